"""Column helpers for record bookkeeping: ids, timestamps, units, JSON paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewash.functions.common import col_of


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 of a ``timestamp_ntz`` value,
    independent of the session time zone (a cast to ``timestamp`` would
    shift by the zone offset)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col_of(c).cast("timestamp_ntz"))


def event_time(c) -> Column:
    """An instant (``timestamp``) with the same epoch micros as a
    ``timestamp_ntz`` read as UTC; watermarks need this type."""
    return F.timestamp_micros(epoch_micros(c))


def ntz_from_micros(c) -> Column:
    """``timestamp_ntz`` from epoch micros (the inverse of ``epoch_micros``)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", col_of(c), epoch)


def coalesce_default(c, default) -> Column:
    """Value of a possibly missing field, or ``default``."""
    return F.coalesce(col_of(c), F.lit(default))


def int_unit_convert(c, divisor: int) -> Column:
    """Floor division of an integer quantity (e.g. ns -> ms with 1_000_000),
    as Python's ``//``.  Exact for every bigint: the division is decimal, not
    double (epoch nanoseconds exceed a double's 53-bit integer range)."""
    x = col_of(c).cast("bigint").cast("decimal(20,0)")
    return F.floor(x / F.lit(int(divisor)).cast("decimal(20,0)")).cast("bigint")


def surrogate_id(*key_cols, width: int | None = None) -> Column:
    """Reproducible surrogate id: SHA-256 of the key columns.

    ``width`` keeps a prefix of the hex digest (8 for short session ids).
    Call with no key for a random UUID (non-reproducible).
    """
    if not key_cols:
        out = F.expr("uuid()")
    else:
        parts = [F.coalesce(col_of(k).cast("string"), F.lit("\u0000")) for k in key_cols]
        out = F.sha2(F.concat_ws("\u0001", *parts), 256)
    return F.substring(out, 1, width) if width else out


def iso_timestamp_string(c) -> Column:
    """Naive ISO-8601 text the way Python's ``datetime.isoformat()`` writes it.

    Microseconds are written only when non-zero.  The session time zone
    plays no part: a ``timestamp_ntz`` is cast to text directly.
    """
    s = col_of(c).cast("timestamp_ntz").cast("string")
    whole, part = F.split_part(s, F.lit("."), F.lit(1)), F.split_part(s, F.lit("."), F.lit(2))
    whole = F.replace(whole, F.lit(" "), F.lit("T"))
    return F.when(part == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(part, 6, "0")))


# Fixed value: what ``datetime.isoformat()`` writes (a space is read too).
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def ingest_timestamp() -> Column:
    """Ingest time as a naive UTC timestamp, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def parse_iso_timestamp(c) -> Column:
    """Parse ISO text back to ``timestamp_ntz`` (null when malformed).

    A direct cast, so local times that a zone skips stay as they are."""
    s = col_of(c)
    return F.when(s.rlike(ISO_PATTERN), s).try_cast("timestamp_ntz")


def _json_path(path: list[str]) -> str:
    """JSON path of nested keys.  A key with a quote cannot be written in one."""
    if any("'" in p for p in path):
        raise ValueError(f"a key with a single quote has no JSON path: {path}")
    return "$" + "".join(f"['{p}']" for p in path)


def json_field_path(c, path: list[str], default=None, as_type: str | None = None) -> Column:
    """Nested lookup with a default at every level (``d.get(a, {}).get(b, x)``)."""
    v = F.get_json_object(col_of(c), _json_path(path))
    if as_type:
        v = v.try_cast(as_type)
    return v if default is None else F.coalesce(v, F.lit(default))


def json_fields(c, specs: dict) -> list[Column]:
    """Several fields of one JSON text, parsed once into a VARIANT.

    ``specs`` maps an output name to ``(path, type)`` or
    ``(path, type, default)``; a path is a list of keys.  Malformed JSON,
    a missing path or a value of another type gives the default (or null).
    ``get_json_object`` would parse the text again for every field.
    """
    v = F.try_parse_json(col_of(c))
    out = []
    for name, spec in specs.items():
        path, typ, *default = spec
        x = F.try_variant_get(v, _json_path(path), typ)
        if default:
            x = F.coalesce(x, F.lit(default[0]))
        out.append(x.alias(name))
    return out


def round_fixed(c, digits: int) -> Column:
    """Round half away from zero on the decimal value, as a double.

    A deliberate difference: Python rounds the binary value half to even, so
    it makes 0.12 of 0.125 and 2.67 of 2.675; this makes 0.13 and 2.68, as SQL does.
    ``round_fixed_binary`` rounds as Python does."""
    return F.round(col_of(c), digits)


_SPLIT = float(2 ** 27 + 1)  # halves the 53 bits of a double (Veltkamp)


def _product_error(x: Column, p: float, product: Column) -> Column:
    """``x * p - product``, exactly: the halves' products have no rounding error (Dekker)."""
    p_high = p * _SPLIT - (p * _SPLIT - p)
    p_low = p - p_high
    high = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    low = x - high
    return ((high * F.lit(p_high) - product) + high * F.lit(p_low) + low * F.lit(p_high)) + low * F.lit(p_low)


def round_fixed_binary(c, digits: int) -> Column:
    """Round the binary value of a double, ties to even, as Python's ``round`` does: 0.125
    gives 0.12 and 2.675, which is a little less in binary, 2.67.

    ``c * 10^digits`` is taken as a product and its exact rounding error, so the remainder
    that decides is exact.  ``digits`` is 0 to 22 (these powers of ten are exact doubles).
    Null, NaN and infinities stay; a negative value that rounds to zero gives 0.0."""
    if not 0 <= digits <= 22:
        raise ValueError(f"digits must be 0 to 22, got {digits}")
    x, p = col_of(c).cast("double"), float(10 ** digits)
    product = x * F.lit(p)
    below = F.floor(product).cast("double")
    over_half = (product - below) - F.lit(0.5)
    error = _product_error(x, p, product)
    up = (over_half > -error) | ((over_half == -error) & (F.pmod(below, F.lit(2.0)) == 1.0))
    # beyond 2^53 neighbouring doubles are further apart than the digit
    return F.when(F.abs(product) >= F.lit(2.0 ** 53), x).otherwise((below + up.cast("double")) / F.lit(p))
