"""Operator 7, language ID by Bayesian evidence fusion.

For a row and a language L the log odds are added up:

* text: byte-trigram likelihood P(text | L), trained on a bounded sample of labelled
  rows; long texts count as ``EFFECTIVE`` trigrams, since trigrams are not independent;
* declared language of the markup (or a metadata column): P(declared | L);
* address marks: P(top-level domain | L) and P(language-like first path part | L);
* host prior P(L | host), smoothed towards the registered domain's and that towards
  the whole table's: (n_host,L + K * P(L | domain)) / (n_host + K), and so on up.

The tables of the last three are grouped aggregates over all rows of the text's own
posteriors, so marks are trusted as far as the texts bear them out; a row's own
posterior is taken out of the host and domain counts that judge it.  A host's counts
reach its rows by a join; the few hosts with a thousandth of all rows or more are
broadcast (a thousand at most), so no host makes a hot task.

``UNKNOWN`` competes with flat trigram odds: texts without letters of a known
language lose to it.  A row is accepted if its best language is known and its posterior
is at least ``MIN_POSTERIOR``.

Defined cases: null or empty text is no evidence for any language, so the row is judged
by its other marks but is never accepted; null marks are a value of their own; a null
host has no prior of its own; repeated rows count as rows; an empty table gives an empty
result; other columns are ignored, whatever their names.  Every label with rows is a
language of the model; above ``MAX_LANGUAGES`` of them training is an error.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewash.llm.common import buffers, frees, release, share_limit, sliced, written

UNKNOWN = "und"
#: Labelled rows per language, and bytes of each, that the trigram model is trained on.
SAMPLE_ROWS, SAMPLE_BYTES = 400, 20_000
SLOTS = 1 << 16
#: Labels that the model may have: its table takes 262 MB of every worker then.  More are an error.
MAX_LANGUAGES = 1000
#: Labels whose counts come to the driver at once (<= 84 MB), and values of a task's lists at once.
LABELS_AT_ONCE, BLOCK_VALUES = 64, 640_000
#: Share of a language's probability that is spread over all trigrams.
UNSEEN = 0.1
#: A text's trigrams weigh as this many independent ones at most.
EFFECTIVE = 60.0
#: Weight of the level above in a smoothed prior, in rows.
HOST_K, DOMAIN_K = 4.0, 20.0
MIN_POSTERIOR = 0.5
#: Address marks fall into this many slots.
MARK_SLOTS = 4096

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:65] = 32  # controls, digits and ASCII punctuation are one separator
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram slots of folded bytes, and the text of each; none of pure separators."""
    x = _FOLD[data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slot = ((x[:-2] * 40503 + x[1:-1]) * 40503 + x[2:]) * np.uint32(2654435761) >> np.uint32(16)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (text[:-2] == text[2:]) & (x[1:-1] != 32)
    return slot[keep].astype(np.int64), text[:-2][keep]


def _rows_at_once(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Record batches with at most ``BLOCK_VALUES`` values in a list column of ``n`` a row."""
    step = max(1, BLOCK_VALUES // n)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


@frees
def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        labels = batch.column("label").to_pylist()
        slot, text = _trigrams(*buffers(batch.column("text")))
        for label in sorted(set(labels)):
            mine = np.array([x == label for x in labels])
            at, n = np.unique(slot[mine[text]], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int64))],
                ["label", "slot", "n"])


def train(labelled: DataFrame, text_col: str, label_col: str, languages: list[str] | None = None,
          sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray]:
    """(languages, log P(slot | language)); the last row is ``UNKNOWN``, flat.

    The sample is the same in every run: per label, the rows with the smallest hashes."""
    rows = labelled.select(F.col(label_col).cast("string").alias("label"),
                           F.substring(F.col(text_col).cast("string"), 1, sample_bytes).alias("text"))
    rows = rows.where(F.col("text").isNotNull() & F.col("label").isNotNull())
    if languages:
        rows = rows.where(F.col("label").isin(languages))
    spark = labelled.sparkSession
    sizes = rows.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels in {label_col}: choose some with `languages`")
    most = spark.createDataFrame([(r["label"], share_limit(sample_rows, r["count"])) for r in sizes], "label string, most long")
    keep = rows.join(F.broadcast(most), "label").where(F.xxhash64("text") <= F.col("most"))
    nth = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("text"), "text"))
    sample = keep.withColumn("nth", nth).where(F.col("nth") <= sample_rows).select("label", "text")
    counts = sample.mapInArrow(_slot_counts, "label string, slot int, n long").groupBy("label", "slot").agg(F.sum("n").alias("n"))
    labels = sorted(r["label"] for r in sizes)
    if len(labels) > LABELS_AT_ONCE:
        counts = written(counts, "language-counts")
    names: list[str] = []
    log_p = np.empty((len(labels) + 1, SLOTS), np.float32)
    for at in range(0, len(labels), LABELS_AT_ONCE):
        some = labels[at:at + LABELS_AT_ONCE]
        got = counts.where(F.col("label").isin(some)).toArrow()  # <= LABELS_AT_ONCE x SLOTS rows
        label = got.column("label").to_numpy(zero_copy_only=False) if got.num_rows else np.zeros(0, object)
        slot, n = got.column("slot").to_numpy(), got.column("n").to_numpy()
        for x in some:
            mine = label == x
            if mine.any():
                row = np.zeros(SLOTS)
                row[slot[mine]] = n[mine]
                log_p[len(names)] = np.log((1 - UNSEEN) * row / row.sum() + UNSEEN / SLOTS)
                names.append(x)
    if len(labels) > LABELS_AT_ONCE:
        release(counts)
    log_p[len(names)] = -np.log(SLOTS)  # the unknown: flat odds
    return names, log_p[:len(names) + 1]


@frees
def _text_evidence(batches: Iterator[pa.RecordBatch], log_p: np.ndarray, markup: bool) -> Iterator[pa.RecordBatch]:
    for batch in _rows_at_once(sliced(batches, "text"), len(log_p)):
        if markup:
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(
                [visible_text(t) for t in batch.column("text").to_pylist()], pa.string()))
        slot, text = _trigrams(*buffers(batch.column("text")))
        n = batch.num_rows
        count = np.bincount(text, minlength=n)
        weight = np.minimum(count, EFFECTIVE) / np.maximum(count, 1)
        scores = np.stack([np.bincount(text, weights=p[slot], minlength=n) * weight for p in log_p], axis=1)
        scores -= scores.max(axis=1, keepdims=True)
        others = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(count.astype(np.int64)), pa.array(list(scores), pa.list_(pa.float64()))],
            [*(c for c in batch.schema.names if c != "text"), "n_grams", "ll"])


_RAW = re.compile(r"<(script|style|noscript|template)\b", re.I)
_RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "noscript", "template")}


def visible_text(page: str | None) -> str:
    """The text of a page without markup, comments, scripts and styles, each one space.

    One pass: the next end of each kind is looked for once and kept until it is passed, so
    a comment or script that never ends (it then counts as a tag) does not cost a search each."""
    page = page or ""
    ends: dict[str, tuple[int, int]] = {}

    def end(kind: str, at: int) -> int:
        """Where the first end of ``kind`` at or after ``at`` stops; -1 if there is none."""
        start, stop = ends.get(kind, (-2, -2))
        if stop != -1 and start < at:
            if kind in _RAW_END:
                m = _RAW_END[kind].search(page, at)
                start, stop = m.span() if m else (-1, -1)
            else:
                start = page.find(kind, at)
                stop = start + len(kind) if start >= 0 else -1
            ends[kind] = (start, stop)
        return stop

    out, at = [], 0
    while True:
        mark = page.find("<", at)
        if mark < 0:
            break
        stop, raw = -1, _RAW.match(page, mark)
        if page.startswith("<!--", mark):
            stop = end("-->", mark + 4)
        elif raw:
            stop = end(raw.group(1).lower(), raw.end())
        if stop < 0:
            stop = end(">", mark + 1)
        if stop < 0:
            break  # no markup ends any more
        out += [page[at:mark], " "]
        at = stop
    out.append(page[at:])
    return entities.unescape("".join(out))


def declared_language(html_col: Column) -> Column:
    """The primary language that a page declares: html lang, else a content-language meta."""
    tag = F.regexp_extract(html_col, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", 1)
    meta = F.regexp_extract(
        html_col, r"(?is)<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", 1)
    return F.lower(F.coalesce(F.nullif(tag, F.lit("")), F.nullif(meta, F.lit(""))))


def host_of(url_col: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def address_marks(url_col: Column) -> tuple[Column, Column, Column, Column]:
    """(host, registered domain, top-level domain, language-like first path part)."""
    host = host_of(url_col)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    suffix = F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1)
    path = F.lower(F.regexp_extract(url_col, r"^[^/]*//[^/?#]+/([a-zA-Z]{2})(?:[-_][a-zA-Z]{2})?(?:[/?#]|$)", 1))
    return (host, F.coalesce(F.nullif(domain, F.lit("")), host), F.nullif(suffix, F.lit("")), F.nullif(path, F.lit("")))


def _posterior(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _sums(n: int, name: str = "p") -> list[Column]:
    return [F.sum(F.col(name)[i]) for i in range(n)]


def _mark_table(rows: DataFrame, mark: str, n: int) -> np.ndarray:
    """log P(slot of the mark | language), MARK_SLOTS x n, add-half smoothed."""
    got = rows.groupBy(mark).agg(F.array(*_sums(n)).alias("c")).toArrow().to_pydict()  # <= MARK_SLOTS rows
    table = np.full((MARK_SLOTS, n), 0.5)
    for slot, c in zip(got[mark], got["c"]):
        table[slot] += c
    used = max(1, len(got[mark]))
    return np.log(table / (table.sum(axis=0) - 0.5 * (MARK_SLOTS - used)))


@frees
def _fused(batches: Iterator[pa.RecordBatch], names: list[str], tables: dict[str, np.ndarray],
           base: np.ndarray, accepted: set[str]) -> Iterator[pa.RecordBatch]:
    n = len(base)
    for batch in _rows_at_once(batches, n):
        matrix = lambda c: np.array([x if x is not None else [0.0] * n for x in batch.column(c).to_pylist()]).reshape(-1, n)
        own = matrix("p")
        host, domain = np.maximum(matrix("host_c") - own, 0), np.maximum(matrix("domain_c") - own, 0)
        up = (domain + DOMAIN_K * base) / (domain.sum(axis=1, keepdims=True) + DOMAIN_K)
        prior = (host + HOST_K * up) / (host.sum(axis=1, keepdims=True) + HOST_K)
        logits = matrix("ll") + np.log(np.maximum(prior, 1e-12))
        for mark, table in tables.items():
            logits += table[np.array(batch.column(mark).to_pylist(), dtype=np.int64)]
        post = _posterior(logits)
        best = post.argmax(axis=1)
        lang = [names[i] for i in best]
        top = post[np.arange(len(best)), best]
        some = np.array(batch.column("n_grams").to_pylist()) > 0
        ok = [bool(s and x in accepted and p >= MIN_POSTERIOR) for s, x, p in zip(some, lang, top)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(lang), pa.array(top.astype(np.float64)),
             pa.array(prior[np.arange(len(best)), best].astype(np.float64)), pa.array(ok)],
            ["id", "key", "language", "posterior", "host_prior", "accepted"])


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], id_col: Column, key_col: Column,
             text_col: Column, declared: Column, host: Column, domain: Column, suffix: Column, path: Column,
             markup: bool = False, accepted: list[str] | None = None) -> DataFrame:
    """id, key, language, posterior, host_prior, accepted per row.

    ``markup``: the text is HTML.  ``accepted``: languages that may be accepted (default:
    all that the model knows)."""
    spark = rows.sparkSession
    names = [*model[0], UNKNOWN]
    n = len(names)
    log_p = spark.sparkContext.broadcast(model[1])  # languages x SLOTS floats
    slot = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit(""))), F.lit(MARK_SLOTS)).cast("int")
    facts = rows.select(
        id_col.cast("long").alias("id"), key_col.alias("key"), F.coalesce(text_col.cast("string"), F.lit("")).alias("text"),
        slot(F.lower(declared)).alias("declared"), slot(suffix).alias("suffix"), slot(path).alias("path"),
        host.alias("host"), domain.alias("domain"))
    schema = "id long, key binary, declared int, suffix int, path int, host string, domain string, n_grams long, ll array<double>"
    scored = facts.mapInArrow(lambda b: _text_evidence(b, log_p.value, markup), schema)
    peak = F.aggregate("ll", F.lit(0.0).cast("double"), lambda a, x: a + F.exp(x))
    scored = written(scored.withColumn("p", F.when(F.col("n_grams") > 0, F.transform("ll", lambda x: F.exp(x) / peak))
                                       .otherwise(F.array_repeat(F.lit(0.0), n))), "language-text")

    whole = scored.agg(F.count(F.lit(1)).alias("rows"), F.array(*_sums(n)).alias("c")).first()
    total = np.array([x or 0.0 for x in whole["c"]])
    base = (total + 1.0) / (total.sum() + n)
    tables = {m: _mark_table(scored, m, n) for m in ("declared", "suffix", "path")}

    def with_counts(df: DataFrame, by: str) -> DataFrame:
        counts = written(scored.where(F.col(by).isNotNull()).groupBy(by).agg(
            F.array(*_sums(n)).alias(f"{by}_c"), F.count(F.lit(1)).alias("members")), f"language-{by}")
        often = F.col("members") * 1000 >= int(whole["rows"])  # a thousand groups at most
        hot, cold = counts.where(often).drop("members"), counts.where(~often).drop("members")
        hit = df.join(F.broadcast(hot), by, "left")
        found = F.col(f"{by}_c").isNotNull()
        return hit.where(found).unionByName(hit.where(~found).drop(f"{by}_c").join(cold, by, "left"))

    joined = with_counts(with_counts(scored, "host"), "domain")
    ok = set(accepted if accepted is not None else model[0])
    shared = spark.sparkContext.broadcast((names, tables, base, ok))
    return joined.select("id", "key", "declared", "suffix", "path", "n_grams", "ll", "p", "host_c", "domain_c").mapInArrow(
        lambda b: _fused(b, *shared.value),
        "id long, key binary, language string, posterior double, host_prior double, accepted boolean")
