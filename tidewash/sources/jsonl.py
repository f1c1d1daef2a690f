"""JSON-lines and JSON-array sources and sinks.

Readers always take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewash.fixed_values import EXCLUDED_NAME_WORDS
from tidewash.functions.text import py_strip

CORRUPT_COL = "_corrupt_record"


def read_jsonl_strict(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines; blank lines are skipped.  Any line that is not exactly one JSON object
    fitting the schema fails the job, also one with a second value or text after the first."""
    return _strict(read_jsonl_tagged(spark, path, schema))


def read_jsonl_tolerant(spark: SparkSession, path, schema: T.StructType
                        ) -> tuple[DataFrame, DataFrame]:
    """JSON lines where lines that are not exactly one JSON object are quarantined.

    Returns ``(good, quarantine)``; quarantine has the raw line in
    ``_corrupt_record``, so nothing on it is lost: a torn append that left two
    records on a line can be split from there.  Blank lines are skipped.  Where
    both are read, use ``read_jsonl_tagged``, which gives them in one pass.
    """
    tagged = read_jsonl_tagged(spark, path, schema)
    bad = F.col(CORRUPT_COL).isNotNull()
    return tagged.where(~bad).drop(CORRUPT_COL), tagged.where(bad).select(CORRUPT_COL)


def read_jsonl_tagged(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Every non-blank JSON line once: the schema's columns, and ``_corrupt_record``
    with the raw line where it is not exactly one JSON object (the columns are then null)."""
    return _tagged(spark.read.text(path).select("value"), schema)


def one_json_value(line: Column) -> Column:
    """Whether a text is one JSON value that ends where the text ends.

    Spark's JSON functions stop after the first value.  Here the text becomes the first
    of two elements of an array, the second being its digest; only if the text is one
    whole value does the array have these two elements.  (A text that closes the array or
    adds elements of its own cannot also hold its own digest.)"""
    mark = F.md5(line)
    pair = F.from_json(F.concat(F.lit("["), line, F.lit(',"'), mark, F.lit('"]')), T.ArrayType(T.StringType()))
    behind = F.array_join(F.slice(pair, F.lit(2), F.lit(1 << 30)), "\n", "")
    return F.coalesce(behind == mark, F.lit(False))


def _tagged(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines (``value`` and any other columns) parsed: the schema's columns, the others, ``_corrupt_record``."""
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    lines = lines.where(py_strip("value") != F.lit(""))
    others = [c for c in lines.columns if c != "value"]
    # explode, so that the parsed struct is a column and not inlined per field
    parsed = lines.select("value", *others, F.explode(F.array(F.struct(
        F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}).alias("_j"),
        one_json_value(F.col("value")).alias("_whole")))).alias("_p"))
    bad = F.col("_p._j").isNull() | F.col(f"_p._j.{CORRUPT_COL}").isNotNull() | ~F.col("_p._whole")
    return parsed.select(*[F.when(~bad, F.col(f"_p._j.{f.name}")).alias(f.name) for f in schema.fields], *others,
                         F.when(bad, F.col("value")).alias(CORRUPT_COL))


def _strict(tagged: DataFrame) -> DataFrame:
    """Fails at the first corrupt line.  A filter, as it is evaluated whatever columns are read."""
    line = F.col(CORRUPT_COL)
    failed = F.raise_error(F.concat(F.lit("malformed JSON line, it starts: "), F.substring(line, 1, 80)))
    return tagged.where(F.when(line.isNotNull(), failed.cast("boolean")).otherwise(F.lit(True))).drop(CORRUPT_COL)


def read_json_array(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Whole-file JSON arrays of objects; each element becomes a row.

    A file is one task (multi-line JSON is not splittable); writers should
    keep such files bounded.  A malformed file fails the job.
    """
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_string_array(spark: SparkSession, path, value_col: str = "text") -> DataFrame:
    """Whole-file JSON arrays of bare strings; one row per string.

    A file is one cell (so under 2 GB); a malformed file fails the job."""
    raw = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.ArrayType(T.StringType()))
    failed = F.raise_error(F.concat(F.lit("malformed JSON array, it starts: "), F.substring("value", 1, 80)))
    return raw.select(F.explode(F.coalesce(parsed, failed.cast(T.ArrayType(T.StringType())))).alias(value_col))


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths and glob patterns that match something."""
    found = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if matches is not None and len(matches):
            found.append(p)
    return found


def multi_file_scan(spark: SparkSession, base, schema: T.StructType,
                    exclude_words=None, fmt: str = "json",
                    source_col: str | None = "source_file") -> DataFrame:
    """Read many files into one frame that says where each row came from.

    ``base`` is a folder (every file below it; ``source_col`` is the first
    component of the path below the folder) or a list of paths / glob patterns
    (``source_col`` is the file name).  In a folder, files whose path below it
    contains an excluded word (case-insensitive; ``EXCLUDED_NAME_WORDS`` unless
    given) are skipped: the hidden ``_metadata`` column is filtered, so they are
    listed but never read.  Named files and patterns are taken as they are,
    unless ``exclude_words`` is given; it then looks at file names.

    JSON means JSON lines and is strict, as ``read_jsonl_strict``.  A folder that
    is missing or empty, or patterns that match nothing, give an empty frame.
    """
    folder = isinstance(base, str)
    if exclude_words is None:
        exclude_words = EXCLUDED_NAME_WORDS if folder else ()
    paths = _existing(spark, [base] if folder else list(base))
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(source_col, F.lit(None).cast("string")) if source_col else empty
    reader = spark.read.option("recursiveFileLookup", True) if folder else spark.read
    lines = fmt == "json"
    df = reader.text(paths) if lines else reader.schema(schema).format(fmt).load(paths)
    if folder:
        # file_path is URI-encoded (a plus sign is not); the base may have a scheme
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        below = base.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
        name = F.substring_index(path, below, -1)
        source = F.substring_index(name, "/", 1)
    else:
        name = F.col("_metadata.file_name")
        source = name
    keep = F.lit(True)
    for w in exclude_words:
        keep = keep & ~F.contains(F.lower(name), F.lit(w.lower()))
    out = df.where(keep)
    columns = ["value"] if lines else [f.name for f in schema.fields]
    if source_col:
        out = out.select(*columns, source.alias(source_col))
    elif lines:
        out = out.select("value")
    return _strict(_tagged(out, schema)) if lines else out


def per_source_counts(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """Rows per input source plus a grand total (``source`` null)."""
    return df.rollup(source_col).agg(F.count(F.lit(1)).alias("n"))


def write_jsonl(df: DataFrame, path: str, mode: str = "append",
                keep_nulls: bool = True, compression: str | None = None) -> None:
    """Write JSON lines.  Non-ASCII text is written as UTF-8, not escaped.

    ``keep_nulls`` writes ``"field": null`` (as a Python ``json.dumps`` of a
    dict with None would); Spark's default omits null fields.
    """
    w = df.write.mode(mode).option("ignoreNullFields", not keep_nulls)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
