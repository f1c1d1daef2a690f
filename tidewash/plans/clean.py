"""The document cleaning plan: normalise, filter, de-duplicate, survivorship,
distributions.  Each step is a DataFrame operator; the plan is one lazy
DataFrame that Catalyst optimises end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewash.functions.text import content_hash, key_normalize, normalize_whitespace
from tidewash.operators.dedup import best_per_group, exact_dedup
from tidewash.operators.filters import min_length_filter
from tidewash.operators.similarity import near_dup_drop_earliest, near_dup_drop_greedy
from tidewash.operators.stats import group_count_sorted, multi_dim_counts, observe_stage
from tidewash.session import checkpoint_root, scratch_path
from tidewash.sources.jsonl import (
    multi_file_scan,
    per_source_counts,
    read_jsonl_strict,
    write_jsonl,
)

from tidewash.fixed_values import (
    DEFAULT_CATEGORY_IN_STATS,
    EXCLUDED_NAME_WORDS,
    MIN_CHARS,
    NEAR_DUP_THRESHOLD,
)


def cleaned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      hash_with: str = "lang", min_chars: int = MIN_CHARS,
                      columns: list[str] | None = None) -> DataFrame:
    """Normalise whitespace, keep texts longer than ``min_chars``, then keep
    the first row (smallest id) of each content hash.

    The length filter is applied after the de-duplication: rows with one
    content hash have the same normalised text, hence the same length, so
    the order does not change the result.  It lets the normalisation run
    once per row (a filter below it would be inlined and evaluate the
    regexes twice).  ``columns`` limits what the result carries (id and hash
    are always kept): narrow rows go through one aggregation.  Otherwise only
    hashes and ids are aggregated and texts are fetched afterwards.
    """
    d = docs.withColumn(text_col, normalize_whitespace(text_col))
    d = (d.withColumn("content_hash", content_hash(hash_with, text_col))
         .withColumn("_tw_len", F.char_length(text_col)))
    if columns is not None:
        keep = [id_col, "content_hash", "_tw_len"] + [c for c in columns if c not in (id_col,)]
        d = d.select(*dict.fromkeys(keep))
    d = exact_dedup(d, "content_hash", id_col, late=columns is None)
    return d.where(F.col("_tw_len") > F.lit(min_chars)).drop("_tw_len")


def clean_and_count(docs: DataFrame, by: str = "lang",
                    default: str = DEFAULT_CATEGORY_IN_STATS) -> DataFrame:
    """Slice 1: cleaned documents counted per ``by``, most frequent first."""
    return group_count_sorted(cleaned_documents(docs, columns=[by]), by, default=default, out="n")


def deduplicated_documents(docs: DataFrame, near_dup: str = "greedy",
                           threshold=NEAR_DUP_THRESHOLD, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """Cleaned documents without near-duplicates (``greedy`` first-wins or
    ``earliest``: drop anything with an earlier similar row).

    The near-duplicate step reads its input twice (token sets, then the
    surviving rows), so the cleaned rows are materialised once with a
    reliable checkpoint in the shared checkpoint folder instead of being
    recomputed from the scan.
    """
    d = cleaned_documents(docs, id_col, text_col)
    if near_dup in (None, "none"):
        return d
    checkpoint_root(d.sparkSession)
    return _without_near_duplicates(d.checkpoint(), near_dup, threshold, id_col, text_col)


def _without_near_duplicates(d: DataFrame, near_dup: str | None, threshold, id_col: str, text_col: str) -> DataFrame:
    if near_dup in (None, "none"):
        return d
    if near_dup == "greedy":
        return near_dup_drop_greedy(d, id_col, text_col, threshold)
    if near_dup == "earliest":
        return near_dup_drop_earliest(d, id_col, text_col, threshold)
    raise ValueError(near_dup)


def clean_dataset(docs: DataFrame, near_dup: str = "greedy", threshold=NEAR_DUP_THRESHOLD,
                  out_path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", survivorship: bool = True) -> DataFrame:
    """The full cleaning plan: normalise, length filter, exact and near
    de-duplication, one survivor per normalised text key (longest cleaned
    text, then smallest id; unless ``survivorship`` is off), optionally written
    as JSON lines (overwrite) and read back from there."""
    d = deduplicated_documents(docs, near_dup, threshold, id_col, text_col)
    s = _survivors_of_cleaned(d, id_col, text_col) if survivorship else d
    if out_path is None:
        return s
    schema = s.schema
    write_jsonl(s, out_path, mode="overwrite")
    return read_jsonl_strict(s.sparkSession, out_path, schema)


def _survivors_of_cleaned(d: DataFrame, id_col: str, key_col: str, text_col: str | None = None,
                          order: tuple = ()) -> DataFrame:
    """One row per normalised ``key_col``: first by ``order`` ((column, ascending) pairs), then
    the longest ``text_col``, then the smallest id."""
    d = (d.withColumn("_key", F.md5(key_normalize(key_col)))
         .withColumn("_len", F.char_length(text_col or key_col)))
    return best_per_group(d, "_key", [*order, ("_len", False), (id_col, True)]).drop("_key", "_len")


def _written(d: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``d`` written to the scratch folder and read back, and its rows as observed on the way."""
    path = scratch_path(d.sparkSession, name)
    seen, rows = observe_stage(d, name)
    seen.write.parquet(path)
    return d.sparkSession.read.schema(d.schema).parquet(path), rows.get["rows"]


def clean_files(spark: SparkSession, base, schema: T.StructType, out_path: str, near_dup: str = "greedy",
                threshold=NEAR_DUP_THRESHOLD, survivorship: bool = True, id_col: str = "doc_id",
                text_cols: tuple[str, ...] = ("text",), hash_with: str = "lang", dims: tuple[str, ...] = ("lang", "source"),
                exclude_words=EXCLUDED_NAME_WORDS, similar_col: str | None = None, key_col: str | None = None,
                survivor_order: tuple = ()) -> DataFrame:
    """From JSON-lines files to a cleaned file, with a report.

    Files below ``base`` whose name has an excluded word are skipped.  All ``text_cols`` are
    normalised.  The first is the text whose length is tested and that is hashed, with
    ``hash_with``, for exact duplicates.  Near-duplicates are looked for in ``similar_col`` and
    survivors grouped by ``key_col`` (both default to the first text).  Of a group the row that
    is first by ``survivor_order``, (column, ascending) pairs, stays; then the one with the
    longest first text, then the smallest id.  The result is written to ``out_path`` as JSON
    lines.  Report rows (section, name, n): ``file`` with the rows of each file and
    their total, ``removed`` with the rows that each step removed, then one
    section per column of ``dims`` with its distribution in the result.

    The files are parsed once.  Each step's rows are written once and counted on the way by
    an observation of that write; no step is counted by a pass of its own.
    """
    text = text_cols[0]
    raw = multi_file_scan(spark, base, schema, exclude_words)
    long_enough = Observation("min_length")
    docs = raw.withColumns({c: normalize_whitespace(c) for c in text_cols})
    docs, n_read = _written(docs.observe(long_enough, F.count_if(F.char_length(text) > MIN_CHARS).alias("rows")), "clean-read")
    n_long = long_enough.get["rows"] or 0
    sources = per_source_counts(docs).select(F.lit("file").alias("section"),
                                             F.coalesce("source_file", F.lit("total")).alias("name"), "n")
    exact, n_exact = _written(cleaned_documents(docs.drop("source_file"), id_col, text, hash_with), "clean-exact")
    distinct, n_distinct = _written(_without_near_duplicates(exact, near_dup, threshold, id_col, similar_col or text), "clean-near")
    kept = distinct.drop("content_hash")
    if survivorship:
        kept = _survivors_of_cleaned(kept, id_col, key_col or text, text, survivor_order).drop("group_size", "multi_member")
    seen, rows = observe_stage(kept, "survivors")
    write_jsonl(seen, out_path, mode="overwrite")
    n_kept = rows.get["rows"]
    steps = [("min_length", n_read - n_long), ("exact_dedup", n_long - n_exact),
             ("near_dup", n_exact - n_distinct), ("survivorship", n_distinct - n_kept)]
    removed = spark.createDataFrame([("removed", name, n) for name, n in steps], "section string, name string, n long")
    result = read_jsonl_strict(spark, out_path, kept.schema)
    found = multi_dim_counts(result, list(dims), default=DEFAULT_CATEGORY_IN_STATS).select(
        F.col("dim").alias("section"), F.col("value").alias("name"), "n")
    return sources.unionByName(removed).unionByName(found)


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              columns: list[str] | None = None) -> DataFrame:
    """One row per normalised text key: the longest original, then smallest id.

    ``columns`` limits what the shuffle carries (``id_col`` and ``n_chars`` are
    needed for the order)."""
    d = docs.withColumn("_key", F.md5(key_normalize(text_col)))
    if columns is not None:
        d = d.select(*dict.fromkeys([id_col, "n_chars", *columns, "_key"]))
    return best_per_group(d, "_key", [("n_chars", False), (id_col, True)], late=columns is None).drop("_key")
