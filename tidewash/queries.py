"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the input tables (or files Spark writes from them) and runs
over whole tables and whole texts.  ``ORACLES`` holds, where the semantics are
expressible in SQL, an independent DuckDB statement over the same tables with
the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewash import fixed_values as FV
from tidewash.functions import records as R
from tidewash.functions import text as X
from tidewash.functions.text import PY_WHITESPACE_CLASS as WS
from tidewash.operators import dedup, filters, joins, keywords, runs, similarity, stats
from tidewash.plans import clean
from tidewash.session import scratch_path
from tidewash.sources import jsonl
from tidewash.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL building blocks for the oracles (DuckDB dialect, RE2 regexes).
_SQL_WS_CHARS = " || ".join(f"chr({ord(ch)})" for ch in X.PY_WHITESPACE_CHARS)


def _sql_strip(x: str) -> str:
    return f"trim({x}, {_SQL_WS_CHARS})"


def _sql_norm(x: str) -> str:
    nl2 = "chr(10) || chr(10)"
    s = f"regexp_replace({x}, '\\n{{3,}}', {nl2}, 'g')"
    s = f"regexp_replace({s}, ' {{2,}}', ' ', 'g')"
    return _sql_strip(s)


def _sql_tokens(x: str) -> str:
    return (f"list_distinct(list_filter(string_split_regex(lower({x}), '{WS}+'), "
            f"lambda t: t <> ''))")


def _sql_messy(x: str) -> str:
    """Messy variant of a text: newline and space runs, padding at both ends."""
    nl = "chr(10)"
    return (f"('  ' || {nl} || replace(replace({x}, '. ', '.   ' || {nl} || {nl} || {nl} || {nl} || ' '), "
            f"', ', ',    ') || ' ' || chr(9) || {nl})")


def _messy(c: str):
    t = F.replace(F.col(c), F.lit(". "), F.lit(".   \n\n\n\n "))
    t = F.replace(t, F.lit(", "), F.lit(",    "))
    return F.concat(F.lit("  \n"), t, F.lit(" \t\n"))


# ---------------------------------------------------------------------------
# 1. Flagship plan: normalise -> length filter -> exact dedup -> counts.
_SQL_HASH = """md5(CASE WHEN text IS NULL THEN '~' ELSE '' END || coalesce(CAST(length(lang) AS VARCHAR), '-1') || ':'
  || coalesce(lang, '') || coalesce(text, ''))"""
_SQL_CLEANED = f"""
WITH n AS (SELECT doc_id, lang, {_sql_norm('text')} AS text FROM documents),
f AS (SELECT * FROM n WHERE length(text) > 30),
h AS (SELECT *, {_SQL_HASH} AS content_hash FROM f),
d AS (SELECT content_hash, arg_min(doc_id, doc_id) AS doc_id, arg_min(lang, doc_id) AS lang,
             arg_min(text, doc_id) AS text FROM h GROUP BY content_hash)
"""


@query("clean_and_count", _SQL_CLEANED + """
SELECT coalesce(lang, 'unknown') AS lang, count(*) AS n FROM d GROUP BY 1""")
def q_clean_and_count(spark, sf):
    return clean.clean_and_count(table(spark, sf, "documents", text_work=True))


@query("cleaned_documents", _SQL_CLEANED + """
SELECT doc_id, content_hash, md5(text) AS text_md5 FROM d""")
def q_cleaned_documents(spark, sf):
    d = clean.cleaned_documents(table(spark, sf, "documents", text_work=True))
    return d.select("doc_id", "content_hash", F.md5("text").alias("text_md5"))


def _null_some(d, c="lang", value="es"):
    """``d`` with nulls in place of one value of a column, to exercise nulls on whole tables."""
    return d.withColumn(c, F.nullif(F.col(c), F.lit(value)))


@query("cleaned_documents_nulls", _SQL_CLEANED.replace(
    "SELECT doc_id, lang, ", "SELECT doc_id, nullif(lang, 'es') AS lang, ", 1).replace(
    "arg_min(lang, doc_id) AS lang,", "arg_min_null(lang, doc_id) AS lang,") + """
SELECT doc_id, content_hash, lang FROM d""")
def q_cleaned_documents_nulls(spark, sf):
    return clean.cleaned_documents(_null_some(table(spark, sf, "documents", text_work=True))).select(
        "doc_id", "content_hash", "lang")


# ---------------------------------------------------------------------------
# 2. Scalar functions.
@query("normalize_whitespace", f"""
SELECT doc_id, md5(t) AS norm_md5, CAST(length(t) AS BIGINT) AS norm_len
FROM (SELECT doc_id, {_sql_norm(_sql_messy('text'))} AS t FROM documents)""")
def q_normalize_whitespace(spark, sf):
    d = table(spark, sf, "documents", text_work=True).select("doc_id", X.normalize_whitespace(_messy("text")).alias("t"))
    return d.select("doc_id", F.md5("t").alias("norm_md5"), F.char_length("t").cast("bigint").alias("norm_len"))


@query("key_normalize", f"""
SELECT doc_id, md5({_sql_strip("lower(" + _sql_messy('text') + ")")}) AS key_md5 FROM documents""")
def q_key_normalize(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return d.select("doc_id", F.md5(X.key_normalize(_messy("text"))).alias("key_md5"))


@query("content_hash", f"""
SELECT doc_id, {_SQL_HASH} AS content_hash, md5(coalesce(lang, '') || text) AS content_hash_plain
FROM (SELECT doc_id, nullif(lang, 'es') AS lang, text FROM documents)""")
def q_content_hash(spark, sf):
    d = _null_some(table(spark, sf, "documents", text_work=True))
    return d.select("doc_id", X.content_hash("lang", "text").alias("content_hash"),
                    X.content_hash("lang", "text", separator_free=True).alias("content_hash_plain"))


@query("char_length", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS text_len, n_chars FROM documents""")
def q_char_length(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.char_length("text").cast("bigint").alias("text_len"), "n_chars")


@query("substring_count", """
SELECT doc_id,
  CAST((length(lower(text)) - length(replace(lower(text), 'the', ''))) / 3 AS BIGINT) AS n_the,
  CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS n_newline,
  CAST((length(text) - length(replace(text, '. ', ''))) / 2 AS BIGINT) AS n_sentence
FROM documents""")
def q_substring_count(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return d.select("doc_id",
                    X.substring_count("text", "the", case_insensitive=True).alias("n_the"),
                    X.substring_count("text", "\n").alias("n_newline"),
                    X.substring_count("text", ". ").alias("n_sentence"))


@query("capped_linear", """
SELECT doc_id, least(length(text) / 1000.0, 5.0) AS length_score FROM documents""")
def q_capped_linear(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.capped_linear(X.char_length("text"), FV.LENGTH_SCORE_SCALE, FV.LENGTH_SCORE_CAP).alias("length_score"))


@query("head_tail_slice", """
SELECT doc_id, left(text, 40) AS head, right(text, 40) AS tail FROM documents""")
def q_head_tail_slice(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.head_slice("text", 40).alias("head"), X.tail_slice("text", 40).alias("tail"))


@query("head_slice", """
SELECT doc_id, left(text, 200) AS head FROM documents""")
def q_head_slice(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.head_slice("text", 200).alias("head"))


@query("tail_slice", """
SELECT doc_id, right(text, 200) AS tail FROM documents""")
def q_tail_slice(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.tail_slice("text", 200).alias("tail"))


@query("prefix_label", """
SELECT doc_id, source || '/' || lang AS label,
       split_part(source || '/' || lang, '/', 1) AS label_source,
       split_part(source || '/' || lang, '/', 2) AS label_lang FROM documents""")
def q_prefix_label(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.prefix_label("source", "lang").alias("label"))
    return d.select("doc_id", "label", X.label_part("label", 1).alias("label_source"),
                    X.label_part("label", 2).alias("label_lang"))


@query("coalesce_default", """
SELECT coalesce(lang, 'general') AS lang, count(*) AS n FROM (
  SELECT lang FROM documents UNION ALL SELECT NULL AS lang FROM benchmark) GROUP BY 1""")
def q_coalesce_default(spark, sf):
    u = stats.union_drift([table(spark, sf, "documents").select("doc_id", "lang"),
                           table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"))])
    return u.groupBy(R.coalesce_default("lang", FV.DEFAULT_CATEGORY_ON_WRITE).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@query("int_unit_convert", """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, CAST(floor(value * 1000000) AS BIGINT) // 1000 AS value_milli
FROM events""")
def q_int_unit_convert(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id",
                    R.int_unit_convert(R.epoch_micros("ts"), 1000).alias("ts_ms"),
                    R.int_unit_convert(F.floor(F.col("value") * 1_000_000), 1000).alias("value_milli"))


@query("surrogate_id", """
SELECT event_id, left(sha256(CAST(event_id AS VARCHAR) || chr(1) || CAST(user_id AS VARCHAR)), 16) AS sid
FROM events""")
def q_surrogate_id(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", R.surrogate_id("event_id", "user_id", width=16).alias("sid"))


@query("ingest_timestamp", """
SELECT event_id, ts_iso, CAST(ts_iso AS TIMESTAMP) AS ts_back FROM (
  SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts_iso FROM events)""")
def q_ingest_timestamp(spark, sf):
    e = table(spark, sf, "events").select("event_id", R.iso_timestamp_string("ts").alias("ts_iso"))
    return e.select("event_id", "ts_iso", R.parse_iso_timestamp("ts_iso").alias("ts_back"))


@query("json_field_path", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       coalesce(json_extract_string(props, '$.meta.source'), 'none') AS meta_source FROM events""")
def q_json_field_path(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", *R.json_fields("props", {"k": (["k"], "int"),
                                                          "meta_source": (["meta", "source"], "string", "none")}))


@query("round_fixed", """
SELECT event_id, round(value / 3.0, 2) AS third_2dp, round(value * 1.37, 1) AS scaled_1dp FROM events""")
def q_round_fixed(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", R.round_fixed(F.col("value") / 3.0, 2).alias("third_2dp"),
                    R.round_fixed(F.col("value") * 1.37, 1).alias("scaled_1dp"))


@query("round_fixed_binary", """
SELECT event_id, CAST(printf('%.2f', value / 3.0) AS DOUBLE) AS third_2dp,
       CAST(printf('%.2f', (event_id % 4001 - 2000) * 0.125::DOUBLE) AS DOUBLE) AS eighths_2dp,
       CAST(printf('%.2f', (event_id % 4001 - 2000)::DOUBLE / 1000) AS DOUBLE) AS thousandths_2dp,
       CAST(printf('%.0f', (event_id % 4001 - 2000)::DOUBLE / 2) AS DOUBLE) AS halves_0dp FROM events""")
def q_round_fixed_binary(spark, sf):
    """As ``round_fixed``, but on the binary value and to even, with many ties and near-ties."""
    e, i = table(spark, sf, "events"), F.col("event_id") % 4001 - 2000
    return e.select("event_id", R.round_fixed_binary(F.col("value") / 3.0, 2).alias("third_2dp"),
                    R.round_fixed_binary(i * 0.125, 2).alias("eighths_2dp"),
                    R.round_fixed_binary(i.cast("double") / 1000, 2).alias("thousandths_2dp"),
                    R.round_fixed_binary(i.cast("double") / 2, 0).alias("halves_0dp"))


# ---------------------------------------------------------------------------
# 3. Filters and predicates.
@query("min_length_filter", f"""
SELECT doc_id, CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT doc_id, {_sql_norm('text')} AS t FROM documents) WHERE length(t) > 30""")
def q_min_length_filter(spark, sf):
    d = table(spark, sf, "documents", text_work=True).select("doc_id", X.normalize_whitespace("text").alias("t"))
    return filters.min_length_filter(d, "t", FV.MIN_CHARS).select(
        "doc_id", F.char_length("t").cast("bigint").alias("text_len"))


@query("category_filter", """
SELECT doc_id, lang, source FROM documents WHERE lang = 'fr'""")
def q_category_filter(spark, sf):
    return filters.category_filter(table(spark, sf, "documents"), "lang", "fr").select("doc_id", "lang", "source")


KEYWORDS = ["license", "password", "secret", "copyright", "@"]


@query("keyword_any", """
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN true ELSE
  (contains(lower(text), 'license') OR contains(lower(text), 'password') OR contains(lower(text), 'secret')
   OR contains(lower(text), 'copyright') OR contains(lower(text), '@')) END AS hit FROM documents""")
def q_keyword_any(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return d.select("doc_id", filters.keyword_any("text", KEYWORDS).alias("hit"))


LONG_KEYWORDS = KEYWORDS + [a + b + c + d for a in "bdgk" for b in "aeiou" for c in "lmnr" for d in "bdgkpt"]


@query("keyword_any_long", f"""
SELECT doc_id, text IS NULL OR text = '' OR regexp_matches(lower(text), '{'|'.join(LONG_KEYWORDS)}') AS hit FROM documents""")
def q_keyword_any_long(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return d.select("doc_id", filters.keyword_any("text", LONG_KEYWORDS).alias("hit"))


@query("keyword_any_table", """
WITH w AS (SELECT list_filter(string_split_regex(text, '[^A-Za-z0-9]+'), lambda x: x <> '') AS w FROM benchmark),
k AS (SELECT DISTINCT lower(w[i] || ' ' || w[i + 1]) AS k FROM w, unnest(range(1, len(w))) AS r(i)),
h AS (SELECT DISTINCT doc_id FROM documents JOIN k ON contains(lower(text), k))
SELECT doc_id, text IS NULL OR text = '' OR doc_id IN (SELECT doc_id FROM h) AS hit FROM documents""")
def q_keyword_any_table(spark, sf):
    """Does the text contain any two words that follow each other in a benchmark text?"""
    words = F.filter(F.split("text", "[^A-Za-z0-9]+"), lambda x: x != "")
    table_ = table(spark, sf, "benchmark").select(words.alias("w")).select(F.explode(F.zip_with(
        F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, 1_000_000_000),
        lambda a, b: F.concat_ws(" ", a, b))).alias("phrase"))
    d = table(spark, sf, "documents", text_work=True).select("doc_id", "text")
    return keywords.keyword_any_table(d, "text", table_, "phrase").select("doc_id", "hit")


@query("code_in_set", """
SELECT event_id, user_id FROM events WHERE user_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144)""")
def q_code_in_set(spark, sf):
    e = table(spark, sf, "events")
    return e.where(filters.code_in_set("user_id", [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])).select("event_id", "user_id")


@query("prefix_predicate", """
SELECT doc_id, starts_with(text, 'The ') AS marked FROM documents""")
def q_prefix_predicate(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", filters.prefix_predicate("text", "The ").alias("marked"))


@query("non_empty", f"""
SELECT doc_id FROM (
  SELECT doc_id, CASE WHEN lang = 'de' THEN ' ' || chr(9) || chr(160) WHEN lang = 'es' THEN NULL
                      ELSE chr(10) || text || ' ' END AS padded FROM documents)
WHERE {_sql_strip('padded')} <> ''""")
def q_non_empty(spark, sf):
    padded = (F.when(F.col("lang") == "de", F.lit(" \t\xa0")).when(F.col("lang") == "es", F.lit(None))
              .otherwise(F.concat(F.lit("\n"), "text", F.lit(" "))))
    return filters.non_empty(table(spark, sf, "documents").select("doc_id", padded.alias("padded")), "padded").select("doc_id")


# ---------------------------------------------------------------------------
# 4. Joins.
@query("resume_anti_join", """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_resume_anti_join(spark, sf):
    todo = table(spark, sf, "documents").select("doc_id")
    done = table(spark, sf, "labels").select("doc_id")
    return joins.resume_anti_join(todo, done, "doc_id")


def _sql_pair_ctes(src: str) -> str:
    """CTEs t, r, p, c, v, pairs over a relation ``src(doc_id, text)``: token
    sets, representatives, lexicographic prefixes, candidates, verified pairs
    (an independent prefix order from the Spark side's rarest-first)."""
    return f"""
t AS (SELECT doc_id, list_sort({_sql_tokens('text')}) AS toks FROM {src}),
r AS (SELECT toks, min(doc_id) AS doc_id, CAST(len(toks) AS BIGINT) AS n FROM t WHERE len(toks) > 0 GROUP BY toks),
p AS (SELECT doc_id, n, unnest(toks[1 : n - (85 * n + 99) // 100 + 1]) AS tok FROM r),
c AS (SELECT DISTINCT a.doc_id AS id_a, b.doc_id AS id_b FROM p a JOIN p b
      ON a.tok = b.tok AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= 85 * greatest(a.n, b.n)),
v AS (SELECT c.id_a, c.id_b, CAST(len(list_intersect(ra.toks, rb.toks)) AS BIGINT) AS n_common, ra.n AS na, rb.n AS nb
      FROM c JOIN r ra ON ra.doc_id = c.id_a JOIN r rb ON rb.doc_id = c.id_b),
pairs AS (SELECT id_a, id_b, n_common, na + nb - n_common AS n_union FROM v
          WHERE n_common * 100 > 85 * (na + nb - n_common))"""


_SQL_SETS = "WITH " + _sql_pair_ctes("documents") + "\n"


@query("resume_ingest", f"""
WITH p AS (SELECT d.doc_id, d.lang, {_sql_norm('d.text')} AS text FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
SELECT coalesce(lang, 'unknown') AS lang, count(*) AS n, count(*) FILTER (WHERE length(text) > 30) AS n_ok,
       count(*) FILTER (WHERE NOT length(text) > 30) AS n_failed FROM p GROUP BY 1""")
def q_resume_ingest(spark, sf):
    """Resumable ingest: the labelled documents are already in the progress
    log; a first run processes the rest in two halves with a restart in
    between (the second run must skip the first run's work); statistics of
    everything processed."""
    from tidewash.plans import resume

    base = scratch_path(spark, "resume")
    docs = table(spark, sf, "documents", text_work=True).select("doc_id", "lang", "text")
    jsonl.write_jsonl(table(spark, sf, "labels").select("doc_id"), f"{base}/progress")

    def process(pending):
        return pending.select("doc_id", "lang", X.normalize_whitespace("text").alias("text"))

    # the English documents arrive first; the second run gets the whole list
    # and must skip what the first run and the progress log already cover
    resume.resume_run(docs.where(F.col("lang") == "en"), "doc_id", process,
                      f"{base}/results", f"{base}/progress")
    resume.resume_run(docs, "doc_id", process, f"{base}/results", f"{base}/progress")
    out = spark.read.json(f"{base}/results", schema="doc_id bigint, lang string, text string")
    return resume.run_statistics(out, "lang", failed=~(F.char_length("text") > 30))


@query("near_dup_pairs", _SQL_SETS + "SELECT id_a, id_b, n_common, n_union FROM pairs")
def q_near_dup_pairs(spark, sf):
    return similarity.near_dup_pairs(table(spark, sf, "documents", text_work=True), "doc_id", "text",
                                     FV.NEAR_DUP_THRESHOLD)


@query("near_dup_pairs_edit")
def q_near_dup_pairs_edit(spark, sf):
    """Second verifier on the candidate pairs: character edit ratio.  No SQL
    oracle: DuckDB's levenshtein counts bytes, Spark's counts characters."""
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_pairs_edit(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD, FV.NEAR_DUP_THRESHOLD)


@query("near_dup_pairs_edit_bytes", _SQL_SETS + """,
e AS (SELECT p.*, levenshtein(a.text, b.text) AS edit_distance,
             greatest(octet_length(encode(a.text)), octet_length(encode(b.text))) AS longest
      FROM pairs p JOIN documents a ON a.doc_id = p.id_a JOIN documents b ON b.doc_id = p.id_b)
SELECT id_a, id_b, n_common, n_union, CAST(edit_distance AS INTEGER) AS edit_distance,
       1.0::DOUBLE - edit_distance::DOUBLE / longest::DOUBLE AS edit_ratio
FROM e WHERE edit_distance <= longest * 15 // 100""")
def q_near_dup_pairs_edit_bytes(spark, sf):
    """The same verifier counting bytes, as DuckDB's levenshtein does."""
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_pairs_edit(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD, FV.NEAR_DUP_THRESHOLD, unit="bytes")


@query("near_dup_earliest", _SQL_SETS + """,
e AS (SELECT id_b, min(id_a) AS first FROM pairs GROUP BY 1)
SELECT t.doc_id AS id, coalesce(e.first, r.doc_id) AS earliest_id, e.first IS NULL AS same_set
FROM t JOIN r ON r.toks = t.toks LEFT JOIN e ON e.id_b = r.doc_id WHERE t.doc_id > coalesce(e.first, r.doc_id)""")
def q_near_dup_earliest(spark, sf):
    """One row per document that has an earlier near-duplicate: the first of them."""
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_earliest(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD)


@query("near_dup_drop_null_ids", "WITH " + _sql_pair_ctes("(SELECT * FROM documents WHERE lang <> 'es')") + """
SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id IN (SELECT doc_id FROM r) AND doc_id NOT IN (SELECT id_b FROM pairs)
UNION ALL
SELECT doc_id, md5(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM t WHERE len(toks) = 0)
UNION ALL
SELECT NULL, md5(text) FROM documents WHERE lang = 'es'""")
def q_near_dup_drop_null_ids(spark, sf):
    """Rows without an id are compared with nothing, and all stay."""
    d = table(spark, sf, "documents", text_work=True).select(
        F.when(F.col("lang") != "es", F.col("doc_id")).alias("doc_id"), "text")
    return similarity.near_dup_drop_earliest(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD).select("doc_id", F.md5("text").alias("text_md5"))


@query("near_dup_pairs_approx")
def q_near_dup_pairs_approx(spark, sf):
    """Candidates of banded min-hashes and of the exact join's keys, exactly verified:
    all of ``near_dup_pairs``; rows-only check."""
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_pairs_approx(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD)


@query("near_dup_members", f"""
WITH t AS (SELECT doc_id, list_sort({_sql_tokens('text')}) AS toks FROM documents WHERE len({_sql_tokens('text')}) > 0)
SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY toks) AS rep_id FROM t
QUALIFY doc_id <> rep_id""")
def q_near_dup_members(spark, sf):
    return similarity.duplicate_members(table(spark, sf, "documents", text_work=True), "doc_id", "text")


@query("near_dup_drop_earliest", _SQL_SETS + """
SELECT doc_id FROM r WHERE doc_id NOT IN (SELECT id_b FROM pairs)
UNION ALL
SELECT doc_id FROM t WHERE len(toks) = 0""")
def q_near_dup_drop_earliest(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_drop_earliest(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD).select("doc_id")


def _sql_greedy_dropped() -> str:
    """CTEs (after the pair CTEs) ending in ``dropped``: a sequential
    first-wins scan over the pair-graph nodes in id order, as a recursive
    CTE carrying the list of kept ids."""
    return """,
nodes AS (SELECT id_a AS id FROM pairs UNION SELECT id_b FROM pairs),
ord AS (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM nodes),
g(rn, kept) AS (
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT g.rn + 1,
         CASE WHEN EXISTS (SELECT 1 FROM pairs q WHERE q.id_b = o.id AND list_contains(g.kept, q.id_a))
              THEN g.kept ELSE list_append(g.kept, o.id) END
  FROM g JOIN ord o ON o.rn = g.rn + 1),
final AS (SELECT kept FROM g ORDER BY rn DESC LIMIT 1),
dropped AS (SELECT id FROM nodes WHERE NOT list_contains((SELECT kept FROM final), id))"""


@query("near_dup_drop_greedy", "WITH RECURSIVE " + _sql_pair_ctes("documents") + _sql_greedy_dropped() + """
SELECT doc_id FROM r WHERE doc_id NOT IN (SELECT id FROM dropped)
UNION ALL
SELECT doc_id FROM t WHERE len(toks) = 0""")
def q_near_dup_drop_greedy(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return similarity.near_dup_drop_greedy(d, "doc_id", "text", FV.NEAR_DUP_THRESHOLD).select("doc_id")


_SQL_CLEAN_DATASET = f"""
WITH n AS (SELECT doc_id, lang, source, {_sql_norm('text')} AS text FROM documents),
h AS (SELECT *, {_SQL_HASH} AS content_hash FROM n),
d AS (SELECT arg_min(doc_id, doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source,
             arg_min(text, doc_id) AS text FROM h GROUP BY content_hash HAVING length(arg_min(text, doc_id)) > 30),
{_sql_pair_ctes('d')},
kept AS (SELECT doc_id FROM r WHERE doc_id NOT IN (SELECT id_b FROM pairs) UNION ALL SELECT doc_id FROM t WHERE len(toks) = 0),
k AS (SELECT d.* FROM d JOIN kept USING (doc_id)),
s AS (SELECT arg_min(doc_id, (-length(text), doc_id)) AS doc_id, arg_min(lang, (-length(text), doc_id)) AS lang,
             arg_min(source, (-length(text), doc_id)) AS source
      FROM k GROUP BY md5({_sql_strip('lower(text)')}))
SELECT 'lang' AS dim, coalesce(lang, 'unknown') AS value, count(*) AS n FROM s GROUP BY 2
UNION ALL
SELECT 'source' AS dim, coalesce(source, 'unknown') AS value, count(*) AS n FROM s GROUP BY 2"""


@query("clean_dataset", _SQL_CLEAN_DATASET)
def q_clean_dataset(spark, sf):
    """The whole cleaning plan (near-duplicates: drop any row with an earlier
    similar one), written as JSON lines, read back, two distributions."""
    out = scratch_path(spark, "clean-dataset")
    kept = clean.clean_dataset(table(spark, sf, "documents", text_work=True), near_dup="earliest", out_path=out)
    return stats.multi_dim_counts(kept, ["lang", "source"], default=FV.DEFAULT_CATEGORY_IN_STATS)


_SQL_CLEAN_DATASET_GREEDY = (
    _SQL_CLEAN_DATASET.replace("WITH n AS", "WITH RECURSIVE n AS", 1)
    .replace("""kept AS (SELECT doc_id FROM r WHERE doc_id NOT IN (SELECT id_b FROM pairs) UNION ALL""",
             _sql_greedy_dropped().lstrip(",") + """,
kept AS (SELECT doc_id FROM r WHERE doc_id NOT IN (SELECT id FROM dropped) UNION ALL""", 1))


@query("clean_dataset_greedy", _SQL_CLEAN_DATASET_GREEDY)
def q_clean_dataset_greedy(spark, sf):
    """Same plan with greedy first-wins near-duplicate removal."""
    out = scratch_path(spark, "clean-dataset-greedy")
    kept = clean.clean_dataset(table(spark, sf, "documents", text_work=True), near_dup="greedy", out_path=out)
    return stats.multi_dim_counts(kept, ["lang", "source"], default=FV.DEFAULT_CATEGORY_IN_STATS)


# ---------------------------------------------------------------------------
# 5. Aggregation, dedup, windows, ordering, set ops.
@query("group_count_sorted", """
SELECT coalesce(event_type, 'unknown') AS event_type, count(*) AS n FROM events GROUP BY 1""")
def q_group_count_sorted(spark, sf):
    return stats.group_count_sorted(table(spark, sf, "events"), "event_type", default=FV.DEFAULT_CATEGORY_IN_STATS)


@query("multi_dim_counts", """
SELECT 'lang' AS dim, coalesce(lang, 'unknown') AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL
SELECT 'source' AS dim, coalesce(source, 'unknown') AS value, count(*) AS n FROM documents GROUP BY 2""")
def q_multi_dim_counts(spark, sf):
    return stats.multi_dim_counts(table(spark, sf, "documents"), ["lang", "source"], default=FV.DEFAULT_CATEGORY_IN_STATS)


@query("stage_audit", f"""
WITH n AS (SELECT doc_id, lang, {_sql_norm('text')} AS text FROM documents),
f AS (SELECT * FROM n WHERE length(text) > 30),
c AS (SELECT (SELECT count(*) FROM documents) AS c0, (SELECT count(*) FROM f) AS c1,
             (SELECT count(DISTINCT {_SQL_HASH}) FROM f) AS c2)
SELECT 1 AS step, 'min_length' AS stage, c0 AS rows_in, c1 AS rows_out, c0 - c1 AS removed FROM c
UNION ALL
SELECT 2, 'exact_dedup', c1, c2, c1 - c2 FROM c""")
def q_stage_audit(spark, sf):
    docs = table(spark, sf, "documents", text_work=True).select("lang", X.normalize_whitespace("text").alias("text"))
    return stats.audit_filter_and_dedup(docs.select(
        X.content_hash("lang", "text").alias("key"), (F.char_length("text") > FV.MIN_CHARS).alias("keep")),
        "key", "keep", ("min_length", "exact_dedup"))


@query("exact_dedup", """
SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY md5(text)""")
def q_exact_dedup(spark, sf):
    d = table(spark, sf, "documents", text_work=True).select("doc_id", F.md5("text").alias("text_md5"))
    return dedup.exact_dedup(d, "text_md5", "doc_id")


@query("group_size", f"""
SELECT doc_id, count(*) OVER (PARTITION BY md5({_sql_strip('lower(text)')})) AS group_size FROM documents""")
def q_group_size(spark, sf):
    d = table(spark, sf, "documents", text_work=True).select("doc_id", "text")
    return dedup.group_size(d, F.md5(X.key_normalize("text"))).select("doc_id", "group_size")


@query("group_size_nulls", """
SELECT doc_id, count(*) OVER (PARTITION BY nullif(lang, 'es')) AS group_size FROM documents""")
def q_group_size_nulls(spark, sf):
    d = _null_some(table(spark, sf, "documents").select("doc_id", "lang"))
    return dedup.group_size(d, "lang").select("doc_id", "group_size")


@query("exact_dedup_nulls", """
SELECT lang, source, min(doc_id) AS doc_id FROM documents WHERE lang <> 'es' GROUP BY lang, source
UNION ALL SELECT NULL, source, doc_id FROM documents WHERE lang = 'es'""")
def q_exact_dedup_nulls(spark, sf):
    """Null keys are no keys: their rows all stay."""
    d = _null_some(table(spark, sf, "documents").select("doc_id", "lang", "source"))
    return dedup.exact_dedup(d, F.concat("lang", F.lit("/"), "source"), "doc_id").select("lang", "source", "doc_id")


@query("best_per_group", f"""
SELECT arg_min(doc_id, (-n_chars, doc_id)) AS doc_id, count(*) AS group_size, count(*) > 1 AS multi_member
FROM documents GROUP BY md5({_sql_strip('lower(text)')})""")
def q_best_per_group(spark, sf):
    return clean.survivors(table(spark, sf, "documents", text_work=True), columns=["doc_id", "n_chars"]).select(
        "doc_id", "group_size", "multi_member")


@query("best_per_group_nulls", f"""
WITH d AS (SELECT *, CASE WHEN lang = 'es' THEN NULL ELSE md5({_sql_strip('lower(text)')}) END AS k FROM documents)
SELECT arg_min(doc_id, (-n_chars, doc_id)) AS doc_id, arg_min(md5(text), (-n_chars, doc_id)) AS text_md5,
       count(*) AS group_size, count(*) > 1 AS multi_member FROM d WHERE k IS NOT NULL GROUP BY k
UNION ALL SELECT doc_id, md5(text), 1, false FROM d WHERE k IS NULL""")
def q_best_per_group_nulls(spark, sf):
    """Whole rows; null keys are no keys: their rows are groups of their own."""
    d = table(spark, sf, "documents", text_work=True)
    k = F.when(F.col("lang") != "es", F.md5(X.key_normalize("text")))
    best = dedup.best_per_group(d, k, [("n_chars", False), ("doc_id", True)])
    return best.select("doc_id", F.md5("text").alias("text_md5"), "group_size", "multi_member")


@query("multi_key_group_count", f"""
SELECT count(*) FILTER (WHERE c > 1) AS n_multi_groups, count(*) AS n_groups
FROM (SELECT count(*) AS c FROM documents GROUP BY md5({_sql_strip('lower(text)')}))""")
def q_multi_key_group_count(spark, sf):
    d = table(spark, sf, "documents", text_work=True)
    return dedup.multi_key_group_count(d, F.md5(X.key_normalize("text")))


def _failed():
    return F.col("event_type") == F.lit("error")


@query("consecutive_runs", """
WITH e AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok_before
           FROM events)
SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event_id, arg_max(event_id, (ts, event_id)) AS last_event_id,
       count(*) AS run_len, count(*) >= 3 AS alert
FROM e WHERE event_type = 'error' GROUP BY user_id, ok_before""")
def q_consecutive_runs(spark, sf):
    e = table(spark, sf, "events")
    return runs.consecutive_runs(e, ["ts", "event_id"], _failed(), "event_id", partition_by="user_id", alert_at=3)


_SQL_TALLY = """
WITH t AS (SELECT event_id, ts, event_type,
  sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS n_ok,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS n_failed,
  min(epoch_us(ts)) OVER w AS t0
  FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query("running_tally", _SQL_TALLY + """
SELECT event_id, CAST(n_ok AS BIGINT) AS n_ok, CAST(n_failed AS BIGINT) AS n_failed FROM t""")
def q_running_tally(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return runs.running_tally(e, ["ts", "event_id"], _failed()).select("event_id", "n_ok", "n_failed")


@query("throughput_eta", _SQL_TALLY + """,
r AS (SELECT event_id, CAST(n_ok AS BIGINT) AS n_ok, (epoch_us(ts) - t0) / 60000000.0 AS elapsed_min FROM t),
q AS (SELECT *, CASE WHEN elapsed_min = 0 THEN NULL ELSE CAST(n_ok AS DOUBLE) / elapsed_min END AS ok_per_min FROM r)
SELECT event_id, n_ok, ok_per_min,
       CASE WHEN ok_per_min IS NULL OR ok_per_min = 0 THEN NULL ELSE CAST(5000 - n_ok AS DOUBLE) / ok_per_min END AS eta_min
FROM q""")
def q_throughput_eta(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return runs.throughput_eta(e, ["ts", "event_id"], "ts", _failed(), target_total=5000).select(
        "event_id", "n_ok", "ok_per_min", "eta_min")


@query("every_nth_summary", _SQL_TALLY + """
SELECT event_id, CAST(n_ok AS BIGINT) AS n_ok, CAST(n_failed AS BIGINT) AS n_failed FROM t
WHERE event_type <> 'error' AND n_ok % 10 = 0""")
def q_every_nth_summary(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return runs.every_nth_summary(e, ["ts", "event_id"], _failed(), every=FV.SUMMARY_EVERY).select("event_id", "n_ok", "n_failed")


@query("cap_per_session", """
SELECT event_id, user_id, rank_in_session FROM (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rank_in_session FROM events)
WHERE rank_in_session <= 5""")
def q_cap_per_session(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return runs.cap_per_session(e, "user_id", ["ts", "event_id"], 5).select(
        "event_id", "user_id", F.col("rank_in_session").cast("bigint").alias("rank_in_session"))


CROSSING_TARGETS = [100_000, 1_000_000, 10_000_000, 40_000_000, 1_000_000_000_000]


@query("first_crossing", """
WITH c AS (SELECT event_id, ts, sum(CAST(round(value * 100) AS BIGINT))
             OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_metric FROM events),
t AS (SELECT unnest([100000, 1000000, 10000000, 40000000, 1000000000000]) AS target),
h AS (SELECT t.target, arg_min(c.event_id, (c.ts, c.event_id)) AS event_id, min(c.ts) AS ts,
             arg_min(c.cum_metric, (c.ts, c.event_id)) AS cum_metric
      FROM t JOIN c ON c.cum_metric >= t.target GROUP BY t.target)
SELECT target, event_id, ts, CAST(cum_metric AS BIGINT) AS cum_metric FROM h""")
def q_first_crossing(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    cents = F.round(F.col("value") * 100).cast("bigint")
    out = runs.first_crossing(e, ["ts", "event_id"], cents, CROSSING_TARGETS, "event_id")
    # a target the total never reaches has no crossing row
    return out.where(F.col("event_id").isNotNull()).select(F.col("target").cast("bigint").alias("target"), "event_id", "ts", "cum_metric")


@query("first_crossing_targets", """
WITH c AS (SELECT event_id, ts, sum(CAST(round(value * 100) AS BIGINT))
             OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM events),
p AS (SELECT CAST(cum AS BIGINT) AS cum, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts FROM c GROUP BY cum),
t AS (SELECT DISTINCT CAST(round(o_totalprice * 100) AS BIGINT) AS target FROM orders)
SELECT t.target, p.event_id, p.ts, p.cum AS cum_metric FROM t ASOF LEFT JOIN p ON t.target <= p.cum""")
def q_first_crossing_targets(spark, sf):
    """A target for every order total; the events' running total reaches some of them."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    targets = table(spark, sf, "orders").select(F.round(F.col("o_totalprice") * 100).cast("bigint").alias("target"))
    return runs.first_crossings(e, ["ts", "event_id"], F.round(F.col("value") * 100).cast("bigint"),
                                targets, "target", "event_id").select("target", "event_id", "ts", "cum_metric")


@query("first_crossing_by_user", """
WITH c AS (SELECT user_id, event_id, ts, sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM events),
t AS (SELECT DISTINCT user_id, CAST(1 + event_id % 40 AS BIGINT) AS target FROM events),
h AS (SELECT user_id, target, arg_min(struct_pack(event_id := c.event_id, ts := c.ts, cum := c.cum), (c.ts, c.event_id)) AS r
      FROM t JOIN c USING (user_id) WHERE c.cum >= t.target GROUP BY ALL)
SELECT user_id, target, r.event_id AS event_id, r.ts AS ts, CAST(r.cum AS BIGINT) AS cum_metric FROM t LEFT JOIN h USING (user_id, target)""")
def q_first_crossing_by_user(spark, sf):
    """Each user's lead of successes over failures, which also falls, against targets of their own."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    targets = e.select("user_id", (F.col("event_id") % 40 + 1).cast("bigint").alias("target"))
    lead = F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    return runs.first_crossings(e, ["ts", "event_id"], lead, targets, "target", "event_id", "user_id").select(
        "user_id", "target", "event_id", "ts", "cum_metric")


EVENT_PRIORITY = {"error": 0, "purchase": 1, "signup": 2, "click": 3, "view": 4}


@query("priority_sort", """
SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2
  WHEN 'click' THEN 3 WHEN 'view' THEN 4 END AS priority FROM events ORDER BY priority, ts, event_id""")
def q_priority_sort(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return stats.priority_sort(e, "event_type", EVENT_PRIORITY, then_by=["ts", "event_id"]).select(
        "event_id", "event_type", "priority")


@query("union_drift", """
SELECT 'documents' AS origin, doc_id AS id, lang, source, NULL AS role, CAST(length(text) AS BIGINT) AS text_len FROM documents
UNION ALL SELECT 'benchmark', item_id, NULL, NULL, NULL, CAST(length(text) AS BIGINT) FROM benchmark
UNION ALL SELECT 'conversations', conv_id, NULL, NULL, role, CAST(length(text) AS BIGINT) FROM conversations""")
def q_union_drift(spark, sf):
    frames = [
        table(spark, sf, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"),
                                             "lang", "source", "text"),
        table(spark, sf, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text"),
        table(spark, sf, "conversations").select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"),
                                                 "role", "text"),
    ]
    u = stats.union_drift(frames)
    return u.select("origin", "id", "lang", "source", "role", F.char_length("text").cast("bigint").alias("text_len"))


@query("sample_n", """
SELECT event_id, event_type FROM events
ORDER BY ('0x' || left(md5(CAST(event_id AS VARCHAR) || ':7'), 8))::BIGINT, event_id LIMIT 100""")
def q_sample_n(spark, sf):
    return stats.sample_n(table(spark, sf, "events").select("event_id", "event_type"), 100, "event_id", seed=7)


@query("sample_half", """
SELECT event_id, event_type FROM events
ORDER BY ('0x' || left(md5(CAST(event_id AS VARCHAR) || ':7'), 8))::BIGINT, event_id LIMIT (SELECT count(*) // 2 FROM events)""")
def q_sample_half(spark, sf):
    """Half of the table, without a merge in one task (beyond ``stats.TOP_K_ROWS`` rows)."""
    e = table(spark, sf, "events").select("event_id", "event_type")
    return stats.sample_n(e, e.count() // 2, "event_id", seed=7)


SAMPLE_FRACTIONS = {"error": 0.5, "purchase": 0.3, "signup": 0.1, "click": 0.05, "view": 0.05}


@query("weighted_stratified_sample", """
SELECT event_id, event_type FROM events
WHERE ('0x' || left(md5(CAST(event_id AS VARCHAR) || ':11'), 8))::BIGINT / 4294967296.0 <
      CASE event_type WHEN 'error' THEN 0.5 WHEN 'purchase' THEN 0.3 WHEN 'signup' THEN 0.1
                      WHEN 'click' THEN 0.05 WHEN 'view' THEN 0.05 ELSE 0.0 END""")
def q_weighted_stratified_sample(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return stats.weighted_stratified_sample(e, "event_type", SAMPLE_FRACTIONS, "event_id", seed=11)


# ---------------------------------------------------------------------------
# 6. Sources and sinks (files are written by Spark from the input tables into
#    a fresh folder under the shared checkpoint root, then read back).
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


def _doc_json_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return d


@query("jsonl_scan_strict", """
SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents""")
def q_jsonl_scan_strict(spark, sf):
    path = scratch_path(spark, "jsonl-strict")
    d = _doc_json_lines(spark, sf)
    # blank lines in between records must be skipped by the reader
    lines = d.select(F.concat(F.to_json(F.struct(*d.columns)), F.lit("\n")).alias("value"))
    lines.write.text(path)
    back = jsonl.read_jsonl_strict(spark, path, DOC_SCHEMA)
    return back.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query("jsonl_scan_strict_refusals", """
SELECT 'fine' AS kind, count(*) AS n_lines, 0 AS n_refused FROM documents
UNION ALL SELECT 'two records', count(*), count(*) FROM documents
UNION ALL SELECT 'text behind', count(*), count(*) FROM documents
UNION ALL SELECT 'closing bracket', count(*), count(*) FROM documents""")
def q_jsonl_scan_strict_refusals(spark, sf):
    """What the strict reader's check of a line says of every document's line, and of the
    line torn in three ways; the reader itself fails at the first refused line (see tests)."""
    d = _doc_json_lines(spark, sf)
    line = F.to_json(F.struct(*d.columns))
    kinds = {"fine": line, "two records": F.concat(line, line), "text behind": F.concat(line, F.lit(' , "x": 1}')),
             "closing bracket": F.concat(line, F.lit("] [1"))}
    rows = d.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n_lines"),
                                    F.count_if(~jsonl.one_json_value(F.col("value"))).alias("n_refused"))


@query("jsonl_scan_tolerant", """
SELECT doc_id, md5(text) AS text_md5, 'ok' AS status FROM documents
UNION ALL SELECT doc_id, NULL, 'quarantine' FROM documents WHERE lang = 'de'
UNION ALL SELECT -1, NULL, 'quarantine' FROM documents WHERE lang = 'es'
UNION ALL SELECT doc_id, NULL, 'two records' FROM documents WHERE lang = 'fr'
UNION ALL SELECT doc_id, NULL, 'text behind' FROM documents WHERE lang = 'fr'""")
def q_jsonl_scan_tolerant(spark, sf):
    path = scratch_path(spark, "jsonl-tolerant")
    d = _doc_json_lines(spark, sf)
    js = F.to_json(F.struct(*d.columns))
    good = d.select(js.alias("value"))
    truncated = d.where(F.col("lang") == "de").select(F.substring(js, 1, 25).alias("value"))
    not_object = d.where(F.col("lang") == "es").select(F.to_json(F.array("text")).alias("value"))
    # a torn append: two records on one line, or one and the rest of another
    twice = d.where(F.col("lang") == "fr").select(F.concat(js, js).alias("value"))
    behind = d.where(F.col("lang") == "fr").select(F.concat(js, F.lit(" "), F.substring(js, 5, 1000)).alias("value"))
    good.unionByName(truncated).unionByName(not_object).unionByName(twice).unionByName(behind).write.text(path)
    tagged, bad = jsonl.read_jsonl_tagged(spark, path, DOC_SCHEMA), F.col(jsonl.CORRUPT_COL).isNotNull()
    return tagged.select(F.when(bad, _id_from_raw(jsonl.CORRUPT_COL)).otherwise(F.col("doc_id")).alias("doc_id"),
                         F.when(~bad, F.md5("text")).alias("text_md5"),
                         F.when(~bad, "ok").when(F.contains(jsonl.CORRUPT_COL, F.lit("}{")), "two records")
                         .when(F.contains(jsonl.CORRUPT_COL, F.lit("} ")), "text behind").otherwise("quarantine").alias("status"))


def _id_from_raw(c):
    """doc_id recovered from a raw (possibly truncated) JSON line, -1 if absent."""
    found = F.regexp_extract(F.col(c), r'"doc_id":(\d+)[,}]', 1)
    return F.when(found == "", F.lit(-1)).otherwise(found).cast("bigint")


BYTES_PER_ARRAY_FILE = 16 << 20


def _array_files(df, c):
    """A folder number per row, so that a folder's texts hold about BYTES_PER_ARRAY_FILE."""
    total = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return F.pmod(F.xxhash64(c), F.lit(total // BYTES_PER_ARRAY_FILE + 1))


@query("json_array_scan", """
SELECT 'documents' AS origin, md5(CAST(doc_id AS VARCHAR) || ':' || text) AS row_md5 FROM documents
UNION ALL SELECT 'benchmark', md5(text) FROM benchmark""")
def q_json_array_scan(spark, sf):
    base = scratch_path(spark, "json-array")
    d = _doc_json_lines(spark, sf)
    # one JSON array per file (one folder per bucket); the number of buckets
    # follows the bytes of the table
    (d.groupBy(_array_files(d, "doc_id").alias("b"))
     .agg(F.to_json(F.collect_list(F.struct(*d.columns))).alias("value"))
     .write.partitionBy("b").text(f"{base}/objects"))
    b = table(spark, sf, "benchmark")
    (b.groupBy(_array_files(b, "item_id").alias("b"))
     .agg(F.to_json(F.collect_list("text")).alias("value"))
     .write.partitionBy("b").text(f"{base}/strings"))
    objs = jsonl.read_json_array(spark, f"{base}/objects", DOC_SCHEMA)
    strs = jsonl.read_json_string_array(spark, f"{base}/strings", "text")
    return objs.select(F.lit("documents").alias("origin"),
                       F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text")).alias("row_md5")).unionByName(
        strs.select(F.lit("benchmark").alias("origin"), F.md5("text").alias("row_md5")))


def _write_labelled_batches(spark, sf, base):
    """Raw batches per language, plus copies in 'Cleaned'/'progress' folders."""
    d = _doc_json_lines(spark, sf)
    batches = d.withColumn("batch", F.concat(F.lit("raw_"), F.col("lang")))
    extra = (d.where(F.col("lang").isin("en", "fr"))
             .withColumn("batch", F.when(F.col("lang") == "en", F.lit("Cleaned_en")).otherwise(F.lit("PROGRESS_fr"))))
    batches.unionByName(extra).write.partitionBy("batch").json(base)


@query("multi_file_scan", """
SELECT doc_id, lang, 'batch=raw_' || lang AS source_file FROM documents""")
def q_multi_file_scan(spark, sf):
    base = scratch_path(spark, "multi-file")
    _write_labelled_batches(spark, sf, base)
    df = jsonl.multi_file_scan(spark, base, DOC_SCHEMA, exclude_words=FV.EXCLUDED_NAME_WORDS)
    return df.select("doc_id", "lang", "source_file")


@query("per_source_counts", """
SELECT 'batch=raw_' || lang AS source_file, count(*) AS n FROM documents GROUP BY ROLLUP ('batch=raw_' || lang)""")
def q_per_source_counts(spark, sf):
    base = scratch_path(spark, "per-source")
    _write_labelled_batches(spark, sf, base)
    df = jsonl.multi_file_scan(spark, base, DOC_SCHEMA, exclude_words=FV.EXCLUDED_NAME_WORDS)
    return jsonl.per_source_counts(df, "source_file")


_CLEAN_FILES_TAIL = """
SELECT 'lang' AS dim, coalesce(lang, 'unknown') AS value, count(*) AS n FROM s GROUP BY 2
UNION ALL
SELECT 'source' AS dim, coalesce(source, 'unknown') AS value, count(*) AS n FROM s GROUP BY 2"""


@query("clean_files", _SQL_CLEAN_DATASET.replace(_CLEAN_FILES_TAIL.strip(), f"""
SELECT 'file' AS section, coalesce('batch=raw_' || lang, 'total') AS name, count(*) AS n
FROM documents GROUP BY ROLLUP ('batch=raw_' || lang)
UNION ALL SELECT 'removed', 'min_length', (SELECT count(*) FROM n WHERE length(text) <= 30)
UNION ALL SELECT 'removed', 'exact_dedup', (SELECT count(*) FROM n WHERE length(text) > 30) - (SELECT count(*) FROM d)
UNION ALL SELECT 'removed', 'near_dup', (SELECT count(*) FROM d) - (SELECT count(*) FROM k)
UNION ALL SELECT 'removed', 'survivorship', (SELECT count(*) FROM k) - (SELECT count(*) FROM s)
UNION ALL SELECT 'lang', coalesce(lang, 'unknown'), count(*) FROM s GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, 'unknown'), count(*) FROM s GROUP BY 2"""))
def q_clean_files(spark, sf):
    """From labelled JSON-lines files (excluded names among them) to a cleaned file and its report."""
    base = scratch_path(spark, "clean-files")
    _write_labelled_batches(spark, sf, f"{base}/in")
    return clean.clean_files(spark, f"{base}/in", DOC_SCHEMA, f"{base}/out", near_dup="earliest")


@query("jsonl_sink_append", """
SELECT doc_id, nullif(lang, 'es') AS lang, md5(text) AS text_md5, source FROM documents""")
def q_jsonl_sink_append(spark, sf):
    path = scratch_path(spark, "sink-append")
    d = _null_some(_doc_json_lines(spark, sf))
    first = F.coalesce(F.col("lang").isin("en", "fr"), F.lit(False))
    jsonl.write_jsonl(d.where(first), path, mode="append")
    jsonl.write_jsonl(d.where(~first), path, mode="append")
    back = jsonl.read_jsonl_strict(spark, path, DOC_SCHEMA)
    return back.select("doc_id", "lang", F.md5("text").alias("text_md5"), "source")


@query("jsonl_sink_overwrite", _SQL_CLEANED + """
SELECT doc_id, md5(text) AS text_md5 FROM d""")
def q_jsonl_sink_overwrite(spark, sf):
    path = scratch_path(spark, "sink-overwrite")
    docs = table(spark, sf, "documents")
    jsonl.write_jsonl(_doc_json_lines(spark, sf), path, mode="overwrite")
    cleaned = clean.cleaned_documents(docs).select("doc_id", "text", "lang", "source")
    jsonl.write_jsonl(cleaned, path, mode="overwrite")
    back = jsonl.read_jsonl_strict(spark, path, DOC_SCHEMA)
    return back.select("doc_id", F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------------------
# 7. Streaming.  The events table arrives as six event-time slices; each
#    query runs twice (slices 0-2, then 3-5) on one checkpoint, so the second
#    run resumes from the first run's state.
def _replay(spark, sf, name, redeliver=None, late_us=None):
    from tidewash.streaming import ingest

    base = scratch_path(spark, name)
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    writers = ingest.write_arrivals(events, "ts", f"{base}/in", 6, redeliver, late_us)
    return base, events.schema, writers


LAST_STREAM_STATS: dict[str, list[dict]] = {}


#: Later than every event by more than any delay below.
STREAM_END = "2200-01-01 00:00:00"


def _until_the_end(spark, base, schema, writers, build, **sink):
    """Each slice arrives whole and is run on its own, then the stream ends: every run but
    the first goes on from the state of the one before."""
    from tidewash.streaming import ingest

    ends = [*writers, lambda: ingest.end_mark(spark, f"{base}/in", schema, "ts", STREAM_END)]
    stats_ = []
    for part in (ends[:2], ends[2:4], ends[4:6], ends[6:]):
        for w in part:
            w()
        stream = ingest.file_stream(spark, f"{base}/in", schema)
        stats_.append(ingest.run_available(build(stream), f"{base}/ckpt", sink_path=f"{base}/out", **sink))
    LAST_STREAM_STATS[base.rsplit("/", 1)[-1].rsplit("-", 1)[0]] = stats_
    return stats_


def _two_runs(spark, base, schema, writers, build, **sink):
    from tidewash.streaming import ingest

    stats_ = []
    for part in (writers[:3], writers[3:]):
        for w in part:
            w()
        stream = ingest.file_stream(spark, f"{base}/in", schema, max_files_per_trigger=8)
        stats_.append(ingest.run_available(build(stream), f"{base}/ckpt", **sink))
    LAST_STREAM_STATS[base.rsplit("/", 1)[-1].rsplit("-", 1)[0]] = stats_
    return stats_


@query("stream_append_ingest", """
SELECT event_id, ts, user_id, event_type, value FROM events""")
def q_stream_append_ingest(spark, sf):
    base, schema, writers = _replay(spark, sf, "stream-ingest")
    _two_runs(spark, base, schema, writers, lambda s: s, sink_path=f"{base}/out")
    return spark.read.schema(schema).parquet(f"{base}/out")


@query("stream_dedup", """
SELECT event_id, ts, user_id, event_type FROM events""")
def q_stream_dedup(spark, sf):
    from tidewash.streaming import ingest

    # the producer re-sends the previous slice's failures with every slice
    base, schema, writers = _replay(spark, sf, "stream-dedup", redeliver=_failed())
    _two_runs(spark, base, schema, writers,
              lambda s: ingest.dedup_stream(s, ["event_id"], "ts", "6 days"), sink_path=f"{base}/out")
    return spark.read.parquet(f"{base}/out").select("event_id", "ts", "user_id", "event_type")


@query("stream_dedup_unlimited", """
SELECT event_id, ts, user_id, event_type FROM events""")
def q_stream_dedup_unlimited(spark, sf):
    """Failures are sent again with the next slice, and the whole first slice at the very end."""
    from tidewash.streaming import ingest

    base, schema, writers = _replay(spark, sf, "stream-dedup-unlimited", redeliver=_failed())
    sink = ingest.first_delivery_sink(f"{base}/out", ["event_id"], "ts")
    _two_runs(spark, base, schema, [*writers, writers[0]], lambda s: s, foreach_batch=sink)
    return ingest.read_deliveries(spark, f"{base}/out", schema).select("event_id", "ts", "user_id", "event_type")


@query("stream_rate_window", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) FILTER (WHERE event_type <> 'error') AS n_ok, count(*) FILTER (WHERE event_type = 'error') AS n_failed
FROM events GROUP BY 1, 2""")
def q_stream_rate_window(spark, sf):
    from tidewash.streaming import ingest

    # rows arrive up to six hours late and out of order; each window is given out once
    late = F.pmod(F.xxhash64("event_id"), F.lit(6 * 3600 * 1_000_000))
    base, schema, writers = _replay(spark, sf, "stream-rate", late_us=late)
    _until_the_end(spark, base, schema, writers, lambda s: ingest.rate_windows(s, "ts", _failed(), "1 hour", "7 hours"))
    return spark.read.parquet(f"{base}/out").select("window_start", "window_end", "n_ok", "n_failed")


@query("stream_run_alert", """
WITH e AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok_before
           FROM events),
f AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id, ok_before ORDER BY ts, event_id) AS run_len
      FROM e WHERE event_type = 'error')
SELECT user_id, event_id, ts, run_len FROM f WHERE run_len = 3""")
def q_stream_run_alert(spark, sf):
    from tidewash.streaming import ingest

    # rows arrive up to six hours late and out of order, over several batches
    late = F.pmod(F.xxhash64("event_id"), F.lit(6 * 3600 * 1_000_000))
    base, schema, writers = _replay(spark, sf, "stream-alert", late_us=late)
    _until_the_end(spark, base, schema, writers, lambda s: ingest.run_alerts(
        s.withColumn("failed", _failed()), "user_id", "ts", "event_id", "failed", 3, delay="7 hours"))
    return spark.read.parquet(f"{base}/out").select("user_id", "event_id", "ts", "run_len")
