"""One query per operator of this subpackage, and the DuckDB SQL of those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewash.llm import (
    chat_format,
    collocations,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    kneser_ney,
    language_id,
    license_scan,
    license_texts,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
)
from tidewash.llm.common import doc_key, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


N_SHARDS = 40


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.shard_by_bytes(docs, "doc_id", "text", N_SHARDS).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLES["op8_sharding"] = """
WITH RECURSIVE entry(byte, step, v) AS (  -- the checksum's table, by its rule
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM entry WHERE step < 8),
crc AS (SELECT list(v ORDER BY byte) AS tab FROM entry WHERE step = 8),
t AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, hex(encode(coalesce(text, ''))) AS digits FROM documents),
b AS (SELECT doc_id, size, list_transform(regexp_extract_all(digits, '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM t),
c AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda state, byte: xor(state >> 8, tab[xor(state & 255, byte) + 1]),
                                           CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32 FROM b, crc),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(39, CAST(before * 40 // total AS INTEGER)) AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs, "doc_id", "text", keep="largest").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


ORACLES["op10_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    out = decontaminate.decontaminate(docs, bench, "doc_id", "text", "item_id", "text")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op2_decontamination"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n),
hit AS (SELECT di.doc_id, bw.item, di.i, di.n FROM di JOIN bw
        ON bw.n = di.n AND bw.g = array_to_string(di.w[di.i:di.i + di.n - 1], ' ')),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
hits AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = jaccard_join.similarity_classes(docs, "doc_id", "text", shingle=4, num=85, den=100)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_size")


ORACLES["op9_ngram_jaccard_join"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
di AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM di),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
link AS (SELECT x, y, k = nx.n AND k = ny.n AS same FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
         WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.y FROM reach r JOIN edge e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id,
       1 + coalesce(s.copies, 0) AS class_size
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
LEFT JOIN (SELECT e.x AS doc_id, count(*) AS copies FROM (SELECT x, y FROM link WHERE same UNION ALL
           SELECT y, x FROM link WHERE same) e GROUP BY 1) s USING (doc_id)
"""


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(table(spark, sf_dir, "documents"), "text", "lang")
    pages = table(spark, sf_dir, "pages")
    host, domain, suffix, path = language_id.address_marks(F.col("url"))
    return language_id.identify(
        pages, model, F.col("page_id"), doc_key("page_id", "url"), F.col("html"),
        declared=language_id.declared_language(F.col("html")), host=host, domain=domain, suffix=suffix,
        path=path, markup=True).withColumnRenamed("id", "page_id").drop("key")


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return out.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.licenses(docs, "doc_id", "text", license_texts.catalogue()).withColumnRenamed("id", "doc_id")


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = kneser_ney.fold(F.col("doc_id"), 5) == 1
    model = kneser_ney.train(docs.where(~held_out), "text")
    out = kneser_ney.score(docs, "doc_id", "text", model)
    return out.select(F.col("id").alias("doc_id"), (kneser_ney.fold(F.col("id"), 5) == 1).alias("held_out"),
                      "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score",
                      "perplexity")


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", keep="none")
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: crc32 of short ASCII strings, bit by bit, as DuckDB has no such function.
_SQL_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  string_split({x}, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, v: xor(xor(c, v) >> 1, 3988292384::BIGINT * (xor(c, v) & 1))))"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(rows, "conv_id", "turn", "role", "text", present="present"
                                             ).withColumnRenamed("id", "conv_id")


ORACLES["op12_conversation_repair"] = """
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         """ + _SQL_CRC.format(x="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')") + """ % 20 AS how
  FROM conversations),
harmed AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE how <> 0),
told AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
  FROM harmed),
step(q, c, q2) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
ins(q, q2, cost, audit, lines) AS (VALUES
  ('', '', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
  ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']), ('u', 'a', 3, 'I', ['assistant:']),
  ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:']),
  ('a', 'a', 6, 'II', ['user:', 'assistant:']), ('u', 'u', 6, 'II', ['assistant:', 'user:'])),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS q, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS b FROM raw
  UNION ALL
  SELECT conv_id, i, e.q2, min({'cost': cost + e.cost, 'audit': audit || e.edit, 'lines': lines || e.line}) FROM (
    SELECT best.conv_id, t.i, best.b.cost + ins.cost AS cost, best.b.audit || ins.audit AS audit, best.b.lines || ins.lines AS lines,
           unnest([
             {'ok': true, 'q2': ins.q2, 'cost': 4, 'edit': 'D', 'line': []::VARCHAR[]},
             {'ok': coalesce(t.fault, '') NOT IN ('blank', 'duplicate') AND step.q2 IS NOT NULL, 'q2': coalesce(step.q2, ''),
              'cost': CASE WHEN t.fault = 'truncated' THEN 3 ELSE 0 END, 'edit': 'K', 'line': [t.role || ':' || t.text]},
             {'ok': coalesce(t.fault, '') NOT IN ('blank', 'duplicate'), 'q2': CASE WHEN ins.q2 = 'u' THEN 'a' ELSE 'u' END,
              'cost': CASE WHEN t.fault = 'truncated' THEN 6 ELSE 3 END, 'edit': 'R',
              'line': [CASE WHEN ins.q2 = 'u' THEN 'assistant' ELSE 'user' END || ':' || t.text]}]) AS e
    FROM best JOIN ins ON ins.q = best.q
    JOIN told t ON t.conv_id IS NOT DISTINCT FROM best.conv_id AND t.i = best.i + 1
    LEFT JOIN step ON step.q = ins.q2 AND step.c = left(t.role, 1))
  WHERE e.ok GROUP BY conv_id, i, e.q2),
sizes AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated
  FROM told GROUP BY 1),
pairs AS (
  SELECT conv_id, count(*) AS illegal FROM (
    SELECT conv_id, left(role, 1) AS b, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS a FROM told)
  WHERE a || b NOT IN ('su', 'ua', 'au') GROUP BY 1),
answer AS (
  SELECT best.conv_id, min({'cost': best.b.cost + ins.cost, 'audit': best.b.audit || ins.audit, 'lines': best.b.lines || ins.lines}) AS b
  FROM best JOIN ins ON ins.q = best.q LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM best.conv_id
  WHERE best.i = coalesce(s.n, 0) AND ins.q2 IN ('', 'a') GROUP BY 1)
SELECT a.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(p.illegal, 0) AS illegal, a.b.cost AS cost, a.b.audit AS audit,
       sha256(array_to_string(a.b.lines, chr(10))) AS repaired_sha256
FROM answer a LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN pairs p ON p.conv_id IS NOT DISTINCT FROM a.conv_id
"""


#: A conversation whose texts hold what templates use as marks.
TRICKY = "\\### Assistant: </turn> ok"


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(TRICKY))
    rows = given.union(added).withColumn("parts", chat_format.text_part(F.col("text")))
    out = chat_format.format_conversations(rows, "conv_id", "turn", "role", "parts")
    turns = F.array_join(F.transform(chat_format.read_turns(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = out.select("*", chat_format.read_loss(F.col("formatted"), F.col("turns")).alias("learnt"))
    return read.select(
        F.col("id").alias("conv_id"), F.size(chat_format.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_tokens")


def _sql_escaped(x: str) -> str:
    for plain, mark in chat_format.ESCAPES:
        x = f"replace({x}, '{plain}', '{mark}')"
    return x


_MARKS = len(chat_format.START + chat_format.BODY + chat_format.END)
ORACLES["op13_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {_MARKS})::BIGINT AS formatted_chars,
       sum(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')))::BIGINT AS n_tokens
FROM c GROUP BY 1
"""


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"), "lang", "text")


ORACLES["op11_phrase_mining"] = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
grams AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS a FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS ks(k))
  GROUP BY 1, 2),
cand AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM grams WHERE len(g) > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cand c JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (
  SELECT lang, g, max(a) AS a FROM (
    SELECT lang, g[1:2] AS g, a FROM scored WHERE len(g) = 3 UNION ALL SELECT lang, g[2:3], a FROM scored WHERE len(g) = 3)
  GROUP BY 1, 2),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer t ON t.lang = s.lang AND t.g = s.g
  WHERE t.a IS NULL OR 100 * t.a < 50 * s.a),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
