"""Registered queries of the training-corpus operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.llm import (anchor_codes, chat_trees, class_lm, decontamination, jaccard_join, license_scan,
                            pattern_packing, quality_classifier, quality_rules, sharding, spelling_variants,
                            substring_dedup, toxicity)
from reportwide.plans.registry import register, table

SQL_OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS p FROM d WHERE len(ws) >= 13)),
lo AS (SELECT k, min(doc_id) AS lo FROM g GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS q
  FROM g JOIN lo USING (k) WHERE lo.lo < g.doc_id),
word AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS q, unnest(ws) AS w FROM d WHERE len(ws) > 0),
kept AS (
  SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.q) FILTER (WHERE gone.q IS NULL) AS t,
         count(gone.q) AS n_removed
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.q = word.q GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def _joined_words(text):
    """Words of a text joined by one space; null gives the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]+", " "))


@register("op1_substring_dedup", SQL_OP1)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(_joined_words(F.col("text")), 256).alias("kept_sha256"))


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@register("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


# A conversation that quotes the template's own control strings.
QUOTING_ID, QUOTING_TEXT = -7, "\\### Assistant: </turn> ok"

SQL_OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) AS r,
         length(text) + length(regexp_replace(text, '[^\\<#:]', '', 'g')) AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + r + 2 + t + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""".replace("\\\\###", "\\###")


@register("op4_chat_trees", SQL_OP4)
def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(QUOTING_ID).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(QUOTING_TEXT).alias("text"))
    out = chat_trees.read_back(chat_trees.format_paths(chat_trees.linear(rows.unionByName(quoting))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("masked", "")
    return out.select(F.col("tree.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@register("op5_feistel_shards")
def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


@register("op6_nb_svm")
def op6_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


SQL_OP7 = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL),
phrases AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[p:p + 9], ' ') AS k
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS p FROM items WHERE len(ws) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
g AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS p
        FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(ws) >= n)),
m AS (SELECT doc_id, p, n, item FROM g JOIN phrases USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


@register("op7_positional_decontamination", SQL_OP7)
def op7_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@register("op8_brown_classes")
def op8_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


SQL_OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 5 * o >= 4 * (a.n + b.n - o)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
low AS (SELECT x, min(y) AS low FROM reach GROUP BY x)
SELECT d.doc_id, least(d.doc_id, coalesce(low.low, d.doc_id)) AS class_id,
       (SELECT count(*) FROM links WHERE links.x = d.doc_id) AS n_links
FROM d LEFT JOIN low ON low.x = d.doc_id"""


@register("op9_ngram_jaccard_join", SQL_OP9)
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op10_pattern_packing")
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def _sql_op11() -> str:
    """k-means over the parts by comparing every part with every entry."""
    assign = """a{r} AS (SELECT p.rn, p.part, arg_min(c.e, 64 * d(p.q, c.q) + c.e) AS e, min(d(p.q, c.q)) AS err
  FROM p JOIN c{r} c USING (part) GROUP BY p.rn, p.part)"""
    move = """c{s} AS (
  SELECT part, c.e, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (
    SELECT part, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS q FROM (
      SELECT part, e, i, sum(p.q[i]) AS s, count(*) AS n
      FROM a{r} JOIN p USING (rn, part), generate_series(1, 4) g(i) GROUP BY part, e, i) GROUP BY part, e) m USING (part, e))"""
    rounds = ",\n".join([assign.format(r=0), move.format(r=0, s=1), assign.format(r=1), move.format(r=1, s=2), assign.format(r=2)])
    rounds = rounds.replace("d(p.q, c.q)", "(" + " + ".join(f"(p.q[{i}] - c.q[{i}]) * (p.q[{i}] - c.q[{i}])" for i in range(1, 5)) + ")")
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
p AS (SELECT rn, part, v[4 * part + 1:4 * part + 4] AS q FROM k, generate_series(0, 15) g(part)),
c0 AS (SELECT part, rn - 1 AS e, q FROM p WHERE rn <= 64),
{rounds},
books AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, e)) AS h FROM c2),
coded AS (SELECT rn, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(err) AS BIGINT) AS error FROM a2 GROUP BY rn)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM k JOIN coded USING (rn), books"""


@register("op11_anchor_codes", _sql_op11())
def op11_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_codes.compress(table(spark, sf_dir, "embeddings"))


def _crc32_table() -> list[int]:
    out = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


# DuckDB has no crc32: it is folded from the bytes of `<doc_id>:<run>`, which are ASCII or U+00C0 to U+00FF.
SQL_OP12 = f"""
WITH RECURSIVE t AS (SELECT {_crc32_table()} AS t),
run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, w, sum(c) AS c FROM (
    SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, 1 AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents)) GROUP BY ALL),
crc AS (
  SELECT w, c, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || w, ''),
      lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [195, CAST(unicode(ch) - 64 AS BIGINT)] END))),
    lambda a, b: xor(t[CAST(xor(a, b) & 255 AS BIGINT) + 1], a >> 8))) AS h
  FROM run, t),
word AS MATERIALIZED (
  SELECT w, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2)
                ELSE w END AS w, c FROM crc)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(c) >= 3),
gap AS (SELECT w, n, i, substr(w, 1, i) AS a, substr(w, i + 2) AS z
        FROM (SELECT w, n, unnest(generate_series(0, length(w) - 1)) AS i FROM word)),
near AS MATERIALIZED (
  SELECT x.w, x.n, y.w AS v, y.n AS m FROM gap x JOIN gap y USING (a, z) WHERE x.w <> y.w
  UNION SELECT x.w, x.n, y.w, y.n FROM gap x JOIN word y ON y.w = x.a || x.z
  UNION SELECT y.w, y.n, x.w, x.n FROM gap x JOIN word y ON y.w = x.a || x.z),
best AS (SELECT w, n, count(*) AS n_near, max(m) AS m, arg_min(v, (-m, v)) AS v FROM near GROUP BY w, n),
form AS MATERIALIZED (SELECT w, v, m FROM best WHERE m >= 2 * n),
chain AS (SELECT w, v FROM form UNION SELECT chain.w, form.v FROM chain JOIN form ON form.w = chain.v),
root AS (SELECT w, v FROM chain WHERE v NOT IN (SELECT w FROM form))
SELECT word.w AS word, form.v AS form, coalesce(root.v, word.w) AS root, word.n,
       CAST(coalesce(best.n_near, 0) AS BIGINT) AS n_near, form.m AS form_n
FROM word LEFT JOIN best ON best.w = word.w LEFT JOIN form ON form.w = word.w LEFT JOIN root ON root.w = word.w"""


@register("op12_spelling_variants", SQL_OP12)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


@register("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
