"""The subpackage's queries over the tables of a folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (decontaminate, jaccard, language, lexical, neighbours, pieces, pii, quality, secret_scan, simhash,
                          suffixes, toxicity, trie)
from starloom.llm.scan import crc_rest
from starloom.llm.spans import count, digest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op1_decontaminate"] = r"""
WITH words AS (
    SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS key, doc_id, text FROM documents
    UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), NULL, text FROM benchmark),
split AS (
    SELECT kind, key, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM words),
items AS (SELECT key, w, least(10, len(w)) AS n FROM split WHERE kind = 'b' AND len(w) > 0 AND key IS NOT NULL),
item_windows AS (
    SELECT DISTINCT key, n, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT key, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM items),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, sizes WHERE kind = 'd' AND len(w) >= n)),
found AS (SELECT d.doc_id, d.n, d.i, b.key FROM doc_windows d JOIN item_windows b USING (n, words)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(key, ',' ORDER BY key) AS items
          FROM (SELECT DISTINCT doc_id, key FROM found) GROUP BY doc_id)
SELECT s.doc_id, len(s.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) WHERE s.kind = 'd'
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), train=crc_rest("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_rest("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs, train=crc_rest("doc_id", 3) != 1)
    return language.predict(docs, model).select("doc_id", (crc_rest("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), train=crc_rest("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id", (crc_rest("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *(count(F.col("base"), kind).alias(f"n_{kind}") for kind in secret_scan.KINDS),
                        F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *(count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
                        F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"))


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"), links=True)


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(read(spark, sf_dir, "documents"))


@query
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"))


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.grafted_trie(read(spark, sf_dir, "conversations"))


ORACLES["op11_trie"] = r"""
WITH numbered AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'r': role, 't': text} ORDER BY pos) AS turns FROM numbered GROUP BY c),
tables AS (SELECT range AS b0 FROM range(256)),
steps AS (
    WITH RECURSIVE s(b, v, n) AS (
        SELECT b0, b0, 0 FROM tables
        UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM s WHERE n < 8)
    SELECT list(v ORDER BY b) AS t FROM s WHERE n = 8),
digits AS (SELECT c, string_split(CAST(c AS VARCHAR), '') AS chars FROM own),
crc AS (
    SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(chars, lambda x: ascii(x)::BIGINT)),
                              lambda v, x: xor(v >> 8, t[(xor(v, x) & 255) + 1])), 4294967295) AS value
    FROM digits, steps),
built AS (
    SELECT o.c, list_concat(coalesce(b.turns[1 : value % 4], []), o.turns[value % 4 + 1 :]) AS turns
    FROM own o JOIN crc USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 20),
prefixes AS (SELECT c, len(turns) AS size, d, turns[1 : d] AS p, turns[d] AS last FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(last) AS last,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
    FROM prefixes GROUP BY d, p),
counted AS (
    SELECT n.*, coalesce(k.kids, 0) AS kids,
           CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.last.t, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes n LEFT JOIN (SELECT d - 1 AS kd, p[1 : d - 1] AS kp, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL) k ON k.kd = n.d AND k.kp = n.p),
below AS (
    SELECT a.d, a.p, sum((x.kids = 0)::BIGINT) AS n_leaves, sum(x.saved) AS saved_tokens
    FROM counted a JOIN (SELECT *, unnest(range(0, d + 1)) AS up FROM counted) x ON x.up = a.d AND x.p[1 : x.up] = a.p
    GROUP BY a.d, a.p)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.kids AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON b.d = n.d AND b.p = n.p
LEFT JOIN nodes q ON q.d = n.d - 1 AND n.d > 0 AND q.p = n.p[1 : n.d - 1]
"""


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(read(spark, sf_dir, "documents"))


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLES["op13_lexical"] = r"""
WITH terms AS (
    SELECT 'd' AS kind, doc_id AS key, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term, NULL AS item
    FROM documents
    UNION ALL
    SELECT 'b', NULL, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), item_id
    FROM benchmark),
tf AS (SELECT key AS doc_id, term, count(*) AS tf FROM terms WHERE kind = 'd' GROUP BY ALL),
docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
df AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
asked AS (SELECT item AS item_id, term, count(*) AS times FROM terms WHERE kind = 'b' GROUP BY ALL),
scored AS (
    SELECT a.item_id, t.doc_id, CAST(sum(a.times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
    FROM asked a JOIN tf t USING (term) JOIN df USING (term) JOIN docs d ON d.doc_id = t.doc_id, total
    GROUP BY a.item_id, t.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""
