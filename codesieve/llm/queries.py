"""The registered queries of the training-data operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import pathlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm import (
    decontaminate,
    hard_negatives,
    jaccard_join,
    lexical_search,
    mixing,
    pstable,
    quality_rules,
    secret_scan,
    sharding,
    suffix_dedup,
    token_rollup,
    url_rules,
    warc,
)
from codesieve.llm.store import Store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


QUALITY_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS p FROM words)),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM starts WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, text, raw, lower(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line FROM (
    SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS raw FROM words)
  WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
duplicate_lines AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM words
          WHERE regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY host),
often AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM lines GROUP BY host, line) l
  JOIN hosts h USING (host) WHERE l.n >= 20 AND l.n > 0.10 * h.n),
taken AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM lines JOIN often USING (host, line) GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(t.n, 0) AS BIGINT) AS n_line_words
  FROM words LEFT JOIN duplicate_lines d USING (doc_id) LEFT JOIN repeated r USING (doc_id) LEFT JOIN taken t USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words - n_line_words < 0.5 * n_words AS depleted FROM base)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM judged
"""


@query("op1_quality_rules", QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("text_key", "host", "line_keys")


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URL_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, max({'h': length(r_host), 'p': length(r_path), 'rule': r_host || r_path, 'verdict': r_verdict}) AS b
  FROM parts, rules
  WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY page_id)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
"""


@query("op6_url_filter", URL_SQL)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_rules.judge(table(spark, sf_dir, "pages", "page_id", "url"), url_rules.rules_table(spark, URL_RULES))


@query("op7_external_shuffle")
def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, checksum, shard and slot of every document."""
    shuffled = sharding.shuffle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return shuffled.select(
        "doc_id",
        sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of distinct 3-word shingles and component at similarity 0.9 of every document."""
    return jaccard_join.groups(table(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=90)


WARC_SQL = r"""
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest
  FROM payloads),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to FROM last
"""


@query("op4_warc_normaliser", WARC_SQL)
def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from normalised archives."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))


#: Rank files of the public vocabularies, first for every document, then for the languages but English.
TOKENIZERS = {
    "byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken",
    "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken",
}


@query("op5_token_rollup")
def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents in, the other languages recounted, toxic documents out; two come twice."""
    first, second = TOKENIZERS
    ranks = {name: pathlib.Path(path).read_bytes() for name, path in TOKENIZERS.items()}
    store = Store(spark, "tokens")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    choose = lambda lang: (first,) if lang == "en" else (first, second)
    counts = store.keep(token_rollup.count_tokens(docs, ranks, choose), "counts")
    toxic = table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1").select("doc_id").distinct()
    change = lambda op, df: df.select(F.lit(op).alias("op"), F.lit(0).alias("seq"), "doc_id", *token_rollup.KEYS, "n_tokens")
    old, new = counts.where(F.col("tokenizer") == first), counts.where(F.col("tokenizer") == second)
    batches = {
        "inserts": change("insert", old),
        "recounts": change("revise", new).withColumn("replaces", F.lit(first)),
        "deletes": change("delete", old.join(toxic, "doc_id", "left_semi")),
    }
    rollup = token_rollup.Rollup(spark, store.path("rollup"))
    for name in ("inserts", "recounts", "recounts", "deletes", "inserts"):
        rollup.commit(name, batches[name])
    return rollup.totals()


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with other numbers, names or units."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).drop("text_key")


@query("op8_temperature_mixing")
def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time a document is seen in the mixture: epoch of its source, block, and slot in the block."""
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("text_key", "copies")


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in all documents, with the forest's verdict; the source stands for the path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.col("source").alias("path"))
    return secret_scan.find_secrets(docs)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once 50-byte strings of smaller documents are taken out."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")


NEGATIVES_SQL = r"""
WITH rows AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_dot_product(a.parts, b.parts) AS BIGINT) AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scores WHERE label = anchor_label)
  WHERE place <= 5),
windows AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all embeddings."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label))


NEAR_VECTORS_SQL = r"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
lengths AS (SELECT *, sqrt(list_dot_product(v, v)) AS length FROM able),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM lengths a JOIN lengths b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.length * b.length) >= 0.98),
reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other),
component AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


@query("op12_pstable_hashing", NEAR_VECTORS_SQL)
def op12_pstable_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at cosine 0.98 within its label."""
    return pstable.near_copies(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


SEARCH_SQL = r"""
WITH documents_terms AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT d, doc_id, term, count(*) AS tf FROM documents_terms GROUP BY d, doc_id, term),
sizes AS (SELECT d, sum(tf)::BIGINT AS n FROM tf GROUP BY d),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
lengths AS (SELECT d, 100 - 25 + ((25 * n * docs) // terms) AS m FROM sizes, totals),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term),
items AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY i, item_id, term),
scores AS (
  SELECT i, item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (d) GROUP BY i, item_id, d, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op13_lexical_search", SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
