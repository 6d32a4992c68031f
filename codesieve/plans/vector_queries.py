"""Words, vocabularies and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from codesieve.functions.unnest import unnest, unnest_structs
from codesieve.functions import profiles, text
from codesieve.operators import scan, vectors
from codesieve.plans import sql, views
from codesieve.plans.registry import query
from codesieve.plans.sql import q, with_views


def docs(spark, sf_dir):
    """(file_id, language, tokens) of the files whose language has a profile."""
    routed = scan.route(views.code_files(spark, sf_dir))
    known = routed.select(
        "file_id", profiles.profile_of(F.col("language")).alias("language"), text.clean_multi(F.col("code")).alias("clean")
    ).where("language IS NOT NULL")
    stop = profiles.words_of(F.col("language"), profiles.STOP_WORDS)
    return known.select("file_id", "language", vectors.tokens(F.col("clean"), stop).alias("tokens"))


def counted(spark, sf_dir):
    return vectors.with_term_counts(vectors.with_terms(docs(spark, sf_dir)).drop("tokens")).drop("terms")


_STOP = " ".join(
    f"WHEN {q(language)} THEN [{', '.join(map(q, words))}]" for language, words in profiles.STOP_WORDS.items()
)
_BASE = (
    with_views("", "routed").rstrip()
    + f""", d AS (SELECT file_id, language, list_filter(regexp_extract_all(lower({sql.clean('code', text.COMMENTS_ALL, text.KEEP_MULTI)}), {q(text.WORD + '{2,}')}),
    lambda x: NOT list_contains(CASE language {_STOP} END, x)) AS t FROM (
    SELECT file_id, code, CASE language WHEN 'javascript' THEN 'js' ELSE language END AS language FROM routed) WHERE language IS NOT NULL),
    g AS (SELECT file_id, language, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS l FROM d),
    c AS (SELECT file_id, language, term, count(*) AS tf FROM (SELECT file_id, language, unnest(l) AS term FROM g) GROUP BY ALL),
    v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY total DESC, term) AS rank FROM (
      SELECT language, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM c GROUP BY ALL HAVING count(*) >= 5)) WHERE rank <= 5000)"""
)


@query("vec_tokens", _BASE + " SELECT file_id, language, CAST(unnest(range(1, len(t) + 1)) AS INTEGER) AS pos, unnest(t) AS token FROM d")
def vec_tokens(spark, sf_dir):
    split = unnest(docs(spark, sf_dir), ["file_id", "language"], "tokens", "token", "at")
    return split.select("file_id", "language", (F.col("at") + 1).alias("pos"), "token")


@query("vec_ngrams", _BASE + " SELECT file_id, language, term, CAST(tf AS INTEGER) AS tf FROM c")
def vec_ngrams(spark, sf_dir):
    return unnest_structs(counted(spark, sf_dir), ["file_id", "language"], "counts")


@query("vec_vocab", _BASE + " SELECT language, term, df, total, CAST(rank AS INTEGER) AS rank FROM v")
def vec_vocab(spark, sf_dir):
    return vectors.vocabulary(counted(spark, sf_dir))


@query(
    "vec_tfidf",
    _BASE
    + """, w AS (SELECT file_id, c.language, term, tf, tf * (ln((1 + n) / CAST(1 + df AS DOUBLE)) + 1) AS raw FROM c JOIN v USING (language, term)
    JOIN (SELECT language, count(*) AS n FROM d GROUP BY language) USING (language))
    SELECT file_id, language, term, CAST(tf AS INTEGER) AS tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY file_id)), 7) AS weight FROM w""",
)
def vec_tfidf(spark, sf_dir):
    texts = counted(spark, sf_dir)
    vocab = vectors.with_idf(vectors.vocabulary(texts), texts)
    return vectors.tfidf(texts, vocab).withColumn("weight", F.round("weight", 7))
