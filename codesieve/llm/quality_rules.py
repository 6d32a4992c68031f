"""Quality rules with cross-document line frequency, in column expressions only.

A document fails the base rules when it has too few words or repeats itself. Beyond them, its lines are
normalised and hashed; for each host the distinct documents per line are counted; a line that more than
``line_share`` of the host's documents hold, and at least ``line_docs`` of them, is taken out; a document
left with less than ``left_share`` of its words is depleted and rejected. ``judge`` gives the verdicts,
``keep_good`` the kept rows as they are, ``keep_cleaned`` the kept rows without the lines above the limits and, of
depleted documents, as many as it takes to hold each of those lines once.

Exact copies count as one document for the frequency of a line: a text copied a thousand times would
otherwise make all its own lines look like boilerplate.

The texts are read once: what is needed of them goes to a narrow table. Lines are reduced to one row per
host, line and text before they are counted, so a line that a third of the documents hold is pre-aggregated
in every task.

Defined results: a null text has no words and fails; a null host is a host of its own, shared with the empty
name; rows with the same or no id are judged one by one; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.store import Store, let

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

MIN_WORDS = 50
REPEATED_PERCENT = 50
LINE_SHARE = 0.10
LINE_DOCS = 20
LEFT_SHARE = 0.5


def repeated_words(words: Column, span: int = 3) -> Column:
    """Words inside windows of ``span`` words that the text holds twice or more.

    Windows are compared by 64-bit hashes. They are sorted only in texts that hold some window twice.
    """

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        added = lambda a, p: F.struct(
            (a["n"] + p + span - F.greatest(a["end"], p)).alias("n"), (p + span).alias("end")
        )
        return F.aggregate(F.sort_array(starts), zero, added)["n"]

    def twice(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))
        held = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return F.transform(held, lambda k: F.get(ordered, k)["p"])

    def counted(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
        several = let(F.sort_array(placed), lambda ordered: covered(twice(ordered)))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(several)

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - span),
            lambda p: F.xxhash64(*[F.get(hashes, p + i) for i in range(span)]),
        )

    several = let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), counted))
    return F.when(F.size(words) < span, 0).otherwise(several).cast("long")


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def tidy(line: Column) -> Column:
    """A line as it is counted: in lower case, its words with one space between."""
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def facts(docs: DataFrame) -> DataFrame:
    """What the rules need of each document, without its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_key"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), has_word).alias("lines"),
    )
    return split.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "host",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform(
            F.transform("lines", tidy),
            lambda line: F.struct(F.xxhash64(line).alias("line"), F.size(F.split(line, " ")).alias("n")),
        ).alias("lines"),
    )


def frequent_lines(lines: DataFrame, line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS) -> DataFrame:
    """Lines above the limits of their host, from rows of ``host, text_key, line``."""
    per_line = lines.select("host", "line", "text_key").distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    per_host = lines.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("n_host"))
    often = per_line.where(F.col("n") >= line_docs).join(per_host, "host")
    return often.where(F.col("n") > line_share * F.col("n_host")).select("host", "line")


def _verdicts(
    base: DataFrame,
    min_words: int = MIN_WORDS,
    repeated_percent: int = REPEATED_PERCENT,
    line_share: float = LINE_SHARE,
    line_docs: int = LINE_DOCS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """The verdicts of ``judge`` from the written ``facts``."""
    lines = base.select("row", "host", "text_key", F.explode("lines").alias("l")).select(
        "row", "host", "text_key", "l.line", "l.n"
    )
    taken = (
        lines.join(frequent_lines(lines, line_share, line_docs), ["host", "line"])
        .groupBy("row")
        .agg(F.sum("n").alias("n_line_words"), F.collect_set("line").alias("line_keys"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeated_percent * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_line_words") < left_share * F.col("n_words")
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (
        base.select("row", "doc_id", "text_key", "host", *measures)
        .join(taken, "row", "left")
        .withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)).cast("long"))
        .select(
            "doc_id",
            *measures,
            failed.alias("base_failed"),
            (~failed & ~depleted).alias("kept"),
            "n_line_words",
            depleted.alias("depleted"),
            "text_key",
            "host",
            "line_keys",
        )
    )


def judge(docs: DataFrame, **limits) -> DataFrame:
    """One row per document of ``doc_id, text, source``: measures, ``base_failed``, ``n_line_words`` and ``kept``.

    ``line_keys`` has the hashes of the document's lines above the limits, null if it holds none. Writes the measures to the
    shared folder when it is called.
    """
    return _verdicts(Store(docs.sparkSession, "quality").keep(facts(docs), "facts"), **limits)


def _same_document(docs: DataFrame, good: DataFrame) -> Column:
    return (
        docs["doc_id"].eqNullSafe(good["_id"])
        & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == good["_text"])
        & (F.coalesce(docs["source"], F.lit("")) == good["_host"])
    )


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    good = judge(docs, **limits).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("host").alias("_host")
    )
    return docs.join(good, _same_document(docs, good), "left_semi")


def without_lines(text: Column, keys: Column) -> Column:
    """``text`` without the lines whose hashes are in ``keys``; the other lines stay as they are."""
    gone = lambda line: F.array_contains(keys, F.xxhash64(tidy(line)))
    left = F.filter(F.split(text, "\n"), lambda line: ~(has_word(line) & gone(line)))
    return F.when(keys.isNull(), text).otherwise(F.array_join(left, "\n"))


def _last_holders(depleted: DataFrame) -> DataFrame:
    """Of the depleted documents, for each host and line above the limits those with the smallest text hash that hold it."""
    held = depleted.select("host", "text_key", F.explode("line_keys").alias("line"))
    first = held.groupBy("host", "line").agg(F.min("text_key").alias("text_key"))
    return depleted.join(first.select("host", "text_key").distinct(), ["host", "text_key"], "left_semi")


def keep_cleaned(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, their ``text`` without the lines above the limits.

    Near copies that fill more than the share of a host make all their lines frequent and each other depleted. So that their
    content does not vanish, every line that depletion would take away stays in one text that passes the base rules; such
    texts are returned whole. They are at most as many as the lines above the limits. Writes the verdicts to the shared folder.

    ``n_chars``, if there is one, becomes the length of what is left; other columns stay as they are.
    """
    store = Store(docs.sparkSession, "quality")
    columns = ["doc_id", "text_key", "host", "base_failed", "depleted", "kept", "line_keys"]
    judged = store.keep(_verdicts(store.keep(facts(docs), "facts"), **limits).select(*columns), "judged")
    store.drop("facts")
    identity = [F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("host").alias("_host")]
    none = F.array().cast("array<long>")
    stays = judged.where("kept").select(*identity, F.coalesce("line_keys", none).alias("keys"))
    whole = _last_holders(judged.where("depleted and not base_failed")).select(*identity, none.alias("keys"))
    # Rows with the same id, text and host have the same verdict and lines.
    good = stays.union(whole).groupBy("_id", "_text", "_host").agg(F.flatten(F.collect_set("keys")).alias("_keys"))
    keys = F.when(F.size("_keys") > 0, F.col("_keys"))
    new = {"text": without_lines(docs["text"], keys)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(keys.isNull(), docs["n_chars"]).otherwise(F.length(new["text"]).cast(docs.schema["n_chars"].dataType))
    met = docs.join(good, _same_document(docs, good))
    return met.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
