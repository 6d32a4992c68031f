"""Temperature mixing of sources, realised as permutations in blocks of a token budget.

A source with share ``p`` of the tokens gets weight ``p ** a`` over the sum of these. The exponent is found by
bisection: the smallest one in 0 to 1 at which no source is repeated more than ``max_epochs`` times, or the largest
one whose weights reach an entropy. Four halvings are worked out at a time in one aggregate over the table of sources,
so neither the sources nor their weights pass through the driver.

The budget is what it takes to see every document ``min_epochs`` times (or a number of tokens); each source's quota
is its weight of it. A source's stream is one seeded permutation of its documents after the other, cut at its quota.
The streams run side by side: block ``b`` holds of each source the next ``weight * block_tokens`` tokens, and is
permuted as a whole. So every block shows the target weights, up to the length of a document.

Positions in a permutation are running sums. They are taken within cells of about ``CELL_ROWS`` documents (ranges of
the random key) and over the cells, never over a whole source. Weights are rounded to parts in 10^9 before use, so that
all later arithmetic is in whole numbers.

Defined results: tokens are words; a null source counts as the empty name; rows with the same id, text and source move
together, their number is in ``copies``; units without a token are seen once, in epoch 0 and a block drawn by hash, whatever
the weight of their source; a source without any token has weight 0; an empty table has no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.store import Store

WORDS = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 2.0
MIN_EPOCHS = 1
BLOCK_TOKENS = 1 << 20
CELL_ROWS = 1000
SEED = 20240
PARTS = 10**9
ROUNDS = 12
POINTS = 15


def units(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text_key, copies, n_tokens`` of ``docs`` (``doc_id, text, source``)."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(WORDS)).cast("long")
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.xxhash64(text).alias("text_key"), words.alias("words")
    )
    return rows.groupBy("doc_id", "source", "text_key").agg(
        F.count("*").alias("copies"), F.sum("words").alias("n_tokens")
    )


def _bisect(shares: DataFrame, good: Column, rising: bool) -> float:
    """The edge in 0 to 1 between exponents for which ``good`` holds and not.

    ``good`` is over ``z`` (sum of ``p ** a``), ``e`` (sum of ``p ** a * ln p``), ``least`` (smallest ``p``) and ``a``.
    ``rising``: it holds from the edge on; otherwise up to it.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / (POINTS + 1)
        grid = F.array(*[F.lit(low + step * k) for k in range(POINTS + 2)])
        at = shares.select("p", F.explode(grid).alias("a"))
        power = F.pow("p", "a")
        sums = at.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("e"), F.min("p").alias("least"))
        marks = sorted((row["a"], row["ok"]) for row in sums.select("a", good.alias("ok")).collect())
        if not marks:
            return 1.0
        holds = [a for a, ok in marks if ok]
        if not holds:
            return 1.0 if rising else 0.0
        if rising:
            high = min(holds)
            low = max((a for a, ok in marks if a < high), default=high)
        else:
            low = max(holds)
            high = min((a for a, ok in marks if a > low), default=low)
        if low == high:
            break
    return high if rising else low


def weights(
    sources: DataFrame,
    max_epochs: float | None = MAX_EPOCHS,
    entropy: float | None = None,
    min_epochs: int = MIN_EPOCHS,
    budget: int | None = None,
) -> tuple[DataFrame, float, int]:
    """Sources (``source, n_tokens, n_units``) with ``weight`` in parts of 10^9 and ``quota``; the exponent; the budget.

    With ``entropy`` (in nats) the exponent is the largest that reaches it, otherwise ``max_epochs`` rules.
    """
    sources = sources.where("n_tokens > 0")
    total = sources.agg(F.sum("n_tokens")).first()[0] or 0
    shares = sources.select((F.col("n_tokens") / F.lit(float(total))).alias("p"))
    if entropy is not None:
        reached = F.log("z") - F.col("a") * F.col("e") / F.col("z") >= entropy
        exponent = _bisect(shares, reached, rising=False)
    else:
        # A source is seen p ** (a - 1) times as often as its share; the largest is seen least.
        rate = F.pow("least", F.col("a") - 1) / F.col("z")
        if budget is not None:
            epochs = rate * (budget / max(1, total))
        else:
            most = shares.agg(F.max("p")).first()[0] or 1.0
            epochs = min_epochs * F.pow(F.col("least") / F.lit(most), F.col("a") - 1)
        exponent = _bisect(shares, epochs <= max_epochs, rising=True)
    power = F.pow(F.col("n_tokens") / F.lit(float(total)), F.lit(exponent))
    sum_ = sources.agg(F.sum(power)).first()[0] or 1.0
    weighted = sources.withColumn("weight", F.greatest(F.lit(1), F.round(power / F.lit(sum_) * PARTS)).cast("long"))
    if budget is None:
        whole = F.col("n_tokens").cast("decimal(38,0)") * (PARTS * min_epochs) / F.col("weight")
        budget = int(weighted.agg(F.max(F.ceil(whole))).first()[0] or 0)
    quota = F.floor(F.col("weight").cast("decimal(38,0)") * budget / PARTS).cast("long")
    return weighted.withColumn("quota", quota), exponent, budget


def mix(
    docs: DataFrame,
    max_epochs: float | None = MAX_EPOCHS,
    entropy: float | None = None,
    min_epochs: int = MIN_EPOCHS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """The mixture of ``docs`` (``doc_id, text, source``): one row per time a unit is seen, with its place.

    ``doc_id, source, text_key, copies, n_tokens, epoch, block, slot``. Writes the units and the weights to the shared
    folder when it is called.
    """
    store = Store(docs.sparkSession, "mixing")
    seen = store.keep(units(docs), "units")
    sources = store.keep(
        seen.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_units")), "sources"
    )
    weighted, _, tokens = weights(sources, max_epochs, entropy, min_epochs, budget)
    weighted = store.keep(weighted, "weights")
    plan = weighted.select(
        "source",
        "weight",
        "quota",
        F.col("n_tokens").alias("available"),
        F.ceil(F.col("n_units") / CELL_ROWS).cast("long").alias("cells"),
    )
    last = F.floor((F.col("quota") - 1) / F.col("available"))
    turns = seen.where("n_tokens > 0").join(plan, "source").where("quota > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("epoch"))
    key = F.xxhash64(F.lit(seed), "source", "epoch", "doc_id", "text_key").bitwiseAND(F.lit((1 << 62) - 1))
    drawn = turns.withColumn("key", key).withColumn("cell", F.floor(F.col("key") / F.ceil(F.lit(1 << 62) / F.col("cells"))))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    cells = drawn.groupBy("source", "epoch", "cell").agg(F.sum("n_tokens").alias("n"))
    above = cells.select(
        "source", "epoch", "cell", F.coalesce(F.sum("n").over(before("source", "epoch").orderBy("cell")), F.lit(0)).alias("above")
    )
    within = F.coalesce(F.sum("n_tokens").over(before("source", "epoch", "cell").orderBy("key", "doc_id", "text_key")), F.lit(0))
    placed = drawn.join(above, ["source", "epoch", "cell"]).withColumn(
        "start", F.col("epoch") * F.col("available") + F.col("above") + within
    )
    block = F.floor(F.col("start").cast("decimal(38,0)") * PARTS / (F.col("weight").cast("decimal(38,0)") * block_tokens))
    unit = ["doc_id", "source", "text_key", "copies", "n_tokens", "epoch"]
    taken = placed.where("start < quota").withColumn("block", block.cast("long")).select(*unit, "block")
    spread = F.pmod(F.xxhash64(F.lit(seed), "source", "doc_id", "text_key"), F.lit(max(1, -(-tokens // block_tokens))))
    bare = seen.where("n_tokens = 0").withColumn("epoch", F.lit(0).cast("long")).select(*unit, spread.alias("block"))
    taken = taken.unionByName(bare)
    draw = F.xxhash64(F.lit(seed + 1), "block", "doc_id", "text_key", "epoch")
    order = Window.partitionBy("block").orderBy(draw, "doc_id", "text_key", "source", "epoch")
    return taken.select(
        *unit, "block", (F.row_number().over(order) - 1).cast("long").alias("slot")
    )


def mixed_rows(docs: DataFrame, **target) -> DataFrame:
    """The rows of ``docs`` as often as the mixture holds them, with their columns."""
    often = mix(docs, **target).groupBy("doc_id", "source", "text_key").agg(F.count("*").cast("int").alias("_times"))
    often = often.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_key").alias("_key"), "_times")
    same = (
        docs["doc_id"].eqNullSafe(often["_id"])
        & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == often["_key"])
        & (F.coalesce(docs["source"], F.lit("")) == often["_source"])
    )
    met = docs.join(often, same).withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return met.select(*[docs[c] for c in docs.columns])
