"""Exact ranks, running sums and cuts without gathering all rows in one task.

A plain ``row_number() OVER (ORDER BY ..)`` sends a whole table to one task, and one partitioned by a
label sends half of it. Here keys are read as a few digits of 16 bits: rows are counted per digit
prefix (pre-aggregated before the shuffle), offsets are summed over those counts, and only rows that
share a prefix are ordered among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.session import materialise

DIGIT = 1 << 16

#: Most rows of a table that is sent to all executors.
SMALL = 10_000


def small_side(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """A table to join with a large one: written once, and sent to all executors when it has no more than ``limit``
    rows. Otherwise it is joined as the planner sees fit, which splits the rows of a hot key between tasks. Runs a job
    when it is called."""
    written = materialise(df, "small")
    return F.broadcast(written) if written.count() <= limit else written


def offsets_before(cells: DataFrame, digits: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Replace ``measures`` by ``<measure>_before``: their sums over all cells ahead in digit order.

    Each window holds the cells below one prefix, at most 65,536 of them.
    """
    *parents, last = digits
    ahead = Window.partitionBy(*parents).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    within = cells.select(
        *digits, *[F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"{m}_before") for m in measures]
    )
    if not parents:
        return within
    totals = cells.groupBy(*parents).agg(*[F.sum(m).alias(m) for m in measures])
    above = offsets_before(totals, parents, measures)
    above = above.select(*parents, *[F.col(f"{m}_before").alias(f"_{m}_above") for m in measures])
    joined = within.join(above, list(parents))
    return joined.select(
        *digits, *[(F.col(f"{m}_before") + F.col(f"_{m}_above")).alias(f"{m}_before") for m in measures]
    )


def key_digits(key: Column) -> dict[str, Column]:
    """Upper three digits of a 64-bit key, in its order."""
    return {
        "_d0": F.shiftright(key, 48),
        "_d1": F.shiftright(key, 32).bitwiseAND(DIGIT - 1),
        "_d2": F.shiftright(key, 16).bitwiseAND(DIGIT - 1),
    }


def with_row_number(df: DataFrame, key: str, out: str = "row_number") -> DataFrame:
    """Add the 1-based position of each row in the order of a unique whole-number key."""
    digits = key_digits(F.col(key).cast("bigint"))
    names = list(digits)
    marked = df.withColumns(digits)
    cells = marked.groupBy(*names).agg(F.count("*").alias("n"))
    before = offsets_before(cells, names, ["n"])
    inside = F.row_number().over(Window.partitionBy(*names).orderBy(key))
    ranked = marked.withColumn("_inside", inside).join(before, names)
    return ranked.withColumn(out, F.col("n_before") + F.col("_inside")).drop(*names, "_inside", "n_before")


def running_by_score(scores: DataFrame, score: str, measures: Sequence[str]) -> DataFrame:
    """Add ``<measure>_before``: sums over all rows of a higher score.

    ``scores`` holds one row per distinct score between 0 and 1, measures already summed.
    """
    scaled = (F.lit(1.0) - F.col(score)) * DIGIT
    first = F.least(F.floor(scaled), F.lit(DIGIT - 1))
    second = F.least(F.floor((scaled - first) * DIGIT), F.lit(DIGIT - 1))
    marked = scores.withColumns({"_d0": first, "_d1": second})
    names = ["_d0", "_d1"]
    cells = marked.groupBy(*names).agg(*[F.sum(m).alias(m) for m in measures])
    before = offsets_before(cells, names, measures)
    before = before.select(*names, *[F.col(f"{m}_before").alias(f"_{m}_ahead") for m in measures])
    ahead = Window.partitionBy(*names).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, -1)
    ranked = marked.withColumns({f"_{m}_in": F.coalesce(F.sum(m).over(ahead), F.lit(0)) for m in measures})
    return ranked.join(before, names).select(
        *scores.columns,
        *[(F.col(f"_{m}_ahead") + F.col(f"_{m}_in")).alias(f"{m}_before") for m in measures],
    )


def hash_cut(df: DataFrame, key: str, by: Sequence[str], need: Column, seed: str = "42") -> DataFrame:
    """Per group, the largest hash among its ``need`` smallest: columns ``by`` and ``cut``.

    ``need`` may use ``n``, the rows of the group. Groups that need no row are left out. A row
    belongs to the chosen ones when its :func:`row_hash` is not above the cut, which needs no
    shuffle of the table itself.
    """
    hashed = df.select(*by, row_hash(key, seed).alias("_hash")).withColumn("_cell", F.substring("_hash", 1, 4))
    cells = hashed.groupBy(*by, "_cell").agg(F.count("*").alias("_rows"))
    if by:
        sizes = cells.groupBy(*by).agg(F.sum("_rows").alias("n"))
        cells = cells.join(sizes, list(by))
    else:
        cells = cells.withColumn("n", F.sum("_rows").over(Window.partitionBy()))
    upto = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    running = cells.withColumn("_upto", F.sum("_rows").over(upto)).withColumn("_need", F.least(need, F.col("n")))
    edge = running.where("_upto - _rows < _need AND _need <= _upto").select(
        *by, "_cell", (F.col("_need") - F.col("_upto") + F.col("_rows")).alias("_rest")
    )
    # One cell per group is left to order: only rows of that cell are shuffled.
    inside = hashed.join(small_side(edge), [*by, "_cell"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*by, "_cell").orderBy("_hash"))
    )
    return inside.where("_rank = _rest").select(*by, F.col("_hash").alias("cut"))


def row_hash(key: str, seed: str = "42") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
