"""Connected components against a plain union-find, and what written tables leave behind."""

import random
import time

import pytest
from pyspark.sql import functions as F

from codesieve.llm.components import components
from codesieve.llm.store import CLEANUP, Store


class Counted(Store):
    """Remembers the tables written."""

    def __init__(self, spark):
        super().__init__(spark, "counted")
        self.kept = []

    def keep(self, df, table):
        self.kept.append(table)
        return super().keep(df, table)


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}


def plain(links):
    least = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            least.setdefault(a, a)
            least.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in least and b in least and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def found(spark, links):
    store = Counted(spark)
    rows = components(spark.createDataFrame(links, "a long, b long"), store, "c").collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.label for r in rows}, store


RANDOM = random.Random(5)
SHAPES = {
    "none": [],
    "loops and nulls": [(3, 3), (None, 1), (2, None), (None, None), (5, 4), (5, 4), (4, 5)],
    "chain": [(k, k + 1) for k in range(40)],
    "mixed": [(RANDOM.randrange(90), RANDOM.randrange(90)) for _ in range(70)] + [(-7, 100 + k) for k in range(50)],
}


@pytest.mark.parametrize("links", SHAPES.values(), ids=SHAPES)
def test_components_equal_a_plain_union(spark, links):
    got, _ = found(spark, links)
    assert got == plain(links)


def test_stars_need_no_round(spark):
    links = [(1, k) for k in range(2, 60)] + [(100, 101)]
    got, store = found(spark, links)
    assert got == plain(links)
    assert sum("around" not in t for t in store.kept) == 1


@pytest.mark.parametrize("setting", [None, "false"])
def test_a_kept_table_leaves_no_shuffle_files(spark, setting):
    if setting is not None:
        spark.conf.set(CLEANUP, setting)
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    again = rows.join(rows.withColumnRenamed("count", "other"), "k")
    store = Store(spark, "left")
    tables = [store.keep(again, name) for name in ("once", "twice")]
    assert spark.conf.get(CLEANUP, None) == setting
    spark.conf.unset(CLEANUP)
    for _ in range(50):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert [t.count() for t in tables] == [700, 700]
