"""Connected components of a table of links, by alternating stars.

Each round points the larger neighbours of every node, then the smaller ones, at the smallest node known there,
until every component is a star around its smallest node. Only minima per node are gathered; the links of a node with
very many neighbours are never brought into one task but split by the skew handling of the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.store import Store


def _point(edges: DataFrame, own_too: bool) -> DataFrame:
    """For links ``u, v``: every ``v`` pointed at the smallest node around ``u``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    pointed = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own_too:
        pointed = pointed.unionByName(least.select("u", F.col("m").alias("v")))
    return pointed.where("u > v").distinct()


def _around(edges: DataFrame) -> DataFrame:
    """For every node of links ``u > v``: the smallest node ``m`` around it, itself included; whether it is ``loose``, that is
    has two smaller neighbours, or a smaller and a larger one, which no node of a star has."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smaller = F.count(F.when(F.col("v") < F.col("u"), True))
    loose = (smaller > 1) | ((smaller == 1) & (F.count("*") > 1))
    return both.groupBy("u").agg(F.min("v").alias("m"), loose.alias("loose")).withColumn("m", F.least("u", "m"))


def components(links: DataFrame, store: Store, name: str) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``): the smallest node reachable. Runs jobs until all are stars."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, turn = store.keep(edges, f"{name}-0"), 0
    while True:
        around = store.keep(_around(edges), f"{name}-around-{turn}")
        if not around.agg(F.max("loose")).first()[0]:
            break
        turn += 1
        least = around.select(F.col("u").alias("v"), "m")
        larger = edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        newer = store.keep(_point(larger, own_too=True), f"{name}-{turn}")
        for table in (f"{name}-{turn - 1}", f"{name}-around-{turn - 1}"):
            store.drop(table)
        edges = newer
    store.drop(f"{name}-around-{turn}")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
