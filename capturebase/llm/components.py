"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import Store


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(store: Store, edges: DataFrame, name: str) -> DataFrame:
    """doc and root, the smallest doc that it is linked to, for every doc of ``edges`` (columns a, b) that isn't its own root."""
    now = store.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}0")
    mark, k = _mark(now), 0
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        #: Large star: each larger neighbour goes to the smallest of the neighbourhood.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        #: Small star: so do the smaller neighbours.
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        k += 1
        now = store.put(small, f"{name}{k}")
        before, mark = mark, _mark(now)
        store.drop(f"{name}{k - 1}")
        if mark == before:
            break
    return now.select(F.col("u").alias("doc"), F.col("v").alias("root"))
