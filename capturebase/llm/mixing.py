"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source is due target / source_size copies. Whole copies are taken outright; the fractions are paired, and each pair
passes probability mass from one document to the other at random until one is 0 or 1. Documents meet from large to small, so that what is
passed hardly changes the words taken. Documents are dealt to buckets by a hash of doc_id; every bucket leaves one residual fraction at
most, and a tree of further groupings combines those until one is left for each source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import Store, small_side

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 4096
FAN_IN = 64


def size_of(text: str) -> Column:
    """Words of the column, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size."""
    return docs.select("doc_id", "source", size_of("text").alias("size"))


def ranked(store: Store, by: DataFrame) -> DataFrame:
    """``by`` (one row a source) with k, the place of each source in order of code points, null last. Sources are sorted over all tasks; only
    the number of rows of each task meet in one place."""
    dealt = by.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
    at = F.monotonically_increasing_id()
    placed = store.put(dealt.select("*", F.shiftright(at, 33).cast("int").alias("task"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("inner")), "placed")
    before, total = {}, 0
    for r in sorted(placed.groupBy("task").count().collect()):  # one row a task
        before[r.task], total = total, total + r["count"]
    starts = by.sparkSession.createDataFrame(list(before.items()), "task int, before long")
    return placed.join(F.broadcast(starts), "task").withColumn("k", F.col("before") + F.col("inner")).drop("task", "inner", "before")


def targets(store: Store, sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, n, source_size, target: shares by weight, none above ``most`` times its source.

    Sources above their cap stay at it, and what that leaves is shared by weight among the others, again and again until none is above. A
    round is one sum over all sources; a source that is capped once stays so, as the others' rate only grows.
    """
    by = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    named = ranked(store, by)
    w = F.get(F.array(*map(F.lit, weights)), F.pmod("k", F.lit(len(weights))).cast("int")).cast("double")
    named = store.put(named.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most))), "named")
    due = share * (named.agg(F.sum("source_size")).first()[0] or 0)
    rate, n_capped = 0.0, -1
    while True:
        above = F.col("w") * F.lit(rate) > F.col("cap")
        capped, caps, weight = named.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)), F.sum(F.when(~above, F.col("w")))).first()
        if capped == n_capped or not weight:
            break
        rate, n_capped = max(0.0, due - most * caps) / weight, capped
    return named.select("source", "n", "source_size", F.when(F.col("w") * F.lit(rate) > F.col("cap"), F.col("cap")).otherwise(F.col("w") * F.lit(rate)).alias("target"))


def _coin(*what: object) -> float:
    """In [0, 1), from the names of what meets; no state, so reruns agree."""
    return int.from_bytes(hashlib.blake2b(repr(what).encode(), digest_size=7).digest(), "big") / (1 << 56)


def pivot(ids: list, p: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Passes mass along the order given; the probabilities after it, and where the one fraction left is, else -1."""
    p, held = p.astype(float).copy(), -1
    for i in range(len(p)):
        if p[i] <= 1e-12 or p[i] >= 1 - 1e-12:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = p[held], p[i]
        u = _coin(seed, ids[held], ids[i])
        if a + b < 1:
            win = u < a / (a + b)
            p[held], p[i] = (a + b, 0.0) if win else (0.0, a + b)
            held = held if win else i
        else:
            rest = a + b - 1
            win = u < (1 - b) / (2 - a - b) if a + b < 2 else True
            p[held], p[i] = (1.0, rest) if win else (rest, 1.0)
            held = i if win else held
        if p[held] <= 1e-12 or p[held] >= 1 - 1e-12:
            p[held] = round(p[held])
            held = -1
    return p, held


def _round(seed: int, last: bool):
    def step(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h", "doc_id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        ids = [None if pd.isna(x) else int(x) for x in rows.doc_id]
        p, held = pivot(ids, rows.p.to_numpy(), seed)
        if last and held >= 0:
            p[held] = float(_coin(seed, "last", ids[held]) < p[held])
            held = -1
        open_ = np.zeros(len(p), bool)
        if held >= 0:
            open_[held] = True
        return rows.assign(p=p, open=open_)

    return step


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``.

    copies is 0, 1 or 2 and taken = copies x size. A null text has size 0; a null source is a source of its own, last; a source without
    words takes nothing. Rows with the same doc_id are rounded apart. An empty table gives no rows. Only ids, sources and sizes move.
    """
    spark = docs.sparkSession
    store = Store(spark)
    sized = store.put(sizes(docs).withColumn("h", F.xxhash64("doc_id", F.lit(seed))), "sized")
    due = targets(store, sized, weights, share)
    due = due.withColumn("due", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).withColumn("buckets", F.ceil(F.col("n") / bucket_rows))
    due = store.put(due, "due")
    wide = due.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) * 2 + 128)).first()[0] or 0
    rows = sized.withColumn("s", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    rows = rows.join(small_side(due.select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), "source_size", "target", "due", "buckets"), wide), ["s", "none"])
    rows = rows.withColumn("whole", F.floor(F.col("due") + 1e-12).cast("long"))
    rows = rows.select("doc_id", "source", "s", "none", "size", "source_size", "target", "h", "whole", F.greatest(F.col("due") - F.col("whole"), F.lit(0.0)).alias("p"), F.pmod("h", F.col("buckets")).alias("bucket"))
    schema = f"{rows._jdf.schema().toDDL()}, open boolean"
    done: list[DataFrame] = []
    top = due.agg(F.max("buckets")).first()[0] or 1
    level = 0
    while True:
        last = top == 1
        out = store.put(rows.groupBy("s", "none", "bucket").applyInPandas(_round(seed + level, last), schema), f"round{level}")
        done.append(out.where(~F.col("open")))
        if last:
            break
        rows = out.where("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        top, level = -(-top // FAN_IN), level + 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    copies = F.col("whole") + F.round("p").cast("long")
    return every.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def draw(docs: DataFrame, **options: object) -> DataFrame:
    """The columns of ``docs`` plus size, source_size, target, copies and taken for every row; ``options`` are those of ``mix``.

    Rows that agree in doc_id, source and size are alike to ``mix``; their copies are dealt to them in order of a hash of the text. Columns
    of ``docs`` named as a result are replaced. Each row moves once, to meet its copies.
    """
    names = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c.lower() not in names]
    own = [f"__{c}" for c in ("id", "no_id", "source", "no_source", "size")]

    def keyed(df: DataFrame, size: Column) -> DataFrame:
        parts = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull(), size)
        return df.withColumns(dict(zip(own, parts, strict=True)))

    dealt = keyed(mix(docs, **options), F.col("size")).groupBy(*own).agg(F.sort_array(F.collect_list("copies")).alias("__copies"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    rows = keyed(docs.select(*kept), size_of("text")).join(dealt, own)
    alone = Window.partitionBy(*own).orderBy(F.xxhash64("text"))
    copies = F.get("__copies", F.row_number().over(alone) - 1)
    return rows.select(*kept, F.col("__size").alias("size"), "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))
