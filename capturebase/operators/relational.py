"""Operators that SQL dialects spell differently: latest row of a key, top one of each outer row, digests of key sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in ``order``; Spark limits the groups before the shuffle and after it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def join_latest(outer: DataFrame, inner: DataFrame, key: str, by: str) -> DataFrame:
    """Each outer row with the inner row of its key that has the largest ``by``, if any; never more rows than outer has."""
    top = inner.groupBy(key).agg(F.max_by(F.struct(*[c for c in inner.columns if c != key]), by).alias("_top"))
    return outer.join(top, key, "left").select(outer["*"], *[F.col(f"_top.{c}").alias(c) for c in inner.columns if c != key])


def key_digest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """For each group: the number of its distinct keys and the SHA-256 of their sorted list, one a line. A group is what one package may
    hold, which its ceiling bounds; a digest of everything at once would need one task for all keys."""
    listed = df.select(*by, *keys).distinct().groupBy(*by).agg(F.count("*").alias("n_keys"), F.array_sort(F.collect_list(F.struct(*keys))).alias("k"))
    return listed.select(*by, "n_keys", F.sha2(F.array_join(F.transform("k", lambda s: F.concat_ws(":", *[s[k].cast("string") for k in keys])), "\n"), 256).alias("keys_sha256"))


def replace_rows(current: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` with the rows of ``changed`` in place of those with the same keys."""
    return current.join(changed, keys, "left_anti").unionByName(changed)


def uncommitted(rows: DataFrame, committed: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` no entry of ``committed`` has, null keys included: what a loader that goes on deletes first."""
    return rows.join(committed.select(key).distinct(), key, "left_anti")


def without_uncommitted(rows: DataFrame, committed: DataFrame, key: str, parts: dict[str, tuple[DataFrame, list[str]]] | None = None) -> dict[str, DataFrame]:
    """``rows`` without the uncommitted ones, and each of ``parts`` (rows of another table, and the keys of what they belong to) without
    those of rows that go."""
    gone = uncommitted(rows, committed, key)
    kept = {"rows": rows.join(committed.select(key).distinct(), key, "left_semi").select(*rows.columns)}
    return kept | {name: part.join(gone.select(*keys).distinct(), keys, "left_anti") for name, (part, keys) in (parts or {}).items()}


def top_categories(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The most frequent values, ties by name."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(n)
