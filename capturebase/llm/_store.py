"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturebase.sources.shared import shared_dir


#: What a side may take in memory to be sent to all; beyond it Spark picks the join.
BROADCAST_BYTES = 16 << 20


BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Makes Arrow batches of at most BATCH_ROWS texts from here on, as both sides of a Python worker hold a whole batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def small_side(df: DataFrame, size: int) -> DataFrame:
    """``df`` marked to be sent to all if its ``size``, an upper bound in bytes that the caller has counted, is small."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


class Store:
    """Writes tables that cut lineage: a lost executor costs a reread, not a recomputation. They stay as long as results may be read from them;
    whoever has written a result elsewhere may ``sweep`` what was opened for it."""

    opened: list[Store] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, shared_dir(spark)
        Store.opened.append(self)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @classmethod
    def sweep(cls, since: int) -> None:
        """Deletes the tables of all but the first ``since`` that were opened."""
        for store in cls.opened[since:]:
            store.drop()
        del cls.opened[since:]


def first_by_hash(rows: DataFrame, key: str, seed: int, n: int) -> list:
    """About the first ``n`` rows by a hash of ``key``, in that order: only hashes meet before the texts of the chosen are fetched."""
    hashed = rows.withColumn("h", F.xxhash64(key, F.lit(seed)))
    last = hashed.select("h").orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if last is None:
        return []
    return sorted(hashed.where(F.col("h") <= last).limit(n).collect(), key=lambda r: (r.h, str(r)))
