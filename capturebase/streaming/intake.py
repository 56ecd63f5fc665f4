"""An extension: a folder that archives are dropped into, as a stream. Each archive goes through the same commit as any other load, so that
a batch that comes again, after a crash, is no work."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from capturebase.sources import remote
from capturebase.sources.ledger import Ledger


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of archives as they come; their contents are not read here."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.tar.gz").option("recursiveFileLookup", "true").load(folder).select("path")


def intake(ledger: Ledger, folder: str, checkpoint: str, name_of: Callable[[str], str], on_error: Callable[[str, Exception], None] | None = None) -> StreamingQuery:
    """Loads all that has come to ``folder`` and ends. ``name_of`` gives the package of a path. An archive that can't be loaded is told to
    ``on_error``, and those after it go on; without that, it stops the stream."""

    def batch(df: DataFrame, _: int) -> None:
        for path in sorted(unquote(urlparse(r.path).path) for r in df.collect()):  # names of files in one batch
            try:
                ledger.load(name_of(path), remote.sha256(path), path)
            except Exception as e:
                if on_error is None:
                    raise
                on_error(path, e)

    return arrivals(ledger.spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
