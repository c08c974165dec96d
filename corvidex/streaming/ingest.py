"""Triage of new files as they arrive."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import content
from ..operators import manifest, triage
from ..sources import listing
from . import arrivals

#: Parts of one content's state: however many paths it has, they meet in several tasks.
SALT = 16

_FOUND = "file_hash string, path string, lane string, length long"


def _last_path(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Of one content the last path in component order so far; a row goes out only if it changes."""
    known = state.get[0] if state.exists else None
    best, row = known, None
    for pdf in batches:
        for path, lane, length in zip(pdf["path"], pdf["lane"], pdf["length"], strict=True):
            if best is None or (path.split("/"), path) > (best.split("/"), best):
                best, row = path, (lane, length)
    if row:
        state.update((best,))
        yield pd.DataFrame({"file_hash": [key[0]], "path": [best], "lane": [row[0]], "length": [row[1]]})


def identities(files: DataFrame) -> DataFrame:
    """A stream of ``file_hash, path, lane, length``: what is new about the contents of a stream of files. Unreadable files have none."""
    hashed = triage.assign(files.where("file_hash IS NOT NULL")).select("file_hash", F.pmod(F.xxhash64("path"), F.lit(SALT)).alias("salt"), "path", "lane", "length")
    return hashed.groupBy("file_hash", "salt").applyInPandasWithState(_last_path, _FOUND, "path string", "update", GroupStateTimeout.NoTimeout)


def entries(found: DataFrame, known: DataFrame) -> DataFrame:
    """Manifest rows of a batch of ``identities``: the last path of the batch and of ``known``; a known hash keeps its status."""
    stored = known.select("file_hash", F.col("path").alias("__path"), F.col("lane").alias("__lane"), F.col("status").alias("__status"))
    joined = triage.last_by_path(found).join(stored, "file_hash", "left")
    later = F.coalesce(F.struct(F.split("__path", "/"), F.col("__path")) > F.struct(F.split("path", "/"), F.col("path")), F.lit(False))
    pick = lambda c: F.when(later, F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    status = F.when(F.col("__status") == "processed", "processed").otherwise("pending").alias("status")
    return joined.select("file_hash", pick("path"), pick("lane"), content.size_mb(F.col("length")).alias("size_mb"), F.col("length").alias("n_bytes"), status, F.current_timestamp().cast("timestamp_ntz").alias("triaged_at"))


def start(spark: SparkSession, folder: str, root: str, checkpoint: str, glob: str = "*") -> StreamingQuery:
    """Triage what is new below ``folder`` into the manifest at ``root``, then stop.

    New files are appended to a log below ``checkpoint``, the stream's offsets
    are its versions, and contents are its keyed state: a content that is known
    under a later path is no news. A batch that runs again after a crash reads
    the same files and sets the same columns, so the manifest is the same.
    Every regular file counts, hidden and empty ones too. After a crash the first
    run ends with the batch that is run again; ``run`` goes on to newer files.
    """
    log = f"{checkpoint.rstrip('/')}/arrivals"
    arrivals.append(spark, folder, log)
    listing.register(spark)

    def batch(found: DataFrame, _: int) -> None:
        manifest.commit(entries(found, manifest.load(found.sparkSession, root)), root, "triage")

    files = spark.readStream.format("corpus_arrivals").options(log=log, glob=glob).schema(listing.columns_schema(triage.COLUMNS)).load()
    return identities(files).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(availableNow=True).start()


def run(spark: SparkSession, folder: str, root: str, checkpoint: str, glob: str = "*") -> int:
    """As ``start``, to the newest version of the log, which is returned."""
    while True:
        query = start(spark, folder, root, checkpoint, glob)
        query.awaitTermination()
        newest = max(arrivals.versions(spark, f"{checkpoint.rstrip('/')}/arrivals"), default=0)
        done = query.lastProgress
        if not done or not done.numInputRows or int(re.search(r"version\D+(\d+)", str(done.sources[0].endOffset))[1]) >= newest:
            return newest
