"""A log of what is new in a tree: each version lists files that no earlier one has."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..sources import crawl
from ..storage import names, publish, remove


def versions(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(n[2:]) for n in names(spark, log) if n.startswith("v="))


def read(spark: SparkSession, log: str) -> DataFrame:
    found = [f"{log.rstrip('/')}/v={n:010d}" for n in versions(spark, log)]
    return spark.read.schema(crawl.ENTRIES).parquet(*found) if found else spark.createDataFrame([], crawl.ENTRIES)


def append(spark: SparkSession, folder: str, log: str, part: int = crawl.PART) -> int:
    """List ``folder`` and append the files whose path, length and time are in no version; the newest version's number.

    A version is renamed to its number when it is whole and never changes, so a
    stream that reads one again reads the same files. A file that was written
    anew arrives anew. If another writer takes the number, what it lists counts
    as known and the rest goes to the next number.
    """
    log, key = log.rstrip("/"), ["path", "length", "modified"]
    listed = storage.written(crawl.entries(spark, folder), "arrivals")
    while True:
        numbers = versions(spark, log)
        newest = numbers[-1] if numbers else 0
        fresh = listed.join(read(spark, log).select(*key), key, "left_anti").select(*listed.columns).selectExpr("*", "false AS is_folder")
        if not fresh.limit(1).count():
            return newest
        draft = f"{log}/.draft-{uuid.uuid4().hex}"
        fresh.write.option("maxRecordsPerFile", part).option("compression", "zstd").parquet(draft)
        if publish(spark, draft, f"{log}/v={newest + 1:010d}"):
            return newest + 1
        remove(spark, draft)
