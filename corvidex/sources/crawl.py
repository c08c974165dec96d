"""Listings of whole trees, level by level, in tasks.

The folders of a level are the rows of a table and are dealt to tasks; what they
hold is written, and its folders are the next level.  The driver learns only
whether there is another level.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .. import storage
from . import stores

ENTRIES = "path string, name string, extension string, length long, modified long, is_folder boolean"
_ARROW = pa.schema([("path", pa.string()), ("name", pa.string()), ("extension", pa.string()), ("length", pa.int64()), ("modified", pa.int64()), ("is_folder", pa.bool_())])
#: Entries in a part of a listing, at most; a task reads the files of one part.
PART = 4096
#: Rows that a listing task holds at once.
_BATCH = 10_000


def _levels(spark: SparkSession, root: str, part: int) -> list[DataFrame]:
    root = stores.local_name(root.rstrip("/") or "/")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, rows = stores.of(root), []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for x in store.children(folder):
                    rows.append((x.path, x.name, "" if x.is_folder else stores.suffix(x.name), x.length, x.modified, x.is_folder))
                    if len(rows) >= _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    level, found = spark.createDataFrame([(root,)], "path string"), []
    while not found or level.limit(1).count():
        tasks = spark.sparkContext.defaultParallelism if found else 1
        found.append(storage.written(level.repartition(tasks).mapInArrow(listed, ENTRIES), "listing", part))
        level = found[-1].where("is_folder").select("path")
    return found


def entries(spark: SparkSession, root: str) -> DataFrame:
    """``path, name, extension, length, modified`` of every regular file below ``root``, hidden and empty ones too; nothing is opened."""
    return reduce(DataFrame.unionByName, _levels(spark, root, 0)).where("NOT is_folder").drop("is_folder")


def parts(spark: SparkSession, root: str, part: int = PART) -> list[str]:
    """Folders with a listing of ``root`` in parts of ``part`` entries, one folder for each level of the tree."""
    return [level._written_to for level in _levels(spark, root, part)]
