"""All files below a folder, with what triage and inventory need of each.

Spark's own ``binaryFile`` format leaves out empty files and names that start
with a dot or an underscore, and reads whole contents for a few leading bytes.
This source yields every regular file of a listing (``crawl``).  Filters on
names, paths, extensions, lengths and times are applied to the listing, and only
columns that are asked for are read: a file that no filter lets through isn't
opened, and one is hashed only for its hash.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from .. import rules, schemas
from ..functions import paths
from . import crawl, stores

#: Columns that the listing has, and those for which a file is opened.
LISTED = ("path", "name", "extension", "length", "modified")
OPENED = ("header", "sample", "file_hash", "error")
_TYPES = {"path": pa.string(), "name": pa.string(), "extension": pa.string(), "length": pa.int64(), "modified": pa.timestamp("us", "UTC"), "header": pa.binary(), "sample": pa.binary(), "file_hash": pa.string(), "error": pa.string()}
#: Files in a batch.
_BATCH = 256

_TESTS = {
    ds.EqualTo: lambda x, v: x == v, ds.EqualNullSafe: lambda x, v: x == v, ds.In: lambda x, v: x in v, ds.GreaterThan: lambda x, v: x > v, ds.GreaterThanOrEqual: lambda x, v: x >= v,
    ds.LessThan: lambda x, v: x < v, ds.LessThanOrEqual: lambda x, v: x <= v, ds.StringStartsWith: str.startswith, ds.StringEndsWith: str.endswith, ds.StringContains: lambda x, v: v in x,
}


def _test(f: ds.Filter):
    """``(column, test)`` of a filter that the listing alone decides, else None. No column of the listing is null."""
    if isinstance(f, ds.Not):
        inner = _test(f.child)
        return inner and (inner[0], lambda x, test=inner[1]: not test(x))
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in LISTED:
        return None
    if isinstance(f, ds.IsNotNull):
        return f.attribute[0], lambda x: True
    # Times differ in precision between the listing and Spark, so Spark compares them.
    if type(f) not in _TESTS or f.value is None or f.attribute[0] == "modified":
        return None
    return f.attribute[0], lambda x, test=_TESTS[type(f)], v=f.value: test(x, v)


class _Part(ds.InputPartition):
    def __init__(self, path: str):
        self.path = path


def _parts(folders: list[str]) -> list[_Part]:
    found = []
    for folder in map(stores.local_name, folders):
        found += [_Part(x.path) for x in stores.of(folder).children(folder) if x.name.endswith(".parquet")]
    return sorted(found, key=lambda p: p.path)


class _Files:
    """Rows of listed files, in the columns of ``schema``."""

    def __init__(self, options: dict[str, str], schema):
        self.glob = options.get("glob", "*")
        self.header = int(options.get("headerBytes", rules.HEADER_BYTES))
        self.sample = int(options.get("sampleBytes", rules.SAMPLE_BYTES))
        self.columns = schema.names
        self.tests: list = []

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        at = stores.of(partition.path)
        with at.open(partition.path) as raw:
            table = pq.read_table(pa.BufferReader(raw.read()), columns=[*LISTED, "is_folder"])
        rows: list[dict] = []
        for entry in (x for b in table.to_batches(_BATCH) for x in b.to_pylist()):
            if entry["is_folder"] or not fnmatch.fnmatchcase(entry["name"], self.glob) or not all(test(entry[c]) for c, test in self.tests):
                continue
            entry["modified"] = datetime.fromtimestamp(entry["modified"] / 1e9, UTC)
            if any(c in OPENED for c in self.columns):
                entry |= self.opened(entry["path"])
            rows.append(entry)
            if len(rows) >= _BATCH:
                yield self.batch(rows)
                rows = []
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], _TYPES[c]) for c in self.columns})

    def opened(self, path: str) -> dict:
        none = dict.fromkeys(OPENED)
        most = max(self.header * ("header" in self.columns), self.sample * ("sample" in self.columns), 1)
        try:
            with stores.of(path).open(path) as f:
                start, digest = f.read(most), None
                if "file_hash" in self.columns:
                    hasher = hashlib.sha256(start)
                    while block := f.read(1 << 20):
                        hasher.update(block)
                    digest = hasher.hexdigest()
            return {"header": start[: self.header], "sample": start[: self.sample], "file_hash": digest, "error": ""}
        except PermissionError:
            return none | {"error": "Permission denied"}
        except OSError as e:
            return none | {"error": str(e)}


class _Reader(_Files, ds.DataSourceReader):
    def __init__(self, options: dict[str, str], schema):
        super().__init__(options, schema)
        self.folders = options["listing"].split(",")

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            if found := _test(f):
                self.tests.append(found)
            else:
                yield f

    def partitions(self) -> list[_Part]:
        return _parts(self.folders) or [_Part(os.devnull)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition.path == os.devnull else super().read(partition)


class CorpusFiles(ds.DataSource):
    """``spark.read.format("corpus_files")``; options listing, glob, headerBytes, sampleBytes; a schema of some columns reads only these."""

    @classmethod
    def name(cls) -> str:
        return "corpus_files"

    def schema(self) -> str:
        return schemas.FILES

    def reader(self, schema) -> ds.DataSourceReader:
        return _Reader(self.options, schema)


# --- arrivals ---------------------------------------------------------------------


class _Arrivals(_Files, ds.DataSourceStreamReader):
    """Offsets are the numbers of a log's versions (``streaming.arrivals``), which never change: a batch that runs again reads the same files."""

    def __init__(self, options: dict[str, str], schema):
        super().__init__(options, schema)
        self.log = stores.local_name(options["log"].rstrip("/"))

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max((int(x.name[2:]) for x in stores.of(self.log).children(self.log) if x.is_folder and x.name.startswith("v=")), default=0)}

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        return _parts([f"{self.log}/v={n:010d}" for n in range(start["version"] + 1, end["version"] + 1)])


class CorpusArrivals(ds.DataSource):
    """``spark.readStream.format("corpus_arrivals")``; options log and those of ``corpus_files``."""

    @classmethod
    def name(cls) -> str:
        return "corpus_arrivals"

    def schema(self) -> str:
        return schemas.FILES

    def streamReader(self, schema) -> ds.DataSourceStreamReader:
        return _Arrivals(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make both formats known; filters reach Python sources only with this setting of Spark."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CorpusFiles)
    spark.dataSource.register(CorpusArrivals)


def columns_schema(columns: tuple[str, ...] | list[str]) -> str:
    types = dict(x.split() for x in schemas.FILES.split(", "))
    return ", ".join(f"{c} {types[c]}" for c in columns)


def files(spark: SparkSession, path: str, glob: str = "*", columns: tuple[str, ...] | list[str] = (), files_per_task: int = crawl.PART, **options: str) -> DataFrame:
    """All regular files below ``path`` as they are listed now; names match ``glob`` with their case.

    ``columns`` are all of ``schemas.FILES`` if left out; files are read when the rows are.
    """
    register(spark)
    reader = spark.read.format("corpus_files").options(listing=",".join(crawl.parts(spark, path, files_per_task)), glob=glob, **options)
    return (reader.schema(columns_schema(columns)) if columns else reader).load()


def ordered(listing: DataFrame) -> DataFrame:
    """In order of path components."""
    return listing.orderBy(paths.path_key(F.col("path")))


def binary_files(spark: SparkSession, path: str, glob: str = "*", most_bytes: int | None = None) -> DataFrame:
    """The listing's columns from any file system Spark reads; without empty files and hidden names."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if most_bytes is not None:
        reader = reader.option("maxLength", most_bytes)
    return from_binary(reader.load(path))


def from_binary(raw: DataFrame) -> DataFrame:
    content, name = F.col("content"), paths.name(F.col("path"))
    head = lambda n: F.substring(content, 1, n)
    return raw.select("path", name.alias("name"), "length", head(rules.HEADER_BYTES).alias("header"), head(rules.SAMPLE_BYTES).alias("sample"), F.sha2(content, 256).alias("file_hash"), F.lit("").alias("error"), paths.suffix(name).alias("extension"), F.col("modificationTime").alias("modified"))
