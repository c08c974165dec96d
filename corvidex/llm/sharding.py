"""A store of immutable shards with size-tiered compaction.

Arrivals are appended as runs of small files.  Runs of about the same size form
a tier; once a tier has ``fan_out`` runs they are merged into one run of
target-sized files, ordered by ``key``.  Every change is a new version of the
manifest, a small list of runs, which becomes visible in one atomic rename that
fails if another writer took the version; data files are never changed.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TARGET_BYTES = 128 << 20
FAN_OUT = 4
#: Runs up to this size are the lowest tier.
LOWEST_BYTES = 1 << 20
#: After so long without a write, data that no version lists is a crashed writer's.
ORPHAN_HOURS = 24.0


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Run:
    name: str
    files: tuple[str, ...]
    n_bytes: int
    n_rows: int
    merged_from: tuple[str, ...] = ()

    def tier(self, fan_out: int) -> int:
        return 0 if self.n_bytes <= LOWEST_BYTES else 1 + int(math.log(self.n_bytes / LOWEST_BYTES, fan_out))


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str
    runs: tuple[Run, ...]


class Store:
    """Runs and manifests below ``root``, which all executors see."""

    def __init__(self, spark: SparkSession, root: str, key: str = "doc_id", target_bytes: int = TARGET_BYTES, fan_out: int = FAN_OUT):
        self.spark, self.root, self.key, self.target_bytes, self.fan_out = spark, root.rstrip("/"), key, target_bytes, fan_out
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    # --- manifests

    def versions(self) -> list[int]:
        folder = self._path("manifest")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[1:-5]) for s in self._fs.listStatus(folder) if s.getPath().getName().startswith("v"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or the one asked for; version 0 is empty."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest(0, "", ())
        stream = self._fs.open(self._path(f"manifest/v{version:010d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Manifest(found["version"], found["schema"], tuple(Run(**r | {"files": tuple(r["files"]), "merged_from": tuple(r["merged_from"])}) for r in found["runs"]))

    def commit(self, base: Manifest, schema: str, runs: tuple[Run, ...]) -> Manifest:
        """Make ``runs`` the version after ``base``, or raise ``Conflict``."""
        new = Manifest(base.version + 1, schema, runs)
        draft, final = self._path(f"manifest/.{uuid.uuid4().hex}"), self._path(f"manifest/v{new.version:010d}.json")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(asdict(new)).encode()))
            out.hflush()
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), none)
        except Exception as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {new.version} exists") from None
            raise
        return new

    # --- data

    def _write(self, df: DataFrame, merged_from: tuple[str, ...] = ()) -> Run:
        name = f"run-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.root}/data/{name}")
        return self._listed(f"data/{name}", name, merged_from)

    def _listed(self, folder: str, name: str, merged_from: tuple[str, ...] = ()) -> Run:
        files = [(f"{folder}/{s.getPath().getName()}", s.getLen()) for s in self._fs.listStatus(self._path(folder)) if s.getPath().getName().startswith("part-")]
        rows = self.spark.read.parquet(f"{self.root}/{folder}").count() if files else 0
        return Run(name, tuple(sorted(f for f, _ in files)), sum(n for _, n in files), rows, merged_from)

    def append(self, df: DataFrame) -> Manifest:
        """Add ``df`` as one run. A lost race is tried again on the newer version: appends don't conflict."""
        run = self._write(df)
        return self._add([run], df.schema.json())

    def append_split(self, df: DataFrame, arrival: str) -> Manifest:
        """Add ``df`` as one run for each value of the column ``arrival``, written in one pass; a version for each run."""
        name = f"batch-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").partitionBy(arrival).parquet(f"{self.root}/data/{name}")
        schema = df.drop(arrival).schema.json()
        manifest = self.manifest()
        for s in sorted(self._fs.listStatus(self._path(f"data/{name}")), key=lambda s: s.getPath().getName()):
            folder = s.getPath().getName()
            if s.isDirectory() and "=" in folder:
                manifest = self._add([self._listed(f"data/{name}/{folder}", f"{name}/{folder}")], schema)
        return manifest

    def _add(self, runs: list[Run], schema: str) -> Manifest:
        while True:
            base = self.manifest()
            if base.schema and base.schema != schema:
                raise ValueError("the schema differs from the store's")
            try:
                return self.commit(base, schema, (*base.runs, *runs))
            except Conflict:
                continue

    def read(self, version: int | None = None, runs: tuple[Run, ...] | None = None) -> DataFrame:
        from pyspark.sql.types import StructType

        manifest = self.manifest(version)
        schema = StructType.fromJson(json.loads(manifest.schema)) if manifest.schema else StructType()
        files = [f"{self.root}/{f}" for r in (manifest.runs if runs is None else runs) for f in r.files]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def due(self, manifest: Manifest) -> list[Run]:
        """The runs of the lowest tier that is full."""
        tiers: dict[int, list[Run]] = {}
        for r in manifest.runs:
            tiers.setdefault(r.tier(self.fan_out), []).append(r)
        return next((runs for _, runs in sorted(tiers.items()) if len(runs) >= self.fan_out), [])

    def compact(self) -> Manifest:
        """Merge full tiers until none is left; each merge is a version of its own."""
        while runs := self.due(manifest := self.manifest()):
            n_files = max(1, round(sum(r.n_bytes for r in runs) / self.target_bytes))
            rows = self.read(runs=tuple(runs))
            # The row's hash splits a key that many rows share over several files.
            salt = F.xxhash64(*rows.columns)
            merged = self._write(rows.repartitionByRange(n_files, F.col(self.key), salt).sortWithinPartitions(self.key), tuple(r.name for r in runs))
            if merged.n_rows != sum(r.n_rows for r in runs):
                raise RuntimeError("the merged run has other rows than its parts")
            gone = {r.name for r in runs}
            try:
                self.commit(manifest, manifest.schema, (*(r for r in manifest.runs if r.name not in gone), merged))
            except Conflict:
                self._fs.delete(self._path(f"data/{merged.name}"), True)
        return manifest

    def vacuum(self, keep_versions: int = 1, orphan_hours: float = ORPHAN_HOURS) -> int:
        """Delete data that only versions before the newest ``keep_versions`` list, and what crashed writers left; returns the number of runs that went.

        A run that no version lists is a writer's that crashed, or one that has
        yet to commit: it goes once its newest file is older than
        ``orphan_hours``. Manifests stay, so that a late writer can't take the
        number of an old version.
        """
        held = self.versions()
        kept = {r.name for v in held[-keep_versions:] for r in self.manifest(v).runs}
        listed = kept | {r.name for v in held[:-keep_versions] for r in self.manifest(v).runs}
        gone = [*sorted(listed - kept), *self._orphans(listed, orphan_hours)]
        return sum(self._fs.delete(self._path(f"data/{name}"), True) for name in gone)

    def _orphans(self, listed: set[str], hours: float) -> list[str]:
        """Runs that no version lists, without files of the last ``hours``."""
        if not self._fs.exists(self._path("data")):
            return []
        before, found = (time.time() - hours * 3600) * 1000, []
        for top in self._fs.listStatus(self._path("data")):
            name = top.getPath().getName()
            inner = [s for s in self._fs.listStatus(top.getPath()) if s.isDirectory()]
            # A batch has a folder for each of its runs.
            split = any("=" in s.getPath().getName() for s in inner)
            runs = [(f"{name}/{s.getPath().getName()}", s) for s in inner] if split else [(name, top)]
            found += [run for run, status in runs if run not in listed and self._newest(status) < before]
        return found

    def _newest(self, status) -> int:
        """When a folder or a file anywhere in it was last written, in milliseconds."""
        newest, files = status.getModificationTime(), self._fs.listFiles(status.getPath(), True)
        while files.hasNext():
            newest = max(newest, files.next().getModificationTime())
        return newest


#: Arrivals that the query deals the documents into.
ARRIVALS = 8


def round_trip(docs: DataFrame, arrivals: int = ARRIVALS, target_bytes: int = TARGET_BYTES) -> tuple[Store, Manifest]:
    """Deal ``docs`` into arrivals by a hash of each row, append them, compact and vacuum.

    All columns and rows are kept: nulls, repeated rows and empty texts as they
    are. An empty table makes a store without runs.
    """
    spark = docs.sparkSession
    root = f"{common.shared_dir(spark)}/corvidex/shards-{uuid.uuid4().hex}"
    store = Store(spark, root, target_bytes=target_bytes)
    store._fs.deleteOnExit(store._path(""))
    arrival = f"arrival_{uuid.uuid4().hex}"  # no column of the documents has this name
    if docs.take(1):
        store.append_split(docs.withColumn(arrival, F.pmod(F.xxhash64("doc_id", "text"), F.lit(arrivals))), arrival)
    store.compact()
    store.vacuum()
    return store, store.manifest()
