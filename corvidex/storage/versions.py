"""A table of rows by key in buckets, in versions that are committed one after the other.

A version is a small JSON file that names, for each bucket, the folders of its
rows.  A commit writes the buckets that its updates touch and publishes the next
version under a name that only one writer can take; another writer that finds it
taken applies its updates to the newer version, so none is lost.  Readers see a
version whole.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import hadoop, modified, n_bytes, names, publish, read_text, remove, write_text

#: Updates of so many bytes (as files) at most are sent to every task; above, both sides are shuffled by key.
BROADCAST_BYTES = 8 << 20
BUCKETS = 16
TRIES = 20


@dataclass(frozen=True)
class Version:
    number: int
    buckets: int
    folders: dict[int, list[str]]  #: of each bucket, relative to the root


class Conflict(RuntimeError):
    """Others kept committing first."""


class Table:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key, self.first_buckets = spark, root.rstrip("/"), schema, key, buckets

    # --- versions ---------------------------------------------------------------

    def _name(self, number: int) -> str:
        return f"{self.root}/version-{number:012d}.json"

    def numbers(self) -> list[int]:
        return [int(n[8:20]) for n in names(self.spark, self.root) if re.fullmatch(r"version-\d{12}\.json", n)]

    def version(self, number: int | None = None) -> Version:
        """The newest version, or a former one that still stands; number 0 has no rows."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return Version(0, self.first_buckets, {})
        found = json.loads(read_text(self.spark, self._name(number)))
        return Version(number, found["buckets"], {int(b): f for b, f in found["folders"].items()})

    def _publish(self, version: Version) -> bool:
        draft = f"{self.root}/.draft-{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps({"buckets": version.buckets, "folders": version.folders}))
        if publish(self.spark, draft, self._name(version.number)):
            return True
        remove(self.spark, draft)
        return False

    # --- rows -------------------------------------------------------------------

    def _typed(self, *columns: str) -> list[Column]:
        return [F.col(c).cast(self.schema[c].dataType).alias(c) for c in columns]

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def read(self, version: Version | None = None, among: list[int] | None = None) -> DataFrame:
        version = version or self.version()
        paths = [f"{self.root}/{f}" for b, folders in sorted(version.folders.items()) if among is None or b in among for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, buckets: int) -> dict[int, list[str]]:
        folder = f"data-{uuid.uuid4().hex}"
        rows.withColumn("bucket", self.bucket(buckets)).write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.root}/{folder}")
        return {int(n[7:]): [f"{folder}/{n}"] for n in names(self.spark, f"{self.root}/{folder}") if n.startswith("bucket=")}

    def replace(self, rows: DataFrame, on: Version | None = None) -> Version:
        """All rows anew. With ``on``, only if that is still the newest version."""
        base = on or self.version()
        # Rows meet by bucket first, else each task would leave a file in every bucket.
        folders = self._write(rows.select(*self._typed(*self.schema.names)).repartition(base.buckets, self.bucket(base.buckets)), base.buckets)
        for _ in range(TRIES):
            new = Version(base.number + 1, base.buckets, folders)
            if self._publish(new):
                return new
            if on:
                raise Conflict(f"version {on.number} of {self.root} isn't the newest any more")
            base = self.version()
            if base.buckets != new.buckets:
                raise Conflict(f"{self.root} was given other buckets")
        raise Conflict(self.root)

    def merged(self, stored: DataFrame, updates: DataFrame, owned: tuple[str, ...], small: bool) -> DataFrame:
        """``stored`` with the columns ``owned`` of ``updates`` set, and the rows of new keys.

        Small updates are broadcast to the stored rows, which then stay where they
        are; what they match is as small, so the rest of them is found without
        another look at the stored rows.
        """
        key, mark = self.key, f"__{uuid.uuid4().hex}"
        new = updates.select(key, F.lit(True).alias(mark), *(F.col(c).alias(f"{mark}{c}") for c in owned))
        pick = [F.when(F.col(mark), F.col(f"{mark}{c}")).otherwise(F.col(c)).alias(c) if c in owned else F.col(c) for c in self.schema.names]
        if not small:
            return stored.join(new, key, "full_outer").select(*pick)
        changed = stored.join(F.broadcast(new), key, "left").select(*pick)
        matched = stored.select(key).join(F.broadcast(updates.select(key)), key, "left_semi")
        fresh = updates.join(F.broadcast(matched), key, "left_anti")
        return changed.unionByName(fresh.select(*((F.col(f.name) if f.name == key or f.name in owned else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema)))

    def commit(self, updates: DataFrame, owned: tuple[str, ...], broadcast_bytes: int = BROADCAST_BYTES, before_publish=None) -> Version:
        """Upsert ``updates(key, owned...)``, whose keys are distinct, as the next version.

        ``updates`` are evaluated once and written; only the buckets they touch
        are read and written again. If another writer was first, its version is
        the base of another try; buckets that it left alone needn't be merged
        anew. ``before_publish`` is called before each try to publish (tests).
        """
        draft = f"{self.root}/.updates-{uuid.uuid4().hex}"
        updates.select(*self._typed(self.key, *owned)).write.option("compression", "zstd").parquet(draft)
        try:
            schema = StructType([self.schema[c] for c in (self.key, *owned)])
            kept = self.spark.read.schema(schema).parquet(draft)
            small = n_bytes(self.spark, draft) <= broadcast_bytes
            base, done = self.version(), {}
            touched = sorted(r[0] for r in kept.select(self.bucket(base.buckets)).distinct().collect())
            todo = touched
            for _ in range(TRIES):
                if todo:
                    done |= dict.fromkeys(todo, [])
                    rows = self.merged(self.read(base, todo), kept.where(self.bucket(base.buckets).isin(todo)), owned, small)
                    done |= self._write(rows if small else rows.repartition(len(todo), self.bucket(base.buckets)), base.buckets)
                new = Version(base.number + 1, base.buckets, {**base.folders, **{b: f for b, f in done.items() if f}})
                if before_publish:
                    before_publish()
                if self._publish(new):
                    return new
                newer = self.version()
                todo = [b for b in touched if newer.folders.get(b) != base.folders.get(b)]
                base = newer
            raise Conflict(f"{TRIES} tries to commit to {self.root} came too late")
        finally:
            remove(self.spark, draft)

    def vacuum(self, keep: int = 2, older_s: float = 24 * 3600) -> list[str]:
        """Remove versions but the newest ``keep``, and folders that none of these names, if ``older_s`` seconds old.

        The age spares what a writer has written and not yet published; after a
        crashed writer, that is how its files go.
        """
        numbers = sorted(self.numbers())
        used = {f.split("/")[0] for n in numbers[-keep:] for folders in self.version(n).folders.values() for f in folders}
        gone = [self._name(n).rsplit("/", 1)[1] for n in numbers[:-keep]]
        old = [n for n in names(self.spark, self.root) if n.startswith(("data-", ".draft-", ".updates-")) and n not in used and time.time() - modified(self.spark, f"{self.root}/{n}") >= older_s]
        for n in gone + old:
            remove(self.spark, f"{self.root}/{n}")
        return gone + old


def exists(spark: SparkSession, root: str) -> bool:
    file_system, at = hadoop(spark, root)
    return bool(file_system.exists(at))
