"""Helpers shared by the training-data operators.

``materialize`` cuts lineage with a written table in the cluster's shared
folder, so a lost executor only costs the tasks it ran.  ``pack`` turns
documents into *shards*: one compressed row holds the documents of one slice of
a scan, small enough for a task's memory whatever the size of the corpus.
"""

from __future__ import annotations

import ctypes
import gc
import itertools
import re
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Raw text bytes in a shard.
SHARD_BYTES = 24 << 20
#: Rows in an Arrow batch; texts can be long.
ARROW_ROWS = 250


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a temporary one only in local mode without a setting (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corvidex-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the files go when the session ends, or by ``discard``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corvidex/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    found = spark.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again."""
    for df in written:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes shuffle files once no frame refers to them.

    The bridge lets go of a frame a moment after Python does, hence two rounds.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def arrow_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in rows: a batch of whole texts must fit beside a task's arrays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()]


def tidy() -> None:
    """Give freed memory back to the system, which a worker that stays for the next task otherwise keeps."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def each_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of shards one by one, with memory given back in between."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)
            tidy()


# --- numpy arrays as bytes -------------------------------------------------


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal significance lie together, which sorted numbers gain from."""
    head, body = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(f"{a.dtype.str}:{len(a)}")
        body.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
    return zstandard.compress(",".join(head).encode() + b"\n" + b"".join(body), 1)


def expand(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``squeeze``."""
    raw = zstandard.decompress(blob)
    head, _, body = raw.partition(b"\n")
    out, at = [], 0
    for item in head.decode().split(","):
        kind, n = item.rsplit(":", 1)
        width, n = np.dtype(kind).itemsize, int(n)
        planes = np.frombuffer(body, np.uint8, width * n, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += width * n
    return out


def pack_texts(ids: list, texts: list[bytes]) -> bytes:
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    known = np.array([x is not None for x in ids], np.uint8)
    meta = squeeze(np.array([0 if x is None else x for x in ids], np.int64), known, lens)
    body = zstandard.compress(b"".join(texts), 1)
    return len(meta).to_bytes(8, "little") + meta + body


def unpack_texts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Document numbers, whether each is known, the lengths and the joined texts."""
    n = int.from_bytes(blob[:8], "little")
    ids, known, lens = expand(blob[8 : 8 + n])
    return ids, known.astype(bool), lens, zstandard.decompress(blob[8 + n :], max_output_size=max(1, int(lens.sum())))


def pack(docs: DataFrame, label: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(shard, docs)``: the documents in slices of about ``shard_bytes``, written to the shared folder.

    Only ``doc_id`` and ``text`` are read. A slice belongs to one scan task, so
    nothing is shuffled.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, texts, held = TaskContext.get().partitionId(), itertools.count(), [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"shard": pa.array([part << 24 | next(seq)], pa.int64()), "docs": pa.array([pack_texts(ids, texts)], pa.binary())})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                ids.append(i)
                texts.append(text)
                held += len(text) + 16
                if held >= shard_bytes:
                    yield flush()
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(slim.mapInArrow(run, "shard long, docs binary"), label)


def table(schema: pa.Schema, **columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# --- connected components --------------------------------------------------


def components(edges: DataFrame, label: str, most_rounds: int = 50) -> DataFrame:
    """``(node, component)`` for each node of ``edges(src, dst)``; the component is its smallest node.

    Alternating large-star and small-star steps; every round is written to the
    shared folder. A hub's edges are pre-aggregated to its minimum before the
    join, and the join may split a hub, so no task holds a whole neighbourhood.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if large else e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        joined = both.join(low, "src")
        if large:
            return joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct()
        kept = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(low.select("src", F.col("low").alias("dst")))
        return kept.where("src <> dst").distinct()

    e = materialize(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct(), f"{label}-edges")
    before = None
    for n in range(most_rounds):
        e = materialize(star(star(e, True), False), f"{label}-round{n}")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
