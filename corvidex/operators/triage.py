"""Triage: a hash and a lane for each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import content, paths


#: What triage reads of a file.
COLUMNS = ("path", "length", "header", "file_hash", "error")


def assign(files: DataFrame, lanes=rules.LANES, magic=rules.MAGIC) -> DataFrame:
    """Adds ``extension`` and ``lane`` to ``files(path, header)``. The rule tables are literals: no join, no shuffle."""
    return files.withColumn("extension", paths.suffix(paths.name(F.col("path")))).withColumn("lane", content.lane(F.col("extension"), F.col("header"), lanes, magic))


def last_by_path(files: DataFrame, key: str = "file_hash") -> DataFrame:
    """One row per content: that whose path is last in component order."""
    order = Window.partitionBy(key).orderBy(paths.path_key(F.col("path")).desc(), F.col("path").desc())
    return files.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def entries(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Manifest rows of ``files(path, length, header, file_hash, error)``; a known hash keeps its status.

    Files that couldn't be read have no hash and make no entry.
    """
    found = last_by_path(assign(files.where("file_hash IS NOT NULL")))
    known = manifest.select("file_hash", F.col("status").alias("__known")) if manifest is not None else None
    joined = found.join(known, "file_hash", "left") if known is not None else found.withColumn("__known", F.lit(None).cast("string"))
    status = F.when(F.col("__known") == "processed", "processed").otherwise("pending")
    return joined.select("file_hash", "path", "lane", content.size_mb(F.col("length")).alias("size_mb"), F.col("length").alias("n_bytes"), status.alias("status"), F.current_timestamp().cast("timestamp_ntz").alias("triaged_at"))


def report(files: DataFrame) -> DataFrame:
    """Files, pending files and millions of bytes by lane, the largest first; equal contents at two paths count twice."""
    grouped = files.groupBy("lane").agg(F.count("*").alias("n_files"), F.count_if(F.col("status") == "pending").alias("n_pending"), F.sum("length").alias("n_bytes"))
    return grouped.withColumn("size_mb", content.size_mb(F.col("n_bytes"))).orderBy(F.desc("n_bytes"), "lane")
