"""The manifest: one row per content hash, whose columns belong to the stages that write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..storage import versions

SCHEMA = schemas.MANIFEST
COLUMNS = tuple(f.name for f in SCHEMA)

#: Columns that a stage owns: it overwrites these and leaves the others.
OWNED = {
    "triage": ("path", "lane", "size_mb", "n_bytes", "status", "triaged_at"),
    "convert": ("path", "lane", "convert_status", "converted_pdf"),
    "profile": ("page_profile", "page_count"),
    "ocr": ("ocr_status", "ocr_output"),
}


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def conform(df: DataFrame) -> DataFrame:
    """All columns of the manifest, null where ``df`` lacks them."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA))


def merge(manifest: DataFrame, updates: DataFrame, owned: tuple[str, ...]) -> DataFrame:
    """Upsert: rows of ``updates`` set the columns ``owned``, to null too; all other values stay. One shuffle by hash on each side."""
    new = updates.select("file_hash", F.lit(True).alias("__new"), *(F.col(c).alias(f"__{c}") for c in owned))
    joined = manifest.join(new, "file_hash", "full_outer")
    return joined.select(*((F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)) if c in owned else F.col(c)).alias(c) for c in manifest.columns))


def mark_processed(manifest: DataFrame, hashes: DataFrame) -> DataFrame:
    return merge(manifest, hashes.select("file_hash").distinct().withColumn("status", F.lit("processed")), ("status",))


def pending_conversions(files: DataFrame, manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """``files`` whose conversion isn't done, or is done but its output is gone."""
    done = manifest.where("convert_status = 'done'").join(existing.select(F.col("path").alias("converted_pdf")), "converted_pdf", "left_semi")
    return files.join(done.select("file_hash"), "file_hash", "left_anti")


def existing_only(rows: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    return rows.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_semi").select(*rows.columns)


# --- storage ------------------------------------------------------------------


def store(spark: SparkSession, root: str, buckets: int = versions.BUCKETS) -> versions.Table:
    """The versioned table at ``root``, in ``buckets`` by hash if it is new."""
    return versions.Table(spark, root, SCHEMA, "file_hash", buckets)


def save(manifest: DataFrame, root: str) -> int:
    """Replace all entries at ``root``; the number of the version."""
    return store(manifest.sparkSession, root).replace(manifest).number


def commit(updates: DataFrame, root: str, stage: str) -> int:
    """Set the columns that ``stage`` owns; entries, columns and commits of others stay. The number of the version."""
    return store(updates.sparkSession, root).commit(updates, OWNED[stage]).number


def load(spark: SparkSession, root: str) -> DataFrame:
    """The newest version; empty if there is none."""
    return store(spark, root).read()


def parse_json(objects: DataFrame) -> DataFrame:
    """Manifest rows of JSON objects ``value`` that hold entries by hash."""
    entry = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in SCHEMA if f.name != "file_hash")
    return conform(objects.select(F.explode(F.from_json("value", f"map<string,struct<{entry}>>"))).select(F.col("key").alias("file_hash"), "value.*"))


def import_json(spark: SparkSession, path: str) -> DataFrame:
    """A manifest kept as one JSON object of entries by hash."""
    return parse_json(spark.read.text(path, wholetext=True))


def export_json(manifest: DataFrame, path: str) -> None:
    """One JSON object per line with its hash; absent keys are left out."""
    manifest.write.option("ignoreNullFields", True).json(path)
