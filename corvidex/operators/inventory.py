"""The inventory: one row per file, and the report by extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import content, paths


#: What an inventory reads of a file: no hash, so no file is read beyond its start.
COLUMNS = ("path", "length", "header", "sample", "error")


def file_info(files: DataFrame) -> DataFrame:
    """``files(path, length, header, sample, error)`` to inventory rows."""
    ext = paths.suffix(paths.name(F.col("path")))
    typed = files.select("path", paths.name(F.col("path")).alias("name"), ext.alias("extension"), content.size_mib(F.col("length")).alias("size_mb"), "length", "header", "sample", F.coalesce("error", F.lit("")).alias("error"))
    ok = F.col("error") == ""
    is_text = F.col("extension").isin(*rules.TEXT_EXTENSIONS)
    encrypted = F.coalesce(content.encrypted(F.col("extension"), F.col("header")), F.lit(False))
    # One pass over the files: the Python function gets the samples of text files, and nulls for the rest.
    found = typed.withColumn("encoding", content.detect_encoding(F.when(ok & is_text, F.substring("sample", 1, rules.SAMPLE_BYTES))))
    told = F.when(ok & is_text, F.col("encoding")).otherwise("unknown").alias("encoding")
    return found.select("path", "name", "extension", "size_mb", (ok & encrypted).alias("is_encrypted"), told, F.lit(0).alias("page_count"), "error", F.col("length").alias("n_bytes"))


def by_extension(files: DataFrame) -> DataFrame:
    """Files, bytes, encrypted files and the mean size by extension, and the total, whose mean is left out.

    Expects ``extension``, ``n_bytes`` and ``is_encrypted``. One partial
    aggregation feeds the groups and the total.
    """
    labelled = files.withColumn("ext", F.when(F.col("extension") == "", rules.NO_EXTENSION).otherwise(F.col("extension")))
    grouped = labelled.rollup("ext").agg(F.grouping("ext").alias("is_total"), F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"), F.count_if("is_encrypted").alias("n_encrypted"))
    total = F.col("is_total") == 1
    return grouped.select(
        F.when(total, "TOTAL").otherwise(F.col("ext")).alias("ext"), "n_files", "n_bytes", "n_encrypted",
        content.size_mib(F.col("n_bytes")).alias("size_mib"),
        F.when(~total, content.size_mib(F.col("n_bytes")) / F.col("n_files")).alias("avg_mib"), total.alias("is_total"),
    ).orderBy("is_total", "ext")


def errors(files: DataFrame, most: int = 10) -> DataFrame:
    """The first files, by path, that couldn't be read."""
    return files.where(F.col("error") != "").orderBy(paths.path_key(F.col("path"))).select("name", "error").limit(most)
