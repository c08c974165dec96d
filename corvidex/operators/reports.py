"""Reports as rows of formatted strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inventory(grouped: DataFrame) -> DataFrame:
    """The table of ``inventory.by_extension``; no encrypted file shows as a dash, the total has no mean."""
    two = lambda c: F.format_string("%.2f", F.col(c))
    total = F.col("is_total")
    none = F.when(total, F.col("n_encrypted").cast("string")).when(F.col("n_encrypted") > 0, F.format_string("🔒 %d", F.col("n_encrypted"))).otherwise("—")
    return grouped.orderBy("is_total", "ext").select(F.col("ext").alias("format"), F.col("n_files").cast("string").alias("count"), two("size_mib").alias("total_size"), none.alias("encrypted"), F.when(total, "").otherwise(two("avg_mib")).alias("avg_size"))


def lanes(report: DataFrame) -> DataFrame:
    return report.select(F.format_string("%-12s | %4d files | %4d pending | %8.2f MB", "lane", "n_files", "n_pending", "size_mb").alias("line"))


def conversions(totals: DataFrame) -> DataFrame:
    return totals.select(F.format_string("valid %d, failed %d", "n_valid", "n_failed").alias("counts"), F.format_string("serial %.1f min, parallel %.1f min", "serial_min", "parallel_min").alias("times"))


def page_classes(distribution: DataFrame) -> DataFrame:
    return distribution.select("class", F.format_string("%6d", "n_pages").alias("pages"), F.format_string("%.1f%%", "percent").alias("percent"))


def ocr(run: DataFrame) -> DataFrame:
    return run.select(F.format_string("%d files, %d pages, confidence %.1f", "n_files", "n_pages", "confidence").alias("line"))
