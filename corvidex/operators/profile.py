"""Page profiles: facts of pages to classes and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules, storage
from ..functions import pages, paths, text


def items(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """``file_hash, path, origin`` of the PDFs to profile that exist: originals, and finished conversions."""
    originals = manifest.where("lane = 'pdf'").select("file_hash", "path", F.lit("original").alias("origin"))
    converted = manifest.where("lane IS DISTINCT FROM 'pdf' AND convert_status = 'done'").select("file_hash", F.col("converted_pdf").alias("path"), F.lit("converted").alias("origin"))
    return originals.unionByName(converted).join(listing.select("path").distinct(), "path", "left_semi").select("file_hash", "path", "origin")


def _measured(facts: DataFrame) -> DataFrame:
    """Each row's class and counts, and its error; what has no page, or an error, has no class."""
    found = facts.select("file_hash", "path", "origin", "page_num", "error", "width", "height", "images", "tables", "spans", text.strip_length(F.coalesce("text", F.lit(""))).alias("text_chars"))
    measured = found.withColumns(
        {
            "image_ratio": pages.area_ratio(F.col("images"), F.col("width"), F.col("height")),
            "table_ratio": pages.area_ratio(F.col("tables"), F.col("width"), F.col("height")),
            "n_images": F.greatest(F.size("images"), F.lit(0)),
            "n_tables": F.greatest(F.size("tables"), F.lit(0)),
            "headings": pages.heading_count(F.col("spans"), F.col("text_chars")),
        }
    )
    named = pages.page_class(F.col("text_chars"), F.col("image_ratio"), F.col("table_ratio"), F.col("n_tables") > 0, F.col("headings"))
    is_page = F.col("page_num").isNotNull() & F.col("error").isNull()
    return measured.select("file_hash", "path", "origin", "page_num", "error", F.when(is_page, named).alias("class"), "text_chars", "n_images", "n_tables", "headings")


def classify(facts: DataFrame) -> DataFrame:
    """One row per page with its class; pages of a file with an error don't count.

    Facts are read once: what is left of them, without texts and boxes, is written.
    """
    measured = storage.written(_measured(facts), "pages")
    broken = measured.where("error IS NOT NULL").select("file_hash").distinct()
    return measured.where("class IS NOT NULL").join(broken, "file_hash", "left_anti").drop("error")


def profiles(facts: DataFrame) -> DataFrame:
    """One row per file: its error, or the counts of its pages by class and of what they hold.

    One scan and one aggregation carry pages and errors together; partial counts
    meet, so a file may have any number of pages. A file that was read but has
    no page has counts of 0.
    """
    ok = F.col("class").isNotNull()
    counts = [F.count_if(F.col("class") == c).cast("int").alias(f"n_{c}") for c in rules.PAGE_CLASSES]
    sums = [F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast("long").alias(c) for c in ("text_chars", "n_images", "n_tables", "headings")]
    grouped = _measured(facts).groupBy("file_hash").agg(F.min("path").alias("path"), F.min("origin").alias("origin"), F.min("error").alias("error"), *counts, *sums)
    good = F.col("error").isNull()
    told = F.filter(F.array(*(F.struct(F.lit(c).alias("class"), F.col(f"n_{c}").alias("n")) for c in sorted(rules.PAGE_CLASSES))), lambda e: e["n"] > 0)
    n_pages = sum((F.col(f"n_{c}") for c in rules.PAGE_CLASSES), F.lit(0))
    return grouped.select("file_hash", "path", "origin", "error", F.when(good, F.map_from_entries(told)).alias("page_profile"), F.when(good, n_pages).alias("page_count"), *(F.when(good, F.col(c)).alias(c) for c in ("text_chars", "n_images", "n_tables", "headings")))


def _counted(found: DataFrame, *by: str) -> DataFrame:
    each = found.where("error IS NULL").select(*by, F.explode("page_profile").alias("class", "n"))
    return each.groupBy(*by, "class").agg(F.sum("n").alias("n_pages"))


def classes_of(found: DataFrame) -> DataFrame:
    """``distribution`` from ``profiles``."""
    return _counted(found).withColumn("percent", F.col("n_pages") * F.lit(1e2) / F.sum("n_pages").over(Window.partitionBy())).orderBy(F.desc("n_pages"), "class")


def origins_of(found: DataFrame) -> DataFrame:
    """``by_origin`` from ``profiles``."""
    return _counted(found, "origin").orderBy("origin", "class")


def totals(found: DataFrame) -> DataFrame:
    """One row: files, those with an error, pages, images, tables and characters."""
    long = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return found.agg(F.count("*").alias("n_files"), F.count("error").alias("n_failed"), long("page_count"), long("n_images"), long("n_tables"), long("text_chars"))


def failures(found: DataFrame) -> DataFrame:
    return found.where("error IS NOT NULL").select("path", text.error_tail(F.col("error"), rules.ERROR_TAIL).alias("error"))


def distribution(classes: DataFrame) -> DataFrame:
    """Pages by class with their share in per cent, the commonest first."""
    counted = classes.groupBy("class").agg(F.count("*").alias("n_pages"))
    return counted.withColumn("percent", F.col("n_pages") * F.lit(1e2) / F.sum("n_pages").over(Window.partitionBy())).orderBy(F.desc("n_pages"), "class")


def by_origin(classes: DataFrame) -> DataFrame:
    return classes.groupBy("origin", "class").agg(F.count("*").alias("n_pages")).orderBy("origin", "class")


def histograms(classes: DataFrame, key: str = "file_hash") -> DataFrame:
    """``key, page_profile (map), page_count``. The inner aggregation leaves at most five rows per file."""
    counted = classes.groupBy(key, "class").agg(F.count("*").cast("int").alias("n"))
    return counted.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class", "n")))).alias("page_profile"), F.sum("n").cast("int").alias("page_count"))


def entries(facts: DataFrame) -> DataFrame:
    """Manifest rows of profiled files; one that was read but has no page gets an empty profile."""
    return profiles(facts).where("error IS NULL").select("file_hash", "page_profile", "page_count")


def backfill(manifest: DataFrame, facts: DataFrame, least_chars: int = rules.BACKFILL_CHARS) -> DataFrame:
    """Profiles by the weaker rule for entries that have none: only files with scanned pages get one."""
    lacking = manifest.where("page_profile IS NULL").withColumn("pdf", paths.usable_path(F.col("converted_pdf"), F.col("path"))).where(paths.suffix(paths.name(F.col("pdf"))) == ".pdf").select("file_hash")
    scanned = F.count_if(text.strip_length(F.coalesce("text", F.lit(""))) < least_chars)
    counted = facts.join(lacking, "file_hash", "left_semi").groupBy("file_hash").agg(scanned.cast("int").alias("scanned"), F.count("page_num").cast("int").alias("page_count"), F.count("error").alias("bad"))
    return counted.where("bad = 0 AND scanned > 0").select("file_hash", F.create_map(F.lit("scanned"), F.col("scanned")).alias("page_profile"), "page_count")
