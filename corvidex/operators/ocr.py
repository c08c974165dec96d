"""Recognition results: words and regions to pages, documents and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import ocr, paths


def candidates(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """``file_hash, path`` of files with scanned pages that exist."""
    scanned = manifest.where(F.coalesce(F.col("page_profile")["scanned"], F.lit(0)) > 0)
    found = scanned.select("file_hash", paths.usable_path(F.col("converted_pdf"), F.col("path")).alias("path"))
    return found.join(listing.select("path").distinct(), "path", "left_semi").select("file_hash", "path")


def page_records(words: DataFrame) -> DataFrame:
    """``words(file_hash, page_num, text[], conf[])`` to one record per page."""
    return words.select("file_hash", "page_num", ocr.page_text(F.col("text")).alias("text"), ocr.confidence(F.col("text"), F.col("conf")).alias("confidence"), F.lit(rules.OCR_LANGUAGE).alias("language"), ocr.word_count(F.col("text")).cast("long").alias("word_count"))


def layout_records(regions: DataFrame) -> DataFrame:
    """``regions(file_hash, page_num, position, region, text)`` to one record per page, blank regions left out."""
    ordered = regions.groupBy("file_hash", "page_num").agg(F.sort_array(F.collect_list(F.struct("position", "region", "text"))).alias("found"))
    return ordered.select("file_hash", "page_num", F.filter("found", lambda r: F.trim(r["text"]) != "").alias("regions"), ocr.combined_text(F.col("found")).alias("combined_text"))


def documents(pages: DataFrame, source: DataFrame) -> DataFrame:
    """One document per file with its pages in order, in the shape that is written as JSON."""
    page = F.struct("page_num", "text", "confidence", "language", F.col("page_num").cast("long").alias("number"), "word_count")
    grouped = pages.groupBy("file_hash").agg(F.sort_array(F.collect_list(page)).alias("p"), F.count("*").alias("total_pages"))
    shaped = F.transform("p", lambda p: F.struct(p["text"].alias("text"), p["confidence"].alias("confidence"), p["language"].alias("language"), p["number"].alias("page_num"), p["word_count"].alias("word_count")))
    return grouped.join(source.select("file_hash", F.col("path").alias("source_pdf")), "file_hash").select("file_hash", "source_pdf", shaped.alias("ocr_results"), "total_pages")


def explode_documents(docs: DataFrame) -> DataFrame:
    """Pages of documents that were read back from JSON."""
    return docs.select("file_hash", F.inline("ocr_results"))


def document_confidence(pages: DataFrame, key: str = "file_hash") -> DataFrame:
    """Pages and their mean confidence per file; blank pages count as 0."""
    return pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.avg("confidence").alias("confidence"))


def run_confidence(per_document: DataFrame) -> DataFrame:
    """Files, pages and the mean of the files' means, 0 if there are none."""
    return per_document.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("n_pages"), F.lit(0)).alias("n_pages"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("confidence"))


def entries(docs: DataFrame, folder: str) -> DataFrame:
    """Manifest rows of recognized files."""
    return docs.select("file_hash", F.lit("done").alias("ocr_status"), F.concat(F.lit(folder.rstrip("/") + "/"), F.col("file_hash"), F.lit("_ocr.json")).alias("ocr_output"))
