"""Facts about files, pages and words, derived from the driver's tables; each has the same rule in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("", ".db", ".doc", ".DOCX", ".jpg", ".mp3", ".PDF", ".png", ".pps", ".ppt", ".pptx", ".rar", ".rtf", ".txt", ".xls", ".xlsx", ".csv", ".md", ".zip", ".7z", ".sqlite", ".xyz", ".wav")
HEADERS = ("25504446", "D0CF11E0A1B11AE1", "504B", "52617221", "00")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each part: its extension, leading bytes and size."""
    pick = lambda values, of: F.element_at(F.array(*map(F.lit, values)), (F.col("p_partkey") % of).cast("int") + 1)
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("/data/file"), F.col("p_partkey"), pick(EXTENSIONS, len(EXTENSIONS))).alias("path"),
        F.floor(F.col("p_retailprice") * 1000).alias("length"), F.unhex(pick(HEADERS, len(HEADERS))).alias("header"),
        F.when(F.col("p_partkey") % 7 == 0, "processed").otherwise("pending").alias("status"),
        F.when(F.col("p_partkey") % 97 == 0, "Permission denied").otherwise("").alias("error"), "p_partkey",
    )


FILES_SQL = f"""SELECT p_partkey, '/data/file' || p_partkey || e AS path, lower(e) AS extension,
  CASE p_partkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.doc' WHEN 2 THEN '.docx' WHEN 3 THEN '.rar' ELSE 'unknown' END AS magic,
  CAST(floor(p_retailprice * 1000) AS BIGINT) AS length, CASE WHEN p_partkey % 7 = 0 THEN 'processed' ELSE 'pending' END AS status,
  CASE WHEN p_partkey % 97 = 0 THEN 'Permission denied' ELSE '' END AS error
  FROM (SELECT *, [{", ".join(f"'{e}'" for e in EXTENSIONS)}][CAST(p_partkey % {len(EXTENSIONS)} AS INT) + 1] AS e FROM part)"""

_LANE = "CASE WHEN {e} = '.pdf' THEN 'pdf' WHEN {e} = '.doc' THEN 'word_legacy' WHEN {e} = '.docx' THEN 'word_modern' WHEN {e} IN ('.xls', '.xlsx', '.csv') THEN 'excel' WHEN {e} IN ('.ppt', '.pptx', '.pps') THEN 'slides' WHEN {e} = '.rtf' THEN 'rtf' WHEN {e} IN ('.txt', '.md') THEN 'text' WHEN {e} IN ('.jpg', '.jpeg', '.png', '.tiff') THEN 'image' WHEN {e} IN ('.mp3', '.wav') THEN 'audio' WHEN {e} IN ('.rar', '.zip', '.7z') THEN 'archive' WHEN {e} IN ('.db', '.sqlite') THEN 'database' END"
LANES_SQL = f"SELECT *, coalesce({_LANE.format(e='extension')}, {_LANE.format(e='magic')}, 'unknown') AS lane FROM ({FILES_SQL})"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each line of an order, its measures already taken."""
    tax = F.col("l_tax") >= 0.03
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), F.when(F.col("l_returnflag") == "N", "original").otherwise("converted").alias("origin"),
        F.floor(F.col("l_extendedprice") / 50).alias("text_chars"), (F.col("l_discount") * 4).alias("image_ratio"),
        F.when(tax, F.col("l_tax") * 5).otherwise(F.lit(0.0)).alias("table_ratio"), tax.alias("has_table"), (F.col("l_linenumber") % 4).alias("headings"),
    )


PAGES_SQL = """SELECT doc, origin, text_chars, CASE WHEN text_chars < 100 THEN 'scanned' WHEN image_ratio >= 0.30 AND text_chars < 800 AND headings <= 2 THEN 'slide_style'
  WHEN table_ratio >= 0.30 THEN 'table_heavy' WHEN has_table THEN 'text_with_tables' ELSE 'text_structured' END AS class
  FROM (SELECT l_orderkey AS doc, CASE WHEN l_returnflag = 'N' THEN 'original' ELSE 'converted' END AS origin, CAST(floor(l_extendedprice / 50) AS BIGINT) AS text_chars,
  l_discount * 4 AS image_ratio, CASE WHEN l_tax >= 0.03 THEN l_tax * 5 ELSE 0 END AS table_ratio, l_tax >= 0.03 AS has_table, l_linenumber % 4 AS headings FROM lineitem)"""


_LINE_CLASSES = PAGES_SQL.replace("SELECT doc, origin,", "SELECT doc, page, origin,", 1).replace("SELECT l_orderkey AS doc,", "SELECT l_orderkey AS doc, l_linenumber AS page,")
#: One class for each line number of an order, as some have one twice.
LINES_SQL = f"SELECT doc, page, min(class) AS class FROM ({_LINE_CLASSES}) GROUP BY doc, page"


def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a page for each line of an order, as a parser would give them; the first page of some files can't be read."""
    box = lambda height: F.array(F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("x1"), height.alias("y1")))
    none, tax, big = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"), F.col("l_tax"), (F.col("l_linenumber") % 4).cast("int")
    span = lambda size: F.struct(F.lit(size).alias("size"), F.lit("a").alias("text"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_hash"), F.concat(F.lit("/f/"), "l_orderkey").alias("path"), F.when(F.col("l_orderkey") % 2 == 0, "original").otherwise("converted").alias("origin"),
        F.col("l_linenumber").cast("int").alias("page_num"), F.repeat(F.lit("w"), F.floor(F.col("l_extendedprice") / 50).cast("int")).alias("text"), F.lit(10.0).alias("width"), F.lit(10.0).alias("height"),
        F.when(F.col("l_discount") > 0, box(F.col("l_discount") * 40)).otherwise(none).alias("images"), F.when(tax >= 0.03, box(tax * 50)).otherwise(none).alias("tables"),
        F.concat(F.array_repeat(span(10.0), 5), F.array_repeat(span(20.0), big)).alias("spans"),
        F.when((F.col("l_orderkey") % 11 == 0) & (F.col("l_linenumber") == 1), "damaged").alias("error"),
    )


PAGE_FACTS_SQL = """SELECT file, origin, page, broken, text_chars, n_images, n_tables, headings, CASE WHEN text_chars < 100 THEN 'scanned' WHEN image_ratio >= 0.30 AND text_chars < 800 AND headings <= 2 THEN 'slide_style'
  WHEN table_ratio >= 0.30 THEN 'table_heavy' WHEN n_tables > 0 THEN 'text_with_tables' ELSE 'text_structured' END AS class
  FROM (SELECT *, CASE WHEN text_chars >= 100 THEN big ELSE 0 END AS headings FROM (SELECT CAST(l_orderkey AS VARCHAR) AS file, CASE WHEN l_orderkey % 2 = 0 THEN 'original' ELSE 'converted' END AS origin, l_linenumber AS page,
  max(CAST(l_orderkey % 11 = 0 AND l_linenumber = 1 AS INT)) OVER (PARTITION BY l_orderkey) = 1 AS broken, CAST(floor(l_extendedprice / 50) AS BIGINT) AS text_chars, l_linenumber % 4 AS big,
  CAST(l_discount > 0 AS INT) AS n_images, CAST(l_tax >= 0.03 AS INT) AS n_tables, l_discount * 40 * 10 / 100 AS image_ratio, CASE WHEN l_tax >= 0.03 THEN l_tax * 50 * 10 / 100 ELSE 0 END AS table_ratio FROM lineitem))"""


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each document: hash and path."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"), F.concat(F.lit("/"), F.col("source"), F.lit("/d"), F.col("doc_id")).alias("path"), F.octet_length("text").cast("long").alias("length"), "text")


CONTENTS_SQL = "SELECT doc_id, sha256(text) AS file_hash, '/' || source || '/d' || doc_id AS path, CAST(strlen(text) AS BIGINT) AS length, text FROM documents"
