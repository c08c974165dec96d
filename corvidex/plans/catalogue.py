"""One query per operator over the driver's tables, and the same in SQL.

The tables hold no files, pages or scans, so ``facts`` derives them; the
operators themselves are the library's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules, storage
from ..functions import content, ocr, paths, register, text
from ..functions import pages as page_functions
from ..operators import convert, inventory, manifest, order, profile, reports, triage
from ..operators import ocr as ocr_operators
from . import facts
from .facts import CONTENTS_SQL, FILES_SQL, LANES_SQL, LINES_SQL, PAGE_FACTS_SQL, PAGES_SQL, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _long(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


def _class_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return facts.pages(spark, sf_dir).withColumn("class", page_functions.page_class(c("text_chars"), c("image_ratio"), c("table_ratio"), c("has_table"), c("headings")))


# --- inventory -------------------------------------------------------------------

_ENCRYPTED = "(extension = '.pdf' AND p_partkey % 5 = 0)"


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = facts.files(spark, sf_dir).withColumn("extension", paths.suffix(paths.name(F.col("path"))))
    header = F.when(F.col("p_partkey") % 5 == 0, F.concat("header", F.lit("-1.7 /Encrypt 5 0 R").cast("binary"))).otherwise(F.col("header"))
    return files.select("extension", F.col("length").alias("n_bytes"), content.encrypted(F.col("extension"), header).alias("is_encrypted"))


_INVENTORY_SQL = f"""SELECT CASE WHEN grouping(x) = 1 THEN 'TOTAL' ELSE x END AS ext, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS n_bytes,
  CAST(count(*) FILTER (WHERE {_ENCRYPTED}) AS BIGINT) AS n_encrypted, CASE WHEN grouping(x) = 0 THEN sum(length) / 1048576 / count(*) END AS avg_mib, sum(length) / 1048576 AS size_mib
  FROM (SELECT *, CASE WHEN extension = '' THEN '(no ext)' ELSE extension END AS x FROM ({FILES_SQL})) GROUP BY ROLLUP (x)"""


@query(f"SELECT ext, n_files, n_bytes, n_encrypted, round(avg_mib, 6) AS avg_mib FROM ({_INVENTORY_SQL})")
def inventory_by_ext_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.by_extension(_inventory(spark, sf_dir)).select("ext", *_long("n_files", "n_bytes", "n_encrypted"), F.round("avg_mib", 6).alias("avg_mib"))


@query(f"SELECT ext AS format, CAST(n_files AS VARCHAR) AS count, printf('%.2f', size_mib) AS total_size, CASE WHEN ext = 'TOTAL' THEN CAST(n_encrypted AS VARCHAR) WHEN n_encrypted > 0 THEN '🔒 ' || n_encrypted ELSE '—' END AS encrypted, coalesce(printf('%.2f', avg_mib), '') AS avg_size FROM ({_INVENTORY_SQL})")
def inventory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.inventory(inventory.by_extension(_inventory(spark, sf_dir)))


@query(f"SELECT parse_filename(path) AS name, error FROM ({FILES_SQL}) WHERE error <> '' ORDER BY string_split(path, '/') LIMIT 10")
def first_10_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.errors(facts.files(spark, sf_dir).withColumn("name", paths.name(F.col("path"))))


@query("SELECT page_id, lower(regexp_extract(n, '(?s)^.+(\\.[^.]+)$', 1)) AS suffix FROM (SELECT page_id, list_last(string_split(url, '/')) AS n FROM pages)")
def url_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", paths.suffix(paths.name(F.col("url"))).alias("suffix"))


@query("SELECT page_id, '/out/' || regexp_replace(n, '(?s)^(.+)\\.[^.]+$', '\\1') || '-' || substr(sha256(html), 1, 16) || '.pdf' AS output FROM (SELECT page_id, html, list_last(string_split(url, '/')) AS n FROM pages)")
def url_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", paths.output_path("/out", paths.name(F.col("url")), content.sha256(F.col("html"))).alias("output"))


@query("SELECT page_id, contains(substr(hex(encode(html)), 1, 1024), '3C6831') AS found FROM pages")
def header_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.substring(F.col("html").cast("binary"), 1, 512)
    return table(spark, sf_dir, "pages").select("page_id", F.contains(head, F.lit("<h1").cast("binary")).alias("found"))


@query(f"SELECT p_partkey, length / 1048576 AS size_mib, CAST(printf('%.2f', length / 1e6) AS DOUBLE) AS size_mb FROM ({FILES_SQL})")
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.files(spark, sf_dir).select("p_partkey", content.size_mib(F.col("length")).alias("size_mib"), content.size_mb(F.col("length")).alias("size_mb"))


@query("SELECT doc_id, CAST(printf('%.2f', (coalesce(strlen(text), 0) * 5000) / 1e6) AS DOUBLE) AS size_mb FROM documents")
def size_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the lengths are ties of the decimal quotient."""
    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") * 5000
    return table(spark, sf_dir, "documents").select("doc_id", content.size_mb(length).alias("size_mb"))


@query()
def encoding_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = F.substring(F.col("text").cast("binary"), 1, rules.SAMPLE_BYTES)
    return table(spark, sf_dir, "documents").select("doc_id", content.detect_encoding(sample).alias("encoding"))


# --- triage and manifest -------------------------------------------------------------


@query(f"SELECT lane, count(*) AS n_files, count(*) FILTER (WHERE status = 'pending') AS n_pending, CAST(sum(length) AS BIGINT) AS n_bytes FROM ({LANES_SQL}) GROUP BY lane ORDER BY n_bytes DESC, lane")
def lane_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.report(triage.assign(facts.files(spark, sf_dir))).select("lane", *_long("n_files", "n_pending", "n_bytes"))


@query(f"SELECT p_partkey, extension, lane FROM ({LANES_SQL})")
def lane_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.assign(facts.files(spark, sf_dir)).select("p_partkey", "extension", "lane")


@query(f"SELECT p_partkey, magic FROM ({FILES_SQL})")
def magic_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.files(spark, sf_dir).select("p_partkey", content.magic_extension(F.col("header")).alias("magic"))


@query(f"SELECT printf('%-12s | %4d files | %4d pending | %8.2f MB', lane, count(*), count(*) FILTER (WHERE status = 'pending'), CAST(printf('%.2f', sum(length) / 1e6) AS DOUBLE)) AS line FROM ({LANES_SQL}) GROUP BY lane")
def lane_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.lanes(triage.report(triage.assign(facts.files(spark, sf_dir))))


@query(f"SELECT doc_id, file_hash FROM ({CONTENTS_SQL})")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.contents(spark, sf_dir).select("doc_id", "file_hash")


_LAST_SQL = f"SELECT file_hash, path, length FROM (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY string_split(path, '/') DESC) AS rn FROM ({CONTENTS_SQL})) WHERE rn = 1"


@query(_LAST_SQL)
def manifest_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.last_by_path(facts.contents(spark, sf_dir)).select("file_hash", "path", "length")


@query(f"SELECT DISTINCT path, CAST(row_number() OVER (ORDER BY string_split(path, '/')) AS BIGINT) AS place FROM (SELECT url AS path FROM pages)")
def path_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each path in component order."""
    rows = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return order.places(rows, paths.path_key(F.col("path")))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier manifest: the contents of even documents, some converted."""
    last = triage.last_by_path(facts.contents(spark, sf_dir).where("doc_id % 2 = 0"))
    return manifest.conform(
        last.select(
            "file_hash", "path", F.lit("text").alias("lane"), F.when(F.col("doc_id") % 3 == 0, "processed").otherwise("pending").alias("status"),
            F.when(F.col("doc_id") % 4 == 0, "done").when(F.col("doc_id") % 4 == 2, "failed").alias("convert_status"),
            F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("/pdf/"), F.col("file_hash"), F.lit(".pdf"))).alias("converted_pdf"),
        )
    )


_KNOWN_SQL = f"""SELECT file_hash, path, 'text' AS lane, CASE WHEN doc_id % 3 = 0 THEN 'processed' ELSE 'pending' END AS status,
  CASE WHEN doc_id % 4 = 0 THEN 'done' WHEN doc_id % 4 = 2 THEN 'failed' END AS convert_status, CASE WHEN doc_id % 4 = 0 THEN '/pdf/' || file_hash || '.pdf' END AS converted_pdf
  FROM (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY string_split(path, '/') DESC) AS rn FROM ({CONTENTS_SQL}) WHERE doc_id % 2 = 0) WHERE rn = 1"""


@query(f"SELECT l.file_hash, l.path, CASE WHEN k.status = 'processed' THEN 'processed' ELSE 'pending' END AS status FROM ({_LAST_SQL}) l LEFT JOIN ({_KNOWN_SQL}) k USING (file_hash)")
def status_carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = facts.contents(spark, sf_dir).withColumn("header", F.substring(F.col("text").cast("binary"), 1, 16))
    return triage.entries(files, _known(spark, sf_dir)).select("file_hash", "path", "status")


@query(f"SELECT c.doc_id, c.file_hash FROM ({CONTENTS_SQL}) c WHERE NOT EXISTS (SELECT 1 FROM ({_KNOWN_SQL}) k WHERE k.file_hash = c.file_hash AND k.convert_status = 'done')")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _known(spark, sf_dir)
    existing = known.where("converted_pdf IS NOT NULL").select(F.col("converted_pdf").alias("path"))
    return manifest.pending_conversions(facts.contents(spark, sf_dir), known, existing).select("doc_id", "file_hash")


_UPDATES_SQL = f"SELECT file_hash, '/new' || path AS path, NULL AS converted_pdf, 'corrupt' AS convert_status FROM ({_LAST_SQL}) WHERE length % 3 = 0"


@query(f"""SELECT coalesce(k.file_hash, u.file_hash) AS file_hash, CASE WHEN u.file_hash IS NOT NULL THEN u.path ELSE k.path END AS path, CASE WHEN u.file_hash IS NOT NULL THEN 'pdf_from_doc' ELSE k.lane END AS lane,
  k.status, CASE WHEN u.file_hash IS NOT NULL THEN u.convert_status ELSE k.convert_status END AS convert_status, CASE WHEN u.file_hash IS NOT NULL THEN CAST(u.converted_pdf AS VARCHAR) ELSE k.converted_pdf END AS converted_pdf
  FROM ({_KNOWN_SQL}) k FULL JOIN ({_UPDATES_SQL}) u ON k.file_hash = u.file_hash""")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = triage.last_by_path(facts.contents(spark, sf_dir)).where("length % 3 = 0")
    updates = last.select("file_hash", F.concat(F.lit("/new"), "path").alias("path"), F.lit(rules.CONVERTED_LANE).alias("lane"), F.lit("corrupt").alias("convert_status"), F.lit(None).cast("string").alias("converted_pdf"))
    return manifest.merge(_known(spark, sf_dir), updates, manifest.OWNED["convert"]).select("file_hash", "path", "lane", "status", "convert_status", "converted_pdf")


@query(f"SELECT file_hash, path, CASE WHEN file_hash IN (SELECT file_hash FROM ({CONTENTS_SQL}) WHERE doc_id % 5 = 0) THEN 'processed' ELSE status END AS status FROM ({_KNOWN_SQL}) UNION ALL SELECT DISTINCT file_hash, NULL, 'processed' FROM ({CONTENTS_SQL}) WHERE doc_id % 5 = 0 AND file_hash NOT IN (SELECT file_hash FROM ({_KNOWN_SQL}))")
def mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = facts.contents(spark, sf_dir).where("doc_id % 5 = 0")
    return manifest.mark_processed(_known(spark, sf_dir), done).select("file_hash", "path", "status")


@query(f"SELECT file_hash, path, 'pending' AS status, CASE WHEN length % 2 = 0 THEN 'done' ELSE 'failed' END AS convert_status, CASE WHEN length % 3 = 0 THEN 'done' END AS ocr_status, CASE WHEN length % 2 = 0 THEN 'pdf_from_doc' ELSE 'other' END AS lane FROM ({_LAST_SQL})")
def manifest_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stages commit to a new manifest; each sets its own columns."""
    root = f"{storage.shared_folder(spark)}/corvidex/manifest-{uuid.uuid4().hex}"
    last = triage.last_by_path(facts.contents(spark, sf_dir))
    manifest.commit(triage.entries(facts.contents(spark, sf_dir).withColumn("header", F.substring(F.col("text").cast("binary"), 1, 16))), root, "triage")
    file_system, at = storage.hadoop(spark, root)
    file_system.deleteOnExit(at)
    even, third = F.col("length") % 2 == 0, F.col("length") % 3 == 0
    manifest.commit(last.select("file_hash", "path", F.when(even, "pdf_from_doc").otherwise("other").alias("lane"), F.when(even, "done").otherwise("failed").alias("convert_status"), F.lit(None).cast("string").alias("converted_pdf")), root, "convert")
    manifest.commit(last.select("file_hash", F.when(third, "done").alias("ocr_status"), F.lit(None).cast("string").alias("ocr_output")), root, "ocr")
    return manifest.load(spark, root).select("file_hash", "path", "status", "convert_status", "ocr_status", "lane")


@query(f"SELECT DISTINCT file_hash, path, 'text' AS lane, length AS n_bytes, CASE WHEN length % 2 = 0 THEN 'scanned=' || length % 9 END AS page_profile FROM ({CONTENTS_SQL})")
def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries kept as JSON objects by hash; absent keys are null."""
    rows = facts.contents(spark, sf_dir)
    entry = F.struct("path", F.lit("text").alias("lane"), F.col("length").alias("n_bytes"), F.when(F.col("length") % 2 == 0, F.create_map(F.lit("scanned"), (F.col("length") % 9).cast("int"))).alias("page_profile"))
    found = manifest.parse_json(rows.select(F.to_json(F.create_map("file_hash", entry)).alias("value")))
    pairs = F.transform(F.map_entries("page_profile"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.select("file_hash", "path", "lane", "n_bytes", F.array_join(pairs, ",").alias("page_profile")).distinct()


@query(f"SELECT file_hash, coalesce(nullif(converted_pdf, ''), path) AS path FROM ({_KNOWN_SQL}) WHERE file_hash IN (SELECT file_hash FROM ({CONTENTS_SQL}) WHERE length % 2 = 0)")
def ocr_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with scanned pages, by the path that can be used, if it exists."""
    known = _known(spark, sf_dir)
    profiles = facts.contents(spark, sf_dir).select("file_hash", F.when(F.col("length") % 2 == 0, F.create_map(F.lit("scanned"), F.lit(1))).otherwise(F.create_map(F.lit("slide_style"), F.lit(2))).alias("p")).groupBy("file_hash").agg(F.any_value("p").alias("p"))
    found = known.drop("page_profile").join(profiles, "file_hash", "left").withColumnRenamed("p", "page_profile")
    listing = known.select("path").unionByName(known.where("converted_pdf IS NOT NULL").select(F.col("converted_pdf").alias("path")))
    return ocr_operators.candidates(found, listing)


@query(f"SELECT file_hash, path, '' AS convert_status FROM ({_LAST_SQL})")
def replace_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole entries are replaced: nothing of the former ones is left."""
    new = triage.last_by_path(facts.contents(spark, sf_dir))
    return manifest.conform(new).select("file_hash", "path", F.coalesce("convert_status", F.lit("")).alias("convert_status"))


_ITEMS_SQL = f"SELECT file_hash, path, 'original' AS origin FROM ({_KNOWN_SQL}) WHERE hash_odd UNION ALL SELECT file_hash, converted_pdf, 'converted' FROM ({_KNOWN_SQL}) WHERE NOT hash_odd AND convert_status = 'done'"


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("file_hash").rlike("[13579bdf]$")
    return _known(spark, sf_dir).withColumn("lane", F.when(odd, "pdf").otherwise("word_legacy"))


_MIXED_SQL = f"(SELECT *, regexp_matches(file_hash, '[13579bdf]$') AS hash_odd FROM ({_KNOWN_SQL}))"


@query(_ITEMS_SQL.replace(f"({_KNOWN_SQL})", _MIXED_SQL))
def origin_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _mixed(spark, sf_dir)
    listing = mixed.select("path").unionByName(mixed.select(F.col("converted_pdf").alias("path")))
    return profile.items(mixed, listing)


@query("SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def path_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return manifest.existing_only(rows, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path")), "doc_id")


@query(f"SELECT file_hash, coalesce(nullif(converted_pdf, ''), path) AS usable FROM ({_KNOWN_SQL})")
def path_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _known(spark, sf_dir).select("file_hash", paths.usable_path(F.col("converted_pdf"), F.col("path")).alias("usable"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


# --- conversion --------------------------------------------------------------------------

_OK, _VALID = "o_orderstatus <> 'P'", "o_orderkey % 7 <> 0"


@query(f"SELECT CASE WHEN {_OK} AND {_VALID} THEN 'done' WHEN {_OK} THEN 'corrupt' ELSE 'failed' END AS status, count(*) AS n FROM orders GROUP BY 1")
def conversion_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    ok = convert.success(code, F.lit(True))
    return table(spark, sf_dir, "orders").groupBy(convert.status(ok, F.expr(_VALID)).alias("status")).agg(F.count("*").alias("n"))


@query(f"SELECT count(*) FILTER (WHERE {_OK}) AS n_valid, count(*) FILTER (WHERE NOT ({_OK})) AS n_failed, CAST(sum(o_orderkey % 100) AS DOUBLE) AS serial_s, sum(o_orderkey % 100) / 60 AS serial_min, sum(o_orderkey % 100) / 4 / 60 AS parallel_min, CAST(sum(o_orderkey % 1000) FILTER (WHERE {_OK}) AS BIGINT) AS text_chars FROM orders")
def conversion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "orders").select(F.expr(_OK).alias("valid"), (F.col("o_orderkey") % 100).cast("double").alias("seconds"), (F.col("o_orderkey") % 1000).alias("text_chars"))
    return convert.totals(results).select(*_long("n_valid", "n_failed"), "serial_s", "serial_min", "parallel_min", "text_chars")


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, length(text) - 299) ELSE text END AS tail FROM documents")
def error_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.error_tail(F.col("text"), rules.ERROR_TAIL).alias("tail"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS file_hash, count(*) FILTER (WHERE l_quantity = 50) = 0 AS valid, CASE WHEN count(*) FILTER (WHERE l_quantity = 50) > 0 THEN 0 ELSE count(*) END AS pages FROM lineitem GROUP BY l_orderkey")
def pdf_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("file_hash"), F.col("l_linenumber").alias("page_num"), F.col("l_shipdate").cast("string").alias("text"), F.when(F.col("l_quantity") == 50, "broken").alias("error"))
    return convert.validity(rows).select("file_hash", "valid", *_long("pages"))


# --- pages -----------------------------------------------------------------------------------


@query(f"SELECT class, count(*) AS n_pages, round(count(*) * 1e2 / sum(count(*)) OVER (), 6) AS percent FROM ({PAGES_SQL}) GROUP BY class")
def page_class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(_class_of(spark, sf_dir)).select("class", *_long("n_pages"), F.round("percent", 6).alias("percent"))


@query(f"SELECT origin, class, count(*) AS n_pages FROM ({PAGES_SQL}) GROUP BY origin, class ORDER BY origin, class")
def origin_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.by_origin(_class_of(spark, sf_dir))


@query(f"SELECT doc, string_agg(class || '=' || n, ',' ORDER BY class) AS page_profile, CAST(sum(n) AS INT) AS page_count FROM (SELECT doc, class, count(*) AS n FROM ({PAGES_SQL}) GROUP BY doc, class) GROUP BY doc")
def class_histogram_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.histograms(_class_of(spark, sf_dir), "doc")
    pairs = F.transform(F.map_entries("page_profile"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.select("doc", F.array_join(pairs, ",").alias("page_profile"), "page_count")


@query(f"SELECT doc, count(*) AS page_count, count(*) FILTER (WHERE text_chars < 100) AS scanned FROM ({PAGES_SQL}) GROUP BY doc HAVING count(*) FILTER (WHERE text_chars < 100) > 0")
def per_doc_scanned_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.histograms(_class_of(spark, sf_dir), "doc")
    return found.select("doc", F.col("page_count").cast("long").alias("page_count"), F.col("page_profile")["scanned"].cast("long").alias("scanned")).where("scanned > 0")


#: Partitions of the table function, each with many documents; they are dealt to tasks by hash.
_FOLD_BUCKETS = 4096


@query(f"""SELECT doc, CAST(n AS INT) AS page_count, profile AS page_profile, coalesce(run, 0) AS longest_scanned_run FROM (SELECT doc, sum(n) AS n, string_agg(class || '=' || n, ',' ORDER BY class) AS profile FROM (SELECT doc, class, count(*) AS n FROM ({LINES_SQL}) GROUP BY doc, class) GROUP BY doc)
  LEFT JOIN (SELECT doc, CAST(max(n) AS INT) AS run FROM (SELECT doc, g, count(*) AS n FROM (SELECT doc, class, page - row_number() OVER (PARTITION BY doc, class ORDER BY page) AS g FROM ({LINES_SQL})) WHERE class = 'scanned' GROUP BY doc, g) GROUP BY doc) USING (doc)""")
def folded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function ``fold_many_pages`` in SQL, over the pages of each document in their order.

    Pages cross the network once, by bucket: the grouping and the function need no other order of tasks.
    The least class of a page is found by its place in the alphabet, which is a number.
    """
    spark.udtf.register("fold_many_pages", register.fold_many_pages("doc", "bigint"))
    named = sorted(rules.PAGE_CLASSES)
    place = F.array_position(F.array(*map(F.lit, named)), F.col("class")).cast("int")
    _class_of(spark, sf_dir).select(F.pmod(F.hash("doc"), F.lit(_FOLD_BUCKETS)).alias("bucket"), "doc", "page", place.alias("place")).createOrReplaceTempView("corvidex_pages")
    classes = ", ".join(f"'{c}'" for c in named)
    one_class = f"SELECT doc, page, element_at(array({classes}), min(place)) AS class, bucket FROM (SELECT /*+ REPARTITION(bucket) */ * FROM corvidex_pages) GROUP BY bucket, doc, page"
    found = spark.sql(f"SELECT * FROM fold_many_pages(TABLE({one_class}) PARTITION BY bucket ORDER BY (doc, page))")
    pairs = F.transform(F.array_sort(F.map_entries("page_profile")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.select("doc", "page_count", F.array_join(pairs, ",").alias("page_profile"), "longest_scanned_run")


_PROFILES_SQL = f"""SELECT file, any_value(origin) AS origin, broken, string_agg(class || '=' || n, ',' ORDER BY class) AS page_profile, CAST(sum(n) AS INT) AS page_count, CAST(sum(images) AS BIGINT) AS n_images,
  CAST(sum(tables) AS BIGINT) AS n_tables, CAST(sum(chars) AS BIGINT) AS text_chars, CAST(sum(heads) AS BIGINT) AS headings
  FROM (SELECT file, any_value(origin) AS origin, broken, class, count(*) AS n, sum(n_images) AS images, sum(n_tables) AS tables, sum(text_chars) AS chars, sum(headings) AS heads FROM ({PAGE_FACTS_SQL}) GROUP BY file, broken, class) GROUP BY file, broken"""


@query(f"SELECT file, origin, broken AS failed, CASE WHEN NOT broken THEN page_profile END AS page_profile, CASE WHEN broken THEN 0 ELSE page_count END AS page_count, CASE WHEN broken THEN 0 ELSE n_images END AS n_images, CASE WHEN broken THEN 0 ELSE n_tables END AS n_tables, CASE WHEN broken THEN 0 ELSE text_chars END AS text_chars, CASE WHEN broken THEN 0 ELSE headings END AS headings FROM ({_PROFILES_SQL})")
def file_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and errors of each file in one pass over the facts."""
    found = profile.profiles(facts.page_facts(spark, sf_dir))
    pairs = F.transform(F.map_entries("page_profile"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.select(F.col("file_hash").alias("file"), "origin", F.col("error").isNotNull().alias("failed"), F.array_join(pairs, ",").alias("page_profile"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("page_count", "n_images", "n_tables", "text_chars", "headings")))


@query(f"SELECT count(*) AS n_files, count(*) FILTER (WHERE broken) AS n_failed, CAST(sum(page_count) FILTER (WHERE NOT broken) AS BIGINT) AS page_count, CAST(sum(n_images) FILTER (WHERE NOT broken) AS BIGINT) AS n_images, CAST(sum(n_tables) FILTER (WHERE NOT broken) AS BIGINT) AS n_tables, CAST(sum(text_chars) FILTER (WHERE NOT broken) AS BIGINT) AS text_chars FROM ({_PROFILES_SQL})")
def profile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.totals(profile.profiles(facts.page_facts(spark, sf_dir)))


@query(f"SELECT origin, class, CAST(count(*) AS BIGINT) AS n_pages FROM ({PAGE_FACTS_SQL}) WHERE NOT broken GROUP BY origin, class")
def origins_of_good_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.origins_of(profile.profiles(facts.page_facts(spark, sf_dir)))


@query(f"SELECT file, page, class, text_chars, n_images, n_tables, headings FROM ({PAGE_FACTS_SQL}) WHERE NOT broken")
def classified_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.classify(facts.page_facts(spark, sf_dir))
    return found.select(F.col("file_hash").alias("file"), F.col("page_num").alias("page"), "class", F.col("text_chars").cast("long").alias("text_chars"), "n_images", "n_tables", "headings")


@query(f"SELECT class, printf('%6d', count(*)) AS pages, printf('%.1f%%', count(*) * 100.0 / sum(count(*)) OVER ()) AS percent FROM ({PAGE_FACTS_SQL}) WHERE NOT broken GROUP BY class")
def page_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.page_classes(profile.classes_of(profile.profiles(facts.page_facts(spark, sf_dir))))


@query("SELECT printf('%d files, %d pages, confidence %.1f', count(*), CAST(sum(n) AS BIGINT), avg(c)) AS line FROM (SELECT user_id, count(*) AS n, avg(value) AS c FROM events GROUP BY user_id)")
def ocr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select("user_id", F.col("value").alias("confidence"))
    return reports.ocr(ocr_operators.run_confidence(ocr_operators.document_confidence(pages, "user_id")))


@query(f"SELECT printf('valid %d, failed %d', count(*) FILTER (WHERE {_OK}), count(*) FILTER (WHERE NOT ({_OK}))) AS counts, printf('serial %.1f min, parallel %.1f min', sum(o_orderkey % 100) / 60, sum(o_orderkey % 100) / 4 / 60) AS times FROM orders")
def conversion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "orders").select(F.expr(_OK).alias("valid"), (F.col("o_orderkey") % 100).cast("double").alias("seconds"))
    return reports.conversions(convert.totals(results))


_STRIP_SQL = r"length(regexp_replace(text, '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g'))"


@query(f"SELECT doc_id, {_STRIP_SQL} AS chars, CAST({_STRIP_SQL} < 10 AS INT) AS scanned_10, CAST({_STRIP_SQL} < 100 AS INT) AS scanned_100 FROM documents")
def scanned_thresholds_10_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = text.strip_length(F.col("text")).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", chars.alias("chars"), (chars < rules.BACKFILL_CHARS).cast("int").alias("scanned_10"), (chars < rules.SCANNED_CHARS).cast("int").alias("scanned_100"))


@query("SELECT vec_id, list_sort(s)[len(s) // 2 + 1] AS median, CAST(len(list_filter(s, lambda x: x > list_sort(s)[len(s) // 2 + 1] * 1.25)) AS INT) AS headings FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS s FROM embeddings)")
def upper_median_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("s"))
    return sizes.select("vec_id", page_functions.upper_median(F.col("s")).alias("median"), page_functions.larger_than_median(F.col("s")).alias("headings"))


@query("SELECT l_orderkey AS doc, CAST(sum(l_linenumber * l_quantity) / 1000 AS DOUBLE) AS ratio FROM lineitem GROUP BY l_orderkey")
def box_area_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("l_linenumber").cast("double").alias("x1"), F.col("l_quantity").cast("double").alias("y1"))
    boxes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(F.collect_list(box).alias("boxes"))
    return boxes.select("doc", page_functions.area_ratio(F.col("boxes"), F.lit(100.0), F.lit(10.0)).alias("ratio"))


@query(f"SELECT file_hash, map_keys(p)[1] AS class, CAST(map_values(p)[1] AS INT) AS n, page_count FROM (SELECT k.file_hash, MAP {{'scanned': count(*) FILTER (WHERE length(c.text) < 500)}} AS p, CAST(count(*) AS INT) AS page_count FROM ({_KNOWN_SQL}) k JOIN ({CONTENTS_SQL}) c USING (file_hash) WHERE k.convert_status = 'done' GROUP BY k.file_hash HAVING count(*) FILTER (WHERE length(c.text) < 500) > 0)")
def backfill_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = facts.contents(spark, sf_dir).select("file_hash", F.col("doc_id").alias("page_num"), "text", F.lit(None).cast("string").alias("error"))
    done = _known(spark, sf_dir).where("convert_status = 'done'")
    return profile.backfill(done, pages, 500).select("file_hash", F.explode("page_profile").alias("class", "n"), "page_count")


# --- recognition ------------------------------------------------------------------------------


@query("SELECT conv_id, turn, region, x0, y0, x1, y1, psm FROM (SELECT conv_id, turn, 100 + CAST(length(text) AS INT) AS h FROM conversations), LATERAL (VALUES ('heading', 0, 0, 50, h // 8, 5), ('body', 0, h // 8, 50, h * 7 // 8, 6), ('footer', 0, h * 7 // 8, 50, h, 12)) v(region, x0, y0, x1, y1, psm)")
def region_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.inline(ocr.regions(F.lit(50), F.length("text") + 100)))
    return rows.select("conv_id", "turn", "region", "x0", "y0", "x1", "y1", "psm")


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS combined_text FROM conversations WHERE text <> '' GROUP BY conv_id")
def combined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("r"))
    return found.select("conv_id", ocr.combined_text(F.col("r")).alias("combined_text"))


@query("SELECT vec_id, coalesce(list_avg(list_filter(list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 100) AS INT)), lambda x: x >= 0)), 0) AS confidence FROM embeddings")
def word_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = F.transform("embedding", lambda x: (x.cast("double") * 100).cast("string"))
    words = F.transform("embedding", lambda x: F.lit("w"))
    return table(spark, sf_dir, "embeddings").select("vec_id", ocr.confidence(words, conf).alias("confidence"))


@query(r"SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) AS INT) AS n_words, array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), chr(10)) AS page_text FROM documents")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("text", r"\s+")
    return table(spark, sf_dir, "documents").select("doc_id", ocr.word_count(words).alias("n_words"), ocr.page_text(words).alias("page_text"))


_PER_DOC_SQL = "SELECT user_id, count(*) AS n_pages, avg(value) AS confidence FROM events GROUP BY user_id"


@query(f"SELECT user_id, n_pages, round(confidence, 6) AS confidence FROM ({_PER_DOC_SQL})")
def document_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select("user_id", F.col("value").alias("confidence"))
    return ocr_operators.document_confidence(pages, "user_id").select("user_id", *_long("n_pages"), F.round("confidence", 6).alias("confidence"))


@query(f"SELECT count(*) AS n_files, CAST(sum(n_pages) AS BIGINT) AS n_pages, round(avg(confidence), 6) AS confidence FROM ({_PER_DOC_SQL})")
def macro_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select("user_id", F.col("value").alias("confidence"))
    return ocr_operators.run_confidence(ocr_operators.document_confidence(pages, "user_id")).select(*_long("n_files", "n_pages"), F.round("confidence", 6).alias("confidence"))


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(order)).where("rn = 1").select("user_id", "event_id", "value")


@query("SELECT CAST(conv_id AS VARCHAR) AS file_hash, count(*) AS total_pages, string_agg(turn || ':' || role, ',' ORDER BY turn) AS pages FROM conversations GROUP BY conv_id")
def ocr_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file_hash"), F.col("turn").alias("page_num"), "text", F.lit(0.0).alias("confidence"), F.col("role").alias("language"), F.lit(0).cast("long").alias("word_count"))
    source = rows.select("file_hash").distinct().withColumn("path", F.lit(""))
    docs = ocr_operators.documents(rows, source)
    pages = F.transform("ocr_results", lambda p: F.concat_ws(":", p["page_num"].cast("string"), p["language"]))
    return docs.select("file_hash", *_long("total_pages"), F.array_join(pages, ",").alias("pages"))
