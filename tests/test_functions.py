from __future__ import annotations

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from corvidex import rules
from corvidex.functions import content, ocr, pages, paths, register, text
from corvidex.plans import catalogue


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize("name", ["a.txt", ".bashrc", "a.tar.gz", "a.", "..a", "noext", "A.PDF", "x..y", "...", ".a.b", "a b.c d", "ä.Ü"])
def test_suffix_and_stem(spark, name):
    p = pathlib.PurePosixPath(name)
    last = name.rfind(".")
    want = name[last:].lower() if 0 < last < len(name) - 1 else ""
    assert one(spark, name, "string", paths.suffix) == want
    assert one(spark, name, "string", paths.stem) == (name[:last] if want else name)
    if name not in ("...", "..a"):  # versions of Python differ here
        assert p.suffix.lower() in (want, ".")


def test_path_order(spark):
    found = [r.p for r in spark.createDataFrame([(x,) for x in ("a-b", "a", "a/b", "a/B")], "p string").orderBy(paths.path_key(F.col("p"))).collect()]
    assert found == ["a", "a/B", "a/b", "a-b"]


@pytest.mark.parametrize(
    ("head", "want"),
    [(b"%PDF-1.7", ".pdf"), (bytes.fromhex("D0CF11E0A1B11AE100"), ".doc"), (b"PK\x03", ".docx"), (b"Rar!", ".rar"), (b"Rar!\x1a\x07", ".rar"), (b"SQLite format 3\0", ".db"), (b"\x89PNG\r\n\x1a\n", ".png"), (b"\xff\xd8\xff", ".jpg"), (b"ID3\x03", ".mp3"), (b"", "unknown"), (b"%PD", "unknown")],
)
def test_magic(spark, head, want):
    assert one(spark, bytearray(head), "binary", content.magic_extension) == want


def test_lane(spark):
    rows = spark.createDataFrame([(".pdf", b""), (".xyz", b"%PDF"), ("", b"PK"), ("", b"\xff\xd8"), (".xyz", b"zz"), ("", None)], "e string, h binary").select(content.lane(F.col("e"), F.col("h"))).collect()
    assert [r[0] for r in rows] == ["pdf", "pdf", "word_modern", "image", "unknown", "unknown"]


def test_encrypted(spark):
    data = [(".pdf", b"%PDF /Encrypt 3"), (".pdf", b"%PDF" + b" " * 1020 + b"/Encrypt"), (".txt", b"/Encrypt")]
    assert [r[0] for r in spark.createDataFrame(data, "e string, h binary").select(content.encrypted(F.col("e"), F.col("h"))).collect()] == [True, False, False]


@pytest.mark.parametrize("s", [" x　", "\x85x\x1c", "\x0bx y\t", "", "  ", "x\n\n"])
def test_strip(spark, s):
    assert one(spark, s, "string", text.strip) == s.strip()
    assert one(spark, s, "string", text.strip_length) == len(s.strip())


def test_error_tail(spark):
    assert one(spark, "x" * 10 + "y" * 300, "string", lambda c: text.error_tail(c, rules.ERROR_TAIL)) == "y" * 300


@pytest.mark.parametrize(("sizes", "want"), [([], None), ([3.0], 3.0), ([1.0, 2.0], 2.0), ([5.0, 1.0, 3.0], 3.0)])
def test_upper_median(spark, sizes, want):
    assert one(spark, sizes, "array<double>", pages.upper_median) == want


@pytest.mark.parametrize(
    ("chars", "image", "table", "has", "headings", "want"),
    [(99, 1.0, 1.0, True, 0, "scanned"), (100, 0.30, 0.0, False, 2, "slide_style"), (100, 0.2999, 0.0, False, 2, "text_structured"), (100, 0.30, 0.0, False, 3, "text_structured"), (799, 0.5, 0.0, False, 0, "slide_style"), (800, 0.5, 0.30, True, 0, "table_heavy"), (800, 0.5, 0.2999, True, 0, "text_with_tables")],
)
def test_page_class(spark, chars, image, table, has, headings, want):
    df = spark.createDataFrame([(chars, image, table, has, headings)], "c int, i double, t double, h boolean, n int")
    assert df.select(pages.page_class(F.col("c"), F.col("i"), F.col("t"), F.col("h"), F.col("n"))).first()[0] == want


def test_area_ratio_without_area(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    df = spark.createDataFrame([([(0.0, 0.0, 1.0, 1.0)], 0.0, 5.0), ([(0.0, 0.0, 2.0, 5.0), (0.0, 0.0, 2.0, 5.0)], 2.0, 5.0), (None, 2.0, 5.0)], f"b array<{box}>, w double, h double")
    assert [r[0] for r in df.select(pages.area_ratio(F.col("b"), F.col("w"), F.col("h"))).collect()] == [0.0, 2.0, 0.0]


def test_words(spark):
    df = spark.createDataFrame([([" a ", "", "b\n", "c"], ["95.9", "-1", "-1", "80"]), ([], []), ([" "], ["50"])], "t array<string>, c array<string>")
    got = df.select(ocr.page_text(F.col("t")), ocr.confidence(F.col("t"), F.col("c")), ocr.word_count(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("a\nb\nc", 87.5, 3), ("", 0.0, 0), ("", 0.0, 0)]


def test_regions(spark):
    rows = spark.createDataFrame([(101, 83)], "w int, h int").select(F.inline(ocr.regions(F.col("w"), F.col("h")))).collect()
    assert [(r.region, r.x0, r.y0, r.x1, r.y1, r.psm) for r in rows] == [("heading", 0, 0, 101, 83 // 8, 5), ("body", 0, 83 // 8, 101, 83 * 7 // 8, 6), ("footer", 0, 83 * 7 // 8, 101, 83, 12)]


def test_encoding(spark):
    data = [(b"plain",), ("grün".encode(),), ("grün ".encode() * 3)[:-3] and ("ü".encode()[:1],), (b"",), (None,)]
    got = [r[0] for r in spark.createDataFrame([(bytearray(x[0]) if x[0] is not None else None,) for x in data], "b binary").select(content.detect_encoding("b")).collect()]
    assert got[:2] == ["ascii", "utf-8"] and got[3:] == [None, None]


def test_fold_many_pages(spark):
    """As fold_pages, with documents over several batches and partitions, in any number of tasks."""
    rng = random.Random(5)
    rows = [(key, page, rng.choice(["scanned", "scanned", "slide_style", "table_heavy"])) for key in [None, *range(60)] for page in rng.sample(range(40), rng.choice([1, 2, 3, 30]))]
    rows += [(99, page, "scanned" if page != 7 else "table_heavy") for page in range(1, 200)] + [(98, None, "scanned")]
    spark.createDataFrame(rows, "doc long, page int, class string").createOrReplaceTempView("fold_test")
    register.register(spark)
    spark.udtf.register("fold_many_pages", register.fold_many_pages("doc", "bigint"))
    want = spark.sql("SELECT * FROM fold_pages(TABLE(fold_test) PARTITION BY doc ORDER BY page)").collect()
    assert {r.doc: r.longest_scanned_run for r in want}[99] == 192
    for batch in ("10000", "7", "1"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        found = spark.sql("SELECT * FROM fold_many_pages(TABLE(fold_test) PARTITION BY pmod(hash(doc), 3) ORDER BY (doc, page))").collect()
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(map(repr, map(_sorted_map, found))) == sorted(map(repr, map(_sorted_map, want)))


def _sorted_map(row):
    return row.doc, row.page_count, sorted(row.page_profile.items()), row.longest_scanned_run


def test_folded_pages_plan(spark, sf):
    """Pages are shuffled once, grouped by hash and folded in Arrow batches."""
    plan = spark._jvm.PythonSQLUtils.explainString(catalogue.QUERIES["folded_pages"](spark, sf)._jdf.queryExecution(), "simple")
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan and "ArrowEvalPythonUDTF" in plan


@pytest.mark.parametrize("s", ["x", " x", "x ", "xäö", "ä x ", "\x7f", "x\x1c", "　x　", "x\u0085", " ", "", "😀 😀".encode("utf-16", "surrogatepass").decode("utf-16"), None])
def test_strip_length_by_bytes(spark, s):
    assert one(spark, s, "string", text.strip_length) == (None if s is None else len(s.strip()))
    assert one(spark, s, "string", text.has_ink) == (None if s is None else bool(s.strip()))


def test_strip_length_looks_at_bytes_first(spark):
    """A character is counted from a text's end, a walk over all of it, only where the end bytes leave a doubt."""
    plan = spark._jvm.PythonSQLUtils.explainString(spark.range(1).select(F.repeat(F.lit("w"), F.col("id").cast("int")).alias("t")).select(text.strip_length(F.col("t")))._jdf.queryExecution(), "simple")
    assert -1 < plan.find("cast(t") < plan.find("RLIKE")
