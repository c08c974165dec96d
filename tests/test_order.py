"""Global places, and profiles in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvidex.functions import paths
from corvidex.operators import order, profile
from corvidex.plans import facts

from .test_storage import explained


def test_places(spark):
    """One host has most paths, one path most rows; places are those of a sorted list, and several tasks sort."""
    names = [f"https://hot.example/{k % 97}/{k}" for k in range(3000)] + ["https://hot.example/same"] * 2000 + ["a/B", "a-b", "", "a/b/c", "a"]
    rows = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "path string, __id int").repartition(5)
    found = order.places(rows, paths.path_key(F.col("path")))
    places = {r.place: r.path for r in found.collect()}
    want = sorted(names, key=lambda n: n.split("/"))
    assert [places[k + 1] for k in range(len(names))] == want
    tasks = order.places(rows, paths.path_key(F.col("path"))).groupBy(F.input_file_name()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.6 * len(names)
    assert "Window" not in explained(found) and order.places(rows.where("false"), F.col("path")).count() == 0


def test_profiles_scan_once(spark, sf):
    plan = explained(profile.profiles(facts.page_facts(spark, sf)))
    assert plan.count("Scan parquet") == 2 and "Join" not in plan  # the node and its details
    assert "partial_count_if" in plan or "partial_" in plan


def test_profiles_of_odd_files(spark):
    """Broken files carry their error, files without pages an empty profile, and null boxes count as none."""
    row = lambda h, n, text, error=None: (h, f"/{h}", "original", n, text, 10.0, 10.0, None, None, None, error)
    schema = "file_hash string, path string, origin string, page_num int, text string, width double, height double, images array<struct<x0:double,y0:double,x1:double,y1:double>>, tables array<struct<x0:double,y0:double,x1:double,y1:double>>, spans array<struct<size:double,text:string>>, error string"
    pages = spark.createDataFrame([row("a", 1, "x" * 99), row("a", 2, "y" * 100), row("b", 1, "z"), row("b", None, None, "damaged"), row("c", None, None), row("d", 1, None)], schema)
    found = {r.file_hash: r for r in profile.profiles(pages).collect()}
    assert found["a"].page_profile == {"scanned": 1, "text_structured": 1} and found["a"].page_count == 2 and found["a"].n_images == 0
    assert found["b"].error == "damaged" and found["b"].page_profile is None and found["b"].page_count is None
    assert found["c"].page_profile == {} and found["c"].page_count == 0 and found["d"].page_profile == {"scanned": 1}
    total = profile.totals(profile.profiles(pages)).first()
    assert (total.n_files, total.n_failed, total.page_count) == (4, 1, 3)
    assert [r.path for r in profile.failures(profile.profiles(pages)).collect()] == ["/b"]
    assert {(r.file_hash, r.page_num) for r in profile.classify(pages).collect()} == {("a", 1), ("a", 2), ("d", 1)}
    assert {r["class"]: r.n_pages for r in profile.classes_of(profile.profiles(pages)).collect()} == {"scanned": 2, "text_structured": 1}
    assert profile.totals(profile.profiles(pages.where("false"))).first().n_files == 0
