"""Listings in tasks, filters in the source, and commits of several writers."""

from __future__ import annotations

import hashlib
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from corvidex.operators import inventory, manifest
from corvidex.sources import crawl, listing, stores
from corvidex.storage import versions


def explained(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def opened(paths) -> set:
    """Files that were read since ``untouched``: their times of access changed."""
    return {p for p in paths if os.stat(p).st_atime > 2}


def untouched(paths) -> None:
    for p in paths:
        os.utime(p, (1, os.stat(p).st_mtime))


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "raw"
    for k in range(60):
        p = root / f"d{k % 5}" / f".h{k % 3}" / f"f{k}{('.pdf', '.TXT', '', '.doc')[k % 4]}"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * k)
    (root / "none").mkdir()
    os.symlink(root, root / "d0" / "loop")
    os.symlink(root / "d1", root / "d2" / "link")
    os.symlink(root / "d0/.h0/f0.pdf", root / "file-link.pdf")
    return root


def walked(root):
    return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if os.path.isfile(os.path.join(d, n))}


def test_listing_equals_a_walk(spark, tree):
    rows = crawl.entries(spark, str(tree)).collect()
    assert {r.path for r in rows} == walked(tree) and len(rows) == 61
    assert all(r.length == os.stat(r.path).st_size and r.extension == os.path.splitext(r.name)[1].lower() for r in rows if not r.name.startswith("."))
    assert {r.path for r in crawl.entries(spark, f"file://{tree}/d1").collect()} == walked(tree / "d1")
    assert crawl.entries(spark, str(tree / "none")).count() == 0 == crawl.entries(spark, str(tree / "absent")).count()
    # Arrow's file systems, as for object stores, find the same below one folder.
    store = stores.Arrow(f"file://{tree}/d1/.h1")
    found = {(x.name, x.length) for x in store.children(f"file://{tree}/d1/.h1")}
    assert found == {(n, os.stat(tree / "d1/.h1" / n).st_size) for n in os.listdir(tree / "d1/.h1")}
    first = sorted(store.children(f"file://{tree}/d1/.h1"))[0]
    with store.open(first.path) as f:
        assert f.read() == (tree / "d1/.h1" / first.name).read_bytes()


def test_large_tree(spark, tmp_path):
    """10^5 files: the driver gets names of listing parts only, and reads no file."""
    for d in range(200):
        folder = tmp_path / "big" / f"{d % 20}" / f"{d}"
        folder.mkdir(parents=True)
        for k in range(500):
            os.close(os.open(folder / f"{k}.txt", os.O_CREAT))
    rows = listing.files(spark, str(tmp_path / "big"), columns=("path", "length"))
    assert rows.agg(F.count("*"), F.countDistinct("path")).first()[:] == (100_000, 100_000)
    reader = listing._Reader({"listing": ",".join(crawl.parts(spark, str(tmp_path / "big")))}, rows.schema)
    assert 100_000 / crawl.PART <= len(reader.partitions()) < 100


def test_filters_and_columns_reach_the_source(spark, tree):
    paths = walked(tree)
    probe = tree / "probe"
    probe.write_bytes(b"x")
    untouched([probe])
    probe.read_bytes()
    if not opened([probe]):
        pytest.skip("this file system keeps no times of access")
    probe.unlink()
    pdfs = {p for p in paths if p.endswith(".pdf") and os.stat(p).st_size > 20 and not os.path.islink(p)}
    untouched(paths)
    rows = listing.files(spark, str(tree)).where("extension = '.pdf' AND length > 20 AND NOT path LIKE '%link.pdf'")
    got = rows.select("path", "file_hash").collect()
    assert {r.path for r in got} == pdfs == opened(paths)
    assert all(r.file_hash == hashlib.sha256(open(r.path, "rb").read()).hexdigest() for r in got)
    plan = explained(rows)  # the source has taken all of them
    assert "Condition" not in plan and "EqualTo(extension,.pdf), GreaterThan(length,20), Not(StringEndsWith(path,link.pdf))" in plan
    untouched(paths)
    listing.files(spark, str(tree), columns=("path", "extension", "length", "modified")).collect()
    assert not opened(paths)
    assert listing.files(spark, str(tree)).where("name IN ('f1.TXT', 'f2') OR length = 59").count() == 3  # not for the source alone
    assert listing.files(spark, str(tree)).where("modified > '2001-01-01' AND modified < '2100-01-01' AND extension <> ''").count() == 46


def test_inventory_scans_once_and_hashes_nothing(spark, tree):
    info = inventory.file_info(listing.files(spark, str(tree), columns=inventory.COLUMNS))
    plan = explained(info)
    assert plan.count("BatchScan") == 2 and "Union" not in plan  # once in the tree of the plan, once in its details
    assert "file_hash" not in plan
    assert {r.encoding for r in info.where("extension = '.txt'").collect()} == {"ascii"} and info.where("encoding = 'unknown'").count() == 46


# --- commits --------------------------------------------------------------------------


def some(spark, hashes, **values):
    rows = spark.createDataFrame([(h,) for h in hashes], "file_hash string")
    return rows.select("file_hash", *(F.lit(v).alias(k) for k, v in values.items()))


def test_two_stages_at_once_keep_both_columns(spark, tmp_path):
    root, hashes = str(tmp_path / "m"), [f"h{k}" for k in range(40)]
    manifest.commit(some(spark, hashes, path="/p", lane="pdf", size_mb=1.0, n_bytes=1, status="pending", triaged_at=None), root, "triage")
    ocr, profile = some(spark, hashes[:30], ocr_status="done", ocr_output="o"), some(spark, hashes[10:] + ["new"], page_count=3).withColumn("page_profile", F.create_map(F.lit("scanned"), F.lit(3)))
    gate, failed = threading.Barrier(2), []

    def write(rows, stage, waits):
        try:
            # Both have read version 1 and merged when the first of them publishes.
            manifest.store(spark, root).commit(rows, manifest.OWNED[stage], before_publish=lambda: gate.wait(60) if waits.pop(0) else None)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(r, s, [True, False, False])) for r, s in ((ocr, "ocr"), (profile, "profile"))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert not failed
    store = manifest.store(spark, root)
    assert store.version().number == 3
    rows = {r.file_hash: r for r in store.read().collect()}
    assert len(rows) == 41 and sum(r.ocr_status == "done" for r in rows.values()) == 30 and sum(r.page_count == 3 for r in rows.values()) == 31
    assert rows["h20"].path == "/p" and rows["h20"].ocr_output == "o" and rows["h20"].page_profile == {"scanned": 3} and rows["new"].path is None
    assert {r.file_hash for r in store.read(store.version(1)).collect()} == set(hashes)  # old readers see their version


def test_commit_rewrites_only_what_it_touches(spark, tmp_path):
    store = manifest.store(spark, str(tmp_path / "m"), buckets=8)
    store.commit(some(spark, [f"h{k}" for k in range(200)], ocr_status="a", ocr_output="b"), manifest.OWNED["ocr"])
    first = store.version()
    store.commit(some(spark, ["h7"], ocr_status=None, ocr_output="c"), manifest.OWNED["ocr"])
    second = store.version()
    assert sum(first.folders[b] != second.folders[b] for b in range(8)) == 1
    rows = {r.file_hash: r for r in store.read().collect()}
    assert len(rows) == 200 and rows["h7"].ocr_status is None and rows["h7"].ocr_output == "c" and rows["h8"].ocr_output == "b"
    updates = some(spark, ["h7", "x"], ocr_status="d", ocr_output="e")
    plan = explained(store.merged(store.read(), updates, manifest.OWNED["ocr"], True))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    by_shuffle = store.commit(updates, manifest.OWNED["ocr"], broadcast_bytes=0)  # updates above the bound
    assert by_shuffle.number == 3 and store.read().where("ocr_output = 'e'").count() == 2 and store.read().count() == 201


def test_replace_vacuum_and_conflicts(spark, tmp_path):
    root = str(tmp_path / "m")
    store = manifest.store(spark, root, buckets=4)
    assert store.read().count() == 0 and store.version().number == 0
    for k in range(3):
        store.replace(manifest.conform(some(spark, [f"h{x}" for x in range(20 - k)], path=f"/{k}")))
    assert store.version().number == 3 and store.read().count() == 18
    stale = store.version(2)
    with pytest.raises(versions.Conflict):
        store.replace(store.read(), on=stale)
    os.makedirs(f"{root}/data-orphan/bucket=0")  # of a writer that crashed
    assert store.vacuum(keep=2) == ["version-000000000001.json"]  # the folders are too young
    time.sleep(0.01)
    assert "data-orphan" in store.vacuum(keep=2, older_s=0)
    assert store.numbers() == [2, 3] and store.read().count() == 18 and store.read(store.version(2)).count() == 19
    store.commit(some(spark, [], ocr_status="x", ocr_output="y"), manifest.OWNED["ocr"])
    assert store.version().number == 4 and store.read().count() == 18
