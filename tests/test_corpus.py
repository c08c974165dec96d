"""Files on disk through triage, conversion, profiles and recognition, with fakes for the external tools."""

from __future__ import annotations

import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from corvidex.adapters import office, pdf, tesseract
from corvidex.operators import convert, inventory, manifest, ocr, profile, reports, triage
from corvidex.sources import listing, recognized
from corvidex.streaming import ingest, progress

CONTENT = {"a.txt": b"hello", "sub/b.PDF": b"%PDF-1.7 /Encrypt", "sub/copy.txt": b"hello", ".hidden": b"x", "_under.md": "grün".encode(), "empty.txt": b"", "noext": b"PK\x03\x04", "old.doc": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1rest", "x/old.doc": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1other", "OLD.DOC": b"upper"}


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "raw"
    for name, data in CONTENT.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    return root


def test_listing_has_every_file(spark, folder):
    rows = {os.path.relpath(r.path, folder): r for r in listing.files(spark, str(folder), files_per_task=3).collect()}
    assert set(rows) == set(CONTENT)
    for name, data in CONTENT.items():
        assert rows[name].length == len(data) and rows[name].file_hash == hashlib.sha256(data).hexdigest() and bytes(rows[name].header) == data
    assert {r.name for r in listing.files(spark, str(folder), "*.doc").collect()} == {"old.doc"}
    assert listing.files(spark, str(folder / "sub"), "none").count() == 0
    assert {r.name for r in listing.binary_files(spark, str(folder)).collect()} == {"a.txt", "b.PDF", "copy.txt", "noext", "old.doc", "OLD.DOC"}


def test_unreadable_file(spark, folder, monkeypatch):
    os.symlink("/proc/self/mem", folder / "odd.txt")  # opens, but can't be read at its start
    row = listing.files(spark, str(folder), "odd.txt").first()
    assert row is None or row.error != ""


def test_inventory(spark, folder):
    info = inventory.file_info(listing.files(spark, str(folder)))
    by_name = {r.name: r for r in info.collect()}
    assert by_name["b.PDF"].is_encrypted and by_name["a.txt"].encoding == "ascii" and by_name["noext"].encoding == "unknown"
    grouped = inventory.by_extension(info)
    rows = grouped.collect()
    assert rows[0].ext == "(no ext)" and rows[-1].ext == "TOTAL" and rows[-1].n_files == len(CONTENT) and rows[-1].avg_mib is None
    assert sum(r.n_files for r in rows[:-1]) == len(CONTENT)
    table = reports.inventory(grouped).collect()
    assert table[-1].avg_size == "" and {r.format: r.encrypted for r in table}[".pdf"] == "🔒 1" and table[0].encrypted == "—"
    assert inventory.errors(info).count() == 0


def test_triage_is_idempotent_and_keeps_other_stages(spark, folder, tmp_path):
    files = listing.files(spark, str(folder))
    first = manifest.conform(triage.entries(files))
    assert first.count() == len(set(CONTENT.values()))
    same = {r.file_hash: r.path for r in first.collect()}
    assert same[hashlib.sha256(b"hello").hexdigest()].endswith("sub/copy.txt")  # the last path in component order
    root = str(tmp_path / "manifest")
    assert manifest.load(spark, root).count() == 0
    done = manifest.merge(first, first.select("file_hash", F.lit("done").alias("ocr_status"), F.lit("o").alias("ocr_output")), manifest.OWNED["ocr"])
    done = manifest.mark_processed(done, first.limit(1))
    manifest.save(done, root)
    again = manifest.load(spark, root)
    merged = manifest.merge(again, triage.entries(files, again), manifest.OWNED["triage"])
    assert merged.count() == first.count()
    assert merged.where("status = 'processed'").count() == 1 and merged.where("ocr_status = 'done'").count() == first.count()
    manifest.save(merged, root)
    assert manifest.load(spark, root).count() == first.count()
    lanes = triage.report(triage.assign(files).withColumn("status", F.lit("pending")))
    assert lanes.agg(F.sum("n_files")).first()[0] == len(CONTENT)
    assert reports.lanes(lanes).count() == lanes.count()


def test_manifest_json(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"h1": {"path": "/a", "lane": "pdf", "page_profile": {"scanned": 2}, "page_count": 3}, "h2": {"path": "/b", "page_profile": {}}, "h3": {"convert_status": "done"}}))
    rows = {r.file_hash: r for r in manifest.import_json(spark, str(path)).collect()}
    assert rows["h1"].page_profile == {"scanned": 2} and rows["h2"].page_profile == {} and rows["h3"].page_profile is None
    out = str(tmp_path / "out")
    manifest.export_json(manifest.import_json(spark, str(path)), out)
    assert "ocr_status" not in "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part"))


def fake_convert(path, output, slot, timeout):
    data = open(path, "rb").read()
    if data.endswith(b"other"):
        return 1, b"broken " + b"x" * 400
    os.makedirs(os.path.dirname(output), exist_ok=True)
    open(output, "wb").write(b"%PDF")
    return 0, b""


def fake_pages(path):
    if path.endswith("b.PDF"):
        raise ValueError("bad page")
    yield {"text": "", "width": 10.0, "height": 10.0, "images": [], "tables": [], "spans": []}
    yield {"text": "w" * 200, "width": 10.0, "height": 10.0, "images": [], "tables": [{"x0": 0.0, "y0": 0.0, "x1": 5.0, "y1": 10.0}], "spans": [{"size": 10.0, "text": "a"}, {"size": 20.0, "text": "b"}]}


def test_convert_and_profile(spark, folder, tmp_path):
    files = listing.files(spark, str(folder), "*.doc")
    out = str(tmp_path / "pdf")
    pending = manifest.pending_conversions(files, manifest.empty(spark), spark.createDataFrame([], "path string"))
    assert pending.count() == 2
    done = convert.run(pending, fake_convert, os.path.exists, out).cache()
    rows = {os.path.basename(os.path.dirname(r.path)): r for r in done.collect()}
    assert rows["raw"].success and not rows["x"].success and rows["x"].attempts == 2 and len(rows["x"].error) == 300
    facts = pdf.page_facts(done.where("success").select("file_hash", F.col("output").alias("path"), F.lit("converted").alias("origin")), fake_pages)
    entries = convert.entries(done, convert.validity(facts))
    assert {r.convert_status for r in entries.collect()} == {"done", "failed"}
    book = manifest.merge(manifest.conform(triage.entries(listing.files(spark, str(folder)))), entries, manifest.OWNED["convert"])
    assert book.where("lane = 'pdf_from_doc'").count() == 2
    existing = spark.createDataFrame([(rows["raw"].output,)], "path string")
    assert manifest.pending_conversions(files, book, existing).count() == 1
    items = profile.items(book, existing.unionByName(listing.files(spark, str(folder)).select("path")))
    assert {(r.origin) for r in items.collect()} == {"original", "converted"}
    pages = pdf.page_facts(items, fake_pages)
    classes = profile.classify(pages)
    assert sorted(r["class"] for r in classes.collect()) == ["scanned", "table_heavy"]  # the broken file has none
    assert {r.headings for r in classes.collect()} == {0}
    assert [r.percent for r in profile.distribution(classes).collect()] == [50.0, 50.0]
    found = profile.entries(pages).collect()
    assert len(found) == 1 and found[0].page_profile == {"scanned": 1, "table_heavy": 1} and found[0].page_count == 2
    assert reports.page_classes(profile.distribution(classes)).first().percent == "50.0%"
    weaker = profile.backfill(book, pages).collect()
    assert [(r.page_profile, r.page_count) for r in weaker] == [({"scanned": 1}, 2)]  # the entry had no profile yet
    total = convert.totals(done.withColumn("valid", F.col("success"))).first()
    assert (total.n_valid, total.n_failed) == (1, 1)
    assert convert.failures(done.withColumn("valid", F.col("success"))).count() == 1


def test_backfill_and_empty_profile(spark):
    m = manifest.conform(spark.createDataFrame([("h1", "/a.pdf", None), ("h2", "/b.pdf", {}), ("h3", "/c.doc", None)], "file_hash string, path string, page_profile map<string,int>"))
    facts = spark.createDataFrame([(h, n, t, None) for h in ("h1", "h2", "h3") for n, t in ((1, "123456789"), (2, "1234567890"), (3, "   "))], "file_hash string, page_num int, text string, error string")
    rows = profile.backfill(m, facts).collect()
    assert [(r.file_hash, r.page_profile, r.page_count) for r in rows] == [("h1", {"scanned": 2}, 3)]


def test_missing_tools():
    with pytest.raises(RuntimeError):
        office.find_tool(("no-such-tool",))
    with pytest.raises((RuntimeError, ImportError)):
        list(pdf.open_with_pymupdf("/none"))


def fake_words(path):
    yield {"text": ["a", " ", "b"], "conf": ["90", "-1", "70.9"]}
    yield {"text": [], "conf": []}


def fake_regions(path):
    yield [("heading", " T "), ("body", "x\n"), ("footer", " ")]


def test_recognition(spark, tmp_path):
    m = manifest.conform(spark.createDataFrame([("h1", "/a.pdf", {"scanned": 1}), ("h2", "/b.pdf", {"table_heavy": 1}), ("h3", "/gone.pdf", {"scanned": 1})], "file_hash string, path string, page_profile map<string,int>"))
    chosen = ocr.candidates(m, spark.createDataFrame([("/a.pdf",), ("/b.pdf",)], "path string"))
    pages = ocr.page_records(tesseract.words(chosen, fake_words))
    assert [(r.page_num, r.text, r.confidence, r.word_count) for r in pages.orderBy("page_num").collect()] == [(1, "a\nb", 80.0, 2), (2, "", 0.0, 0)]
    layout = ocr.layout_records(tesseract.regions(chosen, fake_regions)).first()
    assert layout.combined_text == "T\n\nx" and len(layout.regions) == 2
    docs = ocr.documents(pages, chosen)
    recognized.write(docs, str(tmp_path / "json"))
    assert os.listdir(tmp_path / "json") == ["h1_ocr.json"]
    back = recognized.documents(spark, str(tmp_path / "json"))
    assert ocr.explode_documents(back).count() == 2 and back.first().total_pages == 2
    per = ocr.document_confidence(ocr.explode_documents(back))
    assert per.first().confidence == 40.0
    run = ocr.run_confidence(per)
    assert reports.ocr(run).first().line == "1 files, 2 pages, confidence 40.0"
    assert ocr.run_confidence(per.where("false")).first().confidence == 0.0
    assert ocr.entries(docs, "/o").first().ocr_output == "/o/h1_ocr.json"


def test_macro_mean_differs_from_page_mean(spark):
    pages = spark.createDataFrame([("a", 90.0), ("a", 0.0), ("b", 80.0)], "file_hash string, confidence double")
    assert ocr.run_confidence(ocr.document_confidence(pages)).first().confidence == 62.5


def test_stream(spark, folder, tmp_path):
    """Three runs over a growing tree: every file counts, known contents keep their status and get their last path."""
    root, check = str(tmp_path / "m"), str(tmp_path / "c")
    run = lambda: ingest.run(spark, str(folder), root, check)
    run()
    n = manifest.load(spark, root).count()
    assert n == len(set(CONTENT.values()))
    manifest.save(manifest.mark_processed(manifest.load(spark, root), manifest.load(spark, root)), root)
    (folder / "new.txt").write_bytes(b"new")
    (folder / "again.txt").write_bytes(b"hello")
    run()
    rows = manifest.load(spark, root)
    assert rows.count() == n + 1 and rows.where("status = 'pending'").count() == 1
    (folder / "zzz.txt").write_bytes(b"hello")  # a later path of a known content
    (folder / "a.txt").write_bytes(b"changed")
    run()
    found = {r.file_hash: r for r in manifest.load(spark, root).collect()}
    hello = found[hashlib.sha256(b"hello").hexdigest()]
    assert hello.path.endswith("/zzz.txt") and hello.status == "processed" and len(found) == n + 2
    run()  # nothing new
    (folder / "last.txt").write_bytes(b"last")
    with progress.Progress(spark) as seen:
        run()
        for _ in range(100):  # events come a moment later
            if seen.files and not seen.running:
                break
            time.sleep(0.1)
    assert (seen.files, seen.batches, seen.failed, seen.running) == (1, 1, 0, 0) and seen.contents > n
    found[hashlib.sha256(b"last").hexdigest()] = manifest.load(spark, root).where("path LIKE '%/last.txt'").first()
    assert {h: r.path for h, r in found.items()} == {r.file_hash: r.path for r in manifest.load(spark, root).collect()}


def test_stream_after_a_crash(spark, folder, tmp_path, monkeypatch):
    """A batch that fails after its commit is run again from the log, though the tree has changed, and gives the same manifest."""
    root, check = str(tmp_path / "m"), str(tmp_path / "c")
    commit = manifest.commit

    def crash(*args):
        commit(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(manifest, "commit", crash)
    with pytest.raises(Exception, match="lost"):
        ingest.start(spark, str(folder), root, check).awaitTermination(120)
    monkeypatch.setattr(manifest, "commit", commit)
    before = {r.file_hash: (r.path, r.lane, r.status) for r in manifest.load(spark, root).collect()}
    (folder / "late.txt").write_bytes(b"late")
    assert ingest.run(spark, str(folder), root, check) == 2
    after = {r.file_hash: (r.path, r.lane, r.status) for r in manifest.load(spark, root).collect()}
    assert after.pop(hashlib.sha256(b"late").hexdigest())[1] == "text" and after == before


def test_json_files(spark, tmp_path):
    """One file for each hash, equal when read back; a failed write leaves no partial file."""
    page = "array<struct<text:string,confidence:double,language:string,page_num:long,word_count:long>>"
    rows = [(f"{k:064x}", f"/p{k}.pdf", [(f"ä {k}", 1.5, "eng", 1, 2)] * (k % 4), k % 4) for k in range(50)]
    docs = spark.createDataFrame(rows, f"file_hash string, source_pdf string, ocr_results {page}, total_pages long").repartition(4)
    folder = str(tmp_path / "json")
    for _ in range(2):  # again: the same files
        recognized.write(docs, folder)
        assert sorted(os.listdir(folder)) == [f"{r[0]}_ocr.json" for r in rows]
    assert sorted(map(tuple, recognized.documents(spark, folder).collect())) == sorted(map(tuple, docs.collect()))
    broken = docs.withColumn("file_hash", F.when(F.col("total_pages") == 3, F.raise_error("bad").cast("string")).otherwise(F.concat(F.lit("x"), "file_hash")))
    with pytest.raises(Exception, match="bad"):
        recognized.write(broken, folder)
    assert all(json.load(open(os.path.join(folder, n))) for n in os.listdir(folder)) and not any(n.startswith(".") for n in os.listdir(folder))


def bad_slot(path, output, slot, timeout):
    """The first task's tool is broken, and one file can't be converted."""
    if slot == 0 or path.endswith("never.doc"):
        return 1, b"out of order"
    os.makedirs(os.path.dirname(output), exist_ok=True)
    open(output, "wb").write(b"%PDF")
    return 0, b""


def test_rounds(spark, tmp_path):
    """What a broken task fails is done by another one in the next round; progress comes from the running jobs."""
    files = spark.createDataFrame([(f"h{k}", f"/f{k}.doc") for k in range(40)] + [("bad", "/never.doc")], "file_hash string, path string")
    told = []
    rows = {r.file_hash: r for r in convert.run(files, bad_slot, os.path.exists, str(tmp_path / "o"), workers=3, retries=2, progress=told.append).collect()}
    assert len(rows) == 41 and all(r.success for h, r in rows.items() if h != "bad") and not rows["bad"].success and rows["bad"].attempts == 3
    again = [r for r in rows.values() if r.success and r.attempts == 2]
    assert again and all([a.slot for a in r.history][0] == 0 != r.history[1].slot and r.history[0].error == "out of order" for r in again)
    assert [t.round for t in told] == [1, 2, 3] and told[-1] == (3, 40, 1, 0) and told[0].done + told[0].failed == 41 and told[0].pending == told[0].failed
    assert convert.run(files.where("false"), bad_slot, os.path.exists, str(tmp_path / "o")).count() == 0


def test_command_line(spark, folder, tmp_path, capsys):
    from corvidex.__main__ import main

    main(["inventory", str(folder)])
    main(["triage", str(folder), "--manifest", str(tmp_path / "m")])
    main(["triage", str(folder), "--manifest", str(tmp_path / "m")])
    main(["ingest", str(folder), "--manifest", str(tmp_path / "m2"), "--checkpoint", str(tmp_path / "c")])
    said = capsys.readouterr().out
    assert "TOTAL" in said and "word_legacy" in said and f"{len(set(CONTENT.values()))} contents" in said
    assert manifest.load(spark, str(tmp_path / "m")).count() == len(set(CONTENT.values()))
    with pytest.raises(SystemExit):
        main(["triage", str(folder)])
    with pytest.raises(SystemExit):
        main(["ingest", str(folder), "--manifest", str(tmp_path / "m2")])


def test_functions_for_sql(spark):
    from corvidex.functions.register import register

    register(spark, fake_pages)
    assert spark.sql("SELECT corpus_encoding(X'6162')").first()[0] == "ascii"
    rows = spark.sql("SELECT f.path, p.page_num, length(p.text) AS n FROM VALUES ('/a.pdf') AS f(path), LATERAL page_texts(f.path) p ORDER BY 2").collect()
    assert [(r.page_num, r.n) for r in rows] == [(1, 0), (2, 200)]
