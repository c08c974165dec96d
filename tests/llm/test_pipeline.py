"""The pipeline against a plain version."""

from __future__ import annotations

import random
import re

import pytest

import __spark_entry__
import corpus_pipeline
from corvidex.llm import queries, secret_scan

from .test_dedup import plain_join
from .test_simple import plain_contamination, plain_quality


def plain_kept(text):
    """The verdict of all quality rules, from their definitions."""
    text = text or ""
    n, chars, symbols, dup, _, base_failed = plain_quality(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    upper, lower, digits = (len(re.findall(f"[{c}]", text)) for c in ("A-Z", "a-z", "0-9"))
    long, bangs = sum(len(w.encode()) > 40 for w in words), sum("!!" in w for w in words)
    return not (
        base_failed or 5 * symbols > n or 2 * upper > upper + lower or (lines >= 4 and 100 * dup > 40 * lines) or 2 * digits > chars
        or (n > 0 and not 2 * n <= chars <= 20 * n) or 10 * long > 3 * n or 10 * bangs > 4 * n
    )


def test_pipeline(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [d for d in docs if plain_kept(d[1])]
    classes = plain_join(kept)
    kept = [(i, t) for i, t in kept if classes[i][0] == i]
    kept = [d for d, c in zip(kept, plain_contamination([t for _, t in kept], items), strict=True) if not c[4]]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in kept}
    assert len(kept) > 0.5 * len(docs)
    bins = {}
    for r in rows:
        bins[r.bin_id] = bins.get(r.bin_id, 0) + r.n_tokens
    assert max(bins.values()) <= 2048


def test_odd_documents(spark, sf, tmp_path):
    """Nulls, repeated rows and numbers, a long text, a secret and columns of clashing names go through all stages."""
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8))) for _ in range(n))
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = benchmark.where("text IS NOT NULL").first().text
    clean, long, secret, bad = text(120), text(30_000), text(80) + " password=hunter22hunter " + text(20), text(30) + " " + item + " " + item
    rows = [(1, clean), (1, clean), (2, None), (3, ""), (None, text(90)), (4, long), (5, secret), (6, bad), (7, clean + " more"), (8, "same " * 400)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, blob string, row string, class_id string, bin_id int")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame.columns
    left = sorted((r.doc_id or 0, len(r.text.split())) for r in docs.collect())
    assert left == [(0, 90), (1, 120), (4, 30_000), (5, 101)]
    assert "hunter22" not in "".join(r.text for r in docs.collect())
    total = {}
    for r in found:
        total[r.doc_id or 0] = total.get(r.doc_id or 0, 0) + r.n_tokens
    assert sorted(total.items()) == left


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_are_registered(name):
    assert name in __spark_entry__.queries()


def test_private_keys_go_whole(docs):
    body = "\n".join(["MIIEow/+" * 8] * 3 + ["QUJD=="])
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts = [f"a {head}\n{body}\n{end} z", f"a {head}\nProc-Type: 4,ENCRYPTED\n\n{body}\n{end} z", f"a {head}\n{body}\nthe text goes on", f"a {head} z"]
    got = {r.doc_id: r.text for r in secret_scan.redact(docs(texts)).collect()}
    assert got == {0: "a [SECRET] z", 1: "a [SECRET] z", 2: "a [SECRET]\nthe text goes on", 3: "a [SECRET] z"}
