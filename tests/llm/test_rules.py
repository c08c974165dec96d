"""The rule ensemble: statistics, the compiled expression, lasso weights and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from corvidex.llm import queries, rule_ensemble

from .test_simple import ODD


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(" ")]
    many = lambda chars: sum(c in chars for c in text)
    upper, lower, n, w = many(rule_ensemble._UPPER), many(rule_ensemble._LOWER), len(text) - many(rule_ensemble._SPACES), max(len(words), 1)
    return [
        len(words), n / w, max(map(len, words), default=0), upper / max(upper + lower, 1), (upper + lower) / max(n, 1), many(rule_ensemble._DIGITS) / max(n, 1),
        many(rule_ensemble._SYMBOLS) / w, many(rule_ensemble._BANGS) / w, many(rule_ensemble._STOPS) / w, math.log(len(set(words)) + 1) / math.log(w + 1), len(words) / max(len(lines), 1), (len(lines) - len(set(lines))) / max(len(lines), 1),
    ]


def test_statistics(docs):
    texts = [*ODD, "Straße ¡Ñ! 12 $$\n\nStraße", "x" * 3_000_000, "a b\n" * 100_000]
    rows = rule_ensemble.statistics(docs(texts, extra=True), "doc_id").collect()
    for r in rows:
        assert np.allclose(r.stats, plain_statistics(texts[r.doc_id])), r.doc_id


def made(n=600, seed=1):
    """Label 1 if the first statistic is small and the third is large; others are noise."""
    g = np.random.default_rng(seed)
    x = g.random((n, len(rule_ensemble.STATISTICS)))
    return x, ((x[:, 0] < 0.6) & (x[:, 2] > 0.3)).astype(float)


def test_sparse_rules():
    x, y = made()
    model = rule_ensemble.fit(x, y)
    other, truth = made(seed=2)
    p = 1 / (1 + np.exp(-(model.bias + sum(w * r.holds(other) for r, w in zip(model.rules, model.weights, strict=True)))))
    assert ((p >= 0.5) == truth).mean() > 0.95
    assert 0 < len(model.rules) < len(rule_ensemble.tree_rules(x, y)) / 2
    assert model.weights and rule_ensemble.fit(x, y) == model  # the same rows give the same model


def test_lasso_is_a_minimum():
    x, y = made(300)
    rules = rule_ensemble.tree_rules(x, y, trees=4)
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float)
    penalty = 0.02
    w = rule_ensemble.lasso(z, y, [0.05, penalty], rounds=5000)[-1]
    slope = z.T @ (1 / (1 + np.exp(-(z @ w[:-1] + w[-1]))) - y) / len(y)
    assert np.all(np.abs(slope[w[:-1] == 0]) <= penalty + 2e-3)
    used = w[:-1] != 0
    assert used.any() and np.allclose(slope[used], -penalty * np.sign(w[:-1][used]), atol=2e-3)


def test_compiled_expression(docs):
    x, y = made()
    model = rule_ensemble.fit(x, y)
    spark = docs([]).sparkSession
    rows = spark.createDataFrame([(row.tolist(),) for row in x[:200]], "stats array<double>")
    got = rows.select("stats", model.column(F.col("stats")).alias("p")).collect()
    for r in got:
        z = model.bias + sum(w * bool(rule.holds(np.array([r.stats]))[0]) for rule, w in zip(model.rules, model.weights, strict=True))
        assert abs(r.p - 1 / (1 + np.exp(-z))) < 1e-9


def test_held_out(spark, sf):
    rows = {r.doc_id: r for r in queries.op13_rule_ensemble(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = {i for i in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert {i for i, r in rows.items() if r.held_out} == out and len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    tried = out & set(labels)
    assert len(tried) > 10 and np.mean([rows[i].predicted == labels[i] for i in tried]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows.values())


def test_odd_input(spark, docs):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "same text"), (3, "same text"), (3, "another"), (4, "w" * 500_000)]
    some = docs(rows, extra=True)
    label = lambda values: spark.createDataFrame(values, "doc_id long, quality int, score string")
    for labels in ([], [(None, 1, "x"), (1, None, "x")], [(1, 1, "x"), (3, 1, "x")], [(1, 0, "x"), (3, 0, "x"), (3, 1, "y")]):
        model = rule_ensemble.learn(some, label(labels))
        found = rule_ensemble.score(some, model).collect()
        assert len(found) == len(rows) and all(0 < r.score < 1 for r in found)
        assert len({r.score for r in found if r.doc_id == 3}) <= 2
        if labels and all(q == 0 for i, q, _ in labels if i and q is not None) and any(q == 0 for _, q, _ in labels):
            assert all(r.predicted == 0 for r in found)
    assert rule_ensemble.score(docs([]), rule_ensemble.learn(docs([]), label([(1, 1, "x")]))).count() == 0
