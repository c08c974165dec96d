"""Closed itemsets against plain enumeration."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import defaultdict

import pytest

from corvidex.llm import basket_itemsets

LINES = "sale_id long, item_id long, flag string, support long, items string, basket string, key string"


def plain(lines, least=12, one_of=10_000, confidence=30):
    held = defaultdict(set)
    for sale, item, flag in lines:
        if sale is not None and item is not None and flag != "returned":
            held[sale].add(item)
    total, support = len(held), defaultdict(int)
    for found in held.values():
        for n in range(1, len(found) + 1):
            for c in itertools.combinations(sorted(found), n):
                support[c] += 1
    kept = {c: s for c, s in support.items() if s >= least and s * one_of >= total}
    out = set()
    for c, s in kept.items():
        if any(len(d) == len(c) + 1 and set(d) > set(c) and t == s for d, t in kept.items()):
            continue
        rules = [(i, support[tuple(x for x in c if x != i)], support[(i,)]) for i in c] if len(c) > 1 else []
        rules = [(i, a, b) for i, a, b in rules if 100 * s >= confidence * a and s * total > a * b]
        best = min(((a, i) for i, a, _ in rules), default=(None, None))[1]
        told = ";".join(f"{i}:{a}:{b}" for i, a, b in rules)
        out.add((",".join(map(str, c)), len(c), s, len(rules), best, hashlib.sha256(told.encode()).hexdigest()))
    return out


def frame(spark, lines):
    return spark.createDataFrame([(*x, 7, "x", "y", "z") for x in lines], LINES)


def same(spark, lines, **limits):
    found = basket_itemsets.digest(basket_itemsets.itemsets(frame(spark, lines), **limits)).collect()
    assert len(found) == len({r.items for r in found})
    assert {tuple(r) for r in found} == plain(lines, **limits)


def dealt(seed, sales=60, items=9, implied=True):
    """Baskets in which some items imply others, so that many sets are no keys; repeated rows, nulls and returns among them."""
    r, lines = random.Random(seed), []
    for sale in range(sales):
        held = {i for i in range(-2, items - 2) if r.random() < 0.45}
        if implied:
            held |= {i + 1 for i in held if i % 3 == 0} | ({0, 1, 2} if {3, 5} <= held else set())
        lines += [(sale, i, r.choice(("kept", None, "swapped"))) for i in held for _ in range(r.choice((1, 1, 2)))]
        lines += [(sale, r.randrange(items), "returned"), (None, 1, "kept"), (sale, None, "kept")]
    return lines


@pytest.mark.parametrize("seed", range(2))
def test_itemsets(spark, seed, monkeypatch):
    lines, seen, mine = dealt(seed, items=7), [], basket_itemsets.mine
    monkeypatch.setattr(basket_itemsets, "mine", lambda *a: seen.append(mine(*a)) or seen[-1])
    same(spark, lines, least=5)
    (mined,) = seen
    assert mined.sets.where("NOT key").count() > 10  # inferred or counted, but no keys
    assert mined.counted < max(len(r.items) for r in mined.sets.collect())  # the upper levels read no basket


def test_items_of_every_basket(spark):
    lines = [(s, i, "kept") for s, i, _ in dealt(5, 30, 6) if s is not None and i is not None and i != 4]
    lines += [(s, i, "kept") for s in {x[0] for x in lines} for i in (4, 100)]
    same(spark, lines, least=4)
    same(spark, [(s, i, None) for s in range(12) for i in (2, 10)], least=12)


def test_huge_basket(spark):
    """One basket with a third of all rows, and others above the rest; no limit drops their pairs."""
    lines = dealt(9, 40, 7) + [(1000, i, "kept") for i in range(-2, 400)] + [(1001 + k, i, "kept") for k in range(3) for i in range(-2, 12)]
    found = basket_itemsets.mine(basket_itemsets.baskets(frame(spark, lines)), 6)
    counter = basket_itemsets._Counter(basket_itemsets.baskets(frame(spark, lines)).selectExpr("basket", "item", "1L AS s"), 6)
    assert 0 < counter.n_large < 6 and counter.small.where("size(found) > 200").count() == 0
    expected = {c: s for c, s in supports(lines, range(-2, 12)).items() if s >= 6}
    assert {tuple(sorted(x["i"] for x in r["items"])): r.support for r in found.sets.collect() if all(x["i"] < 12 for x in r["items"])} == expected


def supports(lines, items):
    held, out = defaultdict(set), defaultdict(int)
    for sale, item, flag in lines:
        if sale is not None and item in items and flag != "returned":
            held[sale].add(item)
    for found in held.values():
        for n in range(1, len(found) + 1):
            for c in itertools.combinations(sorted(found), n):
                out[c] += 1
    return out


def test_share_and_empty(spark):
    same(spark, dealt(11, 80, 4), least=2, one_of=3)
    for lines in ([], [(None, 1, "kept"), (1, None, None), (1, 1, "returned")], [(1, 1, "kept")]):
        assert basket_itemsets.digest(basket_itemsets.itemsets(frame(spark, lines))).count() == 0
