"""Spelling variants against every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corvidex.llm import spelling_variants


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(b) != len(a) + 1:
        return False
    k = next((k for k, x in enumerate(a) if b[k] != x), len(a))  # removing a later one leaves the difference
    return b[k + 1 :] == a[k:]


def plain(rows, slip=199, least_times=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % slip == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= least_times}
    forms, out = {}, {}
    for w, c in n.items():
        found = sorted((v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)), key=lambda v: (-n[v], v))
        forms[w] = found[0] if found and n[found[0]] >= 5 * c else None
        out[w] = len(found)
    def root(w):
        return root(forms[w]) if forms[w] else w
    return sorted((w, forms[w], root(w), n[w], out[w], n.get(forms[w])) for w in n)


def same(docs, rows, **sizes):
    expected = plain(rows, sizes.get("slip", 199), sizes.get("least_times", 5))
    assert sorted(map(tuple, spelling_variants.variants(docs(rows, extra=True), **sizes).collect())) == expected
    return expected


def spoil(r, w):
    k, c = r.randrange(len(w)), r.choice("abéÿ×")
    return r.choice((w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]))


def made(seed, words=40, letters="abcdéÀ", longest=60):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.choice((6, 7, 8, 12, 39, 40, 41, longest)))) for _ in range(words)]
    bag = []
    for w in base:
        bag += [w] * r.choice((5, 30, 200))
        for _ in range(4):
            bag += [spoil(r, w)] * r.choice((4, 5, 6, 40))
    r.shuffle(bag)
    return [(k, " ".join(bag[k::7]).title() if k % 2 else "-".join(bag[k::7])) for k in range(7)]


@pytest.mark.parametrize("seed", range(2))
def test_variants(docs, seed):
    expected = same(docs, made(seed))
    assert sum(x[4] > 0 for x in expected) > 50 and any(x[1] for x in expected)


def test_many_shards_and_parts(docs):
    """Small parts give the same rows; a hot head is shared by all words."""
    same(docs, made(3, letters="ab", longest=90), slip=2, shard_words=9, shard_chars=150, scan_words=20)
    r = random.Random(1)
    same(docs, [(k, " ".join("prefix" + "".join(r.choice("abc") for _ in range(6)) for _ in range(500))) for k in range(2)], least_times=1, shard_words=100, scan_words=150)


def test_chains_and_ties(docs):
    words = {"wordaaaa": 5, "wordaaab": 25, "wordaabb": 125, "wordabbb": 625, "wordaaba": 25, "single": 7, "xxxxxx": 5, "xxxxx": 90, "yyyyyyz": 5, "yyyyyy": 30, "yyyyyya": 30}
    expected = {x[0]: x for x in same(docs, [(1, " ".join(w for w, n in words.items() for _ in range(n)))], slip=10**12)}
    assert expected["wordaaaa"][1:3] == ("wordaaab", "wordabbb")  # of equal ones the first; the chain goes on
    assert expected["xxxxxx"][4] == 0 and "xxxxx" not in expected  # five code points are no word


def test_one_edit():
    r = random.Random(5)
    for n, m in ((6, 6), (6, 7), (7, 6), (9, 9)):
        a, b = (["".join(r.choice("ab") for _ in range(k)) for _ in range(80)] for k in (n, m))
        got = {tuple(x) for x in spelling_variants.one_edit(spelling_variants._codes(a), spelling_variants._codes(b))}
        assert got == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if near(x, y)}
    assert spelling_variants.Halves([]).near(["abcdef"]).shape == (0, 2) and np.array_equal(spelling_variants.Halves(["abcdef"]).near(["abcdef"]), np.empty((0, 2)))


def test_odd_input(docs):
    assert spelling_variants.variants(docs([])).count() == 0
    assert spelling_variants.variants(docs([None, "", "ab cd", "12 34"])).count() == 0
    long = "ab" * 300_000
    rows = [(None, "Änderung Änderungen " * 9), (None, None), (1, "Änderunge " * 5), (1, "Änderunge " * 5), (2, f"{long} " * 5), (3, f"{long}c " * 40), (4, "a" * 41 + " " + "a" * 40 + " ")] + [(9, ("a" * 41 + " ") * 5 + ("a" * 40 + " ") * 30)]
    same(docs, rows)
