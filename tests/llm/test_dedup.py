"""Deduplication operators against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest

from corvidex.llm import common, jaccard_join, substring_dedup, suffix_dedup
from corvidex.llm.shingles import shingle_set, shingles_of, word_hashes

# --- suffix arrays ---------------------------------------------------------------


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for n, letters in ((1, 2), (60, 1), (500, 2), (3000, 3), (2000, 26)):
        raw = (rng.integers(0, letters, n) + 97).astype(np.uint8)
        raw[n // 3 : n // 2] = raw[: n // 2 - n // 3]
        order, rank = suffix_dedup.suffix_array(raw, 50)
        text = raw.tobytes()
        assert sorted(order) == list(range(n))
        lcp = suffix_dedup.common_prefixes(raw, order, rank, 50)
        for k in range(1, n):
            a, b = text[order[k - 1] :][:50], text[order[k] :][:50]
            assert a <= b
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert lcp[k] == same


def plain_repeats(rows, width=50):
    least = {}
    key = lambda i: 1 << 62 if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            least[w] = min(least.get(w, 1 << 63), key(i))
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            if least[b[p : p + width]] < key(i):
                gone[p : p + width] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        yield i, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()


def passages_corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    pool = [" ".join(word() for _ in range(rng.randint(3, 40))) for _ in range(10)] + ["ab " * 60, "z" * 180, "é" * 70, "q" * 49, "q" * 50]
    out = [" ".join(rng.choice(pool) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(0, 9))) for _ in range(n)]
    return [*out, out[3], out[3], out[7], None, "", "q"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats(docs, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 3000)
    texts = passages_corpus(seed)
    numbers = list(range(len(texts)))
    random.Random(seed).shuffle(numbers)
    rows = [*zip(numbers, texts, strict=True), (None, texts[4]), (numbers[5], texts[5])]
    out = suffix_dedup.digest(suffix_dedup.repeats(docs(rows, partitions=5, extra=True)))
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(plain_repeats(rows), key=key)


def test_repeats_spans_and_empty(docs):
    a, b = "x1y2z3" * 20, "kept " + "x1y2z3" * 20 + " end"
    rows = {r.doc_id: r for r in suffix_dedup.repeats(docs([a, b])).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(5, 125)] and bytes(rows[1].kept) == b"kept  end" and not rows[0].spans
    assert suffix_dedup.repeats(docs([])).count() == 0
    assert suffix_dedup.digest(suffix_dedup.repeats(docs([None, ""]))).where("n_removed = 0").count() == 2


def test_squeeze_round_trip():
    for arrays in ([np.arange(5)], [np.empty(0, np.uint32), np.array([2**63], np.uint64), np.array([True, False])]):
        for a, b in zip(arrays, common.expand(common.squeeze(*arrays)), strict=True):
            assert a.dtype == b.dtype and (a == b).all()
    ids, known, lens, body = common.unpack_texts(common.pack_texts([1, None], ["ä".encode(), b""]))
    assert list(ids) == [1, 0] and list(known) == [True, False] and list(lens) == [2, 0] and body == "ä".encode()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, k) for k in range(1001, 1100)] + [(k, k + 1) for k in range(2000, 2040)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "src long, dst long"), "t").collect()}
    assert got == {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert common.components(spark.createDataFrame([], "src long, dst long"), "t").count() == 0


# --- Jaccard join ------------------------------------------------------------------


def near_corpus(seed, n=40, groups=6):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 150))) for _ in range(n)]
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(60, 200))
        for _ in range(rng.randint(2, 25)):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    return [*texts, texts[-1], texts[-1].upper(), None, "", " ", "one two", "one two", "a a a a a a a"]


def plain_join(rows, threshold=0.8):
    sets = {i: frozenset(shingle_set((t or "").encode()).tolist()) for i, t in rows}
    distinct = sorted({s for s in sets.values() if s}, key=sorted)
    links = {s: [o for o in distinct if o is not s and len(s & o) >= threshold * len(s | o) - 1e-9] for s in distinct}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    members = {}
    for i, s in sets.items():
        if s:
            members.setdefault(s, []).append(i)
    for s, own in members.items():
        for other in [own[0], *(members[o][0] for o in links[s])]:
            for i in own:
                a, b = root(i), root(other)
                parent[max(a, b)] = min(a, b)
    return {i: (root(i), len(links[s]) if s else 0, len(members[s]) if s else 1) for i, s in sets.items()}


@pytest.mark.parametrize(("seed", "leaf", "block"), [(1, 1024, 4096), (2, 1024, 5), (3, 6, 4096)])
def test_join(docs, seed, leaf, block):
    rows = list(enumerate(near_corpus(seed)))
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in jaccard_join.join(docs(rows, partitions=5, extra=True), leaf=leaf, block_sets=block).collect()}
    assert got == plain_join(rows)


def test_join_odd_rows(docs):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [(None, base), (3, base), (3, base), (9, base + " x"), (12, None), (13, "")]
    got = jaccard_join.join(docs(rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.class_id) for r in got} == {(None, None), (3, 3), (9, 3), (12, 12), (13, 13)}
    kept = jaccard_join.keep_one(docs(rows, extra=True))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["12", "13", "3", "None"] and "rep" in kept.columns
    assert jaccard_join.join(docs([])).count() == 0


def test_two_texts_with_one_number(docs):
    p, q = (" ".join(f"{c}{k}" for k in range(100)) for c in "pq")
    rows = [(1, p), (1, q), (2, p + " x"), (3, q + " y"), (7, ""), (7, " ")]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(docs(rows)).collect())
    assert got == [(1, 2, 1), (1, 3, 1), (2, 2, 1), (3, 3, 1), (7, 7, 0), (7, 7, 0)]
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs(rows)).collect())
    assert [k for k, _ in kept] == [1, 1, 7, 7]
    assert kept == sorted([(1, p), (1, q), (7, ""), (7, " ")])


def test_runs_reach_the_recall():
    assert jaccard_join.runs_for(0.8, 2, 0.9999) == 10


# --- substring dedup --------------------------------------------------------------


@pytest.mark.parametrize(("n", "least", "letters"), [(0, 5, 9), (4, 5, 9), (5, 5, 9), (200, 7, 1 << 40), (300, 10, 3), (80, 46, 1 << 40), (50, 1, 100)])
def test_compact_windows(n, least, letters):
    rng = np.random.default_rng(n)
    h = rng.integers(0, letters, n).astype(np.uint64) << np.uint64(27)
    got = set(zip(*(x.tolist() for x in substring_dedup.compact_windows(h, least)), strict=True))
    want = set()
    for c in range(n):
        lo = c
        while lo and h[lo - 1] > h[c]:
            lo -= 1
        hi = c
        while hi + 1 < n and h[hi + 1] >= h[c]:
            hi += 1
        if hi - lo + 1 >= least:
            want.add((lo, c, hi))
    assert got == want


def test_passages(docs):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    shared, near, short = words(60), words(80), words(40)
    changed = list(near)
    changed[40] = "other"
    texts = [words(200) + shared + words(50), words(30) + shared, shared + words(300), words(100) + near + words(90), words(20) + changed, words(60) + short, short + words(60), words(500), words(10), [], shared]
    texts = [" ".join(t) for t in texts] + [None, " ".join(words(300) + near)]
    got = {r.doc_id: r for r in substring_dedup.classes(docs(texts, partitions=4, extra=True)).collect()}
    assert len(got) == len(texts)
    assert {k: r.class_id for k, r in got.items()} == {0: 0, 1: 0, 2: 0, 10: 0, 3: 3, 4: 3, 12: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 11: 11}
    assert all((r.n_links_found > 0) == (r.class_id in (0, 3)) for r in got.values())
    links = substring_dedup.passages(docs(texts)).collect()
    for r in links:
        a, b = (" ".join((texts[i] or "").split()[s : s + r.n_words]) for i, s in ((r.a, r.a_start), (r.b, r.b_start)))
        x, y = (set(zip(*(w[k:] for k in range(5)), strict=False)) for w in (a.split(), b.split()))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.8


def test_passages_odd_rows(docs):
    p = " ".join(f"v{k}" for k in range(70))
    got = substring_dedup.classes(docs([(None, p), (4, p), (4, p), (8, p + " x")])).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == [("4", "4"), ("4", "4"), ("8", "4"), ("None", "None")]
    assert substring_dedup.classes(docs([])).count() == 0


def test_hot_passage_links_stay_linear(docs):
    p = " ".join(f"v{k}" for k in range(60))
    texts = [f"{' '.join(f'a{i}x{k}' for k in range(20))} {p}" for i in range(150)]
    assert substring_dedup.passages(docs(texts)).count() < 1500
    assert {r.class_id for r in substring_dedup.classes(docs(texts)).collect()} == {0}


def plain_classes(texts, pairs=None, threshold=0.8, passage_words=50):
    """Classes by all aligned passages of all pairs of documents (or of ``pairs`` of places that meet)."""
    least = passage_words - 4
    s = [(shingles_of([t.encode()])[0] >> np.uint64(32)).astype(np.uint32) for t in texts]
    parent = list(range(len(s)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def similar(a, b):
        for shift in range(-len(b) + least, len(a) - least + 1):
            lo, hi = max(0, shift), min(len(a), len(b) + shift)
            if np.isin(a[lo:hi], b).sum() < 0.6 * least:
                continue
            for i in range(lo, hi - least + 1):
                x, y = set(a[i : i + least].tolist()), set(b[i - shift : i - shift + least].tolist())
                if len(x & y) >= threshold * len(x | y) - 1e-9:
                    return True
        return False

    for a, b in pairs if pairs is not None else itertools.combinations(range(len(s)), 2):
        if root(a) != root(b) and len(np.intersect1d(s[a], s[b])) and similar(s[a], s[b]):
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {i: root(i) for i in range(len(s))}


def edited_families(seed, families=12, copies=8):
    """Copies of a passage with one word changed each, so that they are similar to the original only, which lies between them."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    line = words(12)
    texts = []
    for _ in range(families):
        base = words(19) + line + words(19)
        family = [base]
        for k in range(copies):
            edited = list(base)
            edited[rng.choice([*range(6, 18), *range(32, 44)])] = f"e{k}"
            family.insert(0 if k % 2 else len(family), edited)
        texts += [" ".join(words(rng.randint(0, 60)) + p + words(rng.randint(0, 60))) for p in family]
    rng.shuffle(texts)
    return texts


def test_documents_that_share_a_key_all_meet(docs):
    texts = edited_families(3)
    w = substring_dedup._Windows([t.encode() for t in texts], 46, 2)
    members = {}
    for key, doc in zip(w.key.tolist(), w.row.tolist(), strict=True):
        members.setdefault(key, set()).add(doc)
    pairs = sorted({p for m in members.values() for p in itertools.combinations(sorted(m), 2)})
    want = plain_classes(texts, pairs)
    got = {r.doc_id: r.class_id for r in substring_dedup.classes(docs(texts), functions=2).collect()}
    # What meets by a key is never apart; a class may hold more, never less, as other centres of a pair are compared too.
    assert all(got[a] == got[b] for a, b in want.items())
    everything = plain_classes(texts)
    assert all(everything[a] == everything[b] for a, b in got.items())


def test_large_groups(docs):
    # Two windows of a key count as very many: hubs, rarest shingles and blocks then do all the work.
    texts = [*edited_families(4, 6), *(f"{' '.join(f'b{i}x{k}' for k in range(25))} {' '.join(f'c{k}' for k in range(60))}" for i in range(40))]
    want = plain_classes(texts)
    for most in (1, 3, 10):
        assert {r.doc_id: r.class_id for r in substring_dedup.classes(docs(texts), group_windows=most).collect()} == want


def test_words_and_shingles():
    odd = [b"", b"a", b"A b  c", "\xe9 x\ny".encode(), b"one two three four five six", b" ", b"Z" * 300_000 + b" q", b"a b c d e", b"x " * 200_000]
    s, n = shingles_of(odd)
    at = np.cumsum(n)
    for k, text in enumerate(odd):
        own, count = shingles_of([text])
        words = text.split()
        assert count[0] == n[k] == (max(1, len(words) - 4) if words else 0) and (own == s[at[k] - n[k] : at[k]]).all()
        assert word_hashes([text])[1][0] == len(words)
    assert word_hashes([b"Ab"])[0][0] == word_hashes([b"x y ab"])[0][2] != word_hashes([b"x y ba"])[0][2]


def test_passage_length_is_checked(docs):
    with pytest.raises(ValueError, match="passage_words"):
        substring_dedup.classes(docs(["a"]), passage_words=5)
    text = " ".join(f"w{k}" for k in range(700))
    assert {r.class_id for r in substring_dedup.classes(docs([text, text + " x"]), passage_words=560).collect()} == {0}


def test_same_number_and_very_long_text(docs):
    passage = " ".join(f"p{k}" for k in range(60))
    long = " ".join(f"x{k}" for k in range(120_000))
    rows = [(1, "a " + passage), (1, "other"), (2, long + " " + passage), (3, "b"), (3, None)]
    assert {(r.doc_id, r.class_id) for r in substring_dedup.classes(docs(rows)).collect()} == {(1, 1), (2, 1), (3, 3)}


def test_every_window_of_a_key_is_compared(docs):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        # The same line stands in both passages of a text; one of them is another text's too, at the same place or elsewhere.
        line, true = words(30), words(10)
        passage = true + line + words(10)
        for before in (60, 60, 130):
            texts.append(" ".join(words(10) + line + words(10) + words(before) + passage + words(70) + line + words(40)))
    w = substring_dedup._Windows([t.encode() for t in texts], 46, 1)
    members = {}
    for key, doc, place in zip(w.key.tolist(), w.row.tolist(), w.place.tolist(), strict=True):
        members.setdefault(key, {}).setdefault(doc, []).append(place)
    assert any(len(places) > 1 for m in members.values() for places in m.values())
    got = {r.doc_id: r.class_id for r in substring_dedup.classes(docs(texts), functions=1).collect()}
    assert all(got[k] == k // 3 * 3 for k in got)


def test_passages_that_repeat_themselves():
    # Eight of ten shingles are common, but those two return and hold most places.
    a = np.array([*range(8), *[8, 9] * 19], np.uint32)
    b = np.array([*range(8), *[0] * 38], np.uint32)
    assert substring_dedup.verify(a, 23, b, 23, 46, 0.8)[0] == pytest.approx(0.8)


def test_edited_passages_at_the_threshold_share_a_key():
    # One word of 50 is changed: 41 of 51 shingles are common.
    rng = random.Random(5)
    texts = []
    for _ in range(2000):
        base = [f"w{rng.randrange(10**9)}" for _ in range(50)]
        edited = list(base)
        edited[rng.randrange(5, 45)] = "other"
        texts += [" ".join([*(f"a{rng.randrange(10**9)}" for _ in range(40)), *p, *(f"z{rng.randrange(10**9)}" for _ in range(40))]).encode() for p in (base, edited)]
    w = substring_dedup._Windows(texts, 46, substring_dedup.FUNCTIONS)
    keys = [set() for _ in texts]
    for key, doc in zip(w.key.tolist(), w.row.tolist(), strict=True):
        keys[doc].add(key)
    missed = sum(not (keys[k] & keys[k + 1]) for k in range(0, len(texts), 2))
    assert missed <= 2


def test_edited_passages_against_brute_force(docs):
    texts = edited_families(11, 8)
    assert {r.doc_id: r.class_id for r in substring_dedup.classes(docs(texts)).collect()} == plain_classes(texts)


def test_windows_meet_hubs_at_once():
    """Which windows can hold a passage of their hub is told for many at once, as for one; trees and shared keys equal plain ones."""
    rng = np.random.default_rng(3)
    hubs = [rng.integers(0, 5000, 91).astype(np.uint32) for _ in range(40)]
    pairs = []
    for _ in range(600):
        hub, run = hubs[rng.integers(40)], rng.integers(0, 1 << 32, rng.integers(1, 92)).astype(np.uint32)
        n = min(int(rng.integers(0, 92)), len(run))
        run[:n] = hub[:n]
        if len(run) > 3 and rng.random() < 0.3:
            run[2] = run[0]
        pairs.append((run, hub))
    want = [substring_dedup._may_hold(x, np.sort(y), 46, 0.8) for x, y in pairs]
    assert substring_dedup._may_hold_each([x.tobytes() for x, _ in pairs], [y.tobytes() for _, y in pairs], 46, 0.8).tolist() == want
    assert 100 < sum(want) < 500
    for n, most in ((0, 3), (1, 3), (2, 3), (300, 4), (300, 1 << 40)):
        values = rng.integers(0, most, n).astype(np.uint64)
        assert substring_dedup._before(values).tolist() == [max((j for j in range(i) if values[j] <= values[i]), default=-1) for i in range(n)]
