from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from corvidex.llm import common
from corvidex.llm import suffix_tree_lm as lm


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    parts = ["ka", "lo", "mi", "nu", "re", "é", "so"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(80)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(n)]
    return [*texts, texts[0], texts[1], None, "", "NEW\x85word Ka ka", "x\x00y"]


def plain_base(rows):
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {i: (held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows}


def test_scores(docs):
    rows = list(enumerate(corpus()))
    got = {r.doc_id: r for r in lm.score(docs(rows, partitions=5, extra=True)).collect()}
    for i, want in plain_base(rows).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4])
        assert -math.inf < r.score < 0


def test_scores_do_not_depend_on_shards(docs, monkeypatch):
    """Contexts that one shard alone has are judged there: with all texts in one, few in each, or one in each."""
    rows = [(i, t) for i, t in enumerate(corpus(n=60)) if t]
    want = {r.doc_id: r.score for r in lm.score(docs(rows, partitions=1), order=2).collect()}
    few = {r.doc_id: r.score for r in lm.score(docs(rows, partitions=6), order=2).collect()}
    monkeypatch.setattr(lm, "SHARD_BYTES", 1)
    alone = {r.doc_id: r.score for r in lm.score(docs(rows, partitions=3), order=2).collect()}
    assert few == pytest.approx(want, abs=1e-6) and alone == pytest.approx(want, abs=1e-6)


def test_words_of_a_shard():
    texts = [b"", b" a\tB\n\x0b\x0ca  ", "Ünder É\u00a0x\u2003y NEW\x85w".encode(), b"\x1c\x1fA\x00 b", b"a", b"   ", b"\xff\xfe q"]
    texts += [random.Random(k).randbytes(300) for k in range(20)]
    for some in (texts, [b""], [b"a b"], []):
        words, docs = lm._numbered(common.pack_texts(list(range(len(some))), some), 3)
        own, known = lm._Shard(docs), common.zstandard.decompress(words).split(b" ")
        got = [[known[k] for k in own.tokens[a : z + 1]] for a, z in zip(own.starts, own.ends, strict=True)]
        assert got == [[*lm.tokens(t), b""] for t in some]
        assert all(known[a:z] == sorted(known[a:z]) for a, z in zip(own.cut, own.cut[1:], strict=False))


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_names_are_distinct(buckets):
    names = lm._Names(buckets, 5)
    bucket, place = (x.ravel() for x in np.meshgrid(np.arange(max(buckets, 6)), np.arange(500)))
    got = names.of(bucket, place)
    assert len(np.unique(got)) == len(got) and (got < lm.LONE).all()
    got, order = np.sort(got), np.argsort(got)
    cut = names.cut(got)
    assert cut[0] == 0 and all((place[order[cut[b] : cut[b + 1]]] % buckets == b).all() for b in range(buckets))
    with pytest.raises(ValueError):
        names.of(0, np.array([2**63], np.uint64))


def test_arranged():
    code = np.random.default_rng(0).integers(0, 1 << 20, 1000)
    for bits in (20, 60):
        ranked, by = lm._arranged(code, bits)
        assert (ranked == np.sort(code)).all() and (code[by] == ranked).all()


def test_copies_are_likelier(docs):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    fresh = lambda: " ".join(rng.choices(words, k=50))
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = {i: fresh() for i in train}
    copied = set(held[::2])
    texts |= {i: texts[train[k]] if i in copied else fresh() for k, i in enumerate(held)}
    got = {r.doc_id: r for r in lm.score(docs(list(texts.items()))).collect()}
    assert all(got[i].score > got[i].base_score for i in copied)
    assert max(got[i].score for i in held if i not in copied) < min(got[i].score for i in copied)


def test_odd_tables(docs):
    assert lm.score(docs([])).count() == 0
    only_held = [(i, "a b") for i in range(200) if lm.held_out(i)]
    rows = lm.score(docs(only_held)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) and r.base_score == 0 for r in rows)
    assert lm.score(docs([(None, "a b"), (None, None)])).where("NOT held_out").count() == 2


def test_tree_distributions_sum_to_one():
    counts = {b"": Counter(b"banana  "), b" ": Counter(b"bb"), b"a": Counter(b"nn  "), b"n": Counter(b"aa"), b"an": Counter(b"aa"), b"ban": Counter(b"a")}
    a = lm.grow({k: dict(v) for k, v in counts.items()}, 0.0, 0.0, 1.0)
    assert np.allclose((10.0 ** a.cost.astype(float)).sum(axis=1), 1, atol=1e-3)
    # The automaton's state is the longest suffix that is a context.
    rng = random.Random(0)
    for _ in range(50):
        word = bytes(rng.choices(b"ban", k=8))
        state, read = a.start, b" "
        for s in word:
            state, read = a.step[state, s], read + bytes([s])
            assert a.contexts[state] == next(read[k:] for k in range(len(read) + 1) if read[k:] in a.contexts)


def test_spelling_in_batches():
    a = lm.grow({b"": dict(Counter(b"abcab "))}, 0.0, 3.0, 1.0)
    words = [b"a", b"abc", b"", b"c" * 30]
    assert np.allclose(a.score(words), [a.score([w])[0] for w in words])


def test_long_words_in_pieces():
    """A word of any length is scored in pieces of bounded steps, as if byte after byte."""
    rng = random.Random(2)
    grams = {b"": dict(Counter(b"abcab  ")), b"a": {98: 5, 99: 1}, b"ca": {97: 4, 98: 1}, b"bca": {98: 9}, b" ": {97: 3}}
    a = lm.grow(grams, 0.0, 0.0, 1.0)
    words = [bytes(rng.choices(b"abc", k=k)) for k in (1, 1022, 1023, 1024, 1025, 5000, 3 * 1024)]

    def plain(word):
        state, total = a.start, 0.0
        for s in word + b" ":
            total, state = total + float(a.cost[state, s]), a.step[state, s]
        return total

    assert np.allclose(a.score(words), [plain(w) for w in words])
    began = time.monotonic()
    a.score([b"x" * 3_000_000])
    assert time.monotonic() - began < 10


def test_merged_contexts():
    numbers = lambda *x: np.array(x, np.uint64)
    unlikely = lambda n: np.full(n, -4, np.float16)
    one = (numbers(1, 9), np.array([2, 1]), numbers(1, 2, 9), np.array([3, 0, 1], np.uint32), unlikely(3))
    two = (numbers(1, 5), np.array([1, 1]), numbers(1, 1), np.array([2, 0], np.uint32), unlikely(2))
    (c, n, types), (d, m, kinds) = lm.merge_contexts([one, two])
    assert c.tolist() == [5, 0, 1] and n.tolist() == [5, 1] and types.tolist() == [1, 1]
    assert d.tolist() == [5, 0] and m.tolist() == [5, 0] and kinds.tolist() == [1, 0]


def plain_tree(texts, order, root):
    """Log10 scores by a tree of word contexts, as the definition has it; ``root`` gives a word's probability without context."""
    train = [["<", *t, None] for t in texts["train"]]
    follow = {}
    for t in train:
        for i in range(1, len(t)):
            for k in range(1, min(order, i) + 1):
                follow.setdefault(tuple(t[i - k : i]), Counter())[t[i]] += 1
    states = {}

    def p(context, w):
        for k in range(len(context), 0, -1):
            if (s := context[-k:]) in states:
                own, n = follow[s], sum(follow[s].values())
                weight = lm.WORD_SMOOTHING * len(own)
                return (own[w] + weight * p(s[1:], w)) / (n + weight)
        return root(w)

    for s in sorted(follow, key=len):
        own, n = follow[s], sum(follow[s].values())
        if n < lm.LEAST_TIMES:
            continue
        gain = 0
        for w, c in own.items():
            up = p(s[1:], w)
            left = int(n > 1)
            weight = lm.WORD_SMOOTHING * (len(own) - (c == 1) * left)
            gain += c * math.log((c - left + weight * up) / (n - left + weight) / up)
        if gain >= lm.WORD_GAIN:
            states[s] = True
    score = lambda t: sum(math.log10(p(tuple(t[max(0, i - order) : i]), t[i])) for i in range(1, len(t)))
    return {i: score(["<", *t, None]) for i, t in texts["all"].items()}, states


def plain_root(train, depth, least_share, divergence, smoothing):
    """A word's probability without word contexts, and the byte contexts that are states, as the definition has it; ``train`` counts words, None is a text's end."""
    follow = {}
    for w, c in train.items():
        read = b" "
        for s in (w or b"") + b" " if w is not None else b"":
            for d in range(min(depth, len(read)) + 1):
                follow.setdefault(read[len(read) - d :], Counter())[s] += c
            read += bytes([s])
    spelled = sum(follow[b""].values())
    follow = {k: v for k, v in follow.items() if sum(v.values()) >= least_share * spelled}
    for k in (b"", b" "):
        follow[k][lm.END] = train[None]
    total = sum(follow[b""].values())
    # 252 symbols: all bytes but four blanks, with the text's end.
    states = {b"": {s: (follow[b""][s] + 0.5) / (total + 0.5 * 252) for s in range(256)}}
    longest = lambda read: next(states[read[k:]] for k in range(len(read) + 1) if read[k:] in states)
    for context in sorted(follow, key=len)[1:]:
        own, n, up = follow[context], sum(follow[context].values()), longest(context[1:])
        gain = sum(c * math.log(c / n / up[s]) for s, c in own.items())
        if n >= least_share * total and gain >= divergence * len(own) or context == b" ":
            states[context] = {s: (own[s] + smoothing * up[s]) / (n + smoothing) for s in range(256)}

    def spell(w):
        if w is None:
            return longest(b" ")[lm.END]
        p, read = 1.0, b" "
        for s in w + b" ":
            p, read = p * longest(read)[s], read + bytes([s])
        return p

    n, types = sum(train.values()), len(train)
    return lambda w: (train[w] + types * spell(w)) / (n + types), states, follow


@pytest.mark.parametrize(("depth", "least_share"), [(1, 0.0005), (3, 0.002), (5, 0.0001)])
def test_spelling_against_a_plain_tree(docs, depth, least_share):
    rows = list(enumerate(corpus(seed=5, n=120)))
    split = lambda t: [*lm.tokens((t or "").encode()), None]
    train = Counter(w for i, t in rows if not lm.held_out(i) for w in split(t))
    root, states, follow = plain_root(train, depth, least_share, lm.DIVERGENCE, lm.SMOOTHING)
    assert any(len(s) == depth for s in states)
    assert depth == 1 or any(c not in states for c in follow)
    got = {r.doc_id: r.score for r in lm.score(docs(rows, partitions=4), depth=depth, least_share=least_share, order=0).collect()}
    assert got == pytest.approx({i: sum(math.log10(root(w)) for w in split(t)) for i, t in rows}, rel=1e-4, abs=1e-3)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_a_plain_tree(docs, order):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    chain = {w: rng.choices(words, k=3) for w in words}
    texts = {}
    for i in range(150):
        t = [rng.choice(words)]
        for _ in range(rng.randint(0, 30)):
            t.append(rng.choice(chain[t[-1]]) if rng.random() < 0.8 else rng.choice(words))
        texts[i] = t
    train = [t for i, t in texts.items() if not lm.held_out(i)]
    # Held-out texts of one word tell the root's probabilities, by scores without contexts.
    free = [i for i in range(150, 5000) if lm.held_out(i)]
    texts |= dict(zip(free, [[], *([w] for w in words)], strict=False))
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    bare = {r.doc_id: r.score for r in lm.score(docs(rows), order=0).collect()}
    root = {None: 10 ** bare[free[0]]} | {w: 10 ** (bare[i] - bare[free[0]]) for i, w in zip(free[1:], words, strict=False)}
    got = {r.doc_id: r.score for r in lm.score(docs(rows, partitions=4), order=order).collect()}
    want, states = plain_tree({"train": train, "all": texts}, order, root.__getitem__)
    assert any(len(s) == order for s in states)
    assert got == pytest.approx(want, abs=0.02)


def test_long_unknown_words_have_a_score(docs):
    held = next(i for i in range(1, 100) if lm.held_out(i))
    train = [(i, "some words " * 5) for i in range(100, 150) if not lm.held_out(i)]
    rng = random.Random(1)
    odd = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(400))
    got = {r.doc_id: r.score for r in lm.score(docs([*train, (held, f"some {odd} words")])).collect()}
    assert all(math.isfinite(s) for s in got.values()) and got[held] < -300


def test_large_contexts_keep_rare_words():
    # 200,000 words follow one context, one of them very often; a second list asks for words that never did.
    rng = np.random.default_rng(0)
    words = np.unique(rng.integers(0, 2**63, 200_000).astype(np.uint64))
    counts = np.ones(len(words), np.uint32)
    counts[7] = 30_000_000
    unseen = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    context = np.array([5], np.uint64)
    ask = lambda w, c: (context, np.array([len(w)]), w, c, np.full(len(w), -6, np.float16))
    (c, n, types), (d, m, _) = lm.merge_contexts([ask(words, counts), ask(unseen, np.zeros(len(unseen), np.uint32))])
    assert (c == counts).all() and (n == counts.sum(dtype=np.int64)).all() and (types == len(words)).all()
    assert (d == 0).all() and (m == n[0]).all()
