"""Language-model scores from a probabilistic suffix tree.

A text is its words and an end.  The tree has two kinds of contexts:

*   Before a word: the words before it, none to ``order`` of them, a text's
    start among them. A context is grown from one that was seen often enough,
    and is a state if its next words diverge from its parent's (the longest
    state among its shorter suffixes): if, with each occurrence left out in
    turn (its only one excepted), it makes the words that follow it likelier by
    ``WORD_GAIN`` nats. Its distribution is smoothed with its parent's by the number of different words
    that follow; the root's is smoothed with the spelled probability.
*   Within a spelled word: the bytes before a symbol, back to the blank before
    the word and ``depth`` bytes at most.  A context is a state if it is
    frequent enough and its next symbols diverge from its parent's by a
    likelihood-ratio test; its distribution is smoothed with its parent's.

Scoring reads each symbol under the longest suffix that is a state; for bytes
the tree becomes an automaton, so a symbol costs one step.  Every distribution
sums to one.

Texts become word numbers once. Words and contexts are counted across shards by
sorted lists of distinct entries, a length of contexts after the other, so the
network carries an entry once per shard whatever its frequency, and spelled
probabilities are computed once per distinct word of the corpus. Whoever counts
a context with the word after it sees whether several shards have them; as the
next length's contexts, only those go into lists again. What one shard alone has
is judged there, by the same rule.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

DEPTH = 5
#: A state's share of all training symbols is at least this, which bounds the states of a depth by its inverse.
LEAST_SHARE = 5e-5
#: Least likelihood ratio, in nats, for each symbol that follows a context.
DIVERGENCE = 3.0
#: Weight of the parent's distribution, in symbols.
SMOOTHING = 2.0
#: Words of the longest context, and how often a context must occur to be one.
ORDER, LEAST_TIMES = 2, 1
#: Nats that a word context must gain over its parent.
WORD_GAIN = 2.0
#: Weight of the parent's distribution in a word context, for each different word after it.
WORD_SMOOTHING = 3.0
#: Text bytes in a shard; its arrays take about 20 times as much.
SHARD_BYTES = 12 << 20
CONTEXTS_A_BUCKET = 750_000

BLANK, END = 0x20, 0x0A  #: bytes that no word has: before and after a word; the text's end
_U = np.uint64
_ROWS = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])
_ROWS_SQL = "shard long, bucket long, blob binary"
WORDS_A_BUCKET = 400_000
#: Bytes of a word that are read one after the other.
PIECE = 1024


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case; the end isn't among them."""
    return text.lower().split()


def held_out(doc_id: int | None) -> bool:
    """A null number trains."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


# --- words ------------------------------------------------------------------


LONE = _U((1 << 64) - 1)  #: the name of every context that one shard alone has


@dataclass(frozen=True)
class _Names:
    """Names of contexts that shards agree on: the bucket that is to count one, then the bucket and the place where its last word was counted."""

    buckets: int
    words: int  #: buckets of words

    @property
    def width(self) -> int:
        return max(self.buckets, self.words + 1).bit_length()

    def of(self, bucket: int | np.ndarray, place: np.ndarray) -> np.ndarray:
        every, place = _U(self.buckets), place.astype(_U)
        if len(place) and int(place.max()) // self.buckets >= 1 << (64 - 2 * self.width):
            raise ValueError("a bucket has too many contexts to name them")
        return place % every << _U(64 - self.width) | np.asarray(bucket).astype(_U) << _U(64 - 2 * self.width) | place // every

    def cut(self, names: np.ndarray) -> np.ndarray:
        """Where each bucket begins among sorted names, and where the last one ends."""
        return np.append(np.searchsorted(names, np.arange(self.buckets, dtype=_U) << _U(64 - self.width)), len(names))


def _numbered(blob: bytes, buckets: int) -> tuple[bytes, bytes]:
    """The distinct words of a shard by bucket and in order, and its texts as numbers of those words, an end after each text."""
    ids, known, lens, text = common.unpack_texts(blob)
    offsets = np.concatenate(([0], np.cumsum(lens))).astype(np.int64)
    texts = pa.LargeStringArray.from_buffers(len(lens), pa.py_buffer(offsets), pa.py_buffer(text))
    # The functions for ASCII leave other bytes alone; they find an empty word at the ends of some texts.
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    owner = np.repeat(np.arange(len(lens)), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" not in words:
        words.append(b"")
    end = words.index(b"")
    found = coded.indices.to_numpy(zero_copy_only=False)
    owner, found = owner[found != end], found[found != end]
    lens = np.bincount(owner, minlength=len(lens)) + 1
    numbers = np.full(len(found) + len(lens), end, np.int32)
    numbers[np.arange(len(found)) + owner] = found
    bucket = (np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words)) % _U(buckets)).astype(np.int64)
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    number = np.empty(len(words), np.int32)
    number[order] = np.arange(len(words), dtype=np.int32)
    return common.zstandard.compress(b" ".join([words[k] for k in order.tolist()]), 1), common.squeeze(ids, known.astype(np.uint8), lens, number[numbers], np.bincount(bucket, minlength=buckets))


class _Shard:
    """The words of a shard as numbers, and what the answers so far say of them."""

    def __init__(self, blob: bytes):
        ids, known, lens, self.tokens, sizes = common.expand(blob)
        self.numbers = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.train = np.array([not held_out(i) for i in self.numbers], bool)
        self.ends = np.cumsum(lens) - 1
        self.starts = self.ends - lens + 1
        self.trains = np.repeat(self.train, lens)
        #: Where the words of each bucket begin and end.
        self.cut = np.concatenate(([0], np.cumsum(sizes)))

    def counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.trains], minlength=int(self.cut[-1]))

    def read(self, rows: list[dict], order: int, names: _Names) -> tuple[_Contexts, np.ndarray, np.ndarray]:
        """The contexts of ``order`` words, by the answers on shorter ones; each token's log10 probability under the longest state by then, and each word's count."""
        size = int(self.cut[-1])
        count, root, word, key = np.zeros(size, np.int64), np.zeros(size), np.zeros(size, _U), np.full(size + 1, LONE)
        for r in rows:
            if r["kind"] == 0:
                a, z = self.cut[r["bucket"]], self.cut[r["bucket"] + 1]
                count[a:z], root[a:z], number, shared = common.expand(r["blob"])
                word[a:z] = number | _U(r["bucket"]) << _U(32)
                key[a:z] = np.where(shared, names.of(r["bucket"], number), LONE)
        # The start of a text has a bucket of its own.
        key[size] = names.of(len(self.cut) - 1, np.zeros(1, _U))[0]
        p = root[self.tokens]
        found = _Contexts.of_one(self, word, key, count, names)
        for k in range(1, order):
            found = found.longer(*found.apply([r for r in rows if r["kind"] == k], p))
        return found, p, count


def _arranged(code: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of so many bits in order and where each came from; where both fit one number, these are sorted."""
    place = len(code).bit_length()
    if bits + place > 63:
        by = np.argsort(code)
        return code[by], by
    both = code << place | np.arange(len(code))
    both.sort()
    return both >> place, both & ((1 << place) - 1)


class _Contexts:
    """The distinct pairs of a context of one length and the word after it, in order of the contexts' names, and the pair of each token that has one."""

    def __init__(self, own: _Shard, word: np.ndarray, names: _Names, context: np.ndarray, key: np.ndarray):
        """``context`` is each token's, a number of ``key``, or -1; ``key`` has the names."""
        self.own, self.word, self.names = own, word, names
        self.at = np.flatnonzero(context >= 0).astype(np.int32)
        order = np.argsort(key)
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(len(key))
        bits = len(word).bit_length()
        ranked, by = _arranged(rank[context[self.at]] << bits | own.tokens[self.at], bits + len(key).bit_length())
        del rank, context
        head = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, bool)
        self.pair = np.empty(len(by), np.int32)
        self.pair[by] = np.cumsum(head, dtype=np.int32) - 1
        self.first = self.at[by[head]]  #: a token of each pair
        of = (ranked[head] >> bits).astype(np.int32)
        del by, ranked, head
        self.runs = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.empty(0, np.int64)
        self.key = key[order[of[self.runs]]]
        self.lens = np.diff(np.append(self.runs, len(of)))
        self.times = np.bincount(self.pair[own.trains[self.at]], minlength=len(self.first)).astype(np.uint32)
        #: Contexts that other shards have too, which come first, and their pairs.
        self.shared = int(np.searchsorted(self.key, LONE))
        self.listed = int(np.append(self.runs, len(of))[self.shared])

    @classmethod
    def of_one(cls, own: _Shard, word: np.ndarray, key: np.ndarray, count: np.ndarray, names: _Names) -> _Contexts:
        context = np.full(len(own.tokens), -1, np.int32)
        context[1:] = own.tokens[:-1]
        context[own.starts] = len(word)
        often = np.append(count >= LEAST_TIMES, True)
        return cls(own, word, names, np.where(often[context], context, np.int32(-1)), key)

    def longer(self, count: np.ndarray, key: np.ndarray) -> _Contexts:
        """Contexts of one word more: a pair that occurs often enough is the context of what follows."""
        context = np.full(len(self.own.tokens) + 1, -1, np.int32)
        context[self.at + 1] = np.where(count[self.pair] >= LEAST_TIMES, self.pair, np.int32(-1))
        context = context[:-1]
        context[self.own.starts] = -1
        del self.at, self.pair, self.first
        return _Contexts(self.own, self.word, self.names, context, key)

    def lists(self, shard: int, p: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The pairs of shared contexts by bucket: steps between names, how many words follow each context, the words, their counts, and log10 probabilities under the parent, to three digits (0 for what never trains)."""
        cut, ends = self.names.cut(self.key[: self.shared]), np.append(self.runs, len(self.first))
        first = self.first[: self.listed]
        after = self.word[self.own.tokens[first]]
        parent = np.where(self.times[: self.listed] > 0, p[first], 0).astype(np.float16)
        blobs, numbers = [], []
        for b in np.flatnonzero(np.diff(cut)):
            a, z = ends[cut[b]], ends[cut[b + 1]]
            numbers.append(int(b))
            blobs.append(common.squeeze(np.diff(self.key[cut[b] : cut[b + 1]], prepend=_U(0)), self.lens[cut[b] : cut[b + 1]], after[a:z], self.times[a:z], parent[a:z]))
        yield common.table(_ROWS, shard=[shard] * len(blobs), bucket=numbers, blob=blobs)

    def apply(self, rows: list[dict], p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take the answers into ``p``; the count of each pair, and its name as a context."""
        rows = sorted(rows, key=lambda r: r["bucket"])
        parts = [common.expand(r["blob"]) for r in rows]
        key, at = np.full(len(self.first), LONE), 0
        for r, (c, _, _, shared, steps) in zip(rows, parts, strict=True):
            key[at : at + len(shared)][shared.astype(bool)] = self.names.of(r["bucket"], np.cumsum(steps))
            at += len(c)
        lone = self.times[self.listed :].astype(np.int64)
        n, types = judge(self.runs[self.shared :] - self.listed, lone, p[self.first[self.listed :]].astype(np.float16))
        c, n, types = (np.concatenate([*(x[k] for x in parts), mine]) for k, mine in enumerate((lone, n, types)))
        if len(c) != len(self.first) or len(n) != len(self.key):
            raise RuntimeError("an answer is missing")
        run = np.repeat(np.arange(len(n), dtype=np.int32), self.lens)
        # In slices, for the temporary arrays.
        for a in range(0, len(self.at), 1 << 18):
            at, of = self.at[a : a + (1 << 18)], self.pair[a : a + (1 << 18)]
            state = n[run[of]] > 0
            at, of = at[state], of[state]
            weight = types[run[of]] * WORD_SMOOTHING
            p[at] = log_add(c[of], np.log10(weight) + p[at]) - np.log10(n[run[of]] + weight)
        return c, key


def _words_blob(words: list[bytes], *columns: np.ndarray) -> bytes:
    head = common.squeeze(*columns)
    return len(head).to_bytes(8, "little") + head + common.zstandard.compress(b" ".join(words), 1)


def _words_of(blob: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    n = int.from_bytes(blob[:8], "little")
    return common.zstandard.decompress(blob[8 + n :]).split(b" "), common.expand(blob[8 : 8 + n])


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words and the blanks after them as one array of symbols, and where each word starts."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return np.frombuffer(b" ".join(words) + b" ", np.uint8), np.cumsum(lens) - lens


def gram_counts(words: list[bytes], counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each symbol with its longest context: code ``length << 56 | context bytes << 8 | symbol``."""
    seen = [(w, c) for w, c in zip(words, counts.tolist(), strict=True) if c and w]
    if not seen:
        return np.empty(0, _U), np.empty(0, np.int64)
    symbols, starts = spell([w for w, _ in seen])
    n = len(symbols)
    lens = np.diff(np.append(starts, n))
    place = np.arange(n) - np.repeat(starts, lens)  # bytes of the word before the symbol
    length = np.minimum(place + 1, depth)
    padded = np.concatenate([np.full(depth, BLANK, np.uint8), symbols])
    code = symbols.astype(_U)
    for k in range(1, depth + 1):
        before = np.where(k <= length, padded[depth - k : depth - k + n], 0).astype(_U)
        code |= before << _U(8 * k)
    code |= length.astype(_U) << _U(56)
    order = np.argsort(code)
    ranked = code[order]
    head = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return ranked[head], np.add.reduceat(np.repeat(np.array([c for _, c in seen], np.int64), lens)[order], head)


def _merge_words(depth: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        common.tidy()
        bucket = int(pdf["bucket"].iloc[0])
        total: dict[bytes, int] = {}
        lists = []
        for blob in pdf["blob"]:
            words, (counts,) = _words_of(blob)
            lists.append(words)
            for w, c in zip(words, counts.tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        words = sorted(total)
        counts = np.fromiter((total[w] for w in words), np.int64, len(words))
        number = {w: k for k, w in enumerate(words)}
        numbers = [np.fromiter(map(number.__getitem__, own), np.uint32, len(own)) for own in lists]
        shards = np.zeros(len(words), np.int32)
        for own in numbers:
            shards[own] += 1
        rows = [(-1, bucket, _words_blob(words, counts, (shards > 1).astype(np.uint8))), (-2, bucket, common.squeeze(*gram_counts(words, counts, depth)))]
        for shard, own in zip(pdf["shard"], numbers, strict=True):
            rows.append((shard, bucket, common.squeeze(own)))
        known = counts > 0
        rows.append((-3, bucket, common.squeeze(np.array([counts.sum(), known.sum(), total.get(b"", 0)], np.int64))))
        return pd.DataFrame(rows, columns=["shard", "bucket", "blob"])

    return run


# --- the tree -----------------------------------------------------------------


@dataclass
class Automaton:
    """``step[state, symbol]`` is the next state and ``cost[state, symbol]`` the symbol's log10 probability."""

    step: np.ndarray
    cost: np.ndarray
    start: int
    contexts: list[bytes]

    def score(self, words: list[bytes]) -> np.ndarray:
        """The log10 probability of each word with its blank.

        All words take a step together. A long word is cut into pieces that do
        so too: a state is at most as long as the longest context, so a piece
        that first reads as many bytes before it is in the state that it would
        have been in.
        """
        symbols, starts = spell(words)
        lens = np.diff(np.append(starts, len(symbols)))
        warm = max(map(len, self.contexts))
        pieces = np.maximum(1, -(-lens // PIECE))
        word = np.repeat(np.arange(len(words)), pieces)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        before = np.where(nth > 0, warm, 0)
        first = starts[word] + nth * PIECE - before
        size = np.minimum(PIECE, lens[word] - nth * PIECE) + before
        order = np.argsort(-size, kind="stable")
        word, before, first, size = word[order], before[order], first[order], size[order]
        state, cost = np.full(len(word), self.start, np.int32), np.zeros(len(word))
        live = len(word)
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size[:live], -t, "left"))
            s = symbols[first[:live] + t]
            cost[:live] += np.where(before[:live] <= t, self.cost[state[:live], s], 0)
            state[:live] = self.step[state[:live], s]
        return np.bincount(word, cost, minlength=len(words))


def grow(counts: dict[bytes, dict[int, int]], least_share: float, divergence: float, smoothing: float) -> Automaton:
    """The tree of contexts, given the counts of the symbols after each frequent context (the empty one too)."""
    root = counts.get(b"", {})
    symbols = [s for s in range(256) if s not in (9, 11, 12, 13)]
    all_symbols = sum(root.values())
    base = np.full(256, 1e-12)
    for s in symbols:
        base[s] = (root.get(s, 0) + 0.5) / (all_symbols + 0.5 * len(symbols))

    def smooth(context: bytes, parent: np.ndarray) -> np.ndarray:
        own = counts.get(context, {})
        p = parent * smoothing
        for s, c in own.items():
            p[s] += c
        return p / (sum(own.values()) + smoothing)

    # From short to long, so that a parent (the context without its oldest byte) is judged first.
    dist = {b"": base}
    for context in sorted((c for c in counts if c), key=lambda c: (len(c), c)):
        n = sum(counts[context].values())
        if n < least_share * all_symbols:
            continue
        up = context[1:]
        while up not in dist:
            up = up[1:]
        ratio = sum(c * math.log(c / n / dist[up][s]) for s, c in counts[context].items())
        if ratio >= divergence * len(counts[context]) or context == bytes([BLANK]):
            dist[context] = smooth(context, dist[up])
    start = bytes([BLANK])
    if start not in dist:
        dist[start] = smooth(start, base)
    # All prefixes of a state are states: the longest suffix can then be followed step by step.
    for context in list(dist):
        for k in range(1, len(context)):
            if (part := context[:k]) not in dist:
                up = part[1:]
                while up not in dist:
                    up = up[1:]
                dist[part] = dist[up]
    names = sorted(dist, key=lambda c: (len(c), c))
    number = {c: k for k, c in enumerate(names)}
    step = np.zeros((len(names), 256), np.int32)
    cost = np.empty((len(names), 256), np.float32)
    # Shorter contexts come first: a state takes its longest proper suffix's steps, then those to its own extensions.
    longer: dict[bytes, list[int]] = defaultdict(list)
    for context in names[1:]:
        longer[context[:-1]].append(context[-1])
    for k, context in enumerate(names):
        cost[k] = np.log10(dist[context])
        if context:
            up = context[1:]
            while up not in number:
                up = up[1:]
            step[k] = step[number[up]]
        for symbol in longer[context]:
            step[k, symbol] = number[context + bytes([symbol])]
    return Automaton(step, cost, number[start], names)


def log_add(count: np.ndarray, log_rest: np.ndarray) -> np.ndarray:
    """The log10 of ``count + 10**log_rest``; long words are so unlikely that the power itself is 0."""
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(count), log_rest * math.log(10)) / math.log(10)


def _frequent(grams: DataFrame, depth: int, least_share: float) -> dict[bytes, dict[int, int]]:
    """Symbols after each context whose share is large enough: at most ``1 / least_share`` contexts of each length."""
    total = grams.agg(F.sum("n")).first()[0] or 0
    length = F.shiftrightunsigned("gram", 56)
    parts = []
    for d in range(depth + 1):
        # The last d bytes of the context and the symbol.
        parts.append(grams.where(length >= d).groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n")).withColumn("d", F.lit(d)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    context = F.shiftrightunsigned("code", 8)
    often = every.groupBy("d", context.alias("context")).agg(F.sum("n").alias("of")).where(F.col("of") >= max(1, least_share * total))
    rows = every.withColumn("context", context).join(often, ["d", "context"]).select("d", "context", F.col("code").bitwiseAND(F.lit(255)).alias("symbol"), "n")
    out: dict[bytes, dict[int, int]] = defaultdict(dict)
    for r in rows.toLocalIterator():
        out[r.context.to_bytes(r.d, "big")][r.symbol] = r.n
    return out


# --- scores ---------------------------------------------------------------------


def score(docs: DataFrame, depth: int = DEPTH, least_share: float = LEAST_SHARE, divergence: float = DIVERGENCE, smoothing: float = SMOOTHING, order: int = ORDER) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows whose ``crc32`` of the number as text leaves 2 modulo 7 are held out;
    the others train, all of them. Null texts are empty and have an end only;
    a null ``doc_id`` trains. Repeated rows count each time. If nothing trains,
    the tree is its root and symbols are equally likely. No text is too long: it
    lies in one shard. Other columns aren't read.
    """
    packed = common.pack(docs, "lm-shards", SHARD_BYTES)
    size = packed.agg(F.sum(F.length("docs"))).first()[0] or 0
    buckets = max(1, round(size * 2.5 / 40 / WORDS_A_BUCKET), min(8, size >> 20))
    names = _Names(max(1, round(size * 2.5 / 6 / CONTEXTS_A_BUCKET), min(8, size >> 20)), buckets)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob in common.each_shard(batches):
            words, docs = _numbered(blob, buckets)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "words": pa.array([words], pa.binary()), "docs": pa.array([docs], pa.binary())})

    numbered = common.materialize(packed.mapInArrow(number, "shard long, words binary, docs binary"), "lm-numbers")
    common.discard(packed)

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob, docs in common.each_shard(batches):
            own, words = _Shard(docs), common.zstandard.decompress(blob).split(b" ")
            counts = own.counts().astype(np.uint32)
            for b in np.flatnonzero(np.diff(own.cut)).tolist():
                a, z = own.cut[b], own.cut[b + 1]
                yield common.table(_ROWS, shard=[shard], bucket=[b], blob=[_words_blob(words[a:z], counts[a:z])])

    merged = common.materialize(numbered.mapInArrow(list_words, _ROWS_SQL).groupBy("bucket").applyInPandas(_merge_words(depth), _ROWS_SQL), "lm-words")

    n_tokens, n_types, n_ends = 0, 0, 0
    for row in merged.where("shard = -3").select("blob").toLocalIterator():
        a, b, c = common.expand(bytes(row.blob))[0].tolist()
        n_tokens, n_types, n_ends = n_tokens + a, n_types + b, n_ends + c

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                codes, n = common.expand(blob)
                yield pa.RecordBatch.from_pydict({"gram": pa.array(codes.view(np.int64)), "n": pa.array(n)})

    grams = merged.where("shard = -2").select("blob").mapInArrow(unfold, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = _frequent(common.materialize(grams, "lm-grams"), depth, least_share)
    for context in (b"", bytes([BLANK])):
        if n_ends:
            counts.setdefault(context, {})[END] = n_ends
    automaton = docs.sparkSession.sparkContext.broadcast(grow(counts, least_share, divergence, smoothing))

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        common.tidy()
        blobs = dict(zip(pdf["shard"], pdf["blob"], strict=True))
        words, (count, shared) = _words_of(blobs.pop(-1))
        a = automaton.value
        spelled = a.score(words)
        if words and words[0] == b"":
            spelled[0] = a.cost[a.start, END]
        # The root's distribution over words, smoothed with the spelling (Witten-Bell: as much weight as types).
        if n_tokens:
            spelled = log_add(count, math.log10(n_types) + spelled) - math.log10(n_tokens + n_types)
        rows = []
        for shard, blob in blobs.items():
            (number,) = common.expand(blob)
            rows.append((shard, int(pdf["bucket"].iloc[0]), common.squeeze(count[number], spelled[number].astype(np.float32), number, shared[number])))
        return pd.DataFrame(rows, columns=["shard", "bucket", "blob"])

    def with_answers(answers: list[DataFrame]) -> DataFrame:
        every = answers[0]
        for a in answers[1:]:
            every = every.unionByName(a)
        by_shard = every.groupBy("shard").agg(F.collect_list(F.struct("kind", "bucket", "blob")).alias("rows"))
        return numbered.join(by_shard, "shard").select("shard", "docs", "rows")

    def answered(answers: list[DataFrame], length: int) -> DataFrame:
        def list_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, docs, rows in common.each_shard(batches):
                found, p, _ = _Shard(docs).read(rows, length, names)
                yield from found.lists(shard, p)

        def answer_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
            common.tidy()
            lists = []
            for blob in pdf["blob"]:
                steps, *rest = common.expand(blob)
                lists.append((np.cumsum(steps), *rest))
            blobs = []
            for *counts, place in merge_contexts(lists, places=True):
                # The longest contexts don't grow.
                shared = place >= 0 if length < order else np.zeros(0, bool)
                blobs.append(common.squeeze(*counts, shared.astype(np.uint8), np.diff(place[shared] if len(shared) else place[:0], prepend=0)))
            return pd.DataFrame({"shard": pdf["shard"], "bucket": pdf["bucket"], "blob": blobs})

        lists = with_answers(answers).mapInArrow(list_contexts, _ROWS_SQL)
        return common.materialize(lists.groupBy("bucket").applyInPandas(answer_contexts, _ROWS_SQL).withColumn("kind", F.lit(length)), "lm-answers")

    answers = [common.materialize(merged.where("shard >= -1").groupBy("bucket").applyInPandas(answer, _ROWS_SQL).withColumn("kind", F.lit(0)), "lm-answers")]
    common.discard(merged)
    for length in range(1, order + 1):
        common.release(docs.sparkSession)
        answers.append(answered(answers, length))
    common.release(docs.sparkSession)
    floor = math.log10(n_tokens + n_types + 1)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blob, rows in common.each_shard(batches):
            own = _Shard(blob)
            found, word, count = own.read(rows, order, names)
            if order:
                found.apply([r for r in rows if r["kind"] == order], word)
            sums = lambda x: np.add.reduceat(x, own.starts) if len(own.starts) else np.empty(0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(own.numbers, pa.int64()), "held_out": pa.array(~own.train), "n_tokens": pa.array(own.ends - own.starts + 1, pa.int64()),
                "n_known": pa.array(sums((count[own.tokens] > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array([n_tokens] * len(own.numbers), pa.int64()),
                "base_score": pa.array(sums((np.log10(count + 1.0) - floor)[own.tokens]), pa.float64()), "score": pa.array(sums(word), pa.float64()),
            })

    return with_answers(answers).select("docs", "rows").mapInArrow(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def judge(head: np.ndarray, count: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The count of each context and the number of different words after it, both 0 if it is no state; its words begin at ``head``, with their counts and log10 probabilities under the parent."""
    if not len(head):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    of, log_p = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(count)))), parent.astype(float) * math.log(10)
    n, types = np.add.reduceat(count, head), np.add.reduceat((count > 0).astype(np.int64), head)
    # With one occurrence of the word left out, a word that came once is new to the context; a context's only occurrence stays.
    seen = np.flatnonzero((count > 0) & (n[of] >= LEAST_TIMES))
    out_of = n[of[seen]] > 1
    c, weight = count[seen], WORD_SMOOTHING * (types[of[seen]] - (out_of & (count[seen] == 1)))
    with np.errstate(divide="ignore"):
        gained = c * (np.logaddexp(np.log(c - out_of), np.log(weight) + log_p[seen]) - log_p[seen] - np.log(n[of[seen]] - out_of + weight))
    state = np.bincount(of[seen], gained, minlength=len(head)) >= WORD_GAIN
    return np.where(state, n, 0), np.where(state, types, 0)


def merge_contexts(lists: list[tuple[np.ndarray, ...]], places: bool = False) -> list[tuple[np.ndarray, ...]]:
    """For each list (contexts, how many words follow each, words, counts, log10 under the parent) the count of each pair, and of each context the count and the number of different words after it; 0 if the context is no state.

    With ``places`` also each pair's place among all, or -1 if one list alone has it.
    """
    before = np.concatenate([np.repeat(x[0], x[1]) for x in lists])
    after, counts, parent = (np.concatenate([x[k] for x in lists]) for k in (2, 3, 4))
    order = np.lexsort((after, before))
    before, after = before[order], after[order]
    new = np.concatenate(([True], before[1:] != before[:-1]))
    first = new | np.concatenate(([True], after[1:] != after[:-1]))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    spots = np.flatnonzero(first)
    count = np.add.reduceat(counts[order].astype(np.int64), spots)
    n, types = judge(np.flatnonzero(new[first]), count, np.minimum.reduceat(parent[order], spots))
    of, several = np.cumsum(new[first]) - 1, np.diff(np.append(spots, len(order))) > 1
    out = []
    for (context, lens, *_), own in zip(lists, np.split(place, np.cumsum([len(x[2]) for x in lists])[:-1]), strict=True):
        its = of[own[np.cumsum(lens) - lens]] if len(context) else np.empty(0, np.int64)
        out.append((count[own], n[its], types[its], *([np.where(several[own], own, -1)] if places else [])))
    return out
