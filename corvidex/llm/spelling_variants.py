"""Spelling variants: words at one edit from each other, found by their halves.

One edit leaves one half of a word as it is, at the start or at the end of its
variant.  So shards of the vocabulary become Aho-Corasick automata over the
halves of their words; all words of fitting length are scanned once by each, and
what shares a half in its place is verified.  Shards, and the parts of the
vocabulary that they scan, are bounded; nothing is collected.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Code points and occurrences of a word, at least.
LEAST_CHARS, LEAST_TIMES = 6, 5
#: A form occurs so many times as often as its variant, at least.
OUTWEIGH = 5
#: One run in so many, by its hash, loses a code point.
SLIP = 199
#: Words and code points of an automaton, and words that one task scans with it; both are means of hashed parts.
SHARD_WORDS, SHARD_CHARS, SCAN_WORDS = 200_000, 4_000_000, 200_000
#: Lengths up to this have a band of their own; beyond, a band holds lengths within an eighth.
EXACT = 40
#: Code points of a half that stand in the automaton, those next to its mark: links of very long words would form long chains.
PART = 32
#: Comparisons of code points that are held at once.
BLOCK = 1 << 24

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = rf"[A-Za-zÀ-ÿ]{{{LEAST_CHARS},}}"


def vocabulary(docs: DataFrame, slip: int = SLIP, least_times: int = LEAST_TIMES) -> DataFrame:
    """``word, n`` of the words of all texts, counted in Spark: partial sums before the one shuffle.

    A null text has no runs. A null ``doc_id`` has no hash, so its runs stay as
    they are. Repeated rows count each time.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(_RUN), F.lit(0))).alias("run"))
    low = runs.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.pmod("h", F.lit(slip)) == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= LEAST_CHARS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def _band(length: Column) -> Column:
    """Bands are at most a few hundred, whatever the lengths."""
    return F.when(length <= EXACT, length).otherwise(EXACT + 1 + F.floor(F.log2(length / F.lit(float(EXACT))) * 6)).cast("int")


def _tasks(words: DataFrame, shard_words: int, shard_chars: int, scan_words: int) -> DataFrame:
    """``task, scanned, word, n``: each shard's words, and those that it scans, once for each task that the shard has.

    A word is scanned by the shards of the bands of its own length and of one
    more and one less.
    """
    length = F.length("word")
    sizes = {r.band: (r.n, r.chars) for r in words.groupBy(_band(length).alias("band")).agg(F.count("*").alias("n"), F.sum(length).alias("chars")).collect()}
    shards = {b: max(1, math.ceil(n / shard_words), math.ceil(chars / shard_chars)) for b, (n, chars) in sizes.items()}
    reach = lambda b: sum(sizes.get(x, (0, 0))[0] for x in (b - 1, b, b + 1))
    parts = {b: max(1, math.ceil(reach(b) / scan_words)) for b in sizes}
    if not sizes:
        return words.select(F.lit("").alias("task"), F.lit(False).alias("scanned"), "word", "n")
    look = lambda found, band: F.create_map(*(F.lit(x).cast("int") for kv in found.items() for x in kv))[band]
    hashed = words.select("word", "n", F.xxhash64("word").alias("h"), _band(length).alias("own"), F.array_distinct(F.array(*(_band(length + d) for d in (-1, 0, 1)))).alias("bands"))
    own = hashed.select(F.col("own").alias("band"), F.pmod("h", look(shards, F.col("own"))).cast("int").alias("shard"), "word", "n", F.lit(False).alias("scanned"), F.explode(F.sequence(F.lit(0), look(parts, F.col("own")) - 1)).alias("part"))
    each = hashed.select("word", "n", "h", F.explode("bands").alias("band")).where(look(shards, F.col("band")).isNotNull())
    # Another hash than the shard's, so that parts are even within each.
    scans = each.select("band", F.explode(F.sequence(F.lit(0), look(shards, F.col("band")) - 1)).alias("shard"), "word", "n", F.lit(True).alias("scanned"), F.pmod(F.crc32(F.col("word").cast("binary")), look(parts, F.col("band"))).cast("int").alias("part"))
    return own.unionByName(scans).select(F.concat_ws("-", "band", "shard", "part").alias("task"), "scanned", "word", "n")


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, which are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of rows ``(of a, of b)`` at exactly one edit; rows differ in length by one at most."""
    if a.shape[1] > b.shape[1]:
        return one_edit(b, a)[:, ::-1]
    out, rows = [np.empty((0, 2), np.int64)], max(1, BLOCK // max(1, b.size))
    for k in range(0, len(a), rows):
        part, n = a[k : k + rows, None, :], a.shape[1]
        front = part == b[None, :, :n]
        if b.shape[1] == n:
            near = n - front.sum(axis=2, dtype=np.int32) == 1
        else:  # what agrees from the front and what agrees from the end cover the shorter word
            back = (part == b[None, :, 1:])[:, :, ::-1]
            agree = lambda x: np.where(x.all(axis=2), n, x.argmin(axis=2))
            near = agree(front) + agree(back) >= n
        found = np.argwhere(near)
        found[:, 0] += k
        out.append(found)
    return np.concatenate(out)


class Halves:
    """The automaton of a shard: the head of each word after a start mark, and the tail before an end mark.

    The marks are the check of a half's place: a head fits only at the start of
    a scanned word, a tail only at its end. Whole words are compared afterwards.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.owners: list[dict[int, list[int]]] = []
        numbers: dict[str, int] = {}
        for k, w in enumerate(words):
            cut = len(w) // 2
            for half in (f"<{w[: min(cut, PART)]}", f"{w[max(cut, len(w) - PART) :]}>"):
                number = numbers.setdefault(half, len(numbers))
                if number == len(self.owners):
                    self.owners.append(defaultdict(list))
                self.owners[number][len(w)].append(k)
        self.automaton = ahocorasick.Automaton()
        for half, number in numbers.items():
            self.automaton.add_word(half, number)
        if words:
            self.automaton.make_automaton()

    def near(self, scanned: list[str]) -> np.ndarray:
        """Distinct pairs ``(scanned, own)`` of word numbers at one edit."""
        if not self.words or not scanned:
            return np.empty((0, 2), np.int64)
        line = "".join(f"<{w}>" for w in scanned)
        lens = np.fromiter(map(len, scanned), np.int64, len(scanned))
        ends = np.cumsum(lens + 2)
        hits = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(line)), np.int64).reshape(-1, 2)
        at, half = np.searchsorted(ends, hits[:, 0], side="right"), hits[:, 1]
        order = np.lexsort((lens[at], half))
        at, half = at[order], half[order]
        key = half * (int(lens.max()) + 1) + lens[at]
        out, edges = [np.empty((0, 2), np.int64)], np.flatnonzero(np.diff(key, prepend=-1, append=-1)) if len(key) else np.empty(0, np.int64)
        for a, b in itertools.pairwise(edges):
            owners, n = self.owners[half[a]], int(lens[at[a]])
            mine = at[a:b]
            rows = _codes([scanned[k] for k in mine])
            for other in (n - 1, n, n + 1):
                if theirs := owners.get(other):
                    pairs = one_edit(rows, _codes([self.words[k] for k in theirs]))
                    out.append(np.stack([mine[pairs[:, 0]], np.array(theirs)[pairs[:, 1]]], axis=1))
        return np.unique(np.concatenate(out), axis=0)


#: Words that are scanned at once.
_LINE_WORDS, _LINE_CHARS = 20_000, 1_000_000
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by task, the shard's own words first; what each scanned word finds goes out as one row."""
    task, own, counts, halves, waiting, held = None, [], [], None, [], 0

    def flush() -> pa.RecordBatch:
        nonlocal halves
        halves = halves or Halves(own)
        pairs = halves.near(waiting)
        ns = np.array(counts, np.int64)
        # By word, then the most frequent, then the first in code-point order.
        rank = np.empty(len(own), np.int64)
        rank[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
        order = np.lexsort((rank[pairs[:, 1]], -ns[pairs[:, 1]], pairs[:, 0])) if len(pairs) else np.empty(0, np.int64)
        pairs = pairs[order]
        words, first, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        best = pairs[first, 1]
        return pa.RecordBatch.from_arrays([pa.array([waiting[k] for k in words], pa.string()), pa.array(n, pa.int64()), pa.array(ns[best] if len(best) else [], pa.int64()), pa.array([own[k] for k in best], pa.string())], schema=_NEAR)

    for batch in batches:
        for name, scanned, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != task:
                if waiting:
                    yield flush()
                task, own, counts, halves, waiting, held = name, [], [], None, [], 0
            if not scanned:
                own.append(word)
                counts.append(n)
                continue
            waiting.append(word)
            held += len(word)
            if len(waiting) >= _LINE_WORDS or held >= _LINE_CHARS:
                yield flush()
                waiting, held = [], 0
    if waiting:
        yield flush()


def neighbours(words: DataFrame, shard_words: int = SHARD_WORDS, shard_chars: int = SHARD_CHARS, scan_words: int = SCAN_WORDS) -> DataFrame:
    """``word, n_near, form_n, form`` of every word that has a near one; ``form`` is its most frequent near word, the first of equals."""
    dealt = _tasks(words, shard_words, shard_chars, scan_words).repartition("task").sortWithinPartitions("task", "scanned")
    found = dealt.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n_near", (-F.col("b.less")).alias("form_n"), F.col("b.best").alias("form"))


def roots(forms: DataFrame, most: int, label: str = "spelling") -> DataFrame:
    """``word, root`` of ``forms(word, form)``, whose chains are followed to their ends by doubling.

    Each step outweighs the one before, so the greatest count ``most`` bounds a
    chain's length and with it the rounds.
    """
    steps = max(1, math.ceil(math.log(max(most, OUTWEIGH)) / math.log(OUTWEIGH)))
    found = common.materialize(forms.select("word", F.col("form").alias("root")), f"{label}-root")
    for k in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = common.materialize(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"{label}-root{k}")
    return found


def variants(docs: DataFrame, slip: int = SLIP, least_times: int = LEAST_TIMES, **sizes: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``.

    Only ``doc_id`` and ``text`` are read. Texts are read whole; a run of any
    length is a word. Without documents, or without frequent words, there are
    no rows.
    """
    words = common.materialize(vocabulary(docs, slip, least_times), "spelling-words")
    near = words.join(neighbours(words, **sizes), "word", "left")
    outweighs = F.col("form_n") >= OUTWEIGH * F.col("n")
    found = common.materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(outweighs, F.col("form")).alias("form"), F.when(outweighs, F.col("form_n")).alias("form_n")), "spelling-near")
    most = found.agg(F.max("n")).first()[0] or 1
    ends = roots(found.where("form IS NOT NULL"), most)
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
