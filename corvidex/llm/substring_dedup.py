"""Near-duplicate passages by compact windows.

A passage is a run of ``least`` shingles of five words.  For a hash function,
all passages of a text with the same min-hash form *compact windows* ``(left,
centre, right)``: the nodes of the Cartesian tree over the hashes whose subtree
is wide enough.  Two passages with a min-hash in common lie in windows with the
same centre, so a window's key is the shingle at its centre.  Windows of one
key are joined as intervals: laid over each other at their centres, they give
the starts that a passage can have in both, and starts at which enough hash
functions agree are verified by their Jaccard similarity.

1.  Shards list their distinct keys in sorted order; merging the lists by binary
    search leaves the keys that several documents have.
2.  Windows of such keys with the same content are a link without more ado:
    each shard joins its own, and sorted lists of what is left (a content
    once per shard) join those of all shards.  So exact copies and repeated
    passages, however many, become classes by linear work.
    Windows without enough functions that have a shared key nearby are out, and
    so are those where every passage has too many shingles of its own, counted
    on a sample of the shingles that is taken by their hashes.
3.  A key whose documents aren't in one class by then keeps one window per
    content.  All of them meet one of the key's windows, its hub, which
    settles passages that stand in many documents; in keys that still have
    several classes they meet ``HUBS`` more, which settles most of their edited
    copies.
    From here on a window reaches as far as a passage around its centre can, so
    that copies whose edits cut their windows short are still compared whole.
4.  In keys that still have several classes every two windows of different
    ones are joined.  Windows that can hold similar passages share one of their
    rarest shingles, so a common line alone makes no pairs.  A key with very
    many windows is dealt by the rarest shingles of each, counted over the
    whole key.  No task holds the windows of a key, and none are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .jaccard_join import Forest
from .shingles import WIDTH, mix, powers, seed, shingles_of
from .suffix_dedup import _ROWS, _ROWS_SQL, _list_rows

#: Words of the shortest passage.
PASSAGE_WORDS = 50
THRESHOLD = 0.8
#: Hash functions whose windows give keys, and how many of them must have a shared key within a passage: two passages at the threshold fail with a probability of 0.007.
FUNCTIONS, ENOUGH_KEYS = 5, 2
#: One shingle of so many is looked for in other documents, and a passage may have so many more of them that no other has than others have: of 46 with 9 of its own, at most what the threshold allows, one fails with a probability of 0.0005.
SAMPLE_OF, OWN_MORE = 4, 2
#: Hash functions that are counted where two windows lie over each other, and how many must agree: of 32 with a probability of 0.8 each, fewer than 17 agree with one of 0.0002.
AGREE_OF, ENOUGH = 32, 17
KEYS_A_BUCKET = 1_000_000
#: Text bytes in a shard.
SHARD_BYTES = 16 << 20
#: Text bytes whose windows are found at once.
BLOCK = 1 << 20
#: Windows of one key that a task joins, a few MB; larger groups are split.
GROUP_WINDOWS = 16_384
#: Windows of a key that all others of it meet in the second round.
HUBS = 2
#: Windows that a task takes from several keys.
TASK_WINDOWS = 10_000

_U = np.uint64
_PLACE = _U((1 << 26) - 1)


def sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    return key


def compact_windows(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``left, centre, right`` (inclusive) of all windows with ``least`` places or more; of equal hashes the first counts as less.

    A node is wide enough exactly if it is the minimum of some run of ``least``
    places, and both its neighbours in the tree's bounds are such nodes too, so
    the tree is built over those alone.
    """
    n = len(hashes)
    if n < least:
        return (np.empty(0, np.int64),) * 3
    key = (hashes & ~_PLACE) | np.arange(n, dtype=_U)
    centre = np.unique(sliding_min(key, least) & _PLACE).astype(np.int64)
    left, right = _tree(key[centre], centre, np.zeros(len(centre), np.int64), np.full(len(centre), n))
    return left, centre, right


def _before(values: np.ndarray) -> np.ndarray:
    """The place before each that holds the nearest smaller value, -1 if none: places jump along what is known of those before them."""
    at = np.arange(-1, len(values) - 1)
    # The first jump is from the place just before, for all at once.
    open_ = np.flatnonzero(values[:-1] > values[1:]) + 1
    at[open_] -= 1
    while len(open_):
        open_ = open_[at[open_] >= 0]
        open_ = open_[values[at[open_]] > values[open_]]
        at[open_] = at[at[open_]]
    return at


def _tree(values: np.ndarray, places: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each node of a Cartesian tree; nodes of one text have the same ``first`` and ``end`` places."""
    before, after = _before(values), len(values) - 1 - _before(values[::-1])[::-1]
    left = np.where(before >= 0, places[before] + 1, 0)
    right = np.where(after < len(values), places[np.minimum(after, len(values) - 1)] - 1, np.iinfo(np.int64).max)
    return np.maximum(left, first), np.minimum(right, end - 1)


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class _Windows:
    """All windows of a shard, one per centre: ``key, row, place, left, right, content, times``; sides count to ``least - 1`` places at most."""

    def __init__(self, texts: list[bytes], least: int, functions: int):
        parts: list[tuple[np.ndarray, ...]] = []
        sampled: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lens: list[np.ndarray] = []
        for a, z in _groups(texts):
            s, n = shingles_of(texts[a:z])
            long = n >= least
            key = mix(s)
            spot = np.flatnonzero((key % _U(SAMPLE_OF) == 0) & np.repeat(long, n))
            first = np.cumsum(n) - n
            row = np.repeat(np.arange(len(n)), n)[spot]
            sampled.append((key[spot], row + a, spot - first[row]))
            lens.append(n)
            if long.any():
                parts.append(self._block(s[np.repeat(long, n)], n[long], np.flatnonzero(long) + a, least, functions))
        kinds = (_U, np.int32, np.int32, np.uint16, np.uint16, _U, np.uint8)
        self.key, self.row, self.place, self.left, self.right, self.content, self.times = (np.concatenate([p[k] for p in parts]).astype(t) if parts else np.empty(0, t) for k, t in enumerate(kinds))
        self.sample_key, self.sample_row, self.sample_place = (np.concatenate([p[k] for p in sampled]).astype(t) if sampled else np.empty(0, t) for k, t in enumerate((_U, np.int32, np.int32)))
        #: Where each text's shingles begin among all of the shard, and their end.
        self.base = np.concatenate(([0], np.cumsum(np.concatenate(lens)))) if lens else np.zeros(1, np.int64)

    @staticmethod
    def _block(s: np.ndarray, lens: np.ndarray, row: np.ndarray, least: int, functions: int) -> tuple[np.ndarray, ...]:
        """The compact windows of all texts of a block at once; a window never leaves its text."""
        end = np.cumsum(lens)
        first = end - lens
        whole = np.ones(len(s) - least + 1, bool)
        for e in end[:-1].tolist():
            whole[max(0, e - least + 1) : e] = False
        left, right, times = np.full(len(s), -1, np.int64), np.full(len(s), -1, np.int64), np.zeros(len(s), np.uint8)
        places = np.arange(len(s), dtype=_U)
        for i in range(functions):
            key = (mix(s ^ _U(seed(11, i))) & ~_PLACE) | places
            # The starts of which a place is the least follow each other.
            c = (sliding_min(key, least)[whole] & _PLACE).astype(np.int64)
            c = c[np.concatenate(([True], c[1:] != c[:-1]))]
            t = np.searchsorted(end, c, "right")
            lo, hi = _tree(key[c], c, first[t], end[t])
            # A centre of several functions has the widest of its windows.
            left[c] = np.maximum(left[c], np.minimum(c - lo, least - 1))
            right[c] = np.maximum(right[c], np.minimum(hi - c, least - 1))
            times[c] += 1
        c = np.flatnonzero(left >= 0)
        left, right = left[c], right[c]
        t = np.searchsorted(end, c, "right")
        # A hash of the window's shingles in order: they are weighted by powers of an odd number, which its start divides out.
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(s * powers(_ODD, len(s) - 1), dtype=_U)))
        content = mix((sums[c + right + 1] - sums[c - left]) * powers(_INVERSE, len(s))[c - left]) ^ mix(left.astype(_U) << _U(32) | right.astype(_U))
        return mix(s[c]), row[t], c - first[t], left, right, content, times[c]

    def supported(self, shared: np.ndarray, least: int, enough: int) -> np.ndarray:
        """The ``shared`` windows with so many functions whose centre is shared within a passage's reach, itself included; they come in order of place."""
        at = np.flatnonzero(shared)
        line = self.row[at].astype(np.int64) * (1 << 40) + self.place[at]
        until = np.concatenate(([0], np.cumsum(self.times[at].astype(np.int64))))
        return at[until[np.searchsorted(line, line + least, "left")] - until[np.searchsorted(line, line - least, "right")] >= enough]

    def holding(self, at: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
        """The windows ``at`` with a passage that has few shingles of its own, by which of the sampled ones are ``shared``."""
        total = int(self.base[-1])
        if not len(at) or total < least:
            return at[:0]
        spot = self.base[self.sample_row] + self.sample_place
        # A shingle that returns within a passage's reach counts once where it is the text's own, so that returns never speak against a passage.
        order = np.lexsort((spot, self.sample_key))
        again = np.zeros(len(spot), bool)
        again[order[1:]] = (self.sample_key[order[1:]] == self.sample_key[order[:-1]]) & (np.diff(spot[order]) < least)
        more = np.zeros(total + 1, np.int32)
        more[spot + 1] = np.where(shared, -1, np.where(again, 0, 1))
        until = np.cumsum(more, dtype=np.int32)
        good = np.concatenate(([0], np.cumsum(until[least:] - until[:-least] <= OWN_MORE, dtype=np.int32)))
        centre = self.base[self.row[at]] + self.place[at]
        low = np.maximum(centre - self.left[at], centre - least + 1)
        high = np.minimum(centre + self.right[at].astype(np.int64) - least + 1, centre)
        return at[(high >= low) & (good[np.maximum(high, low - 1) + 1] > good[low])]


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of groups of texts with about ``BLOCK`` bytes."""
    a, held = 0, 0
    for k, text in enumerate(texts, 1):
        held += len(text) + 1
        if held >= BLOCK or k == len(texts):
            yield a, k
            a, held = k, 0


def _texts(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Numbers and texts of a shard; a row without a number has an empty text here."""
    ids, known, lens, body = common.unpack_texts(blob)
    ends = np.cumsum(lens)
    return ids, [body[e - n : e] if k else b"" for e, n, k in zip(ends.tolist(), lens.tolist(), known.tolist(), strict=True)]


# --- keys that several documents have ----------------------------------------------


def _distinct(w: _Windows, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of a shard, sorted, whether its documents share each, and the key of each window and then of each sampled shingle."""
    key, row = np.concatenate((w.key, w.sample_key)), np.concatenate((w.row, w.sample_row))
    order = np.argsort(key)
    ranked, doc = key[order], ids[row][order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, bool)
    number = np.cumsum(head) - 1
    many = np.zeros(int(head.sum()), bool)
    if len(ranked):
        # Documents of a key differ if two that follow each other do, in any order.
        many[number[1:][~head[1:] & (doc[1:] != doc[:-1])]] = True
    of = np.empty(len(ranked), np.int64)
    of[order] = number
    return ranked[head], many, of


def _merge_keys(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each listed key whether several documents have it."""
    common.tidy()
    lists = [common.expand(b) for b in pdf["blob"]]
    keys, times = np.unique(np.concatenate([x[0] for x in lists]), return_counts=True)
    shared = times > 1
    spots = [np.searchsorted(keys, x[0]) for x in lists]
    for at, (_, many) in zip(spots, lists, strict=True):
        shared[at] |= many
    return pd.DataFrame({"shard": pdf["shard"], "bucket": pdf["bucket"], "blob": [common.squeeze(np.packbits(shared[at]), np.array([len(at)])) for at in spots]})


# --- windows with the same content ---------------------------------------------------


def _forest(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which of the pairs connect what those before them don't."""
    names, index = np.unique(np.concatenate([one, two]), return_inverse=True)
    n = len(one)
    forest, keep = Forest(len(names)), np.zeros(n, bool)
    code = index[:n] * len(names) + index[n:]
    for k in np.unique(code, return_index=True)[1].tolist():
        a, b = forest.root(int(index[k])), forest.root(int(index[n + k]))
        if a != b:
            forest.join(a, b)
            keep[k] = True
    return keep


_MERGED_SQL = "key long, shard long, row int, doc long, place int, left int, right int, other long, other_place int"
_MERGED = ("key", "shard", "row", "doc", "place", "left", "right", "other", "other_place")


def _merge_contents(pdf: pd.DataFrame) -> pd.DataFrame:
    """One window of each key and content, and links from the documents of the others to its document."""
    common.tidy()
    lists = [common.expand(b) for b in pdf["blob"]]
    shard = np.repeat(pdf["shard"].to_numpy(), [len(x[0]) for x in lists])
    if pdf["bucket"].iloc[0] < 0:  # links that a shard found by itself
        doc, place, left, other, other_place = (np.concatenate([x[k] for x in lists]) for k in range(5))
        found = {"doc": doc, "place": place, "left": left, "other": other, "other_place": other_place}
    else:
        both, key, doc, row, place, left, right = (np.concatenate([x[k] for x in lists]) for k in range(7))
        order = np.lexsort((row, shard, doc, both))
        both = both[order]
        head = np.concatenate(([True], both[1:] != both[:-1]))
        rep, at = order[head], order[~head]
        of = rep[np.cumsum(head)[~head] - 1]
        differ = doc[at] != doc[of]
        at, of = at[differ], of[differ]
        keep = _forest(doc[at], doc[of])
        at, of = at[keep], of[keep]
        n = len(rep)
        join = lambda a, b: np.concatenate([a, b])
        found = {
            "key": pd.array(join(key[rep].view(np.int64), np.zeros(len(at), np.int64)), "Int64"), "shard": join(shard[rep], shard[at]), "row": join(row[rep], row[at]), "doc": join(doc[rep], doc[at]),
            "place": join(place[rep], place[at]), "left": join(left[rep], left[at]), "right": join(right[rep], right[at]),
            "other": pd.array(join(np.zeros(n, np.int64), doc[of]), "Int64"), "other_place": pd.array(join(np.zeros(n, np.int32), place[of]), "Int32"),
        }
        found["key"][n:] = pd.NA
        found["other"][:n] = pd.NA
        found["other_place"][:n] = pd.NA
    out = pd.DataFrame(found)
    for c in _MERGED:
        if c not in out:
            out[c] = pd.array([None] * len(out), "Int64")
    return out[list(_MERGED)]


# --- similar windows -----------------------------------------------------------------


def _fresh(x: np.ndarray, begin: np.ndarray, least: int) -> np.ndarray:
    """Whether a place (row) is the first of its shingle in the passage of a start (column)."""
    order = np.argsort(x, kind="stable")
    before = np.full(len(x), -1)
    same = x[order][1:] == x[order][:-1]
    before[order[1:][same]] = order[:-1][same]
    place = np.arange(len(x))[:, None]
    return (before[:, None] < begin) & (place >= begin) & (place < begin + least)


def _may_hold(a: np.ndarray, b_sorted: np.ndarray, least: int, threshold: float) -> bool:
    """Whether some passage of ``a`` has as many shingles of ``b`` as a similar one must; places with a shingle count, so this is a bound where shingles return."""
    member = b_sorted[np.minimum(np.searchsorted(b_sorted, a), len(b_sorted) - 1)] == a
    until = np.concatenate(([0], np.cumsum(member)))
    most = int((until[least:] - until[:-least]).max()) if len(a) >= least else 0
    if most >= threshold * least:
        return True
    return most > 0 and len(set(a.tolist())) < len(a)


def _may_hold_any(mine: np.ndarray, others: np.ndarray, lens: np.ndarray, returning: np.ndarray, least: int, threshold: float) -> np.ndarray:
    """``_may_hold`` for each row of ``others``, a window padded to the width of all, and the sorted shingles of one."""
    member = (mine[np.minimum(np.searchsorted(mine, others), len(mine) - 1)] == others) & (np.arange(others.shape[1]) < lens[:, None])
    until = np.zeros((len(others), others.shape[1] + 1), np.int16)
    np.cumsum(member, axis=1, out=until[:, 1:])
    most = (until[:, least:] - until[:, :-least]).max(axis=1)
    return (most >= threshold * least) | ((most > 0) & returning)


def _may_hold_each(windows: list[bytes], hubs: list[bytes], least: int, threshold: float) -> np.ndarray:
    """``_may_hold`` for each window and its own hub, all at once: shingles are looked up with the number of their hub."""
    numbers: dict[bytes, int] = {}
    of = np.array([numbers.setdefault(b, len(numbers)) for b in hubs], _U)
    coded = lambda blobs, number: np.frombuffer(b"".join(blobs), np.uint32).astype(_U) | np.repeat(number, [len(b) // 4 for b in blobs]) << _U(32)
    known = np.sort(coded(list(numbers), np.arange(len(numbers), dtype=_U)))
    x = coded(windows, of)
    if not len(x) or not len(known):
        return np.zeros(len(windows), bool)
    lens = np.fromiter((len(b) // 4 for b in windows), np.int64, len(windows))
    end = np.cumsum(lens)
    until = np.concatenate(([0], np.cumsum(known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x)))
    # Runs that leave their window count nothing.
    held = np.zeros(len(x) + 1, np.int64)
    row = np.repeat(np.arange(len(windows)), lens)
    start = np.flatnonzero(np.arange(len(x)) + least <= end[row])
    held[start] = until[start + least] - until[start]
    most = np.where(lens > 0, np.maximum.reduceat(held, end - lens), 0)
    own = np.sort(x & _U(0xFFFFFFFF) | row.astype(_U) << _U(32))
    returning = np.zeros(len(windows), bool)
    returning[(own[1:][own[1:] == own[:-1]] >> _U(32)).astype(np.int64)] = True
    return (most >= threshold * least) | ((most > 0) & returning)


def verify(a: np.ndarray, at_a: int, b: np.ndarray, at_b: int, least: int, threshold: float) -> tuple[float, int, int]:
    """The best Jaccard similarity of aligned passages of ``least`` shingles around two centres, and the shift of its start from each centre.

    Sets of all starts are counted at once; the first of the best starts counts.
    """
    first = max(0, at_a - at_b)
    starts = np.arange(first, min(len(a) - least, len(b) - least + at_a - at_b) + 1)
    if not len(starts) or not _may_hold(a, np.sort(b), least, threshold):
        return 0.0, 0, 0
    shift = starts - at_a + at_b

    mine = _fresh(a, starts, least)
    until = np.zeros((len(a), len(b) + 1), np.int16)
    np.cumsum(a[:, None] == b, axis=1, out=until[:, 1:])
    both = (mine & (until[:, shift + least] > until[:, shift])).sum(axis=0)
    similarity = both / (mine.sum(axis=0) + _fresh(b, shift, least).sum(axis=0) - both)
    best = int(np.argmax(similarity))
    return float(similarity[best]), int(starts[best] - at_a), int(shift[best] - at_b)


_AGREE = np.array([seed(12, i) for i in range(AGREE_OF)], _U)


def min_hashes(runs: list[np.ndarray], least: int) -> list[np.ndarray]:
    """For each run of shingles the min-hash of each of its passages under each counted function: ``(functions, starts)``."""
    s = np.concatenate(runs).astype(_U)
    ends = np.cumsum([len(r) for r in runs])
    h = (mix(s ^ _AGREE[:, None]) >> _U(32)).astype(np.uint32)
    have = 1
    while have < least:
        step = min(have, least - have)
        h = np.minimum(h[:, :-step], h[:, step:])
        have += step
    return [h[:, e - len(r) : max(e - len(r), e - least + 1)] for r, e in zip(runs, ends.tolist(), strict=True)]


def agreeing(a: np.ndarray, at_a: int, b: np.ndarray, at_b: int) -> int:
    """The most functions that agree on a passage in both of two windows laid over each other at their centres."""
    first = max(0, at_a - at_b)
    n = min(a.shape[1], b.shape[1] + at_a - at_b) - first
    if n <= 0:
        return 0
    shift = first - at_a + at_b
    return int((a[:, first : first + n] == b[:, shift : shift + n]).sum(axis=0).max())


_LINKS_SQL = "a long, b long, a_start int, b_start int, n_words int, similarity double"
_LINKS = ["a", "b", "a_start", "b_start", "n_words", "similarity"]
_WINDOW_SQL = "key long, doc long, class long, n long, place int, at int, shingles binary"


def passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, threshold: float = THRESHOLD, functions: int = FUNCTIONS, enough_keys: int | None = None, enough: int = ENOUGH, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Links ``a, b, a_start, b_start, n_words, similarity`` that connect all documents with a near-duplicate passage in common.

    Links make classes, they don't list all pairs: of documents that hold a
    passage, one is the hub. Starts are words. Texts under ``passage_words``
    words have no passage, and no text is too long; null texts are empty; rows
    with a null ``doc_id`` aren't compared; rows with one ``doc_id`` are one
    document. Ties go to the least document. Other columns aren't read.
    ``enough_keys`` is ``ENOUGH_KEYS``, and 1 for fewer functions than
    ``FUNCTIONS``, of which two would too often not agree.
    """
    if enough_keys is None:
        enough_keys = ENOUGH_KEYS if functions >= FUNCTIONS else 1
    least = passage_words - WIDTH + 1
    if not 2 <= least <= 1 << 15:
        raise ValueError(f"passage_words must be from {WIDTH + 1} to {(1 << 15) + WIDTH - 1}")
    spark = docs.sparkSession
    packed = common.pack(docs, "passage-shards", SHARD_BYTES)
    total = packed.agg(F.sum(F.length("docs"))).first()[0] or 0
    buckets = max(1, round(total * 2.5 / 5.5 * (functions * 2 / least + 1 / SAMPLE_OF) / KEYS_A_BUCKET), min(8, total >> 20))

    def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob in common.each_shard(batches):
            ids, texts = _texts(blob)
            keys, many, _ = _distinct(_Windows(texts, least, functions), ids)
            yield from _list_rows(shard, buckets, keys, many)

    def list_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob, rows in common.each_shard(batches):
            ids, texts = _texts(blob)
            w = _Windows(texts, least, functions)
            del texts
            keys, _, of = _distinct(w, ids)
            shared = np.zeros(0, bool)
            for r in sorted(rows or [], key=lambda r: r["bucket"]):
                bits, n = common.expand(r["blob"])
                shared = np.concatenate([shared, np.unpackbits(bits, count=int(n[0])).astype(bool)])
            if len(shared) != len(keys):
                raise RuntimeError("an answer is missing")
            of = shared[of] if len(of) else shared
            at = w.holding(w.supported(of[: len(w.key)], least, enough_keys), of[len(w.key) :], least)
            both = mix(w.key[at] + w.content[at] * _U(0xC2B2AE3D27D4EB4F))
            doc = ids[w.row[at]]
            order = np.lexsort((w.place[at], w.row[at], doc, both))
            at, both, doc = at[order], both[order], doc[order]
            head = np.concatenate(([True], both[1:] != both[:-1])) if len(at) else np.empty(0, bool)
            of = np.flatnonzero(head)[np.cumsum(head) - 1] if len(at) else np.empty(0, np.int64)
            linked = np.flatnonzero(doc != doc[of])
            linked = linked[_forest(doc[linked], doc[of[linked]])]
            if len(linked):
                a, b = at[linked], at[of[linked]]
                yield common.table(_ROWS, shard=[shard], bucket=[-1 - shard], blob=[common.squeeze(ids[w.row[a]], w.place[a], w.left[a], ids[w.row[b]], w.place[b])])
            k = at[head]
            yield from _list_rows(shard, buckets, both[head], w.key[k], ids[w.row[k]], w.row[k], w.place[k], w.left[k], w.right[k])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles of all passages around the centres of wanted windows; half of a hash is enough to compare two of them."""
        for blob, wanted in common.each_shard(batches):
            _, texts = _texts(blob)
            wanted.sort(key=lambda x: x["row"])
            row, s = -1, np.empty(0, np.uint32)
            for a in range(0, len(wanted), 4000):
                part, ats, blobs = wanted[a : a + 4000], [], []
                for x in part:
                    if x["row"] != row:
                        row = x["row"]
                        s = (shingles_of([texts[row]])[0] >> _U(32)).astype(np.uint32)
                    first = max(0, x["place"] - least + 1)
                    ats.append(x["place"] - first)
                    blobs.append(s[first : x["place"] + least].tobytes())
                column = lambda c, t, part=part: pa.array([x[c] for x in part], t)
                yield pa.RecordBatch.from_arrays([*(column(c, pa.int64()) for c in ("key", "doc", "class", "n")), column("place", pa.int32()), pa.array(ats, pa.int32()), pa.array(blobs, pa.binary())], names=["key", "doc", "class", "n", "place", "at", "shingles"])

    def merged_contents() -> DataFrame:
        shared = packed.mapInArrow(list_keys, _ROWS_SQL).groupBy("bucket").applyInPandas(_merge_keys, _ROWS_SQL)
        by_shard = shared.groupBy("shard").agg(F.collect_list(F.struct("bucket", "blob")).alias("rows"))
        lists = packed.join(by_shard, "shard").select("shard", "docs", "rows").mapInArrow(list_contents, _ROWS_SQL)
        return common.materialize(lists.groupBy("bucket").applyInPandas(_merge_contents, _MERGED_SQL), "passage-contents")

    contents = merged_contents()
    common.release(spark)
    start = lambda place: (F.col(place) - F.col("left")).cast("int")
    exact = contents.where("key IS NULL").select(F.col("doc").alias("a"), F.col("other").alias("b"), start("place").alias("a_start"), start("other_place").alias("b_start"), F.lit(passage_words).alias("n_words"), F.lit(1.0).alias("similarity"))
    classed = _classed(contents.where("key IS NOT NULL").select("key", "shard", "row", "doc", "place", "left", "right"), exact, "passage-same")
    mixed = classed.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count("*").alias("n")).where("least < most").select("key", "n")
    wanted = classed.join(mixed, "key").groupBy("shard").agg(F.collect_list(F.struct("row", "place", "left", "right", "key", "doc", "class", "n")).alias("wanted"))
    open_ = common.materialize(packed.join(wanted, "shard").select("docs", "wanted").mapInArrow(fetch, _WINDOW_SQL), "passage-open")
    common.discard(packed)
    found, met = _hubs(open_, 1, least, threshold, passage_words)
    common.discard(open_)
    more, rest = _hubs(met, HUBS, least, threshold, passage_words)
    common.discard(met)
    found = found.unionByName(more)
    few = _joined(rest.where(F.col("n") <= group_windows), least, threshold, enough, passage_words)
    links = exact.unionByName(found).unionByName(few)
    many = rest.where(F.col("n") > group_windows)
    if many.take(1):
        links = links.unionByName(_rarest(many, least, threshold, enough, passage_words, group_windows))
    common.discard(rest)
    return links


def _classed(rows: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``rows`` with the ``class`` of each ``doc`` by ``links``."""
    known = common.components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), label)
    return rows.join(known, rows.doc == known.node, "left").select(*rows.columns, F.coalesce("component", "doc").alias("class"))


def _joined(windows: DataFrame, least: int, threshold: float, enough: int, passage_words: int, group_windows: int | None = None) -> DataFrame:
    """The links among ``windows`` of each key between their classes, written to the shared folder.

    A task joins many groups; those above ``group_windows``, if given, are split, and a task joins two blocks of one.
    """
    buckets = max(1, windows.count() // TASK_WINDOWS)
    none = F.lit(0)
    small = windows if group_windows is None else windows.where(F.col("n") <= group_windows)
    dealt = small.select("*", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), none.alias("one"), none.alias("two"), none.alias("block"))
    if group_windows is not None:
        blocks = F.ceil(F.col("n") / group_windows).cast("int")
        large = windows.where(F.col("n") > group_windows).withColumn("block", F.pmod(F.xxhash64("doc", "place"), blocks).cast("int"))
        large = large.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        dealt = dealt.unionByName(large.select(*windows.columns, F.col("key").alias("bucket"), F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        common.tidy()
        return pd.DataFrame(links_within(pdf, least, threshold, passage_words, enough), columns=_LINKS)

    rows = dealt.select("key", "bucket", "one", "two", "block", "doc", "class", "place", "at", "shingles")
    return common.materialize(rows.groupBy("bucket", "one", "two").applyInPandas(compare, _LINKS_SQL), "passage-near")


def _hubs(windows: DataFrame, hubs: int, least: int, threshold: float, passage_words: int) -> tuple[DataFrame, DataFrame]:
    """The links of all windows with so many of their key, and the windows whose keys still have several classes after that, with their classes by then.

    The join may split a key, so no task holds one.
    """
    window = F.struct("class", "doc", "place", "at", "shingles")
    # The first hub is of the least class, the others are any, by a hash of what they are.
    each = [F.min(window)] if hubs == 1 else [F.min_by(window, F.xxhash64(F.lit(i), "doc", "place")) for i in range(hubs)]
    chosen = windows.groupBy("key").agg(F.array_distinct(F.array(*each)).alias("hubs")).select("key", F.explode("hubs").alias("hub"))
    met = windows.join(chosen, "key").where("class <> hub.class").select("doc", "place", "at", "shingles", "class", F.col("hub.doc").alias("b"), F.col("hub.place").alias("b_place"), F.col("hub.at").alias("b_at"), F.col("hub.shingles").alias("b_shingles"), F.col("hub.class").alias("b_class"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ours, hubs_ = (batch.column(k).to_pylist() for k in ("shingles", "b_shingles"))
            may = np.concatenate([_may_hold_each(ours[k : k + 4096], hubs_[k : k + 4096], least, threshold) for k in range(0, len(ours), 4096)] or [np.zeros(0, bool)])
            for a, ap, aa, sa, ca, b, bp, ba, sb, cb in zip(*(c.to_pylist() for c in batch.filter(pa.array(may)).columns), strict=True):
                x, y = np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32)
                similarity, da, db = verify(x, aa, y, ba, least, threshold)
                if similarity >= threshold - 1e-12:
                    out.append((a, b, ap + da, bp + db, passage_words, similarity, ca, cb))
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()), strict=True)], names=[*_LINKS, "a_class", "b_class"])

    found = common.materialize(met.mapInArrow(judge, _LINKS_SQL + ", a_class long, b_class long").dropDuplicates(["a", "b"]), "passage-hubs")
    # Only classes that a link joins have new numbers, so the search is over those.
    now = common.components(found.select(F.col("a_class").alias("src"), F.col("b_class").alias("dst")), "passage-met")
    rest = windows.drop("n").join(now, F.col("class") == F.col("node"), "left").withColumn("class", F.coalesce("component", "class"))
    mixed = rest.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count("*").alias("n")).where("least < most").select("key", "n")
    return found.select(*_LINKS), common.materialize(rest.join(mixed, "key").select(*windows.columns), "passage-rest")


def _rarest(rest: DataFrame, least: int, threshold: float, enough: int, passage_words: int, group_windows: int) -> DataFrame:
    """The links within keys that have very many windows: a window goes to one group for each of its rarest shingles that others share."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each window's different shingles, and how many of them go before those that a similar window must share."""
        for batch in batches:
            spots, before, single = [], [], []
            for blob in batch.column(batch.schema.get_field_index("shingles")).to_pylist():
                run = np.frombuffer(blob, np.uint32)
                u = np.unique(run)
                spots.append(u.astype(np.int64))
                before.append(len(u) - max(1, int(np.ceil(threshold * _fewest(run, least) - 1e-9))) + 1)
                single.append(len(u))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spots, pa.list_(pa.int64())), pa.array(before, pa.int64()), pa.array(single, pa.int64())], names=[*batch.schema.names, "tokens", "prefix", "tokens_of"])

    # A window is told apart by its document and place; a place is the centre of one key.
    names = rest.columns
    tokens = rest.mapInArrow(spread, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + ", tokens array<long>, prefix long, tokens_of long")
    each = tokens.select("key", "doc", "place", "at", F.xxhash64("shingles").alias("print"), "prefix", "tokens_of", F.explode("tokens").alias("token"))
    often = each.groupBy("key", "token").agg(F.count("*").alias("times")).where("times > 1")
    ranked = each.join(often, ["key", "token"]).groupBy("key", "doc", "place", "at", "print", "prefix", "tokens_of").agg(F.array_sort(F.collect_list(F.struct("times", "token"))).alias("shared"))
    # Shingles that no other window has come first among the rarest.
    chosen = ranked.withColumn("token", F.explode(F.expr("slice(shared, 1, greatest(0, cast(prefix - (tokens_of - size(shared)) AS int)))")))
    groups = chosen.select("key", "doc", "place", "at", "print", F.col("token.token").alias("token"))
    full = rest.withColumn("print", F.xxhash64("shingles")).join(groups, ["key", "doc", "place", "at", "print"])
    full = common.materialize(full.select(F.xxhash64("key", "token").alias("key"), "doc", "class", "place", "at", "shingles"), "passage-rarest")
    sizes = full.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count("*").alias("n")).where("least < most").select("key", "n")
    near = _joined(full.join(sizes, "key").select(*names), least, threshold, enough, passage_words, group_windows)
    common.discard(full)
    return near


def _fewest(run: np.ndarray, least: int) -> int:
    """Different shingles that each passage in a window has at least."""
    if len(set(run.tolist())) == len(run):
        return min(least, len(run))
    return int(_fresh(run, np.arange(max(1, len(run) - least + 1)), least).sum(axis=0).min())


def links_within(pdf: pd.DataFrame, least: int, threshold: float, passage_words: int, enough: int = ENOUGH) -> list[tuple]:
    """Verified links of windows that share a key and whose classes differ; classes that a link joins count as one from then on."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out: list[tuple] = []
    apart = pdf["one"].iloc[0] != pdf["two"].iloc[0]
    pdf = pdf.drop_duplicates(["key", "block", "class", "shingles", "at"]).sort_values(["key", "doc", "place"])
    keys = pdf["key"].to_numpy()
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    columns = [pdf[c].tolist() for c in ("doc", "class", "block", "place", "at", "shingles")]
    for head, end in zip(heads.tolist(), [*heads[1:].tolist(), len(keys)], strict=True):
        docs, groups, blocks, places, ats, blobs = (c[head:end] for c in columns)
        if len({root(g) for g in groups}) < 2:
            continue
        runs = [np.frombuffer(b, np.uint32) for b in blobs]
        prints, ranked = None, [np.sort(r) for r in runs]
        if len(runs) <= 6:
            candidates = ((i, range(i)) for i in range(1, len(runs)))
        else:
            candidates = _sharing(runs, [root(g) for g in groups], root, least, threshold)
        lens = np.fromiter(map(len, runs), np.int64, len(runs))
        padded = np.zeros((len(runs), max(least, int(lens.max()))), np.uint32)
        for k, r in enumerate(runs):
            padded[k, : len(r)] = r
        returning = np.fromiter((bool((r[1:] == r[:-1]).any()) for r in ranked), bool, len(runs))
        for i, others in candidates:
            me = root(groups[i])
            others = [j for j in others if not (apart and blocks[i] == blocks[j]) and docs[i] != docs[j] and root(groups[j]) != me]
            passed: list[int] = []
            for k in range(0, len(others), 1024):
                at = np.array(others[k : k + 1024])
                passed += at[_may_hold_any(ranked[i], padded[at], lens[at], returning[at], least, threshold)].tolist()
            for j in passed:
                if root(groups[i]) == root(groups[j]):
                    continue
                prints = prints or min_hashes(runs, least)
                if agreeing(prints[i], ats[i], prints[j], ats[j]) < enough:
                    continue
                a, b = (i, j) if docs[i] < docs[j] else (j, i)
                similarity, da, db = verify(runs[a], ats[a], runs[b], ats[b], least, threshold)
                if similarity >= threshold - 1e-12:
                    out.append((docs[a], docs[b], places[a] + da, places[b] + db, passage_words, similarity))
                    parent[root(groups[i])] = root(groups[j])
    return out


def _sharing(runs: list[np.ndarray], own: list[int], root: Callable[[int], int], least: int, threshold: float) -> Iterator[tuple[int, list[int]]]:
    """For each window those before it, of other classes, that share one of the rarest shingles of both."""
    sets = [np.array(sorted(set(r.tolist())), np.uint32) for r in runs]
    # Each passage has at least so many different shingles, and a similar one most of them.
    shared = [max(1, int(np.ceil(threshold * _fewest(r, least) - 1e-9))) for r in runs]
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(times, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    single = int(np.searchsorted(times[order], 2))
    cut = np.cumsum([len(u) for u in sets])[:-1]
    # By shingle and class: members of one class don't look at each other.
    posted: dict[int, dict[int, list[int]]] = {}
    for i, (mine, need) in enumerate(zip((np.sort(x) for x in np.split(rank[inverse], cut)), shared, strict=True)):
        met: set[int] = set()
        me = root(own[i])
        mine = mine[: max(0, len(mine) - need + 1)]
        for v in mine[np.searchsorted(mine, single) :].tolist():
            lists = posted.setdefault(v, {})
            for g, members in lists.items():
                if g != me and root(g) != me:
                    met.update(members)
            lists.setdefault(me, []).append(i)
        if met:
            yield i, sorted(met)


def classes(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, n_links_found`` for every row of ``docs``.

    ``class_id`` is the least document that near-duplicate passages connect
    with this one, itself if none. ``n_links_found`` counts the documents that
    a link of ``passages`` joins it with: above 0 exactly if it has a
    near-duplicate, and no count of all pairs. A null ``doc_id`` has null values.
    """
    links = passages(docs, **options).select("a", "b").distinct()
    links = common.materialize(links, "passage-links")
    ends = links.select(F.col("a").alias("doc")).unionByName(links.select(F.col("b").alias("doc")))
    counts = ends.groupBy("doc").agg(F.count("*").alias("n_links"))
    groups = common.components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "passage-classes")
    found = counts.join(groups, counts.doc == groups.node).select("doc", "component", "n_links")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(found, F.col("doc_id") == F.col("doc"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links_found"))
