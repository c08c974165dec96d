"""Removal of long repeated substrings with suffix arrays over shards.

A byte goes if a string of ``width`` bytes that covers it also starts in a
document with a smaller number.  Each such string, a *window*, is owned by its
*anchor*: the k-mer in it with the least hash.  Equal windows have equal
anchors, so all work is arranged by anchor, and consecutive windows with one
anchor form a *run*:

1.  Each shard lists its anchors in sorted order, with a hash of the run's bytes
    and the least document.  Buckets merge these lists by binary search.  If all
    runs of an anchor, wherever they are, hold the same bytes, the least
    document settles them; an anchor of one shard alone is settled there.
2.  Runs of the other anchors (the ends of shared passages, and chance) are
    what a shard builds its suffix array for: Larsson-Sadakane refinement sorts
    their bytes, Kasai's common prefixes group equal windows, and the sorted
    list of distinct windows is merged across shards by binary search again.
3.  Each shard unites the covered windows and cuts them out.

What crosses the network are sorted numbers (an anchor every 14 bytes or so), a
few bytes each, never windows.  One shard's list has a key once, so a string
that a third of all documents share is one entry per shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 50
KMER = 24
#: Windows hashed at once: arrays of this many numbers stay in the cache.
CHUNK = 1 << 18
#: Bytes in one suffix array; candidates of a shard beyond it take several, which merge like shards do.
ARRAY_BYTES = 1 << 20
#: Text bytes in a shard; its arrays take about 20 times as much.
SHARD_BYTES = 6 << 20
#: Anchors or windows in a bucket, on average.
BUCKET_KEYS = 750_000

_U = np.uint64
_POS_BITS = 20
_POS = _U((1 << _POS_BITS) - 1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    return x


def kmer_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each place."""
    n = len(raw)
    word = np.ndarray((n - 7,), "<u8", raw, 0, (1,)) * _U(0x9E3779B97F4A7C15)
    word ^= word >> _U(31)
    out = word[:-16] * _U(0xC2B2AE3D27D4EB4F)
    out += word[8:-8] * _U(0x165667B19E3779F9)
    out ^= out >> _U(33)
    out += word[16:] * _U(0x27D4EB2F165667C5)
    return _scramble(out)


def _combine(h: np.ndarray, *places: np.ndarray) -> np.ndarray:
    out = np.zeros(len(places[0]), _U)
    for k, p in enumerate(places):
        out += h[p] * _U(0xA0761D6478BD642F + 2 * k * 0xE7037ED1A0B428DB & 0xFFFFFFFFFFFFFFFF | 1)
        out ^= out >> _U(27)
    return _scramble(out)


class Runs:
    """The runs of a shard in order of place: first and last window, anchor, hash of the bytes and document."""

    def __init__(self, body: np.ndarray, lens: np.ndarray, width: int = WIDTH):
        ends = np.cumsum(lens)
        starts = ends - lens
        span = width - KMER + 1
        parts: list[tuple[np.ndarray, ...]] = []
        for at in range(0, max(0, len(body) - width + 1), CHUNK):
            raw = body[at : at + CHUNK + width - 1]
            n = len(raw) - width + 1
            h = kmer_hashes(raw)
            key = (h & ~_POS) | np.arange(len(h), dtype=_U)
            have = 1
            while have < span:
                step = min(have, span - have)
                key = np.minimum(key[:-step], key[step:])
                have += step
            # A window must end in the document in which it starts.
            edge = np.zeros(n + 1, np.int32)
            a, b = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + n, "left")
            lo, hi = np.clip(starts[a:b] - at, 0, n), np.clip(np.maximum(starts[a:b], ends[a:b] - width + 1) - at, 0, n)
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi, -1)
            valid = np.cumsum(edge[:-1]) > 0
            anchor = (key & _POS).astype(np.int64)
            split = np.empty(n + 1, bool)
            split[0] = split[-1] = True
            split[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
            cut = np.flatnonzero(split)
            ok = valid[cut[:-1]]
            first, last = cut[:-1][ok], cut[1:][ok] - 1
            far = last + width - KMER
            content = _combine(h, first, first + KMER, far - KMER, far) + _U(0x9FB21C651E98DF25) * (last - first).astype(_U)
            # Anchors are the least hashes: another scramble spreads them evenly over the buckets.
            parts.append((first + at, last + at, _scramble(h[anchor[first]] * _U(0x9E3779B97F4A7C15)), _scramble(content) >> _U(32)))
        join = lambda k, kind: np.concatenate([p[k] for p in parts]).astype(kind) if parts else np.empty(0, kind)
        self.first, self.last, self.anchor, self.content = join(0, np.int64), join(1, np.int64), join(2, _U), join(3, np.uint32)
        self.doc = np.searchsorted(ends, self.first, "right")


# --- suffix arrays ----------------------------------------------------------


def suffix_array(raw: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by their next ``depth`` bytes or more, and the rank of each place (equal if not told apart).

    Larsson-Sadakane: the first eight bytes sort all places into groups, then
    the rank ``h`` places on refines the groups that are still unsorted, and
    ``h`` doubles.
    """
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(_U)
    order = np.argsort(key)
    ranked = key[order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    group = np.flatnonzero(head)[np.cumsum(head) - 1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = group
    h = 8
    while h < depth:
        alone = head & np.concatenate((head[1:], [True]))
        slots = np.flatnonzero(~alone)  # groups with two members or more fill these slots
        if not len(slots):
            break
        places = order[slots]
        pair = (rank[places] << 32) + rank[np.minimum(places + h, n)] + 1
        by = np.argsort(pair)
        order[slots] = places[by]
        pair = pair[by]
        head[slots] = np.concatenate(([True], pair[1:] != pair[:-1]))
        group = np.flatnonzero(head)[np.cumsum(head) - 1]
        rank[order[slots]] = group[slots]
        h *= 2
    return order, rank[:n]


def common_prefixes(raw: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each entry of a suffix array shares with the entry before it, up to ``most``.

    Entries of one rank share ``most`` bytes and more. Elsewhere Kasai's bound,
    that the value at a place is at least that of the place before less one,
    spares comparisons: every eighth place is compared from its first byte, the
    seven after it from the bound on. The bound needs the place before to be
    sorted by bytes, so one that shares ``most`` gives none.
    """
    n = len(order)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    tied = (before >= 0) & (rank[np.maximum(before, 0)] == rank)
    padded = np.concatenate([raw, np.zeros(most + 8, np.uint8)])
    word = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    value = np.where(tied, np.minimum(most, n - np.maximum(np.arange(n), before)), 0)

    def extend(places: np.ndarray) -> None:
        live = places[(before[places] >= 0) & ~tied[places]]
        while len(live):
            at = value[live]
            differ = word[live + at] ^ word[before[live] + at]
            # Whole bytes below the lowest bit that differs.
            low = differ & (~differ + _U(1))
            same = np.where(differ == 0, 8, np.log2(np.maximum(low, _U(1)).astype(np.float64)).astype(np.int64) >> 3)
            value[live] = np.minimum(at + same, np.minimum(most, n - np.maximum(live, before[live])))
            live = live[(same == 8) & (value[live] < most) & (value[live] == at + 8)]

    extend(np.arange(0, n, 8))
    for k in range(1, 8):
        places = np.arange(k, n, 8)
        known = (before[places] >= 0) & ~tied[places]
        bound = np.where(value[places - 1] < most, np.maximum(value[places - 1] - 1, 0), 0)
        # Clipped at the end of the text.
        bound = np.minimum(bound, n - np.maximum(places, before[places]))
        value[places] = np.where(known, bound, value[places])
        extend(places)
    return value[order]


def equal_windows(raw: np.ndarray, is_window: np.ndarray, width: int) -> list[np.ndarray]:
    """``(place, class)`` of the windows, in order of the suffix array; equal strings of ``width`` bytes share a class."""
    order, rank = suffix_array(raw, width)
    lcp = common_prefixes(raw, order, rank, width)
    number = np.cumsum(lcp < width)
    chosen = is_window[order]
    return [order[chosen], number[chosen]]


# --- lists of keys, merged by binary search -----------------------------------


def _cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket in sorted keys."""
    bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], _U)
    return np.concatenate(([0], np.searchsorted(keys, bounds, "left"), [len(keys)]))


def merge_lists(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Codes for sorted lists ``(key, content, mixed, doc)``: 1 if another list has the key with a smaller document, 2 if contents differ."""
    keys = np.unique(np.concatenate([x[0] for x in lists]))
    least = np.full(len(keys), np.iinfo(np.int64).max)
    content, seen, mixed = np.zeros(len(keys), np.uint32), np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    places = [np.searchsorted(keys, x[0]) for x in lists]
    for at, (_, c, m, doc) in zip(places, lists, strict=True):
        mixed[at] |= (m > 0) | (seen[at] & (content[at] != c))
        content[at] = c
        seen[at] = True
        least[at] = np.minimum(least[at], doc)
    return [((least[at] < doc) | (mixed[at].astype(np.uint8) << 1)).astype(np.uint8) for at, (_, _, _, doc) in zip(places, lists, strict=True)]


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """The codes for a bucket's lists; what a shard wrote down for itself (a bucket below 0) passes."""
    common.tidy()
    if pdf["bucket"].iloc[0] < 0:
        return pdf
    codes = merge_lists([tuple(common.expand(b)) for b in pdf["blob"]])
    return pd.DataFrame({"shard": pdf["shard"], "bucket": pdf["bucket"], "blob": [common.squeeze(c) for c in codes]})


_ROWS = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])
_ROWS_SQL = "shard long, bucket long, blob binary"


def _list_rows(shard: int, buckets: int, keys: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    cut = _cut(keys, buckets)
    blobs, numbers = [], []
    for b in np.flatnonzero(np.diff(cut)):
        a, z = cut[b], cut[b + 1]
        numbers.append(int(b))
        blobs.append(common.squeeze(keys[a:z], *(c[a:z] for c in columns)))
    yield common.table(_ROWS, shard=[shard] * len(blobs), bucket=numbers, blob=blobs)


# --- the three passes ----------------------------------------------------------

_LAST = np.iinfo(np.int64).max


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, known, lens, text = common.unpack_texts(blob)
    order_key = np.where(known, ids, _LAST)  # a row without a number comes after all others
    return ids, known, lens, np.frombuffer(text, np.uint8), order_key


class _Anchors:
    """The distinct anchors of a shard, sorted, and the runs of each."""

    def __init__(self, runs: Runs, order_key: np.ndarray):
        self.order = np.argsort(runs.anchor, kind="stable")
        ranked = runs.anchor[self.order]
        head = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, bool)
        at = np.flatnonzero(head)
        self.of_run = np.empty(len(ranked), np.int64)
        self.of_run[self.order] = np.cumsum(head) - 1
        self.key = ranked[at]
        content, doc = runs.content[self.order], order_key[runs.doc[self.order]]
        if len(at):
            low, high = np.minimum.reduceat(content, at), np.maximum.reduceat(content, at)
            self.content, self.mixed, self.least = low, (low != high).astype(np.uint8), np.minimum.reduceat(doc, at)
        else:
            self.content, self.mixed, self.least = np.empty(0, np.uint32), np.empty(0, np.uint8), np.empty(0, np.int64)


def _answers(rows: list, keys: int) -> np.ndarray:
    """Answers in the order of the ``keys`` (-1: any number) that a shard listed."""
    parts = [common.expand(r["blob"])[0] for r in sorted(rows, key=lambda r: r["bucket"]) if r["bucket"] >= 0]
    out = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    if keys >= 0 and len(out) != keys:
        raise RuntimeError(f"{keys} keys were listed and {len(out)} answered")
    return out


def _window_prints(first: np.ndarray, last: np.ndarray, body: np.ndarray, width: int) -> np.ndarray:
    """A fingerprint for each window of the runs, which come in order of place; equal windows have equal ones.

    Runs that follow each other are one region of text. A suffix array over
    the regions groups equal windows; the group's first member is hashed.
    """
    sizes = last - first + 1
    out = np.empty(int(sizes.sum()), _U)
    new = np.concatenate(([True], first[1:] != last[:-1] + 1)) if len(first) else np.empty(0, bool)
    start = first[new]
    n_windows = np.add.reduceat(sizes, np.flatnonzero(new)) if len(first) else np.empty(0, np.int64)
    at, done = 0, 0
    while at < len(start):
        n = max(1, int(np.searchsorted(np.cumsum(n_windows[at:] + width - 1), ARRAY_BYTES)))
        f, w = start[at : at + n], n_windows[at : at + n]
        spread = w + width - 1
        inside = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread)
        raw = body[np.repeat(f, spread) + inside]
        is_window = inside < np.repeat(w, spread)
        local, number = equal_windows(raw, is_window, width)
        head = np.concatenate(([True], number[1:] != number[:-1]))
        one = local[head]
        h = kmer_hashes(raw)
        out[done + np.cumsum(is_window)[local] - 1] = _combine(h, one, one + KMER, one + width - KMER)[np.cumsum(head) - 1]
        done += int(w.sum())
        at += n
    return out


def _mark(covered: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
    edge = np.zeros(len(covered) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, end, -1)
    covered |= np.cumsum(edge[:-1]) > 0


def repeats(docs: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs(doc_id, text)``.

    ``spans`` are the maximal removed runs as byte offsets ``(start, end)`` of
    the UTF-8 text, ``kept`` the bytes that are left. Null texts are empty.
    Strings never cross documents and are judged on the input. Rows with equal
    ``doc_id`` don't remove from each other; a row with a null ``doc_id`` counts
    as later than all others. Other columns aren't read. ``width`` may be from
    49 to 72. ``shard_bytes`` and ``bucket_keys`` bound a task's memory; with
    larger executors raise both, so that lists stay long at any scale.
    """
    if not 2 * KMER + 1 <= width <= 3 * KMER:
        raise ValueError(f"width must be from {2 * KMER + 1} to {3 * KMER}")
    packed = common.pack(docs, "suffix-shards", shard_bytes)
    total = packed.agg(F.sum(F.length("docs"))).first()[0] or 0
    buckets = max(1, round(total * 2.5 / (14 * bucket_keys)), min(8, total >> 20))

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob in common.each_shard(batches):
            _, _, lens, body, order_key = _open(blob)
            x = _Anchors(Runs(body, lens, width), order_key)
            yield from _list_rows(shard, buckets, x.key, x.content, x.mixed, x.least)

    def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blob, rows in common.each_shard(batches):
            _, _, lens, body, order_key = _open(blob)
            runs = Runs(body, lens, width)
            x = _Anchors(runs, order_key)
            code = _answers(rows or [], len(x.key))
            mixed = code[x.of_run] >= 2
            settled = ~mixed & ((code[x.of_run] == 1) | (x.least[x.of_run] < order_key[runs.doc]))
            covered = np.zeros(len(body), bool)
            _mark(covered, runs.first[settled], runs.last[settled] + width)
            # Of runs with one anchor and the same bytes, the least document's first stands for all.
            chosen = np.flatnonzero(mixed)
            alike = (x.of_run[chosen].astype(_U) << _U(32)) | runs.content[chosen].astype(_U)
            doc = order_key[runs.doc[chosen]]
            by = np.lexsort((runs.first[chosen], doc, alike))
            chosen, alike, doc = chosen[by], alike[by], doc[by]
            head = np.concatenate(([True], alike[1:] != alike[:-1])) if len(alike) else np.empty(0, bool)
            group = np.cumsum(head) - 1
            later = doc > doc[head][group]
            _mark(covered, runs.first[chosen[later]], runs.last[chosen[later]] + width)
            rep = chosen[head]
            place_order = np.argsort(runs.first[rep])
            rep = rep[place_order]
            sizes = runs.last[rep] - runs.first[rep] + 1
            prints = _window_prints(runs.first[rep], runs.last[rep], body, width)
            keys, of_window = np.unique(prints, return_inverse=True)
            least = np.full(len(keys), _LAST)
            np.minimum.at(least, of_window, np.repeat(order_key[runs.doc[rep]], sizes))
            # The windows of the representatives and of their repeats in the same document.
            slot = np.empty(len(rep), np.int64)
            slot[place_order] = np.cumsum(sizes) - sizes
            same, at = chosen[~later], slot[group[~later]]
            sizes = runs.last[same] - runs.first[same] + 1
            step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = np.repeat(runs.first[same], sizes) + step
            number = of_window[np.repeat(at, sizes) + step]
            later = np.repeat(order_key[runs.doc[same]], sizes) > least[number]
            _mark(covered, place[later], place[later] + width)
            open_ = ~later
            yield common.table(_ROWS, shard=[shard], bucket=[-1 - shard], blob=[common.squeeze(np.packbits(covered), number[open_].astype(np.uint32), place[open_].astype(np.uint32), np.array([len(keys)]))])
            yield from _list_rows(shard, buckets, keys, np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint8), least)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for blob, rows in common.each_shard(batches):
            ids, known, lens, body, _ = _open(blob)
            state = next(r for r in rows if r["bucket"] < 0)
            bits, number, place, n_keys = common.expand(state["blob"])
            covered = np.unpackbits(bits, count=len(body)).astype(bool)
            code = _answers(rows, int(n_keys[0]))
            hit = place[code[number] & 1 > 0].astype(np.int64)
            _mark(covered, hit, hit + width)
            ends = np.cumsum(lens)
            for a in range(0, len(ids), 500):
                spans, kept = [], []
                for k in range(a, min(a + 500, len(ids))):
                    gone = covered[ends[k] - lens[k] : ends[k]]
                    text = body[ends[k] - lens[k] : ends[k]]
                    if gone.any():
                        edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
                        spans.append([{"start": int(p), "end": int(q)} for p, q in edge.reshape(-1, 2)])
                        kept.append(text[~gone].tobytes())
                    else:
                        spans.append([])
                        kept.append(text.tobytes())
                z = min(a + 500, len(ids))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[a:z], mask=~known[a:z]), "n_bytes": pa.array(lens[a:z]), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    def gathered(rows: DataFrame, *columns: str) -> DataFrame:
        by_shard = rows.groupBy("shard").agg(F.collect_list(F.struct("bucket", "blob")).alias("rows"))
        return packed.join(by_shard, "shard", "left").select(*columns, "docs", "rows")

    def merged(lists: DataFrame, label: str) -> DataFrame:
        return common.materialize(lists.groupBy("bucket").applyInPandas(_merge, _ROWS_SQL), label)

    # Lists exist as shuffle files only, one kind at a time; the answers are small.
    anchors = merged(packed.mapInArrow(list_anchors, _ROWS_SQL), "suffix-anchors")
    common.release(docs.sparkSession)
    windows = merged(gathered(anchors, "shard").mapInArrow(list_windows, _ROWS_SQL), "suffix-windows")
    common.release(docs.sparkSession)
    return gathered(windows).mapInArrow(cut_out, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
