"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items are normalised to words and cut into windows of 13 words (an
item of fewer words is one window).  Windows of all items form the patterns of
one automaton; a text is normalised and scanned once, and hits are mapped back
to words and to code points of the original.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Nodes of one automaton, each about 60 bytes; a larger benchmark is scanned for in several blocks.
MOST_NODES = 4_000_000
#: Words of an item that are kept together, at most.
PIECE_WORDS = 5_000

#: Upper-case letters become lower-case; letters, digits and bytes of other scripts stay; the rest separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows(text: bytes, width: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


class Scanner:
    """The automaton of a set of ``(item, text)``; built once per task from a broadcast block."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows(text, width):
                owners.setdefault(w, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, own in owners.items():
            # Bytes as one character each; the spaces make a match start and end at a word's border.
            self.automaton.add_word(f" {pattern.decode('latin-1')} ", (len(pattern) + 2, pattern.count(b" ") + 1, own))
        self.filled = bool(owners)
        if self.filled:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit runs of words ``(first, end)`` and the items found."""
        words = words_of(text)
        if not self.filled or not words:
            return len(words), [], set()
        line = f" {b' '.join(words).decode('latin-1')} "
        found: set[str] = set()
        hits: list[tuple[int, int]] = []
        at, index = 0, 0
        for end, (length, n, own) in self.automaton.iter(line):
            found |= own
            # Matches come in order of their ends: the word that ends there is counted on from the last.
            index += line.count(" ", at, end)
            at = end
            hits.append((index - n, index))
        runs: list[list[int]] = []
        for a, b in sorted(hits):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        return len(words), [(a, b) for a, b in runs], found


def original_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets in the original of runs of words."""
    flat = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], flat.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


def _pieces(text: bytes, width: int) -> Iterator[tuple[bytes, int]]:
    """An item in pieces that hold all its windows, each with a bound of its automaton's nodes."""
    words = words_of(text)
    for i in range(0, max(1, len(words) - width + 1), PIECE_WORDS):
        piece = words[i : i + PIECE_WORDS + width - 1]
        if piece:
            yield b" ".join(piece), min(width, len(piece)) * (sum(map(len, piece)) + len(piece)) + 2 * len(piece)


def _blocks(benchmark: DataFrame, width: int, most_nodes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks whose automata have ``most_nodes`` nodes and those of one piece at most; the driver holds one at a time."""
    slim = benchmark.select(F.col("item_id").cast("string").alias("item"), F.encode(F.col("text"), "utf-8").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    block, held = [], 0
    for row in slim.toLocalIterator():
        for piece, nodes in _pieces(bytes(row.text), width):
            if block and held + nodes > most_nodes:
                yield block
                block, held = [], 0
            block.append((row.item, piece))
            held += nodes
    if block:
        yield block


_FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _told(ids: pa.Array, texts: list[bytes], n_words: list[int], runs: list[list[tuple[int, int]]], items: list[list[str]]) -> pa.RecordBatch:
    spans = [[{"start": a, "end": b} for a, b in original_spans(t, r)] if r else [] for t, r in zip(texts, runs, strict=True)]
    return pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()), pa.array(items, SCHEMA.field("items").type), pa.array(spans, SCHEMA.field("spans").type)], schema=SCHEMA)


def _scan_block(docs: DataFrame, items: list[tuple[str, bytes]], width: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value, width)
        for batch in batches:
            texts = common.texts_of(batch)
            found = [scanner.scan(t) for t in texts]
            yield _told(batch.column(0), texts, [n for n, _, _ in found], [r for _, r, _ in found], [sorted(o) for _, _, o in found])

    return docs.mapInArrow(run, _FOUND)


def _hits(rows: DataFrame, blocks: Iterable[list[tuple[str, bytes]]], width: int) -> DataFrame:
    """``row, runs, items`` of the texts of ``rows(row, text)`` that a block's automaton hits: a scan for each block, whose automaton is built once a task."""
    hits = []
    for items in blocks:
        shared = rows.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(shared.value, width)
            for batch in batches:
                found = [(row, r, sorted(o)) for row, t in zip(batch.column(0).to_pylist(), common.texts_of(batch), strict=True) for _, r, o in [scanner.scan(t)] if r]
                runs = [[{"a": a, "b": b} for a, b in r] for _, r, _ in found]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array(runs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array([f[2] for f in found], pa.list_(pa.string()))], names=["row", "runs", "items"])

        hits.append(common.materialize(rows.select("row", "text").mapInArrow(run, "row long, runs array<struct<a:long,b:long>>, items array<string>"), "benchmark-hits"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, hits)
    return every.groupBy("row").agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, runs, items`` of several blocks to the rows of ``scan``."""
    for batch in batches:
        texts = common.texts_of(batch)
        runs = [_merged([(x["a"], x["b"]) for x in r or []]) for r in batch.column(2).to_pylist()]
        yield _told(batch.column(0), texts, [len(words_of(t)) for t in texts], runs, [sorted(o or []) for o in batch.column(3).to_pylist()])


def _first_two(blocks: Iterator[list[tuple[str, bytes]]]) -> tuple[list[tuple[str, bytes]], Iterator[list[tuple[str, bytes]]] | None]:
    first, second = next(blocks, []), next(blocks, None)
    return first, None if second is None else itertools.chain([first, second], blocks)


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, most_nodes: int = MOST_NODES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, items, spans`` (code points of the original).

    Null or empty texts have no words; null items are no items; an empty
    benchmark hits nothing. Texts and items are read whole, however long.
    Repeated rows come back as often, each with its own text's hits; items of
    equal windows are all found. Other columns aren't read.

    An automaton has at most ``most_nodes`` nodes and those of one piece of an
    item, so what is broadcast and built is bounded. A benchmark of several
    blocks costs a scan of the texts for each and joins what they hit.
    """
    common.arrow_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first, several = _first_two(_blocks(benchmark, width, most_nodes))
    if several is None:
        return _scan_block(slim, first, width)
    rows = common.materialize(slim.withColumn("row", F.monotonically_increasing_id()), "benchmark-texts")
    return rows.join(_hits(rows, several, width), "row", "left").select("doc_id", "text", "runs", "items").mapInArrow(_merge, _FOUND)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return F.expr(f"{n_hit} > 0 AND 20 * {n_hit} >= {n_words}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def keep(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, most_nodes: int = MOST_NODES) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns; with one block of the benchmark nothing is shuffled."""
    common.arrow_batches(docs.sparkSession)
    first, several = _first_two(_blocks(benchmark, width, most_nodes))
    if several is not None:
        own = f"__{uuid.uuid4().hex}"  # no column of ``docs``
        rows = common.materialize(docs.withColumn(own, F.monotonically_increasing_id()), "benchmark-texts")
        texts = rows.select(F.col(own).alias("row"), F.col("text").cast("string").alias("text"))
        found = texts.join(_hits(texts, several, width), "row").select(F.col("row").alias("doc_id"), "text", "runs", "items").mapInArrow(_merge, _FOUND)
        return rows.join(found.where(contaminated()).select(F.col("doc_id").alias(own)), own, "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(first)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value, width)
        for batch in batches:
            found = [scanner.scan(t) for t in common.texts_of(batch, batch.schema.names[at])]
            hit = [sum(b - a for a, b in runs) for _, runs, _ in found]
            yield batch.filter(pa.array([not (h and 20 * h >= n) for h, (n, _, _) in zip(hit, found, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
