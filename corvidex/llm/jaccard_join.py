"""N-gram Jaccard join along chosen paths.

Each text is the set of its shingles of five words.  In a run, a set walks a
path: at every node a token of the set is sampled by a hash that depends on the
node alone, so sets that share many tokens choose the same child.  Sets that end
in the same leaf are compared exactly by brute force; leaves that are too large
split further along the same rule.  Independent runs repeat until a pair at the
threshold is met with the target recall.

Copies (equal shingle sets) are one *class text*; links are between different
class texts.  A pair is counted in its first common leaf only, so counts need
no list of pairs, and links leave a leaf as a forest, so rows stay linear.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import WIDTH, mix, seed, shingle_sets

THRESHOLD = 0.8
#: Nodes below the root on a path, before leaves that are too large split.
DEPTH = 2
RECALL = 0.9999
#: Sets in a leaf that brute force takes; larger leaves split while that makes them smaller.
LEAF = 1024
#: Sets of a leaf that one task holds twice at most; a larger leaf is dealt into blocks, and each pair of blocks is a task.
BLOCK_SETS = 1024


def runs_for(threshold: float, depth: int, recall: float) -> int:
    """Runs after which a pair at ``threshold`` has met with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def choose(shingles: np.ndarray, starts: np.ndarray, lens: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The child of each node: its set's least token under the node's own hash."""
    tokens = mix(shingles ^ np.repeat(nodes, lens))
    return mix(np.minimum.reduceat(tokens, starts) + nodes * np.uint64(0x2545F4914F6CDD1D))


def leaves(shingles: np.ndarray, lens: np.ndarray, depth: int, runs: int) -> np.ndarray:
    """For each set (none empty) its leaf in each run: shape ``(sets, runs)``."""
    starts = np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
    out = np.empty((len(lens), runs), np.uint64)
    for r in range(runs):
        node = np.full(len(lens), seed(3, r), np.uint64)
        for _ in range(depth):
            node = choose(shingles, starts, lens, node)
        out[:, r] = node
    return out


def signatures(docs: DataFrame, width: int, depth: int, runs: int) -> DataFrame:
    """``doc_id, print, set_key, n_shingles, paths``; a text without words has a null ``set_key``, and ``print`` is a hash of the text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                sets = shingle_sets(common.texts_of(part), width)
                lens = np.fromiter(map(len, sets), np.int64, len(sets))
                some = lens > 0
                keys = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
                paths: list = [None] * len(sets)
                if some.any():
                    met = leaves(np.concatenate([s for s in sets if len(s)]), lens[some], depth, runs).view(np.int64)
                    for k, row in zip(np.flatnonzero(some), met, strict=True):
                        paths[k] = row
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.int64()), pa.array(lens), pa.array(paths, pa.list_(pa.int64()))], names=["doc_id", "print", "set_key", "n_shingles", "paths"])

    return docs.select("doc_id", F.xxhash64("text").alias("print"), "text").mapInArrow(run, "doc_id long, print long, set_key long, n_shingles long, paths array<long>")


def _slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with bounded text, one row at least."""
    sizes = np.array([len(t) for t in common.texts_of(batch)])
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most)))
        yield batch.slice(at, n)
        at += n


# --- inside a leaf ----------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the sizes of its intersections with the sets after it; by bitmaps, a block of rows at a time."""
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    if len(sets) == 2:
        yield 0, np.array([len(np.intersect1d(sets[0], sets[1], assume_unique=True))])
        return
    tokens, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    n_bits = int(shared.sum())
    words = max(1, -(-n_bits // 64))
    bits = np.zeros((len(sets), words * 8), np.uint8)
    row = np.repeat(np.arange(len(sets)), lens)
    keep = shared[inverse]
    col, row = column[inverse][keep], row[keep]
    np.bitwise_or.at(bits, (row, col >> 3), (1 << (col & 7)).astype(np.uint8))
    bits = bits.view(np.uint64)
    step = max(1, (1 << 22) // words)
    for i in range(len(sets) - 1):
        parts = [np.bitwise_count(bits[i] & bits[j : j + step]).sum(axis=1, dtype=np.int64) for j in range(i + 1, len(sets), step)]
        yield i, np.concatenate(parts)


def near_pairs(sets: list[np.ndarray], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the numbers of later sets with Jaccard similarity of ``threshold`` or more."""
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    for i, both in overlaps(sets):
        union = lens[i] + lens[i + 1 :] - both
        yield i, np.flatnonzero(both >= threshold * union - 1e-9) + i + 1


class Forest:
    """Union-find over a leaf's sets."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def compare(members: np.ndarray, sets: list[np.ndarray], first: list[np.ndarray], level: int, threshold: float, leaf: int, recall: float, links: np.ndarray, forest: Forest, block: np.ndarray | None = None) -> None:
    """Find all links among ``members``, numbers of sets; count those that met in no earlier leaf.

    ``first`` has, for each level above, one row per set of all the leaves of
    that level and the number of the one we are in: a pair counts here only if
    they differ in every earlier one. With ``block``, only pairs of different
    blocks count.
    """
    if len(members) > leaf:
        runs = runs_for(threshold, 1, recall)
        lens = np.array([len(sets[m]) for m in members], np.int64)
        starts = np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
        joined = np.concatenate([sets[m] for m in members])
        child = np.stack([choose(joined, starts, lens, np.full(len(members), seed(5, level, r), np.uint64)) for r in range(runs)], axis=1)
        largest = max(np.unique(child[:, r], return_counts=True)[1].max() for r in range(runs))
        if largest <= 0.7 * len(members):
            at = np.zeros((len(sets), runs), np.uint64)
            at[members] = child
            for r in range(runs):
                order = np.argsort(child[:, r], kind="stable")
                for group in np.split(members[order], np.flatnonzero(np.diff(child[order, r])) + 1):
                    if len(group) > 1:
                        compare(group, sets, [*first, at[:, :r]], level + 1, threshold, leaf, recall, links, forest, block)
            return
    for i, near in near_pairs([sets[m] for m in members], threshold):
        if not len(near):
            continue
        a, others = members[i], members[near]
        if block is not None:
            others = others[block[others] != block[a]]
        new = np.ones(len(others), bool)
        for above in first:
            if above.shape[1]:
                new &= ~(above[others] == above[a]).any(axis=1)
        links[a] += new.sum()
        np.add.at(links, others[new], 1)
        for b in others:
            forest.join(a, b)


# --- the join ---------------------------------------------------------------


def _classed(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, depth: int = DEPTH, recall: float = RECALL, leaf: int = LEAF, block_sets: int = BLOCK_SETS) -> DataFrame:
    """``doc_id, print, set_key, class_key, class_id, n_links, n_copies`` for every row of ``docs``; a class has one ``class_key``."""
    runs = runs_for(threshold, depth, recall)
    common.arrow_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = common.materialize(signatures(slim, width, depth, runs), "jaccard-rows")
    known = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    texts = known.groupBy("set_key").agg(F.min(F.struct("doc_id", "paths")).alias("m"), F.count("*").alias("n_copies")).select("set_key", F.col("m.doc_id").alias("rep"), F.col("m.paths").alias("paths"), "n_copies")
    texts = common.materialize(texts, "jaccard-texts")

    # Leaves with several texts; leaves with the same texts in them are one.
    walks = texts.select("rep", "set_key", F.posexplode("paths").alias("run", "leaf"))
    crowd = walks.groupBy("run", "leaf").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("set_key")).alias("sum1"), F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("sum2")).where("n > 1")
    crowd = crowd.groupBy("n", "sum1", "sum2").agg(F.min(F.struct("run", "leaf")).alias("m")).select("m.run", "m.leaf", F.ceil(F.col("n") / block_sets).cast("int").alias("blocks"))
    # A leaf of several blocks has a task for each pair of blocks; a text goes to those of its own block.
    own = F.pmod(F.xxhash64("set_key", F.lit(9)), F.col("blocks")).cast("int")
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct("run", "leaf", F.least(b, own).alias("low"), F.greatest(b, own).alias("high"), own.alias("own")))
    places = walks.join(crowd, ["run", "leaf"]).select("rep", "set_key", F.explode(tasks).alias("place")).groupBy("rep", "set_key").agg(F.collect_list("place").alias("places"))
    places = common.materialize(places.join(texts.select("rep", "set_key", "paths"), ["rep", "set_key"]), "jaccard-places")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each leaf that a text is in, with its shingles."""
        for batch in batches:
            for part in _slices(batch, 2 << 20):
                out: dict[str, list] = {"node": [], "run": [], "leaf": [], "low": [], "high": [], "own": [], "paths": [], "shingles": []}
                keys, paths, spots = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("set_key", "paths", "places"))
                for key, path, places_of, s in zip(keys, paths, spots, shingle_sets(common.texts_of(part), width), strict=True):
                    if not len(s) or xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) != key:
                        continue  # another row with this doc_id
                    blob = common.zstandard.compress(s.tobytes(), 1)
                    for spot in places_of:
                        for c, v in (("node", key), *spot.items(), ("paths", path), ("shingles", blob)):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict({"node": pa.array(out["node"], pa.int64()), "run": pa.array(out["run"], pa.int32()), "leaf": pa.array(out["leaf"], pa.int64()), **{c: pa.array(out[c], pa.int32()) for c in ("low", "high", "own")}, "paths": pa.array(out["paths"], pa.list_(pa.int64())), "shingles": pa.array(out["shingles"], pa.binary())})

    held = slim.join(places, slim.doc_id == places.rep).select("set_key", "paths", "places", "text")
    spread = held.mapInArrow(load, "node long, run int, leaf long, low int, high int, own int, paths array<long>, shingles binary")

    def brute(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values("node")
        nodes, r = pdf["node"].to_numpy(), int(pdf["run"].iloc[0])
        sets = [np.frombuffer(common.zstandard.decompress(b), np.uint64) for b in pdf["shingles"]]
        links, forest = np.zeros(len(sets), np.int64), Forest(len(sets))
        paths = np.stack(pdf["paths"].to_list())[:, :r]
        cross = pdf["own"].to_numpy() if pdf["low"].iloc[0] != pdf["high"].iloc[0] else None
        compare(np.arange(len(sets)), sets, [paths], 0, threshold, leaf, recall, links, forest, cross)
        roots = nodes[[forest.root(k) for k in range(len(sets))]]
        kept = (links > 0) | (roots != nodes)
        return pd.DataFrame({"node": nodes[kept], "root": roots[kept], "links": links[kept]})

    found = common.materialize(spread.groupBy("run", "leaf", "low", "high").applyInPandas(brute, "node long, root long, links long"), "jaccard-links")
    classes = common.components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")), "jaccard-classes")
    counts = found.groupBy(F.col("node").alias("set_key")).agg(F.sum("links").alias("links"))
    # A number that several texts carry names a class only if it has no other.
    twice = known.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high").select("doc_id")
    names = known.select("doc_id", "set_key").distinct().join(twice.withColumn("shared", F.lit(1)), "doc_id", "left").groupBy("set_key").agg(F.min(F.struct(F.coalesce("shared", F.lit(0)).alias("shared"), "doc_id")).alias("name"))
    nodes = texts.select("set_key", "n_copies").join(counts, "set_key", "left").join(names, "set_key").join(classes, F.col("set_key") == F.col("node"), "left").select("set_key", F.coalesce("component", "set_key").alias("class_key"), "name", F.coalesce("links", F.lit(0)).cast("long").alias("links"), "n_copies")
    nodes = common.materialize(nodes, "jaccard-nodes")
    named = nodes.groupBy("class_key").agg(F.min("name").alias("name")).select("class_key", F.col("name.doc_id").alias("class"))
    every = nodes.drop("name").join(named, "class_key")
    usable = F.col("doc_id").isNotNull()
    return rows.select("doc_id", "print", "set_key").join(every, "set_key", "left").select("doc_id", "print", "set_key", "class_key", F.when(usable, F.coalesce("class", "doc_id")).alias("class_id"), F.when(usable, F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), F.when(usable, F.coalesce("n_copies", F.lit(1))).cast("long").alias("n_copies"))


def join(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` for every row of ``docs(doc_id, text)``.

    ``class_id`` is the least ``doc_id`` of all documents that links or equal
    sets connect (of those that only one text carries, if there are any);
    ``n_links`` counts the different other texts (shingle sets) whose similarity
    to this one is ``threshold`` or more; ``n_copies`` counts the rows with an
    equal set. Texts count, not numbers: rows with one ``doc_id`` and different
    texts are different, repeated rows are copies. A text without words (null
    and empty ones too) is alone in its class; a row with a null ``doc_id``
    isn't compared and its ``class_id`` is null. Texts may be of any length: a
    task holds the shingles of one leaf. Where more than ``leaf`` sets in a
    leaf are split further, pairs that meet in no split count with the
    probability ``recall`` like all others. Other columns aren't read.
    ``options`` are ``threshold``, ``width``, ``depth``, ``recall``, ``leaf``
    and ``block_sets``.
    """
    return _classed(docs, **options).select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of ``docs``: that with the least ``doc_id``, of several texts with it that with the least hash.

    Rows with a null ``doc_id`` and texts without words belong to no class and stay.
    """
    of = _classed(docs, **options).where("class_key IS NOT NULL AND doc_id IS NOT NULL")
    first = of.groupBy("class_key").agg(F.min(F.struct("doc_id", "print")).alias("m")).select("m.doc_id", "m.print")
    mark, number = (f"{c}_{uuid.uuid4().hex}" for c in ("print", "number"))  # no column of the documents has these names
    marked = docs.withColumns({mark: F.xxhash64(F.col("text").cast("string")), number: F.col("doc_id").cast("long")})
    spare = F.expr(r"doc_id IS NULL OR coalesce(cast(text AS string), '') RLIKE '^[\\x20\\x09-\\x0D]*$'")
    chosen = marked.where(~spare).join(first.select(F.col("doc_id").alias(number), F.col("print").alias(mark)), [number, mark], "left_semi").dropDuplicates([number, mark])
    return chosen.select(*docs.columns).unionByName(docs.where(spare))
