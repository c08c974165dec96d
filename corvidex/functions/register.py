"""The library's Python functions for use from SQL."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..adapters.pdf import Opener, open_with_pymupdf
from .content import _encodings


def page_texts(opener: Opener) -> Callable:
    """A table function ``page_texts(path)``: a row for each page with its number, text and size."""

    class PageTexts:
        def eval(self, path: str) -> Iterator[tuple]:
            for n, fact in enumerate(opener(path), 1):
                yield n, fact["text"], fact["width"], fact["height"]

    return F.udtf(PageTexts, returnType="page_num int, text string, width double, height double")


class FoldPages:
    """``fold_pages(TABLE(pages) PARTITION BY key ORDER BY page)``: a document's pages to one row, read in a stream.

    The table has a key, a page number and a class, in this order and under any
    names. A row has the key, the number of pages, the pages of each class, and
    the longest run of scanned pages that follow each other. A document of any
    length takes a few counters.
    """

    @staticmethod
    def analyze(pages: AnalyzeArgument) -> AnalyzeResult:
        if not pages.isTable or len(pages.dataType.fields) < 3:
            raise ValueError("fold_pages takes a table of key, page number and class")
        key = pages.dataType.fields[0]
        profile = MapType(StringType(), IntegerType())
        return AnalyzeResult(StructType([StructField(key.name, key.dataType), StructField("page_count", IntegerType()), StructField("page_profile", profile), StructField("longest_scanned_run", IntegerType())]))

    def __init__(self):
        self.key, self.counts, self.run, self.longest, self.last = None, {}, 0, 0, None

    def eval(self, page: Row) -> None:
        self.key, number, name = page[0], page[1], page[2]
        self.counts[name] = self.counts.get(name, 0) + 1
        follows = self.last is not None and number == self.last + 1
        self.run = (self.run + 1 if follows else 1) if name == "scanned" else 0
        self.longest, self.last = max(self.longest, self.run), number

    def terminate(self) -> Iterator[tuple]:
        if self.counts:
            yield self.key, sum(self.counts.values()), self.counts, self.longest


class FoldManyPages:
    """``fold_pages`` with many documents to a partition, by Arrow batches: ``PARTITION BY bucket ORDER BY (key, page)``.

    A bucket is any function of the key. Rows are those of ``fold_pages``, with far
    fewer calls, and a page without a class counts as a page only. The counters
    of the document at a batch's end go on to the next batch.
    """

    def __init__(self):
        # Of the open document: its last key and page number, and its counters.
        self.last, self.was_scanned, self.n, self.counts, self.run, self.longest = None, False, 0, Counter(), 0, 0

    def eval(self, pages: pa.RecordBatch) -> Iterator[pa.Table]:
        if not pages.num_rows:
            return
        self.name = pages.schema.names[0]
        keys, numbers, classes = pages.columns[:3]
        # The row before each row; the first one's is the last row of the batch before.
        n, before = len(keys), self.last or (keys[:1], numbers[:1])
        starts = _differ(keys, pa.concat_arrays([before[0], keys[:-1]]))
        starts[0] |= self.last is None
        follows = _true(pc.equal(numbers, pc.add(pa.concat_arrays([before[1], numbers[:-1]]), 1))) & ~starts
        scanned = _true(pc.equal(classes, "scanned"))
        goes_on = follows & scanned & np.append(self.was_scanned, scanned[:-1])
        at = np.arange(n)
        began = np.maximum.accumulate(np.where(goes_on, -self.run, at))
        run = np.where(scanned, at - began + 1, 0)

        first = np.flatnonzero(starts)  # of each document that begins here
        opened = first[0] if len(first) else n
        self._add(classes[:opened], run[:opened])
        if len(first):
            if self.last:
                yield self._open()
            if len(first) > 1:
                yield self._closed(keys, classes, run, first)
            self.n, self.counts, self.longest = 0, Counter(), 0
            self._add(classes[first[-1] :], run[first[-1] :])
        self.last, self.was_scanned, self.run = (keys[-1:], numbers[-1:]), scanned[-1], int(run[-1])

    def _add(self, classes: pa.Array, run: np.ndarray) -> None:
        self.n += len(classes)
        for found in classes.value_counts():
            if (name := found["values"].as_py()) is not None:
                self.counts[name] += found["counts"].as_py()
        self.longest = max(self.longest, int(run.max(initial=0)))

    def _closed(self, keys: pa.Array, classes: pa.Array, run: np.ndarray, first: np.ndarray) -> pa.Table:
        """All documents that begin and end in this batch."""
        begin, end = first[0], first[-1]
        sizes = np.diff(first)
        coded = classes[begin:end].dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        n_names = len(coded.dictionary) + 1
        pairs, counts = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n_names + codes + 1, return_counts=True)
        named = pairs % n_names > 0
        pairs, counts = pairs[named], counts[named]
        offsets = np.searchsorted(pairs // n_names, np.arange(len(sizes) + 1))
        profiles = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), coded.dictionary.take(pa.array(pairs % n_names - 1)), pa.array(counts, pa.int32()))
        return self._table(keys.take(pa.array(first[:-1])), sizes, profiles, np.maximum.reduceat(run[begin:end], first[:-1] - begin))

    def _open(self) -> pa.Table:
        return self._table(self.last[0], [self.n], pa.array([list(self.counts.items())], pa.map_(pa.string(), pa.int32())), [self.longest])

    def _table(self, keys: pa.Array, sizes, profiles: pa.Array, longest) -> pa.Table:
        return pa.table([keys, pa.array(sizes, pa.int32()), profiles, pa.array(longest, pa.int32())], names=[self.name, "page_count", "page_profile", "longest_scanned_run"])

    def terminate(self) -> Iterator[pa.Table]:
        if self.last:
            yield self._open()


def _true(found: pa.Array) -> np.ndarray:
    return found.fill_null(False).to_numpy(zero_copy_only=False)


def _differ(keys: pa.Array, before: pa.Array) -> np.ndarray:
    """Where a key is not the one before it; null is a key, and so is NaN."""
    if pa.types.is_nested(keys.type):
        return np.array([a != b for a, b in zip(keys.to_pylist(), before.to_pylist())])
    same = pc.equal(keys, before)
    if pa.types.is_floating(keys.type):
        same = pc.or_kleene(same, pc.and_(pc.is_nan(keys), pc.is_nan(before)))
    return ~(_true(same) | (_true(keys.is_null()) & _true(before.is_null())))


def fold_many_pages(key: str, key_type: str) -> Callable:
    """The table function ``FoldManyPages`` for keys of one type; Spark asks Arrow functions for their columns beforehand."""
    return F.arrow_udtf(FoldManyPages, returnType=f"`{key}` {key_type}, page_count int, page_profile map<string,int>, longest_scanned_run int")


def register(spark: SparkSession, opener: Opener = open_with_pymupdf) -> None:
    """``corpus_encoding(sample)``, for lateral joins ``page_texts(path)``, and ``fold_pages`` over partitioned tables."""
    spark.udf.register("corpus_encoding", F.pandas_udf(_encodings, "string"))
    spark.udtf.register("page_texts", page_texts(opener))
    spark.udtf.register("fold_pages", F.udtf(FoldPages))
