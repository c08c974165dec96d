"""Conflict-constrained best-fit packing.

Items go into bins of ``capacity`` tokens.  A bin carries a bitmap of the
sources and one of the duplicate clusters that it holds; two items of one
source or of one cluster never share a bin.  Bins are ordered by what is left
in them: a search starts at the tightest bin that is wide enough and goes on to
its successors until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY = 2048
#: Tokens that one group, packed by itself in one task, holds on average.
GROUP_TOKENS = 2_000_000
#: And items, as many short ones of one source make searches long.
GROUP_ITEMS = 8_192

SCHEMA = "doc_id long, piece int, bin_id string, bin_start int, doc_start long, n_tokens int, bin_tokens int"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, in the order given. Bit numbers below 0 conflict with nothing."""
    left: list[tuple[int, int]] = []  # (residual, bin), ascending
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        s_bit, c_bit = 1 << s if s >= 0 else 0, 1 << c if c >= 0 else 0
        at = bisect_left(left, (size, -1))
        while at < len(left) and (source_bits[left[at][1]] & s_bit or cluster_bits[left[at][1]] & c_bit):
            at += 1
        if at < len(left):
            residual, b = left.pop(at)
        else:
            residual, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        bins.append(b)
        offsets.append(capacity - residual)
        source_bits[b] |= s_bit
        cluster_bits[b] |= c_bit
        if residual > size:
            insort(left, (residual - size, b))
    return bins, offsets


def measure(docs: DataFrame, source: str | None = "source", tokens: str | None = None) -> DataFrame:
    """``doc_id, source, cluster, n_tokens``: without texts. A cluster is a set of rows with the same text.

    Tokens are words between ASCII spaces unless ``tokens`` names a column.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.col(tokens).cast("long") if tokens else F.expr(r"size(filter(split(coalesce(cast(text as string), ''), '[\\x20\\x09-\\x0D]+'), w -> w <> ''))").cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(source).cast("string") if source else F.lit(None).cast("string")).alias("source"), F.xxhash64(text).alias("cluster"), F.coalesce(n, F.lit(0)).alias("n_tokens"))


def pack(items: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Bins for ``items(doc_id, source, cluster, n_tokens)``.

    An item longer than ``capacity`` is cut into full pieces, bins by
    themselves, and a rest that is packed like other items. Rows are dealt into
    groups by a hash of the whole row, so that a hot source or cluster spreads
    evenly; groups are packed independently. Every row comes back: one without tokens has
    no bin. A null source or cluster conflicts with nothing; repeated rows are
    items of their own. Of bins that are equally tight the first one takes an
    item, of equally long items the one with the least number goes first. An
    item of any length makes as many pieces as it needs. Other columns aren't read.
    """
    items = common.materialize(items.select("doc_id", "source", "cluster", "n_tokens"), "pack-items")
    total, n = items.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-total // group_tokens), -(-n // group_items))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["group"].iloc[0])
        rows, rests = [], []
        pdf = pdf.sort_values(["n_tokens", "doc_id"], kind="stable")
        times = Counter(pdf["cluster"].dropna())
        source_no: dict = {}
        cluster_no: dict = {}
        for doc_id, source, cluster, n in zip(pdf["doc_id"], pdf["source"], pdf["cluster"], pdf["n_tokens"], strict=True):
            n = int(n)
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            if n <= 0:
                rows.append((doc_id, 0, None, 0, 0, 0, 0))
                continue
            full, rest = divmod(n, capacity)
            for k in range(full):
                rows.append((doc_id, k, f"{group}.{len(rows)}f", 0, k * capacity, capacity, capacity))
            if rest:
                s = -1 if pd.isna(source) else source_no.setdefault(source, len(source_no))
                c = -1 if pd.isna(cluster) or times[cluster] < 2 else cluster_no.setdefault(cluster, len(cluster_no))
                rests.append((rest, doc_id, full, s, c))
        rests.sort(key=lambda r: (-r[0], -1 if r[1] is None else r[1], r[2]))
        bins, offsets = best_fit([r[0] for r in rests], [r[3] for r in rests], [r[4] for r in rests], capacity)
        used = Counter()
        for b, r in zip(bins, rests, strict=True):
            used[b] += r[0]
        rows += [(doc_id, piece, f"{group}.{b}", at, piece * capacity, size, used[b]) for (size, doc_id, piece, _, _), b, at in zip(rests, bins, offsets, strict=True)]
        out = pd.DataFrame(rows, columns=["doc_id", "piece", "bin_id", "bin_start", "doc_start", "n_tokens", "bin_tokens"])
        return out.astype({"doc_id": "Int64"})

    dealt = items.withColumn("group", F.pmod(F.xxhash64("doc_id", "source", "cluster", "n_tokens"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(fill, SCHEMA)
