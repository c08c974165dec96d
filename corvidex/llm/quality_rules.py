"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one bit for each failed rule.  A *policy* is a versioned mask (which bits
reject) and needs no second look at the texts; ablations are bitwise
aggregations over the ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CONTINUED = bytes(range(0x80, 0xC0))
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"

#: Measurements, in the order of the ledger's columns; ratios are taken from them by the rules.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_long_words", "n_bang_words")

SCHEMA = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES)])


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  #: SQL over the measurements, whose names stand in braces
    base: bool = False

    def failed(self, prefix: str = "") -> Column:
        return F.expr(self.fails.format(**{m: prefix + m for m in MEASURES}))


#: Version 1 of the rule set; bits are never reused.
RULES = (
    Rule(0, "too_short", "{n_words} < 50", True),
    Rule(1, "repeated_trigrams", "100 * {n_repeat_words} > 50 * {n_words}", True),
    Rule(2, "symbol_heavy", "5 * {n_symbols} > {n_words}"),
    Rule(3, "shouting", "2 * {n_upper} > {n_upper} + {n_lower}"),
    Rule(4, "duplicate_lines", "{n_lines} >= 4 AND 100 * {n_dup_lines} > 40 * {n_lines}"),
    Rule(5, "digit_heavy", "2 * {n_digits} > {word_chars}"),
    Rule(6, "word_length", "{n_words} > 0 AND ({word_chars} > 20 * {n_words} OR {word_chars} < 2 * {n_words})"),
    Rule(7, "long_words", "10 * {n_long_words} > 3 * {n_words}"),
    Rule(8, "exclaiming", "10 * {n_bang_words} > 4 * {n_words}"),
)


@dataclass(frozen=True)
class Policy:
    """A versioned choice of the rules that reject."""

    version: str
    rejects: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rejects)


BASE_MASK = sum(1 << r.bit for r in RULES if r.base)
POLICY_V1 = Policy("v1", tuple(r.name for r in RULES))


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.split()  # bytes split at exactly the six ASCII spaces
    n = len(words)
    glyphs = text.translate(None, SPACE + CONTINUED)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n >= 4:
        index: dict[bytes, int] = {}
        put = index.setdefault
        ids = np.fromiter((put(w, len(index)) for w in words), np.int64, n)
        size = len(index)
        pairs = ids[:-1] * size + ids[1:]
        if size >= 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1]
        code = pairs[:-1] * size + ids[2:]
        order = np.argsort(code)
        ranked = code[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(n, bool)
        for k in range(3):
            hit[k : k + n - 2] |= twice
        repeated = int(hit.sum())
    count = lambda chars: len(text) - len(text.translate(None, chars))
    return (
        n,
        len(glyphs),
        count(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        count(UPPER),
        count(LOWER),
        count(DIGITS),
        sum(len(w) > 40 for w in words),
        sum(b"!!" in w for w in words) if b"!!" in text else 0,
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, all measurements and ``failed_bits``: one row per input row, in one pass without a shuffle.

    A null text has no words. Rows are independent: repeated rows and a null
    ``doc_id`` come back as they are, so there are no ties. Texts are measured
    whole, one at a time; other columns of ``docs`` are not read.
    """
    common.arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in common.texts_of(batch)]
            columns = np.array(rows, np.int64).reshape(len(rows), len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], schema=SCHEMA)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = slim.mapInArrow(run, ", ".join(f"{f.name} long" for f in SCHEMA))
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.failed(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def rejected(policy: Policy = POLICY_V1) -> Column:
    """Whether ``policy`` rejects a ledger row; the base rules always do."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask | BASE_MASK).cast("long")) != 0


def apply_policy(book: DataFrame, policy: Policy = POLICY_V1) -> DataFrame:
    base = F.col("failed_bits").bitwiseAND(F.lit(BASE_MASK).cast("long")) != 0
    return book.withColumns({"base_failed": base, "kept": ~rejected(policy), "policy": F.lit(policy.version)})


def ablations(book: DataFrame, policy: Policy = POLICY_V1) -> DataFrame:
    """For each rule of ``policy``: documents that fail it, and those that only it rejects.

    One partial aggregation over bits; the result has one row per rule.
    """
    mask = policy.mask | BASE_MASK
    active = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    sums = [F.count("*").alias("n")]
    for r in rules:
        one = F.lit(1 << r.bit).cast("long")
        sums += [F.count_if(active.bitwiseAND(one) != 0).alias(f"f{r.bit}"), F.count_if(active == one).alias(f"o{r.bit}")]
    total = book.agg(*sums)
    entries = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.bit).alias("bit"), F.col(f"f{r.bit}").alias("n_failed"), F.col(f"o{r.bit}").alias("n_only"), F.col("n").alias("n_docs")) for r in rules))
    return total.select(F.inline(entries))


def keep(docs: DataFrame, policy: Policy = POLICY_V1) -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, with their columns.

    Joined back by a row's own number would need a shuffle of texts, so the
    verdict is computed where the text is: the filter runs inside the scan.
    """
    common.arrow_batches(docs.sparkSession)
    names = docs.columns
    own = f"__{uuid.uuid4().hex}_"  # no column of ``docs`` has such a name
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t) for t in common.texts_of(batch, names[at])], np.int64).reshape(-1, len(MEASURES))
            extra = [pa.array(c) for c in rows.T]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, *(f"{own}{m}" for m in MEASURES)])

    schema = StructType([*docs.schema.fields, *(StructField(f"{own}{m}", LongType()) for m in MEASURES)])
    failed = F.lit(False)
    for rule in RULES:
        if (policy.mask | BASE_MASK) >> rule.bit & 1:
            failed = failed | rule.failed(own)
    return docs.mapInArrow(run, schema).where(~failed).select(*names)
