"""Fingerprints, types and sizes of file contents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def magic_extension(header: Column, table=rules.MAGIC) -> Column:
    """The extension that the leading bytes stand for; the first entry that fits counts."""
    found = None
    for prefix, ext in table:
        fits = F.startswith(header, F.unhex(F.lit(prefix)))
        found = F.when(fits, ext) if found is None else found.when(fits, ext)
    return found.otherwise(rules.UNKNOWN)


def lane_of(extension: Column, lanes=rules.LANES) -> Column:
    """The first lane that lists ``extension``, or null. The rule table is a literal map, so no join is needed."""
    table = {}
    for lane, exts in lanes:
        for ext in exts:
            table.setdefault(ext, lane)
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[extension]


def lane(extension: Column, header: Column, lanes=rules.LANES, table=rules.MAGIC) -> Column:
    """By extension, else by leading bytes, else unknown."""
    return F.coalesce(lane_of(extension, lanes), lane_of(magic_extension(header, table), lanes), F.lit(rules.UNKNOWN))


def encrypted(extension: Column, header: Column, window: int = rules.HEADER_BYTES) -> Column:
    """Whether a PDF names an encryption dictionary in its first bytes."""
    return (extension == ".pdf") & F.contains(F.substring(header, 1, window), F.lit("/Encrypt").cast("binary"))


def size_mib(length: Column) -> Column:
    return length / F.lit(1048576)


def size_mb(length: Column) -> Column:
    """Millions of bytes to two places: the nearest to the binary quotient, an exact tie to the even one.

    Whole numbers only. Beside a tie of the decimal quotient the binary one lies
    on the same side; at a tie, ``q`` is the quotient as a whole number over
    ``2**k``, and its product with a million tells the side. Exact below a
    petabyte.
    """
    cents, rest = F.floor(length / F.lit(10_000)).cast("long"), F.pmod(length, F.lit(10_000))
    quotient = length / F.lit(1e6)
    k = (F.lit(53) - F.floor(F.log2(quotient))).cast("int")
    power = F.call_function("shiftleft", F.lit(1).cast("long"), k)
    wide = lambda c: c.cast("decimal(19,0)")
    side = F.signum(wide((quotient * power).cast("long")) * F.lit(1_000_000).cast("decimal(7,0)") - wide(length) * wide(power))
    up = F.when(rest > 5000, 1).when(rest < 5000, 0).when(side > 0, 1).when(side < 0, 0).otherwise(F.pmod(cents, F.lit(2)))
    return (cents + up) / F.lit(100.0)


def _encodings(sample: pd.Series) -> pd.Series:
    try:
        from charset_normalizer import from_bytes

        def guess(b: bytes) -> str | None:
            best = from_bytes(b).best()
            return best.encoding if best else None
    except ImportError:
        from chardet import detect

        def guess(b: bytes) -> str | None:
            return detect(b)["encoding"]

    def one(b: bytes | None) -> str | None:
        if not b:
            return None
        if b.isascii():
            return "ascii"
        try:
            b.decode()
            return "utf-8"
        except UnicodeDecodeError as e:
            # A sample may end in the middle of a character.
            if e.start >= len(b) - 3 and e.reason == "unexpected end of data":
                return "utf-8"
        return guess(b)

    return sample.map(one)


def detect_encoding(sample) -> Column:
    """The likeliest encoding of each sample, or null; a Python function because no built-in one tells encodings apart."""
    return F.pandas_udf(_encodings, "string")(sample)
