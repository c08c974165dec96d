"""Text as Python's strings see it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that ``str.strip`` removes.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", "")


def _plain(byte: Column) -> Column:
    """Whether a first or last byte is one of ASCII's visible characters, so no white space."""
    return (byte >= F.lit(b"!")) & (byte < F.lit(b"\x7f"))


def strip_length(text: Column) -> Column:
    """Code points without the white space around them.

    The first and the last byte tell of most texts that there is none; other
    texts are searched if an end has some. Bytes are found at once, but a
    character counted from the end takes a walk over the whole text.
    """
    raw = text.cast("binary")
    ends = F.concat(F.substring(text, 1, 1), F.right(text, F.lit(1)))
    searched = (~_plain(raw) | ~_plain(F.substring(raw, -1, 1))) & ends.rlike(_SPACE)
    return F.when(searched, F.length(strip(text))).otherwise(F.length(text))


def has_ink(text: Column) -> Column:
    """``strip_length(text) > 0``, most often by a look at the first byte."""
    return _plain(text.cast("binary")) | (strip_length(text) > 0)


def error_tail(message: Column, most: int) -> Column:
    return F.right(message, F.lit(most))
