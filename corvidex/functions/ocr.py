"""Recognized words and regions to page records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import strip, strip_length


def words(text: Column) -> Column:
    """Stripped words, without blank ones."""
    return F.filter(F.transform(text, strip), lambda w: w != "")


def page_text(text: Column) -> Column:
    return F.array_join(words(text), "\n")


def confidence(text: Column, conf: Column) -> Column:
    """Mean of the whole-number confidences of non-blank words, without negative ones; 0 if there are none."""
    seen = F.filter(F.transform(F.arrays_zip(text.alias("t"), conf.alias("c")), lambda z: F.when(strip_length(z["t"]) > 0, z["c"].cast("double").cast("int"))), lambda c: c >= 0)
    return F.when(F.size(seen) > 0, F.aggregate(seen, F.lit(0).cast("long"), lambda acc, c: acc + c) / F.size(seen)).otherwise(F.lit(0.0))


def word_count(text: Column) -> Column:
    """Non-blank words, those without a confidence included."""
    return F.size(words(text))


def regions(width: Column, height: Column, layout=rules.REGIONS) -> Column:
    """Boxes of a page's regions with the segmentation mode of each."""
    edge = lambda k: F.floor(height * k / 8).cast("int")
    return F.array(*(F.struct(F.lit(n).alias("region"), F.lit(0).alias("x0"), edge(a).alias("y0"), width.cast("int").alias("x1"), edge(b).alias("y1"), F.lit(mode).alias("psm")) for n, a, b, mode in layout))


def combined_text(found: Column) -> Column:
    """Texts of the non-blank regions in their order, a blank line between them."""
    texts = F.transform(found, lambda r: strip(r["text"]))
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n\n")
