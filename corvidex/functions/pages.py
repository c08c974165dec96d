"""Facts of one page to its class."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import has_ink


def area_ratio(boxes: Column, width: Column, height: Column) -> Column:
    """Summed area of boxes as a share of the page; overlaps count twice; 0 for a page without area."""
    area = F.aggregate(F.coalesce(boxes, F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")), F.lit(0.0), lambda acc, b: acc + (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]))
    return F.when(width * height != 0, area / (width * height)).otherwise(F.lit(0.0))


def upper_median(values: Column) -> Column:
    """The element at half the length of the sorted array; null if it is empty."""
    return F.when(F.size(values) > 0, F.element_at(F.sort_array(values), F.floor(F.size(values) / 2).cast("int") + 1))


def heading_count(spans: Column, text_chars: Column, least_chars: int = rules.SCANNED_CHARS, factor: float = rules.HEADING_FACTOR) -> Column:
    """Spans that are clearly larger than the median span; blank spans don't count."""
    sizes = F.transform(F.filter(spans, lambda s: has_ink(s["text"])), lambda s: s["size"])
    return _once(sizes, lambda found: F.when((text_chars >= least_chars) & (F.size(found) > 0), larger_than_median(found, factor)).otherwise(F.lit(0)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used; inside a lambda it would be for each element."""
    return F.transform(F.array(value), use)[0]


def larger_than_median(sizes: Column, factor: float = rules.HEADING_FACTOR) -> Column:
    return _once(upper_median(sizes), lambda median: F.size(F.filter(sizes, lambda x: x > median * F.lit(factor))))


def page_class(text_chars: Column, image_ratio: Column, table_ratio: Column, has_table: Column, headings: Column) -> Column:
    """The first class that fits."""
    return (
        F.when(text_chars < rules.SCANNED_CHARS, "scanned")
        .when((image_ratio >= rules.SLIDE_IMAGE_RATIO) & (text_chars < rules.SLIDE_CHARS) & (headings <= rules.SLIDE_HEADINGS), "slide_style")
        .when(table_ratio >= rules.TABLE_RATIO, "table_heavy")
        .when(has_table, "text_with_tables")
        .otherwise("text_structured")
    )
