"""Places in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage


def places(rows: DataFrame, *keys: Column, place: str = "place") -> DataFrame:
    """``rows`` with their place, from 1, in the order of ``keys``.

    Ranges of keys are dealt to tasks and sorted there; a place is the place in
    a range and the number of rows in the ranges before, of which there are as
    many as shuffle partitions. Equal keys are spread too, so one of them may
    hold most rows; among them the order is that of the scan.
    """
    spark = rows.sparkSession
    ranges, tie, at = int(spark.conf.get("spark.sql.shuffle.partitions")), "__tie", "__at"
    numbered = rows.withColumn(tie, F.monotonically_increasing_id())
    order = [*keys, F.col(tie)]
    dealt = numbered.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Written, so that ranges and places are of one run.
    kept = storage.written(dealt.drop(tie).withColumn(at, F.monotonically_increasing_id()), "order")
    part = F.shiftright(at, 33)
    before, offsets = 0, []
    for r in sorted(kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        offsets += [F.lit(r.part), F.lit(before)]
        before += r.n
    if not offsets:
        return kept.select(*rows.columns, F.lit(None).cast("long").alias(place))
    return kept.select(*rows.columns, (F.create_map(*offsets)[part] + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long").alias(place))
