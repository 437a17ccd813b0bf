"""Running totals and dense numbers over sorted rows, without a one-task window.

Rows are range-partitioned and settled with their place; each partition is counted or summed
alone, and the totals of the earlier partitions (one row per partition and group) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from energy_mart.operators.joins import join_null_safe
from energy_mart.session import materialise

_PART = "__part"
_PLACE = "__place"
_BEFORE = "__before"
# monotonically_increasing_id: partition number above this many bits, row number below.
_ROW_BITS = 33


def _earlier(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Amount of each partition to the sum of the amounts before it."""
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(_BEFORE, F.coalesce(F.sum(_BEFORE).over(before), F.lit(0)))


def dense_numbers(df: DataFrame, order: Sequence[str], out: str, start: int = 0) -> DataFrame:
    """Number rows start+1, start+2, ... in ``order``; ``order`` must be unique.

    One range shuffle, one write, and a map-side addition: the sorted partitions carry their
    row numbers already.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ranged.withColumn(_PLACE, F.monotonically_increasing_id()))
    place = F.col(_PLACE)
    row = place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    split = placed.withColumn(_PART, F.shiftright(place, _ROW_BITS))
    parts = split.groupBy(_PART).agg((F.max(row) + 1).alias(_BEFORE))
    # One row per partition.
    joined = split.join(F.broadcast(_earlier(parts)), _PART)
    return joined.withColumn(out, row + F.col(_BEFORE) + F.lit(start + 1)).select(*df.columns, out)


def running_total(
    df: DataFrame, order: Sequence[str], weight: str, out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of ``weight`` up to and including each row, in ``order`` within ``by``.

    (by, order) must be unique.
    """
    ranged = materialise(
        df.repartitionByRange(*by, *order).withColumn(_PART, F.spark_partition_id())
    )
    parts = materialise(
        _earlier(ranged.groupBy(_PART, *by).agg(F.sum(weight).alias(_BEFORE)), by)
    )
    local = (
        Window.partitionBy(_PART, *by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = join_null_safe(ranged.withColumn(out, F.sum(weight).over(local)), parts, [_PART, *by])
    return joined.withColumn(out, F.col(out) + F.col(_BEFORE)).select(*df.columns, out)
