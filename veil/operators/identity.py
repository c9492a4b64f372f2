"""Row ids: unique, and contiguous over a global order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.plans.tables import Kept, keep

SLICE, POSITION = "_slice", "_position"
_ORIGIN = "_origin"


def add_row_id(df: DataFrame, column: str = "_rn") -> DataFrame:
    """Unique, increasing ids with gaps. Write the table before anything joins on them."""
    return df.withColumn(column, F.monotonically_increasing_id())


def ordered_slices(df: DataFrame, *order, label: str = "slices") -> Kept:
    """Sort a table into range partitions and keep it, with slice number and position per row.

    Slices follow each other in the order; positions count from 0 in each slice. The table is
    written because range bounds are sampled anew each time a plan runs. Rows that tie on the
    order are spread by the partition they come from, so that one frequent value fills many slices.
    """
    placed = df.withColumn(_ORIGIN, F.spark_partition_id())
    order = [*order, F.col(_ORIGIN)]
    # high bits of the generated id: partition; low 33 bits: position in it
    generated = placed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *df.columns, F.monotonically_increasing_id().alias(POSITION)
    )
    return keep(
        generated.select(
            *df.columns,
            F.shiftright(POSITION, 33).cast("int").alias(SLICE),
            F.col(POSITION).bitwiseAND(F.lit((1 << 33) - 1)).alias(POSITION),
        ),
        label,
    )


def running_offsets(per_slice: DataFrame, amount: str, *groups: str) -> DataFrame:
    """Sum of ``amount`` over all earlier slices, for a table with one row per slice and group."""
    before = W.partitionBy(*groups).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    return per_slice.withColumn("_before", F.coalesce(F.sum(amount).over(before), F.lit(0)))


def number_rows(df: DataFrame, *order: str | Column, column: str = "_rn", start: int = 1) -> DataFrame:
    """Contiguous numbers over a global order, equal to ``row_number()`` over it.

    Ties are numbered arbitrarily; give an order that decides them when it matters.
    """
    slices = ordered_slices(df, *order, label="numbered").df
    # one row per range partition, so the keyless window and the broadcast stay tiny
    sizes = slices.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    offsets = running_offsets(sizes, "_size").select(SLICE, "_before")
    numbered = slices.join(F.broadcast(offsets), SLICE)
    return numbered.select(*df.columns, (F.col("_before") + F.col(POSITION) + start).alias(column))
