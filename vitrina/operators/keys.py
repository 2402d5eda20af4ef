"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.session import stored

PREFIX = 2
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_keys(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number the rows 1..n in ``order`` without moving them into one task.

    The rows are range-sorted over all tasks and numbered inside each partition;
    the partition sizes (one row per partition) give the offsets.  The sorted
    rows are stored because both steps must see the same partitions.
    """
    numbered = stored(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.col("_pos").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row + 1)
        .drop("_pos", "_part", "_before")
    )


def dense_rank_of_values(df: DataFrame, column: str, name: str, start: int = 0) -> DataFrame:
    """Distinct values of a label with their alphabetical rank.

    Labels are numbered inside their first ``PREFIX`` characters, and the number of labels
    with a smaller prefix is added: no task sees more than one prefix, and no job runs
    before the result is used.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    values = values.withColumn("_prefix", F.substring(column, 1, PREFIX))
    # One row per prefix reaches this window.
    earlier = W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    sizes = values.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_prefix", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_prefix").orderBy(column))
    numbered = values.withColumn("_row", inside).join(offsets, "_prefix")
    return numbered.select(column, (F.col("_before") + F.col("_row") + (start - 1)).alias(name))
