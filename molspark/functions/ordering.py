"""Row positions without a single-partition window.

A plain ``row_number() OVER (ORDER BY ...)`` puts every row (or every row of a hot group) into one
task. Here rows are numbered inside the partitions of a sorted table and get the partition's offset,
so the only window without keys runs on a row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molspark.session import materialised

def dense_index(df: DataFrame, order: str, keys: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """Add the 0-based rank of `order` (unique in its group, of any ordered type) inside each `keys` group.

    Rows are numbered over the whole table by `sorted_position`, in pieces of counted rows however
    sparse the values are; a group's least number is then taken off.
    """
    keys = list(keys)
    placed = sorted_position(df, [*keys, order], "_at")
    if not keys:
        return placed.withColumnRenamed("_at", name)
    starts = placed.groupBy(*keys).agg(F.min("_at").alias("_start"))
    starts = starts.select(*(F.col(k).alias(f"_key_{k}") for k in keys), "_start")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return (
        placed.join(starts, reduce(and_, same))
        .withColumn(name, F.col("_at") - F.col("_start"))
        .drop("_at", "_start", *(f"_key_{k}" for k in keys))
    )


def sorted_position(df: DataFrame, order: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """Add the 0-based position under a total `order` of any column types.

    The range-partitioned sort is written once: partition numbers are then fixed, and the
    offsets table has one row per partition, so its broadcast is bounded by the partition count.
    """
    stamped = materialised(df.sort(*order).withColumn("_stamp", F.monotonically_increasing_id()))
    stamped = stamped.withColumn("_part", F.shiftright("_stamp", 33)).withColumn(
        "_row", F.col("_stamp").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stamped.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        stamped.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_stamp", "_part", "_row", "_offset")
    )
