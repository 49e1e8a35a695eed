"""Distributed dense ranking of a distinct key set.

``dense_rank() OVER (ORDER BY k)`` without PARTITION BY plans as
``Exchange SinglePartition``: every key passes through one task. Here the keys
are range-partitioned and sorted, each task numbers its own rows, and a
per-partition offset (one row per partition: a proven size bound) turns local
positions into global ranks. The numbered set is checkpointed so the range
boundaries, which come from sampling, are fixed before offsets are derived.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.session import checkpoint_dir

_PARTITION_SHIFT = 33  # monotonically_increasing_id = partition << 33 | row


def dense_rank_distinct(keys: DataFrame, order_cols: Sequence[str], rank_col: str,
                        num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row of the DISTINCT key set
    ``keys`` in ascending ``order_cols`` order (nulls last), i.e. the dense
    rank of the key. ``keys`` must already be distinct on ``order_cols``."""
    spark = keys.sparkSession
    checkpoint_dir(spark)
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    ranged = (keys.repartitionByRange(num_partitions, *order) if num_partitions
              else keys.repartitionByRange(*order))
    numbered = (ranged.sortWithinPartitions(*order)
                      .withColumn("_mid", F.monotonically_increasing_id())
                      .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _PARTITION_SHIFT)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    sizes = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = (numbered.withColumn("_pid", pid)
                      .join(F.broadcast(offsets), "_pid")
                      .withColumn(rank_col, (F.col("_off") + local + 1).cast("bigint")))
    return ranked.drop("_pid", "_off", "_mid")
