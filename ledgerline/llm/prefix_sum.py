"""Running sums over a whole table in a global order, without a single-partition window.

The table is range-sorted, each partition is summed, the partition sums (one row per partition)
are summed up, and each row adds its partition's offset to its place inside the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.scratch import Scratch


def range_sorted(scratch: Scratch, df: DataFrame, order: list[str], rows_per_part: int = 1_000) -> DataFrame:
    """The stored table with ``part`` numbers that follow the order; order columns should be distinct together.

    ``df`` must be cheap to read twice (range partitioning samples it).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(parts, -(-df.count() // rows_per_part)))
    keys = [F.asc_nulls_last(c) for c in order]
    return scratch.store(df.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()), "ranges")


def running_sums(ranges: DataFrame, order: list[str], value: str, within: list[str] | None = None,
                 name: str = "before") -> DataFrame:
    """``ranges`` with the sum of ``value`` over all earlier rows (of the same ``within`` columns).

    ``within`` must be a prefix of ``order``; nulls in it form a group of their own.
    """
    within = within or []
    keys = [F.asc_nulls_last(c) for c in order]
    local = ranges.withColumn("_local", F.coalesce(F.sum(value).over(
        W.partitionBy("part", *within).orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    # one row for each (partition, group that it holds)
    sums = ranges.groupBy("part", *within).agg(F.sum(value).alias("_sum"))
    before = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(
        W.partitionBy(*within, *([] if within else [F.lit(0)])).orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0))).select(F.col("part").alias("_part"), *[F.col(c).alias(f"_{c}") for c in within], "_offset")
    match = F.col("part") == F.col("_part")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return local.join(before, match).withColumn(name, F.col("_local") + F.col("_offset")).drop(
        "_local", "_part", "_offset", *[f"_{c}" for c in within])
