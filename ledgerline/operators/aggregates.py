"""Table queries, stats and profiles (S3, S4, A1-A3, A9) and the set/join helpers.

Every aggregate here is a single ``agg`` (one scan, partial aggregation before the shuffle);
money is summed as wide decimals so totals are exact and independent of row order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S


def money(c: Column, scale: int = 10) -> Column:
    """A money value as a decimal wide enough for its total: 38 digits, ``scale`` of them after the point.

    A double has 15 to 17 digits, so its value is kept to that scale; one too large for the decimal becomes
    NULL rather than an error.
    """
    return c.try_cast(f"decimal(38,{scale})")


def money_sum(c: Column, scale: int = 10) -> Column:
    """Exact total of a money column whatever the order of rows: decimal sum, returned as double."""
    return F.sum(money(c, scale)).cast("double")


def query_filtered(df: DataFrame, filters: dict | None = None, limit: int | None = None,
                   order_by: list[str] | None = None) -> DataFrame:
    """Conjunction of equality filters (``None`` means IS NULL), optional limit.

    Values stay literals (never spliced into SQL text), so they reach the scan as pushed filters.
    A falsy ``limit`` means no limit; with ``order_by`` the limit is a deterministic top-n.
    """
    out = df
    if filters:
        conds = [F.col(k).isNull() if v is None else (F.col(k) == F.lit(v)) for k, v in filters.items()]
        out = out.filter(reduce(lambda a, b: a & b, conds))
    if limit:
        if order_by:
            out = out.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
        out = out.limit(int(limit))
    return out


def existing_keys(df: DataFrame | None, key: str = S.KEY_COLUMN) -> DataFrame | None:
    """The key column only (Catalyst prunes the scan to it)."""
    return None if df is None else df.select(key)


def table_stats(df: DataFrame, date_col: str = S.DATE_COLUMN, amount_col: str = S.AMOUNT_COLUMN) -> DataFrame:
    """A1: count, min/max date, total and mean amount in one aggregation (nulls on empty input)."""
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                 F.sum(money(F.col(amount_col))).alias("_sum"),
                 F.count(amount_col).alias("_n"))
    return agg.select("total_rows", "min_date", "max_date",
                      F.col("_sum").cast("double").alias("total_amount"),
                      F.try_divide(F.col("_sum").cast("double"), F.nullif(F.col("_n"), F.lit(0))).alias("avg_amount"))


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A2: null count per column: one aggregation, then unpivoted to (column, nulls)."""
    cols = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls")


def profile_totals(df: DataFrame, amount_col: str = S.AMOUNT_COLUMN) -> DataFrame:
    """A2: rows, exact duplicate rows, total and mean amount.

    Duplicates come from a full-row group-by (partial aggregation before the shuffle).
    """
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"),
                                          F.sum(money(F.col(amount_col))).alias("__s"),
                                          F.count(amount_col).alias("__c"))
    agg = per_row.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total_rows"),
                      F.count(F.lit(1)).alias("_distinct"),
                      F.sum("__s").alias("_sum"), F.coalesce(F.sum("__c"), F.lit(0)).alias("_n"))
    return agg.select("total_rows", (F.col("total_rows") - F.col("_distinct")).alias("duplicate_rows"),
                      F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)).alias("total_amount"),
                      F.try_divide(F.col("_sum").cast("double"), F.nullif(F.col("_n"), F.lit(0))).alias("mean_amount"))


def value_counts(df: DataFrame, columns: list[str] | None = None, with_share: bool = False) -> DataFrame:
    """A3: (column, value, count[, share]) for several columns in one pass; null values not listed.

    The columns are unpivoted and grouped once (partial aggregation first). The share divides by
    all rows, nulls included: per-column totals are summed from the count table itself (one row
    per profiled column, so the broadcast side has a proven bound) and joined back on ``column``.
    No window over a column's values, however many distinct values it has, and no second scan.
    """
    cols = columns or ["tipo_operacion", "estado", "moneda"]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    if with_share:
        totals = counts.groupBy("column").agg(F.sum("count").alias("__total"))
        counts = (counts.join(F.broadcast(totals), "column", "inner")
                  .withColumn("share", F.col("count") / F.col("__total")).drop("__total"))
    return counts.filter(F.col("value").isNotNull())


def report_sample(df: DataFrame, order_by: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows by a stated order (TakeOrdered: a top-n, not a global sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def semi_existing(batch: DataFrame, target: DataFrame, key: str = S.KEY_COLUMN) -> DataFrame:
    """Rows of ``batch`` whose key exists in ``target`` (left semi join)."""
    return batch.join(target.select(key), key, "left_semi").select(*batch.columns)


def anti_new(batch: DataFrame, target: DataFrame, key: str = S.KEY_COLUMN) -> DataFrame:
    """Rows of ``batch`` whose key does not exist in ``target`` (left anti join)."""
    return batch.join(target.select(key), key, "left_anti").select(*batch.columns)


def union_all(*frames: DataFrame) -> DataFrame:
    """Append frames by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
