"""Deduplication family.

Keep-first is ``row_number() = 1`` over (keys, row order): Catalyst adds a partial
``WindowGroupLimit`` below the shuffle, so each input partition ships at most one row per key and a
hot key does not land whole in one task. When the row order is unique (a file position), keep-first
needs no row shuffle at all: it drops the later copies found by the flag operator below. Operators that must keep *every* row of a group (flag,
find) never window over the group: they aggregate per key (partial aggregation) and join the small
per-key facts back (``plans.keyjoin``). Counts come from key aggregates, not from windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S
from ledgerline.functions.hashing import content_hash_column
from ledgerline.plans.keyjoin import Stored, join_on_keys, materialize, materialize_by

STRATEGIES = ("hash", "key")
MERGE_STRATEGIES = ("first", "last", "max", "min", "sum")


def _asc(cols) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def with_content_hash(df: DataFrame, columns: list[str] | None = None, out: str = S.HASH_COLUMN,
                      hash_len: int = S.HASH_LENGTH, separator: str = "", string_null: str = "None",
                      reuse: bool = True) -> DataFrame:
    """Add the content hash; hashes already in ``out`` are kept when ``reuse`` (nulls are filled)."""
    cols = columns or S.HASH_SOURCE_COLUMNS
    fresh = content_hash_column(df.schema, cols, hash_len, separator, string_null)
    if reuse and out in df.columns:
        return df.withColumn(out, F.coalesce(F.col(out).cast("string"), fresh))
    return df.withColumn(out, fresh)


def keep_first(df: DataFrame, keys: list[str], order_by: list[str], unique_order: bool = False) -> DataFrame:
    """First row of every key group in row order; null keys form one group.

    With ``unique_order`` (no two rows share an order tuple, e.g. a file position) the rows are not
    shuffled: only (key, order) goes through a partially aggregated group-by that finds, for keys
    with copies, the first order tuple; that table (duplicated keys only) is measured and joined
    back, and every later copy is dropped. Otherwise ``row_number() = 1`` over the key.
    """
    if unique_order:
        flagged = flag_duplicates(df, order_by, keys, out="__later")
        return flagged.filter(~F.col("__later")).drop("__later")
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_asc(order_by))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_first_stored(df: DataFrame, keys: list[str], order_by: list[str]) -> tuple[DataFrame, int, int]:
    """``keep_first`` where few keys or none are expected to repeat: (stored rows, their number, bytes).

    The rows are written once and their keys counted, which moves the keys alone; only if one repeats are the rows themselves
    shuffled, and the first of each key written again.
    """
    return keep_first_dealt(df, keys, order_by)[:3]


def keep_first_dealt(df: DataFrame, keys: list[str], order_by: list[str], deal_by: str | None = None, parts: int | None = None) -> Stored:
    """``keep_first_stored``, the stored rows dealt by a column for their reader."""
    def save(frame):
        return materialize_by(frame, deal_by, parts) if deal_by in frame.columns else Stored(*materialize(frame))
    stored = save(df)
    if key_counts(stored.frame, keys).first()["final_count"] == stored.rows:
        return stored
    return save(keep_first(stored.frame, keys, order_by))


def dedup_hash(df: DataFrame, order_by: list[str], unique_order: bool = False, rare: bool = False, **hash_opts) -> DataFrame:
    """D3: content-hash dedup, keep first. ``rare``: copies are few or none, as where a unique key is part of the hash."""
    hashed, keys = with_content_hash(df, **hash_opts), [hash_opts.get("out", S.HASH_COLUMN)]
    return keep_first_stored(hashed, keys, order_by)[0] if rare else keep_first(hashed, keys, order_by, unique_order)


def dedup_key(df: DataFrame, order_by: list[str], keys: list[str] | None = None) -> DataFrame:
    """Business-key dedup, keep first (default key ``numero_operacion``)."""
    return keep_first(df, list(keys or [S.KEY_COLUMN]), order_by)


def order_value(df: DataFrame, order_by: list[str]) -> Column:
    """Row order as one value: a long row number stays a long (hash aggregates), else a struct; nulls first."""
    if len(order_by) == 1 and isinstance(df.schema[order_by[0]].dataType, T.LongType):
        return F.coalesce(F.col(order_by[0]), F.lit(-(1 << 63)))
    return F.struct(*[F.col(c) for c in order_by])


def flag_duplicates(df: DataFrame, order_by: list[str], keys: list[str] | None = None,
                    out: str = "is_duplicate") -> DataFrame:
    """``is_duplicate`` true for every row but the first of its key group (null keys group)."""
    keys = list(keys or [S.KEY_COLUMN])
    order = order_value(df, order_by)
    stats = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__first"))
             .filter(F.col("__n") > 1).drop("__n"))
    joined = join_on_keys(df, stats, keys, null_safe=True)
    flag = F.col("__first").isNotNull() & ~order.eqNullSafe(F.col("__first"))
    return joined.withColumn(out, flag).drop("__first")


def find_duplicates(df: DataFrame, keys: list[str] | None = None, sort: bool = False) -> DataFrame:
    """Every member of a key group with more than one row (null keys group together)."""
    keys = list(keys or [S.KEY_COLUMN])
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).drop("__n")
    stats = stats.withColumn("__hit", F.lit(True))
    out = join_on_keys(df, stats, keys, how="inner", null_safe=True).drop("__hit")
    if sort:
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return out


def dedup_priority(df: DataFrame, keys: list[str], priority: str = S.DATE_COLUMN, order: str = "desc",
                   tie_order: list[str] | None = None, sort: bool = False) -> DataFrame:
    """Per key keep the highest (``desc``) or lowest (``asc``) priority; null priority loses both ways.

    Any ``order`` other than ``'asc'`` means descending.
    """
    p = F.col(priority).asc_nulls_last() if order == "asc" else F.col(priority).desc_nulls_last()
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(p, *_asc(tie_order or []))
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    if sort:
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return out


def merge_duplicates(df: DataFrame, keys: list[str], strategy: dict[str, str] | None = None,
                     order_by: list[str] | None = None) -> DataFrame:
    """One row per key; per column first/last (non-null, by row order), max, min or sum.

    Rows with a null key are dropped (pandas ``groupby`` semantics); ``sum`` of only nulls is 0.
    Runs as one hash/sort aggregate with map-side partial aggregation: no hot task.
    """
    strategy = dict(strategy or {})
    bad = {v for v in strategy.values() if v not in MERGE_STRATEGIES}
    if bad:
        raise ValueError(f"Unknown merge strategy: {sorted(bad)}")
    order = F.struct(*[F.col(c) for c in (order_by or [])]) if order_by else None
    aggs = []
    for name in df.columns:
        if name in keys:
            continue
        how = strategy.get(name, "first")
        c = F.col(name)
        if how in ("first", "last"):
            if order is None:
                raise ValueError("first/last merge needs order_by")
            ord_nn = F.when(c.isNotNull(), order)
            agg = F.min_by(c, ord_nn) if how == "first" else F.max_by(c, ord_nn)
        elif how == "max":
            agg = F.max(c)
        elif how == "min":
            agg = F.min(c)
        else:
            kind = df.schema[name].dataType
            # doubles are added as decimals: the same total whatever the order of rows
            total = F.sum(c.try_cast("decimal(38,10)")).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.sum(c)
            agg = F.coalesce(total, F.lit(0).cast(kind))
        aggs.append(agg.alias(name))
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    merged = df.filter(not_null).groupBy(*keys).agg(*aggs) if aggs else df.filter(not_null).select(*keys).distinct()
    return merged.select(*df.columns)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: input rows and distinct keys (null keys one group), from a key-only aggregate."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total_input"),
                       F.count(F.lit(1)).alias("final_count"))


def dedup_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """total_input, duplicates_found, duplicates_removed, final_count (keep-first on ``keys``)."""
    kc = key_counts(df, keys)
    return kc.select("total_input",
                     (F.col("total_input") - F.col("final_count")).alias("duplicates_found"),
                     (F.col("total_input") - F.col("final_count")).alias("duplicates_removed"),
                     "final_count")


def dedup_report(stats: DataFrame) -> DataFrame:
    """The stats plus duplicate_rate and retention_rate (0 and 1 on empty input)."""
    rate = F.coalesce(F.try_divide(F.col("duplicates_removed").cast("double"),
                                   F.nullif(F.col("total_input"), F.lit(0))), F.lit(0.0))
    return stats.select("*", rate.alias("duplicate_rate"), (F.lit(1.0) - rate).alias("retention_rate"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.distinct()


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows, from one aggregate over all columns."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg((F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))).cast("long").alias("duplicates"))


def deduplicate(df: DataFrame, strategy: str = "hash", order_by: list[str] | None = None,
                key_columns: list[str] | None = None, unique_order: bool = False,
                **hash_opts) -> tuple[DataFrame, DataFrame]:
    """Dispatch by strategy; returns (deduplicated rows, one-row stats). D10: unknown strategy raises."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    if not order_by:
        raise ValueError("deduplicate needs an explicit row order (order_by)")
    if strategy == "hash":
        hashed = with_content_hash(df, **hash_opts)
        keys = [hash_opts.get("out", S.HASH_COLUMN)]
        return keep_first(hashed, keys, order_by, unique_order), dedup_stats(hashed, keys)
    keys = list(key_columns or [S.KEY_COLUMN])
    return keep_first(df, keys, order_by, unique_order), dedup_stats(df, keys)
