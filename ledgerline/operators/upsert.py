"""Keyed upsert into the target table.

A merge is a pure ``DataFrame`` function: existing keys take the batch's values (all columns but
id, key and is_duplicate), new keys are inserted, the rest is kept; ``_action`` says which.
Three plans give the same rows:

* ``broadcast`` -- the batch is measured and proven small: the target is streamed once through
  a broadcast anti join (kept rows) and a broadcast inner join on its key/id columns (matched
  keys); the target is never shuffled, whatever its size.
* ``keyed`` -- the batch is large but the keys it shares with the target are few: only the
  target's (key, id, is_duplicate) columns are shuffled to find them; the other target rows pass
  through a broadcast anti join unshuffled.
* ``shuffle`` -- a full outer equi-join on the key with presence markers on both sides.

Presence comes from literal markers, never from a value column being null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.text import empty_to_null, truncate
from ledgerline.plans.keyjoin import materialize
from ledgerline.session import broadcast_limit

ACTION = "_action"
SEQ = "__seq"                     # distinct numbers of a batch's rows; new ids follow them


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def normalize_load(df: DataFrame) -> DataFrame:
    """Typed date, descripcion cut to 500, banks/accounts cut to 50, '' -> NULL for destinations.

    Null descripcion / banco_origen / cuenta_origen stay NULL (not the text 'nan' / 'None').
    """
    out = df
    cols = set(df.columns)
    if S.DATE_COLUMN in cols and dict(df.dtypes)[S.DATE_COLUMN] == "string":
        out = out.withColumn(S.DATE_COLUMN, F.col(S.DATE_COLUMN).try_cast("timestamp"))
    if "descripcion" in cols:
        out = out.withColumn("descripcion", truncate(F.col("descripcion"), S.DESCRIPTION_MAX))
    for c in ("banco_origen", "cuenta_origen"):
        if c in cols:
            out = out.withColumn(c, truncate(F.col(c), S.BANK_ACCOUNT_MAX))
    for c in ("banco_destino", "cuenta_destino"):
        if c in cols:
            out = out.withColumn(c, empty_to_null(truncate(F.col(c), S.BANK_ACCOUNT_MAX)))
    return out


def duplicate_source_keys(batch: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in the batch (key-only aggregate, partial on the map side)."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def prepare_batch(batch: DataFrame, key: str = S.KEY_COLUMN, on_duplicate: str = "error",
                  order_by: list[str] | None = None) -> DataFrame:
    """Make the batch one row per key: fail fast (default) or keep the last row by ``order_by``."""
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
        return batch.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    if on_duplicate != "error":
        raise ValueError(f"Unknown on_duplicate: {on_duplicate}")
    return batch


def check_unique_batch(batch: DataFrame, key: str) -> None:
    """Fail fast when a batch key repeats (run on the materialised batch, not its lineage)."""
    dup = duplicate_source_keys(batch, key).limit(1).collect()
    if dup:
        raise ValueError(f"batch holds key {dup[0][key]!r} {dup[0]['n']} times; "
                         "use on_duplicate='last' with order_by to keep one")


def _target_columns(target: DataFrame) -> list[str]:
    return [c for c in target.columns if c not in (ACTION,)]


def upsert_merge(target: DataFrame, batch: DataFrame, key: str = S.KEY_COLUMN, load_time=None,
                 on_duplicate: str = "error", order_by: list[str] | None = None,
                 strategy: str = "auto", max_id: int | None = None,
                 broadcast_bytes: int | None = None, check_keys: bool = True,
                 target_empty: bool = False) -> DataFrame:
    """K5/K6: the merged target, one row per key, with ``_action`` in kept / inserted / updated.

    ``batch`` must carry the target's value columns (missing ones become NULL). New rows get
    ``id = max(target.id) + 1 + n`` where n is unique per new row (not dense), fixed by writing
    the batch to the checkpoint folder first, so a retried task reproduces the same ids; pass
    ``max_id`` when it is known (the snapshot store keeps it) to skip the scan for it.

    If the target has one row per key, so has the result: kept keys and batch keys are disjoint
    by construction and the (materialised, small) batch is checked for repeated keys here.

    ``target_empty=True`` (the caller knows the target has no rows, e.g. a new store) makes every
    batch row an insert without any join.

    ``check_keys=False`` skips the repeated-key check when the caller has proof the batch keys are
    unique (e.g. validation enforced a non-null unique key on them).

    ``strategy``: ``auto`` picks ``broadcast`` when the batch is measured small, else ``keyed``
    when the matched keys are, else ``shuffle``; each can also be forced.
    """
    cols = _target_columns(target)
    src = shape_batch(target, prepare_batch(batch, key, on_duplicate, order_by), key, load_time)
    if target_empty:
        # first load: every row is an insert; no join. The ids are written by this one write job,
        # which commits one attempt per partition, so they stay unique without writing the batch first
        if on_duplicate == "error" and check_keys:
            check_unique_batch(src, key)
        base_id = (max_id if max_id is not None else 0) + 1
        ids = (F.lit(base_id) + F.col("__seq")).alias("id")
        return src.select(*[ids if c == "id" else F.col(c) for c in cols], F.lit("inserted").alias(ACTION))
    src, _, nbytes = materialize(src)
    if on_duplicate == "error" and check_keys:
        check_unique_batch(src, key)
    if max_id is None and "id" in cols:
        max_id = target.agg(F.max("id").alias("m")).first()["m"]
    base_id = (max_id if max_id is not None else 0) + 1
    limit = broadcast_limit(target.sparkSession) if broadcast_bytes is None else broadcast_bytes
    return merge_staged(target, src, key, cols, base_id, nbytes, limit, strategy)


def shape_batch(target: DataFrame, batch: DataFrame, key: str, load_time=None) -> DataFrame:
    """The batch in the target's columns (but the id; missing ones NULL, load stamp set), its rows numbered by ``__seq``.

    A batch that is stored with such a column keeps it.
    """
    src_cols = []
    for c in _target_columns(target):
        if c == "fecha_carga":
            src_cols.append(_ts(load_time).alias(c))
        elif c != "id":
            found = F.col(c) if c in batch.columns else F.lit(None)
            src_cols.append(found.cast(target.schema[c].dataType).alias(c))
    seq = F.col(SEQ) if SEQ in batch.columns else F.monotonically_increasing_id()
    return batch.select(*src_cols, seq.alias(SEQ))


def merge_staged(target: DataFrame, src: DataFrame, key: str, cols: list[str], base_id: int, nbytes: int, limit: int,
                 strategy: str = "auto") -> DataFrame:
    """The merged rows of a target and a stored, shaped batch of ``nbytes`` with one row per key."""
    if strategy not in ("auto", "broadcast", "keyed", "shuffle"):
        raise ValueError(f"Unknown upsert strategy: {strategy}")
    small = limit > 0 and nbytes <= limit
    if strategy == "broadcast" and not small:
        raise ValueError(f"the batch has {nbytes} bytes; a broadcast takes at most {limit}")
    if strategy == "broadcast" or (strategy == "auto" and small):
        return _merge_broadcast(target, src, key, cols, base_id)
    if strategy in ("auto", "keyed"):
        merged = _merge_keyed(target, src, key, cols, base_id, limit)
        if merged is not None:
            return merged
    return _merge_shuffle(target, src, key, cols, base_id)


def _merged_row(cols: list[str], key: str, base_id: int, t_present: Column, s_present: Column,
                t: str, s: str) -> list[Column]:
    out = []
    for c in cols:
        if c == "id":
            out.append(F.when(t_present, F.col(f"{t}.id"))
                       .otherwise(F.lit(base_id) + F.col(f"{s}.__seq")).alias("id"))
        elif c == key:
            out.append(F.coalesce(F.col(f"{t}.{c}"), F.col(f"{s}.{c}")).alias(c))
        elif c == "is_duplicate":
            out.append(F.when(t_present, F.col(f"{t}.{c}")).otherwise(F.col(f"{s}.{c}")).alias(c))
        else:
            out.append(F.when(s_present, F.col(f"{s}.{c}")).otherwise(F.col(f"{t}.{c}")).alias(c))
    action = (F.when(t_present & s_present, F.lit("updated"))
              .when(s_present, F.lit("inserted")).otherwise(F.lit("kept")))
    return out + [action.alias(ACTION)]


def _merge_shuffle(target: DataFrame, src: DataFrame, key: str, cols: list[str], base_id: int) -> DataFrame:
    t = target.select(*cols, F.lit(True).alias("__t")).alias("t")
    s = src.withColumn("__s", F.lit(True)).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return j.select(*_merged_row(cols, key, base_id, F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull(),
                                 "t", "s"))


def _merge_broadcast(target: DataFrame, src: DataFrame, key: str, cols: list[str], base_id: int) -> DataFrame:
    keys = F.broadcast(src.select(key))
    kept = target.select(*cols).join(keys, key, "left_anti").select(*cols).withColumn(ACTION, F.lit("kept"))
    keep_cols = [c for c in ("id", "is_duplicate") if c in cols]
    matched = target.select(key, *keep_cols).join(keys, key, "inner").withColumn("__t", F.lit(True)).alias("t")
    s = src.withColumn("__s", F.lit(True)).alias("s")
    # matched has at most one row per batch key: a small-to-small join
    j = s.join(F.broadcast(matched), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    t_present = F.col("t.__t").isNotNull()
    rows = []
    for c in cols:
        if c == "id":
            rows.append(F.when(t_present, F.col("t.id")).otherwise(F.lit(base_id) + F.col("s.__seq")).alias("id"))
        elif c == key:
            rows.append(F.col(f"s.{c}").alias(c))
        elif c == "is_duplicate":
            rows.append(F.when(t_present, F.col("t.is_duplicate")).otherwise(F.col("s.is_duplicate")).alias(c))
        else:
            rows.append(F.col(f"s.{c}").alias(c))
    touched = j.select(*rows, F.when(t_present, F.lit("updated")).otherwise(F.lit("inserted")).alias(ACTION))
    return kept.unionByName(touched)


def _merge_keyed(target: DataFrame, src: DataFrame, key: str, cols: list[str], base_id: int,
                 limit: int) -> DataFrame | None:
    """Large batch: find the matched keys with a key-only join, then keep the target's other rows
    through a broadcast anti join, so no full target row is shuffled.

    Only (key, id, is_duplicate) of the target meet the batch keys in a shuffle join; the matched
    set (never larger than the batch) is written and measured. Returns None when it is too large
    to broadcast, and the caller falls back to the full outer join.
    """
    keep_cols = [c for c in ("id", "is_duplicate") if c in cols]
    matched = target.select(key, *keep_cols).join(src.select(key), key, "inner")
    matched, _, mbytes = materialize(matched)
    if not (limit > 0 and mbytes <= limit):
        return None
    kept = (target.select(*cols).join(F.broadcast(matched.select(key)), key, "left_anti").select(*cols)
            .withColumn(ACTION, F.lit("kept")))
    t = matched.withColumn("__t", F.lit(True)).alias("t")
    s = src.alias("s")
    j = s.join(F.broadcast(t), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    t_present = F.col("t.__t").isNotNull()
    rows = []
    for c in cols:
        if c == "id":
            rows.append(F.when(t_present, F.col("t.id")).otherwise(F.lit(base_id) + F.col("s.__seq")).alias("id"))
        elif c == "is_duplicate":
            rows.append(F.when(t_present, F.col("t.is_duplicate")).otherwise(F.col("s.is_duplicate")).alias(c))
        else:
            rows.append(F.col(f"s.{c}").alias(c))
    touched = j.select(*rows, F.when(t_present, F.lit("updated")).otherwise(F.lit("inserted")).alias(ACTION))
    return kept.unionByName(touched)


def upsert_counts(merged: DataFrame) -> DataFrame:
    """Rows kept / inserted / updated by a merge, one row (a single aggregation)."""
    return merged.agg(F.count_if(F.col(ACTION) == "kept").alias("rows_kept"),
                      F.count_if(F.col(ACTION) == "inserted").alias("rows_inserted"),
                      F.count_if(F.col(ACTION) == "updated").alias("rows_updated"))


def load_stats(merged: DataFrame, failed: bool = False) -> DataFrame:
    """K9: rows_inserted, rows_updated, rows_failed, total_processed (= batch rows).

    All-or-nothing, as the staged load: when the load failed every batch row counts as failed.
    """
    c = upsert_counts(merged)
    total = F.col("rows_inserted") + F.col("rows_updated")
    if failed:
        return c.select(F.lit(0).cast("long").alias("rows_inserted"), F.lit(0).cast("long").alias("rows_updated"),
                        total.alias("rows_failed"), total.alias("total_processed"))
    return c.select("rows_inserted", "rows_updated", F.lit(0).cast("long").alias("rows_failed"),
                    total.alias("total_processed"))


def append_new(target: DataFrame, batch: DataFrame, key: str = S.KEY_COLUMN) -> DataFrame:
    """K4: batch rows whose key is not in the target (what an append adds)."""
    return batch.join(target.select(key), key, "left_anti").select(*batch.columns)


def duplicate_keys(df: DataFrame, key: str = S.KEY_COLUMN) -> DataFrame:
    """K3: keys held by more than one row; must be empty for a published target."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique_key(df: DataFrame, key: str = S.KEY_COLUMN) -> None:
    bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise ValueError(f"unique key violated: {bad[0][key]!r} occurs {bad[0]['n']} times")


def to_target(df: DataFrame, ids: Column | None = None, load_time=None) -> DataFrame:
    """Shape a frame into the target schema (missing columns NULL, fixed types and order)."""
    cols = []
    for f in S.TARGET_SCHEMA.fields:
        if f.name == "id" and ids is not None:
            cols.append(ids.cast(f.dataType).alias("id"))
        elif f.name == "fecha_carga" and load_time is not None and f.name not in df.columns:
            cols.append(_ts(load_time).alias(f.name))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
