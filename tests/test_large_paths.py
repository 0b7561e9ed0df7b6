"""The code paths taken at scale: broadcast disabled, so per-key tables and upsert batches go
through shuffle joins (with AQE skew handling). Results must equal the broadcast paths."""

import pytest
from pyspark.sql import functions as F

import ledgerline.plans.catalog as C
from ledgerline.operators import dedup as D
from ledgerline.operators import upsert as U
from tests.conftest import SF001

KEYS = ["validation_summary", "validation_failures", "rule_unique", "valid_keep_first", "flag_duplicates",
        "find_duplicates", "quick_validate", "csv_row_index"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("key", KEYS)
def test_shuffle_path_equals_broadcast_path(spark, no_broadcast, key):
    fn = C.QUERIES[key]
    small = _rows(fn(spark, SF001))
    no_broadcast()
    df = fn(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan or key == "csv_row_index"
    assert _rows(df) == small


def test_upsert_auto_falls_back_to_shuffle(spark, no_broadcast):
    small = _rows(C.q_upsert_merge(spark, SF001))
    no_broadcast()
    merged = C.q_upsert_merge(spark, SF001)
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert _rows(merged) == small


def test_hot_key_through_shuffle_join(spark, no_broadcast):
    no_broadcast()
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        df = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
            F.col("id").alias("o"))
        df = df.unionByName(spark.range(2000).select(F.col("id").cast("string").alias("k"),
                                                      (F.col("id") + 100000).alias("o")))
        flagged = D.flag_duplicates(df, ["o"], ["k"])
        # HOT: 2000 rows, 1999 later copies; ids 0..1999 not divisible by 3 appear twice
        twice = sum(1 for i in range(2000) if i % 3 != 0)
        assert flagged.filter("is_duplicate").count() == 1999 + twice
        assert D.find_duplicates(df, ["k"]).count() == 2000 + 2 * twice
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_batch_duplicates_detected_on_shuffle_path(spark, no_broadcast):
    no_broadcast()
    target, batch = C.upsert_sides(spark, SF001)
    dup = batch.unionByName(batch.limit(1))
    with pytest.raises(ValueError):
        U.upsert_merge(target, dup, load_time=C.AS_OF)


def test_keyed_upsert_never_shuffles_target_rows(spark):
    target, batch = C.upsert_sides(spark, SF001)
    merged = U.upsert_merge(target, batch, load_time=C.AS_OF, strategy="keyed")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan
    want = U.upsert_merge(target, batch, load_time=C.AS_OF, strategy="shuffle")
    cols = [c for c in want.columns if c != "id"]
    assert _rows(merged.select(cols)) == _rows(want.select(cols))


@pytest.mark.parametrize("key", ["dedup_key", "dedup_hash", "dedup_key_multi"])
def test_keep_first_without_row_shuffle_equals_window(spark, key):
    """Unique row order: the flag-and-drop keep-first gives the window's rows."""
    from ledgerline.sources.fixtures import ORDER_COLS, ops
    from ledgerline.sources.tables import table
    if key == "dedup_key_multi":
        df, keys, order = table(spark, SF001, "lineitem"), ["l_orderkey", "l_linenumber"], C.LI_TIE
    elif key == "dedup_hash":
        df, keys, order = D.with_content_hash(ops(spark, SF001)), ["content_hash"], ORDER_COLS
    else:
        df, keys, order = ops(spark, SF001), ["numero_operacion"], ORDER_COLS
    a = D.keep_first(df, keys, order)
    b = D.keep_first(df, keys, order, unique_order=True)
    assert "Window" not in b._jdf.queryExecution().executedPlan().toString()
    assert _rows(a) == _rows(b.select(a.columns))


def test_hot_null_key_through_shuffle_join(spark, no_broadcast):
    from ledgerline.operators.rules import ColumnSpec, RuleSet
    from ledgerline.operators.validate import validate
    no_broadcast()
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        df = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
            .otherwise((F.col("id") % 700).cast("string")).alias("k"), F.col("id").alias("o"))
        flagged = D.flag_duplicates(df, ["o"], ["k"])
        n_keys = df.filter("k IS NOT NULL").select("k").distinct().count()
        # every row but the first of its group (the NULL group included) is a later copy
        assert flagged.filter("is_duplicate").count() == 3000 - (n_keys + 1)
        rules = RuleSet((ColumnSpec("k", "string", True, unique=True),))
        failures = validate(df, rules, id_cols=["o"]).failures()
        dup_rows = df.filter("k IS NOT NULL").groupBy("k").count().filter("count > 1").agg(F.sum("count")).first()[0]
        assert failures.count() == dup_rows            # NULL keys never break uniqueness
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
