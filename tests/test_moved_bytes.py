"""What shuffles move: the uniqueness join, hash dedup where no hash repeats, the sides of the upsert, compressed CSV."""

import glob

import pytest
from pyspark.sql import functions as F

import ledgerline.plans.catalog as C
from ledgerline import schema as S
from ledgerline.operators import dedup as D
from ledgerline.operators.rules import ColumnSpec, RuleSet, default_rules, greater_than
from ledgerline.operators.validate import validate
from ledgerline.plans import runs as R
from ledgerline.sources.csv import scan_csv, write_csv

AS_OF = "2001-01-01 00:00:00"


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _ops(spark, n=300):
    """Ids repeat from row 250 on; every 7th row has an amount that is no number, every 50th no account."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit("2000-01-01").alias("fecha_operacion"), F.format_string("OP-%08d", i % 250).alias("numero_operacion"),
        F.lit("RETIRO").alias("tipo_operacion"), F.when(i % 7 == 0, F.lit("x")).otherwise(i.cast("string")).alias("monto"),
        F.lit("PEN").alias("moneda"), F.when(i % 50 != 0, F.lit("100-0000001-1-01")).alias("cuenta_origen"), F.lit(None).cast("string").alias("cuenta_destino"),
        F.lit("BCP").alias("banco_origen"), F.lit("").alias("banco_destino"), F.lit("d").alias("descripcion"),
        F.lit("COMPLETADA").alias("estado"), F.lit("WEB").alias("canal"), i.alias("row"), (i % 3).alias("lote"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_uniqueness_join_moves_what_is_asked_for(spark, no_broadcast):
    v = validate(_ops(spark), default_rules(AS_OF), id_cols=["row"])
    plan = _plan(v.failures_top(20))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    moved = plan[plan.index("ShuffledHashJoin"):]
    moved = moved[:moved.index("Exchange")]
    assert "estado" not in moved and "cuenta_origen" not in moved
    failures = {(r["row"], r["column"], r["error"]) for r in v.failures().collect()}
    wanted = {(i, "numero_operacion", S.MSG_UNIQUE) for i in range(300) if i < 50 or i >= 250}
    wanted |= {(i, "monto", S.coerce_message("double")) for i in range(300) if i % 7 == 0}
    wanted |= {(i, "cuenta_origen", S.MSG_NOT_NULL) for i in range(300) if i % 50 == 0}
    assert failures == wanted
    assert {r["row"] for r in v.valid().collect()} == set(range(300)) - {i for i, _, _ in wanted}


def test_more_rules_than_bits_of_a_word(spark):
    df = spark.range(4).select(F.col("id").alias("k"), *[F.lit(k).alias(f"c{k}") for k in range(130)])
    rules = RuleSet((ColumnSpec("k", "long", False, unique=True), *[ColumnSpec(f"c{k}", "long", checks=(greater_than(F.lit(0), "low"),)) for k in range(130)]))
    odd = df.withColumns({"c0": F.col("k"), "c61": F.col("k"), "c62": F.col("k") - 1, "c129": F.col("k") - 2})
    found = {(r["k"], r["column"]) for r in validate(odd, rules, id_cols=["k"]).failures().collect()}
    assert found == {(0, "c0"), (0, "c61"), (0, "c62"), (1, "c62"), (0, "c129"), (1, "c129"), (2, "c129")}


def test_unknown_check_is_neither_valid_nor_rejected(spark):
    rules = RuleSet((ColumnSpec("k", "long", unique=True), ColumnSpec("a", "long", checks=(greater_than(F.col("b"), "low"),))))
    df = spark.createDataFrame([(1, 5, 1), (2, 5, None), (3, 1, 5), (4, 5, None), (4, 5, 1)], "k long, a long, b long")
    v = validate(df, rules, id_cols=["k"])
    assert [r["k"] for r in v.valid().collect()] == [1]
    assert sorted(r["k"] for r in v.rejected().collect()) == [3, 4, 4]


def test_runs_move_the_hash_and_not_its_columns(spark, no_broadcast):
    v = validate(_ops(spark), default_rules(AS_OF), id_cols=["row"])
    runs = R.runs_from_batches(v, "lote", AS_OF, error_row="row")
    assert "SortMergeJoin" not in _plan(R.runs_from_batches(v, "lote", AS_OF, with_errors=False))
    plan = _plan(R.runs_from_batches(v, "lote", AS_OF, with_errors=False))
    moved = plan[plan.index("ShuffledHashJoin"):]
    assert "cuenta_origen" not in moved[:moved.index("Exchange")]
    valid = [i for i in range(50, 250) if i % 7 and i % 50]
    got = {r["pipeline_id"]: (r["input_rows"], r["validation_passed"], r["rows_loaded"]) for r in runs.collect()}
    assert got == {f"etl_batch_{b}": (100, *[sum(i % 3 == b for i in valid)] * 2) for b in range(3)}


def test_keep_first_of_stored_rows(spark):
    df = spark.range(100).select(F.when(F.col("id") > 1, F.col("id")).alias("k"), F.col("id").alias("o"))
    rows, n, _ = D.keep_first_stored(df, ["k"], ["o"])                    # two null keys are one group
    assert n == 99 and sorted(r["o"] for r in rows.collect()) == [0, *range(2, 100)]
    rows, n, _ = D.keep_first_stored(df.filter("k is not null"), ["k"], ["o"])
    assert n == 98 and "Window" not in _plan(rows) and "Exchange" not in _plan(rows)


def test_upsert_sides_are_stored_once(spark, monkeypatch):
    real, calls = C.materialize, []
    monkeypatch.setattr(C, "materialize", lambda df: calls.append(1) or real(df))
    C.upsert_sides(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1


def test_compressed_csv_in_many_files(spark, scratch):
    df = spark.range(100).coalesce(1).select(F.col("id").cast("string").alias("a"), F.concat(F.lit('x "q",\n'), F.col("id")).alias("b"))
    folder = scratch("gz")
    write_csv(df, folder, compression="gzip", rows_per_file=30)
    assert len(glob.glob(f"{folder.removeprefix('file:')}/*.csv.gz")) == 4
    assert [tuple(r) for r in scan_csv(spark, folder).orderBy("row").collect()] == [(str(i), f'x "q",\n{i}', i) for i in range(100)]
