"""Tables dealt by a key: what meets by it is not shuffled, hot keys are left to shuffles, nothing stays in the catalog."""

import pytest
from pyspark.sql import functions as F

import ledgerline.plans.catalog as C
from ledgerline import schema as S
from ledgerline.operators import dedup as D
from ledgerline.operators import upsert as U
from ledgerline.operators.rules import default_rules
from ledgerline.operators.validate import validate
from ledgerline.plans import keyjoin as K
from ledgerline.plans.pipeline import ReconciliationJob
from ledgerline.plans.target import TargetTable
from ledgerline.sources.csv import scan_csv, write_csv
from tests.test_moved_bytes import AS_OF, _ops, _plan, no_broadcast  # noqa: F401


def _shuffled_columns(df):
    plan = _plan(df)
    return [line for line in plan.splitlines() if "Exchange" in line]


def _tables(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_dealt_rows_meet_by_their_key_without_a_shuffle(spark, no_broadcast):  # noqa: F811
    before = _tables(spark)
    df = spark.range(1000).select((F.col("id") % 300).cast("string").alias("k"), F.col("id").alias("o"), F.lit("x").alias("v"))
    df = df.withColumn("k", F.when(F.col("o") % 10 != 0, F.col("k")))
    stored = K.materialize_by(df, "k", 4)
    assert stored.dealt and stored.rows == 1000 and stored.bytes > 0 and _tables(spark) == before
    first = D.keep_first(stored.frame, ["k"], ["o"])
    assert not _shuffled_columns(first)
    assert sorted(map(tuple, first.collect()), key=str) == sorted(map(tuple, D.keep_first(df, ["k"], ["o"]).collect()), key=str)
    assert sorted(map(tuple, stored.frame.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_a_hot_key_is_left_to_shuffles(spark, monkeypatch):
    monkeypatch.setattr(K, "SKEWED_ROWS", 100)
    hot = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    stored = K.materialize_by(hot, "k", 16)
    assert not stored.dealt and stored.frame.count() == 2000
    even = K.materialize_by(spark.range(2000).select(F.col("id").cast("string").alias("k")), "k", 16)
    assert even.dealt and even.frame.count() == 2000


def test_too_many_files_and_nested_columns_stay_undealt(spark, monkeypatch):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.array("id").alias("a"))
    assert not K.materialize_by(df, "k", 4).dealt and not K.materialize_by(df.drop("a"), "none", 4).dealt
    assert K.materialize_by(df.drop("a"), "k", 4).dealt
    monkeypatch.setattr(K, "DEALT_FILES", 3)
    stored = K.materialize_by(df.drop("a"), "k", 4)
    assert not stored.dealt and stored.frame.count() == 50


def test_validation_of_dealt_rows_moves_no_rows(spark, no_broadcast):  # noqa: F811
    rows = _ops(spark)
    v = validate(rows, default_rules(AS_OF), id_cols=["row"], store=True, deal_by=S.KEY_COLUMN)
    wanted = validate(rows, default_rules(AS_OF), id_cols=["row"])
    moved = _shuffled_columns(v.valid())
    assert len(moved) == 1 and "__k0" in moved[0]            # the table of repeated keys alone
    assert sorted(map(str, v.valid().collect())) == sorted(map(str, wanted.valid().collect()))
    assert sorted(map(str, v.failures().collect())) == sorted(map(str, wanted.failures().collect()))


def _whole(spark, lo, hi, amount):
    return _ops(spark, 250).filter(F.col("row").between(lo, hi - 1)).withColumns({"fecha_operacion": F.lit("2000-01-01").cast("timestamp"), "monto": F.lit(float(amount)),
                             "cuenta_origen": F.lit("100-0000001-1-01"), "is_duplicate": F.lit(0), "content_hash": F.lit("h")})


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_a_load_shuffles_neither_batch_nor_table(spark, scratch, no_broadcast, monkeypatch, strategy):  # noqa: F811
    written = []
    real = TargetTable._write

    def seen(self, frame, parts, overwrite, deal):
        written.append((_plan(frame), deal))
        return real(self, frame, parts, overwrite, deal)
    monkeypatch.setattr(TargetTable, "_write", seen)
    table = TargetTable(spark, scratch("dealt"), parts=4)
    table.insert(U.to_target(_whole(spark, 0, 160, 1), ids=F.col("row") + 1, load_time=AS_OF))
    assert table.load(_whole(spark, 100, 250, 2), load_time=AS_OF, strategy=strategy) == {"inserted": 90, "updated": 60}
    assert len(written) == 2 and not any("Exchange" in plan or deal for plan, deal in written)
    rows = {r[S.KEY_COLUMN]: (r["monto"], r["id"]) for r in table.current().collect()}
    assert len(rows) == 250 and len({i for _, i in rows.values()}) == 250
    assert all(rows[f"OP-{i:08d}"][0] == (1.0 if i < 100 else 2.0) for i in range(250))
    assert all(rows[f"OP-{i:08d}"][1] == i + 1 for i in range(160))


def test_buckets_of_a_new_table_follow_its_first_load(spark, scratch, monkeypatch):
    import ledgerline.plans.target as target
    monkeypatch.setattr(target, "bucket_count", lambda rows: 40)
    table = TargetTable(spark, scratch("sized"))
    table.load(_whole(spark, 0, 50, 1), load_time=AS_OF)
    assert table.part_count() == 40 and table.current().count() == 50
    assert TargetTable(spark, table.folder).parts_for(spark.range(1)) == 40
    asked = TargetTable(spark, scratch("asked"), parts=3)
    asked.load(_whole(spark, 0, 50, 1), load_time=AS_OF)
    assert asked.part_count() == 3


def test_upsert_sides_shuffle_no_rows(spark, no_broadcast, monkeypatch):  # noqa: F811
    seen, real = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df: seen.append(_plan(df)) or real(df))
    C.upsert_sides(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and "Window" in seen[0] and "Exchange" not in seen[0]


def test_of_tied_rows_the_job_keeps_the_first_of_the_file(spark, scratch):
    rows = _ops(spark, 240).withColumns({"monto": F.lit("5.5"), "cuenta_origen": F.lit("100-0000001-1-01"), "tie": F.lit(1), "descripcion": F.col("row").cast("string"),
                                         "numero_operacion": F.format_string("OP-%08d", F.col("row") % 60)}).drop("lote")
    folder = scratch("tied")
    write_csv(rows.repartition(5).sortWithinPartitions("row").drop("row"), folder)
    numbered = {r["descripcion"]: r["row"] for r in scan_csv(spark, folder).collect()}
    rules = default_rules(AS_OF).only(*C.NOT_UNIQUE)
    job = ReconciliationJob(spark, scratch("tt"), scratch("tr"), as_of=AS_OF, rules=rules, order_by=["tie"], dedup_strategy="key")
    kept = {r[S.KEY_COLUMN]: r["descripcion"] for r in job.run(folder, pipeline_id="tied").target.collect()}
    wanted = {f"OP-{k:08d}": min((str(i) for i in range(k, 240, 60)), key=numbered.get) for k in range(60)}
    assert kept == wanted
