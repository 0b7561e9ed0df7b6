"""The target as a catalog table, bucketed by its key."""

import pytest
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import upsert as U
from ledgerline.plans.catalog import AS_OF, deduped_ops
from ledgerline.plans.target import TargetTable
from tests.conftest import SF001


@pytest.fixture(scope="module")
def batch(spark):
    return U.normalize_load(deduped_ops(spark, SF001)).withColumn("is_duplicate", F.lit(0)).cache()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_below_an_exchange(df, name):
    """Lines of the plan between the target's scan and its join that are an Exchange."""
    lines = plan(df).splitlines()
    found = []
    for k, line in enumerate(lines):
        if "FileScan" in line and name in line:
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            for above in reversed(lines[:k]):
                at = len(above) - len(above.lstrip(" :+-*()0123456789"))
                if at < depth:
                    depth = at
                    if "Join" in above:
                        break
                    found += [above] if "Exchange" in above else []
    return found


def test_a_managed_table_by_name(spark, batch):
    table = TargetTable(spark, "operaciones_prueba", parts=3)
    table.drop()
    try:
        assert not table.exists() and table.current() is None and table.keys().count() == 0 and table.max_id() is None
        created = table.create()
        assert [(f.name, f.dataType) for f in created.schema] == [(f.name, f.dataType) for f in S.TARGET_SCHEMA]
        assert (created.count(), table.max_id(), table.part_count()) == (0, 0, 3)
        assert table.load(batch, load_time=AS_OF) == {"inserted": 2951, "updated": 0}
        assert TargetTable(spark, "operaciones_prueba", parts=99).part_count() == 3      # an existing table keeps its buckets
        assert table.max_id() == table.current().agg(F.max("id")).first()[0]
        assert spark.table("operaciones_prueba").select(F.count_if(F.col("_part") != F.pmod(F.hash(S.KEY_COLUMN), F.lit(3)))).first()[0] == 0
    finally:
        table.drop()
    assert not spark.catalog.tableExists("operaciones_prueba")


@pytest.mark.parametrize("strategy", ["broadcast", "keyed", "shuffle"])
def test_every_merge_gives_the_same_rows_and_counts(spark, scratch, batch, strategy):
    table = TargetTable(spark, scratch("m"), parts=5)
    table.load(batch.filter("l_orderkey % 3 <> 0"), load_time="2000-01-01 00:00:00")
    old = {r.numero_operacion: r.id for r in table.current().collect()}
    new = batch.filter("l_orderkey % 3 <> 1").withColumn("monto", F.col("monto") + 1)
    counts = table.load(new, load_time=AS_OF, strategy=strategy)
    rows = {r.numero_operacion: r for r in table.current().collect()}
    amounts = {r.numero_operacion: (r.l_orderkey % 3, r.monto) for r in batch.collect()}
    assert counts == {"inserted": sum(k == 0 for k, _ in amounts.values()), "updated": sum(k == 2 for k, _ in amounts.values())}
    assert {k: r.monto for k, r in rows.items()} == {k: m + (d != 1) for k, (d, m) in amounts.items()}
    assert all(rows[k].id == i for k, i in old.items()) and len({r.id for r in rows.values()}) == len(rows)
    assert {k for k, r in rows.items() if str(r.fecha_carga) == "2000-01-01 00:00:00"} == {k for k, (d, _) in amounts.items() if d == 1}


def test_joins_by_key_do_not_shuffle_the_table(spark, scratch, batch):
    table = TargetTable(spark, scratch("b"), parts=4)
    table.load(batch, load_time=AS_OF)
    own, src = spark.table(table.name), U.shape_batch(table.current(), batch.limit(500), S.KEY_COLUMN, AS_OF)
    cols = [f.name for f in S.TARGET_SCHEMA]
    with_limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = U.merge_staged(table.current(), src, S.KEY_COLUMN, cols, 1, 1 << 40, 0, "shuffle")
        assert "FullOuter" in plan(merged) and "Bucketed: true" in plan(merged)
        assert scans_below_an_exchange(merged, table.name) == []
        matched = own.select(S.KEY_COLUMN).join(src.select(S.KEY_COLUMN), S.KEY_COLUMN)
        assert "SortMergeJoin" in plan(matched) and scans_below_an_exchange(matched, table.name) == []
        # the same join of a table without buckets does
        plain = table.current().repartition(3)
        plain.write.mode("overwrite").saveAsTable("plain_prueba")
        shuffled = spark.table("plain_prueba").select(S.KEY_COLUMN).join(src.select(S.KEY_COLUMN), S.KEY_COLUMN)
        assert scans_below_an_exchange(shuffled, "plain_prueba")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_limit)
        spark.sql("DROP TABLE IF EXISTS plain_prueba")


def test_a_folder_is_found_by_a_catalog_that_does_not_know_it(spark, scratch, batch):
    folder = scratch("f")
    table = TargetTable(spark, folder, parts=6)
    table.load(batch, load_time=AS_OF)
    rows = sorted(map(str, table.current().collect()))
    spark.sql(f"DROP TABLE {table.name}")                      # an external table: its files stay
    again = TargetTable(spark, folder, parts=2)
    assert again.part_count() == 6 and sorted(map(str, again.current().collect())) == rows
    assert again.load(batch.limit(10), load_time=AS_OF) == {"inserted": 0, "updated": 10}
    again.drop()
    assert not TargetTable(spark, folder).exists()


def test_nothing_changes_when_a_batch_is_refused(spark, scratch, batch):
    table = TargetTable(spark, scratch("r"), parts=2)
    table.load(batch.limit(50), load_time=AS_OF)
    old = sorted(map(str, table.current().collect()))
    with pytest.raises(ValueError, match="2 times"):
        table.load(batch.limit(20).unionByName(batch.limit(20)), load_time=AS_OF)
    with pytest.raises(ValueError, match="required"):
        table.load(batch.limit(20).withColumn("canal", F.lit(None).cast("string")), load_time=AS_OF)
    with pytest.raises(ValueError, match="required"):
        table.load(batch.limit(20).withColumn(S.KEY_COLUMN, F.lit(None).cast("string")), load_time=AS_OF, check_keys=False)
    assert sorted(map(str, table.current().collect())) == old
    assert table.load(batch.limit(0), load_time=AS_OF) == {"inserted": 0, "updated": 0}
    with pytest.raises(ValueError, match="parts"):
        TargetTable(spark, "t", parts=0)


def test_the_largest_id_comes_from_footers(spark, scratch, batch):
    from ledgerline.sources.parquet import footer_aggregates
    table = TargetTable(spark, scratch("i"), parts=2)
    table.load(batch, load_time=AS_OF)
    place = spark.sql(f"DESCRIBE EXTENDED {table.name}").filter("col_name = 'Location'").first().data_type
    df = footer_aggregates(spark, place, S.TARGET_SCHEMA, F.max("id").alias("m"), F.count(F.lit(1)).alias("n"))
    assert "PushedAggregation: [MAX(id), COUNT(*)]" in plan(df)
    assert tuple(df.first()) == tuple(table.current().agg(F.max("id"), F.count(F.lit(1))).first())


def test_merge_statement_for_tables_with_row_level_operations(spark):
    """No such catalog is at hand: the statement is parsed, and a Parquet table refuses it."""
    table = TargetTable(spark, "zusammen_prueba")
    table.drop()
    table.create()
    try:
        spark._jsparkSession.sessionState().sqlParser().parsePlan(table.merge_sql("stage"))
        table.current().withColumn("_part", F.lit(0)).createOrReplaceTempView("stage")
        with pytest.raises(Exception, match="MERGE INTO"):
            spark.sql(table.merge_sql("stage"))
    finally:
        table.drop()
