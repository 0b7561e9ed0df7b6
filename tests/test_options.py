"""Options beyond the defaults: hash separator and length, NULL equality filters, replayed stream."""

import hashlib

from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import dedup as D
from ledgerline.plans import runs as R
from ledgerline.plans.pipeline import ReconciliationJob
from ledgerline.plans.target import TargetTable
from ledgerline.sources import csv as C
from ledgerline.sources import generator as G


def test_hash_separator_and_length(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    plain = [r["h"] for r in D.with_content_hash(df, ["x", "y"], out="h").collect()]
    assert plain[0] == plain[1]                       # undelimited text collides, as documented
    sep = [r["h"] for r in D.with_content_hash(df, ["x", "y"], out="h", separator="|", hash_len=64).collect()]
    assert sep[0] != sep[1] and len(sep[0]) == 64
    assert sep[0] == hashlib.sha256(b"a|bc").hexdigest()


def test_query_filtered_null_and_limit(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, None)], "k int, v string")
    out = A.query_filtered(df, {"v": None}, limit=2, order_by=["k"])
    assert [r["k"] for r in out.collect()] == [1, 3]
    assert A.query_filtered(df, {"v": "x", "k": 2}).count() == 1
    assert A.query_filtered(df, None, limit=0).count() == 4       # a falsy limit means no limit


def test_replayed_micro_batch_leaves_same_table(spark, scratch):
    from ledgerline.streaming import start_incremental_load
    landing = scratch("landing")
    rows = G.generate_operations(spark, 200, "2001-01-01 00:00:00").drop("gen_id") \
        .withColumn("fecha_operacion", F.date_format("fecha_operacion", "yyyy-MM-dd HH:mm:ss"))
    C.write_csv(rows.coalesce(1), landing)
    target, runs = scratch("target"), scratch("runs")
    job = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00")
    for ckpt in (scratch("ckpt-a"), scratch("ckpt-b")):          # second stream replays the same file
        q = start_incremental_load(spark, landing, job, ckpt, trigger_once=True)
        q.awaitTermination(300)
    table = TargetTable(spark, target).current()
    assert table.count() == 200 and table.select("id").distinct().count() == 200
    hist = R.run_history(spark, runs).collect()           # newest first
    assert [(r["rows_loaded"], r["rows_updated"]) for r in hist] == [(0, 200), (200, 0)]
    assert len({r["pipeline_id"] for r in hist}) == 2 and "None" not in hist[0]["pipeline_id"]


def test_a_batch_with_a_record_of_success_is_not_loaded_again(spark, scratch):
    from ledgerline.streaming.incremental import _done
    runs = scratch("runs")
    assert not _done(spark, runs, "stream_a_0")
    for pid, status in (("stream_a_0", "success"), ("stream_a_1", "failed")):
        R.write_records(R.record_frame(spark, {"pipeline_id": pid, "status": status}), runs)
    assert _done(spark, runs, "stream_a_0") and not _done(spark, runs, "stream_a_1") and not _done(spark, runs, "stream_b_0")


def test_generator_shuffle_keeps_rows(spark):
    plain = G.generate_operational_file(spark, 500, "2001-01-01 00:00:00")
    mixed = G.generate_operational_file(spark, 500, "2001-01-01 00:00:00", shuffle=True)
    a, b = [r["gen_id"] for r in plain.collect()], [r["gen_id"] for r in mixed.collect()]
    assert sorted(a) == sorted(b) and a != b and len(b) == 525


def test_a_column_of_dates_settles_on_one_layout(spark):
    import datetime as dt
    rows = ["03/04/2001", "25/12/2001", "12/25/2001", "2001-05-06", "x", None, "", " 01/02/2001 ", "31/31/2001", "1/2/2001"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, d string")
    votes = {r["layout"]: r["votes"] for r in C.date_votes(df, "d").collect()}
    assert (votes["dd/MM/yyyy"], votes["MM/dd/yyyy"], votes["yyyy-MM-dd"], votes["dd.MM.yyyy"]) == (3, 3, 1, 0)
    assert C.date_layout(df, "d") == "dd/MM/yyyy"                                      # the first of a tie
    assert C.date_layout(df, "d", ["MM/dd/yyyy", "dd/MM/yyyy"]) == "MM/dd/yyyy"
    got = {r.k: r.d for r in C.parse_dates_voted(df, "d").collect()}
    assert {k: v for k, v in got.items() if v} == {0: dt.datetime(2001, 4, 3), 1: dt.datetime(2001, 12, 25), 7: dt.datetime(2001, 2, 1)}
    more = df.unionByName(spark.createDataFrame([(20, "06/30/2001")], "k int, d string"))
    assert {r.k for r in C.parse_dates_voted(more, "d").filter("d is not null").collect()} == {0, 2, 7, 20}
    none = spark.createDataFrame([(1, "x"), (2, None)], "k int, d string")
    assert C.date_layout(none, "d") is None and [r.d for r in C.parse_dates_voted(none, "d").collect()] == [None, None]
    assert C.parse_dates_voted(none.limit(0), "d").count() == 0


def test_a_voted_layout_serves_a_rule_set(spark):
    from ledgerline.operators.rules import ColumnSpec, RuleSet
    from ledgerline.operators.validate import validate
    df = spark.createDataFrame([(1, "25/12/2001"), (2, "13/13/2001"), (3, "04/05/2001")], "k int, d string")
    rules = RuleSet((ColumnSpec("d", "timestamp", False, formats=(C.date_layout(df, "d"),)),))
    v = validate(df, rules, id_cols=["k"])
    assert [(r.k, r.d.month) for r in v.valid().orderBy("k").collect()] == [(1, 12), (3, 5)]


DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_staged_load_into_a_database_is_one_transaction(spark):
    """Embedded in-memory Derby: no port, no server."""
    import pytest

    from ledgerline.sources.jdbc import _connection, _execute, merge_table, read_table, write_table
    url = "jdbc:derby:memory:ledgerline_merge;create=true"
    types = "k VARCHAR(10), v VARCHAR(20)"

    def rows(*data):
        return spark.createDataFrame(list(data), "k string, n long, v string")

    def table():
        return sorted(tuple(r) for r in read_table(spark, url, "T", DERBY, single_task=True).collect())

    def tables():
        with _connection(spark, url, DERBY) as c:
            return _execute(c, "SELECT count(*) FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'", query=True)
    write_table(rows(("a", 1, "old"), ("b", 2, "old")), url, "T", "overwrite", DERBY, types)
    with _connection(spark, url, DERBY) as c:
        _execute(c, 'ALTER TABLE T ADD CONSTRAINT positive CHECK ("n" > 0)')
    assert merge_table(rows(("b", 20, "new"), ("c", 3, "new"), ("d", 4, "x")), url, "T", "k", DERBY, column_types=types) == {"inserted": 2, "updated": 1}
    assert table() == [("a", 1, "old"), ("b", 20, "new"), ("c", 3, "new"), ("d", 4, "x")]
    assert merge_table(rows(("a", 9, "kept out")), url, "T", "k", DERBY, updated=["n"], column_types=types) == {"inserted": 0, "updated": 1}
    before, count = table(), tables()
    assert before[0] == ("a", 9, "old")
    with pytest.raises(Exception, match="(?i)check|constraint"):           # a row of the batch breaks a rule: none of it goes in
        merge_table(rows(("e", 5, "new"), ("b", -1, "bad")), url, "T", "k", DERBY, column_types=types)
    with pytest.raises(Exception):                                         # a key of the table meets two rows of the batch
        merge_table(rows(("a", 5, "x"), ("a", 6, "y")), url, "T", "k", DERBY, column_types=types)
    assert table() == before and tables() == count == 1
