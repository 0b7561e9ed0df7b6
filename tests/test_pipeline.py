"""Whole job (P1), failure path (P2), report tables (P4), JDBC (K10), incremental stream."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import runs as R
from ledgerline.plans.pipeline import ReconciliationJob, build_report, quick_validate, write_report
from ledgerline.plans.target import NullInRequiredColumn, TargetTable
from ledgerline.sources import csv as C
from ledgerline.sources import generator as G
from ledgerline.sources.jdbc import read_table, write_table

AS_OF = "2001-01-01 00:00:00"


def _generated_csv(spark, scratch, n=2000):
    df = G.generate_operational_file(spark, n, AS_OF)
    folder = scratch("gen-csv")
    C.write_csv(df.drop("gen_id", "source_id", "is_copy", "error_kind").coalesce(2), folder)
    return folder


def test_pipeline_end_to_end(spark, scratch):
    src = _generated_csv(spark, scratch)
    target, runs, out = scratch("target"), scratch("runs"), scratch("out")
    job = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00")
    res = job.run(src, output_dir=out, pipeline_id="p1")
    rec = res.record
    assert rec["status"] == "success"
    assert rec["input_rows"] == 2100
    assert rec["validation_passed"] + rec["validation_failed"] == rec["input_rows"]
    assert rec["rows_loaded"] == res.target.count() == rec["validation_passed"] - rec["duplicates_removed"]
    assert len(rec["validation_errors"]) == 100
    # the CSV copy holds exactly the loaded rows
    assert spark.read.option("header", True).csv(out).count() == rec["rows_loaded"]
    # second run of the same file: all updates, table unchanged in size
    res2 = job.run(src, pipeline_id="p2")
    assert (res2.record["rows_loaded"], res2.record["rows_updated"]) == (0, rec["rows_loaded"])
    assert res2.target.count() == rec["rows_loaded"]
    hist = R.run_history(spark, runs).collect()
    assert [r["pipeline_id"] for r in hist] == ["p2", "p1"]
    stats = R.history_stats(R.run_history(spark, runs)).first()
    assert stats["total_runs"] == 2 and stats["successful_runs"] == 2
    report = build_report(R.run_history(spark, runs), res2.target, ["numero_operacion"])
    assert report["kpis"].count() == 14 and report["sample"].count() == 100
    write_report(report, scratch("report"))


def test_failure_leaves_target_and_records_run(spark, scratch):
    src = _generated_csv(spark, scratch, 500)
    target, runs = scratch("target"), scratch("runs")
    job = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00")
    first = job.run(src, pipeline_id="ok").target.count()
    bad = spark.createDataFrame([("x",)], "numero_operacion string")
    broken = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00", order_by=["missing_column"])
    with pytest.raises(Exception):
        broken.run(bad, pipeline_id="bad")
    assert TargetTable(spark, target).current().count() == first
    rec = R.run_by_id(R.run_history(spark, runs), "bad").first()
    assert rec["status"] == "failed" and rec["error_message"]


def test_quick_validate(spark, scratch):
    rows, summary = quick_validate(spark, _generated_csv(spark, scratch, 300), AS_OF)
    s = summary.first()
    assert rows.count() == s["valid_rows"]
    assert set(rows.columns) >= {"is_duplicate", "content_hash"}


def test_csv_row_index_matches_file_order(spark, scratch):
    df = spark.range(5000).select(F.col("id").cast("string").alias("v"))
    folder = scratch("idx")
    C.write_csv(df.repartition(1).sortWithinPartitions(F.col("v").cast("long")), folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        back = C.scan_csv(spark, folder)
        assert back.rdd.getNumPartitions() >= 1
        rows = back.select(F.col("v").cast("long").alias("v"), C.ROW).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r["v"] == r[C.ROW] for r in rows)


def test_jdbc_roundtrip_with_pushdown(spark, scratch):
    """Embedded in-memory Derby (no port). Derby maps text to CLOB, so its own types are used here."""
    url = "jdbc:derby:memory:ledgerline;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = G.generate_operations(spark, 200, AS_OF).drop("gen_id")
    write_table(df, url, "OPERACIONES", mode="overwrite", properties=props, column_types=None)
    with pytest.raises(ValueError, match="single_task"):
        read_table(spark, url, "OPERACIONES", props)
    halves = read_table(spark, url, "OPERACIONES", props, predicates=['"monto" < 25000', '"monto" >= 25000'])
    assert halves.count() == 200 and halves.rdd.getNumPartitions() == 2
    back = read_table(spark, url, "OPERACIONES", props, single_task=True)
    assert back.count() == 200
    amount = [c for c in back.columns if c.lower() == "monto"][0]
    q = back.filter(F.col(amount) > 25000.0).select(amount)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan" in plan
    assert q.count() == df.filter(F.col("monto") > 25000.0).count()


def test_incremental_stream(spark, scratch):
    from ledgerline.streaming import start_incremental_load
    landing = scratch("landing")
    G_df = G.generate_operations(spark, 300, AS_OF).drop("gen_id")
    G_df = G_df.withColumn("fecha_operacion", F.date_format("fecha_operacion", "yyyy-MM-dd HH:mm:ss"))
    C.write_csv(G_df.coalesce(1), landing + "/a")
    target, runs = scratch("target"), scratch("runs")
    job = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00")
    q = start_incremental_load(spark, landing + "/a", job, scratch("ckpt"), trigger_once=True)
    q.awaitTermination(300)
    assert TargetTable(spark, target).current().count() == 300
    assert R.run_history(spark, runs).count() == 1


def test_store_create_keys_publish_drop(spark, scratch):
    from ledgerline import schema as S
    store = TargetTable(spark, scratch("store"))
    assert store.current() is None and store.keys().count() == 0
    t = store.create()
    assert [(f.name, f.dataType) for f in t.schema] == [(f.name, f.dataType) for f in S.TARGET_SCHEMA]
    assert t.count() == 0 and store.max_id() == 0
    store.drop()
    assert not store.exists()


def test_load_failure_counts_batch_rows(spark, scratch):
    src = _generated_csv(spark, scratch, 300)
    target, runs = scratch("target"), scratch("runs")
    job = ReconciliationJob(spark, target, runs, as_of="2001-02-01 00:00:00")
    orig = job._load

    def boom(deduped, pid):
        raise RuntimeError("disk full")
    job._load = boom
    with pytest.raises(RuntimeError):
        job.run(src, pipeline_id="loadfail")
    job._load = orig
    rec = R.run_by_id(R.run_history(spark, runs), "loadfail").first()
    assert rec["error_message"].startswith("Failed to load data: ")
    assert rec["load_failed"] == rec["validation_passed"] - rec["duplicates_found"] > 0


def test_parquet_row_index_across_files(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerline.sources.parquet import ROW as PROW
    from ledgerline.sources.parquet import scan_parquet
    folder = scratch("pq")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local)
    start = 0
    for i, n in enumerate([700, 1, 1300]):
        pq.write_table(pa.table({"v": list(range(start, start + n))}), f"{local}/part-{i:05d}.parquet",
                       row_group_size=256)
        start += n
    rows = scan_parquet(spark, folder).collect()
    assert len(rows) == 2001 and all(r["v"] == r[PROW] for r in rows)


def test_loading_flow_like_the_reference_script(spark, scratch):
    """create -> upsert all -> stats -> 5-row sample -> re-load 100 rows: updates only, same size."""
    from ledgerline.operators import aggregates as A
    from ledgerline.operators import upsert as U
    from ledgerline.plans.catalog import AS_OF, deduped_ops
    from tests.conftest import SF001
    store = TargetTable(spark, scratch("target"))
    batch = U.normalize_load(deduped_ops(spark, SF001)).withColumn("is_duplicate", F.lit(0))
    store.create()
    assert store.load(batch, load_time=AS_OF) == {"inserted": 2951, "updated": 0}
    stats = A.table_stats(store.current()).first()
    assert stats["total_rows"] == 2951 and abs(stats["total_amount"] - 156651964.32) < 1e-6
    assert A.query_filtered(store.current(), None, limit=5, order_by=["id"]).count() == 5
    hundred = A.report_sample(batch, ["numero_operacion"], 100)
    assert store.load(hundred, load_time=AS_OF) == {"inserted": 0, "updated": 100}
    assert store.current().count() == 2951


def test_command_line(spark, scratch):
    from ledgerline.cli import main
    src, target, runs, rep = scratch("cli-csv"), scratch("cli-target"), scratch("cli-runs"), scratch("cli-rep")
    main(["generate", src, "--rows", "400", "--as-of", AS_OF], spark=spark)
    out = main(["run", src, "--target", target, "--runs", runs, "--as-of", "2001-02-01 00:00:00",
                "--pipeline-id", "cli1"], spark=spark)
    assert out["status"] == "success" and out["input_rows"] == 420
    main(["report", "--runs", runs, "--target", target, "--output", rep], spark=spark)
    assert spark.read.option("header", True).csv(f"{rep}/kpis").count() == 7
    main(["reset", "--target", target], spark=spark)
    assert not TargetTable(spark, target).exists()


def test_header_only_input(spark, scratch):
    from ledgerline import schema as S
    folder = scratch("empty")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local)
    with open(f"{local}/part-0.csv", "w") as fh:
        fh.write(",".join(S.OPS_COLUMNS) + "\n")
    job = ReconciliationJob(spark, scratch("target"), scratch("runs"), as_of=AS_OF)
    rec = job.run(folder, pipeline_id="empty").record
    assert (rec["status"], rec["input_rows"], rec["rows_loaded"], rec["validation_errors"]) == ("success", 0, 0, [])
    assert TargetTable(spark, job.store.root).current().count() == 0


def _part_files(store):
    """{part: its files} of a target in a folder."""
    local, out = f"{store.folder}/buckets-{store.part_count()}".removeprefix("file:"), {}
    for folder in os.listdir(local):
        if folder.startswith("_part="):
            names = [f for f in os.listdir(f"{local}/{folder}") if f.endswith(".parquet")]
            out[int(folder[6:])] = sorted((f, os.stat(f"{local}/{folder}/{f}").st_mtime_ns) for f in names)
    return out


def _batch_of(rows):
    return rows.drop("id", "fecha_carga", "is_duplicate").withColumn("row", F.monotonically_increasing_id()).withColumn(
        "fecha_operacion", F.date_format("fecha_operacion", "yyyy-MM-dd HH:mm:ss"))


def test_a_load_rewrites_only_buckets_with_updates_and_appends_the_rest(spark, scratch):
    src = _generated_csv(spark, scratch, 800)
    job = ReconciliationJob(spark, scratch("pt"), scratch("pr"), as_of="2001-02-01 00:00:00", target_parts=8)
    first = job.run(src, pipeline_id="b1").record
    before, ids = _part_files(job.store), {r.numero_operacion: r.id for r in job.store.current().collect()}
    assert len(before) == 8
    known = job.store.current([3]).limit(5)
    new = job.store.current([0, 1, 2, 3, 4]).limit(60).withColumn("numero_operacion", F.regexp_replace("numero_operacion", "OP-0", "OP-9"))
    again = job.run(_batch_of(known.unionByName(new)), pipeline_id="b2").record
    assert (again["rows_loaded"], again["rows_updated"]) == (60, 5)
    after = _part_files(job.store)
    # every file but those of bucket 3 is still there; files with new keys stand beside them
    assert {p for p in before if not set(before[p]) <= set(after[p])} == {3} and sum(map(len, after.values())) > sum(map(len, before.values()))
    rows = job.store.current().collect()
    assert len(rows) == first["rows_loaded"] + 60 == len({r.id for r in rows}) == len({r.numero_operacion for r in rows})
    assert all(ids[r.numero_operacion] == r.id for r in rows if r.numero_operacion in ids)


def test_overwritten_buckets_keep_no_old_files(spark, scratch):
    src = _generated_csv(spark, scratch, 300)
    job = ReconciliationJob(spark, scratch("ft"), scratch("fr"), as_of="2001-02-01 00:00:00", target_parts=2)
    sizes = []
    for k in range(4):
        job.run(src, pipeline_id=f"f{k}")
        sizes.append(sum(map(len, _part_files(job.store).values())))
    assert sizes[1] == sizes[2] == sizes[3]


@pytest.mark.parametrize("updates", [True, False])
def test_a_statement_that_fails_leaves_the_table(spark, scratch, monkeypatch, updates):
    src = _generated_csv(spark, scratch, 300)
    job = ReconciliationJob(spark, scratch("st"), scratch("sr"), as_of="2001-02-01 00:00:00", target_parts=2)
    rows = job.run(src, pipeline_id="s1").record["rows_loaded"]
    old = sorted(map(str, job.store.current().collect()))
    source = src if updates else _batch_of(job.store.current().withColumn("numero_operacion", F.regexp_replace("numero_operacion", "OP-0", "OP-9")))
    real = TargetTable._write

    def half(self, frame, parts, overwrite, deal):
        # tasks fail after others have written their files
        lost = F.when(F.pmod(F.hash("numero_operacion"), F.lit(7)) == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("canal"))
        return real(self, frame.withColumn("canal", lost), parts, overwrite, deal)
    with monkeypatch.context() as m:
        m.setattr(TargetTable, "_write", half)
        with pytest.raises(Exception, match="lost"):
            job.run(source, pipeline_id="s2")
    rec = R.run_by_id(R.run_history(spark, job.runs_dir), "s2").first()
    assert (rec["status"], rec["load_failed"]) == ("failed", rows)
    store = TargetTable(spark, job.store.root)
    assert sorted(map(str, store.current().collect())) == old
    again = job.run(source, pipeline_id="s3").record
    assert (again["rows_updated"], again["rows_loaded"]) == ((rows, 0) if updates else (0, rows))


def test_required_columns_are_enforced(spark, scratch):
    src = _generated_csv(spark, scratch, 300)
    folder = scratch("nocanal")
    spark.read.option("header", True).csv(src).drop("canal").write.option("header", True).csv(folder)
    job = ReconciliationJob(spark, scratch("nt"), scratch("nr"), as_of="2001-02-01 00:00:00")
    with pytest.raises(NullInRequiredColumn, match="canal"):
        job.run(folder, pipeline_id="n1")
    rec = R.run_by_id(R.run_history(spark, job.runs_dir), "n1").first()
    assert rec["status"] == "failed" and rec["load_failed"] > 0 and job.store.current().count() == 0


@pytest.mark.parametrize("files", [1, 3, 7])
def test_missing_column_is_reported_for_any_number_of_files(spark, scratch, files):
    src, folder = _generated_csv(spark, scratch, 300), scratch("missing")
    spark.read.option("header", True).csv(src).drop("descripcion").repartition(files).write.option("header", True).csv(folder)
    rec = ReconciliationJob(spark, scratch("mt"), scratch("mr"), as_of="2001-02-01 00:00:00").run(folder, pipeline_id="m").record
    assert (None, "descripcion", "column_in_dataframe") in [(e["row"], e["column"], e["error"]) for e in rec["validation_errors"]]


def test_frames_with_tied_rows_load_once(spark, scratch):
    src = _generated_csv(spark, scratch, 300)
    rows = C.scan_csv(spark, src, row_index=False).withColumn("row", F.lit(1))
    a = ReconciliationJob(spark, scratch("a"), scratch("ar"), as_of="2001-02-01 00:00:00").run(rows, pipeline_id="t").record
    b = ReconciliationJob(spark, scratch("b"), scratch("br"), as_of="2001-02-01 00:00:00").run(src, pipeline_id="u").record
    assert a["rows_loaded"] == b["rows_loaded"] > 0


def test_warnings_are_recorded(spark, scratch):
    job = ReconciliationJob(spark, scratch("w"), scratch("wr"), as_of="2001-02-01 00:00:00")
    rec = job.run(_generated_csv(spark, scratch, 300), pipeline_id="w", expected_checksum=1.0).record
    assert [w.split(":")[0] if "mismatch" in w else w for w in rec["warnings"]] == ["Checksum mismatch", "Found 15 duplicate operation IDs"] \
        or len(rec["warnings"]) == 2
    assert R.run_history(spark, job.runs_dir).first()["warnings"] == rec["warnings"]


def test_error_text_is_whole(spark, scratch):
    job = ReconciliationJob(spark, scratch("e"), scratch("er"), as_of="2001-02-01 00:00:00")

    def boom(*a):
        raise RuntimeError("x" * 5000)
    job._load = boom
    with pytest.raises(RuntimeError):
        job.run(_generated_csv(spark, scratch, 300), pipeline_id="e")
    assert len(R.run_history(spark, job.runs_dir).first()["error_message"]) > 5000


def test_scratch_of_one_job_is_not_touched_by_another(spark, scratch):
    from ledgerline.operators import dedup as D
    frame = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    flagged = D.flag_duplicates(frame, ["id"], ["k"])                   # holds a stored key table
    ReconciliationJob(spark, scratch("o"), scratch("or"), as_of="2001-02-01 00:00:00").run(_generated_csv(spark, scratch, 300), pipeline_id="o")
    assert flagged.filter("is_duplicate").count() == 90


def _write(folder, **files):
    local = folder.removeprefix("file:")
    os.makedirs(local)
    for name, text in files.items():
        with open(f"{local}/{name}.csv", "w") as f:
            f.write(text)
    return folder


def test_line_breaks_and_quotes_survive_a_round_trip(spark, scratch):
    rows = [(1, 'two\nlines, "quoted"'), (2, "plain"), (3, "a\r\nb"), (4, None)]
    folder = scratch("ml")
    C.write_csv(spark.createDataFrame(rows, "i int, t string"), folder)
    back = C.scan_csv(spark, folder)
    assert sorted((int(r.i), r.t) for r in back.collect()) == [(1, 'two\nlines, "quoted"'), (2, "plain"), (3, "a\nb"), (4, None)] \
        or sorted((int(r.i), r.t) for r in back.collect()) == rows


def test_ragged_rows(spark, scratch):
    folder = _write(scratch("rg"), a="a,b\n1,2\n3,4,5\n6\n7,8\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        C.scan_csv(spark, folder, row_index=False).collect()
    got = [(r.row, r.a, r.b, r[C.MALFORMED]) for r in C.scan_csv(spark, folder, malformed=True).orderBy("row").collect()]
    assert got == [(0, "1", "2", None), (1, None, None, "3,4,5"), (2, None, None, "6"), (3, "7", "8", None)]
    from ledgerline.operators.rules import ColumnSpec, RuleSet
    from ledgerline.operators.validate import validate
    v = validate(C.scan_csv(spark, folder, malformed=True), RuleSet((ColumnSpec("a", "long", False), ColumnSpec("b", "long", False))), id_cols=["row"])
    assert sorted(map(tuple, v.failures().collect())) == [(1, C.MALFORMED, "malformed_row"), (2, C.MALFORMED, "malformed_row")]


def test_files_with_another_column_order_fail(spark, scratch):
    folder = _write(scratch("co"), a="a,b\n1,2\n", b="b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        C.scan_csv(spark, folder, row_index=False).collect()


@pytest.mark.parametrize("k", [1, 7, 60])
def test_first_failures_match_global_top_k(spark, scratch, k):
    from ledgerline.operators.rules import default_rules
    from ledgerline.operators.validate import validate
    src = scratch("multi")
    gen = G.generate_operational_file(spark, 900, AS_OF, 0.05, 0.08)
    C.write_csv(gen.drop("gen_id", "source_id", "is_copy", "error_kind").repartition(5), src)
    job = ReconciliationJob(spark, scratch("t"), scratch("r"), as_of="2001-02-01 00:00:00", max_errors=k)
    got = job.run(src, pipeline_id=f"k{k}").record["validation_errors"]
    v = validate(C.scan_csv(spark, src), default_rules("2001-02-01 00:00:00"), id_cols=[C.ROW])
    want = [{"row": r[C.ROW], "column": r["column"], "error": r["error"]} for r in v.failures_top(k).collect()]
    assert got == want and len(got) == k


@pytest.mark.parametrize("key", ["pipeline_default_rows", "pipeline_default_parquet_rows", "quick_validate_default"])
def test_a_registered_query_rejects_all_rows_of_a_repeated_id(spark, key):
    from ledgerline.plans.catalog import QUERIES
    from ledgerline.sources.fixtures import ops_planted
    from tests.conftest import SF001
    repeated = {r.numero_operacion for r in ops_planted(spark, SF001).groupBy("numero_operacion").count().filter("count > 1").collect()}
    got = [r.numero_operacion for r in QUERIES[key](spark, SF001).select("numero_operacion").collect()]
    kept = {r.numero_operacion for r in QUERIES["pipeline_final_rows"](spark, SF001).select("numero_operacion").collect()}
    assert len(got) == len(set(got)) and set(got) == kept - repeated and kept & repeated
