"""Hand-made edge rows (FIXTURES §3): every other column valid, one outcome each."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S
from ledgerline.operators import dedup as D
from ledgerline.operators import upsert as U
from ledgerline.operators.rules import default_rules
from ledgerline.operators.validate import validate
from ledgerline.plans import runs as R

AS_OF = "2001-01-01 00:00:00"
BASE = {"fecha_operacion": "2000-12-01 10:00:00", "numero_operacion": "OP-00000001", "tipo_operacion": "DEPOSITO",
        "monto": "100.0", "moneda": "PEN", "cuenta_origen": "191-1234567-0-89", "cuenta_destino": None,
        "banco_origen": "BCP", "banco_destino": None, "descripcion": "pago", "estado": "COMPLETADA",
        "canal": "WEB"}
COLS = list(BASE) + ["row"]
SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "row" else T.StringType()) for c in COLS])


def frame(spark, *changes, drop=()):
    rows = []
    for i, ch in enumerate(changes):
        r = dict(BASE, numero_operacion=f"OP-{i + 1:08d}")
        r.update(ch)
        r["row"] = i
        rows.append(tuple(r[c] for c in COLS))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.drop(*drop) if drop else df


def failures(spark, *changes, rules=None, drop=()):
    v = validate(frame(spark, *changes, drop=drop), rules or default_rules(AS_OF))
    return v, sorted((r["row"], r["column"], r["error"]) for r in v.failures().collect())


def test_amount_zero_rejected(spark):
    _, f = failures(spark, {"monto": "0"})
    assert f == [(0, "monto", S.MSG_AMOUNT_POSITIVE)]


def test_amount_bounds(spark):
    v, f = failures(spark, {"monto": "0.01"}, {"monto": "1000000"}, {"monto": "1000000.01"})
    assert f == [(2, "monto", S.MSG_AMOUNT_MAX)]
    assert v.valid().count() == 2


def test_date_bound_is_inclusive(spark):
    _, f = failures(spark, {"fecha_operacion": AS_OF}, {"fecha_operacion": "2001-01-01 00:00:00.000001"})
    assert f == [(1, "fecha_operacion", S.MSG_FUTURE_DATE)]


def test_bad_date_is_one_coerce_failure(spark):
    _, f = failures(spark, {"fecha_operacion": "FECHA_INVALIDA"})
    assert f == [(0, "fecha_operacion", "coerce_dtype('datetime64[ns]')")]


def test_null_date_is_one_not_null_failure(spark):
    _, f = failures(spark, {"fecha_operacion": None})
    assert f == [(0, "fecha_operacion", S.MSG_NOT_NULL)]


def test_two_null_ids_fail_not_null_only(spark):
    _, f = failures(spark, {"numero_operacion": None}, {"numero_operacion": None})
    assert f == [(0, "numero_operacion", S.MSG_NOT_NULL), (1, "numero_operacion", S.MSG_NOT_NULL)]


def test_id_format(spark):
    _, f = failures(spark, {"numero_operacion": "OP-1234567"}, {"numero_operacion": "OP-123456789"},
                    {"numero_operacion": "op-12345678"})
    assert f == [(i, "numero_operacion", S.MSG_OP_ID_FORMAT) for i in range(3)]


def test_repeated_id_rejects_every_copy_or_later_ones(spark):
    same = {"numero_operacion": "OP-00000042"}
    _, f = failures(spark, same, same, same)
    assert f == [(i, "numero_operacion", S.MSG_UNIQUE) for i in range(3)]
    rules = default_rules(AS_OF, unique_mode="keep_first", order_by=["row"])
    v, f = failures(spark, same, same, same, rules=rules)
    assert f == [(1, "numero_operacion", S.MSG_UNIQUE), (2, "numero_operacion", S.MSG_UNIQUE)]
    assert [r["row"] for r in v.valid().collect()] == [0]


def test_account_format(spark):
    _, f = failures(spark, {"cuenta_origen": "191-1234567-0-89"}, {"cuenta_origen": "191-123456-0-89"})
    assert f == [(1, "cuenta_origen", S.MSG_ACCOUNT_FORMAT)]


def test_allowed_values_are_case_sensitive(spark):
    _, f = failures(spark, {"estado": "completada"}, {"tipo_operacion": "PAGO"}, {"moneda": "EUR"},
                    {"canal": "APP"})
    assert f == [(0, "estado", S.isin_message(S.ESTADO_VALUES)), (1, "tipo_operacion", S.isin_message(S.TIPO_VALUES)),
                 (2, "moneda", S.isin_message(S.MONEDA_VALUES)), (3, "canal", S.isin_message(S.CANAL_VALUES))]


def test_text_amount_is_coerce_failure_and_not_in_total(spark):
    v, f = failures(spark, {"monto": "abc"}, {"monto": "10.5"})
    assert f == [(0, "monto", "coerce_dtype('float64')")]
    assert v.control_total(10.5).first()["checksum_ok"] is True


def test_one_row_three_failures(spark):
    v, f = failures(spark, {"monto": "-5", "estado": "X", "canal": "Y"})
    assert len(f) == 3
    s = v.summary().first()
    assert (s["total_rows"], s["valid_rows"], s["invalid_rows"]) == (1, 0, 1)


def test_missing_column_rejects_no_row(spark):
    v, f = failures(spark, {}, {}, drop=("canal",))
    assert f == [(None, "canal", S.MSG_MISSING_COLUMN)]
    assert v.valid().count() == 2


def test_extra_column_kept(spark):
    v = validate(frame(spark, {}).withColumn("extra", F.lit("e")), default_rules(AS_OF))
    assert v.valid().first()["extra"] == "e"


def test_empty_input(spark):
    v = validate(frame(spark, {}).limit(0), default_rules(AS_OF))
    s = v.summary().first()
    assert (s["total_rows"], s["valid_rows"], s["invalid_rows"], s["success_rate"]) == (0, 0, 0, 0.0)
    rep = D.dedup_report(D.dedup_stats(frame(spark, {}).limit(0), ["numero_operacion"])).first()
    assert (rep["total_input"], rep["duplicate_rate"], rep["retention_rate"]) == (0, 0.0, 1.0)


def test_control_total_tolerance(spark):
    v = validate(frame(spark, {"monto": "10.00"}), default_rules(AS_OF))
    assert v.control_total(10.009).first()["checksum_ok"] is True
    assert v.control_total(10.01).first()["checksum_ok"] is False
    msgs = [r["message"] for r in v.checksum_warnings(10.01).collect()]
    assert msgs == ["Checksum mismatch: expected 10.01, got 10.00"]


def test_priority_null_loses_both_ways(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 3, 3)], "key string, p int, o int")
    desc = D.dedup_priority(df, ["key"], "p", "desc", ["o"]).first()
    asc = D.dedup_priority(df, ["key"], "p", "asc", ["o"]).first()
    assert (desc["p"], asc["p"]) == (5, 3)


def test_merge_semantics(spark):
    df = spark.createDataFrame([(None, "a", 1.0, 1), ("k", None, None, 2), ("k", "x", None, 3)],
                               "key string, v string, n double, o int")
    out = D.merge_duplicates(df, ["key"], {"v": "first", "n": "sum"}, ["o"]).collect()
    assert [(r["key"], r["v"], r["n"]) for r in out] == [("k", "x", 0.0)]


def test_hash_text_of_fractional_second(spark):
    df = spark.createDataFrame([("OP-00000001", 100.0, dt.datetime(2025, 1, 2, 12, 0, 0, 500000), "191-1")],
                               "numero_operacion string, monto double, fecha_operacion timestamp, cuenta_origen string")
    got = D.with_content_hash(df).first()["content_hash"]
    text = "OP-00000001" + "100.0" + "2025-01-02 12:00:00.500000" + "191-1"
    assert got == hashlib.sha256(text.encode()).hexdigest()[:16]


def _target(spark):
    rows = validate(frame(spark, {}, {"numero_operacion": "OP-00000009"}), default_rules(AS_OF)).valid()
    return U.to_target(D.with_content_hash(U.normalize_load(rows)), ids=F.col("row") + 1,
                       load_time="2000-01-01 00:00:00").withColumn("is_duplicate", F.lit(0))


def test_upsert_same_batch_twice(spark):
    target = _target(spark)
    batch = target.drop("id", "fecha_carga")
    once = U.upsert_merge(target, batch, load_time=AS_OF)
    c = U.upsert_counts(once).first()
    assert (c["rows_kept"], c["rows_inserted"], c["rows_updated"]) == (0, 0, 2)
    twice = U.upsert_merge(once.drop(U.ACTION), batch, load_time=AS_OF)
    cols = [c for c in target.columns if c != "fecha_carga"]
    assert sorted(map(tuple, once.select(cols).collect())) == sorted(map(tuple, twice.select(cols).collect()))


def test_upsert_repeated_key(spark):
    target = _target(spark)
    batch = target.drop("id", "fecha_carga").withColumn("o", F.lit(1))
    dup = batch.unionByName(batch.withColumn("monto", F.lit(7.0)).withColumn("o", F.lit(2)))
    with pytest.raises(ValueError):
        U.upsert_merge(target, dup, load_time=AS_OF)
    out = U.upsert_merge(target, dup, load_time=AS_OF, on_duplicate="last", order_by=["o"])
    assert {r["monto"] for r in out.collect()} == {7.0}


def test_normalize_load(spark):
    df = frame(spark, {"descripcion": "d" * 501, "banco_destino": ""})
    r = U.normalize_load(df).first()
    assert len(r["descripcion"]) == 500 and r["banco_destino"] is None


def test_truncated_run_record_is_quarantined(spark, scratch):
    folder = scratch("runs")
    runs = R.record_frame(spark, {"pipeline_id": "a", "start_time": dt.datetime(2025, 1, 1), "input_rows": 10,
                                  "rows_loaded": 5, "status": "success"})
    R.write_records(runs, folder)
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    with open(os.path.join(local, "broken.json"), "w") as fh:
        fh.write(json.dumps({"pipeline_id": "b", "input_rows": 3})[:-5])
    hist = R.run_history(spark, folder).collect()
    assert [r["pipeline_id"] for r in hist] == ["a"]
    assert R.quarantined(spark, folder).count() == 1


def test_run_with_no_input(spark):
    runs = R.record_frame(spark, {"pipeline_id": "z", "start_time": dt.datetime(2025, 1, 1), "input_rows": 0,
                                  "rows_loaded": 0, "rows_updated": 0, "status": "success",
                                  "processing_time_seconds": 0.0})
    assert R.run_summary(runs).first()["success_rate"] == "0.00%"
    kpi = {r["label"]: r["value"] for r in R.report_kpis(runs).collect()}
    assert kpi["Tasa de Éxito"] == "0.00%"


def test_unknown_dedup_strategy(spark):
    with pytest.raises(ValueError):
        D.deduplicate(frame(spark, {}), "fuzzy", ["row"])


def test_upsert_into_empty_target_fast_path(spark):
    target = _target(spark)
    batch = target.drop("id", "fecha_carga")
    empty = target.limit(0)
    a = U.upsert_merge(empty, batch, load_time=AS_OF)
    b = U.upsert_merge(empty, batch, load_time=AS_OF, target_empty=True)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "FullOuter" not in plan
    cols = [c for c in a.columns if c != "id"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    assert b.select("id").distinct().count() == b.count() == 2


def test_extra_date_layouts(spark):
    from dataclasses import replace
    rules = default_rules(AS_OF)
    cols = tuple(replace(c, formats=("dd/MM/yyyy HH:mm",)) if c.name == "fecha_operacion" else c
                 for c in rules.columns)
    v = validate(frame(spark, {"fecha_operacion": "01/12/2000 10:30"}, {"fecha_operacion": "2000-12-01 10:30:00"}),
                 replace(rules, columns=cols))
    got = sorted(r["fecha_operacion"] for r in v.valid().collect())
    assert got == [dt.datetime(2000, 12, 1, 10, 30)] * 2
    _, f = failures(spark, {"fecha_operacion": "01/12/2000 10:30"})
    assert f == [(0, "fecha_operacion", "coerce_dtype('datetime64[ns]')")]
