"""Independent SQL oracles (DuckDB dialect) for the registered queries, same keys and column names.

The ``ops`` fixture is inlined as a CTE from the same expression list Spark reads; every rule is
restated here as a plain WHERE clause, so the oracle shares no Spark code path.
"""

from __future__ import annotations

from ledgerline import schema as S
from ledgerline.sources.fixtures import AS_OF, OPS_CTE, PLANTED_CTE


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, fecha_operacion, monto, l_quantity"
ORDER_SQL = ("l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, "
             "fecha_operacion NULLS FIRST, monto NULLS FIRST, l_quantity NULLS FIRST")
LI_TIE_SQL = ("l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST, "
              "l_quantity NULLS FIRST, l_shipdate NULLS FIRST")
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"
TS = "try_cast(fecha_operacion AS TIMESTAMP)"
DUPKEYS = ("dupkeys AS (SELECT numero_operacion AS k FROM ops WHERE numero_operacion IS NOT NULL "
           "GROUP BY numero_operacion HAVING count(*) > 1)")
FIRSTS = (f"ranked AS (SELECT *, row_number() OVER (PARTITION BY numero_operacion ORDER BY {ORDER_SQL}) AS rn "
          "FROM ops)")


def _isin(values):
    return "(" + ", ".join(q(v) for v in values) + ")"


# (kind, column, error, failing condition) -- restated from the rule definitions
RULES = [
    ("coerce", "fecha_operacion", S.coerce_message("timestamp"), f"fecha_operacion IS NOT NULL AND {TS} IS NULL"),
    ("not_null", "fecha_operacion", S.MSG_NOT_NULL, "fecha_operacion IS NULL"),
    ("max_date", "fecha_operacion", S.MSG_FUTURE_DATE, f"{TS} > {AS_OF_SQL}"),
    ("not_null", "numero_operacion", S.MSG_NOT_NULL, "numero_operacion IS NULL"),
    ("regex_id", "numero_operacion", S.MSG_OP_ID_FORMAT, "NOT regexp_matches(numero_operacion, '^OP-[0-9]{8}$')"),
    ("unique", "numero_operacion", S.MSG_UNIQUE, "numero_operacion IN (SELECT k FROM dupkeys)"),
    ("not_null", "tipo_operacion", S.MSG_NOT_NULL, "tipo_operacion IS NULL"),
    ("isin", "tipo_operacion", S.isin_message(S.TIPO_VALUES), f"tipo_operacion NOT IN {_isin(S.TIPO_VALUES)}"),
    ("not_null", "monto", S.MSG_NOT_NULL, "monto IS NULL"),
    ("positive", "monto", S.MSG_AMOUNT_POSITIVE, "monto <= 0"),
    ("max_amount", "monto", S.MSG_AMOUNT_MAX, "monto > 1000000"),
    ("not_null", "moneda", S.MSG_NOT_NULL, "moneda IS NULL"),
    ("isin", "moneda", S.isin_message(S.MONEDA_VALUES), f"moneda NOT IN {_isin(S.MONEDA_VALUES)}"),
    ("not_null", "cuenta_origen", S.MSG_NOT_NULL, "cuenta_origen IS NULL"),
    ("regex_account", "cuenta_origen", S.MSG_ACCOUNT_FORMAT,
     "NOT regexp_matches(cuenta_origen, '^[0-9]{3}-[0-9]{7}-[0-9]-[0-9]{2}$')"),
    ("not_null", "banco_origen", S.MSG_NOT_NULL, "banco_origen IS NULL"),
    ("not_null", "descripcion", S.MSG_NOT_NULL, "descripcion IS NULL"),
    ("not_null", "estado", S.MSG_NOT_NULL, "estado IS NULL"),
    ("isin", "estado", S.isin_message(S.ESTADO_VALUES), f"estado NOT IN {_isin(S.ESTADO_VALUES)}"),
    ("not_null", "canal", S.MSG_NOT_NULL, "canal IS NULL"),
    ("isin", "canal", S.isin_message(S.CANAL_VALUES), f"canal NOT IN {_isin(S.CANAL_VALUES)}"),
]

OPS_COLS_TYPED = ", ".join(
    (f"{TS} AS fecha_operacion" if c == "fecha_operacion" else c)
    for c in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"] + S.OPS_COLUMNS)
OPS_COLS_RAW = ", ".join(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"] + S.OPS_COLUMNS)


def fails_cte(kinds=None, skip_columns=()) -> str:
    parts = [f"SELECT {IDS}, {q(col)} AS \"column\", {q(err)} AS error FROM ops WHERE {cond}"
             for kind, col, err, cond in RULES
             if (kinds is None or kind in kinds) and col not in skip_columns]
    return "fails AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def nfail_expr(unique_cond: str = "numero_operacion IN (SELECT k FROM dupkeys)") -> str:
    terms = []
    for kind, _col, _err, cond in RULES:
        c = unique_cond if kind == "unique" else cond
        terms.append(f"(CASE WHEN {c} THEN 1 ELSE 0 END)")
    return " + ".join(terms)


WITH_BASE = f"WITH {OPS_CTE},\n{DUPKEYS}"
SCORED = f"scored AS (SELECT *, {nfail_expr()} AS nfail FROM ops)"
VALID = f"valid AS (SELECT {OPS_COLS_TYPED} FROM scored WHERE nfail = 0)"


def _hash_expr(prefix: str = "") -> str:
    p = prefix
    ts = (f"CASE WHEN {p}fecha_operacion IS NULL THEN 'NaT' WHEN epoch_us({p}fecha_operacion) % 1000000 = 0 "
          f"THEN strftime({p}fecha_operacion, '%Y-%m-%d %H:%M:%S') "
          f"ELSE strftime({p}fecha_operacion, '%Y-%m-%d %H:%M:%S.%f') END")
    return (f"substr(sha256(coalesce({p}numero_operacion, 'None') || coalesce(cast({p}monto AS VARCHAR), 'nan') || "
            f"{ts} || coalesce({p}cuenta_origen, 'None')), 1, 16)")


HASHED = f"hashed AS (SELECT *, {_hash_expr()} AS content_hash FROM valid)"
DEDUPED = (f"deduped AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY content_hash "
           f"ORDER BY {ORDER_SQL}) AS rn FROM hashed) WHERE rn = 1)")
PIPE = f"{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED},\n{DEDUPED}\n"


def _rule_sql(*kinds) -> str:
    return f"{WITH_BASE},\n{fails_cte(set(kinds))}\nSELECT * FROM fails"


def _sum2(col: str) -> str:
    return f"sum(CAST({col} AS DECIMAL(18,2)))"


ORACLES: dict[str, str] = {}

ORACLES["validation_failures"] = f"{WITH_BASE},\n{fails_cte()}\nSELECT * FROM fails"
ORACLES["validation_summary"] = f"""{WITH_BASE},\n{SCORED}
SELECT count(*) AS total_rows, CAST(count_if(nfail = 0) AS BIGINT) AS valid_rows,
       CAST(count_if(nfail > 0) AS BIGINT) AS invalid_rows,
       CASE WHEN count(*) = 0 THEN 0.0 ELSE count_if(nfail = 0) / count(*) END AS success_rate
FROM scored"""
ORACLES["failures_by_rule"] = (f"{WITH_BASE},\n{fails_cte()}\nSELECT \"column\", error, count(*) AS failures "
                               "FROM fails GROUP BY ALL")
ORACLES["failures_top100"] = (f"{WITH_BASE},\n{fails_cte()}\nSELECT * FROM fails ORDER BY {ORDER_SQL}, "
                              "\"column\", error LIMIT 100")
ORACLES["valid_rows"] = f"{WITH_BASE},\n{SCORED},\n{VALID}\nSELECT * FROM valid"
ORACLES["rejected_rows"] = (f"{WITH_BASE},\n{SCORED}\nSELECT {OPS_COLS_RAW}, CAST(nfail AS INTEGER) AS n_failures "
                            "FROM scored WHERE nfail > 0")
for _k in ["coerce", "not_null", "max_date", "positive", "max_amount", "regex_id", "regex_account", "isin",
           "unique"]:
    ORACLES[f"rule_{_k}"] = _rule_sql(_k)
ORACLES["missing_column"] = (f"{WITH_BASE},\n{fails_cte(skip_columns=('canal',))}\n"
                             "SELECT \"column\", error, count(*) AS failures FROM fails GROUP BY ALL\n"
                             f"UNION ALL SELECT 'canal', {q(S.MSG_MISSING_COLUMN)}, 1")
ORACLES["control_total"] = f"""{WITH_BASE},\n{SCORED},\n{VALID}
SELECT 1000000.0::DOUBLE AS expected_total, coalesce({_sum2('monto')}, 0)::DOUBLE AS actual_total,
       abs(coalesce({_sum2('monto')}, 0) - CAST('1000000.0' AS DECIMAL(38,10))) < 0.01 AS checksum_ok
FROM valid"""
ORACLES["validation_warnings"] = f"""{WITH_BASE},\n{SCORED},\n{VALID},
tot AS (SELECT coalesce({_sum2('monto')}, 0) AS t FROM valid),
dups AS (SELECT (SELECT count(*) FROM ops) - (SELECT count(*) FROM (SELECT DISTINCT numero_operacion FROM ops)) AS n)
SELECT 'Checksum mismatch: expected 1000000.0, got ' || CAST(t AS VARCHAR) AS message FROM tot
WHERE NOT abs(t - CAST('1000000.0' AS DECIMAL(38,10))) < 0.01
UNION ALL
SELECT 'Found ' || CAST(n AS VARCHAR) || ' duplicate operation IDs' FROM dups WHERE n > 0"""
ORACLES["custom_rules"] = """
SELECT 'orders' AS source, o_orderkey AS row_key, 'o_totalprice' AS "column", 'not_nullable' AS error
  FROM orders WHERE o_totalprice IS NULL
UNION ALL SELECT 'orders', o_orderkey, 'o_totalprice', 'price must be positive' FROM orders WHERE o_totalprice <= 0
UNION ALL SELECT 'orders', o_orderkey, 'o_totalprice', 'Amount exceeds maximum limit' FROM orders
  WHERE o_totalprice > 400000.0
UNION ALL SELECT 'orders', o_orderkey, 'o_orderpriority', 'not_nullable' FROM orders WHERE o_orderpriority IS NULL
UNION ALL SELECT 'orders', o_orderkey, 'o_orderpriority', 'isin([''1-URGENT'', ''2-HIGH'', ''3-MEDIUM''])'
  FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'customer', c_custkey, 'c_acctbal', 'not_nullable' FROM customer WHERE c_acctbal IS NULL
UNION ALL SELECT 'customer', c_custkey, 'c_acctbal', 'balance must be positive' FROM customer WHERE c_acctbal <= 0
"""
ORACLES["valid_keep_first"] = f"""{WITH_BASE},\n{FIRSTS},
scored AS (SELECT *, {nfail_expr('numero_operacion IS NOT NULL AND rn > 1')} AS nfail FROM ranked),
{VALID}
SELECT * FROM valid"""

# ---- dedup ---------------------------------------------------------------------------------------
ORACLES["content_hash"] = f"{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED}\nSELECT {IDS}, content_hash FROM hashed"
ORACLES["flag_duplicates"] = f"""WITH {OPS_CTE},\n{FIRSTS}
SELECT {IDS}, numero_operacion, rn > 1 AS is_duplicate FROM ranked"""
ORACLES["dedup_hash"] = PIPE + "SELECT * FROM deduped"
ORACLES["dedup_key"] = f"WITH {OPS_CTE},\n{FIRSTS}\nSELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1"
ORACLES["dedup_key_multi"] = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_TIE_SQL}) AS rn FROM lineitem)
WHERE rn = 1"""
ORACLES["find_duplicates"] = f"""WITH {OPS_CTE}
SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY numero_operacion) AS n FROM ops) WHERE n > 1"""
ORACLES["dedup_priority_desc"] = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, {LI_TIE_SQL}) AS rn FROM lineitem)
WHERE rn = 1"""
ORACLES["dedup_priority_asc"] = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate ASC NULLS LAST, {LI_TIE_SQL}) AS rn FROM lineitem)
WHERE rn = 1"""


def _first(col: str, last: bool = False) -> str:
    direction = " DESC NULLS LAST" if last else " NULLS FIRST"
    order = ", ".join(c.replace(" NULLS FIRST", "") + direction for c in LI_TIE_SQL.split(", "))
    return f"first({col} ORDER BY {order}) FILTER (WHERE {col} IS NOT NULL)"


ORACLES["merge_duplicates"] = f"""
SELECT l_orderkey, l_linenumber, {_first('l_partkey')} AS l_partkey, {_first('l_suppkey')} AS l_suppkey,
       {_first('l_extendedprice')} AS l_extendedprice, coalesce(sum(l_quantity), 0) AS l_quantity,
       max(l_discount) AS l_discount, min(l_tax) AS l_tax, {_first('l_shipdate', True)} AS l_shipdate,
       {_first('l_extendedprice', True)} AS last_extendedprice
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber"""
_STATS = f"""WITH {OPS_CTE},
c AS (SELECT (SELECT count(*) FROM ops) AS total_input,
             (SELECT count(*) FROM (SELECT DISTINCT numero_operacion FROM ops)) AS final_count)
"""
ORACLES["dedup_stats"] = _STATS + """SELECT total_input, total_input - final_count AS duplicates_found,
       total_input - final_count AS duplicates_removed, final_count FROM c"""
ORACLES["dedup_report"] = _STATS + """SELECT total_input, total_input - final_count AS duplicates_found,
       total_input - final_count AS duplicates_removed, final_count,
       CASE WHEN total_input = 0 THEN 0.0 ELSE (total_input - final_count) / total_input END AS duplicate_rate,
       1.0 - CASE WHEN total_input = 0 THEN 0.0 ELSE (total_input - final_count) / total_input END AS retention_rate
FROM c"""
ORACLES["dedup_documents_text"] = """SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS FIRST) AS rn FROM documents) WHERE rn = 1"""
ORACLES["distinct_rows"] = f"WITH {OPS_CTE}\nSELECT DISTINCT {', '.join(S.OPS_COLUMNS)} FROM ops"
ORACLES["quick_validate"] = f"""{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED},
ranked2 AS (SELECT *, row_number() OVER (PARTITION BY numero_operacion ORDER BY {ORDER_SQL}) AS rn FROM hashed)
SELECT {IDS}, numero_operacion, rn > 1 AS is_duplicate, content_hash FROM ranked2"""

# ---- queries and aggregates ----------------------------------------------------------------------
ORACLES["table_stats"] = PIPE + f"""SELECT count(*) AS total_rows, min(fecha_operacion) AS min_date,
       max(fecha_operacion) AS max_date, {_sum2('monto')}::DOUBLE AS total_amount,
       {_sum2('monto')}::DOUBLE / nullif(count(monto), 0) AS avg_amount
FROM deduped"""
ORACLES["table_stats_orders"] = f"""SELECT count(*) AS total_rows, min(o_orderdate) AS min_date,
       max(o_orderdate) AS max_date, {_sum2('o_totalprice')}::DOUBLE AS total_amount,
       {_sum2('o_totalprice')}::DOUBLE / nullif(count(o_totalprice), 0) AS avg_amount
FROM orders"""
ORACLES["query_filtered"] = (f"{WITH_BASE},\n{SCORED},\n{VALID}\nSELECT * FROM valid "
                             "WHERE estado = 'PENDIENTE' AND moneda = 'USD' AND canal = 'WEB'")
ORACLES["query_filtered_limit"] = """SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
ORDER BY o_orderkey LIMIT 5"""
ORACLES["existing_keys"] = PIPE + "SELECT numero_operacion FROM deduped"
ORACLES["report_sample"] = PIPE + "SELECT * FROM deduped ORDER BY numero_operacion NULLS FIRST LIMIT 100"
ORACLES["profile_nulls"] = f"WITH {OPS_CTE}\n" + "\nUNION ALL ".join(
    f"SELECT {q(c)} AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM ops" for c in S.OPS_COLUMNS)
ORACLES["profile_totals"] = f"""WITH {OPS_CTE}
SELECT count(*) AS total_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(S.OPS_COLUMNS)} FROM ops)) AS duplicate_rows,
       coalesce({_sum2('monto')}::DOUBLE, 0.0) AS total_amount,
       {_sum2('monto')}::DOUBLE / nullif(count(monto), 0) AS mean_amount
FROM ops"""


def _value_counts(cols, src: str, share: bool) -> str:
    parts = []
    for c in cols:
        s = f", count(*) / (SELECT count(*) FROM {src}) AS share" if share else ""
        parts.append(f"SELECT {q(c)} AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count{s} "
                     f"FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}")
    return "\nUNION ALL ".join(parts)


ORACLES["value_counts"] = f"WITH {OPS_CTE}\n" + _value_counts(["tipo_operacion", "estado", "moneda"], "ops", False)
ORACLES["value_counts_share"] = f"WITH {OPS_CTE}\n" + _value_counts(["tipo_operacion", "estado", "moneda"], "ops",
                                                                     True)
ORACLES["value_counts_events"] = _value_counts(["event_type"], "events", True)
ORACLES["union_all"] = f"""WITH {OPS_CTE},
u AS (SELECT * FROM ops UNION ALL SELECT * FROM ops WHERE l_linenumber = 1)
SELECT numero_operacion, count(*) AS copies FROM u GROUP BY numero_operacion"""

# ---- upsert --------------------------------------------------------------------------------------
_NORM_COLS = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
              "try_cast(fecha_operacion AS TIMESTAMP) AS fecha_operacion, numero_operacion, tipo_operacion, monto, "
              "moneda, substr(cuenta_origen, 1, 50) AS cuenta_origen, "
              "nullif(substr(cuenta_destino, 1, 50), '') AS cuenta_destino, substr(banco_origen, 1, 50) AS banco_origen, "
              "nullif(substr(banco_destino, 1, 50), '') AS banco_destino, substr(descripcion, 1, 500) AS descripcion, "
              "estado, canal")
TARGET_COLS = ["fecha_operacion", "numero_operacion", "tipo_operacion", "monto", "moneda", "cuenta_origen",
               "cuenta_destino", "banco_origen", "banco_destino", "descripcion", "estado", "canal", "content_hash",
               "fecha_carga", "is_duplicate"]
UPSERT_BASE = f"""WITH {OPS_CTE},
base AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY numero_operacion ORDER BY {ORDER_SQL})
         AS rn FROM ops WHERE numero_operacion IS NOT NULL) WHERE rn = 1),
norm AS (SELECT {_NORM_COLS} FROM base),
tgt AS (SELECT l_orderkey * 10 + l_linenumber AS id, * EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_quantity), {_hash_expr()} AS content_hash, TIMESTAMP '2000-06-01 00:00:00' AS fecha_carga,
               CAST(0 AS INTEGER) AS is_duplicate
        FROM norm WHERE l_orderkey % 3 <> 0),
bat0 AS (SELECT * REPLACE (monto + 1 AS monto) FROM norm WHERE l_orderkey % 3 <> 1),
bat AS (SELECT *, {_hash_expr()} AS content_hash, CAST(0 AS INTEGER) AS is_duplicate FROM bat0),
merged AS (
  SELECT CASE WHEN t.numero_operacion IS NOT NULL THEN t.id END AS id,
         coalesce(t.numero_operacion, s.numero_operacion) AS numero_operacion,
""" + ",\n".join(
    f"         CASE WHEN s.numero_operacion IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
    for c in TARGET_COLS if c not in ("numero_operacion", "fecha_carga", "is_duplicate")) + f""",
         CASE WHEN s.numero_operacion IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t.fecha_carga END AS fecha_carga,
         CASE WHEN t.numero_operacion IS NOT NULL THEN t.is_duplicate ELSE s.is_duplicate END AS is_duplicate,
         CASE WHEN t.numero_operacion IS NOT NULL AND s.numero_operacion IS NOT NULL THEN 'updated'
              WHEN s.numero_operacion IS NOT NULL THEN 'inserted' ELSE 'kept' END AS action
  FROM tgt t FULL OUTER JOIN bat s ON t.numero_operacion = s.numero_operacion)
"""
ORACLES["upsert_merge"] = UPSERT_BASE + "SELECT * EXCLUDE (id) FROM merged"
ORACLES["upsert_merge_shuffle"] = ORACLES["upsert_merge"]
ORACLES["upsert_merge_keyed"] = ORACLES["upsert_merge"]
ORACLES["upsert_counts"] = UPSERT_BASE + """SELECT CAST(count_if(action = 'kept') AS BIGINT) AS rows_kept,
  CAST(count_if(action = 'inserted') AS BIGINT) AS rows_inserted,
  CAST(count_if(action = 'updated') AS BIGINT) AS rows_updated FROM merged"""
ORACLES["load_stats"] = UPSERT_BASE + """SELECT CAST(count_if(action = 'inserted') AS BIGINT) AS rows_inserted,
  CAST(count_if(action = 'updated') AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_failed,
  CAST(count_if(action <> 'kept') AS BIGINT) AS total_processed FROM merged"""
ORACLES["upsert_total"] = UPSERT_BASE + f"""SELECT {_sum2('monto')}::DOUBLE AS total_amount, count(*) AS total_rows
FROM merged"""
ORACLES["assert_unique_key"] = UPSERT_BASE + """SELECT numero_operacion, count(*) AS n FROM merged
GROUP BY numero_operacion HAVING count(*) > 1"""
ORACLES["append_new"] = UPSERT_BASE + f"""SELECT {', '.join(c for c in TARGET_COLS if c not in ('fecha_carga',))},
  TIMESTAMP '{AS_OF}' AS fecha_carga
FROM bat WHERE numero_operacion NOT IN (SELECT numero_operacion FROM tgt)"""
ORACLES["join_semi_existing"] = UPSERT_BASE + """SELECT * FROM bat
WHERE numero_operacion IN (SELECT numero_operacion FROM tgt)"""
ORACLES["join_anti_new"] = UPSERT_BASE + """SELECT * FROM bat
WHERE numero_operacion NOT IN (SELECT numero_operacion FROM tgt)"""
ORACLES["normalize_load"] = f"WITH {OPS_CTE}\nSELECT {_NORM_COLS} FROM ops"

# ---- run history ---------------------------------------------------------------------------------
RUNS_BASE = f"""{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED},\n{fails_cte()},
base AS (SELECT l_linenumber, count(*) AS input_rows, CAST(count_if(nfail = 0) AS BIGINT) AS validation_passed,
                CAST(count_if(nfail > 0) AS BIGINT) AS validation_failed FROM scored GROUP BY l_linenumber),
dup AS (SELECT l_linenumber, CAST(sum(n) - count(*) AS BIGINT) AS duplicates_found, count(*) AS rows_loaded
        FROM (SELECT l_linenumber, content_hash, count(*) AS n FROM hashed GROUP BY ALL) GROUP BY l_linenumber),
nerr AS (SELECT l_linenumber, CAST(least(count(*), 100) AS INTEGER) AS n_errors FROM fails GROUP BY l_linenumber),
runs AS (
  SELECT 'etl_batch_' || CAST(b.l_linenumber AS VARCHAR) AS pipeline_id,
         TIMESTAMP '{AS_OF}' + to_hours(CAST(b.l_linenumber AS BIGINT)) AS start_time,
         TIMESTAMP '{AS_OF}' + to_hours(CAST(b.l_linenumber AS BIGINT)) + to_microseconds(input_rows * 1000) AS end_time,
         'l_linenumber=' || CAST(b.l_linenumber AS VARCHAR) AS input_file,
         input_rows, validation_passed, validation_failed,
         coalesce(duplicates_found, 0) AS duplicates_found, coalesce(duplicates_found, 0) AS duplicates_removed,
         coalesce(rows_loaded, 0) AS rows_loaded, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS load_failed,
         (input_rows * 1000) / 1000000.0 AS processing_time_seconds,
         CASE WHEN validation_failed > validation_passed THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN validation_failed > validation_passed THEN 'validation rejected most rows' ELSE '' END
           AS error_message,
         coalesce(n_errors, 0) AS n_errors
  FROM base b LEFT JOIN dup d ON b.l_linenumber = d.l_linenumber LEFT JOIN nerr e ON b.l_linenumber = e.l_linenumber)
"""
_RUN_SCALARS = ("pipeline_id, start_time, end_time, input_file, input_rows, validation_passed, validation_failed, "
                "duplicates_found, duplicates_removed, rows_loaded, rows_updated, load_failed, "
                "processing_time_seconds, status, error_message, n_errors")
ORACLES["run_duration"] = RUNS_BASE + "SELECT pipeline_id, start_time, end_time, processing_time_seconds FROM runs"
ORACLES["run_summary"] = RUNS_BASE + """SELECT pipeline_id, status, input_rows AS total_input,
  rows_loaded AS total_loaded,
  printf('%.2f%%', CASE WHEN input_rows = 0 THEN 0.0 ELSE rows_loaded / input_rows END * 100.0) AS success_rate,
  duplicates_removed, n_errors AS validation_errors, printf('%.2fs', processing_time_seconds) AS processing_time,
  rows_loaded + rows_updated AS rows_written
FROM runs"""
ORACLES["history_stats"] = RUNS_BASE + """SELECT count(*) AS total_runs,
  CAST(count_if(status = 'success') AS BIGINT) AS successful_runs,
  printf('%.2f%%', count_if(status = 'success') / count(*) * 100.0) AS success_rate,
  CAST(sum(input_rows) AS BIGINT) AS total_rows_processed, CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded,
  printf('%.2fs', avg(processing_time_seconds)) AS avg_processing_time, max(start_time) AS last_run
FROM runs HAVING count(*) > 0"""
ORACLES["run_history"] = RUNS_BASE + f"SELECT {_RUN_SCALARS} FROM runs"
ORACLES["write_run_record"] = ORACLES["run_history"]
ORACLES["run_by_id"] = RUNS_BASE + f"SELECT {_RUN_SCALARS} FROM runs WHERE pipeline_id = 'etl_batch_3'"
_KPI_VALUES = ["CAST(input_rows AS VARCHAR)", "CAST(validation_passed AS VARCHAR)",
               "CAST(validation_failed AS VARCHAR)", "CAST(duplicates_removed AS VARCHAR)",
               "CAST(rows_loaded AS VARCHAR)",
               "printf('%.2f%%', rows_loaded / greatest(coalesce(input_rows, 1), 1) * 100.0)",
               "printf('%.2fs', coalesce(processing_time_seconds, 0.0))"]
ORACLES["report_kpis"] = RUNS_BASE + "\nUNION ALL ".join(
    f"SELECT pipeline_id, {i + 1} AS position, {q(lbl)} AS label, {v} AS value FROM runs"
    for i, (lbl, v) in enumerate(zip(S.KPI_LABELS, _KPI_VALUES)))
ORACLES["report_kpis_text"] = RUNS_BASE + "\nUNION ALL ".join(
    f"SELECT pipeline_id, {i + 1} AS position, {q(lbl)} AS label, "
    + (v.replace("CAST(", "format('{:,}', ").replace(" AS VARCHAR)", ")") if v.startswith("CAST(") else v) + " AS value FROM runs"
    for i, (lbl, v) in enumerate(zip(S.KPI_LABELS, _KPI_VALUES)))
ORACLES["report_distribution"] = RUNS_BASE + "\nUNION ALL ".join(
    f"SELECT pipeline_id, {q(lbl)} AS category, CAST({v} AS BIGINT) AS count FROM runs"
    for lbl, v in zip(S.DISTRIBUTION_LABELS, ["validation_passed", "validation_failed", "duplicates_removed",
                                               "rows_loaded"]))
ORACLES["stage_funnel"] = f"""{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED},
c AS (SELECT (SELECT count(*) FROM scored) AS input, (SELECT count(*) FROM scored WHERE nfail = 0) AS valid,
             (SELECT count(*) FROM scored WHERE nfail > 0) AS invalid,
             (SELECT count(*) FROM hashed) - (SELECT count(DISTINCT content_hash) FROM hashed) AS duplicates,
             (SELECT count(DISTINCT content_hash) FROM hashed) AS loaded)
SELECT 1 AS position, 'input' AS stage, CAST(input AS BIGINT) AS rows FROM c
UNION ALL SELECT 2, 'valid', CAST(valid AS BIGINT) FROM c
UNION ALL SELECT 3, 'invalid', CAST(invalid AS BIGINT) FROM c
UNION ALL SELECT 4, 'duplicates', CAST(duplicates AS BIGINT) FROM c
UNION ALL SELECT 5, 'loaded', CAST(loaded AS BIGINT) FROM c"""

# ---- CSV, generator, whole job -------------------------------------------------------------------
_OPS_ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"] + S.OPS_COLUMNS
ORACLES["scan_csv"] = f"WITH {OPS_CTE}\nSELECT " + ", ".join(
    f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in _OPS_ALL) + " FROM ops"
ORACLES["csv_row_index"] = """SELECT count(*) AS rows, count(*) AS distinct_rows, CAST(0 AS BIGINT) AS first_row,
  count(*) - 1 AS last_row FROM lineitem"""
ORACLES["parse_dates_lenient"] = f"WITH {OPS_CTE}\nSELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {TS} AS " \
    "fecha_operacion, monto, l_quantity FROM ops"
ORACLES["write_csv_roundtrip"] = PIPE + "SELECT * REPLACE (nullif(banco_destino, '') AS banco_destino) FROM deduped"
ORACLES["pipeline_final_rows"] = PIPE + f"""SELECT fecha_operacion, numero_operacion, tipo_operacion, monto, moneda,
  substr(cuenta_origen, 1, 50) AS cuenta_origen, nullif(substr(cuenta_destino, 1, 50), '') AS cuenta_destino,
  substr(banco_origen, 1, 50) AS banco_origen, nullif(substr(banco_destino, 1, 50), '') AS banco_destino,
  substr(descripcion, 1, 500) AS descripcion, estado, canal, content_hash,
  TIMESTAMP '{AS_OF}' AS fecha_carga, CAST(0 AS INTEGER) AS is_duplicate
FROM deduped"""


ORACLES["target_schema"] = ORACLES["pipeline_final_rows"]
ORACLES["exact_duplicates"] = f"""WITH {OPS_CTE}
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(S.OPS_COLUMNS)} FROM ops)) AS duplicates FROM ops"""
ORACLES["report_header"] = RUNS_BASE + "SELECT pipeline_id, start_time, upper(status) AS status FROM runs"
ORACLES["parquet_row_index"] = ORACLES["csv_row_index"]
ORACLES["pipeline_parquet_rows"] = ORACLES["pipeline_final_rows"]

# ---- planted rows: copies, rows with the same hash, malformed accounts, amounts over the cap --------------
_PLANTED_SCORED = f"scored AS (SELECT *, {nfail_expr('FALSE')} AS nfail FROM ops)"


def _planted(sql: str) -> str:
    """The same SQL over the planted operations, without the uniqueness rule."""
    return sql.replace(OPS_CTE, PLANTED_CTE).replace(SCORED, _PLANTED_SCORED)


for _k in ["rule_max_amount", "rule_regex_account", "dedup_hash", "distinct_rows", "profile_totals", "exact_duplicates",
           "stage_funnel"]:
    ORACLES[_k] = _planted(ORACLES[_k])


def _by_key(sql: str) -> str:
    """The job over the planted operations: the first row of each operation id stays."""
    return _planted(sql).replace("PARTITION BY content_hash", "PARTITION BY numero_operacion")


ORACLES["pipeline_final_rows"] = ORACLES["pipeline_parquet_rows"] = _by_key(ORACLES["pipeline_final_rows"])
ORACLES["quick_validate"] = _planted(f"""{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED}
SELECT numero_operacion, count(*) - 1 AS duplicates, count(*) AS rows, count(DISTINCT content_hash) AS hashes
FROM hashed GROUP BY numero_operacion""")
ORACLES["quick_validate_summary"] = _planted(ORACLES["validation_summary"])
ORACLES["find_duplicates_sorted"] = _planted(ORACLES["find_duplicates"])
ORACLES["dedup_priority_sorted"] = ORACLES["dedup_priority_desc"]
ORACLES["assert_unique_key"] = f"""WITH {PLANTED_CTE}
SELECT numero_operacion, count(*) AS n FROM ops GROUP BY numero_operacion HAVING count(*) > 1"""
ORACLES["pipeline_csv_copy"] = _by_key(PIPE) + f"""SELECT {', '.join(
    "nullif(banco_destino, '') AS banco_destino" if c == 'banco_destino' else c for c in S.OPS_COLUMNS)}, content_hash FROM deduped"""
ORACLES["pipeline_warnings"] = _planted(ORACLES["validation_warnings"])
ORACLES["target_keys"] = UPSERT_BASE + """SELECT numero_operacion FROM merged
WHERE fecha_operacion IS NOT NULL AND cuenta_origen IS NOT NULL"""
ORACLES["parse_dates_voted"] = """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%m/%d/%Y')
             WHEN 7 THEN 'no date' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS t FROM lineitem),
read AS (SELECT *, try_strptime(t, '%Y-%m-%d') AS d1, try_strptime(t, '%d/%m/%Y') AS d2, try_strptime(t, '%m/%d/%Y') AS d3 FROM v),
votes AS (SELECT 1 AS place, count(d1) AS votes FROM read UNION ALL SELECT 2, count(d2) FROM read UNION ALL SELECT 3, count(d3) FROM read),
best AS (SELECT place FROM votes ORDER BY votes DESC, place LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey, CASE place WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS fecha FROM read, best"""
_WHOLE = "fecha_operacion IS NOT NULL AND cuenta_origen IS NOT NULL"      # required columns
ORACLES["target_merge"] = ORACLES["target_merge_bucketed"] = UPSERT_BASE + f"SELECT * EXCLUDE (id, action) FROM merged WHERE {_WHOLE}"
ORACLES["target_append"] = UPSERT_BASE + f"""SELECT {', '.join(TARGET_COLS)} FROM tgt WHERE {_WHOLE}
UNION ALL SELECT {', '.join(c for c in TARGET_COLS).replace('fecha_carga', f"TIMESTAMP '{AS_OF}' AS fecha_carga")} FROM bat
WHERE {_WHOLE} AND numero_operacion NOT IN (SELECT numero_operacion FROM tgt WHERE {_WHOLE})"""
ORACLES["target_reset"] = UPSERT_BASE + f"""SELECT {', '.join(TARGET_COLS).replace('fecha_carga', f"TIMESTAMP '{AS_OF}' AS fecha_carga")}
FROM bat WHERE {_WHOLE}"""
ORACLES["value_edges"] = """
WITH v AS (SELECT l_linenumber, CAST(l_extendedprice * 1e4 AS VARCHAR) AS large, l_linenumber / 8192.0::DOUBLE AS small,
                  l_partkey % 3 = 0 AS suffixed FROM lineitem)
SELECT l_linenumber, CAST(min(length(large)) AS INTEGER) AS shortest_text, CAST(count_if(large LIKE '%e%') AS BIGINT) AS with_exponent,
       max(CAST(small AS VARCHAR)) AS small_text, CAST(count_if(NOT suffixed) AS BIGINT) AS numbers,
       sum(CAST(small AS DECIMAL(38,10)))::DOUBLE AS small_total
FROM v GROUP BY l_linenumber"""

# ---- the default rules, uniqueness included, and dedup by hash over the planted operations ----------------
ORACLES["pipeline_default_rows"] = ORACLES["pipeline_default_parquet_rows"] = ORACLES["target_schema"].replace(OPS_CTE, PLANTED_CTE)
ORACLES["quick_validate_default"] = f"""{WITH_BASE},\n{SCORED},\n{VALID},\n{HASHED},
ranked2 AS (SELECT *, row_number() OVER (PARTITION BY numero_operacion ORDER BY {ORDER_SQL}) AS rn FROM hashed)
SELECT numero_operacion, fecha_operacion, monto, rn > 1 AS is_duplicate, content_hash FROM ranked2""".replace(OPS_CTE, PLANTED_CTE)
