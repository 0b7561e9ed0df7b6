"""The ``ops`` fixture: operation records planted over ``lineitem``.

One list of (expression, name) pairs feeds both Spark (``selectExpr``) and the SQL oracle
(``OPS_CTE``), so both engines read the very same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.tables import table

AS_OF = "2001-01-01 00:00:00"

# Row order for keep-first: ascending, nulls first; free of ties at every scale factor.
ORDER_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "fecha_operacion", "monto", "l_quantity"]

OPS_EXPRS = [
    ("cast(l_orderkey as bigint)", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_partkey", "l_partkey"),
    ("l_suppkey", "l_suppkey"),
    ("l_quantity", "l_quantity"),
    ("CASE WHEN l_quantity = 47 AND l_linenumber = 5 THEN 'FECHA_INVALIDA' "
     "ELSE cast(l_shipdate as string) END", "fecha_operacion"),
    ("CASE WHEN l_quantity = 50 AND l_linenumber = 7 THEN NULL "
     "WHEN l_quantity = 49 AND l_linenumber = 7 THEN 'BAD' || cast(l_orderkey as string) "
     "ELSE 'OP-' || lpad(cast(l_orderkey * 10 + l_linenumber as string), 8, '0') END", "numero_operacion"),
    ("CASE l_returnflag WHEN 'A' THEN 'DEPOSITO' WHEN 'R' THEN 'RETIRO' ELSE 'TRANSFERENCIA' END",
     "tipo_operacion"),
    ("CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN -l_extendedprice ELSE l_extendedprice END", "monto"),
    ("CASE WHEN l_linestatus = 'O' THEN 'PEN' ELSE 'USD' END", "moneda"),
    ("CASE WHEN l_quantity = 48 AND l_linenumber = 6 THEN NULL "
     "ELSE lpad(cast(100 + l_suppkey % 900 as string), 3, '0') || '-' || lpad(cast(l_partkey as string), 7, '0') "
     "|| '-' || cast(l_linenumber % 10 as string) || '-' || lpad(cast(l_orderkey % 100 as string), 2, '0') END",
     "cuenta_origen"),
    ("CASE WHEN l_orderkey % 10 < 3 THEN NULL "
     "ELSE '191-' || lpad(cast(l_suppkey as string), 7, '0') || '-0-89' END", "cuenta_destino"),
    ("CASE l_suppkey % 4 WHEN 0 THEN 'BCP' WHEN 1 THEN 'BBVA' WHEN 2 THEN 'INTERBANK' ELSE 'BN' END",
     "banco_origen"),
    ("CASE WHEN l_partkey % 10 < 3 THEN NULL WHEN l_partkey % 10 = 3 THEN '' ELSE 'RIPLEY' END", "banco_destino"),
    ("'mov ' || cast(l_partkey as string)", "descripcion"),
    ("CASE WHEN l_discount = 0.09 AND l_tax = 0.07 THEN 'ESTADO_DESCONOCIDO' "
     "WHEN l_quantity <= 42 THEN 'COMPLETADA' WHEN l_quantity <= 47 THEN 'PENDIENTE' ELSE 'FALLIDA' END",
     "estado"),
    ("CASE l_partkey % 4 WHEN 0 THEN 'WEB' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'ATM' ELSE 'SUCURSAL' END", "canal"),
]

OPS_SELECT = "SELECT\n  " + ",\n  ".join(f"{e} AS {n}" for e, n in OPS_EXPRS) + "\nFROM lineitem"
OPS_CTE = f"ops AS (\n{OPS_SELECT}\n)"


# Planted rows: added copies and faults, so that dedup, caps and formats have something to find.
# (rows of ops to take, columns to replace)
PLANTS = [
    ("l_orderkey % 40 = 7", {}),                                                         # exact copies
    ("l_orderkey % 40 = 9", {"l_quantity": "l_quantity + 1000", "descripcion": "'copia'", "canal": "'ATM'"}),   # same hash
    ("l_orderkey % 40 = 11", {"numero_operacion": "'OP-' || lpad(cast(l_orderkey * 10 + l_linenumber + 50000000 as string), 8, '0')",
                              "cuenta_origen": "'12-34'"}),
    ("l_orderkey % 40 = 13", {"numero_operacion": "'OP-' || lpad(cast(l_orderkey * 10 + l_linenumber + 60000000 as string), 8, '0')",
                              "monto": "abs(monto) + 1000000"}),
]
_COLUMNS = [n for _, n in OPS_EXPRS]
PLANTED_CTE = OPS_CTE.replace("ops AS (", "ops0 AS (", 1) + ",\nops AS (\nSELECT * FROM ops0\n" + "\n".join(
    f"UNION ALL SELECT {', '.join(f'{new[c]} AS {c}' if c in new else c for c in _COLUMNS)} FROM ops0 WHERE {where}"
    for where, new in PLANTS) + ")"


def ops_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ops`` with the planted rows."""
    base = ops(spark, sf_dir)
    out = base
    for where, new in PLANTS:
        out = out.unionByName(base.filter(where).selectExpr(*[f"{new[c]} AS {c}" if c in new else c for c in _COLUMNS]))
    return out


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw (untyped date) operation records, one per lineitem row."""
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for e, n in OPS_EXPRS])
