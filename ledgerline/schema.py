"""Schemas and fixed values of the operation-record model.

The values under "Fixed values" must stay exactly as they are: they are the column names,
allowed values, patterns and failure texts the reconciled records and reports are matched on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference model for identical results)
# ---------------------------------------------------------------------------------------------
OPS_COLUMNS = [
    "fecha_operacion", "numero_operacion", "tipo_operacion", "monto", "moneda",
    "cuenta_origen", "cuenta_destino", "banco_origen", "banco_destino", "descripcion",
    "estado", "canal",
]
KEY_COLUMN = "numero_operacion"
DATE_COLUMN = "fecha_operacion"
AMOUNT_COLUMN = "monto"
HASH_COLUMN = "content_hash"
HASH_SOURCE_COLUMNS = ["numero_operacion", "monto", "fecha_operacion", "cuenta_origen"]
HASH_LENGTH = 16

TIPO_VALUES = ["DEPOSITO", "RETIRO", "TRANSFERENCIA"]
MONEDA_VALUES = ["PEN", "USD"]
ESTADO_VALUES = ["COMPLETADA", "PENDIENTE", "FALLIDA"]
CANAL_VALUES = ["WEB", "MOBILE", "ATM", "SUCURSAL"]
BANKS = ["BCP", "BBVA", "INTERBANK", "SCOTIABANK", "BANBIF", "PICHINCHA", "BN", "FALABELLA",
         "RIPLEY", "CITIBANK"]

OP_ID_PATTERN = "^OP-[0-9]{8}$"
ACCOUNT_PATTERN = "^[0-9]{3}-[0-9]{7}-[0-9]-[0-9]{2}$"
MAX_AMOUNT = 1_000_000
CHECKSUM_TOLERANCE = 0.01

MSG_FUTURE_DATE = "Future dates not allowed"
MSG_OP_ID_FORMAT = "Invalid operation ID format"
MSG_AMOUNT_POSITIVE = "Amount must be positive"
MSG_AMOUNT_MAX = "Amount exceeds maximum limit"
MSG_ACCOUNT_FORMAT = "Invalid account format"
MSG_NOT_NULL = "not_nullable"
MSG_UNIQUE = "field_uniqueness"
MSG_MISSING_COLUMN = "column_in_dataframe"
MSG_MALFORMED_ROW = "malformed_row"
COERCE_DTYPE_NAMES = {"timestamp": "datetime64[ns]", "double": "float64", "long": "int64", "string": "str"}

# pandas' default tokens read back as missing from CSV text
CSV_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                   "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Load normaliser column lengths
DESCRIPTION_MAX = 500
BANK_ACCOUNT_MAX = 50

# Report labels (KPI and distribution tables)
KPI_LABELS = ["Total Registros Entrada", "Registros Validados", "Registros Inválidos",
              "Duplicados Removidos", "Registros Cargados", "Tasa de Éxito", "Tiempo de Procesamiento"]
DISTRIBUTION_LABELS = ["Validados", "Inválidos", "Duplicados", "Cargados"]
# ---------------------------------------------------------------------------------------------


def isin_message(values: list[str]) -> str:
    return "isin(" + repr(list(values)) + ")"


def coerce_message(kind: str) -> str:
    return "coerce_dtype('" + COERCE_DTYPE_NAMES[kind] + "')"


SPARK_TYPES = {
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "string": T.StringType(),
}

# Target table: one row per business key; id is a surrogate, fecha_carga the load stamp.
TARGET_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("fecha_operacion", T.TimestampType(), False),
    T.StructField("numero_operacion", T.StringType(), False),
    T.StructField("tipo_operacion", T.StringType(), False),
    T.StructField("monto", T.DoubleType(), False),
    T.StructField("moneda", T.StringType(), False),
    T.StructField("cuenta_origen", T.StringType(), False),
    T.StructField("cuenta_destino", T.StringType(), True),
    T.StructField("banco_origen", T.StringType(), False),
    T.StructField("banco_destino", T.StringType(), True),
    T.StructField("descripcion", T.StringType(), True),
    T.StructField("estado", T.StringType(), False),
    T.StructField("canal", T.StringType(), False),
    T.StructField("content_hash", T.StringType(), True),
    T.StructField("fecha_carga", T.TimestampType(), True),
    T.StructField("is_duplicate", T.IntegerType(), True),
])
FAILURE_STRUCT = T.StructType([
    T.StructField("row", T.LongType(), True),
    T.StructField("column", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])

RUN_SCHEMA = T.StructType([
    T.StructField("pipeline_id", T.StringType(), True),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("input_file", T.StringType(), True),
    T.StructField("input_rows", T.LongType(), True),
    T.StructField("validation_passed", T.LongType(), True),
    T.StructField("validation_failed", T.LongType(), True),
    T.StructField("validation_errors", T.ArrayType(FAILURE_STRUCT), True),
    T.StructField("duplicates_found", T.LongType(), True),
    T.StructField("duplicates_removed", T.LongType(), True),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("rows_updated", T.LongType(), True),
    T.StructField("load_failed", T.LongType(), True),
    T.StructField("processing_time_seconds", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("warnings", T.ArrayType(T.StringType()), True),
])
RUN_SCHEMA_READ = T.StructType(RUN_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
