"""External database read/write through Spark's JDBC source (K10), and the staged load (K6).

Equality filters and column selections on the returned frame are pushed into the database query
by Spark; writes go out in parallel batches with the target column types stated. A staged load writes the batch to a
table of its own, in parallel; then one MERGE inside the database, in one transaction, updates matched rows and
inserts the others, and the stage is dropped, also when the merge fails.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

# Column types for CREATE TABLE on the database side (lengths are the target's column limits)
TARGET_DDL_TYPES = ("numero_operacion VARCHAR(20), tipo_operacion VARCHAR(20), moneda VARCHAR(3), "
                    "cuenta_origen VARCHAR(50), cuenta_destino VARCHAR(50), banco_origen VARCHAR(50), "
                    "banco_destino VARCHAR(50), descripcion VARCHAR(500), estado VARCHAR(20), canal VARCHAR(20), "
                    "content_hash VARCHAR(32)")


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, predicates: list[str] | None = None,
               single_task: bool = False) -> DataFrame:
    """Read a database table in several tasks: by ranges of a numeric column, or by given predicates.

    The ranges need bounds and a number of partitions, or the whole table would come through one
    task; that must be asked for with ``single_task``.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties or {}))
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partition column needs lower, upper and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    elif not single_task:
        raise ValueError("give a partition column with bounds, predicates, or single_task=True")
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
                column_types: str | None = TARGET_DDL_TYPES, batch_size: int = 10_000) -> None:
    """Write a frame to a database table (created with ``column_types`` when absent)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if column_types:
        present = {c.split()[0] for c in column_types.split(", ")}
        usable = ", ".join(c for c in column_types.split(", ") if c.split()[0] in set(df.columns) & present)
        if usable:
            writer = writer.option("createTableColumnTypes", usable)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()


@contextlib.contextmanager
def _connection(spark: SparkSession, url: str, properties: dict):
    """A connection of the driver process; committed at the end of the block, rolled back if it fails."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    name = properties.get("driver") or jvm.java.sql.DriverManager.getDriver(url).getClass().getName()
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    connection = loader.loadClass(name).getDeclaredConstructor(None).newInstance(None).connect(url, props)
    connection.setAutoCommit(False)
    try:
        yield connection
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(connection, sql: str, query: bool = False) -> int:
    """Rows that a statement changed, or the one number that a query gives."""
    statement = connection.createStatement()
    try:
        if not query:
            return statement.executeUpdate(sql)
        result = statement.executeQuery(sql)
        result.next()
        return result.getInt(1)
    finally:
        statement.close()


def merge_sql(table: str, stage: str, columns: list[str], key: str, updated: list[str], quote: str = '"') -> str:
    """One MERGE of a stage into a table: matched rows take the updated columns, others are inserted."""
    def q(c):
        return f"{quote}{c}{quote}"
    return (f"MERGE INTO {table} AS t USING {stage} AS s ON t.{q(key)} = s.{q(key)} "
            f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{q(c)} = s.{q(c)}' for c in updated)} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, columns))}) VALUES ({', '.join(f's.{q(c)}' for c in columns)})")


def merge_table(df: DataFrame, url: str, table: str, key: str, properties: dict | None = None, updated: list[str] | None = None,
                column_types: str | None = TARGET_DDL_TYPES, batch_size: int = 10_000, quote: str = '"') -> dict:
    """K6: upsert a frame into a database table by key; returns {"inserted", "updated"}.

    ``updated``: the columns that matched rows take (all but the key). Keys must not repeat in the frame: the database refuses
    the merge then, as it does for a row that breaks a constraint, and the table is as before.
    """
    properties, spark = dict(properties or {}), df.sparkSession
    stage = f"stage_{uuid.uuid4().hex[:12]}"
    columns = df.columns
    sql = merge_sql(table, stage, columns, key, [c for c in columns if c != key] if updated is None else updated, quote)
    try:
        write_table(df, url, stage, "errorifexists", properties, column_types, batch_size)
        with _connection(spark, url, properties) as connection:
            both = f"SELECT count(*) FROM {table} t JOIN {stage} s ON t.{quote}{key}{quote} = s.{quote}{key}{quote}"
            matched, total = _execute(connection, both, query=True), _execute(connection, f"SELECT count(*) FROM {stage}", query=True)
            _execute(connection, sql)
        return {"inserted": total - matched, "updated": matched}
    finally:
        with contextlib.suppress(Exception), _connection(spark, url, properties) as connection:     # there may be none
            _execute(connection, f"DROP TABLE {stage}")
