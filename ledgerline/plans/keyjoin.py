"""Attach per-key statistics back to rows without a hot partition.

Per-key facts (group size, first row of a group) are computed with a hash aggregate: partial
aggregation on the map side shrinks a hot key to one row per input partition before the
shuffle, so one key holding a third of all rows costs nothing extra there. The small per-key
table is written as parquet to the shared checkpoint folder (cuts lineage, survives executor
loss), its real byte size is observed during that write, and only then is it broadcast. Above the limit the rows are shuffled
and meet a hash table of their partition's keys: rows are not sorted, so they do not spill. AQE's skew-join split cuts a hot
key's row partition into pieces.

Rows that several steps meet by one key are stored dealt by it (``materialize_by``): a bucketed table, so that aggregates, joins and
windows over that key read it bucket by bucket and shuffle nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import broadcast_limit, bytes_of, scratch_path


ROW_GROUP = 4 << 20      # small row groups: a table that one task wrote can be read by several
HASHED = 16 << 20        # measured bytes of a shuffle partition that may become a hash table in memory
BUCKET_INPUT = 16 << 20  # bytes of input files that a bucket of a dealt table is meant to hold
DEALT_FILES = 20_000     # files of a dealt table: each task writes one for each bucket
SKEWED, SKEWED_ROWS = 4, 1_000_000     # a bucket of so many times the mean, and so many rows, holds a hot key


class Stored(NamedTuple):
    """A stored table, its rows and bytes, and whether it is dealt by a key."""
    frame: DataFrame
    rows: int
    bytes: int
    dealt: bool = False


def _width(field: T.StructField) -> Column:
    dt = field.dataType
    c = F.col(f"`{field.name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + F.lit(8)
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long") + F.lit(16)
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    return F.lit(fixed.get(type(dt), 8) + 1).cast("long")


def observed(obs: Observation, **empty) -> dict:
    """Metrics of an observed write; ``empty`` where the optimizer proved the plan empty and dropped them."""
    try:
        return obs.get
    except Py4JJavaError:
        return empty


def materialize(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Returns (frame, rows, bytes). Rows and an in-memory byte size are observed on the write job
    itself (one pass); the written files cut the lineage, so later stages and retries read them
    instead of recomputing the input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    sized, obs = _sized(df)
    sized.write.mode("errorifexists").option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(path)
    m = obs.get
    return spark.read.schema(df.schema).parquet(path), int(m["n"]), int(m["b"])


def _sized(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with an observation of its rows and bytes."""
    widths = [_width(f) for f in df.schema.fields] or [F.lit(1).cast("long")]
    obs = Observation(f"size_{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(reduce(lambda a, b: a + b, widths)), F.lit(0)).alias("b")), obs


def _tasks(df: DataFrame) -> int:
    """About as many tasks as read the files of a plan."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return spark.sparkContext.defaultParallelism + read // bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def bucket_count(df: DataFrame) -> int:
    """Buckets to deal the rows of a frame into; 0 where its many tasks would write too many files."""
    spark, tasks = df.sparkSession, _tasks(df)
    cores, most = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    buckets = min(most, max(cores, (tasks - cores) * split // BUCKET_INPUT), DEALT_FILES // tasks)
    return buckets if buckets >= min(most, cores) else 0


def materialize_by(df: DataFrame, key: str, buckets: int | None = None, unique: bool = False) -> Stored:
    """``materialize``, the rows dealt by ``key``: read back as a table bucketed by it, which steps by that key don't shuffle.

    A task writes its rows of each bucket to a file of their own, so nothing is shuffled here either. Rows stay undealt where that
    would make too many files or a column is nested, and are read as undealt where one bucket holds a hot key (looked for unless the
    keys are ``unique``): shuffles spread those better.
    """
    spark = df.sparkSession
    plain = (key in df.columns and all(isinstance(f.dataType, T.AtomicType) for f in df.schema.fields)
             and not any(set(",:;`") & set(c) for c in df.columns))
    buckets = bucket_count(df) if buckets is None or _tasks(df) * buckets > DEALT_FILES else buckets
    if not (plain and buckets):
        return Stored(*materialize(df))
    path, name = scratch_path(spark, "keys"), f"ledgerline_dealt_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd', 'parquet.block.size' '{ROW_GROUP}') "
              f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        sized, obs = _sized(df)
        sized.write.insertInto(name)
        rows = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")            # the files stay: they are scratch, and the frame knows its buckets
    m = obs.get
    stored = Stored(rows, int(m["n"]), int(m["b"]), True)
    if not unique and stored.rows >= SKEWED_ROWS:
        files = spark.read.schema(df.schema).parquet(path)
        sizes = files.groupBy(F.regexp_extract("_metadata.file_name", r"_(\d+)\.c\d+", 1)).agg(F.count(F.lit(1)).alias("n"))
        if sizes.agg(F.max("n")).first()[0] > max(SKEWED_ROWS, SKEWED * stored.rows / buckets):
            return Stored(files, stored.rows, stored.bytes)
    return stored


def hashable(df: DataFrame, nbytes: int) -> DataFrame:
    """A measured side of a shuffle join: hashed by partition if its partitions are small, else sorted."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if nbytes <= parts * HASHED else df


def sized_side(df: DataFrame) -> tuple[DataFrame, bool]:
    """Materialise a per-key table and say whether it is proven small enough to broadcast."""
    saved, _, nbytes = materialize(df)
    limit = broadcast_limit(df.sparkSession)
    small = limit > 0 and nbytes <= limit
    return saved if small else hashable(saved, nbytes), small


def join_on_keys(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "left",
                 null_safe: bool = False, small: bool | None = None) -> DataFrame:
    """Join a per-key table (columns: keys + facts) back to the rows.

    ``null_safe`` makes null keys one group (pandas' ``duplicated`` semantics). When ``small``
    is None the per-key table is materialised and measured first.
    """
    if small is None:
        stats, small = sized_side(stats)
    renamed = stats
    tmp = [f"__k{i}" for i in range(len(keys))]
    for k, t in zip(keys, tmp):
        renamed = renamed.withColumnRenamed(k, t)
    side = F.broadcast(renamed) if small else renamed
    if null_safe:
        cond = [rows[k].eqNullSafe(side[t]) for k, t in zip(keys, tmp)]
    else:
        cond = [rows[k] == side[t] for k, t in zip(keys, tmp)]
    joined = rows.join(side, reduce(lambda a, b: a & b, cond), how)
    return joined.drop(*tmp)
