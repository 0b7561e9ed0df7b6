"""Parquet input for the job, and what the files' footers know.

The scan has the same positional ``row`` index as the CSV scan.

Parquet files carry each row's position inside the file (``_metadata.row_index``), so the index is
exact whatever the split layout: rows per file are counted, a running sum over that per-file table
(one row per file) gives each file's first row number, and each row adds its in-file position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans.keyjoin import join_on_keys

ROW = "row"


def scan_parquet(spark: SparkSession, path: str, row_index: bool = True) -> DataFrame:
    """Parquet files as a frame (typed columns kept), plus the 0-based position ``row``.

    Several files are numbered in path order, as if concatenated.
    """
    raw = spark.read.parquet(path)
    if not row_index:
        return raw
    tagged = raw.select("*", F.col("_metadata.file_path").alias("__file"),
                        F.col("_metadata.row_index").alias("__ri"))
    files = tagged.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    # one row per input file
    order = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("__file", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__off"))
    joined = join_on_keys(tagged, offsets, ["__file"], how="inner")
    return joined.select(*[F.col(f"`{c}`") for c in raw.columns], (F.col("__off") + F.col("__ri")).alias(ROW))


def footer_aggregates(spark: SparkSession, path: str, schema: T.StructType, *aggregates: Column) -> DataFrame:
    """Counts, and minima and maxima of numbers, of Parquet files from their footers: no data page is read.

    In a session of its own, whose Parquet reader takes aggregates: other aggregates give the same values from the data.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema).parquet(path).agg(*aggregates)
