"""CSV scan and sink.

The scan never infers types: every column is read as text, pandas' missing-value tokens become
NULL, and the declared types are applied later by the rules (lenient ``try_cast``). Columns are those of
the first header; a file with other columns, or the same in another order, fails the scan. A row
with too many or too few fields fails the scan as well, unless the malformed rows are asked for:
then each comes with its raw text and no values, and validation rejects it.

Line breaks inside quotes are part of the value, and a file is read in ranges all the same. A first pass follows the
lines of each range from both states that it may begin in (inside a quoted value or not) and counts the records under
each (``csvranges.py``); running compositions over the table of ranges, one row each, settle the states and give each
range the number of its first record, pandas' default index, without a global sort. The second pass
gives the records of each range with their numbers to Spark's CSV parser (``from_csv``). Only records that begin in
one range and end in another are put together by a shuffle, from their pieces. Lines end in LF or CR LF, by the first
line of each file.

``multi_line=False`` is for files that are known to have no line breaks in quotes: Spark's reader splits them by lines, and
``row_numbers`` numbers the rows by a count of each split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import null_tokens_to_null
from ledgerline.operators.validate import MALFORMED
from ledgerline.plans.keyjoin import join_on_keys, materialize, observed
from ledgerline.session import broadcast_limit
from ledgerline.sources import csvranges

ROW = "row"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ORDER_TAGS = ["_file", "_block", "_pos"]


# -- files in ranges -------------------------------------------------------------------------------
def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The physical lines of the files, in order, with the key of their file and the place of the range that each begins in."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # ranges must not change between two passes when executors come or go
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.xxhash64("_metadata.file_path").alias("_key"), F.col("_metadata.file_block_start").alias("_block"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(_key, _file, _same) of every file; no file is opened. A path beside every line would cost more than the line."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    return files.groupBy(F.xxhash64("_file").alias("_key")).agg(F.min("_file").alias("_file"), F.count(F.lit(1)).alias("_same"))


def _placed(summaries: DataFrame) -> DataFrame:
    """The state at the beginning of each range, the number of its first record and its header, from their summaries."""
    order = Window.partitionBy("_file").orderBy("_block")
    before, to_here = (order.rowsBetween(Window.unboundedPreceding, k) for k in (-1, 0))
    # a range keeps the state, swaps it or decides it; the state before a range is the last decided one, swapped since
    swap = (F.col("closed_end") & ~F.col("open_end")).cast("int")
    decided = F.when(F.col("closed_end") == F.col("open_end"), F.struct(F.col("closed_end").alias("state"), F.col("swaps")))
    df = summaries.withColumn("swaps", F.sum(swap).over(to_here)).withColumn("last", F.last(decided, ignorenulls=True).over(before))
    swapped = (F.col("swaps") - swap - F.coalesce("last.swaps", F.lit(0))) % 2 == 1
    df = df.withColumn("open", F.coalesce("last.state", F.lit(False)) != swapped).withColumn(
        "crlf", F.coalesce(F.max(F.col("head").endswith("\r")).over(Window.partitionBy("_file")), F.lit(False)))
    per_state = [F.col(f"{x}_records") - F.when(F.col("crlf"), F.col(f"{x}_cr")).otherwise(0) for x in ("open", "closed")]
    df = df.withColumn("records", F.when(F.col("open"), per_state[0]).otherwise(per_state[1]))
    df = df.withColumn("header", ((F.coalesce(F.sum("records").over(before), F.lit(0)) == 0) & (F.col("records") > 0)).cast("int"))
    # this window has no partitions: it runs over one row for each range of the input
    every = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("first_row", F.coalesce(F.sum(F.col("records") - F.col("header")).over(every), F.lit(0))).select(
        "_key", "_file", "_same", "_block", "open", "first_row", "header", "crlf", "head")


def _from_csv(text: Column, names: list[str], malformed: str) -> Column:
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, malformed])
    return F.from_csv(text, ddl, {"escape": '"', "columnNameOfCorruptRecord": malformed, "mode": "PERMISSIVE"})


def _checked(ranges: DataFrame, width: int) -> tuple[DataFrame, bool, bool]:
    """The stored table of ranges, whether it may be broadcast, and whether a record crosses ranges: one job in all.

    Fails if a file's header does not end in its first range, or is not that of the other files.
    """
    head, first = F.regexp_replace("head", "\r$", ""), F.col("header") == 1
    fields = _from_csv(F.lower(head), [f"c{k}" for k in range(width)], "more")
    names = F.when(first & F.col("head").isNotNull(), F.to_json(fields))
    facts = Observation(f"ranges_{uuid.uuid4().hex}")
    told = ranges.withColumn("_names", names).observe(
        facts, F.max(F.when(first & F.col("head").isNull(), F.col("_file"))).alias("late"),
        F.max(F.when(first & head.rlike("\r[^\n]"), F.col("_file"))).alias("cr"), F.min("_names").alias("least"), F.max("_names").alias("most"),
        F.max_by("_file", "_names").alias("other"), F.max("open").alias("open"), F.max("_same").alias("same"))
    stored, _, size = materialize(told.select("_key", "_block", "open", "first_row", "header", "crlf"))
    found = observed(facts, late=None, cr=None, least=None, most=None, other=None, open=None, same=None)
    if (found["same"] or 1) > 1:
        raise ValueError("two files have one key: rename one")
    if found["late"]:
        raise ValueError(f"the header of {found['late']} does not end within the first range of the file")
    if found["cr"]:
        raise ValueError(f"lines of {found['cr']} end in CR alone")
    if found["least"] != found["most"]:
        raise ValueError(f"the header of {found['other']} is not that of the other files")
    limit = broadcast_limit(ranges.sparkSession)
    return stored, 0 < size <= limit or size == 0, bool(found["open"])


def _parsed(rows: DataFrame, names: list[str], null_tokens: list[str] | None, malformed: bool, pieces: bool = False) -> DataFrame:
    """The values of records ``rows(_text, row, _crlf)``; pieces of records wait as they are.

    As with Spark's reader of whole files, CR LF inside quotes becomes LF where lines end in CR LF, but not in raw text.
    """
    whole = F.col("_piece").isNull() if pieces else F.lit(True)
    text = F.when(F.col("_crlf"), F.replace("_text", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("_text"))
    df = rows.select(F.struct("row", "_text", "_crlf", *["_piece"] * pieces).alias("_own"),
                     _from_csv(F.when(whole, text), names, MALFORMED).alias("_in"))
    good = F.col("_in")[MALFORMED].isNull()
    raw = F.when(~good, F.col("_own._text"))
    bad = F.lit(None) if malformed else F.raise_error(F.concat(F.lit("MALFORMED_RECORD: "), raw))
    values = [F.when(good, null_tokens_to_null(F.col("_in")[c], null_tokens)).otherwise(bad.cast("string")).alias(c) for c in names]
    return df.select(*values, *([raw.alias(MALFORMED)] if malformed else []), F.col("_own.row").alias("_row"),
                     *[F.when(F.col("_own._piece").isNotNull(), F.col(f"_own.{c}")).alias(c) for c in ("_text", "_crlf", "_piece") if pieces])


def _scan_ranges(spark: SparkSession, path: str, null_tokens: list[str] | None, malformed: bool) -> DataFrame:
    """Values and row number (``_row``) of every record; see the module text."""
    names = spark.read.options(header=True, multiLine=True, escape='"').csv(path).columns
    lines = _lines(spark, path)
    summaries = lines.mapInArrow(csvranges.summaries, csvranges.SUMMARIES_DDL).join(_files(spark, path), "_key")
    ranges, small, crossing = _checked(_placed(summaries), len(names))
    if not small:                # some 40 bytes a range: beyond the broadcast limit the lines meet their range in a shuffle
        lines = lines.withColumn("_pos", F.monotonically_increasing_id())
    told = join_on_keys(lines, ranges, ["_key", "_block"], how="left", small=small)
    if not small:
        told = told.repartition("_key", "_block").sortWithinPartitions("_key", "_block", "_pos").drop("_pos")
    rows = told.mapInArrow(csvranges.records, csvranges.RECORDS_DDL)
    if not crossing:
        return _parsed(rows, names, null_tokens, malformed)
    # the pieces of records that cross ranges are stored beside the parsed rows, and put together by row
    stored = materialize(_parsed(rows, names, null_tokens, malformed, pieces=True))[0]
    pieces = stored.filter(F.col("_piece").isNotNull()).groupBy(F.col("_row").alias("row")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_piece", "_text"))), lambda x: x["_text"]), "\n").alias("_text"), F.first("_crlf").alias("_crlf"))
    return stored.filter(F.col("_piece").isNull()).drop("_text", "_crlf", "_piece").unionByName(_parsed(pieces, names, null_tokens, malformed))


# -- files split by lines --------------------------------------------------------------------------
def _scan(spark: SparkSession, path: str, malformed: bool) -> tuple[DataFrame, list[str]]:
    """All columns as text, and their names; malformed rows fail or come with their raw text."""
    options = {"header": True, "escape": '"', "enforceSchema": False}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if malformed:
        schema = schema.add(MALFORMED, T.StringType())
        options["columnNameOfCorruptRecord"] = MALFORMED
    raw = spark.read.schema(schema).options(mode="PERMISSIVE" if malformed else "FAILFAST", **options).csv(path)
    return raw, names


def scan_csv_tagged(spark: SparkSession, path: str, null_tokens: list[str] | None = None, malformed: bool = False) -> DataFrame:
    """One pass over files without line breaks in quotes: all columns as text plus the file-order tags (file path, split
    start, position in the scan). Ordering by the tags is file order; ``row_numbers`` turns them into 0-based rows."""
    raw, names = _scan(spark, path, malformed)
    good = F.col(MALFORMED).isNull() if malformed else F.lit(True)
    cols = [F.when(good, null_tokens_to_null(F.col(f"`{c}`"), null_tokens)).alias(c) for c in names]
    return raw.select(*cols, *([F.col(MALFORMED)] if malformed else []), F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_pos"))


def split_offsets(tagged: DataFrame) -> DataFrame:
    """Per file split: first scan position and first row number (one row per split).

    The running sum is a window over this small table only: its size is the number of file splits
    (input bytes / split size), not the number of rows.
    """
    splits = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("__n"), F.min("_pos").alias("__first"))
    order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("_file", "_block", "__first", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__off"))


def row_numbers(tagged: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (carrying the tags of ``tagged``) with the 0-based file position ``row`` added."""
    joined = join_on_keys(rows, split_offsets(tagged), ["_file", "_block"], how="inner")
    return joined.withColumn(ROW, F.col("__off") + F.col("_pos") - F.col("__first")).drop("__off", "__first")


def scan_csv(spark: SparkSession, path: str, null_tokens: list[str] | None = None, row_index: bool = True,
             multi_line: bool = True, malformed: bool = False) -> DataFrame:
    """All columns as strings, missing tokens as NULL, plus the 0-based file position ``row``.

    Several files are numbered in (path, offset) order, as if concatenated; headers and blank lines have no number. The
    files are read twice (states and counts of the ranges, then rows). If records cross ranges, the rows are written to the
    checkpoint folder on the way.
    """
    if multi_line:
        rows = _scan_ranges(spark, path, null_tokens, malformed)
        if not row_index:
            return rows.drop("_row")
        return rows.withColumn(ROW, F.col("_row")).drop("_row")
    tagged = scan_csv_tagged(spark, path, null_tokens, malformed)
    if not row_index:
        return tagged.drop(*ORDER_TAGS)
    return row_numbers(tagged, tagged).drop(*ORDER_TAGS)


def parse_dates_lenient(df: DataFrame, column: str, formats: list[str] | None = None) -> DataFrame:
    """Text to timestamp; anything that does not parse becomes NULL (never an error)."""
    c = F.col(column)
    if formats:
        parsed = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats], c.try_cast("timestamp"))
    else:
        parsed = c.try_cast("timestamp")
    return df.withColumn(column, parsed)


# layouts that the vote knows, the first of a tie first, and the shape of their texts
DATE_LAYOUTS = {
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", "yyyy-MM-dd": r"^\d{4}-\d\d-\d\d$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$",
    "dd/MM/yyyy HH:mm:ss": r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d$", "dd/MM/yyyy HH:mm": r"^\d\d/\d\d/\d{4} \d\d:\d\d$",
    "dd/MM/yyyy": r"^\d\d/\d\d/\d{4}$", "MM/dd/yyyy HH:mm:ss": r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d$",
    "MM/dd/yyyy HH:mm": r"^\d\d/\d\d/\d{4} \d\d:\d\d$", "MM/dd/yyyy": r"^\d\d/\d\d/\d{4}$",
    "dd-MM-yyyy": r"^\d\d-\d\d-\d{4}$", "dd.MM.yyyy": r"^\d\d\.\d\d\.\d{4}$", "yyyy/MM/dd": r"^\d{4}/\d\d/\d\d$", "yyyyMMdd": r"^\d{8}$",
}


def _by_layout(c: Column, layout: str, shape: str | None) -> Column:
    parsed = F.try_to_timestamp(c, F.lit(layout))
    return F.when(c.rlike(shape), parsed) if shape else parsed


def date_votes(df: DataFrame, column: str, layouts: list[str] | None = None) -> DataFrame:
    """(layout, place, votes): how many values of a text column each layout reads; one pass over that column."""
    names = list(DATE_LAYOUTS) if layouts is None else list(layouts)
    c = F.trim(F.col(f"`{column}`"))
    counts = df.agg(*[F.count(_by_layout(c, n, DATE_LAYOUTS.get(n))).alias(f"v{k}") for k, n in enumerate(names)])
    votes = F.explode(F.array(*[F.struct(F.lit(n).alias("layout"), F.lit(k).alias("place"), F.col(f"v{k}").alias("votes"))
                                for k, n in enumerate(names)]))
    return counts.select(votes.alias("v")).select("v.*")


def date_layout(df: DataFrame, column: str, layouts: list[str] | None = None) -> str | None:
    """The layout that reads most values of a text column, the first in the list of a tie; None if none reads any.

    It can be given to a rule set: ``ColumnSpec(column, "timestamp", formats=(layout,))``.
    """
    best = date_votes(df, column, layouts).filter("votes > 0").orderBy(F.desc("votes"), "place").first()
    return best["layout"] if best else None


def parse_dates_voted(df: DataFrame, column: str, layouts: list[str] | None = None) -> DataFrame:
    """S2 for layouts that nobody named: the column settles on one layout by vote, and is read by it alone; the rest is NULL."""
    layout = date_layout(df, column, layouts)
    parsed = F.lit(None).cast("timestamp") if layout is None else _by_layout(F.trim(F.col(f"`{column}`")), layout, DATE_LAYOUTS.get(layout))
    return df.withColumn(column, parsed)


def write_csv(df: DataFrame, directory: str, mode: str = "overwrite", compression: str | None = None, rows_per_file: int = 0) -> None:
    """K1: header + one CSV part per partition, or more of ``rows_per_file`` each; timestamps with six fraction digits."""
    (df.write.mode(mode).option("header", True).option("timestampFormat", CSV_TIMESTAMP_FORMAT).option("maxRecordsPerFile", rows_per_file)
     .option("escape", '"').csv(directory, compression=compression))
