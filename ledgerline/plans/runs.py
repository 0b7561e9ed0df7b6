"""Run history: one record per run, written as JSON, read back as a table.

A run record is a row of ``RUN_SCHEMA``. Records are appended as JSON files to a shared folder;
reading them back is one ``spark.read.json`` with a fixed schema, and a damaged file is set aside
in ``_corrupt_record`` instead of failing the read. Everything after that is plain aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.text import percent_text, seconds_text, thousands_text
from ledgerline.operators.validate import FAILED, FAILURES

SCALAR_FIELDS = [f.name for f in S.RUN_SCHEMA.fields if f.name not in ("validation_errors", "warnings")]


def record_frame(spark: SparkSession, record: dict) -> DataFrame:
    """One run record (a dict of RUN_SCHEMA fields) as a one-row frame."""
    row = {f.name: record.get(f.name) for f in S.RUN_SCHEMA.fields}
    for name in ("validation_errors", "warnings"):
        if row.get(name) is None:
            row[name] = []
    return spark.createDataFrame([row], S.RUN_SCHEMA)


def write_records(runs: DataFrame, directory: str) -> None:
    """K8: append run records as JSON (whole files are committed; no half-written record)."""
    (runs.select(*[f.name for f in S.RUN_SCHEMA.fields])
     .write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(directory))


def read_all(spark: SparkSession, directory: str, multi_line: bool = False) -> DataFrame:
    """All records with a ``_corrupt_record`` column (null on good rows).

    Files are read as text (one record per line, or one per file with ``multi_line``) and parsed
    with ``from_json`` in permissive mode: a damaged record becomes a row whose only non-null
    field is its raw text, and any query over the result stays allowed.
    """
    text = spark.read.text(directory, wholetext=multi_line)
    parsed = F.from_json(F.col("value"), S.RUN_SCHEMA_READ,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return text.filter(F.trim(F.col("value")) != "").select(parsed.alias("r")).select("r.*")


def run_history(spark: SparkSession, directory: str, multi_line: bool = False) -> DataFrame:
    """The good records, newest first."""
    good = read_all(spark, directory, multi_line)
    return good.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record") \
               .orderBy(F.col("start_time").desc_nulls_last())


def quarantined(spark: SparkSession, directory: str, multi_line: bool = False) -> DataFrame:
    """Records that could not be parsed, kept as raw text."""
    return read_all(spark, directory, multi_line).filter(F.col("_corrupt_record").isNotNull()) \
        .select("_corrupt_record")


def run_by_id(runs: DataFrame, pipeline_id: str) -> DataFrame:
    """The record of one run (empty frame when absent)."""
    return runs.filter(F.col("pipeline_id") == F.lit(pipeline_id))


def duration_seconds(start: Column, end: Column) -> Column:
    """A4: end - start in seconds (null until the run has ended)."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def with_duration(runs: DataFrame) -> DataFrame:
    """A4: fill processing_time_seconds from start/end once the run has ended."""
    d = duration_seconds(F.col("start_time"), F.col("end_time"))
    return runs.withColumn("processing_time_seconds",
                           F.when(F.col("end_time").isNotNull(), d).otherwise(F.col("processing_time_seconds")))


def _success_rate(loaded: Column, input_rows: Column) -> Column:
    return F.coalesce(F.try_divide(loaded.cast("double"), F.nullif(input_rows, F.lit(0))), F.lit(0.0))


def run_summary(runs: DataFrame) -> DataFrame:
    """A5: per run: status, input, loaded, success rate text, duplicates, error count, time text.

    ``rows_loaded`` counts inserts only; ``rows_written`` adds the updates beside it.
    """
    rate = _success_rate(F.col("rows_loaded"), F.col("input_rows"))
    return runs.select(
        "pipeline_id", "status",
        F.col("input_rows").alias("total_input"), F.col("rows_loaded").alias("total_loaded"),
        percent_text(rate).alias("success_rate"),
        "duplicates_removed",
        (F.col("n_errors") if "n_errors" in runs.columns else F.coalesce(F.size("validation_errors"), F.lit(0)))
        .alias("validation_errors"),
        seconds_text(F.col("processing_time_seconds")).alias("processing_time"),
        (F.col("rows_loaded") + F.col("rows_updated")).alias("rows_written"))


def history_stats(runs: DataFrame) -> DataFrame:
    """Totals over all runs in one aggregation; no row when there is no run."""
    agg = runs.agg(F.count(F.lit(1)).alias("total_runs"),
                   F.count_if(F.col("status") == "success").alias("successful_runs"),
                   F.coalesce(F.sum("input_rows"), F.lit(0)).cast("long").alias("total_rows_processed"),
                   F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("total_rows_loaded"),
                   F.avg("processing_time_seconds").alias("_avg"),
                   F.max("start_time").alias("last_run"))
    return agg.filter(F.col("total_runs") > 0).select(
        "total_runs", "successful_runs",
        percent_text(F.col("successful_runs") / F.col("total_runs")).alias("success_rate"),
        "total_rows_processed", "total_rows_loaded",
        seconds_text(F.col("_avg")).alias("avg_processing_time"), "last_run")


def report_kpis(runs: DataFrame, thousands: bool = False) -> DataFrame:
    """The seven KPI rows (label, value) of each run; counts with thousands marks if asked for."""
    count = thousands_text if thousands else lambda c: c.cast("string")
    rate = F.col("rows_loaded") / F.greatest(F.coalesce(F.col("input_rows"), F.lit(1)), F.lit(1))
    values = [*[count(F.col(c)) for c in ("input_rows", "validation_passed", "validation_failed", "duplicates_removed", "rows_loaded")],
              percent_text(rate),
              seconds_text(F.coalesce(F.col("processing_time_seconds"), F.lit(0.0)))]
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(lbl).alias("label"), v.alias("value"))
                      for i, (lbl, v) in enumerate(zip(S.KPI_LABELS, values))])
    return runs.select("pipeline_id", F.inline(pairs))


def report_distribution(runs: DataFrame) -> DataFrame:
    """Record distribution (validated, invalid, duplicates, loaded) of each run."""
    values = [F.col("validation_passed"), F.col("validation_failed"), F.col("duplicates_removed"),
              F.col("rows_loaded")]
    pairs = F.array(*[F.struct(F.lit(lbl).alias("category"), v.cast("long").alias("count"))
                      for lbl, v in zip(S.DISTRIBUTION_LABELS, values)])
    return runs.select("pipeline_id", F.inline(pairs))


def report_header(runs: DataFrame) -> DataFrame:
    """Summary header: id, start time, upper-cased status."""
    return runs.select("pipeline_id", "start_time", F.upper(F.col("status")).alias("status"))


def stage_funnel(counts: list[DataFrame] | dict[str, int], spark: SparkSession | None = None) -> DataFrame:
    """A10: stage counts as rows (position, stage, rows).

    ``counts`` is a list of one-row frames whose columns are stages, in funnel order; each is
    unpivoted on its own and the rows are appended (no join between the counters).
    """
    if isinstance(counts, dict):
        rows = [(i + 1, k, int(v)) for i, (k, v) in enumerate(counts.items())]
        return spark.createDataFrame(rows, "position int, stage string, rows long")
    parts, pos = [], 0
    for frame in counts:
        pairs = []
        for c in frame.columns:
            pos += 1
            pairs.append(F.struct(F.lit(pos).alias("position"), F.lit(c).alias("stage"),
                                  F.col(c).cast("long").alias("rows")))
        parts.append(frame.select(F.inline(F.array(*pairs))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def runs_from_batches(validation, batch_col: str, started, errors_per_run: int = 100,
                      error_row: str | None = None, with_errors: bool = True) -> DataFrame:
    """One run record per value of ``batch_col`` (e.g. one input file per run), plus ``n_errors``.

    One aggregate of the validated rows gives every counter (rows grouped by run and by the content
    hash of the valid ones: input, passed, loaded = distinct hashes, duplicates, failures that the
    record holds). Only ``with_errors`` scans them again, for the first ``errors_per_run`` failures
    per run ordered by (row, column, error) -- a bounded top-k per run (partial
    ``WindowGroupLimit``), never a whole group.
    """
    from ledgerline.functions.hashing import content_hash_column
    annotated = validation.annotated
    # where uniqueness is judged by a join, the hash is worked out before it: the join moves the hash and not its columns
    rows = annotated if validation.marks is None else validation.marks.rows
    clean = ~F.col(FAILED if validation.marks is None else validation.marks.BROKEN)
    source = {f"__t{k}": validation.typed_column(rows, c) for k, c in enumerate(c for c in S.HASH_SOURCE_COLUMNS if c in rows.columns)}
    rows = rows.withColumns({"__batch": validation.typed_column(rows, batch_col), **source})
    rows = rows.withColumn("__h", F.when(clean, content_hash_column(rows.schema, list(source)))).drop(*source)
    judged = rows if validation.marks is None else validation.judged(rows)
    valid = ~F.col(FAILED)
    per_hash = (judged.select(F.col("__batch").alias(batch_col), valid.alias("__v"), F.when(valid, F.col("__h")).alias("__h"), F.size(FAILURES).alias("__f"))
                .groupBy(batch_col, "__h").agg(F.count(F.lit(1)).alias("__n"), F.count_if("__v").alias("__nv"),
                                               F.sum("__f").alias("__nf")))
    counts = per_hash.groupBy(batch_col).agg(
        F.least(F.sum("__nf"), F.lit(errors_per_run)).cast("int").alias("n_errors"),
        F.sum("__n").cast("long").alias("input_rows"),
        F.sum("__nv").cast("long").alias("validation_passed"),
        F.count_if(F.col("__h").isNotNull()).alias("rows_loaded"))
    base = counts.select(batch_col, "input_rows", "validation_passed",
                         (F.col("input_rows") - F.col("validation_passed")).alias("validation_failed"),
                         (F.col("validation_passed") - F.col("rows_loaded")).alias("duplicates_found"),
                         "rows_loaded", "n_errors")
    row_id = F.col(error_row).cast("long") if error_row else F.lit(None).cast("long")
    fails = (annotated.select(batch_col, row_id.alias("row"), F.explode(FAILURES).alias("_f"))
             .select(batch_col, "row", F.col("_f.column").alias("column"), F.col("_f.error").alias("error")))
    w = Window.partitionBy(batch_col).orderBy(F.col("row").asc_nulls_first(), "column", "error")
    top = (fails.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= errors_per_run)
           .groupBy(batch_col)
           .agg(F.array_sort(F.collect_list(F.struct("__rn", "row", "column", "error"))).alias("__e")))
    errs = top.select(batch_col, F.transform("__e", lambda x: F.struct(x["row"].alias("row"),
                                                                        x["column"].alias("column"),
                                                                        x["error"].alias("error")))
                      .alias("validation_errors"))
    start = (F.lit(str(started)).cast("timestamp") if not isinstance(started, Column) else started) \
        + F.make_dt_interval(F.lit(0), F.col(batch_col).cast("int"))
    runs = base.join(errs, batch_col, "left") if with_errors else base.withColumn(
        "validation_errors", F.lit(None).cast(S.RUN_SCHEMA["validation_errors"].dataType))
    runs = (runs.withColumn("start_time", start)
            .withColumn("end_time", F.timestamp_micros(F.unix_micros(F.col("start_time"))
                                                       + F.col("input_rows") * F.lit(1000))))
    failed = F.col("validation_failed") > F.col("validation_passed")
    extra = [F.coalesce("n_errors", F.lit(0)).alias("n_errors")]
    out = runs.select(
        F.concat(F.lit("etl_batch_"), F.col(batch_col).cast("string")).alias("pipeline_id"),
        "start_time", "end_time",
        F.concat(F.lit(f"{batch_col}="), F.col(batch_col).cast("string")).alias("input_file"),
        "input_rows", "validation_passed", "validation_failed",
        F.coalesce(F.col("validation_errors"), F.array().cast(S.RUN_SCHEMA["validation_errors"].dataType))
        .alias("validation_errors"),
        F.coalesce(F.col("duplicates_found"), F.lit(0)).cast("long").alias("duplicates_found"),
        F.coalesce(F.col("duplicates_found"), F.lit(0)).cast("long").alias("duplicates_removed"),
        F.coalesce(F.col("rows_loaded"), F.lit(0)).cast("long").alias("rows_loaded"),
        F.lit(0).cast("long").alias("rows_updated"), F.lit(0).cast("long").alias("load_failed"),
        F.lit(None).cast("double").alias("processing_time_seconds"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(failed, F.lit("validation rejected most rows")).otherwise(F.lit("")).alias("error_message"),
        F.array().cast(S.RUN_SCHEMA["warnings"].dataType).alias("warnings"), *extra)
    return with_duration(out)
