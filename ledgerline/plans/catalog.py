"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each reads the driver tables (or frames Spark derives from them) whole, so its work grows with
the data. Oracles in SQL live in ``plans.oracles`` under the same keys.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import aggregates as A
from ledgerline.operators import dedup as D
from ledgerline.operators.rules import ColumnSpec, RuleSet, default_rules, greater_than, isin, less_equal
from ledgerline.operators.validate import Validation, duplicate_warning, validate
from ledgerline.operators import upsert as U
from ledgerline.plans import runs as R
from ledgerline.plans.keyjoin import materialize, materialize_by
from ledgerline.session import scratch_path
from ledgerline.sources import csv as C
from ledgerline.sources.fixtures import AS_OF, ORDER_COLS, ops, ops_planted
from ledgerline.sources.tables import table

# Priority / merge on lineitem: key and tie order (also the first/last order of the merge)
LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_TIE = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
CHECKSUM_EXPECTED = 1_000_000.0


CSV_FILE_ROWS = 250_000          # of a compressed file: some 50 MB of text

# every rule but uniqueness: repeated operations stay, for the dedup after it to find
NOT_UNIQUE = ("coerce", "not_null", "max_date", "positive", "max_amount", "regex_id", "regex_account", "isin")


def planted_valid(spark: SparkSession, sf_dir: str) -> Validation:
    """The planted operations, validated by all rules but uniqueness."""
    return validate(ops_planted(spark, sf_dir), default_rules(AS_OF).only(*NOT_UNIQUE), id_cols=ORDER_COLS)


def _validation(spark: SparkSession, sf_dir: str, rules: RuleSet | None = None) -> Validation:
    return validate(ops(spark, sf_dir), rules or default_rules(AS_OF), id_cols=ORDER_COLS)


def _rule_only(*kinds, source=ops):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validate(source(spark, sf_dir), default_rules(AS_OF).only(*kinds), id_cols=ORDER_COLS).failures()
    return q


def valid_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir).valid()


def deduped_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows, content-hash deduplicated (keep first by row order)."""
    v = validate(ops(spark, sf_dir), default_rules(AS_OF), id_cols=ORDER_COLS, store=True, deal_by=S.KEY_COLUMN)
    return D.dedup_hash(v.valid(), ORDER_COLS, rare=True)


# ---- validation ---------------------------------------------------------------------------------
def q_validation_summary(spark, sf_dir):
    return _validation(spark, sf_dir).summary()


def q_validation_failures(spark, sf_dir):
    return _validation(spark, sf_dir).failures()


def q_failures_by_rule(spark, sf_dir):
    return _validation(spark, sf_dir).failures_by_rule()


def q_failures_top100(spark, sf_dir):
    return _validation(spark, sf_dir).failures_top(100)


def q_valid_rows(spark, sf_dir):
    return valid_ops(spark, sf_dir)


def q_rejected_rows(spark, sf_dir):
    rej = _validation(spark, sf_dir).rejected()
    return rej.select(*[c for c in rej.columns if c != "_failures"], F.size("_failures").alias("n_failures"))


def q_missing_column(spark, sf_dir):
    """Input without ``canal``: one failure with a null row, no row rejected for it."""
    v = validate(ops(spark, sf_dir).drop("canal"), default_rules(AS_OF), id_cols=ORDER_COLS)
    return v.failures_by_rule()


def q_control_total(spark, sf_dir):
    return _validation(spark, sf_dir).control_total(CHECKSUM_EXPECTED).drop("actual_text")


def q_validation_warnings(spark, sf_dir):
    """Checksum mismatch against a wrong expected total + duplicate-id count of the raw input."""
    v = _validation(spark, sf_dir)
    flagged = D.flag_duplicates(ops(spark, sf_dir), ORDER_COLS)
    dup = flagged.agg(F.count_if(F.col("is_duplicate")).alias("duplicates"))
    return v.checksum_warnings(CHECKSUM_EXPECTED).unionByName(duplicate_warning(dup))


def q_custom_rules(spark, sf_dir):
    """A caller-supplied rule set over ``orders`` and ``customer``."""
    orders_rules = RuleSet((
        ColumnSpec("o_totalprice", "double", False,
                   checks=(greater_than(F.lit(0), "price must be positive", "positive"),
                           less_equal(F.lit(400_000.0), S.MSG_AMOUNT_MAX, "max_amount"))),
        ColumnSpec("o_orderpriority", "string", False,
                   checks=(isin(["1-URGENT", "2-HIGH", "3-MEDIUM"]),)),
    ))
    cust_rules = RuleSet((
        ColumnSpec("c_acctbal", "double", False,
                   checks=(greater_than(F.lit(0), "balance must be positive", "positive"),)),
    ))
    o = validate(table(spark, sf_dir, "orders"), orders_rules, id_cols=["o_orderkey"]).failures()
    c = validate(table(spark, sf_dir, "customer"), cust_rules, id_cols=["c_custkey"]).failures()
    return (o.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("row_key"), "column", "error")
            .unionByName(c.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("row_key"),
                                  "column", "error")))


def q_valid_keep_first(spark, sf_dir):
    rules = default_rules(AS_OF, unique_mode="keep_first", order_by=ORDER_COLS)
    return _validation(spark, sf_dir, rules).valid()


# ---- dedup ----------------------------------------------------------------------------------------
def q_content_hash(spark, sf_dir):
    return D.with_content_hash(valid_ops(spark, sf_dir)).select(*ORDER_COLS, "content_hash")


def q_flag_duplicates(spark, sf_dir):
    return D.flag_duplicates(ops(spark, sf_dir), ORDER_COLS).select(*ORDER_COLS, "numero_operacion",
                                                                    "is_duplicate")


def q_dedup_hash(spark, sf_dir):
    """The planted operations: copies and rows with the same hash go, the first by row order stays."""
    return D.dedup_hash(planted_valid(spark, sf_dir).valid(), ORDER_COLS)


def q_dedup_key(spark, sf_dir):
    return D.dedup_key(ops(spark, sf_dir), ORDER_COLS)


def q_dedup_key_multi(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return D.keep_first(li, LI_KEYS, LI_TIE)


def q_find_duplicates(spark, sf_dir):
    return D.find_duplicates(ops(spark, sf_dir))


def q_dedup_priority_desc(spark, sf_dir):
    return D.dedup_priority(table(spark, sf_dir, "lineitem"), LI_KEYS, "l_shipdate", "desc", LI_TIE)


def q_dedup_priority_asc(spark, sf_dir):
    return D.dedup_priority(table(spark, sf_dir, "lineitem"), LI_KEYS, "l_shipdate", "asc", LI_TIE)


def q_find_duplicates_sorted(spark, sf_dir):
    """D5 in key order, nulls last."""
    return D.find_duplicates(ops_planted(spark, sf_dir), sort=True)


def q_dedup_priority_sorted(spark, sf_dir):
    return D.dedup_priority(table(spark, sf_dir, "lineitem"), LI_KEYS, "l_shipdate", "desc", LI_TIE, sort=True)


def q_merge_duplicates(spark, sf_dir):
    li = (table(spark, sf_dir, "lineitem")
          .select(*LI_KEYS, "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                  "l_shipdate")
          .withColumn("last_extendedprice", F.col("l_extendedprice")))
    strategy = {"l_extendedprice": "first", "last_extendedprice": "last", "l_quantity": "sum",
                "l_discount": "max", "l_tax": "min", "l_shipdate": "last"}
    return D.merge_duplicates(li, LI_KEYS, strategy, LI_TIE)


def q_dedup_stats(spark, sf_dir):
    return D.dedup_stats(ops(spark, sf_dir), [S.KEY_COLUMN])


def q_dedup_report(spark, sf_dir):
    return D.dedup_report(D.dedup_stats(ops(spark, sf_dir), [S.KEY_COLUMN]))


def q_dedup_documents_text(spark, sf_dir):
    # the text itself stays out of the exchange: its digest and length stand for it
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("digest"), F.length("text").alias("length"))
    return D.keep_first(docs, ["digest", "length"], ["doc_id"]).drop("digest", "length")


def q_distinct_rows(spark, sf_dir):
    return D.distinct_rows(ops_planted(spark, sf_dir).select(*S.OPS_COLUMNS))


def q_quick_validate(spark, sf_dir):
    """P3 on a CSV: validate, flag duplicates and hash in one call; by id, as file order decides which row is first."""
    from ledgerline.plans.pipeline import quick_validate
    rows, _ = quick_validate(spark, _ops_csv(spark, sf_dir, ops_planted, "gzip"), AS_OF, default_rules(AS_OF).only(*NOT_UNIQUE))
    return rows.groupBy("numero_operacion").agg(
        F.count_if(F.col("is_duplicate")).alias("duplicates"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("content_hash").alias("hashes"))


def q_quick_validate_summary(spark, sf_dir):
    from ledgerline.plans.pipeline import quick_validate
    return quick_validate(spark, _ops_csv(spark, sf_dir, ops_planted, "gzip"), AS_OF, default_rules(AS_OF).only(*NOT_UNIQUE))[1]


def q_quick_validate_default(spark, sf_dir):
    """P3 by the default rules: every row of a repeated id is rejected, so each id has one row."""
    from ledgerline.plans.pipeline import quick_validate
    rows, _ = quick_validate(spark, _ops_csv(spark, sf_dir, ops_planted, "gzip"), AS_OF)
    return rows.select("numero_operacion", "fecha_operacion", "monto", "is_duplicate", "content_hash")


# ---- queries and aggregates -------------------------------------------------------------------
def q_table_stats(spark, sf_dir):
    return A.table_stats(deduped_ops(spark, sf_dir))


def q_table_stats_orders(spark, sf_dir):
    return A.table_stats(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


def q_query_filtered(spark, sf_dir):
    return A.query_filtered(valid_ops(spark, sf_dir), {"estado": "PENDIENTE", "moneda": "USD", "canal": "WEB"})


def q_query_filtered_limit(spark, sf_dir):
    return A.query_filtered(table(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
                            limit=5, order_by=["o_orderkey"])


def q_existing_keys(spark, sf_dir):
    return A.existing_keys(deduped_ops(spark, sf_dir))


def q_report_sample(spark, sf_dir):
    return A.report_sample(deduped_ops(spark, sf_dir), [S.KEY_COLUMN], 100)


def q_profile_nulls(spark, sf_dir):
    return A.profile_nulls(ops(spark, sf_dir), S.OPS_COLUMNS)


def q_profile_totals(spark, sf_dir):
    return A.profile_totals(ops_planted(spark, sf_dir).select(*S.OPS_COLUMNS))


def q_value_counts(spark, sf_dir):
    return A.value_counts(ops(spark, sf_dir))


def q_value_counts_share(spark, sf_dir):
    return A.value_counts(ops(spark, sf_dir), with_share=True)


def q_value_counts_events(spark, sf_dir):
    return A.value_counts(table(spark, sf_dir, "events"), ["event_type"], with_share=True)


def q_union_all(spark, sf_dir):
    o = ops(spark, sf_dir)
    copies = o.filter(F.col("l_linenumber") == 1)
    return A.union_all(o, copies).groupBy("numero_operacion").agg(F.count(F.lit(1)).alias("copies"))


# ---- upsert ---------------------------------------------------------------------------------------
TARGET_LOADED = "2000-06-01 00:00:00"


def upsert_sides(spark, sf_dir):
    """Key-deduped ops, each in the target (l_orderkey % 3 <> 0), the batch (% 3 <> 1, with monto + 1) or both."""
    dealt = materialize_by(ops(spark, sf_dir).filter(F.col(S.KEY_COLUMN).isNotNull()), S.KEY_COLUMN).frame
    base = D.keep_first(dealt, [S.KEY_COLUMN], ORDER_COLS)
    norm, _, _ = materialize(U.normalize_load(base))      # shared by both sides: computed and stored once
    tgt = (norm.filter(F.col("l_orderkey") % 3 != 0)
           .withColumn("fecha_carga", F.lit(TARGET_LOADED).cast("timestamp"))
           .withColumn("is_duplicate", F.lit(0)))
    is_bad = F.col(S.KEY_COLUMN).startswith("BAD").cast("long")
    target = U.to_target(D.with_content_hash(tgt),
                         ids=(F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 2 + is_bad)
    batch = D.with_content_hash(norm.filter(F.col("l_orderkey") % 3 != 1).withColumn("monto", F.col("monto") + 1)
                                .withColumn("is_duplicate", F.lit(0)))
    return target, batch


def merged_ops(spark, sf_dir, strategy="auto"):
    target, batch = upsert_sides(spark, sf_dir)
    return U.upsert_merge(target, batch, load_time=AS_OF, strategy=strategy)


def q_upsert_merge(spark, sf_dir):
    return merged_ops(spark, sf_dir).drop("id").withColumnRenamed(U.ACTION, "action")


def q_upsert_merge_keyed(spark, sf_dir):
    target, batch = upsert_sides(spark, sf_dir)
    merged = U.upsert_merge(target, batch, load_time=AS_OF, strategy="keyed")
    return merged.drop("id").withColumnRenamed(U.ACTION, "action")


def q_upsert_merge_shuffle(spark, sf_dir):
    return merged_ops(spark, sf_dir, "shuffle").drop("id").withColumnRenamed(U.ACTION, "action")


def q_upsert_counts(spark, sf_dir):
    return U.upsert_counts(merged_ops(spark, sf_dir))


def q_load_stats(spark, sf_dir):
    return U.load_stats(merged_ops(spark, sf_dir))


def q_upsert_total(spark, sf_dir):
    return merged_ops(spark, sf_dir).agg(A.money_sum(F.col("monto")).alias("total_amount"),
                                         F.count(F.lit(1)).alias("total_rows"))


def q_assert_unique_key(spark, sf_dir):
    """Keys that break the target's uniqueness: repeated operations of the planted input."""
    return U.duplicate_keys(ops_planted(spark, sf_dir).select(S.KEY_COLUMN))


def q_append_new(spark, sf_dir):
    target, batch = upsert_sides(spark, sf_dir)
    return U.to_target(U.append_new(target, batch), load_time=AS_OF).drop("id")


def q_join_semi_existing(spark, sf_dir):
    target, batch = upsert_sides(spark, sf_dir)
    return A.semi_existing(batch, target)


def q_join_anti_new(spark, sf_dir):
    target, batch = upsert_sides(spark, sf_dir)
    return A.anti_new(batch, target)


def q_normalize_load(spark, sf_dir):
    return U.normalize_load(ops(spark, sf_dir))


# ---- run history ----------------------------------------------------------------------------------
def runs_ops(spark, sf_dir):
    """One run record per l_linenumber batch of the ops fixture."""
    return R.runs_from_batches(_validation(spark, sf_dir), "l_linenumber", AS_OF, error_row="l_orderkey")


def _run_counts(spark, sf_dir):
    """The runs without their failure rows: one scan of the validation."""
    return R.runs_from_batches(_validation(spark, sf_dir), "l_linenumber", AS_OF, with_errors=False)


def _scalars(runs):
    return runs.select(*R.SCALAR_FIELDS, F.size("validation_errors").alias("n_errors"))


def _written_runs(spark, sf_dir):
    import uuid
    from ledgerline.session import checkpoint_dir
    folder = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    R.write_records(runs_ops(spark, sf_dir), folder)
    return folder


def q_run_duration(spark, sf_dir):
    return runs_ops(spark, sf_dir).select("pipeline_id", "start_time", "end_time", "processing_time_seconds")


def q_run_summary(spark, sf_dir):
    return R.run_summary(_run_counts(spark, sf_dir))


def q_history_stats(spark, sf_dir):
    return R.history_stats(_run_counts(spark, sf_dir))


def q_run_history(spark, sf_dir):
    return _scalars(R.run_history(spark, _written_runs(spark, sf_dir)))


def q_write_run_record(spark, sf_dir):
    folder = _written_runs(spark, sf_dir)
    return _scalars(R.read_all(spark, folder).drop("_corrupt_record"))


def q_run_by_id(spark, sf_dir):
    return _scalars(R.run_by_id(runs_ops(spark, sf_dir), "etl_batch_3"))


def q_report_kpis(spark, sf_dir):
    return R.report_kpis(_run_counts(spark, sf_dir))


def q_report_kpis_text(spark, sf_dir):
    return R.report_kpis(_run_counts(spark, sf_dir), thousands=True)


def q_report_distribution(spark, sf_dir):
    return R.report_distribution(_run_counts(spark, sf_dir))


def q_stage_funnel(spark, sf_dir):
    v = planted_valid(spark, sf_dir)
    s = v.summary()
    hashed = D.with_content_hash(v.valid())
    d = D.dedup_stats(hashed, [S.HASH_COLUMN])
    counts = [s.select(F.col("total_rows").alias("input"), F.col("valid_rows").alias("valid"),
                       F.col("invalid_rows").alias("invalid")),
              d.select(F.col("duplicates_removed").alias("duplicates"), F.col("final_count").alias("loaded"))]
    return R.stage_funnel(counts)


# ---- CSV, generator, whole job ------------------------------------------------------------------
OPS_NUMERIC = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint",
               "l_quantity": "double", "monto": "double"}


def _ops_csv(spark, sf_dir, source=ops, compression=None):
    """The operations as a CSV; a compressed file can't be read in ranges, so such files are many."""
    folder = scratch_path(spark, "ops-csv")
    C.write_csv(source(spark, sf_dir), folder, compression=compression, rows_per_file=CSV_FILE_ROWS if compression else 0)
    return folder


def q_scan_csv(spark, sf_dir):
    return C.scan_csv(spark, _ops_csv(spark, sf_dir), row_index=False)


def q_csv_row_index(spark, sf_dir):
    scanned = C.scan_csv(spark, _ops_csv(spark, sf_dir))
    return scanned.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(C.ROW).alias("distinct_rows"),
                       F.min(C.ROW).alias("first_row"), F.max(C.ROW).alias("last_row"))


def _ops_parquet(spark, sf_dir, source=ops):
    folder = scratch_path(spark, "ops-parquet")
    source(spark, sf_dir).write.option("compression", "zstd").parquet(folder)
    return folder


def _job(spark, **options):
    from ledgerline.plans.pipeline import ReconciliationJob
    rules = default_rules(AS_OF).only(*NOT_UNIQUE)
    # the row order is by value, also where a CSV holds it as text
    typed = tuple(ColumnSpec(c, "double" if c == "l_quantity" else "long") for c in ORDER_COLS if rules.spec(c) is None)
    return ReconciliationJob(spark, scratch_path(spark, "target"), scratch_path(spark, "runs"), as_of=AS_OF,
                             rules=replace(rules, columns=rules.columns + typed), order_by=ORDER_COLS, dedup_strategy="key", **options)


def _default_job(spark, **options):
    """The reference's job: default rules with uniqueness, dedup by content hash, first by row number."""
    from ledgerline.plans.pipeline import ReconciliationJob
    return ReconciliationJob(spark, scratch_path(spark, "target"), scratch_path(spark, "runs"), as_of=AS_OF, **options)


def q_pipeline_default_rows(spark, sf_dir):
    """P1 on a CSV by the defaults: all rows of the planted copies' ids are rejected."""
    return _default_job(spark).run(_ops_csv(spark, sf_dir, ops_planted, "gzip"), pipeline_id="etl_default").target.drop("id")


def q_pipeline_default_parquet_rows(spark, sf_dir):
    """The same on Parquet input."""
    job = _default_job(spark, input_format="parquet")
    return job.run(_ops_parquet(spark, sf_dir, ops_planted), pipeline_id="etl_default_parquet").target.drop("id")


def q_parquet_row_index(spark, sf_dir):
    from ledgerline.sources.parquet import scan_parquet
    scanned = scan_parquet(spark, _ops_parquet(spark, sf_dir))
    return scanned.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(C.ROW).alias("distinct_rows"),
                       F.min(C.ROW).alias("first_row"), F.max(C.ROW).alias("last_row"))


def q_pipeline_parquet_rows(spark, sf_dir):
    """P1 on Parquet input (typed columns, exact row positions): the planted copies go."""
    job = _job(spark, input_format="parquet")
    return job.run(_ops_parquet(spark, sf_dir, ops_planted), pipeline_id="etl_parquet").target.drop("id")


def q_parse_dates_lenient(spark, sf_dir):
    return C.parse_dates_lenient(ops(spark, sf_dir), S.DATE_COLUMN).select(*ORDER_COLS)


def q_parse_dates_voted(spark, sf_dir):
    """S2 by vote: three layouts in one column, which settles on that of most values."""
    day = F.col("l_shipdate").cast("date")
    text = (F.when(F.col("l_linenumber") == 1, F.date_format(day, "yyyy-MM-dd")).when(F.col("l_linenumber") == 2, F.date_format(day, "MM/dd/yyyy"))
            .when(F.col("l_linenumber") == 7, F.lit("no date")).otherwise(F.date_format(day, "dd/MM/yyyy")))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("fecha"))
    return C.parse_dates_voted(li, "fecha")


def q_write_csv_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "dedup-csv")
    C.write_csv(deduped_ops(spark, sf_dir), folder)
    back = C.scan_csv(spark, folder, row_index=False)
    types = dict(OPS_NUMERIC, fecha_operacion="timestamp")
    return back.select(*[(F.col(c).try_cast(types[c]) if c in types else F.col(c)).alias(c) for c in back.columns])


def q_pipeline_final_rows(spark, sf_dir):
    """P1 on a CSV, its deduplicated copy included: the planted copies go."""
    return _job(spark).run(_ops_csv(spark, sf_dir, ops_planted, "gzip"), pipeline_id="etl_fixture").target.drop("id")


def q_pipeline_csv_copy(spark, sf_dir):
    """The CSV copy that the job leaves, read back."""
    folder = scratch_path(spark, "copy")
    _job(spark).run(_ops_csv(spark, sf_dir, ops_planted, "gzip"), output_dir=folder, pipeline_id="etl_copy")
    back = C.scan_csv(spark, folder, row_index=False)
    types = dict(OPS_NUMERIC, fecha_operacion="timestamp")
    return back.select(*[(F.col(c).try_cast(types[c]) if c in types else F.col(c)).alias(c)
                         for c in S.OPS_COLUMNS + [S.HASH_COLUMN]])


def q_pipeline_warnings(spark, sf_dir):
    """V17 in the job: the warnings of the run record."""
    rec = _job(spark).run(_ops_csv(spark, sf_dir, ops_planted, "gzip"), pipeline_id="etl_warn", expected_checksum=CHECKSUM_EXPECTED).record
    return spark.createDataFrame([(w,) for w in rec["warnings"]], "message string")


def _whole_sides(spark, sf_dir):
    """The two sides of the upsert without rows that lack a required column."""
    whole = F.col("fecha_operacion").isNotNull() & F.col("cuenta_origen").isNotNull()
    return (side.filter(whole) for side in upsert_sides(spark, sf_dir))


def _target_table(spark, rows=None):
    from ledgerline.plans.target import TargetTable
    table = TargetTable(spark, scratch_path(spark, "target"))
    if rows is not None:
        table.insert(rows)
    return table


def q_target_keys(spark, sf_dir):
    """S4 on the table: the keys of a target that was loaded twice."""
    target, batch = _whole_sides(spark, sf_dir)
    table = _target_table(spark, target)
    table.load(batch, load_time=AS_OF)
    return table.keys()


def q_target_merge(spark, sf_dir, strategy="auto"):
    """K5, K6 on the table: matched rows updated in their buckets, others appended."""
    target, batch = _whole_sides(spark, sf_dir)
    table = _target_table(spark, target)
    table.load(batch, load_time=AS_OF, strategy=strategy)
    return table.current().drop("id")


def q_target_merge_bucketed(spark, sf_dir):
    """The same by the join that reads the table bucket by bucket."""
    return q_target_merge(spark, sf_dir, "shuffle")


def q_target_append(spark, sf_dir):
    """K4 on the table: only rows with new keys go in."""
    target, batch = _whole_sides(spark, sf_dir)
    table = _target_table(spark, target)
    table.load(batch, load_time=AS_OF, update=False)
    return table.current().drop("id")


def q_target_reset(spark, sf_dir):
    """K7, K2: a target that was dropped and created anew holds the batch alone."""
    target, batch = _whole_sides(spark, sf_dir)
    table = _target_table(spark, target)
    table.drop()
    table.load(batch, load_time=AS_OF)
    return table.current().drop("id")


def q_value_edges(spark, sf_dir):
    """D1, V1 and A1 outside cents: hash text of small and large amounts, strict numbers, totals of small values."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") * 1e4).alias("large"),
        (F.col("l_linenumber") / F.lit(8192.0)).alias("small"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(F.col("l_quantity").cast("string"), F.lit("d")))
        .otherwise(F.col("l_quantity").cast("string")).alias("number"))
    from ledgerline.functions.hashing import double_text
    from ledgerline.operators.rules import typed
    from pyspark.sql import types as T
    return li.groupBy("l_linenumber").agg(
        F.min(F.length(double_text(F.col("large")))).alias("shortest_text"),
        F.count_if(double_text(F.col("large")).contains("e")).alias("with_exponent"),
        F.max(double_text(F.col("small"))).alias("small_text"),
        F.count(typed(F.col("number"), T.StringType(), "double")).alias("numbers"),
        A.money_sum(F.col("small")).alias("small_total"))


def q_target_schema(spark, sf_dir):
    """K2 + K6: create the target with its fixed schema, load the deduplicated rows, read it back."""
    store = _target_table(spark)
    store.create()
    batch = U.normalize_load(deduped_ops(spark, sf_dir)).withColumn("is_duplicate", F.lit(0))
    store.load(batch, load_time=AS_OF)
    # a second load of a part of the rows changes nothing but their stamp
    store.load(batch.filter("l_orderkey % 5 = 0"), load_time=AS_OF)
    return store.current().drop("id")


def q_exact_duplicates(spark, sf_dir):
    return D.exact_duplicate_count(ops_planted(spark, sf_dir).select(*S.OPS_COLUMNS))


def q_report_header(spark, sf_dir):
    return R.report_header(runs_ops(spark, sf_dir))


QUERIES = {
    "validation_summary": q_validation_summary,
    "validation_failures": q_validation_failures,
    "failures_by_rule": q_failures_by_rule,
    "failures_top100": q_failures_top100,
    "valid_rows": q_valid_rows,
    "rejected_rows": q_rejected_rows,
    "rule_coerce": _rule_only("coerce"),
    "rule_not_null": _rule_only("not_null"),
    "rule_max_date": _rule_only("max_date"),
    "rule_positive": _rule_only("positive"),
    "rule_max_amount": _rule_only("max_amount", source=ops_planted),
    "rule_regex_id": _rule_only("regex_id"),
    "rule_regex_account": _rule_only("regex_account", source=ops_planted),
    "rule_isin": _rule_only("isin"),
    "rule_unique": _rule_only("unique"),
    "missing_column": q_missing_column,
    "control_total": q_control_total,
    "validation_warnings": q_validation_warnings,
    "custom_rules": q_custom_rules,
    "valid_keep_first": q_valid_keep_first,
    "content_hash": q_content_hash,
    "flag_duplicates": q_flag_duplicates,
    "dedup_hash": q_dedup_hash,
    "dedup_key": q_dedup_key,
    "dedup_key_multi": q_dedup_key_multi,
    "find_duplicates": q_find_duplicates,
    "dedup_priority_desc": q_dedup_priority_desc,
    "dedup_priority_asc": q_dedup_priority_asc,
    "merge_duplicates": q_merge_duplicates,
    "dedup_stats": q_dedup_stats,
    "dedup_report": q_dedup_report,
    "dedup_documents_text": q_dedup_documents_text,
    "distinct_rows": q_distinct_rows,
    "quick_validate": q_quick_validate,
    "table_stats": q_table_stats,
    "table_stats_orders": q_table_stats_orders,
    "query_filtered": q_query_filtered,
    "query_filtered_limit": q_query_filtered_limit,
    "existing_keys": q_existing_keys,
    "report_sample": q_report_sample,
    "profile_nulls": q_profile_nulls,
    "profile_totals": q_profile_totals,
    "value_counts": q_value_counts,
    "value_counts_share": q_value_counts_share,
    "value_counts_events": q_value_counts_events,
    "union_all": q_union_all,
    "upsert_merge": q_upsert_merge,
    "upsert_merge_shuffle": q_upsert_merge_shuffle,
    "upsert_merge_keyed": q_upsert_merge_keyed,
    "upsert_counts": q_upsert_counts,
    "load_stats": q_load_stats,
    "upsert_total": q_upsert_total,
    "assert_unique_key": q_assert_unique_key,
    "append_new": q_append_new,
    "join_semi_existing": q_join_semi_existing,
    "join_anti_new": q_join_anti_new,
    "normalize_load": q_normalize_load,
    "run_duration": q_run_duration,
    "run_summary": q_run_summary,
    "history_stats": q_history_stats,
    "run_history": q_run_history,
    "write_run_record": q_write_run_record,
    "run_by_id": q_run_by_id,
    "report_kpis": q_report_kpis,
    "report_kpis_text": q_report_kpis_text,
    "report_distribution": q_report_distribution,
    "stage_funnel": q_stage_funnel,
    "scan_csv": q_scan_csv,
    "csv_row_index": q_csv_row_index,
    "parquet_row_index": q_parquet_row_index,
    "pipeline_parquet_rows": q_pipeline_parquet_rows,
    "parse_dates_lenient": q_parse_dates_lenient,
    "parse_dates_voted": q_parse_dates_voted,
    "write_csv_roundtrip": q_write_csv_roundtrip,
    "pipeline_final_rows": q_pipeline_final_rows,
    "pipeline_csv_copy": q_pipeline_csv_copy,
    "pipeline_warnings": q_pipeline_warnings,
    "target_keys": q_target_keys,
    "target_merge": q_target_merge,
    "target_merge_bucketed": q_target_merge_bucketed,
    "target_append": q_target_append,
    "target_reset": q_target_reset,
    "value_edges": q_value_edges,
    "quick_validate_summary": q_quick_validate_summary,
    "find_duplicates_sorted": q_find_duplicates_sorted,
    "dedup_priority_sorted": q_dedup_priority_sorted,
    "target_schema": q_target_schema,
    "exact_duplicates": q_exact_duplicates,
    "report_header": q_report_header,
    "quick_validate_default": q_quick_validate_default,
    "pipeline_default_rows": q_pipeline_default_rows,
    "pipeline_default_parquet_rows": q_pipeline_default_parquet_rows,
}
