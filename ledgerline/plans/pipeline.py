"""The reconciliation job (P1-P4): extract -> validate -> dedup -> CSV copy -> upsert -> run record.

One plan for every input size. The input is parsed once and written once, as columns and the row rules that
it breaks, to the shared checkpoint folder; uniqueness (a key-only scan), the failure report and the valid rows read that table.
The deduplicated rows are written once too; the CSV copy and the load read them. A load appends new
keys to the target table and rewrites only the buckets in which it updates rows, as its last step, so a failure before or in a
statement leaves the table as it was; the run record is saved on success and on failure (P2).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import dedup as D
from ledgerline.operators import upsert as U
from ledgerline.operators.rules import RuleSet, default_rules
from ledgerline.operators.validate import FAILED, duplicate_warning, validate
from ledgerline.plans import runs as R
from ledgerline.plans.keyjoin import Stored, materialize_by, observed
from ledgerline.plans.target import TargetTable
from ledgerline.session import scratch_owner
from ledgerline.sources.csv import MALFORMED, ROW, scan_csv, write_csv
from ledgerline.sources.parquet import scan_parquet


@dataclass
class RunResult:
    record: dict
    target: DataFrame | None = None
    failures: list = field(default_factory=list)


class ReconciliationJob:
    """Configured job; ``run`` processes one input (path or frame) into the target table.

    ``target``: a catalog table's name, or a folder. ``target_parts``: buckets of a new table, by default by the size of its first load;
    a load rewrites those in which it updates rows.
    """

    def __init__(self, spark: SparkSession, target: str, runs_dir: str, rules: RuleSet | None = None,
                 as_of=None, order_by: list[str] | None = None, max_errors: int = 100,
                 dedup_strategy: str = "hash", key_columns: list[str] | None = None,
                 input_format: str | None = None, target_parts: int | None = None, multi_line: bool = True):
        self.spark = spark
        self.store = TargetTable(spark, target, parts=target_parts)
        self.runs_dir = runs_dir
        self.as_of = as_of
        self.rules = rules or default_rules(as_of)
        self.order_by = order_by
        self.max_errors = max_errors
        self.dedup_strategy = dedup_strategy
        self.key_columns = key_columns
        self.input_format = input_format
        self.multi_line = multi_line

    def _extract(self, source) -> DataFrame:
        """The input with its row numbers (a frame keeps its own ``row``, if any)."""
        if isinstance(source, DataFrame):
            return source
        fmt = self.input_format or ("parquet" if str(source).rstrip("/").endswith(".parquet") else "csv")
        if fmt == "parquet":
            return scan_parquet(self.spark, source)
        return scan_csv(self.spark, source, multi_line=self.multi_line, malformed=True)

    @staticmethod
    def _report_rows(top: list) -> list[dict]:
        """Failure dicts of the run record from top-failure rows carrying ``row``."""
        return [{"row": r[ROW] if ROW in r.asDict() else None, "column": r["column"], "error": r["error"]}
                for r in top]

    def run(self, source, output_dir: str | None = None, pipeline_id: str | None = None,
            expected_checksum: float | None = None) -> RunResult:
        """Process one input. The CSV copy goes to ``output_dir``, by default a folder beside the target."""
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        pid = pipeline_id or f"etl_{now.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:6]}"
        rec = {f.name: None for f in S.RUN_SCHEMA.fields}
        rec.update(pipeline_id=pid, start_time=now, input_file=source if isinstance(source, str) else "<frame>",
                   input_rows=0, validation_passed=0, validation_failed=0, validation_errors=[],
                   duplicates_found=0, duplicates_removed=0, rows_loaded=0, rows_updated=0, load_failed=0,
                   processing_time_seconds=0.0, status="running", error_message="", warnings=[])
        stage, kept = "extract", 0
        with scratch_owner(self.spark):
            try:
                raw = self._extract(source)
                stage = "validate"
                order_by = self.order_by or ([ROW] if ROW in raw.columns else None)
                v = validate(raw, self.rules, id_cols=[ROW] if ROW in raw.columns else (order_by or []), store=True,
                             deal_by=(self.key_columns or [self.store.key])[0])
                # the counts ride on the job of the first failures, which reads every row once
                annotated, counts = v.annotated, Observation(f"validate_{pid}")
                v.annotated = annotated.observe(counts, F.count(F.lit(1)).alias("total"), F.count_if(~F.col(FAILED)).alias("valid"))
                rec["validation_errors"] = self._report_rows(v.failures_top(self.max_errors).collect())
                v.annotated = annotated
                m = observed(counts, total=0, valid=0)
                total, valid = int(m["total"]), int(m["valid"])
                rec["input_rows"] = total
                rec["validation_passed"] = valid
                rec["validation_failed"] = total - valid
                rec["warnings"] = self._warnings(v, expected_checksum)
                if not order_by:
                    raise ValueError("an explicit row order is needed for keep-first dedup")
                stage = "dedup"
                clean = D.with_content_hash(v.valid().drop(MALFORMED))
                parts = self.store.parts_for(clean)
                first = [*order_by, *[c for c in (ROW,) if c in raw.columns and c not in order_by]]       # of tied rows, the first in the file
                # the write also fixes the numbers that new ids follow
                clean = clean.withColumns({"is_duplicate": F.lit(0), U.SEQ: F.monotonically_increasing_id()})
                if self.dedup_strategy == "hash" and self._proven_unique():       # the hash holds the key
                    stored = D.keep_first_dealt(clean, [S.HASH_COLUMN], first, self.store.key, parts)
                else:
                    deduped, _ = D.deduplicate(clean.drop(U.SEQ), self.dedup_strategy, first, self.key_columns)
                    stored = materialize_by(deduped.drop(ROW).withColumn(U.SEQ, F.monotonically_increasing_id()), self.store.key, parts)
                deduped, kept = stored.frame.drop(ROW), stored.rows
                rec["duplicates_found"] = rec["duplicates_removed"] = valid - kept
                stage = "copy"
                write_csv(deduped.drop(U.SEQ), output_dir or f"{self.store.root}-csv/{pid}")
                stage = "load"
                loaded = self._load(deduped, stored)
                rec["rows_loaded"] = loaded["inserted"]
                rec["rows_updated"] = loaded["updated"]
                rec["status"] = "success"
            except Exception as exc:  # noqa: BLE001 -- P2: record the failure, then re-raise
                rec["status"] = "failed"
                prefix = "Failed to load data: " if stage == "load" else ""
                rec["error_message"] = f"{prefix}{type(exc).__name__}: {exc}"
                if stage == "load":
                    rec["load_failed"] = kept        # all-or-nothing: every row of the batch counts as failed (K9)
                self._finish(rec)
                raise
        self._finish(rec)
        return RunResult(rec, self.store.current())

    def _warnings(self, v, expected: float | None) -> list[str]:
        """Checksum mismatch of the valid rows, and the number of repeated operation ids of the input."""
        key, raw = self.store.key, v.marks.rows
        found = [v.checksum_warnings(expected)] if expected is not None else []
        if key in raw.columns:
            counts = D.key_counts(raw, [key]).select((F.col("total_input") - F.col("final_count")).alias("duplicates"))
            found.append(duplicate_warning(counts))
        return [r["message"] for f in found for r in f.collect()]

    def _required(self) -> set[str]:
        """Columns that have a value in every valid row."""
        return {c.name for c in self.rules.columns if not c.nullable and self.rules.wants("not_null")}

    def _proven_unique(self) -> bool:
        """Validation already leaves at most one valid row per key when it enforces a non-null unique key."""
        spec = self.rules.spec(self.store.key)
        return spec is not None and spec.unique and spec.name in self._required() and self.rules.wants("unique")

    def _load(self, deduped: DataFrame, stored: Stored) -> dict:
        """Insert the new keys of the stored rows into the target and update the others."""
        not_null = self._required()
        # a valid row has a value in these columns, and one of its type if types are checked
        proven = not_null if self.rules.wants("coerce") else ()
        return self.store.load(U.normalize_load(deduped), load_time=self.as_of, check_keys=not self._proven_unique(), stored=stored, proven=proven)

    def _finish(self, rec: dict) -> None:
        end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rec["end_time"] = end
        rec["processing_time_seconds"] = (end - rec["start_time"]).total_seconds()
        clean = {k: rec.get(k) for k in [f.name for f in S.RUN_SCHEMA.fields]}
        R.write_records(R.record_frame(self.spark, clean).coalesce(1), self.runs_dir)


def quick_validate(spark: SparkSession, csv_path: str, as_of=None, rules: RuleSet | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan, validate, flag duplicate ids and hash; returns (rows, summary)."""
    v = validate(scan_csv(spark, csv_path, malformed=True), rules or default_rules(as_of), id_cols=[ROW], store=True, deal_by=S.KEY_COLUMN)
    rows = D.with_content_hash(D.flag_duplicates(v.valid().drop(MALFORMED), [ROW]))
    return rows, v.summary()


def build_report(runs: DataFrame, target: DataFrame, order_by: list[str], sample_rows: int = 100) -> dict:
    """The report tables of one or more runs: header, KPIs, distribution, data sample."""
    from ledgerline.operators.aggregates import report_sample
    return {"header": R.report_header(runs), "kpis": R.report_kpis(runs),
            "distribution": R.report_distribution(runs),
            "sample": report_sample(target, order_by, sample_rows)}


def write_report(report: dict, directory: str) -> None:
    """Each report table as a CSV folder."""
    for name, frame in report.items():
        write_csv(frame.coalesce(1), f"{directory.rstrip('/')}/{name}")
