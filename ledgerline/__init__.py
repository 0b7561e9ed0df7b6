"""ledgerline: Spark-native validation, deduplication and keyed upsert of operation records.

Every public operator is a ``DataFrame -> DataFrame`` function built from native Spark
expressions; storage is touched only in ``sources`` and ``plans``.

    from ledgerline import get_spark, validate, default_rules, deduplicate, upsert_merge
    from ledgerline import TargetTable, ReconciliationJob, scan_csv
"""

from ledgerline.operators.dedup import (deduplicate, find_duplicates, flag_duplicates, merge_duplicates,
                                        with_content_hash)
from ledgerline.operators.rules import ColumnSpec, RuleSet, default_rules
from ledgerline.operators.upsert import normalize_load, upsert_counts, upsert_merge
from ledgerline.operators.validate import validate
from ledgerline.plans.pipeline import ReconciliationJob
from ledgerline.plans.target import TargetTable
from ledgerline.session import checkpoint_dir, get_spark
from ledgerline.sources.csv import scan_csv, write_csv
from ledgerline.sources.parquet import scan_parquet

__all__ = ["get_spark", "checkpoint_dir", "validate", "default_rules", "RuleSet", "ColumnSpec", "deduplicate",
           "flag_duplicates", "find_duplicates", "merge_duplicates", "with_content_hash", "upsert_merge",
           "upsert_counts", "normalize_load", "TargetTable", "ReconciliationJob", "scan_csv", "scan_parquet",
           "write_csv"]
