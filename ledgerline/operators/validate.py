"""Validation: collect every failure of every rule in one pass.

Each row gets an ``array<struct<column, error>>`` of its failures, built from one ``when`` per
rule; uniqueness is the only rule that needs other rows and is attached from a per-key table
(see ``plans.keyjoin``). Before that join the other rules are worked out to one bit each, so that it
moves what its reader asks for, and not every column that a rule looks at. Valid rows are those with
an empty array, and come out typed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S
from ledgerline.operators.dedup import order_value
from ledgerline.operators.rules import RuleSet, default_rules, row_rules, typed
from ledgerline.plans.keyjoin import join_on_keys, materialize, materialize_by, sized_side

FAILURES = "_failures"
FAILED = "_failed"
MALFORMED = "_malformed_row"            # raw text of rows that the CSV scan could not split


def _money_text(total):
    """Cents, or as many digits as the total has."""
    text = total.cast("string")
    return F.regexp_replace(text, r"(\.\d\d\d*?)0*$", "$1")


def _unique_key(rows: DataFrame, spec) -> tuple[DataFrame, str]:
    """The rows with the typed values of a column that must be unique, and their name: its own, if it has its type already."""
    raw_type = rows.schema[spec.name].dataType
    if raw_type == S.SPARK_TYPES[spec.dtype]:
        return rows, spec.name
    key = f"__ukey_{spec.name}"
    return rows.withColumn(key, typed(F.col(spec.name), raw_type, spec.dtype, spec.formats)), key


def _unique_flag(df: DataFrame, spec, rules: RuleSet, flag: str) -> Callable[[DataFrame], DataFrame]:
    """What adds boolean ``flag`` to rows of ``df``: the row breaks uniqueness of ``spec.name`` (null keys never do)."""
    if rules.unique_mode not in ("reject_all", "keep_first"):
        raise ValueError(f"Unknown unique_mode: {rules.unique_mode}")
    if rules.unique_mode == "keep_first" and not rules.order_by:
        raise ValueError("unique_mode='keep_first' needs order_by")
    keyed, key = _unique_key(df, spec)
    counts = keyed.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__ukey"))
    if rules.unique_mode == "keep_first":
        order = order_value(df, list(rules.order_by))
        stats = counts.agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__first"))
        broken = F.col("__first").isNotNull() & ~order.eqNullSafe(F.col("__first"))
    else:
        stats = counts.agg(F.count(F.lit(1)).alias("__n")).withColumn("__first", F.lit(True))
        broken = F.coalesce(F.col("__first"), F.lit(False))
    stats, small = sized_side(stats.filter(F.col("__n") > 1).select("__ukey", "__first"))

    def add(rows: DataFrame) -> DataFrame:
        rows, own = _unique_key(rows, spec)
        joined = join_on_keys(rows, stats.withColumnRenamed("__ukey", own), [own], small=small)
        return joined.withColumn(flag, broken).drop("__first", *([own] if own != spec.name else []))
    return add


def _checks(df: DataFrame, rules: RuleSet) -> list[tuple[Column, str, str]]:
    """(failed?, column, error) of every rule that a row breaks by itself; last that the scan could not split it."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [c for spec in rules.columns if spec.name in types
              for c in row_rules(spec, F.col(spec.name), types[spec.name], rules)]
    if MALFORMED in types:
        # nothing else of such a row can be judged
        bad = F.col(MALFORMED).isNotNull()
        checks = [(~bad & cond, c, e) for cond, c, e in checks] + [(bad, MALFORMED, S.MSG_MALFORMED_ROW)]
    return checks


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _with_failures(df: DataFrame, failed: Column, checks: list[tuple[Column, str, str]]) -> DataFrame:
    """The rows with ``_failed``, one boolean expression inside the generated code, and ``_failures``, which filters an array.

    Spark evaluates that outside of the generated code, expression by expression: it is only worked out for rows that fail.
    """
    item = T.StructType([T.StructField("column", T.StringType()), T.StructField("error", T.StringType())])
    none = F.array().cast(T.ArrayType(item))
    found = F.filter(F.array(*[F.when(cond, F.struct(F.lit(c).alias("column"), F.lit(e).alias("error")))
                               for cond, c, e in checks]), lambda x: x.isNotNull())
    return df.withColumns({FAILED: failed, FAILURES: F.when(failed, found).otherwise(none) if checks else none})


class Marks:
    """The rules that a row breaks by itself, beside it: whether it breaks any, and which, as bits of long columns."""

    BROKEN, BITS = "__broken", 62

    def __init__(self, df: DataFrame, rules: RuleSet):
        checks = _checks(df, rules)
        bits = [F.when(cond, F.lit(1 << k % self.BITS)).otherwise(F.lit(0)).cast("long") for k, (cond, _, _) in enumerate(checks)]
        words = [bits[k:k + self.BITS] for k in range(0, len(bits), self.BITS)]
        failed = _any([cond for cond, _, _ in checks])
        marked = {f"__rules{k}": F.when(failed, reduce(lambda a, b: a.bitwiseOR(b), w)).otherwise(F.lit(0).cast("long")) for k, w in enumerate(words)}
        self.columns = [self.BROKEN, *marked]
        self.rows = df.withColumns({self.BROKEN: failed, **marked})
        self.checks = [(F.col(f"__rules{k // self.BITS}").bitwiseAND(F.lit(1 << k % self.BITS)) != 0, c, e)
                       for k, (_, c, e) in enumerate(checks)]


def annotate(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The input with ``_failed``, whether the row breaks a rule, and ``_failures``, every (column, error) it breaks."""
    return validate(df, rules).annotated


def missing_columns(df: DataFrame, rules: RuleSet) -> list[str]:
    """Declared columns absent from the input: schema-level failures that reject no row."""
    present = set(df.columns)
    return [c.name for c in rules.columns if c.name not in present]


@dataclass
class Validation:
    """Result of validating one frame. Every output is a lazy DataFrame over ``annotated``."""
    annotated: DataFrame
    rules: RuleSet
    id_cols: list[str]
    missing: list[str] = field(default_factory=list)
    marks: Marks | None = None                                        # what each row breaks by itself
    judged: Callable[[DataFrame], DataFrame] | None = None            # what adds the failures to rows that have their marks

    def typed_view(self, df: DataFrame) -> DataFrame:
        """``df`` with every declared column coerced to its type (NULL where it does not convert)."""
        return df.select(*[self.typed_column(df, name).alias(name) for name in df.columns])

    def typed_column(self, df: DataFrame, name: str) -> Column:
        """A column of ``df``, coerced to its declared type if it has one."""
        spec = self.rules.spec(name)
        return F.col(name) if spec is None else typed(F.col(name), df.schema[name].dataType, spec.dtype, spec.formats)

    def valid(self) -> DataFrame:
        """Rows with no failure, declared columns coerced to their types."""
        return self.typed_view(self.annotated.filter(~F.col(FAILED)).drop(FAILED, FAILURES))

    def rejected(self) -> DataFrame:
        """Rows with at least one failure, raw values kept, failures attached."""
        return self.annotated.filter(FAILED).drop(FAILED)

    def failures(self) -> DataFrame:
        """V11 + V13: one row per (row, column, error); schema-level ones have null row ids."""
        rows = (self.annotated.filter(FAILED).select(*self.id_cols, F.explode(FAILURES).alias("_f"))
                .select(*self.id_cols, F.col("_f.column").alias("column"), F.col("_f.error").alias("error")))
        if not self.missing:
            return rows
        spark = self.annotated.sparkSession
        id_fields = [f for f in rows.schema.fields if f.name in set(self.id_cols)]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in id_fields]
                              + [T.StructField("column", T.StringType()), T.StructField("error", T.StringType())])
        extra = spark.createDataFrame([tuple([None] * len(id_fields)) + (m, S.MSG_MISSING_COLUMN)
                                       for m in self.missing], schema)
        return rows.unionByName(extra)

    def failures_by_rule(self) -> DataFrame:
        """Failure counts per (column, error)."""
        return self.failures().groupBy("column", "error").agg(F.count(F.lit(1)).alias("failures"))

    def failures_top(self, n: int = 100) -> DataFrame:
        """The first ``n`` failures in (row, column, error) order (TakeOrdered, no global sort)."""
        order = [F.col(c).asc_nulls_first() for c in self.id_cols] + [F.col("column"), F.col("error")]
        return self.failures().orderBy(*order).limit(n)

    def summary(self) -> DataFrame:
        """Total, valid, invalid, success_rate (0 when empty), in one aggregation."""
        agg = self.annotated.agg(F.count(F.lit(1)).alias("total_rows"),
                                 F.count_if(~F.col(FAILED)).alias("valid_rows"))
        return agg.select(
            "total_rows", "valid_rows",
            (F.col("total_rows") - F.col("valid_rows")).alias("invalid_rows"),
            F.coalesce(F.try_divide(F.col("valid_rows").cast("double"), F.nullif(F.col("total_rows"), F.lit(0))),
                       F.lit(0.0)).alias("success_rate"))

    def control_total(self, expected: float | None, amount: str = S.AMOUNT_COLUMN) -> DataFrame:
        """Exact decimal total of ``amount`` over the valid rows vs an expected value."""
        total = self.valid().agg(F.sum(F.col(amount).try_cast("decimal(38,10)")).alias("_t"))
        actual = F.coalesce(F.col("_t"), F.lit(0).cast("decimal(38,10)"))
        if expected is None:
            ok = F.lit(True)
            exp = F.lit(None).cast("double")
        else:
            exp = F.lit(float(expected))
            # exact decimal difference: 10.00 vs 10.01 is 0.01 (a double difference is 0.00999...)
            exp_dec = F.lit(repr(float(expected))).cast("decimal(38,10)")
            ok = F.abs(actual - exp_dec) < F.lit(str(S.CHECKSUM_TOLERANCE)).cast("decimal(38,10)")
        return total.select(exp.alias("expected_total"), actual.cast("double").alias("actual_total"),
                            ok.alias("checksum_ok"), _money_text(actual).alias("actual_text"))

    def checksum_warnings(self, expected: float | None, amount: str = S.AMOUNT_COLUMN) -> DataFrame:
        """A warning row when the control total does not match (never fatal)."""
        ct = self.control_total(expected, amount)
        msg = F.concat(F.lit(f"Checksum mismatch: expected {expected!r}, got "), F.col("actual_text"))
        return ct.filter(~F.col("checksum_ok")).select(msg.alias("message"))


def validate(df: DataFrame, rules: RuleSet | None = None, id_cols: list[str] | None = None,
             as_of=None, store: bool = False, deal_by: str | None = None) -> Validation:
    """Validate ``df`` against ``rules`` (default: the operations rule set).

    With ``store`` the rows are written to the checkpoint folder with their marks, so that row rules are worked out once; dealt by
    ``deal_by``, if it is there, so that uniqueness or dedup by it doesn't shuffle them.
    """
    rules = rules or default_rules(as_of)
    if id_cols is None:
        id_cols = ["row"] if "row" in df.columns else []
    unique = [s for s in rules.columns if s.unique and s.name in df.columns and rules.wants("unique")]
    missing = missing_columns(df, rules)
    if not unique and not store:
        checks = _checks(df, rules)
        return Validation(_with_failures(df, _any([cond for cond, _, _ in checks]), checks), rules, list(id_cols), missing)
    marks = Marks(df, rules)
    if store:
        marks.rows = materialize_by(marks.rows, deal_by).frame if deal_by in df.columns else materialize(marks.rows)[0]
    flags = {f"__dup_{s.name}": s for s in unique}
    adders = [_unique_flag(marks.rows, s, rules, flag) for flag, s in flags.items()]
    whole = F.col(MALFORMED).isNull() if MALFORMED in df.columns else F.lit(True)
    repeated = [(whole & F.col(flag), s.name, S.MSG_UNIQUE) for flag, s in flags.items()]
    rest = len(marks.checks) - (MALFORMED in df.columns)             # that a row could not be split comes last
    checks = marks.checks[:rest] + repeated + marks.checks[rest:]

    def judged(rows: DataFrame) -> DataFrame:
        for add in adders:
            rows = add(rows)
        failed = _any([F.col(Marks.BROKEN), *[cond for cond, _, _ in repeated]])
        return _with_failures(rows, failed, checks).drop(*flags, *marks.columns)
    return Validation(judged(marks.rows), rules, list(id_cols), missing, marks, judged)


def duplicate_warning(n_duplicates: DataFrame, column: str = "duplicates") -> DataFrame:
    """``Found n duplicate operation IDs`` when n > 0 (input: one-row frame with the count)."""
    return (n_duplicates.filter(F.col(column) > 0)
            .select(F.format_string("Found %d duplicate operation IDs", F.col(column)).alias("message")))
