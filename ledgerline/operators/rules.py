"""Declarative validation rules.

A ``RuleSet`` is a list of ``ColumnSpec``: declared type (coercion), nullability, value checks
and uniqueness. Value checks skip nulls (a null fails only ``not_null``); a value that cannot be
coerced fails only ``coerce``. Everything compiles to native Column expressions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S


# text that counts as a number (Spark's own cast also takes suffixes such as 12.5d)
NUMBER = {"double": r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$",
          "long": r"^\s*[+-]?\d+\s*$"}
DATED = r"^\s*[+-]?\d{4,}"


@dataclass(frozen=True)
class Check:
    """A value check: ``test(typed_column)`` is true when the value passes."""
    error: str
    test: Callable[[Column], Column]
    kind: str = "check"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str = "string"          # timestamp | double | long | string
    nullable: bool = True
    unique: bool = False
    checks: tuple[Check, ...] = ()
    formats: tuple[str, ...] = ()   # extra text layouts tried before the plain cast (timestamps)


@dataclass(frozen=True)
class RuleSet:
    columns: tuple[ColumnSpec, ...]
    unique_mode: str = "reject_all"          # reject_all | keep_first
    order_by: tuple[str, ...] = ()           # row order for keep_first (ascending, nulls first)
    kinds: frozenset[str] | None = None      # restrict to some rule kinds (None = all)

    def only(self, *kinds: str) -> "RuleSet":
        return replace(self, kinds=frozenset(kinds))

    def wants(self, kind: str) -> bool:
        return self.kinds is None or kind in self.kinds

    def spec(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name == name), None)


def _as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp")


def less_equal(bound, error: str, kind: str = "max") -> Check:
    return Check(error, lambda c: c <= bound, kind)


def greater_than(bound, error: str, kind: str = "positive") -> Check:
    return Check(error, lambda c: c > bound, kind)


def matches(pattern: str, error: str, kind: str = "regex") -> Check:
    return Check(error, lambda c: c.rlike(pattern), kind)


def isin(values: list[str], error: str | None = None) -> Check:
    vals = list(values)
    return Check(error or S.isin_message(vals), lambda c: c.isin(*vals), "isin")


def not_before(as_of=None, error: str = S.MSG_FUTURE_DATE) -> Check:
    bound = _as_of_col(as_of)
    return Check(error, lambda c: c <= bound, "max_date")


def default_rules(as_of=None, unique_mode: str = "reject_all", order_by: list[str] | None = None) -> RuleSet:
    """The operations-file rule set: 10 typed required columns, 9 value checks, one unique key."""
    cols = (
        ColumnSpec("fecha_operacion", "timestamp", False, checks=(not_before(as_of),)),
        ColumnSpec("numero_operacion", "string", False, unique=True,
                   checks=(matches(S.OP_ID_PATTERN, S.MSG_OP_ID_FORMAT, "regex_id"),)),
        ColumnSpec("tipo_operacion", "string", False, checks=(isin(S.TIPO_VALUES),)),
        ColumnSpec("monto", "double", False,
                   checks=(greater_than(F.lit(0), S.MSG_AMOUNT_POSITIVE, "positive"),
                           less_equal(F.lit(S.MAX_AMOUNT), S.MSG_AMOUNT_MAX, "max_amount"))),
        ColumnSpec("moneda", "string", False, checks=(isin(S.MONEDA_VALUES),)),
        ColumnSpec("cuenta_origen", "string", False,
                   checks=(matches(S.ACCOUNT_PATTERN, S.MSG_ACCOUNT_FORMAT, "regex_account"),)),
        ColumnSpec("banco_origen", "string", False),
        ColumnSpec("descripcion", "string", False),
        ColumnSpec("estado", "string", False, checks=(isin(S.ESTADO_VALUES),)),
        ColumnSpec("canal", "string", False, checks=(isin(S.CANAL_VALUES),)),
    )
    return RuleSet(cols, unique_mode, tuple(order_by or ()))


def typed(c: Column, raw_type, dtype: str, formats: tuple[str, ...] = ()) -> Column:
    """Lenient coercion: a value that does not convert becomes NULL (ANSI-safe ``try_cast``).

    For timestamps, ``formats`` are tried first (``try_to_timestamp``), then the plain cast.
    """
    target = S.SPARK_TYPES[dtype]
    if raw_type == target:
        return c
    text = raw_type == T.StringType()
    if dtype == "timestamp" and text:
        # a bare time of day would become a time of the day the job runs
        dated = F.when(c.rlike(DATED), c.try_cast(target))
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats], dated) if formats else dated
    if text and dtype in NUMBER:
        return F.when(c.rlike(NUMBER[dtype]), F.trim(c).try_cast(target))
    return c.try_cast(target)


def row_rules(spec: ColumnSpec, raw: Column, raw_type, rules: RuleSet) -> list[tuple[Column, str, str]]:
    """(failed?, column, error) triples of the row-local rules of one column."""
    out: list[tuple[Column, str, str]] = []
    val = typed(raw, raw_type, spec.dtype, spec.formats)
    if rules.wants("coerce") and S.SPARK_TYPES[spec.dtype] != raw_type:
        out.append((raw.isNotNull() & val.isNull(), spec.name, S.coerce_message(spec.dtype)))
    if not spec.nullable and rules.wants("not_null"):
        out.append((raw.isNull(), spec.name, S.MSG_NOT_NULL))
    for chk in spec.checks:
        if rules.wants(chk.kind) or rules.wants("check"):
            out.append((val.isNotNull() & ~chk.test(val), spec.name, chk.error))
    return out


__all__ = ["Check", "ColumnSpec", "RuleSet", "default_rules", "less_equal", "greater_than", "matches", "isin",
           "not_before", "typed", "row_rules"]
