"""Content hash: SHA-256 over the Python ``str()`` text of a few fields, hex prefix.

The text encoding is byte-exact with Python's ``str`` for the types in use:
strings as is, doubles in shortest repr (``100.0``; plain digits from 1e-4 up to 1e16, an exponent of
two digits or more outside), timestamps as ``YYYY-MM-DD HH:MM:SS`` with exactly six fraction digits
when the microseconds are not zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING_NULL_TEXT = "None"
DOUBLE_NULL_TEXT = "nan"
TIMESTAMP_NULL_TEXT = "NaT"


def _let(value: Column, body) -> Column:
    """``body`` over a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _shortest(c: Column, digits: Column, exponent: Column, sizes: Column) -> Column:
    """The fewest of so many digits that read back as the same double: struct(digits, exponent of the first one)."""
    n = F.length(digits)

    def rounded(k):
        """The digits at size k: the nearer neighbour, a half to even, and the other one."""
        unit = F.rpad(F.lit("1"), F.greatest(n - k, F.lit(0)) + 1, F.lit("0")).cast("decimal(20,0)")
        whole = digits.cast("decimal(20,0)")
        up = whole + F.call_function("div", unit, F.lit(2).cast("decimal(20,0)"))
        low, near = F.call_function("div", whole, unit), F.call_function("div", up, unit)
        near = near - F.when((up % unit == 0) & (unit > 1), near % 2).otherwise(0)
        return _let(F.struct(low.alias("low"), near.alias("near")), lambda x: F.array(x["near"], x["low"] + x["low"] + 1 - x["near"]))

    def same(k, text):
        first = exponent + F.length(text) - k               # a carry makes one digit more
        back = F.concat(F.substring(text, 1, 1), F.lit("."), F.substring(text, 2, 20), F.lit("E"), first.cast("string")).try_cast("double")
        return F.when((n > k) & (back == c), F.struct(F.regexp_replace(text, "0+$", "").alias("digits"), first.alias("exponent")))
    tries = F.flatten(F.transform(sizes, lambda k: F.transform(rounded(k), lambda r: same(k, r.cast("string")))))
    return F.coalesce(F.get(F.filter(tries, lambda x: x.isNotNull()), F.lit(0)), F.struct(digits.alias("digits"), exponent.alias("exponent")))


def _layout(digits: Column, exponent: Column) -> Column:
    """Python's layout of a number's digits and the exponent of the first one: plain from 1e-4 up to 1e16."""
    n, point = F.length(digits), exponent + 1                   # digits before the point
    plain = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
             .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
             .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n))))
    power = F.concat(F.when(n > 1, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), n)))
                     .otherwise(digits), F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
                     F.lpad(F.abs(exponent).cast("string"), F.greatest(F.length(F.abs(exponent).cast("string")), F.lit(2)), F.lit("0")))
    return F.when((exponent >= -4) & (exponent < 16), plain).otherwise(power)


def double_text(c: Column) -> Column:
    """Text of a double as Python's ``str`` prints it: the shortest digits that read back equal, in Python's layout.

    Spark prints ``1.23456789E7`` outside 1e-3..1e7, and for some doubles of more than 15 digits more of them than it
    must. Digits and exponent are taken from its scientific form; where there are many, the fewest that do are sought.
    """
    size = F.abs(c)
    spark_text = size.cast("string")
    mantissa = F.substring_index(spark_text, "E", 1)
    exponent = F.substring_index(spark_text, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    # a plain text as digits and exponent: those before the point, or the zeros behind it
    small = F.regexp_replace(digits, "^0+", "")
    at = F.when(size >= 1, F.instr(spark_text, ".") - 2).otherwise(F.length(small) - F.length(digits))
    scientific, many = spark_text.contains("E"), F.length(spark_text) > 16
    # an integer below 2^63 has all its digits at hand, and the smallest doubles have fewer than the JVM prints
    integer = size.between(2.0 ** 53, 2.0 ** 63 - 1024)
    exact = F.when(integer, size).cast("bigint").cast("string")
    parts = F.when(integer, F.struct(exact.alias("digits"), (F.length(exact) - 1).alias("exponent"))).when(scientific, F.struct(digits.alias("digits"), exponent.alias("exponent"))).otherwise(F.struct(small.alias("digits"), at.alias("exponent")))
    tiny = (size > 0) & (size < 2.3e-308)
    sizes = F.when(tiny, F.sequence(F.lit(1), F.lit(17))).otherwise(F.array(*map(F.lit, (15, 16, 17))))
    fewest = _let(parts, lambda p: _shortest(size, p["digits"], p["exponent"], sizes))
    sought = _let(fewest, lambda p: _layout(p["digits"], p["exponent"]))
    text = F.when(tiny | many, sought).when(scientific, _layout(digits, exponent)).otherwise(spark_text)
    negative = (c < 0) | (c.cast("string").startswith("-"))
    return (F.when(F.isnan(c), F.lit("nan")).when(spark_text == "Infinity", F.when(negative, F.lit("-inf")).otherwise(F.lit("inf")))
            .otherwise(F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), text)))


def python_text(c: Column, dtype: T.DataType, string_null: str = STRING_NULL_TEXT) -> Column:
    """Text of a value as Python's ``str`` prints it (nulls as pandas prints them)."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.unix_micros(c.cast("timestamp")) % F.lit(1_000_000) == 0
        text = F.when(whole, F.date_format(c, "yyyy-MM-dd HH:mm:ss")) \
                .otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        return F.coalesce(text, F.lit(TIMESTAMP_NULL_TEXT))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.coalesce(double_text(c.cast("double")), F.lit(DOUBLE_NULL_TEXT))
    if isinstance(dtype, T.DateType):
        return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(TIMESTAMP_NULL_TEXT))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.when(c, F.lit("True")).otherwise(F.lit("False")), F.lit(STRING_NULL_TEXT))
    return F.coalesce(c.cast("string"), F.lit(string_null))


def content_hash_column(schema: T.StructType, columns: list[str], hash_len: int = 16, separator: str = "",
                        string_null: str = STRING_NULL_TEXT) -> Column:
    """``substring(sha2(text(c1) || sep || text(c2) ..., 256), 1, hash_len)`` over the present columns."""
    present = [f for f in schema.fields if f.name in set(columns)]
    by_name = {f.name: f for f in present}
    parts = [python_text(F.col(n), by_name[n].dataType, string_null) for n in columns if n in by_name]
    if not parts:
        text = F.lit("")
    elif separator:
        text = F.concat_ws(separator, *parts)
    else:
        text = F.concat(*parts)
    return F.substring(F.sha2(text, 256), 1, hash_len)
