"""Synthetic operation records.

Every random draw is a hash of (seed, row id, group): ``md5`` -> 8 hex digits -> uniform in
[0, 1); one md5 serves four draws. Rows are independent, so any partitioning of ``spark.range`` gives the same data and the
same text runs in any SQL engine with ``md5``. Categorical shares, ranges and null rates follow
the operational file model.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schema as S

# Fixed values of the model: category shares and value ranges
TIPO_SHARES = [("DEPOSITO", 0.4), ("RETIRO", 0.3), ("TRANSFERENCIA", 0.3)]
MONEDA_SHARES = [("PEN", 0.85), ("USD", 0.15)]
ESTADO_SHARES = [("COMPLETADA", 0.85), ("PENDIENTE", 0.10), ("FALLIDA", 0.05)]
CANAL_SHARES = [("WEB", 0.40), ("MOBILE", 0.35), ("ATM", 0.15), ("SUCURSAL", 0.10)]
AMOUNT_MIN_CENTS, AMOUNT_SPAN_CENTS = 1_000, 4_999_000          # 10.00 .. 50,000.00
DESTINATION_NULL_RATE = 0.3
WORDS = ["pago", "servicio", "cuenta", "cliente", "factura", "abono", "cargo", "mensual", "proveedor",
         "planilla", "cuota", "reembolso"]
ERROR_KINDS = ["invalid_date", "negative_amount", "null_operation_id", "invalid_state", "missing_account"]
ERROR_STRIDE = 1_000_003       # prime; picks distinct rows as (stride * j + offset) mod n


# Each md5 gives four independent 32-bit draws (hex digits 1-8, 9-16, 17-24, 25-32); every named
# draw is a (group, slot) of one md5(seed:id:group). Spark computes each distinct md5 once per row.
DRAW_SLOTS = {
    "day": ("a", 0), "hour": ("a", 1), "minute": ("a", 2), "amount": ("a", 3),
    "tipo": ("b", 0), "moneda": ("b", 1), "estado": ("b", 2), "canal": ("b", 3),
    "o1": ("c", 0), "o2": ("c", 1), "o3": ("c", 2), "o4": ("c", 3),
    "d1": ("d", 0), "d2": ("d", 1), "d3": ("d", 2), "d4": ("d", 3),
    "dnull": ("e", 0), "bnull": ("e", 1), "bank_o": ("e", 2), "bank_d": ("e", 3),
    "w0": ("f", 0), "w1": ("f", 1), "w2": ("f", 2), "w3": ("f", 3),
    "w4": ("g", 0), "w5": ("g", 1), "dup": ("g", 2), "err": ("g", 3),
    "order": ("h", 0),
}


def draw(seed: int, rid: Column, name: str) -> Column:
    """Uniform double in [0, 1): 32 bits of md5(seed:id:group) at the draw's slot."""
    group, slot = DRAW_SLOTS[name]
    h = F.md5(F.concat(F.lit(f"{seed}:"), rid.cast("string"), F.lit(f":{group}")))
    return F.conv(F.substring(h, 8 * slot + 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def pick(u: Column, shares: list[tuple[str, float]]) -> Column:
    """Category by cumulative share."""
    expr = None
    acc = 0.0
    for value, share in shares[:-1]:
        acc = round(acc + share, 10)
        expr = F.when(u < F.lit(acc), F.lit(value)) if expr is None else expr.when(u < F.lit(acc), F.lit(value))
    return expr.otherwise(F.lit(shares[-1][0]))


def randint(u: Column, lo: int, hi: int) -> Column:
    """Integer in [lo, hi) from a uniform draw."""
    return F.lit(lo) + F.floor(u * F.lit(hi - lo)).cast("long")


def _account(seed: int, rid: Column, prefix: str) -> Column:
    parts = [F.lpad(randint(draw(seed, rid, f"{prefix}1"), 100, 999).cast("string"), 3, "0"),
             F.lpad(randint(draw(seed, rid, f"{prefix}2"), 1_000_000, 9_999_999).cast("string"), 7, "0"),
             randint(draw(seed, rid, f"{prefix}3"), 0, 9).cast("string"),
             F.lpad(randint(draw(seed, rid, f"{prefix}4"), 10, 99).cast("string"), 2, "0")]
    return F.concat_ws("-", *parts)


def _rows(base: DataFrame, rid: Column, as_of: str, seed: int) -> list[Column]:
    """The columns of the operation with id ``rid`` (a pure function of the id)."""
    start = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.lit(30 * 86400)
    secs = (start + randint(draw(seed, rid, "day"), 0, 31) * 86400 + randint(draw(seed, rid, "hour"), 0, 24) * 3600
            + randint(draw(seed, rid, "minute"), 0, 60) * 60)
    words = F.array(*[F.lit(w) for w in WORDS])
    desc = F.concat(F.concat_ws(" ", *[F.element_at(words, (randint(draw(seed, rid, f"w{i}"), 0, len(WORDS)) + 1)
                                                     .cast("int")) for i in range(6)]), F.lit("."))
    banks = F.array(*[F.lit(b) for b in S.BANKS])
    bank_o = F.element_at(banks, (randint(draw(seed, rid, "bank_o"), 0, len(S.BANKS)) + 1).cast("int"))
    bank_d = F.element_at(banks, (randint(draw(seed, rid, "bank_d"), 0, len(S.BANKS)) + 1).cast("int"))
    cents = F.lit(AMOUNT_MIN_CENTS) + F.floor(draw(seed, rid, "amount") * F.lit(AMOUNT_SPAN_CENTS)).cast("long")
    return [
        F.timestamp_seconds(secs).alias("fecha_operacion"),
        F.format_string("OP-%08d", rid + 1).alias("numero_operacion"),
        pick(draw(seed, rid, "tipo"), TIPO_SHARES).alias("tipo_operacion"),
        (cents.cast("double") / F.lit(100.0)).alias("monto"),
        pick(draw(seed, rid, "moneda"), MONEDA_SHARES).alias("moneda"),
        _account(seed, rid, "o").alias("cuenta_origen"),
        F.when(draw(seed, rid, "dnull") < F.lit(DESTINATION_NULL_RATE), F.lit(None).cast("string"))
        .otherwise(_account(seed, rid, "d")).alias("cuenta_destino"),
        bank_o.alias("banco_origen"),
        F.when(draw(seed, rid, "bnull") < F.lit(DESTINATION_NULL_RATE), F.lit(None).cast("string"))
        .otherwise(bank_d).alias("banco_destino"),
        desc.alias("descripcion"),
        pick(draw(seed, rid, "estado"), ESTADO_SHARES).alias("estado"),
        pick(draw(seed, rid, "canal"), CANAL_SHARES).alias("canal"),
    ]


def generate_operations(spark: SparkSession, n_rows: int, as_of: str, seed: int = 42,
                        num_partitions: int | None = None) -> DataFrame:
    """``n_rows`` clean operations with ids OP-00000001.., dates in the 30 days before ``as_of``."""
    base = spark.range(0, n_rows, 1, num_partitions) if num_partitions else spark.range(n_rows)
    return base.select(F.col("id").alias("gen_id"), *_rows(base, F.col("id"), as_of, seed))


def inject_duplicates(df: DataFrame, n_rows: int, rate: float, seed: int = 42, as_of: str | None = None) -> DataFrame:
    """Append ``int(n * rate)`` exact copies of rows drawn with replacement.

    Copy ``j`` repeats row ``floor(u(j) * n)``. Rows are a pure function of their id, so with
    ``as_of`` the copies are generated straight from the drawn ids (no join, no second pass over
    the originals); without it they are fetched from ``df`` by an equi-join on ``gen_id``.
    """
    k = int(n_rows * rate)
    originals = df.withColumn("source_id", F.col("gen_id")).withColumn("is_copy", F.lit(False))
    if k == 0:
        return originals
    spark = df.sparkSession
    picks = spark.range(k).select(F.col("id").alias("copy_no"),
                                  randint(draw(seed, F.col("id"), "dup"), 0, n_rows).alias("source_id"))
    if as_of is not None:
        copies = picks.select((F.lit(n_rows) + F.col("copy_no")).alias("gen_id"),
                              *_rows(picks, F.col("source_id"), as_of, seed), "source_id",
                              F.lit(True).alias("is_copy"))
    else:
        copies = (picks.join(df.withColumnRenamed("gen_id", "source_id"), "source_id", "inner")
                  .withColumn("gen_id", F.lit(n_rows) + F.col("copy_no")).drop("copy_no")
                  .withColumn("is_copy", F.lit(True)))
    return originals.unionByName(copies)


def _stride(n: int) -> int:
    s = ERROR_STRIDE
    while math.gcd(s, n) != 1:
        s += 2
    return s


def inject_errors(df: DataFrame, n_rows: int, rate: float, seed: int = 42) -> DataFrame:
    """``int(n * rate)`` distinct rows get one of five errors.

    The chosen rows are ``(stride * j + offset) mod n`` for j < k, stride coprime to n. Each row
    finds its own j with the modular inverse of the stride (j = (id - offset) * inv mod n) and is
    chosen iff j < k: exact count, distinct rows, no join, no sort, no list on the driver.
    """
    k = int(n_rows * rate)
    if k == 0:
        return df.withColumn("error_kind", F.lit(None).cast("string"))
    stride = _stride(n_rows)
    inv = pow(stride, -1, n_rows)
    offset = seed % n_rows
    dec = "decimal(38,0)"
    j = F.pmod((F.col("gen_id") - F.lit(offset)).cast(dec) * F.lit(inv).cast(dec), F.lit(n_rows).cast(dec))
    kinds = F.array(*[F.lit(e) for e in ERROR_KINDS])
    kind = F.element_at(kinds, (randint(draw(seed, F.col("gen_id"), "err"), 0, len(ERROR_KINDS)) + 1).cast("int"))
    marked = df.withColumn("error_kind", F.when(j < F.lit(k), kind))
    e = F.col("error_kind")
    return marked.select(
        *[c for c in df.columns if c not in ("fecha_operacion", "monto", "numero_operacion", "estado",
                                              "cuenta_origen")],
        F.when(e == "invalid_date", F.lit("FECHA_INVALIDA"))
        .otherwise(F.date_format("fecha_operacion", "yyyy-MM-dd HH:mm:ss")).alias("fecha_operacion"),
        F.when(e == "negative_amount", -F.abs(F.col("monto"))).otherwise(F.col("monto")).alias("monto"),
        F.when(e == "null_operation_id", F.lit(None).cast("string")).otherwise(F.col("numero_operacion"))
        .alias("numero_operacion"),
        F.when(e == "invalid_state", F.lit("ESTADO_DESCONOCIDO")).otherwise(F.col("estado")).alias("estado"),
        F.when(e == "missing_account", F.lit(None).cast("string")).otherwise(F.col("cuenta_origen"))
        .alias("cuenta_origen"),
        e.alias("error_kind"))


def generate_operational_file(spark: SparkSession, n_rows: int, as_of: str, duplicate_rate: float = 0.05,
                              error_rate: float = 0.02, seed: int = 42, shuffle: bool = False) -> DataFrame:
    """S7 + S8 + S9: clean rows, then copies, then errors over all ``n + copies`` rows, then the
    content hash of the final values (a missing id hashes as ``None``, a bad date as its text).

    ``shuffle`` mixes the copies in among the rows (the file order a keep-first dedup sees): rows are
    sorted by a hash draw of their id, a range-partitioned sort, never one task.
    """
    from ledgerline.operators.dedup import with_content_hash
    clean = generate_operations(spark, n_rows, as_of, seed)
    with_dups = inject_duplicates(clean, n_rows, duplicate_rate, seed, as_of=as_of)
    total = n_rows + int(n_rows * duplicate_rate)
    out = with_content_hash(inject_errors(with_dups, total, error_rate, seed), reuse=False)
    if shuffle:
        out = out.orderBy(draw(seed, F.col("gen_id"), "order"), F.col("gen_id"))
    return out
