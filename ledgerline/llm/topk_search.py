"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every candidate, in blocks of vectors. The k-th best entry of each
query is located without sorting: entries are ordered by (score, smaller id first), each pass
counts the entries of a query in the digits of that order that are still open, the counts of all
blocks are added up by query, and the digit that holds the k-th entry is opened for the next pass.
Score digits come first (wide bins, then finer ones down to single scores), then the digits of the
id among the entries that tie with the k-th score. At the end each query has an exact threshold,
(score, id), and exactly k entries reach it; a last pass scores again and keeps those.

A block only reports digits down to its own k-th entry: lower ones can't hold the global k-th. So a
query gets at most k counts from a block and pass, whatever the ties; nothing grows with the number
of equal vectors. Queries and candidates meet block by block on an equi-join of slot numbers; no
block, histogram or result is collected, and none passes through the driver as a broadcast: Spark
sizes a side of a join without the copies that ``explode`` makes of it, so all joins here are
sort-merge joins, whatever the session's broadcast limit. Scores are computed in doubles when they are exact
(|score| < 2^53), else in Python integers, saturating at the range of a long.

Rows: a vector that is null, or holds null or non-finite components, takes no part. Vectors of
different lengths are compared as if the shorter one ended in zeros. Null ids take no part. Rows
that repeat an id are separate candidates, except that a query never meets a row of its own id;
repeated query ids are one query, with the first vector in component order. Extra columns are
ignored. An empty table, or one without queries, gives an empty result; a query with fewer than k
candidates gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.scratch import Scratch, rename_clear

BLOCK = 4096                # candidates in a block
QUERY_BLOCK = 512           # queries in a block
LONG = 1 << 63
STEP_BITS = 7               # bits of the order that one pass opens: 128 bins inside the open one
NONE = -(1 << 62)           # no bin opened yet


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component (saturating at the range of a long), held as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(rows: list[list[float]]) -> np.ndarray:
    width = max(map(len, rows), default=0)
    m = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        m[k, :len(r)] = r
    return m


def _pack(kind: str, size: int):
    """Vectors of a partition as blocks: ids, rows and columns of the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []

        def block():
            m = _matrix(rows)
            return pa.RecordBatch.from_pydict({
                f"{kind}_ids": [np.array(ids, np.int64).tobytes()], f"{kind}_width": pa.array([m.shape[1]], pa.int32()),
                kind: [m.tobytes()]})
        for b in batches:
            for i, v in zip(b.column("id").to_pylist(), b.column("v").to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(ids) == size:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()
    return run


def _read(ids: bytes, width: int, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(body, np.float64).reshape(len(i), width)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of quantised vectors as int64, exact or saturated."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    top = (np.abs(q).max(initial=0.0)) * (np.abs(c).max(initial=0.0)) * max(width, 1)
    if top < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q).dot(whole(c).T) if width else np.zeros((len(q), len(c)), object)
    return np.vectorize(lambda s: max(-LONG, min(LONG - 1, s)), otypes=[np.int64])(exact)


def _need_cut(digit: np.ndarray, need: int) -> np.ndarray:
    """Digits down to the block's own entry of rank ``need``; lower ones can't hold the global one."""
    if len(digit) > need:
        digit = digit[digit >= np.partition(digit, len(digit) - need)[len(digit) - need]]
    return digit


def _counts(stage: str, bits: int, last_bits: int):
    """Histogram of the open entries of each query over one block of candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                qid, q = _read(row["q_ids"], row["q_width"], row["q"])
                cid, c = _read(row["c_ids"], row["c_width"], row["c"])
                need, score, low = np.frombuffer(row["state"], np.int64).reshape(3, -1)
                s = scores(q, c)
                rows, digits, counts = [], [], []
                for r in range(len(qid)):
                    own = cid != qid[r]
                    # larger keys are better: the score itself, then the complement of the id
                    key = s[r][own] if stage == "score" else ~cid[own & (s[r] == score[r])]
                    if low[r] != NONE:
                        key = key[(key >> last_bits) == low[r]]
                    d, n = np.unique(_need_cut(key >> bits, int(need[r])), return_counts=True)
                    rows.append(np.full(len(d), qid[r]))
                    digits.append(d)
                    counts.append(n)
                yield pa.RecordBatch.from_pydict({"query_id": np.concatenate(rows), "digit": np.concatenate(digits),
                                                  "n": np.concatenate(counts)})
    return run


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries that reach the threshold (score, id) of their query, one pair of blocks at a time."""
    for b in batches:
        for row in b.to_pylist():
            qid, q = _read(row["q_ids"], row["q_width"], row["q"])
            cid, c = _read(row["c_ids"], row["c_width"], row["c"])
            _, score, low = np.frombuffer(row["state"], np.int64).reshape(3, -1)
            s = scores(q, c)
            reach = (s > score[:, None]) | ((s == score[:, None]) & (cid[None, :] <= low[:, None]))
            r, x = np.nonzero(reach & (cid[None, :] != qid[:, None]))
            yield pa.RecordBatch.from_pydict({"query_id": qid[r], "vec_id": cid[x], "score": s[r, x]})


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of a partition as blocks, with their state."""
    pack = _pack("q", QUERY_BLOCK)
    for b in batches:
        for at in range(0, b.num_rows, QUERY_BLOCK):
            part = b.slice(at, QUERY_BLOCK)
            block = next(pack(iter([part])))
            state = np.array([part.column(c).to_pylist() for c in ("need", "score", "low")], np.int64)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array([state.tobytes()], pa.binary())],
                                             names=[*block.schema.names, "state"])


def _merged(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A sort-merge join: neither side is broadcast, however small Spark takes it to be."""
    return left.join(right.hint("merge"), on, how)


def _passes(bound: float) -> list[int]:
    """Shifts of the passes over keys of absolute value up to ``bound``: coarse to single values."""
    top = max(int(bound), 1).bit_length()
    return [*range(top - STEP_BITS, 0, -STEP_BITS), 0]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """The k best candidates of each query: (query_id, rank, vec_id, score); see the module text for all cases."""
    if k < 1:
        raise ValueError("k must be at least 1")
    scratch = Scratch(vectors.sparkSession, "topk")

    def usable(df: DataFrame) -> DataFrame:
        df = rename_clear(df, {"id": id_col, "v": vector_col})
        return df.filter(F.col("id").isNotNull() & _usable(F.col("v"))).select(
            F.col("id").cast("long").alias("id"), quantised(F.col("v"), scale).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    q = scratch.store(usable(queries).groupBy("id").agg(F.min("v").alias("v")), "queries")
    n_queries, q_norm = q.agg(F.count(F.lit(1)), F.max(norm)).first()
    cand = usable(vectors)
    c_norm, c_id = cand.agg(F.max(norm), F.max(F.abs(F.col("id").cast("double")))).first()
    blocks = scratch.store(cand.mapInArrow(_pack("c", BLOCK), "c_ids binary, c_width int, c binary"), "blocks")
    n_slots = max(1, blocks.count())
    slotted = blocks.withColumn("slot", F.pmod(F.xxhash64("c_ids"), F.lit(n_slots)))

    def pairs(state: DataFrame) -> DataFrame:
        """Every block of candidates next to every block of queries that ``state`` holds."""
        packed = _merged(q, state, "id").repartition(max(1, -(-n_queries // QUERY_BLOCK))).mapInArrow(
            _pack_queries, "q_ids binary, q_width int, q binary, state binary")
        slot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slots - 1).cast("long")))
        # the join holds the right side's rows of a slot: a few blocks of candidates, not all queries
        return _merged(packed.withColumn("slot", slot), slotted, "slot")

    def refine(state: DataFrame, stage: str, bound: float, name: str) -> DataFrame:
        """Locate the key of rank ``need``: the state with ``low`` = that key, and the entries that tie with it."""
        last = 0
        for bits in _passes(min(bound, float(LONG - 1))):
            counts = pairs(state.select("id", "need", "score", "low")).mapInArrow(
                _counts(stage, bits, last), "query_id long, digit long, n long")
            total = counts.groupBy("query_id", "digit").agg(F.sum("n").alias("n"))
            best_first = W.partitionBy("query_id").orderBy(F.desc("digit"))
            total = total.withColumn("upto", F.sum("n").over(best_first.rowsBetween(W.unboundedPreceding, 0)))
            # without such a digit, a query has fewer entries than it needs; it stays out and takes all
            found = _merged(total.withColumnRenamed("query_id", "id"), state.select("id", "need", "score"), "id").filter(
                (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            state = scratch.store(found.select(
                "id", (F.col("need") - F.col("upto") + F.col("n")).alias("need"), "score", F.col("digit").alias("low"),
                F.col("n").alias("ties")), f"{name}-{bits}")
            last = bits
        return state

    none = F.lit(NONE).cast("long")
    start = q.select("id", F.lit(k).cast("long").alias("need"), F.lit(0).cast("long").alias("score"), none.alias("low"))
    kth = refine(start, "score", (q_norm or 0.0) * (c_norm or 0.0) + 1, "score")
    tied = kth.filter("ties > need").select("id", "need", F.col("low").alias("score"), none.alias("low"))
    last_id = refine(tied, "id", c_id or 0.0, "id").select("id", F.bitwise_not("low").alias("last_id"))
    kth_of_all = _merged(q.select("id"), kth.select("id", F.col("low").alias("kth")), "id", "left")
    limits = _merged(kth_of_all, last_id, "id", "left").select(
        "id", F.lit(k).cast("long").alias("need"), F.coalesce("kth", F.lit(-LONG).cast("long")).alias("score"),
        F.coalesce("last_id", F.lit(LONG - 1).cast("long")).alias("low"))
    best = pairs(limits).mapInArrow(_select, "query_id long, vec_id long, score long")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
