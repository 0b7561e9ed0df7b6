"""SimHash near-duplicates: fingerprints that differ in at most ``bits`` bits, found by a grid of segment bit counts.

1. *Fingerprints*: every word n-gram of the lower-cased text, repeats included, is hashed (XXH64, seed 42); a bit of
   the fingerprint is set if it is set in more than half of the hashes. Bits are counted eight at a time: each of eight
   masks leaves one bit in every byte of a hash, and up to 255 such hashes add up without a carry.
2. *Vertices*: distinct fingerprints with their smallest document. Equal fingerprints are one vertex from here on.
3. *Embedding*: a fingerprint is cut into 32 segments of two bits; the bit counts of the segments are a point with
   coordinates 0 to 2. A differing bit moves one coordinate by at most one, so the Manhattan distance of two points is
   a lower bound of the fingerprints' distance.
4. *Grid range join*: points within the Manhattan distance 2 are sought. The first 16 coordinates are a cell of one
   grid, the last 16 of another. If the pair is at most one step apart in the first half, one of the two lies in the
   cell of the other or in a cell one step up along one axis: each point is joined, as a home row, with the visitors of
   its cell, who come from the same cell and from the cells one step below (17 at most). Otherwise it is two steps
   apart in the first half and none in the second, and the two share their cell of the second grid. Both cases are one
   equi-join on the cell, so every pair meets once, and a hot cell is a skewed join that Spark splits. The bound on
   the other half, then the exact number of differing bits, are conditions of that join.
5. *Classes*: connected components of the links (large-star / small-star), brought back to the documents.

Everything after step 1 are DataFrame operations over one row per distinct fingerprint.

Rows: a null or blank text has the fingerprint zero, which links like any other; with fewer than n words the whole
sequence is the only n-gram. A null id takes no part in links and gets a null class. Repeated rows and several texts
under one id are vertices like others: all rows of an id get the class of their own fingerprint. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.components import components
from ledgerline.llm.scratch import Scratch, rename_clear

SEED = 42
MAX_BITS = 2                      # what the two grids are made for
LANES = np.uint64(0x0101010101010101)
GRAMS = 200_000                   # hashes whose bits are counted at a time
EVEN = 0x5555555555555555
HALF = 0xFFFFFFFF
DROP_SPACE = bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\v\f\r", b"     "))


def gram_hashes(text: bytes, n: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of all word n-grams of a text, words joined by one space, in runs of at most ``GRAMS``."""
    words = text.translate(DROP_SPACE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return
    flat = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lens + 1) - lens - 1
    count = max(1, len(words) - n + 1)
    ends = (starts + lens)[min(n, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    for k in range(0, count, GRAMS):
        s, e = starts[k:min(k + GRAMS, count)].tolist(), ends[k:k + GRAMS].tolist()
        yield np.fromiter((digest(flat[a:b], seed) for a, b in zip(s, e, strict=True)), np.uint64, len(s))


def bit_sums(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """How often each bit is set in the hashes ptr[k]..ptr[k+1]: an array of (segments, 64)."""
    sizes = np.diff(ptr)
    pieces = -(-sizes // 255)                       # runs of at most 255 hashes of a segment
    own = np.repeat(np.arange(len(sizes)), pieces)
    place = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = ptr[:-1][own] + 255 * place
    out = np.zeros((len(sizes), 8, 8), np.int64)    # segment, byte, bit
    if len(cut):
        heads = np.flatnonzero(place == 0)
        for bit in range(8):
            lanes = np.add.reduceat((h >> np.uint64(bit)) & LANES, cut)
            by_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            out[own[heads], :, bit] = np.add.reduceat(by_byte, heads, axis=0)
    return out.reshape(-1, 64)


def majority(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints: the bits that are set in more than half of the hashes."""
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint(text: str | None, n: int = 3) -> int:
    """Of one text."""
    total, count = np.zeros((1, 64), np.int64), 0
    for h in gram_hashes((text or "").encode("utf-8", "surrogatepass"), n):
        total += bit_sums(h, np.array([0, len(h)]))
        count += len(h)
    return int(majority(total, np.array([count]))[0])


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = K.text_bytes(b.column("text"))
            view = memoryview(raw)
            sums, counts = np.zeros((b.num_rows, 64), np.int64), np.zeros(b.num_rows, np.int64)
            parts, rows, held = [], [], 0

            def settle():
                np.add.at(sums, rows, bit_sums(np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])))
            for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                for h in gram_hashes(bytes(view[s:e]), n):
                    parts.append(h)
                    rows.append(k)
                    counts[k] += len(h)
                    held += len(h)
                    if held >= GRAMS:
                        settle()
                        parts, rows, held = [], [], 0
            if parts:
                settle()
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "fp": majority(sums, counts).view(np.int64)})
        K.trim()
    return run


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, fp) of every row of ``docs(doc_id, text)``; fp is the fingerprint as a signed long."""
    return docs.mapInArrow(_fingerprints(n), "doc_id long, fp long")


def _hex(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def _half(fp: Column, upper: bool) -> Column:
    """32 bits of a fingerprint."""
    return F.shiftrightunsigned(fp, 32) if upper else fp.bitwiseAND(_hex(HALF))


def cell(half: Column) -> Column:
    """The bit counts of the 16 two-bit segments of a half, packed two bits each."""
    return half.bitwiseAND(_hex(EVEN)) + F.shiftrightunsigned(half, 1).bitwiseAND(_hex(EVEN))


def _steps(a: Column, b: Column) -> Column:
    """Manhattan distance of two cells whose counts are 0, 1 or 2: in 1-of-2 marks, counts differ in as many bits."""
    def marks(c):       # 0 -> 00, 1 -> 01, 2 -> 11
        high = F.shiftrightunsigned(c, 1).bitwiseAND(_hex(EVEN))
        return c.bitwiseOR(high)
    return F.bit_count(marks(a).bitwiseXOR(marks(b)))


def near_pairs(vertices: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(u, v) of distinct fingerprints ``vertices(fp)`` that differ in 1 to ``bits`` bits, each pair once, u < v or u > v."""
    if not 1 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be 1 to {MAX_BITS}")
    low, high = cell(_half(F.col("fp"), False)), cell(_half(F.col("fp"), True))
    points = vertices.select("fp", low.alias("low"), high.alias("high"))
    # grid 1: rows at home, and visitors from the same cell and from one step below along an axis
    up = [F.when(F.shiftrightunsigned("low", 2 * k).bitwiseAND(_hex(3)) < 2, F.col("low") + F.lit(1 << (2 * k))) for k in range(16)]
    visits = F.filter(F.array(F.struct(F.col("low").alias("cell"), F.lit(0).alias("grid")), F.struct(F.col("high").alias("cell"), F.lit(1).alias("grid")),
                              *[F.struct(u.alias("cell"), F.lit(0).alias("grid")) for u in up]), lambda x: x["cell"].isNotNull())
    visitors = points.select("fp", "low", "high", F.explode(visits).alias("at")).select(
        F.col("fp").alias("v"), F.col("low").alias("v_low"), F.col("high").alias("v_high"),
        F.col("at.cell").alias("v_cell"), F.col("at.grid").alias("v_grid"))
    homes = points.select(F.col("fp").alias("u"), F.col("low").alias("u_low"), F.col("high").alias("u_high"), F.explode(F.array(
        F.struct(F.col("low").alias("cell"), F.lit(0).alias("grid")), F.struct(F.col("high").alias("cell"), F.lit(1).alias("grid")))).alias("at")).select(
        "u", "u_low", "u_high", F.col("at.cell").alias("u_cell"), F.col("at.grid").alias("u_grid"))
    apart_low, apart_high = _steps(F.col("u_low"), F.col("v_low")), _steps(F.col("u_high"), F.col("v_high"))
    # a pair in one cell is met from both sides: once is enough; two steps apart in the low half is the second grid's part
    once = F.when(F.col("u_grid") == 0, (F.col("u_low") != F.col("v_low")) | (F.col("u") < F.col("v"))).otherwise(
        (F.col("u") < F.col("v")) & (apart_low == 2))
    bound = F.when(F.col("u_grid") == 0, apart_low + apart_high <= bits).otherwise(apart_low <= bits)
    exact = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits
    met = (F.col("u_cell") == F.col("v_cell")) & (F.col("u_grid") == F.col("v_grid"))
    return homes.join(visitors, met & once & bound & exact).select("u", "v")


def near_classes(docs: DataFrame, n: int = 3, bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, n_near, component_id) of every row: fingerprint, linked other fingerprints, smallest id reachable."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.store(fingerprints(rename_clear(docs, {"doc_id": id_col, "text": text_col}), n), "fingerprints")
    vertices = scratch.store(rows.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least")), "vertices")
    links = scratch.store(near_pairs(vertices, bits), "links")
    near = links.select("u").union(links.select("v")).groupBy(F.col("u").alias("id")).agg(F.count(F.lit(1)).alias("n_near"))
    placed = vertices.join(components(scratch, links), F.col("fp") == F.col("id"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    placed = scratch.store(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = scratch.store(placed.join(least, "component").join(near, F.col("fp") == F.col("id"), "left").select(
        F.col("fp").alias("of"), F.coalesce("n_near", F.lit(0)).alias("n_near"), "component_id"), "classes")
    mine = F.col("doc_id").isNotNull()
    return rows.join(classes, F.col("fp") == F.col("of"), "left").select(
        "doc_id", "fp", F.when(mine, F.col("n_near")).alias("n_near"), F.when(mine, F.col("component_id")).alias("component_id"))
