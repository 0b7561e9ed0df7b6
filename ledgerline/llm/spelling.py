"""Spelling variants: words of a vocabulary that differ by one code point, and the far more frequent form of each.

1. *Vocabulary*: distinct words with their counts, numbered, written once.
2. *Filters*: a blocked Bloom filter for each word length. A word's 64-bit hash is the sum of its code points times odd
   powers, so that the hash of an edited word follows from that of the word; it names one block of 64 bits in the
   filter of its length, and four bits of it. The filters are built by tasks, a slice of a filter each.
3. *Probes*: of each word all deletions of a code point (one of a run of equal ones) and all replacements by a larger
   code point of the vocabulary's alphabet are hashed and looked up in the filter of the resulting length. An insertion
   is the other word's deletion and a replacement by a smaller code point the other word's replacement, so every pair
   is met once. The filters are broadcast in rounds of at most ``ROUND_BYTES``: with a larger vocabulary there
   are more rounds, each of them a pass over the words, and never a larger broadcast.
4. *Join*: only positives leave the probing tasks, as (hash, word number, place, code point). An equi-join by hash with
   the vocabulary removes the false positives, and the edit itself, made again, is compared code point by code point.
5. *Forms*: a word's form is its near word of largest count (ties: the smallest by code points), if that count is
   ``ratio`` times its own or more. Along a chain of forms counts grow by that factor, so pointer doubling finds each
   chain's end in a number of rounds that the largest count fixes.

Hashes only choose candidates; what is near is decided by the words. A word has at most some 2,000 near words per 10 code
points, so no key is hot beyond the counting of words, which map tasks add up first.

Rows: null and empty texts have no words; repeated rows and null ids count like others; very long words are words (their
edits are probed in slabs, and leave as numbers, not as copies of the word). Extra columns are ignored. An empty
vocabulary gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.scratch import Scratch, rename_clear
from ledgerline.plans.keyjoin import join_on_keys

U64 = np.uint64
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_PER_BLOCK = 2               # of 64 bits
SLICE_BLOCKS = 1 << 13            # blocks of a slice: 64 KB
ROUND_BYTES = 64 << 20            # filter slices in one broadcast
SLAB = 1 << 19                    # probes hashed at a time
WORDS_PER_TASK = 20_000           # words that one task probes
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


def runs(text: Column, min_chars: int = 1, pattern: str = RUN) -> Column:
    """The runs of a text that have so many code points, as an array."""
    return F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)),
                    lambda w: F.char_length(w) >= min_chars)


def lowered(word: Column) -> Column:
    """A-Z lowered, nothing else."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER)).otherwise(word)


def vocabulary(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """(word, n) of ``words(word)``: those of at least ``min_chars`` code points that occur ``min_count`` times."""
    return words.filter(F.char_length("word") >= min_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# -- hashes ------------------------------------------------------------------------------------------
def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), BASE, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def _code(c: np.ndarray) -> np.ndarray:
    """A random number for each code point."""
    return K.mix64(c.astype(U64) + U64(0x51_7CC1B727220A95))


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of the words of an Arrow column."""
    texts = column.to_pylist()
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])


def _sums(flat: np.ndarray, ptr: np.ndarray):
    """Running sums of code * power inside each word, one longer than the word; the last one is its hash before mixing."""
    lens = np.diff(ptr)
    place = np.arange(len(flat)) - np.repeat(ptr[:-1], lens)
    power = _powers(int(lens.max(initial=1)) + 1)
    term = _code(flat) * power[place]
    total = np.concatenate([np.zeros(1, U64), np.cumsum(term, dtype=U64)])
    return place, power, total, total[ptr[1:]] - total[ptr[:-1]]


def word_hashes(column) -> np.ndarray:
    """The mixed 64-bit hash of each word."""
    flat, ptr = _words(column)
    return K.mix64(_sums(flat, ptr)[3])


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h = word_hashes(b.column("word"))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], names=[*b.schema.names, "h"])


# -- filters -----------------------------------------------------------------------------------------
def _block(h: np.ndarray, blocks) -> np.ndarray:
    """Which of so many blocks, from the upper 32 bits of a hash (a filter has fewer than 2^32)."""
    return ((h >> U64(32)) * np.asarray(blocks, U64)) >> U64(32)


def _mask(h: np.ndarray) -> np.ndarray:
    """Four of 64 bits, from the lower 24 bits of a hash."""
    one, low = U64(1), U64(63)
    return (one << (h & low)) | (one << ((h >> U64(6)) & low)) | (one << ((h >> U64(12)) & low)) | (one << ((h >> U64(18)) & low))


def _build(slice_blocks: int):
    """One slice of the filter of a length."""
    def run(table):
        blocks, first = int(table.column("blocks")[0].as_py()), int(table.column("part")[0].as_py()) * slice_blocks
        h = table.column("h").to_numpy().astype(np.int64).view(U64)
        bits = np.zeros(min(slice_blocks, blocks - first), U64)
        np.bitwise_or.at(bits, (_block(h, blocks) - U64(first)).astype(np.int64), _mask(h))
        return table.slice(0, 1).select(["chars", "blocks"]).append_column("first", pa.array([first], pa.int64())).append_column(
            "bits", pa.array([bits.tobytes()], pa.binary()))
    return run


def _blocks_of(words: Column) -> Column:
    return F.ceil(words / WORDS_PER_BLOCK)


def filters(vocab: DataFrame, slice_blocks: int) -> DataFrame:
    """(chars, blocks, first, bits): the slices of the blocked Bloom filters of ``vocab(word, h, chars)``."""
    sizes = vocab.groupBy("chars").agg(_blocks_of(F.count(F.lit(1))).cast("long").alias("blocks"))
    upper = F.shiftrightunsigned("h", 32)
    # a row for each distinct length, measured and broadcast: words go to their slices, not to their lengths
    placed = join_on_keys(vocab.select("chars", "h"), sizes, ["chars"], how="inner").withColumn(
        "part", F.floor(F.shiftrightunsigned(upper * F.col("blocks"), 32) / slice_blocks).cast("int"))
    return placed.groupBy("chars", "part").applyInArrow(_build(slice_blocks), "chars int, blocks long, first long, bits binary")


def _rounds(spark, built: DataFrame) -> Iterator[list]:
    """The filter slices, by length, in rounds of at most ``ROUND_BYTES``; only one round is on the driver at a time."""
    sizes = built.select("chars", "first", F.octet_length("bits").alias("size")).orderBy("chars", "first").collect()
    at = 0
    while at < len(sizes):
        end, held = at, 0
        while end < len(sizes) and (end == at or held + sizes[end].size <= ROUND_BYTES):
            held += sizes[end].size
            end += 1
        key, ends = F.struct("chars", "first"), (sizes[at], sizes[end - 1])
        low, high = (F.struct(F.lit(x.chars).alias("chars"), F.lit(x.first).cast("long").alias("first")) for x in ends)
        yield built.filter((key >= low) & (key <= high)).collect()
        at = end


# -- probes ------------------------------------------------------------------------------------------
FOUND = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("place", pa.int32()), ("code", pa.int32())])
FOUND_DDL = "hash long, id long, place int, code int"


class _Filter:
    """The slices of one round: of each length a run of blocks."""

    def __init__(self, rows: list[tuple]):
        parts: dict[int, list] = {}
        for chars, blocks, first, bits in sorted(rows, key=lambda r: (r[0], r[2])):
            parts.setdefault(chars, [blocks, first, []])[2].append(np.frombuffer(bits, U64))
        self.of = {chars: (blocks, first, np.concatenate(bits)) for chars, (blocks, first, bits) in parts.items()}

    def holds(self, chars: int, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that the filter of a length has, in the slices of this round."""
        if chars not in self.of:
            return np.zeros(0, np.int64)
        blocks, first, bits = self.of[chars]
        block = _block(h, blocks).astype(np.int64) - first
        here = np.arange(len(h)) if len(bits) == blocks else np.flatnonzero((block >= 0) & (block < len(bits)))
        mask = _mask(h[here])
        return here[bits[block[here]] & mask == mask]


def _probe(shared, alphabet: list[int], slab: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = _Filter(shared.value)
        codes = np.array(alphabet, np.int64)
        values = _code(codes)
        inverse = U64(BASE_INV)
        for b in batches:
            ids = b.column("id").to_numpy()
            flat, ptr = _words(b.column("word"))
            lens = np.diff(ptr)
            place, power, total, whole = _sums(flat, ptr)
            own = np.repeat(np.arange(len(ids)), lens)
            chars = lens[own]
            value = _code(flat)
            found = []
            for size in np.unique(lens).tolist():
                at = np.flatnonzero(chars == size)              # the code points of the words of this length
                # deletions: the first of a run of equal code points
                first = at[(place[at] == 0) | (flat[at] != flat[at - 1])]
                before = total[first] - total[ptr[own[first]]]
                after = total[ptr[own[first] + 1]] - total[first + 1]
                h = K.mix64(before + after * inverse)
                hit = bloom.holds(size - 1, h)
                found.append((h[hit], first[hit], np.full(len(hit), -1)))
                # replacements by a larger code point
                step = max(1, slab // max(len(codes), 1))
                for k in range(0, len(at), step):
                    some = at[k:k + step]
                    which, code = np.nonzero(codes[None, :] > flat[some].astype(np.int64)[:, None])
                    h = K.mix64(whole[own[some]][which] + (values[code] - value[some][which]) * power[place[some]][which])
                    hit = bloom.holds(size, h)
                    found.append((h[hit], some[which[hit]], codes[code[hit]]))
            if found:
                at = np.concatenate([x[1] for x in found]).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "hash": np.concatenate([x[0] for x in found]).view(np.int64), "id": ids[own[at]],
                    "place": place[at].astype(np.int32), "code": np.concatenate([x[2] for x in found]).astype(np.int32)}, schema=FOUND)
        K.trim()
    return run


def near_words(scratch: Scratch, vocab: DataFrame) -> DataFrame:
    """(id, word, n, near_id, near, near_n): every pair of near words of ``vocab(id, word, n, chars, h)``, once."""
    spark = vocab.sparkSession
    alphabet = sorted(ord(r[0]) for r in vocab.select(F.explode(F.split("word", ""))).filter("col <> ''").distinct().collect())
    built = scratch.store(filters(vocab, SLICE_BLOCKS), "filters")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vocab.count() // WORDS_PER_TASK))
    words = vocab.select("id", "word").repartition(tasks, "id")
    found = None
    for rows in _rounds(spark, built):
        shared = spark.sparkContext.broadcast([(r.chars, r.blocks, r.first, bytes(r.bits)) for r in rows])
        positives = scratch.store(words.mapInArrow(_probe(shared, alphabet, SLAB), FOUND_DDL), "positives")
        shared.destroy()
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        found = spark.createDataFrame([], FOUND_DDL)
    a = vocab.select(F.col("id"), F.col("word"), "n")
    b = vocab.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("h").alias("hash"))
    # the edit of the word, made again: the near word's own code point in the gap must be the one that was probed
    gap = F.when(F.col("code") >= 0, F.expr("substring(near, place + 1, 1)")).otherwise("")
    same = F.concat(F.expr("substring(word, 1, place)"), gap, F.expr("substring(word, place + 2)")) == F.col("near")
    differs = (F.col("code") < 0) | (gap != F.expr("substring(word, place + 1, 1)"))
    return found.join(b, "hash").join(a, "id").filter(same & differs).select("id", "word", "n", "near_id", "near", "near_n")


# -- forms -------------------------------------------------------------------------------------------
def _roots(scratch: Scratch, forms: DataFrame, ratio: int, largest: int) -> DataFrame:
    """(id, root_id): the end of each chain of ``forms(id, form_id)``, by pointer doubling."""
    at = forms.select("id", F.col("form_id").alias("root_id"))
    longest = 1 + (math.ceil(math.log(max(largest, 1), ratio)) if ratio > 1 else 64)
    for _ in range(max(0, math.ceil(math.log2(longest)))):
        ahead = at.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        at = scratch.store(at.join(ahead, "root_id", "left").select("id", F.coalesce("next_id", "root_id").alias("root_id")), "roots")
    return at


def variant_groups(words: DataFrame, ratio: int = 10, word_col: str = "word", count_col: str = "n") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a table of distinct words with their counts."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: counts must grow along a chain of forms")
    scratch = Scratch(words.sparkSession, "spelling")
    mine = rename_clear(words, {"word": word_col, "n": count_col}).filter("word is not null and n is not null")
    hashed = mine.withColumn("id", F.monotonically_increasing_id()).withColumn("chars", F.char_length("word")).mapInArrow(
        _hash_words, "word string, n long, id long, chars int, h long")
    vocab = scratch.store(hashed, "vocabulary")          # the numbers are fixed by this one write
    pairs = scratch.store(near_words(scratch, vocab), "pairs")
    both = pairs.unionByName(pairs.select(F.col("near_id").alias("id"), F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("n").alias("own"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"), F.col("near_id").alias("form_id"))).alias("top"))
    best = scratch.store(best.select("id", "n_near", "top.form", "top.form_id", (-F.col("top.less")).alias("form_n"),
                                     (-F.col("top.less") >= F.lit(ratio) * F.col("own")).alias("taken")), "best")
    largest = vocab.agg(F.max("n")).first()[0] or 1
    roots = _roots(scratch, best.filter("taken"), ratio, largest)
    names = vocab.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    roots = roots.join(names, "root_id").select("id", "root")
    taken = F.coalesce("taken", F.lit(False))
    return vocab.select("id", "word", "n").join(best, "id", "left").join(roots, "id", "left").select(
        "word", F.when(taken, F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("form_n")).alias("form_n"))
