"""Source divergence audit: how far the term use of each source lies from every other source of its language.

A group is a (lang, source). Each language keeps the terms that stand in at least ``min_docs`` of its documents. With c
the occurrences of a kept term in a group, N their sum and V the number of kept terms, its price there is
``p = 1 + floor(10^9 (c + 1) / (N + V))``, for every kept term, also those with c = 0; a language has prices in the
same way. The divergence of a group's price p from another price q of the term is ``floor((p - q)^2 / q)``.

1. *Counts*: map tasks add up occurrences and documents of (lang, source, term) before anything is shuffled, and a
   third of all rows in one source is so many partial counts.
2. *Term ids*: the kept terms of a language are dealt to slices by a hash, some ``slice_terms`` each, and numbered in
   their slice. A group's part of a slice is a sorted array of (term id, count).
3. *Pair tasks*: groups are dealt to blocks of ``block_groups``; an unordered pair of blocks and a slice is one
   co-grouped task, which receives the arrays of both sides, bounded by 2 * block_groups * slice size, and merges every
   unordered pair of groups in it: a galloping search of the shorter array in the longer one finds the overlaps,
   which are priced term by term, both ways; what one side has alone is priced by its distinct counts against
   the other side's price of an absent term, both ways; and the number of terms on either side goes along.
4. *Sums*: the slices of a pair are added up; the kept terms that neither group has all cost the same, both ways.
5. *Terms*: the terms by which a group lies above its language, by divergence, the first ``top`` of them.

All arithmetic is in whole numbers: a product by 10^9 is a decimal where it needs to be, or is divided in three steps of
10^3, which is exact below 9 * 10^15 occurrences of all terms of a group; the sum of a pair stays below 2^63 as prices add up to 10^9 + 2V.

Rows: null text, lang or source is read as ''; a group without terms is a group all the same, and a language without
kept terms has pairs of divergence 0. Every row is a document, repeated rows and null ids too: ids are not read.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.scratch import Scratch, rename_clear
from ledgerline.plans.keyjoin import join_on_keys

SCALE = 1_000_000_000
SLICE_TERMS = 20_000              # kept terms of a slice
BLOCK_GROUPS = 8                  # groups of a block
HELD = 400_000                    # (group, term) counts that a map task holds before it sends them
# letters and all that is not ASCII make terms; A-Z are lowered
TERM_BYTES = bytes(c if c >= 0x80 or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20 for c in range(256))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of (lang, source, term), added up over the batches of a task; a group's row has no term."""
    counts: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], [], []]
        for group, c in counts.items():
            size, d = len(c), docs[group]
            for x, column in zip((
                    pa.repeat(pa.scalar(group[0], pa.string()), size + 1), pa.repeat(pa.scalar(group[1], pa.string()), size + 1),
                    pa.array([*c, None], pa.binary()).cast(pa.string()),
                    np.fromiter((*c.values(), 0), np.int64, size + 1), np.fromiter((*map(d.__getitem__, c), 0), np.int64, size + 1)), columns, strict=True):
                column.append(x)
        counts.clear()
        docs.clear()
        if columns[0]:
            table = pa.table([pa.chunked_array(x) for x in columns], names=["lang", "source", "term", "n", "docs"])
            yield from table.combine_chunks().to_batches(max_chunksize=50_000)
        columns = table = None
        K.trim()

    for b in batches:
        raw, offsets = K.text_bytes(b.column("text"))
        view = memoryview(raw)
        for lang, source, s, e in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(),
                                      offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            group = (lang or "", source or "")
            if group not in counts:
                counts[group], docs[group] = Counter(), Counter()
            own, before = counts[group], len(counts[group])
            found = bytes(view[s:e]).translate(TERM_BYTES).split()
            own.update(found)
            docs[group].update(set(found))
            held += len(own) - before
            if held >= HELD:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial sums of ``docs(text, lang, source)``, and a row without a term for each group."""
    return docs.mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long")


def price(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), exact: in decimals where the product leaves the long integers."""
    over = F.greatest(total + kept, F.lit(1))
    exact = _div((count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), over.cast("decimal(20,0)"))
    return F.when(count < 9 * SCALE, _div((count + 1) * F.lit(SCALE), over)).otherwise(exact) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of prices."""
    return _div((p - q) * (p - q), q)


def np_price(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    over = total + kept
    rest, value = np.asarray(count, np.int64) + 1, np.zeros(len(count), np.int64)
    for step in (1, 1000, 1000, 1000):
        rest = rest * step
        value = value * step + rest // over
        rest = rest % over
    return value + 1


def np_gap(p, q):
    return (p - q) * (p - q) // q


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 64):
    """Places of the common values of two sorted arrays, the shorter first: every ``stride``-th value of the longer
    array tells where to look, and the look goes on from there in doubling steps back to single ones."""
    if not len(short) or not len(long):
        z = np.zeros(0, np.int64)
        return z, z
    at = np.maximum(np.searchsorted(long[::stride], short, side="right") - 1, 0) * stride
    step = stride // 2
    while step:                                    # the last place whose value is not above
        ahead = np.minimum(at + step, len(long) - 1)
        at = np.where(long[ahead] <= short, ahead, at)
        step //= 2
    hit = long[at] == short
    return np.flatnonzero(hit), at[hit]


def merge_pair(a: tuple, b: tuple, kept: int) -> tuple[int, int, int]:
    """Two groups' (ids, counts, total) of a slice: (divergence of a from b, of b from a, terms on either side)."""
    swap = len(a[0]) > len(b[0])
    short, long = (b, a) if swap else (a, b)
    i, j = gallop(short[0], long[0])
    p, q = np_price(short[1][i], short[2], kept), np_price(long[1][j], long[2], kept)
    there, back = int(np_gap(p, q).sum()), int(np_gap(q, p).sum())
    none_short, none_long = int(np_price(np.zeros(1), short[2], kept)[0]), int(np_price(np.zeros(1), long[2], kept)[0])
    for side, hits, absent, mine in ((short, i, none_long, True), (long, j, none_short, False)):
        alone = np.ones(len(side[0]), bool)
        alone[hits] = False
        counts, times = np.unique(side[1][alone], return_counts=True)
        own = np_price(counts, side[2], kept)
        away, towards = int((np_gap(own, absent) * times).sum()), int((np_gap(absent, own) * times).sum())
        there, back = (there + away, back + towards) if mine else (there + towards, back + away)
    union = len(short[0]) + len(long[0]) - len(i)
    return (back, there, union) if swap else (there, back, union)


def _arrays(table):
    """A group's part of a slice as sorted arrays."""
    ids, n = table.column("term_id").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(ids)
    ids, n = ids[order].astype(np.int32), n[order].astype(np.int64)
    first = table.slice(0, 1).select(["lang", "source", "slice"])
    return first.append_column("ids", pa.array([ids.tobytes()], pa.binary())).append_column("counts", pa.array([n.tobytes()], pa.binary()))


PAIRS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()),
                   ("ab", pa.int64()), ("ba", pa.int64()), ("terms", pa.int64())])
PAIRS_DDL = "lang string, a string, b string, ab long, ba long, terms long"


def _side(table: pa.Table) -> list[tuple]:
    return [(place, source, (np.frombuffer(ids or b"", np.int32), np.frombuffer(n or b"", np.int64), total)) for place, source, ids, n, total in zip(
        *(table.column(c).to_pylist() for c in ("place", "source", "ids", "counts", "total")), strict=True)]


def _pair_task(left, right):
    """Every unordered pair of groups of two blocks (or of one block with itself), in one slice."""
    rows = {c: [] for c in PAIRS.names}
    if left.num_rows and right.num_rows:
        lang, kept = left.column("lang")[0].as_py(), left.column("kept")[0].as_py()
        others = _side(right)
        for place, source, own in _side(left):
            for other_place, other, its in others:
                if place < other_place and kept:
                    ab, ba, terms = merge_pair(own, its, kept)
                    for c, x in zip(PAIRS.names, (lang, source, other, ab, ba, terms), strict=True):
                        rows[c].append(x)
                elif place < other_place:
                    for c, x in zip(PAIRS.names, (lang, source, other, 0, 0, 0), strict=True):
                        rows[c].append(x)
    return pa.Table.from_pydict(rows, schema=PAIRS)


class Audit:
    """The stored tables of one audit: ``counts`` of kept terms by group, ``groups``, and what is computed from them."""

    def __init__(self, docs: DataFrame, min_docs: int = 3, slice_terms: int = SLICE_TERMS, block_groups: int = BLOCK_GROUPS,
                 text_col: str = "text", lang_col: str = "lang", source_col: str = "source"):
        self.scratch = scratch = Scratch(docs.sparkSession, "divergence")
        self.block_groups = block_groups
        texts = rename_clear(docs, {"text": text_col, "lang": lang_col, "source": source_col})
        use = scratch.store(term_counts(texts).groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")), "use")
        terms = use.filter(F.col("term").isNotNull())
        kept = scratch.store(terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                             .filter(F.col("docs") >= min_docs).drop("docs"), "kept")
        langs = use.select("lang").distinct().join(kept.groupBy("lang").agg(
            F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left").select(
            "lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
        slices = F.greatest(F.lit(1), F.ceil(F.col("kept") / slice_terms)).cast("int")
        self.langs = scratch.store(langs.withColumn("slices", slices), "langs")
        dealt = join_on_keys(kept, self.langs.drop("kept", "lang_total"), ["lang"], how="inner").withColumn(
            "slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int")).drop("slices")
        numbered = dealt.withColumn("term_id", F.row_number().over(W.partitionBy("lang", "slice").orderBy("term")))
        # the kept terms of each group, with their ids
        self.counts = scratch.store(terms.drop("docs").join(numbered, ["lang", "term"]), "counts")
        own = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        places = use.select("lang", "source").distinct().join(own, ["lang", "source"], "left").withColumn(
            "place", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
        self.groups = scratch.store(join_on_keys(places, self.langs, ["lang"], how="inner").withColumn(
            "total", F.coalesce("total", F.lit(0))).withColumn("block", F.floor(F.col("place") / block_groups).cast("int")), "groups")

    def pairs(self) -> DataFrame:
        """(lang, source, other, value): divergence of each group from every other one of its language."""
        arrays = self.counts.select("lang", "source", "slice", "term_id", "n").groupBy("lang", "source", "slice").applyInArrow(
            _arrays, "lang string, source string, slice int, ids binary, counts binary")
        # every group has a row in every slice of its language, if only an empty one
        wanted = self.groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        arrays = self.scratch.store(wanted.join(arrays, ["lang", "source", "slice"], "left"), "arrays")
        blocks = self.groups.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
        arrays = join_on_keys(arrays, blocks, ["lang"], how="inner").select(
            "lang", "slice", "source", "place", "block", "blocks", "ids", "counts", "total", "kept")
        left = arrays.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))).withColumnRenamed("block", "first")
        right = arrays.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("block")))).withColumnRenamed("block", "other")
        right = right.select(*[F.col(c).alias(c) for c in right.columns])          # columns of its own
        task = ["lang", "slice", "first", "other"]
        merged = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_pair_task, PAIRS_DDL)
        sums = merged.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("ab", "ba", "terms")])
        sums = self.scratch.store(sums, "pairs")
        info = self.groups.select("lang", "source", "total", "kept")
        a = info.select(F.col("lang"), F.col("source").alias("a"), F.col("total").alias("a_total"), "kept")
        b = info.select(F.col("lang"), F.col("source").alias("b"), F.col("total").alias("b_total"))
        priced = sums.join(a, ["lang", "a"]).join(b, ["lang", "b"])
        none = F.lit(0).cast("long")
        p, q = price(none, F.col("a_total"), F.col("kept")), price(none, F.col("b_total"), F.col("kept"))
        absent = F.col("kept") - F.col("terms")
        some = F.col("kept") > 0
        both = F.explode(F.array(
            F.struct(F.col("a").alias("source"), F.col("b").alias("other"), F.when(some, F.col("ab") + absent * gap(p, q)).otherwise(0).alias("value")),
            F.struct(F.col("b").alias("source"), F.col("a").alias("other"), F.when(some, F.col("ba") + absent * gap(q, p)).otherwise(0).alias("value"))))
        return priced.select("lang", both.alias("x")).select("lang", "x.source", "x.other", "x.value")

    def terms(self, top: int = 200) -> DataFrame:
        """(lang, source, term, value, rank): the first terms by which a group lies above its language."""
        sized = join_on_keys(self.counts, self.groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"], how="inner")
        priced = sized.select("lang", "source", "term", price(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                              price(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")).filter("p > q")
        valued = priced.select("lang", "source", "term", gap(F.col("p"), F.col("q")).alias("value"))
        order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
        return valued.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def divergences(docs: DataFrame, min_docs: int = 3, top: int = 200, **columns) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of groups of a language, and the first terms of each group."""
    audit = Audit(docs, min_docs, **columns)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = audit.pairs().withColumn("rank", F.row_number().over(order))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank").unionByName(
        audit.terms(top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
