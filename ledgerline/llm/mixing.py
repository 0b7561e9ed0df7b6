"""Mix sources to target weights: random keys, a range sort in each source, prefix sums, exact cuts.

A document's size is its number of words. Sources, by code point with null last, take the weights
in turn and share ``share`` times all words; a target stops at ``most`` times its source's words and
the excess goes to the other sources by weight, until none is above.

Each document gets a key hashed from its id and a seed. In each source the documents are ordered by
that key; a distributed prefix sum of sizes gives the words before each document; and the source is
cut at its exact budget: whole epochs first, then the documents at the head of the order, the last
one in part. ``taken`` counts words, repeats included, so the sum over a source is its target
rounded to whole words. Epochs beyond the first repeat documents in the same order.

The targets are exact: for weights w and caps c, the level L with sum(min(w * L, c)) = total is found
by sweeping the few distinct weights' sources in order of c / w, as a prefix sum over the table of
sources. Reruns agree, whatever the partitioning: keys depend on ids and text digests only.

Rows: a null or blank text has size 0 and takes 0 words; null ids and repeated rows are documents of
their own (ties of the key are broken by id and text digest, and by nothing else: equal rows share
what their places take, in any order); a null source is a source; extra columns are ignored. An empty
table, or one without words, takes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.prefix_sum import range_sorted, running_sums
from ledgerline.llm.scratch import Scratch, rename_clear

WORD = r"[^\x20\x09-\x0D]+"


def targets(scratch: Scratch, sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) for each source of ``sizes(source, size)``."""
    per = scratch.store(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    place = running_sums(range_sorted(scratch, per.withColumn("one", F.lit(1)), ["source"]), ["source"], "one", name="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = scratch.store(place.select("source", "source_size", weight.alias("weight"),
                                     (F.col("source_size") * F.lit(float(most))).alias("cap"))
                        .withColumn("full_at", F.col("cap") / F.col("weight")), "weights")
    words, weights_sum = per.agg(F.sum("source_size"), F.sum("weight")).first()
    if words is None:
        return per.select("source", "source_size", F.col("cap").alias("target"))
    # sources fill up in order of full_at; the level is the last one that leaves none above its cap
    ranges = range_sorted(scratch, per, ["full_at", "source"])
    swept = running_sums(running_sums(ranges, ["full_at", "source"], "cap", name="cap_before"),
                         ["full_at", "source"], "weight", name="weight_before")
    level = swept.withColumn("level", (F.lit(float(words) * float(share)) - F.col("cap_before"))
                             / (F.lit(float(weights_sum)) - F.col("weight_before")))
    # the first source that stays open at its level sets it; of sources that fill up together, that is the highest level
    first = F.struct("full_at", (-F.col("level")).alias("level"))
    best = level.filter(F.col("full_at") >= F.col("level")).agg(F.min_by("level", first)).first()[0]
    target = F.col("cap") if best is None else F.least(F.col("cap"), F.col("weight") * F.lit(float(best)))
    return per.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, digest, size, source_size, target, taken) of every row; see the module text for all cases.

    ``digest`` is the MD5 of the text.
    """
    if not weights or min(weights) <= 0 or share < 0 or most <= 0:
        raise ValueError("weights and most must be above 0, share at least 0")
    scratch = Scratch(docs.sparkSession, "mixing")
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col, "source": source_col})
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = scratch.store(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.md5("text").alias("digest"), key.alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    per = scratch.store(targets(scratch, sized, weights, share, most), "targets")
    order = ["source", "key", "doc_id", "digest"]
    placed = running_sums(range_sorted(scratch, sized, order), order, "size", within=["source"], name="before")
    budget = F.round("target").cast("long")
    joined = placed.alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.doc_id", "d.source", "d.digest", "d.size", "d.before", "s.source_size", "s.target", budget.alias("budget"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return joined.withColumn("epochs", epochs).select(
        "doc_id", "source", "digest", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))
