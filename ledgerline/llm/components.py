"""Connected components of a link table by alternating large-star and small-star steps.

Only joins and ``min`` aggregates: a vertex with very many links is one partial aggregate per
map task and a skewed join side, never one collected group. Each step is written to the shared
checkpoint folder, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import Scratch


def _state(edges: DataFrame) -> tuple:
    """Rows and an order-free checksum of the edge set."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: every vertex hands its smallest neighbour to the others."""
    both = edges if small else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    else:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``links(u, v)`` with long ids -> (id, component): the smallest id reachable, itself included.

    Vertices without a link don't appear. Self links and nulls are ignored; an empty table gives
    an empty result.
    """
    edges = scratch.store(
        links.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _state(edges)
    while seen[0]:
        step = scratch.store(_star(edges, small=False), "large")
        nxt = scratch.store(_star(step, small=True), "small")
        scratch.free(edges, step)
        edges, now = nxt, _state(nxt)
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
