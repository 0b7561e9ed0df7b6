"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the sets of its hashed words, word pairs and pairs with one word between them.
Learning rates are per coordinate, and L1 leaves few weights other than 0, so the model is a short
list (bounded by 2^bits entries) that is broadcast to score all texts where they lie, without a
shuffle.

*Fitting.* A bounded sample of the labelled rows is used: rows are drawn by a hash of their id, so
that about ``max_rows`` (40,000) are left, whatever the corpus; the broadcast of their ids is
bounded by that. The sample is dealt to at most four shards, each shard makes ``epochs`` passes in
a fixed order, and the gradient sums of the shards are added up by coordinate (the bias is
averaged). The sum then meets an L1 that grows with the number of shards; only coordinates above it
are collected. Refits agree, whatever the partitioning.

Rows: null and empty texts are scored (by the bias alone); texts without a label, labels without a
text, and null labels or ids are not learned from; several labels of one id count as toxic if one
does; null ids and repeated rows are scored like all others; extra columns are ignored. An empty
training table gives the score 0.5 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.ftrl import Ftrl, word_features
from ledgerline.llm.scratch import Scratch, rename_clear

BITS = 20                   # hashed coordinates
MAX_ROWS = 40_000           # bound of the sample that is learned from
SHARDS = 4
SHARD_ROWS = 4_000          # fewer shards for fewer rows
EPOCHS = 4
ALPHA = 2.0
L1 = 3.0


class Model(NamedTuple):
    """Sparse weights: at most 2^BITS."""
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.index] = self.weight
        return w


def _feature_sets(column) -> Iterator[np.ndarray]:
    """Distinct feature indexes of each text."""
    raw, offsets = K.text_bytes(column)
    for i, j in K.slabs(offsets):
        off = offsets[i:j + 1]
        f, doc = word_features(raw[off[0]:off[-1]], off - off[0], BITS)
        key = np.unique((doc << BITS) | f)
        cut = np.searchsorted(key >> BITS, np.arange(j - i + 1))
        key = (key & ((1 << BITS) - 1)).astype(np.uint32)
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield key[s:e]


def _learn_shard(l1: float, epochs: int):
    """One shard of the sample, in the order of its hashes: gradient sums by coordinate."""
    def run(table):
        # sets of features in that order, made without a second copy of the texts
        order = pc.sort_indices(table, [("draw", "ascending"), ("doc_id", "ascending"), ("text", "ascending")]).to_pylist()
        sets, labels = list(_feature_sets(table.column("text"))), table.column("toxic").to_pylist()
        K.trim()
        sets, labels = [sets[k] for k in order], [labels[k] for k in order]
        m = Ftrl(BITS, alpha=ALPHA, l1=l1)
        for _ in range(epochs):
            for f, y in zip(sets, labels, strict=True):
                m.learn(f, y)
        at = np.flatnonzero(m.n)
        K.trim()
        return pa.table({"index": pa.array(np.append(at, -1), pa.int64()), "z": np.append(m.z[at], m.bias_z),
                         "n": np.append(m.n[at], m.bias_n)})
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Model:
    """Learn from the labelled rows; see the module text for the sample and all cases."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col})
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    known = scratch.store(
        rename_clear(labels, {"doc_id": id_col, "toxic": label_col}).filter(
            F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).withColumn("draw", draw), "labels")
    n = known.count()
    sample = known.filter(F.col("draw") < int(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    shards = max(1, min(SHARDS, -(-n // SHARD_ROWS)))
    # about max_rows ids and labels: the one side here that is broadcast, a megabyte at most
    rows = docs.filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id").withColumn(
        "shard", F.pmod(F.xxhash64("draw", F.lit(1)), F.lit(shards)))
    sums = rows.groupBy("shard").applyInArrow(_learn_shard(L1 / shards ** 0.5, epochs), "index long, z double, n double")
    merged = scratch.store(sums.groupBy("index").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("c")), "sums")
    m = Ftrl(0, alpha=ALPHA, l1=L1 + (shards - 1) / 3)
    kept = merged.filter((F.abs("z") > m.l1) | (F.col("index") < 0)).orderBy("index").collect()
    if not kept:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    m.bias_z, m.bias_n = kept[0].z / kept[0].c, kept[0].n / kept[0].c
    z, n_ = np.array([r.z for r in kept[1:]]), np.array([r.n for r in kept[1:]])
    return Model(np.array([r["index"] for r in kept[1:]], np.int64), m.weights(z, n_), m.bias())


def _scores(column, w: np.ndarray, bias: float) -> np.ndarray:
    total = np.full(len(column), bias)
    raw, offsets = K.text_bytes(column)
    for i, j in K.slabs(offsets):
        off = offsets[i:j + 1]
        f, doc = word_features(raw[off[0]:off[-1]], off - off[0], BITS)
        hit = w[f] != 0
        key = np.unique((doc[hit] << BITS) | f[hit])
        total[i:j] += np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=j - i)
    return 1.0 / (1.0 + np.exp(-np.clip(total, -50, 50)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, 0 to 1: how likely label 1 is."""
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = sent.value.dense(), sent.value.bias
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_scores(b.column("text"), w, bias))],
                                             names=["doc_id", "score"])
    return docs.mapInArrow(run, "doc_id {}, score double".format(docs.schema["doc_id"].dataType.simpleString()))


def keep_clean(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = sent.value.dense(), sent.value.bias
        for b in batches:
            yield b.filter(pa.array(_scores(b.column(at), w, bias) < threshold))
    return docs.mapInArrow(run, docs.schema)
