"""Quality classifier from weak labels: EM over heuristic labellers, then a hashed linear scorer.

*Labellers.* Each looks at one statistic of a text (shares of symbols, capitals, digits, common function
words, words that repeat the one before, distinct words, words per line, word length) and votes
good, bad or neutral; it does not judge a text with too few words. They overlap, and none needs
labelled data.

*Label model.* The votes of all documents are counted by vote pattern (at most 4^labellers
patterns, whatever the corpus); expectation-maximisation over these counts estimates the share of
good documents and, for each labeller, how often it votes good, bad or neutral on good and on bad
documents (no judgement says nothing). Classes are told apart by the labellers' majority. The posterior of a pattern is the
weak label of its documents.

*Scorer.* A logistic regression over hashed features (words, word pairs, shapes of the text in
byte classes, and binned statistics) is fitted by FTRL-proximal to the posteriors of a bounded
sample: rows drawn by a hash of their id, about ``max_rows`` (40,000), dealt to at most four
shards whose gradient sums are added up. All documents are scored where they lie.

Rows: null and empty texts get no votes and no features, so the prior and the bias; null ids and repeated
rows are judged like all others (a null id isn't drawn for the sample); extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.ftrl import Ftrl, word_features
from ledgerline.llm.scratch import Scratch, rename_clear

U64 = np.uint64
BITS = 20
MAX_ROWS = 40_000
SHARDS = 4
SHARD_ROWS = 4_000
EPOCHS = 3
ALPHA, L1 = 0.5, 1.0

# the commonest function words of English, German, French and Spanish
FUNCTION_WORDS = """the of and to in that is it for was with as be by on not he his but at are this have from or an
der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so dass
de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se
el y los se del las con no una su para al lo como más o pero sus""".split()

CLASS = np.zeros(256, np.uint8)          # classes of bytes: space, lower, upper, digit, other, each symbol its own
CLASS[128:] = 1                          # letters beyond ASCII count as lower
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 1, 2, 3
for _c in range(33, 127):
    if CLASS[_c] == 0:
        CLASS[_c] = _c
SYMBOL = np.zeros(256, bool)
SYMBOL[[c for c in range(33, 127) if CLASS[c] == c and chr(c) not in ".,;:'\"()-?"]] = True


def _hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.unique(K.words(raw, np.array([0, len(raw)]))[0])


_FUNCTION = _hash_words(FUNCTION_WORDS)

# (statistic, lower bound, upper bound, vote inside, vote outside, words needed); votes: 1 good, 2 bad, 3 neutral;
# 0 is no judgement
LABELLERS = [
    ("symbols", 0.0, 0.04, 1, 2, 1),
    ("capitals", 0.0, 0.3, 1, 2, 1),
    ("digits", 0.0, 0.2, 3, 2, 1),
    ("function", 0.08, 1.0, 1, 3, 10),
    ("function", 0.03, 1.0, 3, 2, 30),
    ("repeats", 0.0, 0.06, 1, 2, 10),
    ("distinct", 0.25, 1.0, 3, 2, 30),
    ("length", 2.5, 11.0, 1, 2, 5),
    ("line", 0.0, 400.0, 3, 2, 1),
]
STATISTICS = list(dict.fromkeys(x[0] for x in LABELLERS))


def statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Statistics of the documents of a slab; ``n`` is the number of words."""
    def per_doc(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)
    h, _, doc, counts = K.words(raw, offsets)
    n_docs = len(offsets) - 1
    n = np.maximum(counts, 1).astype(float)
    black = np.maximum(per_doc(~K.SPACE[raw]), 1)
    again = np.zeros(n_docs)
    if len(h) > 1:
        same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        again = np.bincount(doc[1:][same], minlength=n_docs)
    _, ptr = K.distinct(h, doc, n_docs)
    at = np.minimum(np.searchsorted(_FUNCTION, h), len(_FUNCTION) - 1)
    known = np.bincount(doc[_FUNCTION[at] == h], minlength=n_docs) if len(h) else np.zeros(n_docs)
    kind = CLASS[raw]
    letters = np.maximum(per_doc((kind == 1) | (kind == 2)), 1)
    return {"n": counts, "symbols": per_doc(SYMBOL[raw]) / black, "capitals": per_doc(kind == 2) / letters,
            "digits": per_doc(kind == 3) / black, "function": known / n, "repeats": again / n,
            "distinct": np.diff(ptr) / n * np.minimum(1.0, (n / 200.0) ** 0.5 + 0.5), "length": black / n,
            "line": n / (per_doc(raw == 10) + 1)}


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Vote pattern of each document as one number, a digit to base 4 for each labeller."""
    code = np.zeros(len(stats["n"]), np.int64)
    for name, low, high, inside, outside, least in LABELLERS:
        v = np.where((stats[name] >= low) & (stats[name] <= high), inside, outside)
        code = code * 4 + np.where(stats["n"] >= least, v, 0)
    return code


class LabelModel(NamedTuple):
    """Share of good documents, and votes[class, labeller, vote] of judged texts, with class 1 good."""
    prior: float
    votes: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """How likely each vote pattern is good."""
        like = np.log(np.array([1 - self.prior, self.prior]))[:, None] + np.zeros(len(codes))
        for k in range(len(LABELLERS)):
            digit = codes // 4 ** (len(LABELLERS) - 1 - k) % 4
            like = like + np.where(digit > 0, np.log(self.votes[:, k, :][:, digit]), 0.0)
        return 1.0 / (1.0 + np.exp(np.clip(like[0] - like[1], -50, 50)))

    def accuracies(self) -> dict:
        """Estimated accuracy of each labeller's votes (where it votes)."""
        right = (1 - self.prior) * self.votes[0, :, 2] + self.prior * self.votes[1, :, 1]
        cast = (1 - self.prior) * self.votes[0, :, 1:3].sum(1) + self.prior * self.votes[1, :, 1:3].sum(1)
        return {f"{x[0]} {x[3]}{x[4]}": float(a) for x, a in zip(LABELLERS, right / np.maximum(cast, 1e-9), strict=True)}


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM over the counts of vote patterns, from the labellers' majority."""
    m = len(LABELLERS)
    digit = np.stack([codes // 4 ** (m - 1 - k) % 4 for k in range(m)], axis=1)
    bad, good = (digit == 2).sum(1), (digit == 1).sum(1)
    # one bad vote weighs as much as several good ones: labellers call most texts good
    q = np.where(bad > 0, 0.2 ** bad * 0.8, 0.5 + 0.45 * (good > 0))
    one_hot = digit[:, :, None] == np.arange(4)
    model = LabelModel(0.5, np.full((2, m, 4), 1 / 3))
    for _ in range(rounds):
        w = np.stack([(1 - q) * counts, q * counts])
        table = np.einsum("cp,pkv->ckv", w, one_hot) + 1.0                   # one vote of each kind for smoothing
        table[:, :, 0] = 1e-9
        model = LabelModel(float(np.clip(w[1].sum() / max(w.sum(), 1e-9), 0.01, 0.99)), table / table.sum(2, keepdims=True))
        new = model.posterior(codes)
        if np.abs(new - q).max(initial=0.0) < 1e-9:
            break
        q = new
    return model


def _slab_features(raw: np.ndarray, offsets: np.ndarray, stats: dict[str, np.ndarray]):
    """Distinct hashed features: (feature index, doc index), sorted by document."""
    f, d = word_features(raw, offsets, BITS, grams=(1,), skips=())
    feats, docs = [f], [d]
    kind = CLASS[raw].astype(np.uint64)
    if len(raw) > 3:                                                         # shapes: four byte classes in a row
        gram = ((kind[:-3] * U64(128) + kind[1:-2]) * U64(128) + kind[2:-1]) * U64(128) + kind[3:]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = doc[:-3] == doc[3:]
        feats.append((K.mix64(gram + U64(1 << 40)) >> U64(64 - BITS)).astype(np.int64)[inside])
        docs.append(doc[:-3][inside])
    for k, name in enumerate(STATISTICS):
        value = stats[name]
        bins = np.clip(np.floor(8 * np.log2(value + 1 / 64)) + 64, 0, 255).astype(np.uint64)
        some = stats["n"] > 0
        feats.append((K.mix64(bins + U64((k + 1) << 32)) >> U64(64 - BITS)).astype(np.int64)[some])
        docs.append(np.flatnonzero(some))
    key = np.unique((np.concatenate(docs) << BITS) | np.concatenate(feats))
    return key & ((1 << BITS) - 1), key >> BITS


def _slabs(column):
    raw, offsets = K.text_bytes(column)
    for i, j in K.slabs(offsets):
        off = offsets[i:j + 1]
        part, off = raw[off[0]:off[-1]], off - off[0]
        yield i, j, part, off, statistics(part, off)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of vote patterns of a partition, summed up batch by batch."""
    for b in batches:
        codes = [votes(stats) for *_, stats in _slabs(b.column("text"))]
        if codes:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_pydict({"code": code, "n": n})


class Scorer(NamedTuple):
    """Label model and sparse weights (at most 2^BITS)."""
    labels: LabelModel
    index: np.ndarray
    weight: np.ndarray
    bias: float


def _learn_shard(model: LabelModel, l1: float, epochs: int):
    def run(table):
        table = table.sort_by([("draw", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
        sets, soft = [], []
        for i, j, raw, off, stats in _slabs(table.column("text")):
            f, d = _slab_features(raw, off, stats)
            cut = np.searchsorted(d, np.arange(j - i + 1))
            sets.extend(f[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
            soft.extend(model.posterior(votes(stats)).tolist())
        m = Ftrl(BITS, alpha=ALPHA, l1=l1)
        for _ in range(epochs):
            for f, y in zip(sets, soft, strict=True):
                m.learn(f, y)
        at = np.flatnonzero(m.n)
        K.trim()
        return pa.table({"index": pa.array(np.append(at, -1), pa.int64()), "z": np.append(m.z[at], m.bias_z),
                         "n": np.append(m.n[at], m.bias_n)})
    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Scorer:
    """Estimate the labellers on all documents, and learn the scorer from a bounded sample."""
    scratch = Scratch(docs.sparkSession, "quality")
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col})
    counts = docs.select("text").mapInArrow(_vote, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n")).orderBy("code").collect()                     # at most 4^labellers rows
    n = sum(r.n for r in counts)
    labels = estimate(np.array([r.code for r in counts], np.int64), np.array([r.n for r in counts], float))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    shards = max(1, min(SHARDS, -(-n // SHARD_ROWS)))
    sample = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).withColumn("draw", draw).filter(
        F.col("draw") < int(min(1.0, max_rows / max(n, 1)) * (1 << 30))).withColumn(
        "shard", F.pmod(F.xxhash64("draw", F.lit(1)), F.lit(shards)))
    sums = sample.groupBy("shard").applyInArrow(_learn_shard(labels, L1, epochs), "index long, z double, n double")
    merged = scratch.store(sums.groupBy("index").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("c")), "sums")
    m = Ftrl(0, alpha=ALPHA, l1=L1 * shards)
    kept = merged.filter((F.abs("z") > m.l1) | (F.col("index") < 0)).orderBy("index").collect()     # at most 2^BITS rows
    if not kept:
        return Scorer(labels, np.zeros(0, np.int64), np.zeros(0), 0.0)
    m.bias_z, m.bias_n = kept[0].z / kept[0].c, kept[0].n / kept[0].c
    z, n_ = np.array([r.z for r in kept[1:]]), np.array([r.n for r in kept[1:]])
    return Scorer(labels, np.array([r["index"] for r in kept[1:]], np.int64), m.weights(z, n_), m.bias())


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, posterior, score) of every row: the weak label and the scorer's, 0 to 1, higher is better."""
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col})
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        w = np.zeros(1 << BITS)
        w[model.index] = model.weight
        for b in batches:
            total, weak = np.full(b.num_rows, model.bias), np.empty(b.num_rows)
            for i, j, raw, off, stats in _slabs(b.column("text")):
                f, d = _slab_features(raw, off, stats)
                total[i:j] += np.bincount(d, weights=w[f], minlength=j - i)
                weak[i:j] = model.labels.posterior(votes(stats))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(weak),
                                              pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -50, 50))))],
                                             names=["doc_id", "posterior", "score"])
    return docs.mapInArrow(run, "doc_id {}, posterior double, score double".format(docs.schema["doc_id"].dataType.simpleString()))
