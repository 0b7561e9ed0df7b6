import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerline.llm import divergence as D
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute

SCHEMA = "text string, lang string, source string"


def audit(spark, rows, **options):
    return sorted(map(tuple, D.divergences(spark.createDataFrame(rows, SCHEMA), **options).collect()))


def test_query_against_brute_force(spark, documents):
    rows = [(r.text, r.lang, r.source) for r in documents.collect()]
    got = sorted(map(tuple, QUERIES["op12_source_divergence"](spark, SF001).collect()))
    assert got == sorted(brute.divergences(rows))


ROWS = [("red Green blue", "en", "a"), ("red green green naïve", "en", "b"), ("RED green", "en", None), ("red ünd", "en", ""),
        (None, "en", "c"), ("", "en", "d"), ("123 ., \x7f", "en", "e"), ("red green", "en", "a"), ("red green", "en", "a"),
        ("rouge vert", "fr", "a"), ("rouge", "fr", "b"), (None, None, None), ("x x x", None, "s"), ("x", "", "t"), ("x y", None, ""),
        ("seul", "it", "a"), ("red" * 40_000 + " red", "en", "z"), ("東京 🙂 naïve red_green", "en", "b"), ("naïve", "en", "b")]


def test_edges(spark):
    assert audit(spark, ROWS) == sorted(brute.divergences(ROWS))
    assert audit(spark, ROWS, min_docs=1, top=2) == sorted(brute.divergences(ROWS, 1, 2))
    clashing = spark.createDataFrame([(*r, 1, "x", 2) for r in ROWS], f"{SCHEMA}, n int, term string, doc_id int")
    assert sorted(map(tuple, D.divergences(clashing).collect())) == sorted(brute.divergences(ROWS))
    assert D.divergences(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("slices,blocks", [(3, 1), (5, 2), (1000, 3)])
def test_slices_and_blocks_change_nothing(spark, monkeypatch, slices, blocks):
    monkeypatch.setattr(D, "HELD", 10)
    r = np.random.default_rng(2)
    rows = [(" ".join(r.choice([f"w{chr(97 + k)}" for k in range(20)], size=r.integers(0, 30))), "en", f"s{r.integers(0, 7)}") for _ in range(60)]
    assert audit(spark, rows, slice_terms=slices, block_groups=blocks) == sorted(brute.divergences(rows))


@given(st.dictionaries(st.integers(0, 300), st.integers(1, 10 ** 12), max_size=40), st.dictionaries(st.integers(0, 300), st.integers(1, 9), max_size=300))
def test_merge_of_a_pair(a, b):
    def side(c):
        ids = sorted(c)
        return np.array(ids, np.int32), np.array([c[i] for i in ids], np.int64), sum(c.values())
    kept = 301

    def price(c):
        return {t: 1 + 10 ** 9 * (c.get(t, 0) + 1) // (sum(c.values()) + kept) for t in range(kept)}
    p, q = price(a), price(b)
    ab, ba, terms = D.merge_pair(side(a), side(b), kept)
    seen = a.keys() | b.keys()
    assert (ab, ba, terms) == (sum((p[t] - q[t]) ** 2 // q[t] for t in seen), sum((p[t] - q[t]) ** 2 // p[t] for t in seen), len(seen))


@given(st.sets(st.integers(0, 5000), max_size=30), st.sets(st.integers(0, 5000), max_size=900), st.sampled_from([1, 2, 8, 64]))
def test_gallop(short, long, stride):
    i, j = D.gallop(np.array(sorted(short), np.int32), np.array(sorted(long), np.int32), stride)
    assert [sorted(short)[k] for k in i] == [sorted(long)[k] for k in j] == sorted(short & long)


def test_prices_of_counts_beyond_the_long_integers(spark):
    counts = [0, 1, 9 * 10 ** 9 - 1, 9 * 10 ** 9, 10 ** 13, 3 * 10 ** 14]
    total, kept = 4 * 10 ** 14, 12345
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(c, total, kept) for c in counts], "c long, t long, k long")
    expected = [1 + 10 ** 9 * (c + 1) // (total + kept) for c in counts]
    assert [r[0] for r in df.select(D.price(F.col("c"), F.col("t"), F.col("k"))).collect()] == expected
    assert D.np_price(np.array(counts), total, kept).tolist() == expected
