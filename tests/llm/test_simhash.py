import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import simhash as H
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS


def signed(values):
    return [int(np.uint64(v).view(np.int64)) for v in values]


def test_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op13_simhash"](spark, SF001).collect())
    assert got == sorted((i, f"{f:016x}", c) for i, f, c in brute.simhash_classes(rows))


def test_edges(edge, empty):
    got = sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in H.near_classes(edge).collect()), key=str)
    expected = brute.simhash_classes(EDGE_ROWS)
    assert got == sorted(expected, key=str)
    assert {c for i, f, c in expected if f == 0 and i is not None} == {3}          # null, empty and blank texts
    assert H.near_classes(empty).count() == 0


def test_texts_that_differ_a_little_make_a_class(spark):
    base = [f"w{k}" for k in range(4000)]
    rows = [(k, " ".join(base[:100 * k] + ["other"] * (k > 0) + base[100 * k + 1:])) for k in range(8)] + [
        (50 + k, " ".join(f"{x}{k}" for x in base[:300])) for k in range(5)] + [(90, None), (91, "zero\n")]
    got = [(r.doc_id, r.component_id) for r in H.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted((i, c) for i, _, c in brute.simhash_classes(rows))


def flipped(value, places):
    for p in places:
        value ^= 1 << p
    return value


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2 ** 64 - 1), st.lists(st.sets(st.integers(0, 63), max_size=4), max_size=6)), min_size=1, max_size=4),
       st.sampled_from([1, 2]))
def test_grid_finds_every_pair_once(spark, centres, bits):
    values = sorted({flipped(c, p) for c, all_ in centres for p in [(), *all_]})
    df = spark.createDataFrame([(v,) for v in signed(values)], "fp long")
    got = [tuple(sorted(r)) for r in H.near_pairs(df, bits).collect()]
    expected = [tuple(sorted(signed(p))) for k, a in enumerate(values) for b in values[:k] if bin(a ^ b).count("1") <= bits for p in [(a, b)]]
    assert sorted(got) == sorted(expected)


def test_grid_over_all_double_flips_of_one_fingerprint(spark):
    values = [0x0F1E2D3C4B5A6978] + [flipped(0x0F1E2D3C4B5A6978, p) for p in [(k, j) for k in range(0, 64, 3) for j in range(k)]]
    df = spark.createDataFrame([(v,) for v in signed(values)], "fp long")
    assert H.near_pairs(df).count() == sum(bin(a ^ b).count("1") <= 2 for k, a in enumerate(values) for b in values[:k])
    with pytest.raises(ValueError, match="bits"):
        H.near_pairs(df, 3)


@pytest.mark.parametrize("held", [7, 300])
def test_bit_counts_in_pieces(monkeypatch, held):
    monkeypatch.setattr(H, "GRAMS", held)
    text = " ".join(f"word{k % 501}" for k in range(2000))
    assert H.fingerprint(text) == brute.simhash(text)


@given(st.lists(st.lists(st.integers(0, 2 ** 64 - 1), max_size=5), min_size=1, max_size=6), st.integers(1, 200))
def test_bit_sums(segments, times):
    h = np.array([x for s in segments for x in s * times], np.uint64)
    ptr = np.cumsum([0] + [len(s) * times for s in segments])
    expected = [[times * sum(x >> b & 1 for x in s) for b in range(64)] for s in segments]
    assert H.bit_sums(h, ptr).tolist() == expected
