import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import jaccard_join as J
from ledgerline.llm.components import components
from ledgerline.llm.queries import QUERIES
from ledgerline.llm.scratch import Scratch
from tests.conftest import SF001
from tests.llm import brute


def rows_of(df):
    return sorted(df.collect(), key=str)


def test_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op10_ngram_jaccard"](spark, SF001).collect()
    assert sorted(map(tuple, got)) == sorted(brute.classes(rows))


def test_edges(edge):
    from tests.llm.conftest import EDGE_ROWS
    got = sorted(map(tuple, J.similar_classes(edge).collect()), key=str)
    assert got == sorted(brute.classes(EDGE_ROWS), key=str)


def test_empty(empty):
    assert J.similar_classes(empty).count() == 0


def near_copies(n, seed=3):
    r = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.integers(0, 4)):
            w[r.integers(0, len(w))] = f"e{i}x{r.integers(0, 99)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("chunk", [4, 16, 256])
def test_large_group_in_chunks_loses_no_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)
    rows = near_copies(60) + [(100 + k, t + " tail") for k, (_, t) in enumerate(near_copies(30, seed=9))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.similar_classes(df).collect())) == sorted(brute.classes(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=2, max_size=9), st.sampled_from([50, 80]))
def test_prefix_tree_finds_the_classes_of_all_pairs(sets, percent):
    members = [(k, len(s), np.array(sorted(s), np.int64)) for k, s in enumerate(sets)]
    got = dict(J._link_chunk(members, percent))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    for a in range(len(sets)):
        for b in range(a):
            assert (got[a] == got[b]) == (find(a) == find(b))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=2, max_size=9))
def test_probe_meets_every_class(sets):
    index = J._ordered([(k, len(s), np.array(sorted(s), np.int64)) for k, s in enumerate(sets[1:])])
    tree = J.PrefixTree([m[2] for m in index], [m[1] for m in index], 80)
    x = np.array(sorted(sets[0]), np.int64)
    found = {index[k][0] for k in tree.probe(x, len(x), len(index))}
    every = {k for k, s in enumerate(sets[1:]) if 100 * len(s & sets[0]) >= 80 * len(s | sets[0])}
    assert found <= every
    assert bool(found) == bool(every)


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    got = {r.id: r.component for r in components(Scratch(spark, "t"), spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200}
    assert components(Scratch(spark, "t"), spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("hot", [2, 5])
def test_common_grams_of_packs(spark, documents, monkeypatch, hot):
    """The same classes when grams count as common in a pack, over several packs and repeated rows."""
    monkeypatch.setattr(J, "HOT_SETS", hot)
    monkeypatch.setattr(J, "GRAMS_PER_FLUSH", 300)
    rows = [(r.doc_id, r.text) for r in documents.collect()][:120] + [(500 + i, t) for i, t in near_copies(40)]
    rows += rows[::7] + [(rows[3][0], "the same id with another text " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, J.similar_classes(df).collect())) == sorted(brute.classes(rows))
