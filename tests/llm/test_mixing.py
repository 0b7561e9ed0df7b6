from collections import defaultdict

import pytest

from ledgerline.llm import mixing as M
from ledgerline.llm.oracles import MIX
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.oracle_util import canon, duck


def fill(sizes, weights, share, most):
    """{source: target} by resharing round after round."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, target = share * sum(sizes.values()), {}
    while len(target) < len(order):
        open_ = [s for s in order if s not in target]
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if w[s] * level > most * sizes[s]]
        if not full:
            target.update({s: w[s] * level for s in open_})
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
    return target


def check(rows, got, weights=(3, 1, 2), share=1.5, most=2.0):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(brute.words(r[1]))
    target = fill(sizes, weights, share, most)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= most * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-9


def test_query_against_sql(spark):
    assert canon(QUERIES["op6_mix_sources"](spark, SF001).toPandas()) == canon(duck(SF001).execute(MIX).df())


def test_targets_and_budgets(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), ["a", "b", "c", None, "Ä", "huge"][min(i % 7, 5)]) for i in range(300)]
    rows += [(1000, "w " * 9000, "huge"), (1001, None, "a"), (1002, "", "only empty"), (None, "x y z", "b"), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, key string, size int")
    got = M.mix(df, [3, 1, 2]).collect()
    check(rows, got)
    again = M.mix(df.repartition(9), [3, 1, 2]).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    check(rows, M.mix(df, [5], share=0.3).collect(), weights=(5,), share=0.3)
    other = M.mix(df, [3, 1, 2], seed=1).collect()
    assert {(r.doc_id, r.taken) for r in other} != {(r.doc_id, r.taken) for r in got}


def test_sources_that_fill_up_together_or_hold_no_words(spark):
    rows = [(1, "a b c d e f", "s"), (2, None, None), (3, "x y", "t"), (4, "", "u"), (5, "p q r s", "v")]
    for share in (0.1, 1.0, 1.5, 1.9, 2.0, 3.0):
        got = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), [3, 1, 2], share=share).collect()
        if share <= 2.0:
            check(rows, got, share=share)
        else:
            assert all(r.taken == 2 * r.size for r in got)


def test_edges(spark, edge, empty):
    got = M.mix(edge, [3, 1, 2]).collect()
    check([(r.doc_id, r.text, r.source) for r in edge.collect()], got)
    assert M.mix(empty, [1]).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.taken) for r in M.mix(blank, [1]).collect()] == [(0, 0), (0, 0)]
    with pytest.raises(ValueError):
        M.mix(edge, [])
