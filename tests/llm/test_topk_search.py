import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk_search as K
from ledgerline.llm.oracles import TOP_K
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.oracle_util import canon, duck

INF = float("inf")


def brute(rows, queries, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    byid = defaultdict(list)
    for i, v in ok:
        if i in queries:
            byid[i].append(v)
    out = []
    for i, vs in byid.items():
        q = min(vs)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
        out.extend((i, r + 1, j, -s) for r, (s, j) in enumerate(scored))
    return sorted(out)


def test_query_against_sql(spark):
    assert canon(QUERIES["op4_topk_search"](spark, SF001).toPandas()) == canon(duck(SF001).execute(TOP_K).df())


@pytest.mark.parametrize("block,step", [(4096, 7), (5, 2)])
def test_ties_and_odd_vectors(spark, monkeypatch, block, step):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    monkeypatch.setattr(K, "STEP_BITS", step)
    r = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in r.normal(size=6).round(1)]) for i in range(40)]
    rows += [(100 + i, [0.5] * 6) for i in range(30)]              # many equal vectors: ties by id
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [INF] * 6), (203, [float("nan")] * 6), (None, [1.0] * 6),
             (204, [1.0, 2.0]), (205, []), (-7, [0.5] * 6), (3, [0.1] * 6), (206, [1e5] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    queries = {0, 3, 100, 20, 206, -7, 204, 205}
    for k in (1, 7, 500):
        got = K.top_k(df, df.filter(F.col("vec_id").isin(*queries)), k=k).collect()
        assert sorted(map(tuple, got)) == brute(rows, queries, k)


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, K.top_k(df, df).collect())) == [(0, 1, 1, 64 * 128), (1, 1, 0, 64 * 128)]
    assert K.top_k(df.limit(0), df.limit(0)).count() == 0
    assert K.top_k(df, df.limit(0)).count() == 0
    assert K.top_k(df.limit(1), df.limit(1)).count() == 0          # no candidate but itself
    with pytest.raises(ValueError):
        K.top_k(df, df, k=0)


def test_nothing_is_broadcast(spark, monkeypatch):
    """Queries are copied to each slot: a join that broadcasts them sends them through the driver as often."""
    monkeypatch.setattr(K, "BLOCK", 5)
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    plans, store = [], K.Scratch.store

    def ran(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return rows

    def stored(self, df, name):
        ran(df)
        return store(self, df, name)
    monkeypatch.setattr(K.Scratch, "store", stored)
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=4).round(1)]) for i in range(60)] + [(100 + i, [0.5] * 4) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = {0, 7, 100, 101}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100MB")
    try:
        got = ran(K.top_k(df, df.filter(F.col("vec_id").isin(*queries)), k=9))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, got)) == brute(rows, queries, 9)
    assert "SortMergeJoin" in plans[-1] and not [p for p in plans if "Broadcast" in p]


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0 ** 30 + 1, 3.0]])
    b = np.array([[2.0 ** 30 + 1, 5.0]])
    assert K.scores(a, b)[0, 0] == (2 ** 30 + 1) ** 2 + 15
    assert K.scores(a * 2.0 ** 40, b * 2.0 ** 40)[0, 0] == 2 ** 63 - 1
