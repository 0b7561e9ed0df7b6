import numpy as np

from ledgerline.llm import quality as Q
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF01


def test_against_labels_that_it_never_sees(spark):
    rows = QUERIES["op8_quality"](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) >= 0.98 * len(good)
    assert sum(r.keep for r in bad) <= 0.2 * len(bad)


def test_em_finds_the_accuracies_of_simulated_labellers():
    r = np.random.default_rng(0)
    n, m = 20_000, len(Q.LABELLERS)
    y = r.random(n) < 0.8
    right = np.linspace(0.7, 0.95, m)
    code = np.zeros(n, np.int64)
    for k in range(m):
        ok = r.random(n) < right[k]
        judged = r.random(n) < 0.8
        code = code * 4 + np.where(judged, np.where(y == ok, 1, 2), 0)
    codes, counts = np.unique(code, return_counts=True)
    model = Q.estimate(codes, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.05
    assert np.abs(model.votes[1, :, 1] - right).max() < 0.05
    assert np.abs(model.votes[0, :, 2] - right).max() < 0.08
    assert ((model.posterior(code) > 0.5) == y).mean() > 0.95


def test_refits_agree_and_edges(spark, edge, empty):
    a, b = Q.fit(edge), Q.fit(edge.repartition(5))
    assert (a.index == b.index).all() and np.allclose(a.weight, b.weight)
    got = Q.score(edge, a).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    blank = {(r.score, r.posterior) for r in got if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1                                       # nothing to judge: prior and bias
    nothing = Q.fit(empty)
    assert Q.score(empty, nothing).count() == 0 and Q.score(edge, nothing).count() == edge.count()
