import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as T
from ledgerline.llm.ftrl import Ftrl
from ledgerline.llm.queries import QUERIES, held_out, toxic_model
from tests.conftest import SF01


def test_held_out_accuracy(spark):
    """Documents of the unseen third: few clean ones rejected, toxic words of the training rows found."""
    got = QUERIES["op2_toxicity"](spark, SF01)
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0
    rows = got.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    # 33 toxic training rows show only part of the words
    assert sum(r.predicted for r in toxic) >= 0.5 * len(toxic)
    assert np.mean([r.score for r in toxic]) > np.mean([r.score for r in clean]) + 0.3


def test_labels_of_the_held_out_third_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    a = toxic_model(docs, labels)
    b = toxic_model(docs, labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert (a.index == b.index).all() and np.allclose(a.weight, b.weight) and np.isclose(a.bias, b.bias)


def test_refits_agree_whatever_the_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    a, b = T.fit(docs, labels), T.fit(docs.repartition(7), labels.repartition(3))
    assert (a.index == b.index).all() and np.allclose(a.weight, b.weight)
    assert len(a.index) < 2 ** T.BITS / 100                      # L1 leaves a short list


def test_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, "a"), (1, 0, "b"), (2, 0, "c"), (6, None, None), (None, 1, "d"), (99, 1, "e"), (8, 0, None)],
                                   "doc_id long, toxic int, text string")
    model = T.fit(edge, labels)
    got = T.score(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert T.score(empty, model).count() == 0
    nothing = T.fit(empty, labels.limit(0))
    assert {r.score for r in T.score(edge, nothing).collect()} == {0.5}
    kept = T.keep_clean(edge, model, 2.0)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    assert T.keep_clean(edge, model, 0.0).count() == 0


def test_bounded_sample(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = T.fit(docs, labels, max_rows=50)
    assert 0 < len(T.score(docs, model).limit(5).collect())


def test_ftrl_learns_a_separating_feature():
    m = Ftrl(8, alpha=1.0, l1=0.5)
    for _ in range(30):
        m.learn(np.array([1, 2, 3]), 1)
        m.learn(np.array([2, 3, 4]), 0)
    w = m.weights(m.z, m.n)
    assert w[1] > 0 > w[4] and w[7] == 0
