import hashlib
import os
import shutil
import subprocess
import sys
from collections import Counter

import corpus_pipeline as C
from ledgerline.llm import toxicity
from ledgerline.llm.queries import read
from ledgerline.llm.scratch import Scratch
from tests.conftest import ROOT, SF001
from tests.llm import brute
from tests.llm.test_bpe import reference
from tests.llm.test_mixing import fill

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(C.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["toxicity", "ngram_jaccard", "suffix_dedup", "mixing", "byte_bpe"]


def test_each_stage_against_brute_force(spark):
    scratch, docs = Scratch(spark, "t"), read(spark, SF001, "documents")
    before = docs.collect()

    out = scratch.store(stage("toxicity")(spark, docs, SF001), "toxicity")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, read(spark, SF001, "labels"))).collect()}
    rows = out.collect()
    assert out.columns == COLUMNS and sorted(rows) == sorted(r for r in before if scores[r.doc_id] < C.TOXIC)

    docs, before = out, rows
    out = scratch.store(stage("ngram_jaccard")(spark, docs, SF001), "jaccard")
    rows = out.collect()
    stay = {i for i, _, c in brute.classes([(r.doc_id, r.text) for r in before]) if i == c}
    assert out.columns == COLUMNS and sorted(rows) == sorted(r for r in before if r.doc_id in stay)

    docs, before = out, rows
    out = scratch.store(stage("suffix_dedup")(spark, docs, SF001), "suffix")
    rows = out.collect()
    kept = {i: k.decode("utf-8", "ignore") for i, k, _ in brute.cut_windows([(r.doc_id, r.text) for r in before])}
    assert out.columns == COLUMNS
    assert sorted(tuple(r) for r in rows) == sorted((r.doc_id, kept[r.doc_id], r.lang, r.source, len(kept[r.doc_id])) for r in before)

    docs, before = out, rows
    out = scratch.store(stage("mixing")(spark, docs, SF001), "mixing")
    rows = out.collect()
    assert out.columns == COLUMNS
    sizes, taken = Counter(), Counter()
    by = {r.doc_id: r for r in before}
    for r in before:
        sizes[r.source] += len(brute.words(r.text))
    cut = Counter()
    for r in rows:
        taken[r.source] += len(brute.words(r.text))
        if r.text != by[r.doc_id].text:
            cut[r.source] += 1
            assert brute.words(r.text) == brute.words(by[r.doc_id].text)[:len(brute.words(r.text))]
    target = fill(sizes, C.WEIGHTS, 1.5, 2.0)
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-9 for s in sizes)
    assert max(cut.values()) <= 1 and max(Counter(r.doc_id for r in rows).values()) <= 2

    final = stage("byte_bpe")(spark, out, SF001).collect()
    assert sorted((r.doc_id, bytes(r.ids), r.decoded_sha256, r.n_tokens) for r in final) == sorted(
        (r.doc_id, reference(r.text), brute.sha(r.text.encode()), len(reference(r.text)) // 4) for r in rows)
    assert sorted(map(tuple, C.run(spark, SF001).select("doc_id", "n_tokens").collect())) == sorted(
        (r.doc_id, r.n_tokens) for r in final)


def test_edges_go_through_all_stages(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows and ids, through stages 2 to 5."""
    rows = [(1, "a b c d e f g h", "en", "s", 15), (1, "a b c d e f g h", "en", "s", 15), (2, None, None, None, None), (3, "", "en", None, 0),
            (None, "a b c d e f g h", None, "s", 1), (None, "a b c d e f g h", None, "s", 1), (4, "x y z w v u t s", None, "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scratch, labels = Scratch(spark, "t"), spark.createDataFrame([(4, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for data, least in ((docs, 1), (docs.limit(0), 0)):
        for name, f in C.STAGES:
            data = scratch.store(f(spark, data, str(tmp_path)), name)
            if name == "ngram_jaccard" and least:
                assert Counter(r.doc_id for r in data.collect()) == {1: 1, 2: 1, 3: 1, None: 2, 4: 1}
        assert data.count() >= least


def test_the_rest_works_without_this_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [k for k in q if k.startswith('op') or k == 'pipeline'], len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    assert "['ops" not in out.stdout and "[]" in out.stdout


def test_all_fourteen_queries_are_registered():
    import __spark_entry__ as E
    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())


def test_dissimilar_texts_under_one_id_stay(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, a), (5, a + " end"), (5, b), (5, b + " end"), (5, b + " end"), (5, c), (7, c), (8, ""), (8, None), (8, ""),
            (8, a), (9, b), (None, a), (3, "one of its own")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = stage("ngram_jaccard")(spark, docs, SF001)
    first_b = min((b, b + " end"), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert got.columns == COLUMNS
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, a), (5, first_b), (5, c), (8, ""), (8, None), (None, a), (3, "one of its own")], key=str)
