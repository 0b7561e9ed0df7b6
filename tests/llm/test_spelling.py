import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import re

from ledgerline.llm import spelling as S
from ledgerline.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS, LONG

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def planted(rows):
    """Counts of the words of rows (id, text), a run in 31 without a code point."""
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            out[run if h % 31 else run[:k] + run[k + 1:]] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def groups(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, S.variant_groups(df, **options).collect()))


def test_query_against_brute_force(spark, documents, tmp_path):
    some = documents.filter("doc_id % 7 = 0")
    some.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in some.collect()]
    got = sorted(map(tuple, QUERIES["op11_spelling_variants"](spark, str(tmp_path)).collect()))
    assert got == sorted(brute.variant_groups(planted(rows)))
    assert any(r[4] for r in got)


def test_edges(spark, edge, empty, tmp_path):
    edge.write.parquet(f"{tmp_path}/a/documents.parquet")
    got = sorted(map(tuple, QUERIES["op11_spelling_variants"](spark, f"{tmp_path}/a").collect()))
    assert got == sorted(brute.variant_groups(planted(EDGE_ROWS)))
    empty.write.parquet(f"{tmp_path}/b/documents.parquet")
    assert QUERIES["op11_spelling_variants"](spark, f"{tmp_path}/b").count() == 0
    assert "lorem" in LONG


COUNTS = {
    "station": 5000, "statioon": 40, "statoin": 3, "stattion": 400, "stattiion": 30, "staion": 60, "staaion": 5,
    "nation": 100, "notion": 100, "motion": 1000, "lotion": 1000, "potion": 9, "àbcdefg": 20, "ábcdefg": 2, "abcdefg": 2, "âbcdefg": 200,
    "ÿÿÿÿÿÿÿ": 10, "ÿÿÿÿÿÿ": 100, "ÿÿÿÿÿÿÿÿ": 100, "aaaaaaa": 1, "aaaaaa": 10, "aaaaaaaa": 9, "b": 3, "": 40, "ab": 2, "alone": 7, "x×÷y": 5, "x×y": 50,
}


@pytest.mark.parametrize("ratio", [2, 10])
def test_chains_ties_runs_and_short_words(spark, ratio):
    assert groups(spark, COUNTS, ratio=ratio) == sorted(brute.variant_groups(COUNTS, ratio))


def test_ratio(spark):
    with pytest.raises(ValueError, match="ratio"):
        groups(spark, COUNTS, ratio=1)


def many(n, seed=5):
    r = np.random.default_rng(seed)
    words = {"".join(r.choice(list("abcdeà"), size=r.integers(5, 8))) for _ in range(n)}
    return {w: int(x) for w, x in zip(sorted(words), (10 ** r.uniform(0, 4, len(words))).astype(int) + 1, strict=True)}


def test_rounds_and_slices_of_filters(spark, monkeypatch):
    """The same result when filters are cut into small slices and broadcast one or two at a time."""
    counts = many(700)
    whole = sorted(brute.variant_groups(counts))
    assert groups(spark, counts) == whole
    monkeypatch.setattr(S, "SLICE_BLOCKS", 64)
    monkeypatch.setattr(S, "ROUND_BYTES", 1100)
    monkeypatch.setattr(S, "SLAB", 50)
    assert groups(spark, counts) == whole


def test_a_chain_of_forms_is_followed_to_its_end(spark):
    word = "abcdefghijkl"
    counts = {word[:k] + word[k:].upper().lower().replace(word[k] if k < 12 else "?", "z", 1) if k < 12 else word: 2 * 10 ** k for k in range(13)}
    chain = {"z" * k + "a" * (9 - k): 2 * 10 ** k for k in range(10)}
    assert groups(spark, chain) == sorted(brute.variant_groups(chain))
    assert {r[2] for r in groups(spark, chain)} == {"z" * 9}
    assert groups(spark, counts) == sorted(brute.variant_groups(counts))


def test_very_long_words(spark):
    long = "abcdefghij" * 3000
    counts = {long: 50, long[:700] + long[701:]: 5, long[:-1] + "q": 4, "q" + long: 60, long[5:]: 3}
    assert groups(spark, counts) == sorted(brute.variant_groups(counts))


def test_filter_has_no_false_negatives_and_few_positives():
    words = pa.array([f"w{k}x" for k in range(5000)])
    h = S.word_hashes(words)
    blocks = -(-len(h) // S.WORDS_PER_BLOCK)
    table = pa.table({"chars": [5] * len(h), "blocks": [blocks] * len(h), "part": [0] * len(h), "h": h.view(np.int64)})
    bits = S._build(S.SLICE_BLOCKS)(table).column("bits")[0].as_py()
    f = S._Filter([(5, blocks, 0, bits)])
    assert len(f.holds(5, h)) == len(h)
    other = S.word_hashes(pa.array([f"v{k}x" for k in range(20000)]))
    assert len(f.holds(5, other)) < 100
    assert not len(f.holds(6, h))
