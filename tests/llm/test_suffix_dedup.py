import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import suffix_dedup as S
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS


def plain(df):
    return sorted(((r.doc_id, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, texts):
    expected = {i: (len((t or "").encode()), len((t or "").encode()) - len(kept), len(spans), brute.sha(kept))
                for (i, kept, spans), t in ((x, texts[x[0]]) for x in brute.cut_windows(sorted(texts.items())))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in QUERIES["op5_suffix_dedup"](spark, SF001).collect()}
    assert got == expected
    assert sum(v[1] for v in expected.values()) > 1000


def test_edges(edge):
    assert plain(S.remove_repeats(edge)) == sorted(brute.cut_windows(EDGE_ROWS), key=str)


def test_empty(empty):
    assert S.remove_repeats(empty).count() == 0


def test_columns_come_along(edge):
    got = S.remove_repeats(edge, carry=["grp", "source"]).collect()
    assert sorted((str(r.grp), str(r.source)) for r in got) == sorted((str(r.grp), str(r.source)) for r in edge.collect())
    assert all(r.kept_text == bytes(r.kept).decode("utf-8", "ignore") for r in got)


@pytest.mark.parametrize("at_once", [50, 200_000])
def test_common_grams_in_many_contexts(spark, monkeypatch, at_once):
    """One gram around which hundreds of runs differ: settled in slices."""
    monkeypatch.setattr(S, "WINDOWS_AT_ONCE", at_once)
    r = np.random.default_rng(5)
    common = "the quick brown fox jumps over the lazy dog "
    rows = [(i, f"{r.integers(0, 4)} {common}{r.integers(0, 9)} {common}{r.integers(0, 3)}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(S.remove_repeats(df)) == sorted(brute.cut_windows(rows), key=str)


def test_depth(spark):
    rows = [(1, "abcdefghijklmnopqrstuvwxyz"), (2, "xxabcdefghijklmnopqrstuvwxyzyy"), (0, "klmnopqrstuvwxyz0123")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(S.remove_repeats(df, depth=16)) == sorted(brute.cut_windows(rows, 16), key=str)
    with pytest.raises(ValueError):
        S.remove_repeats(df, depth=8)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=40))
def test_radix_groups_are_the_equal_entries_of_several_ids(entries):
    ids = np.array([i for i, _ in entries], np.int64)
    value = np.array([v for _, v in entries], np.int64)
    index, number = S.radix_groups(value % 3, lambda j, x: value[x].astype(np.uint64) if j == 0 else None, ids)
    got = {}
    for x, n in zip(index.tolist(), number.tolist(), strict=True):
        got.setdefault(n, set()).add(x)
    expected = [s for v in set(value.tolist()) if len(set(ids[value == v].tolist())) > 1
                for s in [set(np.flatnonzero(value == v).tolist())]]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected))


@pytest.mark.parametrize("pack,bucket,runs", [(2, 5_000, 10_000), (10 ** 9, 3, 7), (4, 3, 50)])
def test_hot_grams_are_taken_apart(spark, texts, monkeypatch, pack, bucket, runs):
    """The same result whether grams count as hot in a pack, in a bucket, or in some packs only."""
    monkeypatch.setattr(S, "HOT_RUNS", pack)
    monkeypatch.setattr(S, "HOT_IN_BUCKET", bucket)
    monkeypatch.setattr(S, "RUNS_AT_ONCE", runs)
    monkeypatch.setattr(S, "FLUSH_BYTES", 4_000)
    r = np.random.default_rng(8)
    line = "This line stands in very many documents of the corpus, at the end of some and in the middle of others. "
    rows = [(i, f"{r.integers(0, 50)} {line}{r.integers(0, 9)} {line if i % 3 else ''}{r.integers(0, 999)}") for i in range(120)]
    rows += list(texts.items())[:60]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert plain(S.remove_repeats(df)) == sorted(brute.cut_windows(rows), key=str)


def test_rows_are_told_apart_by_their_whole_texts(spark):
    """Two texts under one id whose CRC-32 agree in 16 bits: no byte of the unrelated one goes."""
    import zlib
    a = "the passage that both of the related documents hold, long enough to be found. " * 2
    one = "alpha " + a
    b = next(t for t in (f"unrelated {k} {a[::-1]}" for k in range(1 << 20)) if zlib.crc32(t.encode()) & 0xFFFF == zlib.crc32(one.encode()) & 0xFFFF)
    rows = [(1, a), (2, one), (2, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(S.remove_repeats(df)) == sorted(brute.cut_windows(rows), key=str)
