import pytest

from ledgerline.llm import unit_dedup as U
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_against_brute_force(spark, documents, texts, unit):
    got = {r.doc_id: (bytes(r.kept), [(s.start, s.end) for s in r.spans])
           for r in U.remove_repeated_units(documents, unit=unit).collect()}
    assert got == {i: v for (i, _), v in brute.cut_units(list(texts.items()), unit).items()}


def test_query(spark, texts):
    expected = {i: (len((t or "").encode()), brute.sha(kept), len(spans), n)
                for (i, t), (kept, spans, n) in brute.cut_lines_and_passages(list(texts.items())).items()}
    got = QUERIES["op1_substring_dedup"](spark, SF001).collect()
    assert {r.doc_id: (r.n_bytes, r.kept_sha256, r.n_spans, r.n_units) for r in got} == expected
    assert sum(r.n_removed > 0 for r in got) > 10


@pytest.mark.parametrize("flush", [1 << 10, 6 << 20])
def test_lines_and_passages_over_many_packs(spark, documents, monkeypatch, flush):
    monkeypatch.setattr(U, "FLUSH_BYTES", flush)
    rows = [(r.doc_id, r.text) for r in documents.collect()][:80]
    rows += [(300, "Yes."), (301, "A new one. Yes."), (302, " Yes.\n\nyes.\nA new  one. YES.\n"), (303, None), (304, " \n"), *rows[::9]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, bytes(r.kept), [(s.start, s.end) for s in r.spans], r.n_units) for r in U.remove_repeated_units(df, unit="line+sentence").collect())
    cut = brute.cut_lines_and_passages(rows)
    assert got == sorted((i, *cut[i, t or ""]) for i, t in rows)


def test_rows_are_told_apart_by_their_whole_texts(spark):
    """Two texts under one id whose CRC-32 agree in 16 bits: neither is cut at the other's spans."""
    import zlib
    line = "a line that both have " * 4
    one = f"{line}\nand some words of its own"
    k = next(k for k in range(1 << 20) if zlib.crc32(f"unrelated {k} text {line[::-1]}".encode()) & 0xFFFF == zlib.crc32(one.encode()) & 0xFFFF)
    two = f"unrelated {k} text {line[::-1]}"
    rows = [(1, line), (2, one), (2, two)]
    got = sorted((r.doc_id, bytes(r.kept).decode()) for r in U.remove_repeated_units(
        spark.createDataFrame(rows, "doc_id long, text string"), unit="line+sentence").collect())
    assert got == sorted([(1, line), (2, "and some words of its own"), (2, two)])


def test_edges(edge, empty):
    got = sorted(((r.doc_id, bytes(r.kept)) for r in U.remove_repeated_units(edge).collect()), key=str)
    cut = brute.cut_units(EDGE_ROWS)
    assert got == sorted(((i, cut[i, t or ""][0] if i is not None else (t or "").encode()) for i, t in EDGE_ROWS), key=str)
    assert U.remove_repeated_units(empty).count() == 0


def test_a_planted_passage_goes_and_short_phrases_stay(spark):
    passage = " ".join(f"Sentence {k} of the planted passage has a number of plain words in it." for k in range(6))
    rows = [(1, f"Start here. {passage} End of one."), (2, f"Other text first\n{passage} So it ends. Yes. No."),
            (3, "A clean document. Yes. No. Nothing of it stands anywhere else in this corpus.")]
    got = {r.doc_id: r for r in U.remove_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert bytes(got[1].kept).decode() == rows[0][1]
    assert bytes(got[2].kept).decode() == "Other text first\nSo it ends. Yes. No."
    assert rows[1][1].encode()[got[2].spans[0].start:got[2].spans[0].end].decode().strip() == passage
    assert bytes(got[3].kept).decode() == rows[2][1]
    with pytest.raises(Exception, match="sentence"):
        U.remove_repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), unit="page").collect()


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_every_later_unit_goes_without_a_word_minimum(spark, documents, texts, unit):
    got = {r.doc_id: (bytes(r.kept), [(s.start, s.end) for s in r.spans])
           for r in U.remove_repeated_units(documents, unit=unit, min_words=1).collect()}
    seen, expected = set(), {}
    for i, t in sorted(texts.items()):
        b, kept = (t or "").encode(), b""
        us = brute.units(t, unit)
        spans = []
        for s, e, w in us:
            if w in seen:
                spans = [*spans[:-1], (spans[-1][0], e)] if spans and spans[-1][1] == s else [*spans, (s, e)]
            seen.add(w)
        last = 0
        for s, e in spans:
            kept, last = kept + b[last:s], e
        expected[i] = (kept + b[last:], spans)
    assert got == expected


def test_the_query_keeps_no_repeated_line_and_cuts_no_short_sentence(spark, tmp_path):
    rows = [(1, "Read our terms first.\nA text of its own stands here, for once.\nAll rights reserved"),
            (2, "Another text, which nobody else has.\nall  rights reserved\nSee above. Yes."),
            (3, "Read our terms first.\nIt says so. Yes. And one more sentence.\nAll rights reserved\nAll rights reserved")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect()}
    kept = {1: rows[0][1], 2: "Another text, which nobody else has.\nSee above. Yes.", 3: "It says so. Yes. And one more sentence.\n"}
    assert {i: r.kept_sha256 for i, r in got.items()} == {i: brute.sha(t.encode()) for i, t in kept.items()}
    assert {i: (r.n_units, r.n_spans) for i, r in got.items()} == {1: (0, 0), 2: (1, 1), 3: (3, 2)}
