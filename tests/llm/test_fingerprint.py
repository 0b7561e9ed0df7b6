import hashlib

import numpy as np
import pytest

from ledgerline.llm import fingerprint as P
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS


def expected(rows):
    order = sorted((i, t or "") for i, t in rows if i is not None)
    out = [(None, t or "", t or "") for i, t in rows if i is None]
    out += [(i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]
    return [(i, t, t[:len(t) - len(t) // 2] + nxt[:len(t) // 2], nxt) for i, t, nxt in out]


def check(rows, got):
    want = sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in expected(rows)), key=str)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == want


@pytest.mark.parametrize("size", [3_000, 16 << 20])
def test_query_against_brute_force(spark, texts, monkeypatch, size):
    monkeypatch.setattr(P, "RANGE_BYTES", size)
    got = QUERIES["op7_fingerprints"](spark, SF001).collect()
    check(list(texts.items()), got)
    by = {r.doc_id: r for r in got}
    errors = []
    for i, t, e, nxt in expected(list(texts.items())):
        a, b, c = brute.shingles(t), brute.shingles(e), brute.shingles(nxt)
        if len(a) > 300:
            errors.append(by[i].near_edited - len(a & b) / len(a | b))
            assert abs(by[i].near_next - len(a & c) / len(a | c)) < 0.25
    assert np.abs(errors).mean() < 0.08 and abs(np.mean(errors)) < 0.04
    same = {}
    for r in got:
        assert same.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_edges(spark, edge, empty):
    got = P.edited_fingerprints(edge, with_text=False).collect()
    check(EDGE_ROWS, got)
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {""}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.edited_fingerprints(empty).count() == 0
    one = P.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [(r.edited, r.near_next) for r in one] == [("abcabc", 1.0)]
    plain = {(r.doc_id, r.fingerprint) for r in P.fingerprints(edge).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in got}


def test_merge_and_containment():
    r = np.random.default_rng(2)
    whole = np.unique(r.integers(0, 2 ** 64, 20_000, dtype=np.uint64))
    part = whole[::10]
    a, b = P.keep(whole, P.FRACTION), P.keep(part, P.FRACTION)
    assert P.containment(b, a) == 1.0
    assert abs(P.containment(a, b) - 0.1) < 0.02 and abs(P.likeness(a, b) - 0.1) < 0.02
    assert (P.merge(P.keep(whole[:9000], P.FRACTION), P.keep(whole[7000:], P.FRACTION)) == a).all()
    high = np.array([2 ** 64 - 5, 2 ** 64 - 3], np.uint64)
    assert P.keep(high, P.FRACTION).tolist() == [2 ** 64 - 5]
    assert (P.from_text(P.to_text(a)) == a).all()
    assert P.likeness(a[:0], a[:0]) == 1.0 and P.likeness(a, a[:0]) == 0.0
