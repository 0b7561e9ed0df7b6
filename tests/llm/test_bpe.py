import hashlib

import numpy as np
import pytest
import public_tokenizers as V
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm.conftest import EDGE_ROWS

PATH = V.path("byte_bpe_multi_50k.tiktoken")
with open(PATH, "rb") as f:
    BLOB = f.read()
CODER = bpe.coder_of(BLOB, V.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=V.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})


def reference(text):
    return np.array(REFERENCE.encode_ordinary(text or ""), "<u4").tobytes()


def test_query_against_tiktoken(spark, texts):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op9_byte_bpe"](spark, SF001).collect()}
    assert got == {i: (len(reference(t)) // 4, hashlib.sha256(reference(t)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in texts.items()}


def test_edges(edge, empty):
    got = bpe.encode(edge, PATH, V.PATTERN, decoded=True).collect()
    want = sorted(((i, reference(t), (t or "").encode()) for i, t in EDGE_ROWS), key=str)
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=str) == want
    assert bpe.encode(empty, PATH, V.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(edge, PATH, V.PATTERN), PATH, V.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted(w[2] for w in want)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = CODER.encode(text)
    assert ids == reference(text)
    assert CODER.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abt hei'sn\n", max_size=200))
def test_repetitive_text(text):
    assert CODER.encode(text) == reference(text)


@pytest.mark.parametrize("text", ["ab" * 20_000, " " * 30_000 + "x", "a" * 5_000, "　\x1c\x85​" * 50, "'s'S're" * 100])
def test_long_pieces(text):
    assert CODER.encode(text) == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=2, max_size=4).filter(lambda b: set(b) <= set(b"abc")), st.just(0), max_size=12),
       st.text(alphabet="abc", max_size=12))
def test_backtracking_gives_the_merges_of_any_vocabulary(extra, text):
    """Also for vocabularies with tokens that merging can't produce."""
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(extra)}
    coder = bpe.BytePairCoder(ranks, r"\S+")
    piece = text.encode()
    if piece:
        assert coder.encode_piece(piece) == ([ranks[piece]] if piece in ranks else coder.merge(piece))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=2, max_size=4).filter(lambda b: set(b) <= set(b"abc")), st.just(0), max_size=12),
       st.lists(st.text(alphabet="abc", min_size=1, max_size=90), min_size=1, max_size=40, unique=True))
def test_many_pieces_at_once_are_merged_as_one_is(extra, pieces):
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(extra)}
    coder = bpe.BytePairCoder(ranks, r"\S+")
    want = [[ranks[p.encode()]] if p.encode() in ranks else coder.merge(p.encode()) for p in pieces]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode_pieces(pieces)] == want


def new_words(n, seed=1):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzéßñ中д"))
    return ["".join(rng.choice(letters, k)) for k in rng.integers(3, 16, n)]


def test_new_pieces_are_not_encoded_one_by_one(monkeypatch):
    """Encoding each unseen piece in Python made most of the seconds of ``op9_byte_bpe``."""
    coder, alone = bpe.BytePairCoder(CODER.ranks, V.PATTERN), []
    one = coder.encode_piece
    monkeypatch.setattr(coder, "encode_piece", lambda piece: alone.append(piece) or one(piece))
    text = " ".join([*new_words(5_000), "x" * 200, "x" * 200])
    assert coder.encode(text) == reference(text)
    assert alone == [b" " + b"x" * 200]
    assert " " + "x" * 200 not in coder.pieces


def test_forgotten_pieces(monkeypatch):
    """A piece in use stays known over a change of generation; memory stays bounded, also in one long text."""
    monkeypatch.setattr(bpe, "PIECES_KEPT", 100)
    coder, asked = bpe.BytePairCoder(CODER.ranks, V.PATTERN), []
    many = coder.encode_pieces
    monkeypatch.setattr(coder, "encode_pieces", lambda pieces: asked.extend(pieces) or many(pieces))
    for k in range(20):
        texts = [" often " + " ".join(new_words(40, seed=k)), None, "", " often"]
        assert coder.encode_all(texts) == [reference(t) for t in texts]
    assert asked.count(" often") == 1
    long = " ".join(new_words(3_000, seed=50))
    assert coder.encode(long) == reference(long)
    assert max(len(coder.pieces), len(coder.older)) <= 200


def test_errors():
    with pytest.raises(ValueError, match="vocabulary"):
        CODER.decode(np.array([10 ** 6], "<u4").tobytes())
    with pytest.raises(ValueError, match="byte-level"):
        bpe.BytePairCoder({b"a": 0}, r"\S+")
