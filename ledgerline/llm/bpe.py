"""Byte-level BPE encoding by merges of many pieces at once, and decoding.

The vocabulary is a rank file (one ``base64(token) rank`` a line); merging the lowest rank first
is reproduced exactly. The distinct pieces of about a megabyte of text that are not remembered are
merged side by side, one column of an array each: a round finds the lowest rank of every column,
merges there and looks up the two pairs that changed in a hash table of token pairs. Pieces that
were in use lately are remembered (two generations, bounded in number and length; this only saves
time).

Long pieces are encoded alone, by backtracking over longest matches, in linear time: bytes map to
Latin-1 characters, so one Aho-Corasick automaton finds the longest token at every place. The walk
takes the longest match that fits the token before it, falls back to shorter tokens, and steps
back over a token when none fits. Two tokens fit when the merges leave their two byte strings as
exactly these two tokens; a token sequence whose neighbours all fit is *the* encoding of its bytes,
so each place of a piece can fail only once and the walk is linear. Whether two tokens fit is
remembered for each pair (bounded too).

Texts are split by the tokenizer's pattern first; each match is encoded separately, without
special tokens. The vocabulary's path is a parameter; the driver reads the file and broadcasts it
(its size is bounded by the vocabulary, not by the data).

Rows: a null or empty text gives no ids and decodes to nothing; null ids of documents and repeated
rows pass through; extra columns are ignored; an empty table gives an empty result. Ids outside
the vocabulary raise ``ValueError`` on decoding.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import rename_clear
from ledgerline.llm.textkernel import BASE, slabs, text_bytes

PIECES_KEPT = 100_000            # pieces of a generation that a worker remembers
PAIRS_KEPT = 1_000_000           # token pairs a worker remembers
LONG = 64                        # bytes from which a piece is encoded alone, characters from which it is not remembered
COLUMNS = 2048                   # pieces merged side by side
FEW = 16                         # pieces too few for that
NONE = 1 << 40                   # rank of a pair that is no token


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in blob.splitlines() if line)}


class TokenPairs:
    """Hash table of the token pairs that merge: open addressing, many pairs looked up at once."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, ranks: dict[bytes, int]):
        rows = [(ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items()
                for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        keys = np.array([key for key, _ in rows], np.uint64)
        found = np.array([i for _, i in rows], np.int64)
        bits = max(4, (4 * len(rows)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, self.FREE), np.full(1 << bits, NONE)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == self.FREE]
            self.keys[at[free]] = keys[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.last
        self.ranks[at] = found

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * BASE) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, else ``NONE``; a token of -1 is none."""
        keys = (a << 32 | b).view(np.uint64)
        at = self._home(keys)
        there = self.keys[at]
        out = self.ranks[at]
        other = np.flatnonzero(there != keys)
        out[other] = NONE
        other = other[there[other] != self.FREE]
        while len(other):
            at[other] = (at[other] + 1) & self.last
            there = self.keys[at[other]]
            same = other[there == keys[other]]
            out[same] = self.ranks[at[same]]
            other = other[(there != keys[other]) & (there != self.FREE)]
        return out


class BytePairCoder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: bytes {missing[:5]} have no token")
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.size = {i: len(t) for t, i in ranks.items()}
        self._fits: dict[tuple[int, int], bool] = {}
        self.matches = ahocorasick.Automaton()
        # a token that merging can't produce is only found as a whole piece
        made = {t: i for t, i in ranks.items() if len(t) < 2 or self.merge(t) == [i]}
        for token, i in made.items():
            self.matches.add_word(token.decode("latin-1"), (len(token), i))
        self.matches.make_automaton()
        self.shorter = {i: next((made[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in made), None)
                        for t, i in made.items()}
        self.unmade = ranks.keys() - made.keys()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = TokenPairs(ranks)
        self.pieces: dict[str, bytes] = {}           # packed ids of pieces seen lately
        self.older: dict[str, bytes] = {}            # and of the generation before

    def merge(self, piece: bytes) -> list[int]:
        """The definition: merge the pair of lowest rank, leftmost first, until none is left."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            rank, k = min((self.ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [(0, -1)] * n
        for end, match in self.matches.iter(piece.decode("latin-1")):
            start = end - match[0] + 1
            if match > longest[start]:
                longest[start] = match
        size, shorter, known = self.size, self.shorter, self._fits
        failed = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0][1]
        while True:
            before = out[-1] if out else None
            while token is not None:
                if not failed[at + size[token]]:
                    if before is None:
                        break
                    fit = known.get((before, token))
                    if fit if fit is not None else self.fits(before, token):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += size[token]
                if at == n:
                    return out
                token = longest[at][1]
            else:
                failed[at] = 1
                out.pop()
                at -= size[before]
                token = shorter[before]

    def merge_together(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of the byte strings raw[start:start + size], all at once: (ids end to end, number of ids of each).

        Column i holds string i, a row each place; the row after the last stands for both ends of every
        string. ``best`` has the rank of the pair that starts at a place and, in its lowest bits, the place.
        """
        n, w = len(starts), int(sizes.max())
        bits = w.bit_length()
        places = np.arange(w)[:, None]
        inside = places < sizes
        token = np.full((w + 1, n), -1)
        token[:w][inside] = self.byte_ids[raw[(starts + places)[inside]]]
        best = np.full((w + 1, n), NONE << bits)
        best[:w] = self.pairs.find(token[:-1].ravel(), token[1:].ravel()).reshape(w, n) << bits | places
        after, before = np.empty((w + 1, n), np.int64), np.empty((w + 1, n), np.int64)
        after[:w], after[w] = np.where(places + 1 < sizes, places + 1, w), w
        before[1:], before[0] = places, w
        rows = best[:w]
        token_, best_, after_, before_ = token.ravel(), best.ravel(), after.ravel(), before.ravel()
        while True:
            lowest = rows.min(axis=0)
            on = np.flatnonzero(lowest < NONE << bits)
            if not len(on):
                break
            rank = lowest[on]
            place = rank & ((1 << bits) - 1)
            rank >>= bits
            here = place * n + on
            right = after_[here] * n + on
            beyond = after_[right]
            left = before_[here]
            token_[here], token_[right], best_[right] = rank, -1, NONE << bits
            after_[here] = beyond
            beyond = beyond * n + on
            before_[beyond] = place
            best_[here] = self.pairs.find(rank, token_[beyond]) << bits | place
            start = left * n + on
            best_[start] = self.pairs.find(token_[start], rank) << bits | left
        whole = token[:w].T
        alive = whole >= 0
        return whole[alive], alive.sum(axis=1)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece."""
        raw, offsets = text_bytes(pa.array(pieces, pa.large_string()))
        sizes = np.diff(offsets)
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], LONG)) if len(pieces) >= FEW else 0
        out: list[bytes] = [b""] * len(pieces)
        for at in range(0, short, COLUMNS):
            rows = order[at:min(at + COLUMNS, short)]
            ids, counts = self.merge_together(raw, offsets[rows], sizes[rows])
            packed = ids.astype("<u4").tobytes()
            ends = np.cumsum(counts) * 4
            for i, start, end in zip(rows.tolist(), (ends - counts * 4).tolist(), ends.tolist(), strict=True):
                out[i] = packed[start:end]
        alone = order[short:].tolist()
        if self.unmade:
            alone += [i for i in order[:short].tolist() if pieces[i].encode() in self.unmade]
        for i in alone:
            ids = self.encode_piece(pieces[i].encode())
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _packed(self, split: list[list[str]]) -> list[bytes]:
        """Packed ids of each list of pieces, end to end."""
        if len(self.pieces) >= PIECES_KEPT:
            self.older, self.pieces = self.pieces, {}
        pieces, older = self.pieces, self.older
        new = set().union(*split).difference(pieces)
        pieces.update((p, older[p]) for p in new if p in older)
        todo = [p for p in new if p not in pieces]
        pieces.update(zip(todo, self.encode_pieces(todo), strict=True))
        out = [b"".join(map(pieces.__getitem__, s)) for s in split]
        for p in todo:
            if len(p) >= LONG:
                del pieces[p]
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, each as little-endian unsigned 32-bit integers; null counts as empty."""
        split = [self.split(t) if t else [] for t in texts]
        if len(split) == 1:          # may be long
            s = split[0]
            return [b"".join(self._packed([s[k:k + PIECES_KEPT]])[0] for k in range(0, len(s), PIECES_KEPT))]
        return self._packed(split)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except KeyError as e:
            raise ValueError(f"id {e.args[0]} is not in the vocabulary") from None


_CODERS: dict[tuple[int, str], BytePairCoder] = {}


def coder_of(blob: bytes, pattern: str) -> BytePairCoder:
    """One coder for each vocabulary and worker process."""
    key = (hash(blob), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = BytePairCoder(parse_ranks(blob), pattern)
    return _CODERS[key]


def _vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row, ids packed as little-endian unsigned 32-bit integers.

    With ``decoded`` also the bytes that the ids decode to.
    """
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blob = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(blob.value, pattern)
        for whole in batches:
            for i, j in slabs(text_bytes(whole.column("text"))[1]):
                b = whole.slice(i, j - i)
                ids = coder.encode_all(b.column("text").to_pylist())
                cols = {"doc_id": b.column("doc_id"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    cols["decoded"] = pa.array([coder.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)
    return docs.mapInArrow(run, "doc_id long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of packed ids; null ids decode to nothing."""
    encoded = rename_clear(encoded, {"doc_id": id_col, "ids": ids_col})
    blob = _vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(blob.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "decoded": pa.array(
                [coder.decode(x) if x else b"" for x in b.column("ids").to_pylist()], pa.binary())})
    return encoded.mapInArrow(run, "doc_id long, decoded binary")
