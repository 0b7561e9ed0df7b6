"""Threshold-scaled document fingerprints: every shingle hash below a fixed fraction of the range.

The fingerprint of a text keeps all hashes of its distinct word 5-grams that are below
``fraction`` of the 64-bit range, so its size follows the text, the same shingle is kept or dropped
in every document, and fingerprints of very unequal documents compare: ``containment`` estimates
which share of one is in the other, ``likeness`` the Jaccard similarity, and ``merge`` gives the
fingerprint of the union. A text whose hashes are all above the threshold keeps its smallest one
(also mergeable: the smallest of a union is the smallest of the two), so only texts without words
have an empty fingerprint. As a string it is the ascending hashes in 16 hex digits each.

``edited_fingerprints`` compares each document with an edited version of itself, whose second
half is the head of the next document, and with the next document itself. Only ids and byte
counts are sorted globally (range partitions and prefix sums); they cut the order of ids into
ranges of equal bytes, whole texts travel once, compressed, to their range, and the first
document of a range also goes to the range before it.

Rows: a null text is empty (no shingles, empty fingerprint; two empty fingerprints have likeness 1,
an empty and another one 0). Rows that repeat an id follow each other in the order of their texts.
A row without an id has no place in the order: its next document is itself. Extra columns are
ignored. An empty table gives an empty result; the next document of a single one is itself.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.prefix_sum import range_sorted, running_sums
from ledgerline.llm.scratch import Scratch, rename_clear

U64 = np.uint64
FRACTION = 1 / 8
RANGE_BYTES = 16 << 20           # text bytes of one range of ids; the starts of the ranges are broadcast: one
#                                  long for each, 50 MB at 100 TB
TEXTS_AT_ONCE = 256
FLUSH_BYTES = 8 << 20            # text bytes a map task packs before it sends them


def keep(hashes: np.ndarray, fraction: float) -> np.ndarray:
    """The part of sorted distinct hashes that a fingerprint retains."""
    kept = hashes[:np.searchsorted(hashes, U64(min(int(fraction * 2.0 ** 64), 2 ** 64 - 1)))]
    return kept if len(kept) else hashes[:1]


def sketches(column, n: int = 5, fraction: float = FRACTION) -> list[np.ndarray]:
    """Fingerprints of all texts of an Arrow column, as sorted hashes."""
    out = []
    for _, _, g, ptr in K.shingle_sets(column, n):
        out.extend(keep(g[s:e], fraction) for s, e in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True))
    return out


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(U64)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """Fingerprint of the union of two texts' shingles."""
    return keep(np.union1d(a, b), fraction)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two texts' shingles."""
    if not len(a) and not len(b):
        return 1.0
    both = _common(a, b)
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second one has."""
    return _common(a, b) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame, n: int = 5, fraction: float = FRACTION, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, in one pass and without a shuffle."""
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [to_text(s) for s in sketches(b.column("text"), n, fraction)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "fingerprint": pa.array(found, pa.string())})
    return docs.mapInArrow(run, "doc_id long, fingerprint string")


PACKED = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("kind", pa.binary()), ("sizes", pa.binary()),
                    ("body", pa.binary())])
PACKED_DDL = "part int, ids binary, kind binary, sizes binary, body binary"
OWN, NEXT, ALONE = 0, 1, 2       # a row of the range; the head of the next range; a row without an id


def _pack(starts_sent):
    """Whole texts by range of ids; broadcast are the first ids of the ranges."""

    def flush(parts) -> pa.RecordBatch:
        part, ids, kind = (np.concatenate([p[c] for p in parts]) for c in range(3))
        bodies = [x for p in parts for x in p[3]]
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0]))
        zip_ = zstandard.ZstdCompressor(level=3)
        rows = {c: [] for c in PACKED.names}
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True):
            o = order[s:e]
            own = [bodies[x] for x in o.tolist()]
            for c, x in zip(PACKED.names, (int(part[o[0]]), ids[o].tobytes(), kind[o].tobytes(),
                                           np.array([len(t) for t in own], np.uint32).tobytes(),
                                           zip_.compress(b"".join(own))), strict=True):
                rows[c].append(x)
        return pa.RecordBatch.from_pydict(rows, schema=PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = starts_sent.value
        n = max(1, len(starts))
        parts, held = [], 0
        for b in batches:
            valid = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(b.column("doc_id"), 0).to_numpy()      # filled first: nulls would make floats of the ids
            raw, offsets = K.text_bytes(b.column("text"))
            for i, j in K.slabs(offsets, FLUSH_BYTES):
                bodies = [raw[s:e].tobytes() for s, e in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist(), strict=True)]
                own, ok = ids[i:j], valid[i:j]
                spread = np.array([zlib.crc32(x) % n for x in bodies], np.int64)
                part = np.where(ok, np.searchsorted(starts, own, side="right") - 1, spread)
                kind = np.where(ok, OWN, ALONE).astype(np.uint8)
                head = np.flatnonzero(ok & (starts[np.maximum(part, 0)] == own)) if len(starts) else np.zeros(0, int)
                parts.append((np.concatenate([part, (part[head] - 1) % n]), np.concatenate([own, own[head]]),
                              np.concatenate([kind, np.full(len(head), NEXT, np.uint8)]),
                              bodies + [bodies[x] for x in head.tolist()]))
                held += int(offsets[j] - offsets[i])
                if held >= FLUSH_BYTES:
                    yield flush(parts)
                    parts, held = [], 0
                    K.trim()
        if parts:
            yield flush(parts)
        parts = b = None                 # an idle worker keeps nothing
        K.trim()
    return run


EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edit(n: int, fraction: float, with_text: bool):
    """One range of ids: edit each text with the head of the next one, and compare the fingerprints."""
    schema = EDITED if with_text else pa.schema([pa.field("edited_sha256", pa.string()) if f.name == "edited" else f
                                                 for f in EDITED])

    def run(table):
        unzip, own, after, alone = zstandard.ZstdDecompressor(), [], [], []
        for ids, kind, sizes, body in zip(*(table.column(c).to_pylist() for c in PACKED.names[1:]), strict=True):
            blob, at = unzip.decompress(body), 0
            for i, k, size in zip(np.frombuffer(ids, np.int64).tolist(), kind, np.frombuffer(sizes, np.uint32).tolist(), strict=True):
                (own, after, alone)[k].append((i, blob[at:at + size]))
                at += size
        own.sort()
        # every range has the head of the next one; the first range's head follows the last document
        chains = ([[*own, min(after)]] if own else []) + [[(None, x), (None, x)] for _, x in alone]
        out = []
        for chain in chains:
            for k in range(0, len(chain) - 1, TEXTS_AT_ONCE):
                names = [i for i, _ in chain[k:k + TEXTS_AT_ONCE + 1]]
                texts = [x.decode("utf-8", "replace") for _, x in chain[k:k + TEXTS_AT_ONCE + 1]]
                edited = [t[:len(t) - len(t) // 2] + after_it[:len(t) // 2] for t, after_it in zip(texts, texts[1:], strict=False)]
                first = sketches(pa.array(texts, pa.large_string()), n, fraction)
                second = sketches(pa.array(edited, pa.large_string()), n, fraction)
                for r, t in enumerate(edited):
                    out.append((names[r], len(texts[r]), t if with_text else hashlib.sha256(t.encode()).hexdigest(),
                                to_text(first[r]), to_text(second[r]), likeness(first[r], second[r]),
                                likeness(first[r], first[r + 1])))
        K.trim()
        return pa.Table.from_arrays([pa.array([o[c] for o in out], schema.field(c).type) for c in range(len(schema))], schema=schema)
    return run


def edited_fingerprints(docs: DataFrame, n: int = 5, fraction: float = FRACTION, id_col: str = "doc_id",
                        text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Without ``with_text`` the edited text is replaced by ``edited_sha256``.
    """
    scratch = Scratch(docs.sparkSession, "fingerprint")
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = scratch.store(docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long").alias("bytes")), "ids")
    placed = running_sums(range_sorted(scratch, ids, ["doc_id"]), ["doc_id"], "bytes")
    starts = placed.groupBy(F.floor(F.col("before") / RANGE_BYTES).alias("part")).agg(F.min("doc_id").alias("start"))
    first_ids = np.sort(np.array([r.start for r in starts.select("start").toLocalIterator()], np.int64))
    ddl = ", ".join(f"{f.name} {({pa.int64(): 'long', pa.string(): 'string', pa.float64(): 'double'})[f.type]}" for f in EDITED)
    if not with_text:
        ddl = ddl.replace("edited string", "edited_sha256 string", 1)
    sent = docs.sparkSession.sparkContext.broadcast(first_ids)
    return docs.mapInArrow(_pack(sent), PACKED_DDL).groupBy("part").applyInArrow(_edit(n, fraction, with_text), ddl)
