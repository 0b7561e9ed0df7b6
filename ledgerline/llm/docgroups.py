"""Documents in groups: rows named by (id, digest of the text), whole texts packed by group of documents.

A group is chosen by a hash of the id, so what an operator finds about a document can be sent to its text,
which travels once, compressed together with the other texts of its group and map task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

from ledgerline.llm import textkernel as K

U64 = np.uint64
BUCKET_BYTES = 8 << 20           # text bytes behind one bucket or document group
FLUSH_BYTES = 6 << 20            # text bytes a map task packs before it sends them
DOC = np.dtype([("id", "<i8"), ("variant", "<u8")])        # a row: its id and 64 bits of its text
TEXT = 2                         # kind of the rows that hold texts; operators choose kinds for what they found

# texts, and what was found about them, by group of documents
FOUND = pa.schema([("grp", pa.int32()), ("kind", pa.int8()), ("docs", pa.binary()), ("first", pa.binary()),
                   ("shape", pa.binary()), ("gram", pa.binary()), ("body", pa.binary()), ("carried", pa.binary())])
FOUND_DDL = "grp int, kind byte, docs binary, first binary, shape binary, gram binary, body binary, carried binary"


def text_name(text) -> int:
    """64 bits that tell the texts of one id apart."""
    return xxhash.xxh3_64_intdigest(text)


def batch_docs(b: pa.RecordBatch):
    ids = pc.fill_null(b.column("doc_id"), 0).to_numpy()      # filled first: nulls would make floats of the ids
    valid = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    raw, offsets = K.text_bytes(b.column("text"))
    view = memoryview(raw)
    variant = np.array([text_name(view[s:e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], U64)
    docs = np.zeros(len(ids), DOC)
    docs["id"], docs["variant"] = ids, variant
    return docs, valid, raw, offsets, variant


def groups_of(docs: np.ndarray, n_groups: int) -> np.ndarray:
    return (K.mix64(docs["id"].astype(np.int64).view(U64) + U64(7)) % U64(n_groups)).astype(np.int64)


def cuts(sorted_keys: np.ndarray):
    """(key, start, end) of the runs of equal keys."""
    if not len(sorted_keys):
        return
    cut = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    yield from zip(sorted_keys[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(sorted_keys)], strict=True)


def pack_texts(n_groups: int, carry: list[str] | None = None):
    """Whole texts, compressed together by group of documents; columns to carry go along as Arrow streams."""
    def flush(parts) -> pa.RecordBatch:
        docs = np.concatenate([p[0] for p in parts])
        group = np.concatenate([p[1] for p in parts])
        bodies = [x for p in parts for x in p[2]]
        valid = np.concatenate([p[3] for p in parts])
        extra = pa.Table.from_batches([p[4] for p in parts]) if carry else None
        order = np.argsort(group, kind="stable")
        zip_ = zstandard.ZstdCompressor(level=3)
        rows = {c: [] for c in FOUND.names}
        for key, s, e in cuts(group[order]):
            o = order[s:e]
            own = [bodies[x] for x in o.tolist()]
            for c, x in zip(FOUND.names, (key, TEXT, docs[o].tobytes(), np.array([len(t) for t in own], np.uint32).tobytes(),
                                          valid[o].tobytes(), None, zip_.compress(b"".join(own)),
                                          zip_.compress(_stream(extra.take(o))) if carry else None), strict=True):
                rows[c].append(x)
        return pa.RecordBatch.from_pydict(rows, schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            docs, valid, raw, offsets, variant = batch_docs(b)
            group = np.where(valid, groups_of(docs, n_groups), (variant % U64(n_groups)).astype(np.int64))
            for i, j in K.slabs(offsets, FLUSH_BYTES):
                bodies = [raw[s:e].tobytes() for s, e in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist(), strict=True)]
                parts.append((docs[i:j], group[i:j], bodies, valid[i:j], b.select(carry).slice(i, j - i) if carry else None))
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


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def carried_columns(table) -> pa.Table:
    """Carried columns of a group of documents, in the order of ``_read_group``."""
    unzip = zstandard.ZstdDecompressor()
    return pa.concat_tables([pa.ipc.open_stream(unzip.decompress(x)).read_all() for kind, x in zip(
        table.column("kind").to_pylist(), table.column("carried").to_pylist(), strict=True) if kind == TEXT])


def read_group(table):
    """Texts of a group of documents: [(doc, valid, bytes)]."""
    out, unzip = [], zstandard.ZstdDecompressor()
    for kind, docs, sizes, valid, body in zip(*(table.column(c).to_pylist() for c in ("kind", "docs", "first", "shape", "body")), strict=True):
        if kind != TEXT:
            continue
        blob, at = unzip.decompress(body) if body else b"", 0
        for d, n, v in zip(np.frombuffer(docs, DOC).tolist(), np.frombuffer(sizes, np.uint32).tolist(), valid, strict=True):
            out.append((d, bool(v), blob[at:at + n]))
            at += n
    return out
