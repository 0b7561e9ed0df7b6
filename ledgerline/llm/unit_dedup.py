"""Substring dedup by unit hashing: lines, or the sentences of lines, kept once in the whole corpus.

A text is cut into units: lines, or sentences, which end at line ends and after words that end in one of ``.!?``. A
unit is normalised by lowering A-Z and treating white space runs as one space; its digest
is 96 bits over its words. Of equal units the earliest ranked occurrence, the smallest (doc_id,
place in the text), stays, and later ones go:

* ``unit="line"`` or ``"sentence"``: if the run of neighbouring later units that they stand in has at least
  ``min_words`` words; with 1, every later unit goes.
* ``unit="line+sentence"``, which the registered query uses: every later line goes, however short, and passages
  pasted inside lines go as runs of later sentences of at least ``min_words`` words. Lines are compared with lines,
  and a short sentence ("Yes.") of a line that stands nowhere else stays.

Spans are byte offsets of the original text; a removed unit takes the white space behind it along.

Digests travel packed to hash buckets. A map task settles all but the first of equal units among
the texts it packs together, so a unit that a third of all documents share is one entry for each
pack and not for each document. What is later than another goes back to the documents, which meet
their whole texts (compressed by group of documents) and cut the spans.

Rows: a null text is empty; a null id takes no part and keeps its text; rows that repeat an id and
text are settled alike, and equal units of one id are ranked by their place; texts without words
have no units. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkernel as K
from ledgerline.llm.docgroups import (BUCKET_BYTES, DOC, FLUSH_BYTES, FOUND, FOUND_DDL, TEXT, batch_docs, cuts, groups_of,
                                      pack_texts, read_group)
from ledgerline.llm.scratch import rename_clear

U64 = np.uint64
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[ord(c) for c in ".!?"]] = True
LINES = 1 << 31                  # places of lines, where sentences are units too
LINE_SALT = U64(0x6C696E65)       # and what keeps their digests apart
UNIT = np.dtype([("start", "<u4"), ("end", "<u4"), ("place", "<u4"), ("words", "<u4")])


def units_of(raw: np.ndarray, offsets: np.ndarray, unit: str = "sentence"):
    """Units of the documents of a slab: (doc index, 64-bit digest, 32 more bits, UNIT records)."""
    h, starts, doc, _ = K.words(raw, offsets)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, UNIT)
    head = np.ones(len(h), bool)
    lines = np.cumsum(raw == 10)
    head[1:] = (doc[1:] != doc[:-1]) | (lines[starts[1:]] != lines[starts[:-1]])
    if unit == "sentence":
        word = ~K.SPACE[raw]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[offsets[1:-1][offsets[1:-1] > 0] - 1] = word[offsets[1:-1][offsets[1:-1] > 0] - 1]
        head[1:] |= SENTENCE_END[raw[np.flatnonzero(last)[:-1]]]
    elif unit != "line":
        raise ValueError(f"unit is 'sentence' or 'line', not {unit!r}")
    at = np.flatnonzero(head)
    words = np.diff(np.append(at, len(h)))
    place = np.arange(len(h)) - np.repeat(at, words)
    power = np.empty(int(words.max()), U64)
    power[0] = 1
    power[1:] = K.BASE
    np.cumprod(power, out=power)
    digest = K.mix64(np.add.reduceat(h * power[place], at) + words.astype(U64))
    second = (K.mix64(np.add.reduceat(K.mix64(h + U64(1)) * power[place], at) + words.astype(U64)) >> U64(32)).astype(np.uint32)
    d = doc[at]
    out = np.empty(len(at), UNIT)
    out["start"], out["words"] = starts[at] - offsets[d], words
    first_of_doc = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    out["place"] = np.arange(len(at)) - np.repeat(first_of_doc, np.diff(np.append(first_of_doc, len(at))))
    ends = np.append(starts[at[1:]], len(raw))               # up to the next unit, or the end of the text
    out["end"] = np.minimum(ends, offsets[d + 1]) - offsets[d]
    return d, digest, second, out


def all_units(raw: np.ndarray, offsets: np.ndarray, unit: str):
    """``units_of``, of lines and sentences for ``unit="line+sentence"``."""
    if unit != "line+sentence":
        return units_of(raw, offsets, unit)
    sentences, (d, digest, second, lines) = units_of(raw, offsets, "sentence"), units_of(raw, offsets, "line")
    lines["place"] += np.uint32(LINES)
    return tuple(np.concatenate(x) for x in zip(sentences, (d, K.mix64(digest ^ LINE_SALT), second, lines), strict=True))


ENTRY = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("docs", pa.binary()), ("digest", pa.binary()),
                   ("second", pa.binary()), ("units", pa.binary())])
ENTRY_DDL = "bucket int, settled boolean, docs binary, digest binary, second binary, units binary"
LATER = 0


def _first_of_equal(docs, digest, second, units):
    """(order, mask): entries by digest and rank, and which are the first of their digest."""
    order = np.lexsort((units["place"], docs["variant"], docs["id"], second, digest))
    g, s = digest[order], second[order]
    head = np.ones(len(order), bool)
    head[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    # a repeated row is the same document: what is first in it is first in its copies
    d, p = docs[order], units["place"][order]
    top = np.flatnonzero(head)
    number = np.cumsum(head) - 1
    return order, (d == d[top][number]) & (p == p[top][number]) if len(order) else head


def _entries(unit: str, n_buckets: int):
    def flush(parts) -> pa.RecordBatch:
        docs, digest, second, units = (np.concatenate([p[c] for p in parts]) for c in range(4))
        rows = {c: [] for c in ENTRY.names}
        order, first = _first_of_equal(docs, digest, second, units)
        settled, order = order[~first], order[first]
        if len(settled):
            for c, x in zip(ENTRY.names, (int(digest[settled[0]] % U64(n_buckets)), True, docs[settled].tobytes(), None, None,
                                          units[settled].tobytes()), strict=True):
                rows[c].append(x)
        bucket = ((digest[order] >> U64(32)) * U64(n_buckets) >> U64(32)).astype(np.int64)
        for key, s, e in cuts(bucket):                       # sorted by digest, so by bucket
            o = order[s:e]
            for c, x in zip(ENTRY.names, (key, False, docs[o].tobytes(), digest[o].tobytes(), second[o].tobytes(),
                                          units[o].tobytes()), strict=True):
                rows[c].append(x)
        return pa.RecordBatch.from_pydict(rows, schema=ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            docs, valid, raw, offsets, _ = batch_docs(b)
            for i, j in K.slabs(offsets):
                off = offsets[i:j + 1] - offsets[i]
                d, *rest = all_units(raw[offsets[i]:offsets[j]], off, unit)
                ok = valid[i:j][d]
                parts.append((docs[i:j][d][ok], *(x[ok] for x in rest)))
                held += int(off[-1])
                if held >= FLUSH_BYTES:
                    yield flush(parts)
                    parts, held = [], 0
                    K.trim()
        if parts:
            yield flush(parts)
        parts = b = None                 # an idle worker keeps nothing
        K.trim()
    return run


def _later(n_groups: int):
    """One bucket of digests: all but the earliest occurrence of each go back to their documents."""
    def run(table):
        rows = {c: [] for c in FOUND.names}

        def send(docs, units):
            group = groups_of(docs, n_groups)
            order = np.argsort(group, kind="stable")
            for key, s, e in cuts(group[order]):
                o = order[s:e]
                for c, x in zip(FOUND.names, (key, LATER, docs[o].tobytes(), units[o].tobytes(), None, None, None, None), strict=True):
                    rows[c].append(x)
        settled = table.column("settled")
        known, fresh = table.filter(settled), table.filter(pc.invert(settled))
        if known.num_rows:
            send(K.joined(known.column("docs"), DOC), K.joined(known.column("units"), UNIT))
        docs, digest, second, units = (K.joined(fresh.column(c), t) for c, t in (
            ("docs", DOC), ("digest", U64), ("second", np.uint32), ("units", UNIT)))
        order, first = _first_of_equal(docs, digest, second, units)
        late = order[~first]
        if len(late):
            send(docs[late], units[late])
        K.trim()
        return pa.Table.from_pydict(rows, schema=FOUND)
    return run


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_units", pa.int64()), ("kept", pa.binary()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
KEPT_DDL = "doc_id long, n_bytes long, n_units long, kept binary, spans array<struct<start:long,end:long>>"


def _going(u: np.ndarray, lines: np.ndarray, min_words: int) -> np.ndarray:
    """Of a document's later units those that go: in runs of enough words, or in a later line (all whose sentences are later)."""
    if not len(u):
        return u
    head = np.flatnonzero(np.concatenate([[True], np.diff(u["place"].astype(np.int64)) != 1]))
    words = np.add.reduceat(u["words"].astype(np.int64), head)
    goes = np.repeat(words >= min_words, np.diff(np.append(head, len(u))))
    if len(lines):
        own = np.searchsorted(lines["start"], u["start"], side="right") - 1
        goes |= (own >= 0) & (u["end"] <= lines["end"][np.maximum(own, 0)])
    return u[goes]


def _cut(min_words: int):
    """One group of documents: cut the runs of later units that are long enough."""
    def run(table):
        found = table.filter(pc.equal(table.column("kind"), LATER))
        docs, units = K.joined(found.column("docs"), DOC), K.joined(found.column("first"), UNIT)
        order = np.lexsort((units["place"], docs["variant"], docs["id"]))
        docs, units = docs[order], units[order]
        once = np.ones(len(docs), bool)                       # a repeated row reports its units again
        once[1:] = (docs[1:] != docs[:-1]) | (units["place"][1:] != units["place"][:-1])
        docs, units = docs[once], units[once]
        at = {key: (s, e) for key, s, e in cuts(docs)}
        rows = {c: [] for c in KEPT.names}
        for d, valid, body in read_group(table.filter(pc.equal(table.column("kind"), TEXT))):
            spans, removed = [], 0
            if valid and d in at:
                s, e = at[d]
                u = units[s:e]
                whole = u["place"] >= LINES
                u = _going(u[~whole], u[whole], min_words)
                place = u["place"].astype(np.int64)
                head = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1])) if len(u) else []
                for a, b in zip(head, [*head[1:], len(u)], strict=True) if len(u) else ():
                    spans.append((int(u["start"][a]), int(u["end"][b - 1])))
                removed = len(u)
            kept, last = [], 0
            for a, b in spans:
                kept.append(body[last:a])
                last = b
            kept.append(body[last:])
            for c, x in zip(KEPT.names, (d[0] if valid else None, len(body), removed, b"".join(kept),
                                         [{"start": a, "end": b} for a, b in spans]), strict=True):
                rows[c].append(x)
        K.trim()
        return pa.Table.from_pydict(rows, schema=KEPT)
    return run


def remove_repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                          min_words: int = 10) -> DataFrame:
    """Each row without its later units: (doc_id, n_bytes, n_units removed, kept, spans); see the module text."""
    docs = rename_clear(docs, {"doc_id": id_col, "text": text_col}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(1, math.ceil(total / BUCKET_BYTES))
    later = docs.mapInArrow(_entries(unit, n), ENTRY_DDL).groupBy("bucket").applyInArrow(_later(n), FOUND_DDL)
    return docs.mapInArrow(pack_texts(n), FOUND_DDL).unionByName(later).groupBy("grp").applyInArrow(_cut(min_words), KEPT_DDL)
