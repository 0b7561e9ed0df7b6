"""Exact removal of repeated byte windows by a depth-limited radix sort of suffixes.

A byte is removed when a window of ``depth`` bytes that covers it also starts in a document with a
smaller id. Suffixes are ordered only as far as ``depth`` bytes, most significant digit first; a
group of suffixes that is settled leaves the sort, and what is still equal after the last digit
is exactly a set of repeated windows.

*Order of the digits.* The digits of a window are a fixed rearrangement of its bytes that puts
its most selective part first: the gram (2/5 of the depth) with the smallest hash in the window,
then the gram's place, then the bytes in words of eight. Neighbouring windows share their
first digit, so a whole run of suffixes travels as one entry: (gram, hash of all bytes of the
run, document, place).

1. *First pass*: entries go, packed, to buckets by the hash of their gram. A gram of one document
   only settles its run: nothing is repeated. Runs that are equal as a whole to a run of a smaller
   document are settled too: all windows are repeated. What is left are the first documents of
   runs that differ around an equal gram (ends of copies, edits).
2. *Later passes*: these few runs fetch their bytes and send single windows to the bucket of
   their gram; each pass sorts by (group, next eight bytes) and drops groups that have become
   single. Groups that are left after ``depth`` bytes hold one window in several documents; all
   but those of the smallest document are repeated.
3. Each document cuts the union of its repeated windows.

A gram in very many different contexts (the end of a line that a third of all documents share) is *hot*: its
runs don't meet in one bucket. Packs that find it hot send a notice, and all its runs, wherever they
are, are taken apart into single windows, which go to buckets by a hash of the whole window. Equal runs
and equal windows of one pack or group of documents are settled there, so what travels of a common
run or window is one entry for each pack.

Hashes only choose buckets and settle whole runs (80 or more bits); windows are compared by
their bytes. Texts are taken whole; every gram group of a bucket is arrays in bounded memory,
as the number of buckets follows the bytes of the corpus.

Rows: a null text is empty; a text shorter than ``depth`` bytes keeps all; a null id matches
nothing; rows that repeat an id (with the same or another text) don't match each other, since
neither id is smaller. Extra columns are ignored. An empty table gives an empty result.
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
from ledgerline.llm.docgroups import (BUCKET_BYTES, DOC, FLUSH_BYTES, FOUND, FOUND_DDL, TEXT, batch_docs, carried_columns, cuts,
                                      groups_of, pack_texts, read_group)
from ledgerline.llm.scratch import Scratch, rename_clear

U64 = np.uint64
BUCKET_BYTES = 8 << 20          # text bytes behind one bucket or document group
FLUSH_BYTES = 6 << 20           # text bytes a map task packs before it sends them
SLAB_BYTES = 1 << 18             # text bytes hashed at once
WINDOWS_AT_ONCE = 200_000        # windows that one later pass sorts together
RUNS_AT_ONCE = 10_000            # hot runs that are taken apart together
HOT_RUNS = 256                   # different runs of a gram in one pack that make it hot
HOT_IN_BUCKET = 20_000           # the same in a bucket
PLACE_BITS = U64(28)


def _block_hash(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each place on; short at the end."""
    h, m, p = K.BYTE[raw], 1, int(K.BASE)
    while m < size:
        h = h[:-m] * U64(p) + h[m:]
        m, p = 2 * m, p * p % (1 << 64)
    return h


def _gram_hash(raw: np.ndarray, k: int) -> np.ndarray:
    size = 1 << (k.bit_length() - 1)
    h = _block_hash(raw, size)
    return K.mix64(h[:len(raw) - k + 1] * U64(3) + h[k - size:k - size + len(raw) - k + 1] * K.BASE)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    m, size = v, 1
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(v) - w + 1], m[w - size:w - size + len(v) - w + 1])


def runs_of(raw: np.ndarray, offsets: np.ndarray, depth: int):
    """Runs of windows that share a gram: (doc, gram hash, run hash, first window, place of the gram, windows)."""
    k = max(8, depth * 2 // 5)
    w = depth - k + 1
    none = [np.zeros(0, t) for t in (np.int64, U64, U64, np.int64, np.int64, np.int64)]
    if len(raw) < depth:
        return none
    g = _gram_hash(raw, k)
    place = np.arange(len(g), dtype=np.uint64)
    low = _sliding_min((g >> PLACE_BITS << PLACE_BITS) | place, w)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(low)]
    inside = np.arange(len(low)) + depth <= offsets[doc + 1]
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    if not len(first):
        return none
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | head[1:]
    count = np.flatnonzero(ends) - first + 1
    at = (low[first] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    size = 1 << (k.bit_length() - 1)
    block = _block_hash(raw, size)
    span = count + depth - 1
    whole = K.mix64(((at - first) * 1000 + count).astype(U64))
    for j in range(-(-(w + depth - 1) // size)):
        whole = K.mix64(whole * U64(5) + block[first + np.minimum(j * size, span - size)])
    d = doc[first]
    return d, g[at], whole, first - offsets[d], at - first, count


ENTRY = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("docs", pa.binary()), ("counts", pa.binary()), ("gram", pa.binary()),
                   ("run_low", pa.binary()), ("run_high", pa.binary()), ("first", pa.binary()), ("shape", pa.binary())])
ENTRY_DDL = ("bucket int, kind byte, docs binary, counts binary, gram binary, run_low binary, run_high binary, "
             "first binary, shape binary")
ENTRIES, NOTICE = 8, 9           # runs to compare; grams that are hot in a pack. Other kinds pass through their bucket
SETTLED, OPEN, HOT = 0, 1, 3        # kinds of found runs, beside TEXT
SHAPE = np.dtype([("place", "u1"), ("count", "u1")])


def _equal_runs(gram: np.ndarray, whole: np.ndarray, ids: np.ndarray):
    """(order by gram, run and id; which gram each is of; whether it is later than an equal run)."""
    order = np.lexsort((ids, whole, gram))
    g, w, i = gram[order], whole[order], ids[order]
    new_gram = np.ones(len(g), bool)
    new_gram[1:] = g[1:] != g[:-1]
    new_run = new_gram.copy()
    new_run[1:] |= w[1:] != w[:-1]
    earliest = i[np.flatnonzero(new_run)][np.cumsum(new_run) - 1] if len(i) else i
    return order, np.cumsum(new_gram) - 1, i > earliest


def _bucket(gram: np.ndarray, n_buckets: int) -> np.ndarray:
    return (((gram >> U64(32)) * U64(n_buckets)) >> U64(32)).astype(np.int64)


def _entries(depth: int, n_buckets: int):
    def send(rows: dict, bucket: int, kind: int, **arrays) -> None:
        for c in ENTRY.names:
            rows[c].append({"bucket": bucket, "kind": kind}.get(c, arrays.get(c)))

    def flush(parts) -> pa.RecordBatch:
        docs, gram, whole, first, place, count = (np.concatenate([p[c] for p in parts]) for c in range(6))
        shape = np.empty(len(docs), SHAPE)
        shape["place"], shape["count"] = place, count
        # mixed anew, as the smallest hashes of windows are far from uniform; the other half of the
        # bits tells grams of a bucket apart
        gram = K.mix64(gram)
        rows = {c: [] for c in ENTRY.names}
        order, number, later = _equal_runs(gram, whole, docs["id"])
        # equal runs of one pack: all but the first are settled here; grams with many other runs are hot
        hot = (np.bincount(number[~later], minlength=len(number)) >= HOT_RUNS)[number] & ~later
        for kind, o in ((SETTLED, order[later]), (HOT, order[hot])):
            if len(o):
                send(rows, int(gram[o[0]] % U64(n_buckets)), kind, docs=docs[o].tobytes(), first=first[o].astype(np.uint32).tobytes(),
                     shape=shape[o].tobytes())
        noticed = np.unique(gram[order[hot]])
        for key, s, e in cuts(_bucket(noticed, n_buckets)):
            send(rows, key, NOTICE, gram=noticed[s:e].astype(np.uint32).tobytes())
        rest = np.sort(order[~later & ~hot])
        bucket = _bucket(gram[rest], n_buckets)
        by = np.argsort(bucket, kind="stable")
        for key, s, e in cuts(bucket[by]):
            o = rest[by[s:e]]
            d = docs[o]
            head = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            send(rows, key, ENTRIES, docs=d[head].tobytes(), counts=np.diff(np.append(head, len(o))).astype(np.uint32).tobytes(),
                 gram=gram[o].astype(np.uint32).tobytes(), run_low=whole[o].astype(np.uint32).tobytes(),
                 run_high=(whole[o] >> U64(48)).astype(np.uint16).tobytes(), first=first[o].astype(np.uint32).tobytes(),
                 shape=shape[o].tobytes())
        return pa.RecordBatch.from_pydict(rows, schema=ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            docs, valid, raw, offsets, _ = batch_docs(b)
            for i, j in K.slabs(offsets, SLAB_BYTES):
                off = offsets[i:j + 1] - offsets[i]
                d, *rest = runs_of(raw[offsets[i]:offsets[j]], off, depth)
                keep = valid[i:j][d]
                gram, whole, first, place, count = (x[keep] for x in rest)
                parts.append([docs[i:j][d][keep], gram, whole, first.astype(np.uint32), place.astype(np.uint8),
                              count.astype(np.uint8)])
                held += int(off[-1])
                if held >= FLUSH_BYTES * 2 // 3:
                    yield flush(parts)
                    parts, held = [], 0
                    K.trim()
        if parts:
            yield flush(parts)
        parts = b = None                 # an idle worker keeps nothing
        K.trim()
    return run


def _found_rows(rows: dict, kind: int, docs, first, shape, gram, n_groups: int, body=None) -> None:
    group = groups_of(docs, n_groups)
    order = np.argsort(group, kind="stable")
    for key, s, e in cuts(group[order]):
        o = order[s:e]
        rows["grp"].append(key)
        rows["kind"].append(kind)
        rows["docs"].append(docs[o].tobytes())
        rows["first"].append(first[o].astype(np.uint32).tobytes())
        rows["shape"].append(shape[o].tobytes())
        rows["gram"].append(gram[o].tobytes() if gram is not None else None)
        rows["body"].append(None)
        rows["carried"].append(None)


def _first_pass(n_groups: int):
    """One bucket: settle the runs of grams of one document and the runs equal to an earlier one."""
    def run(key, table):
        bucket = key[0].as_py()
        rows = {c: [] for c in FOUND.names}

        def of(kind):
            part = table.filter(pc.equal(table.column("kind"), kind))
            return lambda name, t: K.joined(part.column(name), t)
        for kind in (SETTLED, HOT):                           # passing through
            join = of(kind)
            _found_rows(rows, kind, join("docs", DOC), join("first", np.uint32), join("shape", SHAPE), None, n_groups)
        noticed = np.unique(of(NOTICE)("gram", np.uint32))
        join = of(ENTRIES)
        docs = np.repeat(join("docs", DOC), join("counts", np.uint32))
        gram, first, shape = join("gram", np.uint32), join("first", np.uint32), join("shape", SHAPE)
        whole = join("run_low", np.uint32).astype(U64) | (join("run_high", np.uint16).astype(U64) << U64(32))
        known = np.isin(gram, noticed)
        _found_rows(rows, HOT, docs[known], first[known], shape[known], None, n_groups)
        order = np.flatnonzero(~known)
        order = order[np.argsort(gram[order], kind="stable")]
        g = gram[order]
        single = np.ones(len(g), bool)
        single[1:] &= g[1:] != g[:-1]
        single[:-1] &= g[1:] != g[:-1]
        order = order[~single]
        if len(order):
            by, gram_no, settled = _equal_runs(gram[order], whole[order], docs["id"][order])
            order = order[by]
            docs, gram, first, shape = docs[order], gram[order], first[order], shape[order]
            ids, gram_at = docs["id"], np.flatnonzero(np.concatenate([[True], gram_no[1:] != gram_no[:-1]]))
            # open: first documents of the runs of a gram that has runs first seen in different documents
            low = np.minimum.reduceat(ids, gram_at)[gram_no]
            high = np.maximum.reduceat(np.where(settled, np.iinfo(np.int64).min, ids), gram_at)[gram_no]
            is_open = ~settled & (high > low)
            hot = (np.bincount(gram_no, weights=is_open) >= HOT_IN_BUCKET)[gram_no] & is_open
            is_open &= ~hot
            _found_rows(rows, SETTLED, docs[settled], first[settled], shape[settled], None, n_groups)
            _found_rows(rows, HOT, docs[hot], first[hot], shape[hot], None, n_groups)
            wide = (np.uint64(bucket) << U64(32)) | gram[is_open].astype(U64)
            _found_rows(rows, OPEN, docs[is_open], first[is_open], shape[is_open], wide, n_groups)
        K.trim()
        return pa.Table.from_pydict(rows, schema=FOUND)
    return run


def _read_found(table, kind: int):
    """Runs of one kind, sorted by document: (docs, first, shape, gram)."""
    mine = table.filter(pc.equal(table.column("kind"), kind))

    def join(name, t):
        return K.joined(mine.column(name), t)
    docs, first, shape, gram = join("docs", DOC), join("first", np.uint32), join("shape", SHAPE), join("gram", U64)
    order = np.lexsort((docs["variant"], docs["id"]))
    return docs[order], first[order].astype(np.int64), shape[order], gram[order] if len(gram) else gram


WINDOW = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("docs", pa.binary()), ("gram", pa.binary()), ("first", pa.binary()),
                    ("shape", pa.binary()), ("body", pa.binary())])
WINDOW_DDL = "bucket int, kind byte, docs binary, gram binary, first binary, shape binary, body binary"


def _word(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as one number."""
    word = np.zeros(len(at), U64)
    for k in range(8):
        word = (word << U64(8)) | raw[at + k].astype(U64)
    return word


def _single_windows(docs, first, shape, body: bytes, depth: int):
    """Windows of hot runs, each an entry of its own: (entries to send, entries equal to one of an earlier document), bytes.

    Entries are [docs, gram, first, shape, starts in the bytes]; the gram is a hash of the whole window.
    """
    raw = np.frombuffer(body, np.uint8)
    count = shape["count"].astype(np.int64)
    span = count + depth - 1
    run = np.repeat(np.arange(len(docs)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(span) - span)[run] + step
    one = np.empty(len(run), SHAPE)
    one["place"], one["count"] = shape["place"][run] - step, 1
    gram = _gram_hash(raw, depth)[start]
    d, f = docs[run], (first[run] + step).astype(np.uint32)
    order = np.lexsort((d["id"], gram))
    d, f, one, gram, start = d[order], f[order], one[order], gram[order], start[order]
    head = np.ones(len(d), bool)
    head[1:] = gram[1:] != gram[:-1]
    top = np.flatnonzero(head)[np.cumsum(head) - 1]
    same = np.ones(len(d), bool)                              # equal hash and equal bytes
    for at in range(0, depth, 8):
        at = min(at, depth - 8)
        same &= _word(raw, start + at) == _word(raw, start[top] + at)
    later = same & (d["id"] > d["id"][top])
    return [[x[m] for x in (d, gram, f, one, start)] for m in (~later, later)], raw


def _fetch(depth: int, n_buckets: int):
    """One group of documents: the bytes of its open runs, sent to the buckets of their grams."""
    def run(table):
        texts: dict = {}
        for d, valid, body in read_group(table):
            if valid:
                texts.setdefault(d, body)
        rows = {c: [] for c in WINDOW.names}

        def send(bucket, kind, docs, gram, first, shape, body):
            for c, x in zip(WINDOW.names, (bucket, kind, docs.tobytes(), gram.tobytes(), first.astype(np.uint32).tobytes(),
                                           shape.tobytes(), body), strict=True):
                rows[c].append(x)

        def bytes_of(docs, first, shape):
            return b"".join([texts[d][p:p + c + depth - 1]
                             for d, p, c in zip(docs.tolist(), first.tolist(), shape["count"].tolist(), strict=True)])
        docs, first, shape, gram = _read_found(table, OPEN)
        bucket = (K.mix64(gram.copy()) % U64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for key, s, e in cuts(bucket[order]):
            o = order[s:e]
            send(key, OPEN, docs[o], gram[o], first[o], shape[o], bytes_of(docs[o], first[o], shape[o]))
        docs, first, shape, _ = _read_found(table, HOT)
        for s in range(0, len(docs), RUNS_AT_ONCE):
            part = slice(s, s + RUNS_AT_ONCE)
            (fresh, later), raw = _single_windows(docs[part], first[part], shape[part],
                                                  bytes_of(docs[part], first[part], shape[part]), depth)
            if len(later[0]):
                send(int(later[1][0] % U64(n_buckets)), SETTLED, *later[:4], None)
            bucket = (K.mix64(fresh[1].copy()) % U64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for key, b, e in cuts(bucket[order]):
                o = order[b:e]
                send(key, OPEN, *(x[o] for x in fresh[:4]), raw[(fresh[4][o][:, None] + np.arange(depth)).reshape(-1)].tobytes())
        K.trim()
        return pa.Table.from_pydict(rows, schema=WINDOW)
    return run


def radix_groups(group: np.ndarray, digits, ids: np.ndarray):
    """Most-significant-digit passes: indexes and group numbers of what stays equal in all digits.

    ``digits(j, index)`` gives the j-th digit of the entries, or None after the last. A group with
    one id only is settled and leaves.
    """
    index, j = np.arange(len(group)), 0
    while True:
        order = np.lexsort((ids[index], group))
        index, group = index[order], group[order]
        head = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
        number = np.cumsum(head) - 1
        if len(index):
            at = np.flatnonzero(head)
            several = (ids[index[np.append(at[1:], len(index)) - 1]] != ids[index[at]])[number]
            index, number = index[several], number[several]
        digit = digits(j, index)
        if digit is None or not len(index):
            return index, number
        # the next digit splits each group
        order = np.lexsort((digit, number))
        index, number, digit = index[order], number[order], digit[order]
        head = np.concatenate([[True], (number[1:] != number[:-1]) | (digit[1:] != digit[:-1])])
        group, j = np.cumsum(head) - 1, j + 1


def _slices(gram: np.ndarray, count: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Runs of whole grams with about ``limit`` windows at most, or of one gram that has more (True)."""
    order = np.argsort(gram, kind="stable")
    heads = [(s, e) for _, s, e in cuts(gram[order])]
    windows = np.concatenate([[0], np.cumsum(count[order])])
    start = 0
    for k, (s, e) in enumerate(heads):
        if k + 1 == len(heads) or windows[heads[k + 1][1]] - windows[start] > limit:
            yield order[start:e], start == s and windows[e] - windows[s] > limit
            start = e


def _repeated(docs, gram, shape, span, base, raw, runs, place, depth: int):
    """Windows of some runs (at one place of the gram only, if given) that an earlier document has: (run, step)."""
    count, first_place = shape["count"].astype(np.int64), shape["place"].astype(np.int64)
    if place is None:
        entry = np.repeat(runs, count[runs])
        step = np.arange(len(entry)) - np.repeat(np.cumsum(count[runs]) - count[runs], count[runs])
    else:
        step = first_place[runs] - place
        entry, step = runs[(step >= 0) & (step < count[runs])], step[(step >= 0) & (step < count[runs])]
    start = base[entry] + step
    ids = docs["id"][entry]

    def digits(j, index):
        if j * 8 >= depth:
            return None
        return _word(raw, start[index] + min(8 * j, depth - 8))
    index, number = radix_groups(np.unique(gram[entry], return_inverse=True)[1].reshape(-1) * 256 + first_place[entry] - step,
                                 digits, ids)
    if not len(index):
        return entry[:0], step[:0]
    head = np.concatenate([[True], number[1:] != number[:-1]])
    low = np.minimum.reduceat(ids[index], np.flatnonzero(head))[np.cumsum(head) - 1]
    again = np.sort(index[ids[index] > low])
    return entry[again], step[again]


def _later_passes(depth: int, n_groups: int):
    """One bucket of open runs: sort their windows digit by digit; repeated windows are settled runs.

    Grams don't meet, and neither do different places of a gram in the window: the bucket is worked off
    in slices of them, so that the memory follows the runs, not their windows.
    """
    def run(table):
        rows = {c: [] for c in FOUND.names}
        known = table.filter(pc.equal(table.column("kind"), SETTLED))
        _found_rows(rows, SETTLED, K.joined(known.column("docs"), DOC), K.joined(known.column("first"), np.uint32),
                    K.joined(known.column("shape"), SHAPE), None, n_groups)
        table = table.filter(pc.equal(table.column("kind"), OPEN))

        def join(name, t):
            return K.joined(table.column(name), t)
        docs, gram, first, shape, raw = (join("docs", DOC), join("gram", U64), join("first", np.uint32),
                                         join("shape", SHAPE), join("body", np.uint8))
        span = shape["count"].astype(np.int64) + depth - 1
        base = np.cumsum(span) - span
        for runs, alone in _slices(gram, shape["count"].astype(np.int64), WINDOWS_AT_ONCE):
            for place in np.unique(np.concatenate([np.arange(p - c + 1, p + 1) for p, c in set(shape[runs].tolist())])) if alone else [None]:
                entry, step = _repeated(docs, gram, shape, span, base, raw, runs, place, depth)
                # neighbouring windows of one run become one settled run
                head = np.ones(len(entry), bool)
                head[1:] = (entry[1:] != entry[:-1]) | (step[1:] != step[:-1] + 1)
                at = np.flatnonzero(head)
                if len(at):
                    out = np.empty(len(at), SHAPE)
                    out["place"], out["count"] = 0, np.diff(np.append(at, len(entry)))
                    _found_rows(rows, SETTLED, docs[entry[at]], first[entry[at]] + step[at], out, None, n_groups)
        K.trim()
        return pa.Table.from_pydict(rows, schema=FOUND)
    return run


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
KEPT_DDL = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"


def _cut(depth: int, carry: list[str]):
    """One group of documents: remove the union of the settled runs from each text."""
    def run(table):
        docs, first, shape, _ = _read_found(table, SETTLED)
        at = {}
        for key, s, e in cuts(docs):
            at[key] = (s, e)
        rows = {c: [] for c in KEPT.names}
        read = read_group(table)
        for d, valid, body in read:
            spans = []
            if valid and d in at:
                s, e = at[d]
                start = first[s:e]
                end = start + shape["count"][s:e].astype(np.int64) + depth - 1
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                head = np.concatenate([[True], start[1:] > end[:-1]])
                tail = np.append(np.flatnonzero(head)[1:], len(start)) - 1
                spans = list(zip(start[head].tolist(), end[tail].tolist(), strict=True))
            kept, last = [], 0
            for a, b in spans:
                kept.append(body[last:a])
                last = b
            kept.append(body[last:])
            for c, x in zip(KEPT.names, (d[0] if valid else None, len(body), b"".join(kept),
                                         [{"start": a, "end": b} for a, b in spans]), strict=True):
                rows[c].append(x)
        K.trim()
        out = pa.Table.from_pydict(rows, schema=KEPT)
        if carry and read:
            out = out.append_column("kept_text", pa.array([x.decode("utf-8", "ignore") for x in rows["kept"]], pa.string()))
            extra = carried_columns(table)
            for c in carry:
                out = out.append_column(f"carried_{c}", extra.column(f"carried_{c}"))
        elif carry:
            raise ValueError("a group of documents without texts")
        return out
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 50,
                   carry: list[str] | None = None) -> DataFrame:
    """Each row without its repeated windows: (doc_id, n_bytes, kept, spans); see the module text for all cases.

    ``kept`` are the bytes left, and may cut a character. Columns named in ``carry`` come along under
    their names, together with ``kept_text``: the bytes left as text, without the bytes of cut characters.
    """
    if not 16 <= depth <= 128:
        raise ValueError("depth must be 16 to 128 bytes")
    carry = list(carry or [])
    wanted = rename_clear(docs, {"doc_id": id_col, "text": text_col, **{f"carried_{c}": c for c in carry}})
    docs = wanted.withColumn("doc_id", F.col("doc_id").cast("long"))
    bare = docs.select("doc_id", "text")
    scratch = Scratch(docs.sparkSession, "suffix")
    total = int(bare.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(1, math.ceil(total / BUCKET_BYTES))
    texts = bare.mapInArrow(pack_texts(n), FOUND_DDL)
    first = scratch.store(bare.mapInArrow(_entries(depth, n), ENTRY_DDL).groupBy("bucket")
                          .applyInArrow(_first_pass(n), FOUND_DDL), "first-pass")
    windows = texts.unionByName(first.filter(F.col("kind") != SETTLED)).groupBy("grp").applyInArrow(_fetch(depth, 4 * n), WINDOW_DDL)
    later = scratch.store(windows.groupBy("bucket").applyInArrow(_later_passes(depth, n), FOUND_DDL), "later-passes")
    settled = first.filter(F.col("kind") == SETTLED).unionByName(later)
    named = [f"carried_{c}" for c in carry]
    whole = docs.mapInArrow(pack_texts(n, named), FOUND_DDL) if carry else texts
    ddl = KEPT_DDL + ", kept_text string" * bool(carry) + "".join(f", `carried_{c}` {docs.schema[f'carried_{c}'].dataType.simpleString()}" for c in carry)
    out = whole.unionByName(settled).groupBy("grp").applyInArrow(_cut(depth, carry), ddl)
    if not carry:
        return out
    return out.select("doc_id", "n_bytes", "kept", "spans", "kept_text", *[F.col(f"`carried_{c}`").alias(c) for c in carry])
