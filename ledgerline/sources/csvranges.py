"""CSV records of byte ranges: which physical lines begin a record, and the records that a range holds.

A range (a split of a file) can't know whether it begins inside a quoted value. So its lines are first followed from
both states, *closed* (a record begins here) and *open* (a quoted value of an earlier line goes on); what a line does
to either state is a function of two bits, and functions of neighbouring ranges compose. Once the state at
the beginning of each range is known, the range gives the records that begin in it.

A field that begins with a quote runs to the quote that is not doubled. What follows that quote up to the next comma,
be it white space or other text, belongs to the field too, quotes included; quotes inside other fields are plain
characters. Only a line that ends inside a quoted field leaves the state open. (Comma, and the double
quote as quote and escape, are the format that ``csv.py`` reads.)

The functions run in Python workers, which need not have this library: the module is sent by value.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+|(?:[^",][^,]*+)?+)'
CLOSES = re.compile(rf"(?:{FIELD},)*+{FIELD}")                                             # from the beginning of a record
CLOSES_OPEN = re.compile(rf'[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+(?:,{FIELD})*+')         # from inside a quoted value

SUMMARIES_DDL = ("_key long, _block long, closed_end boolean, open_end boolean, closed_records long, open_records long, "
                 "closed_cr long, open_cr long, head string")
RECORDS_DDL = "_text string, row long, _piece long, _crlf boolean"


def states_before(lines: pa.Array, begin: tuple[bool, ...]) -> list[np.ndarray]:
    """For each state at the beginning: whether a quoted value is open before each line, and after the last one.

    States that have met stay together: from there on a line is read once for all of them.
    """
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    reads = (CLOSES.fullmatch, CLOSES_OPEN.fullmatch)
    chains = [[state] for state in begin]
    texts = lines.take(pa.array(quoted)).to_pylist()
    met = len(set(begin)) == 1
    for k, t in enumerate(texts):
        if met:                                               # the rest of the lines, for one state
            state, rest = chains[0][-1], []
            for t in texts[k:]:
                state = reads[state](t) is None
                rest.append(state)
            for chain in chains:
                chain.extend(rest)
            break
        for chain in chains:
            chain.append(reads[chain[-1]](t) is None)
        met = len({chain[-1] for chain in chains}) == 1
    passed = np.searchsorted(quoted, np.arange(len(lines) + 1))           # quoted lines before each line
    return [np.array(chain, bool)[passed] for chain in chains]


def _segments(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of lines of one range."""
    key, block = b.column("_key").to_numpy(), b.column("_block").to_numpy()
    cut = np.flatnonzero((block[1:] != block[:-1]) | (key[1:] != key[:-1])) + 1
    yield from zip([0, *cut.tolist()], [*cut.tolist(), len(block)], strict=True) if len(block) else ()


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range of (line, _key, _block), a file's key and the range's place in it: what it does to both states, and its records under each.

    ``*_cr`` counts, among the records, lines of a single carriage return: blank ones where lines end in CR LF.
    ``head`` is the first record of a file's first range, the header, with its line break's carriage return.
    """
    now = None
    schema = pa.schema([("_key", pa.int64()), ("_block", pa.int64()), ("closed_end", pa.bool_()), ("open_end", pa.bool_()),
                        *[(c, pa.int64()) for c in ("closed_records", "open_records", "closed_cr", "open_cr")], ("head", pa.string())])

    def ended():
        return pa.RecordBatch.from_pylist([{c: now[c] for c in schema.names}], schema=schema)

    for b in batches:
        lines = b.column("line")
        for s, e in _segments(b):
            file, block = b.column("_key")[s].as_py(), b.column("_block")[s].as_py()
            if now is None or (now["_key"], now["_block"]) != (file, block):
                if now is not None:
                    yield ended()
                now = {"_key": file, "_block": block, "closed_end": False, "open_end": True, "closed_records": 0,
                       "open_records": 0, "closed_cr": 0, "open_cr": 0, "head": None, "lines": []}
            part = lines.slice(s, e - s)
            blank = pc.equal(part, "").to_numpy(zero_copy_only=False)
            cr = pc.equal(part, "\r").to_numpy(zero_copy_only=False)
            both = states_before(part, (now["closed_end"], now["open_end"]))
            for name, before in zip(("closed", "open"), both, strict=True):
                begins = ~before[:-1] & ~blank
                now[f"{name}_records"] += int(begins.sum())
                now[f"{name}_cr"] += int((begins & cr).sum())
                now[f"{name}_end"] = bool(before[-1])
            if block == 0 and now["head"] is None:
                for k, (line, after) in enumerate(zip(part.to_pylist(), both[0][1:].tolist(), strict=True)):
                    if now["lines"] or not (blank[k] or cr[k]):
                        now["lines"].append(line)
                        if not after:
                            now["head"] = "\n".join(now["lines"])
                            break
    if now is not None:
        yield ended()


class RangesChanged(RuntimeError):
    """The files are cut into other ranges than when they were first read."""


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (_text, row, _piece, _crlf) of the lines of ranges that come with the state at their beginning (``open``), the number
    of their first record (``first_row``), whether it is a header, and whether lines end in CR LF.

    A whole record has no ``_piece``. The pieces of a record that begins in one range and ends in another have its
    row number and the places of their ranges.
    """
    schema = pa.schema([("_text", pa.string()), ("row", pa.int64()), ("_piece", pa.int64()), ("_crlf", pa.bool_())])
    key = held = None                  # the range, and the lines of the record that is open in it, if one is
    state, row, whole = False, 0, True

    def out(texts, rows, place, ended=True):
        texts, crlf = pa.array(texts, pa.string()), first["crlf"]
        if crlf and ended:
            texts = pc.if_else(pc.ends_with(texts, "\r"), pc.utf8_slice_codeunits(texts, 0, -1), texts)
        return pa.RecordBatch.from_arrays([texts, pa.array(rows, pa.int64()), pa.array([place] * len(rows), pa.int64()),
                                           pa.array([crlf] * len(rows), pa.bool_())], schema=schema)

    for b in batches:
        lines = b.column("line")
        for s, e in _segments(b):
            own = (b.column("_key")[s].as_py(), b.column("_block")[s].as_py())
            if own != key:
                if held is not None:                         # it goes on in the next range
                    yield out(["\n".join(held)], [row], key[1], ended=False)
                first = {c: b.column(c)[s].as_py() for c in ("open", "first_row", "header", "crlf")}
                if first["open"] is None:
                    raise RangesChanged(f"there was no range at {own[1]} when the files were first read")
                key, state, row = own, first["open"], first["first_row"] - 1 - first["header"]
                held, whole = ([], False) if state else (None, True)
            part = lines.slice(s, e - s)
            before, = states_before(part, (state,))
            state = bool(before[-1])
            blank = pc.equal(part, "").to_numpy(zero_copy_only=False)
            if first["crlf"]:
                blank = blank | pc.equal(part, "\r").to_numpy(zero_copy_only=False)
            closed = np.flatnonzero(~before[:-1])            # lines before which nothing is open
            if held is not None:                             # the open record goes on up to the first of them
                stop = int(closed[0]) if len(closed) else len(part)
                held += part.slice(0, stop).to_pylist()
                if not len(closed) and state:
                    continue
                if row >= first["first_row"] or not whole:
                    yield out(["\n".join(held)], [row], None if whole else key[1])
                held, whole = None, True
            ends = np.append(closed[1:], len(part))[:len(closed)]
            real = ~blank[closed]
            closed, ends = closed[real], ends[real]
            if state and len(closed):                        # the last record isn't at its end
                held, closed, ends = part.slice(int(closed[-1])).to_pylist(), closed[:-1], ends[:-1]
            numbers = row + 1 + np.arange(len(closed))
            row += len(closed) + (held is not None)
            if len(numbers) and numbers[0] < first["first_row"]:
                closed, ends, numbers = closed[1:], ends[1:], numbers[1:]                  # the header
            one = ends - closed == 1                         # the others are few, or the text is theirs
            if one.any():
                yield out(part.take(pa.array(closed[one], pa.int64())), numbers[one], None)
            if not one.all():
                closed, ends, numbers = closed[~one], ends[~one], numbers[~one]
                size = ends - closed
                each = part.take(pa.array(np.repeat(closed - np.cumsum(size) + size, size) + np.arange(size.sum()))).to_pylist()
                cut = np.cumsum(size).tolist()
                yield out(["\n".join(each[i:j]) for i, j in zip([0, *cut[:-1]], cut, strict=True)], numbers, None)
    if held is not None:
        yield out(["\n".join(held)], [row], key[1], ended=False)
