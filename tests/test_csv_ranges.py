"""CSV files read in ranges: the same records and numbers as one reader of the whole file."""

import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import csv as C
from ledgerline.sources import csvranges as X


def whole(text):
    """Records of a text, character by character."""
    out, record, state = [], "", "begin"          # begin: of a field; plain; quoted; quote: after a quote in a quoted field
    for c in text:
        if c == "\n" and state != "quoted":
            out.append(record)
            record, state = "", "begin"
            continue
        record += c
        if state == "begin":
            state = "quoted" if c == '"' else "begin" if c == "," else "plain"
        elif state == "plain":
            state = "begin" if c == "," else "plain"
        elif state == "quoted":
            state = "quote" if c == '"' else "quoted"
        else:
            state = "quoted" if c == '"' else "begin" if c == "," else "plain"
    if state == "quoted":                         # a quote that nothing closes: the file's last line break is no part of it
        record = record.removesuffix("\n")
    return [r for r in [*out, record] if r != ""]


def by_ranges(lines, cuts, batch):
    """The records of lines cut into ranges, from summaries and records alone."""
    bounds = sorted({0, *(c for c in cuts if c < len(lines))}) if lines else []
    block = np.zeros(len(lines), np.int64)
    for c in bounds:
        block[c:] = 10 * c
    frame = pa.RecordBatch.from_pydict({"line": pa.array(lines, pa.string()), "_key": np.full(len(lines), 7), "_block": block})
    batches = [frame.slice(k, batch) for k in range(0, len(lines), batch)]
    ranges = [r for b in X.summaries(iter(batches)) for r in b.to_pylist()]
    state, first, told = False, 0, {}
    for r in ranges:
        told[r["_block"]] = (state, first)
        first += r["open_records"] if state else r["closed_records"]
        state = r["open_end"] if state else r["closed_end"]
    with_state = [b.append_column("open", pa.array([told[x][0] for x in b.column("_block").to_pylist()], pa.bool_()))
                  .append_column("first_row", pa.array([told[x][1] for x in b.column("_block").to_pylist()], pa.int64()))
                  .append_column("header", pa.array([0] * len(b), pa.int32())).append_column("crlf", pa.array([False] * len(b), pa.bool_()))
                  for b in batches]
    found = [r for b in X.records(iter(with_state)) for r in b.to_pylist()]
    rows = {}
    for r in sorted(found, key=lambda r: (r["row"], -1 if r["_piece"] is None else r["_piece"])):
        rows.setdefault(r["row"], []).append(r["_text"])
    assert sorted(rows) == list(range(len(rows)))
    assert all(len(v) == 1 for k, v in rows.items() if any(r["row"] == k and r["_piece"] is None for r in found))
    return ["\n".join(rows[k]) for k in sorted(rows)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='a,"\n', max_size=120), st.sets(st.integers(0, 40), max_size=8), st.integers(1, 9))
@example('a,"b\n\n\n","c"\n"', {1, 2, 3}, 2)
@example('"a"b,"c\nd"e",f\n\n"', {1}, 1)
def test_records_of_ranges_are_those_of_the_text(text, cuts, batch):
    lines = text.split("\n")
    assert by_ranges(lines[:-1] if lines[-1] == "" else lines, cuts, batch) == whole(text)


def file_of(scratch, text, name="f"):
    folder = scratch("ranges").removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", newline="") as f:
        f.write(text)
    return folder


@pytest.fixture()
def small_ranges(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield of
    for c in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{c}")


def whole_file(spark, path):
    """The same file by Spark's reader of whole files."""
    names = spark.read.options(header=True, multiLine=True, escape='"').csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, C.MALFORMED]])
    rows = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', columnNameOfCorruptRecord=C.MALFORMED).csv(path).coalesce(1).collect()
    return [(*(None if r[C.MALFORMED] is not None else r[c] for c in names), r[C.MALFORMED]) for r in rows]


BODY = ['1,"two\nlines, ""quoted"""', "2,plain", '3,"a\n\n\n\nb\n"', '"4,\n",', "5", '6,x,"y\nz"', '7,"a"b"c', '8,un"quoted"', "", '9,""', '10,"', '",', '11,"last\n\n\none"']


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [40, 10 ** 9])
def test_rows_and_numbers_equal_the_reader_of_whole_files(spark, scratch, small_ranges, eol, size):
    path = file_of(scratch, "\n".join(["x,y", *BODY * 2]).replace("\n", eol))
    expected = whole_file(spark, path)
    small_ranges(size)
    got = C.scan_csv(spark, path, null_tokens=[], malformed=True).orderBy("row").collect()
    assert [r.row for r in got] == list(range(len(expected))) and [(r.x, r.y, r[C.MALFORMED]) for r in got] == expected
    assert any(r.y and "\n" in r.y for r in got) and any(r[C.MALFORMED] for r in got)


def test_many_tasks_read_one_file_and_a_value_longer_than_a_range(spark, scratch, small_ranges):
    rows = [(k, f"line {k}\nand, more" if k % 3 else "x" * 5 + "\n\n" * (900 if k == 300 else 1)) for k in range(600)]
    path = file_of(scratch, "k,v\n" + "".join(f'{k},"{v}"\n' for k, v in rows))
    small_ranges(700)
    back = C.scan_csv(spark, path)
    assert [(int(r.k), r.v, r.row) for r in back.orderBy("row").collect()] == [(k, v, k) for k, v in rows]
    assert C._lines(spark, path).rdd.getNumPartitions() > 10


def test_files_one_after_the_other(spark, scratch, small_ranges):
    folder = file_of(scratch, 'a,b\n1,"x\ny"\n\n2,z\n', "one")
    for name, text in (("two", '"a",b\n3,w'), ("three", "a,b\n"), ("zero", ""), ("blank", "\n\n")):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    small_ranges(6)
    got = [(r.row, r.a, r.b) for r in C.scan_csv(spark, folder).orderBy("row").collect()]
    assert got == [(0, "1", "x\ny"), (1, "2", "z"), (2, "3", "w")]


def test_beyond_the_broadcast_limit_lines_meet_their_range_in_a_shuffle(spark, scratch, small_ranges):
    rows = [(k, f"v{k}\n,{k}") for k in range(200)]
    path = file_of(scratch, "k,v\n" + "".join(f'{k},"{v}"\n' for k, v in rows))
    small_ranges(300)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        assert [(int(r.k), r.v) for r in C.scan_csv(spark, path).orderBy("row").collect()] == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_headers_and_line_ends_that_cannot_be_read(spark, scratch, small_ranges):
    path = file_of(scratch, "a,b\r1,2\r")
    with pytest.raises(ValueError, match="CR alone"):
        C.scan_csv(spark, path)
    small_ranges(8)
    path = file_of(scratch, '"a\n\n\n\n\n\n\n\n\n\n\n\n",b\n1,2\n')
    with pytest.raises(ValueError, match="header"):
        C.scan_csv(spark, path)


def test_values_are_parsed_once(spark, scratch):
    path = file_of(scratch, "a,b,c\n1,2,3\n")
    plan = C.scan_csv(spark, path, malformed=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert C.scan_csv(spark, path).filter(F.col("a") == "1").count() == 1
