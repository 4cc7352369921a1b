"""CSV records with quoted line breaks, over files of any split size.

A quoted field may hold line breaks, so a line belongs to the record of an
earlier line if a quote is open where it begins, and that depends on everything
before it in the file. Seen from a line, only two things can be true at its
start, quote open or not, and the line maps each to what is true at its end.
Such maps compose, so the splits of a file work side by side:

1. every split composes the maps of its lines into one row;
2. the rows of a file, a few bytes per split, are composed in order
   (``applyInArrow`` per file), which tells each split whether it begins inside
   a record and in which split that record began;
3. every split cuts its lines into records. The records that cross splits come
   as fragments, at most two per split, and are put together by a ``groupBy``.

Lines without a quote are passed over by Arrow; only lines that hold one are
scanned character by character. Quotes open a field at its first character, a
doubled quote inside stands for one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitfit.session import work_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
# Splits that begin inside a record: broadcast up to so many, else joined by shuffle.
BROADCAST_SPLITS = 100_000
# A record longer than this many characters is an error: most likely a quote that is never closed.
MAX_RECORD = 1 << 26

LINE_SCHEMA = "file string, split bigint, at bigint, value string"


def end_state(line: str, opened: bool, sep: str, quote: str = QUOTE) -> bool:
    """Whether a quote is open at the end of a line that begins with ``opened``."""
    i = 0
    while True:
        if not opened:
            if not line.startswith(quote, i):
                i = line.find(sep, i) + len(sep)
                if i < len(sep):
                    return False
                continue
            i += len(quote)
        # inside a quoted field: to the quote that is not doubled
        while True:
            i = line.find(quote, i)
            if i < 0:
                return True
            if not line.startswith(quote * 2, i):
                break
            i += 2 * len(quote)
        opened, i = False, line.find(sep, i)
        if i < 0:
            return False
        i += len(sep)


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and order."""
    lines = spark.read.text(path, lineSep="\n")
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.monotonically_increasing_id().alias("at"), "value")


def _splits(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """Rows of each batch by runs of equal split: (file, split, first of the split seen?, columns)."""
    before = None
    for b in batches:
        if not b.num_rows:
            continue
        files, starts = b.column("file"), b.column("split").to_numpy(zero_copy_only=False)
        codes = pc.fill_null(files, "").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
        for i, j in zip([0, *cuts], [*cuts, b.num_rows]):
            key = (files[int(i)].as_py(), int(starts[i]))
            yield *key, key != before, [b.column(c).slice(i, j - i) for c in columns]
            before = key


def _make_state_kernel(sep: str):
    """``mapInArrow`` function: per split, the state at its end for either state at its start, and
    whether a quote that is open at its start is ever closed in it."""

    def kernel(batches):
        key, ends, closes = None, [False, True], False

        def row():
            return pa.RecordBatch.from_pylist([{"file": key[0], "split": key[1], "from_closed": ends[0],
                                                "from_open": ends[1], "closes": closes}])
        for file, split, first, (values,) in _splits(batches, ["value"]):
            if first:
                if key is not None:
                    yield row()
                key, ends, closes = (file, split), [False, True], False
            for line in values.filter(pc.match_substring(values, QUOTE)).to_pylist():
                ends = [end_state(line, s, sep) for s in ends]
                closes = closes or not ends[1]
        if key is not None:
            yield row()

    return kernel


STATE_SCHEMA = "file string, split bigint, from_closed boolean, from_open boolean, closes boolean"


def _chain(table: pa.Table) -> pa.Table:
    """The splits of one file that begin inside a record, and the split in which that record began."""
    out, opened, began = [], False, 0
    for r in sorted(table.to_pylist(), key=lambda r: r["split"]):
        if opened:
            out.append({"file": r["file"], "split": r["split"], "began": began})
        if not opened or r["closes"]:
            began = r["split"]      # a record that is open at the end began in this split
        opened = r["from_open"] if opened else r["from_closed"]
    return pa.Table.from_pylist(out, schema=pa.schema([("file", pa.string()), ("split", pa.int64()), ("began", pa.int64())]))


def _make_record_kernel(sep: str, limit: int):
    """``mapInArrow`` function: records of lines whose split's ``began`` is known. A record that crosses
    splits comes in fragments, ``began`` being set; ``head`` marks a file's first record."""
    names = ["file", "split", "began", "head", "value"]
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("began", pa.int64()), ("head", pa.bool_()),
                        ("value", pa.string())])

    def batch(file, split, began, head, values):
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            [[file] * n, [split] * n, began, head, values], schema.types)], names)

    def kernel(batches):
        key, parts, size, carried, top = None, [], 0, None, False

        def left():     # an open record at the end of its split
            yield batch(*key, [key[1] if carried is None else carried], [top], ["\n".join(parts)])

        for file, split, first, (values, began) in _splits(batches, ["value", "began"]):
            if first:
                if parts:
                    yield from left()
                key, parts, size, carried = (file, split), [], 0, began[0].as_py()
                top = split == 0        # the next record is the first of its file
            opened = bool(parts) or (first and carried is not None)
            done, marks, heads = [], [], []
            quoted = pc.match_substring(values, QUOTE).to_numpy(zero_copy_only=False)
            for line, q in zip(values.to_pylist(), quoted):
                opened = end_state(line, opened, sep) if q else opened
                parts.append(line)
                size += len(line) + 1
                if size > limit:
                    raise ValueError(f"a record of {file} is longer than {limit} characters: a quote that is never closed?")
                if not opened:
                    done.append("\n".join(parts))
                    marks.append(carried)
                    heads.append(top)
                    parts, size, carried, top = [], 0, None, False
            if done:
                yield batch(*key, marks, heads, done)
        if parts:
            yield from left()

    return kernel


RECORD_SCHEMA = "file string, split bigint, began bigint, head boolean, value string"


def read_records(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                 max_record: int = MAX_RECORD) -> DataFrame:
    """One row ``value`` per CSV record of the files under ``path``; line breaks inside quotes stay.

    ``header``: the first record of every file is left out. A record with a quote that
    is not closed by the end of its file runs to that end; one of more than
    ``max_record`` characters is an error.
    """
    lines = _numbered(spark, path)
    states = lines.mapInArrow(_make_state_kernel(sep), STATE_SCHEMA)
    began = states.groupBy("file").applyInArrow(_chain, "file string, split bigint, began bigint")
    # Few splits begin inside a record; their number decides how they are joined.
    path_of = work_path(spark, "csv-splits")
    began.write.parquet(path_of)
    began = spark.read.schema(began.schema).parquet(path_of)
    if began.count() <= BROADCAST_SPLITS:
        joined = lines.join(F.broadcast(began), ["file", "split"], "left")
    else:
        joined = lines.join(began, ["file", "split"], "left").sortWithinPartitions("at")
    found = joined.select("file", "split", "at", "value", "began").mapInArrow(
        _make_record_kernel(sep, max_record), RECORD_SCHEMA)
    whole = found.where("began IS NULL").select("head", "value")
    # A fragment that begins its record carries no mark of its own split unless it stays open.
    pieces = F.array_sort(F.collect_list(F.struct("split", "head", "value")))
    joined_up = (found.where("began IS NOT NULL").groupBy("file", "began").agg(pieces.alias("p"))
                 .select(F.exists("p", lambda x: x["head"]).alias("head"),
                         F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value")))
    records = whole.unionByName(joined_up)
    if header:
        records = records.where(~F.col("head"))
    return records.select(F.regexp_replace("value", "\r$", "").alias("value"))
