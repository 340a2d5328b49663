"""CSV files with line breaks inside quotes, read in splits.

Spark cuts a text file into splits at line ends, and a line end may stand inside quotes. What a split is depends on
what comes before it: a record may begin with it, a quoted field may go on, or an unquoted field whose line
end was escaped. A first pass scans every split from each of these three states and notes the state at its end, how many
records begin in it, and how many lines at its two ends belong to records of other splits. Carried from split to split
in the order of a file, that says for every split in which state it is entered and what number its first record has. The
second pass cuts each split's records and reads their fields where they are; only records that cross
a split's end are put together elsewhere. Both passes must meet the same splits, so the result is written at once, while the
number of cores has no say in the splits.

The driver holds about 60 bytes for each split, as it does to plan the scan. Nothing holds more than a batch of lines
and one record.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: What a line begins in: a record, a quoted field, an unquoted field whose line end was escaped.
RECORD, QUOTED, PLAIN = 0, 1, 2
ROWS = 4096

_SCAN = "file string, start bigint, entry int, exit int, n_lines bigint, n_records bigint, head bigint, tail bigint"
_PARTS = "file string, start bigint, record bigint, number bigint, part int, fields array<string>, text string"
_WHOLE, _HEAD, _TAIL = 0, 1, 2


class Lines:
    """How one line changes the state, in a dialect with doubled quotes and, perhaps, backslash escapes."""

    def __init__(self, backslash: bool, delimiter: str = ","):
        d = re.escape(delimiter)
        self.backslash = backslash
        self.delimited = re.compile(d)
        # up to the quote that ends a field, and up to the delimiter that ends one
        self.quoted = re.compile(r'[^"\\]*(?:(?:""|\\.)[^"\\]*)*' if backslash else r'[^"]*(?:""[^"]*)*', re.S)
        self.plain = re.compile(rf"[^{d}\\]*(?:\\.[^{d}\\]*)*" if backslash else rf"[^{d}]*", re.S)

    def after(self, line: str, state: int) -> int:
        """The state at the beginning of the next line."""
        if '"' not in line and "\\" not in line:
            return QUOTED if state == QUOTED else RECORD
        at, n, fresh = 0, len(line), state == RECORD
        while True:
            if fresh and line.startswith('"', at):
                at, state, fresh = at + 1, QUOTED, False
            if state == QUOTED:
                at = self.quoted.match(line, at).end()
                if at >= n or line[at] == "\\":
                    return QUOTED
                at += 1
                if at < n and not self.delimited.match(line, at):
                    at += 1  # what follows the end of quotes is text, a backslash too
            at, state = self.plain.match(line, at).end(), PLAIN
            if at >= n:
                return RECORD
            if line[at] == "\\":
                return PLAIN
            at, fresh = at + 1, True

    def reader(self, lines: Iterator[str]):
        """Python's reader of this dialect over lines with their ends."""
        csv.field_size_limit(sys.maxsize)
        return csv.reader(lines, doublequote=True, escapechar="\\" if self.backslash else None)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split), value of every line, in their order within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """((file, start), lines) of each split of a partition; a split's lines follow one another."""

    def rows():
        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
            for file, start, line in zip(files, starts, batch.column("value").to_pylist()):
                yield (file, start), line

    for key, group in groupby(rows(), lambda r: r[0]):
        yield key, (line for _, line in group)


def _is_blank(line: str) -> bool:
    return not line or line.isspace()


def scan_splits(spark: SparkSession, path: str, backslash: bool) -> DataFrame:
    """For each split and state of entry: the state at its end, its records that begin in it and its lines of others.

    ``head`` counts the lines of a record that began before, ``tail`` those of one that began here and goes on after.
    """
    dialect = Lines(backslash)

    def scan(batches):
        for (file, start), lines in _splits(batches):
            states, n = [RECORD, QUOTED, PLAIN], 0
            records, heads, opened = [0, 0, 0], [None, None, None], [0, 0, 0]
            for line in lines:
                for k, state in enumerate(states):
                    if state == RECORD:
                        if heads[k] is None:
                            heads[k] = n
                        if _is_blank(line):
                            continue
                        records[k] += 1
                        opened[k] = n
                    states[k] = dialect.after(line, state)
                n += 1
            for k, state in enumerate(states):
                head = n if heads[k] is None else heads[k]
                tail = n - opened[k] if state != RECORD and records[k] else 0
                yield pa.RecordBatch.from_pylist(
                    [{"file": file, "start": start, "entry": k, "exit": state, "n_lines": n, "n_records": records[k], "head": head, "tail": tail}],
                    schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()),
                                      ("n_lines", pa.int64()), ("n_records", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())]),
                )

    return _lines(spark, path).mapInArrow(scan, _SCAN)


def entered_splits(scanned: DataFrame, header: bool) -> list[tuple]:
    """(file, start, entry, number of the first record, of the file's first, head, n_lines - tail) of each split, files by name.

    Records are numbered from 0 over all files; with ``header`` each file's first one takes no number of its own. A file that
    ends within quotes raises.
    """
    out, total = [], 0
    by_file = sorted(scanned.collect(), key=lambda r: (r.file, r.start, r.entry))
    for file, rows in groupby(by_file, lambda r: r.file):
        first = number = total - header
        state = RECORD
        for _, entries in groupby(rows, lambda r: r.start):
            r = list(entries)[state]
            out.append((r.file, r.start, state, number, first, r.head, r.n_lines - r.tail, r.n_lines))
            number, state = number + r.n_records, r.exit
        if state == QUOTED:
            raise ValueError(f"{file} ends inside a quoted field")
        total = max(total, number)
    return out


@contextmanager
def fixed_splits(spark: SparkSession):
    """Splits depend on the files and ``spark.sql.files.maxPartitionBytes`` alone, not on how many cores there are just now."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_records(
    spark: SparkSession,
    path: str,
    stage: Callable[[DataFrame, str], DataFrame],
    backslash: bool = False,
    header: bool = False,
    name: str = "csv_records",
) -> DataFrame:
    """file, record (its place in the file, from 0), number, fields of every record, stored by ``stage`` under ``name``.

    Numbers follow the files by name and the records in them, from 0 and without gaps, whatever the splits; with ``header``
    the first record of each file is not counted. Blank lines are no records. Equal to Python's reader over file after file.
    """
    with fixed_splits(spark):
        splits = entered_splits(scan_splits(spark, path, backslash), header)
        return stage(_cut_records(spark, path, splits, backslash), name)


def _cut_records(spark: SparkSession, path: str, splits: list[tuple], backslash: bool) -> DataFrame:
    known = spark.sparkContext.broadcast({(s[0], s[1]): s[2:] for s in splits})
    dialect = Lines(backslash)
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("record", pa.int64()), ("number", pa.int64()), ("part", pa.int32()),
                        ("fields", pa.list_(pa.string())), ("text", pa.string())])

    def cut(batches):
        for (file, start), lines in _splits(batches):
            _, number, first, head, last, _ = known.value[file, start]
            heads: list[str] = []
            tails: list[str] = []
            now = ""

            def whole(lines=lines):
                nonlocal now
                for at, line in enumerate(lines):
                    if at < head:
                        heads.append(line)
                    elif at >= last:
                        tails.append(line)
                    else:
                        now = line
                        yield line + "\n"

            rows = []

            def add(part, fields, text):
                rows.append({"file": file, "start": start, "record": number - first, "number": number, "part": part, "fields": fields, "text": text})

            for fields in dialect.reader(whole()):
                if not fields or (len(fields) == 1 and _is_blank(fields[0]) and _is_blank(now)):
                    continue
                add(_WHOLE, fields, None)
                number += 1
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows.clear()
            if heads:
                add(_HEAD, None, "\n".join(heads))
            if tails:
                add(_TAIL, None, "\n".join(tails))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    lines = _lines(spark, path)
    columns = ["file", "record", "number", "fields"]
    records = lines.mapInArrow(cut, _PARTS).where(F.col("part") == _WHOLE).select(*columns)
    crossed = sorted({file for file, _, entry, _, _, head, last, n in splits if last < n or (entry != RECORD and head)})
    if not crossed:
        return records

    # a record that crosses splits: the tail of one, all lines of those between, the head of the last
    pieces = lines.where(F.col("file").isin(crossed)).mapInArrow(cut, _PARTS).where(F.col("part") != _WHOLE)
    chain = F.sum((F.col("part") == _TAIL).cast("int")).over(Window.partitionBy("file").orderBy("start", "part"))
    tail = F.col("part") == _TAIL
    joined = pieces.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.max(F.when(tail, F.col("record"))).alias("record"), F.max(F.when(tail, F.col("number"))).alias("number"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "part", "text"))), lambda p: p["text"]), "\n").alias("text"),
    )
    out = pa.schema([schema.field(n) for n in columns])

    def parse(batches):
        for batch in batches:
            rows = batch.select(columns[:3]).to_pylist()
            for row, text in zip(rows, batch.column("text").to_pylist()):
                row["fields"] = next(dialect.reader(iter([text + "\n"])))
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return records.unionByName(joined.mapInArrow(parse, "file string, record bigint, number bigint, fields array<string>"))
