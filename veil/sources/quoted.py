"""CSV files with line breaks in quotes, read by many tasks per file.

Spark reads such a file in one task, because a byte range does not show whether it begins inside quotes.
Here every range is looked at once under both assumptions: whether it ends inside quotes if it began
outside, and if it began inside. Those transitions compose, so a window over the ranges of a file, one row
each, gives the true state at every start. A second reading puts the lines of each record together from
there; only records that lie across the border of two ranges meet in a shuffle. Records are then
parsed by Spark's own CSV parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FILE, RECORD = "_file", "_record"
_SPLIT = "path string, start long, crlf boolean, if_out boolean, if_in boolean, from_out long, from_in long"
_BLANK = "".join(map(chr, range(33)))
_PART = "path string, start long, seq long, begins boolean, ends boolean, record string"


class Quoting:
    """Where quoted values begin and end in a line, for one set of CSV options."""

    def __init__(self, options: Mapping[str, Any]):
        quote = options.get("quote", '"') or ""
        escape = options.get("escape", "\\") or ""
        sep = options.get("sep") or options.get("delimiter") or ","
        self.quote, self.comment = quote, options.get("comment") or ""
        self.trims = str(options.get("ignoreLeadingWhiteSpace", False)).lower() == "true"
        if not quote:
            return
        blank = "".join(re.escape(c) for c in map(chr, range(33)) if c not in sep and c != "\n")
        q, e = re.escape(quote), re.escape(escape)
        self._open = re.compile(f"(?:^|{re.escape(sep)})" + (f"[{blank}]*" if self.trims else "") + q)
        if escape in ("", quote):
            self._inside = re.compile(f"[^{q}]*+" + (f"(?:{q}{q}[^{q}]*+)*+" if escape else ""))
        else:
            self._inside = re.compile(rf"(?:[^{q}{e}]|{e}.|{e}\Z)*+", re.DOTALL)

    def ends_inside(self, line: str, inside: bool) -> bool:
        """Whether the line ends in a quoted value, given whether it begins in one."""
        at = 0
        if not inside:
            if self.comment and line.startswith(self.comment):
                return False
            found = self._open.search(line)
            if found is None:
                return False
            at = found.end()
        while True:
            close = self._inside.match(line, at).end()
            if close == len(line):
                return True
            found = self._open.search(line, close + 1)
            if found is None:
                return False
            at = found.end()

    def is_record(self, lines: pa.Array) -> np.ndarray:
        """Whether a line outside quotes begins a record: it is neither empty nor a comment."""
        true = pc.not_equal(pc.binary_length(pc.utf8_trim(lines, _BLANK) if self.trims else lines), 0)
        if self.comment:
            true = pc.and_not(true, pc.starts_with(lines, self.comment))
        return true.to_numpy(zero_copy_only=False)

    def transitions(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lines that change the state under either assumption, and the states after them."""
        if not self.quote:
            return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
        quoted = np.flatnonzero(pc.match_substring(lines, self.quote).to_numpy(zero_copy_only=False))
        values = lines.take(pa.array(quoted)).to_pylist()
        out = np.array([self.ends_inside(v, False) for v in values], bool)
        inside = np.array([self.ends_inside(v, True) for v in values], bool)
        change = out | ~inside
        return quoted[change], out[change], inside[change]

    def states(self, lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
        """Whether each line begins inside quotes, and whether the last one ends there."""
        at, out, within = self.transitions(lines)
        now, before = inside, np.zeros(len(lines), bool)
        begin = 0
        for i, a, b in zip(at.tolist(), out.tolist(), within.tolist()):
            before[begin : i + 1] = now
            now, begin = (b if now else a), i + 1
        before[begin:] = now
        return before, now


def splittable(options: Mapping[str, Any]) -> bool:
    """Whether files with these options can be read in ranges: UTF-8, no types to guess, lines that end in a line feed."""
    encoding = str(options.get("encoding") or options.get("charset") or "UTF-8").upper().replace("-", "")
    guess = str(options.get("inferSchema", False)).lower() == "true"
    mode = str(options.get("mode", "PERMISSIVE")).upper()
    return encoding == "UTF8" and not guess and options.get("lineSep") in (None, "\n", "\r\n") and mode in ("PERMISSIVE", "FAILFAST")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, list) else str(path))
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The parts of a batch that come from one range of one file."""
    starts, paths = batch.column(1).to_numpy(), batch.column(0)
    change = starts[1:] != starts[:-1]
    if len(paths) > 1:
        change |= pc.not_equal(paths.slice(1), paths.slice(0, len(paths) - 1)).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(paths)] if len(paths) else []
    for a, b in zip(edges, edges[1:]):
        # a copy, since some kernels read a slice from its beginning
        yield paths[a].as_py(), int(starts[a]), pa.concat_arrays([batch.column(2).slice(a, b - a)])


def ranges(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, Any]) -> DataFrame:
    """``path, start, crlf, inside, records``: per range whether it begins inside quotes, and how many records begin in it;
    and of the first range of a file whether its lines end in two characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting = Quoting(options)
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for name, start, lines in _runs(batch):
                if (name, start) not in found:
                    # a file's first line tells how its lines end
                    found[name, start] = [start == 0 and lines[0].as_py().endswith("\r"), False, True, 0, 0]
                state = found[name, start]
                begins = quoting.is_record(pc.replace_substring_regex(lines, r"^\r$", "") if not quoting.trims else lines)
                for k in (1, 2):
                    before, state[k] = quoting.states(lines, state[k])
                    state[2 + k] += int((begins & ~before).sum())
        rows = [(*key, *state) for key, state in found.items()]
        if rows:
            types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [c.split()[0] for c in _SPLIT.split(", ")])

    each = _lines(spark, path).mapInArrow(run, _SPLIT)
    # the state before a range: what the last range that ignores its own start left, turned over by those that swap
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    fixed, swaps = F.col("if_out") == F.col("if_in"), (F.col("if_out") & ~F.col("if_in")).cast("long")
    turned = each.withColumn("turns", F.sum(swaps).over(W.partitionBy("path").orderBy("start")))
    last = F.last(F.when(fixed, F.struct("if_out", "turns")), ignorenulls=True).over(before)
    turns = F.coalesce(F.sum(swaps).over(before), F.lit(0)) - F.coalesce(last["turns"], F.lit(0))
    inside = F.coalesce(last["if_out"], F.lit(False)) != (turns % 2 == 1)
    return turned.select("path", "start", "crlf", inside.alias("inside"), "from_out", "from_in").select(
        "path", "start", "crlf", "inside", F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out")).alias("records")
    )


def count_records(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, Any]) -> DataFrame:
    """``_file, records``: the records of each file, header lines left out, from one reading."""
    header = str(options.get("header", False)).lower() == "true"
    counted = ranges(spark, path, options).groupBy(F.col("path").alias(FILE)).agg(F.sum("records").alias("records"))
    return counted.withColumn("records", F.greatest(F.col("records") - F.lit(int(header)), F.lit(0)).cast("long"))


class _Range:
    """Puts the records of one range together from its lines."""

    def __init__(self, quoting: Quoting, path: str, start: int, inside: bool):
        self.quoting, self.path, self.start, self.inside = quoting, path, start, inside
        self.begins, self.held = not inside, [] if inside else None
        self.seq = -1

    def read(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """The records that end in these lines."""
        n = len(lines)
        before, self.inside = self.quoting.states(lines, self.inside)
        first = np.flatnonzero(~before)
        lead = int(first[0]) if len(first) else n
        done: list[tuple[int, bool, str]] = []
        if self.held is not None:
            self.held += lines.slice(0, lead).to_pylist()
            if lead < n or not self.inside:
                done.append((self.seq, self.begins, "\n".join(self.held)))
                self.held = None
        last = np.append(first[1:], n)
        true = self.quoting.is_record(lines)[first]
        first, last = first[true], last[true]
        seqs = self.seq + 1 + np.arange(len(first))
        self.seq += len(first)
        if self.inside and len(first) and self.held is None:
            self.begins, self.held = True, lines.slice(int(first[-1])).to_pylist()
            first, last, seqs = first[:-1], last[:-1], seqs[:-1]
        texts = lines.take(pa.array(first))
        several = np.flatnonzero(last - first > 1)
        if len(several):
            values = texts.to_pylist()
            for i in several.tolist():
                values[i] = "\n".join(lines.slice(int(first[i]), int(last[i] - first[i])).to_pylist())
            texts = pa.array(values, pa.string())
        for seq, begins, text in done:
            yield self._batch([seq], begins, True, pa.array([text], pa.string()))
        if len(first):
            yield self._batch(seqs, True, True, texts)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """The part of a record that goes on behind the range."""
        if self.held is not None:
            yield self._batch([self.seq], self.begins, False, pa.array(["\n".join(self.held)], pa.string()))

    def _batch(self, seqs, begins: bool, ends: bool, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.repeat(self.path, n), pa.repeat(self.start, n), pa.array(seqs, pa.int64())]
        columns += [pa.repeat(begins, n), pa.repeat(ends, n), texts]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PART.split(", ")])


def records(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, Any]) -> DataFrame:
    """``_file, _record``: the text of each record, header lines left out."""
    header = str(options.get("header", False)).lower() == "true"
    known = ranges(spark, path, options)
    earlier = F.coalesce(F.sum("records").over(W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tops = (earlier == 0) & (F.col("records") > 0)
    # only ranges that begin inside a value or hold a header behind empty lines, and the first ones of files with
    # other line ends; the driver plans every range anyway
    told = known.select("path", "start", "crlf", "inside", tops.alias("top")).where("crlf OR inside OR (top AND start > 0)")
    starts: dict[str, set[int]] = {}
    moved: dict[str, int] = {}
    crlf: set[str] = set()
    for r in told.toLocalIterator():
        if r.inside:
            starts.setdefault(r.path, set()).add(r.start)
        if r.crlf:
            crlf.add(r.path)
        if r.top and r.start:
            moved[r.path] = r.start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting, reader = Quoting(options), None
        for batch in batches:
            for name, start, lines in _runs(batch):
                if reader is None or (reader.path, reader.start) != (name, start):
                    if reader is not None:
                        yield from reader.rest()
                    reader = _Range(quoting, name, start, start in starts.get(name, ()))
                yield from reader.read(pc.replace_substring_regex(lines, r"\r$", "") if name in crlf else lines)
        if reader is not None:
            yield from reader.rest()

    parts = _lines(spark, path).mapInArrow(run, _PART)
    # pieces of records across borders, two per border at most
    rank = F.sum(F.col("begins").cast("long")).over(W.partitionBy("path").orderBy("start", "seq"))
    pieces = parts.where("NOT (begins AND ends)").withColumn("rank", rank)
    in_order = F.sort_array(F.collect_list(F.struct("start", "seq", "record", "ends"))).alias("p")
    first, text = F.element_at("p", 1), F.array_join(F.col("p.record"), "\n")
    # a value that is never closed takes the file's last line feed along
    text = F.when(F.element_at("p", -1)["ends"], text).otherwise(F.concat(text, F.lit("\n")))
    joined = pieces.groupBy("path", "rank").agg(in_order).select(
        "path", first["start"].alias("start"), first["seq"].alias("seq"), text.alias("record")
    )
    every = parts.where("begins AND ends").select("path", "start", "seq", "record").unionByName(joined)
    if header:
        top = F.lit(0).cast("long")
        for name, start in moved.items():
            top = F.when(F.col("path") == name, F.lit(start)).otherwise(top)
        every = every.where(~((F.col("start") == top) & (F.col("seq") == 0)))
    return every.select(F.col("path").alias(FILE), F.col("record").alias(RECORD))


def read_records(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, Any], schema: StructType | None) -> DataFrame:
    """The columns of the files, with the file of each row as ``_file``; without a schema all header names as text."""
    if schema is None:
        schema = StructType([StructField(c, StringType()) for c in spark.read.options(**options).csv(path).columns])
    own = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in ("header", "lineSep")}
    parsed = F.from_csv(F.col(RECORD), schema.toDDL(), own | {"multiLine": "true"})
    return records(spark, path, options).select(parsed.alias("_parsed"), FILE).select("_parsed.*", FILE)
