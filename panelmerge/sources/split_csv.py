"""CSV files that split: many tasks read one file, line breaks in quotes included.

A task that starts in the middle of a file can't know whether it starts inside a quoted
field. So the lines are read twice, as text. The first pass finds, for each split, in which state
(in quotes or not) it ends for either state that it may start in, and the pieces of records at its
ends. A running composition over these summaries (a row a split) gives the state at each start. The second
pass cuts the lines into records; a record over several splits is joined from the summaries' pieces.
``from_csv`` parses the records.

Quotes are doubled inside a quoted field; a quote inside a field that doesn't begin with one is
a character like others, as in Spark's own reader. Records end with a line feed, or, if
the file's first line does, with a carriage return and one. The encoding has to keep ASCII bytes (UTF-8, Latin-1 and their like).
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelmerge.session import ensure_checkpoint_dir

QUOTE, COMMA, BOM = b'"', b",", b"\xef\xbb\xbf"
SUMMARY = ("file string, block long, end0 int, end1 int, head1 binary, tail0 binary, tail0_row long, "
           "tail1 binary, tail1_row long, first binary, first_row long, valid boolean, crlf boolean")
RECORDS = "file string, block long, row long, record binary"


def end_state(line: bytes, state: int) -> int:
    """1 if a quoted field is open behind the line, which starts in ``state``."""
    parts = line.split(QUOTE)
    for i, part in enumerate(parts[:-1]):  # each is followed by a quote
        if state == 1:
            state = 2  # ends the field, or is the first of two
        elif state == 2 and not part and i:
            state = 1
        else:
            state = int(part.endswith(COMMA) or not (i or part))
    return int(state == 1)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (where its split begins) and line, in the order of each split."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes], pa.Array, pa.RecordBatch]]:
    """((file, block), lines, whether each has a quote, rows) of neighbouring lines of one split."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        files, blocks = batch.column(0), batch.column(1)
        cuts = [0]
        if n > 1:
            new = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            cuts += [i + 1 for i, x in enumerate(new.to_pylist()) if x]
        cuts.append(n)
        for i, j in zip(cuts, cuts[1:]):
            own = batch.slice(i, j - i)
            lines = own.column(2)
            quoted = pc.match_substring(lines, QUOTE)
            yield (files[i].as_py(), blocks[i].as_py()), lines.to_pylist(), quoted.to_pylist(), own


class Cutter:
    """Cuts the lines of a split into records, for one state at its start."""

    def __init__(self, state: int) -> None:
        self.state = state
        self.head: bytes | None = None  # what ends a record of an earlier split; without an end, all there is
        self.first: tuple[bytes, int] | None = None
        self.open: list[bytes] = []
        self.open_row = -1 if state else 0  # -1: a record of an earlier split

    def add(self, line: bytes, row: int, quoted: bool) -> tuple[bytes, int] | None:
        """The record (and the number of its first line) that the line ends, if it ends one."""
        if not self.open and self.state == 0:
            self.open_row = row
        self.open.append(line)
        if quoted:
            self.state = end_state(line, self.state)
        if self.state:
            return None
        record, at, self.open = b"\n".join(self.open), self.open_row, []
        if at < 0:
            self.head, self.open_row = record, 0
            return None
        if record in (b"", b"\r"):  # a blank line
            return None
        self.first = self.first or (record, at)
        return record, at

    def tail(self) -> tuple[bytes | None, int | None]:
        return (b"\n".join(self.open), self.open_row) if self.open else (None, None)


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, own, row, valid, crlf = None, (), 0, True, False

    def out():
        zero, one = own
        tail0, tail1 = zero.tail(), one.tail()
        # Lines that are all inside quotes are a head without an end.
        head = one.head if one.head is not None else tail1[0] if tail1[1] == -1 else None
        first = zero.first or ((tail0[0], tail0[1]) if tail0[0] else (None, None))
        values = (*last, zero.state, one.state, head, *tail0, *((None, None) if tail1[1] == -1 else tail1), *first, valid, crlf)
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [x.split()[0] for x in SUMMARY.split(", ")])

    for key, lines, quoted, rows in runs(batches):
        if key != last:
            if last is not None:
                yield out()
            last, own, row, valid, crlf = key, (Cutter(0), Cutter(1)), 0, True, lines[0].endswith(b"\r")
        valid = valid and bool(pc.all(rows.column(3)).as_py())
        for line, q in zip(lines, quoted):
            if key[1] == 0 and row == 0 and line.startswith(BOM):
                line = line[len(BOM):]
            for cutter in own:
                cutter.add(line, row, q)
            row += 1
    if last is not None:
        yield out()


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, cutter, row = None, None, 0
    for key, lines, quoted, rows in runs(batches):
        if key != last:
            last, cutter, row = key, Cutter(rows.column(3)[0].as_py()), 0
        found = []
        for line, q in zip(lines, quoted):
            if key[1] == 0 and row == 0 and line.startswith(BOM):
                line = line[len(BOM):]
            record = cutter.add(line, row, q)
            if record is not None:
                found.append(record)
            row += 1
        n = len(found)
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([r for _, r in found], pa.int64()), pa.array([t for t, _ in found], pa.binary())], ["file", "block", "row", "record"])


def with_starts(summary: DataFrame) -> DataFrame:
    """``summary`` with ``start``, the state at the start of each split. Along a file, a split that ends
    alike for both states sets the state, one that ends the other way round flips it."""
    order = Window.partitionBy("file").orderBy("block")  # a row a split
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sets, flips = F.col("end0") == F.col("end1"), F.when(F.col("end0") > F.col("end1"), 1).otherwise(0)
    s = summary.withColumn("flips", F.sum(flips).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.coalesce(F.lag("flips").over(order), F.lit(0)) - F.coalesce(F.last(F.when(sets, F.col("flips")), True).over(before), F.lit(0))
    last = F.coalesce(F.last(F.when(sets, F.col("end0")), True).over(before), F.lit(0))
    return s.withColumn("start", ((last + since) % 2).cast("int")).drop("flips")


def broken_records(starts: DataFrame) -> DataFrame:
    """Records over several splits, in the columns of RECORDS, at the place where they begin."""
    head = F.struct(F.lit(0).alias("at"), F.lit(False).alias("begins"), F.col("head1").alias("text"), F.lit(None).cast("long").alias("row"))
    tail = F.when(F.col("start") == 1, F.struct("tail1", "tail1_row")).otherwise(F.struct(F.col("tail0").alias("tail1"), F.col("tail0_row").alias("tail1_row")))
    tail = F.struct(F.lit(1).alias("at"), F.lit(True).alias("begins"), tail["tail1"].alias("text"), tail["tail1_row"].alias("row"))
    parts = starts.select("file", "block", F.explode(F.array(F.when(F.col("start") == 1, head), tail)).alias("p")).filter("p.text IS NOT NULL").select("file", "block", "p.*")
    chain = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("file").orderBy("block", "at"))
    whole = parts.withColumn("chain", chain).groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "at", "row", "text"))).alias("parts"))
    text = F.aggregate("parts", F.lit(None).cast("binary"), lambda a, p: F.when(a.isNull(), p["text"]).otherwise(F.concat(a, F.lit(bytearray(b"\n")), p["text"])))
    return whole.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"), text.alias("record"))


def split_records(spark: SparkSession, paths: list[str], summary: DataFrame) -> DataFrame:
    """file, block, row, record: all records of the files. ``summary``: of the same files, stored."""
    starts = with_starts(summary)
    # A row for each split of 128 MB or so: some 30 bytes of memory for each.
    known = F.broadcast(starts.select(F.xxhash64("file").alias("f"), F.col("block").alias("b"), "start"))
    lines = lines_of(spark, paths).withColumn("of", F.xxhash64("file"))
    lines = lines.join(known, F.expr("of = f AND block = b"), "left")
    state = F.coalesce("start", F.raise_error(F.lit("the files were split otherwise in the first pass: read them again")).cast("int"))
    cut = lines.select("file", "block", "line", state.alias("start")).mapInArrow(cut_records, RECORDS)
    return cut.unionByName(broken_records(starts))


def safe_names(header: list[str]) -> list[str]:
    """Column names as Spark's reader gives them: empty and repeated ones are numbered."""
    seen = [h.lower() for h in header]
    return [f"_c{i}" if not h else h + str(i) if seen.count(h.lower()) > 1 else h for i, h in enumerate(header)]


def read_csv_split(spark: SparkSession, paths, encoding: str | None = None, schema: StructType | str | None = None,
                   header: bool = True, order_col: str | None = None) -> DataFrame | None:
    """Text columns of CSV files, united by name (by position without a header); each file is
    UTF-8, or Latin-1 if some byte isn't valid in UTF-8. ``encoding`` fixes the encoding, ``schema`` names and types the columns by position.
    ``order_col`` adds the place of each row: file, block, row. None: there is no line in the files.

    Blank lines are left out; short records are filled with null, long ones cut, as in Spark's
    reader. A quoted field that isn't closed takes the rest of its file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    checked = lines_of(spark, paths).withColumn("valid", F.is_valid_utf8(F.col("line").cast("string")))
    stored = f"{ensure_checkpoint_dir(spark)}/csv-splits-{uuid.uuid4().hex}"
    checked.mapInArrow(summarise, SUMMARY).write.parquet(stored)
    summary = spark.read.schema(SUMMARY).parquet(stored)
    firsts = broken_records(with_starts(summary)).join(summary.filter("block = 0").select("file", "block", F.col("first_row").alias("row")), ["file", "block", "row"])
    whole = summary.filter("block = 0 AND first IS NOT NULL").select("file", "first", "first_row", "crlf").join(
        firsts.select("file", "record"), "file", "left").select("file", F.coalesce("record", "first").alias("first"), "first_row", "crlf")
    valid = summary.groupBy("file").agg(F.bool_and("valid").alias("valid"))
    files = valid.join(whole, "file", "left").orderBy("file").collect()   # one row a file
    if not any(f.first is not None for f in files):
        return None
    names: dict[str, list] = {}
    infos = []
    for f in files:
        charset = encoding or ("UTF-8" if f.valid else "ISO-8859-1")
        text = bytes(f.first or b"").decode(charset, "replace")
        text = text.replace("\r\n", "\n").removesuffix("\r") if f.crlf else text
        cells = next(csv.reader(text.splitlines(keepends=True)), [])
        own = safe_names(cells) if header else [f"_c{i}" for i in range(len(cells))]
        names.setdefault("\x00".join(own), own)
        infos.append((f.file, charset, list(names).index("\x00".join(own)), f.first_row if header else None, bool(f.crlf)))
    known = spark.createDataFrame(infos, "of string, charset string, layout int, header_row long, crlf boolean")
    records = split_records(spark, paths, summary).join(F.broadcast(known), F.col("file") == F.col("of"))   # a row a file
    if header:
        records = records.filter("NOT (block = 0 AND row <=> header_row)")
    charsets = sorted({info[1] for info in infos})
    text: Column = F.col("record").cast("string")
    for charset in charsets:
        if charset.upper() not in ("UTF-8", "UTF8"):
            text = F.when(F.col("charset") == charset, F.decode("record", charset)).otherwise(text)
    # A file whose first line ends with a carriage return and a line feed has both at the end of each.
    text = F.when(F.col("crlf"), F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\r$", "")).otherwise(text)
    if schema is None:
        width = max(map(len, names.values()))
        parsed_as = StructType([StructField(f"_c{i}", StringType()) for i in range(max(width, 1))])
    else:
        parsed_as = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    ddl = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in parsed_as)
    parsed = records.select("layout", F.struct("file", "block", "row").alias("__at"),
                            F.from_csv(text, ddl, {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"}).alias("__cells"))
    order = [F.col("__at").alias(order_col)] if order_col else []
    if schema is not None:
        return parsed.select("__cells.*", *order)
    out = {}
    for layout, own in enumerate(names.values()):
        for i, name in enumerate(own):
            cell = F.when(F.col("layout") == layout, F.col(f"__cells._c{i}")) if len(names) > 1 else F.col(f"__cells._c{i}")
            out[name] = F.coalesce(out[name], cell) if name in out else cell
    return parsed.select(*(c.alias(n) for n, c in out.items()), *order)
