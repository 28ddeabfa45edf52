"""CSV scans with per-file encoding detection.

Spark never raises on bad UTF-8 (it substitutes U+FFFD), so "try utf-8, then
fall back" cannot be an exception handler. Instead each file is scanned as
text and checked with ``is_valid_utf8`` - one distributed aggregation over
all files, grouped by ``_metadata.file_path`` - and files with invalid bytes
are read as ISO-8859-1 (which accepts any byte). A UTF-8 BOM is stripped by
the CSV reader itself.

Quoted fields may hold line breaks; ``split_csv`` reads such a file by many tasks all the
same. Only encodings that don't keep ASCII bytes (UTF-16) are read by one task a file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelmerge.functions.nulls import clean_text
from panelmerge.sources.split_csv import read_csv_split

ROW = "__row"
ASCII_BYTES = {"utf8", "usascii", "ascii", "iso88591", "latin1", "iso885915", "windows1252", "cp1252"}


def splits(encoding: str | None) -> bool:
    """Whether lines and quotes can be found in the bytes of the encoding."""
    return encoding is None or encoding.lower().replace("-", "").replace("_", "") in ASCII_BYTES


def file_order(df: DataFrame, col: str = ROW) -> DataFrame:
    """Add the place of each row of a file scan: file, block, row in the task. Spark
    packs files into tasks by size, so the row number alone isn't the file order."""
    return df.withColumn(col, F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def inspect_files(spark: SparkSession, paths) -> DataFrame:
    """``(file_path, encoding, first_line)`` per file: UTF-8 when every line is valid."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    t = file_order(spark.read.text(paths))
    return t.groupBy(F.col(f"{ROW}.file").alias("file_path")).agg(
        F.when(F.bool_and(F.is_valid_utf8("value")), F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1")).alias("encoding"),
        F.min_by("value", ROW).alias("first_line"))


def detect_encodings(spark: SparkSession, paths) -> DataFrame:
    """``(file_path, encoding)`` per file."""
    return inspect_files(spark, paths).select("file_path", "encoding")


def read_csv_any_encoding(spark: SparkSession, path, encoding: str | None = None,
                          schema: StructType | str | None = None, header: bool = True,
                          order_col: str | None = None) -> DataFrame:
    """Read CSV file(s) as text columns, each file decoded as UTF-8 or Latin-1.

    ``path`` may be a file, a folder or a list. A first pass finds each file's encoding and
    header (one row per file: metadata, not data) and the quote state of each split; a second
    one cuts and parses the records of all files in one scan. Files of different headers are united by
    column name (by position without a header). ``encoding`` fixes the encoding.
    ``order_col`` adds the place of each row in its file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if splits(encoding):
        df = read_csv_split(spark, paths, encoding, schema, header, order_col)
        if df is not None:
            return _cleaned(df)
    groups: dict = {}
    for row in inspect_files(spark, paths).collect():   # one row per file
        key = (encoding or row["encoding"], row["first_line"] if header else None)
        groups.setdefault(key, []).append(row["file_path"])
    if not groups:   # empty files only: read as UTF-8 (header-only or nothing)
        groups = {(encoding or "UTF-8", None): paths}
    frames = []
    for (enc, _), files in sorted(groups.items(), key=repr):
        reader = spark.read.option("header", header).option("encoding", enc) \
            .option("mode", "PERMISSIVE").option("multiLine", True).option("escape", '"')
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
        frame = reader.csv(files)
        frames.append(file_order(frame, order_col) if order_col else frame)
    df = union_all(frames) if header else reduce(lambda a, b: a.union(b), frames)
    return _cleaned(df)


def _cleaned(df: DataFrame) -> DataFrame:
    """Whitespace-only and NA-token cells become NULL in every text column."""
    types = dict(df.dtypes)
    return df.select(*[clean_text(F.col(f"`{c}`")).alias(c) if types[c] == "string"
                       else F.col(f"`{c}`") for c in df.columns])


def read_source(spark: SparkSession, path: str, fmt: str = "csv", encoding: str | None = None,
                order_col: str | None = None) -> DataFrame:
    """Read a raw source by format; CSV columns arrive as text."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return file_order(df, order_col) if order_col else df
    if fmt == "csv":
        return read_csv_any_encoding(spark, path, encoding, order_col=order_col)
    raise ValueError(f"unknown format {fmt}")


def files_under(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``path`` of each file below a folder (or the file itself) that matches the
    pattern, listed by Spark's own file system, without reading the files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
