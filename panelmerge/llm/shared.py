"""Helpers that the corpus operators share: stored tables, words, hashing."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.session import ensure_checkpoint_dir

#: The ASCII whitespace that separates words: [\x20\x09-\x0D]. ``bytes.split()``
#: and ``bytes.strip()`` without arguments use the same six bytes.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

U64 = np.uint64
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, tag: str, free_shuffles: bool = False, codec: str | None = None, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of redoing
    the work. The folder is the one the cluster names in
    ``spark.checkpoint.dir``; the files stay, as results are read lazily.
    ``free_shuffles``: the write's own shuffle files go when it has ended. ``codec``: of the files.
    ``rows_per_file``: at most, 0 for no limit.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true" if free_shuffles else before)
    try:
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path, compression=codec)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def raw(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def word_runs(text: bytes, size: int = 1 << 20):
    """Words of a text in runs of about ``size`` bytes, so a huge text is never
    held as one list of words."""
    start, end = 0, len(text)
    while start < end:
        stop = start + size
        if stop < end:
            while stop < end and text[stop] not in b" \t\n\x0b\x0c\r":
                stop += 1
        yield text[start:stop].split()
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scrambles all bits (splitmix64's finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
