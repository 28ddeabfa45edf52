"""Paged JSON payloads ``[meta, [record, ...]]`` -> rows.

Each payload document is parsed independently (one row per document), so
many payload files are flattened in parallel; nothing is gathered.

``flatten_payload`` parses by a fixed record schema. ``explode_records`` parses to VARIANT:
records whose fields are unknown, missing or of another type survive, and what the caller
doesn't name stays in ``extra``. A page beyond one task's memory should come as JSON Lines, a record
a line (``read_record_lines``): such files split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

RECORD = StructType([
    StructField("countryiso3code", StringType()),
    StructField("country", StructType([StructField("value", StringType())])),
    StructField("date", StringType()),
    StructField("value", DoubleType()),
])


def read_payloads(spark: SparkSession, paths) -> DataFrame:
    """One row per payload file (``value`` = whole document)."""
    return spark.read.option("wholetext", True).text(paths)


def read_record_lines(spark: SparkSession, paths) -> DataFrame:
    """One row per line of JSON Lines files (``value``); the files split."""
    return spark.read.text(paths).filter(F.trim("value") != "")


def explode_records(df: DataFrame, text_col: str = "value", path: str | None = "$[1]") -> DataFrame:
    """``record`` (VARIANT) of each element of the array at ``path`` of a JSON text, with the other
    columns of ``df`` and the element's place ``pos``. ``path`` None: the text is one record. Text
    that isn't JSON, or has no array there, gives no row."""
    parsed = F.try_parse_json(text_col)
    rest = [c for c in df.columns if c != text_col]
    if path is None:
        return df.select(*rest, F.lit(0).alias("pos"), parsed.alias("record")).filter("record IS NOT NULL")
    pages = df.select(*rest, F.try_variant_get(parsed, path, "variant").alias("__records")).filter("schema_of_variant(__records) LIKE 'ARRAY%'")
    cells = df.sparkSession.tvf.variant_explode(F.col("__records").outer())
    return pages.lateralJoin(cells.select("pos", F.col("value").alias("record"))).select(*rest, "pos", "record")


def record_columns(df: DataFrame, fields: dict[str, tuple[str, str]], record_col: str = "record") -> DataFrame:
    """Columns of VARIANT records: ``fields`` names each by (path, type). A field that is missing or
    can't be cast is null; ``extra`` is the record's other top-level fields as JSON (null: none)."""
    known = [path.removeprefix("$.").split(".")[0].split("[")[0] for path, _ in fields.values()]
    as_map = F.try_variant_get(record_col, "$", "map<string,variant>")
    extra = F.map_filter(as_map, lambda k, _: ~k.isin(*known))
    return df.select(
        *(c for c in df.columns if c != record_col), *(F.try_variant_get(record_col, path, kind).alias(name) for name, (path, kind) in fields.items()),
        F.when(F.size(extra) > 0, F.to_json(extra)).alias("extra"))


#: The indicator API's fields.
INDICATOR_FIELDS = {"iso3": ("$.countryiso3code", "string"), "country_name": ("$.country.value", "string"), "year": ("$.date", "string"), "value": ("$.value", "double")}


def flatten_records(df: DataFrame, text_col: str = "value", path: str | None = "$[1]") -> DataFrame:
    """Like ``flatten_payload``, by VARIANT, with ``extra``."""
    r = record_columns(explode_records(df, text_col, path), INDICATOR_FIELDS).filter("value IS NOT NULL")
    return r.select(F.nullif(F.trim("iso3"), F.lit("")).alias("iso3"), "country_name", F.trim("year").try_cast("int").alias("year"), "value", "extra")


def inferred_schema(df: DataFrame, record_col: str = "record") -> DataFrame:
    """One row: the least schema that all records fit, ``schema`` as text."""
    return df.agg(F.schema_of_variant_agg(record_col).alias("schema"))


def flatten_payload(df: DataFrame, text_col: str = "value", record_schema: StructType = RECORD,
                    code="countryiso3code", name="country.value", period="date", value="value") -> DataFrame:
    """Records of element 1 with a non-null value: ``(iso3, country_name,
    year, value)``; empty codes become NULL, the year becomes an int."""
    recs = F.from_json(F.get_json_object(F.col(text_col), "$[1]"), ArrayType(record_schema))
    r = df.select(F.explode(recs).alias("r")).filter(F.col(f"r.{value}").isNotNull())
    return r.select(
        F.nullif(F.trim(F.col(f"r.{code}")), F.lit("")).alias("iso3"),
        F.col(f"r.{name}").alias("country_name"),
        F.trim(F.col(f"r.{period}")).try_cast("int").alias("year"),
        F.col(f"r.{value}").alias("value"))
