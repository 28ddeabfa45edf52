"""A new release of some sources: only the key buckets that changed are merged again.

The store is a folder of immutable Parquet files, committed by a manifest:

* ``sources/release=<n>/source=<label>/bucket=<b>``: the rows of a bucket, written by the release that changed it.
* ``panel/release=<n>/bucket=<b>``: the merged rows of a bucket.
* ``manifest/release=<n>``: the digest tree. Level 0 has a row per source and bucket (rows, digest, the release whose
  files hold it), level k a row per ``fanout ** k`` buckets, the highest a root per source with its schema.

A digest is a pair of sums of row hashes, so it doesn't depend on the order or place of rows, a node is the sum of its
children, and repeated rows count. The manifest is written last: a run that dies before that leaves the former release
in force, and a rerun overwrites its leftovers. The driver sees the changed buckets' numbers, at most ``buckets``.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelmerge.operators.merge import merge_panel

SOURCE, BUCKET, RELEASE = "source", "bucket", "release"
_NODE = [SOURCE, "level", "node"]
_DIGEST = ["rows", "d1", "d2"]
_HEAD = "source string, level int, node int, buckets int, fanout int, schema string"


def bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, by) -> DataFrame:
    """rows, d1, d2 by ``by``: sums of two hashes of all other columns. Hashes skip nulls, so which are null is hashed too."""
    cols = sorted(c for c in df.columns if c not in set(by))
    nulls = [F.isnull(c) for c in cols]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cols, *nulls).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"d{seed}") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)


def digest_tree(leaves: DataFrame, buckets: int, fanout: int) -> DataFrame:
    """source, level, node and digest of every node over ``leaves`` (source, bucket, digest): one aggregation."""
    top = height(buckets, fanout)
    nodes = F.transform(F.sequence(F.lit(0), F.lit(top)),
                        lambda k: F.struct(k.alias("level"), F.floor(F.col(BUCKET) / F.pow(F.lit(float(fanout)), k)).cast("int").alias("node")))
    return leaves.select(SOURCE, *_DIGEST, F.inline(nodes)).groupBy(*_NODE).agg(
        F.sum("rows").alias("rows"), *(F.sum(d).cast("decimal(38,0)").alias(d) for d in ("d1", "d2")))


def height(buckets: int, fanout: int) -> int:
    levels, width = 0, 1
    while width < buckets:
        levels, width = levels + 1, width * fanout
    return levels


def changed_buckets(old: DataFrame, new: DataFrame, buckets: int, fanout: int) -> DataFrame:
    """source and bucket where the trees differ, from the roots down: a level is compared below differing parents only."""
    both = old.select(*_NODE, *_DIGEST).unionByName(new.select(*_NODE, *_DIGEST))
    parents = None
    for level in range(height(buckets, fanout), -1, -1):
        nodes = both.filter(F.col("level") == level)
        if parents is not None:
            nodes = nodes.withColumn("parent", F.floor(F.col("node") / fanout).cast("int")).join(
                parents.withColumnRenamed("node", "parent"), [SOURCE, "parent"], "left_semi")
        # A node of one tree only, or of two digests. A level names the one above once, so the plan grows by a join a level.
        digest = F.struct(*_DIGEST)
        parents = nodes.groupBy(SOURCE, "node").agg(F.count(F.lit(1)).alias("n"), F.min(digest).alias("lo"), F.max(digest).alias("hi")) \
            .filter("n = 1 OR lo <> hi").select(SOURCE, "node")
    return parents.withColumnRenamed("node", BUCKET)


def latest_release(spark: SparkSession, folder: str) -> int | None:
    """The release in force; None for a folder without a manifest."""
    try:
        manifests = spark.read.schema(f"level int, {RELEASE} int").parquet(f"{folder}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return manifests.agg(F.max(RELEASE).alias(RELEASE)).collect()[0][RELEASE]


def apply_release(spark: SparkSession, folder: str, sources: dict[str, DataFrame], keys, buckets: int = 1024, fanout: int = 32,
                  name_col: str | None = None, on_duplicate: str = "error") -> int:
    """Take in new data of ``sources`` (label -> all rows of that source); returns the release's number.

    Sources of the store that aren't given stay as they are; the order of sources is that in which they first came. A
    source without rows keeps its columns. Columns that sources share are of one type. ``buckets`` and ``fanout`` are the store's own and mustn't change.
    Rows with a null key are no panel cell and aren't stored."""
    if not sources:
        raise ValueError("a release brings at least one source")
    before = latest_release(spark, folder)
    number = 0 if before is None else before + 1
    old = None if before is None else spark.read.parquet(f"{folder}/manifest/release={before}")
    schemas = {} if old is None else _schemas(old)
    if old is not None and _layout(old) != (buckets, fanout):
        raise ValueError(f"the store has (buckets, fanout) = {_layout(old)}")
    for label, df in sources.items():
        schemas[label] = df.schema

    def part(df: DataFrame, label: str) -> DataFrame:
        return df.na.drop(subset=list(keys)).select(F.lit(label).alias(SOURCE), bucket_of(keys, buckets).alias(BUCKET), "*")

    # Each source is digested over its own columns, so another source's new column changes nothing.
    parts = {label: part(df, label) for label, df in sources.items()}
    leaves = reduce(DataFrame.unionByName, (digests(df, [SOURCE, BUCKET]) for df in parts.values()))
    tree = digest_tree(leaves, buckets, fanout)
    # Kept in the folder: the comparison, the write and the manifest read it.
    tree.write.mode("overwrite").parquet(f"{folder}/trees/release={number}")
    tree = spark.read.schema(tree.schema).parquet(f"{folder}/trees/release={number}")
    given = F.col(SOURCE).isin(list(sources))
    nothing = tree.limit(0) if old is None else old.filter(given).select(*tree.columns)
    rows = changed_buckets(nothing, tree, buckets, fanout).groupBy(SOURCE).agg(F.collect_set(BUCKET).alias("b")).collect()
    changed = {r[SOURCE]: sorted(r["b"]) for r in rows}
    touched = sorted({b for bs in changed.values() for b in bs})

    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     (df.filter(F.col(BUCKET).isin(changed.get(label, []))) for label, df in parts.items()))
    # Rebalanced, not hashed: a bucket with a hot key is cut into several files.
    stacked.hint("rebalance", SOURCE, BUCKET).write.mode("overwrite").partitionBy(SOURCE, BUCKET).parquet(f"{folder}/sources/release={number}")

    fresh = F.lit(False)
    for label, bs in changed.items():
        fresh = fresh | ((F.col(SOURCE) == label) & F.col("node").isin(bs))
    kept = None if old is None else old.select(*_NODE, F.col("written").alias("w"))
    manifest = tree if old is None else tree.unionByName(old.filter(~given & (F.col("level") >= 0)).select(*tree.columns))
    manifest = manifest.withColumn("w", F.lit(None).cast("int")) if kept is None else manifest.join(kept, _NODE, "left")
    manifest = manifest.select(*_NODE, *_DIGEST, F.when((F.col("level") == 0) & given & fresh, number).otherwise(F.col("w")).alias("written"))
    # A row a source with its place and schema; empty sources have no other. A row a merged bucket: the release of its panel files.
    heads = [(label, -1, i, buckets, fanout, schema.json()) for i, (label, schema) in enumerate(schemas.items())]
    merged_in = spark.createDataFrame([(b, number) for b in touched], "node int, written int")
    if old is not None:
        merged_in = merged_in.unionByName(old.filter("level = -2").select("node", "written").filter(~F.col("node").isin(touched)))
    manifest = manifest.unionByName(spark.createDataFrame(heads, _HEAD), allowMissingColumns=True).unionByName(
        merged_in.withColumn("level", F.lit(-2)), allowMissingColumns=True)

    # The manifest is complete before the merge reads by it, and is in force only under its final name.
    draft = f"{folder}/drafts/release={number}"
    manifest.write.mode("overwrite").parquet(draft)
    manifest = spark.read.schema(manifest.schema).parquet(draft)
    merged = merge_panel([source_rows(spark, folder, manifest, label, touched) for label in schemas], list(keys),
                         name_col=name_col, on_duplicate=on_duplicate)
    merged.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET) \
        .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{folder}/panel/release={number}")
    panel_head = spark.createDataFrame([(None, -3, 0, buckets, fanout, merged.schema.json())], _HEAD)
    manifest.unionByName(panel_head, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/release={number}")
    return number


def _schemas(manifest: DataFrame) -> dict[str, StructType]:
    rows = manifest.filter("level = -1").orderBy("node").select(SOURCE, "schema").collect()
    return {r[SOURCE]: StructType.fromJson(json.loads(r["schema"])) for r in rows}


def _layout(manifest: DataFrame) -> tuple[int, int]:
    row = manifest.agg(F.max("buckets").alias("buckets"), F.max("fanout").alias("fanout")).collect()[0]
    return row["buckets"], row["fanout"]


def _files(written: DataFrame, within=None) -> dict[int, list[int]]:
    """Release -> buckets, of manifest rows; at most a number a bucket comes to the driver."""
    rows = written.groupBy("written").agg(F.collect_list("node").alias("b")).collect()
    wanted = None if within is None else set(within)
    found = {r["written"]: sorted(b for b in r["b"] if wanted is None or b in wanted) for r in rows}
    return {r: bs for r, bs in found.items() if bs}


def _read(spark: SparkSession, base: str, schema: StructType, files: dict[int, list[int]], places: list[StructField]) -> DataFrame:
    """The rows of the given buckets of each release: filters on partition columns, so no other folder's files are read."""
    if not files:
        return spark.createDataFrame([], schema)
    wanted = F.lit(False)
    for r, bs in files.items():
        wanted = wanted | ((F.col(RELEASE) == r) & F.col(BUCKET).isin(bs))
    full = StructType([*schema.fields, *places, StructField(RELEASE, IntegerType()), StructField(BUCKET, IntegerType())])
    return spark.read.schema(full).option("basePath", base).parquet(*(f"{base}/release={r}" for r in files)).filter(wanted)


def source_rows(spark: SparkSession, folder: str, manifest: DataFrame, label: str, within=None) -> DataFrame:
    """The rows of a source that are in force, of the buckets ``within`` (all if None)."""
    schema = _schemas(manifest)[label]
    files = _files(manifest.filter((F.col("level") == 0) & (F.col(SOURCE) == label)), within)
    df = _read(spark, f"{folder}/sources", schema, files, [StructField(SOURCE, StringType())])
    return (df.filter(F.col(SOURCE) == label) if files else df).select(*schema.names)


def current_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The merged panel of the release in force."""
    number = latest_release(spark, folder)
    if number is None:
        raise ValueError(f"no release in {folder}")
    manifest = spark.read.parquet(f"{folder}/manifest/release={number}")
    schema = StructType.fromJson(json.loads(manifest.filter("level = -3").select("schema").collect()[0]["schema"]))
    return _read(spark, f"{folder}/panel", schema, _files(manifest.filter("level = -2")), []).select(*schema.names)
