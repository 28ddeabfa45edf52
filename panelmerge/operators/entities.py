"""Entity resolution: name -> code maps, corrections, relabelling, overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.functions.nulls import strip_ws
from panelmerge.operators.clean import dedup_first_agg, exclude_prefix
from panelmerge.operators.lookup import map_literal, replace_values


def build_name_map(ref: DataFrame, name_col: str, code_col: str, order_col: str,
                   aggregate_prefix: str | None = None) -> DataFrame:
    """``(name, code)``: first non-aggregate code per name under ``order_col``.

    Partial aggregation (min of an ``(order, code)`` struct) instead of a
    window, so a name with many rows is combined map-side.
    """
    df = ref.filter(F.col(code_col).isNotNull())
    if aggregate_prefix:
        df = exclude_prefix(df, code_col, aggregate_prefix)
    df = df.filter(F.col(name_col).isNotNull())
    first = dedup_first_agg(df, [name_col], order_col, [code_col])
    return first.select(F.col(name_col).alias("name"), F.col(code_col).alias("code"))


def apply_corrections(df: DataFrame, col: str, rules: dict, out: str | None = None) -> DataFrame:
    """Strip whitespace, then replace whole values by the rule table."""
    return df.withColumn(out or col, replace_values(strip_ws(F.col(col)), rules))


def correction_stats(df: DataFrame, col: str, rules: dict) -> DataFrame:
    """One row: rows whose stripped value is a rule variant, and total rows.

    The count is taken after the strip, so padded variants are counted too.
    """
    hit = strip_ws(F.col(col)).isin(list(rules)) if rules else F.lit(False)
    return df.agg(F.count_if(hit).alias("rows_corrected"), F.count(F.lit(1)).alias("rows_total"))


def resolve(df: DataFrame, name_col: str, name_map: DataFrame, code_col: str = "code") -> DataFrame:
    """Attach the code for ``name_col``; unknown names get NULL."""
    m = name_map.select(F.col("name").alias("__nm"), F.col("code").alias(code_col))
    out = df.join(m, F.col(name_col) == F.col("__nm"), "left")
    return out.drop("__nm")


def _deletions(name, depth: int):
    """The name and all that is left of it by up to ``depth`` deletions."""
    out = F.array(name)
    for _ in range(depth):
        cut = F.flatten(F.transform(out, lambda s: F.transform(
            F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>")),
            lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))))
        out = F.array_distinct(F.concat(out, cut))
    return out


def propose_names(unknown: DataFrame, known: DataFrame, distance: int = 2, gram: int = 2) -> DataFrame:
    """Known names within an edit distance of names that didn't resolve: ``(name, candidate,
    code, distance)``, all of them. ``unknown``: name; ``known``: name, code.

    A prefix filter finds the candidates: an edit changes ``gram`` grams of a padded name at most, so of the
    ``gram * distance + 1`` rarest grams of either name both share one. Names so short that they have no more
    grams meet by what deletions leave of them. The exact distance is checked on the candidates only.
    Null names have no candidates; repeated ones are one. Distances count characters.
    """
    prefix = gram * distance + 1
    short = prefix + distance   # a name with more characters has too many grams to need deletions

    def distinct(df, *more):
        return df.filter(F.col("name").isNotNull()).select("name", *more).distinct()

    def grams(names):
        padded = F.concat(F.lit("\x01" * (gram - 1)), F.col("name"), F.lit("\x02" * (gram - 1)))
        places = F.sequence(F.lit(1), F.length("name") + (gram - 1))
        each = names.select("name", F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(gram)))).alias("g")).groupBy("name", "g").agg(F.count("*").alias("n"))
        # The second "aa" of a name is another gram than the first.
        return each.select("name", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"), "g").select("name", F.concat("g", F.col("i").cast("string")).alias("g"))

    left, right = distinct(unknown), distinct(known, "code")
    every = left.select("name").union(right.select("name")).distinct()
    all_grams = grams(every)
    rarity = all_grams.groupBy("g").agg(F.count("*").alias("names"))
    # The grams of one name: some dozens.
    ranked = all_grams.join(rarity, "g").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("names", "g"))).alias("order"))
    keys = ranked.select("name", F.explode(F.transform(F.slice("order", 1, prefix), lambda x: x["g"])).alias("key"))
    rests = every.filter(F.length("name") <= short).select("name", F.explode(F.transform(_deletions(F.col("name"), distance), lambda s: F.concat(F.lit("\x03"), s))).alias("key"))
    keys = keys.union(rests)
    ours = keys.join(left, "name").select(F.col("name"), "key")
    theirs = keys.join(right.select("name").distinct(), "name").select(F.col("name").alias("candidate"), "key")
    pairs = ours.join(theirs, "key").filter(F.abs(F.length("name") - F.length("candidate")) <= distance).select("name", "candidate").distinct()
    near = pairs.withColumn("distance", F.levenshtein("name", "candidate", distance)).filter("distance >= 0")
    return near.join(right.withColumnRenamed("name", "candidate"), "candidate").select("name", "candidate", "code", "distance")


def unresolved(df: DataFrame, name_col: str, code_col: str, order_col: str, n: int | None = None) -> DataFrame:
    """Unresolved names: ``(name, first_seen, rows, unresolved_rows)``.

    ``unresolved_rows`` is the total over all names; ``n`` asks for the first
    names by first appearance only.
    """
    miss = df.filter(F.col(code_col).isNull())
    per = miss.groupBy(F.col(name_col).alias("name")).agg(
        F.min(order_col).alias("first_seen"), F.count(F.lit(1)).alias("rows"))
    total = miss.agg(F.count(F.lit(1)).alias("unresolved_rows"))
    out = per.crossJoin(F.broadcast(total)).orderBy("first_seen", "name")
    return out if n is None else out.limit(n)


def canonical_map(ref: DataFrame, code_col: str, name_col: str, order_col: str) -> DataFrame:
    """``(code, name)``: first name per code in the (already filtered) reference."""
    df = ref.filter(F.col(code_col).isNotNull())
    first = dedup_first_agg(df, [code_col], order_col, [name_col])
    return first.select(F.col(code_col).alias("__code"), F.col(name_col).alias("__canon"))


def canonical_name(df: DataFrame, code_col: str, name_col: str, cmap: DataFrame,
                   drop_unlabelled: bool = False) -> DataFrame:
    """Overwrite ``name_col`` from the canonical code -> name map.

    Every row is relabelled (no backfill). With ``drop_unlabelled`` rows whose
    code has no canonical name are removed (inner join).
    """
    base = df.drop(name_col) if name_col in df.columns else df
    how = "inner" if drop_unlabelled else "left"
    out = base.join(cmap, F.col(code_col) == F.col("__code"), how)
    out = out.withColumnRenamed("__canon", name_col).drop("__code")
    cols = [c for c in df.columns] if name_col in df.columns else df.columns + [name_col]
    return out.select(*cols)


def unlabelled_count(df: DataFrame, code_col: str, cmap: DataFrame) -> DataFrame:
    """One row: rows that ``canonical_name(..., drop_unlabelled=True)`` removes."""
    gone = df.join(cmap, F.col(code_col) == F.col("__code"), "left_anti")
    return gone.agg(F.count(F.lit(1)).alias("rows_dropped"))


def override_labels(df: DataFrame, code_col: str, name_col: str, overrides: dict) -> DataFrame:
    """Code-keyed label overrides, applied last (empty dict = no-op)."""
    if not overrides:
        return df
    return df.withColumn(name_col, replace_values_by_key(code_col, name_col, overrides))


def replace_values_by_key(code_col: str, name_col: str, overrides: dict):
    return F.coalesce(F.try_element_at(map_literal(overrides), F.col(code_col)), F.col(name_col))


def override_report(spark: SparkSession, df: DataFrame, code_col: str, overrides: dict) -> DataFrame:
    """Per override rule: rows touched and ``applied`` / ``not found``."""
    rules = spark.createDataFrame(list(overrides.items()), "code string, label string")
    counts = (df.filter(F.col(code_col).isin(list(overrides)))
              .groupBy(F.col(code_col).alias("code")).agg(F.count(F.lit(1)).alias("rows_touched")))
    out = rules.join(counts, "code", "left")   # rules: a literal, one row per rule
    touched = F.coalesce(F.col("rows_touched"), F.lit(0)).cast("long")
    return out.select("code", "label", touched.alias("rows_touched"),
                      F.when(touched > 0, "applied").otherwise("not found").alias("status"))


def verify_overrides(df: DataFrame, code_col: str, name_col: str, codes) -> DataFrame:
    """Distinct labels per overridden code, as a sorted '|'-joined string."""
    return (df.filter(F.col(code_col).isin(list(codes)))
            .groupBy(F.col(code_col).alias("code"))
            .agg(F.array_join(F.sort_array(F.collect_set(name_col)), "|").alias("labels")))


def rule_check(spark: SparkSession, rules: dict, name_map: DataFrame) -> DataFrame:
    """Correction rules whose canonical name is absent from the name map."""
    r = spark.createDataFrame(list(rules.items()), "variant string, canonical string")
    names = name_map.select(F.col("name").alias("__name")).distinct()
    return r.join(names, F.col("canonical") == F.col("__name"), "left_anti")
