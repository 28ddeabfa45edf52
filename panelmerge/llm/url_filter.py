"""URL filter: logistic regression on hashed character n-grams of host and path.

A small table of labelled URLs trains the model; DataFrame functions only. The
whole training is one expression over one row: the labelled examples as dense
vectors, folded into the weights epoch by epoch. The weights (``BUCKETS``
doubles) then meet every URL as a one-row table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import LOWER, UPPER

BUCKETS = 2048
GRAMS = (3, 4, 5)
EPOCHS, RATE, PENALTY = 20, 1.0, 1e-4

# Words in hosts of unwanted sites, and of others.
UNWANTED = (
    "casino", "poker", "roulette", "betting", "bets", "jackpot", "lottery", "pills", "viagra", "pharmacy", "meds", "adult", "porn", "xxx",
    "escort", "cams", "payday", "loans", "prize", "winner", "spam", "linkfarm", "popads", "adclick", "tracker", "replica", "warez",
)
ORDINARY = (
    "library", "museum", "garden", "weather", "university", "school", "kitchen", "recipes", "travel", "history", "science", "physics", "letters",
    "painting", "football", "village", "council", "hospital", "church", "theatre", "orchestra", "railway", "harbour", "forest", "mountain",
    "river", "bakery", "carpenter", "bicycle", "journal", "newspaper", "gazette", "tribune", "archive", "institute", "research", "software",
    "handbook", "grammar", "dictionary", "astronomy", "chemistry", "geology", "fishing", "gardening", "knitting", "cinema", "gallery",
)
PREFIXES, LANGUAGES = ("", "www.", "blog.", "m."), ("en", "de", "fr", "es")
FORMS = ("{}-online", "my{}", "{}24", "best-{}s", "{}hub", "the{}")


def syllables(i: int) -> str:
    """A made-up name: most sites are called by words that no table holds."""
    onsets, vowels, codas = "b c ch d f g h k l m n p r s sh st t th tr v w".split(), "a e i o u ai ea ou".split(), ["", "n", "r", "", "s", "nd", "", "st", "l", "nt", "ng"]
    return "".join(onsets[(i * 5 + 8 * k) % 21] + vowels[(i * 3 + 5 * k + i // 8) % 8] + codas[(i + 4 * k + i // 11) % 11] for k in range(2 + i % 2))


def labelled_urls(made_up: int = 200) -> list[tuple[str, int]]:
    """The training table (1: to be blocked): every word in some hosts, and made-up names."""
    hosts = [(FORMS[(i + k) % len(FORMS)].format(w), 1) for i, w in enumerate(UNWANTED) for k in range(6)]
    hosts += [(FORMS[(i + k) % len(FORMS)].format(w), 0) for i, w in enumerate(ORDINARY) for k in range(4)] + [(syllables(i), 0) for i in range(made_up)]
    return [(f"{'https' if i % 3 else 'http'}://{PREFIXES[i % 4]}{name}.example.{('com', 'org', 'net')[i % 3]}/{LANGUAGES[(i // 3) % 4]}/{i * 7919 % 5003}", y)
            for i, (name, y) in enumerate(hosts)]


LABELLED = tuple(labelled_urls())
# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def url_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (after the first :// up to /, ?, # or end, A-Z lower-cased) and path
    (from there up to ?, # or end). A null url or one without ://: both empty."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return urls.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn(
        "path", F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0))


def _buckets(host: str, path: str) -> str:
    """SQL for the buckets of all n-grams of ``^host$path$``, with repeats; the two parts hash apart."""
    def grams(text: str, part: int) -> str:
        runs = ", ".join(
            f"transform(sequence(1, greatest(1, length({text}) - {n - 1})), i -> cast(pmod(xxhash64(substring({text}, i, {n}), {part}), {BUCKETS}) as int))"
            for n in GRAMS)
        return f"concat({runs})"

    return f"concat({grams(f'''concat('^', {host}, '$')''', 1)}, {grams(f'''concat({path}, '$')''', 2)})"


def train(spark: SparkSession, labelled=LABELLED, epochs: int = EPOCHS) -> DataFrame:
    """One row: weights, an array of BUCKETS + 1 doubles, the last being the bias.

    Stochastic gradient descent over the labelled URLs in hash order, epoch after
    epoch, on n-gram counts over the root of their sum."""
    rows = url_parts(spark.createDataFrame([(u, float(y)) for u, y in labelled], "url string, y double"))
    counted = rows.select("url", "y", F.explode(F.expr(_buckets("host", "path"))).alias("bucket")).groupBy("url", "y", "bucket").agg(F.count("*").cast("double").alias("n"))
    unit = counted.groupBy("url", "y").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("m"), F.sqrt(F.sum("n")).alias("norm"))
    dense = unit.select("url", "y", F.expr(f"concat(transform(sequence(0, {BUCKETS - 1}), b -> coalesce(element_at(m, b) / norm, 0D)), array(1D))").alias("x"))
    # The labelled table is small by contract: all of it is one array.
    one = dense.agg(F.sort_array(F.collect_list(F.struct(F.xxhash64("url").alias("at"), "y", "x"))).alias("examples"))
    dot = "aggregate(zip_with(w, e.x, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    step = (  # the inner fold over one value binds the gradient, so it is computed once
        f"aggregate(array(1D / (1D + exp(-{dot})) - e.y), w, (v, g) -> zip_with(v, e.x, (a, b) -> a - {RATE}D * (g * b + {PENALTY!r}D * a)))")
    return one.select(F.expr(
        f"aggregate(flatten(array_repeat(examples, {epochs})), array_repeat(0D, {BUCKETS + 1}), (w, e) -> {step})").alias("weights"))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """Rule (host + path) and its verdict for each url, null where none fits: it fits its
    host and all subdomains if the path starts with the rule's; the longest wins."""
    rule = verdict = None
    for host, path, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)) if rule is None else rule.when(fits, F.lit(host + path))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    return rule, verdict


def judge_urls(pages: DataFrame, labelled=LABELLED, rules=RULES) -> DataFrame:
    """A verdict on every row of ``pages`` (page_id and url; other columns are ignored):
    page_id, host, path, rule, score (the model's probability of a block), verdict.

    A fitting rule decides, else the model (block from 0.5). A null url, or one without
    ://, has empty host and path and is scored as such. Repeated rows get equal verdicts;
    an empty table gives an empty result.
    """
    weights = train(pages.sparkSession, labelled)
    rule, verdict = rule_columns(rules)
    parts = url_parts(pages.select("page_id", "url"))
    grams = parts.withColumn("grams", F.expr(_buckets("host", "path")))
    scored = grams.crossJoin(F.broadcast(weights)).withColumn("z", F.expr(  # one row of weights
        "aggregate(grams, 0D, (s, b) -> s + element_at(weights, b + 1)) / sqrt(size(grams)) + element_at(weights, -1)"))
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"), (1 / (1 + F.exp(-F.col("z")))).alias("score")
    ).withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))))
