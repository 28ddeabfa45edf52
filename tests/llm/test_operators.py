"""Each operator against a brute-force version, on rows with every awkward case."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward_rows import CLEAN, awkward, docs, nothing, words  # noqa: F401
from pyspark.sql import functions as F

from panelmerge.llm import (
    decontaminate, entropy_lm, line_dedup, linear, mixing, near_dedup, outliers, quality, sharding, toxicity, url_filter)
from panelmerge.llm.shared import id_remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ---- 1. decontamination

def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 100)))
        before = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            now = [i]
            for j, x in enumerate(text, 1):
                now.append(min(before[j - 1] + (c != x), before[j] + 1, now[-1] + 1))
            before = now
        assert decontaminate.best_match(item, text, 0, len(text))[0] == min(before)


def test_leaks_within_budget(spark, nothing):
    item = decontaminate.normalised(CLEAN)
    rng = random.Random(2)
    docs = []
    for edits in range(0, 12):
        text = list(item)
        for at in rng.sample(range(len(text)), edits):
            text[at] = "#" if text[at] == "q" else "q"
        docs.append((edits, words(50, edits) + " " + "".join(text).upper() + ", " + words(20, edits)))
    docs += [(50, None), (51, ""), (None, CLEAN), (52, words(400, 9)), (53, CLEAN)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, CLEAN), (2, CLEAN), (3, None), (4, "a"), (None, CLEAN), (5, words(30, 77))], "item_id long, text string")
    budget = int(len(item) * decontaminate.ERRORS)
    assert budget >= 5
    # One item in a block: all blocks are matched.
    for chars in (1, 1_000_000):
        got = rows(decontaminate.find_leaks(df, items, block_chars=chars), "doc_id", "item_id", "distance")
        want = [(d, i, d) for d in range(budget + 1) for i in (1, 2)] + [(d, i, 0) for d in (53, None) for i in (1, 2)]
        assert got == sorted(want, key=repr)
    assert rows(decontaminate.drop_leaks(df, items), "doc_id") == sorted([(d,) for d in range(budget + 1, 12)] + [(50,), (51,), (52,)], key=repr)
    assert decontaminate.find_leaks(nothing, items).count() == 0
    assert decontaminate.find_leaks(df, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(df, items.limit(0)).count() == len(docs)


def test_short_items_and_items_without_an_id(spark):
    """Short items are found on whole words, within their budget; drop_leaks needs no id."""
    def brute(item, text):
        starts = [i for i in range(len(text)) if text[i] != " " and (i == 0 or text[i - 1] == " ")]
        ends = {j for j in range(1, len(text) + 1) if text[j - 1] != " " and (j == len(text) or text[j] == " ")}
        best = len(item) + 1
        for s in starts:
            before = list(range(len(item) + 1))
            for j in range(s + 1, len(text) + 1):
                now = [j - s]
                for i, c in enumerate(item, 1):
                    now.append(min(before[i - 1] + (c != text[j - 1]), before[i] + 1, now[-1] + 1))
                before = now
                best = min(best, before[-1]) if j in ends else best
        return best

    rng = random.Random(5)
    def some(k):
        return " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(k))
    items = [(i, some(rng.randint(1, 9))[:39].strip()) for i in range(60)]
    items = [(i, t) for i, t in items if len(t) >= 2]
    texts = [some(rng.randint(0, 30)) for _ in range(60)]
    for i, (_, t) in enumerate(items):  # the item with an edit, or grown into a longer word
        at = rng.randrange(len(t))
        texts.append(f"{some(3)} {t[:at]}{rng.choice(['x', 'b', ''])}{t[at + rng.randint(0, 1):]}{'c' * (i % 2)} {some(3)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = [decontaminate.normalised(t) for t in texts]
    want = [(d, i, n) for d, text in enumerate(plain) for i, item in items if (n := brute(item, text)) <= int(len(item) * decontaminate.ERRORS)]
    assert {n for *_, n in want} >= {0, 1, 2}
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got, "doc_id", "item_id", "distance") == sorted(want, key=repr)
    nameless = spark.createDataFrame([(None, "42 Main Road"), (None, CLEAN)], "item_id long, text string")
    held = spark.createDataFrame([(1, "at 42, main road."), (2, "at 142 main roads"), (3, "so: " + CLEAN), (4, "none")], "doc_id long, text string")
    assert rows(decontaminate.drop_leaks(held, nameless), "doc_id") == [(2,), (4,)]


# ---- 2. line de-duplication

def test_leaks_in_texts_without_blanks_and_long_texts(spark, monkeypatch):
    """Scripts without blanks, texts over many slices and segments, an item in many places,
    a law that doesn't hang on the item's length, extra columns of the scan's names."""
    item = words(40, 3)
    assert 200 < len(item)
    held = [(1, "我知道中国的首都是北京。"), (2, "中国的首都不是上海"), (3, f"{words(4000, 1)} {item} {words(4000, 2)}"), (4, f"x{item}x"),
            (5, f"{item} " * 40), (6, f"{words(30, 5)} {item[:90]}q{item[91:]} {words(30, 6)}"), (7, None)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in held], "doc_id long, text string, start int, key string")
    items = spark.createDataFrame([(10, "中国的首都是北京"), (11, item)], "item_id long, text string")
    want = [(1, 10, 0), (3, 11, 0), (4, 11, 2), (5, 11, 0), (6, 11, 1)]
    for small in (False, True):
        if small:
            monkeypatch.setattr(decontaminate, "SEGMENT", 300)
        found = decontaminate.find_leaks(docs, items)
        assert rows(found, "doc_id", "item_id", "distance") == want
    at = {r.doc_id: r for r in found.collect()}
    text = decontaminate.normalised(held[2][1])
    assert text[at[3].start: at[3].end] == item and at[5].start == 0
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns and rows(kept, "doc_id") == [(2,), (7,)]


def test_hits_are_all_places_of_a_piece(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(decontaminate, "SLICE", 64)
    monkeypatch.setattr(decontaminate, "_POWERS", [])
    rng = random.Random(9)
    text = "".join(rng.choice("abé") for _ in range(1000))
    sought = sorted({text[i: i + n] for i, n in ((5, 3), (60, 7), (63, 16), (985, 15))} | {"zzz"})
    table = pa.table({"size": pa.array([len(p) for p in sought], pa.int32()), "hash": [decontaminate.piece_hash(p) for p in sought],
                      "before": pa.array([1] * len(sought), pa.int32()), "behind": pa.array([20] * len(sought), pa.int32())})
    places, sizes, *_ = decontaminate.Finder(table).hits(text)
    assert list(zip(places, sizes)) == sorted((i, len(p)) for p in sought for i in range(1000) if text.startswith(p, i))


def brute_lines(data, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc, text in data:
        for line in (text or "").split("\n"):
            key = lower(line.strip(strip))
            if len(key) >= min_chars and doc is not None:
                holders[key].add(doc)
    out = []
    for doc, text in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[k := lower(x.strip(strip))]) < min_docs or doc == max(holders[k])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(docs, nothing, spark, monkeypatch):
    data = [(r[0], r[1]) for r in awkward()]
    columns = ("doc_id", "n_lines", "n_dropped", "text")
    assert rows(line_dedup.dedup_lines(docs), *columns) == brute_lines(data)
    assert sum(r[2] for r in brute_lines(data)) > 2
    # Every line by the shards, and every repeated line locally.
    for heavy in (1, 10**9):
        monkeypatch.setattr(line_dedup, "HEAVY", heavy)
        assert rows(line_dedup.dedup_lines(docs), *columns) == brute_lines(data)
    assert rows(line_dedup.dedup_lines(nothing), *columns) == []


def test_lines_of_an_id_that_many_texts_share(spark):
    data = [(7 if i % 3 else None, "\n".join(f"line {(i + j) % 50} is long enough to count" for j in range(4))) for i in range(300)]
    data += [(1000 + i % 4, f"line {i} is long enough to count\nown {i}") for i in range(60)] + [(7, data[1][1])] * 50
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(line_dedup.dedup_lines(df), "doc_id", "n_lines", "n_dropped", "text") == brute_lines(data)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(3)
    h, f = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(-2**63, 2**63 - 1, 5000)
    h[:100] = h[0]  # equal first halves still have slots of their own
    index = line_dedup.PerfectHash.build(h, f)
    assert sorted(index.slots(h, f)) == list(range(5000))
    n, last = np.full(5000, 5), np.arange(5000)
    shard = line_dedup.LineIndex(*line_dedup.LineIndex.arrays(h, f, n, last))
    everyone = np.ones(5000, bool)
    assert shard.dropped(h, f, last + 1, everyone, 3).all() and not shard.dropped(h, f, last, everyone, 3).any()
    assert not shard.dropped(h ^ 1, f ^ 1, last + 1, everyone, 3).any()


# ---- 3. outliers

def test_base_statistics(docs):
    want = []
    for doc, text, *_ in awkward():
        w = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        times, covered = Counter(windows), set()
        for i, x in enumerate(windows):
            if times[x] > 1:
                covered.update(range(i, i + 8))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want.append((doc, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(outliers.reject_outliers(docs), *names) == sorted(want, key=repr)


def test_chi_square():
    assert outliers.chi2_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)
    assert outliers.chi2_cdf(12.5916, 6) == pytest.approx(0.95, abs=1e-5)


def test_mcd_ignores_outliers():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, outliers.P))
    x[:80] += 30
    mean, _ = outliers.mcd(x)
    assert np.abs(mean).max() < 0.5


def test_outliers_by_group(spark, nothing):
    rng = random.Random(5)
    data = []
    for i in range(300):
        w = [rng.choice(["alpha", "beta", "gamma", "delta", "house", "garden"]) + str(rng.randint(0, 400)) for _ in range(rng.randint(60, 200))]
        if i >= 280:
            w = [x + "$$&&**" for x in w]
        data.append((i, " ".join(w), "en", "a" if i % 20 else None))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in outliers.reject_outliers(df).filter("kept").collect()}
    assert kept == set(range(280))
    assert outliers.reject_outliers(nothing).count() == 0
    assert outliers.reject_outliers(df.withColumn("text", F.lit("few words"))).filter("kept").count() == 0


def test_repeated_rows_spread_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(outliers, "CHUNK", 50)
    rng = random.Random(14)
    word = ["alpha", "beta", "gamma", "delta", "house", "garden"]
    data = [(i, " ".join(rng.choice(word) + str(rng.randint(0, 400)) for _ in range(rng.randint(60, 200))), "en", "a") for i in range(200)]
    data += [(None, data[0][1], "en", "a")] * 200
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    stats = outliers.base_stats(df).select(F.lit("g").alias("group"), *(F.expr(f"cast({sql} as double)").alias(c) for c, (sql, _) in outliers.FEATURES.items()))
    sizes = spark.createDataFrame([("g", 8)], "group string, chunks long")
    dealt = [r[0] for r in outliers.chunked(stats, sizes).groupBy("chunk").agg(F.sum("copies")).select("sum(copies)").collect()]
    assert sum(dealt) == 400 and max(dealt) < 100 and len(dealt) == 8
    assert outliers.reject_outliers(df).filter("kept").count() == 400


def test_outliers_do_not_follow_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(outliers, "CHUNK", 40)
    rng = random.Random(15)
    data = []
    for i in range(300):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(25, 300))]
        marks = rng.choice([0, 0, 0, 1, 3, 40])
        data.append((i, " ".join(w + ["#"] * marks), "en", rng.choice(["a", "a", "b", None])))
    data += [(1000 + i, data[5][1], "en", "a") for i in range(60)]  # equal vectors
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    first = {r.doc_id: r for r in outliers.reject_outliers(df.repartition(1), tail=1e-2).collect()}
    other = {r.doc_id: r for r in outliers.reject_outliers(df.repartition(7, "text").sortWithinPartitions(F.desc("doc_id")), tail=1e-2).collect()}
    assert len(first) == 360 and 0 < sum(not r.kept for r in first.values()) < 200
    for i, r in first.items():
        assert r.kept == other[i].kept
        assert r.distance == other[i].distance is None if r.base_failed else r.distance == pytest.approx(other[i].distance, rel=1e-9)


def test_estimates_equal_plain_mcd(spark, monkeypatch):
    """One chunk, no further rounds: the plain estimate; a small group leans on the common one."""
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(200, outliers.P)), rng.normal(size=(10, outliers.P)) + 2
    data = [("g", *map(float, r)) for r in x] + [("h", *map(float, r)) for r in y]
    df = spark.createDataFrame(data, ["group", *outliers.NAMES])
    df = df.unionByName(df.withColumn("group", F.lit("")))
    state = outliers.robust_estimates(df, rounds=0)
    got = {r.group: r for r in state.collect()}
    for name, rows_ in (("g", x), ("h", y), ("", np.vstack([x, y]))):
        mean, cov = outliers.mcd(rows_)
        cov = cov - outliers.FLOOR
        assert got[name].rows == len(rows_)
        assert np.allclose([got[name][f"m{i}"] for i in range(outliers.P)], mean)
        assert np.allclose([got[name][f"c{i}_{j}"] for i, j in outliers.PAIRS], [cov[i, j] for i, j in outliers.PAIRS])
    mixed = {r.group: r for r in outliers.shrunk(state, "").collect()}
    w = 10 / (10 + outliers.PRIOR_ROWS)
    assert set(mixed) == {"g", "h"}
    assert mixed["h"].m0 == pytest.approx(w * got["h"].m0 + (1 - w) * got[""].m0)
    gap = got["h"].m0 - got[""].m0
    assert mixed["h"].c0_0 == pytest.approx(w * got["h"].c0_0 + (1 - w) * got[""].c0_0 + w * (1 - w) * gap * gap)


# ---- 4. sharding

def law_of_rows(placed, shards=8):
    by = defaultdict(list)
    for shard, slot in placed:
        by[shard].append(slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_sharding(docs, nothing, spark):
    got = sharding.assign_shards(docs)
    data = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in awkward()]
    assert rows(got, "doc_id", "size", "text_crc32") == sorted(data, key=repr)
    law_of_rows([(r.shard, r.slot) for r in got.collect()])
    assert sharding.assign_shards(nothing).count() == 0
    # A key with a third of all rows; reruns agree; few keys leave home.
    many = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    first = sharding.assign_shards(many)
    law_of_rows([(r.shard, r.slot) for r in first.collect()])
    assert rows(first, "doc_id", "shard", "slot") == rows(sharding.assign_shards(many.repartition(7)), "doc_id", "shard", "slot")


def test_sharding_of_hot_keys_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 100)  # repeated rows over many runs
    data = [(7, f"text {i}") for i in range(1000)] + [(8, "the same row")] * 1000 + [(i, "t") for i in range(100, 1100)] + [(None, None)] * 7
    got = sharding.assign_shards(spark.createDataFrame(data, "doc_id long, text string"))
    law_of_rows([(r.shard, r.slot) for r in got.collect()])
    assert rows(got, "doc_id", "size", "text_crc32") == sorted(((d, len(t or "") + 1, zlib.crc32((t or "").encode())) for d, t in data), key=repr)


def test_ring_moves_little():
    points, owners = sharding.ring(8)
    more, new_owners = sharding.ring(9)
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 20_000)
    before, after = owners[sharding.arc_of(points, keys)], new_owners[sharding.arc_of(more, keys)]
    assert set(after[before != after]) == {8}  # without bounds, keys move to the new shard only
    arcs = Counter(sharding.arc_of(points, keys).tolist())
    for slack in (0.0, 0.1):
        caps = sharding.capacities(20_000, 8, slack)
        ranges = sharding.place(dict(arcs), owners, caps)
        assert sum(b - a for _, a, b, *_ in ranges) == 20_000
        loads = Counter()
        for arc, a, b, s, base in ranges:
            assert base == loads[s]
            loads[s] += b - a
        assert all(loads[s] <= caps[s] for s in range(8))
        stay = sum(b - a for arc, a, b, s, _ in ranges if owners[arc] == s)
        assert stay > 0.8 * 20_000


# ---- 5. mixing

def shared_out(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        level = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if level[s] > 2 * sizes[s]]
        if not over:
            return target | level
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mixing(spark, docs, nothing):
    rng = random.Random(6)
    data = [(i, words(rng.randint(1, 60), i), rng.choice(["a", "b", "c", "B", None, "é", "a", "a"])) for i in range(2000)]
    data += [(5000, None, "a"), (5001, "", "empty"), (None, "x y", "b"), (1, "again again", "a"), (1, "again again", "a")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    plan = mixing.plan_mix(df).cache()
    sizes = Counter()
    for _, text, source in data:
        sizes[source] += len(WORD.findall(text or ""))
    want = shared_out(dict(sizes))
    taken = Counter()
    for r in plan.collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        assert (r.copies >= 1) == (r.shard_1 is not None) and (r.copies == 2) == (r.shard_2 is not None)
        taken[r.source] += r.taken * r.rows
    assert sum(r.rows for r in plan.collect()) == len(data)
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(3, 0.002 * target)
    assert rows(plan, "doc_id", "text_hash", "copies", "shard_1", "order_1") == rows(mixing.plan_mix(df.repartition(5)), "doc_id", "text_hash", "copies", "shard_1", "order_1")
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies * r.rows for r in plan.collect())
    assert mixing.plan_mix(docs).agg(F.sum("rows")).first()[0] == len(awkward())
    assert mixing.plan_mix(nothing).count() == 0 and mixing.mix_documents(nothing).count() == 0


def test_split_tree(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 7), (2, 0), (3, 101)], "sid int, blocks long")
    for shards in (1, 5, 8):
        leaves = mixing.split_tree(quotas, shards, seed=3)
        by_source, by_shard = Counter(), Counter()
        for r in leaves.collect():
            by_source[r.sid] += r.quota
            by_shard[r.shard] += r.quota
        assert by_source == {0: 40, 1: 7, 3: 101}
        assert len(by_shard) == shards and max(by_shard.values()) - min(by_shard.values()) <= math.ceil(math.log2(shards)) + 1
        dealt = mixing.deal_blocks(quotas, leaves, seed=3).collect()
        assert sorted((r.sid, r.block) for r in dealt) == [(s, b) for s, n in ((0, 40), (1, 7), (3, 101)) for b in range(n)]


# ---- 6. near duplicates

def brute_components(data, k, percent):
    sets = []
    for doc, text in data:
        w = WORD.findall(lower(text or ""))
        sets.append((doc, frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    live = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(live):
        for b, t in live[:i]:
            common = len(s & t)
            if 100 * common >= percent * (len(s) + len(t) - common) and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d) if s else d) for d, s in sets), key=repr)


def near_rows(n_groups=12, copies=14):
    rng = random.Random(8)
    out = []
    for g in range(n_groups):
        base = words(120, 1000 + g).split()
        for c in range(copies):  # a spread of edits: links, chains of links, and no links
            text = list(base)
            for at in rng.sample(range(120), rng.choice([0, 1, 2, 3, 6, 12, 30])):
                text[at] = f"edit{rng.randint(0, 10**6)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, k, percent, monkeypatch):
    data = near_rows()
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = brute_components(data, k, percent)
    assert len({r[2] for r in want}) < len(want)
    assert rows(near_dedup.near_duplicates(df, k, percent), "doc_id", "n_shingles", "component_id") == want
    monkeypatch.setattr(near_dedup, "BLOCK", 3)  # buckets over many block pairs
    assert rows(near_dedup.near_duplicates(df, k, percent), "doc_id", "n_shingles", "component_id") == want
    odd = [(r[0], r[1]) for r in awkward()]
    assert rows(near_dedup.near_duplicates(docs, k, percent), "doc_id", "n_shingles", "component_id") == brute_components(odd, k, percent)


def test_near_duplicates_of_an_id_that_many_texts_share(spark):
    """Every set is fetched once, not once for each row of its id."""
    data = [(1, words(40, i // 2) + (" end" if i % 2 else "")) for i in range(200)] + [(2 + i, words(40, 500)) for i in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    nodes = near_dedup.sketch(df, 5).groupBy("node", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.min_by("text_hash", "doc_id").alias("text_hash"))
    wanted = nodes.select(F.col("node").alias("w"), F.col("doc_id").alias("i"), F.col("text_hash").alias("t"))
    assert df.join(wanted, (F.col("i") == F.col("doc_id")) & (F.col("t") == F.xxhash64("text"))).count() == nodes.count() == 201
    assert near_dedup.sets_of(df, nodes, 5).count() == 201
    got = near_dedup.near_duplicates(df)
    assert got.filter("doc_id = 1").select("component_id").distinct().collect() == [(1,)]
    assert rows(got.filter("doc_id > 1"), "doc_id", "component_id") == [(2, 2), (3, 2), (4, 2)]


def test_keep_one(docs, nothing):
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids.count(13) == 1 and 0 in ids and 1 not in ids and 2 not in ids and ids.count(None) == 2 and {4, 5, 6} <= set(ids)
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_keep_one_without_ids_and_of_one_id(spark):
    """Copies and near copies count by their text, whatever their ids."""
    data = [(None, words(60, 1))] * 5 + [(None, words(60, 1) + " x"), (None, words(60, 2)), (8, words(60, 2) + " y")]
    data += [(9, words(60, 3) + end) for end in ("", " a", " b")] + [(9, words(60, 4)), (10, words(60, 4))] + [(None, "")] * 3 + [(None, None), (11, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = near_dedup.keep_one(df).collect()
    stems = sorted(((r.doc_id, " ".join((r.text or "").split()[:60])) for r in got), key=repr)
    want = [(None, words(60, 1)), (8, words(60, 2)), (9, words(60, 3)), (9, words(60, 4)), (None, ""), (None, ""), (11, "")]
    assert stems == sorted(want, key=repr)
    assert sorted(r.text is None for r in got) == [False] * 6 + [True]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60) if i != 30], "a binary, b binary")
    got = {r.node[0]: r.comp[0] for r in near_dedup.components(edges).collect()}
    assert len({got[i] for i in range(31)}) == 1 and len({got[i] for i in range(31, 61)}) == 1 and got[0] != got[31]


def test_circulant_signature():
    """Coordinate k is the minimum of the second permutation, shifted by k."""
    scatter, pieces = near_dedup.permutations()
    hashes = np.array([5, 2**40 + 17, 999], np.uint64)
    second = pieces[:, 0]
    for k in (0, 1, 124):
        want = min(int(second[(int(scatter[int(h) % near_dedup.UNIVERSE]) + k) % near_dedup.UNIVERSE]) for h in hashes)
        assert near_dedup.signature(hashes)[k] == want
    mixed = near_dedup.mix64(hashes + np.uint64(near_dedup.SEED))
    for k in (0, 1, 124):
        assert near_dedup.large_signature(hashes)[k] == near_dedup.mix64((mixed + np.uint64(k)) ^ np.uint64(0xA0761D6478BD642F)).min()


def test_very_large_sets_share_no_bucket_by_chance():
    rng = np.random.default_rng(4)
    def keys(hashes):
        found = near_dedup.bands_of(hashes, 80, near_dedup.LARGE)
        return set(near_dedup.band_keys(np.array([v for _, v in found], np.uint64), np.array([u for u, _ in found])).ravel().tolist())

    for size in (1 << 15, 1 << 21):
        a, b = (rng.integers(0, 1 << 64, size, np.uint64) for _ in range(2))
        assert not keys(a) & keys(b)
    # Links over the border of the universes: of sizes that differ by a fifth.
    small = near_dedup.LARGE * 9 // 10
    a = rng.integers(0, 1 << 64, small, np.uint64)
    more = np.concatenate([a, rng.integers(0, 1 << 64, small // 5, np.uint64)])
    assert len(a) < near_dedup.LARGE < len(more) and keys(a) & keys(more)


@pytest.mark.parametrize("large", [0, 115])
def test_near_duplicates_in_both_universes(spark, large, monkeypatch):
    monkeypatch.setattr(near_dedup, "LARGE", large)
    data = near_rows(8, 10)
    data += [(1000 + i, t[: len(t) * 9 // 10]) for i, t in data[:20]]  # sets on both sides of the border
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(near_dedup.near_duplicates(df, 3, 85), "doc_id", "n_shingles", "component_id") == brute_components(data, 3, 85)


# ---- 7. quality

def quality_rows():
    rng = random.Random(9)
    out = []
    for i in range(400):
        w = [rng.choice(["the", "of", "and", "house", "garden", "river", "stone", "walks", "a", "in"]) + ("" if rng.random() < 0.5 else rng.choice("abcdefgh")) for _ in range(80)]
        kind = i % 8
        w = [x.upper() + "!!" for x in w] if kind == 1 else [x + "$$$" for x in w] if kind == 2 else [x for x in w[:5] for _ in range(16)] if kind == 3 else w
        out.append((i, " ".join(w), kind not in (1, 2, 3)))
    return out


def test_quality(spark, docs, nothing):
    data = quality_rows()
    df = spark.createDataFrame(data, "doc_id long, text string, good boolean")
    got = {r.doc_id: r.kept for r in quality.score_quality(df).collect()}
    assert sum(got[d] == good for d, _, good in data) >= 0.97 * len(data)
    assert all(got[d] for d, _, good in data if good)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(got.values())
    assert quality.score_quality(docs).count() == len(awkward())
    assert quality.score_quality(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


def test_weak_label_model_finds_accuracies():
    rng = np.random.default_rng(10)
    y = rng.random(20_000) < 0.7
    right = (0.9, 0.8, 0.75, 0.95)
    votes = np.stack([np.where(rng.random(len(y)) < 0.2, 0, np.where((rng.random(len(y)) < r) == y, 2, 1)) for r in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, tables, share = quality.weak_label_model(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.03
    for j, r in enumerate(right):
        assert abs(tables[j, 1, 2] / (tables[j, 1, 1] + tables[j, 1, 2]) - r) < 0.04


# ---- 8. toxicity

def test_toxicity_held_out_and_neutral_mentions(spark, docs, nothing):
    rng = random.Random(11)
    neutral, toxic = [f"n{i}" for i in range(300)], ["idiot", "moron", "scum", "trash"]
    data, labels = [], []
    for i in range(1200):
        w = rng.choices(neutral, k=30)
        bad = i % 4 == 0
        if bad:
            w[rng.randrange(30)] = rng.choice(toxic)
        if rng.random() < (0.8 if bad else 0.05):  # the group's name goes with the label
            w[0] = "muslims"
        data.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    data += [(9000, "the muslims met in town " + " ".join(neutral[:20])), (9001, None), (9002, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    truth = spark.createDataFrame([*labels, (None, 1), (9002, None), (0, 1)], "doc_id long, toxic int")
    held = id_remainder(F.col("doc_id"), 5) == 0
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, truth, held).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    out = [(got[d].predicted, y) for d, y in labels if got[d].held_out]
    assert sum(p == y for p, y in out) > 0.97 * len(out)
    assert got[9000].predicted == 0 and got[9001].score == got[9002].score
    weights = {s: toxicity.fit(df.join(truth, "doc_id").select("text", "toxic").filter("toxic is not null"), swap_weight=s)[0] for s in (0.0, 10.0)}
    mention = toxicity.text_features({b"muslims"})
    assert abs(weights[10.0][mention].sum()) < 0.5 * abs(weights[0.0][mention].sum())
    assert toxicity.score_toxicity(docs, truth.limit(0), held).select("score").distinct().count() == 1
    assert toxicity.score_toxicity(nothing, truth, held).count() == 0


def test_logistic_fit_reaches_the_minimum():
    rng = np.random.default_rng(12)
    x = rng.random((300, 6)) < 0.4
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 0, 1, 0] - 0.5)))).astype(float)
    w, b = linear.fit_logistic(linear.Rows([np.flatnonzero(r) for r in x]), y, np.ones(300), 6, l2=0.01, steps=2000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) / 300 + 0.01 * w).max() < 1e-4 and abs((p - y).mean()) < 1e-4


# ---- 9. URL filter

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = lower(host)
    fit = [(len(h + p), h + p) for h, p, _ in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "http://A.COM", "http://a.com/", "https://x.example.com/en/1?q=://z", "https://www.example.com/en/", "https://m.www.example.com/en/a#b",
        "http://example.com/EN/", "http://b.net/es/1", "http://net/fr/", "http://bnet/fr/", "ftp://u:p@É.org:80/ü?x", "http://com?x/", "http://casino24.example.org/de/3", "http://blog.therain.example.org/de/3", "http://" + "long-host." * 5000 + "org/" + "p/" * 5000]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)] + [(3, "://", "h", 1)], "page_id long, url string, host string, path int")
    got = url_filter.judge_urls(pages).cache()
    assert rows(got, "page_id", "host", "path", "rule") == sorted([(i, *brute_url(u)) for i, u in [*enumerate(urls), (3, "://")]], key=repr)
    verdict = {r.page_id: r.verdict for r in got.collect()}
    what = {h + p: v for h, p, v in url_filter.RULES}
    assert all(verdict[i] == what[brute_url(u)[2]] for i, u in enumerate(urls) if brute_url(u)[2])
    assert verdict[16] == "block" and verdict[17] == "allow" and verdict[0] == "allow"
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_model_is_the_regression_of_its_table(spark):
    """Plain gradient descent over the same n-gram counts; held-out names, not in the table."""
    B = url_filter.BUCKETS
    bad = "mega-casino bestbets cheapmeds canadian-pharmacy buylinkfarm webcams escortgirls adclicks".split()
    good = "stanford parliament orchard sailing cityhall tennis novel castle economics lighthouse desert ocean embassy puppets".split()
    urls = [u for u, _ in url_filter.LABELLED] + [f"https://{n}.example.org/de/{i}" for i, n in enumerate(bad + good)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    grams = {r.page_id: (np.array(r.g), r.h) for r in url_filter.url_parts(df).select("page_id", F.expr(url_filter._buckets("host", "path")).alias("g"), F.xxhash64("url").alias("h")).collect()}

    def vector(i):
        g = grams[i][0]
        return np.append(np.bincount(g, minlength=B) / np.sqrt(len(g)), 1.0)

    order = sorted(range(len(url_filter.LABELLED)), key=lambda i: grams[i][1])
    x, y, w = [vector(i) for i in order], [url_filter.LABELLED[i][1] for i in order], np.zeros(B + 1)
    for _ in range(url_filter.EPOCHS):
        for v, label in zip(x, y):
            w -= url_filter.RATE * ((1 / (1 + np.exp(-v @ w)) - label) * v + url_filter.PENALTY * w)
    got = {r.page_id: r.score for r in url_filter.judge_urls(df, rules=(("none.invalid", "/", "allow"),)).collect()}
    want = [1 / (1 + np.exp(-vector(i) @ w)) for i in range(len(urls))]
    assert [got[i] for i in range(len(urls))] == pytest.approx(want, abs=1e-6)
    n = len(url_filter.LABELLED)
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(url_filter.LABELLED)]) > 0.97
    held = [got[n + i] for i in range(len(bad + good))]
    assert np.median(held[:len(bad)]) > max(sorted(held[len(bad):])[:-2])   # most unwanted names score above nearly all others


# ---- 10. language model

def corpus():
    rng = random.Random(13)
    data = [(i, " ".join(rng.choice(["The cat", "a dog", "le chien", "un chat"]) + f" {rng.choice('xyz')}{rng.randint(0, 60)}" for _ in range(rng.randint(0, 40)))) for i in range(300)]
    return data + [(r[0], r[1]) for r in awkward() if r[0] != 10]


def tokens_of(text):
    return [w.encode() for w in WORD.findall(lower(text or ""))] + [b"\n"]


def training(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 != 2


@pytest.mark.parametrize("vocabulary,dense,chunk", [(40, 10, 4096), (80_000, 8192, 1 << 22)])
def test_language_model(spark, nothing, monkeypatch, vocabulary, dense, chunk):
    """Base columns, and the score by a plain model of the same weights, word by word."""
    for name, value in (("VOCABULARY", vocabulary), ("DENSE", dense), ("CHUNK_BYTES", chunk)):
        monkeypatch.setattr(entropy_lm, name, value)
    kept = {}
    learn = entropy_lm.learn_model

    def spy(*args):
        kept["model"], kept["codes"] = learn(*args)
        return kept["model"], kept["codes"]

    monkeypatch.setattr(entropy_lm, "learn_model", spy)
    data = corpus()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    held = id_remainder(F.col("doc_id"), 7) == 2
    counts = Counter(w for d, t in data if training(d) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    got = entropy_lm.score_texts(df, ~held).collect()
    want = sorted((d if d is not None else -1, len(tokens_of(t)), sum(counts[w] > 0 for w in tokens_of(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens_of(t)), 6)) for d, t in data)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want

    model, voc = kept["model"], kept["model"].vocabulary
    C, followed = voc.classes, defaultdict(Counter)
    cls = {w: int(voc.cls[voc.number[w]]) if w in voc.number else int(voc.rare_class([w])[0]) for d, t in data for w in tokens_of(t)}
    for d, t in data:
        own = tokens_of(t)
        if training(d):
            for i, w in enumerate(own):
                for back in (1, 2):
                    if i >= back:
                        followed[own[i - back]][(back - 1) * C + cls[w]] += 1
    mass = Counter({c: 1 for c in range(C)})
    for w, k in counts.items():
        if w not in voc.number:
            mass[cls[w]] += k + 1
    frequent_mass = Counter()
    for w, i in voc.number.items():
        frequent_mass[cls[w]] += counts[w] + 1

    def row(word, back):
        number = voc.number.get(word, 0)
        own = np.zeros(C)
        if 0 < number <= dense:
            return model.weights[2 * (number + 1) + back].astype(float)
        seen = np.array([followed[word][back * C + c] for c in range(C)], float)
        if seen.sum():
            p = model.steps.expected[back]
            own = (seen - seen.sum() * p) / (seen.sum() * p * (1 - p) + entropy_lm.CAUTION)
        return model.weights[2 + back] + own

    for r, (d, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.score)), sorted(data, key=lambda x: (x[0] is None, x[0]))):
        if d is None or not 20 <= d <= 80:  # ids of one row
            continue
        own, total = tokens_of(t), 0.0
        for i, w in enumerate(own):
            z = model.weights[-1].astype(float) + sum(row(own[i - 1 - back], back) if i > back else model.weights[back] for back in (0, 1))
            p = np.exp(z - z.max())
            total += math.log10(p[cls[w]] / p.sum()) + math.log10((counts[w] + 1) / (frequent_mass if w in voc.number else mass)[cls[w]])
        assert r.score == pytest.approx(total, abs=1e-3 * max(1, len(own) / 20)), d
    assert sum(r.score for r in got if r.doc_id and 0 < r.doc_id < 300) > sum(r.base_score for r in got if r.doc_id and 0 < r.doc_id < 300)
    if vocabulary == 40:
        monkeypatch.setattr(entropy_lm, "learn_model", learn)
        assert entropy_lm.score_texts(nothing, ~held).count() == 0
        untrained = entropy_lm.score_texts(df, F.lit(False)).collect()
        assert len(untrained) == len(data) and all(r.n_known == 0 and r.base_score == 0 for r in untrained)


def test_words_and_texts_of_a_chunk_travel_packed(spark, monkeypatch):
    """A row for each chunk of a packing task, not one for each word; nothing is lost or told apart wrongly."""
    monkeypatch.setattr(entropy_lm, "PACKED_ROWS", 1000)
    needs = spark.range(6000, numPartitions=2).select((F.col("id") % 5).alias("chunk"), (F.col("id") * 7919 % 900 - 450).alias("key"))
    rare = spark.range(-300, 500, numPartitions=2).select(F.col("id").alias("key"), F.array(F.col("id"), F.lit(1 << 40)).alias("codes")).filter("key % 2 = 0")
    texts = spark.createDataFrame([(c, 10 * c + i, None if i == 1 else c, 0, "b", f"text \n{c} {i}", i == 2) for c in range(5) for i in range(3)],
                                  "chunk long, row long, doc_id long, round int, before string, text string, last boolean")
    got = entropy_lm.meet(texts, needs, rare).collect()
    words = sorted((r.chunk, k, *c) for r in got if r.kind == 0 for k, c in zip(*(x.tolist() for x in entropy_lm.unpack_words([bytes(r.packed)]))))
    assert words == sorted((r.chunk, r.key, *r.codes) for r in needs.join(rare, "key").collect()) and len(words) > 2000
    assert sum(r.kind == 0 for r in got) <= len(words) // 20
    pieces = sorted((r.chunk, *x.values()) for r in got if r.kind == 1 for x in entropy_lm.unpack([bytes(r.packed)]).select(["row", "before", "text", "last"]).to_pylist())
    assert pieces == sorted((r.chunk, r.row, r.before, r.text, r["last"]) for r in texts.collect())
    steps = entropy_lm.Steps(np.arange(1.0, 9), 4)
    codes = [[], [3 << 16 | 1, 2 << 16 | 6], [1 << 16], [9 << 16 | 7]] * 1000  # over a block of words
    rows, total = steps.rows(pa.array([[0]] + codes, pa.list_(pa.int64()))[1:])
    for i in (0, 1, 2, 3, 3997, 3999):
        seen = np.zeros((2, 4))
        for code in codes[i]:
            seen[(code & 0xFFFF) // 4, (code & 0xFFFF) % 4] += code >> 16
        n, p = seen.sum(axis=1, keepdims=True), steps.expected
        assert np.allclose(rows[i], (seen - n * p) / (n * p * (1 - p) + entropy_lm.CAUTION)) and total[i] == n[0, 0]


def test_pieces_of_long_texts():
    text = (words(3000, 5) + "  " + "x" * 900 + "\n" + words(50, 6)).encode()
    cut = list(entropy_lm.pieces(text, 700))
    assert b"".join(p for _, p, _ in cut) == text and [last for *_, last in cut] == [False] * (len(cut) - 1) + [True]
    seen = []
    for before, piece, _ in cut:
        assert before.split() == seen[-2:]
        seen += piece.split()
    vocabulary = entropy_lm.Vocabulary([b"\n", b"w5", b"w17"], np.array([9.0, 8, 5]), 30, 10)
    whole, parts = entropy_lm.Tokens([(b"", text, True)], vocabulary), entropy_lm.Tokens(cut, vocabulary)
    assert (whole.one == parts.one).all() and (whole.two == parts.two).all() and (whole.cls == parts.cls).all() and whole.names == parts.names
    assert list(entropy_lm.pieces(b"", 700)) == [(b"", b"", True)]


def test_rare_words_are_contexts_of_their_own(spark, monkeypatch):
    """The words beyond the vocabulary tell what follows, and ties at the cut are broken."""
    ties = spark.createDataFrame([(f"w{i}", 5) for i in range(400)] + [("top", 90)], "token string, n long")
    some = list(entropy_lm.frequent_tokens(ties, 100)["token"])
    assert some[0] == "top" and 80 <= len(some) <= 100
    cut = entropy_lm.frequent_tokens
    monkeypatch.setattr(entropy_lm, "frequent_tokens", lambda counts, *_: cut(counts, 3))
    rng = random.Random(3)
    data = [(i, " ".join(f"{(w := rng.randint(0, 39))}n {['llll', 'rrrr'][w % 2]}" for _ in range(60))) for i in range(400)]
    right, wrong = (" ".join(f"{w}n {['llll', 'rrrr'][(w + off) % 2]}" for w in range(40)) for off in (0, 1))
    df = spark.createDataFrame([*data, (1000, right), (1001, wrong)], "doc_id long, text string")
    got = {r.doc_id: r for r in entropy_lm.score_texts(df, F.col("doc_id") < 1000).filter("doc_id >= 1000").collect()}
    assert got[1000].n_known == got[1001].n_known == 81
    assert got[1000].score > got[1001].score + 10


def test_texts_are_stored_as_numbers_of_words(spark, monkeypatch):
    """The model reads chunks of numbers: no pass after them splits texts again, and nothing of a text is lost."""
    monkeypatch.setattr(entropy_lm, "CHUNK_BYTES", 2000)
    data = [(i if i % 5 else None, None if i == 7 else words(i * 7 % 90, i).title() + " \n"[i % 3:], i % 3 if i % 3 < 2 else None) for i in range(60)]
    data.append((99, words(1500, 5), 1))
    vocabulary = entropy_lm.Vocabulary([b"\n", b"w5", b"w17", b"w1"], np.array([9.0, 8, 5, 4]), 300, 90)
    got = entropy_lm.in_chunks(spark.createDataFrame(data, "doc_id long, text string, round int").coalesce(1), spark.sparkContext.broadcast(vocabulary)).collect()
    assert len(got) > 5 and all(r.asDict().keys() == {"chunk", "tokens", "keys"} for r in got) and len({r.chunk for r in got}) == len(got)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r.chunk):
        columns = entropy_lm.unpack_columns(bytes(r.tokens))
        tokens, keys = entropy_lm.Tokens.unpacked(columns, vocabulary), np.frombuffer(bytes(r.keys), np.int64)
        name = {0: "start", **{i: w for w, i in vocabulary.number.items()}}
        for at, *ids in zip(tokens.row, tokens.ids, tokens.one, tokens.two):
            found[int(columns["row"][at])].append([name.get(int(i), "start") if i >= 0 or i == entropy_lm.START else int(keys[-1 - i]) for i in ids])
        for at, doc_id, none, r in zip(*(columns[c].tolist() for c in ("row", "doc_id", "no_id", "round"))):
            assert (None if none else doc_id, None if r < 0 else r) == data[at & 0xFFFF][::2]
    def word(w):
        return w if w in vocabulary.number else int(entropy_lm.word_keys([w])[0])
    for i, (_, text, _) in enumerate(data):
        own = ["start", "start", *map(word, tokens_of(text))]
        assert found[i] == [[own[k], own[k - 1], own[k - 2]] for k in range(2, len(own))], i


def test_softmax_by_products_is_the_softmax():
    """One update, against token by token: rows that come once and often, and weights so far apart that products vanish."""
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(2 * 12 + 1, 7)).astype(np.float32)
    weights[4, 0] += 150
    weights[7, 3] += 150
    one, two = np.append(rng.integers(0, 5, 300), [9, 2]), np.append(rng.integers(0, 6, 300), [11, 3])
    features, cls = np.stack([2 * one, 2 * two + 1], axis=1), rng.integers(0, 7, 302)
    z = weights[features[:, 0]].astype(float) + weights[features[:, 1]] + weights[-1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    gradient = p / p.sum(axis=1, keepdims=True) - np.eye(7)[cls]
    want, squares, touched = weights.astype(float), np.zeros(len(weights)), np.zeros(len(weights), np.int64)
    for row in range(len(weights)):
        part = (features == row).any(axis=1) if row < len(weights) - 1 else np.ones(302, bool)
        if part.any():
            mean = gradient[part].sum(axis=0) / np.sqrt(part.sum())
            squares[row], touched[row] = (mean**2).mean(), part.sum()
            want[row] -= entropy_lm.RATE / np.sqrt(squares[row] + 1e-6) * mean
    got, own_squares, own_touched = weights.copy(), np.zeros(len(weights)), np.zeros(len(weights), np.int64)
    entropy_lm.update(got, own_squares, own_touched, features, cls)
    assert np.allclose(got, want, atol=1e-3) and np.allclose(own_squares, squares, rtol=1e-3, atol=1e-6) and (own_touched == touched).all()


def test_words_in_texts():
    texts = [b"", b" ", b"A\tb", "Ünï \v\nÜ".encode(), b"\nx", b""]
    got, sizes = entropy_lm.words_in(texts)
    assert got.to_pylist() == [w for t in texts for w in t.lower().split()] and sizes.tolist() == [0, 0, 2, 2, 1, 0]
    assert [x.tolist() for x in entropy_lm.words_in([b""])[1:]] == [[0]]


def test_word_shares_sum_to_one():
    vocabulary = entropy_lm.Vocabulary([b"\n", b"the", b"of", b"cat"], np.array([9.0, 8, 5, 2]), 30, 10)
    inside = 10 ** vocabulary.inside[1:]
    for c in set(vocabulary.cls[1:]):
        assert inside[vocabulary.cls[1:] == c].sum() == pytest.approx(1)
    log = entropy_lm.class_log_probs(np.random.default_rng(1).random((3, vocabulary.classes)))
    assert np.exp(log).sum(axis=1) == pytest.approx([1, 1, 1], abs=1e-5)
    names = [b"a", "straße".encode(), b"x" * 5000, b"the"]
    together = vocabulary.rare_class(names)
    assert [int(vocabulary.rare_class([w])[0]) for w in names] == list(together)


# ---- reruns

def test_mix_and_toxic_labels_dont_hang_on_the_layout(spark, docs):
    """The mix at two shuffle widths, and the label of an id that has several."""
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for width in (4, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(width))
            got.append(rows(mixing.plan_mix(docs.repartition(width)), "doc_id", "source", "text_hash", "copies", "taken", "shard_1", "order_1"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, None), (None, 1)], "doc_id long, toxic int").repartition(3)
    sample = toxicity.labelled_sample(docs, labels, F.lit(True))
    assert rows(sample, "doc_id", "toxic") == [(0, 1), (1, 0)]
