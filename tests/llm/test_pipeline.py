"""The stages one after the other, and the registered queries on the smallest tables."""

import os
import random
import sys
import zlib
from collections import Counter

import duckdb
import pytest
from awkward_rows import docs, nothing  # noqa: F401

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


def test_stages(spark, docs, nothing, tmp_path):
    import corpus_pipeline

    if not os.path.isdir(SMALL):
        pytest.skip("no tables")
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    for first in (documents, docs, nothing):
        kept = first
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, kept, SMALL)
            path = str(tmp_path / f"{len(os.listdir(tmp_path))}")
            out.write.parquet(path)
            before, kept = kept, spark.read.parquet(path)
            if i < 4:
                assert kept.columns == first.columns
            if i < 3:
                assert kept.count() <= before.count()
        assert kept.select("shard", "slot").distinct().count() == before.count() == kept.count()


def test_queries(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no tables")
    from panelmerge.llm.oracle import ORACLE_SQL
    from panelmerge.llm.queries import QUERIES

    n = {t: spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("documents", "pages")}
    n["conversations"] = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
    tables = {"op9_": "pages", "op13_": "conversations"}
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    for name, query in QUERIES.items():
        got = query(spark, SMALL)
        columns, got = got.columns, [tuple(r) for r in got.collect()]
        assert name.startswith("op1_") or len(got) == n[tables.get(name.split("_")[0] + "_", "documents")]
        if name in ORACLE_SQL:
            rel = con.sql(ORACLE_SQL[name])
            assert sorted(rel.columns) == sorted(columns)
            assert sorted(rel.select(*columns).fetchall()) == sorted(got)


ALPHABET = "the of and to in a is that for it as with was on be by this are from at or an".split()


def prose(rng, n):
    """Good text: sentences with common words between longer ones."""
    out = []
    for i in range(n):
        w = rng.choice(ALPHABET) if rng.random() < 0.45 else "".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(4, 9)))
        out.append(w.capitalize() if i % 12 == 0 else w + "." if i % 12 == 11 else w)
    return " ".join(out)


def edit_distance_in(item, text):
    """Least number of edits that turn the item into some part of the text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(before[j - 1] + (c != x), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage on its own input: planted junk goes and clean text stays; components,
    leaks, shares and the shard law as plain Python finds them."""
    import corpus_pipeline
    from panelmerge.llm import decontaminate
    from test_operators import brute_components, law_of_rows, shared_out

    rng = random.Random(20)
    items = [(i, prose(rng, 12)) for i in range(3)]
    good = [prose(rng, rng.randint(60, 90)) for _ in range(90)]
    texts = [(t, "good") for t in good]
    texts += [(" ".join([*(w := t.split())[:30], "changed", *w[31:]]), "good") for t in good[:12]] + [(t, "good") for t in good[12:20]]
    texts += [(prose(rng, 30) + " " + items[i % 3][1].replace("e", "x", i % 4) + " " + prose(rng, 30), "good") for i in range(8)]
    texts += [(" ".join(rng.choice(["@@##$$", "%%%&&", "<<>>||"]) + str(rng.randint(0, 9)) for _ in range(60)), "junk") for _ in range(15)]
    rng.shuffle(texts)
    data = [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t), 7) for i, (t, _) in enumerate(texts)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, size long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs, outs = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        outs.append([r.asDict() for r in docs.collect()])
    rated, alone, unleaked, mixed, placed = outs

    assert {r["doc_id"] for r in rated} == {i for i, (_, kind) in enumerate(texts) if kind == "good"}

    component = brute_components([(r["doc_id"], r["text"]) for r in rated], 5, 80)
    assert sorted(r["doc_id"] for r in alone) == sorted(d for d, _, c in component if d == c) and len(alone) < len(rated)

    plain = [decontaminate.normalised(t) for _, t in items]
    leaks = {r["doc_id"] for r in alone for item in plain if edit_distance_in(item, decontaminate.normalised(r["text"])) <= int(len(item) * decontaminate.ERRORS)}
    assert len(leaks) >= 4 and {r["doc_id"] for r in unleaked} == {r["doc_id"] for r in alone} - leaks

    sizes, taken = Counter(), Counter()
    for r in unleaked:
        sizes[r["source"]] += len(r["text"].split())
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    for source, target in shared_out(dict(sizes)).items():
        assert abs(taken[source] - target) <= 100  # within the size of a document
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert {tuple(r.values()) for r in mixed} <= {tuple(r.values()) for r in unleaked}

    law_of_rows([(r["shard"], r["slot"]) for r in placed])
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in placed) == sorted(
        (r["doc_id"], len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode())) for r in mixed)
