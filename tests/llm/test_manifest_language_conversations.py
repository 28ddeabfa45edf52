"""Manifest, language identification and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from awkward_rows import awkward, docs, nothing  # noqa: F401
from pyspark.sql import functions as F

from panelmerge.llm import conversation, language_id, manifest
from panelmerge.llm.shared import id_remainder


# ---- 11. manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and for each node what stands left and right of it on the way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, a in zip(paths, at):
            run = nodes[a // 3 * 3:a // 3 * 3 + 3]
            path.append((run[:a % 3], run[a % 3 + 1:]))
        nodes, at = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], [a // 3 for a in at]
    return nodes[0], paths


def plain_manifest(rows, bad):
    """rows: (doc_id, source, lang, n_chars, text); ``bad`` returns the row as it is checked."""
    order, trees = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode())), {}
    for s in order:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, *plain_tree([leaf(r) for r in own])
    root, tops = plain_tree([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        for row, path in zip(trees[s][0], trees[s][2]):
            h = leaf(bad(row))
            for left, right in path + top:
                h = digest(*left, h, *right)
            out.append((row[0], leaf(row), trees[s][1], root, digest(*(x for left, right in path + top for x in [*left, *right])), h, h == root))
    return out


@pytest.mark.parametrize("sizes", [[1], [3, 1], [82, 4, 1, 2], [250, 81, 9]])
def test_manifest(spark, sizes):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i, f"s{s}" if s else None, "en" if i % 3 else None, i if i % 4 else None, [f"a\nb{i}", "", None, "é" * i, f"one line {i}"][i % 5]))
            i += 1
    check(spark, rows)


def test_manifest_of_awkward_rows(spark, nothing):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in awkward()]
    check(spark, rows + rows[:4] + [(7, "s1", "en", 5, "same")] * 40)
    assert manifest.manifest(nothing).count() == 0


def check(spark, rows):
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, pos long, path string").repartition(3)
    got = manifest.manifest(df, F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))

    def bad(row):
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
        return (*row[:4], row[4].replace("\n", "")) if hit else row

    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(plain_manifest(rows, bad), key=repr)


# ---- 12. language

SAMPLES = {"xx": "kala mika toka lasu", "yy": "brzt gwor strk plmn", "zz": "été çà où naïve"}


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(2)
    net = language_id.start(3)
    windows = rng.integers(97, 123, (5, language_id.WINDOW)).astype(np.uint8)
    target, weight = np.array([0, 1, 2, 0, 1]), np.array([1.0, 2, 1, 1, 3])

    def loss():
        values, _ = language_id.pooled(net, windows)
        p = language_id.softmax(np.maximum(values, 0).reshape(5, -1).astype(float) @ net.out + net.out_bias)
        return -(weight * np.log(p[np.arange(5), target])).sum() / weight.sum()

    for part, slope in zip(net.parts(), language_id.gradients(net, windows, target, weight)):
        flat = part.reshape(-1)
        for i in np.argsort(-np.abs(slope.reshape(-1)))[:3]:
            at, h = flat[i], 1e-3
            flat[i] = at + h
            up = loss()
            flat[i] = at - h
            down = loss()
            flat[i] = at
            assert (up - down) / (2 * h) == pytest.approx(slope.reshape(-1)[i], rel=0.05, abs=1e-4)


def test_tables_and_windows_are_the_network(monkeypatch):
    net = language_id.start(3)
    texts = [b"", b"a", b"x" * 192, b"y" * 193, bytes(range(97, 123)) * 40]
    windows, own = language_id.windows_of(texts)
    assert np.bincount(own).tolist() == [1, 1, 1, 2, 6]
    step = language_id.WINDOW - language_id.OVERLAP
    for k, text in enumerate(texts):   # every run of bytes that a filter covers is in a window
        mine = windows[own == k]
        assert all(bytes(mine[i // step][i % step:i % step + 4]) == text[i:i + 4] for i in range(max(0, len(text) - 3)) if i // step < len(mine))
    values, _ = language_id.pooled(net, windows)
    tables = language_id.Tables(net)
    rates = np.maximum(values, 0).reshape(len(windows), -1) @ net.out + net.out_bias
    assert np.allclose(tables.rate(windows), rates, atol=1e-4)
    want = np.array([rates[own == k].mean(axis=0) for k in range(len(texts))])
    assert np.allclose(language_id.rate_texts(tables, texts), want, atol=1e-4)
    monkeypatch.setattr(language_id, "BATCH", 1)
    long = bytes(range(97, 123)) * 2000
    w, _ = language_id.windows_of([long])
    assert np.allclose(language_id.rate_texts(tables, [long, b"a"])[0], tables.rate(w).mean(axis=0), atol=1e-4)


def test_language(spark, docs, nothing):
    rng = random.Random(6)
    data = [(i, " ".join(rng.choice(SAMPLES[lang].split()) for _ in range(rng.randint(2, 300))), lang) for i in range(240) for lang in [rng.choice("xx yy zz".split())]]
    data += [(1000, None, "xx"), (1001, "", "xx"), (1002, "123 ...", "yy"), (1003, SAMPLES["yy"], None), (None, SAMPLES["zz"], "zz"), (5, data[5][1], data[5][2]), (1004, "été " * 50_000, "zz")]
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, lang string, score int")
    held = id_remainder(F.col("doc_id"), 3) == 1
    got = language_id.identify(df, ~held).collect()
    assert len(got) == len(data)
    label = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert [label[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert label[1003][0] == "yy" and label[None][0] == "zz" and label[1004][0] == "zz"
    out = [i for i, _, _ in data[:240] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(label[i][0] == data[i][2] for i in out) >= 0.98 * len(out) and all(0 <= s <= 1 for _, s in label.values())
    again = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in language_id.identify(df.repartition(5), ~held).collect()}
    assert again == {d: (x, round(s, 6)) for d, (x, s) in label.items()}
    assert language_id.identify(nothing, ~held).count() == 0
    assert {r.lang_pred for r in language_id.identify(df, F.lit(False)).collect()} == {"und"}
    one = language_id.identify(df.filter("lang = 'xx'"), ~held).filter("lang_pred <> 'und'")
    assert {(r.lang_pred, r.score) for r in one.collect()} == {("xx", 1.0)}
    assert language_id.identify(docs, ~held).count() == len(awkward())


# ---- 13. conversations

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def spaced(v):
    return " " if v is None else str(v)


def damage(rows):
    out = []
    for c, t, r, x in rows:
        d, r, x = zlib.crc32(f"{spaced(c)}:{spaced(t)}".encode()) % 20, spaced(r), spaced(x)
        if d:
            x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
            out += [(c, t, "user" if d == 4 else r, x)] * (2 if d == 3 else 1)
    return out


def relaxed(own):
    """States reached by insertions, until nothing gets cheaper."""
    for _ in range(4):
        for q in ("", "s", "u", "a"):
            to = "a" if q == "u" else "u"
            if to in own:
                cost, audit, out = own[to]
                new = (cost + 2, "I" + audit, (("assistant:" if to == "a" else "user:"), *out))
                own[q] = min(own.get(q, new), new, key=lambda w: w[:2])
    return own


def solve(rows):
    """rows: (turn, role, text) in order; costs, edits and results from the last row back."""
    seen, kinds = set(), []
    for _, r, x in rows:
        blank, end = not x.strip(BLANKS), x.rstrip(BLANKS)[-1:]
        kinds.append("blank" if blank else "duplicate" if (r, x) in seen else "truncated" if end not in ".!?" else "")
        seen.add((r, x))
    best = relaxed({"": (0, "", ()), "a": (0, "", ())})
    for (_, r, x), fault in list(zip(rows, kinds))[::-1]:
        own = {}
        for q in ("", "s", "u", "a"):
            ways = [(best[q][0] + 3, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                extra, to = int(fault == "truncated"), "a" if q == "u" else "u"
                if (q, r[:1]) in NEXT:
                    cost, audit, out = best[NEXT[q, r[:1]]]
                    ways.append((cost + extra, "K" + audit, (f"{r}:{x}", *out)))
                cost, audit, out = best[to]
                ways.append((cost + 2 + extra, "R" + audit, (f"{'assistant' if to == 'a' else 'user'}:{x}", *out)))
            own[q] = min(ways, key=lambda w: w[:2])
        best = relaxed(own)
    cost, audit, out = best[""]
    turns, initials = [t for t, _, _ in rows if t is not None], [r[:1] for _, r, _ in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_audit(rows):
    by = {r[0]: [] for r in rows}
    for c, t, r, x in damage(rows):
        by[c].append((t, r, x))
    key = lambda z: (z[0] is not None, z[0] or 0, hashlib.sha256(f"{len(z[1].encode())}:{z[1]}{z[2]}".encode()).digest()[:16])
    return {c: solve(sorted(v, key=key)) for c, v in by.items()}


def talks(seed, sizes):
    rng, rows = random.Random(seed), []
    for c, n in sizes.items():
        turn = 0
        for _ in range(n):
            turn += rng.choice([0, 1, 1, 1, 1, 2])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
            rows.append((c, turn if rng.random() < 0.95 else None, role, rng.choice([f"t{rng.random()}.", f"t{rng.random()}", "same.", "", None, "ok! \n", "long " * 3000 + "?"])))
    return rows + rows[:5]


@pytest.mark.parametrize("chunk_rows", [5, 4096])
def test_conversations(spark, monkeypatch, chunk_rows):
    """A conversation over many chunks, small ones, one without an id, repeated rows; clashing columns."""
    monkeypatch.setattr(conversation, "CHUNK_ROWS", chunk_rows)
    rows = talks(3, {0: 200, 1: 40, 2: 5, 3: 1, None: 20, 9: 2})
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos long, conv string").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in conversation.audit(df).collect()}
    assert got == plain_audit(rows)
    assert conversation.audit(df.limit(0)).count() == 0


def test_repaired_rows_are_conversations(spark):
    rows = talks(8, {1: 30, 2: 7, 3: 12})
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged, judged, edited = conversation.repair(df)
    got = conversation.repaired_rows(damaged, edited).orderBy("conv", "seq").collect()
    for c in "123":
        own = [r for r in got if r.conv == c]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == plain_audit(rows)[int(c)][-1]


def test_costs_behind_are_found_by_fix_up_passes():
    """Whatever the start, vectors differ by a constant only after some rows, and the result is that of one run."""
    rng = random.Random(1)
    for _ in range(50):
        kinds = "".join(rng.choice("suaSUA-_x") for _ in range(60))
        whole = conversation.backward(kinds, conversation.END)
        guess = conversation.backward(kinds[:30], conversation.END)
        assert conversation.step(guess[0], kinds[0])[1] == conversation.step(whole[0], kinds[0])[1]
