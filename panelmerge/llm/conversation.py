"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation should read ``(system? (user assistant)+)?``. Four states say what may come
next; each row is kept, given another role or deleted, and empty rows may be inserted. The
cheapest edits are a shortest path through rows and states.

Rows in order are cut into chunks of ``CHUNK_ROWS``, whatever conversations they belong to.
Costs to the end run backwards: where a conversation goes on in the next chunk, a chunk
starts from a speculative cost vector. Fix-up passes give it the vector that the next
chunk came to and rerun its rows until the vectors differ from the former ones only by a
constant; passes go on until no chunk changes. On the stitched costs, every step forward takes the
least edit (ASCII order of initials) that lies on a cheapest path. A chunk that begins within a
conversation is traced from all four states, and the traces are strung together.

A conversation with a third of all rows is as many chunks as any other rows are. No step
needs texts: rows travel as role initial, fault and digest, and texts meet their edits at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BLANKS, raw, stored

CHUNK_ROWS = 4096
RANGE_BITS = 33  # of a position: the place within its range
STATES = 4  # nothing yet, after system, after user, after assistant
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GROWS = {0: 2, 1: 2, 2: 3, 3: 2}  # where an inserted row, or one with another role, leads
ROLES = {2: "user", 3: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
END = (0, 4, 2, 0)  # costs to the end behind the last row
LEGAL = ("su", "ua", "au")


# ---- rows and their faults

def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copy: rows after damage by crc32(``conv_id:turn``) % 20."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select(spaced("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), damage.alias("damage"))
    return rows.filter("damage <> 0").select(
        "conv", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def text_key(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of role and text."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, copy) by conversation and turn, without texts: pos, conv,
    turn, initial, key, blank, truncated. Within a turn: by digest of role and text, and copy."""
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    short = rows.select(
        "conv", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        text_key(F.col("role"), F.col("text")).alias("key"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
        "copy", F.monotonically_increasing_id().alias("salt"))
    order = ["conv", F.asc_nulls_first("turn"), "key", "copy", "salt"]
    short = stored(short, "turns")
    placed = short.repartitionByRange(*order).sortWithinPartitions(*order)
    pos = F.shiftleft(F.spark_partition_id().cast("long"), RANGE_BITS).bitwiseOR(F.monotonically_increasing_id().bitwiseAND((1 << RANGE_BITS) - 1))
    return stored(placed.select(pos.alias("pos"), "conv", "turn", "initial", "key", "blank", "truncated"), "turns-ordered")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: blank, duplicate (role and text were there before), truncated or none."""
    first = rows.groupBy("conv", "key").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    marked = rows.join(first, "pos", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated").otherwise("none")
    return marked.withColumn("fault", fault).drop("first", "blank", "truncated")


# ---- steps of the shortest path

def row_edits(state: int, kind: str) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row. ``kind``: ``x`` for rows that must go, else
    the initial, in capitals if truncated (``-`` and ``_`` for others than s, u and a)."""
    yield "D", DELETE, state
    if kind != "x":
        extra = TRUNCATED if kind.isupper() or kind == "_" else 0
        if (state, kind.lower()) in NEXT:
            yield "K", extra, NEXT[state, kind.lower()]
        yield "R", REROLE + extra, GROWS[state]


@cache
def step(costs: tuple[int, ...], kind: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Costs to the end before a row, from those behind it, and the same less their least."""
    own = [min(cost + costs[to] for _, cost, to in row_edits(q, kind)) for q in range(STATES)]
    for _ in range(STATES):
        own = [min(own[q], INSERT + own[GROWS[q]]) for q in range(STATES)]
    least = min(own)
    return tuple(own), tuple(x - least for x in own)


@cache
def trace(state: int, kind: str, costs: tuple[int, ...]) -> tuple[str, int, int]:
    """Letters of a row with what is inserted before it, the state behind it and their
    cost: at each point the least letter on a cheapest path. ``costs``: behind the row."""
    before, _ = step(costs, kind)
    letters, paid = "", 0
    while True:
        ways = [(letter, cost, to, True) for letter, cost, to in row_edits(state, kind) if cost + costs[to] == before[state]]
        if INSERT + before[GROWS[state]] == before[state]:
            ways.append(("I", INSERT, GROWS[state], False))
        letter, cost, state, done = min(ways)
        letters, paid = letters + letter, paid + cost
        if done:
            return letters, state, paid


def trailing(state: int) -> tuple[str, int]:
    """Letters behind the last row, and their cost."""
    return "I" * (END[state] // INSERT), END[state]


# ---- chunks

def chunks(rows: DataFrame) -> DataFrame:
    """chunk and its rows in order: pos, conv, kind (one character) and key. The rows of a
    chunk are at most CHUNK_ROWS."""
    steps = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.when(F.col("initial") == "-", "_").otherwise(F.upper("initial"))).otherwise(F.col("initial"))
    at = F.col("pos").bitwiseAND((1 << RANGE_BITS) - 1)
    chunk = F.col("pos") - at + F.floor(at / CHUNK_ROWS)
    rows = rows.select(chunk.alias("chunk"), F.struct("pos", "conv", steps.alias("kind"), "key", "initial").alias("row"))
    return rows.groupBy("chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))


def open_ends(chunked: DataFrame) -> DataFrame:
    """For each chunk: whether its first conversation began before it (``begun``, and the
    ``initial_before``) and the number of the chunk in which its last one goes on (``to``)."""
    ends = chunked.select("chunk", F.col("rows")[0].alias("first"), F.element_at("rows", -1).alias("last"))
    # A row for each end of a chunk (one, if a conversation fills it).
    pieces = ends.select("chunk", F.explode(F.array_distinct(F.array("first.conv", "last.conv"))).alias("conv"), F.col("first.conv").alias("first_conv"),
                         F.col("last.conv").alias("last_conv"), F.col("last.initial").alias("last_initial"))
    along = Window.partitionBy("conv").orderBy("chunk")
    pieces = pieces.withColumn("to", F.lead("chunk").over(along)).withColumn("initial_before", F.lag("last_initial").over(along))
    return pieces.groupBy("chunk").agg(
        F.max(F.when(F.col("conv") == F.col("first_conv"), F.col("initial_before"))).alias("initial_before"),
        F.max(F.when(F.col("conv") == F.col("last_conv"), F.col("to"))).alias("to"))


def backward(kinds: str, costs: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Cost vectors (least 0) behind each row. ``costs``: behind the last one."""
    out = [costs]
    for k in kinds[:0:-1]:
        out.append(step(out[-1], k)[1])
    return out[::-1]


def pieces_of(rows: list[dict]) -> list[tuple[int, int]]:
    """Ranges of the rows of one conversation each."""
    cuts = [0, *(i for i in range(1, len(rows)) if rows[i]["conv"] != rows[i - 1]["conv"]), len(rows)]
    return list(zip(cuts, cuts[1:]))


VECTOR = "array<int>"


def boundary_costs(chunked: DataFrame, links: DataFrame) -> DataFrame:
    """chunk, costs: the vector behind each chunk whose last conversation goes on.

    All chunks that are part of a longer conversation at both ends, or begin within one, run at once
    from END; fix-up passes then rerun those whose vector behind changed by more than a constant."""
    # Only the rows up to the end of the first conversation of a chunk matter for the chunk before it.
    begun = links.filter("initial_before IS NOT NULL").select("chunk", "to")
    first = chunked.select("chunk", F.expr("filter(rows, r -> r.conv = rows[0].conv)").alias("own"), F.size("rows").alias("n"))
    heads = first.join(begun, "chunk").select(
        "chunk", F.array_join(F.transform("own", lambda r: r["kind"]), "").alias("kinds"), F.when(F.size("own") == F.col("n"), F.col("to")).alias("to"))
    heads = stored(heads, "turns-heads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kinds, old, new in zip(*(batch.column(c).to_pylist() for c in ("kinds", "old", "new"))):
                a, b = None if old is None else tuple(old), tuple(new)
                for k in reversed(kinds):
                    a, b = a and step(a, k)[1], step(b, k)[1]
                    if a == b:  # the vectors differ by a constant only: so do all before
                        break
                out.append(None if a == b else list(b))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], ["chunk", "begin"])

    # The vector before each head; ``behind`` is the one it was computed from.
    guess = F.array(*map(F.lit, END))
    state = heads.withColumn("old", F.lit(None).cast(VECTOR)).withColumn("new", guess).mapInArrow(run, f"chunk long, begin {VECTOR}")
    state = stored(state.join(heads, "chunk").select("chunk", "begin", "to", guess.alias("behind")), "turns-vectors")
    while True:
        ahead = state.select(F.col("chunk").alias("to"), F.col("begin").alias("found"))
        checked = state.join(ahead, "to", "left")
        changed = stored(checked.filter("found IS NOT NULL AND found <> behind").select("chunk", F.col("behind").alias("old"), F.col("found").alias("new")), "turns-changed")
        if changed.isEmpty():
            break
        redone = heads.join(changed, "chunk").mapInArrow(run, f"chunk long, begin {VECTOR}").withColumnRenamed("begin", "again")
        state = stored(state.join(changed.join(redone, "chunk"), "chunk", "left").select(
            "chunk", F.coalesce("again", "begin").alias("begin"), "to", F.coalesce("new", "behind").alias("behind")), "turns-vectors")
    return links.filter("to IS NOT NULL").select("chunk", "to").join(state.select(F.col("chunk").alias("to"), F.col("begin").alias("costs")), "to").select("chunk", "costs")


def traced(batches: Iterator[pa.RecordBatch], all_states: bool) -> Iterator[pa.RecordBatch]:
    """With ``all_states``: chunk and, for each state at its begin, the state behind it. Else
    the edits of each piece of a conversation."""
    for batch in batches:
        for at in range(batch.num_rows):  # one chunk is held as objects at a time
            row = batch.slice(at, 1).to_pylist()[0]
            rows, costs, start = row["rows"], tuple(row["costs"] or END), row["state"]
            kinds, pieces = [r["kind"] for r in rows], pieces_of(row["rows"])
            if all_states:
                i, j = pieces[-1]
                behind, ends = backward("".join(kinds[i:j]), costs), []
                # Where the chunk's last conversation begins in it, the state there is 0.
                for q in range(STATES) if i == 0 else [0] * STATES:
                    for k in range(i, j):
                        q = trace(q, kinds[k], behind[k - i])[1]
                    ends.append(q)
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), pa.array([ends], pa.list_(pa.int32()))], ["chunk", "ends"])
                continue
            out: dict[str, list] = {name: [] for name in ("conv", "begin", "audit", "cost", "illegal", "kept", "seq", "role")}
            for p, (i, j) in enumerate(pieces):
                goes_on = j == len(rows) and row["costs"] is not None
                q, last = (start or 0, row["initial_before"]) if p == 0 else (0, None)
                behind = backward("".join(kinds[i:j]), costs if goes_on else END)
                audit, cost, illegal, kept, seq, role = "", 0, 0, [], [], []
                for k in range(i, j):
                    letters, after, paid = trace(q, kinds[k], behind[k - i])
                    for n, letter in enumerate(letters):
                        if letter != "D":
                            q = NEXT[q, kinds[k].lower()] if letter == "K" else GROWS[q]
                            kept.append(rows[k]["key"] if letter != "I" else None)
                            seq.append(8 * rows[k]["pos"] + n)
                            role.append(ROLES[q] if letter != "K" else None)
                    assert q == after
                    audit, cost = audit + letters, cost + paid
                    illegal += last is not None and last + rows[k]["initial"] not in LEGAL
                    last = rows[k]["initial"]
                if not goes_on:
                    letters, paid = trailing(q)
                    for n, _ in enumerate(letters):
                        q = GROWS[q]
                        kept.append(None)
                        seq.append(8 * rows[j - 1]["pos"] + 4 + n)
                        role.append(ROLES[q])
                    audit, cost = audit + letters, cost + paid
                for name, value in (("conv", rows[i]["conv"]), ("begin", rows[i]["pos"]), ("audit", audit), ("cost", cost), ("illegal", illegal), ("kept", kept), ("seq", seq), ("role", role)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["conv"], pa.string()), pa.array(out["begin"], pa.int64()), pa.array(out["audit"], pa.string()), pa.array(out["cost"], pa.int64()),
                pa.array(out["illegal"], pa.int64()), pa.array(out["kept"], pa.list_(pa.binary())), pa.array(out["seq"], pa.list_(pa.int64())), pa.array(out["role"], pa.list_(pa.string()))], list(out))


EDITS = "conv string, begin long, audit string, cost long, illegal long, kept array<binary>, seq array<long>, role array<string>"


def begin_states(ends: DataFrame) -> DataFrame:
    """chunk, state: that of each chunk which begins within a conversation. ``ends``: chunk,
    ends (state behind it by the one before it), to. The chunks of one conversation are strung
    together in doubling steps, so a long one isn't walked chunk by chunk."""
    # Maps from the state before a chunk to that before the chunk ``to``.
    hops = stored(ends.filter("to IS NOT NULL"), "turns-hops")
    # A chain begins where no chunk leads to; the state there is 0 (its first conversation ends or begins in it).
    known = hops.join(hops.select(F.col("to").alias("chunk")), "chunk", "left_anti").select("chunk", F.lit(0).alias("state"))
    known = stored(known, "turns-known")
    while True:
        reached = known.join(hops, "chunk").select(F.col("to").alias("chunk"), F.element_at("ends", F.col("state") + 1).alias("state"))
        more = reached.join(known.select("chunk"), "chunk", "left_anti")
        grown = stored(known.unionByName(more), "turns-known")
        onward = hops.select(F.col("chunk").alias("to"), F.col("ends").alias("then"), F.col("to").alias("next"))
        hops = stored(hops.join(onward, "to").select("chunk", F.transform("ends", lambda q: F.element_at("then", q + 1)).alias("ends"), F.col("next").alias("to")), "turns-hops")
        known = grown
        if hops.isEmpty():
            return known


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each piece of a conversation, in the columns of EDITS. ``rows``: as
    ``faults`` returns them. ``kept`` has the digests of the rows that stay (null: an inserted
    one), ``seq`` their order and ``role`` their new role, if any."""
    chunked = stored(chunks(rows), "turns-chunks")
    links = stored(open_ends(chunked), "turns-links")
    costs = stored(boundary_costs(chunked, links), "turns-costs")
    whole = chunked.join(links, "chunk").join(costs, "chunk", "left")
    linked = whole.filter("to IS NOT NULL OR initial_before IS NOT NULL").withColumn("state", F.lit(None).cast("int"))
    ends = linked.mapInArrow(lambda batches: traced(batches, True), "chunk long, ends array<int>")
    states = begin_states(ends.join(links.select("chunk", "to"), "chunk"))
    return stored(whole.join(states, "chunk", "left").mapInArrow(lambda batches: traced(batches, False), EDITS), "turns-edits")


def repaired_rows(rows: DataFrame, edited: DataFrame, *by: str) -> DataFrame:
    """conv, seq, role, text: the repaired conversations, in any order. Rows and texts meet
    in partitions by ``by``: conv, key if none is given."""
    stays = edited.select("conv", F.posexplode("kept").alias("i", "key"), "seq", "role").select("conv", "key", F.expr("seq[i]").alias("seq"), F.expr("role[i]").alias("new_role"))
    inserted = F.col("key").isNull()
    # An inserted row has a key of its own and its text at once.
    stays = stays.select("conv", F.coalesce("key", F.concat(F.lit("inserted row "), F.col("seq").cast("string")).cast("binary")).alias("key"), "seq", "new_role", F.lit(None).cast("string").alias("role"), F.when(inserted, "").alias("text"))
    texts = rows.select("conv", text_key(F.col("role"), F.col("text")).alias("key"), F.lit(None).cast("long").alias("seq"), F.lit(None).cast("string").alias("new_role"), "role", "text")
    # Repeated rows of a conversation have one key, and one of them stays at most.
    met = stays.unionByName(texts).repartition(*(by or ("conv", "key"))).groupBy("conv", "key").agg(*(F.max(c).alias(c) for c in ("seq", "new_role", "role", "text")))
    return met.filter("seq IS NOT NULL").select("conv", "seq", F.coalesce("new_role", "role").alias("role"), "text")


def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, repaired_sha256 of rows that come in order, conversation by conversation: only a
    hash's state is held, whatever the length of a conversation."""
    last, own = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([own.hexdigest()])], ["conv", "repaired_sha256"])

    for batch in batches:
        for conv, role, text in zip(batch.column(0).to_pylist(), raw(batch.column(2)), raw(batch.column(3))):
            if conv != last:
                if own is not None:
                    yield out()
                last, own = conv, hashlib.sha256()
            else:
                own.update(b"\n")
            own.update(role + b":" + text)
    if own is not None:
        yield out()


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``conversations`` (conv_id, turn, role, text; other columns are ignored) after damage:
    its rows (see ``damaged``), their order and faults (``faults``) and their edits (``edits``)."""
    rows = damaged(conversations)
    judged = stored(faults(ordered_rows(rows)), "turns-judged")
    return rows, judged, edits(judged)


def audit(conversations: DataFrame) -> DataFrame:
    """A row per conv_id of ``conversations``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    A null conv_id is a conversation of its own; a null role or text is one space, and a null
    turn comes before all others. Roles count by their first character; one that isn't s, u
    or a can't be kept. Rows of one turn are ordered by the digest of role and text, a
    damaged row's copy right behind it; repeated rows are duplicates. Blank and empty texts are blank,
    very long ones travel once, at the end. An empty table gives an empty result.

    The hash of a conversation is one sequential function of all its text, so its rows go in
    order through one task, which holds the hash's state only; its audit is one value
    of a letter a row. All else is spread over chunks.
    """
    rows, judged, edited = repair(conversations)
    turns = judged.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *(F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")))
    sums = edited.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("begin", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    # Partitioned by conversation already: only sorted.
    digests = repaired_rows(rows, edited, "conv").sortWithinPartitions("conv", "seq").mapInArrow(hashes, "conv string, repaired_sha256 string")
    all_ids = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    out = all_ids.join(turns, "conv", "left").join(sums, "conv", "left").join(digests, "conv", "left")
    return out.select(
        F.nullif("conv", F.lit(" ")).cast("long").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
