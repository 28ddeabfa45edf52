"""Revisions on a stream: late rows within the delay count, later ones don't, and the state is the open windows only."""

from datetime import datetime, timedelta

from panelmerge.streaming.revisions import append_final, final_revisions

SCHEMA = "k string, t timestamp, rev int, v double"
DAY = datetime(2024, 1, 1)


def row(k, day, rev, v, hour=5):
    return (k, None if day is None else DAY + timedelta(days=day, hours=hour), rev, v)


def test_final_revisions_and_bounded_state(spark, tmp_path):
    inbox, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    batches = [
        [row("a", 0, 1, 1.0), row("a", 0, 2, 2.0, hour=7), row("b", 0, 1, 5.0), row("a", 0, None, 9.0), row(None, 0, 3, 1.0), row("c", None, 1, 1.0)],
        [row("b", 0, 2, 6.0), row("a", 1, 1, 3.0)],  # b is revised in time
        [row("a", 9, 1, 4.0), row("b", 9, 1, None)],  # day 0 and 1 are past the delay after this
        [row("a", 0, 9, 99.0), row("a", 8, 1, 7.0), row("a", 9, 1, 4.5)],  # too late; in time; a tie by value
        *[[row(k, 20 + i, 1, float(i)) for k in "abcd"] for i in range(6)],
    ]
    states = []
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        query = append_final(final_revisions(stream, ["k"], "t", "rev", ["v"], "1 day", "3 days"), out, ckpt)
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {(r.k, (r.window_start - DAY).days): (r.rev, r.v) for r in spark.read.parquet(out).collect()}
    assert got[("a", 0)] == (2, 2.0) and got[("b", 0)] == (2, 6.0) and got[("a", 1)] == (1, 3.0)
    assert got[("a", 8)] == (1, 7.0) and got[("a", 9)] == (1, 4.5) and got[("b", 9)] == (1, None)
    assert spark.read.parquet(out).count() == len(got) and {k for k, _ in got} == {"a", "b", "c", "d"}
    assert max(states[4:]) <= 4 * 5  # four keys in the windows that are still open, however many days went by


def test_on_a_table_every_window_is_final(spark):
    df = spark.createDataFrame([row("a", 0, 1, 1.0), row("a", 0, 2, 0.5), row("a", 40, 1, 3.0)], SCHEMA)
    got = sorted((r.k, (r.window_start - DAY).days, r.rev, r.v) for r in final_revisions(df, ["k"], "t", "rev", ["v"]).collect())
    assert got == [("a", 0, 2, 0.5), ("a", 40, 1, 3.0)]
    assert final_revisions(df.limit(0), ["k"], "t", "rev", ["v"]).count() == 0
