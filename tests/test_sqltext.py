"""Generated SQL text survives awkward identifiers and literals."""

from panelmerge.functions.sqltext import lit, num, q
from panelmerge.operators import stats
from panelmerge.operators.merge import long_to_panel


def test_quoting_helpers():
    assert q("a`b") == "`a``b`"
    assert lit("it's") == "'it\\'s'" and lit("a\\b") == "'a\\\\b'" and lit(3) == "3" and lit(None) == "NULL"
    assert num(1) == "CAST(1.0 AS DOUBLE)"


def test_awkward_names_round_trip(spark):
    rows = [(1, "it's", 1.0), (1, "back\\slash", 2.0), (2, "it's", 3.0), (2, "tick`s", 5.0)]
    lng = spark.createDataFrame(rows, "k int, `src col` string, `va``l` double")
    wide = long_to_panel(lng, ["k"], "src col", "va`l",
                         {"it's": "m 'one'", "back\\slash": "m`two", "tick`s": "m3"})
    got = {r["k"]: (r["m 'one'"], r["m`two"], r["m3"]) for r in wide.collect()}
    assert got == {1: (1.0, 2.0, None), 2: (3.0, None, 5.0)}
    fill = {r.column: r.present for r in stats.column_fill(wide, wide.columns).collect()}
    assert fill == {"k": 2, "m 'one'": 2, "m`two": 1, "m3": 1}
    b = {r.column: r.out_of_bounds for r in stats.bounds_check(wide, ["m 'one'", "m`two"], 1.5, 2.5).collect()}
    assert b == {"m 'one'": 2, "m`two": 0}
    pa = stats.pair_agreement(wide, [("m 'one'", "m`two", "o'ne vs two")]).first()
    assert (pa.pair, pa.n, pa.mean_abs) == ("o'ne vs two", 1, 1.0)
