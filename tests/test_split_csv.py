"""CSV files read by many tasks, against Spark's reader of one task a file."""

import random

import pytest
from pyspark.sql import functions as F

from panelmerge.sources.readers import read_csv_any_encoding
from panelmerge.sources.split_csv import end_state, read_csv_split


def field(rng):
    kind = rng.random()
    if kind < 0.35:
        return rng.choice(["a", "12.5", "", "x y", "pipe 5\" wide", "é"])
    inner = "".join(rng.choice(['""', "\n", ",", "text", "\r\n", " ", "é", ""]) for _ in range(rng.randint(0, 6)))
    return f'"{inner}"'


def make(path, rng, rows, columns=4, head="a,b,c,d\n", encoding="utf-8", end="\n", bom=b""):
    lines = [",".join(["k" + str(i), *(field(rng) for _ in range(columns - 1))]) for i in range(rows)]
    path.write_bytes(bom + (head.replace("\n", end) + end.join(lines) + rng.choice([end, ""])).encode(encoding))
    return str(path)


@pytest.fixture
def small_splits(spark):
    """Splits of some dozen bytes, several to a task."""
    conf = {"spark.sql.files.maxPartitionBytes": "96", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def whole(spark, path, encoding="UTF-8", header=True):
    return spark.read.option("header", header).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)


@pytest.mark.parametrize("seed,encoding,end,bom", [(1, "utf-8", "\n", b""), (2, "utf-8", "\r\n", b""), (3, "latin-1", "\n", b""), (4, "utf-8", "\n", b"\xef\xbb\xbf")])
def test_equals_the_reader_of_one_task(spark, tmp_path, small_splits, seed, encoding, end, bom):
    rng = random.Random(seed)
    path = make(tmp_path / "t.csv", rng, 40, encoding=encoding, end=end, bom=bom)
    got = read_csv_split(spark, path, order_col="at")
    assert got.columns == ["a", "b", "c", "d", "at"]
    want = [tuple(r) for r in whole(spark, path, "ISO-8859-1" if encoding == "latin-1" else "UTF-8").collect()]
    assert len(want) == 40
    # Rows, and their order in the file.
    assert [tuple(r)[:4] for r in got.orderBy("at").collect()] == want
    assert got.select("at.block").distinct().count() > 5   # many tasks read the file


def test_quotes_at_the_ends_of_splits(spark, tmp_path, small_splits):
    """Every length of the first field, so that quotes fall on every place of a split."""
    paths = []
    for shift in range(0, 96, 16):
        text = "a,b\n" + "z" * shift + ',"one\n""two""\n' + "long " * 20 + '\nend"\n' + 'x,"y"\n,"\n"\n'
        paths.append(tmp_path / f"s{shift}.csv")
        paths[-1].write_text(text, newline="")
    paths = list(map(str, paths))
    got = [tuple(r)[:2] for r in read_csv_split(spark, paths, order_col="at").orderBy("at").collect()]
    assert sorted(got, key=repr) == sorted((tuple(r) for r in whole(spark, paths).collect()), key=repr) and len(got) == 18


def test_files_of_different_headers_and_encodings(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_bytes('id,"na\nme",id\n1,é,2\n'.encode())
    (tmp_path / "in" / "two.csv").write_bytes("id,extra\n3,é\n4\n5,x,y\n\n".encode("latin-1"))
    (tmp_path / "in" / "empty.csv").write_bytes(b"")
    got = read_csv_any_encoding(spark, str(tmp_path / "in"))
    assert got.columns == ["id0", "na\nme", "id2", "id", "extra"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("1", "é", "2", None, None), (None, None, None, "3", "é"), (None, None, None, "4", None), (None, None, None, "5", "x")], key=repr)
    assert read_csv_split(spark, str(tmp_path / "in" / "empty.csv")) is None
    typed = read_csv_split(spark, str(tmp_path / "in" / "two.csv"), schema="n int, t string")
    assert sorted(map(tuple, typed.collect())) == [(3, "é"), (4, None), (5, "x")]


def test_an_open_quote_takes_the_rest_of_its_file(spark, tmp_path, small_splits):
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text('a,b\n1,2\n3,"open\n' + "4,5\n" * 60)
    got = read_csv_split(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")])
    assert got.count() == 4 and got.filter("a = '4'").count() == 0


def test_end_state():
    assert [end_state(x, 0) for x in (b"a,b", b'a,"b', b'a,"b"', b'5" x,"', b'"",""""', b'"""', b'a"b,c')] == [0, 1, 0, 1, 0, 1, 0]
    assert [end_state(x, 1) for x in (b"a,b", b'a"', b'a""', b'a"",b', b'a","', b'"')] == [1, 0, 1, 1, 1, 0]


def test_a_plan_scans_the_file_once_more_and_joins_by_broadcast(spark, tmp_path):
    path = make(tmp_path / "p.csv", random.Random(5), 50)
    plan = read_csv_split(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Scan text") == 1
    assert read_csv_split(spark, path).filter(F.col("a") == "k7").count() == 1
