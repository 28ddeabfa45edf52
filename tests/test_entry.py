"""Every registered query against its DuckDB oracle at sf0.001 (the driver
does the same at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _norm(df):
    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False):
        row = []
        for v in r:
            if v is None or (isinstance(v, float) and math.isnan(v)):
                row.append("NULL")
            elif isinstance(v, float):
                row.append(repr(round(v, 6)))
            else:
                row.append(repr(v.item() if hasattr(v, "item") else v))
        out.append("|".join(row))
    return sorted(out)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["user_id", "name", "day"]
    assert df.count() >= 0


def test_every_query_has_oracle():
    assert set(E._QUERIES) <= set(E.queries()) and set(E._QUERIES) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _norm(got) == _norm(exp)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_column_types_match_oracle(spark, con):
    bad = {}
    for name in E._QUERIES:
        fn = E.queries()[name]
        got = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in fn(spark, SF).schema.fields}
        rel = con.sql(E.oracle_sql()[name])
        exp = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if got != exp:
            bad[name] = (got, exp)
    assert bad == {}
