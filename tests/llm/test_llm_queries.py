import duckdb
import pytest

from pagewright.llm import queries

SF = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(str, frame.map(lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v).values.tolist()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
