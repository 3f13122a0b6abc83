import pytest

from editloom.plans import catalogue
from tests.oracle import connection, of_duckdb, of_spark

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name not in catalogue.SQL:
        assert df.count() > 0
        return
    columns, got = of_spark(df)
    want_columns, want = of_duckdb(con, catalogue.SQL[name])
    assert columns == want_columns
    assert len(got) == len(want) > 0
    assert [x for x in zip(got, want, strict=True) if x[0] != x[1]][:2] == []
