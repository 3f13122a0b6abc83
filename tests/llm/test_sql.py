import pytest

from editloom.llm.queries import QUERIES
from editloom.llm.sql import SQL
from tests.oracle import connection, of_duckdb, of_spark


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name, scale):
    d = f"/root/testdata/{scale}"
    columns, got = of_spark(QUERIES[name](spark, d))
    want_columns, want = of_duckdb(connection(d), SQL[name])
    assert columns == want_columns
    assert len(got) == len(want) > 0
    assert [x for x in zip(got, want, strict=True) if x[0] != x[1]][:2] == []
