"""Every corpus query that has SQL against it, value by value."""

import pytest
from compare import connect, spark_rows, sql_rows

from ferryline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name, folder):
    columns, rows = spark_rows(QUERIES[name](spark, folder))
    wanted_columns, wanted = sql_rows(connect(folder), ORACLES[name])
    assert columns == wanted_columns and len(rows) == len(wanted)
    different = [(a, b) for a, b in zip(rows, wanted) if a != b]
    assert not different, different[:5]


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
