"""Every registered query against its SQL counterpart."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

from ferryline.plans.oracles import ORACLES
from ferryline.plans.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = sql_rows(db, ORACLES[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    different = [(a, b) for a, b in zip(rows, wanted) if a != b]
    assert not different, different[:5]
