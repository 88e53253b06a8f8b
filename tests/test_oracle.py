"""Every registered query against its DuckDB twin (the driver's correctness gate), on sf0.001."""

import pytest

import __spark_entry__ as E
from relayout.oracle import SQL
from compare import compare, duck
from conftest import SMOKE

NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_a_twin():
    own = {n for n in E.queries() if not n.startswith("op") and n != "pipeline"}
    assert set(SQL) == own and own <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "ts", "user_id", "value", "event_date", "event_hour", "event_type"]
