"""Every query with SQL gives the SQL's rows; the others run and are not empty."""

import pytest
from compare import rows, sql_rows

from newslode.plans import catalogue as C

SLOW = {"article_acceptance", "page_verification"}  # parts of daily_run and full_run


@pytest.mark.parametrize("name", sorted(C.ORACLE_SQL))
def test_matches_sql(spark, data, name):
    df = C.QUERIES[name](spark, data)
    names, want = sql_rows(C.ORACLE_SQL[name], data)
    assert sorted(df.columns) == names
    assert rows(df) == want


@pytest.mark.parametrize("name", sorted(set(C.QUERIES) - set(C.ORACLE_SQL) - SLOW))
def test_runs(spark, data, name):
    assert C.QUERIES[name](spark, data).count() > 0


def test_entry_and_keys(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
