import pytest

from riskspark.queries import FLAGSHIP, ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, same):
    same(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_point():
    import __spark_entry__ as entry

    assert FLAGSHIP in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
