import pytest

import __spark_entry__
from kymo.plans import registry
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    same(spark, sf_dir, registry.QUERIES[name], registry.ORACLE[name])


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
