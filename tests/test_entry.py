import __spark_entry__
from framewright.plans import catalog


def test_every_sql_twin_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_has_an_sql_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_counts_every_source_once(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and sum(r.sources for r in rows) == 150
