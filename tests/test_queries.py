import pytest
from compare import DATA, database, rows

from tramline.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLES:
        expected = database().execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows(got) == rows(expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_pings_are_shuffled_once_for_dedup_and_gaps(spark):
    from tramline.plans.registry import gap_rows

    plan = gap_rows(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    # besides, each vehicle's last ping of each day: one row for both, combined before the shuffle
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("partial_max_by") == 1
