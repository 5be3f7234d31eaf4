"""Every registered query of the engine's own operators against its SQL."""

import pytest

from gapwise import catalogue
from tests.conftest import DATA
from tests.helpers import rows


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(catalogue.ORACLES[name]).df())


def test_no_query_is_vacuous(duck):
    """Two need more events than the smallest size has."""
    empty = {n for n, q in catalogue.ORACLES.items() if duck.execute(f"SELECT count(*) FROM ({q})").fetchone()[0] == 0}
    assert empty <= {"cycle_tensor", "session_overlap"}


def test_selected_cycles_are_ranked_and_repeatable(spark):
    got = catalogue.QUERIES["selected_cycles"](spark, DATA).toPandas()
    taken = got[got.selection_rank.notna()]
    assert sorted(taken.selection_rank) == list(range(1, len(taken) + 1))
    again = catalogue.QUERIES["selected_cycles"](spark, DATA).toPandas()
    assert rows(got) == rows(again)


@pytest.mark.parametrize(("name", "most"), [("sessions", 2), ("cycles", 2), ("signal_quality", 4), ("nearest_value", 4), ("cycle_validation", 8)])
def test_plans_read_few_tables(spark, name, most):
    plan = catalogue.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") + plan.count("BatchScan") <= most


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scan_pushes_filters_and_prunes_columns(spark):
    plan = catalogue.bounded_scan(spark, DATA)._jdf.queryExecution().toString()
    assert "EqualTo(event_type,click)" in plan and "GreaterThanOrEqual(ts," in plan
    assert "user_id" not in plan.split("ReadSchema")[-1] and "props" not in plan.split("ReadSchema")[-1]


def test_interval_join_is_an_equi_join(spark):
    plan = catalogue.cycle_measurements(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
