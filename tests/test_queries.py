"""Every registered query against its SQL on the driver's smallest tables, where they are there."""

import os

import duckdb
import pytest
from framelake.plans import registry, views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(frame):
    def text(v):
        if v is None or v != v:
            return "-"
        if isinstance(v, str):
            return v
        return repr(bool(v)) if str(v) in ("True", "False") else repr(float(v))

    columns = sorted(frame.columns)
    return columns, sorted(tuple(text(v) for v in r) for r in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in views.BASE:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(registry.ORACLES[name]).fetchdf())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).count() == 1


def test_provenance_is_parsed_once(spark):
    plan = registry.QUERIES["x07_provenance"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("from_json(") == 1


def test_decisions_are_parsed_once(spark):
    plan = registry.QUERIES["s15_decision_files"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("StructsToJsonEvaluator(") == 1


def test_responses_are_searched_and_described_once(spark):
    plan = registry.QUERIES["l08_rejection_messages"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SchemaOfVariant") == 1 and plan.count("Contains(content") == 1  # of items only; fenced blocks are sought only where there are fences


def test_deletion_of_events_sorts_and_broadcasts_nothing(spark):
    plan = registry.QUERIES["m04_delete_events"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") >= 5 and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
