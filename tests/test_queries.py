"""Every query with a SQL equivalent, on the smallest tables; plan checks."""

import importlib.util
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check  # noqa: E402

from queries import registry  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    import duckdb

    db = duckdb.connect()
    for t in check.TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    text, _, good = check.compare(spark, con, str(SF), name)
    assert good and "TYPES" not in text, text


def test_contract():
    spec = importlib.util.spec_from_file_location("entry_module", SF.parent.parent / "repo/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_needs_no_join(spark):
    plan = plan_of(registry.QUERIES["hourly_grid"](spark, str(SF)))
    assert "Join" not in plan
    assert plan.count("FileScan parquet") == 1


def test_parts_read_their_own_rows_only(spark):
    plan = plan_of(registry.QUERIES["tagged_union"](spark, str(SF)))
    assert plan.count("FileScan parquet") == plan.count("PushedFilters: [IsNotNull(ts)") == 2


def test_midnight_values_need_one_scan(spark):
    plan = plan_of(registry.QUERIES["midnight_pick"](spark, str(SF)))
    assert "Join" not in plan and plan.count("FileScan parquet") == 1


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(registry.QUERIES["calendar_spine"](spark, str(SF)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_chunked_fill_never_windows_rows_by_series_alone(spark):
    """Rows are windowed inside (series, chunk); by series only chunk summaries are."""
    from seriesloom.operators import gaps

    ts = "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, int(id)) AS ts"
    df = spark.range(10).selectExpr("'a' AS k", ts, "double(id) AS v")
    plan = plan_of(gaps.forward_fill(df, ["k"], "ts", ["v"], chunk="day"))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("__last_v" in w for w in windows) == 1 and sum("__chunk" in w for w in windows) == 2


def test_three_tables_align_in_one_shuffle(spark):
    from seriesloom.operators.predictions import outer_align

    parts = [spark.range(5).selectExpr("id", f"id AS v{i}") for i in range(3)]
    assert plan_of(outer_align(parts, ["id"])).count("Exchange") == 1


def test_a_hot_series_is_reduced_before_any_shuffle(spark):
    """Map-side partial sums: a third of all events in one series costs a row per hour and task."""
    plan = plan_of(registry.QUERIES["tagged_union"](spark, str(SF)))
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges and all("partial_count" in lines[i + 1] for i in exchanges)
