import re

import pytest

import __spark_entry__ as contract
from tarmac.plans.staging import stg_flights
from tarmac.registry.binding import Tables

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql_and_a_survey_id():
    queries, oracles = contract.QUERIES, contract.ORACLES
    assert set(queries) == set(oracles) and set(queries) <= set(contract.queries())
    assert all(re.match(r"[a-z]\d\d_[a-z0-9_]+$", key) for key in queries)
    for prefix, n in (("m", 14), ("d", 14), ("q", 12)):
        assert [f"{prefix}{i:02d}" for i in range(1, n + 1)] == sorted({k[:3] for k in queries if re.match(prefix + r"\d", k)})


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_written_tables_are_reused_and_follow_the_source(spark):
    tables = Tables(spark, SF)
    first = tables.bronze_flights().inputFiles()
    assert Tables(spark, SF).bronze_flights().inputFiles() == first


@pytest.mark.parametrize("key, columns", [
    ("m08_mart_kpis_monthly", 9), ("m11_mart_route_monthly", 9), ("m13_mart_weather_impact", 6), ("m06_dim_carrier", 1),
])
def test_marts_read_only_their_columns(spark, key, columns):
    df = contract.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?silver", plan.toString())
    assert scans and all(len(s.split(",")) <= columns + 1 for s in scans), scans


def test_date_filters_reach_the_scan_through_the_dedup(spark):
    df = stg_flights(Tables(spark, SF).bronze_flights()).filter("flight_date = date '2024-01-05'").select("origin")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("2024-01-05") or "19727" in plan[plan.index("Window"):]


@pytest.mark.parametrize("key", [
    "d06_airline_ranking", "d07_hub_month", "d08_most_delayed_hubs", "d09_most_punctual_hubs", "d13_busiest_routes",
    "d14_least_punctual_busy_routes",
])
def test_a_month_is_read_from_its_folder(spark, key):
    plan = contract.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("ym" in f and "202402" in f for f in filters), filters


def test_the_quality_report_scans_each_large_table_few_times(spark):
    df = contract.queries()["q12_quality_report"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 22 and plan.count("silver-") <= 6


class DoubledWeather(Tables):
    def stg_weather(self):
        return super().stg_weather().union(super().stg_weather())


class LostFlight(Tables):
    def int_flights_weather(self, *flights):
        return super().int_flights_weather(*flights).filter("flight_number <> '3'")


def few_rows(spark, folder):
    """Ten flights from one airport on one day, and its weather of every hour."""
    rows = {
        "nation": spark.range(2).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name", "0 as n_regionkey"),
        "customer": spark.range(1).selectExpr("id as c_custkey", "1 as c_nationkey"),
        "supplier": spark.range(1).selectExpr("id as s_suppkey", "0 as s_nationkey"),
        "orders": spark.range(1, 11).selectExpr("id as o_orderkey", "0L as o_custkey"),
        "lineitem": spark.range(1, 11).selectExpr(
            "id as l_orderkey", "1L as l_linenumber", "0L as l_suppkey", "1L as l_partkey", "timestamp_ntz '1995-01-01' as l_shipdate",
            "50D as l_quantity", "1000D as l_extendedprice"),
        "events": spark.range(24).selectExpr(
            "id as event_id", "0L as user_id", "make_timestamp_ntz(2024, 1, 1, cast(id as int), 0, 0) as ts", "'view' as event_type",
            "1D as value"),
    }
    for name, df in rows.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("kind, rows, repeated", [(Tables, 10, 0), (DoubledWeather, 20, 10), (LostFlight, 9, 0)])
def test_the_quality_report_holds_the_facts_against_the_staged_flights(spark, tmp_path, kind, rows, repeated):
    from tarmac.plans import quality
    from tarmac.registry.models import _checked_tables

    tables = _checked_tables(kind(spark, few_rows(spark, tmp_path)))
    assert tables["stg_flights"].count() == 10 and tables["fct_flights"].count() == rows
    found = {(r.check_name, r.table_name): r.violations for r in quality.report(tables).filter(
        "check_name in ('unique', 'same_row_count') and table_name in ('stg_flights', 'fct_flights')").collect()}
    assert found == {
        ("unique", "stg_flights"): 0, ("unique", "fct_flights"): repeated, ("same_row_count", "fct_flights"): int(rows != 10)}
