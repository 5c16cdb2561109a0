import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import extract_line, land_payload, land_zip, payload
from tarmac.plans import ingest, marts, quality, refresh, star
from tarmac.plans.staging import stg_flights, stg_weather
from tarmac.schemas import BRONZE_WEATHER
from tarmac.sources import lake, seeds
from tarmac.sources.lake import MARTS
from tarmac.sources.versions import read_snapshot
from tarmac.streaming.landing import stream_extracts


def some_flights(year, month, n=40):
    return [
        extract_line(
            year, month, 1 + i % 20, Flight_Number_Reporting_Airline=str(i), Reporting_Airline=["AA", "DL", "ZZ"][i % 3],
            Origin=["ATL", "DFW"][i % 2], CRSDepTime=f"{6 + i % 12:02d}30", DepDelay=str(i - 5),
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for month in (1, 2, 3):
        land_zip(root / "flights", 2025, month, some_flights(2025, month))
    for month in (1, 2):
        land_payload(root / "weather", 2025, month, payload(
            30, datetime(2025, month, 1), 24 * 28, precipitation=[float(h % 4) for h in range(24 * 28)]))
    return root


@pytest.fixture(scope="module")
def january(spark, landed, tmp_path_factory):
    """A lake that was ingested first and built by the next run."""
    root = str(tmp_path_factory.mktemp("january"))
    assert refresh.refresh(spark, str(landed), root, months=1, transform=False, today=date(2025, 2, 10)) == 40
    assert read_snapshot(spark, root) is None
    assert refresh.refresh(spark, str(landed), root, months=1, today=date(2025, 2, 10)) == 0
    assert refresh.plan_build(spark, root, seeds.carriers(spark), seeds.hub_airports(spark)) is None
    return root


@pytest.fixture
def lake_root(january, tmp_path):
    shutil.copytree(january, tmp_path / "lake")
    return str(tmp_path / "lake")


def expected_marts(spark, root):
    """The marts computed in one go from the same bronze."""
    weather = (lake.read_bronze(spark, root, "weather") if (Path(root) / "bronze" / "weather").exists()
               else spark.createDataFrame([], BRONZE_WEATHER))
    silver = star.int_flights_weather(stg_flights(lake.read_bronze(spark, root, "flights")), stg_weather(weather), True)
    facts = star.fct_flights(silver)
    carriers, airports = seeds.carriers(spark), star.dim_airport(silver, seeds.hub_airports(spark))
    return dict(zip(MARTS, [
        marts.mart_kpis_monthly(facts), marts.mart_carrier_monthly(facts, carriers),
        marts.mart_airport_daily(facts, airports), marts.mart_route_monthly(facts),
        marts.mart_delay_causes_monthly(facts), marts.mart_weather_impact(facts), marts.mart_hourly_profile(facts),
    ]))


def assert_marts(spark, root, rows):
    published = lake.read_marts(spark, root)
    for name, mart in expected_marts(spark, root).items():
        assert published[name].columns == mart.columns
        assert rows(published[name]) == rows(mart), name
    return published


def test_refresh_by_month_equals_one_full_build(spark, landed, lake_root, rows):
    assert refresh.refresh(spark, str(landed), lake_root, months=3, today=date(2025, 4, 2)) == 80
    assert lake.read_marts(spark, lake_root)["mart_weather_impact"].filter("weather_condition = 'Snow'").count() == 0
    # weather that lands late is matched on the next run, without new flights
    land_payload(landed / "weather", 2025, 3, payload(30, datetime(2025, 3, 1), 24 * 28, snowfall=[1.0] * (24 * 28)))
    assert refresh.refresh(spark, str(landed), lake_root, months=3, today=date(2025, 4, 2)) == 0
    published = assert_marts(spark, lake_root, rows)
    assert published["mart_weather_impact"].filter("weather_condition = 'Snow'").count() == 3


def test_streamed_and_directly_loaded_months_are_built(spark, landed, lake_root, tmp_path, rows):
    stream_extracts(spark, str(landed / "flights"), lake_root, str(tmp_path / "checkpoint")).awaitTermination()
    assert refresh.refresh(spark, str(landed), lake_root, months=2, today=date(2025, 3, 10)) == 0
    published = assert_marts(spark, lake_root, rows)
    assert [r.flights for r in published["mart_kpis_monthly"].orderBy("year_month").collect()] == [40, 40, 40]


def test_a_corrected_month_leaves_nothing_stale(spark, landed, tmp_path, rows):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    shutil.copytree(landed, landing)
    refresh.refresh(spark, str(landing), root, months=2, today=date(2025, 3, 10))
    no_hubs = [dict(line, Origin="BZN") for line in some_flights(2025, 2)]
    land_zip(landing / "flights", 2025, 2, no_hubs)
    refresh.refresh(spark, str(landing), root, months=2, force=True, today=date(2025, 3, 10))
    published = assert_marts(spark, root, rows)
    land_zip(landing / "flights", 2025, 2, [])  # and one that is empty
    refresh.refresh(spark, str(landing), root, months=2, force=True, today=date(2025, 3, 10))
    published = assert_marts(spark, root, rows)
    assert [r.year_month for r in published["mart_kpis_monthly"].collect()] == ["2025-01"]


def test_weather_landing_during_a_refresh_is_built(spark, landed, tmp_path, rows, monkeypatch):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    shutil.copytree(landed / "flights", landing / "flights")
    land_payload(landing / "weather", 2025, 1, payload(30, datetime(2025, 1, 1), 24 * 28))
    load = ingest.load_flights

    def slowly(*args):
        land_payload(landing / "weather", 2025, 2, payload(30, datetime(2025, 2, 1), 24 * 28))
        return load(*args)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "load_flights", slowly)
        refresh.refresh(spark, str(landing), root, months=2, today=date(2025, 3, 10))
    assert_marts(spark, root, rows)
    refresh.refresh(spark, str(landing), root, months=2, today=date(2025, 3, 10))
    assert_marts(spark, root, rows)
    facts = lake.read_table(spark, root, "gold", "fct_flights").filter("ym = 202502")
    assert facts.filter("has_weather").count() == 40


@pytest.mark.parametrize("step", ["build_marts", "append_snapshot"])
def test_an_interrupted_build_leaves_the_last_one_and_is_made_up_for(spark, landed, lake_root, monkeypatch, step):
    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, step, broken)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.refresh(spark, str(landed), lake_root, months=2, today=date(2025, 3, 10))
    flights = lambda: [r.flights for r in lake.read_marts(spark, lake_root)["mart_kpis_monthly"].collect()]
    assert flights() == [40]
    assert refresh.refresh(spark, str(landed), lake_root, months=2, today=date(2025, 3, 10)) == 0
    assert flights() == [40, 40]


def test_seeds_of_the_caller_are_used_and_their_change_is_noticed(spark, lake_root):
    renamed = seeds.carriers(spark).withColumn("carrier_name", F.concat(F.lit("The "), "carrier_name"))
    assert refresh.build(spark, lake_root, carriers=renamed) == []
    names = {r.carrier_name for r in lake.read_marts(spark, lake_root)["mart_carrier_monthly"].collect()}
    assert "The American Airlines" in names or any(n.startswith("The ") for n in names)


def test_a_second_writer_is_refused(spark, landed, lake_root):
    from tarmac.sources.versions import sole_writer

    state = Path(lake_root) / "state"
    with sole_writer(spark, lake_root):
        assert (state / "writer").read_text() == spark.sparkContext.applicationId
        with pytest.raises(RuntimeError, match="another run"):
            refresh.refresh(spark, str(landed), lake_root, months=2, today=date(2025, 3, 10))
    assert not (state / "writer").exists()
    assert refresh.refresh(spark, str(landed), lake_root, months=2, today=date(2025, 3, 10)) == 0  # the month is in bronze
    assert lake.read_marts(spark, lake_root)["mart_kpis_monthly"].count() == 2


def test_unused_folders_go_after_one_more_build(spark, landed, lake_root):
    def folders(name):
        return sorted(p.name for p in (Path(lake_root) / "gold" / name).iterdir())

    for month in (2, 3):
        refresh.refresh(spark, str(landed), lake_root, months=month, today=date(2025, month + 1, 10))
    assert folders("mart_kpis_monthly") == ["build=2", "build=3"]
    assert folders("fct_flights") == ["build=1", "build=2", "build=3"]  # a month each
    assert lake.read_table(spark, lake_root, "gold", "fct_flights").count() == 120


def test_gaps_and_empty_landings_are_errors(spark, landed, tmp_path):
    with pytest.raises(FileNotFoundError, match="2024, 12"):
        refresh.refresh(spark, str(landed), str(tmp_path / "lake"), months=3, today=date(2025, 3, 10))
    with pytest.raises(RuntimeError, match="no extract"):
        refresh.refresh(spark, str(tmp_path / "nothing"), str(tmp_path / "lake"))


def test_flights_dated_in_another_month_rebuild_that_month_only(spark, tmp_path, rows):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    for month in (1, 2):
        land_zip(landing / "flights", 2025, month, some_flights(2025, month))
    refresh.refresh(spark, str(landing), root, months=2, today=date(2025, 3, 1))
    assert lake.read_marts(spark, root)["mart_weather_impact"].count() == 0  # there is no weather at all
    stray = [extract_line(2025, 2, 27, Flight_Number_Reporting_Airline="999")]
    land_zip(landing / "flights", 2025, 3, some_flights(2025, 3) + stray)
    refresh.refresh(spark, str(landing), root, months=3, transform=False, today=date(2025, 4, 1))
    assert refresh.build(spark, root, checked=True) == [202502, 202503]
    assert_marts(spark, root, rows)
    land_zip(landing / "flights", 2025, 4, some_flights(2025, 4))
    refresh.refresh(spark, str(landing), root, months=4, transform=False, today=date(2025, 5, 1))
    assert refresh.build(spark, root, checked=True) == [202504]
    snapshot = read_snapshot(spark, root)
    assert {ym: e.version for ym, e in snapshot.months("gold", "fct_flights").items()} == {
        202501: 1, 202502: 2, 202503: 2, 202504: 3}
    published = assert_marts(spark, root, rows)
    kpis = {r.year_month: r.flights for r in published["mart_kpis_monthly"].collect()}
    assert kpis == {"2025-01": 40, "2025-02": 41, "2025-03": 40, "2025-04": 40}
    land_zip(landing / "flights", 2025, 3, some_flights(2025, 3))  # the corrected extract takes the stray back
    refresh.refresh(spark, str(landing), root, months=4, force=True, today=date(2025, 5, 1))
    assert_marts(spark, root, rows)


def test_broken_checks_stop_the_refresh(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    bad = [extract_line(2025, 3, 1, Distance="9000.00", NASDelay="-5.00", Reporting_Airline="")]
    land_zip(landing / "flights", 2025, 3, bad + some_flights(2025, 3))
    with pytest.raises(refresh.QualityError) as error:
        refresh.refresh(spark, str(landing), root, months=1, today=date(2025, 4, 1))
    broken = sorted(part.split(":")[0] for part in str(error.value).split("; "))
    assert broken == [
        "accepted_range(stg_flights.distance_miles)", "non_negative(fct_flights.delay_causes)",
        "not_null(bronze_flights.carrier_code)", "not_null(dim_carrier.carrier_code)",
    ]
    assert read_snapshot(spark, root) is None


def test_broken_checks_leave_the_published_gold(spark, landed, tmp_path, rows):
    landing, root = tmp_path / "in", str(tmp_path / "lake")
    land_zip(landing / "flights", 2025, 1, some_flights(2025, 1))
    refresh.refresh(spark, str(landing), root, months=1, today=date(2025, 2, 1))
    before = {name: rows(df) for name, df in lake.read_marts(spark, root).items()}
    land_zip(landing / "flights", 2025, 2, [dict(line, Distance="9000.00") for line in some_flights(2025, 2)])
    with pytest.raises(refresh.QualityError, match="distance_miles"):
        refresh.refresh(spark, str(landing), root, months=2, today=date(2025, 3, 1))
    assert {name: rows(df) for name, df in lake.read_marts(spark, root).items()} == before
    land_zip(landing / "flights", 2025, 2, some_flights(2025, 2))
    refresh.refresh(spark, str(landing), root, months=2, force=True, today=date(2025, 3, 1))
    assert_marts(spark, root, rows)


def test_the_suite_has_thirty_five_checks(spark, january):
    report = quality.report(refresh.lake_tables(refresh.current(spark, january))).collect()
    assert len(report) == 35 and not [r for r in report if r.violations]
    assert len({(r.check_name, r.table_name, r.column_name) for r in report}) == 35
