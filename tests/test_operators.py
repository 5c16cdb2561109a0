import random

import pytest
from pyspark.sql import functions as F

from tarmac import operators as op
from tarmac.operators import checks
from tarmac.operators import summary
from tarmac.plans import quality


@pytest.fixture(scope="module")
def facts(spark):
    """A skewed fixture: one key holds a third of all rows."""
    draw = random.Random(7)
    rows = [("hot" if draw.random() < 0.34 else f"k{draw.randrange(50)}", draw.randrange(1000), i) for i in range(3000)]
    return spark.createDataFrame(rows, "key string, value int, id int").repartition(6), rows


def test_latest_by_against_brute_force(facts):
    df, rows = facts
    best = {}
    for key, value, i in rows:
        best[key] = max(best.get(key, (-1, -1)), (value, i))
    got = {r.key: (r.value, r.id) for r in op.latest_by(df, ["key"], [F.desc("value"), F.desc("id")]).collect()}
    assert got == best


def test_filters_on_keys_pass_below_the_window(facts):
    df, _ = facts
    latest = op.latest_by(df, ["key"], [F.desc("value")]).filter("key = 'hot'")
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("= hot")


def test_orphans_and_unique_against_brute_force(spark, facts):
    df, rows = facts
    parents = spark.createDataFrame([(f"k{i}",) for i in range(25)], "name string")
    missing = {}
    for key, _, _ in rows:
        if key == "hot" or int(key[1:]) >= 25:
            missing[key] = missing.get(key, 0) + 1
    nulls = spark.createDataFrame([(None, 1, 1)], df.schema)
    got = {r.key: r.rows for r in op.orphans(df.union(nulls), "key", parents, "name").collect()}
    assert got == missing
    assert op.unique(df, "id").count() == 0 and op.unique(nulls.union(nulls), "key").count() == 0
    assert op.unique(df, "key").count() == len({r[0] for r in rows})


def test_checks_let_null_pass(spark):
    df = spark.createDataFrame([(None,), (0,), (10,), (11,)], "x int")
    assert [r.x for r in op.accepted_range(df, "x", 0, 10).collect()] == [11]
    assert [r.x for r in op.accepted_range(df, "x", low=1).collect()] == [0]
    assert [r.x for r in op.accepted_range(df, "x", high=9).orderBy("x").collect()] == [10, 11]
    assert op.accepted_range(df, "x").count() == 0
    assert sorted(r.x for r in op.accepted_values(df, "x", [0, 10]).collect()) == [11]
    assert op.not_null(df, "x").count() == 1
    assert op.summary(df, checks.outside_range("x", 0, 10)).first() == (4, 1)


def test_same_row_count(spark):
    five, six = spark.range(5), spark.range(6)
    assert op.same_row_count(five, five).count() == 0
    assert op.same_row_count(five, six).first() == (5, 6)
    assert op.same_row_count(five.limit(0), six).first() == (0, 6)


def test_total_level_keeps_a_null_group_apart(spark):
    df = spark.createDataFrame([("a", "x", 1), (None, "x", 2)], "k string, c string, n int")
    got = {(r.k, r.c): r.n for r in op.with_total_level(df, "k", ["c"], "ALL", [F.sum("n").alias("n")]).collect()}
    assert got == {("a", "x"): 1, (None, "x"): 2, ("ALL", "x"): 3}


def test_unpivot_drops_nulls_and_pivot_has_fixed_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, 3.0)], "id int, a double, b double")
    long = op.unpivot_named(df, ["id"], {"Late aircraft": "a", "B": "b"}, "cause", "v")
    assert sorted(tuple(r) for r in long.collect()) == [(1, "Late aircraft", 2.0), (2, "B", 3.0)]
    wide = op.pivot_fixed(long, "id", "cause", ["B", "never"], F.avg("v"))
    assert wide.columns == ["id", "B", "never"]


def test_window_helpers(spark):
    df = spark.createDataFrame([("m", "a", 1.0), ("m", "b", 3.0), ("z", "a", 0.0)], "m string, k string, v double")
    out = {(r.m, r.k): r for r in df.withColumns({
        "share": op.share_of_total("v", ["m"]), "place": op.rank_desc("v", ["m"]),
        "lift": op.uplift_over("v", F.col("k") == "a", ["m"])}).collect()}
    assert (out["m", "b"].share, out["m", "b"].place, out["m", "b"].lift) == (75.0, 1, 2.0)
    assert out["z", "a"].share is None


def test_median_is_interpolated(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 10)], "v int").withColumn("g", F.lit(1))
    assert sorted(r.v for r in op.at_least_median(df, "v", ["g"]).collect()) == [3, 10]


def test_top_k_breaks_ties_by_key_and_puts_null_last(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 1)], "k string, v int")
    assert [r.k for r in op.top_k(df, "v", "k", 3).collect()] == ["a", "b", "d"]
    assert [r.k for r in op.bottom_k(df, "v", "k", 4).collect()] == ["d", "a", "b", "c"]


@pytest.mark.parametrize("small", [True, False])
def test_lookup_join_both_ways(spark, facts, small):
    df, rows = facts
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, tag int")
    joined = op.join_lookup(df, lookup, ["key"], "left", small)
    assert joined.count() == len(rows)
    assert joined.filter("tag = 1").count() == sum(r[0] == "hot" for r in rows)


def test_broadcast_needs_a_measured_bound(spark):
    keys = spark.range(100).selectExpr("id % 10 as k")
    assert op.fits_broadcast(keys, 1000, 100) and not op.fits_broadcast(keys, 999, 100)


def test_bronze_and_weather_checks_find_planted_rows(spark):
    from datetime import datetime

    from builders import flights
    from tarmac.sources import seeds

    assert quality.hhmm_summary(flights(spark, {}, {"arr_time": 2401}, {"dep_time": None})).first() == (3, 1)
    assert tuple(quality.seed_summary(seeds.hub_airports(spark)).first()) == (30, 30, 0)
    moved = seeds.hub_airports(spark).replace({33.6407: 73.0}, subset=["latitude"]).withColumn(
        "longitude", F.when(F.col("airport_code") == "DFW", 10.0).otherwise(F.col("longitude")))
    off = [r for r in moved.collect() if not 18 <= r.latitude <= 72 or not -170 <= r.longitude <= -60]
    assert off and quality.seed_summary(moved).first().violations == len(off)
    hours = spark.createDataFrame([("ATL", datetime(2025, 2, 1 + h // 24, h % 24)) for h in range(28 * 24)], "airport_code string, weather_hour timestamp_ntz")
    hubs = seeds.hub_airports(spark)
    assert quality.incomplete_weather(hours, hubs).count() == 0
    assert quality.incomplete_weather(hours.union(hours.limit(1)), hubs).first().rows == 673
    assert quality.incomplete_weather(hours.filter("weather_hour > '2025-02-01'"), hubs).first().expected == 672
    gaps = hours.filter("weather_hour not between '2025-02-03 04:00' and '2025-02-03 06:00'")
    lacking = quality.missing_hours(gaps, hubs.filter("airport_code in ('ATL', 'DFW')"))
    assert lacking.filter("airport_code = 'DFW'").count() == 672
    assert [r.weather_hour.hour for r in lacking.filter("airport_code = 'ATL'").orderBy("weather_hour").collect()] == [4, 5, 6]


def test_keys_are_counted_by_hashes(spark, monkeypatch):
    ids = spark.createDataFrame([(str(i % 90),) for i in range(100)] + [(None,), (None,)], "flight_id string")
    unique = ids.distinct()
    n, mark = quality.repeated_keys(unique, "flight_id")
    assert n == 0 and quality.repeated_keys(ids, "flight_id")[0] == 10
    assert quality.repeated_elsewhere(unique.repartition(3), "flight_id", n, mark) == 0
    assert quality.repeated_elsewhere(ids, "flight_id", n, mark) == 10
    swapped = unique.filter("flight_id <> '7'").union(spark.createDataFrame([("8",)], "flight_id string"))
    assert quality.repeated_elsewhere(swapped, "flight_id", n, mark) == 1
    collide = lambda df, c: df.filter(F.col(c).isNotNull()).select(F.col(c).alias("key"), (F.col(c).cast("long") % 7).alias("h"))
    monkeypatch.setattr(quality, "hashed_keys", collide)  # all hashes collide: the texts decide
    assert quality.repeated_keys(unique, "flight_id")[0] == 0 and quality.repeated_keys(ids, "flight_id")[0] == 10
    empty = unique.limit(0)
    assert quality.repeated_elsewhere(empty, "flight_id", *quality.repeated_keys(empty, "flight_id")) == 0


def test_cancelled_flights_that_arrived_are_found(spark):
    rows = [(True, None, None), (True, 3.0, None), (True, None, False), (False, 3.0, True), (None, 1.0, True)]
    facts = spark.createDataFrame(rows, "is_cancelled boolean, arr_delay_min double, is_arr_delayed boolean")
    assert summary(facts, quality.arrival_after_cancellation()).first() == (5, 2)


def test_latest_where_repeated_is_latest_by_and_moves_few_rows(spark, facts, monkeypatch):
    df, _ = facts
    nulls = spark.createDataFrame([(None, 1, -1), (None, 2, -2), ("once", 3, -3)], df.schema)
    rows, order = df.union(nulls), [F.desc("value"), F.desc("id")]

    def listed(kept):
        return sorted(map(str, kept.collect()))

    for keys in (["key"], ["key", "value"], ["id"]):
        assert listed(op.latest_where_repeated(rows, keys, order)) == listed(op.latest_by(rows, keys, order))
        with monkeypatch.context() as few:  # slots shared by chance change nothing
            few.setattr("tarmac.operators.dedup.SLOTS", 64)
            assert listed(op.latest_where_repeated(rows, keys, order)) == listed(op.latest_by(rows, keys, order))
    single = spark.range(5000).selectExpr("id as key", "repeat('x', 100) as text").union(
        spark.range(3).selectExpr("id as key", "'y' as text"))
    moved = op.latest_where_repeated(single.repartition(3), ["key"], [F.desc("text")])
    assert moved.count() == 5000 and moved.filter("text = 'y'").count() == 3
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "bitmap_construct_agg" in plan


def test_keys_behind_few_hashes_are_combined_before_they_move(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(id % 700 as string) as flight_id").union(
        spark.createDataFrame([("once",), (None,), (None,)], "flight_id string"))
    again, mark = quality.repeated_keys(rows, "flight_id")
    assert again == 700 and mark[0] == 4001
