"""The data-quality suite: declared rules, one pass per table, one row per check."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.checks import outside_range, outside_values, summary
from tarmac.operators.joins import BROADCAST_BYTES, ROW_BYTES, join_lookup
from tarmac.schemas import CANCELLATION_REASONS, DELAY_CAUSES, WEATHER_CLASSES


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows; ``violation`` builds a never-NULL boolean."""

    table: str
    column: str
    check: str
    violation: Callable[[], Column]


def _not_null(table: str, *columns: str) -> list[RowRule]:
    return [RowRule(table, c, "not_null", lambda c=c: F.col(c).isNull()) for c in columns]


def _values(table: str, column: str, values) -> RowRule:
    return RowRule(table, column, "accepted_values", lambda: outside_values(column, values))


def _range(table: str, column: str, low, high) -> RowRule:
    return RowRule(table, column, "accepted_range", lambda: outside_range(column, low, high))


def arrival_after_cancellation() -> Column:
    known = F.col("arr_delay_min").isNotNull() | F.col("is_arr_delayed").isNotNull()
    return F.coalesce(F.col("is_cancelled") & known, F.lit(False))


def negative_cause() -> Column:
    return F.coalesce(F.least(*DELAY_CAUSES.values()) < 0, F.lit(False))


ROW_RULES: list[RowRule] = [
    *_not_null("bronze_flights", "flight_date", "carrier_code"),
    *_not_null("stg_flights", "flight_id", "flight_date", "origin", "dest"),
    _range("stg_flights", "scheduled_dep_hour", 0, 23),
    _values("stg_flights", "cancellation_code", list(CANCELLATION_REASONS)),
    _range("stg_flights", "distance_miles", 0, 6000),
    *_not_null("stg_weather", "airport_code"),
    _range("stg_weather", "precipitation_mm", 0, 200),
    *_not_null("fct_flights", "flight_id"),
    _values("fct_flights", "cancellation_reason", list(CANCELLATION_REASONS.values())),
    _values("fct_flights", "weather_condition", WEATHER_CLASSES),
    RowRule("fct_flights", "arr_delay_min", "cancelled_without_arrival", arrival_after_cancellation),
    RowRule("fct_flights", "delay_causes", "non_negative", negative_cause),
    *_not_null("dim_carrier", "carrier_code"),
    *_not_null("dim_airport", "airport_code"),
    *_not_null("dim_date", "date_key"),
    *_not_null("mart_kpis_monthly", "year_month"),
    _range("mart_kpis_monthly", "on_time_pct", 0, 100),
    _range("mart_carrier_monthly", "on_time_pct", 0, 100),
    _values("mart_delay_causes_monthly", "cause", list(DELAY_CAUSES)),
]

UNIQUE = {
    "stg_flights": "flight_id",
    "fct_flights": "flight_id",
    "dim_carrier": "carrier_code",
    "dim_airport": "airport_code",
    "dim_date": "date_key",
    "mart_kpis_monthly": "year_month",
    "mart_hourly_profile": "scheduled_dep_hour",
}

# child table, child column, parent table, parent column
RELATIONSHIPS = [
    ("fct_flights", "carrier_code", "dim_carrier", "carrier_code"),
    ("fct_flights", "origin_code", "dim_airport", "airport_code"),
    ("fct_flights", "dest_code", "dim_airport", "airport_code"),
    ("fct_flights", "date_key", "dim_date", "date_key"),
]


def _line(check: str, table: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        violations.cast("long").alias("violations"))


def row_report(df: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
    """All row rules of one table and its rows (check ``rows``), in one pass over the columns they name."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.violation()).alias(f"_{i}") for i, r in enumerate(rules)])
    lines = [_line(r.check, r.table, r.column, F.col(f"_{i}")) for i, r in enumerate(rules)]
    return counted.select(F.inline(F.array(_line("rows", table, "*", F.col("_rows")), *lines)))


def hashed_keys(df: DataFrame, column: str) -> DataFrame:
    """The keys that are there, and 64 bits of hash of each (``h``)."""
    return df.filter(F.col(column).isNotNull()).select(F.col(column).alias("key"), F.xxhash64(column).alias("h"))


def repeated_keys(df: DataFrame, column: str) -> tuple[int, tuple]:
    """How many key values occur more than once, and a mark of the whole set of keys (number, xor of hashes).

    Hashes are grouped, not texts. Only if some repeat are the keys behind them grouped, and only those; they
    are combined where they lie, unless more hashes repeat than every task can hold.
    """
    keys = hashed_keys(df, column)
    groups = keys.groupBy("h").agg(F.count(F.lit(1)).alias("rows"))
    odd = F.when(F.col("rows") % 2 == 1, F.col("h"))
    again, rows, mark = groups.agg(F.count_if(F.col("rows") > 1), F.sum("rows"), F.bit_xor(odd)).first()
    if not again:
        return 0, (rows, mark)
    behind = join_lookup(keys, groups.filter("rows > 1").select("h"), "h", "left_semi", again * ROW_BYTES <= BROADCAST_BYTES)
    repeated = behind.groupBy("h", "key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").count()
    return repeated, (rows, mark)


def repeated_elsewhere(df: DataFrame, column: str, others: int, mark: tuple) -> int:
    """The same of a table that should hold the keys of another one, of which ``repeated_keys`` is known.

    Where those are unique and both marks agree, the keys are the same and there is nothing to group.
    """
    if not others and tuple(hashed_keys(df, column).agg(F.nullif(F.count(F.lit(1)), F.lit(0)), F.bit_xor("h")).first()) == mark:
        return 0
    return repeated_keys(df, column)[0]


def unique_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Key values that occur more than once, of all tables with a key.

    The flights' and the facts' keys are looked at here and now, by hashes; those of the small tables in one lazy grouping.
    """
    spark = next(iter(tables.values())).sparkSession
    flights, mark = repeated_keys(tables["stg_flights"], UNIQUE["stg_flights"])
    facts = repeated_elsewhere(tables["fct_flights"], UNIQUE["fct_flights"], flights, mark)
    large = spark.range(1).select(F.inline(F.array(*[
        _line("unique", t, UNIQUE[t], F.lit(n)) for t, n in (("stg_flights", flights), ("fct_flights", facts))])))
    keys = reduce(DataFrame.unionByName, [
        tables[t].select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key"))
        for t, c in UNIQUE.items() if t not in ("stg_flights", "fct_flights")])
    repeated = keys.filter(F.col("key").isNotNull()).groupBy("table_name", "column_name", "key").agg(
        F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return repeated.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("unique").alias("check_name"), "table_name", "column_name", "violations").unionByName(large)


def relationship_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose key has no parent, for all relationships in one pass over the child table.

    The child is grouped by all its keys together, the groups are taken apart key by key,
    and one anti-join meets the keys of all parents.
    """
    children = {child for child, *_ in RELATIONSHIPS}
    parts = []
    for child in children:
        own = [r for r in RELATIONSHIPS if r[0] == child]
        grouped = tables[child].groupBy(*[key for _, key, _, _ in own]).agg(F.count(F.lit(1)).alias("rows"))
        apart = grouped.select("rows", F.inline(F.array(*[
            F.struct(F.lit(child).alias("table_name"), F.lit(key).alias("column_name"), F.col(key).cast("string").alias("key"))
            for _, key, _, _ in own])))
        parts.append(apart.filter(F.col("key").isNotNull()).groupBy("table_name", "column_name", "key").agg(
            F.sum("rows").alias("rows")))
    parents = reduce(DataFrame.unionByName, [
        tables[parent].select(F.lit(child).alias("table_name"), F.lit(key).alias("column_name"),
                              F.col(parent_key).cast("string").alias("key"))
        for child, key, parent, parent_key in RELATIONSHIPS])
    lost = reduce(DataFrame.unionByName, parts).join(parents, ["table_name", "column_name", "key"], "left_anti")
    return lost.groupBy("table_name", "column_name").agg(F.sum("rows").alias("violations")).select(
        F.lit("relationships").alias("check_name"), "table_name", "column_name", "violations")


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check of the suite with its number of violations.

    One pass per table for its row rules and row count, the keys by hashes, one pass over
    the facts for all relationships. Give written tables, not long lazy plans.
    """
    by_table: dict[str, list[RowRule]] = defaultdict(list)
    for rule in ROW_RULES:
        by_table[rule.table].append(rule)
    counted = reduce(DataFrame.unionByName, [row_report(tables[name], name, rules) for name, rules in by_table.items()])
    # The difference of the two row counts: one is added, the other taken away.
    signed = F.when(F.col("table_name") == "fct_flights", F.col("violations")).otherwise(-F.col("violations"))
    same = (F.col("check_name") == "rows") & F.col("table_name").isin("stg_flights", "fct_flights")
    counted = counted.filter((F.col("check_name") != "rows") | same).select(
        F.when(same, "same_row_count").otherwise(F.col("check_name")).alias("check_name"),
        F.when(same, "fct_flights").otherwise(F.col("table_name")).alias("table_name"), "column_name",
        F.when(same, signed).otherwise(F.col("violations")).alias("violations"))
    none = [_line("unique", t, c, F.lit(0)) for t, c in UNIQUE.items()]
    none += [_line("relationships", child, key, F.lit(0)) for child, key, _, _ in RELATIONSHIPS]
    spark = next(iter(tables.values())).sparkSession
    zeros = spark.range(1).select(F.inline(F.array(*none)))
    parts = [counted, unique_report(tables), relationship_report(tables), zeros]
    total = reduce(DataFrame.unionByName, parts).groupBy("check_name", "table_name", "column_name").agg(
        F.sum("violations").alias("violations"))
    differ = (F.col("violations") != 0).cast("long")
    return total.withColumn("violations", F.when(
        F.col("check_name") == "same_row_count", differ).otherwise(F.col("violations")).cast("long"))


def hhmm_summary(bronze: DataFrame) -> DataFrame:
    """Clock numbers of bronze outside 0..2400."""
    columns = ["crs_dep_time", "dep_time", "crs_arr_time", "arr_time"]
    return summary(bronze, reduce(lambda a, b: a | b, [outside_range(c, 0, 2400) for c in columns]))


def seed_summary(hubs: DataFrame) -> DataFrame:
    """Hub rows, distinct codes, and rows whose coordinates lie outside the covered area."""
    off = outside_range("latitude", 18, 72) | outside_range("longitude", -170, -60)
    return hubs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("airport_code").alias("codes"),
        F.count_if(off).alias("violations"),
    )


def incomplete_weather(weather: DataFrame, hubs: DataFrame) -> DataFrame:
    """Hub months that do not hold exactly one row for each hour of the month."""
    month = F.trunc(F.col("weather_hour").cast("date"), "month")
    counted = weather.join(hubs.select("airport_code"), "airport_code", "left_semi").groupBy(
        "airport_code", month.alias("month_start")
    ).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("weather_hour").alias("hours"))
    expected = (F.dayofmonth(F.last_day("month_start")) * 24).cast("long")
    return counted.withColumn("expected", expected).filter(
        (F.col("rows") != F.col("expected")) | (F.col("hours") != F.col("expected"))
    )


def missing_hours(weather: DataFrame, hubs: DataFrame) -> DataFrame:
    """The hub hours that lack, of every month that holds any hour of any hub: ``airport_code``, ``weather_hour``.

    What is expected is hubs x hours of those months, made by tasks, a row per hub and month before it is spread.
    """
    hours = weather.select("airport_code", "weather_hour").distinct()
    months = hours.select(F.trunc(F.col("weather_hour").cast("date"), "month").alias("month_start")).distinct()
    first, last = F.col("month_start").cast("timestamp_ntz"), F.add_months("month_start", 1).cast("timestamp_ntz")
    expected = months.join(F.broadcast(hubs.select("airport_code").distinct())).select(
        "airport_code",
        F.explode(F.sequence(first, last - F.expr("interval 1 hour"), F.expr("interval 1 hour"))).alias("weather_hour"))
    return expected.join(hours, ["airport_code", "weather_hour"], "left_anti")
