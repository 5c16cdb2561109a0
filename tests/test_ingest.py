from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import extract_line, land_csv, land_payload, land_zip, payload
from tarmac import functions as fn
from tarmac.plans import ingest, rejects
from tarmac.schemas import BRONZE_FLIGHTS, EXTRACT_COLUMNS, NULL_TOKENS, WEATHER_VARIABLES
from tarmac.sources import footers, landing, lake, seeds, zips
from tarmac.streaming.landing import stream_extracts
from tarmac.streaming.weather import stream_weather


def months(spark, *pairs):
    return spark.createDataFrame(list(pairs), "year int, month int")


def listed(df):
    return sorted((r.year, r.month) for r in df.collect())


@pytest.mark.parametrize("land, read", [(land_zip, landing.read_extract_zip), (land_csv, landing.read_extract_csv)])
def test_extract_to_bronze(spark, tmp_path, land, read):
    land(tmp_path, 2025, 3, [
        extract_line(2025, 3, 9, OriginCityName="Cañon City, CO", Tail_Number="NA", DepTime="nan", ArrTime="24.5"),
        extract_line(2025, 3, 10, Cancelled="1.00", CancellationCode="B", ArrDelay="", DepTime=""),
    ])
    suffix = "zip" if land is land_zip else "csv"
    bronze = ingest.bronze_flights(read(spark, f"{tmp_path}/on_time_2025_3.{suffix}"))
    assert bronze.columns[:32] == [name for _, name, _ in EXTRACT_COLUMNS]
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE_FLIGHTS]
    a, b = bronze.orderBy("flight_date").collect()
    assert (a.flight_date, a.flight_number, a.crs_dep_time, a.dep_time, a.arr_time) == ("2025-03-09", "17", 905, None, 24)
    assert (a.origin_city, a.tail_number, a.cancellation_code) == ("Cañon City, CO", None, None)
    assert (b.cancelled, b.cancellation_code, b.arr_delay, b.dep_time) == (1.0, "B", None, None)
    assert (a._source_file, a.year, a.month) == (f"on_time_2025_3.{suffix}", 2025, 3) and a._ingested_at


def test_extract_without_a_delimited_member_is_an_error(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "on_time_2025_3.zip", "w") as archive:
        archive.writestr("readme.html", "")
    with pytest.raises(Exception, match="no delimited member"):
        landing.read_extract_zip(spark, f"{tmp_path}/on_time_2025_3.zip").collect()


def test_files_with_another_header_are_refused(spark, tmp_path):
    land_csv(tmp_path, 2025, 3, [extract_line(2025, 3, 1)])
    text = (tmp_path / "on_time_2025_3.csv").read_text()
    (tmp_path / "on_time_2025_4.csv").write_text(text.replace('"Origin"', '"Swap"').replace('"Dest"', '"Origin"').replace('"Swap"', '"Dest"'))
    with pytest.raises(Exception, match="header|HEADER"):
        landing.read_extract_csv(spark, str(tmp_path)).collect()


def test_missing_tokens_and_white_space(spark):
    df = spark.createDataFrame([(t,) for t in [*NULL_TOKENS, " NA", "x"]], "t string")
    assert [r[0] for r in df.select(fn.missing_to_null(F.col("t"))).collect() if r[0]] == [" NA", "x"]
    assert spark.createDataFrame([("\t 7 \n\xa0",)], "t string").select(fn.strip_all(F.col("t"))).first()[0] == "7"


def test_month_window_crosses_the_year(spark):
    window = ingest.month_window(months(spark, (2025, 2)), 4)
    assert listed(window) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_month_bounds_know_leap_years(spark):
    got = {(r.year, r.month): (r.first_day, r.last_day) for r in ingest.month_bounds(months(spark, (2024, 2), (2025, 2))).collect()}
    assert got == {(2024, 2): (date(2024, 2, 1), date(2024, 2, 29)), (2025, 2): (date(2025, 2, 1), date(2025, 2, 28))}


def test_latest_month_walks_back_eight_months_from_the_month_before_today(spark):
    today = F.lit(date(2025, 9, 15))
    assert listed(ingest.latest_month(months(spark, (2025, 6), (2025, 5), (2025, 9)), today)) == [(2025, 6)]
    assert listed(ingest.latest_month(months(spark, (2025, 1)), today)) == [(2025, 1)]
    assert listed(ingest.latest_month(months(spark, (2024, 12)), today)) == []


def test_payload_is_matched_by_position(spark):
    responses = payload(3, datetime(2025, 2, 1), 28 * 24)
    import json

    parsed = spark.createDataFrame([(json.dumps(responses),)], "value string").select(
        F.from_json("value", landing.WEATHER_PAYLOAD).alias("responses"), F.lit(2025).alias("year"), F.lit(2).alias("month"))
    hubs = seeds.hub_order(spark).filter("position < 2")
    bronze = ingest.bronze_weather(parsed, hubs)
    assert bronze.count() == 2 * 28 * 24
    assert set(WEATHER_VARIABLES) <= set(bronze.columns)
    warm = {r.airport_code: r.t for r in bronze.groupBy("airport_code").agg(F.max("temperature_2m").alias("t")).collect()}
    assert warm == {"ATL": 0.0, "DFW": 1.0}
    assert bronze.agg(F.min("weather_time")).first()[0] == datetime(2025, 2, 1)


def test_arrays_of_unequal_length_are_an_error(spark, tmp_path):
    land_payload(tmp_path, 2025, 2, payload(1, datetime(2025, 2, 1), 24, snowfall=[0.0]))
    read = landing.read_weather_payload(spark, f"{tmp_path}/weather_2025_2.json")
    with pytest.raises(Exception, match="differ in length"):
        ingest.bronze_weather(read.select("responses", *landing.month_of(F.col("path"))), seeds.hub_order(spark)).collect()


def test_ingest_is_idempotent_unless_forced(spark, tmp_path):
    land_zip(tmp_path / "in", 2025, 3, [extract_line(2025, 3, d) for d in (1, 2, 3)])
    land_csv(tmp_path / "in", 2025, 4, [extract_line(2025, 4, 1)])
    land_zip(tmp_path / "in", 2024, 1, [extract_line(2024, 1, 1)])
    source, target = str(tmp_path / "in"), str(tmp_path / "lake")
    window = months(spark, (2025, 3), (2025, 4))
    assert ingest.ingest_flights(spark, source, target, window) == 4
    assert ingest.ingest_flights(spark, source, target, window) == 0
    land_zip(tmp_path / "in", 2025, 3, [extract_line(2025, 3, 1)])
    assert ingest.ingest_flights(spark, source, target, window) == 0
    assert ingest.ingest_flights(spark, source, target, months(spark, (2025, 3)), force=True) == 1
    assert listed(lake.present_months(spark, lake.bronze_path(target, "flights"))) == [(2025, 3), (2025, 4)]
    assert lake.read_bronze(spark, target, "flights").count() == 2
    assert (tmp_path / "lake/bronze/flights/year=2025/month=03").is_dir()


def test_a_bad_weather_month_stops_no_other(spark, tmp_path):
    land_payload(tmp_path / "in", 2025, 2, payload(30, datetime(2025, 2, 1), 48))
    land_payload(tmp_path / "in", 2025, 3, payload(30, datetime(2025, 3, 1), 48, snowfall=[]))
    source, target = str(tmp_path / "in"), str(tmp_path / "lake")
    window = months(spark, (2025, 2), (2025, 3))
    assert ingest.ingest_weather(spark, source, target, window) == 30 * 48
    assert listed(lake.present_months(spark, lake.bronze_path(target, "weather"))) == [(2025, 2)]
    land_payload(tmp_path / "in", 2025, 3, payload(30, datetime(2025, 3, 1), 24))
    assert ingest.ingest_weather(spark, source, target, window) == 30 * 24


def test_month_filters_prune_bronze_partitions(spark, tmp_path):
    land_zip(tmp_path / "in", 2025, 3, [extract_line(2025, 3, 1)])
    ingest.ingest_flights(spark, str(tmp_path / "in"), str(tmp_path / "lake"), months(spark, (2025, 3)))
    scan = lake.read_bronze(spark, str(tmp_path / "lake"), "flights").filter("year = 2025 and month = 3").select("distance")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<distance:double>" in plan and "(month" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_foreign_bronze_with_drifting_types(spark, tmp_path):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    for month, delay, extra in ((1, [5, 7], {}), (2, [1.5, None], {"unknown": ["a", "b"]}), (3, [6, 8], {})):
        frame = pd.DataFrame({"flight_date": ["2025-01-01"] * 2, "dep_delay": delay, "crs_dep_time": pd.array([905, None], "Int16"), **extra})
        frame["_ingested_at"] = pd.Timestamp("2025-06-01 01:02:03.456789", tz="UTC")
        folder = tmp_path / f"bronze/flights/year=2025/month=0{month}"
        folder.mkdir(parents=True)
        table = pa.Table.from_pandas(frame, preserve_index=False)
        kind = pa.timestamp("ns", tz="UTC")
        at = table.schema.get_field_index("_ingested_at")
        table = table.set_column(at, pa.field("_ingested_at", kind), table["_ingested_at"].cast(kind))
        pq.write_table(table, folder / "flights.parquet")
        odd = folder / "more.parquet"  # files of one month may differ as well
        pq.write_table(table.slice(0, 0).drop_columns(["dep_delay"]), odd)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(str(tmp_path / "bronze"))
    groups = footers.files_by_schema(files)
    assert sorted(len(paths) for _, paths in groups) == [1, 1, 2, 2] and all("`_ingested_at` bigint" in ddl for ddl, _ in groups)
    lake.adopt_bronze(spark, str(tmp_path), str(tmp_path / "own"), "flights")
    df = lake.read_bronze(spark, str(tmp_path / "own"), "flights")
    assert [f.dataType for f in df.schema] == [f.dataType for f in BRONZE_FLIGHTS]
    assert sorted((r.month, r.dep_delay) for r in df.collect() if r.dep_delay is not None) == [(1, 5.0), (1, 7.0), (2, 1.5), (3, 6.0), (3, 8.0)]
    assert {r._ingested_at for r in df.collect()} == {datetime(2025, 6, 1, 1, 2, 3, 456789)}


def test_foreign_wall_clock_keeps_its_microseconds(spark):
    from pyspark.sql import types as T

    contract = T.StructType([T.StructField("t", T.TimestampNTZType())])
    ns = 1_740_000_000_123_456_000
    df = lake.conform(spark.createDataFrame([(ns,), (None,)], "t long"), contract)
    assert [r.t for r in df.collect()] == [datetime(2025, 2, 19, 21, 20, 0, 123456), None]


def test_extract_stream_loads_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "state")
    land_zip(source, 2025, 3, [extract_line(2025, 3, 1), extract_line(2025, 3, 2)])
    stream_extracts(spark, str(source), target, state).awaitTermination()
    land_zip(source, 2025, 4, [extract_line(2025, 4, 1)])
    query = stream_extracts(spark, str(source), target, state)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    counts = lake.read_bronze(spark, target, "flights").groupBy("month").count().collect()
    assert sorted(tuple(r) for r in counts) == [(3, 2), (4, 1)]


def test_seeds(spark, tmp_path):
    assert seeds.carriers(spark).count() == 24 and seeds.hub_airports(spark).count() == 30
    assert [r.airport_code for r in seeds.hub_order(spark).orderBy("position").limit(3).collect()] == ["ATL", "DFW", "DEN"]
    (tmp_path / "hubs.csv").write_text(
        "airport_code,airport_name,city,state,latitude,longitude\nAAA,A Field,A,AA,33,-84.5\n")
    assert seeds.hub_airports(spark, str(tmp_path / "hubs.csv")).first().latitude == 33.0


def faults_of(spark, target):
    counts = rejects.reject_counts(rejects.read_rejects(spark, target)).collect()
    return sorted((r.source_file, r.reason, r.field, r.rows) for r in counts)


def test_what_bronze_does_not_take_is_kept_with_its_reason(spark, tmp_path):
    import json

    source, target = tmp_path / "in", str(tmp_path / "lake")
    good = extract_line(2025, 3, 1)
    bad = [extract_line(2025, 3, 2, TaxiIn="ten"), extract_line(2025, 3, 31, Month="2"), extract_line(2025, 3, 4, DepTime="99999"),
           extract_line(2025, 3, 5, AirTime="x", Distance="-"), extract_line(2025, 3, 6, Year="")]
    land_zip(source, 2025, 3, [good, *bad, extract_line(2025, 3, 7, DepTime="noon", TaxiIn="NA")])
    land_csv(source, 2025, 3, [good, good])
    land_csv(source, 2025, 4, [extract_line(2025, 4, 1, DepDelay="1,5")])
    (source / "extra.csv").write_bytes((source / "on_time_2025_3.csv").read_bytes())
    window = months(spark, (2025, 3), (2025, 4))
    assert ingest.ingest_flights(spark, str(source), target, window) == 2
    expected = [
        ("extra.csv", "month", "_source_file", 2), ("on_time_2025_3.csv", "hidden", "_source_file", 1),
        ("on_time_2025_3.zip", "date", "FlightDate", 2), ("on_time_2025_3.zip", "number", "AirTime", 1),
        ("on_time_2025_3.zip", "number", "Distance", 1), ("on_time_2025_3.zip", "number", "TaxiIn", 1),
        ("on_time_2025_3.zip", "range", "DepTime", 1), ("on_time_2025_4.csv", "number", "DepDelay", 1)]
    assert faults_of(spark, target) == expected
    kept = rejects.read_rejects(spark, target).filter("source_file = 'on_time_2025_4.csv'").first()
    assert json.loads(kept.line)["DepDelay"] == "1,5" and kept.faults[0].value == "1,5"
    assert ingest.ingest_flights(spark, str(source), target, window) == 0  # nothing is set aside twice
    assert faults_of(spark, target) == expected
    land_zip(source, 2025, 3, [good])
    assert ingest.ingest_flights(spark, str(source), target, window, force=True) == 1
    assert faults_of(spark, target) == [r for r in expected if r[0] != "on_time_2025_3.zip"]


def test_the_stream_sets_aside_what_does_not_fit(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "state")
    land_zip(source, 2025, 3, [extract_line(2025, 3, 1), extract_line(2025, 3, 2, Distance="far")])
    (source / "on_time.zip").write_bytes((source / "on_time_2025_3.zip").read_bytes())
    stream_extracts(spark, str(source), target, state).awaitTermination()
    assert lake.read_bronze(spark, target, "flights").count() == 1
    assert faults_of(spark, target) == [
        ("on_time.zip", "month", "_source_file", 2), ("on_time.zip", "number", "Distance", 1),
        ("on_time_2025_3.zip", "number", "Distance", 1)]


def test_archives_are_read_by_blocks_and_columns(spark, tmp_path, monkeypatch):
    land_zip(tmp_path / "deep", 2025, 3, [extract_line(2025, 3, 1 + d % 28) for d in range(300)])
    land_zip(tmp_path, 2025, 4, [extract_line(2025, 4, 1)])
    (tmp_path / "notes.txt").write_text("")
    monkeypatch.setattr(zips, "BLOCK_BYTES", 8192)
    path = str(tmp_path / "deep/on_time_2025_3.zip")
    batches = list(zips.member_rows(path, ["Origin", "_source_file"]))
    assert len(batches) > 5 and sum(b.num_rows for b in batches) == 300 and batches[0].schema.names == ["Origin", "_source_file"]
    zips.register(spark)
    whole = spark.read.format("zipped_extracts").load(str(tmp_path))
    assert whole.rdd.getNumPartitions() == 2 and whole.count() == 301
    assert zips.read_zips(spark, f"file:{path}", "Origin", "_source_file").distinct().collect() == [("ATL", "on_time_2025_3.zip")]
    assert zips.read_zips(spark, str(tmp_path / "nothing")).count() == 0


def test_streamed_weather_equals_the_batch_load(spark, tmp_path, rows):
    import json
    import os

    source, own, other = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "batch")
    for month in (1, 2):
        land_payload(source, 2025, month, payload(30, datetime(2025, month, 1), 48))
    window = months(spark, (2025, 1), (2025, 2))
    ingest.ingest_weather(spark, str(source), other, window)
    land_payload(source, 2025, 3, payload(30, datetime(2025, 3, 1), 48, snowfall=[0.0]))
    (source / "weather_2025_4.json").write_text("no payload")
    (source / "weather.json").write_text(json.dumps(payload(2, datetime(2025, 4, 1), 2)))
    (source / "weather_2025_5.json").write_text(json.dumps(payload(2, datetime(2025, 5, 1), 2, snowfall=["deep", None])))
    stream_weather(spark, str(source), own, str(tmp_path / "state")).awaitTermination()
    read = lambda root: lake.read_bronze(spark, root, "weather").drop("_ingested_at")
    assert rows(read(own)) == rows(read(other)) and read(own).count() == 30 * 96
    counts = rejects.reject_counts(rejects.read_rejects(spark, own, "weather")).collect()
    assert sorted((r.source_file, r.reason, r.field) for r in counts) == [
        ("weather.json", "month", "path"), ("weather_2025_3.json", "length", "hourly"),
        ("weather_2025_4.json", "payload", "responses"), ("weather_2025_5.json", "number", "snowfall")]
    for name, warmth in (("a", 5), ("b", 7)):  # two corrections of a month in one batch: the later one counts
        (source / f"fix_{name}_2025_1.json").write_text(json.dumps(payload(1, datetime(2025, 1, 1), 24, temperature_2m=[warmth] * 24)))
        os.utime(source / f"fix_{name}_2025_1.json", (2e9 - warmth, 2e9 - warmth))
    stream_weather(spark, str(source), own, str(tmp_path / "state")).awaitTermination()
    january = read(own).filter("month = 1")
    assert january.count() == 24 and january.select("temperature_2m").distinct().collect() == [(5.0,)]
    later = rejects.read_rejects(spark, own, "weather").filter("faults[0].reason = 'later'").collect()
    assert [r.source_file for r in later] == ["fix_b_2025_1.json"]


def test_a_month_lands_as_many_files_of_its_name(spark, rows, tmp_path):
    from tarmac.registry.ingestion import _land
    from tarmac.schemas import RAW_EXTRACT

    lines = [extract_line(2025, 3, 1 + i % 20) | {"_file": f"on_time_2025_{3 + i % 2}.zip"} for i in range(90)]
    columns = [c for c in RAW_EXTRACT.names if c != "_source_file"] + ["_file"]
    landed_rows = spark.createDataFrame([tuple(str(line[c]) for c in columns) for line in lines], ", ".join(f"{c} string" for c in columns))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(batch)
    spark.conf.set(batch, "5")
    try:
        _land(landed_rows.repartition(3), str(tmp_path / "in"), most=10)
    finally:
        spark.conf.set(batch, own)
    found = zips.archives([str(tmp_path / "in")])
    assert len(found) > 6 and {f.rsplit("/", 1)[-1] for f in found} == {"on_time_2025_3.zip", "on_time_2025_4.zip"}
    back = landing.read_extract_zip(spark, str(tmp_path / "in"))
    assert rows(back.withColumnRenamed("_source_file", "_file"), *columns) == rows(landed_rows, *columns)


def test_a_hidden_extract_in_several_files_is_one(spark, rows):
    kept = rejects.hidden(spark, ["/in/a/on_time_2025_3.csv", "/in/b/on_time_2025_3.csv", "/in/on_time_2025_4.csv"])
    assert rows(rejects.reject_counts(kept), "source_file", "rows") == [
        ("on_time_2025_3.csv", 1), ("on_time_2025_4.csv", 1)]
    assert "/in/a/on_time_2025_3.csv,/in/b/on_time_2025_3.csv" in {r.faults[0].value for r in kept.collect()}


def test_months_that_come_by_month_are_written_without_a_shuffle_or_sort(spark, tmp_path):
    from tarmac.session import SIDE_BY_SIDE, side_by_side

    rows = spark.range(40).selectExpr("id", "2025 as year", "cast(id % 2 + 1 as int) as month").coalesce(1)
    with side_by_side(spark):
        with side_by_side(spark):
            pass
        assert int(spark.conf.get(SIDE_BY_SIDE)) >= 4
    before = spark.conf.get(SIDE_BY_SIDE, None)
    lake.write_month_partitions(rows, str(tmp_path / "t"), by_month=True)
    assert spark.conf.get(SIDE_BY_SIDE, None) == before
    assert sorted(p.name for p in (tmp_path / "t").glob("*/*")) == ["month=01", "month=02"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40
    lake.write_month_partitions(rows.filter("month = 2 and id < 10"), str(tmp_path / "t"), by_month=True)
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("month").count().orderBy("month").collect() == [(1, 20), (2, 5)]


def test_rows_are_faulty_where_the_list_of_faults_is_not_empty(spark):
    """By the whole list, dates by the parser alone; and numbers are those of the raw texts."""
    from itertools import product

    from tarmac.schemas import EXTRACT_COLUMNS, EXTRACT_DATE_PARTS, RAW_EXTRACT

    texts = ["", "NA", "NaN", "nan", "-nan", "1.#IND", "ten", " 5 ", "5d", "-7.5", "inf", "1e400", "32767", "32767.6", "-40000", None]
    dates = product(["0", "1", "99", "2024", "2023", "10000", "NA", None], ["0", "1", "2", "12", "13", "x"], ["0", "1", "28", "29", "30", "31", "32"])
    plain = {c: "1" for c in RAW_EXTRACT.names} | {"Year": "2024", "_source_file": "on_time_2024_1.zip"}
    rows = [plain | dict(zip(EXTRACT_DATE_PARTS, d)) for d in dates]
    rows += [plain | {c: t} for t in texts for c, _, kind in EXTRACT_COLUMNS if kind != "string"] + [plain | {"_source_file": "extra.zip"}, plain]
    raw = spark.createDataFrame([tuple(r[c] for c in RAW_EXTRACT.names) for r in rows], RAW_EXTRACT)
    day = F.try_to_date(F.concat_ws("-", *[F.col(c).try_cast("double").cast("int") for c in EXTRACT_DATE_PARTS]), "y-M-d")
    found = rejects.marked(raw).select("_faulty", F.size(rejects.faults(raw)) > 0, F.exists(rejects.faults(raw), lambda f: f.reason == "date"), day.isNull()).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in found) and 0 < sum(r[0] for r in found) < len(found)
    whole = [ingest.bronze_flights(rejects.accepted(kind(raw))).drop("_ingested_at") for kind in (rejects.marked, rejects.parsed)]
    assert whole[0].schema == whole[1].schema
    assert sorted(map(str, whole[0].collect())) == sorted(map(str, whole[1].collect()))
    assert rejects.rejected(rejects.marked(raw)).count() == sum(r[0] for r in found)


def test_extracts_are_loaded_without_a_shuffle_and_in_several_files(spark, tmp_path, monkeypatch):
    for month in (1, 2):
        land_zip(tmp_path / "in", 2025, month, [extract_line(2025, month, 1 + i % 28, Flight_Number_Reporting_Airline=i) for i in range(60)])
    monkeypatch.setattr(lake, "FILE_ROWS", 25)
    own, used = lake.write_month_partitions, []
    monkeypatch.setattr(ingest, "write_month_partitions", lambda df, *args, **how: (used.append((df, how)), own(df, *args, **how)))
    assert ingest.ingest_flights(spark, str(tmp_path / "in"), str(tmp_path / "lake"), months(spark, (2025, 1), (2025, 2))) == 120
    (df, how), = used
    assert how["by_month"] and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    for month in (1, 2):
        assert len(list((tmp_path / "lake/bronze/flights/year=2025" / f"month=0{month}").glob("*.parquet"))) == 3
