"""Hand-written bronze rows and landed files in the source formats."""

from __future__ import annotations

import io
import json
import zipfile
from datetime import datetime, timedelta

from tarmac.schemas import BRONZE_FLIGHTS, BRONZE_WEATHER, EXTRACT_COLUMNS, WEATHER_VARIABLES

DEFAULTS = {
    "flight_date": "2025-03-01", "carrier_code": "AA", "flight_number": "1", "tail_number": "N1",
    "origin": "ATL", "origin_city": "Atlanta, GA", "origin_state": "GA",
    "dest": "DFW", "dest_city": "Dallas, TX", "dest_state": "TX",
    "crs_dep_time": 905, "dep_time": 905, "dep_delay": 0.0, "dep_del15": 0.0, "taxi_out": 10.0, "taxi_in": 5.0,
    "crs_arr_time": 1105, "arr_time": 1105, "arr_delay": 0.0, "arr_del15": 0.0,
    "cancelled": 0.0, "cancellation_code": "", "diverted": 0.0, "crs_elapsed_time": 120.0,
    "actual_elapsed_time": 120.0, "air_time": 95.0, "distance": 731.0,
    "_ingested_at": datetime(2025, 6, 1), "_source_file": "x_2025_3.zip", "year": 2025, "month": 3,
}


def flights(spark, *changes: dict):
    """Bronze flights, each the default flight with some columns changed."""
    values = [{**DEFAULTS, **change} for change in changes]
    return spark.createDataFrame(
        [tuple(v.get(f.name) for f in BRONZE_FLIGHTS) for v in values], BRONZE_FLIGHTS)


def weather(spark, *changes: dict):
    base = {"airport_code": "ATL", "weather_time": datetime(2025, 3, 1, 9), "_ingested_at": datetime(2025, 6, 1),
            "timezone": "America/New_York", "year": 2025, "month": 3}
    values = [{**base, **change} for change in changes]
    return spark.createDataFrame(
        [tuple(v.get(f.name) for f in BRONZE_WEATHER) for v in values], BRONZE_WEATHER)


def extract_csv(lines: list[dict]) -> str:
    """An extract as delimited text: wanted columns among others, in another order."""
    header = ["Quarter", "Year", "Month", "DayofMonth", *[s for s, _, _ in reversed(EXTRACT_COLUMNS)], "DistanceGroup"]
    out = [",".join(f'"{h}"' for h in header) + ","]
    for line in lines:
        out.append(",".join(f'"{line.get(h, "")}"' for h in header) + ",")
    return "\n".join(out) + "\n"


def extract_line(year: int, month: int, day: int, **changes) -> dict:
    line = {
        "Quarter": (month - 1) // 3 + 1, "Year": year, "Month": month, "DayofMonth": day, "DistanceGroup": 3,
        "FlightDate": f"{month}/{day}/{year} 12:00:00 AM", "Reporting_Airline": "AA",
        "Flight_Number_Reporting_Airline": " 17 ", "Tail_Number": "N17", "Origin": "ATL",
        "OriginCityName": "Atlanta, GA", "OriginState": "GA", "Dest": "BZN", "DestCityName": "Bozeman, MT",
        "DestState": "MT", "CRSDepTime": "0905", "DepTime": "0910", "DepDelay": "5.00", "DepDel15": "0.00",
        "TaxiOut": "12.00", "TaxiIn": "4.00", "CRSArrTime": "1105", "ArrTime": "1125", "ArrDelay": "20.00",
        "ArrDel15": "1.00", "Cancelled": "0.00", "CancellationCode": "", "Diverted": "0.00",
        "CRSElapsedTime": "120.00", "ActualElapsedTime": "135.00", "AirTime": "95.00", "Distance": "1640.00",
        "CarrierDelay": "20.00", "WeatherDelay": "0.00", "NASDelay": "0.00", "SecurityDelay": "0.00",
        "LateAircraftDelay": "0.00",
    }
    return {**line, **changes}


def land_zip(folder, year: int, month: int, lines: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / f"on_time_{year}_{month}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("readme.html", "<html></html>")
        archive.writestr(f"on_time_{year}_{month}.csv", extract_csv(lines).encode("latin-1"))


def land_csv(folder, year: int, month: int, lines: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"on_time_{year}_{month}.csv").write_bytes(extract_csv(lines).encode("latin-1"))


def payload(hubs: int, start: datetime, hours: int, **changed) -> list[dict]:
    """One response per hub with parallel hourly arrays; hub i is ``i`` degrees warm."""
    times = [(start + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(hours)]
    out = []
    for i in range(hubs):
        hourly = {name: [0.0] * hours for name in WEATHER_VARIABLES}
        hourly["temperature_2m"] = [float(i)] * hours
        out.append({"timezone": "America/New_York", "hourly": {"time": times, **hourly, **changed}})
    return out


def land_payload(folder, year: int, month: int, responses: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"weather_{year}_{month}.json").write_text(json.dumps(responses))


def zip_bytes(members: dict[str, str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return buffer.getvalue()
