"""Column contracts of the landed extracts, the bronze layer and the seeds."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """'name type, ...' to a schema, without needing a session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column of the monthly extract, bronze name, bronze type, in bronze order.
_EXTRACT = """
FlightDate                       flight_date          string
Reporting_Airline                carrier_code         string
Flight_Number_Reporting_Airline  flight_number        string
Tail_Number                      tail_number          string
Origin                           origin               string
OriginCityName                   origin_city          string
OriginState                      origin_state         string
Dest                             dest                 string
DestCityName                     dest_city            string
DestState                        dest_state           string
CRSDepTime                       crs_dep_time         smallint
DepTime                          dep_time             smallint
DepDelay                         dep_delay            double
DepDel15                         dep_del15            double
TaxiOut                          taxi_out             double
TaxiIn                           taxi_in              double
CRSArrTime                       crs_arr_time         smallint
ArrTime                          arr_time             smallint
ArrDelay                         arr_delay            double
ArrDel15                         arr_del15            double
Cancelled                        cancelled            double
CancellationCode                 cancellation_code    string
Diverted                         diverted             double
CRSElapsedTime                   crs_elapsed_time     double
ActualElapsedTime                actual_elapsed_time  double
AirTime                          air_time             double
Distance                         distance             double
CarrierDelay                     carrier_delay        double
WeatherDelay                     weather_delay        double
NASDelay                         nas_delay            double
SecurityDelay                    security_delay       double
LateAircraftDelay                late_aircraft_delay  double
"""

# (extract column, bronze column, bronze type)
EXTRACT_COLUMNS = [tuple(line.split()) for line in _EXTRACT.strip().splitlines()]
EXTRACT_DATE_PARTS = ["Year", "Month", "DayofMonth"]
EXTRACT_WANTED = EXTRACT_DATE_PARTS + [source for source, _, _ in EXTRACT_COLUMNS]

RAW_EXTRACT = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*EXTRACT_WANTED, "_source_file"]]
)

# Texts a delimited reader of the extracts takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

BRONZE_FLIGHTS = _schema(
    ", ".join(f"{name} {kind}" for _, name, kind in EXTRACT_COLUMNS)
    + ", _ingested_at timestamp, _source_file string, year int, month int"
)

# Hourly variables of the weather payload and their element types.
WEATHER_VARIABLES = {
    "temperature_2m": "double",
    "precipitation": "double",
    "snowfall": "double",
    "wind_speed_10m": "double",
    "wind_gusts_10m": "double",
    "cloud_cover": "double",
    "weather_code": "double",
}

WEATHER_PAYLOAD = (
    "array<struct<timezone: string, hourly: struct<time: array<string>, "
    + ", ".join(f"{name}: array<{kind}>" for name, kind in WEATHER_VARIABLES.items())
    + ">>>"
)

BRONZE_WEATHER = _schema(
    "airport_code string, weather_time timestamp_ntz, "
    + ", ".join(f"{name} {kind}" for name, kind in WEATHER_VARIABLES.items())
    + ", timezone string, _ingested_at timestamp, year int, month int"
)

CARRIERS = _schema("carrier_code string, carrier_name string, carrier_type string")
HUBS = _schema(
    "airport_code string, airport_name string, city string, state string, latitude double, longitude double"
)

# Labels of delay causes with their columns, cancellation codes, and weather classes.
DELAY_CAUSES = {
    "Carrier": "carrier_delay_min",
    "Weather": "weather_delay_min",
    "National Air System": "nas_delay_min",
    "Security": "security_delay_min",
    "Late aircraft": "late_aircraft_delay_min",
}
CANCELLATION_REASONS = {"A": "Carrier", "B": "Weather", "C": "National Air System", "D": "Security"}
WEATHER_CLASSES = ["Dry & calm", "Light rain", "Heavy rain", "Strong wind", "Snow"]
ALL_HUBS = "ALL HUBS"
