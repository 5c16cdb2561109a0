"""Reference tables of fixed size: carriers and hub airports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarmac.schemas import CARRIERS, HUBS

# Carrier code, name, type.
CARRIER_ROWS = """
AA|American Airlines|Network
DL|Delta Air Lines|Network
UA|United Airlines|Network
WN|Southwest Airlines|Low-cost
AS|Alaska Airlines|Network
B6|JetBlue Airways|Low-cost
NK|Spirit Airlines|Ultra low-cost
F9|Frontier Airlines|Ultra low-cost
G4|Allegiant Air|Ultra low-cost
HA|Hawaiian Airlines|Network
SY|Sun Country Airlines|Low-cost
MX|Breeze Airways|Low-cost
OO|SkyWest Airlines|Regional
YX|Republic Airways|Regional
MQ|Envoy Air|Regional
OH|PSA Airlines|Regional
9E|Endeavor Air|Regional
QX|Horizon Air|Regional
ZW|Air Wisconsin|Regional
C5|CommutAir|Regional
G7|GoJet Airlines|Regional
PT|Piedmont Airlines|Regional
EV|ExpressJet Airlines|Regional
YV|Mesa Airlines|Regional
"""

# Airport code, name, city, state, latitude, longitude.
HUB_ROWS = """
ATL|Hartsfield-Jackson Atlanta International|Atlanta|GA|33.6407|-84.4277
DFW|Dallas/Fort Worth International|Dallas/Fort Worth|TX|32.8998|-97.0403
DEN|Denver International|Denver|CO|39.8561|-104.6737
ORD|Chicago O'Hare International|Chicago|IL|41.9742|-87.9073
LAX|Los Angeles International|Los Angeles|CA|33.9416|-118.4085
CLT|Charlotte Douglas International|Charlotte|NC|35.2144|-80.9473
LAS|Harry Reid International|Las Vegas|NV|36.0840|-115.1537
PHX|Phoenix Sky Harbor International|Phoenix|AZ|33.4352|-112.0101
MCO|Orlando International|Orlando|FL|28.4312|-81.3081
SEA|Seattle-Tacoma International|Seattle|WA|47.4502|-122.3088
MIA|Miami International|Miami|FL|25.7959|-80.2870
IAH|George Bush Intercontinental|Houston|TX|29.9902|-95.3368
JFK|John F. Kennedy International|New York|NY|40.6413|-73.7781
EWR|Newark Liberty International|Newark|NJ|40.6895|-74.1745
SFO|San Francisco International|San Francisco|CA|37.6213|-122.3790
BOS|Boston Logan International|Boston|MA|42.3656|-71.0096
FLL|Fort Lauderdale-Hollywood International|Fort Lauderdale|FL|26.0742|-80.1506
MSP|Minneapolis-Saint Paul International|Minneapolis|MN|44.8848|-93.2223
LGA|LaGuardia|New York|NY|40.7769|-73.8740
DTW|Detroit Metropolitan Wayne County|Detroit|MI|42.2162|-83.3554
PHL|Philadelphia International|Philadelphia|PA|39.8744|-75.2424
SLC|Salt Lake City International|Salt Lake City|UT|40.7899|-111.9791
BWI|Baltimore/Washington International|Baltimore|MD|39.1774|-76.6684
DCA|Ronald Reagan Washington National|Washington|DC|38.8512|-77.0402
SAN|San Diego International|San Diego|CA|32.7338|-117.1933
IAD|Washington Dulles International|Washington|VA|38.9531|-77.4565
TPA|Tampa International|Tampa|FL|27.9755|-82.5332
BNA|Nashville International|Nashville|TN|36.1263|-86.6774
AUS|Austin-Bergstrom International|Austin|TX|30.1975|-97.6664
MDW|Chicago Midway International|Chicago|IL|41.7868|-87.7522
"""


def seed_rows(text: str) -> list[list[str]]:
    return [line.split("|") for line in text.strip().splitlines()]


def _inline(spark: SparkSession, text: str, schema: T.StructType, position: bool = False) -> DataFrame:
    """An inline table: the optimizer knows its size, so joins with it broadcast unasked."""
    def literal(value: str, field: T.StructField) -> str:
        quoted = "'" + value.replace("'", "\\'") + "'"
        return f"cast({quoted} as {field.dataType.simpleString()})"

    rows = []
    for i, values in enumerate(seed_rows(text)):
        cells = [literal(v, f) for v, f in zip(values, schema.fields)]
        rows.append("(" + ", ".join(([str(i)] if position else []) + cells) + ")")
    names = (["position"] if position else []) + schema.names
    return spark.sql(f"select * from values {', '.join(rows)} as seed({', '.join(names)})")


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed kept as a delimited file with a header, typed by the schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def carriers(spark: SparkSession, path: str | None = None) -> DataFrame:
    return read_seed(spark, path, CARRIERS) if path else _inline(spark, CARRIER_ROWS, CARRIERS)


def hub_airports(spark: SparkSession, path: str | None = None) -> DataFrame:
    return read_seed(spark, path, HUBS) if path else _inline(spark, HUB_ROWS, HUBS)


def hub_order(spark: SparkSession) -> DataFrame:
    """Hub codes with their place in the list, the only key a weather payload has."""
    return _inline(spark, HUB_ROWS, HUBS, position=True).select("position", "airport_code")
