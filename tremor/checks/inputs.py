"""The test tables in the shapes the operators take, in Spark and in SQL.

Events stand for quakes and orders for order records. Every frame covers its
whole table, row by row, without a shuffle unless it is asked to spread the rows.
"""

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor import schema
from tremor.functions import naive_utc

Query = Callable[[SparkSession, str], DataFrame]

# The events cover January 2024; the week before this day is in the middle.
AS_OF = date(2024, 1, 24)
LOAD_DATE = date(2024, 1, 30)
LOAD_TS = datetime(2024, 1, 30, 12, 34, 56, 789012, tzinfo=timezone.utc)
LOAD_MICROS = 1706618096789012

# Thresholds that leave something on both sides at the scale of the test tables.
HIGH_VALUE = 345.0
ORDER_STATUS = "F"
MIN_PRICE = 100000.0
LARGE_TOTAL = 1500000.0


def events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The events; ``spread`` deals them to all cores, however few tasks the table's row groups are.

    An event is some 50 bytes here, and makes two features of some 700 each later.
    """
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.hint("rebalance", "event_id") if spread else rows


def utc_millis(naive: str) -> Column:
    """Epoch milliseconds of a timestamp without a zone, taken as UTC."""
    return F.unix_millis(F.concat(F.col(naive).cast("string"), F.lit("Z")).cast("timestamp"))


def _place() -> Column:
    return F.concat(
        F.col("user_id").cast("string"),
        F.lit(" km N of "),
        F.col("event_type"),
        F.lit(", "),
        F.get_json_object("props", "$.k"),
    )


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as silver rows, as far as the analyses look at them."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("value").alias("mag"),
        _place().alias("place"),
        F.col("event_type").alias("area"),
        F.col("ts").alias("insert_dt"),
    )


PLACE_SQL = "user_id || ' km N of ' || event_type || ', ' || json_extract_string(props, '$.k')"

QUAKES_SQL = f"""WITH q AS (
  SELECT event_id AS id, value AS mag, {PLACE_SQL} AS place, event_type AS area, ts AS insert_dt
  FROM events
)
"""


def _feature(fid: Column, given: dict[str, Column], coordinates: Column, missing: Column) -> Column:
    """A feature with the given properties, all others null; null geometry if missing."""
    properties = [
        given.get(name, F.lit(None).cast(schema.READ_AS[kind])).alias(name)
        for name, kind in schema.PROPERTIES
    ]
    point = F.struct(F.lit("Point").alias("type"), coordinates.alias("coordinates"))
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.when(~missing, point).alias("geometry"),
        fid.alias("id"),
    )


def features(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Two features per event, in columns ``whole`` and ``poor``.

    The poor one has what real feeds have now and then: no magnitude, an
    unreadable time, a place without an area, two coordinates or no geometry.
    """
    event_id = F.col("event_id")
    longitude = (event_id % 360 - 180).cast("double") + 0.5
    latitude = (event_id % 90).cast("double") + 0.25
    depth = F.get_json_object("props", "$.k").cast("double")
    millis = utc_millis("ts")
    whole = {
        "mag": F.col("value"),
        "place": _place(),
        "time": millis.cast("string"),
        "updated": (millis + 60_000).cast("string"),
        "felt": F.col("user_id").cast("double"),
        "tsunami": (event_id % 2).cast("double"),
        "sig": (event_id % 1000).cast("double"),
        "net": F.col("event_type"),
        "code": event_id.cast("string"),
        "magType": F.lit("ml"),
        "type": F.lit("earthquake"),
        "title": F.concat(F.lit("M at "), _place()),
    }
    poor = {
        "place": F.col("event_type"),
        "time": F.lit("not a time"),
        "updated": millis.cast("string"),
        "net": F.col("event_type"),
    }
    return events(spark, sf_dir, spread).select(
        _feature(event_id.cast("string"), whole, F.array(longitude, latitude, depth), F.lit(False)).alias("whole"),
        _feature(
            F.concat(event_id.cast("string"), F.lit("p")), poor, F.array(longitude, latitude), event_id % 2 == 0
        ).alias("poor"),
    )


def single_features(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The same features, one per row, with the fields of a feature as columns."""
    return (
        features(spark, sf_dir, spread)
        .select(F.explode(F.array("whole", "poor")).alias("feature"))
        .select("feature.*")
    )


def collections(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One feature collection per event.

    A collection of a whole day would put a busy day into one task; these stay
    small whatever the table holds.
    """
    return features(spark, sf_dir, spread).select(
        F.lit("FeatureCollection").alias("type"),
        F.struct(F.lit("events").alias("title"), F.lit(2).alias("count")).alias("metadata"),
        F.array("whole", "poor").alias("features"),
    )


# What silver must hold of those features. Times are without a zone.
SILVER_CTE = f"""WITH e AS (
  SELECT *, {PLACE_SQL} AS place, json_extract_string(props, '$.k') AS k FROM events
), silver AS (
  SELECT CAST(event_id AS VARCHAR) AS id, value AS mag, place,
         date_trunc('second', ts) AS "time",
         date_trunc('second', ts + INTERVAL 1 MINUTE) AS updated,
         user_id AS felt, event_id % 2 AS tsunami, event_id % 1000 AS sig,
         event_type AS net, CAST(event_id AS VARCHAR) AS code, 'ml' AS "magType",
         'earthquake' AS "type", 'M at ' || place AS title, 'Point' AS geometry_type,
         CAST(event_id % 360 - 180 AS DOUBLE) + 0.5 AS longitude,
         CAST(event_id % 90 AS DOUBLE) + 0.25 AS latitude,
         CAST(k AS DOUBLE) AS depth,
         event_type || ', ' || k AS area_tail, k AS area_comma
  FROM e
  UNION ALL
  SELECT event_id || 'p', NULL, event_type, NULL, date_trunc('second', ts), NULL, NULL, NULL,
         event_type, NULL, NULL, NULL, NULL,
         CASE WHEN event_id % 2 = 1 THEN 'Point' END,
         CASE WHEN event_id % 2 = 1 THEN CAST(event_id % 360 - 180 AS DOUBLE) + 0.5 END,
         CASE WHEN event_id % 2 = 1 THEN CAST(event_id % 90 AS DOUBLE) + 0.25 END,
         NULL, '', ''
  FROM e
)
"""

_SHARED = ["place", "felt", "tsunami", "sig", "net", "code", "magType", "title", "longitude", "latitude", "depth"]


def silver_view(rows: DataFrame, *keep: str) -> DataFrame:
    """Typed silver rows in the columns that ``SILVER_SQL`` has."""
    times = [naive_utc(F.col(c)).alias(c) for c in ("time", "updated")]
    loaded = F.unix_micros("insert_dt").alias("loaded_micros")
    return rows.select("id", "mag", "area", "geometry_type", *_SHARED, *times, loaded, *keep)


_quoted = ", ".join(f'"{c}"' for c in _SHARED)

SILVER_COLUMNS_SQL = (
    f'id, mag, area_tail AS area, geometry_type, {_quoted}, "time", updated, '
    f"CAST({LOAD_MICROS} AS BIGINT) AS loaded_micros"
)
SILVER_SQL = f"{SILVER_CTE}SELECT {SILVER_COLUMNS_SQL} FROM silver"


def silver_text_view(rows: DataFrame) -> DataFrame:
    """Text silver rows in the columns that ``SILVER_TEXT_SQL`` has."""
    return rows.select("magnitude", "area", "type", *_SHARED, "time", "updated", "insert_date")


SILVER_TEXT_SQL = f"""{SILVER_CTE}SELECT mag AS magnitude, area_comma AS area, "type", {_quoted},
  strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", strftime(updated, '%Y-%m-%d %H:%M:%S') AS updated,
  '{LOAD_TS.replace(tzinfo=None).isoformat()}' AS insert_date
FROM silver"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the names of order records."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderstatus").alias("order_status"),
    )


ORDERS_CTE = f"""WITH valued AS (
  SELECT o_custkey AS user_id, o_totalprice AS order_value FROM orders
  WHERE o_orderstatus = '{ORDER_STATUS}' AND o_totalprice > {MIN_PRICE}
), totals AS (
  SELECT user_id, round(sum(order_value), 2) AS total FROM valued GROUP BY user_id
)
"""
