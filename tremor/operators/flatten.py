"""From one row per landing document to one typed row per feature.

Scan, explode and project: no step here shuffles.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor import schema
from tremor.functions import (
    AREA_RULES,
    epoch_ms_to_str,
    epoch_ms_to_ts,
    load_instant,
    load_instant_text,
    utc_now,
)

# The area rule each variant has had from the start.
DEFAULT_AREA_RULE = {"typed": "tail", "text": "comma"}


def explode_features(collections: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per feature, with the columns in ``keep`` repeated.

    A document whose list is null or empty gives no row.
    """
    return collections.select(*keep, F.explode("features").alias("feature"))


def _property(name: str, kind: str) -> Column:
    value = F.col(f"feature.properties.{name}")
    return value.try_cast("bigint") if kind == "bigint" else value


def _coordinate(position: int) -> Column:
    # get() answers null beyond the end, where getItem() fails under ANSI.
    return F.get("feature.geometry.coordinates", F.lit(position))


def flatten(features: DataFrame, variant: str = "typed", keep: tuple[str, ...] = ()) -> DataFrame:
    """Properties and coordinates of ``feature`` as columns; epochs stay as read.

    The ``typed`` variant has the feature id and the geometry type; the ``text``
    variant has the event type, and names the magnitude ``magnitude``.
    """
    schema.silver_schema(variant)
    typed = variant == "typed"
    left_out = "type" if typed else None
    properties = [
        _property(name, kind).alias("magnitude" if name == "mag" and not typed else name)
        for name, kind in schema.PROPERTIES
        if name != left_out
    ]
    coordinates = [_coordinate(at).alias(name) for name, at in schema.COORDINATES.items()]
    if typed:
        first = [F.col("feature.id").alias("id")]
        middle = [F.col("feature.geometry.type").alias("geometry_type")]
    else:
        first, middle = [], []
    return features.select(*keep, *first, *properties, *middle, *coordinates)


def with_load_ts(df: DataFrame, load_ts: datetime | None = None, variant: str = "typed") -> DataFrame:
    """Add the load instant: ``insert_dt`` as a timestamp, or ``insert_date`` as
    ISO text. Without ``load_ts`` it is now, fixed here, so that every sink of
    one load carries the same instant."""
    load_ts = load_ts or utc_now()
    if variant == "typed":
        return df.withColumn("insert_dt", load_instant(load_ts))
    return df.withColumn("insert_date", load_instant_text(load_ts))


def transform(
    flat: DataFrame,
    load_ts: datetime | None = None,
    area_rule: str | None = None,
    variant: str = "typed",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Flattened features as silver rows: epochs converted, area and load instant
    added, columns in silver order after those in ``keep``."""
    names = schema.silver_schema(variant).names
    area = AREA_RULES[area_rule or DEFAULT_AREA_RULE[variant]]
    convert = epoch_ms_to_ts if variant == "typed" else epoch_ms_to_str
    rows = flat.withColumns(
        {"time": convert("time"), "updated": convert("updated"), "area": area("place")}
    )
    return with_load_ts(rows, load_ts, variant).select(*keep, *names)
