"""The standard questions over silver rows or any frame with the same columns.

Column names are arguments, so both silver variants and other tables fit. Every
aggregate here combines within each task before its shuffle, so an area that
holds a third of all rows costs each task one partial row.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions import load_day, load_day_plain, load_day_text, utc_now
from tremor.functions._columns import ColumnOrName

# Fixed value: magnitudes above this count as high.
HIGH_MAGNITUDE = 5.0

AsOf = date | str | Column | None


# ---- filters ---------------------------------------------------------------


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Rows whose ``col`` is strictly above the threshold; nulls are not."""
    return df.where(F.col(col) > F.lit(threshold))


def _as_of(as_of: AsOf) -> Column:
    if as_of is None:
        return F.lit(utc_now().date())
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def _as_kind(day: Column, kind: T.DataType) -> Column:
    """The start of a UTC day as a constant of a column's type."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(day) * F.lit(86_400).cast("bigint"))
    return day.cast(kind)


def last_week(
    df: DataFrame,
    ts_col: str,
    as_of: AsOf = None,
    compat: bool = False,
    partition: str | None = None,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Rows of the Monday-to-Sunday week before the one that ``as_of`` lies in, in UTC.

    ``partition`` names a column by which the table is laid out, and ``zones`` says
    what days its folders hold (``folder_zones``): only folders that reach into the
    week are read, whenever they were loaded. Without ``zones`` the column is a date
    that is never later than the row's own day, and only later folders are left out.

    The default compares the column itself with two constants, which reach the
    scan. ``compat`` compares calendar year and ISO week number instead; it
    loses rows around the turn of the year and cannot be pushed down.
    """
    today = _as_of(as_of)
    kind = df.schema[ts_col].dataType
    column = F.col(ts_col)
    if compat:
        day = F.to_date(day_of(df, ts_col))
        return df.where(
            (F.year(day) == F.year(today)) & (F.weekofyear(day) == F.weekofyear(F.date_sub(today, 7)))
        )
    monday = F.trunc(today, "week")
    if partition is not None and zones is not None:
        hit = (F.col("last") >= F.date_sub(monday, 7)) & (F.col("first") < monday)
        # The names of a week's folders.
        folders = [row[0] for row in zones.where(hit).select(partition).distinct().collect()]
        df = df.where(F.col(partition).isin(folders))
    elif partition is not None:
        df = df.where(F.col(partition) < monday)
    return df.where(
        (column >= _as_kind(F.date_sub(monday, 7), kind)) & (column < _as_kind(monday, kind))
    )


def folder_zones(df: DataFrame, partition: str, ts_col: str) -> DataFrame:
    """The first and last day of ``ts_col`` in each folder: ``partition``, first and last.

    Taken when a table is written, it tells later readers which folders they need.
    """
    day = day_of(df, ts_col).cast("date")
    return df.groupBy(partition).agg(F.min(day).alias("first"), F.max(day).alias("last"))


# ---- counts and means ------------------------------------------------------


def day_of(df: DataFrame, col: str) -> Column:
    """Day of a load column, be it a timestamp, with a zone or without, or ISO text."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        return load_day_text(col)
    return (load_day if isinstance(kind, T.TimestampType) else load_day_plain)(col)


def with_day(df: DataFrame, col: str, name: str = "day") -> DataFrame:
    """Add the day of ``col``."""
    return df.withColumn(name, day_of(df, col))


def count_by(df: DataFrame, *keys: ColumnOrName, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def mean_by(df: DataFrame, key: ColumnOrName, val: str, name: str = "mean") -> DataFrame:
    """Mean of ``val`` per key, nulls left out."""
    return df.groupBy(key).agg(F.avg(val).alias(name))


def max_by_area(df: DataFrame, area: str = "area", mag: str = "mag", name: str = "max_mag") -> DataFrame:
    """Largest magnitude per area."""
    return df.groupBy(area).agg(F.max(mag).alias(name))


def mean_group_size(df: DataFrame, *keys: ColumnOrName, name: str = "avg_n") -> DataFrame:
    """Mean number of rows per distinct key: one number."""
    return count_by(df, *keys).agg(F.avg("n").alias(name))


def mean_count_per_key(df: DataFrame, *keys: ColumnOrName, name: str = "avg_n") -> DataFrame:
    """Mean, within each key, of the key's row count: the count itself, as a double."""
    return df.groupBy(*keys).agg(F.count("*").cast("double").alias(name))


def mean_of_ones(df: DataFrame, *keys: ColumnOrName, name: str = "avg_n") -> DataFrame:
    """Mean, within each key, of a one per row: 1.0 for every key."""
    return df.groupBy(*keys).agg(F.avg(F.lit(1)).alias(name))


# ---- strongest and strong areas --------------------------------------------


def top_area(df: DataFrame, area: str = "area", mag: str = "mag", name: str = "max_mag") -> DataFrame:
    """Area of the largest magnitude of all; of several, the first by name.

    The row with the largest magnitude has the area with the largest maximum, so
    no grouping is needed: each task keeps its best row.
    """
    return (
        df.select(F.col(area), F.col(mag).alias(name))
        .orderBy(F.desc(name), F.asc(area))
        .limit(1)
    )


def strongest_last_week(
    df: DataFrame,
    as_of: AsOf = None,
    *,
    ts_col: str = "insert_dt",
    area: str = "area",
    mag: str = "mag",
    compat: bool = False,
) -> DataFrame:
    """Area and magnitude of last week's strongest event; no row for a quiet week."""
    return top_area(last_week(df, ts_col, as_of, compat), area, mag, name=mag)


def areas_above(
    df: DataFrame, threshold: float = HIGH_MAGNITUDE, area: str = "area", mag: str = "mag"
) -> DataFrame:
    """Distinct areas with a magnitude above the threshold."""
    return above(df, mag, threshold).select(area).distinct()


# ---- frequency and intensity -----------------------------------------------
# Sorts end with the place: among equal numbers it spreads the rows over the
# sort's partitions, where the number alone would send them all to one.


def frequency(df: DataFrame, key: str = "place", val: str = "mag") -> DataFrame:
    """Measured events per place, most first."""
    counts = df.groupBy(key).agg(F.count(val).alias("frequency"))
    return counts.orderBy(F.desc("frequency"), F.asc(key))


def intensity(df: DataFrame, key: str = "place", val: str = "mag") -> DataFrame:
    """Total magnitude per place, largest first."""
    sums = df.groupBy(key).agg(F.sum(val).alias("intensity"))
    return sums.orderBy(F.desc("intensity"), F.asc(key))


def place_totals(df: DataFrame, key: str = "place", val: str = "mag") -> DataFrame:
    """Frequency and intensity per place in one pass, null place included."""
    return df.groupBy(key).agg(F.count(val).alias("frequency"), F.sum(val).alias("intensity"))


def frequency_intensity(df: DataFrame, key: str = "place", val: str = "mag") -> DataFrame:
    """Frequency and intensity side by side, most frequent first.

    Equal to the inner join of the two aggregates on the place, which drops a
    null place; one grouping needs one scan and one shuffle where the join needs
    two of each.
    """
    totals = place_totals(df.where(F.col(key).isNotNull()), key, val)
    return totals.orderBy(F.desc("frequency"), F.desc("intensity"), F.asc(key))
