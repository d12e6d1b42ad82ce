"""All analyses over one table, from two passes over it."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.analysis import (
    HIGH_MAGNITUDE,
    AsOf,
    above,
    day_of,
    last_week,
    place_totals,
    top_area,
)
from tremor.sinks import scratch, stored


def area_day_summary(
    df: DataFrame, *, area: str = "area", mag: str = "mag", loaded: str = "insert_dt"
) -> DataFrame:
    """Per area and load day: rows, measured rows, total and largest magnitude.

    Everything asked by area, by day or by both follows from it, and its size is
    areas times days, whatever the size of the table.
    """
    return df.groupBy(F.col(area).alias("area"), day_of(df, loaded).alias("day")).agg(
        F.count("*").alias("n"),
        F.count(mag).alias("measured"),
        F.sum(mag).alias("total"),
        F.max(mag).alias("max_mag"),
    )


def analyses(
    df: DataFrame,
    as_of: AsOf = None,
    *,
    threshold: float = HIGH_MAGNITUDE,
    area: str = "area",
    mag: str = "mag",
    place: str = "place",
    loaded: str = "insert_dt",
    share: Callable[[DataFrame], DataFrame] = stored,
) -> dict[str, DataFrame]:
    """The standard analyses by name.

    Two aggregates are computed here and now, one by area and day and one by
    place, each in one pass, and every answer is read from them. ``share`` says
    how they are kept: by default as files in the shared folder; an identity
    function keeps nothing and leaves each answer to scan for itself.
    """
    days = share(area_day_summary(df, area=area, mag=mag, loaded=loaded))
    places = share(place_totals(df, place, mag).withColumnRenamed(place, "place"))
    return answers_from(days, places, as_of, threshold=threshold)


def answers_from(
    days: DataFrame, places: DataFrame, as_of: AsOf = None, *, threshold: float = HIGH_MAGNITUDE
) -> dict[str, DataFrame]:
    """The standard analyses, from one aggregate by area and day and one by place."""
    n = F.sum("n")
    by_area = days.groupBy("area")
    by_day = days.groupBy("day").agg(n.alias("n"))
    by_day_area = days.select("day", "area", "n")
    max_by_area = by_area.agg(F.max("max_mag").alias("max_mag"))
    in_order = [F.asc("place")]
    return {
        "count_by_area": by_area.agg(n.alias("n")),
        "mean_mag_by_area": by_area.agg(
            F.try_divide(F.sum("total"), F.sum("measured")).alias("avg_mag")
        ),
        "count_by_day": by_day,
        "count_by_day_area": by_day_area,
        "mean_daily_count": by_day.agg(F.avg("n").alias("avg_n")),
        "mean_daily_count_per_day": by_day.select("day", F.col("n").cast("double").alias("avg_n")),
        "mean_daily_area_count": by_day_area.agg(F.avg("n").alias("avg_n")),
        "mean_of_ones_day_area": by_day_area.select("day", "area", F.lit(1.0).alias("avg_n")),
        "max_mag_by_area": max_by_area,
        "top_area": top_area(days, mag="max_mag"),
        "strongest_last_week": top_area(last_week(days, "day", as_of), mag="max_mag", name="mag"),
        "areas_above": above(max_by_area, "max_mag", threshold).select("area"),
        "frequency": places.select("place", "frequency").orderBy(F.desc("frequency"), *in_order),
        "intensity": places.select("place", "intensity").orderBy(F.desc("intensity"), *in_order),
        "frequency_intensity": places.where(F.col("place").isNotNull()).orderBy(
            F.desc("frequency"), F.desc("intensity"), *in_order
        ),
    }


@contextmanager
def analyses_for_now(df: DataFrame, as_of: AsOf = None, **options) -> Iterator[dict[str, DataFrame]]:
    """The standard analyses for as long as the block runs.

    What they are read from is then removed from the shared folder.
    """
    with scratch(df.sparkSession, "analyses") as folder:
        number = count()

        def share(aggregate: DataFrame) -> DataFrame:
            return stored(aggregate, path=f"{folder}/{next(number)}")

        yield analyses(df, as_of, share=share, **options)
