"""Each load's share of the analyses, kept with its load id and merged when they are asked for.

A load writes one small aggregate by area and day and one by place of its own rows. The analyses
over all loads that count are sums and maxima of those shares: a daily load reads its own rows
only, and the answers never go back to the rows of earlier days. A load that is replaced takes its
shares with it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor import schema
from tremor.operators.analysis import HIGH_MAGNITUDE, AsOf, place_totals
from tremor.plans.suite import answers_from, area_day_summary
from tremor.sinks import Journal, remove, stored

_SHARES = {
    "days": "area string, day date, n bigint, measured bigint, total double, max_mag double, load_id string",
    "places": "place string, frequency bigint, intensity double, load_id string",
}


def write_partials(rows: DataFrame, path: str, load_id: str, variant: str = "typed") -> None:
    """Write the shares of one load's silver rows below ``path``."""
    names = schema.ANALYSIS_COLUMNS[variant]
    days = area_day_summary(rows, **names)
    days = days.withColumn("day", F.col("day").cast("date"))
    places = place_totals(rows, "place", names["mag"])
    for name, share in (("days", days), ("places", places)):
        share.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}/load_id={load_id}")


def drop_partials(spark: SparkSession, path: str, load_id: str) -> None:
    for name in _SHARES:
        remove(spark, f"{path.rstrip('/')}/{name}/load_id={load_id}")


def merged_partials(spark: SparkSession, path: str, load_ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """The aggregates by area and day, and by place, of some loads together."""

    def shares(name: str) -> DataFrame:
        if not load_ids:
            return spark.createDataFrame([], _SHARES[name])
        rows = spark.read.schema(_SHARES[name]).parquet(f"{path.rstrip('/')}/{name}")
        return rows.where(F.col("load_id").isin(load_ids))

    days = shares("days").groupBy("area", "day").agg(
        *(F.sum(c).alias(c) for c in ("n", "measured", "total")), F.max("max_mag").alias("max_mag")
    )
    places = shares("places").groupBy("place").agg(
        *(F.sum(c).alias(c) for c in ("frequency", "intensity"))
    )
    return days, places


def analyses_of_loads(
    spark: SparkSession,
    journal: str,
    table: str,
    path: str,
    as_of: AsOf = None,
    *,
    threshold: float = HIGH_MAGNITUDE,
) -> dict[str, DataFrame]:
    """The standard analyses over the loads that count in a table, from their shares alone."""
    ids = list(Journal(spark, journal).table_loads(table))
    days, places = (stored(share, "merged") for share in merged_partials(spark, path, ids))
    return answers_from(days, places, as_of, threshold=threshold)
