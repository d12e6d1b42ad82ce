"""Totals per place in a table laid out by place, for answers without a shuffle.

Each load adds one row for each of its places, in a partition of its own, dealt to buckets by
the hash of the place. Spark reads a bucket of all loads in one task, so that grouping by place,
and joining two such tables by place, needs no exchange: only the sort of an answer has one.
A place with a third of all events has one row in each load and does not make its bucket large,
which the events themselves would.

A load that is repeated under its id replaces its rows, also by none. A null place is kept; the
answers treat it as those from the events do.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.analysis import place_totals
from tremor.sinks import drop_partition, write_table

#: Tasks that read the table, and files of each load in it. It is fixed when the table is made:
#: some 100 MB of totals a bucket is a good size for what the table will hold.
BUCKETS = 64


def write_place_totals(
    rows: DataFrame,
    table: str,
    load_id: str,
    *,
    place: str = "place",
    mag: str = "mag",
    buckets: int = BUCKETS,
    path: str | None = None,
) -> None:
    """Put the totals of one load's rows into the table, instead of what the load had there."""
    totals = place_totals(rows, place, mag).withColumnRenamed(place, "place")
    write_table(
        totals.withColumn("load_id", F.lit(load_id)),
        table,
        "replace_partition",
        partition={"load_id": load_id},
        bucket_by="place",
        buckets=buckets,
        path=path,
    )


def drop_place_totals(spark: SparkSession, table: str, load_id: str) -> None:
    drop_partition(spark, table, {"load_id": load_id})


def scan_place_totals(spark: SparkSession, table: str, load_ids: list[str] | None = None) -> DataFrame:
    """Place, frequency and intensity over all loads, or over some, which are the only ones read.

    The result is dealt by place; a join of two of them by place is done where the rows are.
    """
    rows = spark.read.table(table)
    if load_ids is not None:
        rows = rows.where(F.col("load_id").isin(load_ids))
    return rows.groupBy("place").agg(*(F.sum(c).alias(c) for c in ("frequency", "intensity")))


def frequency_intensity_of_totals(totals: DataFrame) -> DataFrame:
    """Frequency and intensity side by side, most frequent first, without the null place."""
    known = totals.where(F.col("place").isNotNull())
    return known.orderBy(F.desc("frequency"), F.desc("intensity"), F.asc("place"))


def change_of_places(before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals of two sets of loads side by side: the places that are in both."""
    old, new = (
        df.select("place", *(F.col(c).alias(f"{c}_{side}") for c in ("frequency", "intensity")))
        for df, side in ((before, "before"), (after, "after"))
    )
    # Both lie by place: merged in order, without sending either to all tasks.
    return old.join(new.hint("merge"), "place")
