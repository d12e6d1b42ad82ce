"""Landing to silver to table, for either feed."""

from dataclasses import dataclass
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor import schema
from tremor.functions import as_utc, utc_now
from tremor.operators.flatten import explode_features, flatten, transform
from tremor.plans.partials import drop_partials, write_partials
from tremor.sinks import (
    Journal,
    Record,
    drop_partition,
    exists,
    remove,
    remove_others,
    write_landing,
    write_rejects,
    write_silver,
    write_table,
)
from tremor.sources import (
    NoFeaturesError,
    content_column,
    landing_path,
    scan_landed,
    scan_silver,
    scan_table,
    silver_path,
)

MODES = ("append", "overwrite", "replace_partition")

# What each feed has done from the start: history replaces, the day adds.
DEFAULT_MODE = {"daily": "append", "historical": "overwrite"}

TABLE_PARTITIONS = ("feed", "load_date")


@dataclass(frozen=True)
class Load:
    """Where a load went, its id below the silver folder of its feed and day, how many
    landed documents it saw, how many of them are in the rejects folder, and that folder."""

    load_id: str
    day: str
    documents: int
    unreadable: int
    rejects: str


def rejects_path(silver: str) -> str:
    """Where unreadable documents are kept unless a load says otherwise."""
    return f"{silver.rstrip('/')}-rejects"


def spread_by_default(landed: DataFrame, layout: str) -> bool:
    """If rows should be spread before they are written: collections that leave more than half
    of the cores idle when they are read. Else parsing keeps them busy, and writing follows it."""
    if layout != "collections":
        return False
    return 2 * landed.rdd.getNumPartitions() < landed.sparkSession.sparkContext.defaultParallelism


def silver_rows(
    landed: DataFrame,
    *,
    layout: str = "collections",
    variant: str = "typed",
    area_rule: str | None = None,
    load_ts: datetime | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Silver rows of landed collections or features; used by batch and stream."""
    features = explode_features(landed, keep) if layout == "collections" else landed
    return transform(flatten(features, variant, keep), load_ts, area_rule, variant, keep)


def load(
    spark: SparkSession,
    feed: str,
    run_date: date,
    *,
    landing: str,
    silver: str,
    table: str | None = None,
    mode: str | None = None,
    layout: str = "collections",
    style: str = "partitioned",
    multi_line: bool = False,
    variant: str = "typed",
    area_rule: str | None = None,
    load_ts: datetime | None = None,
    rebalance: bool | None = None,
    rejects: str | None = None,
    keep_good: bool = False,
    table_path: str | None = None,
    table_format: str | None = None,
    table_options: dict[str, str] | None = None,
    journal: str | None = None,
    aggregates: str | None = None,
) -> Load:
    """Load one landed day of one feed.

    The landing JSON is parsed once: the table is filled from the silver files of
    this load, which lie in a ``load_id`` folder of their own, so both layers hold
    the same rows and the same load instant.

    ``append`` adds to the day and to the table, ``overwrite`` replaces the feed's
    day in silver and the whole table, ``replace_partition`` replaces the feed's
    day in both. New rows are written before old ones go, so that a reader may see
    both for a moment, never neither. A load that broke off is repeated safely
    with the last.

    Every document is counted in the pass that writes. Those without features go to
    ``rejects`` with their text, feed, day and load id, never to silver. The load
    then fails before old rows or the table change; with ``keep_good`` it goes on
    with the rest.

    With a ``journal`` silver, table and ``aggregates`` change as one: nothing of the
    load counts before its record is committed, all of it does from then on, and what
    a load that broke off left behind is finished or undone first (``recover``). Rows
    that were replaced go afterwards. The table has the load id as a third partition
    column. ``scan_loads`` reads what counts. ``aggregates`` is a folder for this
    load's share of the analyses (``tremor.plans.partials``).

    ``layout`` is ``collections`` (one document per line), ``features`` (one
    feature per line, the one that scales with the size of a file; see
    ``split_landing``) or ``documents`` (files of one document of any size and
    spelling, read by many tasks). A collection is parsed by one task, so where tasks for
    fewer than half of the cores read collections, their rows are rebalanced before they are
    written; with ``rebalance`` always or never. With
    ``table_format`` and ``table_options`` the table is a connector's.
    """
    source = landing_path(landing, feed, run_date, style)
    mode = mode or DEFAULT_MODE[feed]
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if aggregates is not None and (journal is None or table is None):
        raise ValueError("aggregates are kept with a journal and a table")
    if journal is not None and table_format is not None:
        raise ValueError("a connector's table cannot be part of a journal")
    book = Journal(spark, journal) if journal is not None else None
    if book is not None:
        recover(spark, book)
    landed = scan_landed(spark, source, layout, multi_line=multi_line)
    content = F.col(content_column(landed))

    load_id = f"batch-{uuid4().hex}"
    day = silver_path(silver, feed, run_date)
    partition = {"feed": feed, "load_date": run_date.isoformat()}
    rejects = rejects or rejects_path(silver)
    # All rows of a load carry one instant, so that its folder holds one day.
    load_ts = load_ts or utc_now()
    loaded = as_utc(load_ts).date().isoformat()
    record = Record(
        load_id,
        **partition,
        mode=mode,
        silver=day,
        table=table,
        aggregates=aggregates,
        rejects=rejects,
        first_day=loaded,
        last_day=loaded,
    )
    if book is not None:
        book.begin(record)
    # Counted on the way, before any shuffle, in the pass that writes silver.
    seen = Observation()
    counted = landed.observe(
        seen, F.count("*").alias("documents"), F.count(content).alias("readable")
    )
    rows = silver_rows(
        counted.where(content.isNotNull()),
        layout=layout,
        variant=variant,
        area_rule=area_rule,
        load_ts=load_ts,
    ).withColumn("load_id", F.lit(load_id))
    write_silver(
        rows,
        day,
        "append",
        variant=variant,
        partition_by=("load_id",),
        rebalance=spread_by_default(landed, layout) if rebalance is None else rebalance,
    )

    documents, readable = seen.get["documents"], seen.get["readable"]
    written = Load(load_id, day, documents, documents - readable, rejects)
    if written.unreadable:
        bad = landed.where(content.isNull()).withColumns(
            {
                "feed": F.lit(feed),
                "load_date": F.lit(run_date.isoformat()).cast("date"),
                "load_id": F.lit(load_id),
            }
        )
        write_rejects(bad, rejects)
        if not keep_good:
            remove(spark, f"{day}/load_id={load_id}")
            if book is not None:
                book.forget(load_id)
            raise NoFeaturesError(
                f"{written.unreadable} of {documents} documents hold no features and are in "
                f"{rejects}, load_id={load_id}; is a file pretty-printed (multi_line)?"
            )
    if book is None and mode != "append":
        remove_others(spark, day, f"load_id={load_id}")

    if table is not None:
        fresh = loaded_rows(spark, written, variant).withColumns(
            {
                "feed": F.lit(feed),
                "load_date": F.lit(run_date.isoformat()).cast("date"),
            }
        )
        if book is not None:
            fresh = fresh.withColumn("load_id", F.lit(load_id))
        write_table(
            fresh,
            table,
            mode if book is None else "append",
            partition_by=TABLE_PARTITIONS if book is None else (*TABLE_PARTITIONS, "load_id"),
            partition=partition if mode == "replace_partition" and book is None else None,
            path=table_path,
            fmt=table_format,
            **((table_options or {}) if table_format else schema.PARQUET_OPTIONS),
        )
    if aggregates is not None:
        write_partials(loaded_rows(spark, written, variant), aggregates, load_id, variant)
    if book is not None:
        finish(spark, book, book.commit(record))
    return written


def _drop_load(spark: SparkSession, record: Record, load_id: str) -> None:
    """Remove a load's rows from its table and its share of the aggregates."""
    feed, day = record.feed, record.load_date
    if record.table is not None:
        drop_partition(spark, record.table, {"feed": feed, "load_date": day, "load_id": load_id})
    if record.aggregates is not None:
        drop_partials(spark, record.aggregates, load_id)


def finish(spark: SparkSession, book: Journal, record: Record) -> None:
    """Remove what a committed load replaced; done twice, the second time finds nothing."""
    replaced = {r.load_id: r for r in book.committed()} if record.gone_silver or record.gone_table else {}
    for load_id in record.gone_silver:
        remove(spark, f"{replaced[load_id].silver}/load_id={load_id}")
    for load_id in record.gone_table:
        _drop_load(spark, replaced[load_id], load_id)
    book.forget(record.load_id)


def recover(spark: SparkSession, book: Journal) -> None:
    """Finish or undo the loads that broke off."""
    done = {r.load_id: r for r in book.committed()}
    for record in book.begun():
        if record.load_id in done:
            finish(spark, book, done[record.load_id])
            continue
        remove(spark, f"{record.silver}/load_id={record.load_id}")
        _drop_load(spark, record, record.load_id)
        day = f"feed={record.feed}/load_date={record.load_date}/load_id={record.load_id}"
        remove(spark, f"{record.rejects}/{day}")
        book.forget(record.load_id)


def scan_loads(
    spark: SparkSession,
    journal: str,
    *,
    silver: str | None = None,
    table: str | None = None,
    variant: str = "typed",
) -> DataFrame:
    """The rows of silver, or of a table, that count by the journal; other folders are not read."""
    book = Journal(spark, journal)
    if (silver is None) == (table is None):
        raise ValueError("name either silver or a table")
    ids = list(book.silver_loads() if table is None else book.table_loads(table))
    if not ids:
        fields = [*schema.silver_schema(variant), *schema.SILVER_PARTITIONS]
        return spark.createDataFrame([], T.StructType(fields))
    rows = scan_silver(spark, silver, variant) if table is None else scan_table(spark, table)
    return rows.where(F.col("load_id").isin(ids))


def split_landing(
    spark: SparkSession, source: str, target: str, *, multi_line: bool = False
) -> None:
    """Rewrite landed collections as feature lines, which files of any size are split by.

    A collection is parsed by one task; its features are spread before they are written.
    """
    collections = scan_landed(spark, source, multi_line=multi_line)
    bad = collections.where(F.col("features").isNull()).count()
    if bad:
        raise NoFeaturesError(f"{bad} documents in {source} hold no features")
    features = explode_features(collections).hint("rebalance")
    write_landing(features.select("feature.*"), target)


def loaded_rows(spark: SparkSession, done: Load, variant: str = "typed") -> DataFrame:
    """The silver rows that one load wrote; the filter leaves only its folder to read."""
    if not exists(spark, f"{done.day}/load_id={done.load_id}"):  # a load without rows
        return spark.createDataFrame([], schema.silver_schema(variant))
    rows = scan_silver(spark, done.day, variant)
    return rows.where(F.col("load_id") == done.load_id).drop(*schema.SILVER_PARTITIONS.names)
