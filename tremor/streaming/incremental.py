"""The daily load as a stream over the landing folder.

Each run takes what was landed since the last one. The stream keeps no state but
the checkpoint's list of files, so there is nothing to watermark.
"""

from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tremor import schema
from tremor.plans.load import rejects_path, silver_rows, spread_by_default
from tremor.sinks import move_folders, remove, write_rejects, write_silver, write_table
from tremor.sources import (
    NoFeaturesError,
    checked_layout,
    content_column,
    parse_landed,
    scan_silver,
    silver_path,
)

_PARTITIONS = tuple(schema.LANDING_PARTITIONS.names)

#: Folders of a batch that a task writes to at once; rows of more than that are sorted by folder.
OPEN_FOLDERS = 8


def landing_stream(
    spark: SparkSession,
    landing: str,
    *,
    layout: str = "collections",
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream of partitioned landing folders, parsed, with ``feed`` and ``load_date``.

    ``options`` go to the file source, such as ``cleanSource`` to archive landed
    files once they are loaded, which keeps the listing of the folder short.
    """
    fields = T.StructType([T.StructField("value", T.StringType()), *schema.LANDING_PARTITIONS])
    reader = spark.readStream.schema(fields).options(**options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_landed(reader.text(landing, wholetext=multi_line), layout, _PARTITIONS)


def load_incremental(
    spark: SparkSession,
    landing: str,
    silver: str,
    checkpoint: str,
    *,
    table: str | None = None,
    table_path: str | None = None,
    layout: str = "collections",
    multi_line: bool = False,
    variant: str = "typed",
    area_rule: str | None = None,
    load_ts: datetime | None = None,
    rebalance: bool | None = None,
    rejects: str | None = None,
    keep_good: bool = False,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Start a run over everything landed and not yet loaded; it ends by itself.

    A micro-batch overwrites only its own ``load_id`` folders, which are named
    after the query and the batch number. When a run is cut short, the next one
    repeats the batch that was open and replaces what there is of it, so no row
    is lost or doubled. Loads by ``load`` can share the silver folder. ``table``
    is partitioned by feed, day and load id, and filled in the same way.

    The landed files are read and parsed once: documents are counted in the pass
    that writes, into a folder below silver that no scan looks into, and what it
    wrote is moved into place when the counts are known.

    Documents without features go to ``rejects``, as in ``load``; only a batch that
    has some is read again. It then fails before silver changes, stays open, and is
    taken up by the next run; with ``keep_good`` it goes on with the rest. Each
    progress report of the query has the numbers of documents and of readable ones,
    observed as ``landed``.
    """
    checked_layout(layout)
    schema.silver_schema(variant)
    rejects = rejects or rejects_path(silver)
    keys = tuple(schema.SILVER_PARTITIONS.names)

    def write_batch(batch: DataFrame, number: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the batch has no query id to name its folders after")
        load_id = f"stream-{query_id}-{number}"
        content = F.col(content_column(batch))
        seen = Observation()
        counted = batch.observe(
            seen, F.count("*").alias("documents"), F.count(content).alias("readable")
        )
        rows = silver_rows(
            counted.where(content.isNotNull()),
            layout=layout,
            variant=variant,
            area_rule=area_rule,
            load_ts=load_ts,
            keep=_PARTITIONS,
        )
        # The leading underscore hides the folder from scans of silver.
        aside = f"{silver.rstrip('/')}/_open/{load_id}"
        try:
            write_silver(
                rows.withColumn("load_id", F.lit(load_id)),
                aside,
                "overwrite",
                variant=variant,
                partition_by=keys,
                rebalance=spread_by_default(batch, layout) if rebalance is None else rebalance,
                open_folders=OPEN_FOLDERS,
            )
            if seen.get["documents"] != seen.get["readable"]:
                bad = batch.where(content.isNull()).withColumn("load_id", F.lit(load_id))
                write_rejects(bad, rejects, replace_partitions=True)
                if not keep_good:
                    raise NoFeaturesError(
                        f"documents without features are in {rejects}, load_id={load_id}"
                    )
            moved = move_folders(batch.sparkSession, aside, silver, len(keys))
        finally:
            remove(batch.sparkSession, aside)
        if table is not None:
            _fill_table(batch.sparkSession, load_id, moved)

    def _fill_table(session: SparkSession, load_id: str, folders: list[str]) -> None:
        """Each feed and day of the batch, from the silver folder it has just written."""
        for folder in folders:
            partition = dict(unquote(part).split("=", 1) for part in folder.split("/"))
            feed, day = partition["feed"], date.fromisoformat(partition["load_date"])
            rows = scan_silver(session, silver_path(silver, feed, day), variant)
            # As constants the folder's values leave nothing to sort by.
            kinds = {f.name: f.dataType for f in schema.SILVER_PARTITIONS}
            constant = {key: F.lit(partition[key]).cast(kind) for key, kind in kinds.items()}
            rows = rows.where(F.col("load_id") == load_id).drop(*kinds).withColumns(constant)
            write_table(
                rows, table, "replace_partition", partition=partition, path=table_path, **schema.PARQUET_OPTIONS
            )

    stream = landing_stream(
        spark,
        landing,
        layout=layout,
        multi_line=multi_line,
        max_files_per_trigger=max_files_per_trigger,
        **options,
    )
    counted = stream.observe(
        "landed",
        F.count("*").alias("documents"),
        F.count(F.col(content_column(stream))).alias("readable"),
    )
    return (
        counted.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
