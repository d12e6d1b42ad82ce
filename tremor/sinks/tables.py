"""Table sink."""

from pyspark.sql import DataFrame, SparkSession

from tremor.sinks.scratch import remove


def _partition_columns(spark: SparkSession, name: str) -> tuple[str, ...]:
    return tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _own_location(spark: SparkSession, name: str) -> str | None:
    """Where an external table lies; None for one in the warehouse."""
    facts = _facts(spark, name)
    return facts.get("Location") if facts.get("Type") == "EXTERNAL" else None


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partition(spark: SparkSession, name: str, partition: dict[str, str]) -> None:
    """Remove one partition with its files, also of an external table, or one half written."""
    if not spark.catalog.tableExists(name):
        return
    folder = "/".join(f"{key}={value}" for key, value in partition.items())
    spec = ", ".join(f"{key} = {_quoted(value)}" for key, value in partition.items())
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    remove(spark, f"{_facts(spark, name)['Location']}/{folder}")
    spark.catalog.refreshTable(name)


def _replace_partition(df: DataFrame, name: str, partition: dict[str, str]) -> None:
    spark = df.sparkSession
    columns = _partition_columns(spark, name)
    if columns != tuple(partition):
        raise ValueError(f"{name} is partitioned by {columns}, not by {tuple(partition)}")
    # A named partition is replaced whole, also by no rows, whatever the session's settings.
    spec = ", ".join(f"{key} = {_quoted(value)}" for key, value in partition.items())
    rows = df.select(*(c for c in spark.table(name).columns if c not in partition))
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT * FROM {{rows}}", rows=rows)


def write_table(
    df: DataFrame,
    name: str,
    mode: str,
    *,
    partition_by: tuple[str, ...] = (),
    partition: dict[str, str] | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    path: str | None = None,
    fmt: str | None = None,
    **options: str,
) -> None:
    """Write to a catalog table, creating it where it does not exist.

    ``append`` adds rows, ``overwrite`` replaces the table, which stays where it
    lies, and ``replace_partition`` replaces the one ``partition`` (values by
    column, in the table's order), also when ``df`` has no rows.
    ``bucket_by`` deals the rows to ``buckets`` files by the hash of a column, so that
    grouping and joining by it needs no shuffle; the table's rows with one value all
    go to one task then, so they should be few. It has to be given at every append.
    ``path`` places a new table outside the warehouse. With ``fmt`` the table is
    a connector's, which knows the first two modes and its own ``options``. Those of a
    catalog table are kept with it when it is created.
    """
    spark = df.sparkSession
    if fmt is not None:
        if mode == "replace_partition":
            raise ValueError("a connector's table cannot be replaced by partition")
        df.write.format(fmt).option("table", name).options(**options).mode(mode).save()
        return
    exists = spark.catalog.tableExists(name)
    if bucket_by is not None:
        # By the hash that the buckets have too: a task writes one file in each partition.
        df = df.repartition(buckets, bucket_by)
    if mode == "replace_partition":
        if not partition:
            raise ValueError("replace_partition needs the partition")
        partition_by = partition_by or tuple(partition)
        if exists:
            _replace_partition(df, name, partition)
            return
    if exists and mode == "overwrite":
        path = path or _own_location(spark, name)
    writer = df.write.mode("append" if mode == "replace_partition" else mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
