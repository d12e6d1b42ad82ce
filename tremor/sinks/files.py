"""File sinks. Every task writes its own files; nothing passes the driver."""

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor import schema
from tremor.functions import pair_text
from tremor.sinks.scratch import move_folder, remove


def write_landing(
    df: DataFrame, path: str, mode: str = "overwrite", *, compression: str = "none", lines_per_file: int = 0
) -> None:
    """Land each row as one line of JSON, null fields included.

    Landing a folder again replaces it; ``append`` adds files to it. With ``compression``
    a line has an eighth of its size or less, but a file is then read by one task, so give
    ``lines_per_file`` too; the layout ``documents`` takes no compressed files.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", False).option("compression", compression)
    writer.option("maxRecordsPerFile", lines_per_file).json(path)


def write_rejects(df: DataFrame, path: str, *, replace_partitions: bool = False) -> None:
    """Keep unreadable documents: their text by feed, day and load."""
    rows = df.select(F.col("value").alias("text"), *schema.SILVER_PARTITIONS.names)
    mode = "dynamic" if replace_partitions else "static"
    writer = rows.write.mode("overwrite" if replace_partitions else "append")
    writer = writer.option("partitionOverwriteMode", mode)
    writer.partitionBy(*schema.SILVER_PARTITIONS.names).parquet(path)


@contextmanager
def _open_at_once(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let tasks write into so many folders at once, without sorting their rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, folders)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_silver(
    df: DataFrame,
    path: str,
    mode: str,
    *,
    variant: str = "typed",
    partition_by: tuple[str, ...] = (),
    rebalance: bool = False,
    replace_partitions: bool = False,
    open_folders: int = 0,
) -> None:
    """Write silver Parquet (Snappy) with exactly the declared columns and types, and a
    dictionary for those whose values repeat.

    ``rebalance`` lets adaptive execution even out the files, at the cost of a
    shuffle: worth it where a few tasks hold most of the features.
    ``replace_partitions`` makes an overwrite touch only the partitions that
    occur in ``df``. With ``open_folders`` a task has a file open in each of so many
    folders and sorts only the rows of further ones; otherwise it sorts all its rows by
    folder, and spills them where they exceed its memory.
    """
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.silver_schema(variant)]
    rows = df.select(*fields, *partition_by)
    if rebalance:
        rows = rows.hint("rebalance")
    writer = rows.write.mode(mode).option("compression", "snappy").options(**schema.PARQUET_OPTIONS)
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace_partitions else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _open_at_once(df.sparkSession, open_folders) if open_folders else nullcontext():
        writer.parquet(path)


def _pair_lines(df: DataFrame, key: str, value: str) -> Column:
    quoted = isinstance(df.schema[key].dataType, T.StringType)
    return pair_text(key, value, quoted).alias("value")


def write_pairs_text(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """Write ``(key, value)`` lines to ``.txt`` files."""
    df.select(_pair_lines(df, key, value)).write.mode(mode).text(path)


def write_tagged_pairs(
    df: DataFrame, path: str, tag: str, names: tuple[str, ...], key: str, value: str
) -> None:
    """Write ``(key, value)`` lines to a folder for each of the tag's ``names``, in one pass.

    The folders take the place of what was there when all of them are written; a
    tag without rows leaves an empty one. All rows must have one of the names.
    """
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}/_open-{uuid4().hex}"
    try:
        df.select(_pair_lines(df, key, value), F.col(tag).alias("tag")).write.partitionBy("tag").text(aside)
        for name in names:
            move_folder(spark, f"{aside}/tag={name}", f"{path.rstrip('/')}/{name}")
    finally:
        remove(spark, aside)
