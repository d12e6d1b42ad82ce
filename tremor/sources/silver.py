"""Scan of silver Parquet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tremor import schema


def scan_silver(
    spark: SparkSession, path: str, variant: str = "typed", partitioned: bool = True
) -> DataFrame:
    """Silver rows with their declared schema, so that no footer is read for it.

    ``feed``, ``load_date`` and ``load_id`` follow as partition columns, and
    filters on them skip whole folders. A folder written without partitions is
    read with ``partitioned=False``.
    """
    fields = schema.silver_schema(variant)
    reader = spark.read
    if partitioned:
        fields = T.StructType([*fields, *schema.SILVER_PARTITIONS])
        # The folder above all partitions, so that a feed's or a day's own folder
        # still says what feed and day it is.
        root, found, _ = path.partition("/feed=")
        reader = reader.option("basePath", root) if found else reader
    return reader.schema(fields).parquet(path)
