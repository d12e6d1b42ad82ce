"""Scans of catalog and connector tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the status of an order that counts.
COMPLETED = "COMPLETED"


def scan_table(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> DataFrame:
    """A table by name, from the catalog or, with ``fmt``, from a connector.

    Select and filter on the result: Catalyst hands both to the source.
    """
    if fmt is None:
        return spark.read.table(name)
    return spark.read.format(fmt).option("table", name).options(**options).load()


def scan_completed_orders(orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    """User, order and value of the orders in ``status``."""
    return orders.where(F.col("order_status") == F.lit(status)).select(
        "user_id", "order_id", "order_value"
    )
