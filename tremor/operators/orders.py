"""Filter, total and split of order records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An order's least value, and the total that makes a user large.
MIN_ORDER_VALUE = 100
LARGE_TOTAL = 500


def mean_order_value(orders: DataFrame, value: str = "order_value", name: str = "avg_value") -> DataFrame:
    """Mean value over all given orders: one number, null without orders."""
    return orders.agg(F.avg(value).alias(name))


def sum_per_user(
    orders: DataFrame, user: str = "user_id", value: str = "order_value", name: str = "total"
) -> DataFrame:
    """Total value per user."""
    return orders.groupBy(user).agg(F.sum(value).alias(name))


def user_totals(orders: DataFrame, user: str = "user_id", value: str = "order_value") -> DataFrame:
    """Total value per user with the number of values in it, so that the mean over
    all orders follows from the totals."""
    return orders.groupBy(user).agg(F.sum(value).alias("total"), F.count(value).alias("orders"))


def mean_from_totals(totals: DataFrame, name: str = "avg_value") -> DataFrame:
    """The mean order value, from ``user_totals``."""
    return totals.agg(F.try_divide(F.sum("total"), F.sum("orders")).alias(name))


def split_by_threshold(df: DataFrame, col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows strictly above the threshold, and all the others, nulls among them."""
    large = F.coalesce(F.col(col) > F.lit(threshold), F.lit(False))
    return df.where(large), df.where(~large)


def tag_by_threshold(
    df: DataFrame, col: str, threshold: float, above: str, rest: str, name: str = "side"
) -> DataFrame:
    """The same split as a column, for a sink that writes both sides in one pass."""
    return df.withColumn(name, F.when(F.col(col) > F.lit(threshold), above).otherwise(rest))
