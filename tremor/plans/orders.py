"""The order report: mean value, and users split by their total."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tremor.operators.analysis import above
from tremor.operators.orders import (
    LARGE_TOTAL,
    MIN_ORDER_VALUE,
    mean_from_totals,
    split_by_threshold,
    tag_by_threshold,
    user_totals,
)
from tremor.sinks import scratch, stored, write_tagged_pairs
from tremor.sources import scan_completed_orders
from tremor.sources.tables import COMPLETED

# Folders of the two sides.
SIDES = ("large_orders", "small_orders")


@dataclass(frozen=True)
class OrderReport:
    mean_value: DataFrame
    large_orders: DataFrame
    small_orders: DataFrame


def order_report(
    orders: DataFrame,
    output: str | None = None,
    *,
    status: str = COMPLETED,
    min_value: float = MIN_ORDER_VALUE,
    large_total: float = LARGE_TOTAL,
    share: Callable[[DataFrame], DataFrame] = stored,
) -> OrderReport:
    """Report on completed orders above ``min_value``.

    The orders are scanned and shuffled once, into stored totals per user; the
    mean and both sides of the split are read from those. With ``output``, the
    sides are written as text below ``large_orders`` and ``small_orders``, in one pass
    over the totals. ``share`` keeps the totals, by default as files in the shared folder.
    """
    valued = above(scan_completed_orders(orders, status), "order_value", min_value)
    totals = share(user_totals(valued))
    large, small = split_by_threshold(totals.select("user_id", "total"), "total", large_total)
    if output is not None:
        tagged = tag_by_threshold(totals, "total", large_total, *SIDES)
        write_tagged_pairs(tagged, output, "side", SIDES, "user_id", "total")
    return OrderReport(mean_from_totals(totals), large, small)


@contextmanager
def order_report_for_now(
    orders: DataFrame, output: str | None = None, **options
) -> Iterator[OrderReport]:
    """The report for as long as the block runs; the stored totals are then removed."""
    with scratch(orders.sparkSession, "user-totals") as path:
        yield order_report(orders, output, share=lambda totals: stored(totals, path=path), **options)
