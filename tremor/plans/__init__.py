"""Pipelines built from the sources, operators and sinks."""

from tremor.plans.load import Load, load, recover, scan_loads, split_landing
from tremor.plans.orders import OrderReport, order_report, order_report_for_now
from tremor.plans.partials import analyses_of_loads
from tremor.plans.places import (
    change_of_places,
    drop_place_totals,
    frequency_intensity_of_totals,
    scan_place_totals,
    write_place_totals,
)
from tremor.plans.suite import analyses, analyses_for_now, area_day_summary

__all__ = [
    "Load",
    "OrderReport",
    "analyses",
    "analyses_for_now",
    "analyses_of_loads",
    "area_day_summary",
    "change_of_places",
    "drop_place_totals",
    "frequency_intensity_of_totals",
    "load",
    "order_report",
    "order_report_for_now",
    "recover",
    "scan_loads",
    "scan_place_totals",
    "split_landing",
    "write_place_totals",
]
