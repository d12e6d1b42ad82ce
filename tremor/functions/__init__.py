"""Column-to-column functions."""

from tremor.functions.area import AREA_RULES, area_comma, area_tail
from tremor.functions.text import pair_text, plain_number
from tremor.functions.time import (
    as_utc,
    epoch_ms_to_str,
    epoch_ms_to_ts,
    load_day,
    load_day_plain,
    load_day_text,
    load_instant,
    load_instant_text,
    naive_utc,
    utc_now,
)

__all__ = [
    "as_utc",
    "AREA_RULES",
    "area_comma",
    "area_tail",
    "epoch_ms_to_str",
    "epoch_ms_to_ts",
    "load_day",
    "load_day_plain",
    "load_day_text",
    "load_instant",
    "load_instant_text",
    "naive_utc",
    "pair_text",
    "plain_number",
    "utc_now",
]
