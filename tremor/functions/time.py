"""Epoch milliseconds, load instants and load days. Everything is UTC."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.functions._columns import ColumnOrName, column

# Years 1 to 9999, the range in which a timestamp can be printed and read back.
EPOCH_MS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)

# Up to 18 digits after any zeros, which always fit 64 bits.
_WHOLE_NUMBER = r"^\s*[+-]?0*\d{1,18}\s*$"

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _epoch_seconds(c: ColumnOrName) -> Column:
    """Whole seconds, floored; null unless the value is a whole number in range.

    try_cast alone would do, but it throws and catches an exception for each bad
    value, at a hundred times the cost of a good one.
    """
    text = column(c).cast("string")
    seconds = F.floor(F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint")) / 1000)
    low, high = (limit // 1000 for limit in EPOCH_MS_RANGE)
    return F.when(seconds.between(low, high), seconds)


def epoch_ms_to_ts(c: ColumnOrName) -> Column:
    """Epoch milliseconds as a timestamp of whole seconds.

    The instant does not pass through local time, so no session time zone can
    move it.
    """
    return F.timestamp_seconds(_epoch_seconds(c))


def epoch_ms_to_str(c: ColumnOrName) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, in any session zone."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _epoch_seconds(c))
    return (zero + whole).cast("string")


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def as_utc(instant: datetime) -> datetime:
    """A datetime without a zone is taken as UTC."""
    if instant.tzinfo is None:
        return instant.replace(tzinfo=timezone.utc)
    return instant.astimezone(timezone.utc)


def load_instant(load_ts: datetime) -> Column:
    """A load's instant as a timestamp literal."""
    return F.timestamp_micros(F.lit((as_utc(load_ts) - _EPOCH) // timedelta(microseconds=1)))


def load_instant_text(load_ts: datetime) -> Column:
    """A load's instant as ISO text in UTC, without a zone suffix."""
    return F.lit(as_utc(load_ts).replace(tzinfo=None).isoformat())


def naive_utc(c: ColumnOrName) -> Column:
    """An instant as a timestamp without a zone, in UTC whatever the session's zone.

    Counted from the epoch. convert_timezone looks two zones up by name in every row, and
    takes the instant through local time, which has one hour twice when clocks go back.
    """
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return zero + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(column(c).cast("timestamp"))


def load_day(c: ColumnOrName) -> Column:
    """Day of a timestamp with a zone, in UTC."""
    return F.to_date(naive_utc(c))


def load_day_plain(c: ColumnOrName) -> Column:
    """Day of a timestamp without a zone, or of a date."""
    return F.to_date(column(c))


def load_day_text(c: ColumnOrName) -> Column:
    """Day of an ISO text: its first ten characters."""
    return F.substring(column(c), 1, 10)
