from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tremor.functions import (
    area_comma,
    area_tail,
    epoch_ms_to_str,
    epoch_ms_to_ts,
    load_day,
    load_day_text,
    load_instant,
    load_instant_text,
    naive_utc,
    pair_text,
    plain_number,
)


def values(spark, kind, given, function):
    df = spark.createDataFrame([(v,) for v in given], f"c {kind}")
    return [row[0] for row in df.select(function("c")).collect()]


PLACES = [
    ("10 km SSW of Idyllwild, CA", "Idyllwild, CA", "CA"),
    ("Fiji region", "", ""),
    ("Roof of X", "of X", ""),
    ("5 km N of A, B, C", "A, B, C", "B,  C"),
    ("12 km W of Gulf of Alaska", "Gulf of Alaska", ""),
    ("ends in of ", "", ""),
    ("a,", "", ""),
    (",b", "", "b"),
    (", \t b ,  c \n", "", "b ,   c"),
    ("", "", None),
    (None, None, None),
]


def test_area_rules(spark):
    given = [place for place, _, _ in PLACES]
    assert values(spark, "string", given, area_tail) == [tail for _, tail, _ in PLACES]
    assert values(spark, "string", given, area_comma) == [comma for _, _, comma in PLACES]


def test_area_comma_at_its_edges(spark):
    given = ["x , y ,, z", ",,,", " , ", "no comma", "a,b,c,d"]
    expected = ["y , ,  z", ", ,", "", "", "b, c, d"]
    assert values(spark, "string", given, area_comma) == expected


EPOCHS = [
    ("1730610000123", "2024-11-03 05:00:00"),
    ("1730613600123", "2024-11-03 06:00:00"),
    ("-500", "1969-12-31 23:59:59"),
    ("0", "1970-01-01 00:00:00"),
    ("999", "1970-01-01 00:00:00"),
    ("253402300799999", "9999-12-31 23:59:59"),
    ("253402300800000", None),
    ("9223372036854775807", None),
    ("99999999999999999999999", None),
    ("abc", None),
    ("1.5E12", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epochs_do_not_depend_on_the_session_zone(spark, in_zone, zone):
    in_zone(zone)
    given = [e for e, _ in EPOCHS]
    assert values(spark, "string", given, epoch_ms_to_str) == [text for _, text in EPOCHS]
    seconds = values(spark, "string", given, lambda c: F.unix_seconds(epoch_ms_to_ts(c)))
    expected = [
        None if text is None else int(datetime.fromisoformat(text + "+00:00").timestamp())
        for _, text in EPOCHS
    ]
    assert seconds == expected


def test_epochs_of_whole_numbers(spark):
    assert values(spark, "bigint", [1730610000123], epoch_ms_to_str) == ["2024-11-03 05:00:00"]


def test_load_instants_are_utc(spark, in_zone):
    in_zone("America/New_York")
    naive = datetime(2024, 1, 30, 12, 0, 0, 5)
    aware = datetime(2024, 1, 30, 14, 0, 0, 5, tzinfo=timezone(timedelta(hours=2)))
    row = spark.range(1).select(
        *[F.unix_micros(load_instant(t)) for t in (naive, aware)],
        *[load_instant_text(t) for t in (naive, aware)],
    ).first()
    assert list(row) == [1706616000000005] * 2 + ["2024-01-30T12:00:00.000005"] * 2


def test_load_days(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-30 23:59:59' AS t, '2024-01-30T23:59:59.5' AS s")
    assert [str(v) for v in df.select(load_day("t"), load_day_text("s")).first()] == ["2024-01-30"] * 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Auckland", "Asia/Kathmandu"])
def test_instants_in_utc_do_not_pass_local_time(spark, in_zone, zone):
    in_zone(zone)
    # In New York the third is the second 01:30 of its night; the next two are before the epoch and the last day.
    texts = ["2024-01-30 12:34:56.789012", "2024-11-03 05:30:00", "2024-11-03 06:30:00.000001"]
    texts += ["1969-12-31 23:59:59.999999", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    df = df.select("s", F.expr("CAST(s || 'Z' AS TIMESTAMP)").alias("t"))
    rows = df.select(naive_utc("t").cast("string").alias("n"), load_day("t").cast("string").alias("day")).collect()
    assert [r.n for r in rows] == texts
    assert [r.day for r in rows] == [t and t[:10] for t in texts]


def test_instants_in_utc_look_up_no_zone(spark):
    """A zone given by name is looked up in every row, by two regular expressions."""
    df = spark.range(1).select(F.timestamp_micros("id").alias("t"))
    plan = df.select(naive_utc("t"), load_day("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "convert_timezone" not in plan


def test_plain_numbers(spark):
    given = [12345678.5, 100.0, 0.1 + 0.2, 0.00012, 123456789012345.6, -98765432.1, 1e7, 5.0, None]
    expected = [None if v is None else repr(v) for v in given]
    assert values(spark, "double", given, plain_number) == expected


def test_pairs(spark):
    df = spark.createDataFrame([(1, "u", 12345678.5), (None, None, None)], "k bigint, s string, v double")
    assert [r[0] for r in df.select(pair_text("k", "v")).collect()] == ["(1, 12345678.5)", "(None, None)"]
    assert [r[0] for r in df.select(pair_text("s", "v", True)).collect()] == ["('u', 12345678.5)", "(None, None)"]
