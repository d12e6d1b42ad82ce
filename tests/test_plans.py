"""The shape of the plans: what reaches the scan, and how often rows are shuffled."""

import re
from datetime import date, timedelta

import pytest
from feed import collection, feature, land
from pyspark.sql import functions as F

from tremor.checks import inputs as i
from tremor.checks import queries
from tremor.operators import analysis as a
from tremor.plans import (
    change_of_places,
    frequency_intensity_of_totals,
    scan_place_totals,
    write_place_totals,
)
from tremor.plans.load import silver_rows
from tremor.sources import scan_geojson


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def shuffles(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan(df), re.M))


def scans(df):
    return len(re.findall(r"^\(\d+\) Scan parquet", plan(df), re.M))


def read_columns(df):
    [schema] = re.findall(r"ReadSchema: struct<(.*)>", plan(df))
    return {field.split(":")[0] for field in schema.split(",")}


# Shuffles of a query, and the columns that its scan reads.
SHAPES = {
    "count_by_area": (1, {"event_type"}),
    "mean_mag_by_area": (1, {"event_type", "value"}),
    "count_by_day": (1, {"ts"}),
    "count_by_day_area": (1, {"ts", "event_type"}),
    "mean_daily_count": (2, {"ts"}),
    "max_mag_by_area": (1, {"event_type", "value"}),
    "top_area": (0, {"event_type", "value"}),
    "strongest_last_week": (0, {"ts", "event_type", "value"}),
    "areas_above": (1, {"event_type", "value"}),
    "frequency": (2, {"user_id", "event_type", "props", "value"}),
    "frequency_intensity": (2, {"user_id", "event_type", "props", "value"}),
    "area_tail": (0, {"event_id", "user_id", "event_type", "props"}),
    "flatten_collections": (0, {"event_id", "ts", "user_id", "event_type", "value", "props"}),
    "completed_orders": (0, {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}),
    "mean_order_value": (1, {"o_orderstatus", "o_totalprice"}),
    "sum_per_user": (1, {"o_custkey", "o_orderstatus", "o_totalprice"}),
    "large_orders": (1, {"o_custkey", "o_orderstatus", "o_totalprice"}),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shuffles_and_columns(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert (shuffles(df), read_columns(df)) == SHAPES[name]
    assert scans(df) == 1


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("last_week", r"GreaterThanOrEqual\(ts,2024-01-15T00:00\), LessThan\(ts,2024-01-22T00:00\)"),
        ("strongest_last_week", r"GreaterThanOrEqual\(ts,2024-01-15T00:00\)"),
        ("areas_above", r"GreaterThan\(value,345.0\)"),
        ("completed_orders", r"EqualTo\(o_orderstatus,F\)"),
        ("sum_per_user", r"EqualTo\(o_orderstatus,F\).*GreaterThan\(o_totalprice,100000.0\)"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert re.search(r"PushedFilters: .*" + pushed, plan(queries()[name](spark, sf_dir)))


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name in ("count_by_area", "mean_mag_by_area", "frequency_intensity", "sum_per_user"):
        text = plan(queries()[name](spark, sf_dir))
        assert "partial_" in text and "HashAggregate" in text


def test_no_python_and_no_unchecked_joins(spark, sf_dir):
    for name, build in queries().items():
        if name.startswith(("load_", "silver_", "table_", "features_", "flatten_roundtrip", "pairs_", "analysis_", "orders_", "split_")):
            continue
        text = plan(build(spark, sf_dir))
        assert not re.search(r"Python|Arrow|Join|Cartesian", text), name


def test_loading_does_not_shuffle(spark, tmp_path):
    landed = scan_geojson(spark, land(tmp_path / "l", collection(feature("a"))))
    for variant in ("typed", "text"):
        assert "Exchange" not in plan(silver_rows(landed, variant=variant))


def test_ties_are_spread_by_the_sort(spark, sf_dir):
    # Sorting by the count alone would send all places with one event to one task.
    for build in (a.frequency, a.intensity, a.frequency_intensity):
        [key] = re.findall(r"rangepartitioning\((.*?), \d+\)", plan(build(i.quakes(spark, sf_dir))))
        assert key.split(",")[-1].strip().startswith("place")


def test_totals_by_place_need_no_shuffle(spark, sf_dir, tmp_path):
    rows = i.quakes(spark, sf_dir)
    try:
        for load_id in ("a", "b"):
            write_place_totals(rows, "by_place", load_id, buckets=4, path=str(tmp_path / "t"))
        both = scan_place_totals(spark, "by_place")
        assert "Exchange" not in plan(both) and "Bucketed: true" in plan(both)
        # Only the sort has an exchange, by ranges.
        assert re.findall(r"Arguments: (\w+partitioning)", plan(frequency_intensity_of_totals(both))) == [
            "rangepartitioning"
        ]
        joined = change_of_places(*(scan_place_totals(spark, "by_place", [x]) for x in ("a", "b")))
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert re.search(r"PartitionFilters: \[.*load_id#\d+ = a", plan(joined))
        expected = a.place_totals(rows).count()
        assert both.count() == expected and joined.count() == expected
        # A task has written one file of each bucket.
        assert len(list((tmp_path / "t" / "load_id=a").glob("*.parquet"))) <= 4
    finally:
        spark.sql("DROP TABLE IF EXISTS by_place")


def test_a_week_reads_its_folders_only(spark, sf_dir):
    text = plan(queries()["last_week_partitioned"](spark, sf_dir))
    [folders] = re.findall(r"PartitionFilters: \[load_id#\d+ INSET (.*?)\]", text)
    days = [date.fromisoformat(f[:10]) + timedelta(int(f[11:])) for f in folders.split(", ")]
    assert set(days) == {date(2024, 1, d) for d in range(15, 22)} and len(days) == 21
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(insert_dt,2024-01-15", text)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Auckland"])
def test_zoned_instants_are_utc_and_pushed_down(spark, sf_dir, in_zone, tmp_path, zone):
    in_zone(zone)
    rows = spark.sql("SELECT timestamp_seconds(1705888800) AS insert_dt, 1.0D AS mag")  # 22nd, 02:00Z
    rows.write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    days = a.with_day(rows, "insert_dt").select(F.col("day").cast("string")).collect()
    assert [r[0] for r in days] == ["2024-01-22"]
    week = a.last_week(rows, "insert_dt", date(2024, 1, 24))
    assert week.count() == 0 and a.last_week(rows, "insert_dt", date(2024, 1, 29)).count() == 1
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(insert_dt,", plan(week))


def test_writes_have_no_python_and_no_join(spark, sf_dir):
    seen = []
    for name in ("load_daily", "silver_append", "flatten_roundtrip", "pairs_text"):
        text = plan(queries()[name](spark, sf_dir))
        assert not re.search(r"Python|Arrow|Join|Cartesian", text), name
        seen.append(name)
    assert seen


def test_many_features_of_one_document_are_spread(spark, tmp_path):
    landed = scan_geojson(spark, land(tmp_path / "l", collection(*(feature(str(i)) for i in range(50)))))
    rows = silver_rows(landed).hint("rebalance")
    assert "REBALANCE" in plan(rows)
