import os

import pytest
from pyspark.sql import functions as F

from tremor.operators import orders as o
from tremor.operators.analysis import above
from tremor.plans import analyses_for_now, order_report, order_report_for_now
from tremor.sinks import shared_folder, stored, write_pairs_text, write_tagged_pairs

SCHEMA = "user_id bigint, order_id bigint, order_value double, order_status string"


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        (1, 1, 300.0, "COMPLETED"),
        (1, 2, 200.0, "COMPLETED"),
        (2, 3, 300.0, "COMPLETED"),
        (2, 4, 200.5, "COMPLETED"),
        (2, 5, 100.0, "COMPLETED"),
        (3, 6, 12345678.5, "COMPLETED"),
        (4, 7, 900.0, "OPEN"),
        (5, 8, None, "COMPLETED"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def lines(path):
    return sorted(
        line for part in path.glob("*.txt") for line in part.read_text().splitlines()
    )


def test_report(orders, tmp_path):
    report = order_report(orders, str(tmp_path))
    assert report.mean_value.first()[0] == pytest.approx((500 + 500.5 + 12345678.5) / 5)
    assert sorted(map(tuple, report.large_orders.collect())) == [(2, 500.5), (3, 12345678.5)]
    assert sorted(map(tuple, report.small_orders.collect())) == [(1, 500.0)]
    assert lines(tmp_path / "large_orders") == ["(2, 500.5)", "(3, 12345678.5)"]
    assert lines(tmp_path / "small_orders") == ["(1, 500.0)"]


def test_both_sides_are_written_in_one_pass(spark, orders, tmp_path):
    read = []

    def share(totals):
        read.append(stored(totals, path=str(tmp_path / f"totals-{len(read)}")))
        return read[-1].withColumn("total", counted("total"))

    rows = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(total):
        rows.add(1)
        return total

    for _ in range(2):  # the second report replaces the first
        order_report(orders, str(tmp_path / "out"), share=share)
    assert rows.value == 2 * 3
    assert sorted(os.listdir(tmp_path / "out")) == ["large_orders", "small_orders"]
    assert lines(tmp_path / "out" / "large_orders") == ["(2, 500.5)", "(3, 12345678.5)"]
    assert lines(tmp_path / "out" / "small_orders") == ["(1, 500.0)"]


def test_tags_without_rows_and_null_totals(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "user_id string, total double")
    tagged = o.tag_by_threshold(df, "total", 500, "large", "small")
    for rows, small in ((tagged, ["('a', None)", "('b', 1.0)"]), (tagged.limit(0), [])):
        write_tagged_pairs(rows, str(tmp_path / "t"), "side", ("large", "small"), "user_id", "total")
        assert lines(tmp_path / "t" / "small") == small and lines(tmp_path / "t" / "large") == []
        assert sorted(os.listdir(tmp_path / "t")) == ["large", "small"]


def test_report_without_orders(orders):
    report = order_report(orders.where("order_status = 'NONE'"))
    assert report.mean_value.first()[0] is None
    assert report.large_orders.count() == report.small_orders.count() == 0


def test_operators(orders):
    valued = above(orders, "order_value", 100)
    assert valued.count() == 6
    assert o.mean_order_value(valued).first()[0] == pytest.approx(
        o.mean_from_totals(o.user_totals(valued)).first()[0]
    )
    assert {r[0]: r[1] for r in o.sum_per_user(valued).collect()} == {1: 500.0, 2: 500.5, 3: 12345678.5, 4: 900.0}


def test_split_loses_nothing(spark):
    df = spark.createDataFrame([(1, 500.0), (2, 500.1), (3, None), (4, -1.0)], "user_id bigint, total double")
    large, small = o.split_by_threshold(df, "total", 500)
    assert [r[0] for r in large.collect()] == [2]
    assert sorted(r[0] for r in small.collect()) == [1, 3, 4]


def test_textual_users_are_quoted(spark, tmp_path):
    df = spark.createDataFrame([("u1", 1.0)], "user_id string, total double")
    write_pairs_text(df, str(tmp_path / "t"), "user_id", "total")
    assert lines(tmp_path / "t") == ["('u1', 1.0)"]


def test_nothing_stays_of_what_was_for_now(spark, orders):
    folder = shared_folder(spark).removeprefix("file:")

    def kept():
        return {n for n in os.listdir(f"{folder}/tremor") if n.startswith(("analyses-", "user-"))}

    os.makedirs(f"{folder}/tremor", exist_ok=True)
    before = kept()
    with order_report_for_now(orders) as report:
        assert report.mean_value.count() == 1 and len(kept()) == len(before) + 1
    events = spark.sql("SELECT 'a' AS area, 'p' AS place, 1.0D AS mag, TIMESTAMP_NTZ '2024-01-05' AS insert_dt")
    with analyses_for_now(events, "2024-01-10") as answers:
        assert answers["top_area"].count() == 1
    assert kept() == before


def test_a_cluster_names_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: "file:/tmp/x")
    with pytest.raises(RuntimeError):
        shared_folder(spark)
