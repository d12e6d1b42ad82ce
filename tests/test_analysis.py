import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tremor.operators import analysis as a
from tremor.plans import analyses

AS_OF = date(2024, 1, 24)


@pytest.fixture(scope="module")
def quakes(spark):
    rows = [
        ("A", "p1", 4.0, datetime(2024, 1, 14, 23, 59, 59)),
        ("A", "p1", None, datetime(2024, 1, 15)),
        ("A", "p2", 6.5, datetime(2024, 1, 15)),
        ("B", "p3", 6.5, datetime(2024, 1, 21, 23, 59, 59)),
        ("B", None, 9.0, datetime(2024, 1, 22)),
        (None, "p3", 5.0, datetime(2024, 1, 22)),
        ("C", "p4", None, datetime(2024, 1, 22)),
    ]
    return spark.createDataFrame(
        rows, "area string, place string, mag double, insert_dt timestamp_ntz"
    ).cache()


@pytest.fixture(scope="module")
def many(spark):
    """A third of the rows share one area, place and day."""
    pick = random.Random(7)
    rows = []
    for _ in range(900):
        hot = pick.random() < 1 / 3
        rows.append(
            (
                "hot" if hot else pick.choice(["a", "b", "c", None]),
                "hot" if hot else pick.choice([f"p{n}" for n in range(40)] + [None]),
                None if pick.random() < 0.1 else round(pick.uniform(0, 9), 1),
                datetime(2024, 1, 17 if hot else pick.randint(1, 31), pick.randint(0, 23)),
            )
        )
    return spark.createDataFrame(
        rows, "area string, place string, mag double, insert_dt timestamp_ntz"
    ).cache()


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_counts_and_means(quakes):
    assert as_dict(a.count_by(quakes, "area")) == {"A": 3, "B": 2, None: 1, "C": 1}
    assert as_dict(a.mean_by(quakes, "area", "mag")) == {"A": 5.25, "B": 7.75, None: 5.0, "C": None}
    assert as_dict(a.max_by_area(quakes)) == {"A": 6.5, "B": 9.0, None: 5.0, "C": None}
    assert as_dict(a.count_by(quakes, "insert_dt"))[datetime(2024, 1, 22)] == 3
    days = as_dict(a.count_by(a.with_day(quakes, "insert_dt"), "day"))
    assert {str(day): n for day, n in days.items()} == {
        "2024-01-14": 1, "2024-01-15": 2, "2024-01-21": 1, "2024-01-22": 3,
    }


def test_mean_group_sizes(quakes):
    by_day = a.with_day(quakes, "insert_dt")
    assert a.mean_group_size(by_day, "day").first()[0] == 7 / 4
    assert a.mean_group_size(by_day, "day", "area").first()[0] == 7 / 6
    assert sorted(r[1] for r in a.mean_count_per_key(by_day, "day").collect()) == [1.0, 1.0, 2.0, 3.0]
    assert {r[2] for r in a.mean_of_ones(by_day, "day", "area").collect()} == {1.0}


def test_counts_add_up(many):
    for keys in (["area"], ["place"], ["area", "insert_dt"]):
        assert a.count_by(many, *keys).agg(F.sum("n")).first()[0] == many.count()


def test_last_week_is_monday_to_sunday(quakes):
    week = a.last_week(quakes, "insert_dt", AS_OF)
    assert week.count() == 3
    for as_of in (date(2024, 1, 22), "2024-01-28", F.to_date(F.lit("2024-01-25"))):
        assert sorted(a.last_week(quakes, "insert_dt", as_of).collect(), key=str) == sorted(week.collect(), key=str)
    compat = a.last_week(quakes, "insert_dt", AS_OF, compat=True)
    assert sorted(compat.collect(), key=str) == sorted(week.collect(), key=str)


def test_last_week_of_text_and_zoned_columns(quakes):
    text = F.date_format("insert_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    for column in (text, F.col("insert_dt").cast("timestamp"), F.to_date("insert_dt")):
        df = quakes.withColumn("loaded", column)
        assert a.last_week(df, "loaded", AS_OF).count() == 3
        assert a.last_week(df, "loaded", AS_OF, compat=True).count() == 3


def test_turn_of_the_year(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-12-30 12:00:00' AS t")
    assert a.last_week(df, "t", date(2025, 1, 8)).count() == 1
    assert a.last_week(df, "t", date(2025, 1, 8), compat=True).count() == 0


def test_last_week_defaults_to_today(spark):
    df = spark.sql("SELECT explode(sequence(current_date() - 20, current_date())) AS t")
    assert a.last_week(df, "t").count() == 7


def test_strongest(quakes):
    assert tuple(a.strongest_last_week(quakes, AS_OF).first()) == ("A", 6.5)
    assert a.strongest_last_week(quakes, date(2025, 6, 1)).collect() == []
    assert tuple(a.top_area(quakes).first()) == ("B", 9.0)
    assert a.top_area(quakes.limit(0)).collect() == []


def test_top_area_is_the_largest_of_the_maxima(many):
    best = sorted(a.max_by_area(many).where("max_mag IS NOT NULL").collect(), key=lambda r: (-r[1], r[0] or ""))
    assert tuple(a.top_area(many).first()) == tuple(best[0])


def test_areas_above(quakes):
    assert {r[0] for r in a.areas_above(quakes).collect()} == {"A", "B"}
    assert {r[0] for r in a.areas_above(quakes, 4.9).collect()} == {"A", "B", None}


def test_frequency_and_intensity(quakes):
    assert [tuple(r) for r in a.frequency(quakes).collect()] == [
        ("p3", 2), (None, 1), ("p1", 1), ("p2", 1), ("p4", 0),
    ]
    assert [tuple(r) for r in a.intensity(quakes).collect()] == [
        ("p3", 11.5), (None, 9.0), ("p2", 6.5), ("p1", 4.0), ("p4", None),
    ]
    assert [tuple(r) for r in a.frequency_intensity(quakes).collect()] == [
        ("p3", 2, 11.5), ("p2", 1, 6.5), ("p1", 1, 4.0), ("p4", 0, None),
    ]


def test_one_grouping_equals_the_join(many):
    joined = a.frequency(many).join(a.intensity(many), on="place")
    ours = a.frequency_intensity(many)
    assert ours.columns == joined.columns
    assert sorted((p, n, round(s, 6)) for p, n, s in ours.collect()) == sorted(
        (p, n, round(s, 6)) for p, n, s in joined.collect()
    )


def rounded(df):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in df.collect()), key=str
    )


@pytest.mark.parametrize("share", [None, lambda df: df])
@pytest.mark.parametrize("text", [False, True])
def test_suite_equals_the_single_analyses(many, share, text):
    df, mag, loaded = many, "mag", "insert_dt"
    if text:
        mag, loaded = "magnitude", "insert_date"
        iso = F.date_format("insert_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        df = df.select("area", "place", F.col("mag").alias(mag), iso.alias(loaded))
    options = {"share": share} if share else {}
    got = analyses(df, AS_OF, mag=mag, loaded=loaded, **options)
    by_day = a.with_day(df, loaded)
    expected = {
        "count_by_area": a.count_by(df, "area"),
        "mean_mag_by_area": a.mean_by(df, "area", mag, "avg_mag"),
        "count_by_day": a.count_by(by_day, "day"),
        "count_by_day_area": a.count_by(by_day, "day", "area"),
        "mean_daily_count": a.mean_group_size(by_day, "day"),
        "mean_daily_count_per_day": a.mean_count_per_key(by_day, "day"),
        "mean_daily_area_count": a.mean_group_size(by_day, "day", "area"),
        "mean_of_ones_day_area": a.mean_of_ones(by_day, "day", "area"),
        "max_mag_by_area": a.max_by_area(df, mag=mag),
        "top_area": a.top_area(df, mag=mag),
        "strongest_last_week": a.strongest_last_week(df, AS_OF, ts_col=loaded, mag=mag),
        "areas_above": a.areas_above(df, mag=mag),
        "frequency": a.frequency(df, val=mag),
        "intensity": a.intensity(df, val=mag),
        "frequency_intensity": a.frequency_intensity(df, val=mag),
    }
    assert got.keys() == expected.keys()
    for name, frame in expected.items():
        assert rounded(got[name]) == rounded(frame), name
