from datetime import date, datetime

import pytest
from feed import collection, feature, land

from tremor.plans import load
from tremor.plans.load import loaded_rows, split_landing
from tremor.sinks import write_table
from tremor.sources import NoFeaturesError, landing_path, scan_silver, scan_table

DAY, NEXT = date(2024, 1, 5), date(2024, 1, 6)


class Lake:
    def __init__(self, spark, root):
        self.spark, self.landing, self.silver = spark, f"{root}/landing", f"{root}/silver"
        self.table = "quakes_" + root.name.replace("-", "_")

    def land(self, feed, day, *documents, **options):
        return land(landing_path(self.landing, feed, day), *documents, **options)

    def load(self, feed, day=DAY, **options):
        return load(
            self.spark, feed, day, landing=self.landing, silver=self.silver, table=self.table, **options
        )

    def ids(self, **options):
        """Feature ids by feed in silver and in the table."""
        found = []
        for df in (scan_silver(self.spark, self.silver, **options), scan_table(self.spark, self.table)):
            rows = [tuple(r) for r in df.select("feed", "load_date", "id").collect()]
            found.append(sorted((feed, str(day), fid) for feed, day, fid in rows))
        return found


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, tmp_path)
    for feed in ("daily", "historical"):
        made.land(feed, DAY, collection(feature(feed[0] + "1"), feature(feed[0] + "2")))
    made.land("daily", NEXT, collection(feature("d3")))
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")


D, H = [("daily", "2024-01-05", f"d{n}") for n in (1, 2)], [("historical", "2024-01-05", f"h{n}") for n in (1, 2)]
D_NEXT = [("daily", "2024-01-06", "d3")]


def test_daily_appends_and_history_replaces(lake):
    lake.load("daily")
    assert lake.ids() == [D, D]
    lake.load("daily")
    assert lake.ids() == [sorted(D + D)] * 2
    lake.load("historical")
    # History replaces the whole table, yet no daily rows in silver.
    assert lake.ids() == [sorted(D + D + H), H]
    lake.load("historical")
    lake.load("daily", NEXT)
    assert lake.ids() == [sorted(D + D + H + D_NEXT), sorted(H + D_NEXT)]


def test_replacing_a_partition_is_repeatable(lake):
    lake.load("historical")
    lake.load("daily")
    lake.load("daily")
    lake.load("daily", NEXT)
    for _ in range(2):
        lake.load("daily", mode="replace_partition")
        assert lake.ids() == [sorted(D + H + D_NEXT)] * 2


def test_equal_instants_do_not_mix_loads(lake):
    at = datetime(2024, 1, 5, 12)
    for _ in range(2):
        lake.load("daily", load_ts=at)
    assert lake.ids() == [sorted(D + D)] * 2


def test_both_layers_carry_one_instant(lake):
    done = lake.load("daily")
    silver = {r[0] for r in loaded_rows(lake.spark, done).select("insert_dt").collect()}
    table = {r[0] for r in scan_table(lake.spark, lake.table).select("insert_dt").collect()}
    assert len(silver) == 1 and silver == table


@pytest.mark.parametrize("mode", ["overwrite", "append", "replace_partition"])
def test_pretty_printed_landing_touches_nothing(lake, mode):
    lake.load("daily", NEXT)
    lake.land("daily", NEXT, collection(feature("x")), indent=2)
    with pytest.raises(NoFeaturesError):
        lake.load("daily", NEXT, mode=mode)
    assert lake.ids() == [D_NEXT] * 2
    lake.load("daily", NEXT, mode="replace_partition", multi_line=True)
    assert lake.ids() == [[("daily", "2024-01-06", "x")]] * 2


def test_feature_lines_dated_folders_and_rebalance(spark, tmp_path, lake):
    land(landing_path(lake.landing, "historical", DAY, "dated"), feature("f1"), feature("f2"))
    lake.load("historical", layout="features", style="dated", rebalance=True)
    assert [fid for _, _, fid in lake.ids()[0]] == ["f1", "f2"]


def rejected(lake, done=None):
    rows = lake.spark.read.parquet(f"{lake.silver}-rejects").collect()
    return sorted((r.feed, str(r.load_date), r.text) for r in rows if done is None or r.load_id == done.load_id)


def test_unreadable_documents_are_kept_and_touch_nothing(lake):
    done = lake.load("daily")
    assert (done.documents, done.unreadable) == (1, 0)
    lake.land("daily", DAY, "no document", collection(), name="more.json")
    for mode in ("append", "overwrite", "replace_partition"):
        with pytest.raises(NoFeaturesError, match="1 of 3"):
            lake.load("daily", mode=mode)
        assert lake.ids() == [D, D]
    done = lake.load("daily", keep_good=True)
    assert (done.documents, done.unreadable) == (3, 1)
    assert lake.ids() == [sorted(D + D)] * 2
    assert rejected(lake, done) == [("daily", "2024-01-05", '"no document"')]


def test_a_compact_and_a_pretty_printed_file(lake):
    lake.land("daily", DAY, collection(feature("x")), name="pretty.json", indent=2)
    with pytest.raises(NoFeaturesError):
        lake.load("daily")
    done = lake.load("daily", keep_good=True)
    assert done.documents == done.unreadable + 1
    assert "".join(t for _, _, t in rejected(lake, done)).count('"x"') == 1
    assert lake.ids() == [D, D]


def test_unreadable_feature_lines_are_no_rows_of_nulls(lake):
    lake.land("daily", NEXT, feature("x"), name="part.json", indent=2)
    with pytest.raises(NoFeaturesError):
        lake.load("daily", NEXT, layout="features")
    lake.land("daily", NEXT, feature("x"), {"type": "Feature"}, "bad", name="part.json")
    done = lake.load("daily", NEXT, layout="features", keep_good=True)
    assert (done.documents, done.unreadable) == (3, 2)
    assert lake.ids() == [[("daily", "2024-01-06", "x")]] * 2


def test_a_day_landed_empty_replaces_what_was_loaded(lake):
    lake.load("daily", NEXT)
    lake.load("daily")
    lake.land("daily", DAY, collection())
    lake.load("daily", mode="replace_partition")
    assert lake.ids() == [D_NEXT] * 2


def test_one_day_can_be_scanned_alone(lake):
    done = lake.load("daily")
    rows = scan_silver(lake.spark, done.day).select("feed", "load_date").distinct().collect()
    assert [(r.feed, str(r.load_date)) for r in rows] == [("daily", "2024-01-05")]


def test_collections_as_feature_lines(lake):
    split_landing(
        lake.spark,
        landing_path(lake.landing, "daily", DAY),
        landing_path(lake.landing, "daily", NEXT),
    )
    lake.load("daily", NEXT, layout="features")
    assert [fid for _, _, fid in lake.ids()[0]] == ["d1", "d2"]


def test_tables_are_replaced_as_they_are(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    name, where = f"t_{tmp_path.name.replace('-', '_')}", str(tmp_path / "place")
    write_table(rows, name, "overwrite", path=where)
    with pytest.raises(ValueError):
        write_table(rows, name, "replace_partition", partition={"k": "a"})
    write_table(rows.limit(1), name, "overwrite")
    assert scan_table(spark, name).count() == spark.read.parquet(where).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_text_variant(lake):
    done = lake.load("daily", variant="text", load_ts=datetime(2024, 1, 5, 12))
    rows = loaded_rows(lake.spark, done, "text")
    assert len(rows.columns) == 31
    assert [r[0] for r in rows.select("insert_date").distinct().collect()] == ["2024-01-05T12:00:00"]
    assert scan_table(lake.spark, lake.table).columns == [*rows.columns, "feed", "load_date"]


def test_quiet_day(lake):
    lake.land("daily", NEXT, collection())
    lake.load("daily", NEXT)
    assert lake.ids() == [[], []]


@pytest.mark.parametrize("wrong", [{"mode": "merge"}, {"layout": "rows"}, {"variant": "wide"}])
def test_wrong_arguments(lake, wrong):
    with pytest.raises(ValueError):
        lake.load("daily", **wrong)
