"""Loads as one commit: killed at every step, finished or undone by the next."""

import importlib
import os
from datetime import date, datetime

import pytest
from feed import collection, feature, land

from tremor.plans import analyses_of_loads, load, recover, scan_loads
from tremor.sinks import ConcurrentLoadError, Journal, Record, zones
from tremor.sources import NoFeaturesError, landing_path

steps = importlib.import_module("tremor.plans.load")
DAY, NEXT = date(2024, 1, 5), date(2024, 1, 6)


class Killed(BaseException):
    pass


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.table = "loads_" + root.name.replace("-", "_")

    def path(self, name):
        return f"{self.root}/{name}"

    def land(self, feed, day, *documents, **options):
        return land(landing_path(self.path("landing"), feed, day), *documents, **options)

    def load(self, feed, day=DAY, **options):
        return load(
            self.spark, feed, day, landing=self.path("landing"), silver=self.path("silver"),
            table=self.table, table_path=self.path("table"), journal=self.path("journal"),
            aggregates=self.path("shares"), **options,
        )

    def ids(self):
        """Feature ids that count in silver, in the table and, by their number, in the shares."""
        silver = scan_loads(self.spark, self.path("journal"), silver=self.path("silver"))
        table = scan_loads(self.spark, self.path("journal"), table=self.table)
        answers = analyses_of_loads(self.spark, self.path("journal"), self.table, self.path("shares"))
        found = [sorted(r[0] for r in rows.select("id").collect()) for rows in (silver, table)]
        return (*found, sum(r.n for r in answers["count_by_day"].collect()))

    def folders(self):
        """Load ids of which there are files, by layer."""
        found = {}
        for layer in ("silver", "table", "shares"):
            found[layer] = {
                name
                for folder, names, files in os.walk(self.path(layer))
                for name in names
                if name.startswith("load_id=") and any(f.endswith(".parquet") for f in os.listdir(f"{folder}/{name}"))
            }
        return found


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, tmp_path)
    for feed in ("daily", "historical"):
        made.land(feed, DAY, collection(feature(feed[0] + "1", mag=1.0), feature(feed[0] + "2", mag=2.0)))
    made.land("daily", NEXT, collection(feature("n", mag=3.0)))
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")


D, H = ["d1", "d2"], ["h1", "h2"]


def test_modes_change_all_layers_together(lake):
    assert lake.ids() == ([], [], 0)
    lake.load("daily")
    lake.load("daily")
    assert lake.ids() == (sorted(D + D), sorted(D + D), 4)
    lake.load("historical")
    assert lake.ids() == (sorted(D + D + H), H, 2)
    lake.load("daily", NEXT)
    lake.load("daily", NEXT, mode="replace_partition")
    assert lake.ids() == (sorted(D + D + H + ["n"]), sorted([*H, "n"]), 3)
    # What was replaced is gone, and no load is open.
    sizes = {layer: len(found) for layer, found in lake.folders().items()}
    assert sizes == {"silver": 4, "table": 2, "shares": 2}
    assert Journal(lake.spark, lake.path("journal")).begun() == []


STEPS = ["begin", "write_silver", "write_table", "write_partials", "commit", "finish"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_killed_at_each_step(lake, monkeypatch, step, after):
    lake.load("daily")
    before = lake.ids()
    owner = steps.Journal if step in ("begin", "commit") else steps
    whole = getattr(owner, step)

    def killed(*args, **options):
        if after:
            whole(*args, **options)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, killed)
        with pytest.raises(Killed):
            lake.load("daily", mode="replace_partition")
    committed = step == "finish" or (step, after) == ("commit", True)
    # Readers see the old rows or the new ones, in all layers; both are d1 and d2 once.
    assert lake.ids() == before == (D, D, 2)
    journal = Journal(lake.spark, lake.path("journal"))
    assert len(journal.committed()) == 1 + committed
    recover(lake.spark, journal)
    [counts] = journal.silver_loads()
    assert lake.ids() == before and journal.begun() == []
    assert all(found == {f"load_id={counts}"} for found in lake.folders().values())
    # The next load needs no help.
    lake.load("daily", NEXT)
    assert lake.ids() == ([*D, "n"], [*D, "n"], 3)


def test_killed_while_it_removes(lake, monkeypatch):
    lake.load("daily")
    lake.load("daily")
    with monkeypatch.context() as patch:
        patch.setattr(steps, "_drop_load", lambda *args: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            lake.load("historical")
    assert lake.ids() == (sorted(D + D + H), H, 2)
    lake.load("daily", NEXT)
    assert lake.ids() == (sorted([*D, *D, *H, "n"]), [*H, "n"], 3)
    assert {k: len(v) for k, v in lake.folders().items()} == {"silver": 4, "table": 2, "shares": 2}


def test_unreadable_documents_undo_the_load(lake):
    lake.load("daily")
    lake.land("daily", DAY, "no document", name="more.json")
    with pytest.raises(NoFeaturesError):
        lake.load("daily", mode="replace_partition")
    assert lake.ids() == (D, D, 2) and Journal(lake.spark, lake.path("journal")).begun() == []
    assert lake.load("daily", mode="replace_partition", keep_good=True).unreadable == 1
    assert lake.ids() == (D, D, 2)


def test_a_version_is_committed_once(lake, monkeypatch):
    journal = Journal(lake.spark, lake.path("journal"))
    first = Record("a", "daily", "2024-01-05", "append", "s")
    journal.commit(first)
    monkeypatch.setattr(journal, "committed", list)  # as if it had read before the other one's commit
    with pytest.raises(ConcurrentLoadError):
        journal.commit(Record("b", "daily", "2024-01-05", "append", "s"))


def test_zones_and_quiet_days(lake):
    lake.land("daily", NEXT, collection())
    lake.load("daily", NEXT, load_ts=datetime(2024, 3, 9, 23, 59))
    assert lake.ids() == ([], [], 0)
    loads = Journal(lake.spark, lake.path("journal")).table_loads(lake.table)
    [zone] = zones(lake.spark, loads).collect()
    assert zone.first == zone.last == date(2024, 3, 9)


def test_wrong_arguments(lake):
    with pytest.raises(ValueError):
        scan_loads(lake.spark, lake.path("journal"))
    with pytest.raises(ValueError):
        lake.load("daily", table_format="echo")
