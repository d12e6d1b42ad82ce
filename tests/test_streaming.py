import os
import re
from datetime import date, datetime

import pytest
from feed import collection, feature, land

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter

from tremor.plans import load
from tremor.sinks import move_folders
from tremor.sources import landing_path, scan_silver
from tremor.streaming import incremental, load_incremental

DAY, NEXT = date(2024, 1, 5), date(2024, 1, 6)


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing, self.silver, self.checkpoint = (f"{root}/{n}" for n in ("landing", "silver", "check"))

    def land(self, feed, day, *features, name="a.json", whole=True):
        documents = [collection(*features)] if whole else features
        land(landing_path(self.landing, feed, day), *documents, name=name)

    def run(self, **options):
        query = load_incremental(self.spark, self.landing, self.silver, self.checkpoint, **options)
        query.awaitTermination()

    def ids(self, variant="typed"):
        rows = scan_silver(self.spark, self.silver, variant).collect()
        return sorted((r["feed"], str(r["load_date"]), r["id"]) for r in rows)


@pytest.fixture
def stream(spark, tmp_path):
    made = Stream(spark, tmp_path)
    made.land("daily", DAY, feature("d1"), feature("d2"))
    made.land("historical", DAY, feature("h1"))
    return made


FIRST = [("daily", "2024-01-05", "d1"), ("daily", "2024-01-05", "d2"), ("historical", "2024-01-05", "h1")]


def test_each_file_is_loaded_once(stream):
    stream.run()
    assert stream.ids() == FIRST
    stream.run()
    assert stream.ids() == FIRST
    stream.land("daily", NEXT, feature("d3"))
    stream.land("daily", DAY, feature("d4"), name="b.json")
    stream.run(max_files_per_trigger=1)
    assert stream.ids() == sorted(FIRST + [("daily", "2024-01-06", "d3"), ("daily", "2024-01-05", "d4")])


def test_a_repeated_batch_replaces_itself(stream):
    stream.run()
    # As after a crash between the write of the batch and its commit.
    os.remove(f"{stream.checkpoint}/commits/0")
    os.remove(f"{stream.checkpoint}/commits/.0.crc")
    stream.run()
    assert stream.ids() == FIRST


def test_stream_and_batch_share_a_silver_folder(spark, stream):
    load(spark, "historical", DAY, landing=stream.landing, silver=stream.silver)
    stream.run()
    assert stream.ids() == sorted(FIRST + [("historical", "2024-01-05", "h1")])


def test_feature_lines_and_text_variant(spark, tmp_path):
    made = Stream(spark, tmp_path)
    made.land("daily", DAY, feature("d1", mag=1.5), feature("d2"), whole=False)
    made.run(layout="features", variant="text")
    rows = scan_silver(spark, made.silver, "text").collect()
    assert sorted((r["feed"], r["magnitude"] or 0.0) for r in rows) == [("daily", 0.0), ("daily", 1.5)]


def test_unreadable_documents_stay_until_they_are_dealt_with(spark, stream):
    stream.land("daily", NEXT, "bad", feature("d3"), name="c.json", whole=False)
    with pytest.raises(StreamingQueryException):
        stream.run(layout="features")
    with pytest.raises(StreamingQueryException):
        stream.run(layout="features")
    stream.run(layout="features", keep_good=True)
    assert stream.ids() == [("daily", "2024-01-06", "d3")]
    rejects = spark.read.parquet(f"{stream.silver}-rejects").collect()
    # The collections of the other files are no features.
    assert len(rejects) == 3 and sum(r.text == '"bad"' for r in rejects) == 1


def test_table_and_load_instant(spark, stream):
    name = "stream_" + stream.root.name.replace("-", "_")
    at = datetime(2024, 1, 5, 12)
    stream.run(table=name, load_ts=at)
    os.remove(f"{stream.checkpoint}/commits/0")
    os.remove(f"{stream.checkpoint}/commits/.0.crc")
    stream.run(table=name, load_ts=at)
    rows = spark.table(name).collect()
    assert sorted((r["feed"], str(r["load_date"]), r["id"]) for r in rows) == FIRST
    assert {r["insert_dt"] for r in rows} == {at}
    spark.sql(f"DROP TABLE {name}")


def progress(stream, **options):
    query = load_incremental(stream.spark, stream.landing, stream.silver, stream.checkpoint, **options)
    query.awaitTermination()
    return query.recentProgress


def test_a_batch_reads_its_files_once(stream):
    """The source counts a line each time it is read; silver and table need one reading."""
    name = "once_" + stream.root.name.replace("-", "_")
    [report] = progress(stream, table=name)
    assert report["numInputRows"] == 2
    assert report["observedMetrics"]["landed"].asDict() == {"documents": 2, "readable": 2}
    assert stream.spark.table(name).count() == 3
    stream.spark.sql(f"DROP TABLE {name}")
    assert os.listdir(f"{stream.silver}/_open") == []


def test_a_failed_batch_leaves_silver_alone(spark, stream):
    stream.run()
    stream.land("daily", NEXT, "bad", feature("d3"), name="c.json", whole=False)
    with pytest.raises(StreamingQueryException):
        stream.run()
    assert stream.ids() == FIRST and os.listdir(f"{stream.silver}/_open") == []
    # What a run that was killed while it wrote has left behind is not read, and goes.
    os.makedirs(f"{stream.silver}/_open/other/feed=daily/load_date=2024-01-06/load_id=x")
    assert stream.ids() == FIRST


def test_folders_move_into_place(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b", None), (2, "a=b", "x/y")], "n int, k string, m string")
    rows.write.partitionBy("k", "m").parquet(str(tmp_path / "new"))
    rows.limit(0).write.parquet(str(tmp_path / "none"))
    assert move_folders(spark, str(tmp_path / "none"), str(tmp_path / "t"), 2) == []
    for _ in range(2):
        rows.write.mode("overwrite").partitionBy("k", "m").parquet(str(tmp_path / "new"))
        assert len(move_folders(spark, str(tmp_path / "new"), str(tmp_path / "t"), 2)) == 2
    found = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted((r.n, r.k, r.m) for r in found) == [(1, "a b", None), (2, "a=b", "x/y")]


def test_wrong_layout(stream):
    with pytest.raises(ValueError):
        stream.run(layout="rows")


@pytest.mark.parametrize("folders", [8, 1])
def test_a_batch_is_not_sorted_by_folder(spark, stream, monkeypatch, folders):
    """Rows go to files that are open at once; those of further folders are sorted. The table's are constant."""
    name, key = f"unsorted_{folders}", "spark.sql.maxConcurrentOutputFileWriters"
    at_once, filled, parquet, fill = [], [], DataFrameWriter.parquet, incremental.write_table

    def write(writer, path, *args, **kwargs):
        at_once.append((writer._spark.conf.get(key), "/_open/" in path))
        return parquet(writer, path, *args, **kwargs)

    def write_table(rows, *args, **kwargs):
        folder = rows.select("feed", "load_date", "load_id")
        filled.append(folder._jdf.queryExecution().optimizedPlan().toString().split("\n")[0])
        return fill(rows, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    monkeypatch.setattr(incremental, "write_table", write_table)
    monkeypatch.setattr(incremental, "OPEN_FOLDERS", folders)
    # One file for several folders: a task of the batch has rows of all of them, in turn.
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stream.land("daily", NEXT, feature("d3"))
        stream.run(table=name)
        assert at_once == [(str(folders), True)]
        feeds = [re.search(r"\[(\w+) AS feed#\d+, [\d-]+ AS load_date#\d+, stream-", text)[1] for text in filled]
        assert feeds == ["daily", "daily", "historical"]
        assert stream.ids() == sorted(FIRST + [("daily", "2024-01-06", "d3")])
        rows = spark.table(name).select("feed", "load_date", "id").collect()
        assert sorted((r.feed, str(r.load_date), r.id) for r in rows) == stream.ids()
        assert spark.conf.get(key) == "0"
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
