"""What loads of many documents spend: one parse of each, no shuffle where many tasks read them."""

import glob
import os
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from feed import collection, feature, land

from tremor.checks import registry
from tremor.checks.registry import _land
from tremor.plans import load
from tremor.plans.load import spread_by_default
from tremor.sinks import shared_folder, write_landing
from tremor.sources import landing_path, parse_landed, scan_landed

DAY = date(2024, 1, 5)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("layout", ["collections", "features"])
def test_a_document_is_parsed_once(spark, layout):
    texts = spark.createDataFrame([('{"a": 1}',)], "value string").repartition(2)
    plan = _plan(parse_landed(texts, layout))
    assert plan.count("from_json(") == 1
    # Looks up each character of a document, where the first one tells.
    assert "translate" not in plan


def test_blank_lines_are_no_documents(spark):
    texts = ["", " ", "\t\r\n ", " \t{}", " ", "x", None]
    landed = parse_landed(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r.value for r in landed.collect()) == sorted([" \t{}", " ", "x"])


def test_features_without_properties_are_null(spark):
    texts = ['{"properties": {"mag": 1}}', '{"properties": null}', '{"id": "a"}', "x", "[]"]
    landed = parse_landed(spark.createDataFrame([(t,) for t in texts], "value string"), "features")
    assert {r.value for r in landed.where("feature IS NOT NULL").collect()} == {texts[0]}


def test_rows_are_spread_where_few_tasks_read_them(spark, tmp_path):
    few, many = (landing_path(f"{tmp_path}/l", feed, DAY) for feed in ("daily", "historical"))
    land(few, collection(feature("a")))
    for n in range(9):
        land(many, collection(feature(f"b{n}")), name=f"{n}.json")
    assert spread_by_default(scan_landed(spark, few), "collections")
    assert not spread_by_default(scan_landed(spark, many), "collections")
    assert not spread_by_default(scan_landed(spark, few, "features"), "features")
    # One file for each reading task, and not those that a shuffle evens out.
    done = load(spark, "historical", DAY, landing=f"{tmp_path}/l", silver=f"{tmp_path}/s")
    rows = spark.read.parquet(done.day)
    assert len(rows.inputFiles()) > 1
    assert sorted(r.id for r in rows.collect()) == [f"b{n}" for n in range(9)]


def test_compressed_landing(spark, tmp_path):
    path = landing_path(f"{tmp_path}/l", "daily", DAY)
    rows = spark.read.schema("type string, features array<struct<id: string, properties: struct<mag: double>>>")
    land(f"{tmp_path}/from", *(collection(feature(f"a{n}", mag=1.0)) for n in range(7)))
    write_landing(rows.json(f"{tmp_path}/from"), path, compression="lz4", lines_per_file=3)
    assert len([p for p in (tmp_path / "l").rglob("*.lz4") if not p.name.startswith(".")]) >= 3
    done = load(spark, "daily", DAY, landing=f"{tmp_path}/l", silver=f"{tmp_path}/s")
    assert (done.documents, done.unreadable) == (7, 0)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [f"a{n}" for n in range(7)]


def test_events_are_dealt_to_all_cores(spark, tmp_path):
    """One row group is one task, which then made all documents; each core lands some now."""
    rows = spark.range(0, 400_000, 1, 1).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts", "id * 7919 AS user_id",
        "'click' AS event_type", "rand(1) AS value", """'{"k": 3}' AS props""",
    )
    rows.write.option("parquet.block.size", 1 << 28).parquet(str(tmp_path / "events.parquet"))
    _land(spark, str(tmp_path), f"{tmp_path}/a", f"{tmp_path}/b")
    writers = {name.split("-")[1] for name in os.listdir(f"{tmp_path}/a") if name.startswith("part-")}
    assert len(writers) >= 4
    lines = [spark.read.text(f"{tmp_path}/{folder}") for folder in "ab"]
    assert lines[0].distinct().count() == lines[1].count() == 400_000
    assert lines[0].exceptAll(lines[1]).isEmpty()


def _encodings(spark, folder):
    """If a column's values are kept in a dictionary, by column, of the one file in a folder."""
    (file,) = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = [group.column(n) for n in range(group.num_columns)]
    return {c.path_in_schema: any("DICTIONARY" in e for e in c.encodings) for c in columns}


def test_no_dictionary_for_values_of_one_event(spark, tmp_path):
    name = "tremor_test_plain"
    features = [feature(f"a{n}", place=f"{n} km N of X, CA", time="1700000000000", net="ci") for n in range(9)]
    land(landing_path(f"{tmp_path}/l", "daily", DAY), collection(*features))
    try:
        where = {"landing": f"{tmp_path}/l", "silver": f"{tmp_path}/s"}
        load(spark, "daily", DAY, table=name, table_path=f"{tmp_path}/t", **where)
        for layer in "st":
            kept = _encodings(spark, f"{tmp_path}/{layer}")
            assert not any(kept[c] for c in ("id", "place", "time", "updated", "title"))
            assert kept["net"] and kept["insert_dt"]
        assert sorted(r.id for r in spark.table(name).collect()) == [f"a{n}" for n in range(9)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_landing_lies_there_until_it_is_read(spark, tmp_path):
    events = [(n, datetime(2024, 1, 5), n, "view", 1.5, '{"k": 3}') for n in range(20)]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, kinds).write.parquet(f"{tmp_path}/events.parquet")
    paths = [f"{tmp_path}/landing/{name}" for name in "aabca"]
    seen = []
    for path, _ in zip(paths, registry._land_in_turn(spark, str(tmp_path), paths), strict=True):
        assert spark.read.text(path).count() == 20
        seen.append("".join(sorted(os.listdir(f"{tmp_path}/landing"))))
    assert seen == ["a", "a", "ab", "ac", "ac"]
    assert not os.listdir(f"{tmp_path}/landing")


@pytest.mark.parametrize("query", ["load_committed", "load_week_of_late_loads"])
def test_loads_leave_their_result_alone(spark, tmp_path, query, monkeypatch):
    events = [(n, datetime(2024, 1, 5), n, "view", 1.5, '{"k": 3}') for n in range(20)]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, kinds).write.parquet(f"{tmp_path}/events.parquet")
    folder, store, beside = f"{shared_folder(spark).removeprefix('file:')}/tremor", registry.stored, []

    def lying():
        return {os.path.relpath(at, folder) for at, _, files in os.walk(folder) if files} - before

    def storing(df, name, **options):
        beside.extend(lying())
        return store(df, name, **options)

    before = set()
    before = lying()
    monkeypatch.setattr(registry, "stored", storing)
    rows = registry.queries()[query](spark, str(tmp_path))
    # While the result is written no landing lies there, and then nothing but the result.
    assert beside and not [path for path in beside if path.startswith("landing")]
    assert lying() and all(path.startswith("journaled") for path in lying())
    assert rows.count() == {"load_committed": 240, "load_week_of_late_loads": 80}[query]
