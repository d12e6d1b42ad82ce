"""Rows keep their number when the files of a table are cut otherwise between two jobs."""

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tremor.llm import common, decontaminate, ngram_join, quality, suffix_dedup
from tremor.sinks import stored

LONG = " ".join(f"same{i}" for i in range(60))
LINE = "Read more on our site today and every day"


def _text(i: int) -> str:
    own = " ".join(f"w{i}x{k}" for k in range(60 + i % 7))
    kind = i % 4
    return [own, LONG, f"{LINE}\n{own}", f"{LINE}\n{LINE}\n{own} one two three four five six seven eight nine ten"][kind]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, _text(i), "h") for i in range(120)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return stored(made.repartition(12, "doc_id"), "places")


@pytest.fixture
def cut_anew(spark, monkeypatch):
    """After every table that an operator stores, the next scan cuts its files otherwise."""
    key = "spark.sql.files.maxPartitionBytes"
    sizes = ["64k", "128m"]

    def flipped(*args, **kwargs):
        out = stored(*args, **kwargs)
        spark.conf.set(key, sizes[0])
        sizes.reverse()
        return out

    for module in (decontaminate, ngram_join, quality, suffix_dedup):
        monkeypatch.setattr(module, "stored", flipped)
    yield
    spark.conf.unset(key)


def test_suffix_dedup(table, cut_anew):
    data = [(i, _text(i).encode()) for i in range(120)]
    masks = brute.repeats(data)
    expected = {i: brute.kept_bytes(text, masks[i]).decode() for i, text in data}
    found = {r.doc_id: r.text for r in suffix_dedup.deduplicate(table).collect()}
    assert found == {i: text for i, text in expected.items() if text.strip(" ")}


def test_quality(table, cut_anew):
    limits = (quality.MIN_DOCUMENTS, quality.MOST_SHARE, quality.MOST_REMOVED)
    expected = brute.quality([(i, "h", _text(i)) for i in range(120)], *limits)
    assert {r.doc_id: r.text for r in quality.clean(table).collect()} == expected
    assert expected[2] == _text(2).removeprefix(f"{LINE}\n")
    assert {r.doc_id for r in quality.judge(table).collect() if r.kept} == set(expected)


def test_ngram_join(table, cut_anew):
    expected = brute.components([(i, _text(i)) for i in range(120)], 5, 80)
    found = ngram_join.keep_first(table, 5, 80).collect()
    assert {r.doc_id: r.text for r in found} == {i: _text(i) for i in {c for _, c in expected.values()}}


@pytest.mark.parametrize("most", [ngram_join.MOST_BITMAPS, 0])
def test_rows_of_places(spark, monkeypatch, most):
    """By bitmaps, and by a shuffle where there are too many of them."""
    monkeypatch.setattr(ngram_join, "MOST_BITMAPS", most)
    edges = [0, 1, 7, 8, 9, 32_767, 32_768, 65_535, 65_536]
    numbers = [(file << 40) + at for file in (0, 1, 70_000) for at in edges]
    rows = spark.createDataFrame([(n, str(n)) for n in numbers], f"{common.ROW} bigint, text string")
    for kept in (numbers[::2], numbers[1::2], numbers, []):
        places = spark.createDataFrame([(n,) for n in kept], f"{common.ROW} bigint")
        found = ngram_join._rows_of(rows, places)
        assert sorted(int(r.text) for r in found.collect()) == sorted(kept)
        if most and kept:
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("most", [ngram_join.MOST_BITMAPS, 0])
def test_first_documents(table, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "MOST_BITMAPS", most)
    expected = brute.components([(i, _text(i)) for i in range(120)], 5, 80)
    found = ngram_join.keep_first(table, 5, 80).collect()
    assert sorted(r.doc_id for r in found) == sorted({c for _, c in expected.values()})


def test_decontamination(spark, table, cut_anew):
    items = [(1, "one two three four five six seven eight nine ten")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    hits = brute.contamination([(i, _text(i)) for i in range(120)], items)
    found = decontaminate.remove_documents(table, benchmark).collect()
    assert {r.doc_id for r in found} == {i for i, hit in hits.items() if not hit[1]}


def test_frames_without_places_are_stored(spark, table):
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    assert common.stable(table) is table
    kept = table.filter("doc_id > 3").select("text")
    assert common.stable(kept) is kept
    for frame in (
        spark.range(3),
        table.union(table),
        table.select(F.explode(F.array(F.lit(1), F.lit(2)))),
        table.filter(F.rand(1) < 0.5),
        spark.read.parquet(path, path),
        table.join(table.select("doc_id"), "doc_id"),
    ):
        again = common.stable(frame)
        assert again is not frame
        rows = common.packed(again).collect()
        assert len({r[common.ROW] for r in rows}) == len(rows)
    assert common.packed(table.limit(0).transform(common.stable)).collect() == []
