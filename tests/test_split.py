"""Documents of any size, cut anywhere."""

import json

import pytest
from feed import collection, feature, land
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.plans import load
from tremor.sources import BrokenDocumentError, landing_path, scan_documents, split_features
from tremor.sources.split import _placed, _Range, _Reader, _Structure

NASTY = '"features": [{"a": 1}], \\ \\" }]{[ é  '


def _document(n=40, indent=None):
    features = [feature(f"{i}{NASTY}", mag=float(i), place="\\" * (i % 5) + '"' * (i % 3)) for i in range(n)]
    made = {"features ": [{"id": "no"}], **collection(*features), "features2": [{}], "more": {"features": [{"id": "no"}]}}
    made["metadata"]["features"] = [{"id": "no"}]
    return made, json.dumps(made, indent=indent, ensure_ascii=False)


def _cut(path, size, step):
    """The features' texts, read range by range without Spark."""
    ranges = [(str(path), i, min(i + step, size), size) for i in range(0, size, step)]
    outlines = {}
    for given_ in ranges:
        found = _Structure(*_Range(*given_).read())
        outlines[given_[:2]] = (len(found.quotes) % 2 == 1, *found.outline(False), *found.outline(True))
    reader = _Reader({"pass": "features", "ranges": json.dumps(_placed(ranges, outlines))})
    return [x for part in reader.partitions() for batch in reader.read(part) for x in batch.column(0).to_pylist()]


@pytest.mark.parametrize("indent", [None, 1, 4])
@pytest.mark.parametrize("step", [1, 7, 64, 1000, 10**6])
def test_any_cut_gives_the_features(tmp_path, indent, step):
    made, text = _document(8 if step == 1 else 40, indent)
    path = tmp_path / "d.json"
    path.write_text(text)
    found = _cut(path, len(text.encode()), step)
    assert [json.loads(x) for x in found] == made["features"]


_values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text('ab"\\[]{}:, \n', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["features", "a", 'x"', "\\"]), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["a", "features"]), _values, max_size=3), max_size=5), _values, st.integers(1, 40))
def test_any_document(tmp_path_factory, features, other, step):
    text = json.dumps({"a": other, "features": features, "z": other}) + json.dumps({"features": features[:1]}, indent=2)
    path = tmp_path_factory.mktemp("d") / "d.json"
    path.write_text(text)
    assert [json.loads(x) for x in _cut(path, len(text.encode()), step)] == features + features[:1]


def test_scan_has_many_partitions(spark, tmp_path):
    _, text = _document(300)
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text(_document(5, 2)[1])
    (tmp_path / "_hidden.json").write_text("{")
    rows = scan_documents(spark, str(tmp_path), 2_000)
    assert rows.rdd.getNumPartitions() > 20
    found = sorted(r[0] for r in rows.select("feature.properties.mag").collect())
    assert found == sorted([float(i) for i in range(300)] + [float(i) for i in range(5)])


@pytest.mark.parametrize("broken", ['{"features": [{"a": 1}', '{"features": []}}', '{"features": ["a]}'])
def test_broken_documents(spark, tmp_path, broken):
    (tmp_path / "a.json").write_text(broken)
    with pytest.raises(BrokenDocumentError):
        split_features(spark, str(tmp_path), 4)


def test_no_documents(spark, tmp_path):
    assert split_features(spark, str(tmp_path)).collect() == []
    (tmp_path / "a.json").write_text('{"type": "Topology"}')
    assert split_features(spark, str(tmp_path)).collect() == []


def test_load_of_documents(spark, tmp_path):
    from datetime import date

    day = date(2024, 1, 5)
    land(landing_path(f"{tmp_path}/l", "daily", day), collection(feature("a"), {"type": "Feature"}), indent=2)
    options = {"landing": f"{tmp_path}/l", "silver": f"{tmp_path}/s", "layout": "documents"}
    done = load(spark, "daily", day, keep_good=True, **options)
    assert (done.documents, done.unreadable) == (2, 1)
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/s").collect()] == ["a"]


def test_ranges_of_a_large_document_are_bounded(spark, sf_dir, monkeypatch):
    """A seventh of a document grows with it, and a task holds a range."""
    from tremor.checks import registry

    given_, scan = [], registry.scan_documents
    monkeypatch.setattr(registry, "RANGE_BYTES", 20_000, raising=False)
    monkeypatch.setattr(registry, "scan_documents", lambda s, path, n: given_.append(n) or scan(s, path, n))
    n = 2 * spark.read.parquet(f"{sf_dir}/events.parquet").count()
    for name in ("split_document_line", "split_document_pretty"):
        assert registry.queries()[name](spark, sf_dir).select("id").distinct().count() == n
    assert given_ == [20_000] * 2
