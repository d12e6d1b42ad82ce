from datetime import datetime

import pytest
from feed import collection, feature, land

from tremor import schema
from tremor.operators.flatten import explode_features, flatten, transform, with_load_ts
from tremor.sources import scan_geojson

LOAD_TS = datetime(2024, 1, 30, 12, 0)

FULL = dict(
    mag=4.3, place="10 km SSW of Idyllwild, CA", time=1730610000123, updated=1730613600123, tz=-480,
    url="u", detail="d", felt=3, cdi=2.5, mmi=1.25, alert="green", status="reviewed", tsunami=0,
    sig=284, net="ci", code="40000", ids=",ci40000,", sources=",ci,", types=",origin,", nst=20,
    dmin=0.05, rms=0.2, gap=45.0, magType="ml", type="earthquake", title="M 4.3",
)


@pytest.fixture
def scanned(spark, tmp_path):
    def scan(*documents):
        return scan_geojson(spark, land(tmp_path / "landing", *documents))

    return scan


def rows(df, variant="typed"):
    done = transform(flatten(explode_features(df), variant), LOAD_TS, variant=variant)
    assert [(f.name, f.dataType) for f in done.schema] == [
        (f.name, f.dataType) for f in schema.silver_schema(variant)
    ]
    return [row.asDict() for row in done.collect()]


def test_schemas():
    assert len(schema.SILVER_TEXT) == 31
    # The 31 columns of the typed variant, and the feature id.
    assert len(schema.SILVER_TYPED) == 32
    assert schema.SILVER_TYPED.names[:4] == ["id", "mag", "place", "time"]
    assert schema.SILVER_TYPED.names[-6:] == [
        "geometry_type", "longitude", "latitude", "depth", "area", "insert_dt",
    ]
    assert schema.SILVER_TEXT.names[:6] == ["magnitude", "place", "area", "time", "updated", "insert_date"]
    assert schema.SILVER_TEXT.names[-5:] == ["type", "title", "latitude", "longitude", "depth"]
    with pytest.raises(ValueError):
        schema.silver_schema("other")


def test_every_field_arrives(scanned):
    document = collection(feature("ci1", (-116.123456789, 33.5, 10.25), **FULL))
    [typed] = rows(scanned(document))
    expected = {k: v for k, v in FULL.items() if k != "type"} | {
        "time": datetime(2024, 11, 3, 5), "updated": datetime(2024, 11, 3, 6), "id": "ci1",
        "geometry_type": "Point", "longitude": -116.123456789, "latitude": 33.5, "depth": 10.25,
        "area": "Idyllwild, CA", "insert_dt": LOAD_TS,
    }
    assert typed == expected
    [text] = rows(scanned(document), "text")
    expected = {k: v for k, v in FULL.items() if k != "mag"} | {
        "magnitude": 4.3, "time": "2024-11-03 05:00:00", "updated": "2024-11-03 06:00:00",
        "longitude": -116.123456789, "latitude": 33.5, "depth": 10.25,
        "area": "CA", "insert_date": "2024-01-30T12:00:00",
    }
    assert text == expected


@pytest.mark.parametrize("variant", ["typed", "text"])
def test_poor_features_keep_their_row(scanned, variant):
    mag = "mag" if variant == "typed" else "magnitude"
    got = rows(
        scanned(
            collection(
                feature("short", (1.0, 2.0), mag=1.5, felt=3.0, time="abc"),
                feature("nowhere", geometry=False, mag="x", place=None, felt=4),
                feature("bare"),
            )
        ),
        variant,
    )
    assert len(got) == 3
    short, nowhere, bare = got
    assert (short["longitude"], short["latitude"], short["depth"]) == (1.0, 2.0, None)
    assert (short[mag], short["felt"], short["time"], short["area"]) == (1.5, 3, None, None)
    assert (nowhere["longitude"], nowhere["latitude"], nowhere["depth"]) == (None, None, None)
    assert (nowhere[mag], nowhere["felt"], nowhere["area"]) == (None, 4, None)
    assert (bare[mag], bare["place"], bare["depth"]) == (None, None, 3.5)


def test_lists_without_features_give_no_row(scanned):
    document = collection(feature("a"))
    df = scanned(collection(), document, {**document, "features": None})
    assert [r["id"] for r in rows(df)] == ["a"]


def test_area_rule_can_be_chosen(scanned):
    df = scanned(collection(feature("a", place="5 km N of A, B")))
    flat = flatten(explode_features(df))
    assert transform(flat, LOAD_TS, "comma").first()["area"] == "B"
    assert transform(flat, LOAD_TS, "tail").first()["area"] == "A, B"


def test_load_instant_is_the_same_in_every_use_of_a_frame(spark):
    df = with_load_ts(spark.range(3))
    assert df.select("insert_dt").distinct().collect() == df.select("insert_dt").distinct().collect()
