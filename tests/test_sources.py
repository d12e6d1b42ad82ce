from datetime import date

import pytest
from feed import collection, feature, land
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

from tremor import schema
from tremor.operators.flatten import explode_features
from tremor.sinks import write_landing, write_silver, write_table
from tremor.sources import (
    corrupt_documents,
    landing_path,
    parse_feature,
    scan_completed_orders,
    scan_features,
    scan_geojson,
    scan_landed,
    scan_silver,
    scan_table,
    silver_path,
)

DAY = date(2024, 1, 5)


def test_paths():
    assert landing_path("/l/", "daily", DAY) == "/l/feed=daily/load_date=2024-01-05"
    assert landing_path("/l", "daily", DAY, "dated") == "/l/20240105"
    assert landing_path("/l", "historical", DAY, "dated") == "/l/historical/20240105"
    assert silver_path("/s", "historical", DAY) == "/s/feed=historical/load_date=2024-01-05"
    with pytest.raises(ValueError):
        landing_path("/l", "weekly", DAY)
    with pytest.raises(ValueError):
        landing_path("/l", "daily", DAY, "other")


def test_digit_glob_leaves_history_out(spark, tmp_path):
    for feed, fid in (("daily", "d"), ("historical", "h")):
        land(landing_path(str(tmp_path), feed, DAY, "dated"), collection(feature(fid)))
    daily = explode_features(scan_geojson(spark, f"{tmp_path}/[0-9]*"))
    assert [r[0] for r in daily.select("feature.id").collect()] == ["d"]


def test_partitioned_folders_are_columns(spark, tmp_path):
    for feed in ("daily", "historical"):
        land(landing_path(str(tmp_path), feed, DAY), collection(feature(feed)))
    rows = explode_features(scan_geojson(spark, str(tmp_path)), keep=("feed", "load_date"))
    got = rows.select("feature.id", "feed", "load_date").collect()
    assert sorted(map(tuple, got)) == [("daily", "daily", DAY), ("historical", "historical", DAY)]


def test_pretty_printed_file(spark, tmp_path):
    document = collection(feature("a", mag=1.5), feature("b"))
    compact = land(tmp_path / "compact", document)
    pretty = land(tmp_path / "pretty", document, indent=2)
    assert scan_landed(spark, pretty).where("features IS NOT NULL").isEmpty()
    assert scan_landed(spark, pretty, multi_line=True).select("features").collect() == (
        scan_landed(spark, compact).select("features").collect()
    )
    expected = scan_geojson(spark, compact).collect()
    assert scan_geojson(spark, pretty, multi_line=True).collect() == expected
    assert scan_geojson(spark, compact, multi_line=True).collect() == expected


def test_quiet_and_absent_days_are_no_error(spark, tmp_path):
    [row] = scan_landed(spark, land(tmp_path / "quiet", collection())).collect()
    assert row.features == []
    assert scan_landed(spark, land(tmp_path / "empty")).count() == 0


def test_feature_lines_and_feature_text(spark, tmp_path):
    one, two = feature("a", mag=1.5), feature("b")
    lines = scan_features(spark, land(tmp_path / "lines", one, two))
    inside = explode_features(scan_geojson(spark, land(tmp_path / "inside", collection(one, two))))
    assert sorted(lines.collect(), key=str) == sorted(inside.collect(), key=str)
    text = lines.select(F.lit(7).alias("n"), F.to_json("feature").alias("json"))
    parsed = parse_feature(text, "json")
    assert parsed.columns == ["n", "feature"]
    assert sorted(parsed.select("feature").collect(), key=str) == sorted(lines.collect(), key=str)
    assert sorted(parse_feature(lines, "feature").collect(), key=str) == sorted(lines.collect(), key=str)


def test_corrupt_values_are_counted(spark, tmp_path):
    path = land(
        tmp_path / "l", collection(feature("a", mag="x")), collection(feature("b", felt=3.0)), "no document"
    )
    scanned = scan_geojson(spark, path, keep_corrupt=True)
    assert tuple(corrupt_documents(scanned).first()) == (3, 2, 2)
    path = land(tmp_path / "f", feature("a", mag="x"), feature("b"))
    assert tuple(corrupt_documents(scan_features(spark, path, keep_corrupt=True)).first()) == (2, 2, 1)


def test_landing_keeps_nulls(spark, tmp_path):
    df = spark.sql("SELECT 'FeatureCollection' AS type, cast(NULL AS string) AS metadata")
    for mode, files in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        write_landing(df, str(tmp_path / "l"), mode)
        lines = [r[0] for r in spark.read.text(str(tmp_path / "l")).collect()]
        assert lines == ['{"type":"FeatureCollection","metadata":null}'] * files
    assert {p.suffix for p in (tmp_path / "l").glob("part-*")} == {".json"}


def test_silver_is_cast_to_its_schema(spark, tmp_path):
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.SILVER_TEXT]
    df = spark.range(3).select(*nothing).withColumns({"felt": F.lit(2), "magnitude": F.lit(1).cast("float")})
    for mode, rows in (("append", 3), ("append", 6), ("overwrite", 3)):
        write_silver(df, str(tmp_path / "s"), mode, variant="text")
        assert spark.read.parquet(str(tmp_path / "s")).count() == rows
    read = scan_silver(spark, str(tmp_path / "s"), "text", partitioned=False)
    assert [f.dataType for f in read.schema] == [f.dataType for f in schema.SILVER_TEXT]
    assert tuple(read.select("felt", "magnitude").first()) == (2, 1.0)
    assert all(name.endswith((".snappy.parquet", "_SUCCESS")) for name in _files(tmp_path / "s"))


def _files(path):
    return [p.name for p in path.iterdir() if not p.name.startswith(".")]


def test_table_modes(spark):
    def day(n, d):
        return spark.range(n).withColumn("feed", F.lit("daily")).withColumn("load_date", F.lit(d).cast("date"))

    def counts():
        found = scan_table(spark, "modes").groupBy("load_date").count().collect()
        return {str(r["load_date"]): r["count"] for r in found}

    by = ("feed", "load_date")
    write_table(day(3, "2024-01-01"), "modes", "append", partition_by=by)
    write_table(day(3, "2024-01-01"), "modes", "append", partition_by=by)
    write_table(day(4, "2024-01-02"), "modes", "append", partition_by=by)
    assert counts() == {"2024-01-01": 6, "2024-01-02": 4}
    first = {"feed": "daily", "load_date": "2024-01-01"}
    # Columns in another order than the table's.
    write_table(day(2, "2024-01-01").select("load_date", "feed", "id"), "modes", "replace_partition", partition=first)
    assert counts() == {"2024-01-01": 2, "2024-01-02": 4}
    write_table(day(0, "2024-01-01"), "modes", "replace_partition", partition=first)
    assert counts() == {"2024-01-02": 4}
    write_table(day(5, "2024-01-03"), "modes", "overwrite", partition_by=by)
    assert counts() == {"2024-01-03": 5}
    spark.sql("DROP TABLE modes")
    fourth = {"feed": "daily", "load_date": "2024-01-04"}
    write_table(day(1, "2024-01-04"), "modes", "replace_partition", partition=fourth)
    assert counts() == {"2024-01-04": 1}
    spark.sql("DROP TABLE modes")


def test_connector_tables(spark, tmp_path):
    class Echo(DataSource):
        """A connector that answers with the table's name and an option."""

        @classmethod
        def name(cls):
            return "echo"

        def schema(self):
            return "name string, project string"

        def reader(self, schema):
            options = self.options

            class Reader(DataSourceReader):
                def read(self, partition):
                    yield (options["table"], options["project"])

            return Reader()

        def writer(self, schema, overwrite):
            options = self.options

            class Writer(DataSourceWriter):
                def write(self, rows):
                    with open(f"{options['folder']}/{options['table']}-{overwrite}", "a") as out:
                        out.writelines(f"{row.name}\n" for row in rows)
                    return WriterCommitMessage()

            return Writer()

    spark.dataSource.register(Echo)
    assert tuple(scan_table(spark, "a.b.c", "echo", project="p").first()) == ("a.b.c", "p")

    df = spark.createDataFrame([("x", "y")], "name string, project string")
    for mode in ("append", "overwrite"):
        write_table(df, "t", mode, fmt="echo", folder=str(tmp_path))
    assert [(tmp_path / f"t-{over}").read_text() for over in (False, True)] == ["x\n"] * 2
    with pytest.raises(ValueError):
        write_table(df, "t", "replace_partition", fmt="echo")


def test_completed_orders(spark):
    orders = spark.createDataFrame(
        [(1, 10, 5.0, "COMPLETED"), (1, 11, 6.0, "OPEN"), (2, 12, 7.0, None)],
        "user_id bigint, order_id bigint, order_value double, order_status string",
    )
    assert list(map(tuple, scan_completed_orders(orders).collect())) == [(1, 10, 5.0)]
