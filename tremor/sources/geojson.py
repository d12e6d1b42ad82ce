"""Scans of GeoJSON landing files.

Two layouts can be landed. A *collection* is one ``FeatureCollection`` per
line, and a line is the smallest unit a task can read. A *feature* file holds
one feature per line, so that a file of any size is split over many tasks. Both
end as one row per feature in a ``feature`` column.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor import schema
from tremor.sources.split import RANGE_BYTES, split_features

CORRUPT = "_corrupt_record"


LAYOUTS = ("collections", "features")


class NoFeaturesError(ValueError):
    """Landed documents hold no features; they lie in the rejects folder."""


def checked_layout(layout: str) -> str:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    return layout


def parse_landed(texts: DataFrame, layout: str = "collections", keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed texts in ``value``, parsed: ``features`` or ``feature`` beside the text.

    That column is null where a text holds no feature list, or no feature. Blank
    lines are no documents. The columns in ``keep`` stay.
    """
    whole = checked_layout(layout) == "collections"
    # Ends at the first other character; ``translate`` looks each one of a document up.
    texts = texts.where(F.ltrim("value", F.lit(" \t\r\n")) != "")
    if whole:
        return texts.select(*keep, "value", F.from_json("value", schema.COLLECTION)["features"].alias("features"))
    # In a projection of its own, or the test of its properties would parse it once more.
    parsed = texts.select(*keep, "value", F.from_json("value", schema.FEATURE).alias("document"))
    content = F.when(F.col("document.properties").isNotNull(), F.col("document"))
    return parsed.select(*keep, "value", content.alias("feature"))


def scan_landed(
    spark: SparkSession, path: str, layout: str = "collections", *, multi_line: bool = False
) -> DataFrame:
    """Landed documents with their text, one per line or, with ``multi_line``, one per file.

    The layout ``documents`` is files of one document of any size and spelling; its features
    come with their text, like those of the layout ``features``.
    """
    if layout == "documents":
        return parse_landed(split_features(spark, path), "features")
    return parse_landed(spark.read.text(path, wholetext=multi_line), layout)


def scan_geojson(
    spark: SparkSession, path: str, *, multi_line: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """Feature collections, one per line, read with the declared schema.

    ``multi_line`` reads files that hold one pretty-printed document each.
    ``keep_corrupt`` adds the text of every document with a value that did not
    fit its field; that field alone is null, the row stays.
    """
    fields = schema.COLLECTION
    if keep_corrupt:
        fields = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(fields).option("multiLine", multi_line).json(path)


def scan_documents(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Features of documents of any size and spelling, pretty-printed or on one line.

    Ranges of a file are read by tasks of their own. Rows are as those of ``scan_features``.
    """
    return parse_landed(split_features(spark, path, range_bytes), "features").select("feature")


def scan_features(spark: SparkSession, path: str, *, keep_corrupt: bool = False) -> DataFrame:
    """Features, one per line, as a ``feature`` column."""
    fields = schema.FEATURE
    if keep_corrupt:
        fields = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(fields).json(path)
    feature = F.struct(*schema.FEATURE.names).alias("feature")
    return rows.select(feature, *([CORRUPT] if keep_corrupt else []))


def parse_feature(df: DataFrame, col: str) -> DataFrame:
    """Replace a feature given as JSON text by a parsed ``feature``, which is null
    where the text is no feature; a feature that is a struct already is only renamed."""
    feature = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        parsed = F.from_json(feature, schema.FEATURE)
        feature = F.when(parsed["properties"].isNotNull(), parsed)
    others = [name for name in df.columns if name != col]
    return df.select(*others, feature.alias("feature"))


def content_column(landed: DataFrame) -> str:
    """What a document that was read must have: a feature list, or a feature's properties."""
    return "features" if "features" in landed.columns else "feature.properties"


def corrupt_documents(df: DataFrame) -> DataFrame:
    """Number of documents, of those with content, and of those with a value that
    did not fit its field. ``df`` comes from a scan with ``keep_corrupt``."""
    return df.agg(
        F.count("*").alias("documents"),
        F.count(content_column(df)).alias("with_content"),
        F.count(CORRUPT).alias("corrupt"),
    )
