"""Schemas of the landing documents and of the silver layer, declared once.

Landing is read wider than silver is stored: whole-number fields are read as
doubles, so that ``3.0`` in a feed is not lost, and the two epoch fields are
read as text, so that a bad value costs one cell and not the row.
"""

from pyspark.sql import types as T

# Names and order of a feature's properties in the feed, with the
# type each one has in silver.
PROPERTIES = [
    ("mag", "double"),
    ("place", "string"),
    ("time", "epoch"),
    ("updated", "epoch"),
    ("tz", "bigint"),
    ("url", "string"),
    ("detail", "string"),
    ("felt", "bigint"),
    ("cdi", "double"),
    ("mmi", "double"),
    ("alert", "string"),
    ("status", "string"),
    ("tsunami", "bigint"),
    ("sig", "bigint"),
    ("net", "string"),
    ("code", "string"),
    ("ids", "string"),
    ("sources", "string"),
    ("types", "string"),
    ("nst", "bigint"),
    ("dmin", "double"),
    ("rms", "double"),
    ("gap", "double"),
    ("magType", "string"),
    ("type", "string"),
    ("title", "string"),
]

# Position of each coordinate in a GeoJSON point.
COORDINATES = {"longitude": 0, "latitude": 1, "depth": 2}

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# The type each kind of property is read with from landing.
READ_AS = {"double": "double", "bigint": "double", "string": "string", "epoch": "string"}


def _struct(*fields: tuple[str, str | T.DataType]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind) for name, kind in fields]
    )


FEATURE = _struct(
    ("type", "string"),
    ("properties", _struct(*[(name, READ_AS[kind]) for name, kind in PROPERTIES])),
    ("geometry", _struct(("type", "string"), ("coordinates", T.ArrayType(T.DoubleType())))),
    ("id", "string"),
)
METADATA = _struct(
    ("generated", "bigint"),
    ("url", "string"),
    ("title", "string"),
    ("status", "bigint"),
    ("api", "string"),
    ("count", "bigint"),
)
COLLECTION = _struct(
    ("type", "string"), ("metadata", METADATA), ("features", T.ArrayType(FEATURE))
)

_STORED = dict(PROPERTIES)


def _silver(epochs: str, *names: str | tuple[str, str]) -> T.StructType:
    """Silver columns; those without a type of their own have their property's."""
    typed = [(n, _STORED[n]) if isinstance(n, str) else n for n in names]
    return _struct(*[(n, epochs if kind == "epoch" else kind) for n, kind in typed])


# Silver, typed variant: timestamps, the feature id and the geometry type.
SILVER_TYPED = _silver(
    "timestamp",
    ("id", "string"),
    *[name for name, _ in PROPERTIES if name != "type"],
    ("geometry_type", "string"),
    ("longitude", "double"),
    ("latitude", "double"),
    ("depth", "double"),
    ("area", "string"),
    ("insert_dt", "timestamp"),
)

# Silver, text variant: times as text, `magnitude` for `mag`, the event type.
SILVER_TEXT = _silver(
    "string",
    ("magnitude", "double"),
    "place",
    ("area", "string"),
    "time",
    "updated",
    ("insert_date", "string"),
    *[name for name, _ in PROPERTIES if name not in ("mag", "place", "time", "updated")],
    ("latitude", "double"),
    ("longitude", "double"),
    ("depth", "double"),
)

SILVER = {"typed": SILVER_TYPED, "text": SILVER_TEXT}

# Columns with a value of their own in nearly every row. Parquet would look each one up in a
# dictionary, and give that up at its size limit or keep what is hardly smaller; written plainly
# they cost a third less.
_SINGULAR = ("id", "place", "time", "updated", "url", "detail", "code", "ids", "title")
PARQUET_OPTIONS = {f"parquet.enable.dictionary#{name}": "false" for name in _SINGULAR}

# Names of the columns that the analyses use, per variant.
ANALYSIS_COLUMNS = {
    "typed": {"mag": "mag", "loaded": "insert_dt"},
    "text": {"mag": "magnitude", "loaded": "insert_date"},
}

# Partition columns of landing and silver folders. Each load has a silver folder
# of its own, named after its id.
LANDING_PARTITIONS = _struct(("feed", "string"), ("load_date", "date"))
SILVER_PARTITIONS = _struct(("feed", "string"), ("load_date", "date"), ("load_id", "string"))


def silver_schema(variant: str) -> T.StructType:
    if variant not in SILVER:
        raise ValueError(f"variant must be one of {sorted(SILVER)}, not {variant!r}")
    return SILVER[variant]
