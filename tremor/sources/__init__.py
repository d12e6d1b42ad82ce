"""Reading landing documents, silver files and tables."""

from tremor.sources.geojson import (
    LAYOUTS,
    NoFeaturesError,
    checked_layout,
    content_column,
    corrupt_documents,
    parse_feature,
    parse_landed,
    scan_documents,
    scan_features,
    scan_geojson,
    scan_landed,
)
from tremor.sources.paths import FEEDS, landing_path, silver_path
from tremor.sources.silver import scan_silver
from tremor.sources.split import BrokenDocumentError, split_features
from tremor.sources.tables import scan_completed_orders, scan_table

__all__ = [
    "BrokenDocumentError",
    "FEEDS",
    "LAYOUTS",
    "NoFeaturesError",
    "checked_layout",
    "content_column",
    "corrupt_documents",
    "landing_path",
    "parse_feature",
    "parse_landed",
    "scan_completed_orders",
    "scan_documents",
    "scan_features",
    "scan_geojson",
    "scan_landed",
    "scan_silver",
    "scan_table",
    "silver_path",
    "split_features",
]
