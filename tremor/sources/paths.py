"""Folder names of the landing and silver layers."""

from datetime import date

# The two feeds.
FEEDS = ("daily", "historical")


def _checked(feed: str) -> str:
    if feed not in FEEDS:
        raise ValueError(f"feed must be one of {FEEDS}, not {feed!r}")
    return feed


def landing_path(root: str, feed: str, run_date: date, style: str = "partitioned") -> str:
    """Landing folder of one feed and day.

    ``partitioned`` folders (``feed=daily/load_date=2024-01-31``) let Spark
    prune by feed and day and keep the two feeds apart. ``dated`` folders
    (``20240131`` and ``historical/20240131``) read landing data that is
    already laid out so; to scan the days of the daily feed alone, use the glob
    ``[0-9]*``, since ``*`` would take ``historical`` along.
    """
    _checked(feed)
    root = root.rstrip("/")
    if style == "partitioned":
        return f"{root}/feed={feed}/load_date={run_date:%Y-%m-%d}"
    if style == "dated":
        folder = f"{run_date:%Y%m%d}"
        return f"{root}/{folder}" if feed == "daily" else f"{root}/{feed}/{folder}"
    raise ValueError(f"style must be 'partitioned' or 'dated', not {style!r}")


def silver_path(root: str, feed: str, run_date: date) -> str:
    """Silver folder of one feed and day; each load has a folder below it."""
    return f"{root.rstrip('/')}/feed={_checked(feed)}/load_date={run_date:%Y-%m-%d}"
