"""The queries by name. Sums and means of doubles are rounded, because their last
digits depend on the order of the rows; days are text, so that every client
prints them alike."""

from collections.abc import Iterator
from contextlib import ExitStack
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor import schema
from tremor.checks import inputs as i
from tremor.checks.inputs import Query
from tremor.functions import area_comma, area_tail, epoch_ms_to_str, epoch_ms_to_ts, naive_utc
from tremor.operators import analysis as a
from tremor.operators import orders as o
from tremor.operators.flatten import flatten, transform
from tremor.plans import (
    analyses,
    analyses_of_loads,
    change_of_places,
    drop_place_totals,
    frequency_intensity_of_totals,
    load,
    order_report,
    scan_loads,
    scan_place_totals,
    write_place_totals,
)
from tremor.plans.load import silver_rows
from tremor.sinks import (
    Journal,
    move_folder,
    remove,
    scratch,
    scratch_path,
    stored,
    write_landing,
    write_pairs_text,
    write_silver,
    write_table,
    zones,
)
from tremor.sources import (
    landing_path,
    parse_feature,
    scan_completed_orders,
    scan_documents,
    scan_features,
    scan_geojson,
    scan_silver,
    scan_table,
)
from tremor.sources.split import RANGE_BYTES
from tremor.streaming import load_incremental

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def _query(sql: str, name: str | None = None):
    """Register a query under its function's name, or under another."""

    def register(build: Query) -> Query:
        _QUERIES[name or build.__name__] = build
        _ORACLE[name or build.__name__] = sql
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _rounded(df: DataFrame, col: str, digits: int) -> DataFrame:
    return df.withColumn(col, F.round(col, digits))


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.with_day(i.quakes(spark, sf_dir), "insert_dt")


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


# ---- analyses --------------------------------------------------------------

_DAY = "CAST(CAST(insert_dt AS DATE) AS VARCHAR)"


@_query(i.QUAKES_SQL + "SELECT area, count(*) AS n FROM q GROUP BY area")
def count_by_area(spark, sf_dir):
    return a.count_by(i.quakes(spark, sf_dir), "area")


@_query(i.QUAKES_SQL + "SELECT area, round(avg(mag), 6) AS avg_mag FROM q GROUP BY area")
def mean_mag_by_area(spark, sf_dir):
    return _rounded(a.mean_by(i.quakes(spark, sf_dir), "area", "mag", "avg_mag"), "avg_mag", 6)


@_query(i.QUAKES_SQL + "SELECT insert_dt, count(*) AS n FROM q GROUP BY insert_dt")
def count_by_instant(spark, sf_dir):
    return a.count_by(i.quakes(spark, sf_dir), "insert_dt")


@_query(i.QUAKES_SQL + "SELECT area, insert_dt, count(*) AS n FROM q GROUP BY area, insert_dt")
def count_by_area_instant(spark, sf_dir):
    return a.count_by(i.quakes(spark, sf_dir), "area", "insert_dt")


@_query(i.QUAKES_SQL + f"SELECT {_DAY} AS day, count(*) AS n FROM q GROUP BY 1")
def count_by_day(spark, sf_dir):
    return _day_text(a.count_by(_by_day(spark, sf_dir), "day"))


@_query(i.QUAKES_SQL + f"SELECT {_DAY} AS day, area, count(*) AS n FROM q GROUP BY 1, 2")
def count_by_day_area(spark, sf_dir):
    return _day_text(a.count_by(_by_day(spark, sf_dir), "day", "area"))


@_query(
    i.QUAKES_SQL
    + f"SELECT round(avg(n), 6) AS avg_n FROM (SELECT count(*) AS n FROM q GROUP BY {_DAY})"
)
def mean_daily_count(spark, sf_dir):
    return _rounded(a.mean_group_size(_by_day(spark, sf_dir), "day"), "avg_n", 6)


@_query(i.QUAKES_SQL + f"SELECT {_DAY} AS day, CAST(count(*) AS DOUBLE) AS avg_n FROM q GROUP BY 1")
def mean_daily_count_per_day(spark, sf_dir):
    return _day_text(a.mean_count_per_key(_by_day(spark, sf_dir), "day"))


@_query(
    i.QUAKES_SQL
    + f"SELECT round(avg(n), 6) AS avg_n FROM (SELECT count(*) AS n FROM q GROUP BY {_DAY}, area)"
)
def mean_daily_area_count(spark, sf_dir):
    return _rounded(a.mean_group_size(_by_day(spark, sf_dir), "day", "area"), "avg_n", 6)


@_query(i.QUAKES_SQL + f"SELECT {_DAY} AS day, area, CAST(avg(1) AS DOUBLE) AS avg_n FROM q GROUP BY 1, 2")
def mean_of_ones_day_area(spark, sf_dir):
    return _day_text(a.mean_of_ones(_by_day(spark, sf_dir), "day", "area"))


@_query(i.QUAKES_SQL + "SELECT area, max(mag) AS max_mag FROM q GROUP BY area")
def max_mag_by_area(spark, sf_dir):
    return a.max_by_area(i.quakes(spark, sf_dir))


@_query(
    i.QUAKES_SQL
    + "SELECT area, max(mag) AS max_mag FROM q GROUP BY area ORDER BY max_mag DESC, area LIMIT 1"
)
def top_area(spark, sf_dir):
    return a.top_area(i.quakes(spark, sf_dir))


@_query(
    i.QUAKES_SQL
    + """SELECT area, mag FROM q
WHERE insert_dt >= TIMESTAMP '2024-01-15' AND insert_dt < TIMESTAMP '2024-01-22'
ORDER BY mag DESC, area LIMIT 1"""
)
def strongest_last_week(spark, sf_dir):
    return a.strongest_last_week(i.quakes(spark, sf_dir), i.AS_OF)


@_query(
    i.QUAKES_SQL
    + """SELECT area, mag FROM q WHERE year(insert_dt) = 2024 AND weekofyear(insert_dt) = 3
ORDER BY mag DESC, area LIMIT 1"""
)
def strongest_last_week_compat(spark, sf_dir):
    return a.strongest_last_week(i.quakes(spark, sf_dir), i.AS_OF, compat=True)


@_query(
    i.QUAKES_SQL
    + """SELECT id, mag FROM q
WHERE insert_dt >= TIMESTAMP '2024-01-15' AND insert_dt < TIMESTAMP '2024-01-22'"""
)
def last_week(spark, sf_dir):
    return a.last_week(i.quakes(spark, sf_dir), "insert_dt", i.AS_OF).select("id", "mag")


@_query(i.QUAKES_SQL + f"SELECT DISTINCT area FROM q WHERE mag > {i.HIGH_VALUE}")
def areas_above(spark, sf_dir):
    return a.areas_above(i.quakes(spark, sf_dir), i.HIGH_VALUE)


@_query(i.QUAKES_SQL + "SELECT place, count(mag) AS frequency FROM q GROUP BY place")
def frequency(spark, sf_dir):
    return a.frequency(i.quakes(spark, sf_dir))


@_query(i.QUAKES_SQL + "SELECT place, round(sum(mag), 4) AS intensity FROM q GROUP BY place")
def intensity(spark, sf_dir):
    return _rounded(a.intensity(i.quakes(spark, sf_dir)), "intensity", 4)


@_query(
    i.QUAKES_SQL
    + """SELECT f.place, f.frequency, s.intensity
FROM (SELECT place, count(mag) AS frequency FROM q GROUP BY place) f
JOIN (SELECT place, round(sum(mag), 4) AS intensity FROM q GROUP BY place) s ON f.place = s.place"""
)
def frequency_intensity(spark, sf_dir):
    return _rounded(a.frequency_intensity(i.quakes(spark, sf_dir)), "intensity", 4)


def _answers(df: DataFrame, name: str, number: str | None, digits: int = 4) -> DataFrame:
    """One analysis as rows of a shared shape; without a number, a one per row."""

    def field(col: str) -> Column:
        return F.col(col).cast("string") if col in df.columns else F.lit(None).cast("string")

    return df.select(
        F.lit(name).alias("analysis"),
        *[field(col).alias(col) for col in ("area", "day", "place")],
        F.round((F.col(number) if number else F.lit(1)).cast("double"), digits).alias("number"),
    )


# The number that each analysis answers with, and the SQL of it.
_SUITE = {
    "count_by_area": ("n", "area, NULL, NULL, count(*) FROM q GROUP BY area"),
    "mean_mag_by_area": ("avg_mag", "area, NULL, NULL, avg(mag) FROM q GROUP BY area"),
    "count_by_day": ("n", f"NULL, {_DAY}, NULL, count(*) FROM q GROUP BY {_DAY}"),
    "count_by_day_area": ("n", f"area, {_DAY}, NULL, count(*) FROM q GROUP BY area, {_DAY}"),
    "mean_daily_count": (
        "avg_n",
        f"NULL, NULL, NULL, avg(n) FROM (SELECT count(*) AS n FROM q GROUP BY {_DAY})",
    ),
    "mean_daily_count_per_day": ("avg_n", f"NULL, {_DAY}, NULL, count(*) FROM q GROUP BY {_DAY}"),
    "mean_daily_area_count": (
        "avg_n",
        f"NULL, NULL, NULL, avg(n) FROM (SELECT count(*) AS n FROM q GROUP BY area, {_DAY})",
    ),
    "mean_of_ones_day_area": ("avg_n", f"area, {_DAY}, NULL, 1 FROM q GROUP BY area, {_DAY}"),
    "max_mag_by_area": ("max_mag", "area, NULL, NULL, max(mag) FROM q GROUP BY area"),
    "top_area": (
        "max_mag",
        "area, NULL, NULL, mag FROM (SELECT area, mag FROM q ORDER BY mag DESC, area LIMIT 1)",
    ),
    "strongest_last_week": (
        "mag",
        """area, NULL, NULL, mag FROM (SELECT area, mag FROM q
  WHERE insert_dt >= TIMESTAMP '2024-01-15' AND insert_dt < TIMESTAMP '2024-01-22'
  ORDER BY mag DESC, area LIMIT 1)""",
    ),
    "areas_above": (None, f"area, NULL, NULL, 1 FROM q WHERE mag > {i.HIGH_VALUE} GROUP BY area"),
    "frequency": ("frequency", "NULL, NULL, place, count(mag) FROM q GROUP BY place"),
    "intensity": ("intensity", "NULL, NULL, place, sum(mag) FROM q GROUP BY place"),
    "frequency_intensity": ("intensity", "NULL, NULL, place, sum(mag) FROM q GROUP BY place"),
}

_SUITE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}', {sql}" for name, (_, sql) in _SUITE.items()
)


@_query(
    f"""{i.QUAKES_SQL}, answers(analysis, area, day, place, number) AS (
{_SUITE_SQL}
)
SELECT analysis, area, day, place, round(CAST(number AS DOUBLE), 4) AS number FROM answers"""
)
def analysis_suite(spark, sf_dir):
    answers = analyses(i.quakes(spark, sf_dir), i.AS_OF, threshold=i.HIGH_VALUE)
    rows = [_answers(answers[name], name, number) for name, (number, _) in _SUITE.items()]
    union = rows[0]
    for more in rows[1:]:
        union = union.unionByName(more)
    return union


# ---- functions -------------------------------------------------------------


@_query(
    i.QUAKES_SQL + "SELECT id, regexp_extract(place, 'of (.+)$', 1) AS area FROM q",
    name="area_tail",
)
def _area_tail(spark, sf_dir):
    return i.quakes(spark, sf_dir).select("id", area_tail("place").alias("area"))


@_query(
    i.QUAKES_SQL
    + "SELECT id, trim(array_to_string(string_split(place, ',')[2:], ', ')) AS area FROM q",
    name="area_comma",
)
def _area_comma(spark, sf_dir):
    return i.quakes(spark, sf_dir).select("id", area_comma("place").alias("area"))


def _epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = i.utc_millis("ts").cast("string").alias("millis")
    return i.events(spark, sf_dir).select(F.col("event_id").alias("id"), millis)


@_query("SELECT event_id AS id, date_trunc('second', ts) AS time FROM events")
def epoch_to_ts(spark, sf_dir):
    return _epochs(spark, sf_dir).select("id", naive_utc(epoch_ms_to_ts("millis")).alias("time"))


@_query("SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events")
def epoch_to_str(spark, sf_dir):
    return _epochs(spark, sf_dir).select("id", epoch_ms_to_str("millis").alias("time"))


# ---- landing and flattening ------------------------------------------------


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(i.collections(spark, sf_dir), load_ts=i.LOAD_TS)


@_query(i.SILVER_SQL)
def flatten_collections(spark, sf_dir):
    return i.silver_view(_typed(spark, sf_dir))


@_query(i.SILVER_TEXT_SQL)
def flatten_text_variant(spark, sf_dir):
    rows = silver_rows(i.collections(spark, sf_dir), variant="text", load_ts=i.LOAD_TS)
    return i.silver_text_view(rows)


@_query(i.SILVER_SQL)
def flatten_feature_text(spark, sf_dir):
    single = i.single_features(spark, sf_dir)
    text = single.select(F.to_json(F.struct(*single.columns)).alias("json"))
    return i.silver_view(transform(flatten(parse_feature(text, "json")), i.LOAD_TS))


@_query(i.SILVER_SQL)
def flatten_roundtrip(spark, sf_dir):
    path = landing_path(scratch_path(spark, "landing"), "daily", i.LOAD_DATE)
    write_landing(i.collections(spark, sf_dir), path)
    return i.silver_view(silver_rows(scan_geojson(spark, path), load_ts=i.LOAD_TS))


@_query(i.SILVER_SQL)
def features_roundtrip(spark, sf_dir):
    path = landing_path(scratch_path(spark, "landing"), "historical", i.LOAD_DATE, "dated")
    write_landing(i.single_features(spark, sf_dir), path)
    rows = silver_rows(scan_features(spark, path), layout="features", load_ts=i.LOAD_TS)
    return i.silver_view(rows)


# ---- silver and table sinks ------------------------------------------------


@_query(i.SILVER_TEXT_SQL)
def silver_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    rows = silver_rows(i.collections(spark, sf_dir), variant="text", load_ts=i.LOAD_TS)
    write_silver(rows, path, "overwrite", variant="text")
    return i.silver_text_view(scan_silver(spark, path, "text", partitioned=False))


@_query(f"{i.SILVER_SQL} UNION ALL SELECT {i.SILVER_COLUMNS_SQL} FROM silver")
def silver_append(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_silver(_typed(spark, sf_dir), path, "append")
    write_silver(_typed(spark, sf_dir), path, "append")
    return i.silver_view(scan_silver(spark, path, partitioned=False))


@_query(i.SILVER_SQL)
def silver_overwrite(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_silver(_typed(spark, sf_dir), path, "overwrite")
    write_silver(_typed(spark, sf_dir), path, "overwrite")
    return i.silver_view(scan_silver(spark, path, partitioned=False))


# Rows that are read once do not pay for a dictionary.
_ONCE = {"parquet.enable.dictionary": "false"}


def _through_table(spark: SparkSession, fill, view=lambda rows: rows) -> DataFrame:
    """What ``view`` makes of the rows of a table that ``fill`` writes; it leaves no name behind."""
    name = f"tremor_check_{uuid4().hex}"
    try:
        fill(name, scratch_path(spark, "table"))
        return stored(view(scan_table(spark, name)), "table-rows", **_ONCE)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@_query(i.QUAKES_SQL + "SELECT * FROM q UNION ALL SELECT * FROM q")
def table_append(spark, sf_dir):
    def fill(name, path):
        write_table(i.quakes(spark, sf_dir), name, "append", path=path)
        write_table(i.quakes(spark, sf_dir), name, "append")

    return _through_table(spark, fill)


@_query(i.QUAKES_SQL + f"SELECT * FROM q WHERE mag > {i.HIGH_VALUE}")
def table_overwrite(spark, sf_dir):
    def fill(name, path):
        rows = i.quakes(spark, sf_dir)
        write_table(rows, name, "overwrite", path=path)
        write_table(a.above(rows, "mag", i.HIGH_VALUE), name, "overwrite", path=path)

    return _through_table(spark, fill)


# ---- loads -----------------------------------------------------------------


def _loaded_sql(*feeds: str) -> str:
    parts = [
        f"SELECT {i.SILVER_COLUMNS_SQL}, '{feed}' AS feed, '{i.LOAD_DATE}' AS load_date FROM silver"
        for feed in feeds
    ]
    return i.SILVER_CTE + "\nUNION ALL\n".join(parts)


def _loaded_view(rows: DataFrame) -> DataFrame:
    return i.silver_view(
        rows.withColumn("load_date", F.col("load_date").cast("string")), "feed", "load_date"
    )


# A compressed file is read by one task, so each has some 5 MB of JSON.
_LANDED = {"compression": "lz4", "lines_per_file": 5_000}


def _land(spark: SparkSession, sf_dir: str, *paths: str) -> None:
    """Land the events in each folder: in the first one from the table, in others the same lines."""
    write_landing(i.collections(spark, sf_dir, spread=True), paths[0], **_LANDED)
    for path in paths[1:]:
        _land_again(spark, paths[0], path)


def _land_again(spark: SparkSession, landed: str, path: str) -> None:
    """Land the lines of a folder in another one."""
    copy = spark.read.text(landed).write.option("compression", _LANDED["compression"])
    copy.option("maxRecordsPerFile", _LANDED["lines_per_file"]).text(path)


def _load_runs(spark: SparkSession, sf_dir: str, runs: list[tuple[str, str | None]]) -> DataFrame:
    """Land the events for each feed, load in the given order, return the table."""
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    _land(spark, sf_dir, *(landing_path(landing, feed, i.LOAD_DATE) for feed in {feed for feed, _ in runs}))

    def fill(name, path):
        for feed, mode in runs:
            load(
                spark, feed, i.LOAD_DATE, landing=landing, silver=silver, table=name,
                table_path=path, mode=mode, load_ts=i.LOAD_TS,
            )

    return _through_table(spark, fill, _loaded_view)


@_query(_loaded_sql("daily", "daily"))
def load_daily(spark, sf_dir):
    return _load_runs(spark, sf_dir, [("daily", None), ("daily", None)])


@_query(_loaded_sql("historical", "daily"))
def load_historical(spark, sf_dir):
    return _load_runs(spark, sf_dir, [("daily", None), ("historical", None), ("daily", None)])


@_query(_loaded_sql("daily"))
def load_replacing_partition(spark, sf_dir):
    return _load_runs(spark, sf_dir, [("daily", None), ("daily", "replace_partition")])


# The stream stamps its own load instants, so they are left out here.
_UNSTAMPED = "SELECT * EXCLUDE (loaded_micros) FROM"


@_query(f"{_UNSTAMPED} ({_loaded_sql('daily', 'historical')})")
def load_stream(spark, sf_dir):
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    checkpoint = scratch_path(spark, "checkpoint")
    daily, historical = (landing_path(landing, feed, i.LOAD_DATE) for feed in ("daily", "historical"))
    for land in (lambda: _land(spark, sf_dir, daily), lambda: _land_again(spark, daily, historical)):
        land()
        # The second run finds the first feed loaded already and takes the other.
        load_incremental(spark, landing, silver, checkpoint).awaitTermination()
    return _loaded_view(scan_silver(spark, silver)).drop("loaded_micros")


# ---- orders ----------------------------------------------------------------


def _valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = scan_completed_orders(i.orders(spark, sf_dir), i.ORDER_STATUS)
    return a.above(completed, "order_value", i.MIN_PRICE)


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(o.sum_per_user(_valued(spark, sf_dir)), "total", 2)


@_query(
    f"""SELECT o_custkey AS user_id, o_orderkey AS order_id, o_totalprice AS order_value
FROM orders WHERE o_orderstatus = '{i.ORDER_STATUS}'"""
)
def completed_orders(spark, sf_dir):
    return scan_completed_orders(i.orders(spark, sf_dir), i.ORDER_STATUS)


@_query(i.ORDERS_CTE + "SELECT round(avg(order_value), 4) AS avg_value FROM valued")
def mean_order_value(spark, sf_dir):
    return _rounded(o.mean_order_value(_valued(spark, sf_dir)), "avg_value", 4)


@_query(i.ORDERS_CTE + "SELECT user_id, total FROM totals")
def sum_per_user(spark, sf_dir):
    return _totals(spark, sf_dir)


@_query(i.ORDERS_CTE + f"SELECT user_id, total FROM totals WHERE total > {i.LARGE_TOTAL}")
def large_orders(spark, sf_dir):
    return o.split_by_threshold(_totals(spark, sf_dir), "total", i.LARGE_TOTAL)[0]


@_query(i.ORDERS_CTE + f"SELECT user_id, total FROM totals WHERE total <= {i.LARGE_TOTAL}")
def small_orders(spark, sf_dir):
    return o.split_by_threshold(_totals(spark, sf_dir), "total", i.LARGE_TOTAL)[1]


@_query(
    i.ORDERS_CTE
    + "SELECT '(' || user_id || ', ' || CAST(total AS VARCHAR) || ')' AS line FROM totals"
)
def pairs_text(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    write_pairs_text(_totals(spark, sf_dir), path, "user_id", "total")
    return spark.read.text(path).select(F.col("value").alias("line"))


@_query(
    i.ORDERS_CTE
    + f"""SELECT 'mean' AS part, CAST(NULL AS BIGINT) AS user_id, round(avg(order_value), 2) AS value FROM valued
UNION ALL
SELECT CASE WHEN total > {i.LARGE_TOTAL} THEN 'large' ELSE 'small' END, user_id, total FROM totals"""
)
def orders_report(spark, sf_dir):
    report = order_report(
        i.orders(spark, sf_dir),
        scratch_path(spark, "orders"),
        status=i.ORDER_STATUS,
        min_value=i.MIN_PRICE,
        large_total=i.LARGE_TOTAL,
    )

    def part(name: str, rows: DataFrame, user: Column, value: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("part"), user.cast("bigint").alias("user_id"), F.round(value, 2).alias("value")
        )

    return (
        part("mean", report.mean_value, F.lit(None), "avg_value")
        .unionByName(part("large", report.large_orders, F.col("user_id"), "total"))
        .unionByName(part("small", report.small_orders, F.col("user_id"), "total"))
    )


# ---- documents that cannot be read, days that are replaced -------------------

_NEXT = i.LOAD_DATE.replace(day=i.LOAD_DATE.day + 1)
# One text for each event that is no document, beside the documents.
_BAD_SQL = "SELECT 'rejected' AS kind, '{\"features\": [ ' || event_id AS text FROM events"
_KEPT_SQL = f"{i.SILVER_CTE}SELECT 'kept' AS kind, id AS text FROM silver UNION ALL {_BAD_SQL}"


def _land_bad(spark: SparkSession, sf_dir: str, path: str) -> None:
    text = F.concat(F.lit('{"features": [ '), F.col("event_id").cast("string"))
    i.events(spark, sf_dir, spread=True).select(text.alias("value")).write.mode("append").text(path)


def _kept_and_rejected(spark: SparkSession, silver: str, rejects: str) -> DataFrame:
    kept = scan_silver(spark, silver).select(F.lit("kept").alias("kind"), F.col("id").alias("text"))
    bad = spark.read.parquet(rejects).select(F.lit("rejected").alias("kind"), "text")
    return kept.unionByName(bad)


def _load_with_bad(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    path = landing_path(landing, "daily", i.LOAD_DATE)
    whole = layout == "collections"
    write_landing((i.collections if whole else i.single_features)(spark, sf_dir, spread=True), path, **_LANDED)
    _land_bad(spark, sf_dir, path)
    done = load(
        spark, "daily", i.LOAD_DATE, landing=landing, silver=silver, layout=layout, keep_good=True
    )
    return _kept_and_rejected(spark, silver, done.rejects)


@_query(_KEPT_SQL)
def load_with_bad_documents(spark, sf_dir):
    return _load_with_bad(spark, sf_dir, "collections")


@_query(_KEPT_SQL)
def load_with_bad_lines(spark, sf_dir):
    return _load_with_bad(spark, sf_dir, "features")


@_query(_KEPT_SQL)
def load_stream_with_bad_documents(spark, sf_dir):
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    path = landing_path(landing, "daily", i.LOAD_DATE)
    _land(spark, sf_dir, path)
    _land_bad(spark, sf_dir, path)
    rejects = scratch_path(spark, "rejects")
    load_incremental(
        spark, landing, silver, scratch_path(spark, "checkpoint"), rejects=rejects, keep_good=True
    ).awaitTermination()
    return _kept_and_rejected(spark, silver, rejects)


@_query(f"{i.SILVER_CTE}SELECT {i.SILVER_COLUMNS_SQL}, 'daily' AS feed, '{_NEXT}' AS load_date FROM silver")
def load_replacing_with_nothing(spark, sf_dir):
    """Two days are loaded; the first is landed again without features, and replaced."""
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    first, second = (landing_path(landing, "daily", day) for day in (i.LOAD_DATE, _NEXT))
    empty = i.collections(spark, sf_dir, spread=True).withColumn("features", F.slice("features", 1, 0))

    def fill(name, path):
        for day, land in (
            (i.LOAD_DATE, lambda: _land(spark, sf_dir, first)),
            (_NEXT, lambda: _land_again(spark, first, second)),
            (i.LOAD_DATE, lambda: write_landing(empty, first, **_LANDED)),
        ):
            land()
            load(
                spark, "daily", day, landing=landing, silver=silver, table=name, table_path=path,
                mode="replace_partition", load_ts=i.LOAD_TS,
            )

    return _through_table(spark, fill, _loaded_view)


@_query(_loaded_sql("daily"))
def load_large_collections(spark, sf_dir):
    """A document for each kind of event and hour, of a thousand events at most."""
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    hourly = (
        i.features(spark, sf_dir)
        .withColumn("hour", F.col("whole.properties.time").substr(1, 7))
        # Kinds and hours stay as many while events grow in number.
        .withColumn("slice", (F.col("whole.id").cast("bigint") / 1000).cast("bigint"))
        .groupBy("whole.properties.net", "hour", "slice")
        .agg(F.flatten(F.collect_list(F.array("whole", "poor"))).alias("features"))
        .select(F.lit("FeatureCollection").alias("type"), "features")
    )
    write_landing(hourly, landing_path(landing, "daily", i.LOAD_DATE))
    load(spark, "daily", i.LOAD_DATE, landing=landing, silver=silver, load_ts=i.LOAD_TS)
    return _loaded_view(scan_silver(spark, silver))


@_query(_loaded_sql("daily", "historical"))
def load_stream_table(spark, sf_dir):
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")

    def fill(name, path):
        _land(spark, sf_dir, *(landing_path(landing, feed, i.LOAD_DATE) for feed in ("daily", "historical")))
        load_incremental(
            spark, landing, silver, scratch_path(spark, "checkpoint"), table=name,
            table_path=path, load_ts=i.LOAD_TS,
        ).awaitTermination()

    return _through_table(spark, fill, _loaded_view)


# ---- instants with a zone, the text variant, partitions, large numbers -------


def _zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = F.timestamp_millis(i.utc_millis("insert_dt"))
    return i.quakes(spark, sf_dir).withColumn("insert_dt", instant)


@_query(i.QUAKES_SQL + f"SELECT {_DAY} AS day, count(*) AS n FROM q GROUP BY 1")
def count_by_day_zoned(spark, sf_dir):
    return _day_text(a.count_by(a.with_day(_zoned(spark, sf_dir), "insert_dt"), "day"))


_LAST_WEEK_SQL = i.QUAKES_SQL + """SELECT id, mag FROM q
WHERE insert_dt >= TIMESTAMP '2024-01-15' AND insert_dt < TIMESTAMP '2024-01-22'"""


@_query(_LAST_WEEK_SQL)
def last_week_zoned(spark, sf_dir):
    return a.last_week(_zoned(spark, sf_dir), "insert_dt", i.AS_OF).select("id", "mag")


@_query(_LAST_WEEK_SQL)
def last_week_partitioned(spark, sf_dir):
    """From folders by load, a third of them landed a month before and a third two months before.

    The days in each folder are kept when it is written; only folders of that week are read.
    """
    path, kept = scratch_path(spark, "by-load"), scratch_path(spark, "zones")
    late = (F.col("id") % 3 * 30).cast("int")
    rows = a.with_day(i.quakes(spark, sf_dir), "insert_dt").withColumn(
        "load_id", F.concat(F.date_sub("day", late).cast("string"), F.lit("-"), late.cast("string"))
    )
    rows.drop("day").write.partitionBy("load_id").parquet(path)
    a.folder_zones(rows, "load_id", "insert_dt").write.parquet(kept)
    table = spark.read.parquet(path)
    rows = a.last_week(table, "insert_dt", i.AS_OF, partition="load_id", zones=spark.read.parquet(kept))
    return rows.select("id", "mag")


_TEXT_SQL = f"""{i.SILVER_CTE}, q AS (
  SELECT mag, area_comma AS area, place, TIMESTAMP '{i.LOAD_TS:%Y-%m-%d %H:%M:%S}' AS insert_dt FROM silver
), answers(analysis, area, day, place, number) AS (
""" + "\nUNION ALL\n".join(
    f"SELECT '{name}', {sql.replace('2024-01-15', '2024-01-29').replace('2024-01-22', '2024-02-05')}"
    for name, (_, sql) in _SUITE.items()
) + "\n) SELECT analysis, area, day, place, round(CAST(number AS DOUBLE), 8) AS number FROM answers"


@_query(_TEXT_SQL)
def load_text_variant(spark, sf_dir):
    """All analyses over a loaded table of the text variant."""
    landing, silver = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    _land(spark, sf_dir, landing_path(landing, "daily", i.LOAD_DATE))

    def fill(name, path):
        load(
            spark, "daily", i.LOAD_DATE, landing=landing, silver=silver, table=name,
            table_path=path, variant="text", load_ts=i.LOAD_TS,
        )

    answers = analyses(
        _through_table(spark, fill),
        i.LOAD_DATE.replace(month=2, day=7),
        threshold=i.HIGH_VALUE,
        **schema.ANALYSIS_COLUMNS["text"],
    )
    parts = [_answers(answers[name], name, number, 8) for name, (number, _) in _SUITE.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@_query(i.ORDERS_CTE + "SELECT '(' || user_id || ', ' || CAST(round(total * 100, 1) AS VARCHAR) || ')' AS line FROM totals")
def pairs_text_large(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    totals = _totals(spark, sf_dir).withColumn("total", F.round(F.col("total") * 100, 1))
    write_pairs_text(totals, path, "user_id", "total")
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---- loads that are one commit, and what is kept of each ----------------------


def _land_in_turn(spark: SparkSession, sf_dir: str, paths: list[str]) -> Iterator[None]:
    """Land the events in each folder, in the order in which they are read; a step for each reading.

    Lines that no later step reads become those of the next new folder, so that no more of them lie
    there at once than are still to be read. After the last step none are left.
    """
    lying: list[str] = []
    for at, path in enumerate(paths):
        if path not in lying:
            done = [p for p in lying if p not in paths[at:]]
            if done:
                move_folder(spark, done[0], path)
                lying.remove(done[0])
            elif lying:
                _land_again(spark, lying[0], path)
            else:
                _land(spark, sf_dir, path)
            lying.append(path)
        yield
    for path in lying:
        remove(spark, path)


def _journaled(spark: SparkSession, sf_dir: str, runs: list[tuple], read) -> DataFrame:
    """Land the events for each feed and day, load in the given order, return what ``read`` gives.

    A run is a feed, a day, a mode and a load instant. Of what was written the result alone is kept.
    """
    name = f"tremor_check_{uuid4().hex}"
    with ExitStack() as kept:
        landing, silver, journal, shares, table = (
            kept.enter_context(scratch(spark, layer))
            for layer in ("landing", "silver", "journal", "shares", "shares-table")
        )
        kept.callback(spark.sql, f"DROP TABLE IF EXISTS {name}")
        landings = _land_in_turn(spark, sf_dir, [landing_path(landing, feed, day) for feed, day, *_ in runs])
        for (feed, day, mode, at), _ in zip(runs, landings, strict=True):
            load(
                spark, feed, day, landing=landing, silver=silver, table=name, mode=mode, load_ts=at,
                table_path=table, journal=journal, aggregates=shares,
            )
        return stored(read(journal, silver, name, shares), "journaled", compression="zstd", **_ONCE)


_LAYERS_SQL = i.SILVER_CTE + "\nUNION ALL\n".join(
    f"SELECT {i.SILVER_COLUMNS_SQL}, '{feed}' AS feed, '{day}' AS load_date, '{layer}' AS layer FROM silver"
    for layer, feed, day in (
        ("silver", "daily", i.LOAD_DATE),
        ("silver", "daily", i.LOAD_DATE),
        ("silver", "historical", i.LOAD_DATE),
        ("silver", "daily", _NEXT),
        ("table", "historical", i.LOAD_DATE),
        ("table", "daily", _NEXT),
    )
)


@_query(_LAYERS_SQL)
def load_committed(spark, sf_dir):
    """What counts in silver and in the table after loads that add, and that replace others."""
    runs = [
        ("daily", i.LOAD_DATE, "append", i.LOAD_TS),
        ("daily", i.LOAD_DATE, "append", i.LOAD_TS),
        ("historical", i.LOAD_DATE, "overwrite", i.LOAD_TS),
        ("daily", _NEXT, "append", i.LOAD_TS),
        ("daily", _NEXT, "replace_partition", i.LOAD_TS),
    ]

    def read(journal, silver, name, _):
        layers = [
            _loaded_view(rows).withColumn("layer", F.lit(layer))
            for layer, rows in (
                ("silver", scan_loads(spark, journal, silver=silver)),
                ("table", scan_loads(spark, journal, table=name)),
            )
        ]
        return layers[0].unionByName(layers[1])

    return _journaled(spark, sf_dir, runs, read)


_EARLIER, _LATER = (i.LOAD_TS.replace(day=d) for d in (17, 25))
_SHARES_RUNS = [
    ("historical", i.LOAD_DATE, "overwrite", i.LOAD_TS),
    ("daily", i.LOAD_DATE, "append", i.LOAD_TS),
    ("historical", i.LOAD_DATE, "overwrite", _EARLIER),
    ("daily", i.LOAD_DATE, "append", _EARLIER),
    ("daily", _NEXT, "append", i.LOAD_TS),
    ("daily", _NEXT, "replace_partition", _LATER),
]
_SHARES_SQL = f"""{i.SILVER_CTE}, q AS (
  SELECT mag, area_tail AS area, place, loaded_at AS insert_dt FROM silver,
    (SELECT unnest([{", ".join(f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'" for t in (_EARLIER, _EARLIER, _LATER))}]) AS loaded_at)
), answers(analysis, area, day, place, number) AS (
{_SUITE_SQL}
) SELECT analysis, area, day, place, round(CAST(number AS DOUBLE), 8) AS number FROM answers"""


@_query(_SHARES_SQL)
def load_suite_of_shares(spark, sf_dir):
    """All analyses from the shares that each load kept, after append, overwrite and replace."""

    def read(journal, _, name, shares):
        answers = analyses_of_loads(spark, journal, name, shares, i.AS_OF, threshold=i.HIGH_VALUE)
        parts = [_answers(answers[key], key, number, 8) for key, (number, _) in _SUITE.items()]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    return _journaled(spark, sf_dir, _SHARES_RUNS, read)


@_query(
    f"""{i.SILVER_CTE}SELECT id, mag FROM silver UNION ALL SELECT id, mag FROM silver"""
)
def load_week_of_late_loads(spark, sf_dir):
    """Last week's rows of a table, from the folders whose load instants the journal puts there."""
    runs = [
        ("daily", day, "append", at)
        for day in (i.LOAD_DATE.replace(month=1, day=2), i.LOAD_DATE.replace(year=2023, month=11))
        for at in (_EARLIER, _LATER)
    ]

    def read(journal, _, name, __):
        found = zones(spark, Journal(spark, journal).table_loads(name))
        rows = scan_loads(spark, journal, table=name)
        return a.last_week(rows, "insert_dt", i.AS_OF, partition="load_id", zones=found).select("id", "mag")

    return _journaled(spark, sf_dir, runs, read)


# ---- totals by place -------------------------------------------------------


def _by_weekday(spark: SparkSession, sf_dir: str, days: str) -> DataFrame:
    return i.quakes(spark, sf_dir).where(F.expr(f"dayofweek(insert_dt) {days}"))


def _with_place_totals(spark: SparkSession, sf_dir: str, read) -> DataFrame:
    """What ``read`` makes of a table with two loads that count, after one repeated and one undone."""
    name = f"tremor_check_{uuid4().hex}"

    def write(days: str, load_id: str) -> None:
        rows = _by_weekday(spark, sf_dir, days)
        write_place_totals(rows, name, load_id, buckets=8, path=scratch_path(spark, "places"))

    try:
        for days, load_id in (("< 3", "a"), ("IN (1, 6)", "b"), (">= 3", "b"), ("> 0", "undone")):
            write(days, load_id)
        drop_place_totals(spark, name, "undone")
        return stored(read(name), "places")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@_query(_ORACLE["frequency_intensity"])
def frequency_intensity_of_places(spark, sf_dir):
    """Frequency and intensity from a table laid out by place, which two loads have filled."""

    def read(name):
        return _rounded(frequency_intensity_of_totals(scan_place_totals(spark, name)), "intensity", 4)

    return _with_place_totals(spark, sf_dir, read)


@_query(
    i.QUAKES_SQL
    + """, t AS (
  SELECT place, dayofweek(insert_dt) < 2 AS early, count(mag) AS frequency, round(sum(mag), 4) AS intensity
  FROM q WHERE place IS NOT NULL GROUP BY ALL
)
SELECT place, b.frequency AS frequency_before, b.intensity AS intensity_before,
       a.frequency AS frequency_after, a.intensity AS intensity_after
FROM (SELECT * FROM t WHERE early) b JOIN (SELECT * FROM t WHERE NOT early) a USING (place)"""
)
def change_by_place(spark, sf_dir):
    """Totals of two loads side by side, joined where they lie."""

    def read(name):
        a_, b_ = (scan_place_totals(spark, name, [load_id]) for load_id in ("a", "b"))
        both = change_of_places(a_, b_)
        return _rounded(_rounded(both, "intensity_before", 4), "intensity_after", 4)

    return _with_place_totals(spark, sf_dir, read)


# ---- whole documents -----------------------------------------------------------


def _pretty(documents: DataFrame) -> DataFrame:
    text = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    return documents.select(text.alias("value"))


@_query(i.SILVER_SQL)
def whole_documents(spark, sf_dir):
    """Files of one pretty-printed collection each, of some hundred events."""
    path = scratch_path(spark, "landing")
    some = (
        i.features(spark, sf_dir)
        .withColumn("file", (F.col("whole.id").cast("bigint") / 200).cast("bigint"))
        .groupBy("file")
        .agg(F.flatten(F.collect_list(F.array("whole", "poor"))).alias("features"))
        .select(F.lit("FeatureCollection").alias("type"), "features")
    )
    _pretty(some).write.option("maxRecordsPerFile", 1).text(path)
    return i.silver_view(silver_rows(scan_geojson(spark, path, multi_line=True), load_ts=i.LOAD_TS))


_HEAD, _TAIL = '{"type": "FeatureCollection", "title": "a \\"[{\\\\", "features" : [', '], "bbox": [[{"a": {}}]]}'


def _write_document(texts: DataFrame, path: str, line_end: str) -> None:
    """Write features, given as text in ``value``, as one document in one file.

    One task writes it, and holds a batch at a time: it gets the lines in any order.
    """
    head, tail = _HEAD, _TAIL

    def framed(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def lines(values):
            return pa.RecordBatch.from_arrays([values], ["value"])

        yield lines(pa.array([head]))
        comma = ""
        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).cast(pa.string())
                yield lines(pc.binary_join_element_wise(comma, values.slice(0, 1), ""))
                yield lines(pc.binary_join_element_wise(",", values.slice(1), ""))
                comma = ","
        yield lines(pa.array([tail]))

    # Reading the file is what this is about.
    texts.repartition(1).mapInArrow(framed, "value string").write.option("lineSep", line_end).text(path)


def _one_document(spark: SparkSession, sf_dir: str, line_end: str, pretty: bool) -> DataFrame:
    """All events as one document, which is then read in many ranges: seven, or more of a bounded size."""
    path = scratch_path(spark, "document")
    single = i.single_features(spark, sf_dir)
    texts = _pretty(single.select("type", "properties", "geometry", "id")) if pretty else single.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
    _write_document(texts, path, line_end)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    # A task holds a range, so that a seventh of a large document would be too much.
    landed = scan_documents(spark, path, min(-(-size // 7), RANGE_BYTES))
    return i.silver_view(silver_rows(landed, layout="features", load_ts=i.LOAD_TS))


@_query(i.SILVER_SQL)
def split_document_pretty(spark, sf_dir):
    return _one_document(spark, sf_dir, "\n", True)


@_query(i.SILVER_SQL)
def split_document_line(spark, sf_dir):
    return _one_document(spark, sf_dir, " ", False)
