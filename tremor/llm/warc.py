r"""Not-modified revisit resolution over WARC records.

A revisit record of the server-not-modified profile says that a page had not changed; what the
page was then stands in the latest earlier full response for the same canonical URL. Records
are put in time order for each URL and every revisit takes the last response before it (an
as-of join by a window). Its validators must agree: the entity tag by weak comparison if the
revisit has one, otherwise the modification date. The answer to a resolved revisit has the
response's status and payload and its headers, updated by those headers of the revisit that a
304 may change: all but fields of the connection and fields that describe the stored body.

Records of one URL are split by time into periods of ``period`` seconds: the last response of
each period is carried over to the periods after it by a window over periods, and only records
of one period meet in one task. A URL with a third of all rows is thus spread over its periods.
Payloads stay out of both windows; they are looked up by the record that was found, where
they are wanted.

A revisit without URL or date resolves to nothing; so does one without validators. Of several
responses of one instant the one with the largest record id counts; a response of the same
instant as a revisit is not earlier. Repeated rows resolve alike. Null headers are no headers.
Columns other than those named are not kept. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"

# Fields of one connection, and fields that describe the stored body.
KEPT_FIELDS = (
    "connection",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authentication-info",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
)

# Query parameters that only track a visit.
TRACKING = r"(utm_[a-z]+|gclid|fbclid|ref)"


def canonical_url(url: Column) -> Column:
    """One spelling for the URLs of a page.

    The scheme, a ``www.`` in front, default ports, fragments, tracking parameters and a slash
    at the end are left out; the host is in lower case.
    """
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_replace(rest, rf"([?&]){TRACKING}=[^&]*", "$1")
    rest = F.regexp_replace(rest, r"&&+", "&")
    rest = F.regexp_replace(F.regexp_replace(rest, r"\?&", "?"), r"[?&]+$", "")
    return F.concat(host, F.regexp_replace(rest, r"/$", ""))


def weak_tag(tag: Column) -> Column:
    """An entity tag without the sign that it is weak."""
    return F.regexp_replace(F.trim(tag), r"^[Ww]/", "")


def _field(headers: Column, name: str) -> Column:
    return F.element_at(headers, F.lit(name))


def _lower_fields(headers: Column) -> Column:
    """Names in lower case; of a name that occurs twice the last value counts."""
    entries = F.coalesce(F.map_entries(headers), F.expr("array()"))
    named = F.transform(
        entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    last = F.filter(
        named,
        lambda e, i: ~F.exists(
            F.transform(named, lambda x, j: F.struct(x["key"].alias("key"), j.alias("at"))),
            lambda x: (x["key"] == e["key"]) & (x["at"] > i),
        ),
    )
    return F.map_from_entries(last)


def merge_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with those of the 304 in their place, as far as it may change them."""
    allowed = F.map_filter(fresh, lambda name, _: ~name.isin(*KEPT_FIELDS))
    old = F.map_filter(stored, lambda name, _: ~F.map_contains_key(allowed, name))
    merged = F.map_concat(old, allowed)
    return F.map_from_entries(F.array_sort(F.map_entries(merged)))


def resolve_revisits(records: DataFrame, period: int = 86_400) -> DataFrame:
    """One row for each revisit.

    ``records`` has record_id, record_type, url, date (timestamp), profile, status and headers
    (a map). Columns: record_id, url, date, resolved_id (null if nothing fits), outcome
    (``resolved``, ``no response``, ``validators differ`` or ``no validators``), status and
    headers as they were at that time.
    """
    keyed = records.select(
        "record_id",
        "record_type",
        "url",
        "date",
        "profile",
        "status",
        _lower_fields(F.col("headers")).alias("headers"),
        canonical_url(F.col("url")).alias("key"),
        F.floor(F.unix_micros("date") / F.lit(period * 1_000_000)).alias("period"),
    ).filter(
        (F.col("record_type") == "response")
        | ((F.col("record_type") == "revisit") & (F.col("profile") == PROFILE))
    )
    full = F.when(
        F.col("record_type") == "response",
        F.struct("date", "record_id", "status", "headers"),
    )
    # The last response of each URL and period; at most one row for each of them.
    rank = F.struct("date", "record_id")
    ends = (
        keyed.filter(F.col("record_type") == "response")
        .filter(F.col("key").isNotNull() & F.col("date").isNotNull())
        .groupBy("key", "period")
        .agg(F.max_by(F.struct("date", "record_id", "status", "headers"), rank).alias("end"))
    )
    periods = keyed.filter(F.col("record_type") == "revisit").select("key", "period").distinct()
    before = Window.partitionBy("key").orderBy("period").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        periods.join(ends, ["key", "period"], "full")
        .withColumn("carried", F.last("end", ignorenulls=True).over(before))
        .select("key", "period", "carried")
    )
    earlier = Window.partitionBy("key", "period").orderBy(
        F.unix_micros("date"), F.col("record_type").desc(), "record_id"
    ).rowsBetween(Window.unboundedPreceding, -1)
    # At one instant revisits sort before responses, which are not earlier than they.
    found = (
        keyed.withColumn("inside", F.last(full, ignorenulls=True).over(earlier))
        .filter(F.col("record_type") == "revisit")
        .join(carried, ["key", "period"], "left")
        .withColumn("found", F.coalesce("inside", "carried"))
        .withColumn("found", F.when(F.col("key").isNotNull() & F.col("date").isNotNull(), F.col("found")))
    )
    tag, stored_tag = _field(F.col("headers"), "etag"), _field(F.col("found.headers"), "etag")
    seen = _field(F.col("headers"), "last-modified")
    stored_seen = _field(F.col("found.headers"), "last-modified")
    fits = F.when(tag.isNotNull(), weak_tag(tag) == weak_tag(stored_tag)).otherwise(
        seen == stored_seen
    )
    outcome = (
        F.when(F.col("found").isNull(), "no response")
        .when(tag.isNull() & seen.isNull(), "no validators")
        .when(F.coalesce(fits, F.lit(False)), "resolved")
        .otherwise("validators differ")
    )
    settled = found.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return settled.select(
        "record_id",
        "url",
        "date",
        F.when(good, F.col("found.record_id")).alias("resolved_id"),
        "outcome",
        F.when(good, F.col("found.status")).alias("status"),
        F.when(good, merge_headers(F.col("found.headers"), F.col("headers"))).alias("headers"),
    )


def with_payload(resolved: DataFrame, records: DataFrame, payload: str = "payload") -> DataFrame:
    """Add the payload of the response that each revisit was resolved to."""
    bodies = records.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("resolved_id"), F.col(payload)
    )
    return resolved.join(bodies, "resolved_id", "left")
