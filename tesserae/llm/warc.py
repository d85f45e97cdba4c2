"""Not-modified revisits of web archives: an as-of join to the latest earlier full response of the same URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace

# fixed values: fields that a not-modified answer must not change in a stored response (hop-by-hop or of the body)
KEPT_FIELDS = (
    "connection content-encoding content-length content-md5 content-range content-type digest keep-alive "
    "proxy-authenticate proxy-authentication-info proxy-authorization te trailer transfer-encoding upgrade"
).split()
# fixed values: query parameters that name a visit, not a page
TRACKING = "utm_[a-z]+|fbclid|gclid|msclkid|sessionid|ref"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment, tracking parameters and closing slash.

    The host is lower-cased and remaining parameters are sorted; a null or hostless URL gives null.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(bare, "^(?i)https?://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, "^([^/?]*)", 1), ":(80|443)$", ""))
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})="))), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _names(fields: Column) -> Column:
    return F.transform(fields, lambda h: F.lower(h["name"]))


def merge_headers(stored: Column, update: Column) -> Column:
    """Stored header fields, of which the update replaces those it names and may change, and adds its others."""
    allowed = F.filter(update, lambda h: h["name"].isNotNull() & ~F.lower(h["name"]).isin(KEPT_FIELDS))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(_names(allowed), F.coalesce(F.lower(h["name"]), F.lit("")))), allowed)


def resolve_revisits(records: DataFrame, slice_rows: int = 20000) -> DataFrame:
    """The full response that each not-modified revisit stands for.

    ``records``: record_id long, url string, ts long, kind string (``response`` or ``revisit``), etag, last_modified,
    digest strings, headers array<struct<name,value>>. A full response is a ``response`` with a digest.

    Returns a row for each revisit: record_id, url_key, response_id, state, digest, headers. The candidate is the
    latest full response of the same canonical URL before the revisit by (ts, record_id). ``resolved``: every validator
    that both carry agrees, and they share one; then digest is the response's and headers are merged. ``mismatch``: a
    validator differs or none is shared; ``orphan``: there is no earlier full response. Both keep the revisit's headers
    and a null digest; an orphan has a null response_id. Revisits with a null URL or ts are orphans; other nulls never
    match. Repeated rows are resolved one by one. An empty table gives an empty result; other columns are ignored.

    A URL may hold a third of all records, so windows run over (URL, slice): slices are ranges of (URL, time) of about
    ``slice_rows`` records, as many as that takes, and a slice inherits from earlier ones of its URL by a window over their
    summaries, one a slice. Bodies are never moved.
    """
    r = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "etag", "last_modified", "digest", "headers")
    usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    full = usable & (F.col("kind") == "response") & F.col("digest").isNotNull()
    held = F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers")
    slices = records.count() // slice_rows + 1
    live = r.where(usable & (full | (F.col("kind") == "revisit"))).repartitionByRange(slices, "url_key", "ts", "record_id")
    live = Workspace(records.sparkSession, "revisits").save(live.withColumn("part", F.spark_partition_id()), "live")

    before = Window.partitionBy("url_key", "part").orderBy("ts", "record_id", F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    near = live.withColumn("own", F.last(F.when(full, held), ignorenulls=True).over(before)).where("kind = 'revisit'")
    sums = live.groupBy("url_key", "part").agg(F.max_by(F.when(full, held), F.when(full, F.struct("ts", "record_id"))).alias("end"))
    earlier = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("url_key", "part", F.last("end", ignorenulls=True).over(earlier).alias("carry")).where("carry is not null").hint("merge")  # near is dealt and sorted that way already
    got = near.join(carry, ["url_key", "part"], "left").withColumn("hit", F.coalesce("own", "carry")).drop("own", "carry", "part")
    lost = r.where(~usable & (F.col("kind") == "revisit")).withColumn("hit", F.lit(None).cast(got.schema["hit"].dataType))
    got = got.unionByName(lost)

    same = [F.col(c) == F.col(f"hit.{c}") for c in ("etag", "last_modified")]
    agree = F.greatest(*(F.coalesce(s.cast("int"), F.lit(0)) for s in same)) == 1
    clash = F.least(*(F.coalesce(s.cast("int"), F.lit(1)) for s in same)) == 0
    state = F.when(F.col("hit").isNull(), "orphan").when(agree & ~clash, "resolved").otherwise("mismatch")
    out = got.withColumn("state", state)
    done = F.col("state") == "resolved"
    none = F.expr("cast(array() as array<struct<name: string, value: string>>)")
    stored, own = F.coalesce("hit.headers", none), F.coalesce("headers", none)
    return out.select(
        "record_id", "url_key", F.col("hit.record_id").alias("response_id"), "state", F.when(done, F.col("hit.digest")).alias("digest"), F.when(done, merge_headers(stored, own)).otherwise(own).alias("headers")
    )


def page_records(pages: DataFrame, delay: int = 500) -> DataFrame:
    """A crawl log made of ``pages(page_id, url, html)``: each page is captured at time page_id, and its address is
    revisited ``delay`` later with the validators of that capture. A newer capture in between makes them stale."""
    digest = F.md5(F.col("html").cast("binary"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", digest.alias("digest"), F.octet_length("html").cast("string").alias("size"))
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))

    def fields(*pairs):
        return F.array(*(F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs))

    capture = fields(("Content-Type", F.lit("text/html")), ("Content-Length", F.col("size")), ("ETag", etag), ("Age", F.lit("0")))
    again = fields(("Content-Length", F.lit("0")), ("ETag", etag), ("Age", F.lit(delay)), ("Cache-Control", F.lit("max-age=60")))
    kinds = F.array(
        F.struct(F.lit("response").alias("kind"), (F.col("page_id") * 2).alias("record_id"), F.col("page_id").alias("ts"), F.col("digest").alias("digest"), capture.alias("headers")),
        F.struct(F.lit("revisit").alias("kind"), (F.col("page_id") * 2 + 1).alias("record_id"), (F.col("page_id") + delay).alias("ts"), F.lit(None).cast("string").alias("digest"), again.alias("headers")),
    )
    rows = base.select("url", etag.alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.explode(kinds).alias("k"))
    return rows.select("k.record_id", "url", "k.ts", "k.kind", "etag", "last_modified", "k.digest", "k.headers")
