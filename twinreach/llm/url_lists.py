"""URL filters by dated lists.

A list is a history: entries are added and removed at times.  The events of
an entry become validity intervals [added, next event), and every capture is
judged against the entries that were active when it was fetched, by an as-of
join on (entry, time bucket) with the interval as condition.  Interval rows
are repeated for every bucket they touch, so a host with a third of all
captures, or an entry with a long history, is split by time.

An entry is a domain (it covers its subdomains) or a host with the first
segment of the path, written ``host/segment``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinreach.llm.common import numbered, stored

BUCKET = 30 * 86400
ADD, REMOVE = "add", "remove"


def host(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; '' if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")),
                             r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.lower(F.regexp_replace(found, r"\.+$", ""))


def segment(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]+://[^/?#]*/([^/?#]+)", 1)


def entries_for(url: Column) -> Column:
    """The entries that can cover a URL: its host, the parent domains of at
    least two labels, and host/segment."""
    h, s = host(url), segment(url)
    labels = F.split(h, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, n), "."))
    own = F.when(s != "", F.array(F.concat(h, F.lit("/"), s))).otherwise(
        F.array().cast("array<string>"))
    return F.when(h == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, own)))


def intervals(events: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``entry, since, until`` (null: still active) of the active times.

    ``events`` has entry, at (seconds), action; equal events count once, and
    of an addition and a removal at one time the removal holds.  Rows with a
    null are left out.  The next event is looked for inside a time bucket
    first, then among the entry's first events per bucket, so a long history
    is never in one task.
    """
    e = (events.select("entry", "at", "action").dropna()
         .groupBy("entry", "at").agg(F.max("action").alias("action")))  # "remove" > "add"
    e = e.withColumn("bucket", F.floor(F.col("at") / bucket))
    inside = Window.partitionBy("entry", "bucket").orderBy("at")
    later = Window.partitionBy("entry").orderBy("bucket")
    heads = e.groupBy("entry", "bucket").agg(F.min("at").alias("first"))
    heads = heads.select("entry", "bucket", F.lead("first").over(later).alias("after"))
    nexts = e.withColumn("next", F.lead("at").over(inside)).join(heads, ["entry", "bucket"])
    return nexts.where(F.col("action") == ADD).select(
        "entry", F.col("at").alias("since"), F.coalesce("next", "after").alias("until"))


def judged(captures: DataFrame, events: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``page_id, host, fetched, blocked, n_active, entry, since`` per row of
    ``captures`` (page_id, url, fetched in seconds).

    ``n_active`` entries cover the capture at its fetch time; ``entry`` is the
    longest of them (then the first in order), active ``since``.  A capture
    without a host or a fetch time is covered by none.  Repeated rows come
    back as often; empty tables are allowed.
    """
    rows = numbered(captures.select("page_id", "url", "fetched", host(F.col("url")).alias("host")),
                    "row", "url-captures")
    valid = stored(intervals(events, bucket), "url-intervals")
    span = captures.agg(F.max("fetched").alias("last")).first()["last"]
    if span is None:
        span = 0
    until = F.least(F.coalesce("until", F.lit(span + 1)), F.lit(span + 1))
    pieces = valid.where(F.col("since") <= span).withColumn("bucket", F.explode(F.sequence(
        F.floor(F.col("since") / bucket), F.floor((until - 1) / bucket)))).select(
        F.col("entry").alias("e"), F.col("bucket").alias("b"), "since", "until")
    asked = rows.select("row", "fetched", F.explode(entries_for(F.col("url"))).alias("entry"))
    asked = asked.where("fetched is not null").withColumn("bucket", F.floor(F.col("fetched") / bucket))
    active = asked.join(pieces, (F.col("entry") == F.col("e")) & (F.col("bucket") == F.col("b"))
                        & (F.col("since") <= F.col("fetched"))
                        & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    # the longest entry, then the first in order: smallest by (-length, entry)
    best = active.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_active"),
        F.min(F.struct((-F.length("entry")).alias("l"), "entry", "since")).alias("best"))
    out = rows.join(best, "row", "left")
    return out.select("page_id", "host", "fetched", F.col("best").isNotNull().alias("blocked"),
                      F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                      F.col("best.entry").alias("entry"), F.col("best.since").alias("since"))


# -- captures and a list derived from the pages table -------------------------

START = 1704067200  # 2024-01-01, in seconds
YEAR = 366 * 86400


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("string").cast("binary")), 1, 7), 16, 10).cast("long")


def derived_captures(pages: DataFrame) -> DataFrame:
    """Fetch times in 2024 by a digest of the page's id."""
    return pages.select("page_id", "url", (START + _number(F.col("page_id")) % YEAR).alias("fetched"))


def derived_events(pages: DataFrame) -> DataFrame:
    """A history for a third of all entries that cover some page: added,
    removed, added and removed again, at times by a digest of the entry."""
    entry = pages.select(F.explode(entries_for(F.col("url"))).alias("entry")).distinct()
    n = _number(F.concat(F.lit("list "), F.col("entry")))
    listed = entry.withColumn("n", n).where("n % 3 = 0")
    step = 86400 * (10 + F.col("n") % 61)
    turn = listed.withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    return turn.select("entry", (START + F.col("n") % (YEAR // 2) + F.col("k") * step).alias("at"),
                       F.when(F.col("k") % 2 == 0, F.lit(ADD)).otherwise(F.lit(REMOVE)).alias("action"))


def url_report(pages: DataFrame) -> DataFrame:
    return judged(derived_captures(pages), derived_events(pages))
