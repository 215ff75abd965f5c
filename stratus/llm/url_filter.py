"""URL filters against dated lists: a temporal join of captures and list entries.

Native DataFrame functions only.  A list is a log of dated entries (a key
is added or removed).  Each key's entries become validity intervals: an
``add`` holds from its day until the key's next entry in that list.  A
capture is matched by its host's suffixes (at least two labels) and by its
host with the first path segment, against the entries active on the day
it was fetched; the most specific key decides, and on the same key an
allowance beats a block.

Captures are reduced to distinct (host, segment, day) visits before the
join, so a host with a third of all captures takes part once per day, and
the verdicts are joined back.  Both joins are plain equi-joins that Spark
can split; the lists are never broadcast unless Spark finds them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import free_name, written

# What of a URL is its host and its first path segment
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)"
ALLOW = "allow"


def url_host(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and a trailing dot; null if there is none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.+$", "")
    return F.when(host != "", host)


def url_segment(url: Column) -> Column:
    """First segment of the URL's path, as written; null if there is none."""
    segment = F.regexp_extract(url, SEGMENT, 1)
    return F.when(segment != "", segment)


def url_keys(host: Column, segment: Column) -> Column:
    """The keys a list may hold for a URL: suffixes of the host from two labels on, and host/segment."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.when(
        n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n), "."))
    ).otherwise(F.array(host))
    return F.when(segment.isNull(), suffixes).otherwise(F.concat(suffixes, F.array(F.concat_ws("/", host, segment))))


def validity(entries: DataFrame) -> DataFrame:
    """list, key, since, until of a log of entries (list, key, action ``add`` or ``remove``, day).

    ``until`` is the day of the key's next entry in the list (exclusive),
    null while there is none.  Of entries of one day the removal counts;
    repeated additions continue each other.  Entries with a null field are
    not valid and are left out.
    """
    daily = entries.filter("list is not null and key is not null and day is not null").groupBy("list", "key", "day")
    daily = daily.agg(F.max(F.col("action") == "remove").alias("removed"), F.max(F.col("action") == "add").alias("added"))
    upcoming = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    held = daily.filter("removed or added").withColumn("until", upcoming).filter("added and not removed")
    return held.select("list", "key", F.col("day").alias("since"), "until")


def filter_captures(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetched") -> DataFrame:
    """``captures`` with host, verdict (``block``, ``allow`` or ``none``), list, list_key and since.

    The last three name the deciding entry (null without one; among equal
    keys the smallest list).  Captures without a host or a day match no
    entry.  Rows are kept one for one; an added column gets a trailing
    underscore where the input has one of its name.
    """
    names = {c: free_name(captures.columns, c) for c in ("host", "verdict", "list", "list_key", "since", "_segment")}
    host, verdict, list_, list_key, since, segment = names.values()
    taken = captures.withColumns({host: url_host(F.col(url_col)), segment: url_segment(F.col(url_col))})
    visits = taken.select(F.col(host).alias("host"), F.col(segment).alias("segment"), F.col(day_col).alias("day")).distinct()
    visits = visits.filter("host is not null and day is not null")
    active = written(validity(entries), "url-intervals")
    met = visits.withColumn("key", F.explode(url_keys(F.col("host"), F.col("segment")))).join(active, "key")
    met = met.filter("since <= day and (until is null or day < until)")
    allowed = F.col("list") == ALLOW
    first = met.groupBy("host", "segment", "day", "key", allowed.alias("allowed")).agg(
        F.min(F.struct("list", "since")).alias("entry")
    )
    # the longest key decides, then an allowance
    rank = F.struct(F.length("key").alias("n"), "allowed", "key", "entry")
    decided = first.groupBy("host", "segment", "day").agg(F.max(rank).alias("top"))
    decided = written(decided, "url-decisions").select(
        F.col("host").alias("_host"), F.col("segment").alias("_seg"), F.col("day").alias("_day"), "top"
    )
    on = (F.col(host) == F.col("_host")) & F.col(segment).eqNullSafe(F.col("_seg")) & (F.col(day_col) == F.col("_day"))
    out = taken.join(decided, on, "left")
    kind = F.when(F.col("top").isNull(), "none").when(F.col("top.allowed"), ALLOW).otherwise("block")
    return out.select(
        *captures.columns,
        F.col(host),
        kind.alias(verdict),
        F.col("top.entry.list").alias(list_),
        F.col("top.key").alias(list_key),
        F.col("top.entry.since").alias(since),
    )
