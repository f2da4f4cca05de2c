"""URL filters: a temporal list join, in DataFrame operations only.

A list entry says from when on a host (and everything below it) is blocked, allowed, or no longer listed. Entries
of a host become validity intervals: each one holds until the next one of the same host starts. Every capture is evaluated against
the entries active at its fetch time: for the capture's host and each parent domain the one interval that
holds the fetch time; the most specific host with an active entry decides. Blocked captures are not kept.

The as-of join is a union and a last value: for every (host, day) that a capture asks about, the entries that hold on that day (the one that
is carried into it, and those that start in it) are put between the fetch times, and each fetch time takes the last entry before it. Entries and
captures never meet in pairs; entries reach their days by an equality join on (host, month), where an asked day only takes the entries
that touch it. Captures are first reduced to distinct (host, fetch time), so a day of a host holds its distinct times
whatever the number of captures; the verdicts join back to all rows, where adaptive execution can split a hot host.

Entries of one host at one instant: block before allow before remove.

Cases: a null or hostless url, or a null fetch time, matches no entry and is kept; an address (``10.0.0.1``, ``[2001:db8::1]``) has no parent domains;
entries with a null host, time or an unknown action are void; urls of any length are read whole; ties: an entry counts from its very instant on;
repeated rows are judged row by row; without entries everything is kept; an empty table gives an empty result.
Further columns of the captures are carried along under any name; one that is named like a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: scheme://user@HOST:port, the user up to the last @, the host in brackets or up to its port
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#@]*\]|[^/:?#@]+)"
#: Hosts without parent domains.
ADDRESS_PATTERN = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"
#: Actions, the strongest first.
ACTIONS = ("block", "allow", "remove")


def host(url: Column) -> Column:
    """Host of a url in lower case without a final dot; null if there is none."""
    h = F.rtrim(F.lower(F.regexp_extract(url, HOST_PATTERN, 1)), F.lit("."))
    return F.when(h != "", h)


def intervals(entries: DataFrame) -> DataFrame:
    """``host, action, since, until`` (exclusive; null: open) from entries ``host, listed_at, action``."""
    strength = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    one = (entries.select(F.rtrim(F.lower("host"), F.lit(".")).alias("host"), F.col("listed_at").cast("timestamp").alias("since"), "action")
           .filter(F.col("host").isNotNull() & (F.col("host") != "") & F.col("since").isNotNull() & F.col("action").isin(*ACTIONS))
           .groupBy("host", "since").agg(F.min(strength).alias("strength")))
    named = F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("strength").cast("int"))
    return one.select("host", "since", named.alias("action"),
                      F.lead("since").over(W.partitionBy("host").orderBy("since")).alias("until"))


def parents(h: Column) -> Column:
    """A host and its parent domains of two labels or more, the host first; an address has none."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.when(h.rlike(ADDRESS_PATTERN), F.lit(1)).otherwise(F.greatest(n - 1, F.lit(1)))), lambda i: F.array_join(F.slice(labels, i, n), "."))


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``url_host, list_host, list_action, listed_at, url_kept``."""
    rows = captures.select(F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("_row"))
    rows = rows.select("_row", host(F.col(f"_row.`{url_col}`")).alias("_host"), F.col(f"_row.`{time_col}`").cast("timestamp").alias("_at"))
    points = rows.select("_host", "_at").filter("_host is not null and _at is not null").distinct()
    last = points.agg(F.max("_at")).first()[0]  # one value; without captures nothing is listed
    month = lambda c: F.trunc(c, "month")
    # up to the last capture only: an open interval ends there
    until = F.coalesce(F.col("until") - F.expr("interval 1 microsecond"), F.lit(last).cast("timestamp"))
    listed = (intervals(entries).filter(F.col("since") <= F.lit(last).cast("timestamp"))
              .withColumn("end", F.least(until, F.lit(last).cast("timestamp"))).filter("end >= since")
              .select("host", "action", "since", "until",
                      F.explode(F.sequence(month("since"), month("end"), F.expr("interval 1 month"))).alias("month")))
    asked = points.select("_host", "_at", F.posexplode(parents(F.col("_host"))).alias("level", "host"))
    times = asked.select("host", F.col("_at").alias("at")).distinct()
    day = lambda c: F.to_date(c)
    days = times.select("host", day("at").alias("day"), month("at").alias("month")).distinct()
    touching = (days.join(listed, ["host", "month"]).filter((day("since") <= F.col("day")) & (F.col("until").isNull() | (day("until") >= F.col("day"))))
                .select("host", "day", F.col("since").alias("at"), F.struct("action", "since").alias("entry")))
    asks = times.select("host", day("at").alias("day"), "at", F.lit(None).cast(touching.schema["entry"].dataType).alias("entry"))
    # entries of an instant stand before its fetch times
    order = W.partitionBy("host", "day").orderBy("at", F.col("entry").isNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    known = (asks.union(touching).withColumn("last", F.last("entry", ignorenulls=True).over(order))
             .filter("entry is null and last.action <> 'remove'").select("host", F.col("at").alias("_at"), "last"))
    hit = asked.join(known, ["host", "_at"])
    verdict = hit.groupBy("_host", "_at").agg(F.min_by(F.struct("host", "last.action", "last.since"), "level").alias("_v"))
    own = {"url_host": F.col("_host"), "list_host": F.col("_v.host"), "list_action": F.col("_v.action"), "listed_at": F.col("_v.since"),
           "url_kept": F.coalesce(F.col("_v.action"), F.lit("")) != "block"}
    kept = [F.col(f"_row.`{c}`") for c in captures.columns if c.lower() not in own]
    return rows.join(verdict, ["_host", "_at"], "left").select(*kept, *(c.alias(n) for n, c in own.items()))


# --- the registered query: captures and a dated list derived from the pages table --------------------------------

_MINUTES = 366 * 1440  # of 2024
_START = 1704067200  # 2024-01-01 00:00 UTC


def page_captures(pages: DataFrame) -> DataFrame:
    """Each page as a capture with a fetch time in 2024."""
    at = F.timestamp_seconds(F.lit(_START) + F.lit(60) * F.pmod(F.col("page_id") * 7919, F.lit(_MINUTES)))
    return pages.select("page_id", "url", at.alias("fetched_at"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A dated list: the number in a page's path gives a day and an action for its host (every fifth: for the parent domain)."""
    n = F.regexp_extract("url", r"/([0-9]+)", 1).cast("long")
    h = host(F.col("url"))
    parent = F.regexp_replace(h, r"^[^.]*\.", "")
    return (pages.select(n.alias("n"), h.alias("h"), parent.alias("p")).filter("n is not null")
            .select(F.when(F.col("n") % 5 == 0, F.col("p")).otherwise(F.col("h")).alias("host"),
                    F.timestamp_seconds(F.lit(_START) + F.lit(86400) * (F.col("n") % 366)).alias("listed_at"),
                    F.element_at(F.array(*map(F.lit, ACTIONS)), (F.col("n") % 3 + 1).cast("int")).alias("action")))


def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: page_id, url_host, list_host, list_action, listed_at_s (seconds), url_kept."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    with_numbers = pages.withColumn("url", F.col("url").cast("string"))
    found = judge(page_captures(with_numbers), page_entries(with_numbers))
    return found.select("page_id", "url_host", "list_host", "list_action", F.unix_seconds("listed_at").alias("listed_at_s"), "url_kept")


SQL = rf"""
WITH p AS (
  SELECT page_id, nullif(rtrim(lower(regexp_extract(url, '{HOST_PATTERN}', 1)), '.'), '') AS h,
         {_START} + 60 * ((page_id * 7919) % {_MINUTES}) AS fetched,
         TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS n
  FROM pages),
e AS (
  SELECT CASE WHEN n % 5 = 0 THEN regexp_replace(h, '^[^.]*\.', '') ELSE h END AS host, {_START} + 86400 * (n % 366) AS since, min(n % 3) AS a
  FROM p WHERE n IS NOT NULL AND h IS NOT NULL GROUP BY 1, 2),
v AS (SELECT host, since, a, lead(since) OVER (PARTITION BY host ORDER BY since) AS until FROM e WHERE host <> ''),
s AS (SELECT DISTINCT h, fetched, unnest(range(1, CASE WHEN regexp_matches(h, '{ADDRESS_PATTERN}') THEN 2 ELSE greatest(len(string_split(h, '.')), 2) END)) AS level
      FROM p WHERE h IS NOT NULL),
q AS (SELECT h, fetched, level, array_to_string(string_split(h, '.')[level:], '.') AS host FROM s),
m AS (SELECT q.h, q.fetched, q.level, v.host, v.a, v.since FROM q JOIN v ON q.host = v.host
      WHERE q.fetched >= v.since AND (v.until IS NULL OR q.fetched < v.until) AND v.a <> 2),
b AS (SELECT h, fetched, arg_min(host, level) AS list_host, arg_min(a, level) AS a, arg_min(since, level) AS since FROM m GROUP BY 1, 2)
SELECT p.page_id, p.h AS url_host, b.list_host, CASE b.a WHEN 0 THEN 'block' WHEN 1 THEN 'allow' END AS list_action,
       b.since AS listed_at_s, coalesce(b.a, 1) <> 0 AS url_kept
FROM p LEFT JOIN b ON p.h = b.h AND p.fetched = b.fetched
"""
