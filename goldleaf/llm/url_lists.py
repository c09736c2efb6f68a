"""URL filters against dated lists: a temporal join, in DataFrame operations only.

Lines of a list say when a pattern was added or removed.  They become validity
intervals, and every capture is evaluated against the intervals that hold at the
time it was fetched.  Intervals are cut at the ends of time buckets, so the join
is an equality on pattern and bucket and a pattern with a large share of all
rows is spread over its buckets; within one, intervals don't overlap and a
capture meets at most one.  Times are microseconds since 1970.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.sources.tables import materialize

DAY = 86_400_000_000

# Kinds of patterns, the most specific first.
KINDS = ["prefix", "host", "domain"]
HOST, DOMAIN, SEGMENT = r"^[a-z]+://([^/:?#]+)", r"([^.]+[.][^.]+)$", r"^[a-z]+://[^/?#]+/([^/?#]+)"


def url_patterns(url: Column) -> dict[str, Column]:
    """Host, registered domain (the last two labels), and host with the first path segment; null where there is none."""
    low = F.lower(url)
    host = F.nullif(F.regexp_extract(low, HOST, 1), F.lit(""))
    segment = F.nullif(F.regexp_extract(low, SEGMENT, 1), F.lit(""))
    return {
        "prefix": F.concat(host, F.lit("/"), segment),
        "host": host,
        "domain": F.nullif(F.regexp_extract(host, DOMAIN, 1), F.lit("")),
    }


def validity_intervals(lines: DataFrame, bucket: int = DAY) -> DataFrame:
    """(kind, pattern, since, until) of lines (line_id, kind, pattern, at, listed); ``until`` is null while it holds.

    Of lines of one pattern at one time the one with the largest id counts.  Lines
    that change nothing are passed over, and so are those without pattern or time.
    The order of a pattern's lines is found bucket by bucket; only the first and
    last of each bucket meet.
    """
    key = ["kind", "pattern"]
    lines = (
        lines.where("kind IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL AND listed IS NOT NULL")
        .groupBy(*key, "at")
        .agg(F.max_by("listed", F.coalesce("line_id", F.lit(-1))).alias("listed"))
        .withColumn("bucket", F.floor(F.col("at") / bucket))
    )
    inside = Window.partitionBy(*key, "bucket").orderBy("at")
    over = Window.partitionBy(*key).orderBy("bucket")
    carried = (
        lines.groupBy(*key, "bucket")
        .agg(F.max_by("listed", "at").alias("last"))
        .withColumn("carried", F.coalesce(F.lag("last").over(over), F.lit(False)))
        .drop("last")
    )
    changes = (
        lines.join(carried, [*key, "bucket"])
        .withColumn("before", F.coalesce(F.lag("listed").over(inside), "carried"))
        .where("listed <> before")
        .withColumn("next_inside", F.lead("at").over(inside))
    )
    later = (
        changes.groupBy(*key, "bucket")
        .agg(F.min("at").alias("first"))
        .withColumn("next_later", F.lead("first").over(over))
        .drop("first")
    )
    return (
        changes.where("listed")
        .join(later, [*key, "bucket"])
        .select(*key, F.col("at").alias("since"), F.coalesce("next_inside", "next_later").alias("until"))
    )


def evaluate(captures: DataFrame, lines: DataFrame, bucket: int = DAY) -> DataFrame:
    """page_id, fetched_at, n_active, kind, pattern, listed_since, blocked of captures (page_id, url, fetched_at).

    ``kind``, ``pattern`` and ``listed_since`` are those of the most specific entry
    that holds.  A capture without url or time meets none and is not blocked;
    captures that repeat give one row.  Other columns are ignored.
    """
    patterns = F.array(*[F.struct(F.lit(k).alias("kind"), url_patterns(F.col("url"))[k].alias("pattern")) for k in KINDS])
    captures = captures.select("page_id", F.col("url").cast("string").alias("url"), "fetched_at")
    asked = (
        captures.select("page_id", "url", "fetched_at", F.explode(patterns).alias("p"))
        .select("page_id", "url", "fetched_at", "p.kind", "p.pattern")
        .withColumn("bucket", F.floor(F.col("fetched_at") / bucket))
    )
    horizon = captures.agg(F.max("fetched_at")).first()[0]
    intervals = materialize(validity_intervals(lines, bucket), "intervals")
    last = F.least(F.coalesce(F.col("until") - 1, F.lit(horizon)), F.lit(horizon))
    pieces = intervals.where(F.col("since") <= F.lit(horizon).cast("bigint")).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("since") / bucket), F.floor(last / bucket)))
    )
    holds = (F.col("since") <= F.col("fetched_at")) & F.coalesce(F.col("fetched_at") < F.col("until"), F.lit(True))
    met = (
        asked.where("pattern IS NOT NULL AND fetched_at IS NOT NULL")
        .join(pieces, ["kind", "pattern", "bucket"])
        .where(holds)
        .groupBy("page_id", "url", "fetched_at")
        .agg(
            F.count_distinct("kind").alias("n_active"),
            F.min(
                F.struct(
                    F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"), "kind", "pattern", "since"
                )
            ).alias("most"),
        )
    )
    one = captures.distinct()
    same = one["page_id"].eqNullSafe(met["page_id"]) & (one["url"] == met["url"]) & (one["fetched_at"] == met["fetched_at"])
    return one.join(met, same, "left").select(
        one["page_id"],
        one["fetched_at"],
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.col("most.kind").alias("kind"),
        F.col("most.pattern").alias("pattern"),
        F.col("most.since").alias("listed_since"),
        F.col("most").isNotNull().alias("blocked"),
    )


# ---- the query's inputs -----------------------------------------------------
# A list and capture times derived from the tables: every event is a line about a
# page, and the pages take turns; an error takes an entry off, and captures are spread over a month.
FETCH_START = 1_704_067_200_000_000  # 2024-01-01
FETCH_STEP, FETCH_SPAN = 7_919, 2_592_000  # seconds


def micros(df: DataFrame, column: str) -> Column:
    if dict(df.dtypes)[column] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")
    return F.unix_micros(column)


def _lines(events: DataFrame, pages: DataFrame, page: Column) -> DataFrame:
    """Lines of all events about a page of ``pages``; ``page`` is the page_id of an event."""
    about = events.select(
        F.col("event_id").alias("line_id"),
        micros(events, "ts").alias("at"),
        (F.col("event_type") != "error").alias("listed"),
        page.alias("page_id"),
    ).join(pages.select("page_id", "url"), "page_id")
    found = url_patterns(F.col("url"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("line_id") % 3 + 1).cast("int"))
    pattern = F.when(kind == "prefix", found["prefix"]).when(kind == "host", found["host"]).otherwise(found["domain"])
    return about.select("line_id", kind.alias("kind"), pattern.alias("pattern"), "at", "listed")


def list_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Only the lines of the events whose id is a page's."""
    return _lines(events, pages, F.col("event_id"))


def all_list_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """A line of every event: the pages, numbered from 0 by their ids, take the events in turn."""
    last = pages.agg(F.max("page_id")).first()[0]
    return _lines(events, pages, F.pmod("event_id", F.lit((last or 0) + 1)))


def page_captures(pages: DataFrame) -> DataFrame:
    seconds = F.col("page_id") * FETCH_STEP % FETCH_SPAN
    return pages.select("page_id", "url", (F.lit(FETCH_START) + seconds * 1_000_000).alias("fetched_at"))


SQL = r"""
WITH found AS (
    SELECT page_id, url, host, nullif(regexp_extract(host, '([^.]+[.][^.]+)$', 1), '') AS domain,
           host || '/' || nullif(regexp_extract(lower(url), '^[a-z]+://[^/?#]+/([^/?#]+)', 1), '') AS prefix,
           1704067200000000 + (page_id * 7919 % 2592000) * 1000000 AS fetched_at
    FROM (SELECT *, nullif(regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1), '') AS host FROM pages)
), lines AS (
    SELECT event_id AS line_id, epoch_us(ts) AS moment, event_type <> 'error' AS listed,
           CASE event_id % 3 WHEN 0 THEN 'prefix' WHEN 1 THEN 'host' ELSE 'domain' END AS kind,
           CASE event_id % 3 WHEN 0 THEN prefix WHEN 1 THEN host ELSE domain END AS pattern
    FROM events JOIN found ON event_id % (SELECT max(page_id) + 1 FROM pages) = page_id
), ordered AS (
    SELECT kind, pattern, moment, arg_max(listed, line_id) AS listed
    FROM lines WHERE pattern IS NOT NULL GROUP BY ALL
), changes AS (
    SELECT * FROM ordered
    QUALIFY listed <> coalesce(lag(listed) OVER (PARTITION BY kind, pattern ORDER BY moment), false)
), asked AS (
    SELECT page_id, fetched_at, unnest(['prefix', 'host', 'domain']) AS kind, unnest([1, 2, 3]) AS rank,
           unnest([prefix, host, domain]) AS pattern
    FROM found
), met AS (
    SELECT a.*, c.moment AS since FROM asked a
    ASOF JOIN changes c ON a.kind = c.kind AND a.pattern = c.pattern AND a.fetched_at >= c.moment
    WHERE c.listed
)
SELECT f.page_id, f.fetched_at, count(m.kind) AS n_active, arg_min(m.kind, m.rank) AS kind,
       arg_min(m.pattern, m.rank) AS pattern, arg_min(m.since, m.rank) AS listed_since, count(m.kind) > 0 AS blocked
FROM found f LEFT JOIN met m ON f.page_id = m.page_id
GROUP BY f.page_id, f.fetched_at
"""
