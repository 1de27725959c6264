"""URL filters by dated lists: entries become validity intervals, captures look up what held then.

Only DataFrame functions: the text work, the intervals and the as-of join stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: An interval is cut into periods of so many days, which are part of the join key: captures of a
#: host that holds a third of all rows are spread over the periods in which they were fetched.
PERIOD_DAYS = 16


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if the text is no absolute URL."""
    authority = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.coalesce(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and each of its parent domains; none for an empty host."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
    )


def intervals(entries: DataFrame) -> DataFrame:
    """List entries (pattern, action, listed_on date) as intervals [valid_from, valid_to).

    An entry holds until the next one of its pattern; valid_to is null while it is the last. Of
    entries of one pattern and day the one with the largest action counts. Entries without pattern,
    action or date say nothing."""
    one = (
        entries.where("pattern IS NOT NULL AND pattern != '' AND action IS NOT NULL AND listed_on IS NOT NULL")
        .groupBy(F.lower("pattern").alias("pattern"), F.col("listed_on").alias("valid_from"))
        .agg(F.max("action").alias("action"))
    )
    order = Window.partitionBy("pattern").orderBy("valid_from")
    return one.withColumn("valid_to", F.lead("valid_from").over(order))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Each capture (page_id, url, fetched_on) with the entry that decided on it.

    The entry of the longest matching domain suffix active on the day of the fetch decides; without
    one the action is 'none'. Intervals without an end reach to the last day of any capture. Rows without
    URL or date keep their place with action 'none'; repeated rows stay repeated. Returns page_id, url, fetched_on, host, pattern, valid_from, action."""
    period = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / PERIOD_DAYS)
    last = F.lit(captures.agg(F.max(F.col("fetched_on").cast("date"))).first()[0]).cast("date")
    pieces = intervals(entries).where(F.col("valid_from") <= last).select(
        F.col("pattern"), "action", "valid_from", "valid_to",
        F.explode(F.sequence(
            period(F.col("valid_from")), period(F.least(F.coalesce(F.date_sub("valid_to", 1), last), last))
        )).alias("period"),
    )
    rows = captures.select(
        "page_id", "url", "fetched_on", host_of(F.col("url")).alias("host"),
        F.struct(F.monotonically_increasing_id().alias("n")).alias("_row"),
    )
    asked = rows.select(
        "*", F.explode_outer(suffixes(F.col("host"))).alias("pattern"), period(F.col("fetched_on")).alias("period")
    )
    held = pieces.withColumnsRenamed({"pattern": "_pattern", "period": "_period"})
    active = (F.col("valid_from") <= F.col("fetched_on")) & (
        F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))
    )
    met = asked.join(
        held, (F.col("pattern") == F.col("_pattern")) & (F.col("period") == F.col("_period")) & active, "left"
    )
    # Of the entries found for a capture, the longest pattern wins; max() combines before its exchange.
    best = met.groupBy("page_id", "url", "fetched_on", "host", "_row").agg(
        F.max(F.when(
            F.col("_pattern").isNotNull(), F.struct(F.length("pattern").alias("size"), "pattern", "valid_from", "action")
        )).alias("hit")
    )
    return best.select(
        "page_id", "url", "fetched_on", "host", F.col("hit.pattern").alias("pattern"),
        F.col("hit.valid_from").alias("valid_from"), F.coalesce("hit.action", F.lit("none")).alias("action"),
    )
