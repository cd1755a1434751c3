"""URL filters: an as-of join of captures with dated lists.

List entries say from which day a list blocks, allows or no longer mentions a pattern. They become
validity intervals, and every capture is judged by the entries that were active when it was
fetched: the most specific pattern wins, and of equal patterns a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Actions by strength; of several entries of one list, pattern and day the strongest counts.
ACTIONS = ("remove", "allow", "block")
DAY = 86_400


def host_of(url: Column) -> Column:
    """The lower-cased host of an absolute URL, without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\\]*)", 1)
    return F.lower(F.regexp_replace(authority, r"^.*@|\.?(:[0-9]*)?$", ""))


def path_of(url: Column) -> Column:
    """The path without query and fragment, as the segments between slashes."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def patterns_of(host: Column, segments: Column, depth: int) -> Column:
    """Every pattern that covers a URL: its domains of two labels and more, then host and path beginnings."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    heads = F.when(
        (F.size(segments) > 0) & F.lit(depth > 0),
        F.transform(
            F.sequence(F.lit(1), F.least(F.size(segments), F.lit(depth))),
            lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")),
        ),
    )
    return F.when(host != "", F.concat(suffixes, F.coalesce(heads, F.array().cast("array<string>"))))


def validity(entries: DataFrame) -> DataFrame:
    """Entries ``(pattern, list, action, day)`` as ``(pattern, list, action, since, until)``.

    Entries of one pattern, list and day are first made one, by partial aggregation, so a pattern
    with very many entries has at most one row a day and list when its intervals are formed.
    ``until`` is the day from which the next entry holds, null for the last; removals only end.
    """
    strength = F.array_position(F.array(*map(F.lit, ACTIONS)), F.lower("action"))
    # Hosts have no case, paths have. Empty segments, so a final slash too, count no more than in a URL.
    segments = F.filter(F.split("pattern", "/"), lambda s, i: (i > 0) & (s != ""))
    pattern = F.array_join(F.concat(F.array(F.lower(F.substring_index("pattern", "/", 1))), segments), "/")
    ranked = entries.select(pattern.alias("pattern"), "list", "day", strength.alias("strength"))
    ranked = ranked.where("strength > 0 and pattern is not null and day is not null")
    daily = ranked.groupBy("pattern", "list", "day").agg(F.max("strength").alias("strength"))
    following = F.lead("day").over(W.partitionBy("pattern", "list").orderBy("day"))
    return (
        daily.withColumn("until", following)
        .where("strength > 1")
        .select(
            "pattern",
            "list",
            F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("strength").cast("int")).alias("action"),
            F.col("day").alias("since"),
            "until",
        )
    )


def filter_urls(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetch_time",
    bucket_days: int = 64,
) -> DataFrame:
    """Per capture: its id, URL, fetch time, ``host``, ``verdict``, ``pattern``, ``lists`` and ``since``.

    ``entries`` has ``(pattern, list, action, day)``; a pattern is a domain, which covers its
    subdomains, or a host with any number of beginning segments of a path. ``lists`` are those
    that give the verdict, ``since`` the latest day from which one of them does. Without an active
    entry the verdict is "allow" and the other three are null or empty.

    The as-of join is an equal join on pattern and time bucket with the bounds as a further
    condition: intervals are filed under each bucket of ``bucket_days`` they touch, up to the last
    fetch, so that the captures of a hot host spread over the buckets, and Spark may split what is
    left of them. A URL fetched twice at one time is judged once.

    A null or relative URL has no host and a null fetch time no active entry: both are allowed.
    Entries with a null pattern or day, or an unknown action, say nothing. Repeated captures and
    null ids each keep their row; an empty table gives none, an empty list allows all; other
    columns are not looked at.
    """
    pages = captures.select(
        captures[id_col].alias("_id"),
        captures[url_col].cast("string").alias("_url"),
        captures[time_col].cast("timestamp").alias("_time"),
    )
    day = F.floor(F.unix_timestamp("_time") / DAY).cast("int")
    judged = pages.select("_url", "_time").distinct().where("_url is not null and _time is not null")
    judged = judged.select("_url", "_time", day.alias("_day"), F.floor(day / bucket_days).cast("int").alias("_bucket"))
    # Captures get keys as deep as the deepest entry.
    depth = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    keyed = judged.withColumn("_pattern", F.explode(patterns_of(host_of(F.col("_url")), path_of(F.col("_url")), depth)))

    last = judged.agg(F.max("_day")).first()[0] or 0
    spans = validity(entries).select(
        "pattern",
        "list",
        "action",
        "since",
        F.unix_date("since").alias("_from"),
        F.least(F.unix_date("until"), F.lit(last + 1)).alias("_to"),  # least skips a null
    )
    first_bucket, last_bucket = (F.floor(F.col(c) / bucket_days).cast("int") for c in ("_from", "_last"))
    spans = spans.where("_from < _to").withColumn("_last", F.col("_to") - 1)
    filed = spans.withColumn("_filed", F.explode(F.sequence(first_bucket, last_bucket)))

    active = keyed.join(
        filed,
        (F.col("_pattern") == F.col("pattern"))
        & (F.col("_bucket") == F.col("_filed"))
        & (F.col("_day") >= F.col("_from"))
        & (F.col("_day") < F.col("_to")),
    )
    # The strongest answer per list action and pattern first, then the most specific of those.
    weight = F.struct(
        F.col("_pattern").contains("/").alias("path"),
        F.length("_pattern").alias("length"),
        F.col("_pattern").alias("pattern"),
        (F.col("action") == "block").alias("block"),
    )
    answers = active.groupBy("_url", "_time", weight.alias("w")).agg(
        F.sort_array(F.collect_set("list")).alias("lists"), F.max("since").alias("since")
    )
    best = answers.groupBy("_url", "_time").agg(F.max(F.struct("w", "lists", "since")).alias("best"))
    return pages.join(best, ["_url", "_time"], "left").select(
        F.col("_id").alias(id_col),
        F.col("_url").alias(url_col),
        F.col("_time").alias(time_col),
        host_of(F.coalesce("_url", F.lit(""))).alias("host"),
        F.when(F.col("best.w.block"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        F.col("best.w.pattern").alias("pattern"),
        F.coalesce("best.lists", F.array().cast("array<string>")).alias("lists"),
        F.col("best.since").alias("since"),
    )
