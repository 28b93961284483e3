"""URL lists that change in time, joined to captures as of their fetch time.

A list is a log of dated entries: a pattern is added or removed. Entries become validity
intervals, one pattern's never overlapping. A pattern is a domain (``example.com``, which
holds for its subdomains too) or a host with a path prefix of whole segments
(``example.com/a/b``). A capture is joined by all patterns that could hold for its URL and by
month, then by its fetch time: so a host that holds a third of all captures and was listed and
delisted many times meets only the few intervals of a month, and the join is one of equality,
which Spark splits where a key is hot.

DataFrame operations only. Defined results: captures without a URL, host or time meet no entry;
entries without a pattern or date are no entries; of entries of one pattern at one time, the
removal counts; a repeated addition changes nothing; rows repeated with the same id are one
capture, in force if any of them is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Host in lower case, without user and port; empty if there is none."""
    place = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[0-9]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def patterns(url: Column, deepest: int) -> Column:
    """Patterns that hold for a URL: its host's domains, and its host with path prefixes.

    Prefixes have at most ``deepest`` segments, so that a long path makes no more than are listed.
    """
    labels = F.split(host(url), r"\.")
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.when(
        (F.size(parts) > 0) & F.lit(deepest > 0),
        F.transform(
            F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, deepest)))),
            lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    held = F.when(host(url) != "", F.concat(domains, prefixes))
    return F.coalesce(held, F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``(pattern, valid_from, valid_to)`` from ``(pattern, action, dated)``; to is exclusive.

    ``action`` is 'add' or 'remove'; ``valid_to`` is null while an entry is still in force.
    """
    rows = entries.filter("pattern is not null and dated is not null").select(
        "pattern", "dated", (F.col("action") == "add").alias("_on")
    )
    once = rows.groupBy("pattern", "dated").agg(F.min("_on").alias("_on"))
    in_time = Window.partitionBy("pattern").orderBy("dated")
    return (
        once.withColumn("_before", F.lag("_on").over(in_time))
        .filter(F.col("_on") != F.coalesce("_before", F.lit(False)))
        .withColumn("valid_to", F.lead("dated").over(in_time))
        .filter("_on")
        .select("pattern", F.col("dated").alias("valid_from"), "valid_to")
    )


def in_force(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture ``page_id, n_entries, pattern``: entries in force when it was fetched.

    ``captures`` holds ``page_id, url, fetched``; ``pattern`` is the longest one in force, the
    first in order of those equally long, or null.
    """
    month = lambda t: F.date_trunc("month", t)
    segments = F.size(F.split("pattern", "/")) - 1
    deepest = entries.filter("pattern is not null").agg(F.max(segments)).head()[0] or 0
    held = F.array_distinct(patterns(F.col("url"), deepest))
    asked = captures.select(
        "page_id", "fetched", F.explode(held).alias("pattern")
    ).withColumn("_month", month(F.col("fetched")))
    last = captures.agg(F.max("fetched").alias("_last"))
    listed = intervals(entries).withColumn("_last", F.lit(last.head()[0]))
    until = F.coalesce(F.col("valid_to"), F.col("_last"))
    listed = listed.filter(F.col("valid_from") <= until).withColumn(
        "_month",
        F.explode(
            F.sequence(month(F.col("valid_from")), month(until), F.expr("interval 1 month"))
        ),
    )
    met = (
        asked.join(listed.drop("_last"), ["pattern", "_month"])
        .filter(
            (F.col("fetched") >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
        )
        .groupBy("page_id")
        .agg(
            F.countDistinct("pattern").alias("n_entries"),
            F.min(F.struct(-F.length("pattern"), F.col("pattern"))).alias("_best"),
        )
    )
    pages = captures.select("page_id").distinct()
    return pages.join(met, pages["page_id"].eqNullSafe(met["page_id"]), "left").select(
        pages["page_id"],
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.col("_best.pattern").alias("pattern"),
    )
