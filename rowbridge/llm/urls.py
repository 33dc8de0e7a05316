"""URL lists over time: dated entries become validity intervals, captures join as of their fetch.

A list grows by dated events that add an entry or remove it. Per (list, kind,
value) the last event of a day counts, and an entry is active from the day of an
event that adds it to the day before the next that removes it. A capture is
judged by the entries active on the day it was fetched: those of its host, of
every domain above it, and of its exact address.

Captures of one host on one day have the same verdict, so the temporal join is
done once per distinct (host, day), and its result joins the captures on both.
A host with a third of all captures is thereby split by its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column, stage

_HOST = r"(?i)^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@]*)"
_NEVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; null if the address has none."""
    host = F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def address_of(url: Column) -> Column:
    """Host, path and query in one spelling: no scheme, port, fragment or final slash."""
    rest = F.regexp_replace(url, r"(?i)^(?:[a-z][a-z0-9+.\-]*:)?//[^/?#]*", "")
    rest = F.regexp_replace(F.regexp_replace(rest, "#.*$", ""), "/+$", "")
    return F.concat(host_of(url), rest)


def domains(host: Column) -> Column:
    """The host and every domain above it; an address of numbers in brackets has none above."""
    parts = F.when(F.startswith(host, F.lit("[")), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )


def validity(events: DataFrame) -> DataFrame:
    """(list, kind, value, since, until): intervals [since, until) in days.

    ``events`` has (list, kind 'domain' or 'url', value, day, active); events
    without list, value, day or verdict say nothing. Of the events of a day an
    adding one wins over a removing one. Events of one entry are at most one a
    day, which bounds the rows that must be ordered together.
    """
    known = events.where(
        F.col("list").isNotNull() & F.col("value").isNotNull() & F.col("day").isNotNull() & F.col("active").isNotNull()
    )
    daily = known.groupBy("list", "kind", "value", "day").agg(F.max("active").alias("active"))
    entry = Window.partitionBy("list", "kind", "value").orderBy("day")
    dated = daily.withColumn("until", F.coalesce(F.lead("day").over(entry), F.lit(_NEVER).cast("date")))
    return dated.where("active").select("list", "kind", "value", F.col("day").alias("since"), "until")


def _active(asked: DataFrame, intervals: DataFrame, kind: str, keys: Column) -> DataFrame:
    """(asked.*, lists) of the entries of ``kind`` that hold one of ``keys`` on ``day``."""
    wanted = asked.select("subject", "day", F.explode(keys).alias("value"))
    entries = intervals.where(F.col("kind") == kind).select("list", "value", "since", "until")
    met = wanted.join(
        entries,
        (wanted["value"] == entries["value"]) & (F.col("day") >= F.col("since")) & (F.col("day") < F.col("until")),
    )
    return met.groupBy("subject", "day").agg(F.collect_set("list").alias("lists"), F.count(F.lit(1)).alias("n"))


def judge_captures(captures: DataFrame, events: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(row, host, day, lists, n_entries, blocked) of every capture.

    ``lists`` are the distinct lists with an active entry, sorted; a capture
    without address, host or fetch time meets none. Repeated rows are judged
    alike, columns of any name stay inside ``row``.
    """
    intervals = stage(validity(events), "url-intervals")
    given = captures.select(
        F.struct("*").alias("row"), host_of(column(url)).alias("host"), address_of(column(url)).alias("address"),
        F.to_date(column(fetched)).alias("day"),
    )
    known = given.where("host is not null and day is not null")
    hosts = known.select(F.col("host").alias("subject"), "day").distinct()
    by_host = _active(hosts, intervals, "domain", domains(F.col("subject"))).select(
        F.col("subject").alias("host"), "day", F.col("lists").alias("host_lists"), F.col("n").alias("host_n")
    )
    addresses = known.select(F.col("address").alias("subject"), "day").distinct()
    by_address = _active(addresses, intervals, "url", F.array("subject")).select(
        F.col("subject").alias("address"), "day", F.col("lists").alias("url_lists"), F.col("n").alias("url_n")
    )
    by_host, by_address = stage(by_host, "url-hosts"), stage(by_address, "url-addresses")
    judged = given.join(by_host, ["host", "day"], "left").join(by_address, ["address", "day"], "left")
    none = F.array().cast("array<string>")
    lists = F.array_sort(F.array_union(F.coalesce("host_lists", none), F.coalesce("url_lists", none)))
    n = F.coalesce("host_n", F.lit(0)) + F.coalesce("url_n", F.lit(0))
    return judged.select(
        "row", "host", "day", lists.alias("lists"), n.cast("long").alias("n_entries"), (n > 0).alias("blocked")
    )
