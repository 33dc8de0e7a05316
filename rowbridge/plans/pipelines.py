"""Consecutive-period and star-schema pipelines as DataFrame code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.operators.merges import merge_update
from rowbridge.operators.numbering import number_rows
from rowbridge.sinks.partitions import load_partition

# ------------------------------------------------------- consecutive periods


def distinct_days(events: DataFrame, user: str, ts: str) -> DataFrame:
    """(user, day) pairs; duplicates are dropped before the shuffle."""
    return events.select(column(user).alias("user_id"), F.to_date(column(ts)).alias("day")).distinct()


def numbered_days(days: DataFrame) -> DataFrame:
    """Days of each user numbered in order; a user has at most one row per day."""
    order = Window.partitionBy("user_id").orderBy("day")
    return days.withColumn("rn", F.row_number().over(order))


def island_keys(days: DataFrame) -> DataFrame:
    """Day minus its number: equal for all days of one unbroken run."""
    numbered = numbered_days(days)
    return numbered.select("user_id", "day", F.date_sub("day", F.col("rn")).alias("island"))


def consecutive_periods(days: DataFrame) -> DataFrame:
    """Length, first and last day of every run; reuses the partitioning by user."""
    return (
        island_keys(days)
        .groupBy("user_id", "island")
        .agg(
            F.count(F.lit(1)).alias("consecutive_days"),
            F.min("day").alias("period_start"),
            F.max("day").alias("period_end"),
        )
    )


def longest_streaks(
    events: DataFrame, user: str, ts: str, joiner: str, ordered: bool = True
) -> DataFrame:
    """Longest runs per user, ties kept, longest first; ``joiner`` stands between first and last day.

    The maximum is taken over the same partitioning by user instead of joining
    the runs with their maxima.
    """
    runs = consecutive_periods(distinct_days(events, user, ts))
    longest = F.max("consecutive_days").over(Window.partitionBy("user_id"))
    kept = runs.withColumn("max_consecutive_days", longest).where(
        F.col("consecutive_days") == F.col("max_consecutive_days")
    )
    period = F.concat(
        F.col("period_start").cast("string"), F.lit(joiner), F.col("period_end").cast("string")
    )
    result = kept.select("user_id", "max_consecutive_days", period.alias("longest_period"))
    if not ordered:
        return result
    return result.orderBy(F.desc("max_consecutive_days"), "user_id", "longest_period")


# ------------------------------------------------------------ star schema


def categorize(value: Column, categories: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """Category of a value by membership in value lists."""
    result = None
    for name, values in categories.items():
        hit = value.isin(*values)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return F.lit(default) if result is None else result.otherwise(default)


def load_dimension(
    existing: DataFrame | None,
    source: DataFrame,
    natural_key: str,
    surrogate_key: str,
) -> DataFrame:
    """Existing members plus the new ones, numbered on from the largest key.

    New members are numbered in the order of their natural key, so a rerun gives
    the same keys. Members already present keep their row. The result is written
    once, so joins with it know its size and do not number it again.
    """
    rest = [c for c in source.columns if c != natural_key]
    if not rest:
        members = source.distinct()
    else:
        first = F.min(F.struct(*[column(c) for c in rest])).alias("__rest")
        members = (
            source.groupBy(column(natural_key))
            .agg(first)
            .select(column(natural_key), *[F.col("__rest").getField(c).alias(c) for c in rest])
        )
    top = 0
    if existing is not None:
        known = existing.select(column(natural_key))
        members = members.join(known, natural_key, "left_anti")
        top = existing.agg(F.max(column(surrogate_key))).head()[0] or 0
    # Sorting samples its input first; staged members are not computed twice.
    numbered = number_rows(stage(members, "members"), [column(natural_key)], "__row")
    fresh = numbered.select(
        (F.col("__row") + F.lit(top + 1)).cast("bigint").alias(surrogate_key),
        *[column(c) for c in members.columns],
    )
    if existing is None:
        return stage(fresh, "dimension")
    added = fresh.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in existing.schema.fields])
    return stage(existing.unionByName(added), "dimension")


def load_fact(
    source: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str, str]]
) -> DataFrame:
    """Inner joins of a source with its dimensions, adding their surrogate keys.

    Each dimension is (table, its natural key, its surrogate key, source column).
    The joins have no hints: Spark broadcasts a dimension below its threshold, and
    else shuffles and splits a value that many facts share.
    """
    fact = source
    for i, (table, natural, surrogate, name) in enumerate(dimensions):
        side = table.select(column(natural).alias(f"__n{i}"), column(surrogate))
        fact = fact.join(side, column(name) == F.col(f"__n{i}")).drop(f"__n{i}")
    return fact


def parse_discount(amount: Column, discount: Column) -> Column:
    """Share of an amount given as ``10%`` or ``10``; both are percentages."""
    bare = F.when(F.endswith(discount, F.lit("%")), F.replace(discount, F.lit("%"), F.lit("")))
    percent = bare.otherwise(discount).cast("decimal(5,2)")
    return amount * percent / 100


def mixed_dates(text: Column) -> Column:
    """``dd/MM/yyyy`` when the text holds a slash, otherwise ``yyyy-MM-dd``."""
    slashed = F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))
    dashed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    return F.when(F.contains(text, F.lit("/")), slashed).otherwise(dashed).cast("date")


def summarize(
    fact: DataFrame,
    day: str,
    groups: Sequence[str],
    total: str,
    quantity: str,
    discount: str,
    price: str,
) -> DataFrame:
    """Sales per month and group with the mean discount in percent."""
    ratio = column(discount) / F.nullif(column(price), F.lit(0).cast(fact.schema[price].dataType)) * 100
    month = F.trunc(column(day).cast("date"), "month").alias("summary_date")
    return fact.groupBy(month, *[column(g) for g in groups]).agg(
        F.sum(column(total)).alias("total_sales"),
        F.sum(column(quantity)).alias("total_quantity"),
        F.avg(ratio).alias("avg_discount"),
    )


def summary_states(
    fact: DataFrame,
    day: str,
    groups: Sequence[str],
    total: str,
    quantity: str,
    discount: str,
    price: str,
) -> DataFrame:
    """What :func:`summarize` knows of some facts, in a form that adds up: sums, and a count for the mean."""
    ratio = column(discount) / F.nullif(column(price), F.lit(0).cast(fact.schema[price].dataType)) * 100
    month = F.trunc(column(day).cast("date"), "month").alias("summary_date")
    return fact.groupBy(month, *[column(g) for g in groups]).agg(
        F.sum(column(total)).alias("total_sales"),
        F.sum(column(quantity)).alias("total_quantity"),
        F.sum(ratio).alias("discount_sum"),
        F.count(ratio).alias("discount_count"),
    )


def load_states(states: DataFrame, table: str, load: str, location: str | None = None) -> None:
    """Store the states of one load in a partition of its own.

    Old facts and old states are not read. A load that is run again replaces its
    partition, so facts never count twice.
    """
    load_partition(states, table, {"load_id": load}, "overwrite", "parquet", location=location)


def summary_of_states(states: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The summary of all facts whose states are given, from any number of loads."""
    return states.groupBy("summary_date", *[column(g) for g in groups]).agg(
        F.sum("total_sales").cast(states.schema["total_sales"].dataType).alias("total_sales"),
        F.sum("total_quantity").alias("total_quantity"),
        (F.sum("discount_sum") / F.nullif(F.sum("discount_count"), F.lit(0).cast("bigint"))).alias("avg_discount"),
    )


def upsert_summary(target: DataFrame, summary: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Summary rows replace the values of the same month and group."""
    return merge_update(target, summary, ["summary_date", *groups], unique=True)


def recent_facts(fact: DataFrame, day: str, tie: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` latest facts; ``tie`` makes the choice among equal days definite."""
    return fact.orderBy(F.desc(day), *tie).limit(k)
