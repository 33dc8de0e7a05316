"""Key-range splits of a table and row-key ranges of a cell table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, local_rows

Range = tuple[int, int]

_LONG_MAX = (1 << 63) - 1


def key_bounds(df: DataFrame, key: str) -> Range | None:
    """Smallest and largest key as integers; None when the key cannot be split."""
    if not isinstance(df.schema[key].dataType, T.NumericType):
        return None
    row = df.agg(F.min(column(key)), F.max(column(key))).head()
    return None if row[0] is None else (int(row[0]), int(row[1]))


def split_step(lo: int, hi: int, n: int, min_step: int = 0) -> int:
    return max(min_step, (hi - lo + 1) // n)


def split_ranges(lo: int, hi: int, n: int, min_step: int = 0) -> list[Range]:
    """``n`` inclusive ranges of equal width; the last one ends at ``hi``.

    With fewer keys than splits the width is 0 and the last range holds all
    keys, unless ``min_step`` is 1.
    """
    if n < 1:
        raise ValueError("the number of splits must be positive")
    if lo == hi:
        return [(lo, hi)]
    step = split_step(lo, hi, n, min_step)
    starts = [lo + i * step for i in range(n)]
    return [(s, hi if i == n - 1 else s + step - 1) for i, s in enumerate(starts)]


def split_id(key: Column, lo: int, hi: int, n: int, min_step: int = 0) -> Column:
    """Number of the split a key falls into; null keys get a split of their own, ``n``."""
    if lo == hi:
        n = 1
    step = split_step(lo, hi, n, min_step)
    if step == 0 or n == 1:
        inside = F.lit(n - 1)
    else:
        # The distance of two longs may need 64 bits and a sign.
        wide = "bigint" if hi - lo <= _LONG_MAX else "decimal(20,0)"
        distance = F.floor(key).cast(wide) - F.lit(lo).cast(wide)
        inside = F.least(F.lit(n - 1), F.floor(distance / F.lit(step).cast(wide)).cast("int"))
        if wide == "bigint":
            inside = F.least(
                F.lit(n - 1).cast("bigint"), F.call_function("div", distance, F.lit(step))
            )
    return F.when(key.isNull(), F.lit(n)).otherwise(inside).cast("int")


def with_split_id(df: DataFrame, key: str, n: int, min_step: int = 0) -> DataFrame:
    """Tag rows with their split. Narrow: Spark keeps its own file partitions."""
    bounds = key_bounds(df, key)
    if bounds is None:
        return df.withColumn("split_id", F.lit(0))
    return df.withColumn("split_id", split_id(column(key), *bounds, n, min_step))


def range_splits(df: DataFrame, key: str, n: int, min_step: int = 0) -> DataFrame:
    """(split_id, lo, hi, rows) of every split, empty ones included."""
    spark = df.sparkSession
    bounds = key_bounds(df, key)
    ranges: list[tuple] = [(None, None)] if bounds is None else list(split_ranges(*bounds, n, min_step))
    listed = local_rows(
        spark,
        {
            "split_id": list(range(len(ranges))),
            "lo": [lo for lo, _ in ranges],
            "hi": [hi for _, hi in ranges],
        },
        "split_id int, lo bigint, hi bigint",
    )
    tagged = (
        df.select(F.lit(0).alias("split_id"))
        if bounds is None
        else df.select(split_id(column(key), *bounds, n, min_step).alias("split_id"))
    )
    counts = tagged.groupBy("split_id").agg(F.count(F.lit(1)).alias("rows"))
    joined = listed.join(counts, "split_id", "full_outer")
    return joined.select("split_id", "lo", "hi", F.coalesce("rows", F.lit(0)).alias("rows"))


def range_predicates(
    key: str, ranges: Sequence[Range], where: str | None = None, null_split: bool = True
) -> list[str]:
    """One SQL predicate per split, each joined with the caller's filter.

    Inner bounds are half-open and the outer ones left off, so fractional keys
    and rows outside the sampled bounds still belong to exactly one split.
    """
    tests = []
    for i, (lo, _) in enumerate(ranges):
        lower = f"{key} >= {lo}" if i else ""
        upper = f"{key} < {ranges[i + 1][0]}" if i + 1 < len(ranges) else ""
        tests.append(" AND ".join(t for t in (lower, upper) if t) or f"{key} IS NOT NULL")
    if null_split:
        tests.append(f"{key} IS NULL")
    if where and where.strip():
        return [f"({where}) AND ({test})" for test in tests]
    return tests


def read_range_partitioned(
    df: DataFrame,
    key: str,
    n: int,
    where: str | None = None,
    columns: Sequence[str] | None = None,
    min_step: int = 0,
) -> DataFrame:
    """All rows passing ``where`` with the split each belongs to.

    Bounds come from the whole table, as the splits do not depend on the filter.
    The tag is a narrow projection; rows are not moved, so a crowded key range
    never becomes one task.
    """
    bounds = key_bounds(df, key)
    rows = df.where(where) if where and where.strip() else df
    tag = F.lit(0) if bounds is None else split_id(column(key), *bounds, n, min_step)
    return rows.select(*[column(c) for c in (columns or df.columns)], tag.alias("split_id"))


# ----------------------------------------------------------- row-key ranges


def rowkey_bounds(start: str, end: str, n: int) -> list[str]:
    """Split points between two row keys: even for numbers, suffixed otherwise."""
    try:
        lo, hi = int(start), int(end)
    except ValueError:
        inner = [f"{start}_split{i}" for i in range(1, n)]
    else:
        inner = []
        for i in range(1, n):
            product = (hi - lo) * i
            inner.append(str(lo + (abs(product) // n) * (1 if product >= 0 else -1)))
    return [start, *inner, end]


def rowkey_range_splits(df: DataFrame, rowkey: str, start: str, end: str, n: int) -> DataFrame:
    """Rows inside ``[start, end)`` in text order with the range that scans them.

    Ranges of unpadded numbers may overlap in text order; a row is then read by
    the first range that covers it, never twice.
    """
    bounds = rowkey_bounds(start, end, n)
    key = column(rowkey).cast("string")
    found = None
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        inside = (key >= lo) & (key < hi)
        found = F.when(inside, F.lit(i)) if found is None else found.when(inside, F.lit(i))
    return df.withColumn("split_id", found).where(F.col("split_id").isNotNull())


# Keys looked at per split to place its bounds: sizes then vary by 1.6 % (one standard deviation).
KEYS_PER_SPLIT = 4096


def region_bounds(df: DataFrame, rowkey: str, n: int, keys_per_split: int = KEYS_PER_SPLIT) -> list[str]:
    """At most ``n - 1`` row keys that cut the distinct keys into ``n`` regions of about equal size.

    Keys are drawn by their hash, so a row of many cells counts once and reruns
    agree; tables of fewer keys than are drawn get exact bounds. Two narrow
    scans of the key column, nothing is sorted but the drawn keys, of which
    there are ``n * keys_per_split`` whatever the table's size.
    """
    if n < 1:
        raise ValueError("the number of regions must be positive")
    key = column(rowkey).cast("string")
    keys = df.select(key.alias("key")).where("key is not null")
    wanted = n * keys_per_split
    held = keys.agg(F.approx_count_distinct("key", 0.02)).head()[0]
    if held > wanted:
        share = wanted / held
        # A hash is a whole number of 64 bits; the lowest share of them is taken.
        keys = keys.where(F.xxhash64("key") < F.lit(int(-(1 << 63) + share * (1 << 64))))
    drawn = [r[0] for r in keys.distinct().orderBy("key").collect()]
    places = [len(drawn) * i // n for i in range(1, n)]
    # Spark orders text by its UTF-8 bytes, and so were these sorted.
    return list(dict.fromkeys(drawn[p] for p in places if 0 < p < len(drawn)))


def rowkey_region_splits(
    df: DataFrame, rowkey: str, n: int, keys_per_split: int = KEYS_PER_SPLIT
) -> DataFrame:
    """All rows, each with the region its key lies in; null keys get a region of their own, ``n``.

    The first region has no lower and the last no upper bound, so no key is
    skipped. The tag is narrow: a search tree of the bounds, no join and no shuffle.
    """
    bounds = region_bounds(df, rowkey, n, keys_per_split)
    key = column(rowkey).cast("string")

    def region(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(key < F.lit(bounds[middle]), region(lo, middle)).otherwise(region(middle + 1, hi))

    return df.withColumn("split_id", F.when(key.isNull(), F.lit(n)).otherwise(region(0, len(bounds))).cast("int"))
