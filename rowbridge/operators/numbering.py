"""Exact global row numbers without a single-task window.

The rows are written once to the shared folder together with the position they
had (partition and place in it). Positions are then data, so a lost executor
cannot shift them; per-partition counts give each partition its offset. The
offsets are one row per partition, which bounds their broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowbridge.common import column, local_rows, row_hash, stage

_POSITION = "__position"
# Fixed value: monotonically_increasing_id keeps the place in the low 33 bits.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column] | None = None, name: str = "row_id"
) -> DataFrame:
    """Add a gap-free 0-based row number following ``order_by``.

    Equal sort keys are spread and ordered by the hash of the row, so one key
    value holding many rows is still sorted by many tasks. Without ``order_by``
    the rows keep the order in which they are read. The plan is the same for any
    number of rows: a range sort, staged with places, and one offset per partition.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*order_by, row_hash(df)) if order_by else df
    positioned = ordered.select("*", F.monotonically_increasing_id().alias(_POSITION))
    staged = stage(positioned, "numbered")
    return _numbered_by_position(spark, staged, name)


def _numbered_by_position(spark: SparkSession, staged: DataFrame, name: str) -> DataFrame:
    partition = F.shiftright(F.col(_POSITION), _PLACE_BITS)
    place = F.col(_POSITION).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counts = sorted(
        staged.groupBy(partition.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    starts = list(accumulate((c["n"] for c in counts), initial=0))
    offsets = local_rows(
        spark,
        {"__p": [c["p"] for c in counts], "__start": starts[: len(counts)]},
        "__p bigint, __start bigint",
    )
    return (
        staged.join(F.broadcast(offsets), partition == F.col("__p"))
        .withColumn(name, F.col("__start") + place)
        .drop("__p", "__start", _POSITION)
    )


def row_chunks(
    df: DataFrame, rows: int, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Add ``row_id`` and ``chunk_id``: every chunk but the last has exactly ``rows`` rows."""
    if rows < 1:
        raise ValueError("chunk size must be positive")
    numbered = number_rows(df, order_by)
    return numbered.withColumn("chunk_id", F.call_function("div", F.col("row_id"), F.lit(rows)))


def column_chunks(numbered: DataFrame, carry: Sequence[str] = ("row_id",)) -> DataFrame:
    """Long form of text columns: (carry..., col_idx, value), one scan for all columns.

    ``col_idx`` counts the columns from 1.
    """
    names = [c for c in numbered.columns if c not in carry]
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("col_idx"), column(c).cast("string").alias("value"))
            for i, c in enumerate(names, 1)
        ]
    )
    return numbered.select(*carry, F.inline(cells))
