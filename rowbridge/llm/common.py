"""What the corpus operators share: words, row keys, unused names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column

# White space is ASCII only, so a word is a run of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def unused(names: Iterable[str], wanted: str) -> str:
    """``wanted``, or a name like it that no column has (names ignore case)."""
    taken = {n.lower() for n in names}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def put(df: DataFrame, **values: Column) -> DataFrame:
    """Set columns; an input column of the same name (in any case) gives way."""
    clashing = {n.lower() for n in values}
    kept = [column(n) for n in df.columns if n.lower() not in clashing]
    return df.select(*kept, *[v.alias(n) for n, v in values.items()])


def text_or_empty(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """128 bits that identify a row by its values.

    They are the same whenever and wherever the row is read again, so they
    survive lost executors; rows equal in every column share them.
    """
    cells = [
        F.to_json(F.struct(column(f.name))) if "map<" in f.dataType.simpleString() else column(f.name)
        for f in df.schema.fields
    ]
    # Nulls leave a hash unchanged: the pattern of nulls is hashed as well.
    nulls = F.concat(F.lit(""), *[column(f.name).isNull().cast("string") for f in df.schema.fields])
    return F.xxhash64(nulls, *cells), F.xxhash64(F.lit(1), *cells, nulls)


def first_rows(
    rows: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank", parts: tuple[int, ...] = (4096, 64)
) -> DataFrame:
    """The first ``k`` rows of every group with their ``rank`` (int, from 1), in rounds of bounded groups.

    Each round deals the rows of a group to fewer parts by the hash of the row
    and keeps the first ``k`` of each, so no task gets all rows of a group.
    """
    place = unused(rows.columns, "__place")
    for n in parts:
        part = F.pmod(F.xxhash64(*[column(c) for c in rows.columns]), F.lit(n))
        window = Window.partitionBy(*[column(c) for c in by], part).orderBy(*order)
        rows = rows.withColumn(place, F.row_number().over(window)).where(F.col(place) <= k).drop(place)
    window = Window.partitionBy(*[column(c) for c in by]).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(column(rank) <= k)


_KEY_BITS = 23


def key_bits(keys: DataFrame, key: Column) -> DataFrame:
    """A table of 2^23 bits, one set for each key (a long); at most 2^17 rows of (word, bits) whatever the keys."""
    slot = key.bitwiseAND(F.lit((1 << _KEY_BITS) - 1))
    told = keys.select(slot.alias("slot"))
    bit = "bit_or(shiftleft(1L, cast(slot & 63 as int))) as bits"
    return told.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr(bit))


def may_hold(rows: DataFrame, key: Column, bits: DataFrame, name: str = "may_hold") -> DataFrame:
    """Add ``name``: false for a key that surely is not among those of ``bits``, which is sent to all tasks."""
    slot = key.bitwiseAND(F.lit((1 << _KEY_BITS) - 1))
    word, held = unused([*rows.columns, name], "__word"), unused([*rows.columns, name], "__bits")
    sent = F.broadcast(bits.select(F.col("word").alias(word), F.col("bits").alias(held)))
    found = rows.withColumn(name, slot).join(sent, F.shiftright(column(name), 6) == column(word), "left")
    place = column(name).bitwiseAND(F.lit(63)).cast("int")
    set_here = F.getbit(F.coalesce(column(held), F.lit(0).cast("long")), place) == 1
    return found.withColumn(name, set_here).drop(word, held)
