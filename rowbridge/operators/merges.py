"""Insert, ignore, update and replace of a source into a keyed target.

Every function returns the merged table as a DataFrame; key columns are
compared all together. ``order_by`` gives the order in which source rows
arrive: the first one per key wins for *ignore*, the last one otherwise.
Rows that tie get a fixed order by their hash.

There is one plan for any size: the reduced source is written once and joined
without hints, so Spark broadcasts it below its threshold and else shuffles. Repeated
source keys are reduced by an aggregate, which combines before the shuffle, so
a key holding a large share of the source does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column, row_hash, stage

_HIT = "__hit"


class DuplicateKeyError(ValueError):
    """A plain insert met a key that already exists."""


def _listed(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [column(k).isNull() for k in keys])


def _typed(source: DataFrame, target: DataFrame, keys: Sequence[str], names: Sequence[str]) -> list[Column]:
    """Source cells in the target's types; a null key fails the merge."""
    cells = []
    for name in names:
        cell, wanted = column(name), target.schema[name].dataType
        if source.schema[name].dataType != wanted:
            cell = cell.cast(wanted)
        if name in keys and source.schema[name].nullable:
            cell = F.coalesce(cell, F.raise_error(f"null in key column {name}").cast(wanted))
        cells.append(cell.alias(name))
    return cells


def one_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str] | None, last: bool
) -> DataFrame:
    """The first or last row of every key."""
    names = [order_by] if isinstance(order_by, str) else list(order_by or [])
    rank = F.struct(*[column(n) for n in names], row_hash(df).alias("__row_hash"))
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[column(k) for k in keys]).distinct()
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(*[column(k) for k in keys]).agg(
        pick(F.struct(*[column(c) for c in rest]), rank).alias("__row")
    )
    return chosen.select(
        *[column(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def _prepare(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[str] | None,
    last: bool,
    unique: bool = False,
) -> DataFrame:
    """Source cells typed like the target, one row per key.

    Order columns outside the target ride along until a row is chosen.
    """
    names = [order_by] if isinstance(order_by, str) else list(order_by or [])
    extra = [c for c in names if c not in target.columns]
    kept = [c for c in source.columns if c not in extra]
    unknown = [c for c in kept if c not in target.columns]
    if unknown:
        raise ValueError(f"columns missing in the target: {unknown}")
    rows = source.select(*_typed(source, target, keys, kept), *[column(c) for c in extra])
    if not unique:
        rows = one_per_key(rows, keys, names, last)
    return rows.select(*[column(c) for c in kept])


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[column(k) for k in keys])


def _staged(rows: DataFrame) -> DataFrame:
    """The reduced source, evaluated once: every plan below reads it more than once.

    Joins carry no hints: Spark broadcasts the files if they are below its
    threshold and else shuffles, splitting skewed keys at run time.
    """
    return stage(rows, "merge-source")


def _unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, reading only the target's keys."""
    present = _keys_of(target, keys).where(~_any_null(keys))
    return source.join(present, list(keys), "left_anti")


def _padded(df: DataFrame, target: DataFrame) -> DataFrame:
    """Target layout; columns the source does not list become null."""
    return df.select(
        *[
            column(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def conflicting_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a plain insert would write twice."""
    wanted = _keys_of(source, keys)
    repeated = wanted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    present = _keys_of(target, keys)
    existing = wanted.join(present, list(keys), "left_semi")
    return repeated.unionByName(existing)


def rows_with_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source holds.

    The source's keys are made distinct first, so a key that fills it does not crowd one task.
    """
    wanted = source.select(*_typed(source, target, keys, list(keys))).distinct()
    return target.where(~_any_null(keys)).join(wanted, list(keys), "left_semi")


def added_by_insert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str] = (), check: bool = True
) -> DataFrame:
    """The rows a plain insert adds; an existing or repeated key raises DuplicateKeyError."""
    keys = _listed(keys)
    rows = _staged(_prepare(target, source, keys, None, last=True, unique=True))
    if keys and check:
        clash = conflicting_keys(target, rows, keys).head(1)
        if clash:
            raise DuplicateKeyError(f"duplicate key {clash[0].asDict()}")
    return _padded(rows, target)


def merge_insert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str] = (), check: bool = True
) -> DataFrame:
    """Target plus source; an existing or repeated key raises DuplicateKeyError."""
    return target.unionByName(added_by_insert(target, source, keys, check))


def added_by_ignore(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """The first source row of every key the target lacks."""
    keys = _listed(keys)
    if not keys:
        raise ValueError("this merge needs key columns")
    rows = _prepare(target, source, keys, order_by, last=False, unique=unique)
    return _padded(_unmatched(_staged(rows), target, keys), target)


def merge_ignore(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Existing rows win; of several new rows with one key the first wins."""
    return target.unionByName(added_by_ignore(target, source, keys, order_by, unique))


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Matched rows take the source's columns, nulls included; others are added.

    Columns the source does not list keep the target's value.
    """
    keys = _listed(keys)
    if not keys:
        raise ValueError("this merge needs key columns")
    rows = _prepare(target, source, keys, order_by, last=True, unique=unique)
    rows = _staged(rows)
    listed = [c for c in rows.columns if c not in keys]
    renamed = rows.select(
        *[column(k) for k in keys],
        *[column(c).alias(f"__new_{c}") for c in listed],
        F.lit(True).alias(_HIT),
    )
    updated = [
        F.when(F.col(_HIT), column(f"__new_{c}")).otherwise(column(c)).alias(c)
        if c in listed
        else column(c)
        for c in target.columns
    ]
    # Null keys match nothing; kept out of the join they cannot crowd one task.
    keyed = target.where(~_any_null(keys))
    changed = keyed.join(renamed, list(keys), "left_outer").select(*updated)
    fresh = _padded(_unmatched(rows, target, keys), target)
    return changed.unionByName(fresh).unionByName(target.where(_any_null(keys)))


def merge_replace(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Matched rows are deleted and the source rows inserted whole."""
    keys = _listed(keys)
    if not keys:
        raise ValueError("this merge needs key columns")
    rows = _prepare(target, source, keys, order_by, last=True, unique=unique)
    rows = _staged(rows)
    gone = _keys_of(rows, keys)
    keyed = target.where(~_any_null(keys))
    kept = keyed.join(gone, list(keys), "left_anti").unionByName(target.where(_any_null(keys)))
    return kept.unionByName(_padded(rows, target))
