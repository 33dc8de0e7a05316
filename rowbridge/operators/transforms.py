"""Row transformers as DataFrame -> DataFrame steps and their registry.

Parameters keep the names used in job files (``columnIndex``, ``oldValue`` ...).
A missing ``columnIndex`` means every column, indexes outside the row are
ignored. All built-in steps are column expressions, so a chain collapses into
one projection plus its filters.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column
from rowbridge.functions.kinds import DATE, LONG, kind_of, render

Transform = Callable[[DataFrame, dict], DataFrame]

_BLANKS = "".join(map(chr, range(0x21)))
_REGISTRY: dict[str, Transform] = {}


def register(name: str, transform: Transform | None = None):
    """Register a transform under a case-insensitive name (also a decorator)."""

    def add(fn: Transform) -> Transform:
        _REGISTRY[name.lower()] = fn
        return fn

    return add(transform) if transform is not None else add


def register_batches(name: str, fn: Callable, schema: str | T.StructType | None = None) -> None:
    """Register a function over pandas batches: ``fn(batch, parameter) -> batch``.

    Batches arrive through Arrow; ``schema`` is needed when columns change. A
    function of a module needs that module on the executors (``--py-files``).
    """

    def run(df: DataFrame, parameter: dict) -> DataFrame:
        def each(batches):
            for batch in batches:
                yield fn(batch, parameter)

        return df.mapInPandas(each, schema or df.schema)

    register(name, run)


def lookup(name: str) -> Transform:
    """A registered transform, or an importable ``package.module.function``."""
    found = _REGISTRY.get(name.lower())
    if found is not None:
        return found
    module, _, attribute = name.rpartition(".")
    if module:
        try:
            return getattr(importlib.import_module(module), attribute)
        except (ImportError, AttributeError) as error:
            raise ValueError(f"unknown transformer: {name}") from error
    raise ValueError(f"unknown transformer: {name}")


def apply_chain(df: DataFrame, steps: Iterable[str | dict] | None) -> DataFrame:
    """Apply the steps in order; a step is a name or ``{name, parameter}``."""
    for step in steps or []:
        if isinstance(step, str):
            name, parameter = step, {}
        else:
            name, parameter = step["name"], step.get("parameter") or {}
        df = lookup(name)(df, parameter)
    return df


def _indexes(parameter: dict) -> list[int] | None:
    given = parameter.get("columnIndex")
    if given is None:
        return None
    return [int(i) for i in (given if isinstance(given, (list, tuple, set)) else [given])]


def _text(parameter: dict, key: str) -> str | None:
    value: Any = parameter.get(key)
    if isinstance(value, bool):
        return "true" if value else "false"
    return None if value is None else str(value)


def _map_cells(
    df: DataFrame, parameter: dict, change: Callable[[Column, T.DataType], Column | None]
) -> DataFrame:
    chosen = _indexes(parameter)
    cells = []
    for i, field in enumerate(df.schema.fields):
        cell = column(field.name)
        changed = change(cell, field.dataType) if chosen is None or i in chosen else None
        cells.append(cell if changed is None else changed.alias(field.name))
    return df.select(*cells)


def _is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StringType)


@register("trim")
def trim(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """Strip every character up to U+0020 from both ends of text cells."""
    return _map_cells(
        df,
        parameter or {},
        lambda cell, kind: F.trim(cell, F.lit(_BLANKS)) if _is_text(kind) else None,
    )


@register("replace")
def replace(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """Literal replacement in text cells; does nothing unless both values are given."""
    parameter = parameter or {}
    old, new = _text(parameter, "oldValue"), _text(parameter, "newValue")
    if old is None or new is None:
        return df
    if old == "":
        raise ValueError("replace: oldValue must not be empty")
    return _map_cells(
        df,
        parameter,
        lambda cell, kind: F.replace(cell, F.lit(old), F.lit(new)) if _is_text(kind) else None,
    )


def filter_condition(cell: Column, data_type: T.DataType, op: str, value: str) -> Column:
    """Text comparison for ``=``/``!=`` (null-safe), numeric comparison otherwise."""
    if op in ("=", "!="):
        same = render(cell, data_type).eqNullSafe(F.lit(value))
        return same if op == "=" else ~same
    if kind_of(data_type) == LONG or isinstance(data_type, T.DoubleType):
        number = cell.cast("double")
    else:
        number = render(cell, data_type).try_cast("double")
    bound = F.lit(value).try_cast("double")
    tests = {
        ">": number > bound,
        "<": number < bound,
        ">=": number >= bound,
        "<=": number <= bound,
    }
    if op not in tests:
        raise ValueError(f"filter: unknown op {op}")
    # Spark orders NaN above every number; a comparison with NaN must fail.
    return tests[op] & ~F.isnan(number) & ~F.isnan(bound)


@register("filter")
def filter_rows(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """Keep rows whose cell at the smallest given index passes the test."""
    parameter = parameter or {}
    value, op = _text(parameter, "value"), _text(parameter, "op") or "="
    chosen = _indexes(parameter)
    if value is None or not chosen:
        return df
    index = min(chosen)
    if not 0 <= index < len(df.columns):
        return df
    field = df.schema.fields[index]
    return df.where(filter_condition(column(field.name), field.dataType, op, value))


@register("dateformat")
def dateformat(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """Re-format date text; text that does not parse stays as it is."""
    parameter = parameter or {}
    source, target = _text(parameter, "fromFormat"), _text(parameter, "toFormat")
    if source is None or target is None:
        return df

    def change(cell: Column, data_type: T.DataType) -> Column | None:
        if _is_text(data_type):
            parsed = F.try_to_timestamp(cell, F.lit(source))
            return F.coalesce(F.date_format(parsed, target), cell)
        if kind_of(data_type) == DATE:
            return F.date_format(cell, target)
        return None

    return _map_cells(df, parameter, change)


@register("md5encrypt")
def md5encrypt(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """Lower-case hex MD5 of text cells; other kinds stay unchanged."""
    return _map_cells(
        df, parameter or {}, lambda cell, kind: F.md5(cell) if _is_text(kind) else None
    )


@register("zeroonetoboolean")
def zero_one_to_boolean(df: DataFrame, parameter: dict | None = None) -> DataFrame:
    """0/1 in text and long cells become the text false/true."""

    def change(cell: Column, data_type: T.DataType) -> Column | None:
        if not _is_text(data_type) and kind_of(data_type) != LONG:
            return None
        text = cell.cast("string")
        return F.when(text == "0", "false").when(text == "1", "true").otherwise(text)

    return _map_cells(df, parameter or {}, change)
