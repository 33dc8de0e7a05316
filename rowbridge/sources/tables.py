"""Table, query and catalog scans."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rowbridge.common import quoted


def _braced(text: str) -> str:
    """SQL text safe to pass through the ``{name}`` parameters of ``spark.sql``."""
    return text.replace("{", "{{").replace("}", "}}")


def clean_where(where: str | None) -> str:
    """Filter text without a leading ``and``; empty when there is no filter."""
    return re.sub(r"^\s*and\b\s*", "", where or "", flags=re.IGNORECASE).strip()


def extract_table(
    source: DataFrame,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """``select columns from source where ... order by ...``.

    Filter and order may use columns that are not selected. Rows that tie in
    ``order_by`` are ordered by their hash, which also spreads a sort key value
    shared by many rows over several tasks.
    """
    cols = ", ".join(columns) if columns else "*"
    sql = f"select {_braced(cols)} from {{src}}"
    condition = clean_where(where)
    if condition:
        sql += f" where {_braced(condition)}"
    if order_by and order_by.strip():
        sql += f" order by {_braced(order_by)}, xxhash64(struct({_braced(cols)}))"
    return source.sparkSession.sql(sql, src=source)


def extract_query(
    spark: SparkSession,
    query: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    order_by: str | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """The same over a query; ``tables`` name DataFrames the query may use as ``{name}``."""
    return extract_table(spark.sql(query, **tables), columns, where, order_by)


def _catalog_item(item: str, types: dict[str, str]) -> str:
    name, _, alias = item.strip().rpartition(" ")
    if not name:
        name, alias = alias, ""
    name = name.strip()
    if re.search(r"\s+as$", name, re.IGNORECASE):
        name = re.sub(r"\s+as$", "", name, flags=re.IGNORECASE)
    bare = name.strip("`").split(".")[-1].strip("`")
    if bare.lower() not in types:
        return f"{name} as {quoted(alias)}" if alias else name
    text = types[bare.lower()].startswith(("varchar", "char"))
    expression = f"cast({quoted(bare)} as string)" if text else quoted(bare)
    return f"{expression} as {quoted(alias.strip('`') or bare)}"


def read_catalog_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """Scan a catalog table; items may be ``col``, ``table.col`` or ``col alias``."""
    table = spark.table(name)
    if not columns or list(columns) == ["*"]:
        columns = table.columns
    types = {
        f.name.lower(): f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString())
        for f in table.schema.fields
    }
    return extract_table(table, [_catalog_item(c, types) for c in columns], where, order_by)


def declared_columns(items: Sequence[str | dict] | None) -> list[tuple[str, str]]:
    """(name, kind) pairs of a job's column list; entries without a name are dropped."""
    result = []
    for item in items or []:
        if isinstance(item, str):
            result.append((item, "STRING"))
        elif item.get("name"):
            result.append((item["name"], (item.get("type") or "STRING").upper()))
    return result
