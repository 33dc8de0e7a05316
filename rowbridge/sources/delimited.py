"""Delimited text without quoting: every cell is text, the separator is literal."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names accepted for separators.
SEPARATORS = {
    "\\t": "\t",
    "tab": "\t",
    "\\n": "\n",
    "\\r": "\r",
    "comma": ",",
    "pipe": "|",
    "space": " ",
}
# The characters of which a line counts as blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def separator(name: str | None) -> str:
    return "," if name is None else SEPARATORS.get(name, name)


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip_header: bool = False) -> DataFrame:
    """Non-blank lines as ``value``; with ``skip_header`` without each file's first line.

    The CSV reader knows where a file begins even when it is read in pieces.
    A line holds neither ``\\r`` nor ``\\n``, so with these as separator and
    quote the reader passes each line through whole.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    if not files:
        raise ValueError("no input path given")
    if skip_header:
        lines = spark.read.csv(
            files, schema="value string", sep="\r", quote="\n", escape="\n", header=True, enforceSchema=True
        )
    else:
        lines = spark.read.text(files).select("value")
    return lines.where(F.trim("value", F.lit(WHITESPACE)) != "")


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str | None = ",",
    skip_header: bool = False,
) -> DataFrame:
    """Text cells of one or many files; cells a short line lacks are null."""
    parts = F.split(F.col("value"), re.escape(separator(sep)), -1)
    lines = read_lines(spark, paths, skip_header)
    return lines.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])
