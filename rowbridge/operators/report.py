"""Counts taken while a job runs, and the numbers reported afterwards."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class CountCheck:
    """Rows that passed the transformers against rows found in the sink."""

    read: int
    written: int

    @property
    def matched(self) -> bool:
        return self.read == self.written

    def as_dict(self) -> dict:
        return {**asdict(self), "matched": self.matched}


class RowCounter:
    """Counts the rows flowing past one point of a plan, without a job of its own.

    Watch rows above a global sort, not below: sorting reads its input twice.
    """

    def __init__(self, name: str) -> None:
        self._observation = Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        return self._observation.get["rows"]


def export_stats(df: DataFrame) -> DataFrame:
    """(files, columns, rows) of an export read back from its files.

    Rows are counted per file first, which combines before the shuffle, then
    summed. ``df`` must come straight from files.
    """
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def written_rows(spark: SparkSession, path: str, file_type: str, header: bool = False) -> int:
    """Rows found in the files below ``path``, whatever the plan that wrote them counted.

    Cells of text files hold no line feed, so their lines are rows; with
    ``header`` the first line of every file is not one.
    """
    if file_type not in ("csv", "txt"):
        return spark.read.format(file_type).load(path).count()
    found = export_stats(spark.read.option("lineSep", "\n").text(path)).head()
    return found["rows"] - (found["files"] if header else 0)
