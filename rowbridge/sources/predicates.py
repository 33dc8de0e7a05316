"""Range scans of Parquet tables that open only the files a range can be in.

A range-partitioned extraction runs one predicate per split. On a table of many
files each predicate would open every footer; here footers are read once, in
tasks, and tell per file the smallest and largest key and the number of nulls.
They also give the bounds of the whole key, so no rows are read for those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, quoted
from rowbridge.operators.splits import range_predicates, split_ranges

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BOUNDS = "path string, rows bigint, lo bigint, hi bigint, nulls bigint"


@dataclass(frozen=True)
class FileBounds:
    """What a footer tells of the key; ``lo``, ``hi`` and ``nulls`` are None where it does not tell."""

    path: str
    rows: int
    lo: int | None
    hi: int | None
    nulls: int | None

    @property
    def known(self) -> bool:
        """Whether the range is told; a file of nulls only has no range to tell."""
        return self.lo is not None or self.nulls == self.rows

    def may_hold(self, lo: int | None, hi: int | None) -> bool:
        """Whether a key of ``[lo, hi)`` can be in the file; None leaves an end open."""
        if not self.known:
            return self.rows > 0
        if self.lo is None:
            return False
        return (hi is None or self.lo < hi) and (lo is None or self.hi >= lo)

    @property
    def may_hold_null(self) -> bool:
        return self.rows > 0 if self.nulls is None else self.nulls > 0


@dataclass(frozen=True)
class RangeScan:
    """One split: its predicate and the files it opens."""

    split_id: int
    predicate: str
    files: tuple[str, ...]


def _footer(path: str, key: str) -> FileBounds | None:
    """Bounds from the footer of a file; None if only Spark can open its store."""
    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    try:
        system, inner = fs.FileSystem.from_uri(uri)
        opened = system.open_input_file(inner)
    except (pa.ArrowInvalid, OSError):
        return None
    with opened:
        footer = pq.ParquetFile(opened).metadata
    # A file written before the key was added to the table holds nulls only.
    places = [i for i in range(footer.num_columns) if footer.schema.column(i).path.lower() == key.lower()]
    if not places:
        return FileBounds(path, footer.num_rows, None, None, footer.num_rows)
    lows: list[int] = []
    highs: list[int] = []
    nulls: int | None = 0
    told = True
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        stats = group.column(places[0]).statistics
        held = None if stats is None or not stats.has_null_count else stats.null_count
        nulls = None if nulls is None or held is None else nulls + held
        if stats is not None and stats.has_min_max:
            lows.append(int(stats.min))
            highs.append(int(stats.max))
        elif held != group.num_rows:
            told = False
    if not told:
        return FileBounds(path, footer.num_rows, None, None, None)
    return FileBounds(path, footer.num_rows, min(lows, default=None), max(highs, default=None), nulls)


def _footers(listed: DataFrame, key: str) -> list[FileBounds]:
    """Bounds of the listed files, by tasks; ``rows`` is negative where the footer could not be read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [_footer(path, key) or FileBounds(path, -1, None, None, None) for path in paths]
            columns = {name: [getattr(f, name) for f in found] for name in ("path", "rows", "lo", "hi", "nulls")}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if n == "path" else pa.int64()) for n, v in columns.items()],
                names=list(columns),
            )

    return [FileBounds(**r.asDict()) for r in listed.mapInArrow(read, _BOUNDS).collect()]


def _scanned(table: DataFrame, key: str, files: Sequence[str]) -> list[FileBounds]:
    """Bounds by one scan of the key column."""
    path, cell = F.col("_metadata.file_path"), column(key)
    rows = table.where(path.isin(list(files))).groupBy(path.alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(cell).alias("lo"), F.max(cell).alias("hi"),
        F.count_if(cell.isNull()).alias("nulls"),
    )
    return [FileBounds(**r.asDict()) for r in rows.collect()]


def file_bounds(table: DataFrame, path: str, key: str) -> list[FileBounds]:
    """Bounds of ``key`` in each file of the table at ``path``, from the footers.

    Files are listed with the paths that Spark's own metadata give them, their
    content is not read. The driver gets one short row per file, as many as the
    paths it lists anyway. Files in a store that only Spark opens are scanned,
    their key column alone.
    """
    listed = table.sparkSession.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    found = _footers(listed, key)
    rest = [f.path for f in found if f.rows < 0]
    if rest:
        found = [f for f in found if f.rows >= 0] + _scanned(table, key, rest)
    return sorted(found, key=lambda f: f.path)


def range_scans(
    bounds: Sequence[FileBounds], key: str, n: int, where: str | None = None, min_step: int = 0
) -> list[RangeScan]:
    """The splits of the whole key range, each with the files that can hold it, nulls last.

    Every row with a key is in one split, also where the bounds of some files are
    not told: such a file is opened by all splits, and the outer splits are open.
    """
    name = quoted(key)
    lows = [b.lo for b in bounds if b.lo is not None]
    highs = [b.hi for b in bounds if b.hi is not None]
    if not lows:
        every = tuple(b.path for b in bounds if b.rows)
        return [RangeScan(0, where if where and where.strip() else "true", every)]
    ranges = list(split_ranges(min(lows), max(highs), n, min_step))
    tests = range_predicates(name, ranges, where)
    scans = []
    for i, test in enumerate(tests[:-1]):
        lo = ranges[i][0] if i else None
        hi = ranges[i + 1][0] if i + 1 < len(ranges) else None
        scans.append(RangeScan(i, test, tuple(b.path for b in bounds if b.may_hold(lo, hi))))
    scans.append(RangeScan(len(ranges), tests[-1], tuple(b.path for b in bounds if b.may_hold_null)))
    return scans


def predicate_scan(
    spark: SparkSession,
    path: str,
    key: str,
    n: int,
    where: str | None = None,
    columns: Sequence[str] | None = None,
    min_step: int = 0,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All rows of a Parquet table that pass ``where``, one scan per range of ``key``, with ``split_id``.

    Splits are those of ``read_range_partitioned``; null keys form split ``n``. A file
    is opened by the ranges that overlap its keys, and pushed predicates skip its
    other row groups. Files are picked by their path in the metadata, which Spark
    tests while it plans. Without any known bound all rows are split 0; an empty
    table gives no rows.
    """
    table = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    names = {f.name.lower(): f for f in table.schema.fields}
    if key.lower() not in names or not isinstance(names[key.lower()].dataType, WHOLE_NUMBERS):
        raise ValueError(f"a range scan needs a whole-number column, and {key} is none")
    chosen = [column(c) for c in (columns or table.columns)]
    found = None
    for scan in range_scans(file_bounds(table, path, key), key, n, where, min_step):
        if not scan.files:
            continue
        rows = table.where(F.col("_metadata.file_path").isin(list(scan.files))).where(scan.predicate)
        part = rows.select(*chosen, F.lit(scan.split_id).alias("split_id"))
        found = part if found is None else found.unionAll(part)
    return found if found is not None else table.where("false").select(*chosen, F.lit(0).alias("split_id"))
