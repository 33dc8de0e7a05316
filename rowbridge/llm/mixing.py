"""Mixing sources to target weights along a curriculum that varies over time.

Each source has a weight schedule over training progress 0 to 1, linear between
knots. Its integral is the source's share; shares of the whole demand, bounded
by ``max_repeats`` times the source's size, are its target, and what bounded
sources cannot take is shared again by weight. Within a source the documents
follow each other in a keyed random order, once per repeat, until the target is
met. The words taken before a document are a point of the source's cumulative
demand; inverting that curve gives the progress at which the document is due.
Documents of all sources are range-sorted by it.

Running sums never gather a source: documents are ordered by the hash of their
row within about sqrt(rows) hash ranges, and the ranges' sums give each its
offset. So a source with a third of all rows is as many tasks as any.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column, local_rows, stage
from rowbridge.llm.common import row_key, text_or_empty
from rowbridge.operators.numbering import number_rows

# Words are runs of anything but ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"

Knots = list[tuple[float, float]]


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORDS)).cast("long")


def schedules(spark, curriculum: list[Knots]) -> DataFrame:
    """(turn, knots, integral): the schedule of the sources whose rank leaves ``turn``.

    ``curriculum`` is a parameter of a few entries; knots go from 0 to 1.
    ``knots`` holds segments (x0, w0, slope, before, area).
    """
    told, integrals = [], []
    for knots in curriculum:
        if knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
            raise ValueError("a schedule has knots from 0 to 1 and no negative weight")
        segments, before = [], 0.0
        for (x0, w0), (x1, w1) in zip(knots, knots[1:], strict=False):
            if x1 <= x0:
                raise ValueError("knots must ascend")
            area = (w0 + w1) / 2 * (x1 - x0)
            slope = (w1 - w0) / (x1 - x0)
            segments.append({"x0": float(x0), "w0": float(w0), "slope": slope, "before": float(before), "area": float(area)})
            before += area
        told.append(segments)
        integrals.append(float(before))
    # No Python worker: an idle one keeps its memory through the next stage of a pipeline.
    return local_rows(
        spark, {"turn": list(range(len(told))), "knots": told, "integral": integrals},
        "turn int, knots array<struct<x0:double,w0:double,slope:double,before:double,area:double>>, integral double",
    )


def progress_at(share: Column, knots: Column, integral: Column) -> Column:
    """Progress at which ``share`` (0 to 1) of a schedule's integral is reached."""
    due = share * integral

    def within(s: Column) -> Column:
        rest = F.least(F.greatest(due - s["before"], F.lit(0.0)), s["area"])
        # w0 * t + slope / 2 * t**2 = rest, in the form that stands a slope of zero
        root = F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * s["slope"] * rest, F.lit(0.0)))
        step = F.when(rest > 0, 2 * rest / (s["w0"] + root)).otherwise(0.0)
        return s["x0"] + step

    last = F.element_at(F.filter(knots, lambda s: (s["before"] <= due) & (s["area"] > 0)), -1)
    picked = F.transform(F.array(last), within)
    return F.least(F.element_at(picked, 1), F.lit(1.0))


def targets(sources: DataFrame, demand: float, max_repeats: float) -> DataFrame:
    """Add ``target`` to (…, size, integral): ``demand`` by weight, at most ``max_repeats`` sizes.

    Each round gives the sources not yet bounded their share and bounds those it
    would overfill; a round is an aggregate of one row, and no source leaves the
    bound again. Every source at its bound ends the rounds as well.
    """
    bound = F.col("size") * max_repeats
    level = 0.0
    while True:
        full = (F.col("integral") * level >= bound) if level else F.lit(False)
        row = sources.agg(
            F.sum(F.when(full, bound)).alias("taken"), F.sum(F.when(~full, F.col("integral"))).alias("weight")
        ).head()
        if not row.weight:
            return sources.withColumn("target", F.when(F.col("integral") > 0, bound).otherwise(0.0))
        reached = (demand - (row.taken or 0.0)) / row.weight
        if reached <= level * (1 + 1e-12):
            return sources.withColumn("target", F.least(bound.cast("double"), F.col("integral") * level))
        level = reached


def mix(
    docs: DataFrame,
    curriculum: list[Knots],
    share: float = 1.5,
    max_repeats: int = 2,
    source: str = "source",
    size: Callable[[], Column] | str = "size",
) -> DataFrame:
    """Every document with what the mix takes of it.

    Sources are ranked by code point, null last, and take the schedules of
    ``curriculum`` in turn. Returns (row: struct of the input columns, size,
    source_size, target, copies, taken, positions): ``positions`` has the
    progress of each copy. A null or negative size counts as 0; a document
    without words is never taken. An empty table gives an empty result. Rows
    equal in every column keep apart, but it is undefined which of them is cut
    at the end of a target.
    """
    spark = docs.sparkSession
    sized = column(size) if isinstance(size, str) else size()
    h1, h2 = row_key(docs)
    base = docs.select(
        F.struct("*").alias("row"),
        F.greatest(F.coalesce(sized.cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        F.coalesce(column(source).cast("string"), F.lit("")).alias("src"),
        column(source).isNull().alias("nosrc"),
        h1.alias("h1"),
        h2.alias("h2"),
    )
    buckets = isqrt(docs.count()) + 1
    place = F.shiftrightunsigned("h1", 11)  # 53 bits, exact as a double
    bucket = F.floor(place.cast("double") / float(1 << 53) * buckets).cast("int")
    base = base.withColumn("bucket", bucket)
    sums = stage(base.groupBy("src", "nosrc", "bucket").agg(F.sum("size").alias("sum")), "mix-buckets")
    per_source = stage(sums.groupBy("src", "nosrc").agg(F.sum("sum").alias("size")), "mix-sources")
    ranked = number_rows(per_source, ["nosrc", "src"], "rank")
    turns = schedules(spark, curriculum)
    # The curriculum is a handful of rows by its definition.
    weighed = stage(
        ranked.withColumn("turn", (F.col("rank") % len(curriculum)).cast("int")).join(F.broadcast(turns), "turn"),
        "mix-weights",
    )
    total = weighed.agg(F.sum("size")).head()[0] or 0
    aimed = targets(weighed, share * total, float(max_repeats))
    before = Window.partitionBy("src", "nosrc").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("bucket_start", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        .drop("sum")
        .join(aimed.withColumnRenamed("size", "source_size"), ["src", "nosrc"])
        .select("src", "nosrc", "bucket", "bucket_start", "source_size", "target", "knots", "integral")
    )
    offsets = stage(offsets, "mix-offsets")
    inner = (
        Window.partitionBy("src", "nosrc", "bucket").orderBy(place, "h1", "h2").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = base.join(offsets, ["src", "nosrc", "bucket"]).withColumn(
        "start", F.col("bucket_start") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - whole * F.col("source_size")
    # The last repeat takes the documents whose middle lies before its end.
    extra = (F.col("start") + F.col("size") / 2.0 < rest).cast("int")
    copies = F.when(F.col("size") > 0, F.least(whole + extra, F.lit(max_repeats))).otherwise(0).cast("int")
    placed = placed.withColumn("copies", copies)

    def due(epoch: Column) -> Column:
        middle = epoch * F.col("source_size") + F.col("start") + F.col("size") / 2.0
        return progress_at(F.least(middle / F.col("target"), F.lit(1.0)), F.col("knots"), F.col("integral"))

    positions = F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), due)
    ).otherwise(F.array().cast("array<double>"))
    return placed.select(
        "row", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), positions.alias("positions"), "h1", "h2",
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, (row, position), range-sorted: documents not taken are gone."""
    copies = mixed.select("row", F.explode("positions").alias("position"), "h1", "h2")
    return copies.orderBy("position", "h1", "h2").select("row", "position")


def _file_place(name: str) -> tuple[int, int, str]:
    """Spark numbers part files by partition, and within one by turn."""
    found = re.match(r"part-(\d+)(?:.*-c(\d+))?", name)
    return (int(found[1]), int(found[2] or 0), name) if found else (sys.maxsize, 0, name)


def read_order(docs: DataFrame, name: str = "position") -> DataFrame:
    """Add the 0-based place that each row has in the written files, whatever order they are read in.

    ``docs`` are the files of one range-sorted output. Readers pack files by size,
    so the order is taken from names and places, with one offset per file.
    """
    hidden = docs.metadataColumn("_metadata")
    placed = docs.select("*", hidden["file_name"].alias("__file"), hidden["row_index"].alias("__row"))
    counts = placed.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()
    files = sorted(((c["__file"], c["n"]) for c in counts), key=lambda f: _file_place(f[0]))
    starts = list(accumulate((n for _, n in files), initial=0))
    offsets = local_rows(
        docs.sparkSession, {"__file": [f for f, _ in files], "__start": starts[: len(files)]}, "__file string, __start bigint"
    )
    return (
        placed.join(F.broadcast(offsets), "__file")
        .withColumn(name, F.col("__start") + F.col("__row"))
        .drop("__file", "__row", "__start")
    )
