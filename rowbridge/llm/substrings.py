"""Removal of repeated passages: winnowed seeds, extension both ways, maximal repeats.

A text's words are hashed; every ``SEED``-word run has a rolling hash, and of
each ``length`` consecutive words the run with the smallest hash (the leftmost
of equals) is the anchor. The anchor depends on those words alone, so two equal
windows of ``length`` words have the same anchor at the same place, and each
window has exactly one. An anchor owns a row of consecutive windows.

1. Seeds: one narrow row per anchor. Anchors that occur once own no repeat.
2. Extension: an anchor extends left and right as far as the windows it owns
   reach. If all its occurrences extend to the same words, all those windows
   repeat, and nothing more is compared. Where occurrences extend differently,
   the windows of each are hashed and counted, so each occurrence is extended
   exactly as far as it agrees with any other.
3. Maximal repeats: the windows found in a text are merged into word ranges.

Occurrences are counted, never paired: counts combine before the shuffle, and a
passage in a million documents costs a million narrow rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, stage
from rowbridge.llm.common import row_key

LENGTH = 35
SEED = 8
# Texts of more words are hashed in blocks of this many, overlapping by a window.
BLOCK = 1 << 16
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # of bytes: ASCII white space only


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _runs(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words, modulo 2**64."""
    n = len(hashes) - width + 1
    total, factor = np.zeros(n, dtype=np.uint64), 1
    for i in range(width - 1, -1, -1):
        total += hashes[i : i + n] * np.uint64(factor)
        factor = factor * base % (1 << 64)
    return _mixed(total)


def anchors(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text with ``length`` words or more: seed hashes, and per anchor its place and its windows.

    The windows of an anchor start at ``low`` to ``high``.
    """
    seeds = _runs(hashes, SEED, _BASES[0])
    reach = length - SEED + 1
    starts = len(hashes) - length + 1
    owner = np.empty(starts, dtype=np.int64)
    for at in range(0, starts, BLOCK):
        view = sliding_window_view(seeds[at : at + BLOCK + reach - 1], reach)[: starts - at]
        owner[at : at + len(view)] = view.argmin(axis=1) + np.arange(at, at + len(view))
    changes = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    low = np.concatenate([[0], changes])
    high = np.concatenate([changes, [starts]]) - 1
    return seeds, owner[low], low, high


def _extents(hashes: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """Hash of all words an anchor's windows cover, and of where the anchor stands in them."""
    powers = np.empty(len(hashes) + 1, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(np.full(len(hashes), _BASES[1], dtype=np.uint64), out=powers[1:])
    # prefix[i] = sum of hash[j] * base**j: the difference, brought to a common power, is the hash of a range.
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:-1], dtype=np.uint64)])
    inverse = np.uint64(pow(_BASES[1], -1, 1 << 64))
    inverses = np.empty(len(hashes) + 1, dtype=np.uint64)
    inverses[0] = 1
    np.multiply.accumulate(np.full(len(hashes), inverse, dtype=np.uint64), out=inverses[1:])
    span = (prefix[high + length] - prefix[low]) * inverses[low]
    shape = (place - low).astype(np.uint64) * np.uint64(1 << 32) + (high - low).astype(np.uint64)
    return _mixed(_mixed(span) + shape * np.uint64(_BASES[0]))


def _seeded(length: int):
    names = ["h1", "h2", "anchor", "extent", "low", "high"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[np.ndarray]] = [[] for _ in names]
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
                words = split_words(text.as_py())
                if len(words) < length:
                    continue
                hashes = _word_hashes(words)
                seeds, place, low, high = anchors(hashes, length)
                row = (
                    np.full(len(low), k1, dtype=np.int64),
                    np.full(len(low), k2, dtype=np.int64),
                    seeds[place].view(np.int64),
                    _extents(hashes, place, low, high, length).view(np.int64),
                    low.astype(np.int32),
                    high.astype(np.int32),
                )
                for column_values, values in zip(made, row, strict=True):
                    column_values.append(values)
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in made], names=names)

    return run


def _windows(length: int):
    """(window, window2, h1, h2, start) for the windows of the listed anchors."""
    names = ["window", "window2", "h1", "h2", "start"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[np.ndarray]] = [[] for _ in names]
            for i in range(batch.num_rows):
                k1, k2, text, ranges = (c[i].as_py() for c in batch.columns)
                hashes = _word_hashes(split_words(text))
                starts = np.unique(np.concatenate([np.arange(r["low"], r["high"] + 1) for r in ranges]))
                for at in range(0, len(starts), BLOCK):
                    some = starts[at : at + BLOCK]
                    totals = []
                    for base in _BASES:
                        total, factor = np.zeros(len(some), dtype=np.uint64), 1
                        for j in range(length - 1, -1, -1):
                            total += hashes[some + j] * np.uint64(factor)
                            factor = factor * base % (1 << 64)
                        totals.append(_mixed(total).view(np.int64))
                    row = (*totals, np.full(len(some), k1), np.full(len(some), k2), some.astype(np.int32))
                    for column_values, values in zip(made, row, strict=True):
                        column_values.append(values)
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in made], names=names)

    return run


def repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Windows that repeat: (h1, h2, ranges of first and last window start) per row key of ``docs``.

    Rows equal in every column share a key; their windows occur once per row.
    Only rows with a repeat appear.
    """
    h1, h2 = row_key(docs)
    source = docs.select(h1.alias("h1"), h2.alias("h2"), column(text).cast("binary").alias("text"))
    seeds = stage(
        source.mapInArrow(_seeded(length), "h1 long, h2 long, anchor long, extent long, low int, high int"),
        "substring-seeds",
    )
    counted = seeds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("extent").alias("least"), F.max("extent").alias("most")
    )
    known = stage(
        counted.where("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("same")), "substring-anchors"
    )
    repeated = seeds.join(known, "anchor")
    found = stage(
        repeated.groupBy("h1", "h2").agg(
            F.collect_set(F.when(F.col("same"), F.struct("low", "high"))).alias("sure"),
            F.collect_set(F.when(~F.col("same"), F.struct("low", "high"))).alias("open"),
        ),
        "substring-found",
    )
    open_rows = found.where(F.size("open") > 0).select("h1", "h2", "open")
    asked = source.join(open_rows, ["h1", "h2"]).select("h1", "h2", "text", "open")
    windows = stage(
        asked.mapInArrow(_windows(length), "window long, window2 long, h1 long, h2 long, start int"), "substring-windows"
    )
    common = stage(
        windows.groupBy("window", "window2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "substring-common",
    )
    more = (
        windows.join(common, ["window", "window2"])
        .groupBy("h1", "h2")
        .agg(F.collect_set("start").alias("starts"))
        .select("h1", "h2", F.transform("starts", lambda s: F.struct(s.alias("low"), s.alias("high"))).alias("ranges"))
    )
    both = found.where(F.size("sure") > 0).select("h1", "h2", F.col("sure").alias("ranges")).unionByName(more)
    return stage(
        both.groupBy("h1", "h2").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "substring-ranges"
    )


def maximal(ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Word ranges [start, end) that the windows cover, merged where they touch or overlap."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges or ()):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high + length))
        else:
            merged.append((low, high + length))
    return merged


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Set ``text`` to the words left, joined by one space, and add ``n_words`` and ``spans``.

    ``spans`` are the maximal repeats as word ranges [start, end) of the input.
    A null or blank text has no words and becomes empty. An input column with
    the name of an output gives way to it.
    """
    found = repeats(docs, text, length)
    h1, h2 = row_key(docs)
    outputs = {text.lower(), "n_words", "spans"}
    kept = [f for f in docs.schema.fields if f.name.lower() not in outputs]
    source = docs.select(
        h1.alias("h1"), h2.alias("h2"), column(text).cast("binary").alias("text"),
        F.struct(F.lit(0).alias("_"), *[column(f.name) for f in kept]).alias("row"),
    )
    joined = source.join(found, ["h1", "h2"], "left").select("row", "text", "ranges")
    row_type = joined.schema["row"]
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType(
        [row_type, T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("spans", span)]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, counts, spans = [], [], []
            for raw, ranges in zip(batch.column(1), batch.column(2), strict=True):
                words = split_words(raw.as_py())
                cut = maximal(ranges.as_py(), length)
                left, at = [], 0
                for start, end in cut:
                    left += words[at:start]
                    at = end
                texts.append(b" ".join(left + words[at:] if cut else words))
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in cut])
            made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(spans, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    clean = joined.mapInArrow(run, schema)
    return clean.select(
        *[F.col("row").getField(f.name).alias(f.name) for f in kept], F.col("text").alias(text), "n_words", "spans"
    )
