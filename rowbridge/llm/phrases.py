"""Phrase collocations from counting quotient filters.

Only words that are frequent in their language can be in a frequent phrase, so
these get numbers, and texts become runs of numbers. An n-gram is packed from
its numbers and permuted: the last number is xored with a hash of the others, which
can be undone. The result is the quotient, the other numbers are the
remainder, kept in full, so counters are lossless. A task's filter holds the
counters sorted by quotient and remainder; it is cut into shards by the top
bits of the quotient and written as gaps and small integers. The filters of a
shard are merged one shard at a time.

Longer n-grams are counted only where every pair of neighbours may be frequent:
a bit table of fixed size tells which pairs cannot be. It changes the work,
never the result.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.llm.common import first_rows, text_or_empty
from rowbridge.operators.numbering import number_rows

LEAST, LONGEST, FIRST = 100, 5, 2000


@dataclass(frozen=True)
class Limits:
    """Sizes of tables; results do not depend on them."""

    table_words: int = 1 << 18  # words counted at once in a task
    block_words: int = 1 << 20  # words of one dictionary
    chunk_ids: int = 1 << 16  # numbers in one row of runs
    filter_rows: int = 1 << 20  # n-grams before a filter is made
    filter_kept: int = 1 << 19  # counters above which a filter is handed on
    least_shards: int = 1 << 10
    shard_rows: int = 1 << 20  # n-grams for a shard more
    pair_bits: int = 26  # the table of pairs has two to the power of so many bits


LIMITS = Limits()
# Longer words are known by a digest in the dictionary, so its size is bounded.
_WORD_BYTES = 64
# White space and marks that end a piece; "." stands for all of those.
_BREAK = b"."
_LETTERS = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else 0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c for c in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; a break stands where a piece ends."""
    return text.translate(_LETTERS).replace(_BREAK, b" . ").split()


def _short(word: bytes) -> bytes:
    # No word has a space in it.
    return word if len(word) <= _WORD_BYTES else b" " + hashlib.sha256(word).digest()


def _word_counts(texts: DataFrame, limits: Limits) -> DataFrame:
    """(lang, word, n); a null word has the number of all words."""

    def counted(found: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, numbers = [], [], []
        for lang, counts in found.items():
            counts.pop(_BREAK, None)
            langs += [lang] * (len(counts) + 1)
            words += [*counts, None]
            numbers += [*counts.values(), counts.total()]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(numbers, pa.int64())], names=["lang", "word", "n"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[lang].update(tokens(text.as_py()))
                if sum(map(len, found.values())) > limits.table_words:
                    yield counted(found)
                    found.clear()
        if found:
            yield counted(found)

    told = texts.mapInArrow(run, "lang string, word binary, n long")
    return told.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _runs(ids: np.ndarray) -> np.ndarray:
    """Numbers of two and more in a row, each run ended by a 0."""
    known = ids != 0
    paired = np.zeros(len(ids), dtype=bool)
    both = known[:-1] & known[1:]
    paired[:-1] |= both
    paired[1:] |= both
    after = np.concatenate(([False], paired[:-1]))
    kept = np.where(paired, ids, 0)[paired | after]
    return np.append(kept, np.int32(0)) if len(kept) and kept[-1] else kept


def _numbered(texts: DataFrame, words: DataFrame, n_words: int, limits: Limits) -> DataFrame:
    """(ids binary): int32 numbers of frequent words, runs of them parted by 0.

    Dictionaries are sent in blocks of ``block_words``; one block is the usual case, several
    take a pass each.
    """
    starts = range(0, max(n_words, 1), limits.block_words)
    told = texts.withColumn("ids", F.lit(None).cast("binary"))
    for start in starts:
        block = words.where((F.col("id") > start) & (F.col("id") <= start + limits.block_words)).select("lang", "word", "id").toArrow()
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        for lang, word, number in zip(*(block.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
            known[lang][_short(word)] = number
        last = start == starts[-1]
        told = _looked_up(told, dict(known), last, limits.chunk_ids)
        if not last:
            told = stage(told, "phrase-numbers")
    return told


def _looked_up(told: DataFrame, known: dict[str, dict[bytes, int]], last: bool, chunk_ids: int) -> DataFrame:
    long_words = any(w[:1] == b" " for d in known.values() for w in d)

    def numbers(lang: str, text: bytes, before: bytes | None) -> np.ndarray:
        get = known.get(lang, {}).get
        words = tokens(text)
        if long_words:
            words = map(_short, words)
        found = np.array([get(w, 0) for w in words], dtype=np.int32)
        return found if before is None else found + np.frombuffer(before, dtype=np.int32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True)
            if last:
                chunk, size = [], 0
                for lang, text, before in rows:
                    chunk.append(_runs(numbers(lang, text.as_py(), before.as_py())))
                    size += len(chunk[-1])
                    if size >= chunk_ids:
                        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(chunk).tobytes()], pa.binary())], names=["ids"])
                        chunk, size = [], 0
                if size:
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(chunk).tobytes()], pa.binary())], names=["ids"])
            else:
                for i, (lang, text, before) in enumerate(rows):
                    ids = pa.array([numbers(lang, text.as_py(), before.as_py()).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*[c.slice(i, 1) for c in batch.columns[:2]], ids], names=["lang", "text", "ids"])

    return told.mapInArrow(run, "ids binary" if last else "lang string, text binary, ids binary")


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of numbers."""
    h = np.full(len(words[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for w in words:
        h = (h ^ w.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


class Filter:
    """Counters of n-grams of one length, sorted by quotient and remainder.

    Keys are kept in as few 64-bit limbs as the quotient and the other numbers
    need at ``bits`` each.
    """

    def __init__(self, length: int, bits: int) -> None:
        self.length, self.bits = length, bits
        self.per_limb = 64 // bits
        self.n_limbs = -(-length // self.per_limb)

    def pack(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """Limbs of the permuted n-grams: quotient first, then all numbers but the last."""
        low = np.uint64((1 << self.bits) - 1)
        others = [w.astype(np.uint64) for w in words[:-1]]
        fields = [(words[-1].astype(np.uint64) ^ _mixed(others)) & low, *others]
        limbs = []
        for i in range(0, self.length, self.per_limb):
            limb = np.zeros(len(fields[0]), dtype=np.uint64)
            for f in fields[i : i + self.per_limb]:
                limb = limb << np.uint64(self.bits) | f
            limbs.append(limb)
        return limbs

    def _fields(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        low, fields = np.uint64((1 << self.bits) - 1), []
        for i, limb in zip(range(0, self.length, self.per_limb), limbs, strict=True):
            held = min(self.per_limb, self.length - i)
            fields += [limb >> np.uint64(self.bits * (held - 1 - j)) & low for j in range(held)]
        return fields

    def unpack(self, limbs: list[np.ndarray]) -> np.ndarray:
        """The n-grams, one row each."""
        quotient, *others = self._fields(limbs)
        last = quotient ^ _mixed(others) & np.uint64((1 << self.bits) - 1)
        return np.stack([*others, last], axis=1).astype(np.int32)

    def shards(self, limbs: list[np.ndarray], shard_bits: int) -> np.ndarray:
        held = min(self.per_limb, self.length)
        return limbs[0] >> np.uint64(self.bits * held - shard_bits)

    @staticmethod
    def merged(limbs: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Equal keys added up, in order."""
        order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
        limbs = [x[order] for x in limbs]
        first = np.ones(len(counts), dtype=bool)
        if len(counts):
            first[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in limbs])
        starts = np.flatnonzero(first)
        return [x[starts] for x in limbs], np.add.reduceat(counts[order], starts) if len(starts) else counts

    @staticmethod
    def _small(values: np.ndarray) -> np.ndarray:
        most = int(values.max(initial=0))
        return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))

    @classmethod
    def dumped(cls, limbs: list[np.ndarray], counts: np.ndarray) -> list[bytes]:
        """One text of bytes per array, its first byte the width: gaps of the first limb, other limbs, counts."""
        arrays = [cls._small(np.diff(limbs[0], prepend=np.uint64(0))), *map(cls._small, limbs[1:]), cls._small(counts)]
        return [bytes([a.itemsize]) + a.tobytes() for a in arrays]

    @staticmethod
    def loaded(parts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        arrays = [np.frombuffer(p, dtype=f"u{p[0]}", offset=1).astype(np.uint64) for p in parts]
        return [np.cumsum(arrays[0], dtype=np.uint64), *arrays[1:-1]], arrays[-1].astype(np.int64)


def _grams(ids: np.ndarray, length: int, pairs: np.ndarray) -> list[np.ndarray]:
    """The n-grams of a run of numbers; ``pairs`` tells where a pair may start."""
    n = len(ids) - length + 1
    if n <= 0:
        return [ids[:0]] * length
    ok = np.logical_and.reduce([pairs[j : j + n] for j in range(length - 1)])
    at = np.flatnonzero(ok)
    return [ids[at + j] for j in range(length)]


def _places(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a pair in the table of pairs."""
    h = _mixed([a, b])
    low = np.uint64((1 << bits) - 1)
    return (h & low).astype(np.int64), (h >> np.uint64(bits) & low).astype(np.int64)


def _may_be(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = np.ones(len(a), dtype=bool)
    bits = (len(table) << 6).bit_length() - 1
    for place in _places(a, b, bits):
        found &= (table[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return found


def _filters(
    numbered: DataFrame, lengths: list[int], bits: int, shard_bits: int, table: np.ndarray | None, limits: Limits
) -> DataFrame:
    """(length, shard, parts): the filters of every task, cut into shards."""

    def handed_on(kind: Filter, limbs: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        shards = kind.shards(limbs, shard_bits)
        starts = np.flatnonzero(np.diff(shards, prepend=shards[:1] + np.uint64(1)))
        ends = [*starts[1:], len(shards)]
        parts = [kind.dumped([x[a:b] for x in limbs], counts[a:b]) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind.length] * len(parts), pa.int32()), pa.array(shards[starts].astype(np.int64)), pa.array(parts, pa.list_(pa.binary()))],
            names=["length", "shard", "parts"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {n: Filter(n, bits) for n in lengths}
        held: dict[int, list] = {n: [] for n in lengths}
        new = dict.fromkeys(lengths, 0)

        def merged(n: int) -> tuple[list[np.ndarray], np.ndarray]:
            limbs = [np.concatenate([h[0][i] for h in held[n]]) for i in range(kinds[n].n_limbs)]
            new[n] = 0
            return kinds[n].merged(limbs, np.concatenate([h[1] for h in held[n]]))

        for batch in batches:
            for told in batch.column(0):
                ids = np.frombuffer(told.as_py(), dtype=np.int32)
                pairs = (ids[:-1] != 0) & (ids[1:] != 0)
                if table is not None:
                    at = np.flatnonzero(pairs)
                    pairs[at] = _may_be(table, ids[at], ids[at + 1])
                for n in lengths:
                    words = _grams(ids, n, pairs)
                    if not len(words[0]):
                        continue
                    held[n].append((kinds[n].pack(words), np.ones(len(words[0]), dtype=np.int64)))
                    new[n] += len(words[0])
                    if new[n] >= limits.filter_rows:
                        held[n] = [merged(n)]
                        if len(held[n][0][1]) > limits.filter_kept:
                            yield from handed_on(kinds[n], *held[n].pop())
        for n in lengths:
            if held[n]:
                yield from handed_on(kinds[n], *merged(n))

    return numbered.mapInArrow(run, "length int, shard long, parts array<binary>")


def _frequent(filters: DataFrame, bits: int, least: int) -> DataFrame:
    """(ids, n) of the n-grams counted ``least`` times, merging the filters shard by shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def kept() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            kind = Filter(now[0], bits)
            loaded = [kind.loaded(p) for p in parts]
            limbs = [np.concatenate([x[0][i] for x in loaded]) for i in range(kind.n_limbs)]
            limbs, counts = kind.merged(limbs, np.concatenate([x[1] for x in loaded]))
            often = counts >= least
            grams = kind.unpack([x[often] for x in limbs])
            ids = pa.ListArray.from_arrays(np.arange(0, grams.size + 1, kind.length, dtype=np.int32), pa.array(grams.ravel()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts[often])], names=["ids", "n"])

        for batch in batches:
            for length, shard, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (length, shard) != now:
                    yield from kept()
                    now, parts = (length, shard), []
                parts.append(told)
        yield from kept()

    dealt = filters.repartition("length", "shard").sortWithinPartitions("length", "shard")
    return dealt.mapInArrow(run, "ids array<int>, n long")


def _pair_table(pairs: DataFrame, bits: int) -> np.ndarray:
    """A bit table of the frequent pairs; its size is fixed whatever their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits - 6, dtype=np.uint64)
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy().reshape(-1, 2)
            for place in _places(ids[:, 0], ids[:, 1], bits):
                np.bitwise_or.at(table, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at].view(np.int64))], names=["at", "bits"])

    told = pairs.select("ids").mapInArrow(run, "at long, bits long")
    found = told.groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    table = np.zeros(1 << bits - 6, dtype=np.uint64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def frequent_grams(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang", limits: Limits = LIMITS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, grams): numbered frequent words, words per language, and all frequent n-grams.

    ``words`` is (lang, word, n, id), ``totals`` (lang, n), ``grams`` (ids, n) from one word on.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases have two words or more and come at least once")
    texts = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text).cast("binary").alias("text")
    )
    counted = stage(_word_counts(texts, limits).where(F.col("word").isNull() | (F.col("n") >= least)), "phrase-words")
    totals = counted.where("word is null").select("lang", "n")
    words = stage(number_rows(counted.where("word is not null")).withColumn("id", (F.col("row_id") + 1).cast("int")).drop("row_id"), "phrase-ids")
    n_words, occurrences = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
    if n_words >= 1 << 31:
        raise ValueError("more frequent words than a number of 31 bits tells apart")
    bits = max(int(n_words).bit_length(), 1)
    numbered = stage(_numbered(texts, words, n_words, limits), "phrase-runs")
    shards = max(limits.least_shards, int(occurrences) // limits.shard_rows)
    shard_bits = min(bits, (shards - 1).bit_length())
    pairs = stage(_frequent(_filters(numbered, [2], bits, shard_bits, None, limits), bits, least), "phrase-pairs")
    grams = words.select(F.array("id").alias("ids"), "n").unionByName(pairs)
    if longest > 2:
        table = _pair_table(pairs, limits.pair_bits)
        lengths = list(range(3, longest + 1))
        more = stage(_frequent(_filters(numbered, lengths, bits, shard_bits, table, limits), bits, least), "phrase-grams")
        grams = grams.unionByName(more)
    return words, totals, grams


def score_of(a: str, total: str, left: str, right: str) -> Column:
    """floor(1000 a total / (left right)), with products of up to 38 digits."""
    a, total, left, right = (F.col(c).cast("decimal(19,0)") for c in (a, total, left, right))
    return F.call_function("div", (a * 1000).cast("decimal(19,0)") * total, left * right)


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    first: int = FIRST,
    covered: int = 100,
    text: str = "text",
    lang: str = "lang",
    limits: Limits = LIMITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of every language.

    A phrase comes ``least`` times or more. Its score is that of its weakest
    cut, floor(1000 a n / (l r)); ties go to the earliest cut. A phrase is
    dropped if a longer frequent one that holds it comes at least ``covered``
    percent as often. A null text is empty, a null language is ``und``; repeated
    rows count each time; other columns are not read. Ranks follow score and a,
    highest first, then the phrase by its bytes.
    """
    words, totals, grams = frequent_grams(docs, least, longest, text, lang, limits)
    size = F.size("ids")
    phrases = stage(grams.where(size > 1), "phrase-candidates")
    # Whatever holds a phrase and comes as often is reached one word at a time.
    held = phrases.where(size > 2).select(
        F.col("n").alias("longer"),
        F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"),
    )
    most = held.groupBy("ids").agg(F.max("longer").alias("longer"))
    left = phrases.join(most, "ids", "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("n"), F.lit(True)))
    total = totals.select("lang", F.col("n").alias("total"))
    named = words.select(F.col("id"), "lang").join(total, "lang")
    left = stage(left.select("ids", F.col("n").alias("a")).join(named, F.get("ids", F.lit(0)) == F.col("id")).drop("id"), "phrase-left")
    cuts = left.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"one": F.slice("ids", F.lit(1), F.col("cut")), "two": F.slice("ids", F.col("cut") + 1, size - F.col("cut"))})
    cuts = cuts.join(grams.select(F.col("ids").alias("one"), F.col("n").alias("l")), "one")
    cuts = cuts.join(grams.select(F.col("ids").alias("two"), F.col("n").alias("r")), "two")
    weakest = F.min(F.struct(score_of("a", "total", "l", "r").alias("score"), "cut", "l", "r")).alias("weakest")
    scored = cuts.groupBy("ids").agg(weakest, F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("total").alias("n"))
    spelt = left.select("ids", F.posexplode("ids").alias("place", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("place", F.col("word").cast("string").alias("word")))).alias("words"))
    told = scored.join(spelt, "ids").select(
        "lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", F.col("weakest.l").alias("l"), F.col("weakest.r").alias("r"),
        "n", F.col("weakest.score").alias("score"),
    )
    ranked = first_rows(told, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
