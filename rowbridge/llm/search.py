"""Ranked lexical search the other way round: documents stream through an index of the queries.

The items asked for are a stated set, so the inverted index is built over their
terms and sent to all tasks, in blocks of bounded size. Every document brings the counts of
its own terms to the index, which tells the items they belong to; each task
keeps a heap of the ``k`` best documents per item. The heaps are merged in rounds of
bounded groups. Documents are never shuffled.

The score is BM25-like in whole numbers. N counts the documents with a term, L
all their terms, n one document's terms, df the documents that hold a term, tf
its occurrences in the document::

    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m      = 75 + (25 n N) div L
    score  = sum over the item's terms of weight * ((10^9 tf) div (1000 tf + 12 m))
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.llm.common import first_rows

# (item, term) pairs in one index.
BLOCK_POSTINGS = 1 << 18
# Cells of the score matrix and postings worked on at once.
_CELLS, _POSTED = 1 << 21, 1 << 23
# ASCII letters in lower case, digits and all bytes beyond ASCII; the rest parts terms.
_TERMS = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII, A-Z in lower case."""
    return text.translate(_TERMS).split() if text else []


def _asked(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term, times); rows of one id are one item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, told in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counted = Counter(terms_of(told.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(counted), pa.int64()), pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())],
                    names=["item", "term", "times"],
                )

    given = items.select(column(item_id).cast("long").alias("item"), column(text).cast("binary").alias("text"))
    told = given.mapInArrow(run, "item long, term binary, times long")
    return told.groupBy("item", "term").agg(F.sum("times").alias("times"))


class Index:
    """The items of every term: ``items[at[t]:at[t + 1]]``, each ``times`` over."""

    def __init__(self, postings: pa.Table) -> None:
        given = postings.column("item").to_pylist()
        self.names = sorted(set(given), key=lambda i: (i is None, i or 0))
        place = {name: i for i, name in enumerate(self.names)}
        terms = postings.column("term").to_pylist()
        self.terms = {t: i for i, t in enumerate(sorted(set(terms)))}
        numbers = np.array([self.terms[t] for t in terms], dtype=np.int64)
        order = np.argsort(numbers, kind="stable")
        self.items = np.array([place[i] for i in given], dtype=np.int64)[order]
        self.times = postings.column("times").to_numpy()[order].astype(np.int64)
        self.at = np.searchsorted(numbers[order], np.arange(len(self.terms) + 1))


def _term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """(doc, n, terms, tfs) of the documents with a term: all their terms in number, those of the index with counts."""
    known = index.terms

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, ends, terms, tfs = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                told = terms_of(text.as_py())
                if not told:
                    continue
                counted = Counter(told)
                for term in counted.keys() & known.keys():
                    terms.append(known[term])
                    tfs.append(counted[term])
                kept.append(i)
                sizes.append(len(told))
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc", "n", "terms", "tfs"]
            )

    return docs.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<int>")


class Heaps:
    """The ``k`` best documents of every item; equal scores by ascending number, null last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.kept: list[list[tuple]] = [[] for _ in range(items)]
        self.bar = np.ones(items, dtype=np.int64)

    def offer(self, docs: list[int | None], scores: np.ndarray) -> None:
        for d, i in zip(*np.nonzero(scores >= self.bar), strict=True):
            doc, heap = docs[d], self.kept[i]
            entry = (int(scores[d, i]), doc is not None, -(doc or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.bar[i] = max(1, heap[0][0])


def _scores(docs: np.ndarray, terms: np.ndarray, parts: np.ndarray, n: int, index: Index) -> np.ndarray:
    """Scores (n documents x items) from what each (document, term) contributes."""
    lengths = np.diff(index.at)[terms]
    starts = index.at[terms] - (np.cumsum(lengths) - lengths)
    at = np.repeat(starts, lengths) + np.arange(lengths.sum())
    width = len(index.names)
    scores = np.zeros(n * width, dtype=np.int64)
    np.add.at(scores, np.repeat(docs, lengths) * width + index.items[at], np.repeat(parts, lengths) * index.times[at])
    return scores.reshape(n, width)


def _best(counted: DataFrame, index: Index, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc, score): the heaps of every task."""
    step = max(1, min(_CELLS // len(index.names), _POSTED // len(index.items)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(index.names), k)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                docs, sizes = some.column(0).to_pylist(), some.column(1).to_pylist()
                length = np.array([75 + 25 * s * n_docs // n_terms for s in sizes], dtype=np.int64)
                row = np.repeat(np.arange(len(docs)), some.column(2).value_lengths().to_numpy())
                terms, tf = (some.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                parts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[row]))
                heaps.offer(docs, _scores(row, terms, parts, len(docs), index))
        found = [
            (index.names[i], -minus if known else None, score)
            for i, heap in enumerate(heaps.kept) for score, known, minus in heap
        ]
        columns = zip(*found, strict=True) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["item", "doc", "score"])

    return counted.mapInArrow(run, "item long, doc long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank int, doc_id, score): the ``k`` best documents of every item, scores above 0 only.

    Ranks follow the score, then ``doc_id`` with null last; documents equal in
    both keep one place each. A null or empty text has no terms: such a document
    does not count, such an item has no rows. Rows of one item id, null
    included, are one item with the terms of all; repeated document rows are
    several documents. Other columns are not read. Ids are integers.
    """
    spark = docs.sparkSession
    asked = stage(_asked(items, item_id, item_text), "search-items")
    blocks = asked.count() // BLOCK_POSTINGS + 1
    texts = docs.select(column(doc_id).cast("long").alias("doc"), column(text).cast("binary").alias("text"))
    found = spark.createDataFrame([], "item long, doc long, score long")
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        postings = mine.toArrow()
        if not postings.num_rows:
            continue
        index = Index(postings)
        counted = stage(_term_counts(texts, index), "search-counts")
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).head()
        holding = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
        weights = np.zeros(len(index.terms), dtype=np.int64)
        for t, df in zip(holding.column("t").to_pylist(), holding.column("df").to_pylist(), strict=True):
            weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        found = found.unionByName(_best(counted, index, weights, n_docs, n_terms, k))
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    return first_rows(found, ["item"], order, k).select(
        F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score"
    )
