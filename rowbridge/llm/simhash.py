"""SimHash near-duplicates: sharded BK-trees link fingerprints, contraction finds the classes.

Two 64-bit fingerprints with at most ``RADIUS`` differing bits agree on all but
``RADIUS`` of eight bytes. So every distinct fingerprint is put under each choice
of the bytes that must agree, and those that agree on a choice form a shard. A
shard differs in ``8 * RADIUS`` bits only: its tree has at most 2**16 nodes,
whatever the corpus holds. Each shard gets a BK-tree (a child hangs on the
integer Hamming distance to its parent), and every fingerprint of the shard asks
the tree, following only edges within the radius. Tree and questions meet in the
shard's task by one shuffle: broadcasting trees would bring the fingerprints of
all documents to the driver.

A shard gives a spanning forest of its links, never all pairs: a search ends
when each class known to the shard has been met. Copies are one fingerprint, so
the size of a group of copies never matters here.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, stage
from rowbridge.llm.common import unused
from rowbridge.llm.components import connect

BITS = 64
BLOCKS = 8
RADIUS = 2


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text in UTF-8; no words, or null, give zero."""
    tokens = (text or b"").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    grams = zip(*(tokens[i:] for i in range(words)), strict=False) if len(tokens) >= words else [tokens]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(g), seed) for g in grams), dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 255):  # 255 additions fit a byte
        block = np.unpackbits(hashes[start : start + 255].view(np.uint8), bitorder="little")
        counts += block.reshape(-1, BITS).sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """All columns but the text, and the fingerprint as a signed long; a column of its name gives way."""
    rest = [f for f in docs.schema.fields if f.name != text and f.name.lower() != name.lower()]
    schema = T.StructType([*rest, T.StructField(name, T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [fingerprint(t.as_py(), words) for t in batch.column(0)], dtype=np.uint64
            ).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], names=schema.names)

    source = docs.select(
        column(text).cast("binary").alias(unused(docs.columns, "__text")), *[column(f.name) for f in rest]
    )
    return source.mapInArrow(run, schema)


class Tree:
    """A BK-tree of distinct integers."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Place of ``value``, added if it is new."""
        node = 0
        while self.values:
            distance = (value ^ self.values[node]).bit_count()
            if distance == 0:
                return node
            child = self.children[node].get(distance)
            if child is None:
                self.children[node][distance] = len(self.values)
                break
            node = child
        self.values.append(value)
        self.children.append({})
        return len(self.values) - 1

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Places of all values within ``radius``."""
        open_nodes = [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                yield node
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    open_nodes.append(child)


def shard_links(values: Iterable[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect all values of a shard which chains within ``radius`` connect."""
    tree, parent, links = Tree(), [], []
    classes = 0

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in values:
        met: set[int] = set()
        for node in tree.near(value, radius):
            top = root(node)
            if top not in met:
                met.add(top)
                links.append((value, tree.values[node]))
                if len(met) == classes:
                    break
        place = tree.add(value)
        if place < len(parent):  # repeated value
            continue
        parent.append(place)
        for top in met:
            parent[top] = place
        classes += 1 - len(met)
    return links


def _links(shards: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of shards that arrive sorted by (choice, agreed, fp); a shard may span batches."""
    names = ["choice", "agreed", "fp"]
    rest = [np.empty(0, dtype=np.int64) for _ in names]

    def linked(columns: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
        pairs: list[tuple[int, int]] = []
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - start > 1:
                pairs += shard_links(int(v) for v in columns[2][start:end].view(np.uint64))
        both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    for batch in shards:
        columns = [
            np.concatenate([r, c.to_numpy(zero_copy_only=False).astype(np.int64)])
            for r, c in zip(rest, batch.columns, strict=True)
        ]
        if not len(columns[0]):
            continue
        changes = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        bounds = np.concatenate([[0], np.flatnonzero(changes) + 1])
        yield linked(columns, bounds)  # all but the last shard, which may go on
        rest = [c[bounds[-1] :] for c in columns]
    if len(rest[0]):
        yield linked(rest, np.array([0, len(rest[0])]))


def link_fingerprints(distinct: DataFrame, name: str = "fp") -> DataFrame:
    """Links (a, b) that connect every class of fingerprints; not all pairs."""
    width = BITS // BLOCKS
    choices = []
    for i, dropped in enumerate(combinations(range(BLOCKS), RADIUS)):
        mask = (1 << BITS) - 1
        for block in dropped:
            mask &= ~(((1 << width) - 1) << (block * width))
        mask -= (1 << BITS) if mask >= 1 << (BITS - 1) else 0
        choices.append(
            F.struct(F.lit(i).cast("int").alias("choice"), column(name).bitwiseAND(F.lit(mask)).alias("agreed"))
        )
    shards = distinct.select(F.inline(F.array(*choices)), column(name).alias("fp"))
    sharded = shards.repartition("choice", "agreed").sortWithinPartitions("choice", "agreed", "fp")
    return sharded.mapInArrow(_links, "a long, b long")


def classes(fingerprinted: DataFrame, doc_id: str = "doc_id", name: str = "fp") -> DataFrame:
    """Per distinct fingerprint: ``fp``, ``component`` (a fingerprint of the class), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` of the class, null if all are null.
    ``fingerprinted`` is read several times, so give staged rows.
    """
    distinct = stage(
        fingerprinted.groupBy(column(name).alias("fp")).agg(F.min(column(doc_id)).alias("first_id")), "simhash-distinct"
    )
    labels = connect(link_fingerprints(distinct))
    linked = stage(
        distinct.join(labels, distinct["fp"] == labels["node"]).select("fp", "first_id", "component"), "simhash-linked"
    )
    smallest = stage(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    named = stage(linked.join(smallest, "component").select("fp", "component", "component_id"), "simhash-named")
    joined = distinct.join(named.withColumnRenamed("fp", "named"), F.col("fp") == F.col("named"), "left")
    alone = F.col("named").isNull()
    return stage(
        joined.select(
            "fp",
            F.coalesce("component", "fp").alias("component"),
            F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "simhash-classes",
    )


def keepers(fingerprinted: DataFrame, found: DataFrame, keys: tuple[str, str], doc_id: str = "doc_id") -> DataFrame:
    """The row keys of one document per class: the smallest ``doc_id``, nulls last."""
    member = fingerprinted.join(found.select(F.col("fp"), "component"), "fp")
    first = F.min(F.struct(column(doc_id).isNull(), column(doc_id), *[column(k) for k in keys])).alias("first")
    chosen = member.groupBy("component").agg(first)
    return chosen.select(*[F.col(f"first.{k}").alias(k) for k in keys])
