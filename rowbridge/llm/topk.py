"""Exact top-k by inner product: sorted lists read in step, without random access.

Candidates are dealt by hash into blocks of bounded size. A block keeps, per
component, the list of its values in order. Questions read all lists from
their better ends in step: a candidate's seen contributions and the best and
worst that its unread ones can be bound its score from above and below. Which
end is better depends on the sign of a weight only, so a few matrix products
bound all questions of a group at once. A question stops when the bound below
of the k-th best exceeds the bound above of all but a few candidates, and those
few get their final scores; one that does not stop reads to the ends of the lists,
where both bounds are the score. Each (block, block of
questions) is one group of bounded size; a question's winners of all blocks are
reduced to k by rounds of bounded groups.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column, stage
from rowbridge.llm.common import first_rows

# Components of the candidates, and of the questions, in one group.
BLOCK_CELLS = 1 << 19
# Questions whose bounds are computed at once.
_AT_ONCE = 256
# Lists are read so deep first, then four times as deep each time.
_FIRST_DEPTH, _DEEPER = 64, 4
_LEAST_LONG, _MOST_LONG = -(1 << 63), (1 << 63) - 1
# Sums below this are exact in doubles.
_EXACT = float(1 << 53)


def whole_components(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, at most what a long holds.

    Null for a null vector and for one with a null or non-finite component.
    """
    clean = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.when(
        vector.isNotNull() & clean, F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    )


class Lists:
    """The sorted lists of one block of candidates."""

    def __init__(self, rows: np.ndarray) -> None:
        self.whole, self.rows = rows, rows.astype(np.float64)
        n, width = rows.shape
        order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.rows, order, axis=0)
        self.rank = np.empty((n, width), dtype=np.int32)  # place in the ascending list
        np.put_along_axis(self.rank, order, np.arange(n, dtype=np.int32)[:, None], axis=0)

    def bounds(self, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (rows x questions) after ``depth`` values of every list.

        ``up`` and ``down`` have the positive and the negative weights, (components x questions).
        """
        n = len(self.rows)
        low = high = 0.0
        ends = ((up, self.rank >= n - depth, n - 1 - depth, 0), (down, self.rank < depth, depth, n - 1))
        for weights, seen, nearest, farthest in ends:
            known, unread = np.where(seen, self.rows, 0.0) @ weights, (~seen).astype(np.float64)
            high = high + known + unread @ (weights * self.sorted[nearest][:, None])
            low = low + known + unread @ (weights * self.sorted[farthest][:, None])
        return low, high

    def best(self, weights: np.ndarray, k: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """For each question (a row of ``weights``) the places and scores of its ``k`` best rows, ties included.

        The second result counts the questions that stopped before the ends of the lists.
        """
        n, width = self.rows.shape
        floats = weights.astype(np.float64).T
        up, down = np.maximum(floats, 0.0), np.minimum(floats, 0.0)
        largest = float(np.abs(self.rows).max(initial=0)) * np.abs(floats).max(axis=0, initial=0) * width
        slack = np.where(largest < _EXACT, 0.0, largest * width * 2.0**-48)
        found: list = [None] * len(weights)
        left, depth, early = np.arange(len(weights)), max(_FIRST_DEPTH, 4 * int(k.max(initial=1))), 0
        while len(left):
            ended = depth >= n
            if ended:
                low = high = self.rows @ floats[:, left]
            else:
                low, high = self.bounds(up[:, left], down[:, left], depth)
            going = []
            for c, q in enumerate(left):
                bar = np.partition(low[:, c], n - k[q])[n - k[q]]
                few = np.flatnonzero(high[:, c] >= bar - 2 * slack[q])
                if not ended and len(few) > 4 * k[q]:
                    going.append(q)
                    continue
                early += not ended
                scores = high[few, c].astype(np.int64) if ended and not slack[q] else self.scores(few, weights[q], slack[q] == 0)
                found[q] = (few, scores)
            left, depth = np.array(going, dtype=np.int64), depth * _DEEPER
        return found, early

    def scores(self, places: np.ndarray, question: np.ndarray, exact: bool) -> np.ndarray:
        """Final scores; beyond a long they count as the nearest long."""
        if exact:
            return (self.rows[places] @ question.astype(np.float64)).astype(np.int64)
        sums = [sum(a * b for a, b in zip(row, question.tolist(), strict=True)) for row in self.whole[places].tolist()]
        return np.array([min(max(s, _LEAST_LONG), _MOST_LONG) for s in sums], dtype=np.int64)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _best(k: int):
    def run(questions: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if questions.empty or block.empty:
            return empty
        width = max(questions["v"].map(len).max(), block["v"].map(len).max(), 1)
        rows, ids = _matrix(block["v"], width), block["id"].to_numpy()
        lists, parts, ranked = Lists(rows), [], np.sort(ids)
        for start in range(0, len(questions), _AT_ONCE):
            some = questions.iloc[start : start + _AT_ONCE]
            names = some["id"].to_numpy()
            # A question's own rows, one for each time its id comes here, may be among the best.
            alike = np.searchsorted(ranked, names, "right") - np.searchsorted(ranked, names)
            found, _ = lists.best(_matrix(some["v"], width), np.minimum(k + alike, len(rows)))
            for own, (places, scores) in zip(names, found, strict=True):
                others = ids[places] != own
                places, scores = places[others], scores[others]
                # From the largest score down, also where the smallest long is one.
                top = np.lexsort((ids[places], ~scores))[:k]
                parts.append(pd.DataFrame({"query_id": own, "vec_id": ids[places][top], "score": scores[top]}))
        return pd.concat(parts) if parts else empty

    return run


def top_k(vectors: DataFrame, questions: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each question, ties by vec_id.

    Both inputs are (id long, v array of longs); a null vector or id takes no
    part. A shorter vector counts as padded with zeros. A question never meets
    rows of its own id; a repeated id is several candidates, but one question, by
    its smallest vector. Blocks are dealt by hash, so copies spread evenly.
    """
    usable = stage(vectors.where("v is not null and id is not null").select("id", "v"), "topk-rows")
    asked = stage(
        questions.where("v is not null and id is not null").groupBy("id").agg(F.min("v").alias("v")), "topk-questions"
    )
    size = F.greatest(F.coalesce(F.max(F.size("v")), F.lit(1)), F.lit(1))
    rows, width = usable.agg(F.count(F.lit(1)), size).head()
    share = max(1, BLOCK_CELLS // width)
    blocks, groups = rows // share + 1, asked.count() // share + 1
    mine = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    theirs = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    left = asked.withColumn("asked", theirs).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = usable.withColumn("block", mine).withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = left.groupBy("block", "asked").cogroup(right.groupBy("block", "asked")).applyInPandas(
        _best(k), "query_id long, vec_id long, score long"
    )
    ordered = [F.col("score").desc(), F.col("vec_id")]
    return first_rows(found, ["query_id"], ordered, k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def prepared(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v) for ``top_k``: v has whole components, or is null where the vector takes no part."""
    return vectors.select(column(id_column).cast("long").alias("id"), whole_components(column(vector)).alias("v"))


