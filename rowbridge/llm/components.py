"""Connected components of a graph given by links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowbridge.common import stage


def _distinct_links(links: DataFrame) -> DataFrame:
    return (
        links.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def connect(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; links are (a, b) of longs.

    Each round lets every node point to the neighbour of smallest hash (or to
    itself), follows the pointers to their ends by doubling, and joins the ends
    into the links. Links inside a component vanish, so rounds are few. Minima
    combine before the shuffle; all joins read staged tables, so that Spark can
    split a node that many links meet in. Hashes change with the round.
    """
    left = stage(_distinct_links(links), "links")
    labels = None
    turn = 0
    while left.head() is not None:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.xxhash64(F.lit(turn), "b")
        smallest = both.groupBy("a").agg(F.min(F.struct(order.alias("h"), F.col("b").alias("b"))).alias("m"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("b"))
        pointers = stage(smallest.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("to")), "pointers")
        while True:
            next_to = pointers.select(F.col("node").alias("to"), F.col("to").alias("then"))
            moved = stage(pointers.join(next_to, "to").select("node", F.col("then").alias("to"), (F.col("then") != F.col("to")).alias("moved")), "pointers")
            pointers = moved.drop("moved")
            if moved.where("moved").head() is None:
                break
        ends = pointers.withColumnRenamed("to", "component")
        if labels is None:
            labels = ends
        else:
            step = ends.select(F.col("node").alias("component"), F.col("component").alias("end"))
            labels = stage(
                labels.join(step, "component", "left").select("node", F.coalesce("end", "component").alias("component")),
                "labels",
            )
        first = ends.select(F.col("node").alias("a"), F.col("component").alias("ra"))
        second = ends.select(F.col("node").alias("b"), F.col("component").alias("rb"))
        left = stage(
            _distinct_links(left.join(first, "a").join(second, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))),
            "links",
        )
        turn += 1
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
