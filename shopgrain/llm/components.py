"""Connected components by contraction: every node moves to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of the links ``a``, ``b``; a root is its component's smallest.

    Each round maps a node to the smallest of itself and its neighbours and keeps the links
    between the images; only local minima remain, at most half of the nodes of a component,
    so the rounds grow with the logarithm of its size. The maps are then applied one after the other.
    """
    links = materialize(
        edges.where("a <> b").select(
            F.explode(
                F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            ).alias("e")
        ).select("e.a", "e.b"),
        "links",
    )
    moves = []
    while not links.isEmpty():
        move = materialize(
            links.groupBy("a").agg(F.min("b").alias("m")).select(
                F.col("a").alias("node"), F.least("a", "m").alias("to")
            ),
            "moves",
        )
        moves.append(move)
        ends = links.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b"
        )
        links = materialize(
            ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        later = move.select(F.col("node").alias("root"), "to")
        found = found.join(later, "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
    return found
