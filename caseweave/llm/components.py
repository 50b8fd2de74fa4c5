"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): for every id in a link, the smallest id that can be reached.

    In each round every node moves to the neighbour (or stays) with the least hash of
    its id, and links are rewritten to where their ends moved. The hash changes by
    round, so a constant share of the nodes goes each time, on long chains, too, and a
    star is gone after a round or two. Minima are combined before the shuffle, so a
    node with very many links is no hot group; joins on it are left to AQE to split.
    Tables of a round are materialised in the shared folder.
    """
    spark = links.sparkSession
    x, y = F.least(a, b).alias("x"), F.greatest(a, b).alias("y")
    pairs = links.where(F.col(a) != F.col(b)).select(x, y).distinct()
    edges = materialise(pairs, "edges", narrow=True)
    roots = spark.createDataFrame([], "id long, root long")
    level = 0
    while not edges.isEmpty():
        moves = materialise(_moves(edges, level), "moves", narrow=True)
        moved = roots.join(moves.withColumnRenamed("x", "root"), "root", "left").select(
            "id", F.coalesce("to", "root").alias("root")
        )
        first = moves.select(F.col("x").alias("id"), F.col("to").alias("root"))
        roots = materialise(moved if level else first, "roots", narrow=True)
        ends = (
            edges.join(moves.withColumnRenamed("to", "to_x"), "x")
            .join(moves.select(F.col("x").alias("y"), F.col("to").alias("to_y")), "y")
            .where(F.col("to_x") != F.col("to_y"))
        )
        edges = materialise(
            ends.select(
                F.least("to_x", "to_y").alias("x"), F.greatest("to_x", "to_y").alias("y")
            ).distinct(),
            "edges",
            narrow=True,
        )
        level += 1
    lowest = roots.groupBy("root").agg(F.min("id").alias("lowest"))
    return roots.join(lowest, "root").select("id", F.col("lowest").alias("root"))


def _moves(edges: DataFrame, level: int) -> DataFrame:
    """(x, to): the end with the least hash among a node and its neighbours."""
    both = edges.union(edges.select("y", "x").toDF("x", "y"))
    order = F.struct(F.xxhash64(F.lit(level), "y").alias("h"), F.col("y").alias("id"))
    own = F.struct(F.xxhash64(F.lit(level), "x").alias("h"), F.col("x").alias("id"))
    best = both.groupBy("x").agg(F.min(order).alias("best"))
    return best.select("x", F.least(own, "best")["id"].alias("to"))
