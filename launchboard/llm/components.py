"""Connected components by repeated contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.llm.store import Scratch


def contract(labels: DataFrame, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``labels`` (node, comp) after joining the components that ``edges`` (a, b)
    of component numbers link; every component takes its least number.

    Each component moves to the least of its neighbours and itself, edges move
    along, and those that became loops go. Every round removes all components but
    the local minima, so stars end after one and long paths after a few rounds.
    The edges of each round are written, which cuts lineage.
    """
    step = 0
    while True:
        edges = scratch.keep(edges.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges-{step}")
        if edges.isEmpty():
            return scratch.keep(labels, f"{name}-labels") if step else labels
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(
            F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        moves = (both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("new"))
                 .select("old", F.least("old", "new").alias("new")))
        # where the goal itself moves, go along: halves the rounds that chains take
        onward = moves.select(F.col("old").alias("new"), F.col("new").alias("next"))
        moves = moves.join(onward, "new").select("old", F.col("next").alias("new"))
        labels = labels.join(moves, labels.comp == moves.old, "left").select(
            "node", F.coalesce("new", "comp").alias("comp"))
        # every endpoint has a move, so inner joins keep all edges
        left = moves.select(F.col("old").alias("a"), F.col("new").alias("to_a"))
        right = moves.select(F.col("old").alias("b"), F.col("new").alias("to_b"))
        edges = edges.join(left, "a").join(right, "b").select(
            F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        step += 1
