"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored


def _nearest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; written, so that a join with it can split a node with very many links."""
    return stored(pairs.groupBy("a").agg(F.min("b").alias("low")), "nearest")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link to another: the smallest node it is connected with.

    ``links`` has two long columns ``a`` and ``b``, in any order, repeats and loops allowed; rows with a null are no
    links. Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones; in a
    logarithmic number of rounds only stars around the smallest nodes are left. Nothing is collected.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    tree = stored(ordered.where("a <> b AND a IS NOT NULL").distinct(), "links")
    state = _state(tree)
    while state[0]:
        both = tree.union(tree.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_nearest(both), "a", "left")
        large = large.select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        tree = stored(large.distinct(), "links")
        small = tree.join(_nearest(tree), "a")
        hung = small.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        kept = small.where("b = low").select("a", "b")
        tree = stored(kept.union(hung).distinct(), "links")
        last, state = state, _state(tree)
        if state == last:
            break
    return tree.select(F.col("a").alias("node"), F.col("b").alias("component"))
