"""Connected components of a stored list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewcraft.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to its smallest neighbour instead.

    The large star links the larger neighbours of each node, the small star the smaller
    ones and the node itself. ``edges`` has ``a`` and ``b`` with ``a > b``. Minima are
    combined before the shuffle and stored, so that Spark can split a hub's rows in the join.
    """
    if large:
        ends = edges.select("a", "b").unionAll(
            edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
    else:
        ends = edges.select("a", "b")
    least = stored(
        ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
        "least-neighbours",
    )
    joined = ends.join(least, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") > F.col("b")).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for nodes that are not roots.

    ``edges`` has two long columns ``a`` and ``b`` in either order; loops, repeated edges
    and nulls are left out. Alternating large and small stars until nothing changes; each
    round is written to the shared folder.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") > F.col("b"))
        .distinct(),
        "edges",
    )
    before = _mark(edges)
    while before[0]:
        grown = stored(_star(edges, large=True), "edges")
        edges = stored(_star(grown, large=False), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
