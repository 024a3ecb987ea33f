"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(rows: DataFrame) -> DataFrame:
    """Add ``m``, the least v of each u, to rows (u, v).

    A u with a third of all rows is cut into 64 slices by v; the least value goes to each slice that has rows.
    """
    cut = rows.withColumn("_k", F.pmod(F.xxhash64("v"), F.lit(64)))
    least = cut.groupBy("u", "_k").agg(F.min("v").alias("m")).groupBy("u").agg(F.min("m").alias("m"), F.collect_list("_k").alias("_k"))
    return cut.join(least.select("u", "m", F.explode("_k").alias("_k")), ["u", "_k"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around."""
    around = _with_least(_both_ways(edges)).where("v > u")
    return around.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    around = _with_least(edges)
    moved = around.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node is a root or has one edge, to a root."""
    ends = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))
    seen = ends.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.col("v").isNull()).alias("root"))
    return seen.where("lo < hi or (root and lo is not null)").isEmpty()


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is its component's least node.

    Loops and repeated edges do no harm; no edges give an empty table. Nodes are
    longs without nulls. The number of rounds grows with the logarithm of the
    longest path; each round is written to the shared folder (in at most
    ``files`` files), until all components are stars.
    """
    now = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", files
    )
    while not _stars(now):
        now = staged(_small_star(_large_star(now)), "stars", files)
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
