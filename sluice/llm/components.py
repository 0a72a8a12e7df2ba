"""Connected components of a graph whose links never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged, unstaged


def _sum_of(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("m").alias("a"), "b").where("a < b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    down = edges.join(least, "b")
    return (down.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(least.select(F.col("m").alias("a"), "b"))
            .where("a < b").distinct())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for each node with a link; root is the smallest node it reaches.

    ``links`` has two columns ``a`` and ``b`` of one orderable type. Alternating star
    contractions: every round rewires edges to smaller nodes until the edges are stars, which
    takes a number of rounds in the order of log(nodes). Each round is written to the shared
    folder, so a lost executor costs no more than the running round. Sides of a hub are
    partially aggregated before they are shuffled and its join is one that can be split. The
    result reads the last round's table, which ``unstaged`` removes.
    """
    edges = staged(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b").distinct(), "edges")
    seen = _sum_of(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        before, edges = edges, staged(_small_star(_large_star(edges)), "edges")
        unstaged(before)
        now = _sum_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    found.staged_path = edges.staged_path
    return found
