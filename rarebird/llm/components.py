"""Connected components by alternating large-star and small-star rounds, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import Scratch

#: links of a task from which a round has more tasks than cores
LINKS_A_TASK = 50_000


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) of every end of an edge; the component is its smallest node.

    ``edges``: two columns of one orderable type; direction, loops, nulls and repeats do not matter
    (an edge with a null end is none; an empty frame gives no rows). Each round halves path lengths,
    combines minima before the shuffle, and is written to the shared folder, so that lineage stays
    short and only two counters reach the driver. A round never makes links, so its tasks go by the
    links that are left; the rounds end when every component is a star around its smallest node.
    """
    a, b = edges.columns
    own = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    loops = own.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
    links, k = scratch.keep(_ordered(own.where("u <> v")), f"{name}-0"), 0
    while True:
        n, nodes, torn = _state(links)
        if not torn:
            break
        k, tasks = k + 1, max(edges.sparkSession.sparkContext.defaultParallelism, n // LINKS_A_TASK)
        large = _large_star(links if n < 2 * nodes else links.distinct())  # repeats are dropped where they are many
        large = scratch.keep(large.coalesce(tasks), f"{name}-{k}-large")
        scratch.drop(f"{name}-{k - 1}")
        links = scratch.keep(_small_star(large).coalesce(tasks), f"{name}-{k}")
        scratch.drop(f"{name}-{k}-large")
    # every link now goes from a node to the smallest node of its component
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(roots).union(loops).groupBy("node").agg(F.min("component").alias("component"))


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple[int, int, int]:
    """Number of links, of nodes, and of nodes that keep the links from being stars around smallest nodes: those
    with two different smaller neighbours, or with a smaller and a larger one."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("below"), F.lit(0).alias("above")).union(
        links.select("v", F.lit(None), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.min("below").alias("least"), F.max("below").alias("most"), F.max("above").alias("above"), F.count("below").alias("n"))
    torn = F.col("least").isNotNull() & ((F.col("least") != F.col("most")) | (F.col("above") == 1))
    got = nodes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("nodes"), F.count(F.when(torn, 1)).alias("torn")).first()
    return int(got["n"] or 0), got["nodes"], got["torn"]


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of these."""
    least = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    own = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return links.join(least, F.col("u") == F.col("c")).select(own.alias("u"), F.col("m").alias("v"))
