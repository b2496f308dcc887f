"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash


#: Edges for each task that writes a table of them: small graphs need no file for each shuffle partition.
EDGES = 200_000


def _least(edges: DataFrame, stash: Stash, label: str, tasks: int) -> DataFrame:
    """For each u the least of itself and its neighbours. Written, so that the join that follows has two
    plain exchanges and a vertex with very many edges can be split among tasks."""
    return stash.keep(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks), label)


def _large_star(edges: DataFrame, stash: Stash, label: str, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, stash, label, tasks)
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame, stash: Stash, label: str, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, stash, label, tasks)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, stash: Stash, label: str = "edges") -> DataFrame:
    """(id, component) of every vertex of ``edges`` (u, v); the component is the least id that is reachable.

    Both steps keep the components; together they end in stars, in a number of rounds that grows with the
    logarithm of the longest path. Only a count and a checksum come to the driver.
    """
    now = stash.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), f"{label}-0")
    seen, k = _print(now), 0
    while seen[0]:
        tasks = 1 + seen[0] // EDGES
        large = stash.keep(_large_star(now, stash, f"{label}-l", tasks).coalesce(tasks), f"{label}-large")
        after = stash.keep(_small_star(large, stash, f"{label}-s", tasks).coalesce(tasks), f"{label}-{k + 1}")
        stash.drop(f"{label}-{k}", f"{label}-l", f"{label}-s", f"{label}-large")
        now, k, last, seen = after, k + 1, seen, _print(after)
        if seen == last:
            break
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
