"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.session import stage_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join below reads plain exchanges, whose large partitions can be split at a hot node.
    least = stage_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                        "large-star")
    return (both.filter("v > u").join(least, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of those."""
    least = stage_table(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
    linked = edges.join(least, "u")
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct())


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(u, v): every node that is not the least of its component, and that least node.

    ``edges`` has columns u > v of one ordered type.  Each round is written to
    the shared folder, so that the lineage stays one round long and a lost
    executor costs a re-read; the driver sees two numbers a round.
    """
    now = stage_table(edges.select("u", "v").distinct(), name)
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            return now
        now = stage_table(_small_star(_large_star(now)), name)
        before, mark = mark, _mark(now)
        if mark == before:
            return now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], int(r["s"] or 0)
