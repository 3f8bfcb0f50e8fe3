"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum per node and a join, both spread by key;
nothing is gathered on the driver but two numbers a round. Each round's edges
are written to the shared folder, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, remove

MAX_ROUNDS = 100


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours get its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours get the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of an edge; root is the smallest node of its component (orderable type)."""
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v"), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        new = materialize(_small(_large(now)), "edges")
        found = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        remove(now)
        now = new
        if tuple(found) == state:
            pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
        state = tuple(found)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
