"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize


def _toward_minimum(edges: DataFrame, keep) -> DataFrame:
    """Point the kept neighbours of each vertex at the least vertex of its neighbourhood.

    The minimum is a grouped aggregate joined back, so a hub's edges are combined map-side
    and the join can be split by AQE; a window would hold the hub in one task.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return edges.join(least, "u").filter(keep)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    moved = _toward_minimum(both, F.col("v") > F.col("u"))
    # At most as many rows as edges; the small star that follows drops the repeated ones.
    return moved.select(F.col("v").alias("a"), F.col("low").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    moved = _toward_minimum(down, F.lit(True))
    again = moved.select(F.col("v").alias("a"), F.col("low").alias("b")).unionAll(
        moved.select(F.col("u").alias("a"), F.col("low").alias("b"))
    )
    return again.filter("a <> b").distinct()


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges``; component is the least id reachable.

    Null ends and self loops are ignored. Every round is written to the shared folder, so a
    lost executor never reaches back past one round. Stops when a round changes nothing.
    """
    current = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b").distinct()
    mark = None
    for _ in range(max_rounds):
        current = materialize(_small_star(_large_star(current)), "components")
        code = F.xxhash64("a", "b")
        seen = current.agg(F.count("*"), F.bit_xor(code), F.sum(code.cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
