"""Connected components by alternating large-star and small-star steps over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.storage import apart, discard, save


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum((h % 1_000_003).cast("decimal(38,0)")), F.bit_xor(h)).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is its smallest node.

    ``edges`` has long columns ``u`` and ``v``. Each round is two joins and aggregations over the edges, written to the
    shared folder; only three numbers a round reach the driver. Rounds are logarithmic in the size of a component.
    """
    current = save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = _state(current)
    for _ in range(most_rounds):
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(apart(lowest), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(down), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        following = save(small.where("u <> v").distinct(), "edges")
        discard(current)
        before, state, current = state, _state(following), following
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
