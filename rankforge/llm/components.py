"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links between longs to (node, root): the smallest node reachable.

    Large-star then small-star until nothing changes (about log2 of the longest
    chain). Every round is two shuffles with map-side minima and is written to
    the shared folder, so a lost executor costs one round. Nodes without links
    to another node don't appear.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        edges = written(small, "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
