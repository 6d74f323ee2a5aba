"""Heavy hitters: which keys hold very many rows, from one mergeable pass.

The sketch counts rows by hashed bucket, ``depth`` times with different hashes
(a count-min sketch kept as rows). Counts are sums of whole numbers, so partial
sketches of any tasks add up in any order to the same table: two evaluations of it
agree, which a sampled or merged-in-order sketch would not promise. Its size is
``depth * width`` rows at most, whatever the data, so it may be broadcast. A
key's estimate, the least of its buckets, is never below its true count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1 << 14
DEPTH = 2


def _bucket(key: str, turn: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(turn), F.col(key)), F.lit(width)).cast("int")


def degree_sketch(rows: DataFrame, key: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``turn, bucket, n``: rows with a non-NULL key by hashed bucket, once for each of ``depth`` hashes."""
    each = F.array(*(F.struct(F.lit(t).alias("turn"), _bucket(key, t, width).alias("bucket")) for t in range(depth)))
    return (rows.where(F.col(key).isNotNull()).select(F.explode(each).alias("b"))
                .groupBy("b.turn", "b.bucket").agg(F.count(F.lit(1)).alias("n")))


def hot_buckets(sketch: DataFrame, least: int, width: int = WIDTH) -> DataFrame:
    """The buckets that a key of ``least`` rows or more may be in.

    Chance alone puts an even share of all rows into a bucket; ``least`` is raised
    to four such shares, so that large tables don't make every bucket hot.
    """
    share = F.sum("n").over(Window.partitionBy("turn")) / F.lit(width)  # at most ``width`` rows
    return sketch.withColumn("least", F.greatest(F.lit(least), F.ceil(4 * share))).where(F.col("n") >= F.col("least"))


def with_estimate(rows: DataFrame, key: str, hot: DataFrame, out: str, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """Adds ``out``: how many times the threshold the key's estimate is, rounded up; 0 for keys that are not hot."""
    for t in range(depth):
        one = hot.where(F.col("turn") == t).select(F.col("bucket").alias(f"__b{t}"), F.ceil(F.col("n") / F.col("least")).alias(f"__n{t}"))
        # Bounded by the sketch's width.
        rows = rows.withColumn(f"__b{t}", _bucket(key, t, width)).join(F.broadcast(one), f"__b{t}", "left").drop(f"__b{t}")
    seen = [F.coalesce(F.col(f"__n{t}"), F.lit(0)) for t in range(depth)]
    least = F.least(*seen) if depth > 1 else seen[0]
    return rows.withColumn(out, least.cast("int")).drop(*(f"__n{t}" for t in range(depth)))


def heavy_keys(rows: DataFrame, key: str, least: int, out: str = "n_rows", width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``key, n_rows`` of exactly the keys with ``least`` rows or more.

    The sketch leaves out the rows of most other keys before anything is
    shuffled by key; what is left is counted exactly.
    """
    hot = degree_sketch(rows, key, width, depth).where(F.col("n") >= least).withColumn("least", F.lit(least))
    kept = with_estimate(rows.select(key), key, hot, "__hot", depth, width).where(F.col(key).isNotNull() & (F.col("__hot") > 0))
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) >= least)
