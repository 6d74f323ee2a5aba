"""Mixing sources to target weights by Pareto order sampling, DataFrame operations only.

Targets: the budget (``share`` of all sizes) is dealt to the sources by weight;
a source stops at ``most`` times its own size and the excess is dealt again among
the others. That fixed point has a closed form: with the sources in order of
cap/weight, the level is (budget - caps so far) / (weights not capped), and a
source is capped if its cap/weight is at most the level there.

A source whose target is m times its size takes floor(m) certain copies of every
document. The words left are dealt as one copy more of some documents, with a
probability proportional to size: min(1, c * size), c solved for each source so that the
expected words are the words left. Documents that reach 1 are certain and taken whole;
c is found among the source's distinct sizes, largest first. The others are ranked
by (u / (1 - u)) / (p / (1 - p)), u uniform and fixed by the row's content, p
the inclusion probability, and the smallest ranks are taken until the words left
are filled. Where the next document doesn't fit, it and the larger ones are
passed over and the following ones that fit fill up the rest (``FILLS`` times);
at last one document may go over if that comes nearer. Size is counted in
words, so each source comes within half of a document that isn't certain, mostly a
few words. The passes favour short documents with about one document's share of the
words left: much in a source of few documents, little in one of many.

Running sums are taken in two steps, over buckets of the rank and inside each
bucket, so a source with a third of all rows is spread over all tasks. One task
sees at most a source's distinct sizes.

Nulls and edges: a null or blank text has size 0 and takes 0; a null source is a
source, last in order; rows with a null id take part. Repeated rows are separate
documents; equal ranks are broken by id, then size, and rows equal in all of that are
interchangeable. A source of size 0 has target 0.0. Empty tables give empty tables. Extra
columns are not read (``mixed`` passes them through).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
FILLS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words(text_col: str) -> Column:
    """Number of words of the text, 0 for null: the starts of runs."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target). One row per source from here on."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(most))
    everyone = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = everyone.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = (rows.withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                            / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # The level at the first source that isn't capped; all before it in this order are, and from there on levels fall, also where cap/w ties.
    rows = rows.withColumn("final", F.max(F.when(F.col("cap") > F.col("w") * F.col("level"), F.col("level"))).over(whole))
    return rows.select("source", "source_size", F.when(F.col("final").isNull() | (F.col("cap") <= F.col("w") * F.col("final")), F.col("cap")).otherwise(F.col("w") * F.col("final")).alias("target"))


def uniform(*cols: str) -> Column:
    """In (0, 1), fixed by the columns' values."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols))
    return (F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def inclusion(narrow: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, c): one copy more of a document has the probability min(1, c * size); 0 where no words are left."""
    sizes = narrow.where(F.col("size") > 0).groupBy("source", "size").agg(F.count("*").alias("n"))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("n").cast("double") * F.col("size") * F.col("size")
    rows = (sizes.join(goal, F.col("source").eqNullSafe(F.col("_g")))
            .withColumn("c", (F.col("left") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0))) / F.sum(square).over(rest)))
    # At the largest size that isn't certain: the words of all larger ones are taken off, the rest shares what remains.
    return rows.groupBy("source").agg(F.greatest(F.max(F.when(F.col("c") * F.col("size") <= 1, F.struct("size", "c")))["c"], F.lit(0.0)).alias("c"))


def _taken_up_to(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds ``upto``: the sizes of the row and of all before it in its source, by rank."""
    # Odds scaled by the source's share left: back in (0, 1), in the order of the rank, and spread about evenly.
    odds = F.col("rank") * F.col("f") / (1 - F.col("f"))
    rows = rows.withColumn("bucket", F.floor(odds / (1 + odds) * buckets).cast("int"))
    each = rows.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    order = Window.partitionBy("source").orderBy("bucket")
    offset = each.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), (F.sum("s").over(order) - F.col("s")).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("size").over(inside))
    return (rows.join(offset, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
            .withColumn("upto", F.col("offset") + F.col("inside")).drop("_s", "_b", "bucket", "offset", "inside"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS,
           share: float = SHARE, most: float = MOST, keep: list[str] | None = None) -> DataFrame:
    """A row for each document: the kept columns (default none), doc_id, source, size, source_size, target, inclusion (of one copy more), copies and taken."""
    keep = keep or []
    narrow = docs.select(*keep, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"), F.sha2(F.col(text_col).cast("binary"), 256).alias("_h"))
    narrow = written(narrow.withColumn("u", uniform("doc_id", "source", "_h")).drop("_h"), "mix-sizes")
    goal = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most).withColumnRenamed("source", "_g")
    m = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = (goal.withColumn("sure", F.floor(m + 1e-9)).withColumn("f", F.greatest(m - F.col("sure"), F.lit(0.0)))
            .withColumn("left", F.greatest(F.col("target") - F.col("sure") * F.col("source_size"), F.lit(0.0))))
    goal = written(goal, "mix-targets")
    odds = written(inclusion(narrow, goal).withColumnRenamed("source", "_o"), "mix-inclusion")
    goal = goal.join(odds, F.col("_g").eqNullSafe(F.col("_o")), "left").drop("_o")
    buckets = max(1, math.isqrt(narrow.count()))  # as many buckets as documents in one, at most: both steps stay small
    p = F.col("inclusion")
    rows = (narrow.join(goal, F.col("source").eqNullSafe(F.col("_g"))).drop("_g", "left")
            .withColumn("inclusion", F.least(F.coalesce("c", F.lit(0.0)) * F.col("size"), F.lit(1.0)))
            .withColumn("inclusion", F.when(p >= 1 - 1e-9, 1.0).otherwise(p)).drop("c")
            .withColumn("rank", F.when((p > 0) & (p < 1), (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))))
            .withColumn("extra", (p == 1).cast("int")))
    for n in range(FILLS):
        last = n == FILLS - 1
        used = written(rows.groupBy("source").agg(F.sum(F.col("extra") * F.col("size")).alias("_used")).withColumnRenamed("source", "_g"), f"mix-used{n}")
        rows = rows.join(used, F.col("source").eqNullSafe(F.col("_g"))).withColumn("left", F.greatest(F.col("target") - F.col("sure") * F.col("source_size") - F.col("_used"), F.lit(0.0))).drop("_g", "_used")
        fits = (F.col("extra") == 0) & F.col("rank").isNotNull() & ((F.col("size") <= F.col("left")) if not last else (F.col("size") <= 2 * F.col("left")))
        open_ = _taken_up_to(rows.where(fits), buckets)
        enough = (F.col("upto") <= F.col("left")) if not last else (F.col("upto") - F.col("size") / 2 <= F.col("left"))
        now = open_.withColumn("extra", enough.cast("int"))
        rows = written(now.drop("upto").unionByName(rows.where(~fits)).drop("left"), f"mix-fill{n}")
    n = F.least(F.col("sure") + F.col("extra"), F.lit(int(most))).cast("int")
    return rows.select(*keep, "doc_id", "source", "size", "source_size", "target", "inclusion", n.alias("copies"), (n * F.col("size")).cast("long").alias("taken"))
