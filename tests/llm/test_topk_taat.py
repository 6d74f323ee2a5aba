import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm import topk_taat as t

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows, k):
    import numpy as np
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(good):
        if i is None or i % 50:
            continue
        s = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for m, (j, w) in enumerate(good) if m != n))[:k]
        out += [(i, r + 1, None if none else j, -x) for r, (x, none, j) in enumerate(s)]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, VEC).withColumns({"id": F.lit(1), "row": F.lit("r"), "score": F.lit(2.0)})
    return sorted(map(tuple, t.top_k(df, F.col("id") % 50 == 0, **kw).collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, rnd.uniform(-1, 1)]) for _ in range(8)]) for i in range(320)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (450, [float("inf")] * 8), (None, [1.0] * 8), (500, []), (501, [1.0, 1.0, 1.0])]
    rows += [(600 + i, rows[0][1]) for i in range(9)]  # ties and copies
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, rows, candidate_block=50, query_block=2) == brute(rows, 5)
    assert run(spark, rows[:3]) == brute(rows[:3], 5)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_large_components_are_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1e5, 1e5) for _ in range(6)]) for i in range(120)]
    assert run(spark, rows) == brute(rows, 5)
    # Sums that leave 64 bits on the way, and at the bottom, while the best ones fit.
    rows = [(0, [1e7, 1e7, 1.0]), (50, [1.0, 2.0, 3.0])] + [(201 + i, [x, y, rnd.uniform(-9, 9)]) for i, (x, y) in enumerate([(1e13, -1e13), (-1e13, 1e13), (-9e12, -9e12), (3e5, 2e5), (1.0, 4.0), (1e12, -1e12)])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, rows, candidate_block=2, query_block=1) == brute(rows, 5)
