import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm import ann_hnsw as a

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for n, (i, v) in enumerate(good):
        if i is None or i % 50:
            continue
        s = []
        for m, (j, w) in enumerate(good):
            if m != n:
                d = min(len(v), len(w))
                s.append((-round(float(v[:d] @ w[:d]) / math.sqrt(v @ v) / math.sqrt(w @ w), 9), j is None, j or 0))
        out[i] = [(None if none else j, -x) for x, none, j in sorted(s)[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, VEC).withColumns({n: F.lit(1) for n in ("id", "v", "score", "rank", "shard", "block", "h")}).repartition(3)
    out = {}
    for r in a.nearest(df, F.col("id") % 50 == 0, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-8)


def sample(n=400, wide=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=wide).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(1001, rows[0][1])]  # a hot vector, one id twice
    rows += [(2000, [2 * x for x in rows[1][1]]), (2050, rows[2][1][:5]), (2100, rows[2][1][:5] + [0.0] * 3)]
    return rows + [(None, rows[0][1]), (None, rows[3][1]), (3000, None), (3050, []), (3100, [0.0] * wide), (3150, [float("nan")] * wide), (3200, [1.0, None]), (3250, [float("inf")] * wide)]


def test_small_shards_give_what_brute_force_gives(spark):
    rows = sample()
    want = brute(rows, 5)
    close(run(spark, rows), want)
    close(run(spark, rows, shard=40, query_block=3), want)


def test_few_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1e-30, 1e-30])]
    close(run(spark, rows), brute(rows, 5))


def test_recall_of_one_large_shard():
    """Queries that are nodes, and queries that are not, as most are in a shard."""
    rng = np.random.default_rng(2)
    near = rng.normal(size=(40, 32))
    for x in (rng.normal(size=(6000, 32)), near[rng.integers(0, 40, 6000)] + .02 * rng.normal(size=(6000, 32)), rng.normal(size=(6000, 64))):
        graph, order = a.build(x)
        assert sorted(order) == list(range(len(x)))
        unit = a.unit_rows(graph.vectors)
        other = a.unit_rows(x[rng.integers(0, len(x), 200)] + .5 * rng.normal(size=(200, x.shape[1])))
        for q in (unit[::40], other):
            want = np.argsort(-(q @ unit.T), axis=1)[:, :5]
            found = a.search(graph, q.astype(np.float32))
            assert np.mean([len(set(f) & set(w)) / 5 for f, w in zip(found.tolist(), want.tolist())]) >= .9


def test_graph_is_flat_bounded_and_in_reach():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(300, 16)), rng.normal(size=(1, 16)) + 1e-4 * rng.normal(size=(900, 16)), -5 + 1e-5 * rng.normal(size=(300, 16))])
    graph, _ = a.build(x)
    sizes = [len(level) for level in graph.links]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] == len(x)
    for level in graph.links:
        own = np.arange(len(level))[:, None]
        assert level.max() < len(level) and not (level == own).any()
        seen = np.zeros(len(level), bool)
        seen[0] = True
        assert a._reached(level, seen, np.array([0])).all()


def test_merged_shards_reach_the_recall(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(4000)]
    want, got = brute(rows, 5), run(spark, rows, shard=1500)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= .9
