import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm import vector_codes as c

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def brute(rows, scale=4096, parts=8, entries=16, rounds=6):
    good = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = -(-max((len(v) for _, v, _ in good), default=0) // parts) * parts
    size = wide // parts
    x = [[(v + [0] * wide)[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in good]
    books = [[list(r[p]) for r in x[:entries]] for p in range(parts)]

    def place(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [place(r[p], books[p])[1] for r in x]
            for e in range(len(books[p])):
                of = [r[p] for r, a in zip(x, at) if a == e]
                if of:
                    books[p][e] = [sum(col) // len(of) for col in zip(*of)]
    found = [[place(r[p], books[p]) for p in range(parts)] for r in x]
    error = [sum(d for d, _ in f) for f in found]
    by = {}
    for (_, _, y), e in zip(good, error):
        by[y] = by.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{a:02x}" for _, a in f), e, by[y]) for (i, _, y), f, e in zip(good, found, error)), key=str), digest


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, VEC).withColumns({n: F.lit(1) for n in ("id", "v", "code", "error", "x", "position", "entry", "salt", "k0", "_key")}).repartition(3)
    out, books = c.compress(df, keep=["label"], **kw)
    out = c.summed_by(out, "label", "error", "label_error").select("vec_id", F.lower(F.hex("code")), "error", "label_error")
    return sorted(map(tuple, out.collect()), key=str), books.digest()


def sample(rnd, n=150, wide=16, reach=1.0):
    centres = [[rnd.uniform(-reach, reach) for _ in range(wide)] for _ in range(9)]
    rows = [(i, [x + rnd.gauss(0, .2 * reach) for x in rnd.choice(centres)], rnd.choice([None, 1, 2, 2, 2])) for i in range(n)]
    rows += [(1000 + i, rows[3][1], None) for i in range(80)]  # a hot vector
    return rows + [(7, rows[9][1], 1), (7, rows[9][1], 1), (None, rows[0][1], 2), (300, None, 1), (301, [None] * wide, 1), (302, [float("nan")] * wide, 1), (303, [math.inf] * wide, 1)]


def test_against_brute_force(spark):
    rows = sample(random.Random(1))
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, resident=10, parts=4, entries=5, rounds=3) == brute(rows, parts=4, entries=5, rounds=3)


def test_only_moved_parts_are_dealt_again(spark, monkeypatch):
    tables = {}
    keep = c._owned
    monkeypatch.setattr(c, "_owned", lambda df, name: tables.setdefault(name, keep(df, name)))
    rows = sample(random.Random(2), 400)
    run(spark, rows, resident=20)
    came = {name: t.where("came").count() for name, t in tables.items()}
    n = sum(v is not None and None not in v and all(map(math.isfinite, v)) for _, v, _ in rows)
    assert came["members"] == 8 * n and list(tables) == ["members"] + [f"round{i}" for i in range(1, 6)]
    assert 0 < came["round1"] < 8 * n / 2 and came["round5"] < came["round1"]
    owners = tables["members"].groupBy("position", "entry", "salt").count().agg(F.max("count")).first()[0]
    assert owners < n / 4  # a hot entry is salted


def test_large_components_are_exact(spark):
    rnd = random.Random(3)
    rows = sample(rnd, 60, 8, 1e5) + [(2000 + i, [rnd.uniform(-1e14, 1e14) for _ in range(8)], 1) for i in range(0)]
    assert run(spark, rows) == brute(rows)
    x = np.array([[1 << 40, -(1 << 40)], [5, 7]], dtype=np.int64)
    at, d = c.nearest(x, np.array([[0, 0], [-(1 << 40), 1 << 40]]))
    assert at.tolist() == [0, 0] and d.tolist() == [2 << 80, 74]
    at, d = c.nearest(x[1:] << 26, np.array([[0, 0], [0, 0]]))
    assert at.tolist() == [0] and d.tolist() == [74 << 52]


def test_small_and_uneven(spark):
    assert run(spark, [])[0] == [] and run(spark, [(1, None, 1)])[0] == []
    few = [(1, [.5, -1.0, 2.0], 1), (2, [], None), (3, [.25] * 11, None)]
    assert run(spark, few) == brute(few)
    assert run(spark, [(1, [], 1)]) == brute([(1, [], 1)])
