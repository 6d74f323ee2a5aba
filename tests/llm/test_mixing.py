import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rankforge.llm import mixing as m
from tests.llm.helpers import docs, prose


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[n] for n in open_)
        over = [n for n in open_ if left * w[n] / total >= most * sizes[n] - 1e-9]
        if not over:
            out |= {n: left * w[n] / total for n in open_}
            break
        for n in over:
            out[n] = most * sizes[n]
            open_.discard(n)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def rows_of(seed=1):
    rnd = random.Random(seed)
    return [(i, prose(rnd, rnd.choice([2, 5, 40, 300])), "en", rnd.choice(["hot"] * 6 + ["b", "é", None, "z", "\U0001F600"])) for i in range(400)] + [
        (400, None, "en", "b"), (401, " \t ", "en", "empty"), (None, "x y", "en", "b"), (None, "x y", "en", "b"), (402, "x y z", "en", "b")]


def test_targets_sizes_and_fill(spark):
    rows = rows_of()
    out = m.copies(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    size = defaultdict(int)
    import re
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for r in rows:
        size[r[3]] += count(r[1])
    want = water_fill(dict(size))
    got, longest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        got[r.source] += r.taken
    for k in want:
        assert abs(got[k] - want[k]) <= 20, k
    by = {r[0]: count(r[1]) for r in rows if r[0] is not None}
    assert all(r["size"] == by[r.doc_id] for r in out if r.doc_id is not None)


def test_reruns_and_partitions_agree(spark):
    rows = rows_of(2)
    a = sorted(map(str, m.copies(docs(spark, rows)).collect()))
    b = sorted(map(str, m.copies(docs(spark, rows[::-1]).repartition(7)).collect()))
    assert a == b
    assert m.copies(docs(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    df = m.copies(docs(spark, rows_of()[:20], extra=False))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_certain_copies(spark):
    goal = m.targets(spark.createDataFrame([("a", 10), ("b", 1000), (None, 0)], "source string, source_size long"))
    got = {r.source: r.target for r in goal.collect()}
    assert got["a"] == 20 and got["b"] == pytest.approx(1495) and got[None] == 0
    assert goal.where(F.col("target") > 2 * F.col("source_size")).count() == 0


def proportional(sizes, left):
    """Inclusion by bisection on c: the expected words are the words left."""
    lo, hi = 0.0, 1.0
    for _ in range(200):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if sum(min(1, c * s) * s for s in sizes) < left else (lo, c)
    return [min(1, c * s) for s in sizes]


def test_inclusion_and_its_frequencies(spark):
    """100 sources of the same 402 documents are 100 draws of one design."""
    rnd = random.Random(5)
    sizes = [rnd.choice([1, 2, 3, 5, 8, 13, 21]) for _ in range(400)] + [190, 220]
    draws, goal = 100, 0.4 * sum(sizes)
    rows = [(1000 * k + i, " ".join("w" * n), "en", f"s{k}") for k in range(draws) for i, n in enumerate(sizes)]
    out = m.copies(docs(spark, rows, extra=False), weights=(1,), share=0.4).collect()
    want = proportional(sizes, goal)
    assert {i for i, p in enumerate(want) if p > 0.999} == {400, 401}
    taken, words = [0] * len(sizes), defaultdict(int)
    for r in out:
        i = r.doc_id % 1000
        assert r.inclusion == pytest.approx(want[i])
        taken[i] += r.copies
        words[r.source] += r.taken
    assert taken[400] == taken[401] == draws
    assert all(abs(w - goal) <= 21 / 2 for w in words.values())  # half of the longest document that isn't certain
    by_size = defaultdict(list)
    for n, t, p in zip(sizes, taken, want, strict=True):
        by_size[n].append((t / draws, p))
    for n, pairs in by_size.items():
        assert sum(t - p for t, p in pairs) / len(pairs) == pytest.approx(0, abs=0.05), n
    # Equal odds would take short and long ones alike.
    mean = {n: sum(t for t, _ in x) / len(x) for n, x in by_size.items()}
    assert mean[21] > 4 * mean[3] > 0


def test_sql(spark, tmp_dir):
    import duckdb

    from rankforge.llm.queries import ORACLES

    rows = docs(spark, rows_of(4))
    rows.write.parquet(f"{tmp_dir}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents/*.parquet'")
    cols = ("doc_id", "size", "source_size", "target", "taken")
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES['op3_pareto_mixing']})").fetchall()
    got = [tuple(r) for r in m.copies(rows).select(*cols).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_sources_of_equal_size_and_weight_share_alike(spark):
    sizes = {f"s{i}": 100 for i in range(12)}
    goal = m.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = water_fill(sizes)
    assert {r.source: pytest.approx(r.target) for r in goal.collect()} == want
