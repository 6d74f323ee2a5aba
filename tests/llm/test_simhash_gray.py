import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from rankforge.llm import simhash_gray as s
from rankforge.llm.components import components
from tests.llm.helpers import awkward, docs, prose


def plain(text, k=4):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    ones = [0] * 64
    for x in sh:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(sh))


def groups(codes, bits):
    n = len(codes)
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def test_fingerprints_and_components(spark):
    rnd = random.Random(1)
    base = prose(rnd, 300).split()
    rows = awkward() + [(100 + i, " ".join(base[:i] + ["EDIT"] * (i % 3) + base[i:])) for i in range(40)] + [(200, "ÀB c"), (201, "àb C"), (202, "a\x0bb\x0cc d e")]
    out = s.near_duplicates(docs(spark, rows)).collect()
    codes = [plain(t) for _, t in rows]
    at = groups(codes, 4)
    least = {}
    for (i, _), g in zip(rows, at):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in out), key=str) == sorted(((i, c, least.get(g)) for (i, _), c, g in zip(rows, codes, at)), key=str)
    assert s.near_duplicates(docs(spark, [])).collect() == []


def test_spark_hash_is_the_contract_hash(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first().h
    assert r % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_links_with_hot_buckets(spark):
    rng = np.random.default_rng(2)
    codes = {0}
    for base in rng.integers(0, 2**63, 12).tolist():
        for _ in range(60):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << b
            codes.add(x)
    codes = sorted(codes)
    signed = [c - 2**64 if c >> 63 else c for c in codes]
    want = groups(codes, 4)
    for most in (20_000, 40):  # 40: buckets cut into parts
        found = {r.node: r.root for r in components(s.links(spark.createDataFrame([(c,) for c in signed], "fp long"), 4, most)).collect()}
        got = [found.get(c, c) for c in signed]
        assert len(set(got)) == len(set(want)) and len(set(zip(got, want))) == len(set(want))


def test_index_prunes_exactly():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 2**12, 700).astype(np.uint64) << np.uint64(20))
    rank = codes.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    codes = codes[np.argsort(rank)]
    for bits in (0, 1, 2):
        assert s.index_links(codes, bits).tolist() == groups(codes.tolist(), bits)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
