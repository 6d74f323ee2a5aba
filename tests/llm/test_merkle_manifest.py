import zlib

from pyspark.sql import functions as F

from rankforge.llm import merkle_manifest as m
from tests.llm.helpers import CLASH, awkward, docs, sha


def joint(nodes):
    return sha("".join(nodes).encode())


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode())


def climb(nodes, arity):
    """All levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([joint(levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def siblings(levels, i, arity):
    out = []
    for level in levels[:-1]:
        a = i - i % arity
        out.append((level[a:i], level[i + 1:a + arity]))
        i //= arity
    return out


def brute(rows, arity, change=lambda i, t: t):
    """rows: (doc_id, source, lang, n_chars, text); the manifest and the root folded from the changed texts."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == s), key=lambda x: x[:3])
        trees.append((own, climb([x[2] for x in own], arity)))
    top = climb([levels[-1][0] for _, levels in trees], arity)
    out = []
    for t, (own, levels) in enumerate(trees):
        for i, (_, _, lf, r) in enumerate(own):
            path = siblings(levels, i, arity) + siblings(top, t, arity)
            h = leaf([*r[:4], change(r[0], r[4])])
            for a, b in path:
                h = joint([*a, h, *b])
            out.append((r[0], lf, levels[-1][0], top[-1][0], joint([x for a, b in path for x in a + b]), h))
    return sorted(out, key=str)


def run(df, arity, tampered=None, **kw):
    text = F.col("text") if tampered is None else tampered
    rows = m.manifest(df, arity=arity, carry={"tampered": m.leaf_digest([text if c == "text" else F.col(c) for c in m.FIELDS])}, **kw)
    out = rows.select("doc_id", "leaf", "subroot", "root", m.proof_digest(F.col("path")), m.fold(F.col("tampered"), F.col("path")))
    return sorted(map(tuple, out.collect()), key=str)


def sample():
    rows = [(i, t, lang, s) for n, (i, t) in enumerate(awkward()) for lang, s in [((None, "en", "de")[n % 3], (None, "", "a", "Z", "é", "lone" if n == 7 else "a", "a", "a", "a")[n % 9])]]
    return rows + [(1, "same", "en", "a")] * 4


def test_against_brute_force(spark):
    rows = sample()
    df = docs(spark, rows).withColumns({c: F.lit(1) for c in ("key", "idx", "h", "tree", "left", "right", "path", "part", "leaf", "root", "tampered", "inside")})
    plain = [(i, s, lang, len(t or ""), t) for i, t, lang, s in rows]
    for arity in (2, 3, 5):
        assert run(df.repartition(3), arity) == brute(plain, arity)


def test_tampering_shows(spark):
    rows = [(i, f"line {i}\n and more" if i % 3 else f"one line {i}", "en", "ab"[i % 2]) for i in range(40)]
    even = lambda i: zlib.crc32(str(i).encode()) % 2 == 0
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = run(docs(spark, rows), 3, cut)
    assert got == brute([(i, s, lang, len(t), t) for i, t, lang, s in rows], 3, lambda i, t: t.replace("\n", "") if even(i) else t)
    assert {r[0] for r in got if r[5] != r[3]} == {i for i, t, _, _ in rows if even(i) and "\n" in t}


def test_small_tables(spark):
    assert run(docs(spark, []), 3) == []
    one = [(4, None, None, None)]
    (r,) = run(docs(spark, one), 3)
    lf = leaf([4, None, None, 0, None])
    assert r == (4, lf, lf, lf, sha(b""), lf)
    many = [(1, "x", "en", f"s{i}") for i in range(30)]  # a source for each row
    assert run(docs(spark, many), 3) == brute([(1, s, "en", 1, "x") for _, _, _, s in many], 3)


def test_a_part_at_a_time(spark):
    """Places are counted across Arrow batches and partitions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i, f"t{i}", "en", "big" if i % 3 else "small") for i in range(200)]
        assert run(docs(spark, rows), 2) == brute([(i, s, lang, len(t), t) for i, t, lang, s in rows], 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_clashing_names_are_not_read(spark):
    rows = [(i, f"t{i}", "en", "a") for i in range(5)]
    assert run(docs(spark, rows), 3) == run(docs(spark, rows, extra=False), 3) and set(CLASH) <= set(docs(spark, rows).columns)
