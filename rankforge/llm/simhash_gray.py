"""SimHash near-duplicates through a Gray-ordered hierarchical index.

A fingerprint's bit is set if over half of the text's shingle hashes have it.
Only distinct fingerprints are compared. For a distance of r the 64 bits are
cut into r + 2 runs: two fingerprints within r bits agree on two runs at least,
so each fingerprint goes to one bucket per pair of runs and every link shares a
bucket. Inside a bucket, fingerprints are sorted by Gray rank and packed into
leaves; a node keeps the bits that all below it share (mask and value). Two
nodes differ in at least popcount(maskA & maskB & (valueA ^ valueB)) bits, which
accumulates down the levels, so whole groups of pairs are pruned; pairs of
leaves that are already one component are passed over as well. A bucket gives a
spanning star for each of its components, never all pairs. A bucket with more than
``MAX_BUCKET`` fingerprints is cut into parts, and its pairs of parts become
tasks of their own.

Nulls and edges: a null, empty or blank text has fingerprint zero and links to
all others like it; fewer words than the shingle length make one shingle of all.
Rows with a null id are fingerprinted and linked; a component's id is the
smallest non-null doc_id in it, null if there is none. Repeated rows each get a
row. Empty tables give empty tables. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import per_text, written
from rankforge.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LEAF = 32
MAX_BUCKET = 20_000
_PIECE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        n, shingle = 1, len(words)
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = (end - np.fromiter(map(len, words), np.int64, len(words)))[:n].tolist()
    end = end[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(start[at:at + _PIECE], end[at:at + _PIECE], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint's bits as a signed long."""
    def run(texts):
        return {"fp": pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))}

    return per_text(docs, keep or [id_col], text_col, run, [T.StructField("fp", T.LongType())])


def gray_rank(col):
    """How many Gray codes come before this one (as an unsigned number)."""
    for by in (1, 2, 4, 8, 16, 32):
        col = col.bitwiseXOR(F.shiftrightunsigned(col, by))
    return col


def masks(max_bits: int) -> list[int]:
    """Masks (signed) of every pair of the max_bits + 2 runs of bits."""
    edge = np.linspace(0, 64, max_bits + 3).round().astype(int)
    runs = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edge, edge[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(runs, 2))]


def _find(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if np.array_equal(up, root):
            return root
        root = up


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Components after the links i-j: every node's smallest."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        root = _find(root)
    return root


def _shared(value: np.ndarray, mask: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """One level up: what each run of ``fan`` nodes has in common."""
    at = np.arange(0, len(value), fan)
    first = np.repeat(value[at], np.diff(np.append(at, len(value))))
    mask = np.bitwise_and.reduceat(mask & ~(value ^ first), at)
    return value[at] & mask, mask


def hierarchy(codes: np.ndarray, fan: int = LEAF) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (value, mask) from the leaves' members upwards to one node."""
    levels = [(codes, np.full(len(codes), ~np.uint64(0)))]
    while len(levels[-1][0]) > 1:
        levels.append(_shared(*levels[-1], fan))
    return levels


def index_links(codes: np.ndarray, max_bits: int, parts: np.ndarray | None = None, fan: int = LEAF) -> np.ndarray:
    """Component (smallest position) of each of a bucket's codes, which are in Gray order.

    parts: 0 and 1 mark two parts of a large bucket; only pairs across them (or, if all are alike, all) need a look.
    """
    levels, n = hierarchy(codes, fan), len(codes)
    root = np.arange(n)
    a = b = np.zeros(1, np.int64)
    stack = [(len(levels) - 1, a, b)]
    while stack:  # depth first, in bounded pieces
        level, a, b = stack.pop()
        value, mask = levels[level]
        near = np.bitwise_count(mask[a] & mask[b] & (value[a] ^ value[b])) <= max_bits
        a, b = a[near], b[near]
        if level == 1 and len(a):  # leaves whose members are one component already
            low, high = (f.reduceat(root, np.arange(0, n, fan)) for f in (np.minimum, np.maximum))
            done = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
            a, b = a[~done], b[~done]
        if not len(a):
            continue
        if level == 0:
            if parts is not None:
                across = parts[a] != parts[b]
                a, b = a[across], b[across]
            root = unite(root, a, b)
            continue
        below = len(levels[level - 1][0])
        kids = np.arange(fan)
        x = (a[:, None, None] * fan + kids[:, None]) + np.zeros((1, 1, fan), np.int64)
        y = (b[:, None, None] * fan + kids[None, :]) + np.zeros((1, fan, 1), np.int64)
        x, y = x.ravel(), y.ravel()
        ok = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
        x, y = x[ok], y[ok]
        step = 1 << 16 if level == 1 else 256  # pairs of members, or of nodes that open fan * fan more
        near_first = np.argsort(y - x, kind="stable")  # neighbours first: they join most, and the rest is passed over
        x, y = x[near_first], y[near_first]
        for at in range((len(x) - 1) // step * step, -1, -step):
            stack.append((level - 1, x[at:at + step], y[at:at + step]))
    return root


def _bucket_links(max_bits: int):
    """Streams rows sorted by bucket and Gray rank; gives a star for each component of each bucket."""
    def one(bucket: np.ndarray, codes: np.ndarray, part: np.ndarray):
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(start, len(bucket)))
        root = np.arange(len(codes))
        large = size > 2 * LEAF
        small = np.repeat(~large, size)
        for by in range(1, int(size[~large].max(initial=1))):  # small buckets are single leaves: all at once
            i = np.flatnonzero(small[:-by] & (bucket[:-by] == bucket[by:]))
            i = i[np.bitwise_count(codes[i] ^ codes[i + by]) <= max_bits]
            root = unite(root, i, i + by)
        for s, n in zip(start[large], size[large], strict=True):
            p = part[s:s + n]
            root[s:s + n] = s + index_links(codes[s:s + n], max_bits, p if p.min() != p.max() else None)
        i = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(codes[i].view(np.int64)), pa.array(codes[root[i]].view(np.int64))], names=["a", "b"])

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8)]
        for b in batches:
            new = [b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy()]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            whole = np.flatnonzero(held[0] != held[0][-1])  # the last bucket may go on
            if len(whole):
                cut = whole[-1] + 1
                yield one(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield one(*held)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Distinct ``fp`` to (a, b): links that join whatever is joined by pairs within max_bits."""
    tables = F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks(max_bits))))).alias("x")
    rows = fps.select("fp", tables).select("fp", F.xxhash64("x.t", F.col("fp").bitwiseAND(F.col("x.mask"))).alias("bucket"))
    hot = rows.groupBy("bucket").count().where(F.col("count") > max_bucket).select("bucket", F.ceil(F.col("count") / F.lit(max_bucket // 2)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("parts")).cast("int")
    rows = rows.join(hot, "bucket", "left")
    plain = rows.where("parts is null").select("bucket", "fp", F.lit(0).cast("tinyint").alias("part"))
    # Part p of n meets every part: one cell for each pair {p, q}; a cell holds two parts, and the cell {p, p} one.
    cut = (rows.where("parts is not null").withColumn("p", mine).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .select(F.xxhash64("bucket", F.least("p", "q"), F.greatest("p", "q")).alias("bucket"), "fp", (F.col("p") > F.col("q")).cast("tinyint").alias("part")))
    return (plain.union(cut).repartition("bucket").sortWithinPartitions("bucket", gray_rank(F.col("fp")), "fp", "part")
            .mapInArrow(_bucket_links(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default), ``fp``, ``component`` (its smallest fingerprint) and ``component_id``."""
    each = written(fingerprints(docs, id_col, text_col, shingle, keep), "fingerprints")
    by_fp = written(each.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    found = components(links(by_fp.select("fp"), max_bits))
    of = by_fp.join(found, by_fp.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("component"))
    of = written(of, "members")
    ids = of.groupBy("component").agg(F.min("least").alias("component_id"))
    return each.join(of.join(ids, "component").select("fp", "component", "component_id"), "fp")
