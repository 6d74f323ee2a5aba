"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

Equal vectors are one node, which keeps its ``k + 1`` smallest ids: more of them can be in no
result, so nothing is lost, and a vector that a third of the rows have is a node like any other. Nodes are dealt by
hash to shards of about ``SHARD``. A shard's graph is built in one task: a node's level is drawn
geometrically, nodes come in by falling level, and each links to at most ``M`` earlier nodes that it prefers (a candidate
is passed over if it is nearer to one already chosen than to the node). Candidates are the ``BUILD``
nearest of all earlier ones, scored exhaustively inside the shard, which is bounded. Links
are taken up in both directions and cut to ``2 * M`` by the same preference on the bottom level (``M`` above);
a node that the cuts leave out of reach gets a link from its nearest earlier one. The graph is a row of a written table: the
vectors, and per level one flat array of neighbours, -1 where there are fewer.

Queries, in blocks, meet every shard. All queries of a block walk side by side: from the
top level down with a short beam, on the bottom with a beam of ``BEAM``; what the beam holds is scored again on the
original vectors in double precision, and the shards' bests are merged by query.
A test measures the recall against brute force (0.9 or more is asked).

Nulls and edges: a vector that is null, empty, all zero, or has a null or non-finite component takes no part,
as query or candidate. Vectors of unlike length are compared as if filled up with zeros. A null id is never
a query; as a candidate it comes last among ties. A query's own row is left out, rows that repeat its id or its vector are
candidates like others. With fewer than k candidates all of them come. Empty tables give empty tables. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import written

K = 5
M = 16
BUILD = 64
BEAM = 128
#: The beam on the levels above the bottom.
DOWN = 8
SHARD = 8192
QUERY_BLOCK = 4096
#: Queries that walk side by side, and nodes whose candidates are scored at once.
AT_ONCE = 256
#: Nodes of a beam that are expanded together.
STEP = 4
#: Candidates for a node's links, own and from others, the nearest.
MOST = 160


@dataclass
class Graph:
    vectors: np.ndarray  # nodes x dimensions, as given
    unit: np.ndarray  # of length 1, single precision
    #: per level from the bottom: flat neighbour array, nodes of the level x width; nodes are numbered by falling level
    links: list[np.ndarray]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square leaves the range."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def preferred(unit: np.ndarray, node: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates (nearest first, -1: none) at most ``most``: those no nearer to a chosen one than to the node, then the nearest others."""
    have = near >= 0
    of = unit[near]
    to_node = np.where(have, np.einsum("ijk,ik->ij", of, unit[node]), -np.inf)
    between = of @ of.transpose(0, 2, 1)
    passed = ~have
    chosen = np.zeros_like(have)
    count = np.zeros(len(node), int)
    for c in range(near.shape[1]):
        take = ~passed[:, c] & (count < most)
        if take.any():
            chosen[take, c] = True
            count[take] += 1
            passed[take] |= between[take, c] >= to_node[take]
    rank = np.argsort(np.where(chosen, 0, np.where(have, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, rank, 1)


def _grouped(key: np.ndarray, value: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """By key 0..n-1 its values, highest score first, the MOST highest; -1 fills up."""
    order = np.lexsort((value, -score, key))
    key, value = key[order], value[order]
    size = np.bincount(key, minlength=n)
    place = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
    out = np.full((n, min(int(size.max(initial=0)), MOST)), -1, np.int32)
    on = place < out.shape[1]
    out[key[on], place[on]] = value[on]
    return out


def _level(unit: np.ndarray, m: int, most: int) -> np.ndarray:
    """Links of one level's nodes, which are the rows of ``unit`` in the order they come in."""
    n = len(unit)
    own = np.full((n, m), -1, np.int32)
    for at in range(0, n, AT_ONCE):
        node = np.arange(at, min(at + AT_ONCE, n))
        score = unit[node] @ unit[:node[-1] + 1].T
        score[np.arange(score.shape[1]) >= node[:, None]] = -np.inf  # earlier ones only
        c = min(BUILD, score.shape[1])
        near = np.argpartition(-score, c - 1, axis=1)[:, :c]
        s = np.take_along_axis(score, near, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        near = np.where(np.take_along_axis(s, order, 1) > -np.inf, np.take_along_axis(near, order, 1), -1)
        got = preferred(unit, node, near, m)
        own[node, :got.shape[1]] = got
    a, j = np.nonzero(own >= 0)
    b = own[a, j]
    s = np.einsum("ij,ij->i", unit[a], unit[b])
    both = _grouped(np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([s, s]), n)
    out = np.full((n, most), -1, np.int32)
    for at in range(0, n, AT_ONCE):
        node = np.arange(at, min(at + AT_ONCE, n))
        got = preferred(unit, node, both[node], most)
        out[node, :got.shape[1]] = got
    return _in_reach(out, own)


def _reached(links: np.ndarray, seen: np.ndarray, begin: np.ndarray) -> np.ndarray:
    while len(begin):
        begin = np.unique(links[begin])
        begin = begin[begin >= 0]
        begin = begin[~seen[begin]]
        seen[begin] = True
    return seen


def _in_reach(links: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Nodes that can't be reached from the first one get a link from their first choice, an earlier node."""
    if not len(links):
        return links
    seen = np.zeros(len(links), bool)
    seen[0] = True
    _reached(links, seen, np.array([0]))
    more: dict[int, list[int]] = {}
    for i in np.flatnonzero(~seen):
        if not seen[i]:
            more.setdefault(int(own[i, 0]), []).append(int(i))
            seen[i] = True
            _reached(links, seen, np.array([i]))
    if more:
        wide = np.full((len(links), max(map(len, more.values()))), -1, np.int32)
        for j, of in more.items():
            wide[j, :len(of)] = of
        links = np.hstack([links, wide])
    return links


def build(vectors: np.ndarray, m: int = M, seed: int = 5) -> tuple[Graph, np.ndarray]:
    """The graph, and the order that its nodes are in."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m)).astype(int)
    order = np.argsort(-level, kind="stable")
    level, vectors = level[order], vectors[order]
    unit = unit_rows(vectors).astype(np.float32)
    links = [_level(unit[:int((level >= at).sum())], m, 2 * m if at == 0 else m) for at in range(int(level[0]) + 1)]
    return Graph(vectors, unit, links), order


def beam(graph: Graph, level: int, query: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes that each query meets on a level, and their cosines; ``size`` are held, -1: none. start: places by query, -1: none."""
    links, unit = graph.links[level], graph.unit
    n = len(query)
    seen = np.zeros((n, len(links) + 1), bool)  # the last column stands for no node
    seen[:, -1] = True
    who, score, done = np.full((n, size), -1), np.full((n, size), -np.inf, np.float32), np.ones((n, size), bool)
    rows, new = np.arange(n), start
    while len(rows):
        new = np.sort(new, axis=1)
        fresh = ~seen[rows[:, None], new]
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        r, c = np.nonzero(fresh)
        seen[rows[r], new[r, c]] = True
        s = np.full(new.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("ij,ij->i", query[rows[r]], unit[new[r, c]])
        all_s = np.hstack([score[rows], s])
        top = np.argpartition(-all_s, size - 1, axis=1)[:, :size]
        score[rows] = np.take_along_axis(all_s, top, 1)
        who[rows] = np.take_along_axis(np.hstack([who[rows], np.where(fresh, new, -1)]), top, 1)
        done[rows] = np.take_along_axis(np.hstack([done[rows], ~fresh]), top, 1)
        rows = rows[~done[rows].all(1)]
        if len(rows):
            open_ = np.where(done[rows], -np.inf, score[rows])
            pick = np.argpartition(-open_, min(STEP, size) - 1, axis=1)[:, :STEP]
            live = np.take_along_axis(open_, pick, 1) > -np.inf
            done[rows[:, None], pick] = True
            new = np.where(live[:, :, None], links[who[rows[:, None], pick]], -1).reshape(len(rows), -1)
    return who, score


def search(graph: Graph, query: np.ndarray, size: int = BEAM) -> np.ndarray:
    """For each query (rows of length 1) the nodes in its last beam, -1: none."""
    at = np.zeros((len(query), 1), int)
    for level in range(len(graph.links) - 1, 0, -1):
        at, _ = beam(graph, level, query, at, DOWN)
    return beam(graph, 0, query, at, size)[0]


def _padded(rows: pd.Series) -> np.ndarray:
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("h", kind="stable")
    graph, order = build(_padded(rows["v"]))
    ids = [rows["ids"].iloc[i] for i in order]
    # The numbers of missing ids come last in their node.
    known = [[int(x) for x in of if x is not None and x == x] for of in ids]
    return pd.DataFrame([{
        "shard": int(rows["shard"].iloc[0]), "nodes": len(rows), "vectors": graph.vectors.astype("<f8").tobytes(),
        "links": [x.astype("<i4").tobytes() for x in graph.links], "level_nodes": [len(x) for x in graph.links],
        "ids": np.array([x for of in known for x in of], "<i8").tobytes(), "known": np.array([len(of) for of in known], "<i4").tobytes(),
        "unknown": np.array([len(of) - len(k) for of, k in zip(ids, known, strict=True)], "<i4").tobytes()}])


_INDEX = "shard int, nodes int, vectors binary, links array<binary>, level_nodes array<int>, ids binary, known binary, unknown binary"


def _search_shard(k: int, size: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="Int64"), "score": pd.Series(dtype="float64")})
        if index.empty or queries.empty:
            return none
        r = index.iloc[0]
        vectors = np.frombuffer(r["vectors"], "<f8").reshape(r["nodes"], -1)
        given = _padded(queries["v"])
        wide = max(vectors.shape[1], given.shape[1])
        vectors, given = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (vectors, given))
        exact, q = unit_rows(vectors), unit_rows(given)
        graph = Graph(vectors, exact.astype(np.float32), [np.frombuffer(x, "<i4").reshape(n, -1) for x, n in zip(r["links"], r["level_nodes"], strict=True)])
        ids, known, unknown = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["known"], "<i4"), np.frombuffer(r["unknown"], "<i4")
        first = np.cumsum(known) - known
        out = []
        for at in range(0, len(q), AT_ONCE):
            found = search(graph, q[at:at + AT_ONCE].astype(np.float32), size)
            for i, nodes in enumerate(found, at):
                nodes = nodes[nodes >= 0]
                score = exact[nodes] @ q[i]
                best = np.argsort(-score, kind="stable")
                own, query = np.flatnonzero((vectors[nodes] == given[i]).all(1)), int(queries["id"].iloc[i])
                rows: list[tuple] = []
                for b in best:
                    if len(rows) > k and score[b] < rows[k][0]:  # k rows are better, and one more that may be the query's own
                        break
                    n = nodes[b]
                    of = ids[first[n]:first[n] + known[n]].tolist()
                    if b in own and query in of:
                        of.remove(query)
                    rows += [(score[b], x) for x in of] + [(score[b], None)] * int(unknown[n])
                rows = sorted(rows, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
                out += [(query, x, s) for s, x in rows]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"vec_id": "Int64"}) if out else none

    return run


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part; zeros at the end are left out, so that equal directions of unlike length are equal."""
    x = F.col(vector_col)
    good = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    return rows.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: v.cast("double")).alias("v"))


def index(points: DataFrame, k: int = K, shard: int = SHARD) -> tuple[DataFrame, int]:
    """(id, v) to one row for each shard that has nodes: its graph; and the number of shards."""
    order = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    some = points.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    nodes = written(some.groupBy("v").agg(F.collect_list(F.struct("_n", "id")).alias("of"))
                    .select("v", F.transform(F.array_sort("of"), lambda x: x["id"]).alias("ids"), F.xxhash64("v").alias("h")), "ann-nodes")
    shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.withColumn("shard", F.pmod(F.col("h"), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("shard").applyInPandas(_build_shard, _INDEX), "ann-graphs"), shards


def nearest(rows: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", beam_size: int = BEAM,
            shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (on ``id``) holds, against all rows."""
    points = vectors(rows, id_col, vector_col)
    graphs, shards = index(points, k, shard)
    queries = written(points.where(F.col("id").isNotNull() & is_query).distinct(), "ann-queries")
    blocks = max(1, -(-queries.count() // query_block))
    of = queries.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    met = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("shard", "block")
    asked = of.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).groupBy("shard", "block")
    part = met.cogroup(asked).applyInPandas(_search_shard(k, beam_size), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return part.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
