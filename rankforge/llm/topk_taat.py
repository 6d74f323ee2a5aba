"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A vector's component x becomes the integer floor(scale * x); a dimension is a
term, and a candidate's non-zero weight in it a posting. A block of candidates
is inverted in one task; a block of queries scatters, term after term, its
weights times the postings' into dense score arrays (candidates x queries). Each
array is cut to its k best by partition selection, ties to the smaller id, and the
blocks' bests are merged per query. Candidates and queries are both dealt to blocks
by hash, so a task holds one block of each however large the table is, and every query
meets every block.

Nulls and edges: a null vector, or one with a null or non-finite component, takes no
part, as query or candidate; an empty vector takes part and scores 0. Vectors of
unlike length are compared over the dimensions both have. A null id is never a query; as a
candidate it comes last among ties. A query's own row is left out, and rows that
repeat its id are candidates like others. Products are exact: candidates whose sums could
leave 64 bits are scored in Python's integers. A component or a score among the k best that has no place in
64 bits is an error, as in SQL. Extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 4096
#: Queries whose score arrays are held at once.
AT_ONCE = 64
_LAST = np.iinfo(np.int64).max


def _matrix(rows: pd.Series) -> np.ndarray:
    wide = max((len(r) for r in rows), default=0)
    if len(rows) and all(len(r) == wide for r in rows):
        return np.stack(rows.to_numpy()).astype(np.int64) if wide else np.zeros((len(rows), 0), np.int64)
    out = np.zeros((len(rows), wide), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _postings(x: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For each term, who has it and with which weight."""
    out = []
    for t in range(x.shape[1]):
        who = np.flatnonzero(x[:, t])
        out.append((slice(None) if len(who) == len(x) else who, np.ascontiguousarray(x[who, t])))
    return out


def _best(score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores (all, if fewer), ties by order."""
    if score.dtype == object:
        return np.array(heapq.nsmallest(k, range(len(score)), key=lambda i: (-score[i], order[i])), np.int64)
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((order[at], -score[at]))[:k]]


def _block(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="Int64"), "score": pd.Series(dtype="int64"), "beyond": pd.Series(dtype="int64")})
        if candidates.empty or queries.empty:
            return none
        ids = candidates["id"].astype("Int64")
        missing = ids.isna().to_numpy()
        ids = ids.fillna(_LAST).to_numpy(np.int64)
        rows = candidates["row"].to_numpy()
        q = _matrix(queries["terms"])
        c = _matrix(candidates["terms"])
        postings, dims = _postings(c), min(q.shape[1], c.shape[1])
        most = np.abs(c).max(1, initial=0)
        out = []
        for at in range(0, len(q), AT_ONCE):
            part = q[at:at + AT_ONCE]
            score = np.zeros((len(ids), len(part)), np.int64)
            for t in range(min(part.shape[1], len(postings))):
                who, weight = postings[t]
                has = np.flatnonzero(part[:, t])
                if len(has) == len(part):
                    score[who] += weight[:, None] * part[None, :, t]
                elif len(has):
                    to = (who, has) if isinstance(who, slice) else np.ix_(who, has)
                    score[to] += weight[:, None] * part[None, has, t]
            wide = np.flatnonzero(most > _LAST // max(1, dims * int(np.abs(part).max(initial=0))))
            if len(wide):
                score = score.astype(object)
                score[wide] = c[wide, :dims].astype(object) @ part[:, :dims].T.astype(object)
            by_query = np.ascontiguousarray(score.T)
            for i, (query, row) in enumerate(zip(queries["id"].iloc[at:at + AT_ONCE], queries["row"].iloc[at:at + AT_ONCE], strict=True)):
                own = np.flatnonzero(rows == row)
                s, o = np.delete(by_query[i], own), np.delete(ids, own)
                m = np.delete(missing, own)
                best = _best(s, o, k)
                s = s[best]
                beyond = (s > _LAST).astype(np.int64) - (s < -_LAST).astype(np.int64)  # above or below what fits
                out.append(pd.DataFrame({"query_id": query, "vec_id": pd.Series(o[best]).astype("Int64").mask(m[best]), "score": np.where(beyond == 0, s, 0).astype(np.int64), "beyond": beyond}))
        return pd.concat(out, ignore_index=True) if out else none

    return run


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, row, terms) of the rows that take part; row tells rows with equal ids apart by their place among equals."""
    x = F.col(vector_col)
    good = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fits = F.lit(float(1 << 63))
    terms = F.transform(x, lambda v: F.when(F.abs(F.lit(float(scale)) * v.cast("double")) < fits, F.floor(F.lit(float(scale)) * v.cast("double")))
                        .otherwise(F.raise_error(F.lit("a component has no place in 64 bits")).cast("long")).cast("long"))
    own = rows.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), terms.alias("terms"))
    place = Window.partitionBy("id", F.xxhash64("terms")).orderBy("id")  # equal rows only: any order is the same order
    return own.withColumn("row", F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.xxhash64("terms"), F.row_number().over(place)))


def top_k(rows: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
          candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (on ``id``) holds, against all rows."""
    from rankforge.llm.common import written

    own = written(vectors(rows, id_col, vector_col, scale), "vectors")
    queries = own.where(F.col("id").isNotNull() & is_query)
    n, m = own.count(), queries.count()
    blocks, q_blocks = max(1, -(-n // candidate_block)), max(1, -(-m // query_block))

    def dealt(df, mine, mine_n, other, other_n):
        return (df.withColumn(mine, F.pmod(F.xxhash64("row"), F.lit(mine_n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))))

    c = dealt(own, "cb", blocks, "qb", q_blocks).groupBy("cb", "qb")
    q = dealt(queries, "qb", q_blocks, "cb", blocks).groupBy("cb", "qb")
    part = c.cogroup(q).applyInPandas(_block(k), "query_id long, vec_id long, score long, beyond long")
    # A query id that several rows have gives the best of all of them.
    order = Window.partitionBy("query_id").orderBy(F.col("beyond").desc(), F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score has no place in 64 bits")).cast("long")).alias("score")
    return part.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score)
