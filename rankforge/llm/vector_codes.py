"""Vector code compression by member-resident Lloyd rounds.

A vector's component x becomes the integer floor(scale * x); vectors are cut into ``parts`` equal
consecutive parts, and each part position has a codebook of ``entries`` entries, at first that
part of the vectors with the smallest ids. A part's code is the nearest entry (squared Euclidean
distance, ties to the lower index).

Parts live with the owner of (position, entry, salt), dealt out once after the first
assignment; the salt splits an entry that holds many parts. In a round every owner assigns its resident
members anew: those that stay are summed up where they lie, and only those that change their entry
go through the shuffle, to their new owner, into the round's own table. The next codebook is the floor of the means: the
owners' sums of what stayed plus what came. Tables are never rewritten: whether a row of an earlier table has left since
is seen from the row itself, by the codebooks in between (a few entries each, which every task has). So what is
written after the first table is what moved, and each round's table is on shared storage before the
next codebook: a lost executor costs a part of one round. The driver holds codebooks only.

Nulls and edges: a vector that is null or has a null or non-finite component takes no part and has no
row in the result. Vectors of unlike length are filled up with zeros to the longest, and that to a
multiple of ``parts``. Null ids come last among the smallest; equal ids are ordered by their vectors, and repeated rows
are vectors of their own. With fewer rows than entries, each row's part is an entry. Entries without parts stay as they are.
An empty table gives an empty result. Sums and distances are exact: in 64 bits where they fit, in Python's integers
otherwise; a component or an error without a place in 64 bits is an error. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import share, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Parts that an owner has, about, if all vectors are alike.
RESIDENT = 1024
#: came: a part that has this owner now; else a sum of parts that have stayed with theirs.
_STATE = "came boolean, position int, entry int, salt int, n long, x array<long>"


@dataclass
class Books:
    """One codebook per part position: entries x components."""
    books: list[np.ndarray]

    def text(self) -> str:
        """All components by part, entry and place."""
        return ",".join(str(int(x)) for book in self.books for entry in book for x in entry)

    def digest(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry and its squared distance; exact."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bound = max(1, x.shape[1]) * (_largest(x) + _largest(book)) ** 2
    if bound < 1 << 52:  # all sums below are integers that doubles hold
        f, c = x.astype(np.float64), book.astype(np.float64)
        d = (f * f).sum(1)[:, None] - 2 * (f @ c.T) + (c * c).sum(1)
    else:
        kind = np.int64 if bound < 1 << 63 else object
        d = np.stack([((x.astype(kind) - entry.astype(kind)) ** 2).sum(1) for entry in book], axis=1)
    at = np.argmin(d, axis=1) if d.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in d])
    least = d[np.arange(len(d)), at]
    return at, least.astype(np.int64) if least.dtype != object else least


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], np.ascontiguousarray(x).ravel())


def _matrix(col: pa.ListArray, wide: int) -> np.ndarray:
    """The lists as rows, filled up with zeros."""
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (size == wide).all():
        return flat.reshape(len(col), wide)
    out = np.zeros((len(col), wide), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _state(came: bool, position, entry, salt, n, x: np.ndarray) -> pa.RecordBatch:
    columns = [np.broadcast_to(a, len(x)) for a in (came, position, entry, salt, n)]
    kinds = (pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([*(pa.array(a, k) for a, k in zip(columns, kinds, strict=True)), _lists(x)], names=["came", "position", "entry", "salt", "n", "x"])


def integers(rows: DataFrame, keep: list[Column], vector_col: str, scale: int = SCALE) -> DataFrame:
    """The kept columns and ``v`` of the rows that take part."""
    x = F.col(vector_col)
    good = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    at = lambda v: F.lit(float(scale)) * v.cast("double")
    whole = F.transform(x, lambda v: F.when(F.abs(at(v)) < F.lit(float(1 << 63)), F.floor(at(v))).otherwise(F.raise_error(F.lit("a component has no place in 64 bits")).cast("long")).cast("long"))
    return rows.where(F.coalesce(good, F.lit(False))).select(*keep, whole.alias("v"))


def _settle(held, wide: int, salts: int):
    """The first assignment: a row for each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held().books
        size, seen = wide // len(books), 0
        for b in batches:
            x = _matrix(b.column(0), wide).reshape(b.num_rows, len(books), size)
            entry = np.stack([nearest(x[:, p], book)[0] for p, book in enumerate(books)], axis=1)
            salt = (seen + np.arange(b.num_rows)) % salts
            seen += b.num_rows
            yield _state(True, np.tile(np.arange(len(books)), b.num_rows), entry.ravel(), np.repeat(salt, len(books)), 1, x.reshape(entry.size, size))

    return run


def _reassign(held, since: int, size: int):
    """What a round makes of the parts that came when codebook ``since`` was the last: those that move, with their new entry, and sums of those that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = held()
        for b in batches:
            position, entry, salt = (b.column(i).to_numpy() for i in range(3))
            x = _matrix(b.column(3), size)
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                for books in history[since + 1:-1]:  # whether they are still here
                    at = at[nearest(x[at], books.books[p])[0] == entry[at]]
                new = nearest(x[at], history[-1].books[p])[0]
                go = new != entry[at]
                if go.any():
                    yield _state(True, p, new[go], salt[at[go]], 1, x[at[go]])
                at = at[~go]
                for e in np.unique(entry[at]):
                    of = at[entry[at] == e]
                    if _largest(x[of]) < (1 << 62) // len(of):
                        yield _state(False, p, e, salt[of[0]], len(of), x[of].sum(0)[None])
                    else:  # left to the wider sum
                        yield _state(False, p, e, salt[of], 1, x[of])

    return run


def update(books: Books, table: DataFrame, size: int) -> Books:
    """The next codebooks: the floor of the means of a round's members, those that came and the sums of those that stayed."""
    total = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    new = [b.copy() for b in books.books]
    for r in table.groupBy("position", "entry").agg(F.sum("n").alias("n"), *total).collect():  # one row for each entry
        new[r["position"]][r["entry"]] = np.array([int(r[f"s{i}"]) // r["n"] for i in range(size)], np.int64)
    return Books(new)


def _owned(rows: DataFrame, name: str) -> DataFrame:
    return written(rows.repartition("position", "entry", "salt"), f"codes-{name}")


def train(vectors: DataFrame, id_col: str = "id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, resident: int = RESIDENT) -> tuple[Books, int]:
    """vectors (id, v), v as ``integers`` gives them: the codebooks after all rounds, and the number of components with filling."""
    n, wide = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    wide = -(-wide // parts) * parts
    size = wide // parts
    first = vectors.orderBy(F.col(id_col).asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), wide), np.int64)
    for row, r in zip(start, first, strict=True):
        row[:len(r["v"])] = r["v"]
    history = [Books([np.ascontiguousarray(start[:, p * size:(p + 1) * size]) for p in range(parts)])]
    if not n:
        return history[0], wide
    spark, salts = vectors.sparkSession, -(-n // resident)
    tables = [_owned(vectors.select("v").mapInArrow(_settle(share(spark, history[0]), wide, salts), _STATE), "members")]
    for _ in range(rounds):
        if len(history) > 1:
            held = share(spark, list(history))
            members = [t.where("came").select("position", "entry", "salt", "x").mapInArrow(_reassign(held, since, size), _STATE) for since, t in enumerate(tables)]
            tables.append(_owned(reduce(DataFrame.unionByName, members), f"round{len(tables)}"))
        history.append(update(history[-1], tables[-1], size))
    return history[-1], wide


def encode(vectors: DataFrame, books: Books, wide: int) -> DataFrame:
    """All columns but ``v``, which comes last in ``vectors``, plus ``code`` (one byte for each part) and ``error``. No shuffle."""
    held = share(vectors.sparkSession, books)
    keep = vectors.columns[:-1]
    named = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held().books
        size = wide // len(of)
        for b in batches:
            x = _matrix(b.column(len(named)), wide)
            found = [nearest(x[:, p * size:(p + 1) * size], book) for p, book in enumerate(of)]
            code = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            error = [sum(map(int, d)) for d in zip(*(d for _, d in found), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(named))), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error, pa.int64())], names=[*named, "code", "error"])

    src = vectors.toDF(*named, "v")
    out = src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]))
    return out.toDF(*keep, "code", "error")


def summed_by(rows: DataFrame, by: str, value: str, out: str, salts: int = 16) -> DataFrame:
    """rows plus the sum of ``value`` over the rows with an equal ``by``, nulls together. The sums are repeated by salt: a value of ``by`` that a third of the rows have meets them in many places."""
    key = F.coalesce(F.concat(F.lit("+"), F.col(by).cast("string")), F.lit(""))
    total = rows.groupBy(key.alias("_key")).agg(F.sum(value).alias(out)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_key", key).withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    return salted.join(total, ["_key", "_salt"]).select(*rows.columns, out)


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: list[str] | None = None, scale: int = SCALE, parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, resident: int = RESIDENT) -> tuple[DataFrame, Books]:
    """(id, kept columns, code, error) of the vectors that take part, and the codebooks. At most 256 entries."""
    if entries > 256:
        raise ValueError("a code is one byte")
    keep = keep or []
    vectors = integers(rows, [F.col(id_col), *(F.col(c) for c in keep)], vector_col, scale)
    books, wide = train(vectors.toDF("id", *(f"k{i}" for i in range(len(keep))), "v").select("id", "v"), "id", parts, entries, rounds, resident)
    return encode(vectors, books, wide), books
