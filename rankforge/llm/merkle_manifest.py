"""Merkle manifest of a data set, built and proved by sibling-shift self-joins.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8 length,
``:`` and its text. The leaves of a source, by id, are numbered 0, 1, ...; ``arity``
consecutive nodes of a level (the last run may be shorter) have their joint digest as
parent, until one node, the subroot, is left. The subroots by source make the root alike.

Numbering: rows are dealt by range of (source, id, leaf), counted inside each range, and the
ranges' offsets come from one small table of counts, so a source with a third of the rows lies
on a third of the tasks. A level is one written table of (tree, idx): node i's slot is
i mod arity, its siblings' indices are computed (i XOR 1 for pairs, else its slot shifted by 1 ..
arity - 1 within the run) and fetched by equijoins of the level with itself; rows of slot zero then
emit the parents. All sources climb together, so there are about log(largest source) levels.

Proofs come down the same tables: a node's path is its own siblings (those to the left, those to the
right) and its parent's path, fetched by (tree, parent). ``fold`` walks a path from any leaf.
Each level is on shared storage before the next one reads it: a lost executor costs one level.

Nulls and edges: a null field is ``-``, an empty one ``0:``; a null source is a source, first in order;
null ids come first in their source; equal ids are ordered by their leaves, so repeated rows take
neighbouring places and any order of theirs gives the same rows. A lone leaf is its
source's subroot, a lone subroot the root. Texts are only hashed, where they lie, whatever their length. An empty
table gives an empty manifest. Columns that aren't named are not read; none is carried by name, so
clashing ones do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import written

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: No node: the parent of a subroot.
_NONE = -1


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joint(*digests: Column) -> Column:
    """The digest of digests' hex texts, all concatenated."""
    return F.unhex(F.sha2(hex_text(F.concat(*digests)), 256))


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of the fields' lengths and texts."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts)), 256))


def source_key(source: Column) -> Column:
    """Never null; in the order of sources: null first, then by their bytes."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit(""))


def _count_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``inside``: the row's place among its partition's rows of its tree, which lie together."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        tree = b.column(b.schema.get_field_index("key"))
        new = np.append(True, pc.not_equal(tree.slice(1), tree.slice(0, len(tree) - 1)).to_numpy(zero_copy_only=False)) if len(tree) > 1 else np.array([True])
        begin = np.flatnonzero(new)
        inside = np.arange(b.num_rows) - np.repeat(begin, np.diff(np.append(begin, b.num_rows)))
        if tree[0].as_py() == last:
            inside[: begin[1] if len(begin) > 1 else None] += seen
        last, seen = tree[b.num_rows - 1].as_py(), int(inside[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(inside, pa.int64())], names=[*b.schema.names, "inside"])


def numbered(rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """rows with a non-null ``key``: the rows with their place ``idx`` in their key by ``order``, and (key, part, offset, n), n the key's rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("key"), *order]
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
    placed = written(ranged.mapInArrow(_count_inside, T.StructType([*ranged.schema.fields, T.StructField("inside", T.LongType())])), f"merkle-{name}")
    each = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy("key")  # at most as many rows as there are partitions
    before = F.sum("_rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = each.select("key", "part", F.coalesce(before, F.lit(0)).cast("long").alias("offset"), F.sum("_rows").over(own).alias("n"))
    return placed, written(spans, f"merkle-{name}-spans")


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(tree, idx, n, h, ...) plus ``left`` and ``right``: the digests of the run's other nodes before and after it, concatenated."""
    slot, empty = F.pmod(F.col("idx"), F.lit(arity)), F.lit(b"")
    out = nodes
    for d in range(1, arity):
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + F.pmod(slot + d, F.lit(arity))
        other = nodes.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), F.col("h").alias(f"_s{d}"))
        out = out.withColumn("_at", at).join(other, (F.col("tree") == F.col("_t")) & (F.col("_at") == F.col("_i")), "left").drop("_t", "_i", "_at")

    def in_slot(t: int) -> Column:
        """The sibling in slot t, as seen from each slot."""
        seen = F
        for s in range(arity):
            if s != t:
                seen = seen.when(slot == s, F.col(f"_s{(t - s) % arity}"))
        return F.coalesce(seen, empty)

    left = F.concat(empty, *(F.when(slot > t, in_slot(t)).otherwise(empty) for t in range(arity - 1)))
    right = F.concat(empty, *(F.when(slot < t, in_slot(t)).otherwise(empty) for t in range(1, arity)))
    return out.select(*nodes.columns, left.alias("left"), right.alias("right"))


def ascend(nodes: DataFrame, most: int, arity: int = ARITY, name: str = "level") -> tuple[list[DataFrame], DataFrame]:
    """All levels (tree, idx, n, h, left, right), and (tree, h) of the trees' tops. most: nodes of the largest tree."""
    levels = []
    while True:
        # What level zero carries besides stays with it.
        levels.append(written(with_siblings(nodes, arity) if most > 1 else nodes.withColumns({"left": F.lit(b""), "right": F.lit(b"")}), f"merkle-{name}{len(levels)}"))
        if most <= 1:
            break
        first = levels[-1].where((F.col("n") > 1) & (F.pmod("idx", F.lit(arity)) == 0))
        nodes = first.select("tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), joint(F.col("h"), F.col("right")).alias("h"))
        most = -(-most // arity)
    tops = [x.where("n = 1").select("tree", "h") for x in levels]
    out = tops[0]
    for x in tops[1:]:
        out = out.unionByName(x)
    return levels, out


def descend(levels: list[DataFrame], start: DataFrame, arity: int = ARITY) -> DataFrame:
    """Level zero's rows with ``path`` (siblings from the leaf up) and what else ``start`` (tree, path, ...) has, whose path goes on from the tree's top."""
    more = [c for c in start.columns if c not in ("tree", "path")]
    over = start.select(F.col("tree").alias("_t"), F.lit(_NONE).cast("long").alias("_i"), F.col("path").alias("_path"), *more)
    above = None
    for at in range(len(levels) - 1, -1, -1):
        rows = levels[at] if at == 0 else levels[at].select("tree", "idx", "n", "left", "right")
        top = F.col("n") == 1
        rows = rows.withColumn("_up", F.when(top, F.lit(_NONE)).otherwise(F.expr(f"idx div {arity}")).cast("long"))
        parents = over if above is None else over.unionByName(above.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), F.col("path").alias("_path"), *more))
        step = F.array(F.struct("left", "right"))
        above = (rows.join(parents, (F.col("tree") == F.col("_t")) & (F.col("_up") == F.col("_i")))
                 .withColumn("path", F.when(top, F.col("_path")).otherwise(F.concat(step, F.col("_path")))).drop("_t", "_i", "_up", "_path"))
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root, in hex, that a leaf's digest has with the siblings of a path."""
    return F.aggregate(path, hex_text(leaf), lambda acc, s: F.sha2(F.concat(hex_text(s["left"]), acc, hex_text(s["right"])), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: hex_text(F.concat(s["left"], s["right"]))), ""), 256)


PATH = "array<struct<left:binary,right:binary>>"


def manifest(docs: DataFrame, fields: tuple = FIELDS, id_col: str = "doc_id", source_col: str = "source", arity: int = ARITY,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path) and the carried columns, a row for each document; digests in hex, path as binary siblings.

    carry: more columns by name, computed from ``docs`` where the leaves are.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    extra = {f"c{i}": c for i, c in enumerate((carry or {}).values())}
    made = docs.select(source_key(F.col(source_col)).alias("key"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("h"), *(c.alias(n) for n, c in extra.items()))
    placed, spans = numbered(made, [F.col("id").asc_nulls_first(), F.col("h")], "leaves")
    trees, tree_spans = numbered(spans.select("key", "n").distinct().select(F.lit("").alias("key"), F.col("key").alias("of"), "n"), [F.col("of")], "trees")
    n_trees, most = tree_spans.agg(F.max("n")).first()[0] or 0, trees.agg(F.max("n")).first()[0] or 0
    rank = trees.join(tree_spans.select("part", "offset"), "part").select(F.col("of").alias("key"), (F.col("offset") + F.col("inside")).alias("tree"))
    # (key, part): a large source has a row for each of its ranges.
    where = spans.join(rank, "key")
    leaves = placed.join(where, ["key", "part"]).select("tree", (F.col("offset") + F.col("inside")).alias("idx"), "n", "h", "id", *extra)

    levels, tops = ascend(leaves, most, arity, "level")
    subroots = written(tops, "merkle-subroots")
    roots = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_trees).cast("long").alias("n"), "h")
    upper, top = ascend(roots, n_trees, arity, "root")
    one = top.first()
    root = F.lit(one["h"].hex() if one else None).cast("string")
    none = docs.sparkSession.range(1).select(F.col("id").alias("tree"), F.array().cast(PATH).alias("path"))
    start = written(descend(upper, none, arity).select(F.col("idx").alias("tree"), "path", F.col("h").alias("subroot")), "merkle-paths")
    rows = descend(levels, start, arity)
    return rows.select(F.col("id").alias(id_col), hex_text(F.col("h")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), root.alias("root"), "path",
                       *(F.col(n).alias(c) for n, c in zip(extra, carry or {}, strict=True)))
