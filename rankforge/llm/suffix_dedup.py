"""Removal of repeated substrings by external induced sorting of sampled suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts anywhere
else. Texts that are equal are taken once with their number of copies.

Sample. Every start s of a string has an anchor, the position of the least hash of
``GRAM`` bytes inside the string. Equal strings have their anchors at the same
place, so only the suffixes at anchors (about one in 80) are sorted first, and
those of the other starts are induced from them. An anchor owns the run of
starts [lo, hi] that have it. Sorted by (hash, name of all that its starts
can see), tuples that are equal to a neighbour have all their starts repeated; a
tuple whose hash stands alone has none. A hash that is frequent within one task's batch
is dealt out by name, after its tuples with one name became one, so no hash holds a task up. What is left are anchors at the ends of repeated
passages.

Induction. Their suffixes, with the bytes before them, are dealt by anchor hash and
sorted; each carries the length of the prefix it shares with its predecessor.
Step d goes back one byte: tuples are popped in order of (byte before, rank so
far), which is the order of the suffixes that begin d bytes before the anchors,
and the shared length of new neighbours is one more than the least between their
old places. A start is repeated if a neighbour shares ``LENGTH`` bytes with it. Tuples
that can't reach that length any more drop out.

Larger than memory: the queue of tuples is Spark's external sorter, which keeps
its runs on disk and hands them out in order; a task holds one batch of it
(whole groups of equal hash, ``QUEUE_ROWS`` tuples), and the first sweep keeps one
row and a flag. A hash with more than ``HOT`` different contexts would hold one
task up: its starts are named one by one instead and counted by name over all
tasks, which is as exact.

Names are 128-bit hashes. Nulls and edges: a null text is empty; texts under LENGTH bytes keep all.
Null ids are passed through, repeated rows each get their row (and are copies). An
empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import chunks, written

LENGTH = 200
GRAM = 48
QUEUE_ROWS = 1 << 15
HOT = 1 << 14
LOCAL_HOT = 32
#: Positions of a text that are hashed at once.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each position; the same bytes have the same hash wherever they are."""
    if not _TABLES:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, PIECE + 4096), _powers(_INVERSE, PIECE + 4096)
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _TABLES["up"][:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * _TABLES["down"][:n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, lo, hi) of each anchor: the starts lo..hi have it. Ties go to the first place."""
    starts = len(data) - length + 1
    if starts <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z
    out = []
    window = length - gram + 1
    for at in range(0, starts, PIECE):  # starts at .. at + PIECE - 1 see up to PIECE + length bytes
        some = min(PIECE, starts - at)
        h = gram_hashes(data[at:at + some + length - 1], gram)
        place = np.arange(len(h), dtype=np.uint64)
        low = np.uint64((1 << 21) - 1)
        both = (h & ~low) | place
        rows = -(-len(both) // window)
        full = np.full(rows * window, ~np.uint64(0))
        full[:len(both)] = both
        full = full.reshape(rows, window)
        ahead = np.minimum.accumulate(full, axis=1).ravel()
        behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:some], ahead[window - 1:window - 1 + some])
        who = (least & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        out.append((h[who[first]], who[first] + at, first + at, np.append(first[1:], some) - 1 + at))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pack(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return p << 16 | (p - lo) << 8 | (p - hi)


def _unpack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p = x >> 16
    return p, p - (x >> 8 & 255), p - (x & 255)


_SALTED, _KNOWN, _SHARED, _MANY = 1, 2, 4, 8


def _dealt(fp, k1, k2, x1, x2, at, local_hot: int) -> list[np.ndarray]:
    """Adds to a batch's tuples where each is dealt to, and its flags.

    A hash with ``local_hot`` tuples here goes to its names' places instead of its own (_SALTED), and one row in
    its own place says that it is shared (_SHARED). Of its tuples with one name a single one is dealt out (_MANY);
    the others are known to be repeated and only pass through (_KNOWN).
    """
    order = np.lexsort((k2, k1, fp))
    fp, k1, k2, x1, x2, at = (c[order] for c in (fp, k1, k2, x1, x2, at))
    new_fp = np.append(True, fp[1:] != fp[:-1])
    new_name = new_fp | np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    start = np.flatnonzero(new_fp)
    size = np.diff(np.append(start, len(fp)))
    hot = np.repeat(size >= local_hot, size)
    name = np.flatnonzero(new_name)
    several = np.zeros(len(fp), bool)
    several[name] = np.diff(np.append(name, len(fp))) > 1
    flag = np.where(hot, np.where(new_name, _SALTED | np.where(several, _MANY, 0), _KNOWN), 0).astype(np.int8)
    route = np.where(hot, np.where(new_name, fp ^ (k1 * 31 + 1), x1 ^ at), fp)
    told = fp[start[size >= local_hot]]
    z = np.zeros(len(told), np.int64)
    return [np.concatenate(c) for c in ((route, told), (fp, told), (k1, z), (k2, z), (x1, z), (x2, z), (at, z - 1), (flag, np.full(len(told), _SHARED, np.int8)))]


def _anchor_rows(length: int, gram: int, local_hot: int):
    """(x1, x2, text) to tuples (route, fp, k1, k2, x1, x2, at, flag); k is the name of text[lo : hi + length] and the anchor's place in it."""
    def run(batches):
        for b in batches:
            parts, size = [], 0
            for x1, x2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                if text is None or len(text) < length:
                    continue
                fp, p, lo, hi = anchors(np.frombuffer(text, np.uint8), length, gram)
                names = b"".join([hashlib.blake2b(text[a:z + length], digest_size=16, salt=bytes((q - a,))).digest() for q, a, z in zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True)])
                k = np.frombuffer(names, np.int64).reshape(-1, 2)
                parts.append((fp.view(np.int64), k[:, 0], k[:, 1], np.full(len(p), x1), np.full(len(p), x2), _pack(p, lo, hi)))
                size += len(p)
                if size > PIECE // 4:
                    yield _tuples(parts, local_hot)
                    parts, size = [], 0
            if parts:
                yield _tuples(parts, local_hot)

    return run


def _tuples(parts: list, local_hot: int) -> pa.RecordBatch:
    cols = _dealt(*(np.concatenate(c) for c in zip(*parts, strict=True)), local_hot)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["route", "fp", "k1", "k2", "x1", "x2", "at", "flag"])


def _sweep(batches):
    """Tuples sorted by (route, fp, k1, k2) to (fp, x1, x2, at, sure, ask): sure, all its starts are repeated; ask, its context is needed.

    A group is one hash in one place. Its tuples are sure if a neighbour has their name; the first tuple of each name is
    asked if the group has a second name. Holds a batch, one tuple more, and the first tuple of a group until a second name shows up.
    """
    prev = None  # the tuple before the first held one
    pending = None  # first tuple of the current group, if it wasn't asked yet
    held: list[np.ndarray] | None = None
    names = ["fp", "x1", "x2", "at", "sure", "ask"]

    def settle(rows, n):
        """Decides the first n rows; the row after them, if any, is known."""
        nonlocal prev, pending
        before = [np.concatenate([[prev[i]] if prev else c[:1], c[:-1]]) for i, c in enumerate(rows[:4])]
        old_group = (rows[0] == before[0]) & (rows[1] == before[1])
        old_name = old_group & (rows[2] == before[2]) & (rows[3] == before[3])
        if prev is None:
            old_group[0] = old_name[0] = False
        flag = rows[7]
        sure = old_name | (flag & _MANY > 0)
        sure[:-1] |= old_name[1:]
        second = (old_group & ~old_name)[:n]  # first tuple of a further name
        first = ~old_group[:n]
        group = np.cumsum(first)
        ask = second | (~old_name[:n] & (flag[:n] & _SALTED > 0))
        has_second = np.zeros(group[-1] + 1, bool)
        has_second[group[second]] = True
        late = pending if pending is not None and has_second[0] else None
        if late is not None:
            pending = None
        at = np.flatnonzero(first)
        ask[at] |= has_second[group[at]]
        if len(at):
            last = at[-1]
            pending = None if ask[last] else [*(c[last] for c in rows), sure[last]]
        prev = [c[n - 1] for c in rows[:4]]
        keep = np.flatnonzero((sure[:n] | ask) & (flag[:n] & _SHARED == 0))
        cols = [rows[i][keep] for i in (1, 4, 5, 6)] + [sure[:n][keep], ask[keep]]
        if late is not None and not late[7] & _SHARED:  # given out before, if it was sure; now it only asks
            cols = [np.append(c, v) for c, v in zip(cols, (late[1], late[4], late[5], late[6], late[8], True), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    for b in batches:
        new = [b.column(i).to_numpy() for i in range(8)]
        known = new[7] & _KNOWN > 0
        if known.any():
            yes = np.ones(int(known.sum()), bool)
            yield pa.RecordBatch.from_arrays([pa.array(new[i][known]) for i in (1, 4, 5, 6)] + [pa.array(yes), pa.array(~yes)], names=names)
            new = [c[~known] for c in new]
        if not len(new[0]):
            continue
        rows = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        if len(rows[0]) > 1:
            yield settle(rows, len(rows[0]) - 1)
        held = [c[-1:] for c in rows]
    if held is not None:
        yield settle(held, 1)


def _contexts(length: int):
    """Texts with their anchors to the contexts that induction needs: text[lo : hi + length] and where the anchor is."""
    def run(batches):
        for big in batches:
            for b in chunks(big):
                out = [[] for _ in range(8)]
                for x1, x2, text, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist(), strict=True):
                    for a in asked:
                        p, lo, hi = _unpack(np.int64(a["at"]))
                        for col, v in zip(out, (a["fp"], x1, x2, int(p), int(p - lo), not a["sure"], text[lo:hi + length], a["hot"]), strict=True):
                            col.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                                                      pa.array(out[4], pa.int32()), pa.array(out[5], pa.bool_()), pa.array(out[6], pa.binary()), pa.array(out[7], pa.bool_())],
                                                     names=["fp", "x1", "x2", "p", "back", "solo", "context", "hot"])

    return run


def _range_min(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values a..b (a <= b) from a table of powers of two."""
    level = np.frexp((b - a + 1).astype(float))[1] - 1
    out = np.empty(len(a), np.int32)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << int(k)) + 1])
    return out


def _min_table(v: np.ndarray) -> list[np.ndarray]:
    table = [v]
    while (1 << len(table)) <= len(v):
        t, by = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(t[:-by], t[by:]))
    return table


def induce(group: np.ndarray, back: np.ndarray, contexts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, d): the starts, d bytes before the row's anchor, whose string also starts elsewhere among the rows' starts."""
    n = len(group)
    wide = max(length, int(back.max(initial=0))) + 1
    ahead, behind = np.zeros((n, wide), np.uint8), np.zeros((n, wide), np.uint8)
    for i, (c, k) in enumerate(zip(contexts, back.tolist(), strict=True)):
        x = np.frombuffer(c, np.uint8) + 1  # 0 is past the end; 255 is no byte of UTF-8
        ahead[i, :len(x) - k], behind[i, :k] = x[k:], x[:k][::-1]
    order = np.lexsort((np.ascontiguousarray(ahead).view(f"S{wide}").ravel(), group))
    differ = ahead[order[1:]] != ahead[order[:-1]]
    lcp = np.zeros(n, np.int32)
    if n > 1:
        shared = np.where(differ.any(1), differ.argmax(1), 0)
        same = ~differ.any(1)
        shared[same] = (ahead[order[1:][same]] > 0).sum(1)
        ends = (ahead[order[:-1]] > 0).sum(1)
        lcp[1:] = np.where(group[order[1:]] == group[order[:-1]], np.minimum(shared, ends), 0)
    found_row, found_d = [], []
    d = 0
    while len(order):
        near = np.maximum(lcp, np.append(lcp[1:], 0))
        hit = near >= length
        found_row.append(order[hit])
        found_d.append(np.full(int(hit.sum()), d, np.int64))
        d += 1
        alive = (back[order] >= d) & (near + back[order] - (d - 1) >= length)
        at = np.flatnonzero(alive)
        if len(at) < 2:
            break
        table = _min_table(lcp)
        key = group[order[at]] * 256 + behind[order[at], d - 1]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        new = np.zeros(len(at), np.int32)
        inside = np.flatnonzero(key[1:] == key[:-1])
        new[inside + 1] = 1 + _range_min(table, at[inside] + 1, at[inside + 1])
        order, lcp = order[at], new
    return np.concatenate(found_row), np.concatenate(found_d)


def _spans(x1, x2, p, row, d) -> pa.RecordBatch:
    """Repeated starts as runs (x1, x2, lo, hi)."""
    order = np.lexsort((-d, row))
    row, start = row[order], (p[row] - d)[order]
    cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))) if len(row) else np.zeros(0, np.int64)
    end = np.append(cut[1:], len(row)) - 1 if len(row) else cut
    return pa.RecordBatch.from_arrays([pa.array(x1[row[cut]]), pa.array(x2[row[cut]]), pa.array(start[cut]), pa.array(start[end])], names=["x1", "x2", "lo", "hi"])


def _queue(length: int, rows_at_once: int):
    """Contexts in order of fp, in batches of whole groups, to runs of repeated starts."""
    def one(cols):
        fp, x1, x2, p, back, solo, context = cols
        group = np.cumsum(np.append(0, fp[1:] != fp[:-1]))
        row, d = induce(group, back.astype(np.int64), context, length)
        mine = solo[row]
        return _spans(x1, x2, p, row[mine], d[mine])

    def cat(a, b):
        return [x + y if isinstance(x, list) else np.concatenate([x, y]) for x, y in zip(a, b, strict=True)]

    def run(batches):
        held = None
        for b in batches:
            for part in chunks(b, rows_at_once):
                new = [*(part.column(i).to_numpy(zero_copy_only=False) for i in range(6)), part.column(6).to_pylist()]
                held = new if held is None else cat(held, new)
                if len(held[0]) < rows_at_once:
                    continue
                whole = np.flatnonzero(held[0] != held[0][-1])  # the last group may go on
                if len(whole):
                    cut = int(whole[-1]) + 1
                    yield one([c[:cut] for c in held])
                    held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield one(held)

    return run


def _named_starts(length: int):
    """Contexts to a row for each start: (h1, h2, x1, x2, start, solo)."""
    def run(batches):
        for big in batches:
            for b in chunks(big):
                out = [[] for _ in range(4)]
                names = []
                for x1, x2, p, back, solo, c in zip(*(b.column(i).to_pylist() for i in range(1, 7)), strict=True):
                    for s in range(len(c) - length + 1):
                        names.append(hashlib.blake2b(c[s:s + length], digest_size=16, salt=bytes((back - s,))).digest())
                        for col, v in zip(out, (x1, x2, p - back + s, solo), strict=True):
                            col.append(v)
                if names:
                    h = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.bool_())],
                                                     names=["h1", "h2", "x1", "x2", "lo", "solo"])

    return run


def _same_names(batches):
    """Named starts in order of name to those that a neighbour shares its name with. Holds a batch and one row."""
    held, before = None, None
    for b in batches:
        if not b.num_rows:
            continue
        new = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        rows = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        held = [c[-1:] for c in rows]
        yield _settle_names(rows, before, len(rows[0]) - 1)
        if len(rows[0]) > 1:
            before = (rows[0][-2], rows[1][-2])
    if held is not None:
        yield _settle_names(held, before, len(held[0]))


def _settle_names(rows, before, n) -> pa.RecordBatch:
    same = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
    first = before is not None and len(rows[0]) > 0 and (rows[0][0], rows[1][0]) == before
    hit = (np.append(first, same)[:len(rows[0])] | np.append(same, False)[:len(rows[0])])[:n] & rows[5][:n].astype(bool)
    x1, x2, lo = (rows[i][:n][hit] for i in (2, 3, 4))
    return pa.RecordBatch.from_arrays([pa.array(x1), pa.array(x2), pa.array(lo), pa.array(lo)], names=["x1", "x2", "lo", "hi"])


def _cut(length: int):
    """Texts with copies and runs of repeated starts to what is left of them."""
    def run(batches):
        for big in batches:
            for b in chunks(big):
                out = []
                for x1, x2, text, n, lo, hi in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), *(b.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
                    text = text or b""
                    size = len(text)
                    if n > 1 and size >= length:
                        spans = [(0, size)]
                    else:
                        spans = []
                        for s, e in sorted(zip(lo or [], hi or [], strict=True)):
                            if spans and s <= spans[-1][1]:
                                spans[-1] = (spans[-1][0], max(spans[-1][1], e + length))
                            else:
                                spans.append((s, e + length))
                    kept, at = hashlib.sha256(), 0
                    view = memoryview(text)
                    for s, e in spans:
                        kept.update(view[at:s])
                        at = e
                    kept.update(view[at:])
                    out.append((x1, x2, size, sum(e - s for s, e in spans), len(spans), kept.hexdigest(), [s for s, _ in spans], [e for _, e in spans]))
                if out:
                    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["x1", "x2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, local_hot: int = LOCAL_HOT,
                   queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """A row for each document: its id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ranges (starts, ends)."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), body.alias("text")).withColumn("x1", F.xxhash64("text")).withColumn("x2", F.xxhash64(F.lit("second"), "text"))
    # Map-side: copies in a task are one row before anything is dealt out. All three reads of the texts below take the same columns, so one exchange serves them.
    texts = keyed.groupBy("x1", "x2").agg(F.first("text").alias("text"), F.count("*").alias("n"))

    tuples = texts.select("x1", "x2", "text", "n").mapInArrow(_anchor_rows(length, gram, local_hot), "route long, fp long, k1 long, k2 long, x1 long, x2 long, at long, flag byte")
    swept = tuples.repartition("route").sortWithinPartitions("route", "fp", "k1", "k2").mapInArrow(_sweep, "fp long, x1 long, x2 long, at long, sure boolean, ask boolean")

    large = swept.where("ask").groupBy("fp").count().where(F.col("count") > hot).select("fp", F.lit(True).alias("hot"))
    asked = (swept.where("ask").join(large, "fp", "left").groupBy("x1", "x2")
             .agg(F.collect_list(F.struct("fp", "at", "sure", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked")))
    contexts = (texts.join(asked, ["x1", "x2"]).select("x1", "x2", "text", "asked", "n")
                .mapInArrow(_contexts(length), "fp long, x1 long, x2 long, p long, back int, solo boolean, context binary, hot boolean"))
    induced = contexts.where("not hot").repartition("fp").sortWithinPartitions("fp").mapInArrow(_queue(length, queue_rows), "x1 long, x2 long, lo long, hi long")
    named = contexts.where("hot").mapInArrow(_named_starts(length), "h1 long, h2 long, x1 long, x2 long, lo long, solo boolean")
    by_name = named.repartition("h1", "h2").sortWithinPartitions("h1", "h2").mapInArrow(_same_names, "x1 long, x2 long, lo long, hi long")

    p, back, ahead = F.shiftright("at", 16), F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(255))
    sure = swept.where("sure").select("x1", "x2", (p - back).alias("lo"), (p - ahead).alias("hi"))
    runs = sure.union(induced).union(by_name).groupBy("x1", "x2").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    made = texts.join(runs, ["x1", "x2"], "left").select("x1", "x2", "text", "n", "lo", "hi").mapInArrow(_cut(length), T.StructType([
        T.StructField("x1", T.LongType()), T.StructField("x2", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))]))
    made = written(made, "cut")
    return keyed.select(id_col, "x1", "x2").join(made, ["x1", "x2"]).drop("x1", "x2")
