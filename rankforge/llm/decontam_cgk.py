"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Texts are lower-cased and runs of white space become one space. The CGK random
walk reads a string step by step: step j copies the character under the
pointer and moves on by R_j(character), 0 or 1 at random, so strings a few edits
apart get embeddings with small Hamming distance. One LSH table keeps the
characters of a few sampled steps as its key, and tables are repeated (``BEGINNINGS`` x ``TABLES``)
for a recall of 0.9 or more at any share of edited characters up to the 0.2 limit; a test measures it against
brute force by item length, and the README gives the figures. Tables of one beginning share
the first steps of their walk and the characters sampled there; from there on each walks for itself.

An item of L bytes gives windows of ``window_size(L)`` bytes (a power of two,
from a third to three quarters of the item) at each of its words; every
document word starts one window of every size in use, and so does every ``step``-th
byte from there to the next word, so that unspaced text has windows as well. The step is
no longer than the stretch in which an item's windows can start. Where an item's next word is
far, it gives windows at every byte up to it, as a document may count from elsewhere: an exact
copy is found wherever it stands. All windows of
all documents walk through the early sampled steps; only those whose key so far
is a key of some item window walk on. Hits give (item, place) candidates, which a
bit-parallel edit distance between the whole item and the best stretch of text
there decides: an item is in a document at a distance of at most
``MAX_DISTANCE`` times the item's length (0.2: a similarity of 0.8 or more). Places where not even the item's
first words (``HEAD``) are within the item's edits are left out before; none that the distance would accept is among them.

Items under ``LEAST_ITEM`` bytes are too short for windows that survive their edits. They are cut into one piece more than
they may have edits, so that one piece is left as it was in any copy; every place of every piece is a candidate for the
same edit distance, and none is lost. Items that allow no edit or hold pieces under three bytes (``LEAST_PIECES``) are looked for as exact
copies of whole words: one lookup of a rolling hash at every place for each length. Scripts without
spaces need no word's end there.

Items are taken in blocks of about ``BLOCK_BYTES``, each broadcast on its own as sorted keys,
so the broadcast and what the driver holds are bounded whatever the size of the benchmark.

Nulls and edges: null or empty documents hold nothing; null or blank items are not
looked for. Repeated items are reported under each of their ids; repeated
documents each get their rows. Null ids are passed through. Of several places with the least distance the
first counts. Very long texts are looked at in pieces that overlap by more than an item. Empty tables give empty tables,
an empty benchmark no leaks. Other columns pass untouched, whatever their names; only one that is named as the result is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import chunks, share

MAX_DISTANCE = 0.2
BEGINNINGS, TABLES = 8, 4
EARLY, EARLY_STEPS = 10, 20
#: Late steps by window size, and of larger windows.
LATE = {8: 1, 16: 1, 32: 1}
LATE_STEPS = 3
LEAST_ITEM = 64
LEAST_PIECES = 10
#: About as many bytes of items are looked for at once; their index has some 160 times as many.
BLOCK_BYTES = 1 << 18
#: Pairs whose edit distances are computed side by side.
PAIRS = 1 << 12
#: An item's head, in bytes for each edit that the item may have, and then up to the next 64.
HEAD = 1.9
#: Fewer pairs than this for each 64 bytes of item are computed one by one.
FEW = 16
#: Windows start this many bytes apart at most.
STEP = 12
#: Sampled early steps after which windows that begin like no item's are left out.
CHECKS = (5, EARLY)
#: Bytes of text looked at together.
PIECE = 1 << 23
#: Windows that walk together: their state stays in a core's cache.
AT_ONCE = 1 << 15
_BITS, _LATE_BITS = 20, 16

LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
                                  T.StructField("similarity", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "replace").split())


def window_size(length: int) -> int:
    return 1 << max(3, int(0.75 * length).bit_length() - 1)


@dataclass
class Walk:
    """One LSH table: the walk's moves and the steps that are sampled."""
    moves: list[bytes]  # by step, the move of each of the 256 bytes
    early: list[int]
    late: dict[int, list[int]]  # by window size
    beginning: int

    def samples(self, size: int) -> tuple[list[int], list[int]]:
        """The sampled steps, and those after which windows may be left out."""
        return self.early + self.late[size], [self.early[n - 1] for n in CHECKS] + self.late[size]


def late_steps(size: int, rng: np.random.Generator) -> list[int]:
    """One step out of each of some stretches of the rest of the walk, the first ones short: most windows end there. Short windows, which few edits leave whole, have fewer."""
    edge = EARLY_STEPS + np.round((2 * size - EARLY_STEPS) * np.linspace(0, 1, LATE.get(size, LATE_STEPS) + 1) ** 2.5).astype(int)
    return sorted({int(rng.integers(a, b)) for a, b in zip(edge[:-1], edge[1:], strict=True) if b > a and a < 2 * size})


def walks(sizes: list[int], beginnings: int = BEGINNINGS, tables: int = TABLES, seed: int = 11) -> list[Walk]:
    rng = np.random.default_rng(seed)
    steps = 2 * max(sizes, default=8)
    out = []
    for n in range(beginnings):
        first = rng.integers(0, 2, (EARLY_STEPS, 256), np.uint8)
        early = sorted(rng.choice(EARLY_STEPS, EARLY, replace=False).tolist())
        for _ in range(tables):
            moves = rng.integers(0, 2, (steps, 256), np.uint8)
            moves[:EARLY_STEPS] = first[:steps]
            out.append(Walk([m.tobytes() for m in moves], early, {w: late_steps(w, rng) for w in sizes}, n))
    return out


@dataclass
class State:
    """Windows on their way: which ones, where they are, their keys so far."""
    rows: np.ndarray
    pos: np.ndarray
    key: np.ndarray

    def only(self, on: np.ndarray) -> State:
        return State(self.rows.take(on), self.pos.take(on), self.key.take(on))


def begin(start: np.ndarray) -> State:
    return State(np.arange(len(start)), start.astype(np.intp), np.full(len(start), 17, np.uint32))


_ODD32 = np.uint32(0x9E3779B1)


def walk_on(buf: np.ndarray, at: State, walk: Walk, size: int, first: int, last: int, kept=None, start: np.ndarray | None = None) -> State:
    """The windows after the checkpoints first .. last - 1; kept(checkpoint, key) says which of them walk on.

    buf ends with at least 2 * size zero bytes. start: of all windows; with it, a walk past a window's end reads zeros.
    """
    sampled, stops = walk.samples(size)
    j = stops[first - 1] + 1 if first else 0
    for n in range(first, last):
        end = None if start is None or stops[n] < size else start[at.rows] + size
        pos, key = at.pos.copy(), at.key.copy()
        while j <= stops[n]:
            c = buf.take(pos, mode="clip")
            if end is not None and j >= size:  # after j steps a walk is j bytes on at most
                c *= pos < end
            if j in sampled:
                key ^= c
                key *= _ODD32
            pos += np.frombuffer(c.tobytes().translate(walk.moves[j]), np.uint8).astype(np.intp)
            j += 1
        at = State(at.rows, pos, key)
        if kept is not None:
            at = at.only(kept(n, key))
    return at


# ASCII characters that are neither letter nor digit.
_SEPARATES = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def word_starts(buf: np.ndarray) -> np.ndarray:
    """Starts of words: after a space or a zero byte, and not one of them; or after a mark like a bracket, and not one."""
    gap, mark = buf <= 32, _SEPARATES[buf]
    return np.flatnonzero((~gap & np.append(True, gap[:-1])) | (~mark & np.append(True, mark[:-1])))


def window_starts(buf: np.ndarray, step: int) -> np.ndarray:
    """Starts of words, and every step-th byte from there to the next one that is not zero."""
    words = word_starts(buf)
    n = -(-np.diff(np.append(words, len(buf))) // step)
    at = np.repeat(words - step * (np.cumsum(n) - n), n) + step * np.arange(n.sum())
    return at[buf[at] != 0]


def item_starts(text: bytes, size: int, step: int) -> np.ndarray:
    """Where a document's windows may start in a copy of the item, whatever stands before it."""
    buf, last = np.frombuffer(text, np.uint8), len(text) - size
    words = word_starts(buf)
    second = int(words[words > 0].min(initial=len(text)))
    at = window_starts(buf, step)
    if second > min(last, 2 * step):
        at = np.union1d(at, np.arange(min(second, last + 1)))
    return at[at <= last]


def _has(keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of ``key`` are among the sorted keys."""
    if not len(keys):
        return np.zeros(len(key), bool)
    return keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key


def _flags(keys: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, bool)
    out[keys >> np.uint32(32 - bits)] = True
    return out


def _flagged(flags: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """The places of keys whose upper bits have a flag."""
    return np.flatnonzero(flags.take((key >> np.uint32(32 - bits)).astype(np.intp), mode="clip"))


@dataclass
class Hits:
    """Sorted keys, and who has them: (item, start) of equal keys lie together."""
    key: np.ndarray
    item: np.ndarray
    start: np.ndarray

    def of(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``key``, item, start) for each of them that has the key."""
        low, high = np.searchsorted(self.key, key), np.searchsorted(self.key, key, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(np.arange(len(key)), n), self.item[at], self.start[at]


def _hits(key: np.ndarray, item: np.ndarray, start: np.ndarray) -> Hits:
    order = np.lexsort((start, item, key))
    return Hits(key[order], item[order].astype(np.int32), start[order].astype(np.int32))


@dataclass
class Items:
    ids: list
    texts: list[bytes]
    sizes: list[int]
    walks: list[Walk]
    #: by beginning and early checkpoint, and at the last of these by size: sorted keys
    early: dict[tuple[int, int], np.ndarray]
    begun: dict[tuple[int, int], np.ndarray]
    #: by table and size: sorted keys at each late checkpoint but the last; then who has the full ones
    seen: dict[tuple[int, int], list[np.ndarray]]
    at: dict[tuple[int, int], Hits]
    max_distance: float
    step: int
    #: by length of a piece: where it is in the items under LEAST_ITEM
    pieces: dict[int, Hits]
    #: by length, items found as exact copies: sorted hashes, and the items that have them
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    def marks(self) -> dict[tuple, np.ndarray]:
        """Flags by the upper bits of keys, made where they are used: by beginning and early checkpoint, by table, size and late one."""
        if not hasattr(self, "_marks"):
            self._marks = {at: _flags(keys, _BITS) for at, keys in self.early.items()}
            self._marks |= {(t, w, n): _flags(keys, _LATE_BITS) for (t, w), maps in self.seen.items() for n, keys in enumerate([*maps, self.at[t, w].key])}
        return self._marks

    def __getstate__(self):
        """Walks are drawn again from their seed, which is shorter than they are."""
        drawn = (1 + max((w.beginning for w in self.walks), default=-1), len(self.walks))
        return {k: v for k, v in self.__dict__.items() if k != "_marks"} | {"walks": drawn}

    def __setstate__(self, state):
        self.__dict__ |= state
        beginnings, tables = state["walks"]
        self.walks = walks(self.sizes, beginnings, tables // max(1, beginnings))


_ODD = 0x9E3779B97F4A7C15


def rolling(buf: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on that has as many: sums of byte * odd ** place in 64 bits."""
    key = np.zeros(max(0, len(buf) - length + 1), np.uint64)
    for j in range(length):
        key = key * np.uint64(_ODD) + buf[j:j + len(key)]
    return key ^ (key >> np.uint64(29))


def cut(length: int, edits: int) -> list[tuple[int, int]]:
    """(from, to) of edits + 1 pieces."""
    edge = [length * i // (edits + 1) for i in range(edits + 2)]
    return list(zip(edge[:-1], edge[1:], strict=True))


def item_pieces(texts: list[bytes], max_distance: float) -> tuple[dict[int, Hits], set[int]]:
    """Where the pieces of short items are, by their length; and the items that have some."""
    found, has = defaultdict(list), set()
    for i, t in enumerate(texts):
        edits = int(max_distance * len(t))
        if LEAST_PIECES <= len(t) < LEAST_ITEM and edits and len(t) >= 3 * (edits + 1):
            has.add(i)
            for a, b in cut(len(t), edits):
                found[b - a].append((rolling(np.frombuffer(t[a:b], np.uint8), b - a)[0], i, a))
    return {n: _hits(*(np.array(x) for x in zip(*rows, strict=True))) for n, rows in sorted(found.items())}, has


def short_items(texts: list[bytes], others: set[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    out = {}
    short = [i for i, t in enumerate(texts) if len(t) < LEAST_ITEM and i not in others]
    for n in sorted({len(texts[i]) for i in short}):
        of = np.array([i for i in short if len(texts[i]) == n])
        key = np.concatenate([rolling(np.frombuffer(texts[i], np.uint8), n) for i in of])
        order = np.argsort(key, kind="stable")
        out[n] = key[order], of[order]
    return out


def _unspaced(c: str) -> bool:
    """Thai, Lao, Burmese, Khmer, and the scripts of East Asia."""
    return "\u0e00" <= c < "\u0f00" or "\u1000" <= c < "\u10a0" or "\u1780" <= c < "\u1800" or c >= "\u2e80"


def whole_words(index: Items, norm: list[bytes], best: list[dict]) -> None:
    """Exact copies of short items that neither begin nor end inside a word; the first place of each."""
    for group in _groups([(i, 0, t) for i, t in enumerate(norm)] if index.short else []):
        base = np.cumsum([0] + [len(t) + 1 for _, _, t in group])
        text = b"".join(t + b"\0" for _, _, t in group)
        buf = np.frombuffer(text, np.uint8)
        mark = _SEPARATES[buf]
        for n, (keys, of) in index.short.items():
            for at in range(0, len(buf), PIECE):
                key = rolling(buf[at:at + PIECE + n - 1], n)
                low = np.searchsorted(keys, key)
                hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == key)
                for p, a, b in zip((hit + at).tolist(), low[hit].tolist(), np.searchsorted(keys, key[hit], "right").tolist(), strict=True):
                    item = text[p:p + n]
                    i = next((i for i in of[a:b].tolist() if index.texts[i] == item), None)
                    g = int(np.searchsorted(base, p, "right")) - 1
                    found = best[group[g][0]] if g < len(group) else {}
                    if i is None or i in found or p + n >= base[g + 1]:
                        continue
                    chars = item.decode("utf-8", "replace")
                    if (mark[p - 1] or mark[p] or _unspaced(chars[0])) and (mark[p + n - 1] or mark[p + n] or _unspaced(chars[-1])):
                        found[i] = 0, p + n - int(base[g])


def index_items(items: list[tuple], max_distance: float = MAX_DISTANCE, tables: int = TABLES, beginnings: int = BEGINNINGS) -> Items:
    """items: (id, text); ids of equal texts are kept together."""
    by_text = defaultdict(list)
    for i, t in items:
        if n := normal(t):
            by_text[n].append(i)
    texts = sorted(by_text)
    pieces, cut_up = item_pieces(texts, max_distance)
    long = [i for i, t in enumerate(texts) if len(t) >= LEAST_ITEM]
    sizes = sorted({window_size(len(texts[i])) for i in long})
    ws = walks(sizes, beginnings, tables)
    step = min([STEP] + [len(texts[i]) - window_size(len(texts[i])) + 1 for i in long])
    seen, at, begun, early = {}, {}, {}, defaultdict(list)
    pad = 2 * max(sizes, default=8) + 8
    for w in sizes:
        of = np.array([i for i in long if window_size(len(texts[i])) == w])
        buf = np.frombuffer(b"".join(texts[i] + b"\0" * pad for i in of), np.uint8)
        base = np.cumsum([0] + [len(texts[i]) + pad for i in of])
        places = [item_starts(texts[i], w, step) for i in of]
        who = np.repeat(np.arange(len(of)), [len(x) for x in places])
        inside = np.concatenate(places)
        start = base[who] + inside
        for t, walk in enumerate(ws):
            if (walk.beginning, w) not in begun:  # its first table
                early_on = begin(start)
                for n in range(len(CHECKS)):
                    early_on = walk_on(buf, early_on, walk, w, n, n + 1)
                    early[walk.beginning, n].append(early_on.key)
                begun[walk.beginning, w] = np.unique(early_on.key)
            keys, state = [], early_on
            for n in range(len(CHECKS), len(CHECKS) + len(walk.late[w])):
                state = walk_on(buf, state, walk, w, n, n + 1, start=start)
                keys.append(state.key)
            seen[t, w] = [np.unique(k) for k in keys[:-1]]
            at[t, w] = _hits(keys[-1], of[who], inside)
    early = {n: np.unique(np.concatenate(k)) for n, k in early.items()}
    return Items([by_text[t] for t in texts], texts, sizes, ws, early, begun, seen, at, max_distance, step, pieces, short_items(texts, cut_up))


def candidates(index: Items, buf: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, where the item would begin, hit) for the hits of all LSH tables and pieces."""
    out = set()
    every = window_starts(buf, index.step) if index.sizes else np.zeros(0, np.int64)
    marks, first = index.marks(), len(CHECKS)
    for number in sorted({walk.beginning for walk in index.walks}) if len(every) else ():
        tables = [t for t, walk in enumerate(index.walks) if walk.beginning == number]
        parts = []
        for at in range(0, len(every), AT_ONCE):
            part = walk_on(buf, begin(every[at:at + AT_ONCE]), index.walks[tables[0]], index.sizes[0], 0, first,
                           lambda n, key: _flagged(marks[number, n], key, _BITS))
            parts.append((part.rows + at, part.pos, part.key))
        begun = State(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        keys = index.early[number, first - 1]
        key_at = np.minimum(np.searchsorted(keys, begun.key), len(keys) - 1)
        for w in index.sizes:
            on = begun.only(np.flatnonzero(_has(index.begun[number, w], keys)[key_at] & (keys[key_at] == begun.key)))
            if not len(on.rows):
                continue
            for t in tables:
                maps = index.seen[t, w]

                def kept(n, key, t=t, w=w, maps=maps):
                    on = _flagged(marks[t, w, n - first], key, _LATE_BITS)
                    return on[_has(maps[n - first], key[on])] if n - first < len(maps) else on

                end = walk_on(buf, on, index.walks[t], w, first, first + len(maps) + 1, kept, every)
                place, item, inside = index.at[t, w].of(end.key)
                p = every[end.rows[place]]
                out.update(zip(item.tolist(), (p - inside).tolist(), p.tolist(), strict=True))
    for n, hits in index.pieces.items():
        for at in range(0, len(buf), AT_ONCE << 4):
            key = rolling(buf[at:at + (AT_ONCE << 4) + n - 1], n)
            on = np.flatnonzero(_has(hits.key, key))
            place, item, inside = hits.of(key[on])
            p = on[place] + at
            out.update(zip(item.tolist(), (p - inside).tolist(), p.tolist(), strict=True))
    return sorted(out)


def best_stretches(items: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each item to any stretch of its text, and that stretch's first end; pairs side by side in 64-bit words."""
    best, end = np.array([len(i) for i in items], np.int64), np.zeros(len(items), np.int64)
    words = -(-best // 64)
    for w in np.unique(words):
        of = np.flatnonzero(words == w)
        if len(of) < FEW * w:
            for i in of:
                best[i], end[i] = _distance(items[i], texts[i])
            continue
        kinds = sorted({items[i] for i in of})
        number = {k: n for n, k in enumerate(kinds)}
        eq, column = np.zeros((w, 256, len(kinds)), np.uint64), np.arange(len(kinds))
        for at, c in enumerate(np.frombuffer(b"".join(k.ljust(64 * w, b"\0") for k in kinds), np.uint8).reshape(len(kinds), -1).T):
            eq[at >> 6, c, column] |= np.uint64(1) << np.uint64(at & 63)
        eq[:, 0] = 0
        flat = eq.reshape(w, -1)
        of = of[np.argsort([-len(texts[i]) for i in of], kind="stable")]
        for at in range(0, len(of), PAIRS):
            part = of[at:at + PAIRS]
            best[part], end[part] = _distances(flat, len(kinds), np.array([number[items[i]] for i in part]), best[part], [texts[i] for i in part])
    return best, end


def may_hold(items: list[bytes], texts: list[bytes], most: list[int]) -> np.ndarray:
    """Which texts may hold their items with at most so many edits; none that does is left out.

    An item's head is there at no more edits than the item, and ahead of as many bytes as the rest of the item takes at least.
    Of unlike texts more than half the bytes differ, so the head has more edits than the item may have.
    """
    head = [64 * max(1, -int(-HEAD * m // 64)) for m in most]
    cut = np.flatnonzero([h < len(i) for h, i in zip(head, items, strict=True)])
    least, _ = best_stretches([items[n][:head[n]] for n in cut], [texts[n][:max(0, len(texts[n]) - len(items[n]) + head[n] + most[n])] for n in cut])
    out = np.ones(len(items), bool)
    out[cut] = least <= np.array(most, np.int64)[cut]
    return out


def _distance(item: bytes, text: bytes) -> tuple[int, int]:
    """As ``_distances``, one pair in one long word."""
    eq: dict[int, int] = {}
    for at, c in enumerate(item):
        eq[c] = eq.get(c, 0) | 1 << at
    eq.pop(0, None)
    top, every = 1 << (len(item) - 1), (1 << len(item)) - 1
    up, down, d, low, end = every, 0, len(item), len(item), 0
    for j, c in enumerate(text):
        e = eq.get(c, 0)
        v, h = e | down, ((e & up) + up ^ up) | e
        plus, minus = down | every & ~(h | up), up & h
        if plus & top:
            d += 1
        elif minus & top:
            d -= 1
            if d < low:
                low, end = d, j + 1
        plus <<= 1
        up, down = (minus << 1 | ~(v | plus)) & every, plus & v & every
    return low, end


def _distances(eq: np.ndarray, kinds: int, which: np.ndarray, length: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """eq: by word, the places of each character in each item. texts: longest first."""
    w, one, top = len(eq), np.uint64(1), np.uint64(63)
    size = np.array([len(t) for t in texts])
    longest = int(size.max(initial=0))
    chars = np.ascontiguousarray(np.frombuffer(b"".join(t.ljust(longest, b"\0") for t in texts), np.uint8).reshape(len(texts), longest).T)
    last = ((length - 1) & 63).astype(np.uint64)
    up, down = [np.full(len(which), ~np.uint64(0)) for _ in range(w)], [np.zeros(len(which), np.uint64) for _ in range(w)]
    d, low, end = length.copy(), length.copy(), np.zeros(len(which), np.int64)
    for j in range(longest):
        n = int(np.searchsorted(-size, -j, side="left"))  # the pairs whose text goes on
        at = chars[j, :n].astype(np.intp)  # of the pair's character in eq
        at *= kinds
        at += which[:n]
        rise = fall = more = less = None
        for b in range(w):
            p, m, e = up[b][:n], down[b][:n], eq[b].take(at)
            v = e | m
            if fall is not None:
                e |= fall
            h = e & p
            h += p
            h ^= p
            h |= e
            plus, minus = h | p, p & h
            np.invert(plus, out=plus)
            plus |= m
            if b < w - 1:
                more, less = plus >> top, minus >> top
            else:
                d[:n] += ((plus >> last[:n]) & one).view(np.int64)
                d[:n] -= ((minus >> last[:n]) & one).view(np.int64)
            plus <<= one
            minus <<= one
            if rise is not None:
                plus |= rise
                minus |= fall
            rise, fall = more, less
            np.bitwise_and(plus, v, out=m)
            v |= plus
            np.invert(v, out=v)
            np.bitwise_or(minus, v, out=p)
        better = d[:n] < low[:n]
        if better.any():
            better = np.flatnonzero(better)
            low[better], end[better] = d[better], j + 1
    return low, end


def _pieces(norm: list[bytes], overlap: int) -> list[tuple[int, int, bytes]]:
    """(text, offset, bytes): a very long text in pieces that overlap by more than an item with its edits."""
    return [(n, at, t[at:at + PIECE + overlap]) for n, t in enumerate(norm) for at in range(0, max(len(t) - overlap, 1), PIECE)]


def _groups(pieces: list) -> list[list]:
    out, size = [[]], 0
    for p in pieces:
        if size > PIECE:
            out.append([])
            size = 0
        out[-1].append(p)
        size += len(p[2])
    return out


def leaks(index: Items, texts: list) -> list[list[dict]]:
    """For each text, every item that is in it: its best distance and that place, in bytes of the normal text. Equal texts are looked at once."""
    number: dict[bytes, int] = {}
    of_text = [number.setdefault(n, len(number)) for n in map(normal, texts)]
    norm = list(number)
    best: list[dict] = [{} for _ in norm]
    whole_words(index, norm, best)
    if index.sizes or index.pieces:
        longest = max(map(len, index.texts))
        for group in _groups(_pieces(norm, 2 * longest)):
            _look(index, group, best)
    out = []
    for of in best:
        rows = []
        for i, (d, end) in of.items():
            n = len(index.texts[i])
            rows += [{"item_id": x, "distance": d, "similarity": 1 - d / n, "start": max(0, end - n), "end": end} for x in index.ids[i]]
        out.append(sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"])))
    return [out[n] for n in of_text]


def _look(index: Items, group: list, best: list[dict]) -> None:
    """Candidates of some pieces, each place decided once; what is found goes to ``best``."""
    pad = 2 * max(index.sizes, default=LEAST_ITEM) + EARLY_STEPS + 8
    base = np.cumsum([0] + [len(t) + pad for _, _, t in group])
    buf = np.frombuffer(b"".join(t + b"\0" * pad for _, _, t in group), np.uint8)
    looked: dict[tuple[int, int], int] = {}
    work = []
    found = candidates(index, buf)
    place = [(int(g), i, p - int(base[g])) for (i, p, _), g in zip(found, np.searchsorted(base, [h for _, _, h in found], side="right") - 1, strict=True)]
    for g, i, p in place:  # by item, then by place
        size = len(index.texts[i])
        most = int(index.max_distance * size)
        if p <= looked.get((g, i), -1 << 60):  # the stretch before covers this place
            continue
        looked[g, i] = p + most // 4
        left = max(0, p - most)
        work.append((i, g, left, group[g][2][left:max(left, p + size + most + most // 4)]))
    if not work:
        return
    on = may_hold([index.texts[i] for i, *_ in work], [w[3] for w in work], [int(index.max_distance * len(index.texts[i])) for i, *_ in work])
    work = [w for w, x in zip(work, on.tolist(), strict=True) if x]
    distance, end = best_stretches([index.texts[i] for i, *_ in work], [w[3] for w in work])
    for (i, g, left, _), d, e in zip(work, distance.tolist(), end.tolist(), strict=True):
        n, at, _ = group[g]
        new = (d, at + left + e)
        if d <= int(index.max_distance * len(index.texts[i])) and (i not in best[n] or new < best[n][i]):
            best[n][i] = new


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "leaks", max_distance: float = MAX_DISTANCE,
               tables: int = TABLES, beginnings: int = BEGINNINGS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` plus ``out_col``: the items (item_id, text) that each text holds. One pass for each block of items, no shuffle."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    last, at = len(docs.columns), docs.columns.index(text_col)
    out = docs.toDF(*(f"c{i}" for i in range(last))).withColumn("found", F.array().cast(LEAKS))
    for b in range(blocks):
        rows = items.where(block_of == b).collect()  # about block_bytes
        held = share(docs.sparkSession, index_items([(r["item_id"], r["text"]) for r in rows], max_distance, tables, beginnings))
        del rows

        def run(batches, held=held):
            for big in batches:
                for part in chunks(big, 8192):
                    found = leaks(held(), part.column(at).to_pylist())
                    had = part.column(last)
                    if blocks > 1:
                        found = [sorted(x + y, key=lambda r: (r["item_id"] is None, r["item_id"])) for x, y in zip(had.to_pylist(), found, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(last)), pa.array(found, had.type)], names=part.schema.names)

        out = out.mapInArrow(run, out.schema)
    kept = [i for i, c in enumerate(docs.columns) if c != out_col]
    return out.select(*(F.col(f"c{i}").alias(docs.columns[i]) for i in kept), F.col("found").alias(out_col))
