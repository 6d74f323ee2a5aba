import random

import numpy as np
from pyspark.sql import functions as F

from rankforge.llm import decontam_cgk as g
from tests.llm.helpers import awkward, docs, prose


def edit(rnd, s, rate):
    s = list(s)
    for _ in range(int(rate * len(s))):
        p = rnd.randrange(len(s))
        kind = rnd.random()
        if kind < .34:
            s[p] = rnd.choice("abcdefgh ")
        elif kind < .67:
            del s[p]
        else:
            s.insert(p, rnd.choice("abcdefgh "))
    return "".join(s)


def distance(item, text):
    """Least edit distance of the item to any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (a != b)))
        row = new
    return min(row)


def test_bit_parallel_distances():
    rnd = random.Random(1)
    items, texts = [], []
    for _ in range(60):
        item = prose(rnd, rnd.randint(2, 40))
        items.append(item.encode())
        texts.append((prose(rnd, 3) + edit(rnd, item, rnd.random() * .3) + prose(rnd, 3)).encode() if rnd.random() < .9 else b"")
    got, _ = g.best_stretches(items, texts)
    assert got.tolist() == [distance(i, t) for i, t in zip(items, texts)]


def test_recall_against_brute_force():
    """At up to a tenth of the characters edited, nine of ten of the pairs that brute force accepts are found, and nothing else."""
    rnd = random.Random(2)
    items = [(i, prose(rnd, rnd.randint(15, 45))) for i in range(40)]
    index = g.index_items(items)
    texts, want = [], set()
    for n in range(160):
        i, item = rnd.choice(items)
        mid = edit(rnd, item, rnd.choice([0, .03, .06, .1]))
        texts.append(prose(rnd, 30) + " " + mid + " " + prose(rnd, 30))
        if distance(g.normal(item), g.normal(mid)) <= g.MAX_DISTANCE * len(g.normal(item)):
            want.add((n, i))
    found = {(n, r["item_id"]) for n, rows in enumerate(g.leaks(index, texts)) for r in rows}
    assert len(found & want) / len(want) >= .9
    by = dict(items)
    for n, i in found - want:  # a stretch of the surroundings may help: still within the distance
        item = g.normal(by[i])
        assert distance(item, g.normal(texts[n])) <= g.MAX_DISTANCE * len(item)
    assert not any(g.leaks(index, [prose(rnd, 400) for _ in range(20)]))


def test_exact_copies_in_very_long_texts_and_blocks(spark):
    rnd = random.Random(3)
    items = [(i, prose(rnd, rnd.randint(12, 60))) for i in range(30)] + [(90, None), (91, " "), (92, "too short"), (None, prose(rnd, 20))]
    items += [(93, items[0][1].upper())]  # the same item but for case
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("leaks", F.lit(1))
    long = prose(rnd, 40_000)
    rows = awkward() + [(200 + i, f"{long[:rnd.randrange(len(long))]}\n {t}  {prose(rnd, 5)}") for i, t in items[:30]] + [(300, items[33][1])]
    df = docs(spark, rows).drop("leaks")
    for block in (1 << 21, 1 << 10):
        out = g.with_leaks(df, bench, block_bytes=block)
        assert out.columns == [*df.columns, "leaks"] and out.count() == len(rows)
        got = {(r.doc_id, x.item_id, x.distance) for r in out.collect() for x in r.leaks}
        assert {(200 + i, i, 0) for i, _ in items[:30]} | {(200, 93, 0), (300, None, 0)} <= got
        assert all(d in range(200, 301) for d, _, _ in got)
    assert g.with_leaks(df.limit(0), bench).collect() == []
    assert all(r.leaks == [] for r in g.with_leaks(df, bench.limit(0)).collect())


def test_walks_are_the_same_wherever_a_window_is():
    text = g.normal("some words that make a window of text " * 4)
    walk = g.walks([64], 1, 1)[0]
    buf = np.frombuffer(b"xx " + text + b" " + text + b"\0" * 300, np.uint8)
    start = np.array([3, 4 + len(text)])
    early = g.walk_on(buf, g.begin(start), walk, 64, 0, len(g.CHECKS))
    late = g.walk_on(buf, early, walk, 64, len(g.CHECKS), len(g.CHECKS) + len(walk.late[64]), start=start)
    assert early.key[0] == early.key[1] and late.key[0] == late.key[1] != early.key[0]


def test_recall_up_to_the_limit():
    """At every share of edited characters up to MAX_DISTANCE, nine of ten of the pairs that brute force accepts are found."""
    rnd = random.Random(7)
    items = [(i, prose(rnd, rnd.randint(15, 45))) for i in range(200)]
    index = g.index_items(items)
    for rate in (0, .05, .1, .15, .18, .2):
        texts, want = [], set()
        for n, (i, item) in enumerate(items):
            mid = edit(rnd, item, rate)
            texts.append(prose(rnd, 30) + " " + mid + " " + prose(rnd, 30))
            if distance(g.normal(item), g.normal(mid)) <= int(g.MAX_DISTANCE * len(g.normal(item))):
                want.add((n, i))
        found = {(n, r["item_id"]) for n, rows in enumerate(g.leaks(index, texts)) for r in rows}
        assert len(found & want) / len(want) >= .9, rate


def test_exact_copies_without_spaces_around():
    """Unspaced items in unspaced text, and items whose first word is long behind a bracket or a quote mark."""
    rnd = random.Random(8)
    han = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(n))
    items = [(i, han(rnd.randint(8, 120))) for i in range(60)]
    items += [(100 + i, "".join(rnd.choices("abcdefgh0123456789", k=rnd.randint(24, 200)))) for i in range(60)]
    items += [(200 + i, "".join(rnd.choices("abcdefgh", k=30)) + " " + prose(rnd, rnd.randint(1, 6))) for i in range(60)]
    around = [lambda t: han(rnd.randint(1, 300)) + t + han(50), lambda t: "x" * rnd.randint(1, 40) + t + "yz", lambda t: prose(rnd, 20) + " (" + t + ")", lambda t: prose(rnd, 20) + '"' + t + '".']
    index = g.index_items(items)
    for put in around:
        for (i, _), rows in zip(items, g.leaks(index, [put(t) for _, t in items]), strict=True):
            assert (i, 0) in {(r["item_id"], r["distance"]) for r in rows}


def test_short_items_as_whole_words():
    items = [(1, "Blue eel"), (2, "42"), (3, "yes"), (4, "\u4eca\u5929\u5929\u6c14"), (5, "is 7 x 8?"), (6, "blue  EEL"), (7, "a" * 9), (8, "no\0pe")]
    texts = ["The blue\nEEL, of course", "eyes and 1420", "(yes) 42", "\u6211\u8bf4\u4eca\u5929\u5929\u6c14\u5f88\u597d", "Q: Is 7 x 8? 56", "blue eels", "a" * 10, "x " + "a" * 9, "no", "pe", "", None]
    want = [{1, 6}, set(), {2, 3}, {4}, {5}, set(), set(), {7}, set(), set(), set(), set()]
    for more in ([], [(90, prose(random.Random(1), 30))]):  # alone, and with an item that has windows
        got = g.leaks(g.index_items(items + more), texts)
        assert [{r["item_id"] for r in rows} for rows in got] == want
        assert all(r["distance"] == 0 for rows in got for r in rows)
    assert [(r["start"], r["end"]) for r in g.leaks(g.index_items(items), ["well, yes; yes"])[0]] == [(6, 9)]


def recall(rnd, make, rate, n=150):
    """Of the pairs that brute force accepts, among copies with exactly so many edits, the share that is found."""
    items = [(i, make()) for i in range(n)]
    index = g.index_items(items)
    texts, want = [], set()
    for k, (i, item) in enumerate(items):
        mid = edit(rnd, item, rate)
        texts.append(prose(rnd, 12) + " " + mid + " " + prose(rnd, 12))
        if distance(g.normal(item), g.normal(mid)) <= int(g.MAX_DISTANCE * len(g.normal(item))):
            want.add((k, i))
    found = {(k, r["item_id"]) for k, rows in enumerate(g.leaks(index, texts)) for r in rows}
    assert len(want) > n / 2
    return len(found & want) / len(want)


def test_recall_by_length_and_rate():
    """Items of 10 to 63 bytes lose nothing; of longer ones nine of ten are found at every rate."""
    rnd = random.Random(9)

    def prose_of(a, b):
        return lambda: prose(rnd, 40)[: rnd.randint(a, b)].strip().ljust(a, "q")

    for a, b, least in ((10, 23, 1.0), (24, 39, 1.0), (40, 63, 1.0), (64, 79, .9), (80, 250, .9), (251, 400, .9)):
        for rate in (.05, .1, .15, .2):
            assert recall(rnd, prose_of(a, b) if b < 100 else lambda: prose(rnd, 90)[: rnd.randint(a, b)], rate) >= least, (a, b, rate)


def test_a_column_named_as_the_result_is_replaced(spark):
    bench = spark.createDataFrame([(1, "a benchmark question of some words and more")], "item_id long, text string")
    df = spark.createDataFrame([("x", 1, "well: a benchmark question of some words and more", 2)], "leaks string, c0 int, text string, found int")
    (r,) = g.with_leaks(df, bench).collect()
    assert (r.c0, r.found, [x.item_id for x in r.leaks]) == (1, 2, [1])
    (r,) = g.with_leaks(df, bench, out_col="found").collect()
    assert (r.leaks, r.c0, r.found[0].distance) == ("x", 1, 0)


def test_the_index_is_compact():
    import pickle
    rnd = random.Random(10)
    index = g.index_items([(i, prose(rnd, rnd.randint(15, 60))) for i in range(200)])
    assert len(pickle.dumps(index)) < 16 << 20


def test_heads_leave_out_no_pair_and_most_unlike_ones():
    rnd = random.Random(11)
    items, texts, near = [], [], []
    for n in range(300):
        item = prose(rnd, rnd.randint(12, 60)).encode().ljust(64, b"q")
        like = n % 3 != 0
        mid = edit(rnd, item.decode(), rnd.choice([0, .1, .17, .2, .22])) if like else prose(rnd, 50)
        items.append(item)
        texts.append((prose(rnd, rnd.randint(0, 6)) + mid + prose(rnd, rnd.randint(0, 6))).encode())
        near.append(like)
    most = [int(g.MAX_DISTANCE * len(i)) for i in items]
    on = g.may_hold(items, texts, most)
    within = np.array([distance(i, t) <= m for i, t, m in zip(items, texts, most)])
    assert within.sum() > 100 and on[within].all()
    unlike = ~np.array(near) & ~within
    assert on[unlike].sum() < unlike.sum() / 4


def test_may_hold_at_the_edges():
    item = b"abcdefgh" * 20
    assert g.may_hold([], [], []).tolist() == []
    assert g.may_hold([item] * 5, [item, item[32:], item[:128], b"", b"x" * 400], [32] * 5).tolist() == [True, True, True, False, False]
    assert g.may_hold([item, item], [item, item[1:]], [0, 0]).tolist() == [True, False]
    assert g.may_hold([item[:64]], [b""], [12]).tolist() == [True]  # no longer than its head: not judged


def test_pairs_side_by_side_and_one_by_one_agree(monkeypatch):
    rnd = random.Random(12)
    items, texts = [], []
    for _ in range(120):
        item = prose(rnd, rnd.randint(2, 40))
        items.append(item.encode())
        texts.append((prose(rnd, rnd.randint(0, 8)) + edit(rnd, item, rnd.random() * .3) + prose(rnd, 3)).encode() if rnd.random() < .9 else b"\0a\0")
    want = [distance(i, t.replace(b"\0", b"\xff")) for i, t in zip(items, texts)]
    monkeypatch.setattr(g, "FEW", 0)
    side, ends = g.best_stretches(items, texts)
    monkeypatch.setattr(g, "FEW", 1 << 20)
    one, one_ends = g.best_stretches(items, texts)
    assert side.tolist() == one.tolist() == want and ends.tolist() == one_ends.tolist()


def test_whole_items_are_compared_only_where_their_heads_are(monkeypatch):
    """Of the candidates in unlike texts, which are most, few are compared whole; the copies are all found."""
    rnd = random.Random(13)
    words = [prose(rnd, 1)[:4] for _ in range(40)]
    say = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(i, say(rnd.randint(30, 60))) for i in range(60)]
    index = g.index_items(items)
    texts = [say(400) for _ in range(300)] + [say(40) + " " + t + " " + say(40) for _, t in items]
    whole, seen = set(map(g.normal, dict(items).values())), []
    compare, one = g._distances, g._distance
    monkeypatch.setattr(g, "_distances", lambda eq, kinds, which, length, texts: seen.extend(length.tolist()) or compare(eq, kinds, which, length, texts))
    monkeypatch.setattr(g, "_distance", lambda item, text: seen.append(len(item)) or one(item, text))
    got = g.leaks(index, texts)
    assert all(i in {r["item_id"] for r in rows if r["distance"] == 0} for (i, _), rows in zip(items, got[300:], strict=True))
    longer = sum(n in set(map(len, whole)) for n in seen)
    assert len(seen) > 1000 and longer < len(seen) / 3
