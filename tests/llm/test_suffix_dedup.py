import random
from collections import defaultdict

import pytest

from rankforge.llm import suffix_dedup as s
from tests.llm.helpers import awkward, docs, prose, sha


def brute(rows, length):
    where = defaultdict(int)
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for k in range(len(b) - length + 1):
            where[b[k:k + length]] += 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if where[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    out = s.repeated_spans(docs(spark, rows), **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted(map(tuple, out), key=str)


def test_awkward(spark):
    rows = awkward()
    assert run(spark, rows) == brute(rows, 200)
    assert run(spark, []) == []


@pytest.mark.parametrize("hot,local_hot", [(1, 2), (1 << 14, 32), (1 << 14, 3)])
def test_shared_passages(spark, hot, local_hot):
    """Passages of about the length, in other surroundings, at any offset; periodic text; both ways for hot hashes."""
    rnd = random.Random(5)
    parts = [prose(rnd, rnd.randint(3, 12)) for _ in range(12)] + ["ab" * 40, "é" * 25]
    rows = []
    for i in range(60):
        rows.append((i, "".join(rnd.choice(parts) + ("" if rnd.random() < .5 else prose(rnd, 2)) for _ in range(rnd.randint(1, 9)))))
    want = brute(rows, 60)
    assert sum(r[2] for r in want) > 1000
    assert run(spark, rows, length=60, gram=16, hot=hot, local_hot=local_hot, queue_rows=64) == want


def test_long_text_is_cut_into_pieces(spark, monkeypatch):
    rnd = random.Random(6)
    text = prose(rnd, 4000)
    rows = [(1, text + "|" + text[5000:9000]), (2, prose(rnd, 300) + text[100:800])]
    monkeypatch.setattr(s, "PIECE", 1000)
    s._TABLES.clear()
    got = run(spark, rows)
    s._TABLES.clear()
    assert got == brute(rows, 200)
