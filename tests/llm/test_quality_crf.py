import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from rankforge.llm import quality_crf as q
from tests.llm.helpers import awkward, docs, prose


def corpus(seed=1, n=120):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < .6
        lines = [prose(rnd, rnd.randint(4, 20)).capitalize() + "." if good or rnd.random() < .2 else " | ".join(prose(rnd, 8).split()) + " $$$" for _ in range(rnd.randint(1, 9))]
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(good)))
    return rows, labels


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    node, pair, counts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([4, 1, 4])
    good, expected = q.forward_backward(node, pair, counts)
    want, pairs, at = [], np.zeros((2, 2)), 0
    for c in counts:
        all_ = list(itertools.product((0, 1), repeat=int(c)))
        w = np.array([np.exp(sum(node[at + i] * y for i, y in enumerate(ys)) + sum(pair[a, b] for a, b in zip(ys, ys[1:]))) for ys in all_])
        w /= w.sum()
        want += [sum(p for p, ys in zip(w, all_) if ys[i]) for i in range(c)]
        for p, ys in zip(w, all_):
            for a, b in zip(ys, ys[1:]):
                pairs[a, b] += p
        at += c
    assert np.allclose(good, want) and np.allclose(expected, pairs)


def test_held_out_accuracy_and_labels_unread(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    learn = F.col("doc_id") % 3 != 1
    crf = q.fit(docs(spark, rows), lab, learn)
    out = {r.doc_id: r for r in q.score(docs(spark, rows), crf).collect()}
    held = [(out[i].predicted, y) for i, y in labels if i % 3 == 1]
    assert sum(p == y for p, y in held) / len(held) > .9
    flipped = lab.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    assert np.array_equal(q.fit(docs(spark, rows), flipped, learn).weight, crf.weight)


def test_edges(spark):
    rows, labels = corpus(2, 40)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    crf = q.fit(docs(spark, rows), lab, F.lit(True))
    odd = awkward()
    out = q.score(docs(spark, odd), crf).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in out)
    assert len({r.score for r in out if r.doc_id in (30, 31)}) == 1
    assert q.score(docs(spark, []), crf).collect() == []
    assert q.fit(docs(spark, rows), lab.limit(0), F.lit(True)) is None
    assert {r.score for r in q.score(docs(spark, rows), None).collect()} == {0.5}
