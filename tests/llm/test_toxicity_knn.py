import random

import numpy as np
from pyspark.sql import functions as F

from rankforge.llm import toxicity_knn as t
from tests.llm.helpers import awkward, docs, prose


def corpus(seed=1, n=160):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rnd.random() < .4
        words = prose(rnd, rnd.randint(10, 60)).split()
        for _ in range(6 if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["vilex", "nastyo", "grubby"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(500, 40)) * (rng.random((500, 40)) < .2)).astype(np.float32)
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    index = t.build_index(x, list(range(500)), np.zeros(500), {}, np.ones(40, np.float32), 7)
    q = x[:60] * 0.5 + x[100:160] * 0.5
    score, who = t.nearest(index, q)
    full = np.sort(q @ x.T, axis=1)[:, ::-1][:, :7]
    assert np.allclose(score, full, atol=1e-5)
    mine = np.array([[q[i] @ x[index.ids[e]] if e >= 0 else 0 for e in row] for i, row in enumerate(who)])
    assert np.allclose(mine, score, atol=1e-5)


def test_held_out_accuracy_and_labels_unread(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    learn = F.col("doc_id") % 5 != 0
    index = t.fit(docs(spark, rows), lab, learn, k=9)
    out = {r.doc_id: r for r in t.score(docs(spark, rows), index).collect()}
    held = [(out[i].predicted, y) for i, y in labels if i % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > .9
    assert all(len(r.evidence) == 9 and r.evidence[0].cosine >= r.evidence[-1].cosine for r in out.values())
    flipped = lab.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert np.array_equal(t.fit(docs(spark, rows), flipped, learn, k=9).curve, index.curve)


def test_frequencies_count_every_document(spark):
    rows, _ = corpus(2, 50)
    idf = t.document_frequencies(docs(spark, rows).repartition(3), "text", {b"vilex": 0, b"nowhere": 1})
    n = sum("vilex" in x.split() for _, x in rows)
    assert np.allclose(idf, np.log([51 / (1 + n), 51]) + .1)


def test_edges(spark):
    rows, labels = corpus(3, 60)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    index = t.fit(docs(spark, rows), lab, F.lit(True))
    odd = awkward()
    out = t.score(docs(spark, odd), index).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert t.score(docs(spark, []), index).collect() == []
    none = t.fit(docs(spark, rows), lab.limit(0), F.lit(True))
    assert {(r.score, r.predicted) for r in t.score(docs(spark, rows), none).collect()} == {(0.0, 0)}


def test_rare_words_count_as_in_brute_force(spark):
    """Neighbours and cosines from the raw texts, with words that one or two examples, or no example, have."""
    from collections import Counter

    rows, labels = corpus(4, 150)
    rnd = random.Random(5)
    rows = [(i, f"{x} only{i} pair{i // 2} group{rnd.randrange(9)} far{i % 40 if i >= 120 else 'x'}") for i, x in rows] + [(900, "unheard words alone"), (901, rows[0][1] + " only0 unheard unheard")]
    df = docs(spark, rows).repartition(3)
    index = t.fit(df, spark.createDataFrame(labels[:120], "doc_id long, toxic int"), F.lit(True), k=7)
    bags = {i: Counter(x.split()) for i, x in rows}
    many = Counter(w for b in bags.values() for w in b)
    vec = {i: {w: (1 + np.log(n)) * (np.log((1 + len(rows)) / (1 + many[w])) + .1) for w, n in b.items()} for i, b in bags.items()}
    norm = {i: np.sqrt(sum(x * x for x in v.values())) for i, v in vec.items()}
    out = t.score(df, index).collect()
    assert len(out) == len(rows)
    for r in out:
        v = vec[r.doc_id]
        cosine = {e: sum(x * vec[e].get(w, 0) for w, x in v.items()) / norm[r.doc_id] / norm[e] for e in index.ids}
        best = sorted((c for c in cosine.values() if c > 0), reverse=True)[:7]
        assert np.allclose([e.cosine for e in r.evidence], best, atol=1e-5)
        assert all(abs(e.cosine - cosine[int(e.example)]) < 1e-5 for e in r.evidence)
    assert "Join" not in t.score(df, index).select("doc_id", "score")._jdf.queryExecution().optimizedPlan().toString()


def test_voters_are_chosen_on_the_examples():
    """Leaving one out: what is chosen has the widest area of all that is tried, and no example votes for itself."""
    rng = np.random.default_rng(6)
    y = (rng.random(300) < .4).astype(float)
    x = np.abs(rng.normal(size=(300, 30))) * (rng.random((300, 30)) < .4)
    x[:, :3] += y[:, None] * rng.random((300, 3))
    x = (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)).astype(np.float32)
    index = t.build_index(x, list(range(300)), y, {}, np.ones(30, np.float32), 7)
    place = np.array([index.ids.index(i) for i in range(300)])
    none = np.zeros(0, np.int64)
    t.choose(index, [(t.Vectors(x[a:a + 70], none, none, none.astype(np.float32), np.ones(70)), place[a:a + 70]) for a in range(0, 300, 70)])
    cosine = (x @ x.T).astype(float)
    np.fill_diagonal(cosine, -1)

    def tried(k, p):
        vote = []
        for i in range(300):
            near = np.argsort(-cosine[i], kind="stable")[:k]
            w = np.maximum(cosine[i, near], 0) ** p
            vote.append((w * y[near]).sum() / w.sum())
        pairs = [(a > b) + (a == b) / 2 for a, ya in zip(vote, y) if ya for b, yb in zip(vote, y) if not yb]
        return np.mean(pairs)

    areas = {(k, p): tried(k, p) for k in t.VOTERS for p in t.SHARPNESS}
    assert areas[index.voters, index.sharpness] >= max(areas.values()) - 1e-3


def test_any_column_names(spark):
    rows, labels = corpus(7, 60)
    df = docs(spark, rows)
    index = t.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    odd = df.withColumns({c: F.lit(c) for c in ("_found", "found", "evidence", "_norm", "norm", "_digest", "digest", "_more", "c0", "k0", "a.b")})
    want = {r.doc_id for r in t.score(df, index).collect() if r.predicted == 0}
    kept = t.accepted(odd, index)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == want
    assert all(r["a.b"] == "a.b" and r["score"] == 7 for r in kept.collect())
    out = t.score(odd, index, keep=odd.columns)
    assert out.columns[-3:] == ["score", "predicted", "evidence"] and len(set(out.columns)) == len(out.columns) and out.count() == 60


def test_cut_weighs_both_labels_alike():
    rng = np.random.default_rng(8)
    label = (rng.random(400) < .1).astype(int)
    score = np.clip(rng.normal(.1 + .2 * label, .1), 0, 1).round(2)
    cut = t.even_cut(score, label)
    gain = lambda c: (score[label == 1] >= c).mean() - (score[label == 0] >= c).mean()
    assert gain(cut) >= max(gain(c) for c in np.arange(0, 1, .005)) - 1e-9 and gain(cut) > gain(.5) + .3
    assert t.even_cut(np.array([.1, .9]), np.array([0, 1])) == t.even_cut(np.array([.7]), np.array([1])) == t.even_cut(np.zeros(0), np.zeros(0)) == .5


def test_rare_and_faint_label_is_caught(spark):
    """A rare label whose words come once: at even odds most rows of it would stay."""
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(2400):
        bad = rnd.random() < .1
        words = prose(rnd, rnd.randint(10, 40)).split()
        if rnd.random() < (.8 if bad else .08):
            words.insert(0, rnd.choice(["vilex", "nastyo", "grubby"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    df = docs(spark, rows + [(3000, None), (3001, " ")])
    index = t.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 3 != 0)
    kept = {r.doc_id for r in t.accepted(df, index).collect()}
    even = {r.doc_id for r in t.score(df, index).collect() if r.predicted == 0}
    caught = lambda k, y: np.mean([i not in k for i, x in labels if i % 3 == 0 and x == y])
    assert caught(kept, 1) > caught(even, 1) + .2 and caught(kept, 1) - caught(kept, 0) > caught(even, 1) - caught(even, 0) + .1
    assert {3000, 3001} <= kept


def test_few_words_in_long_texts_are_caught(spark):
    """Long texts of many subjects, in which a few words make the label: cosines over all terms hardly see them."""
    rnd = random.Random(10)
    subjects = [prose(rnd, 60, tuple(f"s{s}{x}" for x in "abcdefghi")).split() for s in range(12)]
    bad_words = ["vilex", "nastyo", "grubby", "sordix", "meanal", "foulum", "rottan", "cruelo"]
    rows, labels = [], []
    for i in range(1800):
        bad = rnd.random() < .15
        words = rnd.choices(subjects[rnd.randrange(12)], k=rnd.randint(100, 400))
        for w in rnd.sample(bad_words, 2) if bad else []:
            words.insert(rnd.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    index = t.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 3 != 0)
    assert {w.encode() for w in bad_words} <= set(index.telling.terms)
    kept = {r.doc_id for r in t.accepted(docs(spark, rows), index).collect()}
    caught = lambda y: np.mean([i not in kept for i, x in labels if i % 3 == 0 and x == y])
    assert caught(1) > .95 and caught(0) < .02


def test_telling_terms_differ_by_more_than_chance():
    rng = np.random.default_rng(11)
    n = np.array([300, 200])
    have = rng.binomial(n[:, None], rng.random(4000) * .3)  # the same share of either label
    assert (t.odds(have, n) > 0).sum() <= 2
    told = t.odds(np.column_stack([have, [0, 60], [200, 20]]), n)[-2:]
    assert np.allclose(told, [np.log(60.5 / 140.5) - np.log(.5 / 300.5), np.log(200.5 / 100.5) - np.log(20.5 / 180.5)])
    assert not t.odds(have, np.array([300, 0])).any()


def test_a_task_holds_few_texts(spark):
    """Long texts come to Python in small batches, each text once, kept or not."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from rankforge.llm import common

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    df = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit("words "), 2000)).alias("text"))
    length = [T.StructField("n", T.IntegerType())]
    for keep in (["doc_id"], ["doc_id", "text"], ["text", "doc_id"]):
        rows = common.per_text(df, keep, "text", lambda texts: {"n": pa.array([len(x) for x in texts], pa.int32())}, length)
        assert rows.columns == [*keep, "n"]
        assert sorted((r.doc_id, r.n) for r in rows.select("doc_id", "n").collect()) == [(i, 12000 + len(str(i))) for i in range(2000)]
    index = t.fit(df, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"), F.lit(True))
    kept = t.accepted(df, index)
    sizes = df.mapInArrow(size, "rows long, bytes long").collect()
    assert sum(r.rows for r in sizes) == 2000 and max(r.bytes for r in sizes) < 2 * common.BATCH_BYTES
    plan = kept._jdf.queryExecution().analyzed()
    while "MapInArrow" not in plan.nodeName():
        plan = plan.children().apply(0)
    assert plan.children().apply(0).output().size() == 2
