import random

import numpy as np
from pyspark.sql import functions as F

from rankforge.llm import langid_em as e
from tests.llm.helpers import awkward, docs, prose

STOCK = {"aa": ("kal", "mo", "ti"), "bb": ("schw", "ein", "ge"), "cc": ("ção", "lh", "ua")}


def corpus(seed=1, n=90):
    rnd = random.Random(seed)
    return [(i, prose(rnd, rnd.randint(5, 60), STOCK[lang]), lang) for i in range(n) for lang in [rnd.choice(list(STOCK))]]


def test_held_out_and_mixture(spark):
    rows = corpus()
    learn = F.col("doc_id") % 4 != 2
    models = e.fit(docs(spark, rows + [(500, None, "aa"), (501, "x", None)]), learn)
    assert models.names == ["aa", "bb", "cc"]
    out = {r.doc_id: r for r in e.identify(docs(spark, rows), models).collect()}
    assert all(out[i].lang_pred == lang and out[i].score > .9 for i, _, lang in rows)
    rnd = random.Random(9)
    both = prose(rnd, 60, STOCK["aa"]) + " " + prose(rnd, 30, STOCK["bb"])
    r = e.identify(docs(spark, [(1, both)]), models).first()
    mix = {x.lang: x.share for x in r.mixture}
    assert set(mix) == {"aa", "bb"} and abs(mix["aa"] - 2 / 3) < .1 and r.lang_pred == "aa" and abs(r.score - mix["aa"]) < 1e-9


def test_em_against_a_plain_loop():
    rnd = random.Random(3)
    counts = np.stack([e.count_grams([prose(rnd, 400, s)]) for s in STOCK.values()], 1) + e.SMOOTH
    models = e.Models(list(STOCK), np.log(counts / counts.sum(0)).astype(np.float32))
    text = e.letters(prose(rnd, 20, STOCK["aa"]) + " " + prose(rnd, 20, STOCK["cc"]))
    bins, start = e.words(text)
    like = np.array([[np.exp(sum(float(models.logp[b, k]) for b in w)) for k in range(3)] for w in np.split(bins, start[1:])])
    share = np.ones(3) / 3
    for _ in range(e.ROUNDS):
        r = like * share
        share = (r / r.sum(1, keepdims=True)).mean(0)
    n = np.array([len(start)])
    logl = np.log(like)
    got, _ = e._em(np.exp(logl - logl.max(1, keepdims=True)), logl.max(1), np.zeros(len(like), int), np.array([0]), n, np.ones((1, 3)))
    assert np.allclose(got[0], share, atol=1e-4)


def test_edges(spark):
    rows = corpus(2)
    models = e.fit(docs(spark, rows), F.lit(True))
    odd = awkward() + [(70, "12 34 !?"), (71, "É"), (72, "漢字"), (73, "ª")]
    out = e.identify(docs(spark, odd), models).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.lang_pred for r in out}
    assert all(by[i] == "und" for i in (33, 34, 35, 70)) and all(by[i] in STOCK for i in (71, 72, 36))
    assert e.identify(docs(spark, []), models).collect() == []
    none = e.fit(docs(spark, []), F.lit(True))
    assert {(r.lang_pred, r.score) for r in e.identify(docs(spark, rows), none).collect()} == {("und", 0.0)}


def test_repeated_words_are_worked_out_once(monkeypatch):
    """Proportions, set of languages included, as from a loop over every word; a word's trigrams are looked up once for all texts."""
    rnd = random.Random(4)
    counts = np.stack([e.count_grams([prose(rnd, 400, s)]) for s in STOCK.values()], 1) + e.SMOOTH
    models = e.Models(list(STOCK), np.log(counts / counts.sum(0)).astype(np.float32))
    texts = [" ".join(prose(rnd, 15, s) for s in rnd.sample(list(STOCK.values()), rnd.randint(1, 3))) for _ in range(40)]
    texts = [e.letters(" ".join(rnd.choices(x.split(), k=120))) for x in texts] + [b"", b" ", b"a", b"ab" * 3000, texts[0].encode()]
    looked_up = []
    plain = e.words
    monkeypatch.setattr(e, "words", lambda data: looked_up.append(data) or plain(data))
    got = e.mixtures(models, texts)
    assert sum(len(x.split()) for x in looked_up) == len({w for x in texts for w in x.split()})

    def em(like, of):
        share = np.ones(len(of)) / len(of)
        for _ in range(e.ROUNDS):
            r = like[:, of] * share
            share = (r / r.sum(1, keepdims=True)).mean(0)
        return share, np.log((like[:, of] * share).sum(1)).sum()

    for text, mine in zip(texts, got, strict=True):
        bins, start = plain(text)
        want = np.zeros(3)
        if len(start):
            logl = np.array([models.logp[w].sum(0, dtype=float) for w in np.split(bins, start[1:])])
            like, of = np.exp(logl - logl.max(1, keepdims=True)), [0, 1, 2]
            share, ll = em(like, of)
            while len(of) > 1:
                fewer = [j for j in of if j != of[share.argmin()]]
                new, ll_new = em(like, fewer)
                if not ll - ll_new <= e.PENALTY * np.log(len(start) + 1):
                    break
                of, share, ll = fewer, new, ll_new
            want[of] = share
        assert np.allclose(mine, want, atol=1e-4) and ((mine > 0) == (want > 0)).all()
