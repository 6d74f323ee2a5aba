"""Toxicity by the nearest labelled examples.

Exact TF-IDF cosine, over all terms, against a bounded set of labelled examples,
searched through an inverted index of every term that an example has. Terms that many
examples have are dense rows in blocks of ``BLOCK`` examples, and every (term, block)
keeps its largest weight; the posting lists of the others are added up first. A query's
bound for a block is one dot product plus the block's largest sum so far; blocks are visited
from the highest bound, and a block whose bound can't reach the query's last score so far is
skipped. The nearest ``voters`` vote with weight cosine**sharpness, both chosen by leaving one example out at a time
(the widest area under the curve). In a long text the few words that make it toxic hardly move these cosines, so the examples
vote a second time, nearest by the terms that tell the labels apart alone: those whose share among the examples of either
label differs by more than chance lets the furthest of as many terms differ, weighted by their log odds ratio, and one term
that every text has. A logistic curve fitted on further labelled rows turns both votes into a
probability. The ``k`` nearest of the first are the evidence.

A text's own length scales all of its TF-IDF cosines alike: neighbours, votes and score don't
depend on it. The evidence's cosines do: the terms of a text that no example has are
counted over all documents and joined to the texts (a left join by a digest of the text,
which Spark leaves out where the evidence isn't selected).

Document frequencies count every document. Only the examples and the
calibration rows are a (documented) bounded sample: ``max_examples`` of each
class and ``max_calibration`` rows, the smallest by hash of their id.

Nulls and edges: a null or empty text has no terms and so no neighbours; its
score is the calibrated value of an empty first vote (the share of label 1 among the
examples' prior) and of the second vote of texts without telling terms. Very long texts are whole; a task holds one batch of texts. Equal cosines go to the example that comes first
in the index. An empty table gives an empty one. Columns of ``docs`` pass by their places, so any names do; kept ones that are named as the
result's are replaced by them. Label rows with a null id or null label teach nothing; an
id labelled twice counts once, with its larger label. Repeated documents are
scored alike. Without any usable labels every score is 0.0.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import bounded_batches, calibrated, labelled, per_text, roles, rows_of, sigmoid, share

BLOCK = 64
K = 31
#: What is tried for the number of voters and for the power of a cosine in the vote.
VOTERS = (15, 31, 63, 127)
SHARPNESS = (1.0, 2.0, 4.0)
MAX_EXAMPLES = 1000
MAX_CALIBRATION = 2000
LEAST_CUT = 30
#: Terms that this share of the examples has are dense rows, the most frequent ones; all others are posting lists.
DENSE_SHARE = 0.03
MAX_DENSE = 8000
#: Products of posting lists that are held at once.
AT_ONCE = 1 << 18
#: Labelled rows that the driver scores at once.
ROWS = 256
#: A term of every text, which no token is: texts without telling terms are near each other by it.
EVERY = b""

# Every ASCII character that is neither letter nor digit separates; A-Z become a-z.
_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(_SEPARATE).split()


@dataclass
class Index:
    terms: dict[bytes, int]  # the dense ones first
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    blocks: list[tuple[int, np.ndarray, np.ndarray]]  # first example, terms it has, weights (terms x examples)
    highest: np.ndarray  # dense terms x blocks
    first: np.ndarray  # by other term: where its postings begin, and the end
    who: np.ndarray
    weight: np.ndarray
    curve: np.ndarray
    k: int
    voters: int
    sharpness: float = SHARPNESS[0]
    cut: float = 0.5  # from this score on, ``accepted`` lets a document go
    telling: Index | None = None  # the same examples by the terms that tell the labels apart


@dataclass
class Vectors:
    """Rows of (1 + ln tf) * idf, of length 1 or, without known terms, 0."""
    dense: np.ndarray
    row: np.ndarray  # the other terms: row, number among the others, weight
    term: np.ndarray
    weight: np.ndarray
    norm: np.ndarray  # before


def vectors(bags: list[dict], terms: dict[bytes, int], idf: np.ndarray, n_dense: int) -> Vectors:
    found = [[(i, terms[t], n) for t, n in bag.items() if t in terms] for i, bag in enumerate(bags)]
    row, term, tf = np.array([x for f in found for x in f], np.int64).reshape(-1, 3).T
    weight = (1 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(row, weight * weight, len(bags)))
    weight = (weight / norm[row]).astype(np.float32)
    own = term < n_dense
    dense = np.zeros((len(bags), n_dense), np.float32)
    dense[row[own], term[own]] = weight[own]
    return Vectors(dense, row[~own], term[~own] - n_dense, weight[~own], norm)


def ordered_by_likeness(x: np.ndarray, rounds: int = 4, seed: int = 7) -> np.ndarray:
    """An order of the examples that puts like ones into the same blocks, which keeps block bounds tight."""
    n = max(1, len(x) // (2 * BLOCK))
    centre = x[np.random.default_rng(seed).permutation(len(x))[:n]]
    near = np.zeros(len(x), int)
    for _ in range(rounds):
        near = (x @ centre.T).argmax(1)
        centre = np.stack([x[near == c].mean(0) if (near == c).any() else centre[c] for c in range(len(centre))])
    return np.argsort(near, kind="stable")


def build_index(x: np.ndarray, ids: list, toxic: np.ndarray, terms: dict, idf: np.ndarray, k: int = K, others: Vectors | None = None) -> Index:
    """x: the examples' dense terms; others: the rest of them."""
    order = ordered_by_likeness(x) if len(x) else np.zeros(0, int)
    x, toxic, ids = x[order], toxic[order], [ids[i] for i in order]
    blocks, highest = [], np.zeros((x.shape[1], -(-len(x) // BLOCK)), np.float32)
    for b, at in enumerate(range(0, len(x), BLOCK)):
        part = x[at:at + BLOCK]
        has = np.flatnonzero(part.any(0))
        blocks.append((at, has, np.ascontiguousarray(part[:, has].T)))
        highest[:, b] = part.max(0)
    first, who, weight = np.zeros(len(idf) - x.shape[1] + 1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
    if others is not None:
        by_term = np.argsort(others.term, kind="stable")
        first = np.searchsorted(others.term[by_term], np.arange(len(first)))
        who, weight = np.argsort(order)[others.row[by_term]].astype(np.int32), others.weight[by_term]
    return Index(terms, idf, ids, toxic, blocks, highest, first, who, weight, np.zeros(2), k, k)


def posted(index: Index, q: Vectors) -> np.ndarray:
    """What the terms of posting lists add to the cosine of each row with each example."""
    n, m = len(q.dense), len(index.ids)
    out = np.zeros(n * m)
    size = index.first[q.term + 1] - index.first[q.term]
    total = np.cumsum(size)
    cuts = np.searchsorted(total, np.arange(AT_ONCE, total[-1] if len(total) else 0, AT_ONCE))
    for a, b in zip([0, *cuts], [*cuts, len(size)], strict=True):
        s = size[a:b]
        at = np.repeat(index.first[q.term[a:b]] - np.cumsum(s) + s, s) + np.arange(s.sum())
        out += np.bincount(np.repeat(q.row[a:b], s) * m + index.who[at], np.repeat(q.weight[a:b], s) * index.weight[at], n * m)
    return out.reshape(n, m).astype(np.float32)


def nearest(index: Index, q: np.ndarray, more: np.ndarray | None = None, n_best: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The highest cosines of each row (k of them) and their examples (-1: none), ties to the smaller example. more: what ``posted`` gives."""
    n, k = len(q), n_best or index.k
    # A cosine's bits, which are in its order, over the example's number from behind.
    best = np.zeros((n, k), np.int64)
    bound = q @ index.highest + 1e-5
    if more is not None:
        bound += np.maximum.reduceat(more, [at for at, _, _ in index.blocks], axis=1)
    for b in np.argsort(-bound.mean(0), kind="stable"):
        at, has, weights = index.blocks[b]
        rows = np.flatnonzero(bound[:, b] > _cosine(best[:, 0]))
        if not len(rows):
            continue
        s = q[np.ix_(rows, has)] @ weights
        if more is not None:
            s += more[rows, at:at + s.shape[1]]
        new = np.ascontiguousarray(np.maximum(s, 0), np.float32).view(np.int32).astype(np.int64) << 32 | (_LAST - np.arange(at, at + s.shape[1]))
        best[rows] = np.partition(np.hstack([best[rows], new]), s.shape[1], axis=1)[:, s.shape[1]:]
    best = np.sort(best, axis=1)[:, ::-1]
    score = _cosine(best)
    return score, np.where(score > 0, _LAST - (best & _LAST), -1)


_LAST = (1 << 32) - 1


def _cosine(best: np.ndarray) -> np.ndarray:
    return (best >> 32).astype(np.int32).view(np.float32)


def tally(index: Index, score: np.ndarray, who: np.ndarray, voters: int, sharpness: float) -> np.ndarray:
    """The share of label 1 among the voters, by weight; the examples' share where there are none."""
    score, who = score[:, :voters], who[:, :voters]
    w = np.where(who >= 0, score.astype(float) ** sharpness, 0)
    total = w.sum(1)
    return np.where(total > 0, (w * index.toxic[who]).sum(1) / np.where(total > 0, total, 1), index.toxic.mean())


def votes(index: Index, q: Vectors, told: Vectors | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both votes, by row, and the evidence's cosines and examples. told: what ``by_telling`` gives."""
    if not index.blocks:
        return np.zeros((len(q.dense), 2)), np.zeros((len(q.dense), index.k)), np.full((len(q.dense), index.k), -1)
    score, who = nearest(index, q.dense, posted(index, q), max(index.k, index.voters))
    t = index.telling
    second = tally(t, *nearest(t, told.dense, None, t.voters), t.voters, t.sharpness)
    return np.column_stack([tally(index, score, who, index.voters, index.sharpness), second]), score[:, :index.k], who[:, :index.k]


def probability(index: Index, vote: np.ndarray) -> np.ndarray:
    return sigmoid(vote @ index.curve[:-1] + index.curve[-1])


def odds(have: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The size of each term's log odds ratio; 0 where the labels' shares differ by no more than chance. have: labels x terms, n: examples by label."""
    if not n.all():
        return np.zeros(have.shape[1])
    p = have.sum(0) / n.sum()
    apart = np.abs(have[1] / n[1] - have[0] / n[0]) > np.sqrt(2 * np.log(max(2, (p > 0).sum())) * p * (1 - p) * (1 / n).sum())
    log_odds = np.log((have + 0.5) / (n[:, None] - have + 0.5))
    return np.where(apart, np.abs(log_odds[1] - log_odds[0]), 0)


def by_telling(bags: list[dict], terms: dict[bytes, int], weight: np.ndarray) -> Vectors:
    """The bags by the telling terms. Puts ``EVERY`` into them."""
    for bag in bags:
        bag[EVERY] = 1
    return vectors(bags, terms, weight, len(terms))


def area(vote: np.ndarray, label: np.ndarray) -> float:
    """Under the curve: the share of (1, 0) pairs in order, ties by half."""
    order = np.sort(vote[label == 0])
    if not len(order) or len(order) == len(vote):
        return 0.5
    of = vote[label == 1]
    return float((np.searchsorted(order, of) + np.searchsorted(order, of, "right")).mean() / 2 / len(order))


def choose(index: Index, own) -> None:
    """Voters and sharpness, by leaving each example out of its own neighbours. own: parts of the examples, (vectors, numbers in the index)."""
    kept, label = [], []
    for x, place in own:
        score, who = nearest(index, x.dense, posted(index, x), max(VOTERS) + 1)
        other = np.argsort(who == place[:, None], axis=1, kind="stable")[:, :-1]  # itself last
        kept.append((np.take_along_axis(score, other, 1), np.take_along_axis(who, other, 1)))
        label.append(index.toxic[place])
    score, who, label = (np.concatenate(a) for a in (*zip(*kept, strict=True), label))
    best = -1.0
    for voters in VOTERS:
        for sharpness in SHARPNESS:
            a = area(tally(index, score, who, voters, sharpness), label)
            if a > best + 1e-9:
                best, index.voters, index.sharpness = a, voters, sharpness


def fit(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_examples: int = MAX_EXAMPLES, max_calibration: int = MAX_CALIBRATION, k: int = K) -> Index:
    """``learn``: a condition on the id column; labels of other rows are never read."""
    lab = labelled(labels, label_col, learn, id_col)
    role, n = roles(lab, "toxicity", max_examples, max_calibration, id_col)
    terms, idf, ids, x, y = {}, np.zeros(0), [], np.zeros((0, 0), np.float32), np.zeros(0)
    if not role:
        return build_index(x, ids, y, terms, idf, k)

    rows = rows_of(docs, list(role), lab.schema[id_col].dataType, id_col, text_col)

    def bags(texts):
        bag = [Counter(tokens(t)) for t in texts]
        return {"terms": pa.array([[*b] for b in bag], pa.list_(pa.binary())), "counts": pa.array([[*b.values()] for b in bag], pa.list_(pa.int32()))}

    number: dict[bytes, int] = {}  # each term once, whoever has it
    seen: dict = {}
    for r in per_text(rows, ["_id"], "_text", bags, [T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]).toLocalIterator():
        bag = np.array([number.setdefault(bytes(t), len(number)) for t in r["terms"]], np.int32), np.array(r["counts"], np.int32)
        if r["_id"] in seen:  # an id that repeats: the same text in any run
            names = list(number)
            of = lambda x: sorted((names[t], n) for t, n in zip(x[0].tolist(), x[1].tolist(), strict=True))
            bag = min(seen[r["_id"]], bag, key=of)
        seen[r["_id"]] = bag
    ids = sorted((i for i in seen if role[i][1] == "example"), key=str)
    calibration = sorted((i for i in seen if role[i][1] == "calibration"), key=str)
    names = list(number)
    have = np.bincount(np.concatenate([seen[i][0] for i in ids]) if ids else np.zeros(0, int), minlength=len(names))
    order = sorted(np.flatnonzero(have).tolist(), key=lambda t: (-have[t], names[t]))
    terms = {names[t]: i for i, t in enumerate(order)}
    n_dense = min(MAX_DENSE, int((have >= max(2, DENSE_SHARE * len(ids))).sum()))
    idf = document_frequencies(docs, text_col, terms)

    def bags_of(which):
        return [dict(zip((names[t] for t in seen[i][0].tolist()), seen[i][1].tolist(), strict=True)) for i in which]

    def x_of(which):
        return vectors(bags_of(which), terms, idf, n_dense)

    def told_of(which, telling, weight):
        return by_telling(bags_of(which), telling, weight)

    in_parts = lambda which: [which[at:at + ROWS] for at in range(0, len(which), ROWS)]
    y = np.array([role[i][0] for i in ids], float)
    x = x_of(ids)
    index = build_index(x.dense, ids, y, terms, idf, k, x)
    del x
    if index.blocks:
        n_of = np.array([(y == label).sum() for label in (0, 1)])
        having = np.stack([np.bincount(np.concatenate([seen[i][0] for i in ids if role[i][0] == label] or [np.zeros(0, int)]), minlength=len(names)) for label in (0, 1)])
        weight = odds(having, n_of)
        tells = sorted(np.flatnonzero(weight).tolist(), key=lambda t: names[t])
        telling, weight = {t: i for i, t in enumerate([EVERY, *(names[t] for t in tells)])}, np.append(1.0, weight[tells])
        x = np.concatenate([told_of(part, telling, weight).dense for part in in_parts(ids)])
        index.telling = build_index(x, ids, y, telling, weight, k)
    if index.blocks:
        for ix, of in ((index, x_of), (index.telling, lambda which: told_of(which, telling, weight))):
            place = {i: n for n, i in enumerate(ix.ids)}
            choose(ix, ((of(part), np.array([place[i] for i in part])) for part in in_parts(ids)))
    v = [votes(index, x_of(part), told_of(part, telling, weight) if index.blocks else None)[0] for part in in_parts(calibration)]
    v, label = np.concatenate(v) if v else np.zeros((0, 2)), np.array([role[i][0] for i in calibration])
    index.curve = calibrated(v, label, n, (8.0, 0.0, -6.4))
    index.cut = even_cut(probability(index, v), label)
    return index


def even_cut(score: np.ndarray, label: np.ndarray) -> float:
    """The score from which on the share of label 1 is furthest above that of label 0, both labels weighing alike however rare one is.

    Midway between neighbouring scores; of equally good ones that nearest to 0.5, or 0.5 itself where it is as good. 0.5 where
    either label has fewer than ``LEAST_CUT`` rows, too few to tell a better one.
    """
    if min((label == y).sum() for y in (0, 1)) < LEAST_CUT:
        return 0.5
    own = np.unique(score)
    cuts = np.append((own[1:] + own[:-1]) / 2, 0.5)
    of = [np.sort(score[label == y]) for y in (0, 1)]
    gain = np.searchsorted(of[0], cuts) / len(of[0]) - np.searchsorted(of[1], cuts) / len(of[1])
    best = cuts[gain >= gain.max() - 1e-12]
    return float(best[np.argmin(np.abs(best - 0.5))])


def document_frequencies(docs: DataFrame, text_col: str, terms: dict[bytes, int]) -> np.ndarray:
    """idf of each indexed term over all documents: one row of sums per task, then one."""
    n_terms = len(terms)
    held = share(docs.sparkSession, terms)
    bounded_batches(docs.sparkSession)

    def count(batches):
        total, n = np.zeros(n_terms, np.int64), 0
        get = held().get
        for b in batches:
            for text in b.column(0).to_pylist():
                n += 1
                if text:
                    total[[t for t in map(get, set(tokens(text))) if t is not None]] += 1
        total = np.append(total, n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(n_terms + 1)
    for r in sums.collect():  # as many rows as terms, plus one
        df[r["term"]] = r["n"]
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 0.1


def digest(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode("utf-8", "replace"), digest_size=16).digest()


def unknown_lengths(docs: DataFrame, held, text_col: str) -> DataFrame:
    """(_digest, _more): by text, the sum of the squared weights of its terms that no example has; only texts with such terms.

    Frequencies are counted over all documents; a term's rows meet its count in a join, counts of 1 left out.
    """
    n = F.broadcast(docs.agg(F.count(F.lit(1)).alias("_n")))

    def unknown(texts):
        terms = held().terms
        bags = [Counter(t for t in tokens(x) if t not in terms) for x in texts]
        return {"_digest": pa.array([digest(x) for x in texts], pa.binary()), "_terms": pa.array([[*b] for b in bags], pa.list_(pa.binary())),
                "_tfs": pa.array([[*b.values()] for b in bags], pa.list_(pa.int32()))}

    rows = per_text(docs, [], text_col, unknown, [T.StructField("_digest", T.BinaryType()), T.StructField("_terms", T.ArrayType(T.BinaryType())),
                                                  T.StructField("_tfs", T.ArrayType(T.IntegerType()))])
    rows = rows.select("_digest", F.explode(F.arrays_zip("_terms", "_tfs")).alias("_x")).select("_digest", F.col("_x._terms").alias("_term"), F.col("_x._tfs").alias("_tf"))
    texts = rows.dropDuplicates(["_term", "_digest"])  # repeated texts: once
    often = rows.groupBy("_term").agg(F.count(F.lit(1)).alias("_all")).where("_all > 1")
    idf = F.log((1 + F.col("_n")) / (1 + F.coalesce(F.col("_all"), F.lit(1)))) + 0.1
    weight = (1 + F.log("_tf")) * idf
    return texts.join(often, "_term", "left").crossJoin(n).groupBy("_digest").agg(F.sum(weight * weight).alias("_more"))


_FOUND = T.ArrayType(T.StructType([T.StructField("example", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.IntegerType())]))


def judged(docs: DataFrame, index: Index, text_col: str = "text", evidence: bool = True) -> tuple[DataFrame, Callable]:
    """Every column of ``docs`` by its place (c0, c1, ...), then score, predicted and norm, with ``evidence`` found and digest; and the shared index."""
    held = share(docs.sparkSession, index)

    def run(texts):
        ix = held()
        bags = [Counter(tokens(x)) for x in texts]
        q = vectors(bags, ix.terms, ix.idf, len(ix.highest))
        v, s, who = votes(ix, q, by_telling(bags, ix.telling.terms, ix.telling.idf) if ix.blocks else None)
        p = probability(ix, v) if ix.blocks else np.zeros(len(texts))
        out = {"score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32)), "norm": pa.array(q.norm)}
        if not evidence:
            return out
        near = [[{"example": str(ix.ids[e]), "cosine": float(c), "label": int(ix.toxic[e])} for c, e in zip(cs, es, strict=True) if e >= 0]
                for cs, es in zip(s, who, strict=True)]
        return out | {"found": pa.array(near, pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))),
                      "digest": pa.array([digest(x) for x in texts], pa.binary())}

    places = [f"c{i}" for i in range(len(docs.columns))]
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("norm", T.DoubleType())]
    if evidence:
        fields += [T.StructField("found", _FOUND), T.StructField("digest", T.BinaryType())]
    return per_text(docs.toDF(*places), places, places[docs.columns.index(text_col)], run, fields), held


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default), ``score``, ``predicted`` and ``evidence``: the neighbours, nearest first."""
    kept = [c for c in keep or [id_col] if c not in ("score", "predicted", "evidence")]
    need = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text_col).alias("text"))
    rows = need.toDF(*(f"k{i}" for i in range(len(kept))), "text")
    found, held = judged(rows, index)
    part = F.col("norm") / F.sqrt(F.col("norm") * F.col("norm") + F.coalesce("_more", F.lit(0.0)))
    evidence = F.transform("found", lambda e: F.struct(e["example"].alias("example"), (e["cosine"] * part).alias("cosine"), e["label"].alias("label")))
    found = found.join(unknown_lengths(rows, held, "text").withColumnRenamed("_digest", "digest"), "digest", "left").withColumn("evidence", evidence)
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), "score", "predicted", "evidence")


def accepted(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with all of their columns.

    Called toxic are scores from the index's ``cut`` on: ``predicted`` asks for even odds, at which most of a rare label
    passes. Of a text without known words nothing is known but how frequent the label is; it goes only at even odds.
    """
    rows, _ = judged(docs, index, text_col, evidence=False)
    stays = (F.col("score") < index.cut) | ((F.col("norm") == 0) & (F.col("predicted") == 0))
    return rows.where(stays).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
