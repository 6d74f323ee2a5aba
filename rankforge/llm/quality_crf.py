"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of kinds of characters,
word counts and repetition, together with those of the line before and the
line after; a 2 x 2 table scores neighbouring labels. Forward and backward
passes give each line's probability of being good, and the mean over lines,
weighted by length, is the document's quality; a logistic curve fitted on
further labelled rows turns it into the probability of label 1.

Labels are given for documents, so a training line has its document's label. Training
uses a bounded sample: ``max_examples`` documents of either label and
``max_calibration`` more, the smallest by hash of the id. Scores use every line
of every whole text.

Nulls and edges: a null or empty text is one empty line. Label rows with a null id or
label teach nothing; an id labelled twice counts once, with its larger label.
Without labels every score is 0.5. Repeated rows score alike. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rankforge.llm.common import calibrated, fit_logistic, labelled, per_text, roles, rows_of, sigmoid, share

MAX_EXAMPLES = 1000
MAX_CALIBRATION = 2000
#: Lines of a training sequence; a longer document gives several.
SEGMENT = 256
STEPS = 60

# Kinds of bytes, as text: each is one feature. Bytes of 128 and above are letters.
KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"?!()-", "#$%&*+<=>@[\\]^_`{|}~/")
_KIND = np.zeros(256, np.uint8)
for _n, _chars in enumerate(KINDS):
    _KIND[[ord(c) for c in _chars]] = _n + 1
_KIND[128:] = 1
_KIND[ord(" ")] = len(KINDS) + 1
N_OWN = len(KINDS) + 7  # with spaces, length, length of words, distinct words, full stop, repeat, few words


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features without neighbours, length of each line, lines of each text)."""
    data = [(t or "").encode("utf-8", "replace").split(b"\n") for t in texts]
    counts = np.array([len(d) for d in data], np.int64)
    lines = [x for d in data for x in d]
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    buf = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    start = np.cumsum(size + 1) - (size + 1)
    kind = _KIND[buf]
    out = np.zeros((len(lines), N_OWN), np.float32)
    n = np.maximum(size, 1)
    for k in range(len(KINDS) + 1):
        out[:, k] = np.add.reduceat(kind == k + 1, start, dtype=np.int64) / n
    split = [x.split() for x in lines]
    words = np.fromiter(map(len, split), np.int64, len(lines))
    several = np.fromiter((len(set(w)) for w in split), np.int64, len(lines))
    at = len(KINDS) + 1
    out[:, at] = np.log1p(size) / 8
    out[:, at + 1] = np.minimum(size / np.maximum(words, 1), 30) / 10
    out[:, at + 2] = np.where(words > 0, several / np.maximum(words, 1), 1)
    out[:, at + 3] = np.fromiter((x.endswith(b".") for x in lines), bool, len(lines))
    again = np.fromiter((a == b for a, b in zip(lines[1:], lines[:-1], strict=True)), bool, max(len(lines) - 1, 0))
    out[1:, at + 4] = again
    out[np.cumsum(counts) - counts, at + 4] = 0
    out[:, at + 5] = words <= 2
    return out, size, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0 at the ends), and whether there is such a line."""
    begin = np.cumsum(counts) - counts
    n, m = own.shape
    out = np.zeros((n, 3 * m + 2), np.float32)
    out[:, :m] = own
    out[1:, m:2 * m], out[:-1, 2 * m:3 * m] = own[:-1], own[1:]
    out[begin, m:2 * m] = 0
    out[begin + counts - 1, 2 * m:3 * m] = 0
    out[begin, 3 * m] = 1
    out[begin + counts - 1, 3 * m + 1] = 1
    return out


@dataclass
class Crf:
    weight: np.ndarray
    bias: float
    pair: np.ndarray  # 2 x 2, [label, next label]
    mean: np.ndarray
    scale: np.ndarray
    curve: np.ndarray


def forward_backward(node: np.ndarray, pair: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected number of each pair of neighbouring labels. All sequences step together."""
    order = np.argsort(-counts, kind="stable")
    begin = (np.cumsum(counts) - counts)[order]
    size = counts[order]
    ahead, back = np.zeros((len(node), 2)), np.zeros((len(node), 2))
    score = np.column_stack([np.zeros(len(node)), node])
    ahead[begin] = score[begin]
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size.max(initial=1)))]  # sequences longer than t
    for t in range(1, len(live)):
        at = begin[:live[t]] + t
        a = ahead[at - 1]
        ahead[at, 0] = np.logaddexp(a[:, 0] + pair[0, 0], a[:, 1] + pair[1, 0])
        ahead[at, 1] = np.logaddexp(a[:, 0] + pair[0, 1], a[:, 1] + pair[1, 1]) + score[at, 1]
    for t in range(len(live) - 1, 0, -1):
        at = begin[:live[t]] + t
        b = back[at] + score[at]
        back[at - 1, 0] = np.logaddexp(b[:, 0] + pair[0, 0], b[:, 1] + pair[0, 1])
        back[at - 1, 1] = np.logaddexp(b[:, 0] + pair[1, 0], b[:, 1] + pair[1, 1])
    good = sigmoid((ahead + back)[:, 1] - (ahead + back)[:, 0])
    z = np.repeat(np.logaddexp(*(ahead + back)[np.cumsum(counts) - counts].T), counts)
    inner = np.ones(len(node), bool)
    inner[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inner)
    expected = np.array([[np.exp(np.minimum(ahead[at - 1, i] + pair[i, j] + back[at, j] + score[at, j] - z[at], 0)).sum() for j in (0, 1)] for i in (0, 1)])
    return good, expected


def train(x: np.ndarray, y: np.ndarray, counts: np.ndarray, l2: float = 1.0) -> Crf:
    """Maximum likelihood by gradient steps with momentum, from a plain logistic start. y: of each line."""
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = ((x - mean) / scale).astype(float)
    w = fit_logistic(z, y.astype(float), l2=l2) * 0.5
    pair = np.zeros((2, 2))
    inner = np.ones(len(y), bool)
    inner[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inner)
    seen = np.array([[np.sum((y[at - 1] == i) & (y[at] == j)) for j in (0, 1)] for i in (0, 1)], float)
    n = len(y)
    vw, vp, sw, sp = np.zeros(len(w)), np.zeros((2, 2)), np.zeros(len(w)), np.zeros((2, 2))
    for step in range(1, STEPS + 1):
        good, expected = forward_backward(z @ w[:-1] + w[-1], pair, counts)
        gw = np.append(z.T @ (y - good), (y - good).sum()) / n - l2 * w / n
        gp = (seen - expected) / n - 0.01 * pair
        vw, vp = 0.9 * vw + 0.1 * gw, 0.9 * vp + 0.1 * gp
        sw, sp = 0.99 * sw + 0.01 * gw * gw, 0.99 * sp + 0.01 * gp * gp
        b1, b2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w = w + 0.05 * (vw / b1) / (np.sqrt(sw / b2) + 1e-8)
        pair = pair + 0.05 * (vp / b1) / (np.sqrt(sp / b2) + 1e-8)
    return Crf(w[:-1], float(w[-1]), pair, mean, scale, np.array([1.0, 0.0]))


def quality(crf: Crf, texts: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Length-weighted mean of the lines' marginals, and the marginals."""
    own, size, counts = line_features(texts)
    good, _ = forward_backward((with_neighbours(own, counts) - crf.mean) / crf.scale @ crf.weight + crf.bias, crf.pair, counts)
    begin = np.cumsum(counts) - counts
    weight = size + 1.0
    return np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin), np.split(good, begin[1:])


def fit(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_examples: int = MAX_EXAMPLES, max_calibration: int = MAX_CALIBRATION) -> Crf | None:
    """``learn``: a condition on the id column; labels of other rows are never read. None without labels."""
    lab = labelled(labels, label_col, learn, id_col)
    role, n = roles(lab, "quality", max_examples, max_calibration, id_col)
    if not role:
        return None

    def features(texts):
        own, size, counts = line_features(texts)
        cut = np.cumsum(counts)[:-1]
        return {"own": pa.array([p.ravel().tolist() for p in np.split(own, cut)], pa.list_(pa.float32())), "size": pa.array([p.tolist() for p in np.split(size, cut)], pa.list_(pa.int64()))}

    rows = per_text(rows_of(docs, list(role), lab.schema[id_col].dataType, id_col, text_col), ["_id"], "_text", features,
                    [T.StructField("own", T.ArrayType(T.FloatType())), T.StructField("size", T.ArrayType(T.LongType()))])
    seen = {}
    for r in rows.toLocalIterator():
        f = np.array(r["own"], np.float32).reshape(-1, N_OWN)
        if r["_id"] not in seen or f.tobytes() < seen[r["_id"]][0].tobytes():  # an id that repeats: the same text in any run
            seen[r["_id"]] = (f, np.array(r["size"], np.int64))
    ids = sorted((i for i in seen if role[i][1] == "example"), key=str)
    rest = sorted((i for i in seen if role[i][1] == "calibration"), key=str) or ids
    if not ids:
        return None
    counts = np.array([len(seen[i][0]) for i in ids])
    x = with_neighbours(np.concatenate([seen[i][0] for i in ids]), counts)
    y = np.repeat([role[i][0] for i in ids], counts)
    pieces = np.concatenate([np.diff(np.append(np.arange(0, c, SEGMENT), c)) for c in counts])
    crf = train(x, y, pieces)
    counts = np.array([len(seen[i][0]) for i in rest])
    good, _ = forward_backward((with_neighbours(np.concatenate([seen[i][0] for i in rest]), counts) - crf.mean) / crf.scale @ crf.weight + crf.bias, crf.pair, counts)
    weight = np.concatenate([seen[i][1] for i in rest]) + 1.0
    begin = np.cumsum(counts) - counts
    doc = np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin)
    crf.curve = calibrated(doc, [role[i][0] for i in rest], n)
    return crf


def score(docs: DataFrame, crf: Crf | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default), ``score``, ``predicted`` and ``lines``: each line's probability of being good."""
    held = share(docs.sparkSession, crf)

    def run(texts):
        m = held()
        doc, lines = quality(m, texts) if m else (np.full(len(texts), 0.5), [np.zeros(0)] * len(texts))
        p = sigmoid(m.curve[0] * doc + m.curve[1]) if m else doc
        flat = np.concatenate(lines) if lines else np.zeros(0)
        at = np.cumsum([0] + [len(x) for x in lines]).astype(np.int32)
        return {"score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32)), "lines": pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.float32)))}

    return per_text(docs, keep or [id_col], text_col, run, [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("lines", T.ArrayType(T.FloatType()))])
