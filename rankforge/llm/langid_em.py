"""Language identification by multilingual mixture inference.

Each language has a byte trigram model (add-``SMOOTH`` counts over hashed
trigrams of its labelled sample). A document is a mixture: every word (with the
space before and after it) comes from one language, and its likelihood under a
language is the product of its trigrams'. Expectation-maximisation estimates the
proportions over all words of the whole text. The set of languages is chosen by
penalised likelihood: from all languages, the one with the least share goes and the
proportions are estimated again, for as long as the log-likelihood lost is less
than ``PENALTY`` * ln(words) for each language saved. The document's language is that with
the largest proportion, and that proportion is the score.

The models are fitted on a bounded sample of labelled rows: the ``per_language``
smallest by hash of the id, for each language.

Nulls and edges: a text that is null or has no letter is ``und`` with score 0.0.
Rows without a language or text teach nothing. With no language learnt every
document is ``und``. Ties go to the smaller language name. Repeated rows are judged alike. Extra
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import TEXT_BATCH, per_text, share, written

BINS = 1 << 15
SMOOTH = 0.3
ROUNDS = 12
PENALTY = 1.0
PER_LANGUAGE = 500
PARTS = 16
#: Words whose likelihoods are worked out at once, and bytes of text whose words are held.
PIECE = 1 << 16
HELD = 1 << 22
UNDETERMINED = "und"

# Every ASCII character that isn't a letter separates; A-Z become a-z.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass
class Models:
    names: list[str]
    logp: np.ndarray  # bins x languages


def letters(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(_LETTERS)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(buf: np.ndarray) -> np.ndarray:
    """Bin of each trigram; a trigram counts to the word its middle byte is in."""
    b = buf.astype(np.uint32)
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - 15)


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams with a middle in a word, and where each word's begin. Runs of separators count as one."""
    buf = np.frombuffer(b" " + b" ".join(data.split()) + b" ", np.uint8)
    if len(buf) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    inside = buf[1:-1] != 32
    start = inside & np.append(True, ~inside[:-1])
    return grams(buf)[inside], np.flatnonzero(start[inside])


def count_grams(texts: list) -> np.ndarray:
    out = np.zeros(BINS, np.int64)
    for t in texts:
        out += np.bincount(words(letters(t))[0], minlength=BINS)
    return out


def fit(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Models:
    """``learn``: a condition on the id; other rows' languages are never read."""
    rows = docs.where(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    # The sample's ids first: narrow rows, limited in parts and then for each language, so no task gets more than parts * per_language of them.
    narrow = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        by = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit("language"), "id"), "id")
        narrow = narrow.withColumn("n", F.row_number().over(by)).where(F.col("n") <= per_language)
    # Written, so that its size is known: small enough, it is broadcast and no text is dealt out.
    ids = written(narrow.select("id", "lang").distinct(), "language-sample")
    sample = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(ids, ["id", "lang"])

    def count(batches):
        total: dict = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[lang] = total.get(lang, 0) + count_grams([text])
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bin", "n"])

    # At most BINS rows for each language come to the driver.
    counted = sample.select("lang", "text").mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counted["lang"].unique())
    n = np.zeros((BINS, len(names)))
    if names:
        n[counted["bin"].to_numpy(), np.searchsorted(names, counted["lang"].to_numpy().astype(str))] = counted["n"]
    n += SMOOTH
    return Models(names, np.log(n / n.sum(0)).astype(np.float32))


def _em(like: np.ndarray, base: np.ndarray, doc: np.ndarray, begins: np.ndarray, n: np.ndarray, allowed: np.ndarray, times: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and log-likelihoods; like: of each word, scaled by exp(base); times: how often the document has it; n: its words, repeats too."""
    share = allowed / allowed.sum(1, keepdims=True)
    of = [np.ascontiguousarray(c) for c in like.T]

    def mixed():
        total = of[0] * share[:, 0][doc]
        for j in range(1, len(of)):
            total += of[j] * share[:, j][doc]
        return np.maximum(total, 1e-300, out=total)

    # A single language has every word from the start, unless it gives one no likelihood at all.
    for _ in range(ROUNDS if len(of) > 1 or of[0].min() < 1e-200 else 0):
        w = times / mixed()
        share = share * np.stack([np.add.reduceat(c * w, begins) for c in of], 1) / n[:, None]
    return share, np.add.reduceat(times * (np.log(mixed()) + base), begins)


def mixtures(models: Models, texts: list[bytes]) -> np.ndarray:
    """Proportions of the selected languages, for each text; all 0 without words.

    A word's likelihoods are worked out once for all texts, and a text's words that repeat are one row that counts so often.
    """
    k = len(models.names)
    out = np.zeros((len(texts), k))
    number: dict[bytes, int] = {}
    which, often, sizes, counts, who = [], [], [], [], []
    for i, t in enumerate(texts):
        bag = Counter(t.split())
        if bag:
            which += [number.setdefault(w, len(number)) for w in bag]
            often += bag.values()
            sizes.append(len(bag))
            counts.append(bag.total())
            who.append(i)
    if not who or not k:
        return out
    bins, start = words(b" ".join(number))
    logl = np.concatenate([np.add.reduceat(models.logp[bins[start[a]:start[a + PIECE] if a + PIECE < len(start) else len(bins)]], start[a:a + PIECE] - start[a], axis=0)
                           for a in range(0, len(start), PIECE)]).astype(float)
    highest = logl.max(1)
    which, times, size, n, at = np.array(which), np.array(often, float), np.array(sizes), np.array(counts), np.array(who)
    like = np.ascontiguousarray(np.exp(logl - highest[:, None]).T)[:, which]
    base = highest[which]
    doc, begins = np.repeat(np.arange(len(at)), size), np.cumsum(size) - size
    names = np.tile(np.arange(k), (len(at), 1))
    share, ll = _em(like.T, base, doc, begins, n, np.ones(names.shape), times)
    out[at] = share
    for left in range(k - 1, 0, -1):  # backward: try without the least language; like, names and share have those left
        least = share.argmin(1)
        like = np.where(np.arange(left)[:, None] < least[doc], like[:-1], like[1:])
        names = names[np.arange(left + 1) != least[:, None]].reshape(-1, left)
        share, ll_new = _em(like.T, base, doc, begins, n, np.ones(names.shape), times)
        better = ll - ll_new <= PENALTY * np.log(n + 1)
        if not better.any():
            break
        if not better.all():
            mine = better[doc]
            like, base, times = like[:, mine], base[mine], times[mine]
            size, n, at, names, share, ll_new = size[better], n[better], at[better], names[better], share[better], ll_new[better]
            doc, begins = np.repeat(np.arange(len(at)), size), np.cumsum(size) - size
        ll = ll_new
        out[at] = 0
        out[at[:, None], names] = share
    return out


def _pieces(texts: list[bytes]):
    """Ranges of texts of about HELD bytes together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= HELD:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default), ``lang_pred``, ``score`` and ``mixture``: the languages selected and their proportions."""
    held = share(docs.sparkSession, models)

    def run(texts):
        names = held().names
        data = [letters(t) for t in texts]
        share = np.zeros((len(texts), len(names)))
        for a, b in _pieces(data):
            share[a:b] = mixtures(held(), data[a:b])
        lang, score, mixture = [], [], []
        for t, s in zip(texts, share, strict=True):
            known = bool(names) and has_letter(t) and s.any()
            best = int(s.argmax()) if known else 0
            lang.append(names[best] if known else UNDETERMINED)
            score.append(float(min(1.0, s[best])) if known else 0.0)
            mixture.append([{"lang": names[i], "share": float(s[i])} for i in np.flatnonzero(s > 0)] if known else [])
        return {"lang_pred": pa.array(lang), "score": pa.array(score), "mixture": pa.array(mixture, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))}

    return per_text(docs, keep or [id_col], text_col, run, [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("mixture", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))], TEXT_BATCH)
