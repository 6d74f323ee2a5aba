"""Small documents with every awkward case, and brute-force counterparts."""

import hashlib
import random

from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns whose names operators might use themselves.
CLASH = ("score", "predicted", "fp", "component", "x1", "x2", "n", "leaks", "bucket", "id", "row", "blob", "found", "size", "value", "digest")


def prose(rnd, n, stock=("lor", "em", "ip", "sum", "dol", "or", "sit", "am", "et", "con", "sec", "tet")):
    return " ".join("".join(rnd.choices(stock, k=rnd.randint(1, 3))) for _ in range(n))


def docs(spark, rows, extra=True):
    """rows: (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(7) for c in CLASH})
    return df


def awkward(seed=1):
    """Nulls, blanks, repeats, a very long text, ties."""
    rnd = random.Random(seed)
    a = prose(rnd, 120)
    rows = [(i, prose(rnd, rnd.randint(3, 90))) for i in range(1, 25)]
    rows += [(30, a), (31, a), (31, a), (32, a[:250] + " edited " + a[250:]), (None, a), (33, None), (34, ""), (35, " \t\n "), (36, "one"), (None, None), (37, prose(rnd, 30_000)), (38, a * 3)]
    return rows


def sha(b):
    return hashlib.sha256(b).hexdigest()
