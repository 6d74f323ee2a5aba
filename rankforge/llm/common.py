"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import write_and_read

#: Rows per Arrow batch where each row carries a whole text.
TEXT_BATCH = 256
#: Bytes from which on an Arrow batch to Python ends, so that long texts come in smaller ones.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder and scan it back."""
    return write_and_read(df, f"llm-{name}")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its columns' letter case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def remainder(id_col: str, n: int) -> Column:
    """crc32(id as text) mod n; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


def is_remainder(id_col: str, n: int, r: int) -> Column:
    """Never null: a row without an id is on the learning side, where it has no label to give."""
    return F.coalesce(remainder(id_col, n) == r, F.lit(False))


def chunks(batch: pa.RecordBatch, rows: int = TEXT_BATCH) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python end at ``BATCH_BYTES``, or at less where the session says so.

    Without a limit a batch is 10,000 rows, however long: JVM and Python worker hold it at the same time, each task its own.
    Spark reads the setting when a query runs, so it stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def text_bytes(col: pa.Array) -> list[bytes]:
    """Each text's UTF-8 bytes; a null is empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def share(spark: SparkSession, thing) -> Callable:
    """Broadcasts an object of this package; the result, called in a task, gives it."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    got: list = []

    def value():
        if not got:
            got.append(pickle.loads(held.value))
        return got[0]

    return value


def per_text(df: DataFrame, keep: list[str], text_col: str, fn: Callable[[list], dict[str, pa.Array]],
             fields: list[T.StructField], rows: int = TEXT_BATCH) -> DataFrame:
    """Row for row: the ``keep`` columns and what ``fn`` makes of a chunk's texts (None where null).

    Rows stay in their partition; a task holds one Arrow batch of texts, which are sent once, kept or not.
    """
    bounded_batches(df.sparkSession)
    src = df.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), *([] if text_col in keep else [F.col(text_col).alias("text")]))
    at = [*keep, text_col].index(text_col)
    schema = T.StructType([*(T.StructField(c, src.schema[f"k{i}"].dataType) for i, c in enumerate(keep)), *fields])

    def run(batches):
        for big in batches:
            for b in chunks(big, rows):
                made = fn(b.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [made[f.name] for f in fields],
                                                 names=[*keep, *(f.name for f in fields)])

    return src.mapInArrow(run, schema)


def bounded_rows(df: DataFrame, n: int, key: Column) -> list:
    """At most n rows at the driver, the smallest by ``key``."""
    return df.orderBy(key).limit(n).collect()


def sigmoid(x):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x, y, l2: float = 1e-2, steps: int = 30, weight=1.0):
    """Newton's method on columns of x plus an intercept; returns the weights, intercept last."""
    import numpy as np

    a = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(a.shape[1])
    reg = np.full(len(w), l2)
    for _ in range(steps):
        p = sigmoid(a @ w)
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(reg) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (weight * (p - y)) + reg * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def labelled(labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id") -> DataFrame:
    """(id, _y) of the rows to learn from: a non-null id, a label of 0 or 1; an id labelled twice counts once, with its larger label."""
    return (labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y"))
            .where(F.col(id_col).isNotNull() & F.col("_y").isin(0, 1)).where(learn).groupBy(id_col).agg(F.max("_y").alias("_y")))


def roles(lab: DataFrame, name: str, each: int, calibration: int, id_col: str = "doc_id") -> tuple[dict, dict]:
    """id to (label, "example" or "calibration"), and the number of rows with each label.

    Examples are at most ``each`` rows and two thirds of the rows of either label; then come calibration rows. All by hashes of the id.
    """
    by = F.struct(F.xxhash64(F.lit(name), F.col(id_col)), F.col(id_col))
    n = {r["_y"]: r["count"] for r in lab.groupBy("_y").count().collect()}
    out = {r[0]: (r[1], "example") for y in n for r in bounded_rows(lab.where(F.col("_y") == y), min(each, -(-2 * n[y] // 3)), by)}
    # By another hash: the same one would bring the examples up again.
    most, other = len(out) + calibration, F.struct(F.xxhash64(F.lit(f"{name} calibration"), F.col(id_col)), F.col(id_col))
    for r in bounded_rows(lab, calibration + 2 * each, other):
        if len(out) < most:
            out.setdefault(r[0], (r[1], "calibration"))
    return out, n


def calibrated(vote, label, n: dict, default=(8.0, -6.4)):
    """Slope (slopes, of votes in columns) and intercept from a vote in 0..1 to the probability of label 1, each label weighing as in all labelled rows."""
    import numpy as np

    label = np.asarray(label, float)
    have = [(label == y).sum() for y in (0, 1)]
    if not all(have):
        return np.array(default)
    return fit_logistic(np.asarray(vote).reshape(len(label), -1), label, weight=np.where(label == 1, n[1] / have[1], n[0] / have[0]) * len(label) / (n[0] + n[1]))


def rows_of(docs: DataFrame, ids: list, kind: T.DataType, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text) of a bounded list of ids, which is broadcast."""
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([T.StructField("_id", kind)]))
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(wanted), "_id")
