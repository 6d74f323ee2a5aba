"""WARC archives and their index, merged from sorted runs.

Every page becomes a WARC/1.0 record. Of the records with equal payloads of
``REVISIT_BYTES`` or more, that with the smallest page id is the response and the
others are revisits that refer to it and carry no payload. Archives are plain
files of Spark's text writer in the shared folder (a record ends with CR LF CR LF,
and the writer's line end is its last byte), closed after about ``ARCHIVE_BYTES``.

They are read back record by record by their lengths; a response's payload is
hashed again and must match its header. Each archive gives a run of index lines,
sorted by URL key, time and id. Runs are merged k ways: ranges of the sorted
order are dealt to tasks, and in each a loser tree, one leaf for each run, gives out
the lines, log2(k) comparisons a line. Ranges are cut by the whole sort key, so
a URL with a third of all captures is spread over several tasks. The capture history is in
order by (range_no, pos).

Nulls and edges: a null html is an empty payload; a null url gives no target header
and an empty key; a null page id comes after all others, so it is a response only if no
other page has its payload. Rows that repeat a page id are records of their own; where the
smallest id of a payload repeats, all rows with it are responses. Control
characters in a url are written percent-encoded. Empty tables give an empty archive and index. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import written
from rankforge.session import scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20
#: Index lines for each task of the merge.
MERGE_ROWS = 20_000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

ENTRY = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("urlkey", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: captures of a site sort together."""
    try:
        u = urlsplit(url or "")
        host, port = u.hostname or "", f":{u.port}" if u.port else ""
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def captured_at(id_col: str = "page_id") -> Column:
    """Where a table has no capture times: a second for each id from a fixed day, wrapping after some 30 years."""
    return F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.coalesce(F.col(id_col), F.lit(0)), F.lit(1_000_000_000)))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time: Column | None = None) -> DataFrame:
    """One column, ``value``: each page's record without its last byte."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                        F.date_format(time if time is not None else captured_at(id_col), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    rows = rows.withColumn("n", F.octet_length("html").cast("long")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # Payloads that repeat, one row each; written, so that its size is known when the join is planned.
    again = written(rows.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").select(F.col("digest").alias("d"), "first"), "payloads")
    rows = rows.join(again, F.col("digest") == F.col("d"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    block = F.octet_length(F.lit(_HTTP)) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", urn(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")), line("WARC-Date", F.col("date")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", urn(F.col("first"))), line("X-Payload-Length", F.col("n").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", block.cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(head, F.lit(_HTTP), F.when(revisit, F.lit("")).otherwise(F.col("html")), F.lit("\r\n\r")).alias("value"))


def write_archives(pages: DataFrame, path: str | None = None, archive_bytes: int = ARCHIVE_BYTES, **columns) -> str:
    """The folder of the archives (``*.warc`` content under Spark's part names). No shuffle of payloads beyond the join on repeated ones."""
    path = path or scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex[:12]}")
    html = columns.get("html_col", "html")
    n, total = pages.agg(F.count("*"), F.sum(F.octet_length(html).cast("long"))).first()
    each = max(1, int(archive_bytes / ((total or 0) / max(n, 1) + 600)))
    records(pages, **columns).write.option("maxRecordsPerFile", each).option("lineSep", "\n").option("compression", "none").text(path)
    return path


_HEAD = re.compile(rb"WARC/1\.0\r\n(.*?)\r\n\r\n", re.S)


def parse(data: bytes) -> list[tuple]:
    """(offset, length, headers, payload) of each record, by its declared length."""
    out, at = [], 0
    view = memoryview(data)
    while at < len(data):
        m = _HEAD.match(data, at)
        if not m:
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in m[1].decode().split("\r\n"))
        begin, n = m.end(), int(headers["Content-Length"])
        end = begin + n + 4
        if bytes(view[begin + n:end]) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at}: its length doesn't end at a record end")
        payload = data.index(b"\r\n\r\n", begin) + 4
        out.append((at, end - at, headers, view[payload:begin + n]))
        at = end
    return out


def _id(urn: str | None) -> int | None:
    x = (urn or "")[len("<urn:page:"):-1]
    return int(x) if x not in ("", "none") else None


def sort_key(urlkey: str, timestamp: str, page_id: int | None, run: str, seq: int) -> tuple:
    return urlkey, timestamp, page_id is None, page_id or 0, run, seq


def run_of(name: str, data: bytes) -> list[tuple]:
    """The archive's index lines, sorted."""
    lines = []
    for offset, length, h, payload in parse(data):
        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = h["WARC-Type"]
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{name}: the payload at {offset} doesn't match its digest")
        size = len(payload) if kind == "response" else int(h["X-Payload-Length"])
        stamp = re.sub(r"\D", "", h["WARC-Date"])
        lines.append((url_key(h.get("WARC-Target-URI")), stamp, _id(h["WARC-Record-ID"]), size, digest, kind, _id(h.get("WARC-Refers-To")), offset, length))
    lines.sort(key=lambda x: sort_key(x[0], x[1], x[2], name, x[7]))
    return [(name, i, *x) for i, x in enumerate(lines)]


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every archive's sorted run, written; an archive is read by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                lines = run_of(b.column(0)[i].as_py().rsplit("/", 1)[-1], b.column(1)[i].as_py())
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), _ARROW, strict=True)], names=ENTRY.names)

    return written(files.mapInArrow(run, ENTRY), "runs")


_ARROW = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in ENTRY]


class LoserTree:
    """k-way merge: inner nodes hold the loser of their game, the root's winner comes out next."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.head = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        """Winner below a node (leaves are k to 2k - 1)."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self.head[self.winner] is not None:
            run = self.winner
            yield self.head[run]
            self.head[run] = next(self.runs[run], None)
            node = (run + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merged(runs: DataFrame, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """The runs' lines in global order by (range_no, pos)."""
    n = runs.count()
    key = [F.col("urlkey"), F.col("timestamp"), F.col("page_id").asc_nulls_last(), F.col("run"), F.col("seq")]
    ranged = runs.repartitionByRange(max(1, -(-n // merge_rows)), *key).sortWithinPartitions("run", "seq")
    schema = T.StructType([*ENTRY, T.StructField("range_no", T.IntegerType()), T.StructField("pos", T.LongType())])

    def merge(batches):
        t = pa.Table.from_batches(list(batches)) if (batches := [*batches]) else None  # one range: about merge_rows lines
        if t is None or not t.num_rows:
            return
        keys = list(zip(map(sort_key, *(t.column(c).to_pylist() for c in ("urlkey", "timestamp", "page_id", "run", "seq"))), range(t.num_rows), strict=True))
        cut = [i for i in range(1, len(keys)) if keys[i][0][4] != keys[i - 1][0][4]]
        order = [i for _, i in LoserTree([keys[a:b] for a, b in zip([0, *cut], [*cut, len(keys)], strict=True)])]
        t = t.take(pa.array(order))
        t = t.append_column("range_no", pa.array(np.full(len(order), TaskContext.get().partitionId(), np.int32))).append_column("pos", pa.array(np.arange(len(order))))
        yield from t.combine_chunks().to_batches()

    return ranged.mapInArrow(merge, schema)


def capture_index(pages: DataFrame, **columns) -> DataFrame:
    """Write, read back, index and merge."""
    path = write_archives(pages, **columns)
    return merged(index_runs(pages.sparkSession, path))
