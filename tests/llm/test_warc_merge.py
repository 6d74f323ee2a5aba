import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm import warc_merge as w
from tests.llm.helpers import sha

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
BODY = "<p>same</p>" * 20


def index(spark, rows, **kw):
    pages = spark.createDataFrame(rows, PAGE).withColumns({"value": F.lit(1), "digest": F.lit("x"), "run": F.lit(2)})
    return w.capture_index(pages, **kw).collect()


def test_revisits_and_edges(spark):
    rows = [(5, "http://b.org/x", BODY), (3, "http://a.org/x", BODY), (3, "http://a.org/x", BODY), (None, "http://c.org/", BODY), (7, None, None),
            (8, "http://d.org/?q=1", "short"), (9, "http://d.org/?q=1", "short"), (10, "http://e.org/\r\nX: y", "WARC/1.0\r\nContent-Length: 3\r\n\r\n" * 9), (11, "http://[bad", "é" * 70)]
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index(spark, rows)), key=str)
    first = {5: 3, None: 3}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(i) if h == BODY else None
        want.append((i, len(b), sha(b), "revisit" if to else "response", to))
    assert got == sorted(want, key=str)
    assert index(spark, []) == []


def test_global_order_and_hot_url(spark):
    rnd = random.Random(2)
    rows = [(i, "http://hot.org/" if i % 3 == 0 else f"https://www.s{rnd.randint(0, 40)}.net/{rnd.randint(0, 9)}", f"page {i} " * 30) for i in range(300)]
    path = w.write_archives(spark.createDataFrame(rows, PAGE).repartition(5), archive_bytes=6_000)
    runs = w.index_runs(spark, path)
    assert runs.select("run").distinct().count() > 10
    out = w.merged(runs, merge_rows=40).orderBy("range_no", "pos").collect()
    keys = [w.sort_key(r.urlkey, r.timestamp, r.page_id, r.run, r.seq) for r in out]
    assert len(out) == 300 and keys == sorted(keys)
    assert len({r.range_no for r in out if r.urlkey == w.url_key("http://hot.org/")}) > 1


def test_loser_tree():
    rnd = random.Random(3)
    for k in range(8):
        runs = [sorted(rnd.randint(0, 30) for _ in range(rnd.randint(0, 9))) for _ in range(k)]
        assert list(w.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_bad_archives_are_reported():
    import pytest
    with pytest.raises(ValueError):
        w.parse(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n")
