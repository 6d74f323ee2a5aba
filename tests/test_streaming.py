"""Append-only landing stream: each new file lands exactly once."""

import datetime as dt
import os

from rankforge.sources import land_append, read_raw
from rankforge.sources.schemas import PAGEVIEWS
from rankforge.streaming import land_available


def _batch(spark, path, day, n):
    rows = [("wp", f"A{i}", "all", "user", "daily", f"{day}00", i, dt.datetime(2024, 1, 2))
            for i in range(n)]
    spark.createDataFrame(rows, PAGEVIEWS).coalesce(1).write.mode("append").parquet(path)


def test_landing_appends_new_files_once(spark, tmp_dir):
    src, land, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "landing", "ckpt"))
    _batch(spark, src, "20240101", 3)
    land_available(spark, src, "pageviews", land, checkpoint=ckpt)
    assert read_raw(spark, land, "pageviews").count() == 3
    # nothing new: a rerun lands nothing
    land_available(spark, src, "pageviews", land, checkpoint=ckpt)
    assert read_raw(spark, land, "pageviews").count() == 3
    # a second extraction run appends only its own rows
    _batch(spark, src, "20240102", 2)
    land_available(spark, src, "pageviews", land, checkpoint=ckpt)
    df = read_raw(spark, land, "pageviews")
    assert df.count() == 5
    assert sorted(r[0] for r in df.select("timestamp").distinct().collect()) == ["2024010100", "2024010200"]


def test_streams_and_batch_appends_share_a_table(spark, tmp_dir):
    src, land, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "landing", "ckpt"))
    _batch(spark, src, "20240101", 3)
    land_available(spark, src, "pageviews", land, checkpoint=ckpt)
    land_append(spark.read.schema(PAGEVIEWS).parquet(src).limit(2), land, "pageviews")
    assert read_raw(spark, land, "pageviews").count() == 5
    _batch(spark, src, "20240102", 4)
    land_available(spark, src, "pageviews", land, checkpoint=ckpt)
    df = read_raw(spark, land, "pageviews")
    assert df.count() == 9 and df.schema == PAGEVIEWS
