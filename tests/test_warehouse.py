"""Committed versions, layouts, checks while writing, views of later sessions, repeatable landing."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from rankforge.operators.quality import run_checks
from rankforge.plans.checks import DECLARED_CHECKS
from rankforge.plans.graph import ModelGraph, build
from rankforge.sources import land_append, read_raw
from rankforge.sources.io import landed_batches
from rankforge.sources.standins import landed_raw, landed_root
from rankforge.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def put(spark, root, rows, **kw):
    """One build of a warehouse with one table."""
    w = Warehouse(spark, root)
    version = w.begin()
    df, entry, _ = w.write(version, "t", spark.createDataFrame(rows, "k long, v string"), **kw)
    w.commit(version, {"t": entry})
    return df


def test_a_reader_during_a_rebuild_sees_the_old_table_whole(spark, tmp_dir):
    put(spark, tmp_dir, [(i, "old") for i in range(50)])
    w = Warehouse(spark, tmp_dir)
    reader = w.tables()["t"]
    version = w.begin()
    w.write(version, "t", spark.createDataFrame([(1, "new")], "k long, v string"))  # written, not committed
    assert {r.v for r in reader.collect()} == {"old"} and Warehouse(spark, tmp_dir).tables()["t"].count() == 50
    put(spark, tmp_dir, [(1, "new")])
    assert reader.count() == 50  # a reader keeps its version
    assert [tuple(r) for r in Warehouse(spark, tmp_dir).tables()["t"].collect()] == [(1, "new")]


def test_a_failed_rebuild_changes_nothing(spark, tmp_dir):
    put(spark, tmp_dir, [(1, "old")])
    w = Warehouse(spark, tmp_dir)
    before = w.current()
    bad = spark.range(5).select(F.col("id").alias("k"), F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise("x").cast("string").alias("v"))
    with pytest.raises(Exception):
        w.write(w.begin(), "t", bad)
    assert w.current() == before and [tuple(r) for r in w.tables()["t"].collect()] == [(1, "old")]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_dir):
    for v in "abc":
        put(spark, tmp_dir, [(1, v)])
    w = Warehouse(spark, tmp_dir)
    w.create_view("both", "select v, count(*) as n from t group by v")  # a commit that shares the tables of "c"
    running = w.begin()
    w.write(running, "t", spark.createDataFrame([(1, "under way")], "k long, v string"))
    assert len(w.vacuum(keep=2)) == 2 and len(w.commits()) == 2
    assert [r.v for r in w.tables()["t"].collect()] == ["c"]
    assert os.path.isdir(os.path.join(tmp_dir, "t", running))  # not committed: not touched
    assert Warehouse(spark, os.path.join(tmp_dir, "none")).tables() == {}


def test_buckets_need_no_shuffle_by_their_key(spark, tmp_dir):
    w = Warehouse(spark, tmp_dir)
    version, entries = w.begin(), {}
    for name, n in (("a", 500), ("b", 300)):
        df = spark.range(n).selectExpr("id % 40 as k", f"concat('{name}', id) as v")
        _, entries[name], _ = w.write(version, name, df, bucket_by=["k"], buckets=4)
    w.commit(version, entries)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        later = spark.newSession()
        later.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for s in (spark, later):
            t = Warehouse(s, tmp_dir).attach()
            joined = t["a"].join(t["b"], "k")
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            groups = t["a"].groupBy("k").count()
            assert "Exchange" not in groups._jdf.queryExecution().executedPlan().toString()
            assert groups.count() == 40 and joined.count() == sum((500 // 40 + (k < 500 % 40)) * (300 // 40 + (k < 300 % 40)) for k in range(40))
        assert len(glob.glob(os.path.join(tmp_dir, "a", version, "*.parquet"))) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_sorted_tables_read_back_in_order(spark, tmp_dir):
    df = spark.range(3000).selectExpr("(id * 7919) % 3000 as k", "'x' as v").repartition(7)
    w = Warehouse(spark, tmp_dir)
    out, _, _ = w.write(w.begin(), "t", df, sort_by=["k"])
    assert [r.k for r in out.collect()] == list(range(3000))
    for f in glob.glob(os.path.join(tmp_dir, "t", "*", "*.parquet")):
        ks = [r.k for r in spark.read.parquet(f).collect()]
        assert ks == sorted(ks)


@needs_data
def test_checks_are_taken_while_writing(spark, tmp_dir):
    """The 55 rows are those of checks that scan the tables, and no table is scanned for a check of single rows."""
    graph = ModelGraph(landed_raw(spark, SF), as_of="2001-12-31")
    models, summary = build(graph, out_root=tmp_dir, materialize_all=True)
    graph.release()
    scanned = run_checks(models, DECLARED_CHECKS)
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, scanned.collect())) and summary.count() == 55
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    local = {c.model for c in DECLARED_CHECKS if c.kind not in ("unique", "compound_unique", "relationships")}
    assert count(summary) == count(scanned) - len(local)
    dates = [r.date_day for r in Warehouse(spark, tmp_dir).tables()["dim_date"].select("date_day").collect()]
    assert dates == sorted(dates) and len(dates) > 365
    # the scorecard's joins and unique checks on keys: no shuffle by book
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unique = models["dim_book"].groupBy("book_key").count()._jdf.queryExecution().executedPlan().toString()
        joined = models["fct_weekly_rank"].join(models["dim_book"], "book_key")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in unique and "Exchange" not in joined
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


@needs_data
def test_failing_checks_can_keep_a_version_back(spark, tmp_dir):
    graph = ModelGraph(landed_raw(spark, SF), as_of="2001-12-31")
    few = [c for c in DECLARED_CHECKS if c.name == "row_count_stg_volumes_search"]
    strict = [type(few[0])(few[0].name, few[0].model, few[0].kind, {"min": 10 ** 9})]
    _, summary = build(graph, out_root=tmp_dir, checks=strict, commit_failed=False)
    assert summary.first().status == "FAIL" and Warehouse(spark, tmp_dir).current() is None
    graph.release()


@needs_data
def test_views_of_a_later_session(spark, tmp_dir):
    """Staging and intermediate models and stored SQL, through the command line."""
    from rankforge.__main__ import main

    raw, marts = landed_root(spark, SF), os.path.join(tmp_dir, "marts")
    assert main(["build", "--raw", raw, "--out", marts, "--as-of", "2001-12-31"]) == 0
    assert main(["view", "--marts", marts, "--name", "named_books", "--sql", "select book_key, count(*) as n from author_parse group by book_key"]) == 0
    for name in spark.catalog.listTables():
        if name.isTemporary:
            spark.catalog.dropTempView(name.name)
    out = os.path.join(tmp_dir, "out")
    main(["export", "--marts", marts, "--csv", out, "--single-file", "--sql",
          "select 'stg' as what, count(*) as n from stg_pageviews union all select 'map', count(*) from wiki_author_map "
          "union all select 'stored', sum(n) from named_books union all select 'parse', count(*) from author_parse"])
    got = dict(line.split(",") for line in open(glob.glob(os.path.join(out, "*.csv"))[0]).read().split()[1:])
    g = ModelGraph(landed_raw(spark, SF), as_of="2001-12-31")
    assert got["stg"] == str(g["stg_pageviews"].count()) and got["map"] == str(g["wiki_author_map"].count())
    assert got["stored"] == got["parse"] == str(g["author_parse"].count())
    g.release()


def test_a_repeated_batch_lands_once(spark, tmp_dir):
    from rankforge.sources.schemas import RAW_TABLES

    schema = RAW_TABLES["pageviews"]

    def batch(n, day):
        return spark.createDataFrame([("en", f"A{i}", "desktop", "user", "daily", day, 1, None) for i in range(n)], schema)

    assert land_append(batch(3, "20240101"), tmp_dir, "pageviews", batch_id="2024-01-01")
    assert not land_append(batch(3, "20240101"), tmp_dir, "pageviews", batch_id="2024-01-01")
    assert read_raw(spark, tmp_dir, "pageviews").count() == 3
    # A batch that failed before its marker: its folder is replaced.
    os.remove(os.path.join(tmp_dir, "pageviews", "_batches", "2024-01-01"))
    assert land_append(batch(4, "20240101"), tmp_dir, "pageviews", batch_id="2024-01-01")
    assert land_append(batch(2, "20240102"), tmp_dir, "pageviews", batch_id="2024-01-02")
    assert land_append(batch(2, "20240103"), tmp_dir, "pageviews")  # without an id: as before
    assert land_append(batch(2, "20240103"), tmp_dir, "pageviews")
    assert read_raw(spark, tmp_dir, "pageviews").count() == 4 + 2 + 4
    assert landed_batches(spark, tmp_dir, "pageviews") == ["2024-01-01", "2024-01-02"]
    with pytest.raises(ValueError):
        land_append(batch(1, "x"), tmp_dir, "pageviews", batch_id="../x")


def test_malformed_documents_are_caught(spark):
    from rankforge.operators.quality import Check, failing_rows
    from rankforge.plans.staging import malformed_volumes, stg_volumes
    from rankforge.sources.schemas import RAW_TABLES

    docs = ['{"title":"a","title":"b"}', '{"title":"c"', None, "[1]", ""]
    raw = spark.createDataFrame([(None, str(i), None, None, d, None, None, None) for i, d in enumerate(docs)], "isbn13 decimal(38,9), id string, selflink string, _airbyte_extracted_at timestamp, volumeinfo string, saleinfo string, accessinfo string, searchinfo string")
    assert set(raw.columns) == set(RAW_TABLES["catalogue_search"].fieldNames())
    assert sorted(r.gbooks_id for r in malformed_volumes(raw).collect()) == ["1", "4"]
    assert [r.title for r in stg_volumes(raw).orderBy("gbooks_id").collect()] == ["a", None, None, None, None]
    with pytest.raises(Exception, match="malformed document"):
        stg_volumes(raw, "fail").collect()
    ch = Check("json_docs", "t", "json", {"col": "volumeinfo"})
    assert failing_rows({"t": raw}, ch).count() == 2
    assert run_checks({"t": raw}, [ch]).first().failures == 2


def test_written_volumes_are_parsed_once(spark, tmp_dir):
    """What the parse told about a volume's ISBN is kept beside the table: ranking reads no identifier list again, and the table doesn't show it."""
    import datetime as dt
    from decimal import Decimal

    from rankforge.sources.schemas import RAW_TABLES

    def volume(i, ident):
        return (Decimal(9780000000000 + i % 3), f"v{i}", "s", dt.datetime(2024, 1, 1 + i), f'{{"title":"t","ratingsCount":{i},"industryIdentifiers":[{{"type":"ISBN_13","identifier":"{ident}"}}]}}', "{}", "{}", "{}")

    rows = [volume(i, 9780000000000 + i % 3 if i < 4 else "x") for i in range(9)]
    raw = {n: spark.createDataFrame(rows if n == "catalogue_search" else [], s) for n, s in RAW_TABLES.items()}
    want = sorted(map(str, ModelGraph(raw, as_of="2024-03-01")["best_volume_search"].collect()))
    g = ModelGraph(raw, as_of="2024-03-01")
    models, _ = build(g, out_root=tmp_dir, materialize_all=True, checks=[])
    ranked = g.best_volume_search  # not the written one
    assert "from_json" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "has_isbn_match" not in models["stg_volumes_search"].columns + Warehouse(spark, tmp_dir).tables()["stg_volumes_search"].columns
    assert sorted(map(str, ranked.collect())) == want == sorted(map(str, models["best_volume_search"].collect()))
    assert {"v0", "v1", "v2"} & {r.gbooks_id for r in ranked.collect()}
