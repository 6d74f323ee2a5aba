"""Sources and sinks: declared-schema reads, append landing, table/view
materialisation, CSV export."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rankforge.session import checkpoint_dir
from rankforge.sources import as_table, as_view, export_csv, land_append, read_raw
from rankforge.sources.io import latest_landing
from rankforge.sources.schemas import PAGEVIEWS


def _views(spark, n, day):
    return spark.createDataFrame(
        [("wp", f"A{i}", "all", "user", "daily", f"{day}00", i, dt.datetime(2024, 1, 2)) for i in range(n)],
        PAGEVIEWS)


def test_append_landing_and_schema_read(spark, tmp_dir):
    land_append(_views(spark, 3, "20240101"), tmp_dir, "pageviews")
    land_append(_views(spark, 2, "20240102"), tmp_dir, "pageviews")
    df = read_raw(spark, tmp_dir, "pageviews")
    assert df.schema == PAGEVIEWS and df.count() == 5


def test_table_and_view_materialisation(spark, tmp_dir):
    df = _views(spark, 4, "20240101")
    t = as_table(df, os.path.join(tmp_dir, "t"))
    assert t.count() == 4 and t.schema == df.schema
    p = as_table(df, os.path.join(tmp_dir, "p"), partition_by=["timestamp"])
    assert p.where("timestamp = '2024010100'").count() == 4
    as_view(df, "rf_test_view")
    assert spark.sql("select count(*) from rf_test_view").first()[0] == 4


def test_partitioned_table_keeps_schema_and_order(spark, tmp_dir):
    df = spark.createDataFrame([("x", dt.date(2024, 1, 1), "007", 1), ("y", None, "8", 2), ("z", dt.date(2024, 1, 2), None, 3)],
                               "a string, published_date date, code string, b int")
    t = as_table(df, os.path.join(tmp_dir, "t"), partition_by=["published_date", "code"])
    assert t.schema == df.schema
    assert sorted(map(str, t.collect())) == sorted(map(str, df.collect()))


def test_latest_landing_keeps_one_row_a_record(spark):
    df = _views(spark, 3, "20240101")
    later = df.limit(2).withColumn("views", df.views + 10).withColumn("_airbyte_extracted_at", F.lit(dt.datetime(2024, 1, 5)))
    got = {r.article: r.views for r in latest_landing(df.unionByName(later), "pageviews").collect()}
    assert len(got) == 3 and sum(got.values()) == 0 + 1 + 2 + 20


def test_a_cluster_must_name_the_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_export_csv(spark, tmp_dir):
    out = os.path.join(tmp_dir, "csv")
    export_csv(_views(spark, 3, "20240101").select("article", "views"), out, single_file=True)
    parts = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(parts) == 1
    lines = open(os.path.join(out, parts[0])).read().strip().splitlines()
    assert lines[0] == "article,views" and len(lines) == 4


def test_cli_build_and_export(spark, tmp_dir):
    """Land the stand-in raw tables for sf0.001, build with the CLI, export a report and SQL."""
    import glob

    from rankforge.__main__ import main
    from rankforge.sources.standins import derive_raw

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    raw_root = os.path.join(tmp_dir, "raw")
    for name, df in derive_raw(spark, sf).items():
        land_append(df, raw_root, name)
    marts = os.path.join(tmp_dir, "marts")
    assert main(["build", "--raw", raw_root, "--out", marts, "--as-of", "2001-12-31"]) == 0
    assert spark.sql("select count(*) from weekly_scorecard").first()[0] == 4781
    # a week filter on the built wide table prunes its published_date folders
    from rankforge.operators.reports import top_k_for
    plan = top_k_for(spark.table("weekly_scorecard"), 15, "1998-01-05")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(published_date" in plan and "1998-01-05" in plan
    out = os.path.join(tmp_dir, "kpi")
    assert main(["export", "--marts", marts, "--report", "kpi", "--csv", out, "--single-file"]) == 0
    lines = open(glob.glob(os.path.join(out, "*.csv"))[0]).read().splitlines()
    assert lines[0].startswith("published_date,n_books")
    out2 = os.path.join(tmp_dir, "sql")
    main(["export", "--marts", marts, "--csv", out2, "--single-file",
          "--sql", "select published_date, count(*) as n from weekly_scorecard group by 1"])
    assert len(open(glob.glob(os.path.join(out2, "*.csv"))[0]).read().splitlines()) > 300


def test_partitioned_table_writes_few_files_per_value(spark, tmp_dir):
    import glob

    df = spark.range(0, 4000).selectExpr("id", "cast(id % 4 as string) as part").repartition(16)
    as_table(df, os.path.join(tmp_dir, "pt"), partition_by=["part"])
    for v in "0123":
        files = glob.glob(os.path.join(tmp_dir, "pt", f"part={v}", "*.parquet"))
        assert 1 <= len(files) <= 2


def test_raw_tables_are_landed_on_demand(spark):
    """A query that reads one table runs one derivation; each runs once."""
    from rankforge.session import list_names
    from rankforge.sources.standins import Landed

    landed = Landed(spark, "/root/testdata/sf0.001")
    assert landed["ranked_list"] is landed["ranked_list"] and landed["ranked_list"].count() > 0
    assert list_names(spark, landed.dest) == ["ranked_list"]
    assert list_names(spark, landed.all().dest) == sorted(landed) and len(landed) == 4


def test_the_ranked_list_reads_the_lines_once(spark, tmp_dir):
    """Last week's rank comes from the row before, not from a second chart; a gap of two weeks has none."""
    from rankforge.sources.standins import ranked_list

    weeks = {1: ["01", "08", "22"], 2: ["01", "08", "15"], 3: ["08", None]}
    rows = [(p, float(10 * p + (p == 1 and d == "08") * 50), dt.datetime(2024, 1, int(d)) if d else None) for p, ds in weeks.items() for d in ds] + [(None, 5.0, dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "l_partkey long, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(p, f"a b{p}", "x") for p in (1, 2, 3)] + [(3, "a c", "x")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_dir}/part.parquet")
    df = ranked_list(spark, tmp_dir)
    got = {(r.published_date, r.title, r["rank"], r.rank_last_week, r.weeks_on_list) for r in df.collect()}
    assert got == {("2024-01-01", "A B1", 2, 0, 1), ("2024-01-01", "A B2", 1, 0, 1), ("2024-01-08", "A B1", 1, 2, 2), ("2024-01-08", "A B2", 3, 1, 2),
                   ("2024-01-08", "A B3", 2, 0, 1), ("2024-01-08", "A C", 2, 0, 1), ("2024-01-15", "A B2", 1, 3, 3), ("2024-01-22", "A B1", 1, 0, 3),
                   (None, "A B3", 1, 0, 2), (None, "A C", 1, 0, 2)}
    # rows, January's again and second places again: each branch reads the lines and the parts once
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 6
