import random

from pyspark.sql import functions as F

import corpus_pipeline as p
from rankforge.llm import queries
from tests.llm.helpers import CLASH, awkward, docs, prose


def test_registered():
    import __spark_entry__ as e
    names = set(e.queries())
    assert {*queries.QUERIES, "pipeline"} <= names and set(queries.ORACLES) <= set(e.oracle_sql())
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "mix"]


def test_stages_one_by_one(spark, tmp_dir):
    rnd = random.Random(1)
    item = prose(rnd, 40)
    labels = []
    rows = [(i, prose(rnd, 80), "en", "a" if i % 3 else "b") for i in range(60)]
    for i in range(60, 90):
        rows.append((i, prose(rnd, 40) + " vilex nastyo vilex grubby " * 3 + prose(rnd, 40)))
    labels = [(i, 1, int(i >= 60)) for i in range(90)]
    rows += [(200, rows[1][1]), (201, rows[2][1] + " more"), (202, prose(rnd, 10) + " " + item + " " + prose(rnd, 10)), (203, prose(rnd, 50) + " password = hunter2222 " + prose(rnd, 50))]
    rows += [(i and 300 + i, t) for i, t in awkward(7) if i is None or i >= 30 and i != 37]
    df = docs(spark, rows, extra=False)
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")

    kept = p.toxicity(spark, df, tmp_dir).cache()
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns and len(ids & set(range(60, 90))) <= 3 and set(range(60)) <= ids
    one = p.near_duplicates(spark, df, tmp_dir).cache()
    ids = [r.doc_id for r in one.collect()]
    assert one.columns == df.columns and 1 in ids and 200 not in ids and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert 330 in ids and 331 not in ids and ids.count(None) == 0 and len({333, 334, 335} & set(ids)) == 1
    clean = p.decontamination(spark, df, tmp_dir)
    assert clean.columns == df.columns and {r.doc_id for r in df.collect()} - {r.doc_id for r in clean.collect()} == {202}
    masked = {r.doc_id: r for r in p.secrets(spark, df, tmp_dir).collect()}
    assert "hunter" not in masked[203].text and len(masked[203].text) == masked[203].n_chars and masked[1].text == rows[1][1]
    out = p.run(spark, tmp_dir).collect()
    ids = {r.doc_id for r in out}
    assert not ids & {200, 202} and len(ids & set(range(60, 90))) <= 3
    assert abs(sum(r.taken for r in out) - 1.5 * sum(r["size"] for r in out)) < 200


def test_extra_columns_under_any_names(spark, tmp_dir):
    rnd = random.Random(2)
    names = (*CLASH, "evidence", "_found", "_norm", "_digest", "_more", "found", "norm", "_rf_id", "_rf_text", "_rf_leaks", "_rf_blob", "_rf_found", "c0", "k0", "_h", "u", "copies", "taken", "rank", "todo", "have", "a.b")
    rows = [(i, prose(rnd, 60), "en", "a" if i % 3 else None) for i in range(40)] + [(None, None), (50, "token: abcdef123"), (50, "token: abcdef123")]
    df = docs(spark, rows).withColumns({c: F.lit(c) for c in names})
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x")).write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").withColumn("leaks", F.lit(1)).write.parquet(f"{tmp_dir}/benchmark.parquet")
    for name, stage in p.STAGES:
        out = stage(spark, df, tmp_dir)
        got = out.collect()
        if name != "mix":
            assert out.columns == df.columns and all(r["a.b"] == "a.b" and r["_found"] == "_found" and r["c0"] == "c0" for r in got)
    assert p.run(spark, tmp_dir).columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]


def test_empty_corpus(spark, tmp_dir):
    docs(spark, [], extra=False).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert p.run(spark, tmp_dir).collect() == []
