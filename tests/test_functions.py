"""Column functions, one test per semantic trap (T1-T5, T9) and the helpers."""

import datetime as dt

from pyspark.sql import functions as F

from rankforge import functions as RF


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_t1_name_normalisation_keeps_inner_whitespace(spark):
    assert one_col(spark, ["  A   B  "], RF.normalize_name) == ["a   b"]
    assert one_col(spark, ["  A   B  "], lambda c: RF.normalize_name(c, collapse_ws=True)) == ["a b"]


def test_t1_decimal_suffix_kept_unless_asked(spark):
    assert one_col(spark, ["9780000000001.0"], RF.clean_isbn_text) == ["9780000000001.0"]
    assert one_col(spark, ["9780000000001.00"], lambda c: RF.clean_isbn_text(c, True)) == ["9780000000001"]


def test_t2_safe_date_needs_three_parts(spark):
    got = one_col(spark, ["2021", "2021-05", "2021-05-06", "2021-5-6", "2021/05/06", " 2021-05-06",
                          "garbage", None], RF.safe_date)
    d = dt.date(2021, 5, 6)
    assert got == [None, None, d, d, d, d, None, None]


def test_t3_safe_long_rounds_and_accepts_exponents(spark):
    got = one_col(spark, ["4.5", "-2.5", "1e3", "12", "99999999999999999999", "x", None], RF.safe_long)
    assert got == [5, -3, 1000, 12, None, None, None]
    assert one_col(spark, ["3000000000", "7"], RF.safe_int) == [None, 7]


def test_t4_trim_strips_unicode_spaces_not_tabs(spark):
    got = one_col(spark, [" x ", " x ", "\tx\t", " x"], RF.zs_trim)
    assert got == ["x", "x", "\tx\t", "x"]
    assert one_col(spark, ["  ", "", "a"], RF.trimmed_or_null) == [None, None, "a"]
    assert one_col(spark, ["", " ", "a"], RF.blank_to_null) == [None, " ", "a"]


def test_t5_decimal_to_text_rounds(spark):
    df = spark.createDataFrame([("9780000000001.500000000",), ("9780000000001.000000000",), (None,)],
                               "x string").select(F.col("x").cast("decimal(38,9)").alias("x"))
    assert [r[0] for r in df.select(RF.decimal_to_text("x")).collect()] == [
        "9780000000002", "9780000000001", None]


def test_yyyymmdd_to_date(spark):
    got = one_col(spark, ["2024022900", "2024023000", "abc", "20240101"], RF.yyyymmdd_to_date)
    assert got == [dt.date(2024, 2, 29), None, None, dt.date(2024, 1, 1)]


def test_date_key_and_back(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], "d date")
    r = df.select(RF.date_key("d").alias("k")).select("k", RF.date_from_key("k").alias("d")).first()
    assert r.k == 20240309 and r.d == dt.date(2024, 3, 9)


def test_freshest_treats_missing_as_epoch(spark):
    df = spark.createDataFrame([(None, None), (dt.datetime(2020, 1, 1), None)], "a timestamp, b timestamp")
    got = [r[0] for r in df.select(RF.freshest("a", "b")).collect()]
    assert got == [dt.datetime(1970, 1, 1), dt.datetime(2020, 1, 1)]


def test_json_helpers(spark):
    docs = ['{"industryIdentifiers":[{"type":"ISBN_10","identifier":"1"},'
            '{"type":"ISBN_13","identifier":"978"}],"authors":["A","B"]}',
            '{"industryIdentifiers":[{"type":"ISBN_10","identifier":"978"}],"authors":[]}',
            '{"title":"x"}', "not json"]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    m = [r[0] for r in df.select(RF.json_array_contains(
        "j", "industryIdentifiers", {"type": "ISBN_13", "identifier": F.lit("978")})).collect()]
    assert m == [True, False, False, False]
    a = [r[0] for r in df.select(RF.json_list_as_csv("j", "$.authors")).collect()]
    assert a == ["A,B", "", None, None]
    f = [r[0] for r in spark.createDataFrame([('{"isEbook":true}',), ('{"isEbook":"TRUE"}',), ("{}",)], "j string")
         .select(RF.json_flag_true("j", "$.isEbook")).collect()]
    assert f == [1, 1, 0]


def test_md5_key_is_hex(spark):
    assert one_col(spark, ["abc"], RF.md5_key) == ["900150983cd24fb0d6963f7d28e17f72"]


def test_long_radix_text_is_null_not_an_error(spark):
    """Hex and binary text of any length: a value where it fits, else NULL."""
    texts = ["0x1FFFFFFFFFFFFFFFFFF", "0b" + "1" * 70, "0x" + "0" * 40 + "1F", "0b" + "0" * 80 + "101", "0x7FFFFFFFFFFFFFFF",
             "0xFFFFFFFFFFFFFFFF", "0b" + "1" * 64, "0x" + "F" * 5000, "9" * 60, "1_000", "0x0", "0x1_F"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", RF.safe_long("t").alias("v")).orderBy("i").collect()]
    assert got == [None, None, 31, 5, 2**63 - 1, None, None, None, None, 1000, 0, 31]


def test_integral_columns_are_not_cast_through_text(spark):
    df = spark.createDataFrame([(5, "0x1F")], "views long, t string")
    plan = df.select(RF.long_of(df, "views").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "string" not in plan and "RLIKE" not in plan
    assert df.select(RF.long_of(df, "t").alias("v"), RF.int_of(df, "views").alias("w")).first() == (31, 5)


def test_identifier_lists_are_told_by_text_or_parsed(spark):
    """Plain lists by their text, all others parsed: the same answers as parsing each."""
    texts = ['[{"type":"ISBN_13","identifier":"97"}]', '[{"type":"ISBN_10","identifier":"1"},{"type":"ISBN_13","identifier":"97"}]',
             '[{"identifier":"97","type":"ISBN_13"}]', '[{"type":"ISBN_13","identifier":97}]', '[{"type":"ISBN_13","identifier":"9\\u0037"}]',
             '[{"type":"ISBN_13","identifier":"978"}]', '[{"type":"ISBN_13","identifier":"1","identifier":"97"}]', '[{"x":{"type":"ISBN_13","identifier":"97"}}]',
             '[{"type":"ISBN_13","identifier":"97","x":1}]', '["{\\"type\\":\\"ISBN_13\\",\\"identifier\\":\\"97\\"}"]', '[]', '[null]', 'x', '{"type":"ISBN_13","identifier":"97"}', '', None,
             '[{"type":"ISBN_13","identifier":"97"},]', '[{"type":"ISBN_13","identifier":"97"}{"type":"ISBN_13","identifier":"97"}]', '[{"type":"a\tb","identifier":"1"},{"type":"ISBN_13","identifier":"97"}]',
             '[{"type":"ISBN_13","identifier":"97"}]\n', "[" + ",".join(['{"type":"OTHER","identifier":"1"}'] * 5000 + ['{"type":"ISBN_13","identifier":"97"}']) + "]"]
    df = spark.createDataFrame([(t, i) for t in texts for i in ("97", None, 'a"b')], "t string, i string")
    want = {"type": "ISBN_13", "identifier": F.col("i")}
    got = df.select(RF.list_contains("t", want).alias("told"), RF.array_has_struct(RF.list_objects("t", list(want)), want).alias("parsed"), "i").collect()
    assert [r.told for r in got] == [r.parsed for r in got]
    assert sum(r.told for r in got) == 8


def test_first_texts_are_told_by_text_or_parsed(spark):
    texts = ['["a"]', '["a","b"]', '["",2]', '[""]', '["a\\"b"]', '["a\\u0062"]', '["a","b\\n"]', '["a",]', '["a"', '["a"x]', '["a"]\n', '["a\tb"]', '[null,"a"]', '[1]', '[["a"]]', '{"a":1}', '[]', '', 'x', None,
             '["a"] x', ' ["a"]', "[" + ",".join(['"a"'] * 5000) + "]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(RF.first_text("t").alias("told"), F.try_element_at(RF.list_texts("t"), F.lit(1)).alias("parsed"), "t").collect()
    assert [(r.t, r.told) for r in got] == [(r.t, r.parsed) for r in got]
    assert sum(r.told == "a" for r in got) >= 3


def test_the_date_cast_is_compiled(spark):
    """A method of more than 8000 bytes is never compiled by the JVM: every row of it is interpreted."""
    import re

    df = spark.range(5).selectExpr("cast(id as string) as t").repartition(2).select(RF.safe_date("t").alias("d")).sort("d")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000
