"""Stand-in raw landing tables derived from the TPC-H-like test tables.

The reference's raw inputs (a weekly ranked list, two catalogue streams with
JSON documents, daily article views) are not part of the test data. These
functions derive tables with exactly the raw schemas from ``lineitem``,
``orders`` and ``part`` with Spark, so every model runs on data whose volume
grows with the test tables:

* ranked list - for each week (Monday of ``l_shipdate``) the 15 parts with
  the most shipped quantity; last week's rank comes from the same chart one
  week earlier, weeks-on-list counts the part's charted weeks so far;
* catalogue, search stream - one volume per (part, supplier) edition;
* catalogue, ISBN stream - one volume per (part, line status);
* page views - line counts per (author article, order day, access).

A part name ``"<adj> <noun>"`` gives the two authors ``"<Adj> Writer"`` and
``"<Noun> Writer"``; the article titles are ``"<Adj>_Writer"``. Volumes name a
third author, one pen name for four parts, so authors grow with the parts and
most have no article.

The tables also hold what real landings hold: missing, empty and blank ISBNs,
unrated volumes, subtitles, two spellings of a name, a page that is no
person's, unreadable timestamps, lists landed again later and rows landed twice
at the same time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.operators.topn import asc, desc, number_in_group, top_k_per_group
from rankforge.sources.schemas import RAW_TABLES

# Fixed values of the derivation.
LIST_SIZE = 15
ISBN_BASE = 9780000000000
ISBN10_BASE = 1000000000


def _tables(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(os.path.join(root, f"{n}.parquet")) for n in names]


def _cap(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def _word(i: int) -> Column:
    return F.split_part(F.col("p_name"), F.lit(" "), F.lit(i))


def _author(i: int) -> Column:
    return F.concat(_cap(_word(i)), F.lit(" Writer"))


def _pen() -> Column:
    """A pen name shared by a few parts, in two spellings; no article is named after it."""
    return F.concat(F.when(F.col("l_partkey") % 2 == 0, F.lit("PEN ")).otherwise(F.lit("Pen ")), _s(F.floor(F.col("l_partkey") / 4).cast("bigint")))


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ranked_list(spark: SparkSession, root: str) -> DataFrame:
    lineitem, part = _tables(spark, root, "lineitem", "part")
    weekly = (lineitem.groupBy(F.to_date(F.date_trunc("week", "l_shipdate")).alias("week_date"),
                               "l_partkey")
                      .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty")))
    chart = top_k_per_group(weekly, ["week_date"], [desc("qty"), asc("l_partkey")], LIST_SIZE,
                            rank_col="rank")
    chart = number_in_group(chart, ["l_partkey"], [asc("week_date")], out="weeks_on_list")
    # A part is once in a week's chart: a week earlier is the row before or none. The same window, so the chart is made once.
    before = Window.partitionBy("l_partkey").orderBy(asc("week_date"))
    chart = chart.withColumn("prev_rank", F.when(F.date_add(F.lag("week_date").over(before), 7) == F.col("week_date"), F.lag("rank").over(before)))
    c = chart.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey", "inner")
    # Lower ranks have gaps: no ISBN, an empty one, or blanks (a book known by its URI alone).
    isbn = (F.when((F.col("rank") == 15) & (F.col("l_partkey") % 4 == 0), F.lit(None))
             .when((F.col("rank") == 14) & (F.col("l_partkey") % 4 == 1), F.lit(""))
             .when((F.col("rank") == 13) & (F.col("l_partkey") % 4 == 2), F.lit("  "))
             .otherwise(_s(F.col("l_partkey") + ISBN_BASE)))
    rows = c.select(
        F.date_format("week_date", "yyyy-MM-dd").alias("published_date"),
        F.concat(F.lit("nyt://book/"), _s("l_partkey")).alias("book_uri"),
        isbn.alias("primary_isbn13"),
        F.upper("p_name").alias("title"),
        F.concat(_author(1), F.lit(" & "), _author(2)).alias("author"),
        F.col("p_brand").alias("publisher"),
        F.col("rank").cast("bigint").alias("rank"),
        F.coalesce(F.col("prev_rank"), F.lit(0)).cast("bigint").alias("rank_last_week"),
        F.col("weeks_on_list").cast("bigint").alias("weeks_on_list"),
        F.concat(F.lit("shop:dp/"), _s("l_partkey")).alias("amazon_product_url"),
        F.concat(F.lit("img/"), _s("l_partkey"), F.lit(".jpg")).alias("book_image"),
        (F.col("week_date").cast("timestamp") + F.expr("INTERVAL 30 HOURS")).alias("_airbyte_extracted_at"),
    )
    # January's lists were landed again two hours later, and every second place twice at once.
    again = rows.where(F.substring("published_date", 6, 2) == "01").withColumn("_airbyte_extracted_at", F.col("_airbyte_extracted_at") + F.expr("INTERVAL 2 HOURS"))
    return rows.unionByName(again).unionByName(rows.where("rank = 2"))


def _volume_json(title: Column, ident13: Column, n: Column, qty: Column, first_ship: Column) -> Column:
    tenths = F.lit(10) + (qty % 41)
    rating = F.concat(_s(F.floor(tenths / 10).cast("bigint")), F.lit("."), _s(tenths % 10))
    pub = F.when(F.col("p_size") < 10, _s(F.year(first_ship))).otherwise(
        F.date_format(first_ship, "yyyy-MM-dd"))
    authors = F.when(F.col("p_type") == "SMALL", F.lit("[]")).otherwise(
        F.concat(F.lit('["'), F.col("author_1"), F.lit('","'), F.col("author_2"), F.lit('","'), _pen(), F.lit('"]')))
    unrated = qty % 7 == 0
    return F.concat(
        F.lit('{"title":"'), title, F.lit('","publisher":"'), F.col("p_brand"),
        F.lit('","publishedDate":"'), pub, F.lit('","language":"en","categories":["'),
        F.col("p_type"), F.lit('"],"averageRating":'), F.when(unrated, F.lit("null")).otherwise(rating),
        F.lit(',"ratingsCount":'), F.when(unrated, F.lit("null")).otherwise(_s(n)),
        F.when(F.col("p_size") >= 30, F.concat(F.lit(',"subtitle":"Volume '), _s("p_size"), F.lit('"'))).otherwise(F.lit("")),
        F.lit(',"authors":'), authors,
        F.lit(',"industryIdentifiers":[{"type":"ISBN_13","identifier":"'), ident13,
        F.lit('"},{"type":"ISBN_10","identifier":"'), _s(F.col("l_partkey") + ISBN10_BASE),
        F.lit('"}]}'))


def _catalogue(spark: SparkSession, root: str, grain: str, id_prefix: str) -> DataFrame:
    lineitem, part = _tables(spark, root, "lineitem", "part")
    ed = (lineitem.groupBy("l_partkey", grain)
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
                       F.min("l_shipdate").alias("first_ship"),
                       F.max("l_shipdate").alias("last_ship"))
                  .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size",
                                    _author(1).alias("author_1"), _author(2).alias("author_2")), "l_partkey", "inner"))  # names are cut once for a part
    vid = F.concat(F.lit(id_prefix), _s("l_partkey"), F.lit("-"), _s(grain))
    if grain == "l_suppkey":
        ident13 = F.when(F.col("l_suppkey") % 3 == 0, _s(F.col("l_partkey") + (ISBN_BASE + 1))) \
                   .otherwise(_s(F.col("l_partkey") + ISBN_BASE))
        ebook = F.when(F.col("l_suppkey") % 2 == 0, F.lit("true")).otherwise(F.lit("false"))
        title = F.col("p_name")
    else:
        ident13 = _s(F.col("l_partkey") + ISBN_BASE)
        ebook = F.when(F.col(grain) == "O", F.lit("true")).otherwise(F.lit("false"))
        title = F.concat(F.upper("p_name"), F.lit(" ("), F.col(grain), F.lit(")"))
    return ed.select(
        (F.col("l_partkey") + ISBN_BASE).cast("decimal(38,9)").alias("isbn13"),
        vid.alias("id"),
        F.concat(F.lit("volumes/"), vid).alias("selflink"),
        F.col("last_ship").alias("_airbyte_extracted_at"),
        _volume_json(title, ident13, F.col("n"), F.col("qty"), F.col("first_ship")).alias("volumeinfo"),
        F.concat(F.lit('{"isEbook":'), ebook, F.lit("}")).alias("saleinfo"),
        F.lit('{"viewability":"NO_PAGES"}').alias("accessinfo"),
        F.concat(F.lit('{"textSnippet":"'), F.col("p_type"), F.lit('"}')).alias("searchinfo"),
    )


def catalogue_search(spark: SparkSession, root: str) -> DataFrame:
    return _catalogue(spark, root, "l_suppkey", "s")


def catalogue_isbn(spark: SparkSession, root: str) -> DataFrame:
    return _catalogue(spark, root, "l_linestatus", "i")


def pageviews(spark: SparkSession, root: str) -> DataFrame:
    lineitem, orders, part = _tables(spark, root, "lineitem", "orders", "part")
    lo = (lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
                  .join(orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                      F.to_date("o_orderdate").alias("day")), "l_orderkey")
                  .join(part.select(F.col("p_partkey").alias("l_partkey"), F.array(_word(1), _word(2)).alias("words")), "l_partkey"))
    lo = lo.select(
        # Line 7 stands for traffic on a page that is no person's.
        F.explode(F.when(F.col("l_linenumber") == 7, F.array(F.lit(""))).otherwise(F.col("words"))).alias("w"), "day",
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("desktop")).otherwise(F.lit("mobile-web")).alias("access"))
    v = lo.groupBy("w", "day", "access").agg(F.count(F.lit(1)).alias("views"))
    return v.select(
        F.lit("en.wikipedia").alias("project"),
        F.when(F.col("w") == "", F.lit("_")).otherwise(F.concat(_cap(F.col("w")), F.lit("_Writer"))).alias("article"),
        "access",
        F.lit("user").alias("agent"),
        F.lit("daily").alias("granularity"),
        F.when(F.dayofmonth("day") == 31, F.lit("n/a")).otherwise(F.concat(F.date_format("day", "yyyyMMdd"), F.lit("00"))).alias("timestamp"),
        F.col("views").cast("bigint").alias("views"),
        (F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("_airbyte_extracted_at"),
    )


def derive_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All four raw tables, keyed like :data:`RAW_TABLES`."""
    raw = {
        "ranked_list": ranked_list(spark, root),
        "catalogue_search": catalogue_search(spark, root),
        "catalogue_isbn": catalogue_isbn(spark, root),
        "pageviews": pageviews(spark, root),
    }
    return {k: df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_TABLES[k].fields])
            for k, df in raw.items()}


class Landed(Mapping):
    """The stand-in raw tables of one test-data folder by name, each landed when it is first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        from rankforge.session import checkpoint_dir

        self._spark, self.dest = spark, os.path.join(checkpoint_dir(spark), f"landing-{uuid.uuid4().hex[:12]}")
        self._derived, self._read = derive_raw(spark, root), {}
        self._each = {n: Lock() for n in RAW_TABLES}

    def __getitem__(self, name: str) -> DataFrame:
        from rankforge.sources.io import read_raw

        with self._each[name]:
            if name not in self._read:
                self._derived[name].write.mode("overwrite").parquet(os.path.join(self.dest, name))
                self._read[name] = read_raw(self._spark, self.dest, name)
        return self._read[name]

    def __iter__(self):
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)

    def all(self) -> Landed:
        """Land what is missing; the derivations are independent jobs, submitted together."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(self.__getitem__, self))
        return self


_LANDED: dict[tuple[str, str], Landed] = {}


def landed_raw(spark: SparkSession, root: str) -> Landed:
    """The stand-in raw tables, each landed once per session and test-data folder.

    Like the real landing tables, they are written once (Parquet, under the
    session's shared checkpoint folder) and every model run scans them; the
    first query that reads a table runs its derivation, and those of tables
    that no query reads never run.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(root))
    if key not in _LANDED:
        _LANDED[key] = Landed(spark, root)
    return _LANDED[key]


def landed_root(spark: SparkSession, root: str) -> str:
    """The folder that :func:`landed_raw` landed the tables in; all of them are landed."""
    return landed_raw(spark, root).all().dest
