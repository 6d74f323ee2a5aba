"""Marts: dimensions, bridge, facts and the wide weekly scorecard."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import (
    clean_isbn_text, date_from_key, date_key, freshest, md5_key, total, trimmed_or_null,
)
from rankforge.operators.bridge import build_bridge, places, rollup_over_bridge
from rankforge.operators.calendar import calendar, week_dimension
from rankforge.operators.joins import join_first_available
from rankforge.operators.ranking import rank_change_columns
from rankforge.operators.topn import asc, desc, latest_per_key
from rankforge.operators.windows import trailing_window_sum
from rankforge.plans.intermediate import with_article_author_key

# ---------------------------------------------------------------- dimensions


def dim_author(parsed: DataFrame, wiki_map: DataFrame) -> DataFrame:
    """One row per normalised author name, from bylines and article titles.

    Preference: a wiki article exists; a raw byline name exists; longer raw
    name; greater article text; greater raw name. Because the two sources
    fill disjoint columns, a name resolved to an article keeps no raw name.
    """
    books = (parsed.where(F.col("author_name_norm").isNotNull())
                   .select("author_name_norm", "author_name_raw",
                           F.lit(None).cast("string").alias("wiki_article")))
    wiki = (wiki_map.where(F.col("author_name_norm").isNotNull())
                    .select("author_name_norm", F.lit(None).cast("string").alias("author_name_raw"),
                            "wiki_article"))
    # Book rows never carry an article and article rows never carry a raw
    # name, so the preferred row is: the greatest article if the name has
    # one, else the raw name with the greatest (length, text). That is one
    # grouped max per name - partial aggregation map-side, no sort - and the
    # same row the ordered preference picks.
    raw = F.col("author_name_raw")
    best = (books.unionByName(wiki).groupBy("author_name_norm").agg(
        F.max("wiki_article").alias("wiki_article"),
        F.max(F.when(raw.isNotNull(), F.struct(F.length(raw).alias("n"), raw.alias("raw"))))
         .alias("__raw")))
    return best.select(md5_key("author_name_norm").alias("author_key"), "author_name_norm",
                       F.when(F.col("wiki_article").isNull(), F.col("__raw.raw")).alias("author_name_raw"),
                       "wiki_article",
                       F.col("wiki_article").isNotNull().alias("is_wiki_resolved"))


def latest_list_row(stg_list: DataFrame, strip_decimal: bool = False) -> DataFrame:
    """The latest list row per book natural key (ISBN text as listed, else URI)."""
    nyt = stg_list.select(
        clean_isbn_text("isbn13", strip_decimal).alias("nyt_isbn"),
        F.col("book_uri").alias("nyt_uri"), "published_date", "title_nyt",
        "publisher_nyt", "amazon_product_url", "book_image",
        F.col("extracted_at").alias("nyt_extracted_at"))
    nk = F.coalesce(F.nullif("nyt_isbn", F.lit("")), F.nullif("nyt_uri", F.lit("")))
    # Tie-breakers after the two listed keys make the winner deterministic.
    return latest_per_key(nyt, [nk], "nyt_extracted_at",
                          [desc("published_date"), asc("nyt_isbn"), asc("nyt_uri"), asc("title_nyt")])


def dim_book(keys: DataFrame, best_isbn: DataFrame, best_search: DataFrame,
             stg_list: DataFrame, strip_decimal: bool = False) -> DataFrame:
    """One row per book key with precedence-merged attributes.

    Title and publisher: list first, then the ISBN catalogue stream; ids and
    links from the ISBN stream; ratings from the search stream;
    ``extracted_at`` is the freshest of the three sources. The latest list
    row is matched on ISBN, or - for keys without an ISBN - on the URI.
    """
    gbi = best_isbn.select(F.col("isbn13_clean").alias("__gbi_isbn"), "gbooks_id",
                           "gbooks_selflink", F.col("title").alias("title_gb"), "subtitle",
                           F.col("publisher").alias("publisher_gb"), "language", "category_1",
                           F.col("extracted_at").alias("extracted_at_gb"))
    gbs = best_search.select(F.col("isbn13_clean").alias("__gbs_isbn"), "average_rating",
                             "ratings_count", F.col("extracted_at").alias("extracted_at_ratings"))
    nyt = latest_list_row(stg_list, strip_decimal)
    k = (keys.join(gbi, keys["isbn13_clean"] == gbi["__gbi_isbn"], "left")
             .join(gbs, keys["isbn13_clean"] == gbs["__gbs_isbn"], "left"))
    j = join_first_available(k, nyt, [("isbn13_clean", "nyt_isbn"), ("book_uri", "nyt_uri")])
    return j.select(
        "book_key", "book_nk", "isbn13_clean", "book_uri",
        F.coalesce("title_nyt", "title_gb").alias("title"),
        "title_nyt", "title_gb", "subtitle",
        F.coalesce("publisher_nyt", "publisher_gb").alias("publisher"),
        "publisher_nyt", "publisher_gb", "language", "category_1", "average_rating",
        "ratings_count", "gbooks_id", "gbooks_selflink", "amazon_product_url", "book_image",
        freshest("extracted_at_gb", "extracted_at_ratings", "nyt_extracted_at").alias("extracted_at"),
    )


def dim_week(stg_list: DataFrame) -> DataFrame:
    """One row per list date: ``week_key, week_date, year, month``."""
    return week_dimension(stg_list, "published_date")


def dim_date(stg_views: DataFrame, stg_list: DataFrame, snapshot: DataFrame,
             as_of: str | _dt.date) -> DataFrame:
    """Day calendar spanning views, list dates and snapshots, to ``as_of`` + 2.

    Start: earliest view or list date (``as_of`` when a source is empty).
    End: latest view date, snapshot date or ``as_of``, plus two days. List
    dates do not extend the end. ``as_of`` replaces "today" so results are
    reproducible.
    """
    today = F.lit(str(as_of)).cast("date")
    # One aggregation over the three date sources tagged by origin (each
    # source's min/max stays separate, so an empty source still falls back
    # to ``as_of``): a single one-row result, no joins between aggregates.
    tagged = (stg_views.select(F.lit("v").alias("src"), F.col("view_date").alias("d"))
              .unionByName(stg_list.select(F.lit("l").alias("src"), F.col("published_date").alias("d")))
              .unionByName(snapshot.select(
                  F.lit("s").alias("src"),
                  F.to_date(F.col("snapshot_date_key").cast("string"), "yyyyMMdd").alias("d"))))

    def of(src):
        return F.when(F.col("src") == src, F.col("d"))

    b = tagged.agg(F.min(of("v")).alias("v_lo"), F.max(of("v")).alias("v_hi"),
                   F.min(of("l")).alias("l_lo"), F.max(of("s")).alias("s_hi")).select(
        F.least(F.coalesce("v_lo", today), F.coalesce("l_lo", today)).alias("lo"),
        F.date_add(F.greatest(F.coalesce("v_hi", today), F.coalesce("s_hi", today), today),
                   2).alias("hi"))
    return calendar(b, "lo", "hi")


# ---------------------------------------------------------------- bridge


def bridge_book_author(parsed: DataFrame, authors: DataFrame | None = None) -> DataFrame:
    """One row per (book, author); keeps the primary flag, else the lowest order.

    With ``authors`` (the author dimension) names are resolved by a join and
    the preferred row is picked by a window. Without it the key is derived
    directly: the dimension holds exactly one row for every parsed name,
    keyed by the MD5 of the name, so the join only ever returns that key -
    the same rows without scanning the dimension's sources.
    """
    links = parsed.where(F.col("book_key").isNotNull() & F.col("author_name_norm").isNotNull())
    links = links.select("book_key", "author_name_norm", "author_order", "is_primary")
    order = [desc("is_primary"), asc("author_order")]
    cols = ["book_key", "author_key", "author_order", "is_primary"]
    if authors is not None:
        return build_bridge(links, authors.select("author_key", "author_name_norm"),
                            on="author_name_norm", keys=["book_key", "author_key"],
                            order=order, cols=cols)
    # The preferred row per (book, author) is (lowest order, primary flag if
    # any): a primary row always has order 1, the book's lowest. So it is a
    # plain grouped min/max - partial aggregation map-side, no sort.
    keyed = links.withColumn("author_key", md5_key("author_name_norm"))
    return (keyed.groupBy("book_key", "author_key")
                 .agg(F.min("author_order").alias("author_order"), F.max("is_primary").alias("is_primary"))
                 .select(*cols))


# ---------------------------------------------------------------- facts


def fct_weekly_rank(stg_list: DataFrame, keys: DataFrame, strip_decimal: bool = False) -> DataFrame:
    """One row per (book, week): rank, movement and new-entry flag.

    The list row joins the key table on its natural key (ISBN text as
    listed, else trimmed URI); the latest extraction wins per (book, week).
    """
    src = stg_list.select(
        F.col("published_date").cast("date").alias("week_date"),
        clean_isbn_text("isbn13", strip_decimal).alias("__isbn"),
        trimmed_or_null("book_uri").alias("__uri"),
        *rank_change_columns(),
        "extracted_at")
    nk = F.coalesce(F.nullif("__isbn", F.lit("")), F.nullif("__uri", F.lit("")))
    src = (src.where(F.col("week_date").isNotNull() & nk.isNotNull())
              .withColumn("__nk", nk).withColumn("week_key", date_key("week_date")))
    j = src.join(keys.select("book_key", F.col("book_nk").alias("__nk")), "__nk", "inner")
    best = latest_per_key(j, ["book_key", "week_key"], "extracted_at", [asc("rank")])
    return best.select("book_key", "week_key", "rank", "rank_last_week", "weeks_on_list",
                       "rank_delta", "is_new", "extracted_at")


def fct_catalogue_snapshot(best_search: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per (book, snapshot day) of catalogue ratings; latest wins."""
    src = (best_search.where(F.col("isbn13_clean").isNotNull())
                      .withColumn("__day", F.col("extracted_at").cast("date"))
                      .where(F.col("__day").isNotNull())
                      .withColumn("snapshot_date_key", date_key("__day")))
    j = src.join(keys.select("book_key", "isbn13_clean"), "isbn13_clean", "inner")
    best = latest_per_key(j, ["book_key", "snapshot_date_key"], "extracted_at", [asc("gbooks_id")])
    return best.select("book_key", "snapshot_date_key", "average_rating", "ratings_count",
                       "gbooks_id", "gbooks_selflink", "extracted_at")


def fct_pageviews_daily(stg_views: DataFrame, wiki_map: DataFrame | None = None,
                        collapse_ws: bool = False) -> DataFrame:
    """Raw view rows with an author key and date key; unmapped rows dropped.

    Not deduplicated: a view row landed twice counts twice. With
    ``wiki_map`` the article is resolved by a join. Without it the key is
    derived directly: the map is exactly the distinct (article, name) pairs
    of these same rows that have a usable name, keyed by the MD5 of the
    name, so the join keeps a row iff its article yields a name and returns
    that name's key. Deriving it needs one scan of the views instead of a
    scan for the distinct articles plus a second scan and a join.
    """
    src = stg_views.where(F.col("view_date").isNotNull())
    if wiki_map is not None:
        m = wiki_map.select("author_key", F.col("wiki_article").alias("article"))
        j = src.join(m, "article", "inner")
    else:
        j = with_article_author_key(src, "article", collapse_ws)
    return j.select("author_key", date_key("view_date").alias("date_key"), "views", "access",
                    "agent", "project", "granularity", "extracted_at")


def author_day_views(stg_views: DataFrame, collapse_ws: bool = False, wide: bool = False) -> DataFrame:
    """Views per (author, day), summed per (article, day) first.

    Same sums as aggregating :func:`fct_pageviews_daily`: the author key is a
    function of the article, so the raw rows are first summed per (article,
    day) - partial aggregation map-side on the raw text - and the name
    normalisation and MD5 run once per (article, day) rather than per row.
    All-NULL views stay NULL.
    """
    per_article = (stg_views.where(F.col("view_date").isNotNull())
                            .groupBy("article", "view_date").agg(total("views", wide).alias("views")))
    keyed = with_article_author_key(per_article, "article", collapse_ws)
    return keyed.select("author_key", "view_date", "views")


def fct_author_views_7d(daily: DataFrame, dates: DataFrame | None, weeks: DataFrame,
                        days: int = 7, wide: bool = False) -> DataFrame:
    """Views per (week, author) over the 7 days ending on the list date
    (days -6..0, inclusive).

    The daily facts meet the calendar on ``date_key`` only to turn the key
    into a date: the calendar always runs from the earliest view date (or
    earlier) to the latest view date plus two days (or later), so that join
    drops no fact row. With ``dates=None`` the rows' own ``view_date`` is used
    (or, without one, the key's date), which gives the same rows without
    computing the calendar (whose end bound needs the whole catalogue chain).
    """
    summed = "view_date" in daily.columns
    if dates is not None:
        d = daily.join(dates.select("date_key", "date_day"), "date_key", "inner")
    elif summed:
        d = daily.withColumnRenamed("view_date", "date_day")
    else:
        d = daily.withColumn("date_day", date_from_key("date_key"))
    d = d.select("author_key", "date_day", "views")
    return trailing_window_sum(d, weeks.select("week_key", "week_date"), "date_day", "week_date",
                               ["author_key"], "views", days=days, out="views_7d",
                               pre_aggregate=not summed, wide=wide).select(
        "week_key", "week_date", "author_key", "views_7d")


def fct_book_views_7d(bridge: DataFrame, author_views: DataFrame, wide: bool = False, weeks: DataFrame | None = None) -> DataFrame:
    """Per (book, week): the 7-day views summed over all the book's authors.

    The bridge is counted first (a job), so that places for the sums grow with it. ``weeks`` is the week
    dimension that the author views were made with; without it they are read for their weeks.
    """
    links = bridge.select("book_key", "author_key")
    return rollup_over_bridge(links, author_views.select("week_key", "author_key", "views_7d"),
                              "author_key", ["book_key", "week_key"], "views_7d", wide=wide, partitions=places(links), periods=weeks)


# ---------------------------------------------------------------- wide table

SCORECARD_COLS = [
    "week_key", "book_key", "published_date", "rank", "rank_last_week", "weeks_on_list",
    "rank_delta", "is_new", "isbn13", "title", "publisher", "language", "category_1",
    "average_rating", "ratings_count", "gbooks_id", "gbooks_selflink", "amazon_product_url",
    "book_image", "views_7d", "extracted_at",
]


def listed_book_views(pairs: DataFrame, bridge: DataFrame, author_views: DataFrame, wide: bool = False) -> DataFrame:
    """:func:`fct_book_views_7d` restricted to the given (week, book) pairs.

    Same sums, but only for books on the list that week: the pairs join the
    bridge first, so the roll-up never builds the books x weeks product of
    every book whose author had views.
    """
    pb = pairs.select("week_key", "book_key").join(bridge.select("book_key", "author_key"), "book_key")
    j = pb.join(author_views.select("week_key", "author_key", "views_7d"), ["week_key", "author_key"])
    return j.groupBy("week_key", "book_key").agg(total("views_7d", wide).alias("views_7d"))


def weekly_scorecard(ranks: DataFrame, weeks: DataFrame, books: DataFrame,
                     book_views: DataFrame | None = None, bridge: DataFrame | None = None,
                     author_views: DataFrame | None = None, wide: bool = False) -> DataFrame:
    """One row per (book, week) on the list with book attributes and 7-day views.

    Missing views read 0; ``extracted_at`` is the fresher of the rank row
    and the book row. Views come from ``book_views`` (the book-week fact) or,
    cheaper, from ``bridge`` + ``author_views`` for the listed pairs only.
    """
    if book_views is None:
        book_views = listed_book_views(ranks, bridge, author_views, wide)
    # Both sides of the week join are list-sized, so no forced broadcast (and
    # no size-check job): AQE picks the strategy from runtime sizes.
    wk = weeks.select("week_key", F.col("week_date").alias("published_date"))
    b = books.select("book_key", F.col("isbn13_clean").alias("isbn13"), "title", "publisher",
                     "language", "category_1", "average_rating", "ratings_count", "gbooks_id",
                     "gbooks_selflink", "amazon_product_url", "book_image",
                     F.col("extracted_at").alias("__book_ts"))
    v = book_views.select("week_key", "book_key", F.col("views_7d").alias("__v"))
    j = (ranks.join(wk, "week_key", "inner")
              .join(b, "book_key", "inner")
              .join(v, ["week_key", "book_key"], "left"))
    return j.select(*[
        F.coalesce("__v", F.lit(0).cast("decimal(38,0)" if wide else "bigint")).alias("views_7d") if c == "views_7d"
        else freshest("extracted_at", "__book_ts").alias("extracted_at") if c == "extracted_at"
        else F.col(c)
        for c in SCORECARD_COLS])
