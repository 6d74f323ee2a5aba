"""Intermediate models: best record per ISBN, natural keys, author parsing,
article -> author mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import (
    clean_isbn_text, json_array_contains, json_flag_true, json_list_as_csv, list_contains, md5_key,
    normalize_name, safe_date, trimmed_or_null, zs_trim,
)
from rankforge.operators.keys import consolidate_keys
from rankforge.operators.names import explode_names
from rankforge.operators.topn import asc, best_per_key, desc, number_in_group

BEST_VOLUME_COLS = [
    "isbn13_clean", "gbooks_id", "gbooks_selflink", "extracted_at", "title", "subtitle",
    "publisher", "published_date_raw", "language", "category_1", "average_rating",
    "ratings_count", "volumeinfo", "saleinfo", "accessinfo", "searchinfo",
]


def with_isbn_match(stg: DataFrame) -> DataFrame:
    """Adds ``has_isbn_match``: 1 where a volume lists its ISBN as its ISBN_13 identifier, else 0. With
    ``parse_volumes`` input the list's text comes from the same single parse as the other fields."""
    want = {"type": "ISBN_13", "identifier": F.col("isbn13_clean")}
    has = (list_contains("__identifiers", want) if "__identifiers" in stg.columns
           else json_array_contains("volumeinfo", "industryIdentifiers", want))
    return stg.withColumn("has_isbn_match", has.cast("int"))


def best_volume(stg: DataFrame, match_isbn: bool = True) -> DataFrame:
    """One catalogue volume per ISBN.

    Preference, in order: (search stream only) the volume lists the ISBN as
    its ISBN_13 identifier; more ratings; higher rating; is an e-book; later
    published date (full dates only); later extraction; smaller id.
    """
    base = stg.where(F.col("isbn13_clean").isNotNull())
    base = base.withColumns({
        "is_ebook_flag": json_flag_true("saleinfo", "$.isEbook"),
        "published_date": safe_date("published_date_raw"),
    })
    order = []
    cols = list(BEST_VOLUME_COLS)
    if match_isbn:
        if "has_isbn_match" not in base.columns:
            base = with_isbn_match(base)
        order.append(desc("has_isbn_match"))
        cols.insert(1, "has_isbn_match")
    order += [desc("ratings_count"), desc("average_rating"), desc("is_ebook_flag"),
              desc("published_date"), desc("extracted_at"), asc("gbooks_id")]
    # Nearly all ISBNs begin alike, so sorting compares their numbers first; the text is what counts.
    return best_per_key(base, [F.col("isbn13_clean").try_cast("bigint"), "isbn13_clean"], order).select(*cols)


def authors_text(null_authors_as_text: bool = False):
    """The catalogue's author list of a volume, as comma-separated text."""
    authors = json_list_as_csv("volumeinfo", "$.authors")
    if null_authors_as_text:
        explicit_null = (F.array_contains(F.json_object_keys("volumeinfo"), "authors")
                         & F.get_json_object("volumeinfo", "$.authors").isNull())
        authors = F.when(explicit_null, F.lit("null")).otherwise(authors)
    return authors


def narrow_volumes(best_search: DataFrame, null_authors_as_text: bool = False) -> DataFrame:
    """The best volumes' fields that the marts read, and their authors' text; no JSON document."""
    return best_search.select("isbn13_clean", "gbooks_id", "gbooks_selflink", "extracted_at", "average_rating",
                              "ratings_count", authors_text(null_authors_as_text).alias("authors_text"))


def book_keys(stg_list: DataFrame, best_search: DataFrame, strip_decimal: bool = False) -> DataFrame:
    """One row per book natural key (ISBN, else list URI) with an MD5 key.

    ``best_search`` only contributes its set of ISBNs, so the staged
    catalogue can be passed instead: the best-volume step keeps exactly one
    row per non-NULL staged ISBN, and the consolidation groups repeats, so
    the keys are the same - without parsing any JSON or ranking volumes.
    Output: ``book_key, book_nk, isbn13_clean, book_uri``.
    """
    from_list = stg_list.select(
        clean_isbn_text(trimmed_or_null(F.col("isbn13").cast("string")), strip_decimal).alias("isbn13_clean"),
        trimmed_or_null("book_uri").alias("book_uri"))
    # An ISBN has many volumes: distinct ones by hash first, as the greatest text of a key needs a sort.
    from_catalogue = best_search.select(F.col("isbn13_clean").cast("string").alias("isbn13_clean")).distinct().select(
        trimmed_or_null("isbn13_clean").alias("isbn13_clean"),
        F.lit(None).cast("string").alias("book_uri"))
    return consolidate_keys([from_list, from_catalogue], ["isbn13_clean", "book_uri"],
                            nk="book_nk", key="book_key")


def author_parse(keys: DataFrame, best_search: DataFrame, stg_list: DataFrame,
                 collapse_ws: bool = False, null_authors_as_text: bool = False) -> DataFrame:
    """One row per (book, list row, author name piece) - not unique.

    The byline is the catalogue's JSON author list when it has one, else the
    list's author text. Joining the list by ISBN repeats a book once per
    week it was listed; ``author_order`` numbers the pieces alphabetically
    over those repeated rows and ``is_primary`` marks the first.

    An explicit ``"authors": null`` counts as no list (the list author is
    used); ``null_authors_as_text=True`` reproduces the reference instead,
    where it reads as the text ``null`` - a phantom author named "null".
    """
    authors = (F.col("authors_text") if "authors_text" in best_search.columns
               else authors_text(null_authors_as_text))
    gb = best_search.select(F.col("isbn13_clean").alias("__gb_isbn"), authors.alias("__gb_authors"))
    nyt = stg_list.select(F.col("isbn13").alias("__nyt_isbn"), F.col("author_nyt"))
    base = (keys.join(gb, keys["isbn13_clean"] == gb["__gb_isbn"], "left")
                .join(nyt, keys["isbn13_clean"] == nyt["__nyt_isbn"], "left")
                .select("book_key", "book_nk",
                        F.coalesce(trimmed_or_null("__gb_authors"),
                                   trimmed_or_null("author_nyt")).alias("authors_raw")))
    names = explode_names(base, "authors_raw", raw_col="author_name_raw",
                          norm_col="author_name_norm", keep=["book_key", "book_nk"],
                          collapse_ws=collapse_ws)
    numbered = number_in_group(names, ["book_key"],
                               [asc("author_name_norm"), asc("author_name_raw")],
                               out="author_order", first_flag="is_primary")
    return numbered.select("book_key", "book_nk", "author_name_raw", "author_name_norm",
                           "author_order", "is_primary")


def article_author_name(article: str = "article", collapse_ws: bool = False):
    """An article title read as a normalised person name (``_`` is a space)."""
    return normalize_name(F.replace(F.col(article), F.lit("_"), F.lit(" ")), collapse_ws)


def with_article_author_key(df: DataFrame, article: str = "article", collapse_ws: bool = False) -> DataFrame:
    """Rows whose article reads as a usable name, with that name's MD5
    ``author_key`` (the rows and keys the article map would give them)."""
    name = article_author_name(article, collapse_ws)
    keep = (F.col(article).isNotNull() & (zs_trim(article) != "") & name.isNotNull() & (name != ""))
    return df.where(keep).withColumn("author_key", md5_key(name))


def wiki_author_map(stg_views: DataFrame, collapse_ws: bool = False) -> DataFrame:
    """Distinct (article, normalised author name) with an MD5 author key.

    The article title reads as a name once ``_`` becomes a space.
    """
    src = (stg_views.where(F.col("article").isNotNull() & (zs_trim("article") != ""))
                    .select(F.col("article").alias("wiki_article"),
                            article_author_name("article", collapse_ws).alias("author_name_norm"))
                    .distinct())
    return (src.where(F.col("author_name_norm").isNotNull() & (F.col("author_name_norm") != ""))
               .select(md5_key("author_name_norm").alias("author_key"), "wiki_article",
                       "author_name_norm"))
