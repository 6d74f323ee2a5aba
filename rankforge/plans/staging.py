"""Staging models: type the raw landing tables, one output row per raw row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import (
    blank_to_null, decimal_to_text, first_of, first_text, int_of, is_malformed, json_object, long_of, safe_double, safe_long,
    wide_of, yyyymmdd_to_date,
)

def stg_ranked_list(raw: DataFrame) -> DataFrame:
    """Typed weekly list rows; rows without an ISBN are dropped.

    Blank text means missing; rank fields are safe-cast to int; the
    published date cast is strict (bad text fails the job).
    """
    return (raw.select(
        F.col("published_date").cast("date").alias("published_date"),
        "book_uri",
        blank_to_null("primary_isbn13").alias("isbn13"),
        blank_to_null("title").alias("title_nyt"),
        blank_to_null("author").alias("author_nyt"),
        blank_to_null("publisher").alias("publisher_nyt"),
        int_of(raw, "rank").alias("rank"),
        int_of(raw, "rank_last_week").alias("rank_last_week"),
        int_of(raw, "weeks_on_list").alias("weeks_on_list"),
        "amazon_product_url",
        "book_image",
        F.col("_airbyte_extracted_at").alias("extracted_at"),
    ).where(F.col("isbn13").isNotNull()))


def stg_volumes(raw: DataFrame, on_malformed: str = "null") -> DataFrame:
    """Typed catalogue volumes (used for both catalogue streams).

    The DECIMAL ISBN becomes integer text (rounded); text fields come out of
    the ``volumeinfo`` JSON document; ratings are safe-cast; the raw JSON
    documents are carried for later steps.
    """
    return parse_volumes(raw, on_malformed).drop("__identifiers", "__malformed")


def parse_volumes(raw: DataFrame, on_malformed: str = "null") -> DataFrame:
    """:func:`stg_volumes` plus the text of the identifier list, ``__identifiers``,
    and ``__malformed``, all from one parse of the document.

    The parse keeps the order of keys, so a repeated key reads its first value. A text that is no JSON document has
    NULL fields, or with ``on_malformed="fail"`` stops the job.
    """
    doc = raw.withColumn("__doc", json_object("volumeinfo"))
    bad = is_malformed("volumeinfo", "__doc")
    if on_malformed == "fail":
        doc = doc.withColumn("__doc", F.when(bad, F.raise_error(F.concat(F.lit("malformed document of volume "), F.coalesce("id", F.lit("?"))))
                                             .cast("map<string,string>")).otherwise(F.col("__doc")))
    elif on_malformed != "null":
        raise ValueError(f"on_malformed: {on_malformed!r}")

    def field(name: str):
        return first_of("__doc", name)

    return doc.select(
        decimal_to_text("isbn13").alias("isbn13_clean"),
        F.col("id").alias("gbooks_id"),
        F.col("selflink").alias("gbooks_selflink"),
        F.col("_airbyte_extracted_at").alias("extracted_at"),
        field("title").alias("title"),
        field("subtitle").alias("subtitle"),
        field("publisher").alias("publisher"),
        field("publishedDate").alias("published_date_raw"),
        field("language").alias("language"),
        first_text(field("categories")).alias("category_1"),
        safe_double(field("averageRating")).alias("average_rating"),
        safe_long(field("ratingsCount")).alias("ratings_count"),
        "volumeinfo", "saleinfo", "accessinfo", "searchinfo",
        field("industryIdentifiers").alias("__identifiers"),
        bad.alias("__malformed"),
    )


def malformed_volumes(raw: DataFrame) -> DataFrame:
    """The volumes whose document is no JSON: ``isbn13_clean, gbooks_id, volumeinfo``."""
    return parse_volumes(raw).where("__malformed").select("isbn13_clean", "gbooks_id", "volumeinfo")


def stg_pageviews(raw: DataFrame, wide: bool = False) -> DataFrame:
    """Typed daily page views; rows whose timestamp text is not a valid
    ``YYYYMMDD..`` date are dropped. ``wide`` keeps views in 38 digits, for a
    landing that declares them as decimals beyond 64 bits."""
    return (raw.select(
        "project", "article", "access", "agent", "granularity", "timestamp",
        yyyymmdd_to_date("timestamp").alias("view_date"),
        (wide_of if wide else long_of)(raw, "views").alias("views"),
        F.col("_airbyte_extracted_at").alias("extracted_at"),
    ).where(F.col("view_date").isNotNull()))
