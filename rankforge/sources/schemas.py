"""Declared schemas of the four raw landing tables.

The landing tables carry whatever the extraction wrote; these schemas pin
the columns the staging models read, so reads never infer types.
"""

from __future__ import annotations

from pyspark.sql import types as T

RANKED_LIST = T.StructType([
    T.StructField("published_date", T.StringType()),
    T.StructField("book_uri", T.StringType()),
    T.StructField("primary_isbn13", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("rank", T.LongType()),
    T.StructField("rank_last_week", T.LongType()),
    T.StructField("weeks_on_list", T.LongType()),
    T.StructField("amazon_product_url", T.StringType()),
    T.StructField("book_image", T.StringType()),
    T.StructField("_airbyte_extracted_at", T.TimestampType()),
])

CATALOGUE = T.StructType([
    T.StructField("isbn13", T.DecimalType(38, 9)),
    T.StructField("id", T.StringType()),
    T.StructField("selflink", T.StringType()),
    T.StructField("_airbyte_extracted_at", T.TimestampType()),
    T.StructField("volumeinfo", T.StringType()),
    T.StructField("saleinfo", T.StringType()),
    T.StructField("accessinfo", T.StringType()),
    T.StructField("searchinfo", T.StringType()),
])

PAGEVIEWS = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("article", T.StringType()),
    T.StructField("access", T.StringType()),
    T.StructField("agent", T.StringType()),
    T.StructField("granularity", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("_airbyte_extracted_at", T.TimestampType()),
])

# Raw table name -> schema. Names follow the landing layout.
RAW_TABLES = {
    "ranked_list": RANKED_LIST,
    "catalogue_search": CATALOGUE,
    "catalogue_isbn": CATALOGUE,
    "pageviews": PAGEVIEWS,
}
