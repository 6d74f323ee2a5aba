"""The reusable operators applied directly to the TPC-H-like test tables.

Each function reads whole tables and exercises one operator outside the
model graph: trailing windows on events, best/latest record per key with
NULL sort keys, name explosion, key consolidation, first-available-key
joins, JSON scalar extraction, calendars and week dimensions, the
warehouse's safe text casts, and freshest-timestamp merging.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions import (
    freshest, json_text, safe_date, safe_double, safe_int, safe_long, yyyymmdd_to_date,
)
from rankforge.operators.calendar import calendar, week_dimension
from rankforge.operators.hot_keys import heavy_keys
from rankforge.operators.joins import join_first_available
from rankforge.operators.keys import consolidate_keys
from rankforge.operators.names import explode_names
from rankforge.operators.topn import asc, best_per_key, desc, latest_per_key, number_in_group
from rankforge.operators.windows import trailing_window_sum


def _t(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


def events_trailing_7d(spark: SparkSession, root: str) -> DataFrame:
    """Per user and event day: events in the 7 days ending that day."""
    ev = _t(spark, root, "events").select("user_id", F.to_date("ts").alias("day"),
                                          F.lit(1).cast("bigint").alias("n"))
    anchors = ev.select(F.col("day").alias("anchor_day")).distinct()
    return trailing_window_sum(ev, anchors, "day", "anchor_day", ["user_id"], "n", days=7,
                               out="events_7d")


def orders_best_per_customer(spark: SparkSession, root: str) -> DataFrame:
    """Each customer's best order: non-urgent priority text first (urgent is
    treated as missing and sorts last), then the highest price, then key."""
    o = _t(spark, root, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice",
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"))
    return best_per_key(o, ["o_custkey"], [desc("priority"), desc("o_totalprice"), asc("o_orderkey")])


def events_latest_per_user_day(spark: SparkSession, root: str) -> DataFrame:
    """The latest event per (user, day); event id breaks ties."""
    ev = _t(spark, root, "events").select("user_id", "event_id", "ts", "event_type",
                                          F.to_date("ts").alias("day"))
    return latest_per_key(ev, ["user_id", "day"], "ts", [asc("event_id")])


def part_name_pieces(spark: SparkSession, root: str) -> DataFrame:
    """Part names read as bylines (words joined by `` & ``), one row per
    word, numbered alphabetically within the part."""
    p = _t(spark, root, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(" & ")).alias("byline"))
    names = explode_names(p, "byline", keep=["p_partkey"])
    return number_in_group(names, ["p_partkey"], [asc("name_norm"), asc("name_raw")],
                           out="name_order", first_flag="is_first")


def part_key_consolidation(spark: SparkSession, root: str) -> DataFrame:
    """Natural keys from parts (key text, blank for the smallest sizes; else
    the name) and from line items (key text only)."""
    part = _t(spark, root, "part").select(
        F.when(F.col("p_size") < 5, F.lit("")).otherwise(F.col("p_partkey").cast("string")).alias("key_text"),
        F.col("p_name").alias("alt_key"))
    li = _t(spark, root, "lineitem").select(F.col("l_partkey").cast("string").alias("key_text"),
                                            F.lit(None).cast("string").alias("alt_key"))
    return consolidate_keys([part, li], ["key_text", "alt_key"], nk="nk", key="nk_key")


def orders_customer_first_key(spark: SparkSession, root: str) -> DataFrame:
    """Orders matched to customers on the customer key, or - where the
    order's key is withheld (urgent orders) - on the customer name."""
    o = _t(spark, root, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("k_id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("k_name"))
    c = _t(spark, root, "customer").select(F.col("c_custkey"), F.col("c_custkey").alias("c_id"),
                                           F.col("c_name"))
    j = join_first_available(o, c, [("k_id", "c_id"), ("k_name", "c_name")])
    return j.select("o_orderkey", "c_custkey", "c_name")


def events_json_scalars(spark: SparkSession, root: str) -> DataFrame:
    """``props`` JSON scalar ``$.k`` as a safe bigint, per event."""
    ev = _t(spark, root, "events")
    return ev.select("event_id", safe_long(json_text("props", "$.k")).alias("k"),
                     json_text("props", "$.missing").alias("missing"))


def order_calendar(spark: SparkSession, root: str, as_of: str = "2001-12-31") -> DataFrame:
    """Day calendar from the first order date to the later of the last ship
    date and ``as_of``, plus two days (bounds from one aggregate each)."""
    o = _t(spark, root, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"))
    li = _t(spark, root, "lineitem").agg(F.max(F.to_date("l_shipdate")).alias("ship_hi"))
    today = F.lit(as_of).cast("date")
    b = o.unionByName(li, allowMissingColumns=True).agg(
        F.min("lo").alias("lo"), F.date_add(F.greatest(F.max("ship_hi"), today), 2).alias("hi"))
    return calendar(b, "lo", "hi")


def ship_weeks(spark: SparkSession, root: str) -> DataFrame:
    """Week dimension of the Mondays of ship dates."""
    li = _t(spark, root, "lineitem").select(F.to_date(F.date_trunc("week", "l_shipdate")).alias("wk"))
    return week_dimension(li, "wk")


def event_text_casts(spark: SparkSession, root: str) -> DataFrame:
    """Event values and times written as text, read back with the
    warehouse's safe casts (rounding, exponent text, partial dates)."""
    ev = _t(spark, root, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    txt = F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                   F.lpad((cents % 100).cast("string"), 2, "0"))
    return ev.select(
        "event_id",
        safe_long(txt).alias("value_long"),
        safe_int(F.concat(txt, F.lit("e1"))).alias("value_x10"),
        safe_double(json_text("props", "$.k")).alias("k_double"),
        safe_date(F.date_format("ts", "yyyy-M-d")).alias("day"),
        safe_date(F.date_format("ts", "yyyy-MM")).alias("month_only"),
        yyyymmdd_to_date(F.date_format("ts", "yyyyMMddHH")).alias("view_day"),
    )


def freshest_order_event(spark: SparkSession, root: str) -> DataFrame:
    """Per order: the fresher of its order time and its customer's latest
    event (missing counts as the epoch)."""
    o = _t(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    last = (_t(spark, root, "events").groupBy(F.col("user_id").alias("o_custkey"))
            .agg(F.max("ts").alias("last_event")))
    j = o.join(last, "o_custkey", "left")
    return j.select("o_orderkey", freshest("o_orderdate", "last_event").alias("freshest_at"))


def heavy_parts(spark: SparkSession, root: str) -> DataFrame:
    """Parts with 40 line items or more, and how many they have."""
    return heavy_keys(_t(spark, root, "lineitem"), "l_partkey", 40)


GENERIC_QUERIES = {
    "generic_events_trailing_7d": events_trailing_7d,
    "generic_orders_best_per_customer": orders_best_per_customer,
    "generic_events_latest_per_user_day": events_latest_per_user_day,
    "generic_part_name_pieces": part_name_pieces,
    "generic_part_key_consolidation": part_key_consolidation,
    "generic_orders_customer_first_key": orders_customer_first_key,
    "generic_events_json_scalars": events_json_scalars,
    "generic_order_calendar": order_calendar,
    "generic_ship_weeks": ship_weeks,
    "generic_event_text_casts": event_text_casts,
    "generic_freshest_order_event": freshest_order_event,
    "generic_heavy_parts": heavy_parts,
}
