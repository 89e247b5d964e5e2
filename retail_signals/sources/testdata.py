"""Retail inputs derived from the TPC-H-style test tables.

A series is a supplier (store) x part type (item); a day is a ship date. From
lineitem, part and supplier this builds the three inputs of a run:

* long sales: units = sum of l_quantity per store, item and ship date;
* calendar: one row per day from the first to the last ship date, day number
  ``d_<days since 1995-01-01 + 1>``, week ``floor(days / 7) + 1``, a
  "Promo"/"Cultural" event where days mod 30 is 5, 6 or 7;
* prices: per store, item and week the highest l_extendedprice / l_quantity
  over lines not returned ('R'); weeks with only returned lines get no price.

Everything is a Spark job over the whole tables, so the inputs grow with them.
"""
from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.demand import SERIES_KEYS
from . import wide_kernel
from .layout import materialize_by_series
from .wide_kernel import spread_days

# Workers receive the kernel by value: no package install needed on executors.
cloudpickle.register_pickle_by_value(wide_kernel)

# Origin of the day numbering, the week length, and the event rule.
EPOCH = "1995-01-01"
WEEK_DAYS = 7
EVENT_CYCLE_DAYS = 30
EVENT_DAYS = (5, 6, 7)
EVENT_NAME = "Promo"
EVENT_TYPE = "Cultural"
CATEGORY = "ALL"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_number(date_col) -> F.Column:
    return F.datediff(date_col, F.lit(EPOCH).cast("date"))


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its part type: store_id, item_id, quantity, unit
    price of lines not returned, k (day number from 0).

    What the lines are needed for is projected before the join, so where the parts
    are too many to broadcast, narrow rows are dealt out by part."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("paid"),
        day_number(F.to_date("l_shipdate")).alias("k"))
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.col("l_suppkey").cast("string").alias("store_id"), F.col("p_type").alias("item_id"), "quantity",
                    (F.col("paid") / F.col("quantity")).alias("unit_price"), "k"))


def d_label(k) -> F.Column:
    return F.concat(F.lit("d_"), (k + 1).cast("string"))


def week_of(k) -> F.Column:
    return (F.floor(k / WEEK_DAYS) + 1).cast("int")


def daily_facts(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Per store, item and day: summed units and the highest unit price of the
    lines not returned (null when every line of the day was returned), with the
    store's state.

    Both the sales and the weekly prices come from this one aggregate, so the
    line scan and its joins run once. The lines are dealt out once, by series, and
    aggregated where they lie: what stores the days by series, or reads them so,
    needs no second exchange. A series keeps one row per day in its task, however
    many lines it has. The supplier's nation is joined to the aggregated rows."""
    facts = facts if facts is not None else line_facts(spark, sf_dir)
    supplier = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("store_id"), F.col("s_nationkey").cast("string").alias("state_id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    daily = (facts.repartition(parts, *SERIES_KEYS).groupBy(*SERIES_KEYS, "k")
             .agg(F.sum("quantity").alias("units_sold"), F.max("unit_price").alias("day_price")))
    return (daily.join(supplier, "store_id")
            .select("store_id", "item_id", "state_id", "k", "units_sold", "day_price"))


def long_sales(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Long sales: item_id, dept_id, cat_id, store_id, state_id, d, units_sold."""
    daily = daily if daily is not None else daily_facts(spark, sf_dir)
    return daily.select("item_id", F.col("item_id").alias("dept_id"),
                        F.lit(CATEGORY).alias("cat_id"), "store_id", "state_id",
                        d_label(F.col("k")).alias("d"),
                        F.col("units_sold").cast("double").alias("units_sold"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and the last ship date.

    The span is a global min/max over one pruned column (partial aggregates
    per task, one final row); the exploded calendar is bounded by the span."""
    k = day_number(F.to_date("l_shipdate"))
    span = _table(spark, sf_dir, "lineitem").agg(F.min(k).alias("k0"), F.max(k).alias("k1"))
    days = span.select(F.explode(F.sequence("k0", "k1")).alias("k"))
    event = (F.col("k") % EVENT_CYCLE_DAYS).isin(*EVENT_DAYS)
    return days.select(d_label(F.col("k")).alias("d"),
                       F.date_add(F.lit(EPOCH).cast("date"), F.col("k").cast("int")).alias("date"),
                       week_of(F.col("k")).alias("wm_yr_wk"),
                       F.when(event, F.lit(EVENT_NAME)).alias("event_name_1"),
                       F.when(event, F.lit(EVENT_TYPE)).alias("event_type_1"))


def prices(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Weekly prices: store_id, item_id, wm_yr_wk, sell_price; weeks whose lines
    were all returned get no row."""
    daily = daily if daily is not None else daily_facts(spark, sf_dir)
    return (daily.groupBy("store_id", "item_id", week_of(F.col("k")).alias("wm_yr_wk"))
            .agg(F.max("day_price").alias("sell_price"))
            .where(F.col("sell_price").isNotNull()))


def stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate, written once by series into the checkpoint folder:
    prices, their join, the window and the pivot read it without an exchange."""
    return materialize_by_series(daily_facts(spark, sf_dir), sort_by=("k",), dealt=False)


def inputs(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None
           ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(long sales, calendar, prices) from one shared daily aggregate.

    Sales and prices need different aggregates of the same daily rows, so
    column pruning would give each its own line scan and part join (the most
    expensive stage at scale). The daily aggregate is therefore written once
    and both read it."""
    daily = stored_daily(spark, sf_dir) if daily is None else daily
    return long_sales(spark, sf_dir, daily), calendar(spark, sf_dir), prices(spark, sf_dir, daily)


def day_span(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last day number of the ship dates (one small aggregate)."""
    li = _table(spark, sf_dir, "lineitem")
    k = day_number(F.to_date("l_shipdate"))
    row = li.agg(F.min(k).alias("k0"), F.max(k).alias("k1")).first()
    return int(row["k0"]), int(row["k1"])


def wide_sales(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Wide sales, one row per series: ids, then one column per day ``d_<k+1>``
    for every day of the span; a day without sales is null.

    The day list is the span of ship dates (two numbers fetched with one
    aggregate). Each series' days are collected into a list by a Spark aggregate,
    without an exchange over the facts stored by series, and a kernel spreads the
    lists over the columns in small blocks. So a task holds no more wide rows than a
    block, however many series it has; a pivot held all of them.
    """
    k0, k1 = day_span(spark, sf_dir)
    labels = [f"d_{k + 1}" for k in range(k0, k1 + 1)]
    daily = stored_daily(spark, sf_dir) if daily is None else daily
    ids = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
    listed = (daily.withColumn("dept_id", F.col("item_id")).withColumn("cat_id", F.lit(CATEGORY)).groupBy(*ids)
              .agg(F.collect_list(F.struct(F.col("k").cast("int").alias("k"),
                                           F.col("units_sold").cast("double").alias("units"))).alias("cells"))
              .select(F.concat_ws("_", "item_id", "store_id").alias("id"), *ids, "cells"))
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in ("id", *ids)),
                           *(T.StructField(c, T.DoubleType()) for c in labels)])
    return listed.mapInArrow(lambda batches: spread_days(batches, k0, labels), schema)
