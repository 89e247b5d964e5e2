"""Segmented baseline and ledger against the sequential ones."""
import random

import pytest
from pyspark.sql import functions as F

from retail_signals import SignalConfig, StockPolicy
from retail_signals.operators import long_series
from retail_signals.plans.jobs import ledger_from_demand, ledger_from_stored

COLUMNS = ["store_id", "item_id", "date", "units_sold", "rolling_mean", "forecast_units", "demand", "opening_stock",
           "replenished_qty", "fulfilled_qty", "closing_stock", "stockout_flag", "fulfillment_rate"]


def demand(spark, path, days, units, stores=("a", "b")):
    """One row a day and store; unlike units for each day, some null or NaN."""
    store = F.explode(F.array(*map(F.lit, stores)))
    day = F.date_add(F.lit("0100-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(0, days, 1, 6).select(
        "id", store.alias("store_id"), day.alias("date")).select(
        "date", "store_id", F.lit("st").alias("state_id"), F.lit("i").alias("item_id"), F.lit("d").alias("dept_id"),
        F.lit("c").alias("cat_id"), F.expr(units).alias("units_sold"), F.lit(1.0).alias("price")).write.parquet(path)
    return spark.read.parquet(path)


def same(spark, table, cfg, folder):
    """All rows and columns of both ledgers are equal."""
    for name, made in (("plain", ledger_from_demand(table, cfg)), ("cut", ledger_from_stored(table, cfg))):
        made.select(COLUMNS).write.parquet(f"{folder}/{name}")
    plain, cut = (spark.read.parquet(f"{folder}/{n}") for n in ("plain", "cut"))
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64(*COLUMNS).cast("decimal(38,0)")))
    assert plain.agg(*mark).first() == cut.agg(*mark).first()
    assert plain.count() == table.count()


HASH = "pmod(xxhash64(id, store_id), 1000)"
BUSY = f"case when {HASH} < 5 then null when {HASH} < 8 then double('nan') else double({HASH} % 90) end"


def test_a_million_rows_equal_the_sequential_fold(spark, tmp_path):
    table = demand(spark, f"{tmp_path}/demand", 1_000_000, BUSY, stores=("a",))
    cfg = SignalConfig(segment_rows=120_000)
    rows = long_series.with_segments(table, long_series.series_sizes(table, cfg.segment_rows), cfg.segment_rows)
    sizes = [r["count"] for r in rows.groupBy("segment").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 200_000
    same(spark, table, cfg, tmp_path)


@pytest.mark.parametrize("units, rounds", [
    (BUSY, "meet"),                     # stock runs out now and then: states meet
    (f"double({HASH} % 7)", "never"),  # it never does: each guess is wrong to the end
    ("cast(null as double)", "right"),  # nothing changes: every guess is right
])
def test_wrong_guesses_are_redone(spark, tmp_path, monkeypatch, units, rounds):
    table = demand(spark, f"{tmp_path}/demand", 4000, units)
    cfg = SignalConfig(segment_rows=300, policy=StockPolicy(initial_stock=777, reorder_point=90, lead_rows=3))
    folds = []
    fold = long_series._fold
    monkeypatch.setattr(long_series, "_fold", lambda *a, **k: folds.append(a[2:]) or fold(*a, **k))
    same(spark, table, cfg, tmp_path)
    in_one_piece = (long_series.SERIES_KEYS,) in folds
    assert (len(folds) > 1, in_one_piece) == {"meet": (True, False), "never": (True, True), "right": (False, False)}[rounds]


def test_short_and_long_series_ties_and_gaps(spark, tmp_path):
    rnd = random.Random(2)
    rows = []
    for s, n in (("a", 900), ("b", 40), ("c", 1)):
        for k in range(n):
            rows.append((k * rnd.choice([1, 3]) + (10_000 if k > 500 else 0), s, rnd.choice([None, 0.0, 3.0, 77.0])))
    table = spark.createDataFrame(rows, "id int, store_id string, units double").dropDuplicates(["id", "store_id"])
    table = table.select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id")).alias("date"), "store_id",
                         F.lit(None).cast("string").alias("state_id"), F.lit("i").alias("item_id"),
                         F.lit("d").alias("dept_id"), F.lit("c").alias("cat_id"), F.col("units").alias("units_sold"),
                         F.lit(None).cast("double").alias("price"))
    table = table.unionByName(table.limit(3).withColumn("store_id", F.lit(None).cast("string")))
    table.write.parquet(f"{tmp_path}/demand")
    table = spark.read.parquet(f"{tmp_path}/demand")
    cfg = SignalConfig(segment_rows=60, window_rows=5)
    usable = table.filter("store_id is not null")
    usable.write.parquet(f"{tmp_path}/usable")
    same(spark, spark.read.parquet(f"{tmp_path}/usable"), cfg, tmp_path)


def test_segments_smaller_than_the_window(spark, tmp_path):
    table = demand(spark, f"{tmp_path}/demand", 300, BUSY)
    same(spark, table, SignalConfig(segment_rows=4, window_rows=14), tmp_path)
