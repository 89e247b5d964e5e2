import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledger_rules import assert_ledger, assert_openings
from retail_signals import StockPolicy, project_stock
from retail_signals.operators.stock import LEDGER_COLUMNS
from retail_signals.operators.stock_kernel import fold_openings

D0 = dt.date(2016, 1, 1)
SCHEMA = "date date, store_id string, item_id string, units_sold double, forecast_units double"


def frame(spark, series):
    rows = []
    for (store, item), pairs in series.items():
        for i, (u, f) in enumerate(pairs):
            rows.append((D0 + dt.timedelta(days=i), store, item, u, f))
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, series, policy=StockPolicy()):
    out = project_stock(frame(spark, series), policy).orderBy("store_id", "item_id", "date")
    got = {}
    for r in out.collect():
        got.setdefault((r.store_id, r.item_id), []).append(r.asDict())
    return got


def check(spark, series, policy=StockPolicy()):
    got = run(spark, series, policy)
    for key, pairs in series.items():
        assert_ledger(got[key], [u for u, _ in pairs], [f for _, f in pairs], initial=policy.initial_stock,
                      point=policy.reorder_point, quantity=policy.reorder_qty, lead=policy.lead_rows)


def test_edge_units(spark):
    check(spark, {
        ("s", "zero"): [(0.0, 5.0)] * 5,
        ("s", "null"): [(None, 5.0), (3.0, 5.0), (None, None)],
        ("s", "frac"): [(2.5, 3.0), (149.7, 3.0), (0.4, 1.0), (7.25, 0.0)],
        ("s", "above"): [(500.0, 10.0), (10.0, 10.0), (10.0, 10.0), (10.0, 10.0)],
    })


def test_two_orders_on_the_way(spark):
    # stock falls under the reorder point on two rows in a row: two orders in flight
    check(spark, {("a", "b"): [(120.0, 1.0), (5.0, 1.0), (5.0, 1.0), (1.0, 1.0), (1.0, 1.0),
                               (300.0, 1.0), (1.0, 1.0), (1.0, 1.0)]})


@pytest.mark.parametrize("lead", [1, 2, 5])
def test_leads_random(spark, lead):
    rnd = random.Random(lead)
    series = {(f"s{k}", "i"): [(float(rnd.randint(0, 60)), float(rnd.choice([0, 10, 20])))
                               for _ in range(rnd.randint(1, 60))] for k in range(12)}
    check(spark, series, StockPolicy(lead_rows=lead))


def test_lead_zero_rejected():
    with pytest.raises(ValueError):
        StockPolicy(lead_rows=0)


def test_small_batches_many_partitions(spark):
    rnd = random.Random(7)
    series = {(f"s{k}", f"i{k % 3}"): [(float(rnd.randint(0, 50)), 10.0) for _ in range(97)]
              for k in range(9)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = frame(spark, series).repartition(13)
        out = project_stock(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {}
    for r in sorted(out, key=lambda r: (r.store_id, r.item_id, r.date)):
        got.setdefault((r.store_id, r.item_id), []).append(r)
    for key, pairs in series.items():
        assert_ledger([g.asDict() for g in got[key]], [u for u, _ in pairs], [f for _, f in pairs])


def test_zero_forecast_replaced_by_units(spark):
    got = run(spark, {("s", "i"): [(0.0, 0.0)] * 14 + [(5.0, 0.0)]})[("s", "i")]
    assert got[-1]["forecast_units"] == 5.0
    assert got[0]["forecast_units"] == 0.0


def test_ledger_identities(spark):
    rnd = random.Random(3)
    series = {(f"s{k}", "i"): [(float(rnd.randint(0, 80)), 20.0) for _ in range(40)]
              for k in range(5)}
    for rows in run(spark, series).values():
        for prev, cur in zip(rows, rows[1:]):
            assert cur["opening_stock"] == prev["closing_stock"] + cur["replenished_qty"]
        for r in rows:
            assert 0.0 <= r["fulfillment_rate"] <= 1.0


def test_schema_and_partition_invariance(spark):
    series = {(f"s{k}", "i"): [(float(j % 17), 9.0) for j in range(30)] for k in range(6)}
    a = project_stock(frame(spark, series))
    cols = [c for c in LEDGER_COLUMNS if c not in ("state_id", "dept_id", "cat_id")]
    assert set(cols) <= set(a.columns)
    b = project_stock(frame(spark, series).repartition(5, "date"))
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_kernel_carries_state_across_batches():
    keys = [("a", "x")] * 10
    demand = [30.0] * 10
    policy = (150, 40, 120, 2)
    whole, _, _ = fold_openings(keys, demand, None, policy)
    first, _, state = fold_openings(keys[:4], demand[:4], None, policy)
    second, _, _ = fold_openings(keys[4:], demand[4:], state, policy)
    assert list(whole) == list(first) + list(second)


def test_nan_demand_follows_ieee_comparisons(spark):
    got = run(spark, {("s", "nan"): [(10.0, 5.0), (float("nan"), 5.0), (3.0, 5.0)]})[("s", "nan")]
    assert_ledger(got, [10.0, float("nan"), 3.0], [5.0, 5.0, 5.0])


def test_one_long_series_streams_through_small_batches(spark):
    # one series far longer than any calendar, folded through 1,000-row Arrow
    # batches: state crosses 100 batch edges and the result ekeeps the rules
    n = 100_000
    rnd = random.Random(9)
    units = [float(rnd.randint(0, 70)) for _ in range(n)]
    pdf_units = spark.createDataFrame([(i, u) for i, u in enumerate(units)], "id long, u double")
    df = (spark.range(n).join(pdf_units, "id")
          .select(F.date_add(F.lit("1700-01-01").cast("date"), F.col("id").cast("int"))
                  .alias("date"), F.lit("hot").alias("store_id"), F.lit("item").alias("item_id"),
                  F.col("u").alias("units_sold"), F.lit(20.0).alias("forecast_units")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = (project_stock(df).select("date", "opening_stock", "replenished_qty")
               .orderBy("date").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert_openings([r.opening_stock for r in got], [r.replenished_qty for r in got], units)
