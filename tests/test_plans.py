"""Plan shapes that the design relies on, read from ``explain`` output."""
import datetime as dt
import re

import pytest

from retail_signals import SignalConfig, detect
from retail_signals.plans.jobs import check_inputs, ledger_from_demand

DEMAND = ("date date, d string, store_id string, state_id string, item_id string, "
          "dept_id string, cat_id string, units_sold double, price double, "
          "event_name_1 string, event_type_1 string, is_promo int")


def _plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


def test_one_exchange_from_demand_to_anomalies(spark, capsys):
    d0 = dt.date(2016, 1, 1)
    demand = spark.createDataFrame(
        [(d0 + dt.timedelta(days=k), f"d_{k}", f"s{s}", "st", "i", "dep", "c", float(k % 9), 1.0,
          None, None, 0) for s in range(3) for k in range(20)], DEMAND)
    plan = _plan(detect(ledger_from_demand(demand, SignalConfig())), capsys)
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert len(exchanges) == 1, plan
    kind, keys = exchanges[0]
    assert kind == "hashpartitioning" and "store_id" in keys and "item_id" in keys
    assert "date" not in keys
    assert plan.count("Sort [") == 1, plan          # the window's sort serves the fold too
    assert "MapInArrow" in plan and "Window" in plan
    assert plan.count("Generate") == 1              # five rules, one pass
    assert "Union" not in plan


def test_sales_are_exchanged_once(spark, capsys):
    """From sales and prices to anomalies, with no broadcast: the sales and the
    prices are dealt out once each, by series; duplicate prices still fan out."""
    from retail_signals.operators.demand import enrich_demand
    d0 = dt.date(2016, 1, 1)
    sales = spark.createDataFrame(
        [(f"s{s}", "i", "st", "dep", "c", f"d_{k}", float(k % 9)) for s in range(3) for k in range(20)],
        "store_id string, item_id string, state_id string, dept_id string, cat_id string, d string, units_sold double")
    cal = spark.createDataFrame([(f"d_{k}", d0 + dt.timedelta(days=k), k // 7, None, None) for k in range(20)],
                                "d string, date date, wm_yr_wk int, event_name_1 string, event_type_1 string")
    prices = spark.createDataFrame([("s0", "i", 0, 1.0), ("s0", "i", 0, 2.0), ("s1", "i", 1, 3.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1"}  # all else at Spark's defaults
    plain = sorted(enrich_demand(sales, cal, prices).collect(), key=str)
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        demand = enrich_demand(sales, cal, prices)
        assert sorted(demand.collect(), key=str) == plain and len(plain) == 67
        plan = _plan(detect(ledger_from_demand(demand, SignalConfig())), capsys)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("store_id" in k for k in keys) == 2, plan      # sales and prices, once each
    assert not any("wm_yr_wk" in k for k in keys), plan
    assert sum(k.startswith("d#") for k in keys) == 2, plan   # the calendar join, broadcast as a rule


def test_sales_key_check(spark):
    sales = spark.createDataFrame([("s", "i", "d_1"), ("s", "i", "d_1")],
                                  "store_id string, item_id string, d string")
    cal = spark.createDataFrame([("d_1",)], "d string")
    prices = spark.createDataFrame([("s", "i", 1)], "store_id string, item_id string, wm_yr_wk int")
    with pytest.raises(ValueError, match="sales: keys"):
        check_inputs(sales, cal, prices, long_form=True)
    check_inputs(sales.limit(1), cal, prices, long_form=True)


def test_one_anomaly_reads_only_its_rows(spark, capsys, tmp_path):
    from pyspark.sql import functions as F

    from retail_signals import diagnose_one
    from retail_signals.functions.ids import anomaly_id
    d0 = dt.date(2016, 1, 1)
    an = spark.createDataFrame(
        [(d0, f"s{s}", "i", "demand_spike", "high", 9.0, 3.0, "x") for s in range(4)],
        "date date, store_id string, item_id string, rule_name string, severity string, "
        "metric_value double, expected_value double, details string")
    an = an.select(anomaly_id(F.col("rule_name")).alias("anomaly_id"), "*")
    inv = spark.createDataFrame(
        [(d0 + dt.timedelta(days=k), f"s{s}", "i", 5, 2.0, "D", "C") for s in range(4)
         for k in range(5)],
        "date date, store_id string, item_id string, closing_stock int, forecast_units double, "
        "dept_id string, cat_id string")
    for name, df in (("an", an), ("inv", inv)):
        df.write.parquet(str(tmp_path / name))
    an_r, inv_r = (spark.read.parquet(str(tmp_path / n)) for n in ("an", "inv"))
    chosen = an_r.filter(F.col("store_id") == "s2").first().anomaly_id
    plan = _plan(diagnose_one(an_r, inv_r, None, chosen), capsys)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(anomaly_id,", plan), plan
    assert re.search(r"PushedFilters: \[[^\]]*store_id", plan), plan
    assert "WindowGroupLimit" in plan
