import datetime as dt
import hashlib

from pyspark.sql import functions as F

from retail_signals import (SignalConfig, demand_spikes, detect, project_stock, union_rules,
                            with_baseline)
from retail_signals.functions.ids import anomaly_id
from retail_signals.operators.rules import ANOMALY_COLUMNS

GOLDEN_ID = "6ed306fc43debfdde5769e5660e04febfc9bf0f4a5131e8a79420c24423ea2fe"


def test_anomaly_id_golden(spark):
    df = spark.createDataFrame([(dt.date(2016, 2, 7), "CA_1", "FOODS_1_001")],
                               "date date, store_id string, item_id string")
    assert df.select(anomaly_id("demand_spike")).first()[0] == GOLDEN_ID
    text = "demand_spike|2016-02-07|CA_1|FOODS_1_001"
    assert hashlib.sha256(text.encode()).hexdigest() == GOLDEN_ID


def _series(spark, units, prices=None):
    d0 = dt.date(2016, 1, 1)
    prices = prices or [1.0] * len(units)
    return spark.createDataFrame(
        [(d0 + dt.timedelta(days=i), "s", "i", u, p) for i, (u, p) in enumerate(zip(units, prices))],
        "date date, store_id string, item_id string, units_sold double, price double")


def test_strict_limits_do_not_fire(spark):
    # baseline 10: units exactly 18 (1.8x) and 4.5 (0.45x) are not anomalies
    df = with_baseline(_series(spark, [10.0] * 14 + [18.0]))
    assert demand_spikes(df).count() == 0
    df = with_baseline(_series(spark, [10.0] * 14 + [4.5]))
    assert df.filter(F.col("units_sold") < F.col("rolling_mean") * 0.45).count() == 0
    # fulfilment exactly 0.90 is not a drop
    led = spark.createDataFrame([(dt.date(2016, 1, 1), "s", "i", 0.9, 100, 1.0)],
                                "date date, store_id string, item_id string, fulfillment_rate "
                                "double, closing_stock int, forecast_units double")
    from retail_signals import fulfillment_drops
    assert fulfillment_drops(led).count() == 0


def test_one_row_several_rules(spark):
    units = [10.0] * 14 + [500.0]
    led = project_stock(with_baseline(_series(spark, units, [1.0] * 14 + [None])),
                        partitioned_by_series=True)
    last = detect(led).filter(F.col("date") == dt.date(2016, 1, 15)).collect()
    rules = sorted(r.rule_name for r in last)
    assert rules == ["demand_spike", "fulfillment_drop", "low_inventory", "missing_price"]
    assert len({r.anomaly_id for r in last}) == 4


def test_fused_equals_union(spark):
    import random
    rnd = random.Random(11)
    rows = []
    d0 = dt.date(2016, 1, 1)
    for s in range(4):
        for i in range(50):
            rows.append((d0 + dt.timedelta(days=i), f"s{s}", "i",
                         float(rnd.choice([0, 5, 10, 20, 60])), rnd.choice([1.0, None])))
    demand = spark.createDataFrame(rows, "date date, store_id string, item_id string, "
                                         "units_sold double, price double")
    base = with_baseline(demand)
    led = project_stock(base, partitioned_by_series=True)
    fused = detect(led).select(*ANOMALY_COLUMNS)
    union = union_rules(base, led)
    assert fused.count() == union.count() > 0
    assert fused.exceptAll(union).count() == 0 and union.exceptAll(fused).count() == 0


def test_config_thresholds_apply(spark):
    df = with_baseline(_series(spark, [10.0] * 14 + [15.0]))
    assert demand_spikes(df, SignalConfig(spike_multiplier=1.4)).count() == 1
