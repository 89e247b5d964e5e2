"""Counts on the smallest test scale, as listed in the survey's anchor table."""
import os

import pytest
from pyspark.sql import functions as F

from retail_signals.plans import queries as Q
from retail_signals.operators.rules import ANOMALY_COLUMNS, detect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_anchor_counts(spark):
    led = Q.ledger(spark, SF)
    stats = led.agg(F.count("*").alias("rows"),
                    F.countDistinct("store_id", "item_id").alias("series"),
                    F.sum("stockout_flag").alias("stockouts"),
                    F.sum(F.when(F.col("replenished_qty") > 0, 1).otherwise(0)).alias("arrivals")
                    ).first()
    assert (stats.rows, stats.series, stats.stockouts, stats.arrivals) == (5895, 60, 850, 1091)
    counts = {r.rule_name: r["count"] for r in
              detect(led).select(*ANOMALY_COLUMNS).groupBy("rule_name").count().collect()}
    assert counts == {"demand_spike": 700, "demand_drop": 1324, "low_inventory": 1655,
                      "fulfillment_drop": 799, "missing_price": 1627}
    ids = detect(led).select("anomaly_id")
    assert ids.count() == ids.distinct().count() == 6105
