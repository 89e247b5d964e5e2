"""Anomaly rules over the demand baseline and the stock ledger.

Each rule is public on its own (filter + projection, as a user would write
it); :func:`detect` evaluates all five in one pass over a ledger that carries
the baseline and the price, emitting one row per broken rule with a single
Generate instead of a five-way union that would re-read its inputs.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SignalConfig
from ..functions.ids import anomaly_id
from ..vocabulary import (RULE_DEMAND_DROP, RULE_DEMAND_SPIKE, RULE_FULFILLMENT_DROP,
                          RULE_LOW_INVENTORY, RULE_MISSING_PRICE, RULES)

ANOMALY_COLUMNS = ("anomaly_id", "date", "store_id", "item_id", "rule_name", "severity",
                   "metric_value", "expected_value", "details")


def _rule_parts(cfg: SignalConfig) -> list[tuple[str, Column, Column, Column]]:
    """(rule, predicate, metric_value, expected_value) for the five rules, in order.

    Comparisons are strict. The spike/drop baseline is ``rolling_mean``; the
    stock rules read the ledger's forecast (after zero forecasts were replaced).
    """
    units, mean = F.col("units_sold"), F.col("rolling_mean")
    cover = F.col("forecast_units") * F.lit(cfg.low_cover_days)
    return [
        (RULE_DEMAND_SPIKE, mean.isNotNull() & (units > mean * F.lit(cfg.spike_multiplier)),
         units, mean),
        (RULE_DEMAND_DROP, mean.isNotNull() & (units < mean * F.lit(cfg.drop_multiplier)),
         units, mean),
        (RULE_LOW_INVENTORY, F.col("closing_stock") < cover,
         F.col("closing_stock").cast("double"), cover),
        (RULE_FULFILLMENT_DROP, F.col("fulfillment_rate") < F.lit(cfg.min_fulfillment_rate),
         F.col("fulfillment_rate"), F.lit(cfg.min_fulfillment_rate)),
        (RULE_MISSING_PRICE, F.col("price").isNull(), F.lit(None).cast("double"),
         F.lit(None).cast("double")),
    ]


def _project(df: DataFrame, rule: str, metric: Column, expected: Column) -> DataFrame:
    severity, details = RULES[rule]
    return df.select(anomaly_id(rule).alias("anomaly_id"), "date", "store_id", "item_id",
                     F.lit(rule).alias("rule_name"), F.lit(severity).alias("severity"),
                     metric.cast("double").alias("metric_value"),
                     expected.cast("double").alias("expected_value"),
                     F.lit(details).alias("details"))


def _one_rule(df: DataFrame, rule: str, cfg: SignalConfig) -> DataFrame:
    for name, pred, metric, expected in _rule_parts(cfg):
        if name == rule:
            return _project(df.filter(pred), rule, metric, expected)
    raise KeyError(rule)


def demand_spikes(baseline: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Units above ``spike_multiplier`` x the trailing mean (needs rolling_mean)."""
    return _one_rule(baseline, RULE_DEMAND_SPIKE, cfg)


def demand_drops(baseline: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Units below ``drop_multiplier`` x the trailing mean (needs rolling_mean)."""
    return _one_rule(baseline, RULE_DEMAND_DROP, cfg)


def low_inventory(ledger: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Closing stock below ``low_cover_days`` x the ledger forecast."""
    return _one_rule(ledger, RULE_LOW_INVENTORY, cfg)


def fulfillment_drops(ledger: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Fulfilment rate below ``min_fulfillment_rate``."""
    return _one_rule(ledger, RULE_FULFILLMENT_DROP, cfg)


def missing_prices(demand: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Demand rows without a price for their week."""
    return _one_rule(demand, RULE_MISSING_PRICE, cfg)


def union_rules(baseline: DataFrame, ledger: DataFrame,
                cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """The five rules as separate branches, appended by name (duplicates kept)."""
    parts = [demand_spikes(baseline, cfg), demand_drops(baseline, cfg), low_inventory(ledger, cfg),
             fulfillment_drops(ledger, cfg), missing_prices(baseline, cfg)]
    return reduce(DataFrame.unionByName, parts)


def detect(ledger: DataFrame, cfg: SignalConfig = SignalConfig(), keep: tuple[str, ...] = ()
           ) -> DataFrame:
    """All five rules in one pass over a ledger carrying units_sold,
    rolling_mean and price.

    Each row yields an array of the rules it breaks (a predicate that is null,
    e.g. on the first row of a series, counts as not broken); ``inline`` turns
    the array into rows, and those of rules not broken are left out. ``keep`` names extra ledger columns to carry along.
    """
    hits = []
    for rule, pred, metric, expected in _rule_parts(cfg):
        severity, details = RULES[rule]
        hits.append(F.when(F.coalesce(pred, F.lit(False)), F.struct(
            F.lit(rule).alias("rule_name"), F.lit(severity).alias("severity"),
            metric.cast("double").alias("metric_value"),
            expected.cast("double").alias("expected_value"),
            F.lit(details).alias("details"))))
    # No lambda (it would keep the pass from being compiled); the outer form spares
    # the filter that Spark infers, a second evaluation of the rules.
    exploded = ledger.select("date", "store_id", "item_id", *keep, F.inline_outer(F.array(*hits)))
    return exploded.filter(F.col("rule_name").isNotNull()).select(anomaly_id(F.col("rule_name")).alias("anomaly_id"),
                           *ANOMALY_COLUMNS[1:], *keep)
