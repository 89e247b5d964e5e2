"""Recommended actions: one per anomaly and action type, sized from the
latest ledger row of the anomaly's series."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SignalConfig
from ..vocabulary import (ACTION_BY_RULE, ACTION_OTHERWISE, SENTENCE_BY_RULE, SENTENCE_COLUMNS,
                          SENTENCE_OTHERWISE)
from .demand import SERIES_KEYS

RECOMMENDATION_COLUMNS = ("anomaly_id", "date", "store_id", "item_id", "action_type",
                          "recommendation")


def latest_rows(inventory: DataFrame) -> DataFrame:
    """The latest row (highest date) of every series.

    ``row_number() = 1`` over date descending: Spark plans it with a partial
    top-1 per task before the shuffle (WindowGroupLimit), so only about one row
    per series and task crosses the network.
    """
    w = Window.partitionBy(*SERIES_KEYS).orderBy(F.col("date").desc())
    return (inventory.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def action_type(rule: Column | None = None) -> Column:
    rule = F.col("rule_name") if rule is None else rule
    expr = None
    for name, action in ACTION_BY_RULE.items():
        expr = (F.when(rule == name, F.lit(action)) if expr is None
                else expr.when(rule == name, F.lit(action)))
    return expr.otherwise(F.lit(ACTION_OTHERWISE))


def restock_units(cfg: SignalConfig = SignalConfig()) -> Column:
    """Units that restore ``restock_cover_days`` of forecast cover, at least 0;
    a series without a ledger row gives 0 (``greatest`` skips the null)."""
    gap = F.ceil(F.col("forecast_units") * F.lit(cfg.restock_cover_days) - F.col("closing_stock"))
    return F.greatest(F.lit(0.0), gap).cast("int")


def _sentence(pieces: tuple, qty: Column, cfg: SignalConfig) -> Column:
    cover = f"{cfg.restock_cover_days:g}"
    parts = [qty if p is None else (F.col(p) if p in SENTENCE_COLUMNS else F.lit(p.format(cover=cover)))
             for p in pieces]
    return F.concat_ws(" ", *parts)


def recommendation_text(cfg: SignalConfig = SignalConfig(), rule: Column | None = None
                        ) -> Column:
    """The sentence for a rule; null pieces (e.g. an unknown category) drop out."""
    rule = F.col("rule_name") if rule is None else rule
    qty = restock_units(cfg)
    expr = None
    for name, pieces in SENTENCE_BY_RULE.items():
        text = _sentence(pieces, qty, cfg)
        expr = F.when(rule == name, text) if expr is None else expr.when(rule == name, text)
    return expr.otherwise(_sentence(SENTENCE_OTHERWISE, qty, cfg))


def recommend(anomalies: DataFrame, inventory: DataFrame, cfg: SignalConfig = SignalConfig(),
              partitioned_by_series: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """anomalies LEFT JOIN latest inventory row on (store, item) -> actions.

    The action type depends on the rule alone and the id on date, series and
    rule, so equal narrow rows are the duplicates. They are removed on the
    partitioning by series, which the join with the latest rows reuses; with
    ``partitioned_by_series`` (tables of ``read_by_series``) that is the stored one.
    ``keep`` names further columns of the anomalies to carry along; then every row
    of ``anomalies`` comes out with its action, as a join by id would give, without one.
    """
    latest = latest_rows(inventory).select(
        *SERIES_KEYS, F.col("date").alias("latest_date"), "closing_stock", "forecast_units",
        "dept_id", "cat_id")
    carried = [c for c in keep if c != "rule_name"]
    base = (anomalies.select("anomaly_id", "date", *SERIES_KEYS, "rule_name", *carried)
            .withColumn("action_type", action_type()))
    base = base if partitioned_by_series else base.repartition(*SERIES_KEYS)
    base = base if keep else base.distinct()
    # One row for each series, hashed by task: the actions need no sort.
    return (base.join(latest.hint("shuffle_hash"), on=list(SERIES_KEYS), how="left")
            .select("anomaly_id", "date", *SERIES_KEYS, *keep, "action_type",
                    recommendation_text(cfg).alias("recommendation")))
