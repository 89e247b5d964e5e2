"""retail_signals: retail demand signals as composable Spark DataFrame jobs.

demand -> trailing-mean baseline/forecast -> stock ledger -> anomalies ->
recommendations -> diagnosis, each a DataFrame-to-DataFrame function that runs
on the caller's SparkSession.
"""
from .config import SignalConfig, StockPolicy
from .operators.baseline import attach_forecast, build_forecast, with_baseline
from .operators.demand import build_demand, day_columns, enrich_demand, unpivot_days
from .operators.diagnose import diagnose_all, diagnose_ids, diagnose_one, top_anomaly, top_anomaly_id
from .operators.recommend import latest_rows, recommend
from .operators.rules import (demand_drops, demand_spikes, detect, fulfillment_drops,
                              low_inventory, missing_prices, union_rules)
from .operators.stock import inventory_table, project_stock
from .plans.jobs import Tables, build_all, run_diagnosis, run_pipeline, run_tables
from .plans.runs import run_set

__all__ = [
    "SignalConfig", "StockPolicy", "Tables", "attach_forecast", "build_all", "build_demand",
    "build_forecast", "day_columns", "demand_drops", "demand_spikes", "detect", "diagnose_all",
    "diagnose_ids", "diagnose_one", "enrich_demand", "fulfillment_drops", "inventory_table", "latest_rows",
    "low_inventory", "missing_prices", "project_stock", "recommend", "run_diagnosis",
    "run_pipeline", "run_set", "run_tables", "top_anomaly", "top_anomaly_id", "union_rules",
    "unpivot_days", "with_baseline",
]
