"""Registered queries over the test tables (see ``__spark_entry__``).

Each takes (spark, sf_dir) and returns a DataFrame over the whole tables. The
daily facts, and the ledger where two branches need it, are written first as
Parquet tables in the checkpoint folder, so building a query starts those jobs.
"""
from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SignalConfig
from ..operators.baseline import attach_forecast, build_forecast, with_baseline
from ..operators.demand import SERIES_KEYS, attach_calendar, build_demand, enrich_demand, unpivot_days
from ..operators.diagnose import candidate_rows, diagnose_all, diagnose_ids, diagnose_one, top_anomaly
from ..operators.recommend import latest_rows, recommend
from ..operators.rules import (ANOMALY_COLUMNS, demand_drops, demand_spikes, detect,
                               fulfillment_drops, low_inventory, missing_prices, union_rules)
from ..operators.stock import inventory_table
from ..session import checkpoint_dir, materialize
from ..sources import testdata
from ..sources.files import CALENDAR_FILE, PRICES_FILE, SALES_FILE, read_raw_inputs, read_table, rejected_raw
from ..sources.layout import materialize_by_series, read_by_series, write_by_series
from .jobs import DIAGNOSIS_TEXT, LEDGER_STAGE, build_all, ledger_from_demand, run_diagnosis
from .runs import manifest, run_set

CFG = SignalConfig()
DIAGNOSIS = ("anomaly_id", "best_candidate", "best_score", "explanation")


def demand(spark: SparkSession, sf: str) -> DataFrame:
    sales, calendar, prices = testdata.inputs(spark, sf)
    return enrich_demand(sales, calendar, prices)


def dated_units(spark: SparkSession, sf: str) -> DataFrame:
    """Dated sales without prices: all that the baseline and its rules read."""
    sales, calendar, _ = testdata.inputs(spark, sf)
    return attach_calendar(sales, calendar).select("date", "store_id", "item_id", "units_sold")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_from_demand(demand(spark, sf), CFG)


def _stored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(anomalies, inventory, recommendations) from one materialised ledger."""
    anomalies, inventory = _ledger_outputs(spark, sf)
    return anomalies, inventory, recommend(anomalies, inventory, CFG, partitioned_by_series=True)


def _ledger_outputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(anomalies, inventory) from one ledger stored by series."""
    led = materialize_by_series(ledger(spark, sf))
    return detect(led, CFG).select(*ANOMALY_COLUMNS), inventory_table(led)


def _diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    """Diagnosis of every anomaly, recommendations computed in-row."""
    return diagnose_all(*_ledger_outputs(spark, sf), None, CFG, partitioned_by_series=True)


def q_demand_unpivot(spark, sf):
    return unpivot_days(testdata.wide_sales(spark, sf)).select(
        "store_id", "item_id", "state_id", "dept_id", "cat_id", "d", "units_sold")


def q_demand_timeseries(spark, sf):
    return demand(spark, sf)


def q_forecast_rolling_mean(spark, sf):
    return build_forecast(dated_units(spark, sf), CFG.window_rows)


def _lacking():
    return F.pmod(F.floor(F.datediff(F.col("date"), F.lit("1995-01-01").cast("date")) / 7), F.lit(3)) == 0


def q_forecast_attach(spark, sf):
    """An outside forecast that lacks every third week: those days fall back to
    the day's units."""
    d = materialize(dated_units(spark, sf))
    known = build_forecast(d, CFG.window_rows).filter(~_lacking())
    return attach_forecast(d, known).select("date", "store_id", "item_id", "units_sold", "forecast_units")


def q_stock_projection(spark, sf):
    return inventory_table(ledger(spark, sf))


def q_rule_demand_spike(spark, sf):
    return demand_spikes(with_baseline(dated_units(spark, sf), CFG.window_rows), CFG)


def q_rule_demand_drop(spark, sf):
    return demand_drops(with_baseline(dated_units(spark, sf), CFG.window_rows), CFG)


def q_rule_low_inventory(spark, sf):
    return low_inventory(ledger(spark, sf), CFG)


def q_rule_fulfillment_drop(spark, sf):
    return fulfillment_drops(ledger(spark, sf), CFG)


def q_rule_missing_price(spark, sf):
    return missing_prices(demand(spark, sf), CFG)


def q_anomalies_all(spark, sf):
    led = materialize(ledger(spark, sf))
    return union_rules(led, led, CFG)


def q_anomalies_fused(spark, sf):
    return detect(ledger(spark, sf), CFG).select(*ANOMALY_COLUMNS)


def q_latest_inventory(spark, sf):
    return latest_rows(inventory_table(ledger(spark, sf)))


def q_recommendations(spark, sf):
    return _stored(spark, sf)[2]


def q_top_anomaly(spark, sf):
    return top_anomaly(detect(ledger(spark, sf), CFG).select(*ANOMALY_COLUMNS))


def q_diagnosis_context(spark, sf):
    return _diagnosis(spark, sf).select("anomaly_id", "context_text", "recommendation_lines")


def q_diagnosis_root_cause(spark, sf):
    return _diagnosis(spark, sf).select("anomaly_id", "rule_name", "root_cause")


def q_diagnosis_candidates(spark, sf):
    return (candidate_rows(*_ledger_outputs(spark, sf), None, CFG, partitioned_by_series=True)
            .select("anomaly_id", "round", "candidate_name", "score",
                    F.array_join("score_notes", "; ").alias("score_notes"), "response"))


def q_diagnosis_best(spark, sf):
    return _diagnosis(spark, sf).select("anomaly_id", "best_candidate", "best_score",
                                        "explanation")


def q_diagnosis_top(spark, sf):
    """The one-anomaly use: the top anomaly of the fused stream, then the fold of
    its series alone for its context and its recommendation."""
    rows = demand(spark, sf)
    top = top_anomaly(detect(ledger_from_demand(rows, CFG), CFG).select(*ANOMALY_COLUMNS))
    found = top.collect()
    series = F.lit(False)
    for row in found:
        series = F.col("store_id").eqNullSafe(row["store_id"]) & F.col("item_id").eqNullSafe(row["item_id"])
    inventory = inventory_table(ledger_from_demand(rows.filter(series), CFG))
    return diagnose_one(spark.createDataFrame(found, top.schema), inventory, None).select(*DIAGNOSIS)


def _written(spark: SparkSession, sf: str) -> tuple[str, dict[str, str]]:
    """All tables of a run over the test inputs, published as one set."""
    out = f"{checkpoint_dir(spark)}/retail_signals/{uuid4().hex}"
    return out, run_set(spark, *testdata.inputs(spark, sf), out, "run", CFG, long_form=True)


def q_diagnosis_by_id(spark, sf):
    """Lookups in the stored tables: the latest anomaly of each rule by its id."""
    out, _ = _written(spark, sf)
    anomalies, inventory, recs = (read_table(spark, out, n) for n in (
        "validation_logs", "inventory_fulfillment", "recommendations"))
    latest = anomalies.groupBy("rule_name").agg(F.max(F.struct("date", "anomaly_id")).alias("last")).collect()
    return diagnose_ids(anomalies, inventory, recs, [r["last"]["anomaly_id"] for r in latest], CFG).select(*DIAGNOSIS)


def q_diagnosis_job(spark, sf):
    """The diagnosis job over a published run, with its stored table read back."""
    out, _ = _written(spark, sf)
    return run_diagnosis(spark, out, all_anomalies=True).select(*DIAGNOSIS)


def q_diagnosis_report(spark, sf):
    """The report file of the top anomaly, as written and read back."""
    out, _ = _written(spark, sf)
    run_diagnosis(spark, out, f"{out}/report")
    return spark.read.text(f"{out}/report/{DIAGNOSIS_TEXT}", wholetext=True).select(F.col("value").alias("report"))


def q_diagnosis_stored(spark, sf):
    """Every anomaly, with its recommendations joined from their table."""
    anomalies, inventory, recommendations = _stored(spark, sf)
    stored = materialize_by_series(recommendations)
    return diagnose_all(anomalies, inventory, stored, CFG, partitioned_by_series=True).select(
        "anomaly_id", "best_candidate", "best_score", "explanation")


def q_diagnosis_rounds(spark, sf):
    """The ``rounds`` record of every anomaly as text: number, candidate, system
    prompt, score, notes and response of each round."""
    line = F.transform("rounds", lambda r: F.concat_ws(
        " | ", r["round"].cast("string"), r["candidate_name"], r["system_prompt"],
        r["score"].cast("string"), F.array_join(r["score_notes"], "; "), r["response"]))
    return _diagnosis(spark, sf).select("anomaly_id", F.array_join(line, "\n").alias("rounds_text"))


def _csv_inputs(spark: SparkSession, sf: str, prices_line=None) -> str:
    """The three inputs as CSV folders; ``prices_line`` makes the price cells."""
    raw = f"{checkpoint_dir(spark)}/retail_signals/{uuid4().hex}"
    daily = testdata.stored_daily(spark, sf)
    _, calendar, prices = testdata.inputs(spark, sf, daily)
    wide = testdata.wide_sales(spark, sf, daily)
    if prices_line is not None:
        prices = prices.withColumn("sell_price", prices_line)
    for name, df in ((SALES_FILE, wide), (CALENDAR_FILE, calendar), (PRICES_FILE, prices)):
        df.write.option("header", True).csv(f"{raw}/{name}")
    return raw


def q_demand_from_csv(spark, sf):
    """The CSV path: wide sales, calendar and prices written as CSV into the
    checkpoint folder, read by the typed readers, built into the demand table:
    a row for each series and day, with null units where nothing was sold."""
    return build_demand(*read_raw_inputs(spark, _csv_inputs(spark, sf)))


def q_rejected_raw(spark, sf):
    """Prices of every eleventh week written as ``n/a``: the lines that lenient
    reading rejects."""
    faulty = F.when(F.col("wm_yr_wk") % 11 == 0, F.lit("n/a")).otherwise(F.col("sell_price").cast("string"))
    return rejected_raw(spark, _csv_inputs(spark, sf, faulty)).select("source", "raw")


def _rows_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all tables of a run in common columns, one table under another."""
    none = F.lit(None)
    shown = {
        "processed_demand": ("d", "units_sold", "price", "event_name_1"),
        "rejected_demand": ("d", "units_sold", "price", "event_name_1"),
        "forecast": (none, "forecast_units", none, none),
        "inventory_fulfillment": (F.col("stockout_flag").cast("string"), "opening_stock", "closing_stock", "state_id"),
        "validation_logs": ("rule_name", "metric_value", "expected_value", "anomaly_id"),
        "recommendations": ("action_type", none, none, "recommendation"),
    }
    found = None
    for name, (label, first, second, text) in shown.items():
        col = lambda c: F.col(c) if isinstance(c, str) else c
        part = tables[name].select(
            F.lit(name).alias("table_name"), "date", "store_id", "item_id", col(label).cast("string").alias("label"),
            col(first).cast("double").alias("value_1"), col(second).cast("double").alias("value_2"),
            col(text).cast("string").alias("text"))
        found = part if found is None else found.unionByName(part)
    return found


def q_pipeline_tables(spark, sf):
    """The whole job, published as one set: rows of every written table, read back."""
    _, paths = _written(spark, sf)
    return _rows_of({name: spark.read.parquet(path) for name, path in paths.items()})


def q_build_all(spark, sf):
    """The same tables as lazy frames, nothing of them written."""
    built = build_all(*testdata.inputs(spark, sf), CFG, long_form=True)
    return _rows_of({"processed_demand": built.demand, "rejected_demand": built.rejected,
                     "forecast": built.forecast, "inventory_fulfillment": built.inventory,
                     "validation_logs": built.anomalies, "recommendations": built.recommendations})


def q_demand_figures(spark, sf):
    """Figures that a run observes while it writes, on inputs with planted gaps:
    no calendar row for every 13th day, two prices in every tenth week."""
    sales, calendar, prices = testdata.inputs(spark, sf)
    day = F.regexp_extract("d", "[0-9]+$", 0).cast("int")
    calendar = calendar.filter(day % 13 != 0)
    prices = prices.unionByName(prices.filter(F.col("wm_yr_wk") % 10 == 0).withColumn("sell_price", F.lit(1.0)))
    out = f"{checkpoint_dir(spark)}/retail_signals/{uuid4().hex}"
    run_set(spark, sales, calendar, prices, out, "run", CFG, long_form=True, stop_after=LEDGER_STAGE)
    figures = manifest(spark, out, "run")["figures"]
    return spark.createDataFrame(sorted(figures.items()), "figure string, value long")


def q_settings(spark, sf):
    """Anomalies and their actions under settings other than the defaults."""
    cfg = SignalConfig(window_rows=7, spike_multiplier=2.5, drop_multiplier=0.3, low_cover_days=2.0,
                       min_fulfillment_rate=0.75, restock_cover_days=5.0)
    led = materialize_by_series(ledger_from_demand(demand(spark, sf), cfg))
    anomalies = detect(led, cfg).select(*ANOMALY_COLUMNS)
    actions = recommend(anomalies, inventory_table(led), cfg, partitioned_by_series=True, keep=ANOMALY_COLUMNS[4:])
    return actions.select(*ANOMALY_COLUMNS, "action_type", "recommendation")


def q_actions_by_series(spark, sf):
    """Recommendations and diagnosis over tables stored by series."""
    folder = f"{checkpoint_dir(spark)}/retail_signals/{uuid4().hex}"
    tables = dict(zip(("anomalies", "inventory"), _ledger_outputs(spark, sf)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anomalies, inventory = (read_by_series(spark, write_by_series(df, f"{folder}/{name}", buckets, dealt=True))
                            for name, df in tables.items())
    acted = ("action_type", "recommendation")
    actions = recommend(anomalies, inventory, CFG, partitioned_by_series=True, keep=ANOMALY_COLUMNS[4:])
    texts = diagnose_all(actions, inventory, None, CFG, partitioned_by_series=True, keep=acted)
    return texts.select("anomaly_id", *SERIES_KEYS, *acted, "best_candidate", "explanation")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "demand_unpivot": q_demand_unpivot,
    "demand_timeseries": q_demand_timeseries,
    "forecast_rolling_mean": q_forecast_rolling_mean,
    "forecast_attach": q_forecast_attach,
    "stock_projection": q_stock_projection,
    "rule_demand_spike": q_rule_demand_spike,
    "rule_demand_drop": q_rule_demand_drop,
    "rule_low_inventory": q_rule_low_inventory,
    "rule_fulfillment_drop": q_rule_fulfillment_drop,
    "rule_missing_price": q_rule_missing_price,
    "anomalies_all": q_anomalies_all,
    "anomalies_fused": q_anomalies_fused,
    "latest_inventory": q_latest_inventory,
    "recommendations": q_recommendations,
    "top_anomaly": q_top_anomaly,
    "diagnosis_context": q_diagnosis_context,
    "diagnosis_root_cause": q_diagnosis_root_cause,
    "diagnosis_candidates": q_diagnosis_candidates,
    "diagnosis_best": q_diagnosis_best,
    "diagnosis_top": q_diagnosis_top,
    "diagnosis_stored": q_diagnosis_stored,
    "diagnosis_rounds": q_diagnosis_rounds,
    "diagnosis_by_id": q_diagnosis_by_id,
    "diagnosis_job": q_diagnosis_job,
    "diagnosis_report": q_diagnosis_report,
    "demand_from_csv": q_demand_from_csv,
    "rejected_raw": q_rejected_raw,
    "demand_figures": q_demand_figures,
    "other_settings": q_settings,
    "actions_by_series": q_actions_by_series,
    "build_all": q_build_all,
    "pipeline_tables": q_pipeline_tables,
}
