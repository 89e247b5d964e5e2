"""Job-level API: compose the operators, or run them end to end with writes.

Everything here takes the caller's SparkSession and never stops it.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SignalConfig
from ..operators.baseline import repeats_date, with_baseline
from ..operators.demand import SERIES_KEYS, build_demand, enrich_demand
from ..operators.diagnose import diagnose_all, diagnose_one
from ..operators.long_series import long_ledger, series_sizes
from ..operators.recommend import recommend
from ..operators.rules import ANOMALY_COLUMNS, detect
from ..operators.stock import inventory_table, project_stock
from ..functions.checks import assert_unique
from ..functions.watch import DemandWatch
from ..session import materialize, remove, write_text
from ..sources.files import (LEDGER_STAGE, read_raw_inputs, read_table, read_tables_by_series, rejected_raw, table_path,
                             write_table)
from ..sources.layout import read_by_series

DIAGNOSIS_TABLE = "diagnosis"
DIAGNOSIS_TEXT = "diagnosis_report.txt"


@dataclass(frozen=True)
class Tables:
    demand: DataFrame
    forecast: DataFrame
    inventory: DataFrame
    anomalies: DataFrame
    recommendations: DataFrame
    rejected: DataFrame


# Demand columns the ledger, the rules and the recommendations read; the rest
# (day label, events, promo flag) is not shipped through the Python fold.
LEDGER_INPUT = ("date", "store_id", "state_id", "item_id", "dept_id", "cat_id", "units_sold",
                "price")


def _usable():
    keyed = F.col("date").isNotNull()
    for key in SERIES_KEYS:
        keyed = keyed & F.col(key).isNotNull()
    return keyed


def rejected_demand(demand: DataFrame) -> DataFrame:
    """Demand rows without a date (their day is in no calendar row) or without a
    store or item: a ledger needs a date order and a series, and their anomaly
    ids would collide."""
    return demand.filter(~_usable())


def ledger_from_demand(demand: DataFrame, cfg: SignalConfig = SignalConfig(),
                       watch: DemandWatch | None = None) -> DataFrame:
    """Baseline window and stock fold over one exchange by series.

    The result carries units_sold, price, ``rolling_mean`` and the ledger
    columns, which is all the rules need in one pass. Only those columns go
    through the fold: Spark cannot prune columns across the Python operator,
    so the projection is made before it. Rows of :func:`rejected_demand` are
    left out here, so every entry point treats them alike.
    """
    based = with_baseline(demand.filter(_usable()).select(*LEDGER_INPUT), cfg.window_rows)
    if watch is not None and watch.on:
        based = watch.ledger(based.withColumn("_repeated", repeats_date()), F.col("_repeated")).drop("_repeated")
    return project_stock(based, cfg.policy, partitioned_by_series=True)


def ledger_from_stored(demand: DataFrame, cfg: SignalConfig = SignalConfig(),
                       watch: DemandWatch | None = None) -> DataFrame:
    """As :func:`ledger_from_demand`, for a stored demand table: one count finds
    the series with over ``cfg.segment_rows`` rows, which are folded in segments
    by several tasks; without any, the plan is that of the plain ledger. (Figures
    of repeated dates cover the plainly folded series.)"""
    sizes = series_sizes(demand.filter(_usable()), cfg.segment_rows)
    sizes = materialize(sizes)
    if sizes.isEmpty():
        return ledger_from_demand(demand, cfg, watch)
    short = demand.join(sizes, list(SERIES_KEYS), "left_anti")
    long = long_ledger(demand.filter(_usable()).select(*LEDGER_INPUT), sizes, cfg, cfg.segment_rows)
    return ledger_from_demand(short, cfg, watch).unionByName(long)


def forecast_from_ledger(ledger: DataFrame) -> DataFrame:
    """The forecast table, recomputed in-row from the carried baseline."""
    return ledger.select("date", "store_id", "item_id",
                         F.coalesce(F.col("rolling_mean"), F.col("units_sold"), F.lit(0.0))
                         .alias("forecast_units"))


def tables_from_ledger(demand: DataFrame, ledger: DataFrame,
                       cfg: SignalConfig = SignalConfig()) -> Tables:
    inventory = inventory_table(ledger)
    anomalies = detect(ledger, cfg).select(*ANOMALY_COLUMNS)
    return Tables(demand, forecast_from_ledger(ledger), inventory, anomalies,
                  recommend(anomalies, inventory, cfg), rejected_demand(demand))


def build_all(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
              cfg: SignalConfig = SignalConfig(), long_form: bool = False,
              lenient: bool = False) -> Tables:
    """The five tables as lazy frames (``long_form`` when ``sales`` already has
    one row per series and day). The ledger is referenced by several tables;
    :func:`run_pipeline` materialises it once, this function does not."""
    demand = (enrich_demand(sales, calendar, prices, lenient) if long_form
              else build_demand(sales, calendar, prices, lenient))
    return tables_from_ledger(demand, ledger_from_demand(demand, cfg), cfg)


def check_inputs(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
                 long_form: bool = False) -> None:
    """Fail on duplicate series rows, calendar days or price weeks.

    Duplicates would fan demand rows out through the left joins, and unique
    sales keys bound every series to one row per day, which is what keeps a
    series (one task of the stock fold) bounded by the calendar."""
    assert_unique(sales, ["store_id", "item_id", "d"] if long_form else ["store_id", "item_id"],
                  "sales")
    assert_unique(calendar, ["d"], "calendar")
    assert_unique(prices, ["store_id", "item_id", "wm_yr_wk"], "prices")


def _stages(spark: SparkSession, folder: str, cfg: SignalConfig, watch: DemandWatch,
            make_demand: Callable[[], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """The tables of a run in the order of writing; each reads what earlier ones
    wrote into ``folder``, so the window and the Python fold run exactly once and
    a lost executor re-reads files instead of recomputing the fold. The demand and the
    ledger lie by series, so the window, the fold and the recommendations need no
    exchange (the anomalies and inventory they are made from are those of the tables
    written before)."""
    def stored(name: str) -> DataFrame:
        return read_by_series(spark, table_path(folder, name))

    def ledger() -> DataFrame:
        return stored(LEDGER_STAGE)

    def anomalies() -> DataFrame:
        return detect(ledger(), cfg).select(*ANOMALY_COLUMNS)

    return {
        "processed_demand": make_demand,
        "rejected_demand": lambda: rejected_demand(stored("processed_demand")),
        LEDGER_STAGE: lambda: ledger_from_stored(stored("processed_demand"), cfg, watch),
        "forecast": lambda: forecast_from_ledger(ledger()),
        "inventory_fulfillment": lambda: inventory_table(ledger()),
        "validation_logs": anomalies,
        "recommendations": lambda: recommend(anomalies(), inventory_table(ledger()), cfg, partitioned_by_series=True),
    }


def _demand_maker(sales: DataFrame, calendar: DataFrame, prices: DataFrame, long_form: bool, lenient: bool,
                  watch: DemandWatch) -> Callable[[], DataFrame]:
    make = enrich_demand if long_form else build_demand
    return lambda: make(sales, calendar, prices, lenient, watch)


def run_tables(spark: SparkSession, sales: DataFrame, calendar: DataFrame, prices: DataFrame,
               out_dir: str | Path, cfg: SignalConfig = SignalConfig(), long_form: bool = False,
               lenient: bool = False, check_keys: bool = False,
               watch: DemandWatch | None = None) -> dict[str, str]:
    """Write the five tables in stage order into ``out_dir``, one by one.
    :func:`run_set` publishes them together instead.

    Rows without a date, store or item stay in the demand table and are written
    to ``rejected_demand`` (empty when there are none); the ledger and the rules
    leave them out. ``check_keys`` first checks the dimension keys. ``watch``
    takes figures of the rows as they are written. The ledger is staged inside
    ``out_dir`` and removed at the end, also after an error.
    """
    if check_keys:
        check_inputs(sales, calendar, prices, long_form)
    watch = watch or DemandWatch.off()
    folder = str(out_dir).rstrip("/")
    paths = {}
    try:
        for name, make in _stages(spark, folder, cfg, watch,
                                  _demand_maker(sales, calendar, prices, long_form, lenient, watch)).items():
            paths[name] = write_table(make(), folder, name)
    finally:
        remove(spark, table_path(folder, LEDGER_STAGE))
    del paths[LEDGER_STAGE]
    return paths


def run_pipeline(spark: SparkSession, raw_dir: str | Path, out_dir: str | Path,
                 cfg: SignalConfig = SignalConfig(), lenient: bool = False,
                 check_keys: bool = False) -> dict[str, str]:
    """Three CSV inputs in ``raw_dir`` -> five Parquet tables in ``out_dir``. A
    lenient run also writes ``rejected_raw``, the lines that it read with nulls in
    place of bad cells."""
    sales, calendar, prices = read_raw_inputs(spark, raw_dir, lenient)
    paths = run_tables(spark, sales, calendar, prices, out_dir, cfg, lenient=lenient,
                       check_keys=check_keys)
    if lenient:
        paths["rejected_raw"] = write_table(rejected_raw(spark, raw_dir), out_dir, "rejected_raw")
    return paths


def run_diagnosis(spark: SparkSession, artifacts_dir: str | Path,
                  out_dir: str | Path | None = None, anomaly_id: str | None = None,
                  all_anomalies: bool = False) -> DataFrame:
    """Diagnose stored tables.

    Default: the top anomaly (or ``anomaly_id``), reading only its rows, with
    its report written to ``diagnosis_report.txt``. ``all_anomalies=True``
    diagnoses every anomaly and writes the ``diagnosis`` Parquet table. Folders
    may be on any file system that Spark knows; the report goes to the same one.
    """
    names = ("validation_logs", "inventory_fulfillment", "recommendations")
    out = str(out_dir if out_dir is not None else artifacts_dir).rstrip("/")
    if all_anomalies:
        tables, by_series = read_tables_by_series(spark, artifacts_dir, *names)
        result = diagnose_all(*tables, partitioned_by_series=by_series)
        write_table(result, out, DIAGNOSIS_TABLE)
        return spark.read.parquet(table_path(out, DIAGNOSIS_TABLE))
    result = diagnose_one(*(read_table(spark, artifacts_dir, name) for name in names), anomaly_id)
    kept = result.collect()  # one row: the report is computed once
    write_text(spark, f"{out}/{DIAGNOSIS_TEXT}", kept[0]["explanation"])
    return spark.createDataFrame(kept, result.schema)
