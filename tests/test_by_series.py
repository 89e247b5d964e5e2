"""Work by series: what needs an exchange or a wide frame, and what does not."""
import math
import os
import re
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import functions as F

from retail_signals.operators import diagnose
from retail_signals.operators.demand import build_demand, enrich_demand, unpivot_days
from retail_signals.operators.recommend import recommend
from retail_signals.operators.rules import ANOMALY_COLUMNS
from retail_signals.plans.jobs import ledger_from_demand
from retail_signals.plans.jobs import run_diagnosis, run_pipeline
from retail_signals.sources import testdata
from retail_signals.sources.files import read_table
from retail_signals.sources.layout import materialize_by_series, read_by_series, write_by_series
from retail_signals.sources.wide_kernel import BLOCK_ROWS, spread_days
from test_jobs import _write_inputs


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _demand(spark, days=40):
    rows = [(date(2020, 1, 1) + timedelta(d), s, "X", i, "D", "C", float((d * 7 + k) % 23), None if d % 5 else 1.0)
            for k, (s, i) in enumerate((s, i) for s in ("1", "2") for i in ("a", "b")) for d in range(days)]
    return spark.createDataFrame(rows, "date date, store_id string, state_id string, item_id string, "
                                       "dept_id string, cat_id string, units_sold double, price double")


def _stored(spark):
    from retail_signals.operators.rules import detect
    from retail_signals.operators.stock import inventory_table
    led = materialize_by_series(ledger_from_demand(_demand(spark)))
    return detect(led).select(*ANOMALY_COLUMNS), inventory_table(led)


def test_diagnosis_and_actions_of_a_stored_ledger_need_no_exchange(spark):
    anomalies, inventory = _stored(spark)
    assert anomalies.count() > 0
    kept = ANOMALY_COLUMNS[4:]
    actions = recommend(anomalies, inventory, partitioned_by_series=True, keep=kept)
    texts = diagnose.diagnose_all(actions, inventory, None, partitioned_by_series=True, keep=("action_type",))
    assert _exchanges(actions) == 0 and _exchanges(texts) == 0
    assert _exchanges(diagnose.candidate_rows(anomalies, inventory, None, partitioned_by_series=True)) == 0


def test_carried_columns_equal_the_join_by_id(spark):
    anomalies, inventory = _stored(spark)
    twice = anomalies.unionAll(anomalies.limit(3))
    joined = twice.join(recommend(twice, inventory).drop("date", "store_id", "item_id"), "anomaly_id")
    carried = recommend(twice, inventory, keep=ANOMALY_COLUMNS[4:])
    names = [*ANOMALY_COLUMNS, "action_type", "recommendation"]
    assert sorted(carried.select(names).collect(), key=str) == sorted(joined.select(names).collect(), key=str)


def test_stored_lines_are_attached_with_two_exchanges(spark):
    """One for anomalies and lines together, one for the latest rows."""
    anomalies, inventory = _stored(spark)
    recs = recommend(anomalies, inventory).unionAll(recommend(anomalies, inventory).limit(1))
    plain = [spark.createDataFrame(df.collect(), df.schema) for df in (anomalies, inventory, recs)]
    texts = diagnose.diagnose_all(*plain)
    assert _exchanges(texts) <= 2
    got = {r["anomaly_id"]: r["recommendation_lines"] for r in texts.collect()}
    want = {}
    for r in recs.collect():
        want.setdefault(r["anomaly_id"], []).append(f"- {r['recommendation']}")
    assert got == {k: "\n".join(sorted(v)) for k, v in want.items()}


def test_lines_of_rows_without_a_series_are_not_attached(spark):
    anomalies = spark.createDataFrame([("i", "2020-01-01", None, "a", "demand_drop")],
                                      "anomaly_id string, date string, store_id string, item_id string, rule_name string")
    recs = spark.createDataFrame([("i", None, "a", "text")],
                                 "anomaly_id string, store_id string, item_id string, recommendation string")
    inventory = spark.createDataFrame([], "date string, store_id string, item_id string, closing_stock int, "
                                          "forecast_units double")
    row = diagnose.diagnose_all(anomalies, inventory, recs).first()
    assert row["recommendation_lines"] == "- No recommendation generated"


def test_only_markers_outside_the_fixed_text_are_searched(spark):
    frame = spark.createDataFrame([("", "", "", True, True, "x")], "t_rule_tok string, t_store string, t_item string, "
                                                                  "has_ctx boolean, has_recs boolean, _resp string")
    searched = []
    for rendering in diagnose.RENDERINGS:
        score, notes = diagnose._score(rendering, "_resp")
        plan = frame.select(score.alias("s"), notes.alias("n"))._jdf.queryExecution().analyzed().toString().lower()
        searched.append("contains(" in plan)
    assert searched == [False, False, True]  # the brief prints no root-cause heading


def test_wide_sales_get_their_prices_before_the_unpivot(spark):
    days = [f"d_{i}" for i in range(1, 31)]
    wide = spark.createDataFrame([("a_1", "a", "D", "C", "1", "X", *[float(i) for i in range(30)]),
                                  ("b_1", "b", "D", "C", "1", "X", *[None] * 30)],
                                 "id string, item_id string, dept_id string, cat_id string, store_id string, "
                                 "state_id string, " + ", ".join(f"{d} double" for d in days))
    calendar = spark.createDataFrame([(d, date(2020, 1, 1) + timedelta(i), i // 7, None, None) for i, d in enumerate(days)],
                                     "d string, date date, wm_yr_wk int, event_name_1 string, event_type_1 string")
    prices = spark.createDataFrame([("1", "a", 0, 2.0), ("1", "a", 0, 3.0), ("1", "b", 2, 4.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    built = build_demand(wide, calendar, prices)
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("_listed")  # the lists are joined below the unpivot
    want = enrich_demand(unpivot_days(wide), calendar, prices)
    assert sorted(built.collect(), key=str) == sorted(want.collect(), key=str)
    assert built.count() == 67


def test_days_are_spread_in_small_blocks():
    cells = [[{"k": 5, "units": 1.0}, {"k": 5, "units": 2.0}, {"k": 7, "units": None}], [{"k": None, "units": 9.0}], []]
    n = BLOCK_ROWS + 3
    kind = pa.list_(pa.struct([("k", pa.int32()), ("units", pa.float64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(n)]),
                                        pa.array([cells[i % 3] for i in range(n)], kind)], names=["id", "cells"])
    blocks = list(spread_days(iter([batch.slice(1)]), 5, ["d_6", "d_7", "d_8"]))
    assert [b.num_rows for b in blocks] == [BLOCK_ROWS, 2]
    rows = [r for b in blocks for r in b.to_pylist()]
    assert [r["id"] for r in rows] == [str(i) for i in range(1, n)]
    for r in rows:
        assert (r["d_6"], r["d_7"], r["d_8"]) == ((1.0 if int(r["id"]) % 3 == 0 else None), None, None)
    assert not any(isinstance(r["d_6"], float) and math.isnan(r["d_6"]) for r in rows)


def test_rows_by_series_are_written_where_they_are(spark, tmp_path):
    rows = _demand(spark)
    path = write_by_series(rows.repartition(8, "store_id", "item_id"), f"{tmp_path}/t", 8, None, dealt=True)
    back = read_by_series(spark, path)
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
    assert _exchanges(back.groupBy("store_id", "item_id").agg(F.count("*"))) == 0


def test_texts_of_a_rule_and_series_stand_together(spark):
    anomalies, inventory = _stored(spark)
    texts = diagnose.diagnose_all(anomalies, inventory, None, partitioned_by_series=True)
    rows = texts.select(F.spark_partition_id().alias("task"), "rule_name", "store_id", "item_id", "date").collect()
    for task in {r["task"] for r in rows}:
        mine = [tuple(r)[1:] for r in rows if r["task"] == task]
        assert mine == sorted(mine)


def test_lines_stored_by_series_are_attached_without_an_exchange(spark):
    anomalies, inventory = _stored(spark)
    recs = materialize_by_series(recommend(anomalies, inventory, partitioned_by_series=True))
    texts = diagnose.diagnose_all(anomalies, inventory, recs, partitioned_by_series=True)
    assert _exchanges(texts) == 0
    plain = diagnose.diagnose_all(anomalies, inventory, spark.createDataFrame(recs.collect(), recs.schema))
    assert sorted(texts.collect(), key=str) == sorted(plain.collect(), key=str)


def test_a_run_is_diagnosed_without_an_exchange(spark, tmp_path, monkeypatch):
    """Its tables lie by series; tables written as their rows came give the same texts."""
    from retail_signals.plans import jobs
    raw, out, plain = tmp_path / "raw", tmp_path / "out", tmp_path / "plain"
    raw.mkdir()
    _write_inputs(raw, days=40)
    run_pipeline(spark, raw, out)
    for name in ("validation_logs", "inventory_fulfillment", "recommendations"):
        read_table(spark, out, name).write.parquet(f"{plain}/{name}.parquet")
    exchanges = []
    write = jobs.write_table
    monkeypatch.setattr(jobs, "write_table", lambda df, folder, name: exchanges.append(_exchanges(df)) or write(df, folder, name))
    one, other = (run_diagnosis(spark, folder, all_anomalies=True) for folder in (out, plain))
    assert exchanges[0] == 0 and exchanges[1] > 0
    assert one.count() > 0 and sorted(one.collect(), key=str) == sorted(other.collect(), key=str)


def test_tables_by_series_are_copied_bucket_by_bucket(spark, tmp_path):
    """A task that writes by series sorts its rows by bucket: it should hold one bucket."""
    rows = spark.range(200).select(F.col("id").cast("string").alias("store_id"), F.lit("a").alias("item_id"), "id")
    first = read_by_series(spark, write_by_series(rows, f"{tmp_path}/first", 20, None))
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    path = write_by_series(first.select("store_id", "item_id"), f"{tmp_path}/second", 20, None, dealt=True)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    tasks = {re.match(r"part-(\d+)", f)[1] for f in files}
    assert len(files) > 1 and len(tasks) == len(files)
    assert spark.conf.get(name) == before


def test_lines_are_exchanged_once_by_series(spark, tmp_path):
    """Several lines of a day, a returned line, a part with no line, a supplier listed twice."""
    lines = [(1, 1, 2.0, 10.0, "N", date(1995, 1, 3)), (1, 1, 3.0, 30.0, "N", date(1995, 1, 3)),
             (2, 1, 1.0, 99.0, "R", date(1995, 1, 4)), (2, 2, None, 5.0, "N", date(1995, 1, 4)),
             (9, 1, 1.0, 1.0, "N", date(1995, 1, 3)), (1, None, 1.0, 1.0, "N", date(1995, 1, 3))]
    for name, rows, schema in (
            ("lineitem", lines, "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                "l_returnflag string, l_shipdate date"),
            ("part", [(1, "A"), (2, "B"), (3, "C")], "p_partkey long, p_type string"),
            ("supplier", [(1, 7), (2, 8), (2, 8)], "s_suppkey long, s_nationkey int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    daily = testdata.daily_facts(spark, str(tmp_path))
    again = daily.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "store_id", "item_id")
    assert _exchanges(daily) == 1 and _exchanges(again) == 1
    want = [("1", "A", "7", 2, 5.0, 10.0), ("1", "B", "7", 3, 1.0, None)] + [("2", "B", "8", 3, None, None)] * 2
    assert sorted((tuple(r) for r in daily.collect()), key=str) == sorted(want, key=str)
