"""Published sets, tables by series, lookups by id, rejected lines, observed figures."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from retail_signals import SignalConfig, diagnose_all, diagnose_ids, recommend, run_diagnosis, run_pipeline, run_set
from retail_signals.operators.rules import ANOMALY_COLUMNS
from retail_signals.plans import runs
from retail_signals.plans.jobs import LEDGER_STAGE
from retail_signals.sources import files
from retail_signals.sources.files import read_raw_inputs, read_table, rejected_raw, write_table
from retail_signals.sources.layout import read_by_series, write_by_series
from test_jobs import _write_inputs

STAGES = ["processed_demand", "rejected_demand", LEDGER_STAGE, "forecast", "inventory_fulfillment", "validation_logs",
          "recommendations"]


def test_readers_see_the_old_set_until_the_new_one_is_whole(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=20)
    inputs = read_raw_inputs(spark, raw)
    run_set(spark, *inputs, out, "first")
    old = read_table(spark, out, "validation_logs").count()
    _write_inputs(raw, days=40)
    inputs = read_raw_inputs(spark, raw)
    written = []
    monkeypatch.setattr(runs, "write_table", lambda df, folder, name: written.append(name) or write_table(df, folder, name))
    for k, stage in enumerate(STAGES):
        assert run_set(spark, *inputs, out, "second", stop_after=stage) == {}
        assert read_table(spark, out, "validation_logs").count() == old   # still the first run's
        assert written == STAGES[:k + 1]                                  # nothing is done twice
    paths = run_set(spark, *inputs, out, "second")
    assert written == STAGES and LEDGER_STAGE not in paths
    assert read_table(spark, out, "processed_demand").count() == 4 * 40
    assert "Prompt Evolution:" in run_diagnosis(spark, out).first().explanation
    whole = run_pipeline(spark, raw, tmp_path / "plain")
    for name, path in paths.items():
        one, other = (sorted(spark.read.parquet(p).collect(), key=str) for p in (path, whole[name]))
        assert one == other, name
    with pytest.raises(ValueError, match="other settings"):
        run_set(spark, *inputs, out, "second", SignalConfig(window_rows=3))
    run_set(spark, *inputs, out, "first")  # a finished run is published again as it is
    assert read_table(spark, out, "validation_logs").count() == old and written == STAGES


def test_a_stage_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=20)
    inputs = read_raw_inputs(spark, raw)

    def failing(df, folder, name):
        if name == "forecast":
            df.limit(3).write.mode("overwrite").parquet(files.table_path(folder, name))
            raise OSError("lost")
        return write_table(df, folder, name)

    monkeypatch.setattr(runs, "write_table", failing)
    with pytest.raises(OSError):
        run_set(spark, *inputs, out, "run")
    assert runs.manifest(spark, out, "run")["finished"] == STAGES[:3]
    monkeypatch.setattr(runs, "write_table", write_table)
    paths = run_set(spark, *inputs, out, "run")
    assert spark.read.parquet(paths["forecast"]).count() == 4 * 20


def tables(spark, n=6, days=30):
    d0 = dt.date(2016, 1, 1)
    inventory = spark.createDataFrame(
        [(d0 + dt.timedelta(days=k), f"s{s}", "i", 5 + k, 2.0 + s, "D", "C") for s in range(n) for k in range(days)],
        "date date, store_id string, item_id string, closing_stock int, forecast_units double, dept_id string, cat_id string")
    anomalies = spark.createDataFrame(
        [(f"{s}-{k}", d0 + dt.timedelta(days=k), f"s{s}", "i", "demand_spike", "high", 9.0, 3.0, "x")
         for s in range(n) for k in range(0, days, 3)],
        "anomaly_id string, date date, store_id string, item_id string, rule_name string, severity string, "
        "metric_value double, expected_value double, details string").select(*ANOMALY_COLUMNS)
    return anomalies, inventory


def test_tables_by_series_join_without_exchange(spark, tmp_path, capsys):
    anomalies, inventory = tables(spark)
    stored = [read_by_series(spark, write_by_series(df, f"{tmp_path}/{n}", 5))
              for n, df in (("anomalies", anomalies), ("inventory", inventory))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made, plain in ((recommend(*stored, partitioned_by_series=True), recommend(anomalies, inventory)),
                            (diagnose_all(*stored, None, partitioned_by_series=True),
                             diagnose_all(anomalies, inventory, None))):
            made.explain()
            plan = capsys.readouterr().out
            assert "Exchange" not in plan and "Bucketed: true" in plan, plan
            assert sorted(made.collect(), key=str) == sorted(plain.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_by_series_are_read_by_another_session(spark, tmp_path):
    _, inventory = tables(spark)
    path = write_by_series(inventory, f"{tmp_path}/it's", 3)
    other = spark.newSession()
    other.sql("CREATE DATABASE IF NOT EXISTS elsewhere")
    other.sql("USE elsewhere")
    assert sorted(read_by_series(other, path).collect(), key=str) == sorted(inventory.collect(), key=str)
    write_by_series(inventory.limit(7), path, 2)  # another layout in the same place
    assert read_by_series(spark, path).count() == 7
    with pytest.raises(ValueError, match="not stored by series"):
        read_by_series(spark, str(tmp_path))


def scanned_rows(df) -> int:
    """Rows that the Parquet scans of a plan gave, after it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    return sum(found)


def test_lookups_skip_row_groups_without_the_id(spark, tmp_path):
    """Ids are hashes in no order, so only the bloom filters tell row groups apart."""
    ids = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("anomaly_id"), "id").coalesce(1)
    settings = {"parquet.block.size": str(200_000), "parquet.page.size": str(20_000)}
    conf = spark._jsc.hadoopConfiguration()
    for k, v in settings.items():
        conf.set(k, v)
    try:
        with_filter = write_table(ids, tmp_path, "validation_logs", lookup_rows=5000)
        without = write_table(ids, tmp_path, "plain")
    finally:
        for k in settings:
            conf.unset(k)
    one = F.col("anomaly_id") == ids.filter("id = 23456").first().anomaly_id
    rows = {p: scanned_rows(spark.read.parquet(p).filter(one)) for p in (with_filter, without)}
    assert 1 <= rows[with_filter] < 12_000 and rows[without] == 40_000, rows


def test_diagnosis_by_ids(spark):
    anomalies, inventory = tables(spark)
    recs = recommend(anomalies, inventory)
    ids = ["2-3", "5-27", "0-0"]
    every = {r.anomaly_id: r for r in diagnose_all(anomalies, inventory, recs).collect()}
    got = diagnose_ids(anomalies, inventory, recs, ids).collect()
    assert {r.anomaly_id for r in got} == set(ids) and all(r == every[r.anomaly_id] for r in got)
    with pytest.raises(ValueError, match="nope"):
        diagnose_ids(anomalies, inventory, recs, ["0-0", "nope"])


def test_one_diagnosis_for_each_id(spark):
    anomalies, inventory = tables(spark, n=1, days=4)
    again = anomalies.withColumn("metric_value", F.lit(100.0))
    twice = anomalies.unionByName(again).unionByName(anomalies)
    recs = recommend(anomalies, inventory)
    got = diagnose_all(twice, inventory, recs).collect()
    assert sorted(got, key=str) == sorted(diagnose_all(anomalies, inventory, recs).collect(), key=str)
    assert all("Observed vs expected: 9.0" in r.rounds[0].response for r in got)


def test_rejected_lines_have_file_and_number(spark, tmp_path):
    _write_inputs(tmp_path, days=30)
    prices = (tmp_path / "sell_prices.csv").read_text().splitlines()
    prices[3], prices[7] = prices[3].replace(prices[3].split(",")[3], "abc"), "CA_1,FOODS_1_001"
    prices.insert(5, "")
    (tmp_path / "sell_prices.csv").unlink()
    folder = tmp_path / "sell_prices.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(prices) + "\n")
    (folder / "b.csv").write_text("\n".join([prices[0], prices[1], "CA_1,X,1,,9", prices[2]]) + "\n")
    cal = (tmp_path / "calendar.csv").read_text().splitlines()
    cal[2] = "d_2,not a day,1,,"
    (tmp_path / "calendar.csv").write_text("\n".join(cal) + "\n")
    got = {(r.source, re.sub(".*/", "", r.file), r.line, r.raw) for r in rejected_raw(spark, tmp_path).collect()}
    assert got == {("sell_prices.csv", "a.csv", 4, prices[3]), ("sell_prices.csv", "a.csv", 9, "CA_1,FOODS_1_001"),
                   ("sell_prices.csv", "b.csv", 3, "CA_1,X,1,,9"), ("calendar.csv", "calendar.csv", 3, cal[2])}
    paths = run_pipeline(spark, tmp_path, tmp_path / "out", lenient=True)
    assert spark.read.parquet(paths["rejected_raw"]).count() == 4
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed|CSV header"):
        run_pipeline(spark, tmp_path, tmp_path / "strict")


def test_line_numbers_over_many_blocks(spark, tmp_path):
    from pyspark.sql import types as T

    from retail_signals.sources.rejects import rejected_lines
    lines = ["n"] + [str(k) if k % 997 else f"bad{k}" for k in range(1, 20_000)]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = rejected_lines(spark, str(tmp_path / "x.csv"), T.StructType([T.StructField("n", T.IntegerType())]))
        assert got.select("line", "raw").distinct().count() == 20
        assert {(r.line, r.raw) for r in got.collect()} == {(k + 1, f"bad{k}") for k in range(997, 20_000, 997)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_figures_need_no_other_scan(spark, tmp_path, capsys):
    from retail_signals.functions.watch import DemandWatch
    from retail_signals.operators.demand import build_demand
    _write_inputs(tmp_path, days=20)
    cal = (tmp_path / "calendar.csv").read_text().splitlines()
    (tmp_path / "calendar.csv").write_text("\n".join(cal[:-3] + [cal[1]]) + "\n")  # 3 days lacking, one twice
    inputs = read_raw_inputs(spark, tmp_path)
    plans = []
    watch = DemandWatch()
    for w in (None, watch):
        build_demand(*inputs, watch=w).explain()
        plans.append(capsys.readouterr().out)
    assert plans[0].count("FileScan") == plans[1].count("FileScan") == 3
    watch.observations.clear()
    run_set(spark, *inputs, tmp_path / "out", "run")
    figures = runs.manifest(spark, tmp_path / "out", "run")["figures"]
    assert figures == {"sales_rows": 80, "sales_without_units": 0, "undated_rows": 12, "rows_added_by_calendar": 4,
                       "rows_added_by_prices": 0, "rows_without_price": 12 + 12, "ledger_rows": 72,
                       "repeated_dates": 4}
