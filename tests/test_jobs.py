import datetime as dt
import random

from pyspark.sql import functions as F

from retail_signals import run_diagnosis, run_pipeline


def _write_inputs(path, days=60):
    rnd = random.Random(5)
    d0 = dt.date(2016, 1, 1)
    cols = [f"d_{i}" for i in range(1, days + 1)]
    lines = ["id,item_id,dept_id,cat_id,store_id,state_id," + ",".join(cols)]
    for store in ("CA_1", "TX_1"):
        for item in ("FOODS_1_001", "HOBBIES_1_001"):
            vals = [str(rnd.randint(0, 40)) for _ in cols]
            lines.append(f"{item}_{store},{item},{item[:-4]},{item.split('_')[0]},{store},"
                         f"{store[:2]}," + ",".join(vals))
    (path / "sales_train_validation.csv").write_text("\n".join(lines) + "\n")
    cal = ["d,date,wm_yr_wk,event_name_1,event_type_1"]
    for i in range(days):
        ev = "Promo,Cultural" if i % 30 in (5, 6, 7) else ","
        cal.append(f"d_{i + 1},{d0 + dt.timedelta(days=i)},{i // 7 + 1},{ev}")
    (path / "calendar.csv").write_text("\n".join(cal) + "\n")
    pr = ["store_id,item_id,wm_yr_wk,sell_price"]
    for store in ("CA_1", "TX_1"):
        for item in ("FOODS_1_001", "HOBBIES_1_001"):
            for wk in range(1, days // 7 + 2):
                if wk != 3:  # a missing week feeds missing_price
                    pr.append(f"{store},{item},{wk},{rnd.uniform(2, 9):.2f}")
    (path / "sell_prices.csv").write_text("\n".join(pr) + "\n")


def test_end_to_end(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw)
    paths = run_pipeline(spark, raw, out)
    assert list(paths) == ["processed_demand", "rejected_demand", "forecast", "inventory_fulfillment",
                           "validation_logs", "recommendations"]
    demand = spark.read.parquet(paths["processed_demand"])
    assert demand.count() == 4 * 60
    inv = spark.read.parquet(paths["inventory_fulfillment"])
    assert inv.count() == 4 * 60 and len(inv.columns) == 14
    logs = spark.read.parquet(paths["validation_logs"])
    recs = spark.read.parquet(paths["recommendations"])
    assert logs.count() == recs.count() > 0
    assert logs.filter(F.col("rule_name") == "missing_price").count() == 4 * 7
    report = run_diagnosis(spark, out).first()
    assert (out / "diagnosis_report.txt").read_text() == report.explanation
    every = run_diagnosis(spark, out, all_anomalies=True)
    assert every.count() == logs.select("anomaly_id").distinct().count()
    assert spark.range(1).count() == 1  # the caller's session is still alive


def test_undated_rows_are_routed_and_keys_checked(spark, tmp_path):
    import pytest
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=30)
    cal = (raw / "calendar.csv").read_text().splitlines()
    (raw / "calendar.csv").write_text("\n".join(cal[:-2]) + "\n")  # days 29 and 30 unknown
    paths = run_pipeline(spark, raw, out)
    rejected = spark.read.parquet(paths["rejected_demand"])
    assert rejected.count() == 4 * 2
    assert spark.read.parquet(paths["processed_demand"]).count() == 4 * 30
    assert spark.read.parquet(paths["inventory_fulfillment"]).count() == 4 * 28
    (raw / "calendar.csv").write_text("\n".join(cal + [cal[1]]) + "\n")  # a duplicated day
    from retail_signals.plans.jobs import run_tables
    from retail_signals.sources.files import read_raw_inputs
    with pytest.raises(ValueError, match="calendar: keys"):
        run_tables(spark, *read_raw_inputs(spark, raw), tmp_path / "o2", check_keys=True)


def test_command_line(spark, tmp_path, capsys):
    from retail_signals.__main__ import main
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=40)
    assert main(["run-pipeline", str(raw), str(out)], spark=spark) == 0
    printed = capsys.readouterr().out
    assert "validation_logs" in printed and "recommendations" in printed
    assert main(["diagnose", str(out)], spark=spark) == 0
    report = capsys.readouterr().out
    assert "Prompt Evolution:" in report and (out / "diagnosis_report.txt").exists()
    some_id = (spark.read.parquet(str(out / "validation_logs.parquet"))
               .filter("rule_name = 'missing_price'").first().anomaly_id)
    assert main(["diagnose", str(out), "--anomaly-id", some_id], spark=spark) == 0
    report = capsys.readouterr().out
    assert f"Anomaly ID: {some_id}" in report and "Backfill missing price records" in report


def test_bad_rows_are_treated_alike_and_nothing_is_left(spark, tmp_path):
    from retail_signals.plans.jobs import build_all, run_tables
    from retail_signals.sources.files import read_raw_inputs

    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=30)
    cal = (raw / "calendar.csv").read_text()
    (raw / "calendar.csv").write_text("\n".join(cal.splitlines()[:-1]) + "\n")
    sales, calendar, prices = read_raw_inputs(spark, raw)
    nobody = sales.limit(1).withColumn("store_id", F.lit(None).cast("string"))
    sales = sales.unionByName(nobody)
    paths = run_tables(spark, sales, calendar, prices, out)
    built = build_all(sales, calendar, prices)
    for name, table in (("processed_demand", built.demand), ("rejected_demand", built.rejected),
                        ("forecast", built.forecast), ("inventory_fulfillment", built.inventory),
                        ("validation_logs", built.anomalies), ("recommendations", built.recommendations)):
        written = spark.read.parquet(paths[name])
        cols = table.columns
        assert sorted(written.select(cols).collect(), key=str) == sorted(table.collect(), key=str), name
    assert spark.read.parquet(paths["rejected_demand"]).count() == 4 + 30
    assert sorted(p.name for p in out.iterdir()) == sorted(f"{n}.parquet" for n in paths)
    (raw / "calendar.csv").write_text(cal)
    again = run_pipeline(spark, raw, out)
    assert spark.read.parquet(again["rejected_demand"]).count() == 0


def test_reports_go_to_the_named_file_system(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    _write_inputs(raw, days=40)
    run_pipeline(spark, f"file://{raw}", f"file://{out}")
    report = run_diagnosis(spark, f"file://{out}", f"file://{tmp_path}/reports").first()
    assert (tmp_path / "reports" / "diagnosis_report.txt").read_text() == report.explanation
    assert run_diagnosis(spark, f"file://{out}", f"file://{tmp_path}/reports", all_anomalies=True).count() > 0
    assert (tmp_path / "reports" / "diagnosis.parquet").exists()


def test_files_that_order_columns_differently_fail(spark, tmp_path):
    import pytest
    from retail_signals.sources.files import read_prices_csv

    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "a.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\ns,i,1,2.0\n")
    (folder / "b.csv").write_text("item_id,store_id,wm_yr_wk,sell_price\ni,s,1,2.0\n")
    with pytest.raises(Exception, match="CSV header"):
        read_prices_csv(spark, str(folder)).collect()


def test_restock_text_follows_the_setting(spark):
    from retail_signals import SignalConfig
    from retail_signals.operators.recommend import recommendation_text

    row = spark.createDataFrame([("low_inventory", "i", "s", "c", 2, 10.0)],
                                "rule_name string, item_id string, store_id string, cat_id string, "
                                "closing_stock int, forecast_units double")
    for days, text in ((3.0, "by 28 units to restore 3-day"), (7.5, "by 73 units to restore 7.5-day")):
        got = row.select(recommendation_text(SignalConfig(restock_cover_days=days))).first()[0]
        assert got == f"Increase replenishment for i at s {text} forecast cover."
