import datetime as dt

import pytest

from retail_signals import build_demand, build_forecast, day_columns, unpivot_days, with_baseline
from retail_signals.sources.files import read_raw_inputs

CAL = [("d_1", "2016-01-01", 1, None, None), ("d_2", "2016-01-02", 1, "Promo", "Cultural"),
       ("d_3", "2016-01-03", 1, None, None)]
CAL_SCHEMA = "d string, date string, wm_yr_wk int, event_name_1 string, event_type_1 string"
PRICE_SCHEMA = "store_id string, item_id string, wm_yr_wk int, sell_price double"


def test_mixed_wide_types_unpivot_keeps_nulls(spark):
    sales = spark.createDataFrame(
        [("i1_s1", "i1", "dep", "cat", "s1", "st", 3, 2.5, None)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, "
        "state_id string, d_1 int, d_2 double, d_3 string")
    rows = sorted(unpivot_days(sales).collect(), key=lambda r: r.d)
    assert [(r.d, r.units_sold) for r in rows] == [("d_1", 3.0), ("d_2", 2.5), ("d_3", None)]
    assert dict(unpivot_days(sales).dtypes)["units_sold"] == "double"


def test_no_day_column_raises(spark):
    sales = spark.createDataFrame([("x", "i")], "id string, item_id string")
    with pytest.raises(ValueError, match="No d_\\* columns found in sales table."):
        day_columns(sales)


def test_unmatched_calendar_and_price(spark):
    sales = spark.createDataFrame(
        [("i_s", "i", "dep", "cat", "s", "st", 1.0, 2.0, 4.0)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, "
        "state_id string, d_1 double, d_2 double, d_9 double")
    cal = spark.createDataFrame(CAL, CAL_SCHEMA)
    prices = spark.createDataFrame([("s", "i", 1, 2.0)], PRICE_SCHEMA)
    got = {r.d: r for r in build_demand(sales, cal, prices).collect()}
    assert got["d_9"].date is None and got["d_9"].price is None  # no calendar row
    assert got["d_1"].date == dt.date(2016, 1, 1) and got["d_1"].price == 2.0
    assert got["d_2"].is_promo == 1 and got["d_1"].is_promo == 0
    assert list(build_demand(sales, cal, prices).columns) == [
        "date", "d", "store_id", "state_id", "item_id", "dept_id", "cat_id", "units_sold",
        "price", "event_name_1", "event_type_1", "is_promo"]


def test_unmatched_price_week(spark):
    sales = spark.createDataFrame(
        [("i_s", "i", "dep", "cat", "s", "st", 1.0)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, "
        "state_id string, d_1 double")
    cal = spark.createDataFrame(CAL, CAL_SCHEMA)
    prices = spark.createDataFrame([("s", "other", 1, 2.0)], PRICE_SCHEMA)
    assert build_demand(sales, cal, prices).first().price is None


def test_csv_sources_without_inference(spark, tmp_path):
    (tmp_path / "sales_train_validation.csv").write_text(
        "id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3\n"
        "A_S,A,D,C,S,ST,1,2.5,\n")
    (tmp_path / "calendar.csv").write_text(
        "date,wm_yr_wk,weekday,d,event_name_1,event_type_1\n"
        "2016-01-01,1,Fri,d_1,,\n2016-01-02,1,Sat,d_2,Promo,Cultural\n"
        "2016-01-03,1,Sun,d_3,,\n")
    (tmp_path / "sell_prices.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nS,A,1,3.5\n")
    sales, cal, prices = read_raw_inputs(spark, tmp_path)
    assert dict(sales.dtypes)["d_1"] == "double"
    assert dict(cal.dtypes)["date"] == "date"
    rows = sorted(build_demand(sales, cal, prices).collect(), key=lambda r: r.d)
    assert [r.units_sold for r in rows] == [1.0, 2.5, None]
    assert [r.price for r in rows] == [3.5, 3.5, 3.5]
    assert rows[1].event_name_1 == "Promo" and rows[1].is_promo == 1


def test_malformed_csv_strict_and_lenient(spark, tmp_path):
    (tmp_path / "p.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nS,A,1,abc\n")
    from retail_signals.sources.files import read_prices_csv
    with pytest.raises(Exception):
        read_prices_csv(spark, str(tmp_path / "p.csv")).collect()
    assert read_prices_csv(spark, str(tmp_path / "p.csv"), lenient=True).first().sell_price is None


def _demand(spark, rows):
    return spark.createDataFrame(
        [(dt.date(2016, 1, 1) + dt.timedelta(days=d), s, i, u) for s, i, d, u in rows],
        "date date, store_id string, item_id string, units_sold double")


def test_baseline_first_row_nulls_and_zero(spark):
    df = _demand(spark, [("s", "a", 0, 4.0), ("s", "a", 1, None), ("s", "a", 2, 10.0),
                         ("s", "b", 0, 0.0), ("s", "b", 1, 0.0), ("s", "c", 0, None)])
    got = {(r.item_id, r.date.day): r for r in with_baseline(df).collect()}
    assert got[("a", 1)].rolling_mean is None and got[("a", 1)].forecast_units == 4.0
    assert got[("a", 2)].rolling_mean == 4.0
    assert got[("a", 3)].rolling_mean == 4.0  # the null inside the frame is skipped
    assert got[("b", 2)].rolling_mean == 0.0
    assert got[("c", 1)].forecast_units == 0.0  # no mean, no units


def test_baseline_counts_rows_not_days(spark):
    rows = [("s", "a", 3 * k, float(k)) for k in range(20)]  # a gap of 2 days between rows
    got = sorted(build_forecast(_demand(spark, rows), 14).collect(), key=lambda r: r.date)
    # row 16 (k=16) averages the 14 previous rows k=2..15
    assert got[16].forecast_units == pytest.approx(sum(range(2, 16)) / 14)


def test_prices_by_series_equal_the_three_key_join(spark):
    """Gaps, repeated weeks, null weeks and prices, rows without a calendar day,
    series without prices."""
    import random

    from pyspark.sql import functions as F

    from retail_signals.operators.demand import attach_calendar, attach_prices
    rnd = random.Random(3)
    sales = spark.createDataFrame([(f"s{rnd.randrange(4)}", rnd.choice(["i", "j", None]), f"d_{k % 40}", float(k))
                                   for k in range(400)], "store_id string, item_id string, d string, units_sold double")
    cal = spark.createDataFrame([(f"d_{k}", None, rnd.choice([k // 7 * 100, None]), None, None) for k in range(36)],
                                "d string, date date, wm_yr_wk int, event_name_1 string, event_type_1 string")
    prices = [(f"s{s}", i, rnd.choice([w * 100, None]), rnd.choice([1.5, 2.0, None])) for s in range(3)
              for i in ("i", "j") for w in (0, 1, 1, 3, 4) if (s, i) != (1, "j")]
    prices += [(f"s{s}", "j", w * 100, 9.0 + w) for s in range(3) for w in range(6)]
    prices = spark.createDataFrame(prices, PRICE_SCHEMA)
    dated = attach_calendar(sales, cal)
    want = dated.join(prices.withColumnRenamed("sell_price", "price"), ["store_id", "item_id", "wm_yr_wk"], "left")
    got = attach_prices(dated, prices)
    cols = ["store_id", "item_id", "wm_yr_wk", "d", "units_sold", "price"]
    assert sorted(got.select(cols).collect(), key=str) == sorted(want.select(cols).collect(), key=str)
    assert got.count() > 400 and got.filter(F.col("price").isNotNull()).count() > 20
