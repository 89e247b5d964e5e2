import datetime as dt

import pytest
from pyspark.sql import functions as F

from retail_signals import diagnose_all, diagnose_one, recommend, top_anomaly_id
from retail_signals.functions.ids import anomaly_id

# The reference's stored diagnosis report for one demand spike
# (the expected output of the inputs in ``_golden_inputs``).
GOLDEN_REPORT = (
    "Anomaly ID: 6ed306fc43debfdde5769e5660e04febfc9bf0f4a5131e8a79420c24423ea2fe\n"
    "Rule: demand_spike\n"
    "Date: 2016-02-07\n"
    "Store: CA_1\n"
    "Item: FOODS_1_001\n"
    "Severity: high\n"
    "Observed vs expected: 76.0 vs 34.92857142857143\n"
    "Details: Demand significantly above rolling baseline.\n"
    "Context: Closing stock=162, forecast=36.14\n"
    "\n"
    "Root Cause Analysis:\n"
    "Observed demand significantly exceeds historical baseline, likely due to "
    "promotion/event-driven uplift. Current closing stock: 162, latest forecast: 36.14.\n"
    "\n"
    "Recommendations:\n"
    "- Activate demand surge plan for FOODS_1_001 in CA_1 (temporary safety stock and "
    "expedited reorder).\n"
    "\n"
    "\n"
    "Prompt Evolution:\n"
    "Selected candidate: baseline_analyst\n"
    "Best score: 13\n"
    "Rounds:\n"
    "- Round 1: baseline_analyst | score=13\n"
    "- Round 2: structured_rca | score=13\n"
    "- Round 3: decision_brief | score=11\n"
)
AN_SCHEMA = ("date date, store_id string, item_id string, rule_name string, severity string, "
             "metric_value double, expected_value double, details string")
INV_SCHEMA = ("date date, store_id string, item_id string, closing_stock int, "
              "forecast_units double, dept_id string, cat_id string")


def anomalies(spark, rows):
    df = spark.createDataFrame(rows, AN_SCHEMA)
    return df.select(anomaly_id(F.col("rule_name")).alias("anomaly_id"), "*")


def test_recommendation_texts(spark):
    d = dt.date(2016, 1, 5)
    an = anomalies(spark, [(d, "S", "I", r, "high", 1.0, 2.0, "x") for r in
                           ["low_inventory", "fulfillment_drop", "demand_spike", "missing_price",
                            "demand_drop", "odd_rule"]] + [(d, "S2", "J", "low_inventory", "high",
                                                            1.0, 2.0, "x")])
    inv = spark.createDataFrame([(dt.date(2016, 1, 1), "S", "I", 50, 99.0, "D", "C"),
                                 (dt.date(2016, 1, 9), "S", "I", 5, 18.0, "D", "C")], INV_SCHEMA)
    got = {(r.store_id, r.action_type): r.recommendation
           for r in recommend(an, inv).collect()}
    assert got[("S", "inventory_restock")] == ("Increase replenishment for I at S by 49 units to "
                                               "restore 3-day forecast cover.")
    assert got[("S", "store_allocation")] == ("Rebalance inventory to S for I and prioritize fast "
                                              "replenishment lanes.")
    assert got[("S", "demand_response")] == ("Activate demand surge plan for I in S (temporary "
                                             "safety stock and expedited reorder).")
    assert got[("S", "data_quality_fix")] == ("Backfill missing price records for I in S and "
                                              "validate upstream pricing feed.")
    assert got[("S", "substitution_suggestion")] == ("Suggest substitute items from category C "
                                                     "for I at S to reduce lost sales.")
    # a series without inventory rows: greatest() skips the null -> 0 units
    assert got[("S2", "inventory_restock")] == ("Increase replenishment for J at S2 by 0 units to "
                                                "restore 3-day forecast cover.")
    assert recommend(an.unionByName(an), inv).count() == an.count()  # dedup


def _golden_inputs(spark):
    d = dt.date(2016, 2, 7)
    an = anomalies(spark, [(d, "CA_1", "FOODS_1_001", "demand_spike", "high", 76.0, 489 / 14,
                            "Demand significantly above rolling baseline.")])
    inv = spark.createDataFrame([(d, "CA_1", "FOODS_1_001", 162, 36.142857142857146, "F", "C")],
                                INV_SCHEMA)
    recs = an.select("anomaly_id", F.lit("Activate demand surge plan for FOODS_1_001 in CA_1 "
                                         "(temporary safety stock and expedited reorder).")
                     .alias("recommendation"))
    return an, inv, recs


def test_golden_report(spark):
    out = diagnose_all(*_golden_inputs(spark)).first()
    assert len(GOLDEN_REPORT) == 793
    assert out.explanation == GOLDEN_REPORT
    assert [r.score for r in out.rounds] == [13, 13, 11]
    assert [r.system_prompt for r in out.rounds] == [
        "You are a supply-chain incident analyst. Explain anomaly, root cause, and recommendations with operational context.",
        "You are an RCA specialist. Produce incident summary, root cause, operational context, and action plan in structured form.",
        "You are a decision-intelligence assistant. Create an executive brief with deviation, why, and immediate actions."]
    assert out.best_candidate == "baseline_analyst" and out.best_score == 13


def test_no_recommendation_and_no_context(spark):
    an, inv, recs = _golden_inputs(spark)
    out = diagnose_all(an, inv.limit(0), recs.limit(0)).first()
    assert "- No recommendation generated" in out.best_response
    assert "Context: No inventory context available" in out.best_response
    assert [r.score for r in out.rounds] == [10, 10, 8]  # -2 recs, -1 context
    assert out.root_cause.endswith("promotion/event-driven uplift.")


def test_unknown_rule_fallback(spark):
    d = dt.date(2016, 2, 7)
    an = anomalies(spark, [(d, "S", "I", "weird_rule", "low", None, None, "z")])
    inv = spark.createDataFrame([(d, "S", "I", 3, 2.125, "D", "C")], INV_SCHEMA)
    recs = recommend(an, inv)
    out = diagnose_all(an, inv, recs).first()
    assert out.root_cause.startswith("An anomaly was detected but no specific rule-based")
    assert "Suggest substitute items from category C for I at S" in out.best_response
    assert "Observed vs expected: nan vs nan" in out.best_response
    assert "forecast=2.12" in out.best_response  # half-even on the binary value, like Python


def test_roundtrip_thin_tables(spark, tmp_path):
    # string dates, no metric columns, inventory without dept/cat (the reference's own test)
    val = spark.createDataFrame([("a1", "2016-01-10", "CA_1", "FOODS_1_001", "low_inventory",
                                  "high", "Inventory coverage below threshold.")],
                                "anomaly_id string, date string, store_id string, item_id string, "
                                "rule_name string, severity string, details string")
    inv = spark.createDataFrame([("2016-01-10", "CA_1", "FOODS_1_001", 5, 18.0)],
                                "date string, store_id string, item_id string, closing_stock long, "
                                "forecast_units double")
    recs = spark.createDataFrame([("a1", "Increase replenishment for FOODS_1_001 at CA_1 by 40 "
                                         "units")], "anomaly_id string, recommendation string")
    out = diagnose_one(val, inv, recs, "a1").first()
    assert "Root Cause Analysis" in out.explanation
    assert "Recommendations" in out.explanation
    assert "Observed vs expected: None vs None" in out.explanation
    assert "Closing stock=5, forecast=18.0" in out.explanation


def test_errors(spark):
    an, inv, recs = _golden_inputs(spark)
    with pytest.raises(ValueError, match="No anomalies found in validation logs."):
        top_anomaly_id(an.limit(0))
    with pytest.raises(ValueError, match="Anomaly id not found: nope"):
        diagnose_one(an, inv, recs, "nope")
    assert top_anomaly_id(an) == an.first().anomaly_id


def test_in_row_recommendations_equal_the_joined_table(spark):
    import random
    rnd = random.Random(2)
    d0 = dt.date(2016, 1, 1)
    rules = ["low_inventory", "fulfillment_drop", "demand_spike", "missing_price", "demand_drop"]
    rows = [(d0 + dt.timedelta(days=rnd.randint(0, 30)), f"S{rnd.randint(0, 3)}",
             f"I{rnd.randint(0, 2)}", rnd.choice(rules), "high", float(rnd.randint(0, 9)),
             rnd.choice([None, 2.5]), "x") for _ in range(60)]
    an = anomalies(spark, rows)
    an = an.unionByName(an.limit(5))  # duplicated anomalies too
    inv = spark.createDataFrame(
        [(d0 + dt.timedelta(days=k), f"S{s}", f"I{i}", rnd.randint(0, 50), rnd.random() * 30,
          "D", rnd.choice(["C", None])) for s in range(3) for i in range(3) for k in range(8)],
        INV_SCHEMA)
    cols = ["anomaly_id", "root_cause", "best_candidate", "best_score", "explanation"]
    joined = diagnose_all(an, inv, recommend(an, inv)).select(cols)
    fused = diagnose_all(an, inv, None).select(cols)
    assert joined.count() == fused.count() == an.select("anomaly_id").distinct().count()
    assert joined.exceptAll(fused).count() == 0 and fused.exceptAll(joined).count() == 0
