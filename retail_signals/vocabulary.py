"""Fixed output text.

Fixed values: every string below must equal the reference's output byte for
byte (rule names, severities, details, action types, sentence pieces, root
causes, report candidates and their system prompts). They are listed plainly,
in the order the reference uses them.
"""
from __future__ import annotations

# --- Fixed values: anomaly rules (rule name, severity, details) -------------
RULE_DEMAND_SPIKE = "demand_spike"
RULE_DEMAND_DROP = "demand_drop"
RULE_LOW_INVENTORY = "low_inventory"
RULE_FULFILLMENT_DROP = "fulfillment_drop"
RULE_MISSING_PRICE = "missing_price"

RULES = {
    RULE_DEMAND_SPIKE: ("high", "Demand significantly above rolling baseline."),
    RULE_DEMAND_DROP: ("medium", "Demand significantly below rolling baseline."),
    RULE_LOW_INVENTORY: ("high", "Inventory coverage below threshold."),
    RULE_FULFILLMENT_DROP: ("high", "Fulfillment rate below SLA threshold."),
    RULE_MISSING_PRICE: ("medium", "Missing sell price for date/item/store record."),
}

ANOMALY_ID_SEPARATOR = "|"

# --- Fixed values: recommendation action types ------------------------------
ACTION_BY_RULE = {
    RULE_LOW_INVENTORY: "inventory_restock",
    RULE_FULFILLMENT_DROP: "store_allocation",
    RULE_DEMAND_SPIKE: "demand_response",
    RULE_MISSING_PRICE: "data_quality_fix",
}
ACTION_OTHERWISE = "substitution_suggestion"

# --- Fixed values: recommendation sentences (pieces joined by one space) ----
# Each tuple alternates literal text and the name of a column; ``None`` marks
# the restock quantity.
SENTENCE_BY_RULE = {
    RULE_LOW_INVENTORY: ("Increase replenishment for", "item_id", "at", "store_id", "by", None,
                         "units to restore {cover}-day forecast cover."),
    RULE_FULFILLMENT_DROP: ("Rebalance inventory to", "store_id", "for", "item_id",
                            "and prioritize fast replenishment lanes."),
    RULE_DEMAND_SPIKE: ("Activate demand surge plan for", "item_id", "in", "store_id",
                        "(temporary safety stock and expedited reorder)."),
    RULE_MISSING_PRICE: ("Backfill missing price records for", "item_id", "in", "store_id",
                         "and validate upstream pricing feed."),
}
SENTENCE_OTHERWISE = ("Suggest substitute items from category", "cat_id", "for", "item_id", "at",
                      "store_id", "to reduce lost sales.")
SENTENCE_COLUMNS = {"item_id", "store_id", "cat_id"}

# --- Fixed values: diagnosis root causes -------------------------------------
ROOT_CAUSE_BY_RULE = {
    RULE_LOW_INVENTORY: "Inventory coverage is insufficient for expected near-term demand. "
                        "Reorder trigger and lead-time policy are likely too conservative.",
    RULE_FULFILLMENT_DROP: "Fulfillment degradation indicates stock mismatch or replenishment "
                           "latency at the store-item level.",
    RULE_DEMAND_SPIKE: "Observed demand significantly exceeds historical baseline, likely due to "
                       "promotion/event-driven uplift.",
    RULE_DEMAND_DROP: "Demand has fallen below baseline, indicating potential over-forecasting or "
                      "post-promotion normalization.",
    RULE_MISSING_PRICE: "Upstream pricing feed has missing records, causing incomplete commercial "
                        "context in demand analysis.",
}
ROOT_CAUSE_OTHERWISE = "An anomaly was detected but no specific rule-based root cause mapping exists."
NO_CONTEXT_TEXT = "No inventory context available"
NO_RECOMMENDATION_LINE = "- No recommendation generated"

# --- Fixed values: report candidates, in round order -------------------------
CANDIDATES = (
    ("baseline_analyst",
     "You are a supply-chain incident analyst. Explain anomaly, root cause, and recommendations "
     "with operational context."),
    ("structured_rca",
     "You are an RCA specialist. Produce incident summary, root cause, operational context, and "
     "action plan in structured form."),
    ("decision_brief",
     "You are a decision-intelligence assistant. Create an executive brief with deviation, why, "
     "and immediate actions."),
)

# --- Fixed values: score notes and the marker words they look for ------------
NOTE_RULE = "captures anomaly rule"
NOTE_STORE = "captures store context"
NOTE_ITEM = "captures item context"
NOTE_ROOT_CAUSE = "includes root-cause section"
NOTE_METRICS = "includes observed-vs-expected metrics"
NOTE_CONTEXT = "includes inventory context"
NOTE_ACTIONS = "includes actionable recommendations"
ROOT_CAUSE_MARKER = "Root Cause"
METRIC_MARKERS = ("observed=", "Observed vs expected")
CONTEXT_MARKERS = ("Closing stock", "closing_stock", "forecast")
ACTION_MARKERS = ("Recommendations", "Action Plan", "What to do now")

# --- Fixed values: error messages --------------------------------------------
ERR_NO_DAY_COLUMNS = "No d_* columns found in sales table."
ERR_NO_ANOMALIES = "No anomalies found in validation logs."
ERR_UNKNOWN_ANOMALY = "Anomaly id not found: {}"
