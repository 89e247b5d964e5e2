"""DuckDB SQL computing the same results as the registered queries.

Independent of the Spark code paths: plain joins, windows, a recursive CTE
for the stock ledger, CASE chains for the texts. The fixed texts come from
``vocabulary`` so both sides print the same words. Tables ``lineitem``,
``part`` and ``supplier`` are views over the test parquet files.
"""
from __future__ import annotations

from ..config import SignalConfig
from ..sources.testdata import CATEGORY, EPOCH, EVENT_CYCLE_DAYS, EVENT_DAYS, EVENT_NAME, \
    EVENT_TYPE, WEEK_DAYS
from ..vocabulary import (ACTION_BY_RULE, ACTION_OTHERWISE, CANDIDATES, NO_CONTEXT_TEXT,
                          NO_RECOMMENDATION_LINE, NOTE_ACTIONS, NOTE_CONTEXT, NOTE_ITEM,
                          NOTE_METRICS, NOTE_ROOT_CAUSE, NOTE_RULE, NOTE_STORE, ROOT_CAUSE_BY_RULE,
                          ROOT_CAUSE_OTHERWISE, RULES, SENTENCE_BY_RULE, SENTENCE_OTHERWISE)

CFG = SignalConfig()
NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_events = ", ".join(str(x) for x in EVENT_DAYS)

INPUTS = f"""
li AS (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS store_id, p.p_type AS item_id,
         CAST(s.s_nationkey AS VARCHAR) AS state_id,
         CAST(l.l_shipdate AS DATE) - DATE '{EPOCH}' AS k, l.l_quantity AS quantity,
         CASE WHEN l.l_returnflag <> 'R' THEN l.l_extendedprice / l.l_quantity END AS unit_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey),
sales AS (
  SELECT item_id, item_id AS dept_id, '{CATEGORY}' AS cat_id, store_id, state_id, k,
         'd_' || CAST(k + 1 AS VARCHAR) AS d, CAST(sum(quantity) AS DOUBLE) AS units_sold
  FROM li GROUP BY store_id, item_id, state_id, k),
days AS (SELECT unnest(range(min(k), max(k) + 1)) AS k
         FROM (SELECT CAST(l_shipdate AS DATE) - DATE '{EPOCH}' AS k FROM lineitem)),
cal AS (
  SELECT k, 'd_' || CAST(k + 1 AS VARCHAR) AS d, DATE '{EPOCH}' + CAST(k AS INTEGER) AS date,
         CAST(floor(k / {WEEK_DAYS}) + 1 AS INTEGER) AS wm_yr_wk,
         CASE WHEN k % {EVENT_CYCLE_DAYS} IN ({_events}) THEN '{EVENT_NAME}' END AS event_name_1,
         CASE WHEN k % {EVENT_CYCLE_DAYS} IN ({_events}) THEN '{EVENT_TYPE}' END AS event_type_1
  FROM days),
prices AS (
  SELECT store_id, item_id, CAST(floor(k / {WEEK_DAYS}) + 1 AS INTEGER) AS wm_yr_wk,
         max(unit_price) AS sell_price
  FROM li WHERE unit_price IS NOT NULL GROUP BY ALL),
demand AS (
  SELECT c.date, s.d, s.store_id, s.state_id, s.item_id, s.dept_id, s.cat_id, s.units_sold,
         p.sell_price AS price, c.event_name_1, c.event_type_1,
         CASE WHEN c.event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS is_promo
  FROM sales s LEFT JOIN cal c ON s.d = c.d
       LEFT JOIN prices p ON p.store_id = s.store_id AND p.item_id = s.item_id
                          AND p.wm_yr_wk = c.wm_yr_wk),
base AS (
  SELECT *, avg(units_sold) OVER (PARTITION BY store_id, item_id ORDER BY date
            ROWS BETWEEN {CFG.window_rows} PRECEDING AND 1 PRECEDING) AS rolling_mean
  FROM demand)"""

_P = CFG.policy
_open = f"(l.closing + CASE WHEN l.f_prev THEN {_P.reorder_qty} ELSE 0 END)"
assert _P.lead_rows == 2, "the oracle CTE carries exactly two reorder flags"

LEDGER = f"""
ord AS MATERIALIZED (
  SELECT *, coalesce(units_sold, {dbl(0.0)}) AS demand_q,
         row_number() OVER (PARTITION BY store_id, item_id ORDER BY date) AS i,
         coalesce(rolling_mean, units_sold, {dbl(0.0)}) AS fc_in
  FROM base),
led AS (
  SELECT store_id, item_id, i, {_P.initial_stock} AS opening, 0 AS rep,
         CAST(floor(greatest({dbl(0.0)}, {_P.initial_stock}
              - least(CAST({_P.initial_stock} AS DOUBLE), demand_q))) AS INTEGER) AS closing,
         {_P.initial_stock} <= {_P.reorder_point} AS f_cur, false AS f_prev
  FROM ord WHERE i = 1
  UNION ALL
  SELECT o.store_id, o.item_id, o.i, {_open},
         CASE WHEN l.f_prev THEN {_P.reorder_qty} ELSE 0 END,
         CAST(floor(greatest({dbl(0.0)}, {_open} - least(CAST({_open} AS DOUBLE), o.demand_q)))
              AS INTEGER),
         {_open} <= {_P.reorder_point}, l.f_cur
  FROM led l JOIN ord o ON o.store_id = l.store_id AND o.item_id = l.item_id AND o.i = l.i + 1),
ledger AS (
  SELECT o.date, o.store_id, o.state_id, o.item_id, o.dept_id, o.cat_id,
         o.demand_q AS demand,
         CASE WHEN o.fc_in = 0 THEN o.demand_q ELSE o.fc_in END AS forecast_units,
         l.opening AS opening_stock, l.rep AS replenished_qty,
         least(CAST(l.opening AS DOUBLE), o.demand_q) AS fulfilled_qty,
         l.closing AS closing_stock,
         CASE WHEN o.demand_q > least(CAST(l.opening AS DOUBLE), o.demand_q) THEN 1 ELSE 0 END
           AS stockout_flag,
         CASE WHEN o.demand_q > 0 THEN least(CAST(l.opening AS DOUBLE), o.demand_q) / o.demand_q
              ELSE {dbl(1.0)} END AS fulfillment_rate,
         o.units_sold, o.rolling_mean, o.price
  FROM led l JOIN ord o ON o.store_id = l.store_id AND o.item_id = l.item_id AND o.i = l.i)"""

LEDGER_COLS = ("date, store_id, state_id, item_id, dept_id, cat_id, demand, forecast_units, "
               "opening_stock, replenished_qty, fulfilled_qty, closing_stock, stockout_flag, "
               "fulfillment_rate")


def _rule_sql(rule: str, src: str, pred: str, metric: str, expected: str) -> str:
    sev, details = RULES[rule]
    return (f"SELECT sha256(concat_ws('|', {q(rule)}, CAST(date AS VARCHAR), store_id, item_id))"
            f" AS anomaly_id, date, store_id, item_id, {q(rule)} AS rule_name, {q(sev)} AS "
            f"severity, CAST({metric} AS DOUBLE) AS metric_value, CAST({expected} AS DOUBLE) AS "
            f"expected_value, {q(details)} AS details FROM {src} WHERE {pred}")


RULE_SQL = {
    "demand_spike": _rule_sql(
        "demand_spike", "base",
        f"rolling_mean IS NOT NULL AND units_sold > rolling_mean * {dbl(CFG.spike_multiplier)}",
        "units_sold", "rolling_mean"),
    "demand_drop": _rule_sql(
        "demand_drop", "base",
        f"rolling_mean IS NOT NULL AND units_sold < rolling_mean * {dbl(CFG.drop_multiplier)}",
        "units_sold", "rolling_mean"),
    "low_inventory": _rule_sql(
        "low_inventory", "ledger", f"closing_stock < forecast_units * {dbl(CFG.low_cover_days)}",
        "closing_stock", f"forecast_units * {dbl(CFG.low_cover_days)}"),
    "fulfillment_drop": _rule_sql(
        "fulfillment_drop", "ledger", f"fulfillment_rate < {dbl(CFG.min_fulfillment_rate)}",
        "fulfillment_rate", dbl(CFG.min_fulfillment_rate)),
    "missing_price": _rule_sql("missing_price", "base", "price IS NULL", "NULL", "NULL"),
}

ANOMALIES = "anoms AS (" + "\n  UNION ALL ".join(RULE_SQL.values()) + ")"

LATEST = f"""
latest AS (
  SELECT {LEDGER_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rn
    FROM ledger) WHERE rn = 1)"""


def _case(mapping: dict, otherwise: str, col: str = "a.rule_name") -> str:
    whens = " ".join(f"WHEN {col} = {q(k)} THEN {v}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {otherwise} END"


def _sentence_sql(pieces) -> str:
    qty = (f"CAST(CAST(greatest({dbl(0.0)}, ceil(l.forecast_units * {dbl(CFG.restock_cover_days)}"
           f" - l.closing_stock)) AS INTEGER) AS VARCHAR)")
    cols = {"item_id": "a.item_id", "store_id": "a.store_id", "cat_id": "l.cat_id"}
    parts = [qty if p is None else cols.get(p, q(p.format(cover="3"))) for p in pieces]
    return "concat_ws(' ', " + ", ".join(parts) + ")"


RECS = f"""
recs AS (
  SELECT DISTINCT a.anomaly_id, a.date, a.store_id, a.item_id,
    {_case({k: q(v) for k, v in ACTION_BY_RULE.items()}, q(ACTION_OTHERWISE))} AS action_type,
    {_case({k: _sentence_sql(v) for k, v in SENTENCE_BY_RULE.items()},
           _sentence_sql(SENTENCE_OTHERWISE))} AS recommendation
  FROM anoms a LEFT JOIN latest l ON a.store_id = l.store_id AND a.item_id = l.item_id)"""


def _contains_any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


_root = _case({k: q(v) for k, v in ROOT_CAUSE_BY_RULE.items()}, q(ROOT_CAUSE_OTHERWISE))
_c = "CAST(x.c AS VARCHAR)"
_f = "CAST(round(x.f, 2) AS VARCHAR)"
_m = "coalesce(CAST(a.metric_value AS VARCHAR), 'nan')"
_e = "coalesce(CAST(a.expected_value AS VARCHAR), 'nan')"
_d = "CAST(a.date AS VARCHAR)"


def _responses_sql() -> list[str]:
    j = lambda *xs: " || ".join(xs)
    baseline = j("'Anomaly ID: '", "a.anomaly_id", NL, "'Rule: '", "a.rule_name", NL,
                 "'Date: '", _d, NL, "'Store: '", "a.store_id", NL, "'Item: '", "a.item_id", NL,
                 "'Severity: '", "a.severity", NL, "'Observed vs expected: '", _m, "' vs '", _e,
                 NL, "'Details: '", "a.details", NL, "'Context: '", "ctx_text", NL, NL,
                 "'Root Cause Analysis:'", NL, "root_cause", NL, NL, "'Recommendations:'", NL,
                 "rec_text", NL)
    structured = j("'Incident Summary'", NL, "'- anomaly_id: '", "a.anomaly_id", NL,
                   "'- rule: '", "a.rule_name", NL, "'- severity: '", "a.severity", NL,
                   "'- location: store='", "a.store_id", "', item='", "a.item_id", NL,
                   "'- time: '", _d, NL, "'- metric_gap: observed='", _m, "', expected='", _e,
                   NL, NL, "'Root Cause'", NL, "root_cause", NL, NL, "'Operational Context'", NL,
                   "'- '", "ctx_text", NL, NL, "'Action Plan'", NL, "rec_text", NL)
    brief = j("'Decision Intelligence Brief'", NL, "'Signal: '", "a.rule_name", "' ('",
              "a.severity", "') on '", _d, "' for '", "a.item_id", "' at '", "a.store_id", "'.'",
              NL, "'Deviation: observed='", _m, "', expected='", _e, "'.'", NL,
              "'Why it happened: '", "root_cause", NL, "'Current operating state: '", "ctx_text",
              "'.'", NL, "'What to do now:'", NL, "rec_text", NL)
    return [baseline, structured, brief]


def _score_sql(resp: str) -> tuple[str, str]:
    checks = [(f"a.rule_name <> '' AND contains({resp}, a.rule_name)", 2, NOTE_RULE),
              (f"a.store_id <> '' AND contains({resp}, a.store_id)", 2, NOTE_STORE),
              (f"a.item_id <> '' AND contains({resp}, a.item_id)", 2, NOTE_ITEM),
              (f"contains({resp}, 'Root Cause')", 2, NOTE_ROOT_CAUSE),
              (_contains_any(resp, ("observed=", "Observed vs expected")), 2, NOTE_METRICS),
              ("has_ctx AND " + _contains_any(resp, ("Closing stock", "closing_stock",
                                                     "forecast")), 1, NOTE_CONTEXT),
              ("has_recs AND " + _contains_any(resp, ("Recommendations", "Action Plan",
                                                      "What to do now")), 2, NOTE_ACTIONS)]
    score = " + ".join(f"(CASE WHEN {c} THEN {p} ELSE 0 END)" for c, p, _ in checks)
    notes = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {q(n)} END"
                                           for c, _, n in checks) + ")"
    return f"CAST({score} AS INTEGER)", notes


def _diag_sql() -> str:
    rounds = []
    for i, ((name, _), resp) in enumerate(zip(CANDIDATES, _responses_sql()), start=1):
        score, notes = _score_sql("resp")
        rounds.append(f"SELECT anomaly_id, {i} AS round, {q(name)} AS candidate_name, "
                      f"{score} AS score, {notes} AS score_notes, resp AS response FROM "
                      f"(SELECT a.anomaly_id, a.rule_name, a.store_id, a.item_id, has_ctx, "
                      f"has_recs, {resp} AS resp FROM dx a) a")
    return f"""
ctx AS (SELECT store_id, item_id, closing_stock AS c, forecast_units AS f, true AS present
        FROM latest),
rl AS (SELECT anomaly_id, string_agg('- ' || recommendation, {NL} ORDER BY recommendation)
       AS lines FROM recs GROUP BY anomaly_id),
dx AS (
  SELECT a.*, coalesce(x.present, false) AS has_ctx, rl.lines IS NOT NULL AS has_recs,
    CASE WHEN x.present THEN 'Closing stock=' || {_c} || ', forecast=' || {_f}
         ELSE {q(NO_CONTEXT_TEXT)} END AS ctx_text,
    coalesce(rl.lines, {q(NO_RECOMMENDATION_LINE)}) AS rec_text,
    {_root} || CASE WHEN x.present THEN ' Current closing stock: ' || {_c}
                    || ', latest forecast: ' || {_f} || '.' ELSE '' END AS root_cause
  FROM anoms a LEFT JOIN ctx x ON a.store_id = x.store_id AND a.item_id = x.item_id
       LEFT JOIN rl ON rl.anomaly_id = a.anomaly_id),
cands AS ({' UNION ALL '.join(rounds)}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anomaly_id
                 ORDER BY score DESC, round ASC) AS rk FROM cands) WHERE rk = 1),
round_lines AS (
  SELECT anomaly_id, string_agg('- Round ' || CAST(round AS VARCHAR) || ': ' || candidate_name
         || ' | score=' || CAST(score AS VARCHAR), {NL} ORDER BY round) AS lines
  FROM cands GROUP BY anomaly_id)"""


def _with(*blocks: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(b.strip() for b in blocks) + "\n"


_ALL = (INPUTS, LEDGER, ANOMALIES, LATEST, RECS)

ORACLE_SQL: dict[str, str] = {
    "demand_unpivot": _with(INPUTS) + """
SELECT g.store_id, g.item_id, g.state_id, g.item_id AS dept_id, '""" + CATEGORY + """' AS cat_id,
       'd_' || CAST(days.k + 1 AS VARCHAR) AS d, s.units_sold
FROM (SELECT DISTINCT store_id, item_id, state_id FROM sales) g CROSS JOIN days
LEFT JOIN sales s ON s.store_id = g.store_id AND s.item_id = g.item_id AND s.k = days.k""",
    "demand_timeseries": _with(INPUTS) + "SELECT * FROM demand",
    "forecast_rolling_mean": _with(INPUTS) + f"""
SELECT date, store_id, item_id, coalesce(rolling_mean, units_sold, {dbl(0.0)}) AS forecast_units
FROM base""",
    "forecast_attach": _with(INPUTS) + f"""
SELECT date, store_id, item_id, units_sold,
       CASE WHEN (CAST(floor((date - DATE '1995-01-01') / 7.0) AS BIGINT) % 3 + 3) % 3 = 0 THEN units_sold
            ELSE coalesce(coalesce(rolling_mean, units_sold, {dbl(0.0)}), units_sold) END AS forecast_units
FROM base""",
    "stock_projection": _with(INPUTS, LEDGER) + f"SELECT {LEDGER_COLS} FROM ledger",
    "rule_demand_spike": _with(INPUTS) + RULE_SQL["demand_spike"],
    "rule_demand_drop": _with(INPUTS) + RULE_SQL["demand_drop"],
    "rule_low_inventory": _with(INPUTS, LEDGER) + RULE_SQL["low_inventory"],
    "rule_fulfillment_drop": _with(INPUTS, LEDGER) + RULE_SQL["fulfillment_drop"],
    "rule_missing_price": _with(INPUTS) + RULE_SQL["missing_price"],
    "anomalies_all": _with(INPUTS, LEDGER, ANOMALIES) + "SELECT * FROM anoms",
    "anomalies_fused": _with(INPUTS, LEDGER, ANOMALIES) + "SELECT * FROM anoms",
    "latest_inventory": _with(INPUTS, LEDGER, LATEST) + "SELECT * FROM latest",
    "recommendations": _with(*_ALL) + "SELECT * FROM recs",
    "top_anomaly": _with(INPUTS, LEDGER, ANOMALIES) + """
SELECT * FROM anoms
ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, date DESC, anomaly_id
LIMIT 1""",
    "diagnosis_context": _with(*_ALL, _diag_sql()) + """
SELECT anomaly_id, ctx_text AS context_text, rec_text AS recommendation_lines FROM dx""",
    "diagnosis_root_cause": _with(*_ALL, _diag_sql()) + """
SELECT anomaly_id, rule_name, root_cause FROM dx""",
    "diagnosis_candidates": _with(*_ALL, _diag_sql()) + "SELECT * FROM cands",
    "diagnosis_best": _with(*_ALL, _diag_sql()) + f"""
SELECT b.anomaly_id, b.candidate_name AS best_candidate, b.score AS best_score,
       b.response || {NL} || {NL} || 'Prompt Evolution:' || {NL} || 'Selected candidate: '
       || b.candidate_name || {NL} || 'Best score: ' || CAST(b.score AS VARCHAR) || {NL}
       || 'Rounds:' || {NL} || r.lines || {NL} AS explanation
FROM best b JOIN round_lines r ON r.anomaly_id = b.anomaly_id""",
}
ORACLE_SQL["diagnosis_top"] = ORACLE_SQL["diagnosis_best"] + """
WHERE b.anomaly_id = (
  SELECT anomaly_id FROM anoms
  ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, date DESC, anomaly_id
  LIMIT 1)"""
ORACLE_SQL["diagnosis_stored"] = ORACLE_SQL["diagnosis_best"]
_prompts = " ".join(f"WHEN {q(name)} THEN {q(prompt)}" for name, prompt in CANDIDATES)
ORACLE_SQL["diagnosis_rounds"] = _with(*_ALL, _diag_sql()) + f"""
SELECT anomaly_id, string_agg(concat_ws(' | ', CAST(round AS VARCHAR), candidate_name,
         CASE candidate_name {_prompts} END, CAST(score AS VARCHAR), score_notes, response),
         {NL} ORDER BY round) AS rounds_text
FROM cands GROUP BY anomaly_id"""
_TOP_ID = """
  SELECT anomaly_id FROM anoms
  ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, date DESC, anomaly_id
  LIMIT 1"""
ORACLE_SQL["diagnosis_job"] = ORACLE_SQL["diagnosis_best"]
ORACLE_SQL["diagnosis_by_id"] = ORACLE_SQL["diagnosis_best"] + """
WHERE b.anomaly_id IN (
  SELECT anomaly_id FROM (SELECT anomaly_id, row_number() OVER (PARTITION BY rule_name
    ORDER BY date DESC, anomaly_id DESC) AS nth FROM anoms) WHERE nth = 1)"""
ORACLE_SQL["diagnosis_report"] = (
    "SELECT explanation AS report FROM (" + ORACLE_SQL["diagnosis_top"] + ")")
# Every series has a row for each day of the calendar; days without sales have no units.
ORACLE_SQL["demand_from_csv"] = _with(INPUTS) + """
SELECT c.date, c.d, g.store_id, g.state_id, g.item_id, g.item_id AS dept_id, '""" + CATEGORY + """' AS cat_id,
       s.units_sold, p.sell_price AS price, c.event_name_1, c.event_type_1,
       CASE WHEN c.event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS is_promo
FROM (SELECT DISTINCT store_id, item_id, state_id FROM sales) g CROSS JOIN cal c
LEFT JOIN sales s ON s.store_id = g.store_id AND s.item_id = g.item_id AND s.k = c.k
LEFT JOIN prices p ON p.store_id = g.store_id AND p.item_id = g.item_id AND p.wm_yr_wk = c.wm_yr_wk"""
ORACLE_SQL["rejected_raw"] = _with(INPUTS) + """
SELECT 'sell_prices.csv' AS source, concat_ws(',', store_id, item_id, wm_yr_wk, 'n/a') AS raw
FROM prices WHERE wm_yr_wk % 11 = 0"""
ORACLE_SQL["demand_figures"] = _with(INPUTS) + f"""
, marked AS (SELECT s.*, (s.k + 1) % 13 = 0 AS undated, floor(s.k / {WEEK_DAYS}) + 1 AS week FROM sales s),
priced AS (
  SELECT m.*, p.sell_price IS NOT NULL AS priced FROM marked m LEFT JOIN prices p
  ON p.store_id = m.store_id AND p.item_id = m.item_id AND p.wm_yr_wk = m.week AND NOT m.undated),
twice AS (SELECT count(*) AS n FROM priced WHERE priced AND week % 10 = 0)
SELECT unnest(['sales_rows', 'sales_without_units', 'undated_rows', 'rows_added_by_calendar', 'rows_added_by_prices',
               'rows_without_price', 'ledger_rows', 'repeated_dates']) AS figure,
       CAST(unnest([(SELECT count(*) FROM sales), 0, (SELECT count(*) FROM marked WHERE undated), 0,
                    (SELECT n FROM twice), (SELECT count(*) FROM priced WHERE NOT priced),
                    (SELECT count(*) FROM marked WHERE NOT undated) + (SELECT n FROM twice),
                    (SELECT n FROM twice)]) AS BIGINT) AS value"""
_SET = """
SELECT 'processed_demand' AS table_name, date, store_id, item_id, d AS label, units_sold AS value_1,
       CAST(price AS DOUBLE) AS value_2, event_name_1 AS text FROM demand
UNION ALL SELECT 'forecast', date, store_id, item_id, NULL, coalesce(rolling_mean, units_sold, 0), NULL, NULL FROM base
UNION ALL SELECT 'inventory_fulfillment', date, store_id, item_id, CAST(stockout_flag AS VARCHAR),
       CAST(opening_stock AS DOUBLE), CAST(closing_stock AS DOUBLE), state_id FROM ledger
UNION ALL SELECT 'validation_logs', date, store_id, item_id, rule_name, metric_value, expected_value, anomaly_id
  FROM anoms
UNION ALL SELECT 'recommendations', date, store_id, item_id, action_type, NULL, NULL, recommendation FROM recs"""
ORACLE_SQL["pipeline_tables"] = ORACLE_SQL["build_all"] = _with(*_ALL) + _SET
ORACLE_SQL["actions_by_series"] = ORACLE_SQL["diagnosis_best"].replace(
    "SELECT b.anomaly_id,", "SELECT r2.store_id, r2.item_id, r2.action_type, r2.recommendation, b.anomaly_id,", 1
).replace("b.score AS best_score,", "", 1) + " JOIN recs r2 ON r2.anomaly_id = b.anomaly_id"
# The same SQL printed with other numbers in the places of the defaults.
_OTHER = (
    (f"ROWS BETWEEN {CFG.window_rows} PRECEDING", "ROWS BETWEEN 7 PRECEDING"),
    (f"rolling_mean * {dbl(CFG.spike_multiplier)}", f"rolling_mean * {dbl(2.5)}"),
    (f"rolling_mean * {dbl(CFG.drop_multiplier)}", f"rolling_mean * {dbl(0.3)}"),
    (f"forecast_units * {dbl(CFG.low_cover_days)}", f"forecast_units * {dbl(2.0)}"),
    (f"fulfillment_rate < {dbl(CFG.min_fulfillment_rate)}", f"fulfillment_rate < {dbl(0.75)}"),
    (f"CAST({dbl(CFG.min_fulfillment_rate)} AS DOUBLE) AS expected_value",
     f"CAST({dbl(0.75)} AS DOUBLE) AS expected_value"),
    (f"forecast_units * {dbl(CFG.restock_cover_days)}", f"forecast_units * {dbl(5.0)}"),
    ("to restore 3-day", "to restore 5-day"),
)
_sql = _with(*_ALL) + """
SELECT a.*, r.action_type, r.recommendation FROM anoms a JOIN recs r ON r.anomaly_id = a.anomaly_id"""
for _was, _now in _OTHER:
    assert _was in _sql, _was
    _sql = _sql.replace(_was, _now)
ORACLE_SQL["other_settings"] = _sql
