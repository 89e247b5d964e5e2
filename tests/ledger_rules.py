"""The stock ledger's rules, checked row by row on a result (nothing is folded):
an order is placed on a row whose opening is at or under the point and arrives
``lead`` rows later; the opening is the last closing plus what arrived; the
closing is what is left of the opening, whole units, never negative."""
import math

import pytest


def left_over(opening, demand):
    if demand is None:
        return opening
    return 0 if math.isnan(demand) else math.floor(max(0.0, opening - demand))


def assert_openings(opening, arrived, demand, initial=150, point=40, quantity=120, lead=2):
    assert len(opening) == len(arrived) == len(demand)
    for i, (now, units) in enumerate(zip(opening, arrived)):
        ordered = i >= lead and opening[i - lead] <= point
        assert units == (quantity if ordered else 0), i
        before = left_over(opening[i - 1], demand[i - 1]) if i else initial
        assert now == before + units, i


def assert_ledger(rows, demand, forecast, **policy):
    """``rows``: dicts of one series by date; ``demand``, ``forecast``: its input."""
    assert_openings([r["opening_stock"] for r in rows], [r["replenished_qty"] for r in rows], demand, **policy)
    for r, units, ahead in zip(rows, demand, forecast):
        units = 0.0 if units is None else units
        nan = math.isnan(units)
        opening = float(r["opening_stock"])
        filled = opening if nan else min(opening, units)
        assert r["closing_stock"] == left_over(opening, units)
        assert r["fulfilled_qty"] == filled
        assert r["stockout_flag"] == int(units > filled)
        assert r["fulfillment_rate"] == pytest.approx(filled / units if units > 0 else 1.0)
        if not nan:
            assert r["demand"] == units
            assert r["forecast_units"] == (ahead if ahead else units)
