"""Property tests: the streaming kernel against the ledger rules, any batch split."""
from hypothesis import given, settings
from hypothesis import strategies as st

from ledger_rules import assert_openings
from retail_signals.operators.stock_kernel import fold_openings

demand = st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.0, 7.0, 19.5, 40.0, 41.0, 120.0, 500.0]))
policy = st.tuples(st.integers(0, 200), st.integers(0, 100), st.integers(0, 200), st.integers(1, 6))
series = st.lists(st.lists(demand, min_size=1, max_size=40), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(series=series, policy=policy, cut=st.integers(0, 400))
def test_kernel_keeps_the_ledger_rules(series, policy, cut):
    initial, rop, qty, lead = policy
    keys, dem = [], []
    for s, units in enumerate(series):
        keys += [(f"s{s}", "i")] * len(units)
        dem += [0.0 if u is None else u for u in units]
    cut = min(cut, len(keys))
    first, arr1, state = fold_openings(keys[:cut], dem[:cut], None, policy)
    second, arr2, _ = fold_openings(keys[cut:], dem[cut:], state, policy)
    opening = list(first) + list(second)
    arrived = list(arr1) + list(arr2)
    pos = 0
    for units in series:
        end = pos + len(units)
        assert_openings(opening[pos:end], arrived[pos:end], units, initial, rop, qty, lead)
        pos += len(units)
