"""Job configuration: thresholds of the rules and the stock policy of the ledger.

Fixed values: the defaults below equal the reference's configuration (14-row
window; spike 1.8, drop 0.45, cover 1.5 days, fulfilment 0.90; restock text
for 3 days of cover; initial stock 150, reorder point 40, reorder quantity
120, lead 2 rows).
"""
from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class StockPolicy:
    """Reorder policy of the stock ledger.

    ``lead_rows`` counts rows of a series, not calendar days: an order placed on
    row ``i`` arrives on row ``i + lead_rows``. A lead of 0 would place an order
    after that row's arrivals were taken, so it would never arrive; it is rejected.
    """

    initial_stock: int = 150
    reorder_point: int = 40
    reorder_qty: int = 120
    lead_rows: int = 2

    def __post_init__(self) -> None:
        for name in ("initial_stock", "reorder_point", "reorder_qty", "lead_rows"):
            value = getattr(self, name)
            if not isinstance(value, int) or isinstance(value, bool):
                raise TypeError(f"{name} must be an int, got {value!r}")
        if self.lead_rows < 1:
            raise ValueError("lead_rows must be >= 1 (an order with lead 0 never arrives)")
        if self.initial_stock < 0 or self.reorder_qty < 0:
            raise ValueError("initial_stock and reorder_qty must be >= 0")


@dataclass(frozen=True)
class SignalConfig:
    """Thresholds shared by the forecast, the rules and the recommendations."""

    window_rows: int = 14
    spike_multiplier: float = 1.8
    drop_multiplier: float = 0.45
    low_cover_days: float = 1.5
    min_fulfillment_rate: float = 0.90
    restock_cover_days: float = 3.0
    segment_rows: int = 500_000  # a job folds series with more rows in segments of about this size
    policy: StockPolicy = field(default_factory=StockPolicy)

    def __post_init__(self) -> None:
        if self.window_rows < 1:
            raise ValueError("window_rows must be >= 1")
        if self.segment_rows < 1:
            raise ValueError("segment_rows must be >= 1")
