"""Parameters of a warehouse run, passed to every builder."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class WarehouseConfig:
    """What a run depends on besides its input tables.

    ``end_date`` anchors recency and price validity; ``as_of`` stands in for
    "today" so that reruns give the same rows (``None`` means the clock).
    """

    bronze_root: str = "data/bronze"
    warehouse_root: str = "data/warehouse"
    start_date: date = date(2023, 7, 21)
    end_date: date = date(2026, 7, 20)
    calendar_start: date = date(2023, 1, 1)
    calendar_end: date = date(2027, 12, 31)
    as_of: date | None = None
    full_refresh: bool = False
    # True joins commissions and receivables row by row, so two of them on
    # one order duplicate the fact row; False brings them to one per order.
    fan_out: bool = False
    # Days of order dates the sales fact re-reads; None rebuilds the orders that changed instead.
    sales_window_days: int | None = None
    # True keeps closed versions of the five versioned dimensions, False one current row per key.
    keep_versions: bool = False
    holiday_seed: str | None = None

    @property
    def today(self) -> date:
        return self.as_of or date.today()

    @property
    def calendar_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days + 1
