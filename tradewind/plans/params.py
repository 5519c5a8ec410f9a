"""Numbers and names that the models depend on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Params:
    # Thresholds and labels of the segments and tiers, highest first.
    customer_steps: tuple[tuple[float, str], ...] = ((5, "Loyal"), (2, "Repeat"))
    single_order: str = "One-time"
    no_orders: str = "No Orders"
    product_steps: tuple[tuple[float, str], ...] = ((100, "Bestseller"), (50, "Popular"), (10, "Moderate"))
    product_default: str = "Low Volume"
    seller_steps: tuple[tuple[float, str], ...] = ((10000, "Top Seller"), (5000, "High Performer"), (1000, "Average"))
    seller_default: str = "New/Low Volume"
    unknown: str = "Unknown"
    dropped_statuses: tuple[str, ...] = ("canceled", "unavailable")

    # the customer column to aggregate by
    customer_key: str = "customer_id"
    # decimals of amounts for exact sums; None adds doubles as they come
    money_scale: int | None = None
    # a product or seller without sales counts as one item sold (the row the left join keeps)
    count_unsold_row: bool = True


@dataclass(frozen=True)
class Run:
    """Time and id stamped on the rows of one run."""

    at: datetime
    id: str
    at_column: str = "_loaded_at"
    id_column: str = "_run_id"

    @property
    def columns(self) -> tuple[str, str]:
        return self.at_column, self.id_column
