"""Fixed business values and the names of the lake's layers."""

from __future__ import annotations

from dataclasses import dataclass

# The line-item life cycle. CANCELLED and RETURNED are terminal.
PENDING = "PENDING"
SHIPPED = "SHIPPED"
DELIVERED = "DELIVERED"
CANCELLED = "CANCELLED"
RETURNED = "RETURNED"
LINE_STATUSES = (PENDING, SHIPPED, DELIVERED, CANCELLED, RETURNED)


@dataclass(frozen=True)
class LakeNames:
    """Where each layer lives: an optional catalog and one schema per layer."""

    bronze: str = "orders_bronze"
    silver: str = "orders_silver"
    gold: str = "orders_gold"
    catalog: str | None = None
