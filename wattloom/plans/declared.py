"""Column tests that the models promise, by table."""

from __future__ import annotations

from wattloom.operators.quality import NOT_NULL, UNIQUE
from wattloom.schemas import BATTERY_ACTIONS, PRICE_ZONES, REGIONS

MODEL_TESTS: dict[str, dict[str, tuple]] = {
    "staged_prices": {"start_time": (UNIQUE, NOT_NULL), "end_time": (NOT_NULL,), "price_eur_mwh": (NOT_NULL,)},
    "price_mart": {"start_time": (NOT_NULL,), "price_eur_mwh": (NOT_NULL,)},
    "devices": {"customer_key": (UNIQUE, NOT_NULL), "gateway_id": (UNIQUE, NOT_NULL), "is_vpp_enrolled": (NOT_NULL,)},
    "telemetry": {"customer_key": (NOT_NULL,), "gateway_id": (NOT_NULL,)},
    "capacity_hourly": {"hour": (NOT_NULL,), "region": (NOT_NULL, REGIONS)},
    "arbitrage": {"hour": (NOT_NULL,), "customer_key": (NOT_NULL,), "price_zone": (PRICE_ZONES,), "battery_action": (BATTERY_ACTIONS,)},
}
