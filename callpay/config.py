"""Run settings shared by every model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from callpay.sources.contracts import CURRENCIES, PAYMENT_KEY


@dataclass(frozen=True)
class PipelineConfig:
    """Settings of one run.

    ``as_of`` fixes the clock used for provisional/final flags (UTC, naive);
    ``None`` means the time at which the query runs.
    """

    window_days: int = 3
    as_of: datetime | None = None
    inbound_type: str = "Inbound Team"
    missing_label: str = "Not specified"
    currencies: tuple[str, ...] = CURRENCIES
    payment_key_cols: tuple[str, ...] = PAYMENT_KEY
    match_tenant: bool = False
    null_safe_days: bool = False
    stop_on_failure: bool = True

    @property
    def attribution_key(self) -> list[str]:
        return ["atlas_tenant_id", "contract_id"] if self.match_tenant else ["contract_id"]
