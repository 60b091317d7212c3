"""What one run knows about itself, and the thresholds it is held to."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Service levels. They decide which checks pass."""

    layer_minutes: float = 60.0
    quarantine_pct: float = 5.0
    watermark_age_hours: float = 25.0
    null_key_pct: float = 2.0
    review_days: int = 180
    escalation_days: int = 365


@dataclass(frozen=True)
class RunContext:
    """Identity and clock of a run; injected so that results never depend on the wall clock."""

    run_id: str
    run_ts: datetime
    limits: Limits = field(default_factory=Limits)

    @property
    def run_date(self) -> date:
        return self.run_ts.date()

    @property
    def ts(self) -> Column:
        return F.lit(self.run_ts.isoformat(" ")).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.lit(self.run_date.isoformat()).cast("date")


# Accepted codes after cleansing, and the reason written on rows that fail a rule.
STATUSES = ["Released", "Draft", "Obsolete", "In Review", "Approved"]
CURRENCIES = ["INR", "USD", "EUR", "GBP", "JPY"]

REASON_NO_PART = "null part_id"
REASON_NO_START = "null effective_from"
REASON_STATUS = f"status not in {STATUSES}"
REASON_QUANTITY = "quantity null or <= 0"
REASON_COST = "cost null or <= 0"
REASON_CURRENCY = f"currency not in {CURRENCIES}"

# Which data domains each reader group may see.
GROUP_DOMAINS = {
    "engineering": ["plm", "cad"],
    "procurement": ["erp", "conformed"],
    "management": ["plm", "cad", "erp", "conformed"],
    "data_analysts": ["plm", "cad", "erp", "conformed"],
}

EPOCH_START = "1900-01-01"
