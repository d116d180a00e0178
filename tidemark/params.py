"""Run parameters: every date and threshold a build depends on, fixed per run so reruns agree."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class Params:
    as_of_date: dt.date = field(default_factory=lambda: _utc_now().date())
    run_ts: dt.datetime = field(default_factory=_utc_now)
    near_expiry_days: int = 90
    engagement_days: int = 90
    consumption_days: int = 30
    spine_start: dt.date = dt.date(2025, 1, 1)
    spine_end: dt.date = dt.date(2027, 12, 31)
    at_risk_days_on_hand: int = 60
    at_risk_limit: int = 25
    freshness_warn_hours: int = 30
    freshness_error_hours: int = 48
    sales_lookback_days: int = 7
    visits_lookback_days: int = 7
    inventory_lookback_days: int = 3
    returns_lookback_days: int = 7
    # False: visits older than the lookback wait for a full refresh.
    # True: a changed visit, of any age, brings all rows up to date whose score or gap depends on it.
    late_visits: bool = False
    # "timestamp": a DATE event counts as midnight of its day.
    # "day": a version holds from the first moment of the day it starts.
    asof_granularity: str = "timestamp"
    # True: the first version of a key also covers every event before it.
    asof_first_open: bool = False
