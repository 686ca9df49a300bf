"""Everything a run may vary, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

# Business rules whose numbers and words decide the results.
START_DATE = date(2022, 1, 1)
PREMIUM_PLANS = ("premium", "enterprise")
COMPLETED_STATUSES = ("paid", "shipped", "delivered")
CANCELLED_STATUS = "cancelled"
MARGIN_RATE = Decimal("0.2")
ACTIVE_WITHIN_DAYS = 30
AT_RISK_WITHIN_DAYS = 90
CHURN_MEDIUM_AFTER_DAYS = 90
CHURN_HIGH_AFTER_DAYS = 180
CLASS_A_SHARE = 0.8
CLASS_B_SHARE = 0.95
TOP_TIER_RANK = 10
SECOND_TIER_RANK = 50
SCORE_BUCKETS = 5


@dataclass(frozen=True)
class Params:
    """Parameters of one run.

    ``as_of`` stands for "today" and ``run_ts`` for "now": no model calls the clock, so a run can be
    repeated. ``best_is_high`` turns the recency/frequency/monetary scores round, so that 5 is the
    best fifth; the default keeps 1 as the best. ``use_clean_orders`` feeds the facts from orders
    with a positive amount only.
    """

    as_of: date
    run_ts: datetime
    start_date: date = START_DATE
    premium_plans: tuple[str, ...] = PREMIUM_PLANS
    completed_statuses: tuple[str, ...] = COMPLETED_STATUSES
    margin_rate: Decimal = MARGIN_RATE
    best_is_high: bool = False
    use_clean_orders: bool = False
