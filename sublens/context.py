"""Report clock and tunable parameters.

The original report reads the warehouse clock inline.  Here "today" is an
explicit argument so a run is reproducible and can be replayed for any day;
every date the measures compare against is derived from it once, on the
driver, and enters the plans as a literal (constant-folded, pushed to scans).
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from sublens.functions import domain


@dataclass(frozen=True)
class ReportContext:
    """Parameters of one report run.

    ``today`` is T; the report date is D = T - 1.  Defaults of the campaign
    and attribution parameters are the original report's fixed values.
    """

    today: dt.date
    # FIXED VALUES (defaults) of the original report
    campaign_first: dt.date = dt.date(2021, 2, 10)
    campaign_last: dt.date = dt.date(2021, 2, 16)
    campaign_end_cap: dt.date = dt.date(2021, 3, 17)
    attribution_cutoff: dt.date = dt.date(2020, 7, 31)
    attribution_trial_period: int = 23
    attribution_max_gap: int = 30
    attribution_tenure: int = 14
    upcoming_days: int = 29
    play_floor_seconds: int = 15
    short_window_days: int = 7
    long_window_days: int = 30
    suspended_lag_days: int = 2
    seconds_per_hour: int = 3600
    content_label_token: str = domain.CONTENT_LABEL_TOKEN
    vip_promotions: tuple[str, ...] = domain.VIP_PROMOTIONS
    partner_excluded_ids: tuple[str, ...] = domain.PARTNER_EXCLUDED_IDS
    # physical layout knobs (not semantics)
    lag_bucket_width: int = 1 << 20

    # -- derived dates -----------------------------------------------------
    @property
    def report_date(self) -> dt.date:
        """D: the day the report describes (yesterday)."""
        return self.today - dt.timedelta(days=1)

    @property
    def upcoming_last(self) -> dt.date:
        return self.today + dt.timedelta(days=self.upcoming_days)

    @property
    def short_window(self) -> tuple[dt.date, dt.date]:
        """[T-7, T-1]."""
        return self.today - dt.timedelta(days=self.short_window_days), self.report_date

    @property
    def long_window(self) -> tuple[dt.date, dt.date]:
        """[T-30, T-1]."""
        return self.today - dt.timedelta(days=self.long_window_days), self.report_date

    @property
    def suspended_end(self) -> dt.date:
        return self.today - dt.timedelta(days=self.suspended_lag_days)

    @property
    def month_last(self) -> dt.date:
        """last_day(T)."""
        last = calendar.monthrange(self.today.year, self.today.month)[1]
        return self.today.replace(day=last)

    @property
    def engagement_floor(self) -> dt.date:
        """Earliest engagement day any measure reads."""
        return min(self.long_window[0], self.short_window[0], self.report_date)


def parse_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
