"""Run parameters (the reference's project variables and option flags)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class WarehouseParams:
    # Date dimension bounds; the end is exclusive, as in a date spine.
    date_spine_start: dt.date = dt.date(2026, 1, 1)
    date_spine_end: dt.date = dt.date(2026, 12, 31)
    # Documented intent that the SQL does not implement:
    # D1 - drop issues that are pull requests from stg_issues.
    exclude_pull_requests: bool = False
    # P12 - fail on a comment URL without a number (False: its number is NULL).
    strict_comment_numbers: bool = True
    # D9 - weeks by ISO year, and reported from their Monday.
    iso_year: bool = False
    monday_week_start: bool = False
    # Loader metadata written on bronze rows produced by this run.
    load_id: str = "0"

    @property
    def spine_days(self) -> int:
        return max((self.date_spine_end - self.date_spine_start).days, 0)


# Defaults used with the driver's tables. The spine bounds are
# replaced by data-derived ones in plans.warehouse.driver_warehouse: from the
# first order day to the last event day.
DRIVER_PARAMS = WarehouseParams(
    date_spine_start=dt.date(1995, 1, 1),
    date_spine_end=dt.date(2024, 1, 16),
    load_id="driver",
)
# days between the spine's exclusive end and the last event day
DRIVER_SPINE_END_DAYS = 1
