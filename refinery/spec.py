"""MethodSpec: the per-method differences of the three refresh methods.

The methods do not share one Silver transform: ids, null tests, time range,
defaults, string widths, de-duplication, rounding and the NULL product group
all differ (SURVEY 1.4, V1-V11).  Each difference is a field here so that one
set of DataFrame builders serves all three.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class MethodSpec:
    name: str
    id_separator: str            # V1: '' for clean/batch, '|' for upsert
    null_test: str               # V4: 'path' (JSON null passes) or 'value'
    lower: dt.datetime | None    # V2: inclusive lower bound of review_ts
    upper: dt.datetime | None    # V2: upper bound of review_ts
    upper_inclusive: bool        # V2: clean keeps 2024-01-01 00:00:00 exactly
    helpful_default: int | None  # V6: COALESCE(helpful_vote, 0) or NULL
    images_default: bool | None  # V7: has_images when images is missing
    string_widths: bool          # V8: VARCHAR(n) cut (25/25/50/500)
    dedupe: bool                 # V9: newest row per (user_id, asin)
    round_avg: bool              # V10: ROUND(AVG(rating), 2)
    drop_null_parent: bool       # V11: NULL parent_asin group in Gold
    years: tuple[int, int] | None = None  # batch window: Jan 1 of the first to Jan 1 of the second (F6)

    def for_year(self, year: int) -> "MethodSpec":
        """Batch window [Jan 1 year, Jan 1 year+1)."""
        return replace(self, lower=None, upper=None, years=(year, year + 1))


CLEAN = MethodSpec(
    name="clean_refresh", id_separator="", null_test="path",
    lower=dt.datetime(1996, 1, 1), upper=dt.datetime(2024, 1, 1), upper_inclusive=True,
    helpful_default=0, images_default=None, string_widths=True, dedupe=False,
    round_avg=True, drop_null_parent=False)

# Batch bounds are set per step by ``for_year``; the full range it can cover
# is the watermark's [first year, LAST_BATCH_YEAR].
BATCH = MethodSpec(
    name="batch", id_separator="", null_test="path",
    lower=dt.datetime(1996, 1, 1), upper=dt.datetime(2024, 1, 1), upper_inclusive=False,
    helpful_default=0, images_default=None, string_widths=True, dedupe=False,
    round_avg=True, drop_null_parent=True)

UPSERT = MethodSpec(
    name="upsert", id_separator="|", null_test="value",
    lower=dt.datetime(1996, 1, 1), upper=dt.datetime(2025, 1, 1), upper_inclusive=False,
    helpful_default=None, images_default=False, string_widths=True, dedupe=True,
    round_avg=False, drop_null_parent=True)

FIRST_BATCH_YEAR = 1996
LAST_BATCH_YEAR = 2023
