"""Named row predicates. "Qualified" has three readings, so each has its own name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from herald.functions.times import moment

# Journey states that count as active, and how campaign ids begin.
ACTIVE_STATUSES = ["onboarding_sent", "weekly_active"]
ONBOARDING_PREFIX = "onboarding"
WEEKLY_PREFIX = "weekly"


def in_segment() -> Column:
    return F.col("in_segment") == 1


def reachable() -> Column:
    return F.col("email").isNotNull() & F.col("first_name").isNotNull()


def tagged() -> Column:
    return F.col("location_tag").isNotNull()


def qualified() -> Column:
    """All four tests, as used by the cards and the funnel."""
    return in_segment() & reachable() & tagged()


def segment_tagged() -> Column:
    """The two tests of the per-location breakdown."""
    return in_segment() & tagged()


def exportable(region: str) -> Column:
    """The region export: segment, reachable, and one region."""
    return (F.col("location_tag") == region) & in_segment() & reachable()


def active() -> Column:
    return F.col("journey_status").isin(*ACTIVE_STATUSES)


def entered_flow() -> Column:
    return F.col("journey_status").isNotNull()


def is_event(kind: str) -> Column:
    return F.col("event_type") == kind


def campaign_family() -> Column:
    return (F.when(F.col("campaign_id").startswith(ONBOARDING_PREFIX), "onboarding")
             .when(F.col("campaign_id").startswith(WEEKLY_PREFIX), "weekly"))


def trailing(column: str, as_of: dt.datetime, days: int, periods_back: int = 0) -> Column:
    """Rows in the window of ``days`` that ends at ``as_of`` (end excluded), shifted back."""
    end = as_of - dt.timedelta(days=days * periods_back)
    start = end - dt.timedelta(days=days)
    stamp = F.col(column)
    return (stamp >= moment(start)) & (stamp < moment(end))
