"""Zoneless times, as all tables hold, independent of the session's time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: dt.datetime) -> Column:
    """A Python datetime as the zoneless time it shows; ``F.lit`` would shift it by the
    session's zone."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def instant(zoneless: Column) -> Column:
    """The instant at which clocks in UTC show this time: for operators that need instants,
    so that days begin at midnight and have 24 hours whatever zone the session is in."""
    return F.from_utc_timestamp(zoneless.cast("timestamp"), F.current_timezone())


def zoneless(instant_: Column) -> Column:
    """Inverse of ``instant``."""
    return F.to_utc_timestamp(instant_, F.current_timezone()).cast("timestamp_ntz")
