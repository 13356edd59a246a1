"""The operator board: every metric set under the board's two filters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.functions import predicates as p
from herald.operators import alerts, metrics
from herald.scale import keyed_join, settle


@dataclass(frozen=True)
class Tables:
    audience: DataFrame
    inventory: DataFrame
    sync: DataFrame
    events: DataFrame

    def at_location(self, location: str) -> Tables:
        """Only the contacts of one location, what was sent to them, and its stock. Events and
        syncs, which most panels read, are filtered and written once."""
        people = self.audience.filter(F.col("location_tag") == location)
        ids = settle(people.select("member_id"), "location-members")
        return Tables(people,
                      self.inventory.filter(F.col("shop_location") == location),
                      settle(keyed_join(self.sync, ids, ["member_id"], "left_semi"), "location-syncs"),
                      settle(keyed_join(self.events, ids, ["member_id"], "left_semi"), "location-events"))

    def in_window(self, as_of: dt.datetime, days: int) -> Tables:
        """Contacts, syncs and events of the trailing window; stock is a present state."""
        return Tables(self.audience.filter(p.trailing("ingested_at", as_of, days)),
                      self.inventory,
                      self.sync.filter(p.trailing("synced_at", as_of, days)),
                      self.events.filter(p.trailing("event_at", as_of, days)))


def dashboard(tables: Tables, as_of: dt.datetime, days: int = 30,
              location: str | None = None) -> dict[str, DataFrame]:
    """All panels. Cards and journeys follow the window; the location table and the alerts
    describe the present state."""
    here = tables.at_location(location) if location else tables
    recent = here.in_window(as_of, days)
    return {
        "cards": metrics.kpi_cards(recent.audience, recent.sync, recent.events),
        "deltas": metrics.period_delta(here.audience, here.sync, here.events, as_of, days),
        "funnel": metrics.funnel(here.audience, here.sync),
        "journeys": metrics.journey_performance(recent.events),
        "pooled": metrics.pooled_rates(recent.events),
        "inventory": metrics.inventory_coverage(here.inventory, as_of),
        "locations": metrics.location_status(here.audience, here.sync, here.events,
                                             here.inventory),
        "low_inventory": alerts.low_inventory(here.inventory),
        "low_engagement": alerts.low_engagement(here.audience, here.events),
        "untagged": alerts.untagged_alert(tables.audience),
    }


def register_views(panels: dict[str, DataFrame], prefix: str = "board_") -> list[str]:
    """Offer the panels to SQL users as temporary views."""
    for name, panel in panels.items():
        panel.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in panels]
