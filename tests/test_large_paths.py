"""The same results when nothing may be broadcast, as with sides too large for it."""

import pytest

import oracle
from herald import scale
from herald.operators import locations, ranking
from herald.sources import tables

NAMES = ["location_breakdown", "location_status", "location_tag_all", "location_tag_first",
         "ab_stratified_ranked", "ab_results", "orphan_events", "events_without_sync",
         "segment_flag", "segment_members", "upsert_latest", "ingest_audience", "shop_normalize",
         "select_picks", "messages", "dashboard_location_cards", "constraint_audit"]


@pytest.fixture
def nothing_fits(spark, monkeypatch):
    for module in (scale, ranking, tables):
        monkeypatch.setattr(module, "fits_broadcast", lambda *args, **kwargs: False)
    monkeypatch.setattr(locations, "_names_if_few", lambda *args: None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, nothing_fits, name):
    oracle.check(spark, con, name)
