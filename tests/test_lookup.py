"""Keyed lookup with expiry: the cases of the fixture description."""

import datetime as dt

import pytest

from relayout.operators import lookup as L

AS_OF = "2024-01-15 00:00:00"
T0 = dt.datetime(2024, 1, 15)
DAY = dt.timedelta(days=1)


@pytest.fixture
def tables(spark):
    lookup = spark.createDataFrame([
        ("a", 1, "live", T0 + DAY),
        ("a", 2, "expired", T0 - DAY),
        ("a", 3, "expires-now", T0),
        ("a", 4, "forever", None),
        ("b", 1, "other-ns", T0 + DAY),
    ], "namespace string, key bigint, v string, expires_at timestamp_ntz")
    negative = spark.createDataFrame([
        ("a", 6, T0 + DAY),     # live negative: not loaded even though the source has it
        ("a", 7, T0 - DAY),     # expired negative: loaded again
    ], "namespace string, key bigint, expires_at timestamp_ntz")
    source = spark.createDataFrame([
        ("a", 2, "src2"), ("a", 5, "src5"), ("a", 6, "src6"), ("a", 7, "src7"), ("b", 1, "src-b1"),
    ], "namespace string, key bigint, v string")
    requests = spark.createDataFrame(
        [("a", k) for k in (1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 8)] + [("b", 1), ("b", 9)],
        "namespace string, key bigint")
    return lookup, negative, source, requests


def _pairs(df, *cols):
    return sorted(tuple(getattr(r, c) for c in cols) for r in df.collect())


def test_present_skips_expired_and_absent(tables):
    lookup, _, _, requests = tables
    assert _pairs(L.present(requests, lookup, AS_OF), "namespace", "key", "v") == [
        ("a", 1, "live"), ("a", 4, "forever"), ("b", 1, "other-ns")]


def test_read_through_with_negatives(tables):
    lookup, negative, source, requests = tables
    r = L.read_through(requests, lookup, source, AS_OF, negative=negative, ttl_seconds=3600,
                       missing_ttl_seconds=7200)
    assert _pairs(r.found, "namespace", "key", "v", "origin") == [
        ("a", 1, "live", "cache"), ("a", 2, "src2", "source"), ("a", 4, "forever", "cache"),
        ("a", 5, "src5", "source"), ("a", 7, "src7", "source"), ("b", 1, "other-ns", "cache")]
    assert _pairs(r.stored, "key", "expires_at")[0] == (2, T0 + dt.timedelta(hours=1))
    assert _pairs(r.not_found, "namespace", "key", "expires_at") == [
        ("a", 3, T0 + dt.timedelta(hours=2)), ("a", 8, T0 + dt.timedelta(hours=2)),
        ("b", 9, T0 + dt.timedelta(hours=2))]


def test_read_through_without_negatives_loads_everything(tables):
    lookup, _, source, requests = tables
    r = L.read_through(requests, lookup, source, AS_OF)
    assert ("a", 6) in _pairs(r.found, "namespace", "key")
    assert r.not_found.count() == 0


def test_upsert_last_wins_and_ttl(spark, tables):
    lookup = tables[0]
    updates = spark.createDataFrame([("a", 1, "first", 1), ("a", 1, "second", 2), ("a", 9, "new", 1)],
                                    "namespace string, key bigint, v string, seq int")
    out = L.upsert(lookup, updates, AS_OF, 0, order_by="seq")
    assert _pairs(out, "namespace", "key", "v", "expires_at") == [
        ("a", 1, "second", None), ("a", 4, "forever", None), ("a", 9, "new", None), ("b", 1, "other-ns", T0 + DAY)]


def test_invalidate_and_refresh(spark, tables):
    lookup, _, source, _ = tables
    keys = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("b", 1)], "namespace string, key bigint")
    assert _pairs(L.invalidate(lookup, keys), "namespace", "key") == [("a", 2), ("a", 3)]
    refreshed = L.refresh(lookup, keys, source, AS_OF, 60)
    assert _pairs(refreshed, "namespace", "key", "v") == [("a", 1, "live"), ("a", 4, "forever"), ("b", 1, "src-b1")]


def test_stats_count_every_request(tables):
    lookup, _, _, requests = tables
    assert _pairs(L.stats(requests, lookup, AS_OF), "namespace", "hits", "misses") == [("a", 4, 7), ("b", 1, 1)]


def test_read_through_cycle_stores_what_it_loads(tables):
    """A second read over the stored state answers the loaded keys from the cache."""
    from relayout.sources.staging import materialize

    lookup, negative, source, requests = tables
    first = L.read_through(requests, lookup, source, AS_OF, negative=negative, ttl_seconds=3600)
    state = materialize(L.upsert(lookup, first.stored.drop("expires_at"), AS_OF, 3600), "lookup_state")
    second = L.read_through(requests, state, source, AS_OF, negative=negative, ttl_seconds=3600)
    assert _pairs(second.found, "key", "origin") == _pairs(first.found.selectExpr("key", "'cache' AS origin"),
                                                          "key", "origin")


def test_read_through_joins_each_input_once(tables):
    from relayout.plans.explain import plan_text

    lookup, negative, source, requests = tables
    r = L.read_through(requests, lookup, source, AS_OF, negative=negative)
    for df in (r.found, r.resolved):
        plan = plan_text(df, "simple")
        assert plan.count("Join") == 3 and "Union" not in plan


def test_requests_are_pre_aggregated_before_their_shuffle(spark, tables):
    """A key holding a third of all requests becomes one row per task before any shuffle: every
    hash exchange of the plan sits on an aggregation."""
    import re

    from relayout.plans.explain import plan_text

    lookup, _, _, _ = tables
    hot = spark.range(30000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS namespace",
                                        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS key")
    for df in (L.present(hot, lookup, AS_OF), L.stats(hot, lookup, AS_OF)):
        plan = plan_text(df, "simple")
        children = re.findall(r"Exchange hashpartitioning\([^\n]*\n\s*\+- (\w+)", plan)
        assert children and set(children) == {"HashAggregate"}, plan


def test_upsert_ties_are_deterministic(spark, tables):
    lookup = tables[0]
    updates = spark.createDataFrame([("a", 5, "x", 1), ("a", 5, "z", 1), ("a", 5, "y", 1)],
                                    "namespace string, key bigint, v string, seq int")
    for _ in range(3):
        got = L.upsert(lookup, updates.repartition(3), AS_OF, 0, order_by="seq").where("key = 5").first()
        assert got.v == "z"
