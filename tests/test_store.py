"""Keyed stores: bucketed tables that stay where they are, batches sent to the scans, compaction by partition."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from relayout import fixtures as fx
from relayout.functions.expiry import live
from relayout.operators import lookup as L
from relayout.plans.explain import exchanges, plan_text
from relayout.sources.store import compact, entries, write_bucketed, write_by_expiry

SMOKE = "/root/testdata/sf0.001"
AS_OF = "2024-01-15 00:00:00"
KIND = "namespace string, key long, name string, expires_at timestamp_ntz"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def inputs(spark):
    return [f(spark, SMOKE) for f in (fx.lookup_requests, fx.lookup_cache, fx.lookup_source, fx.lookup_negative)]


@pytest.mark.parametrize("with_negative", [True, False])
def test_batch_gives_what_the_joins_give(spark, with_negative):
    requests, cache, source, negative = inputs(spark)
    how = {"negative": negative if with_negative else None, "ttl_seconds": 60, "missing_ttl_seconds": 3600}
    want = L.read_through(requests, cache, source, AS_OF, **how)
    for limit in (L.BATCH_BYTES, 0):  # both plans
        got = L.read_through_batch(requests, cache, source, AS_OF, batch_bytes=limit, **how)
        for part in ("found", "stored", "not_found"):
            assert same(getattr(got, part), getattr(want, part)), (limit, part)
        assert same(got.resolved.select("namespace", "key", "status"), want.resolved.select("namespace", "key", "status"))


def test_a_batch_moves_no_store(spark, scratch):
    """The scans of the lookup and of the source are filtered by the broadcast keys, without an exchange."""
    requests, cache, source, _ = inputs(spark)
    keys = requests.select("namespace", "key").distinct().limit(20)
    keys = spark.createDataFrame(keys.collect(), keys.schema)
    for table in (cache, source):
        stored = scratch("store")
        table.write.parquet(stored)
        narrowed = L.of_keys(spark.read.parquet(stored), keys, L.KEYS)
        plan = plan_text(narrowed, "simple")
        assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
        assert [e for e in exchanges(narrowed) if "hashpartitioning" in e] == []


def test_key_bytes(spark):
    rows = spark.createDataFrame([("ab", 1), ("", 2), ("é", 3)], "namespace string, key long")
    assert L.key_bytes(rows, L.KEYS) == (2 + 0 + 2) + 3 * 16 + 3 * 16
    assert L.key_bytes(rows.where("false"), L.KEYS) == 0


def test_null_and_empty_batches(spark):
    _, cache, source, negative = inputs(spark)
    nulls = spark.createDataFrame([(None, 1), ("customer", None)], "namespace string, key long")
    for requests in (nulls, nulls.where("false")):
        got = L.read_through_batch(requests, cache, source, AS_OF, negative=negative)
        assert got.found.isEmpty() and got.not_found.isEmpty()


def test_bucketed_stores_are_not_shuffled(spark):
    requests, cache, source, _ = inputs(spark)
    tag = uuid.uuid4().hex[:8]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large tables are not broadcast either
    try:
        stores = [write_bucketed(df, f"{name}_{tag}", 16) for name, df in (("cache", cache), ("source", source))]
        plain = L.read_through(requests, cache, source, AS_OF)
        found = L.read_through(requests, *stores, AS_OF).found
        assert same(found, plain.found)
        # the requests are reduced and moved to the buckets; the stores are not moved
        assert len(exchanges(found)) <= 2 and len(exchanges(plain.found)) > len(exchanges(found))
        assert all("16" in e or "REQUIREMENTS" in e for e in exchanges(found))
        for moved in (L.present(requests, stores[0], AS_OF), L.invalidate(stores[0], requests)):
            text = plan_text(moved, "simple")
            scan = next(i for i, line in enumerate(text.splitlines()) if f"cache_{tag}" in line)
            above = [line for line in text.splitlines()[:scan] if "Exchange" in line]
            assert above == [] and "Bucketed: true" in text
        assert len(stores[0].inputFiles()) <= 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def day(d, h=0):
    return dt.datetime(2024, 1, d, h)


def test_compaction_touches_dead_partitions_only(spark, scratch):
    rows = [("a", i, f"v{i}", e) for i, e in enumerate(
        [day(13), day(14, 23), day(15), day(15, 6), day(15, 7), day(16), day(20), None, None])]
    store = write_by_expiry(spark.createDataFrame(rows, KIND), scratch("by_expiry"))
    folder = store.path.removeprefix("file:")

    def state():
        return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns
                for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}

    before = state()
    compact(spark, store, "2024-01-15 06:00:00")
    after = state()
    left = {r.key for r in entries(spark, store).collect()}
    assert left == {4, 5, 6, 7, 8}
    assert not [f for f in after if "2024-01-13" in f or "2024-01-14" in f]
    untouched = {f: t for f, t in before.items() if "2024-01-16" in f or "2024-01-20" in f or "HIVE_DEFAULT" in f}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    compact(spark, store, "2024-01-15 06:00:00")  # nothing more to do
    assert same(entries(spark, store), spark.createDataFrame(rows, KIND).where(live(F.col("expires_at"), "2024-01-15 06:00:00")))
    compact(spark, store, "2024-01-15 23:00:00")  # the day's partition loses all
    assert {r.key for r in entries(spark, store).collect()} == {5, 6, 7, 8}


def test_compacting_an_empty_store(spark, scratch):
    store = write_by_expiry(spark.createDataFrame([], KIND), scratch("by_expiry"))
    compact(spark, store, AS_OF)
    assert entries(spark, store).isEmpty()
