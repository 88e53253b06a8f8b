"""The registered queries: one per operator family, each over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame. The relayout queries stage a
partitioned source below the session's scratch folder, run the job into a fresh target folder and
return the target as re-read from storage; so the returned rows are what the job wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from .fixtures import AS_OF, BUCKETS, MISSING_TTL_DAYS, MORNING, TTL_DAYS, events_with_layout, table
from .functions.predicates import Expr
from .operators.containment import schema_containment as contain
from .operators.descriptors import parse_descriptors
from .operators.job import relayout
from .operators.lookup import invalidate, present, read_through, read_through_batch, record_negative, refresh, stats, upsert
from .operators.names import all_tables, catalog_names, names_like, tables_matching
from .session import scratch_path
from .sources.staging import path_table_for, written_once
from .sources.store import compact, entries, write_bucketed, write_by_expiry
from .sources.tables import path_table, read_table

# ---------------------------------------------------------------------------------------------
# Relayout job
# ---------------------------------------------------------------------------------------------


def _stage(spark: SparkSession, sf_dir: str, which: str, partition_by: list[str]):
    """The source table: a driver table (``events`` with its date and hour columns) written once per
    application in the given layout."""
    build = (lambda: events_with_layout(spark, sf_dir)) if which == "events" else (lambda: table(spark, sf_dir, which))
    return written_once(spark, ("source", sf_dir, which, tuple(partition_by)), build,
                        f"{which}_by_{'_'.join(partition_by)}", partition_by)


def _target(spark: SparkSession, like, name: str, partition_by: list[str], columns: list[str],
            types: dict[str, T.DataType] | None = None):
    schema = like.schema
    if types:
        schema = T.StructType([
            T.StructField(f.name, types.get(f.name, f.dataType), f.nullable, f.metadata) for f in schema.fields
        ])
    return path_table_for(schema, scratch_path(spark, name), partition_by, columns=columns)


EVENT_TARGET_COLUMNS = ["event_id", "ts", "user_id", "value", "event_date", "event_hour", "event_type"]


def relayout_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: events by day -> one day's rows into a table partitioned by event type, props dropped."""
    src = _stage(spark, sf_dir, "events", ["event_date"])
    tgt = _target(spark, src, "events_by_type", ["event_type"], EVENT_TARGET_COLUMNS)
    return relayout(spark, src, tgt, {"event_date": "2024-01-02"})


def relayout_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: as Q1 with an empty predicate set: every row moves."""
    src = _stage(spark, sf_dir, "events", ["event_date"])
    tgt = _target(spark, src, "events_by_type", ["event_type"], EVENT_TARGET_COLUMNS)
    return relayout(spark, src, tgt, {})


def relayout_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: events by type -> the 'view' rows into a table partitioned by date, then hour."""
    src = _stage(spark, sf_dir, "events", ["event_type"])
    tgt = _target(spark, src, "events_by_date_hour", ["event_date", "event_hour"],
                  ["event_id", "ts", "user_id", "value", "props", "event_type", "event_date", "event_hour"])
    return relayout(spark, src, tgt, {"event_type": "view"})


def relayout_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: full load by type, then a reload of one day's 'view' rows. Only the 'view' target
    partition is replaced, and it is replaced whole: other days' 'view' rows are gone, every other
    type is untouched."""
    src = _stage(spark, sf_dir, "events", ["event_date"])
    tgt = _target(spark, src, "events_by_type", ["event_type"], EVENT_TARGET_COLUMNS)
    relayout(spark, src, tgt, {})
    return relayout(spark, src, tgt, {"event_date": "2024-01-02", "event_type": "view"})


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]


def relayout_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: lineitem by line number -> every row into a table partitioned by return flag, then line
    status."""
    src = _stage(spark, sf_dir, "lineitem", ["l_linenumber"])
    tgt = _target(spark, src, "lineitem_by_flag_status", ["l_returnflag", "l_linestatus"], LINEITEM_COLUMNS)
    return relayout(spark, src, tgt, {})


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def relayout_multi_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: orders by status -> finished urgent orders into a table partitioned by priority; one term
    prunes folders, the other is pushed into the scan."""
    src = _stage(spark, sf_dir, "orders", ["o_orderstatus"])
    tgt = _target(spark, src, "orders_by_priority", ["o_orderpriority"], ORDER_COLUMNS)
    return relayout(spark, src, tgt, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


def relayout_expr_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: the day is given as a SQL expression; it folds to a constant and still prunes folders."""
    src = _stage(spark, sf_dir, "events", ["event_date"])
    tgt = _target(spark, src, "events_by_hour", ["event_hour"],
                  ["event_id", "user_id", "event_type", "value", "event_date", "event_hour"])
    return relayout(spark, src, tgt,
                    {"event_date": Expr("date_format(date'2024-01-01' + 1, 'yyyy-MM-dd')")})


def relayout_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: the target declares other types (key as text, price as a whole number); values are cast
    on the way in."""
    src = _stage(spark, sf_dir, "orders", ["o_orderpriority"])
    tgt = _target(spark, src, "orders_typed", ["o_orderstatus"], ORDER_COLUMNS,
                  types={"o_orderkey": T.StringType(), "o_totalprice": T.LongType()})
    return relayout(spark, src, tgt, {})


def relayout_text_on_int_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is partitioned by a whole number, the predicate gives it as the text '03'."""
    src = _stage(spark, sf_dir, "events", ["event_hour"])
    tgt = _target(spark, src, "events_of_hour", ["event_type"], EVENT_TARGET_COLUMNS)
    return relayout(spark, src, tgt, {"event_hour": "03"})


def relayout_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is partitioned by a date, the predicate spells it '2024-1-2'."""
    build = lambda: table(spark, sf_dir, "events").withColumn("event_day", F.to_date("ts"))
    src = written_once(spark, ("source", sf_dir, "events_dated"), build, "events_dated", ["event_day"])
    tgt = _target(spark, src, "events_of_day", ["event_type"], ["event_id", "user_id", "value", "event_day", "event_type"])
    return relayout(spark, src, tgt, {"event_day": "2024-1-2"})


def relayout_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8d: the target declares the fields of a struct, and of structs in an array, in another order and with
    other types; they are matched by name."""
    def build():
        return table(spark, sf_dir, "events").select(
            "event_id", "event_type", F.hour("ts").alias("event_hour"), F.struct("user_id", "value").alias("who"),
            F.array(F.struct("user_id", "value")).alias("seen"))

    src = written_once(spark, ("source", sf_dir, "events_nested"), build, "events_nested", ["event_hour"])
    swapped = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("user_id", T.StringType())])
    tgt = _target(spark, src, "events_swapped", ["event_type"], ["event_id", "who", "seen", "event_type"],
                  types={"who": swapped, "seen": T.ArrayType(swapped)})
    out = relayout(spark, src, tgt, {})
    return out.select("event_id", F.col("who.user_id").cast("long").alias("who_user"), F.col("who.value").alias("who_value"),
                      F.col("seen")[0]["value"].alias("seen_value"), F.col("seen")[0]["user_id"].cast("long").alias("seen_user"),
                      "event_type")


def relayout_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8e: one day's events between catalog tables. The target's physical column order is not alphabetical and
    it holds a partition ('kept') that must survive; the extract is also read through its view."""
    tag = uuid.uuid4().hex[:8]
    source, target, view = f"relayout_src_{tag}", f"relayout_tgt_{tag}", f"relayout_day_{tag}"
    events = events_with_layout(spark, sf_dir)
    (events.hint("rebalance", "event_date").write.partitionBy("event_date")
     .option("path", scratch_path(spark, source)).saveAsTable(source))
    spark.sql(f"CREATE TABLE {target} (value DOUBLE, event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING) "
              f"USING parquet PARTITIONED BY (event_type) LOCATION '{scratch_path(spark, target)}'")
    (events.where("event_hour = 0").select("value", "event_id", "user_id", "ts", F.lit("kept").alias("event_type"))
     .write.insertInto(target))
    out = relayout(spark, source, target, {"event_date": "2024-01-02"}, view=view)
    columns = ["event_id", "user_id", "value", "ts", "event_type"]
    return (out.select(F.lit("target").alias("origin"), *columns)
            .unionByName(spark.table(view).select(F.lit("view").alias("origin"), *columns)))


def relayout_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8f: the source is a view of the session, the target a catalog table (loaded in a session of its own)."""
    tag = uuid.uuid4().hex[:8]
    view, target = f"relayout_of_{tag}", f"relayout_from_view_{tag}"
    events_with_layout(spark, sf_dir).where("event_hour < 12").createOrReplaceTempView(view)
    spark.sql(f"CREATE TABLE {target} (event_id BIGINT, value DOUBLE, event_date STRING, event_type STRING) "
              f"USING parquet PARTITIONED BY (event_type) LOCATION '{scratch_path(spark, target)}'")
    return relayout(spark, view, target, {"event_date": "2024-01-02"})


def relayout_from_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8g: both layouts come from documents, found among those of all tables; whole fields are compared (strict)."""
    source, target = "events_by_date", "events_by_hour_and_type"
    stored = _stage(spark, sf_dir, "events", ["event_date"])
    docs = written_once(spark, ("described", sf_dir), lambda: fx.described_events(spark, sf_dir, source, target), "described")
    described = parse_descriptors(read_table(spark, docs))
    return relayout(spark, path_table(described.layout("events", source), stored.path),
                    path_table(described.layout("EVENTS", target), scratch_path(spark, target)), {"event_date": "2024-01-03"}, strict=True)


def relayout_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8h: prices come as text, and some are none: those rows go to a folder of their own, the others are loaded."""
    src = written_once(spark, ("source", sf_dir, "priced"), lambda: fx.priced_orders(spark, sf_dir), "orders_priced", ["o_orderpriority"])
    tgt = _target(spark, src, "orders_checked", ["o_orderstatus"], ["o_orderkey", "o_totalprice", "o_orderstatus"],
                  types={"o_totalprice": T.DecimalType(18, 2)})
    refused = scratch_path(spark, "orders_refused")
    out = relayout(spark, src, tgt, {}, rejects=refused)
    columns = ["o_orderkey", F.col("o_totalprice").cast("string").alias("price"), "o_orderstatus"]
    return (out.select(F.lit("target").alias("origin"), *columns, F.lit("").alias("at_fault"))
            .unionByName(spark.read.parquet(refused).select(
                F.lit("rejected").alias("origin"), *columns, F.array_join("rejected_columns", ",").alias("at_fault"))))


# ---------------------------------------------------------------------------------------------
# Schema containment (V2, V3)
# ---------------------------------------------------------------------------------------------


def schema_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: per customer, is the (priority, line status) inventory contained in the (priority,
    order status) inventory; customers without orders or lines are invalid."""
    source, target, pairs = fx.containment_inputs(spark, sf_dir)
    return contain(source, target, pairs)


def containment_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per described table, is it contained in the widest described table of the same order; columns are equal in
    name and type, so comments decide. Tables whose document is rejected are invalid."""
    lists = _descriptors(spark, sf_dir).lists.where(F.col("table").isNotNull())
    # one parse and one shuffle for both sides: each list moves whole, and becomes a row per column where its pair is compared
    lists = lists.select("table", F.transform("columns", lambda c: F.struct(c["name"], c["type"], c["comment"])).alias("columns")).repartition("table")
    pairs = fx.descriptor_pairs(spark, sf_dir)
    target = lists.withColumnRenamed("table", "pair_id")
    source = lists.join(pairs.withColumnRenamed("source", "table"), "table").select("pair_id", "columns").repartition("pair_id")
    inventory = lambda df: df.select("pair_id", F.inline("columns"))
    return contain(inventory(source), inventory(target), pairs)


# ---------------------------------------------------------------------------------------------
# Table descriptors (D1-D7) and names
# ---------------------------------------------------------------------------------------------


def _descriptors(spark: SparkSession, sf_dir: str):

    # documents are stored where they are made, without a shuffle; they are much alike
    docs = written_once(spark, ("descriptors", sf_dir), lambda: fx.descriptor_documents(spark, sf_dir, spread=True), "descriptors",
                        options={"compression": "zstd"})
    return parse_descriptors(read_table(spark, docs))


def descriptor_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain field listing: every parseable column list, whatever else the document holds."""
    return _descriptors(spark, sf_dir).fields


def descriptor_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: the column inventory of every well-formed descriptor, in document and layout order."""
    return _descriptors(spark, sf_dir).columns


def descriptor_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: table parameters, the last value of each duplicate key."""
    return _descriptors(spark, sf_dir).params


def descriptor_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage format (last serde entry) and table type (first type entry)."""
    return _descriptors(spark, sf_dir).storage


def descriptor_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cannot describe a table, with the reason."""
    return _descriptors(spark, sf_dir).rejected.drop("json")


def names_fullmatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: tables of database 'Economy' (any case) whose whole name is a red or blue rod or ring."""
    return tables_matching(fx.name_inventory(spark, sf_dir), "Economy", "(red|blue) (rod|ring)")


def names_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of database 'small' (matched case-insensitively)."""
    return all_tables(fx.name_inventory(spark, sf_dir), "small")


def names_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's own listing, by pattern, of a database with a table for every brand of the first
    part type (and others beside them). Only the distinct brands and types, as table names, are collected."""
    part = table(spark, sf_dir, "part")
    db = f"parts_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    brand = F.regexp_replace(F.lower("p_brand"), "[^a-z0-9]+", "_")
    first = part.agg(F.min("p_type")).first()[0]
    names = [f"brand_{r[0]}" for r in part.where(F.col("p_type") == first).select(brand).distinct().collect()]
    for name in [*names, "sizes", "types"]:
        spark.sql(f"CREATE TABLE {db}.{name} (p_partkey BIGINT) USING parquet")
    return catalog_names(spark, db, "BRAND_*").select("table")


def names_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12d: the tables of all databases (one for every part type) that the catalog's pattern lists."""
    return names_like(fx.brand_inventory(spark, sf_dir), "BRAND_*|name_red*rod")


# ---------------------------------------------------------------------------------------------
# Keyed lookup
# ---------------------------------------------------------------------------------------------


def _lookup_inputs(spark: SparkSession, sf_dir: str):
    """Requests (a projection of ``events``), and the cache, negative and source tables, which are
    stored tables in real use: derived from the driver tables and written once per application."""

    def stored(name, build):
        return read_table(spark, written_once(spark, ("lookup", sf_dir, name), build, f"lookup_{name}"))

    return (fx.lookup_requests(spark, sf_dir),
            stored("cache", lambda: fx.lookup_cache(spark, sf_dir)),
            stored("source", lambda: fx.lookup_source(spark, sf_dir)),
            stored("negative", lambda: fx.lookup_negative(spark, sf_dir)))


def lookup_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: live cached entries of the requested keys."""
    requests, cache, _, _ = _lookup_inputs(spark, sf_dir)
    return present(requests, cache, AS_OF)


def _resolution(spark: SparkSession, sf_dir: str):

    requests, cache, source, negative = _lookup_inputs(spark, sf_dir)
    return read_through(requests, cache, source, AS_OF, negative=negative,
                        ttl_seconds=TTL_DAYS * 86400, missing_ttl_seconds=MISSING_TTL_DAYS * 86400)


def lookup_read_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: every requested key answered from the cache or loaded from the source; live negatives
    are not loaded."""
    return _resolution(spark, sf_dir).found


def lookup_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15: new negatives: requested keys neither cached, nor negative, nor in the source."""
    return _resolution(spark, sf_dir).not_found


def lookup_record_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negatives after recording the keys that were not found; expired ones are gone."""
    _, _, _, negative = _lookup_inputs(spark, sf_dir)
    return record_negative(negative, _resolution(spark, sf_dir).not_found, AS_OF)


def lookup_store_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache after storing what the read-through loaded (L2's store step, via L5)."""
    _, cache, _, _ = _lookup_inputs(spark, sf_dir)
    stored = _resolution(spark, sf_dir).stored.drop("expires_at")
    return upsert(cache, stored, AS_OF, TTL_DAYS * 86400)


def lookup_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16: the cache after storing one update per purchase event (the latest event per key wins)."""
    requests, cache, _, _ = _lookup_inputs(spark, sf_dir)
    updates = requests.where(F.col("event_type") == "purchase").select(
        "namespace", "key", F.concat(F.lit("user-"), F.col("key").cast("string")).alias("name"),
        F.col("value").alias("balance"), F.hour("ts").alias("nation"), "event_id")
    return upsert(cache, updates, AS_OF, TTL_DAYS * 86400, order_by="event_id")


def lookup_invalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17: the cache without the keys of error events."""
    requests, cache, _, _ = _lookup_inputs(spark, sf_dir)
    return invalidate(cache, requests.where(F.col("event_type") == "error"))


def lookup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: the cache after reloading the keys requested on the last day from the source."""
    requests, cache, source, _ = _lookup_inputs(spark, sf_dir)
    last_day = requests.where(F.to_date("ts") == F.lit("2024-01-30").cast("date"))
    return refresh(cache, last_day, source, AS_OF, TTL_DAYS * 86400)


def lookup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19: per namespace, requests answered by a live cache entry and the others."""
    requests, cache, _, _ = _lookup_inputs(spark, sf_dir)
    return stats(requests, cache, AS_OF)


def lookup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20: the keys requested on the last day, as a batch: sent to the scans of the cache and of the source, which are not
    shuffled."""
    requests, cache, source, negative = _lookup_inputs(spark, sf_dir)
    last_day = requests.where(F.to_date("ts") == F.lit("2024-01-30").cast("date"))
    return read_through_batch(last_day, cache, source, AS_OF, negative=negative,
                              ttl_seconds=TTL_DAYS * 86400, missing_ttl_seconds=MISSING_TTL_DAYS * 86400).found


_BUCKETED: dict = {}


def bucketed_stores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cache, negatives and source as bucketed catalog tables, written once per application."""
    build = {"cache": fx.lookup_cache, "source": fx.lookup_source, "negative": fx.lookup_negative}
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUCKETED or not all(spark.catalog.tableExists(t) for t in _BUCKETED[key].values()):
        tag = uuid.uuid4().hex[:8]
        _BUCKETED[key] = {name: f"lookup_{name}_{tag}" for name in build}
        for name, make in build.items():
            write_bucketed(make(spark, sf_dir), _BUCKETED[key][name], BUCKETS)
    return {name: spark.table(t) for name, t in _BUCKETED[key].items()}


def lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q21: every requested key answered, from stores bucketed by key, which stay where they are."""
    stores = bucketed_stores(spark, sf_dir)
    return read_through(fx.lookup_requests(spark, sf_dir), stores["cache"], stores["source"], AS_OF, negative=stores["negative"]).found


def lookup_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q22: a cache partitioned by expiry day after removing what is dead in the morning of a day."""
    store = write_by_expiry(fx.lookup_hours(spark, sf_dir), scratch_path(spark, "cache_by_expiry"))
    compact(spark, store, MORNING)
    return entries(spark, store)
