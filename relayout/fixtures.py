"""Inputs shared by the registered queries, derived from the driver's tables.

Every fixture is a lazy DataFrame over the given parquet tables, so its size grows with them. The
SQL twins in :mod:`relayout.oracle` derive the same rows in DuckDB.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the lookup fixture (also spelled out in the SQL twins).
AS_OF = "2024-01-15 00:00:00"
TTL_DAYS = 7
MISSING_TTL_DAYS = 30
NEGATIVE_TTL_DAYS = 8
MORNING = "2024-01-15 06:00:00"
BUCKETS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_with_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` plus the columns its source layout is partitioned on: the event date as
    ``yyyy-MM-dd`` text and the event hour."""
    return (table(spark, sf_dir, "events")
            .withColumn("event_date", F.date_format("ts", "yyyy-MM-dd"))
            .withColumn("event_hour", F.hour("ts")))


# ---------------------------------------------------------------------------------------------
# Schema containment: one pair per customer. The source inventory holds a column per
# (order priority, order status) of the customer's orders; the target inventory a column per
# (order priority, line status) of the lines of those orders. Comments are unset on both sides.
# ---------------------------------------------------------------------------------------------


def containment_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    no_comment = F.lit(None).cast("string").alias("comment")
    source = orders.select(F.col("o_custkey").alias("pair_id"), F.col("o_orderpriority").alias("name"),
                           F.col("o_orderstatus").alias("type"), no_comment)
    target = (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
              .select(F.col("o_custkey").alias("pair_id"), F.col("o_orderpriority").alias("name"),
                      F.col("l_linestatus").alias("type"), no_comment))
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pair_id"))
    return source, target, pairs


# ---------------------------------------------------------------------------------------------
# Table descriptors: one JSON document per lineitem row, built row by row (no grouping).
# A line with number n describes a table of n columns c1..cn; even positions are partition
# columns; odd ones carry is_partition '2' or '0' (both data). Parameters k0..k2 repeat, so later
# values must win; serde entries: two for flag 'R', one for 'A', none for 'N'; type entries: two
# for status 'F', the key absent for 'O'. Lines without discount get a non-integer flag, lines
# without tax have no "columns" key, and lines of quantity 1 are cut short (malformed JSON). Quantities 2
# to 8: no parameters, no serde list, a null parameter entry, an empty type list, a key that is no list, an
# object as a column type, and a flag with a line end. Quantities 9 and 10 repeat keys (the last value counts): that of
# a column's type, and "columns" itself; 11 has a text that looks like an object.
# ---------------------------------------------------------------------------------------------

# Fixed values of the descriptor fixture (also spelled out in the SQL twin).
COLUMN_TYPES = ["bigint", "string", "double", "date", "timestamp", "int", "boolean"]


def _described_name():
    return F.concat_ws("_", F.lit("t"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def _evenly_read(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` as it is read, if its scan's tasks have about as many rows each and keep all cores at work; else (a file that cannot be
    split) its rows are dealt by ``keys``. Counts come from the files' own figures; the driver gets two numbers."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows, largest = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    return df.repartition(cores, *keys) if 4 * cores * (largest or 0) > 5 * (rows or 0) else df


def descriptor_documents(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``spread``: for documents that are stored to be read by all cores. Lines are dealt, if need be, never their documents."""
    li = table(spark, sf_dir, "lineitem")
    if spread:
        li = _evenly_read(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    quantity = F.col("l_quantity")
    n = F.col("l_linenumber")
    types = F.array(*[F.lit(t) for t in COLUMN_TYPES])

    def column(i):
        flag = (F.when(i % 2 == 0, F.lit("1"))
                .when((i == 1) & (F.col("l_discount") == 0), F.lit("x"))
                .when((i == 1) & (quantity == 8), F.lit("1\n"))
                .when(F.col("l_tax") >= 0.05, F.lit("2"))
                .otherwise(F.lit("0")))
        return F.struct(
            F.concat(F.lit("c"), i.cast("string")).alias("name"),
            F.element_at(types, i).alias("type"),
            F.when(i % 2 == 1, F.col("l_returnflag")).otherwise(F.lit("")).alias("comment"),
            flag.alias("is_partition"),
        )

    def param(j):
        return F.struct(F.concat(F.lit("k"), (j % 3).cast("string")).alias("param_key"),
                        F.concat_ws(":", F.col("l_orderkey").cast("string"), j.cast("string")).alias("param_value"))

    def serde(suffix):
        return F.struct(F.concat(F.lit("in."), suffix).alias("serde_input"),
                        F.concat(F.lit("out."), suffix).alias("serde_output"))

    serde_list = (F.when(F.col("l_returnflag") == "R", F.array(serde(F.lit("Text")), serde(F.col("l_linestatus"))))
                  .when(F.col("l_returnflag") == "A", F.array(serde(F.lit("Text"))))
                  .otherwise(F.array().cast("array<struct<serde_input:string,serde_output:string>>")))
    type_list = F.when(F.col("l_linestatus") == "F", F.array(
        F.struct(F.lit("MANAGED_TABLE").alias("table_type"), F.lit("").alias("view_expanded_text")),
        F.struct(F.lit("VIRTUAL_VIEW").alias("table_type"), F.lit("select 1").alias("view_expanded_text")),
    ))
    some_type = F.struct(F.lit("").alias("table_type"), F.lit("").alias("view_expanded_text"))
    params = F.transform(F.sequence(F.lit(1), n + 1), param)
    doc = F.struct(
        F.when(F.col("l_tax") > 0, F.transform(F.sequence(F.lit(1), n), column)).alias("columns"),
        F.when(quantity == 4, F.array_append(params, F.lit(None).cast("struct<param_key:string,param_value:string>")))
        .when(quantity != 2, params).alias("table_params"),
        F.when(quantity != 3, serde_list).alias("serde_info"),
        F.when(quantity == 5, F.slice(F.array(some_type), 1, 0)).otherwise(type_list).alias("type_info"),
    )
    # A null list is left out of the document (or written as null: parsed the same either way).
    # A column of its own: it is made once, however often the texts below name it.
    li = li.withColumn("text", F.to_json(doc, {"ignoreNullFields": "true"}))
    text = F.col("text")
    text = (F.when(quantity == 6, F.concat(F.lit('{"other":1,'), text.substr(F.lit(2), F.length(text))))
            .when(quantity == 7, F.replace(text, F.lit('"type":"bigint"'), F.lit('"type":{"of":"bigint"}')))
            .when(quantity == 9, F.replace(text, F.lit('"type":"bigint"'), F.lit('"type":"text","type":"bigint"')))
            .when((quantity == 10) & (F.col("l_tax") > 0), F.concat(F.lit('{"columns":[{"name":"old"}],'), text.substr(F.lit(2), F.length(text))))
            .when(quantity == 11, F.replace(text, F.lit('"type":"bigint"'), F.lit('"note":"{\\"of\\":1}","type":"bigint"')))
            .otherwise(text))
    text = F.when(quantity == 1, text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    return li.select(
        F.concat(F.lit("db_"), F.lower(F.col("l_returnflag"))).alias("db"),
        _described_name().alias("table"),
        text.alias("json"),
    )


def described_events(spark: SparkSession, sf_dir: str, source: str, target: str) -> DataFrame:
    """The documents above and, among them, those of two tables of events: by date, and by hour and type (some columns less,
    listed in another order). Comments are the same in both."""
    comments = {"event_id": "one per event", "event_date": "", "value": None}
    kinds = dict(events_with_layout(spark, sf_dir).dtypes)

    def document(names: list[str], partitions: list[str]) -> str:
        columns = [{"name": n, "type": kinds[n], "is_partition": str(int(n in partitions)),
                    **({"comment": comments.get(n, "of events")} if comments.get(n, "") is not None else {})} for n in names]
        return json.dumps({"columns": columns, "table_params": [], "serde_info": []})

    two = spark.createDataFrame([
        ("Events", source, document([*kinds], ["event_date"])),
        ("Events", target, document(["event_type", "value", "event_hour", "user_id", "event_id"], ["event_hour", "event_type"])),
    ], "db string, table string, json string")
    return descriptor_documents(spark, sf_dir).unionByName(two)


def descriptor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_id`` (a described table's name) and ``source``, the table of the last line of the same order: its columns hold
    the others' by name and type, so it is up to the comments (the return flags) whether it contains them."""
    # Lines are dealt by order once: the last line is found, and lines that come twice are dropped, where they lie (a name
    # starts with its order's key). Names are made after that.
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = lines.repartition("l_orderkey").withColumn("pair_id", _described_name())
    last = F.max(F.struct("l_linenumber", "pair_id")).over(Window.partitionBy("l_orderkey"))["pair_id"]
    return (named.withColumn("source", last).groupBy("l_orderkey", "pair_id", "source").agg(F.lit(1))
            .select("pair_id", "source"))


# ---------------------------------------------------------------------------------------------
# Name inventory: every part is a table named by its part name, in a database named by its type.
# ---------------------------------------------------------------------------------------------


def name_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.col("p_type").alias("db"), F.col("p_name").alias("table"))


def brand_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database for every part type, with a table for every brand of it and one for every container-like second word."""
    part = table(spark, sf_dir, "part")
    named = lambda prefix, c: F.concat(F.lit(prefix), F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"))
    return (part.select(F.lower("p_type").alias("db"), F.explode(F.array(named("Brand_", F.col("p_brand")), named("name_", F.col("p_name")))).alias("table"))
            .distinct())


# ---------------------------------------------------------------------------------------------
# Keyed lookup: suppliers and customers are the source, in two namespaces; events are the
# requests (views and clicks ask for customers, other events for suppliers; the user id is the
# key). The lookup caches the source rows of nations 0..19 (name lower-cased), expiring by nation
# band: 0..4 a day before AS_OF, 5..7 exactly at AS_OF, 8..11 never, 12..19 a week after.
# Negatives: keys asked for before 2024-01-08 that the source lacks, expiring 8 days after the
# last such request, plus customers of nations 20..24 with a negative balance, live for a day.
# ---------------------------------------------------------------------------------------------


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _days(n: int):
    return F.make_dt_interval(days=F.lit(n))


def lookup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("namespace"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    cus = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("namespace"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))
    return sup.unionByName(cus)


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ns = F.when(F.col("event_type").isin("view", "click"), F.lit("customer")).otherwise(F.lit("supplier"))
    return ev.select(ns.alias("namespace"), F.col("user_id").alias("key"), "event_id", "ts", "event_type", "value")


def lookup_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = lookup_source(spark, sf_dir)
    nation = F.col("nation")
    expires = (F.when(nation < 5, _as_of() - _days(1))
               .when(nation < 8, _as_of())
               .when(nation < 12, F.lit(None).cast("timestamp_ntz"))
               .otherwise(_as_of() + _days(TTL_DAYS)))
    return src.where(nation < 20).select("namespace", "key", F.lower("name").alias("name"), "balance", "nation",
                                         expires.alias("expires_at"))


def lookup_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = lookup_source(spark, sf_dir)
    early = lookup_requests(spark, sf_dir).where(F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    recorded = (early.join(src.select("namespace", "key"), ["namespace", "key"], "left_anti")
                .groupBy("namespace", "key").agg((F.max("ts") + _days(NEGATIVE_TTL_DAYS)).alias("expires_at")))
    cus = table(spark, sf_dir, "customer")
    stale = cus.where((F.col("c_acctbal") < 0) & (F.col("c_nationkey") >= 20)).select(
        F.lit("customer").alias("namespace"), F.col("c_custkey").alias("key"), (_as_of() + _days(1)).alias("expires_at"))
    return recorded.unionByName(stale)


def lookup_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache with entries that expire at several hours of a day: that of the nation's number."""
    hours = F.make_dt_interval(hours=F.col("nation").cast("int"))
    return lookup_cache(spark, sf_dir).withColumn("expires_at", F.col("expires_at") + hours)


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a careless feed gives them: prices as text, with a mark before those of pending ones."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("~"), price)).otherwise(price).alias("o_totalprice"))
