"""Predicate spellings, nested types, catalog targets, distribution and session traps."""

import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayout import PathTable, extract, relayout, write_session
from relayout.operators.containment import schema_containment
from relayout.operators.descriptors import parse_descriptors
from relayout.operators.job import OVERWRITE_MODE, project_for_target
from relayout.operators.lookup import read_through, record_negative, refresh, upsert
from relayout.plans.distribution import distribute_for_write
from relayout.sources.staging import path_table_for, write_table
from relayout.sources.tables import Layout, read_table

AS_OF = "2024-01-15 00:00:00"
KINDS = {"i": T.IntegerType(), "d": T.DateType(), "s": T.StringType(), "b": T.BooleanType(), "f": T.DoubleType()}
VALUES = {"i": ["0", "1", "03", " 3", "10"], "d": ["2024-1-2", "2024-01-02", "2024-02-03"], "s": ["007", "7", "a/b", "TRUE"],
          "b": ["1", "TRUE", "false", "t"], "f": ["1", "1.0", "1e0", "2.50"]}


@pytest.fixture(scope="module")
def spelled(spark, tmp_path_factory):
    out = {}
    for k, kind in KINDS.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES[k])], "id long, v string")
        df = df.select("id", F.col("v").cast(kind).alias("p"))
        out[k] = (write_table(df, "file:" + str(tmp_path_factory.mktemp("spelled") / k), ["p"]), df)
    return out


@settings(deadline=None, max_examples=30, suppress_health_check=list(HealthCheck))
@given(k=st.sampled_from(sorted(KINDS)), pick=st.integers(0, 4), whole=st.booleans())
def test_any_spelling_finds_what_the_plain_filter_finds(spark, spelled, k, pick, whole):
    table, df = spelled[k]
    text = VALUES[k][pick % len(VALUES[k])]
    value = int(text) if whole and text.strip().isdigit() else text

    def ids(read):
        try:
            return sorted(r.id for r in read().collect())
        except Exception as e:  # a spelling that Spark cannot compare with the column
            return getattr(e, "getCondition", lambda: type(e).__name__)()

    want = ids(lambda: df.where(F.col("p") == F.lit(value)))
    assert ids(lambda: extract(spark, table, {"p": value})) == want


def test_folder_written_elsewhere_with_another_spelling(spark, scratch):
    path = scratch("elsewhere")
    spark.range(3).write.parquet(f"{path}/hour=01")
    table = PathTable(path, T.StructType([T.StructField("id", T.LongType()), T.StructField("hour", T.IntegerType())]), ("hour",))
    assert extract(spark, table, {"hour": 1}).count() == 3 and extract(spark, table, {"hour": "1"}).count() == 3


def test_missing_source_raises(spark, scratch):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("p", T.StringType())])
    gone, target = PathTable(scratch("gone"), schema, ("p",)), path_table_for(schema, scratch("t"), ["p"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        relayout(spark, gone, target, {})
    assert read_table(spark, target, must_exist=False).count() == 0


def test_nested_fields_go_by_name(spark):
    df = spark.sql("SELECT named_struct('a', 10, 'b', 20) s, map('k', named_struct('a', 1, 'b', 2)) m, "
                   "array(named_struct('a', 3, 'b', 4), NULL) l, CAST(NULL AS STRUCT<a: INT, b: INT>) n, 'x' p")
    ba = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    want = Layout(T.StructType([T.StructField("s", ba), T.StructField("m", T.MapType(T.StringType(), ba)),
                                T.StructField("l", T.ArrayType(ba)), T.StructField("n", ba)]), T.StructType([T.StructField("p", T.StringType())]))
    r = project_for_target(df, want).first()
    assert r.s.asDict() == {"b": 20, "a": "10"} and r.m["k"].asDict() == {"b": 2, "a": "1"}
    assert r.l[0].asDict() == {"b": 4, "a": "3"} and r.l[1] is None and r.n is None
    lacks = T.StructType([T.StructField("c", T.LongType())])
    with pytest.raises(ValueError, match="s.c"):
        project_for_target(df, Layout(T.StructType([T.StructField("s", lacks)]), T.StructType([])))


def test_static_overwrite_elsewhere_keeps_its_meaning(spark):
    for t in ("dyn_src", "dyn_tgt"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    spark.range(20).select("id", (F.col("id") % 2).alias("p"), (F.col("id") % 3).alias("q")).write.partitionBy("p").saveAsTable("dyn_src")
    spark.sql("CREATE TABLE dyn_tgt (id BIGINT, p BIGINT, q BIGINT) USING parquet PARTITIONED BY (q)")
    before, seen = spark.conf.get(OVERWRITE_MODE), set()
    stop = threading.Event()

    def watch():
        while not stop.is_set():
            seen.add(spark.conf.get(OVERWRITE_MODE))

    t = threading.Thread(target=watch)
    t.start()
    try:
        relayout(spark, "dyn_src", "dyn_tgt", {"p": 0})
        out = relayout(spark, "dyn_src", "default.dyn_tgt", {"p": 1})
    finally:
        stop.set()
        t.join()
    assert seen == {before} and out.count() == 10
    assert write_session(spark, "dyn_tgt").conf.get(OVERWRITE_MODE) == "dynamic"
    with pytest.raises(ValueError, match="same table"):
        relayout(spark, "dyn_src", "default.dyn_src", {})


@pytest.mark.parametrize("name", ["a:b", "a.b", "a b"])
def test_odd_partition_names_and_maps(spark, name):
    df = spark.sql(f"SELECT id, map('k', id) m, CAST(id % 2 AS STRING) `{name}` FROM range(100)")
    assert distribute_for_write(df, [name]).count() == 100
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert distribute_for_write(df, [name]).count() == 100
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_partition_spreads_over_all_tasks_without_aqe(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = distribute_for_write(spark.range(20_000).select("id", F.lit("hot").alias("p")), ["p"])
        assert out.select(F.spark_partition_id().alias("t")).distinct().count() > 16
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_containment_takes_unset_values_as_equal(spark):
    rows = [(1, None, "int", None), (1, "a", None, "x")]
    df = spark.createDataFrame(rows, "pair_id long, name string, type string, comment string")
    assert [(r.valid, r.missing_columns) for r in schema_containment(df, df).collect()] == [(True, 0)]


def test_registered_containment_plan(spark):
    from relayout.plans.explain import plan_text
    from relayout.queries import schema_containment as registered

    plan = plan_text(registered(spark, "/root/testdata/sf0.001")).split("Initial Plan")[0]
    assert "FullOuter" not in plan and plan.count("Union") >= 1


def _lookup(spark, rows):
    return spark.createDataFrame(rows, "namespace string, key long, v string, expires_at timestamp_ntz")


def test_upsert_stores_one_row_per_key(spark):
    old = _lookup(spark, [("n", 1, "old", None)])
    new = spark.createDataFrame([("n", 1, "a"), ("n", 1, "b"), ("n", None, "c")], "namespace string, key long, v string")
    assert [(r.key, r.v) for r in upsert(old, new, AS_OF, 0).collect()] == [(1, "b")]
    again = refresh(old, new.select("namespace", "key"), new, AS_OF, 0)
    assert [(r.key, r.v) for r in again.collect()] == [(1, "b")]


def test_upsert_evaluates_its_input_once(spark):
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b

    new = spark.createDataFrame([("n", k, "a") for k in range(50)], "namespace string, key long, v string")
    upsert(_lookup(spark, [("n", 1, "old", None)]), new.mapInArrow(seen, new.schema), AS_OF, 0).collect()
    assert count.value == 50


def test_record_negative(spark):
    requests = spark.createDataFrame([("n", 1), ("n", None), ("n", 2)], "namespace string, key long")
    empty = _lookup(spark, [])
    old = spark.sql("SELECT 'n' namespace, 1L key, TIMESTAMP_NTZ'2024-01-01 00:00:00' expires_at "
                    "UNION ALL SELECT 'n', 3L, TIMESTAMP_NTZ'2024-02-01 00:00:00' UNION ALL SELECT 'n', 4L, TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    found = read_through(requests, empty, empty.drop("expires_at"), AS_OF, negative=old, missing_ttl_seconds=86400)
    out = record_negative(old, found.not_found, AS_OF).collect()
    assert sorted((r.key, r.expires_at.day) for r in out) == [(1, 16), (2, 16), (3, 1)]


def test_descriptor_reasons(spark):
    tail = '"table_params":[],"serde_info":[]}'
    col = '{"name":"a","type":"int","comment":"","is_partition":"%s"}'
    docs = {
        "ok": '{"columns":[' + col % "0" + "]," + tail,
        "line end": '{"columns":[' + col % "1\\n" + "]," + tail,
        "cut": '{"columns":[' + col % "0" + "]," + tail[:-1],
        "number": '{"foo":1,"columns":[' + col % "0" + "]," + tail,
        "nested": '{"columns":[' + (col % "0").replace('"int"', '{"of":"int"}') + "]," + tail,
        "text": '{"columns":[' + col % "0" + '],"type_info":"view",' + tail,
    }
    df = spark.createDataFrame([("d", k, v) for k, v in docs.items()], "db string, table string, json string")
    key = "spark.sql.columnNameOfCorruptRecord"
    before = spark.conf.get(key)
    for name in (before, "_other"):
        spark.conf.set(key, name)
        try:
            got = {r.table: r.reason for r in parse_descriptors(df).rejected.collect()}
        finally:
            spark.conf.set(key, before)
        assert got.pop("text") in ("not lists of flat entries", "malformed json")
        assert got == {"line end": "is_partition is not an integer", "cut": "malformed json",
                       "number": "not lists of flat entries", "nested": "not lists of flat entries"}
