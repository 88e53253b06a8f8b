"""The job's inputs and guards: views, folders, Hive settings, rejected rows, pruned listing, sized writes."""

import datetime as dt
import os
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayout import Expr, PathTable, extract, relayout
from relayout.operators.descriptors import parse_descriptors
from relayout.operators.job import check_provider, load_frame, split_rejected
from relayout.plans import distribution as D
from relayout.plans.explain import exchanges
from relayout.sources.staging import path_table_for, write_table
from relayout.sources.tables import Layout, layout_of, matching_folders, path_table, read_table

KIND = "id long, d string, h int, v string"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}", i % 4, str(i)) for i in range(48)], KIND)


def test_view_to_catalog_table(spark, rows, scratch):
    tag = uuid.uuid4().hex[:8]
    rows.where("h < 3").createOrReplaceTempView(f"v_{tag}")
    for name, provider in ((f"t_{tag}", "parquet"),):
        spark.sql(f"CREATE TABLE {name} (v STRING, id BIGINT, h INT) USING {provider} PARTITIONED BY (h) LOCATION '{scratch(name)}'")
        spark.sql(f"INSERT INTO {name} VALUES ('kept', -1, 9), ('gone', -2, 1)")
        out = relayout(spark, f"v_{tag}", name, {"d": "2024-01-02"})
        want = {(r.id, r.h) for r in rows.where("h < 3 and d = '2024-01-02'").collect()} | {(-1, 9)}
        assert {(r.id, r.h) for r in out.collect()} == want
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("relayout_")]


def test_path_source_view_to_path_target(spark, rows, scratch):
    rows.createOrReplaceTempView("some_rows")
    tgt = path_table_for(rows.schema, scratch("t"), ["d"])
    assert relayout(spark, "some_rows", tgt, {}).count() == 48


def test_folders_are_compared_as_their_file_system_names_them(spark, rows, scratch):
    src = write_table(rows, scratch("src"), ["d"])
    plain = src.path.removeprefix("file:")
    for path in (plain, plain + "/", "file://" + plain, "file:" + plain + "/"):
        with pytest.raises(ValueError, match="same table"):
            relayout(spark, src, PathTable(path, src.schema, ("h",)), {})
    for path in (plain + "/inner", os.path.dirname(plain)):
        with pytest.raises(ValueError, match="inside"):
            relayout(spark, src, PathTable(path, src.schema, ("h",)), {})
    relayout(spark, src, PathTable(plain + "_2", src.schema, ("h",)), {}, reread=False)  # a longer name is no subfolder


def test_hive_targets_need_settings():
    def session(**known):
        return lambda key, default: known.get(key.replace(".", "_"), default)

    check_provider("t", "parquet", session())
    check_provider("t", None, session())
    with pytest.raises(ValueError, match="hive.exec.dynamic.partition.mode=nonstrict"):
        check_provider("t", "hive", session())
    with pytest.raises(ValueError, match="hive.exec.dynamic.partition=true"):
        check_provider("t", "HIVE", session(hive_exec_dynamic_partition="false", hive_exec_dynamic_partition_mode="nonstrict"))
    check_provider("t", "hive", session(hive_exec_dynamic_partition_mode="nonstrict"))


def test_rejected_rows(spark, scratch):
    kind = "id long, amount string, who struct<n:string>, many array<string>, m map<string,string>, p string"
    rows = spark.createDataFrame([
        (1, "1.5", ("1",), ["1", None], {"1": "2"}, "1"), (2, "x", ("1",), [], {}, "1"), (3, None, None, None, None, None),
        (4, "2", ("q",), ["1"], None, "2"), (5, "2", ("1",), ["1", "z"], {"a": "1"}, "2"), (6, "2", ("1",), ["1"], {"1": "b"}, "y")], kind)
    src = write_table(rows, scratch("src"), ["id"])
    want = T.StructType.fromDDL("amount double, who struct<n:int>, many array<int>, m map<int,int>, id long, p int")
    tgt = PathTable(scratch("tgt"), want, ("p",))
    bad = scratch("bad")
    out = relayout(spark, src, tgt, {}, rejects=bad)
    assert {r.id for r in out.collect()} == {1, 3}
    got = {r.id: r.rejected_columns for r in spark.read.parquet(bad).collect()}
    assert got == {2: ["amount"], 4: ["who"], 5: ["m", "many"], 6: ["m", "p"]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        relayout(spark, src, PathTable(scratch("tgt"), want, ("p",)), {})


def test_rejects_read_the_source_once(spark, rows, scratch):
    good, bad = split_rejected(rows, Layout(T.StructType.fromDDL("id long, v int"), T.StructType.fromDDL("h int")))
    assert good.columns == ["id", "v", "h"] and bad.columns == ["id", "v", "h", "rejected_columns"]
    assert good.count() == 48 and bad.count() == 0 and all("extract-" in f for f in good.inputFiles())


# --- folders are listed level by level -------------------------------------------------------------

LISTED = {}
VALUES = st.sampled_from(["2024-01-01", "2024-1-2", "2024-01-09", None, Expr("date'2024-01-01' + 1")])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(d=st.one_of(st.just("any"), VALUES), h=st.one_of(st.just("any"), st.sampled_from([0, "1", "02", 7, None, "x:y"])))
def test_listing_finds_what_the_filter_finds(spark, scratch, d, h):
    if "t" not in LISTED:
        rows = spark.createDataFrame([(i, None if i % 5 == 0 else dt.date(2024, 1, 1 + i % 3), i % 4, f"x:{i % 2} %/") for i in range(60)],
                                     "id long, d date, h int, s string")
        LISTED["t"], LISTED["rows"] = write_table(rows, scratch("listed"), ["d", "h", "s"]), rows.collect()
    predicates = {k: v for k, v in (("d", d), ("h", h)) if v != "any" and v != "x:y"}
    if h == "x:y":
        predicates["s"] = "x:1 %/"
    got = sorted(r.id for r in extract(spark, LISTED["t"], predicates).collect())
    dates = {"2024-01-01": dt.date(2024, 1, 1), "2024-1-2": dt.date(2024, 1, 2), "2024-01-09": dt.date(2024, 1, 9)}

    def holds(r):
        ok = True
        if "d" in predicates:
            ok = d is not None and r.d == (dt.date(2024, 1, 2) if isinstance(d, Expr) else dates[d])
        if "h" in predicates:
            ok = ok and h is not None and r.h == int(h)
        return ok and ("s" not in predicates or r.s == predicates["s"])

    assert got == sorted(r.id for r in LISTED["rows"] if holds(r))


def test_a_folder_that_does_not_match_is_never_listed(spark, rows, scratch):
    t = write_table(rows, scratch("t"), ["d", "h"])
    folder = t.path.removeprefix("file:")
    # two tables' layouts in one: an error as soon as Spark lists it
    os.makedirs(f"{folder}/d=2024-01-03/other=1/x=2")
    open(f"{folder}/d=2024-01-03/other=1/x=2/part-0.parquet", "w").close()
    with pytest.raises(Exception, match="CONFLICTING|[Cc]onflicting"):
        read_table(spark, t).count()
    got = extract(spark, t, {"d": "2024-01-02", "h": 1})
    assert {r.id for r in got.collect()} == {r.id for r in rows.where("d = '2024-01-02' and h = 1").collect()}
    assert all("d=2024-01-02/h=1/" in f for f in got.inputFiles())
    assert matching_folders(spark, t, {"d": "2024-01-02"}) == [f"{t.path}/d=2024-01-02"]
    assert matching_folders(spark, t, {"v": "1"}) is None and extract(spark, t, {"d": "2030-01-01"}).count() == 0


def test_listing_of_other_folders(spark, rows, scratch, monkeypatch):
    t = write_table(rows, scratch("t"), ["d", "h"])
    assert matching_folders(spark, PathTable(t.path, t.schema, ("h", "d")), {"h": 1}) is None  # declared otherwise
    assert matching_folders(spark, t, {"d": Expr("v")}) is None  # a value told by another column
    monkeypatch.setattr("relayout.sources.tables.MAX_LISTED", 2)
    assert matching_folders(spark, t, {"h": 1}) is None  # too many folders to look into: Spark lists them
    assert extract(spark, t, {"h": 1}).count() == 12


# --- the number of write tasks comes from a histogram -------------------------------------------------------------


def test_histogram_and_tasks(spark, rows):
    found = D.histogram(rows, ["d", "h"], 1000)
    assert (found.rows, found.partitions, found.largest, found.hot) == (48, 12, 4, [])
    assert [r["n"] for r in D.histogram(rows, ["d"], 15).hot] == [16, 16, 16]
    none = D.histogram(rows.where("false"), ["d"], 10)
    assert (none.rows, none.partitions, none.largest, none.hot) == (0, 0, 0, [])
    make = lambda n, p: D.Histogram(n, p, 0, [])
    assert D.rows_per_task(rows) == (64 << 20) // (8 + 8 + 20 + 4 + 20)
    assert D.write_tasks(make(100, 3), 8, 4_000_000) == 1 and D.write_tasks(make(100, 24 * 5), 8, 4_000_000) == 5
    assert D.write_tasks(make(100, 10 ** 6), 8, 4_000_000) == 32 and D.write_tasks(make(10 ** 9, 10), 8, 4_000_000) == 250


def test_many_small_partitions_are_dealt_to_several_tasks(spark, scratch):
    rows = spark.range(0, 2400, 1, 2).select("id", (F.col("id") % 240).cast("int").alias("p"))
    tgt = path_table_for(rows.schema, scratch("t"), ["p"])
    frame = load_frame(spark, rows, tgt)
    assert len(exchanges(frame)) == 1 and "REPARTITION_BY_NUM" in exchanges(frame)[0]
    assert frame.rdd.getNumPartitions() == min(10, 4 * spark.sparkContext.defaultParallelism)
    per_task = frame.groupBy(F.spark_partition_id()).agg(F.count_distinct("p").alias("n")).collect()
    assert sum(r.n for r in per_task) == 240  # no partition is written by two tasks


def test_hot_partitions_alone_are_split(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 1500, F.lit(None)).when(F.col("id") < 2000, F.lit("b c"))
                                    .otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("p"))
    out = D.distribute_sized(rows, ["p"], share=300, files_per_task=10)
    assert out.columns == rows.columns and out.exceptAll(rows).isEmpty() and rows.exceptAll(out).isEmpty()
    tasks = {r.p: r.n for r in out.select("p", F.spark_partition_id().alias("task")).groupBy("p").agg(F.count_distinct("task").alias("n")).collect()}
    assert 2 <= tasks[None] <= 5 and tasks["b c"] == 2 and all(n == 1 for p, n in tasks.items() if p not in (None, "b c"))


# --- layouts from documents -------------------------------------------------------------------------------------


def test_layout_of_a_document(spark):
    doc = ('{"columns": [{"name": "p", "type": "date", "is_partition": "1"}, {"name": "a", "type": "array<struct<x:int>>", '
           '"comment": "some", "is_partition": "0"}, {"name": "b", "type": "decimal(10,2)", "comment": "", "is_partition": "+0"}], '
           '"table_params": [], "serde_info": []}')
    df = spark.createDataFrame([("Db", "T", doc), ("Db", "bad", "{"), ("Db", "twice", doc), ("db", "TWICE", doc)], "db string, table string, json string")
    d = parse_descriptors(df)
    layout = d.layout("DB", "t")
    assert layout.partition_names == ["p"] and layout.data_names == ["a", "b"]
    assert layout.field("a").metadata == {"comment": "some"} and layout.field("p").metadata == {} and layout.field("b").metadata == {"comment": ""}
    assert layout.field("b").dataType == T.DecimalType(10, 2)
    t = path_table(layout, "/nowhere")
    assert t.partition_by == ("p",) and layout_of(spark, t) == layout
    for name, reason in (("bad", "malformed"), ("none", "no document"), ("twice", "2 documents")):
        with pytest.raises(ValueError, match=reason):
            d.layout("db", name)
