"""What the descriptor queries move and read for each document: lines, not documents, are dealt; a plain document is read once; a
described table's list moves whole."""

from datetime import datetime

from relayout import fixtures as fx
from relayout import queries as Q
from relayout.operators.descriptors import parse_descriptors
from relayout.plans.explain import plan_text

LINE = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _lines(spark, tmp_path, rows, files):
    d = "file:" + str(tmp_path)
    full = [(*r, "F", datetime(1995, 1, 1)) for r in rows]
    spark.createDataFrame(spark.sparkContext.parallelize(full, files), LINE).write.parquet(f"{d}/lineitem.parquet")
    return d


def _line(order, number, flag="A", quantity=20.0, part=7):
    return (order, number, part, 3, quantity, 0.04, 0.02, flag)


def test_documents_are_not_shuffled(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = [_line(o, n) for o in range(8 * cores) for n in (1, 2)]
    even = _lines(spark, tmp_path / "even", rows, cores)
    one = _lines(spark, tmp_path / "one", rows, 1)
    plan = plan_text(fx.descriptor_documents(spark, one, spread=True), "simple")
    assert plan.count("Exchange") == 1 and plan.index("StructsToJson") < plan.index("Exchange")  # lines are, below the documents
    if cores == len(spark.read.parquet(f"{even}/lineitem.parquet").inputFiles()) == spark.read.parquet(f"{even}/lineitem.parquet").rdd.getNumPartitions():
        assert "Exchange" not in plan_text(fx.descriptor_documents(spark, even, spread=True), "simple")
    found = [sorted(tuple(r) for r in fx.descriptor_documents(spark, d, spread=s).collect()) for d in (even, one) for s in (True, False)]
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) == len(rows)
    assert Q.descriptor_storage(spark, one).count() == len(rows)


def test_plain_documents_are_read_once(spark):
    docs = ['{"columns":[{"name":"a","type":"int"%s}],"table_params":[],"serde_info":[]%s}' % x for x in (
        (',"is_partition":"0"', ""), (',"is_partition":"2"', ',"other":[{"k":1}]'),
        (',"is_partition":"0","x":"}],"', ',"y":[]'), (',"is_partition":"0","x":":[{"', ',":[":[]'),
        # not plain, in disguise
        (',"is_partition":"0","x":"}","y":{"z":1},"w":"{"', ""), (',"is_partition":"0","x":"}]","y":[],"w":"[{"', ""),
        (',"is_partition":"0","x":"}],","y":[],"w":"[{"', ""), (',"is_partition":"0","x":"}],\\"","y":[],"w":"[{"', ""),
        (',"is_partition":"0"', ',"other":[1]'), (',"is_partition":"0"', ',"other":[{"k":1},null]'), (',"is_partition":"0","x":tru', ""),
        (',"is_partition":"0"},null,{"is_partition":"0"', ""), (',"is_partition":"0"', ',"other":[{"k":"\\x"}]'), (',"is_partition":"0"},{', ""))]
    df = spark.createDataFrame([("d", f"t{i:02}", j) for i, j in enumerate(docs)], "db string, table string, json string")
    d = parse_descriptors(df)
    flat = "not lists of flat entries"
    assert [r.reason for r in d.parsed.orderBy("table").collect()] == [
        None, None, None, None, flat, flat, flat, flat, flat, None, "malformed json", "null entry", "malformed json", "is_partition is not an integer"]
    generator = next(x for x in plan_text(d.storage, "simple").splitlines() if "Generate explode" in x)
    assert generator.count("from_json") == 1


def test_lists_of_columns_move_whole(spark, tmp_path):
    rows = [_line(1, 1, "A"), _line(1, 3, "A"), _line(1, 3, "A"), _line(2, 1, "R"), _line(2, 2, "A"), _line(3, 2, "A", quantity=1.0),
            _line(3, 1, "A"), _line(None, 1), _line(4, None, "N")]
    d = _lines(spark, tmp_path / "t", rows, 2)
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.containment_comments(spark, d)
        plan = plan_text(out, "simple")
        got = {(r.pair_id, r.valid, r.missing_columns) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert got == {("t_1_1_7_3", True, 0), ("t_1_3_7_3", True, 0), ("t_2_1_7_3", False, 1), ("t_2_2_7_3", True, 0),
                   ("t_3_1_7_3", False, 1), ("t_3_2_7_3", False, 0), ("t_4_7_3", False, 0)}
    above = plan[:plan.index("Union")]
    assert "Exchange" not in above[above.index("partial_max"):]  # no row per column is shuffled
    pairs = fx.descriptor_pairs(spark, d)
    assert plan_text(pairs, "simple").count("Exchange") == 1 and pairs.count() == 7
