"""Descriptor parsing: the variants of the fixture description, one document each."""

import json

from relayout.operators.descriptors import parse_descriptors

BASE = {
    "columns": [{"name": "event_id", "type": "string", "comment": "", "is_partition": "0"},
                {"name": "event_date", "type": "string", "comment": "", "is_partition": "1"},
                {"name": "v", "type": "double", "comment": "value", "is_partition": "0", "extra": "ignored"}],
    "table_params": [{"param_key": "k1", "param_value": "v1"}, {"param_key": "k2", "param_value": "a"},
                     {"param_key": "k1", "param_value": "v2"}],
    "serde_info": [{"serde_input": "in.A", "serde_output": "out.A"}, {"serde_input": "in.B", "serde_output": "out.B"}],
    "type_info": [{"table_type": "MANAGED_TABLE", "view_expanded_text": ""},
                  {"table_type": "VIRTUAL_VIEW", "view_expanded_text": "select 1"}],
}


def _doc(**changes):
    d = dict(BASE)
    for k, v in changes.items():
        if v is None:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def _parse(spark, docs):
    df = spark.createDataFrame([("DB", f"t{i}", j) for i, j in enumerate(docs)], "db string, table string, json string")
    return parse_descriptors(df)


def test_columns_in_document_and_layout_order(spark):
    d = _parse(spark, [_doc()])
    rows = d.columns.orderBy("position").collect()
    assert [(r.position, r.layout_position, r.name, r.is_partition) for r in rows] == [
        (0, 0, "event_id", False), (1, 2, "event_date", True), (2, 1, "v", False)]
    assert rows[2].comment == "value" and rows[2].type == "double"


def test_params_last_duplicate_wins(spark):
    d = _parse(spark, [_doc()])
    assert {(r.param_key, r.param_value) for r in d.params.collect()} == {("k1", "v2"), ("k2", "a")}


def test_serde_last_and_type_first(spark):
    r = _parse(spark, [_doc()]).storage.first()
    assert (r.serde_input, r.serde_output, r.table_type, r.view_expanded_text) == ("in.B", "out.B", "MANAGED_TABLE", "")


def test_defaults_when_absent_or_empty(spark):
    r = _parse(spark, [_doc(type_info=None, serde_info=[])]).storage.first()
    assert (r.serde_input, r.serde_output, r.table_type, r.view_expanded_text) == ("", "", "", "")


def test_numbers_read_as_text(spark):
    cols = [{"name": "a", "type": "int", "comment": "", "is_partition": 1}]
    rows = _parse(spark, [_doc(columns=cols)]).columns.collect()
    assert [(r.name, r.is_partition) for r in rows] == [("a", True)]


def test_other_integers_are_data_columns(spark):
    cols = [{"name": "a", "is_partition": "2"}, {"name": "b", "is_partition": "+1"}, {"name": "c", "is_partition": "-0"}]
    rows = _parse(spark, [_doc(columns=cols)]).columns.orderBy("position").collect()
    assert [r.is_partition for r in rows] == [False, True, False]


def test_rejections(spark):
    docs = [
        _doc(columns=None),
        _doc(columns=[{"name": "a", "is_partition": "yes"}]),
        _doc(columns=[{"name": "a", "is_partition": " 1"}]),
        _doc(columns=[{"name": "a"}]),
        _doc(table_params=None),
        _doc(serde_info=None),
        _doc(type_info=[]),
        '{"columns": [',
        "[1, 2]",
        _doc(),
    ]
    d = _parse(spark, docs)
    reasons = {r.table: r.reason for r in d.rejected.collect()}
    assert reasons == {
        "t0": "missing columns", "t1": "is_partition is not an integer", "t2": "is_partition is not an integer",
        "t3": "is_partition is not an integer", "t4": "missing table_params", "t5": "missing serde_info",
        "t6": "empty type_info", "t7": "malformed json", "t8": "malformed json"}
    assert {r.table for r in d.columns.collect()} == {"t9"}


def test_parse_is_shuffle_free(spark):
    from relayout.plans.explain import exchanges

    d = _parse(spark, [_doc()])
    for df in (d.columns, d.params, d.storage, d.rejected):
        assert exchanges(df) == []


def test_null_first_type_entry_keeps_defaults(spark):
    d = _parse(spark, [_doc(type_info=[None, {"table_type": "VIRTUAL_VIEW", "view_expanded_text": "x"}])])
    assert d.rejected.count() == 0
    r = d.storage.first()
    assert (r.table_type, r.view_expanded_text) == ("", "")


def test_missing_keys_in_chosen_entries_are_null(spark):
    d = _parse(spark, [_doc(serde_info=[{"serde_input": "in.A"}], type_info=[{"view_expanded_text": "v"}])])
    r = d.storage.first()
    assert (r.serde_input, r.serde_output, r.table_type, r.view_expanded_text) == ("in.A", None, None, "v")


def test_field_listing_ignores_other_rules(spark):
    docs = [_doc(), _doc(columns=[{"name": "a", "is_partition": "yes"}]), _doc(table_params=None),
            _doc(columns=None), '{"columns": [']
    d = _parse(spark, docs)
    got = sorted((r.table, r.position, r.name) for r in d.fields.collect())
    assert got == [("t0", 0, "event_id"), ("t0", 1, "event_date"), ("t0", 2, "v"), ("t1", 0, "a"),
                   ("t2", 0, "event_id"), ("t2", 1, "event_date"), ("t2", 2, "v")]


def test_params_null_key_and_value(spark):
    params = [{"param_key": None, "param_value": "a"}, {"param_value": "b"}, {"param_key": "k", "param_value": None},
              {"param_key": "k", "param_value": "c"}, {"param_key": "j"}]
    got = {(r.param_key, r.param_value) for r in _parse(spark, [_doc(table_params=params)]).params.collect()}
    assert got == {(None, "b"), ("k", "c"), ("j", None)}


def test_last_of_repeated_keys(spark):
    text = _doc()
    repeated = [
        text.replace('"type": "double"', '"type": "old", "type": "double"'),
        '{"columns": [{"name": "old", "is_partition": "x"}], ' + text[1:],
        text[:-1] + ', "columns": null}',
        '{"columns": 3, ' + text[1:],
        text.replace('"type": "double"', '"type": {"a": 1}, "type": "double"'),
    ]
    d = _parse(spark, repeated)
    assert {(r.table, r.reason) for r in d.rejected.collect()} == {
        ("t2", "missing columns"), ("t3", "not lists of flat entries"), ("t4", "not lists of flat entries")}
    got = {(r.table, r.name, r.type) for r in d.columns.collect()}
    assert got == {(t, n, k) for t in ("t0", "t1") for n, k in (("event_id", "string"), ("event_date", "string"), ("v", "double"))}


def test_texts_that_look_nested(spark):
    texts = ['{"a": 1}', "[1]", "{", "plain", 'x":{', 'y\\', '\\":[{"', "[{}]: {", "',': ["]
    cols = [{"name": t, "type": "int", "comment": "", "is_partition": "0"} for t in texts]
    nested = [_doc(columns=[{"name": x, "is_partition": "0"}]) for x in ({"a": 1}, [1], {})]
    nested += [_doc(columns=[{"name": "a", "is_partition": "0"}, {"name": "b\\", "type": '"', "comment": x, "is_partition": "0"}]) for x in ({}, [])]
    # null lists and entries hide no nested value
    nested += ['{"columns": [null, {"name": {"a": 1}}], "other": null}', '{"columns": [{"name": [1]}], "other": null}']
    deep = '{"columns": [{"name": {"k": 1, "k": 2}, "is_partition": "0"}], "table_params": [], "serde_info": []}'
    d = _parse(spark, [_doc(columns=cols), *nested, deep])
    assert [r.name for r in d.columns.orderBy("position").collect()] == texts
    assert {r.table for r in d.rejected.where("reason = 'not lists of flat entries'").collect()} == {f"t{i}" for i in range(1, 9)}


def test_other_shapes(spark):
    docs = ['{"columns": "text"}', '{"columns": {"name": "a"}}', '{"columns": [["a"]]}', '{"other": 1}', '{"columns": [1]}',
            '{"other": [{"any": "text"}]}', "", "null", "7", '{"columns": [{"name": "a"},]}', "{'columns': []}"]
    reasons = [r.reason for r in sorted(_parse(spark, docs).rejected.collect(), key=lambda r: int(r.table[1:]))]
    assert reasons == ["not lists of flat entries"] * 5 + ["missing columns"] + ["malformed json"] * 5
