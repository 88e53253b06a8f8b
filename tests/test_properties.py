"""Random small inputs, each operator against a brute-force model of its semantics."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from relayout import relayout
from relayout.operators import lookup as L
from relayout.operators.containment import schema_containment
from relayout.sources.staging import path_table_for, write_table

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

# --- relayout: dynamic overwrite of touched target partitions, twice ---------------------------

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType()),
                       T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType()),
                       T.StructField("a", T.StringType())])
rows_st = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2), st.sampled_from(["p", "q", None]),
                             st.sampled_from(["x", "y", "z"])), min_size=1, max_size=25)
pred_st = st.dictionaries(st.sampled_from(["a", "b", "v"]),
                          st.one_of(st.sampled_from(["x", "y", "w"]), st.integers(0, 5), st.none()), max_size=2)


def _matches(row, preds):
    named = dict(zip(["id", "v", "b", "c", "a"], row))
    for k, want in preds.items():
        have = named[k]
        if want is None or have is None:
            return False
        if isinstance(want, str) != isinstance(have, str):
            return False
        if have != want:
            return False
    return True


def _model(rows, loads):
    state = {}
    for preds in loads:
        touched = {}
        for r in rows:
            if _matches(r, preds):
                touched.setdefault((r[3], r[2]), []).append(r)
        state.update(touched)
    return Counter(r for part in state.values() for r in part)


def _typed(preds):
    # a string value on an integer column would be a type error in ANSI mode; keep types aligned
    return {k: v for k, v in preds.items()
            if v is None or (k == "a") == isinstance(v, str)}


@settings(SETTINGS, max_examples=15)
@given(rows=rows_st, first=pred_st, second=pred_st)
def test_relayout_matches_model(spark, scratch, rows, first, second):
    rows = [(i, v, b, c, a) for i, (v, b, c, a) in enumerate(rows)]
    first, second = _typed(first), _typed(second)
    src = write_table(spark.createDataFrame(rows, SCHEMA), scratch("prop_src"), ["a"])
    tgt = path_table_for(SCHEMA, scratch("prop_tgt"), ["c", "b"], columns=["id", "v", "a", "c", "b"])
    relayout(spark, src, tgt, first)
    out = relayout(spark, src, tgt, second)
    got = Counter((r.id, r.v, r.b, r.c, r.a) for r in out.collect())
    assert got == _model(rows, [first, second])


# --- containment -------------------------------------------------------------------------------

inv_st = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["n1", "n2", "n3"]), st.sampled_from(["int", "string"]),
                            st.sampled_from([None, "c"])), max_size=12)


@SETTINGS
@given(src=inv_st, tgt=inv_st)
def test_containment_matches_model(spark, src, tgt):
    schema = "pair_id bigint, name string, type string, comment string"
    got = {r.pair_id: (r.valid, r.missing_columns) for r in schema_containment(
        spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema),
        spark.createDataFrame([(p,) for p in range(5)], "pair_id bigint")).collect()}
    want = {}
    for p in range(5):
        s = {r[1:] for r in src if r[0] == p}
        t = {r[1:] for r in tgt if r[0] == p}
        missing = len(t - s)
        want[p] = (bool(s) and bool(t) and missing == 0, missing)
    assert got == want


# --- read-through --------------------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 15)
EXP = st.sampled_from([None, T0 - dt.timedelta(hours=1), T0, T0 + dt.timedelta(hours=1)])
KEY = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 6))


@SETTINGS
@given(cache=st.dictionaries(KEY, EXP, max_size=8), negative=st.dictionaries(KEY, EXP, max_size=5),
       source=st.sets(KEY, max_size=10), requests=st.lists(KEY, max_size=20))
def test_read_through_matches_model(spark, cache, negative, source, requests):
    lookup = spark.createDataFrame([(ns, k, f"cache-{ns}{k}", e) for (ns, k), e in cache.items()],
                                   "namespace string, key bigint, v string, expires_at timestamp_ntz")
    neg = spark.createDataFrame([(ns, k, e) for (ns, k), e in negative.items()],
                                "namespace string, key bigint, expires_at timestamp_ntz")
    src = spark.createDataFrame([(ns, k, f"src-{ns}{k}") for ns, k in source], "namespace string, key bigint, v string")
    req = spark.createDataFrame(requests, "namespace string, key bigint")
    r = L.read_through(req, lookup, src, "2024-01-15 00:00:00", negative=neg, missing_ttl_seconds=60)

    def live(e):
        return e is None or e > T0

    found, absent = set(), set()
    for ns, k in set(requests):
        if (ns, k) in cache and live(cache[(ns, k)]):
            found.add((ns, k, f"cache-{ns}{k}", "cache"))
        elif (ns, k) in negative and live(negative[(ns, k)]):
            continue
        elif (ns, k) in source:
            found.add((ns, k, f"src-{ns}{k}", "source"))
        else:
            absent.add((ns, k))
    assert sorted((x.namespace, x.key, x.v, x.origin) for x in r.found.collect()) == sorted(found)
    assert sorted((x.namespace, x.key) for x in r.not_found.collect()) == sorted(absent)


# --- scan narrowing: the partition sub-folder chosen from the predicates never loses a row -------

P_VALUES = ["plain", "a b", "x/y", "k=v", "50%", "ü", "dot.dash-1"]
NARROW_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.StringType()),
                              T.StructField("q", T.IntegerType())])
NARROW_ROWS = [(i, P_VALUES[i % len(P_VALUES)], i % 3) for i in range(42)]


@settings(SETTINGS, max_examples=25)
@given(p=st.one_of(st.sampled_from(P_VALUES + ["absent"]), st.none()), q=st.one_of(st.integers(0, 3), st.none()),
       use_q=st.booleans())
def test_narrowed_scan_matches_filter(spark, scratch, p, q, use_q):
    from relayout import extract

    key = "narrow_src"
    if key not in _NARROW:
        _NARROW[key] = write_table(spark.createDataFrame(NARROW_ROWS, NARROW_SCHEMA), scratch(key), ["p", "q"])
    preds = {"p": p}
    if use_q:
        preds["q"] = q
    got = sorted(r.id for r in extract(spark, _NARROW[key], preds).collect())
    want = sorted(i for i, pv, qv in NARROW_ROWS
                  if p is not None and pv == p and (not use_q or (q is not None and qv == q)))
    assert got == want


_NARROW: dict = {}


# --- descriptors: every output against a plain-Python reading of the rules -----------------------

import json as _json  # noqa: E402
import re as _re  # noqa: E402

_col = st.one_of(st.none(), st.fixed_dictionaries(
    {"name": st.sampled_from(["a", "b", "c"])},
    optional={"type": st.sampled_from(["int", "string"]), "comment": st.sampled_from(["", "x"]),
              "is_partition": st.sampled_from(["0", "1", "2", "+1", "-0", "x", " 1", "99999999999"])}))
_param = st.one_of(st.none(), st.fixed_dictionaries(
    {}, optional={"param_key": st.sampled_from(["k1", "k2"]), "param_value": st.sampled_from(["v1", "v2", "v3"])}))
_serde = st.one_of(st.none(), st.fixed_dictionaries(
    {}, optional={"serde_input": st.sampled_from(["i1", "i2"]), "serde_output": st.sampled_from(["o1", "o2"])}))
_type = st.one_of(st.none(), st.fixed_dictionaries(
    {}, optional={"table_type": st.sampled_from(["T1", "T2"]), "view_expanded_text": st.sampled_from(["", "v"])}))
_doc_st = st.fixed_dictionaries({}, optional={
    "columns": st.one_of(st.none(), st.lists(_col, max_size=4)),
    "table_params": st.one_of(st.none(), st.lists(_param, max_size=4)),
    "serde_info": st.one_of(st.none(), st.lists(_serde, max_size=3)),
    "type_info": st.one_of(st.none(), st.lists(_type, max_size=2)),
})


def _int_text(v):
    return v is not None and _re.fullmatch(r"[+-]?[0-9]+", v) is not None and -2**31 <= int(v) < 2**31


def _describe(doc):
    cols, params, serde, types = (doc.get(k) for k in ("columns", "table_params", "serde_info", "type_info"))
    reason = None
    if cols is None:
        reason = "missing columns"
    elif params is None:
        reason = "missing table_params"
    elif serde is None:
        reason = "missing serde_info"
    elif any(x is None for x in cols + params + serde):
        reason = "null entry"
    elif types == []:
        reason = "empty type_info"
    elif any(not _int_text(c.get("is_partition")) for c in cols):
        reason = "is_partition is not an integer"
    fields = [] if cols is None else [
        (i, None, None, None) if c is None else (i, c.get("name"), c.get("type"), c.get("comment"))
        for i, c in enumerate(cols)]
    if reason:
        return reason, fields, None, None, None
    part = [int(c["is_partition"]) == 1 for c in cols]
    order = [i for i in range(len(cols)) if not part[i]] + [i for i in range(len(cols)) if part[i]]
    columns = sorted((i, order.index(i), cols[i].get("name"), part[i]) for i in range(len(cols)))
    merged = {}
    for p in params:
        merged[p.get("param_key")] = p.get("param_value")
    last = serde[-1] if serde else None
    first = types[0] if types else None
    storage = ((last.get("serde_input"), last.get("serde_output")) if last is not None else ("", ""),
               (first.get("table_type"), first.get("view_expanded_text")) if first is not None else ("", ""))
    return None, fields, columns, set(merged.items()), storage


@settings(SETTINGS, max_examples=30)
@given(docs=st.lists(_doc_st, min_size=1, max_size=6))
def test_descriptors_match_model(spark, docs):
    from relayout.operators.descriptors import parse_descriptors

    df = spark.createDataFrame([("db", f"t{i}", _json.dumps(d)) for i, d in enumerate(docs)],
                               "db string, table string, json string")
    d = parse_descriptors(df)
    rejected = {r.table: r.reason for r in d.rejected.collect()}
    fields = {}
    for r in d.fields.collect():
        fields.setdefault(r.table, []).append((r.position, r.name, r.type, r.comment))
    columns = {}
    for r in d.columns.collect():
        columns.setdefault(r.table, []).append((r.position, r.layout_position, r.name, r.is_partition))
    params = {}
    for r in d.params.collect():
        params.setdefault(r.table, set()).add((r.param_key, r.param_value))
    storage = {r.table: ((r.serde_input, r.serde_output), (r.table_type, r.view_expanded_text))
               for r in d.storage.collect()}
    for i, doc in enumerate(docs):
        t = f"t{i}"
        reason, want_fields, want_columns, want_params, want_storage = _describe(doc)
        assert rejected.get(t) == reason, (doc, rejected.get(t))
        assert sorted(fields.get(t, [])) == want_fields, doc
        if reason is None:
            assert sorted(columns.get(t, [])) == want_columns, doc
            assert params.get(t, set()) == want_params, doc
            assert storage[t] == want_storage, doc
        else:
            assert t not in columns and t not in params and t not in storage
