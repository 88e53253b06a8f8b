"""Table descriptors: JSON documents describing a table, parsed in bulk.

Input: a DataFrame with ``db, table, json``. A document looks like

    {"columns":      [{"name": ..., "type": ..., "comment": ..., "is_partition": "0" | "1"}, ...],
     "table_params": [{"param_key": ..., "param_value": ...}, ...],
     "serde_info":   [{"serde_input": ..., "serde_output": ...}, ...],
     "type_info":    [{"table_type": ..., "view_expanded_text": ...}, ...]}

Rules: a column is a partition column when ``is_partition`` reads as the integer 1; duplicate
parameter keys keep their last value; the last ``serde_info`` entry wins (none: empty strings); the
first ``type_info`` entry wins (list absent, or its first entry null: empty strings); a key missing
from a chosen entry is null. Unknown keys are ignored; numbers in place of strings are read as
their text.

A document that cannot be described is not dropped silently: it goes to ``rejected`` with a reason
(malformed JSON, another shape than lists of
flat objects, a missing ``columns`` / ``table_params`` / ``serde_info`` list, a null entry,
an empty ``type_info`` list, an ``is_partition`` that is not an integer).

Everything is evaluated row by row with JVM-side JSON, array and higher-order functions: no
shuffle, no Python, and each document's work is bounded by its own size. A document whose brackets show lists of flat
entries is plain: it only has to be JSON, and is read once, as the structs that are wanted, which keep the last value of a
repeated key. Any other is read as a map of lists of maps of texts, too, which refuses every other shape, whichever keys it
has. The one thing that lets pass is a nested object or list in a text's place (read as its JSON text), which is told from
the document without its texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import folded
from ..sources.tables import Layout

#: What a document is: this type refuses every other shape, whichever keys a document has.
SHAPE = "map<string,array<map<string,string>>>"
#: What is read of it. Of a repeated key the last value counts.
DOCUMENT_SCHEMA = (
    "columns array<struct<name:string,type:string,comment:string,is_partition:string>>, "
    "table_params array<struct<param_key:string,param_value:string>>, "
    "serde_info array<struct<serde_input:string,serde_output:string>>, "
    "type_info array<struct<table_type:string,view_expanded_text:string>>"
)
#: Where the second read keeps a text that is no JSON.
BROKEN = "_broken"
#: Texts are in double quotes, as JSON has it.
READING = {"allowSingleQuotes": "false"}
#: In a document without its texts: an entry that holds an object or a list.
NESTED = r"""[\[,]\s*\{[^{}\[\]]*:\s*[\[{]"""

#: A document that is flat for certain, if it is JSON: keys with lists of entries without a bracket, in texts or outside. A nested object
#: follows a colon, and a nested list a key that follows no list: neither passes, whatever texts hold. No entry is looked at twice.
PLAIN = (r'\A\s*+\{(?:\s*+"[^"\\\[\]{}]*"\s*+:\s*+\[\s*+(?:\{[^\[\]{}]*\}\s*+(?:,\s*+(?=\{)|(?=\])))*+\]\s*+(?:,(?=\s*+")|(?=\})))*+\}\s*+\z')
#: Bytes of a document that is looked at this way.
GLANCE = 1 << 20

# Integer.parseInt accepts an optional sign and decimal digits only (no blanks), within int range.
INT_TEXT = r"\A[+-]?[0-9]+\z"


@dataclass(frozen=True)
class Descriptors:
    fields: DataFrame    # db, table, position, name, type, comment (D6: every parseable "columns" list)
    columns: DataFrame   # db, table, position, layout_position, name, type, comment, is_partition
    params: DataFrame    # db, table, param_key, param_value
    storage: DataFrame   # db, table, serde_input, serde_output, table_type, view_expanded_text
    rejected: DataFrame  # db, table, json, reason
    lists: DataFrame     # db, table, columns: a described table's list in document order, whole
    parsed: DataFrame    # db, table, json, doc, flat, reason: what the others are views of

    def layout(self, db: str, table: str) -> Layout:
        """S2 from a document: the layout of one described table. Only that table's columns reach the driver. Names of databases
        and tables are matched without regard to case. A table without a document, or with one that
        describes none, is an error, as is one with several."""
        named = (folded(F.col("db")) == db.lower()) & (folded(F.col("table")) == table.lower())
        documents = self.parsed.where(named).select(F.col("reason"), F.col("doc.columns").alias("columns")).limit(2).collect()
        if len(documents) != 1:
            raise ValueError(f"{len(documents) or 'no'} {'documents describe' if documents else 'document describes'} {db}.{table}")
        if documents[0]["reason"] is not None:
            raise ValueError(f"the document of {db}.{table} is rejected: {documents[0]['reason']}")
        fields: dict[bool, list[T.StructField]] = {True: [], False: []}
        for c in documents[0]["columns"]:
            meta = {} if c["comment"] is None else {"comment": c["comment"]}
            fields[int(c["is_partition"]) == 1].append(T.StructField(c["name"], T.DataType.fromDDL(c["type"]), True, meta))
        return Layout(T.StructType(fields[False]), T.StructType(fields[True]))


def _parsed_int(c: Column) -> Column:
    return F.when(c.rlike(INT_TEXT), c.try_cast("int"))


def _is_partition(c: Column) -> Column:
    """Whether a flag reads as 1: nearly all are one digit."""
    return F.when(c.isin("0", "2"), F.lit(False)).when(c == "1", F.lit(True)).otherwise(_parsed_int(c) == 1)


def _plain(json: Column) -> Column:
    """Whether the text is seen at a glance to hold lists of flat entries, none of them null: most documents are. Long ones
    are told the other way."""
    return (F.octet_length(json) < GLANCE) & json.rlike(PLAIN)


def _nested(json: Column) -> Column:
    """Whether a text of the document is a nested object or list in truth, which the shape lets pass (as its JSON
    text). Texts may hold brackets, too: all texts are emptied first."""
    return F.regexp_replace(F.regexp_replace(json, r"\\.", ""), '"[^"]*"', '""').rlike(NESTED)


def _reason(doc: Column, flat: Column, plain: Column, json: Column) -> Column:
    cols = doc["columns"]
    null_entry = lambda a: F.exists(a, lambda x: x.isNull())
    # nearly all flags are one digit
    bad_flag = F.exists(cols, lambda x: F.when(x["is_partition"].isin("0", "1", "2"), F.lit(False)).otherwise(_parsed_int(x["is_partition"]).isNull()))
    return (
        F.when(~flat, F.when(F.from_json(json, "map<string,string>", READING).isNull(), F.lit("malformed json"))
               .otherwise(F.lit("not lists of flat entries")))
        .when(cols.isNull(), F.lit("missing columns"))
        .when(doc["table_params"].isNull(), F.lit("missing table_params"))
        .when(doc["serde_info"].isNull(), F.lit("missing serde_info"))
        .when(~plain & (null_entry(cols) | null_entry(doc["table_params"]) | null_entry(doc["serde_info"])),
              F.lit("null entry"))
        .when(F.size(doc["type_info"]) == 0, F.lit("empty type_info"))
        .when(bad_flag, F.lit("is_partition is not an integer"))
    )


def parse_descriptors(df: DataFrame, json_col: str = "json") -> Descriptors:
    """The five outputs are lazy views of one parse expression; each one that is run scans and parses
    its input again. Where several are needed, run them over a materialized parse (``parsed`` of this
    result, see :func:`relayout.materialize`)."""
    # The parse is the output of one generator (one element per row), so every later field access reads that value: a
    # plain column would let the optimizer parse the document once per accessed field. What is told from it are columns above
    # the generator: in a lambda every step would copy the whole document.
    json = F.col(json_col)
    read = F.struct(_plain(json).alias("plain"),
                    F.from_json(json, f"{DOCUMENT_SCHEMA}, {BROKEN} string", {**READING, "columnNameOfCorruptRecord": BROKEN}).alias("doc"))
    # a plain document only has to be JSON
    shaped = F.when(F.col("p.plain"), F.col(f"p.doc.{BROKEN}").isNull()).otherwise(F.from_json(json, SHAPE, READING).isNotNull())
    doc = F.col("p.doc").dropFields(BROKEN)
    flat = shaped & (F.col("p.plain") | ~_nested(json))
    parsed = (df.select("db", "table", json_col, F.explode_outer(F.array(read)).alias("p"))
              .select("db", "table", json_col, doc.alias("doc"), flat.alias("flat"), _reason(F.col("p.doc"), flat, F.col("p.plain"), json).alias("reason")))
    return outputs_of(parsed.withColumnRenamed(json_col, "json"))


def outputs_of(parsed: DataFrame) -> Descriptors:
    """The five outputs of an already parsed (and, to parse once, materialized) table."""
    good = parsed.where(F.col("reason").isNull())
    rejected = parsed.where(F.col("reason").isNotNull()).select("db", "table", "json", "reason")
    return Descriptors(_fields(parsed), _columns(good), _params(good), _storage(good), rejected, _lists(good), parsed)


def _fields(parsed: DataFrame) -> DataFrame:
    """The field list as the plain listing call gives it: every entry of ``columns`` in document
    order, for every document that parses and has that list; the other keys and ``is_partition``
    are not looked at, so documents rejected for those reasons still list their fields."""
    listed = parsed.where(F.col("flat") & F.col("doc.columns").isNotNull())
    return (listed.select("db", "table", F.posexplode("doc.columns").alias("position", "c"))
            .select("db", "table", "position", "c.name", "c.type", "c.comment"))


def _lists(good: DataFrame) -> DataFrame:
    return good.select("db", "table", F.col("doc.columns").alias("columns"))


def _columns(good: DataFrame) -> DataFrame:
    """One row per column; ``position`` is the document order, ``layout_position``
    puts data columns first and partition columns after, each group in document order."""
    # Sorting on (is_partition, position) puts data columns first, each group in document order. The entries' texts are
    # looked up afterwards, not moved by the sort.
    layout = F.sort_array(F.transform(
        F.col("columns"), lambda x, i: F.struct(_is_partition(x["is_partition"]).alias("is_partition"), i.alias("position"))))
    entry = F.col("columns")[F.col("c.position")]
    return (_lists(good)
            .select("db", "table", "columns", F.posexplode(layout).alias("layout_position", "c"))
            .select("db", "table", F.col("c.position").alias("position"), "layout_position",
                    entry["name"].alias("name"), entry["type"].alias("type"), entry["comment"].alias("comment"), "c.is_partition"))


def _params(good: DataFrame) -> DataFrame:
    """D3: parameters with the last value of each duplicate key. Entries are sorted by key, then by
    position descending, so the first entry of each key run is its last occurrence."""
    ranked = F.sort_array(F.transform(
        F.col("doc.table_params"),
        lambda x, i: F.struct(x["param_key"].alias("k"), (-i).alias("neg_pos"), x["param_value"].alias("v")),
    ))
    withranked = good.select("db", "table", ranked.alias("ranked"))
    kept = F.filter(F.col("ranked"), lambda e, j: (j == 0) | ~F.element_at(F.col("ranked"), j)["k"].eqNullSafe(e["k"]))
    return (withranked.select("db", "table", F.explode(kept).alias("p"))
            .select("db", "table", F.col("p.k").alias("param_key"), F.col("p.v").alias("param_value")))


def _storage(good: DataFrame) -> DataFrame:
    """Last serde entry (none: empty strings); first type entry (list absent or its first
    entry null: empty strings)."""
    serde = F.try_element_at(F.col("doc.serde_info"), F.lit(-1))
    has_serde = F.size(F.col("doc.serde_info")) > 0
    type_info = F.try_element_at(F.col("doc.type_info"), F.lit(1))
    has_type = type_info.isNotNull()
    return good.select(
        "db", "table",
        F.when(has_serde, serde["serde_input"]).otherwise(F.lit("")).alias("serde_input"),
        F.when(has_serde, serde["serde_output"]).otherwise(F.lit("")).alias("serde_output"),
        F.when(has_type, type_info["table_type"]).otherwise(F.lit("")).alias("table_type"),
        F.when(has_type, type_info["view_expanded_text"]).otherwise(F.lit("")).alias("view_expanded_text"),
    )
