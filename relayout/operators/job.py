"""The relayout job (J1, J2): copy the rows of a partitioned source table that match a predicate set
into a target table partitioned on other columns, overwriting just the target partitions that
receive rows.

    source scan -> filter (P1-P4) -> all columns by name (C1) -> target columns by name (C2, C3)
      -> cast to target types (W4) -> rows dealt by target partition -> dynamic overwrite (W1-W3)

It is one lazy DataFrame chain and one write action. Nothing is cached between extract and load, so
Catalyst folds the two projections into the scan: only the target's columns are read, and the
predicate reaches the scan as partition filters (other folders are not read) and pushed filters.

Semantics worth knowing:

* Only target partitions that receive rows are replaced; all others stay (dynamic overwrite). A
  touched target partition is replaced *whole*: rows it held from source partitions outside the
  predicate are gone afterwards. That is the meaning of the original statement; callers that
  reload one source partition into a target partitioned otherwise should know it.
* Columns are matched by name, never by position, so a target whose physical column order is not
  alphabetical gets the right values; the same holds for fields of structs.
* A target column the source lacks is an error (checked before any row is read), as is a target
  without partition columns. An empty extract changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import equalities
from ..plans.distribution import SIZED, distribute_for_write
from ..session import scratch_path
from ..sources.tables import Layout, PathTable, Table, comment_of, layout_of, qualified, quote, read_table


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def missing_columns(source: Layout, target: Layout, strict: bool = False) -> list[str]:
    """Target columns not found among all source columns (V2 for one pair, on column metadata).

    By default a column matches by name. ``strict=True`` is the whole-field rule: name, type and
    comment must all be equal (two unset comments are equal). Role (data or partition) is ignored.
    """
    if strict:
        have = {(f.name, f.dataType.simpleString(), comment_of(f)) for f in source.fields}
        return [f.name for f in target.fields
                if (f.name, f.dataType.simpleString(), comment_of(f)) not in have]
    have_names = set(source.names)
    return [n for n in target.names if n not in have_names]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog tells about a table beside its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r["col_name"] for r in rows]
    details = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else len(rows)
    return {r["col_name"]: r["data_type"] for r in rows[details:]}


def _location(spark: SparkSession, table: Table) -> str | None:
    """Where a table's files are, as its file system names the folder; None for a table without files."""
    path = table.path if isinstance(table, PathTable) else _described(spark, table).get("Location")
    return qualified(spark, path) if path else None


def _check_apart(spark: SparkSession, a: Table, b: Table) -> None:
    """Refuse a target that is the source, or whose folder holds the source's or lies in it. The catalog's own names
    are compared, then the folders as their file system names them."""
    if isinstance(a, str) and isinstance(b, str):
        one, two = spark.catalog.getTable(a), spark.catalog.getTable(b)
        same = (one.catalog, one.namespace, one.name.lower()) == (two.catalog, two.namespace, two.name.lower())
    else:
        same = False
    where = [_location(spark, a), _location(spark, b)]
    if same or (where[0] is not None and where[0] == where[1]):
        raise ValueError("source and target are the same table: its partitions would be overwritten while "
                         "they are read; write to another table (or materialize the source first)")
    if None not in where and any(x.startswith(y + "/") for x, y in (where, where[::-1])):
        raise ValueError(f"one table's folder lies inside the other's: {where[0]} and {where[1]}")


#: Settings without which a Hive-format table takes no dynamic partitions, and the values they have if unset.
HIVE_SETTINGS = {"hive.exec.dynamic.partition": ("true", "true"), "hive.exec.dynamic.partition.mode": ("nonstrict", "strict")}


def check_provider(table: str, provider: str | None, setting) -> None:
    """Refuse to load a Hive-format table where the session lets it take no dynamic partitions. ``setting(key, default)``
    reads the session's settings. Tables of other formats need none."""
    if (provider or "").lower() != "hive":
        return
    wrong = [f"{key}={need}" for key, (need, default) in HIVE_SETTINGS.items() if str(setting(key, default)).lower() != need]
    if wrong:
        raise ValueError(f"{table} is a Hive-format table: loading its partitions needs {' and '.join(wrong)} in the session")


def extract(spark: SparkSession, source: Table, predicates: Mapping[str, Any] | None = None,
            *, view: str | None = None, layout: Layout | None = None) -> DataFrame:
    """S1 + P1-P4 + C1: the matching source rows, every column, columns ascending by name.

    V1: with ``view``, the extract is also registered as a session temp view of that name, so SQL
    can refer to it. It stays lazy and uncached (a view name cannot carry a database prefix)."""
    df = read_table(spark, source, predicates=predicates)
    cond = equalities(predicates)
    if cond is not None:
        df = df.where(cond)
    layout = layout or layout_of(spark, source)
    df = df.select(*[quote(c) for c in layout.extract_order()])
    if view is not None:
        if "." in view:
            raise ValueError(f"temp view name {view!r} may not contain a dot")
        df.createOrReplaceTempView(view)
    return df


def conform(c: Column, have: T.DataType, want: T.DataType, path: str) -> Column:
    """``c`` as the wanted type. Fields of structs are matched by name at every depth, also inside arrays
    and maps (a plain cast would match them by position); one the value lacks is an error."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = []
        for f in want.fields:
            if f.name not in kinds:
                raise ValueError(f"nested field {path}.{f.name} is not in the extract")
            fields.append(conform(c.getField(f.name), kinds[f.name], f.dataType, f"{path}.{f.name}").alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: conform(x, have.elementType, want.elementType, f"{path}[]"))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        if have.keyType != want.keyType:
            c = F.transform_keys(c, lambda k, _: conform(k, have.keyType, want.keyType, f"{path}.key"))
        if have.valueType != want.valueType:
            c = F.transform_values(c, lambda _, v: conform(v, have.valueType, want.valueType, f"{path}.value"))
        return c
    return c.cast(want)


def project_for_target(df: DataFrame, target: Layout) -> DataFrame:
    """C2 + C3 + W4: the target's columns picked by name, in load order, cast to target types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in target.load_order():
        if name not in have:
            raise ValueError(f"target column {name!r} is not in the extract")
        cols.append(conform(F.col(quote(name)), have[name], target.field(name).dataType, name).alias(name))
    return df.select(*cols)


def converts(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether :func:`conform` can convert the value: null can, as can one whose every part can."""
    if have == want:
        return F.lit(True)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        parts = [converts(c.getField(f.name), kinds[f.name], f.dataType) for f in want.fields if f.name in kinds]
        return c.isNull() | reduce(and_, parts, F.lit(True))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return c.isNull() | F.forall(c, lambda x: converts(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return c.isNull() | (F.forall(F.map_keys(c), lambda x: converts(x, have.keyType, want.keyType))
                             & F.forall(F.map_values(c), lambda x: converts(x, have.valueType, want.valueType)))
    return c.isNull() | c.try_cast(want).isNotNull()


def split_rejected(extracted: DataFrame, target: Layout) -> tuple[DataFrame, DataFrame]:
    """The rows of the extract that convert to the target's types, and those that do not, with the names of the columns
    at fault (``rejected_columns``). The extract is read once: it is written to the shared scratch folder in two parts, and
    each is read back from its own."""
    have = {f.name: f.dataType for f in extracted.schema.fields}
    wrong = F.array_compact(F.array(*[
        F.when(~converts(F.col(quote(n)), have[n], target.field(n).dataType), F.lit(n)) for n in target.load_order() if n in have]))
    names = [n for n in target.load_order() if n in have]
    marked = extracted.select(F.struct(*[quote(n) for n in names]).alias("row"), wrong.alias("rejected_columns"))
    path = scratch_path(extracted.sparkSession, "extract")
    marked.withColumn("ok", F.size("rejected_columns") == 0).write.partitionBy("ok").parquet(path)
    staged = extracted.sparkSession.read.schema(T.StructType([*marked.schema.fields, T.StructField("ok", T.BooleanType())])).parquet(path)
    return (staged.where("ok").select("row.*"),
            staged.where("not ok").select("row.*", "rejected_columns"))


def write_session(spark: SparkSession, target: Table) -> SparkSession:
    """The session to load ``target`` in. A catalog table follows the session's overwrite mode only, so it
    gets a session of its own with dynamic overwrite: same catalog, settings and current database, and
    the caller's session, where other threads may write, is left as it is."""
    if isinstance(target, PathTable) or spark.conf.get(OVERWRITE_MODE).lower() == "dynamic":
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(OVERWRITE_MODE, "dynamic")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def write_partitions(df: DataFrame, target: Table, partition_names: list[str]) -> None:
    """Overwrite just the target partitions present in ``df``. For a catalog table ``df`` has to come
    from a session with dynamic overwrite (:func:`write_session`)."""
    if isinstance(target, PathTable):
        (df.write.format(target.format)
           .mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_names)
           .save(target.path))
        return
    spark = df.sparkSession
    if spark.conf.get(OVERWRITE_MODE).lower() != "dynamic":
        raise ValueError(f"{OVERWRITE_MODE} is not dynamic in this session: all of {target} would be replaced; "
                         "build the rows in write_session(spark, target)")
    check_provider(target, _described(spark, target).get("Provider"), spark.conf.get)
    # insertInto is positional: order by the table's physical columns, values already by name.
    physical = spark.table(target).columns
    df.select(*[quote(c) for c in physical]).write.mode("overwrite").insertInto(target)


def load(
    spark: SparkSession,
    extracted: DataFrame,
    target: Table,
    *,
    distribution: str = SIZED,
    layout: Layout | None = None,
) -> None:
    """C2 -> W4 -> rebalance -> W1: write the extract into the target's partitions."""
    layout = layout or layout_of(spark, target)
    frame = load_frame(spark, extracted, target, distribution=distribution, layout=layout)
    write_partitions(frame, target, layout.partition_names)


def load_frame(spark: SparkSession, extracted: DataFrame, target: Table, *, distribution: str = SIZED,
               layout: Layout | None = None) -> DataFrame:
    """The rows exactly as they are handed to the writer (for inspecting the plan)."""
    layout = layout or layout_of(spark, target)
    if not layout.partition_names:
        raise ValueError("the target has no partition columns; a dynamic partition overwrite needs at least one")
    out = project_for_target(extracted, layout)
    return distribute_for_write(out, layout.partition_names, distribution)


def relayout(
    spark: SparkSession,
    source: Table,
    target: Table,
    predicates: Mapping[str, Any] | None = None,
    *,
    strict: bool = False,
    distribution: str = SIZED,
    view: str | None = None,
    reread: bool = True,
    rejects: str | None = None,
) -> DataFrame | None:
    """Extract the matching rows of ``source`` (a table, or a view of this session) and load them into ``target``.

    A value that does not convert to the target's type fails the load (under ANSI), unless ``rejects`` names a new folder:
    then rows with such values are written there, as they were extracted and with the names of the columns
    (``rejected_columns``), and all others are loaded.

    Checks before reading any row that every target column exists in the source (by name, or by
    name, type and comment with ``strict=True``) and that the target is partitioned. Returns the
    target table re-read, or None with ``reread=False``: building a DataFrame over a path table
    lists all of its files at once, which a caller that does not use the result should not pay for
    on a large target.
    """
    _check_apart(spark, source, target)
    if isinstance(target, str):
        check_provider(target, _described(spark, target).get("Provider"), spark.conf.get)
    src, tgt = layout_of(spark, source), layout_of(spark, target)
    if not tgt.partition_names:
        raise ValueError("the target has no partition columns; a dynamic partition overwrite needs at least one")
    missing = missing_columns(src, tgt, strict=strict)
    if missing:
        raise ValueError(f"target columns not in the source: {missing}")
    extracted = extract(spark, source, predicates, view=view, layout=src)
    if rejects is not None:
        extracted, refused = split_rejected(extracted, tgt)
        refused.write.mode("errorifexists").parquet(rejects)
    writer = write_session(spark, target)
    if writer is spark:
        load(spark, extracted, target, distribution=distribution, layout=tgt)
    else:
        # the extract's own plan is handed over, so that views and functions of this session stay what they are
        handed = f"relayout_{uuid.uuid4().hex[:12]}"
        extracted.createGlobalTempView(handed)
        try:
            load(writer, writer.table(f"{writer.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{handed}"), target,
                 distribution=distribution, layout=tgt)
        finally:
            spark.catalog.dropGlobalTempView(handed)
        spark.catalog.refreshTable(target)  # this session did not see the write
    if not reread:
        return None
    return read_table(spark, target, must_exist=False)
