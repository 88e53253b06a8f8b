"""Tables and their layouts.

A table is either a catalog name (``"db.t"``) or a :class:`PathTable`: a folder of files with an
explicit schema and partition columns. The explicit schema matters: a path read would otherwise
infer partition types (a string ``'2024-01-02'`` comes back as a date).
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any, Union

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PathTable:
    """A partitioned table stored as files below ``path``.

    ``schema`` holds every column, data and partition alike; ``partition_by`` names the partition
    columns in their declared (directory nesting) order.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    format: str = "parquet"

    def __post_init__(self) -> None:
        object.__setattr__(self, "partition_by", tuple(self.partition_by))
        missing = [p for p in self.partition_by if p not in self.schema.fieldNames()]
        if missing:
            raise ValueError(f"partition columns {missing} are not in the schema of {self.path}")


Table = Union[str, PathTable]


@dataclass(frozen=True)
class Layout:
    """A table's columns split by role: data columns in schema order, partition columns in
    declared order."""

    data: T.StructType
    partitions: T.StructType

    @property
    def fields(self) -> list[T.StructField]:
        return list(self.data.fields) + list(self.partitions.fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def partition_names(self) -> list[str]:
        return [f.name for f in self.partitions.fields]

    @property
    def data_names(self) -> list[str]:
        return [f.name for f in self.data.fields]

    def field(self, name: str) -> T.StructField:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def extract_order(self) -> list[str]:
        """Every column, data and partition together, ascending by name (case-sensitive)."""
        return sorted(self.names)

    def load_order(self) -> list[str]:
        """Data columns ascending by name, then partition columns in declared order."""
        return sorted(self.data_names) + self.partition_names


def path_table(layout: Layout, path: str, fmt: str = "parquet") -> PathTable:
    """The table of a layout, stored below ``path``."""
    return PathTable(path, T.StructType(layout.fields), tuple(layout.partition_names), fmt)


def comment_of(field: T.StructField) -> str | None:
    return (field.metadata or {}).get("comment")


def layout_of(spark: SparkSession, table: Table) -> Layout:
    """Split a table's columns into data and partition columns, keeping types and comments."""
    if isinstance(table, PathTable):
        parts = set(table.partition_by)
        data = [f for f in table.schema.fields if f.name not in parts]
        by_name = {f.name: f for f in table.schema.fields}
        return Layout(T.StructType(data), T.StructType([by_name[p] for p in table.partition_by]))
    schema = spark.table(table).schema
    types = {f.name: f for f in schema.fields}
    data, partitions = [], []
    for c in spark.catalog.listColumns(table):
        f = types[c.name]
        meta = dict(f.metadata or {})
        if c.description is not None:
            meta["comment"] = c.description
        field = T.StructField(c.name, f.dataType, f.nullable, meta)
        (partitions if c.isPartition else data).append(field)
    return Layout(T.StructType(data), T.StructType(partitions))


def file_system(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = file_system(spark, path)
    return bool(fs.exists(hpath))


def qualified(spark: SparkSession, path: str) -> str:
    """The one name of a path: scheme, authority and no trailing slash, as its file system gives it."""
    hpath, fs = file_system(spark, path)
    return str(fs.makeQualified(hpath).toString()).rstrip("/")


#: Folders that are looked into one by one; below more of them Spark lists what is left, in parallel.
MAX_LISTED = 200
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The paths of the partition folders (``name=value``) right below a folder."""
    hpath, fs = file_system(spark, path)
    paths = [str(status.getPath().toString()) for status in fs.listStatus(hpath)]
    return [p for p in paths if p.rsplit("/", 1)[1][0] not in "._"]


def folder_value(path: str) -> tuple[str, str | None]:
    """Column and value that a partition folder's name tells, unescaped (the null folder's value is None)."""
    name, _, value = path.rsplit("/", 1)[1].partition("=")
    plain = lambda x: re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), x)
    return plain(name), None if value == NULL_FOLDER else plain(value)


def matching_folders(spark: SparkSession, table: PathTable, predicates: Mapping[str, Any] | None) -> list[str] | None:
    """The partition folders of a path table that the predicates select; None if they do not narrow it.

    The folders' names are a partition index: they are listed level by level, read as values, cast to the declared
    type and compared by the very filter that the scan applies; the next level is listed below the matching
    ones only. The listing ends at the last level with a predicate, and where more than ``MAX_LISTED`` folders would
    have to be looked into. Folders that are named otherwise end it, too: then Spark lists everything."""
    from ..functions.predicates import equalities

    wanted = [i for i, c in enumerate(table.partition_by) if c in (predicates or {})]
    if not wanted or not _path_exists(spark, table.path):
        return None
    found, all_of_them = [table.path], True
    for column in table.partition_by[:wanted[-1] + 1]:
        if len(found) > MAX_LISTED:
            break
        below = [p for folder in found for p in subfolders(spark, folder)]
        values = [folder_value(p) for p in below]
        if any(name.lower() != column.lower() for name, _ in values):
            return None
        if column in predicates and below:
            typed = F.col("value").try_cast(table.schema[column].dataType).alias(column)
            rows = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(values)], "_place int, value string").select("_place", typed)
            try:
                kept = sorted(r["_place"] for r in rows.where(equalities({column: predicates[column]})).select("_place").collect())
            except AnalysisException:  # a value that is told by other columns
                kept = list(range(len(below)))
            all_of_them = all_of_them and len(kept) == len(below)
            below = [below[i] for i in kept]
        found = below
    return None if all_of_them else found


def read_table(spark: SparkSession, table: Table, *, must_exist: bool = True, predicates: Mapping[str, Any] | None = None) -> DataFrame:
    """A lazy scan of the table, columns in schema order. Filters and projections applied on
    top reach the scan as partition filters, pushed filters and a pruned read schema.

    With ``predicates`` (which the caller filters by, too), only the folders of a path table that they select are listed
    when the scan is built (:func:`matching_folders`); values are compared by type, so every spelling that equals
    one finds its rows. A folder that does not exist is an error, unless ``must_exist`` is False (a target nothing was
    loaded into): then the table is empty."""
    if not isinstance(table, PathTable):
        return spark.table(table)
    if not must_exist and not _path_exists(spark, table.path):
        return spark.createDataFrame([], table.schema)
    folders = matching_folders(spark, table, predicates)
    if folders == []:
        return spark.createDataFrame([], table.schema).select(*[quote(n) for n in table.schema.fieldNames()])
    df = (
        spark.read.schema(table.schema)
        .option("basePath", table.path)
        .format(table.format)
        .load(table.path if folders is None else folders)
    )
    return df.select(*[quote(n) for n in table.schema.fieldNames()])


def quote(name: str) -> str:
    """A column reference that takes the name literally (dots, spaces, backticks)."""
    return "`" + name.replace("`", "``") + "`"
