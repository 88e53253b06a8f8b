"""Table names of a database, all or by pattern (N1-N4), over a name inventory.

A name inventory is a DataFrame with ``db`` and ``table`` columns (the catalog's
``listTables`` output, or any table list). Both are filters: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import folded, full_match, glob_match


def all_tables(names: DataFrame, db: str) -> DataFrame:
    """N1 + N4: every table of ``db``; the database is matched case-insensitively."""
    return names.where(folded(F.col("db")) == F.lit(db.lower()))


def tables_matching(names: DataFrame, db: str, pattern: str) -> DataFrame:
    """The tables of ``db`` whose whole name matches the regex ``pattern`` (case-sensitive)."""
    return all_tables(names, db).where(full_match(F.col("table"), pattern))


def catalog_names(spark: SparkSession, db: str, pattern: str | None = None) -> DataFrame:
    """The session catalog's own listing (its pattern is a glob, lower-cased as the service
    lower-cases it), as a name inventory."""
    listed = spark.catalog.listTables(db, pattern.lower() if pattern else None)
    return spark.createDataFrame([(db, t.name) for t in listed], "db string, table string")


def names_like(names: DataFrame, pattern: str) -> DataFrame:
    """N3 over an inventory: the tables, of all databases, that the catalog's listing by ``pattern`` would give. A
    filter, for inventories that no catalog listing on the driver should hold."""
    return names.where(glob_match(F.col("table"), pattern))
