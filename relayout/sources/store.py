"""Keyed tables kept in an order that batch operators can use: bucketed by key, or partitioned by expiry.

*Bucketed stores.* ``write_bucketed`` writes a catalog table in a fixed number of buckets of the key's hash, one file
each, sorted by key. A join on the key then shuffles the other side only: requests and updates move to the
buckets, and the lookup and the source stay where they are, whatever the size of the batch. Two stores with the same number of
buckets meet bucket by bucket.

*Stores by expiry.* ``write_by_expiry`` partitions a path table by the day its entries expire on. An
entry lives until its instant, so on any day all earlier partitions are dead as a whole: ``compact`` removes their
folders without reading them, rewrites the one partition of the day itself, and touches no other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expiry import live
from ..operators.lookup import KEYS
from ..session import scratch_path
from .staging import materialize, write_table
from .tables import PathTable, file_system, folder_value, quote, read_table, subfolders

EXPIRES_ON = "expires_on"


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: Sequence[str] = KEYS, path: str | None = None) -> DataFrame:
    """Write ``df`` as the new catalog table ``table``, bucketed and sorted by its keys, below ``path`` (by default a
    fresh folder of the shared scratch folder); returns it. Rows are dealt by the hash that bucketing uses, so every
    bucket is one task's one file. One key's rows are one bucket's: keys are meant to be unique."""
    spark = df.sparkSession
    (df.repartition(buckets, *[F.col(quote(k)) for k in keys]).sortWithinPartitions(*[quote(k) for k in keys])
     .write.format("parquet").mode("errorifexists").option("path", path or scratch_path(spark, table))
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def write_by_expiry(lookup: DataFrame, path: str) -> PathTable:
    """Write a lookup partitioned by the day its entries expire on (null: never)."""
    return write_table(lookup.withColumn(EXPIRES_ON, F.to_date("expires_at")), path, [EXPIRES_ON])


def compact(spark: SparkSession, store: PathTable, as_of: str) -> None:
    """Remove the dead entries of a store by expiry. Partitions of earlier days go without being read; that of the
    day of ``as_of`` is rewritten with its live entries (first to the scratch folder, then over itself, so a rerun after a
    failure finds all live entries in either place); later ones, and entries that never expire, are not touched."""
    day = dt.datetime.fromisoformat(as_of).date()
    folders = {p: value for p in subfolders(spark, store.path) for name, value in [folder_value(p)] if name == EXPIRES_ON}
    kept = None
    if any(v == day.isoformat() for v in folders.values()):
        today = read_table(spark, store, predicates={EXPIRES_ON: day}).where(F.col(EXPIRES_ON) == F.lit(day))
        kept = materialize(today.where(live(F.col("expires_at"), as_of)), "live_of_day")
    for path, value in folders.items():
        if value is not None and value < day.isoformat():
            _remove(spark, path)
    if kept is None:
        return
    if kept.isEmpty():
        for path, value in folders.items():
            if value == day.isoformat():
                _remove(spark, path)
    else:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EXPIRES_ON).parquet(store.path)


def _remove(spark: SparkSession, path: str) -> None:
    hpath, fs = file_system(spark, path)
    fs.delete(hpath, True)


def entries(spark: SparkSession, store: PathTable) -> DataFrame:
    """The lookup that a store by expiry holds."""
    return read_table(spark, store, must_exist=False).drop(EXPIRES_ON)
