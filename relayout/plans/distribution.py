"""How rows are spread over write tasks before a partitioned write.

Without a shuffle, every scan task writes one file into every target partition it holds rows for:
N input tasks times M target partitions files. A rebalance on the target partition columns sends
each target partition to few tasks, and AQE splits a hot one (say a third of all rows) into
advisory-sized pieces and merges small ones, so file sizes stay even.

Merging by size knows nothing of files: hundreds of small target partitions end in one task, which then opens
and closes their files one after another. ``SIZED`` (the job's default) therefore counts the rows of every
target partition first, over the partition columns only, and sets the number of write tasks from that histogram: enough
for the rows (as many a task as the session's advisory partition size holds), and enough that no task writes more than about ``FILES_PER_TASK`` files, as far as the cluster has cores. Only
partitions with more rows than a task's share are split, each into as many parts as it needs. The driver gets
three sums, and ``HOT`` partitions to split at most. Where there are more, partitions are large throughout, and the
rebalance does well: it is used then, and also where the partitions are no more than a task's files.

When AQE is off, a plain hash repartition on the partition columns would put such a hot partition
into one task. Then the rows are salted instead: hash-partitioned on the partition columns plus a
salt taken from a hash of the row (of its columns that can be hashed: maps cannot). There are as many
salts as shuffle partitions, so a hot partition spreads over all tasks. The salt is deterministic, so a
task re-run after an executor loss routes every row exactly as the first run did (``rand()`` would not).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import quote

SIZED = "sized"
REBALANCE = "rebalance"
SALTED = "salted"
NONE = "none"

#: A write task's share of files.
FILES_PER_TASK = 24
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Counts of single partitions that the driver is given at most.
HOT = 1000


def aqe_enabled(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


@dataclass(frozen=True)
class Histogram:
    """Rows and target partitions of a frame, the rows of its largest partition, and the partitions to split: their
    values and rows (``n``), largest first, ``HOT`` at most."""

    rows: int
    partitions: int
    largest: int
    hot: list[Row]


def histogram(df: DataFrame, partition_cols: list[str], rows_per_task: int) -> Histogram:
    """A scan of the partition columns and an aggregation, combined in every task. Only if there is a partition to split
    are its like counted again, to be named."""
    counts = df.groupBy(*[F.col(quote(c)) for c in partition_cols]).agg(F.count(F.lit(1)).alias("n"))
    rows, partitions, largest = counts.agg(F.sum("n"), F.count(F.lit(1)), F.max("n")).first()
    hot = counts.where(F.col("n") > rows_per_task).orderBy(F.desc("n")).limit(HOT).collect() if (largest or 0) > rows_per_task else []
    return Histogram(rows or 0, partitions, largest or 0, hot)


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's columns that can be hashed."""
    hashable = [F.col(quote(c)) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*hashable) if hashable else F.lit(0)


def rows_per_task(df: DataFrame) -> int:
    """How many rows, by their types' usual sizes, make the advisory partition size of the session."""
    size = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        df.sparkSession.conf.get(ADVISORY, "64MB"))
    return max(1, size // (8 + df._jdf.schema().defaultSize()))


def write_tasks(found: Histogram, cores: int, rows_per_task: int, files_per_task: int = FILES_PER_TASK) -> int:
    """How many tasks are to write these partitions."""
    by_rows = -(-found.rows // rows_per_task)
    by_files = min(-(-found.partitions // files_per_task), 4 * cores)
    return max(1, by_rows, by_files)


def distribute_sized(df: DataFrame, partition_cols: list[str], *, share: int | None = None,
                     files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """``df`` dealt to a number of tasks that its histogram gives, partitions of more than ``share`` rows split."""
    share = share or rows_per_task(df)
    found = histogram(df, partition_cols, share)
    if found.partitions <= files_per_task or len(found.hot) == HOT:
        return distribute_for_write(df, partition_cols, REBALANCE)
    spark = df.sparkSession
    tasks = write_tasks(found, spark.sparkContext.defaultParallelism, share, files_per_task)
    columns = [F.col(quote(c)) for c in partition_cols]
    if not found.hot:
        return df.repartition(tasks, *columns)
    # HOT rows at most: each hot partition's values and its parts
    tag = uuid.uuid4().hex[:8]
    kinds = [T.StructField(f"_{tag}_{i}", df.schema[c].dataType) for i, c in enumerate(partition_cols)]
    split = spark.createDataFrame([(*r[:-1], -(-r["n"] // share)) for r in found.hot],
                                  T.StructType([*kinds, T.StructField(f"_{tag}_parts", T.LongType())]))
    same = reduce(and_, [c.eqNullSafe(F.col(k.name)) for c, k in zip(columns, kinds, strict=True)])
    parts = F.coalesce(F.col(f"_{tag}_parts"), F.lit(1))
    return (df.join(F.broadcast(split), same, "left").repartition(tasks, *columns, F.pmod(_row_hash(df), parts))
            .select(*[F.col(quote(c)) for c in df.columns]))


def distribute_for_write(
    df: DataFrame, partition_cols: list[str], mode: str = REBALANCE
) -> DataFrame:
    """Spread ``df`` over write tasks by the target partition columns."""
    if mode == NONE or not partition_cols:
        return df
    if mode == SIZED:
        return distribute_sized(df, partition_cols)
    if mode == REBALANCE and aqe_enabled(df):
        return df.hint("rebalance", *[quote(c) for c in partition_cols])
    if mode not in (REBALANCE, SALTED):
        raise ValueError(f"unknown distribution {mode!r}")
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(_row_hash(df), F.lit(salts))
    return df.repartition(*[F.col(quote(c)) for c in partition_cols], salt)
