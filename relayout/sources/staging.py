"""Writing a DataFrame as a new partitioned path table (used to stage sources and to create
targets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tables import PathTable, quote


def path_table_for(df_schema: T.StructType, path: str, partition_by: list[str] | tuple[str, ...],
                   columns: list[str] | None = None, fmt: str = "parquet") -> PathTable:
    """A PathTable description (nothing written) with the given columns of ``df_schema``:
    data columns in the order given, then the partition columns."""
    by_name = {f.name: f for f in df_schema.fields}
    names = columns if columns is not None else [f.name for f in df_schema.fields]
    data = [by_name[n] for n in names if n not in partition_by]
    parts = [by_name[p] for p in partition_by]
    return PathTable(path, T.StructType(data + parts), tuple(partition_by), fmt)


def write_table(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...],
                fmt: str = "parquet", options: dict[str, str] | None = None) -> PathTable:
    """Write ``df`` to a fresh folder, partitioned, spread over write tasks by the partition columns
    like the job's own write (rebalance, or a deterministic salt without AQE) so each partition gets
    few, evenly sized files. ``options`` are the writer's. Returns the table description."""
    from ..plans.distribution import distribute_for_write

    table = path_table_for(df.schema, path, partition_by, fmt=fmt)
    out = distribute_for_write(df.select(*[quote(n) for n in table.schema.fieldNames()]), list(partition_by))
    out.write.format(fmt).options(**(options or {})).mode("errorifexists").partitionBy(*partition_by).save(path)
    return table


def materialize(df: DataFrame, name: str, partition_by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once below the session's shared scratch folder and read it back.

    This cuts the lineage (a new state of a table that was computed from its previous state can then
    replace it), and the copy lives on shared storage, so losing an executor loses nothing.
    """
    from ..session import scratch_path
    from .tables import read_table

    spark = df.sparkSession
    return read_table(spark, write_table(df, scratch_path(spark, name), partition_by))


_WRITTEN: dict = {}


def written_once(spark, key: tuple, build, name: str, partition_by: list[str] | tuple[str, ...] = (),
                 options: dict[str, str] | None = None) -> PathTable:
    """The table ``build()`` describes, written below the shared scratch folder the first time it is
    asked for in this application and reused afterwards (input tables of the registered queries:
    staged sources, generated documents). Rebuilt if its folder has gone."""
    from ..session import scratch_path
    from .tables import _path_exists

    k = (spark.sparkContext.applicationId, key)
    table = _WRITTEN.get(k)
    if table is None or not _path_exists(spark, table.path):
        table = write_table(build(), scratch_path(spark, name), partition_by, options=options)
        _WRITTEN[k] = table
    return table
