"""Schema containment over column inventories (V2, V3).

An inventory is a DataFrame with one row per column of a table: ``pair_id, name, type, comment``
(other columns such as ``is_partition`` are ignored: a column's role does not matter). For each
pair, the target is contained in the source when every target column equals some source column;
by default equality is the whole field, name and type and comment, with two unset comments equal.
A pair with no rows on one side is invalid.

Plan, for many pairs at once: both inventories are tagged and put together; one groupBy on the pair and
the field says which sides have it (aggregated in every task before the shuffle), and one on the pair
adds that up. There is no join on column keys and no sort, and grouping takes unset values as equal.
Keys include the column name, so a pair holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_containment(
    source: DataFrame,
    target: DataFrame,
    pairs: DataFrame | None = None,
    *,
    strict: bool = True,
) -> DataFrame:
    """One row per pair: ``pair_id``, ``valid`` (target contained in source, both sides present),
    ``missing_columns`` (distinct target columns without an equal source column).

    ``pairs`` (a DataFrame with ``pair_id``) lists the pairs to report; a listed pair with no
    inventory rows is invalid. Without it, every pair seen on either side is reported.
    """
    keys = ["pair_id", "name", "type", "comment"] if strict else ["pair_id", "name"]
    both = (source.select(*keys, F.lit(True).alias("_s"), F.lit(False).alias("_t"))
            .unionByName(target.select(*keys, F.lit(False).alias("_s"), F.lit(True).alias("_t"))))
    fields = both.groupBy(*keys).agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    per_pair = fields.groupBy("pair_id").agg(
        F.max("_s").alias("src"), F.max("_t").alias("tgt"), F.count_if(F.col("_t") & ~F.col("_s")).alias("miss"))
    if pairs is not None:
        per_pair = pairs.select("pair_id").distinct().join(per_pair, "pair_id", "left")
    missing = F.coalesce(F.col("miss"), F.lit(0)).cast("bigint")
    return per_pair.select(
        "pair_id",
        (F.coalesce("src", F.lit(False)) & F.coalesce("tgt", F.lit(False)) & (missing == 0)).alias("valid"),
        missing.alias("missing_columns"),
    )


def layout_inventory(spark, tables: dict) -> DataFrame:
    """Column inventory of catalog or path tables: ``{pair_id: table}`` -> rows of
    ``pair_id, name, type, comment, is_partition``. Only column metadata (a few fields per table)
    passes through the driver."""
    from pyspark.sql import types as T

    from ..sources.tables import comment_of, layout_of

    rows = []
    for pair_id, table in tables.items():
        layout = layout_of(spark, table)
        for f in layout.data.fields:
            rows.append((pair_id, f.name, f.dataType.simpleString(), comment_of(f), 0))
        for f in layout.partitions.fields:
            rows.append((pair_id, f.name, f.dataType.simpleString(), comment_of(f), 1))
    schema = T.StructType([
        T.StructField("pair_id", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()), T.StructField("comment", T.StringType()),
        T.StructField("is_partition", T.IntegerType()),
    ])
    return spark.createDataFrame(rows, schema)
