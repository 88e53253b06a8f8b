"""Operator 5, mixing sources to target weights [native].

Target: ``SHARE`` of all words, dealt to the sources by weight. A source stops at ``EPOCHS`` times its
size; what it cannot take is dealt to the others by weight until nobody is above (capped water-filling).
The level, words per unit of weight, rises to its fixed point: each round adds up, over the table of
sources, the caps of those below the level and the weights of the others, and two sums reach the driver.

Repetitions: with target = (whole + part) * size of the source, every document is repeated ``whole`` times,
and one more, seeded, fractional repetition takes ``part`` of the source: documents in the order of a
seeded hash of their id, until the words are reached; the last one is taken for as many words as are
missing. A source with many documents does this in groups of about ``GROUP`` documents (by the same hash),
each for its share, so that no task ever holds a whole source.

Sources are ranked by code point over a range-partitioned table: ranks within a partition plus the
sizes of the partitions before. Documents get their source's numbers by ``common.lookup`` (hot sources by
broadcast).

Defined results: null is a source of its own, the last; null texts have size 0; sources of size 0 get
target 0; rows with equal ids in a source are ordered by size and take part each; a null id counts as
empty text in the hash. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, lookup, stage

WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
GROUP, SEED = 4096, "mix"


def sized(documents: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", seed=SEED) -> DataFrame:
    """``id, th, src, none, size, order`` of every row: hashes of the text, and seeded of the id."""
    return documents.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("none"),
        F.coalesce(F.regexp_count(text_col, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("order"))


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 by code point, null last."""
    dealt = stage(sources.repartitionByRange("none", "src").withColumn("part", F.spark_partition_id()), "sources")
    # one row per partition, not per source
    before = (dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    place = F.row_number().over(Window.partitionBy("part").orderBy("none", "src")) - 1
    return dealt.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + place).drop("part", "before")


def water_level(sources: DataFrame, total: float) -> float:
    """Words per unit of weight at which min(cap, weight * level) adds up to ``total``."""
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= F.col("cap")
        r = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)).alias("caps"),
                        F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weights")).first()
        if not r["weights"]:
            return level or 0.0
        new = (total - r["caps"]) / r["weights"]
        if level is not None and new <= level:
            return level
        level = new


def targets(rows: DataFrame, *, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """``src, none, source_size, docs, target`` per source."""
    sums = rows.groupBy("src", "none").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank"), F.lit(len(weights))).cast("int"))
    sources = stage(ranked(sums).withColumn("weight", weight)
                    .withColumn("cap", F.col("source_size").cast("double") * epochs), "ranked_sources")
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, total)
    return sources.select("src", "none", "source_size", "docs",
                          F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def mix(documents: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE,
        epochs=EPOCHS, seed=SEED, group=GROUP) -> DataFrame:
    """Per row ``id, size, source_size, target, taken, whole, part, text_hash``: words taken, as whole
    repetitions and words of one more."""
    rows = stage(sized(documents, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed), "sizes")
    joined = lookup(rows, targets(rows, weights=weights, share=share, epochs=epochs), ["src", "none"], "docs")
    number = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    grouped = (joined.withColumn("group", number % F.greatest(F.lit(1), F.floor(F.col("docs") / group)))
               .withColumn("whole", F.floor(F.col("target") / size)))
    of_group = Window.partitionBy("src", "none", "group")
    upto = of_group.orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = (F.col("target") - F.col("whole") * F.col("source_size")) / size
    wanted = F.floor(rest * F.sum("size").over(of_group) + 0.5)
    part = F.greatest(F.lit(0), F.least(F.col("size"), wanted - (F.sum("size").over(upto) - F.col("size")))).cast("long")
    out = grouped.withColumn("part", part)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part",
                      F.col("th").alias("text_hash"))


def repeated(documents: DataFrame, *, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns; texts stay whole, so a
    last repetition of half the words or more counts as one, and of less as none."""
    taken = mix(documents, id_col=id_col, text_col=text_col, **how)
    times = F.col("whole") + (2 * F.col("part") >= F.greatest(F.col("size"), F.lit(1))).cast("long")
    # rows that agree in id and text share their repetitions evenly
    sums = (taken.groupBy(F.col(id_col).alias("_kid"), F.col("text_hash").alias("_kth"))
            .agg(F.sum(times).alias("times"), F.count(F.lit(1)).alias("rows")))
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"))
    joined = packed.join(sums.where("times > 0"), F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")))
    number = F.row_number().over(Window.partitionBy("_id", "_th").orderBy("times"))
    mine = F.floor((F.col("times") + F.col("rows") - F.col("n")) / F.col("rows")).cast("int")
    return (joined.withColumn("n", number).withColumn("mine", mine).where("mine > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("mine")))).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: the mix of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")


SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS none,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
sources AS (
  SELECT src, none, sum(size)::BIGINT AS source_size, count(*) AS docs,
         CASE (row_number() OVER (ORDER BY none, src) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY src, none),
steps AS (
  SELECT 2.0::DOUBLE * source_size / weight AS stop,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS lvl
  FROM sources
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, src, none ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT lvl FROM steps WHERE lvl < stop ORDER BY stop LIMIT 1),
targets AS (
  SELECT src, none, source_size, docs, least(2.0::DOUBLE * source_size, weight * lvl)::DOUBLE AS target FROM sources, level),
grouped AS (
  SELECT s.doc_id, s.size, s.ord, t.*, greatest(1, source_size) AS div,
         ('0x' || substr(ord, 1, 8))::BIGINT % greatest(1, docs // 4096) AS grp,
         floor(target / greatest(1, source_size))::BIGINT AS whole
  FROM sized s JOIN targets t ON s.src = t.src AND s.none = t.none),
taken AS (
  SELECT *, floor((target - whole * source_size) / div * (sum(size) OVER (PARTITION BY src, none, grp)) + 0.5)
            - (sum(size) OVER (PARTITION BY src, none, grp ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size) AS rest
  FROM grouped)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest)))::BIGINT AS taken,
       whole, greatest(0, least(size, rest))::BIGINT AS part
FROM taken
"""
