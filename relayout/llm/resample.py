"""Operator 2, quality by importance resampling over hashed n-grams.

Two generative models, of the target text (labelled good) and of the raw text (all documents), are
bags of hashed word unigrams and bigrams: a probability per bucket. A document's importance is the
log ratio of its probability under the two, and a sample is drawn without replacement by Gumbel
top-k: the ``k`` rows with the largest log importance plus Gumbel noise. The noise comes from a seeded
hash of the id, so reruns agree.

* Raw counts cover all documents; target counts cover a bounded sample of the good rows (``SAMPLE``).
  Every task adds up its own counts; only ``BUCKETS`` sums reach the driver.
* The k-th largest key is found by narrowing a range of keys with counts over the staged keys (a few
  numbers per round reach the driver); no global sort, no row at the driver.

Defined results: a null or empty text has no n-grams and log importance 0; equal keys are taken by id;
rows that agree in id and key share one decision, so a repeated row can make the sample larger than k;
without target rows all importances are 0 (a uniform sample). Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_batches, map_batches, mix, pieces, stage, text_bytes, word_hashes

BUCKETS = 1 << 14
SAMPLE = 40_000
#: Part of the documents that is kept.
SHARE = 0.87
SEED = 17
TEMPERATURE = 1.0


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and bigrams of every text, and the text each belongs to."""
    h, counts = word_hashes(data, offsets)
    text = np.repeat(np.arange(len(counts)), counts)
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    same = text[:-1] == text[1:] if len(text) else np.zeros(0, bool)
    bucket = np.concatenate([h, pair[same]]) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([text, text[1:][same]])


def _counting():
    total = np.zeros((2, BUCKETS), np.int64)

    def add(batch):
        data, offsets = text_bytes(batch.column(0))
        good = np.array(batch.column(1).to_pylist(), bool)
        for i, j in pieces(offsets):
            bucket, text = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            total[1] += np.bincount(bucket[good[i:j][text]], minlength=BUCKETS)

    def finish():
        return pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS), pa.int32()), pa.array(total[0]), pa.array(total[1])],
                                          names=["bucket", "raw", "target"])

    return add, finish


def log_ratios(documents: DataFrame, good: DataFrame, *, id_col="doc_id", text_col="text", sample=SAMPLE) -> np.ndarray:
    """Per bucket, the log of its target probability over its raw probability. ``good`` has the ids of
    target rows, of which at most ``sample`` are used, the first by a hash."""
    ids = (good.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
           .orderBy(F.xxhash64("_id"), "_id").limit(sample).withColumn("_good", F.lit(True)))
    marked = (documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
              .join(F.broadcast(ids), "_id", "left").select("_text", F.coalesce("_good", F.lit(False)).alias("_good")))
    sums = (fold_batches(marked, _counting, "bucket int, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _weighing(ratios: np.ndarray):
    def make():
        def work(batch):
            data, offsets = text_bytes(batch.column("_text"))
            weight = np.zeros(batch.num_rows)
            for i, j in pieces(offsets):
                bucket, text = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                weight[i:j] = np.bincount(text, ratios[bucket], j - i)
            return pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(weight)], names=["_id", "log_weight"])

        return work

    return make


def weigh(documents: DataFrame, ratios: np.ndarray, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``id, log_weight`` of every row: the sum of the log ratios of its n-grams."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    return map_batches(narrow, _weighing(ratios), f"_id {kind}, log_weight double").withColumnRenamed("_id", id_col)


def kth_largest(keys: DataFrame, col: str, k: int, bins: int = 1024) -> float:
    """The ``k``-th largest value of a double column: counts per bin of a range, then the range is the
    bin that holds it, until a bin is a single value. A range shrinks a thousandfold a round."""
    r = keys.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    if not r["n"]:
        return math.inf
    lo, hi, k = r["lo"], r["hi"], min(max(k, 1), r["n"])
    while lo < hi:
        width = (hi - lo) / bins
        inside = keys.where((F.col(col) >= lo) & (F.col(col) <= hi))
        number = F.least(F.floor((F.col(col) - lo) / F.lit(width)), F.lit(bins - 1)) if width else F.lit(0)
        found = (inside.groupBy(number.alias("bin"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect())
        for b in sorted(found, key=lambda b: -b["bin"]):
            if k <= b["n"]:
                if (b["lo"], b["hi"]) == (lo, hi):  # values too near for bins: take off the largest
                    top = inside.where(F.col(col) == hi).count()
                    lo, hi, k = (hi, hi, k) if k <= top else (lo, math.nextafter(hi, -math.inf), k - top)
                else:
                    lo, hi = b["lo"], b["hi"]
                break
            k -= b["n"]
    return lo


def gumbel_top_k(weighted: DataFrame, k: int, *, id_col="doc_id", seed=SEED, temperature=TEMPERATURE) -> DataFrame:
    """Adds ``key`` and ``kept``; stages its input."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), 11).cast("double")
    uniform = (bits + 0.5) / float(1 << 53)
    keyed = stage(weighted.withColumn("key", F.col("log_weight") / temperature - F.log(-F.log(uniform))), "gumbel_keys")
    limit = kth_largest(keyed, "key", k)
    return keyed.withColumn("kept", F.col("key") >= limit)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the documents sampled to look like those labelled good."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    weighted = weigh(documents, log_ratios(documents, good))
    k = math.ceil(SHARE * documents.count())
    return gumbel_top_k(weighted, k)
