"""Operator 9, host-level quality rules.

1. Every document is measured and tested against the rules below (one pass over the texts).
2. Per host, the share of documents that fail some rule. A host with few documents says little, so
   shares are shrunk: an empirical beta prior is fitted to all hosts by moments, and a host's rate is
   the posterior mean (failures + a) / (documents + a + b).
3. A host whose rate is over ``max_rate`` is condemned; the verdict is joined back to its documents.
   A document is kept if it does not fail a base rule, fails fewer than ``max_failures`` rules itself
   and its host is not condemned.

The measures are staged in the shared folder (a narrow table), since both the aggregation and the
join read them. Host counts are added up in every task before the shuffle; the join back broadcasts
the few hosts that hold over a thousandth of all documents and shuffles the others (``lookup``).

Defined results: null and empty texts have no words, so they fail; a null host is a host of its own;
repeated rows count each; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, map_batches, stage

MIN_WORDS, MAX_REPEAT, MAX_SYMBOLS, MAX_DUP_LINES = 50, 50, 10, 50
WORD_LENGTH = (2, 15)
MAX_RATE, MAX_FAILURES = 0.6, 2
SYMBOLS = "#*$%&|<>"
RULES = ("too_short", "repetition", "symbols", "duplicate_lines", "word_length")


def _repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    k = len(numbers)
    if k == n:
        return 0
    pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * k + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:shift + n - 2] |= twice
    return int(inside.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (those with a word)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(data.count(c) for c in SYMBOLS.encode())
    lines = [x for x in data.split(b"\n") if x.split(None, 1)] if b"\n" in data else [data] if words else []
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated_words(words), len(lines)


def _measuring():
    def work(batch):
        out = np.array([measures(t) for t in batch.column("_text").to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_host"), *(pa.array(np.ascontiguousarray(out[:, k])) for k in range(6))],
            names=["_id", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"])

    return work


def measure(documents: DataFrame, *, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                              F.col(host_col).cast("string").alias("_host"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = map_batches(narrow, _measuring, f"_id {kind}, _host string, n_words long, word_chars long, "
                                          "n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    n = F.col("n_words")
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    failed = [n < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEAT * n,
              100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"), 100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
              (mean < WORD_LENGTH[0]) | (mean > WORD_LENGTH[1])]
    return (out.withColumn("base_failed", failed[0] | failed[1])
            .withColumn("failed_rules", F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in zip(RULES, failed, strict=True)]))))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """a, b of a beta distribution with the mean and, as far as sampling does not explain it, the
    variance of the hosts' failure shares, weighted by documents. Four sums reach the driver."""
    r = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("x"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("xx"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("nn")).first()
    n = float(r["n"] or 0)
    if not n:
        return 1.0, 1.0
    mean = min(max(r["x"] / n, 0.5 / n), 1 - 0.5 / n)
    between = r["xx"] - n * mean * mean  # weighted sum of squares
    spread = n - r["nn"] / n
    excess = (between - (r["k"] - 1) * mean * (1 - mean)) / spread if spread > 0 else 0.0
    rho = min(max(excess / (mean * (1 - mean)), 1e-4), 0.5)
    strength = 1 / rho - 1
    return mean * strength, (1 - mean) * strength


def judge(measured: DataFrame, *, max_rate: float = MAX_RATE, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Adds ``host_docs, host_rate, host_kept, kept`` to measured documents (read twice: stage them)."""
    keyed = measured.withColumn("_h", F.coalesce("_host", F.lit(""))).withColumn("_none", F.col("_host").isNull())
    some = (F.size("failed_rules") > 0).cast("long")
    hosts = keyed.groupBy("_h", "_none").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(some).alias("n_failed"))
    a, b = beta_prior(hosts)
    rated = hosts.select("_h", "_none", F.col("n_docs").alias("host_docs"),
                         ((F.col("n_failed") + a) / (F.col("n_docs") + a + b)).alias("host_rate"))
    joined = lookup(keyed, rated, ["_h", "_none"], "host_docs")
    host_kept = F.col("host_rate") <= max_rate
    return (joined.withColumn("host_kept", host_kept)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") < max_failures) & F.col("host_kept"))
            .drop("_h", "_none"))


def host_rules(documents: DataFrame, *, id_col="doc_id", text_col="text", host_col="source", **limits) -> DataFrame:
    measured = stage(measure(documents, id_col=id_col, text_col=text_col, host_col=host_col), "host_measures")
    return judge(measured, **limits).withColumnRenamed("_id", id_col).withColumnRenamed("_host", "host")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: measures and verdict of every document."""
    out = host_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "host", "host_rate", F.concat_ws(",", "failed_rules").alias("failed_rules"))
