"""Operator 6, approximate nearest neighbours by collision counting.

The rows are dealt out in blocks, and the vectors of a block are cut by their norms into shells (no vector
of a shell is shorter than ``SHORTEST`` of its longest). Largest inner product is turned into smallest
distance within a shell: every vector gets one more component, which brings it to the shell's largest norm R,
and a query is brought to norm R and gets 0 there, which changes no order. (With one R for all lengths that component would
rule the projections, and windows would open by length.) Each hash function is one projection on a
random direction; a shell keeps, per function, its vectors' numbers sorted by projection. A query opens
a window around its own projection in every sorted array and widens all windows together (virtual
rehashing); whenever a vector falls into a window, its collisions go up by one. Vectors with at least
``THRESHOLD`` of the windows are candidates; widening ends once a shell has its share of candidates
(``VERIFIED``, and ``LEAST`` times the wanted number at least). In high dimensions a projection tells little of
a distance: windows are wide and the threshold high, so what is counted are the vectors that a window leaves out. Candidates are verified with the original
vectors in double precision. The longest shells come first; a block is done when its ``k`` best are above the
product of the lengths of the query and of the next shell's longest vector, which nothing left can reach.

All rows are indexed, without a sample. Queries meet every block (a stated query set against all rows,
in blocks of ``BLOCK`` rows and ``QUERIES`` queries); each block gives its best ``k`` per query, and the
best of those remain. A task holds one block and one group of queries.

Defined results: vectors that are null, zero, of another length than the most frequent one, or hold null
or non-finite components take no part; rows with a null id take no part. Rows that share an id are rows of
their own, and a query leaves out those with its own id. Ties go to the smaller id. With no more than
``k`` candidates in all, all are given.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

K, EVERY = 20, 20
PROJECTIONS, THRESHOLD, VERIFIED = 64, 0.84, 0.06
#: Half the first windows' width, in units of a function's quartile distance; each widening multiplies it.
FIRST, WIDER = 0.8, 1.06
SHORTEST, LEAST = 0.8, 20
#: Distance of the projections' ranges, more than two windows' widths.
APART = 16.0
BLOCK, QUERIES = 16_384, 4_096
SEED = 5


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms of the rows (none is zero), without overflow on the way."""
    top = np.abs(vectors).max(1)
    return top * np.sqrt(((vectors / top[:, None]) ** 2).sum(1))


class Shell:
    """Sorted projections of vectors of about the same length, in units of the longest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray):
        self.ids, self.vectors, self.norms, self.longest = ids, vectors, norms, norms.max()
        self.order = None  # only large shells are indexed, when first asked

    def index(self, seed: int = SEED) -> None:
        n, d = self.vectors.shape
        more = np.sqrt(np.maximum(1 - (self.norms / self.longest) ** 2, 0))
        rng = np.random.default_rng(seed)
        # directions in groups that are orthogonal, so that functions repeat one another less
        groups = []
        while sum(g.shape[1] for g in groups) < PROJECTIONS:
            groups.append(np.linalg.qr(rng.standard_normal((d + 1, d + 1)))[0][:, :d])
        self.directions = np.concatenate(groups, 1)[:, :PROJECTIONS]
        projected = (np.concatenate([self.vectors / self.longest, more[:, None]], 1) @ self.directions).T
        order = np.argsort(projected, 1, kind="stable")
        values = np.take_along_axis(projected, order, 1)
        spread = values[:, (3 * n) // 4] - values[:, n // 4]
        self.unit = np.where(spread > 0, spread, 1.0)  # widths are told per function in units of its spread
        # all sorted arrays in one, each in a range of its own (projections are 1 at most): one search finds all windows
        self.base = APART * np.arange(PROJECTIONS)
        self.sorted, self.order = (values + self.base[:, None]).ravel(), order.ravel()
        self.first = n * np.arange(PROJECTIONS)
        # the first width: nearly what the shell's own vectors need
        asked = projected[:, :: max(1, n // 16)].T
        wide = np.sort([self.widen(at, FIRST, self.wanted(n, K))[1] for at in asked])
        self.start = wide[len(wide) // 4]

    @staticmethod
    def wanted(n: int, k: int) -> int:
        return min(n, max(LEAST * k, int(VERIFIED * n)))

    def widen(self, at: np.ndarray, width: float, wanted: int) -> tuple[np.ndarray, float]:
        """Candidates around the projections ``at``, from windows that widen until there are enough; the last width."""
        n, allowed = len(self.ids), int((1 - THRESHOLD) * PROJECTIONS)
        misses = left = right = None
        while True:
            lo = self.sorted.searchsorted(at + self.base - np.minimum(width * self.unit, APART / 4), "left")
            hi = self.sorted.searchsorted(at + self.base + np.minimum(width * self.unit, APART / 4), "right")
            if misses is None:
                # wide windows leave few vectors out: these are counted, once per window they miss
                spans = [*zip(self.first, lo, strict=True), *zip(hi, self.first + n, strict=True)]
                misses = np.bincount(np.concatenate([self.order[i:j] for i, j in spans]), minlength=n)
            else:
                spans = [*zip(lo, left, strict=True), *zip(right, hi, strict=True)]
                misses -= np.bincount(np.concatenate([self.order[i:j] for i, j in spans]), minlength=n)
            found = np.flatnonzero(misses <= allowed)
            if len(found) >= wanted:
                return found, width
            left, right, width = lo, hi, width * WIDER

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """``query``: of length 1, as the longest vector is here."""
        n = len(self.ids)
        wanted = self.wanted(n, k)
        if wanted >= n or not np.isfinite(self.longest):
            return np.arange(n)
        if self.order is None:
            self.index()
        return self.widen(np.append(query, 0.0) @ self.directions, self.start, wanted)[0]


class Block:
    """The vectors of a block in shells, the longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = lengths(vectors)
        down = np.argsort(-norms, kind="stable")
        ids, vectors, norms = ids[down], vectors[down], norms[down]
        self.shells, at = [], 0
        while at < len(ids):
            # no vector of a shell is shorter than this part of its longest
            end = max(at + 1, int(np.searchsorted(-norms, -norms[at] * SHORTEST, "right")))
            self.shells.append(Shell(ids[at:end], vectors[at:end], norms[at:end]))
            at = end

    def nearest(self, query_id, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        length = lengths(query[None])[0]
        ids, scores = self.shells[0].ids[:0], np.zeros(0)
        for shell in self.shells:
            # no product is above that of the lengths: no vector from here on can enter (the rest is for rounding)
            if len(ids) >= k and scores[k - 1] > shell.longest * length * (1 + 1e-9):
                break
            found = shell.candidates(query / length, k + 1)
            found = found[shell.ids[found] != query_id]
            ids = np.concatenate([ids, shell.ids[found]])
            scores = np.concatenate([scores, shell.vectors[found] @ query])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


def usable(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    rows = (embeddings.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull())
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .where(F.exists("vec", lambda x: x != 0)))
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = sizes.orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (usual[0]["n"] if usual else 0))


def _searching(k: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, asked = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(asked):
            rows = rows.sort_values("id", kind="stable")
            block = Block(rows["id"].to_numpy(np.int64), np.stack(rows["vec"].to_numpy()).astype(np.float64))
            for query_id, vec in zip(asked["id"], asked["vec"], strict=True):
                ids, scores = block.nearest(query_id, np.asarray(vec, np.float64), k)
                out["query_id"] += [query_id] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return search


def search(embeddings: DataFrame, is_query, *, k: int = K, id_col="vec_id", vec_col="embedding",
           block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query``
    (a column over ``id``) holds."""
    rows = stage(usable(embeddings, id_col, vec_col), "vectors")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks, groups = max(1, -(-n // block)), max(1, -(-asked // queries))
    part = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    # a block goes to every group of queries and a query to every block: the stated query set, in blocks
    held = rows.select("id", "vec", F.lit(False).alias("asks"), part(blocks, 1).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    asking = rows.where(is_query).select("id", "vec", F.lit(True).alias("asks"),
                                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part(groups, 2).alias("group"))
    near = (held.unionByName(asking).groupBy("block", "group")
            .applyInPandas(_searching(k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the 20 nearest of every row whose vec_id is divisible by 20."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % EVERY == 0)
