"""Operator 12, centroid clustering with n-simplex bounds.

Vectors are whole numbers (each component times ``SCALE``, rounded down), so that distances, sums and means are exact and
a rerun gives the same clusters whatever the order of the rows.

A vector's distances to ``PIVOTS`` vectors, computed once and kept with it, are turned into the coordinates of an apex over the
simplex that the pivots' own distances span: those of its foot in the base, and its height. Of two vectors, the
distance of the apexes is a lower bound, and that with one apex mirrored below the base an upper bound. In every
round the centroids get their apexes too; a centroid whose lower bound is above the least upper bound cannot be
nearest and is left out, and the others are compared exactly, in whole numbers.

A round reads the staged vectors, adds up every task's own sums by cluster, and brings ``centroids`` times ``dims`` sums to the
driver; centroids travel with the task functions. Both are bounded by parameters, not by the data. Rounds end early only when
no centroid moved, as nothing can change after that.

Defined results: vectors of another length, null, with a null or non-finite component, or with a scaled component of
``LIMIT`` or more in size (whose squared distance would not fit 64 bits) take no part; a null id takes part and comes last among
the first centroids; rows that share an id are vectors of their own; with fewer vectors than centroids each is a centroid;
without any the result is empty. An empty cluster keeps its centroid. Ties go to the smaller number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_batches, map_batches, stage

DIMS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
PIVOTS = 16
#: Squares of differences of numbers up to this, 64 of them, fit 63 bits.
LIMIT = 1 << 27
#: A pivot whose height over the base of the earlier ones is below this part of its distance adds nothing but rounding.
FLAT = 1e-3
#: Bounds are widened by this part of the distances they come from, more than their rounding.
SLACK = 1e-6


def squared(vectors: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Squared distances of every vector to every other one, exact."""
    return np.stack([((vectors - o) ** 2).sum(1) for o in other], 1) if len(other) else np.zeros((len(vectors), 0), np.int64)


class Simplex:
    """The base that pivots span, and apexes over it."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.base = pivots[:1], np.zeros((1, 0))
        for p in pivots[1:]:
            apex = self.apexes(squared(p[None], self.pivots))[0]
            if apex[-1] > FLAT * np.linalg.norm(apex):
                self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apex])
                self.pivots = np.vstack([self.pivots, p])

    def apexes(self, squares: np.ndarray) -> np.ndarray:
        """Apex coordinates (the foot, then the height) from squared distances to the pivots."""
        squares = squares.astype(np.float64)
        rows = self.base[1:]  # lower triangular; the first pivot is the origin
        right = (squares[:, :1] - squares[:, 1:] + (rows ** 2).sum(1)) / 2
        foot = np.linalg.solve(rows, right.T).T if len(rows) else right
        return np.column_stack([foot, np.sqrt(np.maximum(squares[:, 0] - (foot ** 2).sum(1), 0))])


def bounds(apexes: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances, widened for rounding."""
    foot = ((apexes[:, None, :-1] - other[None, :, :-1]) ** 2).sum(2)
    up, down = apexes[:, None, -1] + other[None, :, -1], apexes[:, None, -1] - other[None, :, -1]
    slack = SLACK * (np.linalg.norm(apexes, axis=1)[:, None] + np.linalg.norm(other, axis=1)[None])
    return np.sqrt(foot + down ** 2) - slack, np.sqrt(foot + up ** 2) + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid, and how many pairs were compared exactly."""
    lower, upper = bounds(apexes, centroid_apexes)
    open_pairs = lower <= upper.min(1, keepdims=True)
    best, at = np.full(len(vectors), np.iinfo(np.int64).max), np.zeros(len(vectors), np.int64)
    for c, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_pairs[:, c])
        d = ((vectors[rows] - centroid) ** 2).sum(1)
        closer = d < best[rows]
        best[rows[closer]], at[rows[closer]] = d[closer], c
    return at, best, int(open_pairs.sum())


# -------------------------------------------------------------------------------------- Spark


def _matrix(column, kind) -> np.ndarray:
    """Lists of one length as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(n, -1) if n else np.zeros((0, 0), kind)


def kept(embeddings: DataFrame, id_col: str, vec_col: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``_id, vec`` of the vectors that take part, in whole numbers."""
    scaled = F.transform(F.col(vec_col), lambda x: x.cast("double") * scale)
    rows = embeddings.select(F.col(id_col).alias("_id"), scaled.alias("scaled")).where(F.size("scaled") == dims)
    whole = F.forall("scaled", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LIMIT), F.lit(False)))
    return rows.where(whole).select("_id", F.transform("scaled", lambda x: F.floor(x).cast("long")).alias("vec"))


def _placing(simplex: Simplex):
    def make():
        def work(batch):
            apexes = simplex.apexes(squared(_matrix(batch.column("vec"), np.int64), simplex.pivots))
            at = np.arange(0, apexes.size + 1, apexes.shape[1], dtype=np.int32)
            return pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("vec"), pa.ListArray.from_arrays(at, pa.array(apexes.ravel()))],
                                              names=["_id", "vec", "apex"])

        return work

    return make


def _summing(centroids: np.ndarray, placed: np.ndarray):
    def make():
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)

        def add(batch):
            if batch.num_rows:
                vectors = _matrix(batch.column("vec"), np.int64)
                at = nearest(vectors, _matrix(batch.column("apex"), np.float64), centroids, placed)[0]
                np.add.at(sums, at, vectors)
                counts[:] += np.bincount(at, minlength=len(centroids))

        def finish():
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(centroids)), pa.int32()), pa.array(counts),
                                               pa.array(list(sums), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

        return add, finish

    return make


def _assigning(centroids: np.ndarray, placed: np.ndarray):
    def make():
        def work(batch):
            at, best, _ = nearest(_matrix(batch.column("vec"), np.int64), _matrix(batch.column("apex"), np.float64), centroids, placed)
            return pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(at, pa.int32()), pa.array(best)], names=["_id", "cluster", "distance"])

        return work

    return make


def moved(rows: DataFrame, centroids: np.ndarray, placed: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    parts = fold_batches(rows.select("vec", "apex"), _summing(centroids, placed), "cluster int, n long, sums array<bigint>")
    found = (parts.select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at")
             .agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect())
    new = centroids.copy()
    for r in found:
        if r["n"]:
            new[r["cluster"], r["at"]] = r["x"] // r["n"]
    return new


def cluster(embeddings: DataFrame, *, id_col="vec_id", vec_col="embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every vector that takes part (staged), and the final centroids."""
    vectors = stage(kept(embeddings, id_col, vec_col, dims, scale), "whole_vectors")
    kind = vectors.schema["_id"].dataType.simpleString()
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")).cast("binary"), 256)
    chosen = vectors.orderBy(order.asc_nulls_last(), "vec").limit(max(centroids, pivots)).collect()
    if not chosen:
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long"), np.zeros((0, dims), np.int64)
    chosen = np.array([r["vec"] for r in chosen], np.int64)
    simplex, now = Simplex(chosen[:pivots]), chosen[:centroids]
    rows = stage(map_batches(vectors, _placing(simplex), f"_id {kind}, vec array<bigint>, apex array<double>"), "apexes")
    for _ in range(rounds):
        new = moved(rows, now, simplex.apexes(squared(now, simplex.pivots)))
        if (new == now).all():
            break
        now = new
    last = map_batches(rows, _assigning(now, simplex.apexes(squared(now, simplex.pivots))), f"_id {kind}, cluster int, distance long")
    return stage(last, "clusters").withColumnRenamed("_id", id_col), now


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every vector's cluster, with the inertia of its cluster and of all, and its centroid's digest."""
    assigned, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = {r["cluster"]: int(r["inertia"]) for r in
            assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    rows = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
            for c, centroid in enumerate(centroids.tolist())]
    # one row per centroid
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    squares = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = ["""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS c, v FROM kept QUALIFY c < 8)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT k.vec_id, any_value(k.v) AS v, min((d, c)).c AS cluster, min((d, c)).d AS distance FROM
  (SELECT k.vec_id, k.v, c.c, {squares} AS d FROM kept k, c{i} c) k GROUP BY k.vec_id)""".replace("(d, c)", "{'d': d, 'c': c}"))
        if i < rounds:
            parts.append(f"""m{i} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM
  (SELECT cluster, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM
   (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY cluster, pos) GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.c)""")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.cluster
""")


SQL = _sql()
