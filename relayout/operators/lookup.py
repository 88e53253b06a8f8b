"""Keyed lookup with expiry, read-through loading and remembered misses (L1-L10), over tables.

Tables (``keys`` defaults to ``namespace, key``; the namespace keeps separate caches apart, L10):

* ``lookup``:   keys, payload columns, ``expires_at`` (NULL = never expires)
* ``negative``: keys, ``expires_at`` -- keys recorded as absent from the source
* ``source``:   keys, payload columns -- the system of record, one row per key
* ``requests``: keys, one row per request (duplicates expected)

Every operator takes an explicit ``as_of`` instant; an entry is live while ``expires_at`` is NULL
or later than ``as_of`` (L6).

Scale: requests are first reduced to distinct keys (or to per-key counts for statistics). That
reduction is aggregated map-side, so a key holding a third of all requests becomes one row per task
before any shuffle, and the joins that follow see every key once. Joins are plain equi-joins on the
keys; AQE turns one into a broadcast only when the runtime size of a side is below the threshold.

A batch of few keys should not move a large store: :func:`read_through_batch` writes the distinct keys down, measures
them, and if they are within ``BATCH_BYTES`` sends them to the scans of the lookup and of the source, which then
are not shuffled at all. Stores kept bucketed by key (``sources.store``) are not moved by batches of any size.

Intended semantics are implemented, not the original defects: a negative is recorded only for a
key the source lacks and only when negatives are enabled; a hit on a live negative does not extend
it; a bulk read consults negatives like a single read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expiry import Instant, expiry, live
from ..sources.staging import materialize

KEYS = ("namespace", "key")
#: Keys of this size together are sent to every task.
BATCH_BYTES = 32 << 20


def _live(df: DataFrame, as_of: Instant) -> DataFrame:
    return df.where(live(F.col("expires_at"), as_of))


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is complete: a null key equals no key, so it is never stored nor found."""
    return df.dropna("any", subset=list(keys))


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _with_keys(df.select(*keys), keys).distinct()


def present(requests: DataFrame, lookup: DataFrame, as_of: Instant, keys: Sequence[str] = KEYS) -> DataFrame:
    """L1: the live lookup entries of the requested keys (absent and expired keys are skipped)."""
    return _live(lookup, as_of).join(_distinct_keys(requests, keys), list(keys), "left_semi")


@dataclass(frozen=True)
class Resolution:
    resolved: DataFrame   # every requested key once: keys, status, cache and source payload
    found: DataFrame      # keys, payload, origin ('cache' | 'source')
    stored: DataFrame     # keys, payload, expires_at: loaded rows to store (upsert into lookup)
    not_found: DataFrame  # keys, expires_at: new negatives (empty when negatives are off)


def read_through(
    requests: DataFrame,
    lookup: DataFrame,
    source: DataFrame,
    as_of: Instant,
    *,
    negative: DataFrame | None = None,
    ttl_seconds: int | None = None,
    missing_ttl_seconds: int | None = None,
    keys: Sequence[str] = KEYS,
) -> Resolution:
    """L2-L4: live entries from the lookup, the rest loaded from the source.

    A requested key with a live negative entry is not loaded and counts as absent (L3, only when
    ``negative`` is given). Keys neither cached nor in the source become new negatives that expire
    after ``missing_ttl_seconds`` (L4). Loaded rows are returned for storing with ``ttl_seconds``.

    Plan: the distinct requested keys, left-joined in turn to the live lookup, the live negatives
    and the source. The dedupe leaves the keys hash-partitioned, so every later join shuffles only
    its other side, and each input is read once. ``resolved`` is that one frame; materialize it
    when several outputs are needed.
    """
    keys = list(keys)
    payload = [c for c in source.columns if c not in keys]
    wanted = _distinct_keys(requests, keys)
    cached = _live(lookup, as_of).select(
        *keys, F.lit(True).alias("_in_cache"), *[F.col(c).alias(f"_cache_{c}") for c in payload])
    fetched = source.select(
        *keys, F.lit(True).alias("_in_source"), *[F.col(c).alias(f"_source_{c}") for c in payload])
    resolved = wanted.join(cached, keys, "left")
    blocked = F.lit(False)
    if negative is not None:
        resolved = resolved.join(
            _live(negative, as_of).select(*keys).distinct().withColumn("_negative", F.lit(True)), keys, "left")
        blocked = F.col("_negative").isNotNull()
    # The source is only consulted for keys the cache misses and no live negative blocks.
    resolved = resolved.join(
        fetched, [*[resolved[k] == fetched[k] for k in keys], F.col("_in_cache").isNull() & ~blocked], "left"
    ).select(*[resolved[k] for k in keys], *[c for c in resolved.columns if c not in keys],
             *[c for c in fetched.columns if c not in keys])
    status = (F.when(F.col("_in_cache").isNotNull(), F.lit("cache"))
              .when(blocked, F.lit("negative"))
              .when(F.col("_in_source").isNotNull(), F.lit("source"))
              .otherwise(F.lit("absent")))
    resolved = resolved.select(*keys, status.alias("status"), *[f"_cache_{c}" for c in payload],
                               *[f"_source_{c}" for c in payload])
    return _outputs(resolved, payload, as_of, negative is not None, ttl_seconds, missing_ttl_seconds, keys)


def _outputs(resolved: DataFrame, payload: list[str], as_of: Instant, negatives: bool, ttl_seconds: int | None,
             missing_ttl_seconds: int | None, keys: list[str]) -> Resolution:
    def origin(which: str) -> DataFrame:
        return resolved.where(F.col("status") == which).select(
            *keys, *[F.col(f"_{which}_{c}").alias(c) for c in payload])

    # one pass over the resolution (a union of two filtered branches would run the joins twice)
    from_cache = F.col("status") == "cache"
    found = resolved.where(F.col("status").isin("cache", "source")).select(
        *keys,
        *[F.when(from_cache, F.col(f"_cache_{c}")).otherwise(F.col(f"_source_{c}")).alias(c) for c in payload],
        F.col("status").alias("origin"))
    stored = origin("source").withColumn("expires_at", expiry(as_of, ttl_seconds))
    absent = resolved.where(F.col("status") == "absent").select(*keys)
    if not negatives:
        absent = absent.where(F.lit(False))
    not_found = absent.withColumn("expires_at", expiry(as_of, missing_ttl_seconds))
    return Resolution(resolved, found, stored, not_found)


def key_bytes(rows: DataFrame, keys: Sequence[str]) -> int:
    """The size of the keys: the bytes of texts and binaries, 16 for any other value."""
    types = dict(rows.dtypes)
    size = sum((F.octet_length(k) if types[k] in ("string", "binary") else F.lit(16)) for k in keys)
    return rows.agg(F.sum((size + 16).cast("long"))).first()[0] or 0


def of_keys(table: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a table whose key is among ``wanted``, which is sent to every task: nothing of the table is moved."""
    return table.join(F.broadcast(wanted.select(*keys)), list(keys), "left_semi")


def read_through_batch(
    requests: DataFrame,
    lookup: DataFrame,
    source: DataFrame,
    as_of: Instant,
    *,
    negative: DataFrame | None = None,
    ttl_seconds: int | None = None,
    missing_ttl_seconds: int | None = None,
    keys: Sequence[str] = KEYS,
    batch_bytes: int = BATCH_BYTES,
) -> Resolution:
    """:func:`read_through` for a batch of keys, which is written down and measured first.

    Up to ``batch_bytes`` the keys are broadcast into the scan of the lookup, those it misses (and no live negative
    blocks) into the scan of the source. What the two scans give is at most the batch's rows; it is written down, too, and the
    outputs are put together from that, so each table is scanned once, without an exchange, when this is called. Larger
    batches take the plan of :func:`read_through`, over the keys as written.
    """
    keys = list(keys)
    payload = [c for c in source.columns if c not in keys]
    wanted = materialize(_distinct_keys(requests, keys), "batch_keys")
    if key_bytes(wanted, keys) > batch_bytes:
        return read_through(wanted, lookup, source, as_of, negative=negative, ttl_seconds=ttl_seconds,
                            missing_ttl_seconds=missing_ttl_seconds, keys=keys)
    cached = materialize(of_keys(_live(lookup, as_of), wanted, keys).select(*keys, *payload), "batch_cached")
    missed = wanted.join(cached.select(*keys), keys, "left_anti")
    if negative is not None:
        blocked = materialize(of_keys(_live(negative, as_of), missed, keys).select(*keys).distinct(), "batch_negative")
        missed = missed.join(blocked, keys, "left_anti")
    missed = materialize(missed, "batch_missed")
    loaded = materialize(of_keys(source, missed, keys).select(*keys, *payload), "batch_loaded")

    def part(rows: DataFrame, status: str) -> DataFrame:
        """Rows of one status, with the payload of its side."""
        types = dict(cached.dtypes)
        sides = [(F.col(c) if status == side else F.lit(None).cast(types[c])).alias(f"_{side}_{c}") for side in ("cache", "source") for c in payload]
        return rows.select(*keys, F.lit(status).alias("status"), *sides)

    resolved = (part(cached, "cache").unionByName(part(loaded, "source"))
                .unionByName(part(missed.join(loaded.select(*keys), keys, "left_anti"), "absent")))
    if negative is not None:
        resolved = resolved.unionByName(part(blocked, "negative"))
    return _outputs(resolved, payload, as_of, negative is not None, ttl_seconds, missing_ttl_seconds, keys)


def upsert(
    lookup: DataFrame,
    updates: DataFrame,
    as_of: Instant,
    ttl_seconds: int | None,
    *,
    order_by: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The lookup after storing ``updates`` with expiry ``as_of + ttl`` (TTL <= 0: never).

    Of several updates to one key the one with the greatest ``order_by`` wins; ties, and all updates
    without ``order_by``, go to the greatest payload (map columns aside), so one row per key is stored and
    a rerun stores the same. Updates with a null key are ignored. The result holds only live entries:
    expired ones no longer exist.

    The reduced updates are written once to the shared scratch folder, as the anti join and the union
    both read them: their input is evaluated once, when this is called. (The reduction keeps structs, so
    Spark sorts for it in every task and again after the shuffle; both sorts spill.)

    Anti join plus union rather than a full outer join: when the updates are small, their keys can
    be broadcast and the (large) lookup is never shuffled; a full outer join cannot be broadcast.
    """
    keys = list(keys)
    payload = [c for c in lookup.columns if c not in keys and c != "expires_at"]
    types = dict(updates.dtypes)
    order = [F.col(order_by)] if order_by is not None else []
    order += [F.col(c) for c in payload if "map<" not in types[c]] or [F.lit(0)]
    latest = (_with_keys(updates, keys).groupBy(*keys)
              .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_v"))
              .select(*keys, *[F.col("_v")[c].alias(c) for c in payload]))
    fresh = materialize(latest, "updates").withColumn("expires_at", expiry(as_of, ttl_seconds))
    kept = _live(lookup, as_of).join(fresh.select(*keys), keys, "left_anti")
    return kept.select(*keys, *payload, "expires_at").unionByName(fresh)


def record_negative(negative: DataFrame, not_found: DataFrame, as_of: Instant, keys: Sequence[str] = KEYS) -> DataFrame:
    """L4: the negatives after recording ``not_found`` (keys, ``expires_at``; see :func:`read_through`). A key
    recorded again gets its new expiry, the latest of several; expired negatives and null keys are dropped,
    so the table does not grow beyond the live ones."""
    keys = list(keys)
    latest = _with_keys(not_found, keys).groupBy(*keys).agg(
        F.max(F.struct(F.col("expires_at").isNull().alias("never"), F.col("expires_at"))).alias("_e"))
    fresh = materialize(latest.select(*keys, F.col("_e.expires_at").alias("expires_at")), "negatives")
    kept = _with_keys(_live(negative, as_of), keys).join(fresh.select(*keys), keys, "left_anti")
    return kept.select(*keys, "expires_at").unionByName(fresh)


def invalidate(lookup: DataFrame, doomed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The lookup without the given keys. Negative entries are a separate table and stay."""
    return lookup.join(_distinct_keys(doomed, keys), list(keys), "left_anti")


def refresh(
    lookup: DataFrame,
    wanted: DataFrame,
    source: DataFrame,
    as_of: Instant,
    ttl_seconds: int | None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Reload the given keys from the source and store them; a key the source lacks keeps its
    old entry. The source is scanned once."""
    keys = list(keys)
    payload = [c for c in lookup.columns if c not in keys and c != "expires_at"]
    reloaded = source.select(*keys, *payload).join(_distinct_keys(wanted, keys), keys, "left_semi")
    return upsert(lookup, reloaded, as_of, ttl_seconds, keys=keys)


def stats(
    requests: DataFrame,
    lookup: DataFrame,
    as_of: Instant,
    by: Sequence[str] = ("namespace",),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Per group, requests answered by a live entry (``hits``) and the others (``misses``).

    Requests are counted per key first (map-side partial counts), so the join sees each key once.
    """
    keys = list(keys)
    per_key = requests.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hit_keys = _live(lookup, as_of).select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = per_key.join(hit_keys, keys, "left")
    is_hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.groupBy(*by).agg(
        F.sum(F.when(is_hit, F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("hits"),
        F.sum(F.when(is_hit, F.lit(0)).otherwise(F.col("n"))).cast("bigint").alias("misses"),
    )
