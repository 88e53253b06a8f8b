"""Session helpers: a local session for tests and the bench, and the shared scratch folder.

Staged and intermediate tables go below the folder the cluster names in ``spark.checkpoint.dir``.
That folder is shared by all executors, so a staged table survives the loss of any executor. The library
demands that setting; :func:`local_scratch` is for the entry module, the bench and tests, which run in local
sessions that may lack it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "relayout") -> SparkSession:
    """A local session as the tests and the bench use it: AQE on, UI off, UTC."""
    return local_scratch(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Staged tables stay there until whoever names the folder empties it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder every executor can reach")
    return configured.rstrip("/")


def local_scratch(spark: SparkSession) -> SparkSession:
    """The session, with a temporary ``spark.checkpoint.dir`` if it is a local one that names none."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        if "local-cluster" not in spark.sparkContext.master:
            spark.conf.set("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="relayout-scratch-"))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
