"""Spark session defaults and the shared checkpoint folder.

Executors can disappear at any time, so long lineages (scored pairs that feed
both the merge and the quality log) are cut with ``DataFrame.checkpoint()``
into the folder the cluster names in ``spark.checkpoint.dir``.  We only set our
own folder when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "scriptorium",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) and Arrow enabled."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Scored text pairs are large per row: keep Arrow batches small so a
        # batch of long transcripts never has to fit in one Python buffer.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    }
    local = bool(master and master.startswith("local"))
    if local:  # the driver is the executor: half of the machine's memory, 16 GB at most
        half = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (2 << 20)
        conf["spark.driver.memory"] = f"{min(16 << 10, half)}m"
    # On a cluster keep the configured shuffle width (AQE coalesces it);
    # locally a small width avoids hundreds of near-empty tasks.
    if shuffle_partitions is not None or local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local session without one gets its own, a cluster must name it."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    if not current:
        current = sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        # Local runs and tests only.
        current = tempfile.mkdtemp(prefix="scriptorium-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, current)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
