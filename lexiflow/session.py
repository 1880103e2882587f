"""Session helpers: local sessions for tests/bench and the shared checkpoint folder.

On a cluster the session is created by the platform; these helpers only fill in
settings that are missing, never override what the cluster already set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every job in this package relies on. AQE re-plans joins from runtime
# sizes (broadcast conversion, skew splitting, partition coalescing). Broadcasts
# decided from *estimated* plan sizes are off: an explode or aggregate can make
# an estimate arbitrarily wrong, so a join is broadcast only by an explicit,
# size-checked hint in the code or by AQE from measured shuffle output.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lexiflow", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared, fault-tolerant folder there; we only create a
    scratch one when neither the setting nor a context checkpoint dir exists
    and the master is local (tests). On a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    active = sc.getCheckpointDir()
    base = named or active
    if not base:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on other machines
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (e.g. on "
                               "HDFS or object storage) for stage tables on a cluster")
        base = tempfile.mkdtemp(prefix="lexiflow-ckpt-")
    if active is None:
        sc.setCheckpointDir(base)
    return base


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}") if "://" not in base \
        else f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_stage_tables(spark: SparkSession) -> int:
    """Delete every path handed out by :func:`scratch_path` in this process so far.

    Query results are lazy and read their stage tables, so the caller decides when they
    are done with: call this after the results have been consumed. Returns the number
    of paths deleted.
    """
    n = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        n += bool(fs.delete(path, True))
    return n


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint folder.

    The table survives executor loss and later stages re-read it instead of
    recomputing the upstream plan. Unlike ``DataFrame.checkpoint`` (which,
    without a persisted input, computes the plan once for the action and once
    more to write the checkpoint files) the plan runs exactly once, and the
    read-back is columnar, so later projections prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)


def materialize_measured(df: DataFrame, name: str, metrics: dict[str, Column]
                         ) -> tuple[DataFrame, dict]:
    """:func:`materialize`, also returning aggregate ``metrics`` of the written rows.

    The metrics are observed while the table is written (``DataFrame.observe``),
    so a size check on a stage table costs no extra job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    df.observe(obs, *[c.alias(k) for k, c in metrics.items()]).write.parquet(path)
    values = {k: (v if v is not None else 0) for k, v in obs.get.items()}
    return spark.read.parquet(path), values

