"""Session construction and shared-storage helpers."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files are removed once their DataFrame is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "ledgerscope", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass nothing and let
    spark-submit decide on master, memory and shuffle partitions; only the conf
    below is applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings our operators assume to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # static or locked conf on some deployments
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Iterative operators cut lineage with ``DataFrame.checkpoint()`` there. We
    never invent a machine-local folder: tests set this conf themselves."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and spark.sparkContext.master.startswith("local"):
        # Single-machine session (tests, local checks): a local folder is shared
        # by construction. Only here do we pick one ourselves.
        import tempfile
        d = tempfile.mkdtemp(prefix="ledgerscope-ckpt-")
    if not d:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder (set it on the session or cluster)")
    spark.sparkContext.setCheckpointDir(d)
    return d


def pin(df, cache: bool = True):
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    An eager checkpoint of an unpersisted frame computes it twice (the
    triggering count, then the reliable write). With ``cache`` the frame is
    persisted for the duration of the checkpoint, so an expensive upstream
    (shuffles, Python kernels) runs once; callers whose upstream is cheap
    (already pinned inputs, small tables) pass ``cache=False``."""
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    if not cache:
        return df.checkpoint(eager=True)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
