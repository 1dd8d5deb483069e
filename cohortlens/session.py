"""Session settings shared by tests, the bench and library users."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every cohortlens job relies on.  AQE re-plans joins from runtime
# sizes (broadcast only below autoBroadcastJoinThreshold, otherwise
# sort-merge), splits skewed join partitions and coalesces small ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # selective joins (one month of orders against all lineitem) get a bloom
    # filter from the small side pushed into the big side before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app: str = "cohortlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the cohortlens defaults.

    Without ``master`` and ``shuffle_partitions`` the cluster's own values win;
    ``spark.checkpoint.dir`` is then expected to name a shared folder.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present.  Only a local-mode
    session without one (tests, the bench) gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder"
        )
    folder = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(folder)
    return folder
