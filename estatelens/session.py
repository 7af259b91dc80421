"""Session helpers.

Cluster settings (shuffle partitions, checkpoint dir, broadcast threshold)
are read from the session when present; defaults are applied only when a
value is unset, which is the case in local tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime from actual
# sizes (broadcast only when the measured side is under the threshold),
# coalesces small shuffle partitions and splits skewed ones.
_REQUIRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle partitions to the advisory size (64 MB), not to the
    # default parallelism: right-sized tasks on a cluster, few on small data
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
    # catalog timestamps carry no zone; literals and casts stay zone-less too
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def build_session(master: str | None = None, app: str = "estatelens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply required runtime settings to an existing session."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a scratch folder
    created and set.
    """
    try:
        sc = spark.sparkContext            # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if not d:
        master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="estatelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
