"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps in the click log are naive
# (documented as UTC); pinning the session zone keeps display/cast identical
# on every executor.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "gapwise", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings gapwise relies on.

    On a cluster the master and most sizing come from spark-submit; only
    missing keys are filled in here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only if unset and the master is local.

    Raises ValueError on any other master without the setting: a folder of the
    driver's machine is not visible to executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.environ.get("GAPWISE_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="gapwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder; removed by :func:`drop_scratch` or at interpreter exit."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gapwise-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark, path))
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        for own in [x for x in _SCRATCH if x[1] == path]:     # other threads may add folders meanwhile
            _SCRATCH.remove(own)


@atexit.register
def _drop_all() -> None:
    for spark, path in list(_SCRATCH):
        try:
            drop_scratch(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to a scratch folder and read it back; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
