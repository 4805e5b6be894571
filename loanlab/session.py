"""Session and scratch-space helpers.

Library code never picks a machine-local folder on a cluster: lineage is cut with
``DataFrame.checkpoint`` into ``spark.checkpoint.dir`` (a shared folder named by the
cluster).  Only when nothing is configured -- local runs and tests -- a private
folder is created.
"""
from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "loanlab",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this package assumes."""
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("LOANLAB_MASTER")
    if master:  # else spark-submit's, or Spark's own default
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = os.environ.get("LOANLAB_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    session conf; only if both are unset on a local master a fresh private folder.  On a
    cluster a machine-local folder would lose data, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="loanlab-ckpt-")
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never reused)."""
    return f"{checkpoint_dir(spark)}/loanlab-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors (once for each application).

    Functions given to Spark are pickled by reference to their module, so executors
    need the code; it travels as one archive through Spark's own file service.
    """
    sc = spark.sparkContext
    with _SHIPPING:   # fits run side by side, and Spark refuses a second archive of that name
        if sc.applicationId in _SHIPPED:
            return
        import zipfile
        root = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="loanlab-src-"), "loanlab.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        p = os.path.join(d, n)
                        z.write(p, os.path.join("loanlab", os.path.relpath(p, root)))
        sc.addPyFile(out)
        _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def right_size(df: DataFrame, row_bytes: int, target_bytes: int = 8 << 20, floor: int = 1) -> DataFrame:
    """Persist ``df`` with a partition count fitted to its size.

    Iterative learners run one job per iteration, so every partition costs a task
    launch per iteration; small training frames get ``ceil(bytes / target)``
    partitions (at least ``floor``, never more than they have).  Large frames
    are left as they are.  Returns the persisted frame (one count job).
    """
    df = df.persist()
    n = df.count()
    have = df.rdd.getNumPartitions()
    want = max(floor, -(-n * max(1, row_bytes) // target_bytes))
    if want >= have:
        return df
    smaller = df.coalesce(int(want)).persist()
    smaller.count()
    df.unpersist()
    return smaller
