"""Session helpers: a tuned local/cluster session and the shared checkpoint root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings every job here assumes: UTC session clock (so event-time text and
# timestamp casts are stable), AQE for skew splitting / partition coalescing,
# and Arrow for the few pandas paths.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "eventide", conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); AQE coalesces small ones.
    """
    _export_package_path()
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _export_package_path() -> None:
    """Let local Python workers import this package (stateful processors run there).

    On a cluster ship the package with ``--py-files`` (or ``ship_package``).
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root] + paths)


def importable(spark: SparkSession | None = None) -> None:
    """Let the Python workers of a session (or of those still to start) import this package.

    Works where executors see this folder, as local sessions do.  On a cluster
    ship the package with ``--py-files`` (or ``ship_package``).
    """
    _export_package_path()
    sc = spark.sparkContext if spark else SparkContext._active_spark_context
    if sc:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root] + known)


def ship_package(spark: SparkSession) -> None:
    """Zip the package and add it to the session, so executors can import it."""
    import shutil
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="eventide-pkg-"), "eventide")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "eventide"))


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC: event times are UTC instants stored as NTZ."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and streaming state.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster it names a
    shared file system).  Only when it is unset and the master is local, as in
    tests, a fresh scratch folder is created and registered as the context's checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name under the checkpoint root (written tables, stream state)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
