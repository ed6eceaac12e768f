"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings a job relies on. AQE turns sort-merge joins into broadcast joins only
# when the runtime size of a side is below the threshold (the size check), splits
# skewed shuffle partitions, and coalesces small ones. A stream lists the files of
# each micro-batch in tasks of several files, not one task per file.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "feedkiln",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is only for local runs and tests; on a cluster the launcher
    decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("FEEDKILN_DRIVER_MEMORY", "16g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedkiln`` importable on every Python worker (``addPyFile`` of a
    zip of the package, once per application). Pandas UDFs and
    ``mapInPandas`` functions are pickled by module reference, so executors
    need the package itself, not only the driver."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Connect session: artifacts are the client's business
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="feedkiln-pyfiles-"), "feedkiln.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for k, v in DEFAULT_CONF.items():
        if k in ("spark.ui.enabled",):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an existing session
            pass
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only a local master may leave it unset (tests), and
    then a temporary folder is picked.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Connect session: the server owns the setting
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share") from None
        return root
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            root = tempfile.mkdtemp(prefix="feedkiln-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root, unique per call."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/feedkiln/{name}-{uuid.uuid4().hex[:12]}"
