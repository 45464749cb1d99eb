"""Session settings the library relies on.

The operators are plain DataFrame code; these settings only make their
behaviour deterministic (UTC clock) and let AQE re-plan shuffles and split
skewed join partitions at run time.
"""

from __future__ import annotations

import importlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings to an existing session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "auditlens", driver_memory: str = "4g") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it a cluster run stops with an error rather than write to
    a machine-local folder. Only a local-mode session with nothing set
    (tests) gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors "
                             "(snapshots and checkpoints must survive executor loss)")
        configured = tempfile.mkdtemp(prefix="auditlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[tuple[str, str]] = set()


def ship_module(spark: SparkSession, module: str = "auditlens") -> None:
    """Send a module, or the whole package it lies in, to the session's Python workers (once per application).

    Functions of an importable module are pickled by name, so executors must
    be able to import it; nothing needs to be installed on them beforehand.
    Extension modules and namespace packages are left to the cluster.
    """
    sc = spark.sparkContext
    top = module.partition(".")[0]
    if (sc.applicationId, top) in _SHIPPED:
        return
    source = getattr(importlib.import_module(top), "__file__", None)
    if source is None or not source.endswith(".py"):
        return
    path = Path(source)
    if path.name == "__init__.py":
        archive = Path(tempfile.mkdtemp(prefix="auditlens-ship-")) / f"{top}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(path.parent.rglob("*")):
                if p.is_file() and p.suffix != ".pyc":
                    z.write(p, Path(top) / p.relative_to(path.parent))
        path = archive
    sc.addPyFile(str(path))
    _SHIPPED.add((sc.applicationId, top))
