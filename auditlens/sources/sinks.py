"""View registration, snapshot sink, preview reads."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from auditlens.session import ensure_checkpoint_dir


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> list[str]:
    """Expose lazy frames as temporary views (recomputed on read, like SQL views)."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


def snapshot_root(spark: SparkSession) -> str:
    """Shared folder for snapshots: under the cluster's checkpoint directory."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/snapshots"


def snapshot(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
             partition_by: list[str] | None = None, keep: int = 2) -> DataFrame:
    """Materialise a frame in a shared folder and read it back.

    This is the refresh of a materialised view: later readers see a fixed
    result and a short lineage, and a lost executor cannot force the
    upstream scans to rerun. Each call writes a new version folder; frames
    read before go on reading theirs, ``latest_snapshot`` gives the newest
    whole one, and of a snapshot's versions the ``keep`` newest stay. Without
    ``path`` the versions lie under the session's checkpoint directory.
    """
    spark = df.sparkSession
    base = path or f"{snapshot_root(spark)}/{name}"
    target = write_version(df, base, fmt, partition_by)
    if path is not None:  # under the checkpoint folder versions belong to their session
        prune_snapshots(spark, base, keep)
    return spark.read.format(fmt).load(target)


def write_version(df: DataFrame, base: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Write a frame as a new version folder under ``base``; returns the folder."""
    target = f"{base}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    # rebalance: AQE sizes the output partitions (no flood of small files from a wide
    # scan, skewed partitions split), clustered by the partition columns if any
    balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = balanced.write.mode("error").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    return target


def _versions(spark: SparkSession, base: str) -> tuple[object, list]:
    """The file system of a snapshot's folder, and its version folders, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x.getPath() for x in fs.listStatus(folder) if x.isDirectory() and x.getPath().getName().startswith("v")] if fs.exists(
        folder) else []
    return fs, sorted(found, key=lambda p: p.getName())


def latest_snapshot(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of a snapshot that was written to its end."""
    fs, versions = _versions(spark, base)
    whole = [v for v in versions if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(v, "_SUCCESS"))]
    if not whole:
        raise ValueError(f"no snapshot in {base}")
    return spark.read.format(fmt).load(whole[-1].toString())


def prune_snapshots(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest versions; returns how many went."""
    fs, versions = _versions(spark, base)
    old = versions[:-keep] if keep else versions
    for version in old:
        fs.delete(version, True)
    return len(old)


# --- one version for many folders ---------------------------------------------------------------

_MANIFESTS = "_manifests"


def _files(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from any file system that Spark reads."""
    fs, place = _files(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, base: str, content: dict) -> str:
    """Make ``content`` (any JSON; folders by name, for example) the published state of ``base``.

    A manifest is written beside the older ones under a hidden name and gets
    its own with one rename, after all that it names was written: a reader sees the state before or the state
    after, never a mix, and a run that fails on its way changes nothing. One writer at a time.
    """
    fs, folder = _files(spark, f"{base}/{_MANIFESTS}")
    fs.mkdirs(folder)
    name = f"m{time.time_ns():020d}.json"
    path = spark._jvm.org.apache.hadoop.fs.Path
    hidden, final = path(folder, f"_{name}"), path(folder, name)
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if not fs.rename(hidden, final):
        raise OSError(f"manifest {final.toString()} could not be published")
    return final.toString()


def manifests(spark: SparkSession, base: str) -> list[str]:
    """The published manifests of ``base``, oldest first."""
    fs, folder = _files(spark, f"{base}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    return sorted(x.getPath().toString() for x in fs.listStatus(folder) if x.getPath().getName().startswith("m"))


def published(spark: SparkSession, base: str, manifest: str | None = None) -> dict | None:
    """What the newest (or the given) manifest of ``base`` says; None before the first."""
    known = manifests(spark, base)
    if manifest is None and not known:
        return None
    return json.loads(read_text(spark, manifest or known[-1]))


def prune_published(spark: SparkSession, base: str, folders, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest manifests, and the version folders that none of those names.

    ``folders``: what ``content`` names, as a function of it. Folders written after the newest manifest (by a run
    that is under way) stay. Returns how many folders went.
    """
    known = manifests(spark, base)
    held = {f.rstrip("/") for m in known[-keep:] for f in folders(published(spark, base, m))}
    newest = known[-1].rpartition("/m")[2].partition(".")[0] if known else ""
    gone = 0
    for parent in {f.rpartition("/")[0] for m in known for f in folders(published(spark, base, m))}:
        fs, place = _files(spark, parent)
        for x in fs.listStatus(place) if fs.exists(place) else []:
            name = x.getPath().getName()
            if x.isDirectory() and name.startswith("v") and f"{parent}/{name}" not in held and name[1:].partition("-")[0] < newest:
                fs.delete(x.getPath(), True)
                gone += 1
    for m in known[:-keep]:
        fs, place = _files(spark, m)
        fs.delete(place, False)
    return gone


def preview(df: DataFrame, analysis_col: str | None, key_col: str | None, n: int = 10) -> DataFrame:
    """A few assessed rows with a key (the notebooks' smoke reads)."""
    out = df
    if analysis_col:
        out = out.filter(out[analysis_col].isNotNull())
    if key_col:
        out = out.filter(out[key_col].isNotNull())
    return out.limit(n)
