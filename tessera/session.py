"""Session defaults and the shared scratch folder.

Every format round trip writes real files. On a cluster they must land in
storage every executor can reach, so the scratch root is the folder the
cluster names in ``spark.checkpoint.dir``. Only when a session has none
(local tests) do we create one and register it as the checkpoint folder.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Applied by ``build_session`` and checked by
# ``ensure_session_defaults`` for sessions built elsewhere.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet timestamps written without a zone are wall-clock values.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "tessera",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               # Checkpoints cut by the numbering are removed once unreferenced.
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Pin the time zone to UTC where the caller left it unset.

    Zone-less values (``TIMESTAMP_NTZ``) do not depend on it, but text
    written for zoned timestamps would.
    """
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created only when the session has none."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # Local sessions (tests, the bench) only: a cluster names its own.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder path under the shared root (not created yet)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera-scratch/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession, hours: float = 72.0) -> list[str]:
    """Removes the scratch folders in which nothing was written for ``hours``, and
    returns their names. Only call it with an age that no running job or DataFrame
    still in use reaches: tables that were read from such a folder lose their files."""
    import pyarrow.fs as pafs

    from .sources.arrow_ipc import filesystem
    if hours < 0:
        raise ValueError("hours must not be negative")
    fs, base = filesystem(f"{checkpoint_root(spark).rstrip('/')}/tessera-scratch")
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        return []
    limit = time.time_ns() - int(hours * 3600 * 1e9)
    removed = []
    for folder in fs.get_file_info(pafs.FileSelector(base)):
        if folder.type != pafs.FileType.Directory:
            continue
        inside = fs.get_file_info(pafs.FileSelector(folder.path, recursive=True, allow_not_found=True))
        # A folder without a known time of writing stays.
        times = [i.mtime_ns for i in [folder, *inside] if i.mtime_ns]
        if times and max(times) <= limit:
            fs.delete_dir(folder.path)
            removed.append(folder.base_name)
    return removed


__all__ = ["build_session", "ensure_session_defaults", "checkpoint_root",
           "scratch_path", "clear_scratch", "SESSION_DEFAULTS"]
