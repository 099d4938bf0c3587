"""tessera: moving tables in and out of delimited text, Arrow IPC and JSON on
Spark, without losing types or nulls.

``attach(spark)`` prepares a session: session defaults, the ``arrow_ipc``
data source, and the package shipped to executors (Python workers import
it to run the Arrow source and the Arrow/pandas operators).
"""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from .session import build_session, checkpoint_root, clear_scratch, ensure_session_defaults, scratch_path

__all__ = ["attach", "build_session", "scratch_path", "clear_scratch", "checkpoint_root"]

_SHIPPED: set[int] = set()


def _package_zip() -> bytes:
    here = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(here):
            for fn in sorted(files):
                if fn.endswith(".py"):
                    full = os.path.join(dirpath, fn)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    return buf.getvalue()


def _ship(spark: SparkSession) -> None:
    """Put the package on every executor's Python path once per context.

    The archive goes to the shared checkpoint folder, so executors fetch it
    from the same storage as their data."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    from .sources.arrow_ipc import filesystem
    data = _package_zip()
    import hashlib
    digest = hashlib.sha1(data).hexdigest()[:12]
    root = checkpoint_root(spark).rstrip("/")
    target = f"{root}/tessera-lib/{digest}/tessera.zip"
    fs, p = filesystem(target)
    if fs.get_file_info(p).type.name == "NotFound":
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(p) as out:
            out.write(data)
    sc.addPyFile(target)
    _SHIPPED.add(key)


def attach(spark: SparkSession) -> SparkSession:
    ensure_session_defaults(spark)
    # Lets the Arrow source apply simple filters before rows reach the JVM.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    _ship(spark)
    from .sources.arrow_ipc import register
    register(spark)
    return spark
