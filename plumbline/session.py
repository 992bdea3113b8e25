"""Sessions: the settings the engine relies on, and its code on the executors."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import sys
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_sent: set[str] = set()


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepared(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per application and pin the time zone."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        _sent.add(app)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        folder = tempfile.mkdtemp(prefix="plumbline-code-")
        archive = os.path.join(folder, "plumbline_code.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for top, _, names in os.walk(_PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(top, name)
                        out.write(path, os.path.join("plumbline", os.path.relpath(path, _PACKAGE)))
        spark.sparkContext.addPyFile(archive)
        if archive in sys.path:  # the driver has the folder itself
            sys.path.remove(archive)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset in local mode (tests), a temporary folder of this process, removed at exit; on a
    cluster that is an error, as executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    path = tempfile.mkdtemp(prefix="plumbline-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` through a checkpoint in the shared folder: lineage ends here, and a lost executor loses nothing."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query``, preceded by ``prepared``."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepared(spark), sf_dir)

    return run
