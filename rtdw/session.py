"""Session settings and the shared folder that streams and stores write to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Whether a store takes disk in advance: 4 MB for each partition of each state step, also where it holds a few rows.
PREALLOCATED = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "rtdw", master: str | None = None, tz: str = "UTC", **conf: str) -> SparkSession:
    """A session with an explicit time zone, AQE and a RocksDB state store.

    ``tz`` decides how epoch values become dates and how window bounds are written.
    Extra settings are given as keyword arguments with ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": tz,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        PROVIDER: STATE_STORE,
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, whose executors live in this very process, may fall back to a temporary
    folder; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="rtdw-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below :func:`shared_dir` for one run of a job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, wherever the driver was started.

    The archive is made anew per session by the driver, which serves it to the executors.
    """
    context = spark.sparkContext
    name = f"rtdw-{context.applicationId}.zip"
    if any(name in path for path in context._python_includes):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rtdw-package-"), name)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)


def keyed_state(spark: SparkSession) -> None:
    """Make a session fit for Spark's state operator, however it was built.

    Spark's default state store has no column families, which the operator needs; a store that was chosen otherwise stays. A
    stream takes the setting when it first starts, and a resumed one that of its checkpoint. The many small stores take no disk
    in advance, unless that is asked for.
    """
    ship_package(spark)
    if spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, STATE_STORE)
    if spark.conf.get(PREALLOCATED, None) is None:
        spark.conf.set(PREALLOCATED, "false")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)
