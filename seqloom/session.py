"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that every plan here was written for. Sizes stay with the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, memory: str = "8g", app: str = "seqloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one where it is unset and the master is local.

    On a cluster the setting is required, since a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    set_to = context.getConf().get("spark.checkpoint.dir")
    if set_to:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(set_to)
        return set_to
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="seqloom-")
    atexit.register(shutil.rmtree, folder, True)
    context.setCheckpointDir(f"file://{folder}")
    return f"file://{folder}"


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and go on from there: later stages survive lost executors."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def application_dir(spark: SparkSession) -> str:
    """The folder of this application in the shared folder. It is removed when the program ends."""
    base, name = shared_dir(spark), spark.sparkContext.applicationId
    path = f"{base}/{name}"
    if path not in _folders:
        _folders.add(path)
        jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()

        def remove() -> None:
            # The gateway may be gone already; then the files stay under the application's id.
            with contextlib.suppress(Exception):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(settings).delete(at, True)

        atexit.register(remove)
    return path


_folders: set[str] = set()


def written(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder as a compressed table and go on from there.

    For large frames: a checkpoint holds rows as they are in memory.
    """
    spark = frame.sparkSession
    path = f"{application_dir(spark)}/{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
