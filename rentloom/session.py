"""Session settings, and the folder for written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str, cores: int = 8) -> SparkSession:
    """Session for tests and the bench; on a cluster use the one it hands out."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM only interprets methods of more bytes, so Spark had better split them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names for checkpoints.

    All executors must see it, so without that setting only a local session, as in tests,
    gets a folder of its own. The folder is this process's: it is deleted when the process
    ends, or earlier by `delete_folder`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rentloom-")
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    deleted_at_exit(spark, path)
    return path


def deleted_at_exit(spark: SparkSession, path: str) -> None:
    atexit.register(_delete_quietly, spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared_folder, wherever it is stored."""
    where, system = stored(spark, path)
    system.delete(where, True)


def stored(spark: SparkSession, path: str):
    """A path and the file system it lies on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, system = stored(spark, path)
    return system.exists(where)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    where, system = stored(spark, path)
    if not system.rename(where, stored(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def whole_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders below path that a job wrote to the end, in the order of their names."""
    where, system = stored(spark, path)
    if not system.exists(where):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    found = [str(f.getPath().toString()) for f in system.listStatus(where) if f.isDirectory()]
    return sorted(f for f in found if system.exists(done(f"{f}/_SUCCESS")))


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete_folder(spark, path)
    except Exception:  # the session has ended before the process
        pass
