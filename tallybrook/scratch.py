"""Fresh folders for intermediate tables and streaming checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
#: Where the tables of this process are that can be released.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _local_folder() -> str:
    global _local_root
    if _local_root is None:
        made = tempfile.mkdtemp(prefix="tallybrook-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_root = Path(made).as_uri()
    return _local_root


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path under the cluster's shared ``spark.checkpoint.dir``.

    Every executor must reach the folder, so a machine-local one is used only
    when the master itself is local and the setting is missing. Paths are never
    reused; how long the shared folder keeps them is the cluster's policy.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in a fresh folder, for a result that is read more than once.

    The shuffle files of the job are handed back at once. Spark deletes them when the
    driver happens to collect the garbage that refers to them, which for a long chain of
    jobs is after all of them have filled the disks.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def released(*tables: DataFrame) -> None:
    """Delete tables of :func:`written`, once all that is made of them is written itself.

    What was written since doesn't read them again, an executor that is lost included.
    On a session without a JVM at hand they stay, as other scratch tables do.
    """
    for table in tables:
        path, jvm = _paths.pop(table, None), getattr(table.sparkSession, "_jvm", None)
        if path is not None and jvm is not None:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
