"""A folder that driver and executors share, for tables written and read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
_stored: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """A folder of our own below spark.checkpoint.dir. Where that is unset, a temporary folder in local mode; on a cluster it has to be set."""
    context = spark.sparkContext
    if context.applicationId not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.split("[")[0] == "local":
                raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
            own = tempfile.mkdtemp(prefix="chapterloom-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            base = f"file://{own}"
        _folders[context.applicationId] = f"{base.rstrip('/')}/chapterloom-{uuid.uuid4().hex}"
    return _folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    _stored.append(path)
    return stored


def delete(spark: SparkSession, path: str) -> None:
    """Deletes what lies under a path of ours."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def discard(stored: DataFrame) -> None:
    """Deletes a table that store() gave, when all that was made from it is stored itself."""
    delete(stored.sparkSession, stored._stored_at)


def store_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stores what make() gives, then deletes every other table that store() has written meanwhile."""
    first = len(_stored)
    made = store(make(), name)
    for path in _stored[first:-1]:
        delete(spark, path)
    del _stored[first:-1]
    return made


def drop_scratch(spark: SparkSession) -> None:
    """Deletes every table that store() has written for this application; call it when results are saved."""
    path = _folders.pop(spark.sparkContext.applicationId, None)
    if path:
        delete(spark, path)
