"""Reading the given tables and writing intermediate ones to the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of its own only where that is unset and
    everything runs on one machine, as in tests."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="footfall-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, deleted when the application ends."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


#: Folders of the tables that `stored` has written and nobody has dropped, oldest first.
_live: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder: computed once, without lineage, safe when executors go."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    _live.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """`make()` as a stored table. The tables that were stored on the way are deleted as soon as it is written."""
    first = len(_live)
    out = stored(make(), name)
    for path in _live[first:-1]:
        delete(spark, path)
    del _live[first:-1]
    return out


def drop_stored(spark: SparkSession, first: int = 0) -> None:
    """Delete the stored tables from the `first` on: for callers that have written all that reads them."""
    for path in _live[first:]:
        delete(spark, path)
    del _live[first:]


def count_stored() -> int:
    return len(_live)
