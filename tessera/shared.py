"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def partitions_for(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a folder of this machine if all of Spark runs on it, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them can read")
        path = tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Spark removes a write's shuffle files when the write is done, instead of when the driver happens to collect its garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, held: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a block; afterwards they are what they were. Not for blocks that run beside each other."""
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_made: dict[str, list[str]] = {}  # tables of each application


def new_table(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables that operators of this application have written so far; to be called when their results are stored."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(df: DataFrame) -> None:
    """Delete the table of a DataFrame from ``written``, which nothing may read any more."""
    path = _paths.pop(df, None)
    if path:
        _made[df.sparkSession.sparkContext.applicationId].remove(path)
        _delete(df.sparkSession, path)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    It cuts lineage in a way that outlives executors, and lets several readers
    use one computation. The schema is passed on so that no file is opened to infer it.
    """
    path = new_table(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written and read again; the tables that it wrote on its way go, as nothing reads them any more."""
    before = set(_made.get(spark.sparkContext.applicationId, []))
    out = written(make(), name)
    made = _made[spark.sparkContext.applicationId]
    for path in [x for x in made if x not in before and x != _paths[out]]:
        _delete(spark, path)
        made.remove(path)
    return out


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what a folder holds; none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(place)) if files.exists(place) else []


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that nothing has yet; what another has renamed there meanwhile stays."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place(target)) or not files.rename(place(source), place(target)):
        raise FileExistsError(target)
