"""Tables in the folder that the driver and all executors share, and files opened in tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset: a new temporary folder in local mode, which has one machine (tests),
    else a folder in the warehouse, which a cluster shares; it is set for the session then."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        local = spark.conf.get("spark.master", "").startswith("local")
        path = tempfile.mkdtemp(prefix="spark-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Paths that this process has given out and not yet cleared.
_given: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    _given.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _given[-1]


def clear(spark: SparkSession) -> int:
    """Delete what this process has written to the shared folder, once no result that reads it is needed any more; how
    many tables there were."""
    n, jvm = 0, spark.sparkContext._jvm
    while _given:
        path = jvm.org.apache.hadoop.fs.Path(_given.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def move(spark: SparkSession, path: str, folder: str | None) -> bool:
    """Move a file into ``folder``, or delete it where that is None; False if it is gone already."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    source = hadoop.Path(path)
    system = source.getFileSystem(conf)
    if folder is None:
        return bool(system.delete(source, False))
    if not system.exists(source):
        return False
    system.mkdirs(hadoop.Path(folder))
    if not system.rename(source, hadoop.Path(f"{folder.rstrip('/')}/{source.getName()}")):
        raise OSError(f"{path} can't be moved to {folder}")
    return True


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there was none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by ``columns`` to the session's number of shuffle partitions, for rows that are short but cost much, such as
    names of files: without a number adaptive execution joins partitions of few bytes, down to one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def open_path(path: str):
    """A seekable file by URI or path; Spark's ``file:/x`` has one slash where others want three."""
    from pyarrow import fs

    if ":/" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)
