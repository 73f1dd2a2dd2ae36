"""Compaction of the day-partitioned table: small files that frequent appends leave are packed, day by day, into files near a
target size. Files of the target size or more, and days with nothing to join, aren't read.

Packed files are first written to a folder of the table that readers skip, then a plan of the swap is noted in another, and only then files are moved and deleted. A run that is lost before the note has changed nothing; one
that is lost behind it is finished by the next call. A reader should not run during the swap itself.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.rows import DDL
from .shared import cut, delete, move
from .sinks import NO_BATCH, table_files

#: Small files of one round; a table with more takes several.
FILES_AT_ONCE = 5000


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, day, batch) of the table's files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", "length")
    part = lambda name: F.url_decode(F.regexp_extract("path", f"/{name}=([^/]+)/", 1))
    return files.select("path", "length", part("day").alias("day"), part("batch").cast("long").alias("batch"))


def packed(files: DataFrame, target_bytes: int, settled: int | None = None) -> DataFrame:
    """(path, length, day, bin): the small files that are to be joined; a day's files are laid end to end by size, and each
    stretch of ``target_bytes`` is a bin. Bins of one file are left as they are."""
    small = files.filter(F.col("length") < target_bytes)
    if settled is not None:
        small = small.filter(F.col("batch") < settled)
    order = Window.partitionBy("day").orderBy("length", "path")
    at = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    x = small.withColumn("bin", F.floor(at / target_bytes)).withColumn("n", F.count("*").over(Window.partitionBy("day", "bin")))
    return x.filter("n > 1").select("path", "length", "day", "bin")


def compact(spark: SparkSession, path: str, target_bytes: int = 256 << 20, sort: str = "dns_domainname", settled: int | None = None) -> int:
    """Pack the table's small files; how many went. With ``settled``, batches from that number on are left, since they may
    yet be run again and replace their files."""
    path, gone = path.rstrip("/"), finish(spark, path.rstrip("/"))
    while True:
        files = listing(spark, path)
        least = files.agg(F.min("batch")).first()[0]
        # Whole bins only, the smallest days' first.
        bins = cut(packed(files, target_bytes, settled))
        order = Window.orderBy("day", "bin")
        sizes = bins.groupBy("day", "bin").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
        rounds = sizes.withColumn("upto", F.sum("n").over(order)).filter((F.col("upto") <= FILES_AT_ONCE) | (F.col("upto") == F.col("n"))).withColumn("number", F.row_number().over(order))
        plan = bins.join(F.broadcast(rounds.select("day", "bin", "number")), ["day", "bin"]).select("path", "number").toArrow()
        if plan.num_rows == 0:
            return gone
        paths = plan.column("path").to_pylist()
        number = spark.createDataFrame(plan.to_pandas()).select(F.col("path").alias("_path"), F.col("number").cast("long"))
        # Each bin is a batch of its own below all others, so that it becomes files of its own.
        rows = spark.read.schema(f"{DDL}, day date, batch long").option("basePath", path).parquet(*paths).withColumn("_path", F.col("_metadata.file_path"))
        rows = rows.join(F.broadcast(number), "_path").withColumn("batch", F.lit(min(least, NO_BATCH)) - F.col("number")).drop("_path", "number")
        n_bins = max(plan.column("number").to_pylist())
        staged = f"{path}/_compacted-{uuid.uuid4().hex}"
        order = [F.col("day"), F.col("batch"), F.asc_nulls_last(sort)]
        table_files(rows.repartitionByRange(n_bins, "batch").sortWithinPartitions(*order).write).parquet(staged)
        number.select("_path", F.lit(staged).alias("staged")).write.parquet(f"{path}/_compaction")
        gone += finish(spark, path)


def finish(spark: SparkSession, path: str) -> int:
    """Carry out the swap that was noted, if there is one; how many small files went."""
    try:
        noted = spark.read.schema("_path string, staged string").parquet(f"{path}/_compaction").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    if noted:
        staged = noted[0]["staged"]
        for row in listing(spark, staged).collect() if exists(spark, staged) else []:
            move(spark, row["path"], f"{path}/day={row['day']}/batch={row['batch']}")
        for row in noted:
            delete(spark, row["_path"])
        delete(spark, staged)
    delete(spark, f"{path}/_compaction")
    return len(noted)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place))
