"""Capture files are scanned by many tasks, though their names are few bytes."""

from pyspark.sql import functions as F

from wirelens.plans import queries as Q
from wirelens.plans import views as V
from wirelens.sources import capture


def test_files_are_dealt_to_tasks(spark, sf, tmp_path):
    V.capture_files(V.captures(Q.messages(spark, sf).filter("seq < 8 * 500").withColumn("seq", F.col("seq") * 4)), str(tmp_path))
    x = capture.scan_files(spark, capture.read_captures(spark, str(tmp_path)).select("path", "length"), block_bytes=10_000)
    got = x.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(got) > 1
