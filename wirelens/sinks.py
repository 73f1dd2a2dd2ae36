"""The day-partitioned, domain-sorted table, metric points, and the ledger of captures."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .operators.attempts import ATTEMPTS
from .operators.rows import DDL


#: What rows are filed under that no batch wrote.
NO_BATCH = -1


def day(ts: str = "time") -> Column:
    return F.to_date(ts)


def write_dns(rows: DataFrame, path: str, sort: str | None = "dns_domainname", rows_per_file: int = 10_000_000, tasks: int | None = None, bloom: bool = True, batch: int | None = None) -> None:
    """Append rows as Parquet (zstd) by day, sorted in each file by ``sort`` (nulls last), so row groups can be skipped.

    With a ``batch`` number, whatever that batch has written before is replaced, so a batch that is run again after a
    failure leaves its rows once; it must hold the same days.

    Rows are dealt by ranges of (day, sort column, client port): a busy day, or a busy domain within it, goes to as many
    tasks as its share of the rows asks for. ``tasks`` is the number of ranges (the session's shuffle partitions if
    unset). An unknown sort column leaves the order as it is.
    """
    x = rows.withColumn("day", day())
    if sort and sort in rows.columns:
        spread = [F.col("prot_src_port")] if "prot_src_port" in rows.columns else []
        order = [F.col("day"), F.asc_nulls_last(sort)]
        x = (x.repartitionByRange(tasks, *order, *spread) if tasks else x.repartitionByRange(*order, *spread)).sortWithinPartitions(*order)
    x = x.withColumn("batch", F.lit(NO_BATCH if batch is None else batch).cast("long"))
    w = x.write.mode("append") if batch is None else x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    table_files(w, rows_per_file, bloom).parquet(path)


def table_files(w: DataFrameWriter, rows_per_file: int = 10_000_000, bloom: bool = True) -> DataFrameWriter:
    """The table's layout: folders by day and batch, zstd, Bloom filter of domains."""
    w = w.partitionBy("day", "batch").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if bloom:
        w = w.option("parquet.bloom.filter.enabled#dns_domainname", "true").option("parquet.bloom.filter.max.bytes", 1 << 20).option("parquet.dictionary.page.size", 2 << 20)
    return w


def read_dns(spark: SparkSession, path: str) -> DataFrame:
    """The written table; a filter on ``day`` reads that day's folder only. Columns that older files lack are null."""
    return spark.read.schema(f"{DDL}, day date, batch long").parquet(path).drop("batch")


def write_points(points: DataFrame, path: str) -> None:
    """Append metric points, by metric."""
    points.write.mode("append").partitionBy("metric").parquet(path)


def dispose(objects: DataFrame, path: str) -> None:
    """Append what became of each capture (object_key, state, ended) to the ledger."""
    objects.select("object_key", "state", "ended").write.mode("append").parquet(path)


def note_attempts(spark: SparkSession, outcomes: DataFrame, path: str, batch: int, seconds: float) -> None:
    """Write a batch's attempts (object_key, length, records, failure) to the ledger, once however often it is run."""
    rows = outcomes.withColumns({"seconds": F.lit(float(seconds)), "at": F.current_timestamp()})
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of attempts; empty where nothing was noted yet."""
    try:
        return spark.read.schema(ATTEMPTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ATTEMPTS)


def report_malformed(malformed: DataFrame, path: str) -> None:
    """Append messages that could not be decoded (file, seq, ts, reason) to their ledger."""
    malformed.select("file", "seq", "ts", "reason").write.mode("append").parquet(path)
