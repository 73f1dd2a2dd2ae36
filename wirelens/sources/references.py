"""Dated snapshots of reference lists: each row is enriched by the list as it was at the row's time, so a list that changes
changes what came later only, also when captures are read again or late."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def save(rows: DataFrame, path: str, taken: datetime) -> None:
    """Keep a list as it is at ``taken``; a snapshot that is taken again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/taken={taken:%Y%m%d%H%M%S}")


def snapshots(spark: SparkSession, path: str) -> list[datetime]:
    """When the list was taken, ascending: one entry a refresh, from the folders' names."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        names = found.select(F.regexp_extract("path", "/taken=([0-9]{14})/", 1).alias("t")).filter("t <> ''").distinct().collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(datetime.strptime(r["t"], "%Y%m%d%H%M%S") for r in names)


def read(spark: SparkSession, path: str, taken: datetime) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/taken={taken:%Y%m%d%H%M%S}")


def as_of(taken: list[datetime], at: Column) -> Column:
    """The latest of ``taken`` that isn't after ``at``; the first one for what is older than all; null for no time."""
    times = F.array(*[F.lit(t).cast("timestamp_ntz") for t in sorted(taken)])
    return F.when(at.isNotNull(), F.coalesce(F.array_max(F.filter(times, lambda t: t <= at)), F.lit(min(taken)).cast("timestamp_ntz")))


def by_snapshot(rows: DataFrame, path: str, at: str, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``build(rows, list)`` for the rows of each snapshot that holds for some time in ``at``, together. Rows without a time
    take the latest list. The number of plans is that of the snapshots between the rows' first and last time."""
    spark = rows.sparkSession
    taken = snapshots(spark, path)
    if not taken:
        raise ValueError(f"no list was taken under {path}")
    first, last, missing = rows.select(F.min(as_of(taken, F.col(at))), F.max(as_of(taken, F.col(at))), F.count_if(F.col(at).isNull())).first()
    used = [t for t in taken if first is not None and first <= t <= last]
    if missing and taken[-1] not in used or not used:
        used.append(taken[-1])
    out = None
    for t in used:
        own = F.coalesce(as_of(taken, F.col(at)), F.lit(taken[-1]).cast("timestamp_ntz")) == F.lit(t).cast("timestamp_ntz")
        part = build(rows.filter(own), read(spark, path, t))
        out = part if out is None else out.unionByName(part)
    return out
