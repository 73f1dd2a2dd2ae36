"""Attempts at captures: which are due, what is given up, and where a retry goes on.

The ledger has one row per attempt (object_key, batch, records, failure, seconds, at): ``records`` of the file had been
given when it ended, ``failure`` is null where it ended well. A file that failed is tried again, from behind the records
that it has given, until it ends well or has been tried ``max_tries`` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTEMPTS = "object_key string, length long, records long, failure string, seconds double, at timestamp, batch long"


def states(attempts: DataFrame, max_tries: int) -> DataFrame:
    """(object_key, length, tries, records, failure, seconds, state) of each object; the state is done, failed or exhausted.
    The failure is that of the last attempt, null where one ended well."""
    latest = F.struct("at", "batch")
    g = attempts.groupBy("object_key").agg(
        F.max_by("length", latest).alias("length"), F.count("*").alias("tries"), F.max("records").alias("records"),
        F.max(F.col("failure").isNull()).alias("_done"), F.max_by(F.struct("failure"), latest)["failure"].alias("_failure"), F.sum("seconds").alias("seconds"),
    )
    state = F.when(F.col("_done"), "done").when(F.col("tries") >= max_tries, "exhausted").otherwise("failed")
    return g.select("object_key", "length", "tries", "records", F.when(~F.col("_done"), F.col("_failure")).alias("failure"), "seconds", state.alias("state"))


def due(files: DataFrame, attempts: DataFrame, max_tries: int) -> DataFrame:
    """(path, length, skip): ``files`` (path, length) that were never tried, and those that failed and may be tried again,
    with the number of records that they have given. A file listed twice is due once."""
    known = states(attempts, max_tries)
    fresh = files.groupBy("path").agg(F.max("length").alias("length")).join(known, F.col("path") == F.col("object_key"), "left_anti").select("path", "length", F.lit(0).cast("long").alias("skip"))
    return fresh.unionByName(known.filter("state = 'failed'").select(F.col("object_key").alias("path"), "length", F.col("records").alias("skip")))


def outcomes(due: DataFrame, endings: DataFrame) -> DataFrame:
    """(object_key, length, records, failure) of what was due: a file without an ending was gone or had nothing in it."""
    joined = due.join(endings.withColumnRenamed("file", "path"), "path", "left")
    failure = F.when(F.col("records").isNull(), F.lit("can't be opened")).otherwise(F.col("failure"))
    return joined.select(F.col("path").alias("object_key"), "length", F.greatest("skip", F.coalesce("records", F.lit(0))).alias("records"), failure.alias("failure"))
