"""Capture objects: notifications, discovery, claims and states, and figures per server."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import supported_format

#: Event names that announce an object.
EVENTS = ("put", "completemultipartupload", "puttagging", "deletetagging")
NOTIFICATION = "struct<Records:array<struct<eventName:string,s3:struct<bucket:struct<name:string>,object:struct<key:string,size:long>>>>>"


def notifications(messages: DataFrame, body: str = "body", drop_empty: bool = True) -> DataFrame:
    """(bucket, key, size, event) from JSON messages; keys decoded, known events, one row per object.

    The event's last part counts (``ObjectCreated:Put``), without regard to case."""
    record = F.explode(F.from_json(F.col(body), NOTIFICATION)["Records"]).alias("r")
    event = F.element_at(F.split(F.lower("r.eventName"), ":"), -1)
    x = messages.select(record).select(F.col("r.s3.bucket.name").alias("bucket"), F.url_decode("r.s3.object.key").alias("key"), F.col("r.s3.object.size").alias("size"), event.alias("event"))
    x = x.filter(F.col("event").isin(*EVENTS))
    if drop_empty:
        x = x.filter(F.col("size") > 0)
    name = F.regexp_replace(F.concat("bucket", F.lit("/"), "key"), r"\s+", "")
    return x.withColumn("_name", name).groupBy("_name").agg(F.min(F.struct("bucket", "key", "size", "event")).alias("o")).select("o.*")


def new_objects(listing: DataFrame, ledger: DataFrame, prefixes: tuple[str, ...] = ("pcap-in/",)) -> DataFrame:
    """Objects under the prefixes, of known formats, that the ledger doesn't have, in key order."""
    under = F.lit(False)
    for p in prefixes:
        under = under | F.col("object_key").startswith(p)
    return listing.filter(under & supported_format("object_key")).join(ledger.select("object_key").distinct(), "object_key", "left_anti").orderBy("object_key")


def object_state(ledger: DataFrame, now: Column, max_proc: int, max_wait: int) -> DataFrame:
    """Adds state: exhausted, incomplete, done, claimed, not_picked_up or waiting, tested in this order."""
    later = lambda c, s: F.col(c) + F.make_interval(secs=F.lit(s)) < now
    state = (
        F.when(F.col("max_tries_reached"), "exhausted")
        .when(F.col("started").isNotNull() & F.col("ended").isNull() & later("started", max_proc), "incomplete")
        .when(F.col("started").isNotNull(), F.when(F.col("ended").isNotNull(), "done").otherwise("claimed"))
        .when(F.col("detected") & later("modified", max_wait), "not_picked_up")
        .otherwise("waiting")
    )
    return ledger.withColumn("state", state)


def tags(text: str | Column) -> Column:
    """Map of an object's tags from their JSON form; null for text that is none."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, "map<string,string>")


def claimable(objects: DataFrame, ledger: DataFrame, max_tries: int) -> DataFrame:
    """Objects that may be taken up: none that the ledger (object_key, started, ended, tries, max_tries_reached) has as claimed,
    done or tried too often. Of several entries of an object any one rules it out."""
    taken = F.col("started").isNotNull() | F.coalesce(F.col("max_tries_reached"), F.lit(False)) | (F.coalesce("tries", F.lit(0)) >= max_tries)
    return objects.join(ledger.filter(taken).select("object_key").distinct(), "object_key", "left_anti")


def stale(modified: Column, now: Column, max_age_hours: int = 24) -> Column:
    """Reference data without a date or older than the age."""
    return F.coalesce(modified + F.make_interval(hours=F.lit(max_age_hours)) < now, F.lit(True))


def ingest_stats(states: DataFrame) -> DataFrame:
    """Objects, bytes, tries and seconds of work by server, site and state."""
    took = (F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 1_000_000
    return states.groupBy("server", "site", "state").agg(F.count("*").alias("objects"), F.sum("size_bytes").alias("bytes"), F.avg("tries").alias("avg_tries"), F.avg(took).alias("avg_seconds"), F.max(took).alias("most_seconds"))
