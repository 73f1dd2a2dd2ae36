"""Traffic metrics in bins of packet time, from dns rows, in one pass over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import time_bin, type_name

PLACE = ("server", "server_location")


def counts_by(rows: DataFrame, tag: Column, name: str, seconds: int = 10) -> DataFrame:
    """(bin, server, server_location, <name>, n) where the tag isn't null."""
    return rows.withColumn("bin", time_bin("time", seconds)).withColumn(name, tag).filter(F.col(name).isNotNull()).groupBy("bin", *PLACE, name).agg(F.count("*").alias("n"))


def counters(rows: DataFrame, seconds: int = 10) -> DataFrame:
    """Requests and responses per bin; ``has_request`` and ``has_response`` tell which sides a row has."""
    return rows.withColumn("bin", time_bin("time", seconds)).groupBy("bin", *PLACE).agg(F.count_if("has_request").alias("requests"), F.count_if("has_response").alias("responses"))


def averages(rows: DataFrame, value: str, seconds: int = 10) -> DataFrame:
    """avg, sample, min and max per bin of a value where there is one."""
    x = rows.filter(F.col(value).isNotNull()).withColumn("bin", time_bin("time", seconds))
    v = F.col(value)
    return x.groupBy("bin", *PLACE).agg(F.avg(v).alias("avg"), F.count("*").alias("sample"), F.min(v).alias("min"), F.max(v).alias("max"))


def measures(include_unpaired_zero: bool = False) -> Column:
    """A row's measures: array of (metric, tag, v, counter) with a value; v is 1 for counters."""
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    proc = F.coalesce(F.col("dns_proc_time"), F.lit(0)) if include_unpaired_zero else F.col("dns_proc_time")
    rtt = F.when(F.col("prot") == 6, F.col("tcp_rtt"))
    found = [
        ("dns_request", none, F.when(F.col("has_request"), 1), True), ("dns_response", none, F.when(F.col("has_response"), 1), True),
        ("dns_qtype", type_name("dns_qtype"), F.when(F.col("dns_qtype").isNotNull(), 1), True), ("dns_rcode", text("dns_rcode"), F.lit(1), True), ("dns_opcode", text("dns_opcode"), F.lit(1), True),
        ("geo_country", F.col("ip_geo_country"), F.when(F.length("ip_geo_country") > 0, 1), True), ("network_protocol", F.when(F.col("prot") == 17, "UDP").otherwise("TCP"), F.lit(1), True),
        ("ip_version", F.when(F.col("ip_version") == 4, "4").otherwise("6"), F.lit(1), True), ("tcp_rtt", none, rtt, False), ("dns_proc_time", none, proc, False),
    ]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), t.alias("tag"), v.cast("long").alias("v"), F.lit(c).alias("counter")) for m, t, v, c in found])
    return F.filter(cells, lambda c: c["v"].isNotNull())


def points() -> Column:
    """Points (type, value) of a group's sum, n, lo and hi: one of a counter, four of an average."""
    point = lambda kind, v: F.struct(F.lit(kind).alias("type"), v.cast("double").alias("value"))
    four = F.array(point("avg", F.col("sum") / F.col("n")), point("sample", F.col("n")), point("min", F.col("lo")), point("max", F.col("hi")))
    return F.when(F.col("counter"), F.array(point("count", F.col("sum")))).otherwise(four)


def metric_points(rows: DataFrame, seconds: int = 10, include_unpaired_zero: bool = False) -> DataFrame:
    """Long form (metric, bin, tag, server, server_location, type, value): each row's measures are unrolled and
    grouped once; counters have one point, averages four."""
    x = rows.withColumn("bin", time_bin("time", seconds)).select("bin", *PLACE, F.inline(measures(include_unpaired_zero)))
    g = x.groupBy("metric", "bin", "tag", *PLACE, "counter").agg(F.sum("v").alias("sum"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    return g.select("metric", "bin", "tag", *PLACE, F.inline(points()))
