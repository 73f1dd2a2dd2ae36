"""Packets to DNS messages: fragments become datagrams, segments become streams and their messages, and both end in one
table with what the packets that brought them say (time, number, addresses, hop limit).

A message is there when its last missing packet is: its ``seq`` and ``ts`` are that packet's, and ``part`` numbers the
messages that one packet completes. Fragments shuffle by datagram, segments by flow; single-packet datagrams, nearly all
rows, aren't shuffled. A flow's segments stream through one task in order of their place, as where a message begins is
known from the ones before only; the task holds one message at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tcp import ACK, SYN, first_with_rtt, handshake_rtt

TCP, UDP = 6, 17
#: Seconds after which an identification may stand for another datagram.
REUSE_SECONDS = 60
#: A DNS message is no shorter.
LEAST_MESSAGE = 12
DATAGRAM = ("file", "src", "dst", "ip_id", "protocol")
FLOW = ("file", "src", "src_port", "dst", "dst_port")
FIELDS = ("file", "seq", "ts", "ip_version", "protocol", "ttl", "src", "src_port", "dst", "dst_port")


def _number(body: str, first: int, size: int) -> Column:
    """Big-endian number of ``size`` bytes from the ``first`` (from 1) of a binary column."""
    return F.conv(F.hex(F.substring(body, first, size)), 16, 10).cast("long")


def is_fragment() -> Column:
    return (F.col("frag_offset") > 0) | F.col("more_fragments")


def join_fragments(packets: DataFrame) -> DataFrame:
    """Fragments as whole packets, with ``payload`` behind their UDP or TCP header.

    The fragments of a datagram may come in any order and more than once (the first counts). One with a hole or an
    overlap, or without its last fragment, is left out. An identification that is seen again after ``REUSE_SECONDS``
    is another datagram's. Time and number are those of the fragment that made it whole, the hop limit is the first one's."""
    by = Window.partitionBy(*DATAGRAM).orderBy("seq")
    apart = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(by).cast("timestamp")) > REUSE_SECONDS * 1_000_000, F.lit(False))
    x = packets.filter(is_fragment()).withColumn("_apart", apart.cast("int")).withColumn("_use", F.sum("_apart").over(by))
    piece = F.struct("frag_offset", "payload", "more_fragments", "seq", "ts", "ttl", "ip_version")
    once = x.groupBy(*DATAGRAM, "_use", "frag_offset").agg(F.min_by(piece, "seq").alias("p"))
    g = once.groupBy(*DATAGRAM, "_use").agg(F.array_sort(F.collect_list("p")).alias("f"))
    end = F.aggregate("f", F.lit(0).cast("long"), lambda t, p: F.when(p["frag_offset"] == t, t + F.length(p["payload"])).otherwise(F.lit(-1)))
    whole = g.filter((end >= 0) & ~F.element_at("f", -1)["more_fragments"])
    latest = F.array_max(F.transform("f", lambda p: F.struct(p["seq"].alias("seq"), p["ts"].alias("ts"))))
    body = F.aggregate("f", F.lit(b""), lambda t, p: F.concat(t, p["payload"]))
    first = F.element_at("f", 1)
    x = whole.select(*DATAGRAM, latest.alias("_at"), first["ttl"].alias("ttl"), first["ip_version"].alias("ip_version"), body.alias("_body"))
    x = x.filter((F.col("protocol") == UDP) & (F.length("_body") >= 8) | (F.col("protocol") == TCP) & (F.length("_body") >= 20))
    tcp = F.col("protocol") == TCP
    skip = F.when(tcp, F.shiftright(_number("_body", 13, 1).cast("int"), 4) * 4).otherwise(8)
    return x.select(
        *DATAGRAM, F.col("_at.seq").alias("seq"), F.col("_at.ts").alias("ts"), "ip_version", "ttl", _number("_body", 1, 2).cast("int").alias("src_port"), _number("_body", 3, 2).cast("int").alias("dst_port"),
        F.when(tcp, _number("_body", 5, 4)).alias("tcp_seq"), F.when(tcp, _number("_body", 14, 1).cast("int")).alias("tcp_flags"), F.substring("_body", skip + 1, F.length("_body")).alias("payload"),
    )


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with data, in order of their ``place`` in the stream of their flow and connection, without what was
    there before (``overlap``), and with ``gap`` behind a hole. A SYN with another sequence number opens a new connection; a
    stream whose SYN isn't captured begins with its first segment."""
    flow = Window.partitionBy(*FLOW).orderBy("seq")
    up_to = flow.rowsBetween(Window.unboundedPreceding, 0)
    syn = F.col("tcp_flags").bitwiseAND(SYN) != 0
    before = F.last(F.when(syn, F.col("tcp_seq")), ignorenulls=True).over(flow.rowsBetween(Window.unboundedPreceding, -1))
    x = segments.withColumn("_opens", (syn & ~F.col("tcp_seq").eqNullSafe(before)).cast("int")).withColumn("connection", F.sum("_opens").over(up_to))
    own = Window.partitionBy(*FLOW, "connection").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    start = F.first(F.col("tcp_seq") + syn.cast("int")).over(own)
    x = x.withColumn("_begun", F.first("_opens").over(own)).withColumn("place", F.pmod(F.col("tcp_seq") + syn.cast("int") - start + 2**31, F.lit(2**32)) - 2**31)
    x = x.withColumn("_size", F.length("payload")).filter("_size > 0")
    w = Window.partitionBy(*FLOW, "connection").orderBy("place", F.desc("_size"), "seq")
    seen = F.max(F.col("place") + F.col("_size")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_seen", F.coalesce(seen, F.when(F.col("_begun") == 1, F.lit(0)).otherwise(F.col("place")).cast("long")))
    fresh = x.filter(F.col("place") + F.col("_size") > F.col("_seen"))
    return fresh.withColumn("gap", F.col("place") > F.col("_seen")).withColumn("overlap", F.greatest(F.lit(0), F.col("_seen") - F.col("place")).cast("int"))


def stream_messages(segments: DataFrame) -> DataFrame:
    """DNS messages of TCP segments (two bytes of length before each message): FIELDS, part and payload. Behind a hole
    the rest of the connection is left out, as nothing tells where the next message begins."""
    placed = _placed(segments).select(*FIELDS, "connection", "place", "gap", F.expr("substring(payload, overlap + 1)").alias("payload"))
    # The windows have dealt rows by flow; sorting keeps them where they are.
    ordered = placed.sortWithinPartitions(*FLOW, "connection", "place")
    schema = pa.schema([("file", pa.string()), ("seq", pa.int64()), ("ts", pa.timestamp("us")), *[(n, pa.int32()) for n in ("ip_version", "protocol", "ttl")], ("src", pa.string()), ("src_port", pa.int32()), ("dst", pa.string()), ("dst_port", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, held, dead, latest, part = None, bytearray(), False, None, 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                own = (*[r[k] for k in FLOW], r["connection"])
                if own != stream:
                    stream, held, dead, latest, part = own, bytearray(), False, None, 0
                dead = dead or r["gap"]
                if dead:
                    continue
                if latest is None or r["seq"] > latest["seq"]:
                    latest, part = {k: r[k] for k in FIELDS}, 0
                held += r["payload"]
                at = 0
                while len(held) >= at + 2 and len(held) >= at + 2 + (size := int.from_bytes(held[at : at + 2])):
                    if size >= LEAST_MESSAGE:
                        out.append({**latest, "part": part, "payload": bytes(held[at + 2 : at + 2 + size])})
                        part += 1
                    at += 2 + size
                del held[:at]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return ordered.mapInArrow(run, "file string, seq long, ts timestamp_ntz, ip_version int, protocol int, ttl int, src string, src_port int, dst string, dst_port int, part int, payload binary")


def dns_payloads(packets: DataFrame, port: int = 53) -> DataFrame:
    """All DNS messages of ``packets`` (a written table: it is read once for datagrams, fragments, segments and handshakes each,
    with filters that reach its files; out of captures each would unpack them anew) with a port on either side, over both protocols: FIELDS, part, msg_len, tcp_rtt (on a
    client's first message of a connection whose handshake was captured) and payload."""
    near = (F.col("src_port") == port) | (F.col("dst_port") == port)
    columns = [*FIELDS, "tcp_seq", "tcp_flags", "payload"]
    whole = packets.filter(~is_fragment() & F.col("protocol").isin(TCP, UDP)).select(*columns).unionByName(join_fragments(packets).select(*columns)).filter(near)
    plain = whole.filter(F.col("protocol") == UDP).select(*FIELDS, F.lit(0).alias("part"), F.lit(None).cast("int").alias("tcp_rtt"), "payload")
    segments = whole.filter((F.col("protocol") == TCP) & F.col("tcp_seq").isNotNull())
    rtt = handshake_rtt(segments.filter(F.col("tcp_flags").bitwiseAND(SYN + ACK) != 0).withColumnRenamed("file", "capture_file"))
    streams = first_with_rtt(stream_messages(segments).withColumnRenamed("file", "capture_file"), rtt).withColumnRenamed("capture_file", "file")
    return plain.unionByName(streams.select(plain.columns)).withColumn("msg_len", F.length("payload"))
