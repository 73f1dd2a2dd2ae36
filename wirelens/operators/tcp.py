"""Fragments and segments: reassembly and handshake round trip. Rows are grouped by datagram or flow; only the split
of a reassembled stream into messages needs a byte kernel."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FLOW = ("capture_file", "src", "src_port", "dst", "dst_port")
SYN, ACK = 2, 16


def reassemble_fragments(packets: DataFrame) -> DataFrame:
    """Whole datagrams of fragments (frag_offset in bytes): payload, number of fragments, offset of the last one.

    A datagram with a gap or without its last fragment is left out. Of a repeated fragment the one with the least ``seq``
    (what orders packets as they came) counts, or without that column the one with the least time, then content."""
    order = F.col("seq") if "seq" in packets.columns else F.struct("ts", "payload", "more_fragments")
    datagram = ["capture_file", "src", "dst", "ip_id", "protocol"]
    first = F.min_by(F.struct("frag_offset", "payload", "more_fragments"), order).alias("p")
    parts = packets.groupBy(*datagram, "frag_offset").agg(first, F.min_by("ts", order).alias("ts"))
    g = parts.groupBy(*datagram).agg(F.array_sort(F.collect_list("p")).alias("f"), F.min("ts").alias("ts"))
    end = F.aggregate("f", F.lit(0).cast("long"), lambda t, x: F.when(x["frag_offset"] == t, t + F.length(x["payload"])).otherwise(F.lit(-1)))
    whole = g.withColumn("_end", end).filter((F.col("_end") >= 0) & ~F.element_at("f", -1)["more_fragments"])
    payload = F.aggregate("f", F.lit(b""), lambda t, x: F.concat(t, x["payload"]))
    return whole.select("capture_file", "src", "dst", "ip_id", "protocol", "ts", F.size("f").alias("fragments"), F.element_at("f", -1)["frag_offset"].alias("last_offset"), payload.alias("payload"))


def contiguous(segments: DataFrame) -> DataFrame:
    """Segments in order without retransmissions, with ``gap`` true behind a hole.

    (capture_file, flow columns, tcp_seq, length, ...): a segment that adds nothing beyond the highest byte seen goes.
    ``place`` is the sequence number relative to the flow's first segment, so that numbers may wrap at 32 bits."""
    flow = Window.partitionBy(*FLOW)
    first = F.first("tcp_seq").over(flow.orderBy("ts", "tcp_seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    x = segments.filter("length > 0").withColumn("place", F.pmod(F.col("tcp_seq") - first + 2**31, F.lit(2**32)) - 2**31)
    w = flow.orderBy("place", F.desc("length"), "ts")
    x = x.withColumn("_seen", F.max(F.col("place") + F.col("length")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = x.filter(F.col("_seen").isNull() | (F.col("place") + F.col("length") > F.col("_seen")))
    return fresh.withColumn("gap", F.coalesce(F.col("place") > F.col("_seen"), F.lit(False))).withColumn("overlap", F.greatest(F.lit(0), F.coalesce(F.col("_seen") - F.col("place"), F.lit(0)))).drop("_seen")


def handshake_rtt(segments: DataFrame) -> DataFrame:
    """(flow of the client, rtt_ms): from SYN-ACK to the client's first ACK; none if the SYN was sent twice."""
    flags = F.col("tcp_flags").bitwiseAND(SYN + ACK)
    client = segments.filter(F.col("dst_port") == 53).groupBy("capture_file", "src", "src_port", "dst").agg(F.count_if(flags == SYN).alias("syns"), F.min(F.when(flags == ACK, F.unix_micros(F.col("ts").cast("timestamp")))).alias("ack"))
    server = segments.filter((F.col("src_port") == 53) & (flags == SYN + ACK)).groupBy("capture_file", F.col("dst").alias("src"), F.col("dst_port").alias("src_port"), F.col("src").alias("dst")).agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("synack"))
    both = client.filter("syns = 1 and ack is not null").join(server, ["capture_file", "src", "src_port", "dst"]).filter("ack >= synack")
    return both.select("capture_file", "src", "src_port", "dst", F.floor((F.col("ack") - F.col("synack")) / 1000).cast("int").alias("rtt_ms"))


def first_with_rtt(messages: DataFrame, rtt: DataFrame) -> DataFrame:
    """Adds tcp_rtt to the first message of each client flow only."""
    keys = ["capture_file", "src", "src_port", "dst"]
    w = Window.partitionBy(*keys).orderBy("ts", "seq", *(["part"] if "part" in messages.columns else []))
    x = messages.withColumn("_n", F.row_number().over(w)).join(rtt, keys, "left")
    return x.withColumn("tcp_rtt", F.when(F.col("_n") == 1, F.col("rtt_ms"))).drop("_n", "rtt_ms")


def split_messages(segments: DataFrame) -> DataFrame:
    """DNS messages of TCP streams (two-byte length before each): segments stream through in order, a message may
    span several; behind a gap the rest of the flow is dropped."""
    fields = [*FLOW, "n", "payload"]
    ordered = contiguous(segments.withColumn("length", F.length("payload"))).select(*FLOW, "place", "gap", F.expr("substring(payload, cast(overlap as int) + 1)").alias("payload"))
    ordered = ordered.repartition(*FLOW).sortWithinPartitions(*FLOW, "place")

    def run(batches):
        flow, held, dead, n = None, b"", False, 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                key = tuple(r[k] for k in FLOW)
                if key != flow:
                    flow, held, dead, n = key, b"", False, 0
                dead = dead or r["gap"]
                if dead:
                    continue
                held += r["payload"]
                while len(held) >= 2 and len(held) >= 2 + (size := int.from_bytes(held[:2])):
                    if size >= 12:
                        out.append({**dict(zip(FLOW, key)), "n": n, "payload": held[2 : 2 + size]})
                        n += 1
                    held = held[2 + size :]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(k, pa.int32() if k.endswith("port") or k == "n" else pa.binary() if k == "payload" else pa.string()) for k in fields]))

    return ordered.mapInArrow(run, ", ".join(f"{k} {'int' if k.endswith('port') or k == 'n' else 'binary' if k == 'payload' else 'string'}" for k in fields))
