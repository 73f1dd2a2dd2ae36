"""Requests paired with responses, as windows over the messages of a capture file.

A response pairs with the message right before it of the same key if that is a request; a request that another one
follows is overwritten; a last request stays unmatched. So pairing needs no join. The windows of transfers and of
pairing share the shuffle on (file, id, client address, client port).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import TRANSFERS, ascii_lower

CLIENT = ("capture_file", "dns_id", "client_ip", "client_port")


def dns_only(packets: DataFrame, port: int = 53) -> DataFrame:
    """TCP or UDP packets with the DNS port on either side."""
    return packets.filter(F.col("prot").isin(6, 17) & ((F.col("src_port") == port) | (F.col("dst_port") == port)))


def _order(messages: DataFrame) -> list[str]:
    """Messages that one packet completed follow by ``part``."""
    return [c for c in ("ts", "seq", "part") if c in messages.columns]


def drop_transfers(messages: DataFrame) -> DataFrame:
    """Without zone-transfer requests, and with only the first response of each transfer."""
    transfer = (F.col("qr") == 0) & F.col("qtype").isin(*TRANSFERS)
    client = Window.partitionBy(*CLIENT).orderBy(*_order(messages))
    epoch = messages.withColumn("_epoch", F.sum(transfer.cast("int")).over(client.rowsBetween(Window.unboundedPreceding, 0)))
    # Responses since the transfer's request: all so far less those before it.
    so_far = F.sum("qr").over(client.rowsBetween(Window.unboundedPreceding, 0))
    counted = epoch.withColumn("_so_far", so_far).withColumn("_at_request", F.max(F.when(transfer, F.col("_so_far"))).over(client.rowsBetween(Window.unboundedPreceding, 0)))
    late = (F.col("qr") == 1) & (F.col("_epoch") > 0) & (F.col("_so_far") - F.col("_at_request") > 1)
    return counted.filter(~transfer & ~late).drop("_epoch", "_so_far", "_at_request")


def transactions(messages: DataFrame, keep_retransmits: bool = False, fold_case: bool = False) -> DataFrame:
    """(capture_file, req, rsp): matched pairs, responses alone (with a question) and requests alone.

    ``keep_retransmits`` also keeps overwritten requests; ``fold_case`` pairs names without regard to case.
    """
    kept = drop_transfers(messages)
    name = ascii_lower("qname") if fold_case else F.col("qname")
    key = Window.partitionBy(*CLIENT, name).orderBy(*_order(messages))
    fields = F.struct(*messages.columns)
    near = kept.select("capture_file", "qr", "qname", fields.alias("this"), F.lag(fields).over(key).alias("before"), F.lead("qr").over(key).alias("next"))
    alone = (F.col("next").isNull() | (F.lit(keep_retransmits) & (F.col("next") == 0))) & F.col("qname").isNotNull()
    paired = F.col("before.qr") == 0
    rows = near.filter(((F.col("qr") == 1) & (F.coalesce(paired, F.lit(False)) | F.col("qname").isNotNull())) | ((F.col("qr") == 0) & alone))
    req = F.when(F.col("qr") == 0, F.col("this")).when(paired, F.col("before"))
    return rows.select("capture_file", req.alias("req"), F.when(F.col("qr") == 1, F.col("this")).alias("rsp"))


def unmatched_requests(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("rsp").isNull())


def capture_stats(messages: DataFrame, pairs: DataFrame, packets: DataFrame | None = None, expiry_ms: int | None = None) -> DataFrame:
    """Per file: messages, requests, responses, matched and unmatched; with ``packets`` (file) their number, with
    ``expiry_ms`` the unmatched requests that had waited that long when the file's last message came."""
    seen = messages.groupBy("capture_file").agg(F.count("*").alias("messages"), F.count_if(F.col("qr") == 0).alias("requests"), F.count_if(F.col("qr") == 1).alias("responses"))
    both = F.col("req").isNotNull() & F.col("rsp").isNotNull()
    made = pairs.groupBy("capture_file").agg(F.count_if(both).alias("matched"), F.count_if(F.col("rsp").isNull()).alias("unmatched"), F.count_if(F.col("req").isNull()).alias("response_only"))
    out, more = seen.join(made, "capture_file", "left"), []
    if expiry_ms is not None:
        last = messages.groupBy("capture_file").agg(F.max("ts").alias("_last"))
        late = pairs.filter("rsp IS NULL").select("capture_file", F.col("req.ts").alias("_ts")).join(last, "capture_file")
        late = late.filter(F.col("_ts") + F.make_interval(secs=F.lit(expiry_ms / 1000)) <= F.col("_last"))
        out, more = out.join(late.groupBy("capture_file").agg(F.count("*").alias("expired")), "capture_file", "left"), ["expired"]
    if packets is not None:
        out, more = packets.groupBy(F.col("file").alias("capture_file")).agg(F.count("*").alias("packets")).join(out, "capture_file", "left"), [*more, "packets"]
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("messages", "requests", "responses", "matched", "unmatched", "response_only", *more)]
    return out.select("capture_file", *zero)
