"""Fragments and segments, in any order, against the messages that were sent."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from test_dns import dns_message, pcap, udp

from wirelens.operators import assembly, pairing
from wirelens.sources import capture

SCHEMA = "file string, seq long, ts timestamp_ntz, ip_version int, protocol int, ttl int, src string, src_port int, dst string, dst_port int, do_not_fragment boolean, frag_offset int, more_fragments boolean, ip_id long, tcp_seq long, tcp_flags int, payload binary"
C, S = ("10.0.0.9", 4000), ("198.51.100.53", 53)


def rows(spark, items):
    """Packets of dicts; seq and ts follow their place unless given."""
    out = []
    for i, x in enumerate(items):
        r = {"file": "f", "seq": i, "ms": i * 10, "ip_version": 4, "protocol": 6, "ttl": 64, "src": C[0], "src_port": C[1], "dst": S[0], "dst_port": S[1], "do_not_fragment": True, "frag_offset": 0, "more_fragments": False, "ip_id": 1, "tcp_seq": None, "tcp_flags": 24, "payload": b""} | x
        out.append(tuple(bytearray(v) if isinstance(v, bytes) else v for v in r.values()))
    return spark.createDataFrame(out, SCHEMA.replace("ts timestamp_ntz", "ms long")).withColumn("ts", F.timestamp_millis("ms").cast("timestamp_ntz")).drop("ms").repartition(3)


def framed(messages):
    return b"".join(struct.pack("!H", len(m)) + m for m in messages)


def got(df):
    return [(r["seq"], r["part"], bytes(r["payload"])) for r in df.orderBy("seq", "part").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_streams_in_any_order(spark, seed):
    """Segments cut anywhere, swapped, sent again whole or in part, numbers that wrap, streams with and without SYN."""
    r = random.Random(seed)
    sent, items = {}, []
    for port in range(4000, 4012):
        for connection in range(2):
            messages = [dns_message(r.randrange(65536), name="x" * r.randrange(1, 40) + ".nl") for _ in range(r.randrange(1, 9))]
            data, at, cuts = framed(messages), r.choice([5, 2**32 - 30, 2**31]) + connection * 99, []
            while sum(cuts) < len(data):
                cuts.append(r.randrange(1, 90))
            segs, place = [], 0
            for n in cuts:
                segs.append((place, data[place : place + n]))
                if r.random() < 0.3:
                    segs.append((place, data[place : place + max(1, n // 2)]))
                place += n
            syn = connection == 1 or r.random() < 0.5
            head, body = segs[:1], segs[1:]
            for i in range(0, len(body) - 1, 2):
                if r.random() < 0.5:
                    body[i], body[i + 1] = body[i + 1], body[i]
            own = [{"src_port": port, "tcp_seq": at % 2**32, "tcp_flags": 2}] * (1 + (r.random() < 0.3)) if syn else []
            own += [{"src_port": port, "tcp_seq": (at + syn + p) % 2**32, "payload": d} for p, d in head + body]
            items += own
            sent.setdefault(port, []).append(messages)
    out = {}
    for x in assembly.dns_payloads(rows(spark, items)).orderBy("seq", "part").collect():
        out.setdefault(x["src_port"], []).append(bytes(x["payload"]))
        assert (x["ttl"], x["protocol"], x["dst_port"], x["msg_len"]) == (64, 6, 53, len(x["payload"]))
    assert out == {p: a + b for p, (a, b) in sent.items()}


def test_time_is_of_the_packet_that_completes(spark):
    a, b = dns_message(1), dns_message(2)
    data = framed([a, b])
    items = [{"tcp_seq": 100 + 40, "payload": data[40:]}, {"tcp_seq": 100, "payload": data[:40], "ttl": 50}]
    items = [{"tcp_seq": 100, "payload": data[:5]}, {"tcp_seq": 140, "payload": data[40:]}, {"tcp_seq": 105, "payload": data[5:40], "ttl": 50}]
    out = assembly.dns_payloads(rows(spark, items)).orderBy("seq", "part").collect()
    assert [(r["seq"], r["part"], r["ttl"], r["ts"].microsecond, bytes(r["payload"])) for r in out] == [(2, 0, 50, 20_000, a), (2, 1, 50, 20_000, b)]


def test_holes(spark):
    m = [dns_message(i) for i in range(3)]
    data = framed(m)
    one = len(data) // 3
    hole = [{"tcp_seq": 0, "payload": data[:one]}, {"tcp_seq": 2 * one, "payload": data[2 * one :]}]
    assert [x[2] for x in got(assembly.dns_payloads(rows(spark, hole)))] == m[:1]
    late = [{"tcp_seq": 9, "tcp_flags": 2}, {"tcp_seq": 15, "payload": data}]
    assert got(assembly.dns_payloads(rows(spark, late))) == []
    short = [{"tcp_seq": 0, "payload": b"\0\3abc" + framed(m[:1]) + b"\0"}, {"tcp_seq": 0, "payload": framed(m), "src_port": 9, "dst_port": 99}]
    assert [x[2] for x in got(assembly.dns_payloads(rows(spark, short)))] == m[:1]
    assert got(assembly.dns_payloads(rows(spark, []))) == []


def test_handshake_is_on_the_first_message_only(spark):
    m = [dns_message(i) for i in range(2)]
    items = [{"tcp_seq": 9, "tcp_flags": 2}, {"src": S[0], "dst": C[0], "src_port": 53, "dst_port": C[1], "tcp_seq": 70, "tcp_flags": 18}, {"tcp_seq": 10, "tcp_flags": 16}, {"tcp_seq": 10, "payload": framed(m)}, {"src": S[0], "dst": C[0], "src_port": 53, "dst_port": C[1], "tcp_seq": 71, "payload": framed([dns_message(0, qr=1)])}]
    out = assembly.dns_payloads(rows(spark, items)).orderBy("seq", "part").collect()
    assert [(r["seq"], r["part"], r["tcp_rtt"]) for r in out] == [(3, 0, 10), (3, 1, None), (4, 0, None)]


def pieces(body, sizes, **more):
    out, at = [], 0
    for i, n in enumerate([*sizes, len(body)]):
        part = body[at : at + n]
        if part:
            out.append({"frag_offset": at, "more_fragments": at + len(part) < len(body), "payload": part, "src_port": None, "dst_port": None, "protocol": 17, **more})
        at += n
    return out


def test_fragments_become_datagrams(spark):
    a, b = dns_message(1, name="a" * 60 + ".nl"), dns_message(2, name="b" * 60 + ".nl")
    whole = lambda m: struct.pack("!HHHH", 4000, 53, 8 + len(m), 0) + m
    first = pieces(whole(a), [24, 32], ip_id=7, ttl=61)
    first[0]["ttl"] = 60
    swapped = [first[2], first[0], first[0], first[1]]
    again = pieces(whole(b), [48], ip_id=7)
    for x in again:
        x["ms"] = 10_000_000  # the same identification, long after
    holed = pieces(whole(a), [24, 32], ip_id=8)[::2]
    open_end = pieces(whole(a), [24, 32], ip_id=9)[:2]
    segment = struct.pack("!HHIIBBHHH", 4001, 53, 500, 0, 5 << 4, 24, 0, 0, 0) + framed([b])
    over_tcp = pieces(segment, [40], ip_id=10, protocol=6)
    v6 = pieces(whole(b), [64], ip_id=2**32 - 5, ip_version=6, src="2001:db8::1", dst="2001:db8::2")
    out = assembly.dns_payloads(rows(spark, [*swapped, *again, *holed, *open_end, *over_tcp, *v6])).orderBy("seq").collect()
    assert [(r["seq"], r["src_port"], r["dst_port"], r["ttl"], r["ip_version"], r["protocol"], bytes(r["payload"])) for r in out] == [
        (3, 4000, 53, 60, 4, 17, a), (5, 4000, 53, 64, 4, 17, b), (11, 4001, 53, 64, 4, 6, b), (13, 4000, 53, 64, 6, 17, b),
    ]


def test_captures_with_both_protocols_pair(spark):
    """A request over TCP and one over UDP in fragments pair with their responses, from bytes to pairs."""
    def tcp(src, dst, sport, dport, seq, payload):
        body = struct.pack("!HHIIBBHHH", sport, dport, seq, 0, 5 << 4, 24, 0, 0, 0) + payload
        ip = struct.pack("!BBHHHBBH", 0x45, 0, 20 + len(body), 1, 0x4000, 64, 6, 0) + bytes(map(int, src.split("."))) + bytes(map(int, dst.split(".")))
        return b"\0" * 12 + b"\x08\x00" + ip + body

    ask, say = framed([dns_message(1), dns_message(2, name="b.nl")]), framed([dns_message(2, qr=1, name="b.nl"), dns_message(1, qr=1)])
    data = struct.pack("!HHHH", 4000, 53, 0, 0) + dns_message(3)
    frames = [tcp(C[0], S[0], 4000, 53, 1, ask[:30]), tcp(C[0], S[0], 4000, 53, 31, ask[30:]), tcp(S[0], C[0], 53, 4000, 81, say[-20:]), tcp(S[0], C[0], 53, 4000, 1 + 80 - len(say[:-20]), say[:-20])]
    frames += [udp(C[0], S[0], 0, 0, b"", 5, 3, data[24:]), udp(C[0], S[0], 0, 0, b"", 5, 0x2000, data[:24]), udp(S[0], C[0], 53, 4000, dns_message(3, qr=1))]
    packets = capture.packets(spark.createDataFrame([("x.pcap", bytearray(pcap(frames)))], "path string, content binary"))
    m = capture.flat_messages(capture.messages(assembly.dns_payloads(packets)))
    p = pairing.transactions(m)
    assert sorted((r["a"], r["b"], r["p"]) for r in p.select(F.col("req.seq").alias("a"), F.col("rsp.seq").alias("b"), F.col("req.prot").alias("p")).collect()) == [(1, 3, 6), (1, 3, 6), (5, 6, 17)]
    stats = pairing.capture_stats(m, p, packets, 1000).first()
    assert (stats["packets"], stats["messages"], stats["matched"], stats["expired"]) == (7, 6, 3, 0)
