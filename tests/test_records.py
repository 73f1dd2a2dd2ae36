"""Captures by ranges against whole reads; damage; link types and extension headers."""

import bz2
import gzip
import io
import random
import struct

import pytest
from pyspark.sql import functions as F

from test_dns import dns_message, pcap, udp
from wirelens.sources import capture, frames, records


def whole(path, data):
    out, n, why = [], 0, None
    f = io.BytesIO(data)
    try:
        lay = records.layout(f.read(24))
        for _, ts, frame in records.records(f, lay):
            out.append((n, ts, frame))
            n += 1
    except records.Damaged as e:
        why = str(e)
    return out, n, why


def by_blocks(data, block):
    """The stitching of ``records.stitched`` in plain Python over ``walk_block``."""
    count = max(1, -(-len(data) // block))
    rows = [{"file": "x", "size": len(data), "block": k, "begin": k * block, "stop": (k + 1) * block, "start": None} for k in range(count)]
    walks = [records.walk_block(io.BytesIO(data), r) for r in rows]
    wrong = 0
    while True:
        bad = [k for k in range(1, count) if walks[k - 1].next is not None and walks[k].start != walks[k - 1].next]
        if not bad:
            return walks, wrong
        wrong += len(bad)
        walks = [records.walk_block(io.BytesIO(data), {**r, "start": walks[k - 1].next}) if k in bad else walks[k] for k, r in enumerate(rows)]


def test_all_block_sizes_find_the_same_records():
    r = random.Random(1)
    inner = pcap([udp("10.0.0.1", "10.0.0.2", 1, 53, dns_message()) for _ in range(30)])
    kinds = [lambda: bytes(r.randrange(256) for _ in range(r.randrange(60, 400))), lambda: inner, lambda: inner[24:], lambda: b"\0" * 300, lambda: struct.pack("<IIII", 1_700_000_000, 5, 64, 64) * 12, lambda: b""]
    for order in "<>":
        data = struct.pack(order + "IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
        starts = []
        for i in range(150):
            frame = r.choice(kinds)()
            starts.append(len(data))
            data += struct.pack(order + "IIII", 1_700_000_000 + i, i, len(frame), len(frame)) + frame
        for block in (50, 333, 1000, 4096, 20_000, 10**6):
            walks, _ = by_blocks(data, block)
            assert sum(w.records for w in walks) == 150 and walks[-1].next == len(data)
            for k, w in enumerate(walks):
                assert w.start == min((s for s in starts if s >= k * block), default=len(data)), (block, k)


def test_guesses_are_mostly_right():
    r = random.Random(2)
    one = [udp("10.0.0.1", "10.0.0.2", 1, 53, bytes(r.randrange(256) for _ in range(100))) for _ in range(900)]
    data = pcap(one) + pcap(one)[24:] + pcap(one)[24:]
    assert by_blocks(data, 10_000)[1] == 0


FAULTS = {
    "fine.pcap": lambda d: d, "cut.pcap": lambda d: d[:-10], "header.pcap": lambda d: d + b"\1\2\3", "long.pcap": lambda d: d[:24 + 2 * 92] + struct.pack("<IIII", 1_700_000_000, 0, 2**31, 2**31) + d[24 + 2 * 92 :],
    "short.pcap": lambda d: d[:20], "other.pcap": lambda d: b"PK\3\4" + d[4:], "fine.pcap.gz": gzip.compress, "cut.pcap.gz": lambda d: gzip.compress(d)[:-30], "false.pcap.gz": lambda d: d, "fine.pcap.bz2": bz2.compress, "false.pcap.bz2": lambda d: b"BZh9" + d, "cut.pcap.xz": lambda d: __import__("lzma").compress(d)[:-30], "big.pcap": lambda d: d[:24] + d[24:] * 40,
}


@pytest.fixture(scope="module")
def faulty(tmp_path_factory):
    path = tmp_path_factory.mktemp("faulty")
    r = random.Random(3)
    data = pcap([udp("10.0.0.9", "198.51.100.53", 4000 + i, 53, bytes(r.randrange(256) for _ in range(34))) for i in range(20)])
    assert len(data) == 24 + 20 * 92
    for name, damage in FAULTS.items():
        (path / name).write_bytes(damage(data))
    return path


@pytest.mark.parametrize("block_bytes", [100, 1000, 64 << 20])
def test_one_bad_file_leaves_all_others(spark, faulty, block_bytes):
    listing = capture.read_captures(spark, str(faulty)).select("path", "length")
    got = capture.scan_files(spark, listing, block_bytes=block_bytes).withColumn("file", F.element_at(F.split("file", "/"), -1)).cache()
    ends = {x["file"]: (x["records"], x["failure"]) for x in capture.endings(got).collect()}
    rows = {}
    for x in capture.of_scan(got).collect():
        rows.setdefault(x["file"], []).append((x["seq"], x["src_port"], bytes(x["payload"])))
    assert ends["fine.pcap"] == ends["fine.pcap.gz"] == ends["fine.pcap.bz2"] == (20, None) and ends["big.pcap"] == (800, None)
    assert ends["cut.pcap"] == (19, "record is cut off") and ends["header.pcap"] == (20, "record header is cut off") and ends["long.pcap"] == (2, "record length is damaged")
    assert ends["short.pcap"] == (0, "file header is cut off") and ends["other.pcap"] == (0, "not a capture")
    assert all(ends[f][1].startswith("can't be unpacked") for f in ("cut.pcap.gz", "false.pcap.gz", "false.pcap.bz2", "cut.pcap.xz")) and len(ends) == len(FAULTS)
    assert {f: len(x) for f, x in rows.items()} == {f: n for f, (n, _) in ends.items() if n}
    assert sorted(rows["big.pcap"])[:20] == sorted(rows["fine.pcap"]) == sorted(rows["fine.pcap.gz"]) and [x[0] for x in sorted(rows["big.pcap"])] == list(range(800))
    content = capture.read_captures(spark, str(faulty))
    assert {(x["file"].split("/")[-1], x["records"], x["failure"]) for x in capture.endings(capture.scan(content)).collect()} == {(f, *x) for f, x in ends.items()}


def test_nothing_at_all(spark):
    rows = spark.createDataFrame([("a.pcap", bytearray()), ("b.pcap.gz", None)], "path string, content binary")
    assert sorted(map(tuple, capture.endings(capture.scan(rows)).collect())) == [("a.pcap", 0, "file is empty"), ("b.pcap.gz", 0, "file is empty")]
    assert capture.scan_files(spark, spark.createDataFrame([], "path string, length long")).count() == 0


def test_resuming_skips_what_was_given(spark, faulty):
    listing = capture.read_captures(spark, str(faulty)).filter("path LIKE '%fine.pcap%'").select("path", "length", F.lit(15).alias("skip"))
    got = capture.scan_files(spark, listing, block_bytes=500)
    assert {(x["records"], x["failure"]) for x in capture.endings(got).collect()} == {(20, None)} and capture.of_scan(got).agg(F.count("*"), F.min("seq")).first() == (15, 15)


def ip6(kind, body, extensions=()):
    chain = [k for k, _ in extensions] + [kind]
    raw = b"".join(bytes([following]) + x[1:] for (_, x), following in zip(extensions, chain[1:]))
    raw += body
    return struct.pack("!IHBB", 6 << 28, len(raw), chain[0], 60) + bytes.fromhex("20010db8" + "0" * 23 + "1") + bytes.fromhex("20010db8" + "0" * 23 + "2") + raw


BODY = struct.pack("!HHHH", 4000, 53, 8 + 3, 0) + b"abc"


@pytest.mark.parametrize("link,head", [(1, b"\0" * 12 + b"\x86\xdd"), (1, b"\0" * 12 + b"\x81\x00\0\5\x86\xdd"), (101, b""), (229, b""), (113, b"\0" * 14 + b"\x86\xdd"), (276, b"\x86\xdd" + b"\0" * 18), (0, b"\x1e\0\0\0"), (108, b"\0\0\0\x1e")])
def test_links_and_extension_headers(link, head):
    chains = [(), [(0, b"\0\0" + b"\0" * 6)], [(0, b"\0\1" + b"\0" * 14), (43, b"\0\0" + b"\0" * 6), (60, b"\0\0" + b"\0" * 6)], [(51, b"\0\4" + b"\0" * 22)]]
    for chain in chains:
        p = frames.packet(head + ip6(17, BODY, chain), link)
        assert (p["protocol"], p["src_port"], p["dst_port"], p["payload"], p["ttl"], p["src"]) == (17, 4000, 53, b"abc", 60, "2001:db8::1")
    first = frames.packet(head + ip6(17, BODY[:8], [(44, b"\0\0" + struct.pack("!HI", 0 | 1, 0xFFFFFFF0))]), link)
    then = frames.packet(head + ip6(17, BODY[8:], [(44, b"\0\0" + struct.pack("!HI", 8, 0xFFFFFFF0))]), link)
    assert [(p["frag_offset"], p["more_fragments"], p["ip_id"], p["src_port"], p["protocol"]) for p in (first, then)] == [(0, True, 0xFFFFFFF0, None, 17), (8, False, 0xFFFFFFF0, None, 17)] and first["payload"] + then["payload"] == BODY


def test_frames_without_packets():
    assert frames.packet(b"", 1) is None and frames.packet(b"\0" * 12 + b"\x08\x06" + b"\0" * 40, 1) is None and frames.packet(b"\x60" + b"\0" * 20, 101) is None and frames.packet(b"\x45" * 30, 999) is None and frames.packet(ip6(0, b"", []), 101) is None
