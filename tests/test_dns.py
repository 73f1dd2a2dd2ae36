"""Table-driven, property and byte-level tests of the DNS operators."""

import bz2
import gzip
import ipaddress
import lzma
import random
import struct

import pytest
from pyspark.sql import functions as F

from wirelens import shared, sinks
from wirelens.functions import columns as C
from wirelens.operators import address, metrics, names, objects, pairing, rows, tcp
from wirelens.plans import queries as Q
from wirelens.sources import capture, reference
from wirelens.streaming import jobs

#: Names with their registered domain, the part before it, public suffix and number of labels.
NAMES = [
    ("zone.nl.", "zone.nl", None, "nl", 2), ("%%%.zone.nl.", "zone.nl", "%%%", "nl", 3), ("*.nl.", "*.nl", None, "nl", 2), ("*.zone.nl.", "zone.nl", "*", "nl", 3), ("test.www.zone.nl.", "zone.nl", "test.www", "nl", 4),
    ("test.blogspot.co.uk.", "blogspot.co.uk", "test", "co.uk", 4), ("www.acme.co.nz.", "acme.co.nz", "www", "co.nz", 4), ("_gc._tcp.host.net.nz.", "host.net.nz", "_gc._tcp", "net.nz", 5), ("email.test@example.com.", "test@example.com", "email", "com", 3),
    ("test .zone.nl.", "zone.nl", "test", "nl", 3), ("➊➋➌192.168.51.52.studio.co.nz.", "studio.co.nz", "???192.168.51.52", "co.nz", 7), ("nl.", None, None, "nl", 1), (".nl.", None, None, "nl", 1), ("co.nz.", None, None, "co.nz", 2),
    (".", None, None, None, 0), ("", None, None, None, 0), (None, None, None, None, None), ("xxx.doesnotexists.", "xxx.doesnotexists", None, "doesnotexists", 2), ("WWW.Test.zone.co.uk.", "zone.co.uk", "www.test", "co.uk", 5), ("a..b.nl..", "b.nl", "a.", "nl", 4),
]


def test_name_table(spark):
    df = spark.createDataFrame([(n[0],) for n in NAMES], "qname string")
    got = {r["qname"]: r for r in names.domain_parts(df, Q.rules(spark)).collect()}
    for name, domain, sub, tld, n in NAMES:
        r = got[name]
        assert (r["domain"], r["subdomain"], r["tld"], r["labels"]) == (domain, sub, tld, n), name


def test_hot_rules_and_standard(spark):
    rules = names.suffix_rules(spark.createDataFrame([("nl",), ("co.nl",), ("// x",), ("",), ("aw",), ("co.aw",)], "value string"), hot=("nl", "aw"))
    df = spark.createDataFrame([(n,) for n in ("lab1.lab2.zone.nl", " www. zone .nl ", "domain.co.nl", "domain.co.aw", "nl")], "qname string")
    got = {r["qname"]: (r["domain"], r["subdomain"]) for r in names.domain_parts(df, rules).collect()}
    assert got == {"lab1.lab2.zone.nl": ("zone.nl", "lab1.lab2"), " www. zone .nl ": ("zone.nl", "www"), "domain.co.nl": ("co.nl", "domain"), "domain.co.aw": ("co.aw", "domain"), "nl": (None, None)}
    std = spark.createDataFrame([(n,) for n in ("a.b.ck", "x.www.ck", "a.city.kawasaki.jp", "a.b.kawasaki.jp", "pvt.k12.ma.us", "a.pvt.k12.ma.us", "foo.bar")], "qname string")
    out = {r["qname"]: r["tld"] for r in names.domain_parts_standard(std, Q.rules(spark)).collect()}
    assert out == {"a.b.ck": "b.ck", "x.www.ck": "ck", "a.city.kawasaki.jp": "kawasaki.jp", "a.b.kawasaki.jp": "b.kawasaki.jp", "pvt.k12.ma.us": "pvt.k12.ma.us", "a.pvt.k12.ma.us": "pvt.k12.ma.us", "foo.bar": "bar"}


def test_cidr_table(spark):
    nets = ["192.168.1.0/24", "10.0.0.0/8", "172.16.0.0/12", "2001:db8::/32", "2001:0db8:85a3::/64", "0.0.0.0/0", "10.9.9.9/32"]
    n = address.normalise(spark.createDataFrame([(c, c, 1) for c in [*nets, "bad", "1.2.3.4/40", "2001:db8::/129", "1::2::3/64", "1.2.3.4", "/8"]], "cidr string, name string, priority int"))
    assert n.count() == len(nets)
    a = spark.createDataFrame([(x,) for x in ("192.168.1.5", "192.168.1.0", "192.168.1.255", "10.1.1.1", "10.9.9.9", "2001:db8::1", "192.168.2.5", "2001:db9::1", "2001:db8:85a3::9", None, "x.y", "10.1.1.1")], "address string")
    own = n.filter("cidr <> '0.0.0.0/0'")
    both = [address.Enrichment("open", own, "name", "plen", True, False), address.longest_prefix("plain", own, "name"), address.longest_prefix("all", n, "name")]
    got = {r["address"]: (r["open"], r["plain"], r["all"]) for r in address.address_dimension(a, both).collect()}
    local, wide = "192.168.1.0/24", "0.0.0.0/0"
    assert got == {
        "192.168.1.5": (local, local, local), "192.168.1.0": (None, local, local), "192.168.1.255": (None, local, local), "10.1.1.1": ("10.0.0.0/8",) * 3, "10.9.9.9": ("10.0.0.0/8", "10.9.9.9/32", "10.9.9.9/32"),
        "2001:db8::1": ("2001:db8::/32",) * 3, "192.168.2.5": (None, None, wide), "2001:db9::1": (None,) * 3, "2001:db8:85a3::9": ("2001:0db8:85a3::/64",) * 3, "x.y": (None,) * 3,
    }


def test_version_6_text(spark):
    r = random.Random(2)
    texts = ["::", "::1", "1::", "fe80::1", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "2001:DB8::A", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "", ":", ":::", "1:2", "1::2::3", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "::1.2.3.400", "1.2.3.4", "1:2:3:4:5:6:7:8::", None]
    texts += [str(ipaddress.IPv6Address(r.getrandbits(128) & r.choice([2**128 - 1, 2**64 - 1, (2**64 - 1) << 64, 0xFFFF << 48]))) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "a string").select("a", C.ipv6_halves("a").alias("h"))
    for row in df.collect():
        try:
            want = int(ipaddress.IPv6Address(row["a"]))
        except (ValueError, TypeError):
            want = None
        got = None if row["h"] is None else (row["h"]["hi"] % 2**64 << 64) + row["h"]["lo"] % 2**64
        assert got == want, row["a"]


FIELDS = "capture_file string, seq long, ts timestamp_ntz, qr int, dns_id int, client_ip string, client_port int, qname string, qtype int"


def random_messages(spark, seed, n=400):
    r = random.Random(seed)
    data = [("f", i, r.randrange(2), r.randrange(2), r.choice("ab"), 1, r.choice(["x", "y", None]), r.choice([1, 1, 1, 252])) for i in range(n)]
    df = spark.createDataFrame(data, "capture_file string, seq long, qr int, dns_id int, client_ip string, client_port int, qname string, qtype int")
    return data, df.withColumn("ts", F.timestamp_millis(F.col("seq") * 10).cast("timestamp_ntz"))


def sequential(data):
    """One pass over the messages in order, with a map of pending requests and one of transfers."""
    pending, transfer, out = {}, {}, set()
    for _, seq, qr, ident, ip, port, name, qtype in data:
        client, key = (ident, ip, port), (ident, ip, port, name)
        if qr == 0 and qtype in (251, 252):
            transfer[client] = 0
        elif qr == 0:
            pending[key] = (seq, name)
        else:
            if client in transfer:
                transfer[client] += 1
                if transfer[client] > 1:
                    continue
            req = pending.pop(key, None)
            if req or name is not None:
                out.add((req[0] if req else None, seq))
    return out | {(seq, None) for seq, name in pending.values() if name is not None}


@pytest.mark.parametrize("seed", range(3))
def test_window_pairing_is_sequential_pairing(spark, seed):
    data, df = random_messages(spark, seed)
    got = {(r["q"], r["r"]) for r in pairing.transactions(df).select(F.col("req.seq").alias("q"), F.col("rsp.seq").alias("r")).collect()}
    assert got == sequential(data)


def test_pairing_needs_few_exchanges(spark, sf, capsys):
    Q.pairs(spark, sf).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1


def stream(spark, df, path, batches, run):
    """Run a stream over ``df`` cut into micro-batches by seq, to its end; rows of each batch."""
    n = df.agg(F.max("seq")).first()[0] + 1
    for i in range(batches):
        df.filter(F.floor(F.col("seq") * batches / n) == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    q = run(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")).option("checkpointLocation", f"{path}/cp").start()
    q.processAllAvailable()
    return q


def test_streaming_pairing_is_batch_pairing(spark, tmp_path):
    data, df = random_messages(spark, 11, 200)
    q = stream(spark, df, tmp_path, 4, lambda s: jobs.pair_stream(s, expiry_ms=10**9).writeStream.format("memory").queryName("paired"))
    q.stop()
    got = {(r["req_seq"], r["rsp_seq"]) for r in spark.table("paired").collect()}
    assert got == {p for p in sequential(data) if p[1] is not None}


def test_streaming_pairing_expires_and_forgets(spark, tmp_path):
    """Requests leave alone once their time is over, late responses don't pair, and no state stays behind."""
    at = [(0, 0, "a", 1, 0), (1, 0, "b", 1, 100), (2, 1, "b", 1, 200), (3, 0, None, 1, 300), (4, 0, "x", 252, 400), (5, 1, "a", 1, 60_000), (6, 0, "c", 1, 61_000), (7, 1, "c", 1, 61_500), (8, 1, "d", 1, 200_000), (9, 1, "e", 1, 400_000)]
    df = spark.createDataFrame([("f", s, qr, 1, "ip", 1, name, kind, ms) for s, qr, name, kind, ms in at], "capture_file string, seq long, qr int, dns_id int, client_ip string, client_port int, qname string, qtype int, ms long")
    df = df.withColumn("ts", F.timestamp_millis(F.col("ms") + 10**12).cast("timestamp_ntz")).drop("ms")
    q = stream(spark, df, tmp_path, 10, lambda s: jobs.pair_stream(s, expiry_ms=1000, late="1 second").writeStream.format("memory").queryName("expired"))
    left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    got = {(r["qname"], r["req_seq"], r["rsp_seq"]) for r in spark.table("expired").collect()}
    assert got == {("a", 0, None), ("b", 1, 2), ("a", None, 5), ("c", 6, 7), ("d", None, 8), ("e", None, 9)}
    assert left == 0


def test_metric_stream_is_metric_points(spark, tmp_path, sf):
    x = Q.sided(Q.dns(spark, sf, [Q.country(spark)])).withColumn("seq", F.monotonically_increasing_id() % 1000)
    x = spark.createDataFrame(x.select("seq", "time", "server", "server_location", "has_request", "has_response", "dns_qtype", "dns_rcode", "dns_opcode", "ip_geo_country", "prot", "ip_version", "tcp_rtt", "dns_proc_time").limit(300).collect(), "seq long, time timestamp_ntz, server string, server_location string, has_request boolean, has_response boolean, dns_qtype int, dns_rcode int, dns_opcode int, ip_geo_country string, prot int, ip_version int, tcp_rtt int, dns_proc_time int")
    path = str(tmp_path / "points")
    q = stream(spark, x, tmp_path, 3, lambda s: jobs.metric_stream(s, late="1000 days").writeStream.outputMode("update").foreachBatch(lambda df, i: jobs.upsert_points(df, i, path)))
    q.stop()
    got, want = jobs.latest_points(spark, path), metrics.metric_points(x)
    key = lambda df: sorted(tuple(str(r[c]) for c in ("metric", "bin", "tag", "server", "type", "value")) for r in df.collect())
    assert key(got) == key(want) and got.count() > 100


def test_ingest_rolls_at_the_least_rows(spark, tmp_path):
    ask = udp("10.0.0.9", "198.51.100.53", 4000, 53, dns_message())
    for i in range(3):
        (tmp_path / f"x_ns1_ams-{i}.pcap").write_bytes(pcap([ask] * 4 + [ask[:50]]))
    written, bad = str(tmp_path / "table"), str(tmp_path / "bad")
    roller = jobs.Roller(spark, str(tmp_path / "staged"), lambda df, n: df.write.mode("overwrite").parquet(f"{written}/roll={n}"), 10)

    def build(df):
        p = capture.packets(df)
        sinks.report_malformed(capture.malformed(p), bad)
        return capture.messages(p).select("file", "seq")

    numbers = iter(range(9))
    q = jobs.ingest(jobs.new_captures(spark, str(tmp_path), 1), build, lambda df: roller.add(df, next(numbers)), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(written).count() == 12 and spark.read.parquet(bad).count() == 3
    assert [r["reason"] != "" for r in spark.read.parquet(bad).collect()] == [True] * 3
    roller.add(spark.createDataFrame([("late", 1)], "file string, seq long"), 7)
    assert spark.read.parquet(written).count() == 12
    roller.flush()
    roller.flush()
    assert spark.read.parquet(written).count() == 13


def test_rolls_replace_what_was_lost(spark, tmp_path):
    """A loss between the table's write and the note of it leaves no row twice; a batch that was rolled isn't staged again."""
    def write(df, n):
        df.write.mode("overwrite").parquet(f"{tmp_path}/table/roll={n}")
        if lost:
            raise RuntimeError(lost.pop())

    lost, batch = ["gone"], lambda i: spark.range(i * 10, i * 10 + 10)
    with pytest.raises(RuntimeError, match="gone"):
        jobs.Roller(spark, str(tmp_path / "staged"), write, 10).add(batch(0), 0)
    again = jobs.Roller(spark, str(tmp_path / "staged"), write, 10)
    again.add(batch(0), 0)
    again.add(batch(1), 1)
    again.add(batch(1), 1)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "table")).select("id").collect()) == list(range(20))


def test_small_sinks(spark, sf, tmp_path):
    points = metrics.metric_points(Q.sided(Q.dns(spark, sf, [Q.country(spark)])))
    sinks.write_points(points, str(tmp_path / "points"))
    assert spark.read.parquet(str(tmp_path / "points")).count() == points.count()
    led = objects.object_state(Q.V.view(spark, sf, Q.V.LEDGER), F.lit(Q.NOW).cast("timestamp_ntz"), 3600, 3600)
    for _ in range(2):
        sinks.dispose(led, str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2 * led.count()
    (tmp_path / "geo.csv").write_text("network,value,org\n10.0.0.0/8,ZZ,Own\n2001:db8::/32,SE,Wide\nbad,x,y\n")
    geo = reference.geo_csv(spark, str(tmp_path / "geo.csv"))
    got = address.address_dimension(spark.createDataFrame([("10.1.1.1",), ("2001:db8::7",)], "address string"), [address.longest_prefix("iso", geo, "value"), address.longest_prefix("org", geo, "org")])
    assert sorted(map(tuple, got.collect())) == [("10.1.1.1", "ZZ", "Own"), ("2001:db8::7", "SE", "Wide")]


def test_rows_need_pairing_once(spark, sf):
    """Enrichment doesn't compute the pairs again: the windows of the plan are those of pairing."""
    plan = Q.dns(spark, sf, Q.enrichments(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == Q.pairs(spark, sf)._jdf.queryExecution().executedPlan().toString().count("Window [") == 3


def test_stored_day_is_pruned(spark, sf, tmp_path):
    sinks.write_dns(Q.dns(spark, sf), str(tmp_path / "t"))
    plan = sinks.read_dns(spark, str(tmp_path / "t")).filter("day = '2024-01-10' AND dns_domainname = 'zone.nl'").select("dns_domainname")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(dns_domainname,zone.nl)" in plan and "ReadSchema: struct<dns_domainname:string>" in plan


def name_bytes(n):
    return b"".join(bytes([len(p)]) + p.encode() for p in n.rstrip(".").split(".")) + b"\0"


def dns_message(ident=7, qr=0, name="www.zone.nl", rcode=0, answers=(), edns=False):
    flags = qr << 15 | 1 << 8 | rcode
    m = struct.pack("!6H", ident, flags, 1, len(answers), 0, int(edns)) + name_bytes(name) + struct.pack("!HH", 1, 1)
    for kind, data in answers:
        m += b"\xc0\x0c" + struct.pack("!HHIH", kind, 1, 60, len(data)) + data
    if edns:
        ecs = struct.pack("!HHHBB", 8, 7, 1, 24, 0) + bytes([10, 1, 2])
        ede = struct.pack("!HHH", 15, 2, 22)
        m += b"\0" + struct.pack("!HHIH", 41, 512, 0x01008000, len(ecs + ede)) + ecs + ede
    return m


def udp(src, dst, sport, dport, payload, ident=1, frag=0x4000, raw=None):
    body = raw if raw is not None else struct.pack("!HHHH", sport, dport, 8 + len(payload), 0) + payload
    ip = struct.pack("!BBHHHBBH", 0x45, 0, 20 + len(body), ident, frag, 64, 17, 0) + bytes(map(int, src.split("."))) + bytes(map(int, dst.split(".")))
    return b"\0" * 12 + b"\x08\x00" + ip + body


def pcap(frames):
    return struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1) + b"".join(struct.pack("<IIII", 1_700_000_000, 1000 * i, len(f), len(f)) + f for i, f in enumerate(frames))


def test_captures_to_rows(spark, tmp_path):
    ask = udp("10.0.0.9", "198.51.100.53", 4000, 53, dns_message(edns=True))
    say = udp("198.51.100.53", "10.0.0.9", 53, 4000, dns_message(qr=1, rcode=3, answers=[(5, name_bytes("alias.nl")), (1, bytes([1, 2, 3, 4]))], edns=True))
    one, two = pcap([ask]), pcap([ask, say])
    name = "x_ns1.zone.nl_ams-1.pcap"
    (tmp_path / name).write_bytes(two)
    (tmp_path / f"{name}.gz").write_bytes(gzip.compress(two))
    (tmp_path / f"{name}.bz2").write_bytes(bz2.compress(two[:30]) + bz2.compress(two[30:]))
    (tmp_path / f"{name}.xz").write_bytes(lzma.compress(one) + lzma.compress(pcap([say])[24:]))
    (tmp_path / "skipped.PCAP").write_bytes(two)
    packets = capture.packets(capture.read_captures(spark, str(tmp_path)))
    assert sorted(map(str, packets.collect())) == sorted(map(str, capture.read_packets(spark, str(tmp_path)).collect()))
    assert packets.count() == 8 and packets.filter("do_not_fragment").count() == 8
    decoded = capture.messages(packets.withColumn("msg_len", F.length("payload")).withColumn("tcp_rtt", F.lit(None).cast("int")))
    got = rows.build_dns(pairing.transactions(capture.flat_messages(decoded)), Q.rules(spark), o=rows.Options(rdata=True)).collect()
    assert len(got) == 4
    for r in got:
        assert (r["dns_rcode"], r["dns_domainname"], r["server"], r["server_location"], r["edns_ecs"], r["edns_options"], r["edns_ext_error"], r["edns_udp"], r["edns_do"]) == (19, "zone.nl", "ns1.zone.nl", "ams", "10.1.2.0/24", [8, 15], [22], 512, True)
        assert r["dns_cname"] == ["alias.nl."] and [tuple(x) for x in r["dns_rdata"]] == [(0, 5, "alias.nl."), (0, 1, "1.2.3.4")]
        assert (r["ip_src"], r["ip_dst"], r["prot_src_port"]) == ("10.0.0.9", "198.51.100.53", 4000)
    assert sorted(r["dns_proc_time"] for r in got) == [0, 1, 1, 1]  # the xz file's second part starts its own clock


def test_malformed_messages_go():
    good = dns_message(qr=1, answers=[(1, bytes(4))])
    assert capture.decode(good)["answer"][0]["data"] == "0.0.0.0"
    assert capture.decode(good[:20]) is None and capture.decode(b"") is None and capture.decode(b"\0" * 4 + b"\0\1" + b"\0" * 6 + b"\xc0\x0c") is None


def test_fragments(spark):
    data = [("a", 0, b"x" * 1480, True), ("a", 1480, b"yy", False), ("a", 0, b"x" * 1480, True), ("gap", 8, b"z", False), ("open", 0, b"z", True)]
    df = spark.createDataFrame([("f", a, "d", 5, 17, o, bytearray(p), m) for a, o, p, m in data], "capture_file string, src string, dst string, ip_id int, protocol int, frag_offset int, payload binary, more_fragments boolean").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = tcp.reassemble_fragments(df).collect()
    assert [(r["src"], r["fragments"], r["last_offset"], len(r["payload"])) for r in out] == [("a", 2, 1480, 1482)]


def test_tcp_messages(spark):
    ms = [dns_message(i) for i in range(3)]
    stream = b"".join(struct.pack("!H", len(m)) + m for m in ms)
    segs = [(0, stream[:10]), (10, stream[10:50]), (10, stream[10:50]), (0, b""), (40, stream[40:])]
    df = spark.createDataFrame([("f", "a", 1, "b", 53, s, bytearray(p), i) for i, (s, p) in enumerate(segs)] + [("f", "h", 1, "b", 53, 5, bytearray(stream), 9)] + [("f", "g", 1, "b", 53, s, bytearray(stream), 9) for s in (0, 10_000)], "capture_file string, src string, src_port int, dst string, dst_port int, tcp_seq long, payload binary, i int").withColumn("ts", F.timestamp_seconds("i"))
    got = {}
    for r in tcp.split_messages(df).orderBy("src", "n").collect():
        got.setdefault(r["src"], []).append(bytes(r["payload"]))
    assert got == {"a": ms, "h": ms, "g": ms}


def test_sequence_numbers_wrap(spark):
    m = [dns_message(i) for i in range(3)]
    stream_ = b"".join(struct.pack("!H", len(x)) + x for x in m)
    segs = [(2**32 - 20, stream_[:20]), (0, stream_[20:60]), (40, stream_[60:]), (0, stream_[20:60])]
    df = spark.createDataFrame([("f", "a", 1, "b", 53, s, bytearray(p), i) for i, (s, p) in enumerate(segs)], "capture_file string, src string, src_port int, dst string, dst_port int, tcp_seq long, payload binary, i int").withColumn("ts", F.timestamp_seconds("i"))
    assert [bytes(r["payload"]) for r in tcp.split_messages(df).orderBy("n").collect()] == m


def test_shared_tables_are_cleared(spark):
    shared.clear(spark)
    x = shared.cut(spark.range(3))
    assert x.count() == 3 and shared.clear(spark) == 1 and shared.clear(spark) == 0


def test_sink(spark, sf, tmp_path):
    x = Q.dns(spark, sf)
    sinks.write_dns(x, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == x.count()
    for file in {r[0] for r in back.select(F.input_file_name()).distinct().collect()}:
        values = [r[0] for r in spark.read.parquet(file).select("dns_domainname").collect()]
        assert values == sorted([v for v in values if v is not None]) + [None] * values.count(None)
    assert all(".zstd." in f for f in back.inputFiles())


def test_state_and_site(spark):
    df = spark.createDataFrame([("d/a_b_ns1_ams-2.pcap", None, None), ("plain.pcap", None, None), ("x_s_t-1.gz", "tag", "site"), ("x_s_t-1.gz", "tag", None)], "k string, a string, b string")
    got = [tuple(r[0]) for r in df.select(C.server_site("k", "a", "b", "ds", "dl")).collect()]
    assert got == [("ns1", "ams"), ("ds", "dl"), ("tag", "site"), ("s", "t")]
    t = spark.createDataFrame([(None,), ("2024-01-01 00:00:00",), ("2024-01-01 02:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("m"))
    now = F.lit("2024-01-02 01:00:00").cast("timestamp_ntz")
    assert [r[0] for r in t.select(objects.stale(F.col("m"), now)).collect()] == [True, True, False]


def test_html_ranges(spark):
    html = '<table id="networks"><tr><th>a</th><th>b</th><th>c</th><th>v4</th><th>v6</th></tr><tr><td>1</td><td>2</td><td>3</td><td><b>1.2.3.0/24</b></td><td>2001:db8::/48</td></tr></table>'
    got = {r["cidr"] for r in reference.html_ranges(spark.createDataFrame([(html,)], "html string")).collect()}
    assert got == {"1.2.3.0/24", "2001:db8::/48"}


def test_library_imports_without_the_corpus_part():
    import ast
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "wirelens"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            for n in ast.walk(ast.parse(f.read_text())):
                if isinstance(n, (ast.Import, ast.ImportFrom)):
                    assert "llm" not in ast.dump(n), f
