"""DNS-shaped views of the star-schema tables: SQL that Spark and DuckDB read alike, and bytes of captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One row per message.
MESSAGES = """
SELECT event_id AS seq, user_id AS who, ts,
 CAST(CASE WHEN event_type IN ('purchase','error') THEN 1 ELSE 0 END AS INT) AS qr,
 CAST(user_id % 16 AS INT) AS dns_id,
 CAST(CASE WHEN user_id % 13 = 0 THEN 6 ELSE 17 END AS INT) AS prot,
 CAST(CASE WHEN user_id % 7 = 3 THEN 6 ELSE 4 END AS INT) AS ip_version,
 CAST(32 + user_id % 96 AS INT) AS ip_ttl,
 CASE WHEN user_id % 7 = 3 THEN concat('2001:db8:', CAST(user_id % 8 + 1 AS VARCHAR(9)), '::', CAST(user_id % 256 + 1 AS VARCHAR(9))) ELSE concat(CASE user_id % 5 WHEN 0 THEN '8.8.8.' WHEN 1 THEN '172.64.0.' WHEN 2 THEN '208.67.222.' WHEN 3 THEN '10.0.0.' ELSE '192.0.2.' END, CAST(user_id % 256 AS VARCHAR(9))) END AS client_ip,
 CAST(1024 + user_id % 5 AS INT) AS client_port,
 concat('198.51.100.', CAST(user_id % 2 AS VARCHAR(9))) AS server_ip,
 CASE user_id % 17 WHEN 0 THEN 'www.zone.nl.' WHEN 1 THEN 'test.www.zone.nl.' WHEN 2 THEN 'www.acme.co.nz.' WHEN 3 THEN 'xxx.doesnotexists.' WHEN 4 THEN 'nl.' WHEN 5 THEN '.nl.' WHEN 6 THEN '.' WHEN 7 THEN '_gc._tcp.host.net.nz.' WHEN 8 THEN 'hostname.bind.' WHEN 9 THEN '%%%.zone.nl.' WHEN 10 THEN 'WWW.Zone.NL.' WHEN 11 THEN ' www. zone .nl ' WHEN 12 THEN 'email.test@example.com.' WHEN 13 THEN 'domain.co.aw' WHEN 14 THEN 'www.test.zone.co.uk.' WHEN 15 THEN 'zone.nl' ELSE 'a..b.nl..' END AS qname,
 CAST(CASE WHEN user_id % 11 = 0 AND event_id % 4 = 0 THEN 252 WHEN user_id % 3 = 0 THEN 28 ELSE 1 END AS INT) AS qtype,
 CAST(1 AS INT) AS qclass, CAST(0 AS INT) AS opcode,
 CAST(CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS INT) AS rcode,
 CAST(CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS INT) AS opt_ext_rcode,
 CAST(30 + event_id % 200 AS INT) AS msg_len,
 event_id % 2 = 0 AS rd, event_id % 3 = 0 AS aa, event_id % 50 = 0 AS tc, event_id % 7 = 0 AS ra, event_id % 11 = 0 AS ad, event_id % 13 = 0 AS cd,
 CAST(1 AS INT) AS qdcount, CAST(event_id % 3 AS INT) AS ancount, CAST(event_id % 2 AS INT) AS nscount, CAST(event_id % 4 AS INT) AS arcount,
 CAST(CASE WHEN event_id % 3 <> 0 THEN 1232 END AS INT) AS edns_udp, CAST(CASE WHEN event_id % 3 <> 0 THEN 0 END AS INT) AS edns_version, CASE WHEN event_id % 3 <> 0 THEN event_id % 2 = 0 END AS edns_do,
 CAST(CASE WHEN user_id % 13 = 0 AND event_id % 2 = 0 THEN event_id % 90 END AS INT) AS tcp_rtt,
 CASE user_id % 6 WHEN 0 THEN concat('8.8.8.', CAST(event_id % 250 AS VARCHAR(9))) WHEN 1 THEN concat('2001:db8:3::', CAST(event_id % 250 + 1 AS VARCHAR(9))) END AS ecs_ip,
 concat('pcap-in/p1/x_ns', CAST(user_id % 2 + 1 AS VARCHAR(9)), '.zone.nl_ams-20240101.pcap.gz') AS capture_file
FROM {events}"""

#: Ranges of public resolvers and of places; edges and hosts show the exclusive rule.
RESOLVERS = [("8.8.8.0/24", "Google", 2), ("172.64.0.0/13", "CloudFlare", 1), ("208.67.222.0/24", "OpenDNS", 3), ("192.0.2.7/32", "HostOnly", 4), ("2001:db8:5::/48", "CloudFlare", 1), ("2001:db8:5::/112", "OpenDNS", 3)]
PLACES = [("8.0.0.0/8", "US", "3356", "Carrier"), ("8.8.8.0/24", "US", "15169", "Search"), ("10.0.0.0/8", "ZZ", "64512", "Private"), ("172.64.0.0/13", "NL", "13335", "Cdn"), ("192.0.2.0/25", "DE", "64496", "Docs"), ("2001:db8::/32", "SE", "64500", "Wide"), ("2001:db8:3::/48", "FI", "64501", "Three"), ("2001:db8:6::80/121", "FR", "64502", "High")]
#: Suffix rules.
RULES = ["nl", "co.nl", "com", "aw", "co.aw", "uk", "co.uk", "nz", "co.nz", "net.nz", "ac.nz", "govt.nz", "org", "net", "us", "ma.us", "k12.ma.us", "pvt.k12.ma.us", "jp", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp"]

LEDGER = """
SELECT concat('pcap-in/p', CAST(user_id % 2 + 1 AS VARCHAR(9)), '/x_ns', CAST(user_id % 4 AS VARCHAR(9)), '.zone.nl_ams-', CAST(event_id AS VARCHAR(9)),
  CASE event_id % 6 WHEN 0 THEN '.pcap' WHEN 1 THEN '.pcap.gz' WHEN 2 THEN '.pcap.xz' WHEN 3 THEN '.pcap.bz2' WHEN 4 THEN '.PCAP' ELSE '.txt' END) AS object_key,
 event_id % 100 AS size_bytes, ts AS modified,
 event_id % 3 = 0 AS detected,
 CASE WHEN event_id % 4 = 0 THEN ts END AS started,
 CASE WHEN event_id % 24 = 0 THEN ts + INTERVAL '7' SECOND WHEN event_id % 8 = 0 THEN ts + INTERVAL '2' SECOND END AS ended,
 CAST(event_id % 4 AS INT) AS tries, event_id % 40 = 0 AS max_tries_reached
FROM {events}"""

#: Records of a response: section, place, type, beginning of the data, which the user's number modulo 9 ends. A record is
#: there where (event_id + type) % 3 isn't 0.
RECORDS = [(0, 1, 1, "192.0.2."), (0, 2, 5, "alias"), (0, 3, 46, "sig"), (1, 1, 2, "ns"), (2, 1, 28, "2001:db8::")]


def records(section: int, seq: Column, who: Column) -> Column:
    """One section's records, in order, as an array of structs."""
    made = [F.when((seq + kind) % 3 != 0, F.struct(F.lit("n").alias("name"), F.lit(kind).alias("type"), F.concat(F.lit(data), (who % 9).cast("string")).alias("data"))) for s, _, kind, data in RECORDS if s == section]
    return F.filter(F.array(*made), lambda r: r.isNotNull())


#: EDNS options of a message: what holds for which row (user_id is ``who``, event_id is ``seq`` of messages).
OPTIONS = [("user_id % 6 = 0", 8), ("event_id % 5 = 0", 15), ("event_id % 2 = 0", 10), ("event_id % 7 = 0", 8)]

#: TCP segments: flows of a client, sequence numbers with retransmissions and holes.
SEGMENTS = """
SELECT concat('f', CAST(user_id % 3 AS VARCHAR(9))) AS capture_file, concat('10.0.0.', CAST(user_id % 200 AS VARCHAR(9))) AS src, CAST(1024 + user_id % 7 AS INT) AS src_port, '198.51.100.53' AS dst, CAST(53 AS INT) AS dst_port,
 event_id AS seq, ts, event_id % 50 * 100 + user_id AS tcp_seq, CAST(CASE WHEN event_id % 10 = 0 THEN 0 ELSE 100 + event_id % 3 * 50 END AS INT) AS length,
 CAST(CASE WHEN event_type = 'signup' THEN 2 ELSE 16 END AS INT) AS tcp_flags
FROM {events}"""


def options(seq: Column, who: Column) -> Column:
    """EDNS options of a message as an array of structs."""
    made = []
    for i, (cond, code) in enumerate(OPTIONS):
        name, _, number, _, _ = cond.split(" ")
        none = F.lit(None).cast("int")
        fields = F.struct(
            F.lit(code).alias("code"), (seq % 25).cast("int").alias("info_code") if code == 15 else none.alias("info_code"),
            (F.concat(F.lit(f"10.{i}.0."), (who % 250).cast("string")) if code == 8 else F.lit(None).cast("string")).alias("ecs_addr"), (F.lit(24 + i) if code == 8 else none).alias("ecs_mask"),
        )
        made.append(F.when((who if name == "user_id" else seq) % int(number) == 0, fields))
    return F.filter(F.array(*made), lambda o: o.isNotNull())


#: Events of one capture file; every MALFORMED-th message lacks its last bytes.
EVENTS_PER_FILE, MALFORMED = 500, 97


#: Bytes in a first fragment and in a first segment, and where a file's sequence numbers begin (they wrap soon).
FIRST_FRAGMENT, FIRST_SEGMENT, FIRST_SEQUENCE = 24, 20, 4_294_966_000


def packets_of(messages: DataFrame) -> DataFrame:
    """(path, seq, k, frame, ts): Ethernet frames of messages over IP of both versions, UDP or TCP, each a DNS message with
    one question and an option record (client subnet, extended error), all in big-endian order.

    Every fifth datagram comes as two fragments, every other of these in reverse. A flow's messages over TCP are one
    stream of bytes: of four, one is one segment, the others are cut in two, in order, in reverse, and with the first
    segment sent again."""
    two = lambda c: F.lpad(F.hex(c.cast("long")), 2, "0")
    four = lambda c: F.lpad(F.hex(c.cast("long")), 4, "0")
    eight = lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")
    bit = lambda c, n: F.shiftleft(F.col(c).cast("int"), n)
    file = F.concat(F.lit("f"), F.floor(F.col("seq") / EVENTS_PER_FILE).cast("string"), F.lit(".pcap"))
    name = F.concat(F.lit("u"), F.col("who").cast("string"), F.lit(".zone.nl"))
    labels = F.array_join(F.transform(F.split(name, r"\."), lambda x: F.concat(two(F.length(x)), F.hex(x))), "")
    flags = bit("qr", 15).bitwiseOR(bit("aa", 10)).bitwiseOR(bit("tc", 9)).bitwiseOR(bit("rd", 8)).bitwiseOR(bit("ra", 7)).bitwiseOR(bit("ad", 5)).bitwiseOR(bit("cd", 4)).bitwiseOR(F.col("rcode"))
    subnet, error = F.concat(F.lit("00080007000118000A0A"), two(F.col("who") % 250)), F.concat(F.lit("000F0002"), four(F.col("seq") % 25))
    opt = F.concat(F.lit("000029"), four(F.lit(1232)), two(F.col("opt_ext_rcode")), F.lit("00"), F.when(F.col("seq") % 2 == 0, "8000").otherwise("0000"), F.lit("0011"), subnet, error)
    whole = F.concat(four(F.col("dns_id")), four(flags), F.lit("0001000000000001"), labels, F.lit("00"), four(F.col("qtype")), F.lit("0001"), opt)
    asks = F.col("qr") == 0
    octets = lambda c: F.array_join(F.transform(F.split(c, r"\."), lambda x: two(x)), "")
    groups = F.split("client_ip", ":")
    client = F.when(F.col("ip_version") == 4, octets("client_ip")).otherwise(F.concat(F.lit("20010DB8"), F.lpad(F.try_element_at(groups, F.lit(3)), 4, "0"), F.repeat(F.lit("0"), 16), F.lpad(F.element_at(groups, -1), 4, "0")))
    server = F.when(F.col("ip_version") == 4, octets("server_ip")).otherwise(F.concat(F.lit("20010DB8"), F.repeat(F.lit("0"), 20), four(F.col("who") % 2 + 1)))
    x = messages.select(
        file.alias("path"), "seq", "ts", "prot", "ip_version", "ip_ttl", "qr", F.when(F.col("seq") % MALFORMED == 0, F.left(whole, F.length(whole) - 6)).otherwise(whole).alias("dns"),
        F.when(asks, F.concat(four(F.col("client_port")), F.lit("0035"))).otherwise(F.concat(F.lit("0035"), four(F.col("client_port")))).alias("ports"),
        F.when(asks, F.concat(client, server)).otherwise(F.concat(server, client)).alias("ends"),
    )
    sent = F.sum(F.length("dns") / 2 + 2).over(Window.partitionBy("path", "prot", "ends", "ports").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("at", F.coalesce(sent, F.lit(0)).cast("long") + FIRST_SEQUENCE).withColumn("stream", F.concat(four(F.length("dns") / 2), F.col("dns")))
    datagram = F.concat("ports", four(F.length("dns") / 2 + 8), F.lit("0000"), "dns")
    segment = lambda skip, data: F.concat(F.col("ports"), eight((F.col("at") + skip) % 2**32), F.lit("000000005018040000000000"), data)
    cut_at = 2 * FIRST_SEGMENT
    one, left, right = segment(0, F.col("stream")), segment(0, F.left("stream", F.lit(cut_at))), segment(FIRST_SEGMENT, F.substr("stream", F.lit(cut_at + 1)))
    head, tail = F.left(datagram, F.lit(2 * FIRST_FRAGMENT)), F.substr(datagram, F.lit(2 * FIRST_FRAGMENT + 1))

    def frame(fragment: int, body: Column) -> Column:
        """``fragment``: 0 a whole packet, 1 the first and 2 the last fragment."""
        length, field = F.length(body) / 2, ("4000", "2000", f"{FIRST_FRAGMENT // 8:04X}")[fragment]
        v4 = F.concat(F.lit("08004500"), four(length + 20), four(F.col("seq") % 65536), F.lit(field), two(F.col("ip_ttl")), two(F.col("prot")), F.lit("0000"), "ends", body)
        more = F.concat(two(F.col("prot")), F.lit("00" + ("", "0001", f"{FIRST_FRAGMENT:04X}")[fragment]), eight(F.col("seq"))) if fragment else F.lit("")
        v6 = F.concat(F.lit("86DD60000000"), four(length + 8 * bool(fragment)), F.lit("2C") if fragment else two(F.col("prot")), two(F.col("ip_ttl")), "ends", more, body)
        return F.concat(F.repeat(F.lit("0"), 24), F.when(F.col("ip_version") == 4, v4).otherwise(v6))

    over_tcp = F.when(F.col("seq") % 4 == 0, F.array(frame(0, one))).when(F.col("seq") % 4 == 1, F.array(frame(0, left), frame(0, right))).when(F.col("seq") % 4 == 2, F.array(frame(0, right), frame(0, left))).otherwise(F.array(frame(0, left), frame(0, right), frame(0, left)))
    over_udp = F.when(F.col("seq") % 10 == 2, F.array(frame(1, head), frame(2, tail))).when(F.col("seq") % 10 == 7, F.array(frame(2, tail), frame(1, head))).otherwise(F.array(frame(0, datagram)))
    return x.select("path", "seq", "ts", F.posexplode(F.when(F.col("prot") == 6, over_tcp).otherwise(over_udp)).alias("k", "frame"))


#: What damages a file, by its number modulo 4: 0 nothing, 1 its last bytes are missing, 2 it is something else, 3 the length of a
#: record is damaged (the first of the event with this number in the file).
CUT_BYTES, DAMAGED_EVENT = 10, 400


def captures(messages: DataFrame, damaged: bool = False) -> DataFrame:
    """(path, content): capture files made of messages, some of them damaged."""
    eight = lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    number = F.floor(F.col("seq") / EVENTS_PER_FILE)
    size = eight(F.length("frame") / 2)
    if damaged:
        size = F.when((number % 4 == 3) & (F.col("seq") % EVENTS_PER_FILE == DAMAGED_EVENT) & (F.col("k") == 0), "FFFFFFFF").otherwise(size)
    record = F.concat(eight(F.floor(micros / 1_000_000)), eight(micros % 1_000_000), size, size, "frame")
    rows = packets_of(messages).select("path", number.alias("number"), "seq", "k", record.alias("r")).groupBy("path", "number").agg(F.array_sort(F.collect_list(F.struct("seq", "k", "r"))).alias("rs"))
    whole = F.concat(F.lit("A1B2C3D40002000400000000000000000000FFFF00000001"), F.array_join("rs.r", ""))
    if damaged:
        whole = F.when(F.col("number") % 4 == 1, F.left(whole, F.length(whole) - 2 * CUT_BYTES)).when(F.col("number") % 4 == 2, F.concat(F.lit("504B0304"), F.substr(whole, F.lit(9)))).otherwise(whole)
    return rows.select("path", F.unhex(whole).alias("content"))


#: Endings of the capture files, by their number.
CODECS = ("pcap", "gz", "bz2", "xz")


def capture_files(captures: DataFrame, folder: str) -> None:
    """Write (path, content) rows as files into a folder that tasks share, packed by CODECS in turn."""

    def run(batches):
        import bz2
        import gzip
        import lzma

        import pyarrow as pa
        from pyarrow import fs

        pack = {"pcap": bytes, "gz": gzip.compress, "bz2": bz2.compress, "xz": lzma.compress}
        system, top = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                codec = CODECS[int(path[1:-5]) % len(CODECS)]
                system.create_dir(top, recursive=True)
                with system.open_output_stream(f"{top}/{path}" + ("" if codec == "pcap" else f".{codec}"), compression=None) as f:
                    f.write(pack[codec](content))
            yield b.select(["path"])

    captures.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def duck(sql: str) -> str:
    return sql.replace("{events}", "events")


def values(rows: list[tuple]) -> str:
    """A SQL VALUES list of Python values."""
    quote = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows) + ")"
