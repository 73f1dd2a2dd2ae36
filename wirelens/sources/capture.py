"""Capture files to packets and DNS messages. Plain captures are read by ranges of bytes, so one file is read by many
tasks; a compressed one can't be split and is streamed through one task, a frame at a time, whatever its size. A file
that can't be read to its end gives the packets before the damage and one failure. Decoding bytes needs Python;
everything behind it is columns."""

from __future__ import annotations

import base64
import io
import struct
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import time_of_millis
from ..shared import cut, dealt, open_path
from . import records
from .frames import address, packet
from .records import Damaged, layout, opened

PACKETS = "file string, seq long, ts_ms long, ip_version int, protocol int, ttl int, src string, src_port int, dst string, dst_port int, do_not_fragment boolean, frag_offset int, more_fragments boolean, ip_id long, tcp_seq long, tcp_flags int, payload binary"
#: Rows of a scan: packets, and for each file read to its end or to its damage one row with ``records`` (``seq`` is null).
SCAN = f"{PACKETS}, records long, failure string"
RR = "array<struct<name:string,type:int,data:string>>"
MESSAGES = f"header struct<id:int,qr:int,opcode:int,aa:boolean,tc:boolean,rd:boolean,ra:boolean,ad:boolean,cd:boolean,rcode:int,qdcount:int,ancount:int,nscount:int,arcount:int>, questions array<struct<qname:string,qtype:int,qclass:int>>, answer {RR}, authority {RR}, additional {RR}, opt struct<udp:int,ext_rcode:int,version:int,do:boolean,options:array<struct<code:int,info_code:int,ecs_addr:string,ecs_mask:int>>>"


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, content) of .pcap, .gz, .xz and .bz2 files (case counts)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{pcap,gz,xz,bz2}").option("recursiveFileLookup", "true").load(path)


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_SCAN_ARROW = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in SCAN.split(", "))])


def _scan_rows(path: str, found: Iterator[tuple[int, int, bytes]], link: Callable[[], int], first: int = 0, skip: int = 0, ends: bool = True) -> Iterator[pa.RecordBatch]:
    """Batches of a scan from a file's records; ``first`` is the number of the first of them, records numbered under
    ``skip`` aren't given. With ``ends`` a last row tells how many records the file has."""
    out, size, seq, failure = [], 0, first, None
    try:
        for _, ts, frame in found:
            if seq >= skip and (p := packet(frame, link())):
                out.append({"file": path, "seq": seq, "ts_ms": ts} | p)
                size += len(frame)
            seq += 1
            if len(out) >= 5000 or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_SCAN_ARROW)
                out, size = [], 0
    except Damaged as e:
        failure = str(e)
    if ends or failure:
        out.append({"file": path, "records": seq, "failure": failure})
    yield pa.RecordBatch.from_pylist(out, schema=_SCAN_ARROW)


def _stream_rows(path: str, raw, skip: int = 0) -> Iterator[pa.RecordBatch]:
    """A scan of one file from its first byte, unpacked as it is read."""
    lay = None

    def found():
        nonlocal lay
        f = opened(path, raw)
        lay = layout(records._read(f, records.FILE_HEADER))
        yield from records.records(f, lay)

    yield from _scan_rows(path, found(), lambda: lay.link, skip=skip)


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", time_of_millis("ts_ms")).drop("ts_ms")


def scan(captures: DataFrame) -> DataFrame:
    """Packets and endings of (path, content) rows. Where there is a column ``skip``, a file's first ``skip`` records aren't
    given again."""
    skip = F.col("skip").cast("long") if "skip" in captures.columns else F.lit(0).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content, n in zip(b.column("path").to_pylist(), b.column("content"), b.column("skip").to_pylist()):
                yield from _stream_rows(path, io.BytesIO(memoryview(content.as_buffer()) if content.is_valid else b""), n or 0)

    return _timed(captures.select("path", "content", skip.alias("skip")).mapInArrow(run, SCAN))


def scan_files(spark: SparkSession, files: DataFrame, open_file: Callable = open_path, block_bytes: int = 64 << 20) -> DataFrame:
    """Packets and endings of the capture files in ``files`` (path, length and, if wanted, skip), of any size: each is
    opened by ``open_file`` in tasks; plain ones are read by ranges of ``block_bytes``."""
    name = F.col("path").alias("file")
    skip = (F.col("skip") if "skip" in files.columns else F.lit(0)).cast("long").alias("skip")
    packed = F.element_at(F.split("path", r"\."), -1).isin("gz", "xz", "bz2")
    rows = cut(files.select(name, F.col("length").alias("size"), skip, packed.alias("packed")))  # listed once
    blocks = records.stitched(rows.filter("NOT packed"), block_bytes, open_file).join(rows.select("file", "skip"), "file")
    last = F.col("failure").isNotNull() | (F.col("stop") >= F.col("size"))
    plain = blocks.filter("records > 0 OR failure IS NOT NULL OR stop >= size").select("file", "start", "stop", "first", "failure", last.alias("last"), "skip")
    whole = rows.filter("packed").select("file", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"), F.lit(0).cast("long").alias("first"), F.lit(None).cast("string").alias("failure"), F.lit(True).alias("last"), "skip")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with open_file(r["file"]) as raw:
                    if r["start"] is None:
                        yield from _stream_rows(r["file"], raw, r["skip"] or 0)
                        continue
                    yield from _range_rows(raw, r)

    return _timed(dealt(plain.unionByName(whole), "file", "first").mapInArrow(run, SCAN))


def _range_rows(raw, r: dict) -> Iterator[pa.RecordBatch]:
    """The records of a range whose first one is known."""
    lay = None

    def found():
        nonlocal lay
        lay = layout(raw.read(records.FILE_HEADER))
        raw.seek(r["start"])
        yield from records.records(io.BufferedReader(raw, records.READ_BYTES) if isinstance(raw, io.RawIOBase) else raw, lay, r["start"], r["stop"])

    yield from _scan_rows(r["file"], found(), lambda: lay.link, r["first"], r["skip"] or 0, r["last"])


def of_scan(rows: DataFrame) -> DataFrame:
    """The packets of a scan."""
    return rows.filter("seq IS NOT NULL").drop("records", "failure")


def endings(rows: DataFrame) -> DataFrame:
    """(file, records, failure) of each file of a scan: null where it was read to its end, else why not; ``records`` are those
    that were read."""
    return rows.filter("seq IS NULL").select("file", "records", "failure")


def packets(captures: DataFrame) -> DataFrame:
    """One row per captured IP packet of (path, content) rows, in order within its file (``seq``), times in milliseconds."""
    return of_scan(scan(captures))


def read_packets(spark: SparkSession, path: str, open_file: Callable = open_path, block_bytes: int = 64 << 20) -> DataFrame:
    """``packets`` of the capture files under a path."""
    return of_scan(scan_files(spark, read_captures(spark, path).select("path", "length"), open_file, block_bytes))


def _name(m: bytes, at: int) -> tuple[str, int]:
    parts, end, hops = [], None, 0
    while True:
        n = m[at]
        if n & 0xC0 == 0xC0:
            end = end if end is not None else at + 2
            at, hops = int.from_bytes(m[at : at + 2]) & 0x3FFF, hops + 1
            if hops > 64:
                raise ValueError("name loops")
        elif n == 0:
            return ".".join(parts) + ".", end if end is not None else at + 1
        else:
            parts.append(m[at + 1 : at + 1 + n].decode("latin-1"))
            at += 1 + n


def _strings(d: bytes) -> list[str]:
    out, at = [], 0
    while at < len(d):
        out.append(d[at + 1 : at + 1 + d[at]].decode("utf-8", "replace"))
        at += 1 + d[at]
    return out


#: Record types whose data is numbers, then hexadecimal digits (signatures, digests, keys' prints).
_NUMBERS_THEN_HEX = {43: "!HBB", 59: "!HBB", 32769: "!HBB", 44: "!BB", 52: "!BBB", 53: "!BBB"}
#: Those that are a base64 key or signature behind numbers.
_KEYS = (48, 60, 25)


def _times(at: int) -> str:
    return datetime.fromtimestamp(at, timezone.utc).strftime("%Y%m%d%H%M%S")


def _types(d: bytes) -> str:
    """The types that a bit map of windows names, by number."""
    out, at = [], 0
    while at + 2 <= len(d):
        window, size = d[at], d[at + 1]
        for i, byte in enumerate(d[at + 2 : at + 2 + size]):
            out += [str(window << 8 | i << 3 | bit) for bit in range(8) if byte & 0x80 >> bit]
        at += 2 + size
    return " ".join(out)


def _rdata(m: bytes, kind: int, at: int, size: int) -> str:
    """A record's data as text. Types without a form of their own, and data that doesn't have its type's form, are given by
    length and hexadecimal digits."""
    d = m[at : at + size]
    try:
        text = _rdata_text(m, kind, at, size, d)
    except (IndexError, ValueError, struct.error):
        text = None
    return text if text is not None else f"\\# {size}" + (f" {d.hex().upper()}" if d else "")


def _rdata_text(m: bytes, kind: int, at: int, size: int, d: bytes) -> str | None:
    if kind == 1 and size == 4 or kind == 28 and size == 16:
        return address(bytes(d))
    if kind in (2, 5, 12, 39):
        return _name(m, at)[0]
    if kind in (15, 18, 21, 36):
        return f"{int.from_bytes(d[:2])} {_name(m, at + 2)[0]}"
    if kind in (13, 16, 99):
        return " ".join(_strings(d))
    if kind == 6:
        a, x = _name(m, at)
        b, x = _name(m, x)
        return " ".join([a, b, *map(str, struct.unpack_from("!5I", m, x))])
    if kind == 33:
        return " ".join([*map(str, struct.unpack_from("!HHH", d)), _name(m, at + 6)[0]])
    if kind == 35:
        strings, x = [], 4
        for _ in range(3):
            strings.append(f'"{d[x + 1 : x + 1 + d[x]].decode("utf-8", "replace")}"')
            x += 1 + d[x]
        return " ".join([*map(str, struct.unpack_from("!HH", d)), *strings, _name(m, at + x)[0]])
    if kind in _NUMBERS_THEN_HEX:
        head = struct.calcsize(_NUMBERS_THEN_HEX[kind])
        return " ".join([*map(str, struct.unpack_from(_NUMBERS_THEN_HEX[kind], d)), d[head:].hex().upper()])
    if kind in _KEYS:
        return " ".join([*map(str, struct.unpack_from("!HBB", d)), base64.b64encode(d[4:]).decode()])
    if kind == 46:
        covers, algorithm, labels, ttl, until, since, tag = struct.unpack_from("!HBBIIIH", d)
        signer, x = _name(m, at + 18)
        return " ".join([str(covers), str(algorithm), str(labels), str(ttl), _times(until), _times(since), str(tag), signer, base64.b64encode(m[x : at + size]).decode()])
    if kind == 47:
        following, x = _name(m, at)
        return f"{following} {_types(m[x : at + size])}".rstrip()
    if kind in (50, 51):
        algorithm, flags, rounds, salt = struct.unpack_from("!BBHB", d)
        out = [str(algorithm), str(flags), str(rounds), d[5 : 5 + salt].hex().upper() or "-"]
        if kind == 50:
            x = 5 + salt
            out += [base64.b32hexencode(d[x + 1 : x + 1 + d[x]]).decode().rstrip("="), _types(d[x + 1 + d[x] :])]
        return " ".join(out).rstrip()
    if kind == 257:
        tag = d[2 : 2 + d[1]].decode("ascii")
        return f'{d[0]} {tag} "{d[2 + d[1] :].decode("utf-8", "replace")}"'
    if kind == 256:
        return f'{struct.unpack_from("!H", d)[0]} {struct.unpack_from("!H", d, 2)[0]} "{d[4:].decode("utf-8", "replace")}"'
    return None


def _options(d: bytes) -> list[dict]:
    out, at = [], 0
    while at + 4 <= len(d):
        code, size = struct.unpack_from("!HH", d, at)
        v, o = d[at + 4 : at + 4 + size], {"code": code, "info_code": None, "ecs_addr": None, "ecs_mask": None}
        if code == 15 and size >= 2:
            o["info_code"] = int.from_bytes(v[:2])
        if code == 8 and size >= 4:
            width = 4 if v[:2] == b"\x00\x01" else 16
            o |= {"ecs_addr": address(bytes(v[4:].ljust(width, b"\0")[:width])), "ecs_mask": v[2]}
        out.append(o)
        at += 4 + size
    return out


def decode(m: bytes) -> dict | None:
    """Header, questions, sections and option record of a DNS message; None if it is malformed."""
    try:
        return _decode(m)
    except (IndexError, ValueError, struct.error):
        return None


def _decode(m: bytes) -> dict:
    ident, flags, qd, an, ns, ar = struct.unpack_from("!6H", m)
    bit = lambda n: bool(flags >> n & 1)
    head = {"id": ident, "qr": flags >> 15, "opcode": flags >> 11 & 15, "aa": bit(10), "tc": bit(9), "rd": bit(8), "ra": bit(7), "ad": bit(5), "cd": bit(4), "rcode": flags & 15, "qdcount": qd, "ancount": an, "nscount": ns, "arcount": ar}
    at, questions, opt = 12, [], None
    for _ in range(qd):
        name, at = _name(m, at)
        kind, cls = struct.unpack_from("!HH", m, at)
        at += 4
        questions.append({"qname": name, "qtype": kind, "qclass": cls})
    sections: list[list[dict]] = [[], [], []]
    for i, n in enumerate((an, ns, ar)):
        for _ in range(n):
            name, at = _name(m, at)
            kind, cls, ttl, size = struct.unpack_from("!HHIH", m, at)
            at += 10
            if at + size > len(m):
                raise ValueError("record data is cut off")
            if kind == 41:
                opt = {"udp": cls, "ext_rcode": ttl >> 24, "version": ttl >> 16 & 255, "do": bool(ttl >> 15 & 1), "options": _options(m[at : at + size])}
            else:
                sections[i].append({"name": name, "type": kind, "data": _rdata(m, kind, at, size)})
            at += size
    return {"header": head, "questions": questions, "answer": sections[0], "authority": sections[1], "additional": sections[2], "opt": opt}


def _reason(m: bytes) -> str | None:
    """Why a message can't be decoded, or None."""
    try:
        _decode(m)
    except (IndexError, ValueError, struct.error) as e:
        return str(e) or type(e).__name__
    return None


def decoded(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """``rows`` with the decoded message's columns in place of the payload, and ``malformed``: why a message could not be
    decoded, or null."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    keep = [f for f in rows.schema.fields if f.name != payload]
    target = StructType([*keep, *StructType.fromDDL(MESSAGES + ", malformed string").fields])
    schema = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 5000):
                out = []
                for r in whole.slice(at, 5000).to_pylist():
                    try:
                        out.append(r | _decode(r.pop(payload) or b""))
                    except (IndexError, ValueError, struct.error) as e:
                        out.append(r | {"malformed": str(e) or type(e).__name__})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, target)


def messages(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """``rows`` whose payload is a DNS message, decoded; see ``malformed`` for the others."""
    return decoded(rows, payload).filter("malformed IS NULL").drop("malformed")


def malformed(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """(file, seq, ts, reason) of rows whose payload could not be decoded, over either protocol. What was decoded of the
    others isn't kept, so only the few malformed ones leave Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            why = pa.array([_reason(m or b"") for m in b.column(3).to_pylist()], pa.string())
            whole = pa.RecordBatch.from_arrays([*b.columns[:3], why], names=["file", "seq", "ts", "reason"])
            yield whole.filter(why.is_valid())

    x = rows.select("file", "seq", "ts", payload)
    kinds = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x.mapInArrow(run, f"file {kinds['file']}, seq {kinds['seq']}, ts {kinds['ts']}, reason string")


def flat_messages(decoded: DataFrame) -> DataFrame:
    """Decoded messages as the flat columns that pairing takes: the client is the side that isn't port 53."""
    asks = F.col("header.qr") == 0
    pick = lambda a, b: F.when(asks, F.col(a)).otherwise(F.col(b))
    q = F.try_element_at("questions", F.lit(1))
    head = [F.col(f"header.{n}").alias(n) for n in ("qr", "opcode", "aa", "tc", "rd", "ra", "ad", "cd", "rcode", "qdcount", "ancount", "nscount", "arcount")]
    subnet = F.try_element_at(F.filter("opt.options", lambda o: o["code"] == 8), F.lit(-1))["ecs_addr"]
    more = ["part"] if "part" in decoded.columns else []
    return decoded.select(
        *more, F.col("file").alias("capture_file"), "seq", "ts", F.col("header.id").alias("dns_id"), *head, F.col("protocol").alias("prot"), "ip_version", F.col("ttl").alias("ip_ttl"), pick("src", "dst").alias("client_ip"), pick("src_port", "dst_port").alias("client_port"), pick("dst", "src").alias("server_ip"),
        q["qname"].alias("qname"), q["qtype"].alias("qtype"), q["qclass"].alias("qclass"), F.col("opt.ext_rcode").alias("opt_ext_rcode"), F.col("opt.udp").alias("edns_udp"), F.col("opt.version").alias("edns_version"), F.col("opt.do").alias("edns_do"), F.col("opt.options").alias("options"), subnet.alias("ecs_ip"), "msg_len", "tcp_rtt", "answer", "authority", "additional",
    )
