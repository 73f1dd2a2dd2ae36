"""Frames to packets: link headers, both versions of IP with extension headers and fragments, UDP and TCP headers."""

from __future__ import annotations

import ipaddress
import struct
from functools import lru_cache

#: Link types by number.
ETHERNET, RAW, RAW_4, RAW_6, COOKED, COOKED_2, NULL, LOOP = 1, 101, 228, 229, 113, 276, 0, 108
_V4, _V6 = b"\x08\x00", b"\x86\xdd"
_TAGS = (b"\x81\x00", b"\x88\xa8", b"\x91\x00")
#: Version-6 headers that say what follows and how long they are; of fragments; of authentication (in words of four).
HOP, ROUTING, FRAGMENT, AUTH, DESTINATION, MOBILITY = 0, 43, 44, 51, 60, 135
TCP, UDP = 6, 17


@lru_cache(1 << 16)
def address(raw: bytes) -> str:
    """Text of an address of 4 or 16 bytes; few addresses have most packets."""
    return str(ipaddress.ip_address(raw))


def network(frame: bytes, link: int) -> bytes | None:
    """The IP packet of a frame, or None if it holds none."""
    if link == ETHERNET:
        at, kind = 14, frame[12:14]
        while kind in _TAGS:
            kind, at = frame[at + 2 : at + 4], at + 4
        return frame[at:] if kind in (_V4, _V6) else None
    if link in (RAW, RAW_4, RAW_6, 12, 14):
        return frame
    if link == COOKED:
        return frame[16:] if frame[14:16] in (_V4, _V6) else None
    if link == COOKED_2:
        return frame[20:] if frame[:2] in (_V4, _V6) else None
    if link in (NULL, LOOP):
        return frame[4:]
    return None


def packet(frame: bytes, link: int = ETHERNET) -> dict | None:
    """Fields of an IP packet and its payload: behind the UDP or TCP header, or the whole body of a fragment. None for
    other frames and headers that are cut off."""
    ip = network(frame, link)
    if not ip:
        return None
    version = ip[0] >> 4
    p: dict = {"do_not_fragment": False, "frag_offset": 0, "more_fragments": False, "ip_id": None, "tcp_seq": None, "tcp_flags": None, "src_port": None, "dst_port": None}
    if version == 4 and len(ip) >= 20:
        size = (ip[0] & 15) * 4
        total, ip_id, frag = struct.unpack_from("!HHH", ip, 2)
        p |= {"ip_version": 4, "ttl": ip[8], "protocol": ip[9], "ip_id": ip_id, "do_not_fragment": bool(frag & 0x4000), "more_fragments": bool(frag & 0x2000), "frag_offset": (frag & 0x1FFF) * 8}
        p |= {"src": address(bytes(ip[12:16])), "dst": address(bytes(ip[16:20]))}
        # Senders that leave splitting to the card write no length.
        body = ip[size : total or None]
    elif version == 6 and len(ip) >= 40:
        total = struct.unpack_from("!H", ip, 4)[0]
        p |= {"ip_version": 6, "ttl": ip[7], "src": address(bytes(ip[8:24])), "dst": address(bytes(ip[24:40]))}
        if (found := _behind_extensions(ip[6], ip[40 : 40 + total if total else None], p)) is None:
            return None
        p["protocol"], body = found
    else:
        return None
    if p["frag_offset"] == 0 and not p["more_fragments"]:
        body = _transport(p, body)
    return p | {"payload": body}


def _behind_extensions(kind: int, body: bytes, p: dict) -> tuple[int, bytes] | None:
    """(protocol, body) behind a chain of version-6 extension headers; fields of a fragment header go to ``p``. A later
    fragment's body begins with no header."""
    while kind in (HOP, ROUTING, FRAGMENT, AUTH, DESTINATION, MOBILITY):
        if len(body) < 8:
            return None
        if kind == FRAGMENT:
            offset, p["ip_id"] = struct.unpack_from("!HI", body, 2)
            p["frag_offset"], p["more_fragments"] = offset & 0xFFF8, bool(offset & 1)
            size = 8
        else:
            size = (body[1] + 2) * 4 if kind == AUTH else (body[1] + 1) * 8
        kind, body = body[0], body[size:]
        if p["frag_offset"] > 0:
            break
    return kind, body


def _transport(p: dict, body: bytes) -> bytes:
    if p["protocol"] == UDP and len(body) >= 8:
        p["src_port"], p["dst_port"] = struct.unpack_from("!HH", body)
        return body[8:]
    if p["protocol"] == TCP and len(body) >= 20:
        p["src_port"], p["dst_port"], p["tcp_seq"] = struct.unpack_from("!HHI", body)
        p["tcp_flags"] = body[13]
        return body[(body[12] >> 4) * 4 :]
    return body
