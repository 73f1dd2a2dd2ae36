"""Record data of many types as text."""

import struct

import pytest
from test_dns import dns_message, name_bytes

from wirelens.sources import capture

N = name_bytes("a.nl")
CASES = [
    (1, bytes([1, 2, 3, 4]), "1.2.3.4"), (28, bytes(15) + b"\1", "::1"), (1, b"\1\2\3", "\\# 3 010203"), (2, N, "a.nl."), (39, N, "a.nl."), (15, b"\0\5" + N, "5 a.nl."), (16, b"\2ab\3c d", "ab c d"), (16, b"", ""),
    (6, N + N + struct.pack("!5I", 1, 2, 3, 4, 5), "a.nl. a.nl. 1 2 3 4 5"), (33, struct.pack("!HHH", 1, 2, 443) + N, "1 2 443 a.nl."), (35, struct.pack("!HH", 10, 20) + b"\1u\3sip\0" + N, '10 20 "u" "sip" "" a.nl.'),
    (43, struct.pack("!HBB", 12345, 13, 2) + b"\xab\xcd", "12345 13 2 ABCD"), (44, b"\4\2\xff", "4 2 FF"), (52, b"\3\1\1\x0a", "3 1 1 0A"), (48, struct.pack("!HBB", 257, 3, 13) + b"key", "257 3 13 a2V5"),
    (46, struct.pack("!HBBIIIH", 1, 13, 2, 300, 1_700_000_000, 0, 7) + N + b"sig", "1 13 2 300 20231114221320 19700101000000 7 a.nl. c2ln"), (47, N + b"\0\1\x40\1\1\x40", "a.nl. 1 257"),
    (50, b"\1\0\0\5\2\xaa\xbb\x05hello\0\1\x40", "1 0 5 AABB D1IMOR3F 1"), (51, b"\1\0\0\5\0", "1 0 5 -"), (257, b"\0\5issueca.nl", '0 issue "ca.nl"'), (256, struct.pack("!HH", 1, 2) + b"https://a.nl", '1 2 "https://a.nl"'),
    (65, b"\0\1\0", "\\# 3 000100"), (65534, b"", "\\# 0"), (33, b"\0", "\\# 1 00"), (46, b"\0\1", "\\# 2 0001"),
]


@pytest.mark.parametrize("kind,data,text", CASES)
def test_record_data(kind, data, text):
    assert capture.decode(dns_message(qr=1, answers=[(kind, data)]))["answer"] == [{"name": "www.zone.nl.", "type": kind, "data": text}]
