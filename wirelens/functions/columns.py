"""Column functions for names, addresses and message fields. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resource record types by number.
RR_TYPES = {
    1: "A", 2: "NS", 3: "MD", 4: "MF", 5: "CNAME", 6: "SOA", 7: "MB", 8: "MG", 9: "MR", 10: "NULL", 11: "WKS", 12: "PTR", 13: "HINFO", 14: "MINFO", 15: "MX", 16: "TXT", 17: "RP", 18: "AFSDB", 19: "X25", 20: "ISDN",
    21: "RT", 22: "NSAP", 23: "NSAP-PTR", 24: "SIG", 25: "KEY", 26: "PX", 27: "GPOS", 28: "AAAA", 29: "LOC", 30: "NXT", 31: "EID", 32: "NIMLOC", 33: "SRV", 34: "ATMA", 35: "NAPTR", 36: "KX", 37: "CERT", 38: "A6", 39: "DNAME", 40: "SINK",
    41: "OPT", 42: "APL", 43: "DS", 44: "SSHFP", 45: "IPSECKEY", 46: "RRSIG", 47: "NSEC", 48: "DNSKEY", 49: "DHCID", 50: "NSEC3", 51: "NSEC3PARAM", 52: "TLSA", 53: "SMIMEA", 55: "HIP", 56: "NINFO", 57: "RKEY", 58: "TALINK", 59: "CDS", 60: "CDNSKEY",
    61: "OPENPGPKEY", 62: "CSYNC", 63: "ZONEMD", 64: "SVCB", 65: "HTTPS", 99: "SPF", 100: "UINFO", 101: "UID", 102: "GID", 103: "UNSPEC", 104: "NID", 105: "L32", 106: "L64", 107: "LP", 108: "EUI48", 109: "EUI64",
    249: "TKEY", 250: "TSIG", 251: "IXFR", 252: "AXFR", 253: "MAILB", 254: "MAILA", 255: "ANY", 256: "URI", 257: "CAA", 258: "AVC", 259: "DOA", 260: "AMTRELAY", 32768: "TA", 32769: "DLV",
}
#: Transfer queries, DNSSEC record types, option codes.
TRANSFERS = (251, 252)
DNSSEC_TYPES = (43, 46, 48)
OPTION_SUBNET, OPTION_ERROR = 8, 15

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed and written once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(name: str | Column) -> Column:
    """Edge control characters and spaces off, one final dot off, leading dots off, inner ones out, others than ASCII
    as '?', lower case. Null for null; empty if nothing is left."""
    x = F.regexp_replace(col(name), _TRIM, "")
    x = F.regexp_replace(F.regexp_replace(x, r"\.$", ""), r"^\.+", "")
    x = F.regexp_replace(F.regexp_replace(x, r"[\x00-\x20]", ""), r"[^\x00-\x7E]", "?")
    return ascii_lower(x)


def labels(clean: str | Column) -> Column:
    """Labels of a cleaned name, without empty ones at the end; an empty array for an empty name."""
    x = F.regexp_replace(col(clean), r"\.+$", "")
    return F.when(F.length(x) > 0, F.split(x, r"\.")).otherwise(F.array().cast("array<string>"))


def last_labels(parts: Column, n: int) -> Column:
    """The last n labels as a name; null if there are fewer."""
    return F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), "."))


def ipv4_number(address: str | Column) -> Column:
    """Number of a dotted address; null unless it has four parts of 0 to 255."""
    a = col(address)
    number = let(F.split(a, r"\.").cast("array<int>"), lambda parts: F.when(F.forall(parts, lambda p: p <= 255), F.aggregate(parts, F.lit(0).cast("long"), lambda t, p: t * 256 + p)))
    return F.when(a.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), number)


def ipv6_halves(address: str | Column) -> Column:
    """struct(hi, lo) of a version-6 address, with '::' and a dotted version-4 tail allowed; null for any other text."""
    none = F.array().cast("array<string>")

    def dotted(a: Column) -> Column:
        tail = F.regexp_extract(a, r":([0-9]{1,3}(?:\.[0-9]{1,3}){3})$", 1)
        return F.when(F.contains(a, F.lit(".")), let(tail, lambda t: let(ipv4_number(t), lambda n: F.concat(F.left(a, F.length(a) - F.length(t)), F.format_string("%x:%x", F.shiftright(n, 16), n.bitwiseAND(0xFFFF)))))).otherwise(a)

    def sides(text: Column) -> Column:
        groups = F.transform(F.split(text, "::"), lambda s: F.when(F.length(s) > 0, F.split(s, ":")).otherwise(none))
        return let(groups, lambda g: F.when(F.size(g) == 1, g[0]).when((F.size(g) == 2) & (F.size(g[0]) + F.size(F.get(g, F.lit(1))) < 8), F.concat(g[0], F.array_repeat(F.lit("0"), F.lit(8) - F.size(g[0]) - F.size(F.get(g, F.lit(1)))), F.get(g, F.lit(1)))))

    def halves(whole: Column) -> Column:
        digits = F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")
        word = lambda d, i: F.conv(F.substring(d, 8 * i + 1, 8), 16, 10).cast("long")
        half = lambda d, i: F.shiftleft(word(d, i), 32).bitwiseOR(word(d, i + 1))
        pair = let(digits, lambda d: F.struct(half(d, 0).alias("hi"), half(d, 2).alias("lo")))
        return F.when((F.size(whole) == 8) & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$")), pair)

    a = F.lower(col(address))
    return F.when(F.contains(a, F.lit(":")), let(let(let(a, dotted), sides), halves))


def is_v4(address: str | Column) -> Column:
    return F.contains(col(address), F.lit("."))


def is_v6(address: str | Column) -> Column:
    return F.contains(col(address), F.lit(":"))


def ascii_lower(text: str | Column) -> Column:
    """Lower case of A to Z only; equal for names that are equal without regard to ASCII case."""
    return F.translate(col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extended_rcode(raw: str | Column, extension: str | Column) -> Column:
    """12-bit response code."""
    return F.shiftleft(F.coalesce(col(extension), F.lit(0)), 4).bitwiseOR(col(raw))


def type_name(number: str | Column) -> Column:
    """Name of a record type; TYPE and the number for one without a name, null for null."""
    n = col(number).cast("int")
    named = F.try_element_at(F.create_map(*[F.lit(x) for kv in RR_TYPES.items() for x in kv]), n)
    return F.coalesce(named, F.concat(F.lit("TYPE"), n.cast("string")))


def time_bin(ts: str | Column, seconds: int = 10) -> Column:
    """Start of the bin of packet time, as seconds since the epoch."""
    epoch = F.unix_micros(col(ts).cast("timestamp"))
    return F.floor(epoch / (1_000_000 * seconds)) * seconds


def millis_between(earlier: Column, later: Column) -> Column:
    return ((F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1000).cast("int")


def time_of_millis(ms: str | Column) -> Column:
    """UTC time without zone from epoch milliseconds (session time zone UTC)."""
    return F.timestamp_millis(col(ms)).cast("timestamp_ntz")


def option_codes(options: str | Column) -> Column:
    """Codes of EDNS options; null if there is none."""
    return F.when(F.size(col(options)) > 0, F.transform(col(options), lambda o: o["code"]))


def extended_errors(options: str | Column) -> Column:
    """Info codes of the extended-error options; null if there is none."""
    some = F.filter(col(options), lambda o: o["code"] == OPTION_ERROR)
    return F.when(F.size(some) > 0, F.transform(some, lambda o: o["info_code"]))


def client_subnet(options: str | Column) -> Column:
    """address/mask of the last client-subnet option."""
    last = F.try_element_at(F.filter(col(options), lambda o: o["code"] == OPTION_SUBNET), F.lit(-1))
    return F.concat(last["ecs_addr"], F.lit("/"), last["ecs_mask"].cast("string"))


def rdata(answer: Column, authority: Column, additional: Column, dnssec: bool = False) -> Column:
    """Records of the three sections in order as structs (section 0, 1, 2; type; data), without DNSSEC ones unless asked."""

    def part(number: int, section: Column) -> Column:
        rows = F.coalesce(section, F.array().cast("array<struct<name:string,type:int,data:string>>"))
        rows = rows if dnssec else F.filter(rows, lambda r: ~r["type"].isin(*DNSSEC_TYPES))
        return F.transform(rows, lambda r: F.struct(F.lit(number).alias("section"), r["type"].alias("type"), r["data"].alias("data")))

    return F.concat(*[part(i, s) for i, s in enumerate((answer, authority, additional))])


def cname_chain(answer: str | Column) -> Column:
    """Targets of the answer's CNAME records; null if there is none."""
    some = F.filter(col(answer), lambda r: r["type"] == 5)
    return F.when(F.size(some) > 0, F.transform(some, lambda r: r["data"]))


def has_data(records: str | Column, data: str) -> Column:
    return F.exists(col(records), lambda r: r["data"] == data)


def server_site(key: str | Column, tag_server: str | Column | None = None, tag_site: str | Column | None = None, default_server: str = "unknown", default_site: str = "unknown") -> Column:
    """struct(server, site): both tags, else the last two '_' tokens before the file name's first '-', else defaults."""
    name = F.substring_index(F.element_at(F.split(col(key), "/"), -1), "-", 1)
    parts = F.split(name, "_")
    server, site = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))
    named = (F.size(parts) >= 2) & (F.length(server) > 0) & (F.length(site) > 0)
    a = col(tag_server) if tag_server is not None else F.lit(None).cast("string")
    b = col(tag_site) if tag_site is not None else F.lit(None).cast("string")
    tagged = (F.length(F.trim(a)) > 0) & (F.length(F.trim(b)) > 0)
    pick = lambda tag, own, other: F.when(tagged, tag).when(named, own).otherwise(other)
    return F.struct(pick(a, server, F.lit(default_server)).alias("server"), pick(b, site, F.lit(default_site)).alias("site"))


def supported_format(key: str | Column) -> Column:
    """Last extension, with case, is one of pcap, gz, xz, bz2."""
    return F.regexp_extract(col(key), r"\.([^./]*)$", 1).isin("pcap", "gz", "xz", "bz2")
