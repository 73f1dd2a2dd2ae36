"""One wide typed row per transaction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cname_chain, client_subnet, extended_errors, extended_rcode, millis_between, option_codes, rdata, server_site
from .address import Enrichment, joined_dimension
from .names import domain_parts, tld_filter
from .ranges import lookup

_RDATA = "array<struct<section:int,type:int,data:string>>"
_I, _S, _B, _LI, _LS = "int", "string", "boolean", "array<int>", "array<string>"
#: The table's columns in order.
COLUMNS = [
    ("dns_id", _I), ("time", "timestamp_ntz"), ("dns_qname", _S), ("dns_domainname", _S), ("dns_tld", _S), ("dns_qname_full", _S), ("dns_labels", _I), ("ip_ttl", _I), ("ip_version", _I), ("prot", _I),
    ("ip_src", _S), ("prot_src_port", _I), ("ip_dst", _S), ("prot_dst_port", _I), ("dns_aa", _B), ("dns_tc", _B), ("dns_rd", _B), ("dns_ra", _B), ("dns_ad", _B), ("dns_cd", _B),
    ("dns_ancount", _I), ("dns_arcount", _I), ("dns_nscount", _I), ("dns_qdcount", _I), ("dns_opcode", _I), ("dns_rcode", _I), ("dns_qtype", _I), ("dns_qclass", _I), ("ip_geo_country", _S), ("ip_asn", _S),
    ("ip_asn_org", _S), ("edns_udp", _I), ("edns_version", _I), ("edns_do", _B), ("edns_options", _LI), ("edns_ecs", _S), ("edns_ecs_ip_asn", _S), ("edns_ecs_ip_asn_org", _S), ("edns_ecs_ip_geo_country", _S), ("edns_ext_error", _LI),
    ("edns_server_options", _LI), ("dns_req_len", _I), ("dns_proc_time", _I), ("dns_res_len", _I), ("dns_pub_resolver", _S), ("tcp_rtt", _I), ("server", _S), ("server_location", _S), ("dns_rdata", _RDATA), ("dns_cname", _LS),
]
#: The same as DDL, for readers and streams.
DDL = ", ".join(f"{n} {t}" for n, t in COLUMNS)


#: Copies of an address's entry where the dimension is joined.
SALTS = 8


@dataclass(frozen=True)
class Options:
    """How rows are built."""

    privacy: bool = False
    extended_rcode: bool = True
    rdata: bool = False
    rdata_dnssec: bool = False
    cname: bool = True
    blocked_tlds: tuple[str, ...] = ()
    server_port: int = 53


def _field(df: DataFrame, side: str, name: str, kind: str) -> Column:
    """A message field of a side, or null where the messages don't have it."""
    return F.col(f"{side}.{name}") if name in df.schema[side].dataType.names else F.lit(None).cast(kind)


def either(df: DataFrame, name: str, kind: str = "int") -> Column:
    return F.coalesce(_field(df, "req", name, kind), _field(df, "rsp", name, kind))


def flags(df: DataFrame, o: Options = Options()) -> dict[str, Column]:
    """Header fields: of requests, of responses, merged, and sentinels."""
    q, r = (lambda n, k="int", s=s: _field(df, s, n, k) for s in ("req", "rsp"))
    code = extended_rcode(r("rcode"), r("opt_ext_rcode")) if o.extended_rcode else r("rcode")
    return {
        "dns_id": F.coalesce(either(df, "dns_id"), F.lit(-1)),
        "dns_opcode": F.coalesce(either(df, "opcode"), F.lit(-1)),
        "dns_rcode": F.when(F.col("rsp").isNotNull(), code).otherwise(F.lit(-1)),
        "dns_rd": q("rd", "boolean"), "dns_cd": q("cd", "boolean"),
        **{f"dns_{n}": r(n, "boolean") for n in ("aa", "tc", "ra", "ad")},
        **{f"dns_{n}": r(n) for n in ("ancount", "arcount", "nscount")},
        "dns_qdcount": F.coalesce(r("qdcount"), q("qdcount")),
        "dns_qtype": either(df, "qtype"), "dns_qclass": either(df, "qclass"),
        "dns_req_len": q("msg_len"), "dns_res_len": r("msg_len"),
    }


def transport(df: DataFrame, o: Options = Options()) -> dict[str, Column]:
    """Client and server side, times and round trip. Client fields of messages already name the client."""
    q = lambda n, k="int": _field(df, "req", n, k)
    rtt = q("tcp_rtt")
    client = either(df, "client_ip", "string")
    return {
        "time": F.coalesce(F.col("req.ts"), F.col("rsp.ts")).cast("timestamp_ntz"),
        "ip_ttl": q("ip_ttl"),
        "ip_version": either(df, "ip_version"), "prot": either(df, "prot"),
        "ip_src": F.lit(None).cast("string") if o.privacy else client,
        "prot_src_port": either(df, "client_port"),
        "ip_dst": either(df, "server_ip", "string"), "prot_dst_port": F.lit(o.server_port),
        "dns_proc_time": millis_between(F.col("req.ts"), F.col("rsp.ts")),
        "tcp_rtt": F.when((q("prot") == 6) & (rtt != -1), rtt),
    }


def edns(df: DataFrame, o: Options = Options()) -> dict[str, Column]:
    """Option record fields of requests and responses."""
    kind = "array<struct<code:int,info_code:int,ecs_addr:string,ecs_mask:int>>"
    q, r = _field(df, "req", "options", kind), _field(df, "rsp", "options", kind)
    return {
        "edns_udp": _field(df, "req", "edns_udp", "int"), "edns_version": _field(df, "req", "edns_version", "int"), "edns_do": _field(df, "req", "edns_do", "boolean"),
        "edns_options": option_codes(q), "edns_server_options": option_codes(r), "edns_ext_error": extended_errors(r),
        "edns_ecs": F.lit(None).cast("string") if o.privacy else client_subnet(q),
    }


def addresses_of(messages: DataFrame) -> DataFrame:
    """The distinct addresses that rows of ``messages`` are enriched by: clients and client subnets. Taken here, before
    pairing, they cost one small aggregation."""
    known = messages.select(F.col("client_ip").alias("address"))
    if "ecs_ip" in messages.columns:
        known = known.unionByName(messages.select(F.col("ecs_ip").alias("address")))
    return known.filter("address IS NOT NULL").distinct()


def _with_dimension(x: DataFrame, enrichments: list[Enrichment], addresses: DataFrame | None) -> DataFrame:
    """Adds _c and _e, the enrichments of _client and _ecs, by joins with the dimension of all addresses."""
    if addresses is None:
        addresses = x.select(F.col("_client").alias("address")).unionByName(x.select(F.col("_ecs").alias("address")))
    dim = joined_dimension(addresses, enrichments)
    # Rows without an address are spread over keys that none has, and a busy client's rows over salted copies of its entry.
    salt = F.pmod(F.xxhash64("req.seq", "rsp.seq"), F.lit(SALTS)).cast("string")
    entry = F.explode(F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.concat("address", F.lit("/"), i.cast("string"))))
    copies = dim.select(entry.alias("_a"), F.struct(*[e.column for e in enrichments]).alias("_v"))
    for key, name in (("_client", "_c"), ("_ecs", "_e")):
        own = x.withColumn("_key", F.concat(F.coalesce(key, F.xxhash64("req.seq", "rsp.seq").cast("string")), F.lit("/"), salt))
        x = own.join(copies.withColumnRenamed("_v", name), F.col("_key") == F.col("_a"), "left").drop("_a", "_key")
    return x


def build_dns(pairs: DataFrame, rules: DataFrame, enrichments: list[Enrichment] = (), o: Options = Options(), addresses: DataFrame | None = None) -> DataFrame:
    """The 50-column rows of transactions. The blocked suffixes go before addresses are looked up. ``enrichments`` with
    columns of the table fill client columns; those of country and ASN also fill the client-subnet columns. Lists that
    fit are searched where the rows are. Longer ones are joined, for which ``addresses`` are those of the messages
    (``addresses_of``); without them they are taken from the pairs, which computes the pairs once more."""
    rr = "array<struct<name:string,type:int,data:string>>"
    name = F.coalesce(F.col("req.qname"), F.col("rsp.qname"))
    x = pairs.withColumn("_client", either(pairs, "client_ip", "string")).withColumn("_ecs", _field(pairs, "req", "ecs_ip", "string")).withColumn("_qname", name)
    x = tld_filter(domain_parts(x, rules, "_qname"), o.blocked_tlds)
    columns = {**flags(pairs, o), **transport(pairs, o), **edns(pairs, o)}
    columns |= {"dns_qname": F.col("subdomain"), "dns_domainname": F.col("domain"), "dns_tld": F.col("tld"), "dns_qname_full": F.col("qname_full"), "dns_labels": F.col("labels")}
    place = server_site("capture_file")
    columns |= {"server": place["server"], "server_location": place["site"]}
    sections = [_field(pairs, "rsp", s, rr) for s in ("answer", "authority", "additional")]
    columns["dns_rdata"] = rdata(*sections, dnssec=o.rdata_dnssec) if o.rdata else F.lit(None).cast(_RDATA)
    columns["dns_cname"] = cname_chain(sections[0]) if o.cname else F.lit(None).cast(_LS)
    if enrichments:
        found = lookup(list(enrichments))
        x = x.withColumns({"_c": found("_client"), "_e": found("_ecs")}) if found else _with_dimension(x, list(enrichments), addresses)
        columns |= {e.column: F.col(f"_c.{e.column}") for e in enrichments}
        columns |= {f"edns_ecs_{e.column}": F.col(f"_e.{e.column}") for e in enrichments if f"edns_ecs_{e.column}" in dict(COLUMNS)}
    return x.select(*[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in COLUMNS])


def align(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of an older and a newer schema together; columns that one lacks are null there."""
    return table.unionByName(rows, allowMissingColumns=True)
