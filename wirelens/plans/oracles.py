"""The same queries in SQL, written apart from the DataFrame code."""

from __future__ import annotations

from ..operators.rows import COLUMNS
from . import views as V

#: Milliseconds that a streamed request waits.
WAIT_MS = 21_600_000

M = f"dns_messages AS ({V.duck(V.MESSAGES)})"
XFR = f"""{M},
x AS (SELECT *, sum(CASE WHEN qr = 0 AND qtype IN (251, 252) THEN 1 ELSE 0 END) OVER (PARTITION BY capture_file, dns_id, client_ip, client_port ORDER BY ts, seq) AS epoch FROM dns_messages),
y AS (SELECT *, sum(qr) OVER (PARTITION BY capture_file, dns_id, client_ip, client_port, epoch ORDER BY ts, seq) AS nth FROM x),
kept AS (SELECT * FROM y WHERE NOT (qr = 0 AND qtype IN (251, 252)) AND NOT (qr = 1 AND epoch > 0 AND nth > 1))"""
WIN = f"""{XFR},
win AS (SELECT seq, qr, lag(qr) OVER k AS pqr, lag(seq) OVER k AS pseq, lead(qr) OVER k AS nqr FROM kept WINDOW k AS (PARTITION BY capture_file, dns_id, client_ip, client_port, qname ORDER BY ts, seq))"""
PAIRS = f"""{WIN},
pairs AS (SELECT CASE WHEN qr = 0 THEN seq WHEN pqr = 0 THEN pseq END AS req_seq, CASE WHEN qr = 1 THEN seq END AS rsp_seq FROM win WHERE qr = 1 OR nqr IS NULL)"""


def clean(c: str) -> str:
    x = f"regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    x = f"regexp_replace(regexp_replace({x}, '\\.$', ''), '^\\.+', '')"
    return f"lower(regexp_replace({x}, '[\\x00-\\x20]', '', 'g'))"


EXACT = [r for r in V.RULES if r[0] not in "*!"]
IN = "(" + ", ".join(f"'{r}'" for r in EXACT) + ")"


def parts(source: str, key: str = "qname", standard: bool = False) -> str:
    """CTEs named_: names and their parts."""
    last = lambda n: f"CASE WHEN len(l) >= {n} THEN array_to_string(l[len(l) - {n - 1}:], '.') END"
    one = last(1)
    multi = " ".join(f"WHEN {last(n)} IN {IN} THEN {last(n)}" for n in (2, 3, 4))
    suffix = f"CASE WHEN {one} IN {IN} THEN CASE {multi} ELSE {one} END ELSE {one} END"
    if standard:
        base = " ".join(f"WHEN {last(n)} IN {IN} THEN {n}" for n in (5, 4, 3, 2, 1))
        suffix = f"""array_to_string(l[greatest(1, len(l) - (CASE WHEN {last(2)} = 'www.ck' THEN 1 WHEN {last(3)} = 'city.kawasaki.jp' THEN 2
            WHEN {last(3)} LIKE '%.kawasaki.jp' THEN 3 WHEN {last(2)} LIKE '%.ck' THEN 2 ELSE CASE {base} ELSE 1 END END) + 1):], '.')"""
    return f"""c_ AS (SELECT {key} AS qname, {clean(key)} AS c FROM ({source})),
l_ AS (SELECT qname, c, CASE WHEN rtrim(c, '.') = '' THEN [] ELSE string_split(rtrim(c, '.'), '.') END AS l FROM c_),
s_ AS (SELECT qname, l, len(l) AS n, {suffix} AS s, len(l) > 0 AS ok FROM l_),
named_ AS (SELECT qname, CASE WHEN ok THEN s END AS tld,
  CASE WHEN ok AND n > len(string_split(s, '.')) THEN array_to_string(l[n - len(string_split(s, '.')):], '.') END AS domain,
  CASE WHEN ok AND n > len(string_split(s, '.')) + 1 THEN array_to_string(l[1:n - len(string_split(s, '.')) - 1], '.') END AS subdomain,
  CAST(CASE WHEN qname IS NULL THEN NULL WHEN ok THEN n ELSE 0 END AS INT) AS labels, CASE WHEN NOT ok THEN qname END AS qname_full FROM s_)"""


NAMES = f"""SELECT DISTINCT qname FROM (SELECT qname FROM dns_messages UNION ALL SELECT regexp_extract(url, '^[a-z]+://([^/:]+)', 1) FROM pages
 UNION ALL SELECT c_mktsegment || '.x.' || c_nationkey || list_extract(['.ck', '.www.ck', '.kawasaki.jp', '.city.kawasaki.jp', '.ma.us', '.pvt.k12.ma.us', '..', '. . NL'], c_custkey % 8 + 1) FROM customer)"""

IP = "(CAST(split_part({0}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({0}, '.', 2) AS BIGINT) * 65536 + CAST(split_part({0}, '.', 3) AS BIGINT) * 256 + CAST(split_part({0}, '.', 4) AS BIGINT))"


def nets(rows: list[tuple], names: str, alias: str) -> str:
    ip, plen = IP.format("split_part(cidr, '/', 1)"), "CAST(split_part(cidr, '/', 2) AS INT)"
    return f"{alias} AS (SELECT *, {plen} AS plen, CASE WHEN contains(cidr, '.') THEN {ip} END AS net, CASE WHEN contains(cidr, '.') THEN CAST(pow(2, 32 - {plen}) AS BIGINT) END AS width FROM {V.values(rows)} AS t(cidr, {names}))"


RES, GEO = nets(V.RESOLVERS, "name, priority", "res"), nets(V.PLACES, "iso, asn, org", "geo")
def inside(address: str, cidr: str) -> str:
    """Containment of this file's version-6 addresses, 2001:db8:group::host, as text."""
    return f"""({address} LIKE '2001:db8:%' AND ({cidr} = '2001:db8::/32' OR {cidr} LIKE '%/48' AND starts_with({address}, split_part({cidr}, '::', 1) || '::') OR {cidr} LIKE '%/112' AND starts_with({address}, split_part({cidr}, '::', 1) || '::')
 OR {cidr} LIKE '%::80/121' AND starts_with({address}, split_part({cidr}, '::', 1) || '::') AND length(split_part({address}, '::', 2)) = 2 AND split_part({address}, '::', 2) >= '80'))"""


#: dim: each address with what is known of it.
DIM = f"""{RES}, {GEO},
addr AS (SELECT DISTINCT a AS address, CASE WHEN contains(a, '.') THEN {IP.format('a')} END AS ip FROM (SELECT client_ip AS a FROM dns_messages UNION ALL SELECT ecs_ip FROM dns_messages) WHERE a IS NOT NULL),
dim AS (SELECT address,
 (SELECT min_by(name, priority) FROM res WHERE ip > net AND ip < net + width - 1 OR {inside('address', 'cidr')}) AS resolver,
 (SELECT max_by(iso, plen) FROM geo WHERE ip >= net AND ip < net + width OR {inside('address', 'cidr')}) AS iso,
 (SELECT max_by(asn, plen) FROM geo WHERE ip >= net AND ip < net + width OR {inside('address', 'cidr')}) AS asn,
 (SELECT max_by(org, plen) FROM geo WHERE ip >= net AND ip < net + width OR {inside('address', 'cidr')}) AS org FROM addr)"""
OPTS = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for cond, code in V.OPTIONS)


def codes(side: str) -> str:
    return f"nullif(concat_ws(',', {OPTS.replace('user_id', side + '.who').replace('event_id', side + '.seq')}), '')"


def rdata(side: str) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN ({side}.seq + {t}) % 3 <> 0 THEN '{s}:{t}:{data}' || ({side}.who % 9) END" for s, _, t, data in V.RECORDS if t != 46) + ")"


#: tx: transactions with all columns, lists as text; q and r sides.
TX = f"""{PAIRS}, {parts('SELECT DISTINCT qname FROM dns_messages')}, {DIM},
tx AS (SELECT p.req_seq, p.rsp_seq, q, r, coalesce(q.dns_id, r.dns_id) AS dns_id, coalesce(q.ts, r.ts) AS time, n.subdomain AS dns_qname, n.domain AS dns_domainname, n.tld AS dns_tld, n.qname_full AS dns_qname_full, n.labels AS dns_labels,
 q.ip_ttl AS ip_ttl, coalesce(q.ip_version, r.ip_version) AS ip_version, coalesce(q.prot, r.prot) AS prot, coalesce(q.client_ip, r.client_ip) AS ip_src, coalesce(q.client_port, r.client_port) AS prot_src_port, coalesce(q.server_ip, r.server_ip) AS ip_dst, CAST(53 AS INT) AS prot_dst_port,
 r.aa AS dns_aa, r.tc AS dns_tc, q.rd AS dns_rd, r.ra AS dns_ra, r.ad AS dns_ad, q.cd AS dns_cd, r.ancount AS dns_ancount, r.arcount AS dns_arcount, r.nscount AS dns_nscount, coalesce(r.qdcount, q.qdcount) AS dns_qdcount,
 q.edns_udp AS edns_udp, q.edns_version AS edns_version, q.edns_do AS edns_do, {codes('q')} AS edns_options, {codes('r')} AS edns_server_options, CASE WHEN r.seq % 5 = 0 THEN CAST(r.seq % 25 AS VARCHAR) END AS edns_ext_error,
 CASE WHEN q.seq % 7 = 0 THEN '10.3.0.' || (q.who % 250) || '/27' WHEN q.who % 6 = 0 THEN '10.0.0.' || (q.who % 250) || '/24' END AS edns_ecs,
 {rdata('r')} AS dns_rdata, CASE WHEN (r.seq + 5) % 3 <> 0 THEN 'alias' || (r.who % 9) END AS dns_cname, coalesce(q.opcode, r.opcode) AS dns_opcode, CAST(CASE WHEN r.seq IS NULL THEN -1 ELSE r.opt_ext_rcode * 16 + r.rcode END AS INT) AS dns_rcode, CAST(coalesce(r.rcode, -1) AS INT) AS raw_rcode,
 coalesce(q.qtype, r.qtype) AS dns_qtype, coalesce(q.qclass, r.qclass) AS dns_qclass, c.iso AS ip_geo_country, c.asn AS ip_asn, c.org AS ip_asn_org, e.asn AS edns_ecs_ip_asn, e.org AS edns_ecs_ip_asn_org, e.iso AS edns_ecs_ip_geo_country,
 q.msg_len AS dns_req_len, CAST((epoch_us(r.ts) - epoch_us(q.ts)) // 1000 AS INT) AS dns_proc_time, r.msg_len AS dns_res_len, c.resolver AS dns_pub_resolver, CASE WHEN q.prot = 6 AND q.tcp_rtt <> -1 THEN q.tcp_rtt END AS tcp_rtt,
 CASE WHEN coalesce(q.capture_file, r.capture_file) LIKE '%ns1%' THEN 'ns1.zone.nl' ELSE 'ns2.zone.nl' END AS server, 'ams' AS server_location
 FROM pairs p LEFT JOIN dns_messages q ON q.seq = p.req_seq LEFT JOIN dns_messages r ON r.seq = p.rsp_seq
 LEFT JOIN named_ n ON n.qname = coalesce(q.qname, r.qname) LEFT JOIN dim c ON c.address = coalesce(q.client_ip, r.client_ip) LEFT JOIN dim e ON e.address = q.ecs_ip)"""

BIN = "epoch_us(time) // 10000000 * 10"


def tx(sql: str) -> str:
    return f"WITH {TX} {sql}"


def counted(name: str, expr: str) -> str:
    return tx(f"SELECT {BIN} AS bin, server, server_location, {expr} AS {name}, count(*) AS n FROM tx WHERE {expr} IS NOT NULL GROUP BY ALL")


QTYPE = "CASE dns_qtype WHEN 1 THEN 'A' WHEN 28 THEN 'AAAA' WHEN 252 THEN 'AXFR' END"
PROTOCOL = "CASE WHEN prot = 17 THEN 'UDP' ELSE 'TCP' END"
FILE = f"'f' || (seq // {V.EVENTS_PER_FILE}) || '.pcap'"
#: pkt: messages with the number of packets they are sent in and the number of the packet that completes them.
PKT = f"""{M}, sent AS (SELECT *, {FILE} AS file, seq // {V.EVENTS_PER_FILE} AS file_no, seq % {V.MALFORMED} = 0 AS bad,
 CASE WHEN ip_version = 4 THEN server_ip ELSE '2001:db8::' || (who % 2 + 1) END AS server,
 CASE WHEN prot = 6 THEN [1, 2, 2, 3][seq % 4 + 1] WHEN seq % 5 = 2 THEN 2 ELSE 1 END AS pieces FROM dns_messages),
pkt AS (SELECT *, CAST(sum(pieces) OVER f AS BIGINT) - pieces AS first_n, CAST(sum(pieces) OVER f AS BIGINT) - pieces + CASE WHEN pieces = 1 THEN 0 ELSE 1 END AS n FROM sent WINDOW f AS (PARTITION BY file_no ORDER BY seq))"""
#: rec: one row per packet; ``fragment`` 1 is the first and 2 the last one of a datagram, ``skip`` what a segment leaves out.
REC_PKT = f"""{PKT}, size AS (SELECT *, 2 + 12 + length('u' || who) + 10 + 4 + 11 + 11 + 6 - CASE WHEN bad THEN 3 ELSE 0 END AS bytes FROM pkt),
flow AS (SELECT *, coalesce(CAST(sum(bytes) OVER (PARTITION BY file, prot, client_ip, client_port, server, qr ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS sent_before FROM size),
rec AS (SELECT * EXCLUDE (n), first_n + k AS n, CASE WHEN prot = 17 AND pieces = 2 THEN CASE WHEN (k = 0) = (seq % 10 = 2) THEN 1 ELSE 2 END ELSE 0 END AS fragment,
 CASE WHEN prot = 6 AND pieces > 1 AND (k = 1) = (seq % 4 <> 2) THEN {V.FIRST_SEGMENT} ELSE 0 END AS skip FROM flow, (SELECT unnest([0, 1, 2]) AS k) WHERE k < pieces)"""
#: failed: how many records of a damaged file are read, and why no more.
FAILED = f"""{PKT}, whole AS (SELECT file, any_value(file_no) AS k, CAST(sum(pieces) AS BIGINT) AS n, min(CASE WHEN seq % {V.EVENTS_PER_FILE} = {V.DAMAGED_EVENT} THEN first_n END) AS bad_n FROM pkt GROUP BY file),
failed AS (SELECT file, CASE WHEN k % 4 = 1 THEN n - 1 WHEN k % 4 = 2 THEN 0 WHEN k % 4 = 3 THEN coalesce(bad_n, n) ELSE n END AS records,
 CASE WHEN k % 4 = 1 THEN 'record is cut off' WHEN k % 4 = 2 THEN 'not a capture' WHEN k % 4 = 3 AND bad_n IS NOT NULL THEN 'record length is damaged' END AS failure FROM whole)"""
SEG = f"seg AS ({V.duck(V.SEGMENTS)})"
LED = f"led AS ({V.duck(V.LEDGER)})"
REC = f"""rec AS (SELECT event_id AS seq, r.section, r.pos, r.type, r.prefix || (user_id % 9) AS data FROM events CROSS JOIN {V.values(V.RECORDS)} AS r(section, pos, type, prefix)
 WHERE event_type IN ('purchase', 'error') AND (event_id + r.type) % 3 <> 0)"""
STATE = """CASE WHEN max_tries_reached THEN 'exhausted' WHEN started IS NOT NULL AND ended IS NULL AND started + INTERVAL 1 DAY < TIMESTAMP '2024-01-20' THEN 'incomplete'
 WHEN started IS NOT NULL THEN CASE WHEN ended IS NOT NULL THEN 'done' ELSE 'claimed' END WHEN detected AND modified + INTERVAL 2 DAY < TIMESTAMP '2024-01-20' THEN 'not_picked_up' ELSE 'waiting' END"""
CIDR = "(s_suppkey % 223 + 1) || '.' || s_nationkey || '.0.0/' || (8 + s_suppkey % 25)"


def avg_of(v: str) -> str:
    return tx(f"SELECT {BIN} AS bin, server, server_location, round(avg({v}), 6) AS avg, count(*) AS sample, min({v}) AS min, max({v}) AS max FROM tx WHERE {v} IS NOT NULL GROUP BY ALL")


def points() -> str:
    count = lambda m, tag, cond: f"SELECT '{m}' AS metric, {BIN} AS bin, {tag} AS tag, server, server_location, 'count' AS type, CAST(count(*) AS DOUBLE) AS value FROM tx WHERE {cond} GROUP BY ALL"
    none = "CAST(NULL AS VARCHAR)"
    out = [
        count("dns_request", none, "req_seq IS NOT NULL"), count("dns_response", none, "rsp_seq IS NOT NULL"), count("dns_qtype", QTYPE, f"{QTYPE} IS NOT NULL"), count("dns_rcode", "CAST(raw_rcode AS VARCHAR)", "true"),
        count("dns_opcode", "CAST(dns_opcode AS VARCHAR)", "true"), count("geo_country", "ip_geo_country", "length(ip_geo_country) > 0"), count("network_protocol", PROTOCOL, "true"), count("ip_version", "CAST(ip_version AS VARCHAR)", "true"),
    ]
    for m, v in (("tcp_rtt", "tcp_rtt"), ("dns_proc_time", "dns_proc_time")):
        for kind, e in (("avg", f"round(avg({v}), 6)"), ("sample", f"count({v})"), ("min", f"min({v})"), ("max", f"max({v})")):
            out.append(f"SELECT '{m}', {BIN}, {none}, server, server_location, '{kind}', CAST({e} AS DOUBLE) FROM tx WHERE {v} IS NOT NULL GROUP BY {BIN}, server, server_location")
    return tx(" UNION ALL ".join(out))


ORACLES = {
    "packet_fields": f"""WITH {REC_PKT} SELECT file, n AS seq, prot, ip_version, ip_ttl, CASE WHEN qr = 0 THEN client_ip ELSE server END AS src, CASE WHEN fragment > 0 THEN NULL WHEN qr = 0 THEN client_port ELSE 53 END AS src_port,
 CASE WHEN qr = 0 THEN server ELSE client_ip END AS dst, CASE WHEN fragment > 0 THEN NULL WHEN qr = 0 THEN 53 ELSE client_port END AS dst_port, ip_version = 4 AND fragment = 0 AS do_not_fragment,
 CASE WHEN prot = 6 THEN ({V.FIRST_SEQUENCE} + sent_before + skip) % 4294967296 END AS tcp_seq, date_trunc('milliseconds', ts) AS ts FROM rec""",
    "dns_only": f"""WITH {REC_PKT}, p AS (SELECT file, n AS seq, CASE WHEN fragment > 0 THEN NULL WHEN qr = 0 THEN client_port ELSE 53 END AS src_port, CASE WHEN n % 7 = 0 THEN 80 WHEN fragment > 0 THEN NULL WHEN qr = 0 THEN 53 ELSE client_port END AS dst_port FROM rec)
SELECT * FROM p WHERE src_port = 53 OR dst_port = 53""",
    "malformed_messages": f"WITH {PKT} SELECT file, n AS seq, date_trunc('milliseconds', ts) AS ts FROM pkt WHERE bad",
    "dns_header": f"WITH {PKT} SELECT file, n AS seq, prot AS protocol, ip_ttl AS ttl, CASE WHEN qr = 0 THEN client_ip ELSE server END AS src, CASE WHEN qr = 0 THEN 53 ELSE client_port END AS dst_port, dns_id AS id, qr, aa, tc, rd, ra, ad, cd, rcode, CAST(1 AS INT) AS qdcount, CAST(1 AS INT) AS arcount, 'u' || who || '.zone.nl.' AS qname, qtype, CAST(1232 AS INT) AS udp, seq % 2 = 0 AS do, opt_ext_rcode AS ext_rcode, '10.10.' || (who % 250) || '.0/24' AS ecs, CAST(seq % 25 AS VARCHAR) AS errors FROM pkt WHERE NOT bad",
    "capture_failures": f"""WITH {FAILED} SELECT *, records AS packets FROM failed""",
    "capture_tries": f"""WITH {FAILED}, t AS (SELECT file AS object_key, CASE WHEN failure IS NULL THEN 1 ELSE CAST(regexp_extract(file, '[0-9]+') AS BIGINT) % 4 + 1 END AS tries, records, failure FROM failed),
s AS (SELECT *, CASE WHEN failure IS NULL THEN 'done' WHEN tries >= 3 THEN 'exhausted' ELSE 'failed' END AS state FROM t) SELECT *, CASE WHEN state = 'failed' THEN records END AS skip FROM s""",
    "capture_pairing": f"""WITH {PKT}, m AS (SELECT * EXCLUDE (qname), who AS qname FROM pkt WHERE NOT bad),
x AS (SELECT *, sum(CASE WHEN qr = 0 AND qtype IN (251, 252) THEN 1 ELSE 0 END) OVER (PARTITION BY file, dns_id, client_ip, client_port ORDER BY date_trunc('milliseconds', ts), n) AS epoch FROM m),
y AS (SELECT *, sum(qr) OVER (PARTITION BY file, dns_id, client_ip, client_port, epoch ORDER BY date_trunc('milliseconds', ts), n) AS nth FROM x),
k AS (SELECT * FROM y WHERE NOT (qr = 0 AND qtype IN (251, 252)) AND NOT (qr = 1 AND epoch > 0 AND nth > 1)),
w AS (SELECT *, lag(qr) OVER v AS pqr, lead(qr) OVER v AS nqr FROM k WINDOW v AS (PARTITION BY file, dns_id, client_ip, client_port, qname ORDER BY date_trunc('milliseconds', ts), n)),
a AS (SELECT file, count(*) AS messages, count(*) FILTER (qr = 0) AS requests, count(*) FILTER (qr = 1) AS responses FROM m GROUP BY 1),
l AS (SELECT file, max(date_trunc('milliseconds', ts)) AS last FROM m GROUP BY 1),
b AS (SELECT file, count(*) FILTER (qr = 1 AND pqr = 0) AS matched, count(*) FILTER (qr = 0 AND nqr IS NULL) AS unmatched, count(*) FILTER (qr = 1 AND pqr IS DISTINCT FROM 0) AS response_only,
 count(*) FILTER (qr = 0 AND nqr IS NULL AND date_trunc('milliseconds', ts) + INTERVAL 10 MINUTE <= last) AS expired FROM w JOIN l USING (file) GROUP BY 1),
p AS (SELECT file, CAST(sum(pieces) AS BIGINT) AS packets FROM pkt GROUP BY 1)
SELECT file AS capture_file, packets, messages, requests, responses, coalesce(matched, 0) AS matched, coalesce(unmatched, 0) AS unmatched, coalesce(response_only, 0) AS response_only, coalesce(expired, 0) AS expired FROM p LEFT JOIN a USING (file) LEFT JOIN b USING (file)""",
    "ip_reassembly": "SELECT l_orderkey AS ip_id, count(*) AS fragments, (max(l_linenumber) - 1) * 8 AS last_offset, string_agg(lpad(upper(to_hex(l_partkey % 65536)), 8, '0'), '' ORDER BY l_linenumber) AS payload FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem) GROUP BY 1 HAVING max(l_linenumber) = count(*) AND min(l_linenumber) = 1",
    "tcp_reassembly": f"""WITH {SEG}, a AS (SELECT *, max(tcp_seq + length) OVER (PARTITION BY capture_file, src, src_port, dst, dst_port ORDER BY tcp_seq, length DESC, ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM seg WHERE length > 0)
SELECT capture_file, src, src_port, count(*) AS segments, CAST(sum(CASE WHEN tcp_seq > seen THEN 1 ELSE 0 END) AS BIGINT) AS gaps, CAST(sum(length - greatest(0, coalesce(seen - tcp_seq, 0))) AS BIGINT) AS bytes FROM a WHERE seen IS NULL OR tcp_seq + length > seen GROUP BY ALL""",
    "tcp_rtt": f"""WITH {SEG}, c AS (SELECT capture_file, src, src_port, dst, count(*) FILTER (tcp_flags = 2) AS syns, min(CASE WHEN tcp_flags = 16 THEN epoch_us(ts) END) AS ack FROM seg GROUP BY ALL),
s AS (SELECT capture_file, src, src_port, dst, min(epoch_us(ts)) AS synack FROM seg WHERE seq % 3 = 0 GROUP BY ALL), r AS (SELECT c.*, CAST((ack - synack) // 1000 AS INT) AS rtt FROM c JOIN s USING (capture_file, src, src_port, dst) WHERE syns = 1 AND ack >= synack),
n AS (SELECT *, row_number() OVER (PARTITION BY capture_file, src, src_port, dst ORDER BY ts, seq) AS k FROM seg) SELECT n.seq, CASE WHEN k = 1 THEN rtt END AS tcp_rtt FROM n LEFT JOIN r USING (capture_file, src, src_port, dst)""",
    "notifications": "SELECT 'b' AS bucket, 'in/u' || user_id || ' x.pcap' AS key, CAST(1 AS BIGINT) AS n FROM events WHERE event_id % 4 <> 2 AND event_id % 3 > 0 GROUP BY user_id",
    "new_objects": f"WITH {LED} SELECT object_key, size_bytes FROM led WHERE regexp_matches(object_key, '\\.(pcap|gz|xz|bz2)$') AND object_key NOT IN (SELECT object_key FROM led WHERE detected)",
    "claimable_objects": f"WITH {LED} SELECT object_key, size_bytes FROM led WHERE object_key NOT IN (SELECT object_key FROM led WHERE started IS NOT NULL OR max_tries_reached OR tries >= 3)",
    "psl_rules": """WITH h AS (SELECT page_id % 5 AS k, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS rule FROM pages)
SELECT DISTINCT rule, CASE k WHEN 1 THEN 'wildcard' WHEN 2 THEN 'exception' ELSE 'exact' END AS kind, CAST(len(string_split(rule, '.')) AS INT) AS n_labels FROM h WHERE k <> 0 AND rule <> '' AND NOT ends_with(rule, '.org')""",
    "resolver_lists": f"""WITH c AS (SELECT {CIDR} AS cidr, s_suppkey, s_name FROM supplier), u AS (SELECT cidr, 'Google' AS name, 2 AS priority FROM c WHERE s_suppkey % 7 <> 0 AND len(string_split_regex(trim(regexp_replace(s_name, '#.*', '')), '\\s+')) = 1 AND trim(regexp_replace(s_name, '#.*', '')) <> '' UNION ALL SELECT cidr, 'CloudFlare', 1 FROM c),
n AS (SELECT name, priority, CAST(split_part(cidr, '/', 2) AS INT) AS plen, {IP.format("split_part(cidr, '/', 1)")} AS ip FROM u), m AS (SELECT *, ip - ip % CAST(pow(2, 32 - plen) AS BIGINT) AS net FROM n)
SELECT name, CAST(priority AS INT) AS priority, plen, count(*) AS n, min(net) AS lo, max(net + CAST(pow(2, 32 - plen) AS BIGINT) - 1) AS hi FROM m GROUP BY ALL""",
    "cidr_normalise": f"""WITH c AS (SELECT s_suppkey, (s_suppkey % 300) || '.' || s_nationkey || '.3.4/' || (s_suppkey % 36) AS cidr FROM supplier WHERE s_suppkey % 9 <> 0 AND s_suppkey % 10 <> 0 AND s_suppkey % 300 < 256 AND s_suppkey % 36 <= 32),
n AS (SELECT *, CAST(split_part(cidr, '/', 2) AS INT) AS plen, {IP.format("split_part(cidr, '/', 1)")} AS ip FROM c), m AS (SELECT *, ip - ip % CAST(pow(2, 32 - plen) AS BIGINT) AS net FROM n),
s AS (SELECT s_suppkey, s_suppkey % 49 AS plen, CAST(2306139568115548160 AS UBIGINT) + CAST('0x' || (s_suppkey % 9999) AS UBIGINT) * 65536 + 9 AS v FROM supplier WHERE s_suppkey % 9 = 0)
SELECT s_suppkey, cidr, CAST(4 AS INT) AS version, plen, '0' AS hi, net AS lo, net + CAST(pow(2, 32 - plen) AS BIGINT) - 1 AS last FROM m
UNION ALL SELECT s_suppkey, '2001:db8:' || (s_suppkey % 9999) || ':9::1/' || plen, 6, CAST(plen AS INT), CASE WHEN plen = 0 THEN '0' ELSE upper(to_hex((v >> (64 - plen)) << (64 - plen))) END, 0, NULL FROM s""",
    "cidr_v6": "SELECT CASE WHEN user_id % 8 = 3 THEN 'three' WHEN user_id % 8 = 5 AND event_id % 65536 >= 32768 THEN 'high' ELSE 'wide' END AS picked, count(DISTINCT (user_id % 8, event_id % 65536)) AS n FROM events GROUP BY 1",
    "html_table_cells": "SELECT page_id, i - 1 AS row_no, regexp_extract(r, '(?is)<a [^>]*>(.*?)</a>', 1) AS cell FROM (SELECT page_id, unnest(l) AS r, generate_subscripts(l, 1) AS i FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?is)<ul.*?</ul>'), '(?is)<li[^>]*>.*?</li>') AS l FROM pages)) WHERE contains(r, '<a ')",
    "html_ranges": "SELECT cidr, count(*) AS n FROM (SELECT (s_suppkey % 223 + 1) || '.' || s_nationkey || '.0.0/16' AS cidr FROM supplier UNION ALL SELECT '2001:db8:' || (s_suppkey % 9999) || '::/48' FROM supplier) GROUP BY 1",
    "geo_networks": """SELECT n_name, (n_nationkey + 1) || '.0.0.0/' || (n_nationkey % 9 + 8) AS cidr, CAST(4 AS INT) AS version, CAST(n_nationkey % 9 + 8 AS INT) AS plen, '0' AS hi, CAST(n_nationkey + 1 AS BIGINT) * 16777216 AS lo FROM nation
UNION ALL SELECT n_name, '2001:db8:' || (n_nationkey + 1) || '::/48', 6, 48, '20010DB8' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 4, '0') || '0000', 0 FROM nation""",
    "server_site": f"""WITH {LED}, t AS (SELECT *, CASE WHEN size_bytes % 2 = 0 THEN 'site' WHEN size_bytes % 3 = 0 THEN 'odd' END AS ts FROM led)
SELECT object_key, CASE WHEN tries = 1 AND ts IS NOT NULL THEN 'tagged' WHEN tries = 3 THEN 'unknown' ELSE regexp_extract(object_key, 'x_(ns[0-9]+\\.zone\\.nl)_', 1) END AS server, CASE WHEN tries = 1 AND ts IS NOT NULL THEN ts WHEN tries = 3 THEN 'unknown' ELSE 'ams' END AS site FROM t""",
    "transport_fields": tx("SELECT req_seq, rsp_seq, time, ip_ttl, ip_version, prot, ip_src, prot_src_port, ip_dst, prot_dst_port, tcp_rtt FROM tx"),
    "header_merge": tx("SELECT req_seq, rsp_seq, dns_rd, dns_aa, dns_tc, dns_req_len, dns_res_len FROM tx"),
    "question_pick": tx("SELECT req_seq, rsp_seq, dns_qtype, dns_qclass FROM tx"),
    "rcode_sentinel": tx("SELECT req_seq, rsp_seq, dns_id, dns_opcode, raw_rcode AS dns_rcode FROM tx"),
    "extended_rcode": tx("SELECT req_seq, rsp_seq, dns_rcode FROM tx"),
    "proc_time": tx("SELECT req_seq, rsp_seq, dns_proc_time FROM tx"),
    "edns_fields": "SELECT event_id AS seq, CAST(1232 AS INT) AS edns_udp, CAST(0 AS INT) AS edns_version, event_id % 3 = 0 AS edns_do FROM events",
    "edns_option_lists": f"SELECT event_id AS seq, nullif(concat_ws(',', {OPTS}), '') AS codes FROM events",
    "edns_ext_errors": "SELECT event_id AS seq, CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 25 AS VARCHAR) END AS errors FROM events",
    "edns_client_subnet": "SELECT event_id AS seq, CASE WHEN event_id % 7 = 0 THEN '10.3.0.' || (user_id % 250) || '/27' WHEN user_id % 6 = 0 THEN '10.0.0.' || (user_id % 250) || '/24' END AS edns_ecs FROM events",
    "rdata_flatten": f"WITH {REC} SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY section, pos) - 1 AS i, section, type, data FROM rec",
    "rdata_no_dnssec": f"WITH {REC} SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY section, pos) - 1 AS i, section, type, data FROM rec WHERE type NOT IN (43, 46, 48)",
    "cname_chain": f"WITH {REC} SELECT seq, string_agg(CASE WHEN section = 0 AND type = 5 THEN data END, ',' ORDER BY pos) AS cnames FROM rec GROUP BY seq",
    "rdata_any_match": f"WITH {REC} SELECT DISTINCT seq FROM rec WHERE data = '192.0.2.3' ORDER BY seq LIMIT 100",
    "rdata_top_a": f"WITH {REC} SELECT data, count(*) AS n FROM rec WHERE type = 1 GROUP BY data ORDER BY n DESC, data LIMIT 25",
    "privacy_mask": tx("SELECT ip_dst, prot_src_port, count(*) AS n, CAST(0 AS BIGINT) AS sources FROM tx GROUP BY ALL"),
    "day_partitions": tx("SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS n FROM tx GROUP BY ALL"),
    "dns_rows": tx("SELECT " + ", ".join(n for n, _ in COLUMNS) + " FROM tx"),
    "stored_day": tx("SELECT dns_domainname, count(*) AS n, max(dns_id) AS most_id FROM tx WHERE CAST(time AS DATE) = DATE '2024-01-10' GROUP BY 1"),
    "schema_align": tx("SELECT CASE WHEN dns_id >= 8 THEN dns_tld END AS dns_tld, count(*) AS n, count(CASE WHEN dns_id >= 8 THEN dns_qname_full END) AS full_names FROM tx GROUP BY 1"),
    "pairing": f"WITH {PAIRS} SELECT m.capture_file, req_seq, rsp_seq FROM pairs JOIN dns_messages m ON m.seq = coalesce(req_seq, rsp_seq)",
    "unmatched_requests": f"WITH {PAIRS} SELECT m.seq, m.qname FROM pairs JOIN dns_messages m ON m.seq = req_seq WHERE rsp_seq IS NULL",
    "pairing_keep_retransmits": f"WITH {WIN} SELECT CASE WHEN qr = 0 THEN seq WHEN pqr = 0 THEN pseq END AS req_seq, CASE WHEN qr = 1 THEN seq END AS rsp_seq FROM win WHERE qr = 1 OR nqr IS NULL OR nqr = 0",
    "pairing_fold_case": f"WITH {WIN.replace('qname ORDER', 'lower(qname) ORDER')} SELECT CASE WHEN qr = 0 THEN seq WHEN pqr = 0 THEN pseq END AS req_seq, CASE WHEN qr = 1 THEN seq END AS rsp_seq FROM win WHERE qr = 1 OR nqr IS NULL",
    "zone_transfer": f"WITH {XFR} SELECT seq, qr, qtype FROM kept",
    "capture_stats": f"""WITH {PAIRS}, a AS (SELECT capture_file, count(*) AS messages, count(*) FILTER (qr = 0) AS requests, count(*) FILTER (qr = 1) AS responses FROM dns_messages GROUP BY 1),
b AS (SELECT m.capture_file, count(*) FILTER (req_seq IS NOT NULL AND rsp_seq IS NOT NULL) AS matched, count(*) FILTER (rsp_seq IS NULL) AS unmatched, count(*) FILTER (req_seq IS NULL) AS response_only FROM pairs JOIN dns_messages m ON m.seq = coalesce(req_seq, rsp_seq) GROUP BY 1)
SELECT a.*, coalesce(matched, 0) AS matched, coalesce(unmatched, 0) AS unmatched, coalesce(response_only, 0) AS response_only FROM a LEFT JOIN b USING (capture_file)""",
    "tld_filter": tx("SELECT dns_tld, count(*) AS n FROM tx WHERE dns_tld IS NULL OR dns_tld NOT IN ('nl', 'co.nz') GROUP BY 1"),
    "clean_name": f"WITH {M} SELECT qname, {clean('qname')} AS clean FROM ({NAMES})",
    "domain_parts": f"WITH {M}, {parts(NAMES)} SELECT qname, domain, subdomain, tld, labels, qname_full FROM named_",
    "domain_parts_standard": f"WITH {M}, {parts(NAMES, standard=True)} SELECT qname, tld, domain, labels FROM named_",
    "tld_exists": f"WITH {M}, {parts(NAMES)} SELECT qname, tld, coalesce(tld = 'bind' OR tld IN {IN} OR tld IN ('ck', 'www.ck', 'kawasaki.jp', 'city.kawasaki.jp') OR regexp_replace(tld, '^[^.]*\\.', '') IN ('kawasaki.jp') AND contains(tld, '.') OR (contains(tld, '.') AND substr(tld, instr(tld, '.') + 1) = 'ck'), false) AS tld_exists FROM named_",
    "resolver_match": f"WITH {M}, {DIM} SELECT address, resolver AS dns_pub_resolver FROM dim WHERE address IN (SELECT client_ip FROM dns_messages)",
    "geo_country": f"WITH {M}, {DIM} SELECT address, iso AS country FROM dim WHERE address IN (SELECT client_ip FROM dns_messages)",
    "asn_lookup": f"WITH {M}, {DIM} SELECT address, asn, org AS asn_org FROM dim WHERE address IN (SELECT client_ip FROM dns_messages)",
    "ecs_enrich": tx("SELECT edns_ecs_ip_geo_country, edns_ecs_ip_asn, edns_ecs_ip_asn_org, count(*) AS n FROM tx GROUP BY ALL"),
    "metrics_counters": tx(f"SELECT {BIN} AS bin, server, server_location, count(req_seq) AS requests, count(rsp_seq) AS responses FROM tx GROUP BY ALL"),
    "metrics_qtype": counted("qtype", QTYPE),
    "metrics_rcode": counted("rcode", "raw_rcode"),
    "metrics_opcode": counted("opcode", "dns_opcode"),
    "metrics_country": counted("country", "ip_geo_country"),
    "metrics_protocol": counted("protocol", PROTOCOL),
    "metrics_ip_version": counted("version", "ip_version"),
    "metrics_rtt": avg_of("tcp_rtt"),
    "metrics_proc_time": avg_of("dns_proc_time"),
    "metric_points": points(),
    "object_state": f"WITH {LED} SELECT object_key, {STATE} AS state FROM led",
    "ingest_stats": f"WITH {LED} SELECT regexp_extract(object_key, 'x_(ns[0-9]+\\.zone\\.nl)_', 1) AS server, 'ams' AS site, {STATE} AS state, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS bytes, round(avg(tries), 6) AS avg_tries, round(avg(epoch_us(ended) - epoch_us(started)) / 1000000, 6) AS avg_seconds, CAST(max(epoch_us(ended) - epoch_us(started)) AS DOUBLE) / 1000000 AS most_seconds FROM led GROUP BY ALL",
    "reference_staleness": f"WITH {LED} SELECT object_key, coalesce(started + INTERVAL 240 HOUR < TIMESTAMP '2024-01-20', true) AS stale FROM led",
    "row_count": tx("SELECT count(*) AS n FROM tx"),
    "top_domains": tx("SELECT dns_domainname, count(*) AS n FROM tx WHERE dns_domainname IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 25"),
    "top_domains_on_date": tx("SELECT dns_domainname, count(*) AS n FROM tx WHERE dns_domainname IS NOT NULL AND CAST(time AS DATE) = DATE '2024-01-10' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"),
    "rcodes_per_day": tx("SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, dns_rcode, count(*) AS n FROM tx GROUP BY ALL"),
    "stream_pairing": f"""WITH {M}, x AS (SELECT *, epoch_ms(ts) AS ms, qr = 0 AND qtype IN (251, 252) AS asks FROM dns_messages),
y AS (SELECT *, max(CASE WHEN asks THEN ms END) OVER c AS mark, sum(CASE WHEN asks THEN 1 ELSE 0 END) OVER c AS epoch FROM x WINDOW c AS (PARTITION BY capture_file, dns_id, client_ip, client_port ORDER BY ts, seq)),
z AS (SELECT *, sum(qr) OVER (PARTITION BY capture_file, dns_id, client_ip, client_port, epoch ORDER BY ts, seq) AS nth FROM y),
k AS (SELECT * FROM z WHERE NOT asks AND NOT (qr = 1 AND epoch > 0 AND mark + {WAIT_MS} > ms AND nth > 1)),
w AS (SELECT *, lag(qr) OVER v AS pqr, lag(seq) OVER v AS pseq, lag(ms) OVER v AS pms, lead(ms) OVER v AS nms FROM k WINDOW v AS (PARTITION BY capture_file, dns_id, client_ip, client_port, qname ORDER BY ts, seq))
SELECT capture_file, qname, CASE WHEN qr = 0 THEN seq WHEN pqr = 0 AND pms + {WAIT_MS} > ms THEN pseq END AS req_seq, CASE WHEN qr = 1 THEN seq END AS rsp_seq FROM w WHERE qr = 1 OR nms IS NULL OR nms >= ms + {WAIT_MS}""",
}
ORACLES["compacted_days"] = ORACLES["day_partitions"].replace("count(*) AS n", "count(*) AS n, CAST(1 AS BIGINT) AS files")
#: The streams give what the batch queries give.
ORACLES |= {"stream_metrics": ORACLES["metric_points"], "rolled_rows": ORACLES["day_partitions"]}
ORACLES["reference_as_of"] = f"WITH {M}, {DIM} SELECT CASE WHEN ts >= TIMESTAMP '2024-01-12' THEN 'N' || iso ELSE iso END AS iso, count(*) AS n FROM dns_messages LEFT JOIN dim ON client_ip = address GROUP BY 1"
ORACLES["rdata_search"] = f"""SELECT time, dns_id, ip_src, prot_src_port, dns_qname FROM ({ORACLES["dns_rows"]}) AS r
WHERE dns_domainname = 'zone.nl' AND len(list_filter(string_split(dns_rdata, ';'), lambda x: split_part(x, ':', 3) = '192.0.2.3')) > 0 ORDER BY ALL LIMIT 100"""
ORACLES["capture_files"] = f"""WITH {PKT} SELECT file || ['', '.gz', '.bz2', '.xz'][CAST(any_value(file_no) % 4 AS INT) + 1] AS file, CAST(sum(pieces) AS BIGINT) AS packets, CAST(sum(pieces) AS BIGINT) AS records, CAST(NULL AS VARCHAR) AS failure, CAST(sum(pieces) AS BIGINT) AS numbers FROM pkt GROUP BY file"""
ORACLES["stored_order"] = ORACLES["day_partitions"].replace("count(*) AS n", "count(*) AS n, CAST(0 AS BIGINT) AS out_of_order")
ORACLES["stored_points"] = f"SELECT tag, count(*) AS points, sum(value) AS total FROM ({ORACLES['metric_points']}) AS p WHERE metric = 'dns_rcode' GROUP BY tag"
