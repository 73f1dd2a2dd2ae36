"""Registered queries: every operator over views of the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .. import compaction, sinks
from ..operators import address, assembly, attempts, metrics, names, objects, pairing, ranges, rows, tcp
from ..shared import cut, new_path
from ..sources import capture, reference, references
from ..streaming import jobs
from . import views as V

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def messages(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, V.MESSAGES)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairing.transactions(messages(spark, d))


def rules(spark: SparkSession) -> DataFrame:
    return names.suffix_rules(spark.createDataFrame([(r,) for r in V.RULES], "value string"))


def resolvers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(V.RESOLVERS, "cidr string, name string, priority int")


def places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(V.PLACES, "cidr string, iso string, asn string, org string")


def enrichments(spark: SparkSession) -> list[address.Enrichment]:
    p = places(spark)
    return [address.resolver(resolvers(spark)), *(address.longest_prefix(c, p, v) for c, v in (("ip_geo_country", "iso"), ("ip_asn", "asn"), ("ip_asn_org", "org")))]


def dns(spark: SparkSession, d: str, enrich: list[address.Enrichment] = (), full: bool = False, **options) -> DataFrame:
    m = with_lists(messages(spark, d)) if full else messages(spark, d)
    return rows.build_dns(pairing.transactions(m), rules(spark), enrich, rows.Options(**options), rows.addresses_of(m) if enrich else None)


def country(spark: SparkSession) -> address.Enrichment:
    return address.longest_prefix("ip_geo_country", places(spark), "iso")


def sided(df: DataFrame) -> DataFrame:
    return df.withColumn("has_request", F.col("dns_req_len").isNotNull()).withColumn("has_response", F.col("dns_res_len").isNotNull())


def ids(df: DataFrame) -> list:
    return [F.col("req.seq").alias("req_seq"), F.col("rsp.seq").alias("rsp_seq")]


# Sources


def packets(spark, d) -> DataFrame:
    """Packets out of the bytes of capture files that are made of the messages."""
    return capture.packets(V.captures(messages(spark, d)))


@query
def packet_fields(spark, d):
    return packets(spark, d).select("file", "seq", F.col("protocol").alias("prot"), "ip_version", F.col("ttl").alias("ip_ttl"), "src", "src_port", "dst", "dst_port", "do_not_fragment", F.col("tcp_seq").alias("tcp_seq"), "ts")


@query
def dns_only(spark, d):
    x = packets(spark, d).withColumnRenamed("protocol", "prot").withColumn("dst_port", F.when(F.col("seq") % 7 == 0, 80).otherwise(F.col("dst_port")))
    return pairing.dns_only(x).select("file", "seq", "src_port", "dst_port")


def payloads(spark, d) -> DataFrame:
    """DNS messages of the captures over both protocols, from datagrams, fragments and segments."""
    return assembly.dns_payloads(cut(packets(spark, d)))


@query
def malformed_messages(spark, d):
    return capture.malformed(payloads(spark, d)).select("file", "seq", "ts")


@query
def dns_header(spark, d):
    """Header, question and option record out of the bytes of messages over both protocols."""
    x = capture.messages(payloads(spark, d))
    q, o = F.element_at("questions", 1), F.col("opt.options")
    head = [F.col(f"header.{n}").alias(n) for n in ("id", "qr", "aa", "tc", "rd", "ra", "ad", "cd", "rcode", "qdcount", "arcount")]
    return x.select("file", "seq", "protocol", "ttl", "src", "dst_port", *head, q["qname"].alias("qname"), q["qtype"].alias("qtype"), F.col("opt.udp").alias("udp"), F.col("opt.do").alias("do"), F.col("opt.ext_rcode").alias("ext_rcode"), C.client_subnet(o).alias("ecs"), F.array_join(C.extended_errors(o).cast("array<string>"), ",").alias("errors"))


@query
def capture_pairing(spark, d):
    """Transactions of decoded captures over both protocols, from bytes to pairs, by file. Messages are decoded once and kept."""
    x = cut(packets(spark, d))
    m = cut(capture.flat_messages(capture.messages(assembly.dns_payloads(x))))
    return pairing.capture_stats(m, pairing.transactions(m), x.select("file"), 600_000)


@query
def capture_failures(spark, d):
    """What became of captures of which three in four are damaged: the packets before the damage are kept."""
    x = capture.scan(V.captures(messages(spark, d), damaged=True))
    return x.groupBy("file").agg(F.max("records").alias("records"), F.max("failure").alias("failure"), F.count("seq").alias("packets"))


@query
def capture_files(spark, d):
    """Packets of capture files on disk: plain ones by ranges of bytes, gz, bz2 and xz as streams."""
    folder = new_path(spark, "captures")
    V.capture_files(V.captures(messages(spark, d)), folder)
    x = capture.scan_files(spark, capture.read_captures(spark, folder).select("path", "length"), block_bytes=10_000)
    name = F.element_at(F.split("file", "/"), -1).alias("file")
    return x.groupBy(name).agg(F.count("seq").alias("packets"), F.max("records").alias("records"), F.max("failure").alias("failure"), F.count_distinct("seq").alias("numbers"))


@query
def capture_tries(spark, d):
    """States of damaged captures after one to four attempts each, and what is due again."""
    ends = capture.endings(capture.scan(V.captures(messages(spark, d), damaged=True)))
    n = F.regexp_extract("file", "[0-9]+", 0).cast("long")
    tried = F.when(F.col("failure").isNull(), F.lit(1).cast("long")).otherwise(n % 4 + 1)
    x = ends.select(F.col("file").alias("object_key"), F.lit(1).cast("long").alias("length"), "records", "failure", F.lit(0.5).alias("seconds"), F.lit(None).cast("timestamp").alias("at"), F.explode(F.sequence(F.lit(1).cast("long"), tried)).alias("batch"))
    again = attempts.due(ends.limit(0).select(F.col("file").alias("path"), F.lit(1).cast("long").alias("length")), x, 3)
    return attempts.states(x, 3).join(again.select(F.col("path").alias("object_key"), "skip"), "object_key", "left").select("object_key", "tries", "records", "failure", "state", "skip")


@query
def ip_reassembly(spark, d):
    """Datagrams of lineitem fragments: an order's lines are fragments of 8 bytes; orders with a missing line go. Of lines that
    repeat, the first in the order of the table's files and rows counts."""
    seq = F.struct("_metadata.file_path", "_metadata.row_index").alias("seq")
    x = table(spark, d, "lineitem").select(seq, F.lit("f").alias("capture_file"), F.lit("a").alias("src"), F.lit("b").alias("dst"), F.col("l_orderkey").alias("ip_id"), F.lit(17).alias("protocol"), ((F.col("l_linenumber") - 1) * 8).alias("frag_offset"), F.lpad(F.hex(F.col("l_partkey") % 65536), 8, "0").cast("binary").alias("payload"), F.lit(False).alias("more_fragments"), F.col("l_shipdate").alias("ts"))
    out = tcp.reassemble_fragments(x)
    return out.select(F.col("ip_id"), F.col("fragments").cast("long").alias("fragments"), F.col("last_offset").cast("long").alias("last_offset"), F.col("payload").cast("string").alias("payload"))


@query
def tcp_reassembly(spark, d):
    return tcp.contiguous(V.view(spark, d, V.SEGMENTS)).groupBy("capture_file", "src", "src_port").agg(F.count("*").alias("segments"), F.count_if("gap").alias("gaps"), F.sum(F.col("length") - F.col("overlap")).alias("bytes"))


@query
def tcp_rtt(spark, d):
    s = V.view(spark, d, V.SEGMENTS)
    answer = s.filter("seq % 3 = 0").select("capture_file", F.col("dst").alias("src"), F.col("dst_port").alias("src_port"), F.col("src").alias("dst"), F.col("src_port").alias("dst_port"), "ts", F.lit(18).alias("tcp_flags"))
    rtt = tcp.handshake_rtt(s.select(*answer.columns).unionByName(answer))
    return tcp.first_with_rtt(s, rtt).select("seq", "tcp_rtt")


@query
def notifications(spark, d):
    e = table(spark, d, "events")
    name = F.element_at(F.array(*[F.lit(x) for x in ("ObjectCreated:Put", "ObjectCreated:CompleteMultipartUpload", "ObjectRemoved:Delete", "s3:ObjectTagging:PUTTAGGING")]), (F.col("event_id") % 4 + 1).cast("int"))
    body = F.to_json(F.struct(F.array(F.struct(name.alias("eventName"), F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(F.format_string("in%%2Fu%d%%20x.pcap", F.col("user_id")).alias("key"), (F.col("event_id") % 3).alias("size")).alias("object")).alias("s3"))).alias("Records")))
    return objects.notifications(e.select(body.alias("body"))).groupBy("bucket", "key").agg(F.count("*").alias("n"))


@query
def new_objects(spark, d):
    led = V.view(spark, d, V.LEDGER)
    return objects.new_objects(led.select("object_key", "size_bytes"), led.filter("detected"))


@query
def claimable_objects(spark, d):
    led = V.view(spark, d, V.LEDGER)
    return objects.claimable(led.select("object_key", "size_bytes"), led, 3)


@query
def psl_rules(spark, d):
    """Rules from lines made of the pages' hosts."""
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1))
    mark = F.when(F.col("page_id") % 5 == 0, "// ").when(F.col("page_id") % 5 == 1, "*.").when(F.col("page_id") % 5 == 2, " !").otherwise("")
    return names.suffix_rules(table(spark, d, "pages").select(F.concat(mark, host).alias("value")), hot=("org",))


@query
def resolver_lists(spark, d):
    s = table(spark, d, "supplier")
    cidr = F.format_string("%d.%d.0.0/%d", F.col("s_suppkey") % 223 + 1, F.col("s_nationkey"), 8 + F.col("s_suppkey") % 25)
    site = reference.site_ranges(s.select(F.concat(cidr, F.when(F.col("s_suppkey") % 7 == 0, " a b").otherwise(F.concat(F.lit(" "), F.col("s_name")))).alias("value")).withColumn("value", F.regexp_replace("value", "#.*", "")))
    plain = reference.plain_ranges(s.filter("s_suppkey % 2 = 0").select(cidr.alias("value")), s.filter("s_suppkey % 2 = 1").select(F.concat(F.lit(" "), cidr).alias("value")))
    out = reference.resolver_networks([("Google", 2, site), ("CloudFlare", 1, plain)])
    return out.groupBy("name", "priority", "plen").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("last_lo").alias("hi"))


@query
def cidr_normalise(spark, d):
    s = table(spark, d, "supplier")
    text = F.when(F.col("s_suppkey") % 9 == 0, F.format_string("2001:db8:%d:9::1/%d", F.col("s_suppkey") % 9999, F.col("s_suppkey") % 49)).when(F.col("s_suppkey") % 10 == 0, "10.0.0.0").otherwise(F.format_string("%d.%d.3.4/%d", F.col("s_suppkey") % 300, F.col("s_nationkey"), F.col("s_suppkey") % 36))
    x = address.normalise(s.select("s_suppkey", text.alias("cidr")))
    return x.select("s_suppkey", "cidr", "version", "plen", F.hex("hi").alias("hi"), "lo", F.when(F.col("version") == 4, F.col("last_lo")).alias("last"))


@query
def cidr_v6(spark, d):
    """Version-6 addresses of users in nested networks; the longest prefix wins."""
    a = table(spark, d, "events").select(F.format_string("2001:db8:%x::%x", F.col("user_id") % 8, F.col("event_id") % 65536).alias("address"))
    nets = spark.createDataFrame([("2001:db8::/32", "wide"), ("2001:db8:3::/48", "three"), ("2001:db8:5::8000/113", "high")], "cidr string, name string")
    return address.address_dimension(a, [address.longest_prefix("picked", address.normalise(nets), "name")]).groupBy("picked").agg(F.count("*").alias("n"))


@query
def html_table_cells(spark, d):
    """Cells of the pages' first list, whose items are rows and whose links are cells."""
    x = reference.table_cells(table(spark, d, "pages").select("page_id", "html"), table=r"(?is)<ul.*?</ul>", row="li", cell="a")
    return x.select("page_id", F.col("row_no").cast("long").alias("row_no"), "cell")


@query
def html_ranges(spark, d):
    """Ranges of both versions out of an HTML table with id networks, made of the suppliers of a nation."""
    s = table(spark, d, "supplier")
    row = F.format_string("<tr><td>%d</td><td>x</td><td>y</td><td><b>%d.%d.0.0/16</b></td><td> 2001:db8:%d::/48 </td></tr>", "s_suppkey", F.col("s_suppkey") % 223 + 1, F.col("s_nationkey"), F.col("s_suppkey") % 9999)
    page = F.concat(F.lit("<html><table><tr><td>no</td></tr></table><table class=a id='networks'><tr><th>a</th><th>b</th><th>c</th><th>v4</th><th>v6</th></tr>"), F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table></html>"))
    return reference.html_ranges(s.groupBy("s_nationkey").agg(page.alias("html"))).groupBy("cidr").agg(F.count("*").alias("n"))


@query
def geo_networks(spark, d):
    n = table(spark, d, "nation")
    four, six = F.format_string("%d.0.0.0/%d", F.col("n_nationkey") + 1, F.col("n_nationkey") % 9 + 8), F.format_string("2001:db8:%d::/48", F.col("n_nationkey") + 1)
    x = reference.geo_networks(n.select("n_name", F.explode(F.array(four, six)).alias("network")))
    return x.select("n_name", "cidr", "version", "plen", F.hex("hi").alias("hi"), "lo")


@query
def server_site(spark, d):
    led = V.view(spark, d, V.LEDGER)
    key = F.when(F.col("tries") == 3, F.lit("plain-1.pcap")).otherwise(F.col("object_key"))
    site = F.when(F.col("size_bytes") % 2 == 0, F.lit("site")).when(F.col("size_bytes") % 3 == 0, F.lit("odd"))
    body = F.to_json(F.create_map(F.lit("server"), F.when(F.col("tries") == 1, F.lit("tagged")), F.lit("site"), site))
    x = led.select("object_key", key.alias("key"), objects.tags(body).alias("tags"))
    return x.select("object_key", C.server_site("key", F.col("tags")["server"], F.col("tags")["site"]).alias("p")).select("object_key", "p.server", "p.site")


# Projections


@query
def transport_fields(spark, d):
    p = pairs(spark, d)
    return p.select(*ids(p), *[c.alias(n) for n, c in rows.transport(p).items() if n != "dns_proc_time"])


@query
def header_merge(spark, d):
    p = pairs(spark, d)
    f = rows.flags(p)
    return p.select(*ids(p), *[f[n].alias(n) for n in ("dns_rd", "dns_aa", "dns_tc", "dns_req_len", "dns_res_len")])


@query
def question_pick(spark, d):
    p = pairs(spark, d)
    f = rows.flags(p)
    return p.select(*ids(p), f["dns_qtype"].alias("dns_qtype"), f["dns_qclass"].alias("dns_qclass"))


@query
def rcode_sentinel(spark, d):
    p = pairs(spark, d)
    f = rows.flags(p, rows.Options(extended_rcode=False))
    return p.select(*ids(p), f["dns_id"].alias("dns_id"), f["dns_opcode"].alias("dns_opcode"), f["dns_rcode"].alias("dns_rcode"))


@query
def extended_rcode(spark, d):
    p = pairs(spark, d)
    return p.select(*ids(p), rows.flags(p)["dns_rcode"].alias("dns_rcode"))


@query
def proc_time(spark, d):
    p = pairs(spark, d)
    return p.select(*ids(p), rows.transport(p)["dns_proc_time"].alias("dns_proc_time"))


def with_options(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("seq"), V.options(F.col("event_id"), F.col("user_id")).alias("options"), F.struct(F.lit(1232).alias("udp"), F.lit(0).alias("version"), (F.col("event_id") % 3 == 0).alias("do")).alias("opt"))


SECTIONS = ("answer", "authority", "additional")


def with_lists(m: DataFrame) -> DataFrame:
    """Messages with their options and, on responses, their records."""
    lists = [F.when(F.col("qr") == 1, V.records(i, F.col("seq"), F.col("who"))).alias(n) for i, n in enumerate(SECTIONS)]
    return m.select("*", V.options(F.col("seq"), F.col("who")).alias("options"), *lists)


@query
def edns_fields(spark, d):
    return with_options(spark, d).select("seq", F.col("opt.udp").alias("edns_udp"), F.col("opt.version").alias("edns_version"), F.col("opt.do").alias("edns_do"))


@query
def edns_option_lists(spark, d):
    return with_options(spark, d).select("seq", F.array_join(C.option_codes("options").cast("array<string>"), ",").alias("codes"))


@query
def edns_ext_errors(spark, d):
    return with_options(spark, d).select("seq", F.array_join(C.extended_errors("options").cast("array<string>"), ",").alias("errors"))


@query
def edns_client_subnet(spark, d):
    return with_options(spark, d).select("seq", C.client_subnet("options").alias("edns_ecs"))


def with_records(spark, d) -> DataFrame:
    """Responses that have records, with their answer, authority and additional sections as arrays."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("purchase", "error"))
    x = e.select(F.col("event_id").alias("seq"), *[V.records(i, F.col("event_id"), F.col("user_id")).alias(n) for i, n in enumerate(SECTIONS)])
    return x.filter(F.size("answer") + F.size("authority") + F.size("additional") > 0)


def _inline(df: DataFrame, column) -> DataFrame:
    return df.select("seq", F.posexplode(column).alias("i", "r")).select("seq", F.col("i").cast("long").alias("i"), "r.section", "r.type", "r.data")


@query
def rdata_flatten(spark, d):
    return _inline(with_records(spark, d), C.rdata(F.col("answer"), F.col("authority"), F.col("additional"), dnssec=True))


@query
def rdata_no_dnssec(spark, d):
    return _inline(with_records(spark, d), C.rdata(F.col("answer"), F.col("authority"), F.col("additional")))


@query
def cname_chain(spark, d):
    return with_records(spark, d).select("seq", F.array_join(C.cname_chain("answer"), ",").alias("cnames"))


@query
def rdata_any_match(spark, d):
    x = with_records(spark, d).withColumn("r", C.rdata(F.col("answer"), F.col("authority"), F.col("additional")))
    return x.filter(C.has_data("r", "192.0.2.3")).select("seq").orderBy("seq").limit(100)


@query
def rdata_top_a(spark, d):
    x = with_records(spark, d).select(F.explode(C.rdata(F.col("answer"), F.col("authority"), F.col("additional"))).alias("r"))
    return x.filter("r.type = 1").groupBy(F.col("r.data").alias("data")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "data").limit(25)


@query
def privacy_mask(spark, d):
    return dns(spark, d, privacy=True).groupBy("ip_dst", "prot_src_port").agg(F.count("*").alias("n"), F.count("ip_src").alias("sources"))


@query
def day_partitions(spark, d):
    return dns(spark, d).groupBy(F.to_date("time").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query
def dns_rows(spark, d):
    """All 50 columns of paired, enriched transactions; lists as text."""
    x = dns(spark, d, enrichments(spark), full=True, rdata=True)
    text = {n: F.array_join(F.col(n).cast("array<string>"), ",") for n in ("edns_options", "edns_server_options", "edns_ext_error", "dns_cname")}
    text["dns_rdata"] = F.array_join(F.transform("dns_rdata", lambda r: F.concat_ws(":", r["section"].cast("string"), r["type"].cast("string"), r["data"])), ";")
    return x.select(*[text.get(n, F.col(n)).alias(n) for n in x.columns])


@query
def stored_day(spark, d):
    """Rows of one day of the written table, read with its partition pruned: counts and order checks by domain."""
    path = new_path(spark, "dns")
    sinks.write_dns(dns(spark, d), path)
    day = sinks.read_dns(spark, path).filter("day = '2024-01-10'")
    return day.groupBy("dns_domainname").agg(F.count("*").alias("n"), F.max("dns_id").alias("most_id"))


@query
def stored_order(spark, d):
    """Rows of the written table that don't follow the row before them in their file by domain, nulls last, by day."""
    path = new_path(spark, "dns")
    sinks.write_dns(dns(spark, d), path)
    x = sinks.read_dns(spark, path).select("day", "dns_domainname", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    before = F.lag(F.struct(F.col("dns_domainname").isNull().alias("a"), F.col("dns_domainname").alias("b"))).over(Window.partitionBy("file").orderBy("i"))
    wrong = F.struct(F.col("dns_domainname").isNull().alias("a"), F.col("dns_domainname").alias("b")) < before
    return x.withColumn("wrong", F.coalesce(wrong, F.lit(False))).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.count_if("wrong").alias("out_of_order"))


@query
def stored_points(spark, d):
    """Points of one metric of the written points, of which only its folder is read."""
    path = new_path(spark, "points")
    sinks.write_points(metrics.metric_points(metric_rows(spark, d, places=True)), path)
    x = spark.read.parquet(path).filter("metric = 'dns_rcode'")
    return x.groupBy("tag").agg(F.count("*").alias("points"), F.sum("value").alias("total"))


@query
def compacted_days(spark, d):
    """Rows of a table of many appends after its small files were packed; files that were joined are gone."""
    path = new_path(spark, "dns")
    x = dns(spark, d)
    for i in range(3):
        sinks.write_dns(x.filter(F.pmod("dns_id", F.lit(3)) == i), path, batch=i)
    compaction.compact(spark, path)
    return sinks.read_dns(spark, path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"), F.count_distinct("_metadata.file_path").alias("files"))


@query
def schema_align(spark, d):
    full = dns(spark, d)
    old = full.filter("dns_id < 8").drop("dns_tld", "dns_cname", "dns_qname_full", "edns_server_options")
    return rows.align(full.filter("dns_id >= 8"), old).groupBy("dns_tld").agg(F.count("*").alias("n"), F.count("dns_qname_full").alias("full_names"))


# Pairing and filters


@query
def pairing_(spark, d):
    p = pairs(spark, d)
    return p.select("capture_file", *ids(p))


QUERIES["pairing"] = QUERIES.pop("pairing_")


@query
def unmatched_requests(spark, d):
    p = pairing.unmatched_requests(pairs(spark, d))
    return p.select(F.col("req.seq").alias("seq"), F.col("req.qname").alias("qname"))


@query
def pairing_keep_retransmits(spark, d):
    p = pairing.transactions(messages(spark, d), keep_retransmits=True)
    return p.select(*ids(p))


@query
def pairing_fold_case(spark, d):
    """Pairing without regard to ASCII case, of messages of which every other one has its name in capitals."""
    m = messages(spark, d).withColumn("qname", F.when(F.col("seq") % 2 == 0, F.upper("qname")).otherwise(F.col("qname")))
    p = pairing.transactions(m, fold_case=True)
    return p.select(*ids(p))


@query
def zone_transfer(spark, d):
    return pairing.drop_transfers(messages(spark, d)).select("seq", "qr", "qtype")


@query
def capture_stats(spark, d):
    return pairing.capture_stats(messages(spark, d), pairs(spark, d))


@query
def tld_filter(spark, d):
    return dns(spark, d, blocked_tlds=(" NL ", "co.nz")).groupBy("dns_tld").agg(F.count("*").alias("n"))


# Names and addresses


def all_names(spark, d) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/:]+)", 1)
    odd = table(spark, d, "customer").select(F.concat(F.col("c_mktsegment"), F.lit(".x."), F.col("c_nationkey"), F.element_at(F.array(*[F.lit(s) for s in (".ck", ".www.ck", ".kawasaki.jp", ".city.kawasaki.jp", ".ma.us", ".pvt.k12.ma.us", "..", ". . NL")]), (F.col("c_custkey") % 8 + 1).cast("int"))).alias("qname"))
    return messages(spark, d).select("qname").unionByName(table(spark, d, "pages").select(host.alias("qname"))).unionByName(odd).distinct()


@query
def clean_name(spark, d):
    return all_names(spark, d).select("qname", C.clean_name("qname").alias("clean"))


@query
def domain_parts(spark, d):
    return names.domain_parts(all_names(spark, d), rules(spark))


@query
def domain_parts_standard(spark, d):
    return names.domain_parts_standard(all_names(spark, d), rules(spark)).select("qname", "tld", "domain", "labels")


@query
def tld_exists(spark, d):
    x = names.domain_parts(all_names(spark, d), rules(spark))
    return names.suffix_exists(x, rules(spark), hot=("bind",)).select("qname", "tld", "tld_exists")


def clients(spark, d) -> DataFrame:
    return messages(spark, d).select(F.col("client_ip").alias("address"))


@query
def resolver_match(spark, d):
    r = address.resolver(resolvers(spark))
    return address.address_dimension(clients(spark, d), [r])


@query
def geo_country(spark, d):
    return address.address_dimension(clients(spark, d), [address.longest_prefix("country", places(spark), "iso")])


@query
def asn_lookup(spark, d):
    p = places(spark)
    return address.address_dimension(clients(spark, d), [address.longest_prefix("asn", p, "asn"), address.longest_prefix("asn_org", p, "org")])


@query
def ecs_enrich(spark, d):
    x = dns(spark, d, enrichments(spark))
    return x.groupBy("edns_ecs_ip_geo_country", "edns_ecs_ip_asn", "edns_ecs_ip_asn_org").agg(F.count("*").alias("n"))


#: When two snapshots of the places were taken.
TAKEN = (datetime(2024, 1, 1), datetime(2024, 1, 12))


@query
def reference_as_of(spark, d):
    """Countries of clients by the list as it was at each message's time; the second snapshot has other codes."""
    path = new_path(spark, "places")
    references.save(places(spark), path, TAKEN[0])
    references.save(places(spark).withColumn("iso", F.concat(F.lit("N"), "iso")), path, TAKEN[1])

    def located(rows: DataFrame, nets: DataFrame) -> DataFrame:
        found = ranges.lookup([address.longest_prefix("iso", nets, "iso")])
        return rows.select(found("client_ip")["iso"].alias("iso"))

    return references.by_snapshot(messages(spark, d), path, "ts", located).groupBy("iso").agg(F.count("*").alias("n"))


# Metrics


def metric_rows(spark, d, places: bool = False) -> DataFrame:
    return sided(dns(spark, d, [country(spark)] if places else [], extended_rcode=False))


@query
def metrics_counters(spark, d):
    return metrics.counters(metric_rows(spark, d))


def _counts(name, column, places=False):
    def run(spark, d):
        return metrics.counts_by(metric_rows(spark, d, places), column(), name)

    run.__name__ = f"metrics_{name}"
    return query(run)


_counts("qtype", lambda: C.type_name("dns_qtype"))
_counts("rcode", lambda: F.col("dns_rcode"))
_counts("opcode", lambda: F.col("dns_opcode"))
_counts("country", lambda: F.when(F.length("ip_geo_country") > 0, F.col("ip_geo_country")), places=True)
_counts("protocol", lambda: F.when(F.col("prot") == 17, "UDP").otherwise("TCP"))
_counts("version", lambda: F.col("ip_version"))
QUERIES["metrics_ip_version"] = QUERIES.pop("metrics_version")


@query
def metrics_rtt(spark, d):
    return metrics.averages(metric_rows(spark, d), "tcp_rtt").withColumn("avg", F.round("avg", 6))


@query
def metrics_proc_time(spark, d):
    return metrics.averages(metric_rows(spark, d), "dns_proc_time").withColumn("avg", F.round("avg", 6))


@query
def metric_points(spark, d):
    return metrics.metric_points(metric_rows(spark, d, places=True)).withColumn("value", F.round("value", 6))


# Streams

#: Milliseconds of packet time that a streamed request waits, and files that one micro-batch takes.
WAIT_MS, FILES = 6 * 3600 * 1000, 8


@query
def stream_pairing(spark, d):
    """Pairing with expiry over micro-batches, state held as a map by name; messages come in order of time, and a last one
    far behind lets everything expire."""
    m = messages(spark, d).select(*pairing.CLIENT, "qname", "qr", "qtype", "seq", "ts")
    path, out, checkpoint = new_path(spark, "messages"), new_path(spark, "paired"), new_path(spark, "checkpoint")
    first, last = (x.timestamp() for x in m.select(F.min("ts").cast("timestamp"), F.max("ts").cast("timestamp")).first())
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    share = F.least(F.floor((t - first) / max(last - first, 1) * 3), F.lit(2))
    end = m.limit(1).withColumns({"qname": F.lit(None).cast("string"), "capture_file": F.lit("end"), "qr": F.lit(1), "ts": F.lit(last + 10 * WAIT_MS / 1000).cast("timestamp").cast("timestamp_ntz")})
    # Each part is paired before the next is there: one with few clients has fewer than FILES files, and a batch that took
    # the rest from the next part would leave that part's other files behind the watermark.
    for part in (*(m.filter(share == i).repartition(FILES, *pairing.CLIENT) for i in range(3)), end):
        part.write.mode("append").parquet(path)
        jobs.pair_files(spark, path, m.schema, out, checkpoint, WAIT_MS, FILES)
    return spark.read.schema(jobs.PAIRED).parquet(out).select("capture_file", "qname", "req_seq", "rsp_seq")


@query
def stream_metrics(spark, d):
    """All metric points by micro-batches of rows in any order, each flush upserted."""
    x = metric_rows(spark, d, places=True)
    x = x.select("time", "server", "server_location", "has_request", "has_response", "dns_qtype", "dns_rcode", "dns_opcode", "ip_geo_country", "prot", "ip_version", "tcp_rtt", "dns_proc_time")
    path, out = new_path(spark, "rows"), new_path(spark, "points")
    x.write.parquet(path)
    jobs.metric_files(spark, path, x.schema, out, new_path(spark, "checkpoint"), FILES // 2, late="1000 days")
    return jobs.latest_points(spark, out).withColumn("value", F.round("value", 6))


@query
def rolled_rows(spark, d):
    """Rows by micro-batches, rolled to the table once enough are staged; rows per day of the table."""
    x = dns(spark, d)
    path, table_path = new_path(spark, "rows"), new_path(spark, "dns")
    x.write.parquet(path)
    roller = jobs.Roller(spark, new_path(spark, "staged"), lambda rows, n: sinks.write_dns(rows, table_path, batch=n), 1500)
    jobs.roll_files(spark, path, x.schema, roller, new_path(spark, "checkpoint"), 1)
    roller.flush()
    return sinks.read_dns(spark, table_path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


# Objects

NOW = "2024-01-20 00:00:00"


@query
def object_state(spark, d):
    x = objects.object_state(V.view(spark, d, V.LEDGER), F.lit(NOW).cast("timestamp_ntz"), 3600 * 24, 3600 * 48)
    return x.select("object_key", "state")


@query
def ingest_stats(spark, d):
    x = objects.object_state(V.view(spark, d, V.LEDGER), F.lit(NOW).cast("timestamp_ntz"), 3600 * 24, 3600 * 48)
    x = x.withColumn("p", C.server_site("object_key")).select("*", "p.server", "p.site")
    return objects.ingest_stats(x).withColumn("avg_tries", F.round("avg_tries", 6)).withColumn("avg_seconds", F.round("avg_seconds", 6))


@query
def reference_staleness(spark, d):
    x = V.view(spark, d, V.LEDGER)
    return x.select("object_key", objects.stale(F.col("started"), F.lit(NOW).cast("timestamp_ntz"), 240).alias("stale"))


# Analyst queries


@query
def row_count(spark, d):
    return dns(spark, d).agg(F.count("*").alias("n"))


@query
def top_domains(spark, d):
    x = dns(spark, d).filter("dns_domainname is not null")
    return x.groupBy("dns_domainname").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dns_domainname").limit(25)


@query
def top_domains_on_date(spark, d):
    """Over the written table, of which only the day's partition is read."""
    path = new_path(spark, "dns")
    sinks.write_dns(dns(spark, d), path)
    x = sinks.read_dns(spark, path).filter((F.col("day") == "2024-01-10") & F.col("dns_domainname").isNotNull())
    return x.groupBy("dns_domainname").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dns_domainname").limit(10)


@query
def rdata_search(spark, d):
    """Rows of one domain whose records hold an address, over the written table: the domain is pushed to the files."""
    path = new_path(spark, "dns")
    sinks.write_dns(dns(spark, d, full=True, rdata=True), path)
    x = sinks.read_dns(spark, path).filter((F.col("dns_domainname") == "zone.nl") & C.has_data("dns_rdata", "192.0.2.3"))
    columns = ["time", "dns_id", "ip_src", "prot_src_port", "dns_qname"]
    return x.select(*columns).orderBy(*columns).limit(100)


@query
def rcodes_per_day(spark, d):
    return dns(spark, d).groupBy(F.to_date("time").cast("string").alias("day"), "dns_rcode").agg(F.count("*").alias("n"))
