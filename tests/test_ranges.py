"""Flat ranges against containment in every network, and against the hash join."""

import ipaddress
import random

from pyspark.sql import functions as F

from wirelens.operators import address, ranges, rows
from wirelens.operators.address import Enrichment
from wirelens.plans import queries as Q


def test_flatten_is_the_best_network_of_all():
    r = random.Random(1)
    for _ in range(40):
        nets = [(a, min(1023, a + r.choice([0, 1, 7, 63, 255, 1023])), (r.randrange(5), r.choice(["x", "y", None]))) for a in (r.randrange(1000) for _ in range(r.randrange(0, 30)))]
        for largest in (True, False):
            flat = ranges.flatten(nets, largest)
            import numpy as np

            got = flat.find(np.array([i.to_bytes(16, "big") for i in range(1100)], dtype="S16"))
            for i in range(1100):
                held = [k for a, b, k in nets if a <= i <= b]
                assert got[i] == ((max if largest else min)(held, key=lambda k: (k[0], k[1] is not None, k[1] or "")) if held else None)
    assert ranges.flatten([(0, 2**128 - 1, (1, "a"))], True).find(__import__("numpy").array([b"\xff" * 16], dtype="S16")) == [(1, "a")]


def networks(spark, r, n):
    out = []
    for i in range(n):
        if i % 2:
            a, plen = ipaddress.IPv4Address(r.getrandbits(32) & 0x0F0FFFFF), r.choice([0, 4, 8, 9, 16, 24, 30, 31, 32])
        else:
            a, plen = ipaddress.IPv6Address(0x20010DB8 << 96 | r.getrandbits(96) & 0x000F000F << 64), r.choice([0, 32, 48, 64, 65, 127, 128])
        out.append((f"{a}/{plen}", r.choice("abcd"), r.randrange(3), r.choice(["u", "v", None])))
    return address.normalise(spark.createDataFrame(out, "cidr string, name string, priority int, other string"))


def test_search_equals_join(spark, monkeypatch):
    r = random.Random(2)
    nets, more = networks(spark, r, 300).cache(), networks(spark, r, 40).cache()
    texts = [str(ipaddress.IPv4Address(r.getrandbits(32) & 0x0F0FFFFF)) for _ in range(500)] + [str(ipaddress.IPv6Address(0x20010DB8 << 96 | r.getrandbits(96) & (0x000F000F << 64 | 7))) for _ in range(500)]
    a = spark.createDataFrame([(t,) for t in [*texts, *texts[:10], None, "", "x.y", "1.2.3", "::", "255.255.255.255"]], "address string")
    both = [address.resolver(nets), Enrichment("all", nets, "name", "priority", False), address.longest_prefix("long", more, "name"), address.longest_prefix("other", more, "other")]
    got = sorted(map(str, address.address_dimension(a, both).collect()))
    assert got == sorted(map(str, address.joined_dimension(a, both).collect())) and len(got) == a.distinct().count() - 1
    monkeypatch.setattr(ranges, "MOST_NETWORKS", 320)
    assert ranges.lookup(both) is None and sorted(map(str, address.address_dimension(a, both).collect())) == got


def test_lists_as_they_are(spark):
    """Networks that aren't normalised give the same, and what is no network gives none."""
    texts = ["10.1.2.3/8", "10.1.0.0/16", "2001:db8::7/32", "10.1.1.1/33", "10.1.1.1", "x/8", "10.1.1.1/", "10.1.1.1/ 9 ", "::/129", "1.2.3/8", "/8", "10.1.1.1/8/8", None, "10.1.1.0/-1", "::ffff:1.2.3.4/128"]
    raw = spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)], "cidr string, name string")
    a = spark.createDataFrame([(t,) for t in ("10.1.1.1", "10.9.1.1", "2001:db8::1", "1.2.3.4", "::ffff:1.2.3.4", "10.200.0.1")], "address string")
    out = [sorted(map(str, f(a, [address.longest_prefix("n", x, "name")]).collect())) for f in (address.address_dimension, address.joined_dimension) for x in (raw, address.normalise(raw))]
    assert out[0] == out[1] == out[2] == out[3] and "10.9.1.1', n='7'" in str(out[0])


def test_rows_by_search_and_by_join(spark, sf, monkeypatch):
    searched = Q.QUERIES["dns_rows"](spark, sf)
    plan = searched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(capture_file") == 1 and "hashpartitioning(_c" not in plan and "SortMergeJoin" not in plan
    want = sorted(map(str, searched.collect()))
    monkeypatch.setattr(ranges, "MOST_NETWORKS", 1)
    assert sorted(map(str, Q.QUERIES["dns_rows"](spark, sf).collect())) == want


def test_many_networks(spark):
    n = 200_000
    nets = spark.range(n).select(F.format_string("%d.%d.%d.0/24", F.col("id") % 223 + 1, (F.col("id") / 223).cast("int") % 250, (F.col("id") / 223 / 250).cast("int")).alias("cidr"), F.col("id").cast("string").alias("name"))
    a = nets.filter("name % 100 = 0").select(F.regexp_replace("cidr", "0/24", "77").alias("address"), "name")
    out = address.address_dimension(a, [address.longest_prefix("found", address.normalise(nets), "name")]).join(a, "address")
    assert out.count() == n // 100 and out.filter("found IS DISTINCT FROM name").isEmpty()
