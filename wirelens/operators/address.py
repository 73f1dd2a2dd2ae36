"""Networks and addresses of both versions: CIDR normalisation and lookup of addresses in networks.

An address is two longs, hi and lo; version 4 has hi = 0. Lists that fit are flattened to disjoint ranges and searched
(``ranges``). A longer list's lookup explodes the prefix lengths that the lists have (at most 33 and 129) for each distinct
address, so it is an equi-join and never a range or nested-loop join, and all enrichments share one explode, one join and
one grouping.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ipv4_number, ipv6_halves, is_v6, let
from . import ranges
from .sizing import small


def _halves(address: Column) -> Column:
    """struct(version, hi, lo) of an address; null if it is none."""
    as_four = let(ipv4_number(address), lambda n: F.when(n.isNotNull(), F.struct(F.lit(4).alias("version"), F.lit(0).cast("long").alias("hi"), n.alias("lo"))))
    as_six = let(ipv6_halves(address), lambda h: F.when(h.isNotNull(), F.struct(F.lit(6).alias("version"), h["hi"].alias("hi"), h["lo"].alias("lo"))))
    return F.when(is_v6(address), as_six).otherwise(as_four)


def _parsed(address: Column) -> Column:
    """Columns version, hi and lo of an address, null if it is none; unrolled, so that it is parsed once a row."""
    return F.inline(F.array(_halves(address)))


def _mask(bits: Column) -> Column:
    """A long whose first ``bits`` (0 to 64) are set."""
    shift = F.least(F.greatest(F.lit(64) - bits, F.lit(0)), F.lit(63))
    return F.when(bits <= 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), shift.cast("int")))


def _masks(version: Column, plen: Column) -> tuple[Column, Column]:
    """Masks of hi and lo; a version-4 prefix counts in the last 32 bits."""
    return _mask(F.when(version == 4, F.lit(64)).otherwise(F.least(plen, F.lit(64)))), _mask(F.when(version == 4, plen + 32).otherwise(plen - 64))


def normalise(df: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Adds version, plen, and first and last address (hi, lo, last_hi, last_lo) of ranges of both versions; rows that
    aren't addr/len of a network go."""
    parts = F.split(F.col(cidr), "/")
    x = df.filter(F.size(parts) == 2).select("*", F.expr(f"try_cast(get(split({cidr}, '/'), 1) AS INT)").alias("plen"), _parsed(F.try_element_at(parts, F.lit(1))))
    x = x.filter((F.col("plen") >= 0) & (F.col("plen") <= F.when(F.col("version") == 4, 32).otherwise(128)))
    hi, lo = _masks(F.col("version"), F.col("plen"))
    x = x.select("*", F.struct(hi.alias("hi"), lo.alias("lo")).alias("_m")).withColumn("hi", F.col("hi").bitwiseAND(F.col("_m.hi"))).withColumn("lo", F.col("lo").bitwiseAND(F.col("_m.lo")))
    end = F.col("lo").bitwiseOR(F.bitwise_not(F.col("_m.lo")))
    last = F.when(F.col("version") == 4, end.bitwiseAND(0xFFFFFFFF)).otherwise(end)
    x = x.withColumn("last_hi", F.when(F.col("version") == 4, F.lit(0).cast("long")).otherwise(F.col("hi").bitwiseOR(F.bitwise_not(F.col("_m.hi"))))).withColumn("last_lo", last)
    return x.filter("version IS NOT NULL").drop("_m")


@dataclass(frozen=True)
class Enrichment:
    """One column of the address dimension: the value of that network (``cidr``, normalised or not), of those that hold the address, which is
    ``largest`` or smallest in ``by``. ``inclusive`` False leaves a version-4 network's first and last address out,
    and with them networks of one or two addresses."""

    column: str
    networks: DataFrame
    value: str
    by: str = "plen"
    largest: bool = True
    inclusive: bool = True


def resolver(networks: DataFrame, inclusive: bool = False) -> Enrichment:
    """The public resolver's name; of several lists the one with the lowest priority number wins."""
    return Enrichment("dns_pub_resolver", networks, "name", "priority", False, inclusive)


def longest_prefix(column: str, networks: DataFrame, value: str) -> Enrichment:
    return Enrichment(column, networks, value)


def address_dimension(addresses: DataFrame, enrichments: list[Enrichment], address: str = "address") -> DataFrame:
    """One row per distinct address with a column for each enrichment (null where no network has it): by a binary search
    in flat ranges, or by a hash join where the lists are too long to broadcast."""
    found = ranges.lookup(enrichments)
    if found is None:
        return joined_dimension(addresses, enrichments, address)
    x = addresses.select(address).filter(F.col(address).isNotNull()).distinct().withColumn("_found", found(address))
    return x.select(address, *[F.col(f"_found.{e.column}").alias(e.column) for e in enrichments])


def joined_dimension(addresses: DataFrame, enrichments: list[Enrichment], address: str = "address") -> DataFrame:
    """``address_dimension`` for networks of any number: the prefix lengths that the lists have are exploded for each
    address and joined by hash on (version, prefix length, network)."""
    known = {id(e.networks): e.networks if "hi" in e.networks.columns else normalise(e.networks) for e in enrichments}
    enrichments = [replace(e, networks=known[id(e.networks)]) for e in enrichments]
    lists: list[DataFrame] = []
    for e in enrichments:
        if not any(e.networks is n for n in lists):
            lists.append(e.networks)
    number = {id(n): i for i, n in enumerate(lists)}
    nets = None
    for i, n in enumerate(lists):
        fields = [F.col(c).alias(f"_{i}_{c}") for c in dict.fromkeys(c for e in enrichments if e.networks is n for c in (e.value, e.by))]
        x = n.select("version", "plen", "hi", "lo", "last_lo", F.lit(i).alias("_list"), *fields)
        nets = x if nets is None else nets.unionByName(x, allowMissingColumns=True)
    lengths: dict[int, list[int]] = {}
    for r in nets.select("version", "plen").distinct().collect():  # at most 33 and 129
        lengths.setdefault(r["version"], []).append(r["plen"])
    some = F.lit(None).cast("array<int>")
    for version, plens in lengths.items():
        some = F.when(F.col("version") == version, F.array(*[F.lit(p) for p in sorted(plens)])).otherwise(some)
    x = addresses.select(address).filter(F.col(address).isNotNull()).distinct().select(address, _parsed(F.col(address)))
    x = x.select(address, "version", F.col("hi").alias("_hi"), F.col("lo").alias("_ip"), F.explode_outer(some).alias("plen"))
    hi, lo = _masks(F.col("version"), F.col("plen"))
    x = x.select(address, "version", "plen", "_ip", F.col("_hi").bitwiseAND(hi).alias("hi"), F.col("_ip").bitwiseAND(lo).alias("lo"))
    hit = x.join(small(nets), ["version", "plen", "hi", "lo"], "left")
    picks = []
    for e in enrichments:
        i = number[id(e.networks)]
        name = lambda c, i=i: F.col(c) if c in ("version", "plen") else F.col(f"_{i}_{c}")
        counts = F.col("_list") == i
        if not e.inclusive:
            counts = counts & ((F.col("version") == 6) | ((F.col("_ip") > F.col("lo")) & (F.col("_ip") < F.col("last_lo"))))
        order = F.when(counts, F.struct(name(e.by).alias("by"), name(e.value).alias("value")))
        picks.append((F.max if e.largest else F.min)(order)["value"].alias(e.column))
    return hit.groupBy(address).agg(*picks)
