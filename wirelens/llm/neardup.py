"""Near duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

Texts are sets of distinct word shingles (A-Z lower-cased), compared as sets of their 64-bit hashes. Texts with fewer
words than a shingle are one shingle; texts without words have an empty set and link with nothing. Rows that share a
doc_id are one document: they share a component, whatever their texts. A null doc_id counts as the smallest possible one
while linking and stays null in the result; such rows are documents of their own. Empty tables give empty results;
further columns are left out.

Texts with equal sets form a class first, so a group of exact copies costs one node however large it is. Candidate
edges of a bucket lead from its centre to the others; the centre follows an order that all buckets share, so buckets with
the same members give the same edges. The order begins with the nodes whose buckets are large: they stand amid their
group, so one star links nearly all of it, and few candidates that are unlike remain. Candidates that counts of shingles
by class prove unlike are left out; every other one is confirmed on full sets. A centre then leaves its bucket, whose
other members, if they lie in several components, get another one in the next round; so ROUNDS rounds test every pair of
buckets with up to ROUNDS + 1 members. Larger buckets get centres in the first BULK rounds only, as more would test the
texts at a group's edge against one member after the other. The members of buckets that then still hold several
components go through an exact prefix-filter join, which finds every link between different components among them. What
remains is a pair that shares no bucket, with a probability under MISS by the choice of bands.

No bucket is held in one task: a bucket with more than one ten-thousandth of all members is dealt by member, which is
at most 10,000 buckets, and its centre is copied to the parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from ._text import SLICE_BYTES, Words, bounded, checked, mix, slices

BINS = 256
NO_ID = -(2**63)
#: Nodes (about 60 bytes each) that are broadcast to fetch their texts; more are joined by shuffle.
BROADCAST_NODES = 500_000
#: Classes by low hash bits whose shingles are counted per text.
CLASSES = 64
#: Members of a centre that one copy of the centre's set serves.
FAN = 500
#: Most probability that a pair at the threshold shares no bucket.
MISS = 3e-6
#: Star rounds before the exact join.
ROUNDS = 4
#: Star rounds that test buckets with more members than all rounds settle; these then wait for the exact join.
BULK = 1
#: Members from which a bucket's size counts for the order of centres, and from which it may be dealt by member; beyond
#: these, one ten-thousandth of all members.
LARGE, HOT = 50, 1000

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, hash) of the distinct shingles, sorted by row and hash, and the number of rows."""
    w = Words(column)
    words, rows, counts = w.hashes() if len(w) else np.zeros(0, np.uint64), w.rows(), w.counts()
    place = np.arange(len(words)) - w.first[:-1][rows] if len(words) else np.zeros(0, np.int64)
    size = np.minimum(counts, width)[rows]
    heads = np.flatnonzero(place + size <= counts[rows])
    value = np.zeros(len(heads), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for i in range(width):
        live = i < size[heads]
        value = np.where(live, value * _PRIME + padded[heads + i], value)
    value = mix(value + size[heads].astype(np.uint64))
    owner = rows[heads]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[fresh], value[fresh], len(counts)


def sketch(owner: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """rows x BINS one-permutation sketch: the least hash of each bin, empty bins filled by optimal densification.

    An empty bin tries bins in an order that hashes of (bin, attempt) give, the same for all texts, and copies the
    first that was filled from the start.
    """
    bins = (value >> np.uint64(56)).astype(np.int64)
    first = np.ones(len(value), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (bins[1:] != bins[:-1])
    out = np.zeros((rows, BINS), dtype=np.uint64)
    filled = np.zeros((rows, BINS), dtype=bool)
    out[owner[first], bins[first]] = value[first]
    filled[owner[first], bins[first]] = True
    some = filled.any(axis=1)
    r, b = np.nonzero(~filled & some[:, None])
    attempt = 0
    while len(r):
        attempt += 1
        donor = (mix(b.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) >> np.uint64(56)).astype(np.int64)
        ok = filled[r, donor]
        out[r[ok], b[ok]] = out[r[ok], donor[ok]]
        r, b = r[~ok], b[~ok]
    return out


def band_keys(signs: np.ndarray, bands: int, depth: int) -> np.ndarray:
    keys = np.zeros((len(signs), bands), dtype=np.uint64)
    for i in range(depth):
        keys = keys * _PRIME + signs[:, i : bands * depth : depth]
    return mix(keys)


def banding(percent: int) -> tuple[int, int]:
    """(bands, depth): the deepest bands of all bins that keep a pair at the threshold with probability 1 - MISS."""
    for depth in range(16, 1, -1):
        bands = BINS // depth
        if (1 - (percent / 100) ** depth) ** bands <= MISS:
            return bands, depth
    return BINS, 1


def _set_name(values: bytes) -> bytes:
    return xxhash.xxh3_128_digest(values)


def sketches(docs: DataFrame, width: int, bands: int, depth: int) -> DataFrame:
    """(doc_id, mark, n_shingles, set_id, bands): set_id is a 128-bit hash of the whole sorted set, mark one of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            owner, value, n = shingle_sets(part.column("text"), width)
            keys = band_keys(sketch(owner, value, n), bands, depth).view(np.int64)
            size = np.bincount(owner, minlength=n)
            at = np.concatenate([[0], np.cumsum(size)])
            raw = value.tobytes()
            names = [_set_name(raw[8 * at[i] : 8 * at[i + 1]]) for i in range(n)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array(size, pa.int64()), pa.array(names, pa.binary()), lists], names=["doc_id", "mark", "n_shingles", "set_id", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(run, "doc_id long, mark long, n_shingles long, set_id binary, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, shingles, counts) of ``nodes`` (node, set_id, id, mark: a row that has the set); counts: shingles in
    each of CLASSES classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            owner, value, n = shingle_sets(part.column("text"), width)
            size = np.bincount(owner, minlength=n)
            at = np.concatenate([[0], np.cumsum(size)])
            raw, wanted = value.tobytes(), part.column("set_id").to_pylist()
            mine = pa.array([_set_name(raw[8 * at[i] : 8 * at[i + 1]]) == wanted[i] for i in range(n)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.view(np.int64)))
            classes = np.bincount(owner * CLASSES + (value & np.uint64(CLASSES - 1)).astype(np.int64), minlength=n * CLASSES)
            counts = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * CLASSES, pa.int32()), pa.array(classes, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(size, pa.int64()), lists, counts], names=["node", "n", "shingles", "counts"]).filter(mine)

    wanted, n = nodes.select("node", "set_id", "id", "mark"), nodes.count()
    if n <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("mark"), "text")
    found = cut(rows.join(wanted, ["id", "mark"]).select("node", "set_id", "text").mapInArrow(run, "node long, n long, shingles array<long>, counts array<int>"))
    return found if found.count() == n else cut(found.dropDuplicates(["node"]))  # repeated rows


def _loads(pairs: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of ``pairs`` (a, b), and the most that one node has on each side."""
    ends = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("node")) for side in "ab"]))
    each = pairs.select(ends.alias("x")).groupBy("x").agg(F.count("*").alias("c"))
    found = each.groupBy("x.side").agg(F.sum("c").alias("total"), F.max("c").alias("most")).collect()
    return max([r["total"] for r in found], default=0), {r["side"]: r["most"] for r in found}


def _hot(pairs: DataFrame, side: str, most: int) -> DataFrame:
    """(side, parts) of nodes with more than ``most`` pairs."""
    return F.broadcast(pairs.groupBy(side).agg(F.count("*").alias("c")).filter(F.col("c") > most).select(side, F.ceil(F.col("c") / most).cast("int").alias("parts")))


def _with_sets(pairs: DataFrame, known: DataFrame, fields: list[str]) -> DataFrame | None:
    """(written) ``pairs`` (a, b) with the ``fields`` of both nodes, suffixed a and b; None if there is no pair.

    A node of very many pairs, such as a centre with a third of all rows, is copied, and its pairs are dealt over the
    copies by their other node. Those are nodes with more than one ten-thousandth of the pairs, at most 10,000; a side
    without any is joined plainly, as every plan costs the driver memory.
    """
    total, loads = _loads(pairs)
    if not total:
        return None
    out, most = pairs, max(FAN, total // 10_000)
    met = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    known = known.select("node", *fields).join(met, "node", "left_semi")
    for side, other in (("a", "b"), ("b", "a")):
        named = known.select(F.col("node").alias(side), *[F.col(f).alias(f + side) for f in fields])
        if loads[side] <= most:
            out = out.join(named, side)
            continue
        hot = _hot(pairs, side, most)
        copies = named.join(hot, side, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        dealt = out.join(hot, side, "left").withColumn("_part", F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        out = dealt.join(copies, [side, "_part"]).drop("_part")
    return out


def _alike_sizes(n: str, m: str, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def able(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame | None:
    """Pairs (a, b) without those that sizes or class counts prove unlike: two sets share at most the lesser count of
    each class; None if there is no pair."""
    most = F.aggregate(F.zip_with("countsa", "countsb", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda total, x: total + x)
    fits = F.when(_alike_sizes("na", "nb", percent), most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).otherwise(False)
    both = _with_sets(pairs, known, ["n", "counts"])
    return None if both is None else both.filter(fits).select("a", "b")


def confirm(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame | None:
    """The pairs (a, b) with 100 * intersection >= percent * union; None if there is no pair."""
    common = F.size(F.array_intersect("shinglesa", "shinglesb"))
    both = _with_sets(pairs, known, ["n", "shingles"])
    return None if both is None else both.filter(common * 100 >= (F.col("na") + F.col("nb") - common) * percent).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node reachable over ``edges`` (a, b), by label spreading with pointer jumps.

    Labels never rise, and the least node of a component keeps its own; so they are right once both ends of every edge
    have the same one.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        of_a, of_b = labels.toDF("a", "la"), labels.toDF("b", "lb")
        if both.filter("a < b").join(of_a, "a").join(of_b, "b").filter("la <> lb").isEmpty():
            return labels
        near = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("label").alias("m"))
        low = labels.join(near, labels["node"] == near["b"], "left").select("node", F.least("label", F.coalesce("m", "label")).alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = cut(low.join(up, "label", "left").select("node", F.least("label", F.coalesce("above", "label")).alias("label")))


def _merge(labels: DataFrame | None, good: DataFrame) -> DataFrame:
    """``labels`` (node, label) of all nodes that have a link, with the components that ``good`` (a, b) links made one.
    Only labels that a new link touches are spread over, so a late round with few links costs little."""
    if labels is None:
        return components(good)
    of_a, of_b = labels.toDF("a", "la"), labels.toDF("b", "lb")
    ends = good.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b").distinct()
    above = components(ends)
    moved = labels.join(above.toDF("label", "above"), "label", "left").select("node", F.coalesce("above", "label").alias("label"))
    return cut(moved.unionByName(above.join(labels.select("node"), "node", "left_anti")))


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``members`` with their node's component (label)."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """(bucket, salt, size, a, na, la): a centre for each bucket whose (labelled) members lie in several components, once
    for each part of a hot bucket."""
    centre = F.min(F.struct((-F.col("weight")).alias("order"), F.xxhash64("node").alias("mark"), "node", "n", "label")).alias("c")
    one = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("parts").alias("parts"), F.count("*").alias("size"), centre).filter("lo <> hi")
    return one.select("bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "size", F.col("c.node").alias("a"), F.col("c.n").alias("na"), F.col("c.label").alias("la"))


def _prefix_pairs(open_: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b): every pair of the nodes ``open_`` (node, label), of different labels, that may reach ``percent``.

    Exact: order each set by rising frequency of its shingles, then value, those of one component only before all others,
    as no pair shares them. If two sets link, the first shingle they share is among the first n - ceil(percent * n) + 1
    of the larger one, which probes, and among the first n - ceil(2 * percent / (100 + percent) * n) + 1 of the smaller
    one, which is indexed, since no larger set can share fewer with it; from there on both hold enough. A group of texts
    just under the threshold has its common shingles behind these prefixes, so they don't meet there.

    A shingle's rows of its largest component meet only rows of others, and the rows of a frequent shingle are dealt
    over copies of FAN rows.
    """
    sizes = open_.groupBy("label").agg(F.count("*").alias("size"))
    nodes = cut(open_.join(sizes, "label").join(known.select("node", "n", "shingles"), "node"))
    each = nodes.select("node", "label", "size", F.explode("shingles").alias("s"))
    # Which component counts as a shingle's largest changes the cost only: the largest of all that have it.
    most = F.max(F.struct("size", "label"))["label"].alias("major")
    often = each.groupBy("s").agg(F.count("*").alias("often"), most, (F.min("label") < F.max("label")).alias("several"))
    often = cut(often.filter("several").select("s", "often", "major"))
    # A shingle that no other component has stands before all others, so only the number of those counts.
    order = F.array_sort(F.collect_list(F.struct("often", "s", "major"))).alias("order")
    shared = each.select("node", "s").join(often, "s").groupBy("node").agg(order).join(nodes.select("node", "label", "n"), "node")
    alone = F.col("n") - F.size("order")
    length = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone).cast("int")
    rows = shared.select("node", "label", "n", alone.alias("alone"), F.posexplode(F.slice("order", F.lit(1), length)).alias("at", "o"))
    rest = F.col("n") - F.col("alone") - F.col("at")
    rows = rows.select("node", "label", "n", rest.alias("rest"), "o.s", (F.col("label") == F.col("o.major")).alias("most"), F.ceil(F.col("o.often") / FAN).alias("fans"))
    rows = cut(rows.withColumn("index", F.col("rest") * (100 + percent) >= 2 * F.col("n") * percent))
    copied = F.explode(F.sequence(F.lit(0).cast("long"), F.col("fans") - 1))
    part = F.pmod(F.xxhash64("node"), F.col("fans"))

    def side(df: DataFrame, name: str, fan: Column) -> DataFrame:
        return df.select("s", F.col("node").alias(name), F.col("label").alias(f"l{name}"), F.col("n").alias(f"n{name}"), F.col("rest").alias(f"r{name}"), fan.alias("fan"))

    larger = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") > F.col("b")))
    enough = _alike_sizes("na", "nb", percent) & (F.least("ra", "rb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
    index = rows.filter("index")
    one = side(rows.filter("not most"), "a", copied).join(side(index, "b", part), ["s", "fan"])
    two = side(rows.filter("most"), "a", part).join(side(index.filter("not most"), "b", copied), ["s", "fan"])
    return one.unionByName(two).filter((F.col("la") != F.col("lb")) & larger & enough).select("a", "b").distinct()


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, salt, parts, node, n, weight) of the buckets with several nodes; members of hot ones are dealt over parts.

    weight: how many nodes its large buckets hold, and the number of its others."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), "node")
    sizes = cut(banded.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1"))
    n, total = sizes.agg(F.count("*"), F.sum("c")).first()
    large, most = (max(x, (total or 0) // 10_000) for x in (LARGE, HOT))  # at most 10,000 buckets hold more
    shared = cut(banded.join(checked(sizes.select("bucket"), n), "bucket", "left_semi"))
    large = F.broadcast(sizes.filter(F.col("c") > large).select("bucket", "c", F.ceil(F.col("c") / most).cast("int").alias("parts")))
    dealt = shared.join(large, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    weights = dealt.groupBy("node").agg(F.sum(F.coalesce("c", F.lit(1))).alias("weight")).join(nodes.select("node", "n"), "node")
    return dealt.drop("c").join(weights, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _same_id(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links between the different sets that rows with one (not null) doc_id have."""
    mine = rows.filter("doc_id is not null and n_shingles > 0")
    several = mine.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).filter("lo <> hi").select("doc_id")
    named = mine.join(several, "doc_id").select("doc_id", "set_id").distinct().join(nodes.select("set_id", "node"), "set_id")
    return named.join(named.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, percent: int, rounds: int) -> DataFrame | None:
    """(node, label): components of the nodes that have a link; None if there is no link."""
    good = cut(_same_id(rows, nodes))
    labels = None if good.isEmpty() else _merge(None, good)
    open_ = cut(_buckets(nodes))
    met = nodes.join(open_.select("node").distinct(), "node", "left_semi")
    known, tested = full_sets(docs, met, width), None
    for step in range(rounds + 1):
        placed = _labelled(open_, labels)
        joined = placed.join(_open_buckets(placed), ["bucket", "salt"])
        if step < rounds:
            joined = joined.withColumn("star", (F.col("size") <= rounds + 1 - step) | F.lit(step < BULK)).filter("node <> a OR NOT star")
        joined = cut(joined)
        if joined.isEmpty():
            return labels
        if step == rounds:
            pairs = _prefix_pairs(joined.select("node", "label").distinct(), known, percent)
        else:
            pairs = joined.filter("star AND label <> la").filter(_alike_sizes("n", "na", percent)).select("a", F.col("node").alias("b")).distinct()
            open_ = joined.select("bucket", "salt", "parts", "node", "n", "weight")
        if tested is not None:
            pairs = pairs.join(tested, (F.least("a", "b") == tested["lo"]) & (F.greatest("a", "b") == tested["hi"]), "left_anti")
        fit = able(cut(pairs.select("a", "b")), known, percent)
        if fit is None:
            continue
        pairs = cut(fit)
        alike = confirm(pairs, known, percent)
        if alike is None:
            continue
        done = pairs.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        tested = done if tested is None else tested.unionByName(done)
        good = cut(alike)
        if not good.isEmpty():
            labels = _merge(labels, good)
    return labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, bands: int | None = None, depth: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    At 85 percent there are 36 bands of 7 bins: two texts at the threshold share no bucket with probability 1e-6, more
    alike ones with less. ``rounds`` of stars change the cost, not the result.
    """
    if bands is None or depth is None:
        bands, depth = banding(percent)
    rows = cut(sketches(docs, width, bands, depth))
    ident = F.coalesce("doc_id", F.lit(NO_ID))
    sets = rows.filter("n_shingles > 0").groupBy("set_id").agg(F.min(F.struct(ident.alias("id"), "mark")).alias("r"), F.min("n_shingles").alias("n"), F.min("bands").alias("bands"))
    # Numbers are given once and kept in the written table.
    nodes = cut(sets.select(F.monotonically_increasing_id().alias("node"), "set_id", "n", "bands", "r.id", "r.mark"))
    labels = links(docs, rows, nodes.select("node", "set_id", "n", "bands", "id", "mark"), width, percent, rounds)
    least = nodes.select("set_id", "node", F.col("id").alias("least"))
    if labels is not None:
        tied = cut(least.join(labels, "node"))
        lowest = tied.groupBy("label").agg(F.min("least").alias("low"))
        least = least.join(tied.join(lowest, "label").select("node", "low"), "node", "left").select("set_id", F.coalesce("low", "least").alias("least"))
    named = rows.select("doc_id", "n_shingles", "set_id").join(least.select("set_id", "least"), "set_id", "left").withColumn("least", F.coalesce("least", "doc_id"))
    # Rows of one doc_id with and without words share the component too.
    mixed = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count_if(F.col("n_shingles") == 0).alias("empty"), F.count("*").alias("all")).filter("empty > 0 AND empty < all").select("doc_id")
    mixed = cut(mixed)
    if not mixed.isEmpty():
        shared = named.join(mixed, "doc_id").groupBy("doc_id").agg(F.min("least").alias("all"))
        named = named.join(shared, "doc_id", "left").withColumn("least", F.coalesce("all", "least"))
    named = named.withColumn("component_id", F.when(F.col("least") != NO_ID, F.col("least")))
    return named.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id. Of its repeated rows one of each text
    stays (the least by its other columns). Rows with a null doc_id stay."""
    found = cut(near_duplicates(bounded(docs), percent=percent).filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_rows"), F.max("kept").alias("_kept")))
    gone = found.filter("_rows > 1 OR NOT _kept").select("doc_id")
    chosen = docs.join(checked(gone, gone.count()), "doc_id", "left_anti").select(docs.columns)
    repeated = found.filter("_rows > 1 AND _kept").select("doc_id")
    if repeated.isEmpty():
        return chosen
    mine, others = docs.join(repeated, "doc_id", "left_semi"), [c for c in docs.columns if c not in ("doc_id", "text")]
    least = mine.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0), *others)).alias("_o"))
    return chosen.unionByName(least.select("doc_id", "text", *[F.col("_o").getField(c).alias(c) for c in others]).select(docs.columns))
