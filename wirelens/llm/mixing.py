"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

Sources, shards and documents with equal keys, nulls and empty texts:

* a null source is a source of its own and sorts last; a null or empty text has size 0 and is taken 0 times;
* repeated rows are documents of their own; an empty table gives an empty result; other columns are kept out;
* ties between quotients fall by source (or shard) number, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Levels tried at once when a quotient is narrowed, and rounds of it: STEPS ** ROUNDS parts on a scale of ratios.
STEPS, ROUNDS = 64, 3


def sizes(docs: DataFrame, text: str = "text") -> Column:
    """Number of words; null counts as empty. Runs of word characters become one mark each, then other characters go."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds the row's number (from 1) in the total order ``order``: ranges sorted apart, then offset by the counts of the
    ranges before, so no task sorts more than its range."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(tasks, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = placed.groupBy("_range").agg(F.count("*").alias("_rows")).select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn("_at", inside).join(offsets, "_range").withColumn(out, F.col("_at") + F.col("_offset")).drop("_range", "_at", "_offset")


def narrowed(parties: DataFrame, bounds: DataFrame, group: list[str], measure: Callable[[Column], Column], goal: str, rounds: int) -> DataFrame:
    """``bounds`` (group, low, high, goal) drawn together around where the sum of ``measure`` over a group's parties,
    which falls from low to high, crosses the goal: at low it is the goal or more, at high the goal or less.

    Each round tries STEPS levels at once in one aggregation, so no group's parties meet in one task.
    """
    keys = [*group, "low", "high", goal]
    for _ in range(rounds):
        level = lambda i: F.col("low") * F.pow(F.col("high") / F.col("low"), F.lit(i / STEPS))
        sums = F.array(*[F.sum(measure(level(i))) for i in range(1, STEPS)]).alias("_sums")
        seen = parties.join(bounds, group).groupBy(*keys).agg(sums)
        enough = F.size(F.filter("_sums", lambda x: x >= F.col(goal)))
        at = lambda n: F.when(n <= 0, F.col("low")).when(n >= STEPS, F.col("high")).otherwise(F.col("low") * F.pow(F.col("high") / F.col("low"), n / STEPS))
        bounds = cut(seen.select(*group, at(enough).alias("low"), at(enough + 1).alias("high"), goal))
    return bounds


def capped_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Targets for rows (source_no, size, weight): shares by weight, cut at cap * size, the excess reshared.

    That is water filling: every target is the lesser of cap * size and level * weight. The level where they sum to all
    sizes is the largest start of resharing: from each level, sources at their cap keep it and the rest is shared by
    weight again, until no further source meets its cap.
    """
    rows = cut(sources.withColumn("_limit", F.col("size") * F.lit(float(cap))).withColumn("_ratio", F.col("_limit") / F.col("weight")))
    capped, level = -1, None
    while True:
        over = F.col("_ratio") < F.lit(level if level is not None else 0.0)
        x = rows.agg(F.count_if(over).alias("n"), F.sum("size").alias("all"), F.sum(F.when(over, F.col("_limit"))).alias("cut"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if x["n"] == capped or not x["open"]:
            break
        capped, level = x["n"], ((x["all"] or 0) - (x["cut"] or 0.0)) / x["open"]
    target = F.least(F.col("_limit"), F.lit(level) * F.col("weight")) if level is not None else F.lit(0.0)
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).drop("_limit", "_ratio")


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague: each group's ``seats`` go to its parties by the highest quotients votes / (2k + 1).

    A party has floor((votes / t + 1) / 2) quotients of t or more, so the quotient that takes the last seat is found by
    narrowing t with sums over the parties. Quotients above the last two levels have their seats; those between them
    (ties and near ties) are numbered by quotient, then party, and take what seats are left. ``party`` is a number.
    """
    rows = cut(parties.withColumn("_g", F.lit(0)))
    by = [*group, "_g"]
    votes_ = F.col(votes).cast("double")
    seats_of = lambda t: F.floor((votes_ / t + 1) / 2)
    stats = rows.groupBy(*by).agg(F.sum(votes_).alias("_all"), F.max(votes_).alias("_most"), F.count("*").alias("_n"), F.max(seats).cast("long").alias("_goal"))
    stats = stats.filter("_all > 0 AND _goal > 0")
    # All quotients from votes / (2 seats + parties) on are seats at least; none is above the most votes.
    low = F.col("_all") / (2 * F.col("_goal") + F.col("_n")) * 0.999999
    spare = 2 * F.col("_goal") - F.col("_n")
    high = F.least(F.col("_most") * 1.000001, F.when(spare > 0, F.col("_all") / spare * 1.000001))
    bounds = narrowed(rows, cut(stats.select(*by, low.alias("low"), F.greatest(high, low).alias("high"), "_goal")), by, seats_of, "_goal", ROUNDS)
    placed = rows.join(bounds, by, "left").withColumn("_sure", F.coalesce(seats_of(F.col("high")), F.lit(0)).cast("long")).withColumn("_may", F.coalesce(seats_of(F.col("low")), F.lit(0)).cast("long"))
    placed = cut(placed.drop("low", "high"))
    left = placed.groupBy(*by).agg((F.max("_goal") - F.sum("_sure")).alias("_left")).filter("_left > 0")
    close = placed.filter("_may > _sure").select(*by, F.col(party).alias("_p"), votes_.alias("_v"), F.explode(F.sequence(F.col("_sure"), F.col("_may") - 1)).alias("_k"))
    close = close.withColumn("_minus", -F.col("_v") / (2 * F.col("_k") + 1)).join(left, by)
    close = cut(numbered(close, [*[F.col(g) for g in by], F.col("_minus"), F.col("_p"), F.col("_k")], "_place"))
    first = close.groupBy(*by).agg(F.min("_place").alias("_first"))
    won = close.join(first, by).filter(F.col("_place") - F.col("_first") < F.col("_left")).groupBy(*by, F.col("_p").alias(party)).agg(F.count("*").alias("_won"))
    done = placed.join(won, [*by, party], "left").withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0)))
    return done.drop("_g", "_goal", "_sure", "_may", "_won")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, block: int = 4, shard_words: int = 100_000, seed: int = 17) -> DataFrame:
    """Words taken of each document so that sources come near their target shares.

    Sainte-Lague deals blocks of ``block`` words to sources, then each source's blocks to its shards. A shard is a seeded
    part of a source of about ``shard_words`` words, so a large source has many shards and a window holds one shard. In
    a shard the documents follow a seeded order; its quota of blocks is a run (around the end, if need be) from a
    seeded block on; whole rounds of the shard repeat it.

    Returns doc_id, source, size, source_size, target, blocks_taken (of the shard), taken.
    """
    sized = cut(docs.select("doc_id", "source", sizes(docs).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_at")))
    totals = numbered(sized.groupBy("source").agg(F.sum("size").alias("size")), [F.col("source").asc_nulls_last()], "source_no")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = capped_targets(totals.withColumn("source_no", F.col("source_no").cast("long")).withColumn("weight", cycle), cap)
    everything = sized.agg(F.sum("size")).first()[0] or 0
    sources = apportion(sources.withColumn("seats", F.lit(round(everything / block)).cast("long")), [], "source_no", "target", "seats", "quota")
    sources = cut(sources.select("source", "source_no", F.col("size").alias("source_size"), "target", "quota", F.greatest(F.lit(1), F.ceil(F.col("size") / shard_words)).alias("shards")))

    placed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"]).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_at"), F.col("shards")))
    parts = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    parts = apportion(parts, ["source_no"], "shard", "shard_size", "quota", "shard_quota")
    words = F.least(F.col("shard_quota") * block, F.lit(cap) * F.col("shard_size"))
    parts = parts.filter("shard_size > 0").select(
        "source_no", "shard", "shard_size", "shard_quota",
        F.floor(words / F.col("shard_size")).alias("rounds"),
        F.pmod(words, F.col("shard_size")).alias("rest"),
        (F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), F.greatest(F.lit(1), F.floor(F.col("shard_size") / block))) * block).alias("begin"),
    )
    order = Window.partitionBy("source_no", "shard").orderBy("_at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("size").over(order)
    laid = placed.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("size"))
    both = laid.join(parts, ["source_no", "shard"], "left")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), high) - F.greatest(F.col("_start"), low))

    stop = F.col("begin") + F.col("rest")
    some = overlap(F.col("begin"), F.least(stop, F.col("shard_size"))) + overlap(F.lit(0), stop - F.col("shard_size"))
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + some).otherwise(0)
    return both.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), F.coalesce("shard_quota", F.lit(0)).alias("blocks_taken"), F.coalesce(taken, F.lit(0)).cast("long").alias("taken"))
