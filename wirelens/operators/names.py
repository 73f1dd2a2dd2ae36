"""Registered domain, subdomain and public suffix of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean_name, labels, last_labels
from .sizing import small


def suffix_rules(lines: DataFrame, hot: tuple[str, ...] = ()) -> DataFrame:
    """(rule, kind, n_labels) from list lines (value): comments and blanks out, rules below a hot TLD out."""
    x = lines.select(F.lower(F.trim("value")).alias("line")).filter((F.col("line") != "") & ~F.col("line").startswith("//"))
    kind = F.when(F.col("line").startswith("!"), "exception").when(F.col("line").startswith("*."), "wildcard").otherwise("exact")
    x = x.select(F.regexp_replace("line", r"^(!|\*\.)", "").alias("rule"), kind.alias("kind"))
    for tld in hot:
        x = x.filter(~F.col("rule").endswith(f".{tld.strip().lower()}"))
    return x.withColumn("n_labels", F.size(F.split("rule", r"\."))).distinct()


def _parts(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("_clean", clean_name(name)).withColumn("_labels", F.coalesce(labels("_clean"), F.array().cast("array<string>")))


def _result(df: DataFrame, name: str) -> DataFrame:
    n, k = F.size("_labels"), F.size(F.split("_suffix", r"\."))
    valid = (n > 0) & F.coalesce(F.array_join("_labels", "") != "", F.lit(False))
    out = df.withColumn("tld", F.when(valid, F.col("_suffix")))
    out = out.withColumn("domain", F.when(valid & (n > k), F.array_join(F.slice("_labels", n - k, k + 1), ".")))
    out = out.withColumn("subdomain", F.when(valid & (n > k + 1), F.array_join(F.slice("_labels", F.lit(1), n - k - 1), ".")))
    out = out.withColumn("labels", F.when(F.col(name).isNotNull(), F.when(valid, n).otherwise(0)))
    out = out.withColumn("qname_full", F.when(~valid, F.col(name)))
    return out.drop("_clean", "_labels", "_suffix")


def domain_parts(df: DataFrame, rules: DataFrame, name: str = "qname") -> DataFrame:
    """Adds domain, subdomain, tld, labels, qname_full: the shortest listed suffix of 2, 3, 4 labels below a listed
    TLD, else the last label. Joins on whole suffix strings with a small broadcast list; no shuffle of ``df``."""
    exact = small(rules.filter("kind = 'exact'").select(F.col("rule")).distinct())
    x = _parts(df, name)
    for i in range(1, 5):
        x = x.withColumn(f"_s{i}", last_labels(F.col("_labels"), i))
        x = x.join(exact.withColumnRenamed("rule", f"_r{i}"), F.col(f"_s{i}") == F.col(f"_r{i}"), "left")
    multi = F.coalesce("_r2", "_r3", "_r4", "_r1")
    x = x.withColumn("_suffix", F.when(F.col("_r1").isNotNull(), multi).otherwise(F.col("_s1")))
    return _result(x.drop(*[f"_{a}{i}" for a in "sr" for i in range(1, 5)]), name)


def domain_parts_standard(names: DataFrame, rules: DataFrame, name: str = "qname") -> DataFrame:
    """As ``domain_parts`` by the list's own algorithm: the longest rule, wildcards, exceptions. For distinct names:
    the candidates of a name are exploded and joined by hash, then the longest wins."""
    x = _parts(names, name)
    cand = x.select(name, "_labels", F.posexplode("_labels").alias("i", "_l"))
    cand = cand.select(name, (F.size("_labels") - F.col("i")).alias("n"), F.array_join(F.slice("_labels", F.col("i") + 1, F.size("_labels")), ".").alias("rule"), F.array_join(F.slice("_labels", F.col("i") + 2, F.size("_labels")), ".").alias("below"))
    kinds = {k: small(rules.filter(F.col("kind") == k).select("rule").distinct()) for k in ("exact", "wildcard", "exception")}
    hits = cand.join(kinds["exact"], "rule").select(name, "n", F.lit(0).alias("rank"))
    hits = hits.unionByName(cand.join(kinds["wildcard"].withColumnRenamed("rule", "below"), "below").select(name, "n", F.lit(0).alias("rank")))
    hits = hits.unionByName(cand.join(kinds["exception"], "rule").select(name, (F.col("n") - 1).alias("n"), F.lit(1).alias("rank")))
    best = hits.groupBy(name).agg(F.max(F.struct("rank", "n"))["n"].alias("_n"))
    x = x.join(best, name, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    x = x.withColumn("_suffix", F.expr("array_join(slice(_labels, greatest(1, size(_labels) - _n + 1), greatest(1, size(_labels))), '.')"))
    return _result(x.drop("_n"), name)


def suffix_exists(df: DataFrame, rules: DataFrame, hot: tuple[str, ...] = (), tld: str = "tld") -> DataFrame:
    """Adds tld_exists: the suffix is hot, listed, or below a wildcard."""
    listed = small(rules.select(F.col("rule").alias("_e")).distinct())
    wild = small(rules.filter("kind = 'wildcard'").select(F.col("rule").alias("_w")).distinct())
    below = F.when(F.contains(F.col(tld), F.lit(".")), F.expr(f"substring({tld}, instr({tld}, '.') + 1)"))
    x = df.join(listed, F.col(tld) == F.col("_e"), "left").join(wild, below == F.col("_w"), "left")
    found = F.col("_e").isNotNull() | F.col("_w").isNotNull()
    return x.withColumn("tld_exists", (F.coalesce(F.col(tld).isin(*hot), F.lit(False)) | found) if hot else found).drop("_e", "_w")


def tld_filter(df: DataFrame, blocked: tuple[str, ...], tld: str = "tld") -> DataFrame:
    """Rows whose public suffix isn't blocked; rows without one stay."""
    names = [b.strip().lower() for b in blocked]
    return df.filter(F.col(tld).isNull() | ~F.col(tld).isin(*names)) if names else df

