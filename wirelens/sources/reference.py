"""Reference lists: suffix rules, public resolvers' ranges, geo networks. Inputs are files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.address import normalise


def site_ranges(lines: DataFrame) -> DataFrame:
    """(cidr) of 'cidr site' lines with exactly two tokens."""
    t = F.split(F.trim("value"), r"\s+")
    return lines.filter(F.size(t) == 2).select(t[0].alias("cidr"))


def plain_ranges(*lists: DataFrame) -> DataFrame:
    """(cidr) of lists with one range a line."""
    out = None
    for lines in lists:
        x = lines.select(F.trim("value").alias("cidr")).filter("cidr <> ''")
        out = x if out is None else out.unionByName(x)
    return out


def table_cells(pages: DataFrame, html: str = "html", table: str = r"(?is)<table.*?</table>", row: str = "tr", cell: str = "t[dh]") -> DataFrame:
    """(all columns of pages but html, row_no, cell_no, cell) of the first table that the pattern finds; markup inside
    cells goes. ``row`` and ``cell`` are patterns of the tags."""
    inside = lambda tag: F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")
    rows = pages.withColumn("_rows", F.regexp_extract_all(F.regexp_extract(F.col(html), f"({table})", 1), inside(row), 1)).drop(html)
    keep = [c for c in rows.columns if c != "_rows"]
    cells = rows.select(*keep, F.posexplode("_rows").alias("row_no", "_row"))
    cells = cells.select(*keep, "row_no", F.posexplode(F.regexp_extract_all("_row", inside(cell), 1)).alias("cell_no", "cell"))
    return cells.withColumn("cell", F.trim(F.regexp_replace("cell", "<[^>]*>", "")))


def html_ranges(pages: DataFrame) -> DataFrame:
    """(cidr) of the 4th and 5th column of the table with id networks, without its first row."""
    cells = table_cells(pages, table=r"""(?is)<table[^>]*id=["']?networks.*?</table>""")
    return cells.filter("row_no > 0 and cell_no in (3, 4) and cell <> ''").select(F.col("cell").alias("cidr"))


def resolver_networks(lists: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """Normalised networks of (name, priority, ranges) lists."""
    out = None
    for name, priority, ranges in lists:
        x = normalise(ranges).withColumn("name", F.lit(name)).withColumn("priority", F.lit(priority))
        out = x if out is None else out.unionByName(x)
    return out


def geo_networks(rows: DataFrame, network: str = "network") -> DataFrame:
    """Normalised networks of both versions from the rows of a vendor's network list."""
    return normalise(rows.withColumnRenamed(network, "cidr"))


def geo_csv(spark: SparkSession, paths: str | list[str], columns: str = "network string, value string, org string") -> DataFrame:
    """``geo_networks`` of a vendor's CSV files (version 4 and 6 come in files of their own)."""
    return geo_networks(spark.read.csv(paths, schema=columns, header=True))
