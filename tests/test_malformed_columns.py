"""Malformed messages leave Python without what was decoded of the others."""

from pyspark.sql import functions as F

from wirelens.sources import capture
from wirelens.sources.frames import address


def test_malformed_takes_its_columns_only(spark, capsys):
    rows = spark.createDataFrame([("f", 1, bytearray(b"\0" * 12)), ("f", 2, bytearray(b"\0")), ("f", 3, None)], "file string, seq long, payload binary").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = capture.malformed(rows)
    assert sorted((r["file"], r["seq"]) for r in out.collect()) == [("f", 2), ("f", 3)] and all(r["reason"] for r in out.collect())
    out.explain("formatted")
    assert "questions" not in capsys.readouterr().out


def test_address_text():
    assert [address(x) for x in (bytes(4), b"\x0a\0\0\1", bytes(16), bytes(12) + b"\1\2\3\4")] == ["0.0.0.0", "10.0.0.1", "::", "::102:304"]
