"""Lists as of a row's time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wirelens.operators import address
from wirelens.sources import references

ONE, TWO = datetime(2024, 1, 1), datetime(2024, 2, 1, 12)


def country(rows, places):
    found = address.address_dimension(rows.select("address"), [address.longest_prefix("iso", places, "iso")])
    return rows.join(found, "address", "left")


def test_a_changed_list_changes_later_rows_only(spark, tmp_path):
    path = str(tmp_path / "places")
    with pytest.raises(ValueError):
        references.by_snapshot(spark.range(1).select(F.current_timestamp().alias("t")), path, "t", lambda r, x: r)
    rows = spark.createDataFrame([(1, "10.0.0.1", datetime(2023, 5, 1)), (2, "10.0.0.1", ONE), (3, "10.0.0.1", datetime(2024, 2, 1, 11)), (4, "10.0.0.1", TWO), (5, "11.0.0.1", TWO), (6, "10.0.0.1", None)], "k int, address string, t timestamp_ntz")
    references.save(spark.createDataFrame([("10.0.0.0/8", "AA")], "cidr string, iso string"), path, ONE)
    before = {r["k"]: r["iso"] for r in references.by_snapshot(rows, path, "t", country).collect()}
    assert before == {1: "AA", 2: "AA", 3: "AA", 4: "AA", 5: None, 6: "AA"}
    for _ in range(2):
        references.save(spark.createDataFrame([("10.0.0.0/8", "BB"), ("11.0.0.0/8", "CC")], "cidr string, iso string"), path, TWO)
    assert references.snapshots(spark, path) == [ONE, TWO]
    after = {r["k"]: r["iso"] for r in references.by_snapshot(rows, path, "t", country).collect()}
    assert after == {1: "AA", 2: "AA", 3: "AA", 4: "BB", 5: "CC", 6: "BB"}
    assert references.by_snapshot(rows.limit(0), path, "t", country).count() == 0
