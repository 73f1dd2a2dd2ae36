"""Which of repeated fragments counts."""

import pytest
from pyspark.sql import functions as F

from wirelens.operators import tcp


@pytest.mark.parametrize("down", [False, True])
def test_first_of_repeated_fragments_counts(spark, down):
    """Fragments that are sent again with other content, dealt to tasks in either order."""
    data = [(i, k, k // 2 * 8, bytes([i, k] * 4)) for i in range(50) for k in range(4)]
    df = spark.createDataFrame([("f", "a", "d", i, 17, at, bytearray(p), False, i * 4 + k) for i, k, at, p in data], "capture_file string, src string, dst string, ip_id int, protocol int, frag_offset int, payload binary, more_fragments boolean, seq long")
    df = df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).coalesce(1).sortWithinPartitions(F.desc("seq") if down else "seq")
    got = {r["ip_id"]: bytes(r["payload"]) for r in tcp.reassemble_fragments(df).collect()}
    assert got == {i: bytes([i, 0] * 4 + [i, 2] * 4) for i in range(50)}
