"""Packing of small files: what stays, what goes, and runs that are lost half way."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wirelens import compaction, shared, sinks
from wirelens.plans import queries as Q


def files(spark, path):
    return {r["path"]: r["length"] for r in compaction.listing(spark, path).collect()}


@pytest.fixture
def table(spark, sf, tmp_path):
    x = Q.dns(spark, sf).cache()
    path = str(tmp_path / "t")
    for i in range(4):
        sinks.write_dns(x.filter(F.pmod("dns_id", F.lit(4)) == i), path, batch=i)
    return path, sorted(map(str, x.collect()))


def content(spark, path):
    return sorted(map(str, sinks.read_dns(spark, path).drop("day").collect()))


def test_only_small_files_are_joined(spark, table):
    path, want = table
    before = files(spark, path)
    days = {p.split("day=")[1][:10] for p in before}
    target = sorted(before.values())[len(before) // 2]
    assert compaction.compact(spark, path, target) > 0
    after = files(spark, path)
    assert content(spark, path) == want and len(after) < len(before)
    assert {p for p, n in before.items() if n >= target} <= set(after)
    compaction.compact(spark, path)
    last = files(spark, path)
    assert len(last) == len(days) and content(spark, path) == want
    assert compaction.compact(spark, path) == 0 and files(spark, path) == last
    for p in last:
        v = pq.read_table(p.replace("file:", "")).column("dns_domainname").to_pylist()
        assert v == sorted(v, key=lambda d: (d is None, d or ""))


def test_rounds_and_batches_that_aren_t_settled(spark, table, monkeypatch):
    path, want = table
    monkeypatch.setattr(compaction, "FILES_AT_ONCE", 5)
    late = {p for p in files(spark, path) if "batch=3" in p}
    compaction.compact(spark, path, settled=3)
    assert late <= set(files(spark, path)) and content(spark, path) == want


@pytest.mark.parametrize("fails_at", [0, 1, 3, 8])
def test_lost_swap_is_finished_by_the_next_call(spark, table, monkeypatch, fails_at):
    path, want = table
    calls = iter(range(10**6))

    def lost(f):
        def run(*args):
            if next(calls) == fails_at:
                raise RuntimeError("lost")
            return f(*args)

        return run

    with monkeypatch.context() as m:
        m.setattr(compaction, "move", lost(shared.move))
        m.setattr(compaction, "delete", lost(shared.delete))
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact(spark, path)
            raise RuntimeError("lost")
    compaction.compact(spark, path)
    assert content(spark, path) == want and len({p.split("day=")[1][:10] for p in files(spark, path)}) == len(files(spark, path))


def test_days_are_packed_apart(spark):
    rows = [(f"d{d}/{i}", n, f"d{d}", 0) for d, sizes in enumerate([[10] * 25, [100, 5], [5, 6], [7]]) for i, n in enumerate(sizes)]
    x = compaction.packed(spark.createDataFrame(rows, "path string, length long, day string, batch long"), 100)
    sizes = {}
    for r in x.collect():
        sizes.setdefault((r["day"], r["bin"]), []).append(r["length"])
    assert sizes == {("d0", 0): [10] * 10, ("d0", 1): [10] * 10, ("d0", 2): [10] * 5, ("d2", 0): [5, 6]}
