"""Captures from a folder to a table: bad files, retries, restarts, and batches that are run again."""

import gzip

import pytest
from pyspark.sql import functions as F
from test_dns import dns_message, pcap, udp

from wirelens import sinks
from wirelens.operators import assembly, attempts, pairing, rows
from wirelens.plans import queries as Q
from wirelens.sources import capture
from wirelens.streaming import jobs


def requests(first, n):
    return pcap([udp("10.0.0.9", "198.51.100.53", 4000 + i % 50, 53, dns_message(first + i)) for i in range(n)])


class Table:
    def __init__(self, spark, path):
        self.spark, self.path, self.fail = spark, str(path), 0

    def write(self, packets, batch):
        m = capture.flat_messages(capture.messages(assembly.dns_payloads(packets)))
        sinks.write_dns(rows.build_dns(pairing.transactions(m), Q.rules(self.spark)), self.path, batch=batch)
        if self.fail:
            self.fail -= 1
            raise RuntimeError("lost after the write")

    def ids(self):
        return sorted(r[0] for r in sinks.read_dns(self.spark, self.path).select("dns_id").collect())


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def run(spark, folder, table, **more):
    job = jobs.CaptureIngest(spark, str(folder / "ledger"), table.write, max_tries=3, block_bytes=1000, **more)
    job.start(str(folder / "in"), str(folder / "checkpoint")).awaitTermination()
    return job


def ledger(spark, folder):
    return {r["object_key"].split("/")[-1]: (r["tries"], r["records"], r["failure"], r["state"]) for r in attempts.states(sinks.read_attempts(spark, str(folder / "ledger")), 3).collect()}


def test_bad_files_are_retried_and_given_up(spark, folder):
    good, packed = requests(0, 30), gzip.compress(requests(100, 20))
    (folder / "in" / "a.pcap").write_bytes(good)
    (folder / "in" / "b.pcap").write_bytes(requests(200, 10)[:-5])
    (folder / "in" / "c.pcap.gz").write_bytes(packed[:-40])
    (folder / "in" / "d.pcap.gz").write_bytes(b"no gzip")
    table = Table(spark, folder / "table")
    job = run(spark, folder, table, archive=str(folder / "done"))
    first = table.ids()
    assert first[:30] == list(range(30)) and [x for x in first if x >= 200] == list(range(200, 209))
    assert ledger(spark, folder)["a.pcap"] == (1, 30, None, "done") and ledger(spark, folder)["b.pcap"] == (1, 9, "record is cut off", "failed")
    assert sorted(p.name for p in (folder / "done").iterdir() if p.suffix != ".crc") == ["a.pcap"] and not (folder / "in" / "a.pcap").exists()
    given = ledger(spark, folder)["c.pcap.gz"][1]
    (folder / "in" / "c.pcap.gz").write_bytes(packed)
    assert job.retry() == 3
    assert table.ids() == sorted([*range(30), *range(100, 120), *range(200, 209)]) and given < 20
    assert ledger(spark, folder)["c.pcap.gz"] == (2, 20, None, "done") and ledger(spark, folder)["b.pcap"][0] == 2
    assert job.retry() == 2 and job.retry() == 0
    assert {f: s for f, (*_, s) in ledger(spark, folder).items()} == {"a.pcap": "done", "b.pcap": "exhausted", "c.pcap.gz": "done", "d.pcap.gz": "exhausted"}
    assert table.ids() == sorted([*range(30), *range(100, 120), *range(200, 209)])


def test_restart_neither_loses_nor_repeats(spark, folder):
    (folder / "in" / "a.pcap").write_bytes(requests(0, 30))
    table = Table(spark, folder / "table")
    table.fail = 1
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, folder, table)
    assert table.ids() == list(range(30)) and ledger(spark, folder) == {}
    run(spark, folder, table)
    assert table.ids() == list(range(30)) and ledger(spark, folder)["a.pcap"][3] == "done"
    (folder / "in" / "b.pcap").write_bytes(requests(50, 5))
    run(spark, folder, table)
    run(spark, folder, table)
    assert table.ids() == [*range(30), *range(50, 55)]
    seconds = sinks.read_attempts(spark, str(folder / "ledger")).agg(F.min("seconds"), F.count("at")).first()
    assert seconds[0] > 0 and seconds[1] == 2


def test_stream_has_no_content(spark, folder, capsys):
    (folder / "in" / "a.pcap").write_bytes(requests(0, 3))
    assert jobs.new_files(spark, str(folder / "in")).columns == ["path", "length"]
    capture.read_captures(spark, str(folder / "in")).select("path", "length").explain()
    assert "ReadSchema: struct<path:string,length:bigint>" in capsys.readouterr().out


def test_batches_of_one_table_replace_only_themselves(spark, tmp_path, sf):
    x = Q.dns(spark, sf).cache()
    path = str(tmp_path / "t")
    for batch in (1, 2, 2, None, 1):
        sinks.write_dns(x, path, batch=batch)
    assert sinks.read_dns(spark, path).count() == 3 * x.count()


def test_due_lists_each_once(spark):
    files = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "path string, length long")
    tried = spark.createDataFrame([("b", 2, 7, "x", 1.0, None, 1), ("c", 5, 3, "x", 1.0, None, 1), ("c", 5, 9, None, 1.0, None, 2)], attempts.ATTEMPTS)
    assert sorted(map(str, ((r["path"], r["length"], r["skip"]) for r in attempts.due(files.filter("path IS NOT NULL"), tried, 2).collect()))) == ["('a', 1, 0)", "('b', 2, 7)"]
