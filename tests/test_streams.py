"""Streams: how often a batch calls on state, and what it may not mix."""

from types import SimpleNamespace

import duckdb
import pandas as pd

from wirelens.plans import queries as Q
from wirelens.plans.oracles import ORACLES
from wirelens.streaming import jobs


class _State:
    """State of one client in memory, which counts the calls."""

    def __init__(self):
        self.map, self.value, self.timers, self.calls = {}, None, set(), 0

    def getMapState(self, *_):
        return self

    getValueState = getMapState

    def _call(self, result=None):
        self.calls += 1
        return result

    def getValue(self, k):
        return self._call(self.map.get(k))

    def containsKey(self, k):
        return self._call(k in self.map)

    def updateValue(self, k, v):
        self._call(self.map.__setitem__(k, v))

    def removeKey(self, k):
        self._call(self.map.pop(k, None))

    def iterator(self):
        return self._call(list(self.map.items()))

    def registerTimer(self, ms):
        self._call(self.timers.add(ms))

    def exists(self):
        return self._call(self.value is not None)

    def get(self):
        return self._call(self.value)

    def update(self, v):
        self.value = self._call(v)

    def clear(self):
        self.value = self._call()


def test_pairing_calls_on_state_once_a_name():
    """2,000 requests of two names, all but the last ones overwritten: calls follow names, not messages; then all expire."""
    at = pd.to_datetime(range(10**12, 10**12 + 2000), unit="ms")
    rows = pd.DataFrame({"qname": ["a", "b"] * 1000, "qr": 0, "qtype": 1, "seq": range(2000), "t": at})
    state, p, key = _State(), jobs._Pairing(10_000), ("f", 1, "ip", 1)
    p.init(state)
    assert list(p.handleInputRows(key, iter([rows]), None)) == []
    assert state.calls <= 8 and len(state.timers) == 1 and len(state.map) == 2
    out = pd.concat(p.handleExpiredTimer(key, SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**12 + 10**6), SimpleNamespace(getExpiryTimeInMs=lambda: min(state.timers))))
    assert sorted(out["req_seq"]) == [1998, 1999] and out["rsp_seq"].isna().all() and not state.map and len(state.timers) == 1


def test_stream_of_few_clients_loses_none(spark, tmp_path):
    """Parts of five clients make fewer files than a batch takes; no batch may take files of the next part too."""
    row = "SELECT CAST(i AS BIGINT) AS event_id, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * CAST(i AS INT) AS ts, CAST(i % 5 AS BIGINT) AS user_id, CASE WHEN i % 3 = 0 THEN 'view' ELSE 'error' END AS event_type, CAST(1 AS DOUBLE) AS value, '' AS props"
    duckdb.sql(f"COPY ({row} FROM range(6000) AS r(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    plain = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    columns = "capture_file, qname, req_seq, rsp_seq"
    want = con.execute(f"SELECT {columns} FROM ({ORACLES['stream_pairing']})").fetchall()
    assert plain(Q.QUERIES["stream_pairing"](spark, str(tmp_path)).select(*columns.split(", ")).collect()) == plain(want) and len(want) > 3000


def test_rolls_read_what_is_staged_only(spark, tmp_path):
    """After a roll nothing stays staged, and the next one reads its own files; a new process rolls what was left."""
    read = []

    def write(df, n):
        read.append(len(df.inputFiles()))
        df.write.mode("overwrite").parquet(f"{tmp_path}/table/roll={n}")

    staged = tmp_path / "staged"
    roller = jobs.Roller(spark, str(staged), write, 10)
    for i in range(4):
        roller.add(spark.range(i * 10, i * 10 + 10, numPartitions=1), i)
        assert list(staged.glob("batch=*")) == []
    roller.add(spark.range(40, 43, numPartitions=1), 4)
    assert read == [1] * 4 and len(list(staged.glob("batch=*"))) == 1
    again = jobs.Roller(spark, str(staged), write, 10)
    again.add(spark.range(30, 40, numPartitions=1), 3)
    again.add(spark.range(43, 50, numPartitions=1), 5)
    assert read == [1] * 4 + [2] and sorted(r[0] for r in spark.read.parquet(str(tmp_path / "table")).select("id").collect()) == list(range(50))
