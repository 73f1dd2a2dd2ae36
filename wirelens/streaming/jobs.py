"""Structured Streaming forms: metrics on packet time, pairing with expiry, continuous ingest, and rolling of files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import TRANSFERS
from ..operators.attempts import due, outcomes, states
from ..operators.metrics import PLACE, measures, points
from ..operators.pairing import CLIENT
from ..shared import cut, delete, move
from ..sinks import note_attempts, read_attempts
from ..sources.capture import endings, of_scan, scan_files


def metric_stream(rows: DataFrame, seconds: int = 10, late: str = "60 seconds") -> DataFrame:
    """All measures of ``metric_points`` as a stream: (metric, bin, tag, server, server_location, type, value).

    A bin is final once the watermark has passed it by ``late``. With output mode append each point is written once and
    later packets are dropped; with update a late packet writes its bin's points again, to be upserted by the
    receiver (``upsert_points``)."""
    x = rows.withColumn("_t", F.col("time").cast("timestamp")).withWatermark("_t", late)
    x = x.select("_t", *PLACE, F.inline(measures()))
    g = x.groupBy(F.window("_t", f"{seconds} seconds").alias("_w"), "metric", "tag", *PLACE, "counter")
    g = g.agg(F.sum("v").alias("sum"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    return g.select("metric", F.unix_seconds("_w.start").alias("bin"), "tag", *PLACE, F.inline(points()))


def upsert_points(points: DataFrame, batch: int, path: str) -> None:
    """Write a micro-batch of updated points; the folder keeps each batch apart and a reader takes the latest."""
    points.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/flush={batch:012d}")


def latest_points(spark: SparkSession, path: str) -> DataFrame:
    """Points as the last flush that wrote each of them left them."""
    key = ["metric", "bin", "tag", *PLACE, "type"]
    return spark.read.parquet(path).groupBy(*key).agg(F.max_by("value", "batch").alias("value"))


PAIRED = "capture_file string, dns_id int, client_ip string, client_port int, qname string, req_seq long, rsp_seq long"
#: State by key needs a store that writes single entries.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Pairing(StatefulProcessor):
    """Pairing of one client's messages. A batch reads and writes the entries of its own names only, each once; one timer
    for all that a batch leaves pending looks over the client's entries, in steps of a STEPS-th of the time they wait. What a
    batch answers or overwrites itself never becomes state."""

    STEPS = 8

    def __init__(self, expiry_ms: int):
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "name string", "seq bigint, ms bigint")
        #: Responses since the last transfer's request, and its time.
        self.transfer = handle.getValueState("transfer", "answers int, ms bigint")

    @staticmethod
    def _entry(name: str | None) -> tuple[str]:
        """A key for a name, which may be null."""
        return ("" if name is None else f"={name}",)

    def _frame(self, key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            names, asked, answered = zip(*rows)
            numbers = {"req_seq": pd.array(asked, dtype="Int64"), "rsp_seq": pd.array(answered, dtype="Int64")}
            yield pd.DataFrame({**dict(zip(CLIENT, key)), "qname": pd.Series(names, dtype=object), **numbers})

    def _wake(self, since: int) -> None:
        """See to a timer once what began at ``since`` has waited long enough."""
        step = max(1, self.expiry_ms // self.STEPS)
        self.handle.registerTimer(-(-(since + self.expiry_ms) // step) * step)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        data = pd.concat(list(rows)).sort_values(["t", "seq"])
        held: dict[str | None, tuple[int, int] | None] = {}  # entries of this batch's names
        old: dict[str | None, tuple[int, int] | None] = {}  # as they are in the state
        out = []
        transfer = marked = self.transfer.get() if self.transfer.exists() else None
        times = pd.DatetimeIndex(data["t"]).as_unit("ns").asi8 // 1_000_000
        for name, qr, qtype, seq, ms in zip(data["qname"], data["qr"], data["qtype"], data["seq"].tolist(), times.tolist()):
            name = name if isinstance(name, str) else None
            if transfer is not None and transfer[1] + self.expiry_ms <= ms:
                transfer = None
            if qr == 0 and qtype in TRANSFERS:
                transfer = (0, ms)
                continue
            if name not in held:
                held[name] = old[name] = self.pending.getValue(self._entry(name))
            before = held[name]
            if before is not None and before[1] + self.expiry_ms <= ms:
                held[name] = before = None if name is None else out.append((name, before[0], None))
            if qr == 0:
                held[name] = (seq, ms)
                continue
            if transfer is not None:
                transfer = (transfer[0] + 1, transfer[1])
                if transfer[0] > 1:
                    continue
            held[name] = None
            if before is not None or name is not None:
                out.append((name, before[0] if before else None, seq))
        began = []
        for name, value in held.items():
            if value is None:
                if old[name] is not None:
                    self.pending.removeKey(self._entry(name))
            elif old[name] is None or tuple(old[name]) != value:
                self.pending.updateValue(self._entry(name), value)
                began.append(value[1])
        if transfer is not None:
            if marked is None or tuple(marked) != transfer:
                self.transfer.update(transfer)
                began.append(transfer[1])
        elif marked is not None:
            self.transfer.clear()
        if began:
            self._wake(min(began))
        yield from self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # No later message is older than the watermark, so what has waited until then waits in vain.
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        out, waiting, over = [], [], []
        for (entry,), (seq, since) in self.pending.iterator():
            if since + self.expiry_ms > now:
                waiting.append(since)
                continue
            over.append(entry)
            if entry:
                out.append((entry[1:], seq, None))
        for entry in over:
            self.pending.removeKey((entry,))
        if self.transfer.exists():
            since = self.transfer.get()[1]
            if since + self.expiry_ms <= now:
                self.transfer.clear()
            else:
                waiting.append(since)
        if waiting:
            self._wake(min(waiting))
        yield from self._frame(key, out)

    def close(self) -> None:
        pass


def pair_stream(messages: DataFrame, expiry_ms: int = 10_000, late: str = "10 seconds") -> DataFrame:
    """(client key, qname, req_seq, rsp_seq) over micro-batches: a pending request waits ``expiry_ms`` of packet time for
    its response and then leaves alone.

    A client's state is a map of its pending requests by name and, for ``expiry_ms`` after a transfer's request, the
    mark of that transfer. A batch touches the entries of its own names; what has been answered or has expired is removed. Sets the
    session's state store to one that writes single entries."""
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    source = messages.select(*CLIENT, "qname", "qr", "qtype", "seq", F.col("ts").cast("timestamp").alias("t")).withWatermark("t", late)
    return source.groupBy(*CLIENT).transformWithStateInPandas(_Pairing(expiry_ms), PAIRED, "append", "eventTime")


def pair_files(spark: SparkSession, path: str, schema, out: str, checkpoint: str, expiry_ms: int, files_per_trigger: int = 100, late: str = "10 seconds") -> None:
    """``pair_stream`` over the Parquet messages under ``path`` that are there now, oldest files first, appended to ``out``.
    What is then still pending stays in the checkpoint for the next run."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    q = pair_stream(source, expiry_ms, late).writeStream.option("checkpointLocation", checkpoint).option("path", out).format("parquet").trigger(availableNow=True).start()
    q.awaitTermination()


def new_captures(spark: SparkSession, path: str, files_per_trigger: int = 100, archive: str | None = None) -> DataFrame:
    """Stream of capture files; the checkpoint keeps which were read, so each is taken once. With ``archive``, files that
    were read are moved there once their batch is done."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    r = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.{pcap,gz,xz,bz2}").option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.load(path)


def new_files(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Stream of capture files by name (path, length), without their content, so files may be of any size; the
    checkpoint keeps which were listed, each is listed once."""
    return new_captures(spark, path, files_per_trigger).select("path", "length")


class CaptureIngest:
    """Takes batches of capture files (path, length) to a table, at most once each record.

    A batch is what is new and what failed before and may be tried again. Its packets go to ``write(packets, batch)``, which
    must replace what the same batch wrote before (``write_dns(batch=...)``). Then the ledger is told how each file
    ended, and files that ended well are moved to ``archive`` or deleted ("delete"). A batch that stops anywhere is run again
    by the stream: before the ledger knows it everything is done anew under its number, afterwards only files are moved.
    A bad file costs no other file's rows; its own are kept up to the damage, and a retry goes on behind them.
    """

    def __init__(self, spark: SparkSession, ledger: str, write: Callable[[DataFrame, int], None], max_tries: int = 3, archive: str | None = None, block_bytes: int = 64 << 20):
        self.spark, self.ledger, self.write, self.max_tries, self.archive, self.block_bytes = spark, ledger, write, max_tries, archive, block_bytes

    def __call__(self, files: DataFrame, batch: int) -> None:
        attempts = read_attempts(self.spark, self.ledger)
        if attempts.filter(F.col("batch") == batch).isEmpty():
            began = time.time()
            todo = cut(due(files.select("path", "length"), attempts, self.max_tries))
            found = cut(scan_files(self.spark, todo, block_bytes=self.block_bytes))
            self.write(of_scan(found), batch)
            note_attempts(self.spark, outcomes(todo, endings(found)), self.ledger, batch, time.time() - began)
        if self.archive:
            done = read_attempts(self.spark, self.ledger).filter((F.col("batch") == batch) & F.col("failure").isNull())
            for row in done.select("object_key").toLocalIterator():  # a batch's files
                move(self.spark, row["object_key"], None if self.archive == "delete" else self.archive)

    def start(self, path: str, checkpoint: str, files_per_trigger: int = 100):
        """Run over what is under ``path`` now; failed files are tried once more with each batch, also of an empty folder
        through ``retry``."""
        return new_files(self.spark, path, files_per_trigger).writeStream.option("checkpointLocation", checkpoint).foreachBatch(self).trigger(availableNow=True).start()

    def retry(self) -> int:
        """One more batch of failed files only, numbered from below so that no stream's batch has its number; how many were due."""
        attempts = read_attempts(self.spark, self.ledger)
        n = states(attempts, self.max_tries).filter("state = 'failed'").count()
        if n:
            least = attempts.agg(F.min("batch")).first()[0]
            self(self.spark.createDataFrame([], "path string, length long"), min(least, 0) - 1)
        return n


def ingest(captures: DataFrame, build: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], checkpoint: str):
    """Run ``build`` then ``write`` on each micro-batch of captures. Reference lists that ``build`` reads are read anew
    for each batch."""
    return captures.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: write(build(df))).trigger(availableNow=True).start()


class Roller:
    """Rolling of output: micro-batches gather in a staging folder until they hold ``least_rows``, and only then become
    files of the table; ``flush`` forces it. What is staged survives a restart, since it is read back.

    ``write(rows, number)`` must replace what was written under the same number (``write_dns(batch=...)``), which is that of
    the first batch in the roll. So a loss between the table's write and the note of it leaves no row twice: the next roll
    begins with the same batch and replaces those files."""

    def __init__(self, spark: SparkSession, staging: str, write: Callable[[DataFrame, int], None], least_rows: int):
        self.spark, self.staging, self.write, self.least_rows = spark, staging.rstrip("/"), write, least_rows
        #: Numbers of the batches that were rolled, and rows of those that are staged; read once, as nothing else writes them.
        self._done: set[int] | None = None
        self._sizes: dict[int, int] = {}

    def add(self, rows: DataFrame, batch: int) -> None:
        """Stage a micro-batch (again after a restart, under its own number) and roll if there is enough. One that was
        rolled before stays as it is."""
        self._resume()
        if batch not in self._done:
            rows.write.mode("overwrite").parquet(self._folder(batch))
            self._sizes[batch] = self.spark.read.schema(rows.schema).parquet(self._folder(batch)).count()
        self._roll(self.least_rows)

    def flush(self) -> None:
        self._resume()
        self._roll(1)

    def _folder(self, batch: int) -> str:
        return f"{self.staging}/batch={batch:012d}"

    def _read(self, path: str) -> DataFrame | None:
        """The table under a path, or None if nothing is there yet."""
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _resume(self) -> None:
        """What an earlier process left: notes, and staged batches; of those that were noted only the folders are left to delete."""
        if self._done is None:
            done, staged = self._read(f"{self.staging}-rolled"), self._read(self.staging)
            noted = {int(r["batch"]) for r in done.select("batch").distinct().toLocalIterator()} if done is not None else set()
            sizes = {int(r["batch"]): r["count"] for r in staged.groupBy("batch").count().collect()} if staged is not None else {}
            for batch in noted & sizes.keys():
                delete(self.spark, self._folder(batch))
            self._done, self._sizes = noted, {b: n for b, n in sizes.items() if b not in noted}

    def _roll(self, least: int) -> None:
        """Roll what is staged. Only its own folders are read and they are deleted once it is noted, so a roll costs the same
        however many came before."""
        if not self._sizes or sum(self._sizes.values()) < least:
            return
        batches = sorted(self._sizes)
        self.write(self.spark.read.parquet(*map(self._folder, batches)), batches[0])
        self.spark.createDataFrame([(b,) for b in batches], "batch long").coalesce(1).write.mode("append").parquet(f"{self.staging}-rolled")
        self._done.update(batches)
        self._sizes = {}
        for batch in batches:
            delete(self.spark, self._folder(batch))


def roll_files(spark: SparkSession, path: str, schema, roller: Roller, checkpoint: str, files_per_trigger: int = 100) -> None:
    """Roll the Parquet rows under ``path`` that are there now, some files a batch."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(roller.add).trigger(availableNow=True).start().awaitTermination()


def metric_files(spark: SparkSession, path: str, schema, out: str, checkpoint: str, files_per_trigger: int = 100, late: str = "60 seconds") -> None:
    """``metric_stream`` over the Parquet rows under ``path`` that are there now, upserted to ``out`` (``latest_points``)."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    points = metric_stream(source, late=late).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    points.foreachBatch(lambda df, i: upsert_points(df, i, out)).trigger(availableNow=True).start().awaitTermination()
