"""Queue messages: drain what has arrived, set bad bodies aside, land the rest."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..folding import finish_folds, not_folded
from ..functions.payload import ENVELOPE_COLUMNS, flatten_body, is_valid_json, normalize_json
from ..operators.ledger import append_paths, fold_ledger, ledger_entries, read_ledger, unread_paths
from ..sinks.files import FLUSH_ROWS
from ..sinks.tables import create_table_if_absent, replace_partitions
from ..shared import pinned_session
from ..sources.files import PROVENANCE
from .load import FILE_AGE, FILES_PER_BATCH, LOAD_BATCH, READ_OPTIONS, batch_label, new_files, read_batch

BROKEN = "_broken_line"
ACCEPTED, REJECTED = "accepted", "rejected"
FEW_MESSAGES = 1_000
FOLDERS_PER_LOAD = 1_000
ARRIVED, DELIVERY = "_arrived", "_delivery"
# Ids of a long window stay on disk, with their copies in the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@dataclass(frozen=True)
class IngestResult:
    """Counters of a drain and why it stopped."""

    received: int
    saved: int
    rejected: int
    paths: tuple[str, ...]
    stopped: str


class _StopRule(StreamingQueryListener):
    """Says when a watched drain is over: a cycle with few messages, or one without any."""

    def __init__(self, name: str, few: int, received: dict[int, int]):
        self.name, self.few, self.received = name, few, received
        self.run: str | None = None
        self.reason: str | None = None
        self.over = threading.Event()

    def _end(self, run: object, reason: str | None) -> None:
        if str(run) == self.run and not self.over.is_set():
            self.reason = reason
            self.over.set()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        taken = self.received.get(event.progress.batchId)
        if taken is not None and taken < self.few:
            self._end(event.progress.runId, "low_throughput" if taken else "zero_messages")

    def onQueryIdle(self, event) -> None:
        self._end(event.runId, "zero_messages")

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId, None)


def _wait(query: StreamingQuery, rule: _StopRule, max_seconds: float | None) -> str | None:
    """Wait for the rule or the time limit, then stop between two cycles; a failed query raises."""
    reason = rule.reason if rule.over.wait(max_seconds) else "time_limit"
    query.stop()
    query.awaitTermination()
    return reason


def _each_delivered_once(
    spark: SparkSession, source: str, file_format: str, declared: T.StructType, max_files: int, key: str, within: str
) -> DataFrame:
    """Messages as a stream, each id once within a stretch of time since it first arrived.

    Time is that of the micro-batch, so no message is ever late, however old its file is. A message
    without id is no other's copy. The state holds the ids of one stretch.
    """
    reader = spark.readStream.format(file_format).schema(declared).options(
        **READ_OPTIONS[file_format], maxFilesPerTrigger=max_files, maxFileAge=FILE_AGE, columnNameOfCorruptRecord=BROKEN
    )
    known = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    delivery = F.when(known, F.concat(F.lit("id:"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("row:"), F.uuid()))
    arrived = reader.load(source).withColumns({ARRIVED: F.current_timestamp(), DELIVERY: delivery})
    return arrived.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark([DELIVERY]).drop(ARRIVED, DELIVERY)


def drain_messages(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    schema: T.StructType,
    body: str = "Body",
    file_format: str = "json",
    max_files: int = FILES_PER_BATCH,
    flush_rows: int = FLUSH_ROWS,
    on_landed: Callable[[str], None] | None = None,
    cycle: str | None = None,
    few: int = FEW_MESSAGES,
    max_seconds: float | None = None,
    once_by: str | None = None,
    within: str = "1 day",
) -> IngestResult:
    """Land all waiting message files as Parquet: ``landing/<batch>/status=…``.

    One pass over each micro-batch writes accepted and rejected messages side by side;
    counts are taken during that write. A replayed batch rewrites its own folder. A
    message counts as taken only when its batch is in the checkpoint, after the write and
    after ``on_landed`` has noted the folder, so no landed folder can be forgotten.

    Without ``cycle`` it ends when what waited at the start has landed. With it (``60 seconds``)
    a micro-batch starts every cycle until one has fewer than ``few`` messages
    (``low_throughput``) or none arrive (``zero_messages``), or after ``max_seconds`` (``time_limit``).
    A cycle that is stopped half-way is replayed by the next run.

    With ``once_by`` (``MessageId``) a message delivered again ``within`` that time of its first
    arrival is left out, in any later batch or run of this checkpoint; the counters leave it out, too. The
    ids are kept as state, so a checkpoint keeps to one of the two ways.
    """
    counts: dict[str, tuple[int, int]] = {}
    received_in: dict[int, int] = {}
    declared = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])

    def land(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        if once_by:
            messages = batch
        else:
            waiting = [row.path for row in batch.collect()]
            if not waiting:
                return
            messages = read_batch(spark, waiting, source, file_format, declared, columnNameOfCorruptRecord=BROKEN).drop(PROVENANCE)
        # a line that is no envelope at all is set aside as it was received
        whole = F.col(BROKEN).isNull()
        ok = whole & is_valid_json(body)
        received = F.when(whole, F.col(body)).otherwise(F.col(BROKEN))
        checked = messages.withColumns(
            {"status": F.when(ok, ACCEPTED).otherwise(REJECTED), body: F.when(ok, normalize_json(body)).otherwise(received)}
        ).drop(BROKEN)
        folder = f"{landing}/{label}"
        seen = Observation()
        counted = checked.observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == REJECTED).alias("bad")
        )
        counted.write.mode("overwrite").option("maxRecordsPerFile", flush_rows).partitionBy("status").parquet(folder)
        counts[label] = (seen.get["n"], seen.get["bad"])
        received_in[batch_id] = seen.get["n"]
        if on_landed and seen.get["n"] > seen.get["bad"]:
            on_landed(folder)

    if once_by:
        stream = _each_delivered_once(pinned_session(spark, **STATE_STORE), source, file_format, declared, max_files, once_by, within)
    else:
        stream = new_files(spark, source, max_files)
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    reason = None
    if cycle:
        rule = _StopRule(f"drain-{uuid.uuid4().hex}", few, received_in)
        streams = stream.sparkSession.streams
        streams.addListener(rule)
        try:
            reason = _wait(writer.queryName(rule.name).trigger(processingTime=cycle).start(), rule, max_seconds)
        finally:
            streams.removeListener(rule)
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    received = sum(n for n, _ in counts.values())
    rejected = sum(bad for _, bad in counts.values())
    stopped = "zero_messages" if received == 0 else "low_throughput" if received < few else "drained"
    paths = tuple(f"{landing}/{label}" for label, (n, bad) in counts.items() if n > bad)
    return IngestResult(received, received - rejected, rejected, paths, reason or stopped)


def _with_status(spark: SparkSession, path: str | Sequence[str], status: str) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*(f"{p}/status={status}" for p in paths))


def accepted(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Messages of landed folders whose body is JSON."""
    return _with_status(spark, path, ACCEPTED)


def rejected(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Messages of landed folders that were set aside, bodies as received."""
    return _with_status(spark, path, REJECTED)


def load_unread(
    spark: SparkSession,
    ledger_path: str,
    queue: str,
    env: str,
    table: str,
    location: str,
    body_schema: T.StructType,
    at: datetime,
    envelope: Sequence[str] = ENVELOPE_COLUMNS,
    max_folders: int = FOLDERS_PER_LOAD,
) -> list[str]:
    """Flatten every unread landing folder into the bronze table, then mark them read.

    ``max_folders`` at a time are one scan, one write and one mark, so a crash after weeks
    without a load costs one such group. A folder is one partition of the table and
    is replaced when loaded again, so a crash before the mark leaves no duplicates; one that
    compaction has folded meanwhile is in the table and only marked. At the end the
    queue's ledger is folded. Returns the folders loaded.
    """
    loaded: list[str] = []
    while True:
        entries = ledger_entries(read_ledger(spark, ledger_path), queue, env)
        paths = [row.path for row in unread_paths(entries).orderBy("path").limit(max_folders).collect()]
        if not paths:
            break
        _load_folders(spark, paths, table, location, body_schema, envelope)
        append_paths(spark, ledger_path, queue, env, paths, True, at)
        loaded += paths
    fold_ledger(spark, ledger_path, queue, env)
    return loaded


def _load_folders(
    spark: SparkSession, paths: list[str], table: str, location: str, body_schema: T.StructType, envelope: Sequence[str]
) -> None:
    # the folder's own name is the last but two part of .../<batch>/status=accepted/<file>
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    finish_folds(spark, table)
    labels = spark.createDataFrame([(p, p.rstrip("/").rpartition("/")[2]) for p in paths], f"path string, {LOAD_BATCH} string")
    waiting = sorted(row.path for row in not_folded(spark, table, labels, LOAD_BATCH).select("path").collect())
    if waiting:
        landed = accepted(spark, waiting).withColumn(LOAD_BATCH, folder)
        rows = flatten_body(landed, body_schema, envelope=[*envelope, LOAD_BATCH])
        create_table_if_absent(spark, table, rows.schema, location, [LOAD_BATCH])
        replace_partitions(spark, table, rows)
