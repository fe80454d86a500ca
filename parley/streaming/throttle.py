"""Rate limit, retries and dead letters for calls to an endpoint, as a stream.

Chunk listings are read as a stream and wait in keyed state for their turn;
only names wait there, never payloads.  A micro-batch releases what the
limit allows, reads the payloads of those chunks from the files they are in,
calls the endpoint, and stores every answer under the batch's number.  An
answer that may be better later (``retry``) comes back as an input of the
stream, due after a back-off that doubles with each attempt; after the last
attempt it is a dead letter.  So every chunk ends in exactly one result row.

The limit is strict.  Calls of a batch happen between its start and the
start of the next one, and count until a whole window after that.  A query
that is started again cannot know what its last batch had sent, so every
lane first waits for a whole window.  The calls of a task that is lost and
run again within a batch are the one thing that is not counted:
``SendLimits.calls`` should leave room for a task's share.

The limit is split evenly over ``lanes``, which are the keys of the state,
so an endpoint's waiting chunks spread over tasks.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (StatefulProcessor, StatefulProcessorHandle,
                                                      TimerValues)

from parley import config
from parley.config import SizeLimits
from parley.operators import inference

WAITING = "chunk_key string, file string, attempt int, due bigint"
RELEASED = T.StructType([
    T.StructField("lane", T.IntegerType()), T.StructField("chunk_key", T.StringType()),
    T.StructField("file", T.StringType()), T.StructField("attempt", T.IntegerType()),
    T.StructField("released_ms", T.LongType())])
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRIED_STATUSES = (inference.STATUS_EXCEPTION, 408, 425, 429, 500, 502, 503, 504)


@dataclass(frozen=True)
class SendLimits:
    """At most ``calls`` in any ``window_ms``; ``attempts`` per chunk, the second one
    ``backoff_ms`` after the first, each later one after twice the time before."""

    calls: int = config.RATE_LIMIT_CALLS_PER_MINUTE
    window_ms: int = 60_000
    lanes: int = 16
    attempts: int = 5
    backoff_ms: int = 2_000
    backoff_most_ms: int = 600_000

    def __post_init__(self):
        if not 0 < self.lanes <= self.calls or self.attempts < 1 or self.window_ms < 1:
            raise ValueError("needs at least one attempt, and one call for each lane")

    def quota(self, lane: int) -> int:
        return self.calls // self.lanes + (lane < self.calls % self.lanes)


class Lane(StatefulProcessor):
    """The waiting chunks of one lane: a queue, those due later, and the calls that still count.

    ``run`` is another text whenever the query is started.
    """

    def __init__(self, limits: SendLimits, poll_ms: int, run: str):
        self.limits, self.poll_ms, self.run = limits, poll_ms, run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getMapState("queue", "n bigint", WAITING)
        self.later = handle.getMapState("later", "n bigint", WAITING)
        self.place = handle.getValueState("place", "head bigint, tail bigint, run string")
        self.sent = handle.getListState("sent", "at bigint, until bigint, calls int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        head, tail, run = self.place.get() if self.place.exists() else (0, 0, self.run)
        for r in rows:
            (self.later if r["due"] > now else self.queue).updateValue(
                (tail,), (r["chunk_key"], r["file"], r["attempt"], r["due"]))
            if r["due"] > now and head == tail:
                head += 1                       # the queue stays empty
            tail += 1
        self.place.update((head, tail, run))
        yield from self._release(key[0], now)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._release(key[0], timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass

    def _free(self, lane: int, now: int, restarted: bool) -> tuple[int, list[tuple]]:
        """Calls allowed now, and the entries that still count."""
        quota, kept = self.limits.quota(lane), []
        if restarted:
            kept.append((now, now, quota))
        elif self.sent.exists():
            for at, until, calls in self.sent.get():
                if until < 0 and at < now:
                    until = now                 # its batch ended before this one began
                if until < 0 or until > now - self.limits.window_ms:
                    kept.append((at, until, calls))
        return max(0, quota - sum(calls for _, _, calls in kept)), kept

    def _release(self, lane: int, now: int) -> Iterator[Row]:
        head, tail, run = self.place.get()
        free, kept = self._free(lane, now, run != self.run)
        due = sorted((v[3], k[0], tuple(v)) for k, v in self.later.iterator() if v[3] <= now)
        went = []
        for _, n, entry in due[:free]:
            self.later.removeKey((n,))
            went.append(entry)
        while head < tail and len(went) < free:
            if self.queue.containsKey((head,)):
                went.append(tuple(self.queue.getValue((head,))))
                self.queue.removeKey((head,))
            head += 1
        if went:
            kept.append((now, -1, len(went)))
        if kept:
            self.sent.put(kept)
        else:
            self.sent.clear()
        self.place.update((head, tail, self.run))
        if head < tail or went or any(True for _ in self.later.keys()):
            self.handle.registerTimer(now + self.poll_ms)
        for key, file, attempt, _ in went:
            yield Row(lane=lane, chunk_key=key, file=file, attempt=attempt, released_ms=now)


def released(waiting: DataFrame, limits: SendLimits, poll_ms: int = 1_000) -> DataFrame:
    """A stream of the chunks whose turn it is, from a stream of waiting ones (``WAITING``).

    To be built anew for each start of its query.
    """
    lane = F.pmod(F.xxhash64("chunk_key"), F.lit(limits.lanes)).cast("int")
    return waiting.withColumn("lane", lane).groupBy("lane").transformWithState(
        statefulProcessor=Lane(limits, poll_ms, uuid.uuid4().hex), outputStructType=RELEASED,
        outputMode="Append", timeMode="ProcessingTime")


def key_of(columns: list[str]):
    """A chunk's name: its key columns as JSON text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


@dataclass(frozen=True)
class Folders:
    """Where a throttled job keeps its rows, below one shared folder."""

    root: str

    @property
    def answers(self) -> str:
        """Every attempt, by batch: the request log."""
        return f"{self.root}/answers"

    @property
    def refused(self) -> str:
        return f"{self.root}/refused"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def _backoff(limits: SendLimits):
    wait = F.lit(limits.backoff_ms) * F.pow(F.lit(2.0), F.col("attempt") - 1)
    return F.least(wait, F.lit(limits.backoff_most_ms)).cast("bigint")


def start_sending(spark: SparkSession, chunks: str, schema: T.StructType, keys: list[str], client,
                  folders: Folders, *, send: SendLimits = SendLimits(),
                  limits: SizeLimits = SizeLimits(), retry=RETRIED_STATUSES,
                  retry_if: Callable | None = None, every: str = "1 second",
                  payload_col: str = "payload", concurrency: int = 1) -> StreamingQuery:
    """Send the chunks in the Parquet files at ``chunks`` to ``client``, within the limit.

    ``keys`` name a chunk; they and ``chunk_idx`` are kept with the answers.
    New files may be added while the query runs.  Stored answers have the
    columns of :func:`parley.operators.inference.infer_chunks`, ``attempt``,
    ``released_ms`` and ``final``: true for the one row a chunk ends in.
    ``retry`` lists the statuses worth another attempt; ``retry_if`` may
    instead give a condition over the answer's columns.
    """
    name = key_of(keys)
    new = (spark.readStream.schema(schema).parquet(chunks)
           .select(name.alias("chunk_key"), F.col("_metadata.file_path").alias("file"),
                   F.lit(1).alias("attempt"), F.lit(0).cast("bigint").alias("due")))
    # the folder must exist before it is read as a stream
    spark.createDataFrame([], WAITING).write.mode("ignore").parquet(f"{folders.refused}/none")
    again = spark.readStream.schema(WAITING).parquet(f"{folders.refused}/*")
    tickets = released(new.union(again), send)

    # The batch that the query was stopped in is run again, and releases nothing then,
    # because its lanes wait: what it had stored is replaced, and its chunks stay waiting.
    first = [True]

    def each(batch: DataFrame, number: int) -> None:
        session, out = batch.sparkSession, f"{folders.answers}/batch={number}"
        # Released chunks are at most ``send.calls`` rows; the files they are in no more.
        mine = batch.collect()
        if not mine and not first:
            return
        first.clear()
        files = sorted({r["file"] for r in mine})
        listed = session.createDataFrame(mine, RELEASED).select("chunk_key", "file", "attempt", "released_ms")
        held = (session.read.schema(schema).parquet(*files) if files
                else session.createDataFrame([], schema)).withColumn("chunk_key", name)
        joined = held.join(F.broadcast(listed), "chunk_key")
        answered = inference.infer_chunks(joined, client, payload_col=payload_col, n_col=None,
                                          limits=limits, concurrency=concurrency,
                                          full_errors=True)
        worth = (F.col("status").isin(*retry) if retry_if is None else retry_if)
        tried = worth & F.col("chunk_error").isNotNull() & (F.col("attempt") < send.attempts)
        (answered.withColumn("final", ~F.coalesce(tried, F.lit(False)))
         .withColumn("answered_ms", F.unix_millis(F.current_timestamp()))
         .write.mode("overwrite").parquet(out))
        stored = session.read.parquet(out).where("NOT final")
        # due from when the answers were stored, not from when they were planned
        back = stored.select("chunk_key", "file", (F.col("attempt") + 1).alias("attempt"),
                             (F.lit(int(time.time() * 1000)) + _backoff(send)).alias("due"))
        back.write.mode("overwrite").parquet(f"{folders.refused}/after_{number}")

    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)              # read when the query starts
    try:
        return (tickets.writeStream.foreachBatch(each).trigger(processingTime=every)
                .option("checkpointLocation", folders.checkpoint).start())
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def answers(spark: SparkSession, folders: Folders) -> DataFrame:
    """All attempts so far, with the ``batch`` they were made in."""
    return spark.read.parquet(folders.answers)


def wait_for_all(query: StreamingQuery, spark: SparkSession, folders: Folders, chunks: int,
                 timeout: float | None = None, poll: float = 2.0) -> None:
    """Stop the query when ``chunks`` of them have their final answer."""
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while end is None or time.monotonic() < end:
            if query.exception() is not None:
                raise query.exception()
            if query.lastProgress is not None:
                try:
                    if answers(spark, folders).where("final").count() >= chunks:
                        return
                except Exception as e:          # nothing stored yet
                    if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                        raise
            query.awaitTermination(poll)
        raise TimeoutError(f"{chunks} chunks were not all answered")
    finally:
        query.stop()
