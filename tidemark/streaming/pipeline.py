"""The feed as Structured Streaming: the same column plans as in batch, and what needs state.

Delivery order inside a micro-batch is not Spark's to keep, so every row carries ``arrival_seq`` and stateful steps sort by it.
"""

import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import adapter, canonical_json, summary
from tidemark.sources import protobuf

PAYLOADS = "arrival_seq bigint, arrival_ts timestamp, payload binary"


def feed_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 16, pattern: str = "*.parquet") -> DataFrame:
    """Feed files of a folder as they come; ``files_per_batch`` holds back a source that is faster than the query."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).parquet(folder)


def normalized(feed: DataFrame, mode: str = "permissive") -> DataFrame:
    """``feed`` with ``event`` and ``error``; with mode ``failfast`` the first bad row ends the query."""
    return adapter.feed_events(feed, mode)


def rendered(events: DataFrame, full: bool = False) -> DataFrame:
    """``events`` (event, and error if there is one) as kind, summary and reason of rejection, with the full JSON if asked for."""
    e = F.col("event")
    before = F.col("error") if "error" in events.columns else F.lit(None).cast("string")
    out = events.withColumn("rejected", F.coalesce(before, summary.validation_error(e))).withColumns({"event_kind": summary.kind_of(e), "summary": summary.summary(e)})
    return out.withColumn("full_json", canonical_json.full_json(e)) if full else out


def consume(payloads: DataFrame, full: bool = False) -> DataFrame:
    """Wire payloads as a consumer sees them: undecodable and rejected ones are rows with a reason, and the stream goes on."""
    told = protobuf.decode(payloads).withColumnRenamed("decode_error", "error")
    return rendered(told, full)


def once_per_key(events: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First of each key within ``delay``: bounded state, for messages that repeat soon. Event times must be timestamps."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def without_consecutive_repeats(blocks: DataFrame, keys: list[str], columns: str, delay_ms: int | None = None) -> DataFrame:
    """Connect and disconnect messages without those that repeat the last one of their key.

    ``blocks`` has ``keys``, kind, arrival_seq and the other fields of ``columns`` (a DDL string of what comes out). The state is
    one kind per key; with ``delay_ms`` it is dropped after that time without a message (Spark then keeps running empty batches).
    A batch's rows of one key meet in one task.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("arrival_seq", kind="stable")
        before = [last, *rows["kind"].iloc[:-1]]
        state.update((rows["kind"].iloc[-1],))
        if delay_ms is not None:
            state.setTimeoutDuration(delay_ms)
        yield rows[[k != b for k, b in zip(rows["kind"], before)]]

    return blocks.groupBy(*keys).applyInPandasWithState(step, columns, "kind string", "append", "NoTimeout" if delay_ms is None else "ProcessingTimeTimeout")


def counts_by_window(events: DataFrame, event_time: str, delay: str, width: str) -> DataFrame:
    """Messages and rejected ones per kind and time window; late ones beyond ``delay`` are not counted."""
    told = events.withWatermark(event_time, delay).groupBy(F.window(event_time, width), "event_kind")
    return told.agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("rejected").isNotNull()).alias("rejected"))


def snapshot_then_live(spark: SparkSession, snapshot: Callable[[], DataFrame], live: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start the stream, take the snapshot, and hand both to ``sink``: the stream's place is fixed before the snapshot is read.

    The snapshot goes to ``sink`` as batch -1 right away, whether or not anything live comes; live batches wait for it. What happens between the two is
    told twice rather than not at all. A snapshot that cannot be taken or handed over stops the stream and is raised. The stream resumes from
    its checkpoint after a failure.
    """
    told, lost = threading.Event(), threading.Event()

    def forward(batch: DataFrame, number: int) -> None:
        told.wait()
        if lost.is_set():
            raise RuntimeError("there is no snapshot")
        sink(batch, number)

    query = live.writeStream.foreachBatch(forward).option("checkpointLocation", checkpoint).start()
    try:
        sink(snapshot(), -1)
    except BaseException:
        lost.set()
        told.set()
        query.stop()
        raise
    told.set()
    return query


def publish(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each event's wire bytes to a folder of any file system that Spark knows; a batch is there as a whole or not at all."""
    return protobuf.encode(events).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()


def flush(query: StreamingQuery, seconds: float) -> None:
    """Wait until all that has come so far is written; TimeoutError if that takes longer, the query's own error if it fails."""
    failed: list[BaseException] = []

    def wait() -> None:
        try:
            query.processAllAvailable()
        except BaseException as e:  # noqa: BLE001 - it is raised again below
            failed.append(e)

    thread = threading.Thread(target=wait, daemon=True)
    thread.start()
    thread.join(seconds)
    if thread.is_alive():
        raise TimeoutError(f"not flushed within {seconds} s")
    if failed:
        raise failed[0]


def supervise(spark: SparkSession, queries: list[StreamingQuery], seconds: float | None = None) -> None:
    """Wait until one of the queries ends, or for some seconds; then all are stopped. A failure is raised, and an ended live stream is one as well."""
    end = None if seconds is None else time.monotonic() + seconds
    try:
        while all(q.isActive for q in queries) and (end is None or time.monotonic() < end):
            time.sleep(0.2)
        failed = [q.exception() for q in queries if q.exception()]
        if failed:
            raise failed[0]
        if any(not q.isActive for q in queries):
            raise RuntimeError("a live stream ended")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        spark.streams.resetTerminated()
