"""Running streams as a service: settings, log lines, stopping."""

import logging
import os
import signal
import threading
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.plans import answers
from tidemark.plans import snapshot as plan
from tidemark.streaming import pipeline, source

log = logging.getLogger("tidemark")


@dataclass(frozen=True)
class Settings:
    """Settings of a service, checked when made. Times are in seconds and at least 1."""

    slots: tuple[int, ...] = ()
    flush_timeout: int = 10
    request_timeout: int = 10
    shutdown_timeout: int = 15
    user: str | None = None
    password_file: str | None = None
    full_events: bool = False
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if len(set(self.slots)) < len(self.slots) or not all(0 <= s <= 255 for s in self.slots):
            raise ValueError("slots must be distinct numbers from 0 to 255")
        if min(self.flush_timeout, self.request_timeout, self.shutdown_timeout) < 1:
            raise ValueError("timeouts must be at least 1 second")
        if self.shutdown_timeout <= self.flush_timeout:
            raise ValueError("the shutdown timeout must exceed the flush timeout")
        if (self.user is None) != (self.password_file is None):
            raise ValueError("user and password file go together")

    def source_options(self, transport: str) -> dict[str, str]:
        """Options of the sources: what the transport needs to connect, and the deadline of a request."""
        out = {**self.options, "transport": transport, "slots": ",".join(map(str, self.slots)), "timeoutSeconds": str(self.request_timeout)}
        return out if self.user is None else out | {"user": self.user, "password": self.password()}

    def password(self) -> str | None:
        """The password without trailing line breaks."""
        return None if self.password_file is None else Path(self.password_file).read_text().rstrip("\r\n")


LEVELS = ("ERROR", "WARN", "INFO", "DEBUG")


def log_level(default: str = "INFO", environment: str = "TIDEMARK_LOG") -> str:
    """The level that the environment asks for, else the default; ValueError if it is none."""
    level = os.environ.get(environment) or default
    if level.upper() not in LEVELS:
        raise ValueError(f"unknown log level {level}")
    return level.upper()


def at_level(lines: DataFrame, level: str, line: str = "line") -> DataFrame:
    """The lines of a level and of all more urgent ones, by the word they begin with."""
    return lines.where(F.substring_index(line, " ", 1).isin(*LEVELS[: LEVELS.index(level) + 1]))


def log_lines(rendered: DataFrame, full: bool = False) -> DataFrame:
    """One line per event, and a second one with its JSON if ``full``; rejected ones as a warning with their reason and length.

    ``rendered``: rows of ``pipeline.rendered`` or ``pipeline.consume``, the latter with payload_len.
    """
    size = F.col("payload_len").cast("string") if "payload_len" in rendered.columns else F.lit(None).cast("string")
    bad = F.concat(F.lit("WARN rejected reason="), F.to_json(F.struct(F.col("rejected").alias("reason"))), F.coalesce(F.concat(F.lit(" payload_len="), size), F.lit("")))
    good = F.concat(F.lit("INFO kind="), F.col("event_kind"), F.lit(" "), F.col("summary"))
    lines = [F.when(F.col("rejected").isNotNull(), bad).otherwise(good)]
    if full:
        lines.append(F.when(F.col("rejected").isNull(), F.concat(F.lit("INFO event="), F.col("full_json"))))
    return rendered.select(F.explode(F.array_compact(F.array(*lines))).alias("line"))


def start(spark: SparkSession, settings: Settings, transport: str, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """A service that reads all slots of ``settings`` and hands log lines of the startup snapshot (batch -1) and of each live batch to ``write``.

    Live payloads are those of the transport; with ``full_events`` each line is followed by its JSON. Lines have the level of ``log_level``.
    """
    source.register(spark)
    options, level = settings.source_options(transport), log_level()
    live = spark.readStream.format("slot_stream").options(**options).load()

    def snapshot() -> DataFrame:
        told = answers.snapshot_parts(answers.fetch(spark, options, answers.requests(list(settings.slots))))
        return plan.snapshot_events(told, list(settings.slots)).withColumnRenamed("seq", "arrival_seq")

    def sink(batch: DataFrame, number: int) -> None:
        rows = pipeline.rendered(batch, settings.full_events) if number < 0 else pipeline.consume(batch, settings.full_events)
        write(at_level(log_lines(rows, settings.full_events), level), number)

    return pipeline.snapshot_then_live(spark, snapshot, live, sink, checkpoint)


class LogListener(StreamingQueryListener):
    """Progress and ends of streams as log lines."""

    def onQueryStarted(self, event) -> None:
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info("stream %s batch=%s rows=%s", p.id, p.batchId, p.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.log(logging.ERROR if event.exception else logging.INFO, "stream %s ended %s", event.id, event.exception or "")


def run_until_shutdown(queries: list[StreamingQuery], settings: Settings, stop: threading.Event | None = None, signals: tuple[int, ...] = (signal.SIGINT, signal.SIGTERM)) -> None:
    """Run until a signal comes (or ``stop`` is set), then flush all streams, each within the flush timeout, and stop them within the shutdown timeout.

    A second signal, or streams that don't stop in time, raise. So does a stream that fails or ends by itself; the others are stopped.
    """
    stop = stop or threading.Event()
    hard = threading.Event()

    def on_signal(number, frame) -> None:
        (hard if stop.is_set() else stop).set()

    before = {s: signal.signal(s, on_signal) for s in signals} if threading.current_thread() is threading.main_thread() else {}
    try:
        while not stop.wait(0.2):
            ended = [q for q in queries if not q.isActive]
            if ended:
                raise ended[0].exception() or RuntimeError("a live stream ended")
        for q in queries:
            pipeline.flush(q, settings.flush_timeout)
    finally:
        stoppers = [threading.Thread(target=q.stop, daemon=True) for q in queries if q.isActive]
        for t in stoppers:
            t.start()
        left = settings.shutdown_timeout
        while any(t.is_alive() for t in stoppers) and left > 0 and not hard.is_set():
            hard.wait(0.1)
            left -= 0.1
        for s, handler in before.items():
            signal.signal(s, handler)
        if any(t.is_alive() for t in stoppers):
            raise TimeoutError("streams did not stop in time")
