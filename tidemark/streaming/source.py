"""A live subscription per slot as a streaming source, and single answers as a batch source, on Spark's Python data source API.

The engine brings no network client. A deployment provides a module of transport functions, named by the option ``transport``
(``module``, or ``module:function`` for another name of ``poll``); addresses and credentials are the transport's and reach it as options.

* ``poll(slot, after, timeout, options)``: an iterable of (position, payload bytes) after a position, in order;
* ``head(slot, timeout, options)``: the last position of a slot, -1 if there is none yet;
* ``answer(request, timeout, options)``: the JSON text of the answer to a request, or None.

Each slot and each request is a partition, read on an executor. A call that fails with a connection error is made again, from the last
position on; one that takes longer than ``timeoutSeconds`` is an error whatever the transport does about it.
"""

import importlib
import queue
import threading
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "slot int, arrival_seq bigint, payload binary"
ANSWERS = "request string, answer string"
READ_AHEAD = 1_000


def slots_of(text: str) -> list[int]:
    """Distinct slots of a comma-separated list, each from 0 to 255."""
    slots = [int(s) for s in text.split(",")]
    if len(set(slots)) < len(slots) or not all(0 <= s <= 255 for s in slots):
        raise ValueError("slots must be distinct numbers from 0 to 255")
    return slots


class Transport:
    """The functions of a transport module, with deadline and retries."""

    def __init__(self, options: dict[str, str]):
        module, _, self.poll_name = options["transport"].partition(":")
        self.module, self.options = module, dict(options)
        self.timeout = float(options.get("timeoutSeconds", "10"))
        self.retries, self.pause = int(options.get("retries", "3")), float(options.get("retrySeconds", "0.2"))
        if self.timeout < 1:
            raise ValueError("timeoutSeconds must be at least 1")

    def _function(self, name: str):
        return getattr(importlib.import_module(self.module), name)

    def _again(self, call):
        for left in range(self.retries, -1, -1):
            try:
                return call()
            except (ConnectionError, EOFError):
                if not left:
                    raise
                time.sleep(self.pause)

    def bounded(self, call):
        """The result of a call, or TimeoutError after the deadline; a call that hangs is left to its own thread."""
        box: list = []

        def run() -> None:
            try:
                box.append((call(), None))
            except BaseException as e:  # noqa: BLE001 - it is raised again where the caller waits
                box.append((None, e))

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        thread.join(self.timeout)
        if not box:
            raise TimeoutError(f"no answer within {self.timeout} s")
        value, error = box[0]
        if error is not None:
            raise error
        return value

    def head(self, slot: int) -> int:
        return self._again(lambda: self.bounded(lambda: int(self._function("head")(slot, self.timeout, self.options))))

    def answer(self, request: str) -> str | None:
        return self._again(lambda: self.bounded(lambda: self._function("answer")(request, self.timeout, self.options)))

    def _steps(self, slot: int, after: int) -> Iterator[tuple[int, bytes]]:
        """What the transport's poll gives, read ahead by a thread of its own; TimeoutError if a step takes too long."""
        box: queue.Queue = queue.Queue(READ_AHEAD)
        over = threading.Event()

        def put(item) -> bool:
            while not over.is_set():
                try:
                    box.put(item, timeout=0.2)
                    return True
                except queue.Full:
                    continue
            return False

        def run() -> None:
            try:
                for step in self._function(self.poll_name or "poll")(slot, after, self.timeout, self.options):
                    if not put(step):
                        return
                put(None)
            except BaseException as e:  # noqa: BLE001 - it is raised again where the steps are read
                put(e)

        threading.Thread(target=run, daemon=True).start()
        try:
            while True:
                try:
                    step = box.get(timeout=self.timeout)
                except queue.Empty:
                    raise TimeoutError(f"no payload within {self.timeout} s") from None
                if step is None:
                    return
                if isinstance(step, BaseException):
                    raise step
                yield step
        finally:
            over.set()

    def poll(self, slot: int, after: int, last: int) -> Iterator[tuple[int, int, bytes]]:
        """(slot, position, payload) after ``after`` up to ``last``; the stream has no deadline, but each of its steps has."""
        at, left = after, self.retries
        while at < last:
            try:
                for position, payload in self._steps(slot, at):
                    if position > last:
                        return
                    if position > at:
                        at = position
                        yield slot, position, payload
                return
            except (ConnectionError, EOFError):
                if not left:
                    raise
                left -= 1
                time.sleep(self.pause)


class SlotPart(InputPartition):
    def __init__(self, slot: int, after: int, last: int):
        self.slot, self.after, self.last = slot, after, last


class SlotStreamReader(DataSourceStreamReader):
    """The offset is the last position of each slot, so a restart leaves no gap. Only positions come to the driver."""

    def __init__(self, options: dict[str, str]):
        self.transport = Transport(options)
        self.slots = slots_of(options["slots"])

    def initialOffset(self) -> dict:
        return {str(s): -1 for s in self.slots}

    def latestOffset(self) -> dict:
        return {str(s): self.transport.head(s) for s in self.slots}

    def partitions(self, start: dict, end: dict) -> list[SlotPart]:
        return [SlotPart(s, start.get(str(s), -1), end[str(s)]) for s in self.slots if end[str(s)] > start.get(str(s), -1)]

    def read(self, partition: SlotPart) -> Iterator[tuple]:
        return self.transport.poll(partition.slot, partition.after, partition.last)


class SlotStream(DataSource):
    """``spark.readStream.format("slot_stream").option("transport", "module").option("slots", "9,98")``"""

    @classmethod
    def name(cls) -> str:
        return "slot_stream"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SlotStreamReader:
        return SlotStreamReader(self.options)


class RequestPart(InputPartition):
    def __init__(self, request: str):
        self.request = request


class AnswerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.transport = Transport(options)
        self.requests = [r for r in options["requests"].split(",") if r]

    def partitions(self) -> list[RequestPart]:
        return [RequestPart(r) for r in self.requests]

    def read(self, partition: RequestPart) -> Iterator[tuple]:
        yield partition.request, self.transport.answer(partition.request)


class Answers(DataSource):
    """``spark.read.format("answers").option("transport", "module").option("requests", "chain_info,chain_tip,ctip/9")``: one row per request."""

    @classmethod
    def name(cls) -> str:
        return "answers"

    def schema(self) -> str:
        return ANSWERS

    def reader(self, schema) -> AnswerReader:
        return AnswerReader(self.options)


def register(spark) -> None:
    """Make both known to a session."""
    spark.dataSource.register(SlotStream)
    spark.dataSource.register(Answers)
