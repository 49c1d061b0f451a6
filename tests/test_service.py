import json
import logging
import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import filled
from tidemark.plans.snapshot import snapshot_events, tip_hash
from tidemark.sources import schema
from tidemark.streaming import pipeline, source
from tidemark.streaming.service import LogListener, Settings, at_level, log_level, log_lines, run_until_shutdown, start


def test_settings(tmp_path):
    (tmp_path / "p").write_text("secret \r\n\n")
    assert Settings((9, 98), user="u", password_file=str(tmp_path / "p")).password() == "secret "
    assert Settings().password() is None
    for bad in ({"slots": (9, 9)}, {"slots": (256,)}, {"flush_timeout": 0}, {"shutdown_timeout": 10}, {"user": "u"}, {"password_file": "p"}):
        with pytest.raises(ValueError):
            Settings(**bad)


class Fake:
    """A stream that stops when it is told to, or ends by itself."""

    def __init__(self, ends=False, error=None, stuck=False):
        self.isActive, self.error, self.stuck = not ends, error, stuck

    def exception(self):
        return self.error

    def processAllAvailable(self):
        self.flushed = True

    def stop(self):
        if self.stuck:
            threading.Event().wait(5)
        self.isActive = False


def test_shutdown():
    stop = threading.Event()
    stop.set()
    streams = [Fake(), Fake()]
    run_until_shutdown(streams, Settings(), stop)
    assert not any(s.isActive for s in streams) and all(s.flushed for s in streams)
    other = Fake()
    with pytest.raises(RuntimeError, match="ended"):
        run_until_shutdown([other, Fake(ends=True)], Settings())
    assert not other.isActive
    with pytest.raises(ValueError, match="broken"):
        run_until_shutdown([Fake(ends=True, error=ValueError("broken"))], Settings())
    with pytest.raises(TimeoutError):
        run_until_shutdown([Fake(stuck=True)], Settings(flush_timeout=1, shutdown_timeout=2), stop)


def parts(spark, error=None):
    head = {"hash": b"\x01" * 32, "previous_hash": b"\x00" * 32, "chain_work": b"\x00" * 32, "height": 1, "timestamp": 1}
    values = {"chain_info": {"network": 3}, "chain_tip": {"header": head}, "sidechain_proposals": {"proposals": []}, "active_sidechains": {"sidechains": []}}
    ddl = f"slot bigint, event {schema.EVENT}, error string"
    out = {k: filled(spark, ddl, [(None, {"timestamp": 1, "enforcer": {k: v}}, error if k == "chain_tip" else None)]) for k, v in values.items()}
    out["ctip"] = filled(spark, ddl, [(s, {"timestamp": 1, "enforcer": {"ctip": {"sidechain_number": s}}}, None) for s in (9, 98, 7)])
    return out


def test_snapshot(spark):
    rows = snapshot_events(parts(spark), [98, 9]).select("seq", F.col("event.enforcer.ctip.sidechain_number").alias("s")).orderBy("seq").collect()
    assert [tuple(r) for r in rows] == [(0, None), (1, None), (2, None), (3, None), (4, 98), (5, 9)]
    assert bytes(tip_hash(parts(spark)["chain_tip"]).first()[0]) == b"\x01" * 32
    with pytest.raises(PySparkException, match="chain_tip: no header"):
        snapshot_events(parts(spark, "no header"), [9]).collect()
    with pytest.raises(ValueError):
        snapshot_events({}, [9])


def test_log_lines(spark):
    df = spark.createDataFrame([(None, "ctip", "sidechain=9 present=false", "{}", None), ('bad "x"', None, None, None, 2)], "rejected string, event_kind string, summary string, full_json string, payload_len bigint")
    assert sorted(r[0] for r in log_lines(df, True).collect()) == ["INFO event={}", "INFO kind=ctip sidechain=9 present=false", 'WARN rejected reason={"reason":"bad \\"x\\""} payload_len=2']
    assert log_lines(df).count() == 2


def test_log_level(spark, monkeypatch):
    monkeypatch.delenv("TIDEMARK_LOG", raising=False)
    assert log_level() == "INFO" and log_level("warn") == "WARN"
    monkeypatch.setenv("TIDEMARK_LOG", "error")
    assert log_level() == "ERROR"
    monkeypatch.setenv("TIDEMARK_LOG", "loud")
    with pytest.raises(ValueError):
        log_level()
    lines = spark.createDataFrame([("INFO a",), ("WARN b",), ("ERROR c",), ("DEBUG d",)], "line string")
    assert [sorted(r[0][-1] for r in at_level(lines, v).collect()) for v in ("ERROR", "WARN", "INFO")] == [["c"], ["b", "c"], ["a", "b", "c"]]


def test_flush_is_bounded():
    class Stuck:
        def processAllAvailable(self):
            time.sleep(5)

    began = time.monotonic()
    with pytest.raises(TimeoutError):
        pipeline.flush(Stuck(), 0.2)
    assert time.monotonic() - began < 3


class Progress:
    id, batchId, numInputRows, exception = "x", 3, 7, None

    @property
    def progress(self):
        return self


def test_listener(caplog):
    listener = LogListener()
    with caplog.at_level(logging.INFO, "tidemark"):
        listener.onQueryStarted(Progress())
        listener.onQueryProgress(Progress())
        listener.onQueryIdle(Progress())
        listener.onQueryTerminated(Progress())
        failed = Progress()
        failed.exception = "broken"
        listener.onQueryTerminated(failed)
    assert [(r.levelname, r.getMessage()) for r in caplog.records] == [("INFO", "stream x started"), ("INFO", "stream x batch=3 rows=7"), ("INFO", "stream x ended "), ("ERROR", "stream x ended broken")]


def told_answers(folder):
    head = {"block_hash": "ab" * 32, "prev_block_hash": "cd" * 32, "work": "00" * 32, "height": 5}
    answers = {"chain_info": {"network": 2, "bip300_constants": {"activation_height": 3}}, "chain_tip": {"block_header_info": head}, "sidechain_proposals": [], "active_sidechains": [], "ctip_9": {"txid": "ee" * 32, "vout": 1, "value": 2, "sequence_number": 3}}
    for name, value in answers.items():
        (folder / f"{name}.json").write_text(json.dumps(value))


def test_service_tells_the_snapshot_without_live_data(spark, tmp_path):
    told_answers(tmp_path)
    lines = []
    query = start(spark, Settings((9, 98), options={"inbox": str(tmp_path)}), "tests.transport", lambda df, n: lines.append((n, sorted(r[0] for r in df.collect()))), str(tmp_path / "check"))
    try:
        assert lines[0][0] == -1 and len(lines[0][1]) == 6
        assert "INFO kind=ctip sidechain=98 present=false" in lines[0][1] and f"INFO kind=chain_tip height=5 block_hash={'ab' * 32}" in lines[0][1]
        (tmp_path / "9-0").write_bytes(b"\xff\x00")
        pipeline.flush(query, 60)
        assert lines[-1][0] >= 0 and lines[-1][1][0].startswith("WARN rejected")
    finally:
        query.stop()


def test_snapshot_that_fails_stops_the_stream(spark, tmp_path):
    told_answers(tmp_path)
    (tmp_path / "chain_tip.json").write_text("{}")
    with pytest.raises(PySparkException, match="chain_tip"):
        start(spark, Settings((9,), options={"inbox": str(tmp_path)}), "tests.transport", lambda df, n: df.collect(), str(tmp_path / "check"))
    assert not spark.streams.active


def test_supervise(spark, tmp_path):
    source.register(spark)
    live = spark.readStream.format("rate").load()
    good = live.writeStream.format("noop").start()
    bad = live.select(F.raise_error(F.lit("broken"))).writeStream.format("noop").start()
    with pytest.raises(PySparkException, match="broken"):
        pipeline.supervise(spark, [good, bad], 60)
    assert not good.isActive
    one, two = (live.writeStream.format("noop").start() for _ in range(2))
    one.stop()
    with pytest.raises(RuntimeError, match="ended"):
        pipeline.supervise(spark, [one, two], 60)
    assert not two.isActive
