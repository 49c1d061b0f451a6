import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.transport import broken
from tidemark.plans import adapter
from tidemark.queries import monitor
from tidemark.sources import protobuf
from tidemark.streaming import pipeline, source


def drained(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def to_memory(df, name, mode="append"):
    drained(df.writeStream.format("memory").queryName(name).outputMode(mode).start())


@pytest.fixture
def feed(spark, data, tmp_path):
    """The feed as five files that come one after the other."""
    df = adapter.read(spark, data, "enforcer_feed")
    for i, part in enumerate(df.randomSplit([1.0] * 5, 3)):
        part.coalesce(1).write.parquet(f"{tmp_path}/feed/{i}")
    return df, pipeline.feed_stream(spark, f"{tmp_path}/feed/*", df.schema, 1)


def test_stream_equals_batch(spark, data, feed):
    to_memory(pipeline.rendered(pipeline.normalized(feed[1])).where("rejected is null").select("arrival_seq", "summary"), "told")
    batch = monitor.render_summary(spark, data).select("arrival_seq", "summary")
    assert sorted(map(tuple, spark.table("told").collect())) == sorted(map(tuple, batch.collect()))


def test_failfast_ends_the_query(feed):
    with pytest.raises(PySparkException):
        drained(pipeline.normalized(feed[1], "failfast").select("arrival_seq", "event").writeStream.format("noop").start())


def test_bad_payload_does_not_end_the_stream(spark, tmp_path):
    good = protobuf.encoder()({"timestamp": 5, "enforcer": {"ctip": {"sidechain_number": 9, "ctip": None}}})
    no_kind = protobuf.encoder()({"timestamp": 5, "enforcer": {}})
    df = spark.createDataFrame([(1, None, b"\xff\x00"), (2, None, no_kind), (3, None, good)], pipeline.PAYLOADS)
    df.write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    to_memory(pipeline.consume(live, True).select("arrival_seq", "rejected", "summary", "full_json"), "consumed")
    rows = {r["arrival_seq"]: r for r in spark.table("consumed").collect()}
    assert rows[1]["rejected"].startswith("invalid payload") and rows[2]["rejected"] == "enforcer event has no kind"
    assert rows[3]["rejected"] is None and rows[3]["summary"] == "sidechain=9 present=false" and '"ctip":null' in rows[3]["full_json"]


def test_consecutive_repeats(spark, tmp_path):
    schema = "slot bigint, hash string, kind string, arrival_seq bigint"
    batches = [[(1, "a", "on", 2), (1, "a", "on", 1), (1, "b", "on", 3)], [(1, "a", "on", 4), (1, "a", "off", 5), (2, "a", "on", 6)], [(1, "a", "on", 8), (1, "a", "off", 7)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{tmp_path}/in/*")
    runs = pipeline.without_consecutive_repeats(live, ["slot", "hash"], schema)
    query = runs.writeStream.format("memory").queryName("runs").trigger(availableNow=True).start()  # a timeout keeps batches coming
    assert query.awaitTermination(60)
    assert sorted(r["arrival_seq"] for r in spark.table("runs").collect()) == [1, 3, 5, 6, 8]


def test_once_per_key_and_windows(spark, tmp_path):
    rows = [(1, "a", "2025-01-01 00:00:01"), (2, "a", "2025-01-01 00:00:02"), (3, "b", "2025-01-01 00:03:00")]
    df = spark.createDataFrame(rows, "seq bigint, event_kind string, at string").select("seq", "event_kind", F.to_timestamp("at").alias("at"), F.lit(None).cast("string").alias("rejected"))
    df.write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    to_memory(pipeline.once_per_key(live, ["event_kind"], "at", "1 hour"), "once")
    assert spark.table("once").count() == 2
    to_memory(pipeline.counts_by_window(live, "at", "1 minute", "1 minute"), "windows", "complete")
    assert sorted((r["event_kind"], r["messages"], r["rejected"]) for r in spark.table("windows").collect()) == [("a", 2, 0), ("b", 1, 0)]


def test_snapshot_comes_first(spark, feed, tmp_path):
    seen = []
    snapshot = lambda: spark.createDataFrame([("tip",)], "kind string")
    query = pipeline.snapshot_then_live(spark, snapshot, feed[1].select("arrival_seq"), lambda df, n: seen.append((n, df.count())), f"{tmp_path}/check")
    drained(query)
    assert seen[0] == (-1, 1) and [n for n, _ in seen[1:]] == list(range(len(seen) - 1)) and sum(c for _, c in seen[1:]) == feed[0].count()


def slots(spark, inbox, which="9,98", transport="tests.transport", **options):
    source.register(spark)
    return spark.readStream.format("slot_stream").option("transport", transport).option("slots", which).option("inbox", str(inbox)).options(**options).load()


def test_source(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name in ("9-0", "9-1", "98-0", "7-0"):
        (inbox / name).write_bytes(name.encode())
    query = slots(spark, inbox).writeStream.format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    (inbox / "9-2").write_bytes(b"9-2")
    query.processAllAvailable()
    query.stop()
    assert sorted(bytes(r["payload"]) for r in spark.table("live").collect()) == [b"9-0", b"9-1", b"9-2", b"98-0"]


def test_published_once_over_a_restart(spark, tmp_path):
    """What comes while the service is down is told after it, and nothing twice."""
    inbox, out, check = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "c")
    inbox.mkdir()
    for i in range(6):
        (inbox / f"9-{i}").write_bytes(protobuf.encoder()({"timestamp": i, "enforcer": {"ctip": {"sidechain_number": 9, "ctip": None}}}))
        if i % 3 == 2:
            events = protobuf.decode(slots(spark, inbox, "9")).select("arrival_seq", "event")
            query = pipeline.publish(events, out, check)
            pipeline.flush(query, 120)
            query.stop()
    told = protobuf.decode(spark.read.parquet(out)).select("arrival_seq", F.col("event.timestamp").cast("int").alias("t")).collect()
    assert sorted(map(tuple, told)) == [(i, i) for i in range(6)]


def test_transport_deadline_and_retries(tmp_path):
    for i in range(3):
        (tmp_path / f"9-{i}").write_bytes(b"%d" % i)
    options = {"slots": "9", "inbox": str(tmp_path), "timeoutSeconds": "1", "retrySeconds": "0"}
    reader = source.SlotStreamReader({**options, "transport": "tests.transport:unsteady"})
    assert reader.latestOffset() == {"9": 2}
    broken["left"] = 2
    (part,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [p for _, p, _ in reader.read(part)] == [0, 1, 2]
    broken["left"] = 9
    with pytest.raises(ConnectionError):
        list(source.SlotStreamReader({**options, "transport": "tests.transport:unsteady", "retries": "1"}).read(part))
    broken["left"] = 0
    with pytest.raises(TimeoutError):
        list(source.SlotStreamReader({**options, "transport": "tests.transport:slow"}).read(part))
    assert reader.partitions({"9": 2}, {"9": 2}) == []


def test_options():
    for bad in ("9,9", "256", "x"):
        with pytest.raises(ValueError):
            source.SlotStreamReader({"transport": "tests.transport", "slots": bad})
    with pytest.raises(ValueError):
        source.SlotStreamReader({"transport": "tests.transport", "slots": "9", "timeoutSeconds": "0"})
