"""The queries of the event contract and of operations over the tables of a folder."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.checks import once
from tidemark.functions.hexes import block_hash
from tidemark.operators import contract, operations, snapshots
from tidemark.plans import adapter, canonical_json, normalize, summary
from tidemark.queries.feed import BLOCKS, messages, read
from tidemark.sources import protobuf

SLOTS = [9, 98]
ANCESTORS = 10
LEAST_HEIGHT = 50_000
SUBJECT = "feed.blocks.2"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return adapter.feed_events(read(spark, folder, "enforcer_feed"))


def normalize_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every delivery, and why it cannot be normalized."""
    return events(spark, folder).select("arrival_seq", "kind", "error")


def render_summary(spark: SparkSession, folder: str) -> DataFrame:
    told = events(spark, folder).where("error is null")
    return told.select("arrival_seq", summary.kind_of(F.col("event")).alias("kind"), once(summary.summary(F.col("event"))).alias("summary")).where("summary is not null")


def render_json(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).where("error is null").select("arrival_seq", canonical_json.full_json(F.col("event")).alias("full_json"))


def payload_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every event written to wire bytes, read again, checked and summarized."""
    wire = protobuf.encode(events(spark, folder).where("error is null").select("arrival_seq", "event"))
    back = protobuf.decode(wire)
    return back.select("arrival_seq", summary.kind_of(F.col("event")).alias("kind"), summary.summary(F.col("event")).alias("summary"))


def decode_permissive(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of which those of unreadable events are broken and those of slot 9 cut by their last byte: what decodes, how long broken ones are, and how much the cut ones lack."""
    wire = protobuf.encode(events(spark, folder).select("arrival_seq", "slot", "event"))
    size = F.octet_length("payload")
    sent = F.coalesce(F.when(F.col("slot") == 9, F.substring("payload", F.lit(1), size - 1)).otherwise(F.col("payload")), F.unhex(F.lit("ff00")))
    told = protobuf.decode(wire.select("arrival_seq", size.cast("bigint").alias("size"), sent.alias("payload")))
    bad = F.col("decode_error").isNotNull()
    return told.select("arrival_seq", (~bad).alias("decoded"), F.when(bad & F.col("size").isNull(), F.col("payload_len")).alias("bad_length"), F.when(bad, F.col("size") - F.col("payload_len")).alias("lacking"))


def observation_ms(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "enforcer_feed").select("arrival_seq", F.unix_millis(F.col("arrival_ts").cast("timestamp")).alias("observed_ms"))


def network_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Any number as the number of a network."""
    return read(spark, folder, "orders").select("o_orderkey", normalize.network(F.length("o_orderpriority") - 6).cast("bigint").alias("network"))


def block_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Deposits and withdrawal bundles of each delivered block."""
    found = read(spark, folder, "enforcer_feed").where("kind = 'block_connected'").select("arrival_seq", "block_connected.events")
    count = lambda field: F.size(F.filter("events", lambda e: e[field].isNotNull())).cast("bigint")
    return found.select("arrival_seq", count("deposit").alias("deposits"), count("withdrawal").alias("withdrawal_bundles"))


def nested_deposit_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Satoshis deposited per slot, summed inside each block first."""
    inside = F.aggregate("block_connected.events", F.lit(0).cast("decimal(38,0)"), lambda a, e: (a + F.coalesce(e["deposit"]["output"]["value_sats"], F.lit(0))).cast("decimal(38,0)"))
    rows = read(spark, folder, "enforcer_feed").where("kind = 'block_connected'").select("deploy_id", F.col("block_connected.sidechain_number").alias("slot"), inside.alias("sats"))
    return rows.groupBy("deploy_id", "slot").agg(F.sum("sats").cast("bigint").alias("deposited"))


def blocks(spark: SparkSession, folder: str, kinds: tuple[str, ...] = BLOCKS) -> DataFrame:
    return messages(spark, folder, kinds).withColumnRenamed("token", "hash")


def dedupe_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    rows = blocks(spark, folder).select("deploy_id", "kind", "slot", "hash", "arrival_seq")
    return contract.dedupe_idempotent(rows, keys=("deploy_id", "kind", "slot", "hash"))


def canonical_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = blocks(spark, folder).select("deploy_id", "slot", "hash", "kind", "height", "arrival_seq")
    return contract.canonical_blocks(rows, keys=("deploy_id", "slot", "hash")).select("deploy_id", "slot", "hash", "height")


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The last snapshot of each deployment."""
    runs = read(spark, folder, "snapshot_runs").withColumn("order", F.struct("snapshot_at", "snapshot_id"))
    return contract.latest_snapshot(runs, ["deploy_id"], "order").select("deploy_id", "snapshot_id", "tip_height", "proposal_count", "sidechain_count", "ctip_count")


def ctip_presence(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each slot holds a CTIP, by the last message about it."""
    rows = read(spark, folder, "enforcer_feed").where("kind = 'ctip'").select("deploy_id", F.col("ctip.sidechain_number").alias("slot"), "arrival_seq", F.col("ctip.ctip").isNotNull().alias("present"), F.col("ctip.ctip.value").cast("bigint").alias("value_sats"))
    return contract.latest_snapshot(rows, ["deploy_id", "slot"]).select("deploy_id", "slot", "present", "value_sats")


def distinct_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return contract.distinct_blocks(blocks(spark, folder, BLOCKS[:1]), ["deploy_id"])


def kind_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """What each kind of message carries: how many there are, of how many slots, and how many carry their payload."""
    feed = read(spark, folder, "enforcer_feed")
    slot = F.coalesce("block_connected.sidechain_number", "block_disconnected.sidechain_number", "ctip.sidechain_number")
    held = F.when(F.col("kind") == "block_connected", F.col("block_connected").isNotNull()).when(F.col("kind") == "block_disconnected", F.col("block_disconnected").isNotNull()).otherwise(F.col("ctip").isNotNull())
    return feed.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"), F.count_distinct(slot).alias("slots"), F.count_if(held).alias("payloads"))


def tip_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the tip stood still during each snapshot, and whether the deployment's stream told that block as well."""
    tips = [block_hash(F.col(c)) for c in ("tip_before", "tip_hash", "tip_after")]
    runs = read(spark, folder, "snapshot_runs").select("snapshot_id", "deploy_id", contract.tips_agree(*tips).alias("consistent"), tips[1].alias("hash"))
    live = blocks(spark, folder, BLOCKS[:1]).select("deploy_id", "hash").distinct().withColumn("live", F.lit(True))
    return runs.join(live, ["deploy_id", "hash"], "left").select("snapshot_id", "consistent", F.coalesce("live", F.lit(False)).alias("seen_live"))


def invalid_running_count(spark: SparkSession, folder: str) -> DataFrame:
    """How many deliveries could not be normalized, up to and with each."""
    told = events(spark, folder).select("arrival_seq", F.col("error").isNotNull().alias("bad"))
    return contract.running_invalid(told, "arrival_seq", F.col("bad")).select("arrival_seq", "invalid_total")


def slot_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Every known block as the stream tells it: once per monitored slot."""
    known = read(spark, folder, "block_headers").select(block_hash(F.col("hash")).alias("hash")).where("hash is not null").distinct()
    return contract.fan_out(known, SLOTS)


def snapshot_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The events of each snapshot in their order: tip, proposals, active sidechains, then one per slot with its CTIP."""
    runs = read(spark, folder, "snapshot_runs")
    line = lambda **parts: F.concat_ws(" ", *[F.concat(F.lit(f"{k}="), c.cast("string")) for k, c in parts.items()])
    heads = runs.select(
        "snapshot_id",
        F.inline(F.array(
            F.struct(F.lit(1).cast("bigint").alias("seq"), F.lit("chain_tip").alias("kind"), line(height=F.col("tip_height"), block_hash=block_hash(F.col("tip_hash"))).alias("summary")),
            F.struct(F.lit(2).cast("bigint").alias("seq"), F.lit("sidechain_proposals").alias("kind"), line(proposal_count=F.col("proposal_count")).alias("summary")),
            F.struct(F.lit(3).cast("bigint").alias("seq"), F.lit("active_sidechains").alias("kind"), line(sidechain_count=F.col("sidechain_count")).alias("summary")),
        )),
    )
    values = {"txid": block_hash(F.col("ctip.txid")), "vout": F.col("ctip.vout"), "value_sats": F.col("ctip.value"), "sequence_number": F.col("ctip.sequence_number")}
    rows = read(spark, folder, "ctip_snapshots").select("snapshot_id", "sidechain_number", "loaded_at", F.col("ctip").isNotNull().alias("present"), *[c.alias(n) for n, c in values.items()])
    last = snapshots.latest_rows(rows, "snapshot_id", ["sidechain_number"], "loaded_at", ["present", *values])
    told = F.when(F.col("present"), line(sidechain=F.col("sidechain_number"), present=F.lit(True), **{n: F.col(n) for n in values})).otherwise(line(sidechain=F.col("sidechain_number"), present=F.lit(False)))
    order = Window.partitionBy("snapshot_id").orderBy("sidechain_number")  # no more than 256 slots
    slots = last.select("snapshot_id", (F.row_number().over(order) + 3).cast("bigint").alias("seq"), F.lit("ctip").alias("kind"), told.alias("summary"))
    return heads.unionByName(slots)


def chain_states(spark: SparkSession, folder: str) -> DataFrame:
    """Chain states as JSON text, made of the props of events: one state, two, or no JSON at all."""
    k = F.get_json_object("props", "$.k")
    one = F.concat(F.lit('{"chainstates":[{"blocks":'), k, F.lit(',"validated":'), F.when(F.col("event_type") == "click", "true").otherwise("false"), F.lit("}]}"))
    two = F.concat(F.lit('{"chainstates":[{"blocks":'), k, F.lit(',"validated":true},{"blocks":'), F.col("user_id").cast("string"), F.lit(',"validated":false}]}'))
    text = F.when(F.col("event_type").isin("click", "view"), one).when(F.col("event_type") == "purchase", two).when(F.col("event_type") == "error", "{}").otherwise("no json")
    return read(spark, folder, "events").select("event_id", text.alias("states"))


def history_ready(spark: SparkSession, folder: str) -> DataFrame:
    return chain_states(spark, folder).select("event_id", operations.history_ready(F.col("states")).alias("ready"))


def history_summary(spark: SparkSession, folder: str) -> DataFrame:
    return chain_states(spark, folder).select("event_id", F.inline(F.array(operations.history_summary(F.col("states"))))).withColumn("chainstate_count", F.col("chainstate_count").cast("bigint"))


def prefix_filter(spark: SparkSession, folder: str) -> DataFrame:
    return operations.with_prefix(read(spark, folder, "courts"), "court_name", "R", "court_code", "court_name")


def _told(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def chain_brief(spark: SparkSession, folder: str) -> DataFrame:
    """A node's answer about its chain, made of a snapshot's counts, without what is not asked for."""
    text = _told('{"pruned":true,"chain":"main","blocks":', F.col("tip_height"), ',"headers":', F.col("tip_height") + F.col("ctip_count"), ',"initialblockdownload":', F.col("ctip_count") > 4, ',"warnings":[]}')
    return read(spark, folder, "snapshot_runs").select("snapshot_id", operations.chain_brief(F.when(F.col("proposal_count") > 1, text).otherwise("[1]")).alias("brief"))


def peer_briefs(spark: SparkSession, folder: str) -> DataFrame:
    """A node's answer about its peers, likewise."""
    one = lambda n: _told('{"id":7,"addr":"10.0.0.', F.col(n), '","inbound":true,"synced_blocks":', F.col("tip_height"), "}")
    text = F.when(F.col("ctip_count") > 4, _told("[", one("ctip_count"), ",", one("proposal_count"), "]")).otherwise("[]")
    return read(spark, folder, "snapshot_runs").select("snapshot_id", operations.peer_briefs(text).alias("peers"))


def subscriptions_on(spark: SparkSession, folder: str) -> DataFrame:
    """The subscriptions on one subject among those that a bus tells."""
    one = lambda n: _told('{"sid":"3","account":"A","subject":"feed.blocks.', F.col(n), '","msgs":', F.col("tip_height"), "}")
    text = _told('{"subscriptions_list":[', one("proposal_count"), ",", one("sidechain_count"), "]}")
    return read(spark, folder, "snapshot_runs").select("snapshot_id", operations.subscriptions_on(text, SUBJECT).alias("told"))


def subject_filter(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "enforcer_feed").where("kind = 'block_disconnected'").select("arrival_seq", "deploy_id")


def nested_exists(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks with a failed withdrawal bundle among their events."""
    states = F.transform("block_connected.events", lambda e: F.struct(e["withdrawal"]["state"].alias("state")))
    return read(spark, folder, "enforcer_feed").where(operations.any_named(states, "state", "failed")).select("arrival_seq")


def node_ready(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots taken from a node of the right chain that had come far enough, had the pinned block and whose tip stood still; counts stand for what a node tells."""
    tip, before = block_hash(F.col("tip_hash")), block_hash(F.col("tip_before"))
    chain, pinned = F.when(F.col("ctip_count") > 4, "main").otherwise("test"), F.when(F.col("sidechain_count") > 2, "pin")
    ready = operations.node_ready(chain, F.col("tip_height"), F.col("tip_height") + F.col("proposal_count") - 3, tip != before, pinned, LEAST_HEIGHT, "main", "pin")
    return read(spark, folder, "snapshot_runs").select("snapshot_id", ready.alias("ready"))


def tip_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots whose tip is, by height and hash, among the headers."""
    ours = read(spark, folder, "snapshot_runs").select("snapshot_id", F.col("tip_height").alias("height"), block_hash(F.col("tip_hash")).alias("hash"))
    theirs = read(spark, folder, "block_headers").select("height", block_hash(F.col("hash")).alias("hash"))
    return operations.tip_agreement(ours, theirs).select("snapshot_id", "height", "hash")


def log_match(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines about a connected block of slot 9."""
    rows = blocks(spark, folder)
    line = F.concat(F.lit("published "), F.regexp_replace("kind", "_", " "), F.lit(" sidechain="), F.col("slot").cast("string"), F.lit(" block_hash="), F.col("hash"))
    hit = operations.log_matches(line, "block connected", F.lit(9), F.col("hash"))
    return rows.where(hit).select("arrival_seq", line.alias("line"))


def undelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Slots of a deployment that were never told its newest connected block."""
    rows = blocks(spark, folder, BLOCKS[:1])
    newest = rows.groupBy("deploy_id").agg(F.max_by("hash", F.struct("time", "arrival_seq")).alias("hash"))
    expected = rows.select("deploy_id", "slot").distinct().join(newest, "deploy_id").select("deploy_id", "slot", "hash")
    return operations.undelivered(expected, rows, ["deploy_id", "slot", "hash"])


def slot_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of slots given as text: the numbers, or null where the list is not valid."""
    rows = read(spark, folder, "snapshot_runs")
    text = F.concat_ws(",", F.col("ctip_count").cast("string"), F.col("tip_height").cast("string"))
    return rows.select("snapshot_id", F.array_join(operations.slots_of(text).cast("array<string>"), "+").alias("slots"))


def positive_guard(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select("event_id", operations.positive(F.get_json_object("props", "$.k")).alias("number"))


def key_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Names set by lines of two files that must not share any."""
    line = lambda c, rest: F.concat(F.lit("  "), F.regexp_replace(F.upper(F.col(c)), "[^A-Z0-9]", "_"), F.lit(rest))
    own = read(spark, folder, "nation").select(operations.setting_keys(line("n_name", " = 1")).alias("name")).where("name is not null")
    locked = read(spark, folder, "nation").where("n_regionkey < 2").select(operations.setting_keys(line("n_name", "=x")).alias("name")).where("name is not null")
    return operations.key_overlap(own, locked, "name")


def new_tip(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots during which a new tip came, at whatever height."""
    before, after = block_hash(F.col("tip_before")), block_hash(F.col("tip_after"))
    return read(spark, folder, "snapshot_runs").where(before != after).select("snapshot_id", after.alias("tip"))


def payload_verify(spark: SparkSession, folder: str) -> DataFrame:
    """Size and SHA-256 of the bytes of each valid hash, and whether they are those stated (wrongly where there is no height)."""
    raw = F.unhex(block_hash(F.col("hash")))
    stated = F.when(F.col("height").isNull(), "00").otherwise(F.sha2(raw, 256))
    rows = read(spark, folder, "block_headers").where(raw.isNotNull())
    return rows.select("header_row_id", F.octet_length(raw).cast("bigint").alias("size"), F.sha2(raw, 256).alias("digest"), operations.payload_matches(raw, 32, stated).alias("matches"))


def received_any(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each deployment's stream of a slot told any disconnected block."""
    slot = F.coalesce("block_connected.sidechain_number", "block_disconnected.sidechain_number", "ctip.sidechain_number").alias("slot")
    return read(spark, folder, "enforcer_feed").groupBy("deploy_id", slot).agg(F.bool_or(F.col("kind") == "block_disconnected").alias("received"))


def block_ancestors(spark: SparkSession, folder: str) -> DataFrame:
    """The header loaded last and its ancestors, newest first."""
    valid: Column = block_hash(F.col("hash"))
    rows = read(spark, folder, "block_headers").select(valid.alias("hash"), block_hash(F.col("previous_hash")).alias("previous_hash"), "header_row_id").where("hash is not null")
    links = rows.groupBy("hash").agg(F.min("previous_hash").alias("previous_hash"))
    start = rows.agg(F.max_by("hash", "header_row_id").alias("hash"))
    return contract.ancestors(links, start, ANCESTORS).select("hash", "distance")


QUERIES = {
    f.__name__: f
    for f in (
        normalize_feed, render_summary, render_json, payload_round_trip, decode_permissive, observation_ms, network_codes, block_counts, nested_deposit_totals, dedupe_idempotent,
        canonical_blocks, latest_snapshot, ctip_presence, distinct_blocks, kind_dispatch, tip_consistency, invalid_running_count, slot_fanout, snapshot_batch, history_ready,
        history_summary, prefix_filter, chain_brief, peer_briefs, subscriptions_on, subject_filter, nested_exists, node_ready, tip_agreement, log_match, undelivered, slot_parse, positive_guard, key_overlap, new_tip,
        payload_verify, received_any, block_ancestors,
    )
}
