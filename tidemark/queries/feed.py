"""The queries of problems 1 to 6 over the tables of a folder."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.checks import once
from tidemark.functions.hexes import block_hash, hash_key, hex_text, link_hash, plain_text
from tidemark.operators import changes, dedupe, hierarchy, references, snapshots
from tidemark.session import set_default

BLOCKS = ("block_connected", "block_disconnected")
HOUR_MS, DAY_MS, DAY_US = 3_600_000, 86_400_000, 86_400_000_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    set_default(spark, "spark.sql.adaptive.enabled", "true")
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Problem 1


def header_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "block_headers").select(once(block_hash(F.col("hash"))).alias("h"), link_hash(F.col("previous_hash")).alias("p"), "header_row_id")
    return hierarchy.links(rows, F.col("h"), F.col("p"), F.col("header_row_id"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    tree = hierarchy.hierarchy(header_links(spark, folder))
    return tree.select(F.col("key").alias("hash"), F.coalesce("root", F.lit("cycle")).alias("root_hash"), "depth")


def p1_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Full path of each header that has a root, as header_row_ids (the least of its hash) from the root down."""
    tree = hierarchy.hierarchy(header_links(spark, folder), with_path=True).where("depth >= 0")
    return tree.select(F.col("key").alias("hash"), F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def p1_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """All descendants of each header, one row per pair."""
    pairs = hierarchy.descendants(hierarchy.hierarchy(header_links(spark, folder), with_path=True))
    return pairs.select(F.col("ancestor").alias("ancestor_row"), F.col("descendant").alias("descendant_row"), F.col("distance").cast("bigint").alias("distance"))


# Problem 2


def messages(spark: SparkSession, folder: str, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Valid deliveries, of some kinds only if any are named: what identifies the message, and its state."""
    feed = read(spark, folder, "enforcer_feed")
    if kinds:
        feed = feed.where(F.col("kind").isin(*kinds))
    block = F.coalesce(F.col("block_connected.header.hash"), F.col("block_disconnected.block_hash"))
    slot = F.coalesce(F.col("block_connected.sidechain_number"), F.col("block_disconnected.sidechain_number"), F.col("ctip.sidechain_number"))
    is_ctip = F.col("kind") == "ctip"
    time = F.col("event_ms").cast("bigint")
    rows = feed.select(
        "arrival_seq", "deploy_id", slot.alias("slot"), "kind", time.alias("time"), "arrival_ts",
        F.when(is_ctip, F.concat(F.lit("ctip "), F.coalesce(time.cast("string"), F.lit("")))).otherwise(once(block_hash(block))).alias("token"),
        F.when(~is_ctip, F.col("block_connected.header.height")).alias("height"),
    )
    return rows.where("token is not null")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    ctip = F.col("kind") == "ctip"  # its message is known by its time, a block's by its hash
    rows = messages(spark, folder).select("arrival_seq", "deploy_id", "slot", F.when(~ctip, F.unhex("token")).alias("block"), F.when(ctip, F.col("token")).alias("ctip"), (F.col("kind") == "block_connected").alias("connected"), "height", "time")
    return dedupe.surplus_deliveries(rows, ["deploy_id", "slot", "block", "ctip"], ["connected", "height"], F.col("time"), "arrival_seq", DAY_MS, HOUR_MS)


# Problems 3 and 4


def _declaration() -> list[Column]:
    d = "declaration"
    return [F.col(d).isNull(), plain_text(F.col(f"{d}.title")), plain_text(F.col(f"{d}.description")), hex_text(F.col(f"{d}.hash_id_1")), hex_text(F.col(f"{d}.hash_id_2"))]


#: item kind: table, count in snapshot_runs, whether the description's hash is a part of the key, all compared fields
ITEMS = {
    "proposal": ("proposal_snapshots", "proposal_count", True, lambda: [hex_text(F.col("description")), F.col("vote_count"), F.col("proposal_height"), F.col("proposal_age"), *_declaration()]),
    "active": ("active_snapshots", "sidechain_count", False, lambda: [hex_text(F.col("description")), F.col("vote_count"), F.col("proposal_height"), F.col("activation_height"), *_declaration()]),
    "ctip": ("ctip_snapshots", "ctip_count", False, lambda: [hex_text(F.col("ctip.txid")), F.col("ctip.vout"), F.col("ctip.value"), F.col("ctip.sequence_number")]),
}
KINDS = list(ITEMS)
KEYS = ["sidechain_number", "description_hash"]
#: attributes of the history by rate of change
HISTORY = {"proposal": {"fast": "proposal_age", "slow": "vote_count"}, "active": {"fast": "vote_count", "slow": "activation_height"}}


def snapshot_items(spark: SparkSession, folder: str, values: dict[str, dict[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """The latest row of each snapshot and key, and the complete snapshots in order, of all kinds in ``values`` at once.

    A snapshot is a struct of kind and snapshot_id here, a series one of kind and deploy_id.
    """
    runs, every, told = read(spark, folder, "snapshot_runs"), None, []
    for kind, fields in values.items():
        table, stated, described, _ = ITEMS[kind]
        code = F.lit(KINDS.index(kind)).alias("kind")
        rows = read(spark, folder, table).withColumn("__key", hex_text(F.col("description_hash")) if described else F.lit(""))
        rows = rows.select(F.struct(code, "snapshot_id").alias("snapshot"), "sidechain_number", F.col("__key").alias("description_hash"), "loaded_at", *[c.alias(n) for n, c in fields.items()])
        every = rows if every is None else every.unionByName(rows)
        told.append(F.struct(F.struct(code, "snapshot_id").alias("snapshot"), F.struct(code, "deploy_id").alias("series"), F.col(stated).alias("stated")))
    latest = snapshots.latest_rows(every, "snapshot", KEYS, "loaded_at", list(next(iter(values.values()))))
    runs = runs.select(F.unix_micros(F.col("snapshot_at").cast("timestamp")).alias("at"), F.inline(F.array(*told)))
    return latest, snapshots.complete_snapshots(runs, latest, "snapshot", "series", "at", "stated", F.floor(F.col("at") / DAY_US))


def _kind(code: str) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col(code) + 1).alias("item_kind")


def history_items(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return snapshot_items(spark, folder, {kind: {rate: F.col(c) for rate, c in groups.items()} for kind, groups in HISTORY.items()})


def _versions(sats: DataFrame) -> DataFrame:
    second = lambda c: F.floor(F.col(c) / 1_000_000)
    rows = snapshots.versions(sats, "series", KEYS)
    return rows.select(_kind("series.kind"), "series.deploy_id", *KEYS, second("valid_from").alias("valid_from"), F.coalesce(second("valid_to"), F.lit(-1)).cast("bigint").alias("valid_to"))


SATELLITES = {"fast": ["fast"], "slow": ["slow"]}


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    latest, runs = history_items(spark, folder)
    return _versions(snapshots.satellites(latest, runs, "snapshot", "series", KEYS, SATELLITES))


def p3_appended(spark: SparkSession, folder: str) -> DataFrame:
    """The same history in two loads: satellites of the first half of each series' snapshots, then the rows that the rest appends."""
    latest, runs = history_items(spark, folder)
    half = runs.groupBy("series").agg(F.floor(F.max("n") / 2).alias("last"))
    on = [runs["series"] == F.col("s")]
    first = runs.join(half.withColumnRenamed("series", "s"), on).where("n <= last").withColumn("next_at", F.when(F.col("n") < F.col("last"), F.col("next_at"))).drop("s", "last")
    stored = snapshots.satellites(latest, first, "snapshot", "series", KEYS, SATELLITES)
    return _versions(stored.unionByName(snapshots.satellites(latest, runs, "snapshot", "series", KEYS, SATELLITES, stored)))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = {kind: {"image": snapshots.digest(*ITEMS[kind][3]()), "held": F.col("ctip").isNotNull() if kind == "ctip" else F.lit(True)} for kind in KINDS}
    latest, runs = snapshot_items(spark, folder, fields)
    found = snapshots.differences(latest.where("held"), runs, "snapshot", KEYS, ["image"])
    series = runs.select(F.col("snapshot").alias("__run"), "series.deploy_id")
    return found.join(series, F.col("snapshot") == F.col("__run")).select(_kind("snapshot.kind"), "deploy_id", "snapshot.snapshot_id", *KEYS, "change")


# Problem 5


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    headers = read(spark, folder, "block_headers").withColumn("h", once(block_hash(F.col("hash")))).where("h is not null")
    runs = read(spark, folder, "snapshot_runs")
    blocks = messages(spark, folder, BLOCKS)

    def refs(rows: DataFrame, table: str, ident: str, target: Column, time: str) -> DataFrame:
        return rows.select(F.lit(table).alias("ref_table"), F.col(ident).alias("ref_id"), F.date_format(time, "yyyy-MM-dd").alias("period"), hash_key(target).alias("block"), _micros(time).alias("time"))

    every = refs(headers, "block_headers", "header_row_id", link_hash(F.col("previous_hash")), "loaded_at")
    every = every.unionByName(refs(blocks, "enforcer_feed", "arrival_seq", F.col("token"), "arrival_ts"))
    every = every.unionByName(refs(runs, "snapshot_runs", "snapshot_id", link_hash(F.col("tip_hash")), "snapshot_at"))
    targets = headers.select(hash_key(F.col("h")).alias("block"), _micros("loaded_at").alias("since"), _micros("deleted_at").alias("until"))
    return references.orphans(every, targets, ["block"], ["ref_table", "ref_id", "period"])


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references per table and day."""
    return references.per_period(p5_found(spark, folder))


def p5_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Disconnect messages that refer by deployment, slot and hash to a block whose connection had not arrived, under each match semantics.

    The key is null in part where a corrupted delivery's hash is not valid, and where it names slot 9, taken as "any slot" here.
    """
    feed = read(spark, folder, "enforcer_feed")
    off = feed.where("kind = 'block_disconnected'").select(
        "arrival_seq", "deploy_id", F.nullif(F.col("block_disconnected.sidechain_number"), F.lit(9)).alias("slot"), once(block_hash(F.col("block_disconnected.block_hash"))).alias("block"), _micros("arrival_ts").alias("time"),
    )
    on = feed.where("kind = 'block_connected'").select(
        "deploy_id", F.col("block_connected.sidechain_number").alias("slot"), once(block_hash(F.col("block_connected.header.hash"))).alias("block"), _micros("arrival_ts").alias("since"), F.lit(None).cast("long").alias("until"),
    )
    out = None
    for match in ("simple", "partial", "full"):
        rows = references.orphans(off, on, ["deploy_id", "slot", "block"], ["arrival_seq"], match).select(F.lit(match).alias("match"), "arrival_seq", "reason")
        out = rows if out is None else out.unionByName(rows)
    return out


# Problem 6


def changes_of(spark: SparkSession, folder: str) -> DataFrame:
    """Connect and disconnect messages as changes; a block is known by the bytes of its hash."""
    feed = messages(spark, folder, BLOCKS)
    return feed.select("deploy_id", F.col("slot").alias("sidechain_number"), F.unhex("token").alias("hash"), "time", "arrival_seq", "height", (F.col("kind") == "block_disconnected").alias("gone"))


def _connected(state: DataFrame) -> DataFrame:
    return state.select("deploy_id", "sidechain_number", F.lower(F.hex("hash")).alias("hash"), "height")


BLOCK = ["deploy_id", "sidechain_number", "hash"]


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _connected(changes.apply_changes(changes_of(spark, folder), BLOCK, ["time", "arrival_seq"], "gone", ["height"]))


def p6_applied(spark: SparkSession, folder: str) -> DataFrame:
    """The same table by applying the newer half of the feed to the blocks that were connected after the older half."""
    rows = changes_of(spark, folder)
    half = rows.agg(F.percentile_approx("time", 0.5, 10_000)).first()[0]
    newer = F.coalesce(F.col("time") > F.lit(half), F.lit(False))
    old = rows.where(~newer).groupBy(*BLOCK).agg(F.max_by(F.struct("gone", "height"), F.struct("time", "arrival_seq")).alias("last"))
    base = old.where("not last.gone").select(*BLOCK, "last.height")
    return _connected(changes.apply_changes(rows.where(newer), BLOCK, ["time", "arrival_seq"], "gone", ["height"], base))


QUERIES = {f.__name__: f for f in (p1_found, p1_paths, p1_descendants, p2_found, p3_found, p3_appended, p4_found, p5_found, p5_report, p5_composite, p6_found, p6_applied)}
