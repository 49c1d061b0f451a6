"""The queries of the snapshot kinds, and of what consumers reject, over the tables of a folder."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.checks import once
from tidemark.functions.hexes import block_hash, hex_text
from tidemark.operators import contract
from tidemark.plans import normalize, summary
from tidemark.queries.feed import read
from tidemark.sources import protobuf, schema

NEARLY_FULL = 2**64 - 1 - 40  # a counter that is about to reach its end


def _declared(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(c.alias("v0"))).cast(schema.RAW_DECLARATION)


def _raw(names: tuple[str, ...], kind: str, **other: Column) -> Column:
    """One element of an array type of raw messages, of a table's columns."""
    fields = [F.col(n).alias(n) for n in names]
    return F.struct(*fields, *[c.alias(n) for n, c in other.items()]).cast(kind.removeprefix("array<").removesuffix(">"))


def raw_proposal() -> Column:
    other = {"declaration": _declared(F.col("declaration")), "description_sha256d_hash": F.col("description_hash")}
    fields = {**{n: F.col(n) for n in ("sidechain_number", "description", "vote_count", "proposal_height", "proposal_age")}, **other}
    order = ("sidechain_number", "description", "declaration", "description_sha256d_hash", "vote_count", "proposal_height", "proposal_age")
    return F.struct(*[fields[n].alias(n) for n in order]).cast(schema.RAW_PROPOSALS.removeprefix("array<").removesuffix(">"))


def raw_active() -> Column:
    return _raw(("sidechain_number", "description", "vote_count", "proposal_height", "activation_height"), schema.RAW_ACTIVE, declaration=_declared(F.col("declaration")))


def _told(rows: DataFrame, raw: Column, reader) -> DataFrame:
    """``rows`` with ``raw`` and the reason against it."""
    return rows.withColumn("raw", raw).withColumn("error", once(reader(F.col("raw")).error))


def proposals(spark: SparkSession, folder: str) -> DataFrame:
    return _told(read(spark, folder, "proposal_snapshots"), raw_proposal(), normalize.proposal)


def active(spark: SparkSession, folder: str) -> DataFrame:
    return _told(read(spark, folder, "active_snapshots"), raw_active(), normalize.active_sidechain)


def normalize_proposals(spark: SparkSession, folder: str) -> DataFrame:
    """Every told proposal, and why it cannot be normalized."""
    return proposals(spark, folder).select("snapshot_id", "sidechain_number", "description_hash", "error")


def normalize_active(spark: SparkSession, folder: str) -> DataFrame:
    return active(spark, folder).select("snapshot_id", "sidechain_number", "description", "error")


def tips(spark: SparkSession, folder: str) -> DataFrame:
    """The header of each snapshot's tip as raw message, null where no header has that hash."""
    fields = {"block_hash": "hash", "prev_block_hash": "previous_hash", "height": "height", "work": "chain_work", "timestamp": "header_time"}
    headers = read(spark, folder, "block_headers").withColumn("h", once(block_hash(F.col("hash")))).where("h is not null")
    first = headers.groupBy("h").agg(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]), "header_row_id").alias("head"))
    runs = read(spark, folder, "snapshot_runs").withColumn("t", once(block_hash(F.col("tip_hash"))))
    return runs.join(first, F.col("t") == F.col("h"), "left").select("snapshot_id", "snapshot_at", F.struct(F.col("head").alias("block_header_info")).cast(schema.RAW_CHAIN_TIP).alias("raw"))


def infos(spark: SparkSession, folder: str) -> DataFrame:
    """Chain infos made of the counts of snapshots: every network number and some that are none, with and without constants."""
    values = {"activation_height": F.col("tip_height"), "withdrawal_bundle_max_age": F.col("sidechain_count")}
    constants = F.struct(*[values.get(c, F.lit(None)).cast("long").alias(c) for c in schema.CONSTANTS])
    raw = F.struct((F.col("proposal_count") - 1).cast("int").alias("network"), F.when(F.col("ctip_count") > 2, constants).alias("bip300_constants")).cast(schema.RAW_CHAIN_INFO)
    return read(spark, folder, "snapshot_runs").select("snapshot_id", "snapshot_at", raw.alias("raw"))


def render_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Chain info, tip, proposals and active sidechains of each snapshot as a consumer tells them; items that cannot be normalized are left out."""

    def rows_of(df: DataFrame) -> DataFrame:  # a snapshot holds a few items for each of 256 slots at most
        return df.where("error is null").groupBy("snapshot_id").agg(F.first("snapshot_at").alias("snapshot_at"), F.collect_list("raw").alias("raw"))

    parts = {
        "chain_info": (infos(spark, folder), normalize.chain_info), "chain_tip": (tips(spark, folder), normalize.chain_tip),
        "sidechain_proposals": (rows_of(proposals(spark, folder)), normalize.sidechain_proposals), "active_sidechains": (rows_of(active(spark, folder)), normalize.active_sidechains),
    }
    out = None
    for kind, (rows, reader) in parts.items():
        events = normalize.normalized(rows, F.unix_millis(F.col("snapshot_at").cast("timestamp")), {kind: reader(F.col("raw"))})
        e = F.col("event")
        events = events.select("snapshot_id", F.lit(kind).alias("kind"), F.coalesce("error", summary.validation_error(e)).alias("rejected"), F.when(F.col("error").isNull(), summary.summary(e)).alias("summary"))
        out = events if out is None else out.unionByName(events)
    return out


def _loose(c: Column) -> Column:
    """Bytes of lenient hex text whatever their number, as a careless producer sends them; none for other text."""
    text = hex_text(c)
    return F.unhex(F.when(text.rlike(r"\A([0-9a-f]{2})*\z"), text))


def careless_events(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as a careless producer would have sent it: nothing is checked, and failed bundles have no state."""
    on, off, tip = F.col("block_connected"), F.col("block_disconnected"), F.col("ctip")
    head = on["header"]
    header = F.struct(_loose(head["hash"]).alias("hash"), _loose(head["previous_hash"]).alias("previous_hash"), head["height"].alias("height"), _loose(head["chain_work"]).alias("chain_work"), head["header_time"].alias("timestamp"))

    def one(e: Column) -> Column:
        d, w = e["deposit"], e["withdrawal"]
        point = F.struct(_loose(d["outpoint"]["txid"]).alias("txid"), d["outpoint"]["vout"].alias("vout"))
        deposit = F.struct(d["sequence_number"].alias("sequence_number"), F.when(d["outpoint"].isNotNull(), point).alias("outpoint"), _loose(d["output"]["address"]).alias("address"), d["output"]["value_sats"].alias("value_sats"))
        done = F.struct(w["sequence_number"].alias("sequence_number"), F.lit(None).cast("binary").alias("transaction"))
        bundle = F.struct(_loose(w["m6id"]).alias("m6id"), F.when(w["state"] == "submitted", True).alias("submitted"), F.lit(None).cast("boolean").alias("failed"), F.when(w["state"] == "succeeded", done).alias("succeeded"))
        return F.struct(F.when(d.isNotNull(), deposit).alias("deposit"), F.when(w.isNotNull(), bundle).alias("withdrawal_bundle"))

    block = F.struct(F.when(head.isNotNull(), header).alias("header"), on["sidechain_number"].alias("sidechain_number"), _loose(on["bmm_commitment"]).alias("bmm_commitment"), F.transform(on["events"], one).alias("events"))
    gone = F.struct(_loose(off["block_hash"]).alias("block_hash"), off["sidechain_number"].alias("sidechain_number"))
    point = F.struct(_loose(tip["ctip"]["txid"]).alias("txid"), tip["ctip"]["vout"].alias("vout"), tip["ctip"]["value"].alias("value_sats"), tip["ctip"]["sequence_number"].alias("sequence_number"))
    held = F.struct(tip["sidechain_number"].alias("sidechain_number"), F.when(tip["ctip"].isNotNull(), point).alias("ctip"))
    kinds = {"block_connected": (on, block), "block_disconnected": (off, gone), "ctip": (tip, held)}
    event = normalize.envelope(F.col("event_ms"), {k: F.when(there.isNotNull(), c).cast(schema.KINDS[k]) for k, (there, c) in kinds.items()})
    text = F.coalesce(head["hash"], off["block_hash"])
    return read(spark, folder, "enforcer_feed").select("arrival_seq", "kind", (block_hash(text).isNull() & (F.col("kind") != "ctip")).alias("damaged"), once(event).alias("event"))


def consumer_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a consumer rejects of careless events, and why."""
    rows = careless_events(spark, folder).select("arrival_seq", "kind", once(summary.validation_error(F.col("event"))).alias("rejected"))
    return rows.where("rejected is not null")


def invalid_total(spark: SparkSession, folder: str) -> DataFrame:
    """Undecodable and rejected payloads up to and with each, counted on from a counter that is nearly full; it stays at its end."""
    wire = protobuf.encode(careless_events(spark, folder).select("arrival_seq", "damaged", "event"))
    told = protobuf.decode(wire.select("arrival_seq", F.when(F.col("damaged"), F.unhex(F.lit("ff00"))).otherwise(F.col("payload")).alias("payload")))
    bad = told.select("arrival_seq", (F.col("decode_error").isNotNull() | summary.validation_error(F.col("event")).isNotNull()).alias("bad"))
    total = contract.running_invalid(bad, "arrival_seq", F.col("bad"), carried=NEARLY_FULL)
    return total.select("arrival_seq", F.col("invalid_total").cast("string").alias("invalid_total"))


QUERIES = {f.__name__: f for f in (normalize_proposals, normalize_active, render_snapshots, consumer_rejects, invalid_total)}
