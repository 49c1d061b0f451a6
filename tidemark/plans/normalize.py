"""What the validator sends, as typed events: strict, and a whole event or nothing.

Each function takes raw columns (types: ``schema.RAW_*``) and gives a ``Checked``: the normalized struct and the first reason
against it, in reading order. ``normalized`` turns that into rows: failing fast or keeping the bad rows apart.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.checks import Checked, each, first_of, hash_bytes, hex_bytes, missing, once, optional, required
from tidemark.sources import schema


def _struct(kind: str, **fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()]).cast(kind)


def network(c: Column) -> Column:
    """A known network number; any other is 1, unknown."""
    return F.when(c.between(0, len(schema.NETWORKS) - 1), c).otherwise(1)


def chain_info(raw: Column) -> Checked:
    constants = raw["bip300_constants"]
    filled = F.struct(*[F.coalesce(constants[c], F.lit(0)).alias(c) for c in schema.CONSTANTS])
    return Checked(_struct(schema.KINDS["chain_info"], network=network(F.coalesce(raw["network"], F.lit(0))), bip300_constants=filled), missing(constants, "chain_info.bip300_constants"))


def header(raw: Column, path: str) -> Checked:
    """Hashes and work of 32 bytes; missing height and time are 0."""
    block = hash_bytes(raw["block_hash"], f"{path}.block_hash")
    previous = hash_bytes(raw["prev_block_hash"], f"{path}.prev_block_hash")
    work = hash_bytes(raw["work"], f"{path}.work")
    zero = F.lit(0)
    value = _struct(schema.HEADER, hash=block.value, previous_hash=previous.value, height=F.coalesce(raw["height"], zero), chain_work=work.value, timestamp=F.coalesce(raw["timestamp"], zero))
    return Checked(value, first_of(block.error, previous.error, work.error))


def chain_tip(raw: Column) -> Checked:
    tip = raw["block_header_info"]
    read = header(tip, "chain_tip.block_header_info")
    return Checked(_struct(schema.KINDS["chain_tip"], header=read.value), first_of(missing(tip, "chain_tip.block_header_info"), read.error))


def declaration(raw: Column, path: str) -> Checked:
    """Absent, or of version 0 with all of its fields."""
    v0 = raw["v0"]
    title, text = required(v0["title"], f"{path}.title"), required(v0["description"], f"{path}.description")
    one, two = hex_bytes(v0["hash_id_1"], f"{path}.hash_id_1"), hex_bytes(v0["hash_id_2"], f"{path}.hash_id_2")
    value = _struct(schema.DECLARATION, v0=F.struct(title.value.alias("title"), text.value.alias("description"), one.value.alias("hash_id_1"), two.value.alias("hash_id_2")))
    return optional(raw, Checked(value, first_of(missing(v0, f"{path}.version"), title.error, text.error, one.error, two.error)))


def proposal(raw: Column) -> Checked:
    path = "sidechain_proposal"
    text = hex_bytes(raw["description"], f"{path}.description")
    digest = hash_bytes(raw["description_sha256d_hash"], f"{path}.description_sha256d_hash")
    told = declaration(raw["declaration"], f"{path}.declaration")
    numbers = {c: required(raw[c], f"{path}.{c}") for c in ("sidechain_number", "vote_count", "proposal_height", "proposal_age")}
    value = F.struct(
        raw["sidechain_number"].alias("sidechain_number"), text.value.alias("raw_description"), digest.value.alias("description_hash"),
        *[raw[c].alias(c) for c in ("vote_count", "proposal_height", "proposal_age")], told.value.alias("declaration"),
    )
    slot, votes, height, age = (n.error for n in numbers.values())
    return Checked(value, first_of(slot, text.error, digest.error, votes, height, age, told.error))


def sidechain_proposals(raw: Column) -> Checked:
    read = each(raw, proposal, "sidechain proposal")
    return Checked(_struct(schema.KINDS["sidechain_proposals"], proposals=read.value), read.error)


def active_sidechain(raw: Column) -> Checked:
    path = "sidechain"
    text = hex_bytes(raw["description"], f"{path}.description")
    told = declaration(raw["declaration"], f"{path}.declaration")
    names = ("sidechain_number", "vote_count", "proposal_height", "activation_height")
    slot, *rest = (missing(raw[c], f"{path}.{c}") for c in names)
    value = F.struct(raw["sidechain_number"].alias("sidechain_number"), text.value.alias("raw_description"), *[raw[c].alias(c) for c in names[1:]], told.value.alias("declaration"))
    return Checked(value, first_of(slot, text.error, *rest, told.error))


def active_sidechains(raw: Column) -> Checked:
    read = each(raw, active_sidechain, "sidechain")
    return Checked(_struct(schema.KINDS["active_sidechains"], sidechains=read.value), read.error)


def ctip(slot: Column, raw: Column) -> Checked:
    """The slot is that of the request; no ctip is a value too. Missing numbers are 0."""
    txid = hash_bytes(raw["txid"], "ctip.txid")
    zero = F.lit(0)
    value = F.struct(txid.value.alias("txid"), F.coalesce(raw["vout"], zero).alias("vout"), F.coalesce(raw["value"], zero).alias("value_sats"), F.coalesce(raw["sequence_number"], zero).alias("sequence_number"))
    read = optional(raw, Checked(value, txid.error))
    return Checked(_struct(schema.KINDS["ctip"], sidechain_number=slot, ctip=read.value), read.error)


def deposit(raw: Column) -> Checked:
    point, output = raw["outpoint"], raw["output"]
    txid = hash_bytes(point["txid"], "deposit.outpoint.txid")
    address = hex_bytes(output["address"], "deposit.output.address")
    value = _struct(
        schema.DEPOSIT, sequence_number=raw["sequence_number"], outpoint=F.struct(txid.value.alias("txid"), point["vout"].alias("vout")),
        address=address.value, value_sats=output["value_sats"],
    )
    error = first_of(
        missing(point, "deposit.outpoint"), missing(output, "deposit.output"), missing(raw["sequence_number"], "deposit.sequence_number"), txid.error,
        missing(point["vout"], "deposit.outpoint.vout"), address.error, missing(output["value_sats"], "deposit.output.value_sats"),
    )
    return Checked(value, error)


def withdrawal(raw: Column) -> Checked:
    """The state is read before the identifier."""
    state, name = raw["event"], "withdrawal_bundle"
    done = state["succeeded"]
    moved = hex_bytes(done["transaction"], f"{name}.succeeded.transaction")
    m6id = hex_bytes(raw["m6id"], f"{name}.m6id")
    finished = F.when(done.isNotNull(), F.struct(done["sequence_number"].alias("sequence_number"), moved.value.alias("transaction")))
    value = _struct(schema.WITHDRAWAL, m6id=m6id.value, submitted=state["submitted"], failed=state["failed"], succeeded=finished)
    unset = state["submitted"].isNull() & state["failed"].isNull() & done.isNull()
    error = first_of(
        missing(state, f"{name}.event"), F.when(unset, F.lit(f"missing {name}.event.state")),
        F.when(done.isNotNull(), first_of(missing(done["sequence_number"], f"{name}.succeeded.sequence_number"), moved.error)), m6id.error,
    )
    return Checked(value, error)


def sidechain_event(raw: Column) -> Checked:
    paid, left = deposit(raw["deposit"]), withdrawal(raw["withdrawal_bundle"])
    has_deposit, has_bundle = raw["deposit"].isNotNull(), raw["withdrawal_bundle"].isNotNull()
    value = F.struct(F.when(has_deposit, paid.value).alias("deposit"), F.when(has_bundle, left.value).alias("withdrawal_bundle"))
    return Checked(value, F.when(has_deposit, paid.error).when(has_bundle, left.error).otherwise(F.lit("missing sidechain event")))


def connected_block(slot: Column, raw: Column) -> Checked:
    """Commitment, then events in order, then the header."""
    info, head = raw["block_info"], raw["header_info"]
    commitment = optional(info["bmm_commitment"], hex_bytes(info["bmm_commitment"], "block_info.bmm_commitment"))
    events = each(info["events"], sidechain_event, "sidechain event")
    top = header(head, "header_info")
    value = _struct(schema.KINDS["block_connected"], header=top.value, sidechain_number=slot, bmm_commitment=commitment.value, events=events.value)
    return Checked(value, first_of(commitment.error, events.error, top.error))


def subscription_event(slot: Column, raw: Column) -> dict[str, Checked]:
    """Connect or disconnect; the reasons against either are the same for both: only one is set."""
    on, off = raw["connect_block"], raw["disconnect_block"]
    block, gone = connected_block(slot, on), hash_bytes(off["block_hash"], "disconnect_block.block_hash")
    dropped = _struct(schema.KINDS["block_disconnected"], block_hash=gone.value, sidechain_number=slot)
    connect_error = first_of(missing(on["header_info"], "connect_block.header_info"), missing(on["block_info"], "connect_block.block_info"), block.error)
    error = first_of(missing(raw, "subscription event"), F.when(on.isNull() & off.isNull(), F.lit("missing subscription event kind")), F.when(on.isNotNull(), connect_error), F.when(off.isNotNull(), gone.error))
    return {"block_connected": Checked(F.when(on.isNotNull(), block.value), error), "block_disconnected": Checked(F.when(off.isNotNull() & on.isNull(), dropped), error)}


def block_infos(slot: Column, raw: Column) -> Checked:
    """A block and its ancestors as connected events, in the order received (newest first)."""

    def one(x: Column) -> Checked:
        read = connected_block(slot, x)
        return Checked(read.value, first_of(missing(x["header_info"], "header_info"), missing(x["block_info"], "block_info"), read.error))

    return each(raw, one, "block info")


def envelope(timestamp: Column, kinds: dict[str, Column]) -> Column:
    """The event with its observation time in milliseconds; kinds not given are null."""
    fields = [F.coalesce(kinds[k], F.lit(None).cast(t)).alias(k) if k in kinds else F.lit(None).cast(t).alias(k) for k, t in schema.KINDS.items()]
    return F.struct(timestamp.cast(schema.U64).alias("timestamp"), F.struct(*fields).alias("enforcer"))


def normalized(df: DataFrame, timestamp: Column, kinds: dict[str, Checked], mode: str = "permissive") -> DataFrame:
    """``df`` with ``event`` and ``error``.

    ``permissive``: a row that cannot be read has a null event and its reason. ``failfast``: it ends the query with the reason.
    A time before 1970 cannot be read. Rows for which no kind is set have an event without a kind.
    """
    early = F.when(timestamp < 0, F.lit("system clock is before the Unix epoch"))
    error = first_of(*[c.error for c in kinds.values()], early)
    if mode == "failfast":
        error = F.when(error.isNotNull(), F.raise_error(error)).cast("string")
    elif mode != "permissive":
        raise ValueError(f"unknown mode {mode}")
    out = df.withColumn("error", once(error))
    return out.withColumn("event", once(F.when(F.col("error").isNull(), envelope(timestamp, {k: c.value for k, c in kinds.items()}))))

