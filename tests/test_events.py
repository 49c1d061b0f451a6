"""Normalization, consumer checks, canonical JSON and the wire format on hand-made messages."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import filled
from tidemark.plans import normalize, summary
from tidemark.plans.canonical_json import full_json
from tidemark.sources import protobuf, schema

B = lambda n, size=32: f"{n:02x}" * size
HEADER = {"block_hash": B(0xAB), "prev_block_hash": B(0xAA), "height": 70_406, "work": B(0x0D), "timestamp": 1_733_000_111}
DEPOSIT = {"sequence_number": 905, "outpoint": {"txid": B(0xE1), "vout": 6}, "output": {"address": "7e57", "value_sats": 1_250_009}}
SUBMITTED = {"m6id": "0a0b", "event": {"submitted": True}}
SUCCEEDED = {"m6id": "0a0b", "event": {"succeeded": {"sequence_number": 906, "transaction": "d0d1"}}}
DECLARED = {"v0": {"title": "t", "description": "", "hash_id_1": "0102", "hash_id_2": "0304"}}
PROPOSAL = {"sidechain_number": 7, "description": "5eed", "declaration": None, "description_sha256d_hash": B(0x2E), "vote_count": 31, "proposal_height": 70_000, "proposal_age": 406}
ACTIVE = {"sidechain_number": 7, "description": "5eed", "vote_count": 77, "proposal_height": 69_000, "activation_height": 70_100, "declaration": DECLARED}
CONSTANTS = dict(zip(schema.CONSTANTS, (41, 23, 67, 59, 83, 71, 1_009)))


def read(spark, kind, value, function):
    """(value, error) of a raw message."""
    df = filled(spark, f"x {kind}", [(value,)])
    got = function(F.col("x"))
    row = df.select(got.value.alias("v"), got.error.alias("e")).first()
    return row["v"], row["e"]


def connect(spark, block=None, head=HEADER, slot=9):
    message = {"connect_block": {"header_info": head, "block_info": {"bmm_commitment": B(0xB3), "events": []} if block is None else block}}
    df = filled(spark, f"slot bigint, x {schema.RAW_SUBSCRIPTION}", [(slot, message)])
    got = normalize.subscription_event(F.col("slot"), F.col("x"))["block_connected"]
    row = df.select(got.value.alias("v"), got.error.alias("e")).first()
    return row["v"], row["e"]


def test_header_and_order_of_reasons(spark):
    value, error = read(spark, schema.RAW_HEADER, HEADER, lambda c: normalize.header(c, "h"))
    assert error is None and bytes(value["hash"]) == b"\xab" * 32 and value["height"] == 70_406
    bad = HEADER | {"block_hash": "zz", "prev_block_hash": None, "work": "00"}
    for fixed, reason in (({}, "invalid hex in h.block_hash"), ({"block_hash": B(1)}, "missing h.prev_block_hash"), ({"block_hash": B(1), "prev_block_hash": B(2)}, "h.work must contain 32 bytes, got 1")):
        assert read(spark, schema.RAW_HEADER, bad | fixed, lambda c: normalize.header(c, "h"))[1] == reason
    bare = {"block_hash": B(1), "prev_block_hash": B(2), "work": B(3)}
    value, error = read(spark, schema.RAW_HEADER, bare, lambda c: normalize.header(c, "h"))
    assert error is None and value["height"] == 0 and value["timestamp"] == 0


def test_connected_block(spark):
    events = [{"deposit": DEPOSIT}, {"withdrawal_bundle": SUBMITTED}, {"withdrawal_bundle": {"m6id": "", "event": {"failed": True}}}, {"withdrawal_bundle": SUCCEEDED}]
    value, error = connect(spark, {"bmm_commitment": "", "events": events})
    assert error is None and value["sidechain_number"] == 9 and bytes(value["bmm_commitment"]) == b""
    assert value["events"][0]["deposit"]["value_sats"] == 1_250_009 and value["events"][3]["withdrawal_bundle"]["succeeded"]["sequence_number"] == 906
    assert connect(spark, {"bmm_commitment": None, "events": []})[0]["bmm_commitment"] is None


@pytest.mark.parametrize(
    ("events", "reason"),
    [
        ([{"deposit": DEPOSIT}, {}], "sidechain event 1: missing sidechain event"),
        ([{"deposit": DEPOSIT | {"outpoint": None}}], "sidechain event 0: missing deposit.outpoint"),
        ([{"deposit": DEPOSIT | {"outpoint": {"txid": B(1), "vout": None}}}], "sidechain event 0: missing deposit.outpoint.vout"),
        ([{"deposit": DEPOSIT | {"outpoint": {"txid": "00", "vout": 1}}}], "sidechain event 0: deposit.outpoint.txid must contain 32 bytes, got 1"),
        ([{"withdrawal_bundle": {"m6id": "zz", "event": {}}}], "sidechain event 0: missing withdrawal_bundle.event.state"),
        ([{"withdrawal_bundle": {"m6id": "zz", "event": {"failed": True}}}], "sidechain event 0: invalid hex in withdrawal_bundle.m6id"),
    ],
)
def test_nested_reasons(spark, events, reason):
    assert connect(spark, {"bmm_commitment": None, "events": events}) [1] == reason


def test_commitment_before_events_before_header(spark):
    bad = HEADER | {"block_hash": "x"}
    assert connect(spark, {"bmm_commitment": "x", "events": [{}]}, bad)[1] == "invalid hex in block_info.bmm_commitment"
    assert connect(spark, {"bmm_commitment": None, "events": [{}]}, bad)[1] == "sidechain event 0: missing sidechain event"
    assert connect(spark, {"bmm_commitment": None, "events": []}, bad)[1] == "invalid hex in header_info.block_hash"
    assert connect(spark, {"bmm_commitment": None, "events": []}, None)[1] == "missing connect_block.header_info"


def test_snapshots(spark):
    value, error = read(spark, schema.RAW_PROPOSALS, [PROPOSAL, PROPOSAL | {"declaration": DECLARED}], normalize.sidechain_proposals)
    assert error is None and value["proposals"][1]["declaration"]["v0"]["title"] == "t"
    assert read(spark, schema.RAW_PROPOSALS, [], normalize.sidechain_proposals) [1] is None
    assert read(spark, schema.RAW_PROPOSALS, [PROPOSAL, PROPOSAL | {"vote_count": None}], normalize.sidechain_proposals)[1] == "sidechain proposal 1: missing sidechain_proposal.vote_count"
    assert read(spark, schema.RAW_PROPOSALS, [PROPOSAL | {"declaration": {"v0": None}}], normalize.sidechain_proposals)[1] == "sidechain proposal 0: missing sidechain_proposal.declaration.version"
    assert read(spark, schema.RAW_ACTIVE, [ACTIVE], normalize.active_sidechains)[1] is None
    assert read(spark, schema.RAW_ACTIVE, [ACTIVE | {"activation_height": None, "declaration": {"v0": None}}], normalize.active_sidechains)[1] == "sidechain 0: missing sidechain.activation_height"
    info = {"network": 77, "bip300_constants": CONSTANTS}
    value, error = read(spark, schema.RAW_CHAIN_INFO, info, normalize.chain_info)
    assert error is None and value["network"] == 1 and value["bip300_constants"]["activation_height"] == 1_009
    assert read(spark, schema.RAW_CHAIN_INFO, {"network": 3, "bip300_constants": None}, normalize.chain_info)[1] == "missing chain_info.bip300_constants"
    assert read(spark, schema.RAW_CHAIN_TIP, {"block_header_info": HEADER}, normalize.chain_tip)[1] is None
    assert read(spark, schema.RAW_CHAIN_TIP, {"block_header_info": None}, normalize.chain_tip)[1] == "missing chain_tip.block_header_info"


def test_ctip(spark):
    slot = lambda c: normalize.ctip(F.lit(8).cast("bigint"), c)
    value, error = read(spark, schema.RAW_CTIP, None, slot)
    assert error is None and value["ctip"] is None and value["sidechain_number"] == 8
    value, error = read(spark, schema.RAW_CTIP, {"txid": B(0xE2), "vout": None, "value": 2**64 - 1, "sequence_number": 8}, slot)
    assert error is None and value["ctip"]["vout"] == 0 and value["ctip"]["value_sats"] == 2**64 - 1
    assert read(spark, schema.RAW_CTIP, {"txid": "0x"}, slot)[1] == "invalid hex in ctip.txid"


def test_backfill_equals_live(spark):
    infos = f"array<{schema.RAW_CONNECT}>"
    block = {"header_info": HEADER, "block_info": {"bmm_commitment": B(0xB3), "events": [{"deposit": DEPOSIT}]}}
    value, error = read(spark, infos, [block, block], lambda c: normalize.block_infos(F.lit(9).cast("bigint"), c))
    assert error is None and value[0] == value[1] == connect(spark, block["block_info"])[0]
    assert read(spark, infos, [block, {"header_info": None, "block_info": None}], lambda c: normalize.block_infos(F.lit(9).cast("bigint"), c))[1] == "block info 1: missing header_info"


def test_modes(spark):
    df = spark.createDataFrame([(1, "ab" * 32), (2, "zz")], "t bigint, h string")
    gone = lambda: {"block_disconnected": normalize.Checked(F.struct(F.unhex("h").alias("block_hash"), F.lit(1).cast("bigint").alias("sidechain_number")), F.when(~F.col("h").rlike("[0-9a-f]"), F.lit("bad")))}
    told = normalize.normalized(df, F.col("t"), gone()).orderBy("t").collect()
    assert [(r["error"], r["event"] is None) for r in told] == [(None, False), ("bad", True)]
    with pytest.raises(PySparkException, match="bad"):
        normalize.normalized(df, F.col("t"), gone(), "failfast").collect()
    with pytest.raises(ValueError):
        normalize.normalized(df, F.col("t"), gone(), "other")
    early = normalize.normalized(df.limit(1).withColumn("t", F.lit(-1)), F.col("t"), {}).first()
    assert early["error"] == "system clock is before the Unix epoch"


HEAD = {"hash": b"\xab" * 32, "previous_hash": b"\xaa" * 32, "height": 5, "chain_work": b"\x01" * 32, "timestamp": 7}
PAID = {"deposit": {"sequence_number": 7, "outpoint": {"txid": b"\x11" * 32, "vout": 2}, "address": b"\x01\x02", "value_sats": 2**64 - 1}}
EVENTS = {
    "chain_info": ({"network": 3, "bip300_constants": CONSTANTS}, "network=network_regtest activation_height=1009 withdrawal_bundle_max_age=41"),
    "chain_tip": ({"header": HEAD}, f"height=5 block_hash={B(0xAB)}"),
    "sidechain_proposals": ({"proposals": [{"sidechain_number": 1, "raw_description": b"\xc0", "description_hash": b"\x02" * 32, "vote_count": 1, "proposal_height": 2, "proposal_age": 3, "declaration": {"v0": {"title": "t", "description": "d", "hash_id_1": b"\x01", "hash_id_2": b""}}}]}, "proposal_count=1"),
    "active_sidechains": ({"sidechains": []}, "sidechain_count=0"),
    "ctip": ({"sidechain_number": 9, "ctip": None}, "sidechain=9 present=false"),
    "block_connected": (
        {"header": HEAD, "sidechain_number": 9, "bmm_commitment": b"", "events": [PAID, {"withdrawal_bundle": {"m6id": b"\x05", "succeeded": {"sequence_number": 10, "transaction": b"\x01\x02"}}}, {"withdrawal_bundle": {"m6id": b"", "submitted": True}}]},
        f"sidechain=9 height=5 block_hash={B(0xAB)} deposits=1 withdrawal_bundles=2 bmm_commitment=true",
    ),
    "block_disconnected": ({"block_hash": b"\x4d" * 32, "sidechain_number": 9}, f"sidechain=9 block_hash={B(0x4D)}"),
}


def frame(spark, *events):
    return filled(spark, f"i bigint, event {schema.EVENT}", list(enumerate(events)))


def event(kind, value):
    return {"timestamp": 1700000000000, "enforcer": {kind: value}}


def told(spark, *events):
    e = F.col("event")
    return frame(spark, *events).select("i", summary.kind_of(e).alias("k"), summary.validation_error(e).alias("v"), summary.summary(e).alias("s"), full_json(e).alias("j")).orderBy("i").collect()


def test_one_of_each_kind(spark):
    rows = told(spark, *[event(k, v) for k, (v, _) in EVENTS.items()])
    assert [(r["k"], r["v"], r["s"]) for r in rows] == [(k, None, s) for k, (_, s) in EVENTS.items()]
    for r in rows:
        parsed = json.loads(r["j"])
        assert json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["j"]
        assert list(parsed["monitor_event"]["Enforcer"]["event"]) == ["".join(w.capitalize() for w in r["k"].split("_"))]
    assert '"state":{"Submitted":{}}' in rows[5]["j"] and '"value_sats":18446744073709551615' in rows[5]["j"] and '"ctip":null' in rows[4]["j"]
    assert '"declaration":{"declaration":{"V0":{' in rows[2]["j"]


@pytest.mark.parametrize(
    ("bad", "reason"),
    [
        ({"timestamp": 1, "enforcer": None}, "event holds nothing"),
        ({"timestamp": 1, "enforcer": {}}, "enforcer event has no kind"),
        (event("chain_info", {"network": 9, "bip300_constants": CONSTANTS}), "chain_info.network is no known network"),
        (event("chain_tip", {"header": None}), "missing chain_tip.header"),
        (event("chain_tip", {"header": HEAD | {"previous_hash": b"x"}}), "block_header.previous_hash must contain 32 bytes, got 1"),
        (event("block_disconnected", {"block_hash": b"x" * 31, "sidechain_number": 300}), "block_disconnected.block_hash must contain 32 bytes, got 31"),
        (event("block_connected", {"header": HEAD, "sidechain_number": 1, "events": [{}]}), "sidechain_event is neither deposit nor withdrawal_bundle"),
        (event("block_connected", {"header": HEAD, "sidechain_number": 1, "events": [{"withdrawal_bundle": {"m6id": b""}}]}), "withdrawal_bundle has no state"),
        (event("active_sidechains", {"sidechains": [{"sidechain_number": 1, "declaration": {"v0": None}}]}), "declaration has no version that is known"),
    ],
)
def test_consumer_rejects(spark, bad, reason):
    row = told(spark, bad)[0]
    assert row["v"] == reason and row["s"] is None


def test_consumer_accepts_what_it_need_not_know(spark):
    assert told(spark, event("block_disconnected", {"block_hash": b"x" * 32, "sidechain_number": 300}))[0]["v"] is None


def test_wire_round_trip(spark):
    df = frame(spark, *[event(k, v) for k, (v, _) in EVENTS.items()], None)
    back = protobuf.decode(protobuf.encode(df)).orderBy("i").collect()
    assert [r["decode_error"] for r in back] == [None] * 8 and back[-1]["payload_len"] is None and back[-1]["event"] is None
    before = [r["j"] for r in told(spark, *[event(k, v) for k, (v, _) in EVENTS.items()])]
    again = protobuf.decode(protobuf.encode(df)).select("i", full_json(F.col("event")).alias("j")).orderBy("i").collect()
    assert [r["j"] for r in again][:-1] == before


def test_bad_payloads_are_data(spark):
    good = protobuf.encoder()(event("ctip", {"sidechain_number": 9, "ctip": None}))
    df = spark.createDataFrame([(0, b"\xff\x00"), (1, b""), (2, good), (3, None)], "i bigint, payload binary")
    rows = protobuf.decode(df).orderBy("i").collect()
    assert [(r["decode_error"] is not None, r["payload_len"]) for r in rows] == [(True, 2), (False, 0), (False, len(good)), (False, None)]
    assert rows[1]["event"]["enforcer"] is None and rows[2]["event"]["enforcer"]["ctip"]["sidechain_number"] == 9


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40), st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1))
def test_any_value_survives_the_wire(raw, small, large):
    row = event("ctip", {"sidechain_number": small, "ctip": {"txid": raw, "vout": small, "value_sats": large, "sequence_number": large}})
    again = protobuf.reader()(protobuf.event_class().FromString(protobuf.encoder()(row)))
    assert again["enforcer"]["ctip"] == row["enforcer"]["ctip"] and again["timestamp"] == row["timestamp"]


def test_bytes_are_those_of_the_library(spark):
    rows = [event(k, v) for k, (v, _) in EVENTS.items()] + [event("chain_info", {"network": -3}), {"timestamp": None, "enforcer": None}, event("chain_tip", {"header": {"height": 2**32 - 1}})]
    for row in rows:
        raw = protobuf.encoder()(row)
        parsed = protobuf.event_class().FromString(raw)
        assert parsed.SerializeToString(deterministic=True) == raw


def test_byte_fields(spark):
    assert schema.byte_fields() == {"address", "block_hash", "bmm_commitment", "chain_work", "description_hash", "hash", "hash_id_1", "hash_id_2", "m6id", "previous_hash", "raw_description", "transaction", "txid"}
