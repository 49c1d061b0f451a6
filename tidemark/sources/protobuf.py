"""Events on the wire: protobuf payloads to typed rows and back.

The message types are described here and built at run time; no generated code. Only this module lets Python touch rows: Spark's
own protobuf functions need a jar that is not part of the distribution. Batches travel as Arrow.
"""

from collections.abc import Iterator
from decimal import Decimal
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.sources import schema

# The wire format. message: (number, field, type[, group]); a trailing * repeats, a ? marks presence.
MESSAGES = {
    "Bip300Constants": [(i + 1, c, "uint32") for i, c in enumerate(schema.CONSTANTS)],
    "ChainInfo": [(1, "network", "int32"), (2, "bip300_constants", "Bip300Constants")],
    "BlockHeader": [(1, "hash", "bytes"), (2, "previous_hash", "bytes"), (3, "height", "uint32"), (4, "chain_work", "bytes"), (5, "timestamp", "uint64")],
    "ChainTip": [(1, "header", "BlockHeader")],
    "SidechainDeclarationV0": [(1, "title", "string"), (2, "description", "string"), (3, "hash_id_1", "bytes"), (4, "hash_id_2", "bytes")],
    "SidechainDeclaration": [(1, "v0", "SidechainDeclarationV0", "declaration")],
    "SidechainProposal": [(1, "sidechain_number", "uint32"), (2, "raw_description", "bytes"), (3, "description_hash", "bytes"), (4, "vote_count", "uint32"), (5, "proposal_height", "uint32"), (6, "proposal_age", "uint32"), (7, "declaration", "SidechainDeclaration")],
    "SidechainProposalsSnapshot": [(1, "proposals", "SidechainProposal*")],
    "ActiveSidechain": [(1, "sidechain_number", "uint32"), (2, "raw_description", "bytes"), (3, "vote_count", "uint32"), (4, "proposal_height", "uint32"), (5, "activation_height", "uint32"), (6, "declaration", "SidechainDeclaration")],
    "ActiveSidechainsSnapshot": [(1, "sidechains", "ActiveSidechain*")],
    "Ctip": [(1, "txid", "bytes"), (2, "vout", "uint32"), (3, "value_sats", "uint64"), (4, "sequence_number", "uint64")],
    "CtipSnapshot": [(1, "sidechain_number", "uint32"), (2, "ctip", "Ctip")],
    "OutPoint": [(1, "txid", "bytes"), (2, "vout", "uint32")],
    "Deposit": [(1, "sequence_number", "uint64"), (2, "outpoint", "OutPoint"), (3, "address", "bytes"), (4, "value_sats", "uint64")],
    "WithdrawalBundleSubmitted": [],
    "WithdrawalBundleFailed": [],
    "WithdrawalBundleSucceeded": [(1, "sequence_number", "uint64"), (2, "transaction", "bytes")],
    "WithdrawalBundleEvent": [(1, "m6id", "bytes"), (2, "submitted", "WithdrawalBundleSubmitted", "state"), (3, "failed", "WithdrawalBundleFailed", "state"), (4, "succeeded", "WithdrawalBundleSucceeded", "state")],
    "SidechainEvent": [(1, "deposit", "Deposit", "event"), (2, "withdrawal_bundle", "WithdrawalBundleEvent", "event")],
    "BlockConnected": [(1, "header", "BlockHeader"), (2, "sidechain_number", "uint32"), (3, "bmm_commitment", "bytes?"), (4, "events", "SidechainEvent*")],
    "BlockDisconnected": [(1, "block_hash", "bytes"), (2, "sidechain_number", "uint32")],
    "EnforcerEvent": [
        (1, "chain_info", "ChainInfo", "event"), (2, "chain_tip", "ChainTip", "event"), (3, "sidechain_proposals", "SidechainProposalsSnapshot", "event"),
        (4, "active_sidechains", "ActiveSidechainsSnapshot", "event"), (5, "ctip", "CtipSnapshot", "event"), (6, "block_connected", "BlockConnected", "event"), (7, "block_disconnected", "BlockDisconnected", "event"),
    ],
    "Event": [(10, "timestamp", "uint64"), (1, "enforcer", "EnforcerEvent", "monitor_event")],
}


@cache
def event_class():
    """The message class of an event."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    file = descriptor_pb2.FileDescriptorProto(name="tidemark_event.proto", package="tidemark", syntax="proto3")
    plain = descriptor_pb2.FieldDescriptorProto
    for name, fields in MESSAGES.items():
        message = file.message_type.add(name=name)
        groups = list(dict.fromkeys(f[3] for f in fields if len(f) > 3))
        present = [f[1] for f in fields if f[2].endswith("?")]
        for g in groups + [f"_{p}" for p in present]:
            message.oneof_decl.add(name=g)
        for number, field, kind, *group in fields:
            base = kind.rstrip("*?")
            out = message.field.add(name=field, number=number, label=plain.LABEL_REPEATED if kind.endswith("*") else plain.LABEL_OPTIONAL)
            if base in MESSAGES:
                out.type, out.type_name = plain.TYPE_MESSAGE, f".tidemark.{base}"
            else:
                out.type = getattr(plain, f"TYPE_{base.upper()}")
            if group:
                out.oneof_index = groups.index(group[0])
            elif kind.endswith("?"):
                out.proto3_optional, out.oneof_index = True, len(groups) + present.index(field)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("tidemark.Event"))


def _varint(n: int) -> bytes:
    """A number on the wire; a negative one as 64 bits."""
    n &= 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


_SMALL = [_varint(i) for i in range(1 << 14)]


def _size(n: int) -> bytes:
    return _SMALL[n] if 0 <= n < 1 << 14 else _varint(n)


@cache
def encoder(name: str = "Event"):
    """A function from a row of the message (a dict; missing and null fields are unset) to its bytes, fields in the order of their numbers."""
    steps = []
    for number, field, kind, *group in sorted(MESSAGES[name]):
        base = kind.rstrip("*?")
        varint = base in ("int32", "uint32", "uint64")
        always = bool(group) or kind.endswith("?")
        steps.append((field, _varint(number << 3 | (0 if varint else 2)), varint, always, base == "string", kind.endswith("*"), encoder(base) if base in MESSAGES else None))

    def write(row: dict) -> bytes:
        out = []
        for field, tag, varint, always, text, many, inner in steps:
            value = row.get(field)
            if value is None:
                continue
            if inner is not None:
                for v in value if many else (value,):
                    raw = b"" if v is True else inner(v)
                    out += (tag, _size(len(raw)), raw)
            elif varint:
                value = int(value)
                if value or always:
                    out += (tag, _size(value))
            elif value or always:
                raw = value.encode() if text else value
                out += (tag, _size(len(raw)), raw)
        return b"".join(out)

    return write


@cache
def reader(name: str = "Event"):
    """A function from a message to a row of it; unset members of a group and unset messages are null, other unset fields their
    default, numbers of 64 bits decimals. A message without fields is true."""
    if not MESSAGES[name]:
        return lambda message: True
    steps = []
    for _, field, kind, *_ in MESSAGES[name]:
        base = kind.rstrip("*?")
        steps.append((field, kind.endswith("*"), base in MESSAGES or kind.endswith("?"), reader(base) if base in MESSAGES else Decimal if base == "uint64" else None))

    def read(message) -> dict:
        out = {}
        for field, many, presence, inner in steps:
            if presence and not many and not message.HasField(field):
                out[field] = None
                continue
            value = getattr(message, field)
            out[field] = [inner(v) for v in value] if many else inner(value) if inner else value
        return out

    return read


def encode(df: DataFrame, event: str = "event", payload: str = "payload") -> DataFrame:
    """All other columns, and the event as wire bytes; a null event is a null payload."""
    rest = [c for c in df.columns if c != event]
    out = T.StructType([*[df.schema[c] for c in rest], T.StructField(payload, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = encoder()
        for b in batches:
            raw = [None if r is None else write(r) for r in b.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(raw, pa.binary())], [*rest, payload])

    return df.select(*rest, event).mapInArrow(run, out)


def decode(df: DataFrame, payload: str = "payload", event: str = "event") -> DataFrame:
    """All other columns, ``event``, ``decode_error`` and ``payload_len``.

    What cannot be decoded is data: a null event and a reason; it ends nothing. Empty bytes are an event without a kind. A null
    payload has a null event, no reason and a null length.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rest = [c for c in df.columns if c != payload]
    kind = schema.event_type()
    out = T.StructType([*[df.schema[c] for c in rest], T.StructField(event, kind), T.StructField("decode_error", T.StringType()), T.StructField("payload_len", T.LongType())])
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.message import DecodeError

        parse, read = event_class().FromString, reader()
        for b in batches:
            events, errors, sizes = [], [], []
            for raw in b.column(len(rest)).to_pylist():
                row = error = None
                if raw is not None:
                    try:
                        row = read(parse(raw))
                    except DecodeError as e:
                        error = f"invalid payload: {e}"
                events.append(row)
                errors.append(error)
                sizes.append(None if raw is None else len(raw))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(events, arrow), pa.array(errors, pa.string()), pa.array(sizes, pa.int64())], out.names)

    return df.select(*rest, payload).mapInArrow(run, out)
