"""The two schemas of the event contract: what the validator sends and what the engine keeps.

Messages become structs with nullable fields; of a "one of" group exactly one field is set. Unsigned 32-bit numbers are
bigint, unsigned 64-bit ones decimal(20,0). A message without fields is a boolean marker.
"""

from pyspark.sql import types as T

U64 = "decimal(20,0)"

# As received: hex is text, everything may be missing.
RAW_HEADER = f"struct<block_hash:string,prev_block_hash:string,height:bigint,work:string,timestamp:{U64}>"
RAW_DECLARATION = "struct<v0:struct<title:string,description:string,hash_id_1:string,hash_id_2:string>>"
RAW_DEPOSIT = f"struct<sequence_number:{U64},outpoint:struct<txid:string,vout:bigint>,output:struct<address:string,value_sats:{U64}>>"
RAW_WITHDRAWAL = f"struct<m6id:string,event:struct<failed:boolean,succeeded:struct<sequence_number:{U64},transaction:string>,submitted:boolean>>"
RAW_BLOCK = f"struct<bmm_commitment:string,events:array<struct<deposit:{RAW_DEPOSIT},withdrawal_bundle:{RAW_WITHDRAWAL}>>>"
RAW_CONNECT = f"struct<header_info:{RAW_HEADER},block_info:{RAW_BLOCK}>"
RAW_SUBSCRIPTION = f"struct<connect_block:{RAW_CONNECT},disconnect_block:struct<block_hash:string>>"
CONSTANTS = (
    "withdrawal_bundle_max_age", "withdrawal_bundle_inclusion_threshold", "used_sidechain_slot_proposal_max_age", "used_sidechain_slot_activation_threshold",
    "unused_sidechain_slot_proposal_max_age", "unused_sidechain_slot_activation_threshold", "activation_height",
)
RAW_CONSTANTS = "struct<" + ",".join(f"{c}:bigint" for c in CONSTANTS) + ">"
RAW_CHAIN_INFO = f"struct<network:int,bip300_constants:{RAW_CONSTANTS}>"
RAW_CHAIN_TIP = f"struct<block_header_info:{RAW_HEADER}>"
RAW_PROPOSALS = f"array<struct<sidechain_number:bigint,description:string,declaration:{RAW_DECLARATION},description_sha256d_hash:string,vote_count:bigint,proposal_height:bigint,proposal_age:bigint>>"
RAW_ACTIVE = f"array<struct<sidechain_number:bigint,description:string,vote_count:bigint,proposal_height:bigint,activation_height:bigint,declaration:{RAW_DECLARATION}>>"
RAW_CTIP = f"struct<txid:string,vout:bigint,value:{U64},sequence_number:{U64}>"

# As kept: bytes, and the fields of each kind checked.
HEADER = f"struct<hash:binary,previous_hash:binary,height:bigint,chain_work:binary,timestamp:{U64}>"
DECLARATION = "struct<v0:struct<title:string,description:string,hash_id_1:binary,hash_id_2:binary>>"
DEPOSIT = f"struct<sequence_number:{U64},outpoint:struct<txid:binary,vout:bigint>,address:binary,value_sats:{U64}>"
WITHDRAWAL = f"struct<m6id:binary,submitted:boolean,failed:boolean,succeeded:struct<sequence_number:{U64},transaction:binary>>"
KINDS = {
    "chain_info": f"struct<network:int,bip300_constants:{RAW_CONSTANTS}>",
    "chain_tip": f"struct<header:{HEADER}>",
    "sidechain_proposals": f"struct<proposals:array<struct<sidechain_number:bigint,raw_description:binary,description_hash:binary,vote_count:bigint,proposal_height:bigint,proposal_age:bigint,declaration:{DECLARATION}>>>",
    "active_sidechains": f"struct<sidechains:array<struct<sidechain_number:bigint,raw_description:binary,vote_count:bigint,proposal_height:bigint,activation_height:bigint,declaration:{DECLARATION}>>>",
    "ctip": f"struct<sidechain_number:bigint,ctip:struct<txid:binary,vout:bigint,value_sats:{U64},sequence_number:{U64}>>",
    "block_connected": f"struct<header:{HEADER},sidechain_number:bigint,bmm_commitment:binary,events:array<struct<deposit:{DEPOSIT},withdrawal_bundle:{WITHDRAWAL}>>>",
    "block_disconnected": "struct<block_hash:binary,sidechain_number:bigint>",
}
ENFORCER = "struct<" + ",".join(f"{k}:{t}" for k, t in KINDS.items()) + ">"
#: timestamp: when the monitor saw it, in milliseconds
EVENT = f"struct<timestamp:{U64},enforcer:{ENFORCER}>"

# Network numbers in order, from 0.
NETWORKS = ("network_unspecified", "network_unknown", "network_mainnet", "network_regtest", "network_signet", "network_testnet")


def event_type() -> T.StructType:
    """EVENT as a type; needs an active session."""
    return T.StructType.fromDDL(EVENT.removeprefix("struct<").removesuffix(">"))


def byte_fields(kind: T.DataType | None = None) -> set[str]:
    """Names of all fields that hold bytes, wherever they are nested."""
    kind = event_type() if kind is None else kind
    if isinstance(kind, T.ArrayType):
        return byte_fields(kind.elementType)
    if not isinstance(kind, T.StructType):
        return set()
    own = {f.name for f in kind.fields if isinstance(f.dataType, T.BinaryType)}
    return own.union(*[byte_fields(f.dataType) for f in kind.fields])
