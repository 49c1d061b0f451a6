"""The queries of the snapshot kinds and of rejections as SQL for DuckDB."""

from tidemark.queries.feed_sql import _hash, _hex
from tidemark.queries.monitor_sql import _bad, _missing
from tidemark.queries.states import NEARLY_FULL
from tidemark.sources.schema import NETWORKS


def _declared(path: str) -> str:
    parts = [_missing(f"declaration.{c}", f"{path}.declaration.{c}") for c in ("title", "description")] + [_bad(f"declaration.{c}", f"{path}.declaration.{c}", None) for c in ("hash_id_1", "hash_id_2")]
    return f"case when declaration is not null then coalesce({', '.join(parts)}) end"


def _item(path: str, digest: bool, age: str) -> str:
    numbers = [_missing(c, f"{path}.{c}") for c in ("vote_count", "proposal_height", age)]
    parts = [_missing("sidechain_number", f"{path}.sidechain_number"), _bad("description", f"{path}.description", None)]
    return f"coalesce({', '.join(parts + ([_bad('description_hash', f'{path}.description_sha256d_hash')] if digest else []) + numbers + [_declared(path)])})"


_P, _A = _item("sidechain_proposal", True, "proposal_age"), _item("sidechain", False, "activation_height")


def _size(c: str) -> str:
    return f"case when regexp_full_match({_hex(c)}, '([0-9a-f]{{2}})*') then length({_hex(c)}) // 2 else 0 end"


def _sized(c: str, field: str) -> str:
    return f"case when {_size(c)} <> 32 then '{field} must contain 32 bytes, got ' || ({_size(c)}) end"


_H = "block_connected.header"
_REJECTED = f"""
careless as (
  select arrival_seq, kind, {_hash("coalesce(block_connected.header.hash, block_disconnected.block_hash)")} is null and kind <> 'ctip' as damaged, case kind
    when 'block_connected' then coalesce({_missing(_H, "block_connected.header")}, {_sized(f"{_H}.hash", "block_header.hash")}, {_sized(f"{_H}.previous_hash", "block_header.previous_hash")},
      {_sized(f"{_H}.chain_work", "block_header.chain_work")}, list_filter(list_transform(block_connected.events, lambda e: case
        when e.deposit is not null then coalesce({_missing("e.deposit.outpoint", "deposit.outpoint")}, {_sized("e.deposit.outpoint.txid", "deposit.outpoint.txid")})
        when e.withdrawal is not null then case when coalesce(e.withdrawal.state, '') not in ('submitted', 'succeeded') then 'withdrawal_bundle has no state' end
        else 'sidechain_event is neither deposit nor withdrawal_bundle' end), lambda x: x is not null)[1])
    when 'block_disconnected' then {_sized("block_disconnected.block_hash", "block_disconnected.block_hash")}
    else case when ctip.ctip is not null then {_sized("ctip.ctip.txid", "ctip.txid")} end end as rejected
  from enforcer_feed)
"""

_TIP = "h.head"
SQL = {
    "normalize_proposals": f"select snapshot_id, sidechain_number, description_hash, {_P} as error from proposal_snapshots",
    "normalize_active": f"select snapshot_id, sidechain_number, description, {_A} as error from active_snapshots",
    "consumer_rejects": f"with {_REJECTED} select arrival_seq, kind, rejected from careless where rejected is not null",
    "invalid_total": f"""with {_REJECTED} select arrival_seq, least({NEARLY_FULL}::hugeint + sum(case when damaged or rejected is not null then 1 else 0 end) over (order by arrival_seq), {2**64 - 1}::hugeint)::varchar as invalid_total from careless""",
    "render_snapshots": f"""
        with heads as (select {_hash("hash")} as h, arg_min({{hash: hash, previous_hash: previous_hash, height: height, work: chain_work}}, header_row_id) as head from block_headers where {_hash("hash")} is not null group by 1),
        tips as (
          select snapshot_id, head, coalesce({_missing(_TIP, "chain_tip.block_header_info")}, {_bad(f"{_TIP}.hash", "chain_tip.block_header_info.block_hash")},
            {_bad(f"{_TIP}.previous_hash", "chain_tip.block_header_info.prev_block_hash")}, {_bad(f"{_TIP}.work", "chain_tip.block_header_info.work")}) as rejected
          from snapshot_runs r left join heads h on h.h = {_hash("tip_hash")}),
        infos as (select *, case when ctip_count > 2 then null else 'missing chain_info.bip300_constants' end as rejected from snapshot_runs)
        select snapshot_id, 'chain_info' as kind, rejected, case when rejected is null then 'network=' || {list(NETWORKS)}[case when proposal_count between 1 and 6 then proposal_count else 2 end]
          || ' activation_height=' || tip_height || ' withdrawal_bundle_max_age=' || sidechain_count end as summary from infos
        union all select snapshot_id, 'chain_tip', rejected, case when rejected is null then 'height=' || coalesce(head.height, 0) || ' block_hash=' || lower(head.hash) end from tips
        union all select snapshot_id, 'sidechain_proposals', null, 'proposal_count=' || count(*) from proposal_snapshots where {_P} is null group by 1
        union all select snapshot_id, 'active_sidechains', null, 'sidechain_count=' || count(*) from active_snapshots where {_A} is null group by 1""",
}
