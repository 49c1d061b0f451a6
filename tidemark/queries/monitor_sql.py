"""The queries of the event contract and of operations as SQL for DuckDB."""

from tidemark.queries.feed_sql import _MESSAGES, _hash
from tidemark.queries.monitor import ANCESTORS, LEAST_HEIGHT, SLOTS, SUBJECT


def _bad(c: str, field: str, size: int | None = 32) -> str:
    """Why strict hex text is rejected."""
    length = f" when length({c}) <> {2 * size} then '{field} must contain {size} bytes, got ' || (length({c}) // 2)" if size else ""
    return f"case when {c} is null then 'missing {field}' when not regexp_full_match({c}, '([0-9A-Fa-f]{{2}})*') then 'invalid hex in {field}'{length} end"


def _missing(c: str, field: str) -> str:
    return f"case when {c} is null then 'missing {field}' end"


_DEPOSIT = f"""coalesce({_missing("e.deposit.outpoint", "deposit.outpoint")}, {_missing('e.deposit."output"', "deposit.output")}, {_missing("e.deposit.sequence_number", "deposit.sequence_number")},
  {_bad("e.deposit.outpoint.txid", "deposit.outpoint.txid")}, {_missing("e.deposit.outpoint.vout", "deposit.outpoint.vout")},
  {_bad('e.deposit."output".address', "deposit.output.address", None)}, {_missing('e.deposit."output".value_sats', "deposit.output.value_sats")})"""
_BUNDLE = f"""coalesce(case when e.withdrawal.state not in ('submitted', 'failed', 'succeeded') or e.withdrawal.state is null then 'missing withdrawal_bundle.event.state' end,
  case when e.withdrawal.state = 'succeeded' and e.withdrawal.sequence_number is null then 'missing withdrawal_bundle.succeeded.sequence_number' end, {_bad("e.withdrawal.m6id", "withdrawal_bundle.m6id", None)})"""
_EVENT = f"case when e.deposit is not null then {_DEPOSIT} when e.withdrawal is not null then {_BUNDLE} else 'missing sidechain event' end"
_EVENTS = f"""list_filter(list_transform(block_connected.events, lambda e, i: case when ({_EVENT}) is not null then 'sidechain event ' || (i - 1) || ': ' || ({_EVENT}) end), lambda x: x is not null)[1]"""
_H = "block_connected.header"

_TOLD = f"""
told as (
  select *, coalesce(
    case when kind = 'block_connected' then coalesce(
      case when {_H} is null then 'missing connect_block.header_info' end,
      case when block_connected.bmm_commitment is not null then {_bad("block_connected.bmm_commitment", "block_info.bmm_commitment", None)} end,
      {_EVENTS}, {_bad(f"{_H}.hash", "header_info.block_hash")}, {_bad(f"{_H}.previous_hash", "header_info.prev_block_hash")}, {_bad(f"{_H}.chain_work", "header_info.work")})
    when kind = 'block_disconnected' then {_bad("block_disconnected.block_hash", "disconnect_block.block_hash")}
    when ctip.ctip is not null then {_bad("ctip.ctip.txid", "ctip.txid")} end,
    case when event_ms < 0 then 'system clock is before the Unix epoch' end) as error
  from enforcer_feed)
"""

_SUMMARY = f"""
select arrival_seq, kind, case kind
  when 'block_connected' then 'sidechain=' || block_connected.sidechain_number || ' height=' || coalesce({_H}.height, 0) || ' block_hash=' || lower({_H}.hash)
    || ' deposits=' || len(list_filter(block_connected.events, lambda e: e.deposit is not null))
    || ' withdrawal_bundles=' || len(list_filter(block_connected.events, lambda e: e.withdrawal is not null))
    || ' bmm_commitment=' || case when block_connected.bmm_commitment is null then 'false' else 'true' end
  when 'block_disconnected' then 'sidechain=' || block_disconnected.sidechain_number || ' block_hash=' || lower(block_disconnected.block_hash)
  else 'sidechain=' || ctip.sidechain_number || case when ctip.ctip is null then ' present=false' else
    ' present=true txid=' || lower(ctip.ctip.txid) || ' vout=' || coalesce(ctip.ctip.vout, 0) || ' value_sats=' || coalesce(ctip.ctip.value, 0)::varchar || ' sequence_number=' || coalesce(ctip.ctip.sequence_number, 0)::varchar end
  end as summary
from told where error is null"""


def _quoted(c: str) -> str:
    return f"""'"' || lower({c}) || '"'"""


_ONE_EVENT = f"""case when e.deposit is not null then '{{"event":{{"Deposit":{{"address":' || {_quoted('e.deposit."output".address')} || ',"outpoint":{{"txid":' || {_quoted("e.deposit.outpoint.txid")} || ',"vout":' || e.deposit.outpoint.vout
  || '}},"sequence_number":' || e.deposit.sequence_number::varchar || ',"value_sats":' || e.deposit."output".value_sats::varchar || '}}}}}}'
  else '{{"event":{{"WithdrawalBundle":{{"m6id":' || {_quoted("e.withdrawal.m6id")} || ',"state":{{' || case e.withdrawal.state when 'submitted' then '"Submitted":{{}}' when 'failed' then '"Failed":{{}}'
    else '"Succeeded":{{"sequence_number":' || e.withdrawal.sequence_number::varchar || ',"transaction":""}}' end || '}}}}}}}}' end"""

_JSON = f"""
select arrival_seq, '{{"monitor_event":{{"Enforcer":{{"event":{{' || case kind
  when 'block_connected' then '"BlockConnected":{{"bmm_commitment":' || coalesce({_quoted("block_connected.bmm_commitment")}, 'null') || ',"events":[' || array_to_string(list_transform(block_connected.events, lambda e: @ONE@), ',')
    || '],"header":{{"chain_work":' || {_quoted(f"{_H}.chain_work")} || ',"hash":' || {_quoted(f"{_H}.hash")} || ',"height":' || coalesce({_H}.height, 0) || ',"previous_hash":' || {_quoted(f"{_H}.previous_hash")}
    || ',"timestamp":' || coalesce({_H}.header_time, 0)::varchar || '}},"sidechain_number":' || block_connected.sidechain_number || '}}'
  when 'block_disconnected' then '"BlockDisconnected":{{"block_hash":' || {_quoted("block_disconnected.block_hash")} || ',"sidechain_number":' || block_disconnected.sidechain_number || '}}'
  else '"Ctip":{{"ctip":' || case when ctip.ctip is null then 'null' else '{{"sequence_number":' || ctip.ctip.sequence_number::varchar || ',"txid":' || {_quoted("ctip.ctip.txid")} || ',"value_sats":' || ctip.ctip.value::varchar || ',"vout":' || ctip.ctip.vout || '}}' end
    || ',"sidechain_number":' || ctip.sidechain_number || '}}' end || '}}}}}},"timestamp":' || event_ms::varchar || '}}' as full_json
from told where error is null""".replace("@ONE@", _ONE_EVENT)

_BLOCKS = "blocks as (select * from messages where token is not null and kind <> 'ctip')"

_STATES = """
states as (
  select event_id, event_type, user_id, try_cast(props::json->>'k' as bigint) as k from events)
"""

SQL = {
    "normalize_feed": f"with {_TOLD} select arrival_seq, kind, error from told",
    "render_summary": f"with {_TOLD} {_SUMMARY}",
    "render_json": f"with {_TOLD} {_JSON}",
    "payload_round_trip": f"with {_TOLD} {_SUMMARY}",
    "decode_permissive": f"""with {_TOLD} select arrival_seq, error is null and slot is distinct from 9 as decoded, case when error is not null then cast(2 as bigint) end as bad_length,
        case when error is null and slot = 9 then cast(1 as bigint) end as lacking
        from (select *, coalesce(block_connected.sidechain_number, block_disconnected.sidechain_number, ctip.sidechain_number) as slot from told)""",
    "observation_ms": "select arrival_seq, epoch_us(arrival_ts) // 1000 as observed_ms from enforcer_feed",
    "network_codes": "select o_orderkey, cast(case when length(o_orderpriority) - 6 between 0 and 5 then length(o_orderpriority) - 6 else 1 end as bigint) as network from orders",
    "block_counts": """select arrival_seq, cast(len(list_filter(block_connected.events, lambda e: e.deposit is not null)) as bigint) as deposits,
        cast(len(list_filter(block_connected.events, lambda e: e.withdrawal is not null)) as bigint) as withdrawal_bundles from enforcer_feed where kind = 'block_connected'""",
    "nested_deposit_totals": """select deploy_id, slot, cast(coalesce(sum(e.deposit."output".value_sats), 0) as bigint) as deposited
        from (select deploy_id, block_connected.sidechain_number as slot, unnest(case when len(block_connected.events) > 0 then block_connected.events else [null] end) as e
              from enforcer_feed where kind = 'block_connected') group by 1, 2""",
    "dedupe_idempotent": f"with {_MESSAGES}, {_BLOCKS} select deploy_id, kind, slot, token as hash, min(arrival_seq) as arrival_seq from blocks group by all",
    "canonical_blocks": f"""with {_MESSAGES}, {_BLOCKS}, ranked as (select *, row_number() over (partition by deploy_id, slot, token order by arrival_seq desc) as k from blocks)
        select deploy_id, slot, token as hash, height from ranked where k = 1 and kind = 'block_connected'""",
    "latest_snapshot": """select deploy_id, snapshot_id, tip_height, proposal_count, sidechain_count, ctip_count from snapshot_runs
        qualify row_number() over (partition by deploy_id order by snapshot_at desc, snapshot_id desc) = 1""",
    "ctip_presence": """select deploy_id, ctip.sidechain_number as slot, ctip.ctip is not null as present, cast(ctip.ctip.value as bigint) as value_sats from enforcer_feed where kind = 'ctip'
        qualify row_number() over (partition by deploy_id, ctip.sidechain_number order by arrival_seq desc) = 1""",
    "distinct_blocks": f"with {_MESSAGES}, {_BLOCKS} select deploy_id, count(distinct token) as blocks from blocks where kind = 'block_connected' group by 1",
    "kind_dispatch": """select kind, count(*) as messages, count(distinct coalesce(block_connected.sidechain_number, block_disconnected.sidechain_number, ctip.sidechain_number)) as slots,
        count(*) filter (case kind when 'block_connected' then block_connected is not null when 'block_disconnected' then block_disconnected is not null else ctip is not null end) as payloads
        from enforcer_feed group by 1""",
    "tip_consistency": f"""with {_MESSAGES}, {_BLOCKS},
        tips as (select snapshot_id, deploy_id, {_hash("tip_before")} as a, {_hash("tip_hash")} as b, {_hash("tip_after")} as c from snapshot_runs)
        select snapshot_id, coalesce(a = b and b = c, false) as consistent,
          exists (select 1 from blocks where kind = 'block_connected' and blocks.deploy_id = tips.deploy_id and token = b) as seen_live from tips""",
    "invalid_running_count": f"with {_TOLD} select arrival_seq, cast(sum(case when error is null then 0 else 1 end) over (order by arrival_seq) as bigint) as invalid_total from told",
    "slot_fanout": f"""select hash, cast(slot as bigint) as slot from (select distinct {_hash("hash")} as hash from block_headers where {_hash("hash")} is not null)
        cross join (select unnest({SLOTS}) as slot)""",
    "snapshot_batch": f"""
        with latest as (
          select snapshot_id, sidechain_number, arg_max(v, row(loaded_at, v)) as v
          from (select *, row(ctip is not null, {_hash("ctip.txid")}, ctip.vout, ctip.value, ctip.sequence_number) as v from ctip_snapshots) group by 1, 2)
        select snapshot_id, cast(1 as bigint) as seq, 'chain_tip' as kind, 'height=' || tip_height || ' block_hash=' || {_hash("tip_hash")} as summary from snapshot_runs
        union all select snapshot_id, 2, 'sidechain_proposals', 'proposal_count=' || proposal_count from snapshot_runs
        union all select snapshot_id, 3, 'active_sidechains', 'sidechain_count=' || sidechain_count from snapshot_runs
        union all select snapshot_id, 3 + row_number() over (partition by snapshot_id order by sidechain_number), 'ctip',
          case when v[1] then 'sidechain=' || sidechain_number || ' present=true txid=' || v[2] || ' vout=' || v[3] || ' value_sats=' || v[4]::varchar || ' sequence_number=' || v[5]::varchar
            else 'sidechain=' || sidechain_number || ' present=false' end from latest""",
    "history_ready": f"with {_STATES} select event_id, event_type = 'click' as ready from states",
    "history_summary": f"""with {_STATES}
        select event_id, event_type = 'click' as history_ready, cast(case when event_type in ('click', 'view') then 1 when event_type = 'purchase' then 2 else 0 end as bigint) as chainstate_count,
          case when event_type in ('click', 'view', 'purchase') then k end as historical_blocks,
          case when event_type in ('click', 'view') then k when event_type = 'purchase' then user_id end as active_blocks,
          cast(case when event_type = 'purchase' then user_id - k else 0 end as bigint) as remaining_blocks from states""",
    "prefix_filter": "select court_code, court_name from courts where starts_with(court_name, 'R')",
    "chain_brief": """select snapshot_id, case when proposal_count > 1 then '{"chain":"main","blocks":' || tip_height || ',"headers":' || (tip_height + ctip_count)
        || ',"verificationprogress":null,"initialblockdownload":' || (ctip_count > 4) || '}' end as brief from snapshot_runs""",
    "peer_briefs": """select snapshot_id, case when ctip_count > 4 then '[' || array_to_string(list_transform([ctip_count, proposal_count],
        lambda n: '{"addr":"10.0.0.' || n || '","inbound":true,"startingheight":null,"synced_headers":null,"synced_blocks":' || tip_height || '}'), ',') || ']' else '[]' end as peers from snapshot_runs""",
    "subscriptions_on": f"""select snapshot_id, '[' || array_to_string(list_transform(list_filter([proposal_count, sidechain_count], lambda n: 'feed.blocks.' || n = '{SUBJECT}'),
        lambda n: '{{"account":"A","subject":"{SUBJECT}","msgs":' || tip_height || '}}'), ',') || ']' as told from snapshot_runs""",
    "subject_filter": "select arrival_seq, deploy_id from enforcer_feed where kind = 'block_disconnected'",
    "nested_exists": "select arrival_seq from enforcer_feed where len(list_filter(block_connected.events, lambda e: e.withdrawal.state = 'failed')) > 0",
    "node_ready": f"select snapshot_id, coalesce(ctip_count > 4 and tip_height >= {LEAST_HEIGHT} and tip_height + proposal_count - 3 >= {LEAST_HEIGHT} and not ({_hash('tip_hash')} <> {_hash('tip_before')}) and sidechain_count > 2, false) as ready from snapshot_runs",
    "tip_agreement": f"""select snapshot_id, tip_height as height, {_hash("tip_hash")} as hash from snapshot_runs
        where exists (select 1 from block_headers b where b.height = tip_height and {_hash("b.hash")} = {_hash("tip_hash")})""",
    "log_match": f"""with {_MESSAGES}, {_BLOCKS}, lines as (
          select arrival_seq, token, 'published ' || replace(kind, '_', ' ') || ' sidechain=' || slot || ' block_hash=' || token as line from blocks)
        select arrival_seq, line from lines where contains(line, 'block connected') and contains(line, token) and regexp_matches(line, '(^|[\\s"])sidechain=9([^0-9]|$)')""",
    "undelivered": f"""with {_MESSAGES}, {_BLOCKS}, told as (select * from blocks where kind = 'block_connected'),
        newest as (select deploy_id, token from told qualify row_number() over (partition by deploy_id order by t desc, arrival_seq desc) = 1)
        select s.deploy_id, s.slot, n.token as hash from (select distinct deploy_id, slot from told) s join newest n using (deploy_id)
        where not exists (select 1 from told t where t.deploy_id = s.deploy_id and t.slot = s.slot and t.token = n.token)""",
    "slot_parse": "select snapshot_id, case when ctip_count between 0 and 255 and tip_height between 0 and 255 then ctip_count || '+' || tip_height end as slots from snapshot_runs",
    "positive_guard": "select event_id, case when try_cast(props::json->>'k' as bigint) > 0 then try_cast(props::json->>'k' as bigint) end as number from events",
    "key_overlap": """with names as (select regexp_replace(upper(n_name), '[^A-Z0-9]', '_', 'g') as name, n_regionkey from nation)
        select distinct name from names where n_regionkey < 2 and regexp_full_match(name, '[A-Z][A-Z0-9_]*')""",
    "new_tip": f"select snapshot_id, {_hash('tip_after')} as tip from snapshot_runs where {_hash('tip_before')} <> {_hash('tip_after')}",
    "payload_verify": f"select header_row_id, cast(32 as bigint) as size, sha256(unhex({_hash('hash')})) as digest, height is not null as matches from block_headers where {_hash('hash')} is not null",
    "received_any": """select deploy_id, coalesce(block_connected.sidechain_number, block_disconnected.sidechain_number, ctip.sidechain_number) as slot,
        bool_or(kind = 'block_disconnected') as received from enforcer_feed group by all""",
    "block_ancestors": f"""with recursive valid as (select {_hash("hash")} as h, {_hash("previous_hash")} as p, header_row_id from block_headers),
        links as (select h, min(p) as p from valid where h is not null group by 1),
        walk as (
          select h, p, cast(0 as bigint) as distance from links where h = (select arg_max(h, header_row_id) from valid where h is not null)
          union all select l.h, l.p, w.distance + 1 from walk w join links l on l.h = w.p where w.distance < {ANCESTORS})
        select h as hash, distance from walk""",
}
