"""The queries of problems 1 to 6 as SQL for DuckDB, each written from the problem's statement by another plan than ours."""

_B = r"[\s\p{Z}\x{FEFF}]"


def _hex(c: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({c}), '^{_B}*(0x)?', ''), '{_B}+$', '')"


def _hash(c: str) -> str:
    return f"case when regexp_full_match({_hex(c)}, '[0-9a-f]{{64}}') then {_hex(c)} end"


def _link(c: str) -> str:
    return f"case when not regexp_full_match({_hex(c)}, '0*') then {_hex(c)} end"


def _text(c: str) -> str:
    return rf"regexp_replace({c}, '^{_B}+|{_B}+$', '', 'g')"


_TREE = f"""
with recursive nodes as (
  select {_hash("hash")} as h, min({_link("previous_hash")}) as p, min(header_row_id) as label
  from block_headers where {_hash("hash")} is not null group by 1),
tree as (
  select h, label, h as root, 0 as depth, [label] as path from nodes where p is null or p not in (select h from nodes)
  union all
  select n.h, n.label, t.root, t.depth + 1, list_append(t.path, n.label) from tree t join nodes n on n.p = t.h)
"""

_MESSAGES = f"""
messages as (
  select arrival_seq, deploy_id, kind, cast(event_ms as bigint) as t, arrival_ts,
    coalesce(block_connected.sidechain_number, block_disconnected.sidechain_number, ctip.sidechain_number) as slot,
    case when kind = 'ctip' then 'ctip ' || coalesce(cast(event_ms as bigint)::varchar, '')
      else {_hash("coalesce(block_connected.header.hash, block_disconnected.block_hash)")} end as token,
    case when kind <> 'ctip' then block_connected.header.height end as height
  from enforcer_feed)
"""


def _latest(kind: str, table: str, key: str, values: str, stated: str) -> str:
    return f"""
  {kind}_latest as (
    select snapshot_id, sidechain_number, {key} as description_hash, arg_max({values}, row(loaded_at, {values})) as v
    from {table} group by 1, 2, 3),
  {kind}_runs as (
    select r.deploy_id, r.snapshot_id, r.snapshot_at, row_number() over w as n, lead(r.snapshot_at) over w as next_at, lead(r.snapshot_id) over w as next_id
    from snapshot_runs r left join (select snapshot_id, count(*) as held from {kind}_latest group by 1) c using (snapshot_id)
    where coalesce(held, 0) >= {stated}
    window w as (partition by r.deploy_id order by r.snapshot_at, r.snapshot_id))"""


_DECLARATION = f"declaration is null, {_text('declaration.title')}, {_text('declaration.description')}, {_hex('declaration.hash_id_1')}, {_hex('declaration.hash_id_2')}"


def _p3(kind: str, table: str, key: str, values: str, stated: str) -> str:
    return f"""
  select '{kind}' as item_kind, deploy_id, sidechain_number, description_hash,
    cast(floor(epoch_us(min(snapshot_at)) / 1000000) as bigint) as valid_from,
    coalesce(cast(floor(epoch_us(arg_max({{ends: next_at}}, n).ends) / 1000000) as bigint), -1) as valid_to
  from (
    select *, sum(fresh) over (partition by deploy_id, sidechain_number, description_hash order by n) as version
    from (
      select r.deploy_id, l.sidechain_number, l.description_hash, r.n, r.snapshot_at, r.next_at,
        case when lag(r.n) over w = r.n - 1 and lag(l.v) over w is not distinct from l.v then 0 else 1 end as fresh
      from {kind}_latest l join {kind}_runs r using (snapshot_id)
      window w as (partition by r.deploy_id, l.sidechain_number, l.description_hash order by r.n)))
  group by deploy_id, sidechain_number, description_hash, version"""


def _p4(kind: str) -> str:
    held = " and l.v[1] is not null" if kind == "ctip" else ""
    return f"""
  select '{kind}' as item_kind, deploy_id, snapshot_id, sidechain_number, description_hash,
    case when then_v is null then 'added' when now_v is null then 'removed' else 'changed' end as change
  from (
    select coalesce(a.deploy_id, b.deploy_id) as deploy_id, coalesce(a.snapshot_id, b.next_id) as snapshot_id,
      coalesce(a.sidechain_number, b.sidechain_number) as sidechain_number, coalesce(a.description_hash, b.description_hash) as description_hash,
      a.v as now_v, b.v as then_v
    from (select r.*, l.sidechain_number, l.description_hash, l.v from {kind}_latest l join {kind}_runs r using (snapshot_id) where r.n > 1{held}) a
    full join (select r.*, l.sidechain_number, l.description_hash, l.v from {kind}_latest l join {kind}_runs r using (snapshot_id) where r.next_id is not null{held}) b
      on a.snapshot_id = b.next_id and a.sidechain_number = b.sidechain_number and a.description_hash = b.description_hash)
  where now_v is distinct from then_v"""


_KIND = {
    "proposal": ("proposal_snapshots", _hex("description_hash"), "proposal_count", "row(vote_count, proposal_age)", f"row({_hex('description')}, vote_count, proposal_height, proposal_age, {_DECLARATION})"),
    "active": ("active_snapshots", "''", "sidechain_count", "row(vote_count, activation_height)", f"row({_hex('description')}, vote_count, proposal_height, activation_height, {_DECLARATION})"),
    "ctip": ("ctip_snapshots", "''", "ctip_count", "", f"row(case when ctip is not null then 1 end, {_hex('ctip.txid')}, ctip.vout, ctip.value, ctip.sequence_number)"),
}


def _with(which: int, kinds: tuple[str, ...]) -> str:
    return "with " + ",".join(_latest(k, _KIND[k][0], _KIND[k][1], _KIND[k][3 + which], _KIND[k][2]) for k in kinds)


_REFS = f"""
headers as (
  select header_row_id, {_hash("hash")} as h, {_link("previous_hash")} as p, loaded_at, deleted_at from block_headers where {_hash("hash")} is not null),
refs as (
  select 'block_headers' as ref_table, header_row_id as ref_id, p as block, loaded_at as t from headers where p is not null
  union all select 'enforcer_feed', arrival_seq, token, arrival_ts from messages where kind <> 'ctip' and token is not null
  union all select 'snapshot_runs', snapshot_id, {_link("tip_hash")}, snapshot_at from snapshot_runs where {_link("tip_hash")} is not null),
orphans as (
  select ref_table, ref_id, strftime(t, '%Y-%m-%d') as period,
    case when not exists (select 1 from headers where h = block) then 'missing'
      when exists (select 1 from headers where h = block and loaded_at <= t) then 'deleted' else 'late' end as reason
  from refs where not exists (select 1 from headers where h = block and loaded_at <= t and (deleted_at is null or deleted_at > t)))
"""

SQL = {
    "p1_found": f"{_TREE} select n.h as hash, coalesce(t.root, 'cycle') as root_hash, cast(coalesce(t.depth, -1) as bigint) as depth from nodes n left join tree t on n.h = t.h",
    "p1_paths": f"{_TREE} select h as hash, array_to_string(path, '/') as path from tree",
    "p1_descendants": f"""{_TREE} select a as ancestor_row, label as descendant_row, cast(depth - i + 1 as bigint) as distance
        from (select label, depth, unnest(path) as a, unnest(range(1, depth + 2)) as i from tree) where i <= depth""",
    "p2_found": f"""
        with {_MESSAGES},
        marked as (
          select *, case when lag(kind) over w = kind and lag(height) over w is not distinct from height then 0 else 1 end as fresh
          from messages where token is not null
          window w as (partition by deploy_id, slot, token order by t, kind, height nulls first, arrival_seq)),
        runs as (select *, sum(fresh) over (partition by deploy_id, slot, token order by t, kind, height nulls first, arrival_seq) as run from marked)
        select arrival_seq from (select arrival_seq, min(arrival_seq) over (partition by deploy_id, slot, token, run) as kept from runs) where arrival_seq <> kept""",
    "p3_found": _with(0, ("proposal", "active")) + " union all ".join(_p3(k, *(_KIND[k][0], _KIND[k][1], _KIND[k][3], _KIND[k][2])) for k in ("proposal", "active")),
    "p4_found": _with(1, tuple(_KIND)) + " union all ".join(_p4(k) for k in _KIND),
    "p5_found": f"with {_MESSAGES}, {_REFS} select * from orphans",
    "p5_report": f"with {_MESSAGES}, {_REFS} select ref_table, period, reason, count(*) as orphans from orphans group by all",
    "p6_found": f"""
        with {_MESSAGES},
        ranked as (
          select *, row_number() over (partition by deploy_id, slot, token order by t desc, arrival_seq desc) as k
          from messages where kind <> 'ctip' and token is not null)
        select deploy_id, slot as sidechain_number, token as hash, height from ranked where k = 1 and kind = 'block_connected'""",
}
SQL["p3_appended"] = SQL["p3_found"]
SQL["p6_applied"] = SQL["p6_found"]
_PARTS = f"""
with refs as (
  select arrival_seq, deploy_id as d, nullif(block_disconnected.sidechain_number, 9) as s, {_hash("block_disconnected.block_hash")} as h, arrival_ts as t
  from enforcer_feed where kind = 'block_disconnected'),
targets as (
  select deploy_id as d, block_connected.sidechain_number as s, {_hash("block_connected.header.hash")} as h, min(arrival_ts) as since
  from enforcer_feed where kind = 'block_connected' group by all),
told as (
  select arrival_seq, d is not null and s is not null and h is not null as whole, d is not null or s is not null or h is not null as any_part, t,
    (select min(since) from targets x where (r.d is null or x.d = r.d) and (r.s is null or x.s = r.s) and (r.h is null or x.h = r.h)) as since
  from refs r),
orphans as (select *, case when since is null then 'missing' else 'late' end as reason from told where any_part and (since is null or since > t))
"""
SQL["p5_composite"] = f"""{_PARTS}
  select 'simple' as match, arrival_seq, reason from orphans where whole union all select 'partial', arrival_seq, reason from orphans
  union all select 'full', arrival_seq, case when told.whole then reason else 'partial' end
    from told left join (select arrival_seq, reason from orphans) orphans using (arrival_seq) where (told.whole and orphans.reason is not null) or (told.any_part and not told.whole)"""
