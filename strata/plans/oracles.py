"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark code: the parsers' expected output is
computed from the source columns the lines were rendered from, and the JVM
split and key/value rules are spelled with DuckDB list functions.
"""

from __future__ import annotations

# --- bindings (same derivations as strata.sources.bindings) ------------------

HOUSES = """select p_partkey as fh_id, unnest(case when p_partkey % 10 = 0
    then [p_partkey, p_partkey + 10000000] else [p_partkey] end) as share_id, p_retailprice as price,
  p_size % 5 + 1 as room, p_brand as area, concat(p_brand, '/', p_type) as place,
  cast(p_partkey % 3 + 1 as int) as rs_type from part"""

INTENTS = """select o_orderkey as rid, concat('C', cast(o_custkey as varchar)) as cid,
  substr(cast(o_orderdate as varchar), 1, 10) as see_time,
  substr(cast(o_orderdate as varchar), 1, 10) as update_time,
  concat('01-Brand#', cast(o_custkey % 25 + 1 as varchar),
    case when o_orderkey % 10 = 9 then '' else concat('-Brand#', cast(o_custkey % 25 + 1 as varchar), '/',
      case o_custkey % 6 when 0 then 'MEDIUM' when 1 then 'PROMO' when 2 then 'SMALL'
        when 3 then 'STANDARD' when 4 then 'ECONOMY' else 'LARGE' end) end) as area_code,
  cast(900 + o_orderkey % 60 as double) as price_start, cast(940 + o_orderkey % 60 as double) as price_end,
  case when o_orderkey % 2 = 0 then '1,2' else '3,4,5' end as house_type,
  cast(o_orderkey % 5 as int) as require_type
from orders"""

NORM_INTENTS = f"""select rid, cid, see_time, update_time, area_code,
  split_part(area_code, '-', 1) as city, split_part(area_code, '-', 2) as area,
  split_part(area_code, '-', 3) as place,
  case require_type when 1 then 1 when 2 then 2 when 4 then 2 else 3 end as rs,
  price_start, price_end, house_type
from ({INTENTS}) where len(string_split(area_code, '-')) = 3 and house_type is not null"""

# every (listing, intent row) that matches on place or area; t1 = place match
PAIRS = f"""select h.share_id, h.fh_id, i.cid, i.rid, i.see_time, i.update_time, h.place = i.place as t1
from ({HOUSES}) h join ({NORM_INTENTS}) i
  on (h.place = i.place or h.area = i.area) and h.rs_type = i.rs
 and list_contains(string_split(i.house_type, ','), cast(h.room as varchar))
 and h.price between i.price_start and i.price_end"""

GATED = f"""with p as ({PAIRS}),
g as (select share_id, fh_id, count(distinct cid) filter (where t1) as n1 from p group by 1, 2)
select p.* from p join g using (share_id, fh_id)
where t1 or (n1 < 3 and not exists (select 1 from p q where q.share_id = p.share_id and q.fh_id = p.fh_id
                                                        and q.cid = p.cid and q.t1))"""

TOP3 = f"""with c as ({GATED}),
k as (select share_id, fh_id, cid, row_number() over (partition by share_id, fh_id order by max(see_time) desc, cid) as r
      from c group by share_id, fh_id, cid)
select c.* from c join k using (share_id, fh_id, cid) where k.r <= 3"""

LATEST = f"""select share_id, fh_id, cid, rid, see_time from (
  select *, row_number() over (partition by share_id, fh_id, cid order by update_time desc, rid) as rn
  from ({TOP3})) where rn = 1"""

JTRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _kv(payload: str, key: str) -> str:
    """DuckDB spelling of the key/value rule: last token with key ``key``."""
    k = JTRIM.format(x="substr(t, 1, strpos(t, '=') - 1)")
    v = JTRIM.format(x="split_part(substr(t, strpos(t, '=') + 1), '%', 1)")
    return (f"(list_filter(list_transform(string_split({payload}, '&'), "
            f"lambda t: case when strpos(t, '=') > 0 then [{k}, {v}] end), "
            f"lambda e: e[1] = '{key}'))[-1][2]")


def _jvm_size(s: str, sep: str) -> str:
    parts = f"string_split({s}, '{sep}')"
    return (f"cast(case when {s} = '' then 1 else coalesce(len({parts}) + 1 - list_position("
            f"list_reverse(list_transform({parts}, lambda x: x <> '')), true), 0) end as int)")


EVENT_LINES = """select concat_ws('||',
  case when event_id % 11 = 0 then concat(chr(1), chr(0), strftime(ts, '%Y-%m-%d %H:%M:%S'))
       else strftime(ts, '%Y-%m-%d %H:%M:%S') end,
  concat('10.0.', cast(user_id % 256 as varchar), '.', cast(event_id % 256 as varchar)),
  'wx', concat('U', cast(user_id as varchar)), 'app1', '1.0',
  case when user_id % 2 = 0 then 'ios' else 'android' end,
  concat('m', cast(user_id % 9 as varchar)), 'wifi', '', '114.1', '22.5',
  concat('s', cast(event_id % 97 as varchar)), concat('r', cast(user_id % 13 as varchar)),
  case when event_id % 7 = 0 then ''
       when event_id % 5 = 0 then concat('uid=x&eId=', event_type, '&uid= ', cast(user_id as varchar),
            ' &obj=', printf('%.2f', value), '&bd=b%20', cast(event_id % 3 as varchar), '&junk')
       else concat('eId=', event_type, '&uid=', cast(user_id as varchar), '&obj=', printf('%.2f', value)) end
) as value from events"""

EVENT_EXPECTED = """select strftime(ts, '%Y-%m-%d %H:%M:%S') as request_time,
  concat('10.0.', cast(user_id % 256 as varchar), '.', cast(event_id % 256 as varchar)) as ip,
  'wx' as http_logsource, concat('U', cast(user_id as varchar)) as http_uuid, 'app1' as http_aid,
  '1.0' as http_version, case when user_id % 2 = 0 then 'ios' else 'android' end as http_phoneos,
  concat('m', cast(user_id % 9 as varchar)) as http_phonemodel, 'wifi' as http_network,
  '' as http_carries, '114.1' as http_longitude, '22.5' as http_latitude,
  case when event_id % 5 = 0 then 'b' end as bd, cast(null as varchar) as osv,
  cast(user_id as varchar) as uid, event_type as eid, printf('%.2f', value) as obj,
  cast(null as varchar) as scs, cast(null as varchar) as osl, cast(null as varchar) as dpi,
  cast(null as varchar) as bat, concat('s', cast(event_id % 97 as varchar)) as sid,
  concat('r', cast(user_id % 13 as varchar)) as srcid, '2024-02-01' as l_date
from events where event_id % 7 <> 0"""

PAGE_EXPECTED = """select cast(page_id as varchar) as it, '10.1.0.1' as ip, 'web' as logsource,
  concat('U', cast(page_id as varchar)) as uuid, 'a1' as aid, 'ss' as ssid, '2.0' as ver, 'linux' as ost,
  regexp_extract(url, '^[a-z]+://([^/]+)', 1) as model, '4g' as bi_nt, 'cm' as bi_np,
  '114.0' as bi_lng, '22.0' as bi_lat, 'ch' as channel, 'mac' as mac, 'imei' as imei,
  'idfa' as idfa, 'imsi' as imsi, cast(page_id as varchar) as pid,
  cast(page_id % 97 as varchar) as st, case when page_id % 4 = 0 then 'ios' end as bd,
  case when page_id % 4 = 0 then '17' end as osv, cast(page_id % 13 as varchar) as uid,
  case when page_id % 4 = 0 then '9' else '1' end as et, cast(null as varchar) as scs,
  cast(null as varchar) as osl, cast(null as varchar) as dpi, cast(null as varchar) as bat,
  concat('s', cast(page_id as varchar)) as sid, 'src' as srcid, '2024-02-01' as l_date
from pages"""

FACTS = """select user_id as uuid, strftime(ts, '%Y-%m-%d') as l_date, user_id, event_type, value, event_id
from events"""

SEGMENT_RULES = [
    (1, "event_type='purchase' and value>60"),
    (2, "value>150"),
    (3, "user_id % 7 = 0"),
    (4, "user_id in (select user_id from segment_facts where value>180)"),
    (5, "1=0"),
]


def _per_rule(rid: int, rule: str, facts: str = "segment_facts", start="2024-01-28",
              end="2024-01-28", cols=("group_number", "group_active_count")) -> str:
    parts = [f"cast({rid} as int) as id"]
    if "group_number" in cols:
        parts.append(f"(select count(distinct uuid) from {facts} where ({rule})) as group_number")
    if "group_active_count" in cols:
        parts.append(f"(select count(distinct uuid) from {facts} where uuid in "
                     f"(select distinct uuid from {facts} where ({rule})) "
                     f"and l_date >= '{start}' and l_date <= '{end}') as group_active_count")
    return "select " + ", ".join(parts)


def _segments(cols) -> str:
    body = "\nunion all\n".join(_per_rule(i, r, cols=cols) for i, r in SEGMENT_RULES)
    return f"with segment_facts as ({FACTS})\n{body}"


STORED_RULES = """select cast(ascii(event_type) * 100 + length(event_type) as int) as id,
  case when event_type = 'view' then 'daily visitors' else event_type end as group_name,
  case when event_type = 'error' then '' else concat('event_type = ''', event_type,
    ''' and uuid in (select uuid from OLD_DW_facts where value > 100)') end as group_rule_sql,
  case when event_type = 'signup' then 0 else 1 end as status
from (select distinct event_type from events)"""

ACTIVE_RULES = f"""select id, group_name, regexp_replace(group_rule_sql, 'OLD_DW', 'dw', 'g') as group_rule_sql
from ({STORED_RULES}) where status = 1 and group_name <> 'daily visitors'
  and group_rule_sql is not null and group_rule_sql <> ''"""

# the two stored rules that stay active, spelled out per rule
STORED_RULE_COUNTS = "with dw_facts as (" + FACTS + ")\n" + "\nunion all\n".join(
    _per_rule(f"ascii('{t}') * 100 + length('{t}')",
              f"event_type = '{t}' and uuid in (select uuid from dw_facts where value > 100)",
              facts="dw_facts")
    for t in ("click", "purchase"))

COUNT_STATE = """select cid, p_date, count(*) as count from (
  select concat('C', cast(o_custkey as varchar)) as cid, substr(cast(o_orderdate as varchar), 1, 10) as p_date
  from orders) group by cid, p_date"""

J3 = f"""select h.fh_id, i.cid, i.rid, i.see_time, i.update_time,
  cast(case when h.place = i.place then 1 else 2 end as int) as tier
from ({HOUSES}) h join ({NORM_INTENTS}) i
  on h.price between i.price_start and i.price_end and cast(h.room as varchar) <= i.house_type
 and (h.place = i.place or h.area = i.area)"""

ORACLES: dict[str, str] = {
    "c2_event_log_parse": EVENT_EXPECTED,
    "c1_page_log_parse": PAGE_EXPECTED,
    "p2_rejects": f"""select value as line, {_jvm_size('value', '||')} as n_fields
        from ({EVENT_LINES}) where {_jvm_size('value', '||')} <> 15""",
    "p6_url_params": f"""select page_id, {_kv('q', 'page')} as page, {_kv('q', 'ref')} as ref
        from (select page_id, regexp_extract(url, '\\?([^#]*)', 1) as q from pages)""",
    "s2_bucket_path": """select event_id,
        strftime(time_bucket(interval 5 minutes, ts) - interval 5 minutes, '%Y-%m-%d/%H-%M') as bucket
        from events""",
    "p13_field_profile": f"""select {_jvm_size('text', ' ')} as n_fields, count(*) as lines
        from documents group by 1""",
    "a8_max_struct": f"""select text as line, {_jvm_size('text', ' ')} as n_fields
        from documents order by text desc, n_fields desc limit 1""",
    "p9_normalize_intents": f"""select rid, cid, city, area, place, rs, price_start, price_end, house_type
        from ({NORM_INTENTS})""",
    "p14_price_band": "select p_partkey, p_retailprice from part where p_retailprice between 950.0 and 960.0",
    "j1_place_candidates": f"select share_id, fh_id, cid, rid, see_time from ({PAIRS}) where t1",
    "j2_match_candidates": f"""select share_id, fh_id, cid, rid, cast(case when t1 then 1 else 2 end as int) as tier
        from ({GATED})""",
    "t1_top_clients_per_house": f"select share_id, fh_id, cid, rid from ({TOP3})",
    "w2_latest_per_key": LATEST,
    "c3_match_stateless": LATEST,
    "j3_place_or_area": f"select fh_id, cid, rid, tier from ({J3})",
    "c4_best_client": f"""select fh_id, cid, rid, see_time from (
        select *, row_number() over (partition by fh_id order by see_time desc, update_time desc, rid) as rn
        from ({J3})) where rn = 1""",
    "m1_daily_reset": f"select cid, count from ({COUNT_STATE}) where p_date = '1998-08-02'",
    "a6_merge_counts": """select concat('C', cast(o_custkey as varchar)) as cid, count(*) as count
        from orders group by 1""",
    "j4_exclude_capped": f"""select rid, cid from ({NORM_INTENTS})
        where cid not in (select cid from ({COUNT_STATE}) group by cid having sum(count) > 3)""",
    "r1_segment_counts": "select *, 'ok' as status from (" + _segments(("group_number", "group_active_count")) + ")",
    "r1_bad_rules": "select *, true as counted from (" + _segments(("group_number", "group_active_count")) + """) where id <= 2
        union all select 13, 0, 0, true
        union all select unnest([11, 12, 14, 15]), null, null, false""",
    "a2_collect_all_ids": """select user_id, coalesce(string_agg(cast(event_id as varchar), ',' order by event_id)
        filter (where event_type = 'view'), '') as ids from events group by user_id""",
    "a10_first_row": "select event_id, user_id, event_type from events order by value desc, event_id limit 1",
    "k8_preview": f"select rid, cid, area, place from ({NORM_INTENTS}) order by rid limit 20",
    "j6_intents_of_counted": f"""select rid, cid, cast(c.n as bigint) as count from ({NORM_INTENTS})
        join (select cid, sum(count) as n from ({COUNT_STATE}) group by cid having sum(count) > 3) c using (cid)""",
    "f11_days_before": "select event_id, strftime(ts - interval 7 days, '%Y-%m-%d') as day from events",
    "s3_k1_catalog_roundtrip": f"""select l_date, event_type, count(*) as n, count(distinct uuid) as users
        from ({FACTS}) where l_date >= '2024-01-10' group by 1, 2""",
    "a3_rule_users": _segments(("group_number",)),
    "a4_rule_active": _segments(("group_active_count",)),
    "r2_active_rules": ACTIVE_RULES,
    "r1_stored_rule_counts": "select *, 'ok' as status from (" + STORED_RULE_COUNTS + ")",
    "a2_collect_ids": """select user_id, string_agg(cast(event_id as varchar), ',' order by event_id) as ids
        from events where event_id is not null group by user_id""",
    "p15_fill": """select d.doc_id, coalesce(l.quality, 0) as quality, coalesce(l.toxic, 0) as toxic,
        coalesce('L' || cast(l.doc_id as varchar), ' ') as label_ref
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "s4_date_scan": """select event_id, user_id as uuid, strftime(ts, '%Y-%m-%d') as l_date, event_type
        from events where strftime(ts, '%Y-%m-%d') >= '2024-01-28'""",
}

TSV_LINES = """select concat_ws(chr(9), cast(event_id as varchar), cast(user_id as varchar), event_type,
  printf('%.2f', value), strftime(ts, '%Y-%m-%d'), 'c6', 'c7', 'c8', 'c9', 'c10', 'c11', 'c12',
  case when event_id % 4 = 0 then '' else props end) as value from events"""

ORACLES.update({
    "c2_ingest_event_log": EVENT_EXPECTED,
    "c1_ingest_page_log": PAGE_EXPECTED,
    "l1_stream_ingest": EVENT_EXPECTED,
    "l1_stream_buckets": EVENT_EXPECTED,
    "k2_replace_table": ORACLES["a6_merge_counts"],
    "k3_snapshot_table": ORACLES["s4_date_scan"],
    "k4_csv_export": "select p_partkey, p_name, p_retailprice from part",
    "k6_json_export": ORACLES["p15_fill"],
    "p13_tsv_profile": f"""select {_jvm_size('value', chr(9))} as n_fields, count(*) as lines
        from ({TSV_LINES}) group by 1""",
    "k7_text_export": f"""select concat('(', value, ',13)') as record from ({TSV_LINES})
        where {_jvm_size('value', chr(9))} = 13""",
})

ORACLES["m2_assign_unbound_cap"] = LATEST


def _assigned(state: str, columns: str) -> str:
    """The sequential rule itself: a recursion over the listings in (share_id,
    fh_id) order that carries every client's counter."""
    return f"""with recursive p as ({PAIRS}),
s as (
  select share_id, fh_id, cid, bool_or(t1) as place,
    case when bool_or(t1) then max(see_time) filter (where t1) else max(see_time) end as ms,
    case when bool_or(t1) then count(*) filter (where t1) else count(*) end as n,
    case when bool_or(t1) then arg_max(rid, (update_time, -rid)) filter (where t1) else arg_max(rid, (update_time, -rid)) end as rid
  from p group by share_id, fh_id, cid),
l as (
  select row_number() over (order by share_id, fh_id) as i, share_id, fh_id,
    list(struct_pack(cid := cid, place := place, n := n, rid := rid) order by ms desc nulls last, cid) as c
  from s group by share_id, fh_id),
r(i, counts, top) as (
  select cast(0 as bigint), (select coalesce(map_from_entries(list((cid, cast(n as bigint)))), map([]::varchar[], []::bigint[])) from ({state})),
    cast([] as struct(cid varchar, place boolean, n bigint, rid bigint)[])
  union all
  select i + 1, map_concat(counts, map_from_entries(list_transform(top, lambda x: (x.cid, coalesce(counts[x.cid], 0) + x.n)))), top
  from (
    select i, counts, (case when len(list_filter(live, lambda x: x.place)) >= 3 then list_filter(live, lambda x: x.place) else live end)[1:3] as top
    from (select r.i, r.counts, list_filter(l.c, lambda x: coalesce(r.counts[x.cid], 0) <= 3) as live
          from r join l on l.i = r.i + 1)))
select {columns} from (select l.share_id, l.fh_id, unnest(r.top) as x from r join l on l.i = r.i) t"""


ORACLES["m2_assign_capped"] = _assigned("select '' as cid, 0 as n where false", "share_id, fh_id, x.cid as cid, x.rid as rid, x.n as n_rows")
MATCH_STATE = "select concat('C', cast(o_custkey as varchar)) as cid, count(*) // 4 as n from orders group by 1"
ORACLES["c3_run_match"] = f"""select a.share_id, a.fh_id, a.cid, i.area_code, i.price_start, i.price_end, i.house_type
    from ({_assigned(MATCH_STATE, "share_id, fh_id, x.cid as cid, x.rid as rid")}) a join ({NORM_INTENTS}) i using (rid)"""
ORACLES["c3_run_match_catalog"] = _assigned(MATCH_STATE, "share_id, fh_id, x.cid as cid")

ORACLES.update({
    "p6_kv_map": """select cast(user_id as varchar) as uid, event_type as eid, printf('%.2f', value) as obj,
        case when event_id % 5 = 0 then 'b' end as bd from events where event_id % 7 <> 0""",
    "t2_day_table_reset": f"""select cid, cast(sum(count) as bigint) as count from ({COUNT_STATE}) group by cid
        having (select max(p_date) from ({COUNT_STATE})) = '2001-08-01'""",
    "r3_segment_export": "select cast(id as varchar) as id, cast(group_number as varchar) as group_number, "
                         "cast(group_active_count as varchar) as group_active_count from ("
                         + STORED_RULE_COUNTS + ")",
    "k5_csv_parallel": ORACLES["s2_bucket_path"],
})

ORACLES["c4_best_client_job"] = ORACLES["c4_best_client"]

ORACLES.update({
    "a2_id_chunks": """select event_type, chunk, count(*) as n, string_agg(cast(event_id as varchar), ',' order by event_id) as ids
        from (select event_type, event_id, (row_number() over (partition by event_type order by event_id) - 1) // 1000 as chunk
              from events where event_id is not null) group by event_type, chunk""",
    "c2_ingest_ledger": EVENT_EXPECTED,
    "s6_json_inferred": """select event_id, event_type, value, case when event_type = 'view' then user_id end as viewer,
        case when event_type = 'view' then event_id end as viewed from events""",
    # each rule as parameters of one of four conditions
    "r1_thousand_rules": f"""with f as ({FACTS}),
        r as (select cast(range as int) as id, range % 4 as kind, range * 7 % 500 as t, range % 97 + 2 as m from range(1000)),
        u as (select distinct r.id, f.uuid from r join f on
          (r.kind = 0 and f.value > r.t) or (r.kind = 1 and f.event_type = 'purchase' and f.value > r.t)
          or (r.kind = 2 and f.user_id % r.m = 0) or (r.kind = 3 and f.event_type in ('view', 'click') and f.user_id % r.m = 1)),
        a as (select distinct uuid from f where l_date >= '2024-01-28' and l_date <= '2024-01-28')
        select r.id, count(u.uuid) as group_number, count(a.uuid) as group_active_count
        from r left join u using (id) left join a on a.uuid = u.uuid group by r.id""",
})
