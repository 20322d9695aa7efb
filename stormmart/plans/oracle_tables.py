"""DuckDB SQL of the queries in ``registry_tables``."""

from __future__ import annotations

from stormmart.operators import quality as dq
from stormmart.plans.registry_tables import (
    CHANGED_FROM,
    DOCUMENT_LENGTHS,
    FIRST_LOAD,
    LARGEST_PART,
    SECOND_LOAD,
)
from stormmart.sources.links import WINDOWS_1252

_IN_SET = f"'{dq.IN_SET}'"
_LOW_CODES = " ".join(f"when {k} then {v}" for k, v in WINDOWS_1252.items())


def _rejects() -> str:
    return " union all ".join(
        f"select doc_id, '{c}' as column_name, {n} as limit_length, cast(length({c}) as integer) as found_length "
        f"from documents where length({c}) > {n}" for c, n in DOCUMENT_LENGTHS.items())


def _fits() -> str:
    return " and ".join(f"coalesce(length({c}) <= {n}, true)" for c, n in DOCUMENT_LENGTHS.items())


def _run(i: int, table: str) -> str:
    return f"""
select {i} as i, '{dq.NOT_NULL}' as rule, 'event_type' as column_name, count(*) as n,
       count(*) filter (event_type is null) as bad from {table}
union all select {i}, '{dq.BETWEEN}', 'user_id', count(*), count(*) filter (user_id < 10) from {table}
union all select {i}, '{dq.UNIQUE}', 'event_id', (select count(*) from {table}), count(*)
  from (select event_id from {table} where event_id is not null group by event_id having count(*) > 1)"""


TABLE_ORACLE = {
    "q39_header_scan": """
select o_orderkey, case when o_orderkey % 4 <> 2 then o_orderstatus end as o_orderstatus, o_totalprice,
       cast(null as varchar) as refused
from orders where o_orderkey % 4 <> 3
union all select null, null, null, 'unknown column: O_EXTRA'""",
    "q41_set_table": f"""
with l as (select *, case when l_linenumber <> 2 then 'PART-' || l_partkey end as part_name,
             l_partkey in (select p_partkey from part where p_size <= {LARGEST_PART}) as known from lineitem),
c as (select count(*) as n, count(*) filter (not known) as a, count(*) filter (part_name is not null and not known) as b,
        count(part_name) as d, count(*) filter (l_partkey is null) as e from l)
select {_IN_SET} as rule, 'l_partkey' as column_name, n as element_count, a as unexpected_count, a = 0 as success from c
union all select {_IN_SET}, 'part_name', n, b, b = 0 from c
union all select {_IN_SET}, 'part_name', n, d, d = 0 from c
union all select '{dq.NOT_NULL}', 'l_partkey', n, e, e = 0 from c""",
    "q42_column_defaults": "select c_custkey, c_name, 'load' as origin, true as has_time from customer",
    "q43_length_rejects": f"""
select doc_id, cast(null as varchar) as column_name, cast(null as integer) as limit_length,
       cast(null as integer) as found_length from documents where {_fits()}
union all {_rejects()}""",
    "q44_character_references": f"""
with texts as (
  select page_id, unnest([0, 1, 2, 3, 4]) as link_pos, unnest([
    chr(cast(page_id * 131 % 55000 + 160 as integer)), chr(cast(page_id * 131 % 55000 + 160 as integer)),
    chr(cast(page_id % 900 + 127744 as integer)),
    chr(cast(case page_id % 32 + 128 {_LOW_CODES} else page_id % 32 + 128 end as integer)),
    repeat(chr(65533), 4) || '&lt;&#38;' || chr(201) || '&nosuch; & ' || page_id]) as link_text
  from pages)
select page_id, cast(link_pos as integer) as link_pos,
       regexp_replace(link_text, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') as link_text from texts""",
    "q45_stream_restart": f"""
select o_orderkey, case when changed then 'U' else o_orderstatus end as o_orderstatus, o_totalprice,
       case when changed then timestamp '{SECOND_LOAD}' else timestamp '{FIRST_LOAD}' end as loaded
from (select *, o_orderdate >= timestamp '{CHANGED_FROM}' as changed from orders)""",
    "q46_archive_drain": """
select count(*) as n_rows, cast(sum(o_orderkey) as bigint) as sum_keys, cast(0 as bigint) as not_moved,
       cast(0 as bigint) as left_in_landing from orders""",
    "q47_checkpoint_runs": f"""
with worse as (
  select case when event_id % 50 = 0 then 0 else event_id end as event_id,
         case when event_id % 11 <> 0 then event_type end as event_type, user_id, value from events),
runs as ({_run(0, "events")} union all {_run(1, "worse")}),
b as (select *, lag(bad) over (partition by rule, column_name order by i) as before from runs)
select 'events' as suite, rule, column_name, 'run-' || i as batch, cast(i + 1 as integer) as run, n as element_count,
       bad as unexpected_count, bad = 0 as success, before as unexpected_before, bad - before as change,
       (before = 0) <> (bad = 0) as turned from b""",
    "q48_listing_counts": """
select o_orderstatus, count(*) as n_rows, cast(sum(o_orderkey) as bigint) as sum_keys, true as all_listed
from orders group by o_orderstatus""",
}
