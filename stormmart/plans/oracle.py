"""DuckDB SQL equivalents of the registered queries (same column names/types).

Written independently of the Spark expressions: the SQL states each model the
way a warehouse user would, with the same fixed test inputs.
"""

from __future__ import annotations

from stormmart.operators import quality as dq
from stormmart.plans import registry as R
from stormmart.plans.oracle_tables import TABLE_ORACLE
from stormmart.plans.registry_files import FILE_ORACLE, MAX_ANCHORS
from stormmart.plans.registry_tables import MIXED_SUITE

_NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"
_LETTER = r"\p{L}"


def _amount_parts(text: str) -> tuple[str, str, str]:
    """number, unit and amount SQL for an amount text expression."""
    rest = f"regexp_replace(lower({text}), '{_LETTER}', '')"
    number = (f"case when length({rest}) > 0 and regexp_matches({rest}, '{_NUMBER_TEXT}') "
              f"then try_cast({rest} as double) end")
    unit = (f"case when regexp_matches(lower(right({text}, 1)), '{_LETTER}') "
            f"then lower(right({text}, 1)) end")
    amount = (f"case when ({unit}) = 'h' then ({number}) * 100 "
              f"when ({unit}) = 'k' then ({number}) * 1000 "
              f"when ({unit}) = 'm' then ({number}) * 1000000 "
              f"when ({unit}) = 'b' then ({number}) * 1000000000 "
              f"else coalesce({number}, 0) end")
    return number, unit, amount


def _lit(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _unexpected(rule: dq.Rule) -> str:
    c = rule.column
    kw = rule.kwargs
    if rule.kind == dq.NOT_NULL:
        return f"{c} is null"
    if rule.kind == dq.BE_NULL:
        return f"{c} is not null"
    if rule.kind == dq.IN_SET:
        if kw.get("ignore_case"):
            vals = ", ".join(_lit(str(v).upper()) for v in kw["value_set"])
            return f"{c} is not null and upper({c}) not in ({vals})"
        vals = ", ".join(_lit(v) for v in kw["value_set"])
        return f"{c} is not null and {c} not in ({vals})"
    if rule.kind in (dq.BETWEEN, dq.LENGTH_BETWEEN):
        x = c if rule.kind == dq.BETWEEN else f"length({c})"
        conds = []
        lo, hi = kw.get("min_value"), kw.get("max_value")
        if lo is not None:
            conds.append(f"{x} {'<=' if kw.get('strict_min') else '<'} {_lit(lo)}")
        if hi is not None:
            conds.append(f"{x} {'>=' if kw.get('strict_max') else '>'} {_lit(hi)}")
        return f"{c} is not null and ({' or '.join(conds) or 'false'})"
    raise ValueError(rule.kind)


def _suite_sql(table: str, suite: dq.Suite) -> str:
    parts = []
    for r in suite.rules:
        head = f"select {_lit(suite.name)} as suite, {_lit(r.kind)} as rule, {_lit(r.column_name)} as column_name"
        if r.kind in (dq.UNIQUE, dq.COMPOUND_UNIQUE):
            cols = list(r.column) if isinstance(r.column, tuple) else [r.column]
            keys = ", ".join(cols)
            present = " and ".join(f"{k} is not null" for k in cols)
            dup = (f"(select count(*) from (select {keys} from {table} where {present} "
                   f"group by {keys} having count(*) > 1))")
            parts.append(f"{head}, (select count(*) from {table}) as element_count, "
                         f"{dup} as unexpected_count, {dup} = 0 as success")
        else:
            bad = f"count(*) filter (where {_unexpected(r)})"
            parts.append(f"{head}, count(*) as element_count, {bad} as unexpected_count, "
                         f"{bad} = 0 as success from {table}")
    return "\nunion all\n".join(parts)


_EV_Q = ("(select *, case when event_type = 'purchase' then value end as purchase_value, "
         "case when value < 0 then value end as refund_value from events)")

# References that occur in the given pages; '&amp;' last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def _links_sql(pages: str, token: str | None, name_col: str = "link_text") -> str:
    text = "regexp_replace(inner_html, '<[^>]*>', '', 'g')"
    for ref, ch in ENTITIES:
        text = f"replace({text}, {_lit(ref)}, {_lit(ch)})"
    where = f"where contains(raw_text, {_lit(token)})" if token is not None else ""
    return f"""(
  select page_id, link_pos,
         regexp_replace(raw_text, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') as {name_col}
  from (
    select page_id, link_pos, {text} as raw_text
    from (
      select page_id,
             cast(unnest(range(len(a))) as integer) as link_pos,
             unnest(a) as inner_html
      from (select page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*>(.*?)</a>', 1) as a from {pages})
    )
  ) {where}
)"""


_Q01_N, _Q01_U, _Q01_A = _amount_parts("damage_property")
_Q23_CN, _Q23_CU, _Q23_CA = _amount_parts("damage_crops")
_Q02_N, _Q02_U, _Q02_A = _amount_parts("amount_text")

_THOUSANDS = "cast(cast(floor(o_totalprice / 1000) as bigint) as varchar)"

_CENTURY_TS = """(
  {t} + to_years(coalesce(cast(
      try_cast(substr({ym}, 1, 4) as integer) - (try_cast(substr({ym}, 1, 4) as integer) % 100)
      + (year({t}) % 100) - year({t}) as integer), 0)))"""

_NULL_TOKENS = ", ".join(_lit(t) for t in __import__(
    "stormmart.functions.text", fromlist=["DEFAULT_NULL_TOKENS"]).DEFAULT_NULL_TOKENS)


def _nt(c: str) -> str:
    return f"case when {c} in ({_NULL_TOKENS}) then null else {c} end"


_ORDERS_TEXT = f"""
  select cast(o_orderkey as varchar) as o_orderkey,
         cast(year(o_orderdate) * 100 + month(o_orderdate) as varchar) as begin_yearmonth,
         upper(strftime(o_orderdate, '%d-%b-%y %H:%M:%S')) as begin_date_time,
         case o_orderkey % 7 when 0 then 'NA' when 1 then ''
              when 2 then cast(cast(floor(cents / 1000000) as bigint) as varchar) || '.5'
              else cast(cast(floor(cents / 1000000) as bigint) as varchar) || '.'
                   || lpad(cast(cast(floor(cents / 10000) as bigint) % 100 as varchar), 2, '0') end as magnitude,
         case when o_orderkey % 7 = 3 then 'null'
              else cast(cast(floor(cents / 100) as bigint) as varchar) || '.'
                   || lpad(cast(cents % 100 as varchar), 2, '0') end as tor_length,
         case when o_orderkey % 7 = 4 then 'N/A' else o_orderstatus end as state
  from (select *, cast(floor(o_totalprice * 100 + 0.5) as bigint) as cents from orders)
"""

_TWO_LOADS = f"""(
  select *, timestamp '{R.FIRST_LOAD_AT}' as __date_loaded, '{R.FIRST_FILE}' as __filename
  from orders where o_orderdate < timestamp '{R.FIRST_LOAD_UNTIL}'
  union all
  select *, timestamp '{R.SECOND_LOAD_AT}' as __date_loaded, '{R.SECOND_FILE}' as __filename
  from orders
)"""

_CAL_VALUES = ", ".join(f"({_lit(d)}, {_lit(w)}, {_lit(a)})" for d, w, a in
                        __import__("stormmart.operators.lookup", fromlist=["DAY_ACTIVITIES"]).DAY_ACTIVITIES)

_LINKS_TOKEN = _links_sql("pages", R.LINK_TOKEN)
_LOG_LINKS = _links_sql(f"(select * from pages where starts_with(url, '{R.LOADED_URL_PREFIX}'))", None)

ORACLE: dict[str, str] = {
    "q01_yearly_amount": f"""
with d as (
  select o_orderstatus as state,
         year(o_orderdate) * 100 + month(o_orderdate) as begin_yearmonth,
         {_THOUSANDS} || (['', 'H', 'k', 'M', 'B', 't'])[(o_orderkey % 6) + 1] as damage_property
  from orders
)
select substr(cast(begin_yearmonth as varchar), 1, 4) as event_year, state,
       sum({_Q01_A}) as total_property_damage
from d group by 1, 2
""",
    "q02_parse_amount_edges": f"""
with t as (
  select o_orderkey,
         case o_orderkey % 12
           when 0 then {_THOUSANDS} || 'K'
           when 1 then {_THOUSANDS} || '.' || cast(o_orderkey % 10 as varchar) || 'M'
           when 2 then {_THOUSANDS} || 'B'
           when 3 then {_THOUSANDS} || 'H'
           when 4 then 'K'
           when 5 then '0'
           when 6 then ''
           when 7 then null
           when 8 then {_THOUSANDS}
           when 9 then {_THOUSANDS} || 't'
           when 10 then {_THOUSANDS} || '.5KK'
           else '-' || {_THOUSANDS} || 'k' end as amount_text
  from orders
)
select o_orderkey, amount_text, {_Q02_N} as damage_number, {_Q02_U} as damage_unit,
       {_Q02_A} as amount
from t
""",
    "q03_distinct_rows": "select distinct * from lineitem",
    "q04_first_per_key": """
select * exclude (rn) from (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber
    order by l_shipdate nulls first, l_partkey nulls first, l_suppkey nulls first,
             l_quantity nulls first, l_extendedprice nulls first, l_discount nulls first,
             l_tax nulls first, l_returnflag nulls first, l_linestatus nulls first) as rn
  from lineitem
) where rn = 1
""",
    "q05_incremental_above_max": f"""
select * from events
where coalesce(ts > (select max(ts) from events where ts < timestamp '{R.EVENTS_TARGET_BEFORE}'),
               (select max(ts) from events where ts < timestamp '{R.EVENTS_TARGET_BEFORE}') is null)
""",
    "q06_incremental_empty_target": f"""
select * from events
where coalesce(ts > (select max(ts) from events where ts < timestamp '{R.EMPTY_TARGET_BEFORE}'),
               (select max(ts) from events where ts < timestamp '{R.EMPTY_TARGET_BEFORE}') is null)
""",
    "q07_upsert": f"""
with target as (select * from orders where o_orderdate < timestamp '{R.ORDERS_TARGET_BEFORE}'),
batch as (
  select o_orderkey, o_custkey, lower(o_orderstatus) as o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '{R.ORDERS_BATCH_FROM}'
)
select * from target t where not exists (select 1 from batch b where b.o_orderkey = t.o_orderkey)
union all
select * from batch
""",
    "q08_dq_not_null": _suite_sql(_EV_Q, R.Q08_SUITE),
    "q09_dq_null": _suite_sql(_EV_Q, R.Q09_SUITE),
    "q10_dq_in_set": _suite_sql(_EV_Q, R.Q10_SUITE),
    "q11_dq_between": _suite_sql("lineitem", R.Q11_SUITE),
    "q12_dq_unique": _suite_sql("lineitem", R.Q12_LINEITEM) + "\nunion all\n"
    + _suite_sql("orders", R.Q12_ORDERS),
    "q36_first_anchors": f"""
select page_id, cast(link_pos as bigint) as link_pos,
       page_id || case when page_id % 3 = 0 then '.csv' else '.txt' end as name, page_id % 3 = 0 as csv
from {_links_sql("pages", R.LINK_TOKEN)} where link_pos < {MAX_ANCHORS}
""",
    "q13_link_extract": "select * from " + _links_sql("pages", R.LINK_TOKEN),
    "q14_missing_files": f"""
with listing as (select page_id, link_pos, link_text as __filename from {_links_sql("pages", None)}),
log as (select link_text as __filename
        from {_links_sql(f"(select * from pages where starts_with(url, '{R.LOADED_URL_PREFIX}'))", None)})
select * from listing l where not exists (select 1 from log g where g.__filename = l.__filename)
""",
    "q15_repeated_headers": """
select doc_id, lang, source from (
  select case when doc_id % 50 = 7 then 'DOC_ID' when doc_id % 50 = 13 then null
              else cast(doc_id as varchar) end as doc_id,
         case when doc_id % 50 = 7 then 'LANG' else lang end as lang,
         case when doc_id % 50 = 7 then 'SOURCE' else source end as source
  from documents
) where doc_id is distinct from 'DOC_ID'
""",
    "q16_conform_types": f"""
with raw as ({_ORDERS_TEXT}),
nt as (
  select {_nt('o_orderkey')} as o_orderkey, {_nt('begin_yearmonth')} as begin_yearmonth,
         {_nt('begin_date_time')} as begin_date_time, {_nt('magnitude')} as magnitude,
         {_nt('tor_length')} as tor_length, {_nt('state')} as state
  from raw
)
select o_orderkey,
       coalesce(try_cast(begin_yearmonth as integer),
                case when regexp_matches(begin_yearmonth, '{_NUMBER_TEXT}')
                     then try_cast(round(try_cast(begin_yearmonth as double)) as integer) end) as begin_yearmonth,
       {_CENTURY_TS.format(t="try_strptime(begin_date_time, '%d-%b-%y %H:%M:%S')", ym="begin_yearmonth")} as begin_date_time,
       case when regexp_matches(magnitude, '{_NUMBER_TEXT}')
            then try_cast(round(try_cast(magnitude as float)) as integer) end as magnitude,
       case when regexp_matches(tor_length, '{_NUMBER_TEXT}') then try_cast(tor_length as double) end as tor_length,
       state
from nt
""",
    "q17_row_hash_groups": """
select l_returnflag, count(*) as distinct_hashes
from (select distinct * from lineitem) group by l_returnflag
""",
    "q18_json_totals": """
select event_type, count(*) as n_rows, sum(t) as total_value,
       printf('Total order value is: %.2f', sum(t)) as total_line
from (select event_type,
             coalesce((select sum(coalesce(try_cast(value as double), 0)) from json_each(props)), 0) as t
      from events)
group by event_type
""",
    "q19_calendar": f"""
with cal(day_name, is_weekday, activity) as (values {_CAL_VALUES})
select e.event_id, c.day_name, dayofweek(e.ts) in (0, 6) as is_weekend, c.is_weekday, c.activity,
       case when c.is_weekday then 'weekday_activities' else 'weekend_activities' end
         || '.' || replace(c.activity, ' ', '_') as task_id,
       'It''s ' || upper(substr(c.day_name, 1, 1)) || substr(c.day_name, 2)
         || ' and I''m busy with ' || c.activity || '.' as message
from events e join cal c on lower(dayname(e.ts)) = c.day_name
""",
    "q20_union_filter": """
select id from (
  select cast(c_nationkey as integer) as id from customer
  union all select 1 union all select null
) where id = 1
""",
    "q21_clean_first_run": f"""
select * exclude (rn) from (
  select *, row_number() over (partition by o_orderkey order by __date_loaded, __filename) as rn
  from (select distinct * from {_TWO_LOADS})
) where rn = 1
""",
    "q22_clean_incremental": f"""
with raw as {_TWO_LOADS},
target as (
  select * exclude (rn) from (
    select *, row_number() over (partition by o_orderkey order by __date_loaded, __filename) as rn
    from raw where __date_loaded = timestamp '{R.FIRST_LOAD_AT}') where rn = 1
),
new_rows as (
  select * exclude (rn) from (
    select *, row_number() over (partition by o_orderkey order by __date_loaded, __filename) as rn
    from (select distinct * from raw)
    where coalesce(__date_loaded > (select max(__date_loaded) from target),
                   (select max(__date_loaded) from target) is null)
  ) where rn = 1
)
select * from target t where not exists (select 1 from new_rows n where n.o_orderkey = t.o_orderkey)
union all
select * from new_rows
""",
    "q23_yearly_totals": f"""
with d as (
  select o_orderstatus as state,
         year(o_orderdate) * 100 + month(o_orderdate) as begin_yearmonth,
         {_THOUSANDS} || (['', 'H', 'k', 'M', 'B', 't'])[(o_orderkey % 6) + 1] as damage_property,
         cast(o_custkey % 1000 as varchar) || (['', 'K', 'M'])[(o_orderkey % 3) + 1] as damage_crops
  from orders
)
select substr(cast(begin_yearmonth as varchar), 1, 4) as event_year, state,
       sum({_Q01_A}) as total_property_damage, sum({_Q23_CA}) as total_crop_damage
from d group by 1, 2
""",
    "q24_observed_values": 'select event_type, count(*) as "count" from events group by event_type',
    "q25_link_counts": f"select page_id, count(*) as num_links from {_LINKS_TOKEN} group by page_id",
    "q26_loaded_files": f"select distinct link_text as __filename from {_LOG_LINKS}",
    "q27_day_branches": f"""
with cal(day_name, is_weekday, activity) as (values {_CAL_VALUES})
select case when c.is_weekday then 'weekday' else 'weekend' end as branch,
       case when c.is_weekday then 'weekday_activities' else 'weekend_activities' end
         || '.' || replace(c.activity, ' ', '_') as task_id,
       count(*) as n_events
from events e join cal c on lower(dayname(e.ts)) = c.day_name
group by 1, 2
""",
    "q28_dq_lengths": _suite_sql("documents", R.Q28_SUITE),
    "q29_event_time_edges": f"""
with t as (
  select l_orderkey, l_linenumber,
         case l_orderkey % 5
           when 0 then upper(strftime(l_shipdate, '%d-%b-%y %H:%M:%S'))
           when 1 then lower(upper(strftime(l_shipdate, '%d-%b-%y %H:%M:%S')))
           when 2 then strftime(l_shipdate, '%-d-%b-%y %-H:%M:%S')
           when 3 then '31-FEB-' || strftime(l_shipdate, '%y') || ' 00:00:00'
           else ' ' || upper(strftime(l_shipdate, '%d-%b-%y %H:%M:%S')) || ' ' end as event_text,
         cast((year(l_shipdate) - case when l_linenumber % 3 = 0 then 100 else 0 end) * 100
              + month(l_shipdate) as integer) as begin_yearmonth
  from lineitem
)
select *, {_CENTURY_TS.format(t="try_strptime(trim(event_text), '%d-%b-%y %H:%M:%S')",
                              ym="cast(begin_yearmonth as varchar)")} as event_time
from t
""",
    "q40_mixed_suite": _suite_sql(
        "(select *, case when l_orderkey % 3 <> 0 then l_orderkey || '-' || l_suppkey end as l_comment_key from lineitem)",
        MIXED_SUITE),
    **FILE_ORACLE,
    **TABLE_ORACLE,
}
