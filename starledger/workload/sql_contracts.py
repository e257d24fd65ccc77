"""SQL equivalents of the queries on whole contracts, snapshot evolution and weekly runs.

Rule bounds and the derived input columns are shared with the Spark side; conditions,
counts and comparisons are written anew for DuckDB.
"""

from __future__ import annotations

from starledger.operators.contracts import Contract, Rule
from starledger.plans.contracts import CANONICAL, GP, SATCAT
from starledger.workload.inputs import GP_COLUMNS, SATCAT_COLUMNS
from starledger.workload.sql import CATALOG, DESCRIBED, MATCH, ORACLES, RAW, SNAPSHOTS

CONTRACT_ORACLES: dict[str, str] = {}


def _broken(name: str, rule: Rule) -> str:
    """When a value breaks a rule, in DuckDB's terms; null breaks none."""
    bound = rule.bound
    if rule.check == "matches":
        pattern = bound.replace(r"\z", "$")
        return f"not regexp_matches(\"{name}\", '{pattern}')"
    if rule.check == "isin":
        return f"\"{name}\" not in ({', '.join(repr(v) for v in bound)})"
    limit = f"date '{bound}'" if hasattr(bound, "isoformat") else f"cast({bound} as double)"
    sign = {"ge": "<", "gt": "<=", "le": ">", "lt": ">="}[rule.check]
    return f'"{name}" {sign} {limit}'


def _summary(contract: Contract, rows: str) -> str:
    """Violations per rule over the relation `rows`."""
    checks = [("*", "non_empty", None)]
    for f in contract.fields:
        checks += [] if f.nullable else [(f.name, "not_null", f'"{f.name}" is null')]
        checks += [(f.name, rule.label, _broken(f.name, rule)) for rule in f.rules]
    selects = [
        f"""select '{name}' as column_name, '{label}' as "check",
                   {f'count(*) filter (where {fails})' if fails else 'cast(count(*) = 0 as bigint)'} as violations,
                   count(*) as rows from {rows}"""
        for name, label, fails in checks
    ]
    return "\nunion all\n".join(selects)


def _whole(columns: dict[str, str]) -> str:
    listed = ", ".join(f'{sql} as "{name}"' for name, sql in columns.items())
    return f"with {DESCRIBED}, whole as (select {listed} from described)"


CONTRACT_ORACLES["gp_violations"] = f"{_whole(GP_COLUMNS)} {_summary(GP, 'whole')}"
CONTRACT_ORACLES["satcat_violations"] = f"{_whole(SATCAT_COLUMNS)} {_summary(SATCAT, 'whole')}"
CONTRACT_ORACLES["canonical_violations"] = (
    f"with canonical_rows as ({ORACLES['canonical_rows']}) {_summary(CANONICAL, 'canonical_rows')}"
)
CONTRACT_ORACLES["gp_csv"] = f"{_whole(GP_COLUMNS)} select * from whole"
CONTRACT_ORACLES["edge_space_counts"] = f"""with {RAW}
select column_name, count(*) filter (where regexp_matches(value, '^[\\s\\x{{a0}}]|[\\s\\x{{a0}}]$')) as n from (
    select unnest(['International Designator', 'National Designator', 'Name of Space Object',
                   'State of Registry', 'Status', 'Function', 'Remarks', 'Registration Documents',
                   'External website']) as column_name,
           unnest([designator, national, name, state, status, "function", remarks, documents,
                   website]) as value
    from raw) group by 1"""
CONTRACT_ORACLES["snapshot_evolution"] = """
select snapshot_date, o_orderstatus, o_orderpriority, count(*) as n from (
    select date '2026-04-19' as snapshot_date, o_orderstatus from orders
    union all by name
    select date '2026-04-26' as snapshot_date, o_orderstatus, o_orderpriority from orders)
group by all"""
CONTRACT_ORACLES["contract_evolution"] = f"""with {SNAPSHOTS},
b as (select list(distinct o_orderpriority) as p, list(distinct o_orderstatus) as s,
             min(o_orderdate) as low, max(o_orderdate) as high from prev),
a as (select list(distinct o_orderpriority) as p, list(distinct o_orderstatus) as s,
             min(o_orderdate) as low, max(o_orderdate) as high from curr)
select column_name, change, case when wider then 'additive' else 'breaking' end as tier from (
    select 'o_orderpriority' as column_name, 'rule isin' as change, list_has_all(a.p, b.p) as wider,
           list_has_all(a.p, b.p) and list_has_all(b.p, a.p) as same from a, b
    union all
    select 'o_orderstatus', 'rule isin', list_has_all(list_filter(a.s, lambda x: x is not null), list_filter(b.s, lambda x: x is not null)),
           list_has_all(list_filter(a.s, lambda x: x is not null), list_filter(b.s, lambda x: x is not null))
           and list_has_all(list_filter(b.s, lambda x: x is not null), list_filter(a.s, lambda x: x is not null)) from a, b
    union all
    select 'o_orderdate', 'rule ge', a.low <= b.low, a.low = b.low from a, b
    union all
    select 'o_orderdate', 'rule le', a.high >= b.high, a.high = b.high from a, b)
where not same"""

WEEKLY = f"""{DESCRIBED},
loads as (
    select later, y || '-' || lpad(k, 9, '0') || 'A' as designator, 'Object ' || k as name,
           'State ' || (o_custkey % 50) as state, o_orderdate as launch,
           case when later and o_orderstatus = 'P' then 'in orbit' when o_orderstatus = 'F' then 'decayed'
                when o_orderstatus = 'O' then 'in orbit' else 'active' end as status,
           case when o_orderstatus = 'F' and p = '4' then cast(o_orderdate - 10 as date)
                when o_orderstatus = 'F' or p = '3' then cast(o_orderdate + 90 as date) end as decay,
           p = '2' or (not later and p = '3') as flag
    from described cross join (values (true), (false)) t(later)
    where p <> case when later then '5' else '1' end),
prev as (select * from loads where not later),
curr as (select * from loads where later),
changed as (
    select designator, unnest(['Status', 'UN Registered']) as column_name,
           unnest([prev.status, cast(prev.flag as varchar)]) as old_value,
           unnest([curr.status, cast(curr.flag as varchar)]) as new_value
    from prev join curr using (designator)),
changes as (select * from changed where old_value is distinct from new_value)"""

_TOP = "(select state from {0} group by 1 order by count(*) desc, state limit 10)"

CONTRACT_ORACLES["changelog"] = f"with {WEEKLY} select *, 1 as n_pairs from changes"
CONTRACT_ORACLES["weekly_run"] = f"""with {WEEKLY},
sizes as (select (select count(*) from prev) as before, (select count(*) from curr) as after,
                 (select count(*) from curr anti join prev using (designator)) as added,
                 (select count(*) from prev anti join curr using (designator)) as removed,
                 (select count(distinct designator) from changes) as rows_changed,
                 (select count(*) from changes) as values_changed,
                 (select count(*) from (select state from curr group by 1 having count(*) < 3)) as rare,
                 (select count(*) from ({_TOP.format('prev')} except {_TOP.format('curr')}))
                 + (select count(*) from ({_TOP.format('curr')} except {_TOP.format('prev')})) as moved,
                 abs((select avg(cast(flag as int)) from curr) - (select avg(cast(flag as int)) from prev)) * 100 as drift)
select 'expectations' as report, 'launch_year' as name, count(*) = 0 as passed, count(*) as n
          from curr where year(launch) not between 1957 and 1998 + 2
union all select 'expectations', 'format_year_coherence', true, 0
union all select 'expectations', 'xxxx_placeholders', true, 0
union all select 'expectations', 'whitespace_residual', true, 0
union all select 'expectations', 'cardinality', abs(after - before) / before <= 0.05,
                 cast(abs(after - before) / before > 0.05 as int) from sizes
union all select 'expectations', 'sor_outliers', rare = 0, rare from sizes
union all select 'drift', 'new_rows', added between 10 and 500, added from sizes
union all select 'drift', 'flagged_share', round(drift, 9) <= 2, cast(round(drift, 9) > 2 as int) from sizes
union all select 'drift', 'top_values', moved = 0, moved from sizes
union all select 'drift', 'total_rows', after between 20000 and 60000, after from sizes
union all select 'diff', 'n_added', true, added from sizes
union all select 'diff', 'n_removed', true, removed from sizes
union all select 'diff', 'n_modified_rows', true, rows_changed from sizes
union all select 'diff', 'n_modified_changes', true, values_changed from sizes
union all select 'warnings', 'in orbit with a decay date', false, count(*) from curr
          where status in ('in orbit', 'active') and decay is not null having count(*) > 0
union all select 'warnings', 'decay before launch', false, count(*) from curr
          where decay < launch having count(*) > 0"""
CONTRACT_ORACLES["satcat_csv"] = f"{_whole(SATCAT_COLUMNS)} select * from whole"
CONTRACT_ORACLES["csv_quarantine"] = f"""with {DESCRIBED}
select 'ragged' as problem, cast(null as varchar) as column_name,
       case p when '1' then 'OBJ ' || k || ',' || k else 'OBJ ' || k || ',' || k || ',' || d || ',more' end
           as value, true as has_file
from described where p in ('1', '2') and o_orderstatus = 'P'
union all
select 'unreadable', 'NUMBER', case p when '3' then 'n' || k else 'x' end, true
from described where p in ('3', '4') and o_orderstatus = 'P'
union all
select 'unreadable', 'DAY', y || '-13-01', true from described where p = '4' and o_orderstatus = 'P'"""
CONTRACT_ORACLES["csv_accepted"] = f"""with {DESCRIBED}
select 'OBJ ' || k as "NAME", case when p <> '5' then o_orderkey end as "NUMBER",
       cast(o_orderdate as date) as "DAY"
from described where o_orderstatus <> 'P' or p = '5'"""
CONTRACT_ORACLES["landed_bodies"] = f"""with {CATALOG}
select 'rows' as body, 'read' as outcome, count(*) as n from sat
union all select 'header only', 'read', 0
union all select 'empty', 'refused', null"""
CONTRACT_ORACLES["empty_load"] = """
with named as (
    select unnest(['International Designator', 'National Designator', 'Name of Space Object',
                   'State of Registry', 'Date of Launch', 'Status', 'Date of Decay', 'UN Registered',
                   'Registration Documents', 'Function', 'Remarks', 'External website']) as column_name),
loads as (select 'empty' as load, 0 as n union all select 'full', count(*) from orders)
select load, n, column_name,
       case when column_name like 'Date of%' then 'date' when column_name = 'UN Registered' then 'boolean'
            else 'string' end as dtype
from loads, named"""
CONTRACT_ORACLES["missing_columns"] = """
with wanted as (
    select unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'price', 'o_orderdate',
                   'o_orderpriority']) as column_name),
tables as (
    select 'orders' as table_name, count(*) as n from orders
    union all select 'lineitem', count(*) from lineitem
    union all select 'customer', count(*) from customer)
select table_name, n, column_name from tables, wanted
where table_name <> 'orders' or column_name = 'price'"""
CONTRACT_ORACLES["snapshot_date_inside"] = f"""with {SNAPSHOTS},
rows as (
    select date '2026-04-19' as snapshot_date, o_orderstatus from prev
    union all
    select date '2026-04-26', o_orderstatus from curr)
select 'history' as read, snapshot_date, o_orderstatus, count(*) as n from rows group by all
union all
select 'date', snapshot_date, o_orderstatus, count(*) from rows
where snapshot_date = date '2026-04-26' group by all"""
CONTRACT_ORACLES["catalog_repeated_numbers"] = f"""with {CATALOG},
numbers as (
    select n, sum(in_gp) as g, sum(in_sat) as s from (
        select norad // 7 * 7 % 1001 as n, 1 as in_gp, 0 as in_sat from gp
        union all
        select norad // 7 * 7 % 1001, 0, 1 from sat) group by 1)
select n as "NORAD_CAT_ID", cast(least(g, s) as bigint) as pairs,
       cast(greatest(g - s, 0) as bigint) as gp_only, cast(greatest(s - g, 0) as bigint) as satcat_only
from numbers"""
CONTRACT_ORACLES["canonical_precedence"] = f"""with {MATCH}
select coalesce(designator, "OBJECT_ID") as cospar_id, "NORAD_CAT_ID" as norad_cat_id,
       coalesce(decay, case when "NORAD_CAT_ID" % 3 = 0 then cast("LAUNCH_DATE" + 333 as date) end,
                "DECAY_DATE") as date_of_decay, match_source
from matched left join registry using (lid)
     left join catalog on matched.rid = "NORAD_CAT_ID"
"""
