"""The shared views again, in the SQL of the checking engine.

Later views read earlier ones; ``with_ctes`` adds what a view needs.
"""

from __future__ import annotations

import re

PAD = "case when length(cast({0} as varchar)) < 4 then lpad(cast({0} as varchar), 4, '0') else cast({0} as varchar) end"
CENTS = "cast(round({0} * 100) as bigint)"
W = "partition by entity_id order by day_no"


def _fill(source: str, column: str, reset: str = "false", block: str = "false", back: int = 0, fwd: str = "0") -> str:
    """Select list parts for one filled column, as nested subqueries over ``source``."""
    boxed = (
        f"case when coalesce({reset}, false) then {{'v': null, 'r': true}} "
        f"when coalesce({block}, false) then {{'v': null, 'r': false}} "
        f"when {column} is not null then {{'v': {column}, 'r': false}} end"
    )
    return (
        f"(select * exclude (bx_, by_, {column}), "
        f"(last_value(by_ ignore nulls) over ({W} rows between {fwd} preceding and current row)).v as {column} "
        f"from (select *, case when not bx_.r then bx_ end as by_ "
        f"from (select * replace (first_value(bx_ ignore nulls) over "
        f"({W} rows between current row and {back} following) as bx_) "
        f"from (select *, {boxed} as bx_ from {source}))))"
    )


def fill_many(source: str, columns: list[str], **options) -> str:
    for c in columns:
        source = _fill(source, c, **options)
    return source


def growth_ratio(num: str, den: str, days: int) -> str:
    f = f"over ({W} range between {days - 1} preceding and current row)"
    n = f"case when count({num}) {f} >= {days} then sum({num}) {f} end"
    d = f"case when count({den}) {f} >= {days} then sum({den}) {f} end"
    return f"({n}) / nullif({d}, 0)"


L = "(cast(35000 as double) * 3.78541)"
SIZE = "case when right(entity_id, 2) in ('06', '08') then cast(2 as double) else cast(1 as double) end"
LOGGED = "(coalesce(removed_volume > 0, false) or coalesce(split_volume > 0, false))"
MOVED = "(coalesce(est_removed_mass > 0, false) or coalesce(est_split_mass > 0, false))"
# Two decimals, halves up on the decimal text of the number, as Spark rounds.
R2 = "cast(round(cast({0} as decimal(38, 9)), 2) as double)"

VIEWS = {
    "event_days": f"select *, {PAD.format('user_id')} as entity_id, cast(ts as date) as obs_date from events",
    "entities": "select distinct entity_id from event_days",
    "raw_obs": f"""
        select entity_id, obs_date,
               cast(view_cents as double) / (view_n * cast(10000 as double)) as density,
               cast(click_cents as double) / (click_n * cast(400 as double)) as depth,
               case when cast(signup_cents as double) / (signup_n * cast(50 as double)) >= 100 then cast(100 as double)
                    else cast(signup_cents as double) / (signup_n * cast(50 as double)) end as purity_pct,
               cast(removed_cents as double) / 100 as removed_volume, cast(split_cents as double) / 100 as split_volume, sampled_at,
               case when me >= 150 then 'I' when me >= 140 then 'Q' when mp >= 150 then 'HC' when mp >= 100 then 'S'
                    when mp >= 60 then 'H' end as move_code
        from (select entity_id, obs_date,
                     sum({CENTS.format('value')}) filter (where event_type = 'view') as view_cents,
                     count(*) filter (where event_type = 'view') as view_n,
                     sum({CENTS.format('value')}) filter (where event_type = 'click') as click_cents,
                     count(*) filter (where event_type = 'click') as click_n,
                     sum({CENTS.format('value')}) filter (where event_type = 'signup') as signup_cents,
                     count(*) filter (where event_type = 'signup') as signup_n,
                     sum({CENTS.format('value')}) filter (where event_type = 'purchase' and value >= 60) as removed_cents,
                     sum({CENTS.format('value')}) filter (where event_type = 'signup' and value >= 80) as split_cents,
                     max(value) filter (where event_type = 'purchase') as mp,
                     max(value) filter (where event_type = 'error') as me,
                     min(ts) filter (where event_type in ('view', 'click')) as sampled_at
              from event_days group by 1, 2)""",
    "daily_obs": "select * from raw_obs",
    "lab_samples": f"""
        select event_id,
               case when event_id % 11 = 0 then 'no id here'
                    when event_id % 7 = 0 then concat('S ', lpad(cast(user_id % 1000 as varchar), 3, '0'), ' ', strftime(ts, '%y%m%d'))
                    when event_id % 13 = 0 then concat('S ', {PAD.format('user_id')}, ' undated')
                    when event_id % 23 = 0 then concat('S ', cast(user_id + 100000 as varchar), ' ', strftime(ts, '%y%m%d'))
                    else concat('S ', {PAD.format('user_id')}, ' ', strftime(ts, '%y%m%d'), ' rpt') end as sample_label,
               case when event_id % 17 = 0 then '0' when event_id % 19 = 0 then 'n/d'
                    else cast(value / 20 as varchar) end as val_text,
               cast(value / 10 as varchar) as val_total_text
        from events where event_type = 'error'""",
    "parsed_all": """
        select event_id, entity_id, obs_date, quality_val, quality_total
        from (select event_id,
                     case when regexp_matches(sample_label, '(?:^|\\s)\\d{4,}(?:\\s.*?)?\\s\\d{6}(?:\\s|$)')
                          then regexp_extract(sample_label, '(?:^|\\s)(\\d{4,})(?:\\s.*?)?\\s\\d{6}(?:\\s|$)', 1)
                          when regexp_matches(sample_label, '(?:^|\\s)\\d{3}(?:\\s.*?)?\\s\\d{6}(?:\\s|$)')
                          then '0' || regexp_extract(sample_label, '(?:^|\\s)(\\d{3})(?:\\s.*?)?\\s\\d{6}(?:\\s|$)', 1) end as entity_id,
                     cast(try_strptime(regexp_extract(sample_label, '(?:^|\\s)\\d{3,}(?:\\s.*?)?\\s(\\d{6})(?:\\s|$)', 1), '%y%m%d') as date) as obs_date,
                     try_cast(val_text as double) as quality_val, try_cast(val_total_text as double) as quality_total
              from lab_samples)
        where entity_id is not null and obs_date is not null and quality_val <> 0 and quality_total is not null""",
    "parsed": "select * from parsed_all where entity_id in (select entity_id from entities)",
    "samples": """
        select entity_id, obs_date, avg(quality_val) as quality_val, avg(quality_total) as quality_total
        from parsed group by 1, 2""",
    "removal_log": """
        select event_id as row_no, case when event_id % 2 = 0 then '1.1' else '2.2' end as source_tag,
               entity_id, obs_date, value / 4 as initial_depth, value / 10 as final_depth, value * 1000 as volume,
               case when event_id % 3 = 0 then props end as notes
        from event_days where event_type = 'purchase'""",
    "daily_inputs": f"""
        select {PAD.format('l_suppkey')} as entity_id, cast(l_shipdate as date) as obs_date,
               {', '.join(f'sum(l_quantity) filter (where l_linenumber = {i}) as in_{i}' for i in range(1, 8))}
        from lineitem group by 1, 2""",
    "shipped_back": f"""
        select {PAD.format('l_suppkey')} as entity_id, cast(l_shipdate as date) as obs_date,
               sum(l_quantity) filter (where l_returnflag = 'R') as est_removed_mass
        from lineitem group by 1, 2""",
    "site_daily": f"""
        select cast(o_orderdate as date) as obs_date,
               cast(sum({CENTS.format('o_totalprice')}) as double) / 100 as usage_qty,
               cast(sum({CENTS.format('o_totalprice')}) filter (where o_orderstatus = 'F') as double) / 100 as primary_qty,
               cast(sum({CENTS.format('o_totalprice')}) filter (where o_orderstatus = 'O') as double) / 100 as secondary_qty,
               min(o_orderpriority) filter (where o_orderstatus = 'P') as notes
        from orders group by 1""",
    "indicators": """
        select entity_id, obs_date,
               max(value) filter (where event_type = 'view') / cast(100 as double) + cast(7.5 as double) as ph,
               max(value) filter (where event_type = 'click') / cast(80 as double) + cast(0 as double) as rotifers,
               max(value) filter (where event_type = 'purchase') / cast(90 as double) + cast(0 as double) as attached_fd,
               max(value) filter (where event_type = 'error') / cast(100 as double) + cast(0 as double) as floating_fd,
               max(value) filter (where event_type = 'signup') / cast(120 as double) + cast(0 as double) as golden_flagellates,
               max(value) filter (where event_type = 'view') / cast(160 as double) + cast(0 as double) as diatoms,
               max(value) filter (where event_type = 'click') / cast(200 as double) + cast(0 as double) as tetra,
               max(value) filter (where event_type = 'purchase') / cast(240 as double) + cast(0 as double) as green_algae
        from event_days group by 1, 2""",
    "facts": "select * from daily_obs full join samples using (entity_id, obs_date)",
    "grid": """
        select k.entity_id, k.obs_date, datediff('day', date '1970-01-01', k.obs_date) as day_no,
               f.* exclude (entity_id, obs_date)
        from (select entity_id, cast(d as date) as obs_date
              from (select distinct entity_id from facts),
                   (select unnest(generate_series(cast(min(obs_date) as timestamp), cast(max(obs_date) as timestamp),
                                                  interval 1 day)) as d from facts)) k
        left join facts f on f.entity_id = k.entity_id and f.obs_date = k.obs_date""",
    # The newest mark of the last six days decides.
    "state": f"""
        select * exclude (mark_),
               coalesce(arg_max(mark_, day_no) filter (where mark_ is not null)
                        over ({W} range between 5 preceding and current row), 0) = 1 as active
        from (select *, case when sampled_at is not null then
                                  case when density <> 0 then 1 end
                             when lag(move_code) over ({W}) = 'HC'
                                  or (move_code = 'I' and lag(move_code) over ({W}) = 'H') then 0 end as mark_
              from grid)""",
    "mass": f"""
        select * replace (nullif(mass, 0) as mass, nullif(mass_corrected, 0) as mass_corrected,
                          nullif(removable_inches, 0) as removable_inches, nullif(removable_gallons, 0) as removable_gallons,
                          nullif(removable_mass, 0) as removable_mass,
                          nullif(removable_mass_corrected, 0) as removable_mass_corrected)
        from (select *, {R2.format('mass * (purity_pct / 100)')} as mass_corrected,
                     {R2.format('removable_mass * (purity_pct / 100)')} as removable_mass_corrected
              from (select *, removable_inches * 35000 * ({SIZE}) as removable_gallons,
                           {R2.format(f'density * ({L} * ({SIZE})) * removable_inches / 1000')} as removable_mass
                    from (select *,
                                 case when density <> 0 and depth <> 0
                                      then {R2.format(f'density * ({L} * ({SIZE})) * depth / 1000')} end as mass,
                                 case when density >= 0.5 and depth <> 0
                                      then greatest(floor((depth * density - cast(13 as double) * cast(0.4 as double)) / density * 8) / 8, 0) end
                                 as removable_inches
                          from state)))""",
    "classed": f"""
        select * exclude (next_),
               case when removed_volume is null and split_volume is null and (move_code is null or move_code = 'I') then null
                    when move_code = 'HC' or (next_ = 'I' and move_code = 'H') then 'HC'
                    when next_ = 'I' and move_code is null then 'HC'
                    when move_code = 'H' then 'H'
                    when move_code = 'SC' or (next_ = 'I' and move_code = 'S') then 'SC'
                    when move_code = 'S' then 'S'
                    when removed_volume > 0 then 'H' when split_volume > 0 then 'S' end as move_class,
               not (removed_volume is null and split_volume is null and (move_code is null or move_code = 'I'))
               and not coalesce(move_code in ('HC', 'H', 'SC', 'S'), false)
               and not coalesce(next_ = 'I' and move_code is null, false)
               and not coalesce(removed_volume > 0, false) and not coalesce(split_volume > 0, false) as move_unmatched
        from (select *, lead(move_code) over ({W}) as next_ from mass)""",
    "differential": f"""
        select * exclude (next_mass, class0, moved_),
               case when moved_ < 0 then null else class0 end as move_class,
               case when class0 in ('H', 'HC') and not coalesce(moved_ < 0, false) then moved_ end as est_removed_mass,
               case when class0 in ('S', 'SC') and not coalesce(moved_ < 0, false) then moved_ end as est_split_mass
        from (select *, case when class0 in ('H', 'S') then mass_corrected - next_mass
                             when class0 in ('HC', 'SC') then mass_corrected end as moved_
              from (select * exclude (move_class), move_class as class0,
                           lead(mass_corrected) over ({W}) as next_mass from classed))""",
    "log_estimate": f"""
        select * exclude (d_, p_),
               case when active then d_ * (p_ / 100) * removed_volume * cast(3.78541 as double) / 1000 end as est_removed_log
        from {_fill(_fill('(select *, density as d_, purity_pct as p_ from differential)', 'd_',
                          reset=LOGGED, block='not active', back=5, fwd='5'),
                    'p_', reset=LOGGED, back=5, fwd='5')}""",
    "moves": """
        select * replace (case when est_removed_mass is null and move_class is not null then est_removed_log
                               else est_removed_mass end as est_removed_mass)
        from log_estimate""",
    "measured": "select * from "
    + fill_many(
        "(select *, case when quality_val is not null then true end as is_measured, "
        "case when quality_val is not null then obs_date end as measured_on from state)",
        ["quality_val", "quality_total", "measured_on"],
        block="not active",
        fwd="unbounded",
    ),
    "moves_measured": "select * from "
    + fill_many(
        "(select *, case when quality_val is not null then true end as is_measured, "
        "case when quality_val is not null then obs_date end as measured_on from moves)",
        ["quality_val", "quality_total", "measured_on"],
        block="not active",
        fwd="unbounded",
    ),
    "reported": f"""
        select * exclude (quiet_, island_),
               case when active then sum(quiet_) over (partition by entity_id, island_ order by day_no
                                                       rows unbounded preceding) end as days_since_event
        from (select *, sum(1 - quiet_) over ({W} rows unbounded preceding) as island_
              from (select *, case when active and est_removed_mass is null and est_split_mass is null
                                   then 1 else 0 end as quiet_ from moves_measured))""",
    "filled": "select * from "
    + fill_many(
        f"""(select *, case when density <> 0 and depth <> 0 then depth * {L} end as liters,
                    case when density <> 0 and depth <> 0 then depth * {L} * (density / cast(0.5 as double)) end as norm_liters,
                    mass_corrected as filled_mass from reported)""",
        ["liters", "norm_liters", "filled_mass"],
        reset=f"{MOVED} and mass_corrected is null",
        back=5,
        fwd="5",
    ),
    # Own value, or the next calendar day's where something was moved; active rows only.
    "corrected": f"""
        select a.*, {', '.join(f'case when {MOVED} then n.{c} else a.{c} end as hc_{c}'
                               for c in ('liters', 'norm_liters', 'filled_mass'))}
        from (select * from filled where active) a
        left join (select entity_id as e, day_no as d, liters, norm_liters, filled_mass from filled where active) n
          on n.e = a.entity_id and n.d = a.day_no + 1""",
    "before": f"""
        select *, sum(r_) over ({W} range between 5 preceding and current row) as removed_before,
               sum(s_) over ({W} range between 5 preceding and current row) as split_before
        from (select *, lag(coalesce(est_removed_mass, 0)) over ({W}) as r_,
                     lag(coalesce(est_split_mass, 0)) over ({W}) as s_ from corrected)""",
    "changed": """
        select b.*, p.hc_liters as prev_liters_7d, p.hc_norm_liters as prev_norm_liters_7d,
               case when removed_before + split_before + b.filled_mass - p.hc_filled_mass > 0
                    then removed_before + split_before + b.filled_mass - p.hc_filled_mass else 0 end * 1000
               as mass_change_grams_7d
        from before b
        left join (select entity_id as e, day_no as d, hc_liters, hc_norm_liters, hc_filled_mass from before) p
          on p.e = b.entity_id and p.d = b.day_no - 7""",
    "valid": f"""
        select entity_id, obs_date,
               count(*) over ({W} range between 7 preceding and current row) = 8
               and count(*) filter (where not active) over ({W} range between 7 preceding and current row) = 0 as valid
        from state""",
    "changes": """
        select c.* replace (case when v.valid then mass_change_grams_7d end as mass_change_grams_7d,
                            case when v.valid then prev_liters_7d end as prev_liters_7d,
                            case when v.valid then prev_norm_liters_7d end as prev_norm_liters_7d)
        from changed c join valid v using (entity_id, obs_date)""",
    "ratios": f"""
        select entity_id, obs_date, mass_change_grams_7d, prev_liters_7d, prev_norm_liters_7d,
               {growth_ratio('mass_change_grams_7d', 'prev_liters_7d', 5)} as growth_5d,
               {growth_ratio('mass_change_grams_7d', 'prev_norm_liters_7d', 5)} as norm_growth_5d,
               {growth_ratio('mass_change_grams_7d', 'prev_liters_7d', 14)} as growth_14d,
               {growth_ratio('mass_change_grams_7d', 'prev_norm_liters_7d', 14)} as norm_growth_14d
        from changes""",
    "growth": """
        select r.*, g.* exclude (entity_id, obs_date)
        from reported r left join ratios g on g.entity_id = r.entity_id and g.obs_date = r.obs_date""",
    "site_growth": """
        select obs_date, c as mass_change_grams_7d, v as prev_liters_7d, n as prev_norm_liters_7d,
               case when k5 >= 5 then c5 / nullif(v5, 0) end as agg_growth_5d,
               case when k5 >= 5 then c5 / nullif(n5, 0) end as agg_norm_growth_5d,
               case when k14 >= 14 then c14 / nullif(v14, 0) end as agg_growth_14d,
               case when k14 >= 14 then c14 / nullif(n14, 0) end as agg_norm_growth_14d
        from (select *, count(*) over a as k5, sum(c) over a as c5, sum(v) over a as v5, sum(n) over a as n5,
                     count(*) over b as k14, sum(c) over b as c14, sum(v) over b as v14, sum(n) over b as n14
              from (select obs_date, datediff('day', date '1970-01-01', obs_date) as day_no,
                           coalesce(sum(mass_change_grams_7d), 0) as c, coalesce(sum(prev_liters_7d), 0) as v,
                           coalesce(sum(prev_norm_liters_7d), 0) as n
                    from growth group by 1)
              window a as (order by day_no range between 4 preceding and current row),
                     b as (order by day_no range between 13 preceding and current row))""",
    "coded": f"""
        select * exclude (sd_),
               case when not active then 0 when sd_ is null or quality_val is null then 1
                    when sd_ < 0.25 then 2
                    when sd_ >= 0.25 and quality_val < 2.5 then 3
                    when (sd_ >= 0.25 and sd_ < 0.5) or (quality_val >= 2.5 and quality_val < 3) then 4
                    when sd_ >= 0.5 and sd_ < 0.8 and quality_val >= 3 then 5
                    when sd_ >= 0.8 and quality_val >= 3 then 6 end as status_code
        from {_fill('(select *, density as sd_ from growth)', 'sd_', block='not active', fwd='2')}""",
    "coded_only": f"""
        select * exclude (sd_),
               case when not active then 0 when sd_ is null or quality_val is null then 1
                    when sd_ < 0.25 then 2 when quality_val < 2.5 then 3
                    when sd_ < 0.5 or quality_val < 3 then 4 when sd_ < 0.8 then 5 else 6 end as status_code
        from {_fill('(select *, density as sd_ from measured)', 'sd_', block='not active', fwd='2')}""",
}


# Readings on every day, gaps with the last known ones, in place of the gappy view.
DENSE = {
    "daily_obs": f"""
        select entity_id, obs_date, {', '.join(f'last_value({c} ignore nulls) over ({W} rows unbounded preceding) as {c}'
                                               for c in ('density', 'depth', 'purity_pct'))},
               removed_volume, split_volume, sampled_at, move_code
        from (select k.entity_id, k.obs_date, datediff('day', date '1970-01-01', k.obs_date) as day_no,
                     o.* exclude (entity_id, obs_date)
              from (select entity_id, cast(d as date) as obs_date from entities,
                    (select unnest(generate_series(cast(min(obs_date) as timestamp), cast(max(obs_date) as timestamp),
                                                   interval 1 day)) as d from event_days)) k
              left join raw_obs o on o.entity_id = k.entity_id and o.obs_date = k.obs_date)"""
}


# Readings of seven years, from whole numbers.
LONG = {
    "shipped": f"""
        select {PAD.format('(l_suppkey // 4)')} as entity_id, cast(l_shipdate as date) as obs_date,
               cast(sum(l_orderkey) as bigint) as k, cast(sum(l_partkey) as bigint) as p
        from lineitem group by 1, 2""",
    "daily_obs": """
        select entity_id, obs_date, case when k % 9 <> 0 then cast(k % 80 + 10 as double) / 100 end as density,
               case when k % 11 <> 0 then cast(p % 12 + 6 as double) end as depth, cast(60 + p % 40 as double) as purity_pct,
               case when k % 97 = 0 then cast(1000 * (1 + p % 9) as double) end as removed_volume,
               case when k % 89 = 0 then cast(500 * (1 + p % 7) as double) end as split_volume,
               case when k % 13 <> 0 then cast(obs_date as timestamp) end as sampled_at,
               case when k % 97 = 0 and p % 2 = 0 then 'H' when k % 89 = 0 and p % 2 = 0 then 'S'
                    when k % 199 = 0 then 'HC' when k % 211 = 0 then 'I' when k % 223 = 0 then 'Q' end as move_code
        from shipped""",
    "samples": """
        select entity_id, obs_date, 1 + cast(p % 40 as double) / 10 as quality_val,
               1 + cast(p % 40 as double) / 10 + 1 as quality_total
        from shipped where k % 17 = 0""",
}


def with_ctes(names: list[str], dense: bool = False, long: bool = False) -> str:
    """A WITH clause of the named views and all they read, in order of need."""
    views = VIEWS | (DENSE if dense else {}) | (LONG if long else {})
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in views:
            if need != name and re.search(rf"(?:from|join)\s+{need}\b", views[name]):
                add(need)
        ordered.append(name)

    for n in names:
        add(n)
    if not ordered:
        return ""
    return "with " + ", ".join(f"{n} as materialized ({views[n]})" for n in ordered)
