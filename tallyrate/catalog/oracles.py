"""DuckDB SQL that each query must agree with, on the raw tables.

Written in the step-by-step form (group, join to totals, union), not in the
single-pass form of the queries, so that the two check each other.
"""

from __future__ import annotations

ATTEMPTS = """
attempts_v as (
  select l_orderkey as attempt_key,
         cast(l_linenumber as int) as period,
         cast(cast(floor(l_extendedprice) as bigint) % 95 as int) as loc_x,
         cast(p_size as int) as loc_y,
         concat(p_name, ' ', p_type) as action_type,
         p_brand as shot_zone_basic,
         p_type as shot_zone_area,
         l_discount * 200 as defender_distance,
         case when l_orderkey % 61 = 30 then 'TIE'
              else cast(l_orderkey % 61 - 30 as varchar) end as scoremargin,
         l_linestatus as htm,
         case when l_linestatus = 'O' then 'F' else 'O' end as vtm,
         case when l_returnflag = 'R' then 1 else 0 end as shot_made_flag
  from lineitem join part on l_partkey = p_partkey
)"""

MARGIN = "cast(case when scoremargin = 'TIE' then '0' else scoremargin end as double)"
BUCKET = f"cast(trunc({MARGIN} / 5) as int)"
BINS = """case when defender_distance < 1 then 0 when defender_distance < 3 then 1
              when defender_distance < 5 then 2 when defender_distance < 7 then 3
              when defender_distance < 10 then 4 when defender_distance < 15 then 5
              else 6 end"""
CATEGORY = """case when contains(action_type, 'gear') then 'Gear'
              when contains(action_type, 'ring') then 'Ring'
              when contains(action_type, 'cold') then 'Cold'
              when contains(action_type, 'hot') then 'Hot' else 'Else' end"""

_NEEDED = "replace(replace(replace(action_type, 'gear', 'Jump'), 'ring', 'Layup'), 'hot', 'Fadeaway')"
NEEDLES = f"""case when contains({_NEEDED}, 'Tip') then 'Tip Shot'
              when contains({_NEEDED}, 'Layup') then 'Layup Shot'
              when contains({_NEEDED}, 'Jump') then 'Jump Shot'
              when contains({_NEEDED}, 'Fadeaway') then 'Fadeaway Shot' else 'Else' end"""

CELLS = f"""
cells as (
  select attempt_key, loc_x, loc_y, shot_zone_basic, shot_zone_area, action_type, shot_made_flag,
         case when loc_x > 47 then 94 - loc_x else loc_x end as x_half,
         case when loc_x > 47 then 50 - loc_y else loc_y end as y_half,
         concat(shot_zone_basic, ' ', shot_zone_area) as zone,
         {BINS} as dist_bin,
         greatest(-3, least(3, {BUCKET})) as margin_cat,
         case when period > 5 then 5 else period end as period
  from attempts_v
)"""

CELL = "zone, dist_bin, margin_cat, period"
PCT2 = ("cast(floor(cast(cast({0} as float) / cast({1} as float) as double) * 100 + 0.5)"
        " as double) / 100")

RATES = f"""
outcomes as (
  select {CELL}, shot_made_flag, count(*) as shots from cells group by all
), cell_totals as (
  select {CELL}, count(*) as total from cells group by all
), joined as (
  select * from outcomes join cell_totals using ({CELL}) where total >= 2
), rated as (
  select *, {PCT2.format('shots', 'total')} as fg from joined
), united as (
  select {CELL}, shot_made_flag, shots, total, fg from rated
  union all
  select {CELL}, 1, 0, total, 0 from rated where shot_made_flag = 0 and shots = total
)"""

EVENTS = """
events_v as (
  select user_id as game_id,
         event_id as eventnum,
         cast(extract(day from ts) % 4 + 1 as int) as period,
         cast(extract(minute from ts) as int) as minutes_remaining,
         cast(floor(extract(second from ts)) as int) as seconds_remaining,
         case when event_type in ('purchase', 'signup')
              then regexp_extract(props, '([0-9]+)', 1) end as scoremargin,
         case when event_type <> 'view'
              then cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 end as actioncode,
         case when event_type = 'click' then 'MISS user shot'
              when event_type = 'purchase' then 'user (3 PTS)'
              when event_type = 'error' then 'user FOUL' end as homedescription,
         case when event_type = 'signup' then 'user 2 PTS'
              when event_type = 'view' then 'MISSED' end as visitordescription,
         case when user_id % 2 = 0 then 'O' else 'F' end as htm,
         value
  from events
), timed as (
  select *, concat('00', game_id, ':', period, ':',
                   lpad(cast(minutes_remaining as varchar), 2, '0')) as time,
         concat('00', game_id, ':', period, ':', minutes_remaining, ':',
                lpad(cast(seconds_remaining as varchar), 2, '0')) as exact_time,
         coalesce(last_value(scoremargin ignore nulls) over (
           partition by game_id order by eventnum
           rows between unbounded preceding and current row), '0') as filled
  from events_v
)"""

COUNTED = """(coalesce(regexp_matches(homedescription, 'MISS | PTS'), false)
          or coalesce(regexp_matches(visitordescription, 'MISS | PTS'), false))"""
KEPT_CODE = "(actioncode is null or actioncode not in (10, 11, 12))"
OWN_SIDE = "coalesce(contains(case when {0} = 'O' then homedescription else visitordescription end, 'user'), false)"

MARGINS = f"""
known as (
  select game_id, exact_time, arg_min(htm, eventnum) as htm
  from timed where value > 50 group by all
), margins as (
  select concat('00', t.game_id) as "GAME_ID", t.exact_time, t.filled
  from timed t join known k using (exact_time)
  where {KEPT_CODE} and {COUNTED} and {OWN_SIDE.format('k.htm')}
)"""


def _bucket(*columns: str) -> str:
    key = ", ".join(["'42'", *[f"cast({c} as varchar)" for c in columns]])
    return f"cast(('0x' || substr(md5(concat_ws('|', {key})), 1, 8)) as bigint) % 1000"


def _attempts(body: str) -> str:
    return f"with {ATTEMPTS} {body}"


def _cells(body: str) -> str:
    return f"with {ATTEMPTS}, {CELLS} {body}"


def _rates(body: str) -> str:
    return f"with {ATTEMPTS}, {CELLS}, {RATES} {body}"


def _events(body: str) -> str:
    return f"with {EVENTS} {body}"


FLAGS = ", ".join(
    [f"case when dist_bin = {i} then 1 else 0 end as d{i}" for i in range(7)]
    + [f"case when period = {i} then 1 else 0 end as p{i}" for i in range(6)])

LABEL_FLAGS = ", ".join(
    [f"case when category = '{x}' then 1 else 0 end as category_{x}" for x in ("Gear", "Ring", "Cold", "Hot", "Else")]
    + [f"case when shot_zone_basic = 'Brand#{i}{j}' then 1 else 0 end as shot_zone_basic_Brand_{i}{j}"
       for i in range(1, 6) for j in range(1, 6)])

# The 16 model features of every supported cell, as f0..f15.
ASSEMBLED = f"""
centres as (
  select zone, avg(x_half) as x_center, avg(y_half) as y_center from cells group by zone
), featured as (
  select {CELL}, x_center / 47 as f0, (y_center - 25) / 25 as f1,
         {', '.join(f'cast(dist_bin = {i} as int) as f{i + 2}' for i in range(7))},
         margin_cat / 3 as f9,
         {', '.join(f'cast(period = {i} as int) as f{i + 10}' for i in range(6))}
  from united join centres using (zone) where shot_made_flag = 1
)"""
FEATURES = ", ".join(f"round(cast(f{i} as double), 9) as f{i}" for i in range(16))
SCALED_FEATURES = ", ".join(
    f"round(case when max(abs(f{i})) over () = 0 then 0.0"
    f" else f{i} / cast(max(abs(f{i})) over () as double) end, 9) as f{i}" for i in range(16))


def _features(body: str) -> str:
    return f"with {ATTEMPTS}, {CELLS}, {RATES}, {ASSEMBLED} {body}"


ORACLES: dict[str, str] = {
    # rate tables
    "success_rate": _rates(f"select {CELL}, shots, total, fg from united where shot_made_flag = 1"),
    "cell_outcome_counts": _rates("select * from outcomes"),
    "cell_totals": _rates("select * from cell_totals"),
    "outcome_counts_with_total": _rates(
        f"select * from outcomes join cell_totals using ({CELL})"),
    "rates_min_support": _rates("select * from cell_totals where total >= 2"),
    "rates_union": _rates("select * from united"),
    "rates_made_only": _rates("select * from united where shot_made_flag = 1"),
    "rates_sorted": _rates(f"select * from united order by {CELL}, shot_made_flag"),
    "top_cells": _rates(f"""select {CELL}, shots, total, fg from united where shot_made_flag = 1
        order by total desc, {CELL} limit 20"""),
    "named_zone_rates": _cells(f"""
        , marked as (select *, {_bucket('attempt_key')} < 700 as is_train from cells),
        counted as (
          select is_train, {CELL}, cast(sum(shot_made_flag) as bigint) as shots, count(*) as total
          from marked group by all having count(*) >= 2
        ), centres as (
          select zone, avg(x_half) as x_center, avg(y_half) as y_center from cells group by zone
        )
        select is_train, {CELL}, shots, total, {PCT2.format('shots', 'total')} as fg,
               round(x_center / 47, 9) as x_center_scaled,
               round((y_center - 25) / 25, 9) as y_center_scaled,
               round(margin_cat / 3, 9) as margin_scaled
        from counted join centres using (zone)"""),
    "rmse_of_baseline": _rates("""
        , made as (select fg from united where shot_made_flag = 1)
        select round(sqrt(avg((fg - m) * (fg - m))), 9) as rmse, count(*) as n
        from made, (select avg(fg) as m from made)"""),
    # zones
    "zone_centroids": _cells("""
        select zone, round(avg(x_half), 9) as x_center, round(avg(y_half), 9) as y_center
        from cells group by zone"""),
    "zone_centroid_join": _cells("""
        select attempt_key, zone, x_half, y_half, round(x_center, 9) as x_center,
               round(y_center, 9) as y_center
        from cells join (select zone, avg(x_half) as x_center, avg(y_half) as y_center
                         from cells group by zone) using (zone)"""),
    "fixed_scale": _cells("""
        select attempt_key, round(x_half / 47, 9) as x_center_scaled,
               round((y_half - 25) / 25, 9) as y_center_scaled,
               round(margin_cat / 3, 9) as margin_scaled from cells"""),
    "dense_row_index": _cells("""
        select zone, row_number() over (order by zone) - 1 as zone_index
        from (select distinct zone from cells)"""),
    # filters and scalar functions
    "filter_half_court": _attempts("""
        select attempt_key, loc_x, loc_y, shot_made_flag from attempts_v where loc_y < 47"""),
    "distinct_actions": _attempts("select distinct action_type from attempts_v"),
    "tie_to_zero": _attempts(
        f"select attempt_key, scoremargin, {MARGIN} as score_margin from attempts_v"),
    "margin_bucket": _attempts(f"select attempt_key, {BUCKET} as bucket from attempts_v"),
    "clamp_margin": _cells("select attempt_key, margin_cat from cells"),
    "clamp_period": _attempts("""
        select attempt_key, period as played, least(period, 5) as period from attempts_v"""),
    "distance_bins": _attempts(
        f"select attempt_key, defender_distance, {BINS} as dist_bin from attempts_v"),
    "fold_court": _cells("select attempt_key, loc_x, loc_y, x_half, y_half from cells"),
    "categorize_first_match": _attempts(
        f"select attempt_key, action_type, {CATEGORY} as category from attempts_v"),
    "pct2": _attempts(f"""
        select loc_x, loc_y, {PCT2.format('sum(shot_made_flag)', 'count(*)')} as fg
        from attempts_v group by loc_x, loc_y"""),
    "percent_text": _rates(f"""
        select {CELL}, printf('%.1f%%', fg * 100) as percent
        from united where shot_made_flag = 1"""),
    "concat_zone": _cells("""
        select attempt_key, shot_zone_basic, shot_zone_area, zone from cells"""),
    "team_flags": _attempts("""
        select attempt_key, cast(htm = 'O' as int) as h, cast(vtm = 'O' as int) as v
        from attempts_v"""),
    "constant_column": _attempts("""
        select attempt_key, period, shot_made_flag, 'Regular' as season_type from attempts_v"""),
    "sql_function_surface": _attempts(f"""
        select attempt_key, {MARGIN} as score_margin, {BUCKET} as bucket,
               greatest(-3, least(3, {BUCKET})) as margin_cat, least(period, 5) as period,
               {BINS} as dist_bin,
               case when loc_x > 47 then 94 - loc_x else loc_x end as x_half,
               case when loc_x > 47 then 50 - loc_y else loc_y end as y_half,
               {NEEDLES} as category,
               {PCT2.format('loc_x', '(loc_x + loc_y + 1)')} as share,
               concat(shot_zone_basic, ' ', shot_zone_area) as zone
        from attempts_v"""),
    # encoding
    "frequency_index": _attempts("""
        select shot_zone_basic, n,
               row_number() over (order by n desc, shot_zone_basic) - 1 as label_index
        from (select shot_zone_basic, count(*) as n from attempts_v group by 1)"""),
    "string_index_columns": _cells(f"""
        , labelled as (select attempt_key, zone, {CATEGORY} as category from cells),
        categories as (
          select category, row_number() over (order by count(*) desc, category) - 1 as i
          from labelled group by category
        ), zones as (
          select zone, row_number() over (order by count(*) desc, zone) - 1 as i
          from labelled group by zone
        )
        select attempt_key, c.i as category, z.i as zone
        from labelled l join categories c on l.category = c.category
                        join zones z on l.zone = z.zone"""),
    "string_index_stage": _cells(f"""
        , labelled as (select attempt_key, {CATEGORY} as category from cells),
        categories as (
          select category, cast(row_number() over (order by count(*) desc, category) - 1 as int)
                 as category_index
          from labelled group by category
        )
        select attempt_key, category, category_index from labelled join categories using (category)"""),
    "one_hot": _rates(f"select {CELL}, {FLAGS} from cell_totals"),
    "one_hot_flags": _cells(f"select attempt_key, {FLAGS} from cells"),
    "assemble_features": _features(f"select {CELL}, {FEATURES} from featured"),
    # every feature of at most four values is 0/1 here, so indexing keeps the values
    "vector_index": _features(f"select {CELL}, {FEATURES} from featured"),
    "vector_index_values": _attempts("""
        , v as (select attempt_key, loc_x % 3 * 10 - 5 as three, loc_y % 4 * 7 + 2 as four, loc_x as many
                from attempts_v)
        select *, cast(dense_rank() over (order by three) - 1 as int) as three_index,
               cast(dense_rank() over (order by four) - 1 as int) as four_index, many as many_index from v"""),
    "one_hot_labels": _cells(f"""
        , labelled as (select attempt_key, shot_zone_basic, {CATEGORY} as category from cells)
        select attempt_key, {LABEL_FLAGS} from labelled"""),
    "max_abs_scale_vector": _features(f"select {CELL}, {SCALED_FEATURES} from featured"),
    "vector_element": _features(
        f"select {CELL}, round(f0, 2) as x, round(f1, 2) as y from featured"),
    "vector_from_array": _cells("""
        select zone, round(avg(x_half), 9) as x_center, round(avg(y_half), 9) as y_center
        from cells group by zone"""),
    "rate_table_roundtrip": _features(f"select {CELL}, {FEATURES} from featured"),
    "max_abs_scale": _attempts(f"""
        , numbers as (select attempt_key, loc_x, {MARGIN} as score_margin from attempts_v),
        largest as (select max(abs(loc_x)) as mx, max(abs(score_margin)) as mm from numbers)
        select attempt_key, round(loc_x / mx, 9) as loc_x_scaled,
               round(score_margin / mm, 9) as score_margin_scaled from numbers, largest"""),
    # splits
    "split_attempts": _attempts(f"""
        select attempt_key, shot_made_flag, {_bucket('attempt_key')} < 700 as is_train
        from attempts_v"""),
    "split_cells": _rates(f"""
        select {CELL}, shots, total, fg, {_bucket('zone', 'dist_bin', 'margin_cat', 'period')} < 700
               as is_train
        from united where shot_made_flag = 1"""),
    # event logs
    "forward_fill": _events("select game_id, eventnum, filled as scoremargin from timed"),
    "forward_fill_large_groups": _events("""
        select 1 as season, eventnum, coalesce(last_value(scoremargin ignore nulls) over (
                 order by eventnum rows between unbounded preceding and current row), '0') as scoremargin
        from events_v"""),
    "time_key": _events("""
        select eventnum, exact_time as attempt_time, concat_ws(':', '00' || game_id, period,
               minutes_remaining || ':' || lpad(cast(seconds_remaining as varchar), 2, '0'))
               as log_time from timed"""),
    "url_per_key": _events("""
        select distinct game_id, 'http://stats.example/plays?game=00' || game_id || '&start=0&end=0'
               as url from events_v"""),
    "events_for_subject": _events(f"""
        select eventnum, htm, homedescription, visitordescription from events_v
        where {OWN_SIDE.format('htm')}"""),
    "exclude_codes": _events(f"select eventnum, actioncode from events_v where {KEPT_CODE}"),
    "regex_either_side": _events(f"""
        select eventnum, homedescription, visitordescription from events_v where {COUNTED}"""),
    "first_attr_per_game": _events("""
        select game_id, arg_min(htm, eventnum) as htm,
               arg_min(minutes_remaining, eventnum) as minutes_remaining
        from events_v group by game_id"""),
    "semi_join_time": _events("""
        select eventnum, time from timed
        where time in (select time from timed where value > 50)"""),
    "left_join_margin": _events(f"""
        select a.eventnum, a.time, m.scoremargin
        from (select eventnum, time from timed where value > 50) a
        left join (select time, scoremargin from timed where {KEPT_CODE} and {COUNTED}) m
        on a.time = m.time"""),
    "reconcile_counts": _events(f"""
        select coalesce(a.game_id, m.game_id) as game_id, a.n as "from", m.n as "to"
        from (select game_id, count(*) as n from timed where value > 50 group by game_id) a
        full join (select game_id, count(*) as n from timed where {COUNTED} group by game_id) m
        on a.game_id = m.game_id where a.n is distinct from m.n"""),
    "match_margins": _events(f"""
        , {MARGINS}
        select a.eventnum as index, a.exact_time as "TIME", m.filled as "SCOREMARGIN"
        from (select eventnum, exact_time from timed where value > 50) a
        left join margins m on a.exact_time = m.exact_time"""),
    "reconcile_margins": _events(f"""
        , {MARGINS}
        select coalesce(a."GAME_ID", m."GAME_ID") as "GAME_ID", a.n as "from", m.n as "to"
        from (select concat('00', game_id) as "GAME_ID", count(*) as n
              from timed where value > 50 group by 1) a
        full join (select "GAME_ID", count(*) as n from margins group by 1) m
        on a."GAME_ID" = m."GAME_ID" where a.n is distinct from m.n"""),
    "incomplete_counts": _events("""
        select count(*) as row_count,
               count(*) filter (scoremargin is null or actioncode is null) as incomplete,
               count(*) filter (scoremargin is null) as missing_scoremargin,
               count(*) filter (actioncode is null) as missing_actioncode from events_v"""),
    # models: what must hold whatever the fitted trees and centres are
    "model_roundtrip": _cells(f"""
        , marked as (select *, {_bucket('attempt_key')} < 700 as is_train from cells),
        counted as (
          select {CELL}, cast(sum(shot_made_flag) as bigint) as shots, count(*) as total
          from marked where not is_train group by all having count(*) >= 2
        )
        select {CELL}, {PCT2.format('shots', 'total')} as fg, true as same_prediction
        from counted"""),
    "learned_zone_totals": _attempts(f"""
        select {BINS} as dist_bin, greatest(-3, least(3, {BUCKET})) as margin_cat, period,
               count(*) as total, cast(sum(shot_made_flag) as bigint) as shots
        from attempts_v where loc_y < 47 group by all"""),
    # files and text
    "scan_csv": _attempts("select * from attempts_v"),
    "csv_roundtrip": _events("""
        select game_id, eventnum, period, scoremargin, actioncode, homedescription,
               visitordescription, value from events_v"""),
    "scan_resultset_json": _events("""
        select concat('00', game_id) as "GAME_ID", eventnum as "EVENTNUM", period as "PERIOD",
               minutes_remaining || ':' || lpad(cast(seconds_remaining as varchar), 2, '0')
               as "PCTIMESTRING", scoremargin as "SCOREMARGIN",
               homedescription as "HOMEDESCRIPTION", visitordescription as "VISITORDESCRIPTION",
               actioncode as "EVENTMSGACTIONTYPE", 'Regular' as "SEASON_TYPE" from events_v"""),
    "scan_resultset_files": _events("""
        select concat('00', game_id) as "GAME_ID", eventnum as "EVENTNUM", period as "PERIOD",
               minutes_remaining || ':' || lpad(cast(seconds_remaining as varchar), 2, '0')
               as "PCTIMESTRING", scoremargin as "SCOREMARGIN",
               homedescription as "HOMEDESCRIPTION", visitordescription as "VISITORDESCRIPTION",
               actioncode as "EVENTMSGACTIONTYPE", 'Regular' as "SEASON_TYPE" from events_v"""),
    "text_contains_counts": r"""
        with lines as (
          select 'documents' as source,
                 unnest(regexp_split_to_array(text, '\r\n|\r|\n')) as value from documents
          union all
          select 'pages', unnest(regexp_split_to_array(html, '\r\n|\r|\n')) from pages
        )
        select source, count(*) filter (contains(value, 'a')) as lines_with_a,
               count(*) filter (contains(value, 'b')) as lines_with_b from lines group by source""",
    "scan_text": r"""
        with lines as (
          select unnest(regexp_split_to_array(text, '\r\n|\r|\n')) as value from documents
        )
        select count(*) filter (contains(value, 'a')) as lines_with_a,
               count(*) filter (contains(value, 'b')) as lines_with_b from lines""",
}
