"""DuckDB SQL of the queries, written independently of the plans: windows and joins where those group."""

from __future__ import annotations

import re

#: Relations by name, each over the driver's tables or relations above it.
CTES: dict[str, str] = {}


def _add(name: str, sql: str) -> None:
    CTES[name] = sql


_add("trips_", """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, cast(o_orderdate as date) service_date, cast(o_orderkey as varchar) trip_id,
  cast(cast(o_orderdate as date) as varchar) || '_' || cast(o_orderkey as varchar) trip_key, case when o_orderkey % 4 = 0 then 'north' else 'south' end source from orders""")
_add("seen_", """select t.source, t.service_date, t.trip_key, t.trip_id, cast(l_linenumber as bigint) stop_sequence, case when l_partkey % 11 <> 0 then 'S' || cast(l_suppkey as varchar) end stop_id,
  cast(t.service_date as timestamp) + to_seconds(o_orderkey % 24 * 3600 + l_linenumber * 600) plan, l_partkey, l_suppkey,
  case when l_suppkey % 50 = 0 then -83050 when l_partkey % 13 <> 0 then cast(l_quantity as bigint) * 30 - 300 end arr_delay_s,
  case when l_partkey % 17 <> 0 then cast(l_quantity as bigint) * 30 - 300 + l_suppkey % 7 * 30 - 60 end dep_delay_s,
  l_returnflag = 'R' and l_linestatus = 'F' stop_skipped, o_orderstatus = 'P' and o_orderkey % 5 = 0 trip_cancelled from lineitem join trips_ t on l_orderkey = o_orderkey""")
_add("snap_", """select *, plan + to_seconds((l_partkey % 41 - 20) * 60 + l_suppkey % 60) snapshot_ts from seen_""")
_add("reports_", """select *, snapshot_ts + to_seconds(19 + l_partkey % 7) fetched_at, plan + to_seconds(arr_delay_s) actual_arr, plan + to_seconds(120 + dep_delay_s) actual_dep,
  case when arr_delay_s is not null then plan end sched_arr, case when dep_delay_s is not null then plan + to_seconds(120) end sched_dep from snap_""")
_add("static_stops_", """select case k when 0 then date '2026-01-01' else date '2026-02-01' end static_version, 'S' || cast(s_suppkey as varchar) stop_id,
  case when k = 1 and s_suppkey % 5 = 0 then n_name || ' Central' else n_name end stop_name from supplier join nation on s_nationkey = n_nationkey, (values (0), (1)) v(k) where s_suppkey % 10 <> 3""")
_add("stop_names_", "select stop_id, max(stop_name) stop_name from static_stops_ group by 1")
_add("line_names_", "select cast(o_orderkey as varchar) trip_id, o_orderpriority line from orders where o_orderpriority <> '4-NOT SPECIFIED'")
_add("planned_", """with v as (select distinct o_orderkey, o_custkey, cast(date_trunc('month', d) as date) static_version from
   (select o_orderkey, o_custkey, unnest([cast(o_orderdate as date) - 40, cast(o_orderdate as date) + cast(o_custkey % 60 - 30 as integer)]) d from orders))
  select static_version, feed, cast(o_orderkey as varchar) trip_id, n::bigint stop_sequence, 'S' || cast((o_orderkey + n) % 100 + 1 as varchar) stop_id,
   case when n > 1 then o_orderkey % 24 * 3600 + n * 600 end arrival_s, o_orderkey % 24 * 3600 + n * 600 + 120 departure_s
  from v, (values ('rv'), ('fv')) f(feed), range(1, 8) r(n) where (feed = 'rv' or o_custkey % 9 = 0) and n <= 3 + o_orderkey % 4""")
_add("messages_", """select source, service_date, trip_key, trip_id, o_orderstatus <> 'O' trip_cancelled, cast(service_date as timestamp) + to_seconds(43200 + o_custkey % 60) snapshot_ts from trips_""")
_OK = "{0} between -3600 and 86400"
_LATEST = "qualify row_number() over (partition by source, trip_key, stop_sequence order by snapshot_ts desc, fetched_at desc, {0}) = 1"
_add("halts_", """select source, service_date, trip_key, trip_id, stop_sequence, arg_max(stop_id, (snapshot_ts, fetched_at, stop_id)) filter (where stop_id is not null) stop_id, max(snapshot_ts) last_ts,
  max(sched_arr) filter (where arr_delay_s between -3600 and 86400) sched_arr, max(sched_dep) filter (where dep_delay_s between -3600 and 86400) sched_dep from reports_ group by 1, 2, 3, 4, 5""")
_add("state_", f"select source, trip_key, stop_sequence, stop_skipped, trip_cancelled from reports_ {_LATEST.format('stop_skipped desc, trip_cancelled desc')}")
for _k in ("arr", "dep"):
    _add(f"{_k}_", f"select source, trip_key, stop_sequence, actual_{_k}, {_k}_delay_s from reports_ where sched_{_k} is not null and {_OK.format(f'{_k}_delay_s')} and snapshot_ts <= sched_{_k} + interval 5 minute {_LATEST.format(f'{_k}_delay_s desc, actual_{_k} desc')}")
_add("observed_", """select h.source, h.service_date, h.trip_key, h.trip_id, h.stop_sequence, h.stop_id, n.stop_name, h.sched_arr, h.sched_dep, a.actual_arr, d.actual_dep, a.arr_delay_s, d.dep_delay_s,
  coalesce(last_ts >= coalesce(h.sched_dep, h.sched_arr) + interval 5 minute, false) is_final, s.stop_skipped, s.trip_cancelled, l.line
  from halts_ h join state_ s using (source, trip_key, stop_sequence) left join arr_ a using (source, trip_key, stop_sequence) left join dep_ d using (source, trip_key, stop_sequence)
  left join stop_names_ n on n.stop_id = h.stop_id left join line_names_ l on l.trip_id = h.trip_id""")
_add("last_message_", "select source, service_date, trip_key, trip_id, max(snapshot_ts) last_ts from messages_ where trip_cancelled group by 1, 2, 3, 4")
_add("unseen_", "select * from last_message_ m where not exists (select 1 from reports_ r where r.trip_key = m.trip_key)")


def _valid(candidates: str) -> str:
    return f"""select x.trip_key, x.static_version, min(p.feed) feed from (select k.trip_key, k.trip_id, max(p.static_version) static_version from {candidates} k join planned_ p on p.trip_id = k.trip_id and p.static_version <= k.service_date group by 1, 2) x
  join planned_ p on p.trip_id = x.trip_id and p.static_version = x.static_version group by 1, 2 having count(distinct p.feed) = 1"""


_add("unseen_version_", _valid("unseen_"))
_add("resolved_", """select u.source, u.service_date, u.trip_key, u.trip_id, p.stop_sequence, p.stop_id, n.stop_name, cast(u.service_date as timestamp) + to_seconds(p.arrival_s) sched_arr, cast(u.service_date as timestamp) + to_seconds(p.departure_s) sched_dep,
  null::timestamp actual_arr, null::timestamp actual_dep, null::bigint arr_delay_s, null::bigint dep_delay_s,
  coalesce(u.last_ts >= cast(u.service_date as timestamp) + to_seconds(coalesce(p.departure_s, p.arrival_s)) + interval 5 minute, false) is_final, false stop_skipped, true trip_cancelled, l.line
  from unseen_ u join unseen_version_ v using (trip_key) join planned_ p on p.trip_id = u.trip_id and p.static_version = v.static_version and p.feed = v.feed left join stop_names_ n on n.stop_id = p.stop_id left join line_names_ l on l.trip_id = u.trip_id""")
_add("events_", "select * from observed_ union all by name select * from resolved_")
_add("valued_", "select * replace (case when not (trip_cancelled or stop_skipped) then arr_delay_s end as arr_delay_s, case when not (trip_cancelled or stop_skipped) then dep_delay_s end as dep_delay_s) from events_")
_add("deltas_", """select *, lag(stop_id) over w from_id, lag(stop_name) over w from_name, lag(stop_sequence) over w = stop_sequence - 1 is_direct, arr_delay_s - lag(dep_delay_s) over w run_delta_s, dep_delay_s - arr_delay_s dwell_delta_s
  from valued_ window w as (partition by source, trip_key order by stop_sequence)""")
_DST = "coalesce(month({0}) in (3, 10) and dayofweek({0}) = 0 and month(cast({0} as date) + 7) <> month({0}) and hour({0}) = 2, false)"
_add("flagged_", f"select *, {_DST.format('sched_arr')} or {_DST.format('sched_dep')} dst_ambiguous from deltas_")
_add("after_", "select *, coalesce(lag(dst_ambiguous) over (partition by source, trip_key order by stop_sequence), false) before_ from flagged_")
_add("runs_", """select source, service_date, trip_key, trip_id, line, stop_sequence stop_no, stop_id, stop_name, from_id, from_name, sched_arr, sched_dep, case when not dst_ambiguous then arr_delay_s end arr_delay_s, case when not dst_ambiguous then dep_delay_s end dep_delay_s,
  case when not dst_ambiguous and not before_ then run_delta_s end run_delta_s, case when not dst_ambiguous then dwell_delta_s end dwell_delta_s, is_direct, is_final, stop_skipped, trip_cancelled, dst_ambiguous from after_""")
_MEASURES = """count(distinct trip_key) trips, sum(run_delta_s)::bigint run_delta_sum, count(run_delta_s) run_measured, sum(dwell_delta_s)::bigint dwell_delta_sum, count(dwell_delta_s) dwell_measured,
  count(*) filter (where trip_cancelled) cancelled_stops, count(*) filter (where stop_skipped) skipped_stops, count(*) filter (where dst_ambiguous) dst_stops,
  sum(run_delta_s)::double / nullif(count(run_delta_s), 0) run_delta_per_train, sum(dwell_delta_s)::double / nullif(count(dwell_delta_s), 0) dwell_delta_per_train"""
_add("origin_", f"select service_date, source, from_id, from_name, stop_id to_id, stop_name to_name, {_MEASURES} from runs_ where is_direct group by 1, 2, 3, 4, 5, 6")
_add("labelled_", "select *, coalesce(from_name, from_id) from_label, coalesce(stop_name, stop_id) to_label, from_name is not null and stop_name is not null named from runs_ where is_direct")
_add("bottlenecks_", f"""select *, least(from_label, to_label) || ' <-> ' || greatest(from_label, to_label) pair, from_label < to_label forward from
  (select service_date, source, from_label, to_label, hour(sched_arr)::bigint "hour", bool_and(named) labels_complete, {_MEASURES} from labelled_ group by 1, 2, 3, 4, 5)""")
_add("buffer_", """with e as (select *, arr_delay_s - run_delta_s > 60 late from labelled_ where run_delta_s is not null and arr_delay_s is not null)
  select service_date, source, line, from_label, to_label, bool_and(named) labels_complete, count(distinct trip_key) trips, count(*) evaluable, count(*) filter (where run_delta_s < 0) gained, count(*) filter (where run_delta_s > 0) lost, count(*) filter (where run_delta_s = 0) unchanged,
  count(*) filter (where late) entered_late, count(*) filter (where not late) entered_on_time, count(*) filter (where late and run_delta_s < 0) reserve_used, coalesce(sum(-run_delta_s) filter (where late and run_delta_s < 0), 0)::bigint reserve_used_s,
  count(*) filter (where not late and run_delta_s < 0) reserve_unused, coalesce(sum(-run_delta_s) filter (where not late and run_delta_s < 0), 0)::bigint reserve_unused_s, coalesce(sum(run_delta_s) filter (where run_delta_s > 0), 0)::bigint loss_s, sum(run_delta_s)::bigint net_s from e group by 1, 2, 3, 4, 5""")
_add("placed_", "select *, min(stop_no) over w first_no, min(case when not stop_skipped then stop_no end) over w fs, max(case when not stop_skipped then stop_no end) over w ls from runs_ window w as (partition by source, trip_key)")
_add("states_", """select *, stop_no > first_no has_arrival, case when trip_cancelled then 'cancelled' when fs is null then 'unserved_run' when stop_skipped and (stop_no < fs or stop_no > ls) then 'truncated'
  when stop_skipped then 'skipped' when dst_ambiguous then 'ambiguous' when arr_delay_s is null then 'no_report' else 'measured' end state from placed_""")
_add("candidates_", "select service_date, trip_key, trip_id, count(*) observed_stops from observed_ group by 1, 2, 3 having bool_and(stop_skipped) and not bool_or(trip_cancelled)")
_add("candidate_version_", _valid("candidates_"))
_add("coverage_", """select k.service_date, k.trip_key, v.static_version, v.feed, k.observed_stops, count(p.stop_sequence) planned_stops, count(o.stop_sequence) planned_observed, count(p.stop_sequence) > 0 checkable, case when count(p.stop_sequence) > 0 then count(o.stop_sequence) = count(p.stop_sequence) end complete
  from candidates_ k left join candidate_version_ v using (trip_key) left join planned_ p on p.trip_id = k.trip_id and p.static_version = v.static_version and p.feed = v.feed left join (select distinct trip_key, stop_sequence from observed_) o on o.trip_key = k.trip_key and o.stop_sequence = p.stop_sequence group by 1, 2, 3, 4, 5""")
_STATES = ("cancelled", "unserved_run", "truncated", "skipped", "ambiguous", "no_report", "measured")
_add("counted_", f"""select service_date, source, line, threshold_s::bigint threshold_s, count(*) filter (where has_arrival) stops_planned, {', '.join(f"count(*) filter (where has_arrival and state = '{s}') stops_{s}" for s in _STATES)},
  count(*) filter (where has_arrival and state = 'measured' and arr_delay_s < threshold_s) stops_punctual from states_ cross join (select unnest([60, 180, 360, 900, 3600]) threshold_s) group by 1, 2, 3, 4""")
_add("trip_states_", """select s.service_date, s.source, s.line, s.trip_key, bool_or(trip_cancelled) c, bool_or(state = 'unserved_run') u, bool_or(state = 'truncated') t, coalesce(bool_or(checkable), false) k, coalesce(bool_or(complete), false) f
  from states_ s left join coverage_ v on v.service_date = s.service_date and v.trip_key = s.trip_key group by 1, 2, 3, 4""")
_add("trip_counts_", """select service_date, source, line, count(*) trips, count(*) filter (where c) trips_cancelled, count(*) filter (where u) trips_unserved, count(*) filter (where u and f) trips_unserved_confirmed, count(*) filter (where u and not k) trips_unserved_uncheckable, count(*) filter (where t) trips_truncated from trip_states_ group by 1, 2, 3""")
_add("punctuality_", f"""select g.service_date, g.source, g.line, trips, trips_cancelled, trips_unserved, trips_unserved_confirmed, trips_unserved_uncheckable, trips_truncated, stops_planned, {', '.join(f'stops_{s}' for s in _STATES)}, threshold_s, stops_punctual,
  case when stops_measured > 0 then stops_punctual::double / stops_measured end quota_measured, case when stops_planned > 0 then stops_punctual::double / stops_planned end quota_planned
  from counted_ g join trip_counts_ f on f.service_date = g.service_date and f.source = g.source and f.line is not distinct from g.line""")
_add("quality_", """select *, measured_arr / nullif(planned_arr, 0)::double coverage_arr, measured_dep / nullif(planned_dep, 0)::double coverage_dep, named_stops / nullif(stops, 0)::double name_share from
  (select service_date, source, count(distinct trip_key) trips, count(*) stops, count(sched_arr) planned_arr, count(sched_dep) planned_dep, count(arr_delay_s) measured_arr, count(dep_delay_s) measured_dep, count(*) filter (where trip_cancelled) cancelled_stops, count(*) filter (where stop_skipped) skipped_stops, count(*) filter (where dst_ambiguous) dst_stops,
  count(*) filter (where sched_arr is not null and arr_delay_s is null and not (trip_cancelled or stop_skipped or dst_ambiguous)) unexplained_arr, count(*) filter (where sched_dep is not null and dep_delay_s is null and not (trip_cancelled or stop_skipped or dst_ambiguous)) unexplained_dep,
  count(*) filter (where stop_no > 1 and not is_direct) gap_sections, count(stop_name) named_stops, count(*) filter (where not is_final) not_final from runs_ group by 1, 2)""")
_add("fetches_", "select event_id, user_id, date_trunc('day', ts)::timestamp + to_seconds(date_diff('second', date_trunc('day', ts)::timestamp, date_trunc('second', ts)::timestamp) // 2) fetched_at from events")
_add("poll_rows_", "select case when user_id % 2 = 0 then 'north' else 'south' end source, fetched_at, fetched_at - to_seconds(event_id % 40) snapshot_ts from fetches_")
_add("polls_", """select *, date_diff('second', lag(fetched_at) over (partition by source order by fetched_at), fetched_at) gap_s, date_diff('second', snapshot_ts, fetched_at) feed_age_s from (select source, fetched_at, max(snapshot_ts) snapshot_ts from poll_rows_ group by 1, 2)""")
_add("hours_", "select source, max(fetched_at) last, unnest(generate_series(date_trunc('hour', min(fetched_at)), date_trunc('hour', max(fetched_at)), interval 1 hour)) hour_begin from polls_ group by 1")
_add("hourly_", "select source, date_trunc('hour', fetched_at) hour_begin, count(*) polls, max(gap_s) largest_gap_s, sum(feed_age_s)::double / nullif(count(feed_age_s), 0) feed_age_mean_s, max(feed_age_s) feed_age_max_s, min(fetched_at) first_poll, max(fetched_at) last_poll from polls_ group by 1, 2")
_add("collection_", """select cast(hour_begin as date) calendar_day, hour(hour_begin)::bigint "hour", source, coalesce(polls, 0) polls_seen, 120::bigint polls_expected, coalesce(polls, 0) / 120::double coverage, largest_gap_s, feed_age_mean_s, feed_age_max_s, first_poll, last_poll, hour_begin + interval 1 hour <= last hour_complete
  from hours_ left join hourly_ using (source, hour_begin)""")


def _recent(rel: str, day: str, n: int) -> str:
    return f"select * from {rel} where (source, {day}) in (select (source, {day}) from (select source, {day}, dense_rank() over (partition by source order by {day} desc) k from (select distinct source, {day} from {rel})) where k <= {n})"


def _busiest(rel: str) -> str:
    return f"select r.* from {rel} r join (select source, from_label, to_label from {rel} group by 1, 2, 3 qualify row_number() over (partition by source order by sum(trips) desc, from_label nulls first, to_label nulls first) <= 200) b on b.source = r.source and b.from_label = r.from_label and b.to_label = r.to_label"


_add("ext_1_", _recent("bottlenecks_", "service_date", 365))
_add("ext_1_sum_", """select source, from_label, to_label, pair, forward, "hour", bool_and(labels_complete) labels_complete, sum(trips)::bigint trips, sum(run_delta_sum)::bigint run_sum, sum(run_measured)::bigint run_measured, sum(dwell_delta_sum)::bigint dwell_sum, sum(dwell_measured)::bigint dwell_measured, sum(cancelled_stops)::bigint cancelled_stops, sum(skipped_stops)::bigint skipped_stops from ext_1_ group by 1, 2, 3, 4, 5, 6""")
_add("ext_sections_", _busiest("ext_1_sum_"))
_add("ext_collection_", f"select calendar_day, \"hour\", source, polls_seen, polls_expected, coverage, largest_gap_s, feed_age_mean_s, feed_age_max_s, hour_complete from ({_recent('collection_', 'calendar_day', 365)})")
_add("ext_punctuality_", f"select * replace (coalesce(line, 'no line number') as line), line is not null line_known, threshold_s / 60.0::double threshold_min from ({_recent('punctuality_', 'service_date', 365)})")
_SUMS = ("trips", "evaluable", "gained", "lost", "unchanged", "entered_late", "entered_on_time", "reserve_used", "reserve_used_s", "reserve_unused", "reserve_unused_s", "loss_s", "net_s")
_add("ext_4_", f"select * replace (coalesce(line, 'no line number') as line) from ({_recent('buffer_', 'service_date', 365)})")
_add("ext_lines_", f"select source, line, count(distinct from_label || ' -> ' || to_label) sections, {', '.join(f'sum({c})::bigint {c}' for c in _SUMS if c not in ('gained', 'unchanged'))} from ext_4_ group by 1, 2")
_add("ext_5_", f"select source, line, from_label, to_label, bool_and(labels_complete) labels_complete, {', '.join(f'sum({c})::bigint {c}' for c in _SUMS)} from ext_4_ group by 1, 2, 3, 4")
_add("ext_buffer_", _busiest("ext_5_"))
_add("ext_6_", _recent("runs_", "service_date", 3))
_add("chosen_", """select source, service_date, trip_key, coalesce(line, 'no line number') line, min(sched_dep) departs from ext_6_ group by 1, 2, 3, 4 having count(*) >= 2
  qualify row_number() over (partition by source, service_date, coalesce(line, 'no line number') order by min(sched_dep) nulls last, trip_key) <= 6""")
_add("ext_runs_", """select r.service_date, r.source, r.trip_key, c.line, c.departs, stop_no, coalesce(stop_name, stop_id) stop, stop_name is not null name_known, sched_arr is not null and sched_dep is not null has_dwell, arr_delay_s, dep_delay_s, run_delta_s, dwell_delta_s, stop_skipped, trip_cancelled, dst_ambiguous
  from runs_ r join chosen_ c on c.source = r.source and c.trip_key = r.trip_key""")
_NAME = "case source when 'north' then 'Northern network' when 'south' then 'Southern network' else source end"
_add("totals_", """select from_label || ' -> ' || to_label section, from_label, to_label, pair, forward, bool_and(labels_complete) labels_complete, sum(trips)::bigint trips, sum(run_sum)::double / nullif(sum(run_measured), 0) run_per_train, sum(dwell_sum)::double / nullif(sum(dwell_measured), 0) dwell_per_train,
  sum(run_measured)::bigint run_measured, sum(cancelled_stops)::bigint cancelled_stops, sum(skipped_stops)::bigint skipped_stops from ext_sections_ where source = 'south' group by all""")
_add("ranking_", "select section, trips, round(run_per_train / 60.0, 2) run_min, round(dwell_per_train / 60.0, 2) dwell_min, run_measured, labels_complete, cancelled_stops, skipped_stops from totals_ where run_per_train is not null and trips >= 5 order by run_per_train desc, section limit 10")
_add("heatmap_", """select from_label || ' -> ' || to_label section, "hour", sum(run_sum)::double / sum(run_measured) / 60.0 run_min, sum(trips)::bigint trips from ext_sections_ where source = 'south' and "hour" is not null group by from_label, to_label, "hour" having sum(run_measured) > 0""")
_add("directions_", """select pair, max(case when forward then run_per_train end) / 60.0 forward_min, max(case when not forward then run_per_train end) / 60.0 back_min, min(trips) trips_weaker from totals_ group by pair
  having count(*) = 2 and max(case when forward then run_per_train end) is not null and max(case when not forward then run_per_train end) is not null""")
_add("shares_", """select from_label || ' -> ' || to_label section, line, evaluable, lost, gained, entered_late, entered_on_time, reserve_used, reserve_unused, round(loss_s / 60.0::double, 1) loss_min, round(reserve_used_s / 60.0::double, 1) used_min, round(reserve_unused_s / 60.0::double, 1) unused_min, labels_complete,
  100.0::double * lost / nullif(evaluable, 0) lost_share, 100.0::double * reserve_used / nullif(entered_late, 0) used_share, 100.0::double * reserve_unused / nullif(entered_on_time, 0) unused_share from ext_buffer_ where source = 'south' and evaluable >= 1""")
_add("named_", "select *, min(stop_no) over (partition by source, trip_key) first, count(*) over (partition by source, trip_key, stop) times, row_number() over (partition by source, trip_key, stop order by stop_no) nth from ext_runs_")
_add("marked_", "select *, case when times > 1 then stop || ' (' || nth || ')' else stop end name from named_")
_add("parts_", """select source, trip_key, stop_no * 10 position, 'start ' || name step, 'start' kind, coalesce(arr_delay_s, dep_delay_s) part_s, coalesce(arr_delay_s, dep_delay_s) level_s, trip_cancelled, stop_skipped, dst_ambiguous from marked_ where stop_no = first
  union all select source, trip_key, stop_no * 10 + 1, '-> ' || name, 'on the way', run_delta_s, arr_delay_s, trip_cancelled, stop_skipped, dst_ambiguous from marked_ where stop_no > first
  union all select source, trip_key, stop_no * 10 + 2, 'stop ' || name, 'in station', dwell_delta_s, dep_delay_s, trip_cancelled, stop_skipped, dst_ambiguous from marked_ where has_dwell""")
_add("steps_", """select source, trip_key, position, step, kind, part_s / 60.0::double part_min, level_s / 60.0::double level_min, case when trip_cancelled then 'trip cancelled' when stop_skipped then 'stop skipped' when dst_ambiguous then 'clock change' when part_s is null then 'no report' end reason from parts_""")
_Q = "100.0::double * sum(stops_punctual) / nullif(sum(stops_measured), 0) quota_measured, 100.0::double * sum(stops_punctual) / nullif(sum(stops_planned), 0) quota_planned"
_add("curve_", f"select threshold_min, sum(stops_punctual)::bigint punctual, sum(stops_measured)::bigint measured, sum(stops_planned)::bigint planned, {_Q} from ext_punctuality_ where source = 'south' group by 1")

_add("swiss_raw_", """select t.service_date, '85:11:' || t.trip_id trip_id, case when t.o_custkey % 3 <> 0 then cast(t.o_custkey as varchar) end block_id, t.o_orderstatus = 'P' trip_cancelled, cast(l_suppkey as varchar) || '-' || cast(l_partkey as varchar) stop_id, 'Halt ' || l_suppkey stop_name, 'IC' || (t.o_custkey % 90) line,
  cast(t.service_date as timestamp) + to_seconds(t.o_orderkey % 26 * 3600 + l_linenumber * 600) plan, to_seconds(cast(l_quantity as bigint) * 7 - 60) late, l_partkey, l_suppkey from lineitem join trips_ t on l_orderkey = t.o_orderkey where t.o_orderkey % 6 <> 0""")
_add("swiss_timed_", """select *, case when l_partkey % 5 <> 0 then plan end sched_arr, case when l_partkey % 7 <> 0 then plan + interval 2 minute end sched_dep, l_suppkey % 4 = 0 real_arr, l_partkey % 4 = 0 real_dep,
  case when l_partkey % 5 <> 0 and l_suppkey % 4 = 0 then plan + late end actual_arr, case when l_partkey % 7 <> 0 and l_partkey % 4 = 0 then plan + late + interval 1 minute end actual_dep from swiss_raw_""")
_add("swiss_", """select 'swiss' source, service_date, cast(service_date as varchar) || '_' || trip_id trip_key, trip_id, row_number() over (partition by service_date, trip_id order by coalesce(sched_arr, sched_dep) nulls last, sched_dep nulls last, stop_id, actual_arr nulls last, actual_dep nulls last) stop_sequence, stop_id, stop_name, sched_arr, sched_dep, actual_arr, actual_dep,
  date_diff('second', sched_arr, actual_arr) arr_delay_s, date_diff('second', sched_dep, actual_dep) dep_delay_s, (sched_arr is null or real_arr) and (sched_dep is null or real_dep) is_final, false stop_skipped, trip_cancelled, line, block_id from swiss_timed_""")
_add("raw_", """select cast(o_orderkey as varchar) trip_id, cast(o_orderdate as date) service_date, case when l_partkey % 19 <> 0 and l_partkey % 23 <> 0 then l_linenumber::bigint end stop_sequence, case when l_suppkey % 9 <> 0 then 'S' || l_suppkey end stop_id, s, d, l_partkey, l_returnflag = 'R' skipped, o_orderstatus = 'P' and l_partkey % 19 = 0 cancelled, l_partkey % 19 = 0 alone,
  s + l_partkey % 3600 snapshot, case when l_partkey % 29 <> 0 then s + l_partkey % 3600 + 19 end fetched from (select *, epoch(cast(o_orderdate as date))::bigint + o_orderkey % 24 * 3600 + l_linenumber * 600 s, cast(l_quantity as bigint) * 30 - 300 d from lineitem join orders on l_orderkey = o_orderkey)""")
_add("sent_", """select *, epoch(cast(o_orderdate as date))::bigint + 86400 day_end, epoch(cast(o_orderdate as date))::bigint + o_orderkey % 24 * 3600 + l_linenumber * 600 s, cast(l_quantity as bigint) * 30 - 300 d from lineitem join orders on l_orderkey = o_orderkey""")
_BERLIN = "timezone('Europe/Berlin', to_timestamp({0}))"


def _berlin(condition: str, moment: str) -> str:
    return f"case when {condition} then {_BERLIN.format(moment)} end"


#: Rows that violate a check.
VIOLATIONS: dict[str, tuple[str, str]] = {
    "scheduled_time_missing": ("error", "select 1 from observed_ where sched_arr is null and sched_dep is null"),
    "arrivals_add_up": ("error", "select 1 from (select service_date, source, count(arr_delay_s) m, count(*) filter (where arr_delay_s is null and (trip_cancelled or stop_skipped or dst_ambiguous)) r, count(*) n from runs_ where sched_arr is not null group by 1, 2) a full join quality_ q using (service_date, source) where n is distinct from planned_arr or m + r + unexplained_arr is distinct from n"),
    "cancellations_unresolved": ("warn", "select 1 from messages_ m where trip_cancelled and not exists (select 1 from events_ e where e.trip_key = m.trip_key)"),
    "resolved_without_actuals": ("error", "select 1 from resolved_ where coalesce(actual_arr, actual_dep) is not null or coalesce(arr_delay_s, dep_delay_s) is not null"),
    "no_run_provable": ("warn", "select service_date from coverage_ where service_date >= (select min(static_version) from planned_) group by 1 having count(*) filter (where complete) = 0"),
    "arrival_after_departure_reconstructed": ("warn", "select 1 from observed_ where sched_arr > sched_dep"),
    "outside_service_day_reconstructed": ("warn", "select 1 from (select service_date, unnest([sched_arr, sched_dep]) s from observed_) where date_diff('second', cast(service_date as timestamp), s) not between 0 and 108000"),
    "several_names": ("warn", "select stop_id from static_stops_ group by 1 having count(distinct stop_name) > 1"),
    "stop_repeated": ("error", "select 1 from observed_ group by source, trip_key, stop_sequence having count(*) > 1"),
    "marts_agree": ("error", "select 1 from (select service_date, source, sum(run_measured) n, sum(run_delta_sum) s from origin_ group by 1, 2) a full join (select service_date, source, sum(run_measured) k, sum(run_delta_sum) t from bottlenecks_ group by 1, 2) b using (service_date, source) where n is distinct from k or s is distinct from t"),
    "hours_complete": ("error", "select 1 from (select source, min(calendar_day + to_hours(\"hour\")) a, max(calendar_day + to_hours(\"hour\")) b, count(*) n from collection_ group by 1) where date_diff('hour', a, b) + 1 <> n"),
    "stops_contiguous": ("error", "select 1 from observed_ group by source, trip_key having min(stop_sequence) <> 1 or max(stop_sequence) <> count(*)"),
    "clock_change_stops": ("warn", f"select 1 from (select unnest([sched_arr, sched_dep]) s from events_) where s is not null and {_DST.format('s')}"),
    "clock_change_without_metrics": ("error", "select 1 from runs_ where dst_ambiguous and coalesce(arr_delay_s, dep_delay_s, run_delta_s, dwell_delta_s) is not null"),
    "curve_monotone": ("error", "select 1 from (select *, lag(stops_punctual) over (partition by service_date, source, line order by threshold_s) b, min(stops_planned) over w lo, max(stops_planned) over w hi from punctuality_ window w as (partition by service_date, source, line)) where b > stops_punctual or lo <> hi"),
    "states_complete": ("error", f"select 1 from punctuality_ where {' + '.join(f'stops_{s}' for s in _STATES)} <> stops_planned"),
    "buffer_within_origin": ("error", "select 1 from (select service_date, source, sum(evaluable) e from buffer_ group by 1, 2) full join (select service_date, source, sum(run_measured) m from origin_ group by 1, 2) using (service_date, source) where e > coalesce(m, 0)"),
    "buffer_partitions": ("error", "select 1 from buffer_ where gained + lost + unchanged <> evaluable or entered_late + entered_on_time <> evaluable"),
    "first_stop_alone_without_section": ("error", "select 1 from placed_ where (stop_no = first_no) <> (is_direct is null)"),
    "deltas_chain": ("error", "select 1 from runs_ a join runs_ b on b.source = a.source and b.trip_key = a.trip_key and b.stop_no = a.stop_no - 1 where a.run_delta_s is not null and not (a.is_direct and a.run_delta_s is not distinct from a.arr_delay_s - b.dep_delay_s)"),
    "arrival_after_departure": ("error", "select 1 from observed_ where sched_arr > sched_dep"),
    "outside_service_day": ("error", "select 1 from (select service_date, unnest([sched_arr, sched_dep]) s from observed_) where date_diff('second', cast(service_date as timestamp), s) not between 0 and 108000"),
    "origin_from_runs": ("error", "select 1 from (select service_date, source, sum(run_delta_s) s, count(run_delta_s) n, sum(dwell_delta_s) d, count(dwell_delta_s) k from runs_ where is_direct group by 1, 2) a full join (select service_date, source, sum(run_delta_sum) s2, sum(run_measured) n2, sum(dwell_delta_sum) d2, sum(dwell_measured) k2 from origin_ group by 1, 2) b using (service_date, source) where (s, n, d, k) is distinct from (s2, n2, d2, k2)"),
}

#: Final selects by query.
FINAL: dict[str, str] = {
    "prj_reconstructed_schedule": "select source, trip_key, stop_sequence, snapshot_ts, sched_arr, sched_dep, arr_delay_s, dep_delay_s from reports_",
    "prj_plausible_reports": "select trip_key, stop_sequence, snapshot_ts, coalesce(arr_delay_s between -3600 and 86400, false) arr_plausible, coalesce(dep_delay_s between -3600 and 86400, false) dep_plausible, coalesce(snapshot_ts <= sched_arr + interval 5 minute, false) arr_in_time from reports_",
    "prj_clock_change": f"select event_id, {_DST.format('ts')} ambiguous from (select event_id, (timestamp '2026-10-24 00:00:00' + to_seconds(event_id * 37 % 259200)) ts from events)",
    "prj_timetable_seconds": "select trip_id, static_version, feed, stop_sequence, arrival_s, departure_s from planned_",
    "prj_wall_clock": "select event_id, timezone('Europe/Berlin', to_timestamp(1774000000 + event_id * 7919)) local_time from events",
    "prj_path_origin": "select s_suppkey, cast(regexp_extract(p, 'v=(\\d{4}-\\d{2}-\\d{2})', 1) as date) static_version, split_part(p, '/', 4) feed from (select s_suppkey, '/x/v=2026-0' || (1 + s_suppkey % 9) || '-01/' || case when s_suppkey % 2 = 0 then 'rv' else 'fv' end || '/stops.txt' p from supplier)",
    "prj_scope_filter": "select source, trip_key, trip_id, stop_sequence, stop_id from reports_ r where trip_key in (select trip_key from reports_ group by 1 having bool_or(stop_id is not null and cast(substr(stop_id, 2) as bigint) % 7 = 0) or bool_and(stop_id is null))",
    "join_lines_of_trips": "select static_version, feed, cast(o_orderkey as varchar) trip_id, 'L' || (o_custkey % 50) line from orders join (values (date '2026-01-01', 'rv'), (date '2026-01-01', 'fv')) v(static_version, feed) on (o_orderkey % 3 = 0) = (feed = 'fv') where o_custkey % 50 <> 7",
    "join_valid_version": "select * from candidate_version_",
    "join_cancelled_stops": "select source, service_date, trip_key, stop_sequence, stop_id, stop_name, sched_arr, sched_dep, is_final, trip_cancelled, line from resolved_",
    "join_run_coverage": "select * from coverage_",
    "agg_name_variants": "select stop_id \"key\", 'stop' kind, max(stop_name) label, count(distinct stop_name) variants, min(static_version) first_seen, max(static_version) last_seen from static_stops_ group by 1",
    "win_derived_sequence": "select source, trip_key, stop_sequence raw_sequence, row_number() over (partition by source, trip_key order by coalesce(sched_arr, sched_dep) nulls last, sched_dep nulls last, stop_id nulls first) stop_sequence from (select source, trip_key, stop_sequence, stop_id, sched_arr, sched_dep from observed_ where coalesce(sched_arr, sched_dep) is not null)",
    "win_section_deltas": "select source, trip_key, stop_sequence, from_id prev_stop_id, is_direct, run_delta_s, dwell_delta_s from deltas_",
    "win_poll_gaps": "select * from polls_",
    "consolidated_stops": "select * exclude (stop_name, line) from observed_",
    "stop_events": "select * from events_",
    "stop_states": "select source, trip_key, stop_no, has_arrival, state from states_",
    "mart_run_detail": "select * from runs_",
    "mart_delay_origin": "select * from origin_",
    "mart_bottlenecks": "select * from bottlenecks_",
    "mart_buffer_balance": "select * from buffer_",
    "mart_punctuality": "select * from punctuality_",
    "mart_data_quality": "select * from quality_",
    "mart_collection": "select * from collection_",
    "ext_sections": "select * from ext_sections_",
    "ext_collection": "select * from ext_collection_",
    "ext_punctuality": "select * from ext_punctuality_",
    "ext_buffer_lines": "select * from ext_lines_",
    "ext_buffer_sections": "select * from ext_buffer_",
    "ext_run_sample": "select * from ext_runs_",
    "rep_data_state": f"select source, count(*) \"days\", sum(trips)::bigint trips, sum(stops)::bigint stops, min(service_date) first_day, max(service_date) last_day, {_NAME} label from quality_ group by 1",
    "rep_one_source": "select * from quality_ where source = 'north'",
    "rep_split_total": "select sum(run_delta_sum)::bigint / 60.0::double run_min, sum(dwell_delta_sum)::bigint / 60.0::double dwell_min, sum(cancelled_stops)::bigint cancelled_stops from origin_",
    "rep_top_sections": "select coalesce(from_name, from_id) || ' -> ' || coalesce(to_name, to_id) section, service_date, trips, run_measured, run_delta_per_train / 60.0 run_min, dwell_delta_per_train / 60.0 dwell_min from origin_ where run_measured > 0 order by run_delta_per_train desc, section nulls last, service_date, source, from_id nulls last, to_id nulls last limit 10",
    "rep_coverage": f"select service_date, {_NAME} label, stops, round(100 * coverage_arr, 1) measured_arr, round(100 * coverage_dep, 1) measured_dep, unexplained_arr + unexplained_dep no_report, round(100 * name_share, 1) named, cancelled_stops, skipped_stops from quality_",
    "rep_collection_days": f"select calendar_day, {_NAME} label, (sum(polls_seen) filter (where hour_complete))::bigint polls, count(*) filter (where hour_complete) \"hours\", 100.0::double * (sum(polls_seen) filter (where hour_complete))::bigint / nullif((sum(polls_expected) filter (where hour_complete))::bigint, 0) coverage, count(*) filter (where hour_complete and polls_seen = 0) hours_without_poll, max(largest_gap_s) largest_gap_s from ext_collection_ group by calendar_day, source",
    "rep_section_sources": f"select distinct source, {_NAME} label from ext_sections_",
    "rep_section_totals": "select * from totals_",
    "rep_section_ranking": "select * from ranking_",
    "rep_heatmap": "select * from heatmap_",
    "rep_heatmap_top": "select h.* from heatmap_ h join (select distinct section from ranking_) r on r.section = h.section",
    "rep_directions": "select * from directions_",
    "rep_asymmetry": "select pair, round(forward_min, 2) forward_min, round(back_min, 2) back_min, round(abs(forward_min - back_min), 2) difference_min, trips_weaker from directions_ where trips_weaker >= 5 order by abs(forward_min - back_min) desc, pair limit 10",
    "rep_buffer_sources": f"select distinct source, {_NAME} label from ext_buffer_",
    "rep_buffer_sections": "select * from shares_",
    "rep_too_tight": "select section, line, evaluable, lost, round(lost_share, 1) lost_share, loss_min, labels_complete from shares_ where lost_share is not null order by shares_.lost_share desc, loss_min desc, section, line limit 10",
    "rep_reserve_works": "select section, line, entered_late, reserve_used, round(used_share, 1) used_share, used_min from shares_ where used_share is not null and entered_late >= 1 order by shares_.used_share desc, used_min desc, section, line limit 10",
    "rep_reserve_idle": "select section, line, entered_on_time, reserve_unused, round(unused_share, 1) unused_share, unused_min from shares_ where unused_share is not null and entered_on_time >= 1 order by shares_.unused_share desc, unused_min desc, section, line limit 10",
    "rep_buffer_lines": "select line, trips, evaluable, 100.0::double * lost / nullif(evaluable, 0) disturbance, 100.0::double * reserve_used / nullif(entered_late, 0) recovery, entered_late, round(net_s / 60.0::double, 1) net_min from ext_lines_ where source = 'south' and evaluable >= 1 and entered_late > 0",
    "rep_run_sources": f"select source, max(service_date) \"day\", count(distinct trip_key) trips, {_NAME} label from ext_runs_ group by source",
    "rep_run_days": "select strftime(service_date, '%Y-%m-%d') \"day\", strftime(service_date, '%d.%m.%Y') label, count(distinct trip_key) trips from ext_runs_ where source = 'south' group by 1, 2",
    "rep_run_lines": "select line, count(distinct trip_key) trips from ext_runs_ where source = 'south' group by 1",
    "rep_run_trips": "with g as (select trip_key, min(stop_no) a, max(stop_no) b, count(*) stops, any_value(line) line, any_value(departs) departs from ext_runs_ where source = 'south' and line like '%-%' group by 1) select g.trip_key, g.line || ' | from ' || coalesce(strftime(g.departs, '%H:%M'), '--:--') || ' | ' || x.stop || ' -> ' || y.stop label, stops from g left join ext_runs_ x on x.trip_key = g.trip_key and x.stop_no = g.a left join ext_runs_ y on y.trip_key = g.trip_key and y.stop_no = g.b",
    "rep_waterfall": "select * from steps_",
    "rep_waterfall_parts": "select source, trip_key, step, position, kind, part_min from steps_ where part_min is not null",
    "rep_waterfall_levels": "select source, trip_key, step, position, level_min from steps_ where level_min is not null",
    "rep_punctuality_sources": f"select source, count(distinct service_date) \"days\", {_NAME} label from ext_punctuality_ group by source",
    "rep_curve": "select * from curve_",
    "rep_curve_long": "select threshold_min, 'stops served' reading, quota_measured quota from curve_ union all select threshold_min, 'all planned stops', quota_planned from curve_",
    "rep_state_totals": f"select {', '.join(f'sum({c})::bigint {c}' for c in ('stops_planned', *(f'stops_{s}' for s in _STATES), 'trips', 'trips_cancelled', 'trips_unserved', 'trips_unserved_confirmed', 'trips_truncated'))} from ext_punctuality_ where source = 'south' and threshold_s = 360",
    "rep_line_table": f"select line, sum(trips)::bigint trips, sum(trips_cancelled)::bigint trips_cancelled, sum(trips_unserved)::bigint trips_unserved, sum(trips_unserved_confirmed)::bigint trips_unserved_confirmed, sum(trips_unserved_uncheckable)::bigint trips_unserved_uncheckable, sum(trips_truncated)::bigint trips_truncated, sum(stops_planned)::bigint stops_planned, {_Q} from ext_punctuality_ where source = 'south' and threshold_s = 360 group by 1",
    "stream_change_detection": "select event_id, user_id, event_type from (select *, lag(event_type) over w t, event_id // 50 - lag(event_id // 50) over w gap, row_number() over w n from events window w as (partition by user_id order by event_id)) where n = 1 or t is distinct from event_type or gap > 40",
    "stg_swiss_events": "select * from swiss_",
    "stg_realtime_reports": f"""select 'realtime' source, service_date, cast(service_date as varchar) || '_' || trip_id trip_key, trip_id, stop_sequence, stop_id, {_BERLIN.format('snapshot')} snapshot_ts, {_berlin('fetched is not null', 'coalesce(fetched, 0)')} fetched_at,
  case when l_partkey % 13 <> 0 then d end arr_delay_s, case when l_partkey % 17 <> 0 then d + 30 end dep_delay_s, {_berlin('l_partkey % 11 <> 0', 's + d')} actual_arr, {_BERLIN.format('s + 120 + d')} actual_dep, skipped stop_skipped, cancelled trip_cancelled,
  {_berlin('l_partkey % 11 <> 0 and l_partkey % 13 <> 0', 's')} sched_arr, {_berlin('l_partkey % 17 <> 0', 's + 90')} sched_dep from raw_ where not alone and stop_sequence is not null""",
    "src_feed_round_trip": """select cast(o_orderkey as varchar) trip_id, strftime(cast(o_orderdate as date), '%Y%m%d') start_date, cast(o_custkey % 50 as varchar) route_id, 'SCHEDULED' trip_schedule_relationship, case when l_partkey % 23 <> 0 then l_linenumber::bigint end stop_sequence, case when l_suppkey % 9 = 0 then ' ' else 'S' || l_suppkey end stop_id,
  case when l_partkey % 13 <> 0 then d::integer end arrival_delay, case when l_partkey % 11 <> 0 then s + d end arrival_time, case when l_partkey % 17 <> 0 then (d + 30)::integer end departure_delay, s + 120 + d departure_time, case when l_returnflag = 'R' then 'SKIPPED' else 'SCHEDULED' end schedule_relationship, false is_trip_level_only, day_end snapshot_timestamp, day_end + 19 fetched_at
  from sent_ where l_partkey % 19 <> 0
  union all select distinct cast(o_orderkey as varchar), strftime(cast(o_orderdate as date), '%Y%m%d'), cast(o_custkey % 50 as varchar), case when o_orderstatus = 'P' then 'CANCELED' else 'SCHEDULED' end, null::bigint, '', null::integer, null::bigint, null::integer, null::bigint, '', true, day_end, day_end + 19 from sent_ where l_partkey % 19 = 0""",
    "src_raw_store": """select cast(o_orderkey as varchar) trip_id, strftime(cast(o_orderdate as date), '%Y%m%d') start_date, case when old then null else cast(o_custkey % 50 as varchar) end route_id, case when old then null when o_orderstatus = 'P' and l_partkey % 19 = 0 then 'CANCELED' else 'SCHEDULED' end trip_schedule_relationship, number_ stop_sequence,
  case when l_suppkey % 9 = 0 then ' ' else 'S' || l_suppkey end stop_id, case when l_partkey % 13 <> 0 then d::integer end arrival_delay, case when l_partkey % 11 <> 0 then s + d end arrival_time, case when l_partkey % 17 <> 0 then (d + 30)::integer end departure_delay, s + 120 + d departure_time,
  case when l_returnflag = 'R' then 'SKIPPED' else 'SCHEDULED' end schedule_relationship, l_partkey % 19 = 0 is_trip_level_only, at_ snapshot_timestamp, case when l_partkey % 29 <> 0 then at_ + 19 end fetched_at
  from (select *, coalesce(number_, 0) % 2 = 1 old, 1787270400 + (s + l_partkey % 3600) % 3 * 86400 + (s + l_partkey % 3600) % 4 * 21600 at_ from (select *, case when l_partkey % 19 <> 0 and l_partkey % 23 <> 0 then l_linenumber::bigint end number_ from sent_))
  where cast(make_timestamp(at_ * 1000000) as date) = date '2026-08-22'""",
    "src_timetable_archive": """select p.static_version, p.feed, p.trip_id, p.stop_sequence, p.stop_id, 'Stop, ' || p.stop_id stop_name, 'L' || (o.o_custkey % 50) line, p.arrival_s, p.departure_s
  from planned_ p join orders o on cast(o.o_orderkey as varchar) = p.trip_id""",
    "src_timetable_as_of": "select * from planned_ p where static_version = (select max(q.static_version) from planned_ q where q.feed = p.feed and q.static_version <= date '1995-06-17')",
    "stg_realtime_messages": f"select 'realtime' source, service_date, cast(service_date as varchar) || '_' || trip_id trip_key, trip_id, cancelled trip_cancelled, {_BERLIN.format('snapshot')} snapshot_ts, {_berlin('fetched is not null', 'coalesce(fetched, 0)')} fetched_at from raw_ where alone",
    "stg_realtime_polls": f"select 'realtime' source, {_BERLIN.format('fetched')} fetched_at, {_BERLIN.format('snapshot')} snapshot_ts from raw_ where fetched is not null",
    "stg_realtime_unusable": "select strftime(service_date, '%Y%m%d') start_date, trip_id, count(*) n from raw_ where not alone and stop_sequence is null group by 1, 2",
    "raw_extremes": """select count(*) n_rows, min(a) arr_min, max(a) arr_max, min(d2) dep_min, max(d2) dep_max, min(h) hour_min, max(h) hour_max, count(*) filter (where h < 0 or h >= 30) outside, count(h) timed from
  (select case when l_partkey % 13 <> 0 then d::integer end a, case when l_partkey % 17 <> 0 then (d + 30)::integer end d2, case when l_partkey % 13 <> 0 and l_partkey % 11 <> 0 then (s - epoch(service_date)::bigint) / 3600.0::double end h from raw_)""",
    "set_united_sources": "select * from events_ union all by name select * exclude (block_id) from swiss_",
    "set_label_dictionaries": "select stop_id \"key\", 'stop' kind, max(stop_name) label, count(distinct stop_name) variants, min(static_version) first_seen, max(static_version) last_seen from static_stops_ group by 1 union all select cast(o_custkey % 500 as varchar), 'line', max(o_orderpriority), count(distinct o_orderpriority), date '2026-01-01', date '2026-01-01' from orders group by 1",
    "fn_boundaries": f"select event_id, {', '.join(f"date_diff('{u}', ts, ts + to_seconds(event_id % 9000)) n_{u}" for u in ('minute', 'hour', 'day'))} from events",
    "str_without_repeats": "select distinct trip_id, strftime(service_date, '%Y%m%d') start_date, stop_sequence, snapshot snapshot_timestamp from raw_",
    "srt_run_table": "select * from ext_runs_",
    "dq_reconciliation": "with a as (select service_date, source, sum(run_measured)::bigint n, sum(run_delta_sum)::bigint s from origin_ group by 1, 2), b as (select service_date, source, sum(run_measured)::bigint n, sum(run_delta_sum)::bigint s from bottlenecks_ group by 1, 2) select coalesce(a.service_date, b.service_date) service_date, coalesce(a.source, b.source) source, a.n origin_measured, b.n bottleneck_measured, a.s origin_sum, b.s bottleneck_sum from a full join b on a.service_date = b.service_date and a.source = b.source",
    "dq_previous_stop": "select a.source, a.trip_key, a.stop_no, a.is_direct, b.dep_delay_s prev_dep_delay_s, a.arr_delay_s - b.dep_delay_s expected_run_s from runs_ a join runs_ b on b.source = a.source and b.trip_key = a.trip_key and b.stop_no = a.stop_no - 1",
    "dq_summary": "select 'error' severity, count(*) filter (where arr_delay_s is not null and dst_ambiguous) dst_metrics, count(*) filter (where stop_no > 1 and not is_direct) gaps from runs_",
}

#: Queries that reach by another way what another does: increments, streams, files.
WHOLE = {"inc_consolidated_stops": "consolidated_stops", "inc_run_detail": "mart_run_detail", "inc_delay_origin": "mart_delay_origin", "inc_bottlenecks": "mart_bottlenecks", "inc_buffer_balance": "mart_buffer_balance", "inc_punctuality": "mart_punctuality", "inc_data_quality": "mart_data_quality", "inc_ext_buffer_lines": "ext_buffer_lines", "inc_poll_gaps": "win_poll_gaps", "inc_collection": "mart_collection"}
WHOLE |= {"stream_changes_replayed": "stream_change_detection", "stream_without_repeats": "str_without_repeats", "src_csv_by_name": "stg_swiss_events"}
WHOLE |= {f"inc_ext_{name}": f"ext_{name}" for name in ("sections", "collection", "punctuality", "buffer_sections", "run_sample")}
FINAL |= {name: FINAL[whole] for name, whole in WHOLE.items()}
FINAL |= {f"dq_{name}": f"select '{name}' \"name\", '{severity}' severity, count(*) violations from ({rows})" for name, (severity, rows) in VIOLATIONS.items()}

#: Columns of dates and times by query, which are returned as text.
TEXTS: dict[str, str] = {
    "rep_data_state": "first_day last_day",
    "rep_collection_days": "calendar_day",
    "prj_reconstructed_schedule": "snapshot_ts sched_arr sched_dep",
    "prj_plausible_reports": "snapshot_ts",
    "prj_timetable_seconds": "static_version",
    "src_timetable_archive": "static_version",
    "src_timetable_as_of": "static_version",
    "prj_wall_clock": "local_time",
    "prj_path_origin": "static_version",
    "join_lines_of_trips": "static_version",
    "join_valid_version": "static_version",
    "join_cancelled_stops": "service_date sched_arr sched_dep",
    "join_run_coverage": "service_date static_version",
    "agg_name_variants": "first_seen last_seen",
    "win_poll_gaps": "fetched_at snapshot_ts",
    "consolidated_stops": "service_date sched_arr sched_dep actual_arr actual_dep",
    "stop_events": "service_date sched_arr sched_dep actual_arr actual_dep",
    "mart_run_detail": "service_date sched_arr sched_dep",
    "mart_delay_origin": "service_date",
    "mart_bottlenecks": "service_date",
    "mart_buffer_balance": "service_date",
    "mart_punctuality": "service_date",
    "mart_data_quality": "service_date",
    "mart_collection": "calendar_day first_poll last_poll",
    "ext_collection": "calendar_day",
    "ext_punctuality": "service_date",
    "ext_run_sample": "service_date departs",
    "rep_one_source": "service_date",
    "rep_top_sections": "service_date",
    "rep_coverage": "service_date",
    "rep_run_sources": "day",
    "stg_swiss_events": "service_date sched_arr sched_dep actual_arr actual_dep",
    "stg_realtime_reports": "service_date snapshot_ts fetched_at actual_arr actual_dep sched_arr sched_dep",
    "stg_realtime_messages": "service_date snapshot_ts fetched_at",
    "stg_realtime_polls": "fetched_at snapshot_ts",
    "set_united_sources": "service_date sched_arr sched_dep actual_arr actual_dep",
    "set_label_dictionaries": "first_seen last_seen",
    "srt_run_table": "service_date departs",
    "dq_reconciliation": "service_date",
}
TEXTS |= {name: TEXTS[whole] for name, whole in WHOLE.items() if whole in TEXTS}


def _needs(sql: str, found: list[str]) -> None:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needs(CTES[name], found)
            if name not in found:
                found.append(name)


def sql(name: str) -> str:
    """The statement of a query: the relations it needs, and dates and times as text."""
    needed: list[str] = []
    _needs(FINAL[name], needed)
    relations = "".join(f"{n} as materialized ({CTES[n]}),\n" for n in needed)
    texts = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in TEXTS.get(name, "").split())
    return f"with {relations}final_ as ({FINAL[name]}) select *{f' replace ({texts})' if texts else ''} from final_"
