"""DuckDB SQL for the registered queries, over the same supplied tables."""

from __future__ import annotations

from checks.inputs import END, NUDGE, START
from clicklake.functions.normal_scores import C1, C2, C5, C6, MIDDLE, OUTER, TAIL

PHRASED = """case {sel} when 0 then p_name
  when 1 then concat('how to ', p_name)
  when 2 then concat(p_name, ' best practices guide')
  when 3 then concat('what is the best ', p_name, ' for beginner')
  else concat('tutorial on choosing the right ', p_name, ' online free') end"""

EVENT_LOG = f"""
ev0 as (
  select event_id, ts, user_id, value, cast(json_extract_string(props, '$.k') as int) as k,
         event_type in ('view', 'signup', 'error') as is_search,
         concat(cast(user_id as varchar), '-', cast(cast(date_trunc('week', ts) as date) as varchar)) as session_id
  from events),
ev1 as (
  select *, sum(case when is_search then 1 else 0 end) over (
    partition by session_id order by ts, event_id
    rows between unbounded preceding and current row) - 1 as qidx
  from ev0),
ev2 as (
  select *, max(case when is_search then k end) over (partition by session_id, qidx) as qk
  from ev1 where qidx >= 0),
ev3 as (
  select ev2.*, {PHRASED.format(sel="qk % 5")} as query from ev2 join part on p_partkey = qk),
log as (
  select event_id, session_id, user_id, ts as timestamp,
    case when is_search then 'search' else 'click' end as event_type, query,
    case when is_search then cast(length(query) as int) end as query_length,
    case when is_search then cast(length(query) - length(replace(query, ' ', '')) + 1 as int) end as query_words,
    cast(qidx as int) as query_index_in_session,
    case cast(user_id % 4 as int) when 0 then 'new_user' when 1 then 'regular_user'
      when 2 then 'power_user' else 'enterprise_user' end as user_segment,
    case cast(user_id % 3 as int) when 0 then 'desktop' when 1 then 'mobile' else 'tablet' end as device_type,
    case when is_search then 5 + k % 46 end as results_returned,
    case when is_search then value * 2 end as search_latency_ms,
    case when not is_search then 1 + k % 10 end as click_position,
    case when not is_search then case k % 6 when 0 then 'web' when 1 then 'video' when 2 then 'image'
      when 3 then 'pdf' when 4 then 'stackoverflow' else 'github' end end as result_type,
    case when not is_search then value end as time_on_result_seconds,
    case when not is_search then value > 30 end as is_satisfied,
    case when user_id % 8 < 4 then 'control' else 'experiment' end as variant
  from ev3),
s as (select *, cast(timestamp as date) as d from log where event_type = 'search'),
c as (select *, cast(timestamp as date) as d from log where event_type = 'click'),
first_click as (
  select session_id, query_index_in_session, min(timestamp) as clicked_at from c group by all),
pairs as (
  select s.session_id, s.timestamp, s.d, s.device_type as device_type_search,
    date_diff('microsecond', s.timestamp, c.timestamp) / 1e6 as wait
  from s join c using (session_id, query_index_in_session)),
session_wait as (
  select session_id, avg(date_diff('microsecond', timestamp, clicked_at) / 1e6) as avg_time_to_click
  from s join first_click using (session_id, query_index_in_session) group by 1),
session_clicks as (
  select session_id, count(*) as num_clicks, count_if(is_satisfied) as satisfied from c group by 1),
ses as (
  select session_id, min(user_id) as user_id, min(user_segment) as user_segment,
    min(device_type) as device_type, min(timestamp) as session_start,
    date_diff('microsecond', min(timestamp), max(timestamp)) / 1e6 as session_duration_seconds,
    count(*) as num_queries, coalesce(min(num_clicks), 0) as num_clicks,
    coalesce(min(satisfied), 0) as satisfied, avg(query_length) as avg_query_length,
    count(distinct query) as unique_queries,
    (count(*) - count(distinct query)) / count(*) as reformulation_rate,
    min(avg_time_to_click) as avg_time_to_click
  from s left join session_clicks using (session_id) left join session_wait using (session_id)
  group by session_id),
qm as (
  select s.session_id, s.user_id, s.query, s.query_index_in_session, s.user_segment,
    s.device_type, s.timestamp, s.query_length, s.query_words, s.results_returned,
    s.search_latency_ms, s.variant,
    coalesce(a.n, 0) as num_clicks, a.n is not null as has_click,
    a.avg_click_position, a.first_click_position, a.avg_time_on_result,
    coalesce(a.sat, false) as has_satisfied_click, s.d as date
  from s left join (
    select session_id, query_index_in_session, count(*) as n,
      avg(click_position) as avg_click_position, min(click_position) as first_click_position,
      avg(time_on_result_seconds) as avg_time_on_result, bool_or(is_satisfied) as sat
    from c group by 1, 2) a using (session_id, query_index_in_session)),
eng as (
  select session_id, user_id, user_segment, device_type, session_start,
    session_duration_seconds, num_queries, num_clicks, unique_queries, reformulation_rate,
    round_even(round((least(num_queries / 5, 1) * 0.2::double + least(num_clicks / 10, 1) * 0.4::double
      + least(session_duration_seconds / 300, 1) * 0.3::double
      + greatest(0, 1 - reformulation_rate) * 0.1::double) * 1000, 6), 0) / 1000 as engagement_score
  from ses)"""

QUERY_LOG = f"""
qlog as (
  select o_orderkey as query_id,
    concat(cast(o_custkey as varchar), '-', cast(year(o_orderdate) as varchar)) as session_id,
    o_custkey as user_id, {PHRASED.format(sel="o_orderkey % 5")} as query_text,
    o_orderdate as timestamp
  from orders join part on p_partkey = o_orderkey % 100)"""

RESULT_LOG = f"""{QUERY_LOG},
placed as (
  select l_orderkey, l_partkey, l_quantity, l_returnflag = 'R' as clicked,
    row_number() over (partition by l_orderkey
      order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as position
  from lineitem),
res as (
  select concat(cast(query_id as varchar), '-', cast(position as varchar)) as result_id,
    query_id, session_id, user_id, query_text, timestamp as query_time,
    timestamp + to_seconds(cast(l_partkey % 600 as bigint)) as timestamp,
    cast(position as int) as position, l_partkey as document_id, clicked,
    case when clicked then qlog.timestamp + to_seconds(cast(l_partkey % 600 as bigint)) end as click_time,
    case when clicked then l_quantity * 2 end as dwell_time,
    case when clicked then cast(l_partkey % 600 as double) / 50 end as time_to_click,
    case when user_id % 8 < 4 then 'control' else 'experiment' end as variant
  from qlog join placed on l_orderkey = query_id),
clk as (
  select *, case user_id % 3 when 0 then 'desktop' when 1 then 'mobile' else 'tablet' end as device_type
  from res where clicked),
unit_gain as (
  select query_id, sum(case when position <= 10 then 1 / log2(position + 1) else 0 end) as dcg,
    sum(case when nth <= 10 then 1 / log2(nth + 1) else 0 end) as ideal
  from (select query_id, position, row_number() over (partition by query_id order by position) as nth
        from res where clicked) group by 1),
dwell_gain as (
  select query_id,
    {", ".join(
        f"sum(case when position <= {k} then gain / log2(position + 1) else 0 end) as dcg_{k}, "
        f"sum(case when nth <= {k} then gain / log2(nth + 1) else 0 end) as ideal_{k}"
        for k in (3, 5, 10))}
  from (select query_id, position, gain,
          row_number() over (partition by query_id order by gain desc) as nth
        from (select query_id, position, least(coalesce(dwell_time, 0) / 60, 1) as gain
              from res where clicked)) group by 1),
shown as (select query_id, count(*) as results, count_if(clicked) as click_count from res group by 1),
firsts as (
  select query_id, variant, arg_min(position, row(timestamp, position)) filter (where clicked) as pos,
    bool_or(clicked) as hit
  from res group by all),
dw as (
  select query_id, variant, click_count, coalesce(case when ideal_10 > 0 then dcg_10 / ideal_10 end, 0) as ndcg
  from (select distinct query_id, variant from res) join shown using (query_id)
  left join dwell_gain using (query_id))"""

STAR = f"""{RESULT_LOG},
usr as (
  select c_custkey as user_id, c_mktsegment as user_segment,
    case c_custkey % 3 when 0 then 'desktop' when 1 then 'mobile' else 'tablet' end as device_type,
    case c_custkey % 4 when 0 then 'chrome' when 1 then 'firefox' when 2 then 'safari' else 'edge' end as browser,
    n_name as location
  from customer left join nation on n_nationkey = c_nationkey),
facts as (
  select qlog.*, coalesce(results, 0) as result_count, coalesce(clicks, 0) as click_count,
    coalesce(clicks, 0) > 0 as has_click, time_to_first_click, max_click_position
  from qlog left join (
    select query_id, count(*) as results, count_if(clicked) as clicks,
      min(case when clicked then time_to_click end) as time_to_first_click,
      max(case when clicked then position end) as max_click_position
    from res group by 1) using (query_id)),
sessions as (
  select session_id, user_id, start_time, end_time,
    date_diff('microsecond', start_time, end_time) / 1e6 as session_duration,
    device_type, browser, user_segment, total_queries, total_clicks
  from (select session_id, min(user_id) as user_id, min(timestamp) as start_time,
          max(timestamp) as end_time, count(*) as total_queries,
          cast(sum(click_count) as bigint) as total_clicks
        from facts group by 1) left join usr using (user_id)),
queries as (
  select query_id, session_id, query_text, timestamp, result_count,
    lag(query_id) over (partition by session_id order by timestamp, query_id) as reformulation_of,
    has_click, time_to_first_click, max_click_position
  from facts),
daily as (
  select cast(timestamp as date) as date, user_segment, device_type,
    count(distinct session_id) as total_sessions, count(*) as total_queries,
    cast(sum(click_count) as bigint) as total_clicks, avg(has_click::int) as avg_ctr,
    avg(time_to_first_click) as avg_time_to_first_click,
    count(*) / count(distinct session_id) as avg_queries_per_session,
    1 - avg(has_click::int) as zero_click_rate, avg(max_click_position) as click_depth,
    avg(coalesce(case when ideal > 0 then dcg / ideal end, 0)) as avg_ndcg
  from facts left join unit_gain using (query_id) join usr using (user_id)
  group by 1, 2, 3),
daily_in as (select * from daily where date between date '{START}' and date '{END}'),
prof as (
  select *, date_diff('microsecond', start_time, end_time) / 1e6 as duration,
    num_clicks / num_queries as clicks_per_query,
    num_clicks > 0 and date_diff('microsecond', start_time, end_time) / 1e6 > 10 as success
  from (select session_id, count(*) as num_queries, cast(sum(click_count) as bigint) as num_clicks,
          min(user_id) as user_id, min(usr.device_type) as device_type, min(timestamp) as start_time,
          max(timestamp) as end_time
        from facts left join usr using (user_id) group by 1))"""

IN_1997 = f"between date '{START}' and date '{END}'"


def _ev(sql: str) -> str:
    return f"with {EVENT_LOG} {sql}"


def _res(sql: str) -> str:
    return f"with {RESULT_LOG} {sql}"


def _star(sql: str) -> str:
    return f"with {STAR} {sql}"


def _even(expr: str, digits: int) -> str:
    return f"round_even(round(({expr}) * 1e{digits}, 6), 0) / 1e{digits}"


# Normal quantiles at 0.975, 0.95 and 0.8.
Z_TWO, Z_ONE, Z_POWER = 1.9599639845400536, 1.6448536269514715, 0.8416212335729144

WEEK = "concat(cast(cast(date_trunc('week', d) as date) as varchar), '/', cast(cast(date_trunc('week', d) as date) + 6 as varchar))"
MONTH = "strftime(d, '%Y-%m')"
PERIOD = {
    "daily": "d", "weekly": WEEK, "monthly": MONTH,
    "hour": "date_trunc('hour', timestamp)",
    "week": "cast(date_trunc('week', d) as timestamp)",
}


def _ctr(period: str | None = None, by: tuple[str, ...] = (), clicks: str = "c", source: str = "") -> str:
    keys = [f"{PERIOD[period]} as period"] if period else []
    keys += list(by)
    names = (["period"] if period else []) + list(by)
    n = len(names)
    group = ", ".join(str(at + 1) for at in range(n))
    return f"""{source}
  select a.*, coalesce(h, 0) as searches_with_clicks,
    coalesce(h, 0) / total_searches as click_through_rate,
    coalesce(h, 0) / total_searches * 100 as ctr_percentage
  from (select {', '.join(keys)}, count(*) as total_searches from s group by {group}) a
  left join (select {', '.join(keys)}, count(distinct (session_id, query_index_in_session)) as h
             from {clicks} c group by {group}) b using ({', '.join(names)})"""


def _ttc(period: str, by: tuple[str, ...] = (), digits: int | None = 2, source: str = "pairs") -> str:
    def shown(expr: str) -> str:
        return expr if digits is None else _even(expr, digits)

    keys = ", ".join([f"{PERIOD[period]} as period", *by])
    return f"""select {keys}, {shown('avg(wait)')} as avg_time_to_click_seconds,
    {shown('median(wait)')} as median_time_to_click_seconds,
    {shown('stddev_samp(wait)')} as std_time_to_click_seconds,
    count(wait) as total_clicks, count(distinct session_id) as unique_sessions
  from {source} group by {', '.join(str(n + 1) for n in range(len(by) + 1))}"""


def _positions(period: str, by: tuple[str, ...] = ()) -> str:
    keys = ", ".join([f"{PERIOD[period]} as period", *by])
    tops = ", ".join(
        f"count_if(click_position <= {n}) / count(*) * 100 as top_{n}_click_percentage"
        for n in (1, 3, 5)
    )
    return f"""select {keys}, {_even('avg(click_position)', 2)} as avg_click_position,
    {_even('median(click_position)', 2)} as median_click_position,
    {_even('stddev_samp(click_position)', 2)} as std_click_position,
    count(session_id) as total_clicks, {tops}
  from c group by {', '.join(str(n + 1) for n in range(len(by) + 1))}"""


def _result_types(period: str) -> str:
    t = "time_on_result_seconds"
    return f"""select {PERIOD[period]} as period, result_type,
    {_even(f'avg({t})', 2)} as avg_time_on_result, {_even(f'median({t})', 2)} as median_time_on_result,
    {_even(f'stddev_samp({t})', 2)} as std_time_on_result,
    {_even('avg(is_satisfied::int)', 2)} as satisfaction_rate, count(session_id) as total_clicks
  from c group by 1, 2"""


def _rollup(keys: str, digits: int | None, with_time: bool) -> str:
    def shown(expr: str) -> str:
        return expr if digits is None else _even(expr, digits)

    last = f", {shown('avg(avg_time_on_result)')} as avg_time_on_result" if with_time else ""
    return f"""select {keys}, count(distinct session_id) as unique_sessions,
    count(distinct user_id) as unique_users, count(query) as total_queries,
    {shown('avg(has_click::int)')} as click_through_rate,
    {shown('avg(has_satisfied_click::int)')} as satisfaction_rate,
    {shown('avg(search_latency_ms)')} as avg_search_latency_ms,
    {shown('avg(query_length)')} as avg_query_length,
    {shown('avg(first_click_position)')} as avg_first_click_position{last}
  from qm group by {keys}"""


def _engagement(period: str) -> str:
    label = PERIOD[period].replace("d", "cast(session_start as date)") if period == "daily" else (
        WEEK.replace("date_trunc('week', d)", "date_trunc('week', session_start)")
    )
    return f"""select session_id, user_id, user_segment, device_type, {label} as period,
    session_duration_seconds, num_queries, num_clicks, unique_queries, reformulation_rate,
    engagement_score from eng"""


def _anomalies(source: str, metric: str, window: int, threshold: float, order: str = "date") -> str:
    frame = f"over (order by {order} rows between {window - 1} preceding and current row)"
    return f"""select *, coalesce(abs({metric}_zscore) > {threshold}, false) as {metric}_is_anomaly
  from (select *, ({metric} - {metric}_rolling_mean) / nullif({metric}_rolling_std, 0) as {metric}_zscore
    from (select *,
      case when count({metric}) {frame} >= 3 then avg({metric}) {frame} end as {metric}_rolling_mean,
      case when count({metric}) {frame} >= 3 then stddev_samp({metric}) {frame} end as {metric}_rolling_std
      from ({source})))"""


CTR_BY_DAY = f"select period as date, click_through_rate as ctr from ({_ctr('daily')})"
TREND = f"select *, row_number() over (order by date) - 1 as row_index from ({CTR_BY_DAY})"

R6_BY = """
q6 as (select variant, avg(case when pos > 0 then 1 / pos else 0 end) as mrr,
         avg(hit::int) as successful_query_rate from firsts group by all),
n6 as (select variant, coalesce(avg(ndcg) filter (where click_count > 0), 0) as ndcg from dw group by all),
p6 as (select variant, coalesce(avg(position) filter (where clicked), 0) as avg_click_position,
         avg(clicked::int) filter (where position = 1) as first_position_ctr from res group by all),
r4 as (
  select variant, avg(n) as avg_queries_per_session, avg((n > 1)::int) as reformulation_rate,
    avg((not hit)::int) as abandonment_rate,
    avg(case when n > 1 then (missed - last_missed) / (n - 1) else 0 end) as zero_click_reformulation_rate
  from (select variant, session_id, count(*) as n, bool_or(hit) as hit, count_if(not hit) as missed,
          arg_max((not hit)::int, {place}) as last_missed
        from (select variant, session_id, query_id, bool_or(clicked) as hit, min(timestamp) as t
              from res group by all) group by all) group by all)"""


def _r6(select: str, place: str = "query_id", split: bool = False) -> str:
    parts = R6_BY.format(place=place)
    if not split:
        parts = parts.replace("select variant, ", "select ").replace("group by all)", "group by all)")
    return f"with {RESULT_LOG}, {parts} {select}"


_MEASURES = (
    ("mrr", "q6"), ("ndcg", "n6"), ("successful_query_rate", "q6"), ("avg_click_position", "p6"),
    ("first_position_ctr", "p6"), ("avg_queries_per_session", "r4"), ("reformulation_rate", "r4"),
    ("abandonment_rate", "r4"), ("zero_click_reformulation_rate", "r4"),
)
R7 = " union all ".join(
    f"""select '{m}' as metric, a.{m} as baseline, b.{m} as experiment, b.{m} - a.{m} as absolute_diff,
    case when a.{m} = 0 then 'inf'::double else (b.{m} - a.{m}) / a.{m} * 100 end as relative_diff_percent
    from {t} a, {t} b where a.variant = 'control' and b.variant = 'experiment'"""
    for m, t in _MEASURES
)

DISTRIBUTION = """select {by}, count(*) as session_count,
  count(*) * 100 / (select count(*) from sessions where cast(start_time as date) {dates}) as percentage,
  avg(total_queries) as avg_queries, avg(total_clicks) as avg_clicks, avg(session_duration) as avg_duration
  from sessions where cast(start_time as date) {dates} group by 1"""

POSITIONS = """select position, count(*) as impression_count, count_if(clicked) as click_count,
  count_if(clicked) / count(*) as ctr, avg(dwell_time) as avg_dwell_time
  from res r {join} where {where} group by 1 order by 1 limit 20"""

TOP_QUERIES = f"""select query_text, count(*) as query_count, count_if(has_click) as click_count,
  count_if(has_click) / count(*) as click_rate, avg(time_to_first_click) as avg_time_to_click
  from queries where cast(timestamp as date) {IN_1997} group by 1
  order by query_count desc, query_text limit {{n}}"""

LOW = """select q.query_text, count(*) as query_count, count_if(q.has_click) / count(*) as click_rate,
  avg(case when q.has_click then q.time_to_first_click end) as avg_time_to_click,
  max(r.position) as deepest_click_position
  from queries q left join {results} r on q.query_id = r.query_id
  where cast(q.timestamp as date) {dates} group by 1
  having count(*) >= 5 and (count_if(q.has_click) / count(*) < 0.3
    or avg(case when q.has_click then q.time_to_first_click end) > 10 or max(r.position) > 5)
  order by click_rate, query_count desc, query_text limit 20"""


def _arms(source: str, metrics: tuple[str, ...]) -> str:
    """Arm statistics by sorting the whole sample."""
    long = " union all ".join(
        f"select '{m}' as metric, variant = 'control' as ctl, cast({m} as double) as v from {source} "
        f"where {m} is not null" for m in metrics
    )
    return f"""
long as ({long}),
arm as (select metric, ctl, count(*) as n, avg(v) as m, var_samp(v) as s2, median(v) as med
        from long group by all),
dev as (select metric, ctl, avg(abs(v - med)) as zbar, sum(abs(v - med) ** 2) as zz
        from long join arm using (metric, ctl) group by all),
hist as (select metric, v, count_if(ctl) as c, count_if(not ctl) as e from long group by all),
cum as (select *, sum(e) over (partition by metric order by v) as upto_e from hist),
u as (select metric, sum(c * (upto_e - e / 2)) as u_statistic,
        sum(cast(c + e as double) ** 3 - (c + e)) as tie_sum from cum group by all)
select metric, a.n as control_sample_size, b.n as experiment_sample_size,
  a.m as control_mean, b.m as experiment_mean, a.s2 as control_variance, b.s2 as experiment_variance,
  a.med as control_median, b.med as experiment_median,
  (a.m - b.m) / sqrt(((a.n - 1) * a.s2 + (b.n - 1) * b.s2) / (a.n + b.n - 2) * (1 / a.n + 1 / b.n)) as student_t,
  (a.m - b.m) / sqrt(a.s2 / a.n + b.s2 / b.n) as welch_t,
  (a.s2 / a.n + b.s2 / b.n) ** 2
    / ((a.s2 / a.n) ** 2 / (a.n - 1) + (b.s2 / b.n) ** 2 / (b.n - 1)) as welch_df,
  (a.n + b.n - 2) * (a.n * b.n / (a.n + b.n) * (x.zbar - y.zbar) ** 2)
    / nullif(x.zz - a.n * x.zbar ** 2 + y.zz - b.n * y.zbar ** 2, 0) as levene_w,
  u_statistic, tie_sum
from arm a join arm b using (metric) join dev x using (metric) join dev y using (metric) join u using (metric)
where a.ctl and not b.ctl and x.ctl and not y.ctl"""


def _rank_p(source: str, metrics: tuple[str, ...], by: str = "") -> str:
    """Table ``rp``: Mann-Whitney p-values, the normal tail through the series of erf."""
    keys = "metric, seg" if by else "metric"
    seg = f"{by} as seg, " if by else ""
    long = " union all ".join(
        f"select '{m}' as metric, {seg}variant = 'control' as ctl, {m} as v from {source} "
        f"where {m} is not null" for m in metrics
    )
    return f"""
rl as ({long}),
rh as (select {keys}, v, count_if(ctl) as c, count_if(not ctl) as e from rl group by all),
rc as (select *, sum(e) over (partition by {keys} order by v) as upto_e from rh),
ru as (select {keys}, sum(c) as n1, sum(e) as n2, sum(c * (upto_e - e / 2)) as u,
         sum(cast(c + e as double) ** 3 - (c + e)) as tie from rc group by {keys}),
rz as (select {keys}, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5::double)
         / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - tie / ((n1 + n2) * (n1 + n2 - 1)))) / sqrt(2) as x from ru),
rp as (select {keys}, p_value, p_value < 0.05 as significant, 'Mann-Whitney U test' as test_type
  from (select {keys}, least(1.0::double, 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80),
      lambda n: (case when n % 2 = 0 then 1 else -1 end) * x ** (2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))))
    as p_value from rz))"""


def _polynomial(coefficients: tuple, x: str) -> str:
    return "(" + " + ".join(f"{c!r}::double * {x} ** {at}" for at, c in enumerate(coefficients)) + ")"


def _normal_quantile(p: str, r: str) -> str:
    """AS 241; r is the root of minus the logarithm of the smaller tail."""
    def ratio(parts: tuple, x: str) -> str:
        return f"{_polynomial(parts[0], x)} / {_polynomial(parts[1], x)}"

    return f"""case when abs({p} - 0.5) <= 0.425 then ({p} - 0.5) * ({ratio(MIDDLE, f"(0.180625 - ({p} - 0.5) ** 2)")})
      else sign({p} - 0.5) * (case when {r} <= 5 then {ratio(OUTER, f"({r} - 1.6)")} else {ratio(TAIL, f"({r} - 5)")} end) end"""


def _mix(x: str, out: str) -> str:
    """Columns that scatter the 32-bit number x, the last of them ``out``."""
    mask = "4294967295::ubigint"
    return f"""(xor({x}, {x} >> 16) * 2146121005::ubigint) & {mask} as {out}_1,
    (xor({out}_1, {out}_1 >> 15) * 2221713035::ubigint) & {mask} as {out}_2, xor({out}_2, {out}_2 >> 16) as {out}"""


def _compared(source: str, metrics: tuple[str, ...], by: str = "", draws: int = 10_000) -> str:
    """Table ``cmp``: test chosen by Shapiro-Wilk, its p-value, and the Poisson bootstrap's bounds.

    Every observation has its own row and score. Arms have more than 11 values; for arms that both look
    normal there is no p-value here, so such a row would differ.
    """
    keys = "metric, seg" if by else "metric"
    return f"""{_rank_p(source, metrics, by)},
arm as (
  select *, sum(times) over (partition by {keys}, ctl order by v) as upto, sum(times) over (partition by {keys}, ctl) as n
  from (select {keys}, ctl, v, count(*) as times from rl group by all)),
ranked as (select *, unnest(range(cast(upto - times + 1 as bigint), cast(upto + 1 as bigint))) as rank from arm),
shares as (select *, (rank - 0.375::double) / (n + 0.25::double) as p, sqrt(-ln(least(p, 1 - p))) as r from ranked),
scored as (select *, {_normal_quantile("p", "r")} as m from shares),
shapiro as (
  select {keys}, ctl, any_value(n) as n, sum(m * m) as mm, sum(m * v) - sum(m) * avg(v) as scores,
    sum(v * v) - sum(v) * avg(v) as squares, -min(m) filter (where rank = 1) as m1, -min(m) filter (where rank = 2) as m2,
    max(v) - min(v) as wide, max(v) filter (where rank = n - 1) - max(v) filter (where rank = 2) as narrow
  from scored group by {keys}, ctl),
weights as (
  select *, 1 / sqrt(n) as root, {_polynomial(C1, "root")} + m1 / sqrt(mm) as a1, {_polynomial(C2, "root")} + m2 / sqrt(mm) as a2,
    sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) as scale,
    (a1 * wide + a2 * narrow + (scores - m1 * wide - m2 * narrow) / scale) ** 2 / squares as w, ln(n) as logn
  from shapiro),
normal as (
  select {keys}, bool_and((ln(1 - w) - ({_polynomial(C5, "logn")})) / exp({_polynomial(C6, "logn")}) <= 1.6448536269514722::double) as both_normal
  from weights group by {keys}),
law as (
  select k, pow(2, k) as mean, unnest(range(cast(greatest(0, floor(mean - 8 * sqrt(mean))) as bigint), cast(ceil(mean + 8 * sqrt(mean)) + 9 as bigint))) as j,
    exp(-mean + j * ln(mean) - lgamma(j + 1)) as w from range(0, 16) t(k)),
upto as (select k, j, sum(w) over (partition by k order by j) / sum(w) over (partition by k) as upto from law),
drawn as (
  select g.k, h, j from (select k, h, (h + 0.5::double) / 65536 as q from range(0, 16) t(k) cross join range(0, 65536) s(h)) g
  asof join upto u on g.k = u.k and g.q <= u.upto),
bits as (
  select *, cast(ctl as int) as is_control, cast(upto as ubigint) as place from (select *, unnest(range(0, 16)) as k from arm)
  where (cast(times as bigint) >> k) & 1 = 1),
named as (
  select *, cast((place >> 32) * 128 + 2 * k + is_control as ubigint) & 4294967295::ubigint as high, {_mix("high", "mixed")},
    xor(mixed, place & 4294967295::ubigint) as low, {_mix("low", "name")} from bits),
replicated as (
  select {keys}, ctl, v, k, replicate, (name + cast(replicate as ubigint) * 2654435769::ubigint) & 4294967295::ubigint as x, {_mix("x", "y")}, y >> 16 as h
  from named cross join range(0, {draws}) t(replicate)),
resampled as (
  select {keys}, replicate, sum(v * j) filter (where not ctl) / sum(j) filter (where not ctl)
      - sum(v * j) filter (where ctl) / sum(j) filter (where ctl) as gap
  from replicated a join drawn d on d.k = a.k and d.h = cast(a.h as bigint) group by {keys}, replicate),
bounds as (select {keys}, quantile_cont(gap, 0.025) as ci_lower, quantile_cont(gap, 0.975) as ci_upper from resampled group by {keys}),
cmp as (
  select {keys}, case when not both_normal then p_value end as p_value, case when not both_normal then significant end as significant,
    case when both_normal then 'a t-test' else 'Mann-Whitney U test' end as test_type, ci_lower, ci_upper
  from rp join normal using ({keys}) join bounds using ({keys}))"""


def _arm_means(source: str, metrics: tuple[str, ...], by: str = "") -> str:
    seg = f"{by} as seg, " if by else ""
    group = "group by 1, 2" if by else ""
    return " union all ".join(
        f"""select '{m}' as metric, {seg}avg({m}) filter (where variant = 'control') as control_mean,
        avg({m}) filter (where variant = 'experiment') as experiment_mean,
        count({m}) filter (where variant = 'control') as control_sample_size,
        count({m}) filter (where variant = 'experiment') as experiment_sample_size, count(*) as segment_size
        from {source} {group}""" for m in metrics
    )


def _comparison(source: str, metrics: tuple[str, ...]) -> str:
    return f"""{_compared(source, metrics)}
select metric, control_mean, experiment_mean, experiment_mean - control_mean as absolute_difference,
  (experiment_mean - control_mean) / control_mean * 100 as relative_difference_percent,
  control_sample_size, experiment_sample_size, p_value, significant, test_type, cast(null as varchar) as error, ci_lower, ci_upper
from ({_arm_means(source, metrics)}) join cmp using (metric)"""


def _t_margin(mean: str, error: str, n: str) -> str:
    """0.975 quantile of t with n - 1 degrees of freedom, as a series around the normal one."""
    z, v = f"{Z_TWO!r}::double", f"({n} - 1)"
    terms = (
        f"{z} + ({z}**3 + {z}) / (4 * {v}) + (5 * {z}**5 + 16 * {z}**3 + 3 * {z}) / (96 * {v}**2)"
        f" + (3 * {z}**7 + 19 * {z}**5 + 17 * {z}**3 - 15 * {z}) / (384 * {v}**3)"
        f" + (79 * {z}**9 + 776 * {z}**7 + 1482 * {z}**5 - 1920 * {z}**3 - 945 * {z}) / (92160 * {v}**4)"
    )
    return f"{mean} - {error} * ({terms}) as lower, {mean} + {error} * ({terms}) as upper"


def _t_two_sided(t: str, v: str) -> str:
    """P(|T| > t) by the finite series in the angle atan(t / sqrt(v)), for 1 degree of freedom or more."""
    angle = f"atan(({t}) / sqrt({v}))"
    even = f"list_sum([exp(lgamma(i + 0.5) - lgamma(i + 1.0)) / sqrt(pi()) * cos({angle}) ** (2 * i) for i in range(0, cast({v} // 2 as bigint))])"
    odd = f"coalesce(list_sum([sqrt(pi()) / 2 * exp(lgamma(i + 1.0) - lgamma(i + 1.5)) * cos({angle}) ** (2 * i + 1) for i in range(0, cast(({v} - 1) // 2 as bigint))]), 0)"
    return f"case when {v} % 2 = 0 then 1 - sin({angle}) * {even} else 1 - 2 / pi() * ({angle} + sin({angle}) * {odd}) end"


def _newton(t: str, v: str) -> str:
    """One step from t towards the 0.975 quantile."""
    density = f"exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) * (1 + {t} ** 2 / {v}) ** (-({v} + 1) / 2)"
    return f"{t} + ({_t_two_sided(t, v)} - 0.05) / (2 * {density})"


SAMPLE = """smp as (select variant, user_segment, date, has_click::int::double as has_click,
  search_latency_ms from qm)"""

BASELINE = f"""base as (
  select user_segment, total_searches, click_through_rate as p
  from ({_ctr(None, ('user_segment',))})),
traffic as (
  select user_segment, avg(n) as daily from (
    select user_segment, d, count(distinct session_id) as n from s group by all) group by all)"""


def _needed(z: float) -> str:
    return f"cast(ceil((({z + Z_POWER!r}::double) / (0.02::double / sqrt(p * (1 - p)))) ** 2) as bigint)"


def _histogram(column: str, bins: int) -> str:
    return f"""select bin, lo + (hi - lo) / {bins} * bin as bin_start,
  lo + (hi - lo) / {bins} * (bin + 1) as bin_end, coalesce(n, 0) as count
  from (select cast(unnest(range({bins})) as int) as bin)
  cross join (select min({column})::double as lo, max({column})::double as hi from prof)
  left join (
    select cast(least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) as int) as bin, count(*) as n
    from prof cross join (select min({column})::double as lo, max({column})::double as hi from prof)
    group by 1) using (bin)"""


AB = """select 'T-1' as test_id, 'ranking change' as test_name, date '1995-01-01' as start_date,
  date '2001-08-01' as end_date, metric, variant, avg(v) as value, count(*) as sample_size
  from (select 'dwell_time' as metric, variant, dwell_time as v from clk
        union all select 'time_to_click', variant, time_to_click from clk)
  where v is not null group by all"""

SESSION_COLUMNS = """session_id, user_id, start_time, end_time, session_duration, device_type,
  browser, user_segment, total_queries, total_clicks"""

LINKED = """
linked as (
  select *, lag(query_id) over w as prev_id, lag(query_text) over w as prev_text,
    lag(timestamp) over w as prev_time
  from {source} window w as (partition by session_id order by timestamp, query_id)),
near as (
  select *, case when date_diff('microsecond', prev_time, timestamp) / 1e6 <= {gap}
      and 1 - levenshtein(prev_text, query_text) / greatest(length(prev_text), length(query_text)) >= {sim}
    then prev_id end as rel
  from linked)"""

ORACLES: dict[str, str] = {
    "a_event_log": _ev("select * from log"),
    "b_result_log": _res("select * from res"),
    "s1_csv_round_trip": _ev("select * from log"),
    "s2_saved_metrics": _ev(_rollup("date", None, True)),
    "s4_named_parameters": _ev(
        """select user_segment, count(*) as clicks, avg(time_on_result_seconds) as avg_seconds
        from c where device_type = 'mobile' and click_position <= 5 group by 1"""
    ),
    "s5_insert_dataframe": _star(
        "select session_id, start_time, total_queries, session_duration from sessions"
    ),
    "s6_duplicate_keys": _res(
        "select document_id, count(*) as rows from res group by 1 having count(*) > 1"
    ),
    "s9_insert_select": _star(
        "select session_id, browser, total_clicks from sessions where device_type = 'mobile'"
    ),
    "s10_free_sql": _star(
        """select browser, count(*) as sessions, cast(sum(total_clicks) as bigint) as clicks
        from sessions where total_queries > 1 group by 1"""
    ),
    "t1_search_sessions": _star("select * from sessions"),
    "t2_search_queries": _star("select * from queries"),
    "t2_search_queries_limited": "with " + STAR + ", "
    + LINKED.format(source="facts", gap=90 * 86400, sim=0.4)
    + """ select query_id, session_id, query_text, timestamp, result_count, rel as reformulation_of,
        has_click, time_to_first_click, max_click_position from near""",
    "t3_search_results": _res(
        """select result_id, query_id, session_id, position, document_id, clicked, click_time,
        dwell_time from res"""
    ),
    "t4_daily_metrics": _star("select * from daily"),
    "p1_session_metrics": _ev(
        """select session_id, user_id, user_segment, device_type, session_start,
        session_duration_seconds, num_queries, num_clicks, num_clicks / num_queries as click_through_rate,
        case when num_clicks > 0 then satisfied / num_clicks else 0 end as satisfaction_rate,
        avg_query_length, unique_queries, reformulation_rate, avg_time_to_click,
        cast(session_start as date) as date from ses"""
    ),
    "p2_time_to_first_click": _ev("select session_id, avg_time_to_click from ses"),
    "p3_query_metrics": _ev("select * exclude (variant) from qm"),
    "p4_daily_aggregates": _ev(_rollup("date", 4, True)),
    "p4_daily_unrounded": _ev(_rollup("date", None, True)),
    "p5_segment_aggregates": _ev(_rollup("user_segment, date", 4, False)),
    "p6_quality_score": _ev(
        f"""select date, (click_through_rate / max(click_through_rate) over () * 0.3::double
        + satisfaction_rate / max(satisfaction_rate) over () * 0.4::double
        + (1 - avg_search_latency_ms / max(avg_search_latency_ms) over ()) * 0.1::double
        + (1 - avg_first_click_position / max(avg_first_click_position) over ()) * 0.1::double
        + avg_time_on_result / max(avg_time_on_result) over () * 0.1::double) * 100 as search_quality_score
        from ({_rollup("date", 4, True)})"""
    ),
    "p7_summary_statistics": _ev(
        """select count(*) as total_queries, count(distinct session_id) as unique_sessions,
        count(distinct user_id) as unique_users, avg(has_click::int) as overall_ctr,
        avg(has_satisfied_click::int) as overall_satisfaction, avg(search_latency_ms) as avg_search_latency,
        strftime(min(date), '%Y-%m-%d') as date_start, strftime(max(date), '%Y-%m-%d') as date_end from qm"""
    ),
    "e1_ctr_daily": _ev(_ctr("daily")),
    "e1_ctr_daily_segment": _ev(_ctr("daily", ("user_segment",))),
    "e1_ctr_weekly_device": _ev(_ctr("weekly", ("device_type",))),
    "e1_ctr_monthly": _ev(_ctr("monthly")),
    "e2_time_to_click_daily": _ev(_ttc("daily")),
    "e2_time_to_click_weekly_device": _ev(_ttc("weekly", ("device_type_search",))),
    "e3_session_engagement": _ev(_engagement("daily")),
    "e3_session_engagement_weekly": _ev(_engagement("weekly")),
    "e4_click_positions_daily": _ev(_positions("daily")),
    "e4_click_positions_monthly_segment": _ev(_positions("monthly", ("user_segment",))),
    "e5_result_engagement_daily": _ev(_result_types("daily")),
    "e5_result_engagement_weekly": _ev(_result_types("weekly")),
    "e6_user_segments": _ev(
        """select user_id, user_segment, total_searches, total_clicks, unique_sessions, click_through_rate,
        avg_session_duration, satisfaction_rate,
        case when click_through_rate >= 0.7 and satisfaction_rate >= 0.6 then 'highly_engaged'
          when click_through_rate >= 0.4 and satisfaction_rate >= 0.3 then 'moderately_engaged'
          when click_through_rate >= 0.1 then 'low_engaged' else 'disengaged' end as engagement_segment
        from (select user_id, user_segment, total_searches, coalesce(n, 0) as total_clicks, unique_sessions,
            coalesce(n, 0) / total_searches as click_through_rate, avg_session_duration,
            coalesce(sat, 0) as satisfaction_rate
          from (select user_id, min(user_segment) as user_segment, count(*) as total_searches,
                  count(distinct session_id) as unique_sessions from s group by 1)
          join (select user_id, avg(session_duration_seconds) as avg_session_duration from ses group by 1)
            using (user_id)
          left join (select user_id, count(*) as n, avg(is_satisfied::int) as sat from c group by 1)
            using (user_id))"""
    ),
    "e9_engagement_summary": _ev(
        """select (select count(distinct (session_id, query_index_in_session)) from c)
          / (select count(*) from s) as overall_ctr,
        (select avg(wait) from pairs) as avg_time_to_click,
        (select avg(click_position) from c) as avg_click_position,
        (select avg((click_position <= 3)::int) from c) as top_3_click_rate,
        avg(session_duration_seconds) as avg_session_duration, avg(num_queries) as avg_queries_per_session,
        avg(engagement_score) as avg_engagement_score from eng"""
    ),
    "e10_ctr_overall": _ev(
        """select *, searches_with_clicks / total_searches as click_through_rate,
        searches_with_clicks / total_searches * 100 as ctr_percentage
        from (select (select count(*) from s) as total_searches,
          count(distinct (session_id, query_index_in_session)) as searches_with_clicks from c)"""
    ),
    "e10_ctr_by_segment": _ev(_ctr(None, ("user_segment", "device_type"))),
    "e10_zero_click_rate": _ev(
        f"""select device_type, total_searches, 1 - click_through_rate as zero_click_rate
        from ({_ctr(None, ('device_type',))})"""
    ),
    "e10_time_to_first_click": _ev(
        """select avg(date_diff('microsecond', timestamp, clicked_at) / 1e6) as avg_time_to_first_click
        from s join first_click using (session_id, query_index_in_session)"""
    ),
    "r1_ndcg": _res(
        """select query_id, click_count, coalesce(case when ideal > 0 then dcg / ideal end, 0) as ndcg_10
        from shown left join unit_gain using (query_id)"""
    ),
    "r1_ndcg_dwell_gain": _res("select query_id, click_count, ndcg as ndcg_10 from dw"),
    "r2_mrr": _res("select avg(case when pos > 0 then 1 / pos else 0 end) as mrr from firsts"),
    "r3_query_success": _res("select avg(hit::int) as successful_query_rate from firsts"),
    "r4_reformulation": _r6("select * from r4"),
    "r4_reformulation_by_time": _r6("select * from r4", "row(t, query_id)"),
    "r5_satisfaction": _res(
        """select *, greatest(0, least(100, case when click_count > 0 then 50 else 20 end
          + least(25, clicks_in_top_3 * 10) + least(20, coalesce(avg_dwell_time, 0) / 2)
          - least(10, greatest(0, (click_depth - 3) * 2))
          - case when time_to_first_click is null then 5
                 else least(10, greatest(0, (time_to_first_click - 2) * 2)) end))::double as satisfaction_score
        from (select query_id, count_if(clicked) as click_count,
            count_if(clicked and position <= 3) as clicks_in_top_3,
            case when count_if(clicked) > 0 then avg(dwell_time) filter (where clicked) else 0 end as avg_dwell_time,
            coalesce(max(position) filter (where clicked), 0) as click_depth,
            min(time_to_click) filter (where clicked) as time_to_first_click
          from res group by 1)"""
    ),
    "r6_ranking_quality": _r6("select * from q6, n6, p6"),
    "r7_compare_relevance": _r6(R7, split=True),
    "r8_mrr_clicked_only": _res("select avg(1 / pos) as mrr from firsts where hit"),
    "q1_daily_metrics": _star("select * from daily_in"),
    "q1_daily_metrics_segment": _star("select * from daily_in where user_segment = 'MACHINERY'"),
    "q2_session_details": _star(
        """select s.*, q.query_id, q.query_text, q.timestamp, q.result_count, q.has_click,
        q.time_to_first_click from sessions s left join queries q using (session_id)
        where session_id = '30-1997'"""
    ),
    "q3_query_results": _res(
        """select result_id, position, document_id, clicked, click_time, dwell_time from res
        where query_id = 42"""
    ),
    "q4_user_sessions": _star(
        """select session_id, start_time, end_time, session_duration, device_type, browser,
        total_queries, total_clicks from sessions where user_id = 30
        order by start_time desc, session_id limit 5"""
    ),
    "q5_top_queries": _star(TOP_QUERIES.format(n=10)),
    "q6_reformulations": _star(
        f"""select q1.query_text as original_query, q2.query_text as reformulated_query,
        count(*) as frequency,
        case when length(q2.query_text) > length(q1.query_text) then 'expanded'
          when length(q2.query_text) < length(q1.query_text) then 'narrowed' else 'rephrased' end
          as reformulation_type
        from queries q1 join queries q2 on q1.session_id = q2.session_id
          and q2.reformulation_of = q1.query_id
        where cast(q1.timestamp as date) {IN_1997} group by q1.query_text, q2.query_text
        order by frequency desc, original_query, reformulated_query limit 10"""
    ),
    "q7_positions": _res(POSITIONS.format(join="", where=f"cast(click_time as date) {IN_1997}")),
    "q7_positions_segment": _star(
        POSITIONS.format(
            join="join sessions s on r.session_id = s.session_id",
            where=f"cast(click_time as date) {IN_1997} and s.user_segment = 'MACHINERY'",
        )
    ),
    "q7_positions_by_query_date": _res(
        POSITIONS.format(join="", where=f"cast(query_time as date) {IN_1997}")
    ),
    "q8_ab_test_values": _res(AB),
    **{
        key: f"with {RESULT_LOG}, {_rank_p('clk', ('dwell_time', 'time_to_click'))} "
        f"select a.*, p_value, significant from ({AB}) a join rp using (metric)"
        for key in ("t5_ab_test_results", "q8_ab_test_results", "d4h_ab_testing")
    },
    "q9_metric_timeseries": _star(
        "select date, user_segment, avg_ctr from daily_in where device_type = 'mobile'"
    ),
    "q10_segment_distribution": _star(DISTRIBUTION.format(by="user_segment", dates=IN_1997)),
    "q11_device_distribution": _star(DISTRIBUTION.format(by="device_type", dates=IN_1997)),
    "q12_low_satisfaction": _star(
        LOW.format(results="(select * from res where clicked)", dates=IN_1997)
    ),
    "q12_low_satisfaction_deduped": _star(
        LOW.format(
            results="(select query_id, max(position) as position from res where clicked group by 1)",
            dates=IN_1997,
        )
    ),
    "q13_zero_click": _star(
        f"""select cast(timestamp as date) as date, user_segment, count(*) as query_count,
        count_if(not has_click) as zero_click_count,
        count_if(not has_click) * 100 / count(*) as zero_click_percentage
        from queries q join sessions s on q.session_id = s.session_id
        where cast(timestamp as date) {IN_1997} group by 1, 2"""
    ),
    "q14_complexity": _star(
        f"""select case when w between 1 and 2 then '1-2 words' when w between 3 and 4 then '3-4 words'
          when w between 5 and 7 then '5-7 words' else '8+ words' end as query_length,
        count(*) as query_count, count_if(has_click) / count(*) as click_rate,
        avg(case when has_click then time_to_first_click end) as avg_time_to_click
        from (select *, length(query_text) - length(replace(query_text, ' ', '')) + 1 as w from queries
              where cast(timestamp as date) {IN_1997}) group by 1"""
    ),
    "q15_recent_activity": _star(
        """select query_id, q.session_id, query_text, timestamp, has_click, time_to_first_click,
        user_segment, device_type from queries q join sessions s on q.session_id = s.session_id
        order by timestamp desc, query_id desc limit 100"""
    ),
    "x1_confidence_interval": _ev(
        f"""select variant, mean, {_t_margin('mean', 'std_error', 'sample_size')}, std_error, sample_size
        from (select variant, avg(search_latency_ms) as mean,
          stddev_samp(search_latency_ms) / sqrt(count(search_latency_ms)) as std_error,
          count(search_latency_ms) as sample_size from qm group by 1)"""
    ),
    "x1_mean_and_error": _ev(
        """select variant, avg(search_latency_ms) as mean,
        stddev_samp(search_latency_ms) / sqrt(count(search_latency_ms)) as std_error,
        count(search_latency_ms) as sample_size from qm group by 1"""
    ),
    "x2_rank_test": f"with {EVENT_LOG}, {SAMPLE}, {_rank_p('smp', ('has_click',))} select * from rp",
    "x2_compare_arms": f"with {EVENT_LOG}, {SAMPLE}, {_comparison('smp', ('has_click',))}",
    "x3_analyze_experiment": f"with {RESULT_LOG}, {_comparison('clk', ('dwell_time', 'time_to_click'))}",
    "x4_segment_impact": f"""with {RESULT_LOG}, {_compared('clk', ('dwell_time',), 'device_type')}
        select concat('dwell_time for device_type=', seg) as metric, seg as segment, segment_size,
          segment_size / (select count(*) from clk) * 100 as segment_size_percent, control_mean, experiment_mean,
          experiment_mean - control_mean as absolute_difference,
          (experiment_mean - control_mean) / control_mean * 100 as relative_difference_percent, control_sample_size,
          experiment_sample_size, p_value, significant, test_type, cast(null as varchar) as error, ci_lower, ci_upper
        from ({_arm_means('clk', ('dwell_time',), 'device_type')}) join cmp using (metric, seg)""",
    "x2_arm_statistics": f"with {RESULT_LOG}, {_arms('clk', ('dwell_time', 'time_to_click'))}",
    "x2_arm_statistics_binary": f"with {EVENT_LOG}, {SAMPLE}, {_arms('smp', ('has_click', 'search_latency_ms'))}",
    "x3_differences": f"with {RESULT_LOG}, {_rank_p('clk', ('dwell_time', 'time_to_click'))} "
    + "select d.*, p_value, significant, test_type from ("
    + " union all ".join(
        f"""select '{m}' as metric, c as control_mean, e as experiment_mean,
        e - c as absolute_difference, (e - c) / c * 100 as relative_difference_percent,
        nc as control_sample_size, ne as experiment_sample_size
        from (select avg({m}) filter (where variant = 'control') as c,
          avg({m}) filter (where variant = 'experiment') as e,
          count({m}) filter (where variant = 'control') as nc,
          count({m}) filter (where variant = 'experiment') as ne from clk)"""
        for m in ("dwell_time", "time_to_click")
    )
    + ") d join rp using (metric)",
    "x4_segment_differences": f"with {RESULT_LOG}, {_rank_p('clk', ('dwell_time',), 'device_type')} "
    + """select d.*, p_value, significant, test_type from (select concat('dwell_time for device_type=', device_type) as metric, device_type as segment,
        count(*) as segment_size, count(*) / (select count(*) from clk) * 100 as segment_size_percent,
        avg(dwell_time) filter (where variant = 'control') as control_mean,
        avg(dwell_time) filter (where variant = 'experiment') as experiment_mean,
        avg(dwell_time) filter (where variant = 'experiment')
          - avg(dwell_time) filter (where variant = 'control') as absolute_difference,
        count(dwell_time) filter (where variant = 'control') as control_sample_size,
        count(dwell_time) filter (where variant = 'experiment') as experiment_sample_size
        from clk group by device_type) d join rp on rp.seg = d.segment""",
    "x5_timeseries_intervals": _ev(
        f"""select date, mean as search_latency_ms_mean, mean - error * t4 as search_latency_ms_lower,
        mean + error * t4 as search_latency_ms_upper, n as search_latency_ms_sample_size
        from (select *, n - 1 as v, lower as t0, {_newton('t0', 'v')} as t1, {_newton('t1', 'v')} as t2,
            {_newton('t2', 'v')} as t3, {_newton('t3', 'v')} as t4
          from (select *, {_t_margin('0', '-1', 'n')} from (
            select date, avg(search_latency_ms) as mean, count(search_latency_ms) as n,
              stddev_samp(search_latency_ms) / sqrt(count(search_latency_ms)) as error from qm group by 1)))"""
    ),
    "x5_timeseries_means": _ev(
        """select date, avg(search_latency_ms) as search_latency_ms_mean,
        count(search_latency_ms) as search_latency_ms_sample_size from qm group by 1"""
    ),
    "x6_anomalies": _ev(_anomalies(CTR_BY_DAY, "ctr", 7, 3.0)),
    "x6_anomalies_tight": _ev(_anomalies(CTR_BY_DAY, "ctr", 11, 1.5)),
    "x6_anomaly_rows": _ev(
        f"""select cast(row_index as int) as row_index, date, ctr from (
        select *, row_number() over (order by date) - 1 as row_index
        from ({_anomalies(CTR_BY_DAY, "ctr", 11, 1.5)})) where ctr_is_anomaly"""
    ),
    "x7_sample_size": f"""with {EVENT_LOG}, {BASELINE} select user_segment,
        {_needed(Z_TWO)} as required_n, {_needed(Z_ONE)} as required_n_one_sided from base""",
    "x8_test_duration": f"""with {EVENT_LOG}, {BASELINE} select user_segment,
        {_needed(Z_TWO)} * 2 / (daily * 0.5::double) as days from base join traffic using (user_segment)""",
    "x9_detectable_effect": f"""with {EVENT_LOG}, {BASELINE} select user_segment,
        {Z_TWO + Z_POWER!r}::double * sqrt(p * (1 - p) * (2 / total_searches)) as mde from base""",
    "x10_trend_fit": _ev(
        f"""select count(*) as n, regr_slope(ctr, row_index) as slope,
        regr_intercept(ctr, row_index) as intercept, regr_r2(ctr, row_index) as strength,
        case when regr_slope(ctr, row_index) > 0 then 'Upward' else 'Downward' end as direction
        from ({TREND})"""
    ),
    "x10_trend": _ev(
        f"""select n, slope, intercept, strength, direction, {_t_two_sided('sqrt(strength * v / (1 - strength))', 'v')} as p_value
        from (select *, n - 2 as v from (
          select count(*) as n, regr_slope(ctr, row_index) as slope,
            regr_intercept(ctr, row_index) as intercept, regr_r2(ctr, row_index) as strength,
            case when regr_slope(ctr, row_index) > 0 then 'Upward' else 'Downward' end as direction
          from ({TREND})))"""
    ),
    "x10_trend_line": _ev(
        f"""select date, ctr, cast(row_index as int) as row_index, i + m * row_index as fitted
        from ({TREND}) cross join (select regr_slope(ctr, row_index) as m,
          regr_intercept(ctr, row_index) as i from ({TREND}))"""
    ),
    "d1_overview_kpis": _star(
        """select avg(avg_ctr) as ctr, avg(zero_click_rate) as zero_click_rate,
        avg(avg_time_to_first_click) as time_to_click, avg(avg_queries_per_session) - 1 as reformulation_rate
        from daily_in"""
    ),
    "d2_mean_ndcg": _star("select avg(avg_ndcg) as ndcg from daily_in"),
    "d3_ctr_anomalies": _star(
        _anomalies(
            "select date, sum(avg_ctr * total_queries) / sum(total_queries) as ctr from daily_in group by 1",
            "ctr", 7, 3.0,
        )
    ),
    "d3_ctr_anomalies_raw_rows": _star(
        _anomalies(
            "select date, user_segment, device_type, avg_ctr as ctr from daily_in", "ctr", 7, 3.0,
            "date, user_segment, device_type",
        )
    ),
    "d4a_overview_devices": _star(DISTRIBUTION.format(by="device_type", dates=IN_1997)),
    "d4b_query_analysis_top": _star(TOP_QUERIES.format(n=20)),
    "d4c_user_engagement_positions": _res(
        POSITIONS.format(join="", where=f"cast(click_time as date) {IN_1997}")
    ),
    "d4d_ndcg_trend": _star(
        """select date, user_segment, device_type, avg_ndcg, cast(row_index as int) as row_index,
        i + m * row_index as fitted
        from (select *, regr_slope(avg_ndcg, row_index) over () as m,
                regr_intercept(avg_ndcg, row_index) over () as i
              from (select *, row_number() over (order by date, user_segment, device_type) - 1 as row_index
                    from daily_in))"""
    ),
    "d4e_sessions": _star("select date, user_segment, device_type, total_sessions from daily_in"),
    "d4f_segments": _star(DISTRIBUTION.format(by="user_segment", dates=IN_1997)),
    "d4g_ctr": _star(
        _anomalies(
            "select date, sum(avg_ctr * total_queries) / sum(total_queries) as ctr from daily_in group by 1",
            "ctr", 7, 3.0,
        )
    ),
    "d5_session_profiles": _star("select * from prof"),
    "d5_success_rate": _star(
        "select count(*) as session_count, avg(success::int) as success_rate from prof"
    ),
    "d5_success_by_device": _star(
        """select device_type, count(*) as session_count, avg(success::int) as success_rate
        from prof group by 1"""
    ),
    "d6_top_texts": f"""with {QUERY_LOG} select query_text, count(*) as count from qlog group by 1
        order by count desc, query_text limit 15""",
    "d7_histogram_queries": _star(_histogram("num_queries", 10)),
    "d7_histogram_clicks": _star(_histogram("num_clicks", 10)),
    "d7_histogram_duration": _star(_histogram("duration", 20)),
    "c2_sessionize": _ev(
        """select event_id, user_id, cast(sum(starts) over (partition by user_id order by timestamp, event_id)
          as bigint) as session_number
        from (select *, case when date_diff('microsecond', lag(timestamp) over (
                partition by user_id order by timestamp, event_id), timestamp) / 1e6 > 21600
              then 1 else 0 end as starts from log)"""
    ),
    "c3_session_length": f"""with {QUERY_LOG} select query_id, session_id, user_id, query_text, timestamp
        from (select *, count(*) over (partition by session_id) as n,
          row_number() over (partition by session_id order by timestamp, query_id) as nth from qlog)
        where n >= 2 and nth <= 3""",
    "c4_ctr_click_timeout": _ev(
        _ctr(
            "daily",
            clicks="""(select c.* from c join s using (session_id, query_index_in_session)
              where date_diff('microsecond', s.timestamp, c.timestamp) / 1e6 <= 14400)""",
        )
    ),
    "c1_sample_sessions": _ev(
        "select * from log where cast('0x' || left(md5(session_id), 8) as bigint) < 2147483648"
    ),
    "c5_time_to_click_capped": _ev(
        _ttc(
            "daily", (), None,
            """(select p.* from pairs p join (select d, quantile_cont(wait, 0.95) as bar from pairs
                where wait <= 129600 group by 1) b using (d) where wait <= 129600 and wait <= bar)""",
        )
    ),
    "c6_ndcg_at": _res(
        "select query_id, click_count, "
        + ", ".join(
            f"coalesce(case when ideal_{k} > 0 then dcg_{k} / ideal_{k} end, 0) as ndcg_{k}"
            for k in (3, 5, 10)
        )
        + " from shown left join dwell_gain using (query_id)"
    ),
    "c7_precision_at": _res(
        "select "
        + ", ".join(
            f"(select count(*) from res where clicked and position <= {k}) / {k} "
            f"/ (select count(*) from shown) as precision_{k}"
            for k in (3, 5, 10)
        )
    ),
    "c8_map": _res(
        """select avg(coalesce(ap, 0)) as map_10 from shown left join (
          select query_id, avg(nth / position) as ap from (
            select query_id, position, row_number() over (partition by query_id order by position) as nth
            from res where clicked and position <= 10) group by 1) using (query_id)"""
    ),
    "c9_follow_up_rate": f"with {QUERY_LOG}, "
    + LINKED.format(source="qlog", gap=120 * 86400, sim=0.4)
    + """ select count(*) as total_queries, count(rel) as refined_queries,
        count(rel) / count(*) as reformulation_rate from near""",
    "c10_query_diversity": f"""with {QUERY_LOG} select cast(sum(n) as bigint) as total_queries,
        count(*) as unique_queries, count(*) / sum(n) as diversity,
        sum(case when n > 1 then n else 0 end) / sum(n) as repeated_share
        from (select query_text, count(*) as n from qlog group by 1)""",
    "c11_ctr_hourly": _ev(_ctr("hour")),
    "c11_ctr_week_start": _ev(_ctr("week")),
    "c12_user_type": _ev(
        """select case when session_id = first_id then 'new' else 'returning' end as user_type,
        count(*) as session_count, avg(num_queries) as avg_queries, avg(num_clicks) as avg_clicks
        from (select *, first_value(session_id) over (
          partition by user_id order by session_start, session_id) as first_id from ses) group by 1"""
    ),
    "c12_time_of_day": "with "
    + EVENT_LOG
    + """, tod as (select *, case when hour(timestamp) < 6 then 'night' when hour(timestamp) < 12 then 'morning'
        when hour(timestamp) < 18 then 'afternoon' else 'evening' end as time_of_day from log) """
    + _ctr(None, ("time_of_day",)).replace("from s group", "from tod where event_type = 'search' group").replace(
        "from c c group", "from tod where event_type = 'click' group"
    ),
    "c12_location": "with "
    + EVENT_LOG
    + """, loc as (select log.*, n_name as location from log join customer on c_custkey = user_id
        left join nation on n_nationkey = c_nationkey) """
    + _ctr(None, ("location",)).replace("from s group", "from loc where event_type = 'search' group").replace(
        "from c c group", "from loc where event_type = 'click' group"
    ),
    "c13_ndcg_distribution": _res(
        """select ndcg_range, count(*) as query_count, count(*) / sum(count(*)) over () as share
        from (select case when ndcg < 0.2 then '0.0-0.2' when ndcg < 0.4 then '0.2-0.4'
            when ndcg < 0.6 then '0.4-0.6' when ndcg < 0.8 then '0.6-0.8' when ndcg < 0.9 then '0.8-0.9'
            else '0.9-1.0' end as ndcg_range from dw where click_count > 0) group by 1"""
    ),
}
ORACLES["d8_filtered_ctr"] = (
    "with "
    + EVENT_LOG
    + """, cls as (""" + ORACLES["e6_user_segments"].split(EVENT_LOG, 1)[1].strip() + """),
    kind as (select session_id, session_id = first_value(session_id) over (
        partition by user_id order by t, session_id) as fresh
      from (select user_id, session_id, min(timestamp) as t from log group by all)),
    kept as (select log.* from log join kind using (session_id)
      join (select user_id from cls where engagement_segment = 'moderately_engaged') using (user_id)
      where cast(timestamp as date) between date '2024-01-05' and date '2024-01-25'
        and device_type = 'mobile' and not fresh and hour(timestamp) between 12 and 17) """
    + _ctr(None, ("user_segment",)).replace("from s group", "from kept where event_type = 'search' group").replace(
        "from c c group", "from kept where event_type = 'click' group"
    )
)

# Layout of the supplied tables the SQL reads, to find which result columns are doubles.
TABLES = """
create table events (event_id bigint, ts timestamp, user_id bigint, event_type varchar, value double, props varchar);
create table part (p_partkey bigint, p_name varchar, p_brand varchar, p_type varchar, p_size int, p_retailprice double);
create table orders (o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double, o_orderdate timestamp, o_orderpriority varchar);
create table lineitem (l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag varchar, l_linestatus varchar, l_shipdate timestamp);
create table customer (c_custkey bigint, c_name varchar, c_nationkey int, c_acctbal double, c_mktsegment varchar);
create table nation (n_nationkey int, n_name varchar, n_regionkey int);
"""


# Reports over tables stored by month, and the daily table of merged states, give the rows of the plain ones.
# Logs without ids of events: the same rows, users as text.
for _key in ("p1_session_metrics", "e6_user_segments"):
    ORACLES[f"{_key}_plain_log"] = f"select * replace (concat('user_', user_id) as user_id) from ({ORACLES[_key]})"

# A result of a nested log is known by its document: it is clicked if the query has a click on that document.
ORACLES["t3_results_of_nested_log"] = _res(
    """select result_id, query_id, session_id, position, document_id, clicks is not null as clicked, first_click as click_time
    from res left join (
      select query_id, document_id, count(*) as clicks, arg_min(click_time, position) as first_click
      from res where clicked group by all) using (query_id, document_id)"""
)
ORACLES["d5_flat_nested_log"] = _star(
    """select session_id, user_id, query_id, query_text, timestamp, device_type, location,
      coalesce(results, 0) as result_count, coalesce(click_count, 0)::bigint as click_count
    from qlog left join shown using (query_id) left join usr using (user_id)"""
)
ORACLES["d5_profiles_of_nested_log"] = ORACLES["d5_session_profiles"]

for _stored, _plain in {
    "q5_top_queries_by_month": "q5_top_queries",
    "q6_reformulations_by_month": "q6_reformulations",
    "q7_positions_by_month": "q7_positions",
    "q7_positions_by_query_month": "q7_positions_by_query_date",
    "q12_low_satisfaction_by_month": "q12_low_satisfaction",
    "q15_recent_activity_by_month": "q15_recent_activity",
    "t4_daily_metrics_merged": "t4_daily_metrics",
}.items():
    ORACLES[_stored] = ORACLES[_plain]


def rounded() -> dict[str, str]:
    """The SQL with double columns rounded, as ``queries.comparable`` does."""
    import duckdb

    empty = duckdb.connect()
    empty.execute(TABLES)

    def shown(name: str, kind: str) -> str:
        if kind != "DOUBLE":
            return f'"{name}"'
        value = f'"{name}" * {NUDGE!r}::double'
        return f'case when abs({value}) < 1e6 then round({value}, 6) else round({value}, 2) end as "{name}"'

    texts = {}
    for key, text in ORACLES.items():
        columns = empty.execute(f"describe {text}").fetchall()
        picked = ", ".join(shown(name, kind) for name, kind, *_ in columns)
        texts[key] = f"select {picked} from ({text})"
    return texts
