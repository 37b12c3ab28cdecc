"""SQL twins of the registered queries, over the same tables."""

from __future__ import annotations

import math

from hostpulse.adapters import FOREST, FOREST_CUT, LIMITS, SVM_OFFSET
from hostpulse.config import FEATURES, SWEEP

# The markers of non-human user agents, written out here so that a change in the engine shows.
_MARKERS = (
    r"bot|crawler|spider|scraper|python|curl|wget|java/|go-http|httpclient|libwww|ahrefsbot|semrushbot|mj12bot|baiduspider|yandexbot"
    r"|googlebot|bingbot|scrapy|facebookexternalhit|archive\.org_bot"
)
_KEYS = "ts, host, method, resource, status"

RAW = """
first_delivery as (
  select event_type as kind, event_id as _row_id, 'a.csv' as _source_file,
    case when event_id % 211 = 0 then '' when user_id % 7 = 0 then ' 10.0.0.' || user_id || ' '
         else '10.0.0.' || user_id end as host,
    case when event_id % 101 = 0 then '32/Foo/2024 00:00:00' else strftime(ts, '%d/%b/%Y %H:%M:%S') end as datetime,
    case when event_type = 'signup' then 'post' else ' get' end as method,
    case when user_id = 3 then '/index' else '/' || event_type || '/' || json_extract_string(props, '$.k') end as resource,
    'HTTP/1.1' as protocol,
    case when event_id % 307 = 0 then '999'
         when event_type = 'error' then case when user_id % 5 = 0 then '404' when user_id % 2 = 0 then '500' else '403' end
         else '200' end as status,
    case when event_id % 10 = 0 then '-' when event_id % 53 = 0 then ''
         else cast(cast(floor(value * 100) as bigint) as varchar) end as bytes,
    cast(null as varchar) as referrer,
    case when user_id % 20 = 1 then 'Googlebot/2.1' when event_id % 97 = 0 then null
         when event_id % 2 = 0 then 'Mozilla/5.0 (X11)' else 'Mozilla/5.0 (Mac)' end as user_agent
  from events),
raw as (
  select * from first_delivery
  union all
  select * replace ('7' as bytes, 'b.csv' as _source_file) from first_delivery where kind = 'purchase')"""

TYPED = f"""{RAW},
typed as (
  select _row_id, _source_file, datetime, protocol, referrer,
    try_strptime(trim(datetime), '%d/%b/%Y %H:%M:%S') as ts,
    trim(host) as host, upper(trim(method)) as method, trim(resource) as resource, trim(user_agent) as user_agent,
    case when regexp_full_match(trim(status), '[+-]?[0-9]+') then try_cast(trim(status) as smallint) end as status,
    coalesce(case when regexp_full_match(trim(bytes), '[+-]?[0-9]+') then try_cast(trim(bytes) as bigint) end, 0) as bytes,
    cast(coalesce(regexp_matches(user_agent, '(?i)({_MARKERS})'), false) as tinyint) as is_bot_ua
  from raw),
valid as (select * from typed where ts is not null and length(host) > 0 and status between 100 and 599)"""

CLEAN = f"""{TYPED},
clean as (
  select * from valid qualify row_number() over (partition by {_KEYS} order by _source_file, _row_id) = 1)"""


def _features(seconds: int) -> str:
    return f"""{CLEAN},
features as (
  select host, time_bucket(interval '{seconds} seconds', ts) as window_start,
    count(*) as req_count,
    count(distinct resource) + max(case when resource is null then 1 else 0 end) as unique_urls,
    count(distinct user_agent) + max(case when user_agent is null then 1 else 0 end) as unique_ua,
    avg(case when status between 400 and 499 then 1.0 else 0.0 end) as error_4xx_rate,
    avg(case when status between 500 and 599 then 1.0 else 0.0 end) as error_5xx_rate,
    avg(bytes) as avg_bytes, cast(sum(bytes) as bigint) as total_bytes,
    coalesce(stddev_samp(bytes), 0) as bytes_std, avg(is_bot_ua) as bot_ua_rate
  from clean group by all)"""


DAY = _features(86400)

SCORED = f"""{DAY},
with_score as (
  select *, -least(1.0, cast(0.3 as double) + cast(0.02 as double) * req_count + cast(0.3 as double) * error_4xx_rate
    + cast(0.05 as double) * unique_ua) as anomaly_score_if from features),
with_labels as (
  select *, cast(case when anomaly_score_if < -0.6 then -1 else 1 end as tinyint) as label_if,
    cast(case when total_bytes > 60000 or (req_count >= 4 and error_5xx_rate >= 0.5) or (req_count >= 4 and unique_urls = 1)
      or (bot_ua_rate > 0 and req_count >= 5) then -1 else 1 end as tinyint) as label_secondary,
    greatest(0, least(100, -100 * anomaly_score_if)) as risk_score_100 from with_score),
labelled as (
  select *, cast(case when label_if = -1 or label_secondary = -1 then -1 else 1 end as tinyint) as label_combined
  from with_labels)"""


def _limit(column: str, factor: str = "", cap: bool = False) -> str:
    value = (
        f"case when quantile_cont({column}::double, 0.999) = 0 "
        f"then round_even(coalesce(min(case when {column} > 0 then {column} end), 0.01)::double * 0.5, 4) "
        f"else round_even(quantile_cont({column}::double, 0.999) * 1.25::double{factor}, 4) end"
    )
    return f"least({value}, 0.9)" if cap else value


CLASSIFIED = f"""{SCORED},
limits as (
  select {_limit('bot_ua_rate', cap=True)} as bot_ua_rate, {_limit('error_4xx_rate', cap=True)} as error_4xx_rate,
    {_limit('req_count')} as req_count_ddos, {_limit('unique_urls')} as unique_urls_scraper,
    {_limit('req_count', ' * 0.6::double')} as req_count_highvol
  from labelled where label_combined = 1),
scored as (
  select l.*, case when label_combined <> -1 then 'normal'
    when l.bot_ua_rate > t.bot_ua_rate then 'bot / crawler'
    when l.error_4xx_rate > t.error_4xx_rate then 'vulnerability scan / dir-brute'
    when req_count > req_count_ddos and unique_urls / greatest(req_count, 1) < 0.05 then 'DDoS / flood (single endpoint)'
    when unique_urls > unique_urls_scraper or unique_urls / greatest(req_count, 1) > 0.6 then 'web scraper (content theft)'
    when req_count > req_count_highvol then 'high-volume anomaly'
    else 'low-volume anomaly (needs manual review)' end as anomaly_type
  from labelled l, limits t)"""

_ROUNDED = ", ".join(
    f"round({c}, 6) as {c}" if c in ("error_4xx_rate", "error_5xx_rate", "avg_bytes", "bytes_std", "bot_ua_rate") else c
    for c in FEATURES
)
_Z_COLUMNS = [f"z_{c}" for c in FEATURES]
STANDARDISED = f"""{DAY},
moments as (select {", ".join(f"avg({c}::double) as m_{c}, case when stddev_pop({c}::double) = 0 then 1 else stddev_pop({c}::double) end as s_{c}" for c in FEATURES)} from features),
z as (select host, window_start, {", ".join(f"({c} - m_{c}) / s_{c} as z_{c}" for c in FEATURES)} from features, moments)"""

_SQUARED = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _Z_COLUMNS)
DBSCAN = f"""{STANDARDISED},
points as (select {", ".join(_Z_COLUMNS)}, count(*) as weight, row_number() over () as id from z group by {", ".join(_Z_COLUMNS)}),
near as materialized (select a.id, b.id as other, b.weight from points a, points b where {_SQUARED} <= 0.8::double * 0.8::double),
core as materialized (select id from near group by id having sum(weight) >= 5),
reached as (select distinct id from near where other in (select id from core))"""


def _percent_of(table: str, where: str = "") -> str:
    return f"(select count(*) from {table} {where})"


def _day_scored(select: str, source: str = CLASSIFIED) -> str:
    return f"with {source} {select}"


_SCORED_COLUMNS = (
    f"host, window_start, {_ROUNDED}, round(anomaly_score_if, 6) as anomaly_score_if, "
    "round(risk_score_100, 6) as risk_score_100, label_if, label_secondary, label_combined, anomaly_type"
)
ORACLES: dict[str, str] = {
    "typed_log": f"""with {TYPED} select ts, host, method, resource, protocol, status, bytes, referrer, user_agent, is_bot_ua,
        datetime, _source_file from typed""",
    "clean_log": f"""with {CLEAN} select ts, host, method, resource, protocol, status, bytes, referrer, user_agent, is_bot_ua,
        datetime, _source_file from clean""",
    "cleaning_counters": f"""with {CLEAN} select count(*) as rows_in, count(*) - (select count(*) from valid) as dropped_invalid,
        (select count(*) from valid) - (select count(*) from clean) as dropped_duplicates,
        (select count(*) from clean) as kept from typed""",
    "rows_per_file": f"with {RAW} select _source_file, count(*) as rows from raw group by all",
    **{
        name: f"with {_features(seconds)} select host, window_start, {_ROUNDED} from features"
        for name, seconds in (("features_60s", 60), ("features_1h", 3600), ("features_1d", 86400))
    },
    "eda_overview": f"""with {CLEAN} select count(*) as records,
        count(distinct host) + max(case when host is null then 1 else 0 end) as hosts,
        count(distinct user_agent) + max(case when user_agent is null then 1 else 0 end) as user_agents,
        min(ts) as first_ts, max(ts) as last_ts, cast(sum(is_bot_ua) as bigint) as bot_requests,
        round_even(avg(is_bot_ua) * 100, 1) as bot_pct from clean""",
    "eda_status_distribution": f"""with {CLEAN} select status, count(*) as count,
        round_even(count(*) / {_percent_of('clean')} * 100, 1) as pct from clean group by status""",
    "eda_top_hosts": f"""with {CLEAN} select host, count(*) as n, round_even(count(*) / {_percent_of('clean')} * 100, 1) as pct
        from clean group by host order by n desc, host limit 10""",
    "eda_top_user_agents": f"""with {CLEAN} select user_agent, count(*) as n,
        round_even(count(*) / {_percent_of('clean')} * 100, 1) as pct, substring(coalesce(user_agent, ''), 1, 55) as shown
        from clean group by user_agent order by n desc, user_agent nulls last limit 10""",
    "eda_top_resources": f"""with {CLEAN} select resource, count(*) as n, substring(coalesce(resource, ''), 1, 52) as shown
        from clean group by resource order by n desc, resource nulls last limit 10""",
    "eda_hourly_load": f"""with {CLEAN}, hours as (select cast(hour(ts) as integer) as hour, count(*) as count from clean group by 1)
        select hour, count, cast(floor(count / (select max(count) from hours) * 30) as integer) as bar_len,
        count > 4 * (select median(count) from hours) as is_hot from hours""",
    "scaler": f"with {STANDARDISED} select feature, mean, std from ("
    + " union all ".join(f"select '{c}' as feature, round(m_{c}, 6) as mean, round(s_{c}, 6) as std from moments" for c in FEATURES)
    + ")",
    "standardised_features": f"with {STANDARDISED} select host, window_start, "
    + ", ".join(f"round({c}, 6) as {c}" for c in _Z_COLUMNS) + " from z",
    "standardised_embeddings": "with x as (select vec_id, "
    + ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(64)) + " from embeddings) select vec_id, "
    + ", ".join(f"round((e{i} - (select avg(e{i}) from x)) / (select stddev_pop(e{i}) from x), 6) as z_e{i}" for i in range(64))
    + " from x",
    "normal_percentiles": f"with {SCORED} " + " union all ".join(
        f"""select '{c}' as feature, {", ".join(f"round(quantile_cont({c}::double, {q}), 6) as {n}" for q, n in
        ((0.5, 'p50'), (0.9, 'p90'), (0.99, 'p99'), (0.999, 'p99_9')))} from labelled where label_combined = 1"""
        for c in ("req_count", "unique_urls", "error_4xx_rate", "bot_ua_rate")
    ),
    "thresholds": f"with {CLASSIFIED} select * from limits",
    "thresholds_by_counting": f"with {CLASSIFIED} select * from limits",
    "union_vs_intersection": _day_scored(
        """, c as (select count(*) as n, count(*) filter (label_if = -1 and label_secondary = 1) as only_if,
        count(*) filter (label_secondary = -1 and label_if = 1) as only_secondary,
        count(*) filter (label_if = -1 and label_secondary = -1) as intersection,
        count(*) filter (label_if = -1 or label_secondary = -1) as "union" from labelled)
        select *, round(only_if / n * 100, 6) as only_if_pct, round(only_secondary / n * 100, 6) as only_secondary_pct,
        round(intersection / n * 100, 6) as intersection_pct, round("union" / n * 100, 6) as union_pct,
        round(only_secondary / greatest("union", 1) * 100, 6) as lost_by_intersection_pct from c""", SCORED),
    "threat_types": _day_scored(f"select {_SCORED_COLUMNS} from scored"),
    "report_overview": _day_scored("""select count(*) as total, count(*) filter (label_combined <> -1) as normal,
        count(*) filter (label_combined = -1) as anomalous,
        round_even(count(*) filter (label_combined <> -1) / count(*) * 100, 1) as normal_pct,
        round_even(count(*) filter (label_combined = -1) / count(*) * 100, 1) as anomalous_pct from scored"""),
    "report_score_range": _day_scored("""select label_combined, round(min(anomaly_score_if), 6) as min_score,
        round(max(anomaly_score_if), 6) as max_score, round(avg(anomaly_score_if), 6) as mean_score
        from scored group by label_combined"""),
    "report_type_distribution": _day_scored(f"""select anomaly_type, count(*) as count,
        round_even(count(*) / {_percent_of('scored', 'where label_combined = -1')} * 100, 1) as pct
        from scored where label_combined = -1 group by anomaly_type"""),
    "report_top_hosts": _day_scored("""select host, count(*) as anom_windows, round(max(risk_score_100), 6) as max_risk,
        cast(sum(req_count) as bigint) as total_reqs, arg_min(anomaly_type, window_start) as type
        from scored where label_combined = -1 group by host order by round(max(risk_score_100), 6) desc, host limit 15"""),
    "report_features_by_type": _day_scored("""select anomaly_type, round_even(avg(req_count), 1) as avg_req,
        round_even(avg(unique_urls), 1) as avg_urls, round_even(avg(error_4xx_rate), 3) as avg_4xx,
        round_even(avg(bot_ua_rate), 3) as avg_bot from scored where label_combined = -1 group by anomaly_type"""),
    "dbscan_noise": f"""with {DBSCAN} select z.host, z.window_start,
        cast(case when reached.id is null then -1 else 1 end as tinyint) as label_secondary
        from z join points using ({", ".join(_Z_COLUMNS)}) left join reached using (id)""",
}
_REPORT = f"""select host, window_start, {_ROUNDED.replace('round(bytes_std, 6) as bytes_std, ', '')},
    round(anomaly_score_if, 6) as anomaly_score_if, round(risk_score_100, 6) as risk_score_100, label_if, label_secondary,
    anomaly_type from scored where label_combined = -1"""
ORACLES["anomaly_report"] = _day_scored(_REPORT)
ORACLES["anomaly_report_csv"] = _day_scored(_REPORT)
_FILE = "case when kind = 'signup' and _row_id % 2 = 1 then 'western' else kind end"
_REFERRER = """case kind when 'error' then 'żółw' when 'signup' then case when _row_id % 2 = 0 then 'é' || chr(129) else '“naïve” – œuvre' end
    when 'purchase' then 'first line' || chr(10) || '"second"; line' end as referrer"""
ORACLES["ingest_mixed_dialects"] = f"""with {RAW} select nullif(host, '') as host, datetime, method, resource, protocol, status,
    nullif(bytes, '') as bytes, {_REFERRER}, user_agent, {_FILE} as _source_file from raw"""
ORACLES["rejected_files"] = f"""with {RAW} select 'no header of 9 fields' as reason, count(*) as rows from raw where kind = 'click'"""
ORACLES["csv_dialects"] = f"""with {RAW}
    select case kind when 'error' then ',' when 'purchase' then ';' when 'signup' then '|' else chr(9) end as separator,
      case kind when 'error' then 'windows-1250' when 'signup' then case when _row_id % 2 = 0 then 'latin-1' else 'cp1252' end
        when 'view' then 'utf-8-sig' else 'utf-8' end as encoding,
      kind = 'purchase' as multi_line, sum(case when kind = 'purchase' then 2 else 1 end)::bigint as lines from raw group by all"""
_E = [f"e{i}" for i in range(64)]
ORACLES["dbscan_clusters"] = f"""with recursive
    x as (select vec_id, {", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(64))} from embeddings),
    z as (select vec_id, {", ".join(f"({c} - (select avg({c}) from x)) / (select stddev_pop({c}) from x) as {c}" for c in _E)} from x),
    near as materialized (select a.vec_id as id, b.vec_id as other from z a, z b
      where {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _E)} <= 9.4::double * 9.4::double),
    core as materialized (select id from near group by id having count(*) >= 5),
    edge as materialized (select id, other from near where id in (select id from core) and other in (select id from core)),
    reach(id, other) as (select id, other from edge union select r.id, e.other from reach r join edge e on r.other = e.id),
    label as (select id, min(other) as cluster from reach group by id)
    select x.vec_id, coalesce(min(label.cluster), -1) as cluster
    from x join near on near.id = x.vec_id left join label on label.id = near.other group by x.vec_id"""

_SVM_TERMS = [f"z_{c} * {-(1 + i) / 8}::double" for i, c in enumerate(sorted(FEATURES))]
_SVM = f"""{STANDARDISED},
totals as (select *, {" + ".join(_SVM_TERMS)} as total, {" + ".join(f"abs({t})" for t in _SVM_TERMS)} as terms from z),
cut as (select total as rho from totals order by total limit 1 offset (select cast(floor(0.05::double * count(*)) as bigint) from totals)),
sided as (select *, total - rho as margin, total - rho < -1e-9::double * (terms + abs(rho)) as below from totals, cut)"""
ORACLES["svm_given_labels"] = f"with {_SVM} select host, window_start, cast(case when below then -1 else 1 end as tinyint) as label_secondary from sided"
_SQUARE = sum(((1 + i) / 8) ** 2 for i in range(len(FEATURES)))
ORACLES["svm_given_certificate"] = f"""with {_SVM}, one as (
    select count(*) as n, {_SQUARE / 2}::double - any_value(rho) + avg(greatest(0, -margin)) / 0.05::double as objective,
      avg(case when below then 1.0 else 0.0 end) as share_below from sided)
    select n, round(objective, 6) as objective, round({-_SQUARE / 2}::double, 6) as dual, round(objective + {_SQUARE / 2}::double, 6) as gap,
      round(share_below, 6) as share_below from one"""


def _path(n: int) -> float:
    """Mean path of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def _tree(tree: int, node: int = 0, depth: int = 0) -> str:
    """Path length in one of the given trees, as a CASE."""
    column, threshold, n = next(row[2:] for row in FOREST if row[:2] == (tree, node))
    if column is None:
        return f"{depth + _path(n)!r}::double"
    return f"case when {column} <= {threshold}::double then {_tree(tree, 2 * node + 1, depth + 1)} else {_tree(tree, 2 * node + 2, depth + 1)} end"


_GIVEN_SCORE = f"-pow(2, -(({' + '.join(_tree(t) for t in range(3))}) / 3) / {_path(256)!r}::double)"
ORACLES["forest_given_scores"] = f"with {STANDARDISED} select host, window_start, round({_GIVEN_SCORE}, 6) as score from z"
ORACLES["isolation_forest_shape"] = f"""with {_features(60)} select cast(tree as int) as tree,
    least(256, (select count(*) from features)) as leaf_rows, 1 as leaves_over_splits from range(200) t(tree)"""
_GIVEN_LIMITS = {k: f"{v}::double" for k, v in LIMITS.items()}
ORACLES["scored_with_given_models"] = f"""with {STANDARDISED},
given as (select host, window_start, {_GIVEN_SCORE} as score, {" + ".join(_SVM_TERMS)} as total, {" + ".join(f"abs({t})" for t in _SVM_TERMS)} as terms from z),
labelled as (select f.*, cast(score as float)::double as anomaly_score_if, cast(greatest(0, least(100, -100 * score)) as float)::double as risk_score_100,
    cast(case when score < {FOREST_CUT}::double then -1 else 1 end as tinyint) as label_if,
    cast(case when total - {SVM_OFFSET}::double < -1e-9::double * (terms + {abs(SVM_OFFSET)}::double) then -1 else 1 end as tinyint) as label_secondary
    from features f join given using (host, window_start)),
united as (select *, cast(case when label_if = -1 or label_secondary = -1 then -1 else 1 end as tinyint) as label_combined from labelled)
select {_SCORED_COLUMNS.replace('anomaly_type', '')} case when label_combined <> -1 then 'normal'
    when bot_ua_rate > {_GIVEN_LIMITS['bot_ua_rate']} then 'bot / crawler'
    when error_4xx_rate > {_GIVEN_LIMITS['error_4xx_rate']} then 'vulnerability scan / dir-brute'
    when req_count > {_GIVEN_LIMITS['req_count_ddos']} and unique_urls / greatest(req_count, 1) < 0.05 then 'DDoS / flood (single endpoint)'
    when unique_urls > {_GIVEN_LIMITS['unique_urls_scraper']} or unique_urls / greatest(req_count, 1) > 0.6 then 'web scraper (content theft)'
    when req_count > {_GIVEN_LIMITS['req_count_highvol']} then 'high-volume anomaly'
    else 'low-volume anomaly (needs manual review)' end as anomaly_type from united"""


def _swept(c: float) -> str:
    return f"""select {c}::double as contamination, count(*) as n, count_if(a) as n_if, count_if(b) as n_svm, count_if(a or b) as n_union,
    count_if(a and b) as n_intersection from (select s.anomaly_score_if < (select quantile_cont(anomaly_score_if, {c}::double) from scores) as a,
      total - rho < -1e-9::double * (terms + abs(rho)) as b from scores s join totals using (host, window_start),
      (select total as rho from totals order by total limit 1 offset (select cast(floor({c}::double * count(*)) as bigint) from totals)))"""


ORACLES["sensitivity_given"] = f"""with {SCORED},
moments as (select {", ".join(f"avg({c}::double) as m_{c}, case when stddev_pop({c}::double) = 0 then 1 else stddev_pop({c}::double) end as s_{c}" for c in FEATURES)} from features),
z as (select host, window_start, {", ".join(f"({c} - m_{c}) / s_{c} as z_{c}" for c in FEATURES)} from features, moments),
totals as (select *, {" + ".join(_SVM_TERMS)} as total, {" + ".join(f"abs({t})" for t in _SVM_TERMS)} as terms from z),
scores as (select host, window_start, anomaly_score_if from with_score),
swept as ({" union all ".join(_swept(c) for c in SWEEP)})
select round(contamination, 6) as contamination, n_if, round(n_if / n * 100, 6) as if_pct, n_svm, round(n_svm / n * 100, 6) as svm_pct, n_union,
    round(n_union / n * 100, 6) as union_pct, n_intersection from swept"""
ORACLES["heavy_resources"] = f"with {CLEAN} select resource, count(*) as n from clean group by resource order by n desc, resource nulls last limit 10"
ORACLES["heavy_stamps"] = f"""with {CLEAN} select concat_ws(' ', user_agent, strftime(ts, '%Y-%m-%d %H:%M:%S')) as pair, count(*) as n
    from clean group by pair order by n desc, pair limit 10"""
ORACLES["incremental_clean"] = ORACLES["clean_log"]
ORACLES["incremental_features"] = ORACLES["features_1d"]
ORACLES["distinct_roll_up"] = f"""with {CLEAN} select strftime(ts, '%Y-%m-%d') as day, count(*) as requests,
    count(distinct resource) + max(case when resource is null then 1 else 0 end) as resources, true as near from clean group by 1"""
