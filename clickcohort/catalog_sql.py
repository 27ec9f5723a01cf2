"""The catalog's queries in SQL, written independently of the Spark plans.

Every statement runs on the driver's tables in DuckDB. Shapes differ on purpose:
plain ``count(DISTINCT ...)``, row windows and self joins instead of counted values.
"""

from __future__ import annotations

from clickcohort.adapters import AGENTS

ORACLES: dict[str, str] = {}

# Fixed values, written out here so that a wrong constant in the package shows.
JOB_DATE = "2024-01-31"
STATS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
HOUR_COLUMNS = tuple(f"hourly_hist_{h:02d}" for h in range(24))


def r6(expr: str, name: str | None = None) -> str:
    """Rounded like the catalog rounds, with the same nudge."""
    return f"round(({expr})::DOUBLE + 1e-9, 6) + 0.0 AS {name or expr}"


def lit(text: object) -> str:
    return "NULL" if text is None else f"'{text}'" if isinstance(text, str) else str(text)


def choice(column: str, values: list) -> str:
    cases = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE {column} {cases} END"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

BASE = f"""
base AS (
  SELECT event_id, ts, user_id, event_type, {K} AS k, CAST(ts AS DATE) AS day
  FROM events
)"""

AGENT_TABLE = "agent_dim AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(lit(v) for v in a) + ")" for a in AGENTS
) + ") t(id, name, kind, browser, version, os, device))"

KEY_SQL = ("coalesce(date,'unknown') || '|' || coalesce(site,'unknown') || '|' || "
           "coalesce(partner,'unknown') || '|' || coalesce(ip,'unknown') || '|' || "
           "coalesce(user_agent,'unknown')")


def ev(ips: int = 10, agents: int = 3, replaced: str = "") -> str:
    agent = f"(user_id % {agents})"
    return f"""{BASE},
ev0 AS (
  SELECT event_id AS row_id, ts, CAST(day AS VARCHAR) AS date, 's1' AS site, 'p1' AS partner,
    '10.0.0.' || (user_id % {ips}) AS ip, {agent} AS user_agent_id,
    {choice(agent, [a[3] for a in AGENTS])} AS user_agent,
    {choice(agent, [a[2] for a in AGENTS])} AS user_agent_type,
    {choice(agent, [a[6] for a in AGENTS])} AS device_type,
    {choice(agent, [a[5] for a in AGENTS])} AS os_type,
    'UA' || (k % 6) AS user_agent_full, event_type AS origin, 'D' || (k % 3) AS destination,
    CAST(CAST(day + CAST(k % 7 AS INTEGER) AS DATE) AS VARCHAR) AS dep_date,
    user_id || '-' || hour(ts) AS session_id,
    CASE WHEN k % 3 <> 0 THEN 'r' END AS referrer, (k % 2 = 0) AS cookie_present,
    {choice('(k % 4)', ['1.1', '2', '3', 'unknown'])} AS http_version,
    CASE WHEN event_type = 'error' THEN 500.0 WHEN event_type = 'view' AND k % 10 = 0 THEN 404.0
         ELSE 200.0 END AS status_code,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 10 = 0 THEN 2.0 ELSE 1.0 END
         ELSE 0.0 END::DOUBLE AS num_orders
  FROM base
),
ev AS (
  SELECT *, CAST(num_orders > 0 AS INTEGER) AS has_order, {KEY_SQL} AS cohort_key,
    sha1(lower(origin) || '|' || lower(destination) || '|' || dep_date || '||1-0-0|economy|0')
      AS payload_signature
  FROM (SELECT * {replaced} FROM ev0)
)"""


RAW = f"""{BASE},
raw AS (
  SELECT event_id AS row_id,
    CASE WHEN k <> 13 THEN ts END AS ts, 's1' AS site,
    CASE WHEN k % 25 <> 0 THEN 'p1' END AS partner,
    upper(event_type) AS origin, 'D' || (k % 3) AS destination,
    CASE WHEN k % 4 <> 0 THEN 'RT' END AS journey_type,
    CAST(CAST(day + CAST(k % 7 AS INTEGER) AS DATE) AS VARCHAR) AS dep_date,
    CASE WHEN k % 2 = 0 THEN CAST(CAST(day + 10 AS DATE) AS VARCHAR) END AS ret_date,
    1 + k % 3 AS adults, k % 2 AS children, CASE WHEN k % 5 <> 0 THEN 0 END AS infants,
    CASE WHEN k % 11 <> 0 THEN CAST(k % 2 AS VARCHAR) END AS stops_raw,
    user_id || '-' || hour(ts) AS session_id,
    CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS num_orders,
    CASE WHEN k <> 17 THEN user_id % 4 END AS user_agent_id,
    CASE WHEN k <> 19 THEN CAST(event_id AS VARCHAR) END AS click_id
  FROM base
),
addresses AS (
  SELECT CAST(event_id AS VARCHAR) AS click, '10.0.0.' || (user_id % 10) AS addr
  FROM base WHERE event_type <> 'signup'
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), '10.0.0.' || (user_id % 10)
  FROM base WHERE event_type = 'purchase'
),
{AGENT_TABLE},
agented AS (
  SELECT raw.*, coalesce(browser, 'Unknown') AS user_agent, coalesce(kind, 'Unknown') AS
    user_agent_type, coalesce(device, 'Unknown') AS device_type, coalesce(os, 'Unknown') AS os_type,
    coalesce(name, CASE WHEN user_agent_id IS NULL THEN 'Unknown'
                        ELSE 'Unknown User Agent ' || user_agent_id END) AS user_agent_full
  FROM raw LEFT JOIN agent_dim ON user_agent_id = id
),
left_joined AS (
  SELECT agented.*, coalesce(addr, 'unknown') AS ip
  FROM agented LEFT JOIN addresses ON click_id = click
),
inner_joined AS (
  SELECT agented.*, addr AS ip FROM agented JOIN addresses ON click_id = click
)"""


def key_of(ip: str, date: str = f"'{JOB_DATE}'") -> str:
    return (f"{date} || '|s1|' || coalesce(partner, 'unknown') || '|' || {ip} || '|' || user_agent")


# -- ingest --------------------------------------------------------------------

ORACLES["ingest_normalize"] = f"""WITH {RAW}
SELECT row_id, CAST(epoch_us(ts) AS BIGINT) AS timestamp, site, coalesce(partner, 'unknown') AS
  partner, origin, coalesce(journey_type, 'OW') AS journey_type, dep_date, ret_date,
  adults || '-' || children || '-' || coalesce(infants, 0) AS pax_config, 'Economy' AS cabin,
  coalesce(stops_raw, '0') AS stops, 'unknown' AS ip, user_agent, num_orders,
  200.0::DOUBLE AS status_code, false AS cookie_present, 'unknown' AS http_version,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(num_orders > 0 AS INTEGER) AS has_order,
  {key_of("'unknown'")} AS cohort_key,
  sha1(lower(origin) || '|' || lower(destination) || '|' || dep_date || '|' ||
       coalesce(ret_date, '') || '|' || adults || '-' || children || '-' || coalesce(infants, 0) ||
       '|economy|' || coalesce(stops_raw, '0')) AS payload_signature
FROM agented"""

ORACLES["ingest_matched"] = f"""WITH {RAW}
SELECT row_id, ip, partner, adults::DOUBLE AS num_adults, coalesce(infants, 0)::DOUBLE AS
  num_infants, coalesce(stops_raw, '0') AS stops, num_orders,
  CAST(num_orders > 0 AS INTEGER) AS has_order, {key_of("ip")} AS cohort_key
FROM inner_joined"""

ORACLES["ip_join_left"] = f"WITH {RAW} SELECT row_id, ip FROM left_joined"
ORACLES["ip_join_grid"] = ORACLES["ip_join_left"]
ORACLES["ip_join_inner"] = f"WITH {RAW} SELECT row_id, ip FROM inner_joined"
ORACLES["ip_match_rate"] = f"""WITH {RAW}
SELECT (SELECT count(*) FROM raw) AS input_rows, (SELECT count(*) FROM inner_joined) AS
  joined_rows, {r6('(SELECT count(*) FROM inner_joined) / (SELECT count(*) FROM raw)::DOUBLE',
                   'match_rate')}"""
ORACLES["ua_enrich"] = f"""WITH {RAW}
SELECT row_id, user_agent, user_agent_type, device_type, os_type, user_agent_full FROM agented"""
ORACLES["payload_signatures"] = f"WITH {ev()} SELECT row_id, payload_signature FROM ev"

ORACLES["dq_ingest"] = f"""WITH {RAW}, keyed AS (
  SELECT *, {key_of('ip')} AS cohort_key FROM left_joined),
sizes AS (SELECT cohort_key, count(*) AS n FROM keyed GROUP BY 1),
clicks AS (SELECT click_id FROM keyed WHERE click_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT count(*) AS total_rows, CAST(epoch_us(min(ts)) AS BIGINT) AS first_timestamp,
  CAST(epoch_us(max(ts)) AS BIGINT) AS last_timestamp, count(*) - count(ts) AS null_timestamp,
  count(*) - count(ret_date) AS null_ret_date, count(*) AS null_referrer,
  count(*) - count(session_id) AS null_session_id,
  (SELECT count(*) FROM sizes) AS cohorts,
  (SELECT count(*) FROM sizes WHERE n < 5) AS small_cohorts,
  (SELECT count(*) FROM clicks) AS repeated_clicks
FROM keyed"""

ORACLES["dq_issues"] = f"""WITH {RAW}, keyed AS (
  SELECT *, {key_of('ip')} AS cohort_key FROM left_joined),
small AS (SELECT count(*) AS n FROM
  (SELECT cohort_key FROM keyed GROUP BY 1 HAVING count(*) < 2000)),
clicks AS (SELECT count(*) AS n FROM (SELECT click_id FROM keyed WHERE click_id IS NOT NULL
  GROUP BY 1 HAVING count(*) > 1)),
untimed AS (SELECT count(*) - count(ts) AS n FROM keyed)
SELECT n || ' cohorts have < 2000 events' AS issue FROM small WHERE n > 0
UNION ALL SELECT n || ' events have no readable timestamp' FROM untimed WHERE n > 0
UNION ALL SELECT n || ' click ids occur more than once' FROM clicks WHERE n > 0"""

_COOKIES = ["true", " TRUE ", "1", "t", "Yes", "no", "0", "false", "", "nan", "2", None]
ORACLES["cookie_texts"] = f"""
SELECT event_id AS row_id, coalesce(lower(trim(text)) IN ('true', '1', 't', 'yes'), false)
  AS cookie_present
FROM (SELECT event_id, {choice('event_id % 12', _COOKIES)} AS text FROM events)"""
ORACLES["ingest_totals"] = f"""WITH {ev()}
SELECT count(*) AS rows, count(DISTINCT cohort_key) AS unique_cohorts,
  count(DISTINCT ip) AS unique_ips, count(DISTINCT user_agent) AS unique_user_agents FROM ev"""

# -- cohort features: one CTE per block, named like the block ----------------------

NIGHT = "22, 23, 0, 1, 2, 3, 4, 5, 6"

CTES = {
    "hours": "hours AS (SELECT cohort_key, " + ", ".join(
        f"(count(*) FILTER (WHERE hour(ts) = {h}))::DOUBLE / count(ts) AS {name}"
        for h, name in enumerate(HOUR_COLUMNS)) + " FROM ev GROUP BY 1)",
    "shape": """
cells AS (
  SELECT c.cohort_key, h.h, coalesce(n, 0) / total::DOUBLE AS p
  FROM (SELECT cohort_key, count(*) AS total FROM ev GROUP BY 1) c
  CROSS JOIN (SELECT unnest(range(24)) AS h) h
  LEFT JOIN (SELECT cohort_key, hour(ts) AS h, count(*) AS n FROM ev GROUP BY 1, 2) e
    ON e.cohort_key = c.cohort_key AND e.h = h.h
),
shape AS (
  SELECT cohort_key, -sum((p + 1e-10) * log2(p + 1e-10)) AS hourly_entropy,
    (25 - 2 * sum(running) / sum(p)) / 24 AS hourly_gini
  FROM (SELECT *, sum(p) OVER (PARTITION BY cohort_key ORDER BY p, h
                               ROWS UNBOUNDED PRECEDING) AS running FROM cells)
  GROUP BY 1
)""",
    "basics": f"""basics AS (
  SELECT cohort_key, count(*) AS n_events,
    (count(*) FILTER (WHERE hour(ts) IN ({NIGHT})))::DOUBLE / count(*) AS night_share,
    CAST(epoch_us(min(ts)) AS BIGINT) AS first_timestamp,
    CAST(epoch_us(max(ts)) AS BIGINT) AS last_timestamp,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9 AS duration_hours,
    CASE WHEN count(*) < 5 THEN 0.0 ELSE
      (count(*) FILTER (WHERE minute(ts) IN (0, 15, 30, 45)))::DOUBLE / count(*) END
      AS schedule_regularity_strength,
    (count(*) FILTER (WHERE http_version = '1.1'))::DOUBLE / count(*) AS http11_share,
    (count(*) FILTER (WHERE http_version = '2'))::DOUBLE / count(*) AS http2_share,
    (count(*) FILTER (WHERE http_version = '3'))::DOUBLE / count(*) AS http3_share,
    (count(*) FILTER (WHERE http_version = 'unknown'))::DOUBLE / count(*) AS http_unknown_share,
    (count(*) FILTER (WHERE cookie_present))::DOUBLE / count(*) AS cookie_rate,
    count(referrer)::DOUBLE / count(*) AS referrer_rate,
    (count(*) FILTER (WHERE status_code BETWEEN 200 AND 299))::DOUBLE / count(*) AS ok2xx_rate,
    (count(*) FILTER (WHERE status_code BETWEEN 400 AND 499))::DOUBLE / count(*) AS client4xx_rate,
    (count(*) FILTER (WHERE status_code BETWEEN 500 AND 599))::DOUBLE / count(*) AS server5xx_rate,
    bool_or(user_agent_type = 'Bot') AS is_bot_ua_type,
    bool_or(user_agent_type = 'Application') AS is_application_ua_type,
    bool_or(regexp_matches(lower(device_type), 'phone|tablet')) AS is_mobile_device,
    count(DISTINCT user_agent_type) AS ua_type_diversity,
    count(DISTINCT device_type) AS device_diversity,
    count(DISTINCT origin || '>' || destination) AS od_unique,
    count(DISTINCT dep_date) AS dep_dates_unique,
    count(DISTINCT session_id) AS unique_sessions,
    count(DISTINCT session_id)::DOUBLE / count(*) AS sessions_per_event
  FROM ev GROUP BY 1)""",
    "gaps": """
gap_rows AS (
  SELECT *, sum(CASE WHEN gap < 1000000 THEN 1 ELSE 0 END) OVER (
      PARTITION BY cohort_key ORDER BY ts, row_id ROWS 9 PRECEDING) AS dense,
    row_number() OVER (PARTITION BY cohort_key ORDER BY ts, row_id) AS gap_no
  FROM (SELECT cohort_key, ts, row_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (
          PARTITION BY cohort_key ORDER BY ts, row_id) AS gap FROM ev)
  WHERE gap IS NOT NULL
),
gap_agg AS (
  SELECT cohort_key, quantile_cont(gap, 0.5) / 1e6 AS p50, quantile_cont(gap, 0.95) / 1e6 AS p95,
    avg(CASE WHEN gap < 2000000 THEN 1.0 ELSE 0.0 END) AS lt2,
    CAST(coalesce(max(dense) FILTER (WHERE gap_no >= 10), 0) AS BIGINT) AS run
  FROM gap_rows GROUP BY 1
),
gaps AS (
  SELECT c.cohort_key, coalesce(p50, 0.0) AS gap_p50, coalesce(p95, 0.0) AS gap_p95,
    CASE WHEN p50 > 0 THEN p95 / p50 WHEN p50 = 0 THEN 0.0 END AS gap_p95_over_p50,
    run AS max_run_lt_1s, lt2 AS share_lt_2s
  FROM (SELECT DISTINCT cohort_key FROM ev) c LEFT JOIN gap_agg USING (cohort_key)
)""",
    "bursts": """
islands AS (
  SELECT cohort_key, status_code NOT BETWEEN 200 AND 299 AS bad,
    row_number() OVER (PARTITION BY cohort_key ORDER BY ts, row_id)
    - row_number() OVER (PARTITION BY cohort_key, status_code BETWEEN 200 AND 299
                         ORDER BY ts, row_id) AS island
  FROM ev
),
bursts AS (
  SELECT cohort_key, CAST(coalesce(max(n) FILTER (WHERE bad), 0) AS BIGINT) AS error_bursts
  FROM (SELECT cohort_key, bad, island, count(*) AS n FROM islands GROUP BY 1, 2, 3) GROUP BY 1
)""",
    "signatures": """
sig AS (SELECT cohort_key, payload_signature, count(*) AS n FROM ev GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cohort_key
                                        ORDER BY n DESC, payload_signature) AS rn FROM sig),
signatures AS (
  SELECT cohort_key, count(*) AS num_signatures, max(n)::DOUBLE / sum(n) AS top_signature_share,
    count(*) FILTER (WHERE n >= 10) AS num_exact_repeats_ge_10,
    sum(n - 1)::DOUBLE / sum(n) AS repeat_ratio, CAST(sum(n) AS BIGINT) AS total,
    CAST(max(CASE WHEN rn = 1 THEN n END) AS BIGINT) AS top_sig_1_count,
    max(CASE WHEN rn = 1 THEN n END)::DOUBLE / sum(n) * 100 AS top_sig_1_pct,
    CAST(max(CASE WHEN rn = 2 THEN n END) AS BIGINT) AS top_sig_2_count,
    max(CASE WHEN rn = 2 THEN n END)::DOUBLE / sum(n) * 100 AS top_sig_2_pct,
    CAST(max(CASE WHEN rn = 3 THEN n END) AS BIGINT) AS top_sig_3_count,
    max(CASE WHEN rn = 3 THEN n END)::DOUBLE / sum(n) * 100 AS top_sig_3_pct
  FROM ranked GROUP BY 1
)""",
    "orders_block": """orders_block AS (
  SELECT cohort_key, sum(num_orders) AS total_orders, avg(num_orders) AS orders_per_event,
    avg(has_order) AS conversion_rate, CAST(sum(has_order) AS BIGINT) AS events_with_orders,
    CAST(count(*) - sum(has_order) AS BIGINT) AS events_without_orders,
    avg(has_order) AS order_ratio,
    CASE WHEN sum(num_orders) > 0 THEN count(DISTINCT num_orders) ELSE 0 END
      AS unique_order_values,
    CASE WHEN sum(num_orders) > 0 THEN max(num_orders) ELSE 0.0 END AS max_orders_per_event,
    CASE WHEN sum(num_orders) > 0 THEN min(num_orders) ELSE 0.0 END AS min_orders_per_event,
    CASE WHEN sum(num_orders) > 0 THEN count(DISTINCT num_orders) = 1 ELSE true END
      AS all_same_orders,
    CASE WHEN sum(num_orders) > 0 THEN bool_and(num_orders IN (0, 1)) ELSE true END
      AS only_zero_or_one_orders,
    CASE WHEN sum(num_orders) > 0 THEN var_pop(num_orders) ELSE 0.0 END AS order_variance
  FROM ev GROUP BY 1)""",
    "agents": """
full_counts AS (
  SELECT cohort_key, min(date) AS date, user_agent_full, count(*) AS n FROM ev GROUP BY 1, 3),
full_mode AS (
  SELECT *, sum(n) OVER (PARTITION BY cohort_key) AS total,
    row_number() OVER (PARTITION BY cohort_key ORDER BY n DESC, user_agent_full) AS rn
  FROM full_counts),
agents AS (
  SELECT cohort_key, m.user_agent_full AS ua_full, n::DOUBLE / total AS ua_full_mode_share,
    d.ips AS ua_full_ip_diversity, d.ips::DOUBLE / a.ips AS ua_full_ip_diversity_ratio
  FROM full_mode m
  JOIN (SELECT date, user_agent_full, count(DISTINCT ip) AS ips FROM ev GROUP BY 1, 2) d
    ON d.date = m.date AND d.user_agent_full = m.user_agent_full
  JOIN (SELECT date, count(DISTINCT ip) AS ips FROM ev GROUP BY 1) a ON a.date = m.date
  WHERE rn = 1)""",
    "identity": """identity AS (
  SELECT cohort_key, date, site, partner, ip, user_agent, user_agent_type, device_type, os_type
  FROM (SELECT *, row_number() OVER (PARTITION BY cohort_key ORDER BY row_id) AS rn FROM ev)
  WHERE rn = 1)""",
    "churn": """churn AS (SELECT date, ip, count(DISTINCT user_agent) AS ua_churn_per_ip_day
  FROM ev GROUP BY 1, 2)""",
}


def ladder_ctes(source: str, key: str, day: str, distinct: bool = False) -> str:
    rows = f"SELECT {'DISTINCT' if distinct else ''} {key} AS k, CAST({day} AS DATE) AS d FROM {source}"
    return f"""
steps AS (SELECT k, d, coalesce(d - lag(d) OVER (PARTITION BY k ORDER BY d) = 1, false) AS one
          FROM ({rows})),
stepped AS (SELECT k, one, sum(CASE WHEN one THEN 0 ELSE 1 END) OVER (
              PARTITION BY k ORDER BY d, one ROWS UNBOUNDED PRECEDING) AS run FROM steps),
runs AS (SELECT k, run, count(*) FILTER (WHERE one) AS n FROM stepped GROUP BY 1, 2),
sizes_of AS (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY 1),
ladder AS (
  SELECT r.k AS {key}, CASE WHEN max(s.n) < 3 THEN 0
      ELSE CAST(coalesce(sum(r.n) FILTER (WHERE r.n >= 2), 0) AS BIGINT) END AS ladder_sweep_count
  FROM runs r JOIN sizes_of s ON s.k = r.k GROUP BY 1)"""


# Repeated dates: the steps of zero days come first within a date, so the row that
# steps by one day must be the first of its date.
_LADDER = """
dated AS (SELECT cohort_key AS k, CAST(dep_date AS DATE) AS d,
            row_number() OVER (PARTITION BY cohort_key ORDER BY dep_date, row_id) AS rn FROM ev),
steps AS (SELECT k, rn, coalesce(d - lag(d) OVER (PARTITION BY k ORDER BY rn) = 1, false) AS one
          FROM dated),
stepped AS (SELECT k, one, sum(CASE WHEN one THEN 0 ELSE 1 END) OVER (
              PARTITION BY k ORDER BY rn ROWS UNBOUNDED PRECEDING) AS run FROM steps),
runs AS (SELECT k, run, count(*) FILTER (WHERE one) AS n FROM stepped GROUP BY 1, 2),
ladder_sizes AS (SELECT cohort_key AS k, count(*) AS n FROM ev GROUP BY 1),
ladder AS (
  SELECT r.k AS cohort_key, CASE WHEN max(s.n) < 3 THEN 0
      ELSE CAST(coalesce(sum(r.n) FILTER (WHERE r.n >= 2), 0) AS BIGINT) END AS ladder_sweep_count
  FROM runs r JOIN ladder_sizes s ON s.k = r.k GROUP BY 1)"""
CTES["ladder"] = _LADDER


def block(names: list[str] | str, columns: list[str], source: str | None = None,
          rounded: tuple[str, ...] = ()) -> str:
    names = [names] if isinstance(names, str) else names
    with_ = f"WITH {source or ev()}, " + ", ".join(CTES[n] for n in names)
    joins = names[0] + "".join(f" JOIN {n} USING (cohort_key)" for n in names[1:])
    shown = ", ".join(r6(c) if c in rounded else c for c in columns)
    return f"{with_} SELECT cohort_key, {shown} FROM {joins}"


FEW = ev(5, 2)
SCHEDULE = "(schedule_regularity_strength > 0.5) AS schedule_regular_times"

ORACLES["cohort_min_size"] = f"""WITH {ev()}
SELECT row_id, cohort_key FROM ev WHERE cohort_key IN (
  SELECT cohort_key FROM ev GROUP BY 1 HAVING count(*) >= 10)"""
ORACLES["hourly_hist"] = block("hours", list(HOUR_COLUMNS), rounded=HOUR_COLUMNS)
ORACLES["hourly_entropy_gini"] = block(
    "shape", ["hourly_entropy", "hourly_gini"], rounded=("hourly_entropy", "hourly_gini"))
ORACLES["night_share"] = block("basics", ["n_events", "night_share"], rounded=("night_share",))
ORACLES["active_span"] = block("basics", ["first_timestamp", "last_timestamp", "duration_hours"],
                               rounded=("duration_hours",))
ORACLES["schedule_regularity"] = block(
    "basics", [SCHEDULE, "schedule_regularity_strength"],
    rounded=("schedule_regularity_strength",))
_GAPS = ("gap_p50", "gap_p95", "gap_p95_over_p50", "share_lt_2s")
ORACLES["gap_stats"] = block("gaps", list(_GAPS), rounded=_GAPS)
ORACLES["gap_stats_in_pieces"] = block("gaps", list(_GAPS), FEW, _GAPS)
ORACLES["max_run_lt"] = block("gaps", ["max_run_lt_1s"], FEW)
ORACLES["error_bursts"] = block("bursts", ["error_bursts"], FEW)
LADDER_COLUMNS = ["ladder_sweep_count > 0 AS ladder_sweep", "ladder_sweep_count"]
ORACLES["runs_in_pieces"] = block(["gaps", "bursts"], ["max_run_lt_1s", "error_bursts"], FEW)
ORACLES["ladder_sweep"] = block("ladder", LADDER_COLUMNS)
ORACLES["ladder_sweep_distinct"] = (
    f"WITH {ev()}, {ladder_ctes('ev', 'cohort_key', 'dep_date', distinct=True)} "
    f"SELECT cohort_key, {', '.join(LADDER_COLUMNS)} FROM ladder")
ORACLES["orders_ladder"] = (
    "WITH dated AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, row_number() OVER ("
    "PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders), "
    + _LADDER[_LADDER.index("steps AS"):]
    .replace("SELECT cohort_key AS k, count(*) AS n FROM ev", "SELECT o_custkey AS k, count(*) AS n FROM orders")
    .replace("r.k AS cohort_key", "r.k AS o_custkey")
    + f" SELECT o_custkey, {', '.join(LADDER_COLUMNS)} FROM ladder")
_SIGS = ("top_signature_share", "repeat_ratio")
ORACLES["signature_stats"] = block(
    "signatures", ["num_signatures", "top_signature_share", "num_exact_repeats_ge_10",
                   "repeat_ratio"], rounded=_SIGS)
ORACLES["pattern_flags"] = block("signatures", [
    "(total >= 10 AND top_signature_share > 0.5)::INTEGER::DOUBLE AS anomaly_high_repetition",
    "(total >= 100 AND num_signatures < 5)::INTEGER::DOUBLE AS anomaly_low_diversity",
    "0.0::DOUBLE AS anomaly_burst_pattern"], FEW)
_TOPS = [f"top_sig_{i}_{part}" for i in (1, 2, 3) for part in ("count", "pct")]
_PCTS = tuple(c for c in _TOPS if c.endswith("pct"))
ORACLES["top_signatures"] = block("signatures", _TOPS, FEW, _PCTS)
ORACLES["route_diversity"] = block("basics", ["od_unique", "dep_dates_unique"])
ORACLES["session_volume"] = block("basics", ["unique_sessions", "sessions_per_event"],
                                  rounded=("sessions_per_event",))
_CLIENT = ["is_bot_ua_type", "is_application_ua_type", "is_mobile_device", "ua_type_diversity",
           "device_diversity"]
ORACLES["client_diversity"] = block("basics", _CLIENT)
_HTTP = ("http11_share", "http2_share", "http3_share", "http_unknown_share")
ORACLES["http_shares"] = block("basics", list(_HTTP), rounded=_HTTP)
_HYGIENE = ("cookie_rate", "referrer_rate")
ORACLES["hygiene"] = block("basics", list(_HYGIENE), rounded=_HYGIENE)
_STATUS = ("ok2xx_rate", "client4xx_rate", "server5xx_rate")
ORACLES["status_rates"] = block("basics", list(_STATUS), rounded=_STATUS)
_ORDERS = ["total_orders", "orders_per_event", "conversion_rate", "events_with_orders",
           "events_without_orders", "order_ratio", "unique_order_values", "max_orders_per_event",
           "min_orders_per_event", "all_same_orders", "only_zero_or_one_orders", "order_variance"]
_ORDER_DOUBLES = ("total_orders", "orders_per_event", "conversion_rate", "order_ratio",
                  "max_orders_per_event", "min_orders_per_event", "order_variance")
ORACLES["order_features"] = block("orders_block", _ORDERS, rounded=_ORDER_DOUBLES)
ORACLES["ua_churn"] = f"WITH {ev(50)}, {CTES['churn']} SELECT * FROM churn"
_AGENTS = ["ua_full", "ua_full_mode_share", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio"]
_AGENT_DOUBLES = ("ua_full_mode_share", "ua_full_ip_diversity_ratio")
ORACLES["ua_full_diversity"] = block("agents", _AGENTS, rounded=_AGENT_DOUBLES)
_IDENTITY = ["date", "site", "partner", "ip", "user_agent", "user_agent_type", "device_type",
             "os_type"]
ORACLES["cohort_identity"] = block("identity", _IDENTITY)

# All blocks side by side.
_DOUBLES = {
    *_GAPS, *_SIGS, *_PCTS, *_HTTP, *_HYGIENE, *_STATUS, *_ORDER_DOUBLES, *_AGENT_DOUBLES,
    *HOUR_COLUMNS, "hourly_entropy", "hourly_gini", "night_share", "duration_hours",
    "schedule_regularity_strength", "sessions_per_event",
}
_FEATURES = [
    *_IDENTITY, *_AGENTS, *HOUR_COLUMNS, "hourly_entropy", "hourly_gini", "night_share",
    *_GAPS, "max_run_lt_1s", SCHEDULE, "schedule_regularity_strength", "first_timestamp",
    "last_timestamp", "duration_hours", "num_signatures", *_SIGS, "num_exact_repeats_ge_10",
    "od_unique", "dep_dates_unique", *LADDER_COLUMNS, *_TOPS, *_HTTP, *_HYGIENE,
    "ua_churn_per_ip_day", *_CLIENT, "unique_sessions", "sessions_per_event", "n_events",
    *_STATUS, "error_bursts", *_ORDERS,
]
_BLOCKS = ["basics", "identity", "hours", "shape", "gaps", "bursts", "signatures", "orders_block",
           "agents", "ladder"]


def feature_ctes(source: str) -> str:
    return f"{source}, " + ", ".join(CTES[n] for n in [*_BLOCKS, "churn"]) + f""",
features AS (
  SELECT cohort_key, {', '.join(_FEATURES)}
  FROM basics {' '.join(f'JOIN {n} USING (cohort_key)' for n in _BLOCKS[1:])}
  JOIN churn USING (date, ip) WHERE n_events >= 5)"""


FEATURE_CTES = feature_ctes(ev())


def _names(columns: list[str]) -> list[str]:
    return [c.split(" AS ")[-1] for c in columns]


ORACLES["all_cohort_features"] = f"WITH {FEATURE_CTES} SELECT cohort_key, " + ", ".join(
    r6(c) if c in _DOUBLES else c for c in _names(_FEATURES)) + " FROM features"

ORACLES["features_of_large_cohorts"] = ORACLES["all_cohort_features"]

# -- ad-hoc analysis ---------------------------------------------------------------

AUDIT = """audit AS (
  SELECT *, order_values = 1 AND events >= 5 AS identical_orders,
    min_orders = 0 AND max_orders <= 1 AND events >= 5 AS only_zero_one,
    events >= 20 AND total_orders = 0 AS high_volume_no_orders
  FROM (SELECT cohort_key, count(num_orders) AS events, count(DISTINCT num_orders) AS order_values,
          min(num_orders) AS min_orders, max(num_orders) AS max_orders,
          sum(num_orders) AS total_orders FROM ev GROUP BY 1))"""
ORACLES["order_audit"] = f"WITH {ev()}, {AUDIT} SELECT * FROM audit"
ORACLES["order_audit_summary"] = f"WITH {FEW}, {AUDIT} " + " UNION ALL ".join(
    f"SELECT '{s}' AS suspicion, count(*) FILTER (WHERE {s}) AS cohorts FROM audit"
    for s in ("identical_orders", "only_zero_one", "high_volume_no_orders"))
ORACLES["order_audit_examples"] = (
    f"WITH {ev()}, {AUDIT} SELECT * FROM audit WHERE only_zero_one ORDER BY cohort_key LIMIT 5")
ORACLES["order_totals"] = f"""WITH {ev()}
SELECT count(*) AS events, sum(num_orders) AS total_orders,
  CAST(sum(has_order) AS BIGINT) AS events_with_orders,
  CAST(count(*) - sum(has_order) AS BIGINT) AS events_without_orders,
  {r6('avg(has_order) * 100', 'conversion_pct')}, {r6('avg(num_orders)', 'orders_per_event')}
FROM ev"""
ORACLES["order_distribution"] = f"""WITH {ev()}
SELECT num_orders, count(*) AS events,
  {r6('count(*) * 100.0 / (SELECT count(*) FROM ev)', 'pct')}
FROM ev GROUP BY 1 ORDER BY 1 LIMIT 10"""
for _name, _column in (("orders_by_ua_type", "user_agent_type"), ("orders_by_browser", "user_agent")):
    ORACLES[_name] = f"""WITH {ev()}
SELECT {_column}, count(num_orders) AS events, sum(num_orders) AS orders,
  round_even(avg(num_orders), 3) + 0.0 AS mean_orders,
  {r6('round_even(avg(has_order), 3) * 100', 'conversion_pct')}
FROM ev GROUP BY 1"""


def counts_sql(source: str, column: str, limit: str = "") -> str:
    return f"""SELECT {column} AS value, count(*) AS events,
  {r6(f'count(*) * 100.0 / (SELECT count(*) FROM {source})', 'pct')}
FROM {source} GROUP BY 1 ORDER BY 2 DESC, 1 {limit}"""


ORACLES["value_counts_ua"] = f"WITH {ev()} " + counts_sql("ev", "user_agent_type")
ORACLES["value_counts_priority"] = counts_sql("orders", "o_orderpriority", "LIMIT 10")
ORACLES["client_totals"] = f"WITH {ev()} " + " UNION ALL ".join(
    f"SELECT '{name}' AS client, count(*) FILTER (WHERE {test}) AS events, "
    f"{r6(f'(count(*) FILTER (WHERE {test})) * 100.0 / count(*)', 'pct')} FROM ev"
    for name, test in (
        ("bot", "user_agent_type = 'Bot'"), ("application", "user_agent_type = 'Application'"),
        ("web_browser", "user_agent_type = 'Web Browser'"),
        ("mobile", "device_type ILIKE '%phone%' OR device_type ILIKE '%tablet%'"),
        ("desktop", "device_type ILIKE '%pc%' OR device_type ILIKE '%desktop%'")))
ORACLES["top_ua_ids"] = f"""WITH {ev()}
SELECT user_agent_id, count(*) AS events, arg_min(user_agent, row_id) AS browser,
  {r6('count(*) * 100.0 / (SELECT count(*) FROM ev)', 'pct')}
FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
ORACLES["ua_distribution"] = f"""WITH {RAW}
SELECT CAST(user_agent_id AS VARCHAR) AS user_agent_id, count(*) AS count,
  min(user_agent) AS browser_model, min(user_agent_type) AS user_agent_type,
  min(device_type) AS device, min(os_type) AS os_type
FROM agented WHERE user_agent_id IS NOT NULL GROUP BY 1"""

# -- whole-column statistics ----------------------------------------------------------


def _moments(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", count({c}) AS n, avg({c}) AS mean, "
            f"quantile_cont({c}, 0.5) AS median, stddev_pop({c}) AS std, "
            f"quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.75) AS q75, "
            f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr, "
            f"avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS skewness, "
            f"avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 AS kurtosis "
            f"FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)")


ORACLES["robust_stats"] = "SELECT \"column\", n, " + ", ".join(
    r6(c) for c in ("mean", "median", "std", "q25", "q75", "iqr", "skewness", "kurtosis")
) + " FROM (" + " UNION ALL ".join(_moments(c) for c in STATS_COLUMNS) + ")"

for _method, _centre, _scale in (
    ("robust", "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
    ("standard", "avg({c})", "stddev_pop({c})"),
    ("minmax", "min({c})", "max({c}) - min({c})"),
):
    _stats = ", ".join(
        f"{_centre.format(c=c)} AS centre_{c}, "
        f"CASE WHEN ({_scale.format(c=c)}) = 0 THEN 1 ELSE {_scale.format(c=c)} END AS scale_{c}"
        for c in STATS_COLUMNS)
    ORACLES[f"normalize_{_method}"] = (
        f"WITH stats AS (SELECT {_stats} FROM lineitem) SELECT l_orderkey, l_linenumber, "
        + ", ".join(r6(f"({c} - centre_{c}) / scale_{c}", c) for c in STATS_COLUMNS)
        + " FROM lineitem, stats")


def _corr(a: str, b: str, expr: str, source: str = "lineitem") -> str:
    return (f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r6(expr, 'correlation')} "
            f"FROM {source}")


_PAIRS = [(a, b) for i, a in enumerate(STATS_COLUMNS) for b in STATS_COLUMNS[i + 1:]]
ORACLES["correlation_pairs"] = " UNION ALL ".join(_corr(a, b, f"corr({a}, {b})") for a, b in _PAIRS)
ORACLES["correlation_matrix"] = " UNION ALL ".join(
    _corr(a, b, "any_value(1.0)" if a == b else f"corr({a}, {b})")
    for a in STATS_COLUMNS for b in STATS_COLUMNS)
_WIDE = "(SELECT l_quantity, l_extendedprice, l_quantity * 2 + 1 AS doubled FROM lineitem)"
ORACLES["high_correlation"] = "SELECT * FROM (" + " UNION ALL ".join(
    _corr(a, b, f"abs(corr({a}, {b}))", _WIDE) for a, b in (
        ("l_quantity", "l_extendedprice"), ("l_quantity", "doubled"),
        ("l_extendedprice", "doubled"))) + ") WHERE correlation > 0.85"

# -- history ------------------------------------------------------------------------

_EWMA = ["night_share", "top_signature_share", "hourly_entropy", "cookie_rate"]


def _ewma(value: str, alpha: float) -> str:
    weight = f"pow({1 - alpha}, rn - 1)"
    return f"sum({value} * {weight}) / sum({weight})"



def _ewma_by_day(names: list[str], condition: str) -> str:
    return f"""WITH {ev()}, {CTES['basics']}, {CTES['shape']}, {CTES['signatures']},
{CTES['identity']},
today AS (
  SELECT cohort_key, CAST(date AS DATE) AS day, ip || '|' || user_agent AS who,
    {', '.join(names)}
  FROM basics JOIN shape USING (cohort_key) JOIN signatures USING (cohort_key)
  JOIN identity USING (cohort_key)),
past AS (
  SELECT t.cohort_key, {', '.join(f'h.{f}' for f in names)},
    row_number() OVER (PARTITION BY t.cohort_key ORDER BY h.day DESC) AS rn
  FROM today t JOIN today h ON h.who = t.who AND h.day < t.day AND h.day >= t.day - 30),
averaged AS (
  SELECT cohort_key, {', '.join(f'{_ewma(f, 0.3)} AS s_{f}, {_ewma(f, 0.1)} AS l_{f}'
                               for f in names)}
  FROM past GROUP BY 1)
SELECT cohort_key, {', '.join(r6(f'coalesce(s_{f}, {f})', f'ewma_{f}_7d') + ', '
                             + r6(f'coalesce(l_{f}, {f})', f'ewma_{f}_30d') for f in names)}
FROM today LEFT JOIN averaged USING (cohort_key) {condition}"""


ORACLES["ewma_history"] = _ewma_by_day(_EWMA, "")
ORACLES["ewma_last_day"] = _ewma_by_day(
    _EWMA + ["repeat_ratio", "referrer_rate"], "WHERE day = (SELECT max(day) FROM today)")

ORACLES["ewma_first_day"] = _ewma_by_day(
    _EWMA + ["repeat_ratio", "referrer_rate"], "WHERE day = (SELECT min(day) FROM today)")

ORACLES["ewma_nation_daily"] = f"""
WITH daily AS (
  SELECT c_nationkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    sum(o_totalprice) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY day) AS no FROM daily),
paired AS (
  SELECT t.c_nationkey, t.day, h.revenue, t.no - h.no + 1 AS rn
  FROM numbered t JOIN numbered h
    ON h.c_nationkey = t.c_nationkey AND h.no BETWEEN t.no - 29 AND t.no)
SELECT c_nationkey, day, round({_ewma('revenue', 0.3)}, 3) AS ewma FROM paired GROUP BY 1, 2"""

ORACLES["jaccard_prev_day"] = f"""WITH {ev()},
days AS (SELECT date, lag(date) OVER (ORDER BY date) AS prev FROM (SELECT DISTINCT date FROM ev)),
sets AS (SELECT DISTINCT date, ip, user_agent, cohort_key, payload_signature AS s FROM ev),
cur AS (SELECT cohort_key, any_value(c.date) AS date, any_value(ip) AS ip,
          any_value(user_agent) AS user_agent, count(*) AS n FROM sets c GROUP BY 1),
common AS (
  SELECT c.cohort_key, count(*) AS n FROM sets c JOIN days d ON d.date = c.date
  JOIN sets p ON p.date = d.prev AND p.ip = c.ip AND p.user_agent = c.user_agent AND p.s = c.s
  GROUP BY 1)
SELECT c.cohort_key, CASE WHEN d.prev IS NOT NULL THEN
    {r6('coalesce(m.n, 0) / (c.n + coalesce(p.n, 0) - coalesce(m.n, 0))::DOUBLE', 'x').replace(' AS x', '')}
  END AS jaccard_signatures_vs_prev_day
FROM cur c JOIN days d ON d.date = c.date
LEFT JOIN cur p ON p.date = d.prev AND p.ip = c.ip AND p.user_agent = c.user_agent
LEFT JOIN common m ON m.cohort_key = c.cohort_key"""

ORACLES["jaccard_sets"] = f"""WITH {ev()}, per AS (
  SELECT date, count(DISTINCT user_agent_full) AS agents,
    count(DISTINCT CASE WHEN has_order = 1 THEN user_agent_full END) AS buyers FROM ev GROUP BY 1)
SELECT date, {r6('buyers / agents::DOUBLE', 'similarity')} FROM per"""

ORACLES["latest_day"] = f"""WITH {ev()}
SELECT row_id, date FROM ev WHERE date = (SELECT max(date) FROM ev)"""

# -- scores and reports ----------------------------------------------------------------

_SET_ISO = """-pow(2, -(
      CASE WHEN n_events <= 10.5 THEN CASE WHEN night_share <= 0.4505 THEN 5.5 ELSE 3.5 END
           ELSE CASE WHEN hourly_entropy <= 3.2005 THEN 4.0 ELSE 6.0 END END
      + CASE WHEN night_share <= 0.2105 THEN 2.5
             WHEN top_signature_share <= 0.1505 THEN 6.5 ELSE 4.5 END
      + CASE WHEN hourly_entropy <= 2.4505 THEN 3.0
             WHEN n_events <= 6.5 THEN 4.75 ELSE 5.25 END)::DOUBLE
      / (3 * (2 * (ln(15) + 0.5772156649015329) - 1.875)))"""


def scored_sql(source: str, raw_iso: str, high: float, medium: float) -> str:
    return f"""{feature_ctes(source)},
ruled AS (
  SELECT *, greatest(0.0, least(1.0,
    0.2 * (night_share + 1 - hourly_entropy / 4) / 2
    + 0.3 * (top_signature_share + repeat_ratio) / 2
    + 0.2 * ((1 - least(gap_p50 / 60, 1)) + least(coalesce(max_run_lt_1s, 0) / 10.0, 1)) / 2
    + 0.15 * ((1 - cookie_rate) + (1 - referrer_rate)) / 2
    + 0.1 * ua_full_mode_share
    + 0.1 * ua_full_ip_diversity_ratio
    + 0.1 * greatest(http11_share, CASE WHEN http2_share > 0.95 THEN 1 ELSE 0 END)
    + 0.05 * least(ln(1 + n_events) / 10, 1))) AS rule_score,
    {raw_iso} AS raw_iso
  FROM features),
scaled AS (SELECT *, (raw_iso - min(raw_iso) OVER ()) / (max(raw_iso) OVER () - min(raw_iso) OVER ())
    AS iso_score FROM ruled),
blended AS (SELECT *, round(0.5 * rule_score + 0.5 * iso_score, 9) AS botness FROM scaled),
scored AS (SELECT *, CASE WHEN botness >= {high} THEN 'High' WHEN botness >= {medium} THEN 'Medium'
             ELSE 'Low' END AS risk_band FROM blended),
bands AS (SELECT unnest(['High', 'Medium', 'Low']) AS risk_band),
per_band AS (SELECT b.risk_band, count(s.cohort_key) AS cohorts
  FROM bands b LEFT JOIN scored s ON s.risk_band = b.risk_band GROUP BY 1)"""


SCORED = scored_sql(ev(), _SET_ISO, 0.6, 0.4)

ORACLES["rule_score"] = f"WITH {SCORED} SELECT cohort_key, {r6('rule_score')} FROM scored"
ORACLES["risk_bands"] = f"WITH {SCORED} SELECT cohort_key, {r6('botness')}, risk_band FROM scored"
ORACLES["band_counts"] = f"WITH {SCORED} SELECT * FROM per_band"
ORACLES["risk_distribution"] = f"""WITH {SCORED}
SELECT risk_band, cohorts, {r6('cohorts * 100.0 / (SELECT count(*) FROM scored)', 'pct')}
FROM per_band"""
ORACLES["score_statistics"] = f"WITH {SCORED} " + " UNION ALL ".join(
    f"SELECT '{s}' AS score, count(*) AS cohorts, {r6(f'avg({s})', 'mean')}, "
    f"{r6(f'stddev_samp({s})', 'std')}, {r6(f'min({s})', 'min')}, {r6(f'max({s})', 'max')} "
    "FROM scored" for s in ("rule_score", "iso_score", "botness"))
ORACLES["top_n_per_band"] = f"""WITH {SCORED}
SELECT risk_band, CAST(rank AS INTEGER) AS rank, cohort_key, {r6('botness')}
FROM (SELECT *, row_number() OVER (PARTITION BY risk_band ORDER BY botness DESC, cohort_key)
        AS rank FROM scored) WHERE rank <= 20"""
for _band in ("High", "Medium"):
    ORACLES[f"top_{_band.lower()}_cohorts"] = f"""WITH {SCORED}
SELECT site, partner, ip, round_even(botness, 3) + 0.0 AS botness, risk_band, n_events,
  round_even(night_share * 100, 1) + 0.0 AS night_share,
  round_even(top_signature_share * 100, 1) + 0.0 AS top_signature_share, ladder_sweep
FROM scored WHERE risk_band = '{_band}' ORDER BY scored.botness DESC, cohort_key LIMIT 10"""
_EXTRACT_DOUBLES = {"ua_full_mode_share", "ua_full_ip_diversity_ratio", "rule_score", "iso_score",
                    "botness", "night_share", "top_signature_share", "repeat_ratio", "gap_p50",
                    "cookie_rate", "referrer_rate", "http11_share", "http2_share",
                    "hourly_entropy"}
ORACLES["cohort_extract"] = f"WITH {SCORED} SELECT " + ", ".join(
    r6(c) if c in _EXTRACT_DOUBLES else c for c in (
        "cohort_key", "date", "site", "partner", "ip", "user_agent", "ua_full",
        "ua_full_mode_share", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio", "rule_score",
        "iso_score", "botness", "risk_band", "n_events", "night_share", "top_signature_share",
        "repeat_ratio", "gap_p50", "max_run_lt_1s", "cookie_rate", "referrer_rate",
        "http11_share", "http2_share", "ladder_sweep", "hourly_entropy")) + " FROM scored"
ORACLES["top_ua_ip_diversity"] = f"""WITH {ev()}, {CTES['agents']}
SELECT DISTINCT ua_full, ua_full_ip_diversity,
  {r6('ua_full_ip_diversity_ratio')}
FROM agents ORDER BY 2 DESC, 1, 3 DESC LIMIT 10"""
ORACLES["dq_scoring"] = f"""WITH {SCORED}, broken AS (
  SELECT *, CASE WHEN is_mobile_device THEN NULL ELSE iso_score * 2 END AS iso2 FROM scored)
SELECT * FROM (
  SELECT 'missing iso_score' AS issue, count(*) FILTER (WHERE iso2 IS NULL) AS cohorts FROM broken
  UNION ALL
  SELECT 'iso_score outside [0, 1]', count(*) FILTER (WHERE iso2 < 0 OR iso2 > 1) FROM broken)
WHERE cohorts > 0"""

_ROBOT_FIXED = {"origin": "'view'", "destination": "'D0'", "dep_date": "date", "referrer": "NULL",
                "cookie_present": "false", "http_version": "'1.1'", "user_agent_full": "'UA0'"}
ROBOTS = scored_sql(
    ev(2, 2, "REPLACE (" + ", ".join(
        f"CASE WHEN ip = '10.0.0.0' THEN {v} ELSE {c} END AS {c}"
        for c, v in _ROBOT_FIXED.items()) + ")"),
    "CASE WHEN top_signature_share <= 0.5 THEN 0.0 ELSE 1.0 END", 0.75, 0.55)
ORACLES["evidence_rows"] = f"""WITH {ROBOTS},
top AS (SELECT cohort_key, botness, risk_band FROM scored WHERE risk_band = 'High'
        ORDER BY botness DESC, cohort_key LIMIT 10),
drawn AS (
  SELECT top.*, ev.* EXCLUDE (cohort_key), row_number() OVER (
    PARTITION BY cohort_key ORDER BY sha1('42:' || row_id), row_id) AS no
  FROM ev JOIN top USING (cohort_key))
SELECT cohort_key, {r6('botness', 'botness_score')}, risk_band, CAST(no AS INTEGER) AS sample_no,
  row_id, epoch_us(ts) AS timestamp, origin, session_id, referrer, cookie_present,
  CAST(status_code AS DOUBLE) AS status_code, payload_signature
FROM drawn WHERE no <= 3"""
_TEXTS = ("cohort_key", "site", "partner", "ip", "user_agent", "ua_full", "risk_band")
_NUMBERS = ("ua_full_mode_share", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio",
            "rule_score", "iso_score", "botness", "n_events", "night_share",
            "top_signature_share", "repeat_ratio", "gap_p50", "max_run_lt_1s", "cookie_rate",
            "referrer_rate", "ladder_sweep", "hourly_entropy")


def _report_value(section: str, field: str, expr: str) -> str:
    return (f"SELECT '{section}', CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), '{field}', "
            f"CAST(NULL AS VARCHAR), {r6(expr, 'number')} FROM scored")


ORACLES["report_rows"] = f"""WITH {ROBOTS},
listed AS (
  SELECT *, lower(risk_band) || '_risk_cohorts' AS section, CAST(row_number() OVER (
    PARTITION BY risk_band ORDER BY botness DESC, cohort_key) AS INTEGER) AS rank
  FROM scored WHERE risk_band IN ('High', 'Medium'))
""" + " UNION ALL ".join([
    *[f"SELECT section, rank, cohort_key, '{c}' AS field, {c} AS text, "
      "CAST(NULL AS DOUBLE) AS number FROM listed WHERE rank <= 50" for c in _TEXTS],
    *[f"SELECT section, rank, cohort_key, '{c}', CAST(NULL AS VARCHAR), {r6(c, 'number')} "
      "FROM listed WHERE rank <= 50" for c in _NUMBERS],
    _report_value("summary", "total_cohorts", "count(*)"),
    *[_report_value("summary", f"{b.lower()}_risk_count",
                    f"count(*) FILTER (WHERE risk_band = '{b}')")
      for b in ("High", "Medium", "Low")],
    *[_report_value("statistics", f"{score}_{name}", f"{fn}({score})")
      for score in ("rule_score", "iso_score", "botness")
      for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))],
])
