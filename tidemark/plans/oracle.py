"""DuckDB SQL equal to each checkable query (same keys as ``catalog.QUERIES``).

DuckDB's ``extract(dow)`` is Sunday = 0.  Carried values are as-of lookups here, so these
queries check the operators' windows by another route.
"""

from __future__ import annotations

WL_BENCH = """
SELECT n.n_name AS location, CAST(l.l_shipdate AS DATE) AS date,
       MAX(l.l_extendedprice) AS temp_max_c, MIN(l.l_extendedprice) AS temp_min_c,
       CAST(COUNT(*) AS DOUBLE) AS precipitation_mm
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2"""

WL_SMALL = """
SELECT event_type AS location, CAST(ts AS DATE) AS date, MAX(value) AS temp_max_c,
       MIN(value) AS temp_min_c, CAST(COUNT(*) AS DOUBLE) AS precipitation_mm
FROM events GROUP BY 1, 2"""

RL = """
SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS fx_rate FROM orders
WHERE extract(dow FROM o_orderdate) NOT IN (0, 6) GROUP BY 1"""

# One row per day from the first to the last published one.  The day itself is arithmetic
# on a number; its rate is looked up as of that day; it is published if a rate has its date.
FX_FILLED = f"""
rl AS ({RL}),
span AS (SELECT min(date) AS first_day, max(date) - min(date) AS n FROM rl),
days AS (SELECT first_day + CAST(i AS INTEGER) AS date FROM span, range(0, 200000) t(i) WHERE i <= n),
fx AS (SELECT days.date, rl.fx_rate, days.date IN (SELECT date FROM rl) AS is_published_rate
       FROM days ASOF JOIN rl ON days.date >= rl.date)"""

D8 = f"""
WITH wl AS ({WL_BENCH}), {FX_FILLED}
SELECT wl.location, wl.date, wl.temp_max_c, wl.temp_min_c,
       wl.temp_max_c - wl.temp_min_c AS temp_range_c, wl.precipitation_mm,
       fx.fx_rate AS fx_usd_mxn, fx.is_published_rate AS fx_is_published_rate,
       extract(dow FROM wl.date) NOT IN (0, 6) AS is_business_day
FROM wl LEFT JOIN fx ON wl.date = fx.date"""

LOCF_BY_ENTITY = f"""
WITH wl AS (SELECT location, date, temp_max_c FROM ({WL_BENCH})
            WHERE extract(dow FROM date) NOT IN (0, 6)),
days AS (SELECT s.location, s.first_day + CAST(i AS INTEGER) AS date
         FROM (SELECT location, min(date) AS first_day, max(date) - min(date) AS n
               FROM wl GROUP BY ALL) s JOIN range(0, 200000) t(i) ON i <= s.n)
SELECT days.location, days.date, wl.temp_max_c, wl.date = days.date AS is_observed
FROM days ASOF JOIN wl ON days.location = wl.location AND days.date >= wl.date"""

UPSERT_INPUTS = f"""
wl AS ({WL_BENCH}),
t AS (SELECT * FROM wl WHERE date < DATE '2001-01-01'),
b AS (SELECT location, date, temp_max_c + 1 AS temp_max_c, temp_min_c,
             precipitation_mm + 100 AS precipitation_mm FROM wl WHERE date >= DATE '2000-12-22')"""

MART_INPUTS = f"""
src AS ({D8}),
t AS (SELECT location, date, temp_max_c + 0.5 AS temp_max_c, temp_min_c, temp_range_c,
             precipitation_mm, fx_usd_mxn, fx_is_published_rate, is_business_day
      FROM src WHERE date < DATE '2001-06-01'),
cut AS (SELECT CAST(coalesce(max(date), DATE '1970-01-01') - INTERVAL 10 DAY AS DATE) AS c FROM t)"""

def _report(table: str, checks: list[tuple[str, str, str]]) -> str:
    """checks: (check_name, column_name, failing-row condition)."""
    parts = [f"SELECT '{n}' AS check_name, '{c}' AS column_name, "
             f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM {table}"
             for n, c, cond in checks]
    return " UNION ALL ".join(parts)


def _status(inner: str) -> str:
    return (f"SELECT check_name, column_name, failures, "
            f"CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({inner})")


# Profiled columns of the two tables: (name, type, gets min/max/distinct).
PROFILE_COLUMNS = {
    "orders": [("o_orderkey", "BIGINT", True), ("o_custkey", "BIGINT", True),
               ("o_orderstatus", "VARCHAR", False), ("o_totalprice", "DOUBLE", True),
               ("o_orderdate", "TIMESTAMP", True), ("o_orderpriority", "VARCHAR", False)],
    "events": [("event_id", "BIGINT", True), ("ts", "TIMESTAMP", True),
               ("user_id", "BIGINT", True), ("event_type", "VARCHAR", False),
               ("value", "DOUBLE", True), ("props", "VARCHAR", False)],
}


def _profile(table: str) -> str:
    parts = []
    for name, typ, prof in PROFILE_COLUMNS[table]:
        lo = f"CAST(min({name}) AS VARCHAR)" if prof else "CAST(NULL AS VARCHAR)"
        hi = f"CAST(max({name}) AS VARCHAR)" if prof else "CAST(NULL AS VARCHAR)"
        dc = f"CAST(count(DISTINCT {name}) AS BIGINT)" if prof else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{typ}' AS data_type, "
            f"CAST(count(*) AS BIGINT) AS row_count, "
            f"CAST(round(100.0 * count(*) FILTER (WHERE {name} IS NULL) / count(*), 2) AS DOUBLE)"
            f" AS null_pct, {lo} AS min_value, {hi} AS max_value, {dc} AS distinct_count "
            f"FROM {table}")
    return " UNION ALL ".join(parts)


INJECTED_D8 = f"""
wl0 AS ({WL_BENCH}),
last AS (SELECT location, max(date) AS date FROM wl0 GROUP BY 1),
wl AS (SELECT wl0.location, wl0.date,
              CASE WHEN last.location IS NOT NULL THEN 5.0 ELSE wl0.temp_max_c END AS temp_max_c,
              CASE WHEN last.location IS NOT NULL THEN 25.0 ELSE wl0.temp_min_c END AS temp_min_c,
              wl0.precipitation_mm
       FROM wl0 LEFT JOIN last ON wl0.location = last.location AND wl0.date = last.date),
{FX_FILLED},
d8 AS (SELECT wl.location, wl.date, wl.temp_max_c, wl.temp_min_c,
       wl.temp_max_c - wl.temp_min_c AS temp_range_c, wl.precipitation_mm,
       fx.fx_rate AS fx_usd_mxn, fx.is_published_rate AS fx_is_published_rate,
       extract(dow FROM wl.date) NOT IN (0, 6) AS is_business_day
       FROM wl LEFT JOIN fx ON wl.date = fx.date)"""

PLAN = """
s AS (SELECT DISTINCT user_id AS source, 1 + user_id % 5 AS lag_days FROM events),
st AS (SELECT user_id AS source,
              CASE WHEN user_id % 7 = 0 THEN NULL ELSE max(CAST(ts AS DATE)) END AS last_watermark
       FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY user_id),
j AS (SELECT s.source, st.last_watermark,
             CAST(DATE '2024-01-31' - CAST(s.lag_days AS INTEGER) AS DATE) AS window_end
      FROM s LEFT JOIN st ON s.source = st.source),
plan AS (SELECT source, last_watermark,
                CASE WHEN last_watermark IS NOT NULL THEN CAST(last_watermark + 1 AS DATE)
                     ELSE CAST(window_end - 30 AS DATE) END AS window_start, window_end FROM j),
planned AS (SELECT *, window_start <= window_end AS has_work FROM plan)"""

BATCH = f"""{PLAN},
batch AS (SELECT e.event_id, e.user_id AS source, e.event_type, CAST(e.ts AS DATE) AS date, e.value
          FROM events e JOIN planned p ON e.user_id = p.source
          WHERE p.has_work AND CAST(e.ts AS DATE) BETWEEN p.window_start AND p.window_end)"""

SQL = {
    "src_parallel_arrays": f"""WITH wl AS ({WL_SMALL}),
r AS (SELECT *, row_number() OVER (PARTITION BY location, date_trunc('month', date) ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY location, date_trunc('month', date)) AS n FROM wl)
SELECT location, date, temp_max_c, temp_min_c, precipitation_mm,
       TIMESTAMP '2024-02-01 00:00:00' AS extracted_at FROM r WHERE rn <= n - 3""",
    "src_nested_points": f"""WITH rl AS ({RL})
SELECT 'fx_usd_mxn' AS series, date, fx_rate AS value,
       TIMESTAMP '2024-02-01 00:00:00' AS extracted_at FROM rl""",
    "staging_cast": """
SELECT event_type AS series, CAST(CAST(CAST(ts AS DATE) AS VARCHAR) AS DATE) AS date,
       CAST(CAST(value AS VARCHAR) AS DOUBLE) AS fx_rate, ts AS extracted_at
FROM events WHERE event_type = 'click'""",
    "plan_windows": f"WITH {PLAN} SELECT * FROM planned",
    "two_run_build": D8,
    "late_corrections": D8,
    "carry_by_load": LOCF_BY_ENTITY,
    "profile_kept": f"""SELECT * EXCLUDE (distinct_count),
       CASE WHEN distinct_count IS NOT NULL THEN TRUE END AS distinct_close
FROM ({_profile("orders")})""",
    "asof_last_click": """
WITH click AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value
               FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.event_type, e.ts, click.ts AS click_ts,
       click.event_id AS click_event_id, click.value AS click_value
FROM events e ASOF LEFT JOIN click ON e.user_id = click.user_id AND e.ts > click.ts""",
    "asof_recent_purchase": """
WITH bought AS (SELECT ts, max(event_id) AS event_id, arg_max(user_id, event_id) AS user_id
                FROM events WHERE event_type = 'purchase' GROUP BY 1),
found AS (SELECT e.event_id, e.ts, e.value, bought.ts AS p_ts, bought.event_id AS p_event,
                 bought.user_id AS p_user, bought.ts >= e.ts - INTERVAL 10 MINUTE AS near
          FROM events e ASOF LEFT JOIN bought ON e.ts >= bought.ts WHERE e.event_type = 'error')
SELECT event_id, ts, value, CASE WHEN near THEN p_ts END AS purchase_ts,
       CASE WHEN near THEN p_event END AS purchase_event_id,
       CASE WHEN near THEN p_user END AS purchase_user_id FROM found""",
    "stream_ingest": """
SELECT event_id, CAST(ts AS DATE) AS date, ts, user_id, event_type, value FROM events""",
    "windowed_batch": f"WITH {BATCH} SELECT * FROM batch",
    "watermark_after": f"""WITH {BATCH},
loaded AS (SELECT source, count(*) AS n FROM batch GROUP BY 1)
SELECT p.source, CASE WHEN p.has_work AND coalesce(l.n, 0) > 0 THEN p.window_end
                      ELSE p.last_watermark END AS last_watermark,
       CAST(coalesce(l.n, 0) AS BIGINT) AS rows_loaded
FROM planned p LEFT JOIN loaded l ON p.source = l.source""",
    "business_day_flag": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
       CAST(extract(dow FROM CAST(o_orderdate AS DATE)) AS BIGINT) AS day_of_week,
       extract(dow FROM CAST(o_orderdate AS DATE)) NOT IN (0, 6) AS is_business_day
FROM orders""",
    "calendar_spine": """
SELECT first_day + CAST(i AS INTEGER) AS date
FROM (SELECT CAST(min(o_orderdate) AS DATE) AS first_day,
             CAST(max(o_orderdate) AS DATE) - CAST(min(o_orderdate) AS DATE) AS n FROM orders) s
JOIN range(0, 200000) t(i) ON i <= n""",
    "locf_global": f"WITH {FX_FILLED} SELECT date, fx_rate, is_published_rate FROM fx",
    "locf_global_bucketed": f"WITH {FX_FILLED} SELECT date, fx_rate, is_published_rate FROM fx",
    "locf_increment": f"""WITH {FX_FILLED}
SELECT date, fx_rate, is_published_rate FROM fx WHERE date >= DATE '2001-01-01'""",
    "enrich_daily": D8,
    "model_views": D8,
    "locf_minute": """
WITH obs AS (SELECT date_trunc('minute', ts) AS ts, max(value) AS value FROM events GROUP BY 1),
grid AS (SELECT lo + to_minutes(CAST(i AS BIGINT)) AS ts
         FROM (SELECT min(ts) AS lo, datediff('minute', min(ts), max(ts)) AS n FROM obs) s
         JOIN range(0, 10000000) t(i) ON i <= n)
SELECT grid.ts, obs.value, obs.ts = grid.ts AS is_observed
FROM grid ASOF JOIN obs ON grid.ts >= obs.ts""",
    "locf_by_entity": LOCF_BY_ENTITY,
    "locf_by_entity_bucketed": LOCF_BY_ENTITY,
    "upsert_replace": f"""WITH {UPSERT_INPUTS}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.location = t.location AND b.date = t.date)
UNION ALL SELECT * FROM b""",
    "upsert_partial": f"""WITH {UPSERT_INPUTS}
SELECT coalesce(t.location, b.location) AS location, coalesce(t.date, b.date) AS date,
       CASE WHEN b.location IS NOT NULL THEN b.temp_max_c ELSE t.temp_max_c END AS temp_max_c,
       CASE WHEN b.location IS NOT NULL THEN b.temp_min_c ELSE t.temp_min_c END AS temp_min_c,
       CASE WHEN t.location IS NOT NULL THEN t.precipitation_mm ELSE b.precipitation_mm END
         AS precipitation_mm
FROM t FULL OUTER JOIN b ON t.location = b.location AND t.date = b.date""",
    "incremental_mart": f"""WITH {MART_INPUTS},
sel AS (SELECT * FROM src WHERE date >= (SELECT c FROM cut))
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM sel WHERE sel.location = t.location AND sel.date = t.date)
UNION ALL SELECT * FROM sel""",
    "full_rebuild": D8,
    "window_replace": f"""WITH {MART_INPUTS},
gone AS (SELECT location, max(date) AS date FROM t
         WHERE location = (SELECT min(location) FROM t) GROUP BY 1),
trimmed AS (SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.location = src.location AND gone.date = src.date))
SELECT * FROM t WHERE date < (SELECT c FROM cut)
UNION ALL SELECT * FROM trimmed WHERE date >= (SELECT c FROM cut)""",
    "dq_not_null": f"""WITH wl0 AS ({WL_BENCH}),
wl AS (SELECT location, date, temp_max_c,
              CASE WHEN precipitation_mm = 1 THEN NULL ELSE temp_min_c END AS temp_min_c FROM wl0)
""" + _status(_report("wl", [("not_null", c, f"{c} IS NULL")
                             for c in ("location", "date", "temp_max_c", "temp_min_c")])),
    "dq_accepted_range": f"""WITH d80 AS ({D8}),
d8 AS (SELECT CASE WHEN day(date) = 15 THEN CAST('NaN' AS DOUBLE) ELSE fx_usd_mxn END
              AS fx_usd_mxn FROM d80)
""" + _status(_report("d8", [("accepted_range", "fx_usd_mxn",
                              "NOT (fx_usd_mxn >= 450000.0) OR NOT (fx_usd_mxn <= 495000.0)")])),
    "dq_unique_combination": """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_row_rule": f"WITH {INJECTED_D8} SELECT * FROM d8 WHERE temp_max_c < temp_min_c",
    "dq_report": f"""WITH d8 AS ({D8}),
dups AS (SELECT 'unique_combination' AS check_name, 'location,date' AS column_name,
                CAST(count(*) AS BIGINT) AS failures
         FROM (SELECT location, date FROM d8 GROUP BY 1, 2 HAVING count(*) > 1))
""" + _status(_report("d8", [
        ("not_null", "location", "location IS NULL"),
        ("not_null", "date", "date IS NULL"),
        ("accepted_range", "fx_usd_mxn", "NOT (fx_usd_mxn >= 5) OR NOT (fx_usd_mxn <= 50)"),
        ("max_not_below_min", "temp_max_c,temp_min_c", "temp_max_c < temp_min_c"),
    ]) + " UNION ALL SELECT * FROM dups"),
    "failing_row_trace": f"""WITH {INJECTED_D8},
bad AS (
  SELECT location, date, temp_max_c, temp_min_c, fx_usd_mxn, 'max_not_below_min' AS check_name
  FROM d8 WHERE temp_max_c < temp_min_c
  UNION ALL
  SELECT location, date, temp_max_c, temp_min_c, fx_usd_mxn, 'accepted_range'
  FROM d8 WHERE fx_usd_mxn NOT BETWEEN 450000.0 AND 495000.0
  UNION ALL
  SELECT location, max(date) + 400, NULL, NULL, NULL, 'not_null' FROM d8 GROUP BY 1),
raw AS (SELECT n.n_name AS location, CAST(l.l_shipdate AS DATE) AS date, l.l_orderkey,
               l.l_linenumber, l.l_extendedprice
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey),
last_day AS (SELECT max(date) AS d FROM rl)
SELECT bad.*, raw.l_orderkey AS raw_l_orderkey, raw.l_linenumber AS raw_l_linenumber,
       raw.l_extendedprice AS raw_l_extendedprice, raw.l_orderkey IS NOT NULL AS raw_found,
       r.date AS rate_day, r.fx_rate AS raw_fx_rate, r.date IS NOT NULL AS found
FROM bad LEFT JOIN raw ON bad.location = raw.location AND bad.date = raw.date
LEFT JOIN rl r ON bad.date <= (SELECT d FROM last_day)
     AND r.date = (SELECT max(x.date) FROM rl x WHERE x.date <= bad.date)""",
    "contract_diff": """
WITH o AS (SELECT min(date_trunc('month', o_orderdate)) AS m1 FROM orders),
e AS (SELECT min(date_trunc('month', ts)) AS m1 FROM events),
e2 AS (SELECT min(date_trunc('month', ts)) AS m2 FROM events
       WHERE date_trunc('month', ts) > (SELECT m1 FROM e))
SELECT 'orders' AS table_name, CAST(m1 AS DATE) AS partition, 'o_totalprice' AS column_name,
       'missing' AS issue, 'double' AS expected_type, NULL AS actual_type FROM o
UNION ALL SELECT 'orders', CAST(m1 AS DATE), 'o_totalprice_old', 'extra', NULL, 'double' FROM o
UNION ALL SELECT 'events', CAST(m1 AS DATE), 'event_type', 'missing', 'string', NULL FROM e
UNION ALL SELECT 'events', CAST(m1 AS DATE), 'event_type_old', 'extra', NULL, 'string' FROM e
UNION ALL SELECT 'events', CAST(m2 AS DATE), 'value', 'type_mismatch', 'double', 'string' FROM e2
WHERE m2 IS NOT NULL""",
    "landing_late_files": f"""SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS extracted_at
FROM ({WL_SMALL})""",
    "landing_revisions": f"""WITH wl AS ({WL_SMALL})
SELECT location, date, temp_max_c + CASE WHEN date >= DATE '2024-01-15' THEN 1000 ELSE 0 END
         AS temp_max_c, temp_min_c, precipitation_mm,
       TIMESTAMP '2024-02-01 00:00:00' AS extracted_at FROM wl""",
    "freshness_report": """
SELECT event_type AS source, max(ts) AS last_loaded_at, max(CAST(ts AS DATE)) AS last_date,
       CAST(count(*) AS BIGINT) AS row_count FROM events GROUP BY 1""",
    "profile_table": _profile("orders") + " UNION ALL " + _profile("events"),
}
