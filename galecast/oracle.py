"""DuckDB SQL for every registered query, written independently of the Spark plans."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

WX = f"""
wx AS (
  SELECT event_id, user_id AS ville_id, CAST(ts AS DATE) AS date_prevision, ts AS retrieved_at,
    CASE WHEN event_type = 'error' AND k % 5 = 0 THEN NULL ELSE k * 0.75e0 - 12.5e0 END AS temperature_max,
    k * 0.75e0 - 12.5e0 - 12e0 + (event_id % 16) AS temperature_min,
    CASE WHEN event_type = 'signup' AND k % 7 = 0 THEN NULL
         WHEN event_type = 'error' AND k % 11 = 0 THEN -1e0 ELSE value / 16e0 END AS precipitation_sum,
    CAST((k * 7) % 101 AS DOUBLE) AS precipitation_probability_max,
    CASE WHEN k = 29 THEN 130e0 ELSE ((k * 37) % 100) * 0.375e0 END AS wind_speed_max,
    CASE WHEN k = 29 THEN 255e0 ELSE ((k * 37) % 100) * 0.75e0 END AS wind_gusts_max,
    k AS weather_code
  FROM (SELECT *, {K} AS k FROM events)
)"""

RULES = {
    "temperature_order": "temperature_min > temperature_max",
    "temperature_max": "temperature_max < -10 OR temperature_max > 55",
    "temperature_min": "temperature_min < -10 OR temperature_min > 55",
    "precipitation_sum": "precipitation_sum < 0 OR precipitation_sum > 500",
    "wind_speed_max": "wind_speed_max < 0 OR wind_speed_max > 250",
    "wind_gusts_max": "wind_gusts_max < 0 OR wind_gusts_max > 250",
}
PLAUSIBLE = " AND ".join(f"NOT COALESCE({broken}, FALSE)" for broken in RULES.values())


def _scored(source: str) -> str:
    """CTEs ``parts`` (sub-scores) and ``scored`` over a forecast-shaped relation."""
    return f"""
parts AS (
  SELECT *,
    GREATEST(GREATEST(0e0, LEAST(100e0, (temperature_max - 25e0) / 30e0 * 100e0)),
             GREATEST(0e0, LEAST(100e0, (10e0 - temperature_min) / 15e0 * 100e0))) AS temperature_risk,
    GREATEST(0e0, LEAST(100e0, precipitation_sum / 20e0 * 100e0)) AS precipitation_risk,
    GREATEST(0e0, LEAST(100e0, wind_gusts_max / 70e0 * 100e0)) AS wind_risk
  FROM {source} WHERE {PLAUSIBLE}
),
graded AS (
  SELECT *, CAST(round_even(
      (temperature_risk * 0.3e0 + precipitation_risk * 0.4e0 + wind_risk * 0.3e0) * 0.7e0
      + GREATEST(temperature_risk, precipitation_risk, wind_risk) * 0.3e0, 0) AS INTEGER) AS risk_score
  FROM parts
),
scored AS (
  SELECT *, CASE WHEN risk_score < 30 THEN 'faible' WHEN risk_score < 60 THEN 'moyen' ELSE 'élevé' END AS risk_level
  FROM graded
)"""


SCORED = f"{WX},{_scored('wx')}"


def _latest(source: str, name: str = "latest") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id, date_prevision
                                 ORDER BY retrieved_at DESC, event_id DESC) AS place FROM {source})
  WHERE place = 1
)"""


LATEST = f"{SCORED},{_latest('scored')}"
CITIES = """
villes AS (
  SELECT c_custkey AS id, c_name AS city, c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude,
         r_name AS region
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
)"""
WAREHOUSE = f"{LATEST},{CITIES}"
BATCHED = """
batched AS (
  SELECT *, CAST(position // 100 + 1 AS BIGINT) AS batch_no, CAST(position % 100 AS INTEGER) AS pos
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS position FROM customer)
)"""
CHECKED = f"""{BATCHED},
checked AS (
  SELECT batch_no, COUNT(*) AS n_requested,
         COUNT(*) FILTER (c_custkey IN (SELECT user_id FROM events)) AS n_received
  FROM batched GROUP BY batch_no
)"""
VIEW = """city, latitude, longitude, date_prevision, temperature_max, temperature_min, precipitation_sum,
  precipitation_probability_max, wind_speed_max, wind_gusts_max, risk_score, risk_level"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _top(value: str, name: str) -> str:
    return _with(WAREHOUSE, f"""
SELECT city, {value} AS {name} FROM latest JOIN villes ON id = ville_id GROUP BY city
ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 10""")


def _picked(region: str | None, extra: str = "", period: int | None = None) -> str:
    """Latest versions under a selection, from the filtered serving rows as the dashboard does it."""
    region_test = f"region = '{region}'" if region else "TRUE"
    window = f"date_prevision <= (SELECT MIN(date_prevision) FROM chosen) + {period - 1}" if period else "TRUE"
    return f"""{WAREHOUSE},
chosen AS (SELECT * FROM latest JOIN villes ON id = ville_id WHERE {region_test}),
picked AS (SELECT * FROM chosen WHERE {window} {extra})"""


PICKED_ROWS = "SELECT city, date_prevision, risk_score, risk_level FROM picked"
KPIS = """
SELECT COUNT(DISTINCT city) AS n_cities, MAX(temperature_max) AS temperature_max,
       MAX(precipitation_sum) AS precipitation_max,
       COUNT(*) FILTER (risk_level = 'élevé') AS n_high_risk,
       (SELECT city FROM {rows} GROUP BY city ORDER BY AVG(risk_score) DESC, city LIMIT 1) AS riskiest_city
FROM {rows}"""


def _unpivot(label: str, value: str, entries: dict[str, str], ctes: str, source: str) -> str:
    lines = [f"SELECT '{n}' AS {label}, CAST({e} AS BIGINT) AS {value} FROM {source}" for n, e in entries.items()]
    return (_with(ctes, "") if ctes else "") + "\nUNION ALL\n".join(lines)


def _null_counts(columns: tuple[str, ...]) -> dict[str, str]:
    return {c: f"COUNT(*) FILTER ({c} IS NULL)" for c in columns}


def _orphans(name: str, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return f"""
SELECT '{name}' AS relation, COUNT(DISTINCT {child_key}) AS n_keys, COUNT(*) AS n_rows FROM {child} c
WHERE {child_key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{child_key})"""


LINE_ORDER = """l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate"""

ORACLE: dict[str, str] = {
    "q1_max_temp": _top("MAX(temperature_max)", "temperature_max_observee"),
    "q2_max_precip": _top("MAX(precipitation_sum)", "precipitation_max_observee"),
    "q3_avg_risk": _top("ROUND(AVG(risk_score), 1)", "risque_moyen"),
    "q4_risk_by_day": _with(LATEST, """
SELECT date_prevision, ROUND(AVG(risk_score), 1) AS risque_moyen_ce_jour,
       MAX(risk_score) AS risque_maximal_observe_ce_jour
FROM latest GROUP BY date_prevision"""),
    "q5_worst_day": _with(WAREHOUSE, """
SELECT city, date_prevision AS periode_la_plus_a_risque, risk_score, risk_level
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id ORDER BY risk_score DESC, date_prevision) AS place
      FROM latest) JOIN villes ON id = ville_id
WHERE place = 1"""),
    "q6_above_average": _with(WAREHOUSE, """
SELECT city, ROUND(AVG(risk_score), 1) AS risque_moyen_ville
FROM latest JOIN villes ON id = ville_id GROUP BY city
HAVING SUM(risk_score) * (SELECT COUNT(*) FROM latest) > (SELECT SUM(risk_score) FROM latest) * COUNT(*)"""),
    "latest_version": _with(
        f"{WX},{_latest('wx')}", "SELECT event_id, ville_id, date_prevision, retrieved_at FROM latest"
    ),
    "latest_run": """
SELECT event_id, user_id AS ville_id, strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S') AS run_ts FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT MAX(strftime(ts, '%Y%m%d')) FROM events)""",
    "documents_clean": f"""
WITH d AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day, k FROM (SELECT *, {K} AS k FROM events)
           WHERE user_id % 7 <> 0 AND user_id % 11 <> 0),
first AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, day ORDER BY event_id) AS place FROM d) WHERE place = 1),
wx AS (SELECT user_id, day AS date_prevision, k - 10e0 AS temperature_max, k - 22e0 AS temperature_min, k - 1e0 AS precipitation_sum,
       k * 2e0 AS wind_speed_max, k * 3e0 AS wind_gusts_max, CAST(k AS DOUBLE) AS weather_code FROM first)
SELECT CAST(user_id AS VARCHAR) AS city, date_prevision, temperature_max, temperature_min, precipitation_sum, wind_gusts_max,
  weather_code, COALESCE(r_name, '-') AS region, {PLAUSIBLE} AS accepted,
  array_to_string(list_filter([{", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in RULES.items())}],
    lambda x: x IS NOT NULL), ',') AS violations
FROM wx LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey""",
    "documents_set_aside": f"""
WITH d AS (SELECT user_id, date_trunc('week', ts) AS week, event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {K} AS k FROM events),
w AS (SELECT user_id, CAST(CAST(week AS DATE) AS VARCHAR) AS week, list(day ORDER BY event_id) AS days, list(k ORDER BY event_id) AS ks
      FROM d GROUP BY ALL),
t AS (SELECT *, '{{"city":"' || user_id || '","lat":1.5,"lng":-2.5,"weather_raw":{{"daily":{{"time":["' || array_to_string(days, '","') || '"]'
  || ',"temperature_2m_max":[' || array_to_string(list_transform(ks, lambda k: k - 10), ',') || ']'
  || ',"temperature_2m_min":[' || array_to_string(list_transform(ks, lambda k: k - 22), ',') || ']'
  || ',"precipitation_sum":[' || array_to_string(list_transform(ks, lambda k: k - 1), ',') || ']'
  || ',"precipitation_probability_max":[' || array_to_string(ks, ',') || ']'
  || ',"wind_speed_10m_max":[' || array_to_string(list_transform(ks, lambda k: k * 2), ',') || ']'
  || ',"wind_gusts_10m_max":[' || array_to_string(list_transform(ks, lambda k: k * 3), ',') || ']'
  || ',"weather_code":[' || array_to_string(CASE WHEN user_id % 7 = 0 THEN ks[2:] ELSE ks END, ',') || ']}}}}}}' AS whole FROM w)
SELECT user_id, week AS source_split,
  CASE WHEN user_id % 11 = 0 THEN left(whole, length(whole) - 5) ELSE whole END AS text
FROM t WHERE user_id % 7 = 0 OR user_id % 11 = 0""",
    "risk_subscores": _with(
        SCORED, "SELECT event_id, temperature_risk, precipitation_risk, wind_risk FROM parts"
    ),
    "risk_score": _with(SCORED, "SELECT event_id, risk_score, risk_level FROM scored"),
    "weather_categories": _with(SCORED, """
SELECT CASE WHEN temperature_max < 25 THEN 'faible' WHEN temperature_max < 40 THEN 'moyen'
            WHEN temperature_max >= 40 THEN 'élevé' END AS temperature_category,
       CASE WHEN precipitation_sum < 5 THEN 'faible' WHEN precipitation_sum < 15 THEN 'moyen'
            WHEN precipitation_sum >= 15 THEN 'élevé' END AS precipitation_category,
       CASE WHEN wind_gusts_max < 40 THEN 'faible' WHEN wind_gusts_max < 60 THEN 'moyen'
            WHEN wind_gusts_max >= 60 THEN 'élevé' END AS wind_category,
       COUNT(*) AS n_rows
FROM scored GROUP BY ALL"""),
    "risk_level_distribution": _with(SCORED, """
SELECT CASE risk_level WHEN 'faible' THEN 1 WHEN 'moyen' THEN 2 ELSE 3 END AS level_rank, risk_level,
       COUNT(*) AS n_rows
FROM scored GROUP BY risk_level"""),
    "plausibility_filter": _with(WX, f"SELECT event_id, ville_id, date_prevision FROM wx WHERE {PLAUSIBLE}"),
    "plausibility_reject": _unpivot(
        "rule",
        "n_rows",
        {n: f"COUNT(*) FILTER ({b})" for n, b in RULES.items()}
        | {
            "rejected": f"COUNT(*) FILTER (NOT ({PLAUSIBLE}))",
            "accepted": f"COUNT(*) FILTER ({PLAUSIBLE})",
        },
        WX,
        "wx",
    ),
    "reject_reasons": _with(WX, f"""
SELECT event_id, concat_ws(',', {", ".join(f"CASE WHEN {b} THEN '{n}' END" for n, b in RULES.items())}) AS violations
FROM wx WHERE NOT ({PLAUSIBLE})"""),
    "dedup_first": f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS place
  FROM (SELECT * REPLACE (l_discount + 0e0 AS l_discount, l_tax + 0e0 AS l_tax) FROM lineitem))
WHERE place = 1""",
    "silver_rows": _with(f"""{WX},
firsts AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id, date_prevision ORDER BY event_id) AS place FROM wx)
  WHERE place = 1
),{_scored('firsts')}""", """
SELECT event_id, ville_id, date_prevision,
       CASE WHEN temperature_max < 25 THEN 'faible' WHEN temperature_max < 40 THEN 'moyen'
            WHEN temperature_max >= 40 THEN 'élevé' END AS temperature_category,
       CASE WHEN precipitation_sum < 5 THEN 'faible' WHEN precipitation_sum < 15 THEN 'moyen'
            WHEN precipitation_sum >= 15 THEN 'élevé' END AS precipitation_category,
       CASE WHEN wind_gusts_max < 40 THEN 'faible' WHEN wind_gusts_max < 60 THEN 'moyen'
            WHEN wind_gusts_max >= 60 THEN 'élevé' END AS wind_category,
       risk_score, risk_level
FROM scored"""),
    "coerce_types": f"""
WITH raw AS (
  SELECT event_id,
    CASE event_id % 8 WHEN 0 THEN ' ' || k || ' ' WHEN 1 THEN k || 'e2' WHEN 2 THEN 'abc' || k
      WHEN 3 THEN k || 'd' WHEN 4 THEN '0x' || k WHEN 5 THEN k || '_000' WHEN 6 THEN ''
      ELSE '-' || k || '.5' END AS number,
    CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d') || 'T05:00'
      WHEN 2 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y') || '-02-30' END AS day
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
)
SELECT event_id,
  CASE WHEN regexp_matches(trim(number), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')
       THEN TRY_CAST(trim(number) AS DOUBLE) END AS number,
  CAST(try_strptime(day, '%Y-%m-%d') AS DATE) AS day
FROM raw""",
    "json_extract_measures": f"SELECT event_id, {K} AS weather_code FROM events",
    "flatten_arrays": """
SELECT vec_id, label, CAST(place - 1 AS INTEGER) AS day_index, CAST(embedding[place] AS DOUBLE) AS component
FROM (SELECT *, unnest(generate_series(1, len(embedding))) AS place FROM embeddings)""",
    "batch_plan": _with(BATCHED, """
SELECT batch_no, MIN(position) AS first_row, MAX(position) AS last_row, COUNT(*) AS n_cities
FROM batched GROUP BY batch_no"""),
    "batch_params": _with(BATCHED, """
SELECT batch_no, string_agg(CAST(c_acctbal AS VARCHAR), ',' ORDER BY pos) AS latitude,
       string_agg(CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), ',' ORDER BY pos) AS longitude,
       'temperature_2m_max,temperature_2m_min,precipitation_sum,precipitation_probability_max,'
       || 'wind_speed_10m_max,wind_gusts_10m_max,weather_code' AS daily,
       7 AS forecast_days, 'auto' AS timezone
FROM batched GROUP BY batch_no"""),
    "envelope_normalise": f"""
SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE -1 END AS INTEGER) AS n_responses,
       CASE WHEN event_id % 4 < 3 THEN {K} ELSE -1 END AS first_k
FROM events""",
    "batch_validation": _with(
        CHECKED, "SELECT batch_no, n_requested, n_received, n_requested = n_received AS ok FROM checked"
    ),
    "dead_letter": _with(CHECKED, """
SELECT c_name AS city, batch_no FROM batched
WHERE batch_no NOT IN (SELECT batch_no FROM checked WHERE n_requested = n_received)"""),
    "positional_join": _with(BATCHED, """
SELECT batch_no, pos, c_name AS city, s_name FROM batched
JOIN (SELECT s_name, ROW_NUMBER() OVER (ORDER BY s_suppkey) - 1 AS position FROM supplier) USING (position)"""),
    "dq_duplicates": """
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, COUNT(*) FILTER (n > 1) AS n_duplicated_keys,
       CAST(SUM(n - 1) AS BIGINT) AS n_surplus_rows
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "dq_unique": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "dq_report": _unpivot(
        "metric",
        "n_rows",
        {
            "rows": "COUNT(*)",
            "cities_present": "COUNT(DISTINCT ville_id)",
            "cities_expected": "MAX((SELECT COUNT(*) FROM customer))",
            "cities_expected_distinct": "MAX((SELECT COUNT(DISTINCT c_custkey) FROM customer))",
        }
        | {
            f"missing_{c}": e
            for c, e in _null_counts(
                ("ville_id", "date_prevision", "temperature_max", "precipitation_sum")
            ).items()
        },
        SCORED,
        "scored",
    ),
    "dq_not_null": _unpivot(
        "column_name",
        "n_missing",
        _null_counts(("ville_id", "date_prevision", "retrieved_at", "temperature_max", "precipitation_sum")),
        WX,
        "wx",
    ),
    "dq_text_length": _unpivot(
        "column_name",
        "n_too_long",
        {c: f"COUNT(*) FILTER (length({c}) > {n})" for c, n in (("text", 150), ("lang", 20), ("source", 20))},
        "",
        "documents",
    ),
    "dq_stage_counts": _unpivot(
        "stage",
        "n_rows",
        {
            "flattened": "COUNT(*)",
            "deduplicated": "COUNT(*) FILTER (place = 1)",
            "accepted": f"COUNT(*) FILTER (place = 1 AND {PLAUSIBLE})",
            "rejected": f"COUNT(*) FILTER (place = 1 AND NOT ({PLAUSIBLE}))",
        },
        f"""{WX},
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id, date_prevision ORDER BY event_id) AS place FROM wx
)""",
        "ranked",
    ),
    "dq_referential": "\nUNION ALL\n".join(
        (
            _orphans("orders-customer", "orders", "o_custkey", "customer", "c_custkey"),
            _orphans("events-customer", "events", "user_id", "customer", "c_custkey"),
            _orphans("customer-events", "customer", "c_custkey", "events", "user_id"),
            _orphans("documents-labels", "documents", "doc_id", "labels", "doc_id"),
        )
    ),
    "enrich_left_join": """
SELECT d.doc_id, lang, source, COALESCE(quality, -1) AS quality, COALESCE(toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "unmatched_keys": """
SELECT DISTINCT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NULL""",
    "surrogate_lookup": """
SELECT o_orderkey, c_custkey AS ville_id FROM orders
JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""",
    "dim_upsert": _with(f"""{CITIES},
existing AS (SELECT * FROM villes WHERE region <> 'ASIA'),
incoming AS (
  SELECT id, city, latitude + 1 AS latitude, longitude, CASE WHEN latitude >= 0 THEN region END AS region
  FROM villes WHERE id IN (SELECT user_id FROM events)
),
added AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY id) AS n FROM incoming WHERE city NOT IN (SELECT city FROM existing)
)""", """
SELECT COALESCE(e.id, (SELECT MAX(id) FROM existing) + a.n) AS id, COALESCE(e.city, i.city) AS city,
       CASE WHEN i.city IS NOT NULL THEN i.latitude ELSE e.latitude END AS latitude,
       CASE WHEN i.city IS NOT NULL THEN i.longitude ELSE e.longitude END AS longitude,
       COALESCE(CASE WHEN i.city IS NOT NULL THEN i.region ELSE e.region END, '-') AS region
FROM existing e FULL JOIN incoming i ON i.city = e.city LEFT JOIN added a ON a.city = i.city"""),
    "dim_upsert_parts": _with(f"""{CITIES},
placed AS (SELECT id, city, floor(latitude / 128) AS latitude, floor(longitude) AS longitude, region FROM villes),
existing AS (SELECT * FROM placed WHERE region <> 'ASIA'),
incoming AS (
  SELECT city, latitude + 1 AS latitude, longitude, CASE WHEN latitude >= 0 THEN region END AS region
  FROM placed WHERE id IN (SELECT user_id FROM events)
)""", """
SELECT COALESCE(e.city, i.city) AS city,
       CASE WHEN i.city IS NOT NULL THEN i.latitude ELSE e.latitude END AS latitude,
       CASE WHEN i.city IS NOT NULL THEN i.longitude ELSE e.longitude END AS longitude,
       COALESCE(CASE WHEN i.city IS NOT NULL THEN i.region ELSE e.region END, '-') AS region,
       e.city IS NOT NULL AS kept
FROM existing e FULL JOIN incoming i ON i.city = e.city"""),
    "fact_insert_absent": _with(WX, """
SELECT event_id, ville_id, date_prevision, retrieved_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id, date_prevision, retrieved_at ORDER BY event_id) AS place FROM wx) n
WHERE place = 1 AND NOT EXISTS (
  SELECT 1 FROM events o WHERE o.event_type <> 'signup' AND o.user_id = n.ville_id AND o.ts = n.retrieved_at)"""),
    "numeric_cast": """
SELECT l_orderkey, l_linenumber,
       COALESCE(CAST(TRY_CAST(l_extendedprice AS DECIMAL(6, 2)) AS VARCHAR), '') AS price,
       CAST(CAST(l_quantity AS DECIMAL(5, 2)) AS VARCHAR) AS quantity,
       l_extendedprice IS NULL OR TRY_CAST(l_extendedprice AS DECIMAL(6, 2)) IS NOT NULL AS fits
FROM lineitem""",
    "run_ts_roundtrip": """
SELECT event_id, run_ts, strptime(run_ts, '%Y%m%d_%H%M%S') AS retrieved_at,
       regexp_extract('bronze/meteo/meteo_' || run_ts || '.json', '(\\d{8}_\\d{6})', 1) AS run_in_name,
       CAST(strptime(run_ts, '%Y%m%d_%H%M%S') AS DATE) AS run_date
FROM (SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_ts FROM events)""",
    "serving_view": _with(WAREHOUSE, f"SELECT {VIEW} FROM latest JOIN villes ON id = ville_id"),
    "dash_options": _with(WAREHOUSE, """
SELECT DISTINCT 'city' AS filter, city AS option FROM latest JOIN villes ON id = ville_id
UNION ALL
SELECT DISTINCT 'date', CAST(date_prevision AS VARCHAR) FROM latest"""),
    "dash_filter_city": _with(_picked("EUROPE"), PICKED_ROWS),
    "dash_filter_period": _with(_picked("AFRICA", period=3), PICKED_ROWS),
    "dash_filter_combo": _with(
        _picked(
            "EUROPE",
            "AND date_prevision IN (DATE '2024-01-02', DATE '2024-01-05') AND risk_level IN ('moyen', 'élevé')",
            period=7,
        ),
        PICKED_ROWS,
    ),
    "dash_kpis": _with(_picked(None), KPIS.format(rows="picked")),
    "dash_kpi_labels": _with(
        _picked(None, period=7) + f", k AS ({KPIS.format(rows='picked')})",
        """
SELECT CAST(n_cities AS VARCHAR) AS n_cities, printf('%.1f °C', temperature_max) AS temperature_max,
       printf('%.1f mm', precipitation_max) AS precipitation_max, CAST(n_high_risk AS VARCHAR) AS n_high_risk,
       riskiest_city FROM k""",
    ),
    "dash_top_city": _with(WAREHOUSE, """
SELECT city, AVG(risk_score) AS mean_risk FROM latest JOIN villes ON id = ville_id
GROUP BY city ORDER BY mean_risk DESC, city LIMIT 1"""),
    "dash_map": _with(WAREHOUSE, """
SELECT city, latitude, longitude, date_prevision, risk_score, risk_level,
       CASE risk_level WHEN 'faible' THEN '#2ecc71' WHEN 'moyen' THEN '#f39c12' ELSE '#e74c3c' END AS colour
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ville_id ORDER BY risk_score DESC, date_prevision) AS place
      FROM latest) JOIN villes ON id = ville_id
WHERE place = 1"""),
    "dash_top10": _with(WAREHOUSE, """
SELECT city, round_even(AVG(risk_score) * 10, 0) / 10 AS risk_score FROM latest JOIN villes ON id = ville_id
GROUP BY city ORDER BY risk_score DESC, city LIMIT 10"""),
    "dash_detail": _with(WAREHOUSE, """
SELECT city, date_prevision, temperature_max, temperature_min, precipitation_sum, wind_gusts_max,
       risk_score, risk_level FROM latest JOIN villes ON id = ville_id"""),
}
# The same answers by other ways: stored states, an array document cut into ranges, a table kept current load by load.
ORACLE["dash_kpis_states"] = _with(_picked("EUROPE", period=7), KPIS.format(rows="picked"))
ORACLE["dash_top10_states"] = _with(_picked(None, "AND risk_level IN ('moyen', 'élevé')"), """
SELECT city, round_even(AVG(risk_score) * 10, 0) / 10 AS risk_score FROM picked
GROUP BY city ORDER BY risk_score DESC, city LIMIT 10""")
ORACLE["q4_states"] = ORACLE["q4_risk_by_day"]
ORACLE["q5_states"] = ORACLE["q5_worst_day"]
ORACLE["documents_array_split"] = ORACLE["documents_clean"]
ORACLE["latest_version_incremental"] = ORACLE["latest_version"]
