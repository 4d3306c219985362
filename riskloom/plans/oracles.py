"""The same results in plain SQL, written the long way round: separate
aggregates joined back together, and every batch re-normalised on its own."""

from __future__ import annotations

from riskloom.plans.catalogue import EARLIER_DAY, PARAMS
from riskloom.schemas import FEATURE_COLS, PROFILE_AXES

_DAILY = """daily AS (
  SELECT e.user_id, any_value(c.c_mktsegment) AS role,
    CAST(date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) AS INTEGER) AS day,
    CAST(CASE WHEN date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) % 7 >= 5
         THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(min(hour(e.ts)) AS INTEGER) AS login_hour,
    CAST(count(*) FILTER (e.event_type = 'view') AS BIGINT) AS files_accessed,
    CAST(count(*) FILTER (e.event_type = 'error') AS BIGINT) AS failed_logins,
    CAST(count(*) FILTER (e.event_type = 'purchase') AS BIGINT) AS sensitive_files,
    CAST(count(*) FILTER (e.event_type = 'click') AS BIGINT) AS emails_sent,
    CAST(max(CASE WHEN e.value > 100 AND NOT isnan(e.value) THEN 1 ELSE 0 END) AS INTEGER) AS usb_usage,
    CAST(count(*) FILTER (hour(e.ts) < 6 OR hour(e.ts) >= 20) AS BIGINT) AS after_hours,
    CAST(max(CASE WHEN e.event_type = 'signup' THEN 1 ELSE 0 END) AS INTEGER) AS vpn_connections
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  GROUP BY e.user_id, CAST(e.ts AS DATE))"""


def _features(log: str = "daily", out: str = "feat") -> str:
    return f"""{out}_days AS (SELECT CAST(count(DISTINCT day) AS DOUBLE) AS d FROM {log}),
{out}_agg AS (
  SELECT user_id, coalesce(min(role), 'unknown') AS role,
    avg(login_hour) AS login_mean, coalesce(stddev_samp(login_hour), 0) AS login_std,
    avg(files_accessed) AS files_mean, CAST(max(files_accessed) AS DOUBLE) AS files_max,
    coalesce(stddev_samp(files_accessed), 0) AS files_std,
    CAST(sum(failed_logins) AS DOUBLE) AS failed_total,
    CAST(sum(sensitive_files) AS DOUBLE) AS sensitive_total,
    avg(emails_sent) AS emails_mean, CAST(max(emails_sent) AS DOUBLE) AS emails_max,
    CAST(sum(usb_usage) AS DOUBLE) AS usb_total,
    avg(after_hours) AS after_hours_mean, CAST(max(after_hours) AS DOUBLE) AS after_hours_max,
    CAST(sum(vpn_connections) AS DOUBLE) AS vpn_total
  FROM {log} GROUP BY user_id),
{out}_we AS (
  SELECT user_id, avg(files_accessed) AS weekend_files
  FROM {log} WHERE is_weekend = 1 GROUP BY user_id),
{out}_wd AS (
  SELECT user_id, avg(files_accessed) AS weekday_files
  FROM {log} WHERE is_weekend = 0 GROUP BY user_id),
{out} AS (
  SELECT a.*, sensitive_total / (files_mean * d + 1) AS sensitive_ratio,
    failed_total / d AS failed_login_rate, usb_total / d AS usb_rate, vpn_total / d AS vpn_rate,
    coalesce(weekend_files, 0) / (coalesce(weekday_files, 1) + 1) AS weekend_activity_ratio
  FROM {out}_agg a LEFT JOIN {out}_we USING (user_id) LEFT JOIN {out}_wd USING (user_id)
  CROSS JOIN {out}_days)"""


def _raw(log: str = "daily", out: str = "raw") -> str:
    return f"""{out} AS (
  SELECT *, CAST(0.2 AS DOUBLE) * sensitive_total + CAST(0.1 AS DOUBLE) * failed_total
    AS risk_score_raw
  FROM (SELECT user_id, coalesce(min(role), 'unknown') AS role,
          CAST(sum(sensitive_files) AS BIGINT) AS sensitive_total,
          CAST(sum(failed_logins) AS BIGINT) AS failed_total
        FROM {log} GROUP BY user_id))"""


def _level(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 75 THEN 'Critical' WHEN {score} >= 50 THEN 'High' "
        f"WHEN {score} >= 25 THEN 'Medium' ELSE 'Low' END"
    )


def _scored(raw: str = "raw", out: str = "scored") -> str:
    return f"""{out} AS (
  SELECT *, {_level("risk_score")} AS risk_level
  FROM (SELECT r.*, CASE WHEN mn = mx THEN 0.0::DOUBLE
          ELSE (risk_score_raw - mn) / (mx - mn) * 100::DOUBLE END AS risk_score
        FROM {raw} r
        CROSS JOIN (SELECT min(risk_score_raw) AS mn, max(risk_score_raw) AS mx FROM {raw})))"""


def _forest(features: str = "feat", depth: int = 8) -> str:
    """The isolation forest, one level of all trees after the other: 2^depth samples at most."""
    seed, trees, most = PARAMS.seed, PARAMS.forest.trees, PARAMS.forest.max_samples
    scaled = ", ".join(
        f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}"
        for c in FEATURE_COLS
    )
    number = lambda digest, at: f"CAST('0x' || substr({digest}, {at}, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"
    lists = ", ".join(f"[{i}, {c}]" for i, c in enumerate(FEATURE_COLS))
    parts = [
        f"scaled AS MATERIALIZED (SELECT user_id, {scaled} FROM {features})",
        f"""cells AS MATERIALIZED (SELECT user_id, CAST(pair[1] AS INTEGER) AS f, pair[2] AS x, round(pair[2], 9) AS v
  FROM (SELECT user_id, unnest([{lists}]) AS pair FROM scaled))""",
        f"""facts AS (SELECT *, greatest(1, least({trees}, CAST(floor(1 / p) AS BIGINT))) AS block
  FROM (SELECT *, least(1.0::DOUBLE, (psi + 4 * sqrt(psi)) / n) AS p, ceil(log2(greatest(psi, 2))) AS deepest
    FROM (SELECT count(*) AS n, least({most}, count(*)) AS psi FROM scaled)))""",
        f"""drawn AS (SELECT user_id, b, {number(f"md5('{seed}:' || user_id || ':' || b)", 1)} / p AS draw, block, psi
  FROM scaled, facts, range({trees}) AS blocks(b) WHERE b * block < {trees}),
sampled AS (SELECT CAST(b * block + floor(draw) AS INTEGER) AS tree, user_id, psi, draw - floor(draw) AS place
  FROM drawn WHERE draw < block AND b * block + floor(draw) < {trees}),
rows_0 AS MATERIALIZED (SELECT tree, user_id, '' AS path FROM sampled
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY place, user_id) <= psi)""",
    ]
    for d in range(depth + 1):
        digest = f"md5('{seed}:' || tree || ':' || path)"
        parts.append(
            f"""ranges_{d} AS (SELECT tree, path, f, min(v) AS low, max(v) AS high,
    row_number() OVER (PARTITION BY tree, path ORDER BY f) - 1 AS place, count(*) OVER (PARTITION BY tree, path) AS usable
  FROM rows_{d} JOIN cells USING (user_id) CROSS JOIN facts WHERE {d} < deepest
  GROUP BY tree, path, f HAVING min(v) < max(v)),
cuts_{d} AS MATERIALIZED (SELECT tree, path, f, low + {number(digest, 14)} * (high - low) AS cut
  FROM ranges_{d} WHERE place = floor({number(digest, 1)} * usable)),
rows_{d + 1} AS MATERIALIZED (SELECT tree, user_id, path || CASE WHEN v <= cut THEN '0' ELSE '1' END AS path
  FROM rows_{d} JOIN cuts_{d} USING (tree, path) JOIN cells USING (user_id, f))"""
        )
    cuts = " UNION ALL ".join(f"SELECT * FROM cuts_{d}" for d in range(depth + 1))
    rows = " UNION ALL ".join(f"SELECT * FROM rows_{d}" for d in range(depth + 2))
    parts.append(
        f"""cuts AS MATERIALIZED ({cuts}),
numbered AS MATERIALIZED (SELECT tree, path, n, f, cut, row_number() OVER (PARTITION BY tree ORDER BY path) - 1 AS node
  FROM (SELECT tree, path, count(*) AS n FROM ({rows}) GROUP BY tree, path) LEFT JOIN cuts USING (tree, path)),
nodes AS (SELECT a.tree, CAST(a.node AS INTEGER) AS node, coalesce(a.f, -1) AS feature, coalesce(a.cut, 0) AS threshold,
    CAST(coalesce(l.node, -1) AS INTEGER) AS "left", CAST(coalesce(r.node, -1) AS INTEGER) AS "right",
    CAST(a.n AS INTEGER) AS size, CAST(length(a.path) AS INTEGER) AS depth
  FROM numbered a LEFT JOIN numbered l ON l.tree = a.tree AND l.path = a.path || '0'
  LEFT JOIN numbered r ON r.tree = a.tree AND r.path = a.path || '1')"""
    )
    return ",\n".join(parts)


def _forest_scores(depth: int = 8) -> str:
    """Every user's way down every tree; the border is a quantile over all users."""
    path = lambda n: f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649) - 2 * ({n} - 1) / {n} WHEN {n} = 2 THEN 1 ELSE 0 END"
    parts = [
        f"at_0 AS (SELECT tree, user_id, '' AS path FROM range({PARAMS.forest.trees}) AS t(tree), scaled)"
    ]
    for d in range(depth + 1):
        parts.append(
            f"""at_{d + 1} AS MATERIALIZED (SELECT a.tree, a.user_id, CASE WHEN c.f IS NULL THEN a.path
    WHEN x <= cut THEN a.path || '0' ELSE a.path || '1' END AS path
  FROM at_{d} a LEFT JOIN cuts c ON c.tree = a.tree AND c.path = a.path
  LEFT JOIN cells v ON v.user_id = a.user_id AND v.f = c.f)"""
        )
    parts.append(
        f"""lengths AS (SELECT user_id, avg(length(path) + {path("n")}) AS way
  FROM at_{depth + 1} JOIN numbered USING (tree, path) GROUP BY user_id),
scores AS (SELECT user_id, -pow(2, -way / greatest({path("psi")}, 1e-12)) AS s FROM lengths, facts)"""
    )
    return ",\n".join(parts)


def _r(column: str) -> str:
    value = f"round({column}, 6)"
    return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END AS {column}"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_FEATURE_LIST = ", ".join(_r(c) for c in FEATURE_COLS)
_SCORED_LIST = (
    f"user_id, role, sensitive_total, failed_total, {_r('risk_score_raw')}, "
    f"{_r('risk_score')}, risk_level"
)
_BATCHES = """batches AS (
  SELECT *, CAST(least(10, n - (batch_num - 1) * 10) AS INTEGER) AS users_in_batch,
    CAST(least(batch_num * 10, n) AS INTEGER) AS total_users_processed
  FROM (SELECT user_id, n, CAST((pos - 1) // 10 + 1 AS INTEGER) AS batch_num,
          CAST((n + 9) // 10 AS INTEGER) AS total_batches
        FROM (SELECT user_id, row_number() OVER (ORDER BY user_id) AS pos, count(*) OVER () AS n
              FROM (SELECT DISTINCT user_id FROM daily))))"""
_REPLAY = """batches AS (
  SELECT user_id, CAST(user_id % 4 + 1 AS INTEGER) AS batch_num, CAST(4 AS INTEGER) AS total_batches,
    CAST(count(*) OVER (PARTITION BY user_id % 4) AS INTEGER) AS users_in_batch,
    CAST(count(*) OVER (ORDER BY user_id % 4 RANGE UNBOUNDED PRECEDING) AS INTEGER)
      AS total_users_processed
  FROM (SELECT DISTINCT user_id FROM daily))"""
_METADATA = f"""steps AS (
  SELECT DISTINCT batch_num, total_batches, users_in_batch, total_users_processed FROM batches),
state AS (
  SELECT s.*, r.risk_score_raw,
    min(r.risk_score_raw) OVER (PARTITION BY s.batch_num) AS mn,
    max(r.risk_score_raw) OVER (PARTITION BY s.batch_num) AS mx
  FROM steps s JOIN batches b ON b.batch_num <= s.batch_num JOIN raw r ON r.user_id = b.user_id),
metadata AS (
  SELECT batch_num, total_batches, users_in_batch, total_users_processed,
    CAST(count(*) FILTER (level = 'High') AS BIGINT) AS high_risk_count,
    CAST(count(*) FILTER (level = 'Critical') AS BIGINT) AS critical_risk_count
  FROM (SELECT *, {_level("CASE WHEN mn = mx THEN 0 ELSE (risk_score_raw - mn) / (mx - mn) * 100 END")}
          AS level FROM state)
  GROUP BY ALL)"""


def _count(level: str) -> str:
    return f"CAST(count(*) FILTER (risk_level = '{level}') AS BIGINT)"


def _breakdown() -> str:
    size = "CASE WHEN abs(risk_score) = 0 THEN 1 ELSE abs(risk_score) END"
    factors = [
        ("Isolation Forest", "0.3", "0"),
        ("One-Class SVM", "0.25", "0"),
        ("Autoencoder", "0.15", "0"),
        ("Sensitive Files", "0.2", "sensitive_total"),
        ("Failed Logins", "0.1", "failed_total"),
    ]
    return " UNION ALL ".join(
        f"SELECT user_id, '{name}' AS factor, round_even(CAST({w} AS DOUBLE) * {c} / ({size}) * 100, 1)"
        " AS contribution_pct FROM scored"
        for name, w, c in factors
    )


def oracles() -> dict[str, str]:
    daily, feat, raw, scored = _DAILY, _features(), _raw(), _scored()
    on_daily, on_features = _with(daily), _with(daily, feat)
    on_raw, on_scored = _with(daily, raw), _with(daily, raw, scored)
    on_metadata = _with(daily, raw, _BATCHES, _METADATA)
    features_sql = f"{on_features}SELECT user_id, role, {_FEATURE_LIST} FROM feat"
    scored_sql = f"{on_scored}SELECT {_SCORED_LIST} FROM scored"
    card = """SELECT user_id, risk_level, round_even(risk_score, 1) AS risk_score,
  upper(role[1]) || lower(role[2:]) AS role, CAST(sensitive_total AS DOUBLE) AS sensitive_total,
  CAST(failed_total AS DOUBLE) AS failed_total FROM scored"""
    debtors = (
        "debtor_log AS (SELECT * FROM daily WHERE user_id IN "
        "(SELECT c_custkey FROM customer WHERE c_acctbal < 0))"
    )
    scaled = ", ".join(
        _r(f"z_{c}").replace(f" AS z_{c}", f" AS {c}") for c in FEATURE_COLS
    )
    zscores = ", ".join(
        f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
        f"ELSE stddev_pop({c}) OVER () END AS z_{c}"
        for c in FEATURE_COLS
    )
    upsert_logs = f"""early_log AS (SELECT * FROM daily WHERE day <= {EARLIER_DAY}),
late_log AS (SELECT * FROM daily WHERE user_id IN
  (SELECT user_id FROM daily WHERE day = (SELECT max(day) FROM daily)))"""
    merged = """merged AS (
  SELECT * FROM late_raw UNION ALL
  SELECT * FROM early_raw WHERE user_id NOT IN (SELECT user_id FROM late_raw))"""
    return {
        "daily_activity": f"{on_daily}SELECT * FROM daily",
        "n_days": f"{on_daily}SELECT CAST(count(DISTINCT day) AS BIGINT) AS n_days FROM daily",
        "weekend_profile": f"""{on_daily}, we AS (
  SELECT user_id, avg(files_accessed) AS weekend_files, avg(login_hour) AS weekend_logins,
    avg(after_hours) AS weekend_after_hours FROM daily WHERE is_weekend = 1 GROUP BY user_id),
wd AS (SELECT user_id, avg(files_accessed) AS weekday_files FROM daily WHERE is_weekend = 0
  GROUP BY user_id)
SELECT user_id, {_r("weekend_files")}, {_r("weekend_logins")}, {_r("weekend_after_hours")},
  {_r("weekday_files")}
FROM (SELECT DISTINCT user_id FROM daily) LEFT JOIN we USING (user_id) LEFT JOIN wd USING (user_id)""",
        "user_features": features_sql,
        "features_for_users": f"{_with(daily, debtors, _features('debtor_log'))}"
        f"SELECT user_id, role, {_FEATURE_LIST} FROM feat",
        "scaler_stats": on_features
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std"
            " FROM feat"
            for c in FEATURE_COLS
        ),
        "features_scaled": f"{on_features}SELECT user_id, {scaled} "
        f"FROM (SELECT user_id, {zscores} FROM feat)",
        "risk_rules_only": f"{on_raw}SELECT user_id, role, sensitive_total, failed_total, "
        f"{_r('risk_score_raw')} FROM raw",
        "risk_scored": scored_sql,
        "risk_ranked": f"{scored_sql} ORDER BY risk_score DESC, user_id",
        "stored_scores": scored_sql,
        "top_risky_users": f"""{on_scored}SELECT user_id, role, round(risk_score, 6) AS risk_score,
  risk_level, CAST(row_number() OVER (ORDER BY s.risk_score DESC, user_id) AS INTEGER) AS rank
FROM scored s ORDER BY rank LIMIT 10""",
        "risk_breakdown": on_scored + _breakdown(),
        "risk_level_counts": f"{on_scored}SELECT risk_level, count(*) AS n FROM scored GROUP BY 1",
        "risk_level_share": f"""{on_scored}SELECT risk_level, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS pct
FROM scored GROUP BY 1""",
        "risk_stats": f"""{on_scored}SELECT * FROM (
  SELECT count(*) AS total_users, {_count("Critical")} AS critical_count,
    {_count("High")} AS high_count, {_count("Medium")} AS medium_count, {_count("Low")} AS low_count,
    round(avg(risk_score), 6) AS mean_risk_score, round(max(risk_score), 6) AS max_risk_score,
    round(min(risk_score), 6) AS min_risk_score FROM scored) WHERE total_users > 0""",
        "kpi": f"""{on_scored}SELECT count(*) AS total_users, {_count("Critical")} AS critical,
  {_count("High")} AS high, round_even(avg(risk_score), 1) AS avg_score,
  round_even(max(risk_score), 1) AS max_score FROM scored""",
        "critical_alarm": f"""{on_scored}SELECT * FROM (
  SELECT {_count("Critical")} AS critical_users FROM scored) WHERE critical_users > 0""",
        "distinct_roles": f"{on_daily}SELECT DISTINCT role FROM daily ORDER BY role",
        "role_level_crosstab": f"""{on_scored}SELECT role, {_count("Critical")} AS "Critical",
  {_count("High")} AS "High", {_count("Medium")} AS "Medium", {_count("Low")} AS "Low"
FROM scored GROUP BY role""",
        "score_histogram": f"""{on_scored}SELECT
  CAST(least(floor(30 * risk_score / 100) + 1, 30) AS INTEGER) AS bin, risk_level, count(*) AS n
FROM scored GROUP BY 1, 2""",
        "filtered_view": f"""{on_scored}SELECT {_SCORED_LIST} FROM scored s
WHERE risk_level IN ('Critical', 'High') AND s.risk_score >= 30 AND s.risk_score <= 90
  AND role IN ('BUILDING', 'MACHINERY')""",
        "alert_table": f"""{on_scored}SELECT user_id, role, round_even(risk_score, 1) AS risk_score,
  risk_level, sensitive_total, failed_total FROM scored""",
        "alerts_export": f"{scored_sql} WHERE risk_level IN ('Critical', 'High')",
        "user_cards": on_scored + card,
        "user_drilldown": f"{on_scored}{card} s ORDER BY s.risk_score DESC, user_id LIMIT 1",
        "behaviour_profile": on_features
        + " UNION ALL ".join(
            f"SELECT user_id, CAST({i} AS INTEGER) AS position, '{axis}' AS axis, "
            f"round({axis}, 6) AS value FROM feat"
            for i, axis in enumerate(PROFILE_AXES, 1)
        ),
        "user_batches": f"""{_with(daily, _BATCHES)}SELECT user_id, batch_num, total_batches,
  users_in_batch, total_users_processed FROM batches""",
        "batch_metadata": f"{on_metadata}SELECT * FROM metadata",
        "batch_metadata_latest": f"{on_metadata}SELECT * FROM metadata ORDER BY batch_num DESC LIMIT 1",
        "batch_progress": f"""{on_metadata}SELECT batch_num,
  format('Batch {{}}/{{}}', batch_num, total_batches) AS batch_text, total_users_processed,
  format('{{}} Critical + {{}} High risk users detected', critical_risk_count, high_risk_count)
    AS alert_text,
  round(least(total_users_processed / (total_batches * 10.0::DOUBLE), 1.0::DOUBLE), 6) AS progress
FROM metadata""",
        "upsert_scores": _with(
            daily,
            upsert_logs,
            _raw("early_log", "early_raw"),
            _raw("late_log", "late_raw"),
            merged,
            _scored("merged"),
        )
        + f"SELECT {_SCORED_LIST} FROM scored",
        "stream_daily_activity": f"{on_daily}SELECT * FROM daily",
        "csv_activity": f"""{on_daily}SELECT * REPLACE (user_id + 9007199254740992 AS user_id,
  files_accessed // 2 AS files_accessed) FROM daily WHERE files_accessed % 2 = 0""",
        "iforest_nodes": f"""{_with(daily, feat, _forest())}SELECT tree, node, feature, {_r("threshold")},
  "left", "right", size, depth FROM nodes""",
        "iforest_scores": f"""{_with(daily, feat, _forest(), _forest_scores())}SELECT user_id,
  {_r("score_samples")}, {_r("decision")}
FROM (SELECT user_id, s AS score_samples, s - quantile_cont(s, {PARAMS.forest.contamination}) OVER () AS decision FROM scores)""",
        "csv_rejects": f"""{on_daily}SELECT user_id + 9007199254740992 AS user_id,
  'files_accessed' AS reasons FROM daily WHERE files_accessed % 2 = 1""",
        "model_inventory": f"""{on_daily}SELECT * FROM (VALUES ('iforest_meta', 1, NULL),
  ('iforest_nodes', NULL, true), ('ocsvm_meta', 1, NULL), ('scaler', 18, NULL)) AS t(model_table, rows, in_bounds)
UNION ALL SELECT 'ocsvm_landmarks', least(256, count(DISTINCT user_id)), NULL FROM daily""",
        "user_breakdown": f"""{on_scored}SELECT user_id, factor, contribution_pct FROM ({_breakdown()})
WHERE user_id = (SELECT min(user_id) FROM scored)""",
        "batch_clock": f"""{on_metadata}, stamps AS (
  SELECT batch_num, max(ts) AS ts FROM batches JOIN events USING (user_id) GROUP BY batch_num)
SELECT batch_num,
  format('Batch {{}}/{{}}', batch_num, total_batches) AS batch_text, total_users_processed,
  format('{{}} Critical + {{}} High risk users detected', critical_risk_count, high_risk_count)
    AS alert_text,
  round(least(total_users_processed / (total_batches * 10.0::DOUBLE), 1.0::DOUBLE), 6) AS progress,
  strftime(ts, '%H:%M:%S') AS updated_at
FROM metadata JOIN stamps USING (batch_num)""",
        "stream_metadata": f"""{_with(daily, raw, _REPLAY, _METADATA)}SELECT batch_num, total_batches,
  users_in_batch, total_users_processed, high_risk_count, critical_risk_count FROM metadata""",
        "stream_status": f"""{_with(daily, _REPLAY)}SELECT batch_num, total_batches,
  count(*) AS rows_in_batch, CAST(users_in_batch AS BIGINT) AS users_in_batch,
  CAST(total_users_processed AS BIGINT) AS users_so_far,
  round(batch_num / total_batches, 6) AS progress
FROM daily JOIN batches USING (user_id) GROUP BY ALL""",
        "model_facts": f"""{on_features}, z AS (SELECT {zscores} FROM feat),
entries AS (SELECT unnest([{", ".join(f"z_{c}" for c in FEATURE_COLS)}]) AS v FROM z)
SELECT count(*) AS users, CAST(floor(0.05 * (count(*) - 1)) + 1 AS BIGINT) AS below_offset,
  true AS few_outside,
  round((SELECT 1 / ({len(FEATURE_COLS)} * var_pop(v)) FROM entries), 6) AS gamma,
  CAST(0 AS BIGINT) AS without_error, CAST(0 AS BIGINT) AS wrong_risk,
  100.0::DOUBLE AS highest, 0.0::DOUBLE AS lowest
FROM feat""",
        "stream_scored": scored_sql,
        "stream_features": features_sql,
    }
