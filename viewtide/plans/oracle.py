"""The domain views as SQL, for checking results on another engine."""

from __future__ import annotations

import re

VIEWS = {
    "v_users": """
        SELECT c_custkey AS user_id, n_name AS country, c_mktsegment AS subscription_plan,
               r_name AS region, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS monthly_spend,
               CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 97 = 1 THEN CAST(110 AS DOUBLE)
                    ELSE CAST(18 + c_custkey % 50 AS DOUBLE) END AS age,
               CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE c_name END AS email
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "v_movies": """
        SELECT p_partkey AS movie_id, p_name AS title, p_type AS genre_primary, p_brand AS content_type,
               CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS DOUBLE) / CAST(5 AS DOUBLE) END
                 AS imdb_rating,
               p_size <= 25 AS is_original
        FROM part WHERE p_size <= 48""",
    "v_watch": """
        SELECT l_orderkey AS session_id, l_linenumber AS session_seq, o_custkey AS user_id,
               l_partkey AS movie_id, l_shipdate AS watch_date, o_orderpriority AS device_type,
               CASE WHEN l_quantity > 46 THEN NULL ELSE l_quantity END AS watch_duration_minutes,
               ROUND(l_discount * 1000, 0) AS progress_percentage,
               CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'stopped' ELSE 'started' END
                 AS action,
               CASE WHEN l_linestatus = 'F' THEN 'SD' ELSE '4K' END AS quality
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_reviews": """
        SELECT o_custkey AS user_id, l_partkey AS movie_id, ROUND(1 + l_tax * 50, 1) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "v_raw_watch": """
        SELECT CASE WHEN session_id % 50 = 0 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END
                 AS user_id, movie_id, session_id, session_seq, watch_date,
               CASE WHEN watch_duration_minutes = 46 THEN CAST('NaN' AS DOUBLE)
                    ELSE watch_duration_minutes END AS watch_duration_minutes,
               action, quality, CAST(NULL AS DOUBLE) AS unused
        FROM (SELECT * FROM v_watch UNION ALL SELECT * FROM v_watch WHERE session_seq = 7) t""",
    "v_events": """
        SELECT event_id, ts AS event_time, user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'stopped'
                    WHEN 'click' THEN 'paused' WHEN 'signup' THEN NULL ELSE 'started' END AS action,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS progress_percentage,
               value AS watch_duration_minutes,
               CASE event_id % 4 WHEN 0 THEN 'SD' WHEN 1 THEN 'HD' WHEN 2 THEN '4K' ELSE 'Ultra HD' END
                 AS quality,
               CASE event_id % 3 WHEN 0 THEN 'TV' WHEN 1 THEN 'Mobile' ELSE 'Laptop' END AS device_type
        FROM events""",
    "v_changes": """
        SELECT o_custkey AS user_id, o_orderdate AS changed_at, o_orderkey AS change_id, o_orderstatus AS country,
               o_orderpriority AS subscription_plan, c_acctbal AS monthly_spend,
               c_acctbal + o_orderkey % 1000 > 5000 AS is_active
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_tastes": """
        SELECT user_id, movie_id, AVG(rating) AS user_rating FROM (
            SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id, 'm' || CAST(l_partkey AS VARCHAR) AS movie_id,
                   ROUND(1 + CASE WHEN o_custkey % 3 = l_partkey % 3 THEN 2 ELSE 0 END + l_tax * 10, 1) AS rating
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t GROUP BY user_id, movie_id""",
    "v_slices": """
        SELECT *, CAST(LEAST((DAY(event_time) - 1) // 5, 5) + CASE WHEN event_id % 13 = 0 THEN 3 ELSE 0 END
                    AS INTEGER) AS batch FROM v_events""",
    "v_marks": """
        SELECT batch, MAX(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
                        - INTERVAL 10 MINUTE AS mark
        FROM (SELECT batch, date_trunc('milliseconds', MAX(event_time)) AS latest FROM v_slices GROUP BY batch) b""",
    "v_ratings": """
        SELECT user_id, movie_id, AVG(rating) AS user_rating FROM v_reviews GROUP BY user_id, movie_id""",
    "v_star": """
        SELECT w.*, CAST(YEAR(w.watch_date) AS INTEGER) AS watch_year,
               CAST(MONTH(w.watch_date) AS INTEGER) AS watch_month, u.country, u.subscription_plan,
               u.monthly_spend, m.title, m.genre_primary, m.content_type, r.user_rating
        FROM v_watch w JOIN v_users u ON w.user_id = u.user_id
                       JOIN v_movies m ON w.movie_id = m.movie_id
                       LEFT JOIN v_ratings r ON w.user_id = r.user_id AND w.movie_id = r.movie_id""",
    "v_sessions": """
        SELECT * FROM v_star WHERE watch_date IS NOT NULL AND watch_duration_minutes IS NOT NULL""",
    "v_retention": """
        SELECT CAST(YEAR(f.first_date) AS INTEGER) AS cohort_year,
               CAST(MONTH(f.first_date) AS INTEGER) AS cohort_month, s.watch_year, s.watch_month,
               COUNT(DISTINCT s.user_id) AS active_users,
               CAST((s.watch_year - YEAR(f.first_date)) * 12 + s.watch_month - MONTH(f.first_date)
                 AS INTEGER) AS months_since_cohort
        FROM v_sessions s JOIN (SELECT user_id, MIN(watch_date) AS first_date
                                FROM v_sessions GROUP BY user_id) f ON s.user_id = f.user_id
        GROUP BY YEAR(f.first_date), MONTH(f.first_date), s.watch_year, s.watch_month""",
    "v_enriched": """
        SELECT e.*, u.country, u.monthly_spend, m.title, m.genre_primary, m.content_type,
               m.imdb_rating, m.is_original
        FROM v_events e
        LEFT JOIN (SELECT * REPLACE (COALESCE(monthly_spend, 0) AS monthly_spend)
                   FROM v_users) u ON e.user_id = u.user_id
        LEFT JOIN (SELECT * REPLACE (COALESCE(imdb_rating, 0) AS imdb_rating)
                   FROM v_movies) m ON e.movie_id = m.movie_id""",
    "v_flags": """
        SELECT * REPLACE (COALESCE(progress_percentage, 0) AS progress_percentage,
                          COALESCE(watch_duration_minutes, 0) AS watch_duration_minutes),
               CASE WHEN COALESCE(progress_percentage, 0) < 20 THEN 1 ELSE 0 END AS is_low_engagement,
               CASE WHEN quality IN ('SD', 'HD') THEN 1 ELSE 0 END AS is_quality_downgrade,
               CASE WHEN action = 'stopped' AND COALESCE(progress_percentage, 0) < 50 THEN 1 ELSE 0 END
                 AS is_abandoned,
               CASE WHEN action = 'completed' THEN 1 ELSE 0 END AS is_completed
        FROM v_enriched""",
    "v_messages": """
        SELECT event_id, CASE WHEN event_id % 50 = 1 THEN NULL ELSE user_id END AS user_id, movie_id,
               CASE WHEN event_id % 50 = 2 THEN 'not a time'
                    ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS timestamp,
               action, progress_percentage, watch_duration_minutes, quality, device_type
        FROM v_events""",
    "v_encoded": """
        SELECT event_id, user_id, timestamp,
               '{"event_id":' || CAST(event_id AS VARCHAR)
               || COALESCE(',"user_id":' || CAST(user_id AS VARCHAR), '')
               || ',"movie_id":' || CAST(movie_id AS VARCHAR)
               || ',"timestamp":"' || timestamp || '"'
               || COALESCE(',"action":"' || action || '"', '')
               || COALESCE(',"progress_percentage":' || CAST(progress_percentage AS VARCHAR), '')
               || ',"watch_duration_minutes":' || CAST(watch_duration_minutes AS VARCHAR)
               || ',"quality":"' || quality || '","device_type":"' || device_type || '"}' AS value
        FROM v_messages""",
}


def with_views(sql: str, views: dict[str, str] = VIEWS) -> str:
    """Prefix ``sql`` with the views it uses, directly or through others."""

    def needed(text: str) -> set[str]:
        direct = {name for name in views if re.search(rf"\b{name}\b", text)}
        return direct.union(*[needed(views[name]) for name in direct])

    names = needed(sql)
    parts = [f"{name} AS ({body})" for name, body in views.items() if name in names]
    body = sql.strip()
    if not parts:
        return body
    glue = ", " if body.upper().startswith("WITH ") else " "
    body = body[5:] if glue == ", " else body
    return f"WITH {', '.join(parts)}{glue}{body}"


def rounded(expression: str, scale: int = 4) -> str:
    """Half-up rounding in decimals, immune to the last bits of a double sum."""
    exact = f"CAST(ROUND({expression}, {scale + 6}) AS DECIMAL(38, {scale + 6}))"
    return f"CAST(ROUND({exact}, {scale}) AS DOUBLE)"


def buckets(width: str, keys: str = "", time: str = "event_time") -> str:
    """Select list of a tumbling window and its keys."""
    start = f"time_bucket(INTERVAL '{width}', {time}, TIMESTAMP '1970-01-01')"
    return f"{start} AS window_start, {start} + INTERVAL '{width}' AS window_end" + (
        f", {keys}" if keys else ""
    )


def trending(width: str, where: str = "TRUE") -> str:
    return f"""
        SELECT {buckets(width, 'movie_id, title, genre_primary, content_type')},
               COUNT(*) AS view_count, COUNT(DISTINCT user_id) AS unique_viewers,
               {rounded('AVG(progress_percentage)')} AS avg_completion_pct,
               {rounded('SUM(watch_duration_minutes)')} AS total_watch_time_min,
               COUNT(*) FILTER (WHERE action = 'completed') AS completed_views
        FROM v_enriched WHERE {where} GROUP BY ALL"""


def health(width: str, keys: str, where: str = "TRUE") -> str:
    return f"""
        SELECT *, CASE WHEN low_engagement_count / total_sessions > 0.6 THEN 'HIGH'
                       WHEN low_engagement_count / total_sessions > 0.4 THEN 'MEDIUM'
                       ELSE 'LOW' END AS alert_level FROM (
        SELECT {buckets(width, keys)},
               COUNT(*) AS total_sessions, COUNT(DISTINCT user_id) AS unique_users,
               {rounded('SUM(watch_duration_minutes)', 1)} AS total_watch_minutes,
               {rounded('AVG(progress_percentage)', 2)} AS avg_completion_pct,
               {rounded('AVG(imdb_rating)', 2)} AS avg_content_quality,
               CAST(SUM(is_low_engagement) AS BIGINT) AS low_engagement_count,
               CAST(SUM(is_abandoned) AS BIGINT) AS abandonment_count,
               CAST(SUM(is_quality_downgrade) AS BIGINT) AS quality_downgrade_count,
               CAST(SUM(is_completed) AS BIGINT) AS completion_count,
               {rounded('SUM(is_low_engagement) / COUNT(*) * 100', 2)} AS low_engagement_rate,
               {rounded('SUM(is_abandoned) / COUNT(*) * 100', 2)} AS abandonment_rate,
               {rounded('SUM(is_completed) / COUNT(*) * 100', 2)} AS completion_rate,
               {rounded('SUM(monthly_spend)', 2)} AS revenue_impact,
               {rounded('AVG(monthly_spend)', 2)} AS avg_subscriber_value
        FROM v_flags WHERE {where} GROUP BY ALL) h"""
