"""DuckDB-side twins of the fixture views, as SQL common table expressions.

Only the base tables are registered in the checker, so every oracle query
inlines the views it needs. ``with_views`` resolves the dependencies.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "base": ([], """
SELECT user_id AS series_id, event_id, ts, value, anomaly, k,
       CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS i,
       CAST(COUNT(*) OVER (PARTITION BY user_id) AS BIGINT) AS n
FROM (SELECT user_id, event_id, ts, value,
             CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS DOUBLE) AS k,
             CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS anomaly
      FROM events) e"""),
    "readings": (["base"], """
SELECT series_id, event_id, ts, i, n, anomaly,
       value AS ch1, k AS ch2, value - k AS ch3,
       CASE WHEN i BETWEEN 20 AND 54 THEN CAST(7 AS DOUBLE) ELSE CAST(EXTRACT(MINUTE FROM ts) AS DOUBLE) END AS ch4,
       CAST(EXTRACT(HOUR FROM ts) AS DOUBLE) AS ch5,
       CAST(event_id % 97 AS DOUBLE) AS ch6,
       CAST(series_id AS DOUBLE) AS ch7,
       value + 2 * k AS ch8,
       CAST(i AS DOUBLE) + CASE WHEN i >= 40 AND i % 5 = 0 THEN CAST(3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS arrival_s,
       CASE WHEN series_id % 5 = 3 THEN 'val' WHEN series_id % 5 = 4 THEN 'test' ELSE 'train' END AS split
FROM base"""),
    "windows": (["readings"], """
SELECT series_id, split, i, i - 19 AS idx, y, cents
FROM (SELECT series_id, split, i, n,
             COALESCE(MAX(anomaly) OVER (PARTITION BY series_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), 0) AS y,
             CAST(SUM(CAST(ROUND(ch1 * 100) AS BIGINT)) OVER (PARTITION BY series_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS cents
      FROM readings) w
WHERE i >= 19 AND i < n - 10"""),
    "scores": (["windows"], """
SELECT w.series_id, w.split, w.i, w.idx, w.y, m.model_id,
       ROUND(1 / (1 + EXP(-(m.slope * (w.cents / CAST(2000 AS DOUBLE) - 50) + m.bias))), 6) AS p
FROM windows w
CROSS JOIN (SELECT 'm1' AS model_id, CAST(0.06 AS DOUBLE) AS slope, CAST(0 AS DOUBLE) AS bias
            UNION ALL SELECT 'm2', CAST(0.12 AS DOUBLE), CAST(0 AS DOUBLE)
            UNION ALL SELECT 'm3', CAST(0.03 AS DOUBLE), CAST(-1.5 AS DOUBLE)) m"""),
    "file_rows": (["readings"], """
SELECT CAST(FLOOR(event_id / 400) AS BIGINT) AS file_k, ts, ch1, ch2, ch3, ch4, ch5, ch6, ch7, ch8, anomaly, 0 AS changepoint
FROM readings
UNION ALL
SELECT fk - 1, ts,
       CASE WHEN odd = 0 THEN ch1 + 1 ELSE ch1 END, CASE WHEN odd = 1 THEN ch2 + 1 ELSE ch2 END,
       CASE WHEN odd = 2 THEN ch3 + 1 ELSE ch3 END, CASE WHEN odd = 3 THEN ch4 + 1 ELSE ch4 END,
       CASE WHEN odd = 4 THEN ch5 + 1 ELSE ch5 END, CASE WHEN odd = 5 THEN ch6 + 1 ELSE ch6 END,
       CASE WHEN odd = 6 THEN ch7 + 1 ELSE ch7 END, CASE WHEN odd = 7 THEN ch8 + 1 ELSE ch8 END,
       CASE WHEN fk % 4 IN (1, 2) THEN 1 - anomaly ELSE anomaly END,
       CASE WHEN fk % 4 = 3 THEN 1 ELSE 0 END
FROM (SELECT *, CASE WHEN fk % 4 = 2 THEN (fk // 4) % 8 END AS odd
      FROM (SELECT *, CAST(FLOOR(event_id / 400) AS BIGINT) AS fk FROM readings
            WHERE event_id >= 400 AND event_id % 400 < 100) r) c"""),
    "registry": ([], """
SELECT 'm1' AS model_id, 'Model one' AS name, 'Linear' AS family, CAST(0.91 AS DOUBLE) AS test_f1, TRUE AS requires_scaling
UNION ALL SELECT 'm2', 'Model two', 'Tree', CAST(0.85 AS DOUBLE), FALSE
UNION ALL SELECT 'm3', 'Model three', 'Kernel', CAST(0.53 AS DOUBLE), TRUE
UNION ALL SELECT 'm4', 'Model four', 'Deep', NULL, FALSE"""),
    "bursts": (["readings"], """
SELECT DISTINCT series_id, 10 AS start_i, 15 + series_id % 26 AS dur,
       CAST(7 + series_id % 8 AS DOUBLE) / 10 AS intensity FROM readings"""),
    "channel_ranges": ([], """
SELECT 'ch1' AS channel, CAST(0 AS DOUBLE) AS lo, CAST(200 AS DOUBLE) AS hi
UNION ALL SELECT 'ch2', CAST(1 AS DOUBLE), CAST(98 AS DOUBLE)
UNION ALL SELECT 'ch3', CAST(-90 AS DOUBLE), CAST(300 AS DOUBLE)
UNION ALL SELECT 'ch8', CAST(0 AS DOUBLE), CAST(400 AS DOUBLE)"""),
    "live_config": ([], """
SELECT CAST(0 AS DOUBLE) AS at_s, 'm1' AS model_id, CAST(0.5 AS DOUBLE) AS threshold
UNION ALL SELECT CAST(30 AS DOUBLE), 'm2', NULL
UNION ALL SELECT CAST(45 AS DOUBLE), NULL, CAST(0.6 AS DOUBLE)"""),
    "uploads": (["readings"], """
SELECT series_id AS file, event_id AS row,
       CASE WHEN event_id % 251 = 5 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS ts_text,
       CASE WHEN event_id % 419 = 23 THEN 'x1' ELSE CAST(ch1 AS VARCHAR) END AS ch1,
       CASE WHEN event_id % 401 = 17 THEN 'abc' ELSE CAST(ch2 AS VARCHAR) END AS ch2,
       CASE WHEN event_id % 211 = 7 THEN '--' ELSE CAST(ch3 AS VARCHAR) END AS ch3,
       CAST(ch4 AS VARCHAR) AS ch4,
       CASE WHEN event_id % 223 = 11 THEN 'N/A' ELSE CAST(ch5 AS VARCHAR) END AS ch5,
       CASE WHEN event_id % 227 = 13 THEN '' ELSE CAST(ch6 AS VARCHAR) END AS ch6,
       CAST(ch7 AS VARCHAR) AS ch7,
       CASE WHEN event_id % 409 = 19 THEN '#' ELSE CAST(ch8 AS VARCHAR) END AS ch8,
       CAST(anomaly AS VARCHAR) AS anomaly
FROM readings"""),
    "upload_headers": (["readings"], """
SELECT file, col_pos, col_name FROM (
  SELECT f.file, CAST(h.col_pos AS BIGINT) AS col_pos,
         CASE WHEN f.file % 6 = 1 AND h.name = 'ch2' THEN 'CH_2'
              WHEN f.file % 6 = 2 AND h.name = 'ch3' THEN 'Ch 3'
              WHEN f.file % 6 = 3 AND h.name = 'ch5' THEN 'channel5'
              WHEN f.file % 6 = 4 AND h.name = 'datetime' THEN 'Timestamp'
              ELSE h.name END AS col_name
  FROM (SELECT DISTINCT series_id AS file FROM readings) f
  CROSS JOIN (SELECT * FROM (VALUES (0, 'datetime'), (1, 'ch1'), (2, 'ch2'), (3, 'ch3'), (4, 'ch4'), (5, 'ch5'),
                                    (6, 'ch6'), (7, 'ch7'), (8, 'ch8'), (9, 'anomaly')) v(col_pos, name)) h) x
WHERE NOT (file % 6 = 5 AND col_name = 'anomaly')"""),
    "model_requests": (["readings"], """
SELECT DISTINCT series_id, 'm' || CAST(series_id % 6 AS VARCHAR) AS model_id FROM readings"""),
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(needs: list[str], body: str, extra: list[tuple[str, str]] = (),
               recursive: bool = False) -> str:
    """``WITH <views needed>, <extra CTEs> <body>``."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _closure(needs)]
    parts += [f"{name} AS ({sql}\n)" for name, sql in extra]
    if not parts:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body
