"""DuckDB SQL twins of ``queries.QUERIES`` (tables are pre-registered views).

Written independently of the Spark plans: windows are a plain per-row
``generate_series`` explode, neighbours plain ``lag``/``lead`` over the whole
key, and the timeout contract a pair of ``NOT EXISTS``.  Times are epoch
microseconds; window bounds are emitted as epoch ms or rendered text.
"""

from __future__ import annotations

H = 3_600_000_000
SIX_H = 6 * H
DAY = 24 * H
FMT = "'%Y-%m-%d %H:%M:%S'"


def _slide(t: str, size: int, slide: int) -> str:
    return f"unnest(generate_series({t} - {t} % {slide} + {slide}, {t} - {t} % {slide} + {size}, {slide}))"


_VIEWS = ("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, user_id, "
          "epoch_us(ts) AS t FROM events WHERE event_type = 'view'")

_TOPN = f"""
WITH v AS ({_VIEWS}),
w AS (SELECT item_id, {_slide('t', H, 300_000_000)} AS we FROM v),
c AS (SELECT item_id, we // 1000 AS window_end, count(*) AS cnt FROM w GROUP BY item_id, we),
r AS (SELECT window_end, item_id, cnt,
             row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM c)
SELECT window_end, item_id, cnt, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 3"""

# The report's labels and rules (see functions/text.py).
_REPORT = f"""
WITH top AS ({_TOPN})
SELECT window_end,
       repeat('=', 43) || chr(10) || '时间：' || strftime(make_timestamp(window_end * 1000), {FMT}) || '.0'
       || chr(10) || string_agg('No' || rank || ': 商品ID=' || item_id || ' 浏览量=' || cnt, chr(10) ORDER BY rank)
       || chr(10) || repeat('=', 44) || chr(10) || chr(10) AS report
FROM top GROUP BY window_end"""

_HASH = ("list_reduce(list_prepend(0::BIGINT, [ascii(ch)::BIGINT for ch in string_split(CAST(user_id AS VARCHAR), '')]), "
         "lambda a, x: (a * 61 + x) & 536870911)")

_HOUR_END = f"(t - t % {H} + {H}) // 1000"

_GEO = f"""
WITH g AS (SELECT epoch_us(e.ts) AS t, n.n_name AS province
           FROM events e JOIN customer c ON e.user_id = c.c_custkey
                         JOIN nation n ON c.c_nationkey = n.n_nationkey
           WHERE e.event_type = 'click'),
w AS (SELECT province, {_slide('t', H, 5_000_000)} AS we FROM g)
SELECT strftime(make_timestamp(we), {FMT}) AS window_end, province, count(*) AS cnt
FROM w GROUP BY we, province"""


def _marketing(total: bool) -> str:
    keys = "'Total' AS channel, 'Total' AS behavior" if total else "'ch' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 6) AS channel, event_type AS behavior"
    return f"""
WITH m AS (SELECT epoch_us(ts) AS t, {keys} FROM events
           WHERE event_type <> 'signup'),
w AS (SELECT channel, behavior, {_slide('t', 60_000_000, 1_000_000)} AS we FROM m)
SELECT strftime(make_timestamp(we - 60000000), {FMT}) AS window_start,
       strftime(make_timestamp(we), {FMT}) AS window_end, channel, behavior, count(*) AS cnt
FROM w GROUP BY we, channel, behavior"""


_CAP = f"""
SELECT event_id, user_id, event_type, epoch_us(ts) AS t,
       row_number() OVER (PARTITION BY user_id, event_type, epoch_us(ts) // {DAY}
                          ORDER BY ts, event_id) AS rn
FROM events"""

_CAPPED_SLIDING = f"""
WITH r AS ({_CAP}),
w AS (SELECT event_type, {_slide('t', H, 300_000_000)} AS we FROM r WHERE rn <= 3)
SELECT event_type, we // 1000 AS window_end, count(*) AS cnt FROM w GROUP BY event_type, we"""

_CONSEC = f"""
WITH l AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  lag(event_type) OVER w AS pt, lag(epoch_us(ts)) OVER w AS ptt,
                  lag(event_id) OVER w AS prev_event_id
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, prev_event_id FROM l
WHERE event_type = 'error' AND pt = 'error' AND t < ptt + {SIX_H}"""

_NEXT = """
WITH l AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  lead(event_type) OVER w AS nt, lead(epoch_us(ts)) OVER w AS ntt,
                  lead(event_id) OVER w AS nid
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""

_SEQ_MATCH = _NEXT + f"""
SELECT user_id, event_id AS event_id_0, nid AS event_id_1 FROM l
WHERE event_type = 'click' AND nt = 'purchase' AND ntt - t < {SIX_H}"""

_LOGIN_PATTERN = _NEXT + f"""
SELECT user_id, event_id AS event_id_0, nid AS event_id_1 FROM l
WHERE event_type = 'error' AND nt = 'error' AND ntt - t < {SIX_H}"""

_SEQ_TIMEOUT = _NEXT + f"""
SELECT user_id, event_id AS event_id_0 FROM l
WHERE event_type = 'click' AND (nid IS NULL OR ntt - t >= {SIX_H})"""

_ORDER_TIMEOUT = f"""
WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t FROM events)
SELECT c.user_id, c.event_id FROM e c
WHERE c.event_type = 'click'
  AND NOT EXISTS (SELECT 1 FROM e s WHERE s.user_id = c.user_id AND s.event_type = 'click'
                  AND s.t >= c.t - {SIX_H} AND s.t < c.t)
  AND NOT EXISTS (SELECT 1 FROM e o WHERE o.user_id = c.user_id AND o.event_type <> 'click'
                  AND o.t >= c.t AND o.t <= c.t + {SIX_H})"""


_DAILY = """
WITH e AS (SELECT *, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS day FROM events),
o AS (SELECT user_id, day, event_id AS order_event_id, epoch_us(ts) AS ot FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS rn
        FROM e WHERE event_type = 'signup') WHERE rn = 1),
p AS (SELECT user_id, day, event_id AS pay_event_id, epoch_us(ts) AS pt FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS rn
        FROM e WHERE event_type = 'purchase') WHERE rn = 1)"""


def _reconcile(kind: str) -> str:
    return _DAILY + f""",
j AS (SELECT coalesce(o.user_id, p.user_id) AS user_id, coalesce(o.day, p.day) AS day,
             CASE WHEN o.user_id IS NOT NULL AND p.user_id IS NOT NULL THEN 'matched'
                  WHEN o.user_id IS NOT NULL THEN 'unmatched_order' ELSE 'unmatched_pay' END AS kind,
             order_event_id, pay_event_id
      FROM o FULL OUTER JOIN p ON o.user_id = p.user_id AND o.day = p.day)
SELECT user_id, day, kind, order_event_id, pay_event_id FROM j WHERE kind = '{kind}'"""


_RECONCILE_TOL = _DAILY + f"""
SELECT o.user_id, o.day, 'matched' AS kind, order_event_id, pay_event_id
  FROM o JOIN p ON o.user_id = p.user_id AND o.day = p.day WHERE abs(pt - ot) <= {12 * H}
UNION ALL
SELECT o.user_id, o.day, 'unmatched_order', order_event_id, NULL
  FROM o LEFT JOIN p ON o.user_id = p.user_id AND o.day = p.day
  WHERE p.user_id IS NULL OR abs(pt - ot) > {12 * H}
UNION ALL
SELECT p.user_id, p.day, 'unmatched_pay', NULL, pay_event_id
  FROM p LEFT JOIN o ON o.user_id = p.user_id AND o.day = p.day
  WHERE o.user_id IS NULL OR abs(pt - ot) > {12 * H}"""


def _pairs(tolerance: int | None) -> str:
    """A waiting row per user, walked row by row (ws: side that waits, wi: its id, wt: its time)."""
    gone = "false" if tolerance is None else f"t - wt > {tolerance}"
    return f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, epoch_us(ts) AS t, CAST(event_type = 'purchase' AS INT) AS side,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'purchase', event_id) AS rn
  FROM events WHERE event_type IN ('signup', 'purchase')),
s AS (
  SELECT user_id, 0::BIGINT AS rn, -1 AS ws, NULL::BIGINT AS wi, NULL::BIGINT AS wt, NULL::BIGINT AS mo, NULL::BIGINT AS mp,
         -1 AS xs, NULL::BIGINT AS xi
  FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL
  SELECT user_id, rn, CASE WHEN pair THEN -1 ELSE side END, CASE WHEN pair THEN NULL ELSE event_id END,
         CASE WHEN pair THEN NULL ELSE t END,
         CASE WHEN pair THEN CASE WHEN side = 0 THEN event_id ELSE wi END END,
         CASE WHEN pair THEN CASE WHEN side = 1 THEN event_id ELSE wi END END,
         CASE WHEN gone THEN ws ELSE -1 END, CASE WHEN gone THEN wi END
  FROM (SELECT e.*, ws, wi, ws >= 0 AND {gone} AS gone, wt,
               ws >= 0 AND NOT ({gone}) AND ws <> side AS pair
        FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)),
l AS (SELECT user_id, max(rn) AS rn FROM s GROUP BY user_id)
SELECT user_id, 'matched' AS kind, mo AS order_event_id, mp AS pay_event_id FROM s WHERE mo IS NOT NULL
UNION ALL
SELECT user_id, CASE WHEN xs = 0 THEN 'unmatched_order' ELSE 'unmatched_pay' END, CASE WHEN xs = 0 THEN xi END,
       CASE WHEN xs = 1 THEN xi END FROM s WHERE xi IS NOT NULL
UNION ALL
SELECT user_id, CASE WHEN ws = 0 THEN 'unmatched_order' ELSE 'unmatched_pay' END, CASE WHEN ws = 0 THEN wi END,
       CASE WHEN ws = 1 THEN wi END FROM s JOIN l USING (user_id, rn) WHERE ws >= 0"""


def _machine(clock: str) -> str:
    """The saved row per user, walked over rows and timers (state: 0 none, 1 click, 2 other)."""
    over = "ORDER BY ts, event_id" if clock == "stream" else "PARTITION BY user_id ORDER BY ts, event_id"
    return f"""
WITH RECURSIVE r AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS t, coalesce(lag(epoch_us(ts)) OVER ({over}), epoch_us(ts)) AS clock
  FROM events),
v AS (SELECT user_id, event_id, t, clock AS pos, 0 AS fires, CAST(event_type = 'click' AS INT) AS st FROM r
      UNION ALL SELECT user_id, event_id, t, t + {SIX_H}, 1, 0 FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos, fires, t, event_id) AS rn FROM v),
s AS (
  SELECT user_id, 0::BIGINT AS rn, 0 AS state, NULL::BIGINT AS saved, NULL::BIGINT AS alert
  FROM (SELECT DISTINCT user_id FROM n)
  UNION ALL
  SELECT n.user_id, n.rn,
         CASE WHEN fires = 1 THEN 0 WHEN st = 0 THEN 2 WHEN state = 0 THEN 1 ELSE state END,
         CASE WHEN fires = 1 THEN NULL WHEN st = 0 OR state = 0 THEN event_id ELSE saved END,
         CASE WHEN fires = 1 AND state = 1 THEN saved END
  FROM s JOIN n ON n.user_id = s.user_id AND n.rn = s.rn + 1)
SELECT user_id, alert AS event_id FROM s WHERE alert IS NOT NULL"""


_HALF_H = H // 2
_ARRIVED = """
WITH a AS (SELECT event_id, event_type, epoch_us(ts) AS t,
                  (epoch_us(ts) + ((event_id * 7919) % 14400) * 1000000) * 1024 + event_id % 1024 AS arrival FROM events),
m AS (SELECT *, max(t) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)"""
_LATE_KEPT = _ARRIVED + f""",
w AS (SELECT event_id, seen, {_slide('t', 2 * H, _HALF_H)} AS we FROM m)
SELECT event_id, min(we) // 1000 AS open_from FROM w WHERE seen IS NULL OR seen - {H} < we GROUP BY event_id"""
_ON_TIME = _ARRIVED + f""",
w AS (SELECT event_type, seen, {_slide('t', 2 * H, _HALF_H)} AS we FROM m)
SELECT event_type, we // 1000 AS window_end, count(*) AS cnt FROM w WHERE seen IS NULL OR seen < we GROUP BY event_type, we"""

_RUNNING_UV = f"""
WITH v AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'view'),
f AS (SELECT event_id, {_HOUR_END} AS window_end,
             row_number() OVER (PARTITION BY {_HOUR_END}, user_id ORDER BY event_id) = 1 AS fresh FROM v)
SELECT event_id, window_end,
       CAST(sum(CAST(fresh AS INT)) OVER (PARTITION BY window_end ORDER BY event_id) AS BIGINT) AS uv FROM f"""

_CAPPED_GEO = f"""
WITH r AS ({_CAP}),
g AS (SELECT r.t, n.n_name AS province FROM r JOIN customer c ON r.user_id = c.c_custkey
                                              JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE rn <= 3),
w AS (SELECT province, {_slide('t', H, 5_000_000)} AS we FROM g)
SELECT province, we // 1000 AS window_end, count(*) AS cnt FROM w GROUP BY province, we"""

ORACLE: dict[str, str] = {
    "hot_items_topn": _TOPN,
    "hot_items_report": _REPORT,
    "page_views_hourly": f"WITH v AS ({_VIEWS}) SELECT {_HOUR_END} AS window_end, count(*) AS pv FROM v GROUP BY 1",
    "unique_visitors_hourly": f"WITH v AS ({_VIEWS}) SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv FROM v GROUP BY 1",
    "unique_visitors_bitmap": f"WITH v AS ({_VIEWS}) SELECT {_HOUR_END} AS window_end, count(DISTINCT {_HASH}) AS uv FROM v GROUP BY 1",
    "geo_clicks_sliding": _GEO,
    "events_sliding_1h_5s": f"""
WITH w AS (SELECT event_type, {_slide('epoch_us(ts)', H, 5_000_000)} AS we FROM events)
SELECT event_type, we // 1000 AS window_end, count(*) AS cnt FROM w GROUP BY event_type, we""",
    "events_total_60s_1s": f"""
WITH w AS (SELECT {_slide('epoch_us(ts)', 60_000_000, 1_000_000)} AS we FROM events)
SELECT we // 1000 AS window_end, count(*) AS cnt FROM w GROUP BY we""",
    "channel_counts_sliding": _marketing(False),
    "total_counts_sliding": _marketing(True),
    "daily_cap_warnings": f"WITH r AS ({_CAP}) SELECT user_id, event_type, event_id, 'Click over 2 times today.' AS msg FROM r WHERE rn = 4",
    "daily_cap_passed": f"WITH r AS ({_CAP}) SELECT event_id, user_id, event_type FROM r WHERE rn <= 3",
    "capped_sliding_counts": _CAPPED_SLIDING,
    "consecutive_failures": _CONSEC,
    "login_fail_pattern": _LOGIN_PATTERN,
    "sequence_match": _SEQ_MATCH,
    "sequence_timeout": _SEQ_TIMEOUT,
    "order_timeout": _ORDER_TIMEOUT,
    "reconcile_tolerance": _RECONCILE_TOL,
    "reconcile_matched": _reconcile("matched"),
    "reconcile_unmatched_left": _reconcile("unmatched_order"),
    "reconcile_unmatched_right": _reconcile("unmatched_pay"),
    "parsed_events": "SELECT event_id, user_id, event_type, epoch_us(ts) AS event_time FROM events",
    "decoded_events": "SELECT event_id AS key, event_id, user_id, event_type, epoch_us(ts) AS event_time FROM events",
    "epoch_scaling": f"""
WITH t AS (SELECT epoch_us(ts) AS t FROM events),
w AS (SELECT (t - t % {H} + {H}) // 1000 AS window_end, count(*) AS cnt FROM t GROUP BY 1)
SELECT unit, window_end, cnt FROM w, (VALUES ('s'), ('ms'), ('txt')) u(unit)""",
    "login_alerts": f"""
WITH n AS (SELECT event_id, user_id, event_type, ts,
                  lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id, CAST(user_id AS VARCHAR) || '2s内连续登录失败' AS msg FROM n
WHERE event_type = 'error' AND pt = 'error' AND epoch_us(ts) < epoch_us(pts) + {SIX_H}""",
    "unique_visitors_approx_error": f"""
WITH v AS ({_VIEWS})
SELECT DISTINCT {_HOUR_END} AS window_end, true AS within FROM v""",
    # exact counts: the sketches hold far fewer users than registers here
    "unique_visitors_daily_merged": f"WITH v AS ({_VIEWS}) SELECT (t - t % {DAY} + {DAY}) // 1000 AS window_end, count(DISTINCT user_id) AS uv FROM v GROUP BY 1",
    "unique_visitors_running": _RUNNING_UV,
    "reconcile_repeated": _pairs(None),
    "reconcile_repeated_within": _pairs(12 * H),
    "order_timeout_machine": _machine("stream"),
    "order_timeout_machine_by_key": _machine("key"),
    "late_rows_kept": _LATE_KEPT,
    "on_time_counts": _ON_TIME,
    "capped_geo_sliding": _CAPPED_GEO,
}
