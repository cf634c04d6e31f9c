"""DuckDB SQL oracles, one per registered query (same column names and types).

They state each job's result from its definition over the raw tables: a row
belongs to every window that covers it (``CROSS JOIN range(k)``), neighbours
are ``lag``/``lead`` over the whole key, the failure-burst state machine is a
recursive CTE that walks each user's events one by one.  Only the 1-day/5-s
windows use the delta form, because expanding 17,280 windows per row is the
very cost the operator avoids.
"""

from __future__ import annotations

from eventide.plans import catalog as C
from eventide.operators.windows import us

K = "CAST(props->>'k' AS BIGINT)"


def ts_text(x: str) -> str:
    return (f"(strftime({x}, '%Y-%m-%d %H:%M:%S') || '.' || "
            f"coalesce(nullif(rtrim(strftime({x}, '%f'), '0'), ''), '0'))")


def end_of(ts_us: str, slide: int, i: str = "0") -> str:
    """Epoch-us end of the ``i``-th window (0-based) after the pane holding ``ts_us``."""
    return f"({ts_us} - ({ts_us} % {slide}) + CAST({i} + 1 AS BIGINT) * {slide})"


PV = f"""pv AS (SELECT user_id, {K} AS item_id, ts, event_id AS seq, epoch_us(ts) AS us
             FROM events WHERE event_type = 'view')"""

HI_SIZE, HI_SLIDE = us(C.HOT_ITEMS["size"]), us(C.HOT_ITEMS["slide"])
HI_K = HI_SIZE // HI_SLIDE


def _hot_items_windows(src: str = "pv") -> str:
    return f"""SELECT item_id, make_timestamp({end_of('us', HI_SLIDE, 'i')}) AS window_end,
                   count(*) AS cnt
            FROM {src} CROSS JOIN range({HI_K}) t(i) GROUP BY ALL"""


def _top(src: str, key: str, n: int, rank: str = "rank") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end
                               ORDER BY cnt DESC, {key}) AS {rank} FROM ({src})) WHERE {rank} <= {n}"""


HOT_ITEMS_TOPN = f"""WITH {PV}
SELECT item_id, window_end, cnt, rank FROM ({_top(_hot_items_windows(), 'item_id', C.HOT_ITEMS['n'])})"""

IP_LOG = "'10.0.' || ((user_id // 256) % 256) || '.' || (user_id % 256)"
URL = (f"'/p/' || {K} || CASE WHEN {K} % 5 = 0 THEN '.css' WHEN {K} % 5 = 1 THEN '.js?v=1' "
       f"ELSE '.html' END")
ACCESS = f"""acc AS (SELECT {IP_LOG} AS ip, CAST(user_id AS VARCHAR) AS user_id,
                      date_trunc('second', ts) AS ts,
                      CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
                      {URL} AS url, event_id, event_id + (event_id * 17) % 40 AS seq
               FROM events)"""
STATIC = "regexp_matches(url, '\\.(css|js|ico|png)$')"

MARKET = """mk AS (SELECT CAST(user_id AS VARCHAR) AS user_id,
                    CASE event_type WHEN 'purchase' THEN 'download' WHEN 'signup' THEN 'install'
                                    WHEN 'error' THEN 'uninstall' ELSE event_type END AS behavior,
                    ['appstore', 'weibo', 'wechat', 'tieba'][CAST(props->>'k' AS BIGINT) % 4 + 1]
                        AS channel, ts, event_id AS seq
             FROM events)"""


def sparse_sliding(src: str, keys: list[str], size: int, slide: int) -> str:
    """Intervals of window ends with a constant, non-zero count (delta form)."""
    k = ", ".join(keys)
    return f"""
panes AS (SELECT {k}, epoch_us(ts) - epoch_us(ts) % {slide} + {slide} AS p, count(*) AS c
          FROM {src} GROUP BY ALL),
deltas AS (SELECT {k}, e, sum(d) AS d FROM (
             SELECT {k}, p AS e, c AS d FROM panes
             UNION ALL SELECT {k}, p + {size} AS e, -c AS d FROM panes) GROUP BY ALL
           HAVING sum(d) <> 0),
runs AS (SELECT {k}, e, sum(d) OVER (PARTITION BY {k} ORDER BY e) AS cnt,
                lead(e) OVER (PARTITION BY {k} ORDER BY e) AS next_e FROM deltas)
SELECT {k}, make_timestamp(e) AS first_end, make_timestamp(next_e - {slide}) AS last_end,
       CAST((next_e - e) // {slide} AS BIGINT) AS n_windows, CAST(cnt AS BIGINT) AS cnt
FROM runs WHERE cnt > 0 AND next_e IS NOT NULL"""


M_SIZE, M_SLIDE = us(C.MARKET["size"]), us(C.MARKET["slide"])

ADS = f"""ads AS (SELECT e.user_id, {K} % 3 AS ad_id, n.n_name AS province, c.c_mktsegment AS city,
                  e.ts, e.event_id AS seq, strftime(e.ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day
           FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
                         LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
           WHERE e.event_type = 'click'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, seq)
                  AS day_rank FROM ads)"""

LOGINS = """lg AS (SELECT user_id, '10.1.' || (CAST(props->>'k' AS BIGINT) % 256) || '.' || (user_id % 256) AS ip,
                   CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type,
                   ts, epoch_us(ts) AS us, event_id AS seq FROM events),
lgp AS (SELECT *, lag(event_type) OVER w AS prev_type, lag(us) OVER w AS prev_us,
               lag(ts) OVER w AS prev_ts, lag(ip) OVER w AS prev_ip
        FROM lg WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))"""
LW = us(C.LOGIN_WITHIN)
LW_TXT = str(LW // 1_000_000)

BURSTS = f"""WITH RECURSIVE ev AS (
  SELECT user_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS f, ts, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
st(user_id, rn, anchor, n, first_ts, last_ts, e_first, e_last, e_n) AS (
  SELECT user_id, rn, CASE WHEN f = 1 THEN us END, CASE WHEN f = 1 THEN 1 ELSE 0 END,
         CASE WHEN f = 1 THEN ts END, CASE WHEN f = 1 THEN ts END,
         NULL::TIMESTAMP, NULL::TIMESTAMP, NULL::BIGINT
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT s.user_id, e.rn,
    CASE WHEN e.f = 1 THEN (CASE WHEN s.anchor IS NULL OR e.us > s.anchor + {LW} THEN e.us ELSE s.anchor END) END,
    CASE WHEN e.f = 1 THEN (CASE WHEN s.anchor IS NULL OR e.us > s.anchor + {LW} THEN 1 ELSE s.n + 1 END) ELSE 0 END,
    CASE WHEN e.f = 1 THEN (CASE WHEN s.anchor IS NULL OR e.us > s.anchor + {LW} THEN e.ts ELSE s.first_ts END) END,
    CASE WHEN e.f = 1 THEN e.ts END,
    CASE WHEN s.anchor IS NOT NULL AND e.us > s.anchor + {LW} AND s.n >= {C.BURST_N} THEN s.first_ts END,
    CASE WHEN s.anchor IS NOT NULL AND e.us > s.anchor + {LW} AND s.n >= {C.BURST_N} THEN s.last_ts END,
    CASE WHEN s.anchor IS NOT NULL AND e.us > s.anchor + {LW} AND s.n >= {C.BURST_N} THEN s.n END
  FROM st s JOIN ev e ON e.user_id = s.user_id AND e.rn = s.rn + 1),
out AS (
  SELECT user_id, e_first AS first_fail_ts, e_last AS last_fail_ts, e_n AS n FROM st WHERE e_n IS NOT NULL
  UNION ALL
  SELECT s.user_id, s.first_ts, s.last_ts, s.n
  FROM st s JOIN (SELECT user_id, max(rn) AS mr FROM ev GROUP BY 1) m ON s.user_id = m.user_id AND s.rn = m.mr
  WHERE s.anchor IS NOT NULL AND s.n >= {C.BURST_N})
SELECT user_id, first_fail_ts, last_fail_ts, CAST(n AS BIGINT) AS fail_times,
       'login fail in {LW_TXT}s for ' || n || ' times.' AS warn_msg
FROM out"""

OT = us(C.ORDER_TIMEOUT)
ORDERS = """od AS (SELECT user_id AS order_id, CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'create' END AS t,
                   CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS tie, ts, epoch_us(ts) AS us,
                   event_id AS seq
            FROM events WHERE event_type IN ('signup', 'purchase'))"""
FUNNEL = f"""WITH {ORDERS},
nx AS (SELECT *, min(CASE WHEN t = 'pay' THEN us END) OVER (PARTITION BY order_id ORDER BY ts, tie, seq
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us FROM od),
cr AS (SELECT order_id, ts AS create_ts, us, make_timestamp(pay_us) AS pay_ts,
              pay_us IS NOT NULL AND pay_us - us < {OT} AS ok,
              make_timestamp(us + {OT}) AS timeout_ts
       FROM nx WHERE t = 'create')"""
ORDER_PAID = FUNNEL + f"""
SELECT order_id, create_ts, pay_ts,
       'order ' || order_id || ' start at ' || {ts_text('create_ts')} || ' and payed at ' || {ts_text('pay_ts')} AS msg
FROM cr WHERE ok"""
ORDER_TIMEOUTS = FUNNEL + f"""
SELECT order_id, create_ts, timeout_ts,
       'order ' || order_id || ' start at ' || {ts_text('create_ts')} || ' and timeout at ' || {ts_text('timeout_ts')} AS msg
FROM cr WHERE NOT ok"""

ORDER_STATUS = f"""WITH {ORDERS},
nb AS (SELECT *, lag(t) OVER w AS prev_t, lag(us) OVER w AS prev_us, lag(ts) OVER w AS prev_ts,
              lead(t) OVER w AS next_t
       FROM od WINDOW w AS (PARTITION BY order_id ORDER BY ts, tie, seq)),
st AS (SELECT *, CASE
         WHEN t = 'pay' AND prev_t = 'create' AND us - prev_us < {OT} THEN 'paid'
         WHEN t = 'pay' AND prev_t = 'create' THEN 'paid_after_timeout'
         WHEN t = 'pay' THEN 'pay_without_create'
         WHEN t = 'create' AND coalesce(next_t = 'pay', false) = false THEN 'created_timeout' END AS status
       FROM nb)
SELECT order_id, status, CASE WHEN status = 'paid' THEN 'PAY' ELSE 'TIMEOUT' END AS tag,
       CASE WHEN t = 'create' THEN ts WHEN prev_t = 'create' THEN prev_ts END AS create_ts,
       CASE WHEN t = 'pay' THEN ts END AS pay_ts,
       CASE status WHEN 'paid' THEN '[' || order_id || '] payed successfully'
                   WHEN 'paid_after_timeout' THEN '[' || order_id || '] payed but already timeout'
                   WHEN 'pay_without_create' THEN '[' || order_id || '] payed but not found create'
                   ELSE '[' || order_id || '] created, order timeout' END AS msg
FROM st WHERE status IS NOT NULL"""

TX_PAYS = """pays AS (SELECT CAST(user_id AS VARCHAR) AS tx_id, user_id AS order_id, ts, event_id AS seq
              FROM events WHERE event_type = 'purchase')"""
TX_REC = """rec AS (SELECT CAST(user_id AS VARCHAR) AS tx_id,
                     ['wechat', 'alipay'][CAST(props->>'k' AS BIGINT) % 2 + 1] AS pay_channel,
                     ts, event_id AS seq
              FROM events WHERE event_type = 'view')"""
TX_JOIN = f"""WITH {TX_PAYS}, {TX_REC}
SELECT p.tx_id, p.order_id, p.ts AS pay_ts, r.pay_channel, r.ts AS receipt_ts
FROM pays p JOIN rec r ON p.tx_id = r.tx_id
 AND epoch_us(r.ts) - epoch_us(p.ts) BETWEEN {us(C.TX_LOWER)} AND {us(C.TX_UPPER)}"""



def _tx_outer(pay_open: str = "false", receipt_open: str = "false") -> str:
    """Pairs in the interval and the rows of both sides without one, but for those that still wait for theirs."""
    fits = (f"p.tx_id = r.tx_id AND epoch_us(r.ts) - epoch_us(p.ts) "
            f"BETWEEN {us(C.TX_LOWER)} AND {us(C.TX_UPPER)}")
    return f"""WITH {TX_PAYS}, {TX_REC}
SELECT 'MATCH' AS tag, p.tx_id, p.order_id, p.ts AS pay_ts, p.seq AS pay_seq, r.pay_channel, r.ts AS receipt_ts,
       r.seq AS receipt_seq FROM pays p JOIN rec r ON {fits}
UNION ALL SELECT 'UNMATCHED', p.tx_id, p.order_id, p.ts, p.seq, NULL, NULL, NULL FROM pays p
WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE {fits}) AND NOT ({pay_open})
UNION ALL SELECT 'UNMATCHED', r.tx_id, NULL, NULL, NULL, r.pay_channel, r.ts, r.seq FROM rec r
WHERE NOT EXISTS (SELECT 1 FROM pays p WHERE {fits}) AND NOT ({receipt_open})"""


TX_CHAINS = f"""WITH {TX_PAYS}, {TX_REC},
u AS (SELECT tx_id, ts, 0 AS side, seq, order_id, NULL::VARCHAR AS pay_channel FROM pays
      UNION ALL SELECT tx_id, ts, 1 AS side, seq, NULL::BIGINT, pay_channel FROM rec),
s1 AS (SELECT *, lag(side) OVER w AS prev_side, lag(ts) OVER w AS prev_ts
       FROM u WINDOW w AS (PARTITION BY tx_id ORDER BY ts, side, seq)),
s2 AS (SELECT *, CASE WHEN prev_side IS NULL OR prev_side = side
                      OR epoch_us(ts) - epoch_us(prev_ts) >
                         CASE WHEN prev_side = 0 THEN {us(C.TX_WAIT_PAY)} ELSE {us(C.TX_WAIT_RECEIPT)} END
                 THEN 1 ELSE 0 END AS start FROM s1),
s3 AS (SELECT *, sum(start) OVER (PARTITION BY tx_id ORDER BY ts, side, seq
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chain FROM s2),
s4 AS (SELECT *, row_number() OVER (PARTITION BY tx_id, chain ORDER BY ts, side, seq) AS pos,
              count(*) OVER (PARTITION BY tx_id, chain) AS chain_len FROM s3),
pairs AS (SELECT tx_id, chain, (pos + 1) // 2 AS pair_no, count(*) AS k,
                 max(order_id) AS order_id, max(CASE WHEN side = 0 THEN ts END) AS pay_ts,
                 max(CASE WHEN side = 0 THEN seq END) AS pay_seq, max(pay_channel) AS pay_channel,
                 max(CASE WHEN side = 1 THEN ts END) AS receipt_ts,
                 max(CASE WHEN side = 1 THEN seq END) AS receipt_seq
          FROM s4 GROUP BY tx_id, chain, (pos + 1) // 2)"""
TX_MATCHED = TX_CHAINS + """
SELECT tx_id, order_id, pay_ts, pay_seq, pay_channel, receipt_ts, receipt_seq FROM pairs WHERE k = 2"""
TX_UNMATCHED = TX_CHAINS + """
SELECT tx_id, order_id, pay_ts, pay_seq, pay_channel, receipt_ts, receipt_seq FROM pairs WHERE k = 1"""


def _late_sql(src: str, size: int, slide: int, bound: int, allowed: int, extra: str = "") -> str:
    """(row, window) pairs with the watermark seen on arrival and the status."""
    k = size // slide
    return f"""lw AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY seq, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {bound} AS wm_us
            FROM {src}),
lx AS (SELECT *, {end_of('epoch_us(ts)', slide, 'i')} AS e,
              {end_of('epoch_us(ts)', slide, str(k - 1))} AS last_e FROM lw CROSS JOIN range({k}) t(i)),
ls AS (SELECT *, CASE WHEN wm_us IS NULL OR e - 1 > wm_us THEN 'on_time'
                      WHEN e - 1 + {allowed} > wm_us THEN 'late_update'
                      ELSE 'expired' END AS status FROM lx){extra}"""


L = C.LATE
LATE_SRC = "(SELECT event_id, ts, event_type, event_id + (event_id * 17) % 40 AS seq FROM events)"
LATE_CTE = _late_sql(LATE_SRC, us(L["size"]), us(L["slide"]), us(L["bound"]), us(L["allowed"]))

HP = C.HOT_PAGES
PAGES_SRC = f"(SELECT * FROM acc WHERE method = 'GET' AND NOT {STATIC})"
HOT_PAGES = f"""WITH {ACCESS},
{_late_sql(PAGES_SRC, us(HP['size']), us(HP['slide']), us(HP['bound']), us(HP['allowed']))},
cnts AS (SELECT url, make_timestamp(e) AS window_end, count(*) AS cnt FROM ls
         WHERE status <> 'expired' GROUP BY ALL)
SELECT url, window_end, cnt, rank FROM ({_top('SELECT * FROM cnts', 'url', HP['n'])})"""

CUT = C.CHANGELOG_CUTOFF.strftime("%Y-%m-%d %H:%M:%S")
CHANGELOG = f"""WITH {PV},
prev AS (SELECT item_id, window_end, cnt, rank FROM ({_top(_hot_items_windows(f"(SELECT * FROM pv WHERE ts < TIMESTAMP '{CUT}')"), 'item_id', C.HOT_ITEMS['n'])})),
curr AS (SELECT item_id, window_end, cnt, rank FROM ({_top(_hot_items_windows(), 'item_id', C.HOT_ITEMS['n'])}))
SELECT *, '-' AS op FROM (SELECT * FROM prev EXCEPT ALL SELECT * FROM curr)
UNION ALL
SELECT *, '+' AS op FROM (SELECT * FROM curr EXCEPT ALL SELECT * FROM prev)"""

REPORT = f"""WITH {PV}, top AS ({HOT_ITEMS_TOPN.replace(f'WITH {PV}', '')}),
lines AS (SELECT window_end, rank, 'NO' || rank || ': 商品ID=' || item_id || chr(9) || ' 点击量=' || cnt
                 || chr(9) || ' 窗口结束时间=' || (epoch_us(window_end) // 1000) || chr(10) AS line FROM top)
SELECT window_end, '窗口结束时间：' || {ts_text('window_end')} || chr(10) || string_agg(line, '' ORDER BY rank)
       || '========================' || chr(10) || chr(10) AS report
FROM lines GROUP BY window_end"""

POLY = ("list_reduce(list_transform(str_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
        "lambda a, c: (a * 61 + c) % 536870912)")
HOUR = 3_600_000_000


ORACLE: dict[str, str] = {
    "parse_ad_click": f"""WITH {ADS} SELECT user_id, ad_id, coalesce(province, '') AS province,
        coalesce(city, '') AS city, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts FROM ads""",
    "parse_login": f"""WITH {LOGINS} SELECT user_id, ip, event_type,
        make_timestamp((us // 1000000) * 1000000) AS ts FROM lg""",
    "parse_order": f"""WITH {ORDERS} SELECT order_id, t AS event_type,
        CASE WHEN t = 'pay' THEN CAST(order_id AS VARCHAR) ELSE '' END AS tx_id,
        make_timestamp((us // 1000000) * 1000000) AS ts FROM od""",
    "parse_receipt": f"""WITH {TX_REC} SELECT tx_id, pay_channel,
        make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts FROM rec""",
    "channel_sliding_dense": f"""WITH {MARKET}, x AS (
          SELECT channel, behavior, {end_of('epoch_us(ts)', HOUR, 'i')} AS e
          FROM mk CROSS JOIN range({M_SIZE // HOUR}) t(i) WHERE behavior <> 'uninstall')
        SELECT channel, behavior, make_timestamp(e - {M_SIZE}) AS window_start, make_timestamp(e) AS window_end,
               count(*) AS cnt FROM x GROUP BY ALL""",
    "sequence_3step": f"""WITH {LOGINS},
        o AS (SELECT user_id, event_type, ts, us,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS rn FROM lg),
        m AS (SELECT a.user_id, a.ts AS first_ts, a.us AS first_us,
                     CASE WHEN b.event_type = 'fail' THEN b.ts END AS second_ts, b.rn AS brn
              FROM o a LEFT JOIN o b ON a.user_id = b.user_id AND b.rn = a.rn + 1 WHERE a.event_type = 'fail'),
        r AS (SELECT m.*, (SELECT min(c.us) FROM o c WHERE c.user_id = m.user_id AND c.rn > m.brn
                           AND c.event_type = 'success') AS relief_us FROM m),
        k AS (SELECT *, second_ts IS NOT NULL AND epoch_us(second_ts) - first_us < {us(C.DAY)} AS ok2 FROM r),
        f AS (SELECT *, ok2 AND relief_us IS NOT NULL AND relief_us - first_us < {us(C.DAY)} AS ok3 FROM k)
        SELECT user_id, CASE WHEN ok3 THEN 'MATCH' ELSE 'TIMEOUT' END AS tag,
               CAST(1 + coalesce(CAST(ok2 AS INT), 0) + coalesce(CAST(ok3 AS INT), 0) AS INT) AS steps, first_ts,
               CASE WHEN ok2 THEN second_ts END AS second_ts,
               CASE WHEN ok3 THEN make_timestamp(relief_us) END AS relief_ts FROM f""",
    "parse_behavior": f"""SELECT user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
        'pv' AS behavior, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts
        FROM events WHERE event_type = 'view'""",
    "access_log_parse": f"WITH {ACCESS} SELECT ip, user_id, ts, method, url FROM acc",
    "static_filter": f"""WITH {ACCESS} SELECT ip, user_id, ts, method, url FROM acc
        WHERE method = 'GET' AND NOT {STATIC}""",
    "channel_exclude": f"""WITH {MARKET} SELECT user_id, behavior, channel, ts FROM mk
        WHERE behavior IS DISTINCT FROM 'uninstall'""",
    "hot_items_topn": HOT_ITEMS_TOPN,
    "hot_items_sql": f"""WITH {PV} SELECT item_id, window_end, cnt, row_num
        FROM ({_top(_hot_items_windows(), 'item_id', C.HOT_ITEMS['n'], 'row_num')})""",
    "ranking_report": REPORT,
    "topn_changelog": CHANGELOG,
    "pv_hourly": f"""WITH {PV} SELECT make_timestamp({end_of('us', HOUR)}) AS window_end, count(*) AS cnt
        FROM pv GROUP BY 1""",
    "pv_salted": f"""WITH {PV} SELECT make_timestamp({end_of('us', HOUR)}) AS window_end, count(*) AS cnt
        FROM pv GROUP BY 1""",
    "uv_exact": f"""WITH {PV} SELECT make_timestamp({end_of('us', HOUR)}) AS window_end,
        count(DISTINCT user_id) AS uv FROM pv GROUP BY 1""",
    "uv_bitmap": f"""WITH {PV} SELECT make_timestamp({end_of('us', HOUR)}) AS window_end,
        count(DISTINCT {POLY}) AS uv FROM pv GROUP BY 1""",
    "uv_running": f"""WITH {PV}, h AS (SELECT *, {end_of('us', HOUR)} AS e, {POLY} AS hv FROM pv),
        f AS (SELECT *, row_number() OVER (PARTITION BY e, hv ORDER BY ts, seq) AS rn FROM h)
        SELECT make_timestamp(e) AS window_end, ts, seq,
               row_number() OVER (PARTITION BY e ORDER BY ts, seq) AS uv FROM f WHERE rn = 1""",
    "hot_pages_topn": HOT_PAGES,
    "late_classify": f"""WITH {LATE_CTE}
        SELECT event_id, ts, seq, make_timestamp(e) AS window_end, status FROM ls""",
    "late_rows": f"""WITH {LATE_CTE}
        SELECT DISTINCT event_id, ts, seq, make_timestamp(wm_us) AS wm FROM ls
        WHERE e = last_e AND status = 'expired'""",
    "lateness_counts": f"""WITH {LATE_CTE}
        SELECT event_type, make_timestamp(e) AS window_end,
               CAST(count(*) FILTER (WHERE status = 'on_time') AS BIGINT) AS cnt_on_time,
               CAST(count(*) AS BIGINT) AS cnt,
               CAST(count(*) FILTER (WHERE status = 'late_update') AS BIGINT) AS late_updates
        FROM ls WHERE status <> 'expired' GROUP BY ALL""",
    "channel_sliding": f"""WITH {MARKET}, src AS (SELECT * FROM mk WHERE behavior <> 'uninstall'),
        {sparse_sliding('src', ['channel', 'behavior'], M_SIZE, M_SLIDE)}""",
    "ad_passed": f"""WITH {ADS} SELECT user_id, ad_id, province, city, ts, day FROM ranked
        WHERE day_rank <= {C.AD_CAP}""",
    "ad_warnings": f"""WITH {ADS} SELECT user_id, ad_id, day, ts, 'Click Over {C.AD_CAP} times today.' AS msg
        FROM ranked WHERE day_rank = {C.AD_CAP + 1}""",
    "ad_province": f"""WITH {ADS}, src AS (SELECT * FROM ranked WHERE day_rank <= {C.AD_CAP}),
        {sparse_sliding('src', ['province'], M_SIZE, M_SLIDE)}""",
    "login_bursts": BURSTS,
    "login_pairs": f"""WITH {LOGINS}
        SELECT user_id, prev_ts AS first_fail_ts, ts AS last_fail_ts, CAST(2 AS BIGINT) AS fail_times,
               user_id || ' login fail 2 times in {LW_TXT} seconds.' AS warn_msg
        FROM lgp WHERE event_type = 'fail' AND prev_type = 'fail' AND us - prev_us <= {LW}""",
    "login_pattern": f"""WITH {LOGINS}
        SELECT user_id, prev_ts AS first_fail_ts, ts AS last_fail_ts, CAST(2 AS BIGINT) AS fail_times,
               'login fail LoginEvent(' || user_id || ',' || prev_ip || ',fail,' || (prev_us // 1000000) || ')'
                   AS warn_msg
        FROM lgp WHERE event_type = 'fail' AND prev_type = 'fail' AND us - prev_us < {LW}""",
    "order_paid": ORDER_PAID,
    "order_timeouts": ORDER_TIMEOUTS,
    "order_status": ORDER_STATUS,
    "tx_interval_join": TX_JOIN,
    "tx_outer_join": _tx_outer(),
    "tx_matched": TX_MATCHED,
    "tx_unmatched": TX_UNMATCHED,
}

# Streams (contract C10): what the watermark, the latest instant of the rows a job reads, has closed.


def _closed(query: str, column: str, types: str = "", sign: str = "<", cols: str = "*") -> str:
    where = f" WHERE event_type IN ({types})" if types else ""
    return (f"SELECT {cols} FROM ({ORACLE[query]}) WHERE {column} {sign} "
            f"(SELECT date_trunc('milliseconds', max(ts)) FROM events{where})")


ORACLE |= {
    "stream_hot_items": _closed("hot_items_topn", "window_end", "'view', 'pv'", "<="),
    "stream_uv": _closed("uv_exact", "window_end", "'view'", "<="),
    "stream_tx_join": TX_JOIN,
    "stream_login_pairs": _closed("login_pairs", "last_fail_ts", cols="* EXCLUDE (fail_times)"),
    "stream_order_paid": _closed("order_paid", "pay_ts", "'signup', 'purchase'", cols="* EXCLUDE (msg)"),
    "stream_ad_passed": _closed("ad_passed", "ts", "'click'"),
}


def _latest(types: str) -> str:
    return f"(SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_type IN ({types}))"


# a report that waits for a time-out is out once the watermark has reached it, or once the key's next row was read
_ORDERS_WM = _latest("'signup', 'purchase'")
_TX_WM = f"least({_latest(chr(39) + 'purchase' + chr(39))}, {_latest(chr(39) + 'view' + chr(39))})"
_READ = "events AS (SELECT * FROM main.events WHERE ts < {wm}), "


def _read_before(query: str, wm: str) -> str:
    """The query over the events before the watermark."""
    return ORACLE[query].replace("WITH ", "WITH " + _READ.format(wm=wm.replace("FROM events", "FROM main.events")), 1)




def _late_wm(src: str, bound) -> str:
    """The contract's watermark after the last row, as Spark's timers see it (in milliseconds)."""
    return f"(SELECT (max(epoch_us(ts)) - {us(bound)}) // 1000 * 1000 FROM {src})"


_PAGE_SPAN, _PAGE_SLIDE = us(HP["size"]), us(HP["slide"])

ORACLE |= {
    "stream_order_status": f"""SELECT * FROM ({_read_before('order_status', _ORDERS_WM)}) s
        WHERE status <> 'created_timeout' OR epoch_us(create_ts) + {OT} <= epoch_us({_ORDERS_WM})
           OR EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.order_id AND e.event_type IN ('signup', 'purchase')
                      AND e.ts > s.create_ts AND e.ts < {_ORDERS_WM})""",
    "stream_login_bursts": f"""SELECT * FROM ({BURSTS}) WHERE epoch_us(first_fail_ts) + {LW} <
        (SELECT epoch_us(date_trunc('milliseconds', max(ts))) FROM events)""",
    "stream_tx_outer": _tx_outer(f"epoch_us(p.ts) + {us(C.TX_UPPER)} >= epoch_us({_TX_WM})",
                                 f"epoch_us(r.ts) - {us(C.TX_LOWER)} >= epoch_us({_TX_WM})"),
    "stream_changelog": ORACLE["hot_items_topn"],
    "stream_tx_matched": _read_before("tx_matched", _TX_WM),
    "stream_tx_unmatched": f"""SELECT * FROM ({_read_before('tx_unmatched', _TX_WM)}) s
        WHERE epoch_us(coalesce(pay_ts, receipt_ts)) + CASE WHEN pay_ts IS NULL THEN {us(C.TX_WAIT_RECEIPT)}
              ELSE {us(C.TX_WAIT_PAY)} END < epoch_us({_TX_WM})
           OR EXISTS (SELECT 1 FROM events e WHERE CAST(e.user_id AS VARCHAR) = s.tx_id
                      AND e.event_type IN ('purchase', 'view')
                      AND e.ts > coalesce(s.pay_ts, s.receipt_ts) AND e.ts < {_TX_WM})""",
    "stream_sequence_3step": _closed("sequence_3step", "relief_ts"),
    "stream_late_rows": ORACLE["late_rows"],
    "stream_lateness_counts": ORACLE["lateness_counts"].replace(
        "WHERE status <> 'expired'", f"WHERE status <> 'expired' AND e <= {_late_wm('events', L['bound'])}"),
    "stream_hot_pages": HOT_PAGES.replace(
        "WHERE status <> 'expired'", f"WHERE status <> 'expired' AND e - e % {_PAGE_SPAN} + "
        f"{_PAGE_SPAN - _PAGE_SLIDE} <= {_late_wm(PAGES_SRC, HP['bound'])}"),
    "stream_uv_running": ORACLE["uv_bitmap"],
    "stream_uvcount": ORACLE["uv_bitmap"],
    "text_scan": ORACLE["parse_behavior"],
}
