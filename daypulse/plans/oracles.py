"""DuckDB oracles (``oracle_sql()``): for each registered query an
independent SQL formulation over the same test tables.

They are written from the definitions in SURVEY §2, not from Spark plans:
join chains where the Spark side folds into one pass, ``COUNT(DISTINCT)``
over explicit copies where the Spark side uses interval sums, window
ranking where the Spark side uses ``max_by``.
"""

from __future__ import annotations

from daypulse.fixtures import ADAPTER_SQL

# ---------------------------------------------------------------- pieces
_MALFORMED = r"%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)"


def _decode(x: str) -> str:
    """Java URLDecoder semantics: '+' is a blank; a bad escape leaves the
    whole input unchanged; null -> ''."""
    return (f"CASE WHEN {x} IS NULL THEN '' WHEN regexp_matches({x}, '{_MALFORMED}') THEN {x} "
            f"ELSE url_decode(replace({x}, '+', ' ')) END")


_PROTO = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"

# client_log plus: path (decoded, /wechat kept), clean, is_wechat, steps.
CLIENT_PATHS = f"""
cp1 AS (SELECT *, {_decode('url')} AS dec1 FROM client_log),
cp2 AS (SELECT *, regexp_extract(dec1, '{_PROTO}', 1) AS proto,
                  regexp_extract(dec1, '{_HOST}', 1) AS host FROM cp1),
cp3 AS (SELECT *, replace(replace(replace(dec1, host, ''), proto || '://', ''), '/index.html?#', '') AS stripped
        FROM cp2),
cp4 AS (SELECT *, CASE WHEN proto = '' THEN NULL ELSE {_decode('stripped')} END AS path FROM cp3),
cp5 AS (SELECT *, replace(replace(CASE WHEN suffix(path, '/') THEN path ELSE path || '/' END, '/', '//'),
                          'wechat', '') AS p0 FROM cp4),
cp6 AS (SELECT *, list_reduce(list_prepend(p0, regexp_extract_all(p0, 'name//([^/]*)/', 1)),
                              lambda acc, v: replace(acc, v, '')) AS p1 FROM cp5),
cp7 AS (SELECT *, list_reduce(list_prepend('', regexp_extract_all(p1, '/([a-z][a-z,A-Z]*)/', 1)),
          lambda acc, g: CASE WHEN suffix(acc, '|') THEN left(acc, length(acc) - 1)
                              ELSE acc || g || '/' || CASE WHEN g IN ('talkcloud', 'name') THEN '|' ELSE '' END
                         END) AS folded FROM cp6),
client_paths AS (
  SELECT *,
    CASE WHEN starts_with(path, '/wechat') THEN replace(path, '/wechat', '') ELSE path END AS clean,
    starts_with(path, '/wechat') AS is_wechat,
    CASE WHEN path IS NULL THEN NULL WHEN starts_with(p1, '/') THEN rtrim(folded, '|') ELSE '' END AS steps
  FROM cp7)"""

PAGE_PATHS = CLIENT_PATHS.replace("FROM client_log", "FROM page_view")

def _ip_num(x: str) -> str:
    """Four parts, each the plain text of a number up to 255; else 0."""
    plain = "TRY_CAST(p AS BIGINT) BETWEEN 0 AND 255 AND CAST(TRY_CAST(p AS BIGINT) AS VARCHAR) = p"
    parts = f"string_split(coalesce({x}, ''), '.')"
    return (f"CASE WHEN len({parts}) = 4 AND len(list_filter({parts}, lambda p: coalesce({plain}, false))) = 4 THEN "
            f"CAST(split_part({x}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({x}, '.', 2) AS BIGINT) * 65536"
            f" + CAST(split_part({x}, '.', 3) AS BIGINT) * 256 + CAST(split_part({x}, '.', 4) AS BIGINT) ELSE 0 END")


def _rx(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def _ua(x: str) -> str:
    def after(tag):
        word = f"string_split(string_split(replace(replace(replace({x}, chr(9), ' '), chr(10), ' '), chr(13), ' '), '{tag}')[2] || ' ', ' ')[1]"
        return f"CASE WHEN contains({x}, '{tag}') THEN {word} ELSE 'unknown' END"

    android = r"Android [0-9.]+; ([^;)]+)"
    os = (f"CASE WHEN {_rx(x, '(?:iPhone|CPU) OS ')} THEN 'iOS' WHEN {_rx(x, 'Android')} THEN 'Android' "
          f"WHEN {_rx(x, 'Windows NT')} THEN 'Windows' WHEN {_rx(x, 'Mac OS X')} THEN 'Mac OS X' "
          f"WHEN {_rx(x, 'Linux')} THEN 'Linux' ELSE 'Other' END")
    major = (f"CASE WHEN {_rx(x, 'OS ([0-9]+)_')} THEN regexp_extract({x}, 'OS ([0-9]+)_', 1) "
             f"WHEN {_rx(x, 'Android ([0-9]+)')} THEN regexp_extract({x}, 'Android ([0-9]+)', 1) "
             f"WHEN {_rx(x, 'Windows NT ([0-9]+)')} THEN regexp_extract({x}, 'Windows NT ([0-9]+)', 1) "
             f"WHEN {_rx(x, 'Mac OS X ([0-9]+)')} THEN regexp_extract({x}, 'Mac OS X ([0-9]+)', 1) "
             f"ELSE '' END")
    return f"""
    CASE WHEN {_rx(x, 'iPad')} THEN 'iPad' WHEN {_rx(x, 'iPhone')} THEN 'iPhone'
         WHEN {_rx(x, android)} THEN regexp_extract({x}, '{android}', 1) ELSE 'Unknown device' END AS device,
    {os} AS os,
    {os} || ' ' || {major} AS os_version,
    {after('Language/')} AS language,
    {after('NetType/')} AS network,
    CASE WHEN {_rx(x, 'MicroMessenger/')} THEN 'WeChat' WHEN {_rx(x, 'Edge?/')} THEN 'Edge'
         WHEN {_rx(x, 'Chrome/')} THEN 'Chrome' WHEN {_rx(x, 'Firefox/')} THEN 'Firefox'
         WHEN {_rx(x, 'Safari/')} THEN 'Safari' WHEN {_rx(x, 'curl/')} THEN 'curl'
         WHEN {_rx(x, 'iPhone|iPad')} THEN 'Mobile Safari UI/WKWebView' ELSE 'Other' END AS browser"""


GEO = """
ips AS (SELECT DISTINCT ip FROM client_log),
ipn AS (SELECT ip, {ipnum} AS ip_num FROM ips),
ranges AS (SELECT start_ip, end_ip, concat_ws(' ', country, local_city) AS loc FROM geo_range),
hits AS (SELECT ipn.ip, ipn.ip_num, r.loc,
           row_number() OVER (PARTITION BY ipn.ip ORDER BY r.start_ip DESC, r.end_ip ASC, r.loc DESC) AS rn
         FROM ipn LEFT JOIN ranges r ON ipn.ip_num BETWEEN r.start_ip AND r.end_ip),
geo AS (SELECT ip, ip_num, coalesce(loc, 'unknown') AS location FROM hits WHERE rn = 1)""".format(
    ipnum=_ip_num("ip"))

USER_DAY = """
ud AS (
  SELECT date, uid, _id,
    arg_max(app_id, (t, event_id)) AS app_id,
    arg_max(is_wechat, (t, event_id)) AS is_wechat,
    arg_max(res, (t, event_id)) AS resolution,
    arg_max(u_a, (t, event_id)) AS u_a,
    arg_max(ip, (t, event_id)) AS ip
  FROM client_paths GROUP BY date, uid, _id)"""

USER_DIMS = f"""
ud_dims AS (
  SELECT ud.date, ud.uid, ud._id, ud.app_id, ud.is_wechat, ud.resolution, geo.location AS loc, {_ua('ud.u_a')}
  FROM ud LEFT JOIN geo ON ud.ip IS NOT DISTINCT FROM geo.ip)"""

DIMS = "app_id, is_wechat, resolution, loc, device, os, os_version, language, network, browser"

SESSIONS = """
srows AS (SELECT * FROM client_log WHERE t IS NOT NULL AND uid IS NOT NULL AND _id IS NOT NULL),
sess AS (SELECT _id, coalesce(arg_min(CASE WHEN uid <> '' THEN uid END, (t, uid)), '') AS uid,
                MIN(date) AS date, MIN(t) AS start_t, MAX(t) AS end_t
         FROM srows GROUP BY _id),
dp AS (SELECT CASE WHEN uid = '' THEN 'tmp_' || _id ELSE uid END AS combined_id, date,
              CAST(SUM(end_t - start_t) AS BIGINT) AS session_length, COUNT(*) AS session_count
       FROM sess GROUP BY 1, 2),
swa AS (SELECT date, combined_id, MIN(date) OVER (PARTITION BY combined_id) AS earliest_date,
               session_length, session_count FROM dp)"""


def _with(adapters, *blocks, body: str) -> str:
    parts = [f"{n} AS ({ADAPTER_SQL[n].strip()})" for n in adapters]
    parts += [b.strip() for b in blocks]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


_SERVER = """
sl AS (SELECT event_id, line, substr(line, 25) AS body FROM server_line WHERE length(line) > 24),
srv AS (SELECT event_id, TRY_CAST(substr(line, 1, 10) AS DATE) AS date,
               json_extract_string(body, '$.actionType') AS action_type,
               CAST(json_extract(body, '$.studentId') AS BIGINT) AS student_id FROM sl)"""

_REFUND_ACTIONS = "('refund_success', 'refund_verify_failure', 'refund_apply', 'refund_cancel')"
_STATUS_NAME = ("CASE status WHEN 0 THEN '待审核' WHEN 1 THEN '审核失败' WHEN 3 THEN '退费成功(线下)' "
                "WHEN 4 THEN '已取消' WHEN 5 THEN '退费中' WHEN 6 THEN '退费成功(线上)' "
                "WHEN 7 THEN '平台处理中' ELSE '待审核' END")
_CHANNEL = ("CASE pay_channel WHEN 2 THEN '支付宝' WHEN 43 THEN '支付宝二维码' WHEN 4 THEN '微信JS' "
            "WHEN 30 THEN '微信二维码' WHEN 27 THEN '银联POS' WHEN 28 THEN '快钱POS' WHEN 99 THEN 'POS' "
            "WHEN 1 THEN '现金' ELSE '未知状态' END")
_RETENTION_CHAIN = """
users AS (SELECT date, uid FROM ud),
firsts AS (SELECT uid, MIN(date) AS earliest FROM users WHERE uid IS NOT NULL GROUP BY uid),
cur AS (SELECT date, COUNT(*) AS current FROM users GROUP BY date),
aged AS (SELECT u.date, date_diff('day', f.earliest, u.date) AS age FROM users u JOIN firsts f ON u.uid = f.uid),
r1 AS (SELECT date, COUNT(*) AS returning FROM aged WHERE age = 1 GROUP BY date),
r7 AS (SELECT date, COUNT(*) AS returning FROM aged WHERE age = 7 GROUP BY date),
r30 AS (SELECT date, COUNT(*) AS returning FROM aged WHERE age = 30 GROUP BY date),
d1 AS (SELECT cur.date, r1.returning / cur.current AS d1_retention FROM cur JOIN r1 ON cur.date = r1.date),
d7 AS (SELECT cur.date, r7.returning / cur.current AS d7_retention FROM cur JOIN r7 ON cur.date = r7.date),
d30 AS (SELECT cur.date, r30.returning / cur.current AS d30_retention FROM cur JOIN r30 ON cur.date = r30.date)"""
_RETENTION_BODY = """
SELECT coalesce(d1.date, d7.date, d30.date) AS date, d1_retention, d7_retention, d30_retention
FROM d1 FULL JOIN d7 ON d1.date = d7.date FULL JOIN d30 ON coalesce(d1.date, d7.date) = d30.date"""

_BASICS = f"""
copies AS (SELECT u.*, o.off, u.date + CAST(o.off AS INTEGER) AS day
           FROM ud_dims u, (SELECT unnest(range(0, 31)) AS off) o),
basics AS (
  SELECT day AS date, {DIMS},
    COUNT(DISTINCT CASE WHEN off = 0 THEN _id END) AS sessions,
    COUNT(DISTINCT CASE WHEN off < 1 THEN uid END) AS dau,
    COUNT(DISTINCT CASE WHEN off < 8 THEN uid END) AS wau,
    COUNT(DISTINCT CASE WHEN off < 31 THEN uid END) AS mau
  FROM copies GROUP BY day, {DIMS})"""

_PER_DAY_BASICS = """
per_day AS (SELECT date, CAST(SUM(sessions) AS BIGINT) AS sessions, CAST(SUM(dau) AS BIGINT) AS dau,
                   CAST(SUM(wau) AS BIGINT) AS wau, CAST(SUM(mau) AS BIGINT) AS mau
            FROM basics GROUP BY date)"""

_CL = ("client_log",)
_CLG = ("client_log", "geo_range")

ORACLES: dict[str, str] = {
    # --------------------------------------------------- sources / parsing
    "json_extract": _with(("event_json",), body="""
SELECT event_id, CASE WHEN json_valid(props) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       coalesce(NOT json_valid(props), FALSE) AS is_corrupt
FROM event_json"""),
    "extra_field_report": _with(("event_json_wide",), """
keyed AS (SELECT props, unnest(json_keys(props)) AS field FROM event_json_wide WHERE json_valid(props))""", body="""
SELECT field, COUNT(*) AS rows, CASE field WHEN 'ab' THEN 'OBJECT<group: STRING, seed: BIGINT>' WHEN 'tags' THEN 'ARRAY<STRING>'
  WHEN 'ratio' THEN 'DECIMAL(21,1)' END AS type FROM keyed WHERE field <> 'k' GROUP BY field"""),
    "extra_field_values": _with(("event_json_wide",), """
good AS (SELECT event_id, CASE WHEN json_valid(props) THEN props END AS props FROM event_json_wide)""", body="""
SELECT event_id, CAST(json_extract(props, '$.ab.seed') AS BIGINT) AS seed, json_extract_string(props, '$.tags[0]') AS tag,
  CAST(json_extract(props, '$.ratio') AS DOUBLE) AS ratio FROM good"""),
    "server_log_parse": _with(("server_line",), _SERVER, body="SELECT * FROM srv"),
    "scan_date_filter": _with(_CL, body="""
SELECT event_id, date, uid, event_type FROM client_log
WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""),
    "client_landing": _with(_CL, body="""
SELECT event_id, CAST(epoch_ms(t) AS DATE) AS date, uid, _id FROM client_log WHERE t IS NOT NULL"""),
    "action_router": _with(("server_line",), _SERVER, body=f"""
SELECT event_id, action_type,
  CASE WHEN action_type = 'pay' THEN 'payment' WHEN action_type IN {_REFUND_ACTIONS} THEN 'refund'
       WHEN action_type = 'student_add' THEN 'student' WHEN action_type = 'signup_class' THEN 'signup' END AS route
FROM srv"""),
    "video_playbacks": _with(_CL, body="""
SELECT date, COUNT(*) AS cnt FROM client_log
WHERE e_c = 'userBehavior' AND e_a = 'lessonPlaybackTriggered' GROUP BY date"""),
    "identity_resolve": _with(_CL, body="""
SELECT event_id, coalesce(nullif(uid, ''), _id) AS funnel_id,
       CASE WHEN uid = '' THEN 'tmp_' || _id ELSE uid END AS combined_id FROM client_log"""),
    "pay_channel_label": _with(("payment",), body=f"""
SELECT purchase_number, line_no, part_key, supp_key, pay_channel, {_CHANNEL} AS channel_label FROM payment"""),
    "refund_status_code": _with(("refund",), body=f"""
SELECT status, {_STATUS_NAME} AS status_name, COUNT(*) AS cnt
FROM refund WHERE action_type IN {_REFUND_ACTIONS} GROUP BY 1, 2"""),
    "money_truncate": _with(("payment",), body="""
SELECT date, CAST(SUM(total_price // 100) AS BIGINT) AS units_truncated,
       CAST(SUM(total_price) AS DOUBLE) / 100 AS units_exact
FROM payment GROUP BY date"""),
    "business_date": _with(("payment",), body="""
SELECT purchase_number, line_no, part_key, supp_key, coalesce(pay_date, date) AS business_date FROM payment"""),
    "refund_record": _with(("refund",), body=f"""
SELECT action_type, CAST(purchase_id AS VARCHAR) AS purchase_number, purchase_money, money AS refund_money,
       status, {_STATUS_NAME} AS status_name, date
FROM refund WHERE action_type IN {_REFUND_ACTIONS}"""),
    # ----------------------------------------------------------- URL / UA
    "url_decode": _with(_CL, body=f"SELECT event_id, {_decode('url')} AS decoded FROM client_log"),
    "url_clean": _with(_CL, CLIENT_PATHS, body="SELECT event_id, clean AS path, is_wechat FROM client_paths"),
    "url_steps": _with(_CL, CLIENT_PATHS, body="SELECT event_id, steps FROM client_paths"),
    "path_param": _with(_CL, CLIENT_PATHS, body="""
SELECT event_id,
  replace(regexp_extract(CASE WHEN suffix(clean, '/') THEN clean ELSE clean || '/' END,
                         '/homeWorkReport/([^/]*)/', 1), 'homeWorkReport', '') AS report
FROM client_paths WHERE clean IS NOT NULL"""),
    "ua_fields": _with(_CL, body=f"SELECT event_id, {_ua('u_a')} FROM client_log"),
    "ua_fields_by_rules": _with(("agent_log",), """
expected(kind, device, os, major, language, network, browser) AS (VALUES
  (0, 'iPhone', 'iOS', true, 'unknown', 'unknown', 'Safari'), (1, 'iPhone', 'iOS', true, 'zh_CN', '4G', 'WeChat'),
  (2, 'iPad', 'iOS', true, 'unknown', 'unknown', 'Chrome Mobile iOS'), (3, 'SM-G{v}0F', 'Android', true, 'unknown', 'unknown', 'Chrome'),
  (4, 'MI {v}', 'Android', true, 'unknown', 'WIFI', 'MiuiBrowser'),
  (5, 'Generic Android', 'Android', true, 'unknown', 'unknown', 'Firefox'),
  (6, 'Unknown device', 'Windows', true, 'unknown', 'unknown', 'Edge'), (7, 'Unknown device', 'Windows', true, 'unknown', 'unknown', 'IE'),
  (8, 'Mac', 'Mac OS X', true, 'unknown', 'unknown', 'Safari'), (9, 'Unknown device', 'Ubuntu', false, 'unknown', 'unknown', 'Firefox'),
  (10, 'Spider', 'Other', false, 'unknown', 'unknown', 'Googlebot'), (11, 'Unknown device', 'Other', false, 'unknown', 'unknown', 'curl'),
  (NULL, 'Unknown device', 'Other', false, 'unknown', 'unknown', 'Other')),
numbered AS (SELECT event_id, CASE WHEN u_a IS NOT NULL THEN event_id % 12 END AS kind, CAST(5 + event_id % 9 AS VARCHAR) AS v FROM agent_log)""", body="""
SELECT event_id, replace(device, '{v}', v) AS device, os, os || ' ' || CASE WHEN major THEN v ELSE '' END AS os_version, language, network, browser
FROM numbered JOIN expected ON numbered.kind IS NOT DISTINCT FROM expected.kind"""),
    "ip_to_long": _with(_CL, body=f"SELECT event_id, ip, {_ip_num('ip')} AS ip_num FROM client_log"),
    # ---------------------------------------------------------------- geo
    "geo_lookup": _with(_CLG, GEO, body="SELECT ip, ip_num, location FROM geo"),
    "geo_lookup_bucketed": _with(_CLG, GEO, body="SELECT ip, ip_num, location FROM geo"),
    # --------------------------------------------------- user-day, actives
    "user_day": _with(_CL, CLIENT_PATHS, USER_DAY, body="SELECT * FROM ud"),
    "active_users_basics": _with(_CLG, CLIENT_PATHS, GEO, USER_DAY, USER_DIMS, _BASICS,
                                 body="SELECT * FROM basics"),
    "active_users_interval": _with(_CLG, CLIENT_PATHS, GEO, USER_DAY, USER_DIMS, _BASICS,
                                   body="SELECT * FROM basics"),
    "geo_lookup_dyadic": _with(_CLG, GEO, body="SELECT ip, location FROM geo"),
    "geo_lookup_any": _with(("client_log", "any_range", "any_address"), body="""
SELECT ip, coalesce(loc, 'unknown') AS location FROM (
  SELECT ip, loc, row_number() OVER (PARTITION BY ip ORDER BY start_no DESC NULLS LAST, end_no, loc DESC) AS rn
  FROM any_address LEFT JOIN any_range ON no BETWEEN start_no AND end_no) WHERE rn = 1"""),
    "actives_by_bitmap": _with(_CLG, CLIENT_PATHS, USER_DAY, GEO, USER_DIMS, f"""
valued AS (SELECT date, uid, {', '.join(f"coalesce(CAST({d} AS VARCHAR), 'null') AS {d}" for d in DIMS.split(', '))} FROM ud_dims),
sets AS (SELECT DISTINCT date, uid, unnest([{{'dim': 'total', 'value': ''}},
    {{'dim': 'all', 'value': concat_ws('|', {DIMS})}},
    {', '.join(f"{{'dim': '{d}', 'value': {d}}}" for d in DIMS.split(', '))}]) AS s FROM valued),
moved AS (SELECT date + CAST(off AS INTEGER) AS day, off, uid, s FROM sets, (SELECT unnest(range(0, 31)) AS off))""", body="""
SELECT day AS date, s.dim AS dim, s.value AS value, COUNT(DISTINCT CASE WHEN off < 1 THEN uid END) AS dau,
       COUNT(DISTINCT CASE WHEN off < 8 THEN uid END) AS wau, COUNT(DISTINCT uid) AS mau
FROM moved GROUP BY ALL"""),
    "url_reach_sketched": _with(_CL, body="""
SELECT url, COUNT(DISTINCT coalesce(nullif(uid, ''), _id)) AS users, TRUE AS within_bound FROM client_log
WHERE url IS NOT NULL AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY url"""),
    "active_users_total": _with(_CL, CLIENT_PATHS, USER_DAY, """
copies AS (SELECT u.*, o.off, u.date + CAST(o.off AS INTEGER) AS day
           FROM ud u, (SELECT unnest(range(0, 31)) AS off) o)""", body="""
SELECT day AS date,
  COUNT(DISTINCT CASE WHEN off = 0 THEN _id END) AS sessions,
  COUNT(DISTINCT CASE WHEN off < 1 THEN uid END) AS dau,
  COUNT(DISTINCT CASE WHEN off < 8 THEN uid END) AS wau,
  COUNT(DISTINCT CASE WHEN off < 31 THEN uid END) AS mau
FROM copies GROUP BY day"""),
    "first_visit": _with(_CL, CLIENT_PATHS, USER_DAY, body="""
SELECT uid, MIN(date) AS earliest_date FROM ud WHERE uid IS NOT NULL GROUP BY uid"""),
    "high_water_mark": _with(_CL, CLIENT_PATHS, USER_DAY, body="""
SELECT CAST(MAX(date) - INTERVAL 1 DAY AS DATE) AS processed_until FROM ud"""),
    "user_age": _with(_CL, CLIENT_PATHS, USER_DAY, body="""
SELECT ud.date, ud.uid, ud._id, f.earliest_date, CAST(date_diff('day', f.earliest_date, ud.date) AS INTEGER) AS age
FROM ud JOIN (SELECT uid, MIN(date) AS earliest_date FROM ud WHERE uid IS NOT NULL GROUP BY uid) f
  ON ud.uid = f.uid"""),
    "retention_d1_d7_d30": _with(_CL, CLIENT_PATHS, USER_DAY, _RETENTION_CHAIN, body=_RETENTION_BODY),
    "retention_full_outer": _with(_CL, CLIENT_PATHS, USER_DAY, _RETENTION_CHAIN, body=_RETENTION_BODY),
    "retention_cohort": _with(("user_day_sparse",), """
act AS (SELECT DISTINCT CAST(uid AS VARCHAR) AS uid, date FROM user_day_sparse),
firsts AS (SELECT uid, MIN(date) AS cohort FROM act GROUP BY uid),
sizes AS (SELECT cohort, COUNT(*) AS cohort_size FROM firsts GROUP BY cohort),
back AS (SELECT f.cohort, date_diff('day', f.cohort, a.date) AS age FROM act a JOIN firsts f ON a.uid = f.uid)""",
                              body="""
SELECT s.cohort AS date, s.cohort_size,
  CASE WHEN s.cohort + 1 <= last.day THEN
    CAST((SELECT COUNT(*) FROM back b WHERE b.cohort = s.cohort AND b.age = 1) AS DOUBLE) / s.cohort_size END AS d1_retention,
  CASE WHEN s.cohort + 7 <= last.day THEN
    CAST((SELECT COUNT(*) FROM back b WHERE b.cohort = s.cohort AND b.age = 7) AS DOUBLE) / s.cohort_size END AS d7_retention,
  CASE WHEN s.cohort + 30 <= last.day THEN
    CAST((SELECT COUNT(*) FROM back b WHERE b.cohort = s.cohort AND b.age = 30) AS DOUBLE) / s.cohort_size END AS d30_retention
FROM sizes s, (SELECT MAX(date) AS day FROM act) last"""),
    # -------------------------------------------------------------- funnel
    "open_distribution": _with(_CL, CLIENT_PATHS, """
opens AS (
  SELECT replace(regexp_extract(CASE WHEN suffix(clean, '/') THEN clean ELSE clean || '/' END,
                                '/homeWorkReport/([^/]*)/', 1), 'homeWorkReport', '') AS report,
         coalesce(nullif(uid, ''), _id) AS who
  FROM client_paths WHERE contains(clean, 'homeWorkReport')),
per_pair AS (SELECT report, who, COUNT(*) AS times_opened FROM opens GROUP BY report, who)""", body="""
SELECT times_opened, COUNT(*) AS cnt FROM per_pair GROUP BY times_opened"""),
    "distinct_steps": _with(_CL, CLIENT_PATHS, body="""
SELECT DISTINCT coalesce(nullif(uid, ''), _id) AS uid, steps AS url FROM client_paths WHERE steps IS NOT NULL"""),
    "url_reach": _with(_CL, CLIENT_PATHS, """
pairs AS (SELECT DISTINCT coalesce(nullif(uid, ''), _id) AS uid, steps AS url
          FROM client_paths WHERE steps IS NOT NULL)""", body="""
SELECT url, COUNT(DISTINCT uid) AS reach FROM pairs GROUP BY url"""),
    "funnel_paths": _with(_CL, """
pairs AS (SELECT DISTINCT coalesce(nullif(uid, ''), _id) || '@' || CAST(date AS VARCHAR) AS who,
                 event_type AS step FROM client_log),
reach AS (SELECT step, COUNT(DISTINCT who) AS r FROM pairs GROUP BY step),
paths AS (SELECT p.who, string_agg(p.step, '>' ORDER BY reach.r DESC, p.step ASC) AS funnel
          FROM pairs p JOIN reach ON p.step = reach.step GROUP BY p.who)""", body="""
SELECT funnel, COUNT(*) AS cnt FROM paths GROUP BY funnel"""),
    "funnel_url_paths": _with(_CL, CLIENT_PATHS, """
pairs AS (SELECT DISTINCT coalesce(nullif(uid, ''), _id) AS who, steps AS step
          FROM client_paths WHERE steps IS NOT NULL),
reach AS (SELECT step, COUNT(DISTINCT who) AS r FROM pairs GROUP BY step),
paths AS (SELECT p.who, string_agg(p.step, '>' ORDER BY reach.r DESC, p.step ASC) AS funnel
          FROM pairs p JOIN reach ON p.step = reach.step GROUP BY p.who)""", body="""
SELECT funnel, COUNT(*) AS cnt FROM paths GROUP BY funnel"""),
    "top_urls": _with(_CL, CLIENT_PATHS, """
pairs AS (SELECT DISTINCT coalesce(nullif(uid, ''), _id) AS uid, steps AS url
          FROM client_paths WHERE steps IS NOT NULL)""", body="""
SELECT url, COUNT(DISTINCT uid) AS reach FROM pairs GROUP BY url ORDER BY reach DESC, url ASC LIMIT 3"""),
    "page_url_fields": _with(("page_view",), PAGE_PATHS, body="""
SELECT event_id, clean AS path, is_wechat, steps,
  replace(regexp_extract(CASE WHEN suffix(clean, '/') THEN clean ELSE clean || '/' END, '/en/([^/]*)/', 1), 'en', '') AS en
FROM client_paths"""),
    "page_funnels": _with(("page_view",), PAGE_PATHS, """
pairs AS (SELECT DISTINCT coalesce(nullif(uid, ''), _id) AS who, steps AS step
          FROM client_paths WHERE steps IS NOT NULL),
reach AS (SELECT step, COUNT(DISTINCT who) AS r FROM pairs GROUP BY step),
paths AS (SELECT p.who, string_agg(p.step, '>' ORDER BY reach.r DESC, p.step ASC) AS funnel
          FROM pairs p JOIN reach ON p.step = reach.step GROUP BY p.who)""", body="""
SELECT funnel, COUNT(*) AS cnt FROM paths GROUP BY funnel"""),
    # ------------------------------------------------------------ commerce
    "latest_per_key": _with(("payment",), """
ranked AS (SELECT *, row_number() OVER (PARTITION BY purchase_number
                                        ORDER BY date DESC, line_no DESC, part_key DESC, supp_key DESC) AS rn
           FROM payment)""", body="""
SELECT purchase_number, line_no, part_key, supp_key, total_price, pay_channel, date FROM ranked WHERE rn = 1"""),
    "revenue_by_channel": _with(("payment",), f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY purchase_number
                                        ORDER BY date DESC, line_no DESC, part_key DESC, supp_key DESC) AS rn
           FROM payment),
latest AS (SELECT purchase_number, {_CHANNEL} AS pay_channel, total_price // 100 AS total_price,
                  coalesce(pay_date, date) AS bdate FROM ranked WHERE rn = 1)""", body="""
SELECT bdate AS date, pay_channel, CAST(SUM(total_price) AS BIGINT) AS total_price,
       MAX(purchase_number) AS purchase_number
FROM latest GROUP BY bdate, pay_channel"""),
    "refund_by_status": _with(("refund",), body=f"""
SELECT date,
  CASE action_type WHEN 'refund_apply' THEN '待审核' WHEN 'refund_verify_failure' THEN '审核失败'
                   WHEN 'refund_success' THEN '退费成功' WHEN 'refund_cancel' THEN '已取消' END AS status,
  COUNT(purchase_id) AS cnt, CAST(SUM(money // 100) AS BIGINT) AS refund_money,
  CAST(SUM(purchase_money // 100) AS BIGINT) AS purchase_money
FROM refund WHERE action_type IN {_REFUND_ACTIONS} GROUP BY 1, 2"""),
    "signup_by_class": _with(("signup",), body="""
SELECT date, class_name, COUNT(purchase_id) AS cnt
FROM (SELECT date, purchase_id, unnest(class_names) AS class_name FROM signup) GROUP BY date, class_name"""),
    "students_by_day": _with(("student",), body="""
SELECT date, COUNT(*) AS cnt FROM (SELECT student_id, MAX(date) AS date FROM student GROUP BY student_id)
GROUP BY date"""),
    "dedup_payments": _with(("payment",), """
ranked AS (SELECT *, row_number() OVER (PARTITION BY purchase_number
                                        ORDER BY date, line_no, part_key, supp_key) AS rn FROM payment)""",
                            body="""
SELECT purchase_number, pay_channel, total_price, pay_date, date FROM ranked WHERE rn = 1"""),
    "dedup_refunds": _with(("refund",), f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY purchase_id, action_type
                                        ORDER BY date, status, money, purchase_money) AS rn
           FROM refund WHERE action_type IN {_REFUND_ACTIONS})""", body="""
SELECT purchase_id, action_type, status, money, purchase_money, date FROM ranked WHERE rn = 1"""),
    "star_relation": _with(("class_info", "course", "class_grade", "grade", "subject", "class_teacher", "teacher"), body="""
SELECT ci.id, ci.name || ci.open_code AS class_name, c.name AS course_name, g.name AS grade_name, c.year, c.season,
  s.name AS subject_name, t.name || t.mobile AS teacher_name
FROM class_info ci
JOIN course c ON ci.course_id = c.id
JOIN subject s ON c.subject_id = s.id
JOIN class_grade cg ON cg.class_id = ci.id
JOIN grade g ON cg.grade_id = g.id
JOIN class_teacher ct ON ct.class_id = ci.id
JOIN teacher t ON ct.teacher_usr_id = t.id
WHERE ci.is_del = 0"""),
    # ------------------------------------------------------------ sessions
    "session_rollup": _with(_CL, SESSIONS, body="SELECT * FROM sess"),
    "session_datapoints": _with(_CL, SESSIONS, body="SELECT * FROM dp"),
    "sessions_by_gap": _with(_CL, """
ev AS (SELECT CASE WHEN uid = '' THEN 'tmp_' || _id ELSE uid END AS combined_id, ts FROM client_log),
marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh
  FROM ev WHERE combined_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY combined_id ORDER BY ts)),
islands AS (SELECT *, SUM(fresh) OVER (PARTITION BY combined_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM marked)""", body="""
SELECT combined_id, epoch_us(MIN(ts)) // 1000 AS start_t, epoch_us(MAX(ts)) // 1000 AS end_t, COUNT(*) AS events,
       epoch_us(MAX(ts)) // 1000 - epoch_us(MIN(ts)) // 1000 AS session_length
FROM islands GROUP BY combined_id, island"""),
    "sessions_with_age": _with(_CL, SESSIONS, body="SELECT * FROM swa"),
    "sessions_snapshot": _with(_CL, SESSIONS, body="SELECT * FROM swa"),
    "new_users": _with(_CL, SESSIONS, body="""
SELECT date, CAST(COUNT_IF(date = earliest_date) AS BIGINT) AS new_users FROM swa GROUP BY date"""),
    "active_datapoints": _with(_CL, SESSIONS, """
daily AS (SELECT date, COUNT(*) AS n FROM swa GROUP BY date),
days AS (SELECT DISTINCT date + CAST(o.off AS INTEGER) AS day
         FROM daily, (SELECT unnest(range(0, 31)) AS off) o)""", body="""
SELECT d.day AS date,
  CAST(coalesce(SUM(CASE WHEN daily.date = d.day THEN n END), 0) AS BIGINT) AS dau,
  CAST(coalesce(SUM(CASE WHEN daily.date >= d.day - 7 THEN n END), 0) AS BIGINT) AS wau,
  CAST(coalesce(SUM(n), 0) AS BIGINT) AS mau
FROM days d JOIN daily ON daily.date BETWEEN d.day - 30 AND d.day GROUP BY d.day"""),
    "returning_counts": _with(_CL, SESSIONS, body="""
SELECT date, CAST(COUNT_IF(date_diff('day', earliest_date, date) = 1) AS BIGINT) AS d1_returning,
             CAST(COUNT_IF(date_diff('day', earliest_date, date) = 7) AS BIGINT) AS d7_returning,
             CAST(COUNT_IF(date_diff('day', earliest_date, date) = 30) AS BIGINT) AS d30_returning
FROM swa GROUP BY date"""),
    "rows_to_json": _with(_CL, SESSIONS, body="""
SELECT CAST(to_json(struct_pack(date := date, combined_id := combined_id, earliest_date := earliest_date,
                                session_length := session_length, session_count := session_count)) AS VARCHAR) AS value
FROM swa"""),
    # ------------------------------------------------------------------ BI
    "xau_param": _with(_CL, SESSIONS, """
days AS (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS day FROM swa)""",
                       body="""
SELECT d.day AS date, COUNT(DISTINCT s.combined_id) AS xau
FROM days d LEFT JOIN swa s ON s.date BETWEEN d.day - 6 AND d.day GROUP BY d.day"""),
    "dx_retention": _with(_CL, SESSIONS, body="""
SELECT date, CAST(COUNT_IF(date_diff('day', earliest_date, date) = 1) AS DOUBLE)
             / nullif(COUNT_IF(date_diff('day', earliest_date, date) = 0), 0) AS dx_retention
FROM swa GROUP BY date"""),
    "session_time_avg": _with(_CL, SESSIONS, body="""
SELECT date, CAST(SUM(session_length) AS DOUBLE) / COUNT(*) / 1000 AS avg_session_seconds FROM swa GROUP BY date"""),
    "sessions_avg": _with(_CL, SESSIONS, body="""
SELECT date, CAST(SUM(session_count) AS DOUBLE) / COUNT(*) AS avg_sessions FROM swa GROUP BY date"""),
    "sessions_total": _with(_CL, SESSIONS, body="""
SELECT date, CAST(SUM(session_count) AS BIGINT) AS total_sessions FROM swa GROUP BY date"""),
    "users_per_day": _with(_CL, SESSIONS, body="""
SELECT date, COUNT(DISTINCT combined_id) AS users, COUNT(*) AS records FROM swa GROUP BY date"""),
    "bi_basics_per_day": _with(_CLG, CLIENT_PATHS, GEO, USER_DAY, USER_DIMS, _BASICS, _PER_DAY_BASICS,
                               body="SELECT date, sessions, dau, wau, mau FROM per_day"),
    "bi_measures_long": _with(_CLG, CLIENT_PATHS, GEO, USER_DAY, USER_DIMS, _BASICS, _PER_DAY_BASICS, body="""
SELECT date, 'dau' AS measure, dau AS value, 0 AS measure_order FROM per_day
UNION ALL SELECT date, 'wau', wau, 1 FROM per_day
UNION ALL SELECT date, 'mau', mau, 2 FROM per_day
UNION ALL SELECT date, 'sessions', sessions, 3 FROM per_day"""),
    "dense_calendar": _with(("user_day_sparse",), """
fv AS (SELECT MIN(date) AS d FROM user_day_sparse WHERE uid IS NOT NULL GROUP BY uid),
per AS (SELECT d AS date, COUNT(*) AS n FROM fv GROUP BY d),
days AS (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM per)""",
                            body="""
SELECT days.date, coalesce(per.n, 0) AS first_visits FROM days LEFT JOIN per ON days.date = per.date"""),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
