"""Independent SQL (DuckDB dialect) for every registered answer.

Written from the question, not from the Spark code: the same input
derivations as ``plans.fixtures`` and the straightforward SQL for each
answer (windows with QUALIFY, joins, GROUP BY). Column names and types
match the Spark results. k-means has no SQL counterpart.
"""

from __future__ import annotations

from pagetrail.plans import registry as R

_PV_SELECT = """
  SELECT e.ts AS timeCreate,
         {cookie} AS cookieCreate,
         CAST((e.event_id * 31 + e.user_id) % 5 AS INTEGER) AS browserCode,
         'v' || CAST(e.event_id % 9 AS VARCHAR) AS browserVer,
         CAST(e.event_id % 7 AS INTEGER) AS osCode,
         'o' || CAST(e.event_id % 4 AS VARCHAR) AS osVer,
         CAST((e.event_id * 17 + e.user_id) % 4001 AS BIGINT) AS ip,
         CAST(e.event_id % 13 AS INTEGER) AS locId,
         regexp_extract(p.url, '^https?://([^/?#]+)', 1) AS domain,
         CAST(e.event_id % 6 AS INTEGER) AS siteId,
         CAST(e.event_id % 8 AS INTEGER) AS cId,
         regexp_extract(p.url, '^https?://[^/?#]+(/[^?#]*)', 1) AS path,
         CAST(NULL AS VARCHAR) AS referer,
         e.user_id AS guid,
         'none' AS flashVersion,
         CAST(e.event_id % 2 AS VARCHAR) AS jre,
         '1920x1080' AS sr,
         '24' AS sc,
         CAST(e.event_id % 3 AS INTEGER) AS geographic,
         CAST(e.event_id % 10 AS INTEGER) AS category,
         e.event_id AS event_id
  FROM {events} e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
"""

PAGEVIEW = "pageview AS (" + _PV_SELECT.format(
    cookie="CAST(date_trunc('hour', e.ts) AS TIMESTAMP)", events="events"
) + ")"

PAGEVIEW_FIRST_SEEN = (
    "ev_first AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events),\n"
    "pageview AS (" + _PV_SELECT.format(cookie="e.first_ts", events="ev_first") + ")"
)

# Puts of the cookie-keyed table (times as epoch millis, null defaults) and
# the surviving row of every key: latest view, then the larger event id.
PUTS = """
puts AS (
  SELECT coalesce((epoch_us(cookieCreate) // 1000), 0) AS row_key,
         coalesce((epoch_us(timeCreate) // 1000), 0) AS timeCreate,
         coalesce((epoch_us(cookieCreate) // 1000), 0) AS cookieCreate,
         coalesce(browserCode, 0) AS browserCode, coalesce(browserVer, '') AS browserVer,
         coalesce(osCode, 0) AS osCode, coalesce(osVer, '') AS osVer,
         coalesce(ip, 0) AS ip, coalesce(locId, 0) AS locId,
         coalesce(domain, '') AS domain, coalesce(siteId, 0) AS siteId,
         coalesce(cId, 0) AS cId, coalesce(path, '') AS path,
         coalesce(referer, '') AS referer, coalesce(guid, 0) AS guid,
         coalesce(flashVersion, '') AS flashVersion, coalesce(jre, '') AS jre,
         coalesce(sr, '') AS sr, coalesce(sc, '') AS sc,
         coalesce(geographic, 0) AS geographic, coalesce(category, 0) AS category,
         event_id
  FROM pageview
),
survivors AS (
  SELECT * FROM puts
  QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY timeCreate DESC, event_id DESC) = 1
)"""

CELLS = (
    "timeCreate, cookieCreate, browserCode, browserVer, osCode, osVer, ip, locId, domain, "
    "siteId, cId, path, referer, guid, flashVersion, jre, sr, sc, geographic, category"
)

WORKFORCE = """
departments AS (
  SELECT 'd' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS dept_no, n_name AS dept_name FROM nation
),
employees AS (
  SELECT c_custkey AS emp_no, DATE '1960-01-01' AS birth_date, c_name AS first_name,
         c_mktsegment AS last_name, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         DATE '1990-01-01' AS hire_date
  FROM customer
),
dept_emp AS (
  SELECT c_custkey AS emp_no, 'd' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS dept_no,
         DATE '1995-01-01' AS from_date, DATE '9999-01-01' AS to_date
  FROM customer
),
dept_manager AS (
  SELECT dept_no, min(emp_no) AS emp_no, DATE '1995-01-01' AS from_date, DATE '9999-01-01' AS to_date
  FROM dept_emp GROUP BY dept_no
),
titles AS (
  SELECT o_custkey AS emp_no, min(o_orderpriority) AS title, CAST(o_orderdate AS DATE) AS from_date,
         DATE '9999-01-01' AS to_date
  FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
),
salary_days AS (
  SELECT o_custkey AS emp_no, CAST(o_orderdate AS DATE) AS from_date,
         CAST(max(floor(o_totalprice)) AS BIGINT) AS salary
  FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
),
salaries AS (
  SELECT emp_no, salary, from_date,
         coalesce(lead(from_date) OVER (PARTITION BY emp_no ORDER BY from_date), DATE '9999-01-01') AS to_date
  FROM salary_days
),
flat AS (
  SELECT de.dept_no || '_' || CAST(de.emp_no AS VARCHAR) AS dept_emp,
         de.from_date AS de_from_date, de.to_date AS de_to_date,
         e.emp_no, e.birth_date, e.first_name, e.last_name, e.gender, e.hire_date,
         d.dept_no, d.dept_name, dm.from_date AS dm_from_date, dm.to_date AS dm_to_date
  FROM dept_emp de
  LEFT JOIN employees e ON de.emp_no = e.emp_no
  LEFT JOIN departments d ON de.dept_no = d.dept_no
  LEFT JOIN dept_manager dm ON de.dept_no = dm.dept_no AND de.emp_no = dm.emp_no
),
keyed_salaries AS (
  SELECT CAST(emp_no AS VARCHAR) || '_' || CAST(from_date AS VARCHAR) AS row_key,
         from_date, to_date, salary, emp_no
  FROM salaries
),
keyed_titles AS (
  SELECT CAST(emp_no AS VARCHAR) || '_' || CAST(from_date AS VARCHAR) AS row_key,
         from_date, to_date, title, emp_no
  FROM titles
)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _millis(t) -> int:
    return int(t.timestamp() * 1000)


T1, T2 = _millis(R.T1), _millis(R.T2)
PERSON = "f.emp_no, f.birth_date, f.first_name, f.last_name, f.gender, f.hire_date"

ORACLE_SQL: dict[str, str] = {
    "pv_top_url_per_guid_day": _w(PAGEVIEW)
    + """
SELECT guid, timeCreate, path, access_count,
       CAST(row_number() OVER (PARTITION BY guid, timeCreate
                               ORDER BY access_count DESC, path ASC NULLS FIRST) AS INTEGER) AS rank
FROM (SELECT guid, CAST(timeCreate AS DATE) AS timeCreate, path, count(*) AS access_count
      FROM pageview GROUP BY guid, CAST(timeCreate AS DATE), path)
QUALIFY rank = 1""",
    "pv_top_ips_by_guid": _w(PAGEVIEW)
    + """
SELECT ip, count(DISTINCT guid) AS guid_count FROM pageview GROUP BY ip
ORDER BY guid_count DESC, ip ASC NULLS FIRST LIMIT 1000""",
    "pv_top_domains": _w(PAGEVIEW)
    + """
SELECT domain, count(*) AS count FROM pageview GROUP BY domain
ORDER BY count DESC, domain ASC NULLS FIRST LIMIT 100""",
    "pv_top_locs_by_ip": _w(PAGEVIEW)
    + """
SELECT locId, count(DISTINCT ip) AS unique_ip_count FROM pageview GROUP BY locId
ORDER BY unique_ip_count DESC, locId ASC NULLS FIRST LIMIT 10""",
    "pv_top_browser_per_os": _w(PAGEVIEW)
    + """
SELECT osCode, browserCode,
       CAST(row_number() OVER (PARTITION BY osCode ORDER BY count DESC, browserCode ASC NULLS FIRST) AS INTEGER) AS rank
FROM (SELECT osCode, browserCode, count(*) AS count FROM pageview GROUP BY osCode, browserCode)
QUALIFY rank = 1""",
    "pv_gap_export": _w(PAGEVIEW)
    + f"""
SELECT concat_ws(chr(9), CAST(guid AS VARCHAR), domain, path, CAST(timeCreate AS VARCHAR)) AS concatenated
FROM pageview WHERE timeCreate > cookieCreate + INTERVAL {R.GAP_SECONDS} SECOND""",
    "pv_gap_600000s": _w(PAGEVIEW_FIRST_SEEN)
    + f"""
SELECT concat_ws(chr(9), CAST(guid AS VARCHAR), domain, path, CAST(timeCreate AS VARCHAR)) AS concatenated
FROM pageview
WHERE epoch_us(timeCreate) // 1000000 > epoch_us(cookieCreate) // 1000000 + {R.GAP_SECONDS_LITERAL}""",
    "kv_upsert_pageview": _w(PAGEVIEW, PUTS) + f"SELECT row_key, {CELLS} FROM survivors",
    "kv_urls_of_guid_day": _w(PAGEVIEW)
    + f"""
SELECT path FROM (
  SELECT CAST(guid AS VARCHAR) || '_' || CAST(timeCreate AS VARCHAR) AS row_key,
         coalesce(path, '') AS path, timeCreate, event_id
  FROM pageview)
WHERE starts_with(row_key, '{R.GUID}_{R.DAY}')
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY timeCreate DESC, event_id DESC) = 1""",
    "kv_ips_of_guid": _w(PAGEVIEW, PUTS)
    + f"""
SELECT s.ip AS ip, count(*) AS count
FROM puts l JOIN survivors s ON l.row_key = s.row_key
WHERE s.guid = {R.GUID} GROUP BY s.ip""",
    "kv_last_visit": _w(PAGEVIEW, PUTS)
    + f"""
SELECT s.guid AS guid, s.timeCreate AS timeCreate, s.ip AS ip
FROM puts l JOIN survivors s ON l.row_key = s.row_key
WHERE s.guid = {R.GUID}
ORDER BY s.timeCreate DESC, s.ip ASC, s.row_key ASC LIMIT 1""",
    "kv_guids_os_browser_time": f"""
WITH l AS (
  SELECT epoch_us(date_trunc('hour', e.ts)) // 1000 AS row_key, epoch_us(e.ts) // 1000 AS timeCreate, e.event_id, e.user_id AS guid,
         CAST(e.event_id % 7 AS INTEGER) AS osCode, CAST((e.event_id * 31 + e.user_id) % 5 AS INTEGER) AS browserCode
  FROM events e JOIN (SELECT page_id FROM pages) p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
), s AS (
  SELECT row_key, count(*) AS views, max_by(struct_pack(guid, timeCreate, osCode, browserCode), struct_pack(a := timeCreate, b := event_id)) AS v
  FROM l GROUP BY row_key
)
SELECT v.guid AS guid, v.timeCreate AS timeCreate, v.osCode AS osCode, v.browserCode AS browserCode FROM s, range(views)
WHERE v.osCode = {R.OS_CODE} AND v.browserCode = {R.BROWSER_CODE} AND v.timeCreate > {T1} AND v.timeCreate < {T2}""",
    "kv_ips_of_guid_log": _w(PAGEVIEW)
    + f"SELECT ip, count(*) AS count FROM pageview WHERE guid = {R.GUID} GROUP BY ip",
    "kv_last_visit_log": _w(PAGEVIEW)
    + f"""
SELECT guid, (epoch_us(timeCreate) // 1000) AS timeCreate, ip FROM pageview WHERE guid = {R.GUID}
ORDER BY timeCreate DESC, ip ASC LIMIT 1""",
    "kv_guids_os_browser_time_log": _w(PAGEVIEW)
    + f"""
SELECT guid, (epoch_us(timeCreate) // 1000) AS timeCreate, osCode, browserCode FROM pageview
WHERE osCode = {R.OS_CODE} AND browserCode = {R.BROWSER_CODE}
  AND (epoch_us(timeCreate) // 1000) > {T1} AND (epoch_us(timeCreate) // 1000) < {T2}""",
    "emp_flat_dept_emp": _w(WORKFORCE)
    + """
SELECT dept_emp AS row_key, de_from_date, de_to_date, emp_no, birth_date, first_name, last_name,
       gender, hire_date, dept_no, dept_name, dm_from_date, dm_to_date
FROM flat""",
    "emp_flat_count": _w(WORKFORCE) + "SELECT count(*) AS row_count FROM flat",
    "emp_flat_salaries": _w(WORKFORCE) + "SELECT * FROM keyed_salaries",
    "emp_flat_titles": _w(WORKFORCE) + "SELECT * FROM keyed_titles",
    "emp_dept_employees": _w(WORKFORCE)
    + f"""
SELECT {PERSON}
FROM dept_emp de JOIN flat f ON f.dept_emp = de.dept_no || '_' || CAST(de.emp_no AS VARCHAR)
WHERE de.dept_no = '{R.DEPT_NO}' AND f.emp_no IS NOT NULL""",
    "emp_dept_managers": _w(WORKFORCE)
    + f"""
SELECT {PERSON}
FROM dept_emp de JOIN flat f ON f.dept_emp = de.dept_no || '_' || CAST(de.emp_no AS VARCHAR)
WHERE de.dept_no = '{R.DEPT_NO}' AND f.dm_from_date IS NOT NULL""",
    "emp_payroll_on_date": _w(WORKFORCE)
    + f"""
SELECT CAST(coalesce(sum(coalesce(k.salary, 0)), 0) AS BIGINT) AS total_salary
FROM salaries s
LEFT JOIN keyed_salaries k ON k.row_key = CAST(s.emp_no AS VARCHAR) || '_' || CAST(s.from_date AS VARCHAR)
WHERE s.from_date < DATE '{R.PAYROLL_DATE}' AND s.to_date > DATE '{R.PAYROLL_DATE}'""",
    "emp_titles": _w(WORKFORCE)
    + f"""
SELECT k.title AS title
FROM (SELECT DISTINCT from_date FROM titles) d
JOIN keyed_titles k ON k.row_key = '{R.EMP_NO}_' || CAST(d.from_date AS VARCHAR)
WHERE k.title IS NOT NULL""",
    "emp_distinct_title_dates": _w(WORKFORCE) + "SELECT DISTINCT from_date FROM titles",
    "text_word_count": """
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word""",
}

# The look-up against a stored keyed table asks the same question.
ORACLE_SQL["kv_ips_of_guid_stored"] = ORACLE_SQL["kv_ips_of_guid"]
ORACLE_SQL["pv_top_domains_few"] = ORACLE_SQL["pv_top_domains"].replace("LIMIT 100", f"LIMIT {R.FEW_DOMAINS}")

# Later puts win over stored ones whatever their time; all puts carry all cells.
ORACLE_SQL["kv_upsert_pageview_merge"] = _w(PAGEVIEW, PUTS) + f"""
SELECT row_key, {CELLS} FROM puts
QUALIFY row_number() OVER (PARTITION BY row_key
  ORDER BY epoch_ms(timeCreate) >= TIMESTAMP '{R.MERGE_DAY}' DESC, timeCreate DESC, event_id DESC) = 1"""
ORACLE_SQL["kv_upsert_pageview_stored"] = _w(PAGEVIEW, PUTS) + f"""
SELECT row_key, {CELLS} FROM puts
QUALIFY row_number() OVER (PARTITION BY row_key
  ORDER BY minute(epoch_ms(timeCreate)) < {R.HALF_HOUR} DESC, timeCreate DESC, event_id DESC) = 1"""
ORACLE_SQL["kv_upsert_pageview_bucketed"] = ORACLE_SQL["kv_upsert_pageview_merge"]
_BAD = "(event_id % 50 = 0 OR event_id % 90 = 11)"
ORACLE_SQL["pv_ingest_counts"] = f"""
SELECT count(*) AS lines, count(*) FILTER ({_BAD}) AS rejected, count(*) FILTER (NOT {_BAD} AND event_id % 70 = 7) AS without_key
FROM events WHERE event_id % (SELECT count(*) FROM pages) IN (SELECT page_id FROM pages)"""
ORACLE_SQL["pv_ingest_rows"] = _w(PAGEVIEW) + f"""
SELECT guid, timeCreate, CASE WHEN event_id % 70 <> 7 THEN cookieCreate END AS cookieCreate, nullif(domain, '') AS domain,
       nullif(path, '') AS path, ip, category FROM pageview WHERE NOT {_BAD}"""
_REPORT = {
    "top_url_per_guid_day": ("pv_top_url_per_guid_day", ["guid", "timeCreate", "path"], "access_count"),
    "top_ips_by_guid": ("pv_top_ips_by_guid", ["ip"], "guid_count"),
    "top_domains": ("pv_top_domains", ["domain"], "count"),
    "top_locations_by_ip": ("pv_top_locs_by_ip", ["locId"], "unique_ip_count"),
    "top_browser_per_os": ("pv_top_browser_per_os", ["osCode", "browserCode"], "rank"),
}
ORACLE_SQL["pv_report"] = " UNION ALL ".join(
    f"SELECT '{name}' AS answer, "
    + ", ".join(f"CAST({k} AS VARCHAR) AS k{i}" for i, k in enumerate([*keys, "NULL", "NULL"][:3], 1))
    + f", CAST({n} AS BIGINT) AS n FROM ({ORACLE_SQL[sql]})"
    for name, (sql, keys, n) in _REPORT.items()
)
# Look-ups in the merged stores: some keys, and a range of keys.
ORACLE_SQL["kv_get_hours_stored"] = (
    f"SELECT * FROM ({ORACLE_SQL['kv_upsert_pageview_stored']}) WHERE row_key IN ({', '.join(str(_millis(t)) for t in R.HOURS)})"
)
ORACLE_SQL["emp_salaries_page"] = _w(WORKFORCE) + f"""
SELECT emp_no, salary, from_date, to_date FROM salaries
ORDER BY emp_no, from_date LIMIT {R.PAGE_SIZE} OFFSET {R.PAGE_NUMBER * R.PAGE_SIZE}"""
ORACLE_SQL["kv_urls_of_guid_day_stored"] = ORACLE_SQL["kv_urls_of_guid_day"]
# The same instants as zoned timestamps ask the same question.
ORACLE_SQL["kv_upsert_pageview_zoned"] = ORACLE_SQL["kv_upsert_pageview"]
ORACLE_SQL["kv_guids_os_browser_time_log_zoned"] = ORACLE_SQL["kv_guids_os_browser_time_log"]
ORACLE_SQL["emp_flat_dept_emp_reput"] = _w(WORKFORCE) + f"""
SELECT dept_emp AS row_key, CASE WHEN emp_no % 2 = 0 THEN DATE '{R.REPUT_DATE}' ELSE de_from_date END AS de_from_date,
       de_to_date, emp_no, birth_date, first_name, last_name, gender, hire_date, dept_no, dept_name, dm_from_date, dm_to_date
FROM flat"""
ORACLE_SQL["emp_flat_titles_collide"] = """
SELECT CAST(emp_no AS VARCHAR) || '_' || CAST(d AS VARCHAR) AS row_key, d AS from_date, DATE '9999-01-01' AS to_date, max(p) AS title, emp_no
FROM (SELECT o_custkey AS emp_no, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS d, o_orderpriority AS p FROM orders)
GROUP BY emp_no, d"""
_NEAREST = "SELECT l_quantity AS x, l_discount AS y, CASE " + " ".join(
    f"WHEN d{i} <= least(d0, d1, d2) THEN {i}" for i in range(3)
) + " END AS prediction FROM (SELECT *, " + ", ".join(
    f"(l_quantity - {a:f}::DOUBLE) * (l_quantity - {a:f}::DOUBLE) + (l_discount - {b:f}::DOUBLE) * (l_discount - {b:f}::DOUBLE) AS d{i}"
    for i, (a, b) in enumerate(R.GIVEN_CENTERS)
) + " FROM lineitem)"
ORACLE_SQL["kmeans_assign_given"] = _NEAREST


def _settled(start: list[tuple[float, float]], steps: int) -> str:
    """Lloyd's steps one after another; those after the centres have settled change nothing."""
    k = len(start)
    first = ", ".join(f"{a:f}::DOUBLE AS x{i}, {b:f}::DOUBLE AS y{i}" for i, (a, b) in enumerate(start))
    far = ", ".join(f"(x - x{i}) * (x - x{i}) + (y - y{i}) * (y - y{i}) AS d{i}" for i in range(k))
    least = f"least({', '.join(f'd{i}' for i in range(k))})"
    nearest = "CASE " + " ".join(f"WHEN d{i} <= {least} THEN {i}" for i in range(k)) + " END AS c"
    ctes = ["p AS (SELECT l_quantity AS x, l_discount AS y, count(*) AS n FROM lineitem GROUP BY ALL)", f"s0 AS (SELECT {first})"]
    for s in range(steps):
        ctes.append(f"a{s} AS (SELECT *, {nearest} FROM (SELECT *, {far} FROM p, s{s}))")
        ctes.append(f"m{s} AS (SELECT c, sum(n) AS n, round(sum(x * n) / sum(n), 6) AS x, round(sum(y * n) / sum(n), 6) AS y FROM a{s} GROUP BY c)")
        kept = ", ".join(f"coalesce((SELECT {v} FROM m{s} WHERE c = {i}), {v}{i}) AS {v}{i}" for i in range(k) for v in "xy")
        ctes.append(f"s{s + 1} AS MATERIALIZED (SELECT {kept} FROM s{s})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT c AS cluster, CAST(n AS BIGINT) AS n, x, y FROM m{steps - 1}"


ORACLE_SQL["kmeans_fit_from"] = _settled(R.FIT_FROM, 30)
ORACLE_SQL["kmeans_step"] = (
    f"SELECT prediction AS cluster, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM ({_NEAREST}) GROUP BY prediction"
)
