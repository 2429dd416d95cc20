"""The same results as plain SQL, written from the definitions: what was known as of a day, sums per group, lookups by day."""

from __future__ import annotations

PLACE = """42 + ({k} * 37 % 900) / 100.0 AS latitude, -4 + ({k} * 53 % 1200) / 100.0 AS longitude,
  lpad(CAST({k} * 137 % 95000 AS VARCHAR), 5, '0') AS postal_code"""

READINGS = f"""all_readings AS (
  SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS product, ts AS observed_at, CAST(ts AS DATE) AS day,
    value AS price, event_id AS reading_id, {PLACE.format(k='user_id')},
    CASE WHEN user_id % 10 = 0 THEN 'A' ELSE 'R' END AS road_type,
    'City ' || (user_id % 50) AS city, (event_id % 4) || ' High Street' AS address
  FROM events),
readings AS (SELECT * FROM all_readings WHERE price > 0.5 AND price < 350)"""

LONG_READINGS = f"""readings AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS entity, l_returnflag AS product, l_shipdate AS observed_at,
    CAST(l_shipdate AS DATE) AS day, l_extendedprice AS price, l_orderkey, l_linenumber, l_partkey,
    {PLACE.format(k='l_suppkey')}, CASE WHEN l_suppkey % 10 = 0 THEN 'A' ELSE 'R' END AS road_type,
    'City ' || (l_suppkey % 50) AS city, l_suppkey || ' High Street' AS address
  FROM lineitem)"""

TIE = "reading_id DESC"
LONG_TIE = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC"


def daily(tie: str = TIE) -> str:
    return f"""daily_full AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY entity, product, day ORDER BY observed_at DESC, {tie}) = 1),
daily AS (SELECT entity, product, day, price FROM daily_full),
entities AS (
  SELECT s.*, l.latitude, l.longitude, l.postal_code, l.road_type, l.city, l.address,
    substring(lpad(l.postal_code, 5, '0'), 1, 2) AS area
  FROM (SELECT entity, product, min(day) AS first_day, max(day) AS last_day FROM daily_full GROUP BY ALL) s
  JOIN (SELECT * FROM daily_full QUALIFY row_number() OVER (PARTITION BY entity, product ORDER BY day DESC) = 1) l
    USING (entity, product))"""


FIRST_DAY = "(SELECT min(CAST(ts AS DATE)) FROM events)"
LAST_DAY = "(SELECT max(CAST(ts AS DATE)) FROM events)"
LONG_FIRST = "(SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)"
LONG_LAST = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"


def as_day(day: str) -> str:
    """SQL of a day: an expression in brackets as it is, else a literal."""
    return day if day.startswith("(") else f"DATE '{day}'"


def days(name: str, first: str, stop: str) -> str:
    return f"{name} AS (SELECT CAST(unnest(range({as_day(first)}, {as_day(stop)}, INTERVAL 1 DAY)) AS DATE) AS day)"


def each_day(
    first: str = FIRST_DAY, stop: str = f"({LAST_DAY} + 1)", *, source: str = "daily", spans: str = "entities", last: str = "last_day"
) -> str:
    """Every key on every day of its span: the price known on that day and the one known the day before."""
    return f"""key_days AS (
  SELECT entity, product, area, first_day, CAST(unnest(range(greatest(first_day, {as_day(first)}),
    least({last} + 1, {as_day(stop)}), INTERVAL 1 DAY)) AS DATE) AS day FROM {spans}),
each_day AS (
  SELECT k.*, d.price, p.price AS prev_price, CAST(coalesce(d.price <> p.price, FALSE) AS INTEGER) AS changed
  FROM key_days k
  ASOF JOIN {source} d ON k.entity = d.entity AND k.product = d.product AND k.day >= d.day
  ASOF LEFT JOIN {source} p ON k.entity = p.entity AND k.product = p.product AND k.day > p.day)"""


EVENT_REF = """ref AS (SELECT CAST(ts AS DATE) AS day, max(value) AS ref FROM events
  WHERE event_type = 'purchase' AND isodow(CAST(ts AS DATE)) <= 5 GROUP BY 1),
holidays AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) IN (1, 15)),
observed AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)"""

LONG_REF = """ref AS (SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS ref FROM orders
  WHERE isodow(CAST(o_orderdate AS DATE)) <= 5 GROUP BY 1),
holidays AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '07-14')),
observed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"""


def calendar(first: str, stop: str, sources: str = EVENT_REF) -> str:
    """All calendar columns; ``first .. stop`` includes the margins."""
    return f"""{sources},
{days('cal_days', first, stop)},
quoted AS (SELECT c.day, r.ref AS ref_lag0 FROM cal_days c ASOF LEFT JOIN ref r ON c.day >= r.day),
quote_past AS (
  SELECT q.day, q.ref_lag0, a.ref_lag0 AS ref_lag1, b.ref_lag0 AS ref_lag3, c.ref_lag0 AS ref_lag7 FROM quoted q
  LEFT JOIN quoted a ON a.day = q.day - 1 LEFT JOIN quoted b ON b.day = q.day - 3 LEFT JOIN quoted c ON c.day = q.day - 7),
free_days AS (
  SELECT day, day IN (SELECT day FROM holidays) AS is_holiday,
    CASE WHEN day < {as_day(stop)} - 1 THEN day + 1 IN (SELECT day FROM holidays) END AS before_holiday,
    CASE WHEN day > {as_day(first)} THEN day - 1 IN (SELECT day FROM holidays) END AS after_holiday
  FROM cal_days),
school AS (
  SELECT day, day(day) BETWEEN 10 AND 20 AND day IN (SELECT day FROM observed) AS break_zone_a,
    day(day) BETWEEN 5 AND 12 AND day IN (SELECT day FROM observed) AS break_zone_b, FALSE AS break_zone_c
  FROM cal_days),
calendar AS (
  SELECT q.*, CAST(ref_lag0 - ref_lag1 AS FLOAT) AS ref_diff_1d, CAST(ref_lag0 - ref_lag7 AS FLOAT) AS ref_diff_7d,
    f.* EXCLUDE (day), s.* EXCLUDE (day)
  FROM quote_past q, free_days f, school s WHERE f.day = q.day AND s.day = q.day)"""


# A gap is the value minus a mean that is taken from a sum of whole cents.
# Unchanged days count from the last change, or from the second day if there was none.
FEATURES = """known AS (
  SELECT *, CAST(round(prev_price * 100) AS BIGINT) AS cents FROM each_day WHERE prev_price IS NOT NULL),
peer_totals AS (SELECT day, area, product, sum(cents) AS cents, count(*) AS n FROM known GROUP BY ALL),
week_totals AS (
  SELECT entity, product, day + CAST(range AS INTEGER) AS day, sum(cents) AS cents, count(*) AS n FROM known, range(7) GROUP BY ALL),
change_days AS (SELECT entity, product, day FROM each_day WHERE changed = 1),
features AS (
  SELECT k.* EXCLUDE (first_day, cents), CAST(k.day - coalesce(c.day, k.first_day + 1) AS SMALLINT) AS days_unchanged,
    CAST(prev_price - CAST(p.cents AS DOUBLE) / (p.n * CAST(100 AS DOUBLE)) AS FLOAT) AS peer_gap,
    CAST(prev_price - CAST(w.cents AS DOUBLE) / (w.n * CAST(100 AS DOUBLE)) AS FLOAT) AS rolling_gap
  FROM known k
  ASOF LEFT JOIN change_days c ON k.entity = c.entity AND k.product = c.product AND k.day >= c.day
  JOIN peer_totals p ON k.day = p.day AND k.area IS NOT DISTINCT FROM p.area AND k.product = p.product
  JOIN week_totals w ON k.entity = w.entity AND k.product = w.product AND k.day = w.day)"""

PANEL = """panel AS (
  SELECT f.entity, f.product, f.day, f.price, f.prev_price, e.latitude, e.longitude, e.postal_code, e.road_type, e.city,
    e.address, f.area, CAST(isodow(f.day) - 1 AS TINYINT) AS weekday, c.ref_lag0, c.ref_lag1, c.ref_lag3, c.ref_lag7,
    c.ref_diff_1d, c.ref_diff_7d, CAST(f.prev_price - c.ref_lag0 * CAST(0.01 AS DOUBLE) AS FLOAT) AS ref_spread,
    c.is_holiday, c.before_holiday, c.after_holiday, c.break_zone_a, c.break_zone_b, c.break_zone_c,
    f.days_unchanged, f.peer_gap, f.rolling_gap
  FROM features f JOIN entities e USING (entity, product) LEFT JOIN calendar c ON f.day = c.day)"""

EVENT_CALENDAR = calendar(f"({FIRST_DAY} - 12)", f"({LAST_DAY} + 2)")
BASE = f"{READINGS},\n{daily()}"
EACH_DAY = f"{BASE},\n{each_day()}"
EVENT_PANEL = f"{EACH_DAY},\n{EVENT_CALENDAR},\n{FEATURES},\n{PANEL}"

SCORED = f"""{EACH_DAY},
{FEATURES},
raw AS (SELECT *, round_even(CAST(rolling_gap AS DOUBLE) * CAST(-0.0005 AS DOUBLE) * 10000, 0) / CAST(10000 AS DOUBLE) AS raw_delta
  FROM features),
scored AS (SELECT *, CASE WHEN raw_delta < CAST(-0.0020 AS DOUBLE) OR raw_delta > CAST(0.0008 AS DOUBLE) THEN raw_delta
  ELSE CAST(0 AS DOUBLE) END AS delta FROM raw),
labelled AS (SELECT *,
  CASE WHEN price - prev_price > CAST(0.002 AS DOUBLE) THEN 'up' WHEN price - prev_price < CAST(-0.002 AS DOUBLE) THEN 'down'
    ELSE 'stable' END AS actual,
  CASE WHEN delta > CAST(0.0008 AS DOUBLE) THEN 'up' WHEN delta < CAST(-0.0020 AS DOUBLE) THEN 'down' ELSE 'stable' END AS predicted
  FROM scored),
micro AS (SELECT *, abs(price - prev_price) AS size,
  CAST(round_even(abs(price - prev_price) * 1000000, 0) AS BIGINT) AS naive,
  CAST(round_even(abs(price - (prev_price + delta)) * 1000000, 0) AS BIGINT) AS model FROM scored)"""

# State after the 24th: fourteen days and the last older row of each key; feed: latest reading up to the 25th.
ATTRS = "latitude, longitude, postal_code, road_type, city, address"
MERGED = f"""{BASE},
past AS (SELECT entity, product, day, price, {ATTRS},
    lead(day) OVER (PARTITION BY entity, product ORDER BY day) AS next_day
  FROM daily_full WHERE day <= DATE '2024-01-24'),
old_state AS (SELECT * EXCLUDE (next_day) FROM past
  WHERE day >= DATE '2024-01-10' OR next_day IS NULL OR next_day >= DATE '2024-01-10'),
feed AS (SELECT entity, product, day, price, {ATTRS} FROM readings WHERE day <= DATE '2024-01-25'
  QUALIFY row_number() OVER (PARTITION BY entity, product ORDER BY observed_at DESC, reading_id DESC) = 1),
merged AS (SELECT * FROM feed UNION ALL SELECT * FROM old_state o
  WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.entity = o.entity AND f.product = o.product AND f.day = o.day))"""

def _forecast_sql() -> str:
    spans = """known_entities AS (
  SELECT entity, product, min(day) AS first_day, substring(lpad(arg_max(postal_code, day), 5, '0'), 1, 2) AS area,
    unnest(arg_max(struct_pack(latitude, longitude, postal_code, road_type, city, address), day)) FROM merged GROUP BY entity, product)"""
    return f"""WITH {MERGED},
{spans},
{each_day("2023-12-31", "2024-01-26", source="merged", spans="known_entities", last="DATE '2024-01-25'")},
{FEATURES},
raw AS (SELECT *, round_even(CAST(rolling_gap AS DOUBLE) * CAST(-0.0005 AS DOUBLE) * 10000, 0) / CAST(10000 AS DOUBLE) AS raw_delta
  FROM features WHERE day = DATE '2024-01-25'),
kept AS (SELECT *, CASE WHEN raw_delta < CAST(-0.0020 AS DOUBLE) OR raw_delta > CAST(0.0008 AS DOUBLE) THEN raw_delta
  ELSE CAST(0 AS DOUBLE) END AS delta FROM raw)
SELECT k.entity, k.product, k.day, k.price, round_even((k.price + k.delta) * 1000, 0) / CAST(1000 AS DOUBLE) AS predicted_price,
  round_even(k.delta * 10000, 0) / CAST(10000 AS DOUBLE) AS predicted_delta,
  CASE WHEN k.delta > CAST(0.0008 AS DOUBLE) THEN 'up' WHEN k.delta < CAST(-0.0020 AS DOUBLE) THEN 'down' ELSE 'stable' END AS trend,
  e.latitude, e.longitude, e.postal_code, e.city, e.address, k.area
FROM kept k JOIN known_entities e USING (entity, product)"""


STATIONS = f"""stations AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entity, c_mktsegment AS product, c_acctbal AS price, {PLACE.format(k='c_custkey')},
    c_name AS address, 'City & Co ' || c_nationkey AS city FROM customer),
communes AS (
  SELECT s_name AS commune, lpad(CAST(s_suppkey * 137 % 9500 AS VARCHAR), 5, '0') AS code,
    42 + (s_suppkey * 37 % 900) / 100.0 AS latitude, -4 + (s_suppkey * 53 % 1200) / 100.0 AS longitude, s_suppkey
  FROM supplier)"""


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2)"
    chord = f"{half_lat} * {half_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {half_lon} * {half_lon}"
    return f"(CAST(12742000 AS DOUBLE) * asin(sqrt(least({chord}, CAST(1 AS DOUBLE)))))"


# Fixed value: the address of the map search.
LINK = "'https://www.google.com/maps/search/?api=1&query=' || url_encode(concat_ws(' ', address, {middle}city))"


def _report_sql() -> str:
    return f"""WITH {SCORED},
n AS (SELECT a.t AS label,
    (SELECT count(*) FROM labelled WHERE actual = a.t AND predicted = a.t) AS hit,
    (SELECT count(*) FROM labelled WHERE predicted = a.t) AS claimed,
    (SELECT count(*) FROM labelled WHERE actual = a.t) AS support
  FROM (VALUES ('down'), ('stable'), ('up')) a(t)),
rates AS (SELECT label, support, hit, CASE WHEN claimed = 0 THEN 0 ELSE hit / CAST(claimed AS DOUBLE) END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hit / CAST(support AS DOUBLE) END AS r FROM n),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM rates),
w AS (SELECT
    max(p) FILTER (label = 'down') AS p1, max(p) FILTER (label = 'stable') AS p2, max(p) FILTER (label = 'up') AS p3,
    max(r) FILTER (label = 'down') AS r1, max(r) FILTER (label = 'stable') AS r2, max(r) FILTER (label = 'up') AS r3,
    max(f1) FILTER (label = 'down') AS f1, max(f1) FILTER (label = 'stable') AS f2, max(f1) FILTER (label = 'up') AS f3,
    max(support) FILTER (label = 'down') AS s1, max(support) FILTER (label = 'stable') AS s2,
    max(support) FILTER (label = 'up') AS s3, CAST(sum(support) AS BIGINT) AS n, CAST(sum(hit) AS BIGINT) AS hits FROM f),
lines AS (SELECT label, p AS precision, r AS recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', hits / CAST(n AS DOUBLE), hits / CAST(n AS DOUBLE), hits / CAST(n AS DOUBLE), n FROM w
  UNION ALL SELECT 'macro avg', (p1 + p2 + p3) / 3, (r1 + r2 + r3) / 3, (f1 + f2 + f3) / 3, n FROM w
  UNION ALL SELECT 'weighted avg', (p1 * s1 + p2 * s2 + p3 * s3) / n, (r1 * s1 + r2 * s2 + r3 * s3) / n,
    (f1 * s1 + f2 * s2 + f3 * s3) / n, n FROM w)
SELECT label, round_even(precision * 10000, 0) / 10000 AS precision, round_even(recall * 10000, 0) / 10000 AS recall,
  round_even(f1 * 10000, 0) / 10000 AS f1, support FROM lines"""


LABELS = "(VALUES ('down'), ('stable'), ('up'))"

STATION_FILE = """SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS product,
  CASE WHEN event_id % 11 <> 0 THEN ts END AS observed_at, value AS price,
  CASE WHEN user_id % 13 <> 0 THEN CAST(4200000 + user_id * 37 % 900 * 1000 AS DOUBLE) / CAST(100000 AS DOUBLE) END AS latitude,
  CAST(-400000 + user_id * 53 % 1200 * 1000 AS DOUBLE) / CAST(100000 AS DOUBLE) AS longitude,
  lpad(CAST(user_id * 137 % 95000 AS VARCHAR), 5, '0') AS postal_code,
  CASE WHEN user_id % 10 = 0 THEN 'A' ELSE 'R' END AS road_type, 'City ' || (user_id % 50) AS city,
  (event_id % 4) || ' rue de l\u2019\u00c9t\u00e9 & Fils' AS address{more}
FROM events WHERE value IS NOT NULL AND event_id % 7 <> 0"""

ORACLES: dict[str, str] = {
    "ingest_checked": """WITH good AS (SELECT * FROM events WHERE event_id % 17 <> 0),
finds AS (SELECT 'record' AS kind FROM events WHERE event_id % 17 = 0
  UNION ALL SELECT 'entity' FROM good WHERE event_id % 23 = 0 UNION ALL SELECT 'price' FROM good WHERE event_id % 19 = 0
  UNION ALL SELECT 'time' FROM good WHERE event_id % 13 = 0
  UNION ALL SELECT CASE WHEN event_id % 13 = 0 THEN 'reading without a time' ELSE 'reading' END FROM good
    WHERE event_id % 23 <> 0 AND event_id % 19 <> 0 AND value IS NOT NULL)
SELECT kind, count(*) AS n_rows FROM finds GROUP BY kind""",
    "ingest_stations": STATION_FILE.format(more=", CASE WHEN user_id % 3 <> 0 THEN CAST(user_id % 7 AS VARCHAR) END AS lanes"),
    "ingest_feed": STATION_FILE.format(more="") + " AND event_id % 11 <> 0",
    "ingest_quotes": """SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice AS ref FROM orders
WHERE o_orderkey % 9 <> 0 AND o_orderkey % 5 <> 0 AND o_orderdate >= DATE '1996-01-01'""",
    "ingest_breaks": """SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey % 2 = 0 AS INTEGER) AS break_zone_a,
  CASE WHEN o_orderkey % 3 <> 0 THEN 0 END AS break_zone_b, CASE WHEN o_orderkey % 5 = 0 THEN 1 END AS break_zone_c
FROM orders WHERE o_orderdate >= DATE '1996-01-01'""",
    "ingest_holidays": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE day(o_orderdate) = 1",
    "ingest_communes": """SELECT s_name AS commune, lpad(CAST(s_suppkey * 137 % 9500 AS VARCHAR), 5, '0') AS code,
  CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal END AS latitude, CASE WHEN s_suppkey % 6 <> 0 THEN s_acctbal END AS longitude
FROM supplier""",
    "train_evaluate": f"""WITH {SCORED},
valid AS (SELECT * FROM labelled WHERE day >= {LAST_DAY} - 9),
sizes AS (SELECT t, (SELECT count(*) FROM valid WHERE actual = t) AS n FROM {LABELS} a(t)),
errors AS (SELECT count(*) AS n, CAST(sum(naive) AS DOUBLE) / (count(*) * CAST(1000000 AS DOUBLE)) AS naive FROM micro
  WHERE day >= {LAST_DAY} - 9)
SELECT 'support ' || t AS measure, CAST(n AS DOUBLE) AS value FROM sizes
UNION ALL SELECT 'cells ' || t, n FROM sizes
UNION ALL SELECT 'rows', n FROM errors UNION ALL SELECT 'naive error', naive FROM errors UNION ALL SELECT 'scores', n FROM errors
UNION ALL SELECT 'scores missing', 0 UNION ALL SELECT 'scores changed by a reload', 0""",
    "scan_glob": """SELECT event_type AS product, count(*) AS n_rows,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1""",
    "json_keys_explode": "SELECT event_id, unnest(json_keys(props)) AS name FROM events",
    "calendar_range": """WITH b AS (SELECT event_type AS product, CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi
  FROM events GROUP BY 1)
SELECT product, CAST(unnest(range(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b""",
    "sink_roundtrip": f"WITH {BASE} SELECT * FROM daily",
    "union_state": f"WITH {MERGED} SELECT * FROM merged",
    "rolling_state": f"""WITH {MERGED},
m AS (SELECT *, lead(day) OVER (PARTITION BY entity, product ORDER BY day) AS next_day FROM merged)
SELECT * EXCLUDE (next_day) FROM m WHERE day >= DATE '2024-01-11' OR next_day IS NULL OR next_day >= DATE '2024-01-11'""",
    "bucketed_state": f"""WITH {MERGED},
m AS (SELECT *, lead(day) OVER (PARTITION BY entity, product ORDER BY day) AS next_day FROM merged)
SELECT * EXCLUDE (next_day) FROM m WHERE day >= DATE '2024-01-11' OR next_day IS NULL OR next_day >= DATE '2024-01-11'""",
    "late_readings": f"""WITH {MERGED},
newest AS (SELECT entity, product, max(day) AS last_day FROM old_state GROUP BY ALL)
SELECT product, count(*) AS n_rows, CAST(sum(CAST(round_even(price * 100, 0) AS BIGINT)) AS BIGINT) AS cents
FROM readings JOIN newest USING (entity, product) WHERE day < last_day GROUP BY product""",
    "daily_forecast": _forecast_sql(),
    "publish_snapshot": _forecast_sql(),
    "publish_run": _forecast_sql(),
    "typed_casts": """SELECT event_id, CAST(ts AS DATE) AS day, CAST(value AS FLOAT) AS value_float,
  CAST(floor(value) AS INTEGER) AS value_int, CAST(user_id % 100 AS TINYINT) AS user_tiny,
  TRY_CAST(regexp_extract(props, '[0-9]+') AS SMALLINT) AS prop_small,
  TRY_CAST(substring(event_type, 1, 1) AS INTEGER) AS not_a_number, CAST(user_id AS VARCHAR) AS user_text FROM events""",
    "plausible_range": """SELECT event_id AS reading_id, CAST(user_id AS VARCHAR) AS entity, event_type AS product,
  value AS price FROM events WHERE value > 0.5 AND value < 350""",
    "split_by_date": f"""WITH {BASE} SELECT *, CASE WHEN day <= DATE '2024-01-20' THEN 'train' ELSE 'valid' END AS part
FROM daily WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' OR day >= DATE '2024-01-22'""",
    "null_audit": f"""WITH {EACH_DAY},
{EVENT_REF},
a AS (SELECT d.price, d.prev_price, day(o.day) BETWEEN 10 AND 20 AS break_zone_a, NULL AS break_zone_c
  FROM each_day d JOIN observed o ON d.day = o.day)
SELECT count(*) AS n_rows,
  count(*) FILTER (price IS NULL OR prev_price IS NULL OR break_zone_a IS NULL OR break_zone_c IS NULL) AS n_any_null,
  count(*) FILTER (price IS NULL) AS null_price, count(*) FILTER (prev_price IS NULL) AS null_prev_price,
  count(*) FILTER (break_zone_a IS NULL) AS null_break_zone_a, count(*) FILTER (break_zone_c IS NULL) AS null_break_zone_c
FROM a""",
    "latest_day": f"WITH {BASE} SELECT * FROM daily WHERE day = (SELECT max(day) FROM daily)",
    "param_lookup": f"""WITH {STATIONS} SELECT commune, latitude, longitude FROM communes WHERE code = '01096'
ORDER BY commune, latitude, longitude LIMIT 1""",
    "valid_code": """SELECT c_custkey, code, regexp_full_match(code, '[0-9]{5}') AS is_valid FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_custkey || 'x' ELSE CAST(c_custkey * 137 AS VARCHAR) END AS code
  FROM customer)""",
    "ref_ffill": f"WITH {calendar('2023-12-20', '2024-02-06')} SELECT day, ref_lag0 FROM quoted",
    "ref_backfill": f"""WITH {calendar('2023-12-20', '2024-02-06')}
SELECT day, coalesce(ref_lag0, (SELECT ref FROM ref ORDER BY day LIMIT 1)) AS ref_lag0 FROM quoted""",
    "ref_lags": f"WITH {calendar('2023-12-20', '2024-02-06')} SELECT * FROM quote_past",
    "ref_diffs": f"WITH {calendar('2023-12-20', '2024-02-06')} SELECT day, ref_diff_1d, ref_diff_7d FROM calendar",
    "holiday_flags": f"WITH {calendar('2024-01-01', '2024-01-31')} SELECT * FROM free_days",
    "flag_coalesce": f"WITH {calendar('2023-12-20', '2024-02-06')} SELECT * FROM school",
    "dedup_last_per_day": f"WITH {BASE} SELECT * FROM daily",
    "entity_span": f"WITH {BASE} SELECT * EXCLUDE (area) FROM entities",
    "panel_grid": f"WITH {EACH_DAY} SELECT entity, product, day FROM key_days",
    "panel_fill": f"WITH {EACH_DAY} SELECT entity, product, day, price FROM each_day",
    "asof_daily": f"""WITH {BASE},
{days('w', '2024-01-10', '2024-02-03')}
SELECT d.entity, d.product, w.day, arg_max(d.price, d.day) AS price FROM w JOIN daily d ON d.day <= w.day GROUP BY ALL""",
    "panel_enriched": f"""WITH {EACH_DAY},
{EVENT_CALENDAR}
SELECT f.entity, f.product, f.price, c.* REPLACE (f.day AS day) FROM each_day f LEFT JOIN calendar c ON f.day = c.day""",
    "prev_price": f"WITH {EACH_DAY} SELECT entity, product, day, price, prev_price FROM each_day",
    "change_flag": f"WITH {EACH_DAY} SELECT entity, product, day, price, prev_price, changed FROM each_day",
    "run_groups": f"""WITH {EACH_DAY}
SELECT e.entity, e.product, e.day, e.price, e.prev_price, e.changed, count(c.day) AS run_id
FROM each_day e LEFT JOIN each_day c ON c.entity = e.entity AND c.product = e.product AND c.changed = 1 AND c.day <= e.day
GROUP BY ALL""",
    "days_unchanged": f"WITH {EACH_DAY},\n{FEATURES} SELECT entity, product, day, price, prev_price, days_unchanged FROM features",
    "rolling_gap": f"WITH {EACH_DAY},\n{FEATURES} SELECT entity, product, day, price, prev_price, rolling_gap FROM features",
    "peer_gap": f"WITH {EACH_DAY},\n{FEATURES} SELECT entity, product, day, price, prev_price, area, peer_gap FROM features",
    "feature_panel": f"WITH {EVENT_PANEL} SELECT * FROM panel",
    "long_history": f"""WITH {LONG_READINGS},
{daily(LONG_TIE)},
{each_day(LONG_FIRST, f"({LONG_LAST} + 1)")},
{calendar(f"({LONG_FIRST} - 12)", f"({LONG_LAST} + 2)", LONG_REF)},
{FEATURES},
{PANEL}
SELECT product, CAST(year(day) AS INTEGER) AS year, count(*) AS n_rows, CAST(sum(days_unchanged) AS BIGINT) AS days_unchanged,
  count(*) FILTER (before_holiday) AS before_holiday,
  {', '.join(f'CAST(sum(CAST(round_even(CAST({c} AS DOUBLE) * 100, 0) AS BIGINT)) AS BIGINT) AS {c}'
             for c in ('price', 'prev_price', 'rolling_gap', 'peer_gap', 'ref_diff_7d'))}
FROM panel GROUP BY 1, 2""",
    "area_code": "SELECT c_custkey, substring(lpad(CAST(c_custkey * 137 AS VARCHAR), 5, '0'), 1, 2) AS area FROM customer",
    "weekday_index": "SELECT o_orderkey, CAST(isodow(CAST(o_orderdate AS DATE)) - 1 AS TINYINT) AS weekday FROM orders",
    "ref_spread": f"""WITH {EACH_DAY},
{calendar('2023-12-20', '2024-02-06')}
SELECT d.entity, d.product, d.day, CAST(d.prev_price - r.ref_lag0 * CAST(0.01 AS DOUBLE) AS FLOAT) AS ref_spread
FROM each_day d LEFT JOIN quoted r ON d.day = r.day""",
    "map_link": f"WITH {STATIONS} SELECT entity, {LINK.format(middle='NULL, ')} AS map_link FROM stations",
    "target_weight": f"""WITH {EACH_DAY}
SELECT entity, product, day, CAST(price - prev_price AS FLOAT) AS target,
  CASE WHEN CAST(price - prev_price AS FLOAT) > CAST(0.002 AS FLOAT) THEN CAST(1.4 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight
FROM each_day WHERE prev_price IS NOT NULL""",
    "dead_band": f"WITH {SCORED} SELECT entity, product, day, raw_delta, delta FROM scored",
    "trend_label": f"WITH {SCORED} SELECT entity, product, day, predicted, actual FROM labelled",
    "predicted_price": f"""WITH {SCORED} SELECT entity, product, day,
  round_even((price + delta) * 1000, 0) / CAST(1000 AS DOUBLE) AS predicted_price,
  round_even(delta * 10000, 0) / CAST(10000 AS DOUBLE) AS predicted_delta FROM scored""",
    "naive_mae": f"""WITH {SCORED},
m AS (SELECT CAST(sum(naive) AS DOUBLE) / (count(*) * CAST(1000000 AS DOUBLE)) AS mae FROM micro)
SELECT mae, mae * 100 AS mae_hundredths FROM m""",
    "model_mae": f"""WITH {SCORED}
SELECT count(*) AS n_rows, CAST(sum(naive) AS DOUBLE) / (count(*) * CAST(1000000 AS DOUBLE)) AS naive_mae,
  CAST(sum(model) AS DOUBLE) / (count(*) * CAST(1000000 AS DOUBLE)) AS model_mae FROM micro""",
    "segment_report": f"""WITH {SCORED},
s AS (SELECT b.bound, count(*) AS n, CAST(sum(naive) AS DOUBLE) AS naive, CAST(sum(model) AS DOUBLE) AS model,
    count(*) FILTER (delta != 0) AS detected,
    count(*) FILTER (delta != 0 AND sign(delta) = sign(price - prev_price)) AS hits
  FROM micro, (VALUES (CAST(5 AS DOUBLE)), (CAST(50 AS DOUBLE)), (CAST(150 AS DOUBLE))) b(bound)
  WHERE size >= b.bound GROUP BY 1)
SELECT bound, n AS n_rows, n * CAST(100 AS DOUBLE) / (SELECT count(*) FROM micro) AS share_pct,
  naive / (n * CAST(1000000 AS DOUBLE)) AS naive_mae, model / (n * CAST(1000000 AS DOUBLE)) AS model_mae,
  (naive - model) * 100 / naive AS gain_pct, detected * CAST(100 AS DOUBLE) / n AS detected_pct,
  CASE WHEN detected = 0 THEN 0 ELSE hits * CAST(100 AS DOUBLE) / detected END AS direction_pct FROM s""",
    "confusion_matrix": f"""WITH {SCORED}
SELECT a.t AS actual, p.t AS predicted, count(l.entity) AS n_rows FROM {LABELS} a(t) CROSS JOIN {LABELS} p(t)
LEFT JOIN labelled l ON l.actual = a.t AND l.predicted = p.t GROUP BY 1, 2""",
    "confusion_matrix_pct": f"""WITH {SCORED},
c AS (SELECT a.t AS actual, p.t AS predicted, count(l.entity) AS n FROM {LABELS} a(t) CROSS JOIN {LABELS} p(t)
  LEFT JOIN labelled l ON l.actual = a.t AND l.predicted = p.t GROUP BY 1, 2)
SELECT actual, predicted, n * CAST(100 AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY actual), 0) AS pct FROM c""",
    "classification_report": _report_sql(),
    "radius_search": f"""WITH {STATIONS},
centre AS (SELECT * FROM communes WHERE code = '01096' ORDER BY commune, latitude, longitude LIMIT 1),
near AS (SELECT s.*, {distance('s.latitude', 's.longitude', 'c.latitude', 'c.longitude')} AS d FROM stations s, centre c
  WHERE s.product = 'BUILDING')
SELECT {LINK.format(middle='')} AS map_link, entity, price,
  round_even((price + price * CAST(0.01 AS DOUBLE)) * 1000, 0) / CAST(1000 AS DOUBLE) AS predicted_price,
  CASE WHEN price > CAST(0.0008 AS DOUBLE) THEN 'up' WHEN price < CAST(-0.002 AS DOUBLE) THEN 'down' ELSE 'stable' END AS trend,
  round_even(price * CAST(0.01 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS predicted_delta, postal_code, city, address,
  CAST(round(d) AS BIGINT) AS distance_m FROM near WHERE d <= 200000 ORDER BY price, entity""",
    "radius_topk": f"""WITH {STATIONS},
near AS (SELECT *, {distance('latitude', 'longitude', 'CAST(46 AS DOUBLE)', 'CAST(2 AS DOUBLE)')} AS d FROM stations)
SELECT entity, product, CAST(round(d) AS BIGINT) AS distance_m FROM near WHERE d <= 100000 ORDER BY d, entity, product LIMIT 25""",
    "radius_join": f"""WITH {STATIONS},
pairs AS (SELECT c.s_suppkey AS code, s.entity, s.product,
    {distance('c.latitude', 'c.longitude', 's.latitude', 's.longitude')} AS d FROM communes c, stations s)
SELECT code, entity, product, CAST(round(d) AS BIGINT) AS distance_m FROM pairs WHERE d <= 50000""",
    "nearest_join": f"""WITH {STATIONS},
pairs AS (SELECT c.s_suppkey AS code, s.entity, s.product,
    {distance('c.latitude', 'c.longitude', 's.latitude', 's.longitude')} AS d FROM communes c, stations s),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY code ORDER BY CAST(round(d * 1000) AS BIGINT), entity, product) AS INTEGER) AS rank
    FROM pairs WHERE d <= 50000)
SELECT code, rank, entity, product, CAST(round(d) AS BIGINT) AS distance_m FROM ranked WHERE rank <= 5""",
}
ORACLES["merged_segments"] = ORACLES["segment_report"]
