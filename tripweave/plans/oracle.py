"""Plain SQL for the registered queries, written independently of the DataFrame code.

Each statement runs on the driver's tables as views. Doubles are rounded to six
places on both sides.
"""

from __future__ import annotations

import re

_BASE = """
gps AS (
  SELECT event_id AS seq, user_id AS vehicle_id,
    CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 30) AS BIGINT) AS sec_of_day,
    CASE WHEN event_id % 97 = 0 THEN 112.5e0
         WHEN event_id % 4 = 0 THEN 114.0e0 + ((event_id // 4) % 6) * 0.03e0 + ((event_id * 7919) % 60) / 20000.0e0
         ELSE 113.95e0 + ((event_id * 7919) % 2000) / 10000.0e0 END AS lng,
    CASE WHEN event_id % 4 = 0 THEN 22.52e0 + ((event_id // 4) % 6) * 0.01e0 + ((event_id * 104729) % 60) / 20000.0e0
         ELSE 22.5e0 + ((event_id * 104729) % 1000) / 10000.0e0 END AS lat,
    CASE WHEN event_type IN ('click', 'purchase') THEN 0 {foreign} ELSE 1 END AS open_status,
    value AS speed
  FROM events),
boxed AS (
  SELECT *, CASE WHEN speed BETWEEN 0 AND 150 THEN speed END AS ok_speed FROM gps
  WHERE lng BETWEEN 113.5e0 AND 114.5e0 AND lat BETWEEN 22.4e0 AND 22.9e0),
fed AS (SELECT * FROM boxed QUALIFY count(ok_speed) OVER (PARTITION BY vehicle_id) > 0),
seen AS (
  SELECT *, lag(open_status) OVER (PARTITION BY vehicle_id ORDER BY sec_of_day, seq) AS prev_status FROM fed),
chg AS (
  SELECT *, CASE WHEN prev_status = 1 AND open_status = 0 THEN 1 ELSE -1 END AS change FROM seen
  WHERE (prev_status = 1 AND open_status = 0) OR (prev_status = 0 AND open_status = 1)),
"""

_STRICT = """
started AS (
  SELECT *, lead(sec_of_day) OVER w AS e_sec, lead(lng) OVER w AS e_lng, lead(lat) OVER w AS e_lat FROM chg
  WINDOW w AS (PARTITION BY vehicle_id ORDER BY sec_of_day, seq)),
raw AS (
  SELECT seq AS trip_id, vehicle_id, sec_of_day AS s_sec, lng AS s_lng, lat AS s_lat, e_sec, e_lng, e_lat
  FROM started WHERE change = 1 AND e_sec IS NOT NULL),
"""

_MEASURED = """
m0 AS (
  SELECT *, e_sec - s_sec + CASE WHEN e_sec < s_sec THEN 86400 ELSE 0 END AS duration_s,
    power(sin((radians(e_lat) - radians(s_lat)) / 2), 2)
      + cos(radians(s_lat)) * cos(radians(e_lat)) * power(sin((radians(e_lng) - radians(s_lng)) / 2), 2) AS h
  FROM {trips}),
measured AS (
  SELECT trip_id, vehicle_id, s_sec, s_lng, s_lat, e_sec, e_lng, e_lat, duration_s,
    duration_s / 60.0e0 AS duration_min, 2 * 6371.0e0 * atan2(sqrt(h), sqrt(1 - h)) AS distance_km,
    CASE WHEN duration_s > 0 THEN 2 * 6371.0e0 * atan2(sqrt(h), sqrt(1 - h)) / (duration_s / 3600.0e0) ELSE 0 END AS avg_speed,
    CAST(s_sec // 3600 AS INTEGER) AS hour
  FROM m0),
valid AS (
  SELECT * FROM measured WHERE duration_min BETWEEN 1 AND 240 AND distance_km >= 0.2e0 AND avg_speed BETWEEN 5 AND 100)
"""


def _cell(axis: str, point: str) -> str:
    low, step, top = ("113.5e0", "0.01e0", 100) if axis == "lng" else ("22.4e0", "0.009e0", 55)
    return f"least({top}, greatest(0, CAST(trunc(({point} - {low}) / {step}) AS INTEGER)))"


_GRID = f"""
, cells AS (
  SELECT *, {_cell('lng', 's_lng')} AS si, {_cell('lat', 's_lat')} AS sj,
    {_cell('lng', 'e_lng')} AS ei, {_cell('lat', 'e_lat')} AS ej FROM valid),
pairs AS (
  SELECT CAST(si * 56 + sj AS BIGINT) AS o, CAST(ei * 56 + ej AS BIGINT) AS d, count(*) AS flow FROM cells GROUP BY ALL),
top30 AS (SELECT * FROM pairs WHERE o <> d ORDER BY flow DESC, o, d LIMIT 30),
signed AS (
  SELECT least(o, d) AS lo, greatest(o, d) AS hi, CAST(sum(CASE WHEN o < d THEN flow ELSE -flow END) AS BIGINT) AS net
  FROM top30 GROUP BY ALL),
edges AS (
  SELECT CASE WHEN net > 0 THEN lo ELSE hi END AS o, CASE WHEN net > 0 THEN hi ELSE lo END AS d, abs(net) AS flow
  FROM signed WHERE net <> 0),
flows AS (
  SELECT grid_id, CAST(sum(outf) AS BIGINT) AS outflow, CAST(sum(inf) AS BIGINT) AS inflow,
    CAST(sum(inf) - sum(outf) AS BIGINT) AS net_flow
  FROM (SELECT CAST(si * 56 + sj AS BIGINT) AS grid_id, 1 AS outf, 0 AS inf FROM cells
        UNION ALL SELECT CAST(ei * 56 + ej AS BIGINT), 0, 1 FROM cells) GROUP BY grid_id)
"""


def lng_of(cell: str) -> str:
    return f"round(113.5e0 + (({cell}) // 56 + 0.5e0) * 0.01e0, 6)"


def lat_of(cell: str) -> str:
    return f"round(22.4e0 + (({cell}) % 56 + 0.5e0) * 0.009e0, 6)"


def _name(cell: str) -> str:
    return (
        f"'(' || CAST(round(113.5e0 + (({cell}) // 56 + 0.5e0) * 0.01e0, 5) AS VARCHAR) || ',' || "
        f"CAST(round(22.4e0 + (({cell}) % 56 + 0.5e0) * 0.009e0, 5) AS VARCHAR) || ')'"
    )


def _pings(body: str) -> str:
    return "WITH " + _BASE.format(foreign="").rstrip().rstrip(",") + "\n" + body


def _trips(body: str) -> str:
    return "WITH " + _BASE.format(foreign="") + _STRICT + _MEASURED.format(trips="raw") + body


def _spatial(body: str) -> str:
    return _trips(_GRID + body)


_TRIP_COLUMNS = """trip_id, vehicle_id, s_sec, round(s_lng, 6) AS s_lng, round(s_lat, 6) AS s_lat, e_sec,
  round(e_lng, 6) AS e_lng, round(e_lat, 6) AS e_lat"""
_MEASURES = """duration_s, round(duration_min, 6) AS duration_min, round(distance_km, 6) AS distance_km,
  round(avg_speed, 6) AS avg_speed, hour"""

_FIFO = """
sums AS (
  SELECT *, sum(CASE WHEN change = 1 THEN 1 ELSE 0 END) OVER w AS s, sum(CASE WHEN change = -1 THEN 1 ELSE 0 END) OVER w AS e
  FROM chg WINDOW w AS (PARTITION BY vehicle_id ORDER BY sec_of_day, seq ROWS UNBOUNDED PRECEDING)),
lows AS (
  SELECT *, least(0, coalesce(min(s - e) OVER (PARTITION BY vehicle_id ORDER BY sec_of_day, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM sums),
used AS (SELECT * FROM lows WHERE change = -1 AND s - e >= low),
ends AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY sec_of_day, seq) AS n FROM used),
starts AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY sec_of_day, seq) AS n FROM chg WHERE change = 1),
raw AS (
  SELECT a.seq AS trip_id, a.vehicle_id, a.sec_of_day AS s_sec, a.lng AS s_lng, a.lat AS s_lat,
    b.sec_of_day AS e_sec, b.lng AS e_lng, b.lat AS e_lat
  FROM starts a JOIN ends b ON a.vehicle_id = b.vehicle_id AND a.n = b.n)
"""

# fixed values: periods of the day; the bins further down hold the histogram labels
_PERIOD_VALUES = """periods(period_no, period_name, time_range, a, b) AS (VALUES
  (0, '早高峰', '07:00-09:00', 25200, 32400), (1, '日间平峰', '09:00-17:00', 32400, 61200),
  (2, '晚高峰', '17:00-19:00', 61200, 68400), (3, '夜间', '19:00-23:59', 68400, 86340))"""
_HOURS = "hours AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))"


def _hist(column: str, edges: list[float | None], labels: list[str]) -> str:
    rows = ", ".join(
        f"({i}, '{label}', {float(lo)}e0, {'1e308' if hi is None else str(float(hi)) + 'e0'})"
        for i, (label, lo, hi) in enumerate(zip(labels, edges, edges[1:]))
    )
    return _trips(f""", bins(bin_no, label, lo, hi) AS (VALUES {rows}),
counted AS (
  SELECT CAST(b.bin_no AS INTEGER) AS bin_no, b.label, count(v.trip_id) AS n
  FROM bins b LEFT JOIN valid v ON v.{column} > b.lo AND v.{column} <= b.hi GROUP BY ALL)
SELECT bin_no, label, n, round(n * 100.0e0 / sum(n) OVER (), 6) AS share_pct,
  CAST(row_number() OVER (ORDER BY n DESC, bin_no) AS INTEGER) AS rank_no FROM counted""")


def _density(points: str) -> str:
    return _spatial(f"""
SELECT i_lng, i_lat, count(*) AS n, round(113.5e0 + (i_lng + 0.5e0) * 0.01e0, 6) AS lng,
  round(22.4e0 + (i_lat + 0.5e0) * 0.009e0, 6) AS lat FROM ({points}) GROUP BY i_lng, i_lat""")


_EFFICIENCY = """
SELECT vehicle_id, count(*) AS trip_count, round((sum(duration_s)::DOUBLE / 60.0e0), 6) AS total_duration,
  round(sum(distance_km), 6) AS total_distance, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance,
  printf('%02d:%02d:%02d', min(s_sec) // 3600, min(s_sec) % 3600 // 60, min(s_sec) % 60) AS first_trip,
  printf('%02d:%02d:%02d', max(e_sec) // 3600, max(e_sec) % 3600 // 60, max(e_sec) % 60) AS last_trip
FROM valid GROUP BY vehicle_id"""


_CLUSTER_TABLES = "pts|near|core|links|walk|core_root|numbered|labelled|centers|summary"


def _cluster_tables(side: str, suffix: str = "") -> str:
    tables = f""",
pts AS (SELECT trip_id AS id, {side}_lng AS lng, {side}_lat AS lat, {side}_lng * 103000.0e0 AS x, {side}_lat * 111000.0e0 AS y FROM valid),
near AS (
  SELECT p.id AS a, q.id AS b FROM pts p JOIN pts q
  ON q.x BETWEEN p.x - 516 AND p.x + 516
  AND sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= 0.005e0 * 103000.0e0),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 20),
links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
walk(root, id) AS (
  SELECT id, id FROM core
  UNION SELECT w.root, l.b FROM walk w JOIN links l ON l.a = w.id WHERE w.root < l.b),
core_root AS (SELECT id, min(root) AS root FROM walk GROUP BY id),
numbered AS (SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster_id FROM core_root),
labelled AS (
  SELECT p.id, coalesce(n.cluster_id, (
    SELECT min(m.cluster_id) FROM near r JOIN numbered m ON m.id = r.b WHERE r.a = p.id), -1) AS cluster_id, p.lng, p.lat
  FROM pts p LEFT JOIN numbered n ON n.id = p.id),
centers AS (
  SELECT cluster_id, avg(lng) AS c_lng, avg(lat) AS c_lat, count(*) AS trip_count FROM labelled WHERE cluster_id >= 0 GROUP BY cluster_id),
summary AS (
  SELECT c.cluster_id, c.c_lng AS center_lng, c.c_lat AS center_lat, c.trip_count,
    max(sqrt((l.lng - c.c_lng) * (l.lng - c.c_lng) + (l.lat - c.c_lat) * (l.lat - c.c_lat))) * 103000.0e0 AS radius_m,
    max(2 * 6371.0e0 * asin(sqrt(power(sin(radians(l.lat - c.c_lat) / 2), 2)
      + cos(radians(l.lat)) * cos(radians(c.c_lat)) * power(sin(radians(l.lng - c.c_lng) / 2), 2)))) * 1000 AS radius_true_m
  FROM centers c JOIN labelled l USING (cluster_id) GROUP BY ALL)
"""
    return re.sub(rf"\b({_CLUSTER_TABLES})\b", rf"\1{suffix}", tables)


def _clusters(side: str, tail: str) -> str:
    return "WITH RECURSIVE " + _BASE.format(foreign="") + _STRICT + _MEASURED.format(trips="raw") + _cluster_tables(side) + tail


def _both_clusters(tail: str) -> str:
    """Tables of the start clusters, and of the end clusters with _e behind their names."""
    return _clusters("s", _cluster_tables("e", "_e") + tail)


def _label(lng: str, lat: str) -> str:
    """Three decimals, halves of the shortest decimal form rounded up."""
    part = lambda x: f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(24, 18)), 3) AS DECIMAL(12, 3))"
    return f"'(' || {part(lng)} || ',' || {part(lat)} || ')'"


def _hotspots(kind: str) -> str:
    return _clusters(kind[0], f"""
SELECT '{kind}' AS point_type, cluster_id, round(center_lng, 6) AS center_lng, round(center_lat, 6) AS center_lat,
  trip_count, round(radius_m, 4) AS radius_m, round(radius_true_m, 4) AS radius_true_m
FROM summary ORDER BY trip_count DESC, cluster_id LIMIT 20""")


_SPEED_ROWS = """ranked AS (
  SELECT seq, vehicle_id, sec_of_day, ok_speed, row_number() OVER (PARTITION BY vehicle_id ORDER BY sec_of_day, seq) AS rn FROM boxed),
filled AS (
  SELECT *,
    last_value(ok_speed IGNORE NULLS) OVER up AS pv, last_value(CASE WHEN ok_speed IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS pr,
    first_value(ok_speed IGNORE NULLS) OVER dn AS nv, first_value(CASE WHEN ok_speed IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS nr
  FROM ranked WINDOW
    up AS (PARTITION BY vehicle_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    dn AS (PARTITION BY vehicle_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

_REASON = """CASE WHEN duration_min < 1 THEN 'too_short' WHEN duration_min > 240 THEN 'too_long'
  WHEN distance_km < 0.2e0 THEN 'too_near' WHEN avg_speed < 5 THEN 'too_slow' WHEN avg_speed > 100 THEN 'too_fast' END"""


def _funnel() -> str:
    return _trips(""",
c AS (SELECT (SELECT count(*) FROM gps) AS pings, (SELECT count(*) FROM boxed) AS boxed, (SELECT count(*) FROM fed) AS fed,
  (SELECT count(*) FROM raw) AS trips, (SELECT count(*) FROM valid) AS valid),
s AS (
  SELECT 1 AS step_no, 'box' AS step, pings AS rows_before, boxed AS rows_after FROM c
  UNION ALL SELECT 2, 'speed', boxed, fed FROM c UNION ALL SELECT 3, 'trips', fed, trips FROM c
  UNION ALL SELECT 4, 'filter', trips, valid FROM c)
SELECT step_no, step, rows_before, rows_after, rows_before - rows_after AS removed,
  CASE WHEN rows_before > 0 THEN round((rows_before - rows_after) * 100.0e0 / rows_before, 6) END AS removal_pct FROM s""")


def _profile() -> str:
    def row(metric: str, value: str, pct: bool = False) -> str:
        share = f"round({value} * 100.0e0 / count(*), 6)" if pct else "CAST(NULL AS DOUBLE)"
        return f"SELECT '{metric}' AS metric, round(CAST({value} AS DOUBLE), 6) AS value, {share} AS pct FROM gps"

    inside = "lng BETWEEN 113.5e0 AND 114.5e0 AND lat BETWEEN 22.4e0 AND 22.9e0"
    return _pings("\nUNION ALL ".join([
        row("rows", "count(*)"), row("vehicles", "count(DISTINCT vehicle_id)"),
        row("first_sec", "min(sec_of_day)"), row("last_sec", "max(sec_of_day)"),
        row("speed_mean", "avg(speed)"), row("speed_median", "median(speed)"),
        row("speed_std", "stddev_samp(speed)"), row("speed_max", "max(speed)"),
        row("out_of_box", f"count(*) FILTER (NOT ({inside}))", True),
        row("occupied", "count(*) FILTER (open_status = 0)", True),
        row("vacant", "count(*) FILTER (open_status = 1)", True),
        row("other_status", "count(*) FILTER (open_status NOT IN (0, 1))", True),
    ]))


def _nulls() -> str:
    return _pings("\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0e0 / count(*), 6) AS pct FROM gps"
        for c in ("vehicle_id", "sec_of_day", "lng", "lat", "open_status", "speed")
    ))


_CACHE_SCALARS = f"""
, {_HOURS}, {_PERIOD_VALUES},
scalars AS (
  SELECT 'hourly_trips' AS stat_type, printf('%02d:00', h.hour) AS stat_key, CAST(count(v.trip_id) AS DOUBLE) AS stat_value
  FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour
  UNION ALL
  SELECT 'period_trips', p.period_name, CAST(count(v.trip_id) AS DOUBLE)
  FROM periods p LEFT JOIN valid v ON v.s_sec >= p.a AND v.s_sec < p.b GROUP BY p.period_name)
"""


_PEAK_LISTS = ", ".join(
    f"(SELECT coalesce(string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) FILTER (n > mean * 1.5e0 AND hour BETWEEN {a} AND {b}), '')"
    f" FROM (SELECT *, avg(n) OVER () AS mean FROM c)) AS {name}"
    for name, a, b in (("morning_peak", 6, 10), ("evening_peak", 16, 20))
)

_BOARD_FACTS = _clusters("s", _GRID + _CACHE_SCALARS + """
SELECT 'kpis' AS section, 'all' AS label, CAST(count(*) AS DOUBLE) AS a, CAST(count(DISTINCT vehicle_id) AS DOUBLE) AS b,
  round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS c, round(avg(distance_km), 6) AS d, round(avg(avg_speed), 6) AS e FROM valid
UNION ALL SELECT * FROM (
  SELECT 'heatmap', '', round(22.4e0 + (sj + 0.5e0) * 0.009e0, 6), round(113.5e0 + (si + 0.5e0) * 0.01e0, 6), count(*)::DOUBLE, NULL, NULL
  FROM cells GROUP BY si, sj ORDER BY count(*) DESC, si, sj LIMIT 500)
UNION ALL SELECT * FROM (
  SELECT 'ranking', '#' || cluster_id, row_number() OVER (ORDER BY trip_count DESC, cluster_id)::DOUBLE AS rank, round(center_lng, 6),
    round(center_lat, 6), trip_count::DOUBLE, NULL FROM summary ORDER BY rank LIMIT 15)
UNION ALL SELECT 'trend', printf('%02d:00', h.hour), count(v.trip_id)::DOUBLE, round(coalesce(avg(avg_speed), 0), 6),
  round(coalesce(avg(distance_km), 0), 6), NULL, NULL FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour
UNION ALL SELECT CASE stat_type WHEN 'hourly_trips' THEN 'hourly' ELSE 'periods' END, stat_key, stat_value, NULL, NULL, NULL, NULL FROM scalars""")


def _over_midnight() -> str:
    """One run over two days, in seconds from the start of the first."""
    base = _BASE.format(foreign="").split("fed AS")[0]
    measured = _MEASURED.format(trips="raw").replace("e_sec - s_sec + CASE WHEN e_sec < s_sec THEN 86400 ELSE 0 END AS", "e_sec - s_sec AS")
    return "WITH " + base + """
fed AS (SELECT *, seq % 2 * 86400 + sec_of_day AS t_sec FROM boxed QUALIFY count(ok_speed) OVER (PARTITION BY vehicle_id, seq % 2) > 0),
seen AS (SELECT *, lag(open_status) OVER (PARTITION BY vehicle_id ORDER BY t_sec, seq) AS prev_status FROM fed),
chg AS (
  SELECT *, CASE WHEN prev_status = 1 AND open_status = 0 THEN 1 ELSE -1 END AS change FROM seen
  WHERE (prev_status = 1 AND open_status = 0) OR (prev_status = 0 AND open_status = 1)),
started AS (
  SELECT *, lead(t_sec) OVER w AS e_at, lead(lng) OVER w AS e_lng, lead(lat) OVER w AS e_lat FROM chg WINDOW w AS (PARTITION BY vehicle_id ORDER BY t_sec, seq)),
raw AS (
  SELECT seq AS trip_id, vehicle_id, t_sec AS s_sec, lng AS s_lng, lat AS s_lat, e_at AS e_sec, e_lng, e_lat FROM started WHERE change = 1 AND e_at IS NOT NULL),
""" + measured + f"""
SELECT trip_id, vehicle_id, CASE WHEN s_sec < 86400 THEN '2024-01-01' ELSE '2024-01-02' END AS day, s_sec % 86400 AS s_sec,
  round(s_lng, 6) AS s_lng, round(s_lat, 6) AS s_lat, e_sec % 86400 AS e_sec, round(e_lng, 6) AS e_lng, round(e_lat, 6) AS e_lat,
  duration_s, round(duration_min, 6) AS duration_min, round(distance_km, 6) AS distance_km, round(avg_speed, 6) AS avg_speed,
  CAST(s_sec % 86400 // 3600 AS INTEGER) AS hour FROM valid
UNION ALL BY NAME SELECT seq AS trip_id, vehicle_id, 'open' AS day FROM started WHERE change = 1 AND e_at IS NULL"""


def _facts(section: str, statement: str, label: str, *values: str) -> str:
    """The rows of a statement as section, label and up to five numbers."""
    numbers = ", ".join(f"CAST({v} AS DOUBLE) AS {c}" for v, c in zip([*values, *["NULL"] * (5 - len(values))], "abcde"))
    return f"SELECT '{section}' AS section, {label} AS label, {numbers} FROM ({statement})"


def _board_set(s: dict[str, str]) -> str:
    return "\nUNION ALL ".join([
        _facts("kpis", s["kpis"], "'all'", "total_trips", "total_vehicles", "avg_duration", "peak_hour", "peak_trips"),
        _facts("hourly", s["hourly_board"], "label", "trip_count"),
        *[_facts(n, s[f"{n}_hist"], "label", "n", "share_pct") for n in ("duration", "distance", "speed")],
        _facts("period", s["period_shares"], "period_name", "ratio_pct"), _facts("hotspots", s["hotspot_bars"], "label", "cluster_id", "trip_count"),
        _facts("distance_summary", s["distance_summary"], "''", "mean", "median", "short_ratio", "long_ratio"),
        _facts("speed_summary", s["speed_summary"], "''", "mean", "median", "total", "mean_bin"),
        _facts("vehicles", s["vehicle_bars"], "CAST(vehicle_id AS VARCHAR)", "trip_count", "total_duration", "total_distance", "avg_duration", "avg_distance"),
        _facts("flow_nodes", s["od_nodes"], "name", "lng", "lat"), _facts("flow_edges", s["od_net_edges"], "source || '>' || target", "value"),
        _facts("net_flow", s["net_flow_top15"], "direction || ' ' || label", "order_no", "grid_id", "net_flow"),
    ])


def _analysed(s: dict[str, str]) -> str:
    return "\nUNION ALL ".join([
        _facts("od_trips", s["od_export"], "concat_ws(' ', VehicleNum, Stime, Etime, trip_id)", "SLng", "ELat", "duration_min", "distance_km", "avg_speed"),
        _facts("hourly_stats", s["hourly_stats"], "CAST(hour AS VARCHAR)", "trip_count", "avg_duration", "median_duration", "avg_distance", "unique_vehicles"),
        _facts("period_stats", s["period_stats"], "concat_ws(' ', period_name, time_range)", "trip_count", "ratio_pct", "avg_duration", "avg_distance", "active_vehicles"),
        _facts("hotspots", s["hotspots_both"], "concat_ws(' ', point_type, cluster_id)", "center_lng", "center_lat", "trip_count"),
        _facts("vehicle_efficiency", s["vehicle_efficiency"], "concat_ws(' ', vehicle_id, first_trip, last_trip)",
               "trip_count", "total_duration", "total_distance", "avg_duration", "avg_distance"),
        _facts("net_flow", s["net_flow"], "CAST(grid_id AS VARCHAR)", "lng", "lat", "outflow", "inflow", "net_flow"),
        _facts("realtime_stats", s["cache_scalars"], "concat_ws(' ', stat_type, stat_key)", "stat_value"),
    ])


_HOTSPOT_ROW = """'start' AS point_type, cluster_id, round(center_lng, 6) AS center_lng, round(center_lat, 6) AS center_lat,
  trip_count, round(radius_m, 4) AS radius_m, round(radius_true_m, 4) AS radius_true_m"""
_HOTSPOT_MERGE = _clusters("s", _cluster_tables("s", "_early").replace("FROM valid)", "FROM valid WHERE hour < 12)", 1) + f""",
newer AS (SELECT * FROM (SELECT {_HOTSPOT_ROW} FROM summary ORDER BY trip_count DESC, cluster_id LIMIT 20) WHERE cluster_id % 2 = 0),
older AS (SELECT {_HOTSPOT_ROW} FROM summary_early ORDER BY trip_count DESC, cluster_id LIMIT 20)
SELECT * FROM newer UNION ALL SELECT * FROM older WHERE cluster_id NOT IN (SELECT cluster_id FROM newer)""")

_REPORT_FIGURES = f"""
SELECT CAST(unnest(range(11)) AS INTEGER) AS figure_no,
  unnest(['trips', 'vehicles', 'mean duration (min)', 'mean distance (km)', 'morning peak hours', 'evening peak hours', 'busiest hour',
          'short trips (%)', 'long trips (%)', 'pick-up hotspots', 'drop-off hotspots']) AS figure,
  unnest([format('{{:,}}', total_trips), format('{{:,}}', total_vehicles), format('{{:,.1f}}', avg_duration), format('{{:,.2f}}', avg_distance),
          '[' || replace(morning_peak, ',', ', ') || ']', '[' || replace(evening_peak, ',', ', ') || ']',
          printf('%02d:00', peak_hour_max) || ' (' || format('{{:,}}', peak_max_trips) || ' trips)', format('{{:,.1f}}', short_trip_ratio),
          format('{{:,.1f}}', long_trip_ratio), format('{{:,}}', start_hotspots), format('{{:,}}', end_hotspots)]) AS text
FROM (%s)"""


def statements() -> dict[str, str]:
    """SQL per query name."""
    out = _simple()
    return out | {
        "trips_over_midnight": _over_midnight(), "board_set": _board_set(out), "analysed_tables": _analysed(out), "hotspot_merge": _HOTSPOT_MERGE,
        "report_figures": _REPORT_FIGURES.replace("%s", out["report_fields"]),
        "csv_mixed": _pings("""
SELECT CASE WHEN seq % 7 > 0 THEN CAST(vehicle_id AS VARCHAR) END AS vehicle, CASE WHEN seq % 7 > 0 THEN '出租车' || vehicle_id END AS note,
  CASE WHEN seq % 7 = 0 THEN 'corrupt_line' END AS reason, CASE WHEN seq % 7 = 0 THEN CAST(seq AS VARCHAR) END AS bad_no FROM gps"""),
    }


def _simple() -> dict[str, str]:
    out = {
        "ping_box_filter": _pings(
            "SELECT seq, vehicle_id, sec_of_day, round(lng, 6) AS lng, round(lat, 6) AS lat, open_status, round(speed, 6) AS speed FROM boxed"),
        "speed_marked": _pings("SELECT seq, vehicle_id, round(ok_speed, 6) AS speed FROM boxed"),
        "speed_linear": _pings(", " + _SPEED_ROWS + """
SELECT seq, vehicle_id, round(coalesce(ok_speed, pv + (nv - pv) * (rn - pr) / (nr - pr), pv, nv), 6) AS speed
FROM filled WHERE coalesce(pv, nv) IS NOT NULL"""),
        "speed_ffill": _pings(", " + _SPEED_ROWS + """
SELECT seq, vehicle_id, round(coalesce(ok_speed, pv, nv), 6) AS speed FROM filled WHERE coalesce(pv, nv) IS NOT NULL"""),
        "status_changes": _pings("SELECT seq, vehicle_id, sec_of_day, prev_status, open_status, change FROM chg"),
        "trips_raw": _trips(f"SELECT {_TRIP_COLUMNS} FROM raw"),
        "trips_fifo": "WITH " + _BASE.format(foreign="WHEN event_type = 'error' THEN 2") + _FIFO + f"SELECT {_TRIP_COLUMNS} FROM raw",
        "trips_unclosed": _trips("""
SELECT count(*) AS starts, count(*) FILTER (e_sec IS NULL) AS unclosed FROM started WHERE change = 1"""),
        "trips_valid": _trips(f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid"),
        "od_export": _trips("""
SELECT vehicle_id AS VehicleNum, printf('%02d:%02d:%02d', s_sec // 3600, s_sec % 3600 // 60, s_sec % 60) AS Stime,
  round(s_lng, 6) AS SLng, round(s_lat, 6) AS SLat, round(e_lng, 6) AS ELng, round(e_lat, 6) AS ELat,
  printf('%02d:%02d:%02d', e_sec // 3600, e_sec % 3600 // 60, e_sec % 60) AS Etime, round(duration_min, 6) AS duration_min,
  round(distance_km, 6) AS distance_km, round(avg_speed, 6) AS avg_speed, trip_id FROM valid"""),
        "trips_equirect": _trips("""
SELECT trip_id, round(6371.0e0 * sqrt(power(radians(e_lng - s_lng) * cos(radians((s_lat + e_lat) / 2)), 2)
  + power(radians(e_lat - s_lat), 2)), 6) AS distance_km FROM raw"""),
        "rule5_rejects": _trips("""
SELECT count(*) AS trips, count(*) FILTER (duration_min < 1) AS too_short, count(*) FILTER (duration_min > 240) AS too_long,
  count(*) FILTER (distance_km < 0.2e0) AS too_near, count(*) FILTER (avg_speed < 5) AS too_slow,
  count(*) FILTER (avg_speed > 100) AS too_fast FROM measured"""),
        "reject_counts": _trips(f""", r(reason_no, reason) AS (VALUES (0, 'no_measure'), (1, 'too_short'), (2, 'too_long'),
  (3, 'too_near'), (4, 'too_slow'), (5, 'too_fast')), t AS (SELECT {_REASON} AS reason FROM measured)
SELECT CAST(r.reason_no AS INTEGER) AS reason_no, r.reason, count(t.reason) AS n FROM r LEFT JOIN t ON t.reason = r.reason GROUP BY ALL"""),
        "clean_funnel": _funnel(),
        "od_midnight": "WITH " + _BASE.format(foreign="") + _STRICT + """
shifted AS (SELECT trip_id, vehicle_id, (s_sec + 43200) % 86400 AS s_sec, s_lng, s_lat, (e_sec + 43200) % 86400 AS e_sec, e_lng, e_lat FROM raw),
""" + _MEASURED.format(trips="shifted") + f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid",
        "quality_profile": _profile(),
        "quality_nulls": _nulls(),
        "speed_segments": _pings(""", bins(bin_no, label, lo, hi) AS (VALUES (0, '0', NULL, NULL), (1, '静止(0)', 0e0, 1e0),
  (2, '低速(1-20)', 1e0, 20e0), (3, '中速(20-40)', 20e0, 40e0), (4, '快速(40-60)', 40e0, 60e0), (5, '超快(>60)', 60e0, 1e308))
SELECT CAST(b.bin_no AS INTEGER) AS bin_no, b.label, count(g.seq) AS n,
  round(count(g.seq) * 100.0e0 / (SELECT count(*) FROM gps), 6) AS pct
FROM bins b LEFT JOIN gps g ON (b.bin_no = 0 AND g.speed = 0) OR (g.speed > b.lo AND g.speed <= b.hi) GROUP BY ALL"""),
        "hourly_stats": _trips(f""", {_HOURS}
SELECT h.hour, count(v.trip_id) AS trip_count, round(coalesce((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 0), 6) AS avg_duration,
  round(coalesce(median(duration_min), 0), 6) AS median_duration, round(coalesce(avg(distance_km), 0), 6) AS avg_distance,
  count(DISTINCT vehicle_id) AS unique_vehicles FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour"""),
        "hourly_counts": _trips(f""", {_HOURS}
SELECT h.hour, count(v.trip_id) AS trip_count FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour"""),
        "hourly_trend": _trips(f""", {_HOURS}
SELECT h.hour, count(v.trip_id) AS trip_count, round(coalesce(avg(avg_speed), 0), 6) AS avg_speed,
  round(coalesce(avg(distance_km), 0), 6) AS avg_distance FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour"""),
        "peak_hours": _trips(f""", {_HOURS},
c AS (SELECT h.hour, count(v.trip_id) AS n FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour),
t AS (SELECT *, avg(n) OVER () AS mean FROM c)
SELECT round(any_value(mean), 6) AS mean_hourly_trips, round(any_value(mean) * 1.5e0, 6) AS peak_threshold,
  coalesce(string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) FILTER (n > mean * 1.5e0), '') AS peak_hours,
  coalesce(string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) FILTER (n > mean * 1.5e0 AND hour BETWEEN 6 AND 10), '') AS morning_peak,
  coalesce(string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) FILTER (n > mean * 1.5e0 AND hour BETWEEN 16 AND 20), '') AS evening_peak,
  (SELECT hour FROM t ORDER BY n DESC, hour LIMIT 1) AS peak_hour_max, max(n) AS peak_max_trips FROM t"""),
        "hourly_reference_lines": _trips(f""", {_HOURS}, {_PERIOD_VALUES},
c AS (SELECT h.hour, count(v.trip_id) AS n FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour)
SELECT hour, n AS trip_count, round(avg(n) OVER (), 6) AS mean_trips, round(avg(n) OVER () * 1.5e0, 6) AS peak_threshold,
  n > avg(n) OVER () * 1.5e0 AS is_peak, (SELECT period_name FROM periods p WHERE c.hour * 3600 >= p.a AND c.hour * 3600 < p.b) AS period_name FROM c"""),
        "period_stats": _trips(f""", {_PERIOD_VALUES}
SELECT CAST(p.period_no AS INTEGER) AS period_no, p.period_name, p.time_range, count(v.trip_id) AS trip_count,
  round(count(v.trip_id) * 100.0e0 / (SELECT count(*) FROM valid), 6) AS ratio_pct, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance, count(DISTINCT vehicle_id) AS active_vehicles
FROM periods p LEFT JOIN valid v ON v.s_sec >= p.a AND v.s_sec < p.b GROUP BY ALL"""),
        "duration_stats": _trips("""
SELECT count(*) AS n, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS mean, round(median(duration_min), 6) AS median, round(stddev_samp(duration_min), 6) AS std,
  round(skewness(duration_min), 6) AS skewness, round(kurtosis(duration_min), 6) AS kurtosis,
  round(quantile_cont(duration_min, 0.25), 6) AS p25, round(quantile_cont(duration_min, 0.5), 6) AS p50, round(quantile_cont(duration_min, 0.75), 6) AS p75,
  round(quantile_cont(duration_min, 0.9), 6) AS p90, round(quantile_cont(duration_min, 0.95), 6) AS p95, round(quantile_cont(duration_min, 0.99), 6) AS p99,
  round(min(duration_min), 6) AS min, round(max(duration_min), 6) AS max FROM valid"""),
        "distance_stats": _trips("""
SELECT count(*) AS n, round(avg(distance_km), 6) AS mean, round(median(distance_km), 6) AS median, round(stddev_samp(distance_km), 6) AS std,
  round(quantile_cont(distance_km, 0.25), 6) AS p25, round(quantile_cont(distance_km, 0.5), 6) AS p50, round(quantile_cont(distance_km, 0.75), 6) AS p75,
  round(quantile_cont(distance_km, 0.9), 6) AS p90, round(quantile_cont(distance_km, 0.95), 6) AS p95,
  round(avg(CASE WHEN distance_km < 3 THEN 100.0e0 ELSE 0 END), 6) AS short_trip_ratio,
  round(avg(CASE WHEN distance_km > 10 THEN 100.0e0 ELSE 0 END), 6) AS long_trip_ratio FROM valid"""),
        "duration_hist": _hist("duration_min", [0, 5, 10, 20, 30, 60, 120, 240],
                               ["≤5分钟", "5-10分钟", "10-20分钟", "20-30分钟", "30-60分钟", "60-120分钟", ">120分钟"]),
        "distance_hist": _hist("distance_km", [0, 1, 3, 5, 10, 20, 30, None],
                               ["<1km", "1-3km", "3-5km", "5-10km", "10-20km", "20-30km", ">30km"]),
        "speed_hist": _hist("avg_speed", [0, 10, 20, 30, 40, 50, 60, 80, None],
                            ["0-10", "10-20", "20-30", "30-40", "40-50", "50-60", "60-80", ">80"]),
        "speed_stats": _trips("""
SELECT round(avg(avg_speed), 6) AS mean, round(median(avg_speed), 6) AS median, count(*) AS total,
  CAST(CASE WHEN avg(avg_speed) <= 60 THEN ceil(avg(avg_speed) / 10) - 1 WHEN avg(avg_speed) <= 80 THEN 6 ELSE 7 END AS INTEGER) AS mean_bin FROM valid"""),
        "vehicle_efficiency": _trips(_EFFICIENCY),
        "vehicle_top15": _trips(_EFFICIENCY + " ORDER BY trip_count DESC, vehicle_id LIMIT 15"),
        "kpis": _trips(""", h AS (SELECT hour, count(*) AS n FROM valid GROUP BY hour)
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  (SELECT hour FROM h ORDER BY n DESC, hour LIMIT 1) AS peak_hour, (SELECT max(n) FROM h) AS peak_trips FROM valid"""),
        "live_kpis": _trips("""
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance, round(avg(avg_speed), 6) AS avg_speed FROM valid"""),
        "trips_per_vehicle": _trips("""
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles,
  round(count(*) * 1.0e0 / count(DISTINCT vehicle_id), 6) AS trips_per_vehicle FROM valid"""),
        "dur_dist_corr": _trips("SELECT round(corr(duration_min, distance_km), 6) AS correlation, count(*) AS n FROM valid"),
        "density_start": _density("SELECT si AS i_lng, sj AS i_lat FROM cells"),
        "density_end": _density("SELECT ei AS i_lng, ej AS i_lat FROM cells"),
        "density_both": _density("SELECT si AS i_lng, sj AS i_lat FROM cells UNION ALL SELECT ei, ej FROM cells"),
        "density_by_period": _spatial(f""", {_PERIOD_VALUES}
SELECT CAST(p.period_no AS INTEGER) AS period_no, p.period_name, si AS i_lng, sj AS i_lat, count(*) AS n,
  round(113.5e0 + (si + 0.5e0) * 0.01e0, 6) AS lng, round(22.4e0 + (sj + 0.5e0) * 0.009e0, 6) AS lat
FROM cells c JOIN periods p ON c.s_sec >= p.a AND c.s_sec < p.b GROUP BY ALL"""),
        "od_matrix": _spatial("SELECT o, d, flow FROM pairs"),
        "od_summary": _spatial("""
SELECT CAST(sum(flow) AS BIGINT) AS trips, count(*) AS pairs, CAST(coalesce(sum(flow) FILTER (o = d), 0) AS BIGINT) AS intra_trips,
  round(coalesce(sum(flow) FILTER (o = d), 0) * 100.0e0 / sum(flow), 6) AS intra_pct FROM pairs"""),
        "od_top30": _spatial(f"""
SELECT o, d, flow, {lng_of('o')} AS o_lng, {lat_of('o')} AS o_lat, {lng_of('d')} AS d_lng, {lat_of('d')} AS d_lat FROM top30"""),
        "od_net_edges": _spatial(f"SELECT o, d, {_name('o')} AS source, {_name('d')} AS target, flow AS value FROM edges"),
        "od_net_edges_all": _spatial(f""", all_signed AS (
  SELECT least(o, d) AS lo, greatest(o, d) AS hi, CAST(sum(CASE WHEN o < d THEN flow ELSE -flow END) AS BIGINT) AS net
  FROM pairs WHERE o <> d GROUP BY ALL),
net AS (SELECT CASE WHEN net > 0 THEN lo ELSE hi END AS o, CASE WHEN net > 0 THEN hi ELSE lo END AS d, abs(net) AS flow FROM all_signed WHERE net <> 0)
SELECT o, d, {_name('o')} AS source, {_name('d')} AS target, flow AS value FROM net ORDER BY flow DESC, o, d LIMIT 30"""),
        "od_nodes": _spatial(f"""
SELECT DISTINCT {_name('c')} AS name, {lng_of('c')} AS lng, {lat_of('c')} AS lat FROM (SELECT o AS c FROM edges UNION SELECT d FROM edges)"""),
        "net_flow": _spatial(f"SELECT grid_id, {lng_of('grid_id')} AS lng, {lat_of('grid_id')} AS lat, outflow, inflow, net_flow FROM flows"),
        "net_flow_dense": _spatial(f"""
SELECT g.range AS grid_id, {lng_of('g.range')} AS lng, {lat_of('g.range')} AS lat, coalesce(outflow, 0) AS outflow,
  coalesce(inflow, 0) AS inflow, coalesce(net_flow, 0) AS net_flow FROM range(5656) g LEFT JOIN flows f ON f.grid_id = g.range"""),
        "net_flow_top15": _spatial("""
SELECT *, """ + _label("113.5e0 + (grid_id // 56 + 0.5e0) * 0.01e0", "22.4e0 + (grid_id % 56 + 0.5e0) * 0.009e0") + """ AS label FROM (
SELECT * FROM (SELECT 'in' AS direction, CAST(row_number() OVER (ORDER BY net_flow DESC, grid_id) AS INTEGER) AS order_no, grid_id, net_flow, abs(net_flow) AS value
  FROM flows ORDER BY order_no LIMIT 15)
UNION ALL SELECT * FROM (SELECT 'out', CAST(row_number() OVER (ORDER BY net_flow, grid_id) AS INTEGER) AS order_no, grid_id, net_flow, abs(net_flow)
  FROM flows ORDER BY order_no LIMIT 15))"""),
        "top_cells_outflow": _spatial("SELECT grid_id, outflow, inflow FROM flows ORDER BY outflow DESC, grid_id LIMIT 10"),
        "top_cells_inflow": _spatial("SELECT grid_id, outflow, inflow FROM flows ORDER BY inflow DESC, grid_id LIMIT 10"),
        "heat_top500": _spatial("""
SELECT si AS i_lng, sj AS i_lat, round(113.5e0 + (si + 0.5e0) * 0.01e0, 6) AS lng, round(22.4e0 + (sj + 0.5e0) * 0.009e0, 6) AS lat,
  count(*) AS count, least(count(*), 50) AS intensity FROM cells GROUP BY si, sj ORDER BY count(*) DESC, si, sj LIMIT 500"""),
        "hotspots_start": _hotspots("start"),
        "hotspots_end": _hotspots("end"),
        "hotspot_labels": _clusters("s", "SELECT id, cluster_id FROM labelled"),
        "hotspot_ranking": _clusters("s", """
SELECT CAST(row_number() OVER (ORDER BY trip_count DESC, cluster_id) AS INTEGER) AS rank_no, cluster_id, round(center_lng, 6) AS lng, round(center_lat, 6) AS lat,
  """ + _label("center_lng", "center_lat") + """ AS label, trip_count AS count, round(trip_count * 100.0e0 / max(trip_count) OVER ()) AS bar_pct
FROM summary ORDER BY rank_no LIMIT 15"""),
        "hotspots_both": _both_clusters("\nUNION ALL ".join(f"""SELECT * FROM (
SELECT '{kind}' AS point_type, cluster_id, round(center_lng, 6) AS center_lng, round(center_lat, 6) AS center_lat,
  trip_count, round(radius_m, 4) AS radius_m, round(radius_true_m, 4) AS radius_true_m
FROM {table} ORDER BY trip_count DESC, cluster_id LIMIT 20)""" for kind, table in (("start", "summary"), ("end", "summary_e")))),
        "hotspot_bars": _clusters("s", """
SELECT cluster_id, '#' || cluster_id || ' ' || """ + _label("center_lng", "center_lat") + """ AS label, trip_count
FROM summary ORDER BY trip_count DESC, cluster_id LIMIT 15"""),
        "space_summary": _clusters("s", """
SELECT 5656 AS n_cells, 0.01e0 AS grid_lng, 0.009e0 AS grid_lat, (SELECT count(*) FROM centers) AS hotspot_count"""),
        "vehicle_bars": _trips(f"""
SELECT vehicle_id, trip_count, round(total_duration, 1) AS total_duration, round(total_distance, 2) AS total_distance,
  round(avg_duration, 1) AS avg_duration, round(avg_distance, 2) AS avg_distance
FROM ({_EFFICIENCY.replace(", 6)", ", 12)")}) ORDER BY trip_count DESC, vehicle_id LIMIT 15"""),
        "trips_derived": "WITH " + _BASE.format(foreign="") + _STRICT.rstrip().rstrip(",") + f"""
SELECT {_TRIP_COLUMNS}, CAST(s_sec // 3600 AS INTEGER) AS hour, e_sec - s_sec + CASE WHEN e_sec < s_sec THEN 86400 ELSE 0 END AS duration_s,
  round((e_sec - s_sec + CASE WHEN e_sec < s_sec THEN 86400 ELSE 0 END) / 60.0e0, 6) AS duration_min,
  round(6371.0e0 * sqrt(power(radians(e_lng - s_lng) * cos(radians((s_lat + e_lat) / 2)), 2) + power(radians(e_lat - s_lat), 2)), 6) AS distance_km
FROM raw""",
        "scatter_sample": _trips("""
SELECT trip_id, round(duration_min, 6) AS duration_min, round(distance_km, 6) AS distance_km
FROM valid ORDER BY md5(trip_id || ':42'), trip_id LIMIT 500"""),
        "csv_pings": _pings("""
SELECT vehicle_id, sec_of_day, round(lng, 6) AS lng, round(lat, 6) AS lat, open_status, round(speed, 6) AS speed FROM gps"""),
        "csv_quarantine": _pings("""
SELECT seq, CASE WHEN seq % 13 = 0 THEN 'bad_vehicle' WHEN seq % 11 = 0 THEN 'bad_coordinate' ELSE 'bad_status' END AS reject_reason
FROM gps WHERE seq % 13 = 0 OR seq % 11 = 0 OR seq % 7 = 0"""),
        "csv_trips": _trips("""
SELECT vehicle_id, s_sec, round(s_lng, 6) AS s_lng, round(s_lat, 6) AS s_lat, e_sec, round(e_lng, 6) AS e_lng, round(e_lat, 6) AS e_lat
FROM valid"""),
        "two_day_store": _pings("""
SELECT CASE WHEN seq % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS day, vehicle_id, sec_of_day, round(lng, 6) AS lng,
  round(lat, 6) AS lat, open_status, round(speed, 6) AS speed FROM gps"""),
        "hourly_merge": _trips(f""", {_HOURS}
SELECT h.hour, count(v.trip_id) AS trip_count, round(coalesce((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 0), 6) AS avg_duration,
  round(coalesce(median(duration_min), 0), 6) AS median_duration, round(coalesce(avg(distance_km), 0), 6) AS avg_distance,
  count(DISTINCT vehicle_id) AS unique_vehicles
FROM hours h LEFT JOIN valid v ON v.hour = h.hour AND (v.hour >= 9 OR v.hour < 12) GROUP BY h.hour"""),
        "period_merge": _trips(f""", {_PERIOD_VALUES},
rows AS (SELECT p.*, v.* FROM periods p LEFT JOIN valid v ON v.s_sec >= p.a AND v.s_sec < p.b AND (p.period_name <> '早高峰' OR v.hour < 12))
SELECT period_name, time_range, count(trip_id) AS trip_count,
  round(count(trip_id) * 100.0e0 / (SELECT count(*) FROM valid WHERE period_name <> '早高峰' OR hour < 12), 6) AS ratio_pct,
  round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance, count(DISTINCT vehicle_id) AS active_vehicles
FROM rows GROUP BY period_name, time_range""".replace("rows AS", "told AS").replace("FROM rows", "FROM told")),
        "vehicle_merge": _trips(f"""SELECT vehicle_id AS "VehicleNum", * EXCLUDE (vehicle_id) FROM (
{_EFFICIENCY.replace("FROM valid", "FROM valid WHERE hour < 12 OR vehicle_id % 2 = 0")})"""),
        "published_table": _spatial(f"SELECT grid_id, {lng_of('grid_id')} AS lng, {lat_of('grid_id')} AS lat, outflow, inflow, net_flow FROM flows"),
        "live_repeats": _trips(f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid"),
        "report_fields": _both_clusters(f""", {_HOURS},
c AS (SELECT h.hour, count(v.trip_id) AS n FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour)
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance, (SELECT hour FROM c ORDER BY n DESC, hour LIMIT 1) AS peak_hour_max, (SELECT max(n) FROM c) AS peak_max_trips,
  round(avg(CASE WHEN distance_km < 3 THEN 100.0e0 ELSE 0 END), 6) AS short_trip_ratio,
  round(avg(CASE WHEN distance_km > 10 THEN 100.0e0 ELSE 0 END), 6) AS long_trip_ratio,
  {_PEAK_LISTS}, (SELECT count(*) FROM centers) AS start_hotspots, (SELECT count(*) FROM centers_e) AS end_hotspots FROM valid"""),
        "cache_scalars": _trips(_CACHE_SCALARS + "SELECT * FROM scalars"),
        "cache_upsert": _trips(_CACHE_SCALARS + """
SELECT stat_type, stat_key, stat_value FROM scalars WHERE stat_type = 'hourly_trips'
UNION ALL SELECT 'period_trips', p.period_name, CAST(count(v.trip_id) AS DOUBLE)
FROM periods p LEFT JOIN valid v ON v.s_sec >= p.a AND v.s_sec < p.b AND v.hour < 12 GROUP BY p.period_name"""),
        "hourly_board": _trips(f""", {_HOURS}
SELECT h.hour, printf('%02d:00', h.hour) AS label, count(v.trip_id) AS trip_count
FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour"""),
        "period_shares": _trips(f""", {_PERIOD_VALUES}
SELECT CAST(p.period_no AS INTEGER) AS period_no, p.period_name, round(count(v.trip_id) * 100.0e0 / (SELECT count(*) FROM valid), 1) AS ratio_pct
FROM periods p LEFT JOIN valid v ON v.s_sec >= p.a AND v.s_sec < p.b GROUP BY ALL"""),
        "distance_summary": _trips("""
SELECT round(avg(distance_km), 2) AS mean, round(median(distance_km), 2) AS median,
  round(avg(CASE WHEN distance_km < 3 THEN 100.0e0 ELSE 0 END), 1) AS short_ratio,
  round(avg(CASE WHEN distance_km > 10 THEN 100.0e0 ELSE 0 END), 1) AS long_ratio FROM valid"""),
        "speed_summary": _trips("""
SELECT round(avg(avg_speed), 1) AS mean, round(median(avg_speed), 1) AS median, count(*) AS total,
  CAST(CASE WHEN avg(avg_speed) <= 60 THEN ceil(avg(avg_speed) / 10) - 1 WHEN avg(avg_speed) <= 80 THEN 6 ELSE 7 END AS INTEGER) AS mean_bin FROM valid"""),
        "time_summary": _trips(f""", {_HOURS},
c AS (SELECT h.hour, count(v.trip_id) AS n FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour)
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles, {_PEAK_LISTS},
  (SELECT hour FROM c ORDER BY n DESC, hour LIMIT 1) AS peak_hour_max FROM valid"""),
        "cache_kpis": _trips("""
SELECT count(*) AS total_trips, count(DISTINCT vehicle_id) AS total_vehicles, round((sum(duration_s)::DOUBLE / 60.0e0 / count(duration_s)), 6) AS avg_duration,
  round(avg(distance_km), 6) AS avg_distance, round(avg(avg_speed), 6) AS avg_speed FROM valid"""),
        "cache_heatmap": _spatial("""
SELECT round(22.4e0 + (sj + 0.5e0) * 0.009e0, 6) AS lat, round(113.5e0 + (si + 0.5e0) * 0.01e0, 6) AS lng, count(*) AS count
FROM cells GROUP BY si, sj ORDER BY count(*) DESC, si, sj LIMIT 500"""),
        "cache_trend": _trips(f""", {_HOURS}
SELECT printf('%02d:00', h.hour) AS hours, count(v.trip_id) AS trips, round(coalesce(avg(avg_speed), 0), 6) AS speeds,
  round(coalesce(avg(distance_km), 0), 6) AS distances FROM hours h LEFT JOIN valid v ON v.hour = h.hour GROUP BY h.hour"""),
        "cache_periods": _trips(_CACHE_SCALARS + """
SELECT stat_key AS label, CAST(stat_value AS BIGINT) AS trips FROM scalars WHERE stat_type = 'period_trips'"""),
        "cache_hourly": _trips(_CACHE_SCALARS + """
SELECT stat_key AS hour, CAST(stat_value AS BIGINT) AS trips FROM scalars WHERE stat_type = 'hourly_trips'"""),
        "cache_ranking": _clusters("s", """
SELECT CAST(row_number() OVER (ORDER BY trip_count DESC, cluster_id) AS INTEGER) AS rank, '#' || cluster_id AS name,
  round(center_lng, 6) AS lng, round(center_lat, 6) AS lat, trip_count AS count FROM summary ORDER BY rank LIMIT 15"""),
        "board_dashboard": _BOARD_FACTS,
        "cache_rows": _BOARD_FACTS,
        "quarantine_rows": _trips("""
SELECT trip_id AS seq, CASE WHEN trip_id % 13 = 0 THEN 'bad_vehicle' WHEN trip_id % 11 = 0 THEN 'bad_time' ELSE 'bad_coordinate' END AS reject_reason
FROM valid WHERE trip_id % 13 = 0 OR trip_id % 11 = 0 OR trip_id % 7 = 0"""),
        "live_trips": _trips(f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid"),
        "live_board": f"SELECT * FROM ({_BOARD_FACTS}) WHERE section <> 'ranking'",
        "live_keyed": _trips(f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid"),
        "live_delta_board": _BOARD_FACTS,
        "live_settled": _trips(f"SELECT {_TRIP_COLUMNS}, {_MEASURES} FROM valid"),
        "live_heat": _spatial("""
, spread AS (SELECT si, sj, s_sec // 900 * 900 - k.range * 900 AS start FROM cells, range(4) k)
SELECT strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(start), '%Y-%m-%d %H:%M') AS window_start, si AS i_lng, sj AS i_lat,
  round(113.5e0 + (si + 0.5e0) * 0.01e0, 6) AS lng, round(22.4e0 + (sj + 0.5e0) * 0.009e0, 6) AS lat, count(*) AS count
FROM spread GROUP BY ALL"""),
        "live_hourly": _trips("""
SELECT strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(hour), '%Y-%m-%d %H:%M') AS stat_key, CAST(count(*) AS DOUBLE) AS stat_value,
  round(avg(avg_speed), 6) AS avg_speed, round(avg(distance_km), 6) AS avg_distance FROM valid GROUP BY hour"""),
    }
    return out
