"""The registered queries again, as SQL written from their definitions.

The SQL takes other ways than the Spark code where it can: plain window functions for
blocked numbering, a product of all stops for the grid join, unrolled rounds for the loop.
"""

from __future__ import annotations

import re

_MAX_ROUNDS = 3
_STEPS = 14

_VIEWS: dict[str, str] = {
    "trips": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, 'R' || (o_custkey % 40) AS route_id,
               CASE WHEN wd BETWEEN 1 AND 5 THEN '1' WHEN wd = 6 THEN '2' ELSE '3' END AS service_id,
               CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
               'To ' || o_orderpriority AS trip_headsign,
               strftime(o_orderdate, '%Y%m%d') AS start_date
        FROM (SELECT *, (date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 4) % 7 AS wd FROM orders)""",
    "services": """
        SELECT d.day, d.service_id
        FROM (VALUES ('monday', '1'), ('tuesday', '1'), ('wednesday', '1'), ('thursday', '1'),
                     ('friday', '1'), ('saturday', '2'), ('sunday', '3')) AS d(day, service_id)
        WHERE d.service_id IN (SELECT service_id FROM trips)""",
    "exceptions": """
        SELECT CASE WHEN n % 2 = 0 THEN CAST(CAST(service_id AS INTEGER) % 3 + 1 AS VARCHAR) ELSE service_id END AS service_id,
               start_date AS service_date, n % 2 + 1 AS kind
        FROM (SELECT service_id, start_date, count(*) AS n FROM trips GROUP BY service_id, start_date)
        WHERE n % 5 = 0""",
    "service_dates": """
        SELECT strftime(d, '%Y%m%d') AS service_date, service_id FROM (
            SELECT service_id, unnest(generate_series(min(strptime(start_date, '%Y%m%d')),
                                                      max(strptime(start_date, '%Y%m%d')), INTERVAL 1 DAY)) AS d
            FROM trips GROUP BY service_id)
        WHERE service_id = CASE isodow(d) WHEN 6 THEN '2' WHEN 7 THEN '3' ELSE '1' END
        EXCEPT SELECT service_date, service_id FROM exceptions WHERE kind = 2
        UNION SELECT service_date, service_id FROM exceptions WHERE kind = 1""",
    "calls": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id,
               CAST(seq AS INTEGER) AS stop_sequence,
               CAST(18000 + (l_orderkey * 97) % 70200 + 300 * (seq - 1) AS INTEGER) AS arr_secs,
               CAST(18000 + (l_orderkey * 97) % 70200 + 300 * (seq - 1) + 30 AS INTEGER) AS dep_secs
        FROM (SELECT l_orderkey, l_suppkey,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY min(l_linenumber), l_suppkey) AS seq
              FROM lineitem GROUP BY l_orderkey, l_suppkey)""",
    "stops": """
        SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
               CAST(49.2 AS DOUBLE) + (s_suppkey % 10) * CAST(0.0006 AS DOUBLE) AS stop_lat,
               CAST(-123.1 AS DOUBLE) + (s_suppkey // 10) * CAST(0.0009 AS DOUBLE) AS stop_lon
        FROM supplier""",
    "rt_stops": """
        SELECT c.stop_id, c.trip_id, c.stop_sequence,
               CASE WHEN l_tax = 0 THEN -1 ELSE q - 400 END AS arrival_delay,
               CASE WHEN l_tax = 0 THEN -1 ELSE midnight + c.arr_secs + q - 400 END AS arrival_time,
               q - 400 + 5 * l_linenumber AS departure_delay,
               midnight + c.dep_secs + q - 400 + 5 * l_linenumber AS departure_time,
               midnight + c.arr_secs - 60 AS snapshot_ts
        FROM (SELECT *, CAST(floor(l_quantity * 20) AS INTEGER) AS q FROM lineitem) l
        JOIN calls c ON c.trip_id = CAST(l_orderkey AS VARCHAR) AND c.stop_id = CAST(l_suppkey AS VARCHAR)
        JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
                     CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS midnight
              FROM orders) o ON o.trip_id = c.trip_id""",
    "rt_trips": """
        SELECT t.trip_id, t.start_date, t.route_id, t.direction_id, r.snapshot_ts
        FROM trips t JOIN rt_stops r ON r.trip_id = t.trip_id""",
    "rt_vehicles": """
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 1000 AS VARCHAR) AS trip_id,
               'V' || user_id AS vehicle_label,
               CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS snapshot_ts
        FROM events""",
    "alerts": """
        SELECT 'A' || (event_id % 20) AS alert_id, 'R' || (user_id % 40) AS route_id,
               moment AS active_period_start,
               CASE WHEN event_id % 4 = 0 THEN -1 ELSE moment + 3600 END AS active_period_end,
               CASE WHEN event_id % 3 = 0 THEN '-1' ELSE CAST(user_id % 100 AS VARCHAR) END AS stop_id,
               3 AS route_type, moment AS snapshot_ts,
               k % 12 + 1 AS cause, k % 9 + 1 AS effect, k % 4 + 1 AS severity_level
        FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS moment,
                     CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "routes": """
        SELECT route_id, lpad(n, 3, '0') AS route_short_name,
               CASE WHEN CAST(n AS INTEGER) % 10 <> 0 THEN 'Line ' || n END AS route_long_name
        FROM (SELECT DISTINCT route_id, substr(route_id, 2) AS n FROM trips)""",
    "searches": """
        SELECT s_suppkey AS query_id, CAST(s_suppkey AS VARCHAR) AS origin,
               CAST(21600 + (s_suppkey * 977) % 54000 AS INTEGER) AS departure_secs,
               CASE s_suppkey % 7 WHEN 0 THEN 'monday' WHEN 1 THEN 'tuesday' WHEN 2 THEN 'wednesday'
                    WHEN 3 THEN 'thursday' WHEN 4 THEN 'friday' WHEN 5 THEN 'saturday' ELSE 'sunday' END AS day
        FROM supplier""",
    "destinations": """
        SELECT DISTINCT c_custkey % n AS query_id, CAST((c_custkey * 31 + c_nationkey) % n AS VARCHAR) AS stop_id
        FROM customer, (SELECT count(*) AS n FROM supplier)""",
    "search_terms": """
        SELECT s_suppkey AS term_id,
               CASE s_suppkey WHEN 0 THEN 'SUPPLIER#' WHEN 1 THEN 'zzz' ELSE right(s_name, 4) END AS term
        FROM supplier""",
    # Preprocessed tables.
    "kept": "SELECT * FROM calls WHERE arr_secs < 86400",
    "patterns": """
        SELECT t.trip_id, t.route_id, t.service_id, p.calls,
               t.route_id || '--' || md5(p.calls || ',' || p.a || ',' || p.b || ',' || p.c || ',' || p.d) AS pattern
        FROM trips t
        JOIN (SELECT trip_id, count(*) AS calls,
                     sum(CAST('0x' || substr(m, 1, 8) AS BIGINT)) AS a, sum(CAST('0x' || substr(m, 9, 8) AS BIGINT)) AS b,
                     sum(CAST('0x' || substr(m, 17, 8) AS BIGINT)) AS c, sum(CAST('0x' || substr(m, 25, 8) AS BIGINT)) AS d
              FROM (SELECT trip_id, md5(stop_sequence || '@' || stop_id) AS m FROM kept)
              GROUP BY trip_id) p ON p.trip_id = t.trip_id""",
    "dated": "SELECT k.*, p.service_id, p.route_id, p.pattern FROM kept k JOIN patterns p ON p.trip_id = k.trip_id",
    "served": "SELECT * FROM stops WHERE stop_id IN (SELECT stop_id FROM dated)",
    "stop_pairs": """
        SELECT a.stop_id AS from_stop_id, b.stop_id AS to_stop_id,
               2 * 6372800.0 * asin(sqrt(pow(sin(radians(b.stop_lat - a.stop_lat) / 2), 2)
                   + cos(radians(a.stop_lat)) * cos(radians(b.stop_lat))
                     * pow(sin(radians(b.stop_lon - a.stop_lon) / 2), 2))) AS distance
        FROM stops a, stops b WHERE a.stop_id <> b.stop_id""",
    "all_transfers": "SELECT * FROM stop_pairs WHERE distance < 100",
    "moves": """
        SELECT from_stop_id, to_stop_id, CAST(ceil(distance / 1.4) AS INTEGER) AS walk_secs FROM all_transfers
        WHERE from_stop_id IN (SELECT stop_id FROM served) AND to_stop_id IN (SELECT stop_id FROM served)
        UNION ALL SELECT stop_id, stop_id, 0 FROM served""",
    # Fusion and features.
    "schedule": """
        SELECT c.trip_id, t.route_id, t.service_id, t.direction_id, c.arr_secs AS sch_arrival_secs,
               c.dep_secs AS sch_departure_secs, c.stop_id, c.stop_sequence, s.stop_name,
               round(s.stop_lat, 6) AS stop_lat, round(s.stop_lon, 6) AS stop_lon
        FROM calls c JOIN trips t ON t.trip_id = c.trip_id JOIN stops s ON s.stop_id = c.stop_id""",
    "fused": """
        SELECT s.trip_id, s.stop_id,
               strftime(make_timestamp(coalesce(arrival_time, departure_time) * 1000000), '%m-%d-%Y') AS trip_date,
               arrival_delay, s.route_id, arrival_time - arrival_delay AS sch_arrival_time,
               departure_time - departure_delay AS sch_departure_time, s.stop_sequence, s.stop_name,
               s.stop_lat, s.stop_lon, arrival_time, departure_delay, departure_time
        FROM schedule s
        JOIN (SELECT trip_id, stop_id, nullif(arrival_time, -1) AS arrival_time,
                     CASE WHEN arrival_time <> -1 THEN arrival_delay END AS arrival_delay,
                     departure_delay, departure_time
              FROM rt_stops) r ON r.trip_id = s.trip_id AND r.stop_id = s.stop_id""",
    "max_delay": """
        SELECT f.* FROM fused f
        WHERE f.arrival_delay IS NOT DISTINCT FROM (
            SELECT max(g.arrival_delay) FROM fused g
            WHERE g.trip_id = f.trip_id AND g.stop_id = f.stop_id AND g.trip_date = f.trip_date)""",
    "records": """
        SELECT f.*, t.direction_id FROM trips t JOIN (
            SELECT *, row_number() OVER (PARTITION BY trip_id, stop_id, trip_date
                ORDER BY arrival_delay DESC NULLS LAST, arrival_time DESC NULLS LAST,
                         departure_delay DESC, departure_time DESC) AS choice
            FROM fused) f ON f.trip_id = t.trip_id
        WHERE choice = 1""",
    "spread": "SELECT median(arrival_delay) AS mid, stddev_samp(arrival_delay) AS dev FROM records",
    "timed": """
        SELECT *, CASE WHEN stop_sequence = 1 THEN 0 ELSE coalesce(arrival_time - lag(arrival_time) OVER (
                   PARTITION BY trip_id, trip_date ORDER BY stop_sequence, arrival_time, stop_id), 0) END AS running_time
        FROM records WHERE arrival_time IS NOT NULL""",
    "series": """
        SELECT r.* REPLACE (CASE WHEN abs(arrival_delay - mid) > dev THEN mid ELSE arrival_delay END / 60 AS arrival_delay)
        FROM timed r, spread""",
    "lags": """
        SELECT *, row_number() OVER w AS position, {lags}
        FROM series WINDOW w AS (PARTITION BY route_id, direction_id
                                 ORDER BY arrival_time, trip_id, stop_sequence, stop_id)""",
    "supervised": f"""
        SELECT *, position - {_STEPS} > n - floor(n * 0.1) AS is_test
        FROM (SELECT *, count(*) OVER (PARTITION BY route_id, direction_id) AS n FROM lags WHERE position > {_STEPS})""",
}
_VIEWS["lags"] = _VIEWS["lags"].format(
    lags=", ".join(
        f"lag({f}, {i}) OVER w AS {f}_{i}"
        for f in ("arrival_delay", "arrival_time", "running_time")
        for i in range(1, _STEPS + 1)
    )
)


def _rounds(tag: str, searches: str, services: str) -> dict[str, str]:
    """The rounds of some searches, as views whose names begin with the tag."""
    views = {
        f"{tag}labels_0": f"""
        SELECT query_id, origin AS stop_id, 0 AS round, departure_secs AS arrival_secs, CAST(NULL AS VARCHAR) AS mode,
               CAST(NULL AS VARCHAR) AS trip_id, CAST(NULL AS VARCHAR) AS board_stop,
               CAST(NULL AS INTEGER) AS board_dep_secs, CAST(NULL AS VARCHAR) AS alight_stop,
               CAST(NULL AS INTEGER) AS alight_secs
        FROM {searches} WHERE origin IN (SELECT stop_id FROM served)""",
        f"{tag}known_0": f"SELECT query_id, stop_id, arrival_secs FROM {tag}labels_0",
    }
    for k in range(1, _MAX_ROUNDS + 1):
        views[f"{tag}boardable_{k}"] = f"""
        SELECT f.query_id, c.trip_id, c.stop_id, c.stop_sequence, c.dep_secs, c.pattern,
               s.departure_secs + 3600 AS horizon_secs
        FROM {tag}labels_{k - 1} f
        JOIN {searches} s ON s.query_id = f.query_id
        JOIN {services} v ON v.day = s.day
        JOIN dated c ON c.stop_id = f.stop_id AND c.service_id = v.service_id
        WHERE c.dep_secs >= f.arrival_secs AND c.arr_secs >= s.departure_secs
          AND c.arr_secs < s.departure_secs + 3600"""
        views[f"{tag}onward_{k}"] = f"""
        SELECT b.query_id, c.stop_id, c.arr_secs AS arrival_secs, 'R' AS mode, b.trip_id,
               b.stop_id AS board_stop, b.dep_secs AS board_dep_secs, c.stop_id AS alight_stop,
               c.arr_secs AS alight_secs
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, trip_id ORDER BY stop_sequence) AS place
              FROM {tag}boardable_{k}) b
        JOIN dated c ON c.trip_id = b.trip_id AND c.stop_sequence > b.stop_sequence AND c.arr_secs < b.horizon_secs
        WHERE place = 1"""
        views[f"{tag}rides_{k}"] = f"""
        SELECT r.* EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id, stop_id
                                         ORDER BY arrival_secs, trip_id) AS place
            FROM {tag}onward_{k}) r
        LEFT JOIN {tag}known_{k - 1} n ON n.query_id = r.query_id AND n.stop_id = r.stop_id
        WHERE place = 1 AND (n.arrival_secs IS NULL OR r.arrival_secs < n.arrival_secs)"""
        views[f"{tag}candidates_{k}"] = f"""
        SELECT query_id, stop_id, arrival_secs, mode, trip_id, board_stop, board_dep_secs, alight_stop, alight_secs
        FROM {tag}rides_{k}
        UNION ALL
        SELECT r.query_id, m.to_stop_id, r.arrival_secs + m.walk_secs, 'RW', r.trip_id, r.board_stop,
               r.board_dep_secs, r.alight_stop, r.alight_secs
        FROM {tag}rides_{k} r JOIN moves m ON m.from_stop_id = r.stop_id AND m.to_stop_id <> r.stop_id
        UNION ALL
        SELECT f.query_id, m.to_stop_id, f.arrival_secs + m.walk_secs, 'W', '', f.stop_id, f.arrival_secs,
               f.stop_id, f.arrival_secs
        FROM {tag}labels_{k - 1} f JOIN moves m ON m.from_stop_id = f.stop_id AND m.to_stop_id <> f.stop_id"""
        views[f"{tag}labels_{k}"] = f"""
        SELECT c.query_id, c.stop_id, {k} AS round, c.arrival_secs, c.mode, c.trip_id, c.board_stop,
               c.board_dep_secs, c.alight_stop, c.alight_secs
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, stop_id
                  ORDER BY arrival_secs, mode, alight_stop) AS place
              FROM {tag}candidates_{k}) c
        LEFT JOIN {tag}known_{k - 1} n ON n.query_id = c.query_id AND n.stop_id = c.stop_id
        WHERE place = 1 AND (n.arrival_secs IS NULL OR c.arrival_secs < n.arrival_secs)"""
        views[f"{tag}known_{k}"] = f"""
        SELECT query_id, stop_id, min(arrival_secs) AS arrival_secs
        FROM (SELECT * FROM {tag}known_{k - 1} UNION ALL SELECT query_id, stop_id, arrival_secs FROM {tag}labels_{k})
        GROUP BY query_id, stop_id"""
    views[f"{tag}labels"] = " UNION ALL ".join(f"SELECT * FROM {tag}labels_{k}" for k in range(_MAX_ROUNDS + 1))
    return views


def _ways(tag: str, destinations: str) -> dict[str, str]:
    """The hops and legs of the journeys to some destinations."""
    views = {
        f"{tag}final": f"""
    SELECT l.* FROM {tag}labels l JOIN {destinations} d ON d.query_id = l.query_id AND d.stop_id = l.stop_id
    WHERE l.round = (SELECT max(m.round) FROM {tag}labels m WHERE m.query_id = l.query_id AND m.stop_id = l.stop_id)""",
        f"{tag}hop_1": f"SELECT stop_id AS destination, * FROM {tag}final WHERE round > 0",
    }
    for k in range(2, _MAX_ROUNDS + 1):
        views[f"{tag}hop_{k}"] = f"""
        SELECT h.destination, l.* FROM {tag}hop_{k - 1} h
        JOIN {tag}labels l ON l.query_id = h.query_id AND l.stop_id = h.board_stop AND l.round = h.round - 1
        WHERE l.round > 0"""
    views[f"{tag}hops"] = " UNION ALL ".join(f"SELECT * FROM {tag}hop_{k}" for k in range(1, _MAX_ROUNDS + 1))
    views[f"{tag}legs"] = f"""
    SELECT query_id, destination,
           CAST(row_number() OVER (PARTITION BY query_id, destination ORDER BY round, part) AS INTEGER) AS leg_no,
           mode, trip_id, from_stop, to_stop, depart_secs, arrive_secs
    FROM (SELECT query_id, destination, round, 1 AS part, 'ride' AS mode, trip_id, board_stop AS from_stop,
                 alight_stop AS to_stop, board_dep_secs AS depart_secs, alight_secs AS arrive_secs
          FROM {tag}hops WHERE mode <> 'W'
          UNION ALL
          SELECT query_id, destination, round, 2, 'walk', trip_id, alight_stop, stop_id, alight_secs, arrival_secs
          FROM {tag}hops WHERE mode <> 'R')"""
    return views


def _arrivals(tag: str) -> str:
    return f"""
        SELECT query_id, stop_id, min(arrival_secs) AS arrival_secs, max(round) AS round FROM {tag}labels
        GROUP BY query_id, stop_id"""


def _best(tag: str, searches: str) -> str:
    """The legs of the three quickest journeys of each search."""
    return f"""
        SELECT l.query_id, CAST(r.rank AS INTEGER) AS rank, l.destination, r.minutes,
               CAST(r.rides AS INTEGER) AS rides, l.leg_no,
               CASE WHEN l.mode = 'walk' THEN 'Walk' ELSE t.trip_headsign END AS method,
               a.stop_name AS from_name, b.stop_name AS to_name
        FROM (SELECT f.query_id, f.stop_id, CAST((f.arrival_secs - s.departure_secs) // 60 AS INTEGER) AS minutes,
                     (SELECT count(*) FROM {tag}legs g WHERE g.query_id = f.query_id AND g.destination = f.stop_id
                      AND g.mode = 'ride') AS rides,
                     row_number() OVER (PARTITION BY f.query_id ORDER BY f.arrival_secs, f.stop_id) AS rank
              FROM {tag}final f JOIN {searches} s ON s.query_id = f.query_id WHERE f.round > 0) r
        JOIN {tag}legs l ON l.query_id = r.query_id AND l.destination = r.stop_id
        LEFT JOIN trips t ON t.trip_id = l.trip_id
        JOIN stops a ON a.stop_id = l.from_stop
        JOIN stops b ON b.stop_id = l.to_stop
        WHERE r.rank <= 3"""


def _matches(column: str, limit: int) -> str:
    """Stops whose name has the requested part, the shortest names first."""
    return f"""
        SELECT term, stop_id, stop_name FROM (
            SELECT t.term, s.stop_id, s.stop_name,
                   row_number() OVER (PARTITION BY t.term ORDER BY length(s.stop_name), s.stop_name) AS rank
            FROM (SELECT DISTINCT {column} AS term FROM requests) t
            JOIN served s ON contains(lower(s.stop_name), lower(t.term)))
        WHERE rank <= {limit}"""


_DAY = """CASE s_suppkey % 7 WHEN 0 THEN 'monday' WHEN 1 THEN 'tuesday' WHEN 2 THEN 'wednesday'
                    WHEN 3 THEN 'thursday' WHEN 4 THEN 'friday' WHEN 5 THEN 'saturday' ELSE 'sunday' END"""
_VIEWS |= _rounds("", "searches", "services") | _ways("", "destinations")
_VIEWS |= {
    "customer_searches": f"""
        SELECT s_suppkey AS query_id, CAST(s_suppkey % n AS VARCHAR) AS origin,
               CAST(21600 + (s_suppkey * 977) % 54000 AS INTEGER) AS departure_secs, {_DAY} AS day
        FROM (SELECT c_custkey AS s_suppkey FROM customer), (SELECT count(*) AS n FROM supplier)""",
    "customer_destinations": """
        SELECT c_custkey AS query_id, CAST((c_custkey * 31 + c_nationkey) % n AS VARCHAR) AS stop_id
        FROM customer, (SELECT count(*) AS n FROM supplier)
        UNION SELECT c_custkey, CAST((c_custkey * 7 + 3) % n AS VARCHAR)
        FROM customer, (SELECT count(*) AS n FROM supplier)""",
    "dated_searches": """
        SELECT s.query_id, s.origin, s.departure_secs, d.day FROM searches s
        JOIN (SELECT o_custkey % n AS query_id, strftime(max(o_orderdate), '%Y%m%d') AS day
              FROM orders, (SELECT count(*) AS n FROM supplier) GROUP BY 1) d ON d.query_id = s.query_id""",
    "dated_services": "SELECT service_date AS day, service_id FROM service_dates",
    "requests": f"""
        SELECT s_suppkey AS request_id, {_DAY} AS day, CAST(21600 + (s_suppkey * 977) % 54000 AS INTEGER) AS departure_secs,
               right(s_name, 4) AS origin, lpad(CAST((s_suppkey * 31 + 7) % n AS VARCHAR), 4, '0') AS destination
        FROM supplier, (SELECT count(*) AS n FROM supplier)""",
    "start_matches": _matches("origin", 3),
    "end_matches": _matches("destination", 10),
    "named_searches": """
        SELECT r.request_id || ' ' || m.stop_id AS query_id, r.request_id, m.stop_name AS origin_name, m.stop_id AS origin,
               r.departure_secs, r.day, r.destination
        FROM requests r JOIN start_matches m ON m.term = r.origin""",
    "named_destinations": """
        SELECT DISTINCT s.query_id, m.stop_id FROM named_searches s JOIN end_matches m ON m.term = s.destination""",
}
_VIEWS |= _rounds("customer_", "customer_searches", "services")
_VIEWS |= _rounds("dated_", "dated_searches", "dated_services")
_VIEWS |= _rounds("named_", "named_searches", "services") | _ways("named_", "named_destinations")

# Computed once although several later views read them.
_MATERIALIZED = re.compile(
    r"trips|exceptions|calls|kept|patterns|dated|served|all_transfers|moves|requests|service_dates|\w+_matches|"
    r"(\w+_)?(searches|destinations|rides_\d|labels_\d|known_\d|labels|hops|legs)|"
    r"fused|records|spread|timed|series|lags|supervised|ordinals|ranges|tails"
)

_FUSED = (
    "trip_id, stop_id, trip_date, arrival_delay, route_id, sch_arrival_time, sch_departure_time, stop_sequence, "
    "stop_name, stop_lat, stop_lon, arrival_time, departure_delay, departure_time"
)


def _latest(table: str, keys: str, rest: str) -> str:
    order = ", ".join(f"{column} DESC" for column in ["snapshot_ts", *rest.split(", ")] if column not in keys)
    return f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS place FROM {table})
        WHERE place = 1"""


_LATEST_ALERTS = _latest(
    "alerts", "alert_id, stop_id, route_id",
    "active_period_start, active_period_end, route_type, cause, effect, severity_level",
)
_KEYS = {
    "trips": ("rt_trips", "trip_id, snapshot_ts"),
    "stops": ("rt_stops", "stop_id, trip_id, stop_sequence, snapshot_ts"),
    "vehicles": ("rt_vehicles", "vehicle_id, trip_id, snapshot_ts"),
    "alerts": ("alerts", "alert_id, stop_id, route_id"),
}

_BODIES: dict[str, str] = {
    "services_by_day": """
        SELECT v.day, v.service_id, count(*) AS trips FROM services v JOIN trips t ON t.service_id = v.service_id
        GROUP BY v.day, v.service_id""",
    "services_by_date": "SELECT * FROM service_dates",
    "calendar_days": """
        SELECT strftime(d, '%Y%m%d') AS sch_date FROM (
            SELECT unnest(generate_series(min(strptime(start_date, '%Y%m%d')), max(strptime(start_date, '%Y%m%d')),
                                          INTERVAL 1 DAY)) AS d FROM trips)""",
    "trips_in_service": """
        SELECT trip_id, stop_id, stop_sequence FROM calls WHERE trip_id IN (
            SELECT trip_id FROM trips WHERE service_id IN (SELECT service_id FROM services WHERE day = 'saturday'))""",
    "stops_in_service": """
        SELECT DISTINCT v.day, s.stop_id, s.stop_name FROM dated c JOIN services v ON v.service_id = c.service_id
        JOIN stops s ON s.stop_id = c.stop_id""",
    "stop_times_same_day": "SELECT * FROM kept",
    "departure_window": "SELECT * FROM calls WHERE arr_secs >= 52200 AND arr_secs < 55800",
    "trip_patterns": "SELECT * FROM patterns",
    "trips_per_pattern": """
        SELECT route_id, min(trip_id) AS first_trip_id, count(*) AS trips, max(calls) AS calls
        FROM (SELECT t.trip_id, t.route_id, count(*) AS calls,
                     string_agg(k.stop_sequence || '@' || k.stop_id, ',' ORDER BY k.stop_sequence) AS sequence
              FROM trips t JOIN kept k ON k.trip_id = t.trip_id GROUP BY t.trip_id, t.route_id)
        GROUP BY route_id, sequence""",
    "trip_length": "SELECT trip_id, max(stop_sequence) AS last_sequence FROM calls GROUP BY trip_id",
    "route_direction_trips": """
        SELECT trip_id, route_id, direction_id, service_id FROM trips WHERE route_id = 'R7' AND direction_id = 1""",
    "static_schedule": "SELECT * FROM schedule",
    "schedule_round_trip": "SELECT * FROM schedule",
    "stored_days": """
        SELECT v.day, CAST(c.arr_secs // 3600 AS INTEGER) AS hour, count(*) AS calls, count(DISTINCT c.trip_id) AS trips,
               count(DISTINCT c.stop_id) AS stops
        FROM dated c JOIN services v ON v.service_id = c.service_id GROUP BY ALL""",
    "distinct_sequences": "SELECT DISTINCT stop_sequence FROM calls",
    "walking_transfers": """
        SELECT from_stop_id, to_stop_id, round(distance, 6) AS distance, round(distance / 1.4, 6) AS transfer_time
        FROM all_transfers""",
    "timetable_calls": """
        SELECT v.day, c.trip_id, c.stop_id, c.stop_sequence, c.arr_secs, c.dep_secs, c.pattern AS route_id
        FROM dated c JOIN services v ON v.service_id = c.service_id""",
    "timetable_transfers": """
        SELECT a.day, t.from_stop_id, t.to_stop_id, round(t.distance / 1.4, 6) AS transfer_time
        FROM all_transfers t
        JOIN (SELECT DISTINCT v.day, c.stop_id FROM dated c JOIN services v ON v.service_id = c.service_id) a
          ON a.stop_id = t.from_stop_id
        JOIN (SELECT DISTINCT v.day, c.stop_id FROM dated c JOIN services v ON v.service_id = c.service_id) b
          ON b.stop_id = t.to_stop_id AND b.day = a.day""",
    "scan_day_partition": """
        SELECT 'sunday' AS day, trip_id, stop_id, stop_sequence, arr_secs, dep_secs FROM dated
        WHERE service_id IN (SELECT service_id FROM services WHERE day = 'sunday')""",
    "boardable_calls": "SELECT query_id, trip_id, stop_id, stop_sequence, dep_secs FROM boardable_1",
    "earliest_trip_per_pattern": """
        SELECT query_id, pattern, dep_secs, trip_id, stop_sequence, stop_id FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id, pattern
                                         ORDER BY dep_secs, trip_id, stop_sequence, stop_id) AS place FROM boardable_1)
        WHERE place = 1""",
    "downstream_stops": "SELECT query_id, trip_id, board_stop, stop_id, arrival_secs FROM onward_1",
    "footpath_relax": """
        SELECT query_id, stop_id, arrival_secs, mode, trip_id, board_stop, alight_stop FROM first_moves
        WHERE mode <> 'R'""",
    "candidate_union": """
        SELECT query_id, stop_id, arrival_secs, mode, trip_id, board_stop, alight_stop FROM first_moves""",
    "earliest_arrivals": _arrivals(""),
    "arrivals_at_destinations": f"""
        SELECT a.* FROM ({_arrivals("customer_")}) a
        JOIN customer_destinations d ON d.query_id = a.query_id AND d.stop_id = a.stop_id""",
    "arrivals_by_date": _arrivals("dated_"),
    "reachable_by_round": "SELECT query_id, round, count(*) AS stops FROM labels GROUP BY query_id, round",
    "journey_legs": """
        SELECT query_id, destination AS stop_id, leg_no, mode, trip_id, from_stop, to_stop, depart_secs, arrive_secs
        FROM legs""",
    "journeys_to_destinations": """
        SELECT f.query_id, f.stop_id, CAST((f.arrival_secs - s.departure_secs) // 60 AS INTEGER) AS trip_time,
               f.round AS improved_round, coalesce(g.trip, '') AS trip,
               concat_ws('|', s.origin, g.hops) AS hops, concat_ws('|', o.stop_name, g.hop_names) AS hop_names
        FROM final f
        JOIN searches s ON s.query_id = f.query_id
        JOIN stops o ON o.stop_id = s.origin
        LEFT JOIN (SELECT l.query_id, l.destination,
                          string_agg(CASE WHEN l.mode = 'walk' THEN l.trip_id || 'W' ELSE l.trip_id END, '|' ORDER BY leg_no) AS trip,
                          string_agg(l.to_stop, '|' ORDER BY leg_no) AS hops,
                          string_agg(p.stop_name, '|' ORDER BY leg_no) AS hop_names
                   FROM legs l JOIN stops p ON p.stop_id = l.to_stop
                   GROUP BY l.query_id, l.destination) g
          ON g.query_id = f.query_id AND g.destination = f.stop_id""",
    "best_journeys": _best("", "searches"),
    "journeys_by_name": f"""
        SELECT s.request_id, s.origin_name, b.* EXCLUDE (query_id) FROM ({_best("named_", "named_searches")}) b
        JOIN named_searches s ON s.query_id = b.query_id""",
    "stop_search": """
        SELECT term_id, CAST(rank AS INTEGER) AS rank, stop_id, stop_name FROM (
            SELECT t.term_id, s.stop_id, s.stop_name,
                   row_number() OVER (PARTITION BY t.term_id ORDER BY length(s.stop_name), s.stop_name) AS rank
            FROM search_terms t JOIN stops s ON contains(lower(s.stop_name), lower(t.term)))
        WHERE rank <= 3""",
    "feed_json_flatten": "SELECT * FROM rt_stops",
    "feed_trip_rows": "SELECT * FROM rt_trips",
    "feed_vehicle_rows": """
        SELECT trip_id AS vehicle_id, trip_id, 'V' || trip_id AS vehicle_label, snapshot_ts FROM rt_stops""",
    "ingest_counts": """
        SELECT snapshot_ts, count(*) AS trips, count(*) AS stops, count(*) AS vehicles FROM rt_stops GROUP BY snapshot_ts""",
    "alert_entities": "SELECT * FROM alerts",
    "alert_ingest_counts": """
        SELECT snapshot_ts, count(*) AS alerts, 2 * count(*) AS informed, count(*) AS named
        FROM alerts GROUP BY snapshot_ts""",
    "rt_upsert_trips": _latest("rt_trips", "trip_id, snapshot_ts", "start_date, route_id, direction_id"),
    "rt_upsert_stops": _latest(
        "rt_stops", "stop_id, trip_id, stop_sequence, snapshot_ts",
        "arrival_delay, arrival_time, departure_delay, departure_time",
    ),
    "rt_upsert_vehicles": _latest("rt_vehicles", "vehicle_id, trip_id, snapshot_ts", "vehicle_label"),
    "alerts_upsert": _LATEST_ALERTS,
    "rt_upsert_batches": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY alert_id, stop_id, route_id
                ORDER BY snapshot_ts DESC, snapshot_ts % 86400 // 21600 DESC, active_period_start DESC, active_period_end DESC,
                         route_type DESC, cause DESC, effect DESC, severity_level DESC) AS place FROM alerts)
        WHERE place = 1""",
    "rt_dedup_batch": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY stop_id, trip_id, stop_sequence, snapshot_ts
                ORDER BY arrival_delay, arrival_time, departure_delay, departure_time) AS place FROM rt_stops)
        WHERE place = 1""",
    "key_violations": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS repeated_keys, CAST(coalesce(sum(copies), 0) AS BIGINT) AS row_count
        FROM (SELECT count(*) AS copies FROM {view} GROUP BY {keys} HAVING count(*) > 1)"""
        for name, (view, keys) in _KEYS.items()
    ),
    "rt_bottom_k_delay": """
        SELECT * FROM rt_stops
        ORDER BY arrival_delay, arrival_time, departure_delay, departure_time, snapshot_ts, stop_id, stop_sequence, trip_id
        LIMIT 10000""",
    "clean_sentinels": "SELECT * FROM rt_stops WHERE arrival_time <> -1",
    "fused_delays": "SELECT * FROM fused",
    "fused_max_delay": f"SELECT {_FUSED} FROM max_delay",
    "fused_route_compat": """
        SELECT f.* EXCLUDE (top) FROM (
            SELECT *, max(arrival_delay) OVER (PARTITION BY trip_id, stop_id, trip_date) AS top FROM (
                SELECT s.trip_id, s.stop_id,
                       strftime(make_timestamp(departure_time * 1000000), '%m-%d-%Y') AS trip_date,
                       r.arrival_delay, s.route_id, r.arrival_time - r.arrival_delay AS sch_arrival_time,
                       r.departure_time - r.departure_delay AS sch_departure_time, s.stop_sequence, s.stop_name,
                       s.stop_lat, s.stop_lon, r.departure_time AS arrival_time, r.departure_delay, r.departure_time
                FROM schedule s JOIN rt_stops r ON r.trip_id = s.trip_id AND r.stop_id = s.stop_id
                WHERE s.route_id = 'R7' AND s.direction_id = 1)) f
        WHERE arrival_delay = top""",
    "delay_by_stop": """
        SELECT stop_id, round(avg(departure_delay), 4) AS avg_departure_delay FROM max_delay GROUP BY stop_id""",
    "delay_by_stop_time": """
        SELECT stop_name, CAST(quarter(moment) AS INTEGER) AS quarter, CAST(month(moment) AS INTEGER) AS month,
               CAST(day(moment) AS INTEGER) AS day, CAST(hour(moment) AS INTEGER) AS hour,
               round(avg(arrival_delay), 4) AS avg_arrival_delay
        FROM (SELECT *, make_timestamp(sch_arrival_time * 1000000) AS moment FROM max_delay WHERE sch_arrival_time IS NOT NULL)
        GROUP BY ALL""",
    "delay_arrival_departure": """
        SELECT stop_name, round(avg(arrival_delay), 4) AS avg_arrival_delay,
               round(avg(departure_delay), 4) AS avg_departure_delay
        FROM max_delay GROUP BY stop_name""",
    "alerts_by_route": f"""
        SELECT a.route_id, r.route_long_name, max(r.route_short_name) AS route_short_name,
               count(*) AS alerts, min(a.severity_level) AS min_severity
        FROM ({_LATEST_ALERTS}) a JOIN routes r ON r.route_id = a.route_id
        WHERE r.route_long_name IS NOT NULL AND a.route_id IN (SELECT route_id FROM rt_trips)
        GROUP BY a.route_id, r.route_long_name""",
    "delay_by_route_direction": """
        SELECT t.route_id, t.direction_id, round(avg(r.departure_delay), 4) AS avg_departure_delay
        FROM rt_stops r JOIN trips t ON t.trip_id = r.trip_id GROUP BY t.route_id, t.direction_id""",
    "delay_outliers": """
        SELECT trip_id, stop_id, trip_date,
               round(CASE WHEN abs(arrival_delay - mid) > dev THEN mid ELSE arrival_delay END, 6) AS arrival_delay
        FROM records, spread""",
    "running_time": "SELECT trip_id, stop_id, trip_date, stop_sequence, arrival_time, running_time FROM timed",
    "lag_features": f"""
        SELECT trip_id, stop_id, trip_date, position, round(arrival_delay, 6) AS arrival_delay, {{columns}}
        FROM lags WHERE position > {_STEPS}""",
    "train_test_split": "SELECT trip_id, stop_id, trip_date, position, is_test FROM supervised",
    "minmax_scale": """
        SELECT trip_id, stop_id, trip_date, {scaled} FROM supervised, (
            SELECT {ranges} FROM supervised WHERE NOT is_test)""",
    "next_calls": """
        SELECT route_id, direction_id, trip_id, stop_sequence, stop_id,
               coalesce(lead(trip_id) OVER w, first_value(trip_id) OVER w) AS next_trip_id,
               coalesce(lead(stop_sequence) OVER w, first_value(stop_sequence) OVER w) AS next_stop_sequence,
               coalesce(lead(stop_id) OVER w, first_value(stop_id) OVER w) AS next_stop_id,
               coalesce(lead(sch_arrival_secs) OVER w, first_value(sch_arrival_secs) OVER w) AS next_arrival_secs
        FROM schedule
        WINDOW w AS (PARTITION BY route_id, direction_id ORDER BY CAST(trip_id AS BIGINT), stop_sequence)""",
}
_VIEWS["first_moves"] = "SELECT * FROM candidates_1"

# The given model of the forecast: weights of the oldest row first; delay, arrival time and running time of each.
_WEIGHTS = [w for step in range(_STEPS, 0, -1) for w in (0.5**step, 0.002, 0.05 / step)]
_LAGS = [f"{f}_{step}" for step in range(_STEPS, 0, -1) for f in ("arrival_delay", "arrival_time", "running_time")]


def _scale(value: str, feature: str) -> str:
    return f"(CAST({value} AS DOUBLE) - {feature}_lo) / ({feature}_hi - {feature}_lo)"


def _minutes(inputs: str) -> str:
    """The forecast of a list of scaled values."""
    weights = ", ".join(f"CAST({w!r} AS DOUBLE)" for w in _WEIGHTS)
    return (
        f"arrival_delay_lo + (0.01 + list_dot_product({inputs}, [{weights}])) * (arrival_delay_hi - arrival_delay_lo)"
    )


_VIEWS |= {
    "ranges": "SELECT "
    + ", ".join(
        f"CAST(min({f}) AS DOUBLE) AS {f}_lo, CAST(max({f}) AS DOUBLE) AS {f}_hi"
        for f in ("arrival_delay", "arrival_time", "running_time")
    )
    + " FROM supervised WHERE NOT is_test",
    "predicted": f"""
        SELECT s.*, {_minutes("[" + ", ".join(_scale(c, c.rsplit("_", 1)[0]) for c in _LAGS) + "]")} AS predicted
        FROM supervised s, ranges""",
    "ordinals": """
        SELECT *, row_number() OVER (PARTITION BY route_id, direction_id
                   ORDER BY CAST(trip_id AS BIGINT), stop_sequence, stop_id) AS ordinal,
               count(*) OVER (PARTITION BY route_id, direction_id) AS series_calls
        FROM schedule""",
    "tails": f"""
        SELECT route_id, direction_id, flatten(list([{", ".join(_scale(f, f) for f in ("arrival_delay", "arrival_time", "running_time"))}]
                   ORDER BY position)) AS inputs,
               arg_max(trip_id, position) AS trip_id, arg_max(stop_sequence, position) AS stop_sequence,
               arg_max(arrival_time, position) AS arrival_time, arg_max(sch_arrival_time, position) AS sch_arrival_time
        FROM (SELECT *, max(position) OVER (PARTITION BY route_id, direction_id) AS n FROM lags), ranges
        WHERE position > n - {_STEPS} GROUP BY route_id, direction_id HAVING count(*) = {_STEPS}""",
    "rolled": f"""
        SELECT t.route_id, t.direction_id, 0 AS step, t.inputs, CAST(t.arrival_time AS DOUBLE) AS arrival,
               o.sch_arrival_secs AS secs, t.sch_arrival_time - o.sch_arrival_secs AS day_start, o.ordinal, o.series_calls,
               CAST(NULL AS VARCHAR) AS trip_id, CAST(NULL AS VARCHAR) AS stop_name, CAST(NULL AS DOUBLE) AS delay
        FROM tails t JOIN ordinals o ON o.route_id = t.route_id AND o.direction_id = t.direction_id
          AND o.trip_id = t.trip_id AND o.stop_sequence = t.stop_sequence
        UNION ALL
        SELECT route_id, direction_id, step + 1,
               list_concat(inputs[4:], [{_scale("minutes", "arrival_delay")}, {_scale("day_start + secs + minutes * 60", "arrival_time")},
                                        {_scale("day_start + secs + minutes * 60 - arrival", "running_time")}]),
               day_start + secs + minutes * 60, secs, day_start, ordinal, series_calls, trip_id, stop_name, minutes
        FROM (SELECT r.route_id, r.direction_id, r.step, r.inputs, r.arrival, n.sch_arrival_secs AS secs,
                     r.day_start + CASE WHEN n.sch_arrival_secs < r.secs THEN 86400 ELSE 0 END AS day_start,
                     n.ordinal, r.series_calls, n.trip_id, n.stop_name, {_minutes("r.inputs")} AS minutes
              FROM rolled r JOIN ordinals n ON n.route_id = r.route_id AND n.direction_id = r.direction_id
                AND n.ordinal = r.ordinal % r.series_calls + 1, ranges
              WHERE r.step < 20), ranges""",
}
_BODIES["forecast_mae"] = """
    SELECT count(*) AS rows, round(avg(abs(arrival_delay - predicted)), 6) AS mae,
           round(avg(abs(arrival_delay - mean)), 6) AS mean_mae
    FROM predicted, (SELECT avg(arrival_delay) AS mean FROM supervised WHERE NOT is_test) WHERE is_test"""
_BODIES["forecast_next_stops"] = """
    SELECT r.route_id, r.direction_id, r.step, r.stop_name, t.trip_headsign AS trip_name, round(r.delay, 4) AS delay,
           strftime(make_timestamp(CAST((r.day_start + r.secs) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS scheduled_time
    FROM rolled r JOIN trips t ON t.trip_id = r.trip_id WHERE r.step > 0"""
_BODIES["lag_features"] = _BODIES["lag_features"].format(
    columns=", ".join(
        [f"round(arrival_delay_{i}, 6) AS arrival_delay_{i}" for i in range(1, _STEPS + 1)]
        + [f"{f}_{i}" for f in ("arrival_time", "running_time") for i in range(1, _STEPS + 1)]
    )
)
_FEATURES = ("arrival_delay", "arrival_time", "running_time")
_BODIES["minmax_scale"] = _BODIES["minmax_scale"].format(
    scaled=", ".join(
        f"round(CAST({f} - {f}_lo AS DOUBLE) / ({f}_hi - {f}_lo), 6) AS {f}_scaled" for f in _FEATURES
    ),
    ranges=", ".join(f"min({f}) AS {f}_lo, max({f}) AS {f}_hi" for f in _FEATURES),
)


def _uses(sql: str) -> set[str]:
    return {name for name in _VIEWS if re.search(rf"(?<![\w.']){name}(?![\w.'])", sql)}


def _with_views(body: str) -> str:
    """The query preceded by the views it needs, each after those it reads."""
    ordered: list[str] = []

    def add(sql: str) -> None:
        for name in sorted(_uses(sql)):
            if name not in ordered and _VIEWS[name] is not sql:
                add(_VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    add(body)
    parts = [
        f"{name} AS {'MATERIALIZED ' if _MATERIALIZED.fullmatch(name) else ''}({_VIEWS[name]})" for name in ordered
    ]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(body) for name, body in _BODIES.items()}
