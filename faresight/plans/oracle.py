"""Independent SQL (DuckDB dialect) for every registered query.

DuckDB only has the raw test tables, so the fare-domain views are inlined as CTEs written from the
derivation rules in :mod:`faresight.sources.fixtures`. Timestamps are UTC wall-clock values;
``timezone(zone, timezone('UTC', ts))`` gives the wall-clock time in ``zone``.
"""

from __future__ import annotations

D = "2024-01-28"

_VIEWS = [
    ("airport_info", """
    SELECT 'A' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS airport_code,
           n.n_name AS name, r.r_name AS country,
           CASE n.n_nationkey % 5 WHEN 0 THEN 'Asia/Seoul' WHEN 1 THEN 'Asia/Tokyo'
                WHEN 2 THEN 'Europe/Paris' WHEN 3 THEN 'America/New_York'
                ELSE 'America/Los_Angeles' END AS time_zone
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    ("flight_info", """
    SELECT 'F' || CAST(o.o_orderkey AS VARCHAR) AS air_id,
           CASE WHEN o.o_orderkey % 13 <> 0 THEN o.o_orderkey % 5 = 0 END AS is_layover,
           'A' || lpad(CAST(c.c_nationkey % 4 AS VARCHAR), 2, '0') AS depart_airport,
           CASE WHEN c.c_custkey % 29 = 0 THEN 'A98'
                WHEN c.c_custkey % 9 = 0 THEN 'A' || lpad(CAST(c.c_custkey % 3 AS VARCHAR), 2, '0')
                ELSE 'A' || lpad(CAST(3 + c.c_custkey % 5 AS VARCHAR), 2, '0') END AS arrival_airport,
           CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
                ELSE 'AL' || CAST(o.o_orderkey % 4 AS VARCHAR) END AS airline,
           TIMESTAMP '2024-01-20 00:00:00' + to_hours(CAST(o.o_orderkey % 480 AS BIGINT))
               AS depart_timestamp,
           TIMESTAMP '2024-01-20 00:00:00'
               + to_hours(CAST(o.o_orderkey % 480 + 1 + o.o_orderkey % 11 AS BIGINT)) AS arrival_timestamp,
           CAST(60 * (1 + o.o_orderkey % 11) AS INTEGER) AS journey_time
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""),
    ("fare_raw", """
    SELECT f.air_id,
           CASE l.l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'C' ELSE 'F' END AS seat_class,
           CASE WHEN l.l_partkey % 83 <> 0 THEN 'AGT' || CAST(l.l_suppkey % 2 AS VARCHAR) END AS agt_code,
           CASE WHEN l.l_partkey % 53 <> 0 THEN CAST(floor(l.l_extendedprice) AS INTEGER) END AS adult_fare,
           CASE WHEN l.l_partkey % 89 <> 0
                THEN CAST(f.depart_timestamp AS DATE) + CAST(2 - l.l_partkey % 15 AS INTEGER) END AS fetched_date,
           l.l_linestatus AS fare_class,
           ((l.l_orderkey * 8 + l.l_linenumber) * 100000 + l.l_partkey) * 10000 + l.l_suppkey AS batch_id,
           l.l_linenumber AS ln
    FROM lineitem l JOIN flight_info f ON f.air_id = 'F' || CAST(l.l_orderkey AS VARCHAR)"""),
    ("fare_info", """
    SELECT air_id, seat_class, agt_code, adult_fare, fetched_date, fare_class FROM (
        SELECT *, row_number() OVER (PARTITION BY air_id, seat_class, agt_code, fetched_date, fare_class
                                     ORDER BY batch_id DESC, adult_fare DESC NULLS LAST) AS rn
        FROM fare_raw WHERE ln <= 4) WHERE rn = 1 OR agt_code IS NULL OR fetched_date IS NULL"""),
    ("temp_fare_info", """
    SELECT batch_id, air_id, seat_class, agt_code, adult_fare, fetched_date, fare_class
    FROM fare_raw WHERE ln >= 4"""),
    ("layover_info", """
    SELECT 'F' || CAST(o.o_orderkey AS VARCHAR) AS air_id,
           'F' || CAST(o.o_orderkey + k.k AS VARCHAR) AS segment_id,
           CAST(k.k AS INTEGER) AS layover_order,
           CASE WHEN k.k = 2 THEN NULL ELSE CAST(30 + o.o_orderkey % 90 AS INTEGER) END AS connect_time
    FROM orders o, (VALUES (1), (2)) k(k) WHERE o.o_orderkey % 5 = 0"""),
    ("routes", """
    SELECT d.airport_code AS depart_airport, a.airport_code AS arrival_airport
    FROM airport_info d, airport_info a
    WHERE d.airport_code IN ('A00', 'A01', 'A02') AND a.airport_code IN ('A03', 'A04', 'A05', 'A06')
    UNION
    SELECT a.airport_code, d.airport_code
    FROM airport_info d, airport_info a
    WHERE d.airport_code IN ('A00', 'A01', 'A02') AND a.airport_code IN ('A03', 'A04', 'A05', 'A06')"""),
]


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = _VIEWS + list(extra or [])
    return "WITH " + ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes) + "\n" + body


# Archive frame over all routes and local departure days (one row per fare of a routed flight).
_EXPIRED = ("expired", f"""
    SELECT fi.air_id, fi.is_layover,
           fi.depart_airport || '_' || fi.arrival_airport AS route_key,
           CAST(timezone('Asia/Seoul', timezone('UTC', fi.depart_timestamp)) AS DATE) AS window_date,
           dep.airport_code AS "airport_code(dep)", dep.name AS depart_airport,
           dep.country AS depart_country,
           arr.airport_code AS "airport_code(arr)", arr.name AS arrival_airport,
           arr.country AS arrival_country,
           fi.airline,
           fi.depart_timestamp AS "depart_time(utc)", fi.arrival_timestamp AS "arrival_time(utc)",
           timezone(dep.time_zone, timezone('UTC', fi.depart_timestamp)) AS "depart_time(dep)",
           timezone(dep.time_zone, timezone('UTC', fi.arrival_timestamp)) AS "arrival_time(dep)",
           timezone(arr.time_zone, timezone('UTC', fi.depart_timestamp)) AS "depart_time(arr)",
           timezone(arr.time_zone, timezone('UTC', fi.arrival_timestamp)) AS "arrival_time(arr)",
           fa.seat_class, fa.agt_code, fa.adult_fare AS fare, fa.fare_class, fi.journey_time,
           fa.fetched_date,
           CAST(timezone(dep.time_zone, timezone('UTC', fi.depart_timestamp)) AS DATE) AS depart_date
    FROM flight_info fi
    JOIN routes r ON fi.depart_airport = r.depart_airport AND fi.arrival_airport = r.arrival_airport
    JOIN airport_info dep ON fi.depart_airport = dep.airport_code
    JOIN airport_info arr ON fi.arrival_airport = arr.airport_code
    JOIN fare_info fa ON fi.air_id = fa.air_id""")

_FLIGHTS = ("flights", """
    SELECT air_id, route_key, window_date,
           strftime(min("depart_time(utc)"), '%Y-%m-%d %H:%M:%S') AS "depart_time(utc)",
           strftime(min("depart_time(dep)"), '%Y-%m-%d %H:%M:%S') AS "depart_time(dep)",
           strftime(min("arrival_time(utc)"), '%Y-%m-%d %H:%M:%S') AS "arrival_time(utc)",
           strftime(min("arrival_time(arr)"), '%Y-%m-%d %H:%M:%S') AS "arrival_time(arr)",
           min("airport_code(dep)") AS depart_airport, min("airport_code(arr)") AS arrival_airport,
           CASE bool_and(is_layover) WHEN true THEN 'True' WHEN false THEN 'False' END AS is_layover,
           min(journey_time) AS journey_time
    FROM expired GROUP BY air_id, route_key, window_date""")

_FRAME = ("frame", """
    SELECT route_key, window_date, max(fetched_date) AS max_fetched FROM expired GROUP BY ALL""")

_OFFERS = ("offers", """
    SELECT e.air_id, e.route_key, e.window_date, e.seat_class, e.airline, e.agt_code, e.fare_class,
           e.seat_class || '.' || e.airline || '.' || e.agt_code || '.' || e.fare_class AS option_id,
           min(e.fetched_date) AS first_date, min(e.depart_date) AS dep_date,
           least(min(e.depart_date), min(fr.max_fetched) + 1) AS end_date
    FROM expired e JOIN frame fr ON e.route_key = fr.route_key AND e.window_date = fr.window_date
    WHERE e.seat_class IS NOT NULL AND e.airline IS NOT NULL AND e.agt_code IS NOT NULL
      AND e.fare_class IS NOT NULL
    GROUP BY ALL""")

_DAYS = ("days", """
    SELECT o.*, CAST(unnest(generate_series(CAST(o.first_date AS TIMESTAMP),
                                            CAST(o.end_date - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
               AS collected
    FROM offers o WHERE o.first_date < o.end_date""")

_HISTORY = ("history", """
    SELECT d.air_id, d.route_key, d.window_date, d.option_id, d.collected,
           strftime(d.collected, '%Y-%m-%d') AS collected_date,
           ['월', '화', '수', '목', '금', '토', '일'][isodow(d.collected)] AS collected_day,
           CAST(d.dep_date - d.collected AS INTEGER) AS days_to_departure,
           e.fare AS price, e.air_id IS NOT NULL AS is_available
    FROM days d LEFT JOIN expired e
      ON e.air_id = d.air_id AND e.seat_class = d.seat_class AND e.airline = d.airline
     AND e.agt_code = d.agt_code AND e.fare_class = d.fare_class AND e.fetched_date = d.collected""")

# Flights with both airports known: their zones and the departure as it reads on the clock there.
_KNOWN = ("known", """
    SELECT fl.*, d.time_zone AS dep_zone, a.time_zone AS arr_zone,
           timezone(d.time_zone, timezone('UTC', fl.depart_timestamp)) AS local_departure
    FROM flight_info fl
    JOIN airport_info d ON d.airport_code = fl.depart_airport
    JOIN airport_info a ON a.airport_code = fl.arrival_airport""")

_LEGS = ("legs", """
    WITH wanted AS (SELECT DISTINCT air_id FROM expired WHERE is_layover),
    instants AS (
        SELECT lo.air_id, lo.segment_id, lo.layover_order, lo.connect_time, k.airline, k.depart_airport,
               k.arrival_airport, k.journey_time, k.dep_zone, k.arr_zone, k.depart_timestamp, k.arrival_timestamp,
               timezone('UTC', k.depart_timestamp) AS left_at, timezone('UTC', k.arrival_timestamp) AS came_at
        FROM layover_info lo SEMI JOIN wanted w ON w.air_id = lo.air_id JOIN known k ON k.air_id = lo.segment_id)
    SELECT air_id, segment_id, layover_order, connect_time, airline AS segment_airline,
           depart_airport AS segment_depart, arrival_airport AS segment_arrival,
           depart_timestamp AS segment_depart_time_utc, arrival_timestamp AS segment_arrival_time_utc,
           timezone(dep_zone, left_at) AS segment_depart_time_in_dep, timezone(dep_zone, came_at) AS segment_arrival_time_in_dep,
           timezone(arr_zone, left_at) AS segment_depart_time_in_arr, timezone(arr_zone, came_at) AS segment_arrival_time_in_arr,
           journey_time AS segment_duration
    FROM instants""")


def _agg_sql(source: str, where: str) -> str:
    return f"""
    WITH known AS ({_KNOWN[1]}),
    per_flight AS (
        SELECT air_id, is_layover, coalesce(airline, 'airline 여러개') AS airline,
               concat(depart_airport, '_', arrival_airport) AS route_key, CAST(year(local_departure) AS INTEGER) AS depart_year,
               CAST(month(local_departure) AS INTEGER) AS depart_month, CAST(day(local_departure) AS INTEGER) AS depart_day
        FROM known)
    SELECT p.* EXCLUDE (air_id), o.seat_class, o.fare_class, o.fetched_date, avg(o.adult_fare) AS mean_price,
           CAST(quantile_cont(o.adult_fare, 0.5) AS DOUBLE) AS median_price, count(*) AS ticket_count
    FROM {source} o JOIN per_flight p USING (air_id) {where}
    GROUP BY ALL"""


_ROUND_AGG = """SELECT route_key, depart_year, depart_month, depart_day, is_layover, airline, seat_class,
       fare_class, fetched_date, round(mean_price, 4) AS mean_price, round(median_price, 4) AS median_price,
       ticket_count FROM {src}"""

_UPSERTED = ("upserted", """
    SELECT * FROM agg_current c
    WHERE NOT EXISTS (SELECT 1 FROM agg_new n WHERE n.route_key = c.route_key
        AND n.depart_year = c.depart_year AND n.depart_month = c.depart_month
        AND n.depart_day = c.depart_day AND n.is_layover = c.is_layover AND n.airline = c.airline
        AND n.seat_class = c.seat_class AND n.fare_class = c.fare_class AND n.fetched_date = c.fetched_date)
    UNION ALL SELECT * FROM agg_new""")

_LATEST = ("latest", """
    SELECT air_id, seat_class, agt_code, adult_fare, fetched_date, fare_class FROM (
        SELECT *, row_number() OVER (PARTITION BY air_id, seat_class, agt_code, fetched_date, fare_class
                                     ORDER BY batch_id DESC, adult_fare DESC NULLS LAST) AS rn
        FROM temp_fare_info {where}) WHERE rn = 1 OR agt_code IS NULL OR fetched_date IS NULL""")


_MIGRATED = """
    SELECT f.* FROM fare_info f ANTI JOIN latest t USING (air_id, seat_class, agt_code, fetched_date, fare_class)
    UNION ALL SELECT * FROM latest"""


def _fare_upsert_sql(where: str) -> str:
    return with_views(_MIGRATED, [(_LATEST[0], _LATEST[1].format(where=where))])


_DEPARTED = ("departed", """
    SELECT air_id FROM flight_info
    WHERE depart_timestamp >= TIMESTAMP '2024-01-27 15:00:00' AND depart_timestamp < TIMESTAMP '2024-01-28 15:00:00'""")

_BOUNDS_WHERE = f"""WHERE batch_id BETWEEN
    (SELECT min(batch_id) FROM temp_fare_info WHERE fetched_date = DATE '{D}')
    AND (SELECT max(batch_id) FROM temp_fare_info WHERE fetched_date = DATE '{D}')"""

ORACLE: dict[str, str] = {
    "fare_daily_agg": with_views(_ROUND_AGG.format(src="agg"), [
        ("agg", _agg_sql("temp_fare_info", f"WHERE fetched_date = DATE '{D}'"))]),
    "fare_daily_agg_all": with_views(_ROUND_AGG.format(src="agg"), [
        ("agg", _agg_sql("temp_fare_info", ""))]),
    "agg_upsert": with_views(_ROUND_AGG.format(src="upserted"), [
        ("agg_current", _agg_sql("fare_info", "")),
        ("agg_new", _agg_sql("temp_fare_info", f"WHERE fetched_date = DATE '{D}'")),
        _UPSERTED]),
    "agg_retention": with_views(_ROUND_AGG.format(src="kept"), [
        ("agg_current", _agg_sql("fare_info", "")),
        ("agg_new", _agg_sql("temp_fare_info", f"WHERE fetched_date = DATE '{D}'")),
        _UPSERTED,
        ("kept", f"""SELECT * FROM upserted
                     WHERE NOT coalesce(fetched_date <= DATE '{D}' - INTERVAL 2 DAY, false)""")]),
    "batch_bounds": with_views(f"""
    SELECT min(batch_id) AS min_batch_id, max(batch_id) AS max_batch_id
    FROM temp_fare_info WHERE fetched_date = DATE '{D}'"""),
    "fare_latest": with_views("SELECT * FROM latest", [(_LATEST[0], _LATEST[1].format(where=""))]),
    "fare_upsert": _fare_upsert_sql(""),
    "fare_migrate": _fare_upsert_sql(_BOUNDS_WHERE),
    "landing_purge": with_views(f"""
    SELECT * FROM temp_fare_info WHERE NOT coalesce(fetched_date = DATE '{D}', false)"""),
    "expired_delete": with_views("""
    SELECT * FROM flight_info
    WHERE NOT coalesce(depart_timestamp >= TIMESTAMP '2024-01-27 15:00:00'
                       AND depart_timestamp < TIMESTAMP '2024-01-28 15:00:00', false)"""),
    "routes": with_views("SELECT depart_airport, arrival_airport FROM routes"),
    "business_date": with_views("""
    SELECT event_id,
           CAST(timezone('Asia/Seoul', timezone('UTC', ts + INTERVAL 1 DAY)) AS DATE) AS business_date
    FROM events"""),
    "flights_in_window": with_views("""
    SELECT fi.*, fi.depart_airport || '_' || fi.arrival_airport AS route_key,
           CAST(timezone('Asia/Seoul', timezone('UTC', fi.depart_timestamp)) AS DATE) AS window_date
    FROM flight_info fi
    JOIN routes r ON fi.depart_airport = r.depart_airport AND fi.arrival_airport = r.arrival_airport"""),
    "flights_in_day": with_views("""
    SELECT fi.*, fi.depart_airport || '_' || fi.arrival_airport AS route_key,
           CAST(timezone('Asia/Seoul', timezone('UTC', fi.depart_timestamp)) AS DATE) AS window_date
    FROM flight_info fi
    JOIN routes r ON fi.depart_airport = r.depart_airport AND fi.arrival_airport = r.arrival_airport
    WHERE fi.depart_timestamp >= TIMESTAMP '2024-01-27 15:00:00'
      AND fi.depart_timestamp < TIMESTAMP '2024-01-28 15:00:00'"""),
    "expired_fares": with_views("SELECT * FROM expired", [_EXPIRED]),
    "archive_flights": with_views("SELECT * FROM flights", [_EXPIRED, _FLIGHTS]),
    "archive_options": with_views("""
    SELECT air_id, route_key, window_date, option_id, seat_class, airline, agt_code, fare_class,
           first_date, dep_date, end_date FROM offers""", [_EXPIRED, _FRAME, _OFFERS]),
    "price_history": with_views("""
    SELECT air_id, route_key, window_date, option_id, collected_date, collected_day, days_to_departure,
           price, is_available FROM history""", [_EXPIRED, _FRAME, _OFFERS, _DAYS, _HISTORY]),
    "price_history_doc": with_views("""
    SELECT o.air_id, o.route_key, o.window_date, o.option_id, o.seat_class, o.airline, o.agt_code AS agency, o.fare_class,
           h.collected_date, h.collected_day, h.days_to_departure, h.price, h.is_available
    FROM offers o LEFT JOIN history h ON o.air_id = h.air_id AND o.option_id = h.option_id""",
        [_EXPIRED, _FRAME, _OFFERS, _DAYS, _HISTORY]),
    "layover_segments": with_views("SELECT * FROM legs", [_EXPIRED, _KNOWN, _LEGS]),
    "layover_doc": with_views("""
    SELECT air_id, CAST(row_number() OVER (PARTITION BY air_id ORDER BY layover_order) AS INTEGER) AS place, segment_id,
           layover_order AS segment_order, connect_time, segment_airline AS airline, segment_depart AS "from", segment_arrival AS "to",
           strftime(segment_depart_time_utc, '%Y-%m-%d %H:%M:%S') AS depart_time_utc,
           strftime(segment_arrival_time_utc, '%Y-%m-%d %H:%M:%S') AS arrival_time_utc, segment_duration AS duration
    FROM legs""", [_EXPIRED, _KNOWN, _LEGS]),
    "archive_sink": with_views("""
    SELECT f.air_id, f.route_key, f.window_date, f."depart_time(utc)" AS dep_utc, f."depart_time(dep)" AS dep_local,
           f."arrival_time(utc)" AS arr_utc, f."arrival_time(arr)" AS arr_local, f.depart_airport AS dep_code, f.arrival_airport AS arr_code,
           f.is_layover AS layover, f.journey_time AS journey, p.option_id, p.seat_class, p.airline, p.agency, p.fare_class,
           p.collected_date, p.collected_day, p.days_to_departure, p.price, p.is_available, coalesce(l.legs, '-') AS legs
    FROM flights f
    LEFT JOIN (SELECT o.air_id, o.option_id, o.seat_class, o.airline, o.agt_code AS agency, o.fare_class, h.collected_date,
                      h.collected_day, h.days_to_departure, h.price, h.is_available
               FROM offers o LEFT JOIN history h ON o.air_id = h.air_id AND o.option_id = h.option_id) p ON p.air_id = f.air_id
    LEFT JOIN (SELECT air_id, string_agg(concat_ws('|', segment_id, layover_order, coalesce(CAST(connect_time AS VARCHAR), 'null'),
                      coalesce(segment_airline, 'null'), segment_depart, segment_arrival, strftime(segment_depart_time_utc, '%Y-%m-%d %H:%M:%S'),
                      strftime(segment_arrival_time_utc, '%Y-%m-%d %H:%M:%S'), segment_duration), ';' ORDER BY layover_order) AS legs
               FROM legs GROUP BY air_id) l ON l.air_id = f.air_id""",
        [_EXPIRED, _FLIGHTS, _FRAME, _OFFERS, _DAYS, _HISTORY, _KNOWN, _LEGS]),
    "archive_text": with_views("""
    SELECT f.air_id, '{"air_id":"' || f.air_id || '","flight":{"depart_time(utc)":"' || f."depart_time(utc)" || '"' AS begins,
           coalesce(p.unpriced, 0) AS null_prices, coalesce(l.direct, 0) AS null_connections, f.is_layover IS NULL AS null_flag,
           l.air_id IS NULL AS null_legs
    FROM flights f
    LEFT JOIN (SELECT air_id, count(*) - count(price) AS unpriced FROM history GROUP BY air_id) p ON p.air_id = f.air_id
    LEFT JOIN (SELECT air_id, count(*) - count(connect_time) AS direct FROM legs GROUP BY air_id) l ON l.air_id = f.air_id""",
        [_EXPIRED, _FLIGHTS, _FRAME, _OFFERS, _DAYS, _HISTORY, _KNOWN, _LEGS]),
    "stream_ingest": with_views("SELECT * FROM temp_fare_info"),
    "landing_lifecycle": with_views(f"""
    SELECT 'landing' AS part, batch_id, air_id, seat_class, agt_code, adult_fare, fetched_date, fare_class
    FROM temp_fare_info WHERE fetched_date IS DISTINCT FROM DATE '{D}'
    UNION ALL SELECT 'fares', NULL, * FROM migrated
    UNION ALL SELECT 'upserted', (SELECT count(*) FROM latest), NULL, NULL, NULL, NULL, NULL, NULL
    UNION ALL SELECT 'purged', (SELECT count(*) FROM temp_fare_info WHERE fetched_date = DATE '{D}'), NULL, NULL, NULL, NULL, NULL, NULL""",
        [(_LATEST[0], _LATEST[1].format(where=_BOUNDS_WHERE)), ("migrated", _MIGRATED)]),
    # One row in five lands after the migration, whose bounds are those of the rows that it saw.
    "landing_race": with_views(f"""
    SELECT 'landing' AS part, batch_id, air_id, seat_class, agt_code, adult_fare, fetched_date, fare_class
    FROM temp_fare_info WHERE fetched_date IS DISTINCT FROM DATE '{D}' OR batch_id % 5 = 2
    UNION ALL SELECT 'fares', NULL, * FROM migrated
    UNION ALL SELECT 'upserted', (SELECT count(*) FROM latest), NULL, NULL, NULL, NULL, NULL, NULL
    UNION ALL SELECT 'purged', (SELECT count(*) FROM early WHERE fetched_date = DATE '{D}'), NULL, NULL, NULL, NULL, NULL, NULL
    UNION ALL SELECT 'purged again', 0, NULL, NULL, NULL, NULL, NULL, NULL""",
        [("early", "SELECT * FROM temp_fare_info WHERE batch_id % 5 <> 2"),
         (_LATEST[0], _LATEST[1].replace("temp_fare_info", "early").format(where=_BOUNDS_WHERE.replace("temp_fare_info", "early"))), ("migrated", _MIGRATED)]),
    "expired_delete_resumed": with_views("""
    SELECT s.interrupted, (SELECT count(*) FROM departed) AS removed, true AS same_counts, f.*
    FROM (SELECT * FROM flight_info f ANTI JOIN departed d ON d.air_id = f.air_id) f,
         (VALUES ('written 1'), ('noted 1'), ('moved 1'), ('moved 2'), ('marked 1')) s(interrupted)""", [_DEPARTED]),
    # The second merge finds no landing rows of the run date, so it aggregates, migrates and removes nothing more.
    "job_counts": with_views(f"""
    SELECT * FROM (
    SELECT 'archive' AS job, unnest(['documents', 'scanned', 'removed', 'undecided', 'kept', 'removed unarchived']) AS counted,
           unnest([documents, scanned, removed, 0, scanned - removed, removed - documents]) AS n
    FROM (SELECT (SELECT count(*) FROM flight_info) AS scanned, (SELECT count(*) FROM departed) AS removed,
                 (SELECT count(DISTINCT e.air_id) FROM expired e SEMI JOIN departed d ON d.air_id = e.air_id) AS documents)
    UNION ALL SELECT 'merge 1', 'agg_upserted', (SELECT count(*) FROM agg_new)
    UNION ALL SELECT 'merge 1', 'agg_removed', (SELECT count(*) FROM upserted WHERE fetched_date <= DATE '{D}' - INTERVAL 2 DAY)
    UNION ALL SELECT 'merge 1', 'fare_upserted', (SELECT count(*) FROM latest)
    UNION ALL SELECT 'merge 1', 'landing_removed', (SELECT count(*) FROM temp_fare_info WHERE fetched_date = DATE '{D}')
    UNION ALL SELECT 'merge 2', unnest(['agg_upserted', 'agg_removed', 'fare_upserted', 'landing_removed']), 0)""", [
        _DEPARTED, _EXPIRED, ("agg_current", _agg_sql("fare_info", "")), ("agg_new", _agg_sql("temp_fare_info", f"WHERE fetched_date = DATE '{D}'")),
        _UPSERTED, (_LATEST[0], _LATEST[1].format(where=_BOUNDS_WHERE))]),
    "layover_listing": with_views("""
    SELECT row_number() OVER (ORDER BY air_id, layover_order) AS position, air_id, layover_order, segment_id FROM legs""", [_EXPIRED, _KNOWN, _LEGS]),
    "business_date_text": """
    SELECT event_id, CASE WHEN event_id % 8 < 4 THEN CAST(timezone('Asia/Seoul', timezone('UTC', ts + INTERVAL 1 DAY)) AS DATE)
                          WHEN event_id % 8 = 4 THEN CAST(ts AS DATE) + 1 END AS business_date
    FROM events""",
    "stream_idle_stop": with_views("SELECT * FROM temp_fare_info"),
    "stream_restart": with_views("SELECT *, '0,1,1,2' AS epochs_written, true AS committed FROM temp_fare_info"),
}
ORACLE["route_documents"] = ORACLE["archive_sink"]
