"""The same queries in DuckDB SQL, stated independently where SQL allows it."""

from __future__ import annotations

POSITIONS = """positions AS (
  SELECT CAST(user_id AS VARCHAR) AS uuid, CAST(floor(epoch(ts)) AS BIGINT) AS tick,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS edge_id
  FROM events)"""

LENGTHS = """lengths AS (
  SELECT p_partkey AS edge_id, p_retailprice AS length FROM part WHERE p_size <= 40)"""

SPEEDS = f"""{POSITIONS}, {LENGTHS},
paired AS (
  SELECT uuid, tick, edge_id,
         tick - lag(tick) OVER (PARTITION BY uuid ORDER BY tick, edge_id) AS tick_diff
  FROM positions),
speeds AS (
  SELECT p.uuid, p.tick, p.edge_id, l.length, p.tick_diff, l.length / p.tick_diff AS kmh
  FROM paired p LEFT JOIN lengths l ON l.edge_id = p.edge_id
  WHERE p.tick_diff > 0)"""


def _bounds(source: str, keys: str, value: str, name: str) -> str:
    """CTE `name`: n, mean, median, mad and thresholds of `value` per key."""
    same = " AND ".join(f"s.{k.strip()} = m.{k.strip()}" for k in keys.split(","))
    own = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""{name}_mid AS (
  SELECT {keys}, count({value}) AS n, avg({value}) AS mean, median({value}) AS median
  FROM {source} GROUP BY {keys}),
{name}_dev AS (
  SELECT {own}, any_value(m.n) AS n, any_value(m.mean) AS mean, any_value(m.median) AS median,
         1.4826 * median(abs(s.{value} - m.median)) AS mad
  FROM {source} s JOIN {name}_mid m ON {same} GROUP BY {own}),
{name} AS (
  SELECT *, median + 3 * mad AS upper_threshold, median - 3 * mad AS lower_threshold
  FROM {name}_dev)"""


ROUNDED_BOUNDS = """n, round(mean, 9) AS mean, round(median, 9) AS median, round(mad, 9) AS mad,
  round(upper_threshold, 9) AS upper_threshold, round(lower_threshold, 9) AS lower_threshold"""

OBSERVED = """observed AS (
  SELECT event_id, event_type, user_id AS edge_id, 500 - value AS avg_speed FROM events)"""

# The rule step by step: one row of a vehicle after the other.
ACCEPTED = f"""WITH RECURSIVE {LENGTHS},
arrivals AS (
  SELECT CAST(user_id AS VARCHAR) AS uuid, CAST(floor(epoch(ts)) AS BIGINT) AS tick,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS edge_id,
         ((event_id * 37) % 101) * 1099511627776 + event_id AS seq
  FROM events),
numbered AS (
  SELECT a.*, l.length, row_number() OVER (PARTITION BY uuid ORDER BY seq) AS nr
  FROM arrivals a LEFT JOIN lengths l ON l.edge_id = a.edge_id),
walk AS (
  SELECT uuid, nr, seq, tick, edge_id, length, CAST(NULL AS BIGINT) AS held, tick AS kept
  FROM numbered WHERE nr = 1
  UNION ALL
  SELECT n.uuid, n.nr, n.seq, n.tick, n.edge_id, n.length, w.kept,
         CASE WHEN n.tick > w.kept AND n.length IS NULL THEN w.kept ELSE n.tick END
  FROM walk w JOIN numbered n ON n.uuid = w.uuid AND n.nr = w.nr + 1),
accepted AS (
  SELECT uuid, seq, tick, edge_id, length / (tick - held) AS avg_speed
  FROM walk WHERE tick > held AND length IS NOT NULL)"""



def _placed(source: str, key: str, name: str, per_tile: int, east: int, north: int) -> str:
    return f"""{name} AS (
  SELECT {key} AS node_id,
         CAST(2817000 + 12000 * (({key} // {per_tile}) % 16) + ({key} * {east}) % 12000 AS DOUBLE) AS x,
         CAST(7206500 + 8000 * (({key} // {per_tile}) // 16) + ({key} * {north}) % 8000 AS DOUBLE) AS y
  FROM {source})"""


NODES = _placed("customer", "c_custkey", "nodes", 1500, 4973, 3571)
BOARD_POINTS = _placed("supplier", "s_suppkey", "board_points", 100, 7919, 6151)

# Fixed values of the ellipsoid WGS84 and its transverse Mercator series: rectifying
# radius times the scale on the meridian, first eccentricity, and the coefficients by
# order of grid to conformal, conformal to grid, and conformal to geodetic latitude.
GRID_RADIUS = 0.9996 * 6367449.145823415
ECCENTRICITY = 0.08181919084262149
TO_SPHERE = (8.377321640579486e-04, 5.905870152220203e-08, 1.6734826652839968e-10,
             2.1647980400627059e-13, 3.7879780461686053e-16, 7.2487488906941545e-19)
TO_GRID = (8.377318206244698e-04, 7.608527773572307e-07, 1.1976455033294527e-09,
           2.4291706072013587e-12, 5.711757677865804e-15, 1.4911177312583895e-17)
TO_LATITUDE = (3.356551469132832e-03, 6.5718731986284435e-06, 1.7646404113085805e-08,
               5.3877537842559224e-11, 1.764007472632213e-13, 6.056073876794177e-16)


def _sum(coefficients, template: str) -> str:
    return " + ".join(f"({c!r}) * " + template.format(k=2 * order)
                      for order, c in enumerate(coefficients, start=1))


def _latlon(source: str, name: str) -> str:
    """CTE `name`: node_id, lat, lon of a source with x, y in UTM zone 19 south."""
    return f"""{name}_a AS (
  SELECT node_id, (y - 10000000.0) / {GRID_RADIUS!r} AS xi, (x - 500000.0) / {GRID_RADIUS!r} AS eta
  FROM {source}),
{name}_b AS (
  SELECT node_id,
    xi - ({_sum(TO_SPHERE, 'sin({k} * xi) * cosh({k} * eta)')}) AS u,
    eta - ({_sum(TO_SPHERE, 'cos({k} * xi) * sinh({k} * eta)')}) AS v
  FROM {name}_a),
{name}_c AS (
  SELECT node_id, asin(sin(u) / cosh(v)) AS chi,
         -69.0 + degrees(atan2(sinh(v), cos(u))) AS lon FROM {name}_b),
{name} AS (
  SELECT node_id, lon,
    degrees(chi + {_sum(TO_LATITUDE, 'sin({k} * chi)')}) AS lat
  FROM {name}_c)"""


def _metres(a: str, b: str) -> str:
    return (f"2 * 6371008.8 * asin(sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + "
            f"cos(radians({a}.lat)) * cos(radians({b}.lat)) * "
            f"pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))")


NEAR = f"""{NODES}, {BOARD_POINTS}, {_latlon('nodes', 'placed')},
{_latlon('board_points', 'sites')},
near AS (
  SELECT p.node_id, CAST(s.node_id AS VARCHAR) AS board, {_metres('p', 's')} AS distance
  FROM placed p, sites s
  WHERE {_metres('p', 's')} <= 1000)"""

SIGNS = f"""{OBSERVED}, {_bounds('observed', 'edge_id', 'avg_speed', 'model')},
found AS (
  SELECT o.edge_id, o.avg_speed FROM observed o JOIN model m ON m.edge_id = o.edge_id
  WHERE o.avg_speed < m.lower_threshold)"""

SIGN_ROWS = f"""WITH {SIGNS}, {NEAR},
signs AS (
  SELECT f.edge_id, '#' AS routing_key,
         n.board || '.' || e.o_custkey || '.' || (e.o_custkey + 1) AS body
  FROM found f JOIN orders e ON e.o_orderkey = f.edge_id
  JOIN near n ON n.node_id = e.o_custkey)"""

_phi = "radians(-23.0 - (c_custkey % 997) / 1000.0)"
_east = "radians(-46.0 - (c_custkey % 991) / 1000.0 + 69.0)"
GRID = f"""WITH a AS (
  SELECT c_custkey, {_phi} AS phi, {_east} AS east FROM customer),
b AS (
  SELECT c_custkey, east, sinh(atanh(sin(phi)) - {ECCENTRICITY!r}
         * atanh({ECCENTRICITY!r} * sin(phi))) AS t FROM a),
c AS (
  SELECT c_custkey, atan2(t, cos(east)) AS u,
         asinh(sin(east) / sqrt(t * t + cos(east) * cos(east))) AS v FROM b)
SELECT c_custkey, -23.0 - (c_custkey % 997) / 1000.0 AS lat,
  -46.0 - (c_custkey % 991) / 1000.0 AS lon,
  round(500000.0 + {GRID_RADIUS!r} * (v + {_sum(TO_GRID,
                                          'cos({k} * u) * sinh({k} * v)')}), 3) AS x,
  round(10000000.0 + {GRID_RADIUS!r} * (u + {_sum(TO_GRID,
                                            'sin({k} * u) * cosh({k} * v)')}), 3) AS y
FROM c"""

TRIPS = """trips AS (
  SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderstatus AS origin,
         o_orderpriority AS destination, CAST(o_custkey % 100 AS VARCHAR) AS link_origin,
         CAST(o_custkey % 6 AS INT) AS count, CAST(o_orderkey % 3600 AS INT) AS start,
         'car' AS mode
  FROM orders)"""

SPLIT = f"""WITH {TRIPS}
SELECT name, origin, destination, link_origin, CAST(ceil(count / 2.0) AS INT) AS count,
       start - 600 AS start, mode
FROM trips WHERE start BETWEEN 600 AND 1200"""

VEHICLES = f"""WITH {TRIPS},
demand AS (
  SELECT name, origin, destination, link_origin, start, mode, sum(count) AS vehicles
  FROM trips GROUP BY ALL),
numbered AS (
  SELECT *, md5(concat_ws(':', 'seed', name, origin, destination, link_origin, start, mode,
                          vehicle)) AS h
  FROM (SELECT *, unnest(range(CAST(vehicles AS BIGINT))) AS vehicle FROM demand)),
expanded AS (
  SELECT name, origin, destination, link_origin, 1 AS count,
         start + CAST('0x' || substr(h, 1, 6) AS INT) % 26 AS start, mode,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-a'
         || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
  FROM numbered)"""

CAR = ("'Car' AS description, 'current_location' AS capabilities, 'active' AS status, "
       "CAST(-23 AS DOUBLE) AS lat, CAST(-46 AS DOUBLE) AS lon")
NEW_CARS = f"""SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uuid, {CAR} FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""

MEANS = """means AS (
  SELECT l_linenumber AS last_link, l_returnflag = 'R' AS has_event,
         avg(l_quantity) AS distance, avg(l_extendedprice) AS duration
  FROM lineitem GROUP BY ALL),
compared AS (
  SELECT CAST(CASE last_link WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE last_link END AS BIGINT)
           AS last_link,
         has_event, avg(distance) AS distance, avg(duration) AS duration
  FROM means GROUP BY ALL)"""
COMPARED = f"""WITH {MEANS}
SELECT last_link, has_event, round(distance, 6) AS distance, round(duration, 6) AS duration
FROM compared"""

HISTORIES = """points AS (
  SELECT CASE WHEN user_id % 29 <> 0 THEN CAST(user_id AS VARCHAR) END AS uuid,
         CASE WHEN event_type <> 'error' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS tick,
         CASE WHEN event_id % 11 <> 0
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS edge_id
  FROM events)"""
CLEAN = f"""WITH {HISTORIES}
SELECT uuid, tick, edge_id FROM points
WHERE uuid IS NOT NULL AND tick IS NOT NULL AND edge_id IS NOT NULL"""


def _nearest(divisor: int, digits: int) -> str:
    return f"""WITH {NODES}, {BOARD_POINTS},
ranked AS (
  SELECT b.node_id AS board, n.node_id,
         sqrt(pow(n.x / {divisor} - b.x / {divisor}, 2) + pow(n.y / {divisor} - b.y / {divisor}, 2))
           AS distance,
         row_number() OVER (PARTITION BY b.node_id
           ORDER BY pow(n.x - b.x, 2) + pow(n.y - b.y, 2), n.node_id) AS nr
  FROM board_points b, nodes n)
SELECT board, node_id, round(distance, {digits}) AS distance FROM ranked WHERE nr = 1"""


TRAINED = f"WITH {SPEEDS}, {_bounds('speeds', 'edge_id', 'kmh', 'model')}"

ACCEPTED_ROWS = ACCEPTED + """
SELECT uuid, seq, tick, edge_id, avg_speed FROM accepted"""

HISTORY_LINES = """broken AS (
  SELECT CASE event_id % 17 WHEN 0 THEN '{"uuid":"' || user_id || '","capabilities":'
    WHEN 1 THEN 'lost ' || event_id
    WHEN 2 THEN '{"uuid":"' || user_id || '","capabilities":{"current_location":[{"date":"d","nodeID":"x'
                || event_id || '","tick":"1"}]}}' END AS line
  FROM events WHERE event_id % 17 < 3)"""

MODEL_LINES = """model_rows AS (
  SELECT CASE p_partkey % 7 WHEN 0 THEN 'x3.0,1.5,0.5,' || p_partkey WHEN 1 THEN p_size || '.5,1.5,0.5'
    WHEN 2 THEN p_size || '.5,1.5,0.5,' END AS line,
    CASE WHEN p_partkey % 7 < 2 THEN 'unreadable' ELSE 'no edge id' END AS reason
  FROM part WHERE p_partkey % 7 < 3)"""

MOVES = f"""{HISTORIES}, {LENGTHS},
clean AS (SELECT * FROM points WHERE uuid IS NOT NULL AND tick IS NOT NULL AND edge_id IS NOT NULL),
paired AS (
  SELECT edge_id, tick - lag(tick) OVER (PARTITION BY uuid ORDER BY tick, edge_id) AS tick_diff FROM clean),
moved AS (
  SELECT count(*) AS moves, count(*) FILTER (l.edge_id IS NULL) AS unknown
  FROM paired p LEFT JOIN lengths l ON l.edge_id = p.edge_id WHERE tick_diff > 0)"""


def _link(key: str, length: str, from_node: str = "'\"' || o_custkey || '\"'", more: str = "true") -> str:
    tail = f"""|| ' length="' || {length} || '" note="a > b"/>'""" if more == "true" else "|| '/>'"
    return f"""'<link id="' || {key} || '" from=' || {from_node} || ' to="1"' {tail}"""


ORACLES: dict[str, str] = {
    "rejected_history_lines": f"WITH {HISTORY_LINES} SELECT line, 'unreadable' AS reason FROM broken",
    "rejected_model_rows": f"WITH {MODEL_LINES} SELECT line, reason FROM model_rows",
    "source_line_counts": f"""WITH {HISTORY_LINES},
users AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events))
SELECT 'histories' AS source, (SELECT n FROM users) + count(*) AS lines, (SELECT n FROM users) AS usable,
  count(*) AS rejected FROM broken
UNION ALL SELECT 'model', count(*), count(*) FILTER (p_partkey % 7 > 2), count(*) FILTER (p_partkey % 7 < 3) FROM part
UNION ALL SELECT 'trip log', count(*), count(*) FILTER (l_orderkey % 19 <> 0), count(*) FILTER (l_orderkey % 19 = 0)
FROM lineitem
UNION ALL SELECT 'vehicles', count(*), count(*) FILTER (o_orderkey % 13 > 2), count(*) FILTER (o_orderkey % 13 < 3)
FROM orders""",
    "rejected_links": f"""SELECT CASE o_orderkey % 11 WHEN 0 THEN {_link("'x' || o_orderkey", "'1'")}
  WHEN 1 THEN {_link("o_orderkey", "'long'")} ELSE {_link("o_orderkey", "''", "o_custkey", "")} END AS line,
  CASE o_orderkey % 11 WHEN 0 THEN 'no id' WHEN 1 THEN 'length is no number' ELSE 'unreadable' END AS reason
FROM orders WHERE o_orderkey % 11 IN (0, 1, 6)""",
    "links_outside_sections": """SELECT o_orderkey AS edge_id, o_custkey AS from_node, 1 AS to_node,
  o_totalprice AS length FROM orders WHERE o_orderkey % 11 NOT IN (0, 1, 6)""",
    "rejected_trips": """SELECT CAST(o_orderkey AS VARCHAR) AS name,
  o_orderkey % 3600 || CASE o_orderkey % 5 WHEN 0 THEN '.5' WHEN 1 THEN '.0' ELSE '' END AS start,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 6 AS VARCHAR) END AS count,
  CASE WHEN o_orderkey % 5 = 0 THEN 'no start' ELSE 'no count' END AS reason
FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0""",
    "training_metrics": f"""WITH {MOVES}
SELECT 'points' AS metric, count(*) AS number FROM points
UNION ALL SELECT 'points with no uuid', count(*) FROM points WHERE uuid IS NULL
UNION ALL SELECT 'points with no tick', count(*) FROM points WHERE uuid IS NOT NULL AND tick IS NULL
UNION ALL SELECT 'points with no edge', count(*) FROM points
WHERE uuid IS NOT NULL AND tick IS NOT NULL AND edge_id IS NULL
UNION ALL SELECT 'moves', moves FROM moved
UNION ALL SELECT 'moves on unknown edges', unknown FROM moved""",
    "sketched_bounds": f"""WITH {SPEEDS}
SELECT edge_id, count(kmh) AS n, true AS median_within, true AS mad_within
FROM speeds GROUP BY edge_id HAVING count(kmh) > 0""",
    "train_thresholds": f"{TRAINED} SELECT edge_id, {ROUNDED_BOUNDS} FROM model",
    "pair_speed": f"""WITH {SPEEDS}
SELECT uuid, tick, edge_id, length, tick_diff, kmh FROM speeds""",
    "flatten_histories": CLEAN,
    "rejected_positions": f"""WITH {HISTORIES}
SELECT uuid, edge_id, CASE WHEN uuid IS NULL THEN 'no uuid' WHEN tick IS NULL THEN 'no tick'
                           ELSE 'no edge' END AS reason
FROM points WHERE uuid IS NULL OR tick IS NULL OR edge_id IS NULL""",
    "edge_speed_deviations": f"""WITH {SPEEDS},
mid AS (SELECT edge_id, median(kmh) AS median FROM speeds GROUP BY edge_id)
SELECT s.uuid, s.tick, s.edge_id, round(m.median, 9) AS median,
       round(abs(s.kmh - m.median), 9) AS deviation
FROM speeds s JOIN mid m ON m.edge_id = s.edge_id""",
    "mad_by_key": f"""WITH {_bounds('events', 'user_id', 'value', 'model')}
SELECT user_id, {ROUNDED_BOUNDS} FROM model""",
    "mad_by_flag": f"""WITH {_bounds('lineitem', 'l_returnflag, l_linestatus',
                                     'l_extendedprice', 'model')}
SELECT l_returnflag, l_linestatus, n, round(mean, 4) AS mean, round(median, 6) AS median,
  round(mad, 6) AS mad, round(upper_threshold, 6) AS upper_threshold,
  round(lower_threshold, 6) AS lower_threshold FROM model""",
    "detect_anomalies": f"""WITH {SIGNS}
SELECT edge_id, round(avg_speed, 9) AS avg_speed,
       '{{"edgeId":"' || edge_id || '"}}' AS message FROM found""",
    "flag_speeds": f"""WITH {OBSERVED}, {_bounds('observed', 'event_type', 'avg_speed', 'model')}
SELECT o.event_id, o.event_type, o.avg_speed < m.lower_threshold AS is_anomaly
FROM observed o JOIN model m ON m.event_type = o.event_type""",
    "flag_unusable_bounds": f"""WITH {OBSERVED}
SELECT event_id, event_type, event_type NOT IN ('click', 'view', 'error') AND avg_speed < 490
  AS is_anomaly FROM observed""",
    "rejected_speeds": """WITH sent AS (
  SELECT event_id, CAST(user_id AS VARCHAR) || CASE event_id % 3 WHEN 0 THEN '.0' WHEN 1 THEN '.7' ELSE '' END
         AS edge, event_id % 5 <> 0 AS known FROM events)
SELECT '{"edge_id":"' || edge || CASE WHEN known THEN '","avg_speed":"' || event_id || '"}' ELSE '"}' END AS value,
  CASE WHEN event_id % 3 = 1 THEN 'no edge id' ELSE 'no speed' END AS reason
FROM sent WHERE event_id % 3 = 1 OR NOT known""",
    "json_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k,
  json_extract_string(props, '$.missing') AS missing,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_id,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_number FROM events""",
    "stateful_speed": ACCEPTED_ROWS,
    "speed_message_round_trip": ACCEPTED + """
SELECT CAST(edge_id AS VARCHAR) AS edge_text, edge_id, avg_speed FROM accepted""",
    "routing_filter": """SELECT event_id, event_type || '.current_location.simulated' AS routing_key
FROM events WHERE event_type NOT IN ('view', 'error', 'click')""",
    "reproject_nodes": f"""WITH {NODES}, {_latlon('nodes', 'placed')}
SELECT n.node_id, n.x, n.y, round(p.lat, 7) AS lat, round(p.lon, 7) AS lon
FROM nodes n JOIN placed p ON p.node_id = n.node_id""",
    "project_to_grid": GRID,
    "boards_in_radius": f"""WITH {NEAR}
SELECT node_id, board, round(distance, 3) AS distance FROM near""",
    "nearest_node": _nearest(1, 9),
    "nearest_node_dense": _nearest(1048576, 12),
    "rejected_boards": """SELECT 'board-' || s_suppkey AS uuid,
  CASE WHEN s_suppkey % 3 = 0 THEN 'board without description' ELSE 'board without place' END AS reason
FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 5 = 0""",
    "rejected_position_messages": """SELECT event_id AS seq,
  CASE WHEN event_id % 13 = 0 THEN 'no uuid' WHEN event_id % 7 = 0 THEN 'no tick' ELSE 'no edge' END AS reason
FROM events WHERE event_id % 13 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0""",
    "sign_messages": f"{SIGN_ROWS} SELECT edge_id, routing_key, body FROM signs",
    "rejected_anomalies": """WITH sent AS (
  SELECT CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN 'no json'
         ELSE '{"edgeId":"' || user_id || '"}' END AS value,
         CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END AS edge_id FROM events),
judged AS (
  SELECT s.value, s.edge_id,
         CASE WHEN s.edge_id IS NULL THEN 'no edge id'
              WHEN p.p_partkey IS NULL THEN 'unknown edge'
              WHEN c.c_custkey IS NULL THEN 'unknown node' END AS reason
  FROM sent s LEFT JOIN part p ON p.p_partkey = s.edge_id AND p.p_size <= 40
  LEFT JOIN customer c ON c.c_custkey = p.p_partkey * 20)
SELECT * FROM judged WHERE reason IS NOT NULL""",
    "split_trips": SPLIT,
    "expand_trips": f"{VEHICLES} SELECT * FROM expanded",
    "register_absent": NEW_CARS,
    "boards_by_capability": f"""WITH {BOARD_POINTS}, {_latlon('board_points', 'sites')}
SELECT 'board-' || node_id AS uuid, CAST(node_id AS VARCHAR) AS description,
       'traffic_board' AS capabilities, 'active' AS status,
       round(lat, 7) AS lat, round(lon, 7) AS lon FROM sites""",
    "trip_first_ticks": """SELECT l_orderkey AS last_tick, l_extendedprice AS duration,
  round(l_orderkey - l_extendedprice, 6) AS first_tick FROM lineitem""",
    "compare_destinations": COMPARED,
    "overlay_destinations": f"""WITH {MEANS}
SELECT last_link,
  round(max(distance) FILTER (NOT has_event), 6) AS distance_baseline,
  round(max(distance) FILTER (has_event), 6) AS distance_events,
  round(max(duration) FILTER (NOT has_event), 6) AS duration_baseline,
  round(max(duration) FILTER (has_event), 6) AS duration_events
FROM compared GROUP BY last_link""",
    "consecutive_pairs_array": """WITH points AS (
  SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
paired AS (
  SELECT vec_id, CAST(i - 1 AS INT) AS pos, CAST(v AS DOUBLE) AS first,
         CAST(lead(v) OVER (PARTITION BY vec_id ORDER BY i) AS DOUBLE) AS second FROM points)
SELECT vec_id, pos, round(first, 9) AS first, round(second, 9) AS second
FROM paired WHERE second IS NOT NULL""",
    "short_arrays": """SELECT vec_id,
  CASE WHEN vec_id % 3 > 0 THEN 0 END AS pos,
  CASE WHEN vec_id % 3 > 0 THEN round(CAST(embedding[1] AS DOUBLE), 9) END AS first,
  CASE vec_id % 3 WHEN 1 THEN round(CAST(embedding[1] AS DOUBLE), 9)
                  WHEN 2 THEN round(CAST(embedding[2] AS DOUBLE), 9) END AS second
FROM embeddings""",
    "array_deviations": """WITH points AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v,
         generate_subscripts(embedding, 1) AS i FROM embeddings),
mid AS (SELECT vec_id, median(v) AS median FROM points GROUP BY vec_id)
SELECT p.vec_id, round(m.median, 9) AS median, CAST(p.i - 1 AS INT) AS pos,
       round(abs(p.v - m.median), 9) AS deviation
FROM points p JOIN mid m ON m.vec_id = p.vec_id""",
    "last_write_wins": """SELECT l_partkey, l_orderkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
         l_linenumber DESC, l_extendedprice DESC) AS nr FROM lineitem) WHERE nr = 1""",
    "road_map_xml": f"""WITH {NODES}
SELECT o_orderkey AS edge_id, o_custkey AS from_node, o_custkey + 1 AS to_node,
       o_totalprice AS length, n.x, n.y
FROM orders JOIN nodes n ON n.node_id = o_custkey""",
    "repeated_ids_xml": """SELECT c_custkey % 97 AS edge_id, max(c_custkey) AS from_node,
  max(c_custkey) + 1 AS to_node, max(c_custkey) + 0.5::DOUBLE AS length
FROM customer GROUP BY c_custkey % 97""",
    "nodes_xml": f"""WITH {NODES}, {_latlon('nodes', 'placed')}
SELECT n.node_id, n.x, n.y, round(p.lat, 7) AS lat, round(p.lon, 7) AS lon
FROM nodes n JOIN placed p ON p.node_id = n.node_id""",
    "trips_xml": f"SELECT *, 'kept' AS note FROM ({SPLIT})",
    "vehicles_csv": f"{VEHICLES} SELECT uuid, name, start FROM expanded",
    "model_csv": f"""{TRAINED} SELECT edge_id, round(mad, 9) AS mad,
  round(upper_threshold, 9) AS upper_threshold, round(lower_threshold, 9) AS lower_threshold
FROM model""",
    "trip_log_csv": COMPARED,
    "histories_json": CLEAN,
    "catalog_table": f"""SELECT CAST(c_custkey AS VARCHAR) AS uuid, {CAR}
FROM customer WHERE c_acctbal > 0 UNION ALL ({NEW_CARS})""",
    "stream_stateful_speed": ACCEPTED_ROWS,
    "stream_bulk_speed": ACCEPTED_ROWS,
    "stream_restart": """SELECT CASE event_type WHEN 'view' THEN 'north.car.current_location.simulated'
  WHEN 'error' THEN 'car.current_location.real' WHEN 'click' THEN 'car_current_location.simulated'
  ELSE event_type || '.current_location.simulated' END AS key, event_type AS value, event_id AS seq
FROM events""",
    "stream_two_sinks": f"""WITH {OBSERVED}
SELECT '{{"edgeId":"' || edge_id || '"}}' AS value FROM observed WHERE avg_speed < 480""",
    "stream_state_handover": ACCEPTED_ROWS,
    "stream_recovery": f"""WITH {OBSERVED}
SELECT edge_id, round(avg_speed, 9) AS avg_speed FROM observed WHERE event_id % 9 > 1 AND avg_speed < 480""",
    "stream_fan_out": f"""WITH {OBSERVED},
found AS (SELECT edge_id, round(avg_speed, 6) AS speed FROM observed WHERE event_id % 9 > 1 AND avg_speed < 480)
SELECT 'messages' AS sink, '{{"edgeId":"' || edge_id || '"}}' AS value FROM found
UNION ALL SELECT 'rows', '{{"edge_id":' || edge_id || ',"avg_speed":' || speed || '}}' FROM found""",
    "stream_metrics": """SELECT 'messages' AS metric, count(*) AS number FROM events
UNION ALL SELECT 'messages with no edge id', count(*) FROM events WHERE event_id % 9 = 0
UNION ALL SELECT 'messages with no speed', count(*) FROM events WHERE event_id % 9 = 1
UNION ALL SELECT 'input rows', count(*) FROM events""",
    "stream_signs": f"{SIGN_ROWS} SELECT routing_key AS key, body AS value FROM signs",
}
