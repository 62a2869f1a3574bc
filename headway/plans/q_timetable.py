"""Registered queries: sequences, stop times, service patterns, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.time import duration_seconds
from headway.operators import patterns as pat
from headway.operators import resolve as res
from headway.operators import rollup
from headway.operators import sequence as seq
from headway.plans import network as net
from headway.plans.network import NETWORK_SQL, STOP_SEQUENCE_SQL
from headway.plans.registry import Tables, query

_STOP_TIMES_SQL = (
    "WITH "
    + NETWORK_SQL
    + """,
vj AS (
  SELECT o_orderkey, 'VJ' || o_orderkey AS vj_code,
         CASE WHEN o_orderkey % 50 <> 7 THEN (o_orderkey * 997) % 86400 END AS start_s
  FROM orders WHERE o_orderkey % 5 <> 0),
base AS (
  SELECT l.*, v.vj_code, v.start_s, l_tax > 0.05 AS changed,
         CASE WHEN l_linestatus = 'F' THEN l_linenumber * 10 WHEN l_quantity > 40 THEN 0 END AS bf,
         CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN 60 END AS bt,
         CASE WHEN l_tax > 0.05 AND l_partkey % 3 = 0 THEN 0 WHEN l_tax > 0.05 AND l_partkey % 3 = 1 THEN 45 END AS vf,
         CASE WHEN l_tax > 0.05 AND l_suppkey % 4 = 0 THEN 120 WHEN l_tax > 0.05 AND l_suppkey % 4 = 1 THEN 0 END AS vt,
         CASE WHEN l_partkey % 13 = 0 THEN 0 ELSE 1 END AS from_ok,
         CASE WHEN l_suppkey % 13 <> 0 AND is_last THEN 1 ELSE 0 END AS to_ok
  FROM links l JOIN vj v ON v.o_orderkey = l.l_orderkey),
timed AS (
  SELECT *,
    CASE WHEN NOT changed THEN CAST(l_quantity AS INTEGER) * 60
         WHEN l_discount > 0.02 THEN CAST(l_quantity AS INTEGER) * 60 + 30 ELSE 0 END AS run,
    coalesce(sum(from_ok + to_ok) OVER (PARTITION BY vj_code ORDER BY section_pos, link_pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS is_first
  FROM base),
waited AS (
  SELECT *, CASE WHEN is_first THEN coalesce(nullif(vf, 0), nullif(bf, 0), 0)
    ELSE coalesce(coalesce(nullif(vt, 0), vf), coalesce(nullif(bt, 0), bf), 0) END AS wait
  FROM timed),
clocked AS (
  SELECT *, coalesce(sum(run + wait) OVER (PARTITION BY vj_code ORDER BY section_pos, link_pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + wait AS dep,
    lag(from_stop = to_stop) OVER (PARTITION BY vj_code, section_pos ORDER BY link_pos) AS prev_loop
  FROM waited),
uses AS (
  SELECT file_id, vj_code, jp_id, section_pos, link_pos, 0 AS e, from_stop AS stop, dep, start_s, prev_loop,
         CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber * 10 END AS given, l_quantity > 25 AS tp,
         CASE l_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS act FROM clocked WHERE from_ok = 1
  UNION ALL
  SELECT file_id, vj_code, jp_id, section_pos, link_pos, 1, to_stop, dep + run, start_s, NULL, NULL, l_quantity > 25, 4
  FROM clocked WHERE to_ok = 1),
lagged AS (
  SELECT *, lag(stop) OVER (PARTITION BY vj_code ORDER BY section_pos, link_pos, e) AS prev FROM uses),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY vj_code ORDER BY section_pos, link_pos, e) - 1 AS auto FROM lagged
  WHERE NOT (e = 0 AND coalesce(stop = prev, false) AND NOT coalesce(prev_loop, false)))
SELECT file_id, vj_code, jp_id, stop AS atco_code, CAST(auto AS INTEGER) AS auto_sequence_number,
  CAST(coalesce(given, auto) AS INTEGER) AS sequence_number,
  CAST((start_s + dep) % 86400 AS BIGINT) AS departure_seconds,
  CASE WHEN start_s IS NOT NULL THEN
    lpad(CAST(((start_s + dep) % 86400) // 3600 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(((start_s + dep) % 3600) // 60 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST((start_s + dep) % 60 AS VARCHAR), 2, '0') END AS departure_time,
  tp AS is_timing_point, act AS stop_activity_id
FROM kept"""
)


def _stop_times(t: Tables, blocked: bool) -> DataFrame:
    out = seq.stop_times(
        net.vehicle_journeys(t),
        net.journey_patterns(t),
        net.timing_links(t),
        net.vj_links(t),
        blocked=blocked,
    )
    return out.withColumn("departure_seconds", F.col("departure_seconds").cast("bigint"))


@query("stop_times", _STOP_TIMES_SQL, by_file=True)
def stop_times(t: Tables) -> DataFrame:
    return _stop_times(t, blocked=False)


@query("stop_times_blocked", _STOP_TIMES_SQL, by_file=True)
def stop_times_blocked(t: Tables) -> DataFrame:
    return _stop_times(t, blocked=True)


def _links(t: Tables) -> DataFrame:
    return seq.pattern_links(net.journey_patterns(t), net.timing_links(t))


def _sequence(t: Tables) -> DataFrame:
    return seq.stop_sequence(_links(t), net.placeholder_stops(t))


@query(
    "pattern_links",
    "WITH " + NETWORK_SQL + """
SELECT file_id, jp_id, CAST(section_pos AS INTEGER) AS section_pos, CAST(link_pos AS INTEGER) AS link_pos,
       from_stop, to_stop, is_last FROM links""",
    by_file=True,
)
def pattern_links(t: Tables) -> DataFrame:
    return _links(t).select(
        "file_id",
        "jp_id",
        "section_pos",
        "link_pos",
        F.col("from.stop_ref").alias("from_stop"),
        F.col("to.stop_ref").alias("to_stop"),
        "is_last",
    )


@query(
    "stop_sequence",
    STOP_SEQUENCE_SQL + "SELECT file_id, jp_id, CAST(pos AS INTEGER) AS pos, stop_ref FROM seq",
    by_file=True,
)
def stop_sequence(t: Tables) -> DataFrame:
    return _sequence(t)


@query(
    "simple_stop_sequence",
    "WITH " + NETWORK_SQL + """,
uses AS (
  SELECT file_id, jp_id, section_pos, link_pos, 0 AS e, from_stop AS stop_ref FROM links
  WHERE NOT (section_pos > 0 AND link_pos = 0)
  UNION ALL
  SELECT file_id, jp_id, section_pos, link_pos, 1, to_stop FROM links WHERE is_last)
SELECT file_id, jp_id, CAST(row_number() OVER (PARTITION BY jp_id ORDER BY section_pos, link_pos, e) - 1 AS INTEGER) AS pos,
       stop_ref FROM uses""",
    by_file=True,
)
def simple_stop_sequence(t: Tables) -> DataFrame:
    return seq.simple_stop_sequence(_links(t))


@query(
    "consecutive_pairs",
    STOP_SEQUENCE_SQL + """
SELECT * FROM (SELECT file_id, jp_id, CAST(pos AS INTEGER) AS sequence_number, stop_ref AS from_stop,
  lead(stop_ref) OVER (PARTITION BY jp_id ORDER BY pos) AS to_stop FROM seq) WHERE to_stop IS NOT NULL""",
    by_file=True,
)
def consecutive_pairs(t: Tables) -> DataFrame:
    return seq.consecutive_pairs(_sequence(t), ["file_id", "jp_id"], ["pos"])


@query(
    "distinct_pairs",
    "SELECT DISTINCT 'ST' || (l_suppkey % 500) AS from_stop, 'ST' || (l_partkey % 500) AS to_stop FROM lineitem",
)
def distinct_pairs(t: Tables) -> DataFrame:
    links = t.lineitem.select(
        F.concat(F.lit("ST"), F.col("l_suppkey") % 500).alias("from_stop"),
        F.concat(F.lit("ST"), F.col("l_partkey") % 500).alias("to_stop"),
    )
    return seq.distinct_pairs(links)


@query(
    "track_sequence",
    STOP_SEQUENCE_SQL + """,
pairs AS (SELECT file_id, jp_id, pos AS sequence_number, stop_ref AS from_stop,
  lead(stop_ref) OVER (PARTITION BY jp_id ORDER BY pos) AS to_stop FROM seq),
tracks AS (SELECT min(s_suppkey) AS id, 'ST' || (s_suppkey % 11) AS a, 'ST' || ((s_suppkey // 11) % 11) AS b
  FROM supplier GROUP BY ALL)
SELECT file_id, jp_id, CAST(sequence_number AS INTEGER) AS sequence_number, from_stop, to_stop, id AS tracks_id
FROM pairs JOIN tracks ON a = from_stop AND b = to_stop""",
    by_file=True,
)
def track_sequence(t: Tables) -> DataFrame:
    tracks = net.supplier_pairs(t).select(
        "id",
        F.concat(F.lit("ST"), "a").alias("from_atco_code"),
        F.concat(F.lit("ST"), "b").alias("to_atco_code"),
    )
    pairs = seq.consecutive_pairs(_sequence(t), ["file_id", "jp_id"], ["pos"])
    return seq.track_sequence(pairs, tracks)


@query(
    "terminal_stops",
    STOP_SEQUENCE_SQL + """,
ends AS (SELECT file_id, jp_id, min_by(stop_ref, pos) AS first_stop, max_by(stop_ref, pos) AS last_stop
  FROM seq GROUP BY ALL),
names AS (SELECT 'ST' || p_partkey AS code, p_name || ' ' || p_partkey AS name FROM part)
SELECT file_id, jp_id, first_stop, last_stop, a.name AS origin, b.name AS destination
FROM ends LEFT JOIN names a ON a.code = first_stop LEFT JOIN names b ON b.code = last_stop""",
    by_file=True,
)
def terminal_stops(t: Tables) -> DataFrame:
    return seq.terminal_stops(_sequence(t), net.stops(t))


@query(
    "timing_point_count",
    "WITH " + NETWORK_SQL + """
SELECT file_id, jp_id, CAST(sum(CASE WHEN l_quantity > 25 THEN 2 ELSE 0 END) AS BIGINT) AS principal_timing_points
FROM links GROUP BY ALL""",
    by_file=True,
)
def timing_point_count(t: Tables) -> DataFrame:
    return seq.timing_point_count(_links(t))


@query(
    "unknown_activities",
    "WITH " + NETWORK_SQL + """
SELECT file_id, 'S' || l_orderkey || CASE half WHEN 0 THEN '-A' ELSE '-B' END AS section_id,
  CAST(link_pos AS INTEGER) AS link_pos, stop_ref, activity FROM (
  SELECT *, from_stop AS stop_ref, 'unknown' AS activity FROM links WHERE l_partkey % 13 = 0
  UNION ALL SELECT *, to_stop, NULL FROM links WHERE l_suppkey % 13 = 0)""",
    by_file=True,
)
def unknown_activities(t: Tables) -> DataFrame:
    return seq.unknown_activities(net.timing_links(t))


@query(
    "broken_links",
    "WITH " + NETWORK_SQL + """,
lagged AS (SELECT file_id, l_orderkey, half, from_stop,
  lag(to_stop) OVER (PARTITION BY l_orderkey, half ORDER BY link_pos) AS prev FROM links)
SELECT DISTINCT file_id, 'S' || l_orderkey || CASE half WHEN 0 THEN '-A' ELSE '-B' END AS section_id
FROM lagged WHERE prev <> from_stop""",
    by_file=True,
)
def broken_links(t: Tables) -> DataFrame:
    return seq.broken_links(net.timing_links(t))


# ------------------------------------------------------- service patterns

_BRIDGE_SQL = STOP_SEQUENCE_SQL + """,
keyed AS (
  SELECT 'F' || (o_orderkey // 100) AS file_id, 'JP' || o_orderkey AS jp_id, o_orderkey AS ordinal,
         'SV' || (o_custkey % 3) AS service_code, o_orderstatus,
         coalesce(s.stops, '') AS stops, coalesce(s.n, 0) AS num_stops
  FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey
  LEFT JOIN (SELECT jp_id, string_agg(stop_ref, chr(31) ORDER BY pos) AS stops, count(*) AS n FROM seq GROUP BY jp_id) s
    ON s.jp_id = 'JP' || o_orderkey),
bridge AS (
  SELECT file_id, jp_id, ordinal, service_code, o_orderstatus, num_stops,
    min_by(service_code, ordinal) OVER (PARTITION BY file_id, stops) || '-' || sha256(file_id || chr(31) || stops) AS service_pattern_id
  FROM keyed)
"""


def _bridge(t: Tables) -> DataFrame:
    return pat.service_pattern_bridge(net.journey_patterns(t), _sequence(t))


@query(
    "service_patterns",
    _BRIDGE_SQL + """SELECT file_id, jp_id, service_code, service_pattern_id, CAST(num_stops AS INTEGER) AS num_stops FROM bridge""",
    by_file=True,
)
def service_patterns(t: Tables) -> DataFrame:
    return _bridge(t).drop("ordinal")


_JOURNEY_MAP_SQL = _BRIDGE_SQL + """,
vj AS (SELECT 'F' || (o_orderkey // 100) AS file_id, 'VJ' || o_orderkey AS vj_code, o_orderkey AS ordinal,
    'L' || (o_custkey % 4) AS line_ref,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'JP' || o_orderkey END AS jp_ref,
    CASE WHEN o_orderkey % 5 = 0 THEN 'VJ' || (o_orderkey - CASE WHEN o_orderkey % 10 = 0 THEN 5 ELSE 1 END) END AS vj_ref
  FROM orders),
direct AS (SELECT vj.*, b.service_pattern_id FROM vj LEFT JOIN bridge b ON b.file_id = vj.file_id AND b.jp_id = jp_ref),
mapped AS (SELECT d.file_id, d.vj_code, d.ordinal, d.line_ref,
    coalesce(d.service_pattern_id, h.service_pattern_id) AS service_pattern_id,
    CASE WHEN d.service_pattern_id IS NOT NULL THEN 'direct' WHEN h.service_pattern_id IS NOT NULL THEN 'hop' ELSE 'unresolved' END AS how
  FROM direct d LEFT JOIN direct h ON h.file_id = d.file_id AND h.vj_code = d.vj_ref)
"""


def _journey_map(t: Tables) -> DataFrame:
    return res.journey_pattern_of(net.vehicle_journeys(t), _bridge(t))


@query("journey_patterns_resolved", _JOURNEY_MAP_SQL + "SELECT file_id, vj_code, service_pattern_id, how FROM mapped", by_file=True)
def journey_patterns_resolved(t: Tables) -> DataFrame:
    return _journey_map(t)


@query(
    "pattern_members",
    _JOURNEY_MAP_SQL + """
SELECT b.file_id, b.service_pattern_id, count(DISTINCT jp_id) AS journey_patterns,
  CAST(max(num_stops) AS INTEGER) AS num_stops,
  (SELECT count(*) FROM mapped m WHERE m.file_id = b.file_id AND m.service_pattern_id = b.service_pattern_id) AS vehicle_journeys
FROM bridge b GROUP BY b.file_id, b.service_pattern_id""",
    by_file=True,
)
def pattern_members(t: Tables) -> DataFrame:
    return pat.pattern_members(_bridge(t), _journey_map(t))


@query(
    "pattern_direction",
    _BRIDGE_SQL + """,
counted AS (SELECT file_id, service_pattern_id,
    CASE o_orderstatus WHEN 'F' THEN 'inbound' WHEN 'O' THEN 'outbound' ELSE 'clockwise' END AS direction,
    count(*) AS n, min(ordinal) AS first FROM bridge GROUP BY ALL)
SELECT file_id, service_pattern_id, direction FROM (
  SELECT *, row_number() OVER (PARTITION BY file_id, service_pattern_id ORDER BY n DESC, first) AS r FROM counted) WHERE r = 1""",
    by_file=True,
)
def pattern_direction(t: Tables) -> DataFrame:
    return pat.pattern_direction(_bridge(t), net.journey_patterns(t))


@query(
    "pattern_line",
    _JOURNEY_MAP_SQL + """,
counted AS (SELECT file_id, service_pattern_id, line_ref, count(*) AS n, min(ordinal) AS first
  FROM mapped WHERE service_pattern_id IS NOT NULL GROUP BY ALL)
SELECT file_id, service_pattern_id, line_ref FROM (
  SELECT *, row_number() OVER (PARTITION BY file_id, service_pattern_id ORDER BY n DESC, first) AS r FROM counted) WHERE r = 1""",
    by_file=True,
)
def pattern_line(t: Tables) -> DataFrame:
    return pat.pattern_line(_journey_map(t), net.vehicle_journeys(t))


@query(
    "patterns_of_service",
    _BRIDGE_SQL + "SELECT DISTINCT file_id, service_code AS used_by, service_pattern_id FROM bridge",
    by_file=True,
)
def patterns_of_service(t: Tables) -> DataFrame:
    return pat.patterns_of_service(_bridge(t), net.journey_patterns(t))


@query(
    "supplier_majority_flag",
    """WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first
  FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first, l_returnflag) AS r FROM c) WHERE r = 1""",
)
def supplier_majority_flag(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_suppkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal")
    )
    return pat.majority(rows, ["l_suppkey"], "l_returnflag", "ordinal")


_PATTERN_STOPS_SQL = _BRIDGE_SQL + """,
pattern_stops AS (SELECT DISTINCT b.file_id, b.service_pattern_id, s.stop_ref FROM bridge b JOIN seq s ON s.jp_id = b.jp_id)
"""


def _pattern_stops(t: Tables) -> DataFrame:
    patterns = pat.patterns_with_stops(net.journey_patterns(t), _sequence(t))
    return patterns.select("file_id", "service_pattern_id", F.explode("stops").alias("stop_ref"))


@query(
    "pattern_localities",
    _PATTERN_STOPS_SQL + """
SELECT DISTINCT file_id, service_pattern_id, 'E' || (p_partkey % 40) AS locality_id
FROM pattern_stops JOIN part ON 'ST' || p_partkey = stop_ref WHERE p_partkey % 4 <> 0""",
    by_file=True,
)
def pattern_localities(t: Tables) -> DataFrame:
    return pat.pattern_localities(_pattern_stops(t), net.stops(t))


@query(
    "pattern_admin_areas",
    _PATTERN_STOPS_SQL + """
SELECT DISTINCT file_id, service_pattern_id, CAST(p_partkey % 9 AS INTEGER) AS admin_area_id
FROM pattern_stops JOIN part ON 'ST' || p_partkey = stop_ref WHERE p_partkey % 6 <> 0""",
    by_file=True,
)
def pattern_admin_areas(t: Tables) -> DataFrame:
    return pat.pattern_admin_areas(_pattern_stops(t), net.stops(t))


@query(
    "pattern_metadata",
    _BRIDGE_SQL + """,
p AS (SELECT file_id, service_pattern_id, min(jp_id) AS jp, min(service_code) AS service_code,
    min(CASE o_orderstatus WHEN 'F' THEN 'inbound' WHEN 'O' THEN 'outbound' ELSE 'clockwise' END) AS direction,
    max(num_stops) AS n, min(ordinal) AS ordinal FROM bridge GROUP BY file_id, service_pattern_id),
e AS (SELECT jp_id, min_by(stop_ref, pos) AS a, max_by(stop_ref, pos) AS b FROM seq GROUP BY jp_id),
q AS (SELECT p.*, x.p_name || ' ' || x.p_partkey AS fs, y.p_name || ' ' || y.p_partkey AS ls,
    'L' || (ordinal % 5) AS line_id, service_code = 'SV0' AS known_service
  FROM p LEFT JOIN e ON e.jp_id = p.jp LEFT JOIN part x ON 'ST' || x.p_partkey = a LEFT JOIN part y ON 'ST' || y.p_partkey = b),
r AS (SELECT *, CASE WHEN fs IS NOT NULL AND ls IS NOT NULL THEN fs WHEN known_service THEN 'Depot' ELSE 'unknown' END AS origin,
    CASE WHEN fs IS NOT NULL AND ls IS NOT NULL THEN ls WHEN known_service THEN 'Station' ELSE 'unknown' END AS destination FROM q)
SELECT file_id, service_pattern_id, origin, destination,
  CASE WHEN line_id = 'L4' THEN 'unknown'
       WHEN direction = 'inbound' AND line_id <> 'L1' THEN 'in ' || line_id
       WHEN direction IN ('outbound', 'clockwise') AND line_id <> 'L2' THEN 'out ' || line_id
       WHEN origin <> 'unknown' AND destination <> 'unknown' THEN origin || ' - ' || destination
       ELSE 'unknown' END AS description,
  CASE WHEN line_id = 'L4' THEN 'unknown' ELSE 'Line ' || line_id END AS line_name
FROM r""",
    by_file=True,
)
def pattern_metadata(t: Tables) -> DataFrame:
    stops, jps = net.stops(t), net.journey_patterns(t)
    # Worked out in a stage of its own, and once: both readers take the same columns.
    sequence = _sequence(t).repartition("file_id", "jp_id")
    bridge = pat.service_pattern_bridge(jps, sequence)
    ends = seq.terminal_stops(sequence, stops)
    direction = jps.select("file_id", "jp_id", "direction")
    patterns = (
        bridge.join(direction, ["file_id", "jp_id"])
        .groupBy("file_id", "service_pattern_id")
        .agg(
            F.min("jp_id").alias("jp_id"),
            F.min("service_code").alias("service_code"),
            F.min("direction").alias("direction"),
            F.min("ordinal").alias("ordinal"),
        )
        .join(ends, ["file_id", "jp_id"], "left")
        .select(
            "file_id",
            "service_pattern_id",
            "service_code",
            "direction",
            F.concat(F.lit("L"), F.col("ordinal") % 5).alias("line_id"),
            F.col("origin").alias("first_stop_name"),
            F.col("destination").alias("last_stop_name"),
        )
    )
    # Lines L0..L3 per file; L1 has no inbound text, L2 no outbound text.
    files = jps.select("file_id").distinct().repartition("file_id")
    line_id = F.explode(F.array(*[F.lit(f"L{i}") for i in range(4)])).alias("line_id")
    none = F.lit(None).cast("string")
    lines = files.select("file_id", line_id).select(
        "file_id",
        "line_id",
        F.concat(F.lit("Line "), "line_id").alias("line_name"),
        F.struct(F.when(F.col("line_id") != "L1", F.concat(F.lit("in "), "line_id")).otherwise(none).alias("description")).alias("inbound"),
        F.struct(F.when(F.col("line_id") != "L2", F.concat(F.lit("out "), "line_id")).otherwise(none).alias("description")).alias("outbound"),
    )
    services = files.select(
        "file_id", F.lit("SV0").alias("service_code"), F.lit("Depot").alias("origin"), F.lit("Station").alias("destination")
    )
    return pat.pattern_metadata(patterns, services, lines)


@query(
    "journey_reference_chain",
    """WITH RECURSIVE vj AS (SELECT o_orderkey, 'F' || (o_orderkey // 100) AS file_id, 'VJ' || o_orderkey AS vj_code,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'JP' || o_orderkey END AS jp_ref,
    CASE WHEN o_orderkey % 5 = 0 THEN 'VJ' || (o_orderkey - CASE WHEN o_orderkey % 10 = 0 THEN 5 ELSE 1 END) END AS vj_ref FROM orders),
  walk AS (SELECT file_id, vj_code, jp_ref, vj_ref FROM vj
    UNION ALL SELECT w.file_id, w.vj_code, v.jp_ref, v.vj_ref FROM walk w JOIN vj v
      ON w.jp_ref IS NULL AND v.file_id = w.file_id AND v.vj_code = w.vj_ref)
SELECT file_id, vj_code, max(jp_ref) AS jp_ref FROM walk GROUP BY ALL""",
)
def journey_reference_chain(t: Tables) -> DataFrame:
    return res.journey_reference_chain(net.vehicle_journeys(t))


@query(
    "journeys_by_line",
    """SELECT 'F' || (o_orderkey // 100) AS file_id, 'VJ' || o_orderkey AS vj_code, 'L' || (o_custkey % 4) AS line_id,
  'Line ' || (o_custkey % 4) AS line_name FROM orders WHERE o_custkey % 4 < 3""",
)
def journeys_by_line(t: Tables) -> DataFrame:
    vjs = net.vehicle_journeys(t)
    ids = F.explode(F.array(*[F.lit(str(i)) for i in range(3)])).alias("n")
    lines = vjs.select("file_id").distinct().select("file_id", ids).select(
        "file_id", F.concat(F.lit("L"), "n").alias("line_id"), F.concat(F.lit("Line "), "n").alias("line_name")
    )
    return res.journeys_by_line(vjs, lines).select(
        "file_id", "vj_code", F.col("line_ref").alias("line_id"), "line_name"
    )


@query(
    "vehicle_journey_rows",
    """SELECT 'F' || (o_orderkey // 100) AS file_id, 'VJ' || o_orderkey AS vj_code, 'JP' || o_orderkey AS jp_ref,
  'L' || (o_custkey % 4) AS line_ref,
  CASE WHEN o_orderkey % 50 = 7 THEN 'late' ELSE
    lpad(CAST((o_orderkey * 997 % 86400) // 3600 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST((o_orderkey * 997 % 86400) % 3600 // 60 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST((o_orderkey * 997 % 86400) % 60 AS VARCHAR), 2, '0') END AS start_time,
  CASE o_orderstatus WHEN 'F' THEN 'inbound' WHEN 'O' THEN 'outbound' ELSE 'clockwise' END AS direction,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'J' || (o_orderkey % 1000) ELSE '' END AS journey_code,
  CASE WHEN o_orderkey % 4 = 0 THEN 'B' || (o_orderkey % 20) END AS block_number,
  o_orderkey % 3 = 0 AS departure_day_shift
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    by_file=True,
)
def vehicle_journey_rows(t: Tables) -> DataFrame:
    return rollup.vehicle_journey_rows(net.vehicle_journeys(t), net.journey_patterns(t))


@query(
    "duplicate_journeys",
    """SELECT conv_id // 50 AS file_id, role, CAST(length(text) % 40 AS INTEGER) AS jp, count(*) AS journeys,
  string_agg('V' || lpad(CAST(conv_id AS VARCHAR), 9, '0') || '-' || turn, ',' ORDER BY 'V' || lpad(CAST(conv_id AS VARCHAR), 9, '0') || '-' || turn) AS vj_codes
FROM conversations GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_journeys(t: Tables) -> DataFrame:
    code = F.concat(F.lit("V"), F.lpad(F.col("conv_id").cast("string"), 9, "0"), F.lit("-"), F.col("turn"))
    journeys = t.conversations.select(
        F.floor(F.col("conv_id") / 50).alias("file_id"),
        F.lit("08:00:00").alias("departure_time"),
        (F.length("text") % 40).alias("jp_ref"),
        F.col("role").alias("profile"),
        code.alias("vj_code"),
    )
    out = pat.duplicate_journeys(journeys)
    return out.select(
        "file_id", F.col("profile").alias("role"), F.col("jp_ref").alias("jp"), "journeys", "vj_codes"
    )


@query(
    "iso_durations",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE l_linenumber % 5
  WHEN 0 THEN l_quantity * 60 WHEN 1 THEN l_quantity * 3600 + l_suppkey WHEN 2 THEN -(l_quantity * 86400 + 90)
  WHEN 3 THEN l_quantity + 0.5 ELSE 0 END AS DOUBLE) AS seconds FROM lineitem""",
)
def iso_durations(t: Tables) -> DataFrame:
    n, q = F.col("l_linenumber") % 5, F.col("l_quantity").cast("int")
    text = (
        F.when(n == 0, F.concat(F.lit("PT"), q, F.lit("M")))
        .when(n == 1, F.concat(F.lit("PT"), q, F.lit("H"), "l_suppkey", F.lit("S")))
        .when(n == 2, F.concat(F.lit("-P"), q, F.lit("DT1M30S")))
        .when(n == 3, F.concat(F.lit("PT"), q, F.lit(".5S")))
        .otherwise(F.concat(F.lit("about "), q, F.lit("M")))
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", duration_seconds(text).alias("seconds")
    )


def _flexible(t: Tables) -> tuple[DataFrame, DataFrame]:
    """An order is a flexible pattern and journey, its lines are stops and zones."""
    file_id = F.floor(F.col("l_orderkey") / 100).alias("file_id")
    stops = net.link_rows(t).select(
        file_id,
        F.concat(F.lit("JP"), "l_orderkey").alias("jp_id"),
        (F.col("half") == "A").alias("in_sequence"),
        F.col("link_pos").alias("stop_pos"),
        F.concat(F.lit("ST"), F.col("l_partkey") * 2).alias("stop_ref"),
        F.when(F.col("l_quantity") > 25, "principalPoint").alias("timing_status"),
        ((F.col("half") == "B") | (F.col("l_returnflag") == "R")).alias("is_flexible"),
    )
    journeys = t.orders.select(
        F.floor(F.col("o_orderkey") / 100).alias("file_id"),
        F.concat(F.lit("VJ"), "o_orderkey").alias("vj_code"),
        F.concat(F.lit("JP"), "o_orderkey").alias("jp_ref"),
    )
    return stops, journeys


@query(
    "flexible_stop_sequence",
    "WITH " + NETWORK_SQL + """
SELECT f AS file_id, jp_id, CAST(row_number() OVER (PARTITION BY jp_id ORDER BY half, link_pos) - 1 AS INTEGER) AS pos,
  'ST' || (l_partkey * 2) AS stop_ref, half = 0 AS in_sequence FROM links""",
)
def flexible_stop_sequence(t: Tables) -> DataFrame:
    return seq.flexible_stop_sequence(_flexible(t)[0])


@query(
    "flexible_stop_rows",
    "WITH " + NETWORK_SQL + """,
known AS (SELECT f, l_orderkey, jp_id, l_partkey * 2 AS p, l_quantity > 25 AND half = 0 AND l_returnflag <> 'R' AS tp,
  row_number() OVER (PARTITION BY jp_id ORDER BY half, link_pos) - 1 AS n FROM links
  WHERE l_partkey * 2 IN (SELECT p_partkey FROM part))
SELECT f AS file_id, 'VJ' || l_orderkey AS vj_code, jp_id, 'ST' || p AS atco_code, p_name || ' ' || p AS common_name,
  CAST(n AS INTEGER) AS auto_sequence_number, CAST(NULL AS VARCHAR) AS departure_time, tp AS is_timing_point, 3 AS stop_activity_id
FROM known JOIN part ON p_partkey = p""",
)
def flexible_stop_rows(t: Tables) -> DataFrame:
    stops, journeys = _flexible(t)
    return seq.flexible_stop_rows(journeys, stops, net.stops(t))
