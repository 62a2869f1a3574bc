"""Registered queries: geometry, track distances, similarity, consolidation.

Embedding components, scaled to degrees, are the points of a track; a label is
a stop pair.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import geo
from headway.operators import sequence as seq
from headway.operators import tracks as trk
from headway.operators.components import connected_components
from headway.plans import network as net
from headway.plans.network import STOP_SEQUENCE_SQL
from headway.plans.registry import Tables, query
from headway.session import staged

R = geo.EARTH_RADIUS


def _point(i: int, scale: float) -> Column:
    e = F.col("embedding")
    return F.struct(
        (e[2 * i].cast("double") * scale - 1).alias("lon"),
        (e[2 * i + 1].cast("double") * scale + 52).alias("lat"),
    )


def _tracks(t: Tables, points: int = 3, scale: float = 0.01) -> DataFrame:
    return t.embeddings.select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("A"), "label").alias("from_atco_code"),
        F.concat(F.lit("B"), "label").alias("to_atco_code"),
        F.array(*[_point(i, scale) for i in range(points)]).alias("points"),
    )


def _sql_point(i: int, scale: float) -> str:
    return (
        f"CAST(embedding[{2 * i + 1}] AS DOUBLE) * {scale} - 1 AS x{i}, "
        f"CAST(embedding[{2 * i + 2}] AS DOUBLE) * {scale} + 52 AS y{i}"
    )


def _sql_haversine(x1: str, y1: str, x2: str, y2: str) -> str:
    x1, y1, x2, y2 = (f"({v})" for v in (x1, y1, x2, y2))
    return (
        f"2 * {R} * asin(sqrt(pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) * cos(radians({y2}))"
        f" * pow(sin(radians({x2} - {x1}) / 2), 2)))"
    )


def _sql_segment(x1: str, y1: str, x2: str, y2: str) -> str:
    """Another way than the library's: the chord in space, bent to the arc (exact to a micrometre at a kilometre)."""
    a, b = geo.WGS84_A, geo.WGS84_B
    e2 = 1 - (b / a) ** 2

    def place(x: str, y: str) -> tuple[str, str, str]:
        nu = f"({a} / sqrt(1 - {e2!r} * pow(sin(radians({y})), 2)))"
        return (
            f"{nu} * cos(radians({y})) * cos(radians({x}))",
            f"{nu} * cos(radians({y})) * sin(radians({x}))",
            f"{1 - e2!r} * {nu} * sin(radians({y}))",
        )

    square = " + ".join(f"pow({p} - {q}, 2)" for p, q in zip(place(x1, y1), place(x2, y2), strict=True))
    return f"(sqrt({square}) * (1 + ({square}) / (24 * pow({R}, 2))))"


_T3 = "t AS (SELECT vec_id, label, " + ", ".join(_sql_point(i, 0.01) for i in range(3)) + " FROM embeddings)"


@query(
    "haversine",
    f"WITH {_T3} SELECT vec_id, round({_sql_haversine('x0', 'y0', 'x1', 'y1')}, 4) AS metres FROM t",
)
def haversine(t: Tables) -> DataFrame:
    p, q = F.col("points")[0], F.col("points")[1]
    metres = geo.haversine(p["lon"], p["lat"], q["lon"], q["lat"])
    return _tracks(t).select(F.col("id").alias("vec_id"), F.round(metres, 4).alias("metres"))


@query(
    "track_rows",
    f"""WITH {_T3}, m AS (SELECT *, CAST(floor({_sql_segment('x0', 'y0', 'x1', 'y1')} + {_sql_segment('x1', 'y1', 'x2', 'y2')}) AS INTEGER) AS len FROM t),
last AS (SELECT vec_id % 7 AS f, label, max(vec_id) AS vec_id FROM m WHERE vec_id % 5 <> 0 GROUP BY ALL)
SELECT 'F' || f AS file_id, 'A' || m.label AS from_atco_code, 'B' || m.label AS to_atco_code,
  CASE WHEN vec_id % 3 = 0 THEN CAST(vec_id AS INTEGER) ELSE len END AS distance, len AS coord_distance FROM last JOIN m USING (vec_id)""",
)
def track_rows(t: Tables) -> DataFrame:
    links = _tracks(t).select(
        F.concat(F.lit("F"), F.col("id") % 7).alias("file_id"),
        F.col("from_atco_code").alias("from_stop"),
        F.col("to_atco_code").alias("to_stop"),
        F.when(F.col("id") % 5 == 0, F.slice("points", 1, 1)).otherwise(F.col("points")).alias("points"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("int")).alias("distance"),
        F.col("id").alias("ordinal"),
    )
    return trk.track_rows(links).drop("points")


@query(
    "missing_track_pairs",
    """SELECT DISTINCT 'A' || (l_suppkey % 60) AS from_stop, 'B' || (l_partkey % 60) AS to_stop FROM lineitem
EXCEPT SELECT 'A' || label, 'B' || label FROM embeddings""",
)
def missing_track_pairs(t: Tables) -> DataFrame:
    wanted = t.lineitem.select(
        F.concat(F.lit("A"), F.col("l_suppkey") % 60).alias("from_stop"),
        F.concat(F.lit("B"), F.col("l_partkey") % 60).alias("to_stop"),
    )
    return trk.missing_pairs(wanted, _tracks(t))


def _pattern_tracks(t: Tables) -> DataFrame:
    """Tracks between the stops ST0..ST10, one per code pair of the suppliers."""
    key = F.col("id")
    a, b = F.col("a"), F.col("b")

    def at(n: Column, d: float) -> Column:
        return F.struct((n * 0.01 + d).alias("lon"), (n * 0.005 + 52 + d).alias("lat"))

    mid = at((a + b) / 2, 0.001)
    points = F.when(key % 9 == 0, F.array(at(a, 0.0), at(b, 0.0))).otherwise(F.array(at(a, 0.0), mid, at(b, 0.0)))
    chosen = net.supplier_pairs(t).select(
        key,
        F.concat(F.lit("ST"), a).alias("from_atco_code"),
        F.concat(F.lit("ST"), b).alias("to_atco_code"),
        points.alias("points"),
        F.when(key % 4 != 0, (key * 10).cast("int")).alias("distance"),
        (key * 11).cast("int").alias("coord_distance"),
    )
    # An older track for every other pair: it is stored too, and must not count.
    older = chosen.where(key % 2 == 0).select(
        (-key).alias("id"), "from_atco_code", "to_atco_code",
        F.reverse("points").alias("points"), F.lit(1).alias("distance"), F.lit(1).alias("coord_distance"),
    )
    return chosen.unionByName(older)


_PAIRS_SQL = STOP_SEQUENCE_SQL + """,
pairs AS (SELECT * FROM (SELECT file_id, jp_id, pos, stop_ref AS a, lead(stop_ref) OVER (PARTITION BY jp_id ORDER BY pos) AS b FROM seq) WHERE b IS NOT NULL),
trk AS (SELECT id, 'ST' || ka AS a, 'ST' || kb AS b, CASE WHEN id % 4 <> 0 THEN id * 10 END AS distance, id * 11 AS coord,
    CASE WHEN id % 9 = 0 THEN 2 ELSE 3 END AS n, ka, kb
  FROM (SELECT min(s_suppkey) AS id, s_suppkey % 11 AS ka, (s_suppkey // 11) % 11 AS kb FROM supplier GROUP BY ALL)),
joined AS (SELECT p.*, id, distance, coord, n, ka, kb FROM pairs p LEFT JOIN trk USING (a, b))
"""


def _pairs(t: Tables) -> DataFrame:
    links = seq.pattern_links(net.journey_patterns(t), net.timing_links(t))
    stops = seq.stop_sequence(links, net.placeholder_stops(t))
    return seq.consecutive_pairs(stops, ["file_id", "jp_id"], ["pos"])


@query(
    "sufficient_tracks",
    _PAIRS_SQL + "SELECT file_id, jp_id, bool_and(coalesce(n >= 3, false)) AS sufficient FROM joined GROUP BY ALL",
    by_file=True,
)
def sufficient_tracks(t: Tables) -> DataFrame:
    return trk.sufficient_tracks(_pairs(t), _pattern_tracks(t))


@query(
    "pattern_distance",
    _PAIRS_SQL + f""",
d AS (SELECT file_id, jp_id, bool_and(coalesce(n >= 3, false)) AS ok, sum(coalesce(distance, 0)) AS td, sum(coalesce(coord, 0)) AS tc,
  sum({_sql_haversine('x.p_partkey % 600 / 100.0 - 5', 'x.p_partkey % 500 / 100.0 + 50', 'y.p_partkey % 600 / 100.0 - 5', 'y.p_partkey % 500 / 100.0 + 50')}) AS hv
  FROM joined JOIN part x ON 'ST' || x.p_partkey = a JOIN part y ON 'ST' || y.p_partkey = b GROUP BY ALL),
e AS (SELECT d.*, CASE WHEN CAST(substr(jp_id, 3) AS BIGINT) % 6 = 0 THEN CAST(substr(jp_id, 3) AS BIGINT) END AS rd FROM d)
SELECT file_id, jp_id, CAST(CASE WHEN ok THEN td ELSE coalesce(rd, floor(hv)) END AS BIGINT) AS distance,
  CAST(CASE WHEN ok THEN tc END AS BIGINT) AS coord_distance,
  CASE WHEN ok THEN 'tracks' WHEN rd IS NOT NULL THEN 'routed' ELSE 'stops' END AS distance_source FROM e""",
    by_file=True,
)
def pattern_distance(t: Tables) -> DataFrame:
    pairs = _pairs(t)
    number = F.col("o_orderkey")
    routed = t.orders.where("o_orderkey % 6 = 0").select(
        F.concat(F.lit("F"), F.floor(number / 100)).alias("file_id"),
        F.concat(F.lit("JP"), number).alias("jp_id"),
        number.alias("distance"),
    )
    return trk.pattern_distance(pairs, _pattern_tracks(t), net.stops(t), routed)


@query(
    "pattern_geometry",
    _PAIRS_SQL + """,
g AS (SELECT *, row_number() OVER (PARTITION BY jp_id ORDER BY pos) AS r,
    coalesce(sum(n - 1) OVER (PARTITION BY jp_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM joined WHERE id IS NOT NULL),
pt AS (SELECT file_id, jp_id, 0 AS i, ka * 0.01 AS lon, ka * 0.005 + 52 AS lat FROM g WHERE r = 1
  UNION ALL SELECT file_id, jp_id, before + 1, (ka + kb) / 2.0 * 0.01 + 0.001, (ka + kb) / 2.0 * 0.005 + 52 + 0.001 FROM g WHERE n = 3
  UNION ALL SELECT file_id, jp_id, before + n - 1, kb * 0.01, kb * 0.005 + 52 FROM g)
SELECT file_id, jp_id, CAST(count(*) AS INTEGER) AS points, round(sum((i + 1) * lon), 6) AS lon_by_place, round(sum((i + 1) * lat), 6) AS lat_by_place
FROM pt GROUP BY ALL""",
    by_file=True,
)
def pattern_geometry(t: Tables) -> DataFrame:
    lines = trk.pattern_geometry(_pairs(t), _pattern_tracks(t))

    def by_place(part: str) -> Column:
        placed = F.transform("points", lambda p, i: (i + 1) * p[part])
        return F.round(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 6)

    return lines.select(
        "file_id", "jp_id", F.size("points").alias("points"),
        by_place("lon").alias("lon_by_place"), by_place("lat").alias("lat_by_place"),
    )


@query(
    "pattern_shape",
    STOP_SEQUENCE_SQL + """,
p AS (SELECT file_id, jp_id, pos, p_partkey % 600 / 100.0 - 5 AS lon FROM seq JOIN part ON 'ST' || p_partkey = stop_ref)
SELECT file_id, jp_id, CASE WHEN count(*) >= 2 THEN CAST(count(*) AS INTEGER) END AS points,
  CASE WHEN count(*) >= 2 THEN round(min_by(lon, pos), 6) END AS first_lon FROM p GROUP BY ALL""",
    by_file=True,
)
def pattern_shape(t: Tables) -> DataFrame:
    links = seq.pattern_links(net.journey_patterns(t), net.timing_links(t))
    stops = seq.stop_sequence(links, net.placeholder_stops(t))
    located = stops.join(
        net.stops(t).select(F.col("atco_code").alias("stop_ref"), "lon", "lat"), "stop_ref"
    ).withColumn("k", F.lit(0))
    return trk.pattern_line(located).select(
        "file_id",
        "jp_id",
        F.when(F.col("points").isNotNull(), F.size("points")).alias("points"),
        F.round(F.col("points")[0]["lon"], 6).alias("first_lon"),
    )


# --------------------------------------------------------- similarity

_SCALE, _THRESHOLD = 0.002, 28.0
_DEG = math.pi / 180 * R


def _sql_planar() -> str:
    cols = []
    for side in "ab":
        for i in range(3):
            cols.append(f"({side}.x{i} - a.x_min) * {_DEG} * cos(radians(a.y_min)) AS {side}x{i}")
            cols.append(f"({side}.y{i} - a.y_min) * {_DEG} AS {side}y{i}")
    return ", ".join(cols)


def _sql_to_segment(p: str, s: str, i: int, j: int) -> str:
    px, py, ax, ay, bx, by = f"{p[0]}x{p[1]}", f"{p[0]}y{p[1]}", f"{s}x{i}", f"{s}y{i}", f"{s}x{j}", f"{s}y{j}"
    t = (
        f"least(1, greatest(0, (({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({by} - {ay}))"
        f" / nullif(pow({bx} - {ax}, 2) + pow({by} - {ay}, 2), 0)))"
    )
    return f"(pow({px} - {ax} - {t} * ({bx} - {ax}), 2) + pow({py} - {ay} - {t} * ({by} - {ay}), 2))"


def _sql_one_way(p: str, s: str) -> str:
    near = [f"least({_sql_to_segment(p + str(i), s, 0, 1)}, {_sql_to_segment(p + str(i), s, 1, 2)})" for i in range(3)]
    return f"greatest({', '.join(near)})"


_SIMILAR_SQL = (
    "t AS (SELECT *, least(x0, x1, x2) AS x_min, least(y0, y1, y2) AS y_min FROM (SELECT vec_id, label, "
    + ", ".join(_sql_point(i, _SCALE) for i in range(3))
    + " FROM embeddings)),\n"
    + "xy AS (SELECT a.vec_id AS track_a, b.vec_id AS track_b, a.label, "
    + _sql_planar()
    + " FROM t a JOIN t b ON a.label = b.label AND a.vec_id < b.vec_id),\n"
    + "similar_pairs AS (SELECT track_a, track_b, label, sqrt(greatest("
    + f"{_sql_one_way('a', 'b')}, {_sql_one_way('b', 'a')})) AS distance FROM xy),\n"
    + f"near AS (SELECT * FROM similar_pairs WHERE distance < {_THRESHOLD})\n"
)
_COMPONENT_SQL = (
    "WITH RECURSIVE "
    + _SIMILAR_SQL
    + """,
edges AS (SELECT track_a AS s, track_b AS d FROM near UNION SELECT track_b, track_a FROM near),
reach AS (SELECT s AS id, s AS other FROM edges UNION SELECT r.id, e.d FROM reach r JOIN edges e ON e.s = r.other),
comp AS (SELECT id AS track_id, min(other) AS canonical_id FROM reach GROUP BY id)
"""
)


def _similar(t: Tables) -> DataFrame:
    return trk.similar_tracks(_tracks(t, 3, _SCALE), _THRESHOLD)


@query(
    "similar_tracks",
    "WITH " + _SIMILAR_SQL + "SELECT 'A' || label AS from_atco_code, 'B' || label AS to_atco_code, track_a, track_b, round(distance, 4) AS distance FROM near",
)
def similar_tracks(t: Tables) -> DataFrame:
    return _similar(t).withColumn("distance", F.round("distance", 4))


@query("canonical_tracks", _COMPONENT_SQL + "SELECT * FROM comp")
def canonical_tracks(t: Tables) -> DataFrame:
    return trk.canonical_tracks(_similar(t))


@query("nightly_consolidation", _COMPONENT_SQL + "SELECT * FROM comp")
def nightly_consolidation(t: Tables) -> DataFrame:
    """Every third track comes on a second night, which compares and joins these alone."""
    tracks = _tracks(t, 3, _SCALE)
    new = tracks.where("id % 3 = 0").select("id")
    first = staged(trk.canonical_tracks(trk.similar_tracks(tracks.where("id % 3 <> 0"), _THRESHOLD)))
    return trk.extended_canonical(first, trk.similar_tracks(tracks, _THRESHOLD, new))


@query(
    "consolidation_report",
    _COMPONENT_SQL + """,
refs AS (SELECT l_orderkey, l_partkey % (SELECT count(*) FROM embeddings) AS tid FROM lineitem)
SELECT 'tracks_deleted' AS measure, count(*) AS n FROM comp WHERE track_id <> canonical_id
UNION ALL SELECT 'references_moved', count(*) FROM refs JOIN comp ON tid = track_id WHERE track_id <> canonical_id""",
)
def consolidation_report(t: Tables) -> DataFrame:
    return trk.consolidate(_tracks(t, 3, _SCALE), _references(t), _THRESHOLD)[2]


def _references(t: Tables) -> DataFrame:
    size = t.embeddings.count()
    return t.lineitem.select(
        F.col("l_orderkey").alias("service_pattern_id"),
        "l_linenumber",
        (F.col("l_partkey") % size).alias("tracks_id"),
    )


@query(
    "repointed_references",
    _COMPONENT_SQL + """
SELECT l_orderkey AS service_pattern_id, l_linenumber, coalesce(canonical_id, l_partkey % (SELECT count(*) FROM embeddings)) AS tracks_id
FROM lineitem LEFT JOIN comp ON track_id = l_partkey % (SELECT count(*) FROM embeddings)""",
)
def repointed_references(t: Tables) -> DataFrame:
    return trk.consolidate(_tracks(t, 3, _SCALE), _references(t), _THRESHOLD)[1]


@query(
    "connected_components",
    """SELECT o_orderkey AS id, first AS component FROM (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first,
  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n > 1""",
)
def components(t: Tables) -> DataFrame:
    """Orders tied to the first of the same customer and status, and those to
    the last of the customer."""
    by_status = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("dst"))
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("src"))
    edges = t.orders.join(by_status, ["o_custkey", "o_orderstatus"]).select(
        F.col("o_orderkey").alias("src"), "dst"
    ).unionByName(by_status.join(last, "o_custkey").select("src", "dst"))
    return connected_components(edges)


@query(
    "grid_round_trip",
    "SELECT o_orderkey AS id, true AS easting_returns, true AS northing_returns FROM orders",
)
def grid_round_trip(t: Tables) -> DataFrame:
    """Grid to degrees and back: within the metre that rounding to whole metres costs."""
    key = F.col("o_orderkey")
    grid = t.orders.select(
        key.alias("id"),
        (200000 + key * 7919 % 400000).alias("e"),
        (60000 + key * 104729 % 800000).alias("n"),
    ).withColumn("p", geo.grid_to_lonlat(F.col("e"), F.col("n")))
    back = grid.withColumn("g", geo.lonlat_to_grid(F.col("p.lon"), F.col("p.lat")))
    return back.select(
        "id",
        (F.abs(F.col("g.easting") - F.col("e")) <= 1).alias("easting_returns"),
        (F.abs(F.col("g.northing") - F.col("n")) <= 1).alias("northing_returns"),
    )


@query(
    "track_insert",
    """SELECT 'A' || label AS from_atco_code, 'B' || label AS to_atco_code, CAST(count(*) AS BIGINT) AS tracks,
  false AS is_new FROM embeddings GROUP BY label
UNION ALL SELECT DISTINCT 'A' || (l_suppkey % 12), 'B' || (l_suppkey % 12), 1, true FROM lineitem
WHERE l_suppkey % 12 NOT IN (SELECT label FROM embeddings)""",
)
def track_insert(t: Tables) -> DataFrame:
    key = F.col("l_suppkey") % 12
    point = lambda d: F.struct((key * 0.1 + d).alias("lon"), (F.lit(52.0) + d).alias("lat"))
    incoming = t.lineitem.select(
        F.concat(F.lit("A"), key).alias("from_atco_code"),
        F.concat(F.lit("B"), key).alias("to_atco_code"),
        F.array(point(0.0), point(0.1)).alias("points"),
    ).distinct()
    merged = trk.insert_tracks(_tracks(t).withColumn("is_new", F.lit(False)), incoming)
    return merged.groupBy("from_atco_code", "to_atco_code", F.coalesce("is_new", F.lit(True)).alias("is_new")).agg(
        F.count(F.lit(1)).alias("tracks")
    )
