"""Tracks: lines between stops, distances, similarity and consolidation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.geo import (
    EARTH_RADIUS,
    geodesic_length,
    haversine,
)
from headway.operators.components import connected_components, extended_components
from headway.operators.nearness import forest, nearer
from headway.session import staged

DEFAULT_THRESHOLD = 20.0
SNAP_METRES = 15.0
DEGREE = 3.141592653589793 / 180 * EARTH_RADIUS
# Lines nearer than a distance have bounds nearer than it in any direction: along the
# axes and (of factors for longitude and latitude) about the diagonals of middle latitudes.
DIRECTIONS = {"lon": (1.0, 0.0), "lat": (0.0, 1.0), "up": (0.6, 1.0), "down": (0.6, -1.0)}
BOUNDS = tuple(f"{name}_{side}" for name in DIRECTIONS for side in ("min", "max"))
# Metres that rounding may not decide, and pairs of lines one task compares.
SLACK = 1e-3
PAIRS_AT_ONCE = 1 << 22


def track_rows(route_links: DataFrame) -> DataFrame:
    """Track rows from route links with at least two points.

    ``distance`` is the given one, else the length along the points;
    ``coord_distance`` is always that length. Of several links between the same
    stops the last in the document counts.
    """
    usable = route_links.where(F.size("points") >= 2)
    chosen = usable.groupBy("file_id", "from_stop", "to_stop").agg(
        F.max_by(F.struct("points", "distance"), "ordinal").alias("t")
    )
    rows = chosen.select(
        "file_id",
        F.col("from_stop").alias("from_atco_code"),
        F.col("to_stop").alias("to_atco_code"),
        F.col("t.points").alias("points"),
        F.col("t.distance").alias("given"),
        geodesic_length(F.col("t.points")).alias("coord_distance"),
    )
    return rows.select(
        "file_id",
        "from_atco_code",
        "to_atco_code",
        "points",
        F.coalesce("given", "coord_distance").alias("distance"),
        "coord_distance",
    )


def with_track_id(tracks: DataFrame) -> DataFrame:
    """Repeatable ids from the stop pair and the points."""
    return tracks.withColumn("id", F.xxhash64("from_atco_code", "to_atco_code", "points"))


def track_lookup(tracks: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One track per stop pair (and ``keys``): the last one, by document order where
    there is one, then by id, then by its points."""
    order = [c for c in ("ordinal", "id", "points") if c in tracks.columns]
    chosen = tracks.groupBy(
        *keys, F.col("from_atco_code").alias("from_stop"), F.col("to_atco_code").alias("to_stop")
    ).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_t"))
    return chosen.select(*keys, "from_stop", "to_stop", "_t.*")


def file_track_sequence(pairs: DataFrame, tracks: DataFrame) -> DataFrame:
    """Tracks along each pattern, out of the tracks of its own file; pairs
    without a track leave gaps in the numbers."""
    lookup = track_lookup(tracks, ["id"], ["file_id"]).withColumnRenamed("id", "tracks_id")
    return pairs.join(lookup, ["file_id", "from_stop", "to_stop"])


def journey_tracks(journeys: DataFrame, pattern_tracks: DataFrame) -> DataFrame:
    """Tracks along each journey, numbered as along its pattern.

    ``journeys(file_id, vj_code, jp_id)``; journeys without a pattern have none.
    """
    along = pattern_tracks.select("file_id", "jp_id", "sequence_number", "tracks_id")
    return journeys.select("file_id", "vj_code", "jp_id").join(along, ["file_id", "jp_id"]).drop("jp_id")


def missing_pairs(wanted: DataFrame, tracks: DataFrame) -> DataFrame:
    """Distinct stop pairs that no stored track covers yet."""
    have = tracks.select(F.col("from_atco_code").alias("from_stop"), F.col("to_atco_code").alias("to_stop"))
    return wanted.select("from_stop", "to_stop").distinct().join(have, ["from_stop", "to_stop"], "left_anti")


def insert_tracks(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append one track per pair not stored yet, so re-runs add no duplicates."""
    body = [c for c in incoming.columns if c not in ("from_atco_code", "to_atco_code")]
    single = track_lookup(incoming, body).withColumnsRenamed({"from_stop": "from_atco_code", "to_stop": "to_atco_code"})
    fresh = with_track_id(single).join(
        existing.select("from_atco_code", "to_atco_code"),
        ["from_atco_code", "to_atco_code"],
        "left_anti",
    )
    return existing.unionByName(fresh, allowMissingColumns=True)


def pattern_line(pattern_stops: DataFrame) -> DataFrame:
    """Line through a pattern's located stops; null under two points.

    ``pattern_stops(file_id, jp_id, pos, k, lon, lat)``; ``k`` orders extra zone
    points after their stop. One row's list is one document's stop list.
    """
    points = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "k", "lon", "lat"))),
        lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")),
    )
    located = pattern_stops.where("lon is not null and lat is not null")
    lines = located.groupBy("file_id", "jp_id").agg(points.alias("points"))
    return lines.withColumn("points", F.when(F.size("points") >= 2, F.col("points")))


def _paired_tracks(pairs: DataFrame, tracks: DataFrame) -> DataFrame:
    """Each pair with its one track; tracks that name a file serve that file only."""
    keys = [k for k in ("file_id",) if k in tracks.columns]
    lookup = track_lookup(tracks, ["points", "distance", "coord_distance"], keys)
    return pairs.join(lookup, [*keys, "from_stop", "to_stop"], "left")


def sufficient_tracks(pairs: DataFrame, tracks: DataFrame) -> DataFrame:
    """Whether every neighbouring pair has a track of three points or more."""
    return (
        _paired_tracks(pairs, tracks)
        .groupBy("file_id", "jp_id")
        .agg(F.bool_and(F.coalesce(F.size("points") >= 3, F.lit(False))).alias("sufficient"))
    )


def pattern_distance(
    pairs: DataFrame,
    tracks: DataFrame,
    stop_points: DataFrame,
    routed: DataFrame | None = None,
) -> DataFrame:
    """Length of each pattern and where it comes from.

    Track sums when every pair has track data, else a routed distance when one
    is supplied, else the great-circle sum over the stops.
    """
    own = [k for k in ("file_id",) if k in stop_points.columns]
    a = stop_points.select(
        *own, F.col("atco_code").alias("from_stop"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")
    )
    b = stop_points.select(
        *own, F.col("atco_code").alias("to_stop"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")
    )
    rows = _paired_tracks(pairs, tracks).join(a, [*own, "from_stop"], "left").join(b, [*own, "to_stop"], "left")
    hop = haversine(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    sums = rows.groupBy("file_id", "jp_id").agg(
        F.bool_and(F.coalesce(F.size("points") >= 3, F.lit(False))).alias("sufficient"),
        F.sum(F.coalesce("distance", F.lit(0))).alias("track_distance"),
        F.sum(F.coalesce("coord_distance", F.lit(0))).alias("track_coord_distance"),
        F.floor(F.sum(hop)).alias("line_distance"),
    )
    if routed is None:
        sums = sums.withColumn("routed_distance", F.lit(None).cast("bigint"))
    else:
        sums = sums.join(
            routed.select("file_id", "jp_id", F.col("distance").alias("routed_distance")),
            ["file_id", "jp_id"],
            "left",
        )
    by_track, by_route = F.col("sufficient"), F.col("routed_distance").isNotNull()
    return sums.select(
        "file_id",
        "jp_id",
        F.when(by_track, F.col("track_distance"))
        .when(by_route, F.col("routed_distance"))
        .otherwise(F.col("line_distance"))
        .cast("bigint")
        .alias("distance"),
        F.when(by_track, F.col("track_coord_distance")).cast("bigint").alias("coord_distance"),
        F.when(by_track, "tracks").when(by_route, "routed").otherwise("stops").alias("distance_source"),
    )


def pattern_geometry(
    pairs: DataFrame, tracks: DataFrame, tolerance: float | None = None
) -> DataFrame:
    """Tracks of a pattern joined in order into one line.

    Each later track starts at the previous one's end: always, or with a
    tolerance only within so many metres. The joint point is kept once when
    snapped. Order along the pattern is kept.
    """
    rows = _paired_tracks(pairs, tracks).where(F.col("points").isNotNull())
    along = Window.partitionBy("file_id", "jp_id").orderBy("sequence_number")
    prev = F.lag(F.element_at("points", -1)).over(along)
    rows = rows.withColumn("prev_end", prev)
    start = F.col("points")[0]
    gap = haversine(F.col("prev_end.lon"), F.col("prev_end.lat"), start["lon"], start["lat"])
    snap = F.col("prev_end").isNotNull()
    if tolerance is not None:
        snap = snap & (gap <= tolerance)
    rest = F.slice("points", F.lit(2), F.greatest(F.size("points") - 1, F.lit(0)))
    rows = rows.withColumn("part", F.when(snap, rest).otherwise(F.col("points")))
    ordered = F.array_sort(F.collect_list(F.struct("sequence_number", "part")))
    return rows.groupBy("file_id", "jp_id").agg(
        F.flatten(F.transform(ordered, lambda p: p["part"])).alias("points")
    )


def _outlines(tracks: DataFrame) -> DataFrame:
    """Every track (``is_new`` or not) without its points: two hashes of them and their bounds."""

    def along(lon: float, lat: float) -> F.Column:
        if not lon or not lat:
            return F.transform("points", lambda p: p["lon"] if lon else p["lat"])
        # Points that lack a coordinate bound nothing across the axes.
        whole = F.forall("points", lambda p: p["lon"].isNotNull() & p["lat"].isNotNull())
        return F.when(whole, F.transform("points", lambda p: lon * p["lon"] + lat * p["lat"]))

    bounds = [
        end(along(*factors)).alias(f"{name}_{side}")
        for name, factors in DIRECTIONS.items()
        for side, end in (("min", F.array_min), ("max", F.array_max))
    ]
    return tracks.select(
        "id",
        "is_new",
        "from_atco_code",
        "to_atco_code",
        F.xxhash64("points").alias("h1"),
        F.xxhash64(F.lit(1), "points").alias("h2"),
        *bounds,
    )


def similar_tracks(tracks: DataFrame, threshold: float = DEFAULT_THRESHOLD, new: DataFrame | None = None) -> DataFrame:
    """Pairs of tracks between the same stops closer than ``threshold`` metres.

    With ``new`` (``id``) only pairs that a new track adds: stop pairs without one are not
    read further, and lines already stored are not compared with each other.

    Copies of one line (equal in a 128-bit hash of their points) are tied to the
    copy with the lowest id, which is all that grouping needs; only distinct
    lines are compared. Distance is the discrete Hausdorff distance on a flat
    projection around the pair.

    Distinct lines meet only inside one (from, to) pair and, within it, in the
    same or a neighbouring cell of a grid over their lower left corner: two
    lines nearer than the threshold have corners nearer than it, so nothing is
    lost. Lines alone in their cells go; the others fetch their points once per
    cell, and a cell's pairs are dealt out over tasks by their number. Only
    pairs whose bounds differ by less than the threshold are measured.
    """
    ends = ["from_atco_code", "to_atco_code"]
    fresh = F.lit(True)
    if new is not None:
        added = new.select("id").distinct().withColumn("added", F.lit(True))
        touched = tracks.join(added, "id").select(*ends).distinct()
        tracks = tracks.join(touched, ends, "left_semi").join(added, "id", "left")
        fresh = F.coalesce("added", F.lit(False))
    outlines = _outlines(tracks.withColumn("is_new", fresh))
    keys = [*ends, "h1", "h2"]
    # A shape is new if all its copies are: pairs of one seen before are known.
    shapes = outlines.groupBy(*keys).agg(
        F.min_by(F.struct("id", "is_new"), "id").alias("first"), F.bool_and("is_new").alias("is_new"), *[F.first(c).alias(c) for c in BOUNDS]
    ).select(*keys, "first.id", F.col("first.is_new").alias("first_new"), "is_new", *BOUNDS)
    shapes = staged(shapes)
    copies = (
        outlines.select(*keys, F.col("id").alias("track_b"), F.col("is_new").alias("b_new"))
        .join(shapes.select(*keys, "id", "first_new"), keys)
        .where((F.col("id") < F.col("track_b")) & (F.col("b_new") | F.col("first_new")))
        .select(
            "from_atco_code",
            "to_atco_code",
            F.col("id").alias("track_a"),
            "track_b",
            F.lit(0.0).alias("distance"),
        )
    )
    return _compared(shapes, tracks.select("id", "points"), threshold).unionByName(copies)


def _compared(shapes: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """Pairs of distinct lines nearer than the threshold, with their distance."""
    # Latitude rows are a threshold high. Longitude cells are as wide as the
    # threshold at the row's own poleward edge plus one row, so neighbours reach.
    row_height = threshold / DEGREE
    boxed = shapes.withColumn("row", F.floor(F.col("lat_min") / row_height))

    def column(row) -> F.Column:
        edge = F.greatest(F.abs(row), F.abs(row + 1)) * row_height
        width = F.lit(row_height) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-6))
        return F.floor(F.col("lon_min") / width)

    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    left = boxed.withColumn("cell_row", F.col("row")).withColumn("cell_col", column(F.col("row")))
    # The right side is copied to every cell a partner could sit in: three rows,
    # three columns of each, computed with that row's cell width.
    right = boxed.withColumn("cell_row", F.explode(F.transform(steps, lambda i: F.col("row") + i)))
    right = right.withColumn(
        "cell_col", F.explode(F.transform(steps, lambda i: column(F.col("cell_row")) + i))
    )
    cell = ["from_atco_code", "to_atco_code", "cell_row", "cell_col"]
    # A cell's own lines are among its right ones, so a product of one is a line alone.
    pairs = F.col("lefts") * F.col("rights")
    crowded = staged(
        left.groupBy(*cell).agg(F.count(F.lit(1)).alias("lefts"))
        .join(right.groupBy(*cell).agg(F.count(F.lit(1)).alias("rights")), cell)
        .where(pairs > 1)
        .select(*cell, F.ceil(pairs / PAIRS_AT_ONCE).alias("parts"), pairs.alias("pairs"))
    )
    work = crowded.agg(F.sum("pairs")).first()[0] or 0
    tasks = 1 + 2 * int(work // PAIRS_AT_ONCE)
    parts = crowded.drop("pairs")
    left = left.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    right = right.join(parts, cell).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    keys = [*cell, "part"]
    body = ["id", "is_new", *BOUNDS, "points"]
    left = left.join(points, "id").select(*keys, *[F.col(c).alias(f"a_{c}") for c in body])
    right = right.join(points, "id").select(*keys, *[F.col(c).alias(f"b_{c}") for c in body])
    near = (F.col("a_id") < F.col("b_id")) & (F.col("a_is_new") | F.col("b_is_new"))
    shrink = F.cos(F.radians(F.col("a_lat_min")))
    for name, (lon, lat) in DIRECTIONS.items():
        # What a metre across a direction can change in it, in degrees.
        slope = F.sqrt(F.lit(lon * lon) / (shrink * shrink) + lat * lat) / DEGREE
        for side in ("min", "max"):
            c = f"{name}_{side}"
            close = F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) < (threshold + SLACK) * slope
            near = near & (F.coalesce(close, F.lit(True)) if lon and lat else close)
    met = left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys).where(near)
    return nearer(
        met.select(
            "from_atco_code",
            "to_atco_code",
            F.col("a_id").alias("track_a"),
            F.col("b_id").alias("track_b"),
            "a_points",
            "b_points",
            F.col("a_lon_min").alias("lon0"),
            F.col("a_lat_min").alias("lat0"),
            shrink.alias("shrink"),
        ),
        threshold,
    )


def _links(pairs: DataFrame) -> DataFrame:
    """Edges of the pairs; links a task can tell to be needless go where they arise."""
    edges = pairs.select(F.col("track_a").alias("src"), F.col("track_b").alias("dst"))
    return forest(edges) if {t for _, t in edges.dtypes} == {"bigint"} else edges


def canonical_tracks(pairs: DataFrame) -> DataFrame:
    """Each similar track and the lowest id of its group."""
    labels = connected_components(_links(pairs))
    return labels.select(F.col("id").alias("track_id"), F.col("component").alias("canonical_id"))


def extended_canonical(canonical: DataFrame, pairs: DataFrame) -> DataFrame:
    """``canonical_tracks`` of all pairs so far, from the last ones and the pairs that came since."""
    labels = canonical.select(F.col("track_id").alias("id"), F.col("canonical_id").alias("component"))
    grown = extended_components(labels, _links(pairs))
    return grown.select(F.col("id").alias("track_id"), F.col("component").alias("canonical_id"))


def repoint(references: DataFrame, canonical: DataFrame, column: str = "tracks_id") -> DataFrame:
    """References moved to the canonical track."""
    lookup = canonical.select(F.col("track_id").alias(column), "canonical_id")
    return references.join(lookup, column, "left").select(
        *[F.coalesce("canonical_id", column).alias(column) if c == column else c for c in references.columns]
    )


def consolidate(
    tracks: DataFrame, references: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge similar tracks: kept tracks, moved references, and a count report.

    Nothing is written here; a dry run reads the report only.
    """
    canonical = canonical_tracks(similar_tracks(tracks, threshold))
    duplicates = canonical.where("track_id <> canonical_id")
    kept = tracks.join(duplicates.select(F.col("track_id").alias("id")), "id", "left_anti")
    moved = repoint(references, canonical)
    touched = references.join(
        duplicates.select(F.col("track_id").alias("tracks_id")), "tracks_id", "left_semi"
    )
    report = duplicates.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("tracks_deleted").alias("measure"), "n"
    ).unionByName(
        touched.agg(F.count(F.lit(1)).alias("n")).select(F.lit("references_moved").alias("measure"), "n")
    )
    return kept, moved, report
