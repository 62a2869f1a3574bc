"""Operators over ordered stop and link sequences.

Tables (see ``headway.schemas``): ``journey_patterns`` hold an ordered list of
section references, ``timing_links`` the ordered links of each section,
``vehicle_journeys`` a start time and a pattern reference, ``vj_links`` a
journey's overriding links.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.time import DAY_SECONDS, clock, duration_seconds, seconds_of_day
from headway.operators.scan import scan
from headway.operators.tracks import track_lookup
from headway.session import staged

# Stop activities and their ids in the output tables.
STOP_ACTIVITIES = {"pickUp": 1, "setDown": 2, "pickUpAndSetDown": 3, "pass": 4}
NO_WAIT = "PT0S"
LINK_ORDER = ["section_pos", "link_pos"]
BLOCK_LINKS = 4096
USE_FIELDS = ("stop_ref", "seq_no", "activity", "timing_status")


def pattern_links(journey_patterns: DataFrame, timing_links: DataFrame) -> DataFrame:
    """Ordered timing links of every journey pattern, through its sections.

    ``section_first_stop`` and ``is_last`` describe the link's place in its
    section, so later steps need no second look at the section; a reader that
    exploded whole sections hands them over. Durations are read here, once per
    link of a document rather than once per journey.
    """
    links = timing_links.withColumns(
        {
            "run": duration_seconds(F.col("run_time")),
            "from_wait": _wait(F.col("from.wait_time")),
            "to_wait": _wait(F.col("to.wait_time")),
        }
    )
    if "is_last" not in links.columns:
        section = Window.partitionBy("file_id", "section_id")
        links = links.withColumns(
            {
                "is_last": F.col("link_pos") == F.max("link_pos").over(section),
                "section_first_stop": F.min_by(F.col("from.stop_ref"), F.col("link_pos")).over(section),
            }
        )
    refs = journey_patterns.select(
        "file_id", "jp_id", F.posexplode("section_refs").alias("section_pos", "section_id")
    )
    return refs.join(links, ["file_id", "section_id"])


def _wait(text: Column) -> Column:
    """A wait in seconds and whether it is the zero text; null without text."""
    return F.when(
        text.isNotNull(),
        F.struct(duration_seconds(text).alias("seconds"), (text == NO_WAIT).alias("is_zero")),
    )


def wait_seconds(from_wait: Column, to_wait: Column, is_first: bool) -> Column:
    """Which wait of a link counts, null for none.

    The first stop takes the From wait (zero text counts as none). Elsewhere
    the To wait of the same link wins unless absent or zero; a From wait is
    then returned as it is, zero text included.
    """
    def usable(wait: Column) -> Column:
        return F.when(~wait["is_zero"], wait["seconds"])

    if is_first:
        return usable(from_wait)
    return F.coalesce(usable(to_wait), from_wait["seconds"])


def overriding_links(vj_links: DataFrame) -> DataFrame:
    """First overriding link per journey and referenced pattern link.

    A missing run time of an overriding link counts as zero.
    """
    read = F.struct(
        duration_seconds(F.col("run_time")).alias("run"),
        _wait(F.col("from_wait")).alias("from_wait"),
        _wait(F.col("to_wait")).alias("to_wait"),
    )
    return vj_links.groupBy("file_id", "vj_code", F.col("link_ref").alias("link_id")).agg(
        F.min_by(read, "pos").alias("override")
    )


def _known(activity: Column, activities: Mapping[str, int] = STOP_ACTIVITIES) -> Column:
    return F.coalesce(activity.isin(*activities), F.lit(False))


def _timeline(
    links: DataFrame,
    keys: list[str],
    order: list[str],
    blocked: bool,
    carry: Sequence[str] = (),
    activities: Mapping[str, int] = STOP_ACTIVITIES,
) -> DataFrame:
    """Stops met along each sequence, with seconds since its start.

    ``links`` needs ``run``, ``first_wait`` and ``wait`` in seconds; ``carry``
    names further columns to keep. A sequence of up to ``BLOCK_LINKS`` links is one
    block, which a window works out; ``blocked`` cuts the longer ones only, as its
    scans write their rows and shuffle them by block.
    """
    if not blocked:
        return _met_stops(links, keys, order, False, carry, activities)
    sizes = links.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    long = staged(sizes.where(F.col("n") > BLOCK_LINKS).select(*keys))
    short = _met_stops(links.join(long, keys, "left_anti"), keys, order, False, carry, activities)
    return short.unionByName(_met_stops(links.join(long, keys, "left_semi"), keys, order, True, carry, activities))


def _met_stops(
    links: DataFrame,
    keys: list[str],
    order: list[str],
    blocked: bool,
    carry: Sequence[str],
    activities: Mapping[str, int],
) -> DataFrame:
    uses = [F.struct(*[F.col(f"{side}.{f}").alias(f) for f in USE_FIELDS]).alias(side) for side in ("from", "to")]
    body = [*keys, *carry, *order]
    links = links.select(*body, "is_last", "run", "first_wait", "wait", *uses)
    block = None
    if blocked:
        # Every blocked step reads its rows twice, so they are written once, not worked out again.
        links = staged(links.withColumn("_block", F.floor(F.col("link_pos") / BLOCK_LINKS)))
        block = ["section_pos", "_block"]
    from_ok = _known(F.col("from.activity"), activities)
    to_ok = _known(F.col("to.activity"), activities)
    met_to = F.col("is_last") & to_ok

    # The first stop is the first one with a known activity. Links up to it
    # use the first-stop wait rule.
    here = F.struct(*order)
    met_at = F.min(F.when(from_ok | met_to, here))
    if blocked:
        start = links.groupBy(*keys).agg(met_at.alias("_start"))
        links = links.join(start, keys)
    else:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        links = links.withColumn("_start", met_at.over(whole))
    links = links.withColumn(
        "wait",
        F.when(F.col("_start").isNull() | (here <= F.col("_start")), F.col("first_wait")).otherwise(
            F.col("wait")
        ),
    )
    links = scan(
        links,
        keys,
        order,
        sums={"elapsed": F.col("run") + F.col("wait")},
        lasts={
            "prev_stop": F.when(met_to, F.col("to.stop_ref")).when(from_ok, F.col("from.stop_ref")),
            "prev_link": F.struct(
                "section_pos",
                F.col("from.stop_ref").eqNullSafe(F.col("to.stop_ref")).alias("is_loop"),
            ),
        },
        block=block,
    )
    previous_is_loop = (F.col("prev_link.section_pos") == F.col("section_pos")) & F.col(
        "prev_link.is_loop"
    )
    repeated = (F.col("from.stop_ref") == F.col("prev_stop")) & ~F.coalesce(
        previous_is_loop, F.lit(False)
    )
    links = links.withColumn(
        "emit_from", from_ok & ~F.coalesce(repeated, F.lit(False))
    ).withColumn("emit_to", met_to)
    if blocked:
        links = staged(
            links.where("emit_from or emit_to").select(*body, "_block", "from", "to", "run", "wait", "elapsed", "emit_from", "emit_to")
        )
    links = scan(
        links,
        keys,
        order,
        sums={"emitted": F.col("emit_from").cast("int") + F.col("emit_to").cast("int")},
        block=block,
    )
    departs = F.col("elapsed") + F.col("wait")

    def usage(stop: str, offset: Column, number: Column) -> Column:
        return F.struct(
            F.col(f"{stop}.stop_ref").alias("atco_code"),
            F.col(f"{stop}.seq_no").alias("seq_no"),
            F.col(f"{stop}.activity").alias("activity"),
            F.col(f"{stop}.timing_status").alias("timing_status"),
            offset.alias("offset"),
            number.cast("int").alias("auto_sequence_number"),
        )

    first_number = F.col("emitted")
    usages = F.array(
        F.when(F.col("emit_from"), usage("from", departs, first_number)),
        F.when(
            F.col("emit_to"),
            usage("to", departs + F.col("run"), first_number + F.col("emit_from").cast("int")),
        ),
    )
    kept = F.filter(usages, lambda u: u.isNotNull())
    return links.select(*keys, *carry, F.explode(kept).alias("stop")).select(
        *keys, *carry, "stop.*"
    )


def _with_waits(links: DataFrame) -> DataFrame:
    base = (F.col("from_wait"), F.col("to_wait"))
    return links.withColumns(
        {
            "first_wait": F.coalesce(wait_seconds(*base, True), F.lit(0.0)),
            "wait": F.coalesce(wait_seconds(*base, False), F.lit(0.0)),
        }
    )


def _with_overrides(links: DataFrame) -> DataFrame:
    base = (F.col("from_wait"), F.col("to_wait"))
    own = (F.col("override.from_wait"), F.col("override.to_wait"))

    def wait(is_first: bool) -> Column:
        return F.coalesce(
            wait_seconds(*own, is_first), wait_seconds(*base, is_first), F.lit(0.0)
        )

    run = F.when(F.col("override").isNotNull(), F.col("override.run")).otherwise(F.col("run"))
    return links.withColumns({"run": run, "first_wait": wait(True), "wait": wait(False)})


def stop_times(
    vehicle_journeys: DataFrame,
    journey_patterns: DataFrame,
    timing_links: DataFrame,
    vj_links: DataFrame,
    blocked: bool = False,
    activities: Mapping[str, int] = STOP_ACTIVITIES,
    links: DataFrame | None = None,
) -> DataFrame:
    """Departure of every journey at every stop it serves.

    ``links`` may hand over ``pattern_links`` worked out before.

    Offsets from the start are worked out once per journey pattern; journeys
    that follow their pattern only join them, so the large journey x stop
    result is never sorted. Journeys with overriding links get a scan of their
    own. Departures wrap at midnight; a journey without a readable start keeps
    null departures. ``activities`` names the known stop activities and their
    ids; stops with another activity are left out.
    """
    order = LINK_ORDER
    if links is None:
        links = pattern_links(journey_patterns, timing_links)
    journeys = vehicle_journeys.where(F.col("jp_ref").isNotNull()).select(
        "file_id",
        "vj_code",
        F.col("jp_ref").alias("jp_id"),
        seconds_of_day(F.col("departure_time")).alias("start"),
    )
    overrides = overriding_links(vj_links)
    changed = overrides.select("file_id", "vj_code").distinct()

    plain = journeys.join(changed, ["file_id", "vj_code"], "left_anti")
    shared = _timeline(
        _with_waits(links), ["file_id", "jp_id"], order, blocked, activities=activities
    )
    by_pattern = plain.join(shared, ["file_id", "jp_id"])

    own = journeys.join(changed, ["file_id", "vj_code"], "left_semi")
    own_links = own.join(links, ["file_id", "jp_id"]).join(
        overrides, ["file_id", "vj_code", "link_id"], "left"
    )
    keys = ["file_id", "vj_code", "jp_id"]
    by_journey = _timeline(
        _with_overrides(own_links), keys, order, blocked, ["start"], activities
    )

    departure = F.pmod(F.col("start") + F.col("offset"), F.lit(DAY_SECONDS))
    activity_ids = F.create_map(*[F.lit(x) for kv in activities.items() for x in kv])
    columns = [*keys, "start", *[c for c in shared.columns if c not in ("file_id", "jp_id")]]
    return (
        by_pattern.select(*columns)
        .unionByName(by_journey.select(*columns))
        .select(
            "file_id",
            "vj_code",
            "jp_id",
            "atco_code",
            "auto_sequence_number",
            F.coalesce(
                F.nullif(F.col("seq_no"), F.lit("")).cast("int"), F.col("auto_sequence_number")
            ).alias("sequence_number"),
            departure.alias("departure_seconds"),
            clock(departure).alias("departure_time"),
            (F.coalesce(F.col("timing_status"), F.lit("")) == "principalTimingPoint").alias(
                "is_timing_point"
            ),
            activity_ids[F.col("activity")].alias("stop_activity_id"),
        )
    )


def unknown_activities(timing_links: DataFrame) -> DataFrame:
    """Stop uses left out because their activity is not known."""
    both = F.explode(F.array("from", "to")).alias("use")
    uses = timing_links.select("file_id", "section_id", "link_pos", both)
    return uses.where(~_known(F.col("use.activity"))).select(
        "file_id", "section_id", "link_pos", "use.stop_ref", "use.activity"
    )


def _pattern_stops(links: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.lit(0).alias("end"), F.col("from.stop_ref").alias("stop_ref")),
        F.when(
            F.col("is_last"),
            F.struct(F.lit(1).alias("end"), F.col("to.stop_ref").alias("stop_ref")),
        ),
    )
    return links.select(
        "file_id",
        "jp_id",
        *LINK_ORDER,
        "section_first_stop",
        F.explode(F.filter(ends, lambda e: e.isNotNull())).alias("e"),
    ).select("file_id", "jp_id", *LINK_ORDER, "section_first_stop", "e.end", "e.stop_ref")


def stop_sequence(links: DataFrame, placeholders: DataFrame | None = None) -> DataFrame:
    """Stops of each pattern in order, boundary repeats and placeholders left out.

    A later section's first stop is dropped when it equals the last kept stop.
    Output position ``pos`` is 0-based and has no gaps.
    """
    order = [*LINK_ORDER, "end"]
    rows = _pattern_stops(links)
    if placeholders is not None:
        rows = rows.join(placeholders, ["file_id", "stop_ref"], "left_anti")
    keys = ["file_id", "jp_id"]
    rows = scan(rows, keys, order, lasts={"prev_stop": F.col("stop_ref")})
    repeated = (
        (F.col("section_pos") > 0)
        & (F.col("stop_ref") == F.col("section_first_stop"))
        & (F.col("stop_ref") == F.col("prev_stop"))
    )
    kept = rows.where(~F.coalesce(repeated, F.lit(False)))
    return _numbered(kept, keys, order)


def simple_stop_sequence(links: DataFrame) -> DataFrame:
    """As ``stop_sequence``, but later sections always lose their first stop."""
    rows = _pattern_stops(links)
    section = Window.partitionBy("file_id", "jp_id", "section_pos")
    first_link = F.min("link_pos").over(section)
    kept = rows.withColumn("first_link", first_link).where(
        ~((F.col("section_pos") > 0) & (F.col("link_pos") == F.col("first_link")) & (F.col("end") == 0))
    )
    return _numbered(kept, ["file_id", "jp_id"], [*LINK_ORDER, "end"])


def _numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return rows.select(*keys, pos.alias("pos"), "stop_ref")


def flexible_stop_sequence(flexible_stops: DataFrame) -> DataFrame:
    """Stops in sequence, then zone stops, of each flexible pattern."""
    rank = F.when(F.col("in_sequence"), 0).otherwise(1)
    order = Window.partitionBy("file_id", "jp_id").orderBy("part", "stop_pos")
    return flexible_stops.withColumn("part", rank).select(
        "file_id", "jp_id", (F.row_number().over(order) - 1).alias("pos"), "stop_ref", "in_sequence"
    )


def flexible_stop_rows(
    vehicle_journeys: DataFrame, flexible_stops: DataFrame, stops: DataFrame
) -> DataFrame:
    """Stop rows of flexible journeys: no departure, fixed activity.

    Stops in sequence come first, then zone stops. Stops the stop table does not
    know are dropped; numbering runs over the kept rows. Only fixed stops can be
    timing points.
    """
    known = flexible_stops.join(
        stops.select(F.col("atco_code").alias("stop_ref"), "common_name"), "stop_ref"
    )
    part = F.when(F.col("in_sequence"), 0).otherwise(1)
    order = Window.partitionBy("file_id", "jp_id").orderBy(part, "stop_pos")
    principal = F.coalesce(F.col("timing_status"), F.lit("")) == "principalPoint"
    rows = known.select(
        "file_id",
        "jp_id",
        F.col("stop_ref").alias("atco_code"),
        (F.row_number().over(order) - 1).alias("auto_sequence_number"),
        (~F.col("is_flexible") & principal).alias("is_timing_point"),
        "common_name",
    )
    journeys = vehicle_journeys.select("file_id", "vj_code", F.col("jp_ref").alias("jp_id"))
    return journeys.join(rows, ["file_id", "jp_id"]).select(
        "file_id",
        "vj_code",
        "jp_id",
        "atco_code",
        "common_name",
        "auto_sequence_number",
        F.lit(None).cast("string").alias("departure_time"),
        "is_timing_point",
        F.lit(STOP_ACTIVITIES["pickUpAndSetDown"]).alias("stop_activity_id"),
    )


def consecutive_pairs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], stop: str = "stop_ref"
) -> DataFrame:
    """Pairs of neighbouring stops, numbered from 0 along each sequence."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.select(
            *keys,
            (F.row_number().over(window) - 1).alias("sequence_number"),
            F.col(stop).alias("from_stop"),
            F.lead(stop).over(window).alias("to_stop"),
        )
        .where(F.col("to_stop").isNotNull())
    )


def distinct_pairs(route_links: DataFrame) -> DataFrame:
    """Distinct (from, to) pairs over route links."""
    return route_links.select("from_stop", "to_stop").distinct()


def track_sequence(pairs: DataFrame, tracks: DataFrame) -> DataFrame:
    """Tracks along a sequence. Pairs are numbered first, then those without a
    track fall out, so numbers keep gaps. ``pairs`` carries its own keys."""
    lookup = track_lookup(tracks, ["id"]).withColumnRenamed("id", "tracks_id")
    return pairs.join(lookup, ["from_stop", "to_stop"])


def terminal_stops(sequence: DataFrame, names: DataFrame) -> DataFrame:
    """First and last stop of each sequence and their names."""
    ends = sequence.groupBy("file_id", "jp_id").agg(
        F.min_by("stop_ref", "pos").alias("first_stop"),
        F.max_by("stop_ref", "pos").alias("last_stop"),
    )
    first = names.select(F.col("atco_code").alias("first_stop"), F.col("common_name").alias("origin"))
    last = names.select(F.col("atco_code").alias("last_stop"), F.col("common_name").alias("destination"))
    return ends.join(first, "first_stop", "left").join(last, "last_stop", "left")


def timing_point_count(links: DataFrame) -> DataFrame:
    """Principal timing points over both ends of each pattern's links."""
    principal = "principalTimingPoint"

    def one(side: str) -> Column:
        return F.when(F.col(f"{side}.timing_status") == principal, 1).otherwise(0)

    return links.groupBy("file_id", "jp_id").agg(
        F.sum(one("from") + one("to")).alias("principal_timing_points")
    )


def broken_links(timing_links: DataFrame) -> DataFrame:
    """Sections where a link does not start where the previous one ended."""
    rows = scan(
        timing_links,
        ["file_id", "section_id"],
        ["link_pos"],
        lasts={
            "prev": F.struct(F.coalesce(F.col("to.stop_ref"), F.lit("")).alias("stop")),
        },
    )
    broken = F.col("prev").isNotNull() & (
        F.col("prev.stop") != F.coalesce(F.col("from.stop_ref"), F.lit(""))
    )
    return rows.where(broken).select("file_id", "section_id").distinct()
