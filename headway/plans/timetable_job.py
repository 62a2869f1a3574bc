"""The whole timetable job: staged documents to output tables.

All files of all revisions go through together; ``revision_id`` (one upload)
and ``dataset_id`` stand beside each file. Documents are staged as Parquet once
by the caller (``headway.sources.documents.stage``), section tables are read
from there, rows that fail admission are kept apart, superseded files give their
service row only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import lifecycle as life
from headway.operators import patterns as pat
from headway.operators import resolve as res
from headway.operators import rollup
from headway.operators import sequence as seq
from headway.operators import tracks as trk
from headway.session import staged
from headway.sources import timetables as src
from headway.sources.admission import admit_sections

STOP_COLUMNS = ("atco_code", "id", "common_name", "lon", "lat", "locality_id", "admin_area_id")
# Which of two files of one name in a revision is the later one: by the number or
# time the caller gives with the documents, else by what the files say of themselves.
UPLOAD_ORDER = ("modification_datetime", "creation_datetime", "revision_number", "file_id")
MEASURES = ("num_stops", "journey_patterns", "vehicle_journeys", "localities", "admin_areas", "tracks", "distance")


@dataclass(frozen=True)
class References:
    """Reference tables a job needs; ``stops`` may have a ``zone`` (points) for flexible stops."""

    stops: DataFrame
    bank_holidays: DataFrame
    routed: DataFrame | None = None


class TimetableJob(Mapping[str, DataFrame]):
    """Output tables by name, worked out when asked for.

    What several tables need (which files count, links, stop sequences, the
    pattern bridge) is written once to the shared folder and read from there.
    """

    def __init__(
        self,
        documents: DataFrame,
        references: References,
        violations: DataFrame | None,
        divisions: list[str] | None,
        sections: Mapping[str, DataFrame] | None = None,
    ):
        self.documents, self.references = documents, references
        self.violations, self.divisions = violations, divisions
        self.sections, self.rejected = admit_sections(sections if sections is not None else src.sections(documents))
        self._tables = {
            "file_attributes": lambda: self.flagged,
            "services": self._services,
            "service_patterns": lambda: self.bridge,
            "flexible_service_patterns": lambda: self.flexible_bridge,
            "service_pattern_links": self._service_links,
            "pattern_members": lambda: pat.pattern_members(self.bridge, self.journey_map),
            "pattern_directions": lambda: pat.pattern_direction(self.bridge, self.live("journey_patterns")),
            "pattern_lines": lambda: pat.pattern_line(self.journey_map, self.live("vehicle_journeys")),
            "pattern_metadata": self._metadata,
            "flexible_pattern_members": lambda: pat.pattern_members(self.flexible_bridge, self.journey_map),
            "flexible_pattern_directions": lambda: pat.pattern_direction(self.flexible_bridge, self.live("flexible_patterns")),
            "flexible_pattern_lines": lambda: pat.pattern_line(
                self.journey_map.join(self.flexible_bridge.select("file_id", "service_pattern_id").distinct(), ["file_id", "service_pattern_id"], "left_semi"),
                self.live("flexible_journeys"),
            ),
            "flexible_pattern_metadata": self._flexible_metadata,
            "flexible_pattern_geometry": self._flexible_geometry,
            "pattern_localities": lambda: pat.pattern_localities(self.pattern_stops, self.references.stops),
            "pattern_admin_areas": lambda: pat.pattern_admin_areas(self.pattern_stops, self.references.stops),
            "pattern_geometry": self._geometry,
            "pattern_distances": self._distances,
            "run_statistics": self._run_statistics,
            "vehicle_journeys": lambda: rollup.vehicle_journey_rows(self.live("vehicle_journeys"), self.live("journey_patterns")),
            "stop_times": self._stop_times,
            "flexible_stop_rows": lambda: seq.flexible_stop_rows(
                self.live("flexible_journeys"), self.live("flexible_stops"), self.references.stops
            ),
            "flexible_operation_periods": lambda: cal.flexible_operation_periods(self.live("flexible_journeys")),
            "booking_arrangements": lambda: pat.booking_arrangements(self.live("bookings")),
            "operating_profiles": lambda: cal.weekday_rows(self.profiles),
            "calendar_exceptions": lambda: cal.exceptions(
                self.profiles, self.live("services"), self.references.bank_holidays, self.divisions
            ),
            "serviced_organisation_journeys": lambda: self.organisation_links,
            "serviced_organisation_working_days": lambda: res.organisation_working_days(
                self.organisation_links, self.live("serviced_organisations").where("working_days is not null")
            ),
            "tracks": lambda: self.tracks,
            "pattern_tracks": lambda: self.pattern_tracks,
            "vehicle_journey_tracks": self._journey_tracks,
            "rejected_rows": lambda: self.rejected,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def by_revision(self, name: str) -> DataFrame:
        """A table with revision and dataset of its file, to be replaced by revision."""
        return self[name].join(self.flagged.select("file_id", "revision_id", "dataset_id"), "file_id")

    # Parts that several tables share.

    @cached_property
    def flagged(self) -> DataFrame:
        """Attribute rows of the files that count, one per revision and file name."""
        s = self.sections
        keys = [c for c in ("revision_id", "dataset_id") if c in self.documents.columns]
        files = self.documents.select("file_id", *keys)
        for missing in {"revision_id", "dataset_id"} - set(keys):
            files = files.withColumn(missing, F.lit(0).cast("long"))
        attributes = rollup.file_attributes(s["metadata"], s["services"], s["lines"], s["operators"]).join(files, "file_id")
        if self.violations is not None:
            attributes = attributes.join(self.violations.select("file_id").distinct(), "file_id", "left_anti")
        order = UPLOAD_ORDER
        if "upload_order" in self.documents.columns:
            attributes = attributes.join(self.documents.select("file_id", "upload_order"), "file_id")
            order = ("upload_order", *order)
        named = life.latest_by_name(attributes, order=order)
        return staged(life.supersession(named).drop("upload_order"))

    def live(self, name: str) -> DataFrame:
        return self.sections[name].join(self.flagged.where("not superseded").select("file_id"), "file_id", "left_semi")

    @cached_property
    def links(self) -> DataFrame:
        return staged(seq.pattern_links(self.live("journey_patterns"), self.live("timing_links")))

    @cached_property
    def resolved(self) -> DataFrame:
        return res.resolve_stops(self.live("stop_points"), self.references.stops)

    @cached_property
    def stop_rows(self) -> DataFrame:
        """One row per stop of a file. Where a file names a stop several times, a full
        description counts before a reference, and of equals the least by id, name and
        place: the same row for all tables."""
        fields = ("naptan_stop_id", "common_name", "lon", "lat")
        rank = F.when(F.col("source") == "document", 0).when(F.col("source") == "register", 1).otherwise(2).alias("rank")
        first = F.min(F.struct(rank, *fields)).alias("s")
        return staged(self.resolved.groupBy("file_id", "atco_code").agg(first).select("file_id", "atco_code", *[f"s.{c}" for c in fields]))

    @cached_property
    def sequence(self) -> DataFrame:
        return staged(seq.stop_sequence(self.links, res.placeholders(self.resolved)))

    @cached_property
    def bridge(self) -> DataFrame:
        return staged(pat.service_pattern_bridge(self.live("journey_patterns"), self.sequence))

    @cached_property
    def flexible_sequence(self) -> DataFrame:
        return staged(seq.flexible_stop_sequence(self.live("flexible_stops")).drop("in_sequence"))

    @cached_property
    def flexible_bridge(self) -> DataFrame:
        return staged(pat.service_pattern_bridge(self.live("flexible_patterns"), self.flexible_sequence))

    @cached_property
    def journey_map(self) -> DataFrame:
        """Standard and flexible journeys with their service pattern."""
        standard = res.journey_pattern_of(self.live("vehicle_journeys"), self.bridge)
        flexible = self.live("flexible_journeys").withColumn("vj_ref", F.lit(None).cast("string"))
        return standard.unionByName(res.journey_pattern_of(flexible, self.flexible_bridge))

    @cached_property
    def pattern_stops(self) -> DataFrame:
        return (
            self.bridge.join(self.sequence, ["file_id", "jp_id"])
            .unionByName(self.flexible_bridge.join(self.flexible_sequence, ["file_id", "jp_id"]))
            .select("file_id", "service_pattern_id", "stop_ref")
        )

    @cached_property
    def profiles(self) -> DataFrame:
        return res.effective_profiles(self.live("vehicle_journeys"), self.live("operating_profiles"))

    @cached_property
    def organisation_links(self) -> DataFrame:
        return res.serviced_organisation_journeys(self.profiles, self.live("serviced_organisations"))

    @cached_property
    def tracks(self) -> DataFrame:
        return trk.with_track_id(trk.track_rows(self.live("route_links")))

    @cached_property
    def pairs(self) -> DataFrame:
        return seq.consecutive_pairs(self.sequence, ["file_id", "jp_id"], ["pos"])

    @cached_property
    def pattern_tracks(self) -> DataFrame:
        return trk.file_track_sequence(self.pairs, self.tracks)

    @cached_property
    def representatives(self) -> DataFrame:
        """The first journey pattern of each service pattern stands for its stops."""
        return self._first_of(self.bridge)

    @staticmethod
    def _first_of(bridge: DataFrame) -> DataFrame:
        return bridge.groupBy("file_id", "service_pattern_id").agg(
            F.min_by(F.struct("jp_id", "service_code"), "ordinal").alias("r")
        ).select("file_id", "service_pattern_id", "r.*")

    # Tables.

    def _services(self) -> DataFrame:
        known = self.flagged.select("file_id", "superseded")
        services = self.sections["services"].join(known, "file_id", "left_semi")
        return rollup.service_rows(services, self.sections["lines"], known)

    def _service_links(self) -> DataFrame:
        both = self.bridge.unionByName(self.flexible_bridge)
        return pat.patterns_of_service(both, both)

    def _stop_times(self) -> DataFrame:
        """Stop rows with their service pattern, the register's id and the stop's name."""
        rows = seq.stop_times(
            self.live("vehicle_journeys"), self.live("journey_patterns"), self.live("timing_links"), self.live("vj_links"), links=self.links
        )
        stops = self.stop_rows.select("file_id", "atco_code", "naptan_stop_id", "common_name")
        patterns = self.bridge.select("file_id", "jp_id", "service_pattern_id")
        return rows.join(patterns, ["file_id", "jp_id"], "left").join(stops, ["file_id", "atco_code"], "left")

    def _metadata(self) -> DataFrame:
        return self._metadata_of(self.representatives, self.sequence, self["pattern_directions"], self["pattern_lines"])

    def _flexible_metadata(self) -> DataFrame:
        return self._metadata_of(
            self._first_of(self.flexible_bridge), self.flexible_sequence, self["flexible_pattern_directions"], self["flexible_pattern_lines"]
        )

    def _metadata_of(self, representatives: DataFrame, sequence: DataFrame, directions: DataFrame, lines: DataFrame) -> DataFrame:
        names = self.stop_rows.select("file_id", "atco_code", F.col("common_name").alias("name"))
        ends = sequence.groupBy("file_id", "jp_id").agg(
            F.min_by("stop_ref", "pos").alias("first_stop"), F.max_by("stop_ref", "pos").alias("last_stop")
        )
        first = names.select("file_id", F.col("atco_code").alias("first_stop"), F.col("name").alias("first_stop_name"))
        last = names.select("file_id", F.col("atco_code").alias("last_stop"), F.col("name").alias("last_stop_name"))
        keys = ["file_id", "service_pattern_id"]
        patterns = (
            representatives.join(ends, ["file_id", "jp_id"], "left")
            .join(first, ["file_id", "first_stop"], "left")
            .join(last, ["file_id", "last_stop"], "left")
            .join(directions, keys, "left")
            .join(lines.withColumnRenamed("line_ref", "line_id"), keys, "left")
        )
        return pat.pattern_metadata(patterns, self.live("services"), self.live("lines"))

    def _geometry(self) -> DataFrame:
        """Line of each service pattern: its tracks where all pairs have one, else its stops."""
        along_stops = self._stop_lines(self.sequence)
        enough = trk.sufficient_tracks(self.pairs, self.tracks).where("sufficient")
        along_tracks = trk.pattern_geometry(self.pairs.join(enough, ["file_id", "jp_id"], "left_semi"), self.tracks, trk.SNAP_METRES)
        shapes = along_stops.withColumnRenamed("points", "stop_points").join(
            along_tracks.withColumnRenamed("points", "track_points"), ["file_id", "jp_id"], "full"
        )
        return self.representatives.join(shapes, ["file_id", "jp_id"]).select(
            "file_id", "service_pattern_id", F.coalesce("track_points", "stop_points").alias("points")
        )

    def _flexible_geometry(self) -> DataFrame:
        lines = self._stop_lines(self.flexible_sequence)
        return self._first_of(self.flexible_bridge).join(lines, ["file_id", "jp_id"]).select("file_id", "service_pattern_id", "points")

    def _stop_lines(self, sequence: DataFrame) -> DataFrame:
        """Lines through the stops of patterns, the points of a stop's flexible zone behind the stop."""
        spots = self.stop_rows.select("file_id", F.col("atco_code").alias("stop_ref"), F.lit(0).alias("k"), "lon", "lat")
        zones = self.live("zone_points").withColumnRenamed("atco_code", "stop_ref")
        if "zone" in self.references.stops.columns:
            own = zones.select("file_id", "stop_ref").distinct()
            stored = self.references.stops.select(F.col("atco_code").alias("stop_ref"), F.posexplode("zone").alias("k", "p"))
            register = spots.select("file_id", "stop_ref").join(own, ["file_id", "stop_ref"], "left_anti").join(stored, "stop_ref")
            zones = zones.unionByName(register.select("file_id", "stop_ref", (F.col("k") + 1).alias("k"), "p.lon", "p.lat"))
        return trk.pattern_line(sequence.join(spots.unionByName(zones), ["file_id", "stop_ref"]))

    def _run_statistics(self) -> DataFrame:
        """Sums over all service patterns of a file, flexible ones included."""
        keys = ["file_id", "service_pattern_id"]

        def number(rows: DataFrame, name: str) -> DataFrame:
            return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

        along = self.representatives.join(self.pattern_tracks, ["file_id", "jp_id"])
        patterns = self["pattern_members"].unionByName(self["flexible_pattern_members"])
        for part in (
            number(self["pattern_localities"], "localities"),
            number(self["pattern_admin_areas"], "admin_areas"),
            number(along, "tracks"),
            self["pattern_distances"].select(*keys, "distance"),
        ):
            patterns = patterns.join(part, keys, "left")
        return rollup.run_statistics(patterns, MEASURES)

    def _distances(self) -> DataFrame:
        spots = self.stop_rows.select("file_id", "atco_code", "lon", "lat")
        found = trk.pattern_distance(self.pairs, self.tracks, spots, self.references.routed)
        return self.representatives.join(found, ["file_id", "jp_id"]).select("file_id", "service_pattern_id", *[c for c in found.columns if c not in ("file_id", "jp_id")])

    def _journey_tracks(self) -> DataFrame:
        journeys = self.journey_map.join(self.representatives, ["file_id", "service_pattern_id"])
        return trk.journey_tracks(journeys, self.pattern_tracks)


def process(
    documents: DataFrame,
    references: References,
    violations: DataFrame | None = None,
    divisions: list[str] | None = None,
    sections: Mapping[str, DataFrame] | None = None,
) -> TimetableJob:
    """Output tables by name. Files named in ``violations`` are left out.

    ``documents`` are staged ones, with ``file_id`` and, where there is more than
    one upload, ``revision_id`` and ``dataset_id``. With an ``upload_order`` (a number or a
    time) the last of several files of one name counts; without one the file last
    modified does. Of files too large for one row,
    ``sections`` (``headway.sources.large.large_sections``) are read instead, and
    ``documents`` need those ids only.
    """
    return TimetableJob(documents, references, violations, divisions, sections)
