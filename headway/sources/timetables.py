"""Timetable documents to section tables.

Every function takes parsed documents (``headway.sources.documents``), one row
per file with ``file_id``, and explodes one section; positions come from the
document. ``sections`` gives all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import stop_location
from headway.operators.calendar import WEEKDAYS
from headway.sources.documents import child_names

# Modes and commercial bases a document may name.
MODES = ("air", "bus", "coach", "ferry", "metro", "rail", "tram", "trolleyBus", "underground")
COMMERCIAL_BASES = ("contracted", "notContracted", "partContracted", "unknown")
ACTIVITIES = ("pickUpAndSetDown", "pickUp", "setDown", "pass")
UNKNOWN_LINK = "UNKNOWN"
NO_DESCRIPTION = "No description"


def _first(column: Column) -> Column:
    return F.get(column, F.lit(0))


def _text(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def _explode(df: DataFrame, array: Column, *keep: str, pos: str = "pos") -> DataFrame:
    """Elements with their position; behind the place of their part, where a file
    was read in parts (``headway.sources.large``)."""
    if "place" not in df.columns:
        return df.select("file_id", *keep, F.posexplode(array).alias(pos, "e"))
    rows = df.select("file_id", "place", *keep, F.posexplode(array).alias(pos, "e"))
    return rows.withColumn(pos, F.struct("place", F.col(pos).alias("pos"))).drop("place")


def metadata(docs: DataFrame) -> DataFrame:
    return docs.select(
        "file_id",
        F.col("_SchemaVersion").alias("schema_version"),
        F.to_timestamp("_CreationDateTime").alias("creation_datetime"),
        F.to_timestamp("_ModificationDateTime").alias("modification_datetime"),
        F.col("_Modification").alias("modification"),
        F.col("_RevisionNumber").cast("int").alias("revision_number"),
        F.col("_FileName").alias("filename"),
    )


def operators(docs: DataFrame) -> DataFrame:
    rows = _explode(docs, F.flatten(F.filter(F.transform("Operators", lambda b: b["Operator"]), lambda a: a.isNotNull())), pos="operator_pos")
    return rows.select(
        "file_id",
        "operator_pos",
        _first(F.col("e.NationalOperatorCode")).alias("noc"),
        F.col("e.OperatorShortName").alias("short_name"),
        F.col("e.LicenceNumber").alias("licence_number"),
        F.col("e.PrimaryMode").alias("primary_mode"),
    )


def _services(docs: DataFrame) -> DataFrame:
    all_services = F.flatten(
        F.filter(F.transform("Services", lambda b: b["Service"]), lambda a: a.isNotNull())
    )
    return _explode(docs, all_services, pos="service_pos")


def services(docs: DataFrame) -> DataFrame:
    standard, flexible = F.col("e.StandardService"), F.col("e.FlexibleService")
    usable = _text(standard["Origin"]).isNotNull() & _text(standard["Destination"]).isNotNull()
    mode = F.col("e.Mode")
    public = _first(F.col("e.PublicUse"))
    return _services(docs).select(
        "file_id",
        "service_pos",
        F.col("e.ServiceCode").alias("service_code"),
        F.to_date("e.OperatingPeriod.StartDate").alias("start_date"),
        F.to_date("e.OperatingPeriod.EndDate").alias("end_date"),
        F.when(mode.isin(*MODES), mode).otherwise("bus").alias("mode"),
        F.when(public.isNotNull(), F.lower(public).isin("true", "1")).otherwise(F.lit(True)).alias("public_use"),
        F.coalesce(usable, F.lit(False)).alias("has_standard"),
        flexible.isNotNull().alias("has_flexible"),
        F.when(usable, standard["Origin"]).otherwise(flexible["Origin"]).alias("origin"),
        F.when(usable, standard["Destination"]).otherwise(flexible["Destination"]).alias("destination"),
    )


def lines(docs: DataFrame) -> DataFrame:
    def described(side: str) -> Column:
        d = F.col(f"l.{side}Description")
        return F.when(
            _text(d["Description"]).isNotNull(),
            F.struct(
                d["Origin"].alias("origin"),
                d["Destination"].alias("destination"),
                d["Description"].alias("description"),
            ),
        )

    rows = _services(docs).select(
        "file_id",
        "service_pos",
        F.col("e.ServiceCode").alias("service_code"),
        F.posexplode("e.Lines.Line").alias("line_pos", "l"),
    )
    return rows.select(
        "file_id",
        "service_pos",
        "service_code",
        "line_pos",
        F.col("l._id").alias("line_id"),
        F.col("l.LineName").alias("line_name"),
        described("Inbound").alias("inbound"),
        described("Outbound").alias("outbound"),
    )


def journey_patterns(docs: DataFrame) -> DataFrame:
    """Patterns of the standard parts; a part without both ends has none."""
    part = F.col("e.StandardService")
    ends = _text(part["Origin"]).isNotNull() & _text(part["Destination"]).isNotNull()
    rows = _services(docs).where(ends).select(
        "file_id",
        "service_pos",
        F.col("e.ServiceCode").alias("service_code"),
        F.posexplode("e.StandardService.JourneyPattern").alias("jp_pos", "j"),
    )
    return rows.select(
        "file_id",
        F.col("j._id").alias("jp_id"),
        F.struct("service_pos", "jp_pos").alias("ordinal"),
        "service_code",
        _first(F.col("j.Direction")).alias("direction"),
        F.col("j.DestinationDisplay").alias("destination_display"),
        _first(F.col("j.RouteRef")).alias("route_ref"),
        F.col("j.JourneyPatternSectionRefs").alias("section_refs"),
    )


def _usage(u: Column) -> Column:
    activity = F.when(u["Activity"].isin(*ACTIVITIES), u["Activity"]).otherwise("pickUpAndSetDown")
    return F.when(
        u.isNotNull(),
        F.struct(
            u["StopPointRef"].alias("stop_ref"),
            u["_SequenceNumber"].alias("seq_no"),
            activity.alias("activity"),
            u["TimingStatus"].alias("timing_status"),
            _text(u["WaitTime"]).alias("wait_time"),
        ),
    )


def timing_links(docs: DataFrame) -> DataFrame:
    sections = _explode(docs, F.col("JourneyPatternSections.JourneyPatternSection"), pos="section_ord")
    rows = sections.select(
        "file_id",
        "section_ord",
        F.col("e._id").alias("section_id"),
        F.posexplode("e.JourneyPatternTimingLink").alias("link_pos", "l"),
    )
    return rows.select(
        "file_id",
        "section_id",
        "section_ord",
        "link_pos",
        F.col("l._id").alias("link_id"),
        F.col("l.RouteLinkRef").alias("route_link_ref"),
        F.col("l.RunTime").alias("run_time"),
        _usage(F.col("l.From")).alias("from"),
        _usage(F.col("l.To")).alias("to"),
    )


def _point(loc: Column) -> Column:
    """A location as longitude and latitude; a nested translation comes first."""

    def of(name: str) -> Column:
        return F.coalesce(_text(loc["Translation"][name]), _text(loc[name])).try_cast("double")

    return stop_location(of("Longitude"), of("Latitude"), of("Easting"), of("Northing"))


def route_links(docs: DataFrame) -> DataFrame:
    sections = _explode(docs, F.col("RouteSections.RouteSection"), pos="section_ord")
    rows = sections.select(
        "file_id",
        "section_ord",
        F.col("e._id").alias("section_id"),
        F.posexplode("e.RouteLink").alias("link_pos", "l"),
    )
    mapped = F.flatten(
        F.filter(
            F.transform("l.Track", lambda t: t["Mapping"]["Location"]), lambda a: a.isNotNull()
        )
    )
    named = F.filter(mapped, lambda p: p["_id"].isNotNull())
    located = F.filter(F.transform(named, _point), lambda p: p.isNotNull())
    return rows.select(
        "file_id",
        "section_id",
        "link_pos",
        F.col("l._id").alias("link_id"),
        F.col("l.From.StopPointRef").alias("from_stop"),
        F.col("l.To.StopPointRef").alias("to_stop"),
        F.col("l.Distance").cast("int").alias("distance"),
        located.alias("points"),
        F.struct("section_ord", "link_pos").alias("ordinal"),
    )


def routes(docs: DataFrame, check: bool = True) -> DataFrame:
    """Routes and their sections in order; references to no section are skipped (unless the caller does so)."""
    known = F.transform(
        F.coalesce(F.col("RouteSections.RouteSection"), F.array()), lambda s: s["_id"]
    )
    rows = _explode(docs.withColumn("known", known), F.col("Routes.Route"), "known", pos="route_pos")
    return rows.select(
        "file_id",
        "route_pos",
        F.col("e._id").alias("route_id"),
        F.coalesce(_text(F.col("e.Description")), F.lit(NO_DESCRIPTION)).alias("description"),
        (F.filter("e.RouteSectionRef", lambda r: F.array_contains(F.col("known"), r)) if check else F.col("e.RouteSectionRef")).alias("section_refs"),
    )


def stop_points(docs: DataFrame) -> DataFrame:
    """Full stops and annotated references in one table."""
    full = _explode(docs, F.col("StopPoints.StopPoint"))
    place = F.col("e.Place")
    spot = _point(place["Location"])
    complete = (
        F.col("e.Descriptor").isNotNull()
        & place["NptgLocalityRef"].isNotNull()
        & F.col("e.StopClassification").isNotNull()
        & _text(F.col("e.AdministrativeAreaRef")).isNotNull()
    )
    own = full.where(F.col("e.AtcoCode").isNotNull() & complete).select(
        "file_id",
        F.col("e.AtcoCode").alias("atco_code"),
        F.lit(False).alias("is_reference"),
        F.col("e.Descriptor.CommonName").alias("common_name"),
        place["NptgLocalityRef"].alias("locality_name"),
        F.col("e.StopClassification.StopType").alias("stop_type"),
        spot["lon"].alias("lon"),
        spot["lat"].alias("lat"),
    ).where("lon is not null")
    refs = _explode(docs, F.col("StopPoints.AnnotatedStopPointRef"))
    at = _point(F.col("e.Location"))
    named = _text(F.col("e.StopPointRef")).isNotNull() & _text(F.col("e.CommonName")).isNotNull()
    annotated = refs.where(named).select(
        "file_id",
        F.col("e.StopPointRef").alias("atco_code"),
        F.lit(True).alias("is_reference"),
        F.col("e.CommonName").alias("common_name"),
        F.col("e.LocalityName").alias("locality_name"),
        at["lon"].alias("lon"),
        at["lat"].alias("lat"),
    )
    return own.unionByName(annotated, allowMissingColumns=True)


def zone_points(docs: DataFrame) -> DataFrame:
    """Points of the flexible zones of a file's own stops, numbered from 1 (``k``); those that cannot be read are skipped."""
    full = _explode(docs, F.col("StopPoints.StopPoint")).where("e.AtcoCode is not null")
    zone = F.col("e.StopClassification.OnStreet.Bus.FlexibleZone.Location")
    rows = full.select("file_id", F.col("e.AtcoCode").alias("atco_code"), F.posexplode(F.transform(zone, _point)).alias("k", "p"))
    return rows.where("p.lon is not null").select("file_id", "atco_code", (F.col("k") + 1).alias("k"), "p.lon", "p.lat")


def _ranges(ranges: Column) -> Column:
    """Date ranges with both ends."""
    read = F.transform(
        ranges,
        lambda r: F.struct(
            F.to_date(_first(r["StartDate"])).alias("start"),
            F.to_date(_first(r["EndDate"])).alias("end"),
        ),
    )
    return F.coalesce(
        F.filter(read, lambda r: r["start"].isNotNull() & r["end"].isNotNull()),
        F.array().cast("array<struct<start:date,end:date>>"),
    )


def serviced_organisations(docs: DataFrame) -> DataFrame:
    rows = _explode(docs, F.col("ServicedOrganisations.ServicedOrganisation"))
    days = _ranges(F.col("e.WorkingDays.DateRange"))
    off = _ranges(
        F.flatten(F.filter(F.transform("e.Holidays", lambda h: h["DateRange"]), lambda a: a.isNotNull()))
    )
    return rows.select(
        "file_id",
        F.col("e.OrganisationCode").alias("code"),
        _first(F.col("e.Name")).alias("name"),
        F.when(F.size(days) > 0, days).alias("working_days"),
        F.when(F.size(off) > 0, off).alias("holidays"),
    )


def _journeys(docs: DataFrame, kind: str) -> DataFrame:
    rows = F.flatten(F.filter(F.transform("VehicleJourneys", lambda b: b[kind]), lambda a: a.isNotNull()))
    return _explode(docs, rows, pos="ordinal")


def vehicle_journeys(docs: DataFrame) -> DataFrame:
    """Standard journeys. A block number counts only with a block description."""
    basis = F.col("e.CommercialBasis")
    block = F.col("e.Operational.Block")
    return _journeys(docs, "VehicleJourney").select(
        "file_id",
        F.col("e.VehicleJourneyCode").alias("vj_code"),
        "ordinal",
        _text(F.col("e.JourneyPatternRef")).alias("jp_ref"),
        _text(F.col("e.VehicleJourneyRef")).alias("vj_ref"),
        F.col("e.LineRef").alias("line_ref"),
        F.col("e.ServiceRef").alias("service_ref"),
        F.col("e.DepartureTime").alias("departure_time"),
        _first(F.col("e.DepartureDayShift")).cast("int").alias("departure_day_shift"),
        F.when(_text(block["Description"]).isNotNull(), block["BlockNumber"]).alias("block"),
        F.col("e.Operational.TicketMachine.JourneyCode").alias("journey_code"),
        F.when(basis.isin(*COMMERCIAL_BASES), basis).otherwise("notContracted").alias("commercial_basis"),
    )


def vj_links(docs: DataFrame) -> DataFrame:
    rows = _journeys(docs, "VehicleJourney").select(
        "file_id",
        F.col("e.VehicleJourneyCode").alias("vj_code"),
        F.posexplode("e.VehicleJourneyTimingLink").alias("pos", "l"),
    )
    return rows.select(
        "file_id",
        "vj_code",
        "pos",
        F.coalesce(_text(F.col("l.JourneyPatternTimingLinkRef")), F.lit(UNKNOWN_LINK)).alias("link_ref"),
        _text(F.col("l.RunTime")).alias("run_time"),
        _text(F.col("l.From.WaitTime")).alias("from_wait"),
        _text(F.col("l.To.WaitTime")).alias("to_wait"),
    )


# An optional name space prefix.
PREFIX = r"(?:[\w.-]+:)?"


def _inner(xml: Column, name: str) -> Column:
    """Text of the first element of that name, whatever its prefix and attributes."""
    return _text(F.regexp_extract(xml, rf"<{PREFIX}{name}(?:\s[^>]*)?>\s*([^<]*?)\s*</{PREFIX}{name}\s*>", 1))


def flexible_journeys(docs: DataFrame) -> DataFrame:
    times = F.regexp_extract_all(
        "e.FlexibleServiceTimes",
        F.lit(rf"(?s)<{PREFIX}AllDayService\b[^>]*>|<{PREFIX}ServicePeriod\b[^>]*>.*?</{PREFIX}ServicePeriod\s*>"),
        0,
    )
    parsed = F.transform(
        times,
        lambda x: F.struct(
            x.rlike(rf"^<{PREFIX}AllDay").alias("all_day"),
            _inner(x, "StartTime").alias("start"),
            _inner(x, "EndTime").alias("end"),
        ),
    )
    complete = F.forall(
        parsed, lambda p: p["all_day"] | (p["start"].isNotNull() & p["end"].isNotNull())
    )
    return _journeys(docs, "FlexibleVehicleJourney").select(
        "file_id",
        F.col("e.VehicleJourneyCode").alias("vj_code"),
        "ordinal",
        _text(F.col("e.JourneyPatternRef")).alias("jp_ref"),
        F.col("e.ServiceRef").alias("service_ref"),
        F.col("e.LineRef").alias("line_ref"),
        F.when(complete, parsed).alias("service_times"),
    )


def _profile_rows(owners: DataFrame) -> DataFrame:
    """Operating profiles of owners with a column ``p`` (the raw profile)."""
    raw = F.col("p.RegularDayType.DaysOfWeek")
    named = owners.withColumn("_names", child_names(raw))

    names = F.col("_names")
    weekdays = F.array_contains(names, "MondayToFriday")
    weekend = ~weekdays & F.array_contains(names, "Weekend")
    every = ~weekdays & ~weekend & F.array_contains(names, "MondayToSunday")
    flags = []
    for i, day in enumerate(WEEKDAYS):
        group = weekdays if i < 5 else weekend
        flags.append((F.array_contains(names, day.capitalize()) | group | every).alias(day))
    holidays_only = F.col("p.RegularDayType.HolidaysOnly").isNotNull()
    days = F.struct(*flags, holidays_only.alias("holidays_only"))
    any_day = F.exists(F.array(*[f for f in flags]), lambda x: x)
    valid = F.col("p.RegularDayType").isNotNull() & ~(holidays_only & any_day)

    def refs(side: str) -> Column:
        return F.transform(
            f"p.ServicedOrganisationDayType.{side}",
            lambda d: F.struct(
                d["WorkingDays"]["ServicedOrganisationRef"].alias("working_days"),
                d["Holidays"]["ServicedOrganisationRef"].alias("holidays"),
            ),
        )

    def bank(side: str) -> Column:
        return child_names(F.get(F.col("p.BankHolidayOperation"), F.lit(0))[side])

    return named.select(
        "file_id",
        "owner_kind",
        "owner_id",
        "owner_pos",
        F.when(valid, days).alias("days"),
        _ranges(F.col("p.SpecialDaysOperation.DaysOfOperation.DateRange")).alias("special_operation"),
        _ranges(F.col("p.SpecialDaysOperation.DaysOfNonOperation.DateRange")).alias("special_non_operation"),
        bank("DaysOfOperation").alias("bank_operation"),
        bank("DaysOfNonOperation").alias("bank_non_operation"),
        refs("DaysOfOperation").alias("so_operation"),
        refs("DaysOfNonOperation").alias("so_non_operation"),
    )


def operating_profiles(docs: DataFrame) -> DataFrame:
    """Profiles of journeys and services; rows whose ``days`` are null count as
    none at all. Group names expand to days, the first of them that matches; an
    empty weekday element means no days."""
    journeys = _journeys(docs, "VehicleJourney").select(
        "file_id",
        F.lit("journey").alias("owner_kind"),
        F.col("e.VehicleJourneyCode").alias("owner_id"),
        F.col("ordinal").alias("owner_pos"),
        F.col("e.OperatingProfile").alias("p"),
    )
    of_services = _services(docs).select(
        "file_id",
        F.lit("service").alias("owner_kind"),
        F.col("e.ServiceCode").alias("owner_id"),
        F.col("service_pos").alias("owner_pos"),
        F.col("e.OperatingProfile").alias("p"),
    )
    return _profile_rows(journeys.unionByName(of_services).where("p is not null"))


def _flexible_patterns(docs: DataFrame) -> DataFrame:
    return _services(docs).select(
        "file_id",
        F.col("e.ServiceCode").alias("service_code"),
        "service_pos",
        F.posexplode("e.FlexibleService.FlexibleJourneyPattern").alias("jp_pos", "j"),
    )


def flexible_patterns(docs: DataFrame) -> DataFrame:
    return _flexible_patterns(docs).select(
        "file_id",
        F.col("j._id").alias("jp_id"),
        F.struct("service_pos", "jp_pos").alias("ordinal"),
        "service_code",
        _first(F.col("j.Direction")).alias("direction"),
    )


def stop_uses(inner: Column) -> Column:
    """Stop uses in document order from a sequence's or zone's inner XML."""
    uses = F.regexp_extract_all(
        inner,
        F.lit(rf"(?s)<{PREFIX}(?:Fixed|Flexible)StopUsage\b[^>]*>.*?</{PREFIX}(?:Fixed|Flexible)StopUsage\s*>"),
        0,
    )
    read = F.transform(
        uses,
        lambda u: F.struct(
            u.rlike(rf"^<{PREFIX}Flexible").alias("is_flexible"),
            _inner(u, "StopPointRef").alias("stop_ref"),
            _inner(u, "TimingStatus").alias("timing_status"),
        ),
    )
    return F.coalesce(
        F.filter(read, lambda u: u["stop_ref"].isNotNull()),
        F.array().cast("array<struct<is_flexible:boolean,stop_ref:string,timing_status:string>>"),
    )


def flexible_stops(docs: DataFrame) -> DataFrame:
    """Stops in sequence, and zone stops (flexible ones only)."""
    parts = F.array(
        F.struct(F.lit(True).alias("in_sequence"), stop_uses(F.col("j.StopPointsInSequence")).alias("uses")),
        F.struct(
            F.lit(False).alias("in_sequence"),
            F.filter(stop_uses(F.col("j.FlexibleZones")), lambda u: u["is_flexible"]).alias("uses"),
        ),
    )
    rows = _flexible_patterns(docs).select(
        "file_id", F.col("j._id").alias("jp_id"), F.explode(parts).alias("p")
    )
    return rows.select(
        "file_id", "jp_id", "p.in_sequence", F.posexplode("p.uses").alias("stop_pos", "u")
    ).select("file_id", "jp_id", "in_sequence", "stop_pos", "u.*")


def bookings(docs: DataFrame) -> DataFrame:
    rows = _flexible_patterns(docs).select(
        "file_id",
        "service_code",
        F.struct("service_pos", "jp_pos").alias("ordinal"),
        F.col("j.BookingArrangements")[0].alias("b"),
    ).where("b is not null")
    return rows.select(
        "file_id",
        "service_code",
        "ordinal",
        F.trim(F.regexp_replace("b.Description", r"\s+", " ")).alias("description"),
        _first(F.col("b.Email")).alias("email"),
        F.get(F.col("b.Phone"), F.lit(0))["TelNationalNumber"].alias("phone"),
        _first(F.col("b.WebAddress")).alias("web_address"),
    )


SECTIONS = {
    "metadata": metadata,
    "operators": operators,
    "services": services,
    "lines": lines,
    "journey_patterns": journey_patterns,
    "timing_links": timing_links,
    "route_links": route_links,
    "routes": routes,
    "stop_points": stop_points,
    "zone_points": zone_points,
    "serviced_organisations": serviced_organisations,
    "vehicle_journeys": vehicle_journeys,
    "vj_links": vj_links,
    "flexible_journeys": flexible_journeys,
    "operating_profiles": operating_profiles,
    "flexible_patterns": flexible_patterns,
    "flexible_stops": flexible_stops,
    "bookings": bookings,
}

# What some of these read of a document, for ``documents.parse_timetables``.
FIELDS = {
    "metadata": ("_SchemaVersion", "_CreationDateTime", "_ModificationDateTime", "_Modification", "_RevisionNumber", "_FileName"),
    "lines": ("Services.Service.ServiceCode", "Services.Service.Lines"),
    "route_links": ("RouteSections",),
    "stop_points": ("StopPoints",),
    "vehicle_journeys": tuple(
        f"VehicleJourneys.VehicleJourney.{name}"
        for name in ("VehicleJourneyCode", "JourneyPatternRef", "VehicleJourneyRef", "LineRef", "ServiceRef", "DepartureTime", "DepartureDayShift", "Operational", "CommercialBasis")
    ),
    "operating_profiles": (
        "VehicleJourneys.VehicleJourney.VehicleJourneyCode",
        "VehicleJourneys.VehicleJourney.OperatingProfile",
        "Services.Service.ServiceCode",
        "Services.Service.OperatingProfile",
    ),
    "flexible_stops": ("Services.Service.ServiceCode", "Services.Service.FlexibleService.FlexibleJourneyPattern"),
}


def sections(docs: DataFrame) -> dict[str, DataFrame]:
    return {name: read(docs) for name, read in SECTIONS.items()}
