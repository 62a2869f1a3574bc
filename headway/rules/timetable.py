"""Timetable rule catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.text import (
    all_in,
    contains_date,
    has_prohibited_characters,
    is_true,
    matches_at_start,
)
from headway.functions.time import duration_seconds
from headway.operators.calendar import WEEKDAYS
from headway.operators.resolve import journey_reference_chain
from headway.rules.runner import (
    Catalogue,
    Observation,
    count,
    each,
    has_text,
    numbered,
    present,
    violation_rows,
)
from headway.session import staged
from headway.sources import timetables as src
from headway.sources.documents import child_names
from headway.sources.timetables import stop_uses

STANDARD, FLEXIBLE = "StandardService", "FlexibleService"

# Service code forms, bank holiday names, longest period in days.
REGISTERED = r"[a-zA-Z]{2}\d{7}:[a-zA-Z0-9]+$"
UNREGISTERED = r"UZ[a-zA-Z0-9]{7}:[a-zA-Z0-9]+$"
MAX_PERIOD_DAYS = 4026
HOLIDAYS_COMMON = (
    "ChristmasEve",
    "ChristmasDay",
    "ChristmasDayHoliday",
    "BoxingDay",
    "BoxingDayHoliday",
    "NewYearsDay",
    "NewYearsDayHoliday",
    "GoodFriday",
    "EasterMonday",
    "SpringBank",
    "MayDay",
)
HOLIDAYS_ENGLISH = ("NewYearsEve", "LateSummerBankHolidayNotScotland")
HOLIDAYS_SCOTTISH = ("StAndrewsDayHoliday", "Jan2ndScotland", "Jan2ndScotlandHoliday")
HOLIDAYS_IGNORED = ("StAndrewsDay", "AugustBankHolidayScotland", "OtherPublicHoliday")

# ------------------------------------------------------------- row sets


def _all(array: str, field: str) -> Column:
    """Elements inside a repeatable wrapper element."""
    return each(F.col(array), lambda w: w[field])


def _services() -> Column:
    return _all("Services", "Service")


def _journeys() -> Column:
    return _all("VehicleJourneys", "VehicleJourney")


def _flexible_journeys() -> Column:
    return _all("VehicleJourneys", "FlexibleVehicleJourney")


def _concat(*arrays: Column) -> Column:
    return F.flatten(F.filter(F.array(*arrays), lambda a: a.isNotNull()))


def _some(value: Column) -> Column:
    """A present single element as an array of one."""
    return F.when(value.isNotNull(), F.array(value))


def _notes() -> Column:
    return _concat(F.col("Notes.Note"), each(_services(), lambda s: s["Notes"]["Note"]))


def _profiles() -> Column:
    return _concat(
        F.transform(_services(), lambda s: s["OperatingProfile"]),
        F.transform(_journeys(), lambda v: v["OperatingProfile"]),
        F.transform(_flexible_journeys(), lambda v: v["OperatingProfile"]),
    )


def _text_items(array: Column) -> Column:
    return F.filter(array, lambda t: t.isNotNull())


def _patterns() -> Column:
    return each(_services(), lambda s: s["StandardService"]["JourneyPattern"])


def _links() -> Column:
    return each(
        F.col("JourneyPatternSections.JourneyPatternSection"), lambda s: s["JourneyPatternTimingLink"]
    )


def _flexible_patterns() -> Column:
    return each(_services(), lambda s: s["FlexibleService"]["FlexibleJourneyPattern"])


def _lines() -> Column:
    return each(
        _services(),
        lambda s: F.transform(
            s["Lines"]["Line"],
            lambda l: F.struct(l.alias("line"), s["ServiceCode"].alias("service_code")),
        ),
    )


def _organisations() -> Column:
    return F.col("ServicedOrganisations.ServicedOrganisation")


def _org_ranges() -> Column:
    return each(_organisations(), lambda o: o["WorkingDays"]["DateRange"])


def _root() -> Column:
    return F.array(
        F.struct(
            F.col("_Modification").alias("modification"),
            F.col("_RevisionNumber").alias("revision"),
            F.col("_CreationDateTime").alias("created"),
            F.col("_ModificationDateTime").alias("modified"),
        )
    )


def _first_noc() -> Column:
    operators = each(F.col("Operators"), lambda b: b["Operator"])
    codes = each(operators, lambda o: o["NationalOperatorCode"])
    return F.coalesce(F.get(codes, F.lit(0)), F.lit(""))


ROW_SETS = {
    "private_notes": lambda: _text_items(F.transform(_notes(), lambda n: n["Private"])),
    "note_texts": lambda: _text_items(F.transform(_notes(), lambda n: n["NoteText"])),
    "organisations": _organisations,
    "organisation_ranges": _org_ranges,
    "operator_groups": lambda: F.col("Operators"),
    "operators": lambda: each(F.col("Operators"), lambda b: b["Operator"]),
    "registrations": lambda: F.col("Registrations"),
    "garages": lambda: F.col("Garages.Garage"),
    "service_groups": lambda: F.col("Services"),
    "services": _services,
    "weekday_elements": lambda: _text_items(
        F.transform(_profiles(), lambda p: p["RegularDayType"]["DaysOfWeek"])
    ),
    "standard_parts": lambda: F.filter(
        F.transform(_services(), lambda s: s["StandardService"]), lambda p: p.isNotNull()
    ),
    "routes": lambda: F.col("Routes.Route"),
    "day_shifts": lambda: each(_journeys(), lambda v: v["DepartureDayShift"]),
    "mappings": lambda: each(
        each(F.col("RouteSections.RouteSection"), lambda s: s["RouteLink"]),
        lambda l: F.filter(F.transform(l["Track"], lambda t: t["Mapping"]), lambda m: m.isNotNull()),
    ),
    "timing_links": _links,
    "service_codes": lambda: _text_items(F.transform(_services(), lambda s: s["ServiceCode"])),
    "operating_periods": lambda: F.filter(
        F.transform(_services(), lambda s: s["OperatingPeriod"]), lambda p: p.isNotNull()
    ),
    "lines": lambda: F.transform(
        _lines(), lambda l: F.struct(l["line"].alias("line"), l["service_code"].alias("service_code"), _first_noc().alias("noc"))
    ),
    "link_sections": lambda: F.col("JourneyPatternSections.JourneyPatternSection"),
    "root": _root,
    "layovers": lambda: each(_journeys(), lambda v: v["LayoverPoint"]),
    "route_links": lambda: each(F.col("RouteSections.RouteSection"), lambda s: s["RouteLink"]),
    "journey_interchanges": lambda: _concat(
        _all("VehicleJourneys", "VehicleJourneyInterchange"),
        each(_journeys(), lambda v: v["VehicleJourneyInterchange"]),
    ),
    "pattern_interchanges": lambda: each(_patterns(), lambda p: p["JourneyPatternInterchange"]),
    "referring_journeys": lambda: F.filter(_journeys(), lambda v: v["VehicleJourneyRef"].isNotNull()),
    "patterns": _patterns,
    "link_starts": lambda: F.filter(F.transform(_links(), lambda l: l["From"]), lambda u: u.isNotNull()),
    "link_ends": lambda: F.filter(F.transform(_links(), lambda l: l["To"]), lambda u: u.isNotNull()),
    "journeys": _journeys,
    "journey_links": lambda: each(_journeys(), lambda v: v["VehicleJourneyTimingLink"]),
    "flexible_parts": lambda: F.filter(
        F.transform(_services(), lambda s: s["FlexibleService"]), lambda p: p.isNotNull()
    ),
    "flexible_patterns": _flexible_patterns,
    "journey_groups": lambda: F.col("VehicleJourneys"),
}


# Rows that rules with joins count.
TABLE_ROWS = {
    "holiday_elements": lambda: _holiday_elements(),
    "line_groups": lambda: _line_groups(),
    "stops": lambda: F.col("StopPoints.StopPoint"),
}

# Row sets that look at one item of a long section at a time; the others need what
# the skeleton of a large file holds.
OF_ITEMS = {
    "routes", "weekday_elements", "day_shifts", "mappings", "timing_links", "link_sections", "layovers", "route_links",
    "journey_interchanges", "referring_journeys", "link_starts", "link_ends", "journeys", "journey_links",
}


def service_type() -> Column:
    """A file is flexible with a flexible classification or a flexible part."""
    flexible = F.exists(
        _services(),
        lambda s: s["FlexibleService"].isNotNull() | F.coalesce(_is_classified_flexible(s), F.lit(False)),
    )
    return F.when(F.coalesce(flexible, F.lit(False)), FLEXIBLE).otherwise(STANDARD)


# ---------------------------------------------------------------- tests


def _is_classified_flexible(s: Column) -> Column:
    return F.coalesce(
        F.exists(s["ServiceClassification"], lambda c: c["Flexible"].isNotNull()), F.lit(False)
    )


def _day(text: Column) -> Column:
    return F.to_date(F.substring(text, 1, 10))


def _start(r: Column) -> Column:
    return _day(F.get(r["StartDate"], F.lit(0)))


def _started(today: Column):
    """A date range not in the future may not be provisional."""

    def test(r: Column) -> Column:
        return ((_start(r) <= today) & ~is_true(r["Provisional"])) | (_start(r) > today)

    return test


def _service_group(g: Column) -> Column:
    services = F.coalesce(g["Service"], F.array())

    def number(condition) -> Column:
        return F.size(F.filter(services, condition))

    registered = lambda s: matches_at_start(s["ServiceCode"], REGISTERED)
    standard = number(lambda s: registered(s) & s["StandardService"].isNotNull())
    flexible = number(lambda s: registered(s) & _is_classified_flexible(s))
    unregistered = number(lambda s: matches_at_start(s["ServiceCode"], UNREGISTERED))
    total = standard + flexible + unregistered
    return (total == 1) | ((total > 1) & (flexible == 1) & (standard == 0))


def _group_lines(g: Column) -> Column:
    return each(g["Service"], lambda s: s["Lines"]["Line"])


def _has_standard(g: Column) -> Column:
    return F.coalesce(F.exists(g["Service"], lambda s: s["StandardService"].isNotNull()), F.lit(False))


def _any_description(g: Column) -> Column:
    described = F.exists(
        _group_lines(g),
        lambda l: l["InboundDescription"].isNotNull() | l["OutboundDescription"].isNotNull(),
    )
    return ~_has_standard(g) | described


def _described(side: str):
    def test(g: Column) -> Column:
        empty = F.exists(
            _group_lines(g), lambda l: l[side].isNotNull() & l[side]["Description"].isNull()
        )
        return ~(_has_standard(g) & empty)

    return test


def _line_id(r: Column) -> Column:
    name = F.replace(F.coalesce(r["line"]["LineName"], F.lit("")), F.lit(" "), F.lit(""))
    expected = F.concat(r["noc"], F.lit(":"), F.coalesce(r["service_code"], F.lit("")), F.lit(":"), name)
    return F.startswith(F.coalesce(r["line"]["_id"], F.lit("")), expected)


def _links_join_up(s: Column) -> Column:
    links = F.coalesce(s["JourneyPatternTimingLink"], F.array())
    rest = F.greatest(F.size(links) - 1, F.lit(0))
    ends = F.zip_with(
        F.slice(links, F.lit(1), rest),
        F.slice(links, F.lit(2), rest),
        lambda a, b: F.coalesce(a["To"]["StopPointRef"], F.lit(""))
        == F.coalesce(b["From"]["StopPointRef"], F.lit("")),
    )
    return F.forall(ends, lambda ok: ok)


def _licence(o: Column) -> Column:
    return (F.lower(F.coalesce(o["PrimaryMode"], F.lit(""))) == "coach") | has_text(o["LicenceNumber"])


def _classification_agrees(s: Column) -> Column:
    return F.when(_is_classified_flexible(s), s["FlexibleService"].isNotNull()).otherwise(
        s["StandardService"].isNotNull()
    )


def _flexible_is_classified(s: Column) -> Column:
    return s["FlexibleService"].isNull() | _is_classified_flexible(s)


def _mixed_sequence(p: Column) -> Column:
    uses = stop_uses(p["StopPointsInSequence"])
    fixed = F.filter(uses, lambda u: ~u["is_flexible"])
    mixed = (F.size(fixed) > 0) & F.exists(uses, lambda u: u["is_flexible"])
    others = F.forall(fixed, lambda u: F.coalesce(u["timing_status"], F.lit("")) == "otherPoint")
    return ~mixed | others


def _booking(p: Column) -> Column:
    b = p["BookingArrangements"]

    def one(field: str) -> Column:
        return F.size(each(b, lambda x: x[field])) == 1

    return (count(b) > 0) & (one("Phone") | one("Email") | one("WebAddress"))


def _service_times(g: Column) -> Column:
    first = F.get(g["FlexibleVehicleJourney"], F.lit(0))
    return first.isNotNull() & first["FlexibleServiceTimes"].isNotNull()


def _modified(r: Column) -> Column:
    return F.when(r["revision"] == "0", r["modified"] == r["created"]).otherwise(
        r["created"] < r["modified"]
    )


def _modification(r: Column) -> Column:
    revision = F.coalesce(r["revision"], F.lit(""))
    return ((r["modification"] == "new") & (revision == "0")) | (
        (revision != "0") & (r["modification"] == "revise")
    )


def _period_order(p: Column) -> Column:
    return p["EndDate"].isNull() | (_day(p["StartDate"]) <= _day(p["EndDate"]))


def _period_length(p: Column) -> Column:
    return p["EndDate"].isNull() | (
        F.datediff(_day(p["EndDate"]), _day(p["StartDate"])) <= MAX_PERIOD_DAYS
    )


def _service_code(c: Column) -> Column:
    return matches_at_start(c, REGISTERED) | matches_at_start(c, UNREGISTERED)


def _interchange_tests():
    return [
        lambda x: count(x["InterchangeActivity"]) == 1,
        lambda x: count(x["GuaranteedConnection"]) == 1,
        lambda x: count(x["ChangeLineNumber"]) == 1,
    ]


def observations(today: Column) -> list[Observation]:
    """Observations that look at one document only. ``today`` is a parameter."""
    notes, orgs = "Notes", "Serviced organisations"
    ops, svc = "Operators, Garages and Registrations", "Services and Lines"
    routes, journeys, timing = "Routes and tracks", "Vehicle journeys", "Journey timings on standard services"
    must, flex = "Mandatory Element", "Flexible Service"
    day_names = [d.capitalize() for d in WEEKDAYS]
    o = Observation
    # Numbers, categories and references of the observations.
    return [
        o(8, notes, "2.5", "private_notes", "Private", [lambda t: ~is_true(t)]),
        o(10, orgs, "3.2", "organisations", "ServicedOrganisation", [
            lambda x: count(x["Name"]) == 1,
            lambda x: F.length(F.trim(F.get(x["Name"], F.lit(0)))) >= 5,
        ]),
        o(11, orgs, "3.2", "organisations", "ServicedOrganisation", [lambda x: present(x["WorkingDays"])]),
        o(11, orgs, "3.2", "organisation_ranges", "DateRange", [
            lambda r: count(r["StartDate"]) > 0,
            _started(today),
        ]),
        o(12, ops, "4.2", "operator_groups", "Operators", [lambda g: count(g["Operator"]) == 1]),
        o(13, ops, "4.2", "operator_groups", "Operators", [lambda g: count(g["LicensedOperator"]) == 0]),
        o(14, ops, "4.4", "registrations", "Registrations", [lambda r: F.lit(False)]),
        o(15, ops, "4.3", "garages", "Garage", [lambda g: count(g["GarageCode"]) == 1]),
        o(17, svc, "5.2", "service_groups", "Services", [lambda g: count(g["Service"]) == 1], STANDARD),
        o(17, svc, "5.2", "service_groups", "Services", [_service_group]),
        o(7, notes, "2.5", "note_texts", "NoteText", [lambda t: ~has_prohibited_characters(t)]),
        o(7, notes, "2.5", "note_texts", "NoteText", [lambda t: ~contains_date(t)]),
        o(41, journeys, "9.3.3", "weekday_elements", "DaysOfWeek", [lambda d: all_in(child_names(d), *day_names)]),
        o(9, orgs, "3.2", "organisation_ranges", "DateRange", [
            lambda r: count(r["StartDate"]) == 1,
            lambda r: count(r["EndDate"]) == 1,
        ]),
        o(50, orgs, "3.2", "organisations", "ServicedOrganisation", [lambda x: count(x["Holidays"]) == 0]),
        o(21, svc, "5.3.2", "standard_parts", "StandardService", [lambda p: count(p["JourneyPattern"]) > 0]),
        o(25, svc, "5.5.4", "service_groups", "Services", [_any_description], STANDARD),
        o(26, svc, "5.5.4", "service_groups", "Services", [_described("InboundDescription")], STANDARD),
        o(27, svc, "5.5.4", "service_groups", "Services", [_described("OutboundDescription")], STANDARD),
        o(30, routes, "7.2", "routes", "Route", [lambda r: count(r["ReversingManoeuvres"]) == 0]),
        o(46, journeys, "9.2", "day_shifts", "DepartureDayShift", [lambda d: d == "1"]),
        o(32, routes, "7.1", "mappings", "Mapping", [lambda m: count(m["Location"]) > 1]),
        o(38, timing, "8.4.4", "timing_links", "JourneyPatternTimingLink", [
            lambda l: present(l["From"]["_SequenceNumber"]),
            lambda l: present(l["To"]["_SequenceNumber"]),
        ]),
        o(18, svc, "5.3.2", "service_codes", "ServiceCode", [_service_code]),
        o(20, svc, "5.3.3", "operating_periods", "OperatingPeriod", [_period_order, _period_length]),
        o(24, svc, "5.5", "lines", "Line", [_line_id]),
        o(22, svc, "5.3.5", "services", "Service", [_classification_agrees]),
        o(37, timing, "8.4.3", "link_sections", "JourneyPatternSection", [_links_join_up]),
        o(2, "Versioning", "2.3", "root", "TransXChange", [_modified]),
        o(3, "Versioning", "2.3", "root", "TransXChange", [_modification]),
        o(19, "Layover Point", "9.7.2", "layovers", "LayoverPoint", [lambda p: count(p["Location"]) > 0]),
        o(31, routes, "7.3", "route_links", "RouteLink", [lambda l: count(l["Direction"]) == 0]),
        o(50, "Vehicle Journey Interchange", "9.6.1", "journey_interchanges", "VehicleJourneyInterchange", _interchange_tests()),
        o(52, "Vehicle Journey Interchange", "5.3.6.2", "pattern_interchanges", "JourneyPatternInterchange", _interchange_tests()),
        o(39, journeys, "9.2", "referring_journeys", "VehicleJourneyRef", [lambda v: v["OperatingProfile"].isNull()]),
        o(104, must, "0", "operators", "Operator", [lambda x: count(x["NationalOperatorCode"]) == 1]),
        o(127, must, "0", "operators", "Operator", [_licence]),
        o(105, must, "0", "services", "Service", [lambda s: count(s["PublicUse"]) > 0]),
        o(110, must, "0", "patterns", "JourneyPattern", [lambda p: count(p["OperatorRef"]) == 1]),
        o(111, must, "0", "patterns", "JourneyPattern", [lambda p: count(p["Direction"]) == 1]),
        o(112, must, "0", "patterns", "JourneyPattern", [lambda p: count(p["RouteRef"]) == 1]),
        o(113, must, "0", "patterns", "JourneyPattern", [lambda p: count(p["JourneyPatternSectionRefs"]) > 0]),
        o(114, must, "0", "timing_links", "JourneyPatternTimingLink", [lambda l: present(l["RouteLinkRef"])]),
        o(129, must, "0", "link_starts", "From", [lambda u: present(u["TimingStatus"])]),
        o(131, must, "0", "link_ends", "To", [lambda u: present(u["TimingStatus"])]),
        o(117, must, "0", "journeys", "VehicleJourney", [lambda v: count(v["OperatorRef"]) > 0]),
        o(118, must, "0", "journey_links", "VehicleJourneyTimingLink", [lambda l: present(l["RunTime"])]),
        o(119, flex, "10", "services", "Service", [_flexible_is_classified], FLEXIBLE),
        o(120, flex, "10", "flexible_parts", "FlexibleService", [lambda p: count(p["FlexibleJourneyPattern"]) > 0], FLEXIBLE),
        o(121, flex, "10", "flexible_patterns", "FlexibleJourneyPattern", [_mixed_sequence], FLEXIBLE),
        o(123, flex, "10", "flexible_patterns", "FlexibleJourneyPattern", [_booking], FLEXIBLE),
        o(124, flex, "10", "journey_groups", "VehicleJourneys", [_service_times], FLEXIBLE),
    ]


# ----------------------------------------------------------- table rules


def _journey_table(docs: DataFrame) -> DataFrame:
    return numbered(docs, _journeys(), "v")


def _pattern_table(docs: DataFrame) -> DataFrame:
    return numbered(docs, _patterns(), "p")


def destination_display(docs: DataFrame, **_: DataFrame) -> DataFrame:
    """A display at the pattern, or at both ends of all its links, or at all
    journeys that name the pattern (by equality)."""
    patterns = _pattern_table(docs).where("p.DestinationDisplay is null").select(
        "file_id", "ordinal", F.col("p._id").alias("jp_id"), F.col("p.JourneyPatternSectionRefs").alias("refs")
    )
    sections = docs.select(
        "file_id", F.explode("JourneyPatternSections.JourneyPatternSection").alias("s")
    ).select(
        "file_id",
        F.col("s._id").alias("section_id"),
        F.forall(
            F.coalesce(F.col("s.JourneyPatternTimingLink"), F.array()),
            lambda l: l["From"]["DynamicDestinationDisplay"].isNotNull()
            & l["To"]["DynamicDestinationDisplay"].isNotNull(),
        ).alias("dynamic"),
    )
    undisplayed_section = (
        patterns.select("file_id", "ordinal", F.explode("refs").alias("section_id"))
        .join(sections.where("not dynamic"), ["file_id", "section_id"])
        .select("file_id", "ordinal")
        .distinct()
    )
    undisplayed_journey = (
        _journey_table(docs)
        .where("v.DestinationDisplay is null")
        .select("file_id", F.col("v.JourneyPatternRef").alias("jp_id"))
        .distinct()
    )
    bad = patterns.join(undisplayed_journey, ["file_id", "jp_id"], "left_semi").join(
        undisplayed_section, ["file_id", "ordinal"], "left_semi"
    )
    return violation_rows(bad, 47, "Vehicle journeys", "9.1", "JourneyPattern", "patterns")


def run_time(docs: DataFrame, **_: DataFrame) -> DataFrame:
    """A pattern link with running time forbids From and To on the journey link.

    Of a file's journey links for one pattern link the last one counts.
    """
    journey_links = _journey_table(docs).select(
        "file_id", "ordinal", F.posexplode("v.VehicleJourneyTimingLink").alias("pos", "l")
    )
    last = journey_links.groupBy("file_id", F.col("l.JourneyPatternTimingLinkRef").alias("link_id")).agg(
        F.max_by(
            F.col("l.From").isNotNull() | F.col("l.To").isNotNull(), F.struct("ordinal", "pos")
        ).alias("has_ends")
    )
    links = numbered(docs, _links(), "l")
    time_part = F.regexp_replace("l.RunTime", r"^(-?P)[^T]*", "$1")
    bad = (
        links.where(duration_seconds(time_part) != 0)
        .select("file_id", "ordinal", F.col("l._id").alias("link_id"))
        .join(last.where("has_ends"), ["file_id", "link_id"])
    )
    return violation_rows(bad, 34, "Journey timings on standard services", "8.1", "JourneyPatternTimingLink", "timing_links")


def _holiday_elements() -> Column:
    def rows(owner: Column, ref: str) -> Column:
        return F.flatten(F.transform(owner, lambda o: F.coalesce(F.transform(
            o["OperatingProfile"]["BankHolidayOperation"],
            lambda b: F.struct(
                o[ref].alias("service_ref"),
                F.concat(child_names(b["DaysOfOperation"]), child_names(b["DaysOfNonOperation"])).alias("names"),
            ),
        ), F.array().cast("array<struct<service_ref:string,names:array<string>>>"))))

    return F.concat(
        rows(_services(), "ServiceCode"), rows(_journeys(), "ServiceRef"), rows(_flexible_journeys(), "ServiceRef")
    )


def bank_holidays(docs: DataFrame, regions: DataFrame | None = None, **_: DataFrame) -> DataFrame:
    """Bank holidays named once each, and exactly the nation's list.

    ``regions(service_ref, is_scottish)`` tells which services are Scottish
    only; without it all count as English.
    """
    table = numbered(docs, _holiday_elements(), "h").select(
        "file_id",
        "ordinal",
        "h.service_ref",
        F.filter("h.names", lambda n: ~n.isin(*HOLIDAYS_IGNORED)).alias("names"),
    )
    if regions is None:
        table = table.withColumn("is_scottish", F.lit(False))
    else:
        table = table.join(regions.select("service_ref", "is_scottish"), "service_ref", "left")

    def equals(expected: tuple, optional: tuple) -> Column:
        named = F.array_except("names", F.array(*[F.lit(n) for n in optional]))
        return F.array_sort(named) == F.array(*[F.lit(n) for n in sorted(expected)])

    english = equals(HOLIDAYS_COMMON + HOLIDAYS_ENGLISH, HOLIDAYS_SCOTTISH)
    scottish = equals(HOLIDAYS_COMMON + HOLIDAYS_SCOTTISH, HOLIDAYS_ENGLISH)
    once = F.size(F.array_distinct("names")) == F.size("names")
    right = F.when(F.coalesce("is_scottish", F.lit(False)), scottish).otherwise(english)
    return violation_rows(table.where(~(once & right)), 43, "Vehicle journeys", "9.3.5", "BankHolidayOperation", "holiday_elements")


def unrelated_lines(line_patterns: DataFrame, line_features: DataFrame, lines: DataFrame) -> DataFrame:
    """Files with two lines or more that are not all related, as ``file_id``.

    Related means: every two lines share a journey pattern, or every two lines
    that have any share a feature (stop, stop area or locality). A pattern or
    feature common to all lines settles a file at once. For the others each
    feature's lines are a bitmap, and a line's are the union of those of its
    features: the lines it is connected with. All are related if every union is
    full. No pair of lines is ever a row; features with equal bitmaps are
    one. Rows of both bridges are distinct.
    """
    total = lines.select("file_id", "line_id").distinct().groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    many = lines.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("file_id")

    def connected(bridge: DataFrame, feature: str, size: DataFrame) -> DataFrame:
        rows = bridge.select("file_id", "line_id", F.col(feature).alias("feature"))
        spread = rows.groupBy("file_id", "feature").agg(F.count(F.lit(1)).alias("k")).join(size, "file_id")
        common = spread.where("k = n").select("file_id").distinct()
        open_ = rows.join(common, "file_id", "left_anti")
        place = F.row_number().over(Window.partitionBy("file_id").orderBy("line_id")) - 1
        numbers = open_.select("file_id", "line_id").distinct().withColumn("place", place)
        bits = (
            open_.join(numbers, ["file_id", "line_id"])
            .groupBy("file_id", "feature", F.floor(F.col("place") / 64).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        )
        sets = (
            bits.groupBy("file_id", "feature")
            .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("set"))
            .groupBy("file_id", "set")
            .agg(F.min("feature").alias("feature"))
        )
        words = sets.select("file_id", "feature", F.inline("set"))
        full = (
            open_.join(words, ["file_id", "feature"])
            .groupBy("file_id", "line_id", "word")
            .agg(F.bit_or("bits").alias("bits"))
            .groupBy("file_id", "line_id")
            .agg(F.sum(F.bit_count("bits")).alias("reached"))
            .join(size, "file_id")
            .groupBy("file_id")
            .agg((F.count_if(F.col("reached") == F.col("n")) == F.max("n")).alias("full"))
            .where("full")
            .select("file_id")
        )
        return common.unionByName(full)

    by_pattern = connected(line_patterns, "jp_ref", total)
    mapped = line_patterns.select("file_id", "line_id").distinct().groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    few = many.join(mapped.where("n > 1"), "file_id", "left_anti")
    by_feature = connected(line_features, "feature", mapped)
    related = by_pattern.unionByName(few).unionByName(by_feature)
    return many.join(related, "file_id", "left_anti")


def _line_groups() -> Column:
    return F.filter(F.transform(_services(), lambda s: s["Lines"]), lambda l: l.isNotNull())


def lines_related(docs: DataFrame, stops: DataFrame | None = None, **_: DataFrame) -> DataFrame:
    """The lines of a file are related. ``stops(atco_code, stop_areas)`` is the register.

    Files with one line pass, so only the others are read. The two bridges are
    used several times over and are small next to the documents: staged.
    """
    lines_of = F.size(each(_services(), lambda s: s["Lines"]["Line"]))
    if "place" in docs.columns:
        several = docs.groupBy("file_id").agg(F.sum(lines_of).alias("n")).where("n > 1")
        docs = docs.join(several, "file_id", "left_semi")
    else:
        docs = docs.where(lines_of > 1)
    lines = src.lines(docs).select("file_id", "line_id")
    journeys = src.vehicle_journeys(docs)
    patterns = journey_reference_chain(journeys)
    line_patterns = staged(
        journeys.select("file_id", "vj_code", F.col("line_ref").alias("line_id"))
        .join(patterns.where("jp_ref is not null"), ["file_id", "vj_code"])
        .join(lines, ["file_id", "line_id"], "left_semi")
        .select("file_id", "line_id", "jp_ref")
        .distinct()
    )
    refs = _pattern_table(docs).select(
        "file_id", F.col("p._id").alias("jp_ref"), F.explode("p.JourneyPatternSectionRefs").alias("section_id")
    )
    ends = docs.select(
        "file_id", F.explode("JourneyPatternSections.JourneyPatternSection").alias("s")
    ).select(
        "file_id",
        F.col("s._id").alias("section_id"),
        F.explode(
            F.flatten(
                F.transform(
                    "s.JourneyPatternTimingLink",
                    lambda l: F.array(l["From"]["StopPointRef"], l["To"]["StopPointRef"]),
                )
            )
        ).alias("stop_ref"),
    ).where("stop_ref is not null").distinct()
    line_stops = (
        line_patterns.join(refs, ["file_id", "jp_ref"])
        .join(ends, ["file_id", "section_id"])
        .select("file_id", "line_id", "stop_ref")
        .distinct()
    )
    listed = src.stop_points(docs)
    features = line_stops.select(
        "file_id", "line_id", F.concat(F.lit("stop:"), "stop_ref").alias("feature")
    )
    local = listed.where("is_reference and locality_name <> ''").select(
        "file_id", F.col("atco_code").alias("stop_ref"), F.concat(F.lit("locality:"), "locality_name").alias("feature")
    )
    features = features.unionByName(
        line_stops.join(local, ["file_id", "stop_ref"]).select("file_id", "line_id", "feature")
    )
    if stops is not None:
        areas = listed.select("file_id", "atco_code").distinct().join(
            stops.select("atco_code", F.explode("stop_areas").alias("area")), "atco_code"
        ).select("file_id", F.col("atco_code").alias("stop_ref"), F.concat(F.lit("area:"), "area").alias("feature"))
        features = features.unionByName(
            line_stops.join(areas, ["file_id", "stop_ref"]).select("file_id", "line_id", "feature")
        )
    bad = unrelated_lines(line_patterns, staged(features.distinct()), lines)
    groups = numbered(docs, _line_groups(), "l")
    return violation_rows(groups.join(bad, "file_id", "left_semi"), 23, "Services and Lines", "5.4", "Lines", "line_groups")


def two_month_stops(docs: DataFrame, **_: DataFrame) -> DataFrame:
    """A stop described in the file serves non-coach journeys for two months at most.

    Stop to route links to timing links to sections to patterns (first section
    only) to journeys to the dates of their profiles; the first service's
    period stands in for missing dates. No dates at all fails, no profile passes.
    """
    stop = numbered(docs, F.col("StopPoints.StopPoint"), "s").select(
        "file_id", "ordinal", F.coalesce("s.AtcoCode", F.lit("")).alias("stop_ref")
    )
    route_links = src.route_links(docs).select(
        "file_id", F.col("link_id").alias("route_link"), F.explode(F.array("from_stop", "to_stop")).alias("stop_ref")
    )
    links = docs.select(
        "file_id", F.explode("JourneyPatternSections.JourneyPatternSection").alias("s")
    ).select(
        "file_id", F.col("s._id").alias("section_id"), F.explode("s.JourneyPatternTimingLink").alias("l")
    ).select("file_id", "section_id", F.col("l.RouteLinkRef").alias("route_link")).distinct()
    patterns = _pattern_table(docs).select(
        "file_id",
        F.col("p._id").alias("jp_id"),
        F.get(F.col("p.JourneyPatternSectionRefs"), F.lit(0)).alias("section_id"),
    )
    modes = numbered(docs, _services(), "s").withColumnRenamed("ordinal", "service_pos")
    coach = modes.groupBy("file_id", F.col("s.ServiceCode").alias("service_ref")).agg(
        F.min_by(F.lower(F.coalesce("s.Mode", F.lit(""))), "service_pos").alias("mode")
    ).where("mode = 'coach'")
    period = modes.where("s.OperatingPeriod is not null").groupBy("file_id").agg(
        F.min_by(F.col("s.OperatingPeriod"), "service_pos").alias("period")
    )
    # First profile of each journey code; its first dates in document order.
    profile = F.col("v.OperatingProfile")
    ranges = F.concat(
        *[
            F.coalesce(profile["SpecialDaysOperation"][side]["DateRange"], F.array())
            for side in ("DaysOfOperation", "DaysOfNonOperation")
        ]
    )

    def first(field: str) -> Column:
        dates = each(ranges, lambda r: r[field])
        return F.nullif(F.get(dates, F.lit(0)), F.lit(""))

    profiles = _journey_table(docs).where("v.OperatingProfile is not null").groupBy(
        "file_id", F.col("v.VehicleJourneyCode").alias("vj_code")
    ).agg(F.min_by(F.struct(first("StartDate").alias("start"), first("EndDate").alias("end")), "ordinal").alias("d"))
    dated = profiles.join(period, "file_id", "left").select(
        "file_id",
        "vj_code",
        _day(F.coalesce("d.start", F.nullif("period.StartDate", F.lit("")))).alias("start"),
        _day(F.coalesce("d.end", F.nullif("period.EndDate", F.lit("")))).alias("end"),
    )
    too_long = dated.where(~F.coalesce(F.col("end") <= F.add_months("start", 2), F.lit(False)))
    journeys = (
        src.vehicle_journeys(docs)
        .select("file_id", "vj_code", F.col("jp_ref").alias("jp_id"), "service_ref")
        .join(coach, ["file_id", "service_ref"], "left_anti")
        .join(too_long, ["file_id", "vj_code"], "left_semi")
        .select("file_id", "jp_id")
        .distinct()
    )
    sections = patterns.join(journeys, ["file_id", "jp_id"], "left_semi").select("file_id", "section_id")
    bad_links = links.join(sections, ["file_id", "section_id"], "left_semi").select("file_id", "route_link")
    bad_stops = route_links.join(bad_links, ["file_id", "route_link"], "left_semi").select("file_id", "stop_ref")
    bad = stop.join(bad_stops, ["file_id", "stop_ref"], "left_semi")
    return violation_rows(bad, 28, "Stop points and stop areas", "6", "StopPoint", "stops")


def flexible_stop_refs(docs: DataFrame, stops: DataFrame | None = None, **_: DataFrame) -> DataFrame:
    """Every flexible stop of a flexible pattern is a flexible bus stop of the register."""
    flexible = docs.where(service_type() == FLEXIBLE)
    if "place" in docs.columns:
        flexible = docs.join(flexible.select("file_id").distinct(), "file_id", "left_semi")
    refs = numbered(flexible, _flexible_patterns(), "p").select(
        "file_id",
        "ordinal",
        F.explode(
            F.concat(stop_uses(F.col("p.StopPointsInSequence")), stop_uses(F.col("p.FlexibleZones")))
        ).alias("u"),
    )
    wanted = refs.where("u.is_flexible").select("file_id", "ordinal", F.col("u.stop_ref").alias("atco_code")).distinct()
    if stops is None:
        # Without a register there is nothing to check against.
        known = wanted.select("atco_code")
    else:
        known = stops.where("stop_type = 'BCT' and bus_stop_type = 'FLX'").select("atco_code")
    wanted = wanted.join(known, "atco_code", "left_anti")
    bad = wanted.select("file_id", "ordinal").distinct()
    return violation_rows(bad, 125, "Flexible Service", "10", "FlexibleJourneyPattern", "flexible_patterns")


TABLE_RULES = [
    bank_holidays,
    destination_display,
    run_time,
    lines_related,
    two_month_stops,
    flexible_stop_refs,
]


def catalogue(today: Column | None = None, table_rules: bool = True, row_sets: set[str] | None = None) -> Catalogue:
    """All observations, or those of some row sets."""
    made = Catalogue(ROW_SETS)
    for observation in observations(today if today is not None else F.current_date()):
        if row_sets is None or observation.row_set in row_sets:
            made.add(observation)
    if table_rules:
        for rule in TABLE_RULES:
            made.add_table_rule(rule)
    return made


def timetable_violations(
    docs: DataFrame,
    today: Column | None = None,
    regions: DataFrame | None = None,
    stops: DataFrame | None = None,
) -> DataFrame:
    """All violations of the timetable catalogue.

    ``docs`` should be staged ones (``headway.sources.documents.stage``): the
    joining rules read a dozen section tables from them, each its own columns only.
    """
    return catalogue(today).run(docs, service_type(), regions=regions, stops=stops)
