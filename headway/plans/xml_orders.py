"""Timetable documents written out of the orders table, one per order.

Every part of a document follows from the order's key and date, defects
included, so that what readers and rules should find can be said in SQL too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.plans.registry import Tables
from headway.rules.timetable import HOLIDAYS_COMMON, HOLIDAYS_ENGLISH, HOLIDAYS_SCOTTISH

K = F.col


def _part(value) -> Column:
    return F.lit(value) if isinstance(value, str) else F.coalesce(value.cast("string"), F.lit(""))


def join(*parts) -> Column:
    return F.concat(*[_part(p) for p in parts])


def tag(name: str, *children, **attributes) -> Column:
    head: list = [f"<{name}"]
    for key, value in attributes.items():
        head += [f' {key}="', value, '"']
    return join(*head, ">", *children, f"</{name}>")


def when(condition: Column, *parts) -> Column:
    return F.when(condition, join(*parts)).otherwise("")


def repeat(upto: Column, body) -> Column:
    """Concatenate ``body(i)`` for i = 0 .. upto."""
    return F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), upto.cast("bigint")), body), "")


def names(*days: str) -> str:
    return "".join(f"<{d}/>" for d in days)


def timetable_documents(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")

    def date(shift) -> Column:
        return F.date_format(F.date_add(day, shift), "yyyy-MM-dd")

    code = F.when(k % 13 == 0, "bad code").otherwise(join("PD", F.lpad(k.cast("string"), 7, "0"), ":1"))
    odd = k % 2

    notes = when(k % 5 == 0, tag("Notes", tag("Note",
        tag("NoteText", F.when(k % 25 == 0, "Stop #4").when(k % 15 == 0, "See 2024-01-05 notice").otherwise("Term time only")),
        tag("Private", F.when(k % 20 == 0, "true").otherwise("false")))))
    organisations = when(k % 3 == 0, tag("ServicedOrganisations", tag("ServicedOrganisation",
        tag("OrganisationCode", "ORG"),
        tag("Name", F.when(odd == 0, "School").otherwise("Abc")), when(k % 9 == 0, tag("Name", "Second name")),
        when(k % 4 != 0, tag("WorkingDays", tag("DateRange",
            tag("StartDate", "2020-01-01"), when(k % 27 == 0, tag("StartDate", "2020-01-02")),
            when(k % 15 != 0, tag("EndDate", "2020-02-01")), when(k % 21 == 0, tag("Provisional", "true"))))),
        when(k % 6 == 0, tag("Holidays", tag("DateRange", tag("StartDate", "2021-01-01"), tag("EndDate", "2021-01-02")))))))
    operators = tag("Operators",
        tag("Operator", when(k % 8 != 0, tag("NationalOperatorCode", "OPER")), tag("OperatorShortName", join("Op ", c % 50)),
            when(k % 7 != 0, tag("LicenceNumber", "LIC")), tag("PrimaryMode", F.when(k % 14 == 0, "Coach").otherwise("bus")), id="O1"),
        when(k % 16 == 0, tag("Operator", tag("NationalOperatorCode", "OPR2"), tag("LicenceNumber", "LIC2"), id="O2")),
        when(k % 18 == 0, tag("LicensedOperator", tag("NationalOperatorCode", "OPR3"), id="O3")))
    registrations = when(k % 17 == 0, "<Registrations/>")
    garages = when(k % 11 == 0, tag("Garages", tag("Garage", when(k % 22 != 0, tag("GarageCode", "G")))))

    lines = tag("Lines", repeat(odd, lambda j: tag("Line", tag("LineName", join("L", j)),
        when(k % 3 == 0, tag("InboundDescription", tag("Origin", "A"), when(k % 9 != 0, tag("Description", "in")))),
        when(k % 5 == 0, tag("OutboundDescription", tag("Origin", "B"), when(k % 10 != 0, tag("Description", "out")))),
        id=F.when(k % 19 == 0, "x").otherwise(join("OPER:", code, ":L", j)))))
    period = tag("OperatingPeriod", tag("StartDate", date(0)), F.when(k % 6 == 1, "").when(k % 6 == 2, tag("EndDate", date(-1)))
        .when(k % 6 == 3, tag("EndDate", date(5000))).otherwise(tag("EndDate", date(100))))
    interchange = tag("JourneyPatternInterchange", tag("InterchangeActivity", "a"), tag("GuaranteedConnection", "true"))
    pattern = lambda i: tag("JourneyPattern",
        when(k % 4 != 1, tag("DestinationDisplay", "Town")), when(k % 25 != 1, tag("OperatorRef", "O1")),
        when(k % 29 != 1, tag("Direction", F.when(k % 4 < 2, "inbound").otherwise("outbound"))),
        when(k % 26 != 1, tag("RouteRef", "R0")), when(k % 28 != 1, tag("JourneyPatternSectionRefs", join("S", i))),
        when(k % 31 == 0, interchange), id=join("JP", i))
    standard = when(~(k % 20).isin(1, 4), tag("StandardService", tag("Origin", "Start"), tag("Destination", "End"),
        when(k % 24 != 0, repeat(odd, pattern))))
    flexible_pattern = tag("FlexibleJourneyPattern", tag("Direction", "outbound"),
        tag("StopPointsInSequence",
            tag("FixedStopUsage", tag("StopPointRef", join("ST", k % 7)), tag("TimingStatus", F.when(k % 3 == 0, "principalPoint").otherwise("otherPoint"))),
            tag("FlexibleStopUsage", tag("StopPointRef", join("FX", k % 5)))),
        tag("FlexibleZones", tag("FlexibleStopUsage", tag("StopPointRef", join("FX", k % 5)))),
        when(k % 7 != 0, tag("BookingArrangements", tag("Description", "Call   us"), tag("Phone", tag("TelNationalNumber", "0123")),
            F.when(k % 7 == 1, tag("Phone", tag("TelNationalNumber", "0456"))).otherwise(tag("Email", "a@b.c")))), id="FJP0")
    flexible = when((k % 20).isin(1, 3), tag("FlexibleService", tag("Origin", "F1"), tag("Destination", "F2"),
        when(k % 40 != 3, flexible_pattern)))
    first = tag("Service", tag("ServiceCode", code), lines, period,
        when((k % 20).isin(1, 2), "<ServiceClassification><Flexible/></ServiceClassification>"),
        tag("Mode", "bus"), when(k % 23 != 0, tag("PublicUse", "true")), standard, flexible)
    spare = join("UZ", F.lpad(k.cast("string"), 7, "0"), ":2")
    second = when(k % 10 == 3, tag("Service", tag("ServiceCode", spare),
        tag("Lines", tag("Line", tag("LineName", "LX"), id=join("OPER:", spare, ":LX"))),
        tag("OperatingPeriod", tag("StartDate", date(0))), tag("Mode", "bus"), tag("PublicUse", "true"),
        tag("StandardService", tag("Origin", "X"), tag("Destination", "Y"), tag("JourneyPattern",
            tag("DestinationDisplay", "Z"), tag("OperatorRef", "O1"), tag("Direction", "inbound"), tag("RouteRef", "R0"),
            tag("JourneyPatternSectionRefs", "S0"), id="JPX"))))
    services = tag("Services", first, second)

    def stop(i: Column, j) -> Column:
        gap = F.when(k % 5 == 0, 2).otherwise(3)
        return join("ST", (k + gap * i + j) % 7)

    locations = tag("Location", tag("Longitude", "-1.5"), tag("Latitude", "52.0"), id="p0")
    more = tag("Location", tag("Longitude", "-1.49"), tag("Latitude", "52.01"), id="p1")
    zero = F.lit(0).cast("bigint")
    route_sections = tag("RouteSections", tag("RouteSection",
        tag("RouteLink", tag("From", tag("StopPointRef", stop(zero, 0))), tag("To", tag("StopPointRef", stop(zero, 1))),
            tag("Distance", k % 900), tag("Track", tag("Mapping", locations, when(k % 33 != 0, more))), id="RL0"),
        tag("RouteLink", tag("From", tag("StopPointRef", stop(zero, 1))), tag("To", tag("StopPointRef", stop(zero, 2))),
            when(k % 32 == 0, tag("Direction", "inbound")), id="RL1"), id="RS0"))
    routes = tag("Routes", tag("Route", when(k % 3 != 0, tag("Description", "Route")), tag("RouteSectionRef", "RS0"),
        tag("RouteSectionRef", "RS9"), when(k % 34 == 0, "<ReversingManoeuvres/>"), id="R0"))

    def use(i: Column, j: int, at: int, with_number: Column, with_status: Column) -> Column:
        name = "From" if at == j else "To"
        shift = F.lit(at) if at != j or j == 0 else F.when(k % 36 == 0, 6).otherwise(at)
        body = join(tag("WaitTime", F.when(k % 4 == 0, "PT0S").otherwise(join("PT", k % 50, "S"))),
            when(k % 8 == 1, tag("DynamicDestinationDisplay", "D")), tag("StopPointRef", stop(i, shift)),
            when(with_status, tag("TimingStatus", F.when(k % 3 == 0, "principalTimingPoint").otherwise("otherPoint"))))
        return join(f"<{name}", when(with_number, f' SequenceNumber="{at + 1}"'), ">", body, f"</{name}>")

    def link(i: Column, j: int) -> Column:
        return tag("JourneyPatternTimingLink",
            use(i, j, j, F.lit(True), k % 38 != 0), use(i, j, j + 1, k % 35 != 0, k % 39 != 0),
            when(k % 37 != 0, tag("RouteLinkRef", f"RL{j}")), tag("RunTime", "PT0S" if j == 0 else "PT5M"), id=join("S", i, f"L{j}"))

    sections = tag("JourneyPatternSections", repeat(odd, lambda i: tag("JourneyPatternSection", link(i, 0), link(i, 1), id=join("S", i))))

    english, scottish = names(*HOLIDAYS_COMMON, *HOLIDAYS_ENGLISH), names(*HOLIDAYS_COMMON, *HOLIDAYS_SCOTTISH)
    other = "<OtherPublicHoliday><Description>Fair</Description><Date>2024-01-02</Date></OtherPublicHoliday>"
    bank = F.when(k % 15 == 4, tag("BankHolidayOperation", tag("DaysOfOperation", english, other))).when(
        k % 15 == 9, tag("BankHolidayOperation", tag("DaysOfOperation", names(*HOLIDAYS_COMMON)), tag("DaysOfNonOperation", names(*HOLIDAYS_SCOTTISH)))
    ).when(k % 15 == 14, tag("BankHolidayOperation", tag("DaysOfNonOperation", english, "<ChristmasDay/>"))).otherwise("")
    special = when(k % 4 == 3, tag("SpecialDaysOperation", tag("DaysOfOperation", tag("DateRange", tag("StartDate", date(1)), tag("EndDate", date(3))))))
    profile0 = tag("OperatingProfile", tag("RegularDayType", tag("DaysOfWeek", F.when(k % 45 < 3, "<MondayToFriday/>").otherwise("<Monday/><Friday/>"))), special, bank)
    profile1 = tag("OperatingProfile", tag("RegularDayType", tag("DaysOfWeek", "<Monday/>")))
    line_ref = lambda j: tag("LineRef", F.when(k % 19 == 0, "x").otherwise(join("OPER:", code, ":L", j)))
    operator_ref = when(k % 42 != 0, tag("OperatorRef", "O1"))
    service_ref = tag("ServiceRef", join("SV", c % 4))
    vj0 = tag("VehicleJourney", operator_ref,
        tag("Operational", tag("TicketMachine", tag("JourneyCode", k % 1000)), tag("Block", when(odd == 1, tag("Description", "b")), tag("BlockNumber", k % 30))),
        profile0, when(k % 3 == 0, tag("DestinationDisplay", "D")),
        when(k % 44 < 4, tag("LayoverPoint", tag("Duration", "PT5M"), when(k % 44 != 0, tag("Location", "1")))),
        tag("VehicleJourneyCode", "VJ0"), service_ref, line_ref(zero), tag("JourneyPatternRef", "JP0"),
        when(k % 43 < 5, tag("DepartureDayShift", odd)), tag("DepartureTime", F.when(k % 50 == 0, "").otherwise("08:15:00")),
        tag("VehicleJourneyTimingLink", tag("JourneyPatternTimingLinkRef", "S0L1"), when(k % 47 != 0, tag("RunTime", "PT6M")),
            when(k % 5 == 2, tag("From", tag("WaitTime", "PT1M")))),
        when(k % 48 == 0, tag("VehicleJourneyInterchange", tag("GuaranteedConnection", "true"), tag("ChangeLineNumber", "true"))))
    vj1 = tag("VehicleJourney", operator_ref, when(k % 4 == 0, profile1), when(k % 3 == 0, tag("DestinationDisplay", "D")),
        tag("VehicleJourneyCode", "VJ1"), service_ref, line_ref(odd),
        F.when(k % 6 == 3, tag("VehicleJourneyRef", "VJ0")).otherwise(tag("JourneyPatternRef", join("JP", odd))),
        when(k % 12 == 8, tag("VehicleJourneyRef", "VJ0")), tag("DepartureTime", "09:30:00"))
    flexible_journey = when((k % 20).isin(1, 3), tag("FlexibleVehicleJourney", tag("VehicleJourneyCode", "FVJ0"), service_ref, tag("LineRef", "LF"),
        tag("JourneyPatternRef", "FJP0"), when(k % 3 != 1, tag("FlexibleServiceTimes", F.when(k % 3 == 0, "<AllDayService/>").otherwise(
            tag("ServicePeriod", tag("StartTime", "07:00:00"), tag("EndTime", "19:00:00")))))))
    journeys = tag("VehicleJourneys", vj0, vj1, flexible_journey)

    town = lambda n: tag("AnnotatedStopPointRef", tag("StopPointRef", f"ST{n}"), tag("CommonName", f"Stop {n}"), tag("LocalityName", "Town"))
    own = when(k % 9 == 2, tag("StopPoint", tag("AtcoCode", join("ST", k % 7)), tag("Descriptor", tag("CommonName", join("Own ", k % 7))),
        tag("Place", tag("NptgLocalityRef", "E1"), tag("Location", tag("Translation", tag("Longitude", "-2.25"), tag("Latitude", "53.5")))),
        tag("StopClassification", tag("StopType", "BCT")), tag("AdministrativeAreaRef", "1")))
    stop_points = tag("StopPoints", town(0), town(3), own)

    text = tag("TransXChange", notes, organisations, stop_points, route_sections, routes, sections, operators, registrations,
        garages, services, journeys, SchemaVersion=F.when(k % 30 == 0, "2.1").otherwise("2.4"),
        CreationDateTime=join(date(0), "T00:00:00"), ModificationDateTime=join(date(odd.cast("int")), "T00:00:00"),
        Modification=F.when(k % 4 == 0, "new").otherwise("revise"), RevisionNumber=k % 3, FileName=join("f", k, ".xml"))
    orders = t.spread(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    return orders.select(k.alias("file_id"), text.alias("text"))


# What the timetable rules should find, as (file_id, observation, element, ordinal).
_FLEX = "k % 20 IN (1, 2, 3)"
_STD = "k % 20 NOT IN (1, 4)"
_PATTERNS = f"{_STD} AND k % 24 <> 0"
_SIMPLE = [
    (2, "TransXChange", "CASE WHEN k % 3 = 0 THEN k % 2 = 1 ELSE k % 2 = 0 END"),
    (3, "TransXChange", "NOT ((k % 4 = 0 AND k % 3 = 0) OR (k % 3 <> 0 AND k % 4 <> 0))"),
    (7, "NoteText", "k % 5 = 0 AND k % 25 = 0"),
    (7, "NoteText", "k % 5 = 0 AND k % 25 <> 0 AND k % 15 = 0"),
    (8, "Private", "k % 20 = 0"),
    (10, "ServicedOrganisation", "k % 3 = 0 AND (k % 9 = 0 OR k % 2 = 1)"),
    (11, "ServicedOrganisation", "k % 12 = 0"),
    (11, "DateRange", "k % 3 = 0 AND k % 4 <> 0 AND k % 21 = 0"),
    (9, "DateRange", "k % 3 = 0 AND k % 4 <> 0 AND (k % 27 = 0 OR k % 15 = 0)"),
    (50, "ServicedOrganisation", "k % 6 = 0"),
    (12, "Operators", "k % 16 = 0"),
    (13, "Operators", "k % 18 = 0"),
    (14, "Registrations", "k % 17 = 0"),
    (15, "Garage", "k % 22 = 0"),
    (104, "Operator", "k % 8 = 0"),
    (127, "Operator", "k % 7 = 0 AND k % 14 <> 0"),
    (17, "Services", f"k % 10 = 3 AND NOT ({_FLEX})"),
    # The spare service's code has both forms, so it counts twice.
    (17, "Services", f"k % 10 = 3 OR NOT ((k % 13 <> 0 AND {_STD}) <> (k % 13 <> 0 AND k % 20 IN (1, 2)))"),
    (18, "ServiceCode", "k % 13 = 0"),
    (20, "OperatingPeriod", "k % 6 IN (2, 3)"),
    (21, "StandardService", f"{_STD} AND k % 24 = 0"),
    (22, "Service", "k % 20 IN (2, 4)"),
    (25, "Services", f"NOT ({_FLEX}) AND k % 20 <> 4 AND k % 3 <> 0 AND k % 5 <> 0"),
    (26, "Services", f"NOT ({_FLEX}) AND k % 20 <> 4 AND k % 9 = 0"),
    (27, "Services", f"NOT ({_FLEX}) AND k % 20 <> 4 AND k % 10 = 0"),
    (105, "Service", "k % 23 = 0"),
    (19, "LayoverPoint", "k % 44 = 0"),
    (30, "Route", "k % 34 = 0"),
    (32, "Mapping", "k % 33 = 0"),
    (39, "VehicleJourneyRef", "k % 12 = 8"),
    (41, "DaysOfWeek", "k % 45 < 3"),
    (43, "BankHolidayOperation", "(k % 15 = 4 AND c % 4 = 0) OR (k % 15 = 9 AND c % 4 <> 0) OR k % 15 = 14"),
    (46, "DepartureDayShift", "k % 43 < 5 AND k % 2 = 0"),
    (50, "VehicleJourneyInterchange", "k % 48 = 0"),
    (118, "VehicleJourneyTimingLink", "k % 47 = 0"),
    (28, "StopPoint", f"k % 9 = 2 AND k % 37 <> 0 AND k % 28 <> 1 AND {_PATTERNS} AND CASE WHEN k % 4 = 3 THEN false ELSE k % 6 <> 2 END AND k % 50 <> 0"),
    (119, "Service", "k % 20 = 3"),
    (120, "FlexibleService", "k % 40 = 3"),
    (121, "FlexibleJourneyPattern", "k % 20 IN (1, 3) AND k % 40 <> 3 AND k % 3 = 0"),
    (123, "FlexibleJourneyPattern", "k % 20 IN (1, 3) AND k % 40 <> 3 AND k % 7 < 2"),
    (124, "VehicleJourneys", f"{_FLEX} AND (k % 20 = 2 OR k % 3 = 1)"),
    (125, "FlexibleJourneyPattern", "k % 20 IN (1, 3) AND k % 40 <> 3 AND (k % 5) % 2 = 1"),
]
# (observation, element, condition, last ordinal): one row per ordinal 0..last.
_REPEATED = [
    (24, "Line", "k % 19 = 0 OR k % 8 = 0", "k % 2"),
    (38, "JourneyPatternTimingLink", "k % 35 = 0", "2 * (k % 2) + 1"),
    (37, "JourneyPatternSection", "k % 36 = 0", "k % 2"),
    (114, "JourneyPatternTimingLink", "k % 37 = 0", "2 * (k % 2) + 1"),
    (129, "From", "k % 38 = 0", "2 * (k % 2) + 1"),
    (131, "To", "k % 39 = 0", "2 * (k % 2) + 1"),
    (110, "JourneyPattern", f"{_PATTERNS} AND k % 25 = 1", "k % 2"),
    (111, "JourneyPattern", f"{_PATTERNS} AND k % 29 = 1", "k % 2"),
    (112, "JourneyPattern", f"{_PATTERNS} AND k % 26 = 1", "k % 2"),
    (113, "JourneyPattern", f"{_PATTERNS} AND k % 28 = 1", "k % 2"),
    (52, "JourneyPatternInterchange", f"{_PATTERNS} AND k % 31 = 0", "k % 2"),
    (117, "VehicleJourney", "k % 42 = 0", "1"),
    # Pattern JP1 has a journey of its own unless VJ1 refers to VJ0.
    (47, "JourneyPattern", f"{_PATTERNS} AND k % 8 = 5 AND k % 28 <> 1 AND k % 3 <> 0", "1"),
]
_FIXED = [(31, "RouteLink", "k % 32 = 0", 1), (34, "JourneyPatternTimingLink", "k % 5 = 2", 1)]


def violations_sql() -> str:
    """SQL over orders for all violations the documents contain."""
    parts = [f"SELECT k, {n} AS observation, '{e}' AS element, 0 AS ordinal FROM o WHERE {c}" for n, e, c in _SIMPLE]
    parts += [f"SELECT k, {n}, '{e}', unnest(generate_series(0, {last})) FROM o WHERE {c}" for n, e, c, last in _REPEATED]
    parts += [f"SELECT k, {n}, '{e}', {i} FROM o WHERE {c}" for n, e, c, i in _FIXED]
    # The spare service's line follows those of the first service.
    parts.append("SELECT k, 24, 'Line', k % 2 + 1 FROM o WHERE k % 10 = 3 AND k % 8 = 0")
    towns = "(SELECT count(*) FROM (VALUES (0), (1), (2)) v(j) WHERE (k + {g} + j) % 7 IN (0, 3)) > 0"
    shared = f"k % 5 = 0 OR ({towns.format(g=0)} AND {towns.format(g='CASE WHEN k % 5 = 0 THEN 2 ELSE 3 END')})"
    stops = f"{_STD} AND k % 28 <> 1"
    by_stop = f"({stops} AND (k % 6 = 3 OR {shared}))"
    related = f"CASE WHEN k % 10 <> 3 THEN k % 6 = 3 OR {by_stop} ELSE {by_stop} END"
    parts.append(f"SELECT k, 23, 'Lines', unnest(generate_series(0, CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END)) FROM o WHERE k % 2 = 1 AND k % 19 <> 0 AND NOT ({related})")
    return "WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)\nSELECT k AS file_id, CAST(observation AS INTEGER) AS observation, element, CAST(ordinal AS INTEGER) AS ordinal FROM (\n" + "\nUNION ALL ".join(parts) + ")"
