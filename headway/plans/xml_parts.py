"""Fares documents written out of the part table, one per part.

As with timetables, everything in a document follows from the part's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans.registry import Tables
from headway.plans.xml_orders import join, tag, when


def fares_documents(t: Tables) -> DataFrame:
    k = F.col("p_partkey")

    def ref(name: str, value) -> F.Column:
        return join(f'<{name} ref="', value, '"/>')

    resource = tag("ResourceFrame",
        ref("TypeOfFrameRef", F.when(k % 17 == 1, "X").otherwise("fxc:UK_PI_COMMON:1")),
        when(k % 19 != 1, tag("organisations", tag("Operator",
            when(k % 29 != 1, tag("PublicCode", "ABCD")), when(k % 29 == 1, tag("PublicCode", "AB")),
            when(k % 31 != 1, tag("Name", "Op")), id=F.when(k % 23 == 1, "noc:TOOLONG").otherwise("noc:ABCD")))),
        tag("groupsOfOperators", tag("GroupOfOperators", tag("members", ref("OperatorRef", "noc:A"),
            when(k % 4 != 1, ref("OperatorRef", "noc:B"))), id="G")), id="epd:UK_PI_COMMON:1")
    service = tag("ServiceFrame",
        ref("TypeOfFrameRef", F.when(k % 7 == 1, "X").otherwise("fxc:UK_PI_NETWORK:1")),
        tag("lines", tag("Line", when(k % 6 != 1, tag("Name", "Line")), when(k % 10 != 3, tag("PublicCode", join("P", k % 12))),
            when(k % 14 != 5, ref("OperatorRef", "noc:ABCD")), id=join("LN", k % 9))),
        tag("scheduledStopPoints", tag("ScheduledStopPoint", tag("Name", "Stop"),
            id=F.when(k % 15 == 2, "x:1").otherwise(join("atco:", F.lpad((k % 90).cast("string"), 3, "0"), "99")))), id="sf")
    zone = tag("FareZone", when(k % 24 != 1, tag("Name", "Zone")),
        tag("members", ref("ScheduledStopPointRef", join("atco:ST", k)), ref("ScheduledStopPointRef", join("naptStop:N", k))), id="fz", version="1")
    network = tag("FareFrame",
        ref("TypeOfFrameRef", F.when(k % 21 == 1, "OTHER").otherwise("fxc:UK_PI_FARE_NETWORK:1")),
        tag("fareZones", when(k % 22 != 1, zone)), id="net", version="1")

    def element(kind: str, *content):
        return tag("FareStructureElement", ref("TypeOfFareStructureElementRef", kind), *content, id="e", version="1")

    access = element("fxc:access", tag("GenericParameterAssignment",
        when(k % 51 != 1, ref("TypeOfAccessRightAssignmentRef", F.when(k % 16 == 1, "fxc:eligible").otherwise("fxc:can_access"))),
        when(k % 20 != 1, tag("ValidityParameterGroupingType", "OR")), when(k % 18 != 1, "<validityParameters/>"), id="a"))
    eligibility = element("fxc:eligibility", tag("GenericParameterAssignment", ref("TypeOfAccessRightAssignmentRef", "fxc:eligible"),
        tag("limitations", tag("UserProfile", tag("Name", "Adult"), tag("UserType", F.when(k % 32 == 1, "").otherwise(F.element_at(F.array(F.lit("adult"), F.lit("child"), F.lit("senior")), (k % 3 + 1).cast("int")))), id="u")), id="b"))
    travel = when(k % 12 != 1, element("fxc:travel_conditions", tag("GenericParameterAssignment", ref("TypeOfAccessRightAssignmentRef", "fxc:condition_of_use"),
        tag("limitations", tag("RoundTrip", when(k % 33 != 1, tag("TripType", "single"))),
            tag("FrequencyOfUse", when(k % 34 != 1, tag("FrequencyOfUseType", "none")))), id="c")))
    durations = element("fxc:durations", tag("timeIntervals", when(k % 35 != 1, ref("TimeIntervalRef", "op:1"))))
    extra = when(k % 49 == 1, tag("FareStructureElement", tag("Name", "n"), id="x", version="1"))
    interval = tag("TimeInterval", when(k % 5 != 3, tag("Name", "day")), id="op:1")
    tariff = tag("Tariff", when(k % 26 != 1, tag("validityConditions", tag("ValidBetween",
            tag("FromDate", join("2020-01-", F.lpad((k % 28 + 1).cast("string"), 2, "0"), "T00:00:00")), when(k % 3 != 0, tag("ToDate", "2030-12-31T00:00:00"))))),
        when(~(k % 27).isin(1, 2), ref("OperatorRef", "noc:ABCD")), when(k % 27 == 2, ref("GroupOfOperatorsRef", "G")),
        ref("TypeOfTariffRef", F.when(k % 28 == 1, "fxc:none").otherwise("fxc:flat")), when(k % 30 != 1, tag("TariffBasis", "flat")),
        when(k % 5 != 1, tag("timeIntervals", when(k % 5 != 2, interval))),
        tag("fareStructureElements", access, eligibility, travel, durations, extra), id="t")

    def product(name: str, kind, named, charged, typed, validable, accessible):
        """A product with the parts whose conditions hold."""
        return tag(name, when(named, tag("Name", join("Product ", k % 40))),
            when(charged, tag("ChargingMomentType", "before")), when(typed, ref("TypeOfFareProductRef", "fxc:x")),
            when(validable, tag("validableElements", tag("ValidableElement", tag("fareStructureElements", ref("FareStructureElementRef", "e"))))),
            when(accessible, tag("accessRightsInProduct", tag("AccessRightInProduct", ref("ValidableElementRef", "v")))),
            kind, id="p")

    types = F.array(*[F.lit(v) for v in ("dayPass", "periodPass", "singleTrip", "other")])
    plain = product("PreassignedFareProduct", when(k % 39 != 1, tag("ProductType", F.element_at(types, (k % 4 + 1).cast("int")))),
        k % 36 != 1, k % 37 != 1, k % 38 != 1, k % 40 != 1, k % 41 != 1)
    carnet = when(k % 3 == 0, product("AmountOfPriceUnitProduct", tag("ProductType", F.when(k % 9 == 0, "other").otherwise("tripCarnet")),
        F.lit(True), k % 27 != 3, k % 33 != 6, k % 21 != 9, k % 39 != 12))
    rule = tag("cappingRules", tag("CappingRule", tag("Name", "cap"), tag("CappingPeriod", "day"), ref("ValidableElementRef", "v")))
    capped = F.when(k % 16 == 8, tag("CappedDiscountRight", rule)).when(k % 16 == 0, tag("CappedDiscountRight", rule, id="cap")).otherwise("")
    others = when(k % 5 == 0, "<SupplementProduct id='x'><Name>n</Name></SupplementProduct><UsageDiscountRight/>")
    packages = when(k % 46 != 1, tag("salesOfferPackages", tag("SalesOfferPackage",
        tag("distributionAssignments", tag("DistributionAssignment", when(k % 42 != 1, tag("DistributionChannelType", "onBoard")), when(k % 43 != 1, tag("PaymentMethods", "cash")))),
        tag("salesOfferPackageElements", tag("SalesOfferPackageElement", when(k % 44 != 1, ref("TypeOfTravelDocumentRef", "d")), when(k % 45 != 1, ref("PreassignedFareProductRef", "p")))), id="s")))
    products = tag("FareFrame", ref("TypeOfFrameRef", F.when(k % 25 == 1, "UK_PI_OTHER").otherwise("fxc:UK_PI_FARE_PRODUCT:1")),
        tag("tariffs", tariff), tag("fareProducts", plain, carnet, capped, others), packages, id="epd:UK_PI_FARE_PRODUCT:1", version="1")
    cells = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), k % 3), lambda i: tag("Cell",
        join('<ColumnRef ref="c0"/><RowRef ref="r', i, '"/>'), tag("Amount", join(i + k % 20, ".5")), id="c")), "")
    rows = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), k % 3), lambda i: tag("FareTableRow", tag("Name", "r"), id=join("r", i), order=i + 1)), "")
    prices = tag("FareFrame", when(k % 47 != 1, ref("TypeOfFrameRef", "fxc:UK_PI_FARE_PRICE:1")),
        tag("fareTables", tag("FareTable", when(k % 48 != 1, "<pricesFor/>"), tag("rows", rows),
            tag("columns", tag("FareTableColumn", tag("Name", "c"), id="c0", order="1")), tag("cells", cells), id="ft")), id="epd:UK_PI_FARE_PRICE:1", version="1")
    between = F.when(k % 11 == 1, "").when(k % 11 == 2, "<ValidBetween/>").otherwise(tag("ValidBetween",
        tag("FromDate", join("2021-02-", F.lpad((k % 28 + 1).cast("string"), 2, "0"), "T00:00:00")), tag("ToDate", "2031-01-01T00:00:00")))
    main = join("<CompositeFrame", when(k % 50 != 7, ' id="epd:UK_PI_LINE_FARE_OFFER:1"'), ' version="1">', between,
        ref("TypeOfFrameRef", F.when(k % 13 == 1, "OTHER").otherwise("fxc:UK_PI_LINE_FARE_OFFER:1")),
        tag("frames", resource, service, network, products, prices), "</CompositeFrame>")
    other = tag("CompositeFrame", ref("TypeOfFrameRef", "fxc:UK_PI_METADATA_OFFER:1"), id="epd:UK_PI_METADATA_OFFER:1", version="1")
    text = tag("PublicationDelivery", tag("dataObjects", main, other), version=F.when(k % 2 == 0, "1.1").otherwise("1.10"))
    parts = t.spread(t.part.select("p_partkey"), "p_partkey")
    return parts.select(k.alias("file_id"), text.alias("text"))


_PROD = "k % 25 <> 1"
_PASS = "k % 39 <> 1 AND k % 4 IN (0, 1)"
_ID = "k % 50 = 7"
_SOLD = f"{_PROD} AND k % 46 <> 1"
# (rule, element, ordinal, condition)
_EXPECTED = [
    (1, "FareFrame", 1, f"{_PASS} AND {_PROD} AND k % 5 = 1"),
    (2, "FareFrame", 1, f"{_PASS} AND {_PROD} AND k % 5 = 2"),
    (3, "FareFrame", 1, f"{_PASS} AND {_PROD} AND k % 5 = 3"),
    (4, "FareFrame", 1, f"{_PASS} AND k % 35 = 1"),
    (5, "FareFrame", 1, "k % 39 <> 1 AND k % 4 = 2 AND k % 12 <> 1 AND k % 33 = 1"),
    (6, "fareZones", 0, "k % 21 = 1 OR k % 22 = 1"),
    (7, "fareZones", 0, "k % 21 = 1 OR (k % 22 <> 1 AND k % 24 = 1)"),
    (8, "ServiceFrame", 0, "k % 7 = 1"),
    (9, "ServiceFrame", 0, "k % 6 = 1"),
    (10, "ServiceFrame", 0, "k % 15 = 2"),
    (11, "Line", 0, "k % 10 = 3"),
    (12, "Line", 0, "k % 14 = 5"),
    (13, "CompositeFrame", 0, f"{_ID} OR k % 13 = 1"),
    (14, "CompositeFrame", 0, f"{_ID} OR (k % 25 = 1 AND k % 47 = 1)"),
    (15, "Tariff", 0, f"{_PROD} AND k % 28 = 1"),
    (16, "Tariff", 0, f"{_PROD} AND (k % 27 = 1 OR (k % 27 = 2 AND k % 4 = 1))"),
    (17, "Tariff", 0, f"{_PROD} AND k % 30 = 1"),
    (18, "Tariff", 0, f"{_PROD} AND k % 26 = 1"),
    (19, "fareStructureElements", 0, "k % 12 = 1 OR k % 16 = 1 OR k % 51 = 1"),
    (21, "FareFrame", 2, "k % 47 <> 1 AND k % 48 = 1"),
    (22, "FareFrame", 2, "k % 47 = 1"),
    (23, "FareFrame", 1, "k % 25 = 1"),
    (24, "FareFrame", 1, f"{_PROD} AND k % 3 <> 0 AND k % 36 = 1"),
    (25, "PreassignedFareProduct", 0, f"{_PROD} AND k % 38 = 1"),
    (26, "PreassignedFareProduct", 0, f"{_PROD} AND k % 37 = 1"),
    (27, "PreassignedFareProduct", 0, f"{_PROD} AND k % 40 = 1"),
    (28, "PreassignedFareProduct", 0, f"{_PROD} AND k % 41 = 1"),
    (29, "PreassignedFareProduct", 0, f"{_PROD} AND k % 39 = 1"),
    (30, "AmountOfPriceUnitProduct", 0, f"{_PROD} AND k % 33 = 6"),
    (31, "AmountOfPriceUnitProduct", 0, f"{_PROD} AND k % 27 = 3"),
    (32, "AmountOfPriceUnitProduct", 0, f"{_PROD} AND k % 21 = 9"),
    (33, "AmountOfPriceUnitProduct", 0, f"{_PROD} AND k % 39 = 12"),
    (34, "AmountOfPriceUnitProduct", 0, f"{_PROD} AND k % 9 = 0"),
    (35, "FareFrame", 1, f"{_PROD} AND k % 46 = 1"),
    (36, "SalesOfferPackage", 0, f"{_SOLD} AND k % 42 = 1"),
    (37, "SalesOfferPackage", 0, f"{_SOLD} AND k % 44 = 1"),
    (38, "DistributionAssignment", 0, f"{_SOLD} AND k % 43 = 1"),
    (39, "SalesOfferPackageElement", 0, f"{_SOLD} AND k % 45 = 1"),
    (40, "FareStructureElement", "CASE WHEN k % 12 = 1 THEN 3 ELSE 4 END", "k % 49 = 1"),
    (41, "fareStructureElements", 0, "k % 51 = 1"),
    (42, "GenericParameterAssignment", 0, "k % 20 = 1"),
    (43, "GenericParameterAssignment", 0, "k % 18 = 1"),
    (44, "fareStructureElements", 0, "k % 32 = 1"),
    (45, "FareStructureElement", 2, "k % 12 <> 1 AND k % 34 = 1"),
    (46, "CompositeFrame", 0, f"{_ID} OR k % 11 IN (1, 2)"),
    (47, "CompositeFrame", 0, f"{_ID} OR k % 17 = 1"),
    (48, "CompositeFrame", 0, f"{_ID} OR k % 19 = 1 OR k % 23 = 1 OR k % 29 = 1"),
    (49, "CompositeFrame", 0, f"{_ID} OR (k % 19 <> 1 AND k % 31 = 1)"),
    (50, "CompositeFrame", 0, f"{_ID} OR ({_PROD} AND k % 16 = 8)"),
]


def violations_sql() -> str:
    parts = [
        f"SELECT k AS file_id, {n} AS observation, '{e}' AS element, CAST({i} AS INTEGER) AS ordinal FROM p WHERE {c}"
        for n, e, i, c in _EXPECTED
    ]
    return "WITH p AS (SELECT p_partkey AS k FROM part)\n" + "\nUNION ALL ".join(parts)
