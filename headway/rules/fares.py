"""Fares rule catalogue.

Most rules look at frames of one type only; the type is the ``ref`` of the
frame's first type reference. A frame of another type, or a reference without
that attribute, passes. Every failing rule of a row is reported.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.rules.runner import Catalogue, Observation, count, each, has_text

# Marks in frame types and ids, and reference values.
METADATA = "METADATA"
PRODUCT, PRICE = "UK_PI_FARE_PRODUCT", "UK_PI_FARE_PRICE"
FARE_NETWORK, NETWORK, COMMON = "UK_PI_FARE_NETWORK", "UK_PI_NETWORK", "UK_PI_COMMON"
OFFERS = (
    "UK_PI_LINE_FARE_OFFER",
    "UK_PI_NETWORK_FARE_OFFER",
    "UK_PI_NETWORK_OFFER",
    "UK_PI_METADATA_OFFER",
)
TARIFF_TYPES = (
    "fxc:Distance_kilometers",
    "fxc:flat",
    "fxc:section",
    "fxc:point_to_point",
    "fxc:zone_to_zone",
    "fxc:zonal",
    "fxc:banded",
    "fxc:stored_value",
    "fxc:discount",
    "fxc:multitrip",
)
ACCESS, CAN_ACCESS = "fxc:access", "fxc:can_access"
ELIGIBILITY, ELIGIBLE = "fxc:eligibility", "fxc:eligible"
TRAVEL, CONDITION_OF_USE = "fxc:travel_conditions", "fxc:condition_of_use"
DURATIONS = "fxc:durations"
PASSES, TRIPS = ("dayPass", "periodPass"), ("singleTrip", "dayReturnTrip", "periodReturnTrip")
CARNETS = ("tripCarnet", "passCarnet")
OPERATOR_MARK, OPERATOR_ID_LENGTH, PUBLIC_CODE_LENGTH = "noc:", 8, 4
STOP_MARK = "atco:"


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _is(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _ref(refs: Column) -> Column:
    """``ref`` of the first reference; empty when there is none."""
    return F.when(count(refs) == 0, F.lit("")).otherwise(_first(refs)["_ref"])


def _no_ref(refs: Column) -> Column:
    """A reference that lacks its attribute."""
    return (count(refs) > 0) & _first(refs)["_ref"].isNull()


def _kind(refs: Column, mark: str) -> Column:
    return _is(_ref(refs).contains(mark))


def _when_kind(mark: str, test: Callable[[Column], Column], refs: Callable[[Column], Column] | None = None):
    """Apply a test to rows whose frame is of a type; others pass."""
    find = refs or (lambda r: r["refs"])
    return lambda r: ~_kind(find(r), mark) | _is(test(r))


def _frame(mark: str, test: Callable[[Column], Column]):
    return _when_kind(mark, test, lambda f: f["TypeOfFrameRef"])


def _until_no_ref(items: Column, refs: Callable[[Column], Column]) -> Column:
    """Items before the first one whose reference lacks its attribute."""
    stop = F.array_position(F.transform(items, lambda i: _no_ref(refs(i))), F.lit(True))
    end = F.when(stop == 0, F.size(items).cast("bigint")).otherwise(stop - 1)
    return F.slice(items, F.lit(1), end.cast("int"))


def _element_type(e: Column) -> Column:
    return e["TypeOfFareStructureElementRef"]


def _elements(frame: Column) -> Column:
    return each(
        each(frame["tariffs"]["Tariff"], lambda t: t["fareStructureElements"]),
        lambda g: g["FareStructureElement"],
    )


# ------------------------------------------------------------- row sets


def _composites() -> Column:
    return F.coalesce(F.col("dataObjects.CompositeFrame"), F.array())


def _fare_frames() -> Column:
    """Fare frames inside composite frames."""
    return each(_composites(), lambda c: c["frames"]["FareFrame"])


def _all_fare_frames() -> Column:
    return F.concat(F.coalesce(F.col("dataObjects.FareFrame"), F.array()), _fare_frames())


def _in_frame(frames: Column, rows: Callable[[Column], Column]) -> Column:
    """Rows of each frame with the frame's type reference as ``refs``."""
    return each(
        frames,
        lambda f: F.transform(
            rows(f), lambda x: F.struct(x.alias("x"), f["TypeOfFrameRef"].alias("refs"))
        ),
    )


def _all_elements() -> Column:
    return each(_all_fare_frames(), _elements)


def _with_document_elements(groups: Column) -> Column:
    """Element groups next to all structure elements of the document."""
    everything = _all_elements()
    return F.transform(groups, lambda g: F.struct(g.alias("x"), everything.alias("all")))


def _groups(frames: Column) -> Column:
    return each(each(frames, lambda f: f["tariffs"]["Tariff"]), lambda t: t["fareStructureElements"])


def _zone_rows() -> Column:
    zones = each(each(_all_fare_frames(), lambda f: f["fareZones"]), lambda z: z["FareZone"])
    named = F.forall(zones, lambda z: has_text(z["Name"]))
    return each(
        _fare_frames(),
        lambda f: F.transform(
            f["fareZones"],
            lambda z: F.struct(z.alias("x"), f["TypeOfFrameRef"].alias("refs"), named.alias("all_named")),
        ),
    )


def _tariff_rows() -> Column:
    def of_composite(c: Column) -> Column:
        members = each(
            each(c["frames"]["ResourceFrame"], lambda r: r["groupsOfOperators"]["GroupOfOperators"]),
            lambda g: g["members"]["OperatorRef"],
        )
        return each(
            c["frames"]["FareFrame"],
            lambda f: F.transform(
                f["tariffs"]["Tariff"],
                lambda t: F.struct(
                    t.alias("x"), f["TypeOfFrameRef"].alias("refs"), F.size(members).alias("members")
                ),
            ),
        )

    return each(_composites(), of_composite)


def _assignment_rows() -> Column:
    return each(
        each(_fare_frames(), _elements),
        lambda e: F.transform(
            e["GenericParameterAssignment"],
            lambda a: F.struct(a.alias("x"), _element_type(e).alias("refs")),
        ),
    )


def _packages(f: Column) -> Column:
    return each(f["salesOfferPackages"], lambda s: s["SalesOfferPackage"])


ROW_SETS = {
    "composites": _composites,
    "fare_frames": _fare_frames,
    "zones": _zone_rows,
    "service_frames": lambda: each(_composites(), lambda c: c["frames"]["ServiceFrame"]),
    "service_lines": lambda: each(
        each(each(_composites(), lambda c: c["frames"]["ServiceFrame"]), lambda f: f["lines"]),
        lambda g: g["Line"],
    ),
    "tariffs": _tariff_rows,
    "element_groups": lambda: _with_document_elements(_groups(_all_fare_frames())),
    "elements": _all_elements,
    "composite_elements": lambda: each(_fare_frames(), _elements),
    "assignments": _assignment_rows,
    "preassigned": lambda: _in_frame(
        _fare_frames(), lambda f: each(f["fareProducts"], lambda p: p["PreassignedFareProduct"])
    ),
    "price_units": lambda: _in_frame(
        _fare_frames(), lambda f: each(f["fareProducts"], lambda p: p["AmountOfPriceUnitProduct"])
    ),
    "packages": lambda: _in_frame(_fare_frames(), _packages),
    "distributions": lambda: _in_frame(
        _all_fare_frames(),
        lambda f: each(
            each(_packages(f), lambda p: p["distributionAssignments"]),
            lambda d: d["DistributionAssignment"],
        ),
    ),
    "package_elements": lambda: _in_frame(
        _all_fare_frames(),
        lambda f: each(
            each(_packages(f), lambda p: p["salesOfferPackageElements"]),
            lambda e: e["SalesOfferPackageElement"],
        ),
    ),
}

# ---------------------------------------------------------------- tests


def _product_type(f: Column) -> Column:
    """First product type given in a frame's preassigned products."""
    products = each(f["fareProducts"], lambda p: p["PreassignedFareProduct"])
    types = F.filter(F.transform(products, lambda p: p["ProductType"]), lambda t: t.isNotNull())
    return F.coalesce(_first(types), F.lit(""))


def _intervals(f: Column) -> Column:
    return each(f["tariffs"]["Tariff"], lambda t: t["timeIntervals"])


def _for_products(types: tuple, test: Callable[[Column], Column]):
    return lambda f: ~_product_type(f).isin(*types) | _is(test(f))


def _pass_interval(test: Callable[[Column], Column]):
    """A test of product frames that sell passes."""
    return _for_products(PASSES, _frame(PRODUCT, test))


def _first_of_type(f: Column, kind: str, ok: Callable[[Column], Column]) -> Column:
    """The first element of a type, met before any reference without attribute."""
    readable = _until_no_ref(_elements(f), _element_type)
    found = _first(F.filter(readable, lambda e: _ref(_element_type(e)) == kind))
    return found.isNull() | _is(ok(found))


def _durations(f: Column) -> Column:
    return _first_of_type(
        f,
        DURATIONS,
        lambda e: (count(e["timeIntervals"]) > 0)
        & F.forall(e["timeIntervals"], lambda t: count(t["TimeIntervalRef"]) > 0),
    )


def _round_trips(f: Column) -> Column:
    def ok(e: Column) -> Column:
        limits = _first(e["GenericParameterAssignment"])["limitations"]
        return (count(limits) > 0) & F.forall(
            limits, lambda l: count(_first(l["RoundTrip"])["TripType"]) > 0
        )

    return _first_of_type(f, TRAVEL, ok)


def _zone_type(test: Callable[[Column], Column]):
    """A frame with zones must be of a network type."""

    def check(r: Column) -> Column:
        unread = (count(r["refs"]) == 0) | _no_ref(r["refs"])
        network = _kind(r["refs"], FARE_NETWORK) | _kind(r["refs"], NETWORK)
        return unread | (network & _is(test(r)))

    return check


def _lines(f: Column) -> Column:
    line = _first(_first(f["lines"])["Line"])
    return (count(f["lines"]) == 0) | (line.isNotNull() & has_text(line["Name"]))


def _stop_points(f: Column) -> Column:
    stops = _first(f["scheduledStopPoints"])["ScheduledStopPoint"]
    good = F.forall(stops, lambda s: _is(s["_id"].contains(STOP_MARK)) & has_text(s["Name"]))
    return (count(f["scheduledStopPoints"]) == 0) | ((count(stops) > 0) & _is(good))


def _named(test: Callable[[Column], Column]):
    """A composite frame needs an id; one that marks metadata passes."""

    def check(c: Column) -> Column:
        return c["_id"].isNotNull() & (_is(c["_id"].contains(METADATA)) | _is(test(c)))

    return check


def _offer(c: Column) -> Column:
    any_offer = F.lit(False)
    for mark in OFFERS:
        any_offer = any_offer | _kind(c["TypeOfFrameRef"], mark)
    return any_offer


def _fare_frame_types(c: Column) -> Column:
    frames = F.coalesce(c["frames"]["FareFrame"], F.array())
    unreadable = F.exists(frames, lambda f: _no_ref(f["TypeOfFrameRef"]))
    known = F.exists(
        frames, lambda f: _kind(f["TypeOfFrameRef"], PRODUCT) | _kind(f["TypeOfFrameRef"], PRICE)
    )
    return ~unreadable & known


def _tariff_operator(r: Column) -> Column:
    groups = count(r["x"]["GroupOfOperatorsRef"]) > 0
    return ((count(r["x"]["OperatorRef"]) > 0) | groups) & (~groups | (r["members"] >= 2))


def _tariff_validity(r: Column) -> Column:
    between = _first(_first(r["x"]["validityConditions"])["ValidBetween"])
    return between.isNotNull() & has_text(between["FromDate"])


def _access_right(e: Column) -> Column:
    return each(e["GenericParameterAssignment"], lambda a: a["TypeOfAccessRightAssignmentRef"])


def _combinations(r: Column) -> Column:
    everything = r["all"]

    def pair(kind: str, right: str) -> Column:
        return F.exists(
            everything, lambda e: (_ref(_element_type(e)) == kind) & (_ref(_access_right(e)) == right)
        )

    readable = F.forall(everything, lambda e: ~_no_ref(_element_type(e)) & ~_no_ref(_access_right(e)))
    return (
        (F.size(everything) >= 3)
        & readable
        & pair(ACCESS, CAN_ACCESS)
        & pair(ELIGIBILITY, ELIGIBLE)
        & pair(TRAVEL, CONDITION_OF_USE)
    )


def _price_tables(f: Column) -> Column:
    tables = each(f["fareTables"], lambda g: g["FareTable"])
    return F.exists(tables, lambda t: count(t["pricesFor"]) > 0)


def _typed_by_id(mark: str):
    """A frame whose id names a type must have a reference to that type."""

    def check(f: Column) -> Column:
        named = _is(f["_id"].contains(mark))
        typed = (count(f["TypeOfFrameRef"]) > 0) & (_no_ref(f["TypeOfFrameRef"]) | _kind(f["TypeOfFrameRef"], mark))
        return ~named | typed

    return check


def _products(f: Column) -> Column:
    first = _first(f["fareProducts"])
    units, plain = first["AmountOfPriceUnitProduct"], first["PreassignedFareProduct"]
    product = F.when(count(units) > 0, _first(units)).otherwise(_first(plain))
    return product.isNotNull() & has_text(product["Name"])


def _validable(r: Column) -> Column:
    element = _first(_first(r["x"]["validableElements"])["ValidableElement"])
    return count(_first(element["fareStructureElements"])["FareStructureElementRef"]) > 0


def _access_rights(r: Column) -> Column:
    rights = _first(r["x"]["accessRightsInProduct"])["AccessRightInProduct"]
    return F.exists(rights, lambda a: count(a["ValidableElementRef"]) > 0)


def _distribution(r: Column) -> Column:
    first = _first(_first(r["x"]["distributionAssignments"])["DistributionAssignment"])
    return first.isNotNull() & has_text(first["DistributionChannelType"])


def _travel_document(r: Column) -> Column:
    first = _first(_first(r["x"]["salesOfferPackageElements"])["SalesOfferPackageElement"])
    return count(first["TypeOfTravelDocumentRef"]) > 0


def _group_elements(kind: str, ok: Callable[[Column], Column]):
    """All elements of a type in a group, read up to an unreadable reference."""

    def check(r: Column) -> Column:
        items = F.coalesce(r["x"]["FareStructureElement"], F.array())
        return F.forall(
            _until_no_ref(items, _element_type),
            lambda e: ~_is(_ref(_element_type(e)) == kind) | _is(ok(e)),
        )

    return check


def _access_assigned(e: Column) -> Column:
    return count(_first(e["GenericParameterAssignment"])["TypeOfAccessRightAssignmentRef"]) > 0


def _user_profile(e: Column) -> Column:
    limit = _first(_first(e["GenericParameterAssignment"])["limitations"])
    profile = _first(limit["UserProfile"])
    return profile.isNotNull() & has_text(profile["Name"]) & has_text(profile["UserType"])


def _frequency(e: Column) -> Column:
    uses = each(
        each(e["GenericParameterAssignment"], lambda a: a["limitations"]), lambda l: l["FrequencyOfUse"]
    )
    types = F.filter(
        F.transform(uses, lambda u: u["FrequencyOfUseType"]), lambda t: t.isNotNull()
    )
    is_travel = _is(_ref(_element_type(e)) == TRAVEL)
    return ~is_travel | has_text(_first(types))


def _resource_type(c: Column) -> Column:
    frame = _first(c["frames"]["ResourceFrame"])
    named = _is(frame["_id"].contains(COMMON))
    return ~named | _kind(frame["TypeOfFrameRef"], COMMON)


def _organisations(c: Column) -> Column:
    groups = each(c["frames"]["ResourceFrame"], lambda r: r["organisations"])
    operators = _first(groups)["Operator"]

    def good(o: Column) -> Column:
        code = F.coalesce(_first(o["PublicCode"]), F.lit(""))
        return (
            _is(o["_id"].contains(OPERATOR_MARK))
            & (F.length(o["_id"]) == OPERATOR_ID_LENGTH)
            & (count(o["PublicCode"]) > 0)
            & (F.length(code) == PUBLIC_CODE_LENGTH)
        )

    return (count(operators) > 0) & F.forall(operators, lambda o: _is(good(o)))


def _operator_names(c: Column) -> Column:
    operators = each(
        each(c["frames"]["ResourceFrame"], lambda r: r["organisations"]), lambda g: g["Operator"]
    )
    return F.forall(operators, lambda o: has_text(o["Name"]))


def _capping(c: Column) -> Column:
    frames = _until_no_ref(
        F.coalesce(c["frames"]["FareFrame"], F.array()), lambda f: f["TypeOfFrameRef"]
    )

    def good(f: Column) -> Column:
        right = _first(each(f["fareProducts"], lambda p: p["CappedDiscountRight"]))
        rule = _first(right["cappingRules"]["CappingRule"])
        complete = (
            right["_id"].isNotNull()
            & has_text(rule["Name"])
            & has_text(rule["CappingPeriod"])
            & (count(rule["ValidableElementRef"]) > 0)
        )
        return right.isNull() | _is(complete)

    return F.forall(frames, lambda f: ~_kind(f["TypeOfFrameRef"], PRODUCT) | good(f))


def observations(experimental: bool = False) -> list[Observation]:
    def o(number: int, category: str, row_set: str, element: str, test) -> Observation:
        return Observation(number, category, "", row_set, element, [test])

    def product(row_set_test):
        return _when_kind(PRODUCT, row_set_test)

    frame, tariff, zones = "FareFrame", "Tariff", "fareZones"
    listed = [
        o(1, "Tariff", "fare_frames", frame, _pass_interval(lambda f: F.size(_intervals(f)) > 0)),
        o(2, "Tariff", "fare_frames", frame, _pass_interval(
            lambda f: (F.size(_intervals(f)) == 0) | F.exists(_intervals(f), lambda t: count(t["TimeInterval"]) > 0))),
        o(3, "Tariff", "fare_frames", frame, _pass_interval(
            lambda f: F.forall(each(_intervals(f), lambda t: t["TimeInterval"]), lambda i: has_text(i["Name"])))),
        o(4, "Duration", "fare_frames", frame, _for_products(PASSES, _durations)),
        o(5, "Conditions", "fare_frames", frame, _for_products(TRIPS, _round_trips)),
        o(6, "FareZones", "zones", zones, _zone_type(lambda r: count(r["x"]["FareZone"]) > 0)),
        o(7, "FareZones", "zones", zones, _zone_type(lambda r: r["all_named"])),
        o(8, "TypeOfFrame", "service_frames", "ServiceFrame", lambda f: _kind(f["TypeOfFrameRef"], NETWORK)),
        o(9, "Lines", "service_frames", "ServiceFrame", _lines),
        o(10, "scheduledStopPoints", "service_frames", "ServiceFrame", _stop_points),
        o(11, "Lines", "service_lines", "Line", lambda l: has_text(l["PublicCode"])),
        o(12, "Lines", "service_lines", "Line", lambda l: count(l["OperatorRef"]) > 0),
        o(13, "TypeOfFrame", "composites", "CompositeFrame", _named(_offer)),
        o(14, "TypeOfFrame", "composites", "CompositeFrame", _named(_fare_frame_types)),
        o(15, "Tariff", "tariffs", tariff, product(lambda r: _is(_ref(r["x"]["TypeOfTariffRef"]).isin(*TARIFF_TYPES)))),
        o(16, "Tariff", "tariffs", tariff, product(_tariff_operator)),
        o(17, "Tariff", "tariffs", tariff, product(lambda r: count(r["x"]["TariffBasis"]) > 0)),
        o(18, "Tariff", "tariffs", tariff, product(_tariff_validity)),
        o(19, "FareStructureElement", "element_groups", "fareStructureElements", _combinations),
        o(20, "FareStructureElement", "element_groups", "fareStructureElements", lambda r: F.size(r["all"]) > 0),
        o(21, "FareTables", "fare_frames", frame, _frame(PRICE, _price_tables)),
        o(22, "TypeOfFrame", "fare_frames", frame, _typed_by_id(PRICE)),
        o(23, "TypeOfFrame", "fare_frames", frame, _typed_by_id(PRODUCT)),
        o(24, "FareProducts", "fare_frames", frame, _frame(PRODUCT, _products)),
    ]
    number = 25
    for rows, label in (("preassigned", "PreassignedFareProduct"), ("price_units", "AmountOfPriceUnitProduct")):
        carnet = rows == "price_units"
        kind = (lambda r: _is(r["x"]["ProductType"].isin(*CARNETS))) if carnet else (lambda r: has_text(r["x"]["ProductType"]))
        for test in (
            lambda r: count(r["x"]["TypeOfFareProductRef"]) > 0,
            lambda r: has_text(r["x"]["ChargingMomentType"]),
            _validable,
            _access_rights,
            kind,
        ):
            listed.append(o(number, "FareProducts", rows, label, product(test)))
            number += 1
    listed += [
        o(35, "SalesOfferPackages", "fare_frames", frame, _frame(
            PRODUCT, lambda f: count(_first(f["salesOfferPackages"])["SalesOfferPackage"]) > 0)),
        o(36, "SalesOfferPackages", "packages", "SalesOfferPackage", product(_distribution)),
        o(37, "SalesOfferPackages", "packages", "SalesOfferPackage", product(_travel_document)),
        o(38, "SalesOfferPackages", "distributions", "DistributionAssignment", product(lambda r: has_text(r["x"]["PaymentMethods"]))),
        o(39, "SalesOfferPackages", "package_elements", "SalesOfferPackageElement", product(
            lambda r: (count(r["x"]["PreassignedFareProductRef"]) > 0) | (count(r["x"]["AmountOfPriceUnitProductRef"]) > 0))),
        o(40, "FareStructureElement", "elements", "FareStructureElement", lambda e: count(_element_type(e)) > 0),
        o(41, "Access", "element_groups", "fareStructureElements", _group_elements(ACCESS, _access_assigned)),
        o(42, "Access", "assignments", "GenericParameterAssignment", lambda r: ~_is(_ref(r["refs"]) == ACCESS)
            | has_text(r["x"]["ValidityParameterGroupingType"]) | has_text(r["x"]["ValidityParameterAssignmentType"])),
        o(43, "Access", "assignments", "GenericParameterAssignment", lambda r: ~_is(_ref(r["refs"]) == ACCESS)
            | (count(r["x"]["validityParameters"]) > 0)),
        o(44, "Eligibility", "element_groups", "fareStructureElements", _group_elements(ELIGIBILITY, _user_profile)),
        o(45, "Conditions", "composite_elements", "FareStructureElement", _frequency),
        o(46, "Validity", "composites", "CompositeFrame", _named(lambda c: has_text(_first(c["ValidBetween"])["FromDate"]))),
        o(47, "TypeOfFrame", "composites", "CompositeFrame", _named(_resource_type)),
        o(48, "Organisations", "composites", "CompositeFrame", _named(_organisations)),
        o(49, "Organisations", "composites", "CompositeFrame", _named(_operator_names)),
    ]
    if experimental:
        listed.append(o(50, "FareProducts", "composites", "CompositeFrame", _named(_capping)))
    return listed


def fares_violations(docs: DataFrame, experimental: bool = False) -> DataFrame:
    """All violations of the fares catalogue; the capping rule is experimental."""
    made = Catalogue(ROW_SETS, every_failure=True)
    for observation in observations(experimental):
        made.add(observation)
    return made.run(docs).drop("reference")
