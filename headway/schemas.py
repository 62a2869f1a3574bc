"""Fixed schemas of the two document types, as Spark DDL.

Only elements that operators or rules read are listed. An attribute is a
``_name`` column. Repeatable elements, and elements whose number a rule counts,
are arrays. Elements whose children are wanted by name or in mixed order are
kept as text (their inner XML).
"""

from __future__ import annotations


def struct(**fields: str) -> str:
    return "struct<" + ",".join(f"`{k}`:{v}" for k, v in fields.items()) + ">"


def array(item: str) -> str:
    return f"array<{item}>"


TEXT = "string"
TEXTS = array(TEXT)
CORRUPT = "_corrupt"

# ------------------------------------------------------------ timetables

_TRANSLATION = struct(Longitude=TEXT, Latitude=TEXT, Easting=TEXT, Northing=TEXT)
_LOCATION = struct(
    _id=TEXT, Longitude=TEXT, Latitude=TEXT, Easting=TEXT, Northing=TEXT, Translation=_TRANSLATION
)
_DATES = array(struct(StartDate=TEXTS, EndDate=TEXTS, Description=TEXT, Provisional=TEXT))
_RANGES = struct(DateRange=_DATES)
_ORG_DAYS = array(
    struct(
        WorkingDays=struct(ServicedOrganisationRef=TEXTS),
        Holidays=struct(ServicedOrganisationRef=TEXTS),
    )
)
_PROFILE = struct(
    RegularDayType=struct(DaysOfWeek=TEXT, HolidaysOnly=TEXT),
    PeriodicDayType=TEXT,
    ServicedOrganisationDayType=struct(DaysOfOperation=_ORG_DAYS, DaysOfNonOperation=_ORG_DAYS),
    SpecialDaysOperation=struct(DaysOfOperation=_RANGES, DaysOfNonOperation=_RANGES),
    BankHolidayOperation=array(struct(DaysOfOperation=TEXT, DaysOfNonOperation=TEXT)),
)
_NOTES = struct(Note=array(struct(NoteCode=TEXT, NoteText=TEXT, Private=TEXT)))
_USAGE = struct(
    _id=TEXT,
    _SequenceNumber=TEXT,
    WaitTime=TEXT,
    Activity=TEXT,
    DynamicDestinationDisplay=TEXT,
    StopPointRef=TEXT,
    TimingStatus=TEXT,
    FareStageNumber=TEXT,
)
_TIMING_LINK = struct(
    _id=TEXT, From=_USAGE, To=_USAGE, RouteLinkRef=TEXT, RunTime=TEXT, Distance=TEXT
)
_ROUTE_LINK = struct(
    _id=TEXT,
    From=struct(StopPointRef=TEXT),
    To=struct(StopPointRef=TEXT),
    Distance=TEXT,
    Direction=TEXTS,
    Track=array(struct(Mapping=struct(Location=array(_LOCATION)))),
)
_OPERATOR = struct(
    _id=TEXT,
    NationalOperatorCode=TEXTS,
    OperatorCode=TEXT,
    OperatorShortName=TEXT,
    OperatorNameOnLicence=TEXT,
    TradingName=TEXT,
    LicenceNumber=TEXT,
    PrimaryMode=TEXT,
)
_LINE_TEXT = struct(Origin=TEXT, Destination=TEXT, Description=TEXT)
_INTERCHANGE = struct(
    InterchangeActivity=TEXTS, GuaranteedConnection=TEXTS, ChangeLineNumber=TEXTS
)
_JOURNEY_PATTERN = struct(
    _id=TEXT,
    DestinationDisplay=TEXT,
    OperatorRef=TEXTS,
    Direction=TEXTS,
    RouteRef=TEXTS,
    JourneyPatternSectionRefs=TEXTS,
    JourneyPatternInterchange=array(_INTERCHANGE),
)
_BOOKING = array(
    struct(
        Description=TEXT,
        Phone=array(struct(TelNationalNumber=TEXT)),
        Email=TEXTS,
        WebAddress=TEXTS,
        AllBookingsTaken=TEXT,
    )
)
_FLEXIBLE_PATTERN = struct(
    _id=TEXT,
    Direction=TEXTS,
    StopPointsInSequence=TEXT,
    FlexibleZones=TEXT,
    BookingArrangements=_BOOKING,
)
_SERVICE = struct(
    ServiceCode=TEXT,
    PrivateCode=TEXT,
    Lines=struct(
        Line=array(
            struct(
                _id=TEXT,
                LineName=TEXT,
                InboundDescription=_LINE_TEXT,
                OutboundDescription=_LINE_TEXT,
            )
        )
    ),
    OperatingPeriod=struct(StartDate=TEXT, EndDate=TEXT),
    OperatingProfile=_PROFILE,
    ServiceClassification=array(struct(Flexible=TEXT)),
    RegisteredOperatorRef=TEXT,
    Mode=TEXT,
    PublicUse=TEXTS,
    Notes=_NOTES,
    StandardService=struct(Origin=TEXT, Destination=TEXT, JourneyPattern=array(_JOURNEY_PATTERN)),
    FlexibleService=struct(
        Origin=TEXT, Destination=TEXT, FlexibleJourneyPattern=array(_FLEXIBLE_PATTERN)
    ),
)
_VJ_USAGE = struct(WaitTime=TEXT, Activity=TEXT, DynamicDestinationDisplay=TEXT)
_JOURNEY = struct(
    PrivateCode=TEXT,
    OperatorRef=TEXTS,
    Operational=struct(
        TicketMachine=struct(JourneyCode=TEXT), Block=struct(Description=TEXT, BlockNumber=TEXT)
    ),
    OperatingProfile=_PROFILE,
    DestinationDisplay=TEXT,
    CommercialBasis=TEXT,
    LayoverPoint=array(struct(Duration=TEXT, Name=TEXT, Location=TEXTS)),
    VehicleJourneyCode=TEXT,
    ServiceRef=TEXT,
    LineRef=TEXT,
    JourneyPatternRef=TEXT,
    VehicleJourneyRef=TEXT,
    DepartureTime=TEXT,
    DepartureDayShift=TEXTS,
    VehicleJourneyTimingLink=array(
        struct(
            _id=TEXT,
            JourneyPatternTimingLinkRef=TEXT,
            RunTime=TEXT,
            From=_VJ_USAGE,
            To=_VJ_USAGE,
        )
    ),
    VehicleJourneyInterchange=array(_INTERCHANGE),
)
_FLEXIBLE_JOURNEY = struct(
    VehicleJourneyCode=TEXT,
    ServiceRef=TEXT,
    LineRef=TEXT,
    Direction=TEXT,
    JourneyPatternRef=TEXT,
    VehicleJourneyRef=TEXT,
    OperatorRef=TEXTS,
    OperatingProfile=_PROFILE,
    FlexibleServiceTimes=TEXT,
)
_STOP_POINT = struct(
    AtcoCode=TEXT,
    NaptanCode=TEXT,
    Descriptor=struct(CommonName=TEXT),
    Place=struct(NptgLocalityRef=TEXT, Location=_LOCATION),
    StopClassification=struct(
        StopType=TEXT, OnStreet=struct(Bus=struct(BusStopType=TEXT, FlexibleZone=struct(Location=array(_LOCATION))))
    ),
    StopAreas=struct(StopAreaRef=TEXTS),
    AdministrativeAreaRef=TEXT,
)
_ORGANISATION = struct(
    OrganisationCode=TEXT, Name=TEXTS, WorkingDays=_RANGES, Holidays=array(_RANGES)
)

TIMETABLE_FIELDS = dict(
    _SchemaVersion=TEXT,
    _CreationDateTime=TEXT,
    _ModificationDateTime=TEXT,
    _Modification=TEXT,
    _RevisionNumber=TEXT,
    _FileName=TEXT,
    Notes=_NOTES,
    StopPoints=struct(
        StopPoint=array(_STOP_POINT),
        AnnotatedStopPointRef=array(
            struct(StopPointRef=TEXT, CommonName=TEXT, LocalityName=TEXT, Location=_LOCATION)
        ),
    ),
    RouteSections=struct(RouteSection=array(struct(_id=TEXT, RouteLink=array(_ROUTE_LINK)))),
    Routes=struct(
        Route=array(
            struct(_id=TEXT, Description=TEXT, RouteSectionRef=TEXTS, ReversingManoeuvres=TEXTS)
        )
    ),
    JourneyPatternSections=struct(
        JourneyPatternSection=array(
            struct(_id=TEXT, JourneyPatternTimingLink=array(_TIMING_LINK))
        )
    ),
    Operators=array(struct(Operator=array(_OPERATOR), LicensedOperator=array(_OPERATOR))),
    Garages=struct(Garage=array(struct(GarageCode=TEXTS))),
    Registrations=TEXTS,
    ServicedOrganisations=struct(ServicedOrganisation=array(_ORGANISATION)),
    Services=array(struct(Service=array(_SERVICE))),
    VehicleJourneys=array(
        struct(
            VehicleJourney=array(_JOURNEY),
            FlexibleVehicleJourney=array(_FLEXIBLE_JOURNEY),
            VehicleJourneyInterchange=array(_INTERCHANGE),
        )
    ),
)


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{k}` {v}" for k, v in {**fields, CORRUPT: TEXT}.items())


TIMETABLE_DDL = ddl(TIMETABLE_FIELDS)

# ----------------------------------------------------------------- fares

_REF = struct(_ref=TEXT)
_REFS = array(_REF)
_BETWEEN = struct(FromDate=TEXT, ToDate=TEXT)
_ASSIGNMENT = struct(
    _id=TEXT,
    TypeOfAccessRightAssignmentRef=_REFS,
    ValidityParameterGroupingType=TEXT,
    ValidityParameterAssignmentType=TEXT,
    validityParameters=TEXTS,
    limitations=array(
        struct(
            UserProfile=array(struct(_id=TEXT, Name=TEXT, UserType=TEXT)),
            RoundTrip=array(struct(TripType=TEXTS)),
            FrequencyOfUse=array(struct(FrequencyOfUseType=TEXT)),
        )
    ),
)
_STRUCTURE_ELEMENT = struct(
    _id=TEXT,
    _version=TEXT,
    Name=TEXT,
    TypeOfFareStructureElementRef=_REFS,
    timeIntervals=array(struct(TimeIntervalRef=_REFS)),
    GenericParameterAssignment=array(_ASSIGNMENT),
)
_TARIFF = struct(
    _id=TEXT,
    Name=TEXT,
    validityConditions=array(struct(ValidBetween=array(_BETWEEN))),
    OperatorRef=_REFS,
    GroupOfOperatorsRef=_REFS,
    TypeOfTariffRef=_REFS,
    TariffBasis=TEXTS,
    timeIntervals=array(struct(TimeInterval=array(struct(_id=TEXT, Name=TEXT)))),
    fareStructureElements=array(struct(FareStructureElement=array(_STRUCTURE_ELEMENT))),
)
_PRODUCT = struct(
    _id=TEXT,
    Name=TEXT,
    ChargingMomentType=TEXT,
    TypeOfFareProductRef=_REFS,
    ProductType=TEXT,
    validableElements=array(
        struct(
            ValidableElement=array(
                struct(fareStructureElements=array(struct(FareStructureElementRef=_REFS)))
            )
        )
    ),
    accessRightsInProduct=array(
        struct(AccessRightInProduct=array(struct(ValidableElementRef=_REFS)))
    ),
)
_PACKAGE = struct(
    _id=TEXT,
    Name=TEXT,
    distributionAssignments=array(
        struct(
            DistributionAssignment=array(
                struct(DistributionChannelType=TEXT, PaymentMethods=TEXT)
            )
        )
    ),
    salesOfferPackageElements=array(
        struct(
            SalesOfferPackageElement=array(
                struct(
                    TypeOfTravelDocumentRef=_REFS,
                    PreassignedFareProductRef=_REFS,
                    AmountOfPriceUnitProductRef=_REFS,
                )
            )
        )
    ),
)
_CELL = struct(_id=TEXT, ColumnRef=_REF, RowRef=_REF, Amount=TEXT)
_FARE_TABLE = struct(
    _id=TEXT,
    Name=TEXT,
    pricesFor=TEXTS,
    rows=struct(FareTableRow=array(struct(_id=TEXT, _order=TEXT, Name=TEXT))),
    columns=struct(FareTableColumn=array(struct(_id=TEXT, _order=TEXT, Name=TEXT))),
    cells=struct(Cell=array(_CELL)),
)
_FARE_FRAME = struct(
    _id=TEXT,
    _version=TEXT,
    TypeOfFrameRef=_REFS,
    fareZones=array(
        struct(
            FareZone=array(
                struct(
                    _id=TEXT,
                    _version=TEXT,
                    Name=TEXT,
                    members=struct(ScheduledStopPointRef=array(struct(_ref=TEXT, _VALUE=TEXT))),
                )
            )
        )
    ),
    tariffs=struct(Tariff=array(_TARIFF)),
    fareProducts=array(
        struct(
            xs_any=TEXTS,
            PreassignedFareProduct=array(_PRODUCT),
            AmountOfPriceUnitProduct=array(_PRODUCT),
            CappedDiscountRight=array(
                struct(
                    _id=TEXT,
                    cappingRules=struct(
                        CappingRule=array(
                            struct(Name=TEXT, CappingPeriod=TEXT, ValidableElementRef=_REFS)
                        )
                    ),
                )
            ),
        )
    ),
    salesOfferPackages=array(struct(SalesOfferPackage=array(_PACKAGE))),
    fareTables=array(struct(FareTable=array(_FARE_TABLE))),
    priceGroups=struct(
        PriceGroup=array(
            struct(_id=TEXT, members=struct(GeographicalIntervalPrice=array(struct(_id=TEXT, Amount=TEXT))))
        )
    ),
)
_SERVICE_FRAME = struct(
    _id=TEXT,
    TypeOfFrameRef=_REFS,
    lines=array(
        struct(Line=array(struct(_id=TEXT, Name=TEXT, PublicCode=TEXT, OperatorRef=_REFS)))
    ),
    scheduledStopPoints=array(struct(ScheduledStopPoint=array(struct(_id=TEXT, Name=TEXT)))),
)
_RESOURCE_FRAME = struct(
    _id=TEXT,
    TypeOfFrameRef=_REFS,
    organisations=array(
        struct(Operator=array(struct(_id=TEXT, PublicCode=TEXTS, Name=TEXT)))
    ),
    groupsOfOperators=struct(
        GroupOfOperators=array(struct(_id=TEXT, members=struct(OperatorRef=_REFS)))
    ),
)
_FRAMES = dict(
    ResourceFrame=array(_RESOURCE_FRAME),
    ServiceFrame=array(_SERVICE_FRAME),
    FareFrame=array(_FARE_FRAME),
)
_COMPOSITE = struct(
    _id=TEXT, ValidBetween=array(_BETWEEN), TypeOfFrameRef=_REFS, frames=struct(**_FRAMES)
)
FARES_FIELDS = dict(
    _version=TEXT,
    PublicationTimestamp=TEXT,
    ParticipantRef=TEXT,
    dataObjects=struct(CompositeFrame=array(_COMPOSITE), **_FRAMES),
)
FARES_DDL = ddl(FARES_FIELDS)
