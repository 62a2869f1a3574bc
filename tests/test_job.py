"""The timetable job and the fares documents on a few small documents."""

import pytest

from headway.plans.timetable_job import References, process
from headway.rules.fares import fares_violations
from headway.sources import documents as docs
from headway.sources import fares
from headway.sources.large import large_sections
from headway.sources import timetables as src
from tests.conftest import rows


def timetable(revision, name, code="PD1", start="2024-01-01", flexible=False, prefix=""):
    p = prefix
    stops = "".join(f"<{p}AnnotatedStopPointRef><{p}StopPointRef>{s}</{p}StopPointRef><{p}CommonName>Stop {s}</{p}CommonName></{p}AnnotatedStopPointRef>" for s in "ABC")
    spot = lambda lon: f"<{p}Location id='l'><{p}Longitude>{lon}</{p}Longitude><{p}Latitude>52</{p}Latitude></{p}Location>"
    route = "".join(
        f'<{p}RouteLink id="{i}"><{p}From><{p}StopPointRef>{a}</{p}StopPointRef></{p}From><{p}To><{p}StopPointRef>{b}</{p}StopPointRef></{p}To>'
        f"<{p}Distance>{d}</{p}Distance><{p}Track><{p}Mapping>{spot(-1)}{spot(-1.01)}{spot(-1.02)}</{p}Mapping></{p}Track></{p}RouteLink>"
        for i, (a, b, d) in enumerate([("A", "B", 500), ("A", "B", 700), ("B", "C", 900)])
    )
    link = lambda i, a, b: (
        f'<{p}JourneyPatternTimingLink id="t{i}"><{p}From SequenceNumber="{i}"><{p}StopPointRef>{a}</{p}StopPointRef><{p}TimingStatus>principalTimingPoint</{p}TimingStatus></{p}From>'
        f"<{p}To><{p}StopPointRef>{b}</{p}StopPointRef></{p}To><{p}RouteLinkRef>{i}</{p}RouteLinkRef><{p}RunTime>PT5M</{p}RunTime></{p}JourneyPatternTimingLink>"
    )
    zone = (
        f'<{p}FlexibleService><{p}FlexibleJourneyPattern id="fj"><{p}Direction>outbound</{p}Direction><{p}StopPointsInSequence>'
        f"<{p}FixedStopUsage><{p}StopPointRef>A</{p}StopPointRef></{p}FixedStopUsage><{p}FlexibleStopUsage x='1'><{p}StopPointRef>C</{p}StopPointRef></{p}FlexibleStopUsage>"
        f"</{p}StopPointsInSequence></{p}FlexibleJourneyPattern></{p}FlexibleService>"
        if flexible
        else ""
    )
    flexible_journey = (
        f"<{p}FlexibleVehicleJourney><{p}VehicleJourneyCode>fv</{p}VehicleJourneyCode><{p}ServiceRef>{code}</{p}ServiceRef><{p}LineRef>l1</{p}LineRef>"
        f"<{p}JourneyPatternRef>fj</{p}JourneyPatternRef><{p}FlexibleServiceTimes><{p}ServicePeriod z='1'><{p}StartTime>07:00:00</{p}StartTime>"
        f"<{p}EndTime>19:00:00</{p}EndTime></{p}ServicePeriod></{p}FlexibleServiceTimes></{p}FlexibleVehicleJourney>"
        if flexible
        else ""
    )
    space = f' xmlns:{p[:-1]}="http://www.transxchange.org.uk/"' if p else ""
    return (
        f'<{p}TransXChange{space} SchemaVersion="2.4" RevisionNumber="{revision}" FileName="{name}"><{p}StopPoints>{stops}</{p}StopPoints>'
        f'<{p}RouteSections><{p}RouteSection id="rs">{route}</{p}RouteSection></{p}RouteSections>'
        f'<{p}JourneyPatternSections><{p}JourneyPatternSection id="s">{link(0, "A", "B")}{link(1, "B", "C")}</{p}JourneyPatternSection></{p}JourneyPatternSections>'
        f"<{p}Services><{p}Service><{p}ServiceCode>{code}</{p}ServiceCode><{p}Lines><{p}Line id='l1'><{p}LineName>One</{p}LineName></{p}Line></{p}Lines>"
        f"<{p}OperatingPeriod><{p}StartDate>{start}</{p}StartDate></{p}OperatingPeriod>"
        f"<{p}StandardService><{p}Origin>O</{p}Origin><{p}Destination>D</{p}Destination><{p}JourneyPattern id='j'><{p}DestinationDisplay>x</{p}DestinationDisplay>"
        f"<{p}Direction>inbound</{p}Direction><{p}RouteRef>r</{p}RouteRef><{p}JourneyPatternSectionRefs>s</{p}JourneyPatternSectionRefs></{p}JourneyPattern></{p}StandardService>"
        f"{zone}</{p}Service></{p}Services><{p}VehicleJourneys><{p}VehicleJourney><{p}VehicleJourneyCode>v</{p}VehicleJourneyCode><{p}ServiceRef>{code}</{p}ServiceRef>"
        f"<{p}LineRef>l1</{p}LineRef><{p}JourneyPatternRef>j</{p}JourneyPatternRef><{p}DepartureTime>08:00:00</{p}DepartureTime></{p}VehicleJourney>{flexible_journey}</{p}VehicleJourneys></{p}TransXChange>"
    )


@pytest.fixture(scope="module")
def job(spark):
    uploads = [
        (1, 10, 100, timetable(5, "a.xml", start="2024-02-01")),
        (2, 20, 200, timetable(1, "a.xml", start="2024-01-01", flexible=True)),
        (3, 10, 100, timetable(4, "old.xml", start="2024-03-01")),
        (4, 10, 100, timetable(9, "same name.xml", code="PD2")),
        (5, 10, 100, timetable(9, "same name.xml", code="PD2")),
    ]
    texts = spark.createDataFrame(uploads, "file_id long, revision_id long, dataset_id long, text string")
    stops = spark.createDataFrame(
        [(s, i, f"Stop {s}", -1.0 - i / 100, 52.0, "E1", 3) for i, s in enumerate("ABC")],
        "atco_code string, id int, common_name string, lon double, lat double, locality_id string, admin_area_id int",
    )
    holidays = spark.createDataFrame([], "txc_element string, date date, division string")
    return process(docs.parse_timetables(texts), References(stops, holidays))


def test_revisions_do_not_supersede_each_other(job):
    got = {r.file_id: r.superseded for r in job["file_attributes"].collect()}
    # 3 is older than 1 in one upload; 2 stands alone in another; of 4 and 5, with one name, one counts.
    assert got == {1: False, 2: False, 3: True, 5: False}
    assert rows(job.by_revision("service_patterns"), "file_id", "revision_id", "dataset_id") == [(1, 10, 100), (2, 20, 200), (5, 10, 100)]


def test_the_later_upload_of_a_name_counts(spark):
    """By the order the caller gives, whatever the ids; without one by what the files say."""
    same = timetable(9, "same.xml")
    older = same.replace("<TransXChange", '<TransXChange ModificationDateTime="2024-01-01T00:00:00"')
    newer = same.replace("<TransXChange", '<TransXChange ModificationDateTime="2024-02-01T00:00:00"')
    uploads = [(9, 1, 3, older), (2, 1, 5, older), (7, 1, None, newer), (4, 2, 1, older), (5, 2, 2, older), (6, 3, 1, older)]
    read = docs.parse_timetables(spark.createDataFrame(uploads, "file_id long, revision_id long, upload_order long, text string"))
    stops = spark.createDataFrame([], "atco_code string, id int, common_name string, lon double, lat double, locality_id string, admin_area_id int")
    holidays = spark.createDataFrame([], "txc_element string, date date, division string")
    given = process(read, References(stops, holidays))["file_attributes"]
    assert rows(given, "file_id") == [(2,), (5,), (6,)] and "upload_order" not in given.columns
    stated = process(read.drop("upload_order"), References(stops, holidays))["file_attributes"]
    assert rows(stated, "file_id") == [(5,), (6,), (7,)]


def test_one_row_per_stop_for_all_tables(spark):
    text = timetable(1, "a.xml").replace(
        "<StopPoints>", "<StopPoints><AnnotatedStopPointRef><StopPointRef>A</StopPointRef><CommonName>Another</CommonName></AnnotatedStopPointRef>"
        "<StopPoint><AtcoCode>B</AtcoCode><Descriptor><CommonName>Own B</CommonName></Descriptor><Place><NptgLocalityRef>E</NptgLocalityRef><Location>"
        "<Translation><Longitude>-3</Longitude><Latitude>50</Latitude></Translation></Location></Place><StopClassification><StopType>BCT</StopType></StopClassification>"
        "<AdministrativeAreaRef>1</AdministrativeAreaRef></StopPoint>")
    read = docs.parse_timetables(spark.createDataFrame([(1, text)], "file_id long, text string"))
    stops = spark.createDataFrame(
        [(c, i, f"Reg {c}", -1.0 - i / 100, 52.0, "E1", 3) for i, c in enumerate("ABC")],
        "atco_code string, id int, common_name string, lon double, lat double, locality_id string, admin_area_id int",
    )
    made = process(read, References(stops, spark.createDataFrame([], "txc_element string, date date, division string")))
    assert rows(made["stop_times"], "atco_code", "common_name") == [("A", "Reg A"), ("B", "Own B"), ("C", "Reg C")]
    assert (made["pattern_metadata"].first().origin, made["pattern_metadata"].first().destination) == ("Reg A", "Reg C")


def test_pattern_ids_and_their_tables(job):
    bridge = job["service_patterns"]
    assert bridge.select("service_pattern_id").distinct().count() == bridge.count() == 3
    assert rows(job["pattern_distances"], "file_id", "distance", "distance_source") == [(f, 1600, "tracks") for f in (1, 2, 5)]
    assert {len(r.points) for r in job["pattern_geometry"].collect()} == {6}
    meta = job["pattern_metadata"].where("file_id = 1").first()
    assert (meta.origin, meta.destination, meta.line_name, meta.description) == ("Stop A", "Stop C", "One", "Stop A - Stop C")
    assert rows(job["run_statistics"].where("file_id = 1"), "num_stops", "vehicle_journeys") == [(3, 1)]


def test_stop_rows_and_tracks_of_journeys(job):
    one = job["stop_times"].where("file_id = 1").orderBy("auto_sequence_number").collect()
    assert [(r.atco_code, r.naptan_stop_id, r.common_name, r.departure_time) for r in one] == [
        ("A", 0, "Stop A", "08:00:00"), ("B", 1, "Stop B", "08:05:00"), ("C", 2, "Stop C", "08:10:00")]
    assert one[0].service_pattern_id == job["service_patterns"].where("file_id = 1").first().service_pattern_id
    tracks = job["vehicle_journey_tracks"].where("file_id = 1")
    assert rows(tracks, "vj_code", "sequence_number") == [("v", 0), ("v", 1)]


def test_flexible_patterns(job):
    assert rows(job["flexible_service_patterns"], "file_id", "jp_id", "num_stops") == [(2, "fj", 2)]
    members = job["pattern_members"].where("file_id = 2")
    assert members.count() == 1
    assert rows(job["service_pattern_links"].where("file_id = 2"), "used_by") == [("PD1",), ("PD1",)]
    assert rows(job["pattern_localities"].where("file_id = 2"), "locality_id") == [("E1",), ("E1",)]


def test_flexible_patterns_are_full_patterns(job):
    keys = ("file_id", "num_stops", "vehicle_journeys")
    assert rows(job["flexible_pattern_members"], *keys) == [(2, 2, 1)]
    assert rows(job["flexible_pattern_directions"], "direction") == [("outbound",)]
    assert rows(job["flexible_pattern_lines"], "line_ref") == [("l1",)]
    assert rows(job["flexible_pattern_metadata"], "origin", "destination", "line_name", "description") == [("Stop A", "Stop C", "One", "Stop A - Stop C")]
    assert [[tuple(p) for p in r.points] for r in job["flexible_pattern_geometry"].collect()] == [[(-1.0, 52.0), (-1.02, 52.0)]]
    stats = job["run_statistics"].where("file_id = 2").first().asDict()
    assert stats == dict(file_id=2, service_patterns=2, num_stops=5, journey_patterns=2, vehicle_journeys=2, localities=2, admin_areas=2, tracks=2, distance=1600)


def test_zone_points_follow_their_stop(spark):
    spot = lambda lon: f"<Location><Translation><Longitude>{lon}</Longitude><Latitude>50</Latitude></Translation></Location>"
    text = timetable(1, "a.xml", flexible=True).replace(
        "<StopPoints>", f"<StopPoints><StopPoint><AtcoCode>A</AtcoCode><Descriptor><CommonName>Own A</CommonName></Descriptor><Place><NptgLocalityRef>E</NptgLocalityRef>{spot(-3)}</Place>"
        f"<StopClassification><StopType>BCT</StopType><OnStreet><Bus><BusStopType>FLX</BusStopType><FlexibleZone>{spot(-3.1)}<Location/>{spot(-3.2)}</FlexibleZone></Bus></OnStreet></StopClassification>"
        "<AdministrativeAreaRef>1</AdministrativeAreaRef></StopPoint>")
    read = docs.parse_timetables(spark.createDataFrame([(1, text)], "file_id long, text string"))
    zone = "zone array<struct<lon:double,lat:double>>"
    stops = spark.createDataFrame(
        [("C", 2, "Stop C", -1.0, 52.0, "E1", 3, [(-1.5, 52.5)]), ("A", 1, "Stop A", 0.0, 0.0, "E1", 3, [(9.0, 9.0)]), ("B", 3, "Stop B", -2.0, 51.0, "E1", 3, None)],
        f"atco_code string, id int, common_name string, lon double, lat double, locality_id string, admin_area_id int, {zone}",
    )
    made = process(read, References(stops, spark.createDataFrame([], "txc_element string, date date, division string")))
    want = [(-3.0, 50.0), (-3.1, 50.0), (-3.2, 50.0), (-1.0, 52.0), (-1.5, 52.5)]
    assert [[tuple(p) for p in r.points] for r in made["flexible_pattern_geometry"].collect()] == [want]


def test_prefixed_documents_read_alike(spark):
    texts = spark.createDataFrame([(i, timetable(1, "a.xml", flexible=True, prefix=p)) for i, p in enumerate(("", "t:"))], "file_id long, text string")
    read = docs.parse_timetables(texts)
    for name in ("flexible_stops", "flexible_journeys", "lines", "timing_links", "route_links", "stop_points"):
        table = src.SECTIONS[name](read)
        plain, prefixed = (rows(table.where(f"file_id = {i}").drop("file_id")) for i in (0, 1))
        assert plain and plain == prefixed, name


def test_files_read_in_parts_give_the_same_sections(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.xml").write_text(timetable(i, f"{i}.xml", flexible=i == 1))
    whole, parts = src.sections(docs.read_timetables(spark, str(tmp_path))), large_sections(spark, str(tmp_path))
    assert set(parts) == set(whole)
    for name, table in whole.items():
        positions = [c for c in table.columns if c in ("ordinal", "owner_pos") or c.endswith(("_pos", "_ord")) and c not in ("link_pos", "line_pos", "stop_pos")]
        plain = [c for c in table.columns if c not in positions]
        assert rows(parts[name].select(*plain)) == rows(table.select(*plain)), name
    order = lambda t: [r.vj_code for r in t.orderBy("file_id", "ordinal").collect()]
    assert order(parts["vehicle_journeys"]) == order(whole["vehicle_journeys"])


FARES = """<PublicationDelivery version="1.1"><dataObjects><CompositeFrame id="c"><frames><FareFrame id="f"><fareZones>
<FareZone id="z1" version="1"><Name>Zone</Name></FareZone><FareZone id="z2" version="1"/><FareZone id="z3"><Name>No version</Name></FareZone></fareZones>
<tariffs><Tariff id="t"><fareStructureElements><FareStructureElement id="e"{version}/></fareStructureElements></Tariff></tariffs>
<fareProducts><PreassignedFareProduct id="p"/><SupplementProduct id="s"/><UsageDiscountRight/></fareProducts></FareFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"""


def test_empty_structure_elements_break_their_rule(spark):
    empty = '<PublicationDelivery version="1.1"><dataObjects><CompositeFrame id="c"><frames><FareFrame id="f"><tariffs><Tariff id="t"><fareStructureElements/></Tariff></tariffs></FareFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>'
    full = empty.replace("<fareStructureElements/>", '<fareStructureElements><FareStructureElement id="e" version="1"/></fareStructureElements>')
    read = docs.parse_fares(spark.createDataFrame([(1, empty), (2, full)], "file_id int, text string"))
    assert rows(fares_violations(read).where("observation = 20"), "file_id", "element") == [(1, "fareStructureElements")]


def test_fares_counts_and_admission(spark):
    texts = spark.createDataFrame([(1, FARES.format(version=' version="1"')), (2, FARES.format(version=""))], "file_id int, text string")
    read = docs.parse_fares(texts)
    assert rows(fares.fare_frames(read), "file_id", "num_of_fare_products") == [(1, 3), (2, 3)]
    assert rows(fares.fare_zones(read), "file_id", "zone_id") == [(1, "z1"), (2, "z1")]
    assert rows(fares.rejected_zones(read).where("file_id = 1"), "reason") == [("name",), ("version",)]
    assert rows(fares.failed_files(read), "file_id") == [(2,)]
