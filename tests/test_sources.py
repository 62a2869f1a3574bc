import datetime
import hashlib

from pyspark.sql import functions as F

from headway.operators import lifecycle as life
from headway.sources import documents as docs
from headway.sources import tables as tab
from headway.sources import timetables as src
from headway.sources.admission import admit, admit_sections
from headway.streaming import feeds
from tests.conftest import rows

TIMETABLE = """<?xml version="1.0" encoding="utf-8"?>
<TransXChange xmlns="http://www.transxchange.org.uk/" SchemaVersion="2.4" CreationDateTime="2024-01-01T00:00:00"
 ModificationDateTime="2024-01-02T00:00:00" Modification="revise" RevisionNumber="7" FileName="one.xml">
 <StopPoints>
  <AnnotatedStopPointRef><StopPointRef>A</StopPointRef><CommonName>Alpha &amp; Co</CommonName></AnnotatedStopPointRef>
  <AnnotatedStopPointRef><StopPointRef>B</StopPointRef></AnnotatedStopPointRef>
  <StopPoint><AtcoCode>C</AtcoCode><Descriptor><CommonName>Gamma</CommonName></Descriptor>
   <Place><NptgLocalityRef>E1</NptgLocalityRef><Location><Easting>400000</Easting><Northing>300000</Northing></Location></Place>
   <StopClassification><StopType>BCT</StopType></StopClassification><AdministrativeAreaRef>9</AdministrativeAreaRef></StopPoint>
 </StopPoints>
 <Operators><Operator id="o"><NationalOperatorCode>ABCD</NationalOperatorCode></Operator></Operators>
 <Services><Service><ServiceCode>PD0000001:1</ServiceCode><Lines><Line id="l1"><LineName>1</LineName></Line><Line id="l2"><LineName>2</LineName></Line></Lines>
  <OperatingPeriod><StartDate>2024-01-01</StartDate></OperatingPeriod><Mode>hovercraft</Mode>
  <OperatingProfile><RegularDayType><DaysOfWeek/></RegularDayType></OperatingProfile>
  <StandardService><Origin>A</Origin><Destination>C</Destination>
   <JourneyPattern id="j"><DestinationDisplay>x</DestinationDisplay><Direction>inbound</Direction><RouteRef>r</RouteRef>
    <JourneyPatternSectionRefs>s2</JourneyPatternSectionRefs><JourneyPatternSectionRefs>s1</JourneyPatternSectionRefs></JourneyPattern></StandardService>
 </Service></Services>
 <VehicleJourneys>
  <VehicleJourney><VehicleJourneyCode>v1</VehicleJourneyCode><DepartureTime>08:00:00</DepartureTime><DepartureDayShift>0</DepartureDayShift>
   <Operational><Block><BlockNumber>7</BlockNumber></Block></Operational>
   <OperatingProfile><RegularDayType><DaysOfWeek><MondayToFriday/><Weekend/></DaysOfWeek></RegularDayType></OperatingProfile></VehicleJourney>
  <VehicleJourney><VehicleJourneyCode>v2</VehicleJourneyCode>
   <OperatingProfile><RegularDayType><DaysOfWeek><Monday/></DaysOfWeek><HolidaysOnly/></RegularDayType></OperatingProfile></VehicleJourney>
  <VehicleJourney><VehicleJourneyCode>v3</VehicleJourneyCode><DepartureTime>09:00:00</DepartureTime>
   <OperatingProfile><RegularDayType><HolidaysOnly/></RegularDayType></OperatingProfile></VehicleJourney>
  <VehicleJourney><VehicleJourneyCode>v4</VehicleJourneyCode><DepartureTime>09:00:00</DepartureTime>
   <OperatingProfile><BankHolidayOperation><DaysOfOperation><GoodFriday/></DaysOfOperation></BankHolidayOperation></OperatingProfile></VehicleJourney>
 </VehicleJourneys>
</TransXChange>"""


def corpus(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.xml").write_text(text)
    return str(tmp_path)


def test_read_timetables(spark, tmp_path):
    read = docs.read_timetables(spark, corpus(tmp_path, one=TIMETABLE))
    assert read.count() == 1 and docs.corrupt_documents(read).count() == 0
    tables = src.sections(read)
    assert rows(tables["metadata"], "schema_version", "revision_number", "filename") == [("2.4", 7, "one.xml")]
    assert rows(tables["lines"], "line_pos", "line_id") == [(0, "l1"), (1, "l2")]
    assert rows(tables["journey_patterns"], "section_refs") == [(["s2", "s1"],)]
    service = tables["services"].first()
    assert (service.mode, service.public_use, service.has_standard, service.has_flexible) == ("bus", True, True, False)
    stops = {r.atco_code: r for r in tables["stop_points"].collect()}
    # A reference without a name is left out, the grid is converted, entities are read.
    assert set(stops) == {"A", "C"} and stops["A"].common_name == "Alpha & Co" and not stops["C"].is_reference
    assert abs(stops["C"].lon + 2) < 0.01


def test_profiles(spark, tmp_path):
    read = docs.read_timetables(spark, corpus(tmp_path, one=TIMETABLE))
    accepted, rejected = admit_sections({n: src.SECTIONS[n](read) for n in ("operating_profiles", "vehicle_journeys")})
    days = {r.owner_id: [f for f in r.days.asDict() if r.days[f]] for r in accepted["operating_profiles"].collect()}
    week = ["monday", "tuesday", "wednesday", "thursday", "friday"]
    # The first group that matches counts; an empty element means no days.
    assert days == {"v1": week, "v3": ["holidays_only"], "PD0000001:1": []}
    # v2 mixes days and holidays only, v4 has no regular part; v2 has no departure.
    assert rows(rejected, "section", "reason") == [("operating_profiles", "days")] * 2 + [("vehicle_journeys", "departure_time")]
    journey = accepted["vehicle_journeys"].where("vj_code = 'v1'").first()
    assert journey.block is None and journey.departure_day_shift == 0 and journey.commercial_basis == "notContracted"


def test_parsing_text_equals_reading_files(spark, tmp_path):
    path = corpus(tmp_path, one=TIMETABLE)
    listed = docs.scan_corpus(spark, path)
    parsed = docs.parse_timetables(listed.select("file_id", "text"))
    read = docs.read_timetables(spark, path)
    for name in ("lines", "vehicle_journeys", "stop_points", "operating_profiles"):
        a = [r[1:] for r in rows(src.SECTIONS[name](parsed))]
        b = [r[1:] for r in rows(src.SECTIONS[name](read))]
        assert a == b and a


def test_narrow_parsing_gives_the_same_sections(spark):
    texts = [TIMETABLE, TIMETABLE.replace("</VehicleJourneys>", ""), "<TransXChange FileName='x'><VehicleJourneys/><Services><Service/></Services></TransXChange>", "<TransXChange><Services>", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "file_id int, text string")
    for name, fields in src.FIELDS.items():
        narrow = src.SECTIONS[name](docs.parse_timetables(frame, fields=fields))
        assert rows(narrow) == rows(src.SECTIONS[name](docs.parse_timetables(frame))), name
    corrupt = docs.unreadable_files(docs.parse_timetables(frame, fields=src.FIELDS["metadata"]))
    assert rows(corrupt) == rows(docs.unreadable_files(docs.parse_timetables(frame)))


def test_filters_do_not_parse_again(spark):
    frame = spark.range(3).selectExpr("id as file_id", "concat('<TransXChange>', id, '</TransXChange>') as text")
    plan = docs.parse_timetables(frame).select("file_id", F.explode("StopPoints.StopPoint"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1


def test_corrupt_file_is_kept(spark, tmp_path):
    path = corpus(tmp_path, good=TIMETABLE, bad="<TransXChange><Services><Service></TransXChange>")
    parsed = docs.parse_timetables(docs.scan_corpus(spark, path).select("file_id", "name", "text"))
    assert rows(docs.corrupt_documents(parsed), "name") == [("bad.xml",)]
    assert src.metadata(parsed).where("schema_version = '2.4'").count() == 1


def test_scan_and_safety(spark, tmp_path):
    entity = '<!DOCTYPE x [<!ENTITY e "boom">]><TransXChange SchemaVersion="2.4"/>'
    path = corpus(tmp_path, ok=TIMETABLE, dtd=entity, fares='<PublicationDelivery version="1.1"/>', old='<TransXChange SchemaVersion="2.1"/>')
    listed = docs.scan_corpus(spark, path)
    ok = listed.where("name = 'ok.xml'").first()
    assert ok.sha1 == hashlib.sha1(TIMETABLE.encode()).hexdigest() and ok.size == len(TIMETABLE.encode())
    assert rows(docs.safety_violations(listed, "TransXChange", ("2.4",)), "name", "error_code") == [
        ("dtd.xml", "DANGEROUS_XML_ERROR"), ("fares.xml", "XML_SYNTAX_ERROR"), ("old.xml", "SCHEMA_VERSION_NOT_SUPPORTED")]
    owned = listed.withColumn("dataset_id", F.lit(1))
    live = owned.where("name = 'ok.xml'").select("dataset_id", "sha1")
    assert life.changed_files(owned, live).count() == 3 and life.unchanged_files(owned, live).count() == 1
    assert life.changed_files(owned.withColumn("dataset_id", F.lit(2)), live).count() == 4


def test_malformed_documents_are_unsafe(spark, tmp_path):
    path = corpus(tmp_path, cut='<TransXChange SchemaVersion="2.4"><Services></TransXChange>', open='<TransXChange SchemaVersion="2.4">', ok=TIMETABLE)
    found = docs.safety_violations(docs.scan_corpus(spark, path), "TransXChange", ("2.4",))
    assert rows(found, "name", "error_code") == [(n, "XML_SYNTAX_ERROR") for n in ("cut.xml", "open.xml")]


def test_listing_and_readers_agree_on_file_ids(spark, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    (folder / "a b.xml").write_text(TIMETABLE)
    (folder / "c%20d.xml").write_text(TIMETABLE)
    listed, read = docs.scan_corpus(spark, str(folder)), docs.read_timetables(spark, str(folder))
    both = listed.join(read.select("file_id", F.col("path").alias("read_from")), "file_id")
    assert both.where("path = read_from").count() == 2
    status = read.select("file_id", F.when(F.col("path").contains("b.xml"), "succeeded").otherwise("failed").alias("status"))
    assert rows(docs.surviving_files(listed, status), "name") == [("a b.xml",)]


def test_schema_validation(spark, tmp_path):
    xsd = tmp_path / "doc.xsd"
    xsd.write_text("""<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="TransXChange"><xs:complexType>
      <xs:attribute name="SchemaVersion" type="xs:decimal" use="required"/></xs:complexType></xs:element></xs:schema>""")
    (tmp_path / "in").mkdir()
    path = corpus(tmp_path / "in", good='<TransXChange SchemaVersion="2.4"/>', bad='<TransXChange SchemaVersion="two"/>')
    found = docs.schema_violations(docs.read_timetables(spark, path, xsd=str(xsd)))
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["bad.xml"]


def test_stop_register(spark, tmp_path):
    stop = lambda code, second, day: (
        f'<StopPoint ModificationDateTime="2024-01-0{day}T00:00:00"><AtcoCode>{code}</AtcoCode><NaptanCode>{second}</NaptanCode>'
        f"<Descriptor><CommonName>{code}{day}</CommonName></Descriptor><Place><Location><Translation><Longitude>-1</Longitude>"
        "<Latitude>52</Latitude></Translation></Location></Place></StopPoint>")
    (tmp_path / "register.xml").write_text("<NaPTAN><StopPoints>" + stop("A", "", 1) + stop("B", "n2", 1) + stop("B", "n3", 2) + "</StopPoints></NaPTAN>")
    incoming = tab.read_stop_register(spark, str(tmp_path / "register.xml"))
    stored = incoming.where("atco_code = 'A'").withColumn("common_name", F.lit("old")).withColumn("atco_code", F.explode(F.array(F.lit("A"), F.lit("Z"))))
    merged = tab.load_stops(stored, incoming)
    assert rows(merged, "atco_code", "naptan_code", "common_name") == [("A", None, "A1"), ("B", "n3", "B2"), ("Z", None, "old")]


def test_admission(spark):
    df = spark.createDataFrame([("f", "a", None), ("f", "", "x"), ("f", None, None)], "file_id string, code string, name string")
    accepted, rejected = admit(df, ["code"], {"name": "none"})
    assert rows(accepted) == [("f", "a", "none")]
    assert rejected.count() == 2 and rows(rejected, "reason") == [("code",), ("code",)]


def test_replace_and_extract(spark, tmp_path):
    path = str(tmp_path / "out")
    tab.replace_revisions(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "revision_id int, v string"), path)
    tab.replace_revisions(spark.createDataFrame([(1, "z")], "revision_id int, v string"), path)
    assert rows(spark.read.parquet(path), "revision_id", "v") == [(1, "z"), (2, "c")]
    tables = {
        "services": spark.createDataFrame([(10, 1), (20, 2)], "id int, revision_id int"),
        "service_patterns": spark.createDataFrame([(100, 10, ["x"]), (200, 20, ["y"])], "id int, service_id int, names array<string>"),
    }
    found = tab.extract_revision(tables, spark.createDataFrame([(1,)], "id int"))
    assert rows(found["service_patterns"], "id") == [(100,)]
    tab.write_extract(found, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv/service_patterns")).first()["names"] == '["x"]'


def test_feed_archive_over_batches(spark, tmp_path):
    schema = "data_format string, received_at timestamp, body string"
    stamp = lambda m: datetime.datetime(2024, 1, 1, 10, m)

    def arrive(*snapshots):
        spark.createDataFrame(list(snapshots), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = feeds.archive_feed(stream, str(tmp_path / "archive"), str(tmp_path / "latest"), str(tmp_path / "state"), availableNow=True)
        q.awaitTermination()

    arrive(("GTFSRT", stamp(1), "a"), ("GTFSRT", stamp(2), "b"), ("SIRIVM", stamp(1), "c"))
    run()
    arrive(("GTFSRT", stamp(3), "d"), ("GTFSRT", stamp(0), "late"))
    run()
    run()
    archived = spark.read.parquet(str(tmp_path / "archive"))
    assert archived.count() == 5
    latest = feeds.current_latest(spark, str(tmp_path / "latest"))
    assert rows(latest, "data_format", "file") == [("GTFSRT", "gtfsrt_2024-01-01_100300.zip"), ("SIRIVM", "sirivm_2024-01-01_100100.zip")]

    # A stream with a checkpoint of its own keeps what is archived, and pointers do not pile up.
    arrive(("SIRIVM", stamp(5), "e"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    feeds.archive_feed(stream, str(tmp_path / "archive"), str(tmp_path / "latest"), str(tmp_path / "state 2"), availableNow=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 5 + 6
    latest = feeds.current_latest(spark, str(tmp_path / "latest"))
    assert rows(latest, "file") == [("gtfsrt_2024-01-01_100300.zip",), ("sirivm_2024-01-01_100500.zip",)]
    for minute in (6, 7, 8):
        arrive(("SIRIVM", stamp(minute), "f"))
        run()
    assert all(len(list(r.glob("batch=*"))) <= 2 for r in (tmp_path / "latest").glob("run=*"))


def test_new_arrivals_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = corpus(tmp_path / "in", a="<x>1</x>", b="<x>1</x>", c="<x>2</x>", d="<x>3</x>")
    live = spark.createDataFrame([(hashlib.sha1(b"<x>3</x>").hexdigest(),)], "sha1 string")

    def run():
        q = (feeds.new_content(feeds.arrivals(spark, path), live).select("sha1", "text").writeStream.format("parquet")
             .option("path", str(tmp_path / "new")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    assert rows(spark.read.parquet(str(tmp_path / "new")), "text") == [("<x>1</x>",), ("<x>2</x>",)]
    corpus(tmp_path / "in", e="<x>2</x>", f="<x>4</x>")
    run()
    assert rows(spark.read.parquet(str(tmp_path / "new")), "text") == [("<x>1</x>",), ("<x>2</x>",), ("<x>4</x>",)]


def test_files_published_after_the_start_are_skipped(spark, tmp_path):
    stamp = lambda day, hour: datetime.datetime(2024, 1, day, hour)
    schemas = {"in": "sha1 string, arrived_at timestamp", "live": "sha1 string, published_at timestamp"}

    def come(where, *rows_):
        spark.createDataFrame(list(rows_), schemas[where]).coalesce(1).write.mode("append").parquet(str(tmp_path / where))

    def run():
        streams = [spark.readStream.schema(schemas[w]).parquet(str(tmp_path / w)) for w in ("in", "live")]
        q = (feeds.unpublished(*streams, delay="2 hours", horizon="3 days").writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
        q.awaitTermination()
        return q.recentProgress

    def given():
        return [r.sha1 for r in spark.read.schema("sha1 string").parquet(str(tmp_path / "out")).orderBy("sha1").collect()]

    come("in", ("before", stamp(1, 10)), ("after", stamp(1, 10)), ("new", stamp(1, 10)), ("new", stamp(1, 11)))
    come("live", ("before", stamp(1, 8)))
    run()
    come("live", ("after", stamp(1, 11)))
    come("in", ("other", stamp(1, 12)))
    run()
    assert given() == []
    # Time goes on for both; what nothing matched comes out, once, and state is let go.
    sizes = []
    for day in (2, 3, 9, 20):
        come("in", (f"tick {day}", stamp(day, 0)))
        come("live", (f"other tick {day}", stamp(day, 0)))
        progress = run()
        sizes.append(sum(o.numRowsTotal for o in progress[-1].stateOperators))
    assert given()[:2] == ["new", "other"] and "before" not in given() and "after" not in given()
    assert sizes[-1] <= sizes[0]
