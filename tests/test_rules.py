import random

import pytest

from pyspark.sql import functions as F

from headway.rules.fares import fares_violations
from headway.rules.runner import Catalogue, Observation, violation_rows
from headway.rules.timetable import catalogue, service_type, timetable_violations, unrelated_lines
from headway.sources.documents import parse_fares, parse_timetables
from tests.conftest import rows

HEAD = '<TransXChange SchemaVersion="2.4" CreationDateTime="{c}" ModificationDateTime="{m}" Modification="{k}" RevisionNumber="{r}" FileName="f.xml">'

JOINING = {23, 28, 34, 43, 47, 125}


def found(spark, body="", numbers=None, c="1", m="2", k="revise", r="1", **references):
    text = HEAD.format(c=c, m=m, k=k, r=r) + body + "</TransXChange>"
    parsed = parse_timetables(spark.createDataFrame([(1, text)], "file_id int, text string"))
    today = F.lit("2024-06-01").cast("date")
    if numbers and not numbers & JOINING:
        out = catalogue(today, table_rules=False).run(parsed, service_type())
    else:
        out = timetable_violations(parsed, today, **references)
    return [r for r in rows(out, "observation", "element", "ordinal") if numbers is None or r[0] in numbers]


def test_empty_document_breaks_nothing(spark):
    assert found(spark) == []


@pytest.mark.parametrize(
    "given, broken",
    [
        (dict(c="1", m="1", r="0", k="new"), []),
        (dict(c="1", m="2", r="0", k="new"), [2]),
        (dict(c="1", m="1", r="3", k="revise"), [2]),
        (dict(c="2", m="1", r="3", k="revise"), [2]),
        (dict(c="1", m="2", r="3", k="new"), [3]),
        (dict(c="1", m="1", r="0", k="revise"), [3]),
    ],
)
def test_versioning(spark, given, broken):
    assert [n for n, _, _ in found(spark, numbers={2, 3}, **given)] == broken


def org(inside):
    return f"<ServicedOrganisations><ServicedOrganisation><Name>School</Name>{inside}</ServicedOrganisation></ServicedOrganisations>"


@pytest.mark.parametrize(
    "inside, broken",
    [
        ("", [11]),
        ("<WorkingDays><DateRange><StartDate>2024-01-01</StartDate><EndDate>2024-02-01</EndDate></DateRange></WorkingDays>", []),
        ("<WorkingDays><DateRange><StartDate>2024-01-01</StartDate><EndDate>2024-02-01</EndDate><Provisional>true</Provisional></DateRange></WorkingDays>", [11]),
        ("<WorkingDays><DateRange><StartDate>2025-01-01</StartDate><EndDate>2025-02-01</EndDate><Provisional>true</Provisional></DateRange></WorkingDays>", []),
        ("<WorkingDays><DateRange><EndDate>2025-02-01</EndDate></DateRange></WorkingDays>", [11, 9]),
    ],
)
def test_organisation_dates(spark, inside, broken):
    assert sorted(n for n, _, _ in found(spark, org(inside), {9, 11})) == sorted(broken)


def test_only_first_failing_rule_of_an_observation(spark):
    body = "<ServicedOrganisations><ServicedOrganisation><WorkingDays/></ServicedOrganisation></ServicedOrganisations>"
    # Neither rule of number 10 holds; one violation is reported.
    assert found(spark, body, {10}) == [(10, "ServicedOrganisation", 0)]


def section(*links):
    made = "".join(f'<JourneyPatternTimingLink id="l{i}"><From><StopPointRef>{a}</StopPointRef></From><To><StopPointRef>{b}</StopPointRef></To></JourneyPatternTimingLink>' for i, (a, b) in enumerate(links))
    return f'<JourneyPatternSections><JourneyPatternSection id="s">{made}</JourneyPatternSection></JourneyPatternSections>'


@pytest.mark.parametrize("links, ok", [([("A", "B"), ("B", "C")], True), ([("A", "B"), ("C", "D")], False), ([("A", "B")], True)])
def test_links_join_up(spark, links, ok):
    assert (found(spark, section(*links), {37}) == []) is ok


def test_last_journey_link_counts(spark):
    pattern = '<JourneyPatternSections><JourneyPatternSection id="s"><JourneyPatternTimingLink id="l"><RunTime>PT1M</RunTime></JourneyPatternTimingLink></JourneyPatternSection></JourneyPatternSections>'
    with_from = "<VehicleJourneyTimingLink><JourneyPatternTimingLinkRef>l</JourneyPatternTimingLinkRef><From><WaitTime>PT1M</WaitTime></From></VehicleJourneyTimingLink>"
    without = "<VehicleJourneyTimingLink><JourneyPatternTimingLinkRef>l</JourneyPatternTimingLinkRef></VehicleJourneyTimingLink>"
    journeys = lambda *ls: "<VehicleJourneys>" + "".join(f"<VehicleJourney>{x}</VehicleJourney>" for x in ls) + "</VehicleJourneys>"
    assert len(found(spark, pattern + journeys(without, with_from), {34})) == 1
    assert found(spark, pattern + journeys(with_from, without), {34}) == []


def test_service_type(spark):
    def kind(service):
        text = HEAD.format(c=1, m=2, k="revise", r=1) + f"<Services><Service>{service}</Service></Services></TransXChange>"
        parsed = parse_timetables(spark.createDataFrame([(1, text)], "file_id int, text string"))
        return parsed.select(service_type().alias("v")).first()["v"]

    assert kind("<StandardService/>") == "StandardService"
    assert kind("<ServiceClassification><Flexible/></ServiceClassification>") == "FlexibleService"
    assert kind("<ServiceClassification><NormalStopping/></ServiceClassification>") == "StandardService"
    assert kind("<FlexibleService/>") == "FlexibleService"


LINES = "file_id int, line_id string"


def bridge(spark, column, *pairs):
    return spark.createDataFrame([(1, a, b) for a, b in pairs], f"{LINES}, {column} string")


def related(spark, n, patterns, features):
    lines = spark.createDataFrame([(1, f"L{i}") for i in range(n)], LINES)
    return unrelated_lines(bridge(spark, "jp_ref", *patterns), bridge(spark, "feature", *features), lines).count() == 0


def test_related_lines(spark):
    assert related(spark, 1, [], [])
    assert related(spark, 2, [("L0", "a"), ("L1", "a")], [])
    assert not related(spark, 2, [("L0", "a"), ("L1", "b")], [("L0", "s1"), ("L1", "s2")])
    assert related(spark, 2, [("L0", "a"), ("L1", "b")], [("L0", "s1"), ("L1", "s1")])
    # Three lines connected pair by pair, no feature common to all.
    triangle = [("L0", "x"), ("L1", "x"), ("L1", "y"), ("L2", "y"), ("L0", "z"), ("L2", "z")]
    own = [("L0", "a"), ("L1", "b"), ("L2", "c")]
    assert related(spark, 3, own, triangle)
    assert not related(spark, 3, own, triangle[:-2])
    # A line without journeys fails the first test and is skipped in the second.
    assert related(spark, 3, own[:2], [("L0", "x"), ("L1", "x")])


def test_related_lines_equal_plain_pairs(spark):
    """Files with up to 150 lines, so that bitmaps have several words."""
    rng = random.Random(2)
    lines, patterns, features, want = [], [], [], set()
    for f in range(40):
        n = rng.choice([1, 2, 3, 5, 64, 65, 150])
        names = [f"L{i}" for i in range(n)]
        lines += [(f, x) for x in names]
        own = [(x, f"p{i}") for i, x in enumerate(names)]
        sets = [set(rng.sample(names, max(1, n - rng.randrange(min(n, 4))))) for _ in range(rng.choice([2, 4, 12]))] if rng.random() < 0.8 else []
        if rng.random() < 0.3:
            sets.append({names[0]})
        patterns += [(f, *p) for p in own]
        features += [(f, x, f"s{i}") for i, s in enumerate(sets) for x in s]
        by_feature = all(any(a in s and b in s for s in sets) for a in names for b in names)
        if n > 1 and not by_feature:
            want.add(f)
    frames = [spark.createDataFrame(x, f"{LINES}{c}") for x, c in ((patterns, ", jp_ref string"), (features, ", feature string"), (lines, ""))]
    got = {r.file_id for r in unrelated_lines(*frames).collect()}
    assert want and len(want) < 40 and got == want


def test_many_lines_on_many_stops(spark):
    """2,000 lines on 500 stops, every two of them on some stop: no row is a pair."""
    lines = spark.range(2000).select(F.lit(1).alias("file_id"), F.concat(F.lit("L"), "id").alias("line_id"))
    patterns = lines.withColumn("jp_ref", F.concat(F.lit("p"), "line_id"))
    # Stop s serves all lines but every fifth from s on, so no stop serves all.
    served = spark.range(2000).crossJoin(spark.range(500).withColumnRenamed("id", "s")).where("(id + s) % 5 <> 0")
    features = served.select(F.lit(1).alias("file_id"), F.concat(F.lit("L"), "id").alias("line_id"), F.concat(F.lit("s"), "s").alias("feature"))
    assert unrelated_lines(patterns, features, lines).count() == 0
    alone = features.where("line_id <> 'L7'").unionByName(spark.createDataFrame([(1, "L7", "far")], features.schema))
    assert unrelated_lines(patterns, alone, lines).count() == 1


def test_catalogue_size():
    made = catalogue()
    assert len(made.observations) + len(made.table_rules) == 58


def test_own_rules(spark):
    """Users add tests and table rules of their own."""
    made = Catalogue({"codes": lambda: F.col("codes")})
    made.add(Observation(900, "Own", "1", "codes", "Code", [lambda c: F.length(c) == 2]))
    made.add_table_rule(lambda d, **_: violation_rows(d.where("size(codes) > 2").select("file_id", F.lit(0).alias("ordinal")), 901, "Own", "2", "File", "files"))
    df = spark.createDataFrame([(1, ["ab", "c"]), (2, ["ab", "cd", "ef"])], "file_id int, codes array<string>")
    assert rows(made.run(df), "file_id", "observation", "ordinal") == [(1, 900, 1), (2, 901, 0)]


def fares(spark, frames, composite_id="c", experimental=False):
    head = f' id="{composite_id}"' if composite_id else ""
    text = f'<PublicationDelivery version="1.1"><dataObjects><CompositeFrame{head}><frames>{frames}</frames></CompositeFrame></dataObjects></PublicationDelivery>'
    parsed = parse_fares(spark.createDataFrame([(1, text)], "file_id int, text string"))
    return {r.observation for r in fares_violations(parsed, experimental).collect()}


def test_fares_composite_without_id_or_marking_metadata(spark):
    assert fares(spark, "", None) == {13, 14, 46, 47, 48, 49}
    assert fares(spark, "", "x_METADATA_y") == set()


def test_fares_unreadable_reference_passes(spark):
    product = "<FareFrame><TypeOfFrameRef{}/><tariffs><Tariff/></tariffs></FareFrame>"
    typed = fares(spark, product.format(' ref="UK_PI_FARE_PRODUCT"'))
    unreadable = fares(spark, product.format(""))
    assert {15, 16, 17, 18, 24, 35} <= typed and not {15, 16, 17, 18, 24, 35} & unreadable


def test_fares_every_failing_rule_is_reported(spark):
    got = fares(spark, '<FareFrame><TypeOfFrameRef ref="UK_PI_FARE_PRODUCT"/><fareProducts><PreassignedFareProduct/></fareProducts></FareFrame>')
    assert {25, 26, 27, 28, 29} <= got
