import math
import math
import random

import pytest
from pyspark.sql import functions as F

from headway.functions import geo, text, time
from headway.session import release, staged


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, seconds",
    [
        ("PT0S", 0),
        ("PT5M", 300),
        ("PT1H2M3S", 3723),
        ("P1DT1S", 86401),
        ("-PT90S", -90),
        ("PT1.5S", 1.5),
        ("P", 0),
        ("", 0),
        (None, 0),
        ("5 minutes", 0),
        ("xPT5M", 0),
        ("PT5Mjunk", 300),
    ],
)
def test_duration(spark, value, seconds):
    assert one(spark, time.duration_seconds(F.lit(value).cast("string"))) == seconds


@pytest.mark.parametrize(
    "value, seconds",
    [("00:00:00", 0), ("23:59:59", 86399), ("7:05:3", 25503), ("24:00:00", None), ("08:00", None), ("noon", None), (None, None)],
)
def test_seconds_of_day(spark, value, seconds):
    assert one(spark, time.seconds_of_day(F.lit(value).cast("string"))) == seconds


def test_clock_and_wrap(spark):
    late = time.advance(F.lit(86000), F.lit(600), F.lit(30))
    assert one(spark, late) == 230
    assert one(spark, time.clock(late)) == "00:03:50"
    assert one(spark, time.clock(F.lit(None).cast("double"))) is None
    assert one(spark, time.advance(F.lit(None).cast("int"), F.lit(1), F.lit(1))) is None


def test_reversed_range_is_empty(spark):
    day = lambda d: F.to_date(F.lit(d))
    assert one(spark, F.size(time.day_range(day("2024-01-03"), day("2024-01-01")))) == 0
    assert one(spark, F.size(time.day_range(day("2024-01-01"), day("2024-01-03")))) == 3
    assert one(spark, time.weekday(day("2024-01-07"))) == 7


@pytest.mark.parametrize("char", list(text.PROHIBITED_CHARACTERS))
def test_prohibited_character(spark, char):
    assert one(spark, text.has_prohibited_characters(F.lit(f"a{char}b"))) is True


def test_plain_text_is_allowed(spark):
    assert one(spark, text.has_prohibited_characters(F.lit("Runs (daily) - not Sundays!"))) is False


@pytest.mark.parametrize(
    "value, found",
    [
        ("from 2024-01-05", True),
        ("until 5/1/24", True),
        ("at 10:30", True),
        ("on Monday", True),
        ("1st 2nd", False),
        ("route 42 only", False),
        ("Market street", False),
        ("", False),
    ],
)
def test_contains_date(spark, value, found):
    assert one(spark, text.contains_date(F.lit(value))) is found


def test_names_and_types(spark):
    assert one(spark, text.base_name(F.lit("/a/b/c.xml"))) == "c.xml"
    assert one(spark, text.xml_name(F.lit("c"))) == "c.xml"
    assert one(spark, text.xml_name(F.lit("c.XML"))) == "c.XML"
    doc = F.lit('<?xml version="1.0"?><TransXChange SchemaVersion="2.4">')
    assert one(spark, text.document_type(doc)) == "TransXChange"
    assert one(spark, text.document_version(doc)) == "2.4"
    fares = F.lit('<PublicationDelivery xmlns="x" version="1.1">')
    assert one(spark, text.document_version(fares)) == "1.1"
    ids = F.array(F.lit("atco:0100123"), F.lit("atco:9x0"), F.lit("naptan:010"), F.lit("atco:0109"))
    assert one(spark, text.area_codes(ids)) == [10]


def test_sequence_key_keeps_order(spark):
    key = lambda *v, owner="f": one(spark, text.sequence_key(F.lit(owner), F.array(*[F.lit(x) for x in v])))
    assert key("a", "b") != key("b", "a")
    assert key("a", "b") != key("ab")
    assert key("a", "b") != key("a", "b", owner="g")
    assert len(key("a")) == 64


@pytest.mark.parametrize(
    ("text_value", "seconds"),
    [
        ("PT5M", 300), ("PT0S", 0), ("PT1H30M", 5400), ("PT1H1M1.5S", 3661.5), ("P1DT2H", 93600), ("P2D", 172800), ("-PT10S", -10),
        ("-P1DT1S", -86401), ("PT", 0), ("P", 0), ("", 0), ("5M", 0), ("P1Y", 0), ("P1YT5M", 0), ("PT5X", 0), ("PT1M2H", 60), ("PT10S5M", 10),
        ("P5M", 0), ("PT1.5H", 0), ("P1DX", 86400), ("P1DXT5M", 86400), ("PT3M tail", 180), (None, 0),
    ],
)
def test_durations_part_by_part(spark, text_value, seconds):
    assert one(spark, time.duration_seconds(F.lit(text_value).cast("string"))) == seconds


def vincenty(lon1, lat1, lon2, lat2):
    a, b = geo.WGS84_A, geo.WGS84_B
    f = (a - b) / a
    u1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    u2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    big = math.radians(lon2 - lon1)
    lam = big
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        ca2 = 1 - sa * sa
        c2 = c - 2 * math.sin(u1) * math.sin(u2) / ca2 if ca2 else 0
        cc = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
        new = big + (1 - cc) * f * sa * (sigma + cc * s * (c2 + cc * c * (2 * c2 * c2 - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    uu = ca2 * (a * a - b * b) / (b * b)
    aa = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
    bb = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
    ds = bb * s * (c2 + bb / 4 * (c * (2 * c2 * c2 - 1) - bb / 6 * c2 * (4 * s * s - 3) * (4 * c2 * c2 - 3)))
    return b * aa * (sigma - ds)


def test_segment_length_against_iteration(spark):
    rng = random.Random(7)
    cases = [(rng.uniform(-6, 2), rng.uniform(49, 60)) for _ in range(200)]
    data = [(x, y, x + rng.uniform(-0.3, 0.3), y + rng.uniform(-0.2, 0.2)) for x, y in cases]
    data += [(rng.uniform(-180, 180), rng.uniform(-85, 85), rng.uniform(-180, 180), rng.uniform(-60, 60)) for _ in range(100)]
    data = [d for d in data if abs(abs(d[0] - d[2]) - 180) > 5]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = df.select("a", "b", "c", "d", geo.segment_length(*[F.col(x) for x in "abcd"]).alias("m")).collect()
    for r in got:
        assert abs(r.m - vincenty(r.a, r.b, r.c, r.d)) <= 1e-4


def test_published_lines(spark):
    """Lines whose lengths are published, to a millimetre; opposite points by the meridian."""
    degrees = lambda d, m, s: (abs(d) + m / 60 + s / 3600) * (1 if d > 0 else -1)
    half = 20003931.4586
    lines = [
        ((-73.8, 40.6, -0.5, 51.6), 5551759.4003),
        ((degrees(144, 25, 29.52440), degrees(-37, 57, 3.72030), degrees(143, 55, 35.38390), degrees(-37, 39, 10.15610)), 54972.271),
        ((0.0, 0.0, 0.0, 90.0), half / 2),
        ((0.0, 0.0, 90.0, 0.0), 6378137.0 * math.pi / 2),
        ((10.0, 30.0, -170.0, -30.0), half),
        ((10.0, 0.0, -170.0, 0.0), half),
        ((10.0, 90.0, 50.0, -90.0), half),
        ((179.9, 10.0, -179.9, 10.0), None),
        ((5.0, 52.0, 5.0, 52.0), 0.0),
        ((7.0, 90.0, 99.0, 90.0), 0.0),
    ]
    df = spark.createDataFrame([(i, *x) for i, (x, _) in enumerate(lines)], "i int, a double, b double, c double, d double")
    got = {r.i: r.m for r in df.select("i", geo.segment_length(*[F.col(x) for x in "abcd"]).alias("m")).collect()}
    for i, (x, want) in enumerate(lines):
        assert abs(got[i] - (vincenty(-0.1, 10.0, 0.1, 10.0) if want is None else want)) < 1e-3, (x, got[i])
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert [r.m for r in odd.select(geo.segment_length(F.col("a"), F.col("b"), F.lit(0.0), F.lit(0.0)).alias("m")).collect()] == [None, None]


def test_haversine_known_value(spark):
    got = one(spark, geo.haversine(F.lit(-0.1278), F.lit(51.5074), F.lit(-2.2426), F.lit(53.4808)))
    assert abs(got - 262_000) < 1000


def test_grid_known_point(spark):
    # Published worked example: 651409.903, 313177.270 is 52.657570 N, 1.717922 E
    # on the national datum, about 52.65798 N, 1.71605 E on WGS84.
    got = one(spark, geo.grid_to_lonlat(F.lit(651409.903), F.lit(313177.270)))
    assert abs(got["lat"] - 52.65798) < 1e-4
    assert abs(got["lon"] - 1.71605) < 1e-4


def test_grid_round_trip(spark):
    rng = random.Random(3)
    data = [(rng.randrange(200000, 600000), rng.randrange(50000, 900000)) for _ in range(100)]
    df = spark.createDataFrame(data, "e int, n int").withColumn("p", geo.grid_to_lonlat(F.col("e"), F.col("n")))
    back = geo.lonlat_to_grid(F.col("p.lon"), F.col("p.lat"))
    for r in df.select("e", "n", back.alias("g")).collect():
        assert abs(r.g["easting"] - r.e) <= 1 and abs(r.g["northing"] - r.n) <= 1


def test_stop_location_prefers_degrees(spark):
    none = F.lit(None).cast("double")
    both = geo.stop_location(F.lit(-1.0), F.lit(52.0), F.lit(400000.0), F.lit(300000.0))
    assert one(spark, both["lon"]) == -1.0
    assert one(spark, geo.stop_location(none, none, F.lit(400000.0), F.lit(300000.0))["lat"]) > 52
    assert one(spark, geo.stop_location(none, none, none, none)) is None


def test_hausdorff(spark):
    def line(*points):
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])

    a, b = line((0, 0), (10, 0)), line((0, 3), (5, 3), (10, 3))
    assert one(spark, geo.hausdorff(a, b)) == pytest.approx(3)
    assert one(spark, geo.hausdorff(a, line((0, 0), (4, 0), (10, 0)))) == pytest.approx(0)
    assert one(spark, geo.hausdorff(a, line((0, 0), (10, 0), (10, 7)))) == pytest.approx(7)


def test_a_table_small_on_disk_alone_is_not_sent_out(spark):
    # 300,000 rows of the same long text take a few megabytes as files and 200 in memory.
    table = staged(spark.range(300_000).select(F.col("id").alias("file_id"), F.lit("stop " * 100).alias("text")))
    joined = table.join(table.withColumnRenamed("text", "other"), "file_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    release(table)
    assert "Join" in plan and "Broadcast" not in plan
