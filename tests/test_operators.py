import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import lifecycle as life
from headway.operators import patterns as pat
from headway.operators import resolve as res
from headway.operators import rollup
from headway.operators import sequence as seq
from headway.operators import tracks as trk
from headway.operators.components import connected_components, extended_components
from headway.operators.scan import scan
from headway.session import staged
from tests.conftest import rows

D = datetime.date
USE = "struct<stop_ref:string,seq_no:string,activity:string,timing_status:string,wait_time:string>"
LINKS = f"file_id string, section_id string, link_pos int, link_id string, route_link_ref string, run_time string, `from` {USE}, `to` {USE}"
JPS = "file_id string, jp_id string, ordinal int, service_code string, direction string, section_refs array<string>"
VJS = "file_id string, vj_code string, ordinal int, jp_ref string, vj_ref string, line_ref string, service_ref string, departure_time string"
VJ_LINKS = "file_id string, vj_code string, pos int, link_ref string, run_time string, from_wait string, to_wait string"


def use(stop, wait=None, seq_no=None, activity="pickUp", status="otherPoint"):
    return (stop, seq_no, activity, status, wait)


def link(section, pos, a, b, run="PT1M"):
    return ("f", section, pos, f"{section}{pos}", "r", run, a, b)


def times(spark, links, sections=("s",), start="10:00:00", overrides=(), blocked=False):
    out = seq.stop_times(
        spark.createDataFrame([("f", "v", 0, "j", None, None, None, start)], VJS),
        spark.createDataFrame([("f", "j", 0, "c", "inbound", list(sections))], JPS),
        spark.createDataFrame(links, LINKS),
        spark.createDataFrame([("f", "v", i, *o) for i, o in enumerate(overrides)], VJ_LINKS),
        blocked=blocked,
    )
    picked = out.orderBy("auto_sequence_number").select("atco_code", "departure_time", "auto_sequence_number", "sequence_number")
    return [tuple(r) for r in picked.collect()]


def test_blocked_steps_read_what_was_written_once(spark):
    """Blocked sums read their rows twice: these are staged, not joined out of the sections again."""
    links = [link("s", i, use(f"P{i}"), use(f"P{i + 1}")) for i in range(3)]
    out = seq.stop_times(
        spark.createDataFrame([("f", "v", 0, "j", None, None, None, "10:00:00")], VJS),
        spark.createDataFrame([("f", "j", 0, "c", "inbound", ["s"])], JPS),
        spark.createDataFrame(links, LINKS),
        spark.createDataFrame([], VJ_LINKS),
        blocked=True,
    )
    assert any("staged-" in f for f in out.inputFiles())
    assert [r.departure_time for r in out.orderBy("auto_sequence_number").collect()] == ["10:00:00", "10:01:00", "10:02:00", "10:03:00"]


def test_only_sequences_longer_than_a_block_are_cut(spark, monkeypatch):
    """Blocked scans write and shuffle their rows: those of short sequences are left out, their times are the same."""
    monkeypatch.setattr(seq, "BLOCK_LINKS", 4)
    written = []
    monkeypatch.setattr(seq, "staged", lambda df: written.append(staged(df)) or written[-1])
    links = [link(s, i, use(f"P{i}", "PT5S"), use(f"P{i + 1}")) for s, n in (("s", 3), ("l", 11)) for i in range(n)]
    journeys = [("f", f"v{j}{own}", 0, f"j{j}", None, None, None, "10:00:00") for j in "sl" for own in "ab"]
    args = (
        spark.createDataFrame(journeys, VJS),
        spark.createDataFrame([("f", f"j{s}", 0, "c", "inbound", [s]) for s in "sl"], JPS),
        spark.createDataFrame(links, LINKS),
        spark.createDataFrame([("f", f"v{s}b", 0, f"{s}1", "PT9M", None, None) for s in "sl"], VJ_LINKS),
    )
    got, want = (sorted(map(tuple, seq.stop_times(*args, blocked=b).collect())) for b in (True, False))
    assert got == want and len(got) == 2 * (4 + 12)
    rows = [t.groupBy("jp_id").count().collect() for t in written if "run" in t.columns]
    assert rows and {r.jp_id for found in rows for r in found} == {"jl"}


@pytest.mark.parametrize("blocked", [False, True])
class TestStopTimes:
    def test_one_section(self, spark, blocked):
        got = times(spark, [link("s", 0, use("A"), use("B")), link("s", 1, use("B"), use("C"), "PT2M")], blocked=blocked)
        assert got == [("A", "10:00:00", 0, 0), ("B", "10:01:00", 1, 1), ("C", "10:03:00", 2, 2)]

    def test_shared_boundary_counts_time_once(self, spark, blocked):
        links = [link("s", 0, use("A"), use("B")), link("t", 0, use("B", "PT30S"), use("C"))]
        got = times(spark, links, ("s", "t"), blocked=blocked)
        assert [g[:2] for g in got] == [("A", "10:00:00"), ("B", "10:01:00"), ("C", "10:02:30")]

    def test_loop_link_keeps_repeat(self, spark, blocked):
        links = [link("s", 0, use("A"), use("A")), link("s", 1, use("A"), use("B"))]
        assert [g[0] for g in times(spark, links, blocked=blocked)] == ["A", "A", "B"]

    def test_repeat_without_loop_is_dropped(self, spark, blocked):
        links = [link("s", 0, use("A"), use("B")), link("s", 1, use("A"), use("C"))]
        assert [g[0] for g in times(spark, links, blocked=blocked)] == ["A", "C"]

    def test_unknown_activity_on_first_stop(self, spark, blocked):
        # Nothing was emitted by the second link, so it still uses the first-stop rule.
        links = [link("s", 0, use("A", activity="x"), use("B")), link("s", 1, use("B", "PT10S"), use("C", "PT50S"))]
        assert [g[:3] for g in times(spark, links, blocked=blocked)] == [("B", "10:01:10", 0), ("C", "10:02:10", 1)]

    def test_waits(self, spark, blocked):
        links = [
            link("s", 0, use("A", "PT10S"), use("B", "PT20S")),
            link("s", 1, use("B", "PT30S"), use("C", "PT40S")),
            link("s", 2, use("C", "PT5S"), use("D", "PT0S")),
        ]
        got = [g[:2] for g in times(spark, links, blocked=blocked)]
        assert got == [("A", "10:00:10"), ("B", "10:01:50"), ("C", "10:02:55"), ("D", "10:03:55")]

    def test_override_without_run_time_is_zero(self, spark, blocked):
        links = [link("s", 0, use("A"), use("B")), link("s", 1, use("B"), use("C"))]
        got = times(spark, links, overrides=[("s0", None, "PT15S", None), ("s0", "PT9M", None, None)], blocked=blocked)
        assert [g[1] for g in got] == ["10:00:15", "10:00:15", "10:01:15"]

    def test_override_zero_wait_stops_fall_back(self, spark, blocked):
        links = [link("s", 0, use("A"), use("B")), link("s", 1, use("B", "PT40S"), use("C"))]
        got = times(spark, links, overrides=[("s1", "PT1M", "PT0S", None)], blocked=blocked)
        assert [g[1] for g in got] == ["10:00:00", "10:01:00", "10:02:00"]

    def test_midnight_and_bad_start(self, spark, blocked):
        links = [link("s", 0, use("A"), use("B"), "PT2H")]
        assert [g[1] for g in times(spark, links, start="23:00:00", blocked=blocked)] == ["23:00:00", "01:00:00"]
        assert [g[1] for g in times(spark, links, start="late", blocked=blocked)] == [None, None]

    def test_given_sequence_number(self, spark, blocked):
        links = [link("s", 0, use("A", seq_no="5"), use("B", seq_no=""))]
        assert [g[3] for g in times(spark, links, blocked=blocked)] == [5, 1]


def test_scan_forms_agree(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("pos"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("v")
    ).withColumn("b", F.floor(F.col("pos") / 64))
    args = dict(sums={"s": F.coalesce("v", F.lit(0))}, lasts={"l": F.col("v")})
    plain = scan(df, ["k"], ["pos"], **args)
    blocked = scan(df, ["k"], ["pos"], block=["b"], **args)
    assert plain.exceptAll(blocked).count() == 0 and plain.count() == blocked.count() == 5000


def test_one_hot_sequence_is_spread(spark):
    """One journey with most of the links: same times, many blocks."""
    n = 20000
    links = spark.range(n).select(
        F.lit("f").alias("file_id"), F.lit("s").alias("section_id"), F.col("id").cast("int").alias("link_pos"),
        F.concat(F.lit("l"), "id").alias("link_id"), F.lit("r").alias("route_link_ref"), F.lit("PT1S").alias("run_time"),
        *[F.struct(F.concat(F.lit("S"), F.col("id") + d).alias("stop_ref"), F.lit(None).cast("string").alias("seq_no"),
            F.lit("pass").alias("activity"), F.lit("x").alias("timing_status"), F.lit(None).cast("string").alias("wait_time")).alias(name)
          for name, d in (("from", 0), ("to", 1))])
    args = (spark.createDataFrame([("f", "v", 0, "j", None, None, None, "00:00:00")], VJS),
            spark.createDataFrame([("f", "j", 0, "c", "inbound", ["s"])], JPS), links,
            spark.createDataFrame([], VJ_LINKS))
    out = seq.stop_times(*args, blocked=True)
    wrong = out.where((F.col("departure_seconds") != F.col("auto_sequence_number") % 86400) | (F.concat(F.lit("S"), "auto_sequence_number") != F.col("atco_code")))
    assert out.count() == n + 1 and wrong.count() == 0


def test_placeholder_inside_sequence(spark):
    links = seq.pattern_links(
        spark.createDataFrame([("f", "j", 0, "c", "inbound", ["s", "t"])], JPS),
        spark.createDataFrame([link("s", 0, use("A"), use("X")), link("s", 1, use("X"), use("B")), link("t", 0, use("B"), use("C"))], LINKS),
    )
    missing = spark.createDataFrame([("f", "X")], "file_id string, stop_ref string")
    got = seq.stop_sequence(links, missing).orderBy("pos").select("pos", "stop_ref")
    assert [tuple(r) for r in got.collect()] == [(0, "A"), (1, "B"), (2, "C")]


FILES = "id int, revision_id int, service_code string, revision_number int, operating_period_start_date date"


@pytest.mark.parametrize(
    "files, kept",
    [
        ([(1, 1, "a", 2, D(2024, 1, 5)), (2, 1, "a", 1, D(2024, 1, 1))], {1, 2}),
        ([(1, 1, "a", 2, D(2024, 1, 5)), (2, 1, "a", 1, D(2024, 1, 5))], {1}),
        ([(1, 1, "a", 2, D(2024, 1, 5)), (2, 1, "a", 1, D(2024, 2, 5))], {1}),
        ([(1, 1, "a", 2, None), (2, 1, "a", 1, D(2024, 2, 5)), (3, 1, "a", 1, None)], {1, 2, 3}),
        ([(1, 1, "a", 2, D(2024, 1, 5)), (2, 1, "a", 1, None)], {1}),
        ([(1, 1, "a", 2, D(2024, 1, 1)), (2, 1, "a", 2, D(2024, 3, 1)), (3, 1, "a", 1, D(2024, 2, 1))], {1, 2, 3}),
        ([(1, 1, "a", 2, D(2024, 1, 1)), (2, 1, "b", 1, D(2024, 3, 1))], {1, 2}),
        ([(1, 10, "a", 1, D(2024, 1, 5)), (2, 20, "a", 5, D(2024, 1, 1))], {1, 2}),
        ([(1, 1, None, 2, D(2024, 1, 1)), (2, 1, None, 1, D(2024, 3, 1))], {1}),
        ([], set()),
    ],
)
def test_supersession(spark, files, kept):
    flagged = life.supersession(spark.createDataFrame(files, FILES))
    assert {r.id for r in flagged.where("not superseded").collect()} == kept
    assert flagged.count() == len(files)


def test_revision_moves_first_decisive_row(spark):
    schema = "id int, revision_id int, filename string, service_code string, line_names array<string>, revision_number int, modification_datetime timestamp, dataset_id int"
    t = datetime.datetime
    live = [(1, 9, "x", "a", ["1", "2"], 3, t(2024, 1, 1)), (2, 9, "y", "a", ["2", "1"], 5, t(2024, 2, 1))]
    draft = [
        (11, 1, "same", "a", ["2", "1"], 3, t(2024, 1, 1)),
        (12, 1, "moved", "a", ["1", "2"], 6, t(2024, 3, 1)),
        (13, 1, "stuck", "a", ["1", "2"], 3, t(2024, 3, 1)),
        (14, 1, "other lines", "a", ["1"], 1, t(2024, 3, 1)),
        (15, 1, "same time", "a", ["1", "2"], 9, t(2024, 2, 1)),
    ]
    own = [(*r, 7) for r in draft]
    got = life.revision_moves(spark.createDataFrame(own, schema), spark.createDataFrame([(*r, 7) for r in live], schema))
    assert {r.filename for r in got.collect()} == {"stuck", "same time"}
    other = life.revision_moves(spark.createDataFrame(own, schema), spark.createDataFrame([(*r, 8) for r in live], schema))
    assert other.count() == 0


def test_pattern_dedup_and_majority(spark):
    jps = spark.createDataFrame(
        [("f", "j1", 0, "c1", "inbound", ["s"]), ("f", "j2", 1, "c2", "outbound", ["s"]), ("f", "j3", 2, "c2", "outbound", ["t"]), ("g", "j1", 0, "c9", "inbound", ["s"])], JPS)
    links = spark.createDataFrame([link("s", 0, use("A"), use("B")), link("t", 0, use("B"), use("A")), ("g", *link("s", 0, use("A"), use("B"))[1:])], LINKS)
    bridge = pat.service_pattern_bridge(jps, seq.stop_sequence(seq.pattern_links(jps, links)))
    by = {(r.file_id, r.jp_id): r.service_pattern_id for r in bridge.collect()}
    assert by["f", "j1"] == by["f", "j2"] != by["f", "j3"]
    assert by["f", "j1"].startswith("c1-") and by["g", "j1"].startswith("c9-")
    # One vote each: the direction met first wins.
    direction = {r.service_pattern_id: r.direction for r in pat.pattern_direction(bridge, jps).where("file_id = 'f'").collect()}
    assert direction[by["f", "j1"]] == "inbound"


def test_journey_resolution(spark):
    vjs = spark.createDataFrame(
        [("f", c, i, jp, vj, None, None, None) for i, (c, jp, vj) in enumerate(
            [("a", "j", None), ("b", None, "a"), ("c", None, "b"), ("d", "nope", None), ("e", None, "e"), ("g", None, "h"), ("h", None, "g"), ("i", None, "lost")])], VJS)
    bridge = spark.createDataFrame([("f", "j", "SP")], "file_id string, jp_id string, service_pattern_id string")
    got = {r.vj_code: r.how for r in res.journey_pattern_of(vjs, bridge).collect()}
    assert got == {"a": "direct", "b": "hop", "c": "unresolved", "d": "unresolved", "e": "unresolved", "g": "unresolved", "h": "unresolved", "i": "unresolved"}
    chain = {r.vj_code: r.jp_ref for r in res.journey_reference_chain(vjs).collect()}
    assert chain == {"a": "j", "b": "j", "c": "j", "d": "nope", "e": None, "g": None, "h": None, "i": None}


def test_long_reference_chain(spark):
    n = 300
    vjs = spark.createDataFrame([("f", f"v{i}", i, "j" if i == 0 else None, None if i == 0 else f"v{i - 1}", None, None, None) for i in range(n)], VJS)
    assert res.journey_reference_chain(vjs).where("jp_ref = 'j'").count() == n


PROFILE = (
    "file_id string, owner_kind string, owner_id string, owner_pos int, "
    "days struct<monday:boolean,tuesday:boolean,wednesday:boolean,thursday:boolean,friday:boolean,saturday:boolean,sunday:boolean,holidays_only:boolean>, "
    "special_operation array<struct<start:date,end:date>>, special_non_operation array<struct<start:date,end:date>>, "
    "bank_operation array<string>, bank_non_operation array<string>, "
    "so_operation array<struct<working_days:array<string>,holidays:array<string>>>, so_non_operation array<struct<working_days:array<string>,holidays:array<string>>>"
)
WEEKDAYS = (True,) * 5 + (False,) * 3


def profile(kind="journey", owner="v", pos=0, days=WEEKDAYS, on=(), off=(), bank_on=(), bank_off=(), so_on=(), so_off=()):
    return ("f", kind, owner, pos, days, list(on), list(off), list(bank_on), list(bank_off), list(so_on), list(so_off))


def exceptions(spark, *profiles, end=None):
    vjs = spark.createDataFrame([("f", "v")], "file_id string, vj_code string")
    eff = res.effective_profiles(vjs, spark.createDataFrame(list(profiles), PROFILE))
    services = spark.createDataFrame([("f", "c", 0, D(2024, 1, 1), end)], "file_id string, service_code string, service_pos int, start_date date, end_date date")
    holidays = spark.createDataFrame(
        [("Xmas", D(2024, 12, 25), "england-and-wales"), ("Xmas", D(2023, 12, 25), "england-and-wales"), ("Xmas", D(2022, 12, 24), "england-and-wales"), ("Fair", D(2024, 6, 1), "scotland")],
        "txc_element string, date date, division string")
    return rows(cal.exceptions(eff, services, holidays), "date", "operates")


class TestCalendar:
    def test_special_days_against_weekdays(self, spark):
        # Friday to Monday: only the weekend is extra, only weekdays are lost.
        span = (D(2024, 3, 1), D(2024, 3, 4))
        assert exceptions(spark, profile(on=[span])) == [(D(2024, 3, 2), True), (D(2024, 3, 3), True)]
        assert exceptions(spark, profile(off=[span])) == [(D(2024, 3, 1), False), (D(2024, 3, 4), False)]

    def test_reversed_range(self, spark):
        assert exceptions(spark, profile(on=[(D(2024, 3, 4), D(2024, 3, 1))])) == []

    def test_bank_holidays_in_period(self, spark):
        assert exceptions(spark, profile(bank_off=["Xmas"])) == [(D(2024, 12, 25), False)]
        assert exceptions(spark, profile(bank_off=["Xmas"]), end=D(2024, 6, 1)) == []
        assert exceptions(spark, profile(bank_on=["Fair", "Other"])) == [(D(2024, 6, 1), True)]

    def test_one_date_from_both_sources(self, spark):
        day = D(2024, 12, 25)
        assert exceptions(spark, profile(off=[(day, day)], bank_off=["Xmas"])) == [(day, False)]

    def test_days_of_a_journey_are_united_once(self, spark):
        span = (D(2024, 3, 1), D(2024, 3, 4))
        other = (False,) * 5 + (True,) * 2 + (False,)
        found = exceptions(spark, profile(on=[span]), profile(days=other, on=[span]))
        assert found == [(D(2024, 3, day), True) for day in (1, 2, 3, 4)]
        eff = res.effective_profiles(spark.createDataFrame([("f", "v")], "file_id string, vj_code string"), spark.createDataFrame([profile(on=[span])], PROFILE))
        services = spark.createDataFrame([("f", "c", 0, D(2024, 1, 1), None)], "file_id string, service_code string, service_pos int, start_date date, end_date date")
        holidays = spark.createDataFrame([("Xmas", D(2024, 12, 25), "scotland")], "txc_element string, date date, division string")
        plan = cal.exceptions(eff, services, holidays)._jdf.queryExecution().optimizedPlan().toString()
        # No second aggregate over single dates, which are many times the words.
        assert not re.search(r"Aggregate \[[^\]]*date#", plan)

    def test_profile_of_first_service(self, spark):
        span = (D(2024, 3, 2), D(2024, 3, 2))
        got = exceptions(spark, profile("service", "s2", 1), profile("service", "s1", 0, on=[span]))
        assert got == [(D(2024, 3, 2), True)]

    def test_operating_days(self, spark):
        j = spark.createDataFrame([("f", "v", WEEKDAYS, D(2024, 3, 1), D(2024, 3, 8))], f"file_id string, vj_code string, {PROFILE.split(', ', 4)[4].split(', special')[0]}, start_date date, end_date date")
        ex = spark.createDataFrame([("f", "v", D(2024, 3, 2), True), ("f", "v", D(2024, 3, 4), False)], "file_id string, vj_code string, date date, operates boolean")
        got = [r.date.day for r in cal.operating_days(j, ex, F.lit("2024-12-31").cast("date")).orderBy("date").collect()]
        assert got == [1, 2, 5, 6, 7, 8]

    def test_organisation_flags(self, spark):
        vjs = spark.createDataFrame([("f", "v")], "file_id string, vj_code string")
        p = profile(so_on=[(["A"], ["B"])], so_off=[(["C"], ["A", "?"])])
        eff = res.effective_profiles(vjs, spark.createDataFrame([p], PROFILE))
        orgs = spark.createDataFrame([("f", c, [(D(2024, 1, 1), D(2024, 1, 2))]) for c in "ABC"], "file_id string, code string, working_days array<struct<start:date,end:date>>")
        links = res.serviced_organisation_journeys(eff, orgs)
        assert rows(links, "code", "operating_on_working_days") == [("A", True), ("A", True), ("B", False), ("C", False)]
        assert res.organisation_working_days(links, orgs).count() == 4


@pytest.mark.parametrize(
    "pairs, groups",
    [
        ([(1, 2), (2, 3), (4, 5)], {1: {1, 2, 3}, 4: {4, 5}}),
        ([], {}),
        ([(7, 7)], {}),
        ([(3, 1), (1, 3), (3, 2)], {1: {1, 2, 3}}),
    ],
)
def test_components(spark, pairs, groups):
    got = {}
    for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect():
        got.setdefault(r.component, set()).add(r.id)
    assert got == groups


def test_components_long_chain_and_hub(spark):
    chain = spark.range(1, 400).select(((F.col("id") * 7919) % 400).alias("src"), (((F.col("id") - 1) * 7919) % 400).alias("dst"))
    hub = spark.range(1000, 4000).select(F.col("id").alias("src"), F.lit(999).cast("long").alias("dst"))
    got = connected_components(chain.unionByName(hub)).groupBy("component").count()
    assert rows(got) == [(0, 400), (999, 3001)]


TRACKS = "id long, from_atco_code string, to_atco_code string, points array<struct<lon:double,lat:double>>, distance int, coord_distance int"


def track(i, *points, pair=("A", "B")):
    return (i, *pair, [(float(x), float(y)) for x, y in points], None, None)


def test_similar_tracks_around_threshold(spark):
    metre = 1 / trk.DEGREE
    base = [(-1.0, 52.0), (-1.0, 52.01)]

    def moved(d):
        return [(x, y + d * metre) for x, y in base]

    data = [track(1, *base), track(2, *moved(19.9)), track(3, *moved(40.2)), track(4, *base), track(5, *base, pair=("A", "C")),
            track(6, base[0], (-1.0, 52.005), base[1])]
    got = rows(trk.similar_tracks(spark.createDataFrame(data, TRACKS)), "track_a", "track_b")
    # 4 is a copy of 1; 6 has the same shape with one more vertex; 2 and 3 are 20.3 m apart.
    assert got == [(1, 2), (1, 4), (1, 6), (2, 6)]


def test_similar_tracks_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    data = [track(i, *[(-2 + rng.uniform(0, 0.0008), 53 + rng.uniform(0, 0.0005)) for _ in range(3)]) for i in range(120)]
    df = spark.createDataFrame(data, TRACKS)
    got = set(rows(trk.similar_tracks(df, 30.0), "track_a", "track_b"))

    def planar(points, o):
        import math

        return [((x - o[0]) * trk.DEGREE * math.cos(math.radians(o[1])), (y - o[1]) * trk.DEGREE) for x, y in points]

    def reach(a, b):
        def seg(p, s, t):
            dx, dy = t[0] - s[0], t[1] - s[1]
            u = max(0, min(1, ((p[0] - s[0]) * dx + (p[1] - s[1]) * dy) / (dx * dx + dy * dy)))
            return ((p[0] - s[0] - u * dx) ** 2 + (p[1] - s[1] - u * dy) ** 2) ** 0.5

        return max(min(seg(p, s, t) for s, t in zip(b, b[1:])) for p in a)

    want = set()
    for i, a in enumerate(data):
        o = (min(p[0] for p in a[3]), min(p[1] for p in a[3]))
        for b in data[i + 1 :]:
            pa, pb = planar(a[3], o), planar(b[3], o)
            if max(reach(pa, pb), reach(pb, pa)) < 30:
                want.add((a[0], b[0]))
    assert got == want and want


def test_consolidation(spark):
    base = [(-1.0, 52.0), (-1.0, 52.01)]
    tracks = spark.createDataFrame([track(3, *base), track(1, *base), track(9, *base, pair=("X", "Y"))], TRACKS)
    refs = spark.createDataFrame([("p", 0, 3), ("q", 0, 9)], "service_pattern_id string, sequence_number int, tracks_id long")
    kept, moved, report = trk.consolidate(tracks, refs)
    assert rows(kept, "id") == [(1,), (9,)]
    assert rows(moved) == [("p", 0, 1), ("q", 0, 9)]
    assert rows(report) == [("references_moved", 1), ("tracks_deleted", 1)]


def test_insert_tracks_twice_adds_nothing(spark):
    incoming = spark.createDataFrame([track(0, (-1, 52), (-1.1, 52))], TRACKS)
    empty = spark.createDataFrame([], TRACKS)
    once = trk.insert_tracks(empty, incoming)
    assert once.count() == 1 and trk.insert_tracks(once, incoming).count() == 1


def test_geometry_snaps(spark):
    tracks = spark.createDataFrame([track(1, (0, 50), (0, 50.1)), track(2, (0.5, 50.1), (0, 50.2), pair=("B", "C"))], TRACKS)
    pairs = spark.createDataFrame([("f", "j", 0, "A", "B"), ("f", "j", 1, "B", "C")], "file_id string, jp_id string, sequence_number int, from_stop string, to_stop string")
    always = trk.pattern_geometry(pairs, tracks).first()["points"]
    assert [(p.lon, p.lat) for p in always] == [(0, 50), (0, 50.1), (0, 50.2)]
    near = trk.pattern_geometry(pairs, tracks, tolerance=15.0).first()["points"]
    assert len(near) == 4


def test_fares_revision_counts_types_once(spark):
    schema = ("revision_id int, file_id int, schema_version string, num_of_lines int, num_of_fare_zones int, num_of_sales_offer_packages int, "
              "num_of_fare_products int, user_types array<string>, product_types array<string>, valid_from timestamp, valid_to timestamp")
    files = [(1, 1, None, 2, 1, 1, 3, ["adult"], ["dayPass", "singleTrip"], None, None), (1, 2, None, 3, 0, 1, 1, ["adult", "child"], ["dayPass"], None, None)]
    r = rollup.fares_revision(spark.createDataFrame(files, schema)).first()
    assert (r.num_of_lines, r.num_of_fare_products, r.num_of_user_profiles, r.num_of_pass_products, r.num_of_trip_products, r.schema_version) == (5, 4, 2, 1, 1, "1.1")


def test_revision_status(spark):
    status = spark.createDataFrame([(1, "succeeded"), (1, "failed"), (2, "failed"), (3, "succeeded")], "revision_id int, status string")
    repack = spark.createDataFrame([(3, "failed")], "revision_id int, status string")
    got = {r.revision_id: (r.status, r.error_code) for r in life.revision_status(status, repack).collect()}
    assert got == {1: ("success", None), 2: ("error", "NO_VALID_FILE_TO_PROCESS"), 3: ("error", "SYSTEM_ERROR")}


def test_open_ended_service_runs_to_the_horizon(spark):
    days = PROFILE.split(', ', 4)[4].split(', special')[0]
    j = spark.createDataFrame([("f", "v", WEEKDAYS, D(2024, 3, 1), None)], f"file_id string, vj_code string, {days}, start_date date, end_date date")
    none = spark.createDataFrame([], "file_id string, vj_code string, date date, operates boolean")
    got = [r.date for r in cal.operating_days(j, none, F.lit("2024-03-08").cast("date")).orderBy("date").collect()]
    assert got == [D(2024, 3, d) for d in (1, 4, 5, 6, 7, 8)]


def test_one_track_per_pair(spark):
    short, long = [(0, 50), (0, 50.05), (0, 50.1)], [(0, 50), (0.1, 50.05), (0, 50.1)]
    stored = spark.createDataFrame([track(1, *short), track(2, *long)], TRACKS).withColumns(
        {"distance": F.col("id").cast("int") * 10 + 90, "coord_distance": F.col("id").cast("int")}
    )
    pairs = spark.createDataFrame([("f", "j", 0, "A", "B")], "file_id string, jp_id string, sequence_number int, from_stop string, to_stop string")
    stops = spark.createDataFrame([("A", 0.0, 50.0), ("B", 0.0, 50.1)], "atco_code string, lon double, lat double")
    assert trk.pattern_distance(pairs, stored, stops).first()["distance"] == 110
    assert [tuple(p) for p in trk.pattern_geometry(pairs, stored).first()["points"]] == long
    assert rows(seq.track_sequence(pairs, stored), "tracks_id") == [(2,)]
    assert trk.insert_tracks(spark.createDataFrame([], TRACKS), spark.createDataFrame([track(1, *short), track(2, *long)], TRACKS)).count() == 1


def test_pattern_ids_differ_between_files(spark):
    jps = spark.createDataFrame([(f, "j1", 0, "c1", "inbound", ["s"]) for f in ("f", "g")], JPS)
    links = spark.createDataFrame([(f, *link("s", 0, use("A"), use("B"))[1:]) for f in ("f", "g")], LINKS)
    bridge = pat.service_pattern_bridge(jps, seq.stop_sequence(seq.pattern_links(jps, links)))
    assert bridge.select("service_pattern_id").distinct().count() == 2


def test_ties_are_settled(spark):
    old = spark.createDataFrame([("a", 1, "stored")], "k string, v int, t string")
    new = spark.createDataFrame([("b", 2, "x"), ("b", 2, "y"), ("a", 0, "m"), ("a", 0, "n")], "k string, v int, t string")
    assert rows(rollup.insert_or_update(old, new, ["k"], "v")) == [("a", 0, "n"), ("b", 2, "y")]
    assert rows(rollup.insert_or_ignore(old, new, ["k"])) == [("a", 1, "stored"), ("b", 2, "x")]


def test_batches_without_one_order(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k int, n int")
    got = life.batches(df, "n", ["k"], 60).collect()
    sizes, order = {}, []
    for r in got:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
        order.append((r.batch_id, -r.n))
    assert sizes == {b: 60 if b < 8 else 20 for b in range(9)}
    highest = {b: min(n for c, n in order if c == b) for b in sizes}
    lowest = {b: max(n for c, n in order if c == b) for b in sizes}
    assert all(lowest[b] <= highest[b + 1] for b in range(8))
    assert life.batches(df.limit(0), "n", ["k"], 60).count() == 0


def test_components_grow_by_new_edges(spark):
    """A second night's edges on the first night's labels equal the whole."""
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    frame = lambda e: spark.createDataFrame(e, "src long, dst long")
    for cut in (0, 60, 150):
        labels = connected_components(frame(edges[:cut]))
        grown = extended_components(labels, frame(edges[cut:]))
        assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, connected_components(frame(edges)).collect()))


def test_new_tracks_are_compared_alone(spark):
    rng = random.Random(8)
    lines = [[(-1 + rng.randrange(4) * 1e-4, 52 + rng.randrange(4) * 1e-4) for _ in range(2)] for _ in range(12)]
    data = [(i, "A", f"B{i % 2}", rng.choice(lines)) for i in range(60)]
    tracks = spark.createDataFrame(data, "id long, from_atco_code string, to_atco_code string, points array<struct<lon:double,lat:double>>")
    whole = trk.canonical_tracks(trk.similar_tracks(tracks))
    for share in (1, 2, 5):
        new = tracks.where(F.col("id") % share == 0).select("id")
        first = trk.canonical_tracks(trk.similar_tracks(tracks.join(new, "id", "left_anti")))
        added = trk.similar_tracks(tracks, new=new)
        ids = {r.id for r in new.collect()}
        grown = trk.extended_canonical(first, added)
        assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, whole.collect()))
        fresh = {tuple(lines_) for i, _, _, lines_ in data if i in ids}
        assert all(r.track_a in ids or r.track_b in ids or tuple(map(tuple, data[r.track_a][3])) in fresh for r in added.collect())


def test_crowded_cells_are_dealt_out(spark, monkeypatch):
    """All lines of one cell: pairs are compared by many tasks, and none is lost."""
    rng = random.Random(11)
    data = [track(i, *[(-1 + rng.uniform(0, 4e-4), 52 + rng.uniform(0, 2e-4)) for _ in range(rng.randrange(2, 12))]) for i in range(150)]
    df = spark.createDataFrame(data, TRACKS).cache()
    whole = rows(trk.similar_tracks(df), "track_a", "track_b")
    monkeypatch.setattr(trk, "PAIRS_AT_ONCE", 200)
    dealt = trk.similar_tracks(df)
    assert rows(dealt, "track_a", "track_b") == whole and whole
    assert dealt.where("distance > 0").select(F.spark_partition_id()).distinct().count() > 20


def test_batched_distance_is_the_column_expression(spark):
    import numpy as np

    from headway.functions.geo import hausdorff, planar
    from headway.operators.nearness import hausdorff_of

    rng = random.Random(4)

    def line():
        points = [(-1 + rng.uniform(0, 4e-3), 52 + rng.uniform(0, 4e-3)) for _ in range(rng.choice([0, 1, 2, 3, 7, 9, 20, 33]))]
        return [(None, y) if rng.random() < 0.03 else (x, y) for x, y in points]

    kind = "array<struct<lon:double,lat:double>>"
    pairs = spark.createDataFrame([(i, line(), line()) for i in range(400)], f"i int, a {kind}, b {kind}")
    lat0, lon0 = F.lit(52.0), F.lit(-1.0)
    plain = pairs.withColumn("d", hausdorff(planar(F.col("a"), lat0, lon0), planar(F.col("b"), lat0, lon0))).withColumn("c", F.cos(F.radians(lat0)))
    table = plain.orderBy("i").toArrow().combine_chunks()
    n = len(table)
    got = hausdorff_of(table["a"].combine_chunks(), table["b"].combine_chunks(), np.full(n, -1.0), np.full(n, 52.0), table["c"].to_numpy())
    want = np.array([np.nan if d is None else d for d in table["d"].to_pylist()])
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_forest_keeps_components(spark):
    from headway.operators.nearness import forest

    rng = random.Random(6)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(350)]
    df = spark.createDataFrame(edges + edges[::-1] * 20, "src long, dst long")
    fewer = forest(df)
    assert fewer.count() < 8 * 600
    assert rows(connected_components(fewer)) == rows(connected_components(df))


def test_days_as_bitmaps(spark):
    """Words of ranges, weekdays and back, around the epoch and over word borders."""
    rng = random.Random(5)
    day = lambda n: datetime.date(1970, 1, 1) + datetime.timedelta(n)
    cases = []
    for _ in range(200):
        a = rng.randrange(-300, 20000)
        cases.append((day(a), day(a + rng.randrange(-3, 200)), *[rng.random() < 0.4 for _ in range(7)]))
    flags = ", ".join(f"{n}:boolean" for n in cal.WEEKDAYS)
    frame = spark.createDataFrame([(i, a, b, tuple(f)) for i, (a, b, *f) in enumerate(cases)], f"i int, a date, b date, days struct<{flags}>")
    words = frame.select("i", "days", F.inline(cal.words_between(F.col("a"), F.col("b"))))
    regular = F.col("bits").bitwiseAND(cal.regular_word(F.col("days"), F.col("word")))
    got = {}
    for r in words.select("i", F.explode(cal.days_in(F.col("word"), regular)).alias("d")).collect():
        got.setdefault(r.i, []).append(r.d)
    for i, (a, b, *f) in enumerate(cases):
        want = [a + datetime.timedelta(n) for n in range((b - a).days + 1)]
        assert sorted(got.get(i, [])) == [d for d in want if f[d.weekday()]]
    bits = frame.select(F.size(cal.days_in(cal.word_of(F.col("a")), cal.bit_of(F.col("a")))).alias("n"), (cal.days_in(cal.word_of(F.col("a")), cal.bit_of(F.col("a")))[0] == F.col("a")).alias("same"))
    assert {tuple(r) for r in bits.collect()} == {(1, True)}


def test_service_pattern_bridge_reads_each_sequence_once(spark):
    jps = spark.createDataFrame(
        [("F1", "J1", 2, "B"), ("F1", "J2", 1, "A"), ("F1", "J3", 3, "C"), (None, "J4", 4, "D")], "file_id string, jp_id string, ordinal int, service_code string"
    )
    stops = spark.createDataFrame(
        [("F1", j, i, s) for j in ("J1", "J2") for i, s in enumerate("xy")], "file_id string, jp_id string, pos int, stop_ref string"
    )
    bridge = pat.service_pattern_bridge(jps, stops)
    got = {r.jp_id: (r.service_pattern_id[:2], r.num_stops) for r in bridge.collect()}
    assert got == {"J1": ("A-", 2), "J2": ("A-", 2), "J3": ("C-", 0)}
    assert bridge._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 1
