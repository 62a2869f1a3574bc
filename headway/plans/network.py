"""Timetable sections read out of the driver's order tables.

An order is a journey pattern with up to two sections, a line item a timing
link, an order also a vehicle journey, a hundred orders a file, a part a stop.
``NETWORK_SQL`` is the same reading in SQL, for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.time import clock
from headway.plans.registry import Tables

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def _file(order_key: str):
    return F.concat(F.lit("F"), F.floor(F.col(order_key) / 100))


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def link_rows(t: Tables) -> DataFrame:
    """One row per line item with its place as a timing link, a file's rows together."""
    half = F.when(F.col("l_linenumber") <= 3, "A").otherwise("B")
    section = Window.partitionBy("file_id", "l_orderkey", "half")
    in_order = section.orderBy(*LINE_ORDER)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(in_order) - 1
    rows = t.lineitem.withColumn("file_id", _file("l_orderkey")).repartition("file_id").withColumn("half", half).withColumns(
        {
            "link_pos": place,
            "links": F.count(F.lit(1)).over(whole),
            "first_supplier": F.first("l_suppkey").over(whole),
        }
    )
    section_id = _text("S", F.col("l_orderkey"), "-", F.col("half"))
    return rows.withColumns(
        {
            "section_id": section_id,
            "link_id": _text(section_id, "-", F.col("link_pos")),
            "is_last": F.col("link_pos") == F.col("links") - 1,
        }
    )


def timing_links(t: Tables) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    number = F.col("l_linenumber")
    status = F.when(F.col("l_quantity") > 25, "principalTimingPoint").otherwise("otherPoint")
    board = F.when(part % 13 == 0, "unknown").when(supp % 3 == 0, "pickUp").when(
        supp % 3 == 1, "setDown"
    ).otherwise("pickUpAndSetDown")
    alight = F.when(supp % 13 != 0, "pass")
    return link_rows(t).select(
        "file_id",
        "section_id",
        "link_pos",
        "link_id",
        _text("RL", part % 200).alias("route_link_ref"),
        _text("PT", F.col("l_quantity").cast("int"), "M").alias("run_time"),
        F.struct(
            _text("ST", supp % 11).alias("stop_ref"),
            F.when(number % 2 == 0, (number * 10).cast("string")).alias("seq_no"),
            board.alias("activity"),
            status.alias("timing_status"),
            F.when(F.col("l_linestatus") == "F", _text("PT", number * 10, "S"))
            .when(F.col("l_quantity") > 40, F.lit("PT0S"))
            .alias("wait_time"),
        ).alias("from"),
        F.struct(
            _text("ST", part % 11).alias("stop_ref"),
            F.lit(None).cast("string").alias("seq_no"),
            alight.alias("activity"),
            status.alias("timing_status"),
            F.when(F.col("l_returnflag") == "A", "PT0S")
            .when(F.col("l_returnflag") == "R", "PT1M")
            .alias("wait_time"),
        ).alias("to"),
        "is_last",
        _text("ST", F.col("first_supplier") % 11).alias("section_first_stop"),
    )


def journey_patterns(t: Tables) -> DataFrame:
    """One per order that has lines; its sections in order."""
    number = F.col("l_linenumber")
    first, second = [F.when(F.bool_or(c), _text("S", F.col("l_orderkey"), h)) for c, h in
                     ((F.coalesce(number <= 3, F.lit(False)), "-A"), (F.coalesce(number > 3, F.lit(True)), "-B"))]
    rows = t.lineitem.select(_file("l_orderkey").alias("file_id"), "l_orderkey", "l_linenumber").repartition("file_id")
    refs = rows.groupBy("file_id", "l_orderkey").agg(F.array_compact(F.array(first, second)).alias("section_refs"))
    orders = t.orders.withColumns({"file_id": _file("o_orderkey"), "l_orderkey": F.col("o_orderkey")})
    return orders.join(refs, ["file_id", "l_orderkey"]).select(
        "file_id",
        _text("JP", F.col("o_orderkey")).alias("jp_id"),
        F.col("o_orderkey").alias("ordinal"),
        _text("SV", F.col("o_custkey") % 3).alias("service_code"),
        F.when(F.col("o_orderstatus") == "F", "inbound")
        .when(F.col("o_orderstatus") == "O", "outbound")
        .otherwise("clockwise")
        .alias("direction"),
        "section_refs",
    )


def vehicle_journeys(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    hop = key % 5 == 0
    return t.orders.select(
        _file("o_orderkey").alias("file_id"),
        _text("VJ", key).alias("vj_code"),
        key.alias("ordinal"),
        F.when(~hop, _text("JP", key)).alias("jp_ref"),
        F.when(hop, _text("VJ", key - F.when(key % 10 == 0, 5).otherwise(1))).alias("vj_ref"),
        _text("L", F.col("o_custkey") % 4).alias("line_ref"),
        _text("SV", F.col("o_custkey") % 3).alias("service_ref"),
        F.when(key % 50 == 7, "late").otherwise(clock(key * 997 % 86400)).alias("departure_time"),
        F.when(key % 3 == 0, (key % 2).cast("int")).alias("departure_day_shift"),
        F.when(key % 4 == 0, _text("B", key % 20)).alias("block"),
        F.when(key % 7 != 0, _text("J", key % 1000)).alias("journey_code"),
    )


def vj_links(t: Tables) -> DataFrame:
    rows = link_rows(t).where("l_tax > 0.05")
    return rows.select(
        "file_id",
        _text("VJ", F.col("l_orderkey")).alias("vj_code"),
        F.col("link_pos").alias("pos"),
        F.col("link_id").alias("link_ref"),
        F.when(F.col("l_discount") > 0.02, _text("PT", F.col("l_quantity").cast("int"), "M30S")).alias("run_time"),
        F.when(F.col("l_partkey") % 3 == 0, "PT0S").when(F.col("l_partkey") % 3 == 1, "PT45S").alias("from_wait"),
        F.when(F.col("l_suppkey") % 4 == 0, "PT2M").when(F.col("l_suppkey") % 4 == 1, "PT0S").alias("to_wait"),
    )


def stops(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        _text("ST", key).alias("atco_code"),
        key.alias("id"),
        _text("N", F.floor(key / 2)).alias("naptan_code"),
        F.concat_ws(" ", "p_name", key.cast("string")).alias("common_name"),
        ((key % 600) / 100.0 - 5).alias("lon"),
        ((key % 500) / 100.0 + 50).alias("lat"),
        F.when(key % 4 != 0, _text("E", key % 40)).alias("locality_id"),
        F.when(key % 6 != 0, (key % 9).cast("int")).alias("admin_area_id"),
        F.array(_text("G", key % 25), _text("G", key % 7)).alias("stop_areas"),
        F.when(key % 2 == 0, key.cast("string")).otherwise(_text("X", key)).alias("private_code"),
        F.col("p_type").alias("stop_type"),
    )


def supplier_pairs(t: Tables) -> DataFrame:
    """Stop code pairs the suppliers stand for, each with its lowest supplier."""
    key = F.col("s_suppkey")
    return t.supplier.groupBy((key % 11).alias("a"), (F.floor(key / 11) % 11).alias("b")).agg(
        F.min(key).alias("id")
    )


def placeholder_stops(t: Tables) -> DataFrame:
    """Stop ST7 counts as unknown to the register, in every file that has links."""
    files = t.lineitem.select(_file("l_orderkey").alias("file_id")).distinct()
    return files.withColumn("stop_ref", F.lit("ST7"))


NETWORK_SQL = """
raw AS (
  SELECT *, l_orderkey // 100 AS f, CASE WHEN l_linenumber <= 3 THEN 0 ELSE 1 END AS half,
         'ST' || (l_suppkey % 11) AS from_stop, 'ST' || (l_partkey % 11) AS to_stop
  FROM lineitem),
placed AS (
  SELECT *, half - min(half) OVER (PARTITION BY l_orderkey) AS section_pos,
         row_number() OVER (PARTITION BY l_orderkey, half
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS link_pos,
         count(*) OVER (PARTITION BY l_orderkey, half) AS links
  FROM raw),
links AS (
  SELECT *, 'F' || f AS file_id, 'JP' || l_orderkey AS jp_id,
         link_pos = links - 1 AS is_last
  FROM placed)
"""

# Stops met by each pattern: boundary repeats and placeholder ST7 left out.
STOP_SEQUENCE_SQL = (
    "WITH "
    + NETWORK_SQL
    + """,
uses AS (
  SELECT file_id, jp_id, l_orderkey, section_pos, link_pos, 0 AS e, from_stop AS stop_ref FROM links
  UNION ALL
  SELECT file_id, jp_id, l_orderkey, section_pos, link_pos, 1, to_stop FROM links WHERE is_last),
marked AS (
  SELECT *, first_value(stop_ref) OVER (PARTITION BY jp_id, section_pos ORDER BY link_pos, e) AS head FROM uses),
lagged AS (
  SELECT *, lag(stop_ref) OVER (PARTITION BY jp_id ORDER BY section_pos, link_pos, e) AS prev
  FROM marked WHERE stop_ref <> 'ST7'),
seq AS (
  SELECT file_id, jp_id, l_orderkey,
         row_number() OVER (PARTITION BY jp_id ORDER BY section_pos, link_pos, e) - 1 AS pos, stop_ref
  FROM lagged
  WHERE NOT coalesce(section_pos > 0 AND stop_ref = head AND stop_ref = prev, false))
"""
)
