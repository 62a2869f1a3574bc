"""Registered queries over XML documents derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import rollup
from headway.plans import xml_parts
from headway.plans.fares_job import process_fares
from headway.plans.registry import Tables, query
from headway.plans.xml_orders import timetable_documents, violations_sql
from headway.plans.xml_parts import fares_documents
from headway.rules.fares import fares_violations
from headway.rules.timetable import timetable_violations
from headway.session import staged
from headway.sources import fares as far
from headway.sources import timetables as src
from headway.sources.admission import REQUIRED, admit, admit_sections
from headway.sources.documents import parse_fares, parse_timetables, safety_violations, unreadable_files


def _docs(t: Tables, section: str | None = None) -> DataFrame:
    """The documents, or what one section function reads of them."""
    return parse_timetables(timetable_documents(t), fields=src.FIELDS[section] if section else None)


@query("timetable_violations", violations_sql())
def timetable_rules(t: Tables) -> DataFrame:
    regions = t.nation.where("n_nationkey < 4").select(
        F.concat(F.lit("SV"), "n_nationkey").alias("service_ref"), (F.col("n_nationkey") == 0).alias("is_scottish")
    )
    stops = t.nation.select(
        F.explode(F.array(F.concat(F.lit("FX"), "n_nationkey"), F.concat(F.lit("ST"), "n_nationkey"))).alias("atco_code"),
        F.array(F.concat(F.lit("G"), "n_nationkey")).alias("stop_areas"),
        F.when(F.col("n_nationkey") % 2 == 0, "BCT").otherwise("RLY").alias("stop_type"),
        F.lit("FLX").alias("bus_stop_type"),
    )
    found = timetable_violations(staged(_docs(t)), F.lit("2026-01-01").cast("date"), regions, stops)
    return found.select("file_id", "observation", "element", "ordinal")


# --------------------------------------------------------------- fares


def _fares(t: Tables) -> DataFrame:
    return parse_fares(fares_documents(t))


@query("fares_violations", xml_parts.violations_sql())
def fares_rules(t: Tables) -> DataFrame:
    found = fares_violations(_fares(t), experimental=True)
    return found.select("file_id", "observation", "element", "ordinal")


_FARES_METADATA_SQL = """SELECT p_partkey AS file_id, CASE WHEN p_partkey % 2 = 0 THEN '1.1' ELSE '1.10' END AS schema_version,
  1 AS num_of_lines, CASE WHEN p_partkey % 22 <> 1 AND p_partkey % 24 <> 1 THEN 1 ELSE 0 END AS num_of_fare_zones,
  CASE WHEN p_partkey % 46 <> 1 THEN 1 ELSE 0 END AS num_of_sales_offer_packages,
  1 + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END
    + CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 0 END AS num_of_fare_products,
  CASE WHEN p_partkey % 32 <> 1 THEN 1 ELSE 0 END AS num_of_user_profiles,
  CASE WHEN p_partkey % 39 <> 1 AND p_partkey % 4 < 2 THEN 1 ELSE 0 END AS num_of_pass_products,
  CASE WHEN p_partkey % 39 <> 1 AND p_partkey % 4 = 2 THEN 1 ELSE 0 END AS num_of_trip_products,
  CASE WHEN p_partkey % 26 <> 1 THEN TIMESTAMP '2020-01-01' + to_days(CAST(p_partkey % 28 AS INTEGER)) END AS valid_from,
  CASE WHEN p_partkey % 26 <> 1 AND p_partkey % 3 <> 0 THEN TIMESTAMP '2030-12-31' END AS valid_to FROM part"""


@query("fares_document_metadata", _FARES_METADATA_SQL)
def fares_document_metadata(t: Tables) -> DataFrame:
    return rollup.fares_file_metadata(far.details(staged(_fares(t))))


@query(
    "fares_document_catalogue",
    """SELECT p_partkey AS file_id, CASE WHEN p_partkey % 11 NOT IN (1, 2) THEN DATE '2021-02-01' + CAST(p_partkey % 28 AS INTEGER) END AS valid_from,
  CASE WHEN p_partkey % 11 NOT IN (1, 2) THEN DATE '2031-01-01' END AS valid_to,
  CASE WHEN p_partkey % 19 <> 1 THEN CASE WHEN p_partkey % 29 = 1 THEN 'AB' ELSE 'ABCD' END END AS national_operator_code,
  'LN' || (p_partkey % 9) AS line_id, CASE WHEN p_partkey % 10 <> 3 THEN 'P' || (p_partkey % 12) ELSE '' END AS line_name,
  CASE WHEN p_partkey % 15 <> 2 THEN CAST(p_partkey % 90 AS VARCHAR) END AS atco_area,
  CASE WHEN p_partkey % 30 <> 1 THEN 'flat' ELSE '' END AS tariff_basis,
  CASE WHEN p_partkey % 39 = 1 THEN '' ELSE ['dayPass', 'periodPass', 'singleTrip', 'other'][p_partkey % 4 + 1] END AS product_type,
  CASE WHEN p_partkey % 36 <> 1 THEN 'Product ' || (p_partkey % 40) ELSE '' END AS product_name,
  CASE WHEN p_partkey % 32 <> 1 THEN ['adult', 'child', 'senior'][p_partkey % 3 + 1] END AS user_type FROM part""",
)
def fares_document_catalogue(t: Tables) -> DataFrame:
    out = rollup.fares_catalogue(far.details(staged(_fares(t))))
    arrays = [c for c, kind in out.dtypes if kind.startswith("array")]
    return out.withColumns({c: F.array_join(F.col(c).cast("array<string>"), "|") for c in arrays})


@query(
    "job_fares_revisions",
    f"""WITH m AS ({_FARES_METADATA_SQL}),
t AS (SELECT p_partkey % 50 AS revision_id, CASE WHEN p_partkey % 32 <> 1 THEN p_partkey % 3 END AS user_type,
    CASE WHEN p_partkey % 39 <> 1 THEN p_partkey % 4 END AS product FROM part),
n AS (SELECT revision_id, count(DISTINCT user_type) AS num_of_user_profiles,
    count(DISTINCT CASE WHEN product < 2 THEN product END) AS num_of_pass_products,
    count(DISTINCT CASE WHEN product = 2 THEN product END) AS num_of_trip_products FROM t GROUP BY revision_id),
s AS (SELECT file_id % 50 AS revision_id, CAST(sum(num_of_lines) AS BIGINT) AS num_of_lines, CAST(sum(num_of_fare_zones) AS BIGINT) AS num_of_fare_zones,
    CAST(sum(num_of_sales_offer_packages) AS BIGINT) AS num_of_sales_offer_packages, CAST(sum(num_of_fare_products) AS BIGINT) AS num_of_fare_products,
    min(valid_from) AS valid_from, max(valid_to) AS valid_to, min(schema_version) AS schema_version FROM m GROUP BY ALL)
SELECT s.*, num_of_user_profiles, num_of_pass_products, num_of_trip_products FROM s JOIN n USING (revision_id)""",
)
def job_fares_revisions(t: Tables) -> DataFrame:
    docs = staged(_fares(t).withColumn("revision_id", F.col("file_id") % 50))
    return process_fares(docs)["revisions"]


@query(
    "fares_table_cells",
    """SELECT p_partkey AS file_id, 'ft' AS table_id, CAST(i AS INTEGER) AS pos, 'r' || i AS row_id, 'c0' AS column_id,
  i + p_partkey % 20 + 0.5::DOUBLE AS amount FROM part, unnest(generate_series(0, p_partkey % 3)) u(i)""",
)
def fares_table_cells(t: Tables) -> DataFrame:
    return far.fare_table_cells(_fares(t))


@query(
    "fares_zone_stop_refs",
    """SELECT p_partkey AS file_id, 'fz' AS zone_id, CASE WHEN c = 0 THEN 'ST' || p_partkey END AS atco_code,
  CASE WHEN c = 1 THEN 'N' || p_partkey END AS naptan_code FROM part, (VALUES (0), (1)) v(c) WHERE p_partkey % 22 <> 1 AND p_partkey % 24 <> 1""",
)
def fares_zone_stop_refs(t: Tables) -> DataFrame:
    return far.zone_stop_refs(_fares(t))


# ----------------------------------------------------------- timetables


@query(
    "document_metadata",
    """SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 30 = 0 THEN '2.1' ELSE '2.4' END AS schema_version,
  o_orderdate AS creation_datetime, o_orderdate + to_days(CAST(o_orderkey % 2 AS INTEGER)) AS modification_datetime,
  CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE 'revise' END AS modification, CAST(o_orderkey % 3 AS INTEGER) AS revision_number,
  'f' || o_orderkey || '.xml' AS filename FROM orders""",
)
def document_metadata(t: Tables) -> DataFrame:
    return src.metadata(_docs(t, "metadata"))


@query(
    "document_journeys",
    """SELECT o_orderkey AS file_id, 'VJ' || v AS vj_code, CAST(v AS INTEGER) AS ordinal,
  CASE WHEN v = 0 THEN 'JP0' WHEN o_orderkey % 6 <> 3 THEN 'JP' || (o_orderkey % 2) END AS jp_ref,
  CASE WHEN v = 1 AND (o_orderkey % 6 = 3 OR o_orderkey % 12 = 8) THEN 'VJ0' END AS vj_ref,
  CASE WHEN v = 0 THEN '08:15:00' ELSE '09:30:00' END AS departure_time,
  CASE WHEN v = 0 AND o_orderkey % 43 < 5 THEN CAST(o_orderkey % 2 AS INTEGER) END AS departure_day_shift,
  CASE WHEN v = 0 AND o_orderkey % 2 = 1 THEN CAST(o_orderkey % 30 AS VARCHAR) END AS block,
  CASE WHEN v = 0 THEN CAST(o_orderkey % 1000 AS VARCHAR) END AS journey_code
FROM orders, (VALUES (0), (1)) x(v) WHERE NOT (v = 0 AND o_orderkey % 50 = 0)""",
)
def document_journeys(t: Tables) -> DataFrame:
    accepted, _ = admit(src.vehicle_journeys(_docs(t, "vehicle_journeys")), REQUIRED["vehicle_journeys"])
    return accepted.drop("line_ref", "service_ref", "commercial_basis")


@query(
    "rejected_rows",
    """SELECT o_orderkey AS file_id, 'vehicle_journeys' AS section, 'departure_time' AS reason FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey, 'timing_links', 'route_link_ref' FROM orders, unnest(generate_series(0, 2 * (o_orderkey % 2) + 1)) WHERE o_orderkey % 37 = 0
UNION ALL SELECT o_orderkey, 'journey_patterns', concat_ws(',', CASE WHEN o_orderkey % 4 = 1 THEN 'destination_display' END, CASE WHEN o_orderkey % 29 = 1 THEN 'direction' END,
    CASE WHEN o_orderkey % 26 = 1 THEN 'route_ref' END, CASE WHEN o_orderkey % 28 = 1 THEN 'section_refs' END)
  FROM orders, unnest(generate_series(0, o_orderkey % 2))
  WHERE o_orderkey % 20 NOT IN (1, 4) AND o_orderkey % 24 <> 0 AND (o_orderkey % 4 = 1 OR o_orderkey % 29 = 1 OR o_orderkey % 26 = 1 OR o_orderkey % 28 = 1)
UNION ALL SELECT o_orderkey, 'flexible_journeys', 'service_times' FROM orders WHERE o_orderkey % 20 IN (1, 3) AND o_orderkey % 3 = 1""",
)
def rejected_rows(t: Tables) -> DataFrame:
    docs = staged(_docs(t))
    names = ("vehicle_journeys", "timing_links", "journey_patterns", "flexible_journeys", "lines", "routes", "route_links", "serviced_organisations", "flexible_patterns", "bookings")
    return admit_sections({n: src.SECTIONS[n](docs) for n in names})[1]


@query(
    "document_lines",
    """SELECT o_orderkey AS file_id, CAST(j AS INTEGER) AS line_pos, 'L' || j AS line_name,
  CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN 'in' END AS inbound, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 10 <> 0 THEN 'out' END AS outbound
FROM orders, unnest(generate_series(0, o_orderkey % 2)) u(j)
UNION ALL SELECT o_orderkey, 0, 'LX', NULL, NULL FROM orders WHERE o_orderkey % 10 = 3""",
)
def document_lines(t: Tables) -> DataFrame:
    return src.lines(_docs(t, "lines")).select(
        "file_id", "line_pos", "line_name",
        F.col("inbound.description").alias("inbound"), F.col("outbound.description").alias("outbound"),
    )


@query(
    "document_profiles",
    """SELECT o_orderkey AS file_id, 'VJ0' AS owner_id, CASE WHEN o_orderkey % 45 < 3 THEN 5 ELSE 2 END AS days,
  CASE WHEN o_orderkey % 4 = 3 THEN 3 ELSE 0 END AS special_days,
  CASE o_orderkey % 15 WHEN 4 THEN 14 WHEN 9 THEN 11 ELSE 0 END AS bank_days, CASE o_orderkey % 15 WHEN 9 THEN 3 WHEN 14 THEN 14 ELSE 0 END AS bank_off FROM orders
UNION ALL SELECT o_orderkey, 'VJ1', 1, 0, 0, 0 FROM orders WHERE o_orderkey % 4 = 0""",
)
def document_profiles(t: Tables) -> DataFrame:
    p = src.operating_profiles(_docs(t, "operating_profiles"))
    return p.select(
        "file_id",
        "owner_id",
        F.size(cal.weekday_numbers(F.col("days"))).alias("days"),
        F.size(cal.expand_ranges(F.col("special_operation"))).alias("special_days"),
        F.size("bank_operation").alias("bank_days"),
        F.size("bank_non_operation").alias("bank_off"),
    )


@query(
    "document_special_days",
    """SELECT o_orderkey AS file_id, 'VJ0' AS owner_id, CAST(o_orderdate AS DATE) + 1 AS first_day, CAST(o_orderdate AS DATE) + 3 AS last_day
FROM orders WHERE o_orderkey % 4 = 3""",
)
def document_special_days(t: Tables) -> DataFrame:
    profiles = src.operating_profiles(_docs(t, "operating_profiles"))
    return profiles.select("file_id", "owner_id", F.explode("special_operation").alias("r")).select(
        "file_id", "owner_id", F.col("r.start").alias("first_day"), F.col("r.end").alias("last_day")
    )


@query("unreadable_files", "SELECT o_orderkey AS file_id, 'XML_SYNTAX_ERROR' AS error_code FROM orders WHERE o_orderkey % 17 = 0")
def unreadable(t: Tables) -> DataFrame:
    """Every seventeenth document breaks off before its end."""
    cut = F.when(F.col("file_id") % 17 == 0, F.expr("left(text, length(text) - 20)")).otherwise(F.col("text"))
    return unreadable_files(parse_timetables(timetable_documents(t).withColumn("text", cut), fields=src.FIELDS["metadata"]))


@query(
    "document_stops",
    """SELECT o_orderkey AS file_id, 'ST' || n AS atco_code, true AS is_reference, 'Stop ' || n AS common_name, 'Town' AS locality_name, NULL::DOUBLE AS lon
FROM orders, (VALUES (0), (3)) v(n)
UNION ALL SELECT o_orderkey, 'ST' || (o_orderkey % 7), false, 'Own ' || (o_orderkey % 7), 'E1', -2.25 FROM orders WHERE o_orderkey % 9 = 2""",
)
def document_stops(t: Tables) -> DataFrame:
    return src.stop_points(_docs(t, "stop_points")).select("file_id", "atco_code", "is_reference", "common_name", "locality_name", "lon")


@query(
    "document_flexible_stops",
    """SELECT o_orderkey AS file_id, 'FJP0' AS jp_id, in_sequence, CAST(stop_pos AS INTEGER) AS stop_pos, is_flexible,
  CASE WHEN is_flexible THEN 'FX' || (o_orderkey % 5) ELSE 'ST' || (o_orderkey % 7) END AS stop_ref
FROM orders, (VALUES (true, 0, false), (true, 1, true), (false, 0, true)) v(in_sequence, stop_pos, is_flexible)
WHERE o_orderkey % 20 IN (1, 3) AND o_orderkey % 40 <> 3""",
)
def document_flexible_stops(t: Tables) -> DataFrame:
    return src.flexible_stops(_docs(t, "flexible_stops")).drop("timing_status")


@query(
    "document_route_links",
    """SELECT o_orderkey AS file_id, 'RL' || l AS link_id, CAST(CASE WHEN l = 0 THEN o_orderkey % 900 END AS INTEGER) AS distance,
  CAST(CASE WHEN l = 1 THEN 0 WHEN o_orderkey % 33 = 0 THEN 1 ELSE 2 END AS INTEGER) AS points FROM orders, (VALUES (0), (1)) v(l)""",
)
def document_route_links(t: Tables) -> DataFrame:
    return src.route_links(_docs(t, "route_links")).select("file_id", "link_id", "distance", F.coalesce(F.size("points"), F.lit(0)).alias("points"))


@query(
    "corpus_inventory",
    """SELECT o_orderkey AS file_id, 'f' || o_orderkey || '.xml' AS filename,
  CASE WHEN o_orderkey % 8 <> 0 THEN 'OPER' END AS noc,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bad code' ELSE 'PD' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || ':1' END AS service_code,
  CASE o_orderkey % 6 WHEN 1 THEN NULL WHEN 2 THEN -1 WHEN 3 THEN 5000 ELSE 100 END AS service_span_days,
  CASE WHEN o_orderkey % 10 = 3 THEN 2 ELSE 1 END AS services,
  o_orderkey % 2 + 1 + CASE WHEN o_orderkey % 10 = 3 THEN 1 ELSE 0 END AS lines,
  CASE WHEN o_orderkey % 20 NOT IN (1, 4) AND o_orderkey % 24 <> 0 THEN o_orderkey % 2 + 1 ELSE 0 END + CASE WHEN o_orderkey % 10 = 3 THEN 1 ELSE 0 END AS journey_patterns,
  2 AS vehicle_journeys, CASE WHEN o_orderkey % 9 = 2 THEN 1 ELSE 0 END AS custom_stops, CASE WHEN o_orderkey % 9 = 2 THEN 3 ELSE 2 END AS stop_points
FROM orders""",
)
def corpus_inventory(t: Tables) -> DataFrame:
    return rollup.corpus_inventory(src.sections(staged(_docs(t))))


@query(
    "safety_violations",
    """SELECT o_orderkey AS file_id, 'f' || o_orderkey || '.xml' AS name, 'SCHEMA_VERSION_NOT_SUPPORTED' AS error_code FROM orders WHERE o_orderkey % 30 = 0
UNION ALL SELECT -page_id - 1, 'p' || page_id || CASE WHEN page_id % 5 = 0 THEN '.html' ELSE '.xml' END,
  CASE WHEN page_id % 5 = 0 THEN 'SUSPICIOUS_FILE' ELSE 'DANGEROUS_XML_ERROR' END FROM pages""",
)
def safety(t: Tables) -> DataFrame:
    own = timetable_documents(t).withColumn("name", F.concat(F.lit("f"), "file_id", F.lit(".xml")))
    suffix = F.when(F.col("page_id") % 5 == 0, ".html").otherwise(".xml")
    pages = t.pages.select((-F.col("page_id") - 1).alias("file_id"), F.col("html").alias("text"), F.concat(F.lit("p"), "page_id", suffix).alias("name"))
    return safety_violations(own.unionByName(pages), "TransXChange", ("2.4",))
