"""Registered queries: output tables of the whole timetable job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans.q_documents import rejected_rows  # noqa: F401  (its SQL is registered first)
from headway.plans.q_jobs import _ACTIVE_SQL, _job, _references
from headway.plans.registry import ORACLES, Tables, query
from headway.plans.timetable_job import process
from headway.plans.xml_orders import timetable_documents
from headway.session import staged
from headway.sources.documents import parse_timetables

_CODE = "CASE WHEN k % 13 = 0 THEN 'bad code' ELSE 'PD' || lpad(CAST(k AS VARCHAR), 7, '0') || ':1' END"
_FLEXIBLE = "k % 20 IN (1, 3) AND k % 40 <> 3"
# Service patterns with stops: of JP0 (shared by the spare service's JPX), of JP1, of JPX alone.
_SERVICE_PATTERNS = """,
sp AS (
  SELECT k, 1 + CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END AS jps,
    CASE WHEN k % 50 <> 0 THEN 1 ELSE 0 END + CASE WHEN k % 2 = 0 OR k % 6 = 3 THEN 1 ELSE 0 END AS vjs,
    CASE WHEN k % 4 < 2 THEN 'inbound' ELSE 'outbound' END AS direction FROM pattern
  UNION ALL SELECT k, 1, CASE WHEN k % 6 <> 3 THEN 1 ELSE 0 END, CASE WHEN k % 4 < 2 THEN 'inbound' ELSE 'outbound' END FROM pattern WHERE k % 2 = 1
  UNION ALL SELECT k, 1, 0, 'inbound' FROM active WHERE k % 10 = 3 AND k % 37 <> 0 AND k NOT IN (SELECT k FROM pattern))
"""


@query(
    "job_file_attributes",
    "WITH " + _ACTIVE_SQL + """SELECT k AS file_id, 'f' || k || '.xml' AS filename, CAST(rev AS INTEGER) AS revision_number,
  d AS operating_period_start_date, NOT coalesce(rev = m OR s IS NULL OR d < s, false) AS superseded FROM latest""",
)
def job_file_attributes(t: Tables) -> DataFrame:
    return _job(t)["file_attributes"].select("file_id", "filename", "revision_number", "operating_period_start_date", "superseded")


@query(
    "job_later_uploads",
    """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 7 AS r, o_orderkey % 50 AS n, (o_orderkey * 7919) % 1009 AS u FROM orders WHERE o_orderkey % 30 <> 0)
SELECT k AS file_id, 'f' || n || '.xml' AS filename FROM (SELECT *, row_number() OVER (PARTITION BY r, n ORDER BY u DESC,
  o_orderdate + to_days(CAST(k % 2 AS INTEGER)) DESC, o_orderdate DESC, k % 3 DESC, k DESC) AS place FROM o JOIN orders ON o_orderkey = k) WHERE place = 1""",
)
def job_later_uploads(t: Tables) -> DataFrame:
    """Fifty names a revision: of the files of one name the one uploaded last counts."""
    text = F.regexp_replace("text", ' FileName="[^"]*"', "")
    name = F.concat(F.lit('<TransXChange FileName="f'), F.col("file_id") % 50, F.lit('.xml"'))
    docs = timetable_documents(t).withColumn("text", F.regexp_replace(text, "^<TransXChange", name))
    read = parse_timetables(docs).withColumns({"revision_id": F.col("file_id") % 7, "upload_order": F.col("file_id") * 7919 % 1009})
    return process(staged(read), _references(t))["file_attributes"].select("file_id", "filename")


@query(
    "job_services",
    "WITH " + _ACTIVE_SQL + f"""SELECT k AS file_id, {_CODE} AS service_code, 'L0' AS name, CAST(k % 2 AS INTEGER) AS others, d AS start_date FROM doc
UNION ALL SELECT k, 'UZ' || lpad(CAST(k AS VARCHAR), 7, '0') || ':2', 'LX', 0, d FROM doc WHERE k % 10 = 3""",
)
def job_services(t: Tables) -> DataFrame:
    return _job(t)["services"].select("file_id", "service_code", "name", F.size("other_names").alias("others"), "start_date")


@query(
    "job_pattern_members",
    "WITH " + _ACTIVE_SQL + _SERVICE_PATTERNS + "SELECT k AS file_id, 3 AS num_stops, CAST(jps AS BIGINT) AS journey_patterns, CAST(vjs AS BIGINT) AS vehicle_journeys FROM sp",
)
def job_pattern_members(t: Tables) -> DataFrame:
    return _job(t)["pattern_members"].where("num_stops > 0").drop("service_pattern_id")


@query("job_pattern_directions", "WITH " + _ACTIVE_SQL + _SERVICE_PATTERNS + "SELECT k AS file_id, direction FROM sp")
def job_pattern_directions(t: Tables) -> DataFrame:
    job = _job(t)
    real = job["pattern_members"].where("num_stops > 0").select("file_id", "service_pattern_id")
    return job["pattern_directions"].join(real, ["file_id", "service_pattern_id"], "left_semi").select("file_id", "direction")


@query(
    "job_vehicle_journeys",
    "WITH " + _ACTIVE_SQL + """, p AS (SELECT k, d FROM active WHERE k % 20 NOT IN (1, 4) AND k % 24 <> 0 AND k % 4 <> 1 AND k % 29 <> 1 AND k % 26 <> 1 AND k % 28 <> 1)
SELECT k AS file_id, 'VJ0' AS vj_code, 'JP0' AS jp_ref, '08:15:00' AS start_time, CAST(k % 1000 AS VARCHAR) AS journey_code,
  CASE WHEN k % 2 = 1 THEN CAST(k % 30 AS VARCHAR) END AS block_number FROM p WHERE k % 50 <> 0
UNION ALL SELECT k, 'VJ1', 'JP' || (k % 2), '09:30:00', '', NULL FROM p WHERE k % 6 <> 3""",
)
def job_vehicle_journeys(t: Tables) -> DataFrame:
    return _job(t)["vehicle_journeys"].select("file_id", "vj_code", "jp_ref", "start_time", "journey_code", "block_number")


@query(
    "job_operating_profiles",
    "WITH " + _ACTIVE_SQL + """SELECT k AS file_id, 'VJ0' AS vj_code, unnest(CASE WHEN k % 45 < 3 THEN ['monday', 'tuesday', 'wednesday', 'thursday', 'friday'] ELSE ['monday', 'friday'] END) AS day_of_week
FROM active WHERE k % 50 <> 0 UNION ALL SELECT k, 'VJ1', 'monday' FROM active WHERE k % 4 = 0""",
)
def job_operating_profiles(t: Tables) -> DataFrame:
    return _job(t)["operating_profiles"]


@query(
    "job_flexible_patterns",
    "WITH " + _ACTIVE_SQL + f"""SELECT k AS file_id, {_CODE} AS service_code, 3 AS num_stops, CAST(CASE WHEN k % 3 <> 1 THEN 1 ELSE 0 END AS BIGINT) AS vehicle_journeys, 'outbound' AS direction
FROM active WHERE {_FLEXIBLE}""",
)
def job_flexible_patterns(t: Tables) -> DataFrame:
    job = _job(t)
    keys = ["file_id", "service_pattern_id"]
    found = job["flexible_service_patterns"].select(*keys, "service_code").join(job["flexible_pattern_members"], keys).join(job["flexible_pattern_directions"], keys)
    return found.select("file_id", "service_code", "num_stops", "vehicle_journeys", "direction")


@query(
    "job_flexible_operation_periods",
    "WITH " + _ACTIVE_SQL + """SELECT k AS file_id, 'FVJ0' AS vj_code, CASE WHEN k % 3 = 0 THEN '00:00:00' ELSE '07:00:00' END AS start_time,
  CASE WHEN k % 3 = 0 THEN '23:59:59' ELSE '19:00:00' END AS end_time, false AS is_error FROM active WHERE k % 20 IN (1, 3) AND k % 3 <> 1""",
)
def job_flexible_operation_periods(t: Tables) -> DataFrame:
    return _job(t)["flexible_operation_periods"].drop("pos")


@query(
    "job_booking_arrangements",
    "WITH " + _ACTIVE_SQL + f"""SELECT k AS file_id, {_CODE} AS service_code, 'Call us' AS description, CASE WHEN k % 7 <> 1 THEN 'a@b.c' END AS email, '0123' AS phone
FROM active WHERE {_FLEXIBLE} AND k % 7 <> 0""",
)
def job_booking_arrangements(t: Tables) -> DataFrame:
    return _job(t)["booking_arrangements"].select("file_id", "service_code", "description", "email", "phone")


@query(
    "job_tracks",
    "WITH " + _ACTIVE_SQL + """SELECT k AS file_id, 'ST' || (k % 7) AS from_atco_code, 'ST' || ((k + 1) % 7) AS to_atco_code, CAST(k % 900 AS INTEGER) AS distance, 2 AS points
FROM active WHERE k % 33 <> 0""",
)
def job_tracks(t: Tables) -> DataFrame:
    return _job(t)["tracks"].select("file_id", "from_atco_code", "to_atco_code", "distance", F.size("points").alias("points"))


@query("job_rejected_rows", ORACLES["rejected_rows"])
def job_rejected_rows(t: Tables) -> DataFrame:
    return _job(t)["rejected_rows"]
