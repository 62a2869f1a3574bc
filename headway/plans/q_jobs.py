"""Registered queries: whole jobs, streams and keyed loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.plans.registry import Tables, query, shared
from headway.plans.timetable_job import References, process
from headway.plans.xml_orders import timetable_documents
from headway.session import shared_folder, staged
from headway.sources.documents import parse_timetables, surviving_files
from headway.sources import tables as tab
from headway.streaming import feeds


def _references(t: Tables) -> References:
    key = F.col("p_partkey")
    stops = t.part.select(
        F.concat(F.lit("ST"), key).alias("atco_code"),
        key.alias("id"),
        F.col("p_name").alias("common_name"),
        F.lit(0.0).alias("lon"),
        F.lit(0.0).alias("lat"),
        F.concat(F.lit("E"), key % 5).alias("locality_id"),
        (key % 4).cast("int").alias("admin_area_id"),
    )
    holidays = t.nation.select(
        F.element_at(F.array(F.lit("ChristmasDay"), F.lit("MayDay")), (F.col("n_nationkey") % 2 + 1).cast("int")).alias("txc_element"),
        F.date_add(F.lit("1995-01-06").cast("date"), (F.col("n_nationkey") * 71).cast("int")).alias("date"),
        F.lit("england-and-wales").alias("division"),
    )
    return References(stops, holidays)


@shared
def _job(t: Tables):
    """Seven uploads share service codes."""
    docs = staged(parse_timetables(timetable_documents(t)).withColumn("revision_id", F.col("file_id") % 7))
    return process(docs, _references(t))


_ACTIVE_SQL = """
doc AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_orderkey % 3 AS rev,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bad code' ELSE 'PD' || o_orderkey END AS code FROM orders WHERE o_orderkey % 30 <> 0),
top AS (SELECT *, max(rev) OVER (PARTITION BY k % 7, code) AS m FROM doc),
latest AS (SELECT *, max(CASE WHEN rev = m THEN d END) OVER (PARTITION BY k % 7, code) AS s FROM top),
active AS (SELECT k, d FROM latest WHERE rev = m OR d < s),
pattern AS (SELECT k, d, k % 2 AS i FROM active WHERE k % 20 NOT IN (1, 4) AND k % 24 <> 0 AND k % 4 <> 1 AND k % 29 <> 1
  AND k % 26 <> 1 AND k % 28 <> 1 AND k % 37 <> 0)
"""


@query(
    "job_stop_times",
    "WITH " + _ACTIVE_SQL + """,
journey AS (
  SELECT k, 'VJ0' AS vj, 0 AS i, 29700 AS s FROM pattern WHERE k % 50 <> 0
  UNION ALL SELECT k, 'VJ1', i, 34200 FROM pattern WHERE k % 6 <> 3),
timed AS (SELECT *, CASE WHEN k % 4 = 0 THEN 0 ELSE k % 50 END AS w, CASE WHEN k % 5 = 0 THEN 2 ELSE 3 END * i + k AS base,
  CASE WHEN vj = 'VJ0' AND k % 47 = 0 THEN 0 WHEN vj = 'VJ0' THEN 360 ELSE 300 END AS run FROM journey),
waited AS (SELECT *, CASE WHEN vj = 'VJ0' AND k % 5 = 2 THEN 60 ELSE w END AS w1 FROM timed),
stop AS (
  SELECT k, vj, i, 0 AS n, 1 AS given, base AS a, s + w AS t, k % 38 <> 0 AS has FROM waited
  UNION ALL SELECT k, vj, i, 1, 2, base + CASE WHEN k % 36 = 0 THEN 6 ELSE 1 END, s + w + w1, k % 38 <> 0 FROM waited
  UNION ALL SELECT k, vj, i, 2, CASE WHEN k % 35 <> 0 THEN 3 ELSE 2 END, base + 2, s + w + w1 + run, k % 39 <> 0 FROM waited)
SELECT k AS file_id, vj AS vj_code, 'JP' || i AS jp_id, 'ST' || (a % 7) AS atco_code, n AS auto_sequence_number, given AS sequence_number,
  CAST(t AS BIGINT) AS departure_seconds, k % 3 = 0 AND has AS is_timing_point, 3 AS stop_activity_id FROM stop""",
)
def job_stop_times(t: Tables) -> DataFrame:
    out = _job(t)["stop_times"]
    return out.withColumn("departure_seconds", F.col("departure_seconds").cast("bigint")).drop(
        "departure_time", "service_pattern_id", "naptan_stop_id", "common_name"
    )


@query(
    "job_service_patterns",
    "WITH " + _ACTIVE_SQL + """,
jp AS (SELECT k, unnest(generate_series(0, k % 2)) AS i FROM pattern)
SELECT k AS file_id, 'JP' || i AS jp_id, 3 AS num_stops FROM jp
UNION ALL SELECT k, 'JPX', 3 FROM active WHERE k % 10 = 3 AND k % 37 <> 0""",
)
def job_service_patterns(t: Tables) -> DataFrame:
    return _job(t)["service_patterns"].where("num_stops > 0").select("file_id", "jp_id", "num_stops")


@query(
    "job_calendar_exceptions",
    "WITH " + _ACTIVE_SQL + """,
hol AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'ChristmasDay' ELSE 'MayDay' END AS name, DATE '1995-01-06' + n_nationkey * 71 AS date FROM nation),
days AS (
  SELECT k, d + i AS date, true AS op FROM active, (VALUES (1), (2), (3)) v(i) WHERE k % 4 = 3 AND k % 50 <> 0
  UNION ALL SELECT k, date, true FROM active JOIN hol ON date >= d AND CASE k % 6 WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN date <= d + 5000 ELSE date <= d + 100 END
    WHERE k % 15 IN (4, 9) AND k % 50 <> 0
  UNION ALL SELECT k, date, false FROM active JOIN hol ON date >= d AND CASE k % 6 WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN date <= d + 5000 ELSE date <= d + 100 END
    WHERE k % 15 = 14 AND k % 50 <> 0)
SELECT DISTINCT k AS file_id, 'VJ0' AS vj_code, date, op AS operates FROM days
WHERE op <> CASE WHEN k % 45 < 3 THEN isodow(date) <= 5 ELSE isodow(date) IN (1, 5) END""",
)
def job_calendar_exceptions(t: Tables) -> DataFrame:
    return _job(t)["calendar_exceptions"]


@query(
    "surviving_files",
    """SELECT o_orderkey AS file_id, 'f' || o_orderkey || '.xml' AS name FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_tax >= 0.07) AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def survivors(t: Tables) -> DataFrame:
    corpus = timetable_documents(t).withColumn("name", F.concat(F.lit("f"), "file_id", F.lit(".xml")))
    status = t.lineitem.select(
        F.col("l_orderkey").alias("file_id"), F.when(F.col("l_tax") >= 0.07, "failed").otherwise("succeeded").alias("status")
    )
    return surviving_files(corpus, status).select("file_id", "name")


# ------------------------------------------------------- keyed loads


@query(
    "stop_register_load",
    """WITH inc AS (SELECT 'ST' || o_custkey AS atco_code, max_by(nullif(o_orderpriority, '5-LOW'), (o_orderdate, o_orderkey)) AS x,
    max_by(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM orders GROUP BY ALL)
SELECT coalesce(inc.atco_code, 'ST' || c_custkey) AS atco_code,
  CASE WHEN inc.k IS NOT NULL THEN (SELECT nullif(o_orderpriority, '5-LOW') FROM orders WHERE o_orderkey = inc.k) ELSE 'N' || c_custkey END AS naptan_code,
  CASE WHEN inc.k IS NOT NULL THEN 'Order ' || inc.k ELSE c_name END AS common_name
FROM customer FULL JOIN inc ON inc.atco_code = 'ST' || c_custkey""",
)
def stop_register_load(t: Tables) -> DataFrame:
    existing = t.customer.select(
        F.concat(F.lit("ST"), "c_custkey").alias("atco_code"),
        F.concat(F.lit("N"), "c_custkey").alias("naptan_code"),
        F.col("c_name").alias("common_name"),
        F.lit(0).cast("bigint").alias("modified_at"),
    )
    code = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    incoming = t.orders.select(
        F.concat(F.lit("ST"), "o_custkey").alias("atco_code"),
        F.nullif(code, F.lit("")).alias("naptan_code"),
        F.concat(F.lit("Order "), "o_orderkey").alias("common_name"),
        (F.unix_timestamp("o_orderdate") * 100000000 + F.col("o_orderkey")).alias("modified_at"),
    )
    return tab.load_stops(existing, incoming).drop("modified_at")


@query(
    "stop_id_refresh",
    "SELECT 'ST' || c_custkey AS atco_code, coalesce(s_suppkey, -c_custkey) AS id FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey",
)
def stop_id_refresh(t: Tables) -> DataFrame:
    stops = t.customer.select(F.concat(F.lit("ST"), "c_custkey").alias("atco_code"), (-F.col("c_custkey")).alias("id"))
    ids = t.supplier.select(F.concat(F.lit("ST"), "s_suppkey").alias("atco_code"), F.col("s_suppkey").alias("id"))
    return tab.refresh_ids(stops, ids)


@query(
    "revision_extract",
    """WITH r AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'), s AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM r))
SELECT 'revisions' AS "table", count(*) AS rows FROM r UNION ALL SELECT 'services', count(*) FROM s
UNION ALL SELECT 'service_patterns', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)""",
)
def revision_extract(t: Tables) -> DataFrame:
    tables = {
        "services": t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("revision_id")),
        "service_patterns": t.lineitem.select(F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("service_id")),
    }
    revisions = t.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("id"))
    counts = None
    for name, df in tab.extract_revision(tables, revisions).items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "revision_replace",
    """SELECT o_custkey % 20 AS revision_id, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
WHERE o_orderstatus = CASE WHEN o_custkey % 20 IN (SELECT o_custkey % 20 FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 480000) THEN 'P' ELSE o_orderstatus END
GROUP BY ALL""",
)
def revision_replace(t: Tables) -> DataFrame:
    """Load all revisions, then replace those with a big pending order by their pending rows."""
    path = f"{shared_folder(t.spark)}/replace-{uuid.uuid4().hex}"
    rows = t.orders.withColumn("revision_id", F.col("o_custkey") % 20).select("revision_id", "o_orderkey", "o_orderstatus", "o_totalprice")
    tab.replace_revisions(rows, path)
    changed = rows.where("o_orderstatus = 'P' and o_totalprice > 480000").select("revision_id").distinct()
    tab.replace_revisions(rows.where("o_orderstatus = 'P'").join(changed, "revision_id", "left_semi").select("o_orderkey", "o_orderstatus", "o_totalprice", "revision_id"), path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("revision_id").cast("bigint").alias("revision_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")
    )


# ------------------------------------------------------------ streams


def _event_stream(t: Tables) -> DataFrame:
    return (
        t.spark.readStream.schema(t.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.folder)
    )


@query(
    "feed_archive_latest",
    """SELECT event_type AS data_format, event_type || '_' || strftime(max(ts), '%Y-%m-%d_%H%M%S') || '.zip' AS file, max(ts) AS last_updated
FROM events GROUP BY event_type""",
)
def feed_archive_latest(t: Tables) -> DataFrame:
    base = f"{shared_folder(t.spark)}/feeds-{uuid.uuid4().hex}"
    snapshots = _event_stream(t).select(
        F.col("event_type").alias("data_format"), F.col("ts").alias("received_at"), F.col("props").alias("body")
    )
    run = feeds.archive_feed(snapshots, f"{base}/archive", f"{base}/latest", f"{base}/state", availableNow=True)
    run.awaitTermination()
    return feeds.current_latest(t.spark, f"{base}/latest")


@query(
    "new_content_stream",
    """SELECT DISTINCT user_id, event_type FROM events WHERE event_type <> (SELECT min(event_type) FROM events)""",
)
def new_content_stream(t: Tables) -> DataFrame:
    base = f"{shared_folder(t.spark)}/arrivals-{uuid.uuid4().hex}"
    key = F.sha1(F.concat_ws("/", "user_id", "event_type"))
    stream = _event_stream(t).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("arrived_at"), key.alias("sha1"))
    first = t.events.agg(F.min("event_type").alias("event_type"))
    live = t.events.join(first, "event_type", "left_semi").select(key.alias("sha1"))
    run = (
        feeds.new_content(stream, live)
        .writeStream.format("parquet")
        .option("path", f"{base}/new")
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return t.spark.read.parquet(f"{base}/new").select("user_id", "event_type").distinct()
