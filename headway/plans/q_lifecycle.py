"""Registered queries: supersession, ledgers, lookups, keyed loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import text as txt
from headway.operators import lifecycle as life
from headway.operators import resolve as res
from headway.operators import rollup
from headway.plans.registry import Tables, query


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def files(t: Tables) -> DataFrame:
    """An order is a timetable file, its customer the service, its year the revision number.

    Forty uploads of eight datasets share service codes.
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        key.alias("id"),
        (key % 40).alias("revision_id"),
        (key % 8).alias("dataset_id"),
        _text("f", key % 3000, ".xml").alias("filename"),
        (cust % 100).alias("service_code"),
        F.year("o_orderdate").alias("revision_number"),
        F.when(key % 11 != 0, day).alias("operating_period_start_date"),
        F.date_add(day, 200).alias("operating_period_end_date"),
        F.col("o_orderdate").alias("creation_datetime"),
        F.to_timestamp(F.date_add(day, (key % 30).cast("int"))).alias("modification_datetime"),
        F.array(_text("L", cust % 4), _text("L", key % 3)).alias("line_names"),
        F.sha1(_text("c", key % 9000)).alias("hash"),
    )


_FILES_SQL = """
files AS (SELECT o_orderkey AS id, o_orderkey % 40 AS revision_id, o_orderkey % 8 AS dataset_id, 'f' || (o_orderkey % 3000) || '.xml' AS filename,
  o_custkey % 100 AS service_code, year(o_orderdate) AS rev, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS start, o_orderdate AS created,
  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS TIMESTAMP) AS modified,
  list_sort(['L' || (o_custkey % 4), 'L' || (o_orderkey % 3)]) AS lines, o_orderkey % 9000 AS content
  FROM orders)
"""
_SUPERSEDED_SQL = "WITH " + _FILES_SQL + """,
flagged AS (SELECT *, NOT coalesce(rev = top OR latest IS NULL OR start < latest, false) AS superseded FROM (
  SELECT *, max(CASE WHEN rev = top THEN start END) OVER (PARTITION BY revision_id, service_code) AS latest FROM (
    SELECT *, max(rev) OVER (PARTITION BY revision_id, service_code) AS top FROM files)))
"""


@query("supersession", _SUPERSEDED_SQL + "SELECT id, service_code, rev AS revision_number, superseded FROM flagged")
def supersession(t: Tables) -> DataFrame:
    return life.supersession(files(t)).select(
        "id", "service_code", F.col("revision_number").cast("bigint").alias("revision_number"), "superseded"
    )


@query(
    "file_counts",
    _SUPERSEDED_SQL + """SELECT revision_id, count(*) FILTER (NOT superseded) AS active,
  count(*) FILTER (superseded) AS superseded FROM flagged GROUP BY ALL""",
)
def file_counts(t: Tables) -> DataFrame:
    return life.file_counts(life.supersession(files(t)))


@query(
    "latest_by_name",
    "WITH " + _FILES_SQL + "SELECT max(id) AS id, revision_id, filename FROM files GROUP BY revision_id, filename",
)
def latest_by_name(t: Tables) -> DataFrame:
    return life.latest_by_name(files(t)).select("id", "revision_id", "filename")


@query(
    "surviving_service_rows",
    _SUPERSEDED_SQL + """SELECT 'F' || id AS file_id, 'S' || service_code AS service_code,
  CASE WHEN id % 6 = 0 THEN 'flexible' ELSE 'standard' END AS service_type,
  'L' || (service_code % 4) AS name, 'L' || (id % 3) AS other_names,
  CASE WHEN NOT superseded THEN 'F' || id END AS file_attributes_id FROM flagged""",
)
def surviving_service_rows(t: Tables) -> DataFrame:
    flagged = life.supersession(files(t)).withColumn("file_id", _text("F", F.col("id")))
    services = flagged.select(
        "file_id",
        _text("S", F.col("service_code")).alias("service_code"),
        (F.col("id") % 6 == 0).alias("has_flexible"),
        F.col("operating_period_start_date").alias("start_date"),
        F.col("operating_period_end_date").alias("end_date"),
    )
    lines = flagged.select(
        "file_id",
        _text("S", F.col("service_code")).alias("service_code"),
        F.posexplode("line_names").alias("line_pos", "line_name"),
    )
    out = rollup.service_rows(services, lines, flagged)
    return out.select(
        "file_id", "service_code", "service_type", "name",
        F.array_join("other_names", "|").alias("other_names"), "file_attributes_id",
    )


@query(
    "hot_pairs",
    "SELECT l_suppkey AS a, l_returnflag AS b, count(*) AS tracks FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def hot_pairs(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_suppkey").alias("a"), F.col("l_returnflag").alias("b"))
    return life.hot_pairs(rows, ["a", "b"])


@query(
    "pair_batches",
    """WITH p AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
  s AS (SELECT *, row_number() OVER (ORDER BY n DESC) - 1 AS r FROM p)
SELECT CAST(r // 50 AS BIGINT) AS batch_id, count(*) AS pairs, max(n) AS most, min(n) AS least FROM s GROUP BY ALL""",
)
def pair_batches(t: Tables) -> DataFrame:
    pairs = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    numbered = life.batches(pairs, "n", ["l_suppkey", "l_returnflag"], 50)
    return numbered.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.max("n").alias("most"), F.min("n").alias("least")
    )


@query(
    "changed_files",
    "WITH " + _FILES_SQL + """SELECT id, EXISTS (SELECT 1 FROM files b WHERE b.content = f.content AND b.dataset_id = f.dataset_id
  AND b.content % 4 = 0 AND b.revision_id % 3 = 0) AS is_live FROM files f""",
)
def changed_files(t: Tables) -> DataFrame:
    corpus = files(t).withColumn("sha1", F.col("hash"))
    live = corpus.where((F.col("id") % 9000 % 4 == 0) & (F.col("revision_id") % 3 == 0)).select("dataset_id", "sha1")
    new = life.changed_files(corpus, live).select("id", F.lit(False).alias("is_live"))
    old = life.unchanged_files(corpus, live).select("id", F.lit(True).alias("is_live"))
    return new.unionByName(old)


@query(
    "without_violations",
    "WITH " + _FILES_SQL + """SELECT id FROM files f WHERE NOT EXISTS
  (SELECT 1 FROM files v WHERE v.start IS NULL AND v.revision_id = f.revision_id AND v.filename = f.filename)""",
)
def without_violations(t: Tables) -> DataFrame:
    f = files(t)
    violations = f.where("operating_period_start_date is null").select("revision_id", F.col("filename").alias("file"))
    return life.without_violations(f, violations).select("id")


@query(
    "revision_moves",
    "WITH " + _FILES_SQL + """,
pairs AS (SELECT a.id, a.revision_id, a.filename, b.rev AS brev, b.id AS bid, a.rev AS arev, a.modified = b.modified AS same
  FROM files a JOIN files b ON a.dataset_id = b.dataset_id AND a.service_code = b.service_code AND a.lines = b.lines
  WHERE a.start IS NULL AND b.start IS NOT NULL),
decisive AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY brev, bid) AS r FROM pairs WHERE same OR brev >= arev)
SELECT DISTINCT revision_id, filename FROM decisive WHERE r = 1 AND CASE WHEN same THEN brev <> arev ELSE true END""",
)
def revision_moves(t: Tables) -> DataFrame:
    f = files(t)
    is_draft = F.col("operating_period_start_date").isNull()
    return life.revision_moves(f.where(is_draft), f.where(~is_draft))


def _status(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").alias("revision_id"),
        _text("up/", key % 7, "/f", key, ".xml").alias("file_key"),
        F.when(key % 3 == 0, "failed").otherwise("succeeded").alias("status"),
        F.when(key % 3 == 0, "XML_SYNTAX").alias("error_code"),
        F.when(key % 3 == 0, _text("bad ", key)).alias("message"),
    )


@query(
    "revision_status",
    """WITH c AS (SELECT o_custkey AS revision_id, count(*) FILTER (o_orderkey % 3 <> 0) AS succeeded,
    count(*) FILTER (o_orderkey % 3 = 0) AS failed,
    count(*) FILTER (o_orderkey % 3 <> 0 AND o_orderkey % 17 = 1) AS rf FROM orders GROUP BY ALL)
SELECT revision_id, succeeded, failed, CASE WHEN succeeded = 0 OR rf > 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN succeeded = 0 THEN 'NO_VALID_FILE_TO_PROCESS' WHEN rf > 0 THEN 'SYSTEM_ERROR' END AS error_code,
  NOT (succeeded = 0 OR rf > 0) AS publishable FROM c""",
)
def revision_status(t: Tables) -> DataFrame:
    repack = t.orders.where("o_orderkey % 3 <> 0").select(
        F.col("o_custkey").alias("revision_id"),
        F.when(F.col("o_orderkey") % 17 == 1, "failed").otherwise("succeeded").alias("status"),
    )
    return life.revision_status(_status(t), repack)


@query(
    "live_pointers",
    """SELECT c_custkey AS id, coalesce(max(o_orderkey) FILTER (o_orderstatus = 'F' AND o_orderkey % 4 <> 0), c_custkey) AS live_revision_id
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def live_pointers(t: Tables) -> DataFrame:
    datasets = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("live_revision_id"))
    revisions = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("dataset_id"),
        F.when(F.col("o_orderstatus") == "F", "live").otherwise("draft").alias("status"),
        (F.col("o_orderkey") % 4 != 0).alias("is_published"),
    )
    return life.live_pointers(datasets, revisions)


@query(
    "revisions_with_violations",
    """SELECT o_custkey AS revision_id FROM orders WHERE o_orderpriority = '2-HIGH'
UNION SELECT c_custkey FROM customer WHERE c_nationkey = 3 UNION SELECT s_suppkey FROM supplier WHERE s_nationkey < 5""",
)
def revisions_with_violations(t: Tables) -> DataFrame:
    return life.revisions_with_violations(
        t.orders.where("o_orderpriority = '2-HIGH'").select(F.col("o_custkey").alias("revision_id")),
        t.customer.where("c_nationkey = 3").select(F.col("c_custkey").alias("revision_id")),
        t.supplier.where("s_nationkey < 5").select(F.col("s_suppkey").alias("revision_id")),
    )


@query(
    "stage_ledger",
    """SELECT o_custkey AS revision_id, 'up/' || (o_orderkey % 7) || '/f' || o_orderkey || '.xml' AS file_key, step,
  CASE WHEN bad THEN 'failed' ELSE 'succeeded' END AS status, CASE WHEN bad THEN code END AS error_code,
  CASE WHEN bad THEN 'bad ' || o_orderkey END AS message FROM (
  SELECT *, 'schema' AS step, 'XML_SYNTAX' AS code, o_orderkey % 3 = 0 AS bad FROM orders
  UNION ALL SELECT *, 'transform', 'SYSTEM_ERROR', o_orderkey % 10 = 1 FROM orders WHERE o_orderkey % 3 <> 0)""",
)
def stage_ledger(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    bad = key % 10 == 1
    transform = t.orders.where(key % 3 != 0).select(
        F.col("o_custkey").alias("revision_id"),
        _text("up/", key % 7, "/f", key, ".xml").alias("file_key"),
        F.when(bad, "SYSTEM_ERROR").alias("error_code"),
        F.when(bad, _text("bad ", key)).alias("message"),
    )
    return life.stage_ledger({"schema": _status(t), "transform": transform})


@query(
    "merged_statistics",
    """SELECT CAST(sum(l_quantity) FILTER (l_linenumber <> 2) AS BIGINT) AS pairs,
  count(*) FILTER (l_linenumber <> 2) AS batches, count(*) FILTER (l_linenumber = 2) AS failures FROM lineitem""",
)
def merged_statistics(t: Tables) -> DataFrame:
    results = t.lineitem.select(
        F.col("l_quantity").cast("bigint").alias("pairs"),
        F.lit(1).cast("bigint").alias("batches"),
        F.when(F.col("l_linenumber") == 2, "failed").otherwise("succeeded").alias("status"),
    )
    return life.merged_statistics(results, ["pairs", "batches"])


@query(
    "map_results",
    """WITH o AS (SELECT o_custkey AS revision_id, 'f' || o_orderkey || '.xml' AS filename, o_orderkey FROM orders)
SELECT revision_id, filename, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'succeeded' END AS status FROM o""",
)
def map_results(t: Tables) -> DataFrame:
    f = t.orders.select(
        F.col("o_custkey").alias("revision_id"), _text("f", F.col("o_orderkey"), ".xml").alias("filename")
    )
    done = _status(t).where(F.regexp_extract("file_key", r"f(\d+)\.xml", 1).cast("bigint") % 5 != 0)
    return res.map_results(f, done)


# ------------------------------------------------------------- lookups


@query(
    "resolve_stops",
    """SELECT 'F' || (l_orderkey // 100) AS file_id, 'ST' || l_partkey AS atco_code,
  CASE WHEN NOT isref THEN 'document' WHEN p_partkey IS NOT NULL THEN 'register' ELSE 'missing' END AS source,
  CASE WHEN isref THEN p_partkey END AS naptan_stop_id,
  CASE WHEN NOT isref THEN 'Doc ' || l_partkey ELSE coalesce(p_name, 'Doc ' || l_partkey) END AS common_name
FROM (SELECT DISTINCT l_orderkey // 100 * 100 AS l_orderkey, l_partkey, l_partkey % 5 <> 0 AS isref FROM lineitem)
LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 7 <> 0""",
)
def resolve_stops(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    document = t.lineitem.select(
        _text("F", F.floor(F.col("l_orderkey") / 100)).alias("file_id"),
        _text("ST", part).alias("atco_code"),
        (part % 5 != 0).alias("is_reference"),
        _text("Doc ", part).alias("common_name"),
        F.lit(None).cast("double").alias("lon"),
        F.lit(None).cast("double").alias("lat"),
    ).distinct()
    register = t.part.where("p_partkey % 7 <> 0").select(
        _text("ST", F.col("p_partkey")).alias("atco_code"),
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("common_name"),
        F.lit(0.0).alias("lon"),
        F.lit(0.0).alias("lat"),
    )
    return res.resolve_stops(document, register).drop("lon", "lat")


@query(
    "stops_by_secondary_code",
    """SELECT c_nationkey || '/' || CAST(floor(c_acctbal / 200) AS BIGINT) AS naptan_code, min('A' || c_custkey) AS atco_code
FROM customer GROUP BY 1 HAVING count(*) = 1""",
)
def stops_by_secondary_code(t: Tables) -> DataFrame:
    code = F.concat_ws("/", "c_nationkey", F.floor(F.col("c_acctbal") / 200)).alias("naptan_code")
    stops = t.customer.select(code, _text("A", F.col("c_custkey")).alias("atco_code"))
    codes = t.customer.select(code).distinct()
    return res.stops_by_secondary_code(codes, stops)


@query(
    "stop_areas",
    """SELECT 'ST' || p_partkey AS atco_code, unnest(['G' || (p_partkey % 25), 'G' || (p_partkey % 7)]) AS stop_area
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""",
)
def stop_areas(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    stops = t.part.select(
        _text("ST", key).alias("atco_code"), F.array(_text("G", key % 25), _text("G", key % 7)).alias("stop_areas")
    )
    codes = t.lineitem.where("l_quantity > 48").select(_text("ST", F.col("l_partkey")).alias("atco_code")).distinct()
    return res.stop_areas(codes, stops)


@query(
    "missing_stop_refs",
    """SELECT DISTINCT l_orderkey // 100 AS file_id, 'ST' || l_partkey AS stop_ref FROM lineitem WHERE l_partkey % 9 = 0""",
)
def missing_stop_refs(t: Tables) -> DataFrame:
    refs = t.lineitem.select(
        F.floor(F.col("l_orderkey") / 100).alias("file_id"), _text("ST", F.col("l_partkey")).alias("stop_ref")
    ).distinct()
    stops = t.part.where("p_partkey % 9 <> 0").select(_text("ST", F.col("p_partkey")).alias("atco_code"))
    return res.missing_stop_refs(refs, stops)


@query(
    "service_regions",
    """WITH reg AS (SELECT o_orderkey AS id, 'PD' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '/1' AS registration_number,
    CASE o_orderkey % 3 WHEN 0 THEN 'WECA' WHEN 1 THEN 'EP' END AS api_type, CAST(o_custkey % 30 AS VARCHAR) AS atco FROM orders),
  area AS (SELECT n_nationkey, substr(r_name, 1, 1) AS region, CAST(n_nationkey // 2 AS VARCHAR) AS atco, n_nationkey % 6 AS lta
    FROM nation JOIN region ON n_regionkey = r_regionkey),
  auth AS (SELECT o_orderkey AS id, o_orderkey % 8 AS lta FROM orders UNION ALL SELECT o_orderkey, (o_orderkey + 1) % 4 FROM orders),
  x AS (SELECT atco, string_agg(DISTINCT region, '|' ORDER BY region) AS r FROM area GROUP BY atco),
  y AS (SELECT id, string_agg(DISTINCT region, '|' ORDER BY region) AS r FROM auth JOIN area USING (lta) GROUP BY id),
  z AS (SELECT reg.id, registration_number, api_type, CASE WHEN api_type IN ('WECA', 'EP') THEN x.r ELSE y.r END AS traveline_region
    FROM reg LEFT JOIN x USING (atco) LEFT JOIN y ON y.id = reg.id)
SELECT id, registration_number, api_type, traveline_region, coalesce(traveline_region = 'S', false) AS is_scottish FROM z""",
)
def service_regions(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    registrations = t.orders.select(
        key.alias("id"),
        _text("PD", F.lpad(key.cast("string"), 7, "0"), "/1").alias("registration_number"),
        F.when(key % 3 == 0, "WECA").when(key % 3 == 1, "EP").alias("api_type"),
        (F.col("o_custkey") % 30).cast("string").alias("atco_code"),
    )
    areas = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.substring("r_name", 1, 1).alias("traveline_region_id"),
        F.floor(F.col("n_nationkey") / 2).cast("string").alias("atco_code"),
        (F.col("n_nationkey") % 6).cast("bigint").alias("ui_lta_id"),
    )
    authorities = t.orders.select(
        key.alias("registration_id"), F.explode(F.array(key % 8, (key + 1) % 4)).alias("ui_lta_id")
    )
    return res.service_regions(registrations, authorities, areas)


@query(
    "published_service_clashes",
    """WITH rev AS (SELECT o_orderkey AS id, o_custkey AS ds, o_orderstatus = 'F' AND o_orderkey % 4 <> 0 AS live FROM orders),
  attr AS (SELECT l_orderkey AS rid, 'S' || (l_partkey % 300) AS code FROM lineitem),
  ptr AS (SELECT ds, max(id) AS rid FROM rev WHERE live GROUP BY ds),
  hit AS (SELECT DISTINCT rid FROM attr JOIN rev ON rev.id = rid AND live
    WHERE code IN (SELECT 'S' || (p_partkey % 300) FROM part WHERE p_size = 7))
SELECT DISTINCT ds AS dataset_id, code AS service_code FROM attr JOIN ptr USING (rid) WHERE rid IN (SELECT rid FROM hit)""",
)
def published_service_clashes(t: Tables) -> DataFrame:
    revisions = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("dataset_id"),
        F.when(F.col("o_orderstatus") == "F", "live").otherwise("draft").alias("status"),
        (F.col("o_orderkey") % 4 != 0).alias("is_published"),
    )
    live = revisions.where("status = 'live' and is_published")
    datasets = live.groupBy("dataset_id").agg(F.max("id").alias("live_revision_id")).withColumnRenamed("dataset_id", "id")
    attributes = t.lineitem.select(
        F.col("l_orderkey").alias("revision_id"), _text("S", F.col("l_partkey") % 300).alias("service_code")
    )
    incoming = t.part.where("p_size = 7").select(
        _text("S", F.col("p_partkey") % 300).alias("service_code")
    )
    return res.published_service_clashes(incoming, attributes, revisions, datasets)


_FARES_STOPS_SQL = """WITH stops AS (SELECT 'ST' || p_partkey AS atco, 'N' || (p_partkey // 2 + CASE WHEN p_partkey % 6 = 1 THEN 1000000 ELSE 0 END) AS ncode, p_partkey,
    CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'X' || p_partkey END AS private FROM part),
  refs AS (SELECT DISTINCT l_orderkey // 50 AS file_id, CASE WHEN l_linenumber % 2 = 0 THEN 'ST' || (l_partkey * 2 % 5000) END AS atco,
    CASE WHEN l_linenumber % 2 = 1 THEN 'N' || (l_partkey // 2) END AS ncode FROM lineitem),
  uniq AS (SELECT ncode, min(private) AS private FROM stops GROUP BY ncode HAVING count(*) = 1),
  found AS (SELECT DISTINCT file_id, CAST(private AS BIGINT) AS stop_id FROM (
    SELECT file_id, private FROM refs JOIN stops USING (atco)
    UNION ALL SELECT file_id, private FROM refs JOIN uniq USING (ncode)) WHERE private NOT LIKE 'X%')
"""


def _fares_stops(t: Tables) -> tuple[DataFrame, DataFrame]:
    key, part, n = F.col("p_partkey"), F.col("l_partkey"), F.col("l_linenumber")
    shift = F.when(key % 6 == 1, 1000000).otherwise(0)
    stops = t.part.select(
        _text("ST", key).alias("atco_code"),
        _text("N", F.floor(key / 2) + shift).alias("naptan_code"),
        F.when(key % 2 == 0, key.cast("string")).otherwise(_text("X", key)).alias("private_code"),
    )
    refs = t.lineitem.select(
        F.floor(F.col("l_orderkey") / 50).alias("file_id"),
        F.when(n % 2 == 0, _text("ST", part * 2 % 5000)).alias("atco_code"),
        F.when(n % 2 == 1, _text("N", F.floor(part / 2))).alias("naptan_code"),
    )
    return refs, stops


@query("fares_stop_ids", _FARES_STOPS_SQL + "SELECT file_id, stop_id FROM found")
def fares_stop_ids(t: Tables) -> DataFrame:
    return res.fares_stop_ids(*_fares_stops(t))


@query(
    "fares_stop_shortfall",
    _FARES_STOPS_SQL + """, w AS (SELECT file_id, count(DISTINCT coalesce(atco, ncode)) AS wanted FROM refs GROUP BY ALL),
  f AS (SELECT file_id, count(*) AS n FROM found GROUP BY ALL)
SELECT w.file_id, wanted, coalesce(n, 0) AS found FROM w LEFT JOIN f USING (file_id) WHERE coalesce(n, 0) < wanted""",
)
def fares_stop_shortfall(t: Tables) -> DataFrame:
    refs, stops = _fares_stops(t)
    return res.fares_stop_shortfall(refs, res.fares_stop_ids(refs, stops))


@query(
    "rows_by_key",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def rows_by_key(t: Tables) -> DataFrame:
    ids = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return res.semi_filter(t.lineitem, ids, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "delete_by_key",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def delete_by_key(t: Tables) -> DataFrame:
    gone = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return res.delete_by(t.orders, gone, ["o_custkey"]).select("o_orderkey", "o_totalprice")


@query(
    "update_by_key",
    """SELECT c_custkey, coalesce(s_name, c_name) AS c_name, CASE WHEN s_suppkey IS NOT NULL AND s_suppkey % 3 <> 0 THEN s_acctbal ELSE c_acctbal END AS c_acctbal
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""",
)
def update_by_key(t: Tables) -> DataFrame:
    changes = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("c_acctbal"),
    )
    return res.update_by(t.customer.select("c_custkey", "c_name", "c_acctbal"), changes, ["c_custkey"])


@query(
    "insert_or_ignore",
    """SELECT c_custkey AS k, 'old' AS state FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def insert_or_ignore(t: Tables) -> DataFrame:
    old = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), F.lit("old").alias("state"))
    new = t.orders.select(F.col("o_custkey").alias("k"), F.lit("new").alias("state"))
    return rollup.insert_or_ignore(old, new, ["k"])


@query(
    "insert_or_update",
    """WITH n AS (SELECT o_custkey AS k, max_by(o_totalprice, o_orderkey) AS v, max(o_orderkey) AS ver FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL)
SELECT coalesce(n.k, c_custkey) AS k, coalesce(n.v, c_acctbal) AS v, coalesce(n.ver, 0) AS ver FROM customer FULL JOIN n ON n.k = c_custkey""",
)
def insert_or_update(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.lit(0).cast("bigint").alias("ver"))
    new = t.orders.where("o_orderkey % 2 = 0").select(
        F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("ver")
    )
    return rollup.insert_or_update(old, new, ["k"], "ver")


# ---------------------------------------------------------- text rules


@query(
    "text_rules",
    r"""WITH d AS (SELECT doc_id, text, string_split_regex(text, '\s+') AS words FROM documents)
SELECT doc_id, regexp_matches(text, '[,\[\]{}^=@:;#$£?%+<>«»\\/|~_¬]') AS prohibited,
  regexp_matches(text, '[\\/]') AS path_separator,
  len(list_filter(words, lambda w: regexp_matches(w, '(?i)^(\d{1,4}[-/.]\d{1,2}([-/.]\d{1,4})?|\d{1,2}:\d{2}(:\d{2})?([ap]m)?|\d{1,2}[ap]m|(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)\.?,?|(mon(day)?|tues?(day)?|wed(nesday)?|thu(rs|rsday)?|fri(day)?|sat(urday)?|sun(day)?)\.?,?|\d{1,2}(st|nd|rd|th)?[-/.]?(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)([-/.]?\d{2,4})?|(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)[-/.]?\d{1,4})$') AND NOT regexp_matches(w, '^\d+$'))) > 0 AS has_date,
  length(trim(text)) >= 5 AS long_enough FROM d""",
)
def text_rules(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.documents.select(
        "doc_id",
        txt.has_prohibited_characters(c).alias("prohibited"),
        txt.has_path_separator(c).alias("path_separator"),
        txt.contains_date(c).alias("has_date"),
        (F.length(F.trim(c)) >= 5).alias("long_enough"),
    )


@query(
    "xml_safety",
    """SELECT page_id, regexp_matches(html, '<!(DOCTYPE|ENTITY)') AS unsafe,
  coalesce(nullif(regexp_extract(html, '<(?:\\w+:)?([A-Za-z]\\w*)[\\s>/]', 1), ''), '') AS root FROM pages
UNION ALL SELECT -doc_id - 1, regexp_matches(text, '<!(DOCTYPE|ENTITY)'),
  coalesce(nullif(regexp_extract(text, '<(?:\\w+:)?([A-Za-z]\\w*)[\\s>/]', 1), ''), '') FROM documents""".replace("\\\\", "\\"),
)
def xml_safety(t: Tables) -> DataFrame:
    both = t.pages.select("page_id", F.col("html").alias("text")).unionByName(
        t.documents.select((-F.col("doc_id") - 1).alias("page_id"), "text")
    )
    c = F.col("text")
    return both.select("page_id", txt.is_unsafe_xml(c).alias("unsafe"), txt.document_type(c).alias("root"))


@query(
    "post_schema_results",
    """SELECT doc_id AS file_id, 'PII_ERROR' AS error_code, text AS details FROM documents WHERE regexp_matches(text, '[\\\\/]')
UNION ALL SELECT DISTINCT d.doc_id, 'SERVICE EXISTS', CAST(l.quality AS VARCHAR) FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1""",
)
def post_schema_results(t: Tables) -> DataFrame:
    names = t.documents.select(F.col("doc_id").alias("file_id"), F.col("text").alias("filename"))
    clashes = t.labels.where("toxic = 1").select(F.col("doc_id").alias("file_id"), F.col("quality").alias("dataset_id"))
    return life.post_schema_results(names, clashes)
