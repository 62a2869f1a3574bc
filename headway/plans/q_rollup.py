"""Registered queries: revision, fares and corpus roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import text as txt
from headway.operators import patterns as pat
from headway.operators import rollup
from headway.plans.q_lifecycle import _FILES_SQL, files
from headway.plans.registry import Tables, query


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query(
    "revision_stats",
    "WITH " + _FILES_SQL + """,
a AS (SELECT revision_id, min(created) AS first_creation_datetime, max(modified) AS last_modification_datetime FROM files GROUP BY ALL),
b AS (SELECT revision_id, min(start) AS first_service_start, min(d + 200) AS first_expiring_service, max(d + 200) AS last_expiring_service FROM files GROUP BY ALL)
SELECT * FROM a FULL JOIN b USING (revision_id)""",
)
def revision_stats(t: Tables) -> DataFrame:
    f = files(t)
    services = f.select(
        "revision_id",
        F.col("operating_period_start_date").alias("start_date"),
        F.col("operating_period_end_date").alias("end_date"),
    )
    return rollup.revision_stats(f, services)


@query(
    "distinct_per_revision",
    """SELECT DISTINCT l_suppkey % 100 AS revision_id, 'E' || (l_partkey % 40) AS locality_id FROM lineitem WHERE l_partkey % 4 <> 0""",
)
def distinct_per_revision(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    bridge = t.lineitem.select(
        F.col("l_orderkey").alias("o"), F.col("l_suppkey"),
        F.when(part % 4 != 0, _text("E", part % 40)).alias("locality_id"),
    ).select(_text("P", F.col("l_suppkey")).alias("service_pattern_id"), "locality_id").distinct()
    patterns = t.supplier.select(
        _text("P", F.col("s_suppkey")).alias("service_pattern_id"), (F.col("s_suppkey") % 100).alias("revision_id")
    )
    return rollup.distinct_per_revision(bridge, patterns, "locality_id")


@query(
    "file_attributes",
    """WITH s AS (SELECT l_orderkey AS f, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey AS pos, CAST(l_shipdate AS DATE) AS d,
    'C' || l_suppkey AS code, l_returnflag AS fl, l_quantity AS q FROM lineitem),
  g AS (SELECT f, min(d) AS s, max(d + 30) AS e, min_by(code, pos) AS code, min_by(q > 25, pos) AS pu, min_by(CASE fl WHEN 'A' THEN 'coach' WHEN 'N' THEN 'rail' END, pos) AS m,
    min_by('from ' || code, pos) FILTER (fl <> 'R') AS o, min_by('to ' || code, pos) FILTER (fl <> 'R') AS x FROM s GROUP BY f)
SELECT o_orderkey AS file_id, 'P' || substr(o_orderpriority, 1, 1) AS national_operator_code,
  coalesce((SELECT string_agg('L' || code, '|' ORDER BY pos) FROM s WHERE s.f = o_orderkey), '') AS line_names,
  g.s AS operating_period_start_date, g.e AS operating_period_end_date, coalesce(o, '') AS origin, coalesce(x, '') AS destination,
  g.code AS service_code, pu AS public_use, coalesce(m, 'bus') AS service_mode
FROM orders JOIN g ON g.f = o_orderkey WHERE o_orderstatus <> 'P'""",
)
def file_attributes(t: Tables) -> DataFrame:
    pos = F.col("l_linenumber") * F.lit(100000000).cast("bigint") + F.col("l_partkey") * 1000 + F.col("l_suppkey")
    flag, code, day = F.col("l_returnflag"), _text("C", F.col("l_suppkey")), F.col("l_shipdate").cast("date")
    services = t.lineitem.select(
        F.col("l_orderkey").alias("file_id"),
        pos.alias("service_pos"),
        code.alias("service_code"),
        (F.col("l_quantity") > 25).alias("public_use"),
        F.when(flag == "A", "coach").when(flag == "N", "rail").alias("mode"),
        day.alias("start_date"),
        F.date_add(day, 30).alias("end_date"),
        F.when(flag != "R", F.concat(F.lit("from "), code)).alias("origin"),
        F.when(flag != "R", F.concat(F.lit("to "), code)).alias("destination"),
    )
    lines = services.select("file_id", "service_pos", F.lit(0).alias("line_pos"), _text("L", F.col("service_code")).alias("line_name"))
    metadata = t.orders.select(
        F.col("o_orderkey").alias("file_id"),
        F.when(F.col("o_orderstatus") == "P", "2.1").otherwise("2.4").alias("schema_version"),
    )
    operators = t.orders.select(
        F.col("o_orderkey").alias("file_id"),
        F.lit(0).alias("operator_pos"),
        _text("P", F.substring("o_orderpriority", 1, 1)).alias("noc"),
        F.lit(None).cast("string").alias("licence_number"),
    )
    out = rollup.file_attributes(metadata, services, lines, operators)
    return out.withColumn("line_names", F.array_join("line_names", "|")).drop("schema_version", "licence_number")


@query(
    "run_statistics",
    """SELECT l_orderkey // 100 AS file_id, count(*) AS service_patterns, CAST(sum(l_quantity) AS BIGINT) AS stops,
  CAST(sum(CASE WHEN l_linenumber < 5 THEN l_partkey % 9 ELSE 0 END) AS BIGINT) AS tracks FROM lineitem GROUP BY ALL""",
)
def run_statistics(t: Tables) -> DataFrame:
    patterns = t.lineitem.select(
        F.floor(F.col("l_orderkey") / 100).alias("file_id"),
        F.col("l_quantity").cast("bigint").alias("stops"),
        F.when(F.col("l_linenumber") < 5, F.col("l_partkey") % 9).alias("tracks"),
    )
    return rollup.run_statistics(patterns, ["stops", "tracks"])


@query(
    "booking_arrangements",
    """SELECT conv_id % 20 AS file_id, role AS service_code, text AS description, CAST(NULL AS VARCHAR) AS email,
  CAST(length(text) % 5 AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS web_address, min(conv_id * 1000 + turn) AS ordinal
FROM conversations GROUP BY ALL""",
)
def booking_arrangements(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = t.conversations.select(
        (F.col("conv_id") % 20).alias("file_id"),
        F.col("role").alias("service_code"),
        F.col("text").alias("description"),
        none.alias("email"),
        (F.length("text") % 5).cast("string").alias("phone"),
        none.alias("web_address"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
    )
    return pat.booking_arrangements(rows)


# --------------------------------------------------------------- fares

_TYPES = ("dayPass", "periodPass", "singleTrip", "dayReturnTrip", "other")
_USERS = ("adult", "child", "senior")


def _pick(values: tuple, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _sql_pick(values: tuple, index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{index} + 1]"


def _fares_frames(t: Tables) -> dict[str, DataFrame]:
    """An order is a fares file; its line items are its lines, zones, products."""
    li = t.lineitem.withColumn("file_id", F.col("l_orderkey"))
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    product = li.select(
        "file_id",
        _pick(_TYPES, part % 5).alias("product_type"),
        F.when(part % 9 != 0, _text("Product ", part % 50)).alias("name"),
    )
    return {
        "files": t.orders.select(
            F.col("o_orderkey").alias("file_id"), F.when(F.col("o_orderkey") % 4 != 0, "1.1").alias("schema_version")
        ),
        "lines": li.where("l_linenumber <= 3").select(
            "file_id", _text("LN", part % 30).alias("line_id"), F.when(supp % 4 != 0, _text("P", supp % 12)).alias("public_code")
        ),
        "fare_zones": li.where("l_quantity > 20").select("file_id"),
        "sales_offer_packages": li.where("l_tax > 0.04").select("file_id"),
        "fare_frames": li.select("file_id", F.col("l_quantity").cast("bigint").alias("num_of_fare_products")),
        "user_profiles": li.where("l_discount > 0.03").select("file_id", _pick(_USERS, supp % 3).alias("user_type")),
        "fare_products": product,
        "tariff_validity": li.where("l_linenumber % 2 = 0").select(
            "file_id", F.col("l_shipdate").alias("from_date"), F.when(part % 3 != 0, F.col("l_shipdate") + F.expr("INTERVAL 40 DAYS")).alias("to_date")
        ),
        "composite_frames": li.where("l_linenumber <= 4").select(
            "file_id",
            F.when(part % 3 == 0, "epd:UK_PI_METADATA_OFFER:x").otherwise("epd:UK:FARES:x").alias("frame_id"),
            F.col("l_shipdate").alias("from_date"),
            (F.col("l_shipdate") + F.expr("INTERVAL 9 DAYS")).alias("to_date"),
        ),
        "operators": li.select("file_id", _text("OP", supp % 15).alias("public_code")),
        "stop_areas": li.select(
            "file_id", F.explode(txt.area_codes(F.array(_text("atco:", F.lpad((part % 90).cast("string"), 3, "0"), "9"), _text("naptan:", part)))).alias("area_code")
        ),
        "tariffs": li.select("file_id", F.when(supp % 5 != 0, _pick(("flat", "zone", "distance"), part % 3)).alias("tariff_basis")),
    }


@query(
    "fares_file_metadata",
    f"""SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 4 <> 0 THEN '1.1' END AS schema_version,
  count(l_orderkey) FILTER (l_linenumber <= 3) AS num_of_lines, count(l_orderkey) FILTER (l_quantity > 20) AS num_of_fare_zones,
  count(l_orderkey) FILTER (l_tax > 0.04) AS num_of_sales_offer_packages, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS num_of_fare_products,
  count(DISTINCT l_suppkey % 3) FILTER (l_discount > 0.03) AS num_of_user_profiles,
  count(DISTINCT l_partkey % 5) FILTER (l_partkey % 5 < 2) AS num_of_pass_products,
  count(DISTINCT l_partkey % 5) FILTER (l_partkey % 5 IN (2, 3)) AS num_of_trip_products,
  min(l_shipdate) FILTER (l_linenumber % 2 = 0) AS valid_from,
  max(l_shipdate + INTERVAL 40 DAY) FILTER (l_linenumber % 2 = 0 AND l_partkey % 3 <> 0) AS valid_to
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def fares_file_metadata(t: Tables) -> DataFrame:
    return rollup.fares_file_metadata(_fares_frames(t))


@query(
    "fares_catalogue",
    f"""WITH x AS (SELECT o_orderkey AS file_id, lineitem.*, {_sql_pick(_TYPES, 'l_partkey % 5')} AS ptype,
  {_sql_pick(_USERS, 'l_suppkey % 3')} AS utype, {_sql_pick(('flat', 'zone', 'distance'), 'l_partkey % 3')} AS basis
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
SELECT file_id, CAST(min(l_shipdate) FILTER (l_linenumber <= 4 AND l_partkey % 3 <> 0) AS DATE) AS valid_from,
  CAST(max(l_shipdate + INTERVAL 9 DAY) FILTER (l_linenumber <= 4 AND l_partkey % 3 <> 0) AS DATE) AS valid_to,
  string_agg(DISTINCT 'OP' || (l_suppkey % 15), '|' ORDER BY 'OP' || (l_suppkey % 15)) AS national_operator_code,
  string_agg('LN' || (l_partkey % 30), '|' ORDER BY 'LN' || (l_partkey % 30)) FILTER (l_linenumber <= 3) AS line_id,
  coalesce(string_agg('P' || (l_suppkey % 12), '|' ORDER BY 'P' || (l_suppkey % 12)) FILTER (l_linenumber <= 3 AND l_suppkey % 4 <> 0),
    CASE WHEN count(*) FILTER (l_linenumber <= 3) > 0 THEN '' END) AS line_name,
  string_agg(DISTINCT CAST(l_partkey % 90 AS VARCHAR), '|' ORDER BY CAST(l_partkey % 90 AS VARCHAR)) AS atco_area,
  coalesce(string_agg(DISTINCT basis, '|' ORDER BY basis) FILTER (l_suppkey % 5 <> 0), CASE WHEN count(l_orderkey) > 0 THEN '' END) AS tariff_basis,
  string_agg(DISTINCT ptype, '|' ORDER BY ptype) AS product_type,
  coalesce(string_agg(DISTINCT 'Product ' || (l_partkey % 50), '|' ORDER BY 'Product ' || (l_partkey % 50)) FILTER (l_partkey % 9 <> 0), CASE WHEN count(l_orderkey) > 0 THEN '' END) AS product_name,
  string_agg(utype, '|' ORDER BY utype) FILTER (l_discount > 0.03) AS user_type
FROM x GROUP BY file_id""",
)
def fares_catalogue(t: Tables) -> DataFrame:
    out = rollup.fares_catalogue(_fares_frames(t))
    arrays = [c for c, kind in out.dtypes if kind.startswith("array")]
    as_text = {c: F.array_join(F.array_sort(F.col(c).cast("array<string>")), "|") for c in arrays}
    return out.withColumns(as_text)


def _fares_files(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").alias("revision_id"),
        key.alias("file_id"),
        F.when(key % 4 == 0, "1.1").when(key % 4 == 1, "1.2").alias("schema_version"),
        (key % 7).alias("num_of_lines"),
        (key % 5).alias("num_of_fare_zones"),
        (key % 3).alias("num_of_sales_offer_packages"),
        (key % 11).alias("num_of_fare_products"),
        F.array(_pick(_USERS, key % 3), _pick(_USERS, key % 2)).alias("user_types"),
        F.array(_pick(_TYPES, key % 5), _pick(_TYPES, key % 4)).alias("product_types"),
        F.col("o_orderdate").alias("valid_from"),
        F.when(key % 6 != 0, F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("valid_to"),
    )


@query(
    "fares_revision",
    """SELECT o_custkey AS revision_id, CAST(sum(o_orderkey % 7) AS BIGINT) AS num_of_lines, CAST(sum(o_orderkey % 5) AS BIGINT) AS num_of_fare_zones,
  CAST(sum(o_orderkey % 3) AS BIGINT) AS num_of_sales_offer_packages, CAST(sum(o_orderkey % 11) AS BIGINT) AS num_of_fare_products,
  min(o_orderdate) AS valid_from, max(o_orderdate + INTERVAL 90 DAY) FILTER (o_orderkey % 6 <> 0) AS valid_to,
  coalesce(min(CASE o_orderkey % 4 WHEN 0 THEN '1.1' WHEN 1 THEN '1.2' END), '1.1') AS schema_version,
  len(list_distinct(flatten(list([o_orderkey % 3, o_orderkey % 2])))) AS num_of_user_profiles,
  len(list_filter(list_distinct(flatten(list([o_orderkey % 5, o_orderkey % 4]))), lambda v: v < 2)) AS num_of_pass_products,
  len(list_filter(list_distinct(flatten(list([o_orderkey % 5, o_orderkey % 4]))), lambda v: v IN (2, 3))) AS num_of_trip_products
FROM orders GROUP BY o_custkey""",
)
def fares_revision(t: Tables) -> DataFrame:
    return rollup.fares_revision(_fares_files(t))


@query(
    "lowest_schema_version",
    """SELECT o_custkey AS revision_id, coalesce(min(CASE o_orderkey % 4 WHEN 0 THEN '1.1' WHEN 1 THEN '1.2' END), '1.1') AS schema_version
FROM orders GROUP BY o_custkey""",
)
def lowest_schema_version(t: Tables) -> DataFrame:
    return rollup.lowest_schema_version(_fares_files(t))


@query(
    "fares_violation_report",
    """SELECT l_suppkey AS revision_id, count(*) AS violations, count(DISTINCT l_orderkey) AS files,
  'validation_report_' || l_suppkey || '.csv' AS report_name FROM lineitem WHERE l_tax > 0.06 GROUP BY l_suppkey""",
)
def fares_violation_report(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_tax > 0.06").select(
        F.col("l_suppkey").alias("revision_id"), F.col("l_orderkey").alias("file")
    )
    return rollup.fares_violation_report(rows)


# -------------------------------------------------------------- corpus


def _host(url):
    return F.regexp_extract(url, r"^https?://([^/]+)", 1)


def _corpus(t: Tables) -> DataFrame:
    return t.pages.select(
        F.when(F.col("page_id") % 10 != 0, _host("url")).alias("archive"),
        F.col("page_id").alias("file_id"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.col("html").alias("text"),
    )


_HOST = "CASE WHEN page_id % 10 <> 0 THEN regexp_extract(url, '^https?://([^/]+)', 1) ELSE 'root' END"


@query(
    "corpus_size_report",
    f"""SELECT {_HOST} AS archive, count(*) AS files, CAST(sum(octet_length(encode(html))) AS BIGINT) AS total_size,
  round(avg(octet_length(encode(html))), 2) AS average_size FROM pages GROUP BY ALL""",
)
def corpus_size_report(t: Tables) -> DataFrame:
    return rollup.size_report(_corpus(t))


@query(
    "corpus_tag_report",
    rf"""SELECT {_HOST} AS archive, page_id AS file_id, CAST(len(regexp_extract_all(html, '<(\w+:)?p[\s/>]')) AS INTEGER) AS occurrences FROM pages""",
)
def corpus_tag_report(t: Tables) -> DataFrame:
    return rollup.tag_report(_corpus(t), "p")


@query("files_with_tag", r"SELECT page_id AS file_id FROM pages WHERE regexp_matches(html, '<(\w+:)?ul[\s/>]')")
def files_with_tag(t: Tables) -> DataFrame:
    return rollup.files_with_tag(_corpus(t), "ul").select("file_id")


@query(
    "path_search",
    r"""WITH e AS (SELECT page_id, unnest(l) AS element, generate_subscripts(l, 1) - 1 AS ordinal FROM
  (SELECT page_id, regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?(?:/>|>.*?</p>)') AS l FROM pages))
SELECT page_id AS file_id, CAST(ordinal AS INTEGER) AS ordinal, nullif(regexp_extract(element, '^<[^>]*\bid="([^"]*)"', 1), '') AS identifier,
  regexp_matches(element, '<(\w+:)?a[\s/>]') AS has_child FROM e""",
)
def path_search(t: Tables) -> DataFrame:
    return rollup.path_search(_corpus(t), "p", "a").drop("element")


@query(
    "archive_manifest",
    """SELECT doc_id % 60 AS archive, bool_or(source IN (SELECT min(source) FROM documents)) AS has_nested_archive,
  CAST(sum(n_chars) AS BIGINT) > 40000 AS too_large, NOT bool_or(lang = 'en' AND doc_id % 4 = 0) AS no_documents,
  CAST(sum(n_chars) AS BIGINT) AS total_size FROM documents GROUP BY ALL""",
)
def archive_manifest(t: Tables) -> DataFrame:
    first = t.documents.agg(F.min("source").alias("source")).withColumn("nested", F.lit(True))
    ext = F.when(F.col("nested"), ".zip").when((F.col("lang") == "en") & (F.col("doc_id") % 4 == 0), ".XML").otherwise(".txt")
    members = t.documents.join(first, "source", "left").select(
        (F.col("doc_id") % 60).alias("archive"), _text("m", F.col("doc_id"), ext).alias("member"), F.col("n_chars").alias("size"),
        "nested", "lang", "doc_id",
    )
    # One document is one member; an English one also counts as a document file.
    xml = members.where("nested and lang = 'en' and doc_id % 4 = 0").select("archive", F.lit("d.xml").alias("member"), F.lit(0).cast("bigint").alias("size"))
    return rollup.archive_manifest(members.select("archive", "member", "size").unionByName(xml), limit=40000)
