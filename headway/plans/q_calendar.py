"""Registered queries: operating calendars.

An order is a journey whose profile follows from its priority, date and key;
nations are bank holidays; a hundred orders are a file with one service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import resolve as res
from headway.plans.registry import Tables, query

# Weekday sets by order priority, and the same in SQL.
_REGULAR = {
    "1-URGENT": (1, 2, 3, 4, 5),
    "2-HIGH": (6, 7),
    "3-MEDIUM": (1, 2, 3, 4, 5, 6, 7),
    "4-NOT SPECIFIED": (2, 4),
}


def _file():
    return F.concat(F.lit("F"), F.floor(F.col("o_orderkey") / 100))


def _journeys(t: Tables) -> DataFrame:
    return t.orders.select(_file().alias("file_id"), F.concat(F.lit("VJ"), "o_orderkey").alias("vj_code"))


def _profiles(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")

    def flag(n: int):
        return F.col("o_orderpriority").isin(*[p for p, d in _REGULAR.items() if n in d])

    days = F.struct(*[flag(i).alias(n) for i, n in enumerate(cal.WEEKDAYS, 1)])
    span = F.struct(day.alias("start"), F.date_add(day, (key % 9 - 1).cast("int")).alias("end"))
    off = F.struct(
        F.date_add(day, 5).alias("start"), F.date_add(day, (key % 6 + 4).cast("int")).alias("end")
    )
    names = F.array(F.concat(F.lit("H"), key % 5), F.concat(F.lit("H"), key % 3))
    return t.orders.select(
        _file().alias("file_id"),
        F.when(key % 10 == 3, "service").otherwise("journey").alias("owner_kind"),
        F.concat(F.lit("VJ"), key).alias("owner_id"),
        key.cast("int").alias("owner_pos"),
        days.alias("days"),
        F.array(span, F.struct(F.date_add(day, 2).alias("start"), F.date_add(day, 3).alias("end"))).alias("special_operation"),
        F.array(off).alias("special_non_operation"),
        F.when(key % 2 == 0, names).alias("bank_operation"),
        F.when(key % 3 == 0, names).alias("bank_non_operation"),
        F.array(
            F.struct(
                F.array(F.concat(F.lit("O"), key % 7)).alias("working_days"),
                F.array(F.concat(F.lit("O"), key % 4)).alias("holidays"),
            )
        ).alias("so_operation"),
        F.array(
            F.struct(
                F.array(F.concat(F.lit("O"), key % 3)).alias("working_days"),
                F.lit(None).cast("array<string>").alias("holidays"),
            )
        ).alias("so_non_operation"),
    )


def _services(t: Tables) -> DataFrame:
    first = t.orders.groupBy(_file().alias("file_id")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("start_date"),
        F.min("o_orderkey").alias("k"),
    )
    end = F.when(F.col("k") % 300 != 0, F.date_add("start_date", 900))
    return first.select(
        "file_id", F.lit("SV").alias("service_code"), F.lit(0).alias("service_pos"), "start_date", end.alias("end_date")
    )


def _holidays(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("H"), "n_regionkey").alias("txc_element"),
        F.date_add(F.lit("1995-01-06").cast("date"), (F.col("n_nationkey") * 71).cast("int")).alias("date"),
        F.when(F.col("n_nationkey") % 4 == 0, "scotland").otherwise("england-and-wales").alias("division"),
    )


_BASE_SQL = """
p AS (SELECT o_orderkey AS k, 'F' || (o_orderkey // 100) AS file_id, 'VJ' || o_orderkey AS vj_code,
    CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr, o_orderkey % 10 = 3 AS is_service FROM orders),
fallback AS (SELECT file_id, min(k) AS sk FROM p WHERE is_service GROUP BY file_id),
profile AS (SELECT p.file_id, p.vj_code, p.k, q.k AS pk, q.d, q.pr
  FROM p LEFT JOIN fallback f ON f.file_id = p.file_id
  JOIN p q ON q.k = CASE WHEN p.is_service THEN f.sk ELSE p.k END),
weekday AS (SELECT * FROM (VALUES ('1-URGENT', 1), ('1-URGENT', 2), ('1-URGENT', 3), ('1-URGENT', 4), ('1-URGENT', 5),
    ('2-HIGH', 6), ('2-HIGH', 7), ('3-MEDIUM', 1), ('3-MEDIUM', 2), ('3-MEDIUM', 3), ('3-MEDIUM', 4), ('3-MEDIUM', 5),
    ('3-MEDIUM', 6), ('3-MEDIUM', 7), ('4-NOT SPECIFIED', 2), ('4-NOT SPECIFIED', 4)) v(pr, dow)),
svc AS (SELECT 'F' || (o_orderkey // 100) AS file_id, min(CAST(o_orderdate AS DATE)) AS s,
    CASE WHEN min(o_orderkey) % 300 <> 0 THEN min(CAST(o_orderdate AS DATE)) + 900 END AS e FROM orders GROUP BY ALL)
"""
_EXCEPTIONS_SQL = _BASE_SQL + """,
hol AS (SELECT 'H' || n_regionkey AS name, DATE '1995-01-06' + n_nationkey * 71 AS date,
    CASE WHEN n_nationkey % 4 = 0 THEN 'scotland' ELSE 'england-and-wales' END AS division FROM nation),
days AS (
  SELECT file_id, vj_code, pr, unnest(generate_series(d, d + CAST(pk % 9 - 1 AS INTEGER), INTERVAL 1 DAY))::DATE AS date, true AS operates FROM profile
  UNION ALL SELECT file_id, vj_code, pr, unnest(generate_series(d + 2, d + 3, INTERVAL 1 DAY))::DATE, true FROM profile
  UNION ALL SELECT file_id, vj_code, pr, unnest(generate_series(d + 5, d + CAST(pk % 6 + 4 AS INTEGER), INTERVAL 1 DAY))::DATE, false FROM profile
  UNION ALL SELECT x.file_id, vj_code, pr, hol.date, operates FROM (
      SELECT file_id, vj_code, pr, 'H' || (pk % 5) AS name, true AS operates FROM profile WHERE pk % 2 = 0
      UNION ALL SELECT file_id, vj_code, pr, 'H' || (pk % 3), true FROM profile WHERE pk % 2 = 0
      UNION ALL SELECT file_id, vj_code, pr, 'H' || (pk % 5), false FROM profile WHERE pk % 3 = 0
      UNION ALL SELECT file_id, vj_code, pr, 'H' || (pk % 3), false FROM profile WHERE pk % 3 = 0) x
    JOIN hol ON hol.name = x.name AND hol.division = 'england-and-wales'
    JOIN svc ON svc.file_id = x.file_id AND hol.date >= s AND (e IS NULL OR hol.date <= e)),
exceptions AS (SELECT DISTINCT file_id, vj_code, date, operates FROM days
  WHERE operates <> EXISTS (SELECT 1 FROM weekday w WHERE w.pr = days.pr AND w.dow = isodow(days.date)))
"""


def _effective(t: Tables) -> DataFrame:
    return res.effective_profiles(_journeys(t), _profiles(t))


def _exceptions(t: Tables) -> DataFrame:
    return cal.exceptions(_effective(t), _services(t), _holidays(t), ["england-and-wales"])


@query(
    "weekday_rows",
    "WITH " + _BASE_SQL + """
SELECT file_id, vj_code, CASE dow WHEN 1 THEN 'monday' WHEN 2 THEN 'tuesday' WHEN 3 THEN 'wednesday' WHEN 4 THEN 'thursday'
  WHEN 5 THEN 'friday' WHEN 6 THEN 'saturday' ELSE 'sunday' END AS day_of_week
FROM profile JOIN weekday USING (pr)""",
)
def weekday_rows(t: Tables) -> DataFrame:
    return cal.weekday_rows(_effective(t))


@query(
    "calendar_exceptions",
    "WITH " + _EXCEPTIONS_SQL + "SELECT file_id, vj_code, date, operates FROM exceptions",
)
def calendar_exceptions(t: Tables) -> DataFrame:
    return _exceptions(t)


@query(
    "operating_days",
    "WITH " + _EXCEPTIONS_SQL + """,
regular AS (SELECT file_id, vj_code, date FROM (
    SELECT file_id, vj_code, pr, unnest(generate_series(d, CASE WHEN k % 7 = 0 THEN greatest(DATE '1999-01-01', d) ELSE d + 60 END, INTERVAL 1 DAY))::DATE AS date FROM profile) x
  WHERE EXISTS (SELECT 1 FROM weekday w WHERE w.pr = x.pr AND w.dow = isodow(x.date)))
SELECT file_id, vj_code, count(*) AS days, min(date) AS first_day, max(date) AS last_day,
  CAST(sum(date - DATE '1990-01-01') AS BIGINT) AS day_sum
FROM (SELECT * FROM regular UNION SELECT file_id, vj_code, date FROM exceptions WHERE operates) r
WHERE NOT EXISTS (SELECT 1 FROM exceptions e WHERE NOT e.operates AND e.file_id = r.file_id AND e.vj_code = r.vj_code AND e.date = r.date)
GROUP BY ALL""",
)
def operating_days(t: Tables) -> DataFrame:
    journeys = _effective(t).withColumn("start_date", F.col("special_operation")[0]["start"])
    number = F.substring("vj_code", 3, 20).cast("long")
    journeys = journeys.withColumn("end_date", F.when(number % 7 != 0, F.date_add("start_date", 60)))
    horizon = F.greatest(F.lit("1999-01-01").cast("date"), F.col("start_date"))
    days = cal.operating_days(journeys, _exceptions(t), horizon)
    epoch = F.lit("1990-01-01").cast("date")
    return days.groupBy("file_id", "vj_code").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.sum(F.datediff("date", epoch)).alias("day_sum"),
    )


@query(
    "effective_profiles",
    "WITH " + _BASE_SQL + "SELECT file_id, vj_code, d AS special_start, pr = '3-MEDIUM' AS every_day FROM profile",
)
def effective_profiles(t: Tables) -> DataFrame:
    every = F.lit(True)
    for n in cal.WEEKDAYS:
        every = every & F.col(f"days.{n}")
    return _effective(t).select(
        "file_id", "vj_code", F.col("special_operation")[0]["start"].alias("special_start"), every.alias("every_day")
    )


def _organisations(t: Tables) -> DataFrame:
    files = t.orders.groupBy(_file().alias("file_id")).agg(F.min(F.col("o_orderdate").cast("date")).alias("d"))
    # Organisations O0..O4 per file; O5 and O6 stay unknown.
    codes = files.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(4))))
    first = F.struct(F.col("d").alias("start"), F.date_add("d", F.col("n") + 10).alias("end"))
    second = F.struct(F.date_add("d", 30).alias("start"), F.date_add("d", F.col("n") + 40).alias("end"))
    days = F.when(F.col("n") == 0, F.array().cast(f"array<struct<start:date,end:date>>")).otherwise(
        F.array(first, second)
    )
    return codes.select("file_id", F.concat(F.lit("O"), "n").alias("code"), days.alias("working_days"))


_ORG_SQL = "WITH " + _BASE_SQL + """,
links AS (
  SELECT file_id, vj_code, 'O' || (pk % 7) AS code, true AS operating_on_working_days, pk % 7 AS n FROM profile WHERE pk % 7 < 5
  UNION ALL SELECT file_id, vj_code, 'O' || (pk % 4), false, pk % 4 FROM profile
  UNION ALL SELECT file_id, vj_code, 'O' || (pk % 3), false, pk % 3 FROM profile)
"""


@query(
    "serviced_organisation_journeys",
    _ORG_SQL + "SELECT file_id, vj_code, code, operating_on_working_days FROM links",
)
def serviced_organisation_journeys(t: Tables) -> DataFrame:
    return res.serviced_organisation_journeys(_effective(t), _organisations(t))


@query(
    "organisation_working_days",
    _ORG_SQL + """
SELECT l.file_id, vj_code, code, operating_on_working_days, s + x.o AS start_date, s + CAST(x.o + n + 10 AS INTEGER) AS end_date
FROM links l JOIN svc ON svc.file_id = l.file_id, (VALUES (0), (30)) x(o) WHERE n > 0""",
)
def organisation_working_days(t: Tables) -> DataFrame:
    orgs = _organisations(t)
    return res.organisation_working_days(res.serviced_organisation_journeys(_effective(t), orgs), orgs)


@query(
    "serviced_organisations_upsert",
    """WITH old AS (SELECT DISTINCT nullif('N' || (c_nationkey % 8), 'N3') AS name, 'C' || (c_custkey % 40) AS code FROM customer),
  fresh AS (SELECT DISTINCT nullif('N' || (o_custkey % 10), 'N3') AS name, 'C' || (o_custkey % 90) AS code FROM orders)
SELECT name, code, 'stored' AS state FROM old UNION ALL
SELECT name, code, 'new' FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.name IS NOT DISTINCT FROM f.name AND old.code = f.code)""",
)
def serviced_organisations_upsert(t: Tables) -> DataFrame:
    def named(n):
        return F.nullif(F.concat(F.lit("N"), n), F.lit("N3")).alias("name")

    existing = t.customer.select(
        named(F.col("c_nationkey") % 8), F.concat(F.lit("C"), F.col("c_custkey") % 40).alias("code")
    ).distinct().withColumn("id", F.lit(-1).cast("bigint"))
    incoming = t.orders.select(
        named(F.col("o_custkey") % 10), F.concat(F.lit("C"), F.col("o_custkey") % 90).alias("code")
    )
    merged = res.upsert_serviced_organisations(incoming, existing)
    return merged.select("name", "code", F.when(F.col("id") == -1, "stored").otherwise("new").alias("state"))


@query(
    "flexible_operation_periods",
    """WITH p AS (SELECT event_id % 100 AS file_id, 'VJ' || event_id AS vj_code, event_type = 'click' AS all_day,
    CAST(event_id % 30 AS INTEGER) AS h FROM events)
SELECT file_id, vj_code, 0 AS pos, CASE WHEN all_day THEN '00:00:00' WHEN h < 24 THEN lpad(CAST(h AS VARCHAR), 2, '0') || ':05:00' END AS start_time,
  CASE WHEN all_day THEN '23:59:59' ELSE '23:30:00' END AS end_time, NOT all_day AND h >= 24 AS is_error FROM p""",
)
def flexible_operation_periods(t: Tables) -> DataFrame:
    hour = F.lpad((F.col("event_id") % 30).cast("string"), 2, "0")
    times = F.struct(
        (F.col("event_type") == "click").alias("all_day"),
        F.concat(hour, F.lit(":05:00")).alias("start"),
        F.lit("23:30:00").alias("end"),
    )
    rows = t.events.select(
        (F.col("event_id") % 100).alias("file_id"),
        F.concat(F.lit("VJ"), "event_id").alias("vj_code"),
        F.array(times).alias("service_times"),
    )
    return cal.flexible_operation_periods(rows)
