"""Service patterns: journey patterns that share one stop sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.text import sequence_key

# Directions that read the inbound and the outbound description.
INBOUND = ("inbound", "antiClockwise")
OUTBOUND = ("outbound", "clockwise")
UNKNOWN = "unknown"


def majority(df: DataFrame, keys: Sequence[str], value: str, ordinal: str) -> DataFrame:
    """Most frequent value per key; a tie goes to the value met first.

    Two partial aggregations, so a hot key is reduced before it is shuffled.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(ordinal).alias("_first"))
    )
    return counted.groupBy(*keys).agg(
        F.min_by(value, F.struct((-F.col("_n")).alias("n"), "_first")).alias(value)
    )


def service_pattern_bridge(journey_patterns: DataFrame, sequence: DataFrame) -> DataFrame:
    """Journey pattern to service pattern.

    Patterns of a file with the same stops share one service pattern. Its id is
    the service code of the first of them and the hash of file id and stops, so
    ids repeat on re-runs and differ between files, hence between revisions.
    """
    return patterns_with_stops(journey_patterns, sequence).drop("stops")


def patterns_with_stops(journey_patterns: DataFrame, sequence: DataFrame) -> DataFrame:
    """The bridge with each pattern's list of ``stops``, so that these need not be joined again.

    The first service code is told by a window over a file's patterns of one list, not by
    a join of the patterns with themselves, which would work out all sequences twice.
    """
    stops = sequence.groupBy("file_id", "jp_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "stop_ref"))), lambda s: s["stop_ref"]
        ).alias("stops")
    )
    keyed = journey_patterns.select("file_id", "jp_id", "ordinal", "service_code").join(
        stops, ["file_id", "jp_id"], "left"
    )
    keyed = keyed.withColumn("stops", F.coalesce("stops", F.array().cast("array<string>"))).select(
        "*",
        sequence_key(F.col("file_id"), F.col("stops")).alias("sequence_key"),
        F.size("stops").alias("num_stops"),
    )
    alike = Window.partitionBy("file_id", "sequence_key")
    first = F.min_by("service_code", "ordinal").over(alike).alias("first_service")
    return keyed.where("sequence_key is not null").select("*", first).select(
        "file_id",
        "jp_id",
        "ordinal",
        "service_code",
        F.concat_ws("-", "first_service", "sequence_key").alias(
            "service_pattern_id"
        ),
        "num_stops",
        "stops",
    )


def pattern_members(bridge: DataFrame, journey_map: DataFrame) -> DataFrame:
    """Numbers of journey patterns, journeys and stops of each service pattern."""
    keys = ["file_id", "service_pattern_id"]
    patterns = bridge.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("journey_patterns"), F.max("num_stops").alias("num_stops")
    )
    journeys = (
        journey_map.where("service_pattern_id is not null")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("vehicle_journeys"))
    )
    return patterns.join(journeys, keys, "left").withColumn(
        "vehicle_journeys", F.coalesce("vehicle_journeys", F.lit(0))
    )


def pattern_direction(bridge: DataFrame, journey_patterns: DataFrame) -> DataFrame:
    directions = journey_patterns.select("file_id", "jp_id", "direction")
    return majority(
        bridge.join(directions, ["file_id", "jp_id"]),
        ["file_id", "service_pattern_id"],
        "direction",
        "ordinal",
    )


def pattern_line(journey_map: DataFrame, vehicle_journeys: DataFrame) -> DataFrame:
    lines = vehicle_journeys.select("file_id", "vj_code", "line_ref", "ordinal")
    return majority(
        journey_map.where("service_pattern_id is not null").join(lines, ["file_id", "vj_code"]),
        ["file_id", "service_pattern_id"],
        "line_ref",
        "ordinal",
    )


def patterns_of_service(bridge: DataFrame, service_patterns: DataFrame) -> DataFrame:
    """Service patterns a service uses, through any shared journey pattern."""
    return (
        bridge.select("file_id", "jp_id", "service_pattern_id")
        .join(service_patterns.select("file_id", "jp_id", F.col("service_code").alias("used_by")), ["file_id", "jp_id"])
        .select("file_id", "used_by", "service_pattern_id")
        .distinct()
    )


def pattern_metadata(
    patterns: DataFrame, services: DataFrame, lines: DataFrame
) -> DataFrame:
    """Origin, destination, line name and description of each service pattern.

    ``patterns`` has service_code, direction, line_id and the names of its end
    stops (null without stops); ``services`` has origin and destination.
    """
    line_cols = lines.select(
        "file_id",
        "line_id",
        "line_name",
        F.col("inbound.description").alias("inbound_text"),
        F.col("outbound.description").alias("outbound_text"),
    )
    service_cols = services.select(
        "file_id",
        "service_code",
        F.col("origin").alias("service_origin"),
        F.col("destination").alias("service_destination"),
    )
    unknown = F.lit(UNKNOWN)
    from_stops = F.col("first_stop_name").isNotNull() & F.col("last_stop_name").isNotNull()
    has_line = F.col("line_name").isNotNull()
    given = F.when(F.col("direction").isin(*INBOUND), F.nullif("inbound_text", F.lit(""))).when(
        F.col("direction").isin(*OUTBOUND), F.nullif("outbound_text", F.lit(""))
    )
    joined = (
        patterns.join(line_cols, ["file_id", "line_id"], "left")
        .join(service_cols, ["file_id", "service_code"], "left")
        .withColumn(
            "origin",
            F.when(from_stops, F.col("first_stop_name")).otherwise(
                F.coalesce("service_origin", unknown)
            ),
        )
        .withColumn(
            "destination",
            F.when(from_stops, F.col("last_stop_name")).otherwise(
                F.coalesce("service_destination", unknown)
            ),
        )
    )
    made = F.when(
        (F.col("origin") != UNKNOWN) & (F.col("destination") != UNKNOWN),
        F.concat_ws(" - ", "origin", "destination"),
    ).otherwise(unknown)
    return joined.select(
        "file_id",
        "service_pattern_id",
        "origin",
        "destination",
        F.when(has_line, F.coalesce(given, made)).otherwise(unknown).alias("description"),
        F.coalesce("line_name", unknown).alias("line_name"),
    )


def pattern_localities(pattern_stops: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct localities per service pattern, nulls dropped."""
    return _pattern_areas(pattern_stops, stops, "locality_id")


def pattern_admin_areas(pattern_stops: DataFrame, stops: DataFrame) -> DataFrame:
    return _pattern_areas(pattern_stops, stops, "admin_area_id")


def _pattern_areas(pattern_stops: DataFrame, stops: DataFrame, column: str) -> DataFrame:
    lookup = stops.select(F.col("atco_code").alias("stop_ref"), column)
    return (
        pattern_stops.select("file_id", "service_pattern_id", "stop_ref")
        .distinct()
        .join(lookup, "stop_ref")
        .where(F.col(column).isNotNull())
        .select("file_id", "service_pattern_id", column)
        .distinct()
    )


def booking_arrangements(bookings: DataFrame) -> DataFrame:
    """Distinct booking arrangements per service, the first of each kept."""
    return bookings.groupBy(
        "file_id", "service_code", "description", "email", "phone", "web_address"
    ).agg(F.min("ordinal").alias("ordinal"))


def duplicate_journeys(vehicle_journeys: DataFrame) -> DataFrame:
    """Journeys with one departure, pattern and profile.

    Flexible journeys have neither departure nor profile and so share one key.
    The code list is part of the report; its size is that of a duplicate group
    within one file.
    """
    return (
        vehicle_journeys.groupBy("file_id", "departure_time", "jp_ref", "profile")
        .agg(
            F.count(F.lit(1)).alias("journeys"),
            F.array_join(F.array_sort(F.collect_list("vj_code")), ",").alias("vj_codes"),
        )
        .where("journeys > 1")
    )
