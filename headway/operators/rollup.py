"""Roll-ups: file attributes, revision and fares statistics, corpus reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Product types counted as passes and as trips.
PASS_PRODUCTS = ("dayPass", "periodPass")
TRIP_PRODUCTS = (
    "singleTrip",
    "dayReturnTrip",
    "periodReturnTrip",
    "timeLimitedSingleTrip",
    "shortTrip",
)
# Marks of metadata frames, default fares schema version.
METADATA_MARK = "UK_PI_METADATA"
DEFAULT_FARES_VERSION = "1.1"


def distinct_per_revision(bridge: DataFrame, patterns: DataFrame, column: str) -> DataFrame:
    """Distinct localities or admin areas per revision."""
    return (
        bridge.join(patterns.select("service_pattern_id", "revision_id"), "service_pattern_id")
        .select("revision_id", column)
        .where(F.col(column).isNotNull())
        .distinct()
    )


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append rows whose key is not stored yet; of several with one key the smallest."""
    body = [c for c in incoming.columns if c not in keys]
    single = incoming.groupBy(*keys).agg(F.min(F.struct(*body)).alias("_r")).select(*keys, "_r.*") if body else incoming.distinct()
    fresh = single.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh)


def insert_or_update(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Stored rows with the newest incoming row per key replacing them; of equally
    new ones the largest, column by column."""
    body = [c for c in existing.columns if c not in keys]
    row = F.struct(F.col(version).alias("v"), F.struct(*body).alias("r"))
    both = existing.select(*keys, F.struct(F.lit(0).alias("p"), row.alias("x")).alias("_rank")).unionByName(
        incoming.select(*keys, F.struct(F.lit(1).alias("p"), row.alias("x")).alias("_rank"))
    )
    best = both.groupBy(*keys).agg(F.max("_rank").alias("_rank"))
    return best.select(*keys, "_rank.x.r.*").select(*existing.columns)


def revision_file_stats(files: DataFrame) -> DataFrame:
    """Earliest creation and latest modification per revision."""
    return files.groupBy("revision_id").agg(
        F.min("creation_datetime").alias("first_creation_datetime"),
        F.max("modification_datetime").alias("last_modification_datetime"),
    )


def revision_service_stats(services: DataFrame) -> DataFrame:
    return services.groupBy("revision_id").agg(
        F.min("start_date").alias("first_service_start"),
        F.min("end_date").alias("first_expiring_service"),
        F.max("end_date").alias("last_expiring_service"),
    )


def revision_stats(files: DataFrame, services: DataFrame) -> DataFrame:
    return revision_file_stats(files).join(revision_service_stats(services), "revision_id", "full")


def file_attributes(metadata: DataFrame, services: DataFrame, lines: DataFrame, operators: DataFrame) -> DataFrame:
    """One attribute row per file from its services, lines and operators.

    Only schema version 2.4 is admitted. The first service gives code, mode and
    public use, the first of the standard parts origin and destination.
    """
    first = F.struct("service_code", "public_use")
    per_file = services.groupBy("file_id").agg(
        F.min("start_date").alias("operating_period_start_date"),
        F.max("end_date").alias("operating_period_end_date"),
        F.min_by(first, "service_pos").alias("s"),
        F.min_by("mode", F.when(F.col("mode").isNotNull(), F.col("service_pos"))).alias("mode"),
        F.min_by("origin", F.when(F.col("origin").isNotNull(), F.col("service_pos"))).alias("origin"),
        F.min_by("destination", F.when(F.col("destination").isNotNull(), F.col("service_pos"))).alias("destination"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("service_pos", "line_pos", "line_name")))
    names = lines.groupBy("file_id").agg(
        F.transform(ordered, lambda s: s["line_name"]).alias("line_names")
    )
    operator = operators.groupBy("file_id").agg(
        F.min_by(F.struct("noc", "licence_number"), "operator_pos").alias("o")
    )
    return (
        metadata.where("schema_version = '2.4'")
        .join(per_file, "file_id")
        .join(names, "file_id", "left")
        .join(operator, "file_id", "left")
        .select(
            *[c for c in metadata.columns],
            F.coalesce("o.noc", F.lit("")).alias("national_operator_code"),
            F.coalesce("o.licence_number", F.lit("")).alias("licence_number"),
            F.coalesce("line_names", F.array().cast("array<string>")).alias("line_names"),
            "operating_period_start_date",
            "operating_period_end_date",
            F.coalesce("origin", F.lit("")).alias("origin"),
            F.coalesce("destination", F.lit("")).alias("destination"),
            F.col("s.service_code").alias("service_code"),
            F.col("s.public_use").alias("public_use"),
            F.coalesce("mode", F.lit("bus")).alias("service_mode"),
        )
    )


def service_rows(services: DataFrame, lines: DataFrame, files: DataFrame) -> DataFrame:
    """Output row per service; a superseded file's service has no file link."""
    ordered = F.array_sort(F.collect_list(F.struct("line_pos", "line_name")))
    names = lines.groupBy("file_id", "service_code").agg(
        F.transform(ordered, lambda s: s["line_name"]).alias("names")
    )
    joined = services.join(names, ["file_id", "service_code"], "left").join(
        files.select("file_id", "superseded"), "file_id", "left"
    )
    all_names = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        "file_id",
        "service_code",
        F.when(F.col("has_flexible"), "flexible").otherwise("standard").alias("service_type"),
        F.coalesce(F.get(all_names, F.lit(0)), F.lit("unknown")).alias("name"),
        F.slice(all_names, F.lit(2), F.greatest(F.size(all_names) - 1, F.lit(0))).alias("other_names"),
        "start_date",
        "end_date",
        F.when(~F.coalesce("superseded", F.lit(False)), F.col("file_id")).alias("file_attributes_id"),
    )


def vehicle_journey_rows(vehicle_journeys: DataFrame, journey_patterns: DataFrame) -> DataFrame:
    """Output row per journey that has its own pattern reference."""
    patterns = journey_patterns.select("file_id", F.col("jp_id").alias("jp_ref"), "direction")
    return (
        vehicle_journeys.where("jp_ref is not null")
        .join(patterns, ["file_id", "jp_ref"])
        .select(
            "file_id",
            "vj_code",
            "jp_ref",
            "line_ref",
            F.col("departure_time").alias("start_time"),
            "direction",
            F.coalesce("journey_code", F.lit("")).alias("journey_code"),
            F.col("block").alias("block_number"),
            # Presence counts, even when the given shift is 0.
            F.col("departure_day_shift").isNotNull().alias("departure_day_shift"),
        )
    )


def run_statistics(patterns: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Sums of per-pattern measures per file, and the number of patterns."""
    return patterns.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("service_patterns"),
        *[F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures],
    )


# ---------------------------------------------------------------- fares


def fares_file_metadata(frames: dict[str, DataFrame]) -> DataFrame:
    """Counts and validity of each fares file, from its detail tables.

    Every detail table is reduced to one row per file before the join.
    """
    products = frames["fare_products"]
    tariffs = frames["tariff_validity"]
    parts = [
        frames["lines"].groupBy("file_id").agg(F.count(F.lit(1)).alias("num_of_lines")),
        frames["fare_zones"].groupBy("file_id").agg(F.count(F.lit(1)).alias("num_of_fare_zones")),
        frames["sales_offer_packages"].groupBy("file_id").agg(
            F.count(F.lit(1)).alias("num_of_sales_offer_packages")
        ),
        frames["fare_frames"].groupBy("file_id").agg(
            F.sum("num_of_fare_products").alias("num_of_fare_products")
        ),
        frames["user_profiles"].groupBy("file_id").agg(
            F.countDistinct("user_type").alias("num_of_user_profiles")
        ),
        products.groupBy("file_id").agg(
            F.countDistinct(F.when(F.col("product_type").isin(*PASS_PRODUCTS), F.col("product_type"))).alias("num_of_pass_products"),
            F.countDistinct(F.when(F.col("product_type").isin(*TRIP_PRODUCTS), F.col("product_type"))).alias("num_of_trip_products"),
        ),
        tariffs.groupBy("file_id").agg(
            F.min("from_date").alias("valid_from"), F.max("to_date").alias("valid_to")
        ),
    ]
    out = frames["files"].select("file_id", "schema_version")
    for part in parts:
        out = out.join(part, "file_id", "left")
    counts = [c for c in out.columns if c.startswith("num_of_")]
    return out.fillna(0, subset=counts)


def fares_catalogue(frames: dict[str, DataFrame]) -> DataFrame:
    """Catalogue row per fares file: arrays of codes, names and types.

    Line ids and names and user types keep repeats, the rest are distinct; all
    are sorted so that runs agree.
    """

    def listed(table: str, column: str, name: str, distinct: bool = True) -> DataFrame:
        values = F.collect_set(column) if distinct else F.collect_list(column)
        return frames[table].groupBy("file_id").agg(F.array_sort(values).alias(name))

    is_metadata = F.coalesce(F.col("frame_id").contains(METADATA_MARK), F.lit(False))
    composite = frames["composite_frames"].where(~is_metadata)
    parts = [
        composite.groupBy("file_id").agg(
            F.min("from_date").cast("date").alias("valid_from"),
            F.max("to_date").cast("date").alias("valid_to"),
        ),
        listed("operators", "public_code", "national_operator_code"),
        listed("lines", "line_id", "line_id", distinct=False),
        listed("lines", "public_code", "line_name", distinct=False),
        listed("stop_areas", "area_code", "atco_area"),
        listed("tariffs", "tariff_basis", "tariff_basis"),
        listed("fare_products", "product_type", "product_type"),
        listed("fare_products", "name", "product_name"),
        listed("user_profiles", "user_type", "user_type", distinct=False),
    ]
    out = frames["files"].select("file_id")
    for part in parts:
        out = out.join(part, "file_id", "left")
    return out


def fares_revision(files: DataFrame) -> DataFrame:
    """Fares roll-up per revision.

    Lines, zones, packages and products add up; user, pass and trip types count
    once over all files, so they come from the exploded arrays.
    """
    sums = files.groupBy("revision_id").agg(
        *[
            F.sum(c).alias(c)
            for c in (
                "num_of_lines",
                "num_of_fare_zones",
                "num_of_sales_offer_packages",
                "num_of_fare_products",
            )
        ],
        F.min("valid_from").alias("valid_from"),
        F.max("valid_to").alias("valid_to"),
        F.coalesce(F.min("schema_version"), F.lit(DEFAULT_FARES_VERSION)).alias("schema_version"),
    )

    def distinct(array: str, name: str, allowed: Sequence[str] | None = None) -> DataFrame:
        rows = files.select("revision_id", F.explode(array).alias("v"))
        if allowed:
            rows = rows.where(F.col("v").isin(*allowed))
        return rows.distinct().groupBy("revision_id").agg(F.count(F.lit(1)).alias(name))

    for part in (
        distinct("user_types", "num_of_user_profiles"),
        distinct("product_types", "num_of_pass_products", PASS_PRODUCTS),
        distinct("product_types", "num_of_trip_products", TRIP_PRODUCTS),
    ):
        sums = sums.join(part, "revision_id", "left")
    return sums.fillna(
        0, subset=["num_of_user_profiles", "num_of_pass_products", "num_of_trip_products"]
    )


def lowest_schema_version(files: DataFrame) -> DataFrame:
    return files.groupBy("revision_id").agg(
        F.coalesce(F.min("schema_version"), F.lit(DEFAULT_FARES_VERSION)).alias("schema_version")
    )


def fares_violation_report(violations: DataFrame) -> DataFrame:
    """Number of violations and report name per revision."""
    return violations.groupBy("revision_id").agg(
        F.count(F.lit(1)).alias("violations"), F.countDistinct("file").alias("files")
    ).withColumn(
        "report_name", F.concat(F.lit("validation_report_"), F.col("revision_id"), F.lit(".csv"))
    )


# --------------------------------------------------------------- corpus


def size_report(corpus: DataFrame) -> DataFrame:
    """Files, total and average size per archive (``root`` without a parent)."""
    return corpus.groupBy(F.coalesce("archive", F.lit("root")).alias("archive")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("total_size"),
        F.round(F.avg("size"), 2).alias("average_size"),
    )


def tag_report(corpus: DataFrame, tag: str) -> DataFrame:
    """How often one element occurs, per file and archive."""
    opening = F.lit(rf"<(\w+:)?{tag}[\s/>]")
    return corpus.select(
        F.coalesce("archive", F.lit("root")).alias("archive"),
        "file_id",
        F.regexp_count("text", opening).alias("occurrences"),
    )


def files_with_tag(corpus: DataFrame, tag: str) -> DataFrame:
    return corpus.where(F.col("text").rlike(rf"<(\w+:)?{tag}[\s/>]"))


def path_search(corpus: DataFrame, parent: str, child: str) -> DataFrame:
    """Elements of one name, their identifier, and whether a child occurs in them.

    Works on whole text of well-formed documents without nested same-name
    elements.
    """
    block = F.regexp_extract_all(
        "text", F.lit(rf"(?s)(<(?:\w+:)?{parent}(?:\s[^>]*)?(?:/>|>.*?</(?:\w+:)?{parent}>))"), 1
    )
    rows = corpus.select("file_id", F.posexplode(block).alias("ordinal", "element"))
    return rows.select(
        "file_id",
        "ordinal",
        F.nullif(F.regexp_extract("element", r'^<[^>]*\bid="([^"]*)"', 1), F.lit("")).alias("identifier"),
        F.col("element").rlike(rf"<(\w+:)?{child}[\s/>]").alias("has_child"),
    )


def archive_manifest(members: DataFrame, limit: int = 10 * 1024**3) -> DataFrame:
    """Checks per archive: nested archives, total size, at least one document."""
    name = F.lower("member")
    return members.groupBy("archive").agg(
        F.bool_or(name.endswith(".zip")).alias("has_nested_archive"),
        (F.sum("size") > limit).alias("too_large"),
        (~F.bool_or(name.endswith(".xml"))).alias("no_documents"),
        F.sum("size").alias("total_size"),
    )


def corpus_inventory(sections: dict[str, DataFrame]) -> DataFrame:
    """Per file: operator, codes, section counts, custom stops, span of service."""
    def per_file(table: str, name: str) -> DataFrame:
        return sections[table].groupBy("file_id").agg(F.count(F.lit(1)).alias(name))

    services = sections["services"].groupBy("file_id").agg(
        F.min_by("service_code", "service_pos").alias("service_code"),
        F.datediff(F.max("end_date"), F.min("start_date")).alias("service_span_days"),
        F.count(F.lit(1)).alias("services"),
    )
    operators = sections["operators"].groupBy("file_id").agg(
        F.min_by("noc", "operator_pos").alias("noc")
    )
    custom = sections["stop_points"].groupBy("file_id").agg(
        F.count_if(~F.col("is_reference")).alias("custom_stops"),
        F.count(F.lit(1)).alias("stop_points"),
    )
    out = sections["metadata"].select("file_id", "filename")
    for part in (
        operators,
        services,
        per_file("lines", "lines"),
        per_file("journey_patterns", "journey_patterns"),
        per_file("vehicle_journeys", "vehicle_journeys"),
        custom,
    ):
        out = out.join(part, "file_id", "left")
    counts = ["services", "lines", "journey_patterns", "vehicle_journeys", "custom_stops", "stop_points"]
    return out.fillna(0, subset=counts)
