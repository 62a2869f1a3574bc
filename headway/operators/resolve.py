"""Reference resolution: lookups between document tables and reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.session import staged


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def semi_filter(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among ``ids`` (by revision, service, stop code ...)."""
    return df.join(ids.select(*keys), list(keys), "left_semi")


def delete_by(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(ids.select(*keys), list(keys), "left_anti")


def update_by(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite columns with the changes' non-null values; keys must be unique there."""
    changed = [c for c in changes.columns if c not in keys]
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = df.join(renamed, list(keys), "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c)
            for c in df.columns
        ]
    )


def resolve_stops(document_stops: DataFrame, stops: DataFrame) -> DataFrame:
    """Where each stop of a document comes from.

    A stop fully described in the document wins over the register; a reference
    the register lacks becomes a placeholder (``source = 'missing'``).
    """
    register = stops.select(
        "atco_code",
        F.col("id").alias("register_id"),
        F.col("common_name").alias("register_name"),
        F.col("lon").alias("register_lon"),
        F.col("lat").alias("register_lat"),
    )
    joined = document_stops.join(register, "atco_code", "left")
    own = ~F.col("is_reference")
    source = (
        F.when(own, "document").when(F.col("register_id").isNotNull(), "register").otherwise("missing")
    )
    return joined.select(
        "file_id",
        "atco_code",
        source.alias("source"),
        F.when(~own, F.col("register_id")).alias("naptan_stop_id"),
        F.when(own, F.col("common_name"))
        .otherwise(F.coalesce("register_name", "common_name"))
        .alias("common_name"),
        F.when(own, F.col("lon")).otherwise(F.col("register_lon")).alias("lon"),
        F.when(own, F.col("lat")).otherwise(F.col("register_lat")).alias("lat"),
    )


def placeholders(resolved: DataFrame) -> DataFrame:
    return resolved.where("source = 'missing'").select(
        "file_id", F.col("atco_code").alias("stop_ref")
    )


def stops_by_secondary_code(codes: DataFrame, stops: DataFrame, code: str = "naptan_code") -> DataFrame:
    """Stops by a second code; a code shared by several stops resolves to none."""
    unique = (
        stops.where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.count(F.lit(1)).alias("n"), F.min("atco_code").alias("atco_code"))
        .where("n = 1")
        .drop("n")
    )
    return codes.join(unique, code)


def stop_areas(codes: DataFrame, stops: DataFrame) -> DataFrame:
    """One row per stop and stop area."""
    return codes.join(stops.select("atco_code", "stop_areas"), "atco_code").select(
        "atco_code", F.explode("stop_areas").alias("stop_area")
    )


def missing_stop_refs(refs: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop references no known stop answers to (an error for flexible patterns)."""
    return refs.join(stops.select(F.col("atco_code").alias("stop_ref")), "stop_ref", "left_anti")


def journey_pattern_of(vehicle_journeys: DataFrame, bridge: DataFrame) -> DataFrame:
    """Service pattern of each journey: by its own pattern reference, else by one
    hop to another journey that has one. ``how`` is direct, hop or unresolved."""
    own = vehicle_journeys.select("file_id", "vj_code", "jp_ref", "vj_ref", "ordinal").join(
        bridge.select("file_id", F.col("jp_id").alias("jp_ref"), "service_pattern_id"),
        ["file_id", "jp_ref"],
        "left",
    )
    # A code met twice counts with its last pattern; one row per code below.
    target = own.where("service_pattern_id is not null").groupBy("file_id", "vj_code").agg(
        F.max_by("service_pattern_id", "ordinal").alias("hop_pattern")
    ).withColumnRenamed("vj_code", "vj_ref")
    joined = own.join(target, ["file_id", "vj_ref"], "left")
    how = (
        F.when(F.col("service_pattern_id").isNotNull(), "direct")
        .when(F.col("hop_pattern").isNotNull(), "hop")
        .otherwise("unresolved")
    )
    return joined.select(
        "file_id",
        "vj_code",
        F.coalesce("service_pattern_id", "hop_pattern").alias("service_pattern_id"),
        how.alias("how"),
    )


def journey_reference_chain(vehicle_journeys: DataFrame) -> DataFrame:
    """Journey pattern of each journey, following journey references to any depth.

    Pointer jumping: each round doubles the distance looked at, so a chain of
    length n takes log2(n) rounds. A round that resolves nothing more means
    only cycles and dangling references are left; those stay null.
    """
    ref = F.nullif(F.col("vj_ref"), F.lit(""))
    state = staged(
        vehicle_journeys.groupBy("file_id", "vj_code")
        .agg(
            F.min_by(
                F.struct(F.nullif(F.col("jp_ref"), F.lit("")).alias("jp_ref"), ref.alias("next")),
                "ordinal",
            ).alias("v")
        )
        .select("file_id", "vj_code", "v.jp_ref", F.when(F.col("v.jp_ref").isNull(), F.col("v.next")).alias("next"))
    )
    is_open = F.col("jp_ref").isNull() & F.col("next").isNotNull()
    settled, waiting = state.where(~is_open), state.where(is_open)
    left = waiting.count()
    while left:
        targets = settled.unionByName(waiting).select(
            "file_id",
            F.col("vj_code").alias("next"),
            F.col("jp_ref").alias("t_jp"),
            F.col("next").alias("t_next"),
        )
        moved = staged(
            waiting.join(targets, ["file_id", "next"], "left").select(
                "file_id", "vj_code", F.col("t_jp").alias("jp_ref"), F.col("t_next").alias("next")
            )
        )
        settled, waiting = settled.unionByName(moved.where(~is_open)), moved.where(is_open)
        remaining = waiting.count()
        if remaining == left:
            break
        left = remaining
    return settled.unionByName(waiting).select("file_id", "vj_code", "jp_ref")


def journeys_by_line(vehicle_journeys: DataFrame, lines: DataFrame) -> DataFrame:
    return vehicle_journeys.join(
        lines.select("file_id", F.col("line_id").alias("line_ref"), "line_name"),
        ["file_id", "line_ref"],
    )


def effective_profiles(
    vehicle_journeys: DataFrame, operating_profiles: DataFrame
) -> DataFrame:
    """The journey's own profile, else that of the file's first service with one."""
    body = [
        c
        for c in operating_profiles.columns
        if c not in ("file_id", "owner_kind", "owner_id", "owner_pos")
    ]
    packed = operating_profiles.select(
        "file_id", "owner_kind", "owner_id", "owner_pos", F.struct(*body).alias("profile")
    )
    own = packed.where("owner_kind = 'journey'").select(
        "file_id", F.col("owner_id").alias("vj_code"), F.col("profile").alias("own")
    )
    fallback = (
        packed.where("owner_kind = 'service'")
        .groupBy("file_id")
        .agg(F.min_by("profile", "owner_pos").alias("from_service"))
    )
    return (
        vehicle_journeys.select("file_id", "vj_code")
        .join(own, ["file_id", "vj_code"], "left")
        .join(fallback, "file_id", "left")
        .withColumn("profile", F.coalesce("own", "from_service"))
        .where(F.col("profile").isNotNull())
        .select("file_id", "vj_code", "profile.*")
    )


def new_serviced_organisations(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Organisations not stored yet by (name, code), where a name may be null."""
    fresh = incoming.select("name", "code").distinct()
    return fresh.join(existing, null_safe(fresh, existing, ["name", "code"]), "left_anti")


def upsert_serviced_organisations(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Stored organisations plus new ones, with an id that repeats on re-runs."""
    fresh = new_serviced_organisations(incoming, existing).select(
        F.xxhash64(F.coalesce("name", F.lit("\x00")), "code").alias("id"), "name", "code"
    )
    return existing.select("id", "name", "code").unionByName(fresh)


def serviced_organisation_journeys(profiles: DataFrame, organisations: DataFrame) -> DataFrame:
    """Journey to organisation links with the ``operating_on_working_days`` flag.

    Operation on working days and non-operation on holidays are true, the other
    two false; a reference to an unknown organisation is dropped.
    """
    def refs(source: str, field: str) -> Column:
        none = F.array().cast("array<string>")
        return F.flatten(F.transform(F.col(source), lambda d: F.coalesce(d[field], none)))

    entry = F.array(
        *[
            F.struct(
                refs(source, field).alias("codes"), F.lit(flag).alias("operating_on_working_days")
            )
            for source, field, flag in (
                ("so_operation", "working_days", True),
                ("so_operation", "holidays", False),
                ("so_non_operation", "working_days", False),
                ("so_non_operation", "holidays", True),
            )
        ]
    )
    links = (
        profiles.select("file_id", "vj_code", F.explode(entry).alias("e"))
        .select("file_id", "vj_code", "e.operating_on_working_days", F.explode("e.codes").alias("code"))
    )
    known = organisations.select("file_id", "code").distinct()
    return links.join(known, ["file_id", "code"], "left_semi")


def organisation_working_days(links: DataFrame, organisations: DataFrame) -> DataFrame:
    """Working-day ranges per journey link; holiday links use them too."""
    days = organisations.select(
        "file_id", "code", F.explode("working_days").alias("range")
    ).select("file_id", "code", F.col("range.start").alias("start_date"), F.col("range.end").alias("end_date"))
    return links.join(days, ["file_id", "code"])


# Interfaces whose registrations map to a region by area code.
AREA_CODE_API_TYPES = ("WECA", "EP")


def service_regions(
    registrations: DataFrame, authorities: DataFrame, admin_areas: DataFrame
) -> DataFrame:
    """Region list of each registration and whether it is Scottish only.

    ``authorities(registration_id, ui_lta_id)`` links a registration to the
    authorities it names. Regions are distinct and joined by ``|``.
    """
    regions = F.array_join(
        F.array_sort(F.collect_set("traveline_region_id")), "|"
    )
    by_area = admin_areas.groupBy("atco_code").agg(regions.alias("area_regions"))
    # Distinct (authority, region) first: the sets below stay a handful of codes.
    authority_regions = admin_areas.select("ui_lta_id", "traveline_region_id").distinct()
    by_authority = (
        authorities.join(authority_regions, "ui_lta_id")
        .groupBy(F.col("registration_id").alias("id"))
        .agg(regions.alias("authority_regions"))
    )
    region = F.when(
        F.col("api_type").isin(*AREA_CODE_API_TYPES), F.col("area_regions")
    ).otherwise(F.col("authority_regions"))
    return (
        registrations.join(by_area, "atco_code", "left")
        .join(by_authority, "id", "left")
        .select(
            "id",
            "registration_number",
            "api_type",
            region.alias("traveline_region"),
            F.coalesce(region == "S", F.lit(False)).alias("is_scottish"),
        )
    )


def map_results(files: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome of a fan-out step per file, matched on base name; failures kept."""
    outcome = results.select(
        F.element_at(F.split("file_key", "/"), -1).alias("filename"), "revision_id", "status"
    )
    return files.join(outcome, ["revision_id", "filename"], "left").withColumn(
        "status", F.coalesce("status", F.lit("unknown"))
    )


def published_service_clashes(
    incoming: DataFrame, file_attributes: DataFrame, revisions: DataFrame, datasets: DataFrame
) -> DataFrame:
    """Published datasets that already carry one of the incoming service codes.

    Codes lead to live published revisions, those to their datasets, and those
    back to all codes the dataset publishes.
    """
    live = revisions.where("status = 'live' and is_published").select(
        F.col("id").alias("revision_id")
    )
    hit = (
        file_attributes.join(incoming.select("service_code").distinct(), "service_code", "left_semi")
        .join(live, "revision_id", "left_semi")
        .select("revision_id")
        .distinct()
    )
    current = datasets.select(
        F.col("id").alias("dataset_id"), F.col("live_revision_id").alias("revision_id")
    ).join(hit, "revision_id", "left_semi")
    return (
        file_attributes.join(current, "revision_id")
        .select("dataset_id", "service_code")
        .distinct()
    )


def fares_stop_ids(stop_refs: DataFrame, stops: DataFrame) -> DataFrame:
    """Register ids behind a fares file's stop references, by either code type.

    Only numeric private codes count. Refs carry ``atco_code`` or ``naptan_code``.
    """
    by_atco = stop_refs.where("atco_code is not null").select("file_id", "atco_code").distinct().join(
        stops.select("atco_code", "private_code"), "atco_code"
    )
    codes = stop_refs.where("naptan_code is not null").select("file_id", "naptan_code").distinct()
    unique = stops_by_secondary_code(codes, stops).join(
        stops.select("atco_code", "private_code"), "atco_code"
    )
    both = by_atco.select("file_id", "private_code").unionByName(unique.select("file_id", "private_code"))
    numeric = F.col("private_code").rlike(r"^\d+$")
    return both.where(numeric).select("file_id", F.col("private_code").cast("bigint").alias("stop_id")).distinct()


def fares_stop_shortfall(stop_refs: DataFrame, stop_ids: DataFrame) -> DataFrame:
    """Files whose references outnumber the stops found for them."""
    code = F.coalesce("atco_code", "naptan_code")
    wanted = stop_refs.groupBy("file_id").agg(F.countDistinct(code).alias("wanted"))
    found = stop_ids.groupBy("file_id").agg(F.count(F.lit(1)).alias("found"))
    return (
        wanted.join(found, "file_id", "left")
        .select("file_id", "wanted", F.coalesce("found", F.lit(0)).alias("found"))
        .where("found < wanted")
    )
