"""Reference tables and keyed loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.geo import stop_location

# Stop register documents: one row per stop.
STOP_DDL = """
`AtcoCode` string, `NaptanCode` string, `Descriptor` struct<`CommonName`:string>,
`Place` struct<`NptgLocalityRef`:string,`Location`:struct<`Translation`:struct<`Longitude`:string,
`Latitude`:string,`Easting`:string,`Northing`:string>,`Longitude`:string,`Latitude`:string,
`Easting`:string,`Northing`:string>>, `StopClassification` struct<`StopType`:string,
`OnStreet`:struct<`Bus`:struct<`BusStopType`:string>>>, `StopAreas` struct<`StopAreaRef`:array<string>>,
`AdministrativeAreaRef` string, `_ModificationDateTime` string
"""


def read_stop_register(spark: SparkSession, path: str) -> DataFrame:
    """Stops of large register documents; the reader splits files by stop."""
    rows = (
        spark.read.format("xml")
        .option("rowTag", "StopPoint")
        .option("ignoreNamespace", "true")
        .schema(STOP_DDL)
        .load(path)
    )
    return stop_register(rows)


def stop_register(rows: DataFrame) -> DataFrame:
    """Register rows with the columns of the stop table; an empty second code is absent."""
    loc = F.col("Place.Location")

    def of(name: str):
        return F.coalesce(
            F.nullif(loc["Translation"][name], F.lit("")), F.nullif(loc[name], F.lit(""))
        ).try_cast("double")

    spot = stop_location(of("Longitude"), of("Latitude"), of("Easting"), of("Northing"))
    return rows.where(F.col("AtcoCode").isNotNull()).select(
        F.col("AtcoCode").alias("atco_code"),
        F.nullif("NaptanCode", F.lit("")).alias("naptan_code"),
        F.col("Descriptor.CommonName").alias("common_name"),
        F.col("Place.NptgLocalityRef").alias("locality_id"),
        spot["lon"].alias("lon"),
        spot["lat"].alias("lat"),
        F.coalesce("StopAreas.StopAreaRef", F.array().cast("array<string>")).alias("stop_areas"),
        F.col("StopClassification.StopType").alias("stop_type"),
        F.col("StopClassification.OnStreet.Bus.BusStopType").alias("bus_stop_type"),
        F.to_timestamp("_ModificationDateTime").alias("modified_at"),
    )


def load_stops(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keyed upsert: incoming stops replace stored ones; of several incoming
    rows with one code the last modified counts, of these the largest row."""
    body = [c for c in existing.columns if c != "atco_code"]
    aligned = incoming.select(
        "atco_code", *[F.col(c) if c in incoming.columns else F.lit(None).alias(c) for c in body]
    )
    ranked = F.struct("_incoming", "modified_at", F.struct(*body).alias("r"))
    both = existing.withColumn("_incoming", F.lit(0)).unionByName(aligned.withColumn("_incoming", F.lit(1)))
    best = both.groupBy("atco_code").agg(F.max(ranked).alias("b"))
    return best.select("atco_code", "b.r.*").select(*existing.columns)


def refresh_ids(stops: DataFrame, ids: DataFrame) -> DataFrame:
    """Attach the internal id by stop code; a stop without a new id keeps its own."""
    new = ids.select("atco_code", F.col("id").alias("_new"))
    return stops.join(new, "atco_code", "left").select(
        *[F.coalesce("_new", "id").alias("id") if c == "id" else c for c in stops.columns]
    )


def replace_revisions(df: DataFrame, path: str) -> None:
    """Write whole revisions: partitions of the revisions present are replaced,
    all others stay."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("revision_id")
        .parquet(path)
    )


# Child tables of a revision extract: table, its key, the parent table and key.
EXTRACT_CHAIN: tuple[tuple[str, str, str, str], ...] = (
    ("services", "revision_id", "revisions", "id"),
    ("file_attributes", "revision_id", "revisions", "id"),
    ("service_patterns", "service_id", "services", "id"),
    ("pattern_stops", "service_pattern_id", "service_patterns", "id"),
    ("pattern_distances", "service_pattern_id", "service_patterns", "id"),
    ("pattern_tracks", "service_pattern_id", "service_patterns", "id"),
    ("tracks", "id", "pattern_tracks", "tracks_id"),
    ("vehicle_journeys", "service_pattern_id", "service_patterns", "id"),
    ("operating_profiles", "vehicle_journey_id", "vehicle_journeys", "id"),
    ("operating_exceptions", "vehicle_journey_id", "vehicle_journeys", "id"),
    ("non_operating_exceptions", "vehicle_journey_id", "vehicle_journeys", "id"),
    ("fares_metadata", "revision_id", "revisions", "id"),
    ("fares_catalogue", "fares_metadata_id", "fares_metadata", "id"),
)


def extract_revision(
    tables: Mapping[str, DataFrame],
    revisions: DataFrame,
    chain: Sequence[tuple[str, str, str, str]] = EXTRACT_CHAIN,
) -> dict[str, DataFrame]:
    """All rows of some revisions, table by table down the key hierarchy."""
    found = {"revisions": revisions}
    for table, key, parent, parent_key in chain:
        if table in tables and parent in found:
            ids = found[parent].select(F.col(parent_key).alias(key)).distinct()
            found[table] = tables[table].join(ids, key, "left_semi")
    return found


def write_extract(extract: Mapping[str, DataFrame], path: str) -> None:
    """One CSV folder per table; arrays and structs are written as JSON."""
    for name, df in extract.items():
        flat = [
            F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c)
            for c, kind in df.dtypes
        ]
        df.select(*flat).write.mode("overwrite").option("header", "true").csv(f"{path}/{name}")
