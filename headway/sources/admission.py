"""Admission of section rows.

A row without its required fields is left out of the section table and kept,
with the reason, in a table of rejected rows. Defaults are filled in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each section's rows must have.
REQUIRED: dict[str, tuple[str, ...]] = {
    "vehicle_journeys": ("departure_time",),
    "flexible_journeys": ("vj_code", "service_ref", "line_ref", "service_times"),
    "timing_links": ("link_id", "from", "to", "from.stop_ref", "to.stop_ref", "route_link_ref", "run_time"),
    "journey_patterns": ("jp_id", "destination_display", "direction", "route_ref", "section_refs"),
    "lines": ("line_id", "line_name"),
    "operating_profiles": ("days",),
    "route_links": ("link_id", "from_stop", "to_stop"),
    "routes": ("route_id",),
    "serviced_organisations": ("code",),
    "flexible_patterns": ("jp_id", "direction"),
    "bookings": ("description",),
    "fare_zones": ("zone_id", "version", "name"),
}


def _missing(df: DataFrame, name: str) -> Column:
    kind = df.select(name).dtypes[0][1]
    empty = F.col(name).isNull()
    if kind == "string":
        empty = empty | (F.col(name) == "")
    elif kind.startswith("array"):
        empty = empty | (F.size(F.col(name)) == 0)
    return empty


def admit(
    df: DataFrame, required: Sequence[str], defaults: Mapping[str, object] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into accepted ones (defaults filled) and rejected ones.

    Both sides come from one flag per row; ``reason`` lists what was missing.
    """
    reason = F.concat_ws(
        ",", *[F.when(_missing(df, name), F.lit(name.replace(".", "_"))) for name in required]
    )
    flagged = df.withColumn("reason", reason)
    accepted = flagged.where(F.col("reason") == "").drop("reason")
    for column, value in (defaults or {}).items():
        accepted = accepted.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return accepted, flagged.where(F.col("reason") != "")


def admit_sections(sections: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Accepted section tables, and all rejected rows by section and reason."""
    accepted, rejected = {}, None
    for name, df in sections.items():
        if name not in REQUIRED:
            accepted[name] = df
            continue
        accepted[name], left = admit(df, REQUIRED[name])
        rows = left.select("file_id", F.lit(name).alias("section"), "reason")
        rejected = rows if rejected is None else rejected.unionByName(rows)
    return accepted, rejected
