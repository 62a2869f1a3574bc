"""Fares documents to frame and detail tables.

Frames come from the top level and from composite frames alike; a composite
frame inside another is not read, and one whose id marks metadata is skipped
with all it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.rollup import METADATA_MARK
from headway.rules.runner import each
from headway.sources.admission import REQUIRED, admit


def composites() -> Column:
    """Composite frames that carry no metadata mark."""
    return F.filter(
        F.coalesce(F.col("dataObjects.CompositeFrame"), F.array()),
        lambda c: ~F.coalesce(c["_id"].contains(METADATA_MARK), F.lit(False)),
    )


def frames(kind: str) -> Column:
    """All frames of one kind, top-level ones first."""
    top = F.coalesce(F.col(f"dataObjects.{kind}"), F.array())
    return F.concat(top, each(composites(), lambda c: c["frames"][kind]))


def _first(column: Column) -> Column:
    return F.get(column, F.lit(0))


def _text(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def _rows(docs: DataFrame, array: Column, pos: str = "pos") -> DataFrame:
    return docs.select("file_id", F.posexplode(array).alias(pos, "e"))


def files(docs: DataFrame) -> DataFrame:
    return docs.select("file_id", F.col("_version").alias("schema_version"))


def composite_frames(docs: DataFrame) -> DataFrame:
    between = _first(F.col("e.ValidBetween"))
    return _rows(docs, composites(), "frame_pos").select(
        "file_id",
        "frame_pos",
        F.col("e._id").alias("frame_id"),
        F.to_timestamp(_text(between["FromDate"])).alias("from_date"),
        F.to_timestamp(_text(between["ToDate"])).alias("to_date"),
    )


# Product elements with columns of their own; ``xs_any`` holds all other children.
PRODUCT_KINDS = ("PreassignedFareProduct", "AmountOfPriceUnitProduct", "CappedDiscountRight", "xs_any")


def fare_frames(docs: DataFrame) -> DataFrame:
    """Fare frames; every child of their products counts as one."""
    products = F.col("e.fareProducts")
    total = F.lit(0)
    for kind in PRODUCT_KINDS:
        total = total + F.size(_kind(products, kind))
    return _rows(docs, frames("FareFrame"), "frame_pos").select(
        "file_id",
        "frame_pos",
        F.col("e._id").alias("frame_id"),
        _first(F.col("e.TypeOfFrameRef"))["_ref"].alias("type_ref"),
        total.cast("bigint").alias("num_of_fare_products"),
    )


def _kind(products: Column, kind: str) -> Column:
    return each(products, lambda p: p[kind])


def zone_rows(docs: DataFrame) -> DataFrame:
    """Every zone element, complete or not."""
    zones = each(each(frames("FareFrame"), lambda f: f["fareZones"]), lambda z: z["FareZone"])
    return _rows(docs, zones).select(
        "file_id",
        "pos",
        F.col("e._id").alias("zone_id"),
        F.col("e._version").alias("version"),
        F.col("e.Name").alias("name"),
        F.col("e.members.ScheduledStopPointRef").alias("members"),
    )


def fare_zones(docs: DataFrame) -> DataFrame:
    """Zones with id, version and name; others are rejected (``rejected_zones``)."""
    return admit(zone_rows(docs), REQUIRED["fare_zones"])[0]


def rejected_zones(docs: DataFrame) -> DataFrame:
    left = admit(zone_rows(docs), REQUIRED["fare_zones"])[1]
    return left.select("file_id", F.lit("fare_zones").alias("section"), "reason")


def failed_files(docs: DataFrame) -> DataFrame:
    """Files with a structure element that lacks id or version: nothing of them is read."""
    bad = F.exists(
        _structure_elements(),
        lambda e: (F.coalesce(e["_id"], F.lit("")) == "") | (F.coalesce(e["_version"], F.lit("")) == ""),
    )
    return docs.where(bad).select(
        "file_id", F.lit("FARES_ETL_ERROR").alias("error_code"), F.lit("FareStructureElement without id or version").alias("message")
    )


def zone_stop_refs(docs: DataFrame) -> DataFrame:
    """Stops named by fare zones, by code type."""
    members = fare_zones(docs).select("file_id", "zone_id", F.explode("members").alias("m"))
    parts = F.split("m._ref", ":")
    is_atco = F.get(parts, F.lit(0)).isin("atco", "naptan")
    code = F.when(F.size(parts) == 2, F.get(parts, F.lit(1)))
    return members.select(
        "file_id",
        "zone_id",
        F.when(is_atco, code).alias("atco_code"),
        F.when(~is_atco, code).alias("naptan_code"),
    )


def _tariffs() -> Column:
    return each(frames("FareFrame"), lambda f: f["tariffs"]["Tariff"])


def tariffs(docs: DataFrame) -> DataFrame:
    return _rows(docs, _tariffs()).select(
        "file_id",
        "pos",
        F.col("e._id").alias("tariff_id"),
        F.col("e.Name").alias("name"),
        _first(F.col("e.TariffBasis")).alias("tariff_basis"),
    )


def tariff_validity(docs: DataFrame) -> DataFrame:
    between = each(F.col("e.validityConditions"), lambda v: v["ValidBetween"])
    rows = _rows(docs, _tariffs()).select("file_id", F.explode(between).alias("b"))
    return rows.select(
        "file_id",
        F.to_timestamp(_text(F.col("b.FromDate"))).alias("from_date"),
        F.to_timestamp(_text(F.col("b.ToDate"))).alias("to_date"),
    )


def _structure_elements() -> Column:
    return each(each(_tariffs(), lambda t: t["fareStructureElements"]), lambda g: g["FareStructureElement"])


def structure_elements(docs: DataFrame) -> DataFrame:
    """Structure elements with their first parameter assignment."""
    given = _first(F.col("e.GenericParameterAssignment"))
    return _rows(docs, _structure_elements()).select(
        "file_id",
        "pos",
        F.col("e._id").alias("element_id"),
        _first(F.col("e.TypeOfFareStructureElementRef"))["_ref"].alias("type_ref"),
        _first(given["TypeOfAccessRightAssignmentRef"])["_ref"].alias("access_right_ref"),
        given["limitations"].alias("limitations"),
    )


def user_profiles(docs: DataFrame) -> DataFrame:
    profiles = each(F.col("limitations"), lambda l: l["UserProfile"])
    rows = structure_elements(docs).select("file_id", F.explode(profiles).alias("u"))
    return rows.select("file_id", F.col("u.UserType").alias("user_type")).where("user_type <> ''")


def fare_products(docs: DataFrame) -> DataFrame:
    """Preassigned products; other kinds only count."""
    products = each(
        each(frames("FareFrame"), lambda f: f["fareProducts"]), lambda p: p["PreassignedFareProduct"]
    )
    return _rows(docs, products).select(
        "file_id",
        "pos",
        F.col("e._id").alias("product_id"),
        _text(F.col("e.Name")).alias("name"),
        _text(F.col("e.ProductType")).alias("product_type"),
    )


def sales_offer_packages(docs: DataFrame) -> DataFrame:
    packages = each(
        each(frames("FareFrame"), lambda f: f["salesOfferPackages"]), lambda s: s["SalesOfferPackage"]
    )
    return _rows(docs, packages).select("file_id", "pos", F.col("e._id").alias("package_id"), F.col("e.Name").alias("name"))


def _tables() -> Column:
    return each(each(frames("FareFrame"), lambda f: f["fareTables"]), lambda g: g["FareTable"])


def _table_parts(docs: DataFrame, wrapper: str, item: str) -> DataFrame:
    return _rows(docs, _tables(), "table_pos").select(
        "file_id", F.col("e._id").alias("table_id"), F.posexplode(F.col(f"e.{wrapper}.{item}")).alias("pos", "i")
    )


def fare_table_rows(docs: DataFrame) -> DataFrame:
    return _table_parts(docs, "rows", "FareTableRow").select(
        "file_id", "table_id", "pos", F.col("i._id").alias("row_id"), F.col("i._order").cast("int").alias("order"), F.col("i.Name").alias("name")
    )


def fare_table_columns(docs: DataFrame) -> DataFrame:
    return _table_parts(docs, "columns", "FareTableColumn").select(
        "file_id", "table_id", "pos", F.col("i._id").alias("column_id"), F.col("i._order").cast("int").alias("order"), F.col("i.Name").alias("name")
    )


def fare_table_cells(docs: DataFrame) -> DataFrame:
    return _table_parts(docs, "cells", "Cell").select(
        "file_id", "table_id", "pos", F.col("i.RowRef._ref").alias("row_id"), F.col("i.ColumnRef._ref").alias("column_id"),
        F.col("i.Amount").try_cast("double").alias("amount"),
    )


def price_groups(docs: DataFrame) -> DataFrame:
    groups = each(frames("FareFrame"), lambda f: f["priceGroups"]["PriceGroup"])
    return _rows(docs, groups).select(
        "file_id", F.col("e._id").alias("group_id"), F.posexplode("e.members.GeographicalIntervalPrice").alias("pos", "i")
    ).select("file_id", "group_id", "pos", F.col("i._id").alias("price_id"), F.col("i.Amount").try_cast("double").alias("amount"))


def lines(docs: DataFrame) -> DataFrame:
    found = each(each(frames("ServiceFrame"), lambda f: f["lines"]), lambda g: g["Line"])
    return _rows(docs, found).select(
        "file_id",
        "pos",
        F.col("e._id").alias("line_id"),
        F.col("e.Name").alias("name"),
        _text(F.col("e.PublicCode")).alias("public_code"),
    )


def stop_areas(docs: DataFrame) -> DataFrame:
    """Area code of each scheduled stop point: three digits after ``atco:``."""
    stops = each(each(frames("ServiceFrame"), lambda f: f["scheduledStopPoints"]), lambda g: g["ScheduledStopPoint"])
    rows = _rows(docs, stops).select("file_id", F.col("e._id").alias("stop_id"))
    code = F.regexp_extract("stop_id", r"atco:(\d{3})", 1)
    return rows.where(code != "").select("file_id", code.cast("int").alias("area_code"))


def operators(docs: DataFrame) -> DataFrame:
    found = each(each(frames("ResourceFrame"), lambda f: f["organisations"]), lambda g: g["Operator"])
    return _rows(docs, found).select(
        "file_id", "pos", F.col("e._id").alias("operator_id"), _first(F.col("e.PublicCode")).alias("public_code"), F.col("e.Name").alias("name")
    ).where("public_code is not null")


DETAILS = {
    "files": files,
    "composite_frames": composite_frames,
    "fare_frames": fare_frames,
    "fare_zones": fare_zones,
    "zone_stop_refs": zone_stop_refs,
    "tariffs": tariffs,
    "tariff_validity": tariff_validity,
    "structure_elements": structure_elements,
    "user_profiles": user_profiles,
    "fare_products": fare_products,
    "sales_offer_packages": sales_offer_packages,
    "fare_table_rows": fare_table_rows,
    "fare_table_columns": fare_table_columns,
    "fare_table_cells": fare_table_cells,
    "price_groups": price_groups,
    "lines": lines,
    "stop_areas": stop_areas,
    "operators": operators,
}


def details(docs: DataFrame) -> dict[str, DataFrame]:
    return {name: read(docs) for name, read in DETAILS.items()}
