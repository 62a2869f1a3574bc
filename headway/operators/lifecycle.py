"""Which files count: supersession, duplicates, revision status, ledgers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.text import has_path_separator


def latest_by_name(files: DataFrame, keys: Sequence[str] = ("revision_id", "filename"), order: Sequence[str] = ("id",)) -> DataFrame:
    """Per revision and file name the row that comes last in ``order``.

    Later columns decide where earlier ones are equal; a null comes before all
    values. A null name is a name. ``order`` should end in a column that tells rows
    apart; rows equal in all of it stay together.
    """
    place = F.struct(*[F.struct(F.col(c).isNotNull().alias(f"has_{i}"), F.col(c).alias(f"v_{i}")) for i, c in enumerate(order)])
    last = files.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max(place).alias("_last"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = files.join(last, reduce(and_, same))
    return joined.where(place == F.col("_last")).drop(*[f"_key_{k}" for k in keys], "_last")


def supersession(
    files: DataFrame,
    keys: Sequence[str] = ("revision_id", "service_code"),
    revision: str = "revision_number",
    start: str = "operating_period_start_date",
) -> DataFrame:
    """Flag files that a higher revision number of the same service code supersedes.

    Files meet within one upload (``revision_id``) only.

    Kept are all files at the highest revision, and lower ones that start
    before the latest start found there (all lower ones if none is given
    there). The per-code summary is a partial aggregation, so a code that holds
    most of the files is reduced before the shuffle; the join back is one an
    adaptive plan can split.
    """
    # max over (revision, start) gives the top revision and its latest start.
    top = files.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.max(F.struct(F.col(revision).alias("revision"), F.col(start).alias("start"))).alias("_top")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = files.join(top, reduce(and_, same))
    kept = (
        (F.col(revision) == F.col("_top.revision"))
        | F.col("_top.start").isNull()
        | (F.col(start) < F.col("_top.start"))
    )
    return joined.withColumn("superseded", ~F.coalesce(kept, F.lit(False))).drop(*[f"_key_{k}" for k in keys], "_top")


def file_counts(flagged: DataFrame) -> DataFrame:
    """Active and superseded files per revision."""
    return flagged.groupBy("revision_id").agg(
        F.count_if(~F.col("superseded")).alias("active"),
        F.count_if(F.col("superseded")).alias("superseded"),
    )


def hot_pairs(tracks: DataFrame, keys: Sequence[str] = ("from_atco_code", "to_atco_code")) -> DataFrame:
    """Pairs held by more than one row, most frequent first."""
    return (
        tracks.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("tracks"))
        .where("tracks > 1")
        .orderBy(F.desc("tracks"), *keys)
    )


def batches(df: DataFrame, by: str, keys: Sequence[str], size: int) -> DataFrame:
    """Number rows into batches of ``size``, highest ``by`` (a whole number, 0 or more) first.

    Rows that tie on ``by`` have no order of their own, so they are spread over
    hash buckets and numbered there. Rows ahead of a bucket are summed up in
    three steps: over ranges of ``by``, over the values of one range, over the
    buckets of one value. Each step orders about the square root of what there is.
    """
    n, top = df.agg(F.count(F.lit(1)), F.max(by)).first()
    spread, width = math.ceil(math.sqrt(n or 1)), math.ceil(math.sqrt((top or 0) + 1))
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(spread)))
    counts = bucketed.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    values = counts.groupBy(by).agg(F.sum("_n").alias("_n")).withColumn("_range", F.floor(F.col(by) / width))
    ranges = values.groupBy("_range").agg(F.sum("_n").alias("_n"))
    in_ranges = F.sum("_n").over(Window.orderBy(F.desc("_range"))) - F.col("_n")
    in_values = F.sum("_n").over(Window.partitionBy("_range").orderBy(F.desc(by))) - F.col("_n")
    in_buckets = F.sum("_n").over(Window.partitionBy(by).orderBy("_bucket")) - F.col("_n")
    ahead = values.select(by, "_range", in_values.alias("_b")).join(ranges.select("_range", in_ranges.alias("_a")), "_range")
    offsets = counts.select(by, "_bucket", in_buckets.alias("_c")).join(ahead, by)
    row = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy(*keys)) - 1
    place = F.col("_row") + F.col("_a") + F.col("_b") + F.col("_c")
    return (
        bucketed.withColumn("_row", row)
        .join(offsets.drop("_range"), [by, "_bucket"])
        .withColumn("batch_id", F.floor(place / size))
        .drop("_row", "_a", "_b", "_c", "_bucket")
    )


def unchanged_files(corpus: DataFrame, live: DataFrame) -> DataFrame:
    """Files whose content is already live in their own dataset."""
    return corpus.join(live.select("dataset_id", "sha1").distinct(), ["dataset_id", "sha1"], "left_semi")


def changed_files(corpus: DataFrame, live: DataFrame) -> DataFrame:
    """Files still to be processed: content not live in their dataset yet."""
    return corpus.join(live.select("dataset_id", "sha1").distinct(), ["dataset_id", "sha1"], "left_anti")


def without_violations(file_attributes: DataFrame, violations: DataFrame) -> DataFrame:
    """File attribute rows of files that broke no rule."""
    bad = violations.select("revision_id", F.col("file").alias("filename")).distinct()
    return file_attributes.join(bad, ["revision_id", "filename"], "left_anti")


def revision_moves(draft: DataFrame, live: DataFrame) -> DataFrame:
    """Draft files whose revision number does not move as it should.

    Live files of the same dataset with the same service code and line set are
    read by ascending revision, then id. The first decisive one settles it: same modification
    time needs the same revision; otherwise a live revision not below the
    draft's is a violation.

    Live rows are reduced before any draft meets them: to the first row per
    modification time, and per revision to the first row and the first with
    another time than that one's. So a draft meets at most one row per revision
    number of its service, however many files the service has.
    """
    key = ["dataset_id", "service_code", "_lines"]
    lines = F.array_sort("line_names")
    modified, place = F.col("modification_datetime"), F.struct("revision", "id")
    rows = live.select(
        "dataset_id",
        "service_code",
        lines.alias("_lines"),
        F.col("modification_datetime").alias("modified"),
        F.col("revision_number").alias("revision"),
        "id",
    )
    by_time = rows.groupBy(*key, "modified", "revision").agg(F.min("id").alias("id"))
    same_time = by_time.groupBy(*key, "modified").agg(F.min(place).alias("same"))
    first = by_time.groupBy(*key, "revision").agg(F.min(F.struct("id", "modified")).alias("first"))
    second = (
        by_time.join(first, [*key, "revision"])
        .where(~F.col("modified").eqNullSafe(F.col("first.modified")))
        .groupBy(*key, "revision")
        .agg(F.min("id").alias("second_id"))
    )
    by_revision = first.join(second, [*key, "revision"], "left")

    drafts = draft.withColumn("_lines", lines)
    ahead = drafts.join(by_revision, key).where(F.col("revision") >= F.col("revision_number"))
    other_id = F.when(
        ~F.col("first.modified").eqNullSafe(modified), F.col("first.id")
    ).otherwise(F.col("second_id"))
    names = ["revision_id", "filename", "id"]
    behind = (
        ahead.withColumn("other_id", other_id)
        .where("other_id is not null")
        .groupBy(*[drafts[n] for n in names])
        .agg(F.min(F.struct("revision", F.col("other_id").alias("id"))).alias("behind"))
    )
    judged = (
        drafts.join(
            same_time.withColumnsRenamed({"dataset_id": "_dataset", "service_code": "_code", "_lines": "_live_lines"}),
            (F.col("dataset_id") == F.col("_dataset"))
            & (F.col("service_code") == F.col("_code"))
            & (F.col("_lines") == F.col("_live_lines"))
            & F.col("modified").eqNullSafe(modified),
            "left",
        )
        .join(behind, names, "left")
    )
    decided_by_time = F.col("same").isNotNull() & (
        F.col("behind").isNull() | (F.col("same") < F.col("behind"))
    )
    wrong = F.when(decided_by_time, F.col("same.revision") != F.col("revision_number")).otherwise(
        F.col("behind").isNotNull()
    )
    return judged.where(wrong).select("revision_id", "filename").distinct()


def revision_status(file_status: DataFrame, repackaged: DataFrame | None = None) -> DataFrame:
    """Status of each revision: error if no file succeeded, or if any failed when
    written out again; success otherwise, and only then publishable."""
    counts = file_status.groupBy("revision_id").agg(
        F.count_if(F.col("status") == "succeeded").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    if repackaged is None:
        joined = counts.withColumn("repack_failed", F.lit(0).cast("bigint"))
    else:
        failures = repackaged.groupBy("revision_id").agg(
            F.count_if(F.col("status") == "failed").alias("repack_failed")
        )
        joined = counts.join(failures, "revision_id", "left").withColumn(
            "repack_failed", F.coalesce("repack_failed", F.lit(0).cast("bigint"))
        )
    code = F.when(F.col("succeeded") == 0, "NO_VALID_FILE_TO_PROCESS").when(
        F.col("repack_failed") > 0, "SYSTEM_ERROR"
    )
    return joined.select(
        "revision_id",
        "succeeded",
        "failed",
        F.when(code.isNull(), "success").otherwise("error").alias("status"),
        code.alias("error_code"),
        code.isNull().alias("publishable"),
    )


def live_pointers(datasets: DataFrame, revisions: DataFrame) -> DataFrame:
    """Move each dataset's pointer to its newest live published revision."""
    live = revisions.where("status = 'live' and is_published").groupBy("dataset_id").agg(
        F.max("id").alias("_live")
    )
    return (
        datasets.join(live, datasets["id"] == live["dataset_id"], "left")
        .select("id", F.coalesce("_live", "live_revision_id").alias("live_revision_id"))
    )


def post_schema_results(files: DataFrame, clashes: DataFrame | None = None) -> DataFrame:
    """Results of the checks after schema validation, in one table.

    File names may hold no path separator. ``clashes(file_id, dataset_id)``
    names published datasets that carry a file's service code; without it that
    check is switched off.
    """
    names = files.where(has_path_separator(F.col("filename"))).select(
        "file_id", F.lit("PII_ERROR").alias("error_code"), F.col("filename").alias("details")
    )
    if clashes is None:
        return names
    exists = clashes.select(
        "file_id", F.lit("SERVICE EXISTS").alias("error_code"), F.col("dataset_id").cast("string").alias("details")
    )
    return names.unionByName(exists.distinct())


def revisions_with_violations(*violation_tables: DataFrame) -> DataFrame:
    """Revisions named in any of the violation tables: whom to notify."""
    keys = [t.select("revision_id").distinct() for t in violation_tables]
    merged = keys[0]
    for k in keys[1:]:
        merged = merged.unionByName(k)
    return merged.distinct()


def stage_ledger(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per file, stage and attempt: status, error code and message."""
    rows = None
    for step, df in stages.items():
        failed = F.col("error_code").isNotNull()
        part = df.select(
            "revision_id",
            "file_key",
            F.lit(step).alias("step"),
            F.when(failed, "failed").otherwise("succeeded").alias("status"),
            "error_code",
            "message",
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def merged_statistics(results: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Sums of numeric statistics over successes, and the number of failures."""
    ok = F.col("status") == "succeeded"
    return results.agg(
        *[F.coalesce(F.sum(F.when(ok, F.col(s))), F.lit(0)).alias(s) for s in stats],
        F.count_if(~ok).alias("failures"),
    )
