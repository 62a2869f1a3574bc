"""Repeated runs of lines, found in a suffix array built by prefix doubling."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import document_key, in_spread, unused
from headway.session import staged


def line_ids(lines: DataFrame) -> DataFrame:
    """``h1, h2, rank`` of every line that occurs more than once.

    ``rank`` counts the occurrences of smaller lines, in the order of the hashes.
    Lines are summed up per range of hashes, about as many ranges as the square
    root of the distinct lines, and inside each range.
    """
    distinct = staged(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    bits = max(1, math.ceil(math.log2(in_spread(distinct.count()) + 1)))
    spread = distinct.withColumn("bucket", F.shiftrightunsigned("h1", 64 - bits))
    sums = spread.groupBy("bucket").agg(F.sum("n").alias("total"))
    before = sums.select("bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("before"))
    inner = F.sum("n").over(Window.partitionBy("bucket").orderBy("h1", "h2")) - F.col("n")
    return spread.withColumn("inner", inner).join(before, "bucket").select("h1", "h2", (F.col("before") + F.col("inner")).alias("rank"))


def extend(suffixes: DataFrame, step: int, width: int) -> DataFrame:
    """One round: ranks by the first L lines become ranks by the first L + ``step``.

    ``suffixes`` holds the suffixes ``did, th, idx`` whose first L lines occur more
    than once, with equal ``rank`` for equal ones, in order. A suffix whose
    follower ``step`` lines on is missing there holds a line sequence found once
    and goes, as does one whose pair of ranks is found once. The others are ranked
    inside their old rank by the rank of the follower: followers are counted per
    pair, summed up per range of ``width`` follower ranks, then inside a range, so
    that one frequent line does not put all its followers into one task. Further
    columns stay.
    """
    ahead = Window.partitionBy("did", "th").orderBy("idx").rangeBetween(step, step)
    pairs = staged(suffixes.withColumn("second", F.max("rank").over(ahead)).where("second IS NOT NULL"))
    groups = pairs.groupBy("rank", "second").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = groups.withColumn("bucket", F.floor(F.col("second") / width))
    sums = groups.groupBy("rank", "bucket").agg(F.sum("n").alias("total"))
    before = sums.select(
        "rank", "bucket", (F.sum("total").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("total")).alias("before")
    )
    inner = F.sum("n").over(Window.partitionBy("rank", "bucket").orderBy("second")) - F.col("n")
    ranked = (
        groups.withColumn("inner", inner)
        .join(before, ["rank", "bucket"])
        .select("rank", "second", (F.col("rank") + F.col("before") + F.col("inner")).alias("next"))
    )
    return pairs.join(ranked, ["rank", "second"]).select(*[c for c in suffixes.columns if c != "rank"], F.col("next").alias("rank"))


def repeated_suffixes(lines: DataFrame, depth: int) -> DataFrame:
    """Suffixes whose first ``depth`` lines occur more than once, ranked by these lines.

    Rows of one rank are one interval of the suffix array with a longest common
    prefix of at least ``depth``. The known prefix doubles from round to round;
    the last round adds what is missing to ``depth``.
    """
    width = in_spread(lines.count())
    suffixes, known = lines, 1
    while known < depth:
        step = min(known, depth - known)
        suffixes = extend(suffixes, step, width)
        known += step
    return suffixes


def later_copies(suffixes: DataFrame, depth: int) -> DataFrame:
    """``did, th, idx`` of the first ``depth`` lines of every suffix that is not the first of its interval."""
    place = F.struct("did", "th", "idx")
    heads = suffixes.groupBy("rank").agg(F.min(place).alias("head"))
    later = suffixes.join(heads, "rank").where(place != F.col("head"))
    return later.select("did", "th", F.explode(F.sequence("idx", F.col("idx") + F.lit(depth - 1))).alias("idx"))


def long_copies(lines: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """Lines of later copies of runs of ``min_lines`` lines, or of fewer with ``min_words`` words.

    ``lines`` has ``did, th, idx, rank, words``. Rounds add one line each; words
    are the same all over an interval, so an interval counts as a whole or not.
    """
    width = in_spread(lines.count())
    ahead = Window.partitionBy("did", "th").orderBy("idx")
    totals = {f"words_{d}": F.sum("words").over(ahead.rangeBetween(0, d - 1)) for d in range(1, min_lines)}
    suffixes = staged(lines.withColumns(totals).drop("words")) if totals else lines.drop("words")
    covered = []
    for depth in range(1, min_lines + 1):
        if depth > 1:
            suffixes = staged(extend(suffixes, 1, width))
        enough = suffixes.where(F.col(f"words_{depth}") >= min_words) if depth < min_lines else suffixes
        covered.append(later_copies(enough, depth))
    return reduce(DataFrame.union, covered)


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def drop_repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_lines: int = 3, min_words: int | None = None
) -> DataFrame:
    """Delete later copies of repeated line runs.

    Documents are sequences of their lines that hold a word (lines are split at
    \\n). A run of at least ``min_lines`` lines that occurs more than once, in one
    document or in several, stays where it occurs first, in the order of id,
    content hash and place; in all later places its lines are deleted. Every
    maximal run is a union of runs of ``min_lines`` lines and a longer one has a
    copy exactly where all of these have, so the suffix array is sorted to that
    depth, and each interval with a longest common prefix of ``min_lines`` keeps
    its first suffix. With ``min_words``, a run of fewer lines counts too if it has
    so many words, down to a single line (``long_copies``).

    Returns ``docs`` with ``text`` replaced by what is left (wordless lines stay)
    and ``n_lines`` (lines with a word), ``n_removed``. A null text stays null
    with no lines; an empty one has none. Rows that repeat id and text are one
    document and get equal results; a null id comes after all others; columns of
    ``docs`` named like new ones are replaced.

    DataFrame functions only. Lines found once end every run, so only repeated
    lines take part in the rounds; every row is a few numbers.
    """
    new = ("n_lines", "n_removed")
    did, th = document_key(id_col, text)
    own_did, own_th, own_lines, own_removed = unused(docs, "_did", "_th", "_lines", "_removed")
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (text, *new)],
        did.alias(own_did),
        th.alias(own_th),
        F.split(F.col(f"`{text}`"), "\n", -1).alias(own_lines),
    )
    carried = ["words"] if min_words is not None else []

    def counted(line: Column) -> list[Column]:
        return [F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias(c) for c in carried]

    hashed = F.filter(
        F.transform(
            F.split(F.col(f"`{text}`"), "\n", -1),
            lambda x, i: F.struct(
                i.alias("pos"), F.when(has_word(x), F.xxhash64(x)).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), *counted(x)
            ),
        ),
        lambda s: s["h1"].isNotNull(),
    )
    fields = [f"line.{c}" for c in ("pos", "h1", "h2", *carried)]
    lines = staged(docs.select(did, th, F.posexplode(hashed).alias("idx", "line")).select("did", "th", "idx", *fields))
    least = [F.min(c).alias(c) for c in ("pos", "rank", *carried)]
    first = staged(lines.join(line_ids(lines), ["h1", "h2"]).groupBy("did", "th", "idx").agg(*least))
    if min_words is None:
        found = later_copies(staged(repeated_suffixes(first.drop("pos"), min_lines)), min_lines)
    else:
        found = long_copies(first.drop("pos"), min_lines, min_words)
    covered = found.distinct()
    removed = (
        first.select("did", "th", "idx", "pos")
        .join(covered, ["did", "th", "idx"])
        .groupBy(F.col("did").alias(own_did), F.col("th").alias(own_th))
        .agg(F.collect_set("pos").alias(own_removed))
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(own_lines) - 1), F.col(own_removed))
    out = keyed.join(removed, [own_did, own_th], "left").withColumns(
        {
            text: F.when(F.col(own_removed).isNull(), F.array_join(own_lines, "\n")).otherwise(
                F.array_join(F.transform(kept, lambda i: F.col(own_lines)[i]), "\n")
            ),
            "n_lines": F.coalesce(F.size(F.filter(own_lines, has_word)), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size(own_removed), F.lit(0)).cast("long"),
        }
    )
    order = [c for c in docs.columns if c not in new] + list(new)
    return out.select(*[F.col(f"`{c}`") for c in order])
