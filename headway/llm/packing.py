"""Best-fit packing with exact complements."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from headway.llm.common import in_spread
from headway.llm.tokens import piece_table
from headway.session import staged


def fill_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Ways to fill a sequence, with how often each is used; together they use up ``counts``.

    Works on the counts per length, so its cost depends on ``capacity`` alone.
    Exact fills of up to three more pieces are tried first; where that leaves more
    sequences than the total calls for, shorter fills are tried too and the plan
    with the fewest sequences is taken (of equals the one with longer fills).
    """
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: list[tuple[tuple[int, ...], int]] = []
    for parts in (3, 2, 1, 0):
        plan = _plan(counts, capacity, parts)
        if not best or sum(n for _, n in plan) < sum(n for _, n in best):
            best = plan
        if sum(n for _, n in best) <= least:
            break
    return best


def _plan(counts: dict[int, int], capacity: int, parts: int) -> list[tuple[tuple[int, ...], int]]:
    """Lengths are taken from the largest down. For each, the gap it leaves is
    looked up among the lengths still available, then among the sums of two and
    of three of them (as far as ``parts`` goes), and a combination is consumed as
    often as all its parts last. What finds no exact complement is packed best
    fit, largest first."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        patterns.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    lengths = np.arange(capacity + 1)
    for a in range(capacity - 1, 0, -1):
        while left[a]:
            rest = _complement(left, lengths, a, capacity - a, parts)
            if rest is None:
                break
            pattern = (a, *rest)
            uses = min(int(left[x]) // pattern.count(x) for x in set(pattern))
            for x in pattern:
                left[x] -= uses
            patterns.append((pattern, uses))
    return patterns + _best_fit(left, capacity)


def _complement(left: np.ndarray, lengths: np.ndarray, a: int, gap: int, parts: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap`` once an ``a`` is taken."""
    have = left[: gap + 1].copy()
    if a <= gap:
        have[a] -= 1
    if parts and have[gap]:
        return (gap,)
    pair = _pair(have, lengths, gap) if parts > 1 else None
    if pair or parts < 3:
        return pair
    there = (have > 0).astype(np.float32)
    sums = np.rint(np.convolve(there, there)[: gap + 1])
    for b in np.flatnonzero((have > 0) & (sums[::-1] > 0))[::-1].tolist():
        have[b] -= 1
        pair = _pair(have, lengths, gap - b)
        have[b] += 1
        if pair:
            return (b, *pair)
    return None


def _pair(have: np.ndarray, lengths: np.ndarray, total: int) -> tuple[int, int] | None:
    low = lengths[1 : total // 2 + 1]
    high = total - low
    fits = (have[low] > 0) & (have[high] > 0) & ((low != high) | (have[low] > 1))
    return (int(high[np.argmax(fits)]), int(low[np.argmax(fits)])) if fits.any() else None


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins with equal content are one entry; ``open_bins`` holds them by gap."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}

    def put(pattern: tuple[int, ...], n: int) -> None:
        if n:
            group = open_bins.setdefault(capacity - sum(pattern), {})
            group[pattern] = group.get(pattern, 0) + n

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            gap = min((g for g in open_bins if g >= length), default=None)
            if gap is None:
                each = min(capacity // length, n)
                put((length,) * each, n // each)
                n -= each * (n // each)
                continue
            pattern, bins = next(iter(open_bins[gap].items()))
            each = min(gap // length, n)
            uses = min(bins, n // each)
            open_bins[gap][pattern] -= uses
            if not open_bins[gap][pattern]:
                del open_bins[gap][pattern]
            if not open_bins[gap]:
                del open_bins[gap]
            put(pattern + (length,) * each, uses)
            n -= uses * each
    return [(p, n) for group in open_bins.values() for p, n in group.items()]


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their rank among equals.

    One row per length of a pattern: ranks from ``first`` on, ``each`` of them
    side by side in one sequence from ``offset`` on, the first in ``sequence``.
    """
    rows, used, sequence = [], {}, 0
    for pattern, uses in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            each = pattern.count(length)
            first = used.get(length, 0)
            rows.append((length, first, each, sequence, offset))
            used[length] = first + each * uses
            offset += each * length
        sequence += uses
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(("length", "first", "each", "sequence", "offset"))}


def ranked(pieces: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0, without gaps.

    A length that holds a large share of all rows is spread over hash buckets:
    rows are numbered inside a bucket, buckets are summed up per length.
    """
    buckets = in_spread(pieces.count())
    salted = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (
        salted.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    )
    numbered = salted.withColumn("_row", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)))
    return numbered.join(before, ["length", "_bucket"]).withColumn("rank", F.col("_before") + F.col("_row") - 1).drop("_bucket", "_row", "_before")


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """Append ``sequence_id, offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Only the counts per length (at most ``capacity`` rows) reach the driver; the
    plan made of them is no larger at any size of data and goes out with the
    tasks. ``order`` names columns that tell pieces apart; pieces equal in all of
    them are interchangeable.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    slots = slot_table(fill_patterns(counts, capacity))
    rows = ranked(pieces, order)
    kept = [c for c in rows.columns if c not in ("rank", "sequence_id", "offset")]
    schema = rows.select(*kept).schema.add("sequence_id", LongType()).add("offset", LongType())
    starts = np.searchsorted(slots["length"], np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slots sorted by length, then first rank: one search in a joint order.
        span = int(slots["first"].max(initial=0)) + 1
        joint = slots["length"] * span + slots["first"] if len(slots["first"]) else np.zeros(0, dtype=np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(joint, length * span + np.minimum(rank, span - 1), side="right") - 1
            at = np.maximum(at, starts[length])
            ahead = rank - slots["first"][at]
            each = slots["each"][at]
            sequence = slots["sequence"][at] + ahead // each
            offset = slots["offset"][at] + ahead % each * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return rows.select(*kept, "rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text: str = "text", end: int = 0) -> DataFrame:
    """Cut documents into pieces and pack them into sequences.

    One row per piece: id, ``piece, start, length, ids_crc32, sequence_id,
    offset``. Texts are encoded once; the pieces (a few numbers each) are staged.
    A null or empty text is one piece that holds the end id alone; repeated rows
    are packed each; rows without an id too. An empty table gives no rows.
    """
    pieces = staged(piece_table(docs, tokenizer, capacity, id_col, text, end))
    columns = [id_col, "piece", "start", "length", "ids_crc32"]
    return pack(pieces, capacity, columns).select(*columns, "sequence_id", "offset")
