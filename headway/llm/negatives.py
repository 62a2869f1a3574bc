"""Hard negatives by a vertical scan: dimensions in columns, largest weights first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import unused
from headway.session import staged

# Rows of one block of vectors, anchors of one block, blocks that meet an anchor block in one task.
BLOCK_ROWS = 4096
ANCHOR_ROWS = 1024
CELL_BLOCKS = 4

# Dimensions between two looks at the bounds.
STRIDE = 8

LAST = (1 << 63) - 1

BLOCK = "block long, n int, width int, largest long, rows binary, ids binary, unnamed binary, labels array<string>, dims binary"


def usable(vector: Column) -> Column:
    """Vectors all of whose components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def in_blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows ``row, id, label, v`` as blocks of at most ``size`` with one column per dimension, without a shuffle."""

    def block(part: pa.RecordBatch) -> pa.RecordBatch:
        lists = part.column("v")
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        width, largest = int(lengths.max(initial=0)), int(np.abs(flat).max(initial=0))
        dims = np.zeros((part.num_rows, width), dtype="<i4" if largest < 1 << 31 else "<i8")
        dims[np.arange(width) < lengths[:, None]] = flat
        rows, ids = part.column("row").to_numpy(), part.column("id")
        columns = [
            pa.array(rows[:1], pa.int64()),
            pa.array([part.num_rows], pa.int32()),
            pa.array([width], pa.int32()),
            pa.array([largest], pa.int64()),
            pa.array([rows.astype("<i8").tobytes()]),
            pa.array([ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype("<i8").tobytes()]),
            pa.array([ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]),
            pa.array([part.column("label").to_pylist()], pa.list_(pa.string())),
            pa.array([dims.T.tobytes()]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in BLOCK.split(", ")])

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch, n = batch.slice(part.num_rows), n + part.num_rows
                held.append(part)
                if n == size:
                    yield block(joined(held))
                    held, n = [], 0
        if held:
            yield block(joined(held))

    return vectors.select("row", "id", "label", "v").mapInArrow(work, BLOCK)


class Vectors:
    """A block, opened: ``dims[d]`` is dimension ``d`` of all rows."""

    def __init__(self, columns: dict, i: int):
        n, width = columns["n"][i], columns["width"][i]
        self.rows = np.frombuffer(columns["rows"][i], "<i8")
        self.ids = np.frombuffer(columns["ids"][i], "<i8")
        self.unnamed = np.frombuffer(columns["unnamed"][i], np.uint8).astype(bool)
        self.labels = columns["labels"][i]
        self.largest = columns["largest"][i]
        self.dims = np.frombuffer(columns["dims"][i], "<i4" if self.largest < 1 << 31 else "<i8").reshape(width, n)
        self.order = np.lexsort((self.rows, self.ids, self.unnamed))

    @property
    def place(self) -> np.ndarray:
        """Rank of each row by id (rows without one last), equal ids by row."""
        out = np.empty(len(self.order), dtype=np.int64)
        out[self.order] = np.arange(len(self.order))
        return out

    def scannable(self, width: int, kind) -> Scan:
        return Scan(self.dims[:width].astype(kind))


class Scan:
    def __init__(self, dims: np.ndarray):
        self.dims = dims
        self.least = dims.min(axis=1) if dims.size else np.zeros(len(dims), dims.dtype)
        self.most = dims.max(axis=1) if dims.size else np.zeros(len(dims), dims.dtype)


def number_kind(width: int, left: int, right: int):
    """Floats that hold every partial sum exactly are quicker than integers."""
    bound = max(1, width) * max(1, left) * max(1, right)
    if bound >= 1 << 56:
        raise ValueError("inner products of these vectors do not fit into 64 bits")
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def bond(scan: Scan, query: np.ndarray, candidates: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
    """Rows that ``needed`` cannot rule out, with their exact inner products.

    Dimensions are read in descending order of the query's magnitude, ``STRIDE``
    at a time. After each step every candidate has a partial product and, from
    the least and largest values of the dimensions left, bounds of the whole;
    ``needed(low, high)`` says which candidates still count.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    weights, low, high = query[order], scan.least[order] * query[order], scan.most[order] * query[order]
    low, high = np.minimum(low, high), np.maximum(low, high)
    low_left = np.append(np.cumsum(low[::-1])[::-1], 0)
    high_left = np.append(np.cumsum(high[::-1])[::-1], 0)
    score = np.zeros(len(candidates), dtype=scan.dims.dtype)
    for a in range(0, len(order), STRIDE):
        if not len(candidates):
            break
        b = min(a + STRIDE, len(order))
        read = scan.dims[order[a:b]]
        score += weights[a:b] @ (read if len(candidates) == read.shape[1] else read[:, candidates])
        if b < len(order):
            kept = needed(score + low_left[b], score + high_left[b])
            candidates, score = candidates[kept], score[kept]
    return candidates, score.astype(np.int64)


def best(score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` by score, highest first, equal ones by place."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= edge)
        return near[np.lexsort((place[near], -score[near]))[:k]]
    return np.lexsort((place, -score))


def kth_largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def _columns(table: pa.Table) -> dict:
    return {name: table.column(name).to_pylist() for name in table.column_names}


FOUND = "anchor long, positive long, row long, id long, score long, positive_score long"


def _scan_cells(blocks: DataFrame, anchors: DataFrame, per_cell) -> DataFrame:
    """Every block of vectors meets every block of anchors, once, in tasks of bounded size.

    Vectors are dealt to ``slots`` groups of about ``CELL_BLOCKS`` blocks each and repeated
    per group of anchors, anchors are repeated per slot: the stated queries
    against all rows, block by block.
    """
    groups = anchors.select("group").distinct().count()
    slots = max(1, -(-blocks.count() // CELL_BLOCKS))
    left = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(max(groups - 1, 0)))))
    right = anchors.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>")))
    return left.groupBy("group", "slot").cogroup(right.groupBy("group", "slot")).applyInArrow(lambda a, b: per_cell(_columns(a), _columns(b)), FOUND)


def _found(rows: list[tuple]) -> pa.Table:
    names = [x.split()[0] for x in FOUND.split(", ")]
    if not rows:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    columns = zip(*rows, strict=True)
    return pa.table({n: pa.array([x for c in column for x in c], pa.int64()) for n, column in zip(names, columns, strict=True)})


def _ids(block: Vectors, at: np.ndarray) -> list:
    return [None if u else int(i) for i, u in zip(block.ids[at], block.unnamed[at], strict=True)]


def nearest_of_label(columns: dict, anchors: dict, k: int) -> pa.Table:
    """Per anchor of a cell: the first ``k`` other rows of its label, among the rows of the cell."""
    out: list[tuple] = []
    for i in range(len(columns["block"])):
        block = Vectors(columns, i)
        names = {x: c for c, x in enumerate(dict.fromkeys(block.labels))}
        codes, place = np.array([names[x] for x in block.labels]), block.place
        scans: dict = {}
        for row, label, vector in zip(anchors["row"], anchors["label"], anchors["v"], strict=True):
            if label not in names:
                continue
            query, scan = _query(block, vector, scans)
            candidates = np.flatnonzero((codes == names[label]) & (block.rows != row))

            def needed(low, high):
                return high >= kth_largest(low, k) if len(low) > k else np.ones(len(low), dtype=bool)

            at, score = bond(scan, query, candidates, needed)
            top = best(score, place[at], k)
            at, score = at[top], score[top]
            out.append(([row] * len(at), [None] * len(at), block.rows[at].tolist(), _ids(block, at), score.tolist(), [None] * len(at)))
    return _found(out)


def _query(block: Vectors, vector: list[int], scans: dict) -> tuple[np.ndarray, Scan]:
    """The anchor and the block in the number kind that holds their products; what one has no value for counts zero."""
    width = min(len(vector), len(block.dims))
    kind = number_kind(width, max(map(abs, vector), default=0), block.largest)
    if (kind, width) not in scans:
        scans[kind, width] = block.scannable(width, kind)
    return np.array(vector[:width], dtype=kind), scans[kind, width]


def in_windows(columns: dict, anchors: dict, k: int, low: int, high: int) -> pa.Table:
    """Per anchor and positive of a cell: the first ``k`` rows of other labels inside the positive's window."""
    out: list[tuple] = []
    for i in range(len(columns["block"])):
        block = Vectors(columns, i)
        names = {x: c for c, x in enumerate(dict.fromkeys(block.labels))}
        codes, place = np.array([names[x] for x in block.labels]), block.place
        scans: dict = {}
        for row, label, vector, positives in zip(anchors["row"], anchors["label"], anchors["v"], anchors["positives"], strict=True):
            windows = sorted({(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives})
            windows = [w for w in windows if w[0] <= w[1]]
            if not windows:
                continue
            query, scan = _query(block, vector, scans)
            candidates = np.flatnonzero(codes != names.get(label, -1))

            def needed(least, most, windows=windows):
                kept = np.zeros(len(least), dtype=bool)
                for a, b in windows:
                    sure = least[(least >= a) & (most <= b)]
                    edge = max(a, kth_largest(sure, k)) if len(sure) >= k else a
                    kept |= (most >= edge) & (least <= b)
                return kept

            at, score = bond(scan, query, candidates, needed)
            tops = {}
            for a, b in windows:
                inside = np.flatnonzero((score >= a) & (score <= b))
                tops[a, b] = inside[best(score[inside], place[at[inside]], k)]
            for p in positives:
                top = tops.get((-(-low * p["score"] // 100), high * p["score"] // 100), np.zeros(0, dtype=np.int64))
                here, n = at[top], len(top)
                out.append(([row] * n, [p["row"]] * n, block.rows[here].tolist(), _ids(block, here), score[top].tolist(), [p["score"]] * n))
    return _found(out)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
) -> DataFrame:
    """For each anchor and positive the first rows of another label that score nearly as high.

    Components become ``floor(scale * x)``; a row's score is its integer inner
    product with the anchor, higher ones first, equal ones by id. The positives of
    an anchor (a row for which ``is_anchor`` holds) are its first ``positives``
    other rows of its label; a negative of a positive has a score from ``low`` to
    ``high`` percent of the positive's. All rows are searched.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; an anchor without positives, or a positive without
    negatives, gives no row. Rows with a null label, a null vector or a component
    that is null or not finite take no part. A null id is an id that comes after all
    others; rows that repeat an id are rows of their own, in an order of their
    own, and an anchor's copy is another row of its label. Where vectors differ in
    length, missing components count as zero; an empty vector scores zero. Only
    the three columns are read, so others cannot clash. An empty table gives no
    rows. Products beyond 56 bits are refused.

    Two scans over the staged vectors, one for positives and one for windows;
    between them only positives (a few per anchor) are kept.
    """
    (flag,) = unused(vectors, "_anchor")
    x = F.col(f"`{vector}`")
    rows = (
        vectors.withColumn(flag, F.coalesce(is_anchor, F.lit(False)))
        .where(F.col(f"`{label}`").isNotNull() & usable(x))
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{label}`").cast("string").alias("label"),
            F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v"),
            F.col(flag).alias("anchor"),
        )
    )
    rows = staged(rows)
    blocks = staged(in_blocks(rows, BLOCK_ROWS))
    anchors = rows.where("anchor")
    groups = max(1, -(-anchors.count() // ANCHOR_ROWS))
    anchors = staged(anchors.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), "row", "id", "label", "v"))

    def first(found: DataFrame, k: int, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = first(_scan_cells(blocks, anchors, lambda a, b: nearest_of_label(a, b, positives)), positives, "anchor")
    near = staged(near.select("anchor", "row", "id", "score"))
    lists = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    found = _scan_cells(blocks, staged(anchors.join(lists, "row")), lambda a, b: in_windows(a, b, negatives, low, high))
    ranked = first(found, negatives, "anchor", "positive")
    return (
        ranked.join(near.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id")), ["anchor", "positive"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
