"""SimHash near-duplicates through a byte-position inverted index."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_key, per_row, texts_of, unused
from headway.operators.components import connected_components
from headway.session import staged

_FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
BLOCK = 256
CHUNK = 1 << 15


def simhash(text: bytes, width: int = 3) -> int:
    """A bit is 1 if set in over half the hashes of the text's shingles."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = max(0, len(words) - width)
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: last + 1].tolist(), ends[len(words) - 1 - last :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], 42) for a, b in cuts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """Append ``fp``, the SimHash of the whole text as a signed long (0 without words)."""

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        made = [simhash(t, width) for t in texts_of(part.column(text))]
        return {"fp": pa.array(np.array(made, dtype=np.uint64).view(np.int64))}

    return per_row(docs, work, "fp long", text)


def byte_choices() -> list[tuple[int, ...]]:
    """The 14 sets of four byte positions in which any five positions hold a whole set.

    The positions are the points of the affine space of three bits, the sets its
    planes. The three positions outside five lie in a plane, and the plane beside
    it lies inside the five.
    """
    planes = []
    for normal in range(1, 8):
        for side in (0, 1):
            planes.append(tuple(p for p in range(8) if (normal & p).bit_count() % 2 == side))
    return planes


def _links(left: np.ndarray, right: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with enough equal positional bytes, then few enough differing bits."""
    a, b = left.view(np.uint8).reshape(-1, 1, 8), right.view(np.uint8).reshape(1, -1, 8)
    shared = (a == b).sum(axis=2)
    i, j = np.nonzero(shared >= 8 - most)
    close = np.bitwise_count(left[i] ^ right[j]) <= most
    return i[close], j[close]


def _tied(members: np.ndarray, sides: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of one block, cut down to one edge from each fingerprint to the least it is tied to."""
    two = len(np.unique(sides)) > 1
    left = np.flatnonzero(sides == sides.min())
    right = np.flatnonzero(sides == sides.max()) if two else left
    i, j = _links(members[left], members[right], most)
    a, b = left[i], right[j]
    label = np.arange(len(members))
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (before == label).all():
            break
    moved = np.flatnonzero(label != np.arange(len(members)))
    return [(int(members[x]), int(members[label[x]])) for x in moved]


def linked(distinct: DataFrame, most: int = 3) -> DataFrame:
    """Edges ``src, dst`` whose components are those of all links of distinct ``fp``.

    Fingerprints that differ in at most ``most`` (3) bits share at least 8 - most
    positional bytes, so they share all four bytes of one of the 14 sets: the
    inverted index has a list per set and value. Lists of one are dropped. Every
    list is cut into blocks of about ``BLOCK`` fingerprints by hash and each pair
    of blocks meets once, so that a long list is spread over tasks. Inside a
    block pair, shared positional bytes are tallied per pair, pairs that reach
    the least number are verified bit by bit, and a spanning forest of the links
    is kept, so the edges never outgrow the lists.
    """
    if most > 3:
        raise ValueError("the byte sets cover up to three differing bits")

    def key(choice: tuple[int, ...]):
        parts = [F.shiftright(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)) for p in choice]
        value = parts[0]
        for p in parts[1:]:
            value = value * 256 + p
        return value

    lists = distinct.select(
        "fp", F.explode(F.array(*[(key(c) + F.lit(n << 32)).alias("k") for n, c in enumerate(byte_choices())])).alias("k")
    )
    lists = staged(lists)
    long = lists.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    placed = lists.join(long, "k").withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = placed.select("k", "fp", "mine", other).select(
        "k", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), F.struct("fp", "mine").alias("member")
    )
    blocks = met.groupBy("k", "low", "high").agg(F.collect_list("member").alias("members")).where(F.size("members") > 1).select("members")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("members")
            edges = []
            offsets = column.offsets.to_numpy()
            fields = column.values
            fps = fields.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            sides = fields.field("mine").to_numpy(zero_copy_only=False)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                edges += _tied(fps[a:b], sides[a:b], most)
            made = np.array(sorted(set(edges)), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["src", "dst"])

    return blocks.mapInArrow(meet, "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, most: int = 3) -> DataFrame:
    """Id, ``did, th`` (the document's key), ``fp``, ``root`` and ``component_id`` per document.

    Documents of one fingerprint are collapsed before the search, so groups of
    copies cost one entry. ``component_id`` is the smallest id reachable over
    links, the document's own included; null where no member has an id; ``root``
    is the component's smallest fingerprint. Texts without words have fingerprint 0 and are linked like any other. Repeated rows
    stay; other columns of ``docs`` are not carried.
    """
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text).alias("_text"), *document_key(id_col, text))
    marked = staged(fingerprints(rows, "_text", width).drop("_text"))
    distinct = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    component = connected_components(linked(distinct.select("fp"), most))
    joined = distinct.join(component, distinct["fp"] == component["id"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(joined.join(smallest, "component").select("fp", F.col("component").alias("root"), "component_id"), "fp")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one per component of near-duplicates.

    The row with the smallest id stays (rows without an id come last; of rows
    that share an id the one with the smaller content hash); of identical rows
    one stays. Columns are those of ``docs``.
    """
    found = staged(near_duplicates(docs, id_col, text))
    first = found.groupBy("root").agg(F.min(F.struct("did", "th")).alias("o")).select("o.did", "o.th")
    own = unused(docs, "_did", "_th")
    keyed = docs.withColumns(dict(zip(own, document_key(id_col, text), strict=True)))
    return keyed.join(first.toDF(*own), own, "left_semi").dropDuplicates(own).select(*[F.col(f"`{c}`") for c in docs.columns])


