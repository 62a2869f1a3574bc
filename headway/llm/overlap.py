"""Near copies by exact overlap of word shingles, found through prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_key, shards, texts_of, unused
from headway.llm.simhash import _FOLD
from headway.session import release, staged

# Buckets of the counts that order shingles from rare to frequent.
BUCKETS = 1 << 18


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words (of the whole text if it has fewer)."""
    words = text.translate(_FOLD).split()
    made = {xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))} if words else set()
    return np.sort(np.fromiter(made, dtype=np.uint64, count=len(made)))


def bucket_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many shingles of all texts fall into each bucket of hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for part in shards(batches, "text", 8 << 20):
            for text in texts_of(part.column("text")):
                np.add.at(total, (shingles(text, width) % BUCKETS).astype(np.int64), 1)
        held = np.flatnonzero(total)
        for i in range(0, len(held), 1 << 16):
            cut = held[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(cut), pa.array(total[cut])], names=["bucket", "n"])

    table = docs.select("text").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``h, did, th, n, pos``: the shingles of which two near copies share one at least.

    Two sets of overlap ``percent`` share that part of the larger one, so that, in
    any order that is the same for all texts, the first n - ceil(percent n) + 1
    shingles of one meet those of the other. Rare shingles come first.
    """
    counts = bucket_counts(docs, width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, "text", 2 << 20):
            found = []
            for text in texts_of(part.column("text")):
                own = shingles(text, width)
                most = len(own) + (-percent * len(own) // 100) + 1 if len(own) else 0
                order = np.argsort(counts[(own % BUCKETS).astype(np.int64)], kind="stable")[:most]
                found.append((own[order], len(own)))
            sizes = [len(h) for h, _ in found]
            columns = [
                np.concatenate([h for h, _ in found]).view(np.int64) if found else np.zeros(0, np.int64),
                np.repeat(part.column("did").to_numpy(), sizes),
                np.repeat(part.column("th").to_numpy(), sizes),
                np.repeat(np.array([n for _, n in found], dtype=np.int32), sizes),
                np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]) if sizes else np.zeros(0, np.int32),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "did", "th", "n", "pos"])

    return docs.mapInArrow(work, "h long, did long, th long, n int, pos int")


def may_meet(percent: int) -> Column:
    """Whether ``a`` and ``b``, whose first common shingle this is, can still overlap enough."""
    left = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return (100 + percent) * left >= percent * (F.col("a.n") + F.col("b.n"))


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``did, th`` of the later text of every pair (``a``, ``b``) whose shingles overlap by ``percent``; staged."""
    keys = pairs.where(may_meet(percent)).select(
        F.col("a.did").alias("did_a"), F.col("a.th").alias("th_a"), F.col("b.did").alias("did"), F.col("b.th").alias("th")
    )
    keys = staged(keys.distinct())
    needed = keys.select("did", "th").union(keys.select("did_a", "th_a")).distinct()
    texts = staged(docs.join(needed, ["did", "th"], "left_semi").dropDuplicates(["did", "th"]))
    earlier = texts.toDF(*[{"text": "earlier"}.get(c, f"{c}_a") for c in texts.columns])
    both = keys.join(earlier, ["did_a", "th_a"]).select("did", "th", "earlier").join(texts, ["did", "th"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, "text", 4 << 20):
            close = []
            for x, y in zip(texts_of(part.column("earlier")), texts_of(part.column("text")), strict=True):
                a, b = shingles(x, width), shingles(y, width)
                common = len(np.intersect1d(a, b, assume_unique=True))
                close.append(100 * common >= percent * (len(a) + len(b) - common))
            yield part.select(["did", "th"]).filter(pa.array(close, pa.bool_()))

    found = staged(both.mapInArrow(work, "did long, th long").distinct())
    release(keys)
    release(texts)
    return found


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` whose text is no near copy of an earlier one.

    Texts are near copies if the Jaccard overlap of their shingles of ``width``
    words (split at ASCII white space, ASCII case folded) is ``percent`` or more.
    Earlier is the order of id, then content hash; a null id comes last. Texts
    without words and rows that repeat id and text stay. No pair is lost: lists
    of texts per prefix shingle hold every pair (``prefixes``). Each text first
    meets the first one of its lists, then only those that found no copy meet
    all that are earlier, so a group of many copies is not compared pair by pair.
    """
    keyed = docs.select(*document_key(id_col, text), F.col(text).alias("text"))
    entries = staged(prefixes(keyed, width, percent))
    member = F.struct("did", "th", "n", "pos")
    heads = entries.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min(member).alias("a")).where("k > 1")
    lists = staged(entries.join(heads, "h").select("h", "k", "a", member.alias("b")))
    release(entries)
    earlier = F.struct("a.did", "a.th") < F.struct("b.did", "b.th")
    first = verified(lists.where(earlier).select("a", "b"), keyed, width, percent)
    # In a list of two the first one is all there is to meet.
    longer = lists.where("k > 2")
    found = first.select(F.col("did").alias("found_did"), F.col("th").alias("found_th"))
    alone = longer.join(found, (F.col("b.did") == F.col("found_did")) & (F.col("b.th") == F.col("found_th")), "left_anti").select("h", "b")
    pairs = longer.select("h", F.col("b").alias("a")).join(alone, "h").where(earlier)
    second = verified(pairs, keyed, width, percent)
    release(lists)
    own = unused(docs, "_did", "_th")
    gone = first.union(second).toDF(*own)
    marked = docs.withColumns(dict(zip(own, document_key(id_col, text), strict=True)))
    return marked.join(gone, own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
