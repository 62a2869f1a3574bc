"""Token ids in files of directly addressable codes."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import shards, texts_of
from headway.llm.tokens import encoder
from headway.session import shared_folder

# The marks of a file.
MAGIC = b"DACTOK01"
CLOSING = "\nDACEND\n"

# Bits of a continuation bitmap that share one directory entry.
BLOCK = 256
WORD_BITS = 64

# Widest chunk: eight of them fit into one machine word. Levels beyond those that
# the longest id needs.
WIDEST = 8
MORE_LEVELS = 1

# Ids worked on at a time: memory stays bounded in files of one very long document.
STEP = 1 << 20


def chunk_widths(counts: np.ndarray) -> list[int]:
    """Chunk widths that take the fewest bits for values of which ``counts[b]`` have ``b`` bits.

    A value of ``b`` bits goes on to further levels until their widths sum up to
    ``b``. Every level but the last pays one continuation bit per value and its
    share of the rank directory.
    """
    longest = max(1, int(np.flatnonzero(counts).max(initial=0)))
    beyond = np.append(np.cumsum(counts[::-1])[::-1], 0)  # beyond[b]: values of b bits or more
    flag = 1 + 32 / BLOCK
    levels = -(-longest // WIDEST) + MORE_LEVELS
    cheapest: dict[tuple[int, int], tuple[float, list[int]]] = {(longest, left): (0.0, []) for left in range(levels + 1)}
    for done in range(longest - 1, -1, -1):
        here = float(beyond[done + 1] if done else beyond[0])
        for left in range(1, levels + 1):
            options = []
            for width in range(1, min(WIDEST, longest - done) + 1):
                if (done + width, left - 1) in cheapest:
                    cost, widths = cheapest[done + width, left - 1]
                    options.append((cost + here * (width + (flag if widths else 0)), [width, *widths]))
            if options:
                cheapest[done, left] = min(options)
    return cheapest[0, levels][1]


def packed(values: np.ndarray, width: int) -> bytes:
    """``width`` low bits of each value, one after the other, up to a multiple of eight values."""
    shifts, low, parts = np.arange(8, dtype=np.uint64) * np.uint64(width), np.uint64((1 << width) - 1), []
    for a in range(0, len(values), STEP):
        part = values[a : a + STEP].astype(np.uint64) & low
        part = np.append(part, np.zeros(-len(part) % 8, dtype=np.uint64)).reshape(-1, 8)
        words = np.bitwise_or.reduce(part << shifts, axis=1).astype("<u8")
        parts.append(words.view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
    return b"".join(parts)


def unpacked(raw: np.ndarray, width: int) -> np.ndarray:
    """All values of whole groups of eight."""
    words = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    words[:, :width] = raw.reshape(-1, width)
    shifts = np.arange(8, dtype=np.uint64) * np.uint64(width)
    return ((words.view("<u8") >> shifts) & np.uint64((1 << width) - 1)).astype(np.uint32).ravel()


def aligned(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    """How many values have 0, 1, ... 32 bits."""
    counts = np.zeros(33, dtype=np.int64)
    for a in range(0, len(ids), STEP):
        counts += np.bincount(np.frexp(ids[a : a + STEP].astype(np.float64))[1], minlength=33)
    return counts


def encode_shard(ids: np.ndarray, ends: np.ndarray, doc_ids: np.ndarray, unnamed: np.ndarray) -> bytes:
    """One file: header, document directory, levels.

    ``ids`` are the tokens of all documents, ``ends`` where each document ends.
    Level 0 holds the lowest bits of every id. A set bit in a level's
    continuation bitmap says that more bits stand in the next level, at the place
    that the number of set bits before it gives; the directory holds that number
    for every ``BLOCK`` bits. All parts start at multiples of eight bytes.
    """
    rest = ids.astype(np.uint32)
    widths = chunk_widths(bit_lengths(rest))
    parts, counts = [], []
    for level, width in enumerate(widths):
        counts.append(len(rest))
        parts.append(aligned(packed(rest, width) + b"\0"))
        if level == len(widths) - 1:
            break
        rest = rest >> np.uint32(width)
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        blocks = -(-len(more) // BLOCK)
        bitmap = np.concatenate([bitmap, np.zeros(blocks * BLOCK // 8 - len(bitmap), dtype=np.uint8)])
        ones = np.bitwise_count(bitmap.reshape(blocks, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        directory = np.cumsum(ones, dtype=np.uint32) - ones
        parts += [aligned(bitmap.tobytes()), aligned(directory.tobytes())]
        rest = rest[more]
    header = MAGIC + np.array([len(ids), len(ends), len(widths), *widths, *counts], dtype="<i8").tobytes()
    directory = [ends.astype("<i8").tobytes(), doc_ids.astype("<i8").tobytes(), aligned(unnamed.astype(np.uint8).tobytes())]
    return b"".join([header, *directory, *parts])


class Shard:
    """Random access to the ids of one file: only the asked codes are put together."""

    def __init__(self, raw: bytes):
        if not raw.startswith(MAGIC) or not raw.endswith(CLOSING.encode()):
            raise ValueError("not a whole token file")
        self._raw, self._at = raw, len(MAGIC)
        self.n_tokens, self.n_docs, levels = (int(x) for x in self._take("<i8", 3))
        self.widths = self._take("<i8", levels).tolist()
        self.counts = self._take("<i8", levels).tolist()
        self.ends = self._take("<i8", self.n_docs)
        self.doc_ids = self._take("<i8", self.n_docs)
        self.unnamed = self._take(np.uint8, self.n_docs).astype(bool)
        self.chunks, self.bitmaps, self.directories = [], [], []
        for level, (width, count) in enumerate(zip(self.widths, self.counts, strict=True)):
            self.chunks.append(self._take(np.uint8, -(-count // 8) * width + 1))
            if level < levels - 1:
                blocks = -(-count // BLOCK)
                self.bitmaps.append(self._take("<u8", blocks * BLOCK // WORD_BITS))
                self.directories.append(self._take("<u4", blocks))

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self._raw, kind, n, self._at)
        self._at += out.nbytes + -out.nbytes % 8
        return out

    def _chunk(self, level: int, at: np.ndarray) -> np.ndarray:
        width, raw = self.widths[level], self.chunks[level]
        bit = at * width
        byte = bit >> 3
        window = raw[byte].astype(np.uint32) | raw[byte + 1].astype(np.uint32) << np.uint32(8)
        return (window >> (bit & 7).astype(np.uint32)) & np.uint32((1 << width) - 1)

    def _run(self, level: int, a: int, b: int) -> np.ndarray:
        width, first = self.widths[level], a // 8
        return unpacked(self.chunks[level][first * width : -(-b // 8) * width], width)[a - 8 * first : b - 8 * first]

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's entry and the words of its block."""
        words, word = self.bitmaps[level], at // WORD_BITS
        below = (np.uint64(1) << (at % WORD_BITS).astype(np.uint64)) - np.uint64(1)
        ranks = self.directories[level][at // BLOCK].astype(np.int64) + np.bitwise_count(words[word] & below)
        first = at // BLOCK * (BLOCK // WORD_BITS)
        for i in range(BLOCK // WORD_BITS - 1):
            ranks += np.where(first + i < word, np.bitwise_count(words[np.minimum(first + i, len(words) - 1)]), 0)
        return ranks

    def ids(self, places) -> np.ndarray:
        """Ids at any places of the file, in any order."""
        at = np.asarray(places, dtype=np.int64)
        if at.size and (at.min() < 0 or at.max() >= self.n_tokens):
            raise IndexError("no such token")
        out = np.zeros(len(at), dtype=np.uint32)
        rows, shift = np.arange(len(at)), 0
        for level, width in enumerate(self.widths):
            out[rows] |= self._chunk(level, at) << np.uint32(shift)
            if level == len(self.widths) - 1 or not len(at):
                break
            more = (self.bitmaps[level][at // WORD_BITS] >> (at % WORD_BITS).astype(np.uint64)) & np.uint64(1) > 0
            rows, at = rows[more], self._rank(level, at[more])
            shift += width
        return out

    def between(self, start: int, stop: int) -> np.ndarray:
        """A run of ids: what belongs to it is a run in every level, so only its ends are ranked."""
        parts = [np.zeros(0, dtype=np.uint32)]
        for first in range(start, stop, STEP):
            a, b, shift, rows = first, min(first + STEP, stop), 0, None
            for level, width in enumerate(self.widths):
                chunk = self._run(level, a, b)
                if rows is None:
                    rows, out = np.arange(b - a), chunk
                else:
                    out[rows] |= chunk << np.uint32(shift)
                if level == len(self.widths) - 1:
                    break
                byte = a // 8
                more = np.unpackbits(self.bitmaps[level].view(np.uint8)[byte : -(-b // 8)], bitorder="little")[a - 8 * byte : b - 8 * byte].astype(bool)
                rows, shift = rows[more], shift + width
                if not len(rows):
                    break
                a = int(self._rank(level, np.array([a]))[0])
                b = a + len(rows)
            parts.append(out)
        return np.concatenate(parts)

    def document(self, i: int) -> np.ndarray:
        return self.between(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text: str = "text", end: int = 2, shard_tokens: int = 1 << 20
) -> None:
    """Encode every document, append ``end``, and write files of about ``shard_tokens`` ids.

    Documents are dealt out in ascending order of id (rows without an id last;
    rows of one id in the order of a hash of the text, equal rows by their place in the
    input), by ranges that split one id's rows too where it has very many. Each
    task encodes its range and cuts it into files at document ends; a longer
    document is a file of its own. A null text is an empty one, and an empty one
    is the end id alone. An empty table writes no file. A file is one record:
    ``part`` (range), ``shard`` (place in it) and ``n_tokens`` are named in its
    folder, so a listing tells where each begins. Only id and text are read.
    """
    identifier, body = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text}`")
    rows = docs.select(identifier.isNull().alias("unnamed"), identifier.alias("id"), F.xxhash64(body).alias("hash"), F.monotonically_increasing_id().alias("row"), body.alias("text"))
    order = ["unnamed", "id", "hash", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("unnamed", "id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, held, size = TaskContext.get().partitionId(), 0, [], 0
        encode = encoder(tokenizer).ids

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([x for x, _, _ in held])
            ends = np.cumsum([len(x) for x, _, _ in held])
            raw = encode_shard(ids, ends, np.array([i or 0 for _, i, _ in held], dtype=np.int64), np.array([u for _, _, u in held]))
            columns = [pa.array([raw], pa.binary()), pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "part", "shard", "n_tokens"])

        for batch in batches:
            for piece in shards(iter([batch]), "text", 8 << 20):
                for t, i, u in zip(texts_of(piece.column("text")), piece.column("id").to_pylist(), piece.column("unnamed").to_pylist(), strict=True):
                    ids = np.array([*encode(t.decode("utf-8", "replace")), end], dtype=np.uint32)
                    if held and size + len(ids) > shard_tokens:
                        yield flush()
                        shard, held, size = shard + 1, [], 0
                    held.append((ids, i, u))
                    size += len(ids)
        if held:
            yield flush()

    files = ranged.mapInArrow(work, "file binary, part int, shard int, n_tokens long")
    files.select(F.col("file").cast("string").alias("value"), "part", "shard", "n_tokens").write.partitionBy("part", "shard", "n_tokens").option(
        "lineSep", CLOSING
    ).text(folder)


def token_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """The files of a folder with ``path, content, part, shard, n_tokens``; None if it has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files if "shard" in files.columns else None


def file_starts(files: DataFrame) -> DataFrame:
    """``part, shard, before``: ids in all earlier files, from the names alone.

    Summed up per range and inside each range: no task sees more rows than there
    are ranges, or files in one range.
    """
    named = files.select("part", "shard", F.col("n_tokens").cast("long").alias("n"))
    totals = named.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("earlier"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")
    return named.withColumn("inside", inside).join(earlier, "part").select("part", "shard", (F.col("earlier") + F.col("inside")).alias("before"))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder: ``id, start, n_tokens, ids_crc32``, with ``with_ids`` their ``ids`` too.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is of the ids
    as little-endian unsigned 32-bit integers. ``id`` is null where it was.
    """
    schema = "part int, shard int, id long, inner_start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    files = token_files(spark, folder)
    if files is None:
        return spark.createDataFrame([], schema.replace("part int, shard int, ", "").replace("inner_start", "start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, raw in zip(batch.column("part").to_pylist(), batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                held = Shard(raw.as_buffer().to_pybytes())
                ids = held.between(0, held.n_tokens).astype("<u4")
                starts = np.concatenate([[0], held.ends[:-1]]).astype(np.int64)
                pieces = [ids[a:b] for a, b in zip(starts, held.ends, strict=True)]
                columns = [
                    pa.array(np.full(held.n_docs, part), pa.int32()),
                    pa.array(np.full(held.n_docs, shard), pa.int32()),
                    pa.array(held.doc_ids, mask=held.unnamed),
                    pa.array(starts),
                    pa.array(held.ends - starts),
                    pa.array([zlib.crc32(x.tobytes()) for x in pieces], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in pieces], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    found = files.select("part", "shard", "content").mapInArrow(work, schema)
    columns = ["id", (F.col("before") + F.col("inner_start")).alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return found.join(file_starts(files), ["part", "shard"]).select(*columns)


def token_output(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text: str = "text", end: int = 2, shard_tokens: int = 1 << 20) -> DataFrame:
    """Write token files and read them back: ``id_col, start, n_tokens, ids_crc32`` per row of ``docs``.

    The files are left in ``folder``; where none is named, in a new one below the
    shared folder. Null, empty, repeated and very long rows: see ``write_tokens``.
    Columns of ``docs`` besides id and text are left out, so none can clash.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, folder, id_col, text, end, shard_tokens)
    return read_documents(spark, folder).withColumnRenamed("id", id_col)
