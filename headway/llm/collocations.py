"""Phrase collocations: pairs counted in tiles of frequency-ranked ids, longer phrases as pairs of phrases."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from headway.llm.common import small_batches, texts_of
from headway.session import WIDE, release, staged

# Bytes of text whose words share one dictionary and one stream of ids.
SLICE = 4 << 20

# Ids are frequency ranks. They are cut into strips, the first of ``STRIP`` ids, each
# further one as long as all before it, and pairs of ids into tiles of two strips:
# frequent words fall by octaves, so tiles get shares of like size. A tile that
# holds a pair for every ``SPARSE`` of its cells is counted by direct addresses.
STRIP = 512
SPARSE = 8

# Distinct pairs a task holds before it gives them away, and pairs that one task adds up.
HELD = 1 << 19
PART = 1 << 22

# Frequent symbols up to which the whole table goes out with the tasks (24 bytes each,
# words by their length); a longer one is joined.
TABLE = 1 << 20
TABLE_BYTES = 24 << 20

# A-Z are lower-cased, these end a piece, a tab parts words like a space.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(ENDS))

WORDS = "slice long, ids binary, langs array<string>, words array<binary>, counts array<long>"
LEVEL = "slice long, ids binary, part long, cells binary, counts binary"


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Codes of all words in order, -1 between pieces and texts, and the words the codes stand for."""
    raw = b"\n".join(texts).translate(FOLDED).replace(b"\n", b" \n ")
    parts = pc.split_pattern(pa.array([raw], pa.large_binary()), b" ").values
    parts = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
    codes, words = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64), parts.dictionary
    end = pc.index(words, pa.scalar(b"\n", words.type)).as_py()
    if end < 0:
        return codes, words
    codes = np.where(codes == end, -1, codes - (codes > end))
    return codes, pa.concat_arrays([words.slice(0, end), words.slice(end + 1)])


def streams(docs: DataFrame, lang: str, text: str, size: int) -> DataFrame:
    """Slices of the corpus: ``ids`` (words as places in ``words``, -1 where a piece ends), ``langs, words, counts``.

    A slice holds texts of one task up to ``size`` bytes; a longer text is a slice alone.
    Words of different languages have different places.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, n = TaskContext.get().partitionId() << 33, {}, 0

        def flush() -> pa.RecordBatch:
            ids, langs, words, counts, base = [], [], [], [], 0
            for name, texts in held.items():
                codes, own = words_of(texts)
                ids += [np.where(codes < 0, -1, codes + base), [-1]]
                langs += [name] * len(own)
                words.append(own)
                counts.append(np.bincount(codes[codes >= 0], minlength=len(own)))
                base += len(own)
            every = pa.concat_arrays([w.cast(pa.large_binary()) for w in words]).cast(pa.binary())
            columns = [
                pa.array([number], pa.int64()),
                pa.array([np.concatenate(ids).astype("<i4").tobytes()]),
                pa.array([langs], pa.list_(pa.string())),
                pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every),
                pa.array([np.concatenate(counts).astype(np.int64)], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "ids", "langs", "words", "counts"])

        for batch in batches:
            for name, t in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text")), strict=True):
                if held and n + len(t) > size:
                    yield flush()
                    number, held, n = number + 1, {}, 0
                held.setdefault(name, []).append(t)
                n += len(t)
        if held:
            yield flush()

    chosen = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    return chosen.mapInArrow(work, WORDS)


def strip_of(ids: np.ndarray) -> np.ndarray:
    return np.frexp((ids // STRIP).astype(np.float64))[1].astype(np.int64)


def strip_start(strip: int) -> int:
    return STRIP << strip - 1 if strip else 0


def strip_width(strip: int) -> int:
    return STRIP << max(strip - 1, 0)


def summed(cells: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of a tile of ``size`` cells, in order, with the sums of their counts.

    Where cells are many for the tile, by direct addresses; else by a sorted list of
    coordinates.
    """
    if len(cells) * SPARSE >= size:
        total = np.bincount(cells, weights=counts, minlength=size)
        used = np.flatnonzero(total)
        return used, np.rint(total[used]).astype(np.int64)
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    heads = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def count_tiles(left: np.ndarray, right: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Per tile (strip of the first id, strip of the second) its distinct cells and their counts."""
    i, j = strip_of(left), strip_of(right)
    tiles = (i * 64 + j).astype(np.int16)
    order = np.argsort(tiles, kind="stable")
    left, right, tiles = left[order], right[order], tiles[order]
    edges = np.append(np.flatnonzero(np.diff(tiles, prepend=-1)), len(tiles)).tolist()
    found = {}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        tile = divmod(int(tiles[a]), 64)
        width = strip_width(tile[1])
        cells = (left[a:b] - strip_start(tile[0])) * width + (right[a:b] - strip_start(tile[1]))
        found[tile] = summed(cells, np.ones(b - a, dtype=np.int64), strip_width(tile[0]) * width)
    return found


class Tiles:
    """Counts of a task, tile by tile, and how they are given away.

    ``masses[i]`` are the occurrences of the ids of strip ``i``: a tile's share of all pairs
    follows from them, and with it the number of parts its cells are dealt to.
    """

    def __init__(self, masses: list[int]):
        self.masses, self.held, self.n = masses, {}, 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        for tile, found in count_tiles(left, right).items():
            self.held.setdefault(tile, []).append(found)
            self.n += len(found[0])

    def parts(self, tile: tuple[int, int]) -> int:
        share = self.masses[tile[0]] * self.masses[tile[1]] // max(1, sum(self.masses))
        return max(1, -(-2 * share // PART))

    def flush(self) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        rows: list[tuple[int, bytes, bytes]] = []
        for tile, found in self.held.items():
            cells, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(found) > 1:
                cells, counts = summed(cells, counts, strip_width(tile[0]) * strip_width(tile[1]))
            n = self.parts(tile)
            place = (cells * 0x9E3779B1 & 0xFFFFFFFF) * n >> 32
            for part in range(n):
                own = place == part if n > 1 else slice(None)
                if len(cells[own]):
                    steps = np.diff(cells[own], prepend=0)
                    rows.append(((tile[0] * 64 + tile[1] << 32) + part, squeeze(steps.astype("<i8").tobytes()), squeeze(counts[own].astype("<i8").tobytes())))
        self.held, self.n = {}, 0
        if rows:
            nothing = [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([*nothing, *columns], names=["slice", "ids", "part", "cells", "counts"])


def frequent_cells(least: int):
    """Sums up a part of a tile; pairs found ``least`` times go on."""

    def work(table: pa.Table) -> pa.Table:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        tile = divmod(table.column("part")[0].as_py() >> 32, 64)
        cells = np.concatenate([np.cumsum(np.frombuffer(expand(c.as_py()), "<i8")) for c in table.column("cells")])
        counts = np.concatenate([np.frombuffer(expand(c.as_py()), "<i8") for c in table.column("counts")])
        width = strip_width(tile[1])
        cells, counts = summed(cells, counts, strip_width(tile[0]) * width)
        cells, counts = cells[counts >= least], counts[counts >= least]
        left, right = cells // width + strip_start(tile[0]), cells % width + strip_start(tile[1])
        return pa.table({"left": left, "right": right, "f": counts})

    return work


def squeezed(ids: np.ndarray) -> np.ndarray:
    """The stream without repeated gaps."""
    return ids[(ids >= 0) | np.append(True, ids[:-1] >= 0)] if len(ids) else ids


def named_words(codes: np.ndarray, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The stream with the ids of frequent words; ``places`` are those of the words in the slice's list."""
    table = np.full(max(int(codes.max(initial=-1)), int(places.max(initial=-1))) + 2, -1, dtype=np.int64)
    table[places] = symbols
    return squeezed(table[codes])  # the last entry stays -1, and so does a gap


def named_pairs(old: np.ndarray, keys: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The stream with the ids of frequent pairs; ``keys`` are sorted (``pair_keys``)."""
    pairs = np.where((old[:-1] >= 0) & (old[1:] >= 0), old[:-1] << 32 | old[1:], -1)
    if not len(keys):
        return np.full(min(len(pairs), 1), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    return squeezed(np.where(keys[at] == pairs, symbols[at], -1))


def pair_keys(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = known.column("left").to_numpy() << 32 | known.column("right").to_numpy()
    order = np.argsort(keys)
    return keys[order], known.column("symbol").to_numpy()[order]


def _streams(batches: Iterator[pa.RecordBatch], masses: list[int], named) -> Iterator[pa.RecordBatch]:
    """Streams of the next level and the tiles of their pairs; ``named(batch, i)`` gives the ids of a slice."""
    tiles = Tiles(masses)
    for batch in batches:
        for i in range(batch.num_rows):
            ids = named(batch, i)
            both = (ids[:-1] >= 0) & (ids[1:] >= 0)
            tiles.add(ids[:-1][both], ids[1:][both])
            columns = [batch.column("slice").slice(i, 1), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 2]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "ids", "part", "cells", "counts"])
            if tiles.n > HELD:
                yield from tiles.flush()
    yield from tiles.flush()


def _ids(batch: pa.RecordBatch, i: int, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column("ids")[i].as_py(), kind)


def next_level(stream: DataFrame, symbols: DataFrame, words: bool) -> DataFrame:
    """``LEVEL`` rows: the streams with the ids of ``symbols``, and the counted pairs of neighbours.

    A table of symbols up to a fixed size goes out with the tasks. A larger one is
    joined with what each slice holds, and slices fetch what they share with it.
    """
    spark = stream.sparkSession
    masses = [0] * 64
    strips = F.floor(F.log2(F.greatest(F.floor(F.col("symbol") / STRIP), F.lit(0.5)))) + 1
    for row in symbols.groupBy(strips.cast("int").alias("strip")).agg(F.sum("f").alias("n")).collect():
        masses[row["strip"]] = row["n"]
    size = symbols.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word") if words else F.lit(0)).alias("bytes")).first()
    if size["n"] <= TABLE and (size["bytes"] or 0) <= TABLE_BYTES:
        shared = spark.sparkContext.broadcast(symbols.select(*(["lang", "word"] if words else ["left", "right"]), "symbol").toArrow())

        def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if words:
                table = shared.value
                langs = table.column("lang").to_pylist()
                found = {(g, w): n for g, w, n in zip(langs, table.column("word").cast(pa.binary()).to_pylist(), table.column("symbol").to_pylist(), strict=True)}

                def named(batch: pa.RecordBatch, i: int) -> np.ndarray:
                    own = zip(batch.column("langs")[i].as_py(), batch.column("words")[i].as_py(), strict=True)
                    symbols = np.fromiter((found.get(x, -1) for x in own), dtype=np.int64)
                    return named_words(_ids(batch, i, "<i4"), np.arange(len(symbols)), symbols)
            else:
                keys, numbers = pair_keys(shared.value)

                def named(batch: pa.RecordBatch, i: int) -> np.ndarray:
                    return named_pairs(_ids(batch, i, "<i8"), keys, numbers)

            return _streams(batches, masses, named)

        columns = ["slice", "ids", *["langs", "words"] * words]
        return stream.select(*columns).mapInArrow(tabled, LEVEL)

    if words:
        held = stream.select("slice", F.posexplode(F.arrays_zip("langs", "words")).alias("left", "x"))
        held = held.select(F.col("slice").alias("of"), F.col("left").cast("long").alias("left"), F.col("x.langs").alias("lang"), F.col("x.words").cast("string").alias("word"))
        known = held.join(symbols.select("lang", "word", "symbol"), ["lang", "word"]).select("of", "left", F.lit(0).cast("long").alias("right"), "symbol")
    else:
        held = stream.select("slice", "ids").mapInArrow(_pairs_of, "of long, left long, right long")
        known = held.join(symbols.select("left", "right", "symbol"), ["left", "right"]).select("of", "left", "right", "symbol")

    schema = to_arrow_schema(StructType.fromDDL(LEVEL))

    def joined(a: pa.Table, b: pa.Table) -> pa.Table:
        def named(batch: pa.RecordBatch, i: int) -> np.ndarray:
            if words:
                return named_words(_ids(batch, i, "<i4"), b.column("left").to_numpy(), b.column("symbol").to_numpy())
            return named_pairs(_ids(batch, i, "<i8"), *pair_keys(b))

        parts = list(_streams(iter(a.combine_chunks().to_batches()), masses, named)) if a.num_rows else []
        return pa.Table.from_batches(parts, schema=schema)

    return stream.select("slice", "ids").groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(joined, LEVEL)


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct neighbours of each slice."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = _ids(batch, i, "<i8")
            both = (ids[:-1] >= 0) & (ids[1:] >= 0)
            keys = np.unique(ids[:-1][both] << 32 | ids[1:][both])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), batch.column("slice")[i].as_py())), pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF)], names=["of", "left", "right"])


def ranked(found: DataFrame, *order: Column) -> DataFrame:
    """``symbol``: place in the order, from 0, numbered by sorted partitions and inside each."""
    rows = staged(found.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.col("_at") - F.shiftleft("_part", 33)
    return rows.join(before, "_part").withColumn("symbol", F.col("_before") + inside).drop("_at", "_part", "_before")


def numbered(counted: DataFrame, *keys: str) -> DataFrame:
    """Frequent keys as ``symbol, f``, in order of frequency."""
    symbols = ranked(counted, F.col("f").desc(), *[F.col(k) for k in keys])
    small = F.col("symbol") < (1 << 31)
    return staged(symbols.withColumn("symbol", F.when(small, F.col("symbol")).otherwise(F.raise_error(F.lit("over 2^31 frequent symbols")).cast("long"))))


def phrase_levels(docs: DataFrame, lang: str, text: str, least: int, longest: int, size: int = SLICE) -> tuple[DataFrame, list[DataFrame]]:
    """Occurrences of all words per ``lang``, and for each length the phrases found ``least`` times.

    Level 1 has ``symbol, f, lang, word``, a further one ``symbol, f, left, right``: a
    phrase is the pair of the phrases without its last and without its first word.
    """
    stream = staged(streams(docs, lang, text, size), WIDE)
    words = stream.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("x"))
    words = words.select(F.col("x.langs").alias("lang"), F.col("x.words").cast("string").alias("word"), F.col("x.counts").alias("n"))
    every = words.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    every = staged(every.groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f")))
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [numbered(every.where("word is not null"), "lang", "word")]
    for level in range(2, longest + 1):
        following = next_level(stream, levels[-1], level == 2)
        with small_batches(docs.sparkSession):
            rows = staged(following, WIDE)
        release(stream)
        pairs = rows.where("part is not null").groupBy("part").applyInArrow(frequent_cells(least), "left long, right long, f long")
        levels.append(numbered(pairs, "left", "right"))
        stream = rows.where("slice is not null").select("slice", "ids")
    release(stream)
    return totals, levels


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5, top: int = 2000, size: int = SLICE
) -> DataFrame:
    """Per language the ``top`` phrases whose words keep together most.

    Texts (null: empty) are lower-cased in A-Z and cut into pieces at sentence
    marks and line ends, pieces into words at spaces and tabs. Phrases are
    contiguous words of a piece; all occurrences count, overlapping ones too. A
    phrase of 2 to ``longest`` words found ``a >= least`` times is a candidate. Cut
    behind its first words it scores ``floor(1000 * a * n / (l * r))``, with ``n`` the words of the
    language, ``l`` and ``r`` the occurrences of both parts; the lowest cut counts, of
    equal ones the first. A candidate goes if a longer one holds it wherever it
    occurs; as no phrase is rarer than a longer one around it, one word more on
    either side tells.

    Returns ``lang, rank, phrase, a, l, r, n, score``, best first, then by ``a`` and phrase.
    ``top`` is the length of the report; counting knows no limit. A null language
    is ``und``; repeated rows count each; only the two columns are read, so others
    cannot clash; an empty table gives no rows. A very long text is a slice of its
    own. Products are exact to 38 digits.
    """
    totals, levels = phrase_levels(docs, lang, text, least, longest, size)
    table = levels[0].select("symbol", "f", "lang", F.array("word").alias("words"), *[F.array().cast("array<long>").alias(c) for c in ("heads", "tails")])
    candidates = []
    for pairs in levels[1:]:
        left = table.select(F.col("symbol").alias("left"), "lang", "words", "heads", F.col("f").alias("head"))
        right = table.select(F.col("symbol").alias("right"), F.element_at("words", -1).alias("word"), "tails", F.col("f").alias("tail"))
        table = staged(
            pairs.join(left, "left").join(right, "right").select(
                "symbol", "f", "lang",
                F.concat("words", F.array("word")).alias("words"),
                F.concat("heads", F.array("head")).alias("heads"),
                F.concat("tails", F.array("tail")).alias("tails"),
                "left", "right",
            )
        )
        candidates.append(table)
    kept = []
    for shorter, longer in zip(candidates, [*candidates[1:], None], strict=True):
        if longer is not None:
            around = longer.select(F.col("left").alias("symbol"), "f").union(longer.select("right", "f")).groupBy("symbol").agg(F.max("f").alias("around"))
            shorter = shorter.join(around, "symbol", "left").where(F.coalesce(F.col("around") < F.col("f"), F.lit(True)))
        kept.append(shorter.select("lang", "words", "f", "heads", "tails"))
    cut = """array_min(transform(sequence(1, size(heads)), k -> struct(
        cast(1000 * cast(f as decimal(38, 0)) * n as decimal(38, 0)) div (cast(heads[k - 1] as decimal(38, 0)) * tails[size(tails) - k]) as score,
        k, heads[k - 1] as l, tails[size(tails) - k] as r)))"""
    scored = reduce(DataFrame.union, kept).join(totals, "lang").withColumn("cut", F.expr(cut))
    rows = scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
