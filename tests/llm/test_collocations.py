"""Collocations against plain counting: tiles, levels, cuts, awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import headway.llm.collocations as module
from headway.llm.collocations import collocations, squeezed, words_of
from headway.session import staged
from tests.llm.cases import SCHEMA, documents, prose

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def plain(rows, least, longest=5, top=2000):
    """``rows``: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in pieces_of(text):
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(len(q) > len(p) and b >= a and lang == other and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in found.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    rank = Counter()
    ranked = []
    for x in out:
        rank[x[0]] += 1
        if rank[x[0]] <= top:
            ranked.append((x[0], rank[x[0]], *x[1:]))
    return ranked


def found(frame, **options):
    got = collocations(frame, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize(("seed", "size"), [(1, 16 << 20), (2, 200), (3, 1)])
def test_equals_plain_counting(spark, seed, size):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for w in t.split())) for t in prose(150, seed, 40, 6)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = plain(rows, 5)
    assert any(len(r[2].split()) > 3 for r in want)
    assert found(frame, least=5, size=size) == want
    assert found(frame, least=5, top=3) == plain(rows, 5, top=3)
    assert found(frame, least=3, longest=3) == plain(rows, 3, 3)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 3000)) | st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=200), st.integers(0, 3))
def test_tiles(pairs, fold):
    """Cells of tiles stand for the pairs they came from, through parts and back."""
    left, right = (np.array([p[i] for p in pairs], dtype=np.int64) for i in (0, 1))
    tiles = module.Tiles([10**6, 10**7, 10**8, 10**6, *[0] * 60])
    cut = len(pairs) >> fold
    for a, b in ((0, cut), (cut, len(pairs))):
        tiles.add(left[a:b], right[a:b])
    got, seen = Counter(), []
    for batch in tiles.flush():
        for i in range(batch.num_rows):
            made = module.frequent_cells(1)(pa.Table.from_batches([batch.slice(i, 1)]))
            seen += list(zip(made["left"].to_pylist(), made["right"].to_pylist(), strict=True))
            got.update(dict(zip(seen[-made.num_rows :] if made.num_rows else [], made["f"].to_pylist(), strict=True)))
    assert len(seen) == len(set(seen))
    assert got == Counter(pairs)


def test_strips():
    ids = np.array([0, 511, 512, 1023, 1024, 2047, 2048, (1 << 31) - 1])
    strips = module.strip_of(ids).tolist()
    assert strips == [0, 0, 1, 1, 2, 2, 3, 22]
    assert all(module.strip_start(s) <= i < module.strip_start(s) + module.strip_width(s) for i, s in zip(ids.tolist(), strips))


@pytest.mark.parametrize("tile", [0, 1])
def test_long_tables_are_joined(spark, monkeypatch, tile):
    """Beyond the size that goes out with the tasks, and with tasks that give away often."""
    monkeypatch.setattr(module, "TABLE", 3 if tile else module.TABLE)
    monkeypatch.setattr(module, "HELD", 5)
    rows = [("en" if i % 3 else "de", t) for i, t in enumerate(prose(150, 5, 40, 6))]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(frame, least=4, size=300) == plain(rows, 4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aAbÀ .,;:!?\n\r\x0b\x0c\t \x85", max_size=20), max_size=5))
def test_words(texts):
    codes, words = words_of([t.encode() for t in texts])
    names = [w.decode() for w in words.to_pylist()]
    got = [[]]
    for c in codes.tolist():
        if c < 0:
            got.append([])
        else:
            got[-1].append(names[c])
    assert [p for p in got if p] == [p for t in texts for p in pieces_of(t) if p]
    assert squeezed(codes).tolist() == [c for i, c in enumerate(codes.tolist()) if c >= 0 or i == 0 or codes[i - 1] >= 0]


def test_awkward_rows(spark):
    frame = spark.createDataFrame(documents(), SCHEMA).withColumns({"lang": F.lit(None).cast("string"), "rank": F.lit("own"), "n": F.lit("own"), "slice": F.lit("own")})
    want = plain([(None, r[1]) for r in documents()], 3)
    assert want and found(frame, least=3) == want
    assert found(frame.limit(0), least=3) == []
    assert found(frame.withColumn("text", F.lit(None).cast("string")), least=3) == []


def test_counts_beyond_64_bits_stay_exact(spark):
    """1000 * a * n passes 2^63 long before the result does."""
    from pyspark.sql.types import LongType

    a, n, l, r = 3_000_000_007, 9_000_000_000_011, 4_000_000_019, 5_000_000_029
    row = spark.range(1).select(*[F.lit(v).cast(LongType()).alias(c) for c, v in {"f": a, "n": n, "l": l, "r": r}.items()])
    got = row.select(F.expr("cast(1000 * cast(f as decimal(38, 0)) * n as decimal(38, 0)) div (cast(l as decimal(38, 0)) * r)")).first()[0]
    assert got == 1000 * a * n // (l * r)


def test_wide_rows_are_written_in_small_groups(spark, monkeypatch):
    """Slices are rows of megabytes: a reader's memory is a group of them, whatever a task holds."""
    groups = []

    def held(df, *options):
        table = staged(df, *options)
        if "ids" in table.columns:
            for file in table.inputFiles():
                meta = pq.ParquetFile(file.removeprefix("file:")).metadata
                groups.append([meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)])
        return table

    monkeypatch.setattr(module, "staged", held)
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(150_000)), lambda i: (i * 7919 + F.col("id") * 104_729) % 999_983), " ")
    frame = spark.range(0, 13, 1, 1).select(F.lit("en").alias("lang"), text.alias("text"))
    assert collocations(frame, least=1000, longest=2, size=1 << 20).count() == 0
    assert sum(map(sum, groups)) > 16 << 20 and max(map(max, groups)) < 12 << 20
