"""Token files: codec against plain lists, queries against the library, awkward rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm.queries import QUERIES
from headway.llm.tokenfiles import BLOCK, CLOSING, MORE_LEVELS, WIDEST, Shard, chunk_widths, encode_shard, packed, read_documents, token_output, write_tokens
from tests.llm.cases import SCHEMA, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.01"


def shard_of(docs):
    ids = np.array([x for d in docs for x in d], dtype=np.uint32)
    ends = np.cumsum([len(d) for d in docs]).astype(np.int64)
    raw = encode_shard(ids, ends, np.arange(len(docs)), np.zeros(len(docs), dtype=bool))
    return Shard(raw + CLOSING.encode())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=40), max_size=30), st.randoms())
def test_any_token_alone(docs, rng):
    held, flat = shard_of(docs), [x for d in docs for x in d]
    assert held.between(0, len(flat)).tolist() == flat
    at = [rng.randrange(len(flat)) for _ in range(20)] if flat else []
    assert held.ids(at).tolist() == [flat[i] for i in at]
    assert [held.document(i).tolist() for i in range(len(docs))] == docs


@pytest.mark.parametrize("n", [BLOCK - 1, BLOCK, BLOCK + 1, 40 * BLOCK + 7])
def test_ranks_across_blocks(n):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, 1 << 16, n) >> rng.integers(0, 16, n)).tolist()
    held = shard_of([ids])
    assert len(held.widths) > 1 and held.counts[0] == n
    assert held.ids(np.arange(n)[::-1]).tolist() == ids[::-1]
    with pytest.raises(IndexError):
        held.ids([n])


def test_cheapest_widths():
    def bits(widths, counts):
        total, done = 0, 0
        for i, w in enumerate(widths):
            n = sum(c for b, c in enumerate(counts) if b > done or not done)
            total += n * (w + (1 + 32 / BLOCK if i < len(widths) - 1 else 0))
            done += w
        return total

    def splits(n):
        return [[n], *([w, *rest] for w in range(1, n) for rest in splits(n - w))]

    rng = np.random.default_rng(3)
    for _ in range(30):
        counts = np.concatenate([rng.integers(0, 1000, 9) * rng.integers(0, 2, 9), [5]])
        best = chunk_widths(counts)
        assert sum(best) == 9 and max(best) <= WIDEST
        allowed = [s for s in splits(9) if max(s) <= WIDEST and len(s) <= 2 + MORE_LEVELS]
        assert bits(best, counts) == pytest.approx(min(bits(s, counts) for s in allowed))


def test_packing_in_steps(monkeypatch):
    import headway.llm.tokenfiles as module

    values = np.arange(1000, dtype=np.uint32) * 7 % 32
    whole = packed(values, 5)
    monkeypatch.setattr(module, "STEP", 64)
    assert packed(values, 5) == whole
    held = shard_of([values.tolist()])
    assert held.document(0).tolist() == values.tolist()


def test_broken_files_are_refused():
    raw = encode_shard(np.arange(9, dtype=np.uint32), np.array([9]), np.array([1]), np.array([False]))
    for bad in (raw, raw[:-20] + CLOSING.encode()[:-1], b"x" + raw + CLOSING.encode()):
        with pytest.raises(ValueError):
            Shard(bad)


def plain(rows):
    """``rows``: (id, text) in any order; what the files have to hold, by ascending id, rows without one last."""
    library = Tokenizer.from_file(PATH)
    out = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
    return out


@pytest.mark.parametrize("size", [1, 1000, 1 << 20])
def test_round_trip_of_awkward_rows(spark, tmp_path, size):
    frame = spark.createDataFrame(documents(), SCHEMA).withColumns({"start": F.lit("own"), "part": F.lit("own")}).repartition(3)
    write_tokens(frame, PATH, f"{tmp_path}/t", shard_tokens=size)
    got = read_documents(spark, f"{tmp_path}/t", with_ids=True).orderBy("start").collect()
    want = plain([(r[0], r[1]) for r in documents()])
    assert [r["id"] for r in got] == [w[0] for w in want]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert sorted((str(r["id"]), r["n_tokens"], r["ids_crc32"], r["ids"]) for r in got) == sorted((str(w[0]), *w[1:]) for w in want)


def test_hot_id_is_dealt_to_many_files(spark, tmp_path):
    frame = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    write_tokens(frame.repartition(8), PATH, f"{tmp_path}/t")
    spark.conf.set(key, "true")
    parts = spark.read.format("binaryFile").load(f"{tmp_path}/t").groupBy("part").count().count()
    got = read_documents(spark, f"{tmp_path}/t")
    assert parts > 1 and got.count() == 3000 and got.select("start").distinct().count() == 3000


def test_empty_table(spark):
    frame = spark.createDataFrame(documents(), SCHEMA).limit(0)
    got = token_output(frame, PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0


def test_query_equals_library(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_files"](spark, FOLDER).orderBy("doc_id").collect()
    before = 0
    for r, (i, n, crc, _) in zip(got, plain(docs), strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, before, n, crc)
        before += n
