"""Token counts through a digest cache, and the tokenizer both token operators share."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import per_row, texts_of, unused
from headway.session import shared_folder, staged

# Texts outside these characters, or with a very long run without a break, are
# left to the tokenizer library: within them both encoders are tested to agree.
PLAIN = re.compile("[\x00-ɏ]*")
LONG_RUN = re.compile(r"\s{500}|\w{5000}|[^\w\s]{5000}")

# Fixed value: the split of a byte-level file that names none of its own.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others in turn for the
    characters from 256 on.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids as the tokenizer library gives them, without added special tokens.

    Byte-level BPE files whose merges follow the order of ids are run by a
    faster encoder over the same vocabulary where the text is plain.
    """

    def __init__(self, path: str):
        self.path = path
        self.fast = self._fast(path)

    @cached_property
    def library(self):
        """Loaded when a text first needs it: a worker whose texts are plain never holds it."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    @staticmethod
    def _fast(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return None
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec.get("added_tokens", [])):
            return None
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merged = [ranks[bytes(letters[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
            return None
        return tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and PLAIN.fullmatch(text) and not LONG_RUN.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self.library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: other bytes, other counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def open_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Stored counts: ``version, digest, n_tokens``; a folder not yet written has none."""
    schema = "version string, digest binary, n_tokens long"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", cache: str | None = None) -> DataFrame:
    """Append ``n_tokens``, encoding only texts whose digest has no stored count.

    A text is known by the SHA-256 of its content (null counts as empty; bytes
    are otherwise unchanged, as any change of content may change the count)
    together with the digest of the tokenizer file. Missing digests are made
    distinct before texts are encoded, so copies are encoded once; their counts
    are appended to the cache folder (a new one below the shared folder where
    none is named) and every row takes its count from there by an equi-join on
    digests. Counts in the cache appear once per append; a digest that two jobs
    append at a time has the same count twice and is read once. A digest that has
    no count after the append (a lost or half-written file) ends the query.

    Empty texts count 0. Repeated rows stay. A column named ``n_tokens`` is
    replaced. An empty table gives no rows.
    """
    spark, shared = docs.sparkSession, cache is not None
    cache = cache or f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    version = tokenizer_version(tokenizer)
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256))
    known = open_cache(spark, cache).where(F.col("version") == version).select("digest").distinct()
    misses = (
        docs.select(digest.alias("digest"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .join(known, "digest", "left_anti")
        .groupBy("digest")
        .agg(F.min("text").alias("text"))
    )

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        encode = encoder(tokenizer).ids
        return {"n_tokens": pa.array([len(encode(t.decode("utf-8", "replace"))) for t in texts_of(part.column("text"))], pa.int64())}

    per_row(misses, work, "n_tokens long", "text").select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = open_cache(spark, cache).where(F.col("version") == version).select("digest", "n_tokens")
    if shared:
        # Other jobs may have appended the same digests. Written before the join, so
        # that the rows of a text with very many copies can be split over tasks.
        counts = staged(counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    (own,) = unused(docs, "_digest")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "n_tokens"]).withColumn(own, digest)
    missing = F.raise_error(F.lit(f"no stored count for a text in {cache}")).cast("long")
    return rows.join(counts.withColumnRenamed("digest", own), own, "left").withColumn("n_tokens", F.coalesce("n_tokens", missing)).drop(own)


def piece_table(docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text: str = "text", end: int = 0, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens: ``piece, start, length, ids_crc32``.

    A document's ids are followed by ``end``. A longer one is cut into full
    pieces behind a first piece that takes what is over. ``with_ids`` adds the
    ids as little-endian unsigned 32-bit numbers.
    """
    import zlib

    fields = "piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        encode = encoder(tokenizer).ids
        cut = []
        for t in texts_of(part.column(text)):
            ids = np.array([*encode(t.decode("utf-8", "replace")), end], dtype="<u4")
            first = (len(ids) - 1) % capacity + 1
            edges = [0, *range(first, len(ids) + 1, capacity)]
            pieces = []
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                raw = ids[a:b].tobytes()
                pieces.append((i, a, b - a, zlib.crc32(raw), *((raw,) if with_ids else ())))
            cut.append(pieces)
        kinds = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        kinds += [("ids", pa.binary())] if with_ids else []
        return {"pieces": pa.array([[dict(zip((k for k, _ in kinds), p, strict=True)) for p in pieces] for pieces in cut], pa.list_(pa.struct(kinds)))}

    made = per_row(docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text}`").alias(text)), work, f"pieces array<struct<{fields.replace(' ', ':').replace(',:', ', ')}>>", text)
    return made.select(id_col, F.inline("pieces"))


