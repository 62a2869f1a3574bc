"""From raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import settings
from headway.llm.leaks import find_leaks
from headway.llm.lines import drop_repeated_runs
from headway.llm.overlap import drop_near_copies
from headway.llm.packing import pack_documents
from headway.llm.simhash import one_per_group
from headway.llm.toxicity import held_out, learn, score_texts
from headway.session import apply_defaults, staged

WORD = r"[^\x20\x09-\x0D]"
PASSAGE_WORDS = 50


def prepare(spark: SparkSession) -> None:
    apply_defaults(spark)
    settings(spark)


def shielded(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *made: str) -> DataFrame:
    """``work`` on ``docs`` whose columns named like those that ``work`` makes are set aside."""
    aside = {c: f"_aside_{i}" for i, c in enumerate(docs.columns) if c in made}
    done = work(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def rewritten(docs: DataFrame, changed: Column) -> DataFrame:
    """Documents whose text was cut: ``n_chars`` follows, and those left without a word go."""
    out = docs.where(~changed | F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go.

    Null and empty texts are scored like others; repeated rows get equal scores;
    without labels of both kinds nothing goes. An empty table stays one.
    """
    prepare(spark)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return shielded(docs, lambda d: score_texts(d, model).where("predicted = 0"), "score", "predicted", "offending")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go: of three lines and more, or of fewer with ``PASSAGE_WORDS`` words.

    Documents left without a word go too, if they lost lines. Null and empty
    texts stay as they are; rows that repeat id and text are one document; an
    empty table stays one.
    """
    prepare(spark)
    return shielded(
        docs, lambda d: rewritten(drop_repeated_runs(d, min_words=PASSAGE_WORDS), F.col("n_removed") > 0), "n_lines", "n_removed"
    )


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays.

    First the one with the smallest id of every SimHash group; of what is left,
    documents go whose five-word shingles overlap those of an earlier one by 80 % or
    more, which fingerprints alone do not tell. Texts without words are one group; of
    rows that repeat id and text one stays; rows without an id come last; an empty table stays one.
    """
    prepare(spark)
    return drop_near_copies(staged(one_per_group(docs)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out; documents left without a word by that go.

    Null and empty texts stay; repeated rows are cut alike; an empty table, of
    documents or of items, leaves all as it is.
    """
    prepare(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return shielded(
        docs,
        lambda d: rewritten(find_leaks(d, items, cut=True), F.size("leak_spans") > 0),
        "n_words",
        "leak_spans",
        "leak_items",
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens.

    A null or empty text is the end id alone; repeated rows are packed each; an
    empty table gives no piece.
    """
    prepare(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Learned scores, fingerprints and token ids have no SQL form; tests hold each
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
