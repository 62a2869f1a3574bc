"""Toxicity from document labels by multiple-instance learning."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import per_row, texts_of

SENTENCE = re.compile(r"[^.!?…\n]+")
WORD = re.compile(r"\w+")
BUCKETS = 1 << 18
WORDS_KEPT = 100_000
RATIO = 15.0
TOXIC_WEIGHT = 4.0


class Model(NamedTuple):
    """Logit of a sentence: ``bias`` plus the weights of its words' features."""

    weights: np.ndarray
    bias: float


def features(word: str) -> list[int]:
    """Hash buckets of a lower-cased word and of its first three, four and five letters."""
    return [zlib.crc32(f.encode()) % BUCKETS for f in (word, f"3{word[:3]}", f"4{word[:4]}", f"5{word[:5]}")]


def sentence_words(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-cased words of each sentence with a word."""
    for found in SENTENCE.finditer(text):
        words = WORD.findall(found.group().lower())
        if words:
            yield found.start(), found.end(), words


def fit(texts: list[str], labels: list[int], rounds: int = 300, rate: float = 0.1, decay: float = 1e-5, bias_at: float = -6.0) -> Model:
    """Weights under which a document is toxic unless all its sentences are clean.

    With sentence logits z and S the sum of log(1 + e^z), noisy-or says
    P(toxic) = 1 - e^-S. The log-likelihood of the document labels is raised by
    Adam over the whole sample. Only features that tell the labels apart take
    part; the others keep weight 0 and are not held while fitting.
    """
    weights = np.zeros(BUCKETS)
    target = np.array(labels, dtype=np.float64)
    if not len(target) or target.max() <= 0:
        return Model(weights.astype(np.float32), -50.0)
    telling = _telling(texts, target)
    known: dict[str, list[int]] = {}
    flat, sizes, owners = array("i"), array("i"), array("i")
    for i, text in enumerate(texts):
        for _, _, words in sentence_words(text):
            before = len(flat)
            for w in set(words):
                if w not in known:
                    known[w] = [f for f in features(w) if telling[f]]
                flat.extend(known[w])
            sizes.append(len(flat) - before)
            owners.append(i)
    bias = bias_at
    feature, size, owner = np.array(flat), np.array(sizes), np.array(owners)
    sentence = np.repeat(np.arange(len(size)), size)
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence, weights[feature], minlength=len(size))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        total = np.bincount(owner, np.logaddexp(0, z), minlength=len(target))
        pull = np.where(target > 0, -TOXIC_WEIGHT / np.expm1(np.clip(total, 1e-9, 500)), 1.0) / len(target)
        by_sentence = pull[owner] * p
        grad = np.append(np.bincount(feature, by_sentence[sentence], minlength=BUCKETS) + decay * weights, by_sentence.sum() + 1e-3 * (bias - bias_at))
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return Model(weights.astype(np.float32), float(bias))


def _telling(texts: list[str], target: np.ndarray) -> np.ndarray:
    """Buckets whose presence in documents depends on the label: log-likelihood ratio over ``RATIO``, more often in toxic ones."""
    both, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for text, label in zip(texts, target, strict=True):
        words = {w for _, _, words in sentence_words(text) for w in words}
        seen = np.fromiter({f for w in words for f in features(w)}, dtype=np.int64)
        both[seen] += 1
        if label > 0:
            bad[seen] += 1
    share = (target > 0).mean()

    def term(n: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(n > 0, n * np.log(np.maximum(n, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    rest_bad, rest_good = (target > 0).sum() - bad, (target <= 0).sum() - (both - bad)
    rest = len(target) - both
    ratio = 2 * (term(bad, both * share) + term(both - bad, both * (1 - share)) + term(rest_bad, rest * share) + term(rest_good, rest * (1 - share)))
    return (ratio > RATIO) & (bad > both * share)


class _WordWeights(dict):
    def __init__(self, model: Model):
        self.table = model.weights

    def __missing__(self, word: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        w = float(self.table[features(word)].sum())
        self[word] = w
        return w


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 4000) -> Model:
    """Fit on at most ``sample`` labelled rows that ``usable`` admits.

    The sample bound is the only place where rows are left out: the rows with
    the smallest hash of their id are taken, whole texts, one text per id. One
    task fits; the driver sees the ids and the finished weights (1 MB). An id
    with several labels counts as toxic if one of them says so.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
        .collect()
    )
    picked = F.broadcast(spark.createDataFrame([(r["id"], r["y"]) for r in chosen], "id long, y int"))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
        .join(picked, "id")
        .groupBy("id", "y")
        .agg(F.min("text").alias("text"))
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r["id"], r["y"], r["text"] or "") for b in batches for r in b.to_pylist())
        if held:
            model = fit([r[2] for r in held], [r[1] for r in held])
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], names=["weights", "bias"])

    made = rows.repartition(1).mapInArrow(train, "weights binary, bias double").collect()
    if not made:
        return Model(np.zeros(BUCKETS, dtype=np.float32), -50.0)
    return Model(np.frombuffer(made[0]["weights"], dtype=np.float32), made[0]["bias"])


def score_texts(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Append ``score``, ``predicted`` and the offending sentences.

    ``score`` is the noisy-or of the sentence probabilities of the whole text (0
    for null, empty or wordless texts); ``offending`` holds character range and
    probability of the sentences at or over one half. Repeated rows are scored
    alike; columns named like new ones are replaced.
    """

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        weight, bias = _WordWeights(model), model.bias
        lookup = weight.__getitem__
        scores, offending = [], []
        for raw in texts_of(part.column(text)):
            total, found = 0.0, []
            for start, end, words in sentence_words(raw.decode("utf-8", "replace")):
                z = bias + sum(map(lookup, set(words)))
                if z > -30:
                    total += z if z > 30 else math.log1p(math.exp(z))
                    if z >= 0:
                        found.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-min(z, 40)))})
            scores.append(-math.expm1(-total))
            offending.append(found)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return {
            "score": pa.array(scores, pa.float64()),
            "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32()),
            "offending": pa.array(offending, kind),
        }

    return per_row(docs, work, "score double, predicted int, offending array<struct<start:int,end:int,score:double>>", text)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = 0.7, sample: int = 4000) -> DataFrame:
    """Learn from the rows that are not held out, score all; adds ``held_out``."""
    model = learn(docs, labels, ~held_out(id_col), id_col, text, label, sample)
    return score_texts(docs, model, text, threshold).withColumn("held_out", held_out(id_col))
