"""Benchmark decontamination with an FM-index per training shard."""

from __future__ import annotations

import math
import re
import string
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import per_row, texts_of, unused
from headway.session import staged

# Words are runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased first.
_FOLD = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else b if b >= 128 or chr(b) in string.ascii_lowercase + string.digits else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")
SAMPLE_STEP = 8


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """Distinct windows of a block of items, and the items each belongs to."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in folded_words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                windows.setdefault(tuple(ids[i : i + size]), set()).update([] if item is None else [item])
        self.items = list(windows.values())
        self.sizes = np.array([len(w) for w in windows], dtype=np.int64)
        self.words = np.zeros((len(windows), window), dtype=np.int64)
        for i, w in enumerate(windows):
            self.words[i, : len(w)] = w
        self.shortest = int(self.sizes.min(initial=window))
        base = len(self.vocabulary) + 1
        follow = (np.arange(1, window)[None, :] < self.sizes[:, None]) if len(windows) else np.zeros((0, window - 1), dtype=bool)
        self.pairs = np.unique((self.words[:, :-1] * base + self.words[:, 1:])[follow])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; a suffix that ends sorts before its extensions."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:] if step < n else after[: n - step]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        ranked = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        rank[order] = ranked
        if n == 0 or ranked[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """Occurrences of a symbol in a prefix, bit level by bit level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, self.zeros = [], []
        row = symbols
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (row >> bit) & 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(ones)])))
            self.zeros.append(int(len(row) - ones.sum()))
            row = np.concatenate([row[ones == 0], row[ones == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at
        for (bit, ones), zeros in zip(self.levels, self.zeros, strict=True):
            one = (symbol >> bit) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low


class FMIndex:
    """Index of one shard's words: counts, wavelet matrix of the last column, sampled suffix positions."""

    def __init__(self, text: np.ndarray, top: int):
        self.size = len(text)
        order = suffix_array(text)
        self.last = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.ranks = WaveletMatrix(self.last, top)
        self.marked = order % SAMPLE_STEP == 0
        self.sampled = np.where(self.marked, order, -1)

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose suffixes begin with each phrase, by backward search."""
        low, high = np.zeros(len(sizes), dtype=np.int64), np.full(len(sizes), self.size, dtype=np.int64)
        for back in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((sizes > back) & (low < high))
            symbol = phrases[live, sizes[live] - 1 - back]
            low[live] = self.before[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to a sampled one, and as many steps on."""
        position = np.empty(len(rows), dtype=np.int64)
        todo, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            done = self.marked[rows]
            position[todo[done]] = self.sampled[rows[done]] + steps
            todo, rows = todo[~done], rows[~done]
            symbol = self.last[rows]
            rows = self.before[symbol] + self.ranks.rank(symbol, rows)
            steps += 1
        return position


def occurrences(flat: np.ndarray, owner: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Start and phrase number of every occurrence in a shard.

    Only stretches that a phrase could lie in are indexed: runs of two and more
    words in which each pair of neighbours is a pair of some phrase, no shorter
    than the shortest phrase. Words are numbered from 2, symbol 1 sets stretches
    apart, symbol 0 ends the text.
    """
    base = len(phrases.vocabulary) + 1
    n = len(flat)
    if not n or not len(phrases.sizes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    code = flat[:-1] * base + flat[1:]
    live = np.flatnonzero((flat[:-1] > 0) & (flat[1:] > 0) & (owner[:-1] == owner[1:]))
    at = np.searchsorted(phrases.pairs, code[live])
    tied = np.zeros(n + 1, dtype=bool)
    if len(phrases.pairs):
        tied[live[phrases.pairs[np.minimum(at, len(phrases.pairs) - 1)] == code[live]] + 1] = True
    starts = np.flatnonzero((flat > 0) & ~tied[:n])
    ends = np.flatnonzero((flat > 0) & ~tied[1:]) + 1
    long = ends - starts >= phrases.shortest
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    text = np.ones(int((sizes + 1).sum()) + 1, dtype=np.int64)
    text[-1] = 0
    place = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    source, target = np.repeat(starts, sizes) + inner, np.repeat(place, sizes) + inner
    text[target] = flat[source] + 1
    origin = np.full(len(text), -1, dtype=np.int64)
    origin[target] = source
    index = FMIndex(text, base)
    low, high = index.search(phrases.words + 1, phrases.sizes)
    found = np.repeat(np.arange(len(low)), high - low)
    rows = np.repeat(low, high - low) + np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    return origin[index.locate(rows)], found


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = 4 << 20, blocks_per_pass: int = 4, cut: bool = False) -> DataFrame:
    """Append ``n_words, leak_spans, leak_items`` to every document.

    Spans are merged ranges of words, items the sorted ids (as text) of the items
    with an occurring window. With ``cut`` the text loses the words of its spans: a
    span goes from the first byte of its first word to the last of its last, the
    text around it stays, and texts without a span are untouched. Items go out in blocks of about ``block_bytes``
    text, each to all documents; with many blocks, what has been found so far is
    staged every ``blocks_per_pass`` blocks. Documents are indexed in slices of
    a few megabytes, a longer text alone, and are never shuffled.

    Null and empty texts have no words; items without words are left out; an item
    without an id is searched for like others, but has no place in the list of
    ids; items that repeat count once per id; repeated documents get equal
    results; columns of ``docs`` named like new ones are replaced. Without items
    nothing is found; an empty table of documents stays one.
    """
    spark = docs.sparkSession
    usable = items.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text")
    ).distinct()
    volume = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(volume / block_bytes))
    (left,) = unused(docs, "_left")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "leak_spans", "leak_items")]).withColumns(
        {
            "leak_spans": F.array().cast("array<struct<start:int,end:int>>"),
            "leak_items": F.array().cast("array<string>"),
        }
    )
    for b in range(blocks):
        rows = usable.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r["item"], bytes(r["text"])) for r in rows], window))
        last = cut and b + 1 == blocks
        made = "n_words long, leak_spans array<struct<start:int,end:int>>, leak_items array<string>" + f", `{left}` string" * last
        out = per_row(out, _search_in(phrases, text, left if last else None), made, text)
        if b + 1 < blocks and (b + 1) % blocks_per_pass == 0:
            out = staged(out)
    return out.withColumn(text, F.col(left)).drop(left) if cut else out


def _search_in(shared: Any, text: str, left: str | None):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        phrases: Phrases = shared.value
        get = phrases.vocabulary.get
        words = [folded_words(t) for t in texts_of(part.column(text))]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.concatenate([np.fromiter(map(get, w, repeat(0)), dtype=np.int64, count=len(w)) for w in words]) if words else np.zeros(0, dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        starts, found = occurrences(flat, owner, phrases)
        spans = part.column("leak_spans").to_pylist() if "leak_spans" in part.schema.names else [[] for _ in words]
        leaked: list[set[str]] = [set(x) for x in part.column("leak_items").to_pylist()]
        edge = np.zeros(len(flat) + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + phrases.sizes[found], -1)
        for doc, phrase in set(zip(owner[starts].tolist(), found.tolist(), strict=True)):
            leaked[doc] |= phrases.items[phrase]
        hit_docs = np.unique(owner[starts]).tolist()
        if hit_docs:
            hit = np.cumsum(edge)[:-1] > 0
            for doc in hit_docs:
                own = hit[first[doc] : first[doc] + sizes[doc]].copy()
                for s in spans[doc]:
                    own[s["start"] : s["end"]] = True
                turns = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans[doc] = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
        made = {
            "n_words": pa.array(sizes),
            "leak_spans": pa.array(spans, kind),
            "leak_items": pa.array([sorted(x) for x in leaked], pa.list_(pa.string())),
        }
        if left:
            texts = part.column(text).cast(pa.binary()).to_pylist()
            rest = [without_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            made[left] = pa.array(rest, pa.binary()).cast(pa.string())
        return made

    return work


def without_spans(raw: bytes, spans: list[dict[str, int]]) -> bytes:
    """A text without the words of some spans."""
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    kept, last = [], 0
    for s in spans:
        kept.append(raw[last : at[s["start"]][0]])
        last = at[s["end"] - 1][1]
    return b"".join([*kept, raw[last:]])
