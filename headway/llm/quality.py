"""Line-first cleaning and quality verdicts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.common import per_row, texts_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

# Marks that end or join sentences, words of site menus, and
# phrases of notices, licences and calls to act.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE_MARKS = re.compile(r"[.!?…:;,。！？؟।]")
SEPARATORS = re.compile(r"[\x20\x09-\x0D][|»›•·>/][\x20\x09-\x0D]|[|»›•]")
MENU_WORDS = frozenset(
    "about blog cart checkout contact download faq forum help home login logout menu next newsletter previous "
    "register search settings share sitemap subscribe tags".split()
)
PHRASES = re.compile(
    r"all rights reserved|copyright ©|licensed under|permission is hereby granted|terms of (?:use|service)|"
    r"privacy policy|cookie policy|uses? cookies|accept (?:all )?cookies|enable javascript|javascript is (?:disabled|required)|"
    r"lorem ipsum|click here|read more|sign up (?:now|for)|subscribe to|follow us|share this|powered by|back to top|"
    r"skip to (?:main )?content|advertisement",
    re.IGNORECASE,
)
MARKUP = re.compile(r"[#*$%&|<>{}\\^~=_@\[\]]")


def line_fault(line: str) -> str | None:
    """The first rule that a line with a word breaks, or None.

    navigation   two separators or more between labels of at most three words, or
                 at most four words without a mark, one of them a menu word
    punctuation  marks of markup make up over a tenth of the line's letters, or
                 ten words and more stand without one mark of a sentence
    boilerplate  a notice, licence or call phrase, in a line of at most 40 words
    """
    words = WORD.findall(line)
    n = len(words)
    marks = len(MARKUP.findall(line))
    if len(SEPARATORS.findall(line)) >= 2 and all(len(WORD.findall(x)) <= 3 for x in SEPARATORS.split(line)):
        return "navigation"
    if n <= 4 and not SENTENCE_MARKS.search(line) and any(w.lower() in MENU_WORDS for w in words):
        return "navigation"
    if marks * 10 > len(line) - n + 1 or n >= 10 and not SENTENCE_MARKS.search(line):
        return "punctuation"
    if n <= 40 and PHRASES.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text, words inside windows found twice or more in that text.

    All windows of a slice of texts are sorted by one hash in which the text
    takes part; neighbours of equal hash are compared word by word.
    """
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if total < window:
        return np.zeros(len(words), dtype=np.int64)
    ids: dict[bytes, int] = {}
    known = ids.setdefault
    flat = np.fromiter((known(w, len(ids)) for text in words for w in text), dtype=np.int64, count=total)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(total)
    at = at[(at + window <= ends[owner]) & (sizes[owner] > window)]
    mixed = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    key = owner[at].astype(np.uint64)
    for j in range(window):
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + mixed[at + j]
    order = np.argsort(key)
    key, at = key[order], at[order]
    pairs = np.flatnonzero(key[1:] == key[:-1])
    a, b = at[pairs], at[pairs + 1]
    same = owner[a] == owner[b]
    for j in range(window):
        same &= flat[a + j] == flat[b + j]
    starts = np.concatenate([a[same], b[same]])
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    covered = np.cumsum(edge)[:total] > 0
    return np.bincount(owner[covered], minlength=len(words)).astype(np.int64)


def quality(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat: int = 30, max_lost: int = 50) -> DataFrame:
    """Judge whole texts line by line, then as documents.

    Appends ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, the
    text without its failing lines as ``clean_text``, ``n_failed_lines``,
    ``fault`` (base, lost, or null) and ``base_failed``, ``kept``. A document
    is rejected by its base figures (under ``min_words`` words, or over
    ``max_repeat`` per cent of its words in repeated windows), or when its
    failing lines hold over ``max_lost`` per cent of its words.

    One pass without a shuffle. A null or empty text has no words and is
    rejected; a repeated row is judged again and alike; columns of ``docs`` named
    like new ones are replaced; an empty table gives no rows. Texts are judged
    in slices of a few megabytes, a longer text alone.
    """

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        raw = texts_of(part.column(text))
        words = [t.split() for t in raw]
        repeats = repeated_words(words).tolist()
        out: dict[str, list] = {n: [] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "clean_text", "n_failed_lines", "fault", "base_failed")}
        for blob, w, again in zip(raw, words, repeats, strict=True):
            t = blob.decode("utf-8", "replace")
            lines = t.split("\n")
            full = [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
            n = len(w)
            clean, lost, failed = [], 0, 0
            for line in lines:
                if line.strip(" \t\n\x0b\x0c\r") and line_fault(line):
                    lost += len(line.encode().split())
                    failed += 1
                else:
                    clean.append(line)
            base = n < min_words or 100 * again > max_repeat * n
            out["n_words"].append(n)
            out["word_chars"].append(len(t) - sum(t.count(chr(c)) for c in SPACES))
            out["n_symbols"].append(sum(blob.count(c) for c in SYMBOLS))
            out["n_dup_lines"].append(len(full) - len(set(full)))
            out["clean_text"].append("\n".join(clean))
            out["n_failed_lines"].append(failed)
            out["base_failed"].append(base)
            out["fault"].append("base" if base else "lost" if 100 * lost > max_lost * n else None)
        made = {k: pa.array(v, pa.int64()) for k, v in out.items() if k.startswith("n_") or k == "word_chars"}
        made["n_repeat_words"] = pa.array(repeats, pa.int64())
        made["clean_text"] = pa.array(out["clean_text"], pa.string())
        made["fault"] = pa.array(out["fault"], pa.string())
        made["base_failed"] = pa.array(out["base_failed"], pa.bool_())
        made["kept"] = pa.array([f is None for f in out["fault"]], pa.bool_())
        return made

    return per_row(
        docs,
        work,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "clean_text string, n_failed_lines long, fault string, base_failed boolean, kept boolean",
        text,
    )
