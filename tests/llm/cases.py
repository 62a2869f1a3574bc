"""Small tables with the awkward rows, and plain Python versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words long, score string, host string, _removed int, kept boolean"

LONG = " ".join(f"w{i % 997}" for i in range(60_000)) + ".\n" + "Many lines here.\n" * 3000


def documents():
    """Null ids and texts, empty, blank and long texts, ties, repeated rows; columns named like results."""
    a = "One line, as it is.\nAnother line, as it is.\nA third line, as it is.\nA fourth one."
    rows = [
        (5, a),
        (3, a),
        (3, a),
        (3, "the same id, another text.\nOne line, as it is."),
        (None, a),
        (None, None),
        (7, None),
        (8, ""),
        (9, " \t\n\n  \r\n"),
        (10, LONG),
        (11, "ÀÉ naïve – ünïcode … 漢字 ☃\u00a0x\u2028y\x85z"),
        (12, "x"),
        (-4, a + "\nWith an end."),
    ]
    return [(i, t, -1, "own", "own", 1, None) for i, t in rows]


def prose(n, seed=0, words=40, alphabet=12):
    """Texts over few words, so that repeats of every length and self-overlaps abound."""
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(alphabet)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.5:
            old = rng.choice(texts).split()
            a = rng.randrange(len(old) + 1) if old else 0
            b = rng.randrange(a, len(old) + 1)
            body = old[:a] + rng.choices(names, k=rng.randrange(4)) + old[a:b] * rng.choice((1, 1, 2)) + rng.choices(names, k=rng.randrange(12))
        elif rng.random() < 0.2:
            body = [rng.choice(names)] * rng.randrange(words)
        else:
            body = rng.choices(names, k=rng.randrange(words))
        texts.append(" ".join(body))
    return texts


def collected(df, *keys):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: tuple(str(r[k]) for k in keys))
