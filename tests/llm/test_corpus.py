"""Operators over the whole corpus against plain Python: lines, repeats, packing, leaks, near-duplicates."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from headway.llm.leaks import FMIndex, find_leaks, suffix_array
from headway.llm.lines import drop_repeated_runs
from headway.llm.overlap import drop_near_copies
from headway.llm.packing import fill_patterns, pack, pack_documents, slot_table
from headway.llm.simhash import byte_choices, linked, near_duplicates, one_per_group
from headway.llm.substrings import Words, _Names, anchored_blocks, remove_repeats
from headway.operators.components import connected_components
from tests.llm.cases import SCHEMA, WORD, documents, prose

LAST = (1 << 63) - 1
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# Lines


def runs_removed(docs, m):
    """``docs``: (key, text) in the order of first copies; positions removed per key."""
    seqs = {k: [(p, x) for p, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for k, t in docs}
    seen, gone = set(), defaultdict(set)
    for k, _ in docs:
        lines = [x for _, x in seqs[k]]
        for i in range(len(lines) - m + 1):
            run = tuple(lines[i : i + m])
            if run in seen:
                gone[k].update(p for p, _ in seqs[k][i : i + m])
            seen.add(run)
    return gone


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_line_runs_equal_plain_search(spark, m):
    texts = [t.replace(" ", "\n") + ("\n\n  \n" if i % 3 == 0 else "") for i, t in enumerate(prose(120, 5, 30, 5))]
    gone = runs_removed(list(enumerate(texts)), m)
    got = {r["doc_id"]: r for r in drop_repeated_runs(frame(spark, texts), min_lines=m).collect()}
    for i, t in enumerate(texts):
        kept = [x for p, x in enumerate(t.split("\n")) if p not in gone[i]]
        assert got[i]["n_removed"] == len(gone[i])
        assert got[i]["text"] == "\n".join(kept)


def passages_removed(docs, m, words):
    """Like ``runs_removed``, with runs of fewer lines that have ``words`` words."""
    gone = defaultdict(set)
    for d in range(1, m + 1):
        seen = set()
        for k, t in docs:
            lines = [(p, x) for p, x in enumerate((t or "").split("\n")) if WORD.search(x)]
            for i in range(len(lines) - d + 1):
                run = tuple(x for _, x in lines[i : i + d])
                if d < m and sum(len(WORD.findall(x)) for x in run) < words:
                    continue
                if run in seen:
                    gone[k].update(p for p, _ in lines[i : i + d])
                seen.add(run)
    return gone


@pytest.mark.parametrize(("m", "words"), [(1, 9), (3, 1), (3, 6), (4, 9)])
def test_long_passages_of_few_lines_go(spark, m, words):
    rng = random.Random(m)
    texts = ["".join(x + ("\n" if rng.random() < 0.3 else " ") for x in t.split()) for t in prose(150, 5, 40, 4)]
    gone = passages_removed(list(enumerate(texts)), m, words)
    got = {r["doc_id"]: r for r in drop_repeated_runs(frame(spark, texts), min_lines=m, min_words=words).collect()}
    for i, t in enumerate(texts):
        assert got[i]["text"] == "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i])
        assert got[i]["n_removed"] == len(gone[i])
    assert m == 1 or any(gone[i] != runs_removed(list(enumerate(texts)), m)[i] for i in range(len(texts)))
    assert drop_repeated_runs(frame(spark, texts).limit(0), min_words=words).count() == 0


def test_line_runs_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    got = drop_repeated_runs(docs)
    assert got.columns == [*[c for c in docs.columns], "n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(documents())
    for r in rows:
        if r["doc_id"] in (7, 8, 9, 11, 12) or r["text"] is None:
            assert r["n_removed"] == 0
        if r["doc_id"] == -4:
            assert r["n_removed"] == 0 and r["text"].startswith("One line, as it is.")
        if r["doc_id"] in (5,) or r["doc_id"] is None and r["n_lines"]:
            assert r["n_removed"] == 4 and r["text"] == ""
    assert next(r for r in rows if r["doc_id"] == 10)["n_removed"] == 2999
    assert drop_repeated_runs(docs.limit(0)).count() == 0


def test_line_runs_stay_native(spark):
    plan = drop_repeated_runs(frame(spark, ["a\nb\nc\nd", "a\nb\nc"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Repeated word sequences


def words_removed(rows, window):
    """``rows``: (id, text); words kept per row."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            q = tuple(w[k : k + window])
            first[q] = min(first.get(q, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (LAST if i is None else i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "alphabet"), [(5, 2), (7, 4), (12, 9), (50, 40)])
def test_repeats_equal_plain_search(spark, window, alphabet):
    texts = prose(150, window, 4 * window, alphabet)
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(i, texts[i]) for i in order]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window)
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str) == words_removed(rows, window)


def test_repeats_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    got = remove_repeats(docs, window=6).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == words_removed([r[:2] for r in documents()], 6)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_texts_without_an_id_keep_their_own_words(spark):
    """Rows without an id share one place in the order; each text is a document of its own."""
    shared = " ".join(f"s{i}" for i in range(60))
    own = [" ".join(f"o{k}x{i}" for i in range(60)) for k in range(300)]
    rows = [(1, shared), *((None, f"x{k} {shared}" if k % 2 else f"y{k} {w}") for k, w in enumerate(own))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str) == words_removed(rows, 50)


def test_word_names_are_two_and_independent():
    words = Words([b"a b a", b"c"], _Names())
    assert words.names[0] == words.names[2] and words.second[0] == words.second[2]
    assert len(set(words.names.tolist()) | set(words.second.tolist())) == 6
    again = Words([b"c b"], _Names())
    assert again.second.tolist() == [words.second[3], words.second[1]]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 30])
def test_equal_windows_lean_on_equal_symbols(alphabet):
    window = 9
    texts = [t.encode() for t in prose(60, alphabet, 50, alphabet)]
    words = Words(texts, _Names())
    found = anchored_blocks(words, window)
    by_window = defaultdict(set)
    seen = 0
    for owner, start, size, symbol in zip(found["owner"], found["start"], found["size"], found["symbol"], strict=True):
        for k in range(start, start + size):
            by_window[tuple(words.lists[owner][k : k + window])].add(int(symbol))
            seen += 1
    assert seen == sum(max(0, len(w) - window + 1) for w in words.lists)
    assert all(len(symbols) == 1 for symbols in by_window.values())


# Packing


@pytest.mark.parametrize("capacity", [1, 7, 64, 300])
def test_patterns_use_up_counts(capacity):
    rng = random.Random(capacity)
    counts = {n: rng.randrange(1, 40) for n in rng.sample(range(1, capacity + 1), k=max(1, capacity // 3))}
    used = defaultdict(int)
    for pattern, n in fill_patterns(counts, capacity):
        assert n > 0 and sum(pattern) <= capacity
        for x in pattern:
            used[x] += n
    assert dict(used) == counts


def test_exact_complements_come_first():
    assert sum(n for _, n in fill_patterns({60: 5, 40: 5, 70: 2, 20: 2, 10: 2, 50: 4, 25: 3, 15: 3}, 100)) == 5 + 2 + 2 + 2
    assert sorted(fill_patterns({90: 1, 4: 1, 3: 2}, 100)) == [((90, 4, 3, 3), 1)]
    assert fill_patterns({}, 10) == [] and len(slot_table([])["length"]) == 0


def test_packing_places_every_piece(spark):
    library = __import__("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(documents(), SCHEMA)
    for capacity in (2048, 50):
        got = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity).collect()
        want = []
        for i, t, *_ in documents():
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
            first = (len(ids) - 1) % capacity + 1
            edges = [0, *range(first, len(ids) + 1, capacity)]
            want += [(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) == sorted(want, key=str)
        check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], capacity)
    assert pack_documents(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def check_sequences(places, capacity):
    by = defaultdict(list)
    for s, o, n in places:
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def best_fit_decreasing(lengths, capacity):
    gaps = [0] * (capacity + 1)
    n = 0
    for x in sorted(lengths, reverse=True):
        gap = next((g for g in range(x, capacity + 1) if gaps[g]), None)
        if gap is None:
            n += 1
            gap = capacity
        else:
            gaps[gap] -= 1
        gaps[gap - x] += 1
    return n


def test_packing_is_tight_with_a_hot_length(spark):
    rng = random.Random(6)
    lengths = [37] * 2000 + [100] * 300 + [rng.randrange(1, 101) for _ in range(2000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "k long, length long")
    got = pack(pieces, 100, ["k"]).collect()
    assert len(got) == len(lengths)
    n = check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], 100)
    assert n <= best_fit_decreasing(lengths, 100)
    with pytest.raises(ValueError):
        pack(pieces, 99, ["k"])


# Benchmark leaks


def leaked(text, items, window):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = pattern.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for item, t in items:
        own = pattern.findall((t or "").translate(UPPER))
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[k : k + size]:
                    hit.update(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
    return len(words), hit, sorted(found)


def test_items_without_an_id_are_searched_for(spark):
    text = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(None, text), (None, text), (4, "nine ten eleven")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text), (2, "none of it")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in find_leaks(docs, bench).collect()}
    assert [tuple(s) for s in got[1]["leak_spans"]] == [(0, 11)] and got[1]["leak_items"] == ["4"]
    assert got[2]["leak_spans"] == []


@pytest.mark.parametrize("alphabet", [2, 6, 25])
def test_leaks_equal_plain_search(spark, alphabet):
    texts = [t.replace(" ", ", ").title() for t in prose(80, alphabet, 40, alphabet)]
    items = [(i, t) for i, t in enumerate(prose(25, 9, 16, alphabet))]
    items += [(0, "t1 t0"), (50, "T1 t1-T0"), (51, ""), (52, None), (53, "nowhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 300):
        got = {r["doc_id"]: r for r in find_leaks(frame(spark, texts), bench, window=6, block_bytes=block_bytes, blocks_per_pass=2).collect()}
        for i, t in enumerate(texts):
            n, hit, found = leaked(t, items, 6)
            assert got[i]["n_words"] == n
            assert {k for s in got[i]["leak_spans"] for k in range(s["start"], s["end"])} == hit
            assert got[i]["leak_items"] == found


def test_leaks_awkward_rows_and_cut(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    bench = spark.createDataFrame([(1, "another LINE as it is a third"), (None, "as it is")], "item_id long, text string")
    found = find_leaks(docs, bench, window=4, cut=True)
    rows = found.collect()
    assert len(rows) == len(documents()) and set(found.columns) == {*docs.columns, "leak_spans", "leak_items"}
    for r in rows:
        if r["doc_id"] == 5:
            assert r["text"] == "One  fourth one." and r["leak_items"] == ["1"]
        if r["doc_id"] in (8, 9, 10, 11, 12):
            assert r["leak_spans"] == []
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).where(F.size("leak_spans") > 0).count() == 0


def test_fm_index_parts():
    rng = np.random.default_rng(7)
    for n in (1, 2, 30, 400):
        text = np.append(rng.integers(1, 4, size=n), 0)
        order = suffix_array(text)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        index = FMIndex(text, 3)
        assert index.locate(np.arange(n + 1)).tolist() == order.tolist()


# Near-duplicates


def simhash_of(text):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    known = list(parent)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in known}


def test_any_five_bytes_hold_a_choice():
    from itertools import combinations

    choices = [set(c) for c in byte_choices()]
    assert len(choices) == 14 and all(len(c) == 4 for c in choices)
    assert all(any(c <= set(five) for c in choices) for five in combinations(range(8), 5))


def test_links_of_dense_fingerprints(spark):
    """Lists far longer than a block, chains, and far apart fingerprints."""
    rng = random.Random(8)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), k=rng.randrange(0, 7))) for _ in range(500)}
        for _ in range(40):
            centre ^= sum(1 << b for b in rng.sample(range(64), k=3))
            prints.add(centre)
    prints |= {rng.getrandbits(64) for _ in range(300)}
    want = components_of(prints)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    edges = linked(spark.createDataFrame(signed, "fp long"))
    got = {r["id"] % (1 << 64): r["component"] for r in connected_components(edges).collect()}
    groups, mine = defaultdict(set), defaultdict(set)
    for f, c in want.items():
        groups[c].add(f)
        mine[got.get(f, ("alone", f))].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_near_duplicates_equal_plain_search(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words).upper() if rng.random() < 0.3 else "\n".join(words))
    rows = [(i + 100, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in documents()]
    root = components_of({simhash_of(t) for _, t in rows})
    least = {}
    for i, t in rows:
        r = root[simhash_of(t)]
        if i is not None:
            least[r] = min(least.get(r, LAST), i)
    want = sorted([(i, simhash_of(t), least.get(root[simhash_of(t)])) for i, t in rows], key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    kept = one_per_group(docs).collect()
    assert len(kept) == len(set(root.values()))
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} == set(least.values())


def test_near_duplicates_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len({simhash_of(t) for t in {r[1] for r in documents()}})
    assert near_duplicates(docs.limit(0)).count() == 0 and one_per_group(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert one_per_group(empty).count() == 1 and near_duplicates(empty).where("component_id IS NOT NULL").count() == 0


def shingles_of(text, width=5):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def overlap_of(x, y):
    a, b = shingles_of(x), shingles_of(y)
    return len(a & b) / len(a | b) if a and b else 0.0


def test_near_copies_by_shingles_equal_plain_search(spark):
    rng = random.Random(12)
    texts = prose(60, 3, 40, 3)
    for _ in range(40):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(1, 300))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words).upper() if rng.random() < 0.3 else "\n".join(words))
    rng.shuffle(texts)
    sets = []
    for t in texts:
        words = WORD.findall(t.translate(UPPER))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    gone = {j for j, b in enumerate(sets) for a in sets[:j] if a and b and 100 * len(a & b) >= 80 * len(a | b)}
    got = {r["doc_id"] for r in drop_near_copies(frame(spark, texts)).collect()}
    assert got == set(range(len(texts))) - gone
    far = [j for j in gone if not any((simhash_of(texts[j]) ^ simhash_of(t)).bit_count() <= 3 for t in texts[:j])]
    assert far  # the fingerprints alone would leave these


def test_near_copies_by_shingles_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {8, 9, 7, -4, 3, 10, 11, 12} <= set(ids) and 5 not in ids and ids.count(3) == 1
    assert drop_near_copies(docs.limit(0)).count() == 0
