"""Registered queries of the training-data operators; each reads whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from headway.llm import quality as rules
from headway.llm.collocations import collocations
from headway.llm.html import main_text
from headway.llm.leaks import find_leaks
from headway.llm.lines import drop_repeated_runs
from headway.llm.negatives import hard_negatives
from headway.llm.packing import pack_documents
from headway.llm.quality import quality
from headway.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from headway.llm.simhash import near_duplicates
from headway.llm.substrings import remove_repeats
from headway.llm.tokenfiles import token_output
from headway.llm.tokens import token_counts
from headway.llm.toxicity import toxicity
from headway.llm.urls import UrlRule, judge, rule_table

TOKENIZER = "byte_bpe_50k.json"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_WORD = _quoted(rules.WORD.pattern)
_LINE_FAULT = f"""CASE
    WHEN len(regexp_extract_all(line, {_quoted(rules.SEPARATORS.pattern)})) >= 2
      AND len(list_filter(regexp_split_to_array(line, {_quoted(rules.SEPARATORS.pattern)}), lambda x: len(regexp_extract_all(x, {_WORD})) > 3)) = 0 THEN true
    WHEN len(lw) <= 4 AND NOT regexp_matches(line, {_quoted(rules.SENTENCE_MARKS.pattern)})
      AND len(list_filter(lw, lambda x: lower(x) IN ({', '.join(_quoted(w) for w in sorted(rules.MENU_WORDS))}))) > 0 THEN true
    WHEN len(regexp_extract_all(line, {_quoted(rules.MARKUP.pattern)})) * 10 > length(line) - len(lw) + 1 THEN true
    WHEN len(lw) >= 10 AND NOT regexp_matches(line, {_quoted(rules.SENTENCE_MARKS.pattern)}) THEN true
    ELSE len(lw) <= 40 AND regexp_matches(line, {_quoted('(?i)' + rules.PHRASES.pattern)}) END"""


@query(
    "op1_line_quality",
    f"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM texts WHERE len(ws) >= 8)),
    twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, line, regexp_extract_all(line, {_WORD}) AS lw
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)),
    judged AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (fault) AS failed,
            coalesce(sum(len(lw)) FILTER (fault), 0) AS lost
        FROM (SELECT *, {_LINE_FAULT} AS fault FROM lines WHERE len(lw) > 0) GROUP BY doc_id),
    base AS (
        SELECT x.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
            coalesce(c.n, 0) AS n_repeat_words, coalesce(failed, 0) AS n_failed_lines, coalesce(lost, 0) AS lost
        FROM texts x LEFT JOIN covered c ON c.doc_id = x.doc_id LEFT JOIN judged j ON j.doc_id = x.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * lost > 50 * n_words) AS kept,
        n_failed_lines,
        CASE WHEN n_words < 20 OR 100 * n_repeat_words > 30 * n_words THEN 'base' WHEN 100 * lost > 50 * n_words THEN 'lost' END AS fault
    FROM base
    """,
)
def line_quality(t):
    judged = quality(t.documents.select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "fault")


URL_RULES = (
    UrlRule("allow", "host_path", "org/"),
    UrlRule("block", "host_path", "example.org/es/"),
    UrlRule("block", "host_path", "example.org/en/1"),
    UrlRule("allow", "host_path", "com/fr/"),
    UrlRule("block", "host_path", "com/de/"),
    UrlRule("block", "pattern", r"(?i)://([^/?#]*[.])?spam-farm[.]", ("spam", "farm")),
    UrlRule("block", "pattern", r"(?i)://([^/?#]*[.])?cheap-pills[.]", ("cheap", "pills")),
    UrlRule("block", "pattern", r"(?i)[./]casino-[a-z]+[.]", ("casino",)),
    UrlRule("block", "pattern", r"(?i)/adserver/", ("adserver",)),
    UrlRule("block", "pattern", r"(?i)/popunder/", ("popunder",)),
)

_RULE_VALUES = ", ".join(
    f"('{r.action}', '{r.rule}', '{r.rule.partition('/')[0]}', '/{r.rule.partition('/')[2]}')" for r in URL_RULES if r.kind == "host_path"
)
_PATTERNS = " OR ".join(f"regexp_matches(coalesce(url, ''), '{r.rule}')" for r in URL_RULES if r.kind == "pattern")


@query(
    "op5_url_filter",
    f"""
    WITH parsed AS (
        SELECT page_id, url,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    rules(action, rule, rule_host, rule_path) AS (VALUES {_RULE_VALUES}),
    best AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
        FROM parsed, rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY page_id)
    SELECT p.page_id, host, path, b.rule,
        CASE WHEN b.rule IS NOT NULL THEN b.action WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END AS verdict
    FROM parsed p LEFT JOIN best b ON p.page_id = b.page_id
    """,
)
def url_filter(t):
    pages = t.pages.select("page_id", "url")
    return judge(pages, rule_table(t.spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


@query("op7_token_counts")
def token_counts_query(t):
    docs = t.documents.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_counts(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query("op8_best_fit_packing")
def best_fit_packing(t):
    packed = pack_documents(t.documents, public_tokenizers.path(TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_toxicity")
def toxicity_query(t):
    scored = toxicity(t.documents.select("doc_id", "text"), t.labels)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


_LEAK_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op9_decontamination",
    f"""
    WITH texts AS (SELECT doc_id, {_LEAK_WORDS} AS ws FROM documents),
    items AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_LEAK_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
    item_windows AS (
        SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS win
        FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM items)),
    sizes AS (SELECT DISTINCT size FROM item_windows),
    windows AS (
        SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS win
        FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM texts, sizes WHERE len(ws) >= size)),
    found AS (SELECT w.doc_id, w.i, w.size, m.item_id FROM windows w JOIN item_windows m ON m.size = w.size AND m.win = w.win),
    hits AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
    leaks AS (
        SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
    SELECT x.doc_id, len(ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(l.n, 0) AS n_items,
        sha256(coalesce(l.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
    FROM texts x LEFT JOIN hits h ON h.doc_id = x.doc_id LEFT JOIN leaks l ON l.doc_id = x.doc_id
    """,
)
def decontamination_query(t):
    found = find_leaks(t.documents.select("doc_id", "text"), t.benchmark)
    hit = F.aggregate("leak_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "leak_items").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op10_simhash")
def simhash_query(t):
    found = near_duplicates(t.documents)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(
    "op6_recompression",
    f"""
    WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
    windows AS (
        SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50)),
    least AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
    gone AS (
        SELECT DISTINCT doc_id, i FROM (
            SELECT w.doc_id, unnest(range(w.i, w.i + 50)) AS i FROM windows w JOIN least l ON l.h = w.h WHERE w.doc_id > l.d)),
    words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM texts),
    kept AS (
        SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t
        FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i WHERE g.i IS NULL GROUP BY w.doc_id),
    removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT x.doc_id, len(ws) AS n_words, coalesce(r.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
    FROM texts x LEFT JOIN kept k ON k.doc_id = x.doc_id LEFT JOIN removed r ON r.doc_id = x.doc_id
    """,
)
def recompression_query(t):
    kept = remove_repeats(t.documents)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op4_line_runs",
    """
    WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
    lines AS (
        SELECT doc_id, pos, parts[pos] AS line
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos FROM split)
        WHERE regexp_matches(parts[pos], '[^\\x20\\x09-\\x0D]')),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS idx FROM lines),
    runs AS (
        SELECT doc_id, idx, [line, lead(line, 1) OVER w, lead(line, 2) OVER w] AS run, lead(idx, 2) OVER w AS last
        FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
    heads AS (SELECT run, min({'d': doc_id, 'i': idx}) AS head FROM runs WHERE last IS NOT NULL GROUP BY run),
    later AS (
        SELECT r.doc_id, r.idx FROM runs r JOIN heads h ON r.run = h.run
        WHERE last IS NOT NULL AND (r.doc_id <> h.head.d OR r.idx <> h.head.i)),
    gone AS (
        SELECT DISTINCT n.doc_id, n.pos
        FROM (SELECT doc_id, unnest(range(idx, idx + 3)) AS idx FROM later) l
        JOIN numbered n ON n.doc_id = l.doc_id AND n.idx = l.idx),
    left_over AS (
        SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.pos) AS kept
        FROM (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line FROM split) a
        LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.pos = a.pos
        WHERE g.pos IS NULL GROUP BY a.doc_id)
    SELECT s.doc_id,
        (SELECT count(*) FROM lines l WHERE l.doc_id = s.doc_id) AS n_lines,
        (SELECT count(*) FROM gone g WHERE g.doc_id = s.doc_id) AS n_removed,
        CASE WHEN s.text IS NULL THEN NULL ELSE md5(coalesce(k.kept, '')) END AS kept_md5
    FROM split s LEFT JOIN left_over k ON k.doc_id = s.doc_id
    """,
)
def line_runs(t):
    kept = drop_repeated_runs(t.documents.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


@query("op2_main_text")
def main_text_query(t):
    return main_text(t.pages).select("page_id", "url", "text", "n_chars")


@query("op13_token_files")
def token_files_query(t):
    return token_output(t.documents.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), end=2)


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
            CAST(list_dot_product(a.q, o.q) AS BIGINT) AS score
        FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM scored WHERE same)
        WHERE n <= 5),
    fitting AS (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
        WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM fitting WHERE rank <= 5
    """,
)
def hard_negatives_query(t):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = t.embeddings.select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


_PHRASES = " UNION ALL ".join(f"SELECT lang, ws[i:i + {k - 1}] AS p, count(*) AS f FROM starts WHERE i + {k - 1} <= len(ws) GROUP BY ALL" for k in range(1, 6))


@query(
    "op12_collocations",
    f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
    starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
    phrases AS ({_PHRASES}),
    totals AS (SELECT lang, sum(f) AS n FROM phrases WHERE len(p) = 1 GROUP BY lang),
    common AS (SELECT * FROM phrases WHERE f >= 100),
    around AS (
        SELECT lang, p, max(f) AS most FROM (
            SELECT lang, p[1:len(p) - 1] AS p, f FROM common WHERE len(p) > 2
            UNION ALL SELECT lang, p[2:len(p)], f FROM common WHERE len(p) > 2) GROUP BY ALL),
    kept AS (
        SELECT c.* FROM common c LEFT JOIN around x ON x.lang = c.lang AND x.p = c.p
        WHERE len(c.p) > 1 AND (x.most IS NULL OR x.most < c.f)),
    cuts AS (SELECT *, unnest(range(1, len(p))) AS k FROM kept),
    scored AS (
        SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, t.n, c.k,
            (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
        FROM cuts c JOIN totals t ON t.lang = c.lang
            JOIN common x ON x.lang = c.lang AND x.p = c.p[1:c.k]
            JOIN common y ON y.lang = c.lang AND y.p = c.p[c.k + 1:len(c.p)]),
    least AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scored),
    best AS (
        SELECT *, array_to_string(p, ' ') AS phrase,
            row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
        FROM least WHERE place = 1)
    SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
        CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM best WHERE rank <= 2000
    """,
)
def collocations_query(t):
    return collocations(t.documents.select("lang", "text"))
