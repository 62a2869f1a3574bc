"""Row-wise operators: quality, tokens, toxicity, urls, html."""

import random
import re
import time
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from headway.llm import html as pages
from headway.llm.quality import line_fault, quality
from headway.llm.tokens import Encoder, token_counts
from headway.llm.toxicity import fit, held_out, learn, score_texts, sentence_words, toxicity
from headway.llm.urls import UrlRule, judge, rule_table
from tests.llm.cases import SCHEMA, WORD, collected, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def base_figures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_base_equals_plain_count(spark):
    rows = documents() + [(100 + i, t, 0, "", "", 0, None) for i, t in enumerate(prose(200, 1, 90, 3))]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality(docs).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        want = base_figures(r["text"])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert quality(docs.limit(0)).count() == 0


def test_line_rules_and_lost_text(spark):
    assert line_fault("Home | About | Contact") == "navigation"
    assert line_fault("Login") == "navigation"
    assert line_fault("Licensed under the Apache License, Version 2.0.") == "boilerplate"
    assert line_fault("buy*** now### here$$$") == "punctuation"
    assert line_fault("A plain sentence, with an end.") is None
    good = " ".join(f"word{i}" for i in range(30)) + "."
    bad = "\n".join(f"Home | About | P{i}" for i in range(30))
    docs = spark.createDataFrame([(1, good), (2, f"{good}\n{bad}"), (3, f"{good}\nHome | About | Contact")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert (got[1]["kept"], got[2]["kept"], got[3]["kept"]) == (True, False, True)
    assert got[2]["fault"] == "lost" and got[3]["clean_text"] == good


def test_encoders_agree():
    both = Encoder(PATH)
    assert both.fast is not None
    rng = random.Random(2)
    letters = [chr(c) for c in range(0x250)]
    shapes = ["%s", " %s ", "1%s2", "%s%s", ". %s'", "\n%s  x"]
    texts = [s.replace("%s", c) for c in letters for s in shapes]
    letters += [" ", "\n", "'s", "<|endoftext|>", "漢", "😀", "\u2003"] * 40
    texts += ["".join(rng.choices(letters, k=rng.randrange(90))) for _ in range(800)]
    texts += ["", " " * 499 + "a", "\n" * 2000, "a" * 6000, ". " * 900]
    for t in texts:
        assert both.ids(t) == both.library.encode(t, add_special_tokens=False).ids


def test_counts_cached_and_whole(spark, tmp_path):
    docs = spark.createDataFrame(documents(), SCHEMA)
    library = Encoder(PATH).library
    cache = str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts(docs, PATH, cache=cache).collect()
        assert len(got) == len(documents())
        for r in got:
            assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t, *_ in documents()})
    assert token_counts(docs.limit(0), PATH).count() == 0


def test_toxicity_holds_out_and_finds_sentences(spark):
    rng = random.Random(3)
    calm = ["river", "stone", "green", "walks", "under", "paper", "light", "seven", "house", "small"]
    rude = ["blockhead", "nitwit"]
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(rng.choices(calm, k=6)) for _ in range(rng.randrange(1, 8))]
        bad = i % 5 == 0
        if bad:
            sentences[rng.randrange(len(sentences))] += " " + rng.choice(rude)
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs, truth).collect()}
    for i, y in labels:
        assert got[i]["predicted"] == y, (i, got[i]["score"])
    one = next(i for i, y in labels if y)
    spans = got[one]["offending"]
    assert any(w in rows[one][1][s["start"] : s["end"]] for s in spans for w in rude)
    usable = {r["doc_id"] for r in docs.where(~held_out()).collect()}
    model = learn(docs, truth.where(F.col("doc_id").isin([1, 2])), ~held_out())
    assert 0 < len(usable) < 900 and score_texts(docs, model).where("predicted = 1").count() == 0


def test_toxicity_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity(docs, none)
    assert got.where("score IS NULL OR score < 0 OR score > 1 OR held_out IS NULL").count() == 0
    assert got.count() == len(documents())
    assert toxicity(docs.limit(0), none).count() == 0
    assert list(sentence_words("")) == [] and fit([], []).bias < -10


def test_held_out_accuracy_on_driver_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.collect()}
    assert n.get((0, 1), 0) <= 2 and n.get((1, 1), 0) >= 0.7 * (n.get((1, 1), 0) + n.get((1, 0), 0))


RULES = [
    UrlRule("allow", "host_path", "org/"),
    UrlRule("block", "host_path", "example.org/es/"),
    UrlRule("block", "host_path", "example.org/en/1"),
    UrlRule("block", "pattern", r"(?i)[./]casino-[a-z]+[.]", ("casino",)),
]


def test_urls(spark):
    urls = [
        (1, "https://A.Example.ORG/es/2?x=/en/1", "a.example.org", "/es/2", "example.org/es/", "block"),
        (2, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "http://example.org#/es/", "example.org", "", None, "allow"),
        (4, "http://x.org/", "x.org", "/", "org/", "allow"),
        (5, "http://www.casino-royal.com/a", "www.casino-royal.com", "/a", None, "block"),
        (6, "http://casino.com/a", "casino.com", "/a", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "", "", "", None, "allow"),
        (10, "a://b://c/d", "b:", "//c/d", None, "allow"),
        (11, "http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        (12, "http://example.org/ES/1", "example.org", "/ES/1", "org/", "allow"),
    ]
    frame = spark.createDataFrame([(i, u, "own", "own") for i, u, *_ in urls], "page_id long, url string, rule string, other string")
    got = [tuple(r) for r in judge(frame, rule_table(spark, RULES)).select("page_id", "url", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted(urls, key=str)
    assert judge(frame.limit(0), rule_table(spark, RULES)).count() == 0
    with pytest.raises(ValueError):
        rule_table(spark, [UrlRule("block", "pattern", ".*")])


HTML = [
    (
        "<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav>a</nav><main><article><h1>Title</h1><p>One &amp; two<br>three</p>"
        "<aside>x</aside><div class='share-bar'>s</div><form>f<input></form><section class=comments><article class=comment><p>c</p></article></section>"
        "<p>End&nbsp;x</p></article></main><footer>f</footer></body></html>",
        "Title\nOne & two three\nEnd x",
    ),
    ("<body><div id=menu>m</div><div class=content><p>Long text here, yes.</p><div>inner<p>more</p></div></div><div class=footer>f</div>", "Long text here, yes.\ninner\nmore"),
    ("<article><p>a<p>b<ul><li>c<li>d</ul>e</article>", "a\nb\nc\nd\ne"),
    ("<article>x < y and a<b>c</b>d <!-- hi --> &lt;p&gt; <script>if(a<b){}</script>z</article>", "x < y and acd <p> z"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ("<article><p>q<script>unclosed", "q"),
    ("<p title='a>b'>t</p>", "t"),
    ("plain", "plain"),
    ("", ""),
    (None, ""),
    ("<nav>only a menu</nav>", ""),
    ("<div hidden><p>no</p></div><main><p>yes</p></main>", "yes"),
    ("<div class='page has-sidebar'><article><p>yes</p><div class='cookie-notice'>no</div></article><div id='sidebar'>no</div></div>", "yes"),
    ("<article><p>yes</p></article><section id='comments'><article><p>no</p></article></section>", "yes"),
]


def test_pages_by_structure(spark):
    rows = [(i, f"http://h{i}.example.com/", h, "own") for i, (h, _) in enumerate(HTML)]
    rows.append((99, None, "<article>x</article>", "own"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in pages.main_text(frame).collect()}
    for i, (_, want) in enumerate(HTML):
        assert got[i]["text"] == want
        assert got[i]["n_chars"] == len(want)
    assert got[99]["text"] == "x"
    assert pages.main_text(frame.limit(0)).count() == 0


def test_pages_by_template(spark):
    """No element or class name says what is what: only the deduced template does."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]

    def page(i):
        body = "".join(f"<p>{' '.join(rng.choices(words, k=12))}.</p>" for _ in range(rng.randrange(2, 6)))
        want = "\n".join(re.findall("<p>(.*?)</p>", body))
        shell = f"<div class=a><span>Our site, since 1999</span><div>Motto of it</div></div><div class=b>{body}<div>Written by us all</div></div><div class=c>The end of it, number {i}</div>"
        return f"<html><body>{shell}</body></html>", want

    made = [page(i) for i in range(12)]
    frame = spark.createDataFrame([(i, f"http://one.example.com/{i}", h) for i, (h, _) in enumerate(made)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.main_text(frame).collect()}
    for i, (_, want) in enumerate(made):
        assert got[i] == want


def test_template_decides_inside_and_beside_articles(spark):
    """Repeated texts in articles go, a body beside a teaser stays, copied articles stay whole."""
    rng = random.Random(6)

    def prose_of(n):
        return [" ".join(f"w{rng.randrange(900)}" for _ in range(15)) + "." for _ in range(n)]

    def page(paragraphs, tail=""):
        body = "".join(f"<p>{x}</p>" for x in paragraphs)
        return f"<html><body><article><div>Told by our own staff</div>{body}<p>Pass this story on to friends.</p></article>{tail}</body></html>"

    made = [(page(x), "\n".join(x)) for x in (prose_of(rng.randrange(2, 5)) for _ in range(9))]
    story = prose_of(30)
    made.append((page(["One more story."], "<div class=x>" + "".join(f"<p>{x}</p>" for x in story) + "</div>"), None))
    copied = page(prose_of(3))
    rows = [(i, f"http://one.example.com/{i}", h) for i, (h, _) in enumerate(made)] + [(100 + i, f"http://two.example.com/{i}", copied) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (_, want) in enumerate(made[:-1]):
        assert got[i] == want
    assert "\n".join(story) in got[len(made) - 1]
    assert all(got[100 + i] == "\n".join(re.findall("(?:<p>|<div>)(.*?)<", copied)) for i in range(4))


@pytest.mark.parametrize(
    ("row", "between"),
    [("<section><p>{}</p></section>", ""), ("<div><div><p>{}</p></div></div>", ""), ("<div class=d{n}><p>{}</p></div>", "<h2>{}</h2>")],
)
def test_articles_spread_over_siblings_stay_whole(spark, row, between):
    rng = random.Random(7)

    def page(i):
        want, body = [], ""
        for n in range(3):
            for shape in (between, row):
                if shape:
                    want.append(" ".join(f"w{rng.randrange(900)}" for _ in range(14 + 4 * n)) + ".")
                    body += shape.format(want[-1], n=n)
        return f"<html><body><div class=a>Our site</div><div class=b>{body}</div><div class=c>Page {i}</div></body></html>", "\n".join(want)

    made = [page(i) for i in range(10)]
    rows = [(i, f"http://one.example.com/{i}", h) for i, (h, _) in enumerate(made)] + [(99, "http://alone.example.com/", made[0][0].replace("Our site", ""))]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (_, want) in enumerate(made):
        assert got[i] == want
    assert got[99] == made[0][1]


def test_nested_classes():
    outer, inner, crossing = [(0, 1), (10, 2)], [(3, 3), (5, 4)], [(4, 5), (12, 6)]
    assert pages.nest([outer, inner, crossing]) == [1, 2, 3, 4]
    assert pages.nest([]) == []


def test_rows_stay_in_place(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    assert collected(quality(docs).select("doc_id", "text"), "doc_id", "text") == collected(docs.select("doc_id", "text"), "doc_id", "text")


def text_of(markup):
    return "\n".join(pages.main_blocks(pages.parse(markup), frozenset()))


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ('<article class="post has-comments"><p>One text</p></article>', "One text"),
        ('<div class="comments-open"><article><p>A</p></article></div>', "A"),
        ('<div id="comments"><article><p>Only</p></article></div>', "Only"),
        ('<article><p id="related-work">R</p><div class="social-history"><p>S</p></div></article>', "R\nS"),
        ('<article><p>B</p></article><section id="comments"><article class="comment"><p>Nice</p></article></section>', "B"),
        ('<article><p>B</p><div class="comment-list"><p>c</p></div><div class="related-posts">r</div></article>', "B"),
        ("<article><p>One<button>Buy</button> two</p></article>", "One two"),
        ('<article><p>One <span class="ad">Buy now</span> two</p></article>', "One two"),
        ("<article><p>x<span hidden>y</span>z</p></article>", "xz"),
        ('<article><p>x <span class="adverb">y</span></p></article>', "x y"),
        ("<article><header><h1>T</h1></header><p>B</p></article>", "B"),
    ],
)
def test_names_and_inline_elements(markup, want):
    assert text_of(markup) == want


def test_deep_nesting_is_read_in_linear_time():
    """100,000 unclosed tags: elements below the deepest level become siblings, and no text is lost."""
    start = time.perf_counter()
    page = pages.parse("<div>" * 100_000)
    assert time.perf_counter() - start < 5 and len(page.tokens) == 100_000
    assert text_of("<article>" + "<div>x" * 20_000) == "\n".join("x" * 20_000)
    assert text_of("<article>" + "<div>" * 2000 + "<nav>no</nav><p>yes</p>" + "<span>" * 900 + "in" + "</span>" * 900 + "</div>" * 2000 + "<p>end</p>") == "yes\nin\nend"
    long = "word " * 400_000
    assert text_of(f"<article><p>{long}</p></article>") == long.strip()
