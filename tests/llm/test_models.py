"""Toxicity and HTML extraction: held-out accuracy, planted cases, and their defined cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.llm import toxicity
from starfold.llm.html_extract import extract, main_text, parse

SYLLABLES = "ba be bi bo bu da de di do du ga ge gi go la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to".split()
INSULTS = ["stupid", "idiot", "moron", "pathetic"]


def corpus(n, seed, insult=lambda draw: draw.choice(INSULTS)):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        w = ["".join(draw.choices(SYLLABLES, k=draw.randrange(1, 5))) for _ in range(draw.randrange(5, 120))]
        toxic = int(draw.random() < 0.2)
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                w.insert(draw.randrange(len(w) + 1), insult(draw))
        out.append((i, " ".join(w).replace(" ba", ". Ba"), toxic))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.createDataFrame(corpus(600, 1), "doc_id long, text string, toxic int"))


def scores(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [(r["score"], r["predicted"]) for r in toxicity.score(docs, model).orderBy("doc_id").collect()]


def test_held_out_accuracy(spark, model):
    rows = corpus(300, 2)
    got = scores(spark, model, [t for _, t, _ in rows])
    assert np.mean([p == y for (_, p), (_, _, y) in zip(got, rows, strict=True)]) >= 0.98
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got)


def test_gaps_and_inserted_characters(spark, model):
    clean = "lomiba dego sirate " * 10
    changed = ["stu.pid", "stuupid", "s t u p i d", "Idiots!", "pathe-tic", "STUPID"]
    base = scores(spark, model, [clean])[0][0]
    got = scores(spark, model, [f"{clean} {x} {clean}" for x in changed])
    assert all(s > base for s, _ in got)
    assert sum(p for _, p in got) >= 4


def test_defined_cases_of_scores(spark, model):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, " . ", 7), (3, " . ", 7), (None, "you idiot " + "x" * 100_000, 8)], "doc_id long, text string, score int").withColumns({"margin": F.lit(1), "own": F.lit(2)})
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["own"] == 2 for r in rows)
    assert {r["doc_id"]: r["predicted"] for r in rows} == {1: 0, 2: 0, 3: 0, None: 1}
    assert toxicity.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1], [0, 1], [None, None]])
def test_too_few_labels(spark, labels):
    few = spark.createDataFrame([(i, "some words here", y) for i, y in enumerate(labels)], "doc_id long, text string, toxic int")
    got = scores(spark, toxicity.fit(few), ["a", None])
    assert len({s for s, _ in got}) == 1


def test_features_are_those_of_the_kernel():
    """The explicit features against the sum over all pairs of subsequences."""
    def plain(a, b):
        def parts(w):
            w = f"^{w}^"
            return [(w[i] + w[i + p] + w[i + q], toxicity.LAMBDA ** (q + 1)) for i in range(len(w)) for p, q in toxicity.OFFSETS if i + q < len(w)]
        x, y = parts(a), parts(b)
        return sum(u * v for s, u in x for t, v in y if s == t) / (sum(u * u for _, u in x) * sum(v * v for _, v in y)) ** 0.5

    words = ["idiot", "id-iot", "a", "banana", "stupid"]
    got = toxicity.kernel(words, words)
    assert np.allclose(got, [[plain(a, b) for b in words] for a in words], atol=1e-5)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p><p>no</p>";</script></head><body>
<header class="site-header">Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="promo-box">{ad}</div>
<article><header><h1>Title {n}</h1></header><p>First  &amp; &lt;b&gt;<b>bold</b>
 line {n}.<p>Second &eacute;&#233;&#x41; line {n}<br>after</p><aside>Side</aside><form><input value="q">Search</form>
<ul><li>One<li>Two {n}</ul><!-- no <p>comment</p> --><div class="ad">Buy</div></article>
<section class="comments"><p>Reader {n}</p></section><footer>&copy; Host</footer></body></html>"""
WANT = "Title {n}\nFirst & <b>bold line {n}.\nSecond ééA line {n} after\nOne\nTwo {n}"


def test_main_text_of_a_page():
    assert main_text(PAGE.format(n=1, ad="x"), False, frozenset(), frozenset()) == WANT.format(n=1)


@pytest.mark.parametrize(("source", "text"), [
    ("", ""), ("plain & simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<p>a</p", "a"), ("<div><p>x</div>y", "x\ny"), ("a < b and c > d", "a < b and c > d"),
    ("<p class='a>b'>x</p>", "x"), ("<script>var a = '<p>';", ""), ("<!-- open <p>x", ""), ("&am &amp &#0; &bogus;", "&am & � &bogus;"), ("<nav>n</nav><p>t</p><footer>f", "t"),
    ("<p>a  b\t\nc</p>", "a b c"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<textarea><p>no</textarea><p>yes", "yes"), ("</p></div>x", "x"), ("<p>a<span class=ad>buy</span>b</p>", "a\nb"),
])
def test_broken_markup(source, text):
    assert main_text(source, False, frozenset(), frozenset()) == text


def test_deep_nesting_and_long_pages():
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000, False, frozenset(), frozenset()) == "x"
    page = parse("<p>" + "word " * 200_000)
    assert len(page.blocks[0][3]) == 999_999


def test_extract_learns_what_repeats(spark):
    """Hosts without a main element: what repeats from page to page isn't the article."""
    plain = "<html><body><div class='x'>Our motto {k}</div><div class='y'><p>Text {n} of this page, one of many.</p></div><div class='z'>Made by us</div></body></html>"
    rows = [(i, f"https://Plain.example/{i}", plain.format(n=i, k=i % 3)) for i in range(40)]
    rows += [(100 + i, f"http://blog.example.org/p?{i}", PAGE.format(n=i, ad=i % 2)) for i in range(30)]
    rows += [(200, None, "<p>alone</p>"), (201, "not a url", None), (202, "", ""), (200, None, "<p>alone</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "path": F.lit("p"), "host": F.lit("h")})
    got = extract(pages).collect()
    assert len(got) == len(rows)
    want = {i: f"Text {i} of this page, one of many." for i in range(40)} | {100 + i: WANT.format(n=i) for i in range(30)} | {200: "alone", 201: "", 202: ""}
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) and (r["path"], r["host"]) == ("p", "h") for r in got)
    assert extract(pages.limit(0)).collect() == []


def test_extract_gives_the_documents_back(spark):
    """Pages of the table hold documents; the lines of each come back, after a title."""
    import re

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in extract(spark.read.parquet(f"{folder}/pages.parquet")).collect():
        text = docs.get(int(re.search(r"/(\d+)", r["url"][9:])[1]))
        if text is not None:
            assert r["text"].split("\n")[1:] == [x for x in (" ".join(line.split()) for line in text.split("\n")) if x]


def test_a_host_with_two_layouts(spark):
    """Pages without a main element keep their text on a host whose template has one."""
    other = "<html><body><div class='content'><p>Words {n} of the other layout.</p></div></body></html>"
    rows = [(i, f"http://two.example/{i}", PAGE.format(n=i, ad="x") if i < 18 else other.format(n=i)) for i in range(30)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: WANT.format(n=i) if i < 18 else f"Words {i} of the other layout." for i in range(30)}


@pytest.mark.parametrize("source", [
    "<body class='single has-sidebar'><article>{}</article></body>", "<article class='post comments-open'>{}</article>", "<div id='main' class='with-sidebar'>{}</div>", "<html class='no-cookie'><body><main>{}</main>",
    "<html class='cookie'><body class='sidebar nav'><p>{}</p>", "<div class='sidebar'><article>{}</article></div>", "<section class='header'><main>{}</main></section>", "<article class='widget'>{}</article>",
    "<form id='page'><main>{}</main></form>", "<div class='header-image'>{}</div>", "<p class='adaptive non-ad'>{}</p>",
    "<body class='has-sidebar'><article>{}<div class='site-footer'>no</div><article class='comment'>no</article></article><div class='related'><article>no, though it is much longer than the article</article></div>",
    "<p>{}</p><div class='widget-12'><article>no</article></div><div class='cookie-banner'>no</div><div class='main-menu'>no</div><aside class='x'><article>no, though it is much longer than the article</article></aside>",
])
def test_names_that_set_nothing_apart(source):
    assert main_text(source.format("The text itself."), False, frozenset(), frozenset()) == "The text itself."


def test_copied_pages_are_no_template(spark):
    """Articles that are copied to many pages of a host without main elements stay, and what repeats on different pages goes."""
    plain = "<html><body><div>Seen {k} times</div><p>Article {n} begins, as long as an article is.</p><p>And article {n} ends, some way on.</p><footer>f</footer><div class='z'>Made by us</div></body></html>"
    groups = [0] * 60 + [n for n in range(1, 11) for _ in range(4)] + list(range(11, 41))
    rows = [(i, f"http://copies.example/{i}", plain.format(n=n, k=i % 5)) for i, n in enumerate(groups)]
    rows += [(1000 + i, f"http://one.example/{i}", plain.format(n=7, k=i)) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Article {n} begins, as long as an article is.\nAnd article {n} ends, some way on."
    assert {i: got[i] for i in range(len(groups))} == {i: want.format(n=n) for i, n in enumerate(groups)}
    assert all(want.format(n=7) in got[1000 + i] for i in range(40))


def test_the_template_chooses_inside_the_main_element(spark):
    """Repeated slots of the template go below a main element too; items that some pages have, and repeated lines of texts, stay."""
    page = "<body><article><div class='meta'>By our staff {k}</div><h1>Title {n}</h1><p>Text {n} of this page, one of many.</p><p>All rights reserved.</p><p>More {n}.</p>{box}<div class='cta'><p>Read our guide</p></div></article></body>"
    rows = [(i, f"http://inner.example/{i}", page.format(n=i, k=i % 3, box="<pre>make install</pre>" if i % 4 == 0 else "")) for i in range(40)]
    rows += [(100 + i, f"http://few.example/{i}", page.format(n=i, k=i % 3, box="")) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    own = "Title {n}\nText {n} of this page, one of many.\nAll rights reserved.\nMore {n}."
    assert {i: got[i] for i in range(40)} == {i: own.format(n=i) + ("\nmake install" if i % 4 == 0 else "") for i in range(40)}
    assert all(got[100 + i] == f"By our staff {i % 3}\n{own.format(n=i)}\nRead our guide" for i in range(3))
