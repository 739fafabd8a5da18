"""The trained operators: language ID, URL filter, page text."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import language, page_text, url_filter
from refinery.llm.common import ship
from refinery.llm.queries import URL_RULES

from .helpers import SF, docs, table


# ---- language ID ----------------------------------------------------------------

@pytest.fixture(scope="module")
def sf_docs(spark):
    ship(spark)
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(sf_docs):
    found = {r.doc_id: r for r in language.predict(sf_docs).collect()}
    truth = {r.doc_id: r.lang for r in sf_docs.select("doc_id", "lang").collect()}
    assert found.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "fr", "de", "es"} for r in found.values())
    held = [d for d, r in found.items() if r.held_out]
    assert len(held) > 100
    assert sum(found[d].lang_pred == truth[d] for d in held) / len(held) > 0.98


def test_labels_of_held_out_rows_are_not_learned(spark, sf_docs):
    """Another label, or none, on the held-out rows changes no prediction; source and id are no input."""
    some = sf_docs.limit(200)
    moved = some.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert table(language.predict(some)) == table(language.predict(moved))


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog went to the house", "en") for i in range(40)]
    rows += [(100 + i, "le chat et le chien sont dans la maison", "fr") for i in range(40)]
    odd = [(900, None, "en"), (901, "", "fr"), (902, "123 !! ..", None), (903, "the dog", None), (None, "le chien", "en"),
           (0, "the cat and the dog went to the house", "en"), (904, "le chien " * 20_000, None)]
    found = table(language.predict(docs(spark, rows + odd, extra=True)))
    assert len(found) == len(rows) + len(odd)
    by = {r[0]: r for r in found}
    assert [by[i][2:] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by[903][2] == "en" and by[904][2] == "fr" and by[None][2] == "fr" and by[None][1] is False
    kept = language.accepted(docs(spark, rows + odd))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows + odd} - {900, 901, 902}


def test_nothing_to_learn_from(spark):
    assert language.predict(docs(spark, [])).count() == 0
    found = table(language.predict(docs(spark, [(1, "some text", None), (2, "more", None)])))
    assert [r[2:] for r in found] == [("und", 0.0)] * 2


def test_a_hot_id_sends_one_row(spark):
    """Copies of a row with a small hash fill no sample, however many; different texts of an id are rows of their own."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("abcdefgh"[k] * 3 for k in rng.integers(0, 8, 12)), "en" if i % 2 else "fr") for i in range(60)]
    df = docs(spark, rows)
    plain = language.train(df)
    many = language.train(df.unionByName(df.filter("doc_id = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n")))
    assert many.languages == plain.languages
    seen = []
    follow = language.follow_leader
    language.follow_leader = lambda learn, *a: seen.append(len(learn)) or follow(learn, *a)
    try:
        language.train(df.withColumn("doc_id", F.lit(3)))
        language.train(df.unionByName(df))
    finally:
        language.follow_leader = follow
    assert max(seen) <= 60


def test_too_many_languages_fail_loudly(spark):
    df = docs(spark, [(i, "a b", f"l{i}") for i in range(30)])
    with pytest.raises(ValueError, match="more than 5 languages"):
        language.train(df, max_languages=5)


def test_leader_as_written_out():
    """FTRL with elastic net, coordinate by coordinate in plain Python."""
    from math import exp, sqrt

    rng = random.Random(5)
    rows = [(rng.randrange(3), np.array(sorted(rng.sample(range(20), 4))), np.array([rng.random() for _ in range(4)])) for _ in range(40)]
    z, n = [[[0.0] * 3 for _ in range(language.DIM + 1 if i < 0 else 21)] for i in range(2)]

    def weight(i, k):
        if abs(z[i][k]) <= language.L1:
            return 0.0
        sign = 1 if z[i][k] > 0 else -1
        return -(z[i][k] - sign * language.L1) / ((language.BETA + sqrt(n[i][k])) / language.ALPHA + language.L2)

    for _ in range(language.EPOCHS):
        for label, at, x in rows:
            terms = [(int(i), float(v)) for i, v in zip(at, x)] + [(20, 1.0)]
            w = {(i, k): weight(i, k) for i, _ in terms for k in range(3)}
            e = [exp(sum(v * w[i, k] for i, v in terms)) for k in range(3)]
            for k in range(3):
                for i, v in terms:
                    g = v * (e[k] / sum(e) - (k == label))
                    step = (sqrt(n[i][k] + g * g) - sqrt(n[i][k])) / language.ALPHA
                    z[i][k] += g - step * w[i, k]
                    n[i][k] += g * g
    weights, bias = language.follow_leader(rows, 3)
    assert np.allclose(weights[:20], [[weight(i, k) for k in range(3)] for i in range(20)])
    assert np.allclose(bias, [weight(20, k) for k in range(3)])
    assert not weights[20:].any()


def test_document_frequencies_count_all_rows(spark):
    rows = [(i, f"w{i} the") for i in range(700)]
    df, n = language.document_frequencies(docs(spark, rows).select("text").repartition(5))
    own = np.zeros(language.DIM, np.int64)
    for _, text in rows:
        own[np.unique(language.features(text))] += 1
    assert n == 700 and (df == own).all()


def test_l1_makes_weights_sparse():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        at = np.unique(rng.integers(10, 2000, 20))
        rows.append((i % 2, np.append(at, i % 2), np.append(np.full(len(at), 0.1), 1.0)))
    weights, _ = language.follow_leader(rows, 2)
    assert weights[0, 0] > 0 > weights[0, 1] and weights[1, 1] > 0 > weights[1, 0]
    assert (weights == 0).mean() > 0.9


def test_temperature_of_overconfident_scores():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(4000, 3))
    p = language.softmax(z)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert abs(language.fit_temperature(z * 5, labels) - 5) < 0.6


# ---- URL filter --------------------------------------------------------------------

def by_hand(url):
    """(host, path, rule, verdict) by plain string work."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


ODD_URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y#z", "http://example.org?q=/es/", "http://x.org",
            "http://x.org/", "http://notexample.org/es/", "https://example.org/en/1", "https://example.org/en/21",
            "https://a.b.com/fr/a/b", "http://com/de/", "ftp://É.com/de/x\ny", "http://a.com#/fr/", "x://y://z.org/", "http://x.org/é?" + "a" * 5000]


def test_rules_as_by_hand(spark):
    ship(spark)
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(1000 + i, u) for i, u in enumerate(ODD_URLS)] + [(None, "http://x.net/"), (1, "http://x.net/")],
                                "page_id long, url string")
    both = pages.union(odd).withColumn("host", F.lit("clash")).withColumn("suffix", F.lit("clash"))
    rows = both.select("page_id", "url").collect()
    found = url_filter.judge(both, URL_RULES).collect()
    assert len(found) == len(rows)
    expected = sorted([(r.page_id, *by_hand(r.url)[:3]) for r in rows], key=repr)
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in found], key=repr) == expected
    verdicts = {r[0]: r[1] for r in URL_RULES}
    assert all(r.verdict == (verdicts[r.rule] if r.rule else "block" if r.p_block > 0.5 else "allow") for r in found)


def test_trees_learn_held_out_urls(spark):
    """Labels that follow the URL's form are found on URLs not trained on."""
    ship(spark)
    rng = random.Random(1)

    def url(bad):
        word = "".join(rng.choice("abcdefghij") for _ in range(6))
        tail = "/".join(str(rng.randrange(10 ** 8)) for _ in range(3)) + "?a=1&b=2&c=3" if bad else word
        return f"http://{word}.example.{rng.choice(['net', 'com'])}/{tail}"

    rows = [(u, url_filter_label) for url_filter_label in ("allow", "block") for u in {url(url_filter_label == "block") for _ in range(150)}]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "url string, verdict string")
    df = df.withColumn("host", url_filter.host()).withColumn("path", url_filter.path())
    held = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    model = url_filter.train(df.filter(~held))
    scored = model.scored(url_filter.lexical(df.filter(held))).collect()
    assert len(scored) > 50
    assert np.mean([(r.p_block > 0.5) == (r.verdict == "block") for r in scored]) > 0.95


def test_copies_of_a_url_change_no_verdict(spark):
    """A URL that holds most rows neither fills the sample nor moves a suffix's rate."""
    rng = random.Random(4)
    urls = [f"https://a{rng.randrange(50)}.{'shop.com/de' if rng.random() < .5 else 'blog.com/fr'}/p{rng.randrange(10 ** 6)}" for _ in range(400)]
    urls += [f"http://x{rng.randrange(50)}.{rng.choice(['shop', 'blog', 'other'])}.net/p{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    hot = df.unionByName(df.filter("page_id in (3, 4, 5)").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1500)))).drop("n"))
    rules = [("shop.com/de/", "block"), ("blog.com/fr/", "allow")]
    plain, copied = (url_filter.judge(x, rules).distinct().collect() for x in (df, hot))
    assert sorted(map(tuple, plain)) == sorted(map(tuple, copied))
    assert len({r.p_block for r in plain}) > 1


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://x.net/"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(df, URL_RULES).collect()] == ["allow", "allow"]
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://x.com/de/"), (2, "http://x.net/")], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(one, URL_RULES).collect()} == {"block"}


def test_entropy(spark):
    df = spark.createDataFrame([("abab",), ("",), (None,), ("aaaa",), ("é日é日",)], "url string")
    found = [r[0] for r in df.select(url_filter._entropy(F.coalesce("url", F.lit("")))).collect()]
    assert found == pytest.approx([1.0, 0.0, 0.0, 0.0, 1.0])


def test_native_plan(spark):
    """No Python on the main path."""
    df = spark.read.parquet(f"{SF}/pages.parquet")
    plan = url_filter.judge(df, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- page text -------------------------------------------------------------------------

PAGES = {
    # The words stand outside the article's element too.
    """<html><body><header><h1>Site</h1><nav><a href=x>Home</a></nav></header><div id="content"><h2>Title</h2>
    <p>Some long text here,   with words &amp; things.</p><div class="comments"><p>First! A comment by a reader that is
    rather long.</p></div><aside>Side</aside><form><input name=q><button>Go</button></form><p>More text.</p></div>
    <div class="sidebar"><p>Other stories to read</p></div><footer>(c)</footer></body></html>""":
        "Title\nSome long text here, with words & things.\nMore text.",
    """<article><h1>A</h1><div class="cookie-notice">We use cookies</div><p>Text one<script>x("<p>")</script> goes
    on.<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><section id=comments><p>reader says</p></section></article>""":
        "A\nText one goes on.\none\ntwo\nc1\nc2",
    "<p>Just a plain page with a paragraph of text and no more structure at all, long enough.</p>":
        "Just a plain page with a paragraph of text and no more structure at all, long enough.",
    "<article><p>a<b>b</b>c<br>d &lt;x&gt; &#233;&nbsp;f</p><!-- no <p>no</p> --><p> </p><p>g</article>": "abc d <x> é f\ng",
    "<main><style>p{}</style><p title='a>b'>one</p><textarea>no</textarea>two</main>": "one\ntwo",
    # Names that say what an element has, or whose head is something else, drop nothing.
    """<article class="post has-sidebar no-comments"><h1>Title</h1><div class="related-work"><p>Others did this.</p></div>
    <div class="share-price">12 EUR</div><section class=comments><p>Nice!</p></section><div class="related-posts">
    <a href=/x>More</a></div><div class="ad-slot">Buy</div><p>&am<b>p;</b> &amp;amp;</p></article>""":
        "Title\nOthers did this.\n12 EUR\n&amp; &amp;",
    """<body class="single-post sidebar-left"><ul class="main-menu"><li><a href=/>Home</a></ul><div class="entry-content">
    <p>The text of the entry, which is long enough to be one.</p><div id="comment-list"><p>I was here first, ha.</p></div>
    </div><div class="widget-area">Weather</div><div class=newsletter-box>Subscribe</div></body>""":
        "The text of the entry, which is long enough to be one.",
    "": "", "<": "", "<article>": "", "<article><p>x</p></article><p>" : "x",
}


@pytest.fixture(scope="module")
def model(spark):
    ship(spark)
    return page_text.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("html", PAGES)
def test_pages_by_hand(model, html):
    assert page_text.main_text(html, model) == PAGES[html]


def test_articles_of_the_table(spark, model):
    """The given pages name their article: its blocks, by plain cutting, are the text."""
    import html as entities
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in page_text.extract(pages.withColumn("text", F.lit("clash")), model).collect()}
    for r in pages.collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split())
                  for x in re.split("</?(?:p|h1)>", inside)]
        assert found[r.page_id].text == "\n".join(x for x in blocks if x)
        assert found[r.page_id].n_chars == len(found[r.page_id].text) and found[r.page_id].url == r.url


def test_marginals_are_exact(model):
    """Sum-product against the sum over all states of a small tree."""
    from itertools import product

    page = page_text.parse("<div><p>some words here</p><nav><a>x</a></nav><div class=content>and<i>more</i></div></div>")
    text, links = page_text.observed(page)
    n = len(page.tag)
    own = model.text[:, text] * model.links[:, links]
    siblings = np.bincount(page.parent[1:], minlength=n)
    own = own ** (1.0 / np.maximum(siblings[page.parent], 1))
    own[:, 0] = 0.5
    total, one, edge = 0.0, np.zeros(n), page_text.edges_of(page, model)
    for states in product((0, 1), repeat=n):
        w = np.prod([own[s, i] for i, s in enumerate(states)])
        for i in range(1, n):
            w *= edge[i, states[page.parent[i]], states[i]]
        total += w
        one += w * np.array(states)
    assert page_text.marginals(page, model) == pytest.approx(list(one / total))


def test_names_speak_by_their_heads():
    for name, head in {"cookie-notice": "notice", "related-posts": "related", "related-work": "work", "share-price": "price",
                       "shareButtons": "share", "has-sidebar": None, "no-comments": None, "comment-body": "comment",
                       "article-body": "body", "sidebar2": "sidebar", "col-12": "col", "entry__content": "content", "-": None}.items():
        assert page_text.head_word(name) == head, name


def test_weights_of_names_are_learned(spark):
    """Words that no list holds get weights from pages; listed ones can be outvoted by many pages."""
    ship(spark)
    one = ("<body><div class='zorp'>buy this now</div><article><p>some text of the article</p>"
           "<div class='share'>a part that all pages have</div></article></body>")
    pages = spark.createDataFrame([(i, f"u{i}", one) for i in range(300)], "page_id long, url string, html string")
    model = page_text.train(pages)
    assert model.words["zorp"] < -2 and model.words["share"] > 0 and model.words["comments"] < -5
    assert page_text.main_text(one, model) == "some text of the article\na part that all pages have"


def test_odd_pages(spark):
    ship(spark)
    rows = [(1, "u", None), (None, None, "<article><p>x</p></article>"), (2, "u", ""), (2, "u", ""),
            (3, "u", "<p>" * 3000 + "deep"), (4, "u", "<article>" + "<p>long text here</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = table(page_text.extract(df))
    assert len(found) == 6
    assert (4, "u") == [r[:2] for r in found if r[3] > 1000][0] and [r[3] for r in found if r[0] == 4] == [20_000 * 15 - 1]
    assert page_text.extract(df.limit(0)).count() == 0


def test_texts_without_any_evidence_are_rejected(spark):
    """Letters that no training text has say nothing; a few known ones are enough to stay."""
    rows = [(i, "the cat and the dog", "en") for i in range(60)] + [(100 + i, "le chat et le chien", "fr") for i in range(60)]
    odd = [(900, "the", None), (901, "chien", None)]
    kept = {r.doc_id for r in language.accepted(docs(spark, rows + odd)).collect()}
    assert kept == {r[0] for r in rows + odd}
    model = language.Model(["en", "fr"], np.ones(language.DIM), np.zeros((language.DIM, 2)), np.zeros(2))
    assert language.accepted(docs(spark, odd), model).count() == 0
