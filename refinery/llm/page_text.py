"""Main text of pages by a tree-structured graphical model over the DOM.

Each element of a page is a node with two states, content or not.  A node sees
the amount of text below it and the share of that in links; a potential ties
its state to its parent's, by the node's role, which its tag tells, and by what
its class and id call it.  Sum-product messages go up the tree and down again, and
text whose element's content marginal is over one half is kept, a line for
each block.

A name speaks by its head: ``cookie-notice`` is a notice, ``related-posts``
something related, but ``related-work`` is a work, ``share-price`` a price, and
``has-sidebar`` or ``no-comments`` say what an element has.  Each head word has
a weight of its own, learned from the labelled pages; words known to name main
text or other things start with ``NAME_ODDS``.  All of a node's evidence is
bounded, so that tags, names and text can outvote one another.

The potentials are frequencies on labelled pages: those with an ``article`` or
``main`` element, whose labels come from tags alone.  At most ``TRAIN_PAGES``
pages are used, those of smallest hash.

Defined results.  Null or empty html: empty text.  No labelled page: the
smoothing alone, which rests on tags and names.  Unclosed, stray and crossed tags
are mended as browsers do in outline.  Null page_id or url: kept.  Repeated
rows: a row each.  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, slices

TRAIN_PAGES = 1_000
#: Share of the uniform distribution in each frequency.
SMOOTHING = {"text": 0.4, "links": 0.4, "edge": 0.05}
#: P(content) of a node by its role and its parent's state, where no labelled page tells.
PRIOR_EDGE = {"content": (0.9, 0.98), "other": (0.01, 0.01), "plain": (0.1, 0.95), "inline": (0.1, 0.95)}
PRIOR_ROWS = 1.0
#: Odds of content that a word of CONTENT_WORDS or OTHER_WORDS starts with, how many nodes
#: that is worth, the most that all of a node's words say (logarithm), and words learned.
NAME_ODDS = {"content": 100.0, "other": 0.00001}
NAME_ROWS, NAME_BOUND, NAME_WORDS = 20.0, 10.0, 5_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noframes noembed template".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section select summary table tbody td tfoot th thead tr ul""".split())
#: A start tag of the key closes an open one of the values, up to the nearest of STOPS.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}, "option": {"select"}, "optgroup": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
#: Block starts that close an open paragraph.
PARAGRAPH_ENDS = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend",
                           "option", "optgroup", "select"}

CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("""nav header footer aside form script style noscript iframe template head button select
textarea input option label svg canvas object embed menu dialog audio video""".split())
#: Words of class, id, role and itemprop that name what is or is not main text.
CONTENT_WORDS = frozenset("""article articlebody content main maincontent post postbody story storybody entry
entrycontent body text richtext""".split())
OTHER_WORDS = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner
nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside related recommended
recommendations comment comments disqus reply replies respond discussion notice notices cookie cookies consent gdpr
alert popup modal overlay newsletter subscribe subscription signup login share sharing social widget toolbar
pagination pager search searchbox form contentinfo complementary copyright legal skip hidden""".split())

#: A name that begins so says what the element has or does, not what it is.
HAS_WORDS = frozenset("has have had no not non with without is are can show shows hide".split())
#: Heads that only hold what the word before them names.
HOLDERS = frozenset("""list lists item items box boxes wrap wrapper wrapping container holder inner outer left right top
bottom center slot unit bar area zone section block panel group row col column cell link links button buttons icon
icons title label module component region frame""".split())
#: Heads that a word for other things before them makes one of these.
HELD = CONTENT_WORDS | frozenset("posts articles stories news contents texts".split())

_RAW_END = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                  r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>?", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
_NAMING = frozenset(("class", "id", "role", "itemprop", "aria-label"))
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$|/)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

ROLES = ("content", "other", "plain", "inline")
TEXT_BINS = (1, 25, 80, 200, 600)
LINK_BINS = (0.01, 0.33, 0.66)


@dataclass
class Page:
    """The tree, in document order: node 0 is the root."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    role: list[int] = field(default_factory=lambda: [2])
    words: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    #: (node, text) and (node, None) where a block begins or ends.
    runs: list[tuple[int, str | None]] = field(default_factory=list)


def role_of(tag: str, attributes: str) -> int:
    """Index in ROLES, by the tag and what the page itself hides or marks as main."""
    if tag in OTHER_TAGS:
        return 1
    content = tag in CONTENT_TAGS
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = (values[0] or values[1] or values[2]).lower()
            if name.lower() == "aria-hidden" and value == "true":
                return 1
            content |= name.lower() == "role" and value == "main"
        if _HIDDEN.search(re.sub(_ATTRIBUTE, " ", attributes)):
            return 1
    if content:
        return 0
    return 2 if tag in BLOCKS else 3


def head_word(name: str) -> str | None:
    """What a name says that the element is."""
    parts = [p.lower() for p in _PART.findall(name) if not p.isdigit()]
    if not parts or parts[0] in HAS_WORDS and len(parts) > 1:
        return None
    while len(parts) > 1 and parts[-1] in HOLDERS:
        parts.pop()
    if len(parts) > 1 and parts[-1] in HELD and parts[-2] in OTHER_WORDS:
        parts.pop()
    return parts[-1]


def head_words(tag: str, attributes: str) -> tuple[str, ...]:
    """The head words of an element's names; what the whole page is called says nothing."""
    if tag in ("html", "body") or "=" not in attributes:
        return ()
    out = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in _NAMING:
            value = entities.unescape(values[0] or values[1] or values[2])
            out.update(map(head_word, [value] if name.lower() == "aria-label" else value.split()))
    return tuple(sorted(x for x in out if x))


def parse(html: str) -> Page:
    page = Page()
    parent, tags, roles, runs = page.parent, page.tag, page.role, page.runs
    open_ = [0]
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            runs.append((open_[-1], html[at:]))
            break
        if m.start() > at:
            runs.append((open_[-1], html[at:m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                runs.append((open_[-1], entities.escape(m[0][9:].removesuffix("]]>"))))
            continue
        name = name.lower()
        if m[1] or m[4]:
            _close(name, open_, tags, runs)
            continue
        attributes = m[3] or m[6] or ""
        if name in CLOSES:
            for k in range(len(open_) - 1, 0, -1):
                if tags[open_[k]] in STOPS[name]:
                    break
                if tags[open_[k]] in CLOSES[name]:
                    _pop_to(k, open_, tags, runs)
                    break
        if name in PARAGRAPH_ENDS:
            for k in range(len(open_) - 1, 0, -1):
                if tags[open_[k]] == "p":
                    _pop_to(k, open_, tags, runs)
                    break
                if tags[open_[k]] in BLOCKS:
                    break
        node = len(tags)
        parent.append(open_[-1])
        tags.append(name)
        roles.append(role_of(name, attributes))
        page.words.append(head_words(name, attributes))
        if name in BLOCKS:
            runs.append((open_[-1], None))
        elif name == "br":
            runs.append((open_[-1], " "))
        if name in VOID or attributes.endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            close = html.find(">", end.start()) if end else -1
            at = n if close < 0 else close + 1
            continue
        open_.append(node)
    return page


def _pop_to(k: int, open_: list[int], tags: list[str], runs: list[tuple[int, str | None]]) -> None:
    """Close the open nodes from place k on."""
    if any(tags[x] in BLOCKS for x in open_[k:]):
        runs.append((open_[k - 1], None))
    del open_[k:]


def _close(name: str, open_: list[int], tags: list[str], runs: list[tuple[int, str | None]]) -> None:
    """An end tag closes the nearest open one of its name; inline ends don't reach past a block."""
    for k in range(len(open_) - 1, 0, -1):
        tag = tags[open_[k]]
        if tag == name:
            _pop_to(k, open_, tags, runs)
            return
        if tag in BLOCKS and name not in BLOCKS:
            return


def observed(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """Text and link bins of each node, over its whole subtree."""
    n = len(page.tag)
    text, linked = [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    for node, run in page.runs:
        if run:
            size = len(run) - run.count(" ")
            text[node] += size
            if in_link[node]:
                linked[node] += size
    for i in range(n - 1, 0, -1):
        text[page.parent[i]] += text[i]
        linked[page.parent[i]] += linked[i]
    share = [b / a if a else 0.0 for a, b in zip(text, linked)]
    return np.digitize(text, TEXT_BINS), np.digitize(share, LINK_BINS)


def labels(page: Page) -> list[int] | None:
    """States by the page's own tags: 1 below its main element and outside tags for other things.

    None if the page has no such element.
    """
    found = [i for i, r in enumerate(page.role) if r == 0 and page.tag[i] in CONTENT_TAGS]
    if not found:
        return None
    state = [0] * len(page.tag)
    for i in range(1, len(state)):
        if page.role[i] == 1:
            state[i] = 0
        elif page.role[i] == 0 and page.tag[i] in CONTENT_TAGS:
            state[i] = 1
        else:
            state[i] = state[page.parent[i]]
    return state


@dataclass
class Potentials:
    """Probabilities: text and links by state; edge by role, parent's state and own state.
    Words: the logarithm of the odds of content."""

    text: np.ndarray
    links: np.ndarray
    edge: np.ndarray
    words: dict[str, float] = field(default_factory=dict)


def potentials(counts: Counter) -> Potentials:
    """Smoothed frequencies of (kind, given..., value) counts."""
    def table(kind: str, values: int) -> np.ndarray:
        t = np.array([[counts[kind, s, v] for v in range(values)] for s in (0, 1)], float) + 1e-9
        t /= t.sum(axis=1, keepdims=True)
        share = SMOOTHING[kind]
        return (1 - share) * t + share / values

    edge = np.empty((len(ROLES), 2, 2))
    for r, role in enumerate(ROLES):
        for p in (0, 1):
            one = PRIOR_EDGE[role][p]
            n = np.array([counts["edge", 2 * r + p, s] for s in (0, 1)]) + PRIOR_ROWS * np.array([1 - one, one])
            share = SMOOTHING["edge"]
            edge[r, p] = (1 - share) * n / n.sum() + share * np.array([1 - one, one])
    seen = {w for kind, _, w in counts if kind == "word"}
    return Potentials(table("text", len(TEXT_BINS) + 1), table("links", len(LINK_BINS) + 1), edge,
                      {w: _log_odds(w, counts["word", 0, w], counts["word", 1, w])
                       for w in seen | CONTENT_WORDS | OTHER_WORDS})


def _log_odds(word: str, other: int, content: int) -> float:
    kind = "other" if word in OTHER_WORDS else "content" if word in CONTENT_WORDS else None
    odds = NAME_ODDS.get(kind, 1.0)
    n = NAME_ROWS * np.array([1.0, odds]) / max(1.0, odds)
    return float(np.log((content + n[1]) / (other + n[0])))


def edges_of(page: Page, model: Potentials) -> np.ndarray:
    """P(state) by node and parent's state: its role's, the odds of content moved by its names."""
    edge = model.edge[page.role]
    w = np.clip([sum(model.words.get(x, 0.0) for x in words) for words in page.words], -NAME_BOUND, NAME_BOUND)
    at = np.flatnonzero(w)
    odds = edge[at, :, 1] / edge[at, :, 0] * np.exp(w[at])[:, None]
    edge[at, :, 1] = odds / (1 + odds)
    edge[at, :, 0] = 1 / (1 + odds)
    return edge


def marginals(page: Page, model: Potentials) -> list[float]:
    """P(content) of each node by sum-product: messages up to the root, then down."""
    text, links = observed(page)
    # The children of a node speak as one, however many they are.
    siblings = np.bincount(page.parent[1:], minlength=len(text))
    own = (model.text[:, text] * model.links[:, links]) ** (1.0 / np.maximum(siblings[page.parent], 1))
    own /= own.sum(axis=0)
    zero, one = own[0].tolist(), own[1].tolist()
    zero[0] = one[0] = 0.5  # the root sees nothing of its own
    edge = edges_of(page, model).reshape(-1, 4).tolist()
    n, parent = len(edge), page.parent
    # Below: evidence of the node's subtree; to its parent goes its sum over states.
    up0, up1 = [1.0] * n, [1.0] * n
    for i in range(n - 1, 0, -1):
        a, b = zero[i], one[i]
        e00, e01, e10, e11 = edge[i]
        up0[i], up1[i] = e00 * a + e01 * b, e10 * a + e11 * b
        s = up0[i] + up1[i]
        up0[i] /= s
        up1[i] /= s
        p = parent[i]
        x, y = zero[p] * up0[i], one[p] * up1[i]
        zero[p], one[p] = x / (x + y), y / (x + y)
    out = [0.0] * n
    out[0] = one[0] / (zero[0] + one[0])
    top0, top1 = [0.0] * n, [0.0] * n
    top0[0], top1[0] = 1 - out[0], out[0]
    for i in range(1, n):
        p = parent[i]
        # The parent's belief without this child's message.
        x, y = top0[p] / up0[i], top1[p] / up1[i]
        e00, e01, e10, e11 = edge[i]
        a, b = (x * e00 + y * e10) * zero[i], (x * e01 + y * e11) * one[i]
        s = a + b
        top0[i], top1[i] = max(a / s, 1e-300), max(b / s, 1e-300)
        out[i] = b / s
    return out


def main_text(html: str | None, model: Potentials) -> str:
    """The blocks of content, each on a line."""
    if not html:
        return ""
    page = parse(html)
    content = [p > 0.5 for p in marginals(page, model)]
    lines, part = [], []
    for node, run in [*page.runs, (0, None)]:
        if run is None:
            line = " ".join("".join(part).split())
            if line:
                lines.append(line)
            part = []
        elif content[node]:
            part.append(entities.unescape(run))  # a reference does not reach past a tag
    return "\n".join(lines)


def learn_counts(html: str | None) -> Counter:
    """What a labelled page adds to the frequencies; nothing for another."""
    out: Counter = Counter()
    page = parse(html or "")
    state = labels(page)
    if state is None:
        return out
    text, links = observed(page)
    for i in range(1, len(state)):
        s = state[i]
        out["text", s, int(text[i])] += 1
        out["links", s, int(links[i])] += 1
        out["edge", 2 * page.role[i] + state[page.parent[i]], s] += 1
        for w in page.words[i]:
            out["word", s, w] += 1
    return out


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> Potentials:
    """Potentials from the labelled pages among the ``limit`` pages of smallest hash."""
    chosen = hash_sample(pages, ["page_id", "url"], limit).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for html in batch.column(0).to_pylist():
                total.update(learn_counts(html))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([str(k[2]) for k in keys], pa.string()), pa.array([total[k] for k in keys], pa.int64())],
            ["kind", "a", "b", "n"])

    rows = (chosen.repartition(4).mapInArrow(count, "kind string, a int, b string, n long")
            .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    # Some dozens of kinds, and the words met most often.
    few = rows.filter("kind <> 'word'").unionByName(
        rows.filter("kind = 'word'").orderBy(F.desc("n"), "a", "b").limit(NAME_WORDS)).collect()
    return potentials(Counter({(k, a, b if k == "word" else int(b)): n for k, a, b, n in few}))


def extract(pages: DataFrame, model: Potentials | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h, shared.value) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
