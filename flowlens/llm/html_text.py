"""Main text of web pages by a maximum-scoring subsequence of words and tags."""

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import once, utf8

#: Pages that weights are fitted on, at most in expectation.
FIT_PAGES = 5_000
#: Pages of the sample that must have a class or id before a weight of its own is fitted.
NAME_PAGES = 20

#: A quote begins a value only behind an equals sign; one that never ends is a character.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)"
    r"(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"([^\s=>\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu"
    " nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that never hold article text.
OUTSIDE = frozenset(
    "head script style noscript template svg math iframe object canvas audio video nav aside"
    " footer form button select textarea dialog menu title".split())
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu"
    " menubar toolbar".split())
#: Words of a class or id that name the same things as those elements.
OUTSIDE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget widgets"
    " cookie cookies consent gdpr notice notification banner popup modal overlay newsletter"
    " subscribe subscription signup login promo promotion ad ads adv advert adverts advertising"
    " advertisement sponsor sponsored sponsors share sharing social related recommended"
    " recommendations comment comments disqus respond replies reply pagination pager toolbar"
    " skip copyright".split())
#: Words that say nothing about what a class or id names.
PLAIN_NAMES = frozenset(
    "area article articles bar block blocks body bottom box button buttons column container"
    " content extra form global group holder inline inner item items left link links list main"
    " outer page panel post posts primary right row secondary section site slot small sticky"
    " stories text tools top unit wrap wrapper".split())
#: Elements in which a header belongs to the article.
ARTICLES = frozenset(("article", "main"))


@cache
def named(token: str) -> float:
    """What a class or id is believed to say before pages are seen, as log odds for words.

    Sure if all its words name boilerplate or nothing, hardly anything if it has a word
    of its own beside them ("share-price"), nothing without such a word.
    """
    words = [w for w in token.split("-") if w]
    if not OUTSIDE_NAMES.intersection(words) and "header" not in words:
        return 0.0
    sure = OUTSIDE_NAMES | PLAIN_NAMES | {"header"}
    return -4.0 if sure.issuperset(words) else -0.5


@lru_cache(10_000)
def names_of(attrs: str) -> tuple[frozenset[str], str, bool]:
    """Classes and ids in small letters without digits, the role, and whether it is hidden."""
    tokens: set[str] = set()
    role, hidden = "", False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            for part in value.split():
                part = re.sub(r"([a-z])([A-Z])", r"\1-\2", part).lower()
                if not part.startswith(("has-", "with-", "no-", "is-", "not-")):
                    tokens.add("-".join(w for w in re.split(r"[^a-z]+", part) if w))
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden = hidden or value.strip().lower() == "true"
        elif name == "style":
            hidden = hidden or "display:none" in re.sub(r"\s", "", value.lower())
    return frozenset(tokens - {""}), role, hidden


@dataclass(slots=True)
class Element:
    """An element, what it and those around it say, and its items [first, last)."""

    tag: str
    parent: int
    outside: bool
    in_article: bool
    link: bool
    block: str
    names: tuple[str, ...]
    first: int
    last: int = -1


@dataclass(slots=True)
class Item:
    """A run of text, or a tag, with the number of the element it stands in."""

    kind: str
    text: str | None
    node: int
    words: int = 0


def items_of(page: str) -> tuple[list[Item], list[Element]]:
    """Texts and tags of a page in order, and its elements; element 0 is the page.

    Each element knows what its ancestors say, so depth costs nothing and has no limit.
    """
    items: list[Item] = []
    elements = [Element("", 0, False, False, False, "body", (), 0)]
    stack = [0]
    open_tags: Counter = Counter()
    lower = None
    at, size = 0, len(page)

    def context(kind: str, text: str | None = None) -> None:
        own, words = elements[stack[-1]], 0
        if text is not None:
            kind = f"word {'outside' if own.outside else own.block}" + (" link" if own.link else "")
            words = len(text.split())
        items.append(Item(kind, text, stack[-1], words))

    def close() -> str:
        own = elements[stack.pop()]
        own.last = len(items)
        open_tags[own.tag] -= 1
        return own.tag

    while at < size:
        start = page.find("<", at)
        m = TOKEN.match(page, start) if start >= 0 else None
        while start >= 0 and m is None:
            start = page.find("<", start + 1)
            m = TOKEN.match(page, start) if start >= 0 else None
        end = start if m else size
        if end > at:
            context("", page[at:end])
        if not m:
            break
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if open_tags[tag]:
                while close() != tag:
                    pass
            context(f"tag /{tag}" if tag in KNOWN else "tag other")
            continue
        attrs = m["attrs"]
        if tag in BLOCKS:
            while open_tags["p"] and elements[stack[-1]].tag in (
                    "p", "b", "i", "em", "strong", "span", "a"):
                close()
        if tag in ("li", "option", "dt", "dd", "tr", "td", "th") and elements[stack[-1]].tag == tag:
            close()
        context(f"tag {tag}" if tag in KNOWN else "tag other")
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            if lower is None:
                lower = page.lower()
                if len(lower) != size:
                    lower = page
            end = lower.find(f"</{tag}", at)
            at = size if end < 0 else end
        tokens, role, hidden = names_of(attrs) if attrs else (frozenset(), "", False)
        parent = elements[stack[-1]]
        outside = (parent.outside or hidden or tag in OUTSIDE or role in OUTSIDE_ROLES
                   or tag == "header" and not parent.in_article)
        if tag in ARTICLES or tag in ("body", "html"):
            tokens = frozenset()
        elif parent.in_article:
            tokens = frozenset(t for t in tokens if "header" not in t.split("-"))
        block = (tag if tag in KNOWN else "other") if tag in BLOCKS else parent.block
        elements.append(Element(
            tag, stack[-1], outside, parent.in_article or tag in ARTICLES,
            parent.link or tag == "a", block, tuple(sorted(tokens)), len(items)))
        stack.append(len(elements) - 1)
        open_tags[tag] += 1
    while len(stack) > 1:
        close()
    elements[0].last = len(items)
    return items, elements


KNOWN = BLOCKS | frozenset("a b i em strong span br img script style".split())

#: What is believed before any labelled page is seen, as log odds, and how many words or
#: tags that belief weighs.
PRIOR_WEIGHT = 50.0


def prior(kind: str) -> float:
    if kind.startswith("name "):
        return named(kind[5:])
    if kind.startswith("tag"):
        return -0.5
    if "outside" in kind:
        return -2.0
    if kind.endswith("link"):
        return -0.5
    return 1.0


def weigh(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log odds of lying in the article, from (inside, outside) counts of each kind.

    Words score between -3 and 3, tags always below zero; a class or id adds between -6
    and 1 to the words inside.
    """
    total_in = sum(c[0] for k, c in counts.items() if k.startswith("word")) + 1
    total_out = sum(c[1] for k, c in counts.items() if k.startswith("word")) + 1
    weights = {}
    for kind, (inside, outside) in counts.items():
        share = 1 / (1 + np.exp(-prior(kind)))
        a = inside / total_in * min(total_in, total_out) + PRIOR_WEIGHT * share
        b = outside / total_out * min(total_in, total_out) + PRIOR_WEIGHT * (1 - share)
        odds = float(np.log(a / b))
        low, high = (-6.0, 1.0) if kind.startswith("name") else (-3.0, 3.0)
        weights[kind] = float(np.clip(odds, low, -0.2 if kind.startswith("tag") else high))
    return weights


#: What the names of an element must say at least for its words to be left out.
LEFT_OUT = -2.0


def evidence(items: list[Item], elements: list[Element],
             weights: dict[str, float]) -> tuple[list[float], list[bool]]:
    """Of every element: what the names of it and those around it say; whether it is left out.

    If hardly any word of the page would be left, names do not tell the article from the
    rest: then the element that holds most of the words counts without its own.
    """
    own = [sum(weights.get(f"name {t}", named(t)) for t in e.names) for e in elements]
    held = [0] * len(elements)
    for item in items:
        if item.words and not elements[item.node].outside:
            held[item.node] += item.words
    alone = list(held)
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]

    def left_out() -> list[bool]:
        out = [False] * len(elements)
        for i, e in enumerate(elements):
            out[i] = own[i] <= LEFT_OUT or i > 0 and out[e.parent]
        return out

    out = left_out()
    rest = sum(n for n, gone in zip(alone, out) if not gone)
    most = max((i for i in range(1, len(elements)) if own[i] <= LEFT_OUT),
               key=held.__getitem__, default=0)
    if most and 10 * rest < held[most]:
        own[most] = 0.0
        out = left_out()
    total = list(own)
    for i, e in enumerate(elements[1:], start=1):
        total[i] += total[e.parent]
    return total, out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last index of the contiguous run with the largest sum; ties: the first."""
    best, region, total, start = 0.0, (0, -1), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i)
    return region


def main_text(page: str, weights: dict[str, float]) -> str:
    """The main text: blocks of the best region, joined by line ends."""
    items, elements = items_of(page)
    names, left_out = evidence(items, elements, weights)
    scores = [weights.get(i.kind, prior(i.kind)) if i.text is None
              else i.words * (weights.get(i.kind, prior(i.kind)) + names[i.node]) for i in items]
    first, last = best_region(scores)
    if last < first:
        return ""

    def content(i: int) -> bool:
        node = items[i].node
        return items[i].words > 0 and not elements[node].outside and not left_out[node]

    # The region's ends are sharpened to the innermost article or container around it.
    texts = [i for i in range(first, last + 1) if content(i)]
    if not texts:
        return ""
    common = around = items[texts[0]].node
    while elements[common].last <= texts[-1]:
        common = elements[common].parent
    around = common
    node = None
    while around and node is None:
        node = around if elements[around].tag in ARTICLES else None
        around = elements[around].parent
    while node is None and common:
        node = common if elements[common].tag in ("div", "section", "td") else None
        common = elements[common].parent
    if node is not None:
        first, last = min(first, elements[node].first), max(last, elements[node].last - 1)
    else:
        while first > 0 and not is_block(items[first - 1]):
            first -= 1
        while last + 1 < len(items) and not is_block(items[last + 1]):
            last += 1
    chosen = list(range(first, last + 1))
    if any(elements[items[i].node].in_article for i in texts):
        chosen = sorted({*chosen, *other_articles(elements, scores, left_out)})
    blocks, current = [], []
    for item in map(items.__getitem__, chosen):
        if item.text is None:
            name = item.kind[4:].lstrip("/")
            if name in BLOCKS:
                blocks.append("".join(current))
                current = []
            elif name == "br":
                current.append(" ")
        elif not elements[item.node].outside and not left_out[item.node]:
            current.append(item.text)
    blocks.append("".join(current))
    cleaned = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in cleaned if b)


def other_articles(elements: list[Element], scores: list[float],
                   left_out: list[bool]) -> Iterator[int]:
    """Items of the outermost articles that score above zero: a page may have several."""
    for i, e in enumerate(elements):
        outer = elements[e.parent]
        if e.tag in ARTICLES and not outer.in_article and not e.outside and not left_out[i]:
            if sum(scores[e.first:e.last]) > 0:
                yield from range(max(0, e.first - 1), min(len(scores), e.last + 1))


def is_block(item: Item) -> bool:
    return item.text is None and item.kind[4:].lstrip("/") in BLOCKS


def label_counts(pages: list[str]) -> tuple[Counter, Counter]:
    """(kind, inside) counts over the pages that mark their article, and pages by name.

    Words in the article's own marked-off parts (adverts, forms, comments) count as outside
    for the names around them. Tags that mark the article are not counted: they are the
    label.
    """
    counts: Counter = Counter()
    seen: Counter = Counter()
    for page in pages:
        items, elements = items_of(page)
        if not any(e.tag in ARTICLES for e in elements):
            continue
        sure = [False]
        for e in elements[1:]:
            sure.append(sure[e.parent] or any(named(t) <= LEFT_OUT for t in e.names))
        seen.update({t for e in elements for t in e.names})
        held = [[0, 0] for _ in elements]
        for item in items:
            own = elements[item.node]
            inside = own.in_article and not own.outside and not sure[item.node]
            if item.text is None:
                if item.kind[4:].lstrip("/") not in ARTICLES:
                    counts[item.kind, inside] += 1
                continue
            if own.outside or not sure[item.node]:
                counts[item.kind, inside] += item.words
            if not own.outside:
                held[item.node][inside] += item.words
        for i in range(len(elements) - 1, 0, -1):
            for inside in (0, 1):
                held[elements[i].parent][inside] += held[i][inside]
        # A name inside an element of the same name has its words counted there.
        upto: dict[str, int] = {}
        for e, words in zip(elements, held):
            for token in e.names:
                if e.first >= upto.get(token, 0):
                    upto[token] = e.last
                    for inside in (False, True):
                        if words[inside]:
                            counts[f"name {token}", inside] += words[inside]
    return counts, seen


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES, seed: int = 7) -> dict[str, float]:
    """Weights from about ``fit_pages`` pages, those that mark their article as labels.

    The sample is by a hash of the page, so it does not depend on how rows are stored. The
    driver gets one row per kind of word or tag, a few hundred, and per class or id that
    ``NAME_PAGES`` of the sampled pages have. Without labelled pages the prior remains.
    """
    total = pages.count()
    share = min(1.0, fit_pages / max(1, total))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "html"), F.lit(1_000_000))
    sample = pages.select("html").where(F.col("html").isNotNull() & (bucket < share * 1_000_000))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        seen: Counter = Counter()
        for batch in batches:
            own, named_by = label_counts(batch["html"].to_pylist())
            counts += own
            seen += named_by
        keys = list(counts)
        kinds = [k for k, _ in keys] + [f"name {t}" for t in seen]
        yield pa.RecordBatch.from_pydict({
            "kind": kinds, "inside": [i for _, i in keys] + [None] * len(seen),
            "n": pa.array([*(counts[k] for k in keys), *seen.values()], pa.int64())},
            schema=pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    rows = (sample.mapInArrow(count, "kind string, inside boolean, n bigint").groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("outside"),
        F.sum(F.when(F.col("inside").isNull(), F.col("n")).otherwise(0)).alias("pages")))
    usual = ~F.col("kind").startswith("name ") | (F.col("pages") >= NAME_PAGES)
    return weigh({r["kind"]: (r["inside"], r["outside"]) for r in rows.where(usual).collect()})


def extract(page: Column, weights: dict[str, float]) -> Column:
    """The main text of an html column; null is an empty page. Narrow, no shuffle."""
    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text((p or b"").decode(), weights) for p in utf8(pages)],
                        pa.string())

    return once(texts, page)


def main_texts(pages: DataFrame, fit_pages: int = FIT_PAGES) -> DataFrame:
    """(page_id, url, text), one row per row of ``pages``.

    Words and tags get weights (see ``fit_weights``), words also by the classes and ids of
    the elements around them; the contiguous run of them with the largest sum is the
    content, widened to the article or container it lies in and to the page's other
    articles. Within it menus, headers, footers, sidebars, notices, adverts, forms, scripts
    and comments are left out, and nothing else: what lies in such an element, or in one
    whose names score below ``LEFT_OUT``. Text of a block is on one line; blocks are joined by a
    line end. Null or empty html, or a page without words: an empty text. Very long
    pages are read whole. No rows: no rows.
    """
    weights = fit_weights(pages, fit_pages)
    return pages.select("page_id", "url", extract(F.col("html"), weights).alias("text"))
