"""Main text of web pages by tag-path ratios.

A page is read once into text leaves, each with its tag path from the root (tag names with their telling attributes).
Leaves of the same path are taken together: characters per leaf and punctuation marks per leaf. Both ratios are laid
along the page, smoothed by a Gaussian over neighbouring leaves, fused by multiplication and compared with a threshold
of the page; a path's leaves are content if the path's fused ratio is above it. Parts that are never article text by
their tag or role (menus, headers outside the article, controls, scripts) get ratio zero. Class names, ids and forms only
weigh the ratio: by 0 where they are plain (comments, cookies, adverts), by ``DOUBTFUL`` where an article may use the
word as well (a discussion, an alert). They weigh nothing on an element that holds ``MOST`` of the page's text, or half
of it with the largest article in it, so a wrapper named after its sidebar, or a form around the page, loses nothing.
Containers only add to the selection: leaves that share the innermost container with most of the selected text, or the
article around it, such as a title, a lead or a short paragraph between long ones, are content as well.

Defined cases: null and empty html, or html without any content, give an empty text. Unclosed, misnested and
upper-case tags, missing ends and stray signs are read as far as they go. Repeated rows get equal results.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import ready

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])|[\"']))*+)(?:>|\Z)|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
NEVER = frozenset(
    "head nav footer aside button select option textarea input fieldset script style noscript iframe template svg math canvas "
    "object video audio menu dialog title".split()
)
CONTAINERS = frozenset("article main section div body td".split())
ARTICLES = frozenset(("article", "main"))
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
# Words of class names and ids.
UNWANTED = re.compile(
    r"(?:^|[_-])(?:ads?|adv|advert\w*|sponsor\w*|banner|cookies?|consent|gdpr|popup|modal|newsletter|subscri\w+"
    r"|comments?|commentlist|replies|reply|disqus|respond|sidebar|widget\w*|recommend\w*|share|sharing|social|nav\w*"
    r"|menu\w*|breadcrumbs?|footer|toolbar|pager|pagination|byline|login|signup|skip|related-?(?:posts?|articles?|links?|stories|news|content|items))"
    r"(?:$|[_-])",
    re.I,
)
HEADER = re.compile(r"(?:^|[_-])(?:masthead|site-?header|header|topbar)(?:$|[_-])", re.I)
UNSURE = re.compile(
    r"(?:^|[_-])(?:promo\w*|notices?|alert|overlay|discussion|side|related|tags?|search|foot)(?:$|[_-])",
    re.I,
)
#: Names that say what an element comes with, not what it is.
BESIDE = re.compile(r"(?:has|with|without|no|is|show|hide)[_-]", re.I)
DOUBTFUL = 0.6
MOST = 0.8
#: Elements nested deeper add nothing to a path: no text is lost, and a page takes linear time.
DEPTH = 256
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())


class _Leaf:
    __slots__ = ("path", "chain", "articles", "text", "blocked", "named")

    def __init__(self, path, chain, articles, text, blocked, named):
        self.path, self.chain, self.articles, self.text, self.blocked, self.named = path, chain, articles, text, blocked, named


def _attributes(raw: str) -> dict[str, str]:
    return {n.lower(): (v or "").strip("\"'") for n, v in ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else {}


def _unwanted(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is never article text; ``inside`` says that an article is open around it."""
    if tag in NEVER or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    if attributes.get("role", "").lower() in UNWANTED_ROLES:
        return True
    return False


def _weight(tag: str, attributes: dict[str, str], inside: bool) -> float:
    """What an element's kind and names leave of its ratio."""
    if tag == "form" or attributes.get("role", "").lower() == "form":
        return 0.0
    if not attributes or tag in ("body", "html", "article", "main"):
        return 1.0
    weight = 1.0
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        if not BESIDE.match(name):
            if UNWANTED.search(name) or not inside and HEADER.search(name):
                return 0.0
            if UNSURE.search(name):
                weight = DOUBTFUL if inside else 0.0
    return weight


def leaves(page: str) -> list[_Leaf]:
    """The page's blocks of text in order. A block ends wherever an element that is not inline begins or ends."""
    out: list[_Leaf] = []
    # Open elements: (tag, label, never text, number, weight); the number tells elements apart.
    stack: list[tuple[str, str, bool, int, float]] = []
    text: list[str] = []
    # Open elements beyond the depth, all within the stack's last: (tag, never text), and how many of each tag.
    deeper: list[tuple[str, bool]] = []
    held: Counter[str | bool] = Counter()
    number, at, size = 0, 0, len(page)

    def end_block() -> None:
        if text:
            joined = " ".join(references.unescape("".join(text)).split())
            text.clear()
            if joined:
                blocks = [e for e in stack if e[0] not in INLINE]
                path = "/".join(e[1] for e in blocks)
                chain = tuple(e[3] for e in blocks if e[0] in CONTAINERS)
                articles = tuple(e[3] for e in blocks if e[0] in ARTICLES)
                named = tuple((e[3], e[4]) for e in stack if e[4] < 1)
                out.append(_Leaf(path, chain, articles, joined, held[True] > 0 or any(e[2] for e in stack), named))

    def close_implied(tag: str, borders: set[str] | frozenset[str]) -> None:
        if deeper and any(held[b] for b in (tag, *borders)):
            return
        before = len(stack)
        _close_until(stack, tag, borders)
        if len(stack) < before:
            deeper.clear()
            held.clear()

    while at < size:
        found = TOKEN.match(page, at)
        at = found.end()
        tag = found.group(2)
        if tag is None:
            token = found.group()
            if token[0] != "<" or token == "<":
                text.append(token)
            elif token.startswith("<![CDATA["):
                text.append(token[9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found.group(1):
            if held[tag]:
                if tag not in INLINE or held[True]:
                    end_block()
                last = ""
                while last != tag:
                    last, blocking = deeper.pop()
                    held[last] -= 1
                    held[True] -= blocking
            elif any(e[0] == tag for e in stack):
                if tag not in INLINE or held[True] or any((e[2] or e[4] < 1) and e[0] == tag for e in stack):
                    end_block()
                while stack.pop()[0] != tag:
                    pass
                deeper.clear()
                held.clear()
            elif tag == "p":
                end_block()
            continue
        attributes = _attributes(found.group(3))
        inside = any(held[t] for t in ARTICLES) or any(e[0] in ARTICLES for e in stack)
        never = _unwanted(tag, attributes, inside)
        weight = _weight(tag, attributes, inside)
        if tag not in INLINE or never or weight < 1:
            end_block()
        if tag in RAW:
            close = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if tag in VOID or found.group(3).endswith("/") and tag not in CLOSES_P:
            continue
        if tag in CLOSES_P:
            close_implied("p", CLOSES_P - {"p"} | {"td", "th", "li", "body"})
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close_implied(tag, {"ul", "ol", "dl", "table", "select", "menu"} | ({"tr"} if tag in ("td", "th") else set()))
        if len(stack) >= DEPTH:
            deeper.append((tag, never))
            held[tag] += 1
            held[True] += never
            continue
        number += 1
        label = tag + ("." + attributes["class"].split()[0] if attributes.get("class", "").strip() else "")
        stack.append((tag, label, never, number, weight))
    end_block()
    return out


def _close_until(stack: list, tag: str, borders: set[str] | frozenset[str]) -> None:
    """Close an open ``tag`` and what is in it, if no element of ``borders`` was opened since."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == tag:
            del stack[i:]
            return
        if stack[i][0] in borders:
            return


def smoothed(values: list[float], reach: int = 2) -> list[float]:
    """Gaussian smoothing over the neighbours within ``reach``."""
    kernel = [math.exp(-(d * d) / 2.0) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            k = kernel[abs(i - j)]
            total += k * values[j]
            weight += k
        out.append(total / weight)
    return out


def _weights(found: list[_Leaf]) -> list[float]:
    """What tags and names leave of each leaf's ratio."""
    size: dict[int, int] = {}
    articles: dict[int, int] = {}
    for leaf in found:
        if not leaf.blocked:
            for number, _ in leaf.named:
                size[number] = size.get(number, 0) + len(leaf.text)
            for number in leaf.articles:
                articles[number] = articles.get(number, 0) + len(leaf.text)
    total = sum(len(leaf.text) for leaf in found if not leaf.blocked)
    largest = max(articles, key=lambda a: (articles[a], -a), default=None)
    around = {n for leaf in found if not leaf.blocked and largest in leaf.articles for n, _ in leaf.named if n < largest}
    void = {n for n, held in size.items() if held >= MOST * total or n in around and held >= total / 2}
    return [0.0 if leaf.blocked else min((w for n, w in leaf.named if n not in void), default=1.0) for leaf in found]


def content(page: str | None) -> list[str]:
    """The blocks of a page's main text."""
    found = leaves(page or "")
    weights = _weights(found)
    by_path: dict[tuple[str, float], list[int]] = {}
    for i, leaf in enumerate(found):
        if weights[i]:
            by_path.setdefault((leaf.path, weights[i]), []).append(i)
    if not by_path:
        return []
    chars, marks = [0.0] * len(found), [0.0] * len(found)
    for own in by_path.values():
        n_chars = sum(len(found[i].text) for i in own) / len(own)
        n_marks = sum(len(PUNCTUATION.findall(found[i].text)) for i in own) / len(own)
        for i in own:
            chars[i], marks[i] = n_chars, n_marks + 1.0
    fused = [a * b * w for a, b, w in zip(smoothed(chars), smoothed(marks), weights, strict=True)]
    ratio = {path: sum(fused[i] for i in own) / len(own) for path, own in by_path.items()}
    mean = sum(fused) / len(fused)
    threshold = min(0.5 * mean, max(ratio.values()))
    chosen = {i for path, own in by_path.items() if ratio[path] >= threshold for i in own}
    # The innermost container that holds at least nine tenths of the selected characters, and the article around it.
    total = sum(len(found[i].text) for i in chosen)
    held: dict[int, int] = {}
    for i in chosen:
        for c in found[i].chain:
            held[c] = held.get(c, 0) + len(found[i].text)
    home = max((c for c, n in held.items() if n >= 0.9 * total), default=None)
    if home is not None:
        inside = next(found[i] for i in chosen if home in found[i].chain)
        around = [a for a in inside.articles if a <= home]  # numbers grow inwards
        home = around[-1] if around else home
        # A doubtful element with selected text is a part of the article like others.
        good = {n for i in chosen for n, _ in found[i].named}
        chosen |= {
            i for i, leaf in enumerate(found)
            if home in leaf.chain and (weights[i] == 1 or weights[i] and all(n in good for n, _ in leaf.named))
        }
    return [found[i].text for i in sorted(chosen)]


def main_text(docs: DataFrame, html: str = "html") -> Column:
    """A string column with the main text of a column of pages, a line per block."""
    ready(docs.sparkSession)

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(content(p)) for p in pages], dtype=object)

    return F.pandas_udf(run, "string")(F.col(html))


def pages_table(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and its code points."""
    out = pages.select("page_id", "url", main_text(pages).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
