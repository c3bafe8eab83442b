"""Operator 5, HTML extraction: two-pass block rules.

The first pass cuts a page into blocks and classifies each by its stop-word density,
its length and its link density. The second pass gives ambiguous blocks the label of
the nearest decided neighbours. Blocks inside navigation, forms, notices and the like
are left out by their place before the rules are asked.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

LENGTH_LOW = 70
LENGTH_HIGH = 200
STOP_LOW = 0.15
STOP_HIGH = 0.30
#: Share of stop words in a page's long blocks below which its language is not a known one.
STOP_NONE = 0.05
LINKS_HIGH = 0.5

#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were with
    auf aus das dem den der des die ein eine für ist mit nicht sich und von zu
    au aux avec ce dans de des du elle en est et il la le les pas par pour que qui sur un une
    al como con del el es esta lo los las más no para por se su una y
    """.split()
)
#: Elements whose content is never text of the page.
RAW = frozenset("script style noscript template textarea iframe svg math head object canvas".split())
BLOCK = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu
    nav ol option p pre section select summary table tbody td tfoot th thead tr ul
    """.split()
)
#: Elements that hold other blocks; the others end at the next block.
CONTAINER = BLOCK - frozenset("p li dt dd h1 h2 h3 h4 h5 h6 hr option td th tr summary pre".split())
CHROME = frozenset("aside button dialog footer form header menu nav select".split())
LANDMARK = frozenset(("article", "main"))
#: Words of a class, id or role that mark what is not part of an article.
CHROME_WORDS = frozenset(
    """
    ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation
    newsletter notice pager pagination popup promo promotion related reply replies respond search
    share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary
    contentinfo
    """.split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
#: Words after a chrome word that keep its sense, as in ``comment-list``.
PART_WORDS = frozenset(
    """
    area articles bar block bottom box button buttons container content form inner item items left
    link links list outer panel posts primary right secondary section slot stories top unit widget
    wrap wrapper
    """.split()
)
#: Words before a chrome word that say something of a page's layout, as in ``no-sidebar``.
LAYOUT_WORDS = frozenset("fixed has hide is no off on show sticky with without".split())
#: What stays out even where it holds most of a page's text.
BESIDE = frozenset(
    """
    aside comment comments complementary disqus footer nav navigation related replies reply respond
    sidebar
    """.split()
)
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = LANDMARK | frozenset(("html", "body"))
_WORD = re.compile(r"[^\W\d_]+")
_HREF = re.compile(r"(?:^|[\s\"'])href\s*=", re.I)


@dataclass
class Block:
    text: str
    link_chars: int
    chrome: bool
    inside: int
    label: str = ""
    region: int = -1

    @cached_property
    def stop_words(self) -> tuple[int, int]:
        """Stop words, and all words."""
        words = _WORD.findall(self.text.lower())
        return sum(w in STOP_WORDS for w in words), len(words)


@dataclass
class Region:
    """An element that is not part of an article by its name, class, id or role.

    It is part of one after all if it holds the main text and is not `fixed`.
    """

    parent: int
    fixed: bool


def _chrome_word(name: str, in_article: bool) -> str | None:
    """The chrome word that a whole class, id or role stands for."""
    words = re.split(r"[^a-z]+", name)
    if len(words) == 1:
        found = words[0]
    elif words[0] in LAYOUT_WORDS:
        return None
    elif words[-1] in CHROME_WORDS:
        found = words[-1]
        if found == "header" and words[0] not in ("site", "page", "top", "main"):
            return None
    elif words[0] in CHROME_WORDS and words[1] in PART_WORDS:
        found = words[0]
    else:
        return None
    return found if found in CHROME_WORDS and not (found == "header" and in_article) else None


def _chrome(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is chrome, and whether it is even with the main text in it."""
    chrome = name in CHROME and not (name == "header" and in_article)
    fixed = name in BESIDE
    if not attributes:
        return chrome, fixed
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if (
            key == "hidden"
            or (key == "aria-hidden" and value.strip() == "true")
            or (key == "style" and _NOT_SHOWN.search(value))
        ):
            return True, True
        if key in ("class", "id", "role") and name not in ROOTS and name not in HEADS:
            for mark in value.split():
                word = _chrome_word(mark, in_article)
                chrome = chrome or word is not None
                fixed = fixed or word in BESIDE
    return chrome, fixed


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, with white space and character references resolved."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    regions: list[Region] = []
    landmarks: dict[int, int] = {}
    text: list[str] = []
    links: list[str] = []
    in_link = marked = False
    article = articles = 0
    at, size = 0, len(page)
    # Behind the last closing sign nothing can be a tag.
    last = page.rfind(">") + 1

    def flush() -> None:
        nonlocal text, links
        whole = " ".join(entities.unescape("".join(text)).split())
        if whole:
            linked = len(" ".join(entities.unescape("".join(links)).split()))
            out.append(Block(whole, linked, marked, article, region=stack[-1][1] if stack else -1))
        text, links = [], []

    while at < size:
        m = _TOKEN.search(page, at, last) if at < last else None
        piece = page[at : m.start()] if m else page[at:].partition("<!--")[0]
        if piece:
            text.append(piece)
            if in_link:
                links.append(piece)
        if m is None:
            break
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if not name:
            continue
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else (at if name == "head" else size)
            continue
        if name == "a":
            # An anchor without an address, or an empty one, is no link.
            in_link = not closing and not attributes.endswith("/") and _HREF.search(attributes) is not None
        elif name == "br":
            text.append(" ")
        if name not in BLOCK:
            continue
        flush()
        marked = in_link = False
        if name not in CONTAINER:
            marked = not closing and _chrome(name, attributes, bool(article))[0]
        elif not closing:
            region = stack[-1][1] if stack else -1
            chrome, fixed = _chrome(name, attributes, bool(article))
            if chrome:
                regions.append(Region(region, fixed))
                region = len(regions) - 1
            stack.append((name, region, article))
            if name in LANDMARK:
                articles += 1
                landmarks[articles] = region
                article = article or articles
        elif any(n == name for n, _, _ in stack):
            while stack:
                opened, _, before = stack.pop()
                article = before
                if opened == name:
                    break
    flush()
    _settle(out, regions, landmarks)
    return out


def _settle(found: list[Block], regions: list[Region], landmarks: dict[int, int]) -> None:
    """Mark the blocks in regions that do not hold the main text.

    That is more than half of the good text, or the article with the most of it. `landmarks`
    has the region that each article stands in.
    """
    if not regions:
        return
    open_ = [not r.fixed for r in regions]
    for k, r in enumerate(regions):
        open_[k] = open_[k] and (r.parent < 0 or open_[r.parent])
    shown = [b for b in found if not b.chrome and (b.region < 0 or open_[b.region])]
    known = known_language(shown)
    articles: dict[int, list[int]] = {}
    good = [0] * len(regions)
    total = 0
    for b in shown:
        size = len(b.text) if first_pass(b, known) == "good" else 0
        total += size
        if b.region >= 0:
            good[b.region] += size
        if b.inside:
            sizes = articles.setdefault(b.inside, [0, 0])
            sizes[0] += size
            sizes[1] += len(b.text)
    best = max(articles, key=lambda a: articles[a], default=0)
    holds = [False] * len(regions)
    if best and (articles[best][0] or not total) and landmarks[best] >= 0:
        holds[landmarks[best]] = True
    for k in range(len(regions) - 1, -1, -1):
        up = regions[k].parent
        if up >= 0:
            good[up] += good[k]
            holds[up] = holds[up] or holds[k]
    out = [not holds[k] and 2 * good[k] <= total for k in range(len(regions))]
    for k, r in enumerate(regions):
        out[k] = out[k] or not open_[k] or (r.parent >= 0 and out[r.parent])
    for b in found:
        b.chrome = b.chrome or (b.region >= 0 and out[b.region])


def known_language(found: list[Block]) -> bool:
    """Whether the long blocks have stop words at all."""
    long = [b.stop_words for b in found if not b.chrome and len(b.text) >= LENGTH_LOW]
    return sum(s for s, _ in long) >= STOP_NONE * sum(n for _, n in long)


def first_pass(block: Block, known: bool = True) -> str:
    """``good``, ``bad``, or the ambiguous ``near`` and ``short``.

    Where the language is not `known`, length and link density decide.
    """
    size = len(block.text)
    if block.link_chars > LINKS_HIGH * size:
        return "bad"
    if size < LENGTH_LOW:
        return "short"
    stop, words = block.stop_words
    density = stop / max(1, words) if known else 1
    if density >= STOP_HIGH:
        return "good" if size > LENGTH_HIGH else "near"
    if density >= STOP_LOW or block.inside:
        return "near"
    return "bad"


def second_pass(found: list[Block]) -> None:
    """Give ambiguous blocks the label of the nearest decided neighbours.

    The edges of an article element count as good neighbours of the blocks in it, so one
    good side is enough there. Elsewhere both sides of a short block must be good.
    """
    voters = [b for b in found if not b.chrome]
    labels = [b.label for b in voters]

    def nearest(k: int, step: int) -> str:
        i = k + step
        while 0 <= i < len(voters):
            if voters[k].inside and voters[i].inside != voters[k].inside:
                return "good"
            if labels[i] in ("good", "bad"):
                return labels[i]
            i += step
        return "good" if voters[k].inside else "bad"

    sides = {-1: ["bad"] * len(voters), 1: ["bad"] * len(voters)}
    for step in (-1, 1):
        order = range(len(voters)) if step < 0 else range(len(voters) - 1, -1, -1)
        for k in order:
            i = k + step
            if 0 <= i < len(voters) and voters[i].inside == voters[k].inside:
                decided = labels[i] in ("good", "bad")
                sides[step][k] = labels[i] if decided else sides[step][i]
            else:
                sides[step][k] = nearest(k, step)
    for k, block in enumerate(voters):
        if labels[k] not in ("good", "bad"):
            votes = (sides[-1][k] == "good") + (sides[1][k] == "good")
            block.label = "good" if votes >= (1 if block.inside or labels[k] == "near" else 2) else "bad"


def main_text(page: str | None) -> str:
    """The article of a page, one line a block; empty where there is none."""
    found = blocks(page or "")
    known = known_language(found)
    for block in found:
        block.label = "bad" if block.chrome else first_pass(block, known)
    second_pass(found)
    return "\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """Page id, url, main text and its length in code points, for every row.

    Null or empty html gives an empty text. Repeated rows give a row each. Pages are read
    whole, one at a time. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column("html")]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
