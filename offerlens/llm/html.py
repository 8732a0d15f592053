"""Main text of web pages.

The standard library's streaming parser turns a page into lines (its blocks).
Every line has a text-to-tag ratio; the ratios along the page are smoothed by
a Gaussian kernel and clustered by a threshold of one standard deviation below
the mean of the text lines.  Lines of boilerplate elements (menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader
comments) have ratio 0 and never are content.  A region is the lines of one
container, an article or a main part being one as a whole; a region is content
if some smoothed ratio reaches the threshold, and then all its lines are.
Where the page marks articles (or else a main part) only these compete, and
the region with the highest ratio is content always.

White space inside a block becomes one space; character references are
decoded; blocks are joined by a line feed in page order.

Results in special cases: null, empty or text-free pages have an empty text;
unclosed, misnested and truncated markup is read as far as it goes; repeated
rows and null ids are rows like any other; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from offerlens.llm.common import lean, plain, read_table, ship
from offerlens.llm.registry import register

ship(__name__)

SIGMA = 1.0  # of the smoothing kernel, in lines
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body"}
# elements that never hold main text
OFF = frozenset("""nav footer aside form script style noscript template head iframe object svg canvas button select textarea menu
    dialog audio video map datalist""".split())
REGIONS = frozenset("article main section div td body blockquote".split())
OFF_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# class and id names of boilerplate, matched as whole names: what it is, between a place before and a kind of box after it
OFF_NAME = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|header|footer|post|entry|article|user|reader|blog|wp|js)[_-]?)?"
    r"(?:ads?|advert|adverts|advertisement|advertising|adsense|adbox|sponsored|sponsors?|promo|promos|promotion|banner|side-?bar|"
    r"cookies?|cookie-?consent|consent|gdpr|notices?|notification|alert|popup|modal|overlay|comments?|disqus|respond|replies|reply|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|share|sharing|social|social-?media|newsletter|subscribe|"
    r"subscription|sign-?up|log-?in|search|widgets?|pagination|pager|toolbar|copyright|skip-?link|"
    r"(?:related|recommended|popular|more)[_-](?:posts?|articles?|links?|stories|content|reading|news|products?|items?)|recommendations)"
    r"(?:[_-]?(?:box|bar|list|area|wrap|wrapper|container|block|section|panel|slot|unit|banner|notice|form|links?|buttons?|items?|"
    r"menu|popup|modal|overlay|message|thread|header|footer|content|inner|top|bottom|left|right|sign-?up|share|sharing|subscribe|"
    r"widgets?|toggle|\d+))*", re.I)
HEADERS = re.compile(r"(?:site|page|top|global|main)[_-]?header|header[_-]?(?:bar|wrap|wrapper|container)", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Lines(HTMLParser):
    """Parser events to lines ``[text, tags, off, region, depth of article / main]``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int, bool, bool]] = []
        self.open: list[tuple[str, bool, bool]] = []  # (tag, off, new region)
        self.parts: list[str] = []
        self.tags = self.regions = self.off = self.article = self.main = 0
        self.region = [0]

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.off > 0, self.region[-1], self.article > 0, self.main > 0))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_p()
        off = tag in OFF or tag == "header" and not self.article
        if attrs and not off:
            a = dict(attrs)
            off = (a.get("role") or "").lower() in OFF_ROLES or "hidden" in a or (a.get("aria-hidden") or "").lower() == "true" or bool(
                HIDDEN.search(a.get("style") or ""))
            if not off and tag not in ("html", "body", "article", "main"):
                names = f"{a.get('class') or ''} {a.get('id') or ''}".split()
                off = any(OFF_NAME.fullmatch(x) or HEADERS.fullmatch(x) for x in names)
        new = tag == "article" or tag in REGIONS and not self.article and not self.main
        if new:
            self.regions += 1
            self.region.append(self.regions)
        self.off += off
        self.article += tag == "article"
        self.main += tag == "main"
        self.open.append((tag, off, new))

    def pop(self) -> str:
        tag, off, new = self.open.pop()
        if new:
            self.region.pop()
        self.off -= off
        self.article -= tag == "article"
        self.main -= tag == "main"
        return tag

    def close_p(self) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag == "p":
                while self.pop() != "p":
                    pass
                return
            if tag in BLOCKS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if any(x[0] == tag for x in reversed(self.open)):
            # an end tag closes inline elements left open, but not a container around it
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    break
                if tag not in BLOCKS and self.open[i][0] in BLOCKS:
                    return
            while self.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    r = int(np.ceil(3 * sigma))
    k = np.exp(-np.arange(-r, r + 1) ** 2 / (2 * sigma**2))
    return np.convolve(x, k / k.sum())[r:r + len(x)]


def main_text(html: str | None) -> str:
    p = Lines()
    p.feed(html or "")
    p.close()
    p.flush()
    lines = p.lines
    part = 4 if any(x[4] and not x[2] for x in lines) else 5 if any(x[5] and not x[2] for x in lines) else None
    inside = np.array([not x[2] and (part is None or x[part]) for x in lines], bool)
    if not inside.any():
        return ""
    ratio = np.array([0.0 if x[2] else len(x[0]) / max(1, x[1]) for x in lines])
    score = smooth(ratio)
    own = score[inside]
    threshold = own.mean() - own.std()
    region = np.array([x[3] for x in lines])
    best = region[int(np.argmax(np.where(inside, score, -1.0)))]
    content = set(region[inside & (score >= threshold)].tolist()) | {int(best)}
    return "\n".join(x[0] for x, i in zip(lines, inside) if i and x[3] in content)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages(page_id, url, html)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(x) for x in pdf["html"]]
            yield pd.DataFrame({"page_id": plain(pdf["page_id"]), "url": plain(pdf["url"]), "text": text, "n_chars": [len(x) for x in text]})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(lean(run), f"page_id {kind}, url string, text string, n_chars long")


@register("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
