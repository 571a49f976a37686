"""Main text of HTML pages: parser events to lines, text-to-tag ratio, Gaussian smoothing, threshold clustering.

A page is read as a stream of events of the standard parser. Block tags end a line; every line has its text and the number
of tags in it. The ratio of text to tags, smoothed over neighbouring lines, is split in two clusters by a threshold;
lines of the upper cluster point out the content regions, which are then taken whole, in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that never hold article text.
SKIP = frozenset(
    "script style noscript template head title nav footer aside form button select textarea iframe svg math object menu dialog "
    "canvas audio video".split())
REGION = frozenset("article main section div td body html".split())
WHOLE = frozenset("article main".split())
#: Words in class, id or role that mark menus, notices, adverts, comments and the like.
MARK = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav(?:bar|igation|links?|list|menu|s)?|menu(?:bar|items?|list|s)?|breadcrumbs?|sidebar|side|footer|masthead|"
    r"(?:site|page|top)[_-]?header|cookies?|consent|gdpr|notices?|alerts?|comments?|replies|disqus|respond|share|sharing|social|related|recommend\w*|popup|"
    r"modal|overlay|newsletter|subscribe|signup|login|search|widget|toolbar|pagination|pager|skip|copyright|legal|complementary|"
    r"contentinfo|hidden", re.I)
#: Last words of a name that stand for a box: with a mark before them the box is one of that kind.
BOXES = frozenset(
    "area bar block body box column container content form group header inner item items links list main menu panel posts row section text thread "
    "widget wrap wrapper".split())
_PARTS = re.compile(r"[_-]+")
#: Characters a tag beyond which a line is text however long it is.
DENSE = 60


def marked(name: str) -> int:
    """2 if a name from class, id or role marks its box for certain, 1 if it may say something about it only (``share-enabled``), else 0."""
    if MARK.fullmatch(name):
        return 2
    parts = [x for x in _PARTS.split(name) if x]
    if len(parts) < 2 or not MARK.fullmatch(parts[0]) and not MARK.fullmatch("-".join(parts[:2])):
        return 0
    last = parts[-1].lower()
    return 2 if last in BOXES or MARK.fullmatch(last) and last != parts[0].lower() else 1


CHUNK = 1 << 16


class Lines(HTMLParser):
    """Collects (text, tags, region, doubts) per line. A region is the innermost article, main or box around it.

    Doubts are the boxes around a line, outermost first, that go only if they turn out to hold neither an article nor most of the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.certain: list[bool] = []  # of each doubtful box: whether only an article or main in it saves it
        self.saved: set[int] = set()
        self.parents: list[tuple[int, str]] = [(-1, "html")]  # of each region: the region around it, its tag
        self._open: list[tuple[str, bool, int, tuple[int, ...]]] = []  # tag, skipped from here, region, doubts
        self._text: list[str] = []
        self._tags = 0

    def _skipped(self) -> bool:
        return bool(self._open) and self._open[-1][1]

    def _region(self) -> int:
        return self._open[-1][2] if self._open else 0

    def _doubts(self) -> tuple[int, ...]:
        return self._open[-1][3] if self._open else ()

    def end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append((text, self._tags, self._region(), self._doubts()))
        self._text, self._tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
        self._tags += 1
        if tag in VOID:
            return
        if tag == "p" and self._open and self._open[-1][0] == "p":  # an open paragraph ends where the next begins
            self._open.pop()
        region = self._region()
        skipped = self._skipped() or tag in SKIP
        doubts = self._doubts()
        if tag in WHOLE:
            self.saved.update(doubts)
        if not skipped and tag not in ("html", "body", "article", "main"):
            skipped = any(
                k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and "display:none" in v.replace(" ", ""))
                for k, v in attrs)
            # a header belongs to the page unless it stands in an article
            skipped = skipped or tag == "header" and not self._inside_whole(region)
            sure = max((marked(name) for k, v in attrs if v and k in ("class", "id", "role") for name in v.split()), default=0)
            if sure and not skipped:
                self.certain.append(sure == 2)
                doubts = (*doubts, len(self.certain) - 1)
        if tag in REGION and not skipped:
            self.parents.append((region, tag))
            region = len(self.parents) - 1
        self._open.append((tag, skipped, region, doubts))

    def _inside_whole(self, region: int) -> bool:
        while region >= 0:
            region, tag = self.parents[region]
            if tag in WHOLE:
                return True
        return False

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        self._tags += 1
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                return
            # an inline end tag doesn't close the box around it
            if tag not in BLOCK and self._open[i][0] in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if not self._skipped():
            self._text.append(data)


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing along the lines, weights renormalised at both ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach:reach + len(values)]
    return np.convolve(values, kernel, "full")[reach:reach + len(values)] / weight


def threshold(values: np.ndarray) -> float:
    """Cut between two clusters of values on a line: the mean of their means, iterated until it stands still."""
    cut = float(values.mean())
    for _ in range(32):
        low, high = values[values < cut], values[values >= cut]
        then = (low.mean() + high.mean()) / 2 if len(low) and len(high) else cut
        if abs(then - cut) < 1e-9:
            break
        cut = float(then)
    return cut


def _without_marked(parser: Lines) -> list[tuple[str, int, int]]:
    """Lines outside marked boxes. A box with an article or main stays, and one marked in passing that holds most of the text outside boxes marked for certain."""
    held, whole = [0] * len(parser.certain), 0
    for text, _, _, doubts in parser.lines:
        if all(box in parser.saved or not parser.certain[box] for box in doubts):
            whole += len(text)
            for box in doubts:
                held[box] += len(text)
    stays = {box for box, sure in enumerate(parser.certain) if box in parser.saved or not sure and 2 * held[box] > whole}
    return [(text, tags, region) for text, tags, region, doubts in parser.lines if stays.issuperset(doubts)]


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """Main text of one whole page; empty for null, empty and text-free pages."""
    parser = Lines()
    page = html or ""
    for start in range(0, len(page), CHUNK):
        parser.feed(page[start:start + CHUNK])
    parser.close()
    parser.end_line()
    lines = _without_marked(parser)
    if not lines:
        return ""
    # a line of any length counts as dense, and no more than that
    ratio = smooth(np.log1p(np.array([min(len(text) / (1 + tags), DENSE) for text, tags, _ in lines])), sigma)
    chosen = ratio >= threshold(ratio)

    def around(region: int) -> int:
        """The outermost article or main around a region, else the region itself."""
        found, at = region, region
        while at >= 0:
            if parser.parents[at][1] in WHOLE:
                found = at
            at = parser.parents[at][0]
        return found

    homes = {region: around(region) for _, _, region in lines}
    chars: dict[int, list[int]] = {}
    for (text, _, region), yes in zip(lines, chosen, strict=True):
        sums = chars.setdefault(homes[region], [0, 0])
        sums[0] += len(text)
        sums[1] += len(text) * bool(yes)
    # a box counts if most of its text is dense: smoothing lifts the lines next to content as well
    content = {home for home, (whole, dense) in chars.items() if 2 * dense >= whole} or {home for home, (_, dense) in chars.items() if dense}
    if not any(parser.parents[home][1] in WHOLE for home in content):
        content |= {home for home, (_, dense) in chars.items() if dense and parser.parents[home][1] in WHOLE}
    if any(parser.parents[home][1] in WHOLE for home in content):  # what lies outside the articles is not the main text
        content = {home for home in content if parser.parents[home][1] in WHOLE}
    return " ".join(text for text, _, region in lines if homes[region] in content)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), sigma: float = 1.0) -> DataFrame:
    """``keep`` columns with text and n_chars (code points), one row per input row.

    Null and empty pages and pages without text give an empty text. Broken and unclosed markup is read as far as it goes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [main_text(x.as_py(), sigma) for x in part.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*part.schema.names[1:], "text", "n_chars"])

    own = pages.select(F.col(html_col).alias("_html"), *keep)
    schema = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keep)
    return own.mapInArrow(run, f"{schema}, text string, n_chars long")
