"""Main text of HTML pages.

The standard library's streaming parser yields the blocks of a page, one line each, with
their text, their tags and the containers they stand in.  The ratio of text to tags of
each line is smoothed with a Gaussian; a threshold found by clustering the smoothed
ratios in two tells content from the rest.  The content region is the innermost
container that holds all chosen lines, or all main parts if the page marks some, so a
short paragraph between long ones is kept.  Lists and tables are no regions.  Lines of
elements that are never content (menus, forms, notices ..) are left out beforehand.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and attribute names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset((
    "script style noscript template head title nav footer aside form button select textarea input "
    "iframe object svg math canvas audio video dialog menu"
).split())
BLOCKS = frozenset((
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th "
    "thead tr ul"
).split())
INLINE_END = frozenset("br wbr".split())
CONTAINERS = frozenset("html body article main section div td table header blockquote center ul ol dl".split())
#: Containers that are part of what stands around them, never a content region by themselves.
INNER = frozenset("td table ul ol dl".split())
MARKED = ("main", "article")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|sidebar|side-?nav|nav|navbar|navigation|menu|breadcrumbs?|"
    r"footer|masthead|site-?header|page-?header|comments?|comment-?list|disqus|repl(?:y|ies)|respond|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|toolbar|"
    r"widget|pagination|pager|skip-?link|copyright)(?=$|[\s_\d-])"
)
# Names of state, such as "comments-open" or "no-sidebar", say nothing about the element itself.
STATE = re.compile(
    r"(?:^|[_-])(?:no|has|with|without|open|closed|enabled|disabled|on|off)(?=$|[_-])")
HEADER = re.compile(r"(?:^|\s)(?:header|top-?bar|site-?title)(?=$|\s)")
SIGMA = 1.0
#: Elements nested deeper lie side by side at this depth, as in browsers; so a page takes linear time.
MAX_DEPTH = 512


class _Page(HTMLParser):
    """Collects lines ``(text, tags, containers)``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.kinds: list[str] = []  # of containers by number
        self.marked: dict[int, tuple[int, ...]] = {}  # outermost main elements or articles and their paths
        self.stack: list[tuple[str, bool, bool]] = []  # tag, silent, a container was opened
        self.path: list[int] = []
        self.deep: Counter[str] = Counter()  # open elements beyond the depth
        self.silent = 0
        self.parts: list[str] = []
        self.tags = 0

    def parse_marked_section(self, i, report=1) -> int:
        """A section ``<![..`` is a comment: one of character data up to its end, any other up to ``>``."""
        end = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        found = self.rawdata.find(end, i)
        return found + len(end) if found >= 0 else -1

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(1, self.tags), tuple(self.path)))
            self.tags = 0
        self.parts.clear()

    def handle_starttag(self, tag, attrs) -> None:
        if tag in VOID:
            self._void(tag)
            return
        named = dict(attrs)
        if tag in BLOCKS:
            self.flush()
            if tag in ("p", "li", "dt", "dd", "td", "th", "tr"):
                self._close_implied(tag)
        if len(self.stack) >= MAX_DEPTH and tag not in SILENT:
            self.deep[tag] += 1
            self.tags += not self.silent
            return
        quiet = tag in SILENT or self._noise(tag, named)
        container = tag in CONTAINERS
        if container:
            kind = tag
            if tag == "main" or named.get("role") == "main":
                kind = "main"
            elif tag == "article" or named.get("role") == "article" or named.get("itemprop") == "articleBody":
                kind = "article"
            inside = {self.kinds[i] for i in self.path}
            self.path.append(len(self.kinds))
            self.kinds.append(kind)
            if kind in MARKED and kind not in inside and not self._named_noise(named):
                self.marked[self.path[-1]] = tuple(self.path)
        self.stack.append((tag, quiet, container))
        self.silent += quiet
        self.tags += not self.silent

    def _void(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "hr":
            self.flush()
        self.tags += tag not in INLINE_END and not self.silent

    def _noise(self, tag: str, named: dict) -> bool:
        if tag in ("html", "body", "article", "main"):
            return False
        if "hidden" in named or named.get("aria-hidden") == "true" or named.get("role") in ROLES:
            return True
        label = f"{named.get('class') or ''} {named.get('id') or ''}".strip().lower()
        if (tag == "header" or HEADER.search(label)) and not any(
            self.kinds[i] in MARKED for i in self.path
        ):
            return True
        return self._named_noise(named)

    @staticmethod
    def _named_noise(named: dict) -> bool:
        label = f"{named.get('class') or ''} {named.get('id') or ''}".strip().lower()
        return any(NOISE.search(name) and not STATE.search(name) for name in label.split())

    def _close_implied(self, tag: str) -> None:
        """An open element of the same kind ends where the next begins."""
        stops = {"p": BLOCKS - {"p"}, "li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"},
                 "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}}[tag]
        for depth in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[depth][0]
            if open_tag == tag:
                self._pop_to(depth)
                return
            if open_tag in stops or open_tag in SILENT:
                return

    def _pop_to(self, depth: int) -> None:
        self.flush()
        while len(self.stack) > depth:
            _, quiet, container = self.stack.pop()
            self.silent -= quiet
            if container:
                self.path.pop()

    def handle_endtag(self, tag) -> None:
        if tag in VOID:
            self._void(tag)
            return
        self.tags += not self.silent
        if self.deep[tag]:
            self.deep[tag] -= 1
            if tag in BLOCKS:
                self.flush()
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[depth][0]
            if open_tag == tag:
                if tag in BLOCKS or tag in SILENT or any(
                    t in BLOCKS or t in SILENT for t, _, _ in self.stack[depth:]
                ):
                    self._pop_to(depth)
                else:
                    del self.stack[depth]
                return
            if open_tag in BLOCKS and tag not in BLOCKS and tag not in SILENT:
                break  # an inline end tag does not close the block around it
        if tag not in BLOCKS:
            self._drop_inline(tag)
        else:
            self.flush()

    def _drop_inline(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                self.silent -= self.stack[depth][1]
                del self.stack[depth]
                return

    def handle_data(self, data) -> None:
        if not self.silent:
            self.parts.append(data)

    def unknown_decl(self, data) -> None:
        """Character data sections hold markup of other languages."""


def _smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out, n = [], len(values)
    for i in range(n):
        low, high = max(0, i - reach), min(n, i + reach + 1)
        weights = kernel[low - i + reach: high - i + reach]
        out.append(sum(v * w for v, w in zip(values[low:high], weights, strict=True)) / sum(weights))
    return out


def _threshold(values: list[float]) -> float:
    """Between the two clusters of ``values`` (one-dimensional k-means)."""
    low, high = min(values), max(values)
    for _ in range(20):
        cut = (low + high) / 2
        under = [v for v in values if v < cut]
        over = [v for v in values if v >= cut]
        if not under:
            return low
        new = sum(under) / len(under), sum(over) / len(over)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _region(page: _Page, weight: dict[int, int], chosen: int) -> int | None:
    """The container of the content, None for the whole page.

    ``weight`` is the length of the chosen lines in each container.
    """
    held = Counter(container for _, _, path in page.lines for container in path)
    for kind in MARKED:  # what holds all parts
        parts = [path for i, path in page.marked.items() if page.kinds[i] == kind and held[i]]
        if not any(path[-1] in weight for path in parts):
            continue
        if len(parts) == 1:
            return parts[0][-1]
        ends = zip(min(parts), max(parts), strict=False)
        return max((i for i, j in ends if i == j and page.kinds[i] not in INNER), default=None)
    # Containers are numbered in the order they open: the last that holds all chosen lines is the
    # innermost.  One that holds a single line is that line, not a region.
    return max((i for i, w in weight.items() if w == chosen and held[i] > 1 and page.kinds[i] not in INNER),
               default=None)


def extract(html: str | None) -> str:
    """The main text of one page, '' if there is none.

    White space inside a block becomes one blank, blocks are joined by one blank in the
    order of the page.
    """
    page = _Page()
    page.feed(html or "")
    page.close()
    page.flush()
    lines = page.lines
    if not lines:
        return ""
    ratios = _smoothed([len(text) / tags for text, tags, _ in lines])
    cut = _threshold(ratios)
    weight: dict[int, int] = {}
    chosen = 0
    for (text, _, path), ratio in zip(lines, ratios, strict=True):
        if ratio >= cut:
            chosen += len(text)
            for container in path:
                weight[container] = weight.get(container, 0) + len(text)
    region = _region(page, weight, chosen)
    return " ".join(text for text, _, path in lines if region is None or region in path)


def _run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html) for html in batch["html"].to_pylist()]
        yield pa.record_batch({
            "page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64()),
        })


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``; null html gives ''.

    Rows that repeat an id or a page each give a row, an empty table none; other columns
    are not read.  Whatever is no well-formed markup is read as browsers do or left out.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_run, f"page_id {kind}, url string, text string, n_chars long")
