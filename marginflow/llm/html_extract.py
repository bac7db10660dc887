"""Main text of web pages by tag-path ratios.

Every run of text is a leaf under a path of tags from the root. Per page and
path, the leaves' characters and punctuation marks are added up and divided by
the number of leaves; both ratios, laid out in page order, are smoothed by a
Gaussian, fused, and averaged per path again. Paths whose fused ratio reaches a
share of the page's standard deviation are content paths, their leaves content
leaves. The region that holds the content leaves is the article: its blocks are
returned, also headings and short paragraphs whose own path is below the
threshold, but not lists that are links only.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
readers' comments are no leaves: they are told by tag, role, or the words of
class and id.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_CHARS = 4 << 20    # text characters of one batch that goes back to Spark
TAG_RETRIES = 4          # tags without an end outside quotes are looked for until they cost so many readings of the page

DEVIATIONS = 0.5         # a content path's fused ratio is at least so many standard deviations of the page's
RADIUS = 1               # Gaussian smoothing over this many leaves to each side
REGION_SHARE = 0.9       # the region is the deepest box with this share of the content leaves' text
SEMANTIC_SHARE = 0.5     # ... but an article or main element with this share of it is taken first

# Element names and words as HTML and common templates use them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
BOX = frozenset("html body div section article main center table tbody tr td span".split())
NEVER = frozenset(
    "head nav footer aside form script style noscript template iframe object svg canvas audio video button select "
    "textarea dialog menu title noembed noframes xmp search".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs colophon "
    "comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices overlay pager pagination popup promo promotion recommended related replies reply respond "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
HEADER_WORDS = frozenset(["header"])
STATE_FIRST = frozenset(["has", "with", "no", "without", "is", "show", "hide", "js"])
STATE_LAST = frozenset(["open", "closed", "enabled", "disabled", "on", "off"])
CLOSED_BY = {  # a start tag ends an open element of these names, unless one of the fences was opened after it
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
MARKS = ".,;:!?…。，、；：！？"

_OPEN = re.compile(r"<(?:!--|[!?]|/?[A-Za-z]|/)")
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*+)")
_TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.IGNORECASE) for n in RAW}


def _side_words(value: str) -> set[str]:
    """The boilerplate words among a class or id attribute's tokens; states (has-sidebar, comments-open) are none."""
    out: set[str] = set()
    for token in value.split():
        parts = [p.lower() for p in _PART.findall(token)]
        if parts and parts[0] not in STATE_FIRST and parts[-1] not in STATE_LAST:
            out.update(WORDS.intersection(parts))
    return out


class _Tree:
    """Elements of a page (parent, name, path, marks) and its leaves (element, block, text)."""

    def __init__(self, page: str):
        self.parent, self.name, self.path = [-1], ["#"], [0]
        self.side = [False]      # told to be boilerplate by class, id, role or hidden
        self.header = [False]    # ... only as a header, which an article may have of its own
        self.leaves: list[tuple[int, int, str]] = []
        self.block = 0
        self._paths: dict[tuple[int, str], int] = {}
        self._stack = [0]
        self._at: dict[str, list[int]] = {}  # name -> places in the stack
        self._read(page)

    def _pop_to(self, place: int) -> None:
        for el in self._stack[place:]:
            self._at[self.name[el]].pop()
            if self.name[el] in BLOCK:
                self.block += 1
        del self._stack[place:]

    def _text(self, text: str) -> None:
        if text and not text.isspace():
            self.leaves.append((self._stack[-1], self.block, text))
        elif text and self.leaves:
            self.leaves.append((self._stack[-1], self.block, " "))

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK and self._at.get("p"):
            self._pop_to(self._at["p"][-1])
        if name in CLOSED_BY:
            ends, fences = CLOSED_BY[name]
            last = max((self._at[x][-1] for x in ends if self._at.get(x)), default=-1)
            if last > max((self._at[x][-1] for x in fences if self._at.get(x)), default=-1):
                self._pop_to(last)
        if name in BLOCK:
            self.block += 1
        if name == "br":
            self._text(" ")
        if name in VOID:
            return
        up = self._stack[-1]
        el = len(self.name)
        self.parent.append(up)
        self.name.append(name)
        self.path.append(self._paths.setdefault((self.path[up], name), len(self._paths) + 1))
        side = header = False
        if "=" in attributes or "hidden" in attributes:
            for key, value in _ATTR.findall(attributes):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id"):
                    words = _side_words(value)
                    header |= bool(words & HEADER_WORDS)
                    side |= bool(words - HEADER_WORDS)
                elif key == "role" and value.lower() in ROLES:
                    side = True
                elif key == "hidden" or key == "aria-hidden" and value == "true":
                    side = True
                elif key == "style" and "display:none" in value.replace(" ", "").lower():
                    side = True
        self.side.append(side)
        self.header.append(header or name == "header")
        self._at.setdefault(name, []).append(len(self._stack))
        self._stack.append(el)

    def _end(self, name: str) -> None:
        if self._at.get(name):
            self._pop_to(self._at[name][-1])
        elif name == "br":
            self._text(" ")
        elif name == "p":
            self.block += 1

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        last_close = page.rfind(">")
        spare = TAG_RETRIES * n
        while at < n:
            m = _OPEN.search(page, at)
            if m is None:
                self._text(page[at:])
                return
            self._text(page[at:m.start()])
            at = m.start()
            what = m.group()
            if what == "<!--":
                end = page.find("-->", at + 4)
                at = n if end < 0 else end + 3
                continue
            if at > last_close:
                return  # a tag that the page's end cuts off
            if what in ("<!", "<?", "</"):
                at = page.find(">", at) + 1
                continue
            found = _NAME.match(page, at)
            name = found[1].lower()
            end = _TAG_END.match(page, found.end()) if spare > 0 else None
            spare -= 0 if end else n - at
            to = end.end() if end else page.find(">", found.end()) + 1
            if page[at + 1] == "/":
                self._end(name)
            else:
                self._start(name, page[found.end():to - 1])
                if name in RAW:
                    close = _RAW_END[name].search(page, to)
                    to = n if close is None else close.start()
            at = to


def _kept(tree: _Tree) -> list[bool]:
    """Which elements are no boilerplate.

    Class words do not exclude a box that holds a plain article, main or h1
    and half of the page's text: such words describe the page, not the box.
    """
    n = len(tree.name)
    size, holds = [0] * n, [False] * n
    for el, _, text in tree.leaves:
        if tree.name[el] not in NEVER:
            size[el] += len(text)
    for el in range(n - 1, 0, -1):
        name, up = tree.name[el], tree.parent[el]
        if name in ("article", "main", "h1") and not tree.side[el]:
            holds[el] = True
        if name not in NEVER:
            size[up] += size[el]
            holds[up] |= holds[el]
    keep, inside = [True] * n, [False] * n  # inside: within an article or main element
    for el in range(1, n):
        name, up = tree.name[el], tree.parent[el]
        keep[el] = keep[up] and name not in NEVER
        inside[el] = inside[up] or name in ("article", "main") and not tree.side[el]
        if keep[el] and name not in ("html", "body"):
            told = tree.side[el] or tree.header[el] and not inside[up]
            keep[el] = not told or tree.header[el] is False and holds[el] and 2 * size[el] >= size[0]
    return keep


def _smooth(values: list[float], radius: int) -> list[float]:
    kernel = [math.exp(-0.5 * (d / max(radius, 1)) ** 2) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - radius), min(len(values), i + radius + 1)
        weights = kernel[lo - i + radius:hi - i + radius]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


def content_paths(paths: list[int], texts: list[str], deviations: float = DEVIATIONS,
                  radius: int = RADIUS) -> dict[int, float]:
    """path -> fused ratio, of the paths that reach the threshold. ``paths`` and ``texts`` are the leaves in page order."""
    total: dict[int, list[float]] = {}
    for p, t in zip(paths, texts):
        of = total.setdefault(p, [0, 0, 0])
        of[0] += len(t)
        of[1] += sum(map(t.count, MARKS))
        of[2] += 1
    chars = _smooth([total[p][0] / total[p][2] for p in paths], radius)
    marks = _smooth([total[p][1] / total[p][2] for p in paths], radius)
    fused = [c * (1 + m) for c, m in zip(chars, marks)]
    if not fused:
        return {}
    mean = sum(fused) / len(fused)
    least = deviations * math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    of_path: dict[int, float] = {}
    for p, f in zip(paths, fused):
        of_path[p] = of_path.get(p, 0) + f / total[p][2]
    return {p: f for p, f in of_path.items() if f >= least}


def _region(tree: _Tree, weight: list[int]) -> int:
    """The element whose blocks are the article, given the content characters under each element."""
    total = weight[0]
    children: dict[int, list[int]] = {}
    for el in range(1, len(weight)):
        if weight[el]:
            children.setdefault(tree.parent[el], []).append(el)
    for name in ("article", "main"):
        best = max((el for el in range(1, len(weight)) if tree.name[el] == name), key=lambda e: (weight[e], -e), default=0)
        if best and weight[best] >= SEMANTIC_SHARE * total:
            if name == "article":
                while True:  # the outermost article counts: others within it are its parts
                    up = tree.parent[best]
                    while up > 0 and tree.name[up] != "article":
                        up = tree.parent[up]
                    if up <= 0:
                        return best
                    best = up
            return best
    at = 0
    while True:
        best = max(children.get(at, ()), key=lambda e: weight[e], default=0)
        if not best or tree.name[best] not in BOX or weight[best] < REGION_SHARE * total:
            return at
        at = best


def _with_heading(tree: _Tree, keep: list[bool], region: int) -> int:
    """The region, or the box around it (below body) that holds the page's first h1."""
    heading = next((el for el in range(len(tree.name)) if tree.name[el] == "h1" and keep[el]), 0)
    around, el = set(), heading
    while el > 0:
        around.add(el)
        el = tree.parent[el]
    if not heading or tree.name[region] in ("article", "main", "body", "html", "#") or region in around:
        return region
    up = tree.parent[region]
    return up if up in around and tree.name[up] not in ("body", "html", "#") else region


def main_text(page: str) -> str:
    """The article of one page: blocks in page order, one per line; empty if there is none."""
    tree = _Tree(page)
    keep = _kept(tree)
    leaves = [(el, block, _html.unescape(text)) for el, block, text in tree.leaves if keep[el]]
    solid = [(el, text) for el, _, text in leaves if not text.isspace()]
    good = content_paths([tree.path[el] for el, _ in solid], [" ".join(t.split()) for _, t in solid])
    weight = [0] * len(tree.name)
    for el, text in solid:
        if tree.path[el] in good:
            weight[el] += len(text)
    for el in range(len(weight) - 1, 0, -1):
        weight[tree.parent[el]] += weight[el]
    if not weight[0]:
        return ""
    region = _with_heading(tree, keep, _region(tree, weight))
    within, linked, listed = [False] * len(tree.name), [False] * len(tree.name), [False] * len(tree.name)
    within[region] = True
    for el in range(1, len(tree.name)):
        up, name = tree.parent[el], tree.name[el]
        within[el] |= up >= 0 and within[up]
        linked[el] = linked[up] or name == "a"
        listed[el] = listed[up] or name == "li"
    blocks: dict[int, list] = {}
    for el, block, text in leaves:
        if within[el]:
            of = blocks.setdefault(block, [[], False])
            of[0].append(text)
            # a list entry that is a link and nothing else, off the content paths, belongs to a menu
            of[1] |= not text.isspace() and not (linked[el] and listed[el] and tree.path[el] not in good)
    lines = (" ".join("".join(parts).split()) for parts, counts in blocks.values() if counts)
    return "\n".join(line for line in lines if line)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, size = [], 0
        for page_id, url, page in zip(*batch.columns):
            text = main_text(page.as_py() or "")
            rows.append((page_id.as_py(), url.as_py(), text, len(text)))
            size += len(text)
            if size >= BATCH_CHARS:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Null html counts as empty; empty, blank and markup-only pages give an empty
    text. Pages are read whole, in time linear in their length: where quotes
    never close, a tag ends at the next ">". What an unclosed comment or script
    holds is no text. Null ids and urls are kept, repeated rows each give a
    row, other columns are ignored, an empty table gives no rows. No shuffle.
    """
    rows = pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url",
                            "cast(html as string) as html")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
