"""The main text of web pages by tree scoring.

One pass over the tags of a page builds the tree of its block elements, closing what authors
leave open as browsers do. Paragraphs then pass points, for their length and their commas, to
the elements around them: all to the parent, half to the next, ever less further up. The
points of an element are discounted by the share of its text that lies in links. The best
element is the container; it and those of its siblings that also hold prose are kept, but for
parts that by tag, role or name are menus, notices, adverts, comments and the like, and for
lists made of links.

A page is worked on whole and alone: no shuffle, and time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Characters of text that a task holds back before it hands a batch on.
BATCH_CHARS = 4_000_000
# Elements open at once, as browsers bound them too; deeper ones only break the text.
MOST_OPEN = 256

# Element names of the markup language by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "audio button canvas datalist head iframe math meter noembed noframes noscript object progress "
    "script select style svg template textarea title video xmp".split()
)
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
# Start tags that end an open element: of these names, unless one of the second lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th", "caption"), ("table", "tr")),
    "th": (("td", "th", "caption"), ("table", "tr")),
    "tr": (("tr", "caption"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption"), ("table",)),
}
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())
# Parts that are no text of an article: by tag, by role, by a word of their class or id.
SIDE_TAGS = frozenset("aside dialog fieldset footer form header menu nav search".split())
SIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar tooltip".split()
)
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot aside banner breadcrumb breadcrumbs "
    "comment comments cookie cookies consent disqus disclaimer footer form gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices overlay pager pagination paywall popup promo promoted promotion recommended related "
    "replies reply respond rail share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe "
    "subscription survey teaser toolbar topbar trending widget widgets".split()
)
# Names with one of these only tell that something is, or is not, there.
ABOUT = frozenset("allow disabled enabled has layout no open with without".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPHS = frozenset(("p", "pre", "blockquote", "li", "dd", "dt"))
PROSE = frozenset(("p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure"))
LISTS = frozenset(("ul", "ol", "dl", "div", "section", "table"))
# What the parent, the element around it and those further up get of a paragraph's points.
SHARES = (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12, 1 / 15)
# Points that an element starts with.
START = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "th": -5}

# Every repetition is possessive, so that a tag costs its length and no more.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|"
    r"""<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""",
    re.DOTALL,
)
PLAIN_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
COMMAS = re.compile("[,،、，]")
SENTENCE = re.compile("[.!?。！？…][\"'”’»)\\]]*$")


def _aside(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is by its own mark no text of an article."""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        return True
    if tag in SIDE_TAGS or attributes.get("role", "").lower() in SIDE_ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {word.lower() for word in WORD.findall(name)}
        if words & SIDE_WORDS and not words & ABOUT:
            return True
    return False


class Page:
    """Block elements of a page in document order, each after its parent, and its blocks of
    text. Element 0 is the page itself."""

    def __init__(self, html: str):
        self.tags, self.parents, self.asides = [""], [-1], [False]
        # Of each block: its element, its text, how much of it is links, how many links.
        self.blocks: list[tuple[int, str, int, int]] = []
        self._ends: dict[str, dict[int, int]] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        open_elements = [0]
        counts: dict[str, int] = {}
        deeper: dict[str, int] = {}
        pieces: list[str] = []
        linked: list[str] = []
        links = 0
        link_at = None  # how many elements were open when the open link began

        def flush() -> None:
            nonlocal links
            if text := " ".join("".join(pieces).split()):
                in_links = len(" ".join("".join(linked).split()))
                self.blocks.append((open_elements[-1], text, min(in_links, len(text)), links))
            pieces.clear()
            linked.clear()
            links = 1 if link_at is not None else 0

        def say(text: str) -> None:
            if "&" in text:
                text = unescape(text)
            pieces.append(text)
            if link_at is not None:
                linked.append(text)

        def pop() -> None:
            nonlocal link_at
            counts[self.tags[open_elements.pop()]] -= 1
            if link_at is not None and len(open_elements) < link_at:
                link_at = None

        def close(names: tuple[str, ...], behind: tuple[str, ...]) -> None:
            """End the innermost of some elements, with all that is open in it."""
            if any(counts.get(name) for name in names):
                for at in range(len(open_elements) - 1, 0, -1):
                    tag = self.tags[open_elements[at]]
                    if tag in names:
                        while len(open_elements) > at:
                            pop()
                        return
                    if tag in behind:
                        return

        at, tokens = 0, TOKEN
        while (start := html.find("<", at)) >= 0:
            match = tokens.match(html, start)
            if not match and tokens is TOKEN and html[start + 1 : start + 2].isalpha() | html.startswith("</", start):
                # A quote that never ends: from here on a tag ends at the next bracket.
                tokens = PLAIN_TOKEN
                match = tokens.match(html, start)
                if not match and html.find(">", start) < 0:
                    break
            if start > at:
                say(html[at:start])
            if not match:
                say("<")
                at = start + 1
                continue
            at = match.end()
            if not (name := match["name"]):
                continue
            name = name.lower()
            if match["end"]:
                if name == "a":
                    link_at = None
                elif name in BLOCKS:
                    flush()
                    if deeper.get(name):
                        deeper[name] -= 1
                        continue
                    close((name,), () if name == "table" else ("table",) if name in TABLE_PARTS else ("td", "th", "caption"))
                elif name == "br":
                    say(" ")
                continue
            if name in SILENT:
                at = self._after(html, match, name)
                continue
            if name == "a":
                link_at = None
                if "href" in match["rest"].lower():
                    link_at = len(open_elements)
                    links += 1
            elif name in ("br", "hr"):
                flush() if name == "hr" else say(" ")
            elif name in BLOCKS:
                flush()
                if name in ("html", "body") and counts.get(name):
                    continue
                if name not in TABLE_PARTS or name == "table":
                    close(("p",), ("td", "th", "caption", "table"))
                if name in ENDS:
                    close(*ENDS[name])
                elif name in HEADINGS and self.tags[open_elements[-1]] in HEADINGS:
                    pop()
                if len(open_elements) >= MOST_OPEN:
                    deeper[name] = deeper.get(name, 0) + 1
                    continue
                self.tags.append(name)
                self.parents.append(open_elements[-1])
                attributes = {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(match["rest"])}
                self.asides.append(_aside(name, attributes))
                open_elements.append(len(self.tags) - 1)
                counts[name] = counts.get(name, 0) + 1
            elif name not in VOID and match["rest"] and HIDDEN.search(match["rest"]):
                at = self._after(html, match, name)
        say(html[at:])
        flush()

    def _after(self, html: str, match: re.Match, name: str) -> int:
        """Where the content of a silent element ends: raw text at the first end tag, other
        elements at the end tag that belongs to them."""
        if name in RAW:
            found = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.IGNORECASE).search(html, match.end())
            return found.end() if found else len(html)
        if name not in self._ends:
            # All elements of that name are paired at once: looking for each end alone could
            # read the page once per element.
            self._ends[name], begun = {}, []
            for tag in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>])", html, re.IGNORECASE):
                if not tag[1]:
                    begun.append(tag.start())
                elif begun:
                    end = html.find(">", tag.end())
                    self._ends[name][begun.pop()] = end + 1 if end >= 0 else len(html)
        # One that never ends, or ends itself, is empty.
        return match.end() if match["rest"].endswith("/") else self._ends[name].get(match.start(), match.end())


def _sums(page: Page, values: list[float]) -> list[float]:
    """Values of each element's subtree."""
    for node in range(len(values) - 1, 0, -1):
        values[page.parents[node]] += values[node]
    return values


def _dead(page: Page) -> list[bool]:
    """Elements inside a part that is no text of an article.

    What holds the page's main element, or as a form its article, is none of these; nor is the
    head of an article."""
    count = len(page.tags)
    mains = _sums(page, [float(tag == "main") for tag in page.tags])
    articles = _sums(page, [float(tag == "article" and not aside) for tag, aside in zip(page.tags, page.asides, strict=True)])
    inside = [False] * count
    dead = [False] * count
    for node in range(1, count):
        parent, tag = page.parents[node], page.tags[node]
        inside[node] = tag == "article" or inside[parent]
        spared = mains[node] or (tag == "form" and articles[node]) or (tag == "header" and inside[parent])
        dead[node] = dead[parent] or (page.asides[node] and not spared)
    return dead


def _points(text: str) -> float:
    return 1 + len(COMMAS.findall(text)) + min(len(text) // 100, 3)


def main_text(html: str) -> str:
    """The main text of one page, blocks joined by a space."""
    page = Page(html)
    count = len(page.tags)
    dead = _dead(page)
    alive = [not dead[block[0]] for block in page.blocks]
    blocks = list(compress(page.blocks, alive))
    if not blocks:
        return ""

    chars, in_links, links, ends = ([0.0] * count for _ in range(4))
    own = [0.0] * count  # points passed on to an element
    for node, text, linked, number in blocks:
        chars[node] += len(text)
        in_links[node] += linked
        links[node] += number
        ends[node] += bool(SENTENCE.search(text))
        points = _points(text) * (1 - linked / len(text))
        # The block of an element that has blocks beside it scores for the element itself.
        at = page.parents[node] if page.tags[node] in PARAGRAPHS else node
        for share in SHARES:
            if at < 0:
                break
            own[at] += points * share
            at = page.parents[at]
    chars, in_links, links, ends = (_sums(page, values) for values in (chars, in_links, links, ends))

    def density(node: int) -> float:
        return in_links[node] / chars[node] if chars[node] else 0.0

    scores = [(own[n] + START.get(page.tags[n], 0)) * (1 - density(n)) if own[n] and not dead[n] else 0.0 for n in range(count)]
    best = max(range(count), key=scores.__getitem__)
    if scores[best] <= 0:
        best = next((n for n in range(count) if page.tags[n] in MAIN and not dead[n] and chars[n]), -1)
        if best < 0:
            return ""
    around = best
    while around > 0 and page.tags[around] not in MAIN:
        around = page.parents[around]
    parent = page.parents[best]
    kept = [False] * count
    kept[around or best] = True
    if around <= 0 and parent >= 0:
        bound = max(10.0, 0.2 * scores[best])
        for node in range(1, count):
            if page.parents[node] == parent and not dead[node] and chars[node] and density(node) < 0.25:
                prose = page.tags[node] in PROSE and (chars[node] >= 80 or ends[node])
                heading = page.tags[node] in HEADINGS and node < best
                kept[node] |= scores[node] >= bound or prose or heading
    for node in range(1, count):
        inherited = kept[page.parents[node]]
        # Lists, tables and boxes made of links are menus.
        menu = inherited and page.tags[node] in LISTS and links[node] >= 3 and density(node) > 0.6
        kept[node] = (kept[node] or inherited) and not dead[node] and not menu

    def is_kept(node: int, text: str, linked: int) -> bool:
        # Loose text beside the container counts if it reads like prose.
        return kept[node] or (node == parent and around <= 0 and linked < 0.25 * len(text) and bool(SENTENCE.search(text)))

    return " ".join(text for node, text, linked, _ in blocks if is_kept(node, text, linked))


def _extract(place: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, texts = 0, 0, []
            for row, value in enumerate(batch.column(place)):
                texts.append(main_text(value.as_py() or ""))
                held += len(texts[-1])
                if held > BATCH_CHARS or row == batch.num_rows - 1:
                    part = batch.slice(start, row + 1 - start)
                    columns = [c for i, c in enumerate(part.columns) if i != place]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)
                    start, held, texts = row + 1, 0, []

    return run


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the main text in place of the html column, in a column named `text` (an older
    column of that name goes).

    Character references are decoded; white space (that of Unicode) inside a block becomes one
    space; blocks follow each other in page order, joined by one space. Null, empty and
    textless pages give an empty text. Repeated rows are judged alike; other columns, null or
    not, are passed on. An empty table gives an empty one.
    """
    rest = [c for c in pages.columns if c not in (html, text)]
    rows = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html).cast("string").alias("__html"))
    schema = StructType([*rows.schema.fields[:-1]]).add(text, StringType())
    return rows.mapInArrow(_extract(len(rest), schema.names), schema)
