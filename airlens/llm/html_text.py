"""Main text of web pages by text-to-tag ratios (operator 2).

The standard library's parser streams events; text is gathered into lines,
one for each block element, each with the number of tags met in it.  The
ratio of text to tags is smoothed along the page by a Gaussian, and lines
above a threshold form the content cluster.  On every page the regions
(sections of the page) with at least half their text in content lines are
selected whole, so a short paragraph between long ones stays.  What the page
marks as its article has the threshold added to its level; a list or region
there whose text is mostly links has not, and lists of links are judged apart
from the region around them.

Regions that the page itself marks as furniture, by element, role or
attribute, are never selected.  Where such a mark was never closed, or wraps a
form or a hidden layout around the page, it yields if nearly all running text
is inside.  Words of class or id (not of the page's outer elements) mark
regions too: those for comments, adverts and notices always rule out, unless
the page's story itself, its article or headline, is inside; the others only
what the level of its own lines does not show to be running text.

Before the parser, comments, declarations and the contents of scripts go, and
tags are written anew with the few attributes that matter, in one pass whose
time is linear in the page whatever it holds.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U

# Element names of HTML, and words of class, id or role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody "
                  "td tfoot th thead tr ul".split())
REGION = frozenset("article aside body div footer form header main nav section".split())
FURNITURE = frozenset("aside button datalist dialog fieldset footer form head header iframe input label legend menu nav "
                      "noscript object option script select style svg template textarea title".split())
#: Of these, the ones that never hold a story, whatever they hold.
NEVER = frozenset("datalist iframe input noscript object option script select style svg template textarea title".split())
HEAD_ELEMENTS = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp".split())
CONTENT = frozenset("article main".split())
STORY = frozenset("article h1 main".split())
LISTS = frozenset("dl ol table ul".split())
#: Elements whose class and id say what is on the page, not what they are, and
#: words that within an article name its own head.
WORDLESS = frozenset("article body html main".split())
HEAD_WORDS = frozenset("header masthead".split())
#: Words of what is not the story even where it reads like one, and others.
APART_WORDS = frozenset("ad ads advert advertisement advertising adverts comment comments consent cookie cookies discussion "
                        "discussions disqus gdpr newsletter promo promoted replies reply sponsor sponsored subscribe".split())
FURNITURE_WORDS = APART_WORDS | frozenset("alert banner breadcrumb breadcrumbs footer form header masthead menu modal nav "
                                          "navbar navigation notice notices popup related share sidebar skip social toolbar "
                                          "widget".split())
FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                            "toolbar".split())
#: A paragraph ends where another block begins, with or without its end tag.
CLOSES_P = BLOCK - {"body", "html"}
SIGMA = 1.0
SPREAD = 0.5
#: Least characters per tag of running text.
RUNNING = 25.0


#: Least characters of a line of a story, and how much more of that a mark must
#: hold than the rest of the page to yield.
STORY_LINE, MOST = 60, 4

_OPEN = re.compile(r"<(!--|[!?]|/?[a-zA-Z]|/)")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_TAG_END = re.compile(r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']*+))?+""")
_USED = frozenset("aria-hidden class hidden id role".split())


def tidy(html: str) -> str:
    """The page without comments, declarations and the content of raw elements;
    tags carry the attributes that are read here and nothing else.

    What is cut off at the end of the page goes, as browsers have it: an open
    comment or an open tag takes the rest.  A raw element without an end tag is
    taken as an empty one.  No search is repeated over the same stretch: one
    that fails for the rest of the page is not tried again."""
    out: list[str] = []
    at, no_end = 0, set()
    while m := _OPEN.search(html, at):
        i = m.start()
        out.append(html[at:i])
        if m[1] == "!--":
            short = next((k for k in (">", "->") if html.startswith(k, i + 4)), None)
            end = i + 4 + len(short) if short else html.find("-->", i + 4) + 3
            if end < i + 4:
                return "".join(out)
        elif m[1] in "!?/":
            end = html.find(">", i) + 1
            if not end:
                return "".join(out)
        else:
            close = _TAG_END.match(html, i) if "quote" not in no_end else None
            if close is None:  # a quote that is never closed: the tag ends at its first mark
                no_end.add("quote")
            end = close.end() if close else html.find(">", i) + 1
            if not end:
                return "".join(out)
            name = _NAME.match(html, i)[1].lower()
            if html[i + 1] == "/":
                out.append(f"</{name}>")
            else:
                used = [f' {a[1].lower()}="{escape((a[2] or "").strip(QUOTES))}"' for a in
                        _ATTRIBUTE.finditer(html, name_end(html, i), end - 1) if a[1].lower() in _USED]
                out.append(f"<{name}{''.join(used)}>")
                if name in RAW:
                    out.append(f"</{name}>")
                    if name not in no_end:
                        last = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, end)
                        if last:
                            end = html.find(">", last.end()) + 1 or len(html)
                        else:
                            no_end.add(name)
        at = end
    out.append(html[at:])
    return "".join(out)


QUOTES = "\"'"


def name_end(html: str, i: int) -> int:
    return _NAME.match(html, i).end()


def _words(attrs: list) -> set[str]:
    """Words of class and id that name furniture."""
    return {w for name, value in attrs if value and name in ("class", "id")
            for w in value.lower().replace("_", " ").replace("-", " ").split()} & FURNITURE_WORDS


def _is_comment(attrs: list) -> bool:
    """A whole class that says so: some pages hold each comment as an article."""
    return any(name == "class" and {"comment", "reply"} & set((value or "").lower().split()) for name, value in attrs)


def _marked(attrs: list) -> bool:
    return any(name == "role" and (value or "").lower() in FURNITURE_ROLES or name == "hidden"
               or name == "aria-hidden" and value == "true" for name, value in attrs)


@dataclass
class Region:
    """A stretch of the page.  ``mark``: never, furniture, apart or word, what
    its own element or words make of it; ``declared``: inside an article or
    main; ``whole``: the region that a list is judged with, else itself;
    ``closed``: by its own end tag; ``wraps``: by attribute or as a form."""
    parent: int
    mark: str | None
    declared: bool
    whole: int
    wraps: bool = False
    closed: bool = False
    story: bool = False
    text: int = 0


class Lines(HTMLParser):
    """Lines [text, tags, region, characters in links] and regions."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.regions = [Region(-1, None, False, 0)]
        self.stack: list[tuple[str, int]] = []  # open element, region outside it
        self.open = Counter()  # how often each element is on the stack
        self.region = 0
        self.text: list[str] = []
        self.linked = 0
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append([text, self.tags, self.region, min(self.linked, len(text))])
            self.tags = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in HEAD_ELEMENTS and self.open["head"]:
            self._close("head")
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            if tag in CLOSES_P and self.open["p"]:
                self._close("p")
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a" and self.open["a"] and self.stack[-1][0] == "a":
            self._close("a")
        if tag in VOID:
            return
        self.stack.append((tag, self.region))
        self.open[tag] += 1
        here = self.regions[self.region]
        inside = here.declared
        by_attribute = tag not in ("body", "html") and _marked(attrs) and not (tag in CONTENT and not inside)
        words = ({"comment"} if tag == "article" and _is_comment(attrs) else set() if tag in WORDLESS
                 else _words(attrs) - (HEAD_WORDS if inside else set()))
        mark = ("never" if tag in NEVER else "furniture" if tag in FURNITURE and not (tag == "header" and inside) or by_attribute
                else "apart" if words & APART_WORDS else "word" if words else None)
        if mark or tag in REGION or tag in LISTS:
            self.end_line()
            part = tag in LISTS and not mark
            self.regions.append(Region(self.region, mark, inside or tag in CONTENT, here.whole if part else len(self.regions),
                                       by_attribute or tag == "form"))
            self.region = len(self.regions) - 1
        if tag in STORY and mark is None:
            self.regions[self.region].story = True

    def _close(self, tag: str) -> None:
        while self.stack:
            top, outside = self.stack.pop()
            self.open[top] -= 1
            if top == tag and self.region != outside:
                self.regions[self.region].closed = True
            self.region = outside
            if top == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not self.open[tag]:
            return
        if tag in BLOCK or tag in FURNITURE or self.stack[-1][0] != tag:
            self.end_line()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._close("head")
        self.text.append(data)
        if self.open["a"] and not self.open["h1"] and not self.open["h2"]:  # a headline may be a link to its own page
            self.linked += len(" ".join(data.split()))

    def close(self) -> None:
        super().close()
        self.end_line()


def ruled_out(page: Lines) -> list[str | None]:
    """For each region what rules it out: 'out' (never, furniture, apart),
    'word', or None; marks that wrap the story have yielded."""
    regions, n = page.regions, len(page.regions)
    for text, _, region, links in page.lines:
        if len(text) >= STORY_LINE:
            regions[region].text += len(text) - links
    inside, story = [r.text if r.mark != "never" else 0 for r in regions], [r.story for r in regions]
    for k in range(n - 1, 0, -1):  # children come after their parents
        if regions[k].mark != "never":
            inside[regions[k].parent] += inside[k]
            story[regions[k].parent] |= story[k]
    marks = [r.mark for r in regions]

    def state() -> list[str | None]:
        out: list[str | None] = []
        for r, mark in zip(regions, marks):
            own = {"never": "out", "furniture": "out", "apart": "out"}.get(mark, mark)
            above = out[r.parent] if r.parent >= 0 else None
            out.append("out" if "out" in (own, above) else own or above)
        return out

    may = [k for k in range(n) if marks[k] == "apart" or marks[k] == "furniture" and (regions[k].wraps or not regions[k].closed)]
    # A page has few such marks around all its text.
    for k in sorted([k for k in may if inside[k]], key=lambda k: (-inside[k], k))[:32]:
        out = state()
        left = sum(r.text for r, o in zip(regions, out) if o != "out")
        elsewhere = any(r.story for r, o in zip(regions, out) if o != "out")
        if marks[k] == "apart":
            wraps = story[k] and not elsewhere
        else:
            wraps = inside[k] > MOST * left and not elsewhere
        if wraps:
            marks[k] = None
    return state()


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; edges are weighed by the part of the kernel inside."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(values, kernel)[reach:reach + len(values)]
    return full / np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]


def main_lines(html: str, sigma: float = SIGMA, spread: float = SPREAD) -> list[str]:
    """Text of the selected blocks, in page order."""
    page = Lines()
    page.feed(tidy(html))
    page.close()
    if not page.lines:
        return []
    ratio = np.array([len(text) / max(tags, 1) for text, tags, _, _ in page.lines])
    level = smooth(ratio, sigma)
    bar = spread * level.std()

    size, linked = Counter(), Counter()
    for text, _, region, links in page.lines:
        size[region] += len(text)
        linked[region] += links
    links_only = {region for region, n in size.items() if 2 * linked[region] >= n}
    judged = {region: region if region in links_only else page.regions[region].whole for region in size}
    out = ruled_out(page)

    whole, hit, running = Counter(), Counter(), Counter()
    plain = max(bar, level.mean() / 2, RUNNING)
    for (text, _, region, _), at, own in zip(page.lines, level, ratio):
        if out[region] != "out":
            weight = bar if page.regions[region].declared and region not in links_only else 0.0
            whole[judged[region]] += len(text)
            hit[judged[region]] += len(text) * bool(at + weight >= bar)
            running[judged[region]] += len(text) * bool(min(at, own) >= plain)
    content = {region for region, n in whole.items() if 2 * hit[region] >= n}
    chosen = {region for region in content if out[region] != "word" or 2 * running[region] >= whole[region]}
    return [text for text, _, region, _ in page.lines if judged[region] in (chosen or content)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null and empty html give the empty text; markup that is cut off is read as
    far as it goes; repeated rows are extracted each for itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_lines(html.as_py())) for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(U.table(spark, sf_dir, "pages"))
