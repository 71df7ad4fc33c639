"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each with its root-to-leaf path of tags. Text lengths and punctuation are
aggregated for each path and smoothed along the page; paths fuse into the container that holds them, and an
article or main element fuses all that is inside it. All articles and main elements are content; so are containers whose
score, in all or a block, reaches a share of the best one's and, on pages without an article or main element, whatever lies within the element
around all of those (around the best one at least), short as it may be, unless it consists of links. What by its element, role or class is a menu, header, footer, sidebar, notice, advert,
form, script, style or reader comment never takes part; but a name alone does not leave out an element that holds the
page's article or main element, or all but a small part of its score.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from genoframe.llm.workers import tidy

#: Pages in a returned Arrow batch.
BATCH = 512
#: A container's share of the best score from which its blocks are content; the weight of article and main elements.
THRESHOLD, SEMANTIC = 0.2, 20.0
#: Smoothing of a path's ratios over its neighbours on the page.
KERNEL = (0.25, 0.5, 0.25)
#: Shares of letters within links from which a container consists of links, and behind the best container; words of a signature.
LINKED, LINKED_BEHIND, SIGNATURE = 0.6, 0.3, 4

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
#: The rest of a tag whose quotes are closed. Nothing is given back, so a failed attempt reads each letter once.
_REST = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PUNCTUATION = re.compile(r"[.,;:!?。、，；：！？]")
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text belongs to the container around them.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table thead tbody tfoot tr td th caption figure figcaption hgroup address details summary center".split())
SKIPPED = frozenset("nav footer aside form script style noscript template textarea title head iframe button select svg object audio video canvas dialog menu input label fieldset noembed noframes".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar sidenav aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist respond reply replies disqus share sharing social related recommended widget toolbar pagination pager login signup search".split()
)
HEADER_NAMES = frozenset(("header", "topbar"))
COMMENT_NAMES = frozenset("comment comments commentlist respond reply replies disqus".split())
#: Names that no share of the score outweighs.
SURE_NAMES = COMMENT_NAMES | frozenset("ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr".split())
#: A name of several words is that of its last word (but no widget), or of its first word if the others are parts of one ...
PARTS = frozenset(
    "area bar block body bottom box button buttons col column container content form group icons inner item items left link links list outer panel placeholder policy posts primary region right secondary section slot text title top unit wrap wrapper".split()
)
#: ... and says nothing of the element when it tells a state.
STATES = frozenset("disable disabled enable enabled has have hide is js no non not show toggle with without".split())
#: Start tags that end an open element of the same family, down to the listed borders.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class Block(NamedTuple):
    text: str
    path: int  # number of the tag path
    container: int  # number of the path of the container
    root: int  # number of the outermost article or main element around it, 0 outside
    linked: int  # characters within links
    named: int  # number of the innermost element around it that has a name of SKIPPED_NAMES, 0 outside
    item: int  # number of the container element itself
    heading: bool


class _Named(NamedTuple):
    around: int  # number of the named element around it
    sure: bool


class _Open(NamedTuple):
    tag: str
    path: int
    container: int
    skipped: bool
    root: int
    link: bool
    header: bool
    named: int
    item: int


_NONE: frozenset[str] = frozenset()


def _names(found: dict[str, str]) -> set[str]:
    """What the class and id of an element call it."""
    out = set()
    for token in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w for w in re.split(r"[^a-z0-9]+", token) if w]
        if len(words) == 1:
            out.add(words[0])
        elif words and words[0] not in STATES:
            if words[-1] != "widget":
                out.add(words[-1])
            if all(w in PARTS or w in SKIPPED_NAMES for w in words[1:]):
                out.add(words[0])
    return out


def _own(tag: str, attributes: str) -> tuple[str, bool, frozenset[str]]:
    """(an element's label in paths, whether it is left out by itself, names that may leave it out)."""
    if not attributes or attributes.isspace():
        return tag, tag in SKIPPED, _NONE
    found: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(attributes):
        found.setdefault(k.lower(), v.strip("\"'").lower())  # the first of a name holds
    names = _names(found)
    label = tag + "".join(f".{n}" for n in found.get("class", "").split()) + (f"#{found['id']}" if found.get("id") else "")
    if tag in ("html", "body", "article", "main"):
        return label, False, frozenset(names & {"comment", "comments", "reply"}) if tag == "article" else _NONE
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    named = frozenset(names & (SKIPPED_NAMES | HEADER_NAMES if tag in ("div", "section", "table", "td") else SKIPPED_NAMES))
    return label, tag in SKIPPED or hidden or found.get("role") in SKIPPED_ROLES, named


#: Elements repeat on a page and over pages; what is remembered is bounded in number and length.
_own_known = functools.lru_cache(maxsize=4096)(_own)


def _skips(tag: str, attributes: str, above: _Open | None) -> tuple[bool, str, bool, frozenset[str]]:
    """(whether the element is left out, its label in paths, whether it is a header within an article, names that may leave it out)."""
    label, skipped, named = (_own_known if len(attributes) < 256 else _own)(tag, attributes)
    if above is not None and above.skipped and not (above.header and tag in HEADINGS):
        return True, label, above.header, _NONE
    if tag == "header":
        return True, label, bool(above and above.root), _NONE
    return skipped, label, False, named


def blocks(page: str) -> list[Block]:
    """Blocks of text that may be content, in page order."""
    return _candidates(page)[0]


def _candidates(page: str) -> tuple[list[Block], list[int], list[tuple[str, int]]]:
    """(blocks, the path around each path, tag and named element of each article and main element)."""
    out, named, homes, around = _read(page)
    if not any(b.named for b in out):
        return out, around, homes
    kept = _outweighed(out, named, homes)
    return [b for b in out if kept[b.named]], around, homes


def _outweighed(found: list[Block], named: list[_Named], homes: list[tuple[str, int]]) -> list[bool]:
    """Which named elements, by number, are read all the same.

    Those that hold a main element, or an article where none is outside of named elements, or so much of the score of the
    page that what is outside of named elements stays below the threshold; and all named elements around them are read too.
    """
    n = len(named)
    sure = [x.sure for x in named]
    # articles and main elements, scores, characters and linked characters: of each named element alone
    own = [[0.0] * 5 for _ in range(n)]
    for root in {b.root for b in found if b.root}:
        tag, home = homes[root]
        own[home][0] += 1
        own[home][1] += tag == "main"
    for k in range(1, n):
        sure[k] |= sure[named[k].around]
    if not all(sure[1:]):
        for b, score in zip(found, _block_scores(found), strict=True):
            if not sure[b.named]:
                own[b.named] = [x + y for x, y in zip(own[b.named], (0, 0, score, len(b.text), b.linked), strict=True)]
    inside, outside = [x.copy() for x in own], [[0.0] * 5 for _ in range(n)]
    for k in range(n - 1, 0, -1):
        inside[named[k].around] = [x + y for x, y in zip(inside[named[k].around], inside[k], strict=True)]
    kept = [True] * n
    for k in range(1, n):
        around = named[k].around
        outside[k] = [x + y for x, y in zip(outside[around], own[around], strict=True)]
        articles, mains, score, chars, linked = inside[k]
        most = not sure[k] and chars > 0 and outside[k][2] < THRESHOLD * score and linked < LINKED * chars
        kept[k] = kept[around] and (mains > 0 or (articles > 0 and not outside[k][0]) or most)
    return kept


class _Stack:
    """Open elements; where the last one of each tag and the last block is known without a walk, so deep pages are read in linear time."""

    def __init__(self) -> None:
        self.open: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, x: _Open) -> None:
        self.places.setdefault(x.tag, []).append(len(self.open))
        if x.tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(x)

    def cut(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def last(self, tags) -> int:
        """Depth of the innermost open element of ``tags``, -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def top(self) -> _Open | None:
        return self.open[-1] if self.open else None


def _read(page: str) -> tuple[list[Block], list[_Named], list[tuple[str, int]], list[int]]:
    """(blocks; named elements by number; tag and named element around it of each article and main element by number; the
    path around each path, by number: 0 is the page, and a path's number is above that of the one around it)."""
    out: list[Block] = []
    named, homes = [_Named(0, False)], [("", 0)]
    paths: dict[tuple[int, str], int] = {}
    around = [-1]
    stack = _Stack()
    parts: list[str] = []
    roots = linked = items = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack.top()
                out.append(Block(text, top.path, top.container, top.root, linked, top.named, top.item, top.tag in HEADINGS) if top else Block(text, 0, 0, 0, linked, 0, 0, False))
            parts.clear()
        linked = 0

    def text(start: int, end: int) -> None:
        nonlocal linked
        top = stack.top()
        if end > start and not (top and top.skipped):
            part = page[start:end]
            parts.append(entities.unescape(part) if "&" in part else part)  # a reference ends with its part
            if top and top.link:
                linked += end - start

    def close(depth: int) -> None:
        flush()
        stack.cut(depth)

    at, n, loose = 0, len(page), 0
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            text(at, n)
            break
        m = _NAME.match(page, begin)
        if m is None:
            if page.startswith(("<!", "<?"), begin):
                text(at, begin)
                end = page.find("-->", begin + 4) if page.startswith("<!--", begin) else page.find(">", begin)
                at = n if end < 0 else end + (3 if page.startswith("<!--", begin) else 1)
            else:  # a lone <
                text(at, begin + 1)
                at = begin + 1
            continue
        text(at, begin)
        end = _REST.match(page, m.end()).end() if begin >= loose else -1
        if end < 0 or end >= n or page[end] != ">":  # a quote is open to the end: up to there quotes are letters
            loose = max(loose, end)
            end = page.find(">", m.end())
            end = n if end < 0 else end
        tag, attributes = m[1].lower(), page[m.end() : end]
        at = end + 1
        if page[begin + 1] == "/":  # an end tag
            depth = stack.last((tag,))
            if depth >= 0 and tag in BLOCK:
                close(depth)
            elif depth >= 0 and not (stack.blocks and stack.blocks[-1] > depth):
                stack.cut(depth)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            if stack.blocks and stack.open[stack.blocks[-1]].tag == "p":  # a block ends an open paragraph
                close(stack.blocks[-1])
            family, border = CLOSES.get(tag, ((), ()))
            depth = stack.last(family)
            if depth > stack.last(border):
                close(depth)
            flush()
        if tag in VOID:
            continue
        above = stack.top()
        skipped, label, header, names = _skips(tag, attributes, above)
        root, within = (above.root, above.named) if above else (0, 0)
        if names and not skipped:
            named.append(_Named(within, bool(names & SURE_NAMES)))
            within = len(named) - 1
        if tag in ("article", "main") and not root and not skipped and not names:
            roots += 1
            root = roots
            homes.append((tag, within))
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else n
            if end:
                at = page.find(">", end.end()) + 1 or n
            continue
        outer, home = (above.path, above.container) if above else (0, 0)
        path = paths.setdefault((outer, label), len(around))
        if path == len(around):
            around.append(outer)
        holds = tag in BLOCK and tag not in LEAF
        items += holds
        stack.push(_Open(tag, path, path if holds else home, skipped, root, tag == "a" or bool(above and above.link), header, within, items if holds else above.item if above else 0))
    flush()
    return out, named, homes, around


def _block_scores(found: list[Block]) -> list[float]:
    """Characters times punctuation marks of each block's path, smoothed along the page; article and main elements weigh more."""
    length: dict[int, list[float]] = {}
    for b in found:
        own = length.setdefault(b.path, [0, 0, 0])
        own[0] += max(len(b.text) - b.linked, 0)
        own[1] += len(_PUNCTUATION.findall(b.text))
        own[2] += 1
    # ratios of a block's path: characters and punctuation marks per block, smoothed along the page
    ratio = [tuple(x / length[b.path][2] for x in length[b.path][:2]) for b in found]
    padded = [ratio[0], *ratio, ratio[-1]]
    smooth = [tuple(sum(k * padded[i + j][x] for j, k in enumerate(KERNEL)) for x in (0, 1)) for i in range(len(found))]
    return [(chars * (1.0 + marks) + 1e-6) * (SEMANTIC if b.root else 1.0) for b, (chars, marks) in zip(found, smooth, strict=True)]


def _around(paths: set[int], outer: list[int]) -> int:
    """The innermost path that is around (or is) all of ``paths``."""
    held = [0] * len(outer)
    for path in paths:
        held[path] = 1
    for path in range(len(outer) - 1, 0, -1):
        if held[path] == len(paths):
            return path
        held[outer[path]] += held[path]
    return 0


def _below(path: int, outer: list[int]) -> list[bool]:
    """Which paths are ``path`` or lie within it."""
    out = [False] * len(outer)
    for k in range(len(outer)):
        out[k] = k == path or (k > 0 and out[outer[k]])
    return out


def _signed(found: list[Block], own: list[int]) -> bool:
    """Whether blocks are those of several elements that each begin with a signature, as readers' comments do: a few words that are
    no heading and end no sentence, then more."""
    items: dict[int, list[Block]] = {}
    for k in own:
        items.setdefault(found[k].item, []).append(found[k])
    signs = lambda x: len(x) > 1 and not x[0].heading and len(x[0].text.split()) <= SIGNATURE and not x[0].text.rstrip()[-1:] in ".!?。！？"
    return len(items) > 1 and all(map(signs, items.values()))


def main_text(page: str | None) -> str:
    """The blocks of the selected containers, white space within each turned into one space, joined by line ends.

    Containers that consist of links are left out, those behind the best one with fewer links too; so are, behind it, repeated elements
    that begin with a signature, and articles outside of a main element that is the best.
    """
    found, outer, homes = _candidates(page or "")
    if not found:
        return ""
    own: dict[int, list[int]] = {}  # blocks of each container, articles and main elements below 0
    for k, b in enumerate(found):
        own.setdefault(-b.root if b.root else b.container, []).append(k)
    scores = _block_scores(found)
    score = {g: sum(scores[k] for k in ks) for g, ks in own.items()}
    share = {g: sum(found[k].linked for k in ks) / (1 + sum(len(found[k].text) for k in ks)) for g, ks in own.items()}
    best = max(score, key=lambda g: score[g])
    last = own[best][-1]
    plain = {g for g in own if share[g] < (LINKED if own[g][0] < last else LINKED_BEHIND)} | {best}
    each = lambda g: score[g] / len(own[g])
    main = best < 0 and homes[-best][0] == "main"
    inside = {best} | {g for g in plain if (g < 0 and (not main or homes[-g][0] == "main")) or (g >= 0 and score[g] >= THRESHOLD * score[best])}
    inside |= {g for g in plain if g >= 0 and each(g) >= THRESHOLD * each(best)}
    if best >= 0 and not any(g < 0 for g in own):
        first = max(inside, key=lambda g: score[g])
        around = _around((inside - {first}) | {max(outer[first], 0)}, outer)
        within = _below(around, outer)
        inside |= {g for g in plain if within[g]}
        # readers' comments, with what else the element around them holds
        within = _below(best, outer)
        for g in [g for g in inside if not within[g] and own[g][0] > last and _signed(found, own[g])]:
            inside -= {g} | {x for x in inside if x == outer[g] and own[x][0] > last}
    chosen = sorted(k for g in inside for k in own[g])
    return "\n".join(found[k].text for k in chosen)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` (code points) for every row of ``pages``; a map without shuffle.

    Null and empty pages, and pages without content, have the empty text; pages without any tag are one block; broken or
    cut-off markup is read as far as it goes. A line break element counts as white space. Repeated rows each
    give a row; other columns are not read.
    """
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                texts = [main_text(x) for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], schema.fieldNames())

    return pages.select(id_col, url_col, html_col).mapInArrow(tidy(run), schema)
