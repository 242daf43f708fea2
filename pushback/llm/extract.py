"""Main text of web pages by tag-path ratios.

A page is cut into blocks: text under one block element, with its tag path
from the root. Per path, text length, punctuation, link text and leaves are
summed; a path's ratio is its text and punctuation for each leaf, lowered by
its link text. Ratios are smoothed along the page by a window over
neighbouring blocks, weighted by how much of their paths agree, and fused with
the plain ratio. Paths under the threshold (the mean less the spread of the
page's ratios over text) are dropped. Where the page marks its article
(``article``, ``main`` or such a role), ratios are summed by zone and decide
among the zones and the text outside: outside text goes where a zone holds as
much, and a zone goes that holds under a third of what the best holds. The
threshold is then taken over the chosen blocks; in an article it is a tenth,
and text below the parent of most kept text stays (outside an article, if most
of it is no link). Menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles are
never content, by element or by a class, id or role whose name ends in such a
word; a name excludes no element that holds a zone or, where none is marked
and the name is no advert's, most of the page's text.

Character references are decoded, white space in a block becomes one space,
blocks join with one line feed. A null or empty page, and one without content,
gives ''; repeated rows each get their text. Malformed markup never fails, and
time is linear in a page's length: unknown or unclosed tags end with what holds
them; an unclosed script, style, comment or tag runs to the end of the page; a
quote that nothing closes is part of an unquoted value. Zones and named elements
count up to ``NESTED`` levels deep.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.common import map_rows

TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)")
SPACES = re.compile(r"[\s/]*")
ATTRIBUTE_NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
UNQUOTED = re.compile(r"[^\s>]*")
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?。，；！？、]")
#: Fixed lists of HTML element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe object svg math select noembed noframes".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
OUTSIDE = set("nav header footer aside form menu button select label head dialog noscript template".split())
ENDS_P = BLOCK - {"html", "body"}
SAME_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"},
             "option": {"select"}}
#: Words of class, id or role that mark what is not the article.
NOT_CONTENT = set("""ad ads adbox adslot adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion
    nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related
    comment comments respond replies disqus cookie cookies consent notice alert popup modal newsletter subscribe
    share sharing social login signup search form pagination pager toolbar complementary contentinfo""".split())
#: Words of a name that tell what an element holds or has beside it, where it lies, and what it lists.
HOLDS = set("has have with without no not and content layout results".split())
PLACES = set("left right top bottom inner outer wrap wrapper container box area section block bar primary secondary".split())
LISTS = set("list item items links buttons posts articles stories unit slot body text title form".split())
ADVERTS = set("ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored".split())
ZONES = {"article", "main"}
TITLES = {"header", "masthead"}
#: Part of the best zone's text, weighted by ratio, that another zone needs.
ZONE_PART = 1 / 3
#: Part of the threshold that a path in an article needs.
ARTICLE_PART = 0.1
WINDOW = 2
PUNCTUATION_WEIGHT = 4.0


#: Levels of zones and of named elements that count.
NESTED = 32


class Paths:
    """Tag paths from the root as numbers; 0 is the root."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.name, self.parent, self.jump, self.depth = [""], [0], [0], [0]

    def below(self, path: int, name: str) -> int:
        new = self.known.setdefault((path, name), len(self.name))
        if new == len(self.name):
            far = self.jump[path]
            even = self.depth[path] - self.depth[far] == self.depth[far] - self.depth[self.jump[far]]
            self.name.append(name)
            self.parent.append(path)
            self.depth.append(self.depth[path] + 1)
            self.jump.append(self.jump[far] if even else path)
        return new

    def shared(self, a: int, b: int) -> int:
        """The longest path that both begin with, in logarithmic time."""
        depth, jump, parent = self.depth, self.jump, self.parent
        if depth[a] < depth[b]:
            a, b = b, a
        while depth[a] > depth[b]:
            a = jump[a] if depth[jump[a]] >= depth[b] else parent[a]
        while a != b:
            a, b = (jump[a], jump[b]) if jump[a] != jump[b] else (parent[a], parent[b])
        return a


@dataclass
class Block:
    path: int
    text: str
    link_chars: int
    zones: tuple[int, ...]  # zones around it, outermost first
    article: bool
    named: tuple[int, ...]  # elements around it that a class, id or role excludes


def _attributes(found: dict[str, str]) -> tuple[set[str], set[str], bool]:
    """Words of class and id, of role, and whether the element is hidden."""
    words = {tuple(w.lower() for w in WORD_PARTS.findall(x))  # whole names, by their parts
             for name in ("class", "id") for x in found.get(name, "").split()}
    roles = set(found.get("role", "").lower().split())
    hidden = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
              or re.search(r"display\s*:\s*none", found.get("style", "").lower()) is not None)
    return words, roles, hidden


def tag_rest(page: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int] | None:
    """Attributes of the tag whose name ends at ``at``, by lower-case name (the
    first of equal ones), and where the tag ends; None if the page ends first.
    ``last`` has the place of the last quote of either kind."""
    found: dict[str, str] = {}
    while True:
        at = SPACES.match(page, at).end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return found, at + 1
        m = ATTRIBUTE_NAME.match(page, at)
        name, value, at = m[0].lower(), "", m.end()
        if (m := EQUALS.match(page, at)) is not None:
            at = m.end()
            quote = page[at:at + 1]
            if quote in ("'", '"') and last[quote] > at:
                end = page.index(quote, at + 1)
                value, at = page[at + 1:end], end + 1
            else:
                m = UNQUOTED.match(page, at)
                value, at = m[0], m.end()
        found.setdefault(name, html.unescape(value) if "&" in value else value)


def names_other(parts: tuple[str, ...], not_content: set[str]) -> bool:
    """Whether a class or id of these parts names what is not content."""
    if not any(w in not_content for w in parts) or not HOLDS.isdisjoint(parts):
        return False
    rest = [w for w in parts if w not in PLACES]
    return bool(rest) and (rest[-1] in not_content or rest[0] in not_content and len(rest) == 2 and rest[1] in LISTS)


def blocks(page: str, paths: Paths) -> list[Block]:
    """Blocks of a page that lie in no excluded element, in page order."""
    out: list[Block] = []
    # name, excluded, zones, article, named, path
    stack: list[tuple[str, bool, tuple[int, ...], bool, tuple[int, ...], int]] = [("", False, (), False, (), 0)]
    places: dict[str, list[int]] = {}  # of the open elements of a name
    block_places = [0]  # of the open block elements
    holders: set[int] = set()  # named elements that hold a zone
    adverts: set[int] = set()  # named elements that size does not excuse
    n_named = 0
    parts: list[str] = []
    link_chars = links = at = n_zones = 0
    last = {q: page.rfind(q) for q in "'\""}

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text and not stack[-1][1]:
                _, _, zones, article, named, path = stack[-1]
                out.append(Block(path, text, link_chars, zones, article, named))
            parts.clear()
        link_chars = 0

    def add(text: str) -> None:
        nonlocal link_chars
        if text and not stack[-1][1]:
            text = html.unescape(text)
            parts.append(text)
            if links:
                link_chars += len(text.strip())

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            name = stack[-1][0]
            if name in BLOCK or (stack[-1][1], stack[-1][4]) != (stack[-2][1], stack[-2][4]):
                flush()
            if name == "a":
                links = max(0, links - 1)
            stack.pop()
            places[name].pop()
            if block_places[-1] == len(stack):
                block_places.pop()

    while (m := TOKEN.search(page, at)) is not None:
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] in ("<!--", "<![CDATA["):
                stop = "-->" if m[0] == "<!--" else "]]>"
                end = page.find(stop, at)
                if stop == "]]>":
                    add(page[at:end if end >= 0 else len(page)])
                at = end + 3 if end >= 0 else len(page)
            continue
        if (rest := tag_rest(page, at, last)) is None:  # the page's end cut the tag off
            at = len(page)
            break
        start, name = at, m[2].lower()
        attributes, at = rest
        if m[1]:
            if places.get(name):
                close(places[name][-1])
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(page, at)
            shut = page.find(">", end.end()) if end else -1
            at = shut + 1 if shut >= 0 else len(page)
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in ENDS_P and stack[block_places[-1]][0] == "p":
            close(block_places[-1])
        if name in SAME_ENDS:
            depth = max((places[x][-1] for x in (name, *SAME_ENDS[name]) if places.get(x)), default=0)
            if stack[depth][0] == name:
                close(depth)
        if name in BLOCK:
            flush()
        if name in VOID or name not in BLOCK and page[start:at - 1].rstrip().endswith("/"):
            continue
        words, roles, hidden = _attributes(attributes) if attributes else (set(), set(), False)
        zones = stack[-1][2]
        article = stack[-1][3] or name == "article" or "article" in roles
        # an article's own header holds its title
        not_content, outside = (NOT_CONTENT - TITLES, OUTSIDE - TITLES) if stack[-1][2] else (NOT_CONTENT, OUTSIDE)
        named = (bool(roles & not_content) or any(names_other(w, not_content) for w in words)
                 ) and name not in ("html", "body", *ZONES)
        bad = hidden or name in outside
        if not stack[-1][1] and (bad or named):
            flush()
        own = stack[-1][4]
        if named and len(own) < NESTED:
            n_named += 1
            own = (*own, n_named)
            if any(ADVERTS & set(w) for w in words):
                adverts.add(n_named)
        links += name == "a"
        if name in ZONES or roles & ZONES:
            if len(zones) < NESTED:
                n_zones += 1
                zones = (*zones, n_zones)
            if not stack[-1][1]:
                holders.update(own)
        places.setdefault(name, []).append(len(stack))
        path = stack[-1][5]
        if name in BLOCK:
            block_places.append(len(stack))
            path = paths.below(path, name)
        stack.append((name, stack[-1][1] or bad, zones, article, own, path))
    add(page[at:])
    flush()
    size: dict[int, int] = {}
    for b in out:
        for n in b.named:
            size[n] = size.get(n, 0) + len(b.text) - b.link_chars
    most = sum(len(b.text) - b.link_chars for b in out) / 2
    zoned = any(b.zones for b in out)  # then the zones tell what is content
    return [b for b in out if all(n in holders or n not in adverts and not zoned and size[n] > most for n in b.named)]


def path_ratios(found: list[Block], paths: Paths) -> list[float]:
    """Smoothed and fused tag-path ratio of each block; zones have paths of their own."""
    total: dict[tuple, list[float]] = {}
    for b in found:
        t = total.setdefault((b.zones, b.path), [0.0, 0.0, 0.0, 0.0])
        t[0] += len(b.text)
        t[1] += len(PUNCTUATION.findall(b.text))
        t[2] += b.link_chars
        t[3] += 1
    plain = []
    for b in found:
        chars, points, links, leaves = total[b.zones, b.path]
        plain.append((chars + PUNCTUATION_WEIGHT * points) / leaves * max(0.0, 1 - links / max(chars, 1.0)))
    fused = []
    for i, b in enumerate(found):
        weight = near = 0.0
        for j in range(max(0, i - WINDOW), min(len(found), i + WINDOW + 1)):
            other = found[j].path
            same, longer = paths.depth[paths.shared(b.path, other)], max(paths.depth[b.path], paths.depth[other])
            w = math.exp(-abs(i - j)) * (same + 1) / (longer + 1)
            weight += w
            near += w * plain[j]
        fused.append(math.sqrt(plain[i] * near / weight))
    return fused


def chosen(found: list[Block], ratios: list[float], own: list[int], depth: int = 0) -> list[int]:
    """Those of the blocks ``own`` that lie where most text, weighted by ratio, is."""
    groups: dict[int, list[int]] = {}
    for i in own:
        zones = found[i].zones
        groups.setdefault(zones[depth] if len(zones) > depth else 0, []).append(i)
    if list(groups) == [0]:
        return own
    weight = {z: sum(ratios[i] * len(found[i].text) for i in group) for z, group in groups.items()}
    outside = weight.pop(0, 0.0)
    best = max(weight.values())
    # beside zones in a zone, the rest of it is left to the threshold
    out = groups.get(0, []) if depth or outside > best else []
    for z, w in weight.items():
        if w >= ZONE_PART * max(best, outside):
            out = out + chosen(found, ratios, groups[z], depth + 1)
    return sorted(out)


def content(found: list[Block], paths: Paths) -> list[Block]:
    """Blocks of the content paths."""
    if not found:
        return []
    ratios = path_ratios(found, paths)
    picked = chosen(found, ratios, list(range(len(found))))
    found, ratios = [found[i] for i in picked], [ratios[i] for i in picked]
    chars = sum(len(b.text) for b in found)
    mean = sum(r * len(b.text) for r, b in zip(ratios, found)) / chars
    spread = math.sqrt(sum((r - mean) ** 2 * len(b.text) for r, b in zip(ratios, found)) / chars)
    least = max(0.0, mean - spread) * 0.5
    best: dict[tuple, float] = {}
    for b, r in zip(found, ratios):
        key = b.zones, b.path
        best[key] = max(best.get(key, 0.0), r)
    kept = {(b.zones, b.path) for b in found
            if (r := best[b.zones, b.path]) > 0 and r >= least * (ARTICLE_PART if b.article else 1)}
    # headings and the like beside kept paths: siblings under the parent of most kept text
    held: dict[tuple, dict[int, int]] = {}
    for b in found:
        if (b.zones, b.path) in kept:
            own = held.setdefault(b.zones, {})
            above = paths.parent[b.path]
            own[above] = own.get(above, 0) + len(b.text)
    parents = {z: max(own, key=own.get) for z, own in held.items()}

    def beside(b: Block) -> bool:
        parent = parents.get(b.zones)
        if b.link_chars * 2 >= len(b.text) and not b.article:
            return False
        if b.zones and paths.name[b.path] == "h1":  # the title of a zone
            return True
        # in a zone also lists, tables and quotations among the siblings
        return (parent is not None and paths.depth[b.path] > paths.depth[parent] and paths.shared(b.path, parent) == parent
                and (bool(b.zones) or paths.depth[b.path] == paths.depth[parent] + 1))

    return [b for b in found if (b.zones, b.path) in kept or beside(b)]


def main_text(page: str | None) -> str:
    paths = Paths()
    return "\n".join(b.text for b in content(blocks(page, paths), paths)) if page else ""


def extract(pages: DataFrame, *, keep: list[str], html_col: str = "html") -> DataFrame:
    """The ``keep`` columns and ``main_text`` of every page."""
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("main_text", T.StringType())])

    def run(rows):
        for *kept, page in rows:
            yield (*kept, main_text(page))

    return map_rows(pages.select(*[F.col(c) for c in keep], F.col(html_col).alias("_html")), run, schema)
