"""HTML extraction: a wrapper per host, inferred by aligning its pages, says where main texts are.

A wrapper is a union-free regular expression over tags. It is kept as a tree: below each element its parts by label (the
tag with its classes), in order. A part is optional if a page or a repeat lacks it, repeated if an element has several in
a row; parts that come again after others, or in another order on another page, make up one repeated group of
optional parts. The label "#" is text. A text is constant if all pages have the same there, else it is a slot.

What a page's main text is follows from the slots: from the root down into the element that holds most of the text that
differs from page to page and isn't links, until there is none that holds nearly all. Tags and classes rule out what the
contract rules out (menus, adverts, forms and the like), and give articles a lead.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, checkpointed, map_rows
from .url_rules import split_url

# possessive throughout, and unquoted "<" ends a tag, so that a page is read in time that is linear in its length
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/><]*+)((?:[^<>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)>|[^<]++|<""", re.S)
_MARKS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_WITHIN = _INLINE | {"script", "style", "noscript", "template"}
#: What an opening tag closes, if that is open in the same block.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = frozenset("ul ol dl table tbody thead tfoot article section main body div nav aside footer header form select".split())
#: Parts of an article, which are never all of it, and what is all of it only where nothing stands beside it.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LEAVES = _HEADINGS | frozenset("p li dt dd blockquote pre figure figcaption address".split())
_LISTS = frozenset("ul ol dl table tbody thead tfoot tr td th".split())
#: Tags and words of classes, ids and roles that mark what isn't the article.
_OTHER_TAGS = frozenset("nav footer aside form script style textarea title noscript template iframe head button select svg canvas dialog menu object xmp".split())
_OTHER_WORDS = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notices newsletter subscribe subscription "
    "signup signin sharing social breadcrumb breadcrumbs pagination pager recommended recommendations comment comments reply replies popup modal overlay toolbar widget masthead copyright disclaimer".split()
)
#: Words that mark it only where a class has no other words than these and those above.
_WEAK_WORDS = frozenset("alert form login related respond search share skip".split())
_MAIN_WORDS = frozenset("article main content post entry story".split())
_WHOLE = frozenset("html body main article".split())

#: An element is taken for its parent if it has this share of the parent's text; by so much articles count for more.
MOST_OF, LEAD = 0.75, 4
#: Parts of a wrapper, and how deep it goes; what is deeper counts as text of the element at that depth.
MOST_PARTS, DEPTH = 4096, 64


def _label(tag: str, attributes: str) -> str:
    marks = sorted({w for m in _MARKS.findall(attributes) for w in re.sub(r"\d+", "0", m.strip("\"'")).lower().split()}) if attributes else ()
    return ".".join([tag, *marks])


@lru_cache(1 << 16)
def is_other(label: str, in_main: bool = False) -> bool:
    """Whether a label marks what isn't the article; a header within the article has its title, and stays."""
    tag, *marks = label.split(".")
    if tag in _OTHER_TAGS or (tag == "header" and not in_main):
        return True
    if tag in _WHOLE:
        return False
    for words in ({*re.findall("[a-z]+", m)} for m in marks):
        if words & _OTHER_WORDS or (words and words <= _WEAK_WORDS) or (not in_main and "header" in words):
            return True
    return False


@lru_cache(1 << 16)
def is_main(label: str) -> bool:
    tag, *marks = label.split(".")
    return tag in ("article", "main") or any(w in _MAIN_WORDS for m in marks for w in re.findall("[a-z]+", m))


@lru_cache(64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


class Node:
    """An element: its label, what is in it in order (nodes, and lists of strings that make up a text as it is written), and its own characters in links."""

    __slots__ = ("inside", "label", "links")

    def __init__(self, label: str) -> None:
        self.label, self.inside, self.links = label, [], 0


def parse(page: str) -> Node:
    """The page as a tree; the root has the label "". A line break is a space.

    Inline tags are transparent unless their classes mark what isn't the article. End tags without a start are left
    out, elements without an end go on to that of what holds them, and a block ends a paragraph.
    """
    root = Node("")
    stack, tags = [root], [""]  # open nodes
    opened: dict[str, int] = {}  # how many are open, by tag
    within: dict[str, int] = {}  # transparent ones inside an open inline node of the same tag
    link = 0  # how many nodes were open when the current link began

    def close(at: int) -> None:
        nonlocal link
        for t in tags[at:]:
            opened[t] -= 1
            if not opened[t]:
                within.pop(t, None)
        del stack[at:], tags[at:]
        if len(stack) < link:
            link = 0

    pos, n, match = 0, len(page), _TOKEN.match
    while pos < n:
        m = match(page, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                node = stack[-1]
                children = node.inside
                if children and type(children[-1]) is list:
                    children[-1].append(token)
                else:
                    children.append([token])
                if link:
                    node.links += len(token.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                link = 0
            if within.get(tag):
                within[tag] -= 1
            elif opened.get(tag):
                at = len(tags) - 1
                if tag == "p" or tag in _INLINE:  # these end within their block only
                    while at and tags[at] != tag and tags[at] not in _HOLDS:
                        at -= 1
                    if tags[at] != tag:
                        continue
                else:
                    while tags[at] != tag:
                        at -= 1
                close(at)
            continue
        if tag in _VOID:
            children = stack[-1].inside
            if tag == "br":
                if children and type(children[-1]) is list:
                    children[-1].append(" ")
                else:
                    children.append([" "])
            elif tag == "hr":
                children.append(Node("hr"))
            continue
        if tag == "a":
            link = len(stack)
        label = _label(tag, m[3])
        if tag in _INLINE:
            if not is_other(label, True):
                if opened.get(tag):
                    within[tag] = within.get(tag, 0) + 1
                continue
        else:  # a block ends a paragraph, and some end their like
            ends = _CLOSES.get(tag, ())
            if opened.get("p") or any(opened.get(e) for e in ends):
                at = len(tags) - 1
                while at and tags[at] not in _HOLDS:
                    if tags[at] == "p" or tags[at] in ends:
                        close(at)
                    at -= 1
        node = Node(label)
        stack[-1].inside.append(node)
        if tag in _RAW:
            end = _end_of(tag).search(page, pos)
            pos = end.start() if end else n
        elif tag != "svg" or not m[3].rstrip().endswith("/"):
            stack.append(node)
            tags.append(tag)
            opened[tag] = opened.get(tag, 0) + 1
    return root


def _text(written: list[str]) -> str:
    """A text decoded, with one space for any white space."""
    return " ".join(html.unescape("".join(written)).split())


# A part of a wrapper is a list. Of a text: pages that have it, repeated, optional, characters, those in links, and the
# sum of the hashes of a page's texts there (null for a slot). Of an element: pages, repeated, optional, parts by label,
# and the first and last label of its repeated group, if it has one.
_PAGES, _MANY, _OPTIONAL, _CHARS, _LINKS, _SAME = range(6)
_PARTS, _GROUP = 3, 4


def skeleton(node: Node, depth: int = 0) -> list:
    """The wrapper of one page's element."""
    parts: dict[str, list] = {}
    places: dict[str, int] = {}
    last, first, to, links = None, None, None, node.links
    for c in node.inside if depth < DEPTH else [_all_text(node)]:
        if type(c) is list:
            text = _text(c)
            if not text:
                continue
            label, own = "#", [1, False, False, len(text), min(len(text), links), zlib.crc32(text.encode())]
            links -= own[_LINKS]
        else:
            label, own = c.label, skeleton(c, depth + 1)
        if label not in parts:
            places[label] = len(parts)
            parts[label] = own
        else:
            if label != last:  # it comes again after others: a group from its first place on
                first, to = min(places[label], len(parts) if first is None else first), len(parts)
            own[_MANY] = True
            parts[label] = _joined(parts[label], own, label, True)
        last = label
    labels = list(parts)
    return [1, False, False, parts, None if first is None else [labels[first], labels[to - 1]]]


def _all_text(node: Node) -> list[str]:
    """All that is written below a node, in one."""
    out, todo = [], [node]
    while todo:
        c = todo.pop()
        if type(c) is list:
            out += [*c, " "]
        else:
            todo += reversed(c.inside)
    return out


def _joined(a: list, b: list, label: str, together: bool) -> list:
    """Two parts of one label as one: of the same place on other pages, or (together) side by side on one."""
    head = [1 if together else a[_PAGES] + b[_PAGES], a[_MANY] or b[_MANY], a[_OPTIONAL] or b[_OPTIONAL]]
    if label != "#":
        return head + merge(a, b, together)[_PARTS:]
    if together:
        same = None if a[_SAME] is None or b[_SAME] is None else a[_SAME] + b[_SAME]
    else:
        same = a[_SAME] if a[_SAME] == b[_SAME] else None
    return [*head, a[_CHARS] + b[_CHARS], a[_LINKS] + b[_LINKS], same]


def merge(a: list, b: list, together: bool = False) -> list:
    """The wrappers of an element (or page) aligned: parts of one label meet, and what only one has is optional.

    Counts, marks and slots don't depend on the order in which wrappers are merged; the order of parts is that of `a`,
    where b's own parts come after the part that they follow in b.
    """
    x, y = a[_PARTS], b[_PARTS]
    after: dict[str | None, list[str]] = {}
    place = {label: k for k, label in enumerate(x)}
    crossed: list[int] = []  # places of a that b has in another order
    before, furthest = None, -1
    for label in y:
        if label in place:
            if place[label] < furthest:
                crossed += [place[label], furthest]
            furthest = max(furthest, place[label])
            before = label
        else:
            after.setdefault(before, []).append(label)
    parts: dict[str, list] = {}
    for label in (None, *x):
        if label is not None:
            parts[label] = _joined(x[label], y[label], label, together) if label in y else [*x[label][:_OPTIONAL], True, *x[label][_PARTS:]]
        for new in after.get(label, ()):
            parts[new] = [*y[new][:_OPTIONAL], True, *y[new][_PARTS:]]
    ends = {label for g in (a[_GROUP], b[_GROUP]) if g for label in g}
    if crossed:
        labels = list(x)
        ends |= {labels[min(crossed)], labels[max(crossed)]}
    group = None
    if ends:
        inside = [label for label in parts if label in ends]
        group = [inside[0], inside[-1]]
    return [1 if together else a[_PAGES] + b[_PAGES], a[_MANY] or b[_MANY], a[_OPTIONAL] or b[_OPTIONAL], parts, group]


def pruned(wrapper: list, most: int = MOST_PARTS) -> list:
    """A wrapper without the parts that the fewest pages have, if it has more than `most`; pages that have others use their own texts only."""
    pages: list[int] = []

    def count(w: list) -> None:
        for label, p in w[_PARTS].items():
            pages.append(p[_PAGES])
            if label != "#":
                count(p)

    def cut(w: list, least: int) -> list:
        kept = {label: p if label == "#" else cut(p, least) for label, p in w[_PARTS].items() if p[_PAGES] >= least}
        return [*w[:_PARTS], kept, w[_GROUP] if w[_GROUP] and kept.keys() >= {*w[_GROUP]} else None]

    count(wrapper)
    return wrapper if len(pages) <= most else cut(wrapper, sorted(pages, reverse=True)[most] + 1)


def expression(wrapper: list) -> str:
    """A wrapper written as a regular expression: # is a slot, = a constant text, ? and + stand for optional and repeated parts."""

    def one(label: str, p: list) -> str:
        mark = ("+" if p[_MANY] else "") + ("?" if p[_OPTIONAL] else "")
        return (("#" if p[_SAME] is None else "=") if label == "#" else f"<{label}>({expression(p)})") + mark

    out, group = [], wrapper[_GROUP] or [None, None]
    for label, p in wrapper[_PARTS].items():
        out.append(("( " if label == group[0] else "") + one(label, p) + (" )+" if label == group[1] else ""))
    return " ".join(out)


def slot_lengths(wrapper: list) -> dict[str, float]:
    """By path of labels, for a page that has the element: characters below it in slots, without links and what isn't the article.

    Where no slot has any, as on a host of one page, constant texts count too.
    """
    for every in (False, True):
        found: dict[str, float] = {}

        def walk(w: list, path: str, in_main: bool) -> float:
            total = 0
            for label, p in w[_PARTS].items():
                here = f"{path}>{label}"
                if label == "#":
                    own = p[_CHARS] - p[_LINKS] if every or p[_SAME] is None else 0
                else:
                    own = 0 if is_other(label, in_main) else walk(p, here, in_main or is_main(label))
                found[here] = own / p[_PAGES]
                total += own
            return total

        if walk(wrapper, "", False):
            break
    return found


def _own_length(node: Node, in_main: bool) -> int:
    """Characters below a node, without links and what isn't the article."""
    total, todo = 0, [node]
    while todo:
        c = todo.pop()
        total += sum(len(_text(x)) for x in c.inside if type(x) is list) - c.links
        todo += [x for x in c.inside if type(x) is not list and not is_other(x.label, in_main)]
    return total


def main_parts(page: Node, lengths: dict[str, float]) -> tuple[list[Node], str, bool]:
    """The page's elements whose texts are the main text, the path of the last, and whether that is within an article."""
    node, path, in_main, headings = page, "", False, []
    while True:
        by: dict[str, list[Node]] = {}
        for c in node.inside:
            if type(c) is not list and not is_other(c.label, in_main):
                by.setdefault(c.label, []).append(c)
        if not by:
            break
        weights = {x: lengths.get(f"{path}>{x}", 0.0) * (LEAD if is_main(x) and x.split(".")[0] in _WHOLE else LEAD / 2 if is_main(x) else 1) for x in by}
        best = max(by, key=weights.__getitem__)
        total, tag = sum(weights.values()) + lengths.get(f"{path}>#", 0.0), best.split(".")[0]
        whole = weights[best] >= total and len(by[best]) == 1  # nothing stands beside it
        if not total or tag in _LEAVES or (tag in _LISTS and not whole) or (in_main and not (is_main(best) or whole)):
            break
        own = [_own_length(c, in_main) for c in by[best]] if len(by[best]) > 1 else [1]  # of several that look alike, the longest
        found = by[best][own.index(max(own))]
        if weights[best] * max(own) < MOST_OF * total * max(1, sum(own)):
            break
        if not in_main:
            for c in node.inside:
                if c is found:
                    break
                if type(c) is not list and c.label.split(".")[0] in _HEADINGS and weights.get(c.label):
                    headings.append(c)
        node, path, in_main = found, f"{path}>{best}", in_main or is_main(best)
    return [*headings, node], path, in_main


def blocks(node: Node, in_main: bool, without: frozenset[str] | set[str] = frozenset()) -> list[str]:
    """Texts of the blocks below, in order, without what isn't the article, and without the node's own parts of the labels `without`."""
    lines: list[str] = []
    line: list[str] = []

    def end() -> None:
        if line:
            if text := _text(line):
                lines.append(text)
            line.clear()

    todo = [iter(node.inside)]
    while todo:
        for c in todo[-1]:
            if type(c) is list:
                line += c
            elif c.label.split(".")[0] not in _WITHIN:  # those within a line aren't the article, but no end of a block either
                end()
                if not is_other(c.label, in_main) and not (len(todo) == 1 and c.label in without):
                    todo.append(iter(c.inside))
                    break
        else:
            end()
            todo.pop()
    return lines


def extract(page: str, lengths: dict[str, float]) -> str:
    """The main text of a page of a host with such slots; a page with other parts only is judged by its own texts."""
    tree = parse(page)
    parts, path, in_main = main_parts(tree, lengths)
    if not path or not any(lengths.get(f"{path}>{c.label if type(c) is not list else '#'}") for c in parts[-1].inside):
        lengths = slot_lengths(skeleton(tree))
        parts, path, in_main = main_parts(tree, lengths)
    *headings, whole = parts
    template: set[str] = set()
    if path.rsplit(">", 1)[-1].split(".")[0] in ("", "html", "body") and any(lengths.get(f"{path}>{c.label}") for c in whole.inside if type(c) is not list):
        template = {c.label for c in whole.inside if type(c) is not list and not lengths.get(f"{path}>{c.label}", 1.0)}
    return "\n".join([line for h in headings for line in blocks(h, in_main)] + blocks(whole, in_main, template))


def infer_wrappers(pages: DataFrame, url: str = "url", page: str = "html", salts: int = 64) -> DataFrame:
    """host, wrapper (JSON) and n_pages, of every host of `pages`.

    A task aligns the pages of each host that it reads, so that of a host there is one wrapper a batch, not a page;
    those are aligned in two steps, salted first. A wrapper has at most MOST_PARTS parts, so that a host's wrapper and
    a group's work are bounded whatever its pages.
    """

    def start():
        def step(columns):
            found: dict[str, list] = {}
            for u, h in zip(*columns, strict=True):
                host, own = split_url(u)[0], skeleton(parse(h or ""))
                found[host] = pruned(merge(found[host], own) if host in found else own)
            return [list(found), [json.dumps(w, separators=(",", ":")) for w in found.values()], [w[_PAGES] for w in found.values()]]

        return step

    def aligned(group: pd.DataFrame) -> pd.DataFrame:
        whole: list | None = None
        for w in sorted(group["wrapper"]):
            whole = json.loads(w) if whole is None else pruned(merge(whole, json.loads(w)))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(whole, separators=(",", ":"))], "n_pages": [group["n_pages"].sum()]})

    schema = "host string, wrapper string, n_pages long"
    parts = map_rows(pages.select(F.col(url).cast("string"), F.col(page).cast("string")), schema, start)
    once = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts))).groupBy("host", "salt").applyInPandas(aligned, schema)
    return once.groupBy("host").applyInPandas(aligned, schema)


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """`key` (a long), url, text (main text, blocks joined by line ends) and n_chars of every row.

    A null page is empty, and an empty page or one without main text has an empty text; a null url belongs to the host
    "". Very long and very deep pages are read whole, in time linear in their length. Repeated rows are each extracted;
    an empty table gives none. The wrappers are written to the checkpoint folder; they are broadcast if they are at most
    BROADCAST_BYTES, and joined by host if not.
    """
    wrappers = checkpointed(infer_wrappers(pages, url, page))
    own = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"))
    if (wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0) <= BROADCAST_BYTES:
        rules = pages.sparkSession.sparkContext.broadcast({r.host: r.wrapper for r in wrappers.collect()})
        rows = own.withColumn("wrapper", F.lit(None).cast("string"))
    else:
        rules = None
        host = F.translate(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        rows = own.withColumn("host", host).join(wrappers, "host", "left").select("key", "url", "page", "wrapper")

    def start():
        known: dict[str, dict[str, float]] = {}

        def lengths(wrapper: str) -> dict[str, float]:
            if wrapper not in known:
                if len(known) > 10_000:
                    known.clear()
                known[wrapper] = slot_lengths(json.loads(wrapper))
            return known[wrapper]

        def step(columns):
            texts = [extract(h or "", lengths(w if rules is None else rules.value[split_url(u)[0]])) for _, u, h, w in zip(*columns, strict=True)]
            return [columns[0], columns[1], texts, [len(t) for t in texts]]

        return step

    return map_rows(rows, f"`{key}` long, `{url}` string, text string, n_chars long", start)
