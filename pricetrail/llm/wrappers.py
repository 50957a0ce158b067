"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

Every page is a stream of tags and text blocks.  The streams of a host's pages are aligned one
after the other into one expression: what only some pages have becomes optional, neighbours
that look alike become a repeated group, and blocks whose text differs become text slots.  The
finished expression says which parts are the article and which are the page around it; each
page is aligned to it once more, and the blocks of the article's slots are its text.
"""

from __future__ import annotations

import html
import json
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import stored
from pricetrail.llm.url_rules import split_url

TEXT = "#"
DEEPEST = 60  # depth of the tree that is aligned; of elements below, only articles and what is around stay apart
RARE = 20  # an element's own words stay apart in an expression if at least one page in so many has them at that place
PERIOD = 3  # the longest group of neighbours that is folded into a repetition

# Elements and attribute words of the page around an article.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "noembed", "xmp", "title", "svg"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
AROUND_TAGS = set("head nav header footer aside form button select dialog menu object canvas audio video".split())
AROUND_WORDS = set(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar "
    "skip social sponsor sponsored subscribe toolbar widget complementary contentinfo alert dialog".split()
)
COMMENT_WORDS = {"comment", "comments", "commentlist", "reply", "replies", "disqus", "related", "promo", "teaser"}
MAIN_WORDS = {"main", "articlebody"}
# Words that say where or how a thing stands, not what it is: ``share-bar`` is as telling as ``share``.
PLACE_WORDS = set(
    "area bar block body bottom box btn button buttons col column container content count foot form group head icon "
    "icons inner item items left line link links list main outer overlay page panel post posts primary right row "
    "secondary section site slot strip text title top unit wrap wrapper".split()
)
# Words that are as likely the subject of a paragraph as its use.
SUBJECT_WORDS = set(
    "alert banner dialog header menu modal navigation promotion related reply respond search share skip social "
    "sponsor widget".split()
)
TELLING = AROUND_WORDS | COMMENT_WORDS | MAIN_WORDS
PROSE_TAGS = set("p h1 h2 h3 h4 h5 h6 dt dd blockquote pre figure figcaption".split())
BLOCK_TAGS = set("p h1 h2 h3 h4 h5 h6 li dt dd ul ol dl blockquote pre figure figcaption address".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)"
    r"(?:((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|([^>]*)(?:>|$))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile("[a-z]+")


class Part:
    """An element or a text block of one page."""

    __slots__ = ("label", "kids", "text", "linked")

    def __init__(self, label: str):
        self.label, self.kids, self.text, self.linked = label, [], "", 0


def label_of(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id and role, without digits.

    A word of page furniture is marked ``~`` where its name says something else as well:
    ``ad-slot`` gives ``ad slot``, and ``ad-free`` gives ``free ~ad``.
    """
    words: set[str] = set()
    if attributes and "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                own = _WORD.findall(name)
                if all(w in TELLING or w in PLACE_WORDS for w in own):
                    words.update(own)
                else:
                    words.update("~" + w if w in AROUND_WORDS or w in COMMENT_WORDS else w for w in own)
    return f"{tag}.{' '.join(sorted(words))}" if words else tag


def plain_label(label: str) -> str:
    """The tag and the telling words of a label."""
    tag, _, words = label.partition(".")
    telling = [w for w in words.split() if w in TELLING or w[0] == "~"]
    return f"{tag}.{' '.join(telling)}" if telling else tag


def is_around(label: str) -> bool:
    """Whether an element is by its tag or by a whole name part of the page around the article."""
    tag, _, words = label.partition(".")
    if tag in AROUND_TAGS:
        return True
    if not words:
        return False
    own = set(words.split())
    if tag in ("article", "main", "body", "html"):
        return tag == "article" and bool(own & COMMENT_WORDS)
    return bool(own & (AROUND_WORDS - SUBJECT_WORDS if tag in PROSE_TAGS else AROUND_WORDS))


def hints(label: str) -> bool:
    """Whether a name only hints that an element is around; the host's expression decides on it."""
    tag, _, words = label.partition(".")
    if not words or tag in ("article", "main", "body", "html") or is_around(label):
        return False
    return "~" in words or bool(AROUND_WORDS.intersection(words.split()))


def is_main(label: str) -> bool:
    tag, _, words = label.partition(".")
    return tag in ("article", "main") or bool(set(words.split()) & MAIN_WORDS)


def _flat(part: Part) -> list[Part]:
    """The text blocks below a part, in order; those of an article or of elements around it in one part of that label.

    Which that is follows ``verdict``: an element around without main element in it takes all its
    text, else the outermost article, else the outermost main element.
    """
    below = [part]
    for x in below:
        below += [k for k in x.kids if k.label != TEXT]
    own = {id(x): is_main(x.label) and not is_around(x.label) for x in below}
    has_main: dict[int, bool] = {}
    for x in reversed(below):
        has_main[id(x)] = any(own.get(id(k)) or has_main.get(id(k)) for k in x.kids)

    out: list[Part] = []
    last: Part | None = None
    todo: list[tuple[Part, Part | None]] = [(k, None) for k in reversed(part.kids)]
    while todo:
        x, holder = todo.pop()
        if x.label == TEXT:
            if holder is None:
                out.append(x)
            elif holder is last:
                out[-1].kids.append(x)
            else:
                out.append(Part(holder.label))
                out[-1].kids.append(x)
            last = holder
            continue
        if holder is None or own[id(holder)]:
            in_article = holder is not None and holder.label.startswith("article")
            around = (is_around(x.label) or holder is None and hints(x.label)) and not has_main[id(x)]
            if around or own[id(x)] and (holder is None or x.label.startswith("article") and not in_article):
                holder = x
        todo += [(k, holder) for k in reversed(x.kids)]
    return out


def parse(page: str) -> Part:
    """The elements and text blocks of a page; unclosed and stray tags are tolerated."""
    root = Part("page")
    stack, tags = [root], [""]
    block: list[str] = []
    linked, links = 0, 0
    opened: Counter[str] = Counter()  # how often each tag is in ``tags``
    deepest: dict[int, Part] = {}  # parts at depth ``DEEPEST`` with elements below

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(block).split())
        if text:
            part = Part(TEXT)
            part.text, part.linked = text, min(linked, len(text))
            stack[-1].kids.append(part)
        block.clear()
        linked = 0

    def close_last(tag: str) -> None:
        first = len(tags) - 1
        while tags[first] != tag:
            first -= 1
        opened.subtract(tags[first:])
        del stack[first:], tags[first:]

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        stop = token.start() if token else end
        if stop > at:
            words = html.unescape(page[at:stop])
            block.append(words)
            if links:
                linked += len(words)
        if token is None:
            break
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            if tag in INLINE and not opened[tag]:
                links = max(0, links - 1) if tag == "a" else links
                continue
            if opened[tag]:
                close_block()
                close_last(tag)
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            block.append("\n")
            continue
        attributes = token[3] or token[4] or ""
        if tag in VOID:
            if tag == "hr":
                close_block()
            continue
        if tag in INLINE:
            label = label_of(tag, attributes) if "=" in attributes else tag
            if not is_around(label):
                links += tag == "a"
                continue
        else:
            label = label_of(tag, attributes)
        close_block()
        links = 0
        if opened["p"] and tag not in INLINE:  # a block ends an open paragraph
            close_last("p")
        if tag in CLOSED_BY and tags[-1] in CLOSED_BY[tag]:
            close_last(tags[-1])
        if len(stack) > DEEPEST:
            deepest[id(stack[DEEPEST])] = stack[DEEPEST]
        part = Part(label)
        stack[-1].kids.append(part)
        stack.append(part)
        tags.append(tag)
        opened[tag] += 1
    close_block()
    for part in deepest.values():
        part.kids = _flat(part)
    return root


class Node:
    """A node of a host's expression.

    ``pages``: pages that have it; ``late``: pages before the first of them.  For text slots: ``chars`` and ``linked`` add up the text and
    the linked text, and ``same`` is the checksum of a text that never differed, else -1.
    """

    __slots__ = ("label", "optional", "repeated", "pages", "chars", "linked", "same", "late", "kids")

    def __init__(self, label, optional=0, repeated=0, pages=1, chars=0, linked=0, same=-1, late=0, kids=None):
        self.label, self.optional, self.repeated, self.pages = label, optional, repeated, pages
        self.chars, self.linked, self.same, self.late, self.kids = chars, linked, same, late, kids or []

    def packed(self) -> list:
        own = [self.label, self.optional, self.repeated, self.pages, self.chars, self.linked, self.same, self.late]
        return [*own, [k.packed() for k in self.kids]]

    @staticmethod
    def unpacked(x: list) -> Node:
        return Node(*x[:8], [Node.unpacked(k) for k in x[8]])


def merged(a: Node, b: Node, pages: int) -> Node:
    """One node that both fit; text that differs becomes a slot."""
    return Node(
        a.label,
        a.optional | b.optional,
        a.repeated | b.repeated,
        pages,
        a.chars + b.chars,
        a.linked + b.linked,
        a.same if a.same == b.same else -1,
        min(a.late, b.late),
        aligned(a.kids, b.kids, a.pages, b.pages),
    )


def folded(nodes: list[Node]) -> list[Node]:
    """Neighbouring groups that look alike, merged into repeated ones."""
    out: list[Node] = []
    for node in nodes:
        out.append(node)
        again = True
        while again:
            again = False
            for n in range(1, PERIOD + 1):
                if len(out) < 2 * n:
                    break
                first, second = out[-2 * n : -n], out[-n:]
                if all(x.label == y.label for x, y in zip(first, second, strict=True)):
                    out[-2 * n :] = [merged(x, y, max(x.pages, y.pages)) for x, y in zip(first, second, strict=True)]
                    for x in out[-n:]:
                        x.repeated = 1
                    again = n > 1
                    break
    return out


def _unique(labels: list[str], start: int, end: int) -> dict[str, int]:
    """The labels that stand once in a stretch, with their places."""
    seen: dict[str, int] = {}
    for n in range(start, end):
        seen[labels[n]] = -1 if labels[n] in seen else n
    return {label: n for label, n in seen.items() if n >= 0}


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, given by rising first places, whose second places rise as well."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, y) in enumerate(pairs):
        at = bisect_left(ends, y)
        before[n] = last[at - 1] if at else -1
        ends[at : at + 1], last[at : at + 1] = [y], [n]
    out = []
    n = last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A common subsequence of labels, as pairs of places, in about linear time.

    Equal ends match first, then labels that stand once on both sides; where there are none,
    the side whose next label comes sooner on the other side waits for it.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i == m or j == n:
            continue
        theirs = _unique(b, j, n)
        anchors = _rising([(x, theirs[label]) for label, x in _unique(a, i, m).items() if label in theirs])
        if anchors:
            for x, y in anchors:
                todo.append((i, x, j, y))
                i, j = x + 1, y + 1
            found += anchors
            todo.append((i, m, j, n))
            continue
        in_a, in_b = _places(a, i, m), _places(b, j, n)
        while i < m and j < n:
            if a[i] == b[j]:
                found.append((i, j))
                i, j = i + 1, j + 1
                continue
            skip_b, skip_a = _next(in_b, a[i], j) - j, _next(in_a, b[j], i) - i
            if skip_a <= skip_b:
                i += 1
            else:
                j += 1
    return sorted(found)


def _places(labels: list[str], start: int, end: int) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for n in range(start, end):
        out.setdefault(labels[n], []).append(n)
    return out


def _next(places: dict[str, list[int]], label: str, start: int) -> float:
    own = places.get(label, [])
    at = bisect_left(own, start)
    return own[at] if at < len(own) else math.inf


def aligned(a: list[Node], b: list[Node], pages_a: int, pages_b: int) -> list[Node]:
    """Two child streams as one: what only one of them has becomes optional.

    What fewer than one page in ``RARE`` has had since it was first seen is known by its telling words
    only, so names that hardly recur become one repeated child.
    """
    total = pages_a + pages_b
    out: list[Node] = []

    def add(node: Node) -> None:
        if node.pages * RARE < total - node.late and "." in node.label:
            plain = plain_label(node.label)
            if plain != node.label:
                node.label = plain
                if out and out[-1].label == plain:
                    out[-1] = merged(out[-1], node, min(total, out[-1].pages + node.pages))
                    out[-1].repeated = 1
                    return
        out.append(node)

    i = j = 0
    for x, y in [*matches([k.label for k in a], [k.label for k in b]), (len(a), len(b))]:
        for node in a[i:x]:
            node.optional = 1
            add(node)
        for node in b[j:y]:
            node.optional = 1
            node.late += pages_a
            add(node)
        if x < len(a):
            both = merged(a[x], b[y], a[x].pages + b[y].pages)
            both.late = a[x].late
            add(both)
        i, j = x + 1, y + 1
    return folded(out)


def expression(part: Part) -> Node:
    """One page as an expression of its own."""
    if part.label == TEXT:
        return Node(TEXT, 0, 0, 1, len(part.text), part.linked, zlib.crc32(part.text.encode("utf-8", "replace")))
    return Node(part.label, kids=folded([expression(k) for k in part.kids]))


def _tally(node: Node, pages: int, out: set[int]) -> tuple[int, int, int]:
    """Characters outside links that are not the host's own words, linked ones, and all; without ``out``."""
    if node.label == TEXT:
        fixed = node.same != -1 and node.pages > 2 and node.pages * 2 > pages
        dense = node.linked * 2 > node.chars
        return (0 if fixed or dense else node.chars - node.linked), node.linked, node.chars
    if id(node) in out or is_around(node.label) and not _has_main(node):
        return 0, 0, 0
    sums = [_tally(k, pages, out) for k in node.kids]
    return sum(s[0] for s in sums), sum(s[1] for s in sums), sum(s[2] for s in sums)


def _has_main(node: Node) -> bool:
    return any(is_main(k.label) and not is_around(k.label) or _has_main(k) for k in node.kids)


def verdict(root: Node) -> list:
    """The expression cut down to what extraction needs: [label, keep, [children]].

    ``keep`` is K (article), F (taken from pages where the article's element is missing) or D.
    An article or main element decides where there is one; else the element with most of the
    host's varying, unlinked text, without blocks that are the same on most pages.  An element whose
    name only ``hints`` is around if, inside the article, its text is mostly links or the host's own words;
    elsewhere, unless it has most of the host's varying, unlinked text.
    """
    article: set[int] = set()
    out: set[int] = set()  # elements around by the expression's judgement
    changing = _tally(root, root.pages, out)[0]

    def find(node: Node, tag: str) -> None:
        for k in node.kids:
            if is_around(k.label) and not _has_main(k):
                continue
            if is_main(k.label) and k.label.startswith(tag) and not is_around(k.label):
                article.add(id(k))
            else:
                find(k, tag)

    for tag in ("article", ""):
        if not article:
            find(root, tag)

    def judge(node: Node, inside: bool) -> None:
        for k in node.kids:
            out.discard(id(k))
            if hints(k.label) and not _has_main(k):
                own, linked, every = _tally(k, root.pages, out)
                if 2 * linked > every or changing and 2 * own < every if inside else 2 * own <= changing:
                    out.add(id(k))
            judge(k, inside or id(k) in article)

    judge(root, False)
    place = root
    while True:
        own = _tally(place, root.pages, out)[0]
        boxes = [k for k in place.kids if k.label != TEXT and k.label.partition(".")[0] not in BLOCK_TAGS]
        inner = [k for k in boxes if 10 * _tally(k, root.pages, out)[0] >= 7 * own > 0]
        if not inner:
            break
        place = inner[0]
    if not article and place.label.partition(".")[0] not in ("page", "html", "body"):
        judge(place, True)
    varies = _tally(place, root.pages, out)[0] > 0

    def cut(node: Node, inside: bool, dense: bool) -> list:
        if id(node) in out or is_around(node.label) and not _has_main(node):
            return [node.label, "D", []]
        inside = inside or id(node) in article
        dense = dense or node is place
        if node.label == TEXT:
            fallback = dense and (not varies or _tally(node, root.pages, out)[0] > 0)
            return [TEXT, "K" if inside else "F" if fallback else "D", []]
        kids = [cut(k, inside, dense) for k in node.kids]
        keeps = {k[1] for k in kids}
        if len(keeps) == 1 and "M" not in keeps:
            return [node.label, keeps.pop(), []]
        return [node.label, "M" if kids else "D", kids]

    return cut(root, False, False)


def extract(page: str | None, rule: list | None) -> str:
    """The blocks of the article's slots, in page order, one per line."""
    root = parse(page or "")
    kept: list[tuple[str, str]] = []

    def walk(part: Part, node: list | None, keep: str) -> None:
        if part.label == TEXT:
            kept.append((keep, part.text))
            return
        kids = node[2] if node else []
        if not kids:
            for k in part.kids:
                inner = "D" if is_around(k.label) and not any_main(k) else keep
                if inner != "D":
                    walk(k, None, inner)
            return
        # A repeated child takes all neighbours of its label; then the stream goes on.
        by_label = {x[0]: x for x in reversed(kids)}
        runs: list[str] = []
        of: list[int] = []
        for k in part.kids:
            label = k.label if k.label in by_label else plain_label(k.label)
            if not runs or runs[-1] != label:
                runs.append(label)
            of.append(len(runs) - 1)
        at = dict(matches(runs, [x[0] for x in kids]))
        for k, run in zip(part.kids, of, strict=True):
            own = kids[at[run]] if run in at else by_label.get(runs[run])
            if own is None:
                walk(k, None, "D" if is_around(k.label) else "F")
            elif own[1] != "D":
                walk(k, own, own[1])

    def any_main(part: Part) -> bool:
        return any(is_main(k.label) and not is_around(k.label) or any_main(k) for k in part.kids)

    walk(root, rule, rule[1] if rule else "F")
    chosen = [text for keep, text in kept if keep == "K"] or [text for keep, text in kept if keep == "F"]
    return "\n".join(chosen)


def _hosts(pages: DataFrame, key: str) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    ascii_lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select(key, "url", "html", ascii_lower.alias("host"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, rule (JSON) and pages of every host of ``pages`` (url, html).

    Each task aligns its own pages host by host; the expressions of the tasks are aligned
    in two rounds.  A host of ``n`` expressions is gathered in groups of some square root of ``n``, in
    both rounds, whatever its share of the pages.
    """

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Node] = {}
        for frame in frames:
            for url, page in zip(frame["url"], frame["html"], strict=True):
                host = split_url(url)[0]
                node = expression(parse(page or ""))
                seen = found.get(host)
                found[host] = merged(seen, node, seen.pages + 1) if seen else node
            if len(found) > 2000:
                yield rows(found)
                found = {}
        yield rows(found)

    def rows(found: dict[str, Node]) -> pd.DataFrame:
        packed = [(host, json.dumps(n.packed())) for host, n in found.items()]
        return pd.DataFrame(packed, columns=["host", "node"])

    def joined(group: pd.DataFrame) -> Node:
        total: Node | None = None
        for packed in sorted(group["node"]):
            node = Node.unpacked(json.loads(packed))
            total = merged(total, node, total.pages + node.pages) if total else node
        return total

    def first_round(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], json.dumps(joined(group).packed()))], columns=["host", "node"])

    def second_round(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        node = joined(group)
        return pd.DataFrame([(key[0], json.dumps(verdict(node)), node.pages)], columns=["host", "rule", "pages"])

    parts = pages.select("url", "html").mapInPandas(local, "host string, node string")
    parts = stored(parts.withColumn("number", F.monotonically_increasing_id()), "expressions")
    per_host = parts.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    most = per_host.agg(F.max("n").alias("n")).first()["n"] or 1
    salt = F.pmod(F.xxhash64("number"), F.lit(math.isqrt(most - 1) + 1))
    once = parts.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(first_round, "host string, node string")
    return once.groupBy("host").applyInPandas(second_round, "host string, rule string, pages long")


def main_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, url, text and n_chars of every row of ``pages`` (key, url, html).

    Null and empty pages, and pages without article text, have an empty text.  Very long pages are read
    whole, in time about linear in their length.  Equal pages have equal texts.  Pages without
    host share one expression.  Repeated rows and keys each give a row; further columns are
    ignored; an empty table gives an empty result.
    """
    wrappers = stored(infer_wrappers(pages), "wrappers").select(F.col("host").alias("of"), "rule")
    named = _hosts(pages, key)
    joined = named.join(wrappers, named["host"] == wrappers["of"], "left").select(key, "url", "html", "rule")
    fields = joined.schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules: dict[str | None, list | None] = {}
        for frame in frames:
            texts = []
            for page, rule in zip(frame["html"], frame["rule"], strict=True):
                if rule not in rules:
                    if len(rules) > 5000:
                        rules.clear()
                    rules[rule] = json.loads(rule) if rule else None
                texts.append(extract(page, rules[rule]))
            out = frame[[key, "url"]].copy()
            out["text"] = texts
            out["n_chars"] = [len(t) for t in texts]
            yield out

    kind = f"{key} {fields[key].dataType.simpleString()}, url string, text string, n_chars long"
    return joined.mapInPandas(run, kind)
