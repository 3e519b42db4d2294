"""Main text of web pages by wrapper induction over pages of the same host.

Pages become trees of block elements. Pages of a host with alike paths of tags are of one layout; those of each layout are
aligned with the one most like the others by simple tree matching (Yang 1991). A text that at least half of the aligned pages have in one place is template, all else is a slot; pages
that are near copies of each other count once; inside an article it takes four pages and four fifths of them, and headings stay. Slots are looked for in the article's node where the page has one or the wrapper
knows its place, else in the whole page; template inside the article goes too. Menus, headers, footers, forms, scripts and the
like never count.

Rows: null html counts as empty and gives an empty text; a null url counts as a host of its own; repeated pages are
alike, which makes no template by itself; an empty table gives no rows; only the named columns are used. Html of any
length is read whole; where two lists of children are too long for the matching, equal texts are aligned and what lies
between them in order.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import staged
from parcelmetrics.llm.tokens import small_batches

#: Pages aligned with each other, and pages of a host from which it is dealt out in parts.
ALIGNED, HOST_PART = 64, 256
#: Cells of the matching table beyond which children are aligned by their texts.
CELLS = 250_000
#: Share of common words from which pages are near copies, and of common paths of tags from which they are of one layout.
COPY, LAYOUT = 0.8, 0.5
#: Pages that are no copies of each other, and their share, from which a text inside an article is template.
SURE_PAGES, SURE_SHARE = 4, 0.8
HEADING = re.compile("h[1-6]")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    # Only after an equals sign does a quote begin a quoted value.
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s>/]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S,
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of the key closes open elements of the value, up to the nearest of the limits.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
LIMITS = frozenset("ul ol dl table select".split())
SKIPPED = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split() + list(RAW))
ROOTS = frozenset(("article", "main"))
#: Roles as whole names or as parts of compound ones; what only says that a page has or shows a part is no role.
MODIFIERS = re.compile(r"^(?:has|with|no|without|is|show|hide|open|page)[_-]|[_-](?:open|opened|closed|enabled|disabled|on|off|visible|hidden|active|layout|page)$", re.I)
ROLES = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe|sidebar|menu|nav|navbar|navigation|breadcrumbs?|comments?|replies|disqus|share|sharing|social|related|recommended|footer|masthead|search|contentinfo|complementary)(?:$|[_-])",
    re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Node:
    """An element with the blocks of text directly in it (by place among its children) and its element children."""

    __slots__ = ("tag", "skipped", "by_role", "items", "children")

    def __init__(self, tag: str, skipped: bool, by_role: bool = False):
        self.tag, self.skipped, self.by_role = tag, skipped or by_role, by_role
        self.items: list[str | Node] = []
        self.children: list[Node] = []

    def own(self) -> tuple[str, ...]:
        """The blocks directly in it."""
        return tuple(x for x in self.items if isinstance(x, str))

    def blocks(self) -> list[str]:
        """All its blocks in page order, without skipped elements."""
        out: list[str] = []
        todo: list[str | Node] = [self]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
            elif not item.skipped:
                todo.extend(reversed(item.items))
        return out


def skipped(tag: str, opened: Counter[str]) -> bool:
    """Whether an element of this tag never counts; a header does inside an article."""
    return tag in SKIPPED or tag == "header" and not any(opened[r] for r in ROOTS)


def has_role(tag: str, rest: str) -> bool:
    """Whether a class, id or role names a part beside the text. An article, and what holds one (see ``tree``), is none."""
    if "=" not in rest or tag in ("body", "html") or tag in ROOTS:
        return False
    values = (m[0].split("=", 1)[1].strip().strip("\"'") for m in NAMED.finditer(rest))
    return any(ROLES.search(name) and not MODIFIERS.search(name) for value in values for name in value.split())


def tree(page: str) -> Node:
    """The block elements of ``page``; inline elements leave their text only, and white space in a block is one space."""
    root = Node("", False)
    stack, text = [root], []
    opened: Counter[str] = Counter()
    at = 0

    def close() -> Node:
        node = stack.pop()
        opened[node.tag] -= 1
        return node

    def flush() -> None:
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if block:
                stack[-1].items.append(block)

    for match in TAG.finditer(page):
        if match.start() < at:  # inside raw text
            continue
        text.append(page[at : match.start()])
        at = match.end()
        if match["tag"] is None:
            continue
        tag = match["tag"].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if match["end"]:
            if opened[tag] > 0:
                while close().tag != tag:
                    pass
            continue
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        if stack[-1].tag == "p":  # no block lies in a paragraph
            close()
        if tag in CLOSES:
            k = len(stack) - 1
            while k > 0 and stack[k].tag not in LIMITS and stack[k].tag not in CLOSES[tag]:
                k -= 1
            while k > 0 and stack[k].tag in CLOSES[tag]:
                while len(stack) > k:
                    close()
                k -= 1
        node = Node(tag, skipped(tag, opened), has_role(tag, match["rest"]))
        if tag in ROOTS:
            for holder in reversed(stack):
                if not holder.by_role or holder.tag in SKIPPED:
                    continue
                holder.by_role = holder.skipped = False
        stack[-1].items.append(node)
        stack[-1].children.append(node)
        if not match["rest"].endswith("/"):
            stack.append(node)
            opened[tag] += 1
    text.append(page[at:])
    flush()
    return root


def in_order(left: list[Node], right: list[Node]) -> list[tuple[Node, Node]]:
    """Pairs of children: those with equal tag and text first, what lies between them in order."""
    x, y = ([(n.tag, n.own()) for n in side] for side in (left, right))
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    pairs = list(zip(left[:head], right[:head]))
    i = j = head
    middle = SequenceMatcher(None, x[head : len(x) - tail], y[head : len(y) - tail], autojunk=False)
    for block in middle.get_matching_blocks():  # the last one is empty and at the end
        p, q = head + block.a, head + block.b
        pairs += [(n, m) for n, m in zip(left[i:p], right[j:q]) if n.tag == m.tag]
        i, j = p + block.size, q + block.size
        pairs += zip(left[p:i], right[q:j])
    return pairs + list(zip(left[len(x) - tail :], right[len(y) - tail :]))


def matched(a: Node, b: Node, pairing: bool = True, known: dict[tuple[int, int], int] | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Size of the simple tree matching of two nodes of one tag, and the pairs of children matched; among largest
    matchings one with most equal texts. ``known`` has sizes found before."""
    left, right = a.children, b.children
    if not left or not right:
        return 1, []
    if not any(n.children for n in left + right) and len({n.tag for n in left + right}) == 1:
        return 1 + min(len(left), len(right)), in_order(left, right) if pairing else []
    if len(left) * len(right) > CELLS:
        pairs = in_order(left, right)
        return 1 + len(pairs), pairs
    known = {} if known is None else known
    texts = [n.own() for n in right]
    weight = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    size = {}
    for i, x in enumerate(left, 1):
        row, above = weight[i], weight[i - 1]
        text = x.own()
        for j, y in enumerate(right, 1):
            best = above[j] if above[j] >= row[j - 1] else row[j - 1]
            if x.tag == y.tag:
                common = 1
                if x.children and y.children:
                    common = known.get((id(x), id(y))) or matched(x, y, False, known)[0]
                    known[id(x), id(y)] = common
                size[i, j] = common * CELLS + (text != () and text == texts[j - 1])
                best = max(best, above[j - 1] + size[i, j])
            row[j] = best
    i, j, pairs = len(left) if pairing else 0, len(right), []
    while i and j:
        if (i, j) in size and weight[i][j] == weight[i - 1][j - 1] + size[i, j]:
            pairs.append((left[i - 1], right[j - 1]))
            i, j = i - 1, j - 1
        elif weight[i][j] == weight[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + weight[-1][-1] // CELLS, pairs[::-1]


def aligned(reference: Node, page: Node) -> list[tuple[Node, Node]]:
    """Pairs of matched nodes of two trees, from the roots down."""
    out, todo, known = [], [(reference, page)], {}
    while todo:
        a, b = todo.pop()
        out.append((a, b))
        todo.extend(zip(a.children, a.children) if a is b else matched(a, b, True, known)[1])
    return out


def roots(node: Node) -> list[Node]:
    """The outermost article nodes that are not skipped; main nodes where there is no article."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(node, False)]
    while todo:
        n, inside = todo.pop()
        if n.skipped:
            continue
        if n.tag in ROOTS and not (inside and n.tag == "article"):
            found[n.tag].append(n)
        todo.extend((c, inside or n.tag == "article") for c in reversed(n.children))
    return found["article"] or found["main"][:1]


def copies(trees: list[Node]) -> list[int | None]:
    """For each page the first page that it is a near copy of, or itself; None for pages without text."""
    out: list[int | None] = []
    words: dict[int, set[str]] = {}
    for k, t in enumerate(trees):
        own = {w for block in t.blocks() for w in block.split()}
        alike = ((j, other) for j, other in words.items() if COPY * max(len(own), len(other)) <= min(len(own), len(other)))
        near = (j for j, other in alike if len(own & other) >= COPY * len(own | other))
        out.append(next(near, k) if own else None)
        if out[-1] == k:
            words[k] = own
    return out


def paths(node: Node, numbers: dict[tuple[int, str], int]) -> Counter[int]:
    """How often each path of tags is in a tree; ``numbers`` has the number of a path by that of its parent and its tag."""
    out: Counter[int] = Counter()
    todo = [(node, 0)]
    while todo:
        n, path = todo.pop()
        out[path] += 1
        todo.extend((c, numbers.setdefault((path, c.tag), len(numbers) + 1)) for c in n.children)
    return out


def depth(node: Node) -> int:
    deepest, todo = 0, [(node, 1)]
    while todo:
        n, own = todo.pop()
        deepest = max(deepest, own)
        todo.extend((c, own + 1) for c in n.children)
    return deepest


def layouts(trees: list[Node]) -> list[list[int]]:
    """The places of the pages of each layout, its reference first. A page without elements is a layout of its own."""
    numbers: dict[tuple[int, str], int] = {}
    each = [paths(t, numbers) for t in trees]
    # Distinct paths count, so that long pages are like short ones of the same layout.
    kinds: dict[frozenset[int], int] = {}
    kind = [kinds.setdefault(frozenset(a), len(kinds)) for a in each]
    shares = [[len(a & b) / len(a | b) for b in kinds] for a in kinds]
    alike = [[shares[x][y] if shares[x][y] >= LAYOUT else 0 for y in kind] for x in kind]
    left, out = list(range(len(trees))), []
    while left:
        # Of most others of the layout, most paths, the first.
        reference = max(left, key=lambda k: (sum(alike[k][j] for j in left), sum(each[k].values()), -k))
        out.append([reference] + [k for k in left if k != reference and alike[reference][k]])
        left = [k for k in left if k not in out[-1]]
    return out


def main_texts(pages: list[str]) -> list[str]:
    """The main text of each of some pages of one host."""
    trees = [tree(p) for p in pages]
    # Matching descends by recursion, one Python frame for each level of the deepest page.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 2 * max(map(depth, trees), default=0)))
    out = [""] * len(trees)
    for members in layouts(trees):
        for k, text in zip(members, texts_of_layout([trees[k] for k in members])):
            out[k] = text
    return out


def texts_of_layout(trees: list[Node]) -> list[str]:
    """The main text of each of some pages of one layout, the first being the reference."""
    reference = trees[0]
    pairs = [aligned(reference, t) for t in trees]
    explicit = [roots(t) for t in trees]
    original = copies(trees)
    distinct = len(set(original) - {None})
    having: dict[tuple[int, tuple[str, ...]], set[int]] = {}
    article: Counter[int] = Counter()
    for own, found, first in zip(pairs, explicit, original):
        ids = {id(n) for n in found}
        for a, b in own:
            if first is not None:
                having.setdefault((id(a), b.own()), set()).add(first)
            if id(b) in ids:
                article[id(a)] += 1
    place = max(article, key=article.get) if article else None
    template = {key for key, some in having.items() if len(some) > 1 and 2 * len(some) >= distinct}
    # Inside an article two pages may say the same; template there needs many pages, and nearly all of them.
    sure = {key for key, some in having.items() if len(some) >= SURE_PAGES and len(some) >= SURE_SHARE * distinct}
    out = []
    for t, own, found in zip(trees, pairs, explicit):
        if not found and place is not None:
            found = [b for a, b in own if id(a) == place and not b.skipped]
        # What matches nothing varies; a heading in an article is its own.
        known = sure if found else template
        constant = {id(b) for a, b in own if (id(a), b.own()) in known and not (found and HEADING.fullmatch(b.tag))}
        out.append("\n".join(x for n in found or [t] for x in slots(n, constant)))
    return out


def slots(node: Node, constant: set[int]) -> list[str]:
    """Blocks of ``node`` but for those directly in nodes of ``constant``."""
    out: list[str] = []
    todo: list[tuple[str | Node, bool]] = [(node, False)]
    while todo:
        item, drop = todo.pop()
        if isinstance(item, str):
            if not drop:
                out.append(item)
        elif not item.skipped:
            todo.extend((x, id(item) in constant) for x in reversed(item.items))
    return out


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of every page. Hosts of many pages are dealt out in parts, so none fills a task."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*:/+(?:[^/?#@]*@)?([^/:?#]+)", 1)
    rows = rows.withColumn("host", host)
    large = rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > HOST_PART)
    # Written first, so that Spark knows its size and joins pages to a small list of hosts without a shuffle of their html.
    large = staged(large.select(F.col("host").alias("of"), F.ceil(F.col("n") / HOST_PART).alias("parts")), "hosts")
    dealt = rows.join(large, F.col("host") == F.col("of"), "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("page_id", "url"), "parts")).cast("int")).drop("of", "parts")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done(some: list[tuple]) -> pa.RecordBatch:
            texts = main_texts([h[4] for h in some])
            out = [pa.array([h[2] for h in some], pa.int64()), pa.array([h[3] for h in some], pa.string()), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(out, ["page_id", "url", "text"])

        for batch in small_batches(batches, "html"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "page_id", "url", "html"))):
                if held and held[-1][:2] != row[:2]:
                    yield done(held)
                    held = []
                elif len(held) == ALIGNED + ALIGNED // 2:  # so that no page is left over alone
                    yield done(held[:ALIGNED])
                    held = held[ALIGNED:]
                held.append(row)
        if held:
            yield done(held)

    return dealt.repartition("host", "part").sortWithinPartitions("host", "part", "page_id").mapInArrow(extract, "page_id long, url string, text string")
