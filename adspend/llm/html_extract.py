"""HTML main-text extraction by wrapper induction over same-host pages.

1. Every page is parsed once, by its whole html, into a tree of block elements.
   Runs of equal neighbouring subtrees are one repeated node, so a page's tree
   is its layout, whatever the number of its paragraphs, and pages of a host
   share few layouts.
2. Per host the commonest layout is the reference. Every other layout is
   aligned with it by simple tree matching (the largest set of node pairs with
   equal labels that keeps order and ancestors); equal subtrees are found by
   their hashes and matched whole, only what differs between them is compared.
   Long lists of children are compared by rows, in bounded memory, with the same
   result.
   Labels are element and class names; identifiers, which number things, are not
   part of them.
3. Texts are counted per host and aligned node, once for each distinct page
   content, so copies of a page say nothing about the host's template. A text
   that stands in the same node of nearly all distinct contents of a host is
   template; with ``mixed`` False only where no other text stands in that node.
4. A page's content are the blocks inside the article (``main``, or ``article``
   elements); without an article, the body's blocks that are not template. In
   the article a container (``CONTAINERS``) whose blocks are all template is no
   content, whatever it is called: a notice, an advert, a menu. Headings and
   paragraphs that stand in the article's own flow, or beside others that vary,
   are content, constant or not. Menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles and reader comments that say so by element,
   role or class never count. A class says so by its whole name, or by parts
   that are all listed in ``NAMES`` or ``PARTNERS``: ``share-links`` does,
   ``share-of-market`` doesn't.

Layouts and counts are combined inside the tasks before any shuffle, so a host
with a third of all pages costs no more rows than another. The induced
wrappers (constant texts by host and layout) are broadcast below
``BROADCAST_BYTES`` of measured size, else joined by a shuffle; the result is
the same.

Defined results: a null or empty page has the text "" and 0 characters; a
null URL belongs to the host "". Blocks keep page order and are not cut.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut

MIN_PAGES = 10           # of a host, with contents of their own, for a text to be called constant
CONSTANT_SHARE = 0.9     # of the host's distinct contents that have it in the same node
BROADCAST_BYTES = 16 << 20
PAIRS = 200_000          # of nodes with equal labels that are compared one by one; beyond, by rows
CELLS = 1 << 20          # numbers of rows that are kept

# Element names of HTML.
BLOCKS = frozenset("""html body head title article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol
    li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption form fieldset legend address
    hr details summary dialog menu center hgroup search iframe object canvas svg select button textarea option
    noscript template""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea".split())
#: never content
DROPPED = frozenset("""head title nav footer aside form script style noscript template iframe object canvas svg select
    button textarea option dialog menu search""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
#: words of class and id names that mark what is not the article
NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login
    sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments
    disqus reply replies respond share sharing social related recommended recommendations widget widgets pagination
    pager search copyright legal disclaimer skip hidden""".split())
COMMENTS = frozenset({"comment", "comments"})
#: of these, names that parts of an article have too
OWN_NAMES = frozenset({"header"})
#: other parts that such names are made of: share-links, site-footer, comment-list
PARTNERS = frozenset("""area bar block body bottom box btn button buttons content container group home inner item items
    left line link links list main middle outer page panel section site slot strip top right unit wrap wrapper zone
    primary secondary global icons icon row col column first last entry post article mobile desktop sticky fixed
    google text and form open thread""".split())
#: elements that hold blocks of their own; in an article one that is all template is no content
CONTAINERS = frozenset("div section ul ol dl table figure details fieldset address center hgroup".split())
#: an open element that ends where one of these begins
CLOSES = {
    "p": BLOCKS - {"html", "head", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"},
    "option": {"option"}, "head": {"body"},
}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
                  re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                        re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}


class Node:
    __slots__ = ("tag", "label", "parent", "children", "dropped", "root", "number", "box")

    def __init__(self, tag: str, label: str, parent: Node | None, dropped: bool, root: bool):
        self.tag, self.label, self.parent = tag, label, parent
        self.children: list[Node] = []
        self.dropped, self.root, self.number = dropped, root, 0
        # the nearest container inside the article
        self.box: Node | None = self if root and parent.root and tag in CONTAINERS else parent and parent.box
        if parent is not None:
            parent.children.append(self)


def _says(name: str, against: frozenset[str]) -> bool:
    """Whether a class or id name is one of ``against``, or made of such and their partners alone."""
    parts = _WORD.findall(name)
    return any(w in against for w in parts) and all(w in against or w in PARTNERS for w in parts)


def _open(tag: str, attributes: str, parent: Node) -> Node:
    names, dropped = [], parent.dropped or tag in DROPPED
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            if name == "class":
                names += value.split()
            # the page and the article are told by their elements; there only comments count
            against = COMMENTS if tag in ("html", "body", "article", "main") else (
                NAMES - OWN_NAMES if parent.root else NAMES)
            dropped = dropped or any(_says(x, against) for x in value.split())
        elif name == "role":
            dropped = dropped or value in ROLES
        else:
            dropped = dropped or name == "hidden" or value == "true"
    if tag == "header" and not parent.root:  # of the page; an article's own header is part of it
        dropped = True
    label = ".".join([tag, *(re.sub(r"[^a-z0-9_-]", "", n) for n in names[:3])])
    return Node(tag, label, parent, dropped, parent.root or tag in ("article", "main"))


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """The tree of a page's block elements, and its texts in page order:
    the element, the text (one space for white space), its characters in links."""
    top = node = Node("#", "#", None, False, False)
    blocks: list[tuple[Node, str, int]] = []
    text: list[str] = []
    linked = [0, 0]  # open links, characters in them

    def flush() -> None:
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                blocks.append((node, whole, linked[1]))
            text.clear()
        linked[1] = 0

    def said(part: str) -> None:
        if part:
            part = html.unescape(part)
            text.append(part)
            if linked[0]:
                linked[1] += len(part)

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        said(page[at: m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1), m.group(2), m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            end = None if attributes.endswith("/") else _END[tag].search(page, at)
            if not attributes.endswith("/"):
                at = len(page) if end is None else end.end()
            continue
        if tag == "script" or tag == "style":
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            linked[0] = max(0, linked[0] + (-1 if closing else 1))
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            up = node
            while up is not top and up.tag != tag:
                up = up.parent
            if up is not top:
                node = up.parent
            continue
        while node.tag in CLOSES and tag in CLOSES[node.tag]:
            node = node.parent
        new = _open(tag, attributes, node)
        if tag not in VOID:
            node = new
    said(page[at:])
    flush()
    return top, blocks


def layout(top: Node) -> str:
    """The collapsed tree as text; numbers every node by its place in it."""
    order, todo = [], [top]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(n.children)
    shape: dict[int, str] = {}
    size: dict[int, int] = {}
    groups: dict[int, list[list[Node]]] = {}
    for n in reversed(order):
        runs: list[list[Node]] = []
        for c in n.children:
            if runs and shape[id(runs[-1][0])] == shape[id(c)]:
                runs[-1].append(c)
            else:
                runs.append([c])
        groups[id(n)] = runs
        shape[id(n)] = f"{n.label}({','.join(shape[id(r[0])] for r in runs)})"
        size[id(n)] = 1 + sum(size[id(r[0])] for r in runs)
    todo = [top]
    while todo:
        n = todo.pop()
        number = n.number + 1
        for run in groups[id(n)]:
            for c in run:
                c.number = number
                todo.append(c)
            number += size[id(run[0])]
    return shape[id(top)]


def content(blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str]]:
    """The blocks that can be the article's."""
    inside = any(n.root and not n.dropped for n, _, _ in blocks)
    return [(n, t) for n, t, links in blocks
            if not n.dropped and (n.root if inside else not (n.tag == "li" and links > 0.5 * len(t)))]


def tree(shape: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children of a layout's nodes, by number."""
    labels, children, path = [], [], []
    for m in re.finditer(r"([^(),]+)\(|\)", shape):
        if m.group(1) is None:
            path.pop()
            continue
        if path:
            children[path[-1]].append(len(labels))
        path.append(len(labels))
        labels.append(m.group(1))
        children.append([])
    return labels, children


def _numbered(shape: str, known: dict[tuple, int]) -> tuple[list[str], list[list[int]], list[int], list[int]]:
    """Labels, children, sizes and subtree numbers of a layout's nodes; equal subtrees have equal numbers."""
    labels, children = tree(shape)
    size, kind = [1] * len(labels), [0] * len(labels)
    for n in range(len(labels) - 1, -1, -1):  # children have larger numbers
        size[n] += sum(size[c] for c in children[n])
        kind[n] = known.setdefault((labels[n], *(kind[c] for c in children[n])), len(known))
    return labels, children, size, kind


def _heaviest(pairs: list[tuple[int, int, int]], width: int) -> list[tuple[int, int]]:
    """The order-keeping choice of (i, j) pairs with the largest total weight; a tree of best totals by j."""
    best: list[tuple[int, int]] = [(0, -1)] * (width + 1)  # (total, last pair) over j's up to here
    back = []
    for n, (i, j, w) in enumerate(sorted(pairs, key=lambda p: (p[0], -p[1]))):
        total, k = (0, -1), j
        while k > 0:
            total = max(total, best[k])
            k -= k & -k
        mine, k = (total[0] + w, n), j + 1
        back.append((i, j, total[1]))
        while k <= width:
            best[k] = max(best[k], mine)
            k += k & -k
    out, n = [], max(best)[1]
    while n >= 0:
        i, j, n = back[n]
        out.append((i, j))
    return out[::-1]


def _laid(lists: list[list[int]], none: int, apart: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists laid end to end, ``none`` before each: the slots, what totals over a list start with, its last slot.
    Starts are ``apart``, so the totals of a list are below those of the next."""
    sizes = np.array([len(c) + 1 for c in lists], np.int64)
    ends = np.cumsum(sizes)
    slots = np.full(ends[-1], none, np.int64)
    slots[np.delete(np.arange(len(slots)), ends - sizes)] = np.fromiter(chain.from_iterable(lists), np.int64)
    return slots, np.repeat(np.arange(len(lists), dtype=np.int64) * apart, sizes), ends - 1


def _take(totals: np.ndarray, slots: np.ndarray, row: np.ndarray) -> None:
    """Best order-keeping totals up to each slot, with one child more on the other side."""
    more = row[slots[1:]]
    more += totals[:-1]
    np.maximum(totals[1:], more, out=totals[1:])
    np.maximum.accumulate(totals, out=totals)


class _Rows:
    """Weights of a subtree of one layout with all of some siblings' distinct subtrees in another, and a last 0.

    A node is matched with nodes of its own depth alone, so totals over the child lists of that depth, one
    array a depth, are all that is held; every child goes through all the lists at once. Rows of repeated
    subtrees are kept, up to ``CELLS`` numbers.
    """

    def __init__(self, labels: list[str], size: list[int], kind: list[int],
                 siblings: list[int], labels_b: list[str], children_b: list[list[int]], kind_b: list[int]):
        self.labels, self.size, self.kind = labels, size, kind
        self.kept: dict[tuple[int, int], np.ndarray] = {}
        self.held = 0
        self.counts: list[int] = []
        # of each depth, by label: the subtrees' places, and their child lists
        self.parts: list[dict[str, tuple[np.ndarray, ...]]] = []
        level = list({kind_b[n]: n for n in siblings}.values())
        self.places = {kind_b[n]: at for at, n in enumerate(level)}
        while level:
            below = list({kind_b[c]: c for n in level for c in children_b[n]}.values())
            places, parts = {kind_b[c]: at for at, c in enumerate(below)}, {}
            for at, n in enumerate(level):
                parts.setdefault(labels_b[n], []).append(at)
            self.counts.append(len(level))
            self.parts.append({label: (np.array(ats), *_laid(
                [[places[kind_b[c]] for c in children_b[level[at]]] for at in ats], len(below), len(labels) + 1))
                for label, ats in parts.items()})
            level = below

    def __call__(self, top: int) -> np.ndarray:
        path: list[tuple[int, tuple[np.ndarray, ...], np.ndarray]] = []  # open nodes, their lists and totals
        n = top
        while True:
            row = self.kept.get((len(path), self.kind[n]))
            part = self.parts[len(path)].get(self.labels[n]) if row is None else None
            if part is not None:
                path.append((n, part, part[2].copy()))
                n += 1 if len(path) < len(self.parts) else self.size[n]  # numbers of a subtree follow each other
            elif path:
                if row is not None:
                    _take(path[-1][2], path[-1][1][1], row)
                n += self.size[n]
            else:
                return np.zeros(self.counts[0] + 1, np.int64) if row is None else row
            while path and n == path[-1][0] + self.size[path[-1][0]]:
                a, (places, _, starts, ends), totals = path.pop()
                row = np.zeros(self.counts[len(path)] + 1, np.int64)
                row[places] = 1 + totals[ends] - starts[ends]
                if self.held + len(row) <= CELLS:
                    self.kept[len(path), self.kind[a]] = row
                    self.held += len(row)
                if not path:
                    return row
                _take(path[-1][2], path[-1][1][1], row)


def _heaviest_by_rows(rows: Callable[[int], np.ndarray], x: list[int], slots: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """The largest total weight, and the choice ``_heaviest`` makes, of all pairs of ``x`` and ``slots``.

    Totals are kept at the start of every block of children only; from the last block to the first, its
    rows are made again and the choice is read from them.
    """
    slots = np.concatenate([[-1], slots])
    block = max(isqrt(len(x)) + 1, CELLS // len(slots))
    totals, saved = np.zeros(len(slots), np.int64), []
    for i in range((len(x) - 1) // block * block):
        if i % block == 0:
            saved.append(totals.astype(np.int32))
        _take(totals, slots, rows(x[i]))
    saved.append(totals.astype(np.int32))
    out, whole, left, j = [], None, 0, len(slots) - 1
    for at in range((len(x) - 1) // block * block, -1, -block):
        totals, seen = saved.pop().astype(np.int64), []
        for n in x[at: at + block]:
            row = rows(n)
            seen.append((totals.astype(np.int32), row[slots[1:]].astype(np.int32)))
            _take(totals, slots, row)
        if whole is None:
            whole = left = int(totals[-1])
        for i in range(at + len(seen) - 1, at - 1, -1):
            before, weight = seen.pop()
            ends = np.flatnonzero((weight[:j] > 0) & (before[:j] + weight[:j] == left))
            if len(ends):
                j = int(ends[0])
                left = int(before[j])
                out.append((i, j))
    return whole, out[::-1]


def match(page: str, reference: str) -> list[int]:
    """For each node of a layout, the reference's node it is aligned with, or -1.

    Simple tree matching: roots must have equal labels; of their children that
    order-keeping matching is taken whose matched subtrees have the most nodes.
    Equal subtrees are matched whole; equal children at both ends of two lists
    belong together (nothing else could match more of them), so only the lists'
    different middles are compared, and there only children with equal labels.
    Middles with more than ``PAIRS`` such pairs, or whose pairs hold more than ``PAIRS``
    pairs of nodes, are compared by rows: the same matching, in memory of the order of
    the longer list times the root of the other. Time stays quadratic.
    """
    known: dict[tuple, int] = {}
    la, ca, sa, ka = _numbered(page, known)
    lb, cb, sb, kb = _numbered(reference, known)
    weights: dict[tuple[int, int], int] = {}  # by subtree numbers
    picked: dict[tuple[int, int], list[tuple[int, int]]] = {}  # what was chosen by rows

    def middles(a: int, b: int) -> tuple[int, list[int], list[int]]:
        x, y = ca[a], cb[b]
        lo = 0
        while lo < min(len(x), len(y)) and ka[x[lo]] == kb[y[lo]]:
            lo += 1
        hi = 0
        while hi < min(len(x), len(y)) - lo and ka[x[-1 - hi]] == kb[y[-1 - hi]]:
            hi += 1
        return lo, x[lo: len(x) - hi], y[lo: len(y) - hi]

    def candidates(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        where: dict[str, list[int]] = {}
        for j, n in enumerate(y):
            where.setdefault(lb[n], []).append(j)
        return [(i, j) for i, n in enumerate(x) for j in where.get(la[n], ())]

    def weight(a: int, b: int) -> int | None:
        if ka[a] == kb[b]:
            return sa[a]
        return 0 if la[a] != lb[b] else weights.get((ka[a], kb[b]))

    def chosen(a: int, b: int) -> list[tuple[int, int]]:
        _, x, y = middles(a, b)
        best = picked.get((ka[a], kb[b]))
        if best is None:
            best = _heaviest([(i, j, w) for i, j in candidates(x, y) if (w := weight(x[i], y[j]))], len(y))
        return [(x[i], y[j]) for i, j in best]

    def solve(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:  # children before their parents, without recursion
            a, b = todo[-1]
            if weight(a, b) is not None:
                todo.pop()
                continue
            lo, x, y = middles(a, b)
            of, missing = Counter(lb[n] for n in y), {}
            many = sum(of[la[n]] for n in x) > PAIRS
            if not many:
                missing = {(ka[x[i]], kb[y[j]]): (x[i], y[j]) for i, j in candidates(x, y) if weight(x[i], y[j]) is None}
                many = len(missing) > 1 and sum(sa[i] * sb[j] for i, j in missing.values()) > PAIRS
            if many:
                rows = _Rows(la, sa, ka, y, lb, cb, kb)
                inner, picked[ka[a], kb[b]] = _heaviest_by_rows(rows, x, np.array([rows.places[kb[n]] for n in y]))
            elif missing:
                todo.extend(missing.values())
                continue
            else:
                inner = sum(weight(*p) for p in chosen(a, b))
            ends = ca[a][:lo] + ca[a][lo + len(x):]
            weights[ka[a], kb[b]] = 1 + sum(sa[c] for c in ends) + inner
            todo.pop()

    solve(0, 0)
    out, todo = [-1] * len(la), [(0, 0)] if weight(0, 0) else []
    while todo:
        a, b = todo.pop()
        if ka[a] == kb[b]:  # numbers of a subtree follow each other
            out[a: a + sa[a]] = range(b, b + sa[a])
            continue
        if len(weights) > 2 * PAIRS:  # found again where they are needed
            weights.clear()
            picked.clear()
        solve(a, b)  # what was compared by rows left no weights of the pairs below
        out[a] = b
        lo, x, y = middles(a, b)
        todo += zip(ca[a][:lo], cb[b][:lo], strict=True)
        tail = len(ca[a]) - lo - len(x)
        todo += zip(ca[a][lo + len(x):], cb[b][len(cb[b]) - tail:], strict=True)
        todo += chosen(a, b)
    return out


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


_PARSED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()),
    T.StructField("layout", T.LongType()), T.StructField("content", T.LongType()),  # digest of all its texts
    # of all blocks: the layout's node, or -1 in an article's own flow, which is never template; the text's digest;
    # the container's place among the page's, or -1 outside of containers of an article
    T.StructField("nodes", T.ArrayType(T.IntegerType())), T.StructField("digests", T.ArrayType(T.LongType())),
    T.StructField("boxes", T.ArrayType(T.IntegerType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("shape", T.StringType())])  # the layout's text, on one row a batch and host
_PARSED_ARROW = pa.schema([
    ("id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("layout", pa.int64()), ("content", pa.int64()),
    ("nodes", pa.list_(pa.int32())), ("digests", pa.list_(pa.int64())), ("boxes", pa.list_(pa.int32())),
    ("texts", pa.list_(pa.string())),
    ("shape", pa.string())])


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows, told = [], set()
            for page_id, url, host, page in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                top, blocks = parse(page or "")
                shape = layout(top)
                own, key = content(blocks), _digest(shape)
                texts, boxes = [t for _, t in own], {}
                # a text has no line break of its own
                rows.append((page_id, url, host, key, _digest("\n".join(texts)),
                             [n.number if n.box or not n.root else -1 for n, _ in own], [_digest(t) for t in texts],
                             [boxes.setdefault(id(n.box), len(boxes)) if n.box else -1 for n, _ in own],
                             texts, None if (host, key) in told else shape))
                told.add((host, key))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARSED_ARROW, strict=True)],
                schema=_PARSED_ARROW)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, key, shape, reference = (c.to_pylist() for c in batch.columns)
        maps = [match(s, r) for s, r in zip(shape, reference, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(key, pa.int64()),
                                          pa.array(maps, pa.list_(pa.int32()))], names=["host", "layout", "slots"])


def wrappers(parsed: DataFrame, min_pages: int = MIN_PAGES, share: float = CONSTANT_SHARE,
             mixed: bool = True) -> DataFrame:
    """host, layout and its constant (node, digest) pairs, from all distinct contents of each host."""
    # one page stands for all pages of a host that have its texts
    distinct = cut(parsed.groupBy("host", "content").agg(F.min(F.struct("layout", "nodes", "digests")).alias("p")).select(
        "host", "p.*"), "html-contents")
    pages = distinct.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"))
    shapes = parsed.where("shape IS NOT NULL").groupBy("host", "layout").agg(F.first("shape").alias("shape"))
    layouts = shapes.join(pages, ["host", "layout"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = layouts.groupBy("host").agg(F.max(F.struct("n", "shape")).alias("best"), F.sum("n").alias("total"))
    best = best.where(F.col("total") >= min_pages)
    # few bytes and much work: an explicit number of tasks, which is not merged by size
    n = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = layouts.join(best, "host").select("host", "layout", "shape", F.col("best.shape").alias("reference")).repartition(
        n, F.xxhash64("host", "layout"))  # by plain columns it would fall to the aggregate's shuffle, which is merged
    slots = cut(pairs.mapInArrow(_align, T.StructType([
        T.StructField("host", T.StringType()), T.StructField("layout", T.LongType()),
        T.StructField("slots", T.ArrayType(T.IntegerType()))])), "html-slots")
    # a text counts once a content and node; counts are combined before every shuffle
    stood = distinct.select("host", "layout", F.explode(F.array_distinct(F.filter(
        F.arrays_zip("nodes", "digests"), lambda b: b["nodes"] >= 0))).alias("b"))
    stood = stood.groupBy("host", "layout", "b.nodes", "b.digests").agg(F.count(F.lit(1)).alias("n"))
    stood = stood.join(slots, ["host", "layout"]).select(
        "host", F.element_at("slots", F.col("nodes") + 1).alias("slot"), "digests", "n").where("slot >= 0")
    stood = stood.groupBy("host", "slot", "digests").agg(F.sum("n").alias("n"))
    constant = stood.join(best.select("host", "total"), "host").where(
        (F.col("n") >= min_pages) & (F.col("n") >= share * F.col("total")))
    if not mixed:  # the rarest text of the node is constant too
        rarest = stood.groupBy("host", "slot").agg(F.min("n").alias("rarest"))
        constant = constant.join(rarest, ["host", "slot"]).where(
            (F.col("rarest") >= min_pages) & (F.col("rarest") >= share * F.col("total")))
    nodes = slots.select("host", "layout", F.posexplode("slots").alias("node", "slot"))
    return nodes.join(constant, ["host", "slot"]).groupBy("host", "layout").agg(
        F.collect_set(F.struct("node", "digests")).alias("constant"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, share: float = CONSTANT_SHARE,
            broadcast_bytes: int = BROADCAST_BYTES, mixed: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    With ``mixed`` a constant text is template also in a node where other texts
    vary; without, such a text stays.
    """
    url = F.col(f"`{url_col}`")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), url.alias("url"), host.alias("host"),
                        F.col(f"`{html_col}`").alias("page"))
    parsed = cut(rows.mapInArrow(_parse_batches, _PARSED), "html-blocks")
    found = cut(wrappers(parsed, min_pages, share, mixed), "html-wrappers")
    size = found.agg(F.sum(F.size("constant") * 12 + F.octet_length("host") + 40)).first()[0] or 0
    found = F.broadcast(found) if size <= broadcast_bytes else found.hint("merge")
    blocks = F.arrays_zip(F.col("nodes").alias("node"), "digests", "boxes", "texts")

    def varies(b):
        return ~F.coalesce(F.array_contains(F.col("constant"), F.struct(b["node"].alias("node"), b["digests"].alias("digests"))),
                           F.lit(False))

    # a container stays whole where one of its blocks varies
    whole = F.transform(F.filter(blocks, lambda b: (b["boxes"] >= 0) & varies(b)), lambda b: b["boxes"])
    kept = F.filter("blocks", lambda b: varies(b) | ((b["boxes"] >= 0) & F.array_contains(F.col("whole"), b["boxes"])))
    text = F.when(F.col("constant").isNull(), F.array_join("texts", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda b: b["texts"]), "\n"))
    out = parsed.join(found, ["host", "layout"], "left").withColumn("blocks", blocks).withColumn("whole", whole).select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
