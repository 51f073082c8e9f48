"""HTML bodies -> rows (J1, J2): the only Python on the page path.

Spark's ``xpath`` needs well-formed XML and fails on ``<br>``, so pages are
tokenised inside ``mapInArrow`` (Arrow batches, one partition at a time):
well-formed markup by one regular expression, a page with anything else by the
standard library's ``html.parser``.  Both build a small element tree with
HTML's void elements and implied end tags; rules are functions over that tree.  Only (key, body) columns enter Python, and only
the extracted rows leave it; normalisation, joins and assembly stay in
Catalyst.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
# start tag -> open elements it closes implicitly (HTML's optional end tags)
BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer",
         "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol",
         "p", "pre", "section", "table", "ul"}
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPE_STOP = {"table", "ul", "ol", "dl", "div", "nav", "body", "html"}
# a block also closes an open paragraph
CLOSES = {t: frozenset(IMPLIED.get(t, set()) | ({"p"} if t in BLOCK else set())) for t in BLOCK | set(IMPLIED)}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "kids")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None" = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []        # Node or str (text node)
        self.kids: list[Node] = []      # the nodes among them

    @property
    def classes(self) -> str:
        return self.attrs.get("class") or ""

    def elements(self) -> list["Node"]:
        return self.kids

    def texts(self) -> list[str]:
        """Direct text nodes (like XPath ``text()``)."""
        return [c for c in self.children if isinstance(c, str)]

    def descendants(self) -> Iterator["Node"]:
        """Element descendants in document order (iterative: deep pages
        do not hit the recursion limit)."""
        stack = self.kids[::-1]
        while stack:
            n = stack.pop()
            yield n
            if n.kids:
                stack.extend(reversed(n.kids))

    def next_sibling(self, tag: str) -> "Node | None":
        """The first sibling after this one with the tag."""
        sib = self.parent.kids if self.parent is not None else []
        after = iter(sib)
        for s in after:
            if s is self:
                return next((x for x in after if x.tag == tag), None)
        return None


class _Tree:
    """The element tree of a page, from its tags and texts in order."""

    def __init__(self):
        self.root = Node("#root", {})
        self.stack = [self.root]

    def open(self, tag: str, attrs: dict, empty: bool = False):
        stack = self.stack
        closes = CLOSES.get(tag)
        if closes is not None:                      # implied end tags
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t in closes:
                    del stack[i:]
                    break
                if t in SCOPE_STOP:
                    break
        parent = stack[-1]
        node = Node(tag, attrs, parent)
        parent.children.append(node)
        parent.kids.append(node)
        if not empty and tag not in VOID:
            stack.append(node)

    def shut(self, tag: str):
        stack = self.stack
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                del stack[i:]
                return

    def text(self, data: str):
        children = self.stack[-1].children
        if children and isinstance(children[-1], str):
            children[-1] += data
        else:
            children.append(data)

    def comment(self):
        parent = self.stack[-1]
        node = Node("#comment", {}, parent)
        parent.children.append(node)
        parent.kids.append(node)


class _TreeBuilder(HTMLParser):
    """Feeds a tree with what the standard library reads in any page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = _Tree()

    def handle_starttag(self, tag, attrs):
        self.tree.open(tag, {k: (v if v is not None else "") for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.tree.open(tag, {k: (v if v is not None else "") for k, v in attrs}, empty=True)

    def handle_endtag(self, tag):
        self.tree.shut(tag)

    def handle_data(self, data):
        self.tree.text(data)

    def handle_comment(self, data):
        self.tree.comment()


# Well-formed markup, on whose reading all parsers agree: lower-case tags, attributes in double
# quotes, comments without "--", scripts without "</" or "<!" inside; then the text up to the next "<".
_ATTRS = r'((?:[ \n]+[a-z][a-z0-9-]*="(?:[^"&<>]|&amp;)*")*+)'
_OWN_TEXT = "title|textarea|iframe|xmp|noembed|noframes|noscript"
_PLAIN = re.compile(
    r"<(?:/(?P<end>[a-z][a-z0-9]*)>"
    rf"|(?P<start>(?!(?:script|style|plaintext|{_OWN_TEXT})[ \n/>])[a-z][a-z0-9]*){_ATTRS} ?(?P<empty>/?)>"
    r"|!--(?P<comment>)(?!-?>)(?:[^-]|-(?!-))*+-->"
    r"|!(?:doctype|DOCTYPE) [^<>\[]*>"
    rf"|(?P<raw>script|style){_ATTRS}>(?P<inside>(?:[^<]|<(?![/!]))*+)</(?P=raw)>"
    rf"|(?P<own>{_OWN_TEXT}){_ATTRS}>(?P<words>[^<&]*+)</(?P=own)>)"
    r"(?P<text>[^<]*+)")
_ATTR = re.compile(r'([a-z0-9-]+)="([^"]*)"')


def _plain_tree(html: str, scope: str | None = None) -> Node | None:
    """The tree of a page in which all markup is plain; None for any other.

    With ``scope``, only the divs whose class contains it are built, as children of the root,
    with all that is inside them; reading ends with the last of them.  What is outside is
    followed by its tags alone."""
    if scope is not None and "&" in scope:          # written otherwise in the page
        scope = None
    root = Node("#root", {})
    stack: list[Node | None] = [root]               # open elements; None for one that isn't built
    tags = ["#root"]
    inside = 0                                      # where in the stack the outermost scope is; 0: nowhere
    built = scope is None
    at = html.find("<")
    at = len(html) if at < 0 else at
    if at and built:
        root.children.append(unescape(html[:at]))
    seen = {"": {}}                                 # attributes as written -> read; shared by nodes
    for m in _PLAIN.finditer(html, at):
        if m.start() != at:
            return None
        at = m.end()
        end, start, attrs, empty, comment, raw, raw_attrs, script, own, own_attrs, words, text = m.groups()
        if end is not None:
            if tags[-1] == end:
                del tags[-1], stack[-1]
            else:
                for i in range(len(tags) - 1, 0, -1):
                    if tags[i] == end:
                        del tags[i:], stack[i:]
                        break
        elif comment is not None:
            if built:
                node = Node("#comment", {}, stack[-1])
                stack[-1].children.append(node)
                stack[-1].kids.append(node)
        elif start is not None or raw is not None or own is not None:
            if start is None:
                start, attrs = (raw, raw_attrs) if raw is not None else (own, own_attrs)
            if start in CLOSES:                     # implied end tags
                closes = CLOSES[start]
                for i in range(len(tags) - 1, 0, -1):
                    if tags[i] in closes:
                        del tags[i:], stack[i:]
                        break
                    if tags[i] in SCOPE_STOP:
                        break
                if inside >= len(tags):
                    inside, built = 0, False
            node = None
            enters = not built and start == "div" and scope in attrs
            if built or enters:
                read = seen.get(attrs)
                if read is None:
                    read = seen[attrs] = {k: v.replace("&amp;", "&") for k, v in _ATTR.findall(attrs)}
                enters = enters and scope in read.get("class", "")
                if built or enters:
                    parent = stack[-1] if built else root
                    node = Node(start, read, parent)
                    parent.children.append(node)
                    parent.kids.append(node)
            if raw is not None or own is not None:
                if node is not None and (script or words):
                    node.children.append(script or words)
            elif not empty and start not in VOID:
                if enters:
                    inside, built = len(tags), True
                stack.append(node)
                tags.append(start)
        if inside and inside >= len(tags):          # the scope has ended
            inside, built = 0, False
            # an attribute may be written with character references, so none may follow either
            if html.find(scope, at) < 0 and html.find("&", at) < 0:
                return root
        if built and text:
            children = stack[-1].children
            if "&" in text:
                text = unescape(text)
            if children and children[-1].__class__ is str:
                children[-1] += text
            else:
                children.append(text)
    return root if at == len(html) else None


def parse_html(html: str, scope: str | None = None) -> Node:
    """The element tree of a page; of a plain page, only the ``scope`` divs if one is named."""
    root = _plain_tree(html or "", scope)
    if root is not None:
        return root
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return b.tree.root


# ------------------------------------------------------------------ rules

def spec_sheet_rows(root: Node, scope_class: str = "config-section",
                    inner_class: str = "special-layout-18") -> list[dict]:
    """Label cells ``td/span[@class="title"]`` inside a ``div`` whose class
    contains ``inner_class`` inside a ``div`` whose class contains
    ``scope_class``; value cell = first following sibling ``td``.

    Per label: first direct text (the caller cuts its last character),
    ``info`` = direct texts of child ``span.info``, ``alt`` = direct texts of
    descendant ``div.l``, ``colours`` = ``div.focus-color-warp`` ``li/a``
    (``@title``, ``span/@style``).  A title span without text is skipped.
    """
    # Fixed values below: class names and element paths of the spec sheet.
    found: list[list[dict]] = []          # the rows of each inner box, in document order
    # one walk; a node knows whether it is in scope and which inner boxes hold it
    stack: list[tuple[Node, bool, tuple]] = [(root, False, ())]
    while stack:
        n, scoped, boxes = stack.pop()
        if n.tag == "div":
            if scoped and inner_class in n.classes:
                found.append([])
                boxes = (*boxes, found[-1])
            scoped = scoped or scope_class in n.classes
        elif boxes and n.tag == "span" and n.attrs.get("class") == "title" and n.parent.tag == "td":
            texts = n.texts()
            if texts:
                row = {"label": texts[0], **_cell(n.parent.next_sibling("td"))}
                for rows in boxes:
                    rows.append(row)
        if n.kids:
            stack.extend([(k, scoped, boxes) for k in reversed(n.kids)])
    return [row for rows in found for row in rows]


def _cell(cell: Node | None) -> dict:
    """``info``, ``alt`` and ``colours`` of a value cell."""
    info, alt, colours = [], [], []
    if cell is not None:
        info = [t for s in cell.elements()
                if s.tag == "span" and s.attrs.get("class") == "info"
                for t in s.texts()]
        for d in cell.descendants():
            if d.tag != "div":
                continue
            cls = d.attrs.get("class")
            if cls == "l":
                alt += d.texts()
            elif cls == "focus-color-warp":
                for li in d.descendants():
                    if li.tag != "li":
                        continue
                    for a in li.elements():
                        if a.tag != "a" or "title" not in a.attrs:
                            continue
                        styles = [s.attrs["style"] for s in a.elements()
                                  if s.tag == "span" and "style" in s.attrs]
                        if styles:
                            colours.append({"title": a.attrs["title"], "style": styles[0]})
    return {"info": info, "alt": alt, "colours": colours}


@dataclass(frozen=True)
class Step:
    """One step of an element path: tag, exact class, 1-based position among
    same-tag siblings.  The first step matches at any depth; later steps
    are children of the previous one."""
    tag: str
    cls: str | None = None
    nth: int | None = None


def reached(root: Node, path: list[Step]) -> Iterator[Node]:
    """The elements that ``path`` reaches, in document order: one walk, in which bit k of a
    node's mask says that the first k + 1 steps end in it."""
    last = 1 << (len(path) - 1)
    stack: list[tuple[Node, int]] = [(root, 0)]
    while stack:
        node, mask = stack.pop()
        if mask & last:
            yield node
        if not node.kids:
            continue
        count: dict[str, int] = {}
        marked = []
        for kid in node.kids:
            nth = count[kid.tag] = count.get(kid.tag, 0) + 1
            own = 0
            for k, step in enumerate(path):
                if (kid.tag == step.tag and (k == 0 or mask >> (k - 1) & 1)
                        and (step.nth is None or step.nth == nth)
                        and (step.cls is None or kid.attrs.get("class") == step.cls)):
                    own |= 1 << k
            marked.append((kid, own))
        stack.extend(reversed(marked))


def path_texts(root: Node, path: list[Step]) -> list[str]:
    """Direct text nodes of the elements reached by ``path``, in document order."""
    return [t for n in reached(root, path) for t in n.texts()]


def first_path_text(root: Node, path: list[Step]) -> list[dict]:
    """The first text node reached by ``path`` (no row when there is none); the walk
    ends there."""
    return next(([{"text": t}] for n in reached(root, path) for t in n.texts()), [])


def link_rows(root: Node, container: str = "nav") -> list[dict]:
    """``container li a`` -> (label = first direct text, href)."""
    out = []
    for box in (n for n in root.descendants() if n.tag == container):
        for li in (n for n in box.descendants() if n.tag == "li"):
            for a in li.elements():
                if a.tag == "a":
                    t = a.texts()
                    out.append({"label": t[0] if t else "", "href": a.attrs.get("href")})
    return out


# ------------------------------------------------------- J1 on many pages at a time

#: Open elements inside each other, up to which pages are read together.
DEEPEST = 48


@lru_cache(maxsize=4096)
def _read_tag(tag: str) -> tuple[str, int, dict] | None:
    """(name, step in depth, attributes) of a plain start or end tag; None for any other."""
    m = _PLAIN.fullmatch(tag)
    if m is None or (m["end"] is None and m["start"] is None):
        return None
    if m["end"] is not None:
        return m["end"], -1, {}
    attrs = {k: v.replace("&amp;", "&") for k, v in _ATTR.findall(m[3])}
    return m["start"], 0 if m["empty"] or m["start"] in VOID else 1, attrs


def _grouped(group: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """The values, sorted by group, as one list for each of the ``n`` groups."""
    ends = np.searchsorted(group, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each key comes first."""
    return np.unique(keys, return_index=True)[1]


def spec_sheet_table(bodies: pa.Array, scope_class: str = "config-section",
                     inner_class: str = "special-layout-18") -> tuple[np.ndarray, dict]:
    """``spec_sheet_rows`` for many pages in one pass over their tags, as arrays.

    Returns which pages were read, and their rows: ``page`` (index), ``pos``, ``label``, ``info``,
    ``alt``, ``colours``.  Read are pages of plain tags alone, each closed by its own end tag and
    none by implication, without boxes in boxes; for any other page ``spec_sheet_rows`` holds."""
    bodies = bodies.cast(pa.large_string())
    n_pages = len(bodies)
    bounds = np.frombuffer(bodies.buffers()[1], np.int64)[bodies.offset:bodies.offset + n_pages + 1]
    data = bodies.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    known = np.ones(n_pages, bool)
    lt = np.flatnonzero(raw[bounds[0]:] == ord("<")) + bounds[0]
    gt = np.flatnonzero(raw[bounds[0]:] == ord(">")) + bounds[0]
    n = len(lt)
    empty = {"page": np.zeros(0, np.int64)}
    if not n:
        return known, empty
    page = np.searchsorted(bounds[1:], lt, side="right")
    after = np.append(lt[1:], bounds[-1])               # where the text after the tag ends, or its page
    end = np.append(gt, bounds[-1])[np.searchsorted(gt, lt)] + 1
    cut = (end > after) | (end > bounds[page + 1])
    known[page[cut]] = False
    # tag, text, tag, text, ...; a page's last text runs into the next page, but no element owns it
    offsets = np.append(np.column_stack([lt, np.minimum(end, after)]).ravel(), bounds[-1])
    pieces = pa.LargeStringArray.from_buffers(2 * n, pa.py_buffer(offsets.astype(np.int64)), data)
    tags = pieces.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
    kind = tags.indices.to_numpy()
    read = [_read_tag(t) for t in tags.dictionary.to_pylist()]
    names = sorted({r[0] for r in read if r} | {"", "div", "span", "td", "li", "a"})
    number = {name: i for i, name in enumerate(names)}
    known[page[np.array([r is None for r in read])[kind]]] = False
    name = np.array([number[r[0]] if r else 0 for r in read])[kind]
    step = np.array([r[1] if r else 0 for r in read])[kind]

    # the depth after each tag, and the level of the element that it opens or ends
    depth = np.cumsum(step)
    first = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
    base = np.zeros(n_pages, np.int64)
    base[page[first]] = depth[first] - step[first]
    depth = depth - base[page]
    last = np.append(first[1:], n) - 1
    known[page[last][depth[last] != 0]] = False
    known[page[(depth < 0) | (depth > DEEPEST)]] = False
    level = np.where(step > 0, depth, depth + 1)

    # from here on, the tags of the pages read
    keep = known[page]
    at = np.flatnonzero(keep)
    page, name, step, depth, level, kind = (x[keep] for x in (page, name, step, depth, level, kind))
    n = len(at)
    if not n:
        return known, empty
    paired = np.flatnonzero(step != 0)
    paired = paired[np.argsort(page[paired] * (DEEPEST + 2) + level[paired], kind="stable")]
    opens, ends = paired[::2], paired[1::2]             # in turns, as the depth never falls below 0
    known[page[opens[name[opens] != name[ends]]]] = False
    # the element that is open at each level; right where the level is no deeper than the tag
    idx = np.arange(n)
    open_at = np.stack([np.full(n, -1)] + [np.maximum.accumulate(np.where((step > 0) & (level == x), idx, -1))
                                           for x in range(1, level.max() + 1)])
    parent = open_at[level - 1, idx]                    # -1: none
    closes = np.array([[x in CLOSES.get(t, ()) for x in names] for t in names])
    stop = np.array([t in SCOPE_STOP for t in names])
    some = np.flatnonzero((step >= 0) & closes.any(axis=1)[name])
    up = level[some] - 1
    while len(some := some[up > 0]):
        up = up[up > 0]
        over = name[open_at[up, some]]
        implied = closes[name[some], over]
        known[page[some[implied]]] = False
        on = ~implied & ~stop[over]
        some, up = some[on], up[on] - 1

    def where(tag: str, test=lambda attrs: True) -> np.ndarray:
        return np.array([r is not None and r[1] >= 0 and r[0] == tag and test(r[2]) for r in read])[kind]

    def inside(of: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``of``, marked element around it), outermost first."""
        pairs = [(np.flatnonzero(hit), around[hit]) for x in range(1, len(open_at))
                 for around in [open_at[x, of]] for hit in [(x < level[of]) & mark[around]]]
        return (np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])) if pairs else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64))

    # boxes, label cells and their labels
    scopes = where("div", lambda a: scope_class in a.get("class", ""))
    inner = np.flatnonzero(where("div", lambda a: inner_class in a.get("class", "")))
    box = np.zeros(n, bool)
    box[inner[inside(inner, scopes)[0]]] = True
    known[page[np.flatnonzero(box)[inside(np.flatnonzero(box), box)[0]]]] = False
    td = name == number["td"]
    title = np.flatnonzero(where("span", lambda a: a.get("class") == "title") & (parent >= 0) & td[parent])
    title = title[np.unique(inside(title, box)[0])]
    owner = np.where(depth > 0, open_at[np.minimum(depth, len(open_at) - 1), idx], -1)
    text_at = 2 * at + 1
    owner[offsets[text_at + 1] == offsets[text_at]] = -1        # no text
    is_title = np.zeros(n, bool)
    is_title[title] = True
    labels = np.flatnonzero((owner >= 0) & is_title[owner])
    labels = labels[_firsts(owner[labels])]
    of_row = owner[labels]                                      # ascending

    # the cell with the values: the next td in the same row
    cells = np.flatnonzero(td & (step >= 0))
    cells = cells[np.argsort(np.where(parent[cells] < 0, -1 - page[cells], parent[cells]), kind="stable")]
    follows = np.full(n, -1)
    same = (parent[cells[1:]] == parent[cells[:-1]]) & (page[cells[1:]] == page[cells[:-1]])
    follows[cells[:-1][same]] = cells[1:][same]
    cell = follows[parent[of_row]]
    used = np.unique(cell[cell >= 0])
    is_cell = np.zeros(n, bool)
    is_cell[used] = True

    # its texts and colours
    texts = np.flatnonzero(owner >= 0)
    info = texts[where("span", lambda a: a.get("class") == "info")[owner[texts]]]
    info = info[(parent[owner[info]] >= 0) & is_cell[parent[owner[info]]]]
    info = info[np.lexsort((info, owner[info], parent[owner[info]]))]
    alt = texts[where("div", lambda a: a.get("class") == "l")[owner[texts]]]
    some, alt_cell = inside(owner[alt], is_cell)
    alt = alt[some]
    order = np.lexsort((alt, owner[alt], alt_cell))
    alt, alt_cell = alt[order], alt_cell[order]
    warp = where("div", lambda a: a.get("class") == "focus-color-warp")
    known[page[np.flatnonzero(warp)[inside(np.flatnonzero(warp), warp)[0]]]] = False
    is_link = where("a", lambda a: "title" in a) & (parent >= 0) & (name[parent] == number["li"])
    styled = np.flatnonzero(where("span", lambda a: "style" in a) & (parent >= 0) & is_link[parent])
    styled = styled[_firsts(parent[styled])]
    some, warps = inside(parent[parent[styled]], warp)
    styled = styled[some]
    some, colour_cell = inside(warps, is_cell)
    styled, warps = styled[some], warps[some]
    link = parent[styled]
    order = np.lexsort((link, parent[link], warps, colour_cell))
    styled, link, colour_cell = styled[order], link[order], colour_cell[order]

    def words(of: np.ndarray) -> pa.Array:
        out = pieces.take(pa.array(text_at[of])).cast(pa.string())
        if pc.any(pc.match_substring(out, "&")).as_py():
            out = pa.array([unescape(t) for t in out.to_pylist()], pa.string())
        return out

    colours = pa.StructArray.from_arrays(
        [pa.array([read[k][2]["title"] for k in kind[link]], pa.string()),
         pa.array([read[k][2]["style"] for k in kind[styled]], pa.string())], names=["title", "style"])
    right = known[page[of_row]]
    labels, of_row, cell = labels[right], of_row[right], cell[right]
    # one list more, empty, for a label cell that none follows
    place = pa.array(np.where(cell >= 0, np.searchsorted(used, cell), len(used)))

    def listed(group: np.ndarray, values: pa.Array) -> pa.Array:
        return _grouped(np.searchsorted(used, group), values, len(used) + 1).take(place)

    row_page = page[of_row]
    begins = np.searchsorted(row_page, row_page)
    return known, {"page": row_page, "pos": pa.array(np.arange(len(row_page)) - begins, pa.int32()), "label": words(labels),
                   "info": listed(parent[owner[info]], words(info)), "alt": listed(alt_cell, words(alt)),
                   "colours": listed(colour_cell, colours)}


# ------------------------------------------------------------------ Spark jobs

#: Pages whose rows are held at a time, and the bytes of their bodies (one page may have more).
TOGETHER = 256
TOGETHER_BYTES = 1 << 21


def _slices(b: pa.RecordBatch, body: str) -> Iterator[pa.RecordBatch]:
    upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(body)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        most = (upto[at - 1] if at else 0) + TOGETHER_BYTES
        n = min(TOGETHER, max(1, int(np.searchsorted(upto, most, side="right")) - at))
        yield b.slice(at, n)
        at += n


def _run_rule(df: DataFrame, keys: list[str], body: str, rule: Callable[[Node], list[dict]],
              out_schema: str, columns: list[str], prefilter=None, scope: str | None = None, table=None) -> DataFrame:
    """Run ``rule`` over each body; ``keys`` columns are carried to every row, as Arrow.
    ``scope`` names the class of the divs outside of which the rule looks at nothing.
    ``table`` is the rule for many pages at a time; those that it does not read go to ``rule``.
    ``prefilter`` (a Column) drops, JVM-side, bodies the rule cannot match, so
    they never reach Python."""
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_schema}, pos int, {out_schema}"

    out = to_arrow_schema(StructType.fromDDL(schema))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for b in batches for part in _slices(b, body)):
            if table is not None:
                b = b.filter(b.column(body).is_valid())
                read, rows = table(b.column(body))
                if len(rows["page"]):
                    at = pa.array(rows["page"])
                    made = [b.column(k).take(at).cast(out.field(k).type) for k in keys] + \
                        [rows[c].cast(out.field(c).type) for c in ("pos", *columns)]
                    yield pa.RecordBatch.from_arrays(made, names=[*keys, "pos", *columns])
                if read.all():
                    continue
                b = b.filter(pa.array(~read))
            of: list[int] = []                  # the page of every row
            pos: list[int] = []
            found: dict[str, list] = {c: [] for c in columns}
            for i, html in enumerate(b.column(body)):
                html = html.as_py()
                if html is None:
                    continue
                rows = rule(parse_html(html, scope))
                of += [i] * len(rows)
                pos += range(len(rows))
                for c in columns:
                    found[c] += [r[c] for r in rows]
            at = pa.array(of, pa.int64())
            made = [b.column(k).take(at).cast(out.field(k).type) for k in keys] + [pa.array(pos, pa.int32())] + \
                [pa.array(found[c], out.field(c).type) for c in columns]
            yield pa.RecordBatch.from_arrays(made, names=[*keys, "pos", *columns])

    src = df.select(*keys, body)
    if prefilter is not None:
        src = src.filter(prefilter)
    return src.mapInArrow(per_batch, schema)


def _has_tag(body: str, tag: str):
    return F.col(body).rlike(f"(?i)<{tag}[\\s/>]")


def _path_prefilter(body: str, path: list[Step]):
    first = path[0]
    test = _has_tag(body, first.tag)
    if first.cls:
        test = test & (F.instr(F.col(body), first.cls) > 0)
    return test


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def spec_rows(pages: DataFrame, key: str | list[str] = "page_id", body: str = "body",
              **opts) -> DataFrame:
    """J1 as a Spark job: (keys..., pos, label, info, alt, colours)."""
    schema = ("label string, info array<string>, alt array<string>, "
              "colours array<struct<title: string, style: string>>")
    scope = opts.get("scope_class", "config-section")
    inner = opts.get("inner_class", "special-layout-18")
    pre = (F.instr(F.col(body), scope) > 0) & (F.instr(F.col(body), inner) > 0)
    return _run_rule(pages, _keys(key), body, lambda r: spec_sheet_rows(r, **opts), schema,
                     ["label", "info", "alt", "colours"], prefilter=pre, scope=scope,
                     table=lambda bodies: spec_sheet_table(bodies, scope, inner))


def headline_text(pages: DataFrame, path: list[Step], key: str | list[str] = "page_id",
                  body: str = "body", out: str = "headline") -> DataFrame:
    """J2 as a Spark job: (keys..., headline) for pages where the path has text."""
    keys = _keys(key)
    rows = _run_rule(pages, keys, body, lambda r: first_path_text(r, path), "text string",
                     ["text"], prefilter=_path_prefilter(body, path))
    return rows.select(*keys, rows["text"].alias(out))


def link_table(pages: DataFrame, key: str | list[str] = "page_id", body: str = "body",
               container: str = "nav") -> DataFrame:
    """Link rows of a container as a Spark job: (keys..., pos, label, href)."""
    return _run_rule(pages, _keys(key), body, lambda r: link_rows(r, container),
                     "label string, href string", ["label", "href"],
                     prefilter=_has_tag(body, container))


# Fixed value: where the car page states its level (second dl of the price box).
CAR_LEVEL_PATH = [Step("div", cls="car-price"), Step("dl", nth=2), Step("dd")]
