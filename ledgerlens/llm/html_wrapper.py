"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes a tree of block elements; in it, neighbouring siblings of the
same shape are one repeated node, so a page of a hundred paragraphs and one of
three have the same tree.  Pages of a host with the same text count once.
Pages of a host and a shape are summed up by slot (the places where text
stands): how many, and the least and greatest hashes of the slot's text, of its
first text and of its last (they differ where nodes are repeated), an aggregate
that combines on the map side.  Then the shapes
of a host are aligned by simple tree matching, the largest ordered matching of
equal labels, and merged into its wrapper, in rounds as a tree: groups of a few
wrappers become one each until a host has one left.  In a large wrapper, a node
in which all slots vary already is folded into its label.  A slot with the same text on all
different pages of its host, two at least, is template; one that not all pages
have must be the same on several.  A slot whose text varies is content, without
its first or last text where only that is template.

A page's text is that of its varying slots, in page order.  Elements whose tag
or role says what they are (menus, headers, footers, asides, dialogs) are no
content even where they vary.  Forms, and elements with one of a few names as a
whole class or id (adverts, comments), are none where they hold at most half of
the page's varying text.  If a page has an article or main element, text outside
it is none either; and if all its article and main elements stand in elements
that would be left out, those around them are not.

Trees are at most ``DEPTH`` elements deep; what a page nests deeper stands in its
order at that depth, all its text included, and keeps the marks of the elements
around it.

Defined cases: null html gives an empty text; a page whose host shows nothing
that varies (one page, or copies of one) keeps its constant slots; a null or
odd url belongs to the empty host; repeated rows are extracted one by one; a
null page_id stays null; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import drop_scratch, scratch
from ledgerlens.llm.tasks import group_task, map_task
from ledgerlens.llm.url_alias import host_of as url_host

#: Elements inside each other that a tree holds at most.
DEPTH = 100
#: Fewer pages with a slot that other pages of the host lack say nothing about whether it is constant.
MIN_PAGES = 8
#: A host's wrappers are dealt to groups of about so many, and each group merged into one.
GROUP_SIZE = 32
#: Nodes that vary as a whole are folded in wrappers of more slots.
FOLD_SLOTS = 1000
PAGES = "host string, shape_key binary, page binary, shape string, slots array<struct<whole: long, first: long, last: long>>"
WRAPPERS = "host string, part long, pages long, wrapper string"

# Element and class names of HTML documents.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
BLOCKS = set(
    "html body head div section article main aside nav header footer form fieldset p h1 h2 h3 h4 h5 h6 ul ol li "
    "dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary "
    "dialog menu button select option hr center".split()
)
CLOSES_P = BLOCKS - {"button", "select", "option", "html", "body", "head"}
NO_CONTENT = set(
    "head script style textarea title noscript template iframe xmp nav header footer aside button select "
    "dialog menu object svg canvas audio video map".split()
)
NO_CONTENT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu".split())
NO_CONTENT_CLASSES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice disclaimer popup modal overlay newsletter subscribe signup login sidebar sidebars menu menus "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar share sharing social "
    "related recommended comment comments reply replies disqus widget widgets".split()
)
KEPT_WHOLE = {"html", "body", "article", "main"}
#: What an element says of itself: nothing, that it may be no content, that it is none, or that nobody sees it.
NO_MARK, HINT, LEFT_OUT, HIDDEN = range(4)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<!--|<[!?/]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class Node:
    """A block element.

    ``above`` is the element around it.  Beyond ``DEPTH`` elements it may stand in
    the tree beside that one instead of inside it.
    """

    __slots__ = ("tag", "label", "children", "mark", "skip", "main", "above", "holder", "place")

    def __init__(self, tag: str, label: str, mark: int, above: Node | None):
        self.tag, self.label, self.mark, self.above = tag, label, mark, above
        self.main = tag in ("article", "main") or above is not None and above.main
        self.skip, self.place = False, 0  # whether left out; the place in the list of nodes
        self.holder = self  # the node whose children take what stands inside
        self.children: list = []  # nodes, and strings of text


def _mark(tag: str, attributes: dict[str, str]) -> int:
    if "hidden" in attributes:
        return HIDDEN
    role = attributes.get("role", "").lower()
    if tag in NO_CONTENT or role in NO_CONTENT_ROLES:
        return LEFT_OUT
    if tag in KEPT_WHOLE:
        return NO_MARK
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    return HINT if tag == "form" or role == "form" or not NO_CONTENT_CLASSES.isdisjoint(names) else NO_MARK


def settle(root: Node) -> list[Node]:
    """All nodes, parents first, with marks handed down; see the module's text for those around article and main."""
    nodes = [root]
    for place, node in enumerate(nodes):
        node.place = place
        nodes.extend(child for child in node.children if isinstance(child, Node))

    def hand_down() -> None:
        for node in nodes[1:]:
            node.skip = node.above.skip or node.mark >= LEFT_OUT

    hand_down()
    hinted = [False] * len(nodes)
    for node in nodes[1:]:
        hinted[node.place] = node.mark == HINT or hinted[node.above.place]
    mains = [node for node in nodes if node.tag in ("article", "main")]
    if mains and all(node.skip or hinted[node.place] for node in mains):
        cleared = set()
        for node in mains:
            while node is not root and node.above.place not in cleared:
                node = node.above
                cleared.add(node.place)
                node.mark = node.mark if node.mark == HIDDEN else NO_MARK
        hand_down()
    return nodes


def parse(page: str) -> list[Node]:
    """The tree of a page's block elements; inline elements give their text to the block.

    An inline element that is no content is a node of its own.  Open elements
    are closed where HTML implies it, and at the page's end.  The tree is at most
    ``DEPTH`` elements deep: deeper ones stand one after another at that depth,
    a text after an inner element as one more node of its own element.
    Returns all nodes, the root first.
    """
    root = Node("", "", NO_MARK, None)
    stack, opened = [root], Counter()
    at, end = 0, len(page)
    last = page.rfind(">")

    def text(piece: str) -> None:
        if not piece:
            return
        node = stack[-1]
        if node.holder is not node:  # deeper than the tree: its own nodes hold text only
            siblings = node.holder.children
            if siblings[-1] is not node:
                more = Node(node.tag, node.label, NO_MARK, node)
                siblings.append(more)
                more.holder = node.holder
                stack[-1], more.above = more, node
                node = more
        node.children.append(entities.unescape(piece))

    def close(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    while at < end:
        found = _TAG.search(page, at) if at <= last else None
        if not found:
            text(page[at:].split("<!--", 1)[0])  # an open comment has no text
            break
        text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            if found[0] == "<!--":
                stop = page.find("-->", at)
                at = end if stop < 0 else stop + 3
            else:
                stop = page.find(">", at)
                at = end if stop < 0 else stop + 1
            continue
        tag = found[2].lower()
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag not in BLOCKS and stack[depth].tag in BLOCKS:
                    break  # an inline end tag closes no block
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        attributes = {
            k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(found[3])
        } if found[3] else {}
        if re.search(r"(?:^|\s)hidden(?:\s|/|$)", found[3] or ""):
            attributes["hidden"] = ""
        mark = _mark(tag, attributes)
        if tag in VOID and tag != "hr" or not (tag in BLOCKS or mark):
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in BLOCKS:
                    break
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            ends = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
            closes = ends.get(tag, {tag})
            for depth in range(len(stack) - 1, 0, -1) if any(opened[c] for c in closes) else ():
                if stack[depth].tag in ("ul", "ol", "dl", "table", "select"):
                    break
                if stack[depth].tag in closes:
                    close(depth)
                    break
        names = " ".join(sorted(set(attributes.get("class", "").split())))
        node = Node(tag, f"{tag}.{names}" if names else tag, mark, stack[-1])
        holder = stack[-1].holder
        holder.children.append(node)
        if len(stack) > DEPTH:
            node.holder = holder
        if tag != "hr" and not (found[3] or "").endswith("/") or tag in BLOCKS - {"hr"}:
            stack.append(node)
            opened[tag] += 1
    return settle(root)


def blocks_of(node: Node) -> list:
    """A node's children: its texts (white space made one space, empty ones left out) and nodes."""
    out, run = [], []
    for child in [*node.children, None]:
        if isinstance(child, str):
            run.append(child)
            continue
        if run:
            joined = " ".join("".join(run).split())
            if joined:
                out.append(joined)
            run = []
        if child is not None:
            out.append(child)
    return out


def place_slots(nodes: list[Node]) -> tuple[str, list[list[int]], list[tuple[str, Node]]]:
    """(shape as JSON, places of each slot's texts, the texts in page order with their nodes)."""
    texts: list[tuple[str, Node]] = []

    def walk(n: Node):
        children, slots, before = [], [], None
        for child in blocks_of(n):
            if isinstance(child, str):
                texts.append((child, n))
                shape, own = None, [[len(texts) - 1]]
            else:
                shape, own = walk(child)
            if children and before == shape:
                for slot, more in zip(slots[len(slots) - len(own) :], own):
                    slot.extend(more)
            else:
                children.append(shape)
                slots.extend(own)
            before = shape
        return [n.label, children], slots

    shape, slots = walk(nodes[0])
    return json.dumps(shape, separators=(",", ":")), slots, texts


# --- wrappers -----------------------------------------------------------------
# A wrapper is [label, children]; a slot is {"n": pages, "lo": hashes, "hi": hashes}, the
# hashes those of the slot's whole text, of its first and of its last text.
# [label, FOLDED] stands for a node of that label whatever is in it, and all of it varies.
FOLDED = "*"


def _label(tree):
    return None if isinstance(tree, dict) or tree is None else tree[0]


class Matching:
    """Simple tree matching of two trees' nodes, each pair of different subtrees once.

    Equal subtrees get one number, so a page's many alike nodes are compared as
    one.  Equal first or last children are matched without a table: no other
    matching of theirs is larger.  A table's row is one running maximum.
    """

    def __init__(self):
        self.numbers: dict = {}  # of subtrees, by label and children's numbers
        self.known: dict[int, tuple] = {}  # a tree's number by identity (and the tree, to keep that)
        self.nodes: list[tuple] = []  # label and children's numbers, by number
        self.sizes: dict[tuple[int, int], int] = {}

    def number(self, tree) -> int:
        held = self.known.get(id(tree))
        if held is not None:
            return held[0]
        label = _label(tree)
        if label is None:
            key = (None, ())
        elif tree[1] == FOLDED:
            key = (label, None)
        else:
            key = (label, tuple(map(self.number, tree[1])))
        found = self.numbers.setdefault(key, len(self.nodes))
        if found == len(self.nodes):
            self.nodes.append(key)
        self.known[id(tree)] = (found, tree)
        return found

    def size(self, a: int, b: int) -> int:
        """Nodes in the largest ordered matching of two subtrees with both roots in it; 0 if they differ."""
        (label, xs), (other, ys) = self.nodes[a], self.nodes[b]
        if label != other:
            return 0
        if label is None or xs is None or ys is None:
            return 1
        found = self.sizes.get((a, b))
        if found is None:
            head, tail = self._alike(xs, ys)
            xs_, ys_ = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
            found = 1 + sum(self.size(x, x) for x in (*xs[:head], *xs[len(xs) - tail :]))
            if xs_ and ys_:
                found += int(self.table(xs_, ys_)[-1][-1])
            self.sizes[a, b] = found
        return found

    @staticmethod
    def _alike(xs, ys) -> tuple[int, int]:
        """Equal children at the beginning, and then at the end."""
        most, head, tail = min(len(xs), len(ys)), 0, 0
        while head < most and xs[head] == ys[head]:
            head += 1
        while tail < most - head and xs[-1 - tail] == ys[-1 - tail]:
            tail += 1
        return head, tail

    def table(self, xs, ys) -> np.ndarray:
        """Largest matching of the first i and the first j of two lists of subtrees."""
        different = sorted(set(ys))
        column = np.searchsorted(different, ys)
        rows = {x: np.array([self.size(x, y) for y in different], np.int64)[column] for x in set(xs)}
        table = np.zeros((len(xs) + 1, len(ys) + 1), np.int64)
        for i, x in enumerate(xs):
            np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + rows[x]), out=table[i + 1, 1:])
        return table


def match(a, b, memo: Matching | None = None) -> int:
    """Simple tree matching: nodes in the largest ordered matching of two trees."""
    memo = memo or Matching()
    return memo.size(memo.number(a), memo.number(b))


def pairs(xs: list, ys: list, memo: Matching) -> list[tuple]:
    """Children in order: matched pairs, and (x, None) or (None, y) for the others."""
    left, right = [memo.number(x) for x in xs], [memo.number(y) for y in ys]
    head, tail = memo._alike(left, right)
    inner_x, inner_y = left[head : len(left) - tail], right[head : len(right) - tail]
    table = memo.table(inner_x, inner_y)
    i, j, out = len(inner_x), len(inner_y), []
    while i or j:
        together = memo.size(inner_x[i - 1], inner_y[j - 1]) if i and j else 0
        if together and table[i, j] == table[i - 1, j - 1] + together:
            i, j = i - 1, j - 1
            out.append((head + i, head + j))
        elif i and table[i, j] == table[i - 1, j]:
            i -= 1
            out.append((head + i, None))
        else:
            j -= 1
            out.append((None, head + j))
    ends = [(len(left) - k, len(right) - k) for k in range(tail, 0, -1)]
    return [(k, k) for k in range(head)] + out[::-1] + ends


def merge(a, b, memo: Matching | None = None):
    """One wrapper of two with the same root label."""
    memo = memo or Matching()
    if isinstance(a, dict):
        return {"n": a["n"] + b["n"], "lo": list(map(min, a["lo"], b["lo"])), "hi": list(map(max, a["hi"], b["hi"]))}
    if a[1] == FOLDED or b[1] == FOLDED:
        return [a[0], FOLDED]
    children = [
        b[1][j] if i is None else a[1][i] if j is None else merge(a[1][i], b[1][j], memo)
        for i, j in pairs(a[1], b[1], memo)
    ]
    return [a[0], children]


def fill(shape, slots: Iterator):
    """A shape with what ``slots`` gives in the place of each slot."""
    if shape is None:
        return next(slots)
    return [shape[0], [fill(child, slots) for child in shape[1]]]


def slots_in(wrapper) -> list[dict]:
    if isinstance(wrapper, dict):
        return [wrapper]
    if wrapper[1] == FOLDED:
        return []
    return [slot for child in wrapper[1] for slot in slots_in(child)]


def varies(wrapper) -> bool:
    """Whether any slot is known to vary."""
    if isinstance(wrapper, dict):
        return wrapper["lo"][0] != wrapper["hi"][0]
    return wrapper[1] == FOLDED or any(map(varies, wrapper[1]))


def constant(slot: dict) -> tuple[bool, ...]:
    """Whether a slot's whole text, first and last text are the same on all its pages."""
    return tuple(a == b for a, b in zip(slot["lo"], slot["hi"]))


def fold(wrapper):
    """The wrapper with each node in which all slots vary, first and last texts too, as its label alone."""
    if isinstance(wrapper, dict) or wrapper[1] == FOLDED:
        return wrapper
    children = [fold(child) for child in wrapper[1]]
    known = [child for child in children if isinstance(child, dict) or child[1]]  # the others have no text
    whole = bool(known) and all(not any(constant(c)) if isinstance(c, dict) else c[1] == FOLDED for c in known)
    return [wrapper[0], FOLDED if whole else children]


def template_slots(shape, wrapper, pages: int) -> list[tuple[bool, ...]]:
    """For each slot of a shape, whether the wrapper of a host's ``pages`` shows it to be template.

    Its whole text, its first and its last.
    """
    memo = Matching()

    def walk(a, w) -> list[tuple[bool, ...]]:
        if a is None:
            enough = bool(w) and (w["n"] >= MIN_PAGES or w["n"] == pages > 1)
            return [constant(w) if enough else (False,) * 3]
        if w is None or w[1] == FOLDED:
            return [x for child in a[1] for x in walk(child, None)]
        return [
            x
            for i, j in pairs(a[1], w[1], memo)
            if i is not None
            for x in walk(a[1][i], None if j is None else w[1][j])
        ]

    return walk(shape, wrapper)


# --- tasks --------------------------------------------------------------------


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].encode().lower().decode()  # A-Z only


def page_batches(batches) -> Iterator[pa.RecordBatch]:
    """Each page's host, hashes of its shape and text, and slots; a batch has each shape once."""
    from xxhash import xxh3_64_intdigest, xxh3_128_digest

    def code(texts: list[str]) -> int:
        return xxh3_64_intdigest("\n".join(texts).encode()) - (1 << 63)

    names = ["host", "shape_key", "page", "shape", "slots"]
    slot = pa.struct([(name, pa.int64()) for name in ("whole", "first", "last")])
    kinds = (pa.string(), pa.binary(), pa.binary(), pa.string(), pa.list_(slot))
    for batch in batches:
        seen, rows = set(), []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            shape, slots, texts = place_slots(parse(page or ""))
            texts = [text for text, _ in texts]
            host, key = host_of(url), xxh3_128_digest(shape.encode())
            hashes = [
                {"whole": code([texts[i] for i in s]), "first": code([texts[s[0]]]), "last": code([texts[s[-1]]])}
                for s in slots
            ]
            known = (host, key) in seen
            seen.add((host, key))
            rows.append((host, key, xxh3_128_digest("\n".join(texts).encode()), None if known else shape, hashes))
        columns = zip(*rows) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def fill_batches(batches) -> Iterator[pa.RecordBatch]:
    """The wrapper of each single shape."""
    for batch in batches:
        wrappers, pages = [], []
        for shape, slots in zip(batch.column("shape").to_pylist(), batch.column("slots").to_pylist()):
            pages.append(slots[0]["n"])
            ordered = iter([{k: s[k] for k in ("n", "lo", "hi")} for s in sorted(slots, key=lambda s: s["slot"])])
            wrappers.append(_bounded(fill(json.loads(shape), ordered)))
        columns = [batch.column("host"), batch.column("part"), pa.array(pages, pa.int64()), pa.array(wrappers, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "part", "pages", "wrapper"])


def align_wrappers(key, table: pa.Table) -> pa.Table:
    """The wrappers of a host (and group) merged into one, in a fixed order."""
    rows = sorted(table.column("wrapper").to_pylist())
    wrapper = json.loads(rows[0])
    for other in rows[1:]:
        wrapper = merge(wrapper, json.loads(other))
        if len(slots_in(wrapper)) > FOLD_SLOTS:
            wrapper = fold(wrapper)
    columns = {"host": pa.string(), "part": pa.int64(), "pages": pa.int64(), "wrapper": pa.string()}
    values = [key[0].as_py(), key[1].as_py(), pc.sum(table.column("pages")).as_py(), _bounded(wrapper)]
    return pa.table({name: pa.array([v], kind) for (name, kind), v in zip(columns.items(), values)})


def _bounded(wrapper) -> str:
    """A wrapper as JSON, a large one folded."""
    if len(slots_in(wrapper)) > FOLD_SLOTS:
        wrapper = fold(wrapper)
    return json.dumps(wrapper, separators=(",", ":"))


@lru_cache(maxsize=2048)
def _template(shape: str, wrapper: str, pages: int) -> tuple[tuple[bool, ...], ...]:
    tree = json.loads(wrapper)
    found = template_slots(json.loads(shape), tree, pages)
    return tuple(found) if varies(tree) else ((False,) * 3,) * len(found)


def extract(page: str | None, wrapper: str | None, pages: int = 0) -> str:
    """The main text of one page under its host's wrapper, which stands for ``pages`` different pages."""
    nodes = parse(page or "")
    shape, slots, texts = place_slots(nodes)
    gone: set[int] = set()
    if wrapper:
        for slot, (whole, first, last) in zip(slots, _template(shape, wrapper, pages)):
            gone.update(slot if whole else slot[:1] * first + slot[-1:] * last)
    inside = [0] * len(nodes)  # varying characters in each node
    for i, (text, node) in enumerate(texts):
        if not node.skip and i not in gone:
            inside[node.place] += len(text)
    for node in reversed(nodes[1:]):
        inside[node.above.place] += inside[node.place]
    out = [False] * len(nodes)  # in a node that hints at no content and is small
    for node in nodes[1:]:
        out[node.place] = out[node.above.place] or node.mark == HINT and 0 < 2 * inside[node.place] <= inside[0]
    kept = [(text, node) for i, (text, node) in enumerate(texts) if not node.skip and i not in gone and not out[node.place]]
    has_main = any(node.main and not node.skip and not out[node.place] for _, node in texts)
    return "\n".join(text for text, node in kept if node.main or not has_main)


def extract_batches(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("html", "wrapper", "pages")]
        texts = [extract(page, wrapper, pages or 0) for page, wrapper, pages in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


# --- operator -----------------------------------------------------------------


def induce(pages: DataFrame) -> DataFrame:
    """``host, pages, wrapper`` (JSON) of every host with a text; ``pages`` of different text."""
    rows = scratch(pages.select("url", "html").mapInArrow(map_task(page_batches), PAGES), "wrapper_pages")
    shapes = rows.groupBy("host", "shape_key").agg(F.max("shape").alias("shape"))
    different = rows.groupBy("host", "page").agg(F.min(F.struct("shape_key", "slots")).alias("page_slots"))
    values = [F.col(f"s.{name}") for name in ("whole", "first", "last")]
    slots = (
        different.select("host", "page_slots.shape_key", F.posexplode("page_slots.slots").alias("slot", "s"))
        .groupBy("host", "shape_key", "slot")
        .agg(F.count(F.lit(1)).alias("n"), *map(F.min, values), *map(F.max, values))
        .toDF("host", "shape_key", "slot", "n", "lo0", "lo1", "lo2", "hi0", "hi1", "hi2")
        .select("host", "shape_key", "slot", "n", F.array("lo0", "lo1", "lo2").alias("lo"), F.array("hi0", "hi1", "hi2").alias("hi"))
        .groupBy("host", "shape_key")
        .agg(F.collect_list(F.struct("slot", "n", "lo", "hi")).alias("slots"))
    )
    filled = slots.join(shapes, ["host", "shape_key"]).select("host", F.xxhash64("shape_key").alias("part"), "shape", "slots")
    wrappers = align(filled.mapInArrow(map_task(fill_batches), WRAPPERS)).select("host", "pages", "wrapper")
    drop_scratch(rows)
    return wrappers


def align(wrappers: DataFrame) -> DataFrame:
    """One wrapper of each host's; every round merges groups of about ``GROUP_SIZE``."""
    step = 0
    while True:
        wrappers = scratch(wrappers, "wrappers")
        counts = wrappers.groupBy("host").agg(F.count(F.lit(1)).alias("count"))
        if counts.where("count > 1").isEmpty():
            return wrappers
        groups = F.when(F.col("count") > GROUP_SIZE, F.ceil(F.col("count") / (GROUP_SIZE / 2))).otherwise(1)
        step += 1
        wrappers = (
            wrappers.join(counts, "host")
            .select("host", F.pmod(F.xxhash64("part", F.lit(step)), groups).alias("part"), "pages", "wrapper")
            .groupBy("host", "part")
            .applyInArrow(group_task(align_wrappers), WRAPPERS)
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The wrappers lie in the shared folder: Spark knows their size, and sends them
    to all tasks or joins by host accordingly.
    """
    wrappers = induce(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", url_host(F.col("url")).alias("host"))
    met = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper", "pages")
    return met.mapInArrow(map_task(extract_batches), "page_id long, url string, text string, n_chars long")
