"""HTML extraction by wrapper induction: the trees of a host's pages aligned by simple tree matching.

A page becomes a tree of its block elements; inline elements only add text to their block. Its outline keeps the
blocks that hold lines, with repeated siblings folded. The outlines of a host are aligned and merged into one
layout, to which every page is aligned again: over all different pages it is counted how many have a line in a
slot of the layout. Lines that are constant there are template, and what varies is content. Elements that are
named as something else (menus, adverts, comments, ...) are neither.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import packed, written
from sonoloom.llm.urls import host_of

# Element names of HTML, and words that sites use in class, id and role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOT_CONTENT = frozenset(
    "nav header footer aside form script style noscript template iframe svg canvas object button select textarea "
    "menu dialog head title noembed noframes math datalist".split()
)
#: Any class or id with one of these words names an element out, wherever it is, ...
NOT_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored gdpr newsletter navbar breadcrumb breadcrumbs comment "
    "comments disqus pagination".split()
)
#: ... and one of these outside articles if it has no other words, or only such as say where and in what form.
NOT_CONTENT_NAMES = frozenset(
    "sponsor promo promotion banner cookie cookies consent popup modal overlay subscribe subscription sidebar menu nav "
    "navigation footer header masthead respond replies social share sharing related recommended widget pager skip "
    "toolbar login signup notice notices".split()
)
#: Articles of these classes announce others.
_TEASERS = frozenset("teaser teasers".split())
_PLACES = frozenset(
    "left right top bottom upper lower primary secondary main site global mobile desktop wrapper container area box "
    "block section bar list links link buttons inner outer to".split()
)
#: A name with one of these says how the page is laid out, not what the element is.
_MODIFIERS = frozenset("no not non with without has hide hidden free".split())
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu".split())
#: Named out by their nature, whatever they hold; and unless they hold the only article of the page.
_INERT = frozenset("script style noscript template iframe svg canvas object head title noembed noframes math datalist".split())
_ASIDE = frozenset("nav footer aside menu dialog button select textarea".split())
_ENDS = {
    "li": ("li", {"ul", "ol", "menu", "dir"}),
    "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
    "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
    "tr": ("tr td th", {"table"}), "option": ("option", {"select"}),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)|<[!?][^>]*>|[^<]+|<", re.DOTALL)
_MARK = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORDS = re.compile(r"[a-z0-9]+")
_NUMBER = re.compile(r"[0-9]+")

#: A host with fewer different pages shows no template.
LEAST_PAGES = 4
#: Of the pages with a slot, those that must have a line there for it to be template.
CONSTANT = 0.9
#: Of all different pages of the host, those that must: headings of some tables are no layout of the host.
LAYOUT = 0.25
#: Slots of a layout; of more, those that the fewest pages have are left out. No line is template without a slot.
LAYOUT_SLOTS = 2000
#: Blocks below this depth count as children of the one there.
_DEPTH = 64
#: Repeats of up to so many siblings are folded, if so much of their slots can be paired.
_PERIODS = (1, 2, 3)
_ALIKE = 0.8
#: Sibling lists whose lengths have a larger product, after folding, are paired from left to right.
_PAIRED = 40_000


class Node:
    """A block element, or an inline one that is named out: its runs of text and child elements in order."""

    __slots__ = ("inline", "items", "label", "named_out", "tag")

    def __init__(self, tag: str, label: str, named_out: bool, inline: bool = False):
        self.tag, self.label, self.named_out, self.inline, self.items = tag, label, named_out, inline, []

    def blocks(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


def _attributes(tail: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tail)} if "=" in tail else {}


def _is_name_out(name: str, in_article: bool) -> bool:
    """Whether a class or id says that its element is no content."""
    words = set(_WORDS.findall(name))
    if not words.isdisjoint(_MODIFIERS):
        return False
    if not words.isdisjoint(NOT_CONTENT_WORDS):
        return True
    return not in_article and not words.isdisjoint(NOT_CONTENT_NAMES) and words <= NOT_CONTENT_NAMES | _PLACES


def _named_out(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in NOT_CONTENT and not (tag == "header" and in_article):
        return True
    if tag == "article" and not _TEASERS.isdisjoint(_WORDS.findall(attributes.get("class", "").lower())):
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.get("class", ""):
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    return any(_is_name_out(x, in_article) for x in names) or attributes.get("role", "").lower() in NOT_CONTENT_ROLES


def _in_order(root: Node) -> list[tuple[Node, bool]]:
    """Every block with whether it is in an article that is not named out, parents first; as deep as it may be."""
    out, at = [(root, False)], 0
    while at < len(out):
        node, inside = out[at]
        inside = inside or node.tag == "article" and not node.named_out
        out += [(x, inside) for x in node.blocks()]
        at += 1
    return out


def _let_in(root: Node, kept_out: frozenset[str]) -> bool:
    """Lets elements in, in place, that are named out but hold an article or main; true if there is one in `root`.

    Articles within an article are comments or teasers, and let nothing in.
    """
    holds: set[int] = set()
    for node, in_article in reversed(_in_order(root)):
        within = any(id(x) in holds for x in node.blocks())
        if node.named_out and within and not in_article and node.tag not in kept_out:
            node.named_out = False
        if not node.named_out and (within or _is_article(node)):
            holds.add(id(node))
    return id(root) in holds


def _tag_end(text: str, at: int) -> int:
    """Where the > of the tag is whose name ends at `at`, behind all quoted values; -1 if the text ends in it."""
    while m := _MARK.search(text, at):
        if m[0] == ">":
            return m.start()
        at = text.find(m[0], m.end()) + 1
        if not at:
            return -1
    return -1


def parse(text: str) -> Node:
    """The block tree of a page. Open ends, missing and stray tags are taken as browsers take them."""
    root = Node("", "", False)
    # (tag, element that its text goes to, whether it is in an article)
    stack: list[tuple[str, Node, bool]] = [("", root, False)]
    open_tags: Counter[str] = Counter()
    position, end = 0, len(text)
    while position < end:
        m = _TOKEN.match(text, position)
        position = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if not piece.startswith(("<!", "<?")):
                stack[-1][1].items.append(entities.unescape(piece) if "&" in piece else piece)
            continue
        tag, close = tag.lower(), _tag_end(text, position)
        if close < 0:  # the page ends within a tag
            break
        tail, position = text[position:close], close + 1
        if m[1]:
            _close(stack, open_tags, tag)
            continue
        attributes = _attributes(tail)
        if tag in BLOCKS:
            if tag not in ("option", "optgroup"):
                _close(stack, open_tags, "p")
            if tag in _ENDS:
                _end_open(stack, open_tags, *_ENDS[tag])
        out = _named_out(tag, attributes, stack[-1][2])
        if tag in BLOCKS or out:
            mark = tag if tag in ("html", "body", "p") else f"{tag}.{attributes.get('class', '')}"
            node = Node(tag, mark, out, tag not in BLOCKS)
            stack[-1][1].items.append(node)
        else:
            node = stack[-1][1]
            if tag == "br":
                node.items.append(" ")
        if tag in RAW and not tail.endswith("/"):
            close = re.compile(rf"</{tag}\s*/?>", re.IGNORECASE).search(text, position)
            position = close.end() if close else end
        elif tag not in VOID and not (tail.endswith("/") and tag in ("path", "use", "circle", "rect")):
            stack.append((tag, node, stack[-1][2] or tag in ("article", "main")))
            open_tags[tag] += 1
    if not _let_in(root, _INERT | _ASIDE):
        _let_in(root, _INERT)
    return root


def _close(stack: list, open_tags: Counter, tag: str) -> None:
    if not open_tags[tag]:
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == tag:
            _cut(stack, open_tags, i)
            return
        if stack[i][0] in ("table", "article", "body") and tag not in BLOCKS:
            return


def _end_open(stack: list, open_tags: Counter, ended: str, within: set[str]) -> None:
    names = ended.split()
    if not any(open_tags[x] for x in names):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in within:
            return
        if stack[i][0] in names:
            _cut(stack, open_tags, i)
            return


def _cut(stack: list, open_tags: Counter, at: int) -> None:
    open_tags.subtract(tag for tag, *_ in stack[at:])
    del stack[at:]


def _runs(node: Node) -> list[str | Node]:
    """Child blocks and, between them, the text as one line each; blank text is left out."""
    out, parts = [], []
    for x in [*node.items, None]:
        if isinstance(x, str):
            parts.append(x)
            continue
        if x is not None and x.inline and x.named_out:
            continue
        if line := " ".join("".join(parts).split()):
            out.append(line)
        parts = []
        if x is not None:
            out.append(x)
    return out


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main")


def _has_article(root: Node) -> bool:
    todo = [root]
    while todo:
        node = todo.pop()
        if not node.named_out:
            if _is_article(node):
                return True
            todo += node.blocks()
    return False


class Slot:
    """A block of an outline, or a line in it (`#`): its slots in order, and in how many pages it is."""

    __slots__ = ("kids", "label", "merged", "n", "number")

    def __init__(self, label: str, n: int = 1):
        self.label, self.n, self.kids, self.merged, self.number = label, n, [], None, -1

    def numbered(self) -> list[Slot]:
        """All slots, parents first and in page order; sets their numbers to their places."""
        out, todo = [], [self]
        while todo:
            slot = todo.pop()
            slot.number = len(out)
            out.append(slot)
            todo += reversed(slot.kids)
        return out

    def weighed(self, n: int) -> Slot:
        for slot in self.numbered():
            slot.n = n
        return self


def _score(a: Slot, b: Slot, known: dict) -> int:
    """Simple tree matching: the most slots that can be paired, in order, and only below paired slots."""
    if a.label != b.label:
        return 0
    if not a.kids or not b.kids:
        return 1
    pair = (id(a), id(b))
    if pair not in known:
        known[pair] = 1 + _aligned(a.kids, b.kids, known)[0]
    return known[pair]


def _aligned(left: list[Slot], right: list[Slot], known: dict) -> tuple[int, list[tuple[int, int]]]:
    """The best score of two sibling lists, and the pairs that reach it."""
    labels = [x.label for x in left]
    if labels == [y.label for y in right] and len(set(labels)) == len(labels):
        pairs = [(i, i) for i in range(len(left))]
    elif len(left) * len(right) > _PAIRED:
        pairs = _from_left(labels, right)
    else:
        rows = [[0] * (len(right) + 1)]
        for x in left:
            above, row = rows[-1], [0]
            for j, y in enumerate(right):
                row.append(max(above[j + 1], row[j], above[j] + _score(x, y, known)))
            rows.append(row)
        pairs, i, j = [], len(left), len(right)
        while i and j:
            gain = _score(left[i - 1], right[j - 1], known)
            if gain and rows[i][j] == rows[i - 1][j - 1] + gain:
                i, j = i - 1, j - 1
                pairs.append((i, j))
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return rows[-1][-1], pairs[::-1]
    return sum(_score(left[i], right[j], known) for i, j in pairs), pairs


def _from_left(labels: list[str], right: list[Slot]) -> list[tuple[int, int]]:
    places: dict[str, list[int]] = {}
    for i in range(len(labels) - 1, -1, -1):
        places.setdefault(labels[i], []).append(i)
    pairs, last = [], -1
    for j, y in enumerate(right):
        at = places.get(y.label, [])
        while at and at[-1] <= last:
            at.pop()
        if at:
            last = at.pop()
            pairs.append((last, j))
    return pairs


def merge(a: Slot, b: Slot, same_page: bool = False) -> Slot:
    """`a` with the slots of `b`: aligned ones are one slot, the others stand beside them in page order."""
    known: dict = {}
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        y.merged = x
        x.n = max(x.n, y.n) if same_page else x.n + y.n
        kids, i, j = [], 0, 0
        for p, q in _aligned(x.kids, y.kids, known)[1]:
            kids += x.kids[i:p] + y.kids[j:q] + [x.kids[p]]
            todo.append((x.kids[p], y.kids[q]))
            i, j = p + 1, q + 1
        x.kids = kids + x.kids[i:] + y.kids[j:]
    return a


def _alike(a: Slot, b: Slot) -> bool:
    if a.label != b.label:
        return False
    return 2 * _score(a, b, {}) >= _ALIKE * (len(a.numbered()) + len(b.numbered()))


def _fold(slot: Slot) -> None:
    """Leaves out slots without lines and makes repeats among siblings one; as deep as `_DEPTH` only."""
    kids: list[Slot] = []
    for kid in slot.kids:
        _fold(kid)
        if not kid.kids and kid.label != "#":
            continue
        kids.append(kid)
        for k in _PERIODS:
            if len(kids) >= 2 * k and all(_alike(kids[-i - k], kids[-i]) for i in range(1, k + 1)):
                for a, b in zip(kids[-2 * k : -k], kids[-k:]):
                    merge(a, b, same_page=True)
                del kids[-k:]
                break
    slot.kids = kids


def _pruned(root: Slot) -> Slot:
    """The `LAYOUT_SLOTS` slots that most pages have; a slot is never in more pages than its parent."""
    slots = root.numbered()
    if len(slots) > LAYOUT_SLOTS:
        kept = {id(x) for x in sorted(slots, key=lambda x: (-x.n, x.number))[:LAYOUT_SLOTS]}
        for x in slots:
            x.kids = [y for y in x.kids if id(y) in kept]
    return root


def _dumped(slot: Slot) -> list:
    return [slot.label, slot.n, [_dumped(x) for x in slot.kids]]


def _loaded(said: list) -> Slot:
    slot = Slot(said[0], said[1])
    slot.kids = [_loaded(x) for x in said[2]]
    return slot


def _hash(line: str) -> int:
    digest = hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def outline(page: str | None) -> tuple[Slot, list[tuple[int, str]]]:
    """The outline of a page, and its lines that may be main text, each with the number of its slot.

    Those are the lines in articles, or all if no element is named so. Blocks of a class with numbers in it
    have one label whatever the numbers are.
    """
    tree, root = parse(page or ""), Slot("")
    lines: list[tuple[Slot, str]] = []
    todo = [(tree, not _has_article(tree), root, 0)]
    while todo:
        x, inside, slot, depth = todo.pop()
        if isinstance(x, str):
            if inside:
                lines.append((Slot("#"), x))
                slot.kids.append(lines[-1][0])
        elif not x.named_out:
            own = slot
            if 0 < depth < _DEPTH:
                own = Slot(_NUMBER.sub("0", x.label))
                slot.kids.append(own)
            inside = inside or _is_article(x)
            todo += [(y, inside, own, depth + 1) for y in reversed(_runs(x))]
    _fold(root)
    root.numbered()
    return root, [(_kept(slot).number, line) for slot, line in lines]


def _kept(slot: Slot) -> Slot:
    while slot.merged is not None:
        slot = slot.merged
    return slot


def placed(layout: Slot, page: Slot) -> dict[int, int]:
    """Slot of an outline -> slot of the layout that it is aligned with; both are numbered."""
    known, out, todo = {}, {}, [(layout, page)]
    while todo:
        a, b = todo.pop()
        out[b.number] = a.number
        todo += [(a.kids[i], b.kids[j]) for i, j in _aligned(a.kids, b.kids, known)[1]]
    return out


class Wrapper:
    """The layout of a host and the (slot, hash of the line) of its template."""

    def __init__(self, layout: Slot, template: set[tuple[int, int]]):
        layout.numbered()
        self.layout, self.template = layout, template
        self._placed: dict[str, dict[int, int]] = {}

    def slots(self, page: Slot) -> dict[int, int]:
        shape = json.dumps(_dumped(page))
        if shape not in self._placed:
            self._placed[shape] = placed(self.layout, page)
        return self._placed[shape]


def _constant(n, of, pages):
    """Whether a line is template: `n` of the `of` pages with its slot have it, out of the host's different `pages`.

    The figures are numbers or columns. Pages without the slot, as stubs are or pages of another layout, say
    nothing about the line.
    """
    return (n >= LEAST_PAGES - 1) & (n >= LAYOUT * pages) & (n >= CONSTANT * of)


def induce(pages: list[str]) -> Wrapper | None:
    """The wrapper of one host, by the rule of `wrappers`."""
    different = {tuple(sorted(_hash(x) for _, x in lines)): (shape, lines) for shape, lines in map(outline, pages) if lines}
    if len(different) < LEAST_PAGES:
        return None
    layout = Slot("", 0)
    for shape, _ in different.values():
        merge(layout, _loaded(_dumped(shape)))
    wrapper, counts, of = Wrapper(_pruned(layout), set()), Counter(), Counter()
    for shape, lines in different.values():
        at = wrapper.slots(shape)
        here = {(at[i], _hash(x)) for i, x in lines if i in at}
        counts.update(here)
        of.update({slot for slot, _ in here})
    wrapper.template = {x for x, n in counts.items() if _constant(n, of[x[0]], len(different))}
    return wrapper if wrapper.template else None


def extract(page: str | None, wrapper: Wrapper | None = None) -> str:
    """The main text: the varying lines of the article, or of the whole body if no element is named so."""
    shape, lines = outline(page)
    if wrapper is None or not lines:
        return "\n".join(line for _, line in lines)
    at = wrapper.slots(shape)
    return "\n".join(line for i, line in lines if (at.get(i, -1), _hash(line)) not in wrapper.template)


def _outlines(pages: DataFrame) -> DataFrame:
    """(`host`, `shape`, `lines`) of every page with lines, once for all pages of a host with the same lines."""
    kind = "struct<digest:binary,shape:string,lines:array<struct<slot:int,line:bigint>>>"
    entry = pa.list_(pa.struct([("slot", pa.int32()), ("line", pa.int64())]))

    @F.arrow_udf(kind)
    def outlined(html: pa.Array) -> pa.Array:
        digests, shapes, found = [], [], []
        for page in html:
            shape, lines = outline(page.as_py())
            hashed = sorted({(i, _hash(x)) for i, x in lines})
            said = sorted(k for _, k in hashed)
            digests.append(hashlib.blake2b(repr(said).encode(), digest_size=16).digest())
            shapes.append(json.dumps(_dumped(shape), separators=(",", ":")))
            found.append([{"slot": i, "line": k} for i, k in hashed])
        return pa.StructArray.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(shapes, pa.string()), pa.array(found, entry)],
            names=["digest", "shape", "lines"],
        )

    read = pages.where(F.length("html") > 0).select(host_of(F.col("url")).alias("host"), outlined("html").alias("o"))
    one = read.groupBy("host", "o.digest").agg(F.min(F.struct("o.shape", "o.lines")).alias("o"))
    return written(one.where(F.size("o.lines") > 0).select("host", "o.shape", "o.lines"))  # before, it would read pages twice


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One layout for each stretch of rows (host, pages, shape) of one host; holds one layout at a time."""
    host, layout, pages = None, None, 0

    def row() -> pa.RecordBatch:
        said = json.dumps(_dumped(_pruned(layout)), separators=(",", ":"))
        return pa.RecordBatch.from_pydict({"host": [host], "pages": pa.array([pages], pa.int64()), "shape": [said]})

    for batch in batches:
        for h, n, shape in zip(*(batch.column(c).to_pylist() for c in ("host", "pages", "shape"))):
            if layout is not None and h != host:
                yield row()
                layout, pages = None, 0
            found = _loaded(json.loads(shape))
            host, pages = h, pages + n
            layout = found if layout is None else merge(layout, found)
            if len(layout.numbered()) > 2 * LAYOUT_SLOTS:
                _pruned(layout)
    if layout is not None:
        yield row()


def _layouts(outlines: DataFrame) -> DataFrame:
    """(`host`, `pages`, `shape`): the merged outlines of every host with `LEAST_PAGES` different pages.

    Equal outlines are merged as one with their number. The different ones of a host are dealt over all tasks,
    each of which merges its own, in order, before those of one host meet.
    """
    schema = "host string, pages long, shape string"
    weigh = F.arrow_udf(_weighed, "string")
    each = outlines.groupBy("host", "shape").agg(F.count("*").alias("pages"))
    each = each.select("host", "pages", weigh("shape", "pages").alias("shape"))
    parts = each.sortWithinPartitions("host", "shape").mapInArrow(_merged, schema)
    whole = parts.repartition("host").sortWithinPartitions("host", "shape").mapInArrow(_merged, schema)
    return written(whole.where(F.col("pages") >= LEAST_PAGES))


def _weighed(shapes: pa.Array, pages: pa.Array) -> pa.Array:
    each = zip(shapes.to_pylist(), pages.to_pylist())
    return pa.array([json.dumps(_dumped(_loaded(json.loads(s)).weighed(n)), separators=(",", ":")) for s, n in each], pa.string())


def wrappers(pages: DataFrame, broadcast_chars: int = 20_000_000) -> DataFrame:
    """(`host`, `layout`, `template`) of every host with constant lines.

    Every page is read. Pages with the same lines are one page, and a host with fewer than `LEAST_PAGES`
    different ones shows no template, so what is left of the others varies. How much of a page is template does
    not matter. A line is counted within each task before the shuffle. Layouts are broadcast if they have at
    most `broadcast_chars` characters together, else joined.
    """
    outlines = _outlines(pages)
    layouts = _layouts(outlines)
    side = layouts.select(F.col("host").alias("h"), F.col("shape").alias("layout"))
    held = layouts.agg(F.coalesce(F.sum(F.length("shape")), F.lit(0))).first()[0]
    both = outlines.join(F.broadcast(side) if held <= broadcast_chars else side, F.col("host") == F.col("h"))
    entry = pa.list_(pa.struct([("slot", pa.int32()), ("line", pa.int64())]))

    @F.arrow_udf("array<struct<slot:int,line:bigint>>")
    def found(host: pa.Array, layout: pa.Array, shape: pa.Array, lines: pa.Array) -> pa.Array:
        loaded: dict[str, Wrapper] = {}
        shapes: dict[tuple[str, str], dict[int, int]] = {}
        out = []
        for i, (h, s, said) in enumerate(zip(host.to_pylist(), shape.to_pylist(), lines.to_pylist())):
            if (h, s) not in shapes:
                if h not in loaded:
                    loaded[h] = Wrapper(_loaded(json.loads(layout[i].as_py())), set())
                page = _loaded(json.loads(s))
                page.numbered()
                shapes[h, s] = placed(loaded[h].layout, page)
            at = shapes[h, s]
            here = {(at[x["slot"]], x["line"]) for x in said if x["slot"] in at}
            here |= {(slot, None) for slot, _ in here}  # the page has the slot
            out.append([{"slot": a, "line": b} for a, b in here])
        return pa.array(out, entry)

    lines = both.select("host", F.inline(found("host", "layout", "shape", "lines")))
    counts = written(lines.groupBy("host", "slot", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES - 1))
    of = counts.where("line is null").select("host", "slot", F.col("n").alias("of"))
    full = layouts.select("host", F.col("pages").alias("different"), F.col("shape").alias("layout"))
    kept = counts.where("line is not null").join(of, ["host", "slot"]).join(full.select("host", "different"), "host")
    constant = kept.where(_constant(F.col("n"), F.col("of"), F.col("different")))
    template = constant.groupBy("host").agg(F.collect_set(F.struct("slot", "line")).alias("template"))
    return full.select("host", "layout").join(template, "host")


def extracted(pages: DataFrame, broadcast_lines: int = 500_000, broadcast_chars: int = 20_000_000) -> DataFrame:
    """Every row as struct `row` with its main `text`, empty if there is none.

    Named elements that are no content never count, unless they hold the article. Where a page has article or
    main elements, its text is theirs, else that of the body. Lines that are constant in their slot of the
    host's layout, over all its different pages, are left out. Blocks are lines, with one space for white space.
    Null or empty html gives an empty text; rows with a null or odd url share the empty host; repeated rows are
    each extracted; pages of any length and depth are read whole. The wrappers are broadcast if they have at
    most `broadcast_lines` lines and `broadcast_chars` characters of layouts together, else joined.
    """
    table = written(wrappers(pages, broadcast_chars))
    held, chars = table.agg(
        F.coalesce(F.sum(F.size("template")), F.lit(0)), F.coalesce(F.sum(F.length("layout")), F.lit(0))
    ).first()
    side = table.withColumnRenamed("host", "h")
    small = held <= broadcast_lines and chars <= broadcast_chars
    rows = packed(pages)
    joined = rows.join(F.broadcast(side) if small else side, host_of(F.col("row.url")) == F.col("h"), "left")

    @F.arrow_udf("string")
    def text_of(page: pa.Array, host: pa.Array, layout: pa.Array, template: pa.Array) -> pa.Array:
        loaded: dict[str | None, Wrapper | None] = {None: None}
        out = []
        for i, h in enumerate(host.to_pylist()):
            if h not in loaded:
                known = {(x["slot"], x["line"]) for x in template[i].as_py()}
                loaded[h] = Wrapper(_loaded(json.loads(layout[i].as_py())), known)
            out.append(extract(page[i].as_py(), loaded[h]))
        return pa.array(out, pa.string())

    text = text_of(F.col("row.html"), F.col("h"), F.col("layout"), F.col("template"))
    return joined.select("row", text.alias("text"))
