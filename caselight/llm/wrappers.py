"""Main text of web pages by wrapper induction: DOM trees of one host are aligned, what stays constant is template.

Each page is parsed to a tree of its block elements. Its shape (labels without texts, repeats of a sibling folded into one)
is compared with the most frequent shape of its host by simple tree matching, which maps nodes to slots of the host. A
text that stands in the same slot on most of the host's different pages belongs to the template; what varies is content.
Pages with the same longest block count once, so copies of an article do not turn its paragraphs into template. Among the
varying texts those in navigation, adverts, forms and the like (by element, role or class name) go, and the region of the
article is its element if there is one, else the deepest element that holds most of the text.

What moves: shapes and 64-bit hashes of texts for the statistics. The wrapper of a host joins its pages by broadcast
below a measured size, else by a join on the host in which the most frequent hosts, at most 1000, are salted.

Results for odd input: a null or empty page gives an empty text and 0 characters; a null address is a host of its own;
rows that repeat a page give their result each; an empty table gives no rows; long pages are whole, nesting beyond
``MAX_DEPTH`` levels is flattened; other columns are not read. Ties between shapes go to the larger digest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from caselight.llm.common import BROADCAST_BYTES, BROADCAST_ROWS, stored

MAX_DEPTH = 200
#: A text is template from this many different pages of a slot on, if these are half of the slot's pages.
LEAST_PAGES = 5
#: A host is hot, and its pages are salted, beyond one in so many pages; so there are fewer hot hosts than that.
HOT_SHARE, SALTS = 1000, 64

# HTML element names by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split())
UNSEEN = frozenset(
    "script style noscript template head title svg math iframe object canvas audio video select button textarea noframes datalist"
    .split())
RAW = frozenset("iframe noframes noscript script style textarea title".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOW = HEADINGS | frozenset("address blockquote caption dd dt figcaption legend li p pre summary td th".split())
REPEATED = FLOW | frozenset("dl figure ol table tbody thead tr ul".split())
LISTS = frozenset("dir menu ol ul".split())
TABLE = frozenset("table tbody td tfoot th thead tr".split())
#: What a starting element ends if it is open, up to the nearest element of the second kind.
CLOSES = {
    "li": (frozenset(["li"]), LISTS), "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])), "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])), "tr": (frozenset(["td", "th", "tr"]), frozenset(["table"])),
}
ASIDE_TAGS = frozenset("aside dialog footer form menu nav".split())
ASIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class names and ids around the article. Names of the first list are also used for frames around everything.
FRAME_WORDS = frozenset("banner footer header masthead menu nav navbar navigation sidebar toolbar topbar widget widgets".split())
ASIDE_WORDS = FRAME_WORDS | frozenset(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer disqus gdpr login modal newsletter notice notices notification overlay pager pagination popup promo promotion recommended "
    "related replies reply respond search share sharing signup skip social sponsor sponsored subscribe subscription"
    .split())

_TAG = r"(/?)([a-zA-Z][^\s/>]*+)"
_OTHER = r"!--(?:-?>|[\s\S]*?(?:--!?>|\Z))|[!?/][^>]*+>|(?=[a-zA-Z/!?]))"
_TOKEN = re.compile(rf"""<(?:{_TAG}((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|{_OTHER}""")
_PLAIN_TOKEN = re.compile(rf"<(?:{_TAG}([^>]*+)>|{_OTHER}")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_ABOUT = re.compile(r"(?i)(?:has|no|with)[-_]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SHUT = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("tag", "label", "aside", "framed", "region", "parent", "kids", "chars", "index", "shape", "groups")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.label, self.parent, self.kids, self.chars = tag, tag, parent, [], 0
        self.aside, self.framed, self.region = tag in ASIDE_TAGS, False, 2 if tag == "article" else int(tag == "main")
        if "=" in attrs or "hidden" in attrs:
            self.describe({name.lower(): unescape(a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attrs)})

    def describe(self, attrs: dict[str, str]) -> None:
        """What class, id, role and style tell about the element."""
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
        plain = sorted({re.sub(r"[^A-Za-z]+", "-", name).strip("-").lower() for name in names})
        self.label = " ".join([self.tag, *filter(None, plain)])
        role, style = attrs.get("role", "").lower(), attrs.get("style", "").lower()
        if attrs.get("itemprop", "").lower() == "articlebody":
            self.region = 2
        elif role == "main":
            self.region = max(self.region, 1)
        self.aside |= role in ASIDE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_SHUT.search(style))
        words = {word.lower() for name in names if not _ABOUT.match(name) for word in _WORD.findall(name)}
        hits = words & ASIDE_WORDS if self.tag not in ("body", "main") else set()
        if hits and not self.aside:
            self.aside, self.framed = True, hits <= FRAME_WORDS  # a frame's name is judged when all that it holds is known


class Page:
    """A tree of the block elements of a page and its texts in order: (node, tag, text, characters in links).

    Follows the rules of HTML for what browsers repair: left out end tags, stray ones, raw text, pages cut short. After a
    tag whose quotes never close, tags end at the first ``>``.
    """

    def __init__(self, html: str):
        self.root = Node("body", "", None)
        self.open: list[Node] = [self.root]
        self.unseen: list[str] = []
        self.blocks: list[tuple[Node, str, str, int]] = []
        self.run: list[str] = []
        self.links = self.linked = 0
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        at, token = 0, _TOKEN
        while True:
            found = token.search(html, at)
            if found is None:
                self.text(html[at:])
                return
            start = found.start()
            if start > at:
                self.text(html[at:start])
            shut, tag, attrs = found.groups()
            at = found.end()
            if tag:
                tag = tag.lower()
                if shut:
                    self.end(tag)
                    continue
                self.start(tag, attrs)
                if tag in RAW:
                    close = _RAW_END[tag].search(html, at)
                    if close is None:
                        return
                    at = close.start()
            elif at - start == 1:  # no end of this tag
                if token is _PLAIN_TOKEN:
                    return
                token, at = _PLAIN_TOKEN, start

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                node = self.open[-1]
                self.blocks.append((node, node.tag, text, min(self.linked, len(text))))
            self.run, self.linked = [], 0

    def text(self, data: str) -> None:
        if not self.unseen:
            if "&" in data:
                data = unescape(data)
            self.run.append(data)
            if self.links:
                self.linked += len(data.strip())

    def start(self, tag: str, attrs: str) -> None:
        if self.unseen:
            if self.unseen[-1] == "head" and tag not in IN_HEAD:
                self.unseen.pop()
            else:
                if tag in UNSEEN:
                    self.unseen.append(tag)
                return
        if tag in UNSEEN:
            self.unseen.append(tag)
        elif tag == "br":
            self.run.append(" ")
        elif tag == "a":
            self.links += 1
        elif tag in BLOCKS:
            self.flush()
            self.links = 0
            if tag in ("html", "body", "hr"):
                return
            self.end_before(tag)
            if len(self.open) < MAX_DEPTH:
                node = Node(tag, attrs, self.open[-1])
                self.open[-1].kids.append(node)
                self.open.append(node)

    def end_before(self, tag: str) -> None:
        """Elements whose end may be left out end where ``tag`` starts."""
        last = self.open[-1].tag
        if last == "p" or last in HEADINGS and tag in HEADINGS:
            self.open.pop()
        closed, walls = CLOSES.get(tag, (frozenset(), frozenset()))
        for at in range(len(self.open) - 1, 0, -1) if closed else ():
            if self.open[at].tag in closed:
                outermost = at
                while tag == "tr" and self.open[outermost - 1].tag in closed:
                    outermost -= 1
                del self.open[outermost:]
                return
            if self.open[at].tag in walls:
                return

    def end(self, tag: str) -> None:
        if self.unseen:
            if tag in self.unseen:
                del self.unseen[self.unseen.index(tag):]
            return
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCKS and tag not in ("html", "body"):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    self.flush()
                    del self.open[at:]
                    return
                if self.open[at].tag in ("td", "th", "table") and tag not in TABLE:
                    break
            if tag == "p":
                self.flush()  # a stray end is an empty paragraph


def _order(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.kids))
    return out


def _settle(page: Page) -> None:
    """Decide which elements stand beside the article, and take plain text elements out of the tree."""
    nodes = _order(page.root)
    for node, _, text, _ in page.blocks:
        node.chars += len(text)
    holds: dict[int, int] = {}
    for node in reversed(nodes):
        holds[id(node)] = max([node.region, *[holds[id(kid)] for kid in node.kids if not kid.aside or kid.framed]], default=0)
        node.chars += sum(kid.chars for kid in node.kids)
    whole = page.root.chars
    inside = {id(page.root): False}
    for node in nodes[1:]:
        inner = inside[id(node)] = inside[id(node.parent)] or node.region > 0
        if node.framed and (holds[id(node)] or 10 * node.chars > 6 * whole or inner and "header" in node.label):
            node.aside = False
        if node.tag == "header" and not inner:
            node.aside = True
    for node in reversed(nodes[1:]):
        if node.aside:
            node.kids = []
        elif node.tag in FLOW and node.label == node.tag and not node.kids:
            node.parent.kids.remove(node)


def shape_of(page: Page) -> tuple[list, list]:
    """The folded tree as rows (label, parent, region, is a list) and the texts beside it: (row, tag, text, link characters)."""
    _settle(page)
    nodes = _order(page.root)
    for node in reversed(nodes):
        groups: list[tuple[str, list[Node]]] = []
        for kid in node.kids:
            if groups and groups[-1][0] == kid.shape:
                groups[-1][1].append(kid)
            else:
                groups.append((kid.shape, [kid]))
        node.groups = []
        for shape, members in groups:
            if len(members) > 2 or members[0].tag in REPEATED:
                node.groups.append(members)
            else:
                node.groups.extend([member] for member in members)
        node.shape = f"{node.label}({','.join(members[0].shape for members in node.groups)})"
        if len(node.shape) > 64:
            node.shape = blake2b(node.shape.encode(), digest_size=16).hexdigest()
    rows: list[tuple[str, int, int, int]] = []
    todo = [([page.root], -1)]
    while todo:
        members, parent = todo.pop()
        if members[0].aside:
            continue
        for member in members:
            member.index = len(rows)
        rows.append((members[0].label, parent, members[0].region, int(members[0].tag in LISTS)))
        merged = [[kid for member in members for kid in member.groups[k]] for k in range(len(members[0].groups))]
        todo.extend((group, members[0].index) for group in reversed(merged))
    texts = []
    for node, tag, text, links in page.blocks:
        owner, hidden = node, False
        at = node
        while at is not None:
            hidden = hidden or at.aside
            at = at.parent
        if not hidden:
            while owner.parent is not None and owner not in owner.parent.kids and owner.tag in FLOW:
                owner = owner.parent
            texts.append((owner.index, tag, text, links))
    return rows, texts


def text_mark(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def match_trees(one: list, other: list) -> dict[int, int]:
    """Simple tree matching of two shapes: which row of the second each row of the first is mapped to.

    Roots match if their labels do; the children of a matched pair are matched in order, so that most rows are mapped.
    """
    kids = []
    for rows in (one, other):
        below: list[list[int]] = [[] for _ in rows]
        for i, row in enumerate(rows):
            if row[1] >= 0:
                below[row[1]].append(i)
        kids.append(below)
    known: dict[tuple[int, int], tuple[int, list]] = {}

    def score(a: int, b: int) -> int:
        if one[a][0] != other[b][0]:
            return 0
        if (a, b) not in known:
            left, right = kids[0][a], kids[1][b]
            best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
            for i, x in enumerate(left):
                for j, y in enumerate(right):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + score(x, y))
            known[a, b] = best[-1][-1] + 1, best
        return known[a, b][0]

    mapped: dict[int, int] = {}
    todo = [(0, 0)] if score(0, 0) else []
    while todo:
        a, b = todo.pop()
        mapped[a] = b
        left, right, best = kids[0][a], kids[1][b], known[a, b][1]
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((left[i], right[j]))
    return mapped


def slots(rows: list, seed: list) -> list[str]:
    """A name for each row: the row of the seed that it matches, else its path of labels."""
    mapped = match_trees(rows, seed)
    names: list[str] = []
    for i, row in enumerate(rows):
        names.append(str(mapped[i]) if i in mapped else f"{names[row[1]] if row[1] >= 0 else ''}/{row[0]}")
    return names


def main_text(rows: list, texts: list, template: set[tuple[int, int]]) -> str:
    """The varying texts of the region of the article, one per line."""
    live = [t for t in texts if (t[0], text_mark(t[2])) not in template]
    mass, links, held = [0] * len(rows), [0] * len(rows), [0] * len(rows)
    for at, _, text, linked in live:
        mass[at] += len(text)
        links[at] += linked
        held[at] += 1
    own = mass[:]
    for at in range(len(rows) - 1, 0, -1):
        for sums in (mass, links, held):
            sums[rows[at][1]] += sums[at]
    menus = {at for at, row in enumerate(rows) if row[3] and held[at] > 1 and 10 * links[at] > 8 * mass[at]}

    def within(at: int, top: int) -> bool:
        while at >= top:
            if at == top:
                return True
            at = rows[at][1]
        return False

    regions = [at for at, row in enumerate(rows) if row[2] == 2 and mass[at]] or \
        [at for at, row in enumerate(rows) if row[2] == 1 and mass[at]]
    if regions:
        top = max(regions, key=lambda at: (mass[at], -at))
    else:
        top, weight = 0, [m - min(m, 2 * k) for m, k in zip(mass, links)]
        while True:
            below = [at for at, row in enumerate(rows) if row[1] == top]
            heavy = max(below, key=lambda at: (weight[at], -at), default=None)
            if heavy is None or 10 * weight[heavy] < 6 * weight[top] or own[top] * 4 > mass[top]:
                break
            top = heavy
    inside = {at for at in range(top, len(rows)) if within(at, top)}
    in_menu = {at for at in inside if any(within(at, menu) for menu in menus)}
    kept = [t for t in live if t[0] in inside and t[0] not in in_menu]
    lines = [t[2] for t in kept]
    if top and not any(t[1] == "h1" for t in kept):
        above = [t[2] for t in live if t[1] == "h1" and t[0] not in inside and within(top, t[0])]
        lines = above[:1] + lines
    return "\n".join(lines)


_SEEN = "host string, shape_id string, shape string, node int, mark bigint, page bigint"


def _shape_key(rows: list) -> tuple[str, str]:
    shape = json.dumps(rows)
    return shape, blake2b(shape.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Apply ``make`` to each input row (a dict) and pack what it yields, ``most`` rows at a time."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema.names)

    out: list[tuple] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            for row in batch.slice(start, 100).to_pylist():
                out.extend(make(row))
                if len(out) >= most:
                    yield packed(out)
                    out = []
    if out:
        yield packed(out)


def _observe(batches):
    """One row for the page's shape, one for each different text of it; ``page`` stands for its longest text."""
    schema = pa.schema([("host", pa.string()), ("shape_id", pa.string()), ("shape", pa.string()), ("node", pa.int32()),
                        ("mark", pa.int64()), ("page", pa.int64())])

    def make(row: dict):
        rows, texts = shape_of(Page(row["html"]))
        shape, key = _shape_key(rows)
        page = text_mark(max((t[2] for t in texts), key=lambda text: (len(text), text), default=""))
        yield row["host"], key, shape, -1, 0, page
        for node, mark in {(t[0], text_mark(t[2])) for t in texts}:
            yield row["host"], key, None, node, mark, page

    return _rows(batches, make, schema, 5000)


def _extract(id_type: pa.DataType):
    """Arrow function: the main text of pages that stand beside the wrapper of their host."""
    schema = pa.schema([("page_id", id_type), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        known: dict[tuple[str, str], list[str]] = {}  # the slots of the shapes met last

        def make(row: dict):
            rows, texts = shape_of(Page(row["html"]))
            template = set()
            if row["constant"] and texts:
                shape, key = _shape_key(rows)
                names = known.get((row["host"], key))
                if names is None:
                    if len(known) >= 1000:
                        known.clear()
                    names = known[row["host"], key] = slots(json.loads(shape), json.loads(row["seed"]))
                constant = {(c["slot"], c["mark"]) for c in row["constant"]}
                marks = {(t[0], text_mark(t[2])) for t in texts}
                template = {(node, mark) for node, mark in marks if (names[node], mark) in constant}
            text = main_text(rows, texts, template).encode("utf-8", "replace").decode()
            yield row["page_id"], row["url"], text, len(text)

        return _rows(batches, make, schema, 500)

    return run


def _align(batches):
    schema = pa.schema([("host", pa.string()), ("shape_id", pa.string()), ("node", pa.int32()), ("slot", pa.string())])

    def make(row: dict):
        names = slots(json.loads(row["shape"]), json.loads(row["seed"]))
        for node, slot in enumerate(names):
            yield row["host"], row["shape_id"], node, slot

    return _rows(batches, make, schema, 5000)


def host_of(url: Column) -> Column:
    """The host between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?:(?!://)[\s\S])*+://([^/?#]*+)", 1), F.lit("")), upper, lower)


def induce(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (host, html): the wrappers (host, seed, constant) of hosts with a template, and (host, pages) of all hosts.

    ``seed`` is the shape that slots refer to, ``constant`` lists the slot and the hash of each text of the template.
    """
    seen = pages.select("host", "html").mapInArrow(_observe, _SEEN)
    # First every page's text by itself, then the counts: a text that all pages of a host share is merged before it moves.
    different = seen.groupBy("host", "shape_id", "shape", "node", "mark", "page").agg(F.count(F.lit(1)).alias("rows"))
    counts = stored(different.groupBy("host", "shape_id", "shape", "node", "mark").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("rows")), "wrappers")
    shapes = counts.where("node < 0").select("host", "shape_id", "shape", "pages", "rows")
    seeds = shapes.groupBy("host").agg(F.max(F.struct("pages", "shape_id", "shape")).alias("best"),
                                       F.sum("pages").alias("of_host")).where(F.col("of_host") >= LEAST_PAGES)
    seeds = stored(seeds.select("host", F.col("best.shape").alias("seed")), "seeds")
    placed = stored(shapes.join(seeds, "host").select("host", "shape_id", "shape", "seed").mapInArrow(
        _align, "host string, shape_id string, node int, slot string"), "slots")
    of_slot = placed.join(shapes.select("host", "shape_id", "pages"), ["host", "shape_id"]).groupBy("host", "slot").agg(
        F.sum("pages").alias("of_slot"))
    # A text may stand on one page of each of many shapes. Only what is too rare on the whole host is left out beforehand.
    places = counts.where("node >= 0").select("host", "shape_id", "node", "mark", "pages")
    often = places.groupBy("host", "mark").agg(F.sum("pages").alias("of_mark")).where(F.col("of_mark") >= LEAST_PAGES)
    texts = places.join(often, ["host", "mark"], "left_semi").join(
        placed, ["host", "shape_id", "node"]).groupBy("host", "slot", "mark").agg(F.sum("pages").alias("pages"))
    constant = texts.where(F.col("pages") >= LEAST_PAGES).join(of_slot, ["host", "slot"]).where(
        2 * F.col("pages") >= F.col("of_slot"))
    # At most two texts for each text of an average page: a list that stays as short as pages are.
    wrappers = constant.groupBy("host").agg(F.collect_list(F.struct("slot", "mark")).alias("constant")).join(seeds, "host")
    return wrappers, shapes.groupBy("host").agg(F.sum("rows").alias("pages"))


def extract(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page, its blocks in page order, one per line."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = pages.schema[id_col].dataType
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    wrappers, hosts = induce(rows)
    wrappers = stored(wrappers, "templates")
    many, size = wrappers.agg(F.count("*"), F.sum(32 * F.size("constant") + F.length("seed"))).first()
    if many <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        found = rows.join(F.broadcast(wrappers), "host", "left")
    else:
        everything = hosts.agg(F.sum("pages")).first()[0]
        hot = F.broadcast(hosts.where(F.col("pages") * HOT_SHARE > everything).select("host", F.lit(SALTS).alias("salts")))
        spread = rows.join(hot, "host", "left").withColumn(
            "salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("salts", F.lit(1))))
        copies = wrappers.join(hot, "host", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)).cast("bigint") - 1)))
        found = spread.join(copies.drop("salts"), ["host", "salt"], "left")
    return found.select("page_id", "url", "host", "html", "seed", "constant").mapInArrow(
        _extract(to_arrow_type(kind)), f"page_id {kind.simpleString()}, url string, text string, n_chars bigint")
