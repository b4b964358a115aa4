"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged by element path (tags and classes
from the root).  For each node of the merged tree, with m pages having it:

* content importance: 1 - the mean over the distinct texts anywhere inside it
  of log_m(pages that have the text); a text on one page counts 1, one on all
  pages 0;
* presentation importance: the entropy, to base m, of the child layouts
  that its pages show.

A node is unimportant when ``MIX`` * content + (1 - MIX) * presentation is
below ``LEAST``, and noise when no box inside it is important either; a noisy
branch is removed from each page.  A node without any text is neither.  A
node that fewer than ``PAGES`` pages of its host have is judged by the merged
tree of all hosts.  Running tags inside an article (paragraphs, headings,
items, cells) share one node for text and boilerplate, so there a single
text is judged: one of at most ``SHORT`` words that ``REPEATED`` percent of
the host's pages with that node show goes.

Elements that say what they are (navigation, forms, asides, scripts, ...) go
by their tag or role.  Class and id names (adverts, comments, ...) are weaker:
a box goes by its name unless it holds the article or main element, or unless
only a part of the name says so and it holds most of the text; if all text
would go, what has the fewest and weakest such boxes around it stays.  Names of a state
(with-sidebar), and names of headings and running text inside the main
element, say nothing; nor do names of tools there (search, related, share)
on a box that holds running text.  If a page has an article or main element, only its text
counts; of several, those with the fewest and weakest such boxes around.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.llm.storage import cut

MIX = 0.9
LEAST = 0.3
PAGES = 10
NOISE_ROWS = 1 << 17     # noisy nodes and texts sent to every task, at most
REPEATED = 80            # percentage of a node's pages
SHORT = 12               # words
RUNNING = 12             # words of a block of running text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template svg iframe object select annotation annotation-xml".split())
GONE = RAW | frozenset("head nav footer aside form button label option dialog menu".split())
MATH = frozenset("math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle mpadded mphantom msub msup msubsup "
                 "munder mover munderover mtable mtr mtd".split())
INLINE = MATH | frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span "
                          "strike strong sub sup time tt u var wbr input acronym nobr".split())
MAIN = frozenset(["article", "main"])
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd tr tbody thead table ul ol dl figure figcaption".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# class and id words of boxes that are not main text
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu sidebar aside footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments "
    "reply replies discussion disqus feedback search widget toolbar copyright skip masthead topbar form".split())
HEADS = frozenset(["header"])
# words that also title a part of a text, and words of names that tell a box's state
SUBJECTS = frozenset("discussion feedback related search social share sharing notice notices form reply replies consent "
                     "copyright navigation advertising promotion gdpr".split())
# names of tools, which say nothing about a box of the main element that holds running text
TOOLS = frozenset("related search social share sharing form copyright navigation widget toolbar".split())
STATES = frozenset("with without has have no not is hide show js open opened closed status enabled disabled".split())
TEXT = (INLINE - {"a", "span"}) | frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd tr figcaption".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hr main menu nav ol p pre section table ul".split())

# an attribute's value is quoted only right after its "="; elsewhere a quote is a character like others
_ATTRIBUTES = r"""(?>[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?=>)|[^\s>"'][^\s>]*+))?+|=)*+"""
_TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<""", re.S | re.X)
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_SPACE = re.compile(r"\s+")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _attributes(raw: str) -> dict:
    return {k.lower(): v[1:-1] if v[:1] in ("'", '"') and v[-1:] == v[:1] else v
            for k, v in _ATTR.findall(raw)} if raw.strip(" /") else {}


_paths: dict = {}


def _path(parent: int, step: str) -> int:
    """Hash of a path, from its parent's and the last step."""
    if (parent, step) not in _paths:
        if len(_paths) >= 1 << 16:
            _paths.clear()
        _paths[parent, step] = _hash(f"{parent}>{step}")
    return _paths[parent, step]


class _Weak:
    """The boxes around that go by their name, as a chain outwards; ``level``
    is higher the more and the clearer names there are."""
    __slots__ = ("up", "number", "level")

    def __init__(self, up, number, level):
        self.up, self.number, self.level = up, number, level

    def numbers(self):
        w = self
        while w.up is not None:
            yield w.number
            w = w.up


_NONE = _Weak(None, -1, 0)


class _Box:
    """A box of a page with the one around it; ``lo`` and ``hi`` are the
    range of its blocks."""
    __slots__ = ("path", "tag", "up", "lo", "hi")

    def __init__(self, path, tag, up):
        self.path, self.tag, self.up, self.lo, self.hi = path, tag, up, None, None


class _Node:
    """An open element.  ``weak``: the boxes around that go by their name,
    from the outermost main element on if there is one; ``before``: those
    around that main element, None if there is none; ``box``: the innermost
    box, itself or around."""
    __slots__ = ("tag", "path", "gone", "weak", "before", "box", "children")

    def __init__(self, tag, path, gone, weak, before, box):
        self.tag, self.path, self.gone, self.weak, self.before, self.box = tag, path, gone, weak, before, box
        self.children: list[str] = []

    @property
    def main(self) -> bool:
        return self.before is not None


def _names(attrs: dict, key: str):
    for name in attrs.get(key, "").lower().split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if words and STATES.isdisjoint(words):
            yield words


def _named(tag: str, attrs: dict, main: bool) -> str:
    """Whether a 'whole' name, or a 'part' of one, says that a box is not
    main text; 'tool' if that is a tool's, in the main element."""
    if tag in MAIN or tag in ("html", "body") or (main and tag in TEXT):
        return ""
    found = ""
    for key in ("class", "id"):
        known = WORDS if main else WORDS | HEADS
        if main and (key == "id" or tag == "section"):
            known = known - SUBJECTS
        for words in _names(attrs, key):
            if not known.isdisjoint(words) and main and TOOLS.issuperset(known.intersection(words)):
                found = found or "tool"
            elif known.issuperset(words):
                return "whole"
            elif not known.isdisjoint(words):
                found = "part"
    return found


def _open(parent: _Node, tag: str, raw: str, whole: list) -> _Node:
    attrs = _attributes(raw)
    name = _named(tag, attrs, parent.main) if attrs else ""
    gone = (parent.gone or tag in GONE or attrs.get("role", "").lower() in ROLES or "hidden" in attrs
            or attrs.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", attrs.get("style", "").lower()) is not None
            or (tag in INLINE and name != "")
            or (tag in MAIN and any(not {"comment", "comments", "reply"}.isdisjoint(w)
                                    for key in ("class", "id") for w in _names(attrs, key)))
            or (tag in HEADS and not parent.main))
    weak, before = parent.weak, parent.before
    if tag in MAIN and not gone and before is None:
        weak, before = _NONE, weak
    elif name and not gone:
        weak = _Weak(weak, len(whole), weak.level + (2 if name == "whole" else 1))      # part of a name says less
        whole.append(name)
    path = _path(parent.path, tag + "".join(f".{c}" for c in sorted(attrs.get("class", "").lower().split())))
    box = parent.box if tag in INLINE or tag in ("html", "body") else _Box(path, tag, parent.box)
    return _Node(tag, path, gone, weak, before, box)


def _by_name(blocks: list, boxes: list, whole: list) -> tuple[list, list]:
    """Without what goes by its class or id; blocks and boxes end in (weak, before)."""
    fewest = min((b[3].level for b in blocks if b[3] is not None), default=None)

    def main(before):
        return before is not None and before.level == fewest
    kept = {w for before in {b[3] for b in blocks if main(b[3])} for w in before.numbers()}     # boxes around the main element
    text = [b for b in blocks if fewest is None or main(b[3])]
    if text:
        held: dict = {}
        for b in text:
            for w in b[2].numbers():
                held[w] = held.get(w, 0) + len(b[0])
                if whole[w] == "tool" and len(b[0].split()) >= RUNNING:
                    kept.add(w)
        most = sum(len(b[0]) for b in text) / 2
        kept.update(w for w, n in held.items() if n > most and whole[w] != "whole")
    seen: dict = {-1: True}

    def stays(weak):
        up, way = weak, []
        while up.number not in seen:
            way.append(up)
            up = up.up
        ok = seen[up.number]
        for w in reversed(way):
            ok = seen[w.number] = ok and w.number in kept
        return ok
    if text and not any(stays(b[2]) for b in text):
        least = min(b[2].level for b in text)
        kept.update(w for b in text if b[2].level == least for w in b[2].numbers())
        seen = {-1: True}

    def both(weak, before):
        return stays(weak) and (before is None or stays(before))
    return ([(b[0], main(b[3]), b[1]) for b in blocks if both(b[2], b[3])],
            [(path, layout) for path, layout, weak, before in boxes if both(weak, before)])


def parse(page: str) -> tuple[list, list]:
    """(blocks, boxes): blocks (text, in main element, innermost box) in page
    order without what goes by its name; boxes (path, layout of children) of
    the remaining elements.  A node costs the same at any depth."""
    root = _Node("", 0, False, _NONE, None, None)
    stack, blocks, boxes, piece, whole = [root], [], [], [], []

    def flush():
        text = _SPACE.sub(" ", entities.unescape("".join(piece)).replace("\x00", "")).strip()
        piece.clear()
        if text:
            blocks.append((text, stack[-1].box, stack[-1].weak, stack[-1].before))

    def close(depth):
        while len(stack) > depth:
            node = stack[-1]
            if node.tag not in INLINE:
                if not node.gone:
                    flush()
                    boxes.append((node.path, ",".join(node.children), node.weak, node.before))
            stack.pop()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            token = m[0]
            if token[:2] not in ("<!", "<?") and not stack[-1].gone:
                piece.append(token)
            elif token.startswith("<![CDATA[") and not stack[-1].gone:
                piece.append(token[9:].removesuffix("]]>"))
            continue
        closing, raw = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag in VOID:
            if not stack[-1].gone:
                piece.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag not in INLINE:
            if not stack[-1].gone:
                flush()
            shut = {"li": ("li", ("ul", "ol", "menu")), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")),
                    "th": ("th", ("tr", "table")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)),
                    "option": ("option", ("select",))}.get(tag)
            for i in range(len(stack) - 1, 0, -1):         # implied end tags
                if (tag in CLOSES_P and stack[i].tag == "p") or (shut and stack[i].tag in (tag, shut[0])):
                    close(i)
                    break
                if stack[i].tag not in INLINE and stack[i].tag != "p" and not (shut and stack[i].tag not in shut[1]):
                    break
            if not stack[-1].children or stack[-1].children[-1] != tag:
                stack[-1].children.append(tag)
        node = _open(stack[-1], tag, raw, whole)
        if not raw.endswith("/") or tag not in VOID:
            stack.append(node)
    close(1)
    flush()
    return _by_name(blocks, boxes, whole)


def host(url) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _texts(batch):
    """Rows of a batch as (index, url, html)."""
    urls = batch.column(batch.schema.get_field_index("url"))
    pages = batch.column(batch.schema.get_field_index("html"))
    for i in range(batch.num_rows):
        yield i, urls[i].as_py(), pages[i].as_py() or ""


def _spans(blocks: list) -> dict:
    """Path of each box with text: ([its texts as ranges of blocks], the box)."""
    boxes: list = []
    seen = set()
    for i, b in enumerate(blocks):
        box = b[2]
        if box is not None:
            box.lo, box.hi = (i if box.lo is None else box.lo), i + 1
        while box is not None and id(box) not in seen:
            seen.add(id(box))
            boxes.append(box)
            box = box.up
    # a box comes after those inside it, if these are taken by their distance from the outermost one
    depth: dict = {}
    for box in boxes:
        way = []
        while box is not None and id(box) not in depth:
            way.append(box)
            box = box.up
        at = depth[id(box)] if box is not None else 0
        for b in reversed(way):
            at = depth[id(b)] = at + 1
    spans: dict = {}
    for box in sorted(boxes, key=lambda b: -depth[id(b)]):
        spans.setdefault(box.path, ([], box))[0].append((box.lo, box.hi))
        up = box.up
        if up is not None:
            up.lo = box.lo if up.lo is None else min(up.lo, box.lo)
            up.hi = box.hi if up.hi is None else max(up.hi, box.hi)
    return spans


def _around(box: _Box, known: dict) -> list[int]:
    """Paths of the boxes 1, 2, 4, ... steps further out."""
    if box.path not in known:
        way = []
        while box is not None and box.path not in known:
            way.append(box)
            box = box.up
        for b in reversed(way):
            out = [b.up.path] if b.up is not None else []
            while out and len(known[out[-1]]) >= len(out):
                out.append(known[out[-1]][len(out) - 1])
            known[b.path] = out
        return known[way[0].path]
    return known[box.path]


_AROUND = 10             # kind of a box one step further out; 11: two steps, 12: four, ...


def _stats_task(batches):
    """(kind, host, path, value): 0 a text inside, 1 a layout, 2 the page
    itself, from _AROUND on a box further out."""
    for batch in batches:
        out, size = [], 0
        for _, url, page in _texts(batch):
            blocks, boxes = parse(page)
            site = _hash(host(url))
            texts = np.array([_hash(b[0]) for b in blocks], np.int64)
            known: dict = {}
            for path, (ranges, box) in _spans(blocks).items():
                inside = np.unique(np.concatenate([texts[i:j] for i, j in ranges]))
                out.append(_stat(0, site, path, inside))
                out += [_stat(_AROUND + k, site, path, up) for k, up in enumerate(_around(box, known))]
                size += len(inside) + len(known[path])
                if size > 100_000:
                    yield _stat_rows(out)
                    out, size = [], 0
            rows = {(1, site, path, _hash(layout)) for path, layout in boxes}
            rows.update((2, site, path, 0) for path, _ in boxes)
            out.append(np.array(list(rows), np.int64).reshape(-1, 4))
            size += len(rows)
            if size > 100_000:
                yield _stat_rows(out)
                out, size = [], 0
        yield _stat_rows(out)


def _stat(kind: int, site: int, path, value) -> np.ndarray:
    a = np.empty((max(np.size(path), np.size(value)) if np.size(path) and np.size(value) else 0, 4), np.int64)
    a[:, 0], a[:, 1], a[:, 2], a[:, 3] = kind, site, path, value
    return a


def _stat_rows(out):
    a = np.concatenate([np.zeros((0, 4), np.int64), *out])
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0].astype(np.int32))] + [pa.array(a[:, i]) for i in (1, 2, 3)],
                                      names=["kind", "host", "path", "value"])


def noisy_nodes(pages: DataFrame) -> DataFrame:
    """(host, path) hashes of the noisy nodes of each host's pages, and of
    their repeated texts, whose hash is that of the path xor the text's."""
    seen = cut(pages.mapInArrow(_stats_task, "kind int, host long, path long, value long")
               .groupBy("kind", "host", "path", "value").agg(F.count("*").alias("n")))
    nodes = seen.where("kind < 3")
    every = nodes.groupBy("kind", "path", "value").agg(F.sum("n").alias("n"))
    have = seen.where("kind = 2").select("host", "path", F.col("n").alias("m"))
    own = _judged(nodes, ["host", "path"])
    of_all = _judged(every, ["path"]).withColumnRenamed("verdict", "verdict_all")
    judged = cut(have.join(own, ["host", "path"], "left").join(of_all, "path", "left")
                 .select("host", "path", F.coalesce("verdict", "verdict_all").alias("verdict"))
                 .where("verdict in ('noise', 'important')"))
    # boxes around important ones: of each found, those 1, 2, 4, ... steps further out in turn are all
    spared = judged.where("verdict = 'important'").select("host", "path")
    most = seen.agg(F.coalesce(F.max("kind"), F.lit(0))).first()[0]
    for kind in range(_AROUND, most + 1):
        step = seen.where(F.col("kind") == kind).select("host", "path", "value")
        spared = cut(spared.unionByName(step.join(spared, ["host", "path"]).select("host", F.col("value").alias("path"))).distinct())
    noise = judged.where("verdict = 'noise'").select("host", "path").join(spared, ["host", "path"], "left_anti")
    told = seen.where(F.col("kind").eqNullSafe(0) & (F.col("n") >= PAGES)).select("host", "path", "value", "n").join(
        have, ["host", "path"]).where(F.col("n") * 100 >= F.col("m") * REPEATED)
    return noise.unionByName(told.select("host", F.col("path").bitwiseXOR(F.col("value")).alias("path")))


def _judged(seen: DataFrame, node: list[str]) -> DataFrame:
    """(node, verdict) of the nodes that ``PAGES`` pages have: 'noise',
    'important', or 'empty' without any text."""
    rows = seen.groupBy(*node).agg(
        F.sum(F.when(F.col("kind") == 0, F.log("n"))).alias("text_logs"), F.count_if(F.col("kind") == 0).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("layout_logs"),
        F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("m")).where(F.col("m") >= PAGES)
    content = 1 - F.col("text_logs") / F.col("texts") / F.log("m")
    layout = 1 - F.coalesce("layout_logs", F.lit(0.0)) / F.col("m") / F.log("m")
    return rows.select(*node, F.when(F.col("texts") == 0, "empty").when(MIX * content + (1 - MIX) * layout < LEAST, "noise")
                       .otherwise("important").alias("verdict"))


def _extract_task(known):
    def run(batches):
        for batch in batches:
            noise = batch.column(batch.schema.get_field_index("noise")).to_pylist() if known is None else None
            out = []
            for i, url, page in _texts(batch):
                site = _hash(host(url))
                out.append(_text(parse(page)[0], site, known.value if known else {(site, x) for x in noise[i] or ()}))
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")},
                "text": pa.array(out, pa.string()), "n_chars": pa.array([len(t) for t in out], pa.int64())})
    return run


def _text(blocks: list, site: int, noisy: set) -> str:
    main = any(b[1] for b in blocks)
    chosen = [b for b in blocks if b[1] or not main]
    cache: dict = {}

    def noise(box: _Box) -> bool:
        """Is the box, or one around it, noise?"""
        way = []
        while box is not None and id(box) not in cache:
            way.append(box)
            box = box.up
        out = cache[id(box)] if box is not None else False
        for b in reversed(way):
            # the elements of running text inside a main element are never boxes
            out = cache[id(b)] = out or (not (main and (b.tag in FLOW or b.tag in MAIN)) and (site, b.path) in noisy)
        return out

    def repeated(text: str, box) -> bool:
        return (main and box is not None and box.tag in FLOW and len(text.split()) <= SHORT
                and (site, box.path ^ _hash(text)) in noisy)
    left = [b[0] for b in chosen if not noise(b[2]) and not repeated(b[0], b[2])]
    return "\n".join(left or [b[0] for b in chosen])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null and empty pages have empty text; null or unreadable urls share one
    host; malformed and cut pages are read as far as they go.  A page whose
    every branch would be removed keeps them all.  Repeated rows each get
    theirs and also count as pages of their host.  Only the three named
    columns are read.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    out = f"page_id {kind}, url string, text string, n_chars long"
    nodes = cut(noisy_nodes(rows.select("url", "html")))
    if nodes.limit(NOISE_ROWS + 1).count() <= NOISE_ROWS:
        known = pages.sparkSession.sparkContext.broadcast({(r["host"], r["path"]) for r in nodes.collect()})
        return rows.mapInArrow(_extract_task(known), out)
    # too many nodes to send to every task: each page gets its host's
    lists = nodes.groupBy("host").agg(F.collect_list("path").alias("noise"))
    site = F.pandas_udf(lambda urls: urls.map(lambda u: _hash(host(u))), LongType())
    return (rows.withColumn("host", site("url")).join(lists, "host", "left").drop("host")
            .mapInArrow(_extract_task(None), out))
