"""Main text of HTML pages by inferred wrappers (union-free regular expressions).

Pages of a host share templates. A page's tokens form a tree of elements and text; a
*wrapper* is such a tree in which an element may be optional (``?``), repeated (``+``),
and a text is either fixed or a slot. Wrappers are inferred by alignment: the children of
two matching elements are aligned by their labels (longest common subsequence; between labels
that occur once, where there are hundreds of children); what has
no partner becomes optional, equal neighbours fold into one repeated group, texts that
differ become slots. A page alone is its own wrapper with everything fixed, so a wrapper
of a host comes from merging the wrappers of its pages, in any grouping: tasks merge the
pages they read, groups of at most ``FAN`` wrappers are merged in further rounds until
one is left per host. Only wrappers (whose size follows the templates, not the pages)
are shuffled by host; a host with a third of all pages is merged by many tasks.

Extraction walks a page together with its host's wrapper. The region is the page's article
or main element where there is one, else the whole body. Text under an element that is
never content (menus, headers, footers, asides, forms, scripts, ...), or whose class, id
or role says so, goes: inside of an article by the kinds of element that are no part of one
only, so bylines, formulas, tags or related work stay. On a page without an article,
text goes as well that the wrapper shows to be fixed on every one of ``MIN_PAGES`` or more
different pages. Blocks are cut at block elements, white space
inside a block becomes one space.

Defined results: null, empty or textless html: empty text; broken markup (unclosed,
stray or truncated tags, comments and references) is read as far as it goes, as browsers
do; equal pages count once in a wrapper, so copies make no text fixed; null URLs share
the empty host; nesting deeper than ``DEPTH`` is flattened, with its end tags; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import bisect
import html as entities
import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written
from webmetrics.llm.frames import ship
from webmetrics.llm.url_filter import host_of
from webmetrics.llm.words import slices

FAN = 64
TABLE = 1 << 16   # cells of an alignment table
HELD = 20_000     # hosts a task merges at a time
MIN_PAGES = 4
DEPTH = 60
#: Fixed values of HTML: elements without content, with raw content, and those that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table
tbody td tfoot th thead tr ul""".split())
#: An opening tag on the left closes an open element on the right, up to its container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
KEEPS = frozenset("ul ol dl table body html article main section div".split())
#: Never part of an article.
NEVER = frozenset("""head nav footer aside form button select option menu dialog object applet canvas audio video
datalist input label search annotation annotation-xml""".split()) | RAW
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that name a menu, header, footer, sidebar, notice, advert, form or reader
#: comments; inside of an article only these count.
_IN_ARTICLE = r"""ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|header|masthead|menu|nav|navbar|
navigation|newsletter|notices?|pager|pagination|promo\w*|replies|respond|sidebar|sponsor\w*|subscribe|toolbar"""
#: On a page without an article or main element these go as well.
_ELSEWHERE = r"""byline|copyright|disclaimer|feedback|modal|popup|recommend\w*|related|share|sharing|skip|social|tags|teaser|widgets?"""
ARTICLE_NAMES = re.compile(rf"(?:^|[\s_-])(?:{_IN_ARTICLE})(?:$|[\s_-])", re.I | re.X)
NEVER_NAMES = re.compile(rf"(?:^|[\s_-])(?:{_IN_ARTICLE}|{_ELSEWHERE})(?:$|[\s_-])", re.I | re.X)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")


class Node:
    """An element (label, children) or a text (label None, text)."""

    __slots__ = ("tag", "label", "kids", "text", "names", "role", "hidden")

    def __init__(self, tag, label=None, text=None):
        self.tag, self.label, self.text, self.kids = tag, label, text, []
        self.names, self.role, self.hidden = "", "", False


def tree(source: str) -> Node:
    """The page's elements, with browsers' leniency for what is left open."""
    root = Node("#", "#")
    stack, at = [root], 0
    deep: Counter[str] = Counter()      # open elements beyond DEPTH, which are not on the stack

    def text(raw):
        if raw:
            stack[-1].kids.append(Node(None, None, entities.unescape(raw)))

    while at < len(source):
        m = _TAG.search(source, at)
        if m is None:
            text(source[at:] if "<" not in source[at:] or not re.search(r"<[a-zA-Z/!?]", source[at:]) else
                 source[at:at + re.search(r"<[a-zA-Z/!?]", source[at:]).start()])
            break
        text(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if deep[tag]:
                deep[tag] -= 1
                continue
            _close(stack, tag)
            if len(stack) < DEPTH:
                deep.clear()
            continue
        _open(stack, tag)
        if len(stack) < DEPTH:
            deep.clear()
        node = _element(tag, m[3])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            if len(stack) < DEPTH:
                stack.append(node)
            else:
                deep[tag] += 1
    return root


def _element(tag: str, attributes: str) -> Node:
    node = Node(tag, tag)
    if attributes.strip():
        found = {m[1].lower(): entities.unescape(next((x for x in m.groups()[1:] if x is not None), "")) for m in _ATTR.finditer(attributes)}
        node.names = " ".join(x for x in (found.get("class"), found.get("id")) if x)
        node.role = found.get("role", "").strip().lower()
        node.hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", "")))
        kind = sorted(set((found.get("class") or "").split()))
        if kind or node.role:
            node.label = ".".join([tag, *kind]) + (f"[{node.role}]" if node.role else "")
    return node


def _open(stack: list[Node], tag: str) -> None:
    if tag in BLOCK:
        for i in range(len(stack) - 1, 0, -1):      # a block element ends an open paragraph
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in KEEPS:
                break
    shut = CLOSES.get(tag, ())
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in shut:
            del stack[i:]
        elif stack[i].tag in KEEPS:
            break


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in ("article", "main", "td", "th", "table", "body") and tag not in BLOCK:
            return


# --- wrappers: [label, optional, repeated, children]; a text is [null, optional, repeated, fixed text or null]

def wrapper(node: Node) -> list:
    """A page's own wrapper: every text fixed, equal neighbours folded."""
    kids = []
    for k in node.kids:
        if k.label is None:
            t = " ".join(k.text.split())
            if t:
                kids.append([None, False, False, _mark(t)])
        elif not never(k):
            kids.append(wrapper(k))
    return [node.label, False, False, folded(kids)]


def _mark(t: str) -> str:
    """A fixed text; a long one by its hash, to keep wrappers small."""
    if len(t) <= 40:
        return "=" + t
    import hashlib
    return "#" + hashlib.blake2b(t.encode(errors="surrogatepass"), digest_size=12).hexdigest()


def folded(kids: list) -> list:
    """Neighbours with one label become one repeated group."""
    out: list = []
    for k in kids:
        if out and out[-1][0] == k[0]:
            out[-1] = merged(out[-1], k)
            out[-1][2] = True
        else:
            out.append(k)
    return out


def merged(a: list, b: list) -> list:
    """Alignment of two wrappers with one label."""
    optional, repeated = a[1] or b[1], a[2] or b[2]
    if a[0] is None:
        return [None, optional, repeated, a[3] if a[3] == b[3] else None]
    return [a[0], optional, repeated, folded(aligned(a[3], b[3]))]


def common(x: list, y: list) -> list[tuple[int, int]]:
    """Places of a common subsequence of labels: a longest one, or for lists whose table would be
    large one that runs through the longest row of labels that occur once in each."""
    if len(x) * len(y) <= TABLE:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
        out, i, j = [], 0, 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return out
    once, there = Counter(x), Counter(y)
    at = {k: j for j, k in enumerate(y) if there[k] == 1}
    anchors = rising([(i, at[k]) for i, k in enumerate(x) if once[k] == 1 and k in at])
    if not anchors:
        return in_turn(x, y)
    out, i, j = [], 0, 0
    for p, q in [*anchors, (len(x), len(y))]:
        out += [(i + u, j + v) for u, v in common(x[i:p], y[j:q])]
        if p < len(x):
            out.append((p, q))
        i, j = p + 1, q + 1
    return out


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (first places ascend) whose second places ascend too."""
    ends: list[int] = []        # last second place of the best run of each length
    best: list[int] = []        # its pair
    back = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(ends, j)
        back[n] = best[at - 1] if at else -1
        ends[at:at + 1], best[at:at + 1] = [j], [n]
    out, n = [], best[-1] if best else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def in_turn(x: list, y: list) -> list[tuple[int, int]]:
    """Each label of x with its next place in y, unless that skips more of y than is left of x."""
    places: dict = {}
    for j, k in enumerate(y):
        places.setdefault(k, []).append(j)
    out, j = [], 0
    for i, k in enumerate(x):
        here = places.get(k, ())
        n = bisect.bisect_left(here, j)
        if n < len(here) and here[n] - j <= len(x) - i:
            out.append((i, here[n]))
            j = here[n] + 1
    return out


def aligned(a: list, b: list) -> list:
    """Children in common merged, the others optional, in the order of both."""
    head = 0
    while head < len(a) and head < len(b) and a[head][0] == b[head][0]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    out, i, j = [merged(p, q) for p, q in zip(a[:head], b[:head], strict=True)], 0, 0
    for p, q in [*common([k[0] for k in x], [k[0] for k in y]), (len(x), len(y))]:
        out += [[k[0], True, *k[2:]] for k in (*x[i:p], *y[j:q])]
        if p < len(x):
            out.append(merged(x[p], y[q]))
        i, j = p + 1, q + 1
    n = len(a) - tail
    return out + [merged(p, q) for p, q in zip(a[n:], b[len(b) - tail:], strict=True)]


def differs(wrap: list) -> bool:
    """Whether the pages of a wrapper differ in a text or an element."""
    return wrap[1] or (wrap[3] is None if wrap[0] is None else any(map(differs, wrap[3])))


# --- extraction

def never(node: Node, names: re.Pattern = NEVER_NAMES) -> bool:
    """Elements that are no part of an article by their kind, role or name."""
    if node.tag in NEVER or node.role in NEVER_ROLES or node.hidden:
        return True
    if node.tag in ("html", "body", "article", "main"):
        return False
    return bool(node.names and names.search(node.names))


def region(node: Node) -> list[Node]:
    """The outermost article and main elements outside of boilerplate; else the page."""
    found: list[Node] = []

    def look(n):
        for k in n.kids:
            if k.label is None or never(k):
                continue
            if k.tag in ("article", "main") or k.role in ("main", "article"):
                inner = [x for x in k.kids if x.tag == "article"] if k.tag == "main" or k.role == "main" else []
                found.extend(inner or [k])
            else:
                look(k)

    look(node)
    return found or [node]


def main_text(source: str | None, host_wrapper: list | None) -> str:
    """The article's blocks, one per line."""
    if not source:
        return ""
    root = tree(source)
    inside = set(map(id, region(root)))
    # text of an article is never taken for its template's, nor is that of pages that don't differ
    if id(root) not in inside or host_wrapper is None or not differs(host_wrapper):
        host_wrapper = None
    names = NEVER_NAMES if id(root) in inside else ARTICLE_NAMES
    blocks: list[str] = []
    words: list[str] = []

    def end():
        line = " ".join("".join(words).split())
        words.clear()
        if line:
            blocks.append(line)

    def walk(node: Node, wrap: list | None, on: bool, within: frozenset):
        slots = wrap[3] if wrap and not wrap[1] else []     # what is optional has no fixed texts
        at = 0
        for k in node.kids:
            match = next((n for n in range(at, len(slots)) if slots[n][0] == k.label), None)
            w = None if match is None else slots[match]
            if match is not None:
                at = match if w[2] else match + 1
            if k.label is None:
                t = " ".join(k.text.split())
                if on and not (t and w and w[3] is not None and not w[1] and w[3] == _mark(t)):
                    words.append(k.text)
            elif k.tag == "br":
                words.append(" ")
            elif not never(k, names if on else NEVER_NAMES) and not (on and k.tag == "header" and "article" not in within):
                here = on or id(k) in inside
                if k.tag in BLOCK:
                    end()
                walk(k, w, here, within | {k.tag})
                if k.tag in BLOCK:
                    end()
            elif k.tag in BLOCK:
                end()

    walk(root, host_wrapper, id(root) in inside, frozenset())
    end()
    return "\n".join(blocks)


# --- Spark

def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, pages, wrapper as JSON): one per host, from its different pages."""
    ship(pages.sparkSession)
    p = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("text")).where("length(text) > 0")
    # of equal pages one is taken: the first to show a hash, found without moving the text
    p = p.withColumn("h", F.xxhash64("text"))
    copies = written(p.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "h"), "copies")

    def infer(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                for host, text in zip(piece.column("host").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    w = wrapper(tree(text))
                    held[host] = [held[host][0] + 1, merged(held[host][1], w)] if host in held else [1, w]
                if len(held) > HELD:
                    yield _rows(held)
                    held = {}
        yield _rows(held)

    def join_up(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            for host, n, raw in zip(*[batch.column(c).to_pylist() for c in ("host", "pages", "wrapper")], strict=True):
                w = json.loads(raw)
                held[host] = [held[host][0] + n, merged(held[host][1], w)] if host in held else [n, w]
        yield _rows(held)

    kind = "host string, pages long, wrapper string"
    single = p.join(copies, ["host", "h"], "left_anti").select("host", "text")
    twice = p.join(copies, ["host", "h"], "left_semi").groupBy("host", "h").agg(F.first("text").alias("text")).select("host", "text")
    out = written(single.unionByName(twice).mapInArrow(infer, kind), "wrappers")
    while True:
        most = out.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return out
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // FAN)))
        out = written(out.withColumn("salt", salt).repartition("host", "salt").mapInArrow(join_up, kind), "wrappers")


def _rows(held: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "host": pa.array(list(held), pa.string()), "pages": pa.array([x[0] for x in held.values()], pa.int64()),
        "wrapper": pa.array([json.dumps(x[1]) for x in held.values()], pa.string())})


def extracted(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: id, url, text."""
    known = wrappers(pages, url, html).where(F.col("pages") >= MIN_PAGES).select("host", "wrapper")
    p = pages.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("text"),
                     host_of(F.col(f"`{url}`")).alias("host")).join(known, "host", "left").select("id", "url", "text", "wrapper")
    kind = p.schema["id"].dataType.simpleString()

    def run(batches):
        cache: dict[str, list] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                out = []
                for text, raw in zip(piece.column("text").to_pylist(), piece.column("wrapper").to_pylist(), strict=True):
                    if raw is not None and raw not in cache:
                        if len(cache) > 200:
                            cache.clear()
                        cache[raw] = json.loads(raw)
                    out.append(main_text(text, cache.get(raw)))
                yield pa.RecordBatch.from_pydict({"id": piece.column("id"), "url": piece.column("url"), "text": pa.array(out, pa.string())})

    return p.mapInArrow(run, f"id {kind}, url string, text string").withColumnRenamed("id", ident)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: main text of ``pages``."""
    r = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return r.withColumn("n_chars", F.length("text").cast("long"))
