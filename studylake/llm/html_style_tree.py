"""HTML extraction by site style trees.

The DOMs of a host's pages are merged: nodes with one path (tags, classes and
ids from the root) are one node of the host's style tree.  Its importance
combines two entropies over the m different pages that hold the node:

* presentation: the entropy (base m) of the tag sequences of its children;
* content: 1 minus the mean entropy of its texts, where a text on n of the m
  pages has entropy log_m n.  Texts that repeat all over a site score 0, texts
  of one page 1.

Branches of low importance are removed from every page.  Pages count as one if
the blocks agree that their markup does not drop, so copies of an article do not
make it look like a menu, whatever adverts or link lists surround it.
Markup that says what a branch is comes first: navigation, page headers and
footers, sidebars, notices, adverts, forms, comments, scripts and styles are
unimportant, and where a page marks its main text (main, or articles with half
of its text at least) what lies outside is too.  A class or id marks a branch
only as a whole token ("sidebar", "site-footer", not "has-sidebar"), and never
one that holds an article or main or, on a page without them, most of the
text.  The entropies
decide the rest: unmarked branches outside, and nearly constant ones inside.

Statistics are plain aggregates by (host, node, text), so a hot host spreads
by text.  The list of low nodes is joined to the pages by host; it has one row
per host, and Spark broadcasts it only below its own size threshold.

Edge cases: null or empty HTML gives an empty text; a null or unreadable URL
is its own host ''; unclosed elements end with their parents; unclosed
comments, scripts and tags end with the page; repeated rows are extracted one
by one; an empty table gives an empty result; other columns are kept by
``extract``.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from studylake.llm.common import small_batches, table, written
from studylake.llm.url_redirects import host_of

#: Weight of content against presentation.
CONTENT = 0.9
#: A branch outside a marked main text goes below this importance, from so many different pages on; inside, see below.
LOW, LOW_PAGES = 0.5, 5
LOW_INSIDE, LOW_INSIDE_PAGES = 0.2, 20

_WORDS = frozenset
VOID = _WORDS("area base br col embed hr img input link meta param source track wbr".split())
RAW = _WORDS("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = _WORDS("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: What may stand in a head; any other tag, or text, ends it, as its end tag may be left out.
IN_HEAD = _WORDS("title meta link base basefont bgsound script style noscript noframes template".split())
#: Tags without a place in the text: a paragraph goes on behind them.
UNSEEN = _WORDS("script style link meta base".split())
NOISE_TAGS = _WORDS("head title script style noscript template nav footer aside button select option textarea iframe svg canvas object menu dialog noembed noframes".split())
NOISE_ROLES = _WORDS("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_NAMES = _WORDS("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay
sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus share sharing social related newsletter subscribe signup login widget toolbar pagination""".split())
#: Words that may stand beside a noise word in a class or id ("site-footer"); any other makes it say something else ("no-comments").
BESIDE = _WORDS("site page global main top bottom left right upper lower primary secondary mobile desktop box block bar area list section container wrapper wrap header cookie".split())
CLOSES_P = _WORDS("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": (), "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "optgroup": ("select",), "tbody": ("table",), "tfoot": ("table",)}
#: Noise words that say so beside any other word ("ad-slot", "user-comments", "sidebar-2") but one that takes it back.
PLAIN_NOISE = _WORDS("ad ads advert advertisement sponsored sponsor promo sidebar comment comments cookie newsletter breadcrumb breadcrumbs".split())
TAKES_BACK = _WORDS("no not non has have is with without free off open js".split())
P_SCOPE = _WORDS("html table td th caption button object template".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|</?([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?/][^>]*>?|<[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    __slots__ = ("tag", "path", "noise", "main", "named", "marks", "children")

    def __init__(self, tag: str, path: int, noise: bool, main: int, named: bool = False, marks: tuple[int, ...] = ()):
        self.tag, self.path, self.noise, self.main, self.named, self.marks = tag, path, noise, main, named, marks
        self.children: list[tuple[str, Node | None]] = []

    def style(self) -> str:
        """The tags of the children, without noise."""
        return ",".join(tag for tag, n in self.children if n is None or not n.noise)


#: What a node says of its branch: nothing, an article, or the page's main text.
PLAIN, ARTICLE, MAIN = 0, 1, 2


def _says_noise(token: str) -> bool:
    parts = [p for p in re.split(r"[-_]+", token) if p and not re.fullmatch(r"\d+(x\d+)?", p)]
    if len(parts) == 2 and any(p in PLAIN_NOISE for p in parts) and not any(p in TAKES_BACK for p in parts):
        return True
    return any(p in NOISE_NAMES for p in parts) and all(p in NOISE_NAMES or p in BESIDE for p in parts)


def _marks(tag: str, attributes: dict[str, str], inside: bool) -> tuple[bool, bool, int]:
    """(noise, noise by its name only, main) as the markup says."""
    names = _WORDS(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split())
    role = attributes.get("role", "").lower()
    if tag in ("html", "body"):
        return False, False, PLAIN
    if tag in NOISE_TAGS or role in NOISE_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True, False, PLAIN
    if tag == "main" or role == "main" or attributes.get("itemprop", "").lower() == "articlebody":
        return False, False, MAIN
    if tag == "article":
        return bool(names & {"comment", "comments", "reply", "replies"}), False, ARTICLE
    # a form is noise as a name is: not if it holds the article, or most of the page
    named = tag == "form" or any(map(_says_noise, names)) or (not inside and (tag == "header" or bool(names & {"header", "site-header", "page-header"})))
    return False, named, PLAIN


def blocks(page: str) -> tuple[list[tuple[str, Node, bool, int]], list[Node]]:
    """Text blocks of a page in order as (text, owner, noise, main text that it is inside), and all element nodes."""
    root = Node("", 0, False, PLAIN)
    stack, nodes, out = [root], [root], []
    held: list[bool] = []  # of each branch marked by its name: holds an article or main
    text: list[str] = []
    known: dict[tuple, Node] = {}

    def flush() -> None:
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            owner = next(n for n in reversed(stack) if n.tag not in INLINE)
            out.append((joined, owner))

    def leave_head() -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "head":
                pop_to(k)
                break

    def write(t: str) -> None:
        if stack[-1].tag == "head" and not t.isspace():
            leave_head()
        text.append(t)

    def pop_to(k: int) -> None:
        if any(n.tag not in INLINE for n in stack[k:]):
            flush()
        del stack[k:]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            write(html.unescape(page[at:]))
            break
        if m.start() > at:
            write(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[1]
        if tag is None:
            continue
        tag = tag.lower()
        if page[m.start() + 1] == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
            continue
        if tag not in IN_HEAD:
            leave_head()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in P_SCOPE:
                    break
        if tag in CLOSES:
            stop = SCOPE.get(tag, ("table",))
            low = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in CLOSES[tag]:
                    low = k
            if low is not None:
                pop_to(low)
        if tag == "br":
            text.append(" ")
        elif tag not in INLINE and tag not in UNSEEN:
            flush()
        parent = stack[-1]
        if tag in VOID:
            parent.children.append((tag, None))
            continue
        key = (parent.path, tag, m[2], parent.noise, parent.main)  # marks are of the page's own branches
        seen = known.get(key)
        if seen is None:
            attributes = {a.lower(): b or c or d or "" for a, b, c, d in _ATTRIBUTE.findall(m[2])} if m[2] else {}
            noise, named, main = _marks(tag, attributes, bool(parent.main))
            seen = known[key] = Node(tag, xxhash.xxh3_64_intdigest(f"{parent.path}>{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}") >> 1, parent.noise or noise, max(parent.main, main), named)
        node = Node(tag, seen.path, seen.noise, seen.main, seen.named, parent.marks)
        if seen.named and not seen.noise:
            node.marks += (len(held),)
            held.append(False)
        elif seen.main > parent.main and not seen.noise:
            for k in parent.marks:
                held[k] = True
        nodes.append(node)
        parent.children.append((tag, node))
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if not (m[2].rstrip().endswith("/") and tag in ("svg", "path", "g")):
            stack.append(node)
    flush()
    size = [0] * len(held)
    total = 0
    for t, n in out:
        if not n.noise:
            total += len(t)
            for k in n.marks:
                size[k] += len(t)
    elsewhere = any(n.main and not n.noise for _, n in out)  # then a branch without them may well be longer than a short article
    gone = {k for k, h in enumerate(held) if not h and (elsewhere or 2 * size[k] <= total)}
    for n in nodes:
        n.noise = n.noise or any(k in gone for k in n.marks)
    return [(t, n, n.noise, n.main) for t, n in out], nodes


def _main_marked(texts: list[tuple[str, Node, bool, int]]) -> bool:
    """Whether what lies outside the marked main text goes: not for an article that is a small part of the page."""
    kept = [(len(t), main) for t, _, noise, main in texts if not noise]
    return any(main == MAIN for _, main in kept) or 0 < sum(n for n, _ in kept) <= 2 * sum(n for n, main in kept if main)


def _node_rows(pages: DataFrame) -> DataFrame:
    """(host, path, inside, kind, value, page): kind 0 has the texts of a node, kind 1 its style; equal pages have one ``page``.

    Only of blocks that the markup keeps: the others go whatever their importance.
    """
    schema = pa.schema([("host", pa.string()), ("path", pa.int64()), ("inside", pa.bool_()), ("kind", pa.int32()), ("value", pa.int64()), ("page", pa.int64())])

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                texts, nodes = blocks(page or "")
                marked = _main_marked(texts)
                named = {(n.path, bool(main), xxhash.xxh3_64_intdigest(t) >> 1) for t, n, noise, main in texts if not noise and (main or not marked)}
                whole = xxhash.xxh3_64_intdigest("".join(map(str, sorted(v for _, _, v in named)))) >> 1
                rows += [(host, p, main, 0, v, whole) for p, main, v in named]
                owners = {p: main for p, main, _ in named}
                styles: dict[int, list[str]] = defaultdict(list)
                for n in nodes:
                    if n.path in owners and not n.noise:
                        styles[n.path].append(n.style())
                rows += [(host, p, owners[p], 1, xxhash.xxh3_64_intdigest("|".join(sorted(s))) >> 1, whole) for p, s in styles.items()]
                rows += [(host, p, owners[p], 1, 0, whole) for p in owners.keys() - styles.keys()]
            cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return pages.select("host", "html").mapInArrow(run, "host string, path bigint, inside boolean, kind int, value bigint, page bigint")


def importance(pages: DataFrame) -> DataFrame:
    """(host, path, inside, pages, importance) of every node that owns text, from ``pages`` (host, html)."""
    n = F.col("n")
    spread = _node_rows(pages).distinct().groupBy("host", "path", "inside", "kind", "value").agg(F.count("*").alias("n"))
    node = spread.groupBy("host", "path", "inside").agg(
        F.sum(F.when(F.col("kind") == 1, n)).alias("pages"), F.sum(F.when(F.col("kind") == 1, n * F.log(n))).alias("styles"),
        F.avg(F.when(F.col("kind") == 0, F.log(n))).alias("texts"))
    base = F.log("pages")
    looks = F.when(F.col("pages") > 1, (base - F.col("styles") / F.col("pages")) / base).otherwise(1.0)
    says = F.when(F.col("pages") > 1, 1 - F.col("texts") / base).otherwise(1.0)
    return node.select("host", "path", "inside", "pages", ((1 - CONTENT) * looks + CONTENT * says).alias("importance"))


def low_nodes(nodes: DataFrame) -> DataFrame:
    """(host, low): the paths of each host's unimportant nodes."""
    low = ((~F.col("inside") & (F.col("importance") < LOW) & (F.col("pages") >= LOW_PAGES))
           | (F.col("inside") & (F.col("importance") < LOW_INSIDE) & (F.col("pages") >= LOW_INSIDE_PAGES)))
    return nodes.where(low).groupBy("host").agg(F.collect_set("path").alias("low"))


def main_text(page: str | None, low: frozenset[int] = frozenset()) -> str:
    """The page's text without unimportant branches: blocks joined by line ends."""
    texts, _ = blocks(page or "")
    marked = _main_marked(texts)
    return "\n".join(t for t, n, noise, main in texts if not noise and (main or not marked) and n.path not in low)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (any columns, with url and html) and a new column text."""
    small_batches(pages.sparkSession)
    source = pages.drop("text")
    keyed = source.withColumn("__host", host_of(F.col("url")))
    low = written(low_nodes(importance(keyed.select(F.col("__host").alias("host"), "html"))), "style-tree").withColumnRenamed("host", "__host")
    joined = keyed.join(low, "__host", "left").drop("__host").withColumnRenamed("low", "__low")

    def run(batches):
        for b in batches:
            texts = [main_text(p, frozenset(x or ())) for p, x in zip(b.column("html").to_pylist(), b.column("__low").to_pylist(), strict=True)]
            yield b.drop_columns(["__low"]).append_column("text", pa.array(texts, pa.string()))

    return joined.mapInArrow(run, StructType(list(source.schema.fields)).add("text", StringType()))


def op7_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
            .select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")))
