"""Main text of web pages by site style trees.

Page. A small DOM is built from the tags (html.parser reads them, so broken markup is no error). Blocks are runs of
text between block elements, each with the path of containers that it is in. What by its tag, role or class is a menu,
header, footer, sidebar, notice, advert, form, script, style or reader comment is no block. If a page has articles or a
main element, only blocks inside count.

Site style tree. Pages of a host are merged: nodes are container paths (tag, class and id, digits cut), and each holds
the presentation styles (which children follow each other) and the contents (blocks) of all the host's pages. Of a node
that m pages have, the presentation is important by its styles' entropy to base m, a block by 1 less the entropy of its
spread over pages (seen in one page: 1, in all: 0); together, with l children, importance is
(1 - 0.9**l) * presentation + 0.9**l * mean over the node's distinct blocks. Pages whose blocks are all equal count as
one. A node below `low`, in `least` different pages or more, goes from the pages if the rest of those pages' blocks is
more important by `gap`: on a host whose pages are all alike nothing tells a template from text, and nothing goes. The
page's root, its articles and main are never judged, so plain paragraphs of an article stay however often they are met.

Scale. A page's tree is made and read in one task. Merging is counting by (host, node, block) and (host, node), with
partial sums, so a host with most pages is spread. Low nodes per host are few; they are broadcast if measured to be
small, else met by host and salt.

Cases. Null or empty html: empty text. Null url or one without a host: its page is judged alone. Repeated page_ids and
rows are pages of their own. Pages cut off anywhere, unclosed tags and very long ones are read to the end. Empty table:
no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, doc_chunks, materialise
from .url_reputation import host_of

BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
#: Never main text, whatever is inside.
DEAD = frozenset("aside audio button canvas datalist dialog embed footer form frame frameset head iframe input label link map math menu meta nav noembed noframes noscript object option optgroup picture rp script search select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: First or last word of a class or id that marks something beside the text.
MARKS = frozenset("ad ads advert adverts advertisement advertising adsense adslot adbox alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus dropdown footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo promos promotion recommended related replies reply respond rss search share sharing shoutbox sidebar signup skip social sponsor sponsored sponsors subscribe subscription tagcloud toolbar topbar trending widget widgets".split())
#: A first word that says the element is about something, not that it is it.
ABOUT = frozenset("has have with without no not is in show hide".split())
#: The header of one of these has a heading of the text in it.
HEADED = frozenset("article content entry post section story".split())
#: Opening one of these ends an open one of the same row.
CLOSES = {t: frozenset({t}) for t in ("li", "option", "tr")} | {t: frozenset({"dt", "dd"}) for t in ("dt", "dd")} | {t: frozenset({"td", "th"}) for t in ("td", "th")}
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
STOPS = frozenset("article body div html main ol section table ul".split())
INLINE_KEEP = frozenset({"html", "body"})
PLAIN = frozenset("article blockquote body caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup html li main p pre summary tbody td tfoot th thead tr".split())
#: Deeper elements are no nodes of their own, as in browsers; their text is read all the same.
DEEPEST = 512


class Node:
    """An element. `own`: it is beside the text by itself; `dead`: it or one around it is."""

    __slots__ = ("children", "dead", "depth", "own", "parent", "style", "tag")

    def __init__(self, tag: str, style: str, parent: Node | None, own: bool) -> None:
        self.tag, self.style, self.parent, self.own, self.children = tag, style, parent, own, []
        self.dead = own or bool(parent and parent.dead)
        self.depth = parent.depth + 1 if parent else 0


def is_mark(value: str) -> bool:
    for name in value.split():
        words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
        if words and words[0] not in ABOUT and (words[0] in MARKS or words[-1] in MARKS) and not (words[-1] == "header" and words[0] in HEADED):
            return True
    return False


def beside(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether an element is something beside the text."""
    if tag in DEAD or tag == "header":
        return True
    if not attributes or tag in INLINE_KEEP:
        return False
    if (attributes.get("role") or "").lower() in ROLES or "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true":
        return True
    if re.search(r"(display\s*:\s*none|visibility\s*:\s*hidden)", (attributes.get("style") or "").lower()):
        return True
    return is_mark(attributes.get("class") or "") or is_mark(attributes.get("id") or "")


class Reader(HTMLParser):
    """Builds the tree; children are nodes, strings, or None for the end of a block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("root", "", None, False)
        self.beyond: Counter[str] = Counter()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_open(tag)
        if tag in ("article", "main", "h1"):
            # a form around the whole page is no form beside the text
            node = self.at
            while node:
                if node.tag == "form" and node.parent and not node.parent.dead:
                    node.dead = node.own = False
                node = node.parent
        if tag == "br":
            self.at.children.append(" ")
        elif tag == "hr":
            self.at.children.append(None)
        elif tag not in VOID:
            attributes = dict(attrs)
            own = beside(tag, attributes)
            dead = own or self.at.dead
            # inline elements are no nodes, but that the end of a dead one must be found
            if self.at.depth >= DEEPEST and not dead:
                if tag in BLOCK:
                    self.at.children.append(None)
                    self.beyond[tag] += 1
            elif tag in BLOCK or dead:
                style = ".".join([tag, *sorted(re.sub(r"\d+", "", f"{attributes.get('class') or ''} {attributes.get('id') or ''}").lower().split())])
                node = Node(tag, style, self.at, own)
                self.at.children.append(node)
                self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # a slash at the end of a tag has no meaning in HTML
        self.handle_starttag(tag, attrs)

    def end_open(self, tag: str) -> None:
        """Elements that a new block of this kind ends: a paragraph, a heading, the row or item before."""
        node = self.at
        while node.parent and node.tag not in BLOCK:
            node = node.parent
        if node.tag == "p" or (node.tag in HEADINGS and tag in HEADINGS):
            self.at = node = node.parent
        also = CLOSES.get(tag)
        while also and node.parent and node.tag not in STOPS:
            if node.tag in also:
                self.at = node.parent
                return
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        if self.beyond[tag] > 0:
            self.beyond[tag] -= 1
            self.at.children.append(None)
            return
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def outermost(node: Node, tags: frozenset[str], dead: bool = False) -> list[Node]:
    """The outermost elements of these kinds, in page order; those in parts beside the text only if `dead` says so."""
    found, todo = [], [node]
    while todo:
        n = todo.pop()
        if n is not node and n.tag in tags:
            found.append(n)
        else:
            todo += [c for c in reversed(n.children) if isinstance(c, Node) and (dead or not c.dead)]
    return found


def text_roots(page: Node) -> list[Node]:
    """What of a page holds its text: articles, or main, or all. Where broken markup puts an article or main in a menu or the like, that."""
    articles, main = frozenset({"article"}), frozenset({"main"})
    live = outermost(page, articles) or outermost(page, main)
    if not live and (lost := [n for n in outermost(page, articles | main, True) if not n.own]):
        for n in lost:
            revive(n)
        return lost
    return live or [page]


def revive(node: Node) -> None:
    """What is under a node that isn't beside the text by itself."""
    todo = [node]
    while todo:
        n = todo.pop()
        n.dead = False
        todo += [c for c in n.children if isinstance(c, Node) and not c.own]


def name_of(above: int, s: str) -> int:
    """A 64-bit name of s under the name of what is above it."""
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), above & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def blocks(html: str) -> tuple[list[tuple[str, list[int]]], dict[int, tuple[int, int]]]:
    """([(text, its containers' names)], {container: (name of its children's styles, how many they are)}) of a page.

    Paragraphs, headings, list items and the like without class and id belong to the container around them.
    """
    reader = Reader()
    reader.feed(html)
    reader.close()
    out: list[tuple[str, list[int]]] = []
    styles: dict[int, tuple[int, int]] = {}
    for root in text_roots(reader.root):
        buffer: list[str] = []
        # [node, place of its next child, its name, whether it may be judged]
        stack: list[list] = [[root, 0, 0, False]]

        def close() -> None:
            text = " ".join("".join(buffer).split())  # noqa: B023 - called in this turn only
            buffer.clear()  # noqa: B023
            if text:
                out.append((text, [e[2] for e in stack if e[3]]))  # noqa: B023

        while stack:
            node, k, name, judged = stack[-1]
            if k == 0 and judged:
                mine = [c.style for c in node.children if isinstance(c, Node) and not c.dead]
                styles.setdefault(name, (name_of(1, "\n".join(mine)), len(mine)))
            if k == len(node.children):
                close()
                stack.pop()
                continue
            stack[-1][1] += 1
            child = node.children[k]
            if isinstance(child, str):
                buffer.append(child)
            elif child is None:
                close()
            elif not child.dead or child.tag in BLOCK:
                close()
                if child.dead and child.tag == "header" and node.tag in ("article", "main"):
                    # an article's own header: its headings are text
                    child.dead, child.children = False, outermost(child, HEADINGS, True)
                    for c in child.children:
                        revive(c)
                if not child.dead:
                    stack.append([child, 0, name_of(name, child.style), child.style not in PLAIN])
    return out, styles


def parsed(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, blocks, children) of every page; `row` tells rows apart and is written, so it stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("hash", pa.int64()), ("path", pa.list_(pa.int64()))]))
        child = pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64()), ("children", pa.int32())]))
        for batch in (b for x in batches for b in doc_chunks([x], "html")):
            found, below = [], []
            for html in batch.column("html").to_pylist():
                got, styles = blocks(html) if html else ([], {})
                around = {n for _, path in got for n in path}
                found.append([{"text": t, "hash": name_of(0, t), "path": path} for t, path in got])
                below.append([{"node": n, "style": styles[n][0], "children": styles[n][1]} for n in sorted(around)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(found, kind), pa.array(below, child)], ["row", "page_id", "url", "host", "blocks", "children"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", F.nullif(host_of(F.col("url")), F.lit("")).alias("host"), "html")
    out = rows.mapInArrow(run, f"row long, page_id {id_type}, url string, host string, blocks array<struct<text:string,hash:long,path:array<long>>>, children array<struct<node:long,style:long,children:int>>")
    return materialise(out, "style-pages")


def low_nodes(pages: DataFrame, low: float, least: int, gap: float) -> DataFrame:
    """(host, nodes): the nodes of each host's style tree that are not important enough."""
    # pages with equal blocks are one; a page without nodes says nothing
    whole = F.xxhash64(F.transform("blocks", lambda b: b["hash"]))
    told = pages.where("host is not null and size(children) > 0").groupBy("host", whole.alias("page")).agg(F.first(F.transform("blocks", lambda b: F.struct(b["hash"].alias("hash"), b["path"].alias("path")))).alias("blocks"), F.first("children").alias("children"))
    told = materialise(told, "style-told")
    children = told.select("host", F.inline("children"))
    # presentation: entropy of the styles of a node over its m pages, to base m
    per = children.groupBy("host", "node", "style").agg(F.count("*").alias("c"), F.sum("children").alias("l"))
    m = per.groupBy("host", "node").agg(F.sum("c").alias("m"), F.sum("l").alias("l"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    share = F.try_divide(F.log("m") - F.col("clogc") / F.col("m"), F.log("m"))
    shown = m.where(F.col("m") >= least).select("host", "node", "m", (F.col("l") / F.col("m")).alias("l"), share.alias("presentation"))
    # contents: a block once for each page, in each node around it and in the page as a whole (node null)
    spread = told.select("host", "page", F.explode("blocks").alias("b")).select("host", "page", "b.hash", F.explode(F.array_append(F.col("b.path"), F.lit(None).cast("long"))).alias("node")).distinct()
    blocks = spread.groupBy("host", "node", "hash").agg(F.count("*").alias("c"))
    spread_of = lambda m: 1 - F.try_divide(F.log("c"), F.log(m))
    inside = blocks.where("node is not null").join(shown.select("host", "node", "m"), ["host", "node"])
    content = inside.groupBy("host", "node").agg(F.avg(spread_of("m")).alias("content"), F.sum(spread_of("m")).alias("sum_in"), F.count("*").alias("n_in"))
    # the whole of a host: the same blocks over all its pages
    size = told.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    every = blocks.where("node is null").join(size, "host").groupBy("host", "pages").agg(F.sum(spread_of("pages")).alias("sum_all"), F.count("*").alias("n_all"))
    weight = F.pow(F.lit(0.9), F.col("l"))
    judged = shown.join(content, ["host", "node"]).join(every, "host").withColumn("importance", (1 - weight) * F.col("presentation") + weight * F.col("content"))
    rest = F.try_divide(F.col("sum_all") - F.col("sum_in"), F.col("n_all") - F.col("n_in"))
    return judged.where((F.col("importance") < low) & (rest >= F.col("importance") + gap)).groupBy("host").agg(F.collect_set("node").alias("nodes"))


def extract(pages: DataFrame, low: float = 0.3, least: int = 5, gap: float = 0.3, broadcast_rows: int = 100_000) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    bound_batches(pages.sparkSession)
    page = parsed(pages)
    nodes = materialise(low_nodes(page, low, least, gap), "style-low")
    known = page.select("row", "page_id", "url", "host", F.transform("blocks", lambda b: F.struct(b["text"].alias("text"), b["path"].alias("path"))).alias("blocks"))
    if nodes.agg(F.coalesce(F.sum(F.size("nodes")), F.lit(0))).first()[0] <= broadcast_rows:
        met = known.join(F.broadcast(nodes), "host", "left")
    else:
        # a host with most pages meets its nodes in 64 places
        salts = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        met = known.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(64)).cast("int")).join(salts, ["host", "salt"], "left")
    kept = F.filter("blocks", lambda b: F.col("nodes").isNull() | ~F.arrays_overlap(b["path"], F.col("nodes")))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return met.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def oracle() -> str:
    """The text of pages whose article is of headings and paragraphs, and whose site has no template inside it, as the given tables'."""
    article = "regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1)"
    parts = f"string_split(regexp_replace(regexp_replace({article}, '</?(?:p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), chr(1))"
    plain = "regexp_replace(x, '<[^>]*>', '', 'g')"
    for entity, char in (("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;?", "&")):
        plain = f"regexp_replace({plain}, '{entity}', '{char}', 'g')"
    clean = rf"trim(regexp_replace({plain}, '\s+', ' ', 'g'))"
    return f"SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, array_to_string(list_filter(list_transform({parts}, lambda x: {clean}), lambda x: x <> ''), chr(10)) AS text FROM pages)"
