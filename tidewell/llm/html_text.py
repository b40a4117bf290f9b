"""Main text of web pages by template deduction from equivalence classes of tokens.

Pages are parsed into tokens: opened containers, known by their path, and blocks of text. Over the pages
of a host each token has an occurrence vector, the number of times that it stands in every page. Tokens
with equal vectors form an equivalence class. Classes of two or more tokens that stand in half of the
host's pages are valid. Their containers that stand once a page, nested by their paths, are the host's
template. Its slots are what stands in a container but in no deeper one of the template.

Slots are judged over the host. One whose text is mostly links is a menu; one whose text mostly lies in
containers that repeat within the page holds records, such as comments. Of the others the one with the
largest share of the pages' texts is the article's. With it remain: the slots in the topmost article or
main element around it; or else those in the topmost container around it, below body, in which there
is neither menu nor records, the text right in the containers around it, and further slots of ``SIBLING``
of its share or more. Blocks that repeat over half of the host's pages, outside of an article or main
element, belong to the template and go.

Hosts of fewer than ``LEAST_PAGES`` pages show no template. There, and on pages on which the slots hold less
than half of what is left otherwise, containers that are no article by their element or their names go, and
all other text remains. Scripts, styles and parts of forms are never text; elements named as navigation,
asides or footers, and boxes named exactly as adverts, comments or the like, go everywhere.

Pages of a host with equal blocks count once as evidence, so copies don't make their text a template.
Vectors are never gathered: they are compared by sums and exclusive ors of hashes of page and count,
which are partial sums before any shuffle. So a host with a third of all pages is no hot group.

Defined results for odd input: a null html is the empty page and has the empty text; a null or broken url
is the host ''; repeated rows get equal results; an end tag that closes nothing is passed over; an empty
table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_unique, let, settle

BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption summary hr address".split())
CONTAINERS = frozenset(
    "html body div section article main aside nav header footer ul ol dl table tbody thead tfoot form figure details fieldset center menu dialog head noscript template svg iframe select button textarea object video audio canvas label".split()
)
#: Never text; then: never an article.
HARD = frozenset("head form noscript template iframe select button textarea svg object video audio canvas label script style title".split())
SOFT = frozenset("nav footer aside menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = re.compile(
    r"^(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alerts?|menu\w*|nav\w*|sidebar\w*|side|footer|header|masthead|topbar|breadcrumbs?"
    r"|comments?|commentlist|respond|replies|disqus\w*|shar\w+|social\w*|related\w*|recommend\w*|subscri\w+|newsletter\w*|signup|popup|modal|overlay|login|search\w*|pagination|pager|widgets?|toolbar|skip|copyright|legal|disclaimer|hidden|navigation|complementary|contentinfo|banner)$"
)
#: Names of boxes that are no article's text even inside of it.
BOXES = re.compile(r"^(?:ads?|advert|advertisement|adsense|adsbygoogle|sponsored|comments?|comment-?list|disqus_thread|share|sharing|social|newsletter|popup|modal)$")
BROADCAST_BYTES = 64 << 20
LEAST_PAGES, SHARE, SIBLING = 4, 0.5, 0.35
#: Hosts of more pages are joined by a broadcast, so that none is a hot partition.
HOT_PAGES = 100_000


class Page(HTMLParser):
    """Blocks of text with the paths of their containers, and how often each container's path is opened.

    A block: path, text, out (0 text; 1 no article by the names; 2 nor anywhere; 3 no text), the characters
    in links, and the length of the longest path around it of a div or section that repeats in the page.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str, int]] = []  # element, path, out
        self.found: list[tuple[str, str, int, int]] = []  # path, text, out, characters in links
        self.links, self.linked = 0, 0
        self.paths: Counter[str] = Counter()
        self.buffer: list[str] = []
        self.mute = 0
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        if text:
            _, path, out = self.open[-1] if self.open else ("", "", 0)
            self.found.append((path, text, out, min(self.linked, len(text))))
        self.linked = 0

    @functools.cached_property
    def blocks(self) -> list[dict]:
        longest: dict[str, int] = {"": 0}

        def repeated(path: str) -> int:
            if path not in longest:
                again = self.paths[path] > 1 and re.match(r"(?:div|section|article)(?:\.|$)", path.rpartition("/")[2])
                longest[path] = len(path) if again else repeated(path.rpartition("/")[0])
            return longest[path]

        return [{"path": p, "text": t, "out": o, "links": k, "rec": repeated(p)} for p, t, o, k in self.found]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "title"):
            self.flush()
            self.mute += 1
        elif tag == "br":
            self.buffer.append(" ")
        elif tag == "a":
            self.links = int(any(k == "href" for k, _ in attrs))
        elif tag in CONTAINERS:
            self.flush()
            given = dict(attrs)
            names = [n for key in ("id", "class", "role") for n in re.split(r"\s+", given.get(key) or "") if n]
            bad = any(NAMES.match(n.lower()) or NAMES.match(re.split(r"[-_]", n.lower())[0]) for n in names)
            gone = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
            path, out = (self.open[-1][1], self.open[-1][2]) if self.open else ("", 0)
            inside = any(t in ("article", "main") for t, _, _ in self.open)
            box = any(BOXES.match(n.lower()) for n in names)
            if tag not in ("html", "body", "article", "main"):
                own = 3 if tag in HARD or gone else 2 if tag in SOFT or box or (tag == "header" and not inside) else int(bad and not inside)
                out = max(out, own)
            label = ".".join([tag, *sorted({re.sub(r"\d{3,}", "", n.lower()) for n in names})])
            self.open.append((tag, f"{path}/{label}", out))
            self.paths[self.open[-1][1]] += 1
        elif tag in BLOCKS:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "title"):
            self.mute = max(0, self.mute - 1)
        elif tag == "a":
            self.links = 0
        elif tag in CONTAINERS:
            self.flush()
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    break
        elif tag in BLOCKS:
            self.flush()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in CONTAINERS and tag in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.buffer.append(data)
            self.linked += self.links * len(" ".join(data.split()))


PARSED = "id {}, url string, host string, blocks array<struct<path:string,text:string,out:int,links:int,rec:int>>, paths array<struct<path:string,n:int>>"


def parse(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, host, blocks and paths of every page."""
    url = F.col(f"`{url_col}`")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), host.alias("host"), F.col(f"`{html_col}`").alias("html"))
    block = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("out", pa.int32()), ("links", pa.int32()), ("rec", pa.int32())]))
    path = pa.list_(pa.struct([("path", pa.string()), ("n", pa.int32())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 256):
                batch = whole.slice(k, 256)
                found = [Page(x.as_py() or "") for x in batch.column(3)]
                blocks = [x.blocks for x in found]
                paths = [[{"path": p, "n": n} for p, n in x.paths.items()] for x in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(blocks, block), pa.array(paths, path)], names=["id", "url", "host", "blocks", "paths"])

    return rows.mapInArrow(of, PARSED.format(rows.schema["id"].dataType.simpleString()))


def _within(path: Column, top: Column) -> Column:
    return (path == top) | path.startswith(F.concat(top, F.lit("/")))


def _slot(path: Column, skeleton: Column) -> Column:
    """The deepest container of the template around a path; those around it are one another's beginnings."""
    return F.coalesce(F.array_max(F.filter(skeleton, lambda s: _within(path, s))), F.lit(""))


def _with_hosts(left: DataFrame, hosts: DataFrame) -> DataFrame:
    """left with its hosts' columns (but c, their pages): broadcast if they are small in bytes, else shuffled, large hosts apart."""
    arrays = [c for c in ("skeleton", "keep", "bad") if c in hosts.columns]
    chars = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("bigint"), lambda n, x: n + F.char_length(x)), F.lit(0))
    held = hosts.select(F.sum(sum((chars(c) for c in arrays), 64 + 8 * F.coalesce(F.size("fixed"), F.lit(0)))).alias("n")).first()["n"] or 0
    return left.join(F.broadcast(hosts.drop("c")), "host") if held <= BROADCAST_BYTES else join_unique(left, hosts, "host", HOT_PAGES)


def deduce(parsed: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """A row per host: c (its pages), skeleton (the template's containers), wrap (the container around the article), keep and bad (slots), fixed (hashes of repeated blocks).

    skeleton is null for hosts of fewer than least pages.
    """
    content = F.xxhash64(F.transform("blocks", lambda b: F.struct(b["path"], b["text"])))
    block = lambda b: F.struct(b["path"].alias("path"), F.xxhash64(b["path"], b["text"]).alias("block"), F.lit(1).alias("n"), F.char_length(b["text"]).alias("chars"), b["links"].alias("links"), b["rec"].alias("rec"))
    blocks = F.transform(F.filter("blocks", lambda b: b["out"] < 3), block)
    none = F.lit(0)
    paths = F.transform("paths", lambda p: F.struct(p["path"].alias("path"), F.lit(None).cast("bigint").alias("block"), p["n"].alias("n"), none.alias("chars"), none.alias("links"), none.alias("rec")))
    each = parsed.select("host", content.alias("page"), F.concat(paths, F.array_distinct(blocks)).alias("tokens"))
    once_each = settle(each.groupBy("host", "page").agg(F.first("tokens").alias("tokens"), F.count("*").alias("c")), "html-contents")
    tokens = once_each.select("host", "page", F.explode("tokens").alias("t"))
    mark = F.xxhash64("page", "t.n")
    vectors = tokens.groupBy("host", "t.path", "t.block").agg(
        F.count("*").alias("pages"), F.sum("t.n").alias("total"), F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND(F.lit((1 << 32) - 1))).alias("s")
    )
    sizes = settle(once_each.groupBy("host").agg(F.count("*").alias("host_pages"), F.sum("c").alias("c")), "html-sizes")
    frequent = settle(vectors.join(sizes.drop("c"), "host").filter((F.col("pages") >= 2) & (F.col("pages") >= share * F.col("host_pages"))), "html-tokens")
    classes = frequent.groupBy("host", "pages", "total", "x", "s").agg(F.count("*").alias("tokens"))
    template = frequent.join(classes.filter("tokens >= 2"), ["host", "pages", "total", "x", "s"])
    once = template.filter((F.col("host_pages") >= least) & F.expr("block IS NULL AND pages = total"))
    bones = once.groupBy("host").agg(F.collect_set("path").alias("skeleton"))
    fixed = frequent.filter("block IS NOT NULL AND pages >= 3").groupBy("host").agg(F.collect_set("block").alias("fixed"))
    hosts = settle(sizes.select("host", "c").join(bones, "host", "left").join(fixed, "host", "left"), "html-bones")

    texts = _with_hosts(once_each.select("host", F.filter("tokens", lambda t: t["block"].isNotNull()).alias("tokens")), hosts.filter("skeleton IS NOT NULL"))
    texts = texts.withColumn("tokens", F.filter("tokens", lambda t: F.coalesce(~F.array_contains("fixed", t["block"]), F.lit(True))))
    texts = texts.withColumn("whole", F.aggregate("tokens", F.lit(0).cast("bigint"), lambda n, t: n + t["chars"]))
    slots = texts.select("host", "skeleton", "whole", F.explode("tokens").alias("t")).withColumn("slot", _slot(F.col("t.path"), F.col("skeleton")))
    inside = F.when(F.col("t.rec") > F.char_length("slot"), F.col("t.chars")).otherwise(0)
    sums = slots.groupBy("host", "slot").agg(F.sum("t.chars").alias("chars"), F.sum("t.links").alias("links"), F.sum(inside).alias("rec"), F.sum(F.col("t.chars") / F.col("whole")).alias("weight"))
    judged = sums.withColumn("menu", 2 * F.col("links") > F.col("chars")).withColumn("records", 2 * F.col("rec") > F.col("chars"))
    every = judged.groupBy("host").agg(F.collect_list(F.struct("weight", "slot", "menu", "records")).alias("slots"))
    return hosts.join(every, "host", "left").select("host", "c", "skeleton", "fixed", *_verdict(F.col("skeleton"), F.col("slots")))


def _verdict(skeleton: Column, slots: Column) -> list[Column]:
    """wrap, keep and bad: the container around the article, the slots of the article, and those that are menus or records."""
    top = r"^(?:/(?!(?:article|main)(?:[./]|$))[^/]+)*/(?:article|main)(?:\.[^/]*)?$"
    page = r"^(?:/html(?:\.[^/]*)?)?(?:/body(?:\.[^/]*)?)?$"
    best = F.array_max(F.filter(slots, lambda s: ~s["menu"] & ~s["records"]))
    best = F.coalesce(best, F.array_max(F.filter(slots, lambda s: ~s["menu"])), F.array_max(slots))

    def with_main(main: Column) -> Column:
        bad = lambda s: (s["menu"] | s["records"]) & (s["slot"] != main["slot"])
        around = F.filter(skeleton, lambda p: _within(main["slot"], p))
        article = F.array_min(F.filter(around, lambda p: p.rlike(top)))
        clean = F.array_min(F.filter(around, lambda p: ~p.rlike(page) & ~F.exists(slots, lambda s: _within(s["slot"], p) & bad(s))))

        def kept(wrap: Column) -> Column:
            own = lambda s: _within(s["slot"], wrap["path"]) | (~wrap["article"] & (_within(main["slot"], s["slot"]) | (s["weight"] >= SIBLING * main["weight"])))
            return F.struct(F.transform(F.filter(slots, lambda s: ~bad(s) & own(s)), lambda s: s["slot"]).alias("keep"), wrap["path"].alias("wrap"), F.transform(F.filter(slots, bad), lambda s: s["slot"]).alias("bad"))

        return let(F.struct(F.coalesce(article, clean, main["slot"]).alias("path"), article.isNotNull().alias("article")), kept)

    both = F.when(F.size(slots) > 0, let(best, with_main))
    return [both[c].alias(c) for c in ("wrap", "keep", "bad")]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", lists: bool = True) -> DataFrame:
    """id, url and text (blocks joined by an empty line) of every page. Without lists, no element or name but those of HARD counts."""
    parsed = settle(parse(pages, id_col, url_col, html_col), "html-pages")
    hosts = settle(deduce(parsed), "html-hosts")
    named = _with_hosts(parsed, hosts)
    article = lambda b: b["path"].rlike(r"/(?:article|main)\b")
    new = lambda b: article(b) | F.coalesce(~F.array_contains("fixed", F.xxhash64(b["path"], b["text"])), F.lit(True))
    chars = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda n, b: n + F.char_length(b["text"]))
    named = named.withColumn("left", F.filter("blocks", lambda b: (b["out"] < 3) & new(b)))

    def chosen(left: Column) -> Column:
        slotted = F.transform(left, lambda b: F.struct(b["text"].alias("text"), b["out"].alias("out"), _slot(b["path"], F.col("skeleton")).alias("slot")))

        def both(found: Column) -> Column:
            kept = F.filter(found, lambda b: (F.coalesce(F.array_contains("keep", b["slot"]), F.lit(False)) | F.coalesce(_within(b["slot"], F.col("wrap")) & ~F.array_contains("bad", b["slot"]), F.lit(False))) & ((b["out"] < 2) if lists else F.lit(True)))
            plain = F.filter(found, lambda b: ((b["out"] < 1) if lists else F.lit(True)) & ~F.coalesce(F.array_contains("bad", b["slot"]), F.lit(False)))
            return let(F.struct(kept.alias("kept"), plain.alias("plain")), lambda x: F.when((F.size(x["kept"]) > 0) & (2 * chars(x["kept"]) >= chars(x["plain"])), x["kept"]).otherwise(x["plain"]))

        return let(slotted, both)

    return named.select("id", "url", F.array_join(F.transform(chosen(F.col("left")), lambda b: b["text"]), "\n\n").alias("text"))
