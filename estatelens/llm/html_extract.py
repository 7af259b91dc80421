"""Main text of web pages by equivalence-class template deduction.

A page is read once, in Arrow batches, into blocks (text between block-level
boundaries, with the slot it stands in: the chain of container elements with
their marks and places among like siblings) and template tokens. A token is a container's chain or a block's
text in its slot. Over the pages of a host the occurrence vector of a token
(how often on which page) is folded into a hash; tokens with equal vectors form
an equivalence class. Tokens of a class that come in one order on all its pages,
each in one slot of the host's widest class, make it valid if it has enough words
and elements and varying text stands beside it. The texts of valid classes
are the template, on pages with and without an article element, and the
slots between them hold what varies. Then elements and marks refine:

* dropped: slots under menus, headers, footers, sidebars, notices, adverts, forms
  and reader comments, by element, role or mark; a mark or form around
  most of the page, or around its only article, is ignored;
* if a page has an article (or main) element, only its slots are main text; if
  template text is the greater part of it, the page varies too little and all of it stays;
* otherwise slots that are mostly links on the host go.

A page counts in vectors by its text that elements and marks leave, so copies
with other adverts or menus are one page and make no template.

Statistics are sums per (host, token), so a host with a third of all pages is
split by token, and only dropped tokens and slots come back to a page.

Defined results: null or empty html and pages without main text give an empty
text; a url without a host makes a host of its own; unclosed and truncated
markup is closed where it ends; rows are kept apart even if page_id repeats.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import prepare, scratch

#: A class is part of a template if it occurs on this many distinct pages and this share of its host's pages, distinct and all.
MIN_PAGES = 4
MIN_SHARE = 0.5
#: Words and elements a class has at least.
MIN_SIZE = 3
#: Share of an article's characters that has to be left without template text.
LEFT_SHARE = 0.5
#: Parts of a host's common token in joins.
SALTS = 16
#: Share of a slot's characters that stand in links, over the host, from which it is a menu.
LINK_SHARE = 0.6

TAG = re.compile(r"<!--(?:.*?-->|.*+\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
#: One attribute: a name bounded by white space, = or /, and its whole value, so nothing inside a value is taken for a name.
ATTRIBUTE = re.compile(r"([^\s=>/\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?|[\"'/=]", re.S)
#: Elements whose content is never text.
SILENT = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "title", "select", "audio", "video"}
#: Of these the content is raw: only their own end tag ends them.
RAW = {"script", "style", "noscript", "textarea", "iframe", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Containers form the chain of a slot.
CONTAINERS = {"html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table", "figure",
              "details", "dialog", "menu", "fieldset", "blockquote", "button"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "pre", "hr",
                       "address", "figcaption", "summary", "legend", "option", "center", "hgroup", "search"}
BOILERPLATE = {"nav", "footer", "aside", "menu", "dialog", "button", "search"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar"}
#: Elements (and a role) that count like a mark: boilerplate, unless they hold most of the page.
FORMS = {"form", "fieldset"}
#: Words of a class or id that mark boilerplate.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "side",
         "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "foot", "comment", "comments",
         "disqus", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal",
         "overlay", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "widget", "pagination",
         "pager", "toolbar", "skip", "copyright", "disclaimer", "form", "search"}
#: Words of a class or id that say where or what a part is, not what it is about.
PLAIN = {"area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "cell", "col", "column", "container", "content", "count", "div",
         "fixed", "grid", "group", "icon", "icons", "inner", "item", "items", "js", "label", "large", "left", "link", "links", "list", "main", "meta", "mid",
         "module", "outer", "page", "pane", "panel", "posts", "primary", "region", "right", "row", "section", "secondary", "site", "slot", "small", "sticky",
         "text", "title", "top", "unit", "wrap", "wrapper", "zone"}
COMMENTS = {"comment", "comments", "disqus", "replies", "reply", "respond"}
#: Words beside "header" that make it the head of a text.
HEADED = {"article", "entry", "post", "story"}
#: A class that says what a layout has or lacks marks nothing.
LAYOUT = re.compile(r"(?:has|no|not|with|without)[-_]")
#: Share of the page's characters from which a container's mark is ignored; reader comments often hold most of a page.
MOST, MOST_COMMENTS = 0.5, 0.9
MAIN = {"article", "main"}
#: Blocks that are no containers are looked at only for their own marks, and become containers if those mark boilerplate.
MARKED = {"p", "li", "dt", "dd", "tr", "td", "th", "pre", "address", "center", "figcaption"}
#: Words that say little on such a small block.
WEAK = {"side", "header", "foot", "form", "search", "share", "related", "banner"}
#: A block of the first kind ends where one of the others starts.
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}
WORD = re.compile(r"[a-z]+")


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or url or "").lower()
    except ValueError:
        return url or ""


class State(NamedTuple):
    """What the open elements say: boilerplate for certain, inside an article, innermost marked container (-1: none)."""

    out: bool = False
    main: bool = False
    marked: int = -1


class Marked(NamedTuple):
    """A container that a mark calls boilerplate: the marked one around it, whether it stands in an article, is for comments."""

    above: int
    in_main: bool
    comments: bool


class Page:
    """Blocks (slot, text, characters in links, verdict) of one page; verdict: 1 main, -1 boilerplate, 0 open.

    Marks are judged when the page is read: one on a container that holds most
    of the page, outside of articles and not mostly links, says nothing.
    """

    def __init__(self, source: str):
        self.found: list[tuple[str, str, int, State]] = []
        self.marked: list[Marked] = []
        self.chains: list[tuple[str, int]] = []
        self.places: list[int] = []                                   # of blocks among blocks and chains
        self.open: list[tuple[str, str, State, Counter]] = []         # element, chain, state, containers seen inside
        self.top: Counter = Counter()
        self.text: list[str] = []
        self.linked = self.links = 0
        self.silent: dict[str, dict[int, int]] = {}
        self.read(source)
        self.blocks = [(c, t, n, v) for (c, t, n, _), v in zip(self.found, self.verdicts())]

    def end_block(self) -> None:
        t = " ".join("".join(self.text).split())
        if t:
            _, chain, state, _ = self.open[-1] if self.open else ("", "", State(), None)
            self.places.append(len(self.found) + len(self.chains))
            self.found.append((chain, t, min(self.linked, len(t)), state))
        self.text, self.linked = [], 0

    def add(self, raw: str) -> None:
        t = html.unescape(raw)
        self.text.append(t)
        if self.links:
            self.linked += len(t)

    def mark(self, name: str, attributes: str) -> tuple[str, State]:
        """Name with its class and id, and the state inside the element."""
        found: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(attributes):
            if m[1]:                                                  # of attributes of one name the first counts
                found.setdefault(m[1].lower(), next((html.unescape(x) for x in m.groups()[1:] if x is not None), ""))
        label = name + "".join(f".{x}" for x in found.get("class", "").lower().split()) + (f"#{found['id'].lower()}" if found.get("id") else "")
        names = [WORD.findall(x) for x in f"{found.get('class', '')} {found.get('id', '')}".lower().split() if not LAYOUT.match(x)]
        # a name marks only if it says nothing else: social-links does, social-policy does not
        words = {w for x in names if all(w in MARKS or w in COMMENTS or w in HEADED or w in PLAIN for w in x) for w in x}
        above = self.open[-1][2] if self.open else State()
        if above.out:
            return label, above
        hidden = found.get("hidden", "until-found").lower() != "until-found" or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I)
        role = found.get("role", "").lower()
        if hidden or name in BOILERPLATE or role in ROLES:
            return label, above._replace(out=True)
        if name in ("html", "body"):
            return label, above
        if name in MAIN:
            return label, self.under_mark(above, words) if words & {"comment", "comments", "reply", "replies"} else above._replace(main=True)
        if name == "header" and not above.main:
            return label, above._replace(out=True)
        marks = words & (MARKS - WEAK if name in MARKED else MARKS)
        if "header" in marks and (name == "header" or above.main or words & HEADED):
            marks -= {"header"}
        return label, self.under_mark(above, words) if marks or name in FORMS or role == "form" else above

    def under_mark(self, above: State, words: set[str]) -> State:
        self.marked.append(Marked(above.marked, above.main, bool(words & COMMENTS)))
        return above._replace(marked=len(self.marked) - 1)

    def verdicts(self) -> list[int]:
        size, linked = [0] * len(self.marked), [0] * len(self.marked)
        total = 0
        for _, t, n, s in self.found:
            if not s.out:
                total += len(t)
                if s.marked >= 0:
                    size[s.marked] += len(t)
                    linked[s.marked] += n
        for k in range(len(self.marked) - 1, -1, -1):              # a container comes after the one around it
            if (up := self.marked[k].above) >= 0:
                size[up] += size[k]
                linked[up] += linked[k]
        free = any(s.main and not s.out and s.marked < 0 for *_, s in self.found)   # then marks hide no article
        ignored, weak = [], []                                      # by the container and all marked ones around it
        for m, n, inside in zip(self.marked, size, linked):
            most = n > (MOST_COMMENTS if m.comments else MOST) * total and inside <= LINK_SHARE * n and not m.in_main and not free
            ignored.append(most and (m.above < 0 or ignored[m.above]))
            weak.append(most or not m.in_main and not m.comments and (m.above < 0 or weak[m.above]))
        got = [-1 if s.out or s.marked >= 0 and not ignored[s.marked] else int(s.main) for *_, s in self.found]
        if 1 not in got:                                            # an article under marks, if it has more text than what stands free
            under = {k for k, (*_, s) in enumerate(self.found) if s.main and not s.out and weak[s.marked]}
            if sum(len(self.found[k][1]) for k in under) >= sum(len(x[1]) for x, v in zip(self.found, got) if v == 0):
                got = [1 if k in under else v for k, v in enumerate(got)]
        return got

    def silent_end(self, name: str, start: int, source: str) -> int | None:
        """Where the silent element that starts here ends; each end tag ends the last one open. None: never."""
        if name not in self.silent:
            ends, still = {}, []
            for m in re.finditer(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", source, re.I):
                if not m[1] and not m[0].endswith("/>"):
                    still.append(m.start())
                elif m[1] and still:
                    ends[still.pop()] = m.end()
            self.silent[name] = ends
        return self.silent[name].get(start)

    def close(self, name: str) -> None:
        """End the innermost such element and what is open inside it; an end tag without a start ends nothing."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                del self.open[k:]
                return

    def close_marked(self, name: str) -> None:
        """The end tag of a small block ends the innermost one, if it stands open."""
        if self.open and self.open[-1][0] == name:
            self.open.pop()

    def read(self, source: str) -> None:
        at = 0
        while at < len(source):
            m = TAG.search(source, at)
            if not m:
                self.add(source[at:])
                break
            self.add(source[at:m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if name in SILENT:
                if m[1] or m[3].endswith("/"):
                    continue
                if name in RAW:
                    end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
                else:                                # left open: as if it were empty
                    at = self.silent_end(name, m.start(), source) or at
                continue
            if name == "br":
                self.text.append(" ")
            if name == "a":
                self.links = 0 if m[1] else 1
            if name in BLOCKS:
                self.end_block()
                self.links = 0
            if not m[1] and self.open and name in ENDS.get(self.open[-1][0], ()):
                self.open.pop()
            if name in CONTAINERS or name in MARKED and (m[1] or m[3]):
                above = self.open[-1][2] if self.open else State()
                label, state = ("", above) if m[1] else self.mark(name, m[3])
                if m[1]:
                    self.close_marked(name) if name in MARKED else self.close(name)
                elif name in CONTAINERS or state != above:
                    seen = self.open[-1][3] if self.open else self.top
                    seen[label] += 1
                    label += f"~{seen[label]}" * (seen[label] > 1)
                    chain = f"{self.open[-1][1]}/{label}" if self.open else label
                    self.open.append((name, chain, state, Counter()))
                    self.chains.append((chain, len(self.found) + len(self.chains)))
        self.end_block()


def token_hash(chain: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{chain}\0{text}") - (1 << 63)


PARSED = ("page_id bigint, url string, host string, content bigint, blocks array<struct<slot:bigint,token:bigint,at:int,n:int,size:int,words:int,text:string,linked:int,verdict:int>>, "
          "chains array<struct<token:bigint,at:int,n:int>>")


def parse(pages: DataFrame) -> DataFrame:
    """Blocks and container tokens of every page. n: occurrences, at the first of equal tokens of a page. Only blocks that may be main text keep it."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks, chains, contents = [], [], []
            for source in b.column(2).to_pylist():
                p = Page(source or "")
                tokens = [token_hash(c, t) for c, t, *_ in p.blocks]
                left = Counter(tokens)
                kept = int(any(v == 1 for *_, v in p.blocks))
                blocks.append([{"slot": token_hash("", c), "token": k, "at": at, "n": left.pop(k, 0), "size": len(t), "words": t.count(" ") + 1, "text": t if v == kept else None, "linked": n, "verdict": v}
                               for (c, t, n, v), k, at in zip(p.blocks, tokens, p.places)])
                left = Counter(c for c, _ in p.chains)
                chains.append([{"token": token_hash("", c), "at": at, "n": left.pop(c)} for c, at in p.chains if c in left])
                contents.append(token_hash("", "\n".join(t for _, t, _, v in p.blocks if v == kept)))
            hosts = [host(u) for u in b.column(1).to_pylist()]
            b_type = pa.list_(pa.struct([("slot", pa.int64()), ("token", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("size", pa.int32()), ("words", pa.int32()), ("text", pa.string()),
                                         ("linked", pa.int32()), ("verdict", pa.int32())]))
            c_type = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(blocks, b_type), pa.array(chains, c_type)],
                                             ["page_id", "url", "host", "content", "blocks", "chains"])
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, PARSED)


def tokens(parsed: DataFrame) -> DataFrame:
    """host, page, content, token, is_text, kept (a text that may be main text), words, n, at of every token of a page, once."""
    own = ["host", "page", "content"]
    block = (parsed.select(*own, F.explode("blocks").alias("b")).filter("b.n > 0")
             .select(*own, "b.token", F.lit(True).alias("is_text"), F.col("b.text").isNotNull().alias("kept"), "b.words", "b.n", "b.at"))
    chain = parsed.select(*own, F.explode("chains").alias("c")).select(*own, "c.token", F.lit(False).alias("is_text"), F.lit(False).alias("kept"), F.lit(1).alias("words"), "c.n", "c.at")
    return block.unionByName(chain)


def on_pages(rows: DataFrame, common: DataFrame) -> DataFrame:
    """``rows`` (with a page) joined with ``common`` by host and token; a token of a large host is split."""
    salt = F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int").alias("salt")
    salts = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.select("*", salt).join(salts, ["host", "token", "salt"]).drop("salt")


def template(parsed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_size: int = MIN_SIZE) -> DataFrame:
    """page, token: the template's texts on each page where they may be main text, from ``parsed`` with a ``page`` key.

    The occurrence vector of a token is folded into the xor of a hash of
    (content, count). Of a frequent class, tokens stay that have one place among
    the class's tokens on all pages and lie in one slot of the host's widest
    class; it is valid if these have ``min_size`` words and elements, and a token
    outside the template stands beside one of them on some page.
    """
    counts = tokens(parsed).groupBy("host", "token", "is_text", "words", "content").agg(F.sum("n").alias("n"), F.count("*").alias("pages"))
    vectors = counts.groupBy("host", "token", "is_text", "words").agg(F.count("*").alias("contents"), F.sum("pages").alias("pages"), F.bit_xor(F.xxhash64("content", "n")).alias("vector"))
    sizes = (parsed.groupBy("host", "content").agg(F.count("*").alias("copies")).groupBy("host")
             .agg(F.sum("copies").alias("host_pages"), F.count("*").alias("host_contents")))
    frequent = scratch(vectors.filter(F.col("contents") >= min_pages).join(sizes, "host")
                       .filter((F.col("pages") >= min_share * F.col("host_pages")) & (F.col("contents") >= min_share * F.col("host_contents")))
                       .select("host", "token", "vector", "contents", F.col("words").alias("size")), "classes")
    classes = frequent.groupBy("host", "vector").agg(F.max("contents").alias("contents"), F.sum("size").alias("size"))
    widest = classes.groupBy("host").agg(F.max_by("vector", F.struct("contents", "size", "vector")).alias("widest"))
    common = frequent.join(widest, "host").select("host", "token", "vector", "size", (F.col("vector") == F.col("widest")).cast("int").alias("widest"))
    found = on_pages(tokens(parsed).select("host", "page", "token", "is_text", "kept", "at"), common)
    by_place = Window.partitionBy("page").orderBy("at")
    beside = (F.col("at") - F.coalesce(F.lag("at").over(by_place), F.lit(-1)) > 1) | (F.lead("at").over(by_place) - F.col("at") > 1)
    placed = scratch(found.select("host", "page", "token", "is_text", "kept", "vector", "size", F.sum("widest").over(by_place).alias("slot"), beside.alias("beside"),
                                  F.row_number().over(Window.partitionBy("page", "vector").orderBy("at")).alias("place")), "placed")
    fixed = (placed.groupBy("host", "token", "is_text", "vector", "size").agg(F.min("place").alias("p0"), F.max("place").alias("p1"), F.min("slot").alias("s0"), F.max("slot").alias("s1"),
                                                                              F.bool_or("beside").alias("beside")).filter("p0 = p1 AND s0 = s1"))
    valid = fixed.groupBy("host", "vector").agg(F.sum("size").alias("total"), F.bool_or("beside").alias("frames")).filter((F.col("total") >= min_size) & F.col("frames"))
    texts = scratch(fixed.filter("is_text").join(valid, ["host", "vector"], "left_semi").select("host", "token"), "fixed")
    return on_pages(placed.filter("kept").select("host", "page", "token"), texts).select("page", "token")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    parsed = scratch(parse(pages).withColumn("page", F.monotonically_increasing_id()), "parsed")
    has_main = F.exists("blocks", lambda b: b["verdict"] == 1)
    # blocks on which only the host's slots can decide
    open_blocks = (parsed.filter(~has_main).select("host", "page", F.explode("blocks").alias("b")).filter("b.verdict = 0")
                   .select("host", "page", "b.slot", "b.size", "b.linked"))
    open_blocks = scratch(open_blocks, "open")
    menus = (open_blocks.groupBy("host", "slot").agg(F.sum("size").alias("size"), F.sum("linked").alias("linked"))
             .filter(F.col("linked") > LINK_SHARE * F.col("size")).select("host", "slot"))
    menu = open_blocks.join(scratch(menus, "menus"), ["host", "slot"], "left_semi").select("page", F.col("slot").alias("token"))
    # written first: its size decides whether the texts are shuffled
    dropped = scratch(template(parsed).unionByName(menu).groupBy("page").agg(F.collect_set("token").alias("dropped")), "dropped")
    candidates = F.transform(F.filter("blocks", lambda b: b["text"].isNotNull()), lambda b: F.struct(b["token"].alias("token"), b["slot"].alias("slot"), b["size"].alias("size"), b["text"].alias("text")))
    got = (parsed.select("page", "page_id", "url", has_main.alias("has_main"), candidates.alias("all")).join(dropped, "page", "left")
           .withColumn("dropped", F.coalesce("dropped", F.array().cast("array<bigint>"))))
    left = F.filter("all", lambda b: ~F.array_contains("dropped", b["token"]) & (F.col("has_main") | ~F.array_contains("dropped", b["slot"])))
    size = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda n, b: n + b["size"])
    keep = F.when(F.col("has_main") & (size("left") < LEFT_SHARE * size("all")), F.col("all")).otherwise(F.col("left"))
    text = F.array_join(F.transform(keep, lambda b: b["text"]), "\n")
    return got.withColumn("left", left).select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
