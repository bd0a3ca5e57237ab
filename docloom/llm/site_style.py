"""Main text of web pages by a site style tree.

The pages of a host are laid over each other: elements that are reached by the same path of
presentations (tag, class, id) are one node of the host's tree. For each node the tree knows in how
many pages it occurs, how its presentation varies (the sequence of its children's presentations) and
how its content varies (the text below it). Variation is measured as entropy, from 0 if all pages have
the same to 1 if no two have; the importance of a node is a weighted mean of the two. A branch that
occurs in ``least_pages`` pages and has an importance below ``low`` is left out of each of its pages, unless it lies
in an article or main or holds one. Pages of a host with the same text count once, so copies are no evidence.

Some presentations tell what a branch is before any counting, and keep or lose it on every page:
``main`` holds the text where a page has one, and so do articles that hold most of what is left of a page, while
menus, page headers, footers, side bars, notices, adverts, forms and reader comments are never text. That matters because adverts and
menus that differ from page to page are as varied as articles, and a copied article as uniform as a
footer. Classes and ids are read by whole names, or compounds of names and words of form (``ad-box``, but not
``no-ads``). They never take a heading or paragraph of an article, nor a branch with a main, or whose articles hold more
text than those outside of such branches. Paragraphs, headings and lists of the text are never dropped for being alike.

Statistics are counted by host, node and hash with partial sums, so a host with a third of all pages is
counted by all tasks. A page meets only the low nodes that it contains itself.

Defined cases: null or empty html has an empty text. Pages with a null id or without a host in their
url are judged by presentation alone. Broken markup is read to its end, an element that is never closed ends with
its parent. Rows that share an id share their low nodes. Only the three named columns are read. An empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import narrow

LEAST_PAGES = 5
LOW = 0.25
CONTENT_WEIGHT = 0.9

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html td th tr tbody thead tfoot option optgroup title legend".split())
# An element on the left ends an open one on the right that is its nearest within the given bounds.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NEVER_TEXT = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input map math menu nav noscript object script select "
    "style svg template textarea title video".split()
)
NEVER_TEXT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NEVER_TEXT_NAMES = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promoted related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
# What may stand beside such a name in a compound: where or in which form, not what else there is.
FORM_NAMES = frozenset(
    "area bar block body bottom box btn button buttons col column container div form group head holder icon icons inner item items "
    "left link links list outer pane panel right row section slot small text title top unit wrap wrapper".split()
)
REMARKS = frozenset("comment comments disqus replies reply".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
# Containers that carry no meaning of their own: only these are dropped for a low importance.
PLAIN = frozenset("div section span table ul ol dl figure center details fieldset".split())

_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=100_000)
def _named(names: str) -> frozenset[str]:
    """The names of what is never text among a list of classes: whole ones, or in compounds with words of form."""
    found = set()
    for token in names.split():
        words = [token.lower()]
        if words[0] not in NEVER_TEXT_NAMES:
            words = [w.lower() for w in _NAME.findall(token)]
        if all(w in NEVER_TEXT_NAMES or w in FORM_NAMES for w in words):
            found.update(NEVER_TEXT_NAMES.intersection(words))
    return frozenset(found)


class Page(HTMLParser):
    """The elements of a page, in order: parents, tags, presentations, verdicts and text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.style, self.never = [-1], ["#page"], ["#page"], [False]
        self.root = [False]  # article or main, outside of what is never text
        self.inside = [False]  # within such a root
        self.named = [False]  # never text by its own class or id alone
        self._remarks = [False]  # within what is named as readers' comments
        self.items: list[tuple[int, str | None]] = []  # (element, text), or (element, None) where a block begins or ends
        self._open = [0]
        self.feed(html)
        self.close()
        self._judge_names()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.items.append((self._open[-1], " "))
            return
        if tag in CLOSES_PARAGRAPH:
            self._end({"p"}, {"td", "th", "div", "article", "section", "blockquote", "li", "body", "button", "object"})
        if tag in SIBLINGS:
            self._end(*SIBLINGS[tag])
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        up = self._open[-1]
        inside = self.inside[up]
        never = (
            self.never[up]
            or tag in NEVER_TEXT
            or "hidden" in given
            or (given.get("role") or "").lower() in NEVER_TEXT_ROLES
            or tag == "header"
            and not inside
        )
        found = _named(names) if names != " " and tag not in ("html", "body", "main") else frozenset()
        remarks = self._remarks[up] or not REMARKS.isdisjoint(found)
        main = tag == "main" or given.get("role") == "main"
        me = len(self.parent)
        # Each reader's comment may be an article.
        root = not never and (main or tag == "article" and not found and not remarks)
        self.parent.append(up)
        self.tag.append(tag)
        self.style.append(f"{tag}.{_DIGITS.sub('0', names.strip())}")
        self.never.append(never)
        self.root.append(root)
        self.inside.append(inside or root)
        self.named.append(bool(found) and not main and not (inside and tag in HEADINGS))
        self._remarks.append(remarks)
        if tag in BLOCKS:
            self.items.append((me, None))
        if tag not in VOID:
            self._open.append(me)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an element of HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" or tag not in VOID:
            self._end({tag}, {"td", "th", "table"} if tag not in ("table", "html", "body", "tr", "tbody", "thead", "tfoot") else set())

    def handle_data(self, data: str) -> None:
        self.items.append((self._open[-1], data))

    def _end(self, tags: set[str], bounds: set[str]) -> None:
        """Close the nearest open element of ``tags`` with all in it, unless one of ``bounds`` is nearer."""
        for i in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[i]]
            if tag in tags:
                for e in reversed(self._open[i:]):
                    if self.tag[e] in BLOCKS:
                        self.items.append((self.parent[e], None))
                del self._open[i:]
                return
            if tag in bounds:
                return

    def keys(self) -> list[int]:
        """The node of the style tree of each element: a hash of its path of presentations."""
        keys = [0]
        for e in range(1, len(self.parent)):
            keys.append(xxhash.xxh3_64_intdigest(f"{keys[self.parent[e]]:x}/{self.style[e]}") - (1 << 63))
        return keys

    def _holding(self, roots: list[bool]) -> list[bool]:
        """Which elements are one of ``roots`` or hold one."""
        holds = list(roots)
        for e in range(len(self.parent) - 1, 0, -1):
            if holds[e]:
                holds[self.parent[e]] = True
        return holds

    def _judge_names(self) -> None:
        """Lose the named branches, but not what holds a main, or articles with more text than there is in those outside."""
        if not any(self.named):
            return
        holds = self._holding(self.root)
        spared = set()
        if any(n and h for n, h in zip(self.named, holds)):
            mains = self._holding([r and t != "article" for r, t in zip(self.root, self.tag)])
            top = [0] * len(self.parent)  # the outermost named branch around
            for e in range(1, len(self.parent)):
                top[e] = top[self.parent[e]] or (e if self.named[e] else 0)
            held = [0] * len(self.parent)
            for e, text in self.items:
                if text is not None and self.inside[e] and not self.never[e]:
                    held[top[e]] += len(text.strip())
            spared = {e for e, h in enumerate(holds) if h and (mains[e] or held[top[e]] > held[0])}
        for e in range(1, len(self.parent)):
            if self.named[e] and e not in spared:
                self.never[e] = True
            if self.never[self.parent[e]]:
                self.never[e] = True
            if self.never[e]:
                self.root[e] = self.inside[e] = False

    def _plain(self) -> list[bool]:
        """Which elements may go for a low importance: plain ones that neither lie in an article or main nor hold one."""
        holds = self._holding(self.root)
        return [t in PLAIN and not (n or i or h) for t, n, i, h in zip(self.tag, self.never, self.inside, holds)]

    def branches(self) -> list[tuple[int, int, int]]:
        """``(node, presentation, content)`` hashes of the plain branches that may go, one for each node."""
        plain = self._plain()
        if not any(plain):
            return []
        shapes: list[list[str]] = [[] for _ in self.parent]
        texts: list[list[str]] = [[] for _ in self.parent]
        for e in range(1, len(self.parent)):
            above = shapes[self.parent[e]]
            if not above or above[-1] != self.style[e]:
                above.append(self.style[e])
        # The nearest plain element gets the text; what lies in several plain ones moves up as a hash.
        nearest = [0] * len(self.parent)
        for e in range(1, len(self.parent)):
            nearest[e] = e if plain[e] else nearest[self.parent[e]]
        for e, text in self.items:
            if text is not None and nearest[e] and not text.isspace():
                texts[nearest[e]].append(text)
        keys, found = self.keys(), {}
        for e in range(len(self.parent) - 1, 0, -1):
            if plain[e]:
                content = xxhash.xxh3_64_hexdigest("\x1f".join(texts[e]))
                texts[nearest[self.parent[e]]].append(content)
                shape, text = found.get(keys[e], ("", ""))
                found[keys[e]] = (shape + "|" + "/".join(shapes[e]), text + "|" + content)
        return [
            (k, xxhash.xxh3_64_intdigest(s) - (1 << 63), xxhash.xxh3_64_intdigest(t) - (1 << 63)) for k, (s, t) in found.items()
        ]

    def _rooted(self, out: list[bool]) -> bool:
        """Whether the articles hold the text: a main with any, or most of what is not ``out``."""
        if not any(self.root):
            return False
        main = list(self.root)  # within a main, or an element with its role
        for e in range(1, len(main)):
            main[e] = main[self.parent[e]] or main[e] and self.tag[e] != "article"
        within = beside = 0
        for e, text in self.items:
            if text is not None and not out[e] and not text.isspace():
                if main[e]:
                    return True
                if self.inside[e]:
                    within += len(text.strip())
                else:
                    beside += len(text.strip())
        return within > beside

    def text(self, low: set[int]) -> str:
        """The blocks of the text, without the branches whose node is in ``low``."""
        keys, plain = (self.keys(), self._plain()) if low else ([], [])
        out = [False] * len(self.parent)
        for e in range(1, len(self.parent)):
            out[e] = out[self.parent[e]] or self.never[e] or bool(low and plain[e] and keys[e] in low)
        rooted = self._rooted(out)
        blocks: list[str] = []
        parts: list[str] = []
        for e, text in [*self.items, (0, None)]:
            if text is None:
                block = " ".join("".join(parts).split())
                if block:
                    blocks.append(block)
                parts = []
            elif not out[e] and (self.inside[e] or not rooted):
                parts.append(text)
        return "\n\n".join(blocks)


def host_of(url: str | None) -> str | None:
    try:
        return (urlsplit(url or "").hostname or None) and urlsplit(url or "").hostname.lower()
    except ValueError:
        return None


def _branches(pages: DataFrame) -> DataFrame:
    """``(page_id, host, page, node, presentation, content)`` of the plain branches of every page; ``page`` is a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hosts, rows = [], [], []
            for i, (url, html) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())):
                host = host_of(url)
                page = Page(html) if host and html else None
                found = page.branches() if page else []
                if found:
                    whole = xxhash.xxh3_64_intdigest(page.text(set())) - (1 << 63)
                    at += [i] * len(found)
                    hosts += [host] * len(found)
                    rows += [(whole, *f) for f in found]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").take(pa.array(at, pa.int64())), pa.array(hosts, pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
                ["page_id", "host", "page", "node", "presentation", "content"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return pages.mapInArrow(run, f"page_id {kind}, host string, page long, node long, presentation long, content long")


def importance(branches: DataFrame) -> DataFrame:
    """``(host, node, pages, importance)`` of the nodes of all style trees."""

    def entropy(column: str) -> DataFrame:
        each = branches.groupBy("host", "node", column).agg(F.count("*").alias("c"))
        sums = each.groupBy("host", "node").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.log("c")).alias("s"))
        # -sum(p log p) = log m - (sum c log c) / m, as a share of its maximum log m.
        share = F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log("m"))).otherwise(1.0)
        return sums.select("host", "node", F.col("m").alias("pages"), share.alias(column))

    both = entropy("content").join(entropy("presentation").drop("pages"), ["host", "node"])
    weighted = CONTENT_WEIGHT * F.col("content") + (1 - CONTENT_WEIGHT) * F.col("presentation")
    return both.select("host", "node", "pages", weighted.alias("importance"))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, low: float = LOW, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    rows = narrow(pages, page_id=key, url=url, html=html)
    branches = _branches(rows)
    # Copies may still differ in adverts and the like: the least of their hashes stands for all.
    least = branches.groupBy("host", "page", "node").agg(F.min(F.struct("presentation", "content")).alias("least"))
    distinct = least.select("host", "node", "least.presentation", "least.content")
    unimportant = importance(distinct).where((F.col("pages") >= least_pages) & (F.col("importance") < low)).select("host", "node")
    own = branches.select("page_id", "host", "node").join(unimportant, ["host", "node"], "left_semi")
    lows = own.groupBy(F.col("page_id").alias("_id")).agg(F.collect_set("node").alias("_low"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(h).text(set(n or ())) if h else "" for h, n in zip(batch.column("html").to_pylist(), batch.column("_low").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    met = rows.join(lows, rows["page_id"] == lows["_id"], "left").select("page_id", "url", "html", "_low")
    return met.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
