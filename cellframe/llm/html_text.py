"""Main text of web pages by site template removal.

Every page is parsed into element subtrees, and each subtree gets a hash of its tags and texts. Spark counts per host
on how many different pages a subtree occurs; copies of one page count once. A subtree that recurs on many pages of its
host is the site's template and is deleted from all of them. How many that are is a number of pages, however large the
host; only short text must recur on a share of its pages besides. What never is part of an article goes by its element,
role, class or id: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments.

An article (or else a main element) is a hint: if it holds more than half of the text that is left by that, the page's
text is what lies in it. Otherwise it is an element like others. Inside it the counts decide too, with higher bounds:
text elements (paragraphs, headings, list items …) go only if they are long, since short sentences recur.

Each page meets only its own subtrees' templates, joined by host and subtree, so a host with many of them costs its
pages nothing. Templates are broadcast if their counted number allows, and so are the pages' lists.

White space in a block becomes one space, blocks are joined by ``\\n``; ``<br>`` is white space. Defined cases: null and
empty html give an empty text; markup that is cut off or badly nested is closed where it ends; a null url (or one
without a host) belongs to the host '' ; repeated pages give a row each; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.shared import BROADCAST_ROWS, keep, small, table
from cellframe.llm.url_filter import host_of

#: A subtree outside an article is a template from so many pages on, and short text from this share of the host's pages on.
PAGES, SHARE = 3, 0.1
#: And so is one inside an article.
INNER_PAGES, INNER_SHARE = 5, 0.5
#: Long text inside an article is one from so many pages on, too; a text element there must be long.
INNER_MANY = 100
#: Text from so many characters on is long.
LONG = 40

# fixed values: names of HTML elements
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "select", "title")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav header footer aside form button dialog menu fieldset label".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
    "sup time tt u var br wbr img".split()
)
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption".split()) | INLINE
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: An opening tag ends an open element of these, up to the nearest of the second group.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar sidebars nav navbar "
    "navigation menu menus breadcrumb breadcrumbs footer header masthead comment comments commentlist respond replies "
    "disqus social share sharing related recommended widget widgets toolbar pagination pager skip".split()
)
_piece = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_attribute = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def never_by(attributes: str) -> bool:
    """Whether class, id or role name something that is no part of an article."""
    for name, *values in _attribute.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() == "role":
            if value.strip().lower() in NEVER_ROLES:
                return True
        elif any(w.lower() in NEVER_WORDS for w in _word.findall(value)):
            return True
    return False


class Page:
    """A page as elements (in order of their opening) and text blocks, each block with the elements it lies in."""

    def __init__(self, source: str):
        self.tag, self.parent, self.never, self.digest = [""], [-1], [False], [0]
        self.own, self.size = [0], [0]  # characters of an element itself, and with what lies in it
        self.blocks: list[tuple[list[tuple[int, str]], int]] = []  # (element, piece of text) of a block
        self._parts: list[list] = [[]]
        self._open = [0]
        self._block: list[tuple[int, str]] = []
        at = 0
        for m in _piece.finditer(source):
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            if m[3]:
                name = m[3].lower()
                if m[2]:
                    self._end(name)
                else:
                    self._start(name, m[4])
        self._text(source[at:])
        self._flush()
        while self._open:
            self._close()

    def _text(self, raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            self._block.append((self._open[-1], text))
            self._parts[-1].append(text)
            self.own[self._open[-1]] += len("".join(text.split()))

    def _flush(self) -> None:
        if self._block:
            self.blocks.append(self._block)
            self._block = []

    def _close(self) -> None:
        node, parts = self._open.pop(), self._parts.pop()
        if self.tag[node] not in INLINE:
            self._flush()
        text = " ".join("".join(p if isinstance(p, str) else f" \1{p} " for p in parts).split())
        self.digest[node] = xxhash.xxh3_64_intdigest(f"{self.tag[node]}\2{text}".encode("utf-8", "replace")) if text else 0
        self.size[node] += self.own[node]
        if self._parts:
            self.size[self._open[-1]] += self.size[node]
            if self.digest[node]:
                self._parts[-1].append(self.digest[node])

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            self._close()

    def _start(self, name: str, attributes: str) -> None:
        stack = self._open
        if name == "br":
            return self._text(" ")
        if name in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[depth]]
                if tag == "p":
                    self._close_to(depth)
                    break
                if tag not in INLINE:
                    break
        elif name in ENDS:
            ends, until = ENDS[name]
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[depth]]
                if tag in ends:
                    self._close_to(depth)
                    break
                if tag in until:
                    break
        if name not in INLINE:
            self._flush()
        if name in VOID:
            return None
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.never.append(name in NEVER or ("=" in attributes and never_by(attributes)))
        self.digest.append(0)
        self.own.append(0)
        self.size.append(0)
        stack.append(len(self.tag) - 1)
        self._parts.append([])
        return None

    def _end(self, name: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[depth]] == name:
                return self._close_to(depth)
        if name not in INLINE:
            self._flush()
        return None

    def _above(self, marked: list[bool]) -> list[bool]:
        """For each element, whether it or an element around it is marked."""
        out = []
        for node, parent in enumerate(self.parent):
            out.append(marked[node] or (parent >= 0 and out[parent]))
        return out

    def _place(self, articles: list[int]) -> tuple[list[bool], list[bool]]:
        """For each element: whether it is excluded by name, and whether it lies in one of the articles."""
        holds = [False] * len(self.tag)
        outside = self._above(self.never)
        # around an article, a class name says nothing
        for i in articles:
            node = i
            while node >= 0 and not holds[node]:
                holds[node] = True
                node = self.parent[node]
        never = [n and not (h and t not in ("nav", "header", "footer", "aside", "form")) for n, h, t in
                 zip(self.never, holds, self.tag)]
        excluded = self._above(never) if never != self.never else outside
        own = [False] * len(self.tag)
        for i in articles:
            own[i] = not excluded[i]
        return excluded, self._above(own)

    def place(self, outer: frozenset[int] | set[int] = frozenset(),
              inner: frozenset[int] | set[int] = frozenset()) -> tuple[list[bool], list[bool]]:
        """For each element: whether it is left out, by name or as a template, and whether it lies in the page's article.

        ``outer`` are the templates outside an article, ``inner`` those inside.
        """
        for name in ("article", "main"):
            articles = [i for i, t in enumerate(self.tag) if t == name and not self.never[i]]
            if articles:
                excluded, inside = self._place(articles)
                gone = self._gone(excluded, inside, outer, inner)
                left = [0, 0]
                for own, g, i in zip(self.own, gone, inside):
                    left[i] += 0 if g else own
                if left[1] > left[0]:
                    return gone, inside
        excluded, inside = self._place([])
        return self._gone(excluded, inside, outer, inner), inside

    def _gone(self, excluded: list[bool], inside: list[bool], outer: frozenset[int] | set[int],
              inner: frozenset[int] | set[int]) -> list[bool]:
        out = []
        for e, d, i, parent in zip(excluded, self.digest, inside, self.parent):
            # what lies around an article does not take it along
            above = parent >= 0 and out[parent] and inside[parent] == i
            out.append(e or above or d in (inner if i else outer))
        return out

    def candidates(self) -> list[tuple[int, bool, bool, bool]]:
        """Subtrees that may be templates: hash, whether it lies inside the article, is a text element, is long."""
        excluded, inside = self.place()
        found: dict[int, tuple[int, bool, bool, bool]] = {}
        for i in range(1, len(self.tag)):
            d = self.digest[i]
            # the article itself is no template, however many pages carry it
            whole = self.tag[i] in ("html", "body", "main") or (self.tag[i] == "article" and inside[i])
            if d and not excluded[i] and not whole:
                within = inside[i] and (d not in found or found[d][1])
                found[d] = d, within, self.tag[i] in TEXT, self.size[i] >= LONG
        return list(found.values())

    def text(self, outer: frozenset[int] | set[int], inner: frozenset[int] | set[int] = frozenset()) -> str:
        gone, inside = self.place(outer, inner)
        only_inside = any(inside)
        out = []
        for block in self.blocks:
            pieces = [t for node, t in block if not gone[node] and (inside[node] or not only_inside)]
            text = " ".join("".join(pieces).split())
            if text:
                out.append(text)
        return "\n".join(out)

    def fingerprint(self) -> int:
        """Of all text of the page: copies of a page under other addresses share it."""
        return self.digest[0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def subtrees(pages: DataFrame) -> DataFrame:
    """Each page's candidate subtrees, and a row with a null subtree per page.

    ``source`` is the hash of the html, ``page`` that of its text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, key, source in zip(batch["host"], batch["source"], batch["html"]):
                page = Page(source or "")
                name = _signed(page.fingerprint())
                rows.append((host, key, name, None, None, None, None))
                rows += [(host, key, name, _signed(d), *kind) for d, *kind in page.candidates()]
            columns = list(zip(*rows)) or [()] * 7
            yield pd.DataFrame({
                "host": columns[0], "source": columns[1], "page": columns[2], "subtree": pd.array(columns[3], "Int64"),
                **{n: pd.array(c, "boolean") for n, c in zip(("inside", "is_text", "is_long"), columns[4:])},
            })

    return pages.select("host", "source", "html").mapInPandas(
        run, "host long, source long, page long, subtree long, inside boolean, is_text boolean, is_long boolean")


def templates(found: DataFrame) -> DataFrame:
    """(host, subtree, outer, inner): what recurs on many different pages of a host, outside an article or inside."""
    counted = keep(
        found.groupBy("host", "page", "subtree")
        .agg(F.min("inside").alias("inside"), F.max("is_text").alias("is_text"), F.max("is_long").alias("is_long"))
        .groupBy("host", "subtree").agg(
            F.count("page").alias("n"), F.count_if(~F.col("inside")).alias("n_outside"),
            F.max("is_text").alias("is_text"), F.max("is_long").alias("is_long"))
    )
    of_host = counted.where("subtree IS NULL").select("host", F.col("n").alias("pages"))
    outer = f"n_outside >= {PAGES} AND (is_long OR n_outside >= {SHARE} * pages)"
    inner = (
        f"n >= {INNER_PAGES} AND (is_long OR NOT is_text) "
        f"AND (n >= {INNER_SHARE} * pages OR is_long AND n >= {INNER_MANY})"
    )
    return (
        counted.where(f"subtree IS NOT NULL AND n >= {PAGES}").join(of_host, "host")
        .select("host", "subtree", F.expr(outer).alias("outer"), F.expr(inner).alias("inner"))
        .where("outer OR inner")
    )


def extract(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS // 4) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    hosted = pages.select("page_id", "url", "html", F.xxhash64(F.expr(host_of("url"))).alias("host"),
                          F.xxhash64("html").alias("source"))
    found = keep(subtrees(hosted))
    recurring = small(keep(templates(found)), broadcast_rows)
    per_page = keep(
        found.select("host", "source", "subtree").join(recurring, ["host", "subtree"]).groupBy("host", "source").agg(
            F.collect_set(F.when(F.col("outer"), F.col("subtree"))).alias("outer"),
            F.collect_set(F.when(F.col("inner"), F.col("subtree"))).alias("inner"))
    )
    total = per_page.agg(F.sum(F.size("outer") + F.size("inner"))).first()[0] or 0
    per_page = F.broadcast(per_page) if total <= broadcast_rows else per_page

    def known(subtrees_) -> set[int]:
        return set() if subtrees_ is None else set(np.asarray(subtrees_).astype(np.uint64).tolist())

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([Page(source or "").text(known(o), known(i)) for source, o, i in zip(*batch)], dtype=object)

    text_of = F.pandas_udf(run, "string")
    joined = hosted.join(per_page, ["host", "source"], "left").withColumn("text", text_of("html", "outer", "inner"))
    return joined.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
