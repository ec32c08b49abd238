"""Main text of web pages, with site templates found by counting element subtrees per host.

A page is read once into a flat list of openings, texts and closings, in time
in proportion to its length and without recursion. Block subtrees (their tags
and texts) are hashed bottom up; Spark counts for each host on how many
different pages a subtree stands. Those on at least SHARE of the host's pages
(and LEAST pages) are its template. Pages whose whole text is the same count
once, so copies of an article do not turn it into a template.

The text is that of the article (else the main element, else the body) without
elements that are never main text by tag, role or whole class name. In it, the
host's template is deleted: containers outside an article, and link-heavy ones
inside; at MOST of the host's pages, also other containers of an article and
single blocks of a page without one, unless these make up most of the page's
text. Single paragraphs, headings, quotes and list items of an article stay,
however many articles of the host have them: a licence line is text.

Only pages with a subtree that the host's counts may delete meet the counts;
they carry the pieces of their text, and the hashes of these, to them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import hot_keys, looked_up
from .tasks import in_arrow, table, written

SHARE = 0.1
MOST = 0.5
LEAST = 3

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("aside details div dl fieldset figure footer form header menu nav ol section table ul".split())
#: A start tag of the key closes an open element of the values, up to the nearest of CLOSED_BY.
_P = ("p",)
CLOSES = {t: _P for t in "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()}
CLOSES |= {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody")}
SCOPE = frozenset("article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table td th ul".split())
#: Elements that are never main text.
DROP_TAGS = frozenset("aside audio button canvas datalist dialog footer form head iframe input map menu nav noframes noscript object script select style svg template textarea title video".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id names that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
DROP_WORDS = frozenset(
    """ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus footer gdpr header login
    masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion promoted related replies reply respond search share sharing sidebar
    signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split()
)
#: Words that may stand beside those in a name; any other word makes it a name of something else.
NEUTRAL_WORDS = frozenset("area bar block body bottom box buttons container content form global inner item items left link links list main meta page primary right section secondary site text thread top wrap wrapper".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: An element with so much of the text is not dropped by its name or as a form, but for comments.
WHOLE = 0.9
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_QUOTED_END = re.compile(r"[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

OPEN, TEXT, CLOSE = 0, 1, 2


def events(html: str) -> list[tuple]:
    """(OPEN, tag, attributes), (TEXT, text, None) and (CLOSE, tag, None), properly nested."""
    out: list[tuple] = []
    stack: list[str] = []
    times: dict[str, int] = {}
    # how often each tag is open below the innermost boundary of scope, that element included
    scopes: list[dict[str, int]] = [{}]
    at, n, quotes_hold = 0, len(html), True

    def close_top() -> str:
        tag = stack.pop()
        times[tag] -= 1
        if tag in SCOPE:
            scopes.pop()
        else:
            scopes[-1][tag] -= 1
        out.append((CLOSE, tag, None))
        return tag

    while at < n:
        i = html.find("<", at)
        if i < 0:
            out.append((TEXT, html[at:], None))
            break
        if i > at:
            out.append((TEXT, html[at:i], None))
        after = html[i + 1 : i + 2]
        if after == "!":
            if html.startswith("<!--", i):
                j = html.find("-->", i + 4)
                at = n if j < 0 else j + 3
            else:
                j = html.find(">", i)
                at = n if j < 0 else j + 1
            continue
        if after == "?":
            j = html.find(">", i)
            at = n if j < 0 else j + 1
            continue
        closing = after == "/"
        m = _NAME.match(html, i + 1 + closing)
        if not m:
            if closing:
                j = html.find(">", i)
                at = n if j < 0 else j + 1
            else:
                out.append((TEXT, "<", None))
                at = i + 1
            continue
        tag = m.group().lower()
        j = html.find(">", m.end())
        if j >= 0 and quotes_hold and (html.count('"', m.end(), j) % 2 or html.count("'", m.end(), j) % 2):
            end = _QUOTED_END.match(html, m.end())
            if end:
                j = end.end() - 1
            else:
                quotes_hold = False  # an open quote runs to the end: from here on a tag ends at the first >
        if j < 0:
            break
        inside, at = html[m.end() : j], j + 1
        if closing:
            if times.get(tag):
                while close_top() != tag:
                    pass
            elif tag in ("br", "p"):
                out.append((OPEN, "br", ""))
                out.append((CLOSE, "br", None))
            continue
        for other in CLOSES.get(tag, ()):
            # only an element with no scope boundary above it is closed; what stands in another scope stays open
            if scopes[-1].get(other):
                while close_top() != other:
                    pass
        out.append((OPEN, tag, inside))
        if tag in VOID or inside.endswith("/") and tag not in CONTAINERS and tag not in INLINE and tag not in CLOSES:
            out.append((CLOSE, tag, None))
        elif tag in RAW:
            k = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            end = html.find(">", k.end()) if k else -1
            at = n if end < 0 else end + 1
            out.append((CLOSE, tag, None))
        else:
            stack.append(tag)
            times[tag] = times.get(tag, 0) + 1
            if tag in SCOPE:
                scopes.append({tag: 1})
            else:
                scopes[-1][tag] = scopes[-1].get(tag, 0) + 1
    while stack:
        close_top()
    return out


def marked(name: str) -> str:
    """"comment", "other" or "": what a class or id says that its element is, by the words of each whole name."""
    found = ""
    for token in name.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        if words and any(w in DROP_WORDS for w in words) and all(w in DROP_WORDS or w in NEUTRAL_WORDS for w in words):
            found = "comment" if any(w in COMMENT_WORDS for w in words) else found or "other"
    return found


def unwanted(tag: str, inside: str) -> str:
    """"tag", "comment", "other" or "": whether tag and role, or class and id, say that the element is not main text."""
    if tag in DROP_TAGS:
        return "other" if tag == "form" else "tag"
    if not inside or tag in ("html", "body", "article", "main") and "comment" not in inside.lower():
        return ""
    found = ""
    for name, a, b, c in _ATTRIBUTE.findall(inside):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "tag"
        if name == "role" and value.lower() in DROP_ROLES:
            return "tag"
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return "tag"
        if name in ("class", "id"):
            found = max(found, marked(value), key=("", "other", "comment").index)
    return found


class Page:
    """A page's events with, for each element, its end, subtree hash, letters of text, and whether these are mostly links."""

    def __init__(self, html: str):
        self.events = events(html)
        n = len(self.events)
        self.end, self.hash, self.letters, self.links = [0] * n, [0] * n, [0] * n, [False] * n
        self.unwanted = [""] * n
        areas: dict[str, list[tuple[int, bool]]] = {"article": [], "main": []}
        stack: list[list] = []  # place, parts, letters, letters in links
        inside_link = inside_dropped = 0
        for i, (kind, x, more) in enumerate(self.events):
            if kind == OPEN:
                self.unwanted[i] = unwanted(x, more)
                if x == "article" or x == "main" or 'role="main"' in more:
                    if not self.unwanted[i]:
                        areas["article" if x == "article" else "main"].append((i, inside_dropped > 0))
                stack.append([i, [x], 0, 0])
                inside_link += x == "a"
                inside_dropped += self.unwanted[i] != "" and x != "form"
            elif kind == TEXT:
                if stack:
                    words = " ".join(x.split())
                    stack[-1][1].append(words)
                    stack[-1][2] += len(words)
                    stack[-1][3] += len(words) if inside_link else 0
            else:
                at, parts, letters, linked = stack.pop()
                inside_link -= x == "a"
                inside_dropped -= self.unwanted[at] != "" and x != "form"
                self.end[at], self.letters[at] = i, letters
                self.hash[at] = xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) & (2**63 - 1)
                self.links[at] = letters > 0 and 2 * linked > letters
                if stack:
                    stack[-1][1].append(str(self.hash[at]))
                    stack[-1][2] += letters
                    stack[-1][3] += linked
        # the outermost articles, else main elements; those in an aside or the like count if there are no others
        self.places: list[int] = []
        for found in areas.values():
            chosen = [i for i, dropped in found if not dropped] or [i for i, _ in found]
            last = -1
            for i in chosen:
                if i > last:
                    self.places.append(i)
                    last = self.end[i]
            if self.places:
                break

    def pieces(self, by_name: bool = True) -> tuple[list[tuple[str, int]], list[tuple[int, int, bool]]]:
        """(text, candidate or -1) in order, and the candidates: (hash, the candidate around it or -1, whether MOST decides).

        A candidate is a subtree that the host's counts may delete. by_name=False
        leaves elements in that only their class or id marks.
        """
        found, events = bool(self.places), self.events
        spans = [(i, self.end[i]) for i in self.places] if found else [(0, len(events) - 1)] if events else []
        whole = WHOLE * (sum(self.letters[i] for i in self.places) if found else sum(len(" ".join(x.split())) for kind, x, _ in events if kind == TEXT))
        out: list[tuple[str, int]] = []
        candidates: list[tuple[int, int, bool]] = []
        for begin, last in spans:
            i, headings = begin, -1  # headings: end of a header element of an article, of which the headings stay
            around: list[tuple[int, int]] = []  # (end, number) of the open candidates
            while i <= last:
                kind, x, more = events[i]
                while around and around[-1][0] < i:
                    around.pop()
                owner = around[-1][1] if around else -1
                if kind == OPEN:
                    if x not in INLINE:
                        out.append((" ", owner))
                    why = self.unwanted[i]
                    if why == "other":
                        # a wrapper of it all isn't what its name says
                        why = why if (by_name or x in DROP_TAGS) and self.letters[i] < whole else ""
                    elif why == "comment" and not by_name:
                        why = ""
                    gone = bool(why) and not (i == begin and found)
                    if x == "header" and not gone:
                        if found:
                            headings = max(headings, self.end[i])
                        else:
                            gone = True
                    elif headings > i and x in HEADINGS and not gone:
                        out += [(unescape(t), owner) for kind, t, _ in events[i : self.end[i]] if kind == TEXT]
                        gone = True
                    if gone:
                        i = self.end[i]
                        out.append(("" if x in INLINE else " ", owner))
                    elif self.letters[i] and not (i == begin and found) and (x in CONTAINERS or not found and x not in INLINE and x not in ("html", "body")):
                        candidates.append((self.hash[i], owner, not (x in CONTAINERS and (not found or self.links[i]))))
                        around.append((self.end[i], len(candidates) - 1))
                elif kind == TEXT:
                    if i > headings:
                        out.append((unescape(x) if "&" in x else x, owner))
                elif x not in INLINE:
                    out.append((" ", owner))
                i += 1
            out.append((" ", -1))
        return out, candidates

    def parts(self) -> tuple[list[tuple[str, int]], list[tuple[int, int, bool]]]:
        """pieces(), without the names' say if they would leave nothing."""
        got = self.pieces()
        return got if any(x.strip() for x, _ in got[0]) else self.pieces(by_name=False)

    def outside(self) -> set[int]:
        """Hashes of the containers outside the article, for the pages of the host that have none."""
        out, i, k = set(), 0, 0
        while self.places and i < len(self.events):
            if self.events[i][0] == OPEN:
                if k < len(self.places) and i == self.places[k]:
                    i, k = self.end[i], k + 1
                elif not (k < len(self.places) and self.places[k] < self.end[i]):  # it holds no article
                    if self.unwanted[i]:
                        i = self.end[i]
                    elif self.events[i][1] in CONTAINERS and self.letters[i]:
                        out.add(self.hash[i])
            i += 1
        return out

    def text(self, some: frozenset[int] = frozenset(), most: frozenset[int] = frozenset()) -> str:
        """The main text without the template: subtrees on SHARE of the host's pages, and those on MOST of them."""
        return assembled(*self.parts(), some, most)


def spaced(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def assembled(pieces: list[tuple[str, int]], candidates: list[tuple[int, int, bool]], some, most) -> str:
    """Blocks with single spaces, joined by one space, without what lies in a deleted candidate."""

    def kept(both: bool) -> tuple[list[str], int]:
        gone: list[bool] = []
        for x, around, strict in candidates:
            gone.append(around >= 0 and gone[around] or (both and x in most if strict else x in some))
        texts = [" " if owner >= 0 and gone[owner] else x for x, owner in pieces]
        return texts, sum(len(x) - x.count(" ") for x in texts)

    texts, letters = kept(False)
    if most and any(x in most for x, _, strict in candidates if strict):
        fewer, left = kept(True)
        # what makes up most of the text is text that the host's pages share
        texts = fewer if 2 * left >= letters else texts
    return spaced(texts)


def host(url: str | None) -> str:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


#: What a page's text is made of, if counts of its host may still delete some of it.
_PARTS = [("__pieces", "array<string>"), ("__owners", "array<int>"), ("__hashes", "array<bigint>"), ("__around", "array<int>"), ("__strict", "array<boolean>")]
_READ = [("__host", "bigint"), ("__body", "bigint"), ("__counted", "array<bigint>"), ("main_text", "string"), *_PARTS]
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _long(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) & (2**63 - 1)


def read(url: str | None, html: str | None) -> tuple:
    """The values of _READ: host, hash of the whole text, hashes to count (0 for the page), and the text or its parts."""
    page = Page(html or "")
    pieces, candidates = page.parts()
    text = assembled(pieces, candidates, (), ())
    counted = sorted({0, *page.outside(), *(x for x, _, _ in candidates)})
    if not candidates:
        return _long(host(url)), _long(text), counted, text, None, None, None, None, None
    return _long(host(url)), _long(text), counted, None, [x for x, _ in pieces], [i for _, i in pieces], *map(list, zip(*candidates))


def templates(rows: DataFrame, share: float = SHARE, least: int = LEAST, most: float = MOST) -> DataFrame:
    """(host, some, most) from the rows that read() made: hashes on `share` and on `most` of the host's different pages, and on `least`.

    A host has at most 1 / share times the subtrees of its mean page.
    """
    marks = rows.select("__host", "__body", F.explode("__counted").alias("hash"))
    times = written(marks.groupBy("__host", "hash", "__body").agg(F.lit(1).alias("one")).groupBy("__host", "hash").agg(F.count("*").alias("times")).where((F.col("times") >= least) | (F.col("hash") == 0)))
    pages = times.where("hash = 0").select("__host", F.col("times").alias("pages"))
    found = times.where("hash <> 0").join(pages, "__host").where(F.col("times") >= F.col("pages") * share)
    return found.groupBy("__host").agg(F.collect_list("hash").alias("__some"), F.collect_list(F.when(F.col("times") >= F.col("pages") * most, F.col("hash"))).alias("__most"))


def extracted(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """pages with main_text string.

    A null or empty page has the empty text. A page without article and main
    element gives the rest of its body. Repeated rows get equal texts; a null url
    counts as an empty host. A column of pages named main_text is replaced.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c != "main_text"]
    data = pages.select(*[F.col(f"`{c}`").alias(f"__in_{c}") for c in keep], F.col(f"`{url}`").cast("string").alias("__url"), F.col(f"`{html}`").cast("string").alias("__html"))
    fields = [f for f in data.schema if f.name.startswith("__in_")]
    schema = T.StructType([*fields, *T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in _READ))])
    names = schema.names

    def parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                got = zip(*(read(u.as_py(), x.as_py()) for u, x in zip(batch.column(len(keep)), batch.column(len(keep) + 1))))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(x, _ARROW[t]) for x, (_, t) in zip(got, _READ))], names=names)

    rows = written(in_arrow(data, parse, schema))
    own = [f.name for f in fields]
    out = rows.where("main_text IS NOT NULL").select(*own, "main_text")
    open_ = rows.where("main_text IS NULL").select("__host", *own, *[c for c, _ in _PARTS])
    hot = hot_keys(open_.groupBy("__host").count(), "__host")
    told = looked_up(open_, written(templates(rows)), "__host", hot).select(*own, *[c for c, _ in _PARTS], "__some", "__most")

    def finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = []
            for row in zip(*(batch.column(i) for i in range(len(own), len(own) + 7))):
                pieces, owners, hashes, around, strict, some, most = (x.as_py() or () for x in row)
                texts.append(assembled(list(zip(pieces, owners)), list(zip(hashes, around, strict)), frozenset(some), frozenset(most)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), pa.array(texts, pa.string())], names=[*own, "main_text"])

    out = out.unionByName(in_arrow(told, finish, T.StructType([*fields, T.StructField("main_text", T.StringType())])))
    return out.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(own, keep)], "main_text")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
