"""Main text of web pages by template deduction over same-host pages.

1. Each page is read into tokens in page order: a start tag with the path of its ancestors, or a text with its path.
   Pages of a host that say the same outside furniture count once, so copies and mirrors make no template.
2. A token's occurrence vector over the pages of a host is summed up as the exclusive or of digests of (page, count), the
   number of pages and the largest count, so it is pre-aggregated before any shuffle and a hot host is no hot spot.
3. Tokens of a host with equal occurrence vectors form an equivalence class. Classes that occur once a page on at least
   SHARE of the host's pages (and on MIN_PAGES) and hold MIN_CLASS tokens are candidates. A host's tokens in classes are
   at most 1 / SHARE times the tokens of its mean page, which bounds a template.
4. On a page, a class is valid if all its tokens are there in the host's order; valid classes are nested: a class opens
   in a slot of the class around it and must close there. Of two classes that cross, the one on fewer pages is invalid.
   The nested classes are the page's template; what stands between their tokens are slots.
5. Main text comes from the slots: a text that is itself a template token is furniture, inside article and main
   elements too, and so is a slot in a template element that holds mostly links over the host's pages. Then a slot is
   dropped if an element around it is furniture by its kind or name (menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles, comments), which no repetition shows where it differs from page to page. Of the rest,
   slots inside an article or main element are the main text; on pages without one, all slots within the deepest element
   that holds every slot but lists of links are.

Hosts with fewer than MIN_PAGES different pages have no template; there the kinds and names of elements decide alone.

Templates are broadcast where their measured size allows it, so pages aren't shuffled; beyond that, pages are dealt by
host and by a salt whose range grows with the host's pages.

Defined cases: null html counts as empty and gives an empty text; null or odd urls have no host, hence no template;
unclosed and misnested tags are closed as browsers do, cut-off pages end where they end; after a tag whose quotes never
close, tags end at the next '>'; br is white space; repeated pages each get a row; an empty table gives an empty result;
extra columns are ignored. Time and memory are linear in a page's length, however deep it nests.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baitline.llm.common import checkpointed, short_batches

MIN_PAGES = 4
MIN_CLASS = 3
SHARE = 0.5
#: An element is a list of links if it holds this many times more characters in links than outside, over a host.
LINKS = 4
#: Templates of this many bytes in all are broadcast; beyond, a task's share of a host is this many pages.
BROADCAST_BYTES = 32 << 20
SALT_PAGES = 10_000
#: Elements by kind.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"nav", "footer", "aside", "form", "button", "select", "option", "label", "fieldset", "menu", "dialog", "head", "object", "audio", "video", "canvas", "map", "datalist"}
MAIN = {"article", "main"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: Words in class, id or role that mark furniture.
FURNITURE_WORDS = {
    "ad", "ads", "adsense", "advert", "advertisement", "advertising", "advertorial", "adv", "banner", "breadcrumb", "breadcrumbs", "captcha", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus", "dropdown", "footer", "gdpr", "hidden", "login",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "paywall", "popup", "privacy", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget", "alert", "complementary", "contentinfo", "search", "topbar", "outbrain", "taboola",
}
FURNITURE_STARTS = ("comment", "sidebar", "advert", "cookie", "footer", "navbar", "breadcrumb", "newsletter", "sponsor", "popup", "disqus")
#: An open element of the first kind ends where one of the second begins.
ENDS = {
    "p": BLOCK - {"title"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"},
}
#: An end tag or an implied end doesn't look for its element beyond these.
FENCES = {"table", "td", "th", "article", "main", "section", "nav", "aside", "footer", "header", "body", "html", "form"}
_MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements that are never taken for the one that holds the main text, or for a list of links.
_INLINE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "span", "b", "i", "a", "em", "strong"}


class Element:
    """An open or closed element: key is a digest of its path, holder its nearest block element (or itself), scope the
    open tags since the nearest fence, linked and unlinked its characters inside and outside links, order and end its
    place among the page's elements."""

    __slots__ = ("end", "furniture", "holder", "key", "linked", "main", "order", "parent", "scope", "tag", "unlinked")

    def __init__(self, tag: str, parent: Element | None, key: int, furniture: bool, main: bool, order: int):
        self.tag, self.parent, self.key, self.furniture, self.main, self.order = tag, parent, key, furniture, main, order
        self.linked = self.unlinked = self.end = 0
        self.holder = self if parent is None or tag in BLOCK else parent.holder
        self.scope: Counter[str] = Counter() if parent is None or tag in FENCES else parent.scope

    def within(self, other: Element) -> bool:
        return other.order <= self.order < other.end


def _find_marks(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    found = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attributes)}
    named = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in _NAMES.findall(named)} | {re.sub("[^a-z]", "", w) for w in re.split(r"[^a-z]+", named.lower())}
    marked = not words.isdisjoint(FURNITURE_WORDS) or any(w.startswith(FURNITURE_STARTS) for w in words)
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    main = tag in MAIN or found.get("role") == "main" or found.get("itemprop") == "articleBody"
    furniture = tag in FURNITURE or hidden or (tag not in ("html", "body") and not (tag == "main") and marked)
    return f"{tag}[{named}]" if named.strip() else tag, furniture, main, tag == "header" or "header" in words


_cached_marks = lru_cache(maxsize=20_000)(_find_marks)


def _marks(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(name with its class, id and role; furniture, main, or a header, by kind or name) of a start tag."""
    if not attributes.strip():
        return tag, tag in FURNITURE, tag in MAIN, tag == "header"
    return (_cached_marks if len(attributes) + len(tag) < 512 else _find_marks)(tag, attributes)


def _digest(text: str | bytes) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text) - (1 << 63)


@lru_cache(maxsize=20_000)
def _below(key: int, name: str) -> int:
    """The key of an element by its parent's key and its name."""
    return _digest(f"{key}/{name}")


def text_token(key: int, text: str) -> int:
    return _digest(f"{key}#{text}")


#: A host's template: token -> (class, tokens of the class, pages of the class, place in the class's order, mostly links).
Template = dict[int, tuple[int, int, int, int, bool]]


def nested(classes: dict[int, tuple[int, list[int]]]) -> dict[int, tuple[int | None, int]]:
    """The tree of classes (pages, places of its tokens on a page, ascending): class -> (class around it, slot in that).

    Slot n of a class lies behind its n-th token. Of two classes that cross, the one on fewer pages (then with fewer
    tokens, then with the larger number) is left out.
    """
    left = dict(classes)
    while True:
        tree: dict[int, tuple[int | None, int]] = {}
        stack: list[int] = []
        seen: Counter[int] = Counter()
        for _, c in sorted((at, c) for c, (_, places) in left.items() for at in places):
            if not seen[c]:
                tree[c] = (stack[-1], seen[stack[-1]]) if stack else (None, 0)
                stack.append(c)
            elif stack[-1] != c:
                del left[min(c, stack[-1], key=lambda x: (left[x][0], len(left[x][1]), -x))]
                break
            seen[c] += 1
            if seen[c] == len(left[c][1]):
                stack.pop()
        else:
            return tree


class Page:
    """A page as elements and texts. items: (token, element, text or None for a start tag) in page order."""

    def __init__(self, source: str):
        self.items: list[tuple[int, Element, str | None]] = []
        self.count = 0
        self.element = self.root = Element("", None, 0, False, False, 0)
        self.parts: list[str] = []
        self.links = 0
        self._read(source)

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if n := len(text) - text.count(" "):
            if self.links:
                self.element.linked += n
            else:
                self.element.unlinked += n

    def _flush(self) -> None:
        if self.parts:
            if text := _SPACE.sub(" ", "".join(self.parts)).strip():
                self.items.append((text_token(self.element.key, text), self.element, text))
            self.parts = []

    def _open(self, tag: str, attributes: str) -> None:
        while self.element.tag in ENDS and tag in ENDS[self.element.tag]:
            self._leave()
        if tag in BLOCK:  # an open p may lie below inline elements
            e = self.element.holder
            if e.tag in ENDS and tag in ENDS[e.tag]:
                while self.element is not e.parent:
                    self._leave()
        name, furniture, main, header = _marks(tag, attributes)
        above = self.element
        furniture = furniture or header and not above.main  # an article's own header holds its title
        self.count += 1
        self.element = Element(tag, above, _below(above.key, name) if len(name) < 512 else _digest(f"{above.key}/{name}"), above.furniture or furniture, above.main or main, self.count)
        self.element.scope[tag] += 1
        if tag in FENCES:
            self.root.scope[tag] += 1
        self.links += tag == "a"
        self.items.append((self.element.key, self.element, None))

    def _leave(self) -> None:
        e = self.element
        e.scope[e.tag] -= 1
        if e.tag in FENCES:
            self.root.scope[e.tag] -= 1
        e.end = self.count + 1
        self.links -= e.tag == "a"
        self.element = e.parent
        self.element.linked += e.linked
        self.element.unlinked += e.unlinked

    def _close(self, tag: str) -> None:
        """Ends the nearest open element of this kind; inside a fence, only one that lies inside it too."""
        if (self.root if tag in FENCES else self.element).scope[tag] > 0:
            while self.element.tag != tag:
                self._leave()
            self._leave()

    def _read(self, source: str) -> None:
        at, quotes = 0, True
        while match := _MARKUP.search(source, at):
            if match.start() > at:
                self._text(source[at : match.start()])
            comment, declaration, ending, tag = match.groups()
            if comment or declaration:
                end = source.find("-->" if comment else ">", match.end())
                at = end + (3 if comment else 1) if end >= 0 else len(source)
                continue
            rest = _REST.match(source, match.end()) if quotes else None
            at = rest.end() if rest else source.find(">", match.end()) + 1
            quotes = rest is not None
            if not at:  # cut off within a tag
                at = len(source)
                break
            attributes = source[match.end() : at - 1]
            tag = tag.lower()
            if ending:
                if tag in BLOCK:
                    self._flush()
                self._close(tag)
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
                continue
            if tag in BLOCK:
                self._flush()
            if tag in VOID:
                if tag == "br":
                    self.parts.append(" ")
                continue
            self._open(tag, attributes)
        if at < len(source):
            self._text(source[at:].removesuffix("</"))
        self._flush()
        while self.element.parent is not None:
            self._leave()
        self.root.end = self.count + 1

    def tokens(self) -> dict[int, list[int]]:
        """Tokens in order: how often each occurs, and the characters inside and outside links of its elements."""
        found: dict[int, list[int]] = {}
        for token, e, text in self.items:
            seen = found.setdefault(token, [0, 0, 0])
            seen[0] += 1
            if text is None:
                seen[1] += e.linked
                seen[2] += e.unlinked
        return found

    def content(self) -> int:
        """A digest of what the page says outside elements that are furniture by kind or name."""
        return _digest("\n".join(text for _, e, text in self.items if text is not None and not e.furniture))

    def placed(self, template: Template) -> tuple[set[int], dict[int, tuple[int | None, int]]]:
        """(tokens of the valid, nested classes on this page; their tree)."""
        places: dict[int, list[int]] = defaultdict(list)
        for at, (token, _, _) in enumerate(self.items):
            if token in template:
                places[token].append(at)
        classes: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for token, at in places.items():
            classes[template[token][0]].append((template[token][3], at[0] if len(at) == 1 else -1))
        whole = {}
        for token in places:
            c, size, pages, _, _ = template[token]
            if c not in whole and len(classes[c]) == size:
                order = [at for _, at in sorted(classes[c])]
                if order[0] >= 0 and all(a < b for a, b in zip(order, order[1:])):
                    whole[c] = (pages, order)
        tree = nested(whole)
        return {token for token in places if template[token][0] in tree}, tree

    def main_text(self, template: Template) -> str:
        """The slots that stay, one line each."""
        valid, _ = self.placed(template) if template else (set(), {})
        lists = self._lists({token for token in valid if template[token][4]})
        slots = [(text, e) for token, e, text in self.items if text is not None and not e.furniture and token not in valid and e not in lists]
        if any(e.main for _, e in slots):
            return "\n".join(text for text, e in slots if e.main)
        best = self._around(slots)
        return "\n".join(text for text, e in slots if best is None or e.within(best))

    def _lists(self, tokens: set[int]) -> set[Element]:
        """The elements of these tokens that hold no article or main element, and all within them."""
        if not tokens:
            return set()
        holding: set[Element] = set()
        for _, e, text in reversed(self.items):
            if text is None and (e.main and not e.parent.main or e in holding):
                holding |= {e, e.parent}
        found: set[Element] = set()
        for token, e, text in self.items:
            if text is None and (e.parent in found or token in tokens and e not in holding and e.tag not in _INLINE):
                found.add(e)
        return found

    def _around(self, slots: list[tuple[str, Element]]) -> Element | None:
        """The deepest element that holds all slots but lists of links."""
        held = [e for _, e in slots if e.linked <= e.unlinked]
        if not held:
            return None
        first, last = min(e.order for e in held), max(e.order for e in held)
        e = held[0]
        while e is not None and (e.tag in _INLINE or not (e.order <= first and last < e.end)):
            e = e.parent
        return e


def host_of(url: Column) -> Column:
    """The host of a url in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.trim(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)), F.lit(""))


TOKENS = "host string, content long, page long, tokens array<long>, n array<int>, linked array<int>, unlinked array<int>"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a page: host, digests of what it says and of all of it, and its tokens in order."""
    for batch in batches:
        sources = batch.column(1).to_pylist()
        pages = [Page(s) for s in sources]
        found = [p.tokens() for p in pages]
        counts = [[[v[i] for v in f.values()] for f in found] for i in range(3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p.content() for p in pages], pa.int64()), pa.array([_digest(s) for s in sources], pa.int64()), pa.array([[*f] for f in found], pa.list_(pa.int64())), *(pa.array(c, pa.list_(pa.int32())) for c in counts)],
            names=["host", "content", "page", "tokens", "n", "linked", "unlinked"],
        )


MEMBER = np.dtype([("token", "<i8"), ("class", "<i8"), ("pages", "<i8"), ("size", "<u4"), ("place", "<u4"), ("links", "?")])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Templates as the bytes of MEMBER rows."""
    for batch in batches:
        out = []
        for classes in batch.column(2).to_pylist():
            rows = [(m["token"], c["vector"], c["pages"], len(c["m"]), place, m["links"]) for c in classes for place, m in enumerate(c["m"])]
            out.append(np.array(rows, MEMBER).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["host", "pages", "template"])


def unpacked(template: bytes | None) -> Template:
    rows = np.frombuffer(template or b"", MEMBER)
    return {token: (c, size, pages, place, links) for token, c, pages, size, place, links in rows.tolist()}


def templates(pages: DataFrame) -> DataFrame:
    """(host, pages, template): the candidate classes of each host, from pages(host, source).

    pages counts different contents; template is the bytes of a row of MEMBER a token.
    """
    read = pages.where("host <> ''").select("host", "source").mapInArrow(_tokens, TOKENS)
    fields = ["page", "tokens", "n", "linked", "unlinked"]
    once = checkpointed(read.groupBy("host", "content").agg(F.min(F.struct(*fields)).alias("x")).select("host", "content", *(f"x.{f}" for f in fields[1:])))
    each = once.select("host", "content", F.posexplode(F.arrays_zip(*fields[1:])).alias("at", "t")).select("host", "content", "at", "t.*")
    vectors = each.groupBy("host", F.col("tokens").alias("token")).agg(
        F.bit_xor(F.xxhash64("content", "n")).alias("vector"), F.count("*").alias("pages"), F.max("n").alias("most"), F.sum("at").alias("at"), (F.sum("linked") > F.sum("unlinked") * LINKS).alias("links")
    )
    hosts = once.groupBy("host").agg(F.count("*").alias("of")).where(F.col("of") >= MIN_PAGES).select(F.col("host").alias("_host"), "of")
    frequent = vectors.where((F.col("most") == 1) & (F.col("pages") >= MIN_PAGES)).join(hosts, F.col("host") == F.col("_host")).where(F.col("pages") >= F.col("of") * SHARE)
    members = F.array_sort(F.collect_list(F.struct("at", "token", "links")))
    classes = frequent.groupBy("host", "of", "vector", "pages").agg(members.alias("m")).where(F.size("m") >= MIN_CLASS)
    whole = classes.groupBy("host").agg(F.max("of").alias("pages"), F.collect_list(F.struct("vector", "pages", "m")).alias("classes"))
    return whole.mapInArrow(_packed, "host string, pages long, template binary")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Template] = {}
    for batch in batches:
        numbers, urls, sources, hosts, given = (batch.column(i) for i in range(5))
        texts = []
        for i, (source, host) in enumerate(zip(sources.to_pylist(), hosts.to_pylist())):
            if host not in known:
                if len(known) >= 64:
                    known.clear()
                known[host] = unpacked(given[i].as_py())
            texts.append(Page(source).main_text(known[host]))
        yield pa.RecordBatch.from_arrays([numbers, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    short_batches(pages.sparkSession)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("number"), url.alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("source"), host_of(url).alias("host"))
    every = checkpointed(templates(rows))
    size = every.agg(F.sum(F.length("template") + F.length("host") + 64).alias("n")).first().n or 0
    found = every.select(F.col("host").alias("_host"), "template", "pages")
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(found.drop("pages")), F.col("host") == F.col("_host"), "left")
    else:
        salts = F.ceil(F.col("pages") / SALT_PAGES).cast("int")
        hot = found.select(F.col("_host").alias("_hot"), salts.alias("salts")).where("salts > 1")  # a row for SALT_PAGES pages or more
        salted = rows.join(F.broadcast(hot), F.col("host") == F.col("_hot"), "left").withColumn("salt", F.pmod(F.xxhash64("number", "source"), F.coalesce("salts", F.lit(1))).cast("int"))
        dealt = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        joined = salted.join(dealt, (F.col("host") == F.col("_host")) & (F.col("salt") == F.col("_salt")), "left")
    return joined.select("number", "url", "source", "host", "template").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
