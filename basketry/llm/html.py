"""HTML extraction by removal of site templates.

1. Every page is parsed into elements (unclosed and misnested tags as browsers mend them, in outline) and
   each element gets a hash of its subtree: names, classes, text and children.
2. Spark counts, per host, on how many pages a subtree occurs. One that occurs on at least ``MANY`` pages, and on
   the share ``SHARE`` of the host's, belongs to the template. Pages send a subtree once, as one 64-bit key of host and subtree, and the counts
   are combined before the shuffle.
3. Template subtrees are deleted, with what markup itself declares to be no content: scripts, styles, forms,
   menus, headers, footers, sidebars, notices, adverts and reader comments, by element, role or class. The
   second kind is what a page of a small host has nothing but. Inside an article a class says so only if all its
   words do, and an id only if its words name nothing else.
4. Of what is left the text is taken: from the elements ``article``; from ``main`` if there are none, or if more
   of its words lie outside of them; else from the whole page.

A subtree is content, however often it occurs, if it is, holds or lies in an ``article`` or ``main`` that is
itself no comment or sidebar, or if it holds more than half of a page's words (copies of one page are no
template), or fewer than ``FEW`` words outside a list (short sentences meet by chance).

Blocks are the block elements of HTML; white space in a block becomes one space, ``br`` and table cells are
white space, character references are decoded, blocks are joined by one line feed, empty ones left out.

Null or empty html gives an empty text; a page without host shares its template with the other such pages;
rows may repeat and ids be null; an empty table gives an empty result. Other columns are ignored. Whole
pages are read whatever their length; nesting has no limit.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Cut, ship

#: A template subtree is on so many pages of its host at least, and on this share of them; it has so many words.
MANY, SHARE, FEW = 5, 0.2, 4

# Element names of HTML and what markup calls things that are no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p "
    "plaintext pre search section summary table tbody tfoot thead tr ul xmp caption".split()
)
SILENT = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea input iframe "
    "object embed svg math canvas audio video dialog menu noframes datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer colophon sidebar sidenav aside "
    "widget widgets ad ads adbox adslot adsense advert adverts advertisement advertising banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social comment comments commentlist discussion disqus reply replies respond "
    "related recommended recommendations pagination pager toolbar skip hidden".split()
)
#: Words beside those above in names of boxes that are no content, such as site-footer or comment-list.
NEUTRAL = frozenset(
    "site page main top bottom left right inner outer container wrapper wrap box block area section list item items bar "
    "primary secondary global local mobile desktop fixed sticky content widget module panel form link links button "
    "buttons title text icon icons image slot unit row col column group post posts article articles the my js is has id "
    "thread count feed inline wide small large first last left1 right1 header footer".split()
)
#: Words that name content too: an id or a part of a heading's name that has one says nothing alone.
AMBIGUOUS = frozenset(
    "discussion related recommended recommendations recommendation notice notices notification alert hidden social share "
    "sharing promotion banner header subscription reply replies login signup skip comment overlay modal ad ads".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Classes that make an ``article`` or ``main`` inside them no content.
AROUND = frozenset(
    "comment comments commentlist comment-list comments-area discussion disqus replies sidebar related related-posts "
    "related-articles recommended recommendations advert advertisement ads ad widget".split()
)
HEADERS = frozenset(("header", "masthead"))
#: Beginnings of names written in one word, such as cookiebar or commentlist.
_BEGINS = re.compile(r"(?:cookie|advert|sidebar|comment|newsletter|navbar|navmenu|footer|breadcrumb|popup|sponsor|promo|disqus|gdpr)[a-z0-9]*$")
_CLOSES_P = BLOCK - frozenset(("html", "body", "li", "dd", "dt", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"))
_SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"),
}
_SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|xmp|noframes)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(.*?)(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Page:
    """Elements of a page in the order they open: ``tags``, ``parents``, ``attributes``; ``events`` holds
    ``i`` where element ``i`` opens, ``~i`` where it closes, and the texts between."""

    def __init__(self, source: str):
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.attributes: list[dict[str, str]] = []
        self.events: list[int | str] = []
        self._found: list[tuple[int, int]] | None = None
        self._parse(source)

    def _parse(self, source: str) -> None:
        events, stack, at = self.events, [], 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                events.append(source[at : m.start()])
            at = m.end()
            if m[4] or m[7]:
                closing, name, rest = (m[3], m[4], m[5]) if m[4] else (m[6], m[7], m[8])
                name = name.lower()
                if closing:
                    self._close(stack, name)
                else:
                    self._open(stack, name, rest)
        if at < len(source):
            events.append(source[at:])
        while stack:
            events.append(~stack.pop())

    def _open(self, stack: list[int], name: str, rest: str) -> None:
        tags = self.tags
        if name in _CLOSES_P:
            self._close_within(stack, ("p",), BLOCK - {"p"})
        if name in _SIBLINGS:
            self._close_within(stack, _SIBLINGS[name], _SCOPE[name])
        i = len(tags)
        tags.append(name)
        self.parents.append(stack[-1] if stack else -1)
        self.attributes.append({a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(rest)} if "=" in rest else {})
        if re.search(r"(?:^|\s)hidden(?:\s|$)", rest):
            self.attributes[i]["hidden"] = "hidden"
        self.events.append(i)
        if name in VOID or rest.endswith("/") and name in ("svg", "path"):
            self.events.append(~i)
        else:
            stack.append(i)

    def _pop_to(self, stack: list[int], depth: int) -> None:
        while len(stack) > depth:
            self.events.append(~stack.pop())

    def _close_within(self, stack: list[int], names: tuple, stop) -> None:
        """Close the outermost open element of ``names`` above the nearest element of ``stop``."""
        found = None
        for depth in range(len(stack) - 1, -1, -1):
            tag = self.tags[stack[depth]]
            if tag in names:
                found = depth
            elif tag in stop:
                break
        if found is not None:
            self._pop_to(stack, found)

    def _close(self, stack: list[int], name: str) -> None:
        block = name in BLOCK
        for depth in range(len(stack) - 1, -1, -1):
            tag = self.tags[stack[depth]]
            if tag == name:
                self._pop_to(stack, depth)
                return
            if not block and tag in BLOCK:
                return  # an inline end tag does not close the block around it

    def subtrees(self) -> tuple[list[int], list[int]]:
        """Hash and number of words of each element's subtree."""
        n = len(self.tags)
        sums = [xxhash.xxh64_intdigest(f"{t} {a.get('class', '')}") for t, a in zip(self.tags, self.attributes, strict=True)]
        words, stack = [0] * n, []
        for e in self.events:
            if isinstance(e, str):
                split = references.unescape(e).split()
                if split and stack:
                    i = stack[-1]
                    words[i] += len(split)
                    sums[i] = xxhash.xxh64_intdigest(" ".join(split), sums[i])
            elif e >= 0:
                stack.append(e)
            else:
                i = stack.pop()
                if stack:
                    up = stack[-1]
                    words[up] += words[i]
                    sums[up] = xxhash.xxh64_intdigest(sums[i].to_bytes(8, "little"), sums[up])
        return sums, words

    def _tokens(self, i: int) -> list[str]:
        a = self.attributes[i]
        return f"{a.get('class', '')} {a.get('id', '')}".lower().split() if a else []

    def roots(self) -> list[bool]:
        """Elements that hold the content: articles, or mains where there are none or more words of a main lie outside
        of articles than inside, as beside teasers."""
        spoiled, found = [], {"article": [], "main": []}
        for i, tag in enumerate(self.tags):
            up = self.parents[i]
            bad = up >= 0 and spoiled[up]
            if not bad and tag not in ("html", "body"):
                bad = tag in ("nav", "aside", "footer", "template") or not AROUND.isdisjoint(self._tokens(i))
            spoiled.append(bad)
            if not bad:
                kind = "main" if tag == "main" or self.attributes[i].get("role") == "main" else tag
                if kind in found:
                    found[kind].append(i)
        chosen = set(found["article"] or found["main"])
        if found["article"] and found["main"]:
            _, words = self.subtrees()
            outer = [i for i in found["article"] if not self._within(i, chosen - {i})]
            held = sum(words[i] for i in outer if self._within(i, set(found["main"])))
            if sum(words[i] for i in found["main"]) > 2 * held:
                chosen = set(found["main"])
        return [i in chosen for i in range(len(self.tags))]

    def _within(self, i: int, others: set[int]) -> bool:
        while (i := self.parents[i]) >= 0:
            if i in others:
                return True
        return False

    def inside(self, roots: list[bool]) -> list[bool]:
        within: list[bool] = []
        for i, up in enumerate(self.parents):
            within.append(roots[i] or up >= 0 and within[up])
        return within

    def candidates(self) -> set[int]:
        """Hashes of the subtrees that may belong to a template."""
        return {h for _, h in self._candidates()}

    def _candidates(self) -> list[tuple[int, int]]:
        """Element and hash of each subtree that may belong to a template."""
        if self._found is None:
            self._found = self._look_for_candidates()
        return self._found

    def _look_for_candidates(self) -> list[tuple[int, int]]:
        sums, words = self.subtrees()
        roots = self.roots()
        within = self.inside(roots)
        holds = list(roots)
        for i in range(len(self.tags) - 1, 0, -1):
            if holds[i] and self.parents[i] >= 0:
                holds[self.parents[i]] = True
        total = sum(w for w, up in zip(words, self.parents, strict=True) if up < 0)
        found, listed = [], []
        for i, tag in enumerate(self.tags):
            up = self.parents[i]
            listed.append(tag in ("ul", "ol", "nav", "menu") or up >= 0 and listed[up])
            if tag in ("html", "head", "body") or within[i] or holds[i] or not words[i]:
                continue
            if 2 * words[i] > total or words[i] < FEW and not listed[i]:
                continue
            found.append((i, sums[i]))
        return found

    def _declared(self, i: int, within: bool) -> bool:
        """Whether markup says that this element is no content."""
        tag, a = self.tags[i], self.attributes[i]
        if tag in SILENT and not (within and tag in HEADERS):
            return True
        if not a:
            return False
        if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
            return True
        if tag in ("html", "body", "main", "article"):
            return False
        small = within and (tag in _HEADINGS or tag == "p")
        for token in a.get("class", "").lower().split():
            # A paragraph or heading of the content goes only by a name that says nothing else.
            if token in WORDS - HEADERS if small else self._names_no_content(token, within, WORDS):
                return True
        # Inside the content an id may name a section of it; a heading's is its anchor.
        if small:
            return False
        return any(self._names_no_content(t, within, WORDS - AMBIGUOUS if within else WORDS) for t in a.get("id", "").lower().split())

    @staticmethod
    def _names_no_content(token: str, within: bool, words: frozenset) -> bool:
        """Whether a class or id is made of words for what is no content. Outside of an article one such word is
        enough; inside, all others must be neutral ones: ad-slot is none, ad-hoc is."""
        pieces = {p for p in re.split(r"[-_:]+", token) if p}
        named = (pieces | {token}) & words
        grown = any(map(_BEGINS.match, pieces))
        if not within:
            return bool(named) or grown
        rest = pieces - words - NEUTRAL
        return (bool(named - HEADERS) and not rest) or (grown and len(pieces) == 1)

    def text(self, template: set[int]) -> str:
        """The text without template subtrees and without what markup declares no content.

        A page of which the template would take more than three quarters of the words is a copy of pages
        like it: what repeats is its content, and only what markup declares is taken away."""
        gone = {i for i, h in self._candidates() if h in template} if template else set()
        found = self._text(gone)
        if gone and not any(self.roots()):
            plain = self._text(set())
            if 4 * len(found.split()) < len(plain.split()):
                return plain
        return found

    def _text(self, gone: set[int]) -> str:
        roots = self.roots()
        within = self.inside(roots)
        rooted = any(roots)
        # A form around most of a page is its layout.
        _, words = self.subtrees() if "form" in self.tags else (None, None)
        total = sum(w for w, up in zip(words, self.parents, strict=True) if up < 0) if words else 0
        blocks, parts, closed, silent, depth = [], [], -1, False, 0

        def flush() -> None:
            joined = " ".join(references.unescape("".join(parts)).split())
            if joined:
                blocks.append(joined)
            parts.clear()

        for e in self.events:
            if isinstance(e, str):
                if not silent and (depth or not rooted):
                    parts.append(e)
                continue
            i = e if e >= 0 else ~e
            tag = self.tags[i]
            if not silent:
                if tag in BLOCK:
                    flush()
                elif tag in ("br", "td", "th"):
                    parts.append(" ")
            if e >= 0:
                depth += roots[i]
                layout = tag == "form" and 2 * words[i] > total
                if not silent and not roots[i] and not layout and (within[i] or not rooted) and (i in gone or self._declared(i, within[i])):
                    silent, closed = True, i
            else:
                if silent and i == closed:
                    silent, closed = False, -1
                if roots[i]:
                    depth -= 1
        flush()
        return "\n".join(blocks)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _keys(page: Page, host: str) -> dict[int, int]:
    """Key of host and subtree -> subtree hash."""
    seed = xxhash.xxh64_intdigest(host)
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    return {signed(xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)): h for h in page.candidates()}


def _host_key(host: str) -> int:
    """The key under which the pages of a host are counted."""
    return xxhash.xxh64_intdigest(f"pages of {host}") - (1 << 63)


def template_keys(pages: DataFrame) -> DataFrame:
    """``row_key, key``: the subtrees of each page, each once, and the key of its host."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for row, url, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                host = host_of(url)
                found = _keys(Page(source or ""), host)
                rows += [row] * (len(found) + 1)
                keys += [_host_key(host), *found]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(keys, pa.int64())], names=["row_key", "key"])

    return pages.select("row_key", "url", "html").mapInArrow(cut, "row_key long, key long")


def extract(pages: DataFrame, many: int = MANY, share: float = SHARE) -> DataFrame:
    """``page_id, url, text, n_chars, n_template``: the text of each page; ``n_template`` counts its subtrees that belong
    to the template of its host."""
    ship(pages.sparkSession)
    # Rows equal in all three columns share a key, their text is the same.
    keyed = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("row_key"))
    keys = Cut(template_keys(keyed), "subtrees").df
    counts = keys.groupBy("key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= many)
    # A page gets the counts of its subtrees and of its host's pages together.
    per_page = keys.join(counts, "key").groupBy("row_key").agg(F.map_from_entries(F.collect_set(F.struct("key", "pages"))).alias("counts"))
    joined = keyed.join(per_page, "row_key", "left")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for url, source, counted in zip(*(batch.column(c) for c in ("url", "html", "counts")), strict=True):
                page, held, host = Page(source.as_py() or ""), dict(counted.as_py() or ()), host_of(url.as_py())
                least = share * held.pop(_host_key(host), 0)
                template = {h for k, h in _keys(page, host).items() if held.get(k, -1) >= least} if held else set()
                texts.append(page.text(template))
                numbers.append(len(template))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(numbers, pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_template"],
            )

    return joined.mapInArrow(take, "page_id long, url string, text string, n_chars long, n_template long")
