"""Main text of pages by host consensus.

First pass: a page's blocks give scores to the containers above them, and the page votes for the
generalised path (tags and classes, numbers removed) of its best container, or of the ancestor that adds
headings and sibling sections to it.  Spark counts the votes per host.  Second pass: a page's text is
taken from the first of its host's winning paths that it has, or from its own best container if it has none.

What is dropped, and nothing else: the content of

- ``nav``, ``menu``, ``search`` (menus); ``footer``; ``aside`` (sidebars); ``head``, ``title``; ``header``
  outside an article, unless it stands deeper than body, has an h1 and no ``nav``;
- ``form`` with its fields (``fieldset``, ``select``, ``textarea``, ``datalist``), unless it spans most of the page's
  text; ``button``, ``option``, ``input`` anywhere, as they are controls; a ``label`` outside a form is text;
- ``dialog`` (a notice that isn't shown until opened) and what ``hidden``, ``aria-hidden`` or ``display: none`` hides;
- ``script``, ``noscript``, ``style``, ``template`` (inert markup);
- ``iframe``, ``object``, ``audio``, ``video``, ``canvas``: their content is shown only where the medium is not; ``svg``:
  a drawing, its letters are part of the picture.  ``math`` and ``xmp`` are text and stay;
- containers whose class, id or role names one of these parts, adverts, cookie notices, newsletters,
  sharing, related links or reader comments.  See ``kind_of`` and ``lifted`` for names that only seem to.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, stored

#: Elements that end the block before them and start another.
BLOCK = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul xmp".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no page text, read up to their own end tag.
RAW = frozenset("script style noscript template textarea select iframe noembed noframes object svg canvas audio video datalist xmp".split())
#: Elements whose text is never article text.
NOISE_TAGS = frozenset("head title nav aside footer button dialog menu input option search".split())
FORM_TAGS = frozenset(("form", "fieldset"))
#: Words of a class, id or role that name reader comments.
COMMENTS = frozenset("comment comments discussion disqus replies reply respond".split())
#: Words that name adverts; they count on inline elements too.
ADVERTS = frozenset("ad ads advert adverts advertisement promo promoted sponsor sponsored".split())
#: Words that name a part of the page's frame; paragraphs, headings, cells and items may bear them as text.
FRAME = frozenset("banner footer form header masthead menu modal nav navbar navigation sidebar toolbar widget".split())
NOISE = COMMENTS | ADVERTS | FRAME | frozenset("alert breadcrumb breadcrumbs complementary consent contentinfo cookie cookies login newsletter notice notices pager pagination popup reactions related share sharing signup skip social subscribe subscription".split())
#: A name with one of these says what a container has or lacks, not what it is: has-sidebar, no-ads, with-comments.
HAVING = frozenset("has have having with without no not non show hide enable enabled disable disabled open closed allow".split())
#: Words that name the article; a header of one is its headline.
CONTENT = frozenset("article blog content entry hentry main page post section single story text body".split())
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li td th tr dt dd pre blockquote figure figcaption caption summary".split())
WHOLE_PAGE = ("html", "body")
#: A paragraph that starts ends one that is open; likewise for the other elements with optional ends.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
AROUND_P = ("table", "td", "th", "button", "li", "div", "article", "section", "main", "body")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'](?=[^\"']*>))*)>", re.S)
#: A tag whose quotes don't match: it ends at the next ``>``.
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
DIGITS = re.compile(r"\d+")
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")

#: Marks that always count; what is in them needs no other.
FIRM = ("tag", "comments")
#: In so many containers that only seem to be noise, another one is.
DEEP = 8
MAX_PATHS = 3
#: Bytes of winning paths that a task may hold; with more, pages are joined to them by host and salt.
MAX_BROADCAST = 16 << 20
SALT = 64


class Block:
    __slots__ = ("container", "linked", "marks", "parts", "tag")

    def __init__(self, container: int, tag: str, marks: tuple[int, ...]) -> None:
        self.container, self.tag, self.marks = container, tag, marks
        self.parts: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return " ".join(references.unescape("".join(self.parts)).split())


def kind_of(tag: str, names: list[str]) -> str | None:
    """What an element's class, id and role tokens mark it as: "comments", "named" (all words of a token say noise), "hinted" (some do), or nothing.

    A token with a word of HAVING marks nothing; nor does "header" beside a word for the article.  Beside
    a token that names the article, any mark is a hint only.
    """
    found = None
    article = False
    for name in names:
        words = [w.lower() for w in SPLIT.split(name) if w]
        if not words or not HAVING.isdisjoint(words):
            continue
        noise = [w for w in words if w in NOISE and not (w in FRAME and tag in TEXTUAL)]
        if "header" in noise and not CONTENT.isdisjoint(words):
            noise = [w for w in noise if w != "header"]
        if not noise:
            article |= CONTENT.issuperset(words)
        elif not COMMENTS.isdisjoint(noise):
            found = "comments"
        elif found != "comments":
            found = "named" if len(noise) == len(words) or found == "named" else "hinted"
    if tag in ("article", "main"):
        return found if found == "comments" else None
    return "hinted" if found and article else found


class Page:
    """A page's blocks in order, its containers (numbered in page order) and the marks that may make blocks noise."""

    def __init__(self, source: str) -> None:
        self.blocks: list[Block] = []
        self.parent, self.step, self.tag, self.key = [0], [""], [""], [0]
        self.children: list[list[int]] = [[]]
        self.first, self.last = [0], [0]  # the blocks of a container are a range
        self.marks: list[tuple[str, int]] = []  # kind, container
        self.read(source)
        self.last[0] = len(self.blocks)
        self.texts = [b.text() for b in self.blocks]
        seen = self.lifted()
        self.seen = [bool(t) and seen.issuperset(b.marks) for b, t in zip(self.blocks, self.texts, strict=True)]

    def read(self, page: str) -> None:
        none: tuple[int, ...] = ()
        stack: list[tuple[str, int, tuple[int, ...]]] = [("", 0, none)]  # tag, container, marks
        where: dict[str, list[int]] = {}  # positions in the stack by tag
        block = Block(0, "", none)
        at, n = 0, len(page)

        def fresh(tag: str) -> None:
            nonlocal block
            if block.parts:
                self.blocks.append(block)
            block = Block(stack[-1][1], tag, stack[-1][2])

        def pop(to: int) -> None:
            while len(stack) > to:
                tag, container, _ = stack.pop()
                where[tag].pop()
                if tag in BLOCK:
                    self.last[container] = len(self.blocks) + bool(block.parts)

        def find(tags: tuple[str, ...], stops: tuple[str, ...] = ()) -> int:
            top = lambda names: max((w[-1] for t in names if (w := where.get(t))), default=0)
            i = top(tags)
            return i if i and i > top(stops) else 0

        def put(text: str) -> None:
            if stack[-1][2] is block.marks:  # else an inline element hides it
                block.parts.append(text)
                if where.get("a"):
                    block.linked += len(text)

        while at < n:
            start = page.find("<", at)
            if start < 0:
                start = n
            if start > at:
                put(page[at:start])
            if start >= n:
                break
            m = TOKEN.match(page, start) or LOOSE.match(page, start)
            if m is None:
                closing = page.startswith("/", start + 1)
                if page[start + 1 + closing : start + 2 + closing] in LETTERS:  # a tag that never ends takes the rest
                    break
                if closing and (end := page.find(">", start)) >= 0:  # a comment
                    at = end + 1
                    continue
                put("<")
                at = start + 1
                continue
            at = m.end()
            if m[2] is None:
                if page.startswith("<![CDATA[", start):
                    put(page[start + 9 : at - 3])
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "p" and not find(("p",)):
                    fresh("p")
                    continue
                if i := find((tag,), () if tag in BLOCK else ("td", "th", "table")):
                    breaks = any(s[0] in BLOCK for s in stack[i:])
                    pop(i)
                    if breaks or block.marks is not stack[-1][2] and not set(block.marks) <= set(stack[-1][2]):
                        fresh(stack[-1][0])
                continue
            if tag in VOID:
                if tag == "br":
                    put("\n")
                elif tag == "hr":
                    fresh("hr")
                continue
            if tag in RAW:
                if not m[3].endswith("/") or tag in ("script", "style"):
                    end = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                    if tag == "xmp":
                        fresh(tag)
                        put(page[at : end.start() if end else n].replace("&", "&amp;"))
                        fresh(stack[-1][0])
                    at = end.end() if end else n
                continue
            if tag in BLOCK:
                if i := find(("p",), AROUND_P):
                    pop(i)
                if tag in CLOSES and (i := find(CLOSES[tag], STOPS[tag])):
                    pop(i)
            step, kind = self.name(tag, m[3], bool(where.get("article") or where.get("main")))
            _, above, marks = stack[-1]
            if kind and marks and (self.marks[marks[-1]][0] in FIRM or len(marks) >= DEEP):
                kind = None if self.marks[marks[-1]][0] in FIRM else "tag"
            if kind:
                marks = (*marks, len(self.marks))
            if tag in BLOCK:
                container = len(self.parent)
                self.parent.append(above)
                self.step.append(step)
                self.tag.append(tag)
                self.key.append(hash((self.key[above], step)))
                self.children.append([])
                self.children[above].append(container)
            else:
                container = above
            if kind:
                self.marks.append((kind, container if tag in BLOCK else -1))
            where.setdefault(tag, []).append(len(stack))
            stack.append((tag, container, marks))
            if tag in BLOCK:
                fresh(tag)
                self.first.append(len(self.blocks))
                self.last.append(len(self.blocks))
        pop(1)
        if block.parts:
            self.blocks.append(block)

    def name(self, tag: str, source: str, within: bool) -> tuple[str, str | None]:
        """An element's generalised step of a path, and the kind of its mark."""
        classes: list[str] = []
        names: list[str] = []
        hidden = False
        if source and not source.isspace():
            for m in ATTRIBUTE.finditer(source):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "class":
                    classes += value.split()
                elif key in ("id", "role"):
                    names += value.split()
                hidden |= key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and bool(UNSEEN.search(value))
        step = ".".join([tag, *sorted(DIGITS.sub("#", c) for c in classes)]) if classes else tag
        if hidden and tag not in WHOLE_PAGE or tag in NOISE_TAGS:
            return step, "tag"
        if tag in FORM_TAGS:
            return step, "form"
        if tag == "header" and not within:
            return step, "header"
        if tag in WHOLE_PAGE or not (classes or names):
            return step, None
        kind = kind_of(tag, classes + names)
        if tag not in BLOCK and kind != "comments":  # of inline elements only adverts, as a link or a word may be called anything
            kind = "tag" if kind == "named" and any(not ADVERTS.isdisjoint(w.lower() for w in SPLIT.split(c)) for c in classes + names) else None
        return step, kind

    def lifted(self) -> set[int]:
        """The marks that don't count after all.

        A header with a headline, deeper than body and without a menu.  A named or hinted container around the
        only article or main, if that has an h1 or nothing else has text.  A form that has more text than
        all unmarked blocks, and so a hinted container if it has an h1 or the only article.
        """
        out: set[int] = set()
        if not self.marks:
            return out
        own: dict[tuple[int, ...], int] = {}
        for b, t in zip(self.blocks, self.texts, strict=True):
            own[b.marks] = own.get(b.marks, 0) + len(t)
        marked = {c for _, c in self.marks}
        inside: dict[int, set[str]] = {}
        walked: set[tuple[str, int]] = set()
        below = [False] * len(self.tag)  # in a marked container, or one itself
        lone = True
        for c, tag in enumerate(self.tag):
            below[c] = c in marked or c > 0 and below[self.parent[c]]
            if tag in ("h1", "nav", "article", "main"):
                lone &= below[c] or tag in ("h1", "nav")
                up = self.parent[c]
                while up and (tag, up) not in walked:  # all above that have it already
                    walked.add((tag, up))
                    if up in marked:
                        inside.setdefault(up, set()).add(tag)
                    up = self.parent[up]
        for i, (kind, c) in enumerate(self.marks):
            has = inside.get(c, set())
            if kind == "header" and "h1" in has and "nav" not in has and self.tag[self.parent[c]] not in ("", *WHOLE_PAGE):
                out.add(i)
            elif kind not in FIRM and kind != "header":
                only = lone and ("article" in has or "main" in has)
                if only and "h1" in has:
                    out.add(i)
                elif only or kind == "form" or kind == "hinted" and "h1" in has:
                    here = sum(n for marks, n in own.items() if i in marks and out.issuperset(m for m in marks if m != i))
                    rest = sum(n for marks, n in own.items() if i not in marks and out.issuperset(marks))
                    if not rest or kind != "named" and here > rest:
                        out.add(i)
        return out

    def path(self, c: int) -> str:
        steps = []
        while c:
            steps.append(self.step[c])
            c = self.parent[c]
        return "".join(f">{s}" for s in reversed(steps))

    def best(self) -> int | None:
        """The container with the best score (what its own blocks say, and half of what those one level below say), or the article above it."""
        scores: Counter[int] = Counter()
        for b, text, seen in zip(self.blocks, self.texts, self.seen, strict=True):
            size = len(text) - 2 * b.linked if seen else 0
            if size <= 0:
                continue
            c = self.parent[b.container] if b.tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "td", "dd", "dt") and b.container else b.container
            weight = float(size)
            while weight >= 1:
                scores[c] += weight * (2.0 if self.tag[c] in ("article", "main") else 1.0)
                weight /= 2
                if not c:
                    break
                c = self.parent[c]
        return self.whole(min(scores, key=lambda c: (-scores[c], c))) if scores else None

    def whole(self, best: int) -> int:
        """The highest ancestor of a container that adds a section of text that isn't mostly links, reached without one that adds links only.

        An article, main or body is whole as it is; body and what is above it hold the text of the site.
        """
        at = best
        while at and self.tag[at] not in ("article", "main", *WHOLE_PAGE):
            above = self.parent[at]
            if not above or self.tag[above] in WHOLE_PAGE:
                break
            sections: Counter[int] = Counter()
            linked: Counter[int] = Counter()
            under = self.children[above]
            for i in (*range(self.first[above], self.first[at]), *range(self.last[at], self.last[above])):
                if self.seen[i]:
                    c = self.blocks[i].container
                    section = under[bisect_right(under, c) - 1] if c > above and under and c >= under[0] else -1
                    sections[section] += len(self.texts[i])
                    linked[section] += self.blocks[i].linked
            if sections:
                if all(2 * linked[c] > n for c, n in sections.items()):
                    break
                best = above
            at = above
        return best

    def under(self, path: str) -> list[str]:
        """The texts in all containers with a path."""
        key = 0
        for step in path.split(">")[1:]:
            key = hash((key, step))
        ranges = [(self.first[c], self.last[c]) for c, k in enumerate(self.key) if k == key and self.path(c) == path]
        return self.texts_of(ranges)

    def texts_of(self, ranges: list[tuple[int, int]]) -> list[str]:
        out, done = [], 0
        for a, b in ranges:  # in page order; one may lie in another
            out += [self.texts[i] for i in range(max(a, done), b) if self.seen[i]]
            done = max(done, b)
        return out


def vote(page: str | None) -> str | None:
    if not isinstance(page, str) or not page:
        return None
    read = Page(page)
    best = read.best()
    return None if best is None else read.path(best)


def extract(page: str | None, winning: list[str]) -> str:
    """The text of the first winning path with text, else of the page's own best container, else empty."""
    if not isinstance(page, str) or not page:
        return ""
    read = Page(page)
    for path in winning:
        if found := read.under(path):
            return "\n\n".join(found)
    best = read.best()
    return "" if best is None else "\n\n".join(read.texts_of([(read.first[best], read.last[best])]))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_paths: int = MAX_PATHS, min_share: float = 0.1) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null and empty pages, and pages without article text, give an empty text.  A null url is a host of its
    own kind (empty name); null ids and repeated rows are treated like others (each repeated row votes), and
    ids of any size are exact.  A very long page is read whole, in time and memory in proportion to it.  Of
    paths with equal votes the first in their order wins, of containers with equal scores the first of the
    page.  An empty table gives an empty result; other columns, whatever their names, are neither read nor
    kept.  Votes are counted before they move; a frequent host's pages are never in one task.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[^/?#]*//)?(?:[^/?#@]*@)?([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = Counter((h, p) for h, p in zip(pdf["host"], map(vote, pdf["html"]), strict=True) if p is not None)
            yield pd.DataFrame([(h, p, n) for (h, p), n in found.items()], columns=["host", "path", "n"])

    counted = map_slices(rows.select("host", "html"), votes, "host string, path string, n long").groupBy("host", "path").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("at", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))).withColumn("total", F.sum("n").over(Window.partitionBy("host")))
    winners = ranked.where((F.col("at") <= max_paths) & (F.col("n") >= min_share * F.col("total"))).groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "path"))), lambda x: x["path"]).alias("winning"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [extract(h, list(w) if w is not None else []) for h, w in zip(pdf["html"], pdf["winning"], strict=True)]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": list(map(len, texts))})

    winners = stored(winners, "winners")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length(F.array_join("winning", "")) + 64)).first()[0] or 0
    if size <= MAX_BROADCAST:  # no page moves
        joined = rows.join(F.broadcast(winners), "host", "left")
    else:  # every host's pages in SALT parts
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT))
        joined = rows.withColumn("salt", salt).join(winners.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))), ["host", "salt"], "left")
    return map_slices(joined.select("page_id", "url", "html", "winning"), run, "page_id long, url string, text string, n_chars long")
