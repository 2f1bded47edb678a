"""HTML extraction by consensus host paths.

Each page's blocks of text are scored, links counting against them.  Its content is what is not left out and has a
score, and headlines; where articles and main parts hold most of the score, their blocks, headlines, and paragraphs without
links beside them.  The deepest
container of all of the content is the page's vote.  Votes are generalised tag-class paths (such as
``html/body/div.post/article``; digits in classes are dropped), summed per host by Spark; every path with at least a
tenth of its host's votes wins (ten at most, by arithmetic).  Each page is then extracted again from the first winning
path that has all of its content; a page with none such, from its own vote.  Menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments inside a container are left out.

Cases: a null or empty page has an empty text; a null url has the empty host; pages of any length are read whole;
unclosed and stray tags are tolerated; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join, stored, table, text_chunks, url_parts

#: Elements whose inside isn't markup of the page: it goes, up to their own end tag.
RAW = frozenset("script style noscript template textarea title iframe svg select canvas".split())
#: Of these, the ones that hold others of their own kind.
NESTED = frozenset(["svg", "template"])
#: A tag ends at the first ``>`` that isn't in a quoted value; pieces don't give anything back, so that a scan is linear.
TAG = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>""", re.S)
#: The same where quotes don't pair up.
LOOSE = re.compile(r"<(/?)([a-zA-Z][\w:-]*)([^>]*)>", re.S)
OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*>|[^<]+|<", re.S)
PLAIN = re.compile(r"<!--.*|[^<]+|<", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html tbody td tfoot th thead tr caption li dd dt summary".split())
LEFT_OUT = frozenset("nav footer aside form button dialog menu head label option input fieldset".split())
#: Names (whole classes, ids or roles) of parts that aren't the article.
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter commentlist adsbygoogle notice notices paywall popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar widget complementary contentinfo search alert".split()
)
#: Words that make a name of several words with those above (``site-footer``, ``comments-list``) and say nothing themselves.
PLACES = frozenset("articles media message mpu placement thread user wp area bar block bottom box button buttons container form global header icons inner item items left link links list main menu mobile nav page panel post primary right row secondary section site slot top unit wrap wrapper".split())
#: Names that may as well be what a part of an article is about.
TOPICS = frozenset("search alert".split())
#: Names of articles that aren't the page's own.
FOREIGN = frozenset("comment comments reply replies ad ads advert advertisement promo promoted promotion related sponsored".split())
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")
#: Elements that hold a text, not an article.
TEXT = frozenset("p li pre blockquote h1 h2 h3 td".split())
PROSE = frozenset("p pre blockquote".split())
#: Articles and main parts that hold this part of a page's score have its content.
MOST = 0.75


def names_other_part(value: str, inside: bool = False) -> bool:
    """Whether a class, id or role names a part that isn't the article, by all of its words; ``inside`` one, headers and topics stay."""
    for name in value.split():
        parts = WORDS.findall(name)
        if inside and ("header" in parts or not TOPICS.isdisjoint(parts)):
            continue
        if name in OTHER_PARTS or parts and not OTHER_PARTS.isdisjoint(parts) and all(x in OTHER_PARTS or x in PLACES for x in parts):
            return True
    return False


def tokens(source: str) -> Iterator[tuple[re.Match, str | None]]:
    """A page's tags with their names, and its texts and comments with None; raw elements come as their start tag never does.

    A raw element that closes itself is empty, and one without an end tag ends at once (a script or style at the next
    tag), so that nothing after it is lost.
    """
    at, paired, flat, none_left = 0, True, set(), set()
    last = source.rfind(">")  # no tag begins after it
    while at < len(source):
        m = None
        if source[at] == "<" and at < last and (source[at + 1] == "/" or source[at + 1].isalpha()):
            m = (TAG if paired else LOOSE).match(source, at)
            if m is None and paired and source[at + 1 : at + 3].strip("/")[:1].isalpha():
                # Quotes don't pair up to the end: from here on they don't count.
                paired = False
                m = LOOSE.match(source, at)
        if m is None:
            m = (OTHER if at < last else PLAIN).match(source, at)
            at = m.end()
            yield m, None
            continue
        tag, at = m[2].lower(), m.end()
        if tag not in RAW:
            yield m, tag
            continue
        if m[1] or m[3].endswith("/"):
            continue
        end = None if tag in none_left else _raw_end(source, tag, at, flat)
        if end is not None:
            at = end
            continue
        none_left.add(tag)
        if tag in ("script", "style"):
            following = re.compile(r"<(?=/?[a-zA-Z!])").search(source, at)
            at = following.start() if following else len(source)


def _raw_end(source: str, tag: str, at: int, flat: set[str]) -> int | None:
    """Where a raw element ends; None without an end tag.  ``flat`` gets kinds whose tags turned out not to be balanced."""
    if tag in NESTED and tag not in flat:
        depth = 1
        for m in re.compile(rf"<(/?){tag}\b([^>]*)>", re.I).finditer(source, at):
            depth += -1 if m[1] else 0 if m[2].endswith("/") else 1
            if not depth:
                return m.end()
        flat.add(tag)
    m = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
    return m.end() if m else None


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


class Page:
    """Elements (parent, path, left out) and blocks (element, source text, letters in links) of a page."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.path: list[str] = []
        self.out: list[bool] = []
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = []  # open elements
        blocks_at: list[int] = []  # places of blocks among them
        counts: dict[str, int] = {}
        held: list[str] = []
        linked = 0
        owner = -1

        def flush():
            nonlocal linked, owner
            if held:
                text = "".join(held)
                if not text.isspace():
                    self.blocks.append((owner, text, linked))
                held.clear()
            linked, owner = 0, -1

        def close(to: int):
            while len(stack) > to:
                counts[stack.pop()[0]] -= 1
            while blocks_at and blocks_at[-1] >= to:
                blocks_at.pop()

        for m, tag in tokens(source):
            if tag is None:
                text = m[0]
                if text[0] != "<" or text == "<":
                    if owner < 0:
                        owner = stack[-1][1] if stack else -1
                    held.append(text)
                    if counts.get("a"):
                        linked += len(text)
                continue
            if m[1]:
                if tag in BLOCK:
                    flush()
                if counts.get(tag):
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
                continue
            if tag == "br":
                held.append(" ")
                continue
            if tag in BLOCK:
                flush()
                cell = tag in ("li", "dd", "dt", "td", "th", "tr")
                if blocks_at and (cell or tag in CLOSES_P):
                    last = stack[blocks_at[-1]][0]
                    if last == "p" or cell and last == tag:
                        close(blocks_at[-1])
            if tag in VOID:
                continue
            above = stack[-1][1] if stack else -1
            if tag in BLOCK or tag in LEFT_OUT:
                names, out = self._attributes(tag, m[3], above)
                self.parent.append(above)
                self.path.append(f"{self.path[above]}/{tag}{names}" if above >= 0 else tag + names)
                self.out.append(out)
                above = len(self.parent) - 1
            if tag in BLOCK:
                blocks_at.append(len(stack))
            stack.append((tag, above))
            counts[tag] = counts.get(tag, 0) + 1
        flush()

    def _attributes(self, tag: str, source: str, above: int) -> tuple[str, bool]:
        out = above >= 0 and self.out[above]
        inside = above >= 0 and ("/article" in self.path[above] or "/main" in self.path[above])
        out = out or tag in LEFT_OUT or tag == "header" and not inside
        names = ""
        if source and not source.isspace():
            for a in ATTRIBUTE.finditer(source):
                key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                value = (CAMEL.sub("-", value) if key in ("class", "id") else value).lower()
                if key == "class":
                    names = "".join("." + x for x in sorted({re.sub(r"\d+", "", x) for x in value.split()} - {""}))
                if key in ("class", "id", "role"):
                    if tag not in ("body", "html", "article", "main"):
                        out = out or names_other_part(value, inside)
                    elif tag == "article" and names_other_part(value):
                        out = out or not FOREIGN.isdisjoint(WORDS.findall(value))
                elif key == "hidden":
                    out = True
                elif key == "aria-hidden":
                    out = out or value == "true"
                else:
                    out = out or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        return names, out

    def content(self) -> tuple[list[int], float]:
        """The blocks (their places) that an extracted text must have, and their score.

        These are the kept blocks with a score, and kept headlines.  Where articles and main parts hold most of the
        score, they are those in any of them, and headlines.
        """
        named = []
        for path, above in zip(self.path, self.parent, strict=True):
            named.append(above >= 0 and named[above] or _tag(path) in ("article", "main"))
        found = []
        for i, (at, text, linked) in enumerate(self.blocks):
            if at < 0 or not self.out[at]:
                value = max(0.0, len(text) - 2.0 * linked)
                head = at >= 0 and _tag(self.path[at]) == "h1"
                if value > 0 or head:
                    found.append((i, value, head, at >= 0 and named[at]))
        total = sum(x[1] for x in found)
        if sum(x[1] for x in found if x[3]) >= MOST * total:
            # Paragraphs beside the article belong to it as well; what else is there, and what has links, doesn't.
            inside = [x for x in found if x[2] or x[3] or self._paragraph(x[0])]
            found = inside or found
        return [x[0] for x in found], sum(x[1] for x in found)

    def _paragraph(self, i: int) -> bool:
        at, _, linked = self.blocks[i]
        return not linked and at >= 0 and _tag(self.path[at]) in PROSE

    def vote(self, content: tuple[list[int], float] | None = None) -> tuple[str, float]:
        """The path of the deepest container of all of the page's content, and the content's score."""
        places, most = content or self.content()
        if most <= 0:
            return "", 0.0
        owners = {self.blocks[i][0] for i in places}
        best = owners.pop()
        for at in owners:
            while at != best:  # parents come before their children
                if at > best:
                    at = self.parent[at]
                else:
                    best = self.parent[best]
        while best >= 0 and self.parent[best] >= 0 and _tag(self.path[best]) in TEXT:
            best = self.parent[best]
        return (self.path[best], most) if best >= 0 else ("", most)

    def holds(self, path: str, places: list[int]) -> bool:
        """Whether the elements with a path have all of some blocks."""
        wanted = self._below(path)
        return all(self.blocks[i][0] >= 0 and wanted[self.blocks[i][0]] for i in places)

    def _below(self, path: str | None) -> list[bool]:
        wanted = [False] * len(self.parent)
        for i, p in enumerate(self.path):
            wanted[i] = path is None or p == path or self.parent[i] >= 0 and wanted[self.parent[i]]
        return wanted

    def text(self, path: str | None) -> str:
        """The blocks below the elements with a path, in page order; None: all blocks."""
        wanted = self._below(path)
        held = (t for at, t, _ in self.blocks if (path is None if at < 0 else wanted[at] and not self.out[at]))
        return "\n\n".join(filter(None, (" ".join((_html.unescape(t) if "&" in t else t).split()) for t in held)))

    def extract(self, winners: list[str]) -> str:
        have = set(self.path)
        content = self.content()
        for path in winners:
            if path in have and self.holds(path, content[0]) and (text := self.text(path)):
                return text
        path = self.vote(content)[0]
        return self.text(path if path else None)


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, score`` of each page; the input has ``host, html``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_chunks(whole, "html", 1 << 23):
                found = [Page(x or "").vote() for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["host", "path", "score"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, score double")


def winning_paths(cast: DataFrame) -> DataFrame:
    """``host, paths, _n``: those with a tenth of the host's votes at least, most first; and the host's pages.  A page's vote counts once."""
    counted = cast.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    total = counted.groupBy("host").agg(F.sum(F.when(F.col("path") != "", F.col("n"))).alias("all"), F.sum("n").alias("_n"))
    won = counted.where("path <> ''").join(total, "host").where(F.col("n") * 10 >= F.col("all"))
    listed = won.groupBy("host", "_n").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("w"))
    return listed.select("host", F.col("w.path").alias("paths"), "_n")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), url_parts(F.col(url_col))[0].alias("host"), F.col(html_col).alias("html"))
    won = stored(winning_paths(votes(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_chunks(whole, "html", 1 << 23):
                texts = [Page(x or "").extract(w or []) for x, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)["page_id"]
    return salted_join(rows, won, "host").select("page_id", "url", "html", "paths").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op10_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
