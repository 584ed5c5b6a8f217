"""Main text of web pages: block structure, and differencing against the nearest URL."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import batches_of, rows_of, scope, ship_package, written

# Elements without text, elements that end a block, elements and names around the article.
SILENT = {"head", "title", "script", "style", "noscript", "template", "iframe", "svg", "object", "select",
          "textarea", "button", "canvas", "audio", "video"}
AROUND = {"nav", "footer", "aside", "form", "menu", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
          "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
          "ul"} | AROUND
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|sidebar|side-bar|comments?|respond|reply|replies|"
    r"disqus|cookies?|consent|notice|banner|alert|popup|modal|menu|nav|navbar|navigation|breadcrumbs?|footer|"
    r"masthead|site-header|page-header|share|sharing|social|newsletter|subscribe|signup|related|recommended|"
    r"widget|toolbar|skip-link|pagination|legal|disclaimer)(?:$|[\s_-])", re.I)
#: Names that say what a whole page has or how it looks, not what the element is: has-sidebar, comments-enabled.
_TRAITS = re.compile(r"^(?:has|no|not|with|without|is|show|hide|page|layout|theme)-|-(?:enabled|disabled|open|closed|allowed|on|off|active|visible)$")
#: Names that make an element no part of an article even where it is, or holds, one: teasers and comments.
_APART = {"comment", "comments", "reply", "replies", "respond", "related", "recommended", "sidebar", "side-bar", "teaser", "teasers"}
#: Names that are ordinary parts of an article once inside it.
_INSIDE = {"legal", "disclaimer", "alert", "banner", "widget", "toolbar", "masthead"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
SPACES = re.compile(r"\s+")
#: Pages that one task puts in the order of their URLs.
PART_ROWS = 20_000


class _Blocks(HTMLParser):
    """Blocks of a page: text, whether inside the marked article, whether around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool, bool]] = []
        self._open: list[tuple[str, bool, bool, bool, bool]] = []  # tag; silent, article, around, apart, with what encloses it
        self._parts: list[str] = []

    def _state(self) -> tuple[bool, bool, bool, bool]:
        return self._open[-1][1:] if self._open else (False, False, False, False)

    def end_block(self) -> None:
        text = SPACES.sub(" ", "".join(self._parts)).strip()
        self._parts = []
        if text:
            _, article, around, _ = self._state()
            self.blocks.append((text, article, around))

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_block()
        elif tag == "br":
            self._parts.append(" ")
        if tag in VOID:
            return
        if tag in BLOCKS:
            # A paragraph that was not closed ends where the next block starts.
            last = next((i for i in range(len(self._open) - 1, -1, -1) if self._open[i][0] in BLOCKS), None)
            if last is not None and self._open[last][0] == "p":
                del self._open[last:]
        given = {k: v or "" for k, v in attrs}
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and self._open and self._open[-1][0] == tag:
            self._open.pop()
        silent, article, around, apart = self._state()
        role = given.get("role", "").lower()
        main = tag in ("article", "main") or role == "main" or given.get("itemprop", "") == "articleBody"
        names = {n for n in f"{given.get('class', '')} {given.get('id', '')}".lower().split() if not _TRAITS.search(n)}
        named = tag not in ("html", "body") and any(NAMES.search(n) for n in names - (_INSIDE if article else set()))
        hidden = "hidden" in given or given.get("aria-hidden", "") == "true"
        apart = apart or hidden or bool(names & _APART) or tag in AROUND - {"form"} or role in ROLES - {"form"}
        if main and not article:
            around = apart  # what only wraps an article says nothing about it
        else:
            around = around or apart or tag in AROUND or role in ROLES or (named and not main) or (tag == "header" and not article)
        self._open.append((tag, silent or tag in SILENT, (article or main) and not around, around, apart))

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_block()
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at][0] == tag:
                del self._open[at:]
                break
            if tag not in BLOCKS and self._open[at][0] in BLOCKS:
                break  # an inline end tag closes nothing outside its block

    def handle_data(self, data):
        if not self._state()[0]:
            self._parts.append(data)


def page_blocks(html: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in the marked article, around it) of each block in page order."""
    reader = _Blocks()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    return reader.blocks


def common_lines(own: list, other: list) -> set[int]:
    """Places in ``own`` of a longest common subsequence of both."""
    places = defaultdict(list)
    for j, x in enumerate(other):
        places[x].append(j)
    ends: list[int] = []
    last: list[tuple[int, tuple | None]] = []
    chain: list = []
    for i, x in enumerate(own):
        for j in reversed(places.get(x, ())):
            at = bisect_left(ends, j)
            node = (i, chain[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                chain.append(node)
            else:
                ends[at], chain[at] = j, node
    found, last = set(), chain[-1] if chain else None
    while last:
        found.add(last[0])
        last = last[1]
    return found


def template_edges(own: list[int], nearest: list[int], second: list[int]) -> tuple[int, int]:
    """Lines at the head and at the end of a marked article that are part of the site's template: aligned with a line
    of both neighbours' articles, without a break from the edge. Neighbours that share half of the lines or more
    are versions of one article and tell nothing; nor do two that are copies of each other."""
    pairs = [(own, nearest), (own, second), (nearest, second)]
    shared = [common_lines(a, b) for a, b in pairs]
    if any(2 * len(s) >= min(len(a), len(b)) for s, (a, b) in zip(shared, pairs, strict=True)):
        return 0, 0
    gone = shared[0] & shared[1]
    head = next(i for i in range(len(own)) if i not in gone)
    return head, next(i for i in range(len(own)) if len(own) - 1 - i not in gone)


def main_text(blocks: list[tuple[str, bool, bool]], keys: list[int], nearest: list[int] | None,
              edges: tuple[int, int] = (0, 0)) -> str:
    """The lines that stay. A marked article loses its ``template_edges``. Without one, lines
    shared with the nearest page go, unless all of them are shared (a copy of the page)."""
    if any(article for _, article, _ in blocks):
        lines = [text for text, article, around in blocks if article and not around]
        return "\n".join(lines[edges[0]:len(lines) - edges[1]])
    body = {i for i, (_, _, around) in enumerate(blocks) if not around}
    shared = common_lines(keys, nearest) if nearest else set()
    if body - shared:
        body -= shared
    return "\n".join(blocks[i][0] for i in sorted(body))


def _key(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


_BLOCK_SQL = "array<struct<text string, article boolean, around boolean>>"
_BLOCK = pa.list_(pa.struct([("text", pa.string()), ("article", pa.bool_()), ("around", pa.bool_())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of pages with a marked article; the blocks of the others; the keys of the lines of all, and of
    those that structure alone takes."""
    schema = pa.schema([("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                        ("blocks", _BLOCK), ("keys", pa.list_(pa.int64())), ("inner", pa.list_(pa.int64()))])

    def rows():
        for batch in batches:
            for row, page_id, url, html in zip(*[batch.column(c).to_pylist() for c in ("row", "page_id", "url", "html")], strict=True):
                blocks = [(t.encode("utf-8", "replace").decode(), a, b) for t, a, b in page_blocks(html)]
                keys = [_key(b[0]) for b in blocks]
                marked = any(article for _, article, _ in blocks)
                inner = [k for k, (_, article, around) in zip(keys, blocks, strict=True) if not around and article >= marked]
                if marked:
                    yield row, page_id, url, main_text(blocks, keys, None), None, keys, inner
                else:
                    yield (row, page_id, url, None,
                           [dict(zip(("text", "article", "around"), b, strict=True)) for b in blocks], keys, inner)

    yield from batches_of(rows(), schema, size=512)


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def rows():
        for batch in batches:
            for page_id, url, blocks, keys, other in zip(
                    *[batch.column(c).to_pylist() for c in ("page_id", "url", "blocks", "keys", "other")], strict=True):
                yield page_id, url, main_text([(b["text"], b["article"], b["around"]) for b in blocks], keys, other)

    yield from batches_of(rows(), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``template_edges`` of marked articles that have any."""
    schema = pa.schema([("_row", pa.int64()), ("head", pa.int32()), ("tail", pa.int32())])

    def rows():
        for row, own, nearest, second in rows_of(batches, "row", "own", "near_lines", "second_lines"):
            edges = template_edges(own, nearest, second)
            if any(edges):
                yield row, *edges

    yield from batches_of(rows(), schema)


def _article_edges(parsed: DataFrame, near: DataFrame) -> DataFrame:
    """_row, head and tail: lines that a marked article loses at its edges. Only keys of lines are moved."""
    own = parsed.where("text is not null and size(inner) > 0").select("row", F.col("inner").alias("own"))
    rows = own.join(near.where("second is not null"), "row")
    for c, to in (("nearest", "near_lines"), ("second", "second_lines")):
        rows = rows.join(parsed.select(F.col("row").alias(c), F.col("inner").alias(to)), c)
    return rows.select("row", "own", "near_lines", "second_lines").mapInArrow(_cut, "_row long, head int, tail int")


def nearest_rows(rows: DataFrame, parts: int) -> DataFrame:
    """(row, nearest, second) by URL path within each host: of the neighbours in path order the one
    with the longer common path, the earlier one in a tie; and the other one, if it is of the host.

    Range partitions share out a host of any size; the rows at their edges
    look at the edge of the next partition.
    """
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    place = rows.select("row", F.lower(F.regexp_extract(bare, "^([^/?#]*)", 1)).alias("host"),
                        F.split(F.regexp_extract(bare, "^[^/?#]*([^?#]*)", 1), "/").alias("path"))
    order = ["host", "path", "row"]
    dealt = written(place.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "url-order")
    me = F.struct(*order)
    within = Window.partitionBy("part").orderBy(*order)
    # One row per partition.
    edges = dealt.groupBy("part").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    across = Window.orderBy("part")
    edges = edges.select("part", F.lag("high").over(across).alias("before"), F.lead("low").over(across).alias("after"))
    seen = dealt.select("*", F.lag(me).over(within).alias("prev"), F.lead(me).over(within).alias("next")).join(edges, "part", "left")

    def common(other: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size("path"))
        equal = F.size(F.filter(steps, lambda i: F.slice(F.col("path"), 1, i) == F.slice(other["path"], 1, i)))
        return F.when(other["host"] == F.col("host"), equal)

    prev, after = F.coalesce("prev", "before"), F.coalesce("next", "after")
    seen = seen.select("row", "host", "path", prev.alias("prev"), after.alias("next")).select(
        "row", "prev", "next", common(F.col("prev")).alias("p"), common(F.col("next")).alias("n"))
    nearest = F.when(F.col("p").isNotNull() & (F.col("n").isNull() | (F.col("p") >= F.col("n"))), F.col("prev.row")).when(
        F.col("n").isNotNull(), F.col("next.row"))
    second = F.when(F.col("p").isNotNull() & F.col("n").isNotNull(), F.when(F.col("p") >= F.col("n"), F.col("next.row")).otherwise(F.col("prev.row")))
    return seen.select("row", nearest.alias("nearest"), second.alias("second")).where("nearest is not null")


def extract_main(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                 parts: int | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Each page without a marked article is compared with the page of its host whose path is nearest: their
    lines are aligned by longest common subsequence and shared lines deleted. A marked article
    (article, main, role) loses the menus, notices, comments and the like inside it. Copies and quoted
    passages share its lines rightly, so differencing takes from it only lines at its head and end that both
    neighbours of the host share while the articles differ otherwise; see ``template_edges``.
    Null or empty html gives an empty text. Pages without a URL share the empty host;
    repeated rows are pages of their own, compared like others. Other columns are ignored.
    ``parts``: tasks that order the pages by URL, by default one for each ``PART_ROWS`` pages.

    Text of marked articles is stored when it is parsed and only cut at its edges afterwards; keys alone are compared.
    Blocks are stored, and joined with the lines of the nearest page, for the other pages only. Three tables
    stay below the shared folder, as the result reads them.
    """
    ship_package(pages.sparkSession)
    marked = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("page_id"),
                          F.col(url).alias("url"), F.col(html).alias("html"))
    with scope() as here:
        parsed = here.keep(written(marked.mapInArrow(
            _parse, f"row long, page_id long, url string, text string, blocks {_BLOCK_SQL}, keys array<long>, inner array<long>"), "page-lines", 512))
        near = written(nearest_rows(parsed.select("row", "url"), parts or parsed.count() // PART_ROWS + 1), "page-near")
        edges = here.keep(written(_article_edges(parsed, near), "page-edges"))
        bare = near.select("row", "nearest").join(parsed.where("text is null").select("row"), "row", "left_semi")
        others = here.keep(written(bare.join(
            parsed.select(F.col("row").alias("nearest"), F.col("keys").alias("other")), "nearest").select(
            F.col("row").alias("_row"), "other"), "page-neighbours"))
    compared = parsed.where("text is null").join(others, F.col("row") == F.col("_row"), "left").select(
        "page_id", "url", "blocks", "keys", "other").mapInArrow(_select, "page_id long, url string, text string")
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.slice(lines, F.col("head") + 1, F.size(lines) - F.col("head") - F.col("tail")), "\n")
    marked = parsed.where("text is not null").join(edges, F.col("row") == F.col("_row"), "left").select(
        "page_id", "url", F.when(F.col("head").isNull(), F.col("text")).otherwise(left).alias("text"))
    found = marked.unionAll(compared)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
